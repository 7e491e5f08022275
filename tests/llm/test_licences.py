import duckdb

from tessera.llm import licences as L

SCHEMA = "doc_id long, text string, w string, h string, band string"


def test_every_match_holds_an_anchor():
    for templates in (L.TEMPLATES, {"one": "a b c d e"}, {"x": "to be or not to be that is it", "y": "licensed under the terms of it all"}):
        long, phrases = L.anchors(templates)
        for t in templates.values():
            s = L.shingles(t)
            assert sum(not any(f" {w} " in f" {x} " for w in [*long, *phrases]) for x in s) < L.CONTAINED * len(s)


def test_templates_hold_whole_texts_and_common_families():
    assert max(len(L.shingles(t)) for t in L.TEMPLATES.values()) > 100
    assert all(any(x in n for n in L.TEMPLATES) for x in ("MIT-whole", "AGPL", "LGPL", "GPL-2", "EPL", "MPL", "BSD-3", "BSD-warranty", "CC0", "ISC-whole", "Zlib-whole", "Unlicense-whole"))


def test_odd_rows_and_changed_notices(spark):
    mit = L.TEMPLATES["MIT-notice"]
    changed = mit.replace("charge", "cost", 1)
    broken = " ".join(w if i % 6 else "zzz" for i, w in enumerate(mit.split()))
    filler = "lorem ipsum dolor " * 400
    texts = [None, "", "license", filler, filler + mit + " " + filler, changed.upper(), broken, (L.TEMPLATES["CC-BY-4.0"] + ". ") * 3, "x " + L.TEMPLATES["MIT"] + " y", "Released under the license"]
    rows = [(i if i != 8 else None, t, "a", "b", "c") for i, t in enumerate(texts)] + [(4, texts[4], None, None, None)]
    got = {(r.doc_id, r.template): round(r.containment, 6) for r in L.find(spark.createDataFrame(rows, SCHEMA)).collect()}
    con = duckdb.connect()
    con.execute("create table documents(doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [(i, t) for i, t, *_ in rows])
    want = {(i, n): round(c, 6) for i, n, c, *_ in con.execute(L.oracle_sql()).fetchall()}
    assert got == want and (4, "MIT-notice") in got and (5, "MIT-notice") in got and (6, "MIT-notice") not in got and (None, "MIT") in got
    assert L.find(spark.createDataFrame([], SCHEMA)).count() == 0
