"""Licence scans by MinHash bands over overlapping text windows, in DataFrame functions only.

A template is a known notice of five words or more; its shingles are its five-word sequences (lower case, letters a-z and
digits). Its class is the power of two at or over its number of shingles. A document is cut, for each class c, into windows of
2c shingles, one every c, so that any occurrence of up to c shingles lies whole in a window. BANDS MinHash bands of one row
each retrieve templates: a window that holds 80 % of a template's shingles has a Jaccard similarity of 0.19 at least (0.36 where
the template fills its class), and so shares a band with it with a probability over 0.99995. The exact share of the template's
distinct shingles that the window holds then decides: CONTAINED or more is a match.

Two prunings lose nothing: every match holds a word or phrase of ``anchors``, so a text without any of them has none; and a window
without any template shingle has none. The texts left are written to the shared folder once, for all classes. Templates are fixed and few; over ``BROADCAST`` of them are joined, not sent.

Nulls: a null text counts as empty and has no match. Rows of one id, or without one, count together. Texts of under five words
have no shingles. Empty tables give no rows. Further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import materialise

SHINGLE = 5
BANDS = 48
CONTAINED = 0.8
BROADCAST = 10_000  # templates

#: The notices and, where they are short, the whole texts of public licences, by name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "MIT": "Released under the MIT License",
    "MIT-notice": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so',
    "ISC-notice": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "LGPL-notice": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "Zlib-notice": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
    "BSL-1.0": "Distributed under the Boost Software License, Version 1.0.",
    "AGPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-2.0-notice": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "EPL-1.0": "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "MPL-2.0-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "MIT-warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "MIT-whole": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "ISC-whole": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "BSD-source-clause": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "BSD-binary-clause": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "BSD-4-advertising": "All advertising materials mentioning features or use of this software must display the following acknowledgement",
    "BSD-warranty": 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    "Zlib-whole": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    "Unlicense-whole": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
    "BSL-1.0-whole": "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
    "WTFPL": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",
    "Artistic-2.0": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    "All-rights-reserved": "All rights reserved. No part of this publication may be reproduced, stored in a retrieval system, or transmitted in any form or by any means without the prior written permission of the publisher.",
}


def words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def shingles(text: str) -> list[str]:
    """The distinct shingles of a template, in order."""
    w = words(text)
    return list(dict.fromkeys(" ".join(w[i : i + SHINGLE]) for i in range(len(w) - SHINGLE + 1)))


def size_class(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def anchors(templates: dict[str, str]) -> tuple[list[str], list[str]]:
    """Words of six letters or more, and three-word phrases, of which every match holds one.

    A match holds CONTAINED of a template's shingles, so it is enough that those without an anchor are fewer. Long words, and such
    as serve several templates, come first; phrases serve where words don't suffice.
    """
    left = {name: set(shingles(t)) for name, t in templates.items()}
    most = {name: len(s) for name, s in left.items()}
    out: tuple[list[str], list[str]] = ([], [])
    cut = (lambda s: {w for w in s.split() if len(w) >= 6}, lambda s: {" ".join(s.split()[i : i + 3]) for i in range(3)})
    for kept, parts in zip(out, cut, strict=True):
        while True:
            seen: Counter = Counter()
            for name, own in left.items():
                over = len(own) - math.ceil(CONTAINED * most[name]) + 1  # how many must still get an anchor
                if over > 0:
                    for w, n in Counter(w for s in own for w in parts(s)).items():
                        seen[w] += min(n, over)
            if not seen:
                break
            best = max(seen, key=lambda w: (seen[w] * len(w) ** 2, w))
            kept.append(best)
            left = {name: {s for s in own if best not in parts(s)} for name, own in left.items()}
    return out


def _banded(df: DataFrame, hashes: str, *keep: str) -> DataFrame:
    """The bands of each row's set of shingle hashes: the least of each of BANDS hash functions."""
    rows = df.select(*keep, hashes, F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"))
    return rows.select(*keep, "band", F.array_min(F.transform(hashes, lambda x: F.xxhash64(x, F.col("band")))).alias("value"))


def _joined(w: Column) -> Column:
    """The shingles of an array of words; none if there are fewer than five."""
    at = F.when(F.size(w) >= SHINGLE, F.sequence(F.lit(1), F.size(w) - SHINGLE + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.array_join(F.slice(w, i, SHINGLE), " "))


def _once(value: Column) -> Column:
    """The value, computed once a row: the optimiser does not copy it into lambdas that use it for each of their elements."""
    return F.explode(F.array(value))


def find(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, template, containment, first_word, windows): best share, first word of the first matching window, matching windows."""
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    known = {name: shingles(text) for name, text in templates.items()}
    if not all(known.values()):
        raise ValueError(f"a template needs {SHINGLE} words at least")
    table = spark.createDataFrame([(n, size_class(len(s)), s) for n, s in known.items()], "template string, class int, shingles array<string>")
    table = table.withColumn("h", F.transform("shingles", lambda s: F.xxhash64(s)))
    marks: dict[int, set[int]] = {}
    for r in table.select("class", "h").collect():  # the templates' own shingles
        marks.setdefault(r[0], set()).update(r[1])
    bands = _banded(table, "h", "template", "class", "shingles")

    low = F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    has, (long, phrases) = F.lit(False), anchors(templates)
    for w in long:
        has = has | F.contains(F.col("low"), F.lit(w))
    for p in phrases:
        has = has | F.contains(F.col("norm"), F.lit(p))
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), _once(low).alias("low"))
    text = text.select("doc_id", "low", _once(F.regexp_replace("low", "[^a-z0-9]+", " ") if phrases else F.lit("")).alias("norm")).filter(has)
    text = text.select("doc_id", _once(F.regexp_extract_all("low", F.lit("[a-z0-9]+"), F.lit(0))).alias("w"))
    text = text.select("doc_id", "w", _once(F.transform(_joined(F.col("w")), lambda s: F.xxhash64(s))).alias("h")).filter(F.size("h") > 0)
    text = materialise(text, "licence-texts")  # each class reads these few, not the table

    out = None
    for c, own in sorted(marks.items()):
        hashed = sorted(own)
        held = text.filter(F.exists("h", lambda x: x.isin(hashed)))
        spans = F.transform(F.sequence(F.lit(0), F.floor((F.size("h") - 1) / c).cast("int")), lambda j: F.struct(j.alias("j"), F.slice("h", j * c + 1, 2 * c).alias("s")))
        held = held.select("doc_id", "w", F.explode(F.filter(spans, lambda x: F.exists(x["s"], lambda y: y.isin(hashed)))).alias("x"))
        held = held.select("doc_id", F.lit(c).alias("class"), F.col("x.j").alias("j"), F.slice("w", F.col("x.j") * c + 1, 2 * c + SHINGLE - 1).alias("part"), F.col("x.s").alias("s"))
        out = held if out is None else out.union(held)
    if out is None:
        return spark.createDataFrame([], "doc_id long, template string, containment double, first_word long, windows long")
    near = _banded(out, "s", "doc_id", "class", "j", "part").join(F.broadcast(bands) if len(known) <= BROADCAST else bands, ["class", "band", "value"])
    near = near.groupBy("doc_id", "class", "j", "part", "template", "shingles").agg(F.count("*").alias("shared"))
    share = F.size(F.array_intersect(F.array_distinct(_joined(F.col("part"))), "shingles")) / F.size("shingles")
    near = near.withColumn("share", share).filter(F.col("share") >= CONTAINED)
    return near.groupBy("doc_id", "template").agg(
        F.max("share").alias("containment"), F.min(F.col("j").cast("long") * F.col("class")).alias("first_word"), F.countDistinct("j").alias("windows")
    )


def oracle_sql(templates: dict[str, str] | None = None) -> str:
    """The same matches by exact containment of every window, in DuckDB SQL."""
    rows = ", ".join("('" + n.replace("'", "''") + "', '" + t.replace("'", "''") + "')" for n, t in (TEMPLATES if templates is None else templates).items())
    return f"""
    WITH known(template, body) AS (VALUES {rows}),
    cut AS (SELECT template, regexp_extract_all(lower(body), '[a-z0-9]+') AS w FROM known),
    marks AS (SELECT DISTINCT template, array_to_string(w[i : i + {SHINGLE - 1}], ' ') AS s
              FROM (SELECT template, w, unnest(range(1, len(w) - {SHINGLE - 2})) AS i FROM cut)),
    sizes AS (SELECT template, count(*) AS n, CAST(pow(2, ceil(log2(count(*)))) AS BIGINT) AS c FROM marks GROUP BY template),
    docs AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+') AS w FROM documents),
    places AS (SELECT doc_id, i - 1 AS p, array_to_string(w[i : i + {SHINGLE - 1}], ' ') AS s
               FROM (SELECT doc_id, w, unnest(range(1, len(w) - {SHINGLE - 2})) AS i FROM docs)),
    hits AS (SELECT doc_id, p, template, s FROM places JOIN marks USING (s)),
    held AS (SELECT h.doc_id, h.template, z.n, z.c, h.p // z.c - d.k AS j, h.s
             FROM hits h JOIN sizes z USING (template), (VALUES (0), (1)) d(k) WHERE h.p // z.c - d.k >= 0),
    shares AS (SELECT doc_id, template, c, j, count(DISTINCT s) / n::DOUBLE AS share FROM held GROUP BY doc_id, template, n, c, j)
    SELECT doc_id, template, max(share) AS containment, min(j * c)::BIGINT AS first_word, count(*)::BIGINT AS windows
    FROM shares WHERE share >= {CONTAINED} GROUP BY doc_id, template"""
