import base64
import hashlib
import json
import re

from tessera.llm import secrets as S

SCHEMA = "doc_id long, text string, lang string, spans string, n_chars long"


def b64(x):
    return base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")


def tlv(tag, body):
    n = len(body)
    return bytes([tag]) + (bytes([n]) if n < 128 else bytes([0x82]) + n.to_bytes(2, "big")) + body


RSA = tlv(0x30, b"".join(tlv(2, bytes([1 + i % 100] * 32)) for i in range(9)))
PUBLIC = tlv(0x30, tlv(0x30, tlv(6, b"\x2a\x86\x48") + tlv(5, b"")) + tlv(3, b"\0" * 70))
JWT = f"{b64({'alg': 'HS256'})}.{b64({'sub': 'x'})}.abcdefgh"
FAKE = f"{b64({'no': 'HS256'})}.{b64({'sub': 'x'})}.abcdefgh"
PEM = "-----BEGIN RSA PRIVATE KEY-----\n" + base64.b64encode(RSA).decode() + "\n-----END RSA PRIVATE KEY-----"


def slow_base(t):
    out = []
    rules = (
        ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    )
    for k, (kind, rule, ok) in enumerate(rules):
        out += [(m.start(), k, kind, m.end()) for m in re.finditer(rule, t or "", re.ASCII) if ok(m)]
    return [(a, kind, e) for a, _, kind, e in sorted(out)]


def test_base_spans_equal_brute_force(spark, sf):
    odd = ["token = secret: abcdefghijk", "PASSWORD='" + "x" * 8 + "'", "api_key:short", "AKIAAKIA" + "A" * 12, "a" * 31, "f" * 32 + "G" + "0" * 40, "tokEn=Kabcdefgh", "日本 token=abcdefgh1 é", "", None]
    for t in odd + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]:
        assert [x for x in S.spans(t) if x[1] in S.BASE] == slow_base(t)


def test_only_confirmed_structures():
    kinds = lambda t: [k for _, k, _ in S.spans(t) if k not in S.BASE]
    assert kinds(f"see {JWT} end") == ["jwt"] and kinds(f"see {FAKE} end") == []
    assert kinds(PEM) == ["pem"] and kinds(PEM.replace("MII", "AAA")[:80] + PEM[80:]) == []
    assert kinds("k " + base64.b64encode(RSA).decode()) == ["base64_key"] and kinds("k " + base64.b64encode(RSA[:-1] + b"xx").decode()) == []
    assert kinds("k " + base64.b64encode(RSA[:-9]).decode()) == [] and kinds("k " + base64.b64encode(RSA + b"xyz").decode()) == []
    assert kinds("h " + RSA.hex()) == ["hex_key"] and kinds("h " + RSA[:-1].hex()) == []
    assert kinds("x" * 100_000) == []


def octets(kind, inner):
    return tlv(0x30, tlv(2, b"\0") + tlv(0x30, tlv(6, kind) + tlv(5, b"")) + tlv(4, inner))


ED = octets(bytes.fromhex("2b6570"), tlv(4, b"k" * 32))
CURVE = tlv(0x30, tlv(2, b"\1") + tlv(4, b"s" * 32) + tlv(0xA0, tlv(6, bytes.fromhex("2a8648ce3d030107"))))
OPENSSH = b"openssh-key-v1\0" + b"".join(len(x).to_bytes(4, "big") + x for x in (b"none", b"none", b"")) + (1).to_bytes(4, "big") + b"p" * 120


def test_forms_of_keys():
    kinds = lambda t: [k for _, k, _ in S.spans(t) if k not in S.BASE]
    for raw in (RSA, ED + b"", CURVE, octets(S.RSA, RSA), octets(S.EC, CURVE), OPENSSH):
        for alphabet in (base64.b64encode, base64.urlsafe_b64encode):
            text = alphabet(raw).decode()
            assert kinds(f"a {text} b") == ["base64_key"]
            for width, end in ((64, "\n"), (48, "\r\n"), (52, "\n   "), (64, "\\n")):
                wrapped = end.join(text[i : i + width] for i in range(0, len(text), width))
                if len(text) > 48:
                    found = [x for x in S.spans(f"x:{end}{wrapped}{end}words after it") if x[1] == "base64_key"]
                    assert len(found) == 1 and found[0][0] == len(f"x:{end}") and found[0][2] <= len(f"x:{end}{wrapped}")
        for label in ("PRIVATE KEY", "RSA PRIVATE KEY"):
            body = "\\n".join(re.findall(".{1,64}", base64.b64encode(raw).decode()))
            assert kinds(f'{{"key": "-----BEGIN {label}-----\\n{body}\\n-----END {label}-----\\n"}}') == ["pem"]
    locked = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,%s\n\n%s\n-----END RSA PRIVATE KEY-----"
    body = base64.b64encode(bytes(range(64))).decode()
    assert kinds(locked % ("A0" * 16, body)) == ["pem"] and kinds(locked % ("A0" * 3, body)) == [] and kinds(locked % ("A0" * 16, body[:-8])) == []


def test_what_is_no_secret_or_does_not_parse():
    kinds = lambda t: [k for _, k, _ in S.spans(t) if k not in S.BASE]
    ssh = b"\0\0\0\x07ssh-rsa" + (3).to_bytes(4, "big") + b"\1\0\1" + (64).to_bytes(4, "big") + b"k" * 64
    for raw in (PUBLIC, ssh, octets(S.RSA, b"\x04\x02ab" * 20), octets(S.EC, RSA), octets(bytes.fromhex("2b6570"), b"k" * 32)):
        assert kinds("ssh-rsa " + base64.b64encode(raw).decode()) == [] and kinds(raw.hex().upper()) == []
    deep = base64.urlsafe_b64encode(b'{"alg":' + b"[" * 200_000).decode()
    assert kinds(f"{deep}.{deep}.abc") == []
    for t in ("-----BEGIN PRIVATE KEY-----" * 20_000, ("M" * 63 + "\n") * 5000, "MIIEpAIBAAKC" * 8000, "A" * 64 + ("\n" + "MIIJKQIBAAKC" * 5) * 3000):
        assert kinds(t) == []


def test_scan_and_redact(spark):
    both = f"a token={'b' * 40} and {PEM} z"
    rows = [(1, both, None, "x", 3), (1, both, None, "x", None), (None, None, None, None, None), (2, "", "e", None, 0), (3, "plain", None, None, 5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = S.scan(docs).collect()
    assert len(got) == 5
    for r in got:
        base = slow_base(both if r.doc_id == 1 else "")
        assert (r.n_assign, r.n_access, r.n_hex) == ((1, 0, 1) if r.doc_id == 1 else (0, 0, 0))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, k, b in base).encode()).hexdigest()
    red = {(r.doc_id, r.text, r.n_chars) for r in S.redact(docs).collect()}
    assert red == {(1, "a [SECRET] and [SECRET] z", 25), (None, None, None), (2, "", 0), (3, "plain", 5)}
    assert S.redact(docs).columns == docs.columns and S.scan(docs.limit(0)).count() == 0
