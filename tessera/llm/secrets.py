"""Secret scans with structural confirmation.

Three base patterns report by form alone: assignments to a secret's name, access key ids, long hexadecimal runs. The other kinds
are reported only if their content decodes and parses: signed tokens (a JSON header that names its algorithm and a JSON
payload), PEM blocks, and bare base64 or hex runs whose bytes are a private key: DER of which every nested length fits, down to
the key inside its wrapper, or an SSH key. Public keys are no secrets. Base64 may be of either alphabet and run over several
lines, with real or written line ends; an encrypted PEM block is confirmed by its headers and the length of its blocks.

Nulls: a null text counts as empty and has no spans. Offsets are code points of the whole text, the end exclusive. Repeated rows
each keep a row. Further columns are ignored by scan() and kept by redact(). What doesn't parse, however deep or long, is passed
over.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The kinds, in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "jwt", "pem", "base64_key", "hex_key")
BASE = KINDS[:3]

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
NAMES = ("passw", "secret", "token", "api")  # a text without any of them, in lower case, has no assignment
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, so the same as [0-9a-f]+ of 32 or more
TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{4,}\.[A-Za-z0-9_-]*")
PEM_LINE = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
PEM_BODY = re.compile(r"[A-Za-z0-9+/=\s:,-]*")
#: A run of either base64 alphabet that begins as a key does; written line ends before it are not part of it.
RUN64 = re.compile(r"[Mb](?:(?<=\\n[Mb])|(?<=\\r[Mb])|(?<![A-Za-z0-9+/_\\-][Mb]))[A-Za-z0-9+/_-]{47,}={0,2}")
MORE64 = re.compile(r"(?:\r?\n|\\r\\n|\\n)[ \t]*([A-Za-z0-9+/_-]+)={0,2}")
RUN16 = re.compile(r"[36](?<![0-9A-Fa-f][36])[0-9A-Fa-f]{71,}(?![0-9A-Fa-f])")
SSH = b"openssh-key-v1\0"
SSH64 = "b3BlbnNzaC1rZXktdjE"  # how its base64 begins
#: Object ids (DER) of key types and what their wrapped key is.
RSA, EC, DSA = bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a8648ce3d0201"), bytes.fromhex("2a8648ce380401")
CURVES = {bytes.fromhex("2b6570"): 32, bytes.fromhex("2b6571"): 57, bytes.fromhex("2b656e"): 32, bytes.fromhex("2b656f"): 56}


def _unpadded(s: str) -> bytes | None:
    try:
        return base64.urlsafe_b64decode(s + "=" * (-len(s) % 4))
    except (binascii.Error, ValueError):
        return None


def is_signed_token(s: str) -> bool:
    """Three parts, of which the first is a JSON object that names its algorithm and the second a JSON object."""
    head, body, mark = s.split(".", 2)
    try:
        h, b = (json.loads(_unpadded(x) or b"") for x in (head, body))
    except (ValueError, RecursionError):  # no JSON, or nested too deep to be a token
        return False
    if not isinstance(h, dict) or not isinstance(b, dict) or not isinstance(h.get("alg"), str):
        return False
    return h["alg"].lower() == "none" or bool(_unpadded(mark))


def der_items(raw: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of the items that fill raw from end to end; None if a length doesn't fit."""
    out, at = [], 0
    while at < len(raw):
        if at + 2 > len(raw):
            return None
        tag, n = raw[at], raw[at + 1]
        at += 2
        if n & 0x80:
            k = n & 0x7F
            if not 1 <= k <= 4 or at + k > len(raw) or raw[at] == 0:
                return None
            n = int.from_bytes(raw[at : at + k], "big")
            at += k
        if at + n > len(raw):
            return None
        out.append((tag, raw[at : at + n]))
        at += n
    return out


def _nested(raw: bytes, depth: int = 0) -> bool:
    items = der_items(raw)
    return items is not None and depth < 12 and all(_nested(c, depth + 1) for t, c in items if t & 0x20)


def _is_rsa(items: list[tuple[int, bytes]]) -> bool:
    return len(items) >= 9 and all(t == 0x02 for t, _ in items[:9])


def _is_curve(items: list[tuple[int, bytes]]) -> bool:
    """An elliptic key: version 1, the secret number, then its curve or public point."""
    return len(items) >= 2 and items[0] == (0x02, b"\1") and items[1][0] == 0x04 and 16 <= len(items[1][1]) <= 72 and all(t in (0xA0, 0xA1) for t, _ in items[2:])


def _wrapped(kind: bytes, raw: bytes) -> bool:
    """Whether a wrapper's octets hold the key that its object id tells of."""
    items = der_items(raw)
    if not items or len(items) != 1:
        return False
    tag, body = items[0]
    if kind in CURVES:
        return tag == 0x04 and len(body) == CURVES[kind]
    if kind == DSA:
        return tag == 0x02
    inner = der_items(body) if tag == 0x30 else None
    if inner is None or not _nested(raw):
        return False
    return _is_rsa(inner) if kind == RSA else _is_curve(inner) if kind == EC else bool(inner)


def is_der_key(raw: bytes) -> bool:
    """One SEQUENCE that fills raw, all nested lengths fit, and it holds a private key, bare, wrapped or encrypted."""
    items = der_items(raw)
    if not items or len(items) != 1 or items[0][0] != 0x30 or not _nested(raw):
        return False
    inner = der_items(items[0][1]) or []
    tags = [t for t, _ in inner]
    if _is_rsa(inner) or len(inner) >= 3 and _is_curve(inner):
        return True
    if len(inner) >= 3 and tags[:3] == [0x02, 0x30, 0x04] and len(inner[0][1]) == 1:
        kind = der_items(inner[1][1]) or []
        return bool(kind) and kind[0][0] == 0x06 and _wrapped(kind[0][1], inner[2][1])
    if tags == [0x30, 0x04]:  # an encrypted key: the scheme's object id, and whole blocks
        kind = der_items(inner[0][1]) or []
        return bool(kind) and kind[0][0] == 0x06 and len(inner[1][1]) >= 32 and len(inner[1][1]) % 8 == 0
    return False


def is_ssh_key(raw: bytes) -> bool:
    """A private SSH key: its magic, and the length-prefixed cipher, derivation and options after it."""
    if not raw.startswith(SSH):
        return False
    at = len(SSH)
    for _ in range(3):
        n = int.from_bytes(raw[at : at + 4], "big")
        if at + 4 + n > len(raw):
            return False
        at += 4 + n
    return len(raw) >= at + 8 and int.from_bytes(raw[at : at + 4], "big") >= 1


def _is_key(raw: bytes | None) -> bool:
    return bool(raw) and (is_der_key(raw) or is_ssh_key(raw))


def _decode64(s: str) -> bytes | None:
    if ("-" in s or "_" in s) and not ("+" in s or "/" in s):
        s = s.translate({45: 43, 95: 47})
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _is_pem(label: str, body: str) -> bool:
    """Whether what stands between a block's marks is a key, or says how it is encrypted and has whole blocks."""
    body = body.replace("\\r", "").replace("\\n", "\n")
    if not PEM_BODY.fullmatch(body):
        return False
    heads = dict(x.split(":", 1) for x in body.splitlines() if ":" in x)
    raw = _decode64(re.sub(r"[^A-Za-z0-9+/]", "", "".join(x for x in body.splitlines() if ":" not in x)))
    if not raw:
        return False
    how = heads.get("DEK-Info", "").strip().split(",")
    if heads.get("Proc-Type", "").replace(" ", "") == "4,ENCRYPTED" and len(how) == 2 and label != "PRIVATE KEY":
        size = 16 if how[0].startswith("AES") else 8
        return bool(re.fullmatch(r"[0-9A-Fa-f]+", how[1].strip())) and len(how[1].strip()) == 2 * size and len(raw) % size == 0 and len(raw) >= 32
    return _is_key(raw)


def pem_blocks(t: str) -> list[tuple[int, int]]:
    """Spans of the confirmed PEM blocks: a begin mark, the end mark of the same label next."""
    marks = list(PEM_LINE.finditer(t))
    return [(a.start(), b.end()) for a, b in zip(marks, marks[1:]) if a[1] == "BEGIN" and b[1] == "END" and a[2] == b[2] and _is_pem(a[2], t[a.end() : b.start()])]


def _claimed(run: str) -> int:
    """The characters of base64 that the outer length of a DER key calls for; 0 if the run begins with no such key."""
    raw = _decode64(run[:12]) or b""
    if len(raw) < 6 or raw[0] != 0x30:
        return 0
    k = raw[1] & 0x7F if raw[1] & 0x80 else 0
    n = 2 + k + (int.from_bytes(raw[2 : 2 + k], "big") if k else raw[1])
    return 0 if k > 4 else -(-4 * n // 3)


def base64_key(t: str, m: re.Match) -> int:
    """Where the key ends that begins with a run, which may go on over lines of its width; -1 if there is none."""
    run = m[0].rstrip("=")
    ssh = run.startswith(SSH64)
    claimed = _claimed(run)
    if not ssh and not claimed:
        return -1
    if ssh or claimed <= len(run):
        if _is_key(_decode64(run)) and not ssh:
            return m.end()
    parts, have, end = [run], len(run), m.end()
    while ssh or have < claimed:
        more = MORE64.match(t, end)
        if not more or len(more[1]) > len(run):
            break
        parts.append(more[1])
        have, end = have + len(more[1]), more.end()
        if len(more[1]) < len(run):
            break
    return end if _is_key(_decode64("".join(parts))) else -1


def spans(text: str | None) -> list[tuple[int, str, int]]:
    """(start, kind, end) of all secrets of the whole text, by start, then by the order of KINDS."""
    t = text or ""
    out = []
    low = t.lower()
    if any(n in low for n in NAMES):
        out += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(t) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in t:
        out += [(m.start(), "access", m.end()) for m in ACCESS.finditer(t)]
    out += [(m.start(), "hex", m.end()) for m in HEX.finditer(t)]
    if "eyJ" in t:
        out += [(m.start(), "jwt", m.end()) for m in TOKEN.finditer(t) if is_signed_token(m[0])]
    pems = pem_blocks(t) if "-----BEGIN " in t else []
    out += [(a, "pem", b) for a, b in pems]
    begins = [a for a, _ in pems]
    last = 0
    for m in RUN64.finditer(t):
        k = bisect.bisect_right(begins, m.start()) - 1
        if m.start() < last or k >= 0 and m.start() < pems[k][1]:
            continue
        end = base64_key(t, m)
        if end >= 0:
            out.append((m.start(), "base64_key", end))
            last = end
    for m in RUN16.finditer(t):
        if len(m[0]) % 2 == 0 and _is_key(bytes.fromhex(m[0])):
            out.append((m.start(), "hex_key", m.end()))
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[1]), x[2]))


def joined(found: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in found)


def redacted(text: str | None, found: list[tuple[int, str, int]], mark: str = "[SECRET]") -> str | None:
    """The text with each stretch that one or more spans cover replaced by the mark."""
    if text is None or not found:
        return text
    out, at, end = [], 0, -1
    for a, _, b in sorted(found):
        if a >= end:
            out += [text[at:a] if end < 0 else text[end:a], mark]
            at = end = b
        else:
            end = max(end, b)
    return "".join([*out, text[end:]])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, counts of the base kinds, confirmed spans, and the digest of the base spans."""
    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string"

    def run(batches):
        for b in batches:
            rows = []
            for t in b.column(1):
                found = spans(t.as_py())
                base = [x for x in found if x[1] in BASE]
                n = [sum(x[1] == k for x in base) for k in BASE]
                rows.append((*n, len(found) - len(base), hashlib.sha256(joined(base).encode()).hexdigest(), joined(found)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64() if i < 4 else pa.string()) for i, c in enumerate(cols))], ["doc_id", "n_assign", "n_access", "n_hex", "n_confirmed", "base_sha256", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with the secrets in ``text`` replaced by the mark; ``n_chars``, where there is one, counts the new text."""

    def run(batches):
        for b in batches:
            texts = [redacted(t, spans(t), mark) for t in b.column("text").to_pylist()]
            b = b.set_column(b.schema.get_field_index("text"), b.schema.field("text"), pa.array(texts, b.schema.field("text").type))
            at = b.schema.get_field_index("n_chars")
            if at >= 0:
                old = b.column(at).to_pylist()
                new = [o if t is None else len(t) for o, t in zip(old, texts, strict=True)]
                b = b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))
            yield b

    return docs.mapInArrow(run, docs.schema)
