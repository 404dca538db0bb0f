"""Secret scan: patterns by kind, and structural confirmation of encoded candidates.

Base kinds are plain patterns. The further kinds are reported only when their
structure holds: base64 or hexadecimal text must decode, key encodings must
parse with nested lengths that add up, and a signed token needs a header
object that names its algorithm.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tablelab.llm.common import mapped, pick, texts_of

# The base kinds in their order, with the length that a match must reach.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

#: All kinds in the order that breaks ties of the start.
KINDS = ("assign", "access", "hex", "pem", "der_base64", "ssh_base64", "der_hex", "jwt", "pem_base64", "ssh_hex", "pem_hex")

PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----([A-Za-z0-9+/=\s:,\x00-]*?)-----END \1-----")
#: Escapes of JSON and shells, once or several times over. Those of line ends become line ends, others the sign behind NULs.
ESCAPED = re.compile(r"(?<!\\)\\++(?:[rnt/]|u00(?:0[9aAdD]|2[bBfF]|3[dD]))")
#: Runs of one alphabet that go on over line ends. Their joined length must reach LEAST_RUN.
BASE64_RUN = re.compile(r"[A-Za-z0-9+/\x00]{16,}(?:[ \t]*[\r\n]+[ \t]*[A-Za-z0-9+/\x00]+)*(?:\x00*=){0,2}")
HEX_RUN = re.compile(r"[0-9A-Fa-f]{16,}(?:[ \t]*[\r\n]+[ \t]*[0-9A-Fa-f]+)*")
LEAST_RUN = {"base64": 40, "hex": 48}
JWT = re.compile(r"[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")
#: A brace and what may follow it, in base64, not within a word.
JWT_START = re.compile(r"(?<![A-Za-z0-9])e[yw](?=[A-Za-z0-9_-]{8})")
JSON_START = re.compile(rb"\{\s*(?:\"|$)")

_HEX_BYTES = bytes(120 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
_RUN_BYTES = bytes(120 if chr(b).isalnum() and b < 128 or chr(b) in "+/\0" else 32 for b in range(256))
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def _tlv(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value at ``at``; None unless it lies within ``end`` with a minimal length."""
    if at + 2 > end:
        return None
    tag, first = data[at], data[at + 1]
    at += 2
    if first < 0x80:
        size = first
    else:
        width = first & 0x7F
        if not 1 <= width <= 4 or at + width > end or data[at] == 0:
            return None
        size = int.from_bytes(data[at : at + width], "big")
        at += width
        if size < 0x80:
            return None
    return (tag, at, at + size) if at + size <= end else None


def _children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    out = []
    while start < end:
        found = _tlv(data, start, end)
        if found is None:
            return None
        out.append(found)
        start = found[2]
    return out


def der_key(data: bytes) -> str | None:
    """Kind of private key when the bytes are exactly one DER structure of that kind."""
    top = _tlv(data, 0, len(data))
    if top is None or top[0] != 0x30 or top[2] != len(data):
        return None
    parts = _children(data, top[1], top[2])
    if not parts or len(parts) < 2:
        return None
    tags = [p[0] for p in parts]
    if tags[0] == 0x30 and tags[1] == 0x04 and len(tags) == 2:
        inner = _children(data, parts[0][1], parts[0][2])
        return "pkcs8_encrypted" if inner and inner[0][0] == 0x06 else None
    if tags[0] != 0x02 or parts[0][2] - parts[0][1] != 1:
        return None
    version = data[parts[0][1]]
    if len(tags) >= 9 and tags[:9] == [0x02] * 9 and version <= 1:
        return "rsa"
    if len(tags) == 6 and tags == [0x02] * 6 and version == 0:
        return "dsa"
    if version <= 1 and len(tags) >= 3 and tags[1:3] == [0x30, 0x04]:
        inner = _children(data, parts[1][1], parts[1][2])
        return "pkcs8" if inner and inner[0][0] == 0x06 else None
    if version == 1 and tags[1] == 0x04 and all(t in (0xA0, 0xA1) for t in tags[2:]):
        return "ec"
    return None


_MAGIC = b"openssh-key-v1\x00"


def ssh_end(data: bytes, start: int = 0) -> int | None:
    """End of the OpenSSH private key at ``start``: magic word, then length-prefixed strings within the data."""
    if not data.startswith(_MAGIC, start):
        return None
    at = start + len(_MAGIC)
    for _ in range(3):
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    if at + 4 > len(data):
        return None
    keys, at = int.from_bytes(data[at : at + 4], "big"), at + 4
    if not 1 <= keys <= 16:
        return None
    for _ in range(keys + 1):
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return at if at <= len(data) else None


def ssh_key(data: bytes) -> bool:
    return ssh_end(data) is not None


def signed_token(text: str) -> bool:
    """Header and payload decode to JSON objects and the header names an algorithm."""
    head, body, sign = text.split(".")
    try:
        parts = [json.loads(base64.urlsafe_b64decode(x + "=" * (-len(x) % 4))) for x in (head, body)]
        base64.urlsafe_b64decode(sign + "=" * (-len(sign) % 4))
    except (ValueError, binascii.Error, RecursionError):
        return False
    return all(isinstance(p, dict) for p in parts) and isinstance(parts[0].get("alg"), str) and (bool(sign) or parts[0]["alg"] == "none")


def token_spans(text: str) -> list[tuple[int, int]]:
    """Signed tokens, sought at every place where a header may start, also behind ``session_`` or ``auth.``."""
    out, end = [], 0
    for start in JWT_START.finditer(text):
        at = start.start()
        if at < end or not JSON_START.match(base64.urlsafe_b64decode(text[at : at + 8])):
            continue
        found = JWT.match(text, at)
        if found and signed_token(found[0]):
            out.append(found.span())
            end = found.end()
    return out


def _decoded(text: str) -> bytes | None:
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (ValueError, binascii.Error):
        return None


def base_spans(text: str, raw: bytes) -> list[tuple[int, int, str]]:
    out = []
    low = raw.translate(_LOWER)
    if any(w in low for w in _WORDS):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if b"AKIA" in raw:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    if b"x" * HEX_LEAST in raw.translate(_HEX_BYTES):
        out += [(*m.span(), "hex") for m in HEX.finditer(text) if len(m[0]) >= HEX_LEAST]
    return out


def unescaped(text: str) -> str:
    """The text, in its length, with escaped line ends as line ends and other escaped signs behind NULs."""

    def sign(m: re.Match) -> str:
        mark = m[0].lstrip("\\").lower()
        plain = {"/": "/", "u002b": "+", "u002f": "/", "u003d": "="}.get(mark)
        return "\n" * len(m[0]) if plain is None else "\0" * (len(m[0]) - 1) + plain

    return ESCAPED.sub(sign, text) if "\\" in text else text


def pem_spans(text: str) -> list[tuple[int, int]]:
    out = []
    for m in PEM.finditer(text):
        body = "".join(line for line in m[2].split("\n") if ":" not in line)
        data = _decoded(re.sub(r"[\s\0]", "", body))
        if data and (der_key(data) or ssh_key(data) or "Proc-Type" in m[2]):
            out.append(m.span())
    return out


def run_spans(run: re.Match, code: str) -> list[tuple[int, int, str]]:
    """Private keys in a run of base64 or hexadecimal text, its lines joined.

    A DER structure ends where a line of the run ends; OpenSSH keys and PEM
    text are looked for in the decoded bytes from each possible first character.
    """
    # ``unit`` characters hold ``size`` bytes.
    unit, size, alphabet = (4, 3, r"[A-Za-z0-9+/]+") if code == "base64" else (2, 1, r"[0-9A-Fa-f]+")
    pieces = [(m.start() + run.start(), m[0]) for m in re.finditer(alphabet, run[0])]
    joined = "".join(p for _, p in pieces)
    if len(joined) < LEAST_RUN[code]:
        return []
    lows = [0, *accumulate(len(p) for _, p in pieces)]
    ends = set(lows)

    def decoded(shift: int) -> bytes:
        rest = (len(joined) - shift) % unit
        if code == "hex":
            return bytes.fromhex(joined[shift : len(joined) - rest])
        part = joined[shift:] if rest != 1 else joined[shift:-1]
        return base64.b64decode(part + "=" * (-len(part) % 4))

    data = [decoded(shift) for shift in range(unit)]

    def span(low: int, high: int, kind: str) -> tuple[int, int, str]:
        k, j = bisect_right(lows, low) - 1, bisect_right(lows, high - 1) - 1
        end = run.end() if high == len(joined) else pieces[j][0] + high - lows[j]
        return pieces[k][0] + low - lows[k], end, f"{kind}_{code}"

    out, last = [], 0
    for m in re.finditer("M" if code == "base64" else "(?=30)", joined):
        low = m.start()
        shift, at = low % unit, low // unit * size
        top = _tlv(data[shift][at : at + 6], 0, 1 << 40) if low >= last and len(joined) - low >= LEAST_RUN[code] else None
        if top is None or top[0] != 0x30:
            continue
        high = low - (-top[2] * unit // size)
        if high in ends and high - low >= LEAST_RUN[code] and der_key(data[shift][at : at + top[2]]):
            out.append(span(low, high, "der"))
            last = high
    for shift, own in enumerate(data):
        at = own.find(_MAGIC)
        while at >= 0:
            if end := ssh_end(own, at):
                out.append(span(shift + at * unit // size, min(len(joined), shift - (-end * unit // size)), "ssh"))
            at = own.find(_MAGIC, at + 1)
        if b"PRIVATE KEY-----" in own:
            text = unescaped(own.decode("latin-1"))
            out += [span(shift + low * unit // size, min(len(joined), shift - (-high * unit // size)), "pem") for low, high in pem_spans(text)]
    return out


def structural_spans(text: str, raw: bytes) -> list[tuple[int, int, str]]:
    out = []
    plain = unescaped(text)
    if b"-----BEGIN " in raw:
        out += [(*s, "pem") for s in pem_spans(plain)]
    if b"x" * 16 in (raw if plain is text else plain.encode("utf-8", "surrogatepass")).translate(_RUN_BYTES):
        for code, runs in (("base64", BASE64_RUN), ("hex", HEX_RUN)):
            for m in runs.finditer(plain):
                out += run_spans(m, code)
    if b"ey" in raw or b"ew" in raw:
        out += [(*s, "jwt") for s in token_spans(text)]
    return list(dict.fromkeys(out))


def spans_of(text: str) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind), end exclusive, in code points, by start and then kind as listed."""
    raw = text.encode("utf-8", "surrogatepass")
    found = base_spans(text, raw) + structural_spans(text, raw)
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, and ``found`` as structs.

    Null and empty texts have no spans (``base_sha256`` is then that of the
    empty string). Every row gets a row, repeated ones too. Base matches are
    leftmost and do not overlap within a kind; a match below its kind's length
    is dropped after matching. Structural spans may overlap base ones.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())])
    counts = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS[:3]]
    schema = T.StructType([rows.schema["doc_id"], *counts, T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("found", T.ArrayType(span))])

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = [spans_of(t) for t in texts_of(batch)]
        base = [[s for s in x if s[2] in KINDS[:3]] for x in spans]
        found = pa.array(
            [[{"start": a, "end": b, "kind": k} for a, b, k in x] for x in spans],
            pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())])),
        )
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id")]
            + [pa.array([sum(s[2] == k for s in x) for x in base], pa.int64()) for k in KINDS[:3]]
            + [pa.array([hashlib.sha256(_joined(x).encode()).hexdigest() for x in base]), pa.array(map(_joined, spans), pa.string()), found],
            names=schema.names,
        )

    return mapped(rows, step, schema)


def redacted(text: str, mark: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones as one, replaced by ``mark``."""
    out, last = [], 0
    merged: list[list[int]] = []
    for start, end, _ in spans_of(text):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        out += [text[last:start], mark]
        last = end
    return "".join([*out, text[last:]])


def redact_secrets(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with secrets replaced in ``text``; ``n_chars`` follows changed texts only."""
    names = docs.columns
    rows = docs.toDF(*[f"_{i}" for i in range(len(names))])
    at, size_at = names.index(text), names.index(n_chars) if n_chars in names else None

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(batch.columns)
        old = batch.column(at).to_pylist()
        new = [None if t is None else redacted(t) for t in old]
        columns[at] = pa.array(new, pa.string())
        if size_at is not None:
            sizes = [n if a == b else len(b) for n, a, b in zip(batch.column(size_at).to_pylist(), old, new)]
            columns[size_at] = pa.array(sizes, batch.column(size_at).type)
        return pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return mapped(rows, step, rows.schema, f"_{at}").toDF(*names)
