"""Secret scans with structural confirmation (operator 6).

Base patterns report assignments, access keys and long hex strings.  Beyond
them, base64 and hex candidates are decoded, and reported only when the bytes
confirm: a nested tag-length-value structure that adds up (keys and
certificates), length-prefixed key fields, an armoured block around such
bytes, or a signed token whose header parses and names an algorithm.

Defined cases: a null text counts as empty and has no spans; text of any
length is scanned whole; rows repeat as they are; an empty table gives an empty
result; other columns are ignored.  Spans are code points, end exclusive.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from windrose.llm.common import prepare, texts

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "armor", "der", "wire", "token")   # order of spans with the same start

# patterns of the base kinds (fixed values)
_ASSIGN = re.compile(r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")   # the maximal runs of 24 and more
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

# candidates that are decoded
_ARMOR = re.compile(r"-----BEGIN ([A-Z0-9 ]+)-----([A-Za-z0-9+/=\s]+)-----END \1-----")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/]{40,}|[A-Za-z0-9_-]{40,})={0,2}")
_HEX_ANY = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{40,}|[0-9A-F]{40,})(?![0-9A-Za-z])")
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")

# texts without any of these have no span of the kind (linear-time prefilters)
_MAY = {"assign": r"(?i:password|passwd|secret|token|api_?key)[\"']? *[:=]", "access": r"AKIA[A-Z0-9]{16}",
        "hex": r"[0-9a-f]{24}", "armor": r"-----BEGIN ",
        "blob": r"[A-Za-z0-9+/_-]{40}", "token": r"[A-Za-z0-9_-]{8}\.[A-Za-z0-9_-]{2,}\."}
# algorithms of signed tokens (fixed values)
_ALGORITHMS = {"none", "HS256", "HS384", "HS512", "RS256", "RS384", "RS512", "ES256", "ES256K", "ES384", "ES512",
               "PS256", "PS384", "PS512", "EdDSA", "dir", "RSA-OAEP", "RSA-OAEP-256", "A128KW", "A256KW", "ECDH-ES"}
# names that open a length-prefixed key (fixed values)
_WIRE_NAMES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-nistp256", b"ecdsa-sha2-nistp384",
               b"ecdsa-sha2-nistp521")
_WIRE_MAGIC = b"openssh-key-v1\x00"


def tlv_end(data: bytes, at: int, stop: int, depth: int = 0) -> int:
    """End of the tag-length-value element at ``at``, or -1 when its lengths, or
    those nested in it, do not add up."""
    if depth > 32 or at + 2 > stop:
        return -1
    tag, size = data[at], data[at + 1]
    at += 2
    if size & 0x80:
        wide = size & 0x7F
        if not 1 <= wide <= 4 or at + wide > stop or data[at] == 0:
            return -1
        size = int.from_bytes(data[at:at + wide], "big")
        if size < 0x80:
            return -1
        at += wide
    end = at + size
    if end > stop:
        return -1
    if tag & 0x20:               # constructed: its elements fill it exactly
        while at < end:
            at = tlv_end(data, at, end, depth + 1)
            if at < 0:
                return -1
    elif tag == 0x02 and size == 0:
        return -1
    return end


def is_der(data: bytes) -> bool:
    """One sequence over all bytes that holds at least an integer or an object
    identifier, its nested lengths adding up."""
    if len(data) < 24 or data[0] != 0x30 or tlv_end(data, 0, len(data)) != len(data):
        return False
    at = 2 + (data[1] & 0x7F if data[1] & 0x80 else 0)
    return data[at] in (0x02, 0x06, 0x30)


def is_wire(data: bytes) -> bool:
    """Length-prefixed fields that fill the data, the first a key type's name."""
    if data.startswith(_WIRE_MAGIC):
        return len(data) > len(_WIRE_MAGIC) + 4
    fields, at = [], 0
    while at + 4 <= len(data):
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data):
            return False
        fields.append(data[at + 4:at + 4 + size])
        at += 4 + size
    return at == len(data) and len(fields) >= 2 and fields[0] in _WIRE_NAMES


def unbase64(text: str) -> bytes | None:
    """Decoded text of either alphabet, padded as needed; None when it cannot be."""
    body = "".join(text.split()).rstrip("=").translate({0x2D: "+", 0x5F: "/"})
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def confirmed_kind(data: bytes | None) -> str | None:
    if data:
        if is_der(data):
            return "der"
        if is_wire(data):
            return "wire"
    return None


def is_token(header: str, payload: str) -> bool:
    """The header is a JSON object that names a known algorithm and the payload decodes."""
    first = unbase64(header)
    try:
        parsed = json.loads(first or b"")
    except ValueError:
        return False
    if not isinstance(parsed, dict) or not isinstance(parsed.get("alg"), str):
        return False
    return parsed["alg"] in _ALGORITHMS and unbase64(payload) is not None


def base_spans(text: str, may=lambda kind: True) -> list[tuple[str, int, int]]:
    out = []
    if may("assign"):
        out += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= ASSIGN_LEAST]
    if may("access"):
        out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    if may("hex"):
        out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def confirmed_spans(text: str, may=lambda kind: True) -> list[tuple[str, int, int]]:
    """Spans of decoded and parsed candidates, whether or not a base span overlaps."""
    out = []
    if may("armor"):
        for m in _ARMOR.finditer(text):
            if "KEY" in m[1] and confirmed_kind(unbase64(m[2])):
                out.append(("armor", *m.span()))
    if may("token"):
        out += [("token", *m.span()) for m in _TOKEN.finditer(text) if is_token(m[1], m[2])]
    if may("blob"):
        for m in _BASE64.finditer(text):
            kind = confirmed_kind(unbase64(m[0]))
            if kind:
                out.append((kind, *m.span()))
        for m in _HEX_ANY.finditer(text):
            if (m.end() - m.start()) % 2 == 0:
                kind = confirmed_kind(bytes.fromhex(m[0]))
                if kind:
                    out.append((kind, *m.span()))
    return out


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def line(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in spans)


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base array<struct<kind,start,end>>, spans the same with the confirmed
    ones): narrow, one pass, no shuffle."""
    prepare(docs.sparkSession)
    base = texts(docs, id_col, text_col)

    def run(batches):
        for b in batches:
            column = b.column(1)
            may = {k: pc.match_substring_regex(column, p).to_pylist() for k, p in _MAY.items()}
            own, every = [], []
            for i in range(b.num_rows):
                if any(may[k][i] for k in may):
                    text = column[i].as_py()
                    allowed = lambda kind, i=i: may[kind][i]
                    found = base_spans(text, allowed)
                    own.append(ordered(found))
                    every.append(ordered(found + confirmed_spans(text, allowed)))
                else:
                    own.append([])
                    every.append([])
            as_rows = lambda spans: pa.array(
                [[{"kind": k, "start": a, "end": z} for k, a, z in s] for s in spans], _SPAN)
            yield pa.RecordBatch.from_arrays([b.column(0), as_rows(own), as_rows(every)], ["doc_id", "base", "spans"])

    kind = base.schema["doc_id"].dataType.simpleString()
    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    return base.mapInArrow(run, f"doc_id {kind}, base {span}, spans {span}")
