"""Secrets in whole texts: pattern spans, and encoded candidates that are reported only once their structure holds.

The patterned kinds (``assign``, ``access``, ``hex``) are plain pattern matches. The other kinds are decoded first:

``key``      base64 (also URL-safe, wrapped in lines, with or without armour) or hexadecimal digits of a private key.
             The encoding's own lengths say where it ends; every nested length must fill its parent exactly, and the
             members must be those of an RSA (modulus = product of the primes), DSA, elliptic-curve, wrapped, encrypted
             wrapped or OpenSSH private key. Certificates and public keys are not reported. An armoured key under
             the older password scheme has no readable inside: its headers and block length are looked at.
``token``    three dotted base64 parts whose first is a JSON object that names a signature algorithm, whose second is a
             JSON object, and whose third has that algorithm's signature length.
``basic``    credentials of HTTP basic authentication: base64 of printable ``name:password``.
``checked``  access tokens that end in the CRC-32 of their random part.

Texts stay in their partition. Arrow's linear-time matcher first tells which rows of a batch can hold a kind at all;
only those are looked at in Python. Keys beyond ``KEY_BYTES`` do not exist in practice and are not followed further.

Defined results: a null or empty text has no spans; spans count code points, ends are exclusive; they are ordered by
start, then kind in the order of ``KINDS``, then end, and do not overlap within a kind; equal rows give equal results;
other columns of the input are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import binascii
import json
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.bytewords import byte_chunks
from millrace.llm.common import load, query

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "key", "token", "basic", "checked")
KEY_BYTES = 1 << 16

FOUND = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType(), False), T.StructField("start", T.LongType(), False),
            T.StructField("end", T.LongType(), False), T.StructField("detail", T.StringType(), False),
        ]
    ),
    False,
)
Span = tuple[int, int, str]

# --- encodings --------------------------------------------------------------------------------------------------

_INT, _BITS, _OCTETS, _OID, _SEQ = 0x02, 0x03, 0x04, 0x06, 0x30
_OPENSSH = b"openssh-key-v1\0"
# Object identifiers of password-based encryption begin with one of these.
_PASSWORD_SCHEMES = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def header(data: bytes, at: int, stop: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value at ``at``; None where its length is not a shortest form or leaves ``stop``."""
    if at + 2 > stop:
        return None
    tag, size, start = data[at], data[at + 1], at + 2
    if size >= 0x80:
        k = size & 0x7F
        if not 1 <= k <= 3 or start + k > stop:
            return None
        size = int.from_bytes(data[start:start + k])
        if size < 0x80 or data[start] == 0:
            return None
        start += k
    return (tag, start, start + size) if start + size <= stop else None


def members(data: bytes, start: int, stop: int, depth: int = 0) -> list[tuple[int, int, int]] | None:
    """The values that fill ``start`` to ``stop`` exactly, each constructed one filled in its turn; None otherwise."""
    found = []
    while start < stop:
        one = header(data, start, stop)
        if one is None or depth > 8:
            return None
        if one[0] & 0x20 and members(data, one[1], one[2], depth + 1) is None:
            return None
        found.append(one)
        start = one[2]
    return found


def der_key(data: bytes) -> str | None:
    """The kind of private key that ``data`` encodes from its first to its last byte."""
    root = header(data, 0, len(data))
    if root is None or root[0] != _SEQ or root[2] != len(data):
        return None
    parts = members(data, root[1], root[2])
    if not parts:
        return None
    tags = [t for t, _, _ in parts]

    def number(i: int) -> int:
        return int.from_bytes(data[parts[i][1]:parts[i][2]], signed=True)

    def first_oid(i: int) -> bytes | None:
        inner = members(data, parts[i][1], parts[i][2])
        return data[inner[0][1]:inner[0][2]] if inner and inner[0][0] == _OID else None

    size = parts[1][2] - parts[1][1] if len(parts) > 1 else 0
    if tags[:9] == [_INT] * 9 and number(0) in (0, 1):
        return "rsa" if number(1) > 1 << 500 and number(1) == number(4) * number(5) else None
    if tags == [_INT] * 6 and number(0) == 0:
        return "dsa" if number(1) > 1 << 500 and 1 < number(5) < number(2) < number(1) else None
    if tags[:2] == [_INT, _OCTETS] and number(0) == 1 and 16 <= size <= 72 and set(tags[2:]) <= {0xA0, 0xA1}:
        return "elliptic curve"
    if tags[:3] == [_INT, _SEQ, _OCTETS] and number(0) in (0, 1) and set(tags[3:]) <= {0xA0, 0xA1, 0x81} and first_oid(1):
        return "wrapped"
    if tags == [_SEQ, _OCTETS] and (first_oid(0) or b"").startswith(_PASSWORD_SCHEMES):
        return "encrypted wrapped"
    return None


def key_size(lead: bytes) -> int | None:
    """Bytes of the private key whose first ones are ``lead``; None where they do not begin one."""
    root = header(lead, 0, 1 << 24)
    if root is None or root[0] != _SEQ or root[2] > KEY_BYTES:
        return None
    if lead[root[1]:root[1] + 3] in (b"\2\1\0", b"\2\1\1"):
        return root[2]
    scheme = header(lead, root[1], root[2])
    oid = header(lead, scheme[1], scheme[2]) if scheme and scheme[0] == _SEQ and scheme[1] + 2 < len(lead) else None
    return root[2] if oid and oid[0] == _OID and lead[oid[1]:].startswith(_PASSWORD_SCHEMES) else None


def openssh_size(data: bytes) -> int | None:
    """Bytes of the OpenSSH private key that ``data`` begins with; None where its nested lengths do not hold.

    A result beyond the end of ``data`` is what must be read before more can be said.
    """
    at = len(_OPENSSH)
    if not data.startswith(_OPENSSH):
        return None

    def after(at: int) -> int:
        return at + 4 if at + 4 > len(data) else at + 4 + int.from_bytes(data[at:at + 4])

    for _ in ("cipher", "key derivation", "its options"):
        at = after(at)
        if at > len(data):
            return at
    if at + 4 > len(data):
        return at + 4
    keys = int.from_bytes(data[at:at + 4])
    if not 1 <= keys <= 16:
        return None
    at += 4
    for _ in range(keys):
        start, at = at, after(at)
        if at > len(data):
            return at
        public = data[start + 4:at]
        named = int.from_bytes(public[:4])
        if not 4 <= named <= len(public) - 4 or not public[4:4 + named].isascii():
            return None
    start, at = at, after(at)
    return at if at > len(data) or (at > start + 4 and (at - start - 4) % 8 == 0) else None


def from_base64(digits: str) -> bytes | None:
    digits = digits.replace("-", "+").replace("_", "/")
    if len(digits) % 4 == 1:
        return None
    return binascii.a2b_base64(digits + "=" * (-len(digits) % 4))


# --- candidates -------------------------------------------------------------------------------------------------

_D64 = r"A-Za-z0-9+/_\-"
_BREAK = r"[ \t]*(?:\r\n|\n|\r|\\r\\n|\\n)[ \t]*"
_KEY64 = re.compile(rf"(?<![{_D64}])(?:M[{_D64}]{{15}}|b3BlbnNzaC1rZXktdjEA)")
_RUN64 = re.compile(rf"(?:{_BREAK})?([{_D64}]+)")
_KEY16 = re.compile(r"(?<![0-9A-Fa-f])30(?::?[0-9A-Fa-f]{2}){15}")
_RUN16 = re.compile(rf"(?:{_BREAK}|:)?((?:[0-9A-Fa-f]{{2}})+)")
_LOCKED = re.compile(
    r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----\s*Proc-Type: 4,ENCRYPTED\s+DEK-Info: [A-Z0-9-]+,[0-9A-Fa-f]{16,32}\s+"
    rf"([{_D64}\s]+={{0,2}})\s*-----END \1-----"
)
_TOKEN = re.compile(r"(?<![A-Za-z0-9_\-])(e[wy][A-Za-z0-9_\-]+)\.([A-Za-z0-9_\-]+)\.([A-Za-z0-9_\-]+)")
_BASIC = re.compile(r"(?<![A-Za-z0-9])[Bb]asic\x20+([A-Za-z0-9+/]{7,}={0,2})(?![A-Za-z0-9+/=])")
_CHECKED = re.compile(r"(?<![A-Za-z0-9])(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
# Bytes of a signature by algorithm; those of RSA depend on the key.
_SIGNATURE = {
    "HS256": (32, 32), "HS384": (48, 48), "HS512": (64, 64), "ES256": (64, 64), "ES384": (96, 96), "ES512": (132, 132),
    "ES256K": (64, 64), "EdDSA": (64, 114), "RS256": (128, 2048), "RS384": (128, 2048), "RS512": (128, 2048),
    "PS256": (128, 2048), "PS384": (128, 2048), "PS512": (128, 2048),
}
_BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")


def _assign(text: str) -> Iterator[Span]:
    for m in _ASSIGN.finditer(text):
        if len(m[2]) >= 12:
            yield *m.span(), m[1].lower()


def _access(text: str) -> Iterator[Span]:
    for m in _ACCESS.finditer(text):
        if len(m[0]) >= 18:
            yield *m.span(), "access key id"


def _hex(text: str) -> Iterator[Span]:
    for m in _HEX.finditer(text):
        yield *m.span(), f"{len(m[0])} digits"


def _gather(text: str, at: int, run: re.Pattern, digits: int) -> tuple[str, list[tuple[int, int]]]:
    """At most ``digits`` digits from ``at`` on, over line breaks, and ``(digits before, place)`` of each run of them."""
    parts, places, n = [], [], 0
    while n < digits and (m := run.match(text, at)):
        places.append((n, m.start(1)))
        parts.append(m[1][:digits - n])
        n += len(parts[-1])
        at = m.end()
    return "".join(parts), places


def _place_after(places: list[tuple[int, int]], digits: int) -> int:
    before, start = max(p for p in places if p[0] < digits)
    return start + digits - before


def _key64(text: str, at: int) -> Span | None:
    lead = from_base64(_gather(text, at, _RUN64, 36)[0])
    if lead is None:
        return None
    if lead.startswith(b"openssh"):
        size, kind, read = 512, "openssh", -1
        while size is not None and read < size <= KEY_BYTES:
            wanted = (size + 2) // 3 * 4
            digits, _ = _gather(text, at, _RUN64, wanted)
            data = from_base64(digits[:len(digits) - (len(digits) % 4 == 1)])
            read, size = len(data), openssh_size(data)
            if len(digits) < wanted:
                break
        if size is None or size > read:
            return None
    else:
        size, kind = key_size(lead), None
        if size is None:
            return None
    need = (size * 4 + 2) // 3
    digits, places = _gather(text, at, _RUN64, need)
    if len(digits) < need:
        return None
    kind = kind or der_key(from_base64(digits)[:size])
    if kind is None:
        return None
    end = _place_after(places, need)
    pad = re.compile("={0,2}").match(text, end)
    return at, pad.end() if need % 4 and pad.end() - end == -need % 4 else end, f"{kind} private key"


def _key16(text: str, at: int) -> Span | None:
    size = key_size(bytes.fromhex(_gather(text, at, _RUN16, 52)[0]))
    if size is None:
        return None
    digits, places = _gather(text, at, _RUN16, 2 * size)
    kind = der_key(bytes.fromhex(digits)) if len(digits) == 2 * size else None
    return None if kind is None else (at, _place_after(places, 2 * size), f"{kind} private key")


def _locked(text: str) -> Iterator[Span]:
    for m in _LOCKED.finditer(text):
        data = from_base64("".join(m[2].rstrip("= \t\r\n").split()))
        if data and len(data) % 8 == 0:
            yield *m.span(2), "encrypted private key"


def _key(text: str) -> Iterator[Span]:
    found = list(_locked(text))
    for pattern, parse in ((_KEY64, _key64), (_KEY16, _key16)):
        at = 0
        while m := pattern.search(text, at):
            span = parse(text, m.start())
            at = m.end() if span is None else span[1]
            if span is not None:
                found.append(span)
    end = 0
    for span in sorted(found):
        if span[0] >= end:
            yield span
            end = span[1]


def _json_object(digits: str) -> dict | None:
    data = from_base64(digits)
    try:
        value = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _token(text: str) -> Iterator[Span]:
    for m in _TOKEN.finditer(text):
        head = _json_object(m[1])
        low, high = _SIGNATURE.get(str((head or {}).get("alg")), (1, 0))
        signature = from_base64(m[3])
        if signature and low <= len(signature) <= high and _json_object(m[2]) is not None:
            yield *m.span(), f"signed with {head['alg']}"


def _basic(text: str) -> Iterator[Span]:
    for m in _BASIC.finditer(text):
        data = from_base64(m[1].rstrip("=")) if len(m[1]) % 4 == 0 else None
        try:
            name, colon, password = (data or b"").decode("utf-8").partition(":")
        except UnicodeDecodeError:
            continue
        if name and colon and password and (name + password).isprintable():
            yield *m.span(1), "name and password"


def _checked(text: str) -> Iterator[Span]:
    for m in _CHECKED.finditer(text):
        n, sign = zlib.crc32(m[1].encode()), ""
        while n:
            n, k = divmod(n, 62)
            sign = _BASE62[k] + sign
        if sign.rjust(6, "0") == m[2]:
            yield *m.span(), "checksum holds"


_FINDERS = dict(zip(KINDS, (_assign, _access, _hex, _key, _token, _basic, _checked)))
# What a row must match to hold a kind, in the dialect of Arrow's matcher; it may match more.
_FILTERS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]""",
    "access": "AKIA[A-Z0-9]{14}",
    "hex": "[0-9a-f]{16}",
    "key": f"M[{_D64}]{{15}}|b3BlbnNzaC1rZXktdjEA|30(?::?[0-9A-Fa-f]{{2}}){{15}}|Proc-Type: 4,ENCRYPTED",
    "token": r"e[wy][A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]",
    "basic": r"[Bb]asic\x20+[A-Za-z0-9+/]{7}",
    "checked": "(?:gh[pousr]|npm)_[A-Za-z0-9]{36}",
}


def spans_of(texts: pa.Array) -> list[list[tuple[str, int, int, str]]]:
    """``(kind, start, end, detail)`` of each text, in order."""
    found: list[list] = [[] for _ in range(len(texts))]
    for order, kind in enumerate(KINDS):
        for i in pc.indices_nonzero(pc.match_substring_regex(texts, _FILTERS[kind])).to_pylist():
            found[i] += [(start, order, end, detail) for start, end, detail in _FINDERS[kind](texts[i].as_py())]
    return [[(KINDS[order], start, end, detail) for start, order, end, detail in sorted(own)] for own in found]


def find_secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, found)``, one row per row of ``docs``; ``found`` lists kind, start, end and detail."""
    fields = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("detail", pa.string())])

    def work(batches):
        for batch in batches:
            texts = batch.column(1).fill_null("").cast(pa.large_string())
            for i, j, _, _ in byte_chunks(batch.column(1)):
                own = [[dict(zip(("kind", "start", "end", "detail"), s)) for s in spans] for spans in spans_of(texts[i:j])]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], pa.array(own, pa.list_(fields))], ["doc_id", "found"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("found", FOUND, False)])
    return docs.select(docs["doc_id"].alias("doc_id"), docs["text"].cast("string").alias("text")).mapInArrow(work, schema)


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint")


@query("op12_secret_scan")
def op12_secret_scan(spark, sf_dir):
    found = F.col("found")
    return find_secrets(load(spark, sf_dir, "documents")).select(
        "doc_id", *[_count(found, k).alias(f"n_{k}") for k in BASE],
        F.sha2(_listed(F.filter(found, lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        _listed(found).alias("spans"),
    )
