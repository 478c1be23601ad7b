"""Secret scans with structural confirmation.

Three plain kinds are reported as they match (`assign`, `access`, `hex`). Further kinds are candidates of a loose pattern
that are reported only when what they encode holds together:

* `pem`: an armoured private key, with or without header lines, whose body decodes to DER or to an OpenSSH key; or, where headers say
  that the body is enciphered, to whole blocks of the named cipher;
* `jwt`: three base64url parts; the first decodes to a JSON object with a known `alg`, the second to a JSON object, and the
  signature has the length that the algorithm gives;
* `der`: base64 or hex that decodes to a DER private key: a SEQUENCE that fills the data, whose elements' nested lengths add
  up, shaped like PKCS#1, DSA, PKCS#8 (enciphered too) or SEC1;
* `ssh`: base64 of an OpenSSH private key: magic, cipher, key derivation, as many public keys as it counts, and a private part, whose
  nested lengths stay inside the data;
* `wrapped`: base64 or hex that decodes to printable text in which a plain kind matches, or to base64 or hex that decodes to any of these.

Offsets are in code points, end exclusive; a span is the whole match. Matches of one kind are leftmost and don't overlap; a
plain match that is too short is used up and dropped. A null text is empty. Copies and long texts need no special care: each
row is scanned whole by itself.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.columns import append_columns, free_name

#: In the order in which spans of equal start are listed.
KINDS = ("assign", "access", "hex", "pem", "jwt", "der", "ssh", "wrapped")
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )?PRIVATE KEY)-----((?:\s*[A-Za-z][A-Za-z0-9-]*:\x20[^\n]*\n)*)([A-Za-z0-9+/=\s]+)-----END \1-----")
#: Object identifiers of password-based encryption begin like this (PKCS#5 and PKCS#12).
_ENCIPHERED = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c"))
_CIPHER = re.compile(r"DEK-Info:\x20*([A-Z0-9-]+),([0-9A-Fa-f]+)")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}={0,2}")
_HEX_ANY = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])")
#: Signature bytes by algorithm; None: depends on the key.
_ALGORITHMS = {"none": 0, "HS256": 32, "HS384": 48, "HS512": 64, "RS256": None, "RS384": None, "RS512": None, "PS256": None, "PS384": None, "PS512": None, "ES256": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}

Span = tuple[str, int, int]


def plain_spans(text: str) -> list[Span]:
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


def decode_base64(text: str) -> bytes | None:
    body = "".join(text.split()).rstrip("=").translate(str.maketrans("-_", "+/"))
    if not body or len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_elements(data: bytes) -> list[tuple[int, bytes]] | None:
    """Elements (tag, content) that fill ``data`` exactly, or None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length = data[at], data[at + 1]
        at += 2
        if length & 0x80:
            more = length & 0x7F
            if not 1 <= more <= 4 or at + more > len(data):
                return None
            length = int.from_bytes(data[at : at + more], "big")
            at += more
        if at + length > len(data):
            return None
        out.append((tag, data[at : at + length]))
        at += length
    return out


def is_der_key(data: bytes) -> bool:
    """PKCS#1: version and at least eight integers. DSA: version 0 and five. PKCS#8: version, algorithm, octets; enciphered: algorithm,
    octets. SEC1: version 1, octets, [0]..."""
    outer = der_elements(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = der_elements(outer[0][1])
    if not inner:
        return False
    tags = [t for t, _ in inner]
    if tags == [0x30, 0x04]:
        algorithm = der_elements(inner[0][1])
        return bool(algorithm) and algorithm[0][0] == 0x06 and algorithm[0][1].startswith(_ENCIPHERED) and len(inner[1][1]) > 0
    if inner[0][0] != 0x02 or inner[0][1] not in (b"\x00", b"\x01"):
        return False
    if len(tags) >= 9 and tags[:9] == [0x02] * 9:
        return all(content for _, content in inner[:9])
    if tags == [0x02] * 6:
        return inner[0][1] == b"\x00" and all(len(content) >= 16 for _, content in inner[1:])
    if tags[1:3] == [0x30, 0x04]:
        algorithm = der_elements(inner[1][1])
        return bool(algorithm) and algorithm[0][0] == 0x06 and len(inner[2][1]) > 0
    return inner[0][1] == b"\x01" and len(tags) > 1 and tags[1] == 0x04 and len(inner[1][1]) >= 20


def is_ssh_key(data: bytes) -> bool:
    magic = b"openssh-key-v1\x00"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def number() -> int:
        nonlocal at
        at += 4
        return int.from_bytes(data[at - 4 : at], "big") if at <= len(data) else len(data)

    def field() -> bytes:
        nonlocal at
        size = number()
        at += size
        return data[at - size : at]

    for _ in range(3):  # cipher, key derivation, its options
        field()
    keys = number()
    if not 1 <= keys <= 64:
        return False
    for _ in range(keys):
        public = field()
        if at > len(data) or public and int.from_bytes(public[:4], "big") > len(public) - 4:
            return False
    field()
    return at <= len(data)


def is_enciphered(headers: str, body: bytes | None) -> bool:
    """Whole blocks of the cipher that the headers name, whose first block is as long as it needs."""
    cipher = _CIPHER.search(headers)
    block = 16 if cipher and "AES" in cipher[1] else 8
    return bool(cipher and body) and "ENCRYPTED" in headers and len(cipher[2]) == 2 * block and len(body) % block == 0


def holds_secret(data: bytes) -> bool:
    """Printable text with a plain secret in it."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return len(text) >= 12 and all(c.isprintable() or c in "\t\r\n" for c in text) and bool(plain_spans(text))


def is_token(head: str, body: str, signature: str) -> bool:
    parts = [decode_base64(x) for x in (head, body)]
    if None in parts:
        return False
    try:
        header, claims = (json.loads(x) for x in parts)
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(claims, dict) or not isinstance(header.get("alg"), str):
        return False
    if header["alg"] not in _ALGORITHMS:
        return False
    size = len(decode_base64(signature) or b"")
    expected = _ALGORITHMS[header["alg"]]
    return size == expected if expected is not None else size >= 128


def _kind(data: bytes | None, layers: int = 1) -> str | None:
    """What decoded bytes are. Text of one more layer of base64 or hex is decoded again, once."""
    if not data:
        return None
    if is_der_key(data):
        return "der"
    if is_ssh_key(data):
        return "ssh"
    if holds_secret(data):
        return "wrapped"
    if layers and data.isascii():
        text = data.decode().strip()
        for pattern, decode in ((_HEX_ANY, bytes_of_hex), (_BASE64, decode_base64)):
            if pattern.fullmatch(text) and _kind(decode(text), layers - 1):
                return "wrapped"
    return None


def confirmed_spans(text: str) -> list[Span]:
    found: list[Span] = []
    for m in _PEM.finditer(text) if "PRIVATE KEY" in text else ():
        body = decode_base64(m[3])
        if _kind(body, 0) in ("der", "ssh") or is_enciphered(m[2], body):
            found.append(("pem", *m.span()))
    for m in _JWT.finditer(text) if "eyJ" in text else ():
        if is_token(m[1], m[2], m[3]):
            found.append(("jwt", *m.span()))
    armour = [s for s in found if s[0] == "pem"]
    for pattern, decode in ((_BASE64, decode_base64), (_HEX_ANY, bytes_of_hex)):
        for m in pattern.finditer(text):
            if kind := _kind(decode(m[0])):
                if not any(a <= m.start() and m.end() <= b for _, a, b in armour):
                    found.append((kind, *m.span()))
    return found


def bytes_of_hex(text: str) -> bytes | None:
    return bytes.fromhex(text) if len(text) % 2 == 0 else None


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(set(spans), key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def find_secrets(docs: DataFrame, text: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with an array ``out`` of spans (kind, start, end) ordered by start, then kind; one narrow pass."""

    def work(texts: list) -> list:
        return [[_spans(t) for t in texts]]

    return append_columns(docs, [text], T.StructType([T.StructField(out, T.ArrayType(SPAN))]), work)


def _spans(body: bytes | None) -> list[dict]:
    text = (body or b"").decode("utf-8", "replace")
    spans = sorted({*plain_spans(text), *confirmed_spans(text)}, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


def mask_secrets(docs: DataFrame, text: str = "text", mark: str = "[secret]", length: str | None = None) -> DataFrame:
    """``docs`` with every span replaced by ``mark``; overlapping spans together. Null and clean texts stay as they are.

    ``length`` names a column that holds the text's characters; it follows the changed texts.
    """
    name = free_name(docs, "masked")

    def work(texts: list) -> list:
        return [[None if t is None else masked(t.decode("utf-8", "replace"), mark) for t in texts]]

    with_text = append_columns(docs, [text], T.StructType([T.StructField(name, T.StringType())]), work)
    new, old = F.col(f"`{name}`"), F.col(f"`{text}`")
    changed = {text: new}
    if length is not None:
        changed[length] = F.when(new == old, F.col(f"`{length}`")).otherwise(F.char_length(new)).cast(docs.schema[length].dataType)
        changed[length] = F.when(old.isNull(), F.col(f"`{length}`")).otherwise(changed[length])
    return with_text.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def masked(text: str, mark: str) -> str:
    spans = sorted((a, b) for _, a, b in [*plain_spans(text), *confirmed_spans(text)])
    out, at = [], 0
    for a, b in spans:
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def op7_secrets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_secrets(docs)

    def text_of(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE_KINDS))
    kinds = F.transform("secrets", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(text_of(base), 256).alias("base_sha256"), text_of(F.col("secrets")).alias("spans"))
