"""Secrets in texts: plain patterns, and keys and tokens confirmed by their structure.

Three plain kinds come from patterns alone: ``assign`` (a named value), ``access``
(an access key id) and ``hex`` (a long hexadecimal run). Two kinds are reported only
once a candidate has been decoded and its parts fit together:

``key``    base64 or hexadecimal that decodes to a private key: nested DER lengths that
           add up to the last byte with the fields of PKCS#1, PKCS#8 (encrypted or not),
           SEC 1 or DSA, or the length-prefixed fields of an OpenSSH key; base64 may be
           wrapped over lines. Armoured (PEM) text likewise, also with line breaks written
           as ``\\n``; if its header lines say that it is encrypted, it has to be whole
           blocks of the named cipher
``token``  a signed token: three base64url parts, the first two of them JSON objects,
           a named algorithm, and a signature as long as that algorithm makes
"""

from __future__ import annotations

import base64
import binascii
import json
import re
import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultwright.llm.spans import Span, counts, digest, find_spans, of_kind

BASE = ("assign", "access", "hex")
CONFIRMED = ("key", "token")
KINDS = (*BASE, *CONFIRMED)

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_NAMES = ("passw", "secret", "token", "api")
# Runs that fall short are dropped, so asking for the length at once finds the same ones.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

ARMOUR = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----((?:(?!-----)[A-Za-z0-9+/=\s\\:,-])+)-----END \1-----")
CIPHER = re.compile(r"([A-Z0-9-]+),([0-9A-Fa-f]+)")
# The first bytes of a key fix the first letters of its encoding.
KEY_TEXT = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M[A-Za-z0-9+/_-]{39,}|b3BlbnNzaC1rZXktdjE[A-Za-z0-9+/_-]{20,})={0,2}")
BROKEN_LINE = re.compile(r"\r?\n[ \t]*(?=[A-Za-z0-9+/_-])")
LINE = re.compile(r"[A-Za-z0-9+/_-]+")
KEY_HEX = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[fF]70656[eE])[0-9A-Fa-f]{40,}")
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[A-Za-z0-9_-]{9,}\.[A-Za-z0-9_-]{2,}\.[A-Za-z0-9_-]*")

# Bytes of a signature by algorithm; RSA signatures are as long as their key.
SIGNATURE_BYTES = {
    "HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": 64, "none": 0,
}
RSA_ALGORITHMS = ("RS256", "RS384", "RS512", "PS256", "PS384", "PS512")

SEQUENCE, INTEGER, OCTETS, OBJECT_ID = 0x30, 0x02, 0x04, 0x06
# Encodings that every password-based encryption scheme begins with (PKCS#5, PKCS#12).
ENCRYPTION_SCHEMES = (bytes.fromhex("2a864886f70d0105"), bytes.fromhex("2a864886f70d010c01"))


def unbase64(text: str) -> bytes | None:
    """Bytes of base64 text, in the plain or the URL alphabet, padded or not."""
    text = re.sub(r"\s+", "", text).rstrip("=").translate(str.maketrans("-_", "+/"))
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tags and contents that fill ``data`` to its last byte, or None."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length, at = data[at], data[at + 1], at + 2
        if length & 0x80:
            n = length & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            length, at = int.from_bytes(data[at : at + n], "big"), at + n
            if length < 0x80:
                return None
        if at + length > len(data):
            return None
        items.append((tag, data[at : at + length]))
        at += length
    return items


def is_der_key(data: bytes) -> bool:
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    parts = der_items(outer[0][1])
    if not parts or len(parts) < 2:
        return False
    tags, version = [tag for tag, _ in parts], int.from_bytes(parts[0][1], "big")
    if tags == [SEQUENCE, OCTETS]:
        scheme = der_items(parts[0][1])
        return bool(
            scheme and [tag for tag, _ in scheme] == [OBJECT_ID, SEQUENCE]
            and scheme[0][1].startswith(ENCRYPTION_SCHEMES) and len(parts[1][1]) >= 16)
    if tags[0] != INTEGER:
        return False
    if tags == [INTEGER] * 9:
        return version == 0 and len(parts[1][1]) >= 32
    if tags == [INTEGER] * 6:
        return version == 0 and len(parts[1][1]) >= 64
    if version == 1 and tags[1] == OCTETS and all(tag in (0xA0, 0xA1) for tag in tags[2:]):
        return 16 <= len(parts[1][1]) <= 80
    if version in (0, 1) and tags[1:3] == [SEQUENCE, OCTETS] and all(tag in (0xA0, 0xA1, 0x81) for tag in tags[3:]):
        algorithm = der_items(parts[1][1])
        inner = der_items(parts[2][1])
        return bool(algorithm and algorithm[0][0] == OBJECT_ID and inner and inner[0][0] in (SEQUENCE, OCTETS, INTEGER))
    return False


def is_openssh_key(data: bytes) -> bool:
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return False
    at = len(magic)

    def field() -> bytes | None:
        nonlocal at
        if at + 4 > len(data):
            return None
        (n,) = struct.unpack_from(">I", data, at)
        if at + 4 + n > len(data):
            return None
        at += 4 + n
        return data[at - n : at]

    if any(field() is None for _ in range(3)) or at + 4 > len(data):
        return False
    (keys,) = struct.unpack_from(">I", data, at)
    at += 4
    if not 1 <= keys <= 64 or any(field() is None for _ in range(keys)):
        return False
    private = field()
    return bool(private) and at == len(data)


def is_key(data: bytes | None) -> bool:
    return data is not None and (is_der_key(data) or is_openssh_key(data))


def is_armoured_key(body: str) -> bool:
    """Whether the text between the marks of an armoured key holds one."""
    lines = [line.strip() for line in body.replace("\\r", "\r").replace("\\n", "\n").splitlines()]
    headers = dict(line.split(":", 1) for line in lines if ":" in line)
    data = unbase64("".join(line for line in lines if ":" not in line))
    if "DEK-Info" not in headers:
        return is_key(data)
    cipher = CIPHER.fullmatch(headers["DEK-Info"].strip())
    return bool(data and cipher and "ENCRYPTED" in headers.get("Proc-Type", "")
                and len(cipher[2]) in (16, 32) and len(data) % (len(cipher[2]) // 2) == 0)


def wrapped_key(text: str, start: int, end: int) -> int | None:
    """Where a key ends whose base64 begins in the line from ``start`` to ``end`` and goes on in the next ones.

    The outer length of a DER key says how many letters it takes, so other text may follow;
    an OpenSSH key takes all lines.
    """
    need = None
    if text[start] == "M":
        head = unbase64(text[start : start + 16])
        if head is None or head[0] != SEQUENCE:
            return None
        inner = 2 + (head[1] & 0x7F if head[1] & 0x80 else 0)
        if inner > 6 or head[inner] not in (SEQUENCE, INTEGER):
            return None
        need = -(-(inner + (int.from_bytes(head[2:inner], "big") if inner > 2 else head[1])) * 4 // 3)
    lines, got = [text[start:end]], end - start
    while need is None or got < need:
        gap = BROKEN_LINE.match(text, end)
        if not gap:
            break
        line = LINE.match(text, gap.end())
        end = line.end() if need is None else min(line.end(), gap.end() + need - got)
        lines.append(text[gap.end() : end])
        got += len(lines[-1])
    if len(lines) == 1 or not is_key(unbase64("".join(lines))):
        return None
    while text[end : end + 1] == "=":
        end += 1
    return end


def is_token(text: str) -> bool:
    head, body, signature = text.split(".")
    raw = [unbase64(part) for part in (head, body, signature)]
    if None in raw:
        return False
    try:
        header, claims = json.loads(raw[0]), json.loads(raw[1])
    except (ValueError, RecursionError):
        return False
    if not isinstance(header, dict) or not isinstance(claims, dict) or not isinstance(header.get("alg"), str):
        return False
    if header["alg"] in RSA_ALGORITHMS:
        return len(raw[2]) >= 128
    return SIGNATURE_BYTES.get(header["alg"]) == len(raw[2])


def find_secrets(text: str) -> list[Span]:
    """All spans of a text by start, then kind as in ``KINDS``; code points, end exclusive."""
    spans: list[Span] = []
    low = text.lower()
    if any(name in low for name in ASSIGN_NAMES):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text)]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        spans += [("key", *m.span()) for m in ARMOUR.finditer(text) if is_armoured_key(m[2])]
    armoured = [(s, e) for kind, s, e in spans if kind == "key"]
    for m in KEY_TEXT.finditer(text):
        if any(s <= m.start() < e for s, e in armoured):
            continue
        end = m.end() if is_key(unbase64(m[0])) else wrapped_key(text, *m.span())
        if end is not None:
            spans.append(("key", m.start(), end))
    for m in KEY_HEX.finditer(text):
        if len(m[0]) % 2 == 0 and is_key(bytes.fromhex(m[0])):
            spans.append(("key", *m.span()))
    spans += [("token", *m.span()) for m in TOKEN.finditer(text) if is_token(m[0])]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def secrets(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` of every row, read as a whole.

    Null and empty texts have no spans; null ids and repeated rows stay as they are.
    Other columns are not read. Every row is done where it lies, without a shuffle.
    """
    return find_spans(docs, find_secrets)


def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[n.alias(name) for name, n in counts(spans, BASE).items()],
        F.sha2(digest(of_kind(spans, *BASE)), 256).alias("base_sha256"),
        digest(spans).alias("spans"),
        *[n.alias(name) for name, n in counts(spans, CONFIRMED).items()],
    )
