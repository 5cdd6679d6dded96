"""Secret scan with structural confirmation.

Three plain patterns report by their spelling.  Everything else is only a
candidate: base64 and hexadecimal runs are decoded and reported when the bytes
parse as a private key (ASN.1 with nested lengths that fill their parents down to the
key itself, or the OpenSSH container), and dotted tokens when header and claims decode to
JSON objects, the header names a signature algorithm and a signature follows.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafline.llm.common import bounded_batches, without

BASE_KINDS = ("assign", "access", "hex")
KINDS = BASE_KINDS + ("private_key", "signed_token")
ASSIGN_LENGTH = 12
ACCESS_LENGTH = 18
HEX_LENGTH = 16
# Shortest run that can hold an encoded key: an Ed25519 key takes 48 bytes.
KEY_RUN = 60
PLACEHOLDER = "[secret]"
URL_SAFE = str.maketrans("-_", "+/")
OPENSSH_TEXT = "b3BlbnNzaC1rZXktdjEA"

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LENGTH)
RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % KEY_RUN)
ARMOR = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY-----([A-Za-z0-9+/=\s]+)-----END [A-Z0-9 ]{0,40}PRIVATE KEY-----")
DOTTED = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]+)\.([A-Za-z0-9_-]*)")
# Lines of base64 as encoders break them, without armour.
WRAPPED = re.compile(r"(?m)(?:^[A-Za-z0-9+/]{40,76}\r?\n)+[A-Za-z0-9+/]{1,76}={0,2}(?=\r?$)")

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType(), False),
        T.StructField("start", T.IntegerType(), False),
        T.StructField("end", T.IntegerType(), False),
        T.StructField("structure", T.StringType()),
    ]
)

# ASN.1 tags, and algorithms as the bytes of their object identifiers.
INTEGER, OCTETS, OBJECT_ID, SEQUENCE = 0x02, 0x04, 0x06, 0x30
RSA = ("2a864886f70d010101", "2a864886f70d01010a")
EC = "2a8648ce3d0201"
DSA = "2a8648ce380401"
# X25519, X448, Ed25519 and Ed448 with the bytes of their private keys.
CURVES = {"2b656e": 32, "2b656f": 56, "2b6570": 32, "2b6571": 57}
PASSWORD_BASED = ("2a864886f70d0105", "2a864886f70d010c01")
# Bytes of the smallest modulus that counts as one.
LEAST_MODULUS = 32


def children(data, start, end):
    """(tag, from, to) of the values that fill ``start:end`` exactly, else None."""
    found, at = [], start
    while at < end:
        if at + 2 > end:
            return None
        tag, length = data[at], data[at + 1]
        at += 2
        if length & 0x80:
            width = length & 0x7F
            if not 1 <= width <= 4 or at + width > end:
                return None
            length = int.from_bytes(data[at : at + width], "big")
            at += width
        if at + length > end:
            return None
        found.append((tag, at, at + length))
        at += length
    return found


def number(data, part):
    return int.from_bytes(data[part[1] : part[2]], "big")


def rsa_key(data, parts):
    """Version, then modulus, exponents, primes and what follows from them, none longer than the modulus."""
    if len(parts) not in (9, 10) or any(p[0] != INTEGER for p in parts[:9]):
        return False
    sizes = [p[2] - p[1] for p in parts]
    # Only keys of several primes, which are version 1, list the others in a tenth field.
    whole = number(data, parts[0]) == len(parts) - 9 and (len(parts) == 9 or parts[9][0] == SEQUENCE)
    return whole and sizes[1] >= LEAST_MODULUS and min(sizes) > 0 and max(sizes[2:9]) <= sizes[1]


def dsa_key(data, parts):
    """Version, p, q, g and a public key that belongs to the private one."""
    if len(parts) != 6 or any(p[0] != INTEGER or p[1] == p[2] for p in parts):
        return False
    version, p, q, g, y, x = (number(data, part) for part in parts)
    fits = version == 0 and 1024 <= p.bit_length() <= 4096 and 160 <= q.bit_length() <= 256 and 0 < x < q and 1 < g < p
    return fits and pow(g, x, p) == y


def ec_key(data, parts):
    """Version 1, a private number of a curve's size, and at most its curve and public point."""
    tags = [p[0] for p in parts]
    sized = len(tags) >= 2 and 16 <= parts[1][2] - parts[1][1] <= 72
    return tags[:2] == [INTEGER, OCTETS] and sized and number(data, parts[0]) == 1 and tags[2:] in ([], [0xA0], [0xA1], [0xA0, 0xA1])


def inner_key(data, kind, part):
    """Whether the octets of a key without armour are a key of the kind its algorithm names."""
    start, end = part[1], part[2]
    inner = children(data, start, end)
    if not inner or len(inner) != 1:
        return False
    tag, low, high = inner[0]
    if kind in CURVES:
        return tag == OCTETS and high - low == CURVES[kind]
    if kind == DSA:
        return tag == INTEGER and 0 < high - low <= 64
    fields = children(data, low, high) if tag == SEQUENCE else None
    return bool(fields) and (kind in RSA and rsa_key(data, fields) or kind == EC and ec_key(data, fields))


def asn1_key(data):
    """Name of the private-key encoding the bytes are, else None."""
    if data[:1] != b"\x30":
        return None
    outer = children(data, 0, len(data))
    if not outer or len(outer) != 1:
        return None
    parts = children(data, outer[0][1], outer[0][2])
    if not parts:
        return None
    tags = [p[0] for p in parts]

    def algorithm(part):
        fields = children(data, part[1], part[2])
        return data[fields[0][1] : fields[0][2]].hex() if fields and fields[0][0] == OBJECT_ID else None

    if rsa_key(data, parts):
        return "rsa"
    if dsa_key(data, parts):
        return "dsa"
    if ec_key(data, parts):
        return "ec"
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS] and number(data, parts[0]) in (0, 1) and tags[3:] in ([], [0xA0], [0xA1], [0x81], [0xA0, 0x81]):
        return "pkcs8" if inner_key(data, algorithm(parts[1]), parts[2]) else None
    if tags == [SEQUENCE, OCTETS] and (algorithm(parts[0]) or "").startswith(PASSWORD_BASED):
        size = parts[1][2] - parts[1][1]
        return "pkcs8-encrypted" if size >= 32 and size % 8 == 0 else None
    return None


def openssh_key(data):
    """``openssh`` when the container's length-prefixed fields fit, else None."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic):
        return None
    at, fields = len(magic), 0
    while fields < 3:  # cipher, key derivation, its options
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at : at + 4], "big")
        fields += 1
    if at + 4 > len(data):
        return None
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    for _ in range(min(keys, 64) + 1):  # public keys, then the private part
        if at + 4 > len(data):
            return None
        at += 4 + int.from_bytes(data[at : at + 4], "big")
    return "openssh" if keys and at <= len(data) else None


def decoded(run):
    """Bytes of a hexadecimal, base64 or base64url run; None when it is neither."""
    body = run.rstrip("=")
    if len(body) % 2 == 0 and re.fullmatch(r"[0-9a-fA-F]+", body):
        return bytes.fromhex(body)
    try:
        return base64.b64decode(body.translate(URL_SAFE) + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def key_structure(run):
    # In every text form of these encodings the first byte is fixed: "0" or "o".
    if run[0] not in "Mb36":
        return None
    data = decoded(run)
    return data and (asn1_key(data) or openssh_key(data))


def claimed_bytes(head):
    """Number of bytes the outer ASN.1 value that base64 text begins with says it has, else None."""
    try:
        data = base64.b64decode(head[:8].translate(URL_SAFE), validate=True)
    except (binascii.Error, ValueError):
        return None
    if len(data) < 6 or data[0] != SEQUENCE:
        return None
    if data[1] < 0x80:
        return 2 + data[1]
    width = data[1] & 0x7F
    return 2 + width + int.from_bytes(data[2 : 2 + width], "big") if 1 <= width <= 4 else None


def key_in_run(run):
    """(offset, structure) of the key a run ends with: all of it, or what follows a ``/``.

    A place after a ``/`` is decoded only if its first bytes claim exactly the bytes that
    are left, so a run is decoded a bounded number of times whatever it holds.
    """
    kind = key_structure(run)
    if kind:
        return 0, kind
    body, at = run.rstrip("="), run.find("/") + 1
    while 0 < at <= len(body) - KEY_RUN:
        left = len(body) - at
        last = body.find("/", at) < 0
        if body[at] == "M" and claimed_bytes(body[at : at + 8]) == left * 3 // 4 or last and body.startswith("308", at):
            kind = key_structure(run[at:])
        elif body.startswith(OPENSSH_TEXT, at):
            kind = key_structure(run[at:])
        if kind:
            return at, kind
        at = run.find("/", at) + 1
    return None


def wrapped_keys(block, offset):
    """Keys among lines of equal width: each starts at a line and has the lines its length asks for."""
    lines = [(m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9+/=]+", block)]
    i = 0
    while i < len(lines):
        start, end = lines[i]
        width, kind, used = end - start, None, 1
        size = claimed_bytes(block[start:end]) if block[start] == "M" else None
        if size is not None and width >= 40:
            used = -(-(-(-size // 3) * 4) // width)
            own = lines[i : i + used]
            if len(own) == used > 1 and all(b - a == width for a, b in own[:-1]) and own[-1][1] - own[-1][0] <= width:
                kind = key_structure("".join(block[a:b] for a, b in own))
        if kind:
            yield "private_key", offset + start, offset + lines[i + used - 1][1], kind
        i += used if kind else 1


def signature(part):
    """Bytes of a token's last part; empty when it is none."""
    try:
        return base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))
    except (binascii.Error, ValueError):
        return b""


def json_object(part):
    try:
        value = json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4)))
    except (binascii.Error, ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def scan(text):
    """All spans of one text in the order of their start, then kind."""
    found = []
    if not text:
        return found
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= ASSIGN_LENGTH:
            found.append(("assign", m.start(), m.end(), key_structure(m[2])))
    for m in ACCESS.finditer(text):
        if m.end() - m.start() >= ACCESS_LENGTH:
            found.append(("access", m.start(), m.end(), None))
    for m in HEX.finditer(text):
        found.append(("hex", m.start(), m.end(), None))
    for m in RUN.finditer(text):
        key = key_in_run(m[0])
        if key:
            found.append(("private_key", m.start() + key[0], m.end(), key[1]))
    for m in ARMOR.finditer(text) if "-----BEGIN " in text else ():
        data = decoded("".join(m[1].split()))
        kind = data and (asn1_key(data) or openssh_key(data))
        if kind:
            found.append(("private_key", m.start(), m.end(), kind))
    armored = [(start, end) for kind, start, end, _ in found if kind == "private_key"]
    for m in WRAPPED.finditer(text):
        for span in wrapped_keys(m[0], m.start()):
            if not any(start <= span[1] and span[2] <= end for start, end in armored):
                found.append(span)
    for m in DOTTED.finditer(text) if "eyJ" in text else ():
        header = json_object(m[1])
        name = header.get("alg") if header else None
        if isinstance(name, str) and name.lower() not in ("", "none") and json_object(m[2]) is not None and signature(m[3]):
            found.append(("signed_token", m.start(), m.end(), name))
    found.sort(key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return found


def blanked(text, spans):
    """``text`` with every run of touching spans replaced by the placeholder."""
    if not spans:
        return text
    out, at, upto = [], 0, -1
    for _, start, end, _ in spans:
        if start > upto:
            out += [text[at:start], PLACEHOLDER]
        upto = max(upto, end)
        at = upto
    return "".join([*out, text[at:]])


@F.pandas_udf(T.ArrayType(SPAN, False))
def _spans(text: pd.Series) -> pd.Series:
    names = SPAN.names
    return pd.Series([[dict(zip(names, s)) for s in scan(t)] for t in text], dtype="object")


@F.pandas_udf(T.StringType())
def _redacted(text: pd.Series) -> pd.Series:
    return pd.Series([blanked(t, scan(t)) if t else t for t in text], dtype="object")


def find_secrets(docs, text="text"):
    """``docs`` with ``secrets``: array of (kind, start, end, structure).

    Offsets are code points of the whole text, end exclusive.  ``structure`` names the
    encoding or the signature algorithm that was confirmed, and is null where a span
    is reported by spelling alone.  Null and empty texts have an empty array; bytes that are
    not UTF-8 count as replacement characters; repeated rows repeat; a column named
    ``secrets`` is replaced.  Narrow, no shuffle.
    """
    return without(bounded_batches(docs), "secrets").withColumn("secrets", _spans(F.coalesce(F.make_valid_utf8(F.col(text)), F.lit(""))))


def redact_secrets(docs, text="text"):
    """``docs`` with every secret in ``text`` replaced; all other text stays as it is.

    No row is dropped; null stays null.  Bytes that are not UTF-8 become replacement characters.
    """
    return bounded_batches(docs).withColumn(text, _redacted(F.make_valid_utf8(F.col(text))))


def _joined(spans):
    line = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(line, ",")


def _of_kind(*kinds):
    return F.filter(F.col("secrets"), lambda s: s["kind"].isin(*kinds))


def digest(found):
    """Counts per kind, the digest of the base spans, and the listing of all spans."""
    counts = {f"n_{kind}": F.size(_of_kind(kind)).cast("long") for kind in KINDS}
    base = F.sha2(_joined(_of_kind(*BASE_KINDS)).cast("binary"), 256)
    return found.withColumns({**counts, "base_sha256": base, "spans": _joined(F.col("secrets"))})
