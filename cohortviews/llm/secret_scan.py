"""Secret scans with structural confirmation.

Patterns find assignments, access keys and long hex strings; these base spans are reported as they are. Runs of base64
or hex that could hold a key are decoded, and a further span is reported only if the bytes parse as what they claim:
DER whose nested lengths fill their parents exactly and which begins like a private or public key, SSH wire strings whose
lengths add up, or a signed token whose header is JSON with an algorithm. Spans count code points, the end is exclusive.

Kinds: ``assign``, ``access``, ``hex``; then ``pem`` (armoured key), ``der`` (bare base64 or hex), ``ssh``, ``jwt``.

Nulls: a null text is scanned as the empty text. Rows are independent, so repeated rows give repeated results; no rows
give no rows. A text of any length is scanned whole.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortviews.llm.common import map_texts

# The three base patterns and their least lengths, as the contract states them.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # whole runs, so the same as dropping shorter ones
HEX = re.compile(r"[0-9a-f]{24,}")  # likewise
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "pem", "der", "ssh", "jwt")

PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]{0,40}?)(PRIVATE|PUBLIC) KEY-----((?:(?!-----)[\s\S])+)-----END \1\2 KEY-----")
#: What JSON, YAML and shells write for a line break or a slash, with one backslash or more.
ESCAPED_BREAK, ESCAPED_SLASH = re.compile(r"\\+(?:[nrt]|u000[9aAdD]|(?=\s))"), re.compile(r"\\+/")
#: Where a bare run may start: behind no character of a run but '=', or behind an escaped line break.
START = r"(?:(?<![A-Za-z0-9+/_-])|(?<=\\[nrt]))"
#: DER begins with the byte 0x30, an SSH key with a four-byte length or the name of its container.
BASE64 = re.compile(START + r"(?:M[A-Za-z0-9+/_-]|AAAA|b3BlbnNzaC1r)[A-Za-z0-9+/_-]{28,}={0,2}")
#: Hex of DER, of a length-prefixed string, or of the container's name.
HEX_KEY = re.compile(r"(?<![0-9A-Fa-f])(?:30|000000|6[fF]70656[eE]7373682[dD])(?:[0-9A-Fa-f]{2}){15,}(?![0-9A-Fa-f])")
#: The first part begins like '{' or like white space before it; the others are looked at, not taken, as either may be
#: the first part of another token.
JWT = re.compile(r"(?:(?<![A-Za-z0-9_-])|(?<=\\[nrt]))[eICD][A-Za-z0-9_-]++\.(?=([A-Za-z0-9_-]+\.[A-Za-z0-9_-]*))")
#: Headers of an armour, each with the lines that continue it, and what they say of an encrypted body.
HEADERS = re.compile(r"\s*(?:[A-Za-z][A-Za-z0-9-]*:[^\n]*(?:\n[ \t]+[^\n]+)*(?:\n|$))+")
ENCRYPTED = re.compile(r"DEK-Info:\s*[A-Z0-9-]+,\s*((?:[0-9A-Fa-f]{2}){8,16})\s*$", re.MULTILINE)
SSH_NAMES = (b"ssh-", b"ecdsa-sha2-", b"sk-ssh-", b"sk-ecdsa-")
SSH_CONTAINER = b"openssh-key-v1\0"
# Tags of ASN.1 that a key can hold at its top: INTEGER, BIT STRING, OCTET STRING, OID, SEQUENCE, context 0 and 1.
KEY_TAGS = {0x02, 0x03, 0x04, 0x06, 0x30, 0xA0, 0xA1}


def _base64(run: str) -> bytes | None:
    run = "".join(run.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except binascii.Error:
        return None


def is_armoured_key(body: str) -> bool:
    """A key's bytes in an armour's body, whose line breaks may be escaped; or whole cipher blocks that a header announces."""
    if "\\" in body:
        body = ESCAPED_SLASH.sub("/", ESCAPED_BREAK.sub("\n", body))
    headers = HEADERS.match(body) if ":" in body else None
    data = _base64(body[headers.end() :] if headers else body)
    if is_der_key(data) or is_ssh_key(data):
        return True
    vector = ENCRYPTED.search(headers[0]) if headers and data else None  # as long as a block of the cipher
    return bool(vector) and len(data) % (len(vector[1]) // 2) == 0


def _items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, end) of the DER values that fill data[at:end] exactly, or None."""
    out = []
    while at < end:
        if at + 2 > end:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end or data[at] == 0:
                return None
            size = int.from_bytes(data[at : at + n], "big")
            at += n
            if size < 0x80:
                return None
        if at + size > end:
            return None
        out.append((tag, at, at + size))
        at += size
    return out


def is_der_key(data: bytes | None) -> bool:
    """One SEQUENCE of at least two values with exact nested lengths, that opens with a version or an algorithm."""
    top = _items(data, 0, len(data)) if data else None
    if not top or len(top) != 1 or top[0][0] != 0x30:
        return False
    inner = _items(data, top[0][1], top[0][2])
    if not inner or len(inner) < 2 or any(tag not in KEY_TAGS for tag, _, _ in inner):
        return False
    for tag, start, end in inner:
        if tag & 0x20 and not _items(data, start, end):
            return False
        if tag == 0x02 and start == end:
            return False
    tag, start, end = inner[0]
    if tag == 0x30:  # an algorithm, its OID first; then the bits of a public key, or an encrypted private key
        algorithm = _items(data, start, end)
        if not algorithm or algorithm[0][0] != 0x06:
            return False
        # a digest is written like an encrypted key, but only encryption has a salt and a count among its parameters
        return inner[1][0] == 0x03 or (inner[1][0] == 0x04 and len(inner) == 2 and [t for t, _, _ in algorithm[1:]] == [0x30])
    if tag != 0x02:
        return False
    if end - start <= 1:  # a version, then integers, an algorithm or the key itself
        return inner[1][0] in (0x02, 0x04, 0x30)
    return all(t == 0x02 for t, _, _ in inner)  # modulus and exponent


def is_ssh_key(data: bytes | None) -> bool:
    """Length-prefixed strings that fill the data, the first one a key type; or the container of private keys."""
    if not data:
        return False
    container = data.startswith(SSH_CONTAINER)
    at, fields = len(SSH_CONTAINER) if container else 0, []
    while at < len(data) and len(fields) < (3 if container else 64):
        if at + 4 > len(data):
            return False
        size = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if at + size > len(data):
            return False
        fields.append(data[at : at + size])
        at += size
    if container:  # cipher, key derivation and its options, then the number of keys
        return len(fields) == 3 and fields[0].isascii() and 0 < len(fields[0]) < 64 and at + 4 <= len(data)
    return at == len(data) and len(fields) >= 2 and fields[0].startswith(SSH_NAMES)


def is_signed_token(run: str) -> bool:
    """A header that is a JSON object with an algorithm, and a payload that is JSON."""
    parts = run.split(".")
    try:
        header, payload = (json.loads(_base64(p) or b"") for p in parts[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str) and isinstance(payload, (dict, list))


def scan(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every base span and every confirmed span, in order."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    if "-----BEGIN " in text:
        for m in PEM.finditer(text):
            if is_armoured_key(m[3]):
                found.append((m.start(), m.end(), 3))
    for m in BASE64.finditer(text):
        data = _base64(m[0])
        if is_der_key(data):
            found.append((m.start(), m.end(), 4))
        elif is_ssh_key(data):
            found.append((m.start(), m.end(), 5))
    for m in HEX_KEY.finditer(text):
        data = bytes.fromhex(m[0])
        if is_der_key(data):
            found.append((m.start(), m.end(), 4))
        elif is_ssh_key(data):
            found.append((m.start(), m.end(), 5))
    end = 0
    for m in JWT.finditer(text):
        if m.start() >= end and is_signed_token(m[0] + m[1]):
            end = m.end(1)
            found.append((m.start(), end, 6))
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda x: (x[0], x[2]))]


def _joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def _decoded(text: bytes | None) -> str:
    return (text or b"").decode("utf-8", "replace")


def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans (all of them, joined) of every row of ``docs``."""

    def each(texts: list[bytes | None]) -> list[pa.Array]:
        counts, digests, spans = ([], [], []), [], []
        for text in texts:
            found = scan(_decoded(text))
            base = [x for x in found if x[2] in KINDS[:3]]
            for out, kind in zip(counts, KINDS):
                out.append(sum(x[2] == kind for x in base))
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            spans.append(_joined(found))
        return [pa.array(c, pa.int64()) for c in counts] + [pa.array(digests, pa.string()), pa.array(spans, pa.string())]

    return map_texts(
        docs, ["doc_id"], "n_assign long, n_access long, n_hex long, base_sha256 string, spans string", each
    )


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; overlapping spans count as one, of the first kind.

    Texts without a span, and null texts, stay as they are. n_chars, if there, follows the new text.
    """
    columns = docs.columns

    def each(texts: list[bytes | None]) -> list[pa.Array]:
        out = []
        for raw in texts:
            text, parts, at = _decoded(raw), [], 0
            for start, end, kind in scan(text):
                if start >= at:
                    parts += [text[at:start], f"<{kind}>"]
                at = max(at, end)
            out.append(None if raw is None else "".join(parts) + text[at:] if parts else text)
        return [pa.array(out, pa.string())]

    new = map_texts(docs, columns, "__masked string", each)
    made = {"text": F.col("__masked"), "n_chars": F.length("__masked").cast("long")}
    return new.select(*[made.get(c, F.col(f"`{c}`")).alias(c) for c in columns])
