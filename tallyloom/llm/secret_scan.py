"""Secrets in texts: patterns, and candidates confirmed by their structure.

Three patterns report as they match: assignments, access ids, long hexadecimal runs. Further
candidates are reported only after they have been decoded and parsed:

- ``pem``: an armoured private key whose body is a key encoding, or whose headers name a cipher that its
  body's length fits;
- ``key64``, ``keyhex``: base64 (of either alphabet) or hexadecimal runs whose bytes are a key encoding or
  an armoured key; they may be wrapped into lines, hexadecimal ones also with colons, and a wrapped base64
  run inside a ``pem`` doesn't count again;
- ``jwt``: a signed token with a JSON header that names a signing algorithm, a JSON body and a
  signature of that algorithm's length.

A key encoding is DER with nested lengths that all end where their parents end and the fields of
PKCS#1, PKCS#8 (plain or encrypted), SEC1 or DSA, or the length-prefixed fields of an OpenSSH key.
Public keys are no secrets. How long a key is and how many it holds is read from its own length fields.

A run of letters is joined and decoded once, and every start in it is parsed from there, so very long texts
take time by their length and not by starts times length. A null text counts as empty and has no spans. Repeated rows are scanned one by one. Offsets are in
code points. Only the columns named in the call are read, so others may have any name.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import map_arrow

Span = tuple[str, int, int]

#: Kinds in the order that decides ties, and the patterns of the first three.
KINDS = ("assign", "access", "hex", "pem", "key64", "keyhex", "jwt")
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")

PEM = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----((?:[^-]|-(?!----))++)-----END \1-----")
PEM_BYTES = re.compile(PEM.pattern.encode() + rb"\s*")
PEM_HEADERS = re.compile(r"\s*((?:[A-Za-z][A-Za-z0-9-]*:[^\n]*\n(?:[ \t]+\S[^\n]*\n)*)+)")
DEK_INFO = re.compile(r"^DEK-Info:[ \t]*[A-Z0-9-]+,((?:[0-9A-Fa-f]{2}){8,16})[ \t]*$", re.M)
#: Where a run may begin that holds a DER sequence (byte 0x30), an OpenSSH key or an armour.
KEY64 = re.compile(r"(?:(?<![A-Za-z0-9])|(?<=\\[nr]))(?:M|b3Bl|LS0t)(?=[A-Za-z0-9+/_-]{12})")
LINE64 = re.compile(r"[A-Za-z0-9+/_-]+")
WRAP64 = re.compile(r"[ \t]*(?:\\r)?(?:\\n|\r?\n)[ \t]*(?=[A-Za-z0-9+/_]|-(?!----))")
END64 = re.compile(r"={0,2}(?![A-Za-z0-9+/=_-])")
KEYHEX = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[Ff]:?70|2[Dd]:?2[Dd])(?=(?::?[0-9A-Fa-f]{2}){8})")
LINEHEX = re.compile(r"(?:[0-9A-Fa-f]{2})+")
WRAPHEX = re.compile(r":(?=[0-9A-Fa-f]{2})|:?[ \t]*(?:\\r)?(?:\\n|\r?\n)[ \t]*(?=[0-9A-Fa-f]{2})")
ENDHEX = re.compile(r"(?![0-9A-Fa-f])")
#: Three parts in a row; the header may begin behind a hyphen, with { or white space, that is these letters.
CHAIN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]++){2,}+")
PART = re.compile(r"[A-Za-z0-9_-]+")
HEADER = re.compile(r"(?:(?<![A-Za-z0-9_-])|(?<=-))(?:e[w-z0-9_-]|[ICD][A-Za-z0-9_-])(?=[A-Za-z0-9_-]{10})")

#: Bytes that a signature of each algorithm has; RSA ones have their key's length.
SIGNATURE_BYTES = {"HS256": 32, "HS384": 48, "HS512": 64, "ES256": 64, "ES256K": 64, "ES384": 96, "ES512": 132, "EdDSA": 64}
RSA_ALGORITHMS = {"RS256", "RS384", "RS512", "PS256", "PS384", "PS512"}
OPENSSH_MAGIC = b"openssh-key-v1\x00"
INTEGER, BITS, OCTETS, OID, SEQUENCE = 0x02, 0x03, 0x04, 0x06, 0x30
#: Fixed value: RSA keys of several primes have a tenth field.
MOST_FIELDS = 10


def der_fields(data: bytes | memoryview) -> list[tuple[int, bytes | memoryview]] | None:
    """Tag and content of each field in a row; None unless they fill ``data`` exactly, or if no key has so many."""
    fields, at = [], 0
    while at < len(data):
        if at + 2 > len(data) or len(fields) == MOST_FIELDS:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if at + size > len(data):
            return None
        fields.append((tag, data[at : at + size]))
        at += size
    return fields


def is_der_key(data: bytes) -> bool:
    """Whether ``data`` is a private key in one of the DER forms."""
    outer = der_fields(data)
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    fields = der_fields(outer[0][1])
    if not fields:
        return False
    tags = [tag for tag, _ in fields]
    if tags in ([INTEGER] * 9, [INTEGER] * 6):  # PKCS#1, DSA
        return fields[0][1] in (b"\x00", b"\x01") and all(content for _, content in fields)
    if tags[:2] == [INTEGER, OCTETS] and fields[0][1] == b"\x01":  # SEC1
        return len(fields[1][1]) >= 20 and all(
            tag in (0xA0, 0xA1) and der_fields(content) for tag, content in fields[2:]
        )
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS]:  # PKCS#8
        return fields[0][1] in (b"\x00", b"\x01") and _names_algorithm(fields[1][1]) and bool(der_fields(fields[2][1]))
    if tags == [SEQUENCE, OCTETS]:  # PKCS#8, encrypted
        return _names_algorithm(fields[0][1]) and len(fields[1][1]) >= 16
    return False


def _names_algorithm(data: bytes) -> bool:
    fields = der_fields(data)
    return bool(fields) and fields[0][0] == OID and len(fields[0][1]) >= 3


def openssh_size(data: bytes | memoryview) -> int | None:
    """Bytes that the fields of the OpenSSH private key at the start of ``data`` take; None if it is none.

    Cipher, kdf and its options, the number of keys, their public parts, and all private parts as one.
    """
    at = len(OPENSSH_MAGIC)
    if data[:at] != OPENSSH_MAGIC:
        return None

    def number() -> int:
        return int.from_bytes(data[at : at + 4], "big")

    for _ in range(3):
        at += 4 + number()
    keys, at = number(), at + 4
    if not keys or at > len(data):
        return None
    for _ in range(keys + 1):
        size = number()
        if at + 4 > len(data) or not size:
            return None
        at += 4 + size
    return at if at <= len(data) else None


def is_openssh_key(data: bytes) -> bool:
    """Whether ``data`` holds the fields of an OpenSSH private key and nothing else."""
    return openssh_size(data) == len(data)


def der_size(head: bytes) -> int | None:
    """Bytes of the DER sequence that begins with ``head``."""
    if len(head) < 6 or head[0] != SEQUENCE:
        return None
    n = head[1] & 0x7F if head[1] >= 0x80 else 0
    if n > 4 or head[1] == 0x80:
        return None
    return 2 + n + (int.from_bytes(head[2 : 2 + n], "big") if n else head[1])


def is_key(data: bytes) -> bool:
    return is_openssh_key(data) or is_der_key(data)


def secret_size(data: memoryview) -> int | None:
    """Bytes of the key or armoured key that ``data`` begins with; None if there is none."""
    if not len(data):
        return None
    if data[0] == SEQUENCE:
        size = der_size(bytes(data[:6]))
        return size if size is not None and size <= len(data) and is_der_key(data[:size]) else None
    if data[0] == OPENSSH_MAGIC[0]:
        return openssh_size(data)
    armour = PEM_BYTES.match(data) if data[0] == ord("-") else None
    return armour.end() if armour and is_pem_body(armour[2].decode("latin-1")) else None


def decoded64(text: str) -> bytes | None:
    """Base64 with or without its padding; None if it is neither."""
    text = text.rstrip("=")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=b"-_" if "-" in text or "_" in text else None, validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(header: str, body: str, signature: str) -> bool:
    content, sign = json_object(body), decoded64(signature)
    if content is None or sign is None:
        return False
    head = json_object(header)
    if head is None or not isinstance(head.get("alg"), str):
        return False
    if head["alg"] in RSA_ALGORITHMS:
        return len(sign) >= 128
    return SIGNATURE_BYTES.get(head["alg"]) == len(sign)


def json_object(text: str) -> dict | None:
    """The JSON object that a base64 text stands for."""
    data = decoded64(text)
    try:
        value = json.loads(data) if data is not None else None
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_pem_body(body: str) -> bool:
    """Whether the body of an armour is a key encoding, or is encrypted as its headers say."""
    body = re.sub(r"\\r|\r", "", body).replace("\\n", "\n")
    headers = PEM_HEADERS.match(body)
    data = decoded64(re.sub(r"\s", "", body[headers.end() :] if headers else body))
    if data is None:
        return False
    dek = DEK_INFO.search(headers[1]) if headers and "ENCRYPTED" in headers[1] else None
    if dek:
        return len(data) >= 16 and len(data) % min(16, len(dek[1]) // 2) == 0
    return is_key(data)


class Run:
    """The letters from a place of the text on, joined over line ends, and the bytes that they stand for."""

    def __init__(self, text: str, at: int, line: re.Pattern, wrap: re.Pattern) -> None:
        parts, self.firsts, self.places, n = [], [], [], 0
        while found := line.match(text, at):
            parts.append(found[0])
            self.firsts.append(n)
            self.places.append(at)
            n, at = n + len(found[0]), found.end()
            if not (joint := wrap.match(text, at)):
                break
            at = joint.end()
        self.letters, self.end = "".join(parts), at
        self.decoded: dict[int, bytes] = {}

    def offset(self, place: int) -> int:
        """The number of the letter at a place of the text."""
        line = bisect_right(self.places, place) - 1
        return self.firsts[line] + place - self.places[line]

    def after(self, offset: int) -> int:
        """The place behind the letters before ``offset``."""
        line = bisect_left(self.firsts, offset) - 1
        return self.places[line] + offset - self.firsts[line]

    def wrapped(self, start: int, stop: int) -> bool:
        return bisect_right(self.firsts, start) != bisect_left(self.firsts, stop)


class Run64(Run):
    def data(self, offset: int) -> memoryview:
        """The bytes from a letter on."""
        turn = offset % 4
        if turn not in self.decoded:
            letters = self.letters[turn:].replace("-", "+").replace("_", "/")
            letters = letters[: len(letters) - (len(letters) % 4 == 1)]
            self.decoded[turn] = base64.b64decode(letters + "=" * (-len(letters) % 4))
        return memoryview(self.decoded[turn])[offset // 4 * 3 :]

    def stop(self, offset: int, size: int) -> int | None:
        """The letter behind ``size`` bytes; None if letters of both alphabets stand for them."""
        stop = offset + -(-size * 4 // 3)
        letters = self.letters[offset:stop]
        mixed = ("-" in letters or "_" in letters) and ("+" in letters or "/" in letters)
        return None if mixed else stop


class RunHex(Run):
    def data(self, offset: int) -> memoryview:
        turn = offset % 2
        if turn not in self.decoded:
            letters = self.letters[turn:]
            self.decoded[turn] = bytes.fromhex(letters[: len(letters) // 2 * 2])
        return memoryview(self.decoded[turn])[offset // 2 :]

    def stop(self, offset: int, size: int) -> int:
        return offset + 2 * size


def decoded_spans(text: str, starts: re.Pattern, make: Callable[[int], Run], end: re.Pattern) -> Iterator[tuple[int, int, bool]]:
    """Runs of letters that stand for a key, and whether they are wrapped into lines."""
    at, run = 0, None
    while start := starts.search(text, at):
        begin = start.start()
        at = start.end()
        if run is None or begin >= run.end:
            run = make(begin)
        offset = run.offset(begin)
        size = secret_size(run.data(offset))
        stop = run.stop(offset, size) if size else None
        if stop is None:
            continue
        if tail := end.match(text, run.after(stop)):
            yield begin, tail.end(), run.wrapped(offset, stop)
            at = tail.end()


def token_spans(text: str) -> Iterator[tuple[int, int]]:
    """Signed tokens, also those behind a dot or a hyphen."""
    for chain in CHAIN.finditer(text):
        parts = [m.span() for m in PART.finditer(text, *chain.span())]
        i = 0
        while i + 2 < len(parts):
            (begin, end), body, signature = parts[i : i + 3]
            i += 1
            for head in HEADER.finditer(text, begin, end):
                if is_signed_token(text[head.start() : end], text[slice(*body)], text[slice(*signature)]):
                    yield head.start(), signature[1]
                    i += 2
                    break


def base_spans(text: str) -> list[Span]:
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def confirmed_spans(text: str) -> list[Span]:
    """Candidates that parse as what they look like."""
    found = []
    if "-----BEGIN " in text:
        found = [("pem", *m.span()) for m in PEM.finditer(text) if is_pem_body(m[2])]
    armours = found[:]
    for start, end, wrapped in decoded_spans(text, KEY64, lambda at: Run64(text, at, LINE64, WRAP64), END64):
        if not wrapped or not any(s <= start < e for _, s, e in armours):
            found.append(("key64", start, end))
    runs = decoded_spans(text, KEYHEX, lambda at: RunHex(text, at, LINEHEX, WRAPHEX), ENDHEX)
    found += [("keyhex", start, end) for start, end, _ in runs]
    return found + [("jwt", *span) for span in token_spans(text)]


def joined(spans: list[Span]) -> str:
    """kind:start:end by start, then kind."""
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def redacted(text: str, spans: list[Span], mark: str) -> str:
    """The text with each stretch of overlapping spans replaced by ``mark``."""
    parts, at = [], 0
    for _, start, end in sorted(spans, key=lambda x: x[1:]):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def scan_secrets(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, counts by base kind, digest of the base spans, all spans."""

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, digests, spans = [], [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            base = base_spans(text)
            kinds = [k for k, _, _ in base]
            counts.append([kinds.count(k) for k in KINDS[:3]])
            digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
            spans.append(joined(base + confirmed_spans(text)))
        columns = [pa.array(x, pa.int64()) for x in zip(*counts)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
            ["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )

    narrow = df.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = dict(narrow.dtypes)["id"]
    found = map_arrow(narrow, scan, f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    return found.withColumnRenamed("id", id_column)


def redact_secrets(df: DataFrame, text_column: str = "text", mark: str = "[secret]") -> DataFrame:
    """The same rows with every span of the text replaced by ``mark``; other columns stay as they are."""
    at = df.columns.index(text_column)

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = []
        for text in batch.column(at):
            text = text.as_py()
            spans = base_spans(text) + confirmed_spans(text) if text else []
            texts.append(redacted(text, spans, mark) if spans else text)
        columns = [*batch.columns]
        columns[at] = pa.array(texts, pa.string())
        return pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_arrow(df, clean, df.schema)
