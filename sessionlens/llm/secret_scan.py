"""Secret scans: base patterns, then structurally confirmed key material.

Base kinds are fixed patterns (assign, access, hex). Further candidates -
runs of base64 or hex letters and armoured blocks - count only after they
decode to something with the inner structure of a key or a signed token:

* ``pem``: an armoured private key whose body decodes to one of the next two
  (or, when its headers say ENCRYPTED, to whole cipher blocks); line breaks may be
  written as escapes, as in JSON. An END belongs to the last BEGIN before it;
* ``der``: PKCS#1, PKCS#8, encrypted PKCS#8 or SEC1 key; every nested length
  must fit its parent exactly;
* ``openssh``: the magic string followed by length-prefixed fields that fill
  the blob;
* ``jwt``: header and payload are JSON objects, the header names an algorithm.

Base64 of the last but one and the one before may be wrapped over lines without
armour: the first bytes tell how far a key goes (``MAX_KEY`` bytes at most).

Cases: a null text is empty (no spans; the digest of the empty string).
Offsets count code points, ends are exclusive. Repeated rows are each
reported; an empty table gives no rows; extra columns are ignored. Whole
texts are scanned, whatever their length.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, per_text

KINDS = ["assign", "access", "hex", "pem", "der", "openssh", "jwt"]

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs: the same as [0-9a-f]+ with 24 or more
ASSIGN_MIN, ACCESS_MIN = 6, 20
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

ARMOUR = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40})PRIVATE KEY-----")
ARMOURED = re.compile(r"[A-Za-z0-9+/=\s:,.-]*")
BREAK = re.compile(r"\\+[nr]")  # a line break as an escape, escaped again or not
WRAPPED = re.compile(r"[A-Za-z0-9+/]+=*|(?:[ \t]*\r?\n[ \t]*|(?:\\+[nr])+)(?=[A-Za-z0-9+/])")
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{40,}={0,2}")
HEX_ANY = re.compile(r"(?<![0-9A-Fa-f])(?:30|6[Ff]70656[Ee])[0-9A-Fa-f]{70,}")
JWT = re.compile(r"(?<![A-Za-z0-9_-])(eyJ[A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
OPENSSH_MAGIC = b"openssh-key-v1\0"
SHORTEST = 20  # no run that the access or hex scans can take is shorter
MAX_KEY = 16 << 10  # bytes of a wrapped key
LONG = 40  # nor one that the base64 and DER in hex scans can take; tokens may be


def base_spans(text: str, longest: int | None = None) -> list[tuple[int, int, str]]:
    out = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
                if len(m[2]) >= ASSIGN_MIN]
    if longest is None or longest >= SHORTEST:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)
                if m.end() - m.start() >= ACCESS_MIN]
        out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return out


# --- structure ---------------------------------------------------------------

def _b64(s: str) -> bytes | None:
    s = re.sub(r"\s", "", s).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(s + "=" * (-len(s) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _tlv(b: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the value at ``at``; None when lengths don't fit."""
    if at + 2 > end:
        return None
    tag, n, at = b[at], b[at + 1], at + 2
    if n & 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > end:
            return None
        n, at = int.from_bytes(b[at:at + k], "big"), at + k
    return (tag, at, at + n) if at + n <= end else None


def _children(b: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    out = []
    while at < end:
        part = _tlv(b, at, end)
        if part is None:
            return None
        out.append(part)
        at = part[2]
    return out


INTEGER, OCTETS, OID, SEQUENCE = 0x02, 0x04, 0x06, 0x30


def is_der_key(blob: bytes) -> bool:
    top = _tlv(blob, 0, len(blob))
    if top is None or top[0] != SEQUENCE or top[2] != len(blob):
        return False
    parts = _children(blob, top[1], top[2])
    if not parts:
        return False
    tags = [p[0] for p in parts]
    value = lambda p: blob[p[1]:p[2]]
    algorithm = lambda p: (c := _children(blob, p[1], p[2])) and c[0][0] == OID
    if len(tags) >= 9 and set(tags[:9]) == {INTEGER} and value(parts[0]) in (b"\0", b"\1"):
        modulus, p, q = (int.from_bytes(value(parts[i]), "big") for i in (1, 4, 5))
        return modulus.bit_length() >= 256 and p * q == modulus
    if tags[:3] == [INTEGER, SEQUENCE, OCTETS] and value(parts[0]) in (b"\0", b"\1"):
        return bool(algorithm(parts[1])) and parts[2][2] - parts[2][1] >= 16
    if tags[:2] == [INTEGER, OCTETS] and value(parts[0]) == b"\1":
        size = parts[1][2] - parts[1][1]
        return 16 <= size <= 66 and all(t in (0xA0, 0xA1) for t in tags[2:])
    if tags == [SEQUENCE, OCTETS]:
        return bool(algorithm(parts[0])) and parts[1][2] - parts[1][1] >= 16
    return False


def openssh_size(blob: bytes) -> int:
    """How many bytes an OpenSSH key that starts so takes, as far as the blob tells:
    more than the blob has where it goes on; 0 for no key."""
    at, fields = len(OPENSSH_MAGIC), 0
    if not blob.startswith(OPENSSH_MAGIC):
        return 0
    keys = None
    while keys is None or fields < 3 + keys + 1:
        if at + 4 > len(blob):
            return at + 4
        n, at = int.from_bytes(blob[at:at + 4], "big"), at + 4
        if fields == 3 and keys is None:
            keys = n
            if not 1 <= keys <= 16:
                return 0
            continue
        at, fields = at + n, fields + 1
        if at > MAX_KEY:
            return 0
    return at


def is_openssh_key(blob: bytes) -> bool:
    return 0 < openssh_size(blob) == len(blob)


def is_jwt(header: str, payload: str, signature: str) -> bool:
    try:
        head, body = (json.loads(_b64(s) or b"") for s in (header, payload))
    except (ValueError, RecursionError):
        return False
    if not (isinstance(head, dict) and isinstance(body, dict) and isinstance(head.get("alg"), str)):
        return False
    return (signature == "") if head["alg"].lower() == "none" else bool(_b64(signature))


def key_kind(blob: bytes | None) -> str | None:
    if blob and is_der_key(blob):
        return "der"
    return "openssh" if blob and is_openssh_key(blob) else None


def armoured(text: str):
    """(start, end, body) of armoured private keys, in one pass over the markers."""
    begin = None
    for m in ARMOUR.finditer(text):
        if m[1] == "BEGIN":
            begin = m
        elif begin is not None:
            body = BREAK.sub("\n", text[begin.end():m.start()])
            if begin[2] == m[2] and ARMOURED.fullmatch(body):
                yield begin.start(), m.end(), body
            begin = None


def unwrapped(text: str, start: int) -> tuple[bytes | None, int]:
    """The key, by its own length, that base64 lines from ``start`` on spell, and
    where it ends."""
    head = _b64(text[start:start + 24]) or b""
    if head.startswith(OPENSSH_MAGIC):
        size, known = openssh_size(head), len(head)
        while size > known:  # a few fields, each of which says where it ends
            blob = _letters(text, start, size)[0] or b""
            if len(blob) < size:
                return None, start
            size, known = openssh_size(blob), size
    else:
        top = _tlv(head + bytes(MAX_KEY), 0, MAX_KEY)
        size = top[2] if top and top[0] == SEQUENCE else None
    return _letters(text, start, size) if size else (None, start)


def _letters(text: str, start: int, size: int) -> tuple[bytes | None, int]:
    """At most ``size`` bytes of base64 from ``start`` on, and where they end."""
    left, parts, at = -(-size // 3) * 4, [], start
    while left > 0 and (m := WRAPPED.match(text, at)):
        at = m.end()
        if m[0][0] not in " \t\r\n\\":
            parts.append(m[0][:left])
            at -= max(0, len(m[0]) - left)
            left -= len(parts[-1])
            if m[0][-1] == "=":
                break
    spelled = "".join(parts)
    blob = _b64(spelled if "=" in spelled else spelled[:len(spelled) // 4 * 4])
    return (blob[:size] if blob else None), at


def confirmed_spans(text: str, longest: int | None = None) -> list[tuple[int, int, str]]:
    """Spans whose decoded content has the structure of a key or token."""
    out, taken = [], []
    if "PRIVATE KEY-----" in text:
        for start, end, body in armoured(text):
            encrypted = "ENCRYPTED" in body
            if encrypted:
                body = re.split(r"\n\s*\n", body, maxsplit=1)[-1]
            blob = _b64(body)
            if blob and (is_der_key(blob) or is_openssh_key(blob)
                         or encrypted and len(blob) >= 32 and len(blob) % 8 == 0):
                out.append((start, end, "pem"))
                taken.append((start, end))
    taken.append((len(text) + 1, len(text) + 1))
    starts = [s for s, _ in taken]  # ascending, apart

    def free(m):
        k = bisect_right(starts, m.start())
        return (not k or taken[k - 1][1] <= m.start()) and starts[k] >= m.end()

    if "eyJ" in text:
        for m in JWT.finditer(text):
            if free(m) and is_jwt(m[1], m[2], m[3]):
                out.append((m.start(), m.end(), "jwt"))
    if longest is not None and longest < LONG:
        return out
    at = 0
    for m in BASE64.finditer(text):
        if m[0][0] in "Mb" and m.start() >= at and free(m):
            blob, at = _b64(m[0]), m.end()
            kind = key_kind(blob)
            if not kind:
                blob, at = unwrapped(text, m.start())
                kind = key_kind(blob)
            if kind:
                out.append((m.start(), at, kind))
            else:
                at = m.end()
    for m in HEX_ANY.finditer(text):
        if len(m[0]) % 2 == 0 and free(m):
            kind = key_kind(bytes.fromhex(m[0]))
            if kind:
                out.append((m.start(), m.end(), kind))
    return out


_RANK = {k: i for i, k in enumerate(KINDS)}


def _key(span):
    return span[0], _RANK[span[2]], span[1]


def find_spans(text: str) -> tuple[list, list]:
    """Base spans and all spans, each by start, then kind as listed."""
    longest = max(map(len, text.split()), default=0)
    base = sorted(base_spans(text, longest), key=_key)
    more = confirmed_spans(text, longest)
    return base, sorted(base + more, key=_key)


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan(docs: DataFrame, *, keep=("doc_id",)) -> DataFrame:
    """Per row: counts of the base kinds, digest of the base spans, all spans."""
    def kernel():
        def apply(texts):
            cols = [[], [], [], [], []]
            for text in texts:
                base, spans = find_spans(text or "")
                kinds = [k for _, _, k in base]
                row = (*(kinds.count(k) for k in KINDS[:3]),
                       hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))
                for col, value in zip(cols, row):
                    col.append(value)
            return cols
        return apply

    return per_text(docs, kernel, [("n_assign", "long"), ("n_access", "long"), ("n_hex", "long"),
                                   ("base_sha256", "string"), ("spans", "string")], keep=keep)


def masked(text: str | None) -> str | None:
    """The text with every span (overlapping ones merged) replaced by ``[kind]``."""
    if not text:
        return text
    out, at = [], 0
    for start, end, kind in find_spans(text)[1]:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, *, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """All rows and columns, secrets in ``text`` masked and ``n_chars`` (if there) renewed."""
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            fixed = pa.array([masked(t) for t in batch.column(at).to_pylist()], type=pa.string())
            yield pa.RecordBatch.from_arrays(
                [fixed if i == at else batch.column(i) for i in range(batch.num_columns)],
                names=batch.schema.names)

    out = map_arrow(docs, run, docs.schema)
    if n_chars in docs.columns:
        n = F.coalesce(F.length(F.col(f"`{text}`")), F.col(f"`{n_chars}`"))
        out = out.withColumn(n_chars, n.cast(docs.schema[n_chars].dataType))
    return out
