"""Secret scan with structural confirmation.

Three base kinds come from fixed patterns.  Beyond them, runs that could be
encoded keys are decoded, and reported only if their bytes parse:

* ``der``: base64 or hex of an ASN.1 private key; the outer sequence and all
  nested lengths must fill their parents exactly, with the version and the
  members of PKCS#1, PKCS#8, SEC1 or DSA;
* ``pem``: a BEGIN ... PRIVATE KEY block whose body is such a key (an
  encrypted PKCS#8 included), an OpenSSH key, or by its headers a legacy
  encrypted key of whole cipher blocks; or base64 or hex of such a block;
* ``ssh``: base64 or hex of an OpenSSH private key container, its
  length-prefixed strings followed to the end;
* ``jwt``: a signed token; header and payload are JSON objects, the header has
  a known ``alg``, and the signature decodes to the length ``alg`` calls for.

Base64 and hex may be wrapped: lines that hold nothing else are joined, and a
key ends, as its own lengths say, at the end of a line.  Keys wrapped inside a
PEM block are the block's.  A key or token may follow other characters of its
own alphabet (``Bearer_eyJ...``, ``keys/MII...``): beside the start of a run, each
place after one of ``-_`` (in base64 of ``-_+/``) where a key can begin is tried.

Spans count code points, end exclusive.  Defined results: null text counts as
empty and has no spans; repeated rows are scanned each; equal starts are
ordered as in ``KINDS``.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_map, pick

KINDS = ("assign", "access", "hex", "der", "pem", "ssh", "jwt")
BASE_KINDS = KINDS[:3]

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_VALUE_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
ASSIGN_WORDS = ("passw", "secret", "token", "apikey", "api_key")
# A failing match of these two ends where its run of characters ends, so the
# least length can stand in the pattern itself.
ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (ACCESS_MIN - 4))
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{%d,}" % HEX_MIN)

# Payload and signature of a token; the header is the run before.
JWT = re.compile(r"\.(?=([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]{43,}+))")
URL64 = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_-")
PEM = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
PEM_IN_BYTES = b"PRIVATE KEY-----"
# Runs that may be wrapped, by real or escaped line ends; LINE is one of their lines.
WRAP = r"(?:[ \t]*+\r?\n[ \t]*+|(?:\\r)?\\n)"
BASE64_RUN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{16,}}+(?:{WRAP}[A-Za-z0-9+/_-]++)*+={{0,2}}")
BASE64_LINE = re.compile(rf"([A-Za-z0-9+/_-]++)(?:{WRAP})?")
HEX_RUN = re.compile(rf"(?<![0-9A-Fa-f])[0-9A-Fa-f]{{16,}}+(?:{WRAP}[0-9A-Fa-f]++)*+")
HEX_LINE = re.compile(rf"([0-9A-Fa-f]++)(?:{WRAP})?")
LEAST_KEY = 29  # bytes
# Signature bytes by signing method (RSA: by key size, a multiple of 64).
JWT_BYTES = {"HS256": {32}, "HS384": {48}, "HS512": {64}, "ES256": {64}, "ES256K": {64}, "ES384": {96}, "ES512": {132},
             "EdDSA": {64, 114}, "RS256": None, "RS384": None, "RS512": None, "PS256": None, "PS384": None,
             "PS512": None}


def from_base64(text: str) -> bytes | None:
    body = "".join(text.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_members(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, content) of values that fill ``data`` exactly, else None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data) or data[at] == 0:
                return None
            size = int.from_bytes(data[at:at + n], "big")
            at += n
            if size < 0x80:
                return None
        if at + size > len(data):
            return None
        out.append((tag, data[at:at + size]))
        at += size
    return out


INTEGER, OCTETS, SEQUENCE = 0x02, 0x04, 0x30


def is_dsa(p: int, q: int, g: int, y: int, x: int) -> bool:
    """The public member is the generator's power.  (Modulus sizes beyond what
    libraries take, 10,000 bits, are judged by their divisibility alone.)"""
    if not (1 < q < p and 1 < g < p and 0 < y < p and 0 < x < q) or (p - 1) % q:
        return False
    return p.bit_length() > 10_000 or pow(g, x, p) == y


def der_size(data: bytes) -> int | None:
    """Bytes of the value that ``data`` begins with, its header included."""
    if len(data) < 2 or data[0] != SEQUENCE:
        return None
    if data[1] < 0x80:
        return 2 + data[1]
    n = data[1] & 0x7F
    return 2 + n + int.from_bytes(data[2:2 + n], "big") if 1 <= n <= 4 and len(data) >= 2 + n else None


def is_der_key(data: bytes | None, encrypted: bool = False) -> bool:
    outer = der_members(data) if data else None
    if not outer or len(outer) != 1 or outer[0][0] != SEQUENCE:
        return False
    parts = der_members(outer[0][1])
    if not parts:
        return False
    tags = [t for t, _ in parts]
    if encrypted and tags == [SEQUENCE, OCTETS]:
        return bool(der_members(parts[0][1]))
    if tags[0] != INTEGER or len(parts[0][1]) != 1:
        return False
    version = parts[0][1][0]
    if tags == [INTEGER] * 6 and version == 0:
        return is_dsa(*(int.from_bytes(v, "big", signed=True) for _, v in parts[1:]))
    if tags[:9] == [INTEGER] * 9 and version in (0, 1):  # PKCS#1: modulus the product of the primes
        n, _, _, p, q = (int.from_bytes(v, "big") for _, v in parts[1:6])
        return version == 1 or n == p * q
    if tags[1:3] == [SEQUENCE, OCTETS] and version in (0, 1):  # PKCS#8: algorithm, then the key
        algorithm = der_members(parts[1][1])
        return bool(algorithm) and algorithm[0][0] == 0x06 and bool(der_members(parts[2][1]))
    # SEC1: the private scalar, then optional tagged curve and public key
    return (version == 1 and len(tags) > 1 and tags[1] == OCTETS and len(parts[1][1]) in (28, 32, 48, 66)
            and set(tags[2:]) <= {0xA0, 0xA1})


SSH_MAGIC = b"openssh-key-v1\0"


def openssh_size(data: bytes | None) -> int | None:
    """Bytes of the container that ``data`` begins with."""
    if not data or not data.startswith(SSH_MAGIC):
        return None
    at = len(SSH_MAGIC)

    def string() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 > len(data) or at + 4 + size > len(data):
            return None
        at += 4 + size
        return data[at - size:at]

    cipher, kdf, options = string(), string(), string()
    if not cipher or not kdf or options is None:
        return None
    keys, at = int.from_bytes(data[at:at + 4], "big"), at + 4
    if not 1 <= keys <= 64 or any(string() is None for _ in range(keys)):
        return None
    return at if string() is not None else None


def is_openssh_key(data: bytes | None) -> bool:
    return bool(data) and openssh_size(data) == len(data)


def is_pem_key(body: str) -> bool:
    """``body``: what stands between the BEGIN and END lines."""
    lines = body.replace("\\r", "").replace("\\n", "\n").strip().splitlines()
    headers: list[str] = []
    while lines and (":" in lines[0] or headers and lines[0][:1] in (" ", "\t") and lines[0].strip()):
        headers.append(lines.pop(0))
    data = from_base64("".join(lines))
    fields = {k.strip().lower(): v.strip() for k, _, v in (h.partition(":") for h in headers)}
    if "ENCRYPTED" not in fields.get("proc-type", ""):
        return is_openssh_key(data) or is_der_key(data, encrypted=True)
    cipher, _, start = (x.strip() for x in fields.get("dek-info", "").partition(","))
    if not data or not re.fullmatch(r"(?:[0-9A-Fa-f]{16}){1,2}", start):
        return False
    block = len(start) // 2
    return len(data) >= 32 and (len(data) % block == 0 or not cipher.endswith(("CBC", "ECB")))


def pem_keys(text: str) -> list[tuple[int, int]]:
    """Spans of the blocks from BEGIN to the next marker, an END of that label."""
    found, begin = [], None
    for m in PEM.finditer(text):
        if m[1] == "END" and begin and begin[2] == m[2] and is_pem_key(text[begin.end():m.start()]):
            found.append((begin.start(), m.end()))
        begin = m if m[1] == "BEGIN" else None
    return found


def decode64(run: str) -> bytes:
    """The whole bytes of a run of base64 characters without padding."""
    run = run[:-1] if len(run) % 4 == 1 else run
    return binascii.a2b_base64(run.replace("-", "+").replace("_", "/") + "=" * (-len(run) % 4))


def decode16(run: str) -> bytes:
    return bytes.fromhex(run[:len(run) // 2 * 2])


def encoded_keys(text: str, runs: re.Pattern, line: re.Pattern, bits: int, starts: dict[str, str]) -> list[tuple[int, int, str, bool]]:
    """(start, end, kind, wrapped) of the keys in runs of characters of
    ``bits`` bits.  ``starts``: what the code of each kind begins with."""
    decode, group, held = (decode64, 4, 3) if bits == 6 else (decode16, 2, 1)
    found = []
    inner = re.compile("(?<=[/+_-])(?:" + "|".join(starts.values()) + ")") if bits == 6 else None
    for run in runs.finditer(text):
        pieces, at = [], run.start()
        while at < run.end() and (m := line.match(text, at, run.end())):
            pieces.append(m.span(1))
            at = m.end()
        joined = "".join(text[a:b] for a, b in pieces)
        if len(joined) * bits < 8 * LEAST_KEY:
            continue
        begins, total = [], 0
        for a, b in pieces:
            begins.append(total)
            total += b - a
        stops = {n: k for k, n in enumerate((*begins[1:], total))}  # characters -> the line that ends there
        past = 0
        decoded: dict[int, bytes] = {}  # of the run, by the place in a group where it begins
        blocks: dict[int, list] = {}  # PEM keys in them
        for begin in sorted({*begins, *(m.start() for m in inner.finditer(joined))}) if inner else begins:
            if begin < past:
                continue
            k = bisect_right(begins, begin) - 1
            at = pieces[k][0] + begin - begins[k]
            low = joined[begin:begin + 32] if bits == 6 else joined[begin:begin + 32].lower()
            kind = next((kind for kind, code in starts.items() if low.startswith(code)), "pem" if begin == 0 else None)
            if kind is None:
                continue
            size = None
            if kind == "der":
                size = der_size(decode(joined[begin:begin + 16]))
            else:
                skip, phase = divmod(begin, group)
                if phase not in decoded:
                    decoded[phase] = decode(joined[phase:])
                data, skip = decoded[phase], skip * held
                if kind == "ssh":
                    size = openssh_size(data[skip:]) if data.startswith(SSH_MAGIC, skip) else None
                    if size is None:
                        continue
                else:
                    if phase not in blocks:
                        blocks[phase] = pem_keys(data.decode("latin-1")) if PEM_IN_BYTES in data else []
                    if not blocks[phase] or blocks[phase][-1][0] < skip:
                        continue
                    chars = begin + -(-(blocks[phase][-1][1] - skip) * 8 // bits)
                    last = bisect_left(begins, chars) - 1
                    past = begins[last] + pieces[last][1] - pieces[last][0]
                    found.append((at, run.end() if last == len(pieces) - 1 else pieces[last][1], "pem", last > k))
            if size is None:
                continue
            stop = begin + -(-size * 8 // bits)
            if stop not in stops:
                continue
            body = from_base64(joined[begin:stop]) if bits == 6 else bytes.fromhex(joined[begin:stop])
            if is_openssh_key(body) if kind == "ssh" else is_der_key(body):
                last, past = stops[stop], stop
                found.append((at, run.end() if last == len(pieces) - 1 else pieces[last][1], kind, last > k))
    return found


BASE64_STARTS = {"der": "M", "ssh": "b3BlbnNzaC", "pem": "LS0tLS1CRUdJTi"}
HEX_STARTS = {"der": "30", "ssh": SSH_MAGIC[:-1].hex(), "pem": b"-----BEGIN ".hex()}


HEADER = re.compile(r"(?<=[-_])e[wy]")  # base64 of { before a blank or a quote
JSON = json.JSONDecoder()


def header_methods(run: str) -> list[tuple[int, str]]:
    """(begin, alg) of the known token headers that end with the run of base64
    characters and begin with it or after a - or _."""
    found, decoded = [], {}
    for begin in (0, *(m.start() for m in HEADER.finditer(run))):
        phase, held = begin % 4, begin // 4 * 3
        if phase not in decoded:
            decoded[phase] = (from_base64(run[phase:]) or b"").decode("latin-1")
        data = decoded[phase]
        try:
            at = next((k for k in range(held, len(data)) if data[k] not in " \t\r\n"), len(data)) if begin == 0 else held
            header, end = JSON.raw_decode(data, at)
        except (ValueError, RecursionError):
            continue
        if not data[end:].strip(" \t\r\n") and isinstance(header, dict):
            alg = header.get("alg")
            if isinstance(alg, str) and alg in JWT_BYTES:
                found.append((begin, alg))
    return found


def token_start(run: str, payload: str, signature: str) -> int | None:
    """Where in ``run`` the header of a signed token begins."""
    methods = header_methods(run)
    if not methods:
        return None
    try:
        if not isinstance(json.loads(from_base64(payload) or b""), dict):
            return None
    except (ValueError, UnicodeDecodeError, RecursionError):
        return None
    size = len(from_base64(signature) or b"")
    return next((begin for begin, alg in methods
                 if (size in JWT_BYTES[alg] if JWT_BYTES[alg] else size >= 128 and size % 64 == 0)), None)


def scan(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, by start, then kind."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE_MIN]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    for m in JWT.finditer(text):
        start = m.start()
        while start and text[start - 1] in URL64:
            start -= 1
        begin = token_start(text[start:m.start()], m[1], m[2])
        if begin is not None:
            found.append((start + begin, m.end(2), "jwt"))
    blocks = pem_keys(text) if "PRIVATE KEY-----" in text else []
    found += [(*b, "pem") for b in blocks]
    for args in ((BASE64_RUN, BASE64_LINE, 6, BASE64_STARTS), (HEX_RUN, HEX_LINE, 4, HEX_STARTS)):
        for start, end, kind, wrapped in encoded_keys(text, *args):
            if not (wrapped and any(a < start < b for a, b in blocks)):
                found.append((start, end, kind))
    return sorted(set(found), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))



def find_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, spans array<struct<kind, start, end>> of every text."""

    def rows(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column(0),
                "spans": [[{"kind": k, "start": a, "end": b} for a, b, k in scan(t.as_py())] for t in batch.column(1)]}

    return arrow_map(pick(docs, doc_id="long", text="string"), rows,
                     "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def secret_digests(docs: DataFrame) -> DataFrame:
    """Counts and the hash of the base spans, derived from the spans in SQL."""
    def text_of(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return find_secrets(docs).select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(text_of(base).cast("binary"), 256).alias("base_sha256"), text_of(F.col("spans")).alias("spans"))


def redact(text: str | None, replacement: str) -> str | None:
    """Replace every span; overlapping spans become one replacement."""
    if not text:
        return text
    out, at, end = [], 0, 0
    for start, stop, _ in scan(text):
        if start >= end:
            out += [text[at:start], replacement]
        end = at = max(end, stop)
    return "".join(out) + text[at:] if out else text


def redact_secrets(docs: DataFrame, replacement: str = "[secret]") -> DataFrame:
    """``docs`` (doc_id, text, lang, source, n_chars) with every secret in the
    text replaced and n_chars counted anew; no row is dropped."""

    def rows(batch: pa.RecordBatch) -> dict:
        texts = [redact(t.as_py(), replacement) for t in batch.column("text")]
        return {c: batch.column(c) for c in ("doc_id", "lang", "source")} | {
            "text": texts, "n_chars": [None if t is None else len(t) for t in texts]}

    cols = pick(docs, doc_id="long", text="string", lang="string", source="string", n_chars="long")
    return arrow_map(cols, rows, "doc_id long, text string, lang string, source string, n_chars long")
