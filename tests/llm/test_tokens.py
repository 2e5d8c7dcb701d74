import base64
import hashlib
import json
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import bpe_codec, queries, secret_scan, token_planes

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def plain_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_digests_match_library(make_docs, odd_texts):
    enc = plain_encoding()
    got = sorted(map(tuple, bpe_codec.round_trip_digests(make_docs(odd_texts), RANKS, public_tokenizers.PATTERN)
                     .collect()), key=repr)
    want = []
    for i, t in odd_texts:
        ids = enc.encode_ordinary(t or "")
        assert enc.decode(ids) == (t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)


def test_bpe_empty_table(make_docs):
    assert bpe_codec.round_trip_digests(make_docs([]), RANKS, public_tokenizers.PATTERN).collect() == []


def test_bpe_ids_and_bytes_tables(make_docs, odd_texts):
    enc = bpe_codec.encode_documents(make_docs(odd_texts), RANKS, public_tokenizers.PATTERN)
    back = bpe_codec.decode_documents(enc, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id, bytes(r.bytes).decode()) for r in back if r.doc_id) == sorted(
        (i, t or "") for i, t in odd_texts if i)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab19 \n\t'sé.,!- 日́\r")), max_size=60))
def test_bpe_cut_is_safe(text):
    enc = bpe_codec.load_encoding(RANKS, public_tokenizers.PATTERN)
    assert "".join(bpe_codec.chunks(text, 3)) == text
    assert bpe_codec.encode(enc, text, 3) == enc.encode_ordinary(text)


SCRIPTS = {"Cyrillic": "абвёЖ", "Greek": "αβγΔώ", "Arabic": "ابتث\u064b", "Han": "日本語学。，", "Devanagari": "कखि।", "Thai": "กขา่"}


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(sorted(SCRIPTS)), st.data())
def test_bpe_cut_is_safe_in_other_scripts(script, data):
    enc = bpe_codec.load_encoding(RANKS, public_tokenizers.PATTERN)
    text = data.draw(st.text(alphabet=st.sampled_from(list(SCRIPTS[script] + "1٣½ \n\u00a0\u3000\x1c'sré.!-")), max_size=60))
    assert "".join(bpe_codec.chunks(text, 3)) == text
    assert bpe_codec.encode(enc, text, 3) == enc.encode_ordinary(text)


@pytest.mark.parametrize("word", ["слово", "λόγος", "كلمة", "言葉。"])
def test_texts_of_other_scripts_are_cut(word):
    text = (word + ("" if word.endswith("。") else " ")) * 40000
    assert max(map(len, bpe_codec.chunks(text))) < bpe_codec.CHUNK_CHARS + 20
    assert max(map(len, bpe_codec.chunks(text, 512))) < 540


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 4095, 4096, 10001])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    assert np.array_equal(token_planes.from_planes(token_planes.to_planes(ids, bits), n, bits), ids)


@pytest.mark.parametrize("bits", [False, True])
def test_token_files_against_library(spark, make_docs, odd_texts, tmp_path, bits, monkeypatch):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(WORDS)
    tok.encode_special_tokens = True
    path = str(tmp_path / "files")
    token_planes.write_token_files(make_docs(odd_texts), path, WORDS, 2, shards=4, bits=bits)
    got = token_planes.read_digests(spark, path).orderBy("start").collect()
    texts = {i: t or "" for i, t in odd_texts}
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 4, 4, 5, 6, 7, 8, 9, 10]
    at = 0
    for r in got:
        ids = tok.encode(texts[r.doc_id], add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    whole = {r.start: r.ids for r in token_planes.read_token_files(spark, path).collect()}
    assert all(zlib.crc32(whole[r.start]) == r.ids_crc32 for r in got)


def test_token_files_empty(spark, make_docs, tmp_path):
    token_planes.write_token_files(make_docs([]), str(tmp_path / "e"), WORDS, 2, shards=2)
    assert token_planes.read_digests(spark, str(tmp_path / "e")).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aB1 \n\t'sİΣ., ́\x85\x1c日")), max_size=40))
def test_word_cache_equals_whole_text(text):
    words = token_planes.load_words(WORDS)
    ids = words.tokenizer.encode(text, add_special_tokens=False).ids
    assert words.encode(text) == np.array(ids, "<u4").tobytes()


# -- secrets ------------------------------------------------------------------

def brute_base(text):
    import re
    text = text or ""
    out = []
    for kind, pat, flags in (
            ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
            ("access", r"AKIA[A-Z0-9]+", 0), ("hex", r"[0-9a-f]+", 0)):
        for m in re.finditer(pat, text, flags):
            if (len(m[2]) >= 6 if kind == "assign" else len(m[0]) >= (20 if kind == "access" else 24)):
                out.append((m.start(), secret_scan.KINDS.index(kind), m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def tlv(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 + len(s := n.to_bytes((n.bit_length() + 7) // 8, "big"))]) + s
    return bytes([tag]) + size + body


def integer(n):
    return tlv(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


P_, Q_ = 2**127 - 1, 2**89 - 1
RSA = tlv(0x30, b"".join(map(integer, (0, P_ * Q_, 65537, 12345, P_, Q_, 1, 2, 3))))
PKCS8 = tlv(0x30, integer(0) + tlv(0x30, tlv(6, b"\x2a\x86\x48")) + tlv(4, RSA))
SEC1 = tlv(0x30, integer(1) + tlv(4, b"\x11" * 32) + tlv(0xA0, tlv(6, b"\x2a\x86")))


def ssh(s):
    return len(s).to_bytes(4, "big") + s


SSH = secret_scan.SSH_MAGIC + ssh(b"none") * 2 + ssh(b"") + (1).to_bytes(4, "big") + ssh(b"pub" * 9) + ssh(b"priv" * 9)


def url64(b):
    return base64.urlsafe_b64encode(b).rstrip(b"=").decode()


def token(alg="HS256", size=32):
    return ".".join((url64(json.dumps({"alg": alg, "typ": "JWT"}).encode()), url64(b'{"sub":"1"}'), url64(b"\xfe" * size)))


@pytest.mark.parametrize("body,kind", [
    (base64.b64encode(RSA).decode(), "der"), (base64.b64encode(PKCS8).decode(), "der"),
    (base64.b64encode(SEC1).decode(), "der"), (RSA.hex().upper(), "der"), (token(), "jwt"),
    (token("RS256", 256), "jwt"), (base64.b64encode(SSH).decode(), "ssh"),
    ("-----BEGIN RSA PRIVATE KEY-----\n" + base64.encodebytes(RSA).decode() + "-----END RSA PRIVATE KEY-----", "pem"),
    ("-----BEGIN OPENSSH PRIVATE KEY-----\n" + base64.encodebytes(SSH).decode() + "-----END OPENSSH PRIVATE KEY-----", "pem")])
def test_structures_confirmed(body, kind):
    text = f"é before {body} after"
    assert (9, 9 + len(body), kind) in secret_scan.scan(text)


DSA_P = 7879  # FIPS 186's small example: q = 101 divides p - 1, g = 170
DSA = tlv(0x30, b"".join(map(integer, (0, DSA_P, 101, 170, pow(170, 87, DSA_P), 87))))


def pem(label, data, headers=""):
    return f"-----BEGIN {label}-----\n{headers}{base64.encodebytes(data).decode()}-----END {label}-----"


def wrapped(code, width, sep="\n"):
    return sep.join(code[i:i + width] for i in range(0, len(code), width))


def b64(data):
    return base64.b64encode(data).decode()


LONG_SSH = secret_scan.SSH_MAGIC + ssh(b"none") * 2 + ssh(b"") + (1).to_bytes(4, "big") + ssh(b"pub" * 9) + ssh(b"priv" * 9000)
LEGACY = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC," + "0A" * 16 + "\n\n"


def spaced_token():
    return ".".join((url64(b'{ "alg": "HS256"}'), url64(b' {"sub": "1"}'), url64(b"\xfe" * 32)))


@pytest.mark.parametrize("body,kind", [
    *((wrapped(b64(key), width, sep), kind) for key, kind in ((RSA, "der"), (PKCS8, "der"), (SSH, "ssh"))
      for width in (64, 76) for sep in ("\n", "\r\n", "\n    ", "\\n")),
    *((wrapped(code, width), "pem") for code in (b64(pem("RSA PRIVATE KEY", RSA).encode()), b64(("\n" + pem("OPENSSH PRIVATE KEY", SSH) + "\n").encode()))
      for width in (64, 76, 10**6)),
    (SSH.hex(), "ssh"), (wrapped(SSH.hex().upper(), 60), "ssh"), (wrapped(RSA.hex(), 60), "der"), (pem("RSA PRIVATE KEY", RSA).encode().hex(), "pem"),
    (pem("DSA PRIVATE KEY", DSA), "pem"), (pem("RSA PRIVATE KEY", b"\x9c" * 608, LEGACY), "pem"),
    (pem("OPENSSH PRIVATE KEY", LONG_SSH), "pem"), (b64(LONG_SSH), "ssh"), (token("ES256K", 64), "jwt"), (spaced_token(), "jwt")])
def test_other_forms_confirmed(body, kind):
    for before, after in (("é before ", " after"), ("é k\n", "\nafter this"), ('é "', '"')):
        text = before + body + after
        spans = [s for s in secret_scan.scan(text) if s[2] not in secret_scan.BASE_KINDS]
        assert spans == [(len(before), len(before) + len(body), kind)]
        assert not set(body[5:-5].split()) & set(secret_scan.redact(text, "").split())


@pytest.mark.parametrize("before", ["Bearer_", "x-", "a_b-ey-", "keys/private/", "key_", "id+", "ew_MII/"])
@pytest.mark.parametrize("body,kind", [(token(), "jwt"), (spaced_token(), "jwt"), (token("RS256", 256), "jwt"), (b64(RSA), "der"),
                                       (b64(PKCS8), "der"), (b64(SSH), "ssh"), (wrapped(b64(RSA), 64), "der"),
                                       (b64(pem("RSA PRIVATE KEY", RSA).encode()), "pem")])
def test_secrets_after_characters_of_their_alphabet(before, body, kind):
    text = f"é {before}{body} after"
    spans = [s for s in secret_scan.scan(text) if s[2] not in secret_scan.BASE_KINDS]
    begin = 2 if kind == "pem" and len(before) == 4 else 2 + len(before)  # a whole run that decodes to a block is the span
    assert spans == [(begin, 2 + len(before) + len(body), kind)]


@pytest.mark.parametrize("text", ["-eyJh" * 50_000 + token(), ("LS0tLS1CRUdJTiBSU0EgUFJJVkFURSBLRVktLS0tLS0t" + "\n") * 6_000,
                                  "/M" * 100_000, "/b3BlbnNzaC1rZXktdjEA" * 10_000, "-ewog" * 50_000])
def test_many_beginnings_are_linear(text):
    import time
    t = time.perf_counter()
    secret_scan.scan(text)
    assert time.perf_counter() - t < 10


@pytest.mark.parametrize("body", [
    wrapped(b64(RSA[:-3]), 64), wrapped(b64(RSA + b"\0"), 64), wrapped(b64(SSH + b"x"), 64), (SSH + b"x").hex(), SSH.hex()[:-2],
    pem("DSA PRIVATE KEY", DSA[:-1] + b"\x56"), pem("RSA PRIVATE KEY", b"\x9c" * 607, LEGACY), pem("RSA PRIVATE KEY", b"\x9c" * 608),
    b64(pem("RSA PRIVATE KEY", RSA[:-3]).encode()), token("ES256K", 63), pem("RSA PRIVATE KEY", RSA).replace("END RSA", "END EC"),
    "-----BEGIN PRIVATE KEY-----" * 2000])
def test_other_forms_refused(body):
    assert not [s for s in secret_scan.scan(f"x {body} y") if s[2] not in (*secret_scan.BASE_KINDS, "der")]
    assert "END EC" in body or not [s for s in secret_scan.scan(f"x {body} y") if s[2] == "der"]


@pytest.mark.parametrize("body", [
    base64.b64encode(RSA[:-3]).decode(), base64.b64encode(b"\x30\x82\x01\x00" + b"x" * 200).decode(), token("none", 0),
    token("HS256", 31), "eyJhbGciOiJ.eyJhbGci.x", base64.b64encode(SSH + b"x").decode(), base64.b64encode(RSA + b"\0").decode(),
    "-----BEGIN RSA PRIVATE KEY-----\nMIIabc\n-----END RSA PRIVATE KEY-----", "M" + "A" * 60])
def test_structures_refused(body):
    assert not [s for s in secret_scan.scan(f"x {body} y") if s[2] not in secret_scan.BASE_KINDS]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["token", "secret", "api_key", "APIKEY", "pass", "password", "=", ":", " ", '"', "'", "abc", "f" * 12,
                                 "0" * 13, "AKIA", "AKIAB", "X" * 9, "7" * 8, "é", "\n", "ſ", "K", "."]), max_size=14).map("".join))
def test_base_spans_brute_force(text):
    spans = [f"{k}:{a}:{b}" for a, b, k in secret_scan.scan(text) if k in secret_scan.BASE_KINDS]
    assert spans == brute_base(text)


def test_secret_query(spark, make_docs, odd_texts):
    texts = odd_texts + [(20, f"password = hunter22 {token()} " + "ab" * 20), (21, "AKIA" + "Q" * 16)]
    got = {(r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans)
           for r in secret_scan.secret_digests(make_docs(texts)).collect()}
    for i, t in texts:
        base = brute_base(t)
        n = [sum(s.startswith(k) for s in base) for k in secret_scan.BASE_KINDS]
        spans = ",".join(f"{k}:{a}:{b}" for a, b, k in secret_scan.scan(t))
        assert (i, *n, hashlib.sha256(",".join(base).encode()).hexdigest(), spans) in got
    assert secret_scan.secret_digests(make_docs([])).collect() == []


def test_redaction(make_docs, odd_texts):
    texts = odd_texts + [(20, 'a token = "' + "ab" * 20 + '" b AKIA' + "Q" * 16 + " c")]
    out = {r.doc_id: r for r in secret_scan.redact_secrets(make_docs(texts)).collect()}
    assert out[20].text == 'a [secret]" b [secret] c' and out[20].n_chars == len(out[20].text)
    assert out[1].text is None and out[1].n_chars is None and out[8].text == odd_texts[9][1]
    assert secret_scan.redact_secrets(make_docs([])).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_queries_return_every_row(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in ("op3_byte_bpe", "op4_secret_scan", "op10_token_planes"):
        assert queries.QUERIES[name](spark, sf).count() == n
