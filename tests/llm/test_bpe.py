import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken

from conftest import SF_SMALL
from marketlens.llm import bpe
from marketlens.llm.queries import VOCABULARY, op6_byte_bpe

PATTERN = public_tokenizers.PATTERN
TOKENS = bpe.read_ranks(VOCABULARY)
OWN = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})


def texts():
    rng = random.Random(3)
    some = ["", " ", "\n\n", "don't we'll  it's", "a\u00a0b\u2003c\u0085d", "😀👩‍👩‍👧 naïve ﬁ", "\x00\x1f", "<|endoftext|>",
            "x" * 30_000, "word " * 9_000, "'s", "''s  't", "١٢٣ ²³ ⅷ", "\ud7ff\ue000\U0010ffff"]
    alphabet = " \t\n'aé中1-😀\u0301\u200d "
    return some + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(150)]


def unpack(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_ids_equal_the_reference_library_and_decode_back(spark):
    rows = [(i, t, b"old") for i, t in enumerate(texts())] + [(-1, None, b"old")]
    df = spark.createDataFrame(rows, "doc_id long, text string, IDS binary")
    out = bpe.decode(bpe.encode(df, "text", VOCABULARY, PATTERN), "ids", VOCABULARY)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert unpack(r.ids) == OWN.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    assert bpe.encode(df.limit(0), "text", VOCABULARY, PATTERN).count() == 0


def test_splitting_agrees_on_every_code_point():
    enc = bpe.PieceEncoder(bpe.build_tokenizer(TOKENS, None), PATTERN)
    for c in [*range(0x3000), *range(0x3000, 0x110000, 37)]:
        if not 0xD800 <= c < 0xE000:
            s = f"a{chr(c)}b {chr(c)}{chr(c)} 1{chr(c)}  {chr(c)}x"
            assert unpack(enc.packed([s])[0]) == OWN.encode_ordinary(s), hex(c)


def test_offsets_start_each_token(spark):
    df = spark.createDataFrame([("naïve 😀😀 text",), ("",), (None,)], "text string")
    for r in bpe.encode(df, "text", VOCABULARY, PATTERN, offsets="places").collect():
        ids, places = unpack(r.ids), unpack(r.places)
        assert len(ids) == len(places) and places == sorted(places)
        for i, p in zip(ids, places):
            first = TOKENS[i].decode("utf-8", "ignore")
            if first and not first.startswith("\ufffd"):
                assert r.text[p:].lstrip().startswith(first.strip())


def test_cache_overflow_gives_the_same_ids():
    enc = bpe.PieceEncoder(bpe.build_tokenizer(TOKENS, None), PATTERN, most=5)
    for t in texts()[:40]:
        assert unpack(enc.packed([t, t])[1]) == OWN.encode_ordinary(t)


def test_query(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = op6_byte_bpe(spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = OWN.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
