import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketlens.llm import suffix_dedup as S

L = S.LENGTH


def brute(texts):
    """(n_bytes, n_removed, n_spans, kept sha256) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + L] for r in raw for i in range(len(r) - L + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - L + 1):
            if seen[r[i:i + L]] > 1:
                gone[i:i + L] = b"\1" * L
        spans = sum(1 for i in range(len(r)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(r, gone) if not g)
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(spark, rows, schema="doc_id long, text string, k1 string, ranges int"):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], schema)
    got = S.remove_repeats(df, "doc_id", "text")
    removed = F.aggregate("spans", F.lit(0), lambda n, s: n + s["end"] - s["start"])
    return [tuple(r) for r in got.select(
        "id", "n_bytes", removed, F.size("spans"), F.sha2("kept", 256)).collect()]


def corpus(seed, n=60):
    rng = random.Random(seed)

    def prose(k):
        return " ".join("".join(rng.choice("abcdeéf") for _ in range(rng.randint(2, 7))) for _ in range(k))

    passage, short, edge = prose(80), prose(20), prose(120)
    texts = []
    for _ in range(n):
        kind = rng.randrange(8)
        own = prose(rng.randint(5, 200))
        if kind == 0:
            own = prose(30) + passage + prose(30)
        elif kind == 1:
            own = own + short + own[:150]
        elif kind == 2:
            a = rng.randint(0, 60)
            own = prose(10) + edge[a:a + rng.randint(190, 420)] + prose(10)
        elif kind == 3 and texts:
            own = rng.choice(texts)
        elif kind == 4 and texts:
            t = rng.choice(texts)
            cut = rng.randint(0, len(t))
            own = t[:cut] + "#" + t[cut + 1:]
        elif kind == 5:
            own = "na " * rng.randint(50, 300)
        texts.append(own)
    return texts + ["", "short", "x" * L, "y" * (L - 1), "y" * (L - 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    texts = corpus(seed)
    got = sorted(result(spark, list(enumerate(texts))))
    assert [g[1:] for g in got] == brute(texts)


def test_wide_path_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "CLASS_KEYS", 3)
    monkeypatch.setattr(S, "RUN_KEYS", 50)
    monkeypatch.setattr(S, "CHUNK", 700)
    texts = corpus(9, 90)
    got = sorted(result(spark, list(enumerate(texts))))
    assert [g[1:] for g in got] == brute(texts)


def test_parts_grow_with_the_keys(spark, monkeypatch):
    monkeypatch.setattr(S, "PART_BYTES", 4096)
    texts = corpus(4, 90)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cuts = S.borders(df, "text", S.candidates(df, "text"), 2)
    assert cuts == sorted(set(cuts)) and len(cuts) > 8
    got = sorted(result(spark, list(enumerate(texts))))
    assert [g[1:] for g in got] == brute(texts)


def test_text_longer_than_a_chunk(spark):
    rng = random.Random(6)
    long = "".join(rng.choice("abcdefgh ") for _ in range(S.CHUNK + 5000))
    edge = long[S.CHUNK - 400:S.CHUNK + 300]
    texts = [long, "x" * 50 + edge + "y" * 50, long[100:500] + "z" + long[-700:], "own " + long[:150]]
    got = sorted(result(spark, list(enumerate(texts))))
    assert [g[1:] for g in got] == brute(texts)


def test_nulls_repeated_rows_and_empty_table(spark):
    long = "".join(chr(97 + i * i % 23) for i in range(300))
    rows = [(1, None), (1, None), (None, "short"), (2, long), (2, long), (None, "z" + long[::-1])]
    got = Counter(result(spark, rows))
    assert got == Counter((i, *b) for (i, _), b in zip(rows, brute([t for _, t in rows])))
    assert result(spark, []) == []


def test_merge_orders_runs_and_reports_shared_prefixes():
    rng = random.Random(4)
    runs, every = [], []
    for r in range(5):
        keys = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 9))) for _ in range(30)})
        every += [(k, r) for k in keys]
        runs.append(S.Run.pack(keys, [[(r, 0, 0)] for _ in keys]))
    got = list(S.merge([S.Run.read(r) for r in runs]))
    assert [k for _, k, _ in got] == sorted(k for k, _ in every)
    for (_, a, _), (h, b, _) in zip(got, got[1:]):
        assert h == S.shared_prefix(a, b, 0) and a[:h] == b[:h]
    assert list(S.merge([])) == []


def test_known_prefix_is_not_compared_again():
    assert S.shared_prefix(b"xxabcd", b"yyabce", 2) == 5


def test_content_key_hashes_the_text_under_two_seeds(spark):
    import xxhash

    from marketlens.llm.common import text_key

    texts = ["", "a", "some longer text " * 9]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(*text_key(F.col("t"))).collect()
    second = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), 42)
    for t, row in zip(texts, got):
        assert [x % 2**64 for x in row] == [xxhash.xxh64_intdigest(t, 42), xxhash.xxh64_intdigest(t, second)]


def test_a_run_sends_two_places_of_a_frequent_passage(spark):
    rng = random.Random(9)
    prose = lambda k: "".join(rng.choices("abcdefgh ", k=k))
    passage = prose(400)
    texts = [prose(50) + passage + prose(50) for _ in range(100)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    runs = S.sorted_runs(S._texts(df, "text"), S.candidates(df, "text"), []).collect()
    places = [p for r in runs if r.part >= 0 for _, _, p in S.Run.read(bytes(r.run))]
    assert places and max(map(len, places)) == 2
    assert Counter(result(spark, list(enumerate(texts)), "doc_id long, text string, k1 string, ranges int")) == Counter(
        (i, *b) for i, b in enumerate(brute(texts)))
