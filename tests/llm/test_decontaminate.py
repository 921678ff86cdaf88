import random
from itertools import combinations

import pytest

import brute
from conftest import SF_ORACLE
from marketlens.llm import decontaminate as D
from marketlens.llm.queries import op3_decontaminate


def test_masks_hit_every_window_with_allowed_mismatches():
    for n in range(D.MISMATCHES + 1):
        for wrong in combinations(range(D.WINDOW), n):
            assert any(all(s + i not in wrong for i, c in enumerate(m) if c == "1")
                       for m in D.MASKS for s in range(D.WINDOW - len(m) + 1)), wrong


def data(seed):
    rng = random.Random(seed)
    names = [f"v{i}" for i in range(60)]
    prose = lambda n: [rng.choice(names) for _ in range(n)]
    items = [(i, " ".join(prose(rng.randint(14, 60)))) for i in range(25)]
    items += [(100, "five short words stand here"), (101, "too short"), (102, None), (103, ""),
              (104, items[0][1]), (None, "an item without any id at all"), (105, "Mixed, CASE; with-marks five.six!")]
    docs = []
    for d in range(120):
        text = prose(rng.randint(0, 80))
        kind = rng.randrange(5)
        if kind < 3:
            words = (rng.choice(items[:25])[1]).split()
            if kind == 1:  # substitutions
                for _ in range(rng.randint(1, 8)):
                    words[rng.randrange(len(words))] = rng.choice(names)
            if kind == 2:  # a part of it
                a = rng.randint(0, len(words) - 10)
                words = words[a:a + rng.randint(10, 30)]
            text = text + words + prose(rng.randint(0, 40))
        docs.append((d, " ".join(text)))
    docs += [(900, None), (901, ""), (902, "FIVE short, words -- stand here"), (902, "FIVE short, words -- stand here"),
             (903, "five short words sit here"), (904, items[3][1]), (None, "an item without any id at all"),
             (905, "zz " * 30_000 + items[5][1] + " yy" * 30_000), (906, "mixed case with marks five six"), (907, "too short")]
    return docs, items


@pytest.mark.parametrize("block_words", [10**6, 200])
def test_equals_brute_force(spark, block_words):
    docs, items = data(2)
    df = spark.createDataFrame([(i, t, "x", n) for n, (i, t) in enumerate(docs)], "doc_id long, text string, leaks string, n int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = D.find_leaks(df, "text", bench, block_words=block_words)
    assert out.columns == ["doc_id", "text", "n", "leaks"]
    rows = out.collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert {x.item_id for x in r.leaks} == brute.leaks(docs[r.n][1], items), r.n
        words = D.words_of((r.text or "").encode())
        assert all(0 <= x.first_word < x.end_word <= len(words) for x in r.leaks)
    clean = D.clean(df, "text", bench)
    assert clean.columns == df.columns
    assert {r.n for r in clean.collect()} == {r.n for r in rows if not r.leaks}


def test_part_of_an_item_behind_short_documents(spark):
    item = [f"w{i}" for i in range(59)]
    docs = ["a", "b", *["c"] * 10, " ".join(item[30:50]), "d", " ".join(item[45:59]), "", " ".join(item)]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.leaks] for r in D.find_leaks(df, "text", bench).collect() if r.leaks}
    assert got == {12: [(1, 0, 20)], 14: [(1, 0, 14)], 16: [(1, 0, 59)]}


def test_long_items_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(D, "SEGMENT_WORDS", 20)
    rng = random.Random(1)
    item = [f"q{rng.randrange(50)}" for _ in range(150)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    docs = [(a, " ".join(item[a:a + 13])) for a in range(0, 137)] + [(200, " ".join(item[3:15]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id for r in D.find_leaks(df, "text", bench).collect() if r.leaks}
    assert got == set(range(137))
    assert D.find_leaks(df.limit(0), "text", bench).count() == 0
    assert D.clean(df, "text", bench.limit(0)).count() == len(docs)


def test_query(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_ORACLE}/benchmark.parquet").collect()]
    got = {r.doc_id: set(r.item_ids) for r in op3_decontaminate(spark, SF_ORACLE).collect()}
    short = [r for r in docs if len(r.text or "") < 1500]
    for r in short:
        assert got.get(r.doc_id, set()) == brute.leaks(r.text, items)
    assert len(got) >= 10
