import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import brute
from conftest import SF_SMALL
from marketlens.llm import graph, simhash
from marketlens.llm.queries import op2_simhash


def test_masks_cover_every_pair_of_positions():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius)
        assert len(masks) == 2 ** (radius + 1) - 1
        for bits in combinations(range(64), min(radius, 2)):
            assert any(not any(m >> b & 1 for b in bits) for m in masks)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    base = [" ".join(rng.choice(words) for _ in range(120)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    for i in range(len(base), 120):
        t = rng.choice(base).split()
        for _ in range(rng.randint(0, 3)):
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((i, " ".join(t).replace("w1", "W1")))
    return rows + [(500, None), (501, ""), (502, " \t\n"), (503, "one"), (504, "one two"), (503, "one"),
                   (None, base[0]), (None, "alone here now"), (505, "é\u00a0ü x"), (506, "w " * 20_000)]


@pytest.mark.parametrize("block", [256, 2])
def test_equals_brute_force(spark, block):
    rows = corpus(5)
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in rows], "doc_id long, text string, fingerprint string, k1 int")
    got = simhash.near_duplicates(df, "doc_id", "text", block=block)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    want, _ = brute.components(rows)
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)


def test_links_of_close_fingerprints_in_one_large_bucket(spark):
    rng = random.Random(8)
    start = rng.getrandbits(63)
    prints = {start}
    while len(prints) < 300:  # a cloud of chained neighbours
        p = rng.choice(sorted(prints))
        prints.add(p ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)))
    prints |= {rng.getrandbits(63) for _ in range(50)}
    df = spark.createDataFrame([(p,) for p in prints], "fingerprint long")
    roots = {r.node: r.root for r in graph.components(simhash.links(df, 2, block=16)).collect()}
    names = sorted(prints)
    want = dict(zip(names, brute.groups(names)))
    by = {}
    for p in names:
        by.setdefault(want[p], set()).add(roots.get(p, p))
    assert all(len(v) == 1 for v in by.values()) and len(set.union(*by.values())) == len(by)


def test_keep_first_keeps_one_row_of_each_component(spark):
    rows = corpus(6)
    rows += [rows[3], rows[3]]
    df = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, __text_k1 int")
    kept = simhash.keep_first(df, "doc_id", "text").collect()
    _, classes = brute.components(rows)
    first = {}
    for (i, _), c in zip(rows, classes):
        if i is not None:
            first[c] = min(i, first.get(c, i))
    assert len(kept) == len(set(classes))
    assert Counter(r.doc_id for r in kept if r.doc_id is not None) == Counter(first.values())


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df, "doc_id", "text").count() == 0
    assert simhash.keep_first(df, "doc_id", "text").count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000), (None, 3)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 300)}}


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want, _ = brute.components(rows)
    assert Counter(tuple(r) for r in op2_simhash(spark, SF_SMALL).collect()) == Counter(want)
