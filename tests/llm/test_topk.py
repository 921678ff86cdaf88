import random

from pyspark.sql import functions as F

import brute
from marketlens.llm import topk

INF, NAN = float("inf"), float("nan")


def run(spark, rows, every=4, k=5, **kw):
    df = spark.createDataFrame([(i, v, "x", 0) for i, v in rows], "vec_id long, embedding array<float>, rank string, score int")
    got = topk.top_k(df, "vec_id", "embedding", F.col("vec_id") % every == 0, k=k, **kw)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in got.collect())


def as_float(rows):
    import numpy as np
    return [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]


def test_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(24)]) for i in range(400)]
    rows += [(i, rows[i % 7][1]) for i in range(400, 440)]  # ties
    rows += [(1000, None), (1004, [0.1, None] * 12), (1008, [NAN] * 24), (1012, [INF] + [0.0] * 23), (1016, []),
             (None, rows[0][1]), (1020, [1.0, 2.0]), (1021, [0.5, -2.0]), (1024, [0.0] * 24)]
    want = sorted(brute.top_k(as_float(rows), 5, 64, lambda i: i % 4 == 0))
    assert run(spark, rows) == want
    assert run(spark, rows, block_rows=30) == want


def test_repeated_rows_meet_in_no_task(spark):
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(8)]) for i in range(60)]
    rows += [(61, [0.9] * 8)] * 300 + [(62, [rng.gauss(0, 0.3) for _ in range(8)]) for _ in range(50)]
    want = sorted(brute.top_k(as_float(rows), 5, 64, lambda i: i % 4 == 0))
    assert run(spark, rows) == want
    assert run(spark, rows, block_rows=100) == want


def test_copies_beyond_k_are_left_out():
    import numpy as np
    ids = np.array([1, 1, 1, 1, 2, 2, 3])
    m = np.array([[1.0], [1.0], [1.0], [2.0], [2.0], [2.0], [2.0]])
    got = topk.without_copies(ids, m, 2)
    assert got[0].tolist() == [1, 1, 1, 2, 2, 3] and got[1].ravel().tolist() == [1.0, 1.0, 2.0, 2.0, 2.0, 2.0]


def test_fewer_rows_than_k_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    assert run(spark, rows) == sorted(brute.top_k(as_float(rows), 5, 64, lambda i: i % 4 == 0))
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []


def test_products_beyond_doubles_are_exact_or_saturate(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-1, 1]) * rng.uniform(1e6, 9e6) for _ in range(8)]) for i in range(40)]
    assert run(spark, rows) == sorted(brute.top_k(as_float(rows), 5, 64, lambda i: i % 4 == 0))
    huge = [(i, [(-1) ** i * 1e30, 1.0]) for i in range(8)]
    assert run(spark, huge) == sorted(brute.top_k(as_float(huge), 5, 64, lambda i: i % 4 == 0))


def test_bounds_are_never_below_the_product():
    import numpy as np
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(50, 30)) * 20, rng.normal(size=(60, 30)) * 20
    exact, before = a @ b.T, None
    for s in topk.resolutions(30):
        bound = topk.segment_stats(a, s) @ topk.segment_stats(b, s).T
        assert (bound >= exact - 1e-6).all()
        assert before is None or bound.sum() <= before  # finer is tighter on the whole
        before = bound.sum()
