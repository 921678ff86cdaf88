import random
import zlib

from pyspark.sql import functions as F

from brute import jump_hash
from conftest import SF_SMALL
from marketlens.llm import sharding
from marketlens.llm.queries import op10_sharding


def test_jump_hash_equals_the_published_algorithm(spark):
    rng = random.Random(1)
    keys = [0, 1, -1, 2**63 - 1, -2**63, *(rng.randrange(-2**63, 2**63) for _ in range(300))]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 24, 25, 100):
        got = df.select("k", sharding.jump_hash(F.col("k"), n).alias("s")).collect()
        assert [r.s for r in got] == [jump_hash(r.k, n) for r in got]


def test_one_more_shard_takes_rows_only_into_itself(spark):
    df = sharding.assign_shards(spark.range(5000), "id", 24)
    assert df.where("grown_shard != shard and grown_shard != 24").count() == 0
    moved = df.where("grown_shard = 24").count()
    assert 100 < moved < 320  # about 5000 / 25


def test_slots_are_gapless_with_nulls_and_repeated_rows(spark):
    rows = [(None, "x", 1), (None, "x", 1), *[(7, "same", 2)] * 40, *[(i, f"t{i}", 3) for i in range(200)]]
    df = spark.createDataFrame([(*r, r[2], r[2]) for r in rows], "doc_id long, text string, block int, SLOT int, shard int")
    out = sharding.number_slots(sharding.assign_shards(df, "doc_id", 5), blocks=7).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        assert r.shard == jump_hash(-1 if r.doc_id is None else r.doc_id, 5)
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    empty = sharding.assign_shards(df.limit(0), "doc_id", 5)
    assert sharding.number_slots(empty).count() == 0


def test_slots_of_very_many_equal_rows(spark):
    df = spark.range(150_000).select(F.lit(3).cast("long").alias("doc_id"))
    out = sharding.number_slots(sharding.assign_shards(df, "doc_id", 4), blocks=3)
    r = out.agg(F.min("slot").alias("a"), F.max("slot").alias("b"), F.countDistinct("slot").alias("n")).first()
    assert (r.a, r.b, r.n) == (0, 149_999, 150_000)


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    out = op10_sharding(spark, SF_SMALL).collect()
    assert len(out) == len(docs)
    for r in out:
        raw = (docs[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 8, zlib.crc32(raw), "key")
        assert (r.shard, r.grown_shard) == (jump_hash(r.doc_id, 24), jump_hash(r.doc_id, 25))
