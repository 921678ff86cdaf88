"""Join helpers that keep the size and skew of each side in view.

Dimension joins are left to adaptive execution: AQE measures the built side
at runtime and only then picks a broadcast, so nothing unbounded is ever
broadcast on a guess.  Explicit broadcast() hints are used only where the
row count is bounded by construction (nation/region, currency codes, the
holiday calendar).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"


def key_pieces(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str, rows_per_task: int) -> DataFrame:
    """(key, pieces, split_dim) of the keys whose joined rows exceed
    `rows_per_task`: both sides are counted per key, with map-side combine, and
    the product says how many pieces the key needs.  The larger side of a key is
    split and the smaller one repeated, so a repeat costs at most the split."""
    d = dim.groupBy(F.col(dim_key).alias("key")).agg(F.count(F.lit(1)).alias("d"))
    f = fact.groupBy(F.col(fact_key).alias("key")).agg(F.count(F.lit(1)).alias("f"))
    size = F.col("d") * F.col("f")
    return d.join(f, "key").where(size > rows_per_task).select(
        "key", F.least(F.ceil(size / F.lit(rows_per_task)), F.greatest("d", "f")).cast("int").alias("pieces"),
        (F.col("d") > F.col("f")).alias("split_dim"))


def _salted(df: DataFrame, key: str, heavy: Column, is_dim: bool, spread: list[str]) -> DataFrame:
    """A side with its salt: one of its key's pieces where this side is split,
    all of them where it is repeated, 0 for a key that is not heavy."""
    at = heavy[F.col(key)]
    own = F.pmod(F.xxhash64(*spread), at["pieces"]).cast("int")
    split = at["split_dim"] if is_dim else ~at["split_dim"]
    salts = (F.when(at.isNull(), F.array(F.lit(0))).when(split, F.array(own))
             .otherwise(F.sequence(F.lit(0), at["pieces"] - 1)))
    return df.withColumn(SALT, F.explode(salts))


def salted_sides(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str,
                 rows_per_task: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt that cuts every key to about `rows_per_task` joined
    rows.  The heavy keys (of a code column: a few hundred values at most) come
    to the rows as a scalar subquery, so neither side moves to learn its salts."""
    heavy = key_pieces(dim, fact, dim_key, fact_key, rows_per_task).select(F.map_from_entries(F.collect_list(
        F.struct("key", F.struct("pieces", "split_dim"))))).scalar()
    return (_salted(dim, dim_key, heavy, True, dim.columns), _salted(fact, fact_key, heavy, False, fact.columns))


def salted_right_join(dim: DataFrame, fact: DataFrame, dim_key: str, fact_key: str,
                      rows_per_task: int = 1_000_000) -> DataFrame:
    """`dim RIGHT JOIN fact ON dim_key = fact_key` for a low-cardinality key.

    A key such as a currency code has a few hundred values, so a plain shuffle
    join puts every row of a popular code, and its whole output, in one task.
    Only the codes measured as heavy are cut, each by its own size (see
    `salted_sides`); the others join as they are.  Fact rows whose key no dim
    row has are added back by an anti join against the distinct keys (at most
    one row per key).
    """
    d, f = salted_sides(dim, fact, dim_key, fact_key, rows_per_task)
    matched = d.join(f, (d[dim_key] == f[fact_key]) & (d[SALT] == f[SALT]), "inner").drop(SALT)
    keys = dim.select(F.col(dim_key).alias("_k")).where(F.col("_k").isNotNull()).distinct()
    unmatched = fact.join(keys, fact[fact_key] == keys["_k"], "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
