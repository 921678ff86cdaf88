"""SimHash near-duplicate detection with covering locality-sensitive hashing.

A fingerprint has bit i set when more than half of the text's shingle hashes
(XXH64, seed 42) have it.  Fingerprints link when they differ in at most
`radius` bits.  Candidates come from 2**(radius+1) - 1 tables: every bit
position gets a nonzero vector over GF(2) of length radius+1, and table v keeps
the bits whose vector has an odd product with v.  The vectors of any `radius`
positions leave some v orthogonal to all of them, so every pair within the
radius agrees on all kept bits of that table: no pair is missed.

Only distinct fingerprints enter the tables.  A bucket of up to `block`
fingerprints is compared in one place and gives a spanning forest of its links.
A larger bucket is split exactly: two members within the radius meet at a point
half way between them, so each member goes to the points within half the radius
(in the bits that the table leaves out), and the groups at those points, whose
size is bounded by the bit count, are compared instead.

Cases: a null text is empty; a text without words has fingerprint 0 and links
like any other; fewer words than a shingle give one shingle of all of them;
repeated rows and ids each get their row; a null id never names a component
unless the component has no other; a very long text counts whole, in the task
that reads it; an empty table gives no rows.  The input may
have further columns of any name: `near_duplicates` drops and `keep_first`
keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, free_name, text_key
from .graph import components

BLOCK = 256
BITS_AT_ONCE = 1 << 15


def covering_masks(radius: int) -> list[int]:
    """The tables' bit masks as signed 64-bit integers."""
    n = 2 ** (radius + 1) - 1
    vectors = [i % n + 1 for i in range(64)]
    masks = []
    for v in range(1, n + 1):
        m = sum(1 << i for i, w in enumerate(vectors) if (w & v).bit_count() % 2)
        masks.append(m - (1 << 64) if m >> 63 else m)
    return masks


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of UTF-8 bytes as an unsigned integer."""
    import xxhash

    words = text.lower().split()  # on bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    counts = np.zeros(64, dtype=np.int64)
    pairs = zip(starts[:n].tolist(), ends[k - 1:].tolist())
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in pairs), np.uint64, n)
    for i in range(0, n, BITS_AT_ONCE):
        part = hashes[i:i + BITS_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def add_fingerprints(df: DataFrame, text: str, shingle: int) -> DataFrame:
    """Replace `text` by its fingerprint (a signed long named `fingerprint`)."""
    fields = [f for f in df.schema.fields if f.name != text]
    schema = T.StructType(fields + [T.StructField("fingerprint", T.LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle)
                      for t in batch.column(text).cast(pa.binary())]
            keep = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != text]
            col = pa.array(np.array(prints, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([c for _, c in keep] + [col],
                                             names=[n for n, _ in keep] + ["fingerprint"])

    return df.mapInArrow(run, schema)


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links within one bounded group of fingerprints."""
    x = np.unique(values)
    u = x.view(np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= radius
    left, out = np.ones(len(x), dtype=bool), []
    for start in range(len(x)):
        if not left[start]:
            continue
        left[start] = False
        stack = [start]
        while stack:
            i = stack.pop()
            found = np.flatnonzero(near[i] & left)
            left[found] = False
            stack += found.tolist()
            out += [(int(x[i]), int(x[j])) for j in found]
    return out


def _forests(groups: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) of groups given as bounded arrays in column `members`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.column("members")
            flat = np.asarray(col.values)
            at = np.asarray(col.offsets)
            links = [e for i in range(len(col)) for e in forest(flat[at[i]:at[i + 1]], radius)]
            ends = np.array(links, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

    return groups.select("members").mapInArrow(run, "a long, b long")


def _half_way_points(x: F.Column, mask: int, radius: int) -> F.Column:
    free = [i for i in range(64) if not (mask >> i) & 1]
    points = [x]
    for r in range(1, (radius + 1) // 2 + 1):
        for bits in combinations(free, r):
            flip = sum(1 << i for i in bits)
            points.append(x.bitwiseXOR(F.lit(flip - (1 << 64) if flip >> 63 else flip).cast("long")))
    return F.array(*points)


def links(prints: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints (column `fingerprint`)
    exactly as all pairs within `radius` bits do."""
    masks = covering_masks(radius)
    x = F.col("fingerprint")
    keyed = prints.select("fingerprint", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), x.bitwiseAND(F.lit(m).cast("long")).alias("k"))
        for t, m in enumerate(masks)])).alias("at")).select("fingerprint", "at.t", "at.k")
    sizes = keyed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = keyed.join(sizes, ["t", "k"])
    small = met.where(F.col("n") <= block).groupBy("t", "k").agg(F.collect_list("fingerprint").alias("members"))
    large = met.where(F.col("n") > block)
    points = F.coalesce(*[F.when(F.col("t") == t, _half_way_points(x, m, radius)) for t, m in enumerate(masks)])
    split = (large.select("fingerprint", F.explode(points).alias("point"))
             .groupBy("point").agg(F.collect_set("fingerprint").alias("members")).where(F.size("members") > 1))
    return _forests(small.select("members").unionByName(split.select("members")), radius)


def _classed(df: DataFrame, row_id: str, text: str, shingle: int, radius: int, block: int) -> DataFrame:
    """(id, k1, k2, fingerprint, component_id), one row per input row."""
    k1, k2 = text_key(F.col(f"`{text}`"))
    rows = df.select(F.col(f"`{row_id}`").alias("id"), k1.alias("k1"), k2.alias("k2"),
                     F.col(f"`{text}`").alias("text"))
    rows = cut_lineage(add_fingerprints(rows, "text", shingle))
    distinct = cut_lineage(rows.groupBy("fingerprint").agg(F.min("id").alias("first")))
    roots = components(links(distinct, radius, block))
    rooted = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(named, "root").select("fingerprint", "component_id", "root")
    return rows.join(classes, "fingerprint")


def near_duplicates(df: DataFrame, row_id: str, text: str, shingle: int = 3, radius: int = 2,
                    block: int = BLOCK) -> DataFrame:
    """(id, fingerprint as 16 hexadecimal digits, component_id: the smallest id
    that links reach), one row per input row."""
    return _classed(df, row_id, text, shingle, radius, block).select(
        F.col("id").alias(row_id), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id")


def keep_first(df: DataFrame, row_id: str, text: str, shingle: int = 3, radius: int = 2,
               block: int = BLOCK) -> DataFrame:
    """The input's rows, one of each component: that of the smallest id (ties:
    the smallest content key; of equal id and text, any one)."""
    rows = _classed(df, row_id, text, shingle, radius, block)
    key = F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")
    best = rows.groupBy("root").agg(F.min(key).alias("best"))
    copies = rows.groupBy("id", "k1", "k2").agg(F.count(F.lit(1)).alias("n"))
    best = best.select("best.id", "best.k1", "best.k2")
    stay = cut_lineage(best.join(copies, best["id"].eqNullSafe(copies["id"]) & (best["k1"] == copies["k1"])
                     & (best["k2"] == copies["k2"])).select(
        *[best[c].alias(f"__{c}") for c in ("id", "k1", "k2")], F.col("n").alias("__n")))
    names = {c: free_name(df, f"__text_{c}") for c in ("k1", "k2")}
    k1, k2 = text_key(F.col(f"`{text}`"))
    keyed = df.withColumns({names["k1"]: k1, names["k2"]: k2})
    kept = keyed.join(stay.hint("shuffle_hash"), (keyed[names["k1"]] == stay["__k1"]) & (keyed[names["k2"]] == stay["__k2"])
                      & keyed[row_id].eqNullSafe(stay["__id"]))
    cols = [F.col(f"`{c}`") for c in df.columns]
    once = kept.where("__n = 1").select(*cols)
    more = kept.where("__n > 1").dropDuplicates(["__id", "__k1", "__k2"]).select(*cols)
    return once.unionByName(more)
