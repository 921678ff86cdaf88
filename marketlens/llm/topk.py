"""Exact top-k inner products with multi-resolution segment statistics.

Components become integers floor(scale * x).  A vector is cut into 2, 4, ...
segments; of each segment the mean and the standard deviation are kept.  For a
query q and a candidate x,

    <q, x>  <=  sum over segments of  len * (mean_q mean_x + dev_q dev_x),

the mirror image of the lower-bound distance |q - x|^2 >= sum len * ((mean_q -
mean_x)^2 + (dev_q - dev_x)^2) with the norms of both sides known.  The bound
tightens as segments are halved.  A block of candidates is compared with a block
of queries coarse to fine: pairs whose bound stays under the query's k-th best
score so far are dropped at each level, and the exact product is computed for
the survivors only.

The queries are a stated set.  One shuffle deals every row to one block of
candidates, by a hash of id and vector, and every query to all blocks.  A block
is sorted so that its candidates come first: a task holds them (`block_rows` of
them on average, of equal rows no more than k in a batch) while the queries
stream past, k rows of a query leave each block, and a ranking by query merges
them.  Nothing but a count passes the driver.

Cases: vectors that are null or hold a null or non-finite component take no
part, and neither do empty ones; vectors of unequal length are never compared;
a vector does not meet itself (same id), but other rows of equal content do;
rows that repeat an id each take part, and as queries share one ranking; ties go
to the smaller id; an empty table gives no rows; products beyond a bigint are
returned as the nearest bigint.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 512
BLOCK_ROWS, LEAST_ROWS = 131_072, 8_192
EXACT_FLOAT = 2.0 ** 52
BIGINT = 2 ** 63
FOUND = "query_id long, vec_id long, score long"


def usable(vector: F.Column) -> F.Column:
    """Whether a vector takes part."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def segment_stats(m: np.ndarray, segments: int) -> np.ndarray:
    """Rows of sqrt(len) * (means, deviations), so that a dot product of two
    rows is the bound."""
    parts = []
    edges = np.linspace(0, m.shape[1], segments + 1).astype(int)
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            size = np.sqrt(b - a)
            parts += [m[:, a:b].mean(axis=1) * size, m[:, a:b].std(axis=1) * size]
    return np.stack(parts, axis=1)


def resolutions(dim: int) -> list[int]:
    return [s for s in (2, 4, 8, 16) if s * 2 <= dim] or [1]


class Best:
    """The k best (score, id) of each query of a block so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.score = np.full((queries, k), -np.inf)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    def threshold(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Merge found pairs, one sort for all queries that got any."""
        touched = np.unique(query)
        q = np.concatenate([query, np.repeat(touched, self.k)])
        s = np.concatenate([score, self.score[touched].ravel()])
        i = np.concatenate([ids, self.id[touched].ravel()])
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        top = place < self.k
        self.score[q[top], place[top]] = s[top]
        self.id[q[top], place[top]] = i[top]


class Block:
    """Vectors of one length with their segment statistics."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.stats = [segment_stats(vectors, s) for s in resolutions(vectors.shape[1])]
        self.largest = float(np.abs(vectors).max())

    def search(self, other: Block, best: Best) -> Iterator[tuple[int, int, int]]:
        """Compare these queries with a block of candidates; scores that doubles
        cannot hold are yielded as (query id, id, score) instead of entering `best`."""
        bound = self.vectors.shape[1] * self.largest * other.largest
        if bound >= EXACT_FLOAT:
            yield from self._wide(other.ids, other.vectors, best.k)
            return
        slack = 1e-9 * bound + 1e-6  # rounding of the bound's own arithmetic
        limit = best.threshold() - slack
        alive = ((self.stats[0] @ other.stats[0].T >= limit[:, None])
                 & (self.ids[:, None] != other.ids[None, :]))
        q, x = np.nonzero(alive)
        for mine, theirs in zip(self.stats[1:], other.stats[1:]):
            keep = self._products(mine, theirs, q, x) >= limit[q]
            q, x = q[keep], x[keep]
        score = self._products(self.vectors, other.vectors, q, x)
        keep = score >= best.threshold()[q]
        if keep.any():
            best.add(q[keep], score[keep], other.ids[x[keep]])

    @staticmethod
    def _products(a: np.ndarray, b: np.ndarray, q: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Dot products of the surviving pairs; while most pairs survive, one
        matrix product is the cheaper way to them."""
        if len(q) * 8 > len(a) * len(b):
            return (a @ b.T)[q, x]
        cuts = range(0, len(q), 65536)
        return np.concatenate([np.zeros(0), *(
            np.einsum("ij,ij->i", a[q[i:i + 65536]], b[x[i:i + 65536]]) for i in cuts)])

    def _wide(self, ids: np.ndarray, m: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
        """The k best of a block in whole numbers of any size."""
        theirs = [[int(v) for v in row] for row in m]
        for me, row in zip(self.ids.tolist(), self.vectors):
            mine = [int(v) for v in row]
            found = [(max(-BIGINT, min(BIGINT - 1, sum(a * b for a, b in zip(mine, v)))), i)
                     for v, i in zip(theirs, ids.tolist()) if i != me]
            for score, i in sorted(found, key=lambda f: (-f[0], f[1]))[:k]:
                yield me, i, score


def by_length(ids: pa.Array, vectors: pa.Array, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix of integer components) for each vector length in a batch."""
    offsets = np.asarray(vectors.offsets)
    flat = np.floor(np.asarray(vectors.values, dtype=np.float64) * scale)
    lengths = np.diff(offsets)
    number = np.asarray(ids, dtype=np.int64)
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield number[rows], flat[offsets[rows][:, None] + np.arange(n)]


def without_copies(ids: np.ndarray, m: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted rows, of neighbours with equal id and content the first k: further
    ones can be in no query's k best."""
    fresh = np.ones(len(ids), dtype=bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (m[1:] != m[:-1]).any(axis=1)
    at = np.arange(len(ids))
    keep = at - np.maximum.accumulate(np.where(fresh, at, 0)) < k
    return ids[keep], m[keep]


def top_k(df: DataFrame, row_id: str, vector: str, is_query: F.Column, k: int = 20, scale: int = 64,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank from 1, vec_id, score) of each query's k best rows."""
    own = dict(df.dtypes)[vector]
    kind = own if own in ("array<float>", "array<double>") else "array<double>"
    rows = df.withColumn("__query", F.coalesce(is_query, F.lit(False))).select(
        F.col(f"`{row_id}`").cast("long").alias("id"),
        F.col(f"`{vector}`").cast(kind).alias("vector"), "__query")
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")))
    n = rows.count()
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-n // block_rows), min(wanted, -(-n // LEAST_ROWS)))
    candidates = rows.select(F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int").alias("block"),
                             F.lit(False).alias("query"), "id", "vector")
    queries = rows.where("__query").select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                                           F.lit(True).alias("query"), "id", "vector")
    dealt = (candidates.unionByName(queries).repartitionById(blocks, "block")
             .sortWithinPartitions("block", "query", "id", "vector"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = _search(dealt, k, scale).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _search(dealt: DataFrame, k: int, scale: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each query in each block."""
    def out(q, x, score) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (q, x, score)],
                                          names=["query_id", "vec_id", "score"])

    def ask(queries: Block, held: list[Block]) -> Iterator[pa.RecordBatch]:
        best = Best(len(queries.ids), k)
        for block in held:
            wide = list(queries.search(block, best))
            if wide:
                yield out(*zip(*wide))
        q, r = np.nonzero(best.score > -np.inf)
        yield out(queries.ids[q], best.id[q, r], best.score[q, r].astype(np.int64))

    def cut(made: list[tuple[np.ndarray, np.ndarray]]) -> list[Block]:
        ids, m = without_copies(np.concatenate([i for i, _ in made]), np.concatenate([m for _, m in made]), k)
        return [Block(ids[a:a + CANDIDATE_BLOCK], m[a:a + CANDIDATE_BLOCK]) for a in range(0, len(ids), CANDIDATE_BLOCK)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, list] = {}    # candidates of the block as they come, by length
        held: dict[int, list[Block]] = {}
        now = -1
        for batch in batches:
            place = np.asarray(batch.column("block")) * 2 + np.asarray(batch.column("query").cast(pa.int32()))
            edges = np.flatnonzero(np.diff(place, prepend=-1, append=-1))
            for a, b in zip(edges[:-1], edges[1:]):
                block, is_query = divmod(int(place[a]), 2)
                if block != now:
                    made, held, now = {}, {}, block
                part = batch.slice(a, b - a)
                for ids, m in by_length(part.column("id"), part.column("vector"), scale):
                    dim = m.shape[1]
                    if not is_query:
                        made.setdefault(dim, []).append(without_copies(ids, m, k))
                        continue
                    if dim in made:
                        held[dim] = cut(made.pop(dim))
                    for c in range(0, len(ids), QUERY_BLOCK) if dim in held else ():
                        yield from ask(Block(ids[c:c + QUERY_BLOCK], m[c:c + QUERY_BLOCK]), held[dim])

    return dealt.mapInArrow(run, FOUND)
