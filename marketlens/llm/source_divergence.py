"""Source divergence audit over a minimal acyclic transducer vocabulary.

Terms are runs of letters A-Z, a-z and characters beyond ASCII, with A-Z
lower-cased.  A language keeps the terms that at least `min_docs` of its rows
hold.  Steps:

1. Tasks count the rows that hold each term; counts combine before the shuffle.
2. The kept terms are sorted by range partitions, and each is built into
   transducers of about BLOCK_BYTES of terms, one language each.  Blocks are
   consecutive, so a term's lexicographic ordinal within its language is the
   number of terms in earlier blocks plus the transducer's output.
3. The texts stream through the transducers of their language, which recount
   every kept term as (language, source, ordinal) in one narrow pass; counts
   combine before the shuffle.  Transducers are broadcast in rounds of at most
   ROUND_BYTES (or one block); with more, the texts of the languages concerned
   are read once a round.
4. With V kept terms and N counted occurrences, a term of count c has
   p = 1 + floor(10^9 (c + 2) / (N + 2 V)) in a group, and two groups differ at
   a term by floor((p - q)^2 / (p + q)).  Pairs of sources are summed over all
   kept terms by blocks of ordinals: a block of terms x sources fits CELLS
   integers, and rows that no source of a pair has are filled in from the
   count-free p.  Terms over-represented in a source are ranked, ties by
   ordinal, which is the terms' byte order.

All arithmetic is on integers; p comes from 38-digit decimals.

The result has sources x (sources - 1) rows per language by definition.

Cases: a null text, language or source reads as empty; every row counts as a
document, rows that repeat included; a language without kept terms has pairs of
value 0 and no terms; a source without terms has count 0 for all; very long texts
are cut between words, and their terms counted once; an empty table gives no
rows; further columns take no part, as the columns used get names of their own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, received, send
from .transducer import Builder, Transducer

BLOCK_BYTES = 1 << 20
PART_TERMS = 100_000
ROUND_BYTES = 64 << 20
RUN_BYTES = 8 << 20
FLUSH_TERMS = 300_000
CELLS = 1 << 20
CHUNK_TERMS = 4096
SCALE = 1_000_000_000
# Bytes of a term stay (A-Z lower-cased), all others separate.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 0 for b in range(256))


def _rows_of(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    return docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])


def _pieces(text: bytes) -> Iterator[bytes]:
    """A masked text in parts of about RUN_BYTES, cut between words."""
    a = 0
    while len(text) - a > RUN_BYTES:
        b = text.find(b"\0", a + RUN_BYTES)
        if b < 0:
            break
        yield text[a:b]
        a = b
    yield text[a:]


def terms_of(text: str) -> set[bytes]:
    out: set[bytes] = set()
    for piece in _pieces(text.encode().translate(LETTERS)):
        out.update(piece.split(b"\0"))
    out.discard(b"")
    return out


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about RUN_BYTES, to bound what is held as Python strings."""
    for batch in batches:
        step = max(1, int(batch.num_rows * RUN_BYTES / max(batch.nbytes, 1)))
        for a in range(0, batch.num_rows, step):
            yield batch.slice(a, step)


def kept_terms(rows: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term) of the terms that min_docs rows of the language hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush():
            for lang, found in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found)), pa.array(list(found), pa.binary()).cast(pa.string()),
                     pa.array(list(found.values()), pa.int64())], names=["lang", "term", "docs"])
            held.clear()

        for batch in _sliced(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                if (found := terms_of(text)):
                    held.setdefault(lang, Counter()).update(found)
                if sum(map(len, held.values())) > FLUSH_TERMS:
                    yield from flush()
        yield from flush()

    held = rows.select("lang", "text").mapInArrow(run, "lang string, term string, docs long")
    return held.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs).select("lang", "term")


def vocabulary(kept: DataFrame) -> DataFrame:
    """Sorted terms and their transducers: `lang`, `part` and `seq` (a block),
    `local` (ordinal within it), `term`; a block's last row has `packed`."""
    kept = cut_lineage(kept)
    parts = -(-kept.count() // PART_TERMS) or 1
    ranged = kept.repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, seq, held, size, made = None, 0, [], 0, None

        def closed():
            nonlocal seq, held, size, made
            n = len(held)
            out = pa.RecordBatch.from_arrays(
                [pa.array([lang] * n), pa.array([seq] * n, pa.int32()), pa.array(range(n), pa.int64()),
                 pa.array(held, pa.binary()).cast(pa.string()),
                 pa.array([None] * (n - 1) + [made.packed()], pa.binary())],
                names=["lang", "seq", "local", "term", "packed"])
            seq, held, size, made = seq + 1, [], 0, None
            return out

        for batch in batches:
            for own, term in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist()):
                if held and (own != lang or size > BLOCK_BYTES):
                    yield closed()
                lang, made, term = own, made or Builder(), term.encode()
                made.add(term)
                held.append(term)
                size += len(term)
        if held:
            yield closed()

    done = ranged.mapInArrow(run, "lang string, seq int, local long, term string, packed binary")
    return cut_lineage(done.withColumn("part", F.spark_partition_id()))


def _blocks(words: DataFrame) -> DataFrame:
    """One row per block: `first` (ordinal of its first term) and `terms`."""
    before = Window.partitionBy("lang").orderBy("part", "seq")
    return (words.where(F.col("packed").isNotNull())
            .select("lang", "part", "seq", (F.col("local") + 1).alias("terms"), F.length("packed").alias("size"))
            .withColumn("first", F.sum("terms").over(before) - F.col("terms")))


def _rounds(blocks: list) -> Iterator[list]:
    out, size = [], 0
    for b in blocks:
        if out and size + b.size > ROUND_BYTES:
            yield out
            out, size = [], 0
        out.append(b)
        size += b.size
    if out:
        yield out


def _runs(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about RUN_BYTES together."""
    first = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= RUN_BYTES:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def count_words(texts: list[bytes], groups: np.ndarray, blocks: list[tuple[int, Transducer]]):
    """(group, ordinal, count) of the terms in masked texts, sorted by group."""
    whole = np.frombuffer(b"\0".join(texts) + b"\0", dtype=np.uint8)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    letters = whole != 0
    starts = np.flatnonzero(letters & ~np.concatenate(([False], letters[:-1])))
    step = RUN_BYTES // 4
    for a in range(0, len(starts), step):
        some = starts[a:a + step]
        group = groups[np.searchsorted(begin, some, side="right") - 1]
        for first, machine in blocks:
            which, ordinal = machine.read(whole, some)
            if not len(which):
                continue
            span = int(ordinal.max()) + 1
            keys, n = np.unique(group[which] * span + ordinal, return_counts=True)
            yield keys // span, keys % span + first, n


def term_counts(rows: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, source, ordinal, n): occurrences of the kept terms, by streaming
    all texts through the transducers."""
    spark = rows.sparkSession
    schema = "lang string, source string, ordinal long, n long"
    made = []
    index = _blocks(words).orderBy("lang", "part", "seq").collect()  # a row per BLOCK_BYTES of terms
    for some in _rounds(index):
        place = {(b.part, b.seq): (b.lang, b.first) for b in some}
        chosen = words.where(F.col("packed").isNotNull()
                             & F.concat_ws(":", "part", "seq").isin([f"{p}:{s}" for p, s in place]))
        packed: dict[str, list] = {}
        for b in chosen.select("part", "seq", "packed").collect():
            lang, first = place[b.part, b.seq]
            packed.setdefault(lang, []).append((first, bytes(b.packed)))
        sent = send(spark, packed)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            known = received(sent)
            machines = {lang: None for lang in known}
            for batch in _sliced(batches):
                table: dict[tuple, list] = {}
                for lang, source, text in zip(*[batch.column(c).to_pylist() for c in ("lang", "source", "text")]):
                    if lang in known:
                        table.setdefault((lang, source), []).append(text.encode().translate(LETTERS))
                for lang in known:
                    names = [k for k in table if k[0] == lang]
                    texts = [t for k in names for t in table[k]]
                    of = np.repeat(np.arange(len(names)), [len(table[k]) for k in names])
                    if texts and machines[lang] is None:
                        machines[lang] = [(first, Transducer(b)) for first, b in known[lang]]
                    for a, b in _runs(texts):
                        for group, ordinal, n in count_words(texts[a:b], of[a:b], machines[lang]):
                            at = pa.array(group)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([lang] * len(group)), pa.array([k[1] for k in names]).take(at),
                                 pa.array(ordinal), pa.array(n)], names=["lang", "source", "ordinal", "n"])

        here = rows.where(F.col("lang").isin(list(packed)))
        counts = here.mapInArrow(run, schema).groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))
        made.append(cut_lineage(counts))
        sent.destroy()
    out = spark.createDataFrame([], schema)
    for m in made:
        out = out.unionByName(m)
    return out


def _weight(n: str, total: str, terms: str):
    """p of a term counted n times."""
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(38,0)) * CAST({n} + 2 AS DECIMAL(20,0))) "
                  f"DIV CAST({total} + 2 * {terms} AS DECIMAL(20,0))")


def _gap(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) DIV ({p} + {q})")


def pair_sums(counted: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of a language's sources.

    `counted` has (lang, ordinal, at, p), `groups` (lang, source, at, terms, p0):
    `at` numbers a language's sources and p0 is their p of an absent term.
    """
    langs = (groups.groupBy("lang").agg(F.max("terms").alias("terms"),
                                        F.sort_array(F.collect_list(F.struct("at", "p0"))).alias("all"))
             .select("lang", "terms", F.col("all.p0").alias("p0")).where(F.size("p0") > 1)
             .withColumn("wide", F.greatest(F.lit(1), F.least(F.lit(CHUNK_TERMS), F.floor(CELLS / F.size("p0"))))))
    chunks = langs.withColumn("chunk", F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr("GREATEST(terms - 1, 0) DIV wide"))))
    placed = counted.join(langs.select("lang", "wide"), "lang").select(
        "lang", F.expr("ordinal DIV wide").alias("chunk"), F.expr("ordinal % wide").alias("spot"), "at", "p")

    def run(key, found: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        lang, number = key
        row = chunk.iloc[0]
        p0 = np.asarray(row["p0"], dtype=np.int64)
        n = min(int(row["wide"]), int(row["terms"]) - int(number) * int(row["wide"]))
        weights = np.repeat(p0[:, None], max(n, 0), axis=1)
        spots = [found[c].to_numpy(dtype=np.int64) for c in ("at", "spot", "p")]
        weights[spots[0], spots[1]] = spots[2]
        first, second = np.triu_indices(len(p0), 1)
        value = np.zeros(len(first), dtype=np.int64)
        done = 0
        for i in range(len(p0) - 1):
            gap = weights[i + 1:] - weights[i]
            value[done:done + len(gap)] = (gap * gap // (weights[i + 1:] + weights[i])).sum(axis=1)
            done += len(gap)
        return pd.DataFrame({"lang": [lang] * len(value), "a": first, "b": second, "value": value})

    sums = (placed.groupBy("lang", "chunk").cogroup(chunks.groupBy("lang", "chunk"))
            .applyInPandas(run, "lang string, a int, b int, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = sums.select("lang", "value", F.explode(F.array(
        F.struct(F.col("a").alias("at"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("at"), F.col("a").alias("other")))).alias("pair")).select("lang", "value", "pair.*")
    other = groups.select("lang", F.col("at").alias("other"), F.col("source").alias("item"))
    return both.join(groups.select("lang", "at", "source"), ["lang", "at"]).join(other, ["lang", "other"]).select(
        "lang", "source", "item", "value")


def divergence(docs: DataFrame, text: str, lang: str, source: str, min_docs: int = 10, top: int = 10) -> DataFrame:
    """`lang`, `source`, `part` (pair or term), `item`, `value`, `rank`: how far
    each source is from every other source of its language, and the `top` terms
    that it has more often than its language."""
    rows = _rows_of(docs, text, lang, source)
    words = vocabulary(kept_terms(rows, min_docs))
    counts = term_counts(rows, words)
    vocabularies = _blocks(words).groupBy("lang").agg(F.sum("terms").alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    here = (rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
            .join(vocabularies, "lang", "left").fillna(0, ["total", "terms"]))
    # Numbers the sources of a language; every pair of them is a result row.
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    absent = F.when(F.col("terms") > 0, _weight("0", "total", "terms")).otherwise(1)
    groups = cut_lineage(here.select("lang", "source", "total", "terms", number.alias("at"), absent.alias("p0")))

    weighted = counts.join(groups, ["lang", "source"]).select(
        "lang", "source", "at", "ordinal", _weight("n", "total", "terms").alias("p"))
    pairs = pair_sums(weighted.select("lang", "ordinal", "at", "p"), groups)
    by_source = Window.partitionBy("lang", "source")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(
        by_source.orderBy(F.desc("value"), "item")).alias("rank"))

    whole = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.max("terms").alias("terms"))
    of_lang = (counts.groupBy("lang", "ordinal").agg(F.sum("n").alias("n")).join(whole, "lang")
               .select("lang", "ordinal", _weight("n", "total", "terms").alias("q")))
    over = (weighted.join(of_lang, ["lang", "ordinal"]).where("p > q")
            .select("lang", "source", "ordinal", _gap("p", "q").alias("value")))
    ranked = over.withColumn("rank", F.row_number().over(by_source.orderBy(F.desc("value"), "ordinal"))).where(F.col("rank") <= top)
    names = words.join(_blocks(words).select("part", "seq", "first"), ["part", "seq"]).select(
        "lang", (F.col("first") + F.col("local")).alias("ordinal"), F.col("term").alias("item"))
    terms = ranked.join(names, ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    return pairs.unionByName(terms)
