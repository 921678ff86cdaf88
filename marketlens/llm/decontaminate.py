"""Benchmark decontamination by spaced-seed hashing.

Texts become words (ASCII letters lower-cased, ASCII punctuation and blanks
separate).  A seed is a fixed mask over consecutive words; positions marked 0
are ignored.  Seeds of the test items and of the documents are joined on their
hashes, and each hit is verified on its diagonal: a document leaks an item when
some `WINDOW` aligned words hold at most `MISMATCHES` substitutions.  The two
masks together hit every such window (checked in the tests), so verification
sees every leak.

The test items are the stated query set: they are cut into segments, dealt
into blocks of bounded size, and each block is joined with all documents in one
narrow pass over whole texts.  No document is shuffled.

Cases: items of fewer words than the window must appear whole and unchanged;
items under `SHORTEST` words cannot be told from chance and never match; null
and empty texts match nothing; items with equal words are all reported; an
empty table on either side gives no leaks.  Rows and columns of the documents
pass through, repeated rows included; a very long text is searched whole, in the
task that reads it; the result column replaces one of the same name.  Item ids
are whole numbers.
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, received, send

MASKS = ("11101011", "110100111")
WINDOW = 13
MISMATCHES = 2
SHORTEST = 5
SEGMENT_WORDS = 4096
BLOCK_WORDS = 1_000_000
BATCH_WORDS = 1 << 19

_SEPARATORS = string.punctuation
_TABLE = bytes.maketrans(string.ascii_uppercase.encode() + _SEPARATORS.encode(),
                         string.ascii_lowercase.encode() + b" " * len(_SEPARATORS))
LEAK = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()),
                                 T.StructField("first_word", T.IntegerType(), False),
                                 T.StructField("end_word", T.IntegerType(), False)]), False)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def _text_bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


class Index:
    """Seeds and words of one block of test segments."""

    def __init__(self, segments: list[tuple[int | None, bytes]]):
        ids = defaultdict(set)
        for item, text in segments:
            ids[tuple(text.split())].add(item)
        self.vocab: dict[bytes, int] = {}
        self.items: list[np.ndarray] = []
        self.ids: list[list[int | None]] = []
        for words, owners in sorted(ids.items()):
            codes = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words]
            self.items.append(np.array(codes, dtype=np.int64))
            self.ids.append(sorted(owners, key=lambda i: (i is None, i)))
        rng = np.random.default_rng(7)
        self.factors = rng.integers(1, 2**63, size=WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.seeds = []
        for mask in [*MASKS, *("1" * n for n in range(SHORTEST, WINDOW))]:
            offsets = [i for i, c in enumerate(mask) if c == "1"]
            hashes, places = [], []
            for i, codes in enumerate(self.items):
                if (len(codes) < WINDOW) != (len(mask) == len(codes) and "0" not in mask):
                    continue
                at = np.arange(max(0, len(codes) - len(mask) + 1))
                hashes.append(self.hash(codes, at, offsets))
                places.append(np.stack([np.full(len(at), i), at], axis=1))
            if hashes:
                h, p = np.concatenate(hashes), np.concatenate(places)
                order = np.argsort(h, kind="stable")
                keys, first, n = np.unique(h[order], return_index=True, return_counts=True)
                self.seeds.append((offsets, keys, first, n, p[order]))

    def hash(self, codes: np.ndarray, at: np.ndarray, offsets: list[int]) -> np.ndarray:
        h = np.zeros(len(at), dtype=np.uint64)
        for k, o in enumerate(offsets):
            h = (h ^ codes[at + o].astype(np.uint64)) * self.factors[k]
            h ^= h >> np.uint64(29)
        return h

    def leaks(self, texts: list[list[bytes]]) -> list[list[tuple[int | None, int, int]]]:
        """Leaks of each text: (item id, first word, end word) in the text."""
        out: list[list] = [[] for _ in texts]
        gap = [0] * WINDOW
        get, codes, starts = self.vocab.get, [], []
        for words in texts:
            starts.append(len(codes))
            codes += [get(w, 0) for w in words]
            codes += gap
        c = np.array(codes, dtype=np.int64)
        begin = np.array(starts, dtype=np.int64)
        known = c != 0
        hits = set()
        for offsets, keys, first, n, places in self.seeds:
            size = len(c) - offsets[-1]
            if size <= 0:
                continue
            ok = known[:size].copy()
            for o in offsets[1:]:
                ok &= known[o:o + size]
            at = np.flatnonzero(ok)
            h = self.hash(c, at, offsets)
            slot = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = keys[slot] == h
            at, slot = at[hit], slot[hit]
            if not len(at):
                continue
            reps = n[slot]
            step = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
            place = places[np.repeat(first[slot], reps) + step]
            # The gap is longer than every mask, so a hit lies in one document.
            at = np.repeat(at, reps)
            doc = np.searchsorted(begin, at, side="right") - 1
            hits.update(zip(place[:, 0].tolist(), doc.tolist(), (at - place[:, 1]).tolist()))
        if not hits:
            return out
        found: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
        for item, d, diagonal in hits:
            codes_i = self.items[item]
            lo, hi = int(begin[d]), int(begin[d]) + len(texts[d])
            a, b = max(lo, diagonal), min(hi, diagonal + len(codes_i))
            size = min(WINDOW, len(codes_i))
            if b - a < size:
                continue
            same = np.concatenate([[0], np.cumsum(c[a:b] == codes_i[a - diagonal:b - diagonal])])
            need = size - (MISMATCHES if len(codes_i) >= WINDOW else 0)
            good = np.flatnonzero(same[size:] - same[:-size] >= need)
            if len(good):
                cuts = np.flatnonzero(np.diff(good) > size) + 1
                for run in np.split(good, cuts):
                    found[d, item].append((a + int(run[0]) - lo, a + int(run[-1]) + size - lo))
        for (d, item), spans in sorted(found.items()):
            merged: list[list[int]] = []
            for s, e in sorted(spans):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            out[d] += [(i, s, e) for i in self.ids[item] for s, e in merged]
        return out


def segments(bench: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, words, n): the items' words in overlapping bounded segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, value in zip(batch.column("item").to_pylist(), _text_bytes(batch.column("text"))):
                words = words_of(value)
                if len(words) >= SHORTEST:
                    step = SEGMENT_WORDS - WINDOW
                    last = max(1, len(words) - WINDOW)
                    rows += [(item, b" ".join(words[i:i + SEGMENT_WORDS]), len(words[i:i + SEGMENT_WORDS]))
                             for i in range(0, last, step)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                 pa.array([r[2] for r in rows], pa.int64())], names=["item_id", "words", "n"])

    rows = bench.select(F.col(f"`{item_id}`").cast("long").alias("item"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "item_id long, words binary, n long")


def find_leaks(docs: DataFrame, text: str, bench: DataFrame, bench_id: str = "item_id",
               bench_text: str = "text", out: str = "leaks", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Add `out`: the test items each document leaks, with the word spans."""
    spark = docs.sparkSession
    parts = segments(bench, bench_id, bench_text)
    total = parts.agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    docs = docs.drop(out)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, LEAK, False)])
    result = docs
    for k in range(blocks):
        rows = parts.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == k).select("item_id", "words").collect()
        index = send(spark, Index([(r[0], bytes(r[1])) for r in rows]))
        result = _join_block(result, text, index, out, schema)
    return result


def _join_block(docs: DataFrame, text: str, index, out: str, schema: T.StructType) -> DataFrame:
    before = out in docs.columns
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("first_word", pa.int32()), ("end_word", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("item_id", "first_word", "end_word")
        ix = received(index)
        for batch in batches:
            found: list[list] = []
            group: list[list[bytes]] = []
            held = 0
            for value in _text_bytes(batch.column(text)):
                group.append(words_of(value))
                held += len(group[-1])
                if held >= BATCH_WORDS:
                    found += ix.leaks(group)
                    group, held = [], 0
            found += ix.leaks(group)
            new = [[dict(zip(names, x)) for x in row] for row in found]
            if before:
                new = [a + b for a, b in zip(batch.column(out).to_pylist(), new)]
            keep = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n != out]
            yield pa.RecordBatch.from_arrays([c for _, c in keep] + [pa.array(new, kind)],
                                             names=[n for n, _ in keep] + [out])

    return docs.mapInArrow(run, schema)


def clean(docs: DataFrame, text: str, bench: DataFrame, bench_id: str = "item_id",
          bench_text: str = "text") -> DataFrame:
    """The documents that leak no test item, with their own columns."""
    out = free_name(docs, "leaks")
    return find_leaks(docs, text, bench, bench_id, bench_text, out).where(F.size(out) == 0).drop(out)
