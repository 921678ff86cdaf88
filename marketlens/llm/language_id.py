"""Language identification by bit-sliced Bloom filters of letter n-grams.

The n-gram at a letter is the letter with both neighbours, anything but a letter
reading as a space; texts are lower-cased.  A language contains an n-gram that
makes up at least `min_share` of the n-grams of its labelled texts, and at least
`min_ratio` of the greatest share that any language has, so that stray foreign
words in a text, or a few wrong labels, put nothing in.  A language's filter
holds at most 1 / min_share n-grams by construction.

All languages share one table of slots with a bit per language: setting an
n-gram sets its language's bit in HASHES slots, and AND over the slots of an
n-gram gives at once all languages that contain it.  A language whose bit is set
in a share d of the slots answers d^HASHES of foreign n-grams falsely; if it
answers h of a text's n n-grams, an estimated (h - n d^H) / (1 - d^H) are its
own.  The greatest estimate decides, ties by name; the score is its share of all
languages' estimates.  If all estimates are zero, the language with most
labelled n-grams is returned with score 0.

Counts of labelled n-grams combine in the tasks and before the shuffle, so a hot
language or source meets in no task.  The table is broadcast; its size is at most
TABLE_BYTES for any number of languages and n-grams (fewer slots answer falsely
more often, which the estimates take off).

Cases: a null text, an empty one and one without a letter are `und` with score
0; with no labelled text at all every row is; rows with a null label, null text
or a null training mark teach nothing; texts of any length are read whole, in
pieces; rows that repeat, or share or lack an id, each get a result; an empty
table gives no rows; further columns pass through, and the result columns
replace columns of their names.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import received, send

MIN_SHARE = 2e-5
MIN_RATIO = 0.05
HASHES = 3
SLOTS_PER_GRAM = 24
TABLE_BYTES = 64 << 20
PIECE = 1 << 20
FLUSH_GRAMS = 1 << 20
NO_LANGUAGE = "und"
SPACE = 0x20


def letter_table() -> np.ndarray:
    """For every code point: itself if it is a letter, else a space."""
    points = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    is_letter = np.fromiter((chr(c).isalpha() for c in range(len(points))), dtype=bool, count=len(points))
    return np.where(is_letter, points, SPACE).astype(np.uint32)


def pieces(texts: list[str | None]) -> Iterator[tuple[list[int], str]]:
    """(row of each part, parts joined) with about PIECE characters each.  A part
    has one character of context at both ends; between texts that is a space."""
    rows: list[int] = []
    parts: list[str] = []
    size = 0
    for row, text in enumerate(texts):
        text = (text or "").lower()
        for a in range(0, len(text), PIECE):
            b = min(a + PIECE, len(text))
            rows.append(row)
            parts.append(f"{text[a - 1] if a else ' '}{text[a:b]}{text[b] if b < len(text) else ' '}")
            size += b - a
            if size >= PIECE:
                yield rows, parts
                rows, parts, size = [], [], 0
    if rows:
        yield rows, parts


def grams(parts: list[str], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of joined parts as numbers, and how many lie before the end of
    each part."""
    points = letters[np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.uint32)].astype(np.uint64)
    centre = points != SPACE
    ends = np.cumsum([len(p) for p in parts])
    centre[ends - 1] = False
    centre[np.concatenate(([0], ends[:-1]))] = False
    at = np.flatnonzero(centre)
    key = (points[at - 1] << np.uint64(42)) | (points[at] << np.uint64(21)) | points[at + 1]
    return key, np.searchsorted(at, ends)


def _mixed(key: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each number (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        z = key + np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


@dataclass
class Filters:
    """One slot table for all languages: bit l % 64 of word l // 64 is language l."""

    names: list[str]
    totals: np.ndarray  # labelled n-grams per language
    table: np.ndarray  # slots x words

    @property
    def false_rate(self) -> np.ndarray:
        """Per language, how often an n-gram it lacks is answered."""
        if not self.names:
            return np.zeros(0)
        full = [((self.table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(self.names))]
        return np.array(full) ** HASHES

    def slots(self, key: np.ndarray) -> Iterator[np.ndarray]:
        last = np.uint64(len(self.table) - 1)
        for i in range(1, HASHES + 1):
            yield (_mixed(key, i) & last).astype(np.int64)

    def languages(self, key: np.ndarray) -> np.ndarray:
        """The language bits of each n-gram (n-grams x words)."""
        out = None
        for at in self.slots(key):
            out = self.table[at] if out is None else out & self.table[at]
        return out


def build_filters(names: list[str], totals: list[int], members: list[tuple[int, np.ndarray]]) -> Filters:
    """Filters of the (language number, n-grams) lists."""
    words = -(-len(names) // 64) or 1
    most = max((len(k) for _, k in members), default=1)
    slots = 1 << max(10, (most * SLOTS_PER_GRAM - 1).bit_length())
    while slots * words * 8 > TABLE_BYTES and slots > 1024:
        slots //= 2
    made = Filters(names, np.array(totals, dtype=np.float64), np.zeros((slots, words), dtype=np.uint64))
    for i, key in members:
        for at in made.slots(key):
            made.table[at, i // 64] |= np.uint64(1 << (i % 64))
    return made


def gram_counts(labelled: DataFrame, text: str, lang: str, letters) -> DataFrame:
    """(lang, gram, n) over all labelled texts."""
    rows = labelled.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = received(letters)
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out(lang, key, n):
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(key), pa.string()), pa.array(key.view(np.int64)),
                                               pa.array(n)], names=["lang", "gram", "n"])

        for batch in batches:
            by: dict[str, list[str]] = {}
            for own, t in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by.setdefault(own, []).append(t)
            for own, texts in by.items():
                for _, parts in pieces(texts):
                    key, n = np.unique(grams(parts, table)[0], return_counts=True)
                    if own in held:
                        both = np.concatenate((held[own][0], key))
                        key, place = np.unique(both, return_inverse=True)
                        n = np.bincount(place, np.concatenate((held[own][1], n)), len(key)).astype(np.int64)
                    held[own] = (key, n)
                    if len(key) > FLUSH_GRAMS:
                        yield out(own, *held.pop(own))
        for own, (key, n) in held.items():
            if len(key):
                yield out(own, key, n)

    return rows.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, text: str, lang: str, min_share: float = MIN_SHARE, min_ratio: float = MIN_RATIO) -> Filters:
    """The filters of the languages of `labelled`, from all its texts.

    The driver gets at most 1 / min_share n-grams per language."""
    letters = send(labelled.sparkSession, letter_table())
    counts = gram_counts(labelled, text, lang, letters).persist()
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(totals, "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("share"))
    often = shares.where(F.col("share") >= min_share)
    most = often.groupBy("gram").agg(F.max("share").alias("most"))
    kept = often.join(most, "gram").where(F.col("share") >= min_ratio * F.col("most")).select("lang", "gram")
    sizes = {r.lang: r.total for r in totals.collect()}
    names = sorted(sizes)
    found: dict[str, list[int]] = {n: [] for n in names}
    for r in kept.toLocalIterator():
        found[r.lang].append(r.gram)
    counts.unpersist()
    return build_filters(names, [sizes[n] for n in names],
                         [(i, np.array(found[n], dtype=np.int64).view(np.uint64)) for i, n in enumerate(names)])


def predict_texts(texts: list[str | None], filters: Filters, letters: np.ndarray,
                  false_rate: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(language, score) of each text."""
    langs, total = len(filters.names), np.zeros(len(texts))
    hits = np.zeros((len(texts), langs))
    for rows, parts in pieces(texts):
        key, ends = grams(parts, letters)
        begins = np.concatenate(([0], ends[:-1]))
        np.add.at(total, rows, ends - begins)
        answers = filters.languages(key)
        for i in range(langs):
            bit = (answers[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)
            upto = np.concatenate(([0], np.cumsum(bit, dtype=np.int64)))
            np.add.at(hits[:, i], rows, upto[ends] - upto[begins])
    if not langs:
        return [NO_LANGUAGE] * len(texts), np.zeros(len(texts))
    own = np.maximum(hits - total[:, None] * false_rate, 0) / np.maximum(1 - false_rate, 1e-9)
    whole = own.sum(axis=1)
    best = own.argmax(axis=1)
    score = own[np.arange(len(texts)), best] / np.where(whole > 0, whole, 1)
    best = np.where(whole > 0, best, filters.totals.argmax())
    names = [filters.names[b] if n else NO_LANGUAGE for b, n in zip(best, total)]
    return names, np.where(total > 0, np.minimum(score, 1.0), 0.0)


def predict(df: DataFrame, text: str, filters: Filters, lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """Add the language of each text and its score (0 to 1)."""
    sent = send(df.sparkSession, (filters, letter_table(), filters.false_rate))
    gone = {lang_col.lower(), score_col.lower()}
    kept = [f for f in df.schema.fields if f.name.lower() not in gone]
    schema = T.StructType([*kept, T.StructField(lang_col, T.StringType(), False),
                           T.StructField(score_col, T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, letters, false_rate = received(sent)
        for batch in batches:
            names, score = predict_texts(batch.column(text).to_pylist(), made, letters, false_rate)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.array(names, pa.string()), pa.array(score)],
                names=[f.name for f in schema.fields])

    return df.mapInArrow(run, schema)
