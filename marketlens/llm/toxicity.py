"""Toxicity scores from a subsequence string kernel and a support vector machine
on Nyström landmarks.

Kernel: two words are alike when they share character subsequences of length
three, each weighted by DECAY to the power of the span it covers, up to a span
of five, so a gap or an inserted character only weakens a match.  Words start
with a blank that counts as a character.  The value is divided by a function of
each word's length, which keeps it a kernel.

Training (on the driver, on a bounded sample: at most `MAX_TOXIC` + `MAX_CLEAN`
labelled texts, the ones with the smallest hash of their id): the most telling
words and the most mistaken ones become landmarks, words become Nyström features, and a linear machine is
fitted by subgradient steps on the hinge loss.  Each toxic text is a bag of
which one word, its best so far, is the positive example; the highest scored
words of clean texts are added as negatives after each round.  Positive
words also train with one inserted letter.  A text's score is the logistic of
its best word's value.

Scoring: the machine's weights over the landmarks fold into one table indexed by
the hashed subsequence, since the kernel is a dot product of subsequence counts.
Texts are read as one stream of characters in numpy, whole, in bounded pieces.

Cases: characters that are neither letters, digits nor blanks are skipped
(`i.d.i.o.t`), and blanks between single letters too (`i d i o t`).  Null texts
and texts without words get the score of the lowest value.  Toxic and clean texts
count in the logistic by their share of all training labels, whatever the sample
holds of each.  Where no model can be fitted (labels of one kind only, or no word
that tells) every text has the same score and `Model.fitted` is false: a score
of all labels' toxic share says nothing of a text, so a filter has to keep it.
Texts of any length are read whole.  Repeated
rows are each scored; an empty table gives no rows; further columns pass
through, and the result column replaces one of its name.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import received, send

DECAY = 0.6
SPAN = 5
SHORT = 7
TABLE_BITS = 16
MAX_TOXIC = 1500
MAX_CLEAN = 2500
LANDMARKS = 128
MAX_NEGATIVES = 20_000
ROUNDS = 3
SURPRISE = 8.0
STREAM_CHARS = 1 << 17
LOWEST = -3.0
GAPS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


@dataclass
class Model:
    """`table[k]` holds the weight of hashed subsequences of span k + 3."""
    table: np.ndarray
    bias: float
    slope: float
    shift: float
    constant: float | None = None

    @property
    def fitted(self) -> bool:
        return self.constant is None

    def probability(self, value: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(value), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * value + self.shift, -30, 30)))


def character_kinds() -> np.ndarray:
    """For each code below 65536: 0 skipped, 1 letter or digit, 2 blank."""
    kinds = np.zeros(65536, dtype=np.uint8)
    for c in range(65536):
        s = chr(c)
        kinds[c] = 2 if s.isspace() else 1 if s.isalnum() else 0
    kinds[65535] = 1  # stands for all codes above, and counts as a letter
    return kinds


def stream(texts: list[str], kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, word starts' text numbers).  A word is a blank and its letters;
    each text's words follow one another."""
    parts = [" " + t.lower() + " " for t in texts]
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint32)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    kind = kinds[np.minimum(codes, 65535)]
    used = kind > 0
    codes, owner, blank = codes[used], owner[used], kind[used] == 2
    last = np.append(blank[1:], True)
    used = ~(blank & last)  # of several blanks, the one before a letter
    codes, owner, blank = codes[used], owner[used], blank[used]
    if len(codes) > 2:
        single_before = np.append([False, False], blank[:-2] & (owner[:-2] == owner[2:]))
        single_after = np.append(blank[2:], [True, True])
        used = ~(blank & single_before & single_after)
        codes, owner, blank = codes[used], owner[used], blank[used]
    codes = np.where(blank, np.uint32(32), codes)
    return codes, owner


def word_values(codes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, start) of each word of a stream under a weight table."""
    blank = codes == 32
    starts = np.flatnonzero(blank)
    if not len(starts):
        return np.zeros(0), starts
    n = len(codes)
    first, second, third = (codes * f for f in _FACTORS)
    clear = ~blank
    total = np.zeros(n, dtype=np.float32)
    inside = np.ones(n, dtype=bool)
    for b in range(1, SPAN):
        if n <= b:
            break
        inside = inside[:n - b] & clear[b:]
        for a in range(1, b):
            h = first[:n - b] + second[a:n - b + a] + third[b:]
            total[:n - b] += table[b - 2][h >> np.uint32(32 - TABLE_BITS)] * inside
    sums = np.add.reduceat(total, starts)
    lengths = np.diff(np.append(starts, n))
    return sums / length_norm(lengths), starts


def length_norm(lengths: np.ndarray) -> np.ndarray:
    """Square root of the squared weights of a word's subsequences; words under
    SHORT count as that long, so a mere beginning of an insult stays weak."""
    total = np.zeros(len(lengths))
    lengths = np.maximum(lengths, SHORT)
    for _, b in GAPS:
        total += np.maximum(0, lengths - b) * DECAY ** (2 * (b + 1))
    return np.sqrt(np.maximum(total, 1e-6))


def word_table(word: str) -> np.ndarray:
    """Weight table whose value on other words is the kernel with `word`."""
    codes = np.array([32, *map(ord, word)], dtype=np.uint32)
    table = np.zeros((SPAN - 2, 1 << TABLE_BITS), dtype=np.float32)
    counts: dict[int, float] = {}
    for a, b in GAPS:
        for i in range(len(codes) - b):
            h = (int(codes[i]) * int(_FACTORS[0]) + int(codes[i + a]) * int(_FACTORS[1])
                 + int(codes[i + b]) * int(_FACTORS[2])) % (1 << 32) >> (32 - TABLE_BITS)
            counts[h] = counts.get(h, 0.0) + DECAY ** (b + 1)
    norm = length_norm(np.array([len(codes)]))[0]
    for h, v in counts.items():
        for b in range(2, SPAN):
            table[b - 2, h] = v * DECAY ** (b + 1) / norm
    return table


def text_words(texts: list[str], kinds: np.ndarray) -> list[list[str]]:
    """Distinct normalised words of each text, in order of their first place."""
    codes, owner = stream(texts, kinds)
    out: list[dict[str, None]] = [{} for _ in texts]
    starts = np.flatnonzero(codes == 32)
    chars = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    for a, b, o in zip(starts.tolist(), [*starts[1:].tolist(), len(codes)], owner[starts].tolist()):
        if b - a > 3:
            out[o][chars[a + 1:b]] = None
    return [list(w) for w in out]


def _values(words: list[str], table: np.ndarray) -> np.ndarray:
    """Value of each word, some thousand at a time."""
    out = [np.zeros(0)]
    for i in range(0, len(words), 8192):
        text = "".join(" " + w for w in words[i:i + 8192])
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        out.append(word_values(codes.astype(np.uint32), table)[0])
    return np.concatenate(out)


def surprise(a: np.ndarray, n: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Log-likelihood ratio of being in `a` of the toxic and `n` of the clean
    texts, 0 for what is not more frequent in toxic ones."""
    share = (a + n) / (toxic + clean)
    up = a * np.log(np.maximum(a, 1e-9) / np.maximum(toxic * share, 1e-9))
    down = n * np.log(np.maximum(n, 1e-9) / np.maximum(clean * share, 1e-9))
    return np.where(a * clean > n * toxic, up + down, 0.0)


def with_insertions(word: str) -> list[str]:
    """The word with one foreign letter after each of its inner letters."""
    return [word[:i] + "xzqk"[i % 4] + word[i:] for i in range(2, len(word))] if len(word) > 3 else []


def fit(bags: list[tuple[int, list[str]]], toxic_share: float | None = None) -> Model:
    """Model from (label, distinct words) of the sampled texts; `toxic_share` is
    that of all labels (default: the sample's)."""
    number: dict[str, int] = {}
    toxic, clean = ([np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
                     for y, words in bags if y == k] for k in (1, 0))
    empty = np.zeros((SPAN - 2, 1 << TABLE_BITS), dtype=np.float32)
    if toxic_share is None:
        toxic_share = len(toxic) / max(1, len(bags))
    if not toxic or not clean:
        return Model(empty, 0.0, 0.0, 0.0, toxic_share)
    vocab = np.array(list(number), dtype=object)
    in_toxic, in_clean = (np.bincount(np.concatenate([np.zeros(0, np.int64), *part]), minlength=len(vocab))
                          for part in (toxic, clean))
    value = surprise(in_toxic, in_clean, len(toxic), len(clean))
    for k in (4, 5, 6):  # beginnings that many telling words share are telling as well
        starts: dict[str, int] = {}
        stem = np.array([starts.setdefault(w[:k], len(starts)) if len(w) > k else -1 for w in vocab], dtype=np.int64)
        counts = [np.bincount(np.concatenate([np.zeros(0, np.int64), *(np.unique(stem[b][stem[b] >= 0]) for b in part)]),
                              minlength=len(starts) + 1) for part in (toxic, clean)]
        value = np.maximum(value, np.where(stem >= 0, surprise(*counts, len(toxic), len(clean))[stem], 0.0))
    best = [b[value[b].argmax()] for b in toxic if len(b)]
    witness = [i for i in best if value[i] >= SURPRISE]
    if not witness:
        return Model(empty, 0.0, 0.0, 0.0, toxic_share)
    many = Counter(witness)
    ranked = [vocab[i] for i in sorted(many, key=lambda i: (-value[i] * many[i], vocab[i]))]
    common = [vocab[i] for i in np.argsort(-in_clean, kind="stable")[:MAX_NEGATIVES // 4] if in_clean[i]]
    landmarks: list[str] = []  # their tables are large and soon made, so none is held

    def add_landmarks(pool: list[str], most: int) -> None:
        """Up to `most` landmarks in all, in the pool's order, that are not
        close to one another."""
        near = np.max([np.zeros(len(pool)), *(_values(pool, word_table(w)) for w in landmarks)], axis=0)
        for i, w in enumerate(pool):
            if len(landmarks) >= most:
                break
            if near[i] < 0.8:
                landmarks.append(w)
                near = np.maximum(near, _values(pool, word_table(w)))

    def inverse_root() -> np.ndarray:
        kmm = np.stack([_values(landmarks, word_table(w)) for w in landmarks], axis=1)
        val, vec = np.linalg.eigh((kmm + kmm.T) / 2)
        return vec @ np.diag(np.where(val > 1e-4, np.maximum(val, 1e-4) ** -0.5, 0)) @ vec.T

    def features(words: list[str]) -> np.ndarray:
        return np.stack([_values(words, word_table(w)) for w in landmarks], axis=1) @ root

    add_landmarks(ranked, LANDMARKS // 2)
    add_landmarks(common, LANDMARKS * 3 // 4)
    seen_clean = np.flatnonzero(in_clean)
    clean_words = [vocab[i] for i in seen_clean]
    negatives = dict.fromkeys(common)
    negatives.update(dict.fromkeys(clean_words[::max(1, len(clean_words) // (MAX_NEGATIVES // 2))]))
    for _ in range(ROUNDS):
        root = inverse_root()
        many = Counter(vocab[i] for i in witness)
        pos = sorted(many)
        changed = [(v, many[w] / max(1, len(w) - 2)) for w in pos for v in with_insertions(w) if v not in number]
        neg = list(negatives)
        x = np.vstack([features(pos), features([v for v, _ in changed]) if changed else np.zeros((0, len(landmarks))),
                       features(neg)])
        share = np.array([many[w] for w in pos] + [n for _, n in changed], dtype=float)
        y = np.array([1.0] * len(share) + [-1.0] * len(neg))
        # A word of many clean texts would be wrong many times.
        often = np.array([in_clean[number[v]] for v in neg], dtype=float)
        share = np.concatenate([share / share.sum(), often / often.sum() + 2 / len(neg)])
        w, bias = hinge(x, y, share)
        table = sum((a * word_table(m) for a, m in zip((root @ w).astype(np.float32), landmarks)), empty)
        values = _values(list(vocab), table) + bias
        worst = seen_clean[np.argsort(-values[seen_clean], kind="stable")[:MAX_NEGATIVES // 8]]
        negatives.update(dict.fromkeys(vocab[worst]))
        wrong = [vocab[i] for i in worst if values[i] > -0.5]
        add_landmarks(wrong, min(LANDMARKS, len(landmarks) + LANDMARKS // 8))
        again = [i for i in (b[values[b].argmax()] for b in toxic if len(b)) if values[i] > 0 and value[i] > 0]
        witness = again or witness
    top = np.array([max(LOWEST, values[b].max()) if len(b) else LOWEST for b in toxic + clean])
    weight = np.array([toxic_share / len(toxic)] * len(toxic) + [(1 - toxic_share) / len(clean)] * len(clean))
    slope, shift = logistic(top, np.array([1.0] * len(toxic) + [0.0] * len(clean)), weight)
    return Model(table, float(bias), slope, shift)


def hinge(x: np.ndarray, y: np.ndarray, share: np.ndarray, steps: int = 500, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear machine by subgradient steps with Adam-like scaling, averaged
    over the second half."""
    w, g1, g2 = np.zeros(x.shape[1] + 1), 0.0, 0.0
    xb = np.hstack([x, np.ones((len(x), 1))])
    mean, taken = np.zeros_like(w), 0
    for t in range(1, steps + 1):
        active = y * (xb @ w) < 1
        g = -(xb[active] * (y * share)[active, None]).sum(axis=0)
        g[:-1] += penalty * w[:-1]
        g1, g2 = 0.9 * g1 + 0.1 * g, 0.999 * g2 + 0.001 * g * g
        w = w - 0.05 * (1 - t / (steps + 1)) * (g1 / (1 - 0.9 ** t)) / (np.sqrt(g2 / (1 - 0.999 ** t)) + 1e-8)
        if t > steps // 2:
            mean, taken = mean + w, taken + 1
    w = mean / taken
    return w[:-1], float(w[-1])


def logistic(value: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 3000) -> tuple[float, float]:
    """Slope and shift by gradient steps; the weights add up to one."""
    slope, shift = 2.0, 0.0
    goal = np.where(y > 0, 1 - 1 / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(slope * value + shift, -30, 30)))
        slope -= 0.5 * float(((p - goal) * value) @ weight)
        shift -= 0.5 * float((p - goal) @ weight)
    return max(slope, 0.5), shift


def train(docs: DataFrame, labels: DataFrame, row_id: str = "doc_id", text: str = "text",
          label: str = "toxic") -> Model:
    """Fit on a bounded sample of the labelled rows given (`labels` holds only
    rows that may be learned from)."""
    marked = labels.select(F.col(f"`{row_id}`").alias("id"), F.col(f"`{label}`").alias("y")).where(
        F.col("id").isNotNull() & F.col("y").isin(0, 1))
    pick = [marked.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n)
            for y, n in ((1, MAX_TOXIC), (0, MAX_CLEAN))]
    sample = F.broadcast(pick[0].unionByName(pick[1]).distinct())  # at most MAX_TOXIC + MAX_CLEAN rows
    rows = docs.select(F.col(f"`{row_id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(sample, "id")
    kinds = character_kinds()

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = text_words([t or "" for t in batch.column("text").to_pylist()], kinds)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("y").cast(pa.int32()), pa.array(bags, pa.list_(pa.string()))],
                names=["id", "y", "words"])

    kind = rows.schema["id"].dataType.simpleString()
    bags = rows.mapInArrow(words, f"id {kind}, y int, words array<string>")
    # Of rows that repeat an id, one: the sample stays within its bound.
    one = bags.groupBy("id", "y").agg(F.min("words").alias("words")).collect()
    share = marked.agg(F.avg(F.col("y").cast("double"))).first()[0] or 0.0
    return fit([(r["y"], r["words"]) for r in sorted(one, key=lambda r: (r["id"], r["y"]))], share)


def score(df: DataFrame, text: str, model: Model, out: str = "score") -> DataFrame:
    """Add `out`, the probability of toxicity, by a narrow pass."""
    fields = [f for f in df.schema.fields if f.name.lower() != out.lower()]
    schema = T.StructType(fields + [T.StructField(out, T.DoubleType(), False)])
    sent = send(df.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, kinds = received(sent), character_kinds()
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            best = np.full(len(texts), LOWEST)
            for first, last in pieces(texts):
                codes, owner = stream(texts[first:last], kinds)
                values, starts = word_values(codes, m.table)
                np.maximum.at(best, owner[starts] + first, values + m.bias)
            keep = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n.lower() != out.lower()]
            yield pa.RecordBatch.from_arrays([c for _, c in keep] + [pa.array(m.probability(best))],
                                             names=[n for n, _ in keep] + [out])

    return df.mapInArrow(run, schema)


def pieces(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about STREAM_CHARS characters."""
    first = held = 0
    for i, t in enumerate(texts):
        held += len(t) + 2
        if held >= STREAM_CHARS:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)
