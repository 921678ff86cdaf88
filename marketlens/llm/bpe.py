"""Byte-level BPE encoding and decoding with the tokenizers library.

`encode` runs the tokenizer over Arrow batches.  The byte-level alphabet (each
byte shown as one printable character) is built by rule, the merges are derived
from the rank file, and every match of the splitting pattern is encoded by
itself.  `decode` gathers the bytes of the ids from one flat table, so a
character that is split over several tokens comes back whole.

Cases: a null text is empty (no ids, no bytes).  Very long texts are processed
whole, a bounded number of characters at a time; repeated rows and ids each get
their row; an empty table gives no rows.  Other columns pass through; an output
column takes the place of an input column of the same name.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH_CHARS = 1 << 18


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a rank file (base64 token, rank in each line)."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    tokens: list[bytes] = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def byte_alphabet() -> list[str]:
    """The character of each byte: printable Latin-1 bytes show as themselves,
    the others as the code points from 256 on, in byte order."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def merges_of(tokens: list[bytes]) -> list[tuple[bytes, bytes]]:
    """The pair whose merge makes each token: the last two parts left when only
    merges of lower rank are applied to its bytes."""
    rank = {t: i for i, t in enumerate(tokens)}
    out = []
    for i, token in enumerate(tokens):
        if len(token) < 2:
            continue
        parts = [token[j:j + 1] for j in range(len(token))]
        while len(parts) > 2:
            best = min(range(len(parts) - 1), key=lambda j: rank.get(parts[j] + parts[j + 1], len(tokens)))
            if rank.get(parts[best] + parts[best + 1], len(tokens)) >= i:
                break
            parts[best:best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) == 2:
            out.append((parts[0], parts[1]))
    return out


def build_tokenizer(tokens: list[bytes], pattern: str | None):
    """Tokenizer that splits texts by `pattern`; None: each input is one match."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    shown = byte_alphabet()
    name = lambda b: "".join(shown[x] for x in b)
    tok = Tokenizer(models.BPE(vocab={name(t): i for i, t in enumerate(tokens)},
                               merges=[(name(a), name(b)) for a, b in merges_of(tokens)]))
    as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    tok.pre_tokenizer = as_bytes if pattern is None else pre_tokenizers.Sequence(
        [pre_tokenizers.Split(Regex(pattern), "isolated"), as_bytes])
    return tok


class PieceEncoder:
    """Packed ids of whole texts: each distinct match of the pattern goes
    through the tokenizer once, and a bounded cache keeps its packed ids."""

    def __init__(self, tok, pattern: str, most: int = 300_000):
        import regex

        self.tok, self.split, self.most = tok, regex.compile(pattern).findall, most
        self.cache: dict[str, bytes] = {}

    def packed(self, texts: list[str]) -> list[bytes]:
        pieces = [self.split(t) for t in texts]
        new = list(set().union(*pieces).difference(self.cache))
        if len(self.cache) + len(new) > self.most:
            self.cache.clear()
            new = list(set().union(*pieces))
        for i in range(0, len(new), 4096):
            part = new[i:i + 4096]
            for piece, enc in zip(part, self.tok.encode_batch_fast(part, add_special_tokens=False)):
                self.cache[piece] = np.array(enc.ids, dtype="<u4").tobytes()
        get = self.cache.__getitem__
        return [b"".join(map(get, p)) for p in pieces]


def byte_table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All token bytes end to end, and where each token starts."""
    starts = np.zeros(len(tokens) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in tokens], out=starts[1:])
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), starts


def decode_ids(ids: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> bytes:
    """The bytes of `ids`, gathered at once."""
    if not len(ids):
        return b""
    lengths = starts[ids + 1] - starts[ids]
    ends = np.cumsum(lengths)
    step = np.repeat(starts[ids] - (ends - lengths), lengths)
    return flat[step + np.arange(ends[-1])].tobytes()


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about BATCH_CHARS together, to bound what is held."""
    first = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= BATCH_CHARS:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _with(batch: pa.RecordBatch, new: dict[str, pa.Array], drop: tuple[str, ...] = ()) -> pa.RecordBatch:
    gone = {n.lower() for n in (*new, *drop)}
    keep = [(n, c) for n, c in zip(batch.schema.names, batch.columns) if n.lower() not in gone]
    return pa.RecordBatch.from_arrays([c for _, c in keep] + list(new.values()),
                                      names=[n for n, _ in keep] + list(new))


def _out_schema(df: DataFrame, new: list[T.StructField], drop: tuple[str, ...] = ()) -> T.StructType:
    gone = {n.lower() for n in (*(f.name for f in new), *drop)}
    return T.StructType([f for f in df.schema.fields if f.name.lower() not in gone] + new)


def _tokenizer(serialized: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task's own core only
    from tokenizers import Tokenizer

    return Tokenizer.from_str(serialized)


def encode(df: DataFrame, text: str, vocabulary: str, pattern: str, ids: str = "ids",
           offsets: str | None = None, decoded: str | None = None, keep_text: bool = True) -> DataFrame:
    """Add `ids`, the token ids as little-endian unsigned 32-bit integers in one
    binary value (numpy, Arrow and files read it without a list per row).

    With `offsets`, also add the first character position of every token, in
    the same layout; a token that starts inside a character has the position
    of that character.  With `decoded`, also add the bytes that the ids decode
    to, in the same pass.  `vocabulary` is read on the driver and sent along.
    """
    sc = df.sparkSession.sparkContext
    tokens = read_ranks(vocabulary)
    made = sc.broadcast(build_tokenizer(tokens, pattern if offsets else None).to_str())
    table = sc.broadcast(byte_table(tokens))
    new = [T.StructField(n, T.BinaryType(), False) for n in (ids, offsets, decoded) if n]
    drop = () if keep_text else (text,)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(made.value)
        pieces = PieceEncoder(tok, pattern)
        flat, starts = table.value
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            for a, b in _groups(texts):
                out: dict[str, list[bytes]] = {}
                if offsets:
                    found = tok.encode_batch(texts[a:b], add_special_tokens=False)
                    out[ids] = [np.array(e.ids, dtype="<u4").tobytes() for e in found]
                    out[offsets] = [np.array([o[0] for o in e.offsets], dtype="<u4").tobytes() for e in found]
                else:
                    out[ids] = pieces.packed(texts[a:b])
                if decoded:
                    out[decoded] = [decode_ids(np.frombuffer(v, dtype="<u4").astype(np.int64), flat, starts)
                                    for v in out[ids]]
                yield _with(batch.slice(a, b - a), {n: pa.array(v, pa.binary()) for n, v in out.items()}, drop)

    return df.mapInArrow(run, _out_schema(df, new, drop))


def decode(df: DataFrame, ids: str, vocabulary: str, decoded: str = "decoded") -> DataFrame:
    """Add `decoded`, the bytes of packed ids (null ids: empty)."""
    table = df.sparkSession.sparkContext.broadcast(byte_table(read_ranks(vocabulary)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, starts = table.value
        for batch in batches:
            out = [decode_ids(np.frombuffer(v or b"", dtype="<u4").astype(np.int64), flat, starts)
                   for v in batch.column(ids).to_pylist()]
            yield _with(batch, {decoded: pa.array(out, pa.binary())})

    return df.mapInArrow(run, _out_schema(df, [T.StructField(decoded, T.BinaryType(), False)]))


def round_trip(df: DataFrame, text: str, vocabulary: str, pattern: str) -> DataFrame:
    """Ids of each text, their number, and the bytes that the ids decode to, in
    one pass and without the text."""
    done = encode(df, text, vocabulary, pattern, decoded="decoded", keep_text=False)
    return done.withColumn("n_tokens", F.expr("octet_length(ids) div 4"))
