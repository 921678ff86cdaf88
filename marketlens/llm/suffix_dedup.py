"""Removal of byte strings that occur twice, by a distributed merge sort of
sampled suffixes.

A byte is removed when it lies in a string of `LENGTH` bytes (a window) that
also starts anywhere else, in the same text or another.  Sorting every suffix
is not needed: a window's anchor is the position of the smallest hashed
`GRAM`-byte string that starts in its first `SAMPLE` bytes.  The anchor depends
on nothing but the window's bytes, so equal windows have anchors at equal
offsets, and their suffixes from the anchor share `CORE` bytes.

1. Anchors of all texts are counted by the hash of those `CORE` bytes; an anchor
   whose hash is met once cannot belong to a repeated window.
2. Each remaining anchor becomes one key: the suffix from the anchor to the end
   of its last window, then the bytes before it, backwards, to the start of its
   first window.  Tasks sort their keys and send them as front-coded runs to
   range partitions, whose borders come from a bounded sample of keys.
3. A partition combines its runs with a loser tree that remembers for each
   loser the prefix it shares with the winner: of two keys, the one that shares
   more with the last output is the smaller, and only ties are compared, from
   the end of the known prefix on.  The order puts equal keys and equal cores
   next to each other.
4. Equal keys of two places repeat all their windows; a run sends on only two
   places of a key, and the others' ranges past the merge.  Different keys of one
   core are resolved window by window, in the partition.  Where a border cuts a
   core, or a core has very many keys, one of each different window left also
   goes by its 128-bit hash into an aggregate over all parts, so no frequent
   passage meets in one task.

Texts are identified by a 128-bit content key.  Equal texts enter once and, at
`LENGTH` bytes or more, are removed whole.  Texts cross the network compressed.

Cases: a null text is empty; texts under `LENGTH` bytes stay as they are;
repeated rows count as further texts, so they are removed if long enough; null
or repeated ids each get their row; an empty table gives no rows; further
columns are ignored; a very long text is read whole, in overlapping pieces, by
one task that holds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, text_key

LENGTH = 200
SAMPLE = 128
GRAM = 16
CORE = LENGTH - SAMPLE + 1
SAMPLE_KEYS, PART_SAMPLE = 20_000, 16
PART_BYTES = 64 << 20
KEY_BYTES = LENGTH + SAMPLE  # about the longest usual key
RUN_KEYS = 50_000
RUN_PLACES = 200_000
CLASS_KEYS = 4096
OUT_ROWS = 50_000
CHUNK = 1 << 19
PLACES = np.uint64((1 << 24) - 1)  # a chunk holds under 2 * CHUNK + LENGTH bytes


def _mix(h: np.ndarray, x: np.ndarray) -> np.ndarray:
    h = (h ^ x) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _eights(buf: np.ndarray, n: int) -> np.ndarray:
    """The eight bytes from each of the first n positions, as integers."""
    return np.ndarray((n,), dtype="<u8", buffer=buf, strides=(1,))


def anchors(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, anchor, first window, last window, core hash) of each text
    that has windows; texts go through in chunks of about CHUNK bytes, longer
    ones in overlapping pieces."""
    pieces: list[tuple[int, int, bytes]] = []
    held = 0
    for i, t in enumerate(texts):
        for at in range(0, max(0, len(t) - LENGTH + 1), CHUNK):
            piece = t[at:at + CHUNK + LENGTH - 1]
            pieces.append((i, at, piece))
            held += len(piece)
            if held >= CHUNK:
                yield from _chunk_anchors(pieces)
                pieces, held = [], 0
    if pieces:
        yield from _chunk_anchors(pieces)


def _chunk_anchors(pieces: list[tuple[int, int, bytes]]) -> Iterator[tuple]:
    size = np.array([len(p) for _, _, p in pieces])
    end = np.cumsum(size)
    begin = end - size
    n = int(end[-1])
    buf = np.frombuffer(b"".join(p for _, _, p in pieces) + bytes(LENGTH), dtype=np.uint8)
    eight = _eights(buf, n + GRAM)
    low = _mix(_mix(np.full(n, 7, np.uint64), eight[:n]), eight[8:n + 8])
    # The place in the low bits finds the smallest, and of equals the first.
    low = (low & ~PLACES) | np.arange(n, dtype=np.uint64)
    span = 1
    while span * 2 <= SAMPLE:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if SAMPLE > span:
        low = np.minimum(low[:span - SAMPLE], low[SAMPLE - span:])
    open_ = np.zeros(n + 1, dtype=np.int32)
    np.add.at(open_, begin, 1)
    np.add.at(open_, end - LENGTH + 1, -1)
    window = np.cumsum(open_)[:len(low)] > 0
    place = np.where(window, (low & PLACES).astype(np.int64), -1)
    first = np.flatnonzero(np.diff(place, prepend=-2))
    last = np.append(first[1:], len(place)) - 1
    keep = place[first] >= 0
    first, last = first[keep], last[keep]
    anchor = place[first]
    core = np.full(len(anchor), 11, np.uint64)
    for o in [*range(0, CORE - 8, 8), CORE - 8]:
        core = _mix(core, eight[anchor + o])
    core = core.view(np.int64)
    cut = np.searchsorted(first, [*begin, n])
    for k, (i, at, _) in enumerate(pieces):
        a, b = cut[k], cut[k + 1]
        shift = at - begin[k]
        yield i, anchor[a:b] + shift, first[a:b] + shift, last[a:b] + shift, core[a:b]


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which `known` bytes are known."""
    n = min(len(a), len(b))
    if a[known:n] == b[known:n]:
        return n
    step = 8
    while a[known:known + step] == b[known:known + step]:
        known += step
        step *= 2
    while step > 1:
        step //= 2
        if a[known:known + step] == b[known:known + step]:
            known += step
    return known


class Run:
    """A sorted run: front-coded distinct keys, each with its places."""

    @staticmethod
    def pack(keys: list[bytes], places: list[list[tuple[int, int, int]]]) -> bytes:
        lcp, rest = [], []
        before = b""
        for k in keys:
            h = shared_prefix(before, k, 0)
            lcp.append(h)
            rest.append(k[h:])
            before = k
        flat = np.array([p for ps in places for p in ps], dtype="<i8")
        counts = np.array([len(p) for p in places], dtype="<u4")
        return b"".join([np.array([len(keys), len(flat)], dtype="<u4").tobytes(),
                         np.array(lcp, dtype="<u2").tobytes(), np.array([len(r) for r in rest], dtype="<u2").tobytes(),
                         counts.tobytes(), flat.tobytes(), *rest])

    @staticmethod
    def read(block: bytes) -> Iterator[tuple[int, bytes, np.ndarray]]:
        """(length shared with the key before, key, places) in order."""
        n, m = np.frombuffer(block, "<u4", 2).tolist()
        at = 8
        lcp = np.frombuffer(block, "<u2", n, at).tolist()
        size = np.frombuffer(block, "<u2", n, at + 2 * n).tolist()
        counts = np.frombuffer(block, "<u4", n, at + 4 * n).tolist()
        places = np.frombuffer(block, "<i8", 3 * m, at + 8 * n).reshape(m, 3)
        at += 8 * n + 24 * m
        key, p = b"", 0
        for h, s, c in zip(lcp, size, counts):
            key = key[:h] + block[at:at + s]
            at += s
            yield h, key, places[p:p + c]
            p += c


def merge(runs: list[Iterator[tuple[int, bytes, np.ndarray]]]) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Runs combined by a loser tree; the shared length is with the key before."""
    width = 1
    while width < len(runs):
        width *= 2
    key: list[bytes | None] = [None] * width
    data: list = [None] * width
    loser, prefix = [0] * width, [0] * width

    def advance(i: int) -> int:
        item = next(runs[i], None) if i < len(runs) else None
        if item is None:
            key[i] = None
            return 0
        key[i], data[i] = item[1], item[2]
        return item[0]

    def match(a: int, ha: int, b: int, hb: int) -> tuple[int, int, int, int]:
        """(winner, its prefix, loser, the prefix it shares with the winner)."""
        ka, kb = key[a], key[b]
        if kb is None:
            return a, ha, b, 0
        if ka is None:
            return b, hb, a, 0
        if ha > hb:
            return a, ha, b, hb
        if hb > ha:
            return b, hb, a, ha
        h = shared_prefix(ka, kb, ha)
        if h == len(ka) or h < len(kb) and ka[h] < kb[h]:
            return a, ha, b, h
        return b, hb, a, h

    won = [(i, 0) for i in range(width)]
    for i in range(len(runs)):
        advance(i)
    top = width
    while top > 1:
        up = []
        for j in range(0, top, 2):
            (a, ha), (b, hb) = won[j], won[j + 1]
            w, hw, lo, hl = match(a, ha, b, hb)
            loser[top // 2 + j // 2], prefix[top // 2 + j // 2] = lo, hl
            up.append((w, hw))
        won, top = up, top // 2
    w, h = won[0]
    while key[w] is not None:
        yield h, key[w], data[w]
        h = advance(w)
        node = (w + width) // 2
        while node:
            w, h, loser[node], prefix[node] = match(w, h, loser[node], prefix[node])
            node //= 2


def key_of(text: bytes, anchor: int, first: int, last: int) -> bytes:
    """Suffix from the anchor, the bytes before it backwards, and where the
    one ends (so that different windows never give equal keys)."""
    right = text[anchor:last + LENGTH]
    return right + text[first:anchor][::-1] + len(right).to_bytes(2, "big")


def window_bytes(key: bytes) -> tuple[bytes, int]:
    """The bytes of all windows of a key, and the anchor's place in them."""
    n = int.from_bytes(key[-2:], "big")
    left = key[n:-2][::-1]
    return left + key[:n], len(left)


def repeated(entries: list[tuple[bytes, list]], others: list | None = None) -> Iterator[tuple[int, int, int, int]]:
    """(k1, k2, start, end) repeated within the keys of one core.  A place that
    two runs hold counts once.

    Where further keys of the core lie elsewhere, `others` gets one (hash, k1,
    k2, start) of each different window, to be compared with theirs."""
    entries = [(key, places if len(places) == 1 else sorted(set(places))) for key, places in entries]
    for key, places in entries:
        if len(places) > 1:
            size = len(key) - 2
            before = size - int.from_bytes(key[-2:], "big")
            for k1, k2, a in places:
                yield k1, k2, a - before, a - before + size
    if others is None and (len(entries) < 2 or all(len(p) > 1 for _, p in entries)):
        return
    import xxhash

    digest = xxhash.xxh3_128_digest
    seen: dict[bytes, int] = {}
    lone = []
    for key, places in entries:
        text, before = window_bytes(key)
        marks = [digest(text[i:i + LENGTH]) for i in range(len(text) - LENGTH + 1)]
        k1, k2, a = places[0]
        for i, m in enumerate(marks):
            seen[m] = seen.get(m, 0) + 1
            if others is not None and seen[m] == 1:
                others.append((m, k1, k2, a - before + i))
        if len(places) == 1:
            lone.append((marks, before, places[0]))
    for marks, before, (k1, k2, a) in lone:
        hit = np.flatnonzero([seen[m] > 1 for m in marks])
        if len(hit):
            for run in np.split(hit, np.flatnonzero(np.diff(hit) > 1) + 1):
                yield k1, k2, a - before + int(run[0]), a - before + int(run[-1]) + LENGTH


def _texts(df: DataFrame, text: str) -> DataFrame:
    """k1, k2 and the compressed bytes of the texts, repeats within a task left
    out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            rows = []
            for k1, k2, t in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(),
                                 batch.column("text").cast(pa.binary())):
                if (k1, k2) not in seen:
                    seen.add((k1, k2))
                    rows.append((k1, k2, _squeeze(t.as_buffer())))
            yield _rows(rows, [("k1", pa.int64()), ("k2", pa.int64()), ("squeezed", pa.binary())])

    k1, k2 = text_key(F.col(f"`{text}`"))
    rows = df.select(k1.alias("k1"), k2.alias("k2"), F.col(f"`{text}`").alias("text"))
    return rows.where(F.octet_length("text") >= LENGTH).mapInArrow(run, "k1 long, k2 long, squeezed binary")


def _squeeze(data) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unsqueeze(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _rows(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)],
                                      names=[n for n, _ in fields])


def _anchor_rows(df: DataFrame, text: str) -> DataFrame:
    """(core, k1, place) of all anchors, a text once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            keys = list(zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist()))
            fresh = []
            for i, k in enumerate(keys):
                if k not in seen:
                    seen.add(k)
                    fresh.append(i)
            column = batch.column("text").cast(pa.binary())
            for a in range(0, len(fresh), 1024):
                part = fresh[a:a + 1024]
                found = list(anchors([column[i].as_py() for i in part]))
                if found:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate([f[4] for f in found])),
                        pa.array(np.repeat([keys[part[f[0]]][0] for f in found], [len(f[1]) for f in found])),
                        pa.array(np.concatenate([f[1] for f in found]).astype(np.int32))],
                        names=["core", "k1", "place"])

    k1, k2 = text_key(F.col(f"`{text}`"))
    rows = df.select(k1.alias("k1"), k2.alias("k2"), F.col(f"`{text}`").alias("text"))
    return rows.where(F.octet_length("text") >= LENGTH).mapInArrow(run, "core long, k1 long, place int")


def candidates(df: DataFrame, text: str) -> DataFrame:
    """(k1, places) of the anchors whose core hash is met again."""
    rows = _anchor_rows(df, text)
    # Stored, so that the join below can split a core that very many texts hold.
    again = cut_lineage(rows.groupBy("core").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("core"))
    met = rows.join(again, "core", "left_semi")
    return cut_lineage(met.groupBy("k1").agg(F.collect_set("place").alias("places")))


def _keys(t: bytes, places: np.ndarray) -> Iterator[tuple[bytes, int]]:
    """(key, anchor) of a text's candidate anchors."""
    for _, anchor, first, last, _ in anchors([t]):
        pick = np.flatnonzero(np.isin(anchor, places))
        for a, f, e in zip(anchor[pick].tolist(), first[pick].tolist(), last[pick].tolist()):
            yield key_of(t, a, f, e), a


def borders(df: DataFrame, text: str, cands: DataFrame, least: int) -> list[bytes]:
    """Keys that cut the sampled keys into equal shares, `least` of them or as
    many as keep a share near PART_BYTES of keys, so that a part does not grow
    with the input.

    The sample (SAMPLE_KEYS keys, or PART_SAMPLE a part if that is more) decides
    balance only, never the result."""
    total = cands.agg(F.sum(F.size("places"))).first()[0] or 0
    parts = max(least, -(-total * KEY_BYTES // PART_BYTES))
    every = max(1, total // max(SAMPLE_KEYS, PART_SAMPLE * parts))
    some = (cands.select("k1", F.explode("places").alias("place"))
            .where(F.pmod(F.xxhash64("k1", "place"), F.lit(every)) == 0)
            .groupBy("k1").agg(F.collect_list("place").alias("places")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _rows([(key,) for t, p in zip(batch.column("text").cast(pa.binary()), batch.column("places"))
                         for key, _ in _keys(t.as_py(), np.asarray(p.values))], [("key", pa.binary())])

    k1, _ = text_key(F.col(f"`{text}`"))
    rows = df.select(k1.alias("k1"), F.col(f"`{text}`").alias("text"))
    drawn = rows.join(F.broadcast(some), "k1").select("text", "places").mapInArrow(run, "key binary")
    keys = sorted(bytes(r[0]) for r in drawn.distinct().collect())  # copies of a text give its keys once
    cuts = {keys[len(keys) * i // parts] for i in range(1, parts)} if keys else set()
    return sorted(cuts)


def sorted_runs(texts: DataFrame, cands: DataFrame, cuts: list[bytes]) -> DataFrame:
    """(part, run): the candidate keys as sorted, front-coded runs.

    A key with two places is repeated, so a run sends on no more than two; the
    ranges of the others are known and go, by text, to parts under 0."""
    from bisect import bisect_right

    def flush(held: dict[bytes, set]) -> Iterator[pa.RecordBatch]:
        keys = sorted(held)
        places = [sorted(held[k]) for k in keys]
        rows, a = _packed_ranges(keys, places, len(cuts) + 1), 0
        while a < len(keys):
            part = bisect_right(cuts, keys[a])
            b = len(keys) if part == len(cuts) else _first_from(keys, cuts[part], a)
            rows.append((part, Run.pack(keys[a:b], [p[:2] for p in places[a:b]])))
            a = b
        yield _rows(rows, [("part", pa.int32()), ("run", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, set] = {}
        n = 0
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for k1, k2, s, p in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(),
                                    batch.column("squeezed"), batch.column("places")):
                if (k1, k2) in seen:
                    continue
                seen.add((k1, k2))
                for key, a in _keys(_unsqueeze(s.as_py()), np.asarray(p.values)):
                    held.setdefault(key, set()).add((k1, k2, a))
                    n += 1
                if len(held) >= RUN_KEYS or n >= RUN_PLACES:
                    yield from flush(held)
                    held, n = {}, 0
        if held:
            yield from flush(held)

    met = texts.join(cands.hint("shuffle_hash"), "k1").select("k1", "k2", "squeezed", "places")
    return met.mapInArrow(run, "part int, run binary")


def _packed_ranges(keys: list[bytes], places: list[list[tuple[int, int, int]]], parts: int) -> list[tuple[int, bytes]]:
    """(part, packed ranges) of the places beyond the first two of each key."""
    dealt: dict[int, list[tuple[int, int, int, int]]] = {}
    for key, ps in zip(keys, places):
        if len(ps) > 2:
            size = len(key) - 2
            before = size - int.from_bytes(key[-2:], "big")
            for k1, k2, a in ps[2:]:
                dealt.setdefault(-1 - k1 % parts, []).append((k1, k2, a - before, a - before + size))
    return [(part, np.array(rows, dtype="<i8").tobytes()) for part, rows in dealt.items()]


def _first_from(keys: list[bytes], cut: bytes, start: int) -> int:
    from bisect import bisect_left

    return bisect_left(keys, cut, start)


def combine(runs: DataFrame, cuts: list[bytes]) -> DataFrame:
    """Merge each part's runs.  Gives repeated ranges (k1, k2, start, end) and,
    with the hash (d1, d2) set, windows that other parts may repeat."""
    cut_cores = {c[:CORE] for c in cuts}
    fields = [("d1", pa.int64()), ("d2", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()),
              ("start", pa.int32()), ("end", pa.int32())]

    def run(table: pa.Table) -> pa.Table:
        if table.column("part")[0].as_py() < 0:
            known = np.concatenate([np.frombuffer(b.as_buffer(), "<i8").reshape(-1, 4) for b in table.column("run")])
            none = pa.nulls(len(known), pa.int64())
            return pa.Table.from_arrays([none, none, *(pa.array(known[:, i], t) for i, t in enumerate(
                (pa.int64(), pa.int64(), pa.int32(), pa.int32())))], names=[n for n, _ in fields])
        done: list[pa.RecordBatch] = []  # results, compact
        out: list[tuple] = []
        entries: list[tuple[bytes, list]] = []
        wide = False

        def spread() -> None:
            others: list[tuple] = []
            out.extend((None, None, *r) for r in repeated(entries, others))
            out.extend((int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True),
                        k1, k2, a, a + LENGTH) for d, k1, k2, a in others)
            entries.clear()

        def close() -> None:
            if len(out) >= OUT_ROWS:
                done.append(_rows(out, fields))
                out.clear()
            if wide:
                spread()
            else:
                out.extend((None, None, *r) for r in repeated(entries))
                entries.clear()

        readers = [Run.read(b.as_py()) for b in table.column("run")]
        for shared, key, places in merge(readers):
            found = list(map(tuple, places.tolist()))
            if entries and shared == len(key) and entries[-1][0] == key:
                entries[-1][1].extend(found)
                continue
            if shared < CORE:
                close()
                wide = key[:CORE] in cut_cores
            elif len(entries) >= CLASS_KEYS:
                wide = True
                last = entries.pop()  # equal keys may still follow
                close()
                entries.append(last)
            entries.append((key, found))
        close()
        return pa.Table.from_batches([*done, _rows(out, fields)])

    return runs.groupBy("part").applyInArrow(
        run, "d1 long, d2 long, k1 long, k2 long, start int, end int")


def repeated_ranges(df: DataFrame, text: str) -> DataFrame:
    """(k1, k2, start, end): byte ranges of texts, by content key, that windows
    repeated elsewhere cover."""
    cands = candidates(df, text)
    texts = _texts(df, text)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = borders(df, text, cands, parts)
    # Dealt anew: the part of a frequent passage gives far more rows than others.
    found = cut_lineage(combine(sorted_runs(texts, cands, cuts), cuts).repartition("k1", "k2", "start"))
    windows = found.where(F.col("d1").isNotNull())
    again = cut_lineage(windows.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"))
                        .where("n > 1").select("d1", "d2"))
    across = windows.join(again, ["d1", "d2"], "left_semi")
    ranges = found.where(F.col("d1").isNull()).unionByName(across).select("k1", "k2", "start", "end")
    k1, k2 = text_key(F.col(f"`{text}`"))
    copies = (df.where(F.octet_length(F.col(f"`{text}`")) >= LENGTH)
              .groupBy(k1.alias("k1"), k2.alias("k2"))
              .agg(F.count(F.lit(1)).alias("n"), F.first(F.octet_length(F.col(f"`{text}`"))).alias("end"))
              .where("n > 1").select("k1", "k2", F.lit(0).alias("start"), "end"))
    return ranges.unionByName(copies)


def cut_texts(df: DataFrame, text: str) -> DataFrame:
    """(k1, k2, n_bytes, spans, kept) of each different text that loses bytes:
    the maximal removed byte ranges and the remaining bytes."""
    ranges = repeated_ranges(df, text).groupBy("k1", "k2").agg(
        F.collect_set(F.struct("start", "end")).alias("ranges"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            rows = []
            for k1, k2, s, r in zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(),
                                    batch.column("squeezed"), batch.column("ranges")):
                if (k1, k2) in seen:
                    continue
                seen.add((k1, k2))
                t = _unsqueeze(s.as_py())
                merged: list[list[int]] = []
                for a, b in sorted((x["start"], x["end"]) for x in r.as_py()):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                edges = [0, *(e for m in merged for e in m), len(t)]
                rows.append((k1, k2, len(t), [{"start": a, "end": b} for a, b in merged],
                             b"".join(t[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2))))
            yield _rows(rows, [("k1", pa.int64()), ("k2", pa.int64()), ("n_bytes", pa.int64()),
                               ("spans", span), ("kept", pa.binary())])

    met = _texts(df, text).join(ranges.hint("shuffle_hash"), ["k1", "k2"])
    return met.mapInArrow(cut, "k1 long, k2 long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")


def with_cuts(df: DataFrame, row_id: str, text: str, cuts: DataFrame, keep: dict[str, F.Column],
              whole: dict[str, F.Column]) -> DataFrame:
    """One row per input row: its id and the columns `keep` derived from its
    text's cut, or `whole` derived from the text (`text`, null read as empty)
    where nothing is cut.

    Texts stay where they are; what is derived from the cuts joins them by
    content key."""
    k1, k2 = text_key(F.col(f"`{text}`"))
    rows = df.select(F.col(f"`{row_id}`").alias("id"), k1.alias("k1"), k2.alias("k2"),
                     F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    rows = rows.select("id", "k1", "k2", *[c.alias(f"__{n}") for n, c in whole.items()])
    found = cuts.select("k1", "k2", F.lit(True).alias("__cut"), *[c.alias(n) for n, c in keep.items()])
    # A text that two tasks held is cut twice, alike.
    found = cut_lineage(found.dropDuplicates(["k1", "k2"]))
    met = rows.join(found, ["k1", "k2"], "left")
    return met.select("id", *[F.when(F.col("__cut"), F.col(n)).otherwise(F.col(f"__{n}")).alias(n) for n in keep])


def remove_repeats(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """(id, n_bytes, spans, kept): for each row the maximal removed byte ranges
    and the remaining bytes."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    return with_cuts(df, row_id, text, cut_texts(df, text),
                     {"n_bytes": F.col("n_bytes"), "spans": F.col("spans"), "kept": F.col("kept")},
                     {"n_bytes": F.octet_length("text").cast("long"), "spans": none, "kept": F.col("text").cast("binary")})
