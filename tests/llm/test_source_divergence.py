import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import SF_SMALL
from marketlens.llm import source_divergence as sd
from marketlens.llm.common import table
from marketlens.llm.queries import op13_source_divergence
from marketlens.llm.transducer import Builder, Transducer


def made(terms):
    b = Builder()
    for t in sorted(terms):
        b.add(t)
    return b


def read(machine, words):
    text = np.frombuffer(b"\0".join(words) + b"\0", dtype=np.uint8)
    starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
    which, ordinal = machine.read(text, starts)
    return dict(zip(which.tolist(), ordinal.tolist()))


@pytest.mark.parametrize("seed", range(6))
def test_transducer_gives_lexicographic_ordinals(seed):
    rng = random.Random(seed)
    letters = [bytes([b]) for b in ([97, 98, 99] if seed % 2 else range(128, 256))]
    terms = sorted({b"".join(rng.choices(letters, k=rng.randrange(1, 7))) for _ in range(500)})
    words = terms + [b"".join(rng.choices(letters, k=rng.randrange(1, 8))) for _ in range(500)]
    place = {t: i for i, t in enumerate(terms)}
    got = read(Transducer(made(terms).packed()), words)
    assert got == {i: place[w] for i, w in enumerate(words) if w in place}


def test_transducer_is_minimal_and_keeps_no_state_per_letter_of_shared_ends():
    terms = sorted(a + b for a in (b"walk", b"talk", b"stalk", b"chalk") for b in (b"", b"ed", b"ing", b"s"))
    b = made(terms)
    packed = b.packed()
    # Minimal: no two states accept the same endings.
    endings = []
    for final, edges in b.states:
        own = {b""} if final else set()
        for byte, child in edges:
            own |= {bytes([byte]) + e for e in endings[child]}
        endings.append(frozenset(own))
    assert len(set(endings)) == len(endings) and endings[-1] == set(terms)
    assert len(b.states) < sum(map(len, terms)) / 4 and len(packed) < 2000


def brute(rows, min_docs=10, top=10):
    docs = [(lang or "", source or "", re.findall(
        r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)})))
        for text, lang, source in rows]
    held, counts = Counter(), defaultdict(Counter)
    for lang, source, terms in docs:
        held.update((lang, t) for t in set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for (own, t), n in held.items() if own == lang and n >= min_docs]

        def weights(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = Counter()
        for (own, _), c in counts.items():
            if own == lang:
                whole.update(c)
        q, p = weights(whole), {s: weights(c) for (own, s), c in counts.items() if own == lang}
        for s in p:
            def f(a, b):
                return (a - b) ** 2 // (a + b)
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in p if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, i) for i, (v, item) in enumerate(found, 1)]
    return sorted(out)


def result(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in df.collect())


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF_SMALL, "documents").select("text", "lang", "source").collect()]
    got = result(op13_source_divergence(spark, SF_SMALL))
    assert got == brute(rows) and len({r[1] for r in got}) > 5 and {r[2] for r in got} == {"pair", "term"}


def odd_rows():
    rng = random.Random(3)
    words = ["the", "The", "É", "é", "a", "ab", "abc", "ça", "x1y", "日本語", "z" * 400, "𝄞𝄞"]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(0, 30))), rng.choice(["en", "fr", None, ""]),
             rng.choice(["s1", "s2", "S1", None, "é"])) for _ in range(200)]
    rows += [rows[0]] * 30 + [(None, "en", "s9"), ("", "xx", "s1"), ("only once", "xx", "s2"), (None, None, None),
                              ("1 2 3", "yy", "s1"), ("abc. " * 200_000, "en", "s1")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "c") for r in rows], "text string, lang string, source string, "
                                 "value int, rank int, term string")


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = odd_rows()
    assert result(sd.divergence(frame(spark, rows), "text", "lang", "source", 10, 10)) == brute(rows)
    assert result(sd.divergence(frame(spark, rows), "text", "lang", "source", 10**6, 10)) == brute(rows, 10**6)
    assert sd.divergence(frame(spark, rows).limit(0), "text", "lang", "source").collect() == []


def test_many_blocks_rounds_and_chunks_give_the_same(spark, monkeypatch):
    rows = odd_rows()
    for name, small in (("BLOCK_BYTES", 8), ("ROUND_BYTES", 600), ("RUN_BYTES", 64), ("CHUNK_TERMS", 2),
                        ("PART_TERMS", 5), ("FLUSH_TERMS", 10)):
        monkeypatch.setattr(sd, name, small)
    assert result(sd.divergence(frame(spark, rows), "text", "lang", "source", 10, 3)) == brute(rows, 10, 3)
