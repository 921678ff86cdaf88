from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from marketlens.llm import language_id as li
from marketlens.llm.common import table
from marketlens.llm.queries import held_out, op12_language_id

LETTERS = li.letter_table()


def plain_grams(text):
    points = [c if c.isalpha() else " " for c in f" {(text or '').lower()} "]
    return ["".join(points[i - 1:i + 2]) for i in range(1, len(points) - 1) if points[i] != " "]


def number(gram):
    a, b, c = map(ord, gram)
    return a << 42 | b << 21 | c


TEXTS = ["The cat", "", None, "x", "ÀÉ ß-ö", "日本語 テスト", "a1b2c3", "\n\t ", "𝄞𝔞x İI", "aaa " * 50]


@pytest.mark.parametrize("piece", [1, 2, 3, 1 << 20])
def test_grams_of_pieces_equal_plain_ones(monkeypatch, piece):
    monkeypatch.setattr(li, "PIECE", piece)
    got = defaultdict(list)
    for rows, parts in li.pieces(TEXTS):
        key, ends = li.grams(parts, LETTERS)
        for row, a, b in zip(rows, np.concatenate(([0], ends[:-1])), ends):
            got[row] += key[a:b].tolist()
    for i, t in enumerate(TEXTS):
        assert sorted(got[i]) == sorted(map(number, plain_grams(t)))


def test_filters_miss_nothing_and_their_false_answers_are_as_estimated():
    rng = np.random.default_rng(1)
    members = [(i, rng.integers(0, 2**62, 3000 + 40 * i).astype(np.uint64)) for i in range(70)]
    made = li.build_filters([f"l{i:02}" for i in range(70)], [1] * 70, members)
    foreign = rng.integers(0, 2**62, 200_000).astype(np.uint64)
    answers = made.languages(foreign)
    for i, key in members:
        bit = np.uint64(i % 64)
        assert ((made.languages(key)[:, i // 64] >> bit) & np.uint64(1)).all()
        false = ((answers[:, i // 64] >> bit) & np.uint64(1)).mean()
        assert abs(false - made.false_rate[i]) < 0.2 * made.false_rate[i] + 1e-4
    assert made.table.nbytes <= li.TABLE_BYTES


def test_the_table_stays_within_its_bytes(monkeypatch):
    monkeypatch.setattr(li, "TABLE_BYTES", 16384)
    made = li.build_filters(["a", "b"], [1, 1], [(0, np.arange(9000, dtype=np.uint64)), (1, np.arange(5, dtype=np.uint64))])
    assert made.table.nbytes == 16384


def exact(rows, texts, share=li.MIN_SHARE, ratio=li.MIN_RATIO):
    """Predictions with exact sets instead of filters."""
    counts = defaultdict(Counter)
    for text, lang in rows:
        if text is not None and lang is not None:
            counts[lang].update(plain_grams(text))
    counts = {k: c for k, c in counts.items() if c}
    total = {k: sum(c.values()) for k, c in counts.items()}
    most = Counter()
    for k, c in counts.items():
        for g, n in c.items():
            most[g] = max(most[g], n / total[k])
    sets = {k: {g for g, n in c.items() if n / total[k] >= share and n / total[k] >= ratio * most[g]} for k, c in counts.items()}
    out = []
    for t in texts:
        found = plain_grams(t)
        own = {k: sum(g in s for g in found) for k, s in sorted(sets.items())}
        if not found or not sets:
            out.append((li.NO_LANGUAGE, 0.0))
        elif not sum(own.values()):
            out.append((max(sorted(total), key=lambda k: total[k]), 0.0))
        else:
            best = max(own, key=lambda k: own[k])
            out.append((best, own[best] / sum(own.values())))
    return out


def test_query_equals_exact_sets(spark):
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text", "lang", held_out("doc_id").alias("held")).collect()
    want = exact([(r.text, r.lang) for r in docs if not r.held], [r.text for r in docs])
    got = {r.doc_id: r for r in op12_language_id(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    same = 0
    for r, (lang, score) in zip(docs, want):
        assert got[r.doc_id].held_out == r.held and abs(got[r.doc_id].score - score) < 0.02
        same += got[r.doc_id].lang_pred == lang
    assert same >= 0.99 * len(docs)


def test_held_out_accuracy(spark):
    done = op12_language_id(spark, SF_ORACLE).join(table(spark, SF_ORACLE, "documents").select("doc_id", "lang"), "doc_id")
    right = done.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.97


ROWS = [(1, "the cat sat on the mat and the hat", "en"), (2, "le chat est sur la table et la chaise", "fr"),
        (3, None, "en"), (4, "", "fr"), (5, "the the the", None), (6, "123 %%", "de"), (None, "the mat", "fr"),
        (7, "the cat", "en"), (7, "the cat", "en"), (8, "日本", None), (9, "la chaise " * 300_000, None)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, 0.5, "x") for r in rows], "doc_id long, text string, lang string, score double, LANG_PRED string")


def test_odd_rows_and_clashing_columns(spark):
    got = li.predict(frame(spark), "text", li.train(frame(spark).where("doc_id < 3"), "text", "lang"))
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    rows = got.collect()
    assert [(r.doc_id, r.text) for r in rows] == [r[:2] for r in ROWS]
    assert [r.lang_pred for r in rows] == ["en", "fr", "und", "und", "en", "und", "en", "en", "en", "fr", "fr"]
    assert all(0 <= r.score <= 1 for r in rows) and [rows[i].score for i in (2, 3, 5, 9)] == [0, 0, 0, 0]


def test_nothing_learned_and_empty_tables(spark):
    none = li.train(frame(spark).limit(0), "text", "lang")
    assert {r.lang_pred for r in li.predict(frame(spark), "text", none).collect()} == {"und"}
    only = li.train(frame(spark, [(1, None, "en"), (2, "abc", None)]), "text", "lang")
    assert {r.lang_pred for r in li.predict(frame(spark), "text", only).collect()} == {"und"}
    assert li.predict(frame(spark).limit(0), "text", none).collect() == []


def test_held_out_labels_change_nothing(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents")
    other = docs.withColumn("lang", F.when(held_out("doc_id"), F.lit("zz")).otherwise(F.col("lang")))
    other.write.parquet(f"{tmp_path}/documents.parquet")
    a = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in op12_language_id(spark, SF_SMALL).collect()}
    b = {r.doc_id: (r.lang_pred, round(r.score, 9)) for r in op12_language_id(spark, str(tmp_path)).collect()}
    assert a == b
