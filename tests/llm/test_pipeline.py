"""The pipeline against a plain-Python version of its stages."""

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import brute
import corpus_pipeline
from conftest import SF_ORACLE
from marketlens.llm import bpe, toxicity
from marketlens.llm.queries import LONG_RECURRING_FROM, RECURRING_FROM, TOXIC_FROM, VOCABULARY, toxicity_model

TOKENS = bpe.read_ranks(VOCABULARY)
OWN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                        mergeable_ranks={t: i for i, t in enumerate(TOKENS)}, special_tokens={})


def expected(spark, sf_dir):
    docs = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    model, kinds = toxicity_model(spark, sf_dir), toxicity.character_kinds()

    def score(text):
        codes, _ = toxicity.stream([text or ""], kinds)
        v, _ = toxicity.word_values(codes, model.table)
        return model.probability(np.array([max([toxicity.LOWEST, *(v + model.bias)])]))[0]

    docs = [d for d in docs if score(d["text"]) < TOXIC_FROM]
    gone = brute.recurring([d["text"] for d in docs], RECURRING_FROM, LONG_RECURRING_FROM)
    for d in docs:
        d["text"], _, lost = brute.without(d["text"], gone)
        if lost:
            d["n_chars"] = len(d["text"])
    docs.sort(key=lambda d: d["doc_id"])
    _, classes = brute.components([(d["doc_id"], d["text"]) for d in docs])
    first = {}
    for d, c in zip(docs, classes):
        first.setdefault(c, d)
    docs = [d for d in first.values() if not brute.leaks(d["text"], items)]
    return {d["doc_id"]: (d["text"], d["lang"], d["source"], d["n_chars"], OWN.encode_ordinary(d["text"])) for d in docs}


def test_pipeline_equals_brute_force(spark):
    want = expected(spark, SF_ORACLE)
    rows = corpus_pipeline.run(spark, SF_ORACLE).collect()
    got = {r.doc_id: (r.text, r.lang, r.source, r.n_chars, np.frombuffer(r.ids, "<u4").tolist()) for r in rows}
    assert len(got) == len(rows)
    assert got == want
    assert all(r.n_tokens * 4 == len(r.ids) for r in rows)


ODD = [(1, "alpha beta gamma", "en", "s", 16), (2, "delta epsilon", "en", "s", 13), (None, None, None, None, None),
       (None, None, None, None, None), (3, "alpha beta gamma", "en", None, 16), (3, "alpha beta gamma", "en", None, 16),
       (4, "", "en", "s", 0), (5, "zeta " * 50_000, "fr", "s", 250_000), (6, "one two three four five six seven", None, "s", 33)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = [(1, None), (2, ""), (3, "one two three four five six seven")]


def odd_tables(spark, folder, labels):
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")


@pytest.mark.parametrize("labels", [[(1, 0, 0), (2, 1, 1)], [(1, 0, 1), (2, 0, 1)], [(1, 0, 0)], []])
def test_odd_rows_reach_every_stage(spark, scratch, labels):
    """Stage by stage against brute force: labels that allow no model keep all rows."""
    odd_tables(spark, scratch, labels)
    docs = [dict(zip(corpus_pipeline.COLUMNS, r)) for r in ODD]
    now, stages = spark.createDataFrame(ODD, SCHEMA), dict(corpus_pipeline.STAGES)

    def run(name):
        nonlocal now
        stages[name](spark, now, scratch).write.parquet(f"{scratch}/{name}")
        now = spark.read.parquet(f"{scratch}/{name}")
        return now.collect()

    def key(rows):
        return sorted((tuple(r[c] for c in corpus_pipeline.COLUMNS) for r in rows), key=repr)

    assert key(run("toxicity")) == key(docs)
    gone = brute.recurring([d["text"] for d in docs], RECURRING_FROM, LONG_RECURRING_FROM)
    assert not gone and key(run("line_dedup")) == key(docs)
    one = run("simhash_near_dedup")
    rows, classes = brute.components([(d["doc_id"], d["text"]) for d in docs])
    assert len(one) == len(set(classes))
    for c in set(classes):
        ids = [d["doc_id"] for d, x in zip(docs, classes) if x == c and d["doc_id"] is not None]
        assert sum(r.doc_id == (min(ids) if ids else None) for r in one) == 1
    clean = run("decontamination")
    assert key(clean) == key([r for r in one if not brute.leaks(r.text, ITEMS)]) and len(clean) == len(one) - 1
    out = stages["byte_bpe"](spark, now, scratch).collect()
    assert len(out) == len(clean)
    want = {r.doc_id: OWN.encode_ordinary(r.text or "") for r in clean}
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in out} == want


def test_stages_keep_the_columns_of_an_empty_table(spark, scratch):
    odd_tables(spark, scratch, [(1, 0, 0), (2, 1, 1)])
    now = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, scratch)
        assert now.columns == corpus_pipeline.COLUMNS, name
    assert corpus_pipeline.STAGES[-1][1](spark, now, scratch).count() == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "byte_bpe"]
