import numpy as np
from pyspark.sql import functions as F

from marketlens.llm import toxicity as X
from marketlens.llm.queries import op8_toxicity

SF = "/root/testdata/sf0.1"
KINDS = X.character_kinds()


def kernel(a, b):
    return float(X._values([b], X.word_table(a))[0])


def test_kernel_tolerates_gaps():
    same, gap, other = kernel("worthless", "worthless"), kernel("worthless", "worxthless"), kernel("worthless", "harbour")
    assert same > gap > other and abs(kernel("idiots", "moron") - kernel("moron", "idiots")) < 1e-6
    words = ["idiot", "moron", "scum", "worthless", "trash", "harbours", "gardening", "aaaa"]
    gram = np.array([[kernel(a, b) for b in words] for a in words])
    assert np.linalg.eigvalsh((gram + gram.T) / 2).min() > -1e-5  # a kernel: no negative direction


def test_stream_joins_what_was_spread():
    assert X.text_words(["You i.d.i.o.t", "i d i o t s", "", "a  cat"], KINDS) == [["you", "idiot"], ["idiots"], [], ["cat"]]


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = op8_toxicity(spark, SF).join(labels, "doc_id").where("held_out").collect()
    hit = sum(r.predicted == 1 and r.toxic == 1 for r in got)
    assert len(got) > 500
    assert hit / sum(r.predicted for r in got) > 0.7  # 0.78 measured on this small table
    assert hit / sum(r.toxic for r in got) > 0.8


def small(spark):
    clean = ["the harbour was quiet", "a garden of roses", "we read books at night", "boats lay in the bay"]
    rude = ["you are an idiot", "what a moron he is", "such worthless trash", "idiot and moron alike"]
    rows = [(i, clean[i % 4] + f" number {i}") for i in range(200)] + [(1000 + i, f"{rude[i % 4]} said {i}") for i in range(60)]
    labels = [(i, int(i >= 1000)) for i, _ in rows]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_small_table_with_edge_rows(spark):
    docs, labels = small(spark)
    labels = labels.union(spark.createDataFrame([(None, 1), (3, None), (5, 0)], labels.schema))
    model = X.train(docs, labels)
    rows = [(1, "you id1iot", "k"), (2, None, "k"), (3, "", "k"), (4, "quiet roses", "k"), (4, "quiet roses", "k"),
            (None, "IDIOT", "k"), (5, "i-d-i-o-t", "k"), (6, "boats " * 100_000 + "moron", "k"), (7, "!!! ...", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, SCORE string")
    out = X.score(df, "text", model)
    assert out.columns == ["doc_id", "text", "score"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    score = {r.text: r.score for r in got}
    assert min(score["IDIOT"], score["i-d-i-o-t"], score[rows[7][1]]) > score["quiet roses"]
    assert max(score[None], score[""], score["quiet roses"], score["!!! ..."]) < 0.3
    assert X.score(df.limit(0), "text", model).count() == 0


def test_without_labels_of_both_kinds(spark):
    docs, labels = small(spark)
    for part, want in ((labels.limit(0), 0.0), (labels.where("toxic = 0"), 0.0), (labels.where("toxic = 1"), 1.0)):
        model = X.train(docs, part)
        assert not model.fitted
        assert {r.score for r in X.score(docs, "text", model).select("score").distinct().collect()} == {want}


def test_scores_do_not_depend_on_neighbours():
    model = X.Model(np.random.default_rng(1).normal(size=(X.SPAN - 2, 1 << X.TABLE_BITS)).astype(np.float32), 0.1, 1.0, 0.0)
    texts = ["alpha beta", "", "c d e f", "gamma", "x", "i i"]
    alone = []
    for t in texts:
        codes, _ = X.stream([t], KINDS)
        v, _ = X.word_values(codes, model.table)
        alone.append(v.max() if len(v) else None)
    codes, owner = X.stream(texts, KINDS)
    v, starts = X.word_values(codes, model.table)
    best = {}
    for o, x in zip(owner[starts].tolist(), v.tolist()):
        best[o] = max(x, best.get(o, -9e9))
    assert [best.get(i) for i in range(len(texts))] == [None if a is None else float(a) for a in alone]


def by_enumeration(a, b):
    """The kernel of two words by listing their subsequences, before scaling."""
    def counts(w):
        w, out = " " + w, {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + X.SPAN)):
                    key = (w[i], w[j], w[k], k - i)
                    out[key] = out.get(key, 0) + 1
        return out

    ca, cb = counts(a), counts(b)
    total = 0.0
    for (x, y, z, s), n in ca.items():
        for (u, v, w, t), m in cb.items():
            if (x, y, z) == (u, v, w):
                total += n * m * X.DECAY ** (s + 1) * X.DECAY ** (t + 1)
    return total


def test_kernel_equals_enumerated_subsequences():
    words = ["idiot", "idiots", "idxiot", "moron", "worthless", "harbours", "aaaa", "abab"]
    # The scaling divides by one factor of each word's length.
    size = {w: (by_enumeration(w, w) / kernel(w, w)) ** 0.5 for w in words}
    for n in {len(w) for w in words}:
        same = [size[w] for w in words if len(w) == n]
        assert max(same) - min(same) < 1e-3 * max(same)
    for a in words:
        for b in words:
            want = by_enumeration(a, b) / (size[a] * size[b])
            assert abs(kernel(a, b) - want) < 1e-3 * max(1.0, want), (a, b)


def test_the_prior_is_that_of_all_labels():
    rng = np.random.default_rng(3)
    value = np.concatenate([rng.normal(1, 1, 400), rng.normal(-1, 1, 400)])  # the kinds overlap
    y = np.array([1.0] * 400 + [0.0] * 400)

    def mean(share):
        weight = np.where(y > 0, share / 400, (1 - share) / 400)
        slope, shift = X.logistic(value, y, weight)
        return float((1 / (1 + np.exp(-(slope * value + shift)))) @ weight)

    for share in (0.5, 0.1, 0.02):
        assert abs(mean(share) - share) < 0.01 + 0.1 * share


def test_no_telling_word_gives_the_share_and_no_model():
    model = X.fit([(i % 2, ["alpha", "beta"]) for i in range(100)], 0.1)
    assert not model.fitted and set(model.probability(np.zeros(3))) == {0.1}
