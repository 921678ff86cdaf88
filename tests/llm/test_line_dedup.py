import random
from collections import Counter

import pytest

import brute
from conftest import SF_ORACLE
from marketlens.llm import line_dedup as L
from marketlens.llm.queries import LONG_RECURRING_FROM, ORACLE_SQL, RECURRING_FROM, op9_line_dedup


def corpus(seed):
    rng = random.Random(seed)
    prose = lambda n: " ".join(rng.choice(("mel", "tor", "van", "sil", "or")) + str.join("", rng.choices("aeiou", k=3))
                               for _ in range(n))
    texts = []
    for d in range(120):
        lines = [prose(rng.randint(1, 12)) for _ in range(rng.randint(1, 8))]
        if rng.random() < 0.5:
            lines.insert(rng.randint(0, len(lines)), "All rights are reserved by us")
        if rng.random() < 0.4:
            lines.insert(rng.randint(0, len(lines)), f"Page {d} of {rng.randint(1, 99)} in this long volume")
        if rng.random() < 0.3:
            lines.append(f"Posted by the user {prose(1)} on our board")
        if rng.random() < 0.2:
            lines.append("  \tshared  line\twith  blanks\r")
        texts.append("\n".join(lines))
    whole = "\n".join(prose(9) for _ in range(10))
    texts += [whole] * 30 + [whole + f"\n{prose(7)}" for _ in range(4)]  # copies keep their lines
    return texts + [None, "", "\n\n", "one", "x y z", "word " * 20_000]


@pytest.mark.parametrize("min_docs", [3, 10])
def test_equals_brute_force(spark, min_docs):
    texts = corpus(4)
    df = spark.createDataFrame([(i % 50 if i % 9 else None, t, i, "x", "y") for i, t in enumerate(texts)],
                               "doc_id long, text string, row int, N_LINES string, __text_k1 string")
    out = L.drop_recurring_lines(df, "text", min_docs, 3)
    assert out.columns == ["doc_id", "text", "row", "__text_k1", "n_lines", "n_dropped"]
    gone = brute.recurring(texts, min_docs, 3)
    got = {r.row: (r.text, r.n_lines, r.n_dropped) for r in out.collect()}
    assert got == {i: brute.without(t, gone) for i, t in enumerate(texts)}
    if min_docs == 10:
        dropped = {t.split("\n")[n] for t, n in gone}
        assert "All rights are reserved by us" in dropped
        assert any(x.startswith("Page ") for x in dropped) and any(x.startswith("Posted by") for x in dropped)
        assert not any(t == texts[120] for t, _ in gone)


def test_join_without_broadcast_gives_the_same(spark, monkeypatch):
    texts = corpus(7)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = Counter(tuple(r) for r in L.drop_recurring_lines(df, "text", 5).collect())
    monkeypatch.setattr(L, "BROADCAST_ROWS", -1)
    assert Counter(tuple(r) for r in L.drop_recurring_lines(df, "text", 5).collect()) == want


def test_copies_do_not_keep_a_line_that_unrelated_texts_share(spark):
    word = lambda *k: "w" + "".join(chr(97 + int(c)) for x in k for c in f"{x:03d}")
    line = lambda *k: " ".join(word(i, *k) for i in range(8))
    footer = "All of this is held by us"
    unrelated = ["\n".join([line(d, 1), line(d, 2), line(d, 3), footer]) for d in range(30)]
    # Near copies: another line in each, and another beginning in every tenth.
    copies = ["\n".join([line(900, d if d % 10 == 0 else 999), line(901), line(902), line(903), line(904),
                         line(905, d), line(906), footer]) for d in range(300)]
    assert brute.recurring(unrelated + copies, 20) == {(t, t.count("\n")) for t in unrelated + copies}
    df = spark.createDataFrame(list(enumerate(unrelated + copies)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in L.drop_recurring_lines(df, "text", 20).collect()}
    assert got == {i: t.removesuffix("\n" + footer) for i, t in enumerate(unrelated + copies)}
    alone = spark.createDataFrame(list(enumerate(copies)), "doc_id long, text string")
    assert {r.doc_id: r.text for r in L.drop_recurring_lines(alone, "text", 20).collect()} == dict(enumerate(copies))


def test_leading_tokens_alone_make_no_template(spark):
    word = lambda d, i: "".join(chr(97 + int(c)) for c in f"{d:03d}{i}")
    texts = ["\n".join([" ".join(word(d, i) for i in range(9)),
                        f"It is a {word(d, 1)} {word(d, 2)} {word(d, 3)}",  # nothing but the start in common
                        f"It was the {word(d, 1)}",
                        f"Seen at {d} of {d}",                           # the rest has digits
                        f"Posted by the {word(d, 1)} today {word(d, 2)}"]) for d in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.text for r in L.drop_recurring_lines(df, "text", 20).collect()}
    assert got == {i: "\n".join(t.split("\n")[:3]) for i, t in enumerate(texts)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert L.drop_recurring_lines(df, "text").count() == 0


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    gone = brute.recurring(texts.values(), RECURRING_FROM, LONG_RECURRING_FROM)
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in op9_line_dedup(spark, SF_ORACLE).collect()}
    assert got == {i: brute.without(t, gone) for i, t in texts.items()}
    assert sum(n for _, _, n in got.values()) > 0


def _word(*k):
    return "w" + "".join(chr(97 + int(c)) for x in k for c in f"{x:03d}")


def telling_rules_apart():
    """Texts on which each part of the rule decides some line."""
    line = lambda *k, n=8: " ".join(_word(i, *k) for i in range(n))
    long_line = line(77, n=30)
    out = []
    for d in range(40):
        rows = [line(d), f"It is a {_word(d, 1)} {_word(d, 2)}", f"It was the {_word(d, 1)}", "Read more", "Share",
                f"Seen at {d} of {d}", f"{d}", "", " \t", f"Posted by the {_word(d, 1)} today {_word(d, 2)}",
                f"<*> {d} of <*>", line(d, 2)]
        out.append("\n".join(rows[:11] + ([long_line] if d < 6 else []) + [f"Rare {_word(d % 5)}"] + rows[11:]))
    # Fifteen texts with one more line, six near copies with a long line of their own.
    out += ["\n".join([line(100 + d), "Fifteen times only", line(d, 3)]) for d in range(15)]
    out += ["\n".join([line(200), line(201, n=25), line(203), line(202, d), line(204)]) for d in range(6)]
    return out + [None, "", "Read more", "Share\nShare", line(5) * 3000]


def test_one_rule_in_spark_sql_and_plain_python(spark):
    import duckdb
    import pandas as pd
    texts = telling_rules_apart()
    want = [(i, *brute.without(t, brute.recurring(texts, RECURRING_FROM, LONG_RECURRING_FROM))) for i, t in enumerate(texts)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = L.drop_recurring_lines(df, "text", RECURRING_FROM, LONG_RECURRING_FROM)
    assert sorted(tuple(r) for r in got.collect()) == want
    con = duckdb.connect()
    con.register("documents", pd.DataFrame({"doc_id": range(len(texts)), "text": texts}))
    sql = con.execute(ORACLE_SQL["op9_line_dedup"]).fetchall()
    assert sorted(sql) == want
    kept = want[0][1].split("\n")
    gone = set(texts[0].split("\n")) - set(kept)
    assert gone == {"Read more", "Share", "Seen at 0 of 0", texts[0].split("\n")[9], "<*> 0 of <*>", texts[0].split("\n")[11]}
    assert [w[3] for w in want[40:61]] == [0] * 21
