"""Line dedup (native): a log-template tree of fixed depth.

Each line is parsed down a fixed-depth tree: first by its number of tokens,
then by its leading tokens (`DEPTH`, or all of a shorter line), tokens with a
digit counting as a variable field.  The support is `min_docs`, and `long_docs`
for lines of `LONG_TOKENS` tokens and more, which do not recur by chance.  In a
leaf, a token is constant at its position when at least as many lines of the
leaf as the support have it there; the other tokens are variable fields.  Lines
of a leaf with the same constant tokens share a template.  A template recurs,
and its lines are dropped from every document, when

- at least half of its tokens, and two (or the only one), are constant; as the
  leading tokens of a leaf are constant by construction, either one beyond them
  is as well, or all tokens are constant or have a digit, and
- it is found in at least as many different texts as the support that do not
  look like copies of each other: of the beginnings (`SIGNATURE` tokens) of
  their first lines, middle lines or last lines, at least as many differ, and
  either at least `SPREAD` for each text that has it, or at least as many of the
  texts' signatures (the three beginnings) as the support are no variants.  A
  signature is a variant of another that agrees in two beginnings and is held by
  over half of the texts with these two.

The second rule leaves copies of a whole document to the document-level
operators; without it, a large group of copies would lose all of its lines.  A
group of copies and near copies counts once, so it does not keep a line that
unrelated texts share.

Only templates of leaves that are large enough are worked out, so unique lines
cost one hash.  Leaf, token and template counts combine before they are
shuffled; a frequent line never meets in one task.

Cases: a null text is returned as null and counts as no line; blank lines stay;
a text of any length is read whole, its lines as one array; rows that repeat, or that
share or lack an id, are each returned; an empty table gives no rows; further
columns pass through, and the result columns replace columns of their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, free_name, text_key

DEPTH = 3
LONG_TOKENS = 20
SPREAD = 0.2
SIGNATURE = 4
BROADCAST_ROWS = 500_000
BLANKS = " \t\r"
VARIABLE = " "  # no token has a blank


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _tokens(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(BLANKS)), "[ \t\r]+")


def _masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit(VARIABLE)).otherwise(token)


def _beginning(line: Column) -> Column:
    first = F.slice(F.split(F.btrim(line, F.lit(BLANKS)), "[ \t\r]+", SIGNATURE + 1), 1, SIGNATURE)
    return F.xxhash64(F.transform(first, _masked))


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a checkpointed table after counting it, else leave the join
    to the engine."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _parsed(df: DataFrame, text: str) -> DataFrame:
    """One row per line that is not blank: content key of its text, line
    number, leaf, tokens, and how the text's first, middle and last lines begin."""
    k1, k2 = text_key(F.col(f"`{text}`"))
    texts = df.where(F.col(f"`{text}`").isNotNull()).select(
        k1.alias("k1"), k2.alias("k2"), _lines(F.col(f"`{text}`")).alias("lines"))
    half = F.floor((F.size("lines") - 1) / 2).cast("int")
    # Once per text, in a projection below the explode.
    texts = texts.select("k1", "k2", "lines", *[_beginning(F.get("lines", i)).alias(n) for n, i in (
        ("head", F.lit(0)), ("middle", half), ("tail", F.size("lines") - 1))])
    rows = texts.select("k1", "k2", "head", "middle", "tail", F.posexplode("lines").alias("line_no", "line"))
    rows = rows.withColumn("tokens", _tokens(F.col("line"))).withColumn("n", F.size("tokens"))
    leading = [_masked(F.get("tokens", F.lit(i))) for i in range(DEPTH)]
    return rows.where(F.get("tokens", F.lit(0)) != "").withColumn("leaf", F.xxhash64("n", *leading))


def _support(min_docs: int, long_docs: int) -> Column:
    """How many lines or texts make a recurrence, by the line's tokens `n`."""
    return F.when(F.col("n") >= LONG_TOKENS, F.lit(long_docs)).otherwise(F.lit(min_docs))


def _independent() -> list[Column]:
    return [F.countDistinct("k1", "k2").alias("texts"),
            *[F.countDistinct(c).alias(c) for c in ("head", "middle", "tail")]]


def _unlike(templates: DataFrame, support: Column) -> DataFrame:
    """(leaf, template) of the templates with as many signatures as the support
    that are no variants of a more frequent one."""
    ends = ["head", "middle", "tail"]
    one = ["leaf", "n", "template"]
    signatures = cut_lineage(templates.groupBy(*one, *ends).agg(F.countDistinct("k1", "k2").alias("held")))
    own = signatures
    for end in ends:
        pair = [*one, *(e for e in ends if e != end)]
        ruling = (signatures.groupBy(*pair).agg(F.sum("held").alias("all"), F.max("held").alias("top"))
                  .where((F.col("top") * 2 > F.col("all")) & (F.col("top") < F.col("all")))
                  .select(*[F.col(c).alias(f"__{c}") for c in pair], "top"))
        variant = F.col("held") < F.col("top")
        for c in pair:
            variant = variant & (F.col(c) == F.col(f"__{c}"))
        own = own.join(ruling, variant, "left_anti")
    return own.groupBy(*one).agg(F.count(F.lit(1)).alias("own")).where(F.col("own") >= support).select("leaf", "template")


def recurring_lines(df: DataFrame, text: str, min_docs: int, long_docs: int) -> DataFrame:
    """(k1, k2, line_no) of the lines that belong to a recurring template."""
    parsed, support = _parsed(df, text), _support(min_docs, long_docs)
    leaves = cut_lineage(parsed.groupBy("leaf", "n").agg(F.count(F.lit(1)).alias("lines"))
                         .where(F.col("lines") >= support).select("leaf"))
    lines = parsed.join(_small(leaves), "leaf", "left_semi").select(
        "leaf", "k1", "k2", "line_no", "n", "head", "middle", "tail",
        F.transform("tokens", lambda t: F.when(t.rlike("[0-9]"), F.lit(0).cast("long"))
                    .otherwise(F.xxhash64(t))).alias("tokens"))
    lines = cut_lineage(lines.distinct())
    words = F.size(F.filter("tokens", lambda t: t != 0))
    placed = lines.select("leaf", "n", F.posexplode("tokens").alias("at", "token")).where("token != 0")
    constant = (placed.groupBy("leaf", "n", "at", "token").agg(F.count(F.lit(1)).alias("lines"))
                .where(F.col("lines") >= support).select("leaf", "at", "token"))
    mine = lines.select("leaf", "k1", "k2", "line_no", "n", words.alias("words"), "head", "middle", "tail",
                        F.posexplode("tokens").alias("at", "token"))
    fixed = mine.join(constant, ["leaf", "at", "token"])
    templates = (fixed.groupBy("leaf", "k1", "k2", "line_no", "n", "words", "head", "middle", "tail")
                 .agg(F.count(F.lit(1)).alias("fixed"), F.max("at").alias("last"),
                      F.xxhash64(F.sort_array(F.collect_list(F.struct("at", "token")))).alias("template"))
                 .where((F.col("fixed") >= F.least(F.lit(2), F.col("n"))) & (F.col("fixed") * 2 >= F.col("n"))
                        & ((F.col("last") >= DEPTH) | (F.col("fixed") == F.col("words")))))
    templates = cut_lineage(templates.select("leaf", "n", "template", "k1", "k2", "line_no", "head", "middle", "tail"))
    spread = F.greatest("head", "middle", "tail")
    often = cut_lineage(templates.groupBy("leaf", "n", "template").agg(*_independent())
                        .where((F.col("texts") >= support) & (spread >= support))
                        .select("leaf", "template", (spread >= F.col("texts") * SPREAD).alias("spread")))
    recurring = often.where("spread").select("leaf", "template")
    crowded = often.where(~F.col("spread")).select("leaf", "template")
    if not crowded.isEmpty():
        held = templates.join(_small(crowded), ["leaf", "template"], "left_semi")
        recurring = cut_lineage(recurring.unionByName(_unlike(held, support)))
    return templates.join(_small(recurring), ["leaf", "template"], "left_semi").select("k1", "k2", "line_no")


def drop_recurring_lines(df: DataFrame, text: str, min_docs: int = 20, long_docs: int = 5,
                         n_lines: str = "n_lines", n_dropped: str = "n_dropped") -> DataFrame:
    """The rows with `text` reduced to the lines that stay, and two counts."""
    # Stored, so that the join below can split a text that very many rows hold.
    gone = cut_lineage(recurring_lines(df, text, min_docs, long_docs).groupBy("k1", "k2").agg(
        F.collect_list("line_no").alias("__gone")).select(
        F.col("k1").alias("__k1"), F.col("k2").alias("__k2"), "__gone"))
    names = {c: free_name(df, f"__text_{c}") for c in ("k1", "k2")}
    k1, k2 = text_key(F.col(f"`{text}`"))
    keyed = df.withColumns({names["k1"]: k1, names["k2"]: k2})
    met = keyed.join(gone.hint("shuffle_hash"), (keyed[names["k1"]] == gone["__k1"])
                     & (keyed[names["k2"]] == gone["__k2"]), "left")
    whole = F.col(f"`{text}`")
    lines = _lines(whole)
    # A set lookup by position: dropped lines become null, then go.
    stays = F.filter(lines, lambda _, i: ~F.array_contains("__gone", i))
    kept = F.when(F.col("__gone").isNull() | whole.isNull(), whole).otherwise(F.array_join(stays, "\n"))
    total = F.when(whole.isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    lost = F.when(whole.isNull(), F.lit(0)).otherwise(F.coalesce(F.size("__gone"), F.lit(0))).cast("long")
    cols = [c for c in df.columns if c.lower() not in (n_lines.lower(), n_dropped.lower())]
    return met.select(*[kept.alias(c) if c == text else F.col(f"`{c}`") for c in cols],
                      total.alias(n_lines), lost.alias(n_dropped))
