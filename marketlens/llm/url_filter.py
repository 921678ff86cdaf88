"""URL filter (native): longest-match rules, then logistic regression on hashed
character n-grams of host and path.

The model is fitted on a small labelled URL table (`LABELLED`, under 1,000
rows: its features are the only thing collected).  Scoring is one expression
over the url column: n-grams by `transform`, a hashed bucket for each, and the
sum of the buckets' weights.

Cases: a null url, or one without `://`, has an empty host and path, no rule
and no n-grams, and its score is the model's bias alone (below one half, so it
is allowed).  A url of any length is read whole; rows that repeat each get their
result; an empty table gives no rows.  Other columns pass through, those with the
name of a result column are replaced.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 4096
HOST_GRAMS = (3, 4, 5)
PATH_GRAMS = (3, 4)

# Labelled URL table, built by rule from words: a site name is a topic, alone or
# with a word that both kinds of sites use.  Topics that are blocked, and
# everyday words that are not; no name of any site.
BLOCKED_TOPICS = """casino poker roulette slots jackpot betting bets lotto viagra pills meds steroids adult porn
    xxx sexcam escorts spam spammer phishing malware ads adserver adtrack tracker tracking popup clickbait payday
    replica warez""".split()
ALLOWED_TOPICS = """news weather library science garden history recipes school museum travel music health sports town
    source books city photos river mountain kitchen letters numbers nature teacher station brother winter summer mother
    father leather feather northern southern things thought think month earth fourth worth thread theatre therapy thesis
    thermal there their other another together rather nation motion section options question edition tradition
    restaurant studio harbour theory whether nothing anything orchard threshold bethany athletics shelter interest
    northwest forest hundred wherever sandwich honest southeast inland island thousand whistle wheat shoulder stable
    possible cable humble thimble hedge reading heading weddings landing sounding lovely friendly weekly family
    reach teach season reason theology methods ethics athens hotel shore short north south birth truth""".split()
SHARED_WORDS = "shop store online club hub best deals live king royal plus express world zone home group".split()
PREFIXES = ["", "www.", "blog.", "m."]
ENDINGS = ["example.com", "example.org", "example.net"]
PATHS = ["/en/{n}", "/fr/{n}/", "/de/{n}.html", "/es/{n}?page=2&ref=x", "/en/{n}#top", "/news/{n}", "/"]


def site_names(topics: list[str], variants: int) -> list[str]:
    """Each topic alone, then with shared words before or behind it in turn."""
    out = []
    for i, topic in enumerate(topics):
        out.append(topic)
        for j in range(1, variants):
            word = SHARED_WORDS[(5 * i + 3 * j) % len(SHARED_WORDS)]
            out.append((f"{topic}-{word}", f"{word}-{topic}", f"{topic}{word}", f"{word}{topic}")[(i + j) % 4])
    return out


def labelled_urls() -> list[tuple[str, int]]:
    """The labelled table: every name with a prefix, an ending and a path in turn."""
    out = []
    for label, names in ((1, site_names(BLOCKED_TOPICS, 8)), (0, site_names(ALLOWED_TOPICS, 4))):
        for i, name in enumerate(names):
            path = PATHS[i % len(PATHS)].format(n=17 * i)
            out.append((f"https://{PREFIXES[i % len(PREFIXES)]}{name}.{ENDINGS[i % len(ENDINGS)]}{path}", label))
    return out


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls.

    A rule `host/path` fits its host and the host's subdomains when the url's
    path starts with the rule's path."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, what in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        rule_host, slash, rest = text.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def gram_buckets(host: Column, path: Column) -> Column:
    """Hashed buckets of the n-grams of `^host$` and of the path, with repeats."""
    def grams(text: Column, kind: str, n: int) -> Column:
        last = F.length(text) - n + 1
        starts = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.pmod(
            F.xxhash64(F.lit(kind), F.substring(text, i, F.lit(n))), F.lit(BUCKETS)).cast("int"))

    framed = F.when(host != "", F.concat(F.lit("^"), host, F.lit("$"))).otherwise(F.lit(""))
    parts = [grams(framed, "host", n) for n in HOST_GRAMS] + [grams(path, "path", n) for n in PATH_GRAMS]
    return reduce(lambda a, b: F.concat(a, b), parts)


def fit(spark: SparkSession, rounds: int = 2000, rate: float = 4.0, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient descent on the labelled table (bounded).  The
    weights stay combinations of the rows, so the steps are taken on these."""
    rows = labelled_urls()
    data = F.array(*[F.struct(F.lit(u).alias("url"), F.lit(y).alias("y")) for u, y in rows])
    urls = spark.range(1).select(F.explode(data).alias("r")).select("r.url", "r.y")
    feats = urls.select("y", gram_buckets(url_host(F.col("url")), url_path(F.col("url"))).alias("g")).collect()
    x = np.zeros((len(feats), BUCKETS))
    for i, r in enumerate(feats):
        np.add.at(x[i], r["g"], 1.0)
        x[i] /= max(1, len(r["g"])) ** 0.5
    y = np.array([r["y"] for r in feats], dtype=float)
    alike, share, b = x @ x.T, np.zeros(len(y)), -0.5
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(alike @ share + b)))
        share -= rate * ((p - y) / len(y) + penalty * share)
    return x.T @ share, b


def score_expr(host: Column, path: Column, weights: np.ndarray, bias: float) -> Column:
    """Probability that the url should be blocked."""
    table = F.split(F.lit(",".join(f"{v:.6g}" for v in weights)), ",").cast("array<double>")
    grams = gram_buckets(host, path)
    total = F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.get(table, g))
    z = total / F.sqrt(F.greatest(F.size(grams), F.lit(1)).cast("double")) + F.lit(float(bias))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def filter_urls(df: DataFrame, url: str, rules: list[tuple[str, str]],
                model: tuple[np.ndarray, float] | None = None, threshold: float = 0.5) -> DataFrame:
    """Add host, path, rule, url_score and verdict (`allow` or `block`).

    A narrow projection.  Columns of the input that have one of these names
    are replaced."""
    w, b = model or fit(df.sparkSession)
    u = F.col(f"`{url}`")
    host, path = url_host(u), url_path(u)
    rule, by_rule = matched_rule(host, path, rules)
    score = score_expr(host, path, w, b)
    return df.withColumns({
        "host": host, "path": path, "rule": rule, "url_score": score,
        "verdict": F.coalesce(by_rule, F.when(score >= threshold, F.lit("block")).otherwise(F.lit("allow")))})
