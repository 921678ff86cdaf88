"""Registered queries of the subpackage: one `opN_*` per operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, conversation_repair, decontaminate, html_extract, language_id, line_dedup, sharding, simhash,
               source_divergence, suffix_dedup, topk, toxicity, url_filter)
from .common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]
SHARDS = 24
SHINGLE, RADIUS = 3, 2
HELD_OUT_OF, HELD_OUT = 4, 2
TOXIC_FROM = 0.3
RECURRING_FROM, LONG_RECURRING_FROM = 20, 5
TERM_DOCS, TOP_TERMS = 10, 10
QUERY_STEP, TOP, SCALE = 20, 20, 64


def held_out(row_id: str) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(row_id).cast("string")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out("doc_id"))
    return toxicity.train(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    zero = F.lit(0).cast("long")
    done = suffix_dedup.with_cuts(
        docs, "doc_id", "text", suffix_dedup.cut_texts(docs, "text"),
        {"n_bytes": F.col("n_bytes"), "n_removed": removed, "n_spans": F.size("spans").cast("long"),
         "kept_sha256": F.sha2("kept", 256)},
        {"n_bytes": F.octet_length("text").cast("long"), "n_removed": zero, "n_spans": zero,
         "kept_sha256": F.sha2(F.col("text").cast("binary"), 256)})
    return done.withColumnRenamed("id", "doc_id")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs, "doc_id", "text", SHINGLE, RADIUS)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per leaking document: its items and the word spans that leak."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, "text", table(spark, sf_dir, "benchmark").select("item_id", "text"))
    leaks = found.where(F.size("leaks") > 0)
    return leaks.select("doc_id", F.array_distinct(F.col("leaks.item_id")).alias("item_ids"), "leaks")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract_pages(pages, "html").withColumn("n_chars", F.length("text").cast("long"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, "vec_id", "embedding", F.col("vec_id") % QUERY_STEP == 0, TOP, SCALE)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.round_trip(docs, "text", VOCABULARY, public_tokenizers.PATTERN)
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    done = url_filter.filter_urls(pages, "url", URL_RULES)
    return done.select("page_id", "host", "path", "rule", "verdict", "url_score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, "text", toxicity_model(spark, sf_dir))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_recurring_lines(docs, "text", RECURRING_FROM, LONG_RECURRING_FROM)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"))
    return sharding.number_slots(sharding.assign_shards(docs, "doc_id", SHARDS)).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows as the contract damages them; `present` is false on dropped rows."""
    def shown(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    effect = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    rows = conversations.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"),
                                effect.alias("effect"))
    text = (F.when(F.col("effect") == 1, F.lit("")).when(F.col("effect") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    copies = F.array_repeat(F.lit(1), F.when(F.col("effect") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", F.when(F.col("effect") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                       text.alias("text"), (F.col("effect") != 0).alias("present"),
                       F.explode(copies).alias("__copy")).drop("__copy")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return conversation_repair.audits(rows, "conv_id", "turn", "role", "text", F.col("present"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labelled = docs.select("doc_id", "text", "lang").where(~held_out("doc_id"))
    filters = language_id.train(labelled, "text", "lang")
    done = language_id.predict(docs.select("doc_id", "text"), "text", filters)
    return done.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text", "lang", "source")
    return source_divergence.divergence(docs, "text", "lang", "source", TERM_DOCS, TOP_TERMS)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_simhash": op2_simhash,
    "op3_decontaminate": op3_decontaminate,
    "op4_html_text": op4_html_text,
    "op5_top_k": op5_top_k,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_url_filter": op7_url_filter,
    "op8_toxicity": op8_toxicity,
    "op9_line_dedup": op9_line_dedup,
    "op10_sharding": op10_sharding,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_language_id": op12_language_id,
    "op13_source_divergence": op13_source_divergence,
}
def _masked_sql(line: str) -> str:
    """The tokens of a line in DuckDB, those with a digit as a variable field."""
    return (f"list_transform(regexp_split_to_array(trim({line}, ' ' || chr(9) || chr(13)), '[ \\t\\r]+'), "
            f"lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN ' ' ELSE x END)")


ORACLE_SQL: dict[str, str] = {
    "op1_suffix_dedup": """
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        sized AS (SELECT *, (length(h) // 2)::BIGINT AS n FROM docs),
        chunks AS (
            SELECT row, c, n, substring(h, 2 * c + 1, 2 * (500 + 199)) AS part
            FROM (SELECT row, h, n, unnest(range(0, n - 199, 500)) AS c FROM sized WHERE n >= 200)),
        starts AS (
            SELECT row, c + i AS i, md5(substring(part, 2 * i + 1, 400)) AS part
            FROM (SELECT row, c, part, unnest(range(least(500, n - 199 - c))) AS i FROM chunks)),
        twice AS (SELECT part FROM starts GROUP BY part HAVING count(*) > 1),
        covered AS (SELECT row, i FROM starts JOIN twice USING (part)),
        marked AS (
            SELECT row, i, CASE WHEN i > lag(i) OVER w + 200 OR lag(i) OVER w IS NULL THEN 1 ELSE 0 END AS fresh
            FROM covered WINDOW w AS (PARTITION BY row ORDER BY i)),
        grouped AS (SELECT row, i, sum(fresh) OVER (PARTITION BY row ORDER BY i) AS span FROM marked),
        spans AS (SELECT row, min(i) AS a, max(i) + 200 AS b FROM grouped GROUP BY row, span),
        edges AS (SELECT row, a, b, lag(b, 1, 0) OVER (PARTITION BY row ORDER BY a) AS before FROM spans),
        cut AS (
            SELECT e.row, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
                   string_agg(substring(s.h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
            FROM edges e JOIN sized s ON s.row = e.row GROUP BY e.row)
        SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
               sha256(unhex(CASE WHEN c.row IS NULL THEN h ELSE kept || substring(h, 2 * last + 1) END)) AS kept_sha256
        FROM sized s LEFT JOIN cut c ON c.row = s.row""",
    "op9_line_dedup": f"""
        WITH texts AS (
            SELECT text, string_split(text, chr(10)) AS ls
            FROM (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL)),
        ends AS (
            SELECT *, ({_masked_sql('ls[1]')})[1:4] AS head,
                   ({_masked_sql('ls[(len(ls) - 1) // 2 + 1]')})[1:4] AS middle,
                   ({_masked_sql('ls[len(ls)]')})[1:4] AS tail
            FROM texts),
        lines AS (SELECT text, head, middle, tail, unnest(ls) AS line, generate_subscripts(ls, 1) AS line_no FROM ends),
        parsed AS (SELECT text, head, middle, tail, line_no, {_masked_sql('line')} AS tokens FROM lines),
        leaves AS (
            SELECT *, len(tokens) AS n, tokens[1:3] AS start3, len(list_filter(tokens, lambda x: x <> ' ')) AS words,
                   CASE WHEN len(tokens) >= {line_dedup.LONG_TOKENS} THEN {LONG_RECURRING_FROM}
                        ELSE {RECURRING_FROM} END AS support
            FROM parsed WHERE tokens <> ['']),
        placed AS (
            SELECT text, line_no, n, start3, words, support, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS spot
            FROM leaves),
        fixed_tokens AS (
            SELECT n, start3, spot, token FROM placed WHERE token <> ' '
            GROUP BY n, start3, spot, token HAVING count(*) >= any_value(support)),
        templates AS (
            SELECT text, line_no, n, start3, support, list((spot, token) ORDER BY spot) AS template
            FROM placed JOIN fixed_tokens USING (n, start3, spot, token)
            GROUP BY text, line_no, n, start3, words, support
            HAVING count(*) >= least(2, n) AND count(*) * 2 >= n AND (max(spot) > 3 OR count(*) = words)),
        found AS (SELECT t.*, e.head, e.middle, e.tail FROM templates t JOIN ends e USING (text)),
        signatures AS (
            SELECT n, start3, template, head, middle, tail, count(DISTINCT text) AS held
            FROM found GROUP BY ALL),
        unlike AS (
            SELECT n, start3, template, count(*) AS own
            FROM (SELECT *, sum(held) OVER x AS all_x, max(held) OVER x AS top_x, sum(held) OVER y AS all_y,
                         max(held) OVER y AS top_y, sum(held) OVER z AS all_z, max(held) OVER z AS top_z
                  FROM signatures
                  WINDOW x AS (PARTITION BY n, start3, template, middle, tail),
                         y AS (PARTITION BY n, start3, template, head, tail),
                         z AS (PARTITION BY n, start3, template, head, middle))
            WHERE NOT (held < top_x AND top_x * 2 > all_x) AND NOT (held < top_y AND top_y * 2 > all_y)
              AND NOT (held < top_z AND top_z * 2 > all_z)
            GROUP BY n, start3, template),
        often AS (
            SELECT n, start3, template, any_value(support) AS support, count(DISTINCT text) AS texts,
                   greatest(count(DISTINCT head), count(DISTINCT middle), count(DISTINCT tail)) AS spread
            FROM found GROUP BY n, start3, template),
        recurring AS (
            SELECT n, start3, template FROM often JOIN unlike USING (n, start3, template)
            WHERE texts >= support AND spread >= support AND (spread >= texts * {line_dedup.SPREAD} OR own >= support)),
        gone AS (
            SELECT text, list(line_no) AS dropped FROM found JOIN recurring USING (n, start3, template) GROUP BY text)
        SELECT d.doc_id,
               CASE WHEN g.dropped IS NULL THEN d.text
                    ELSE array_to_string(list_filter(string_split(d.text, chr(10)),
                         lambda x, i: NOT list_contains(g.dropped, i)), chr(10)) END AS text,
               coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines,
               coalesce(len(g.dropped), 0)::BIGINT AS n_dropped
        FROM documents d LEFT JOIN gone g ON d.text = g.text""",
    "op13_source_divergence": f"""
        WITH docs AS (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents),
        tokens AS (
            SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
            FROM docs),
        kept AS (
            SELECT lang, term FROM (SELECT DISTINCT id, lang, term FROM tokens)
            GROUP BY lang, term HAVING count(*) >= {TERM_DOCS}),
        groups AS (SELECT DISTINCT lang, source FROM docs),
        counted AS (SELECT lang, source, term, count(*) AS n FROM tokens JOIN kept USING (lang, term) GROUP BY ALL),
        every_term AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n
            FROM groups g JOIN kept k ON g.lang = k.lang
            LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        in_group AS (
            SELECT *, 1 + (1000000000::HUGEINT * (n + 2)) //
                   (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p
            FROM every_term),
        in_lang AS (
            SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) //
                   (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS q
            FROM (SELECT lang, term, sum(n) AS n FROM every_term GROUP BY lang, term)),
        pair_sums AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
            FROM in_group a JOIN in_group b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY ALL),
        pairs AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        terms AS (
            SELECT g.lang, g.source, 'term' AS part, g.term AS item, (p - q) * (p - q) // (p + q) AS value
            FROM in_group g JOIN in_lang l ON g.lang = l.lang AND g.term = l.term WHERE n > 0 AND p > q),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
            FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
        FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}""",
    "op5_top_k": """
        WITH vectors AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS whole
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   list_inner_product(q.whole, c.whole)::BIGINT AS score
            FROM vectors q JOIN vectors c
              ON q.vec_id <> c.vec_id AND len(q.whole) = len(c.whole)
            WHERE q.vec_id % 20 = 0),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
            FROM scored)
        SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 20""",
}
