"""The registered queries ``opN_<name>``, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import decontaminate, exact_dedup, html_text, jaccard_join, line_dedup, lm_scoring, packing, periodic_runs, phrases, quality, substring_dedup, toxicity, url_rules
from meterlake.llm.shared import table


def op1_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.score(table(spark, folder, "documents"))


def op2_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, folder, "documents"))


def op5_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    judged = quality.judge(docs, table(spark, folder, "labels"))
    return judged.select("doc_id", "lang", "perplexity", "threshold", "keep")


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.shared_passages(table(spark, folder, "documents"))


def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.without_repeated_lines(docs).select(
        "rest.doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, folder, "documents"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    judged = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op11_phrase_mining(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


#: The rules of the contract.
URL_RULES = [
    url_rules.Rule("allow", "org/"),
    url_rules.Rule("block", "example.org/es/"),
    url_rules.Rule("block", "example.org/en/1"),
    url_rules.Rule("allow", "com/fr/"),
    url_rules.Rule("block", "com/de/"),
]


def op12_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """A page with an id of ``labels`` and quality 0 is labelled as blocked, with quality 1 as not blocked."""
    marks = table(spark, folder, "labels").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("blocked"))
    judged = url_rules.filter_urls(table(spark, folder, "pages").select("page_id", "url"), marks, URL_RULES)
    return judged.select("rest.page_id", "host", "path", "rule", "verdict", "confidence")


def _with_repeated_tails(docs: DataFrame) -> DataFrame:
    """``docs`` where one text in ten, by the checksum of its id, repeats a stretch of its words up to its end."""
    checked = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    chosen = F.col("h") % 10 == 0
    words = F.array_compact(F.transform(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: F.nullif(w, F.lit(""))))
    split = checked.select("doc_id", "text", "h", F.when(chosen, words).alias("w"))
    sized = split.selectExpr("*", "CAST(size(w) AS BIGINT) AS n", "h DIV 10 AS g")
    first = sized.selectExpr("*", "IF(n > 0, CAST(g % n AS INT), 0) AS a")
    tail = first.selectExpr("*", "CAST(1 + (n - a) DIV (3 + g % 8) AS INT) AS p")
    repeated = "flatten(array_repeat(slice(w, a + 1, p), CAST((n - a) DIV p + 1 AS INT)))"
    text = F.expr(f"array_join(concat(slice(w, 1, a), slice({repeated}, 1, CAST(n - a AS INT))), ' ')")
    return tail.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = periodic_runs.collapse_runs(_with_repeated_tails(docs))
    longest = "array_max(transform(runs, r -> struct(r.length, -r.start AS s, -r.period AS p)))"
    lines = "array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"
    rows = found.select("rest.doc_id", "runs", "text", F.expr(longest).alias("best"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.expr("(1000 * best.length) DIV -best.p").alias("exponent_milli"),
        F.sha2(F.expr(lines), 256).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def queries() -> dict:
    found = (
        op1_lm_scoring,
        op2_html_extraction,
        op3_packing,
        op4_jaccard_join,
        op5_quality_classifier,
        op6_substring_dedup,
        op7_line_dedup,
        op8_exact_dedup,
        op9_decontamination,
        op10_toxicity,
        op11_phrase_mining,
        op12_url_rules,
        op13_periodic_runs,
    )
    return {f.__name__: f for f in found}
