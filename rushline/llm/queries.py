"""The queries of this subpackage, bound to the bundled tables by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

import corpus_pipeline
from rushline.llm import (
    chat, credentials, decontam, jaccard, lines, mixing, oracles, phrases, quality, repair,
    suffixes, tokens, toxicity, urls,
)
from rushline.llm.common import table

# --------------------------------------------------------------------------
# 1 Secret scans
# --------------------------------------------------------------------------


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The owner is the source; its languages stand for its repositories."""
    found = credentials.scan(
        table(spark, sf_dir, "documents"), F.col("source"),
        F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))))

    def of_kind(kind):
        number = credentials.KINDS.index(kind)
        return F.size(F.filter("spans", lambda s: s["kind_no"] == number)).cast("long")

    base = F.filter("spans", lambda s: s["kind_no"] < len(credentials.BASE))

    def judged(verdict):
        return F.size(F.filter("spans", lambda s: s["verdict"] == verdict)).cast("long")

    return found.select(
        "doc_id", *[of_kind(k).alias(f"n_{k}") for k in credentials.BASE],
        F.sha2(credentials.span_text(base), 256).alias("base_sha256"),
        credentials.span_text(F.col("spans")).alias("spans"),
        judged("live").alias("n_live"), judged("example").alias("n_example"))


# --------------------------------------------------------------------------
# 2 Benchmark decontamination
# --------------------------------------------------------------------------

def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.find(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", *decontam.digest(F.col("found")))


# --------------------------------------------------------------------------
# 3 Token counts
# --------------------------------------------------------------------------

TOKENIZER = "piece_bpe_32k.model"


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


# --------------------------------------------------------------------------
# 4 Mixing sources to target weights
# --------------------------------------------------------------------------

def op4_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mixed_sizes(table(spark, sf_dir, "documents"), corpus_pipeline.WEIGHTS)
    return mixed.select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies")


# --------------------------------------------------------------------------
# 5 Chat formatting
# --------------------------------------------------------------------------

#: A conversation whose texts hold the template's own marks.
HOSTILE = oracles.HOSTILE


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.createDataFrame(
        [(-1, 0, "user", HOSTILE), (-1, 1, "assistant", HOSTILE)], rows.schema)
    back = chat.read_back(chat.render(rows.unionByName(hostile)))
    turns = F.array_join(F.transform("read_turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id", F.size("read_turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "n_invalid", "complete")


# --------------------------------------------------------------------------
# 6 Toxicity
# --------------------------------------------------------------------------

def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.select(
        "doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"),
        toxicity.score(docs, model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= toxicity.REJECTED_FROM).cast("int"))


# --------------------------------------------------------------------------
# 7 N-gram Jaccard join
# --------------------------------------------------------------------------

def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id")


# --------------------------------------------------------------------------
# 8 Line dedup
# --------------------------------------------------------------------------

def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = lines.clean(
        table(spark, sf_dir, "documents").select("doc_id", "text", "source"), F.col("source"))
    return cleaned.select(
        "doc_id", "lines.n_lines", "lines.n_flagged", "lines.n_removed",
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("n_chars"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


# --------------------------------------------------------------------------
# 9 Quality rules
# --------------------------------------------------------------------------

def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


# --------------------------------------------------------------------------
# 10 URL filters
# --------------------------------------------------------------------------

URL_RULES = oracles.URL_RULES


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages"), urls.rules_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


# --------------------------------------------------------------------------
# 11 Suffix-array dedup
# --------------------------------------------------------------------------

def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.repeated_strings(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key").alias("doc_id"), "n_bytes", suffixes.span_bytes(F.col("spans")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.col("sha256").alias("kept_sha256"))


# --------------------------------------------------------------------------
# 12 Phrase collocation mining
# --------------------------------------------------------------------------

def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


# --------------------------------------------------------------------------
# 13 Conversation structure repair
# --------------------------------------------------------------------------

def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.with_faults(repair.damage(table(spark, sf_dir, "conversations")))
    return repair.digest(repair.sorted_parts(rows))


# --------------------------------------------------------------------------
# The pipeline
# --------------------------------------------------------------------------

def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = (
    op1_secret_scans, op2_benchmark_decontamination, op3_token_counts, op4_mixing_sources,
    op5_chat_formatting, op6_toxicity, op7_jaccard_join, op8_line_dedup, op9_quality_rules,
    op10_url_filters, op11_suffix_dedup, op12_phrase_mining, op13_conversation_repair,
    pipeline,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.ORACLES)
