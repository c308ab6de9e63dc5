"""Quality rules with adaptive thresholds per language and source.

One pass measures every whole text with built-in expressions. The measures are
summarised in mergeable quantile sketches: counts per bucket, where a bucket
keeps the ten leading bits of an integer measure (relative error below 1/512).
Sketches of a group merge by adding counts, so a small group takes the sketch of
its language, and a small language that of all rows. Fences that follow from the
median and the outer tenths of a group replace fixed cutoffs; rows are filtered by
a join with them. A spread is never below one bucket, which only keeps a group whose
tenth equals its median from losing rows that differ by less than the sketch resolves.

Defined results: NULL and empty texts have no words and fail the base rules;
NULL language and source are groups of their own; repeated rows count as often
as they occur; an empty table gives an empty result; other columns of the input
are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rushline.llm.common import SPACES, let, stored, text_or_empty, words_of

SYMBOLS = "#*$%&|<>"
LEADING_BITS = 10


@dataclass(frozen=True)
class Fences:
    """A fence lies ``reach`` spreads outside an outer tenth; the spread of a side is
    the distance of its tenth from the median, but at least one bucket."""

    reach: int = 3
    min_rows: int = 200


#: Judged measures; all in thousandths.
MEASURES = ("word_length", "symbol_share", "duplicate_line_share", "repeat_share")


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    Windows become one number each, hash above position, and are sorted: equal
    windows are neighbours. Their words are compared, so a hash clash does not
    count. Sorted positions then give the words covered.
    """
    def covered(v):
        w, n = v["w"], v["n"]

        # Up to 2^24 words 40 bits of the hash are left; beyond, 33.
        def packed(i):
            h = F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
            return F.when(n > (1 << 24), F.shiftleft(h, 31).bitwiseOR(i.cast("long"))).otherwise(
                F.shiftleft(h, 24).bitwiseOR(i.cast("long")))

        def position(x):
            return F.when(n > (1 << 24), x.bitwiseAND(F.lit((1 << 31) - 1))).otherwise(
                x.bitwiseAND(F.lit((1 << 24) - 1))).cast("int")

        def same(a, b):
            return (F.get(w, a) == F.get(w, b)) & (F.get(w, a + 1) == F.get(w, b + 1)) & (
                F.get(w, a + 2) == F.get(w, b + 2))

        def close(x, y):
            """Equal hash part, and equal words."""
            hashes = F.when(n > (1 << 24), F.shiftright(x, 31) == F.shiftright(y, 31)).otherwise(
                F.shiftright(x, 24) == F.shiftright(y, 24))
            return F.coalesce(hashes, F.lit(False)) & same(position(x), position(y))

        ordered = F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), packed))

        def picked(g):
            hits = F.filter(g, lambda x, i: close(x, F.get(g, i + 1)) | F.when(
                i > 0, close(x, F.get(g, i - 1))).otherwise(False))
            return let(F.sort_array(F.transform(hits, position)), lambda p: F.aggregate(
                p, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
                lambda a, x: F.struct(
                    (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"), x.alias("last")),
                lambda a: a["n"]))

        return let(ordered, picked)

    return let(
        F.struct(words.alias("w"), F.size(words).alias("n")),
        lambda v: F.when(v["n"] >= 4, covered(v)).otherwise(F.lit(0).cast("long")))


def measures(docs: DataFrame) -> DataFrame:
    """One stored row per input row: id, lang, source and the integer measures."""
    text, words = F.col("text_"), F.col("words_")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    dup_lines = let(lines, lambda v: F.size(v) - F.size(F.array_distinct(v)))
    return stored(
        docs.select("doc_id", "lang", "source", text_or_empty().alias("text_"))
        .withColumn("words_", words_of(text))
        .select(
            "doc_id", "lang", "source",
            F.size(words).cast("long").alias("n_words"),
            F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")
            .alias("n_symbols"),
            dup_lines.cast("long").alias("n_dup_lines"),
            F.size(lines).cast("long").alias("n_lines"),
            repeated_words(words).alias("n_repeat_words"),
        ),
        "quality_measures")


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def scaled() -> dict[str, Column]:
    """The judged measures as whole thousandths; exact in any engine."""
    def per_mille(a, b):
        return F.when(F.col(b) > 0, F.expr(f"(1000 * {a}) div {b}")).otherwise(F.lit(0).cast("long"))

    return {
        "word_length": per_mille("word_chars", "n_words"),
        "symbol_share": per_mille("n_symbols", "word_chars"),
        "duplicate_line_share": per_mille("n_dup_lines", "n_lines"),
        "repeat_share": per_mille("n_repeat_words", "n_words"),
    }


def bucket_width(value: Column) -> Column:
    """How many values share the bucket of a value."""
    width = F.length(F.bin(value))
    return F.pow(F.lit(2.0), F.greatest(width - LEADING_BITS, F.lit(0))).cast("long")


def bucket(value: Column) -> Column:
    """The value with all but its leading ten bits set to zero."""
    return value - F.pmod(value, bucket_width(value))


def sketches(measured: DataFrame, by: list[str]) -> DataFrame:
    """(by, measure, bucket, n): the bucket counts of every group."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("measure"), bucket(v).alias("bucket"))
        for name, v in scaled().items()])
    return measured.select(*by, F.explode(pairs).alias("p")).groupBy(
        *by, F.col("p.measure").alias("measure"), F.col("p.bucket").alias("bucket"),
    ).agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Coarser sketches: counts of the same bucket add up."""
    return sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


#: Quantiles that fences follow from, in tenths of the rows.
TENTHS = {"first": 1, "middle": 5, "last": 9}


def quantiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """(by, measure, rows, first, middle, last): the buckets where the cumulated count
    passes a tenth, a half and nine tenths. A window holds one group's buckets, of
    which there are at most some thousands however many rows they count."""
    group = Window.partitionBy(*by, "measure")
    upto = group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    placed = sketch.withColumns({
        "seen": F.sum("n").over(upto), "rows": F.sum("n").over(group)})
    return placed.groupBy(*by, "measure").agg(
        F.max("rows").alias("rows"),
        *[F.min(F.when(10 * F.col("seen") >= tenths * F.col("rows"), F.col("bucket"))).alias(name)
          for name, tenths in TENTHS.items()])


def thresholds(measured: DataFrame, fences: Fences = Fences()) -> DataFrame:
    """(lang, source, low_*, high_*): one row per group, from its own sketch, or
    from that of its language or of all rows where it has too few rows."""
    fine = stored(sketches(measured, ["lang", "source"]), "quality_sketches")
    wide = merged(fine, ["lang"])
    own = quantiles(fine, ["lang", "source"])
    of_lang = quantiles(wide, ["lang"]).select(
        "lang", "measure", *[F.col(c).alias(f"lang_{c}") for c in ("rows", *TENTHS)])
    of_all = quantiles(merged(wide, []), []).select(
        "measure", *[F.col(c).alias(f"all_{c}") for c in TENTHS])
    enough, lang_enough = F.col("rows") >= fences.min_rows, F.col("lang_rows") >= fences.min_rows
    joined = own.join(
        of_lang.withColumnRenamed("lang", "lang_").withColumnRenamed("measure", "measure_"),
        F.col("lang").eqNullSafe(F.col("lang_")) & (F.col("measure") == F.col("measure_"))
    ).drop("measure_").join(of_all, "measure")
    picked = joined.select("lang", "source", "measure", *[
        F.when(enough, F.col(q)).when(lang_enough, F.col(f"lang_{q}")).otherwise(F.col(f"all_{q}"))
        .alias(q) for q in TENTHS])
    below = F.greatest(F.col("middle") - F.col("first"), bucket_width(F.col("first")))
    above = F.greatest(F.col("last") - F.col("middle"), bucket_width(F.col("last")))
    bounds = picked.select("lang", "source", "measure",
                           (F.col("first") - fences.reach * below).alias("low"),
                           (F.col("last") + fences.reach * above).alias("high"))
    return bounds.groupBy("lang", "source").agg(*[
        F.max(F.when(F.col("measure") == name, F.col(side))).alias(f"{side}_{name}")
        for name in MEASURES for side in ("low", "high")])


def judge(docs: DataFrame, fences: Fences = Fences()) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` of every row."""
    measured = measures(docs)
    limits = thresholds(measured, fences).withColumnRenamed("lang", "lang_").withColumnRenamed(
        "source", "source_")
    inside = F.lit(True)
    for name, value in scaled().items():
        inside = inside & value.between(F.col(f"low_{name}"), F.col(f"high_{name}"))
    joined = measured.join(
        limits, F.col("lang").eqNullSafe(F.col("lang_"))
        & F.col("source").eqNullSafe(F.col("source_")))
    return joined.select(
        *measured.columns, base_failed().alias("base_failed"),
        (~base_failed() & inside).alias("kept"))
