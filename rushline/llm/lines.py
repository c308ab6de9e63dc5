"""Line dedup by distinct-site spread.

A HyperLogLog sketch per line hash estimates on how many sites a line stands; sketches
merge by aggregation. Lines whose estimate is near the threshold are counted exactly.
The threshold is a share of the corpus's own sites. A line of fifty words or more is a
passage of its own: it is counted by the distinct texts that hold it, so a passage that
many documents of one site share is found too, while copies of one text count once.

Lines that reach the threshold are boilerplate and are removed from every row, but for
copies of a whole text: rows that are mostly such lines and that the near-duplicate
operator links with another such row (or that are equal to one) stay whole, since a
story that many sites print is not boilerplate of theirs.

Defined results: lines are the parts between line feeds, compared without white
space at their ends; lines without a word are kept and never counted. A NULL text
stays NULL; NULL sites are one site; repeated rows get the same result; very long texts
are split as they are; an empty table gives an empty result. All columns pass unchanged
but ``text``, and ``n_chars`` where it exists and the text has changed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rushline.llm import jaccard
from rushline.llm.common import SPACES, fresh, stored, words_of

HASHES = ("hash1", "hash2")
KEYS = ("key1", "key2")


@dataclass(frozen=True)
class Spread:
    """A line is boilerplate on so many percent of all sites, and on ``least`` at least."""

    percent: int = 25
    least: int = 4
    #: Lines of so many words are counted by texts, not by sites.
    long_words: int = 50
    #: Relative standard deviation of the sketches.
    error: float = 0.15
    #: Estimates within this factor of the threshold are counted exactly.
    band: float = 4.0
    #: Rows with more than this percentage of their words in such lines may be copies.
    mostly_percent: int = 50


def threshold(docs: DataFrame, site: Column, rule: Spread) -> int:
    """The number of sites, or texts, from which a line of this corpus is boilerplate."""
    sites = docs.groupBy(site.cast("string").alias("site")).agg(F.lit(1)).count()
    return max(rule.least, -(-sites * rule.percent // 100))


def row_keys() -> list[Column]:
    """Equal for rows with the same id and text, different for any others."""
    both = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text")]
    return [F.xxhash64(*both).alias("key1"), F.hash(*both).alias("key2")]


def line_rows(docs: DataFrame, site: Column, rule: Spread) -> DataFrame:
    """(keys, place, line_no, hashes, words, doc_words): lines with a word, each once for
    rows that are equal and stand on the same site. ``place`` is what the line is counted
    by: the site, or the text where the line is long."""
    trimmed = F.btrim(F.col("line"), F.lit(SPACES))
    # What is said of a row is computed before its lines are unfolded, once.
    rows = docs.select(
        *row_keys(), site.cast("string").alias("site"),
        F.xxhash64("text").cast("string").alias("content"),
        F.size(words_of(F.col("text"))).alias("doc_words"),
        F.split("text", "\n", -1).alias("lines"))
    said = [*KEYS, "site", "content", "doc_words"]
    return rows.select(*said, F.posexplode("lines").alias("line_no", "line")).select(
        *said, "line_no", trimmed.alias("line")).where(F.col("line") != "").select(
        *said, "line_no", F.xxhash64("line").alias("hash1"),
        F.hash("line").alias("hash2"), F.size(words_of(F.col("line"))).alias("words"),
    ).withColumn("place", F.when(F.col("words") >= rule.long_words, F.col("content")).otherwise(
        F.col("site"))).drop("site", "content")


def boilerplate(lines: DataFrame, least: int, rule: Spread) -> DataFrame:
    """(hashes): the lines that stand in at least ``least`` places.

    A line in a third of all rows sends one sketch per task; the exact counts take
    the distinct places of the lines near the threshold only.
    """
    sketched = stored(lines.groupBy(*HASHES).agg(
        F.approx_count_distinct("place", rule.error).alias("places"),
        F.max(F.col("place").isNull().cast("int")).alias("null_place"),
    ).select(*HASHES, (F.col("places") + F.col("null_place")).alias("places")).where(
        F.col("places") >= max(2, least / rule.band)), "line_spread")
    sure = sketched.where(F.col("places") > least * rule.band).select(*HASHES)
    near = sketched.where(F.col("places") <= least * rule.band).select(*HASHES)
    exact = lines.join(near, list(HASHES), "left_semi").groupBy(*HASHES, "place").agg(
        F.count(F.lit(1)).alias("n")).groupBy(*HASHES).agg(
        F.count(F.lit(1)).alias("places")).where(F.col("places") >= least).select(*HASHES)
    return stored(sure.unionByName(exact), "line_boilerplate")


def copies(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """(keys): those of the named rows whose text another of them holds too, equal
    or linked by the near-duplicate operator.

    Texts are picked where they lie while the keys, 12 bytes each, are few enough to
    broadcast; their number is counted first.
    """
    keys = stored(keys, "line_mostly")
    if keys.count() <= jaccard.MOST_BROADCAST_IDS:
        keys = F.broadcast(keys)
    rows = stored(docs.select(*row_keys(), "doc_id", F.col("text").cast("string").alias("text")).join(
        keys, list(KEYS), "left_semi"), "line_candidates")
    placed = stored(jaccard.classes(rows), "line_classes")
    many = placed.groupBy("component_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    content = placed.join(many, "component_key", "left_semi").select("content").distinct()
    return rows.select(*KEYS, F.xxhash64("text").alias("content")).join(
        content, "content", "left_semi").select(*KEYS).distinct()


def removals(docs: DataFrame, lines: DataFrame, found: DataFrame, rule: Spread) -> DataFrame:
    """(keys, flagged, removed): line numbers of each row that has such lines."""
    hit = lines.join(found, list(HASHES), "left_semi")
    flagged = hit.groupBy(*KEYS, "doc_words").agg(
        F.collect_set(F.struct("line_no", "words")).alias("hits"))
    words = F.aggregate("hits.words", F.lit(0).cast("long"), lambda a, x: a + x)
    rows = stored(flagged.select(
        *KEYS, F.col("hits.line_no").alias("numbers"),
        (100 * words > rule.mostly_percent * F.col("doc_words")).alias("mostly")), "line_hits")
    copied = copies(docs, rows.where("mostly").select(*KEYS)).withColumn("copied", F.lit(True))
    return rows.join(copied, list(KEYS), "left").select(
        *KEYS, F.size("numbers").cast("long").alias("flagged"),
        F.when(F.col("copied").isNull(), F.col("numbers"))
        .otherwise(F.array().cast("array<int>")).alias("removed"))


def clean(docs: DataFrame, site: Column, rule: Spread = Spread(), into: str = "lines") -> DataFrame:
    """All columns, the text without boilerplate, and the struct ``into``: n_lines
    (lines with a word), n_flagged and n_removed."""
    lines = stored(line_rows(docs, site, rule), "lines")
    found = fresh(docs, "removal")
    least = threshold(docs, site, rule)
    gone = removals(docs, lines, boilerplate(lines, least, rule), rule).select(F.struct(
        F.struct(*KEYS).alias("of"), "flagged", "removed").alias(found))
    joined = docs.join(gone, F.struct(*row_keys()) == F.col(f"{found}.of"), "left")
    parts = F.split("text", "\n", -1)
    removed = F.col(f"{found}.removed")
    kept = F.array_join(F.filter(parts, lambda _, i: ~F.array_contains(removed, i)), "\n")
    some = F.size(removed) > 0
    n_lines = F.size(F.filter(parts, lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    out = joined.withColumn(into, F.struct(
        F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(f"{found}.flagged", F.lit(0).cast("long")).alias("n_flagged"),
        F.coalesce(F.greatest(F.size(removed), F.lit(0)), F.lit(0)).cast("long")
        .alias("n_removed"),
    )).withColumn("text", F.when(some, kept).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(
            F.col(f"{into}.n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType),
        ).otherwise(F.col("n_chars")))
    return out.select(*docs.columns, into)
