"""Secret scan with corpus-wide ownership frequency.

Built-in expressions find candidate spans in every whole text. Each candidate's
value is then counted over distinct owners and repositories: a value that many
owners hold is a copied example, one that stays with few owners and looks live
is a credential. The base kinds are always reported; opaque tokens (no keyword,
no known prefix) are reported only when the corpus says they are live.

Defined results: a NULL text is empty; a NULL owner or repository counts as one
more value; repeated rows are scanned one by one and their values counted once
per owner and repository; an empty table gives an empty result; other columns of
the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rushline.llm.common import let, running_starts, stored, text_or_empty

# Kinds in their listed order, and their patterns.
KINDS = ("assign", "access", "hex", "opaque")
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"(AKIA[A-Z0-9]{16,})",
    "hex": r"([0-9a-f]{24,})",
    "opaque": r"([A-Za-z0-9_-]{20,})",
}
BASE = KINDS[:3]
MIN_ASSIGNED = 6


@dataclass(frozen=True)
class Ownership:
    """When a value counts as an example, and what a live one looks like."""

    example_owners: int = 3
    example_repositories: int = 8
    live_characters: int = 10


def matches(text: Column, kind: str) -> Column:
    """array<struct<start, kind_no, end, value>> of one kind, leftmost first.

    Starts follow from the texts between the matches: code points, end exclusive.
    """
    pattern = F.lit(PATTERNS[kind])
    number = F.lit(KINDS.index(kind))

    def placed(found):
        between = F.split(text, PATTERNS[kind], -1)
        steps = F.transform(found, lambda m, i: (
            F.length(F.get(between, i)) + F.length(m)).cast("long"))
        values = F.regexp_extract_all(text, pattern, F.lit(1))
        # The steps before a match end where it is preceded by its own gap.
        return let(F.struct(
            running_starts(steps).alias("starts"), between.alias("between"), values.alias("values"),
        ), lambda v: F.transform(found, lambda m, i: let(
            F.get(v["starts"], i) + F.length(F.get(v["between"], i)),
            lambda start: F.struct(
                start.alias("start"), number.alias("kind_no"),
                (start + F.length(m)).alias("end"), F.get(v["values"], i).alias("value")))))

    found = F.regexp_extract_all(text, pattern, F.lit(0))
    empty = F.array().cast("array<struct<start:bigint,kind_no:int,end:bigint,value:string>>")
    spans = let(found, lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(empty))
    if kind == "assign":
        return F.filter(spans, lambda s: F.length(s["value"]) >= MIN_ASSIGNED)
    if kind == "opaque":
        # Without mixed character classes a long run is a word or a number.
        return F.filter(spans, lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]")
                        & s["value"].rlike("[A-Z]"))
    return spans


def candidates(docs: DataFrame, owner: Column, repository: Column) -> DataFrame:
    """One stored row per input row: its id, owner, repository and candidates."""
    text = F.col("_text")
    spans = F.concat(*[matches(text, kind) for kind in KINDS])
    compact = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind_no"].alias("kind_no"), s["end"].alias("end"),
        F.md5(s["value"]).alias("value"),
        F.size(F.array_distinct(F.split(s["value"], ""))).alias("characters"),
        (s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]")).alias("mixed")))
    return stored(
        docs.select(
            F.col("doc_id"), owner.cast("string").alias("owner"),
            repository.cast("string").alias("repository"), text_or_empty().alias("_text"),
        ).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository",
            compact.alias("spans")),
        "secret_candidates")


def ownership(found: DataFrame) -> DataFrame:
    """(value, n_owners, n_repositories): who holds each candidate value.

    Copies in one repository fall together before the shuffle, so a value that
    sits in a third of all rows sends one row per task, owner and repository.
    """
    held = found.select(
        F.explode("spans.value").alias("value"), "owner", "repository",
    ).groupBy("value", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    per_owner = held.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("n_repositories"))
    return per_owner.groupBy("value").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("n_repositories").alias("n_repositories"))


def scan(
    docs: DataFrame, owner: Column, repository: Column, rule: Ownership = Ownership(),
) -> DataFrame:
    """(row, doc_id, spans): every reported span with its verdict.

    ``spans`` is sorted by start and kind; each span has start, kind_no, end, the
    hash of its value, n_owners, n_repositories and a verdict: ``live``, ``example``
    or ``plain`` (held by few, but not live-looking).
    """
    found = candidates(docs, owner, repository)
    single = found.select("row", F.inline("spans"))
    copied = (F.col("n_owners") >= rule.example_owners) | (
        F.col("n_repositories") >= rule.example_repositories)
    live = F.col("mixed") & (F.col("characters") >= rule.live_characters)
    judged = single.join(ownership(found), "value").select(
        "row", F.struct(
            "start", "kind_no", "end", "value", "n_owners", "n_repositories",
            F.when(copied, "example").when(live, "live").otherwise("plain").alias("verdict"),
        ).alias("span"),
    ).where((F.col("span.kind_no") < len(BASE)) | (F.col("span.verdict") == "live"))
    per_row = judged.groupBy("row").agg(F.sort_array(F.collect_list("span")).alias("spans"))
    return found.select("row", "doc_id").join(per_row, "row", "left").select(
        "row", "doc_id", F.coalesce("spans", F.array().cast(per_row.schema["spans"].dataType))
        .alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind_no"]), s["start"].cast("string"), s["end"].cast("string"))))
