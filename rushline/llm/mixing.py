"""Mixing sources to target weights by entropy balancing.

Tokens are the unit: the mix is the one nearest to the input, in relative
entropy over tokens, that gives every group its target. Its document rates are
exponentially tilted, prior * exp(sum of the multipliers of the document's
groups), and held at ``max_rate``. Newton iterations solve the convex dual; each
is one aggregate over counts per (groups, prior), which the documents are summed
to before. Rates are then rounded into whole copies: every document takes the
whole part, and those with the smallest hashed priority one more, up to the
threshold at which the source meets its target.

Defined results: NULL and empty texts have size 0 and no effect; NULL groups are
a group of their own, last in order; equal rows share their copies; a group of
size 0 has target 0; an empty table gives an empty result. Extra columns, of any
name, are kept by ``with_copies`` and never read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rushline.llm.common import fresh, join_few, stored, text_or_empty, words_of
from rushline.operators.ranking import numbered


@dataclass(frozen=True)
class Balance:
    max_rate: int = 3
    iterations: int = 40
    tolerance: float = 1e-9
    #: Slots per group and step of the search for the rounding threshold.
    slots: int = 4096
    steps: int = 3
    #: Single documents moved by one copy to close what is left, per group.
    corrections: int = 3


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def ranked_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``sources`` with ``weight``: the weights repeat over the sources in order of
    code points, NULL last. The rank comes from a distributed sort."""
    ranked = numbered(sources, [F.col("source").asc_nulls_last()], "weight")
    repeated = F.array(*[F.lit(float(w)) for w in weights])
    return ranked.withColumn("weight", F.get(repeated, (F.col("weight") % len(weights)).cast("int")))


def filled_targets(sources: DataFrame, max_rate: int) -> DataFrame:
    """``sources`` (source, tokens, weight, ...) with ``target``.

    All tokens are shared by weight; a target above max_rate times its tokens
    stops there and the excess is shared again, until none is above. Each round
    is one small aggregate; the driver holds sums, never the groups.
    """
    at = sources.withColumn("capped", F.lit(False))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    limit = max_rate * F.col("tokens")
    known, share = -1, 0.0
    while True:
        held, open_weight, n = at.agg(
            F.coalesce(F.sum(F.when(F.col("capped"), limit)), F.lit(0)),
            F.coalesce(F.sum(F.when(~F.col("capped"), F.col("weight"))), F.lit(0.0)),
            F.coalesce(F.sum(F.col("capped").cast("long")), F.lit(0))).first()
        if n == known or not open_weight:
            break
        share, known = (total - held) / open_weight, n
        at = sources.withColumn("capped", share * F.col("weight") > limit)
    return sources.withColumn("target", F.least(
        limit.cast("double"), share * F.col("weight")))


def newton(cells: DataFrame, targets: list[DataFrame], rule: Balance) -> list[DataFrame]:
    """The multipliers of every family of groups: (group, multiplier) each.

    ``cells`` hold g0, g1, ... (a group per family), prior and tokens; ``targets``
    one table (group, target) per family. A family's groups are disjoint, so its
    Hessian is diagonal and a Newton step needs two sums per group. Several
    families take turns. The multipliers are stored after each step.
    """
    state = [None] * len(targets)
    for f, wanted in enumerate(targets):
        sums = cells.groupBy(F.col(f"g{f}").alias("group_")).agg(
            F.sum(F.col("prior") * F.col("tokens")).alias("mass"))
        start = F.when((F.col("mass") > 0) & (F.col("target") > 0),
                       F.log(F.col("target") / F.col("mass"))).otherwise(F.lit(0.0))
        held = wanted.join(sums, F.col("group").eqNullSafe(F.col("group_")), "left")
        # A single family starts at the answer for documents below max_rate.
        state[f] = stored(held.select(
            "group", "target", (start if f == 0 else F.lit(0.0)).alias("multiplier")), "mix_state")
    for step in range(rule.iterations):
        f = step % len(targets)
        rated = cells.withColumn("log_rate", F.log("prior"))
        for k, table in enumerate(state):
            own = table.select(F.col("group").alias(f"s{k}"), F.col("multiplier").alias(f"m{k}"),
                               F.col("target").alias(f"t{k}"))
            rated = rated.join(own, F.col(f"g{k}").eqNullSafe(F.col(f"s{k}"))).withColumn(
                "log_rate", F.col("log_rate") + F.col(f"m{k}"))
        inside = F.col("log_rate") < math.log(rule.max_rate)
        mass = F.col("tokens") * F.exp("log_rate")
        sums = rated.groupBy(F.col(f"g{f}").alias("group_")).agg(
            F.sum(F.when(inside, mass).otherwise(rule.max_rate * F.col("tokens"))).alias("got"),
            F.sum(F.when(inside, mass).otherwise(0.0)).alias("slope"))
        gap = F.col("target") - F.col("got")
        move = F.when(F.col("slope") > 0, F.greatest(F.lit(-2.0), F.least(
            F.lit(2.0), gap / F.col("slope")))).otherwise(F.lit(0.0))
        moved = state[f].join(sums, F.col("group").eqNullSafe(F.col("group_")), "left").select(
            "group", "target", (F.col("multiplier") + F.coalesce(move, F.lit(0.0))).alias("multiplier"),
            F.when(F.col("slope") > 0, F.abs(gap) / F.greatest("target", F.lit(1.0)))
            .otherwise(0.0).alias("gap"))
        state[f] = stored(moved, "mix_state")
        worst = state[f].agg(F.max("gap")).first()[0]
        if (worst or 0.0) < rule.tolerance and step + 1 >= len(targets):
            break
    return [s.select("group", "multiplier") for s in state]


def priority(key: Column, fraction: Column) -> Column:
    """Sequential Poisson order: a uniform hash of the key over the fraction."""
    uniform = F.shiftrightunsigned(F.xxhash64(key, F.lit("mix")), 11) / F.lit(float(1 << 53))
    return F.when(fraction > 0, uniform / fraction)


def rounded(sized: DataFrame, rates: DataFrame, rule: Balance) -> DataFrame:
    """(source, multiplier, target, threshold, add, cut): how each group rounds.

    ``sized`` has key, source, prior, size; ``rates`` (source, multiplier, target).
    The threshold is searched in ``steps`` histograms of the priority, each over
    the slot of the one before where the need is met, so no group is ever sorted.
    Then a few single documents take one copy more (``add``) or less (``cut``).
    """
    scored = stored(copy_parts(sized, rates, rule).where(F.col("size") > 0), "mix_scored")
    group = F.col("source").eqNullSafe(F.col("source_"))

    def by(name):
        return F.col(name).alias("source_")

    bounds = stored(rates.join(
        scored.groupBy(by("source")).agg(
            F.sum(F.col("whole") * F.col("size")).alias("whole_tokens")), group, "left"
    ).select("source", "multiplier", "target", (
        F.col("target") - F.coalesce("whole_tokens", F.lit(0))).alias("need"),
        F.lit(0.0).alias("low"), F.lit(float(1 << 20)).alias("width"), F.lit(0).cast("long").alias("below")),
        "mix_bounds")
    for step in range(rule.steps):
        # The first histogram covers 0 .. 2 finely, with all beyond in its last slot.
        width = F.lit(2.0) if step == 0 else F.col("width")
        inside = of_source(scored, bounds.select(by("source"), "low", "width")).where(
            (F.col("priority") >= F.col("low")) & (F.col("priority") < F.col("low") + F.col("width")))
        slot = F.least(F.floor((F.col("priority") - F.col("low")) / width * rule.slots),
                       F.lit(rule.slots - 1)).cast("long")
        counted = inside.groupBy(by("source"), slot.alias("slot")).agg(
            F.sum("size").alias("tokens"))
        upto = Window.partitionBy("source_").orderBy("slot").rowsBetween(
            Window.unboundedPreceding, 0)
        cumulated = counted.withColumn("upto", F.sum("tokens").over(upto))
        # The first slot in which the need is passed; beyond the last none is.
        crossing = cumulated.join(bounds.select("source", "need", F.col("below").alias("below0")), group).where(
            F.col("below0") + F.col("upto") > F.col("need")).groupBy("source_").agg(
            F.min(F.struct("slot", (F.col("upto") - F.col("tokens")).alias("before"))).alias("c"))
        unit = (F.lit(2.0) if step == 0 else F.col("width")) / rule.slots
        last = F.col("c.slot") == rule.slots - 1
        bounds = stored(bounds.join(crossing, group, "left").select(
            "source", "multiplier", "target", "need",
            F.when(F.col("c").isNull(), F.col("low")).otherwise(
                F.col("low") + F.col("c.slot") * unit).alias("low"),
            F.when(F.col("c").isNull(), F.col("width")).when(
                last & F.lit(step == 0), F.col("width")).otherwise(unit).alias("width"),
            (F.col("below") + F.coalesce("c.before", F.lit(0))).alias("below"),
            F.col("c").isNull().alias("all")), "mix_bounds")
    state = bounds.select(
        "source", "multiplier", "target",
        F.when(F.col("all"), F.lit(float(1 << 21))).otherwise(F.col("low")).alias("threshold"),
        F.array().cast("array<bigint>").alias("add"), F.array().cast("array<bigint>").alias("cut"))
    state = stored(state, "mix_rounding")
    for _ in range(rule.corrections):
        given = of_source(scored, state.select(by("source"), "threshold", "add", "cut", "target"))
        extra = extra_copies()
        got = given.groupBy(by("source")).agg(F.sum(
            (F.col("whole") + extra) * F.col("size")).alias("got"))
        left = stored(state.select("source", (F.col("target")).alias("want")).join(got, group).select(
            by("source"), (F.col("want") - F.col("got")).alias("left")), "mix_left")
        fitting = of_source(given.drop("source_"), left).where(
            (F.col("whole") < rule.max_rate) & (F.col("priority").isNotNull())
            & F.when(F.col("left") > 0, extra == 0).otherwise(extra == 1)
            & (F.col("size") < 2 * F.abs("left")))
        best = fitting.groupBy("source_", F.col("left")).agg(F.min(F.struct(
            F.abs(F.abs("left") - F.col("size")).alias("miss"), F.col("key"))).alias("best"))
        state = stored(state.join(best, group, "left").select(
            "source", "multiplier", "target", "threshold",
            F.when(F.col("left") > 0, F.array_append("add", F.col("best.key")))
            .otherwise(F.col("add")).alias("add"),
            F.when(F.col("left") < 0, F.array_append("cut", F.col("best.key")))
            .otherwise(F.col("cut")).alias("cut")), "mix_rounding")
    return state


def copy_parts(sized: DataFrame, rates: DataFrame, rule: Balance) -> DataFrame:
    """``sized`` with the whole part of its rate and its priority for one more."""
    own = rates.select(F.col("source").alias("source_"), F.col("multiplier").alias("multiplier_"))
    rate = F.least(F.lit(float(rule.max_rate)), F.col("prior") * F.exp("multiplier_"))
    return of_source(sized, own).withColumn(
        "rate", rate).withColumn("whole", F.floor("rate").cast("long")).withColumn(
        "priority", priority(F.col("key"), F.col("rate") - F.col("whole"))).drop(
        "source_", "multiplier_")


def extra_copies() -> Column:
    """1 for rows below their group's threshold, but for the corrected ones."""
    inside = F.coalesce(F.col("priority") < F.col("threshold"), F.lit(False))
    takes = (inside & ~F.array_contains("cut", F.col("key"))) | F.array_contains("add", F.col("key"))
    return takes.cast("long")


def of_source(rows: DataFrame, table: DataFrame) -> DataFrame:
    """Rows beside what a stored table, a row per ``source_``, says of their source."""
    return join_few(rows, table, "source", "source_", F.col("key"))


def document_key() -> Column:
    """Equal for equal rows: the id and the whole text."""
    return F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"))


def plan(
    docs: DataFrame, weights: Sequence[float], rule: Balance = Balance(),
) -> tuple[DataFrame, DataFrame]:
    """The stored sizes (doc_id, key, source, prior, size) of all rows, and
    (source, tokens, target, multiplier, threshold, add, cut): a row per source,
    all that is needed to give every document its copies."""
    sized = stored(docs.select(
        "doc_id", document_key().alias("key"), F.col("source").cast("string").alias("source"),
        F.lit(1.0).alias("prior"), word_count(text_or_empty()).alias("size")), "mix_sizes")
    cells = stored(sized.groupBy(F.col("source").alias("g0"), "prior").agg(
        F.sum("size").alias("tokens")), "mix_cells")
    sources = cells.groupBy(F.col("g0").alias("source")).agg(F.sum("tokens").alias("tokens"))
    weighted = stored(ranked_weights(sources, weights), "mix_sources")
    targets = stored(filled_targets(weighted, rule.max_rate), "mix_targets")
    (multipliers,) = newton(
        cells, [targets.select(F.col("source").alias("group"), "target")], rule)
    rates = targets.join(
        multipliers, F.col("source").eqNullSafe(F.col("group"))).select(
        "source", "multiplier", "target")
    rounding = rounded(sized, stored(rates, "mix_rates"), rule)
    decided = targets.select(F.col("source").alias("source_"), "tokens").join(
        rounding, F.col("source").eqNullSafe(F.col("source_"))).drop("source_")
    return sized, stored(decided, "mix_plan")


def mixed_sizes(
    docs: DataFrame, weights: Sequence[float], rule: Balance = Balance(),
) -> DataFrame:
    """(doc_id, size, source_size, target, copies) of every row; texts are read once."""
    sized, decided = plan(docs, weights, rule)
    own = decided.withColumnsRenamed({"source": "source_", "multiplier": "multiplier_of"})
    rates = decided.select("source", "multiplier")
    joined = of_source(copy_parts(sized, rates, rule), own)
    return joined.select(
        "doc_id", "size", F.col("tokens").alias("source_size"), "target",
        (F.col("whole") + extra_copies()).alias("copies"))


def with_copies(
    docs: DataFrame, weights: Sequence[float], rule: Balance = Balance(), into: str = "mix",
) -> DataFrame:
    """All columns of ``docs`` and the struct ``into``: size, source_size, target, copies.

    A map over the documents while the sources are few enough to broadcast.
    """
    name = fresh(docs, "plan_of_source")
    source, of_plan = fresh(docs, "source_text"), fresh(docs, "source_of_plan")
    decided = plan(docs, weights, rule)[1].select(
        F.struct("*").alias(name), F.col("source").alias(of_plan))
    fraction = F.least(F.lit(float(rule.max_rate)), F.exp(f"{name}.multiplier"))
    joined = join_few(docs.withColumn(source, docs["source"].cast("string")), decided, source, of_plan,
                      document_key()).drop(source, of_plan)
    own = F.struct(
        document_key().alias("key"), word_count(text_or_empty()).alias("size"),
        F.floor(fraction).cast("long").alias("whole"),
        (fraction - F.floor(fraction)).alias("fraction"))
    prepared = joined.withColumn(into, own)
    part, of = F.col(into), F.col(name)
    rank = priority(part["key"], part["fraction"])
    takes = ((F.coalesce(rank < of["threshold"], F.lit(False))
              & ~F.array_contains(of["cut"], part["key"]))
             | F.array_contains(of["add"], part["key"]))
    return prepared.withColumn(into, F.struct(
        part["size"].alias("size"), of["tokens"].alias("source_size"),
        of["target"].alias("target"), (part["whole"] + takes.cast("long")).alias("copies"),
    )).drop(name)
