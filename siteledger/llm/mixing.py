"""Mixing of sources to target weights by order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteledger.llm.common import WORD, packed, saved, unpacked

#: Steps of the distribution of ranks over which words are summed before any are ordered.
RANK_STEPS = 65_536


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Targets are the smaller of ``most`` times the source and a common level times its weight;
    the level is found where the sources below it, in the order of cap over weight, are full.
    Reads one row per source.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("w", weight).withColumn("cap", most * F.col("source_size"))
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "total": share * F.sum("source_size").over(everything),
        "full": F.coalesce(F.sum("cap").over(order), F.lit(0.0)),
        "left": F.sum("w").over(everything) - F.coalesce(F.sum("w").over(order), F.lit(0.0)),
    })
    level = (F.col("total") - F.col("full")) / F.col("left")
    found = rows.withColumn("level", F.max(F.when(level <= F.col("cap") / F.col("w"), level)).over(everything))
    return found.select("source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("w"), F.col("cap"))).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """How many copies of each document a mix takes: (doc_id, source, size, source_size, target, copies).

    A source's target over its size is what each of its documents should be taken on average.
    Whole copies of that are certain; the rest is the inclusion probability p of one more.
    Documents draw u from a hash of seed, id and text and are ranked within their source by
    Pareto order: u / (1 - u) over p / (1 - p). The sample is the beginning of that order, as
    long as its words come nearest to what the target has left, so its size is fixed, not random.

    A source may hold any part of the rows: words are first summed over ``RANK_STEPS`` equal steps
    of the rank's distribution, and only the step in which a source's sample ends is put in order.
    Nulls: a null text has size 0, a null source is a source of its own, last in order. Documents
    without words rank like others and add nothing. Repeated rows draw the same u and stand next
    to each other. Empty tables give no rows; where all sizes are 0, nothing is taken.
    """
    slim = saved(_sized(docs, seed).drop("row"), "sizes")
    return _decided(slim, _plan(slim, weights, share, most))


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """The mix itself: each document as often as ``mix`` takes it, with the columns of ``docs``."""
    rows = _sized(docs, seed)
    taken = _decided(rows, _plan(saved(rows.drop("row"), "sizes"), weights, share, most)).where("copies > 0")
    return unpacked(taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")))


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return packed(docs, doc_id=F.col("doc_id").cast("long"), source=F.col("source").cast("string"), size=word_count(F.col("text")), draw=F.xxhash64(F.lit(seed), F.col("doc_id"), text))


def _plan(slim: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source: its target and the last document that its sample takes. Written, so that its size is known."""
    targets = saved(source_targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets")
    cut = _cuts(slim, targets)
    plan = targets.join(cut, targets.source.eqNullSafe(cut.cut_source), "left").drop("cut_source")
    return saved(plan.withColumnRenamed("source", "plan_source"), "plan")


def _decided(rows: DataFrame, plan: DataFrame) -> DataFrame:
    joined = rows.join(plan, rows.source.eqNullSafe(plan.plan_source))
    return joined.withColumn("copies", _copies()).drop("plan_source", "last", "draw")


def _whole() -> Column:
    return F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(F.lit(0)).cast("long")


def _rank() -> Column:
    """Pareto rank, mapped from (0, inf) to (0, 1)."""
    u = (F.shiftrightunsigned(F.col("draw"), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
    p = F.greatest(F.col("target") / F.greatest(F.col("source_size"), F.lit(1)) - _whole(), F.lit(0.0))
    return u * (1 - p) / (u * (1 - p) + (1 - u) * p)  # x / (1 + x) of the rank x


def _copies() -> Column:
    last = F.struct(F.col("last.rank"), F.col("last.draw"), F.col("last.doc_id"))
    mine = F.struct(_rank().alias("rank"), F.col("draw"), F.col("doc_id"))
    return _whole() + F.when(F.col("last.rank").isNotNull() & (mine <= last), 1).otherwise(0)


def _cuts(slim: DataFrame, targets: DataFrame) -> DataFrame:
    """(cut_source, last): the last document in rank order that each source's sample takes."""
    rest = targets.withColumn("rest", F.col("target") - _whole() * F.col("source_size")).where("source_size > 0 AND rest > 0").withColumnRenamed("source", "cut_source")
    ranked = slim.join(rest, slim.source.eqNullSafe(rest.cut_source)).withColumn("rank", _rank())
    ranked = ranked.withColumn("step", F.least(F.floor(F.col("rank") * RANK_STEPS), F.lit(RANK_STEPS - 1)).cast("int"))
    sums = ranked.groupBy("cut_source", "step").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
    up_to = Window.partitionBy("cut_source").orderBy("step")
    steps = sums.withColumn("before", F.sum("words").over(up_to) - F.col("words"))
    # the step in which the words left run out; where they never do, the last one
    inside = steps.where(F.col("before") < F.col("rest")).groupBy("cut_source").agg(F.max_by(F.struct("step", "before"), "step").alias("in"))
    at = saved(inside.select(F.col("cut_source").alias("at_source"), F.col("in.step").alias("at_step"), "in.before"), "cuts")
    near = ranked.join(at, ranked.cut_source.eqNullSafe(at.at_source) & (F.col("step") == F.col("at_step")))
    order = Window.partitionBy("cut_source").orderBy("rank", "draw", "doc_id")
    taken = near.withColumn("off", F.abs(F.col("before") + F.sum("size").over(order) - F.col("rest")))
    here = F.struct("rank", "draw", "doc_id")
    best = taken.groupBy("cut_source").agg(F.min_by(here, F.struct("off", "rank", "draw", "doc_id")).alias("last"), F.min("off").alias("off"), F.first(F.col("rest") - F.col("before")).alias("short"), F.first("at_step").alias("at_step"))
    low = F.lit(-(1 << 63)).cast("long")
    bound = F.struct((F.col("at_step") / F.lit(float(RANK_STEPS))).alias("rank"), low.alias("draw"), low.alias("doc_id"))
    return best.select("cut_source", F.when(F.col("short") < F.col("off"), bound).otherwise(F.col("last")).alias("last"))
