"""Mixing sources by temperature.

A source's share of the tokens, raised to an exponent between 0 (all sources
alike) and 1 (as they are) and normalised, is its weight. The exponent is found
by bisection: the smallest that keeps every source within a number of
repetitions, or the one whose weights have a given entropy. Weights become
budgets of tokens. A source's documents lie in a fixed random order, its
permutation, which is gone through as often as the budget allows and then up to
a cut; the cut is found from sums over blocks of the permutation, so that no
task sees a whole source. Every copy gets a block of the mixture and a place in
it; a block holds all sources in proportion to their weights.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedpulse.llm.arrow import clear_of
from feedpulse.sources.scratch import stored

#: Exponents tried at once: as good as five halvings.
TRIED = 31
PASSES = 7
DOCS_IN_BLOCK = 2_000
TOKENS_IN_BLOCK = 1_000_000
BROADCAST_SOURCES = 10_000
TOLERANCE = 1e-9


def tokens(text: str) -> Column:
    """Words between ASCII white space; null has none."""
    words = F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x09-\x0D ]+"))
    return F.coalesce(words, F.lit(0)).cast("long")


def place(doc_id: str, seed: int, epoch: Column | None = None) -> Column:
    """A document's place in its source's permutation, or with an epoch, in the mixture."""
    return F.xxhash64(F.lit(seed), F.lit(-1) if epoch is None else epoch, F.col(doc_id).cast("string"))


def shares(places: DataFrame) -> DataFrame:
    """(source, tokens, docs, share) of a table of (source, place, tokens, docs); stored."""
    by_source = places.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs"))
    total = by_source.agg(F.sum("tokens").alias("all_tokens"))
    return stored(by_source.join(F.broadcast(total)).withColumn("share", F.expr("coalesce(try_divide(tokens, all_tokens), 0.0)")), "shares")


def _measures(shares: DataFrame, exponents: list[float]) -> list[dict[str, float]]:
    """For each exponent the entropy of the weights, and the largest and smallest ratio of weight to share."""
    aggregates = []
    for i, a in enumerate(exponents):
        p, power = F.col("share"), F.pow("share", F.lit(a))
        ratio = F.pow("share", F.lit(a - 1))
        parts = {"z": F.sum(power), "l": F.sum(power * F.log(p)), "high": F.max(ratio), "low": F.min(ratio)}
        aggregates += [e.alias(f"{name}{i}") for name, e in parts.items()]
    row = shares.where("share > 0").agg(*aggregates).first().asDict()
    out = []
    for i, a in enumerate(exponents):
        z, l = row[f"z{i}"], row[f"l{i}"]
        if not z:
            return [{"entropy": 0.0, "high": 1.0, "low": 1.0}] * len(exponents)
        out.append({"entropy": math.log(z) - a * l / z, "high": row[f"high{i}"] / z, "low": row[f"low{i}"] / z})
    return out


def repeats(measure: dict[str, float], scale: float | None) -> float:
    """How often the most repeated source comes; ``scale``: tokens asked for, as a multiple of all."""
    return measure["high"] * (1 / measure["low"] if scale is None else scale)


def exponent(
    shares: DataFrame,
    max_repeats: float | None = 2.0,
    entropy: float | None = None,
    scale: float | None = None,
) -> tuple[float, dict[str, float]]:
    """The exponent and the measures there.

    Both the entropy and the repetitions fall as the exponent grows to 1. The
    smallest exponent is taken that meets every limit given: repetitions at most
    ``max_repeats``, entropy (nats) at most ``entropy``. If none does, it is 1.
    """

    def meets(m: dict[str, float]) -> bool:
        few = max_repeats is None or repeats(m, scale) <= max_repeats * (1 + TOLERANCE)
        return few and (entropy is None or m["entropy"] <= entropy + TOLERANCE)

    first, last = _measures(shares, [0.0, 1.0])
    if meets(first):
        return 0.0, first
    low, high, best = 0.0, 1.0, last
    for _ in range(PASSES):
        tried = [low + (high - low) * (i + 1) / (TRIED + 1) for i in range(TRIED)]
        measured = _measures(shares, tried)
        good = [i for i, m in enumerate(measured) if meets(m)]
        if not good:
            low = tried[-1]
            continue
        at = good[0]
        low, high, best = (tried[at - 1] if at else low), tried[at], measured[at]
    return high, best


def source_plan(places: DataFrame, max_repeats: float | None, entropy: float | None, scale: float | None) -> DataFrame:
    """(source, epochs, cut): whole runs through the permutation, and the last place of the run after."""
    by_source = shares(places)
    a, m = exponent(by_source, max_repeats, entropy, scale)
    multiple = 1 / m["low"] if scale is None else scale
    z = _measures(by_source, [a])[0]["high"]
    ratio = F.when(F.col("share") > 0, F.pow("share", F.lit(a - 1))).otherwise(None)
    top = by_source.agg(F.max(F.when(F.col("share") > 0, F.pow("share", F.lit(a - 1)))).alias("top"))
    times = F.coalesce(ratio / F.col("top") * z * multiple, F.lit(1.0))
    planned = by_source.join(F.broadcast(top)).withColumn("times", times)
    planned = planned.withColumn("epochs", F.floor(F.col("times") + TOLERANCE).cast("int"))
    planned = planned.withColumn(
        "rest", F.floor(F.greatest(F.col("times") - F.col("epochs"), F.lit(0.0)) * F.col("tokens")).cast("long")
    ).withColumn("blocks", F.ceil(F.col("docs") / DOCS_IN_BLOCK))
    planned = planned.select("source", "epochs", "rest", "blocks")
    # The block of a place: equal parts of the hash's range, in its order.
    block = F.floor((F.col("place") / 2.0**64 + 0.5) * F.col("blocks")).cast("long")
    laid = places.withColumnRenamed("source", "own").join(planned, F.col("own").eqNullSafe(F.col("source")))
    laid = laid.withColumn("block", F.least(block, F.col("blocks") - 1))
    sums = laid.groupBy("source", "block").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    order = Window.partitionBy("source").orderBy("block")
    cut_blocks = (
        sums.withColumn("upto", F.sum("tokens").over(order))
        .where("upto > rest")
        .groupBy("source")
        .agg(F.min_by(F.struct("block", (F.col("rest") - F.col("upto") + F.col("tokens")).alias("left")), "block").alias("at"))
        .select(F.col("source").alias("cut_source"), "at.*")
    )
    inside = laid.drop("rest").join(
        cut_blocks.withColumnRenamed("block", "cut_block"),
        F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("block") == F.col("cut_block")),
    )
    run = Window.partitionBy("source").orderBy("place")
    cuts = (
        inside.withColumn("upto", F.sum("tokens").over(run))
        .groupBy("source")
        .agg(
            F.max(F.when(F.col("upto") <= F.col("left"), F.col("place"))).alias("last"),
            (F.min("place") - 1).alias("before"),
        )
        .select(F.col("source").alias("cut_source"), F.coalesce("last", "before").alias("cut"))
    )
    # A source without a cut block has a rest of nothing but its empty texts, or all of it.
    joined = planned.join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left")
    cut = F.when(F.col("rest") <= 0, F.lit(None)).otherwise(F.coalesce("cut", F.lit(2**63 - 1)))
    return stored(joined.select("source", "epochs", cut.cast("long").alias("cut")), "plan")


def mixture(
    docs: DataFrame,
    max_repeats: float | None = 2.0,
    entropy: float | None = None,
    scale: float | None = None,
    seed: int = 42,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``docs``, a row for each copy in the mixture, with ``epoch``, ``block`` and ``place``.

    The mixture has ``scale`` times the tokens of ``docs``; by default as many as
    let every document in at least once. Documents are whole, so a source stays
    below its budget by less than one. Sorted by place within blocks, the rows
    are in their final order.

    A null source is a source of its own. Rows with the same id and source are
    taken or left together, as are all null ids. Texts without words cost
    nothing. A source of only such texts comes once. An empty table gives an empty
    result. Clashing columns give way to the new ones.
    """
    new = ("epoch", "block", "place")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in new])
    at = place(f"`{doc_id}`", seed)
    places = stored(
        docs.select(F.col(f"`{source}`").alias("source"), at.alias("place"), tokens(f"`{text}`").alias("tokens"))
        .groupBy("source", "place")
        .agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs")),
        "places",
    )
    plan = source_plan(places, max_repeats, entropy, scale)
    own, epochs, cut, copies = (clear_of(docs, x) for x in ("plan_source", "epochs", "cut", "copies"))
    plan = plan.select(F.col("source").alias(own), F.col("epochs").alias(epochs), F.col("cut").alias(cut))
    if plan.count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    joined = docs.join(plan, F.col(f"`{source}`").eqNullSafe(F.col(f"`{own}`")))
    last = F.when(at <= F.col(f"`{cut}`"), 1).otherwise(0)
    joined = joined.withColumn(copies, F.col(f"`{epochs}`") + last).where(f"`{copies}` > 0")
    total = places.agg(F.sum("tokens")).first()[0] or 0
    blocks = max(1, math.ceil(total * (scale or 1) / TOKENS_IN_BLOCK))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    out = joined.select(*kept, F.explode(F.sequence(F.lit(0), F.col(f"`{copies}`") - 1)).alias("epoch"))
    where = place(f"`{doc_id}`", seed, F.col("epoch"))
    return out.withColumn("block", F.pmod(F.xxhash64(where), F.lit(blocks)).cast("int")).withColumn("place", where)
