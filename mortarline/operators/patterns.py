"""Pattern intelligence: how often an entity recurs, what is said of it, and how healthy that looks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mortarline.functions import phrases as P
from mortarline.functions.dialect import SPARK, Dialect


def pattern_type(d: Dialect, name: str, n: str, escalates: str) -> str:
    problem = d.has(f"lower({name})", P.PROBLEM_NAMES)
    return d.first([(f"{n} >= 10 AND {problem}", "stagnation"), (f"{n} >= 10", "convergence"), (f"{n} <= 3", "abandonment"), (escalates, "escalation")], "fragmentation")


def momentum(d: Dialect, n: str, mean: str) -> str:
    return d.first([(f"{n} > {mean} * 1.5", "increasing"), (f"{n} < {mean} * 0.5", "decreasing")], "stable")


def confidence_vote(d: Dialect, n: str, high: str, med: str) -> str:
    return d.first([(f"{high} * 2 > {n}", "high"), (f"({med} + {high}) * 2 > {n}", "med")], "low")


def health(d: Dialect, pattern: str, moving: str, sure: str) -> str:
    """0 to 100 from the pattern, the signals, the momentum and the confidence, cut to a whole number."""
    tenths = d.weights(sure, {k: round(v * 10) for k, v in P.CONFIDENCE_FACTOR.items()}, 10)
    points = f"({d.weights(pattern, P.PATTERN_BASE, 0)} + positive * 5 - negative * 5 + replication * 3 + least(neutral, 5) + {d.weights(moving, P.MOMENTUM_POINTS, 0)})"
    return f"greatest(0, least(100, {d.truncated(f'{points} * {tenths} / 10')}))"


def interpretation(d: Dialect, name: str, score: str, pattern: str) -> str:
    mood = d.first([(f"{score} >= {n}", text) for n, text in P.HEALTH_TEXT[:-1]], P.HEALTH_TEXT[-1][1])
    shape = d.first([(f"{pattern} = {d.text(k)}", v) for k, v in P.PATTERN_TEXT.items()], "")
    tone = d.first([("positive > negative", "and predominantly positive outcome language"), ("negative > positive", "and predominantly negative outcome language")], "and mixed outcome language")
    return f"concat({name}, ' shows ', {mood}, ' ', {shape}, ' ', {tone}, '.')"


def analyze_patterns(entities: DataFrame, links: DataFrame, events: DataFrame, top: int | None = 50) -> DataFrame:
    """One row for each of the ``top`` most linked entities, or of all with None, healthiest first.

    A signal phrase counts once per entity, in however many of its snippets it
    stands.  Ties in the number of links go by entity_id.  Entities without a
    linked event get no row.
    """
    counts = links.where("entity_id is not null").groupBy("entity_id").agg(F.count("*").alias("n"))
    chosen = counts.join(entities.select("entity_id", "entity_name", "entity_type"), "entity_id")
    if top is not None:
        chosen = chosen.orderBy(F.desc("n"), "entity_id").limit(top)
    mean = chosen.agg(F.avg("n").alias("mean"))
    phrases = [(group, i, p) for group, ps in P.SIGNALS.items() for i, p in enumerate(ps)]
    said = links.join(chosen.select("entity_id"), "entity_id").join(events.select("event_id", F.lower(F.coalesce("evidence_snippet", F.lit(""))).alias("s"), "confidence"), "event_id")
    # phrases are flagged per event, so that an entity's snippets never have to be in one place
    flags = [F.bool_or(F.contains("s", F.lit(p))).cast("int").alias(f"_{g}_{i}") for g, i, p in phrases]
    rows = said.groupBy("entity_id").agg(F.count("*").alias("n_rows"), F.count_if(F.col("confidence") == "high").alias("high"), F.count_if(F.col("confidence") == "med").alias("med"), F.bool_or(F.expr(SPARK.has("s", P.ESCALATION_TERMS))).alias("escalates"), *flags)
    totals = {g: sum((F.col(f"_{g}_{i}") for i in range(len(ps))), F.lit(0)) for g, ps in P.SIGNALS.items()}
    rows = rows.select("entity_id", "n_rows", "high", "med", "escalates", *[v.alias(g) for g, v in totals.items()])
    out = chosen.withColumn("mean", mean.scalar()).join(rows, "entity_id")
    out = out.withColumn("pattern_type", F.expr(pattern_type(SPARK, "entity_name", "n", "escalates"))).withColumn("momentum", F.expr(momentum(SPARK, "n", "mean"))).withColumn("confidence_level", F.expr(confidence_vote(SPARK, "n_rows", "high", "med")))
    out = out.withColumn("health_score", F.expr(health(SPARK, "pattern_type", "momentum", "confidence_level")))
    out = out.withColumn("interpretation", F.expr(interpretation(SPARK, "entity_name", "health_score", "pattern_type")))
    columns = ("entity_id", "entity_name", "entity_type", "pattern_type", "health_score", F.col("n").alias("event_count"), "positive", "neutral", "negative", "replication", "momentum", "confidence_level", "interpretation")
    return out.select(*columns).orderBy(F.desc("health_score"), F.desc("event_count"), "entity_id")


def health_ranges(patterns: DataFrame) -> DataFrame:
    low = F.floor(F.least("health_score", F.lit(99)) / 20) * 20
    return patterns.groupBy(low.cast("int").alias("range_start"), "pattern_type").agg(F.count("*").alias("n"))


def pattern_csv(patterns: DataFrame, exported: str) -> DataFrame:
    """The columns of a pattern export, in order, with one time stamp for all rows."""
    total = sum((F.col(c) for c in ("positive", "neutral", "negative", "replication")), F.lit(0))
    signals = [F.col(c).alias(f"{c}_signals") for c in ("positive", "neutral", "negative", "replication")]
    return patterns.select("entity_name", "entity_type", "pattern_type", "health_score", "event_count", *signals, total.alias("total_signals"), F.col("momentum").alias("time_momentum"), "confidence_level", "interpretation", F.lit(exported).alias("export_timestamp"))
