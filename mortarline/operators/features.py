"""Per-entity feature table from events (problem 7).

One grouped pass of conditional counts and a latest time makes the totals of an
entity and type.  They are combined before the shuffle, so an entity that holds a
third of all rows sends at most one narrow row per task and type.  A fixed list
of types lays them out as columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortarline.functions.normalize import iso_timestamp, snake

OUTCOMES = ("failed", "weak", "moderate", "improved", "successful", "unknown")
#: More types than this do not fit one wide row; the long form has no such bound.
MAX_WIDE_TYPES = 1000


def latest_events(events: DataFrame) -> DataFrame:
    """Each event once: the delivery with the latest loaded_at.

    Ties on loaded_at are broken by the row's own values.  Rows without event_id
    name no event and are dropped.  event_type and outcome are put in their
    standard notation (null: 'unknown'), created_at becomes ``ts`` (null if
    absent or unreadable).
    """
    rows = events.where(F.col("event_id").isNotNull()).select(
        "event_id",
        F.coalesce(snake(F.col("event_type")), F.lit("unknown")).alias("event_type"),
        F.coalesce(snake(F.col("outcome")), F.lit("unknown")).alias("outcome"),
        iso_timestamp(F.col("created_at")).alias("ts"),
        "loaded_at",
    )
    newest = F.max(F.struct("loaded_at", "ts", "event_type", "outcome"))
    return rows.groupBy("event_id").agg(newest.alias("d")).select("event_id", "d.event_type", "d.outcome", "d.ts")


def entity_events(events: DataFrame, links: DataFrame) -> DataFrame:
    """Distinct (entity, event) pairs with the event's type, outcome and time.

    ``events`` is the result of latest_events.  Links without entity_id or
    event_id, and links to events that do not exist, are dropped.
    """
    links = links.select("event_id", "entity_id").dropna()
    return links.join(events, "event_id").dropDuplicates(["entity_id", "event_id"])


def _name(kind: str, what: str) -> str:
    return f"{kind.replace('/', '__')}__{what}"


def feature_cells(pairs: DataFrame, outcomes: Sequence[str] = OUTCOMES) -> DataFrame:
    """(entity_id, event_type, n, last, one count per outcome, other_outcomes): a row for each type an entity has events of.

    One grouped pass of conditional counts and a maximum; what a task has of an
    entity and type is combined before it is shuffled.
    """
    conditional = [F.count_if(F.col("outcome") == o).alias(o) for o in outcomes]
    other = F.count_if(~F.col("outcome").isin(*outcomes)).alias("other_outcomes")
    return pairs.groupBy("entity_id", "event_type").agg(F.count("*").alias("n"), F.max("ts").alias("last"), *conditional, other)


def entity_features(pairs: DataFrame, types: Sequence[str], as_of: Column | None = None, outcomes: Sequence[str] = OUTCOMES) -> DataFrame:
    """One row per entity_id: for each type its events, recency and outcome totals.

    Columns of type ``kind/topic``: ``kind__topic__n`` (events), ``__last``
    (latest created_at, null if none is known), one count per outcome and, with
    ``as_of``, ``__days_since`` (days from the latest event to it, negative for
    events in the future).  Events of types that are not listed are counted in
    ``other_types__n``; those of other outcomes in ``__n`` alone, so no event is
    lost.  Entities without events have no row.  The aggregates are those of
    feature_cells; a pivot over the fixed list of types lays them out.
    """
    if len(types) > MAX_WIDE_TYPES:
        raise ValueError(f"more than {MAX_WIDE_TYPES} event types: use feature_cells")
    kinds = [*types, "other_types"]
    kind = F.when(F.col("event_type").isin(*types), F.col("event_type")).otherwise("other_types")
    # times as numbers: a pivot of timestamps would make one aggregate of every cell
    rows = pairs.select("entity_id", kind.alias("kind"), "outcome", F.unix_micros("ts").alias("ts"))
    cells = [F.count(F.lit(1)).alias("n"), F.max("ts").alias("last"), *[F.count_if(F.col("outcome") == o).alias(o) for o in outcomes]]
    wide = rows.groupBy("entity_id").pivot("kind", kinds).agg(*cells)
    value = lambda t, x: F.timestamp_micros(F.col(f"`{t}_{x}`")) if x == "last" else F.coalesce(F.col(f"`{t}_{x}`"), F.lit(0).cast("bigint"))
    wide = wide.select("entity_id", *[value(t, x).alias(_name(t, x)) for t in kinds for x in ("n", "last", *outcomes)])
    if as_of is None:
        return wide
    since = {_name(t, "days_since"): (F.unix_micros(as_of) - F.unix_micros(F.col(_name(t, "last")))) / F.lit(86_400_000_000.0) for t in types}
    return wide.withColumns(since)


def feature_rows(cells: DataFrame, outcomes: Sequence[str] = OUTCOMES) -> DataFrame:
    """The outcome counts of feature_cells that are not 0 as rows (entity_id, event_type, outcome, n)."""
    counts = F.array(*[F.struct(F.lit(o).alias("outcome"), F.col(o).alias("n")) for o in (*outcomes, "other_outcomes")])
    return cells.select("entity_id", "event_type", F.explode(F.filter(counts, lambda c: c["n"] > 0)).alias("c")).select("entity_id", "event_type", "c.outcome", "c.n")
