"""Queries of the per-entity feature table (problem 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.operators.features import OUTCOMES, entity_events, entity_features, feature_cells, feature_rows, latest_events
from mortarline.plans.session import table

WINDOW = ("2025-12-02T00:00:00Z", "2026-01-01T00:00:00Z")


#: The kinds and topics that make the event types of the table, kind/topic.
KINDS = ["assay_limitation", "cost_tradeoff", "decision_point", "degradation_event", "efficacy_result", "manufacturing_constraint", "method_evaluation", "regulatory_risk", "reproducibility_issue", "stability_issue", "toxicity_flag"]
TOPICS = ["bench_scale", "cold_store", "deep_core", "edge_zone", "field_trial", "freeze_thaw", "full_scale", "hot_cure", "joint_detail", "lab_batch", "long_term", "mid_span", "night_pour", "pilot_line", "repair_job", "salt_spray", "serum_phase", "short_term", "site_batch", "surface_coat"]
TYPES = [f"{kind}/{topic}" for kind in KINDS for topic in TOPICS]


def p7_features(spark: SparkSession, d: str) -> DataFrame:
    """Per entity and type the events, the days since the latest one (to the end of the window) and the outcomes."""
    pairs = entity_events(latest_events(table(spark, d, "research_events")), table(spark, d, "event_entities"))
    wide = entity_features(pairs, TYPES, as_of=F.lit(WINDOW[1]).cast("timestamp"))
    return wide.select([c for c in wide.columns if not c.endswith("__last")])


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Combinations with an event in the window, from the totals of its events."""
    start, end = (F.lit(x).cast("timestamp") for x in WINDOW)
    current = latest_events(table(spark, d, "research_events")).where((F.col("ts") >= start) & (F.col("ts") < end))
    cells = feature_cells(entity_events(current, table(spark, d, "event_entities")))
    return feature_rows(cells).select("entity_id", "event_type", "outcome")


_SNAKE = "replace(replace(lower(trim({0})), ' ', '_'), '-', '_')"
_STAMP = """CASE WHEN created_at ~ '^[0-9]{8}T' THEN strptime(replace(created_at, 'Z', '+00'), '%Y%m%dT%H%M%S%z')
    WHEN created_at ~ '[T ].*(Z|[+-][0-9]{2}:[0-9]{2})$' THEN created_at::TIMESTAMPTZ ELSE (created_at || 'Z')::TIMESTAMPTZ END"""

_LATEST = f"""latest AS (
  SELECT event_id, {_SNAKE.format("event_type")} AS event_type, {_SNAKE.format("outcome")} AS outcome, {_STAMP} AS ts,
    row_number() OVER (PARTITION BY event_id ORDER BY loaded_at DESC) AS r
  FROM research_events WHERE event_id IS NOT NULL)"""


def _wide_sql() -> str:
    columns = []
    for t in TYPES:
        name, here = t.replace("/", "__"), f"event_type = '{t}'"
        columns.append(f'count(*) FILTER (WHERE {here}) AS "{name}__n"')
        columns += [f"count(*) FILTER (WHERE {here} AND outcome = '{o}') AS \"{name}__{o}\"" for o in OUTCOMES]
        columns.append(f"(epoch_us(TIMESTAMPTZ '{WINDOW[1]}') - epoch_us(max(ts) FILTER (WHERE {here}))) / 86400000000.0::DOUBLE AS \"{name}__days_since\"")
    others = f"event_type NOT IN ({', '.join(repr(t) for t in TYPES)})"
    columns.append(f"count(*) FILTER (WHERE {others}) AS other_types__n")
    columns += [f"count(*) FILTER (WHERE {others} AND outcome = '{o}') AS other_types__{o}" for o in OUTCOMES]
    return f"""WITH {_LATEST}, pairs AS (SELECT DISTINCT l.entity_id, e.event_id, e.event_type, e.outcome, e.ts FROM latest e JOIN event_entities l USING (event_id) WHERE r = 1 AND l.entity_id IS NOT NULL)
SELECT entity_id, {", ".join(columns)} FROM pairs GROUP BY entity_id"""


ORACLES = {
    "p7_found": f"""WITH {_LATEST}
SELECT DISTINCT l.entity_id, e.event_type, e.outcome
FROM latest e JOIN event_entities l USING (event_id)
WHERE r = 1 AND l.entity_id IS NOT NULL AND ts >= TIMESTAMPTZ '{WINDOW[0]}' AND ts < TIMESTAMPTZ '{WINDOW[1]}'""",
    "p7_features": _wide_sql(),
}
QUERIES = {f.__name__: f for f in (p7_features, p7_found)}
