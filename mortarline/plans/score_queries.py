"""Queries of overlays, canonical entities and patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.functions import phrases as P
from mortarline.functions.classify import explode_sentences, sentences
from mortarline.functions.dialect import DUCKDB as D
from mortarline.operators import overlays as O
from mortarline.operators import patterns as R
from mortarline.operators.model import keep_last
from mortarline.plans.session import table

OVERLAYS = ("science_research_v1", "biohacking_curiosity_v1", "climate_resilience_v1")


def _events(spark: SparkSession, d: str) -> DataFrame:
    return keep_last(table(spark, d, "research_events"), ["event_id"], ["loaded_at", "created_at"])


def _links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "event_entities").select("event_id", "entity_id").dropna().distinct()


def event_overlay_scores(spark: SparkSession, d: str) -> DataFrame:
    """Scores of the sentences of the documents and of the recorded events' snippets."""
    sentences = explode_sentences(table(spark, d, "documents").select("doc_id", "text"), "text").select(F.lit("document").alias("event_id"), F.col("sentence").alias("evidence_snippet"))
    rows = sentences.unionByName(_events(spark, d).select(F.lit("event").alias("event_id"), "evidence_snippet"))
    scores = O.overlay_event_scores(rows, OVERLAYS)
    return scores.groupBy(F.col("event_id").alias("origin"), *OVERLAYS).agg(F.count("*").alias("n"))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    entities = table(spark, d, "entities")
    canonical, mapping = O.canonical_entities(entities, O.alias_rows(table(spark, d, "construction_science_aliases")))
    events, links = _events(spark, d), _links(spark, d)
    models = links.join(entities.where("entity_type in ('model', 'cell_model')").select("entity_id", F.col("entity_name").alias("model")), "entity_id").select("event_id", "model")
    return O.entity_overlay_scores(canonical, mapping, links, O.overlay_event_scores(events, OVERLAYS[:2]), OVERLAYS[:2], models)


def entity_overlay_scores(spark: SparkSession, d: str) -> DataFrame:
    s = _scored(spark, d)
    return s.select("canonical_id", "entity_type", "n_entities", "n_events", F.round("model_factor", 6).alias("model_factor"), *[F.round(f"{o}_score", 6).alias(f"{o}_score") for o in OVERLAYS[:2]], *[f"{o}_bucket" for o in OVERLAYS[:2]])


def overlay_top20(spark: SparkSession, d: str) -> DataFrame:
    top = O.overlay_top(_scored(spark, d), OVERLAYS[0])
    return top.select(F.col("rank").cast("bigint").alias("rank"), "canonical_id", F.round(f"{OVERLAYS[0]}_score", 6).alias("score"))


def bucket_distribution(spark: SparkSession, d: str) -> DataFrame:
    return O.bucket_distribution(_scored(spark, d), OVERLAYS[0])


def canonical_merge(spark: SparkSession, d: str) -> DataFrame:
    merged, _ = O.canonical_entities(table(spark, d, "entities"), O.alias_rows(table(spark, d, "construction_science_aliases")))
    return merged.select("canonical_id", "entity_type", "n_entities", F.array_join("original_names", "|").alias("names"))


def pattern_intelligence(spark: SparkSession, d: str) -> DataFrame:
    return R.analyze_patterns(table(spark, d, "entities"), _links(spark, d), _events(spark, d))


def pattern_export(spark: SparkSession, d: str) -> DataFrame:
    rows = R.analyze_patterns(table(spark, d, "entities"), _links(spark, d), _events(spark, d))
    return R.pattern_csv(rows, "2026-01-01 00:00:00")


def pattern_health_ranges(spark: SparkSession, d: str) -> DataFrame:
    return R.health_ranges(R.analyze_patterns(table(spark, d, "entities"), _links(spark, d), _events(spark, d), top=None))


def pattern_emphasis(spark: SparkSession, d: str) -> DataFrame:
    rows = R.analyze_patterns(table(spark, d, "entities"), _links(spark, d), _events(spark, d), top=None)
    return rows.select("entity_id", F.round(O.emphasized(F.col("health_score"), F.col("pattern_type")), 6).alias("emphasized"))


_EVENTS = "events AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY loaded_at DESC, created_at DESC) AS rn FROM research_events) AS e WHERE rn = 1)"
_LINKS = "links AS (SELECT DISTINCT event_id, entity_id FROM event_entities WHERE event_id IS NOT NULL AND entity_id IS NOT NULL)"
_AA = f"'^[{P.AMINO_ACIDS}]{{8,100}}$'"
_CANON = f"""
aliased AS (SELECT entity_type AS kind, lower(unnest(aliases)) AS alias, canonical, canonical_id FROM construction_science_aliases),
alias_first AS (SELECT kind, alias, arg_min(canonical, canonical_id) AS canonical FROM aliased GROUP BY 1, 2),
typed AS (SELECT entity_id, entity_name, {O.canonical_type(D, "entity_name", "entity_type")} AS entity_type FROM entities WHERE trim(entity_name) <> '' AND trim(entity_type) <> ''),
named AS (SELECT t.*, coalesce(a.canonical, trim(t.entity_name)) AS canonical_name FROM typed t LEFT JOIN alias_first a ON a.kind = t.entity_type AND a.alias = lower(trim(t.entity_name))),
kept AS (SELECT *, entity_type || ':' || lower(canonical_name) AS canonical_id FROM named
  WHERE NOT (entity_type = 'assay' AND lower(canonical_name) IN ({", ".join(D.text(w) for w in P.PROCESS_WORDS)})) AND (entity_type <> 'peptide' OR regexp_matches(upper(trim(canonical_name)), {_AA}))),
merged AS (SELECT canonical_id, entity_type, arg_min(canonical_name, entity_id) AS entity_name, count(*) AS n_entities, string_agg(DISTINCT entity_name, '|' ORDER BY entity_name) AS names FROM kept GROUP BY 1, 2)
"""
_SCORED = f"""WITH {_EVENTS}, {_LINKS}, {_CANON},
scores AS (SELECT event_id, {O.event_score(D, OVERLAYS[0], "s")} AS a, {O.event_score(D, OVERLAYS[1], "s")} AS b FROM (SELECT event_id, lower(coalesce(evidence_snippet, '')) AS s FROM events) AS q),
pairs AS (SELECT DISTINCT canonical_id, event_id FROM links JOIN kept USING (entity_id)),
sums AS (SELECT canonical_id, count(*) AS n_events, avg(coalesce(a, 0)) AS avg_a, avg(coalesce(b, 0)) AS avg_b FROM pairs LEFT JOIN scores USING (event_id) GROUP BY 1),
own AS (SELECT DISTINCT p.canonical_id, lower(trim(e.entity_name)) AS model FROM pairs p JOIN links l USING (event_id) JOIN entities e ON e.entity_id = l.entity_id AND e.entity_type IN ('model', 'cell_model')),
factors AS (SELECT canonical_id, least(avg({O.model_weight(D, "model")}), 2.0) AS f FROM own GROUP BY 1),
raw AS (SELECT m.*, n_events, coalesce(f, 1.0) AS model_factor, avg_a, avg_b FROM merged m JOIN sums USING (canonical_id) LEFT JOIN factors USING (canonical_id)),
scored AS (SELECT *, n_events * {O.priority(D, OVERLAYS[0], "entity_type")} * model_factor + least(avg_a, n_events * 0.5) AS score_a,
  (n_events * {O.priority(D, OVERLAYS[1], "entity_type")} * model_factor + least(avg_b, n_events * 0.5)) * CASE WHEN lower(entity_name) IN ({", ".join(D.text(w) for w in P.INFRASTRUCTURE)}) THEN 0.5 ELSE 1 END AS score_b FROM raw),
bucketed AS (SELECT *, {O.bucket(D, "score_a", O.most_score(D, "n_events"))} AS bucket_a, {O.bucket(D, "score_b", O.most_score(D, "n_events"))} AS bucket_b FROM scored)
"""
_SIGNALS = {g: "(" + " + ".join(f"max(CASE WHEN contains(s, {D.text(p)}) THEN 1 ELSE 0 END)" for p in ps) + ")" for g, ps in P.SIGNALS.items()}


_WORDS = """entity_name || ' shows ' || CASE WHEN health_score >= 80 THEN 'strong research momentum' WHEN health_score >= 60 THEN 'promising and active research' WHEN health_score >= 40 THEN 'exploratory research' WHEN health_score >= 20 THEN 'stalled or uncertain research' ELSE 'declining research attention' END
|| ' ' || MAP {'convergence': 'with convergence around consistent methods', 'escalation': 'with increasing validation efforts', 'stagnation': 'encountering persistent technical barriers', 'abandonment': 'with declining research interest', 'fragmentation': 'remaining methodologically diverse'}[pattern_type]
|| ' and ' || if(positive > negative, 'predominantly positive', if(negative > positive, 'predominantly negative', 'mixed')) || ' outcome language.'"""


def _patterns_sql(top: int | None) -> str:
    return f"""WITH {_EVENTS}, {_LINKS},
chosen AS (SELECT entity_id, entity_name, entity_type, n FROM (SELECT entity_id, count(*) AS n FROM links GROUP BY 1) AS c JOIN entities USING (entity_id) {f"ORDER BY n DESC, entity_id LIMIT {top}" if top else ""}),
said AS (SELECT c.entity_id, lower(coalesce(e.evidence_snippet, '')) AS s, e.confidence FROM chosen c JOIN links USING (entity_id) JOIN events e USING (event_id)),
counted AS (SELECT entity_id, count(*) AS n_rows, count(*) FILTER (WHERE confidence = 'high') AS high, count(*) FILTER (WHERE confidence = 'med') AS med, bool_or({D.has("s", P.ESCALATION_TERMS)}) AS escalates, {", ".join(f"{v} AS {g}" for g, v in _SIGNALS.items())} FROM said GROUP BY 1),
one AS (SELECT c.*, k.* EXCLUDE (entity_id), (SELECT avg(n) FROM chosen) AS mean FROM chosen c JOIN counted k USING (entity_id)),
two AS (SELECT *, CASE WHEN n < 10 AND n > 3 THEN if(escalates, 'escalation', 'fragmentation') WHEN n <= 3 THEN 'abandonment' WHEN regexp_matches(entity_name, '(?i)aggregation|degradation|instability|toxicity|poor') THEN 'stagnation' ELSE 'convergence' END AS pattern_type,
  if(n > 1.5 * mean, 'increasing', if(n < 0.5 * mean, 'decreasing', 'stable')) AS momentum, if(high > n_rows / 2, 'high', if(med + high > n_rows / 2, 'med', 'low')) AS confidence_level FROM one),
patterns AS (SELECT *, least(100, greatest(0, trunc((
  MAP {{'convergence': 40, 'escalation': 45, 'fragmentation': 20, 'stagnation': 10, 'abandonment': 0}}[pattern_type] + 5 * positive - 5 * negative + 3 * replication + least(neutral, 5) + MAP {{'increasing': 10, 'stable': 5, 'decreasing': -10}}[momentum])
  * MAP {{'high': 11, 'med': 10, 'low': 9}}[confidence_level] / 10.0)::INTEGER)) AS health_score FROM two)
"""


QUERIES = {f.__name__: f for f in (event_overlay_scores, entity_overlay_scores, overlay_top20, bucket_distribution, canonical_merge, pattern_intelligence, pattern_export, pattern_health_ranges, pattern_emphasis)}
ORACLES = {
    "event_overlay_scores": f"""WITH {_EVENTS}, texts AS (
  SELECT row_number() OVER () AS i, * FROM (SELECT 'document' AS origin, lower(unnest({sentences(D, "text")})) AS s FROM documents UNION ALL SELECT 'event', lower(coalesce(evidence_snippet, '')) FROM events) AS u),
weights(overlay, term, points) AS (VALUES {", ".join(f"({D.text(o)}, {D.text(t.lower())}, {float(x)})" for o in OVERLAYS for x_of in ("boost", "demote") for t, x in P.OVERLAYS[o][x_of].items())}),
found AS (SELECT i, overlay, sum(points)::DOUBLE AS points FROM texts JOIN weights ON contains(s, term) GROUP BY 1, 2),
sides AS (SELECT i, regexp_matches(s, '{"|".join(P.CO_CLIMATE)}') AND regexp_matches(s, '{"|".join(P.CO_MATERIAL)}') AS co, s LIKE '%efficacy%' OR s LIKE '%effective%' AS claim, regexp_matches(s, '{"|".join(P.ASSAY_KEYWORDS)}') AS assay FROM texts),
scored AS (SELECT t.origin,
  coalesce(a.points, 0) - CASE WHEN claim AND NOT assay THEN 1 ELSE 0 END AS {OVERLAYS[0]}, coalesce(b.points, 0)::DOUBLE AS {OVERLAYS[1]}, coalesce(c.points, 0) + CASE WHEN co THEN 1.5 ELSE 0 END AS {OVERLAYS[2]}
  FROM texts t JOIN sides USING (i) LEFT JOIN found a ON a.i = t.i AND a.overlay = '{OVERLAYS[0]}' LEFT JOIN found b ON b.i = t.i AND b.overlay = '{OVERLAYS[1]}' LEFT JOIN found c ON c.i = t.i AND c.overlay = '{OVERLAYS[2]}')
SELECT origin, {", ".join(f"{o}::DOUBLE AS {o}" for o in OVERLAYS)}, count(*) AS n FROM scored GROUP BY ALL""",
    "entity_overlay_scores": f"{_SCORED} SELECT canonical_id, entity_type, n_entities, n_events, round(model_factor, 6) AS model_factor, round(score_a, 6) AS {OVERLAYS[0]}_score, round(score_b, 6) AS {OVERLAYS[1]}_score, bucket_a AS {OVERLAYS[0]}_bucket, bucket_b AS {OVERLAYS[1]}_bucket FROM bucketed",
    "overlay_top20": f"{_SCORED} SELECT row_number() OVER (ORDER BY score_a DESC, canonical_id) AS rank, canonical_id, round(score_a, 6) AS score FROM bucketed ORDER BY score_a DESC, canonical_id LIMIT 20",
    "bucket_distribution": f"""{_SCORED}, labels AS (SELECT * FROM (VALUES {", ".join(f"({i + 1}, {D.text(b)})" for i, b in enumerate([*[b for b, _ in P.BUCKETS], P.LAST_BUCKET]))}) AS v(position, bucket))
SELECT position, bucket, (SELECT count(*) FROM bucketed WHERE bucket_a = bucket) AS n, round((SELECT count(*) FROM bucketed WHERE bucket_a = bucket) * 100.0::DOUBLE / (SELECT count(*) FROM bucketed), 4) AS percent FROM labels""",
    "canonical_merge": f"WITH {_CANON} SELECT canonical_id, entity_type, n_entities, names FROM merged",
    "pattern_intelligence": f"{_patterns_sql(50)} SELECT entity_id, entity_name, entity_type, pattern_type, health_score, n AS event_count, positive, neutral, negative, replication, momentum, confidence_level, {_WORDS} AS interpretation FROM patterns",
    "pattern_export": f"{_patterns_sql(50)} SELECT entity_name, entity_type, pattern_type, health_score, n AS event_count, positive AS positive_signals, neutral AS neutral_signals, negative AS negative_signals, replication AS replication_signals, positive + neutral + negative + replication AS total_signals, momentum AS time_momentum, confidence_level, {_WORDS} AS interpretation, '2026-01-01 00:00:00' AS export_timestamp FROM patterns",
    "pattern_health_ranges": f"{_patterns_sql(None)} SELECT cast(floor(least(health_score, 99) / 20) * 20 as int) AS range_start, pattern_type, count(*) AS n FROM patterns GROUP BY ALL",
    "pattern_emphasis": f"{_patterns_sql(None)} SELECT entity_id, round(health_score * MAP {{'convergence': 1.10, 'escalation': 1.15, 'fragmentation': 1.05, 'stagnation': 0.95, 'abandonment': 0.90}}[pattern_type]::DOUBLE, 6) AS emphasized FROM patterns",
}
