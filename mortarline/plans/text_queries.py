"""Queries of the sentence functions, classifiers and lenses."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.functions import classify as C
from mortarline.functions import lenses as X
from mortarline.functions import phrases as P
from mortarline.functions.dialect import DUCKDB, SPARK
from mortarline.functions.normalize import exploded
from mortarline.plans.corpus import corpus, corpus_sql, lower_corpus_sql
from mortarline.plans.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _labels_sql(rows: str) -> str:
    """A query that adds all labels to a subquery with a lower-cased sentence and has_entity.

    The rules stand here a second time, as joins of the distinct sentences with a
    table of phrases, so that the expressions are held against something else.
    """
    text = DUCKDB.text
    groups = {"tag": P.METHOD_TAGS, "failure": P.FAILURE_PHRASES, "decision": P.DECISION_PHRASES, "outcome": P.OUTCOME_PHRASES, "stage": P.STAGES, "evidence": {"strong": P.STRONG_EVIDENCE, "weak": P.WEAK_EVIDENCE}}
    words = {"toxic": P.TOXICITY_WORDS, "degrading": P.DEGRADATION_WORDS, "active": P.ACTIVITY_WORDS, "producing": P.PRODUCTION_WORDS, "cost": P.COST_WORDS, "signal": P.HIGH_SIGNAL_TERMS}
    phrases = [(kind, o, label, p) for kind, table_ in groups.items() for o, (label, ps) in enumerate(table_.items()) for p in ps] + [(kind, 0, p, p) for kind, ps in words.items() for p in ps]
    values = ", ".join(f"({text(kind)}, {o}, {text(label)}, {text(r'\b' + re.escape(p).replace(chr(92) + ' ', ' ').replace(chr(92) + '-', '-') + r'\b')})" for kind, o, label, p in phrases)
    measured = " OR ".join(f"regexp_matches(sentence, {text(q + r'.*?[0-9]+[.]?[0-9]*[ ]*(' + u + ')')})" for _, q, u in P.MEASUREMENTS)
    first = lambda kind, default: f"coalesce(arg_min(label, o) FILTER (WHERE kind = '{kind}'), '{default}')"
    has = lambda kind: f"coalesce(bool_or(kind = '{kind}'), false) AS {kind}"
    return f"""WITH rows_ AS (SELECT * FROM ({rows}) AS q), phrases(kind, o, label, p) AS (VALUES {values}), texts AS (SELECT DISTINCT sentence FROM rows_ WHERE sentence IS NOT NULL),
hits AS (SELECT sentence, kind, o, label FROM texts LEFT JOIN phrases ON regexp_matches(sentence, p)),
one AS (SELECT sentence, list_distinct(list(label) FILTER (WHERE kind = 'tag')) AS found, {first("failure", "unknown")} AS failure_reason, {first("decision", "unknown")} AS decision, {first("outcome", "unknown")} AS outcome, {first("stage", "unknown")} AS stage, {first("evidence", "moderate")} AS evidence_strength,
  {", ".join(has(k) for k in words if k != "signal")}, count(DISTINCT label) FILTER (WHERE kind = 'signal') AS signals, {measured} AS has_measurement FROM hits GROUP BY sentence),
two AS (SELECT *, coalesce(found, []) AS tags, CASE WHEN list_contains(coalesce(found, []), 'nitrosamine') OR failure_reason = 'regulatory' THEN 'regulatory_risk' WHEN failure_reason = 'toxicity_flag' OR toxic THEN 'toxicity_flag' WHEN failure_reason = 'stability_failure' THEN 'stability_issue' WHEN degrading THEN 'degradation_event'
  WHEN failure_reason = 'no_activity' OR active THEN 'efficacy_result' WHEN failure_reason = 'scalability' OR producing THEN 'manufacturing_constraint' WHEN len(found) > 0 AND cost THEN 'cost_tradeoff' WHEN len(found) > 0 THEN 'method_evaluation' WHEN decision <> 'unknown' THEN 'decision_point' ELSE 'other' END AS event_type,
  CASE WHEN list_contains(coalesce(found, []), 'serum') THEN 'serum/plasma' WHEN sentence LIKE '%organoid%' THEN 'organoid' WHEN sentence LIKE '%cell line%' OR sentence LIKE '%cell culture%' THEN 'cells' END AS system_context,
  CASE WHEN len(found) > 0 THEN 1 ELSE 0 END + CASE WHEN failure_reason <> 'unknown' THEN 2 ELSE 0 END + CASE WHEN decision <> 'unknown' THEN 1 ELSE 0 END + CASE WHEN has_measurement THEN 2 ELSE 0 END + CASE WHEN signals >= 3 THEN 2 WHEN signals = 2 THEN 1 ELSE 0 END AS points FROM one),
three AS (SELECT rows_.* EXCLUDE (sentence), two.*, CASE WHEN points + CASE WHEN has_entity THEN 2 ELSE 0 END >= 6 THEN 'high' WHEN points + CASE WHEN has_entity THEN 2 ELSE 0 END >= 3 THEN 'med' ELSE 'low' END AS confidence FROM rows_ JOIN two USING (sentence))
SELECT *, CASE WHEN confidence <> 'low' OR event_type <> 'other' AND (failure_reason <> 'unknown' OR decision <> 'unknown' OR len(tags) > 0) THEN 1 ELSE 0 END AS keep FROM three"""


_LABELS = _labels_sql(lower_corpus_sql(DUCKDB))


def _grouped(name: str, keys: list[str], where: str | None = None) -> None:
    """A count of classified sentences by some of their labels."""

    def query(spark: SparkSession, d: str) -> DataFrame:
        rows = C.classify(corpus(spark, d))
        # a filter on a label would be pushed below all labels, with every one it is made of written out
        kept = F.expr(where) if where else F.lit(True)
        counts = rows.groupBy(*keys).agg(F.count_if(kept).alias("n"), F.count_distinct(F.when(kept, F.col("doc_id"))).alias("n_docs"))
        return counts.where("n > 0")

    QUERIES[name] = query
    ORACLES[name] = f"SELECT {', '.join(keys)}, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM ({_LABELS}) AS l {'WHERE ' + where if where else ''} GROUP BY {', '.join(keys)}"


_grouped("failure_reason_distribution", ["failure_reason"])
_grouped("event_type_distribution", ["event_type"])
_grouped("outcome_by_stage", ["stage", "outcome"])
_grouped("decision_distribution", ["decision"])
_grouped("confidence_distribution", ["confidence"])
_grouped("evidence_strength_distribution", ["evidence_strength"])
_grouped("suggested_keep", ["keep", "confidence", "event_type"])
_grouped("system_context_distribution", ["system_context"])
_grouped("confident_events_by_domain", ["research_domain", "event_type"], "confidence <> 'low'")


def method_tag_counts(spark: SparkSession, d: str) -> DataFrame:
    return exploded(C.classify(corpus(spark, d)), F.col("tags"), "tag").groupBy("tag").agg(F.count("*").alias("n"))


def gate_comparison(spark: SparkSession, d: str) -> DataFrame:
    """Sentences that pass the engine's gate, the batch path's gate, both or neither."""
    rows = C.classify(corpus(spark, d)).withColumn("s", F.lower("sentence"))
    gates = rows.select(F.expr(C.signal_gate(SPARK, "s", "tags", "decision", "has_measurement")).alias("engine_gate"), F.expr(C.phrase_gate(SPARK, "s")).alias("phrase_gate"))
    return gates.groupBy("engine_gate", "phrase_gate").agg(F.count("*").alias("n"))


def measurements_by_type_unit(spark: SparkSession, d: str) -> DataFrame:
    rows = exploded(corpus(spark, d).select(F.lower("sentence").alias("s")), F.expr(C.measurements(SPARK, "s")), "m").select(F.split("m", r"\|").alias("p"))
    rows = rows.select(F.col("p")[0].alias("measurement_type"), F.col("p")[2].alias("unit"), F.col("p")[1].cast("double").alias("value"))
    return rows.groupBy("measurement_type", "unit").agg(F.count("*").alias("n"), F.min("value").alias("lowest"), F.max("value").alias("highest"))


def construction_events(spark: SparkSession, d: str) -> DataFrame:
    rows = corpus(spark, d).select("doc_id", F.lower("sentence").alias("s"))
    kind = F.expr(f"CASE WHEN NOT {C.boilerplate(SPARK, 's')} AND NOT {C.climate_row(SPARK, 's')} THEN {C.construction_event(SPARK, 's')} END")
    return exploded(rows, F.array(kind), "event_type", "doc_id").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_docs"))


def boilerplate_filtered(spark: SparkSession, d: str) -> DataFrame:
    rows = corpus(spark, d).select(F.lower("sentence").alias("s"))
    return rows.groupBy(F.expr(C.boilerplate(SPARK, "s")).alias("boilerplate"), F.expr(C.climate_row(SPARK, "s")).alias("climate_row")).agg(F.count("*").alias("n"))


def document_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of whole documents by the simple rule, per collection."""
    rows = C.explode_sentences(table(spark, d, "documents").select("doc_id", "source", "text"), "text")
    return rows.groupBy("source").agg(F.count("*").alias("n_sentences"), F.count_distinct("doc_id").alias("n_docs"), F.max("position").cast("bigint").alias("last_position"))


def abstract_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of whole documents by the rule for abstracts, per language."""
    rows = table(spark, d, "documents").select("lang", F.expr(C.simple_sentences(SPARK, "text")).alias("a"))
    return rows.groupBy("lang").agg(F.sum(F.size("a")).alias("n_sentences"), F.max(F.size("a")).cast("bigint").alias("most"))


def kept_feed_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Sentences that a feed would keep, against those that the engine's gate lets pass."""
    rows = C.classify(corpus(spark, d))
    kept = F.expr(C.feed_keep(SPARK, "CASE WHEN has_entity THEN 1 ELSE 0 END", "tags", "has_measurement"))
    return rows.groupBy(kept.alias("kept"), "keep").agg(F.count("*").alias("n"))


def unmatched_by_lenses(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of the pages by the lens that comes first, those without any among them."""
    rows = C.explode_sentences(table(spark, d, "chunks").select("chunk_id", "chunk_text"), "chunk_text")
    first = X.lens_stack(rows, no_match="keep").where("rank is null or rank = 1")
    return first.groupBy("lens").agg(F.count("*").alias("n"))


def page_sections(spark: SparkSession, d: str) -> DataFrame:
    """Section guessed from the page's text against the one recorded."""
    rows = table(spark, d, "chunks").select(F.lower("chunk_text").alias("s"), F.coalesce("section_guess", F.lit("none")).alias("recorded"))
    return rows.groupBy(F.expr(C.section(SPARK, "s")).alias("guessed"), "recorded").agg(F.count("*").alias("n"))


def snippet_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels of the recorded events' snippets."""
    rows = table(spark, d, "research_events").select("event_id", F.col("evidence_snippet").alias("sentence"), F.lit(True).alias("has_entity"))
    return C.classify(rows).groupBy("outcome", "evidence_strength", "stage").agg(F.count("*").alias("n"))


def confidence_boost(spark: SparkSession, d: str) -> DataFrame:
    """Confidence of each event before and after its entities are looked at."""
    ents = table(spark, d, "entities").select("entity_id", F.concat("entity_type", F.lit(":"), "entity_name").alias("e"))
    links = table(spark, d, "event_entities").select("event_id", "entity_id").dropna().distinct().join(ents, "entity_id")
    listed = links.groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_set("e")), "; ").alias("entities"))
    events = table(spark, d, "research_events").groupBy("event_id").agg(F.max_by(F.struct("confidence", "evidence_snippet", "research_domain"), "loaded_at").alias("x")).select("event_id", "x.*")
    rows = events.join(listed, "event_id").withColumn("s", F.lower("evidence_snippet"))
    return rows.groupBy("confidence", F.expr(C.boosted_confidence(SPARK, "entities", "confidence", "s", "research_domain")).alias("boosted")).agg(F.count("*").alias("n"))


for _q in (method_tag_counts, gate_comparison, measurements_by_type_unit, construction_events, boilerplate_filtered, document_sentences, abstract_sentences, kept_feed_sentences, unmatched_by_lenses, page_sections, snippet_labels, confidence_boost):
    QUERIES[_q.__name__] = _q

_LOW = lower_corpus_sql(DUCKDB)


def _construction_sql(rows: str) -> str:
    """CTEs up to ``judged``: event type, boilerplate and climate_row of a subquery's distinct sentences, the rules stated a second time."""
    text = DUCKDB.text
    any_of = lambda ps: f"regexp_matches(s, {text('|'.join(re.escape(p).replace(chr(92) + '-', '-').replace(chr(92) + ' ', ' ') for p in ps))})"
    pairs = [(-1, "climate_load", P.CLIMATE_TERMS, P.BUILDING_CONTEXT), *((o, *rule) for o, rule in enumerate(P.CONSTRUCTION_EVENTS))]
    values = ", ".join(f"({o}, '{name}', '{side}', {text(p)})" for o, name, first, near in pairs for side, ps in (("first", first), ("near", near)) for p in ps)
    listed = lambda ps: f"[{', '.join(map(text, ps))}]"
    return f"""WITH rows AS (SELECT * FROM ({rows}) AS q), texts AS (SELECT DISTINCT sentence, sentence AS s FROM rows), rules(o, name, side, p) AS (VALUES {values}),
found AS (SELECT sentence, o, name FROM texts JOIN rules ON contains(s, p) GROUP BY 1, 2, 3 HAVING count(DISTINCT side) = 2), events AS (SELECT sentence, arg_min(name, o) AS event_type FROM found GROUP BY 1),
cut AS (SELECT *, string_split_regex(s, '\\s+') AS parts, list_filter(list_transform(string_split_regex(s, '\\s+'), lambda x: trim(x, '.,;:()[]{{}}')), lambda x: x <> '') AS tokens FROM texts),
told AS (SELECT *, len(list_filter(tokens, lambda x: regexp_matches(x, '^-?[0-9]*([.][0-9]+|[0-9][.]?[0-9]*)$'))) AS numbers, len(list_filter({listed(P.MONTHS)}, lambda x: contains(s, x))) AS months, {any_of(P.BUILDING_CONTEXT)} AS building, s LIKE '%climate normals%' AS normals,
  len(list_filter({listed(P.BOILERPLATE_WORDS)}, lambda x: list_contains(parts, x))) AS stock FROM cut),
judged AS (SELECT t.sentence, event_type,
  (normals OR s LIKE '%normales climatiques%') AND NOT building OR {any_of(P.FRONT_MATTER)} OR stock >= 3 AND NOT {any_of(P.ACTION_TERMS)} OR s LIKE '%climate%' AND s LIKE '%pressure%' AND s LIKE '%temperature%' AND s LIKE '%humidity%' AS boilerplate,
  normals AND NOT building AND (numbers >= 3 AND len(tokens) <= 18 OR months >= 2 AND numbers >= 1 OR {any_of(P.CLIMATE_PLACES)} AND numbers >= 1 AND len(tokens) <= 12 OR (s LIKE '%table%' OR s LIKE '%normal%') AND numbers >= 2) AS climate_row
  FROM told t LEFT JOIN events USING (sentence))"""


ORACLES |= {
    "method_tag_counts": f"SELECT tag, count(*) AS n FROM (SELECT unnest(tags) AS tag FROM ({_LABELS}) AS l) AS t GROUP BY tag",
    "gate_comparison": f"SELECT {C.signal_gate(DUCKDB, 'sentence', 'tags', 'decision', 'has_measurement')} AS engine_gate, {C.phrase_gate(DUCKDB, 'sentence')} AS phrase_gate, count(*) AS n FROM ({_LABELS}) AS l GROUP BY ALL",
    "measurements_by_type_unit": f"""SELECT p[1] AS measurement_type, p[3] AS unit, count(*) AS n, min(p[2]::DOUBLE) AS lowest, max(p[2]::DOUBLE) AS highest
FROM (SELECT string_split(m, '|') AS p FROM (SELECT unnest({C.measurements(DUCKDB, "sentence")}) AS m FROM ({_LOW}) AS s) AS u) AS q GROUP BY 1, 2""",
    "construction_events": f"{_construction_sql(_LOW)} SELECT event_type, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM rows JOIN judged USING (sentence) WHERE NOT boilerplate AND NOT climate_row AND event_type IS NOT NULL GROUP BY 1",
    "boilerplate_filtered": f"{_construction_sql(_LOW)} SELECT boilerplate, climate_row, count(*) AS n FROM rows JOIN judged USING (sentence) GROUP BY ALL",
    "document_sentences": f"""SELECT source, sum(len(a))::BIGINT AS n_sentences, count(*) FILTER (WHERE len(a) > 0) AS n_docs, max(len(a)) - 1 AS last_position
FROM (SELECT source, {C.sentences(DUCKDB, "text")} AS a FROM documents) AS s GROUP BY source""",
    "abstract_sentences": r"SELECT lang, sum(len(a))::BIGINT AS n_sentences, max(len(a)) AS most FROM (SELECT lang, regexp_extract_all(text, '[^.!?]*[^.!?\s][^.!?]*') AS a FROM documents) AS q GROUP BY lang",
    "kept_feed_sentences": f"SELECT (has_entity OR len(tags) > 0 OR has_measurement) AS kept, keep, count(*) AS n FROM ({_LABELS}) AS l GROUP BY ALL",
    "page_sections": f"SELECT {C.section(DUCKDB, 's')} AS guessed, recorded, count(*) AS n FROM (SELECT lower(chunk_text) AS s, coalesce(section_guess, 'none') AS recorded FROM chunks) AS c GROUP BY ALL",
    "snippet_labels": f"SELECT outcome, evidence_strength, stage, count(*) AS n FROM ({_labels_sql("SELECT lower(coalesce(evidence_snippet, '')) AS sentence, true AS has_entity FROM research_events")}) AS l GROUP BY ALL",
    "confidence_boost": f"""WITH links AS (SELECT DISTINCT event_id, entity_type || ':' || entity_name AS e FROM event_entities JOIN entities USING (entity_id) WHERE event_id IS NOT NULL),
listed AS (SELECT event_id, string_agg(e, '; ' ORDER BY e) AS entities FROM links GROUP BY 1),
events AS (SELECT event_id, arg_max(confidence, loaded_at) AS confidence, lower(arg_max(evidence_snippet, loaded_at)) AS s, arg_max(research_domain, loaded_at) AS research_domain FROM research_events GROUP BY 1)
SELECT confidence, {C.boosted_confidence(DUCKDB, "entities", "confidence", "s", "research_domain")} AS boosted, count(*) AS n FROM events JOIN listed USING (event_id) GROUP BY ALL""",
}


def _lenses_sql(rows: str) -> str:
    """CTEs up to ``events``: every lens event of a subquery's sentences, the rules stated a second time.

    Each distinct sentence meets a table of phrases once: any_x and has_x say
    whether a phrase of group x stands there as words or as a part, list_x which.
    """
    text = DUCKDB.text
    groups = X.L
    values = ", ".join(f"({text(key)}, {o}, {text(p)}, {text(r'\b' + re.escape(p).replace(chr(92) + ' ', ' ').replace(chr(92) + '-', '-') + r'\b')})" for key, ps in groups.items() for o, p in enumerate(ps))
    flags = ", ".join(f"coalesce(bool_or(k = '{key}' AND word), false) AS any_{key}, coalesce(bool_or(k = '{key}'), false) AS has_{key}, coalesce(list(p ORDER BY o) FILTER (WHERE k = '{key}' AND word), []) AS list_{key}" for key in groups)
    units = "|".join(p.replace(r"(?<=\d)%(?=\s|$)", r"\d%(?:\s|$)") for p in P.UNIT_PATTERNS)
    any_word = lambda ps: r"\b(" + "|".join(re.escape(p).replace(chr(92) + "-", "-").replace(chr(92) + " ", " ") for p in ps) + r")\b"
    generic = f"[{', '.join(text(g) for g in P.GENERIC_NAMES)}]"
    named = lambda *parts: "array_to_string(list_distinct_ordered, '; ')".replace("list_distinct_ordered", " || ".join(f"list_transform(list_filter({array}, lambda x: NOT list_contains({generic}, x)), lambda x: '{kind}:' || x)" for kind, array in parts))
    tagged = lambda event, *tags: f"array_to_string(list_filter(['{event}', {', '.join(f'CASE WHEN {c} THEN {text(t)} END' for c, t in tags)}], lambda x: x IS NOT NULL), ',')"
    one = lambda c: f"CASE WHEN {c} THEN 1 ELSE 0 END"
    level = lambda score, high, med: f"CASE WHEN {score} >= {high} THEN 'high' WHEN {score} >= {med} THEN 'med' ELSE 'low' END"
    energy = r"\benergy\s+(consumption|use|demand)\b"
    gap = r"(\W*\b\w+\b){0,7}\W*"
    saving = f"regexp_matches(sentence, {text(r'\breduc\w*\b' + gap + energy)}) OR regexp_matches(sentence, {text(energy + gap + r'\breduc\w*\b')})"
    built = "any_climate_materials OR any_climate_systems"
    standard = f"(has_standards OR regexp_matches(sentence, {text(P.STANDARD_PATTERN)}))"
    said = "(has_passes OR has_fails OR contains(sentence, 'requirement') OR contains(sentence, 'standard'))"
    lenses = [
        ("building_physics", "building_physics_performance", "any_physics", f"CASE WHEN has_physics_bad THEN 'degraded' WHEN has_physics_good OR {saving} THEN 'positive' ELSE 'neutral' END",
         level(f"2 + {one('any_assemblies')} + {one('number')} + 2 * {one('unit')} + {one('has_measured')}", 6, 3), tagged("building_physics_performance", ("any_assemblies", "has_component"), ("unit", "has_units")), named(("building_component", "list_assemblies[1:5]"), ("physics_metric", "list_physics[1:6]"))),
        ("climate", "climate_resilience", "any_hazards OR any_resilience", "CASE WHEN has_climate_bad AND has_climate_good THEN 'mixed_hazard' WHEN has_climate_bad THEN 'degraded' WHEN has_climate_good THEN 'improved' WHEN any_hazards THEN 'negative' ELSE 'neutral' END",
         level(f"2 * {one('any_hazards')} + {one('any_resilience')} + {one('number')} + {one('unit')} + 2 * {one('has_scenarios')} + 2 * {one(built)}", 6, 3), tagged("climate_resilience", ("any_hazards", "has_hazard"), ("contains(sentence, 'rcp') OR contains(sentence, 'ssp')", "climate_scenario"), (built, "construction_climate_interaction")),
         named(("hazard", "list_hazards[1:6]"), ("resilience_term", "list_resilience[1:4]"), ("material", "list_climate_materials[1:3]"), ("system", "list_climate_systems[1:3]"))),
        ("compliance", "code_compliance", f"{standard} OR {said}", "CASE WHEN has_passes AND has_fails THEN 'mixed' WHEN has_passes THEN 'successful' WHEN has_fails THEN 'failed' ELSE 'neutral' END",
         level(f"3 * {one(standard)} + 2 * {one(said)} + {one('number')} + {one('unit')}", 6, 3), tagged("code_compliance", ("has_passes AND NOT has_fails", "pass"), ("has_fails AND NOT has_passes", "fail"), ("has_passes AND has_fails", "mixed")),
         named(("code_standard", f"CASE WHEN regexp_matches(sentence, {text(P.STANDARD_PATTERN)}) THEN [upper(regexp_extract(sentence, {text(P.STANDARD_PATTERN)}, 1))] WHEN {standard} THEN ['STANDARD'] ELSE [] END"))),
        ("failure", "failure_analysis", "has_failure_signals OR any_failure_modes OR has_causes", "CASE WHEN any_failure_modes THEN 'failed' WHEN has_causes THEN 'negative' ELSE 'unknown' END",
         level(f"2 * {one('any_failure_modes')} + 2 * {one('any_failure_drivers')} + {one('has_causes')} + {one('number')} + {one('unit')}", 6, 3), tagged("failure_analysis", ("any_failure_modes", "has_failure_mode"), ("any_failure_drivers", "has_failure_driver"), ("has_causes", "has_causality"), ("unit", "has_units")), named(("failure_mode", "list_failure_modes"), ("failure_driver", "list_failure_drivers[1:5]"))),
        ("materials", "material_performance", "any_materials AND any_properties OR any_properties AND (unit OR number) OR (any_materials OR any_properties) AND has_tests", "CASE WHEN has_more THEN 'improved' WHEN has_less THEN 'degraded' ELSE 'neutral' END",
         level(f"2 * {one('any_materials')} + 2 * {one('any_properties')} + {one('number')} + 2 * {one('unit')} + {one('has_more OR has_less')}", 7, 4), tagged("material_performance", ("any_materials", "has_material"), ("any_properties", "has_property"), ("unit", "has_units")), named(("material", "list_materials[1:5]"), ("property", "list_properties[1:6]"))),
    ]
    events = " UNION ALL ".join(f"SELECT rows.*, {o} AS o, '{name}' AS lens, '{event}' AS event_type, {raw} AS raw_outcome, {conf} AS confidence, strength AS context_strength, {tags} AS tags, {ents} AS entities FROM rows JOIN flagged USING (sentence) WHERE {when}" for o, (name, event, when, raw, conf, tags, ents) in enumerate(lenses))
    outcome = "MAP {'improved': 'positive', 'successful': 'positive', 'pass': 'positive', 'positive': 'positive', 'degraded': 'negative', 'failed': 'negative', 'fail': 'negative', 'negative': 'negative', 'neutral': 'neutral', 'mixed': 'neutral', 'mixed_hazard': 'neutral', 'stable': 'neutral', 'unknown': 'unknown'}[raw_outcome]"
    return f"""WITH rows AS (SELECT *, row_number() OVER () AS row_id FROM ({rows}) AS q), texts AS (SELECT DISTINCT sentence FROM rows),
phrases(k, o, p, pattern) AS (VALUES {values}), met AS (SELECT sentence, k, o, p, regexp_matches(sentence, pattern) AS word FROM texts LEFT JOIN phrases ON contains(sentence, p)),
counted AS (SELECT sentence, {flags}, regexp_matches(sentence, '\\b[0-9]+([.][0-9]+)?\\b') AS number, regexp_matches(sentence, {text(units)}) AS unit FROM met GROUP BY sentence),
flagged AS (SELECT *, CASE WHEN number AND unit OR regexp_matches(sentence, {text(any_word(P.STRONG_RESULT_TERMS))}) AND (number OR unit) THEN 'strong' WHEN number OR unit OR regexp_matches(sentence, {text(any_word(P.MODERATE_CONTEXT_TERMS))}) THEN 'moderate' ELSE 'weak' END AS strength FROM counted),
raw AS ({events}), events AS (SELECT *, {outcome} AS outcome, 0.9 AS source_weight FROM raw)"""


def _lens_query(name: str) -> None:
    def query(spark: SparkSession, d: str) -> DataFrame:
        return X.apply_lens(corpus(spark, d), name).groupBy("event_type", "outcome", "raw_outcome", "confidence", "context_strength", "tags", "entities").agg(F.count("*").alias("n"))

    QUERIES[f"lens_{name}"] = query
    ORACLES[f"lens_{name}"] = f"{_lenses_sql(_LOW)} SELECT event_type, outcome, raw_outcome, confidence, context_strength, tags, entities, count(*) AS n FROM events WHERE lens = '{name}' GROUP BY ALL"


for _n in X.LENSES:
    _lens_query(_n)


def multi_lens_stack(spark: SparkSession, d: str) -> DataFrame:
    """How often each lens comes first, second and so on among a sentence's lenses."""
    return X.lens_stack(corpus(spark, d)).groupBy("rank", "lens", "confidence", "context_strength").agg(F.count("*").alias("n"))


def lens_events_on_pages(spark: SparkSession, d: str) -> DataFrame:
    """All lenses over the sentences of the pages."""
    rows = C.explode_sentences(table(spark, d, "chunks").select("chunk_id", "doc_id", "chunk_text"), "chunk_text")
    return X.lens_stack(rows).groupBy("lens", "outcome", "confidence").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_docs"))


QUERIES["multi_lens_stack"] = multi_lens_stack
QUERIES["lens_events_on_pages"] = lens_events_on_pages
ORACLES["unmatched_by_lenses"] = f"""{_lenses_sql(f"SELECT lower(unnest({C.sentences(DUCKDB, 'chunk_text')})) AS sentence FROM chunks")},
ranked AS (SELECT row_id, lens, row_number() OVER (PARTITION BY row_id ORDER BY CASE confidence WHEN 'high' THEN 3 WHEN 'med' THEN 2 ELSE 1 END DESC, CASE context_strength WHEN 'strong' THEN 3 WHEN 'moderate' THEN 2 ELSE 1 END DESC, o) AS p FROM events)
SELECT e.lens, count(*) AS n FROM rows r LEFT JOIN ranked e ON e.row_id = r.row_id AND e.p = 1 GROUP BY 1"""
ORACLES["multi_lens_stack"] = f"""{_lenses_sql(_LOW)}
SELECT rank, lens, confidence, context_strength, count(*) AS n FROM (
  SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY source_weight DESC, CASE confidence WHEN 'high' THEN 3 WHEN 'med' THEN 2 ELSE 1 END DESC, CASE context_strength WHEN 'strong' THEN 3 WHEN 'moderate' THEN 2 ELSE 1 END DESC, o) AS rank
  FROM events) AS e GROUP BY 1, 2, 3, 4"""
ORACLES["lens_events_on_pages"] = f"""{_lenses_sql(f"SELECT doc_id, lower(unnest({C.sentences(DUCKDB, 'chunk_text')})) AS sentence FROM chunks")}
SELECT lens, outcome, confidence, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM events GROUP BY 1, 2, 3"""
