"""Sentence-level text functions and classifiers as expressions over a lower-cased sentence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mortarline.functions import phrases as P
from mortarline.functions.dialect import SPARK, Dialect

_MASK = chr(1)


def sentences(d: Dialect, text: str) -> str:
    """The array of a text's sentences: line breaks are spaces, known abbreviations end no sentence."""
    nl = "'\\n'" if d.spark else "chr(10)"
    s = f"replace({text}, {nl}, ' ')"
    for a in P.ABBREVIATIONS:
        s = f"replace({s}, {d.text(a)}, {d.text(a.replace('.', _MASK))})"
    if d.spark:
        parts = f"split({s}, {d.text(r'(?<=[.!?])[ \t\n\x0B\f\r]+')})"
        return f"filter(transform({parts}, x -> trim(BOTH {d.text(' \t')} FROM replace(x, {d.text(_MASK)}, '.'))), x -> x <> '')"
    parts = f"string_split(regexp_replace({s}, {d.text(r'([.!?])\s+')}, {d.text(r'\1' + chr(30))}, 'g'), chr(30))"
    return f"list_filter(list_transform({parts}, lambda x: trim(replace(x, {d.text(_MASK)}, '.'), {d.text(' \t')})), lambda x: x <> '')"


def simple_sentences(d: Dialect, text: str) -> str:
    """The trimmed parts between full stops, exclamation and question marks: the rule for abstracts."""
    if d.spark:
        return f"filter(transform(split({text}, {d.text('[.!?]+')}), x -> trim(BOTH {d.text(' \t\n\r')} FROM x)), x -> x <> '')"
    return f"list_filter(list_transform(string_split_regex({text}, {d.text('[.!?]+')}), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13))), lambda x: x <> '')"


def feed_keep(d: Dialect, n_entities: str, tags: str, measured: str) -> str:
    """Whether a sentence of a feed is kept: it has an entity, a method tag or a measurement."""
    return f"({n_entities} > 0 OR {d.length(tags)} > 0 OR {measured})"


def stage(d: Dialect, s: str) -> str:
    return d.first([(d.word(s, words), name) for name, words in P.STAGES.items()], "unknown")


def section(d: Dialect, s: str) -> str:
    m, r, c = (d.word(s, [w]) for w in ("methods", "results", "discussion"))
    return d.first([(f"{m} AND {r} AND {c}", "mixed_discussion"), (f"{m} AND {r}", "mixed"), (m, "methods"), (r, "results"), (c, "discussion")], "unknown")


def failure_reason(d: Dialect, s: str) -> str:
    return d.first([(d.word(s, words), name) for name, words in P.FAILURE_PHRASES.items()], "unknown")


def decision(d: Dialect, s: str) -> str:
    return d.first([(d.word(s, words), name) for name, words in P.DECISION_PHRASES.items()], "unknown")


def outcome(d: Dialect, s: str) -> str:
    return d.first([(d.word(s, words), name) for name, words in P.OUTCOME_PHRASES.items()], "unknown")


def method_tags(d: Dialect, s: str) -> str:
    """All tags that apply, as an array."""
    return d.compact(f"CASE WHEN {d.word(s, words)} THEN {d.text(tag)} END" for tag, words in P.METHOD_TAGS.items())


def evidence_strength(d: Dialect, s: str) -> str:
    return d.first([(d.word(s, P.STRONG_EVIDENCE), "strong"), (d.word(s, P.WEAK_EVIDENCE), "weak")], "moderate")


def event_type(d: Dialect, s: str, tags: str, failure: str, decided: str) -> str:
    """``tags``, ``failure``, ``decided``: the results of the functions above, as expressions."""
    tagged = f"{d.length(tags)} > 0"
    has_tag = f"array_contains({tags}, 'nitrosamine')" if d.spark else f"list_contains({tags}, 'nitrosamine')"
    return d.first(
        [
            (f"{has_tag} OR {failure} = 'regulatory'", "regulatory_risk"),
            (f"{failure} = 'toxicity_flag' OR {d.word(s, P.TOXICITY_WORDS)}", "toxicity_flag"),
            (f"{failure} = 'stability_failure'", "stability_issue"),
            (d.word(s, P.DEGRADATION_WORDS), "degradation_event"),
            (f"{failure} = 'no_activity' OR {d.word(s, P.ACTIVITY_WORDS)}", "efficacy_result"),
            (f"{failure} = 'scalability' OR {d.word(s, P.PRODUCTION_WORDS)}", "manufacturing_constraint"),
            (f"{tagged} AND {d.word(s, P.COST_WORDS)}", "cost_tradeoff"),
            (tagged, "method_evaluation"),
            (f"{decided} <> 'unknown'", "decision_point"),
        ],
        "other",
    )


def measurements(d: Dialect, s: str) -> str:
    """Every non-overlapping match of every measurement pattern as 'type|value|unit|context'."""
    parts = []
    for name, quantity, units in P.MEASUREMENTS:
        pattern = rf"{quantity}.*?(\d+\.?\d*)\s*({units})"
        found = d.extract_all(s, pattern)
        row = lambda x: f"concat({d.text(name + '|')}, {d.extract(x, pattern, 1)}, '|', {d.extract(x, pattern, 2)}, '|', {x})"  # noqa: B023,E731
        parts.append(f"transform({found}, x -> {row('x')})" if d.spark else f"list_transform({found}, lambda x: {row('x')})")
    return d.concat_arrays(parts)


def has_measurement(d: Dialect, s: str) -> str:
    return "(" + " OR ".join(d.matches(s, rf"{q}.*?(\d+\.?\d*)\s*({u})") for _, q, u in P.MEASUREMENTS) + ")"


def confidence(d: Dialect, s: str, has_entity: str, tags: str, failure: str, decided: str, measured: str) -> str:
    signals = d.points((d.one_word(s, t), 1) for t in P.HIGH_SIGNAL_TERMS)
    score = d.points([(has_entity, 2), (f"{d.length(tags)} > 0", 1), (f"{failure} <> 'unknown'", 2), (f"{decided} <> 'unknown'", 1), (measured, 2), (f"{signals} >= 3", 2), (f"{signals} = 2", 1)])
    return d.first([(f"{score} >= {P.HIGH_CONFIDENCE}", "high"), (f"{score} >= {P.MED_CONFIDENCE}", "med")], "low")


def suggested_keep(d: Dialect, conf: str, kind: str, failure: str, decided: str, tags: str) -> str:
    return f"CASE WHEN {conf} IN ('med', 'high') OR ({kind} <> 'other' AND ({failure} <> 'unknown' OR {decided} <> 'unknown' OR {d.length(tags)} > 0)) THEN 1 ELSE 0 END"


def signal_gate(d: Dialect, s: str, tags: str, decided: str, measured: str) -> str:
    """The engine's gate: measurement, part of a failure phrase, a method tag or a decision."""
    failures = [p for group in P.FAILURE_PHRASES.values() for p in group]
    return f"({measured} OR {d.has(s, failures)} OR {d.length(tags)} > 0 OR {decided} <> 'unknown')"


def phrase_gate(d: Dialect, s: str) -> str:
    """The batch path's gate: part of any failure, decision or method phrase (so 'ms' within a word passes)."""
    return d.has(s, dict.fromkeys(p for t in (P.FAILURE_PHRASES, P.DECISION_PHRASES, P.METHOD_TAGS) for g in t.values() for p in g))


def system_context(d: Dialect, s: str, tags: str) -> str:
    serum = f"array_contains({tags}, 'serum')" if d.spark else f"list_contains({tags}, 'serum')"
    return f"CASE WHEN {serum} THEN 'serum/plasma' WHEN {d.has(s, ['organoid'])} THEN 'organoid' WHEN {d.has(s, ['cell line', 'cell culture'])} THEN 'cells' END"


def construction_event(d: Dialect, s: str) -> str:
    context = d.has(s, P.BUILDING_CONTEXT)
    rules = [f"WHEN {d.has(s, P.CLIMATE_TERMS)} AND {context} THEN 'climate_load'"]
    rules += [f"WHEN {d.has(s, first)} AND {d.has(s, near)} THEN {d.text(name)}" for name, first, near in P.CONSTRUCTION_EVENTS]
    return f"CASE {' '.join(rules)} END"


def boilerplate(d: Dialect, s: str) -> str:
    words = d.points((d.matches(s, rf"(?:^|\s){w}(?:\s|$)"), 1) for w in P.BOILERPLATE_WORDS)
    return (
        f"(({d.has(s, ['climate normals', 'normales climatiques'])} AND NOT {d.has(s, P.BUILDING_CONTEXT)}) OR {d.has(s, P.FRONT_MATTER)}"
        f" OR ({words} >= 3 AND NOT {d.has(s, P.ACTION_TERMS)}) OR ({' AND '.join(d.has(s, [w]) for w in ('climate', 'pressure', 'temperature', 'humidity'))}))"
    )


def climate_row(d: Dialect, s: str, title: str = "''") -> str:
    """A row of a climate table, not prose."""
    split = f"split({s}, {d.text(r'\s+')})" if d.spark else f"string_split_regex({s}, {d.text(r'\s+')})"
    strip = (lambda x: f"trim(BOTH {d.text('.,;:()[]{}')} FROM {x})") if d.spark else (lambda x: f"trim({x}, {d.text('.,;:()[]{}')})")
    number = lambda x: d.matches(strip(x), r"^-?\d*(?:\.\d+|\d\.?\d*)$")
    tokens = f"size(filter({split}, x -> {strip('x')} <> ''))" if d.spark else f"len(list_filter({split}, lambda x: {strip('x')} <> ''))"
    numbers = f"size(filter({split}, x -> {number('x')}))" if d.spark else f"len(list_filter({split}, lambda x: {number('x')}))"
    months = d.points((d.has(s, [m]), 1) for m in P.MONTHS)
    return (
        f"(({d.has(s, ['climate normals'])} OR contains({title}, 'climate normals')) AND NOT {d.has(s, P.BUILDING_CONTEXT)} AND (({numbers} >= 3 AND {tokens} <= 18) OR ({months} >= 2 AND {numbers} >= 1)"
        f" OR ({d.has(s, P.CLIMATE_PLACES)} AND {numbers} >= 1 AND {tokens} <= 12) OR ({d.has(s, ['table'])} AND {numbers} >= 2) OR ({d.has(s, ['normal'])} AND {numbers} >= 2)))"
    )


def boosted_confidence(d: Dialect, entities: str, conf: str, s: str, domain: str) -> str:
    """A confidence raised by the kinds of the entities in a 'type:name; …' string and by the sentence."""
    high = f"CASE WHEN {domain} = 'construction_science' THEN {d.matches(f'lower({entities})', r'(?:^|;)\s*(?:' + '|'.join(P.HIGH_VALUE_TYPES['construction_science']) + r')\s*:\s*[^;\s]')} ELSE {d.matches(f'lower({entities})', r'(?:^|;)\s*(?:' + '|'.join(P.DEFAULT_HIGH_VALUE) + r')\s*:\s*[^;\s]')} END"
    assay = d.matches(f"lower({entities})", r"(?:^|;)\s*(?:" + "|".join(P.ASSAY_TYPES) + r")\s*:\s*[^;\s]")
    base = f"CASE lower(trim(coalesce({conf}, 'low'))) WHEN 'high' THEN 'high' WHEN 'med' THEN 'med' WHEN 'medium' THEN 'med' ELSE 'low' END"
    return f"CASE WHEN {base} = 'high' THEN 'high' WHEN coalesce({entities}, '') = '' THEN {base} WHEN {high} AND {assay} AND {d.word(s, P.MODEL_CONTEXT)} THEN 'high' WHEN {high} AND {assay} THEN 'med' WHEN {high} AND {base} = 'low' THEN 'med' ELSE {base} END"


def classified_sql(d: Dialect, rows: str, text: str = "sentence", has_entity: str = "has_entity") -> str:
    """A query that adds all labels to a subquery with a lower-cased sentence and has_entity."""
    one = f"SELECT *, {method_tags(d, text)} AS tags, {failure_reason(d, text)} AS failure_reason, {decision(d, text)} AS decision, {outcome(d, text)} AS outcome, {stage(d, text)} AS stage, {evidence_strength(d, text)} AS evidence_strength, {has_measurement(d, text)} AS has_measurement FROM ({rows}) AS r"
    two = f"SELECT *, {event_type(d, text, 'tags', 'failure_reason', 'decision')} AS event_type, {confidence(d, text, has_entity, 'tags', 'failure_reason', 'decision', 'has_measurement')} AS confidence, {system_context(d, text, 'tags')} AS system_context FROM ({one}) AS o"
    return f"SELECT *, {suggested_keep(d, 'confidence', 'event_type', 'failure_reason', 'decision', 'tags')} AS keep FROM ({two}) AS t"


def classify(rows: DataFrame, sentence: str = "sentence", has_entity: str = "has_entity") -> DataFrame:
    """Labels of each row's sentence: tags, failure_reason, decision, outcome, stage, evidence_strength, event_type, confidence, keep.

    The sentence is compared in lower case; a null one has no label but the
    defaults.
    """
    d, s = SPARK, "_s"
    out = rows.withColumn(s, F.lower(F.coalesce(F.col(sentence), F.lit(""))))
    out = out.withColumns({n: F.expr(f(d, s)) for n, f in (("tags", method_tags), ("failure_reason", failure_reason), ("decision", decision), ("outcome", outcome), ("stage", stage), ("evidence_strength", evidence_strength), ("has_measurement", has_measurement))})
    out = out.withColumns({"event_type": F.expr(event_type(d, s, "tags", "failure_reason", "decision")), "confidence": F.expr(confidence(d, s, has_entity, "tags", "failure_reason", "decision", "has_measurement")), "system_context": F.expr(system_context(d, s, "tags"))})
    return out.withColumn("keep", F.expr(suggested_keep(d, "confidence", "event_type", "failure_reason", "decision", "tags"))).drop(s)


def explode_sentences(pages: DataFrame, text: str) -> DataFrame:
    """One row per sentence with position from 0; null and empty texts give none."""
    rest = [c for c in pages.columns if c != text]
    return pages.select(*rest, F.posexplode_outer(F.expr(sentences(SPARK, f"`{text}`"))).alias("position", "sentence")).where("sentence is not null")
