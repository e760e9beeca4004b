"""Construction lenses: each looks at one sentence and gives an event with entities, or nothing."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortarline.functions import phrases as P
from mortarline.functions.dialect import SPARK, Dialect

L = P.LENS
LENSES = ("building_physics", "climate", "compliance", "failure", "materials")


def unit_signal(d: Dialect, s: str) -> str:
    """Whether any unit stands in the text; in Spark a search for what the units hold goes before the patterns."""
    # the other engine's patterns cannot look around: there the digit and the space are part of the match
    patterns = P.UNIT_PATTERNS if d.spark else [p.replace(r"(?<=\d)%(?=\s|$)", r"\d%(?:\s|$)") for p in P.UNIT_PATTERNS]
    found = d.matches(s, "|".join(patterns))
    return f"({d.has(s, P.UNIT_PARTS)} AND {found})" if d.spark else found


def number_signal(d: Dialect, s: str) -> str:
    return d.matches(s, r"\b\d+(?:\.\d+)?\b")


def normalized_outcome(d: Dialect, raw: str) -> str:
    return f"CASE {raw} " + " ".join(f"WHEN {d.text(k)} THEN {d.text(v)}" for k, v in P.OUTCOME_BUCKETS.items()) + " ELSE 'unknown' END"


def source_weight(d: Dialect, source_type: str) -> str:
    return d.weights(f"lower(trim(coalesce({source_type}, 'research_paper')))", P.SOURCE_WEIGHTS, P.SOURCE_WEIGHTS["research_paper"])


def context_strength(d: Dialect, s: str, flags: Flags | None = None) -> str:
    flags = flags or in_full(d, s)
    n, u = flags.number, flags.unit
    return d.first([(f"({n} AND {u}) OR ({d.word(s, P.STRONG_RESULT_TERMS)} AND ({n} OR {u}))", "strong"), (f"{n} OR {u} OR {d.word(s, P.MODERATE_CONTEXT_TERMS)}", "moderate")], "weak")


def _level(d: Dialect, score: str, high: int = 6, med: int = 3) -> str:
    return d.first([(f"{score} >= {high}", "high"), (f"{score} >= {med}", "med")], "low")


def _entities(d: Dialect, groups: Sequence[tuple[str, str]]) -> str:
    """'type:name' strings of (type, array) groups, without generic names and names of one letter; groups share no names."""
    arrays = d.concat_arrays([d.prefixed(a, f"{kind}:") for kind, a in groups])
    drop = ", ".join(d.text(f"{kind}:{g}") for kind, _ in groups for g in P.GENERIC_NAMES)
    kept = f"array_except(array_distinct({arrays}), array({drop}))" if d.spark else f"list_filter({arrays}, lambda x: x NOT IN ({drop}))"
    return d.joined(kept, "; ")


@dataclass(frozen=True)
class Flags:
    """What lenses ask of a sentence, as expressions: each in full, or the name of a column that holds it."""

    any_of: Callable[[str], str]
    has: Callable[[str], str]
    number: str
    unit: str


def in_full(d: Dialect, s: str) -> Flags:
    return Flags(lambda key: d.word(s, L[key]), lambda key: d.has(s, L[key]), number_signal(d, s), unit_signal(d, s))


def lens(d: Dialect, name: str, s: str, flags: Flags | None = None) -> dict[str, str]:
    """trigger, raw_outcome, confidence, event_type, tags and entities of one lens as expressions."""
    flags = flags or in_full(d, s)
    any_of, has, n, u = flags.any_of, flags.has, flags.number, flags.unit
    top = lambda key, n: d.top(d.hits(s, L[key]), n)
    tags: list[tuple[str, str]] = []
    if name == "building_physics":
        gap = rf"(?:\W*\b\w+\b){{0,{P.ENERGY_WINDOW}}}\W*"
        energy = r"\benergy\s+(?:consumption|use|demand)\b"
        # the pattern with the open window is costly: most sentences have no word of it
        flexible = f"(contains({s}, 'reduc') AND contains({s}, 'energy') AND ({d.matches(s, rf'\breduc\w*\b{gap}{energy}')} OR {d.matches(s, rf'{energy}{gap}\breduc\w*\b')}))"
        trigger = any_of("physics")
        result = d.first([(has("physics_bad"), "degraded"), (f"{has('physics_good')} OR {flexible}", "positive")], "neutral")
        score = d.points([("true", 2), (any_of("assemblies"), 1), (n, 1), (u, 2), (has("measured"), 1)])
        level = _level(d, score)
        event = "building_physics_performance"
        tags = [(any_of("assemblies"), "has_component"), (u, "has_units")]
        entities = [("building_component", top("assemblies", 5)), ("physics_metric", top("physics", 6))]
    elif name == "climate":
        trigger = f"({any_of('hazards')} OR {any_of('resilience')})"
        result = d.first([(f"{has('climate_bad')} AND {has('climate_good')}", "mixed_hazard"), (has("climate_bad"), "degraded"), (has("climate_good"), "improved"), (any_of("hazards"), "negative")], "neutral")
        built = f"({any_of('climate_materials')} OR {any_of('climate_systems')})"
        level = _level(d, d.points([(any_of("hazards"), 2), (any_of("resilience"), 1), (n, 1), (u, 1), (has("scenarios"), 2), (built, 2)]))
        event = "climate_resilience"
        tags = [(any_of("hazards"), "has_hazard"), (d.has(s, ["rcp", "ssp"]), "climate_scenario"), (built, "construction_climate_interaction")]
        entities = [("hazard", top("hazards", 6)), ("resilience_term", top("resilience", 4)), ("material", top("climate_materials", 3)), ("system", top("climate_systems", 3))]
    elif name == "compliance":
        standard = f"({has('standards')} OR {d.matches(s, P.STANDARD_PATTERN)})"
        said = f"({has('passes')} OR {has('fails')} OR {d.has(s, ['requirement', 'standard'])})"
        trigger = f"({standard} OR {said})"
        result = d.first([(f"{has('passes')} AND {has('fails')}", "mixed"), (has("passes"), "successful"), (has("fails"), "failed")], "neutral")
        level = _level(d, d.points([(standard, 3), (said, 2), (n, 1), (u, 1)]))
        event = "code_compliance"
        tags = [(f"{has('passes')} AND NOT {has('fails')}", "pass"), (f"{has('fails')} AND NOT {has('passes')}", "fail"), (f"{has('passes')} AND {has('fails')}", "mixed")]
        code = f"CASE WHEN {d.matches(s, P.STANDARD_PATTERN)} THEN upper({d.extract(s, P.STANDARD_PATTERN, 1)}) WHEN {standard} THEN 'STANDARD' END"
        entities = [("code_standard", d.compact([code]))]
    elif name == "failure":
        cause = has("causes")
        trigger = f"({has('failure_signals')} OR {any_of('failure_modes')} OR {cause})"
        result = d.first([(any_of("failure_modes"), "failed"), (cause, "negative")], "unknown")
        level = _level(d, d.points([(any_of("failure_modes"), 2), (any_of("failure_drivers"), 2), (cause, 1), (n, 1), (u, 1)]))
        event = "failure_analysis"
        tags = [(any_of("failure_modes"), "has_failure_mode"), (any_of("failure_drivers"), "has_failure_driver"), (cause, "has_causality"), (u, "has_units")]
        entities = [("failure_mode", d.hits(s, L["failure_modes"])), ("failure_driver", top("failure_drivers", 5))]
    elif name == "materials":
        m, p = any_of("materials"), any_of("properties")
        trigger = f"(({m} AND {p}) OR ({p} AND ({u} OR {n})) OR (({m} OR {p}) AND {has('tests')}))"
        result = d.first([(has("more"), "improved"), (has("less"), "degraded")], "neutral")
        level = _level(d, d.points([(m, 2), (p, 2), (n, 1), (u, 2), (f"({has('more')} OR {has('less')})", 1)]), 7, 4)
        event = "material_performance"
        tags = [(m, "has_material"), (p, "has_property"), (u, "has_units")]
        entities = [("material", top("materials", 5)), ("property", top("properties", 6))]
    else:
        raise ValueError(f"unknown lens {name!r}; known: {', '.join(LENSES)}")
    listed = d.compact([d.text(event), *(f"CASE WHEN {c} THEN {d.text(t)} END" for c, t in tags)])
    return {"trigger": trigger, "raw_outcome": result, "confidence": level, "event_type": d.text(event), "tags": d.joined(listed, ","), "entities": _entities(d, entities)}


def sound_entities(entities: Column) -> Column:
    """An array of entities (entity_type, entity_name, entity_variant, role) without junk, each once, the first kept.

    Junk are names of one character, of punctuation alone, and words that name nothing.
    """
    name = lambda e: F.lower(e["entity_name"])
    kept = F.filter(entities, lambda e: (F.length(name(e)) >= 2) & ~name(e).rlike(r"^[!@#$%^&*()_+\-=\[\]{}|;:,.<>?]+$") & ~name(e).isin(*P.GENERIC_NAMES))
    key = lambda e: F.concat_ws("\u0001", e["entity_type"], name(e), F.coalesce(e["entity_variant"], F.lit("")), F.coalesce(e["role"], F.lit("")))
    bound = F.transform(F.array(kept), lambda es: F.struct(es.alias("es"), F.transform(es, key).alias("keys")))
    firsts = F.transform(bound, lambda b: F.filter(b["es"], lambda e, i: F.array_position(b["keys"], F.get(b["keys"], i)) == i + 1))
    return F.get(firsts, F.lit(0))


COLUMNS = ("lens", "event_type", "outcome", "raw_outcome", "confidence", "context_strength", "source_weight", "tags", "entities")


def lens_columns(d: Dialect, name: str, s: str, source_type: str = "'research_paper'") -> dict[str, str]:
    x = lens(d, name, s)
    return {
        "lens": d.text(name),
        "event_type": x["event_type"],
        "outcome": normalized_outcome(d, x["raw_outcome"]),
        "raw_outcome": x["raw_outcome"],
        "confidence": x["confidence"],
        "context_strength": context_strength(d, s),
        "source_weight": source_weight(d, source_type),
        "tags": x["tags"],
        "entities": x["entities"],
    }


def _with_flags(rows: DataFrame, names: Sequence[str], sentence: str) -> tuple[DataFrame, dict[str, dict[str, str]], Flags]:
    """``rows`` with the lower-cased sentence ``_s`` and what the lenses ask of it as columns, and the lenses over those columns."""
    d, s, asked = SPARK, "_s", {"_number": number_signal(SPARK, "_s"), "_unit": unit_signal(SPARK, "_s")}

    def column(kind: str, rule: Callable[[str, Sequence[str]], str]) -> Callable[[str], str]:
        def name(key: str) -> str:
            asked[f"_{kind}_{key}"] = rule(s, L[key])
            return f"_{kind}_{key}"

        return name

    flags = Flags(column("any", d.word), column("has", d.has), "_number", "_unit")
    lenses = {name: lens(d, name, s, flags) for name in names}
    rows = rows.withColumn(s, F.lower(F.col(sentence)))
    return rows.withColumns({k: F.expr(v) for k, v in asked.items()}), lenses, flags


def apply_lens(rows: DataFrame, name: str, sentence: str = "sentence", source_type: str = "'research_paper'") -> DataFrame:
    """The rows that trigger a lens, with its columns; a null sentence triggers none."""
    return lens_stack(rows, [name], sentence, source_type=source_type).drop("rank")


def lens_stack(rows: DataFrame, names: Sequence[str] = LENSES, sentence: str = "sentence", source_type: str = "'research_paper'", confidence_rank: dict[str, int] | None = None, context_rank: dict[str, int] | None = None, no_match: str = "drop") -> DataFrame:
    """All lens events of each row in one pass, ranked by source weight, confidence and context strength.

    ``rank`` counts from 1; ties follow the order of ``names``.  The rank maps can
    be replaced.  A row without any event is left out; with ``no_match`` "keep"
    it stays once with null columns, with "raise" it is an error when it is read.
    An unknown lens or mode is an error at once.
    """
    if no_match not in ("drop", "keep", "raise"):
        raise ValueError(f"unknown mode {no_match!r}")
    d = SPARK
    conf = confidence_rank or {"high": 3, "med": 2, "low": 1}
    ctx = context_rank or {"strong": 3, "moderate": 2, "weak": 1}
    keep = rows.columns
    rows, lenses, flags = _with_flags(rows, names, sentence)
    rows = rows.withColumns({"_strength": F.expr(context_strength(d, "_s", flags)), "_weight": F.expr(source_weight(d, source_type))})
    for name, x in lenses.items():
        rows = rows.withColumn(f"_{name}", F.expr(f"CASE WHEN {x['trigger']} THEN named_struct('event_type', {x['event_type']}, 'raw_outcome', {x['raw_outcome']}, 'confidence', {x['confidence']}, 'tags', {x['tags']}, 'entities', {x['entities']}) END"))
    events = []
    for i, name in enumerate(names):
        e = f"_{name}"
        order = f"'o1', -_weight, 'o2', -({d.weights(f'{e}.confidence', conf, 0)}), 'o3', -({d.weights('_strength', ctx, 0)}), 'o4', {i}"
        fields = f"'lens', '{name}', 'event_type', {e}.event_type, 'outcome', {normalized_outcome(d, f'{e}.raw_outcome')}, 'raw_outcome', {e}.raw_outcome, 'confidence', {e}.confidence, 'context_strength', _strength, 'source_weight', _weight, 'tags', {e}.tags, 'entities', {e}.entities"
        events.append(F.expr(f"CASE WHEN {e} IS NOT NULL THEN named_struct({order}, {fields}) END"))
    ordered = F.array_sort(F.array_compact(F.array(*events)))
    out = rows.select(*keep, F.posexplode_outer(ordered).alias("p", "e"))
    if no_match == "drop":
        out = out.where("e is not null")
    if no_match == "raise":
        out = out.withColumn("p", F.when(F.col("e").isNull(), F.raise_error(F.lit("no lens matches")).cast("int")).otherwise(F.col("p")))
    return out.select(*keep, (F.col("p") + 1).cast("bigint").alias("rank"), *[F.col(f"e.{c}").alias(c) for c in COLUMNS])
