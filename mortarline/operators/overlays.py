"""Overlay scores of events and entities, canonical entities and their buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mortarline.functions import phrases as P
from mortarline.functions.dialect import SPARK, Dialect


def known_overlay(overlay: str) -> Mapping[str, Mapping[str, float]]:
    if overlay not in P.OVERLAYS:
        raise ValueError(f"unknown overlay {overlay!r}; known: {', '.join(P.OVERLAYS)}")
    return P.OVERLAYS[overlay]


def event_score(d: Dialect, overlay: str, s: str) -> str:
    """The weights of all boost and demote terms that are part of a lower-cased snippet, with the overlay's own rules."""
    o = known_overlay(overlay)
    rules = [(f"contains({s}, {d.text(t.lower())})", w) for t, w in [*o["boost"].items(), *o["demote"].items()]]
    if overlay == "climate_resilience_v1":
        rules.append((f"{d.has(s, P.CO_CLIMATE)} AND {d.has(s, P.CO_MATERIAL)}", 1.5))
    if overlay == "science_research_v1":
        rules.append((f"{d.has(s, ['efficacy', 'effective'])} AND NOT {d.has(s, P.ASSAY_KEYWORDS)}", -1))
    return f"cast({d.points(rules)} as double)"


def priority(d: Dialect, overlay: str, kind: str) -> str:
    return d.weights(kind, known_overlay(overlay)["priority"], 1.0)


def model_weight(d: Dialect, name: str) -> str:
    return d.weights(f"lower(trim({name}))", P.MODEL_WEIGHTS, 1.0)


def bucket(d: Dialect, score: str, most: str) -> str:
    share = f"(CASE WHEN {most} <= 0 THEN 0 ELSE {score} / {most} * 100 END)"
    return d.first([(f"{share} >= {n}", name) for name, n in P.BUCKETS], P.LAST_BUCKET)


def most_score(d: Dialect, n: str) -> str:
    """The score that counts as full for so many events."""
    return f"cast(greatest(least(2 * {n}, 10000), 10) as double)"


def canonical_type(d: Dialect, name: str, kind: str, domain: str | None = "construction_science") -> str:
    tables = [*P.GLOBAL_TYPES.items(), *(P.DOMAIN_TYPES.items() if domain == "construction_science" else ())]
    n = f"lower(trim({name}))"
    rules = " ".join(f"WHEN {n} IN ({', '.join(d.text(v) for v in values)}) THEN {d.text(t)}" for t, values in tables)
    return f"CASE {rules} ELSE {kind} END"


def alias_rows(mapping: DataFrame, kind: str = "entity_type", canonical: str = "canonical", aliases: str = "aliases") -> DataFrame:
    """(kind, alias, canonical): the first canonical name of the list that has an alias, case aside."""
    rows = mapping.select(F.col(kind).alias("kind"), F.col(canonical).alias("canonical"), F.col("canonical_id").alias("ord"), F.explode(F.array_distinct(F.transform(aliases, F.lower))).alias("alias"))
    return rows.groupBy("kind", "alias").agg(F.min_by("canonical", "ord").alias("canonical"))


def normalized_entities(entities: DataFrame, aliases: DataFrame) -> DataFrame:
    """``entities`` with canonical_name: the alias table's name of the same type, else the trimmed name itself."""
    rows = entities.withColumn("_alias", F.lower(F.trim("entity_name")))
    known = aliases.select(F.col("kind").alias("_kind"), F.col("alias").alias("_alias"), F.col("canonical").alias("_canonical"))
    out = rows.join(known, (F.col("entity_type") == F.col("_kind")) & (rows["_alias"] == known["_alias"]), "left")
    return out.select(*entities.columns, F.coalesce("_canonical", F.trim("entity_name")).alias("canonical_name"))


def entity_role(name: Column, kind: Column) -> Column:
    """context for generic process words that are called assays, else primary."""
    return F.when((kind == "assay") & F.lower(name).isin(*P.PROCESS_WORDS), "context").otherwise("primary")


def roles_by_map(entities: DataFrame, mapping: DataFrame) -> DataFrame:
    """``entities`` with ``role``: that of the first canonical name of its type which is its name or has it as a variant, else by type.

    ``mapping``: kind, canonical, variants (array), role (null: primary) and ord,
    the order of the canonical names.  Without a hit the role is primary for the
    types that are always so, and unknown for the others.
    """
    names = mapping.select(F.lower("kind").alias("_kind"), F.coalesce("role", F.lit("primary")).alias("_role"), "ord", F.explode(F.array_distinct(F.transform(F.concat(F.array("canonical"), F.coalesce("variants", F.array().cast("array<string>"))), F.lower))).alias("_name"))
    first = names.groupBy("_kind", "_name").agg(F.min_by("_role", "ord").alias("_role"))
    kind = F.lower(F.trim(F.coalesce("entity_type", F.lit(""))))
    rows = entities.withColumns({"_kind": kind, "_name": F.lower(F.trim(F.coalesce("entity_name", F.lit(""))))})
    role = F.coalesce("_role", F.when(F.col("_kind").isin(*P.PRIMARY_TYPES), "primary").otherwise("unknown"))
    return rows.join(first, ["_kind", "_name"], "left").withColumn("role", role).select(*entities.columns, "role")


#: Peptides with fewer linked events are left out of a final export.
PEPTIDE_EVENTS = 2


def exported_entities(scored: DataFrame) -> DataFrame:
    """What a final export shows: all but peptides with too few events.  ``scored``: entity_type, n_events."""
    return scored.where((F.col("entity_type") != "peptide") | (F.coalesce("n_events", F.lit(0)) >= PEPTIDE_EVENTS))


def peptide_is_valid(name: Column, known: Sequence[str] = ()) -> Column:
    n = F.upper(F.trim(name))
    return n.rlike(f"^[{P.AMINO_ACIDS}]{{8,100}}$") | n.isin(*known) if known else n.rlike(f"^[{P.AMINO_ACIDS}]{{8,100}}$")


def canonical_entities(entities: DataFrame, aliases: DataFrame, domain: str = "construction_science") -> tuple[DataFrame, DataFrame]:
    """(canonical entities, mapping): entities merged by lower-cased canonical name and canonical type.

    The row of the smallest entity_id gives the name; original_names holds all
    names in order.  mapping: entity_id, canonical_id.  Entities without name or
    type, generic process words and invalid peptides are in neither.
    """
    rows = entities.where("entity_id is not null and trim(entity_name) <> '' and trim(entity_type) <> ''")
    rows = rows.withColumn("entity_type", F.expr(canonical_type(SPARK, "entity_name", "entity_type", domain)))
    rows = normalized_entities(rows, aliases)
    rows = rows.where((entity_role(F.col("canonical_name"), F.col("entity_type")) != "context") & ((F.col("entity_type") != "peptide") | peptide_is_valid(F.col("canonical_name"))))
    rows = rows.withColumn("canonical_id", F.concat("entity_type", F.lit(":"), F.lower("canonical_name")))
    merged = rows.groupBy("canonical_id", "entity_type").agg(F.min_by("canonical_name", "entity_id").alias("entity_name"), F.array_sort(F.collect_set("entity_name")).alias("original_names"), F.count("*").alias("n_entities"))
    return merged, rows.select("entity_id", "canonical_id")


def overlay_event_scores(events: DataFrame, overlays: Sequence[str], snippet: str = "evidence_snippet") -> DataFrame:
    """event_id with one score column per overlay."""
    rows = events.select("event_id", F.lower(F.coalesce(F.col(snippet), F.lit(""))).alias("_s"))
    return rows.select("event_id", *[F.expr(event_score(SPARK, o, "_s")).alias(o) for o in overlays])


def entity_overlay_scores(canonical: DataFrame, mapping: DataFrame, links: DataFrame, scores: DataFrame, overlays: Sequence[str], models: DataFrame | None = None) -> DataFrame:
    """Score and bucket of every canonical entity under every overlay.

    ``models``: event_id, model (a weight per distinct model of the entity's
    events counts).  An event without a score counts 0.
    """
    pairs = links.join(mapping, "entity_id").select("canonical_id", "event_id").distinct()
    sums = pairs.join(scores, "event_id", "left").groupBy("canonical_id").agg(F.count("*").alias("n_events"), *[F.avg(F.coalesce(F.col(o), F.lit(0.0))).alias(f"_avg_{o}") for o in overlays])
    rows = canonical.join(sums, "canonical_id")
    if models is not None:
        own = pairs.join(models, "event_id").select("canonical_id", F.lower(F.trim("model")).alias("model")).distinct()
        factor = own.groupBy("canonical_id").agg(F.least(F.avg(F.expr(model_weight(SPARK, "model"))), F.lit(2.0)).alias("model_factor"))
        rows = rows.join(factor, "canonical_id", "left").withColumn("model_factor", F.coalesce("model_factor", F.lit(1.0)))
    else:
        rows = rows.withColumn("model_factor", F.lit(1.0))
    for o in overlays:
        score = F.col("n_events") * F.expr(priority(SPARK, o, "entity_type")) * F.col("model_factor") + F.least(F.col(f"_avg_{o}"), F.col("n_events") * 0.5)
        if o == "biohacking_curiosity_v1":
            score = F.when(F.lower("entity_name").isin(*P.INFRASTRUCTURE), score * 0.5).otherwise(score)
        rows = rows.withColumn(f"{o}_score", score)
        rows = rows.withColumn(f"{o}_bucket", F.expr(bucket(SPARK, f"`{o}_score`", most_score(SPARK, "n_events"))))
    return rows.drop(*[f"_avg_{o}" for o in overlays])


def overlay_top(scored: DataFrame, overlay: str, n: int = 20) -> DataFrame:
    """The n best entities of an overlay with their rank; ties go by canonical_id."""
    best = scored.orderBy(F.desc(f"{overlay}_score"), "canonical_id").limit(n)
    return best.withColumn("rank", F.row_number().over(W.orderBy(F.desc(f"{overlay}_score"), "canonical_id")))


def bucket_distribution(scored: DataFrame, overlay: str) -> DataFrame:
    """Count and share of entities per bucket; all five buckets, 0 where empty."""
    labels = [name for name, _ in P.BUCKETS] + [P.LAST_BUCKET]
    counts = [F.count_if(F.col(f"{overlay}_bucket") == b).alias(b) for b in labels]
    one = scored.agg(F.count("*").alias("total"), *counts)
    cells = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(b).alias("bucket"), F.col(b).alias("n")) for i, b in enumerate(labels)])
    out = one.select("total", F.explode(cells).alias("c")).select("c.position", "c.bucket", "c.n", "total")
    return out.select("position", "bucket", "n", F.when(F.col("total") > 0, F.round(F.col("n") * 100.0 / F.col("total"), 4)).otherwise(0.0).alias("percent"))


def emphasized(score: Column, pattern: Column, emphasis: Mapping[str, float] = P.PATTERN_EMPHASIS) -> Column:
    out = F.lit(1.0)
    for k, v in emphasis.items():
        out = F.when(pattern == k, v).otherwise(out)
    return score * out
