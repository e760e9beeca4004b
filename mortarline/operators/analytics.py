"""Rollups, exports and checks over events, entities and their links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortarline.functions import phrases as P
from mortarline.functions.normalize import iso_timestamp

CONFIDENCE_ORDER = ("high", "med", "low")


def distribution(rows: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias(name))


def top(rows: DataFrame, n: int, by: str, *ties: str) -> DataFrame:
    """The n rows with the largest value; ties go by the given columns."""
    return rows.orderBy(F.desc(by), *ties).limit(n)


def confidence_rank(c: Column) -> Column:
    out = F.lit(len(CONFIDENCE_ORDER) + 1)
    for i, level in reversed(list(enumerate(CONFIDENCE_ORDER, 1))):
        out = F.when(c == level, i).otherwise(out)
    return out


def entity_rollup(entities: DataFrame, links: DataFrame, events: DataFrame) -> DataFrame:
    """Per entity name and type: distinct events and papers, first and last seen."""
    rows = links.join(entities.select("entity_id", "entity_type", "entity_name"), "entity_id").join(events.select("event_id", "source_id", "created_at"), "event_id")
    return rows.groupBy("entity_type", "entity_name").agg(F.count_distinct("event_id").alias("event_count"), F.count_distinct("source_id").alias("paper_count"), F.min("created_at").alias("first_seen"), F.max("created_at").alias("last_seen"))


def events_with_entities(events: DataFrame, links: DataFrame, entities: DataFrame) -> DataFrame:
    """Every event with its entities as 'type:name; …' in order ('' without any)."""
    named = links.join(entities.select("entity_id", F.concat("entity_type", F.lit(":"), "entity_name").alias("e")), "entity_id")
    listed = named.groupBy("event_id").agg(F.array_join(F.array_sort(F.collect_set("e")), "; ").alias("entities"))
    return events.join(listed, "event_id", "left").withColumn("entities", F.coalesce("entities", F.lit("")))


def sources_with_event_counts(sources: DataFrame, events: DataFrame) -> DataFrame:
    """All sources with their number of events, 0 included; events are counted before the join."""
    counts = events.groupBy("source_id").agg(F.count("*").alias("n"))
    return sources.select("source_id", "title").join(counts, "source_id", "left").withColumn("n_events", F.coalesce("n", F.lit(0))).drop("n")


def entities_per_event(events: DataFrame, links: DataFrame) -> DataFrame:
    """How many events have how many entities."""
    counts = links.groupBy("event_id").agg(F.count("*").alias("n_entities"))
    return events.select("event_id").join(counts, "event_id", "left").groupBy(F.coalesce("n_entities", F.lit(0)).alias("n_entities")).agg(F.count("*").alias("n_events"))


def events_without_entities(events: DataFrame, links: DataFrame) -> DataFrame:
    return events.join(links.select("event_id"), "event_id", "left_anti")


def events_with_both(links: DataFrame, entities: DataFrame, one: Sequence[str], other: Sequence[str]) -> DataFrame:
    """Events that have an entity of one of both groups of types: one pass, no self-join."""
    kinds = links.join(entities.select("entity_id", "entity_type"), "entity_id")
    flags = kinds.groupBy("event_id").agg(F.count_if(F.col("entity_type").isin(*one)).alias("n_one"), F.count_if(F.col("entity_type").isin(*other)).alias("n_other"))
    return flags.where("n_one > 0 and n_other > 0")


def coverage(events: DataFrame, links: DataFrame, wanted: float = 70.0) -> DataFrame:
    """Share of events that have an entity, and whether it is enough."""
    linked = links.select("event_id").distinct().withColumn("linked", F.lit(1))
    out = events.select("event_id").join(linked, "event_id", "left").agg(F.count("*").alias("n_events"), F.count("linked").alias("n_linked"))
    percent = F.when(F.col("n_events") > 0, F.col("n_linked") * 100.0 / F.col("n_events")).otherwise(0.0)
    return out.withColumn("percent", F.round(percent, 4)).withColumn("passed", percent >= wanted)


def populated(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per column: values that are neither null nor blank, and their share."""
    one = rows.agg(F.count("*").alias("total"), *[F.count_if(F.trim(F.col(c).cast("string")) != "").alias(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in columns])
    return one.select("total", F.explode(cells).alias("c")).select("c.column_name", "c.n", F.when(F.col("total") > 0, F.round(F.col("c.n") * 100.0 / F.col("total"), 4)).otherwise(0.0).alias("percent"))


def watch_list(entities: DataFrame, names: Sequence[str]) -> DataFrame:
    """Found or missing, and how often, for each wanted name (case aside)."""
    wanted = entities.sparkSession.createDataFrame([(n,) for n in names], "wanted string")
    counts = entities.groupBy(F.lower("entity_name").alias("_k")).agg(F.count("*").alias("n"))
    return wanted.join(counts, F.lower("wanted") == F.col("_k"), "left").select("wanted", F.col("n").isNotNull().alias("found"), F.coalesce("n", F.lit(0)).alias("n_entities"))


def domain_export(events: DataFrame, links: DataFrame, entities: DataFrame, canonical: DataFrame, domain: str) -> DataFrame:
    """Canonical entities of a domain with variants, summed event counts, papers and names.

    The events of two names of one canonical entity are added up, so an event
    under both counts twice.  ``canonical``: entity_type, entity_name,
    canonical_name.  Events and papers are counted distinct, never collected;
    lists are made of an entity's distinct names and variants only.
    """
    names = entities.select("entity_id", "entity_type", "entity_name", "entity_variant").join(canonical, ["entity_type", "entity_name"], "left").withColumn("canonical_name", F.coalesce("canonical_name", "entity_name"))
    rows = links.join(events.where(F.col("research_domain") == domain).select("event_id", "source_id"), "event_id").join(names, "entity_id")
    keys = ["entity_type", "canonical_name"]
    events_of = rows.groupBy(*keys, "entity_name").agg(F.count_distinct("event_id").alias("n")).groupBy(*keys).agg(F.sum("n").alias("event_count"), F.array_sort(F.collect_set("entity_name")).alias("names"))
    papers_of = rows.groupBy(*keys).agg(F.count_distinct("source_id").alias("n_papers"))
    variants = rows.where(F.trim("entity_variant") != "").groupBy(*keys).agg(F.array_sort(F.collect_set(F.trim("entity_variant"))).alias("variants"))
    out = events_of.join(papers_of, keys).join(variants, keys, "left")
    return out.select(F.col("canonical_name").alias("entity_name"), "entity_type", F.coalesce(F.array_join("variants", ","), F.lit("")).alias("entity_variant"), "event_count", "n_papers", F.array_join("names", "|").alias("original_names"))


def entity_papers(links: DataFrame, events: DataFrame) -> DataFrame:
    """(entity_id, source_id, n_events): the papers of each entity, a row each, so that an entity of any size fits."""
    return links.join(events.select("event_id", "source_id").where("source_id is not null"), "event_id").groupBy("entity_id", "source_id").agg(F.count_distinct("event_id").alias("n_events"))


def sample_by(rows: DataFrame, column: str, values: Sequence[str], n: int, *order: str) -> DataFrame:
    """The first n rows of each value: one limited sort per value, so no value's rows are in one place."""
    out = None
    for v in values:
        part = rows.where(F.col(column) == v).orderBy(*order).limit(n)
        out = part if out is None else out.unionByName(part)
    return rows.limit(0) if out is None else out


def duplicate_terms(lists: DataFrame) -> DataFrame:
    """Terms (case aside) that stand in more than one category.  ``lists``: category, term."""
    rows = lists.where(F.trim("term") != "").groupBy(F.lower(F.trim("term")).alias("term")).agg(F.array_sort(F.collect_set("category")).alias("categories"))
    return rows.where(F.size("categories") > 1)


def short_terms(lists: DataFrame, most: int = 3, safe: Sequence[str] = ()) -> DataFrame:
    """Terms of up to ``most`` characters without a joining mark, safe ones left out."""
    rows = lists.where((F.length(F.trim("term")) <= most) & (F.trim("term") != "") & ~F.col("term").rlike(r"[-/_.]"))
    return rows.where(~F.upper("term").isin(*[s.upper() for s in safe])) if safe else rows


def seed_issues(lists: DataFrame, safe: Sequence[str] = ()) -> DataFrame:
    """(issue, category, term, detail) of all checks of term lists (category, term).

    problematic: a known ambiguous abbreviation; short: up to three characters;
    common: a word that stands in any text; duplicate: a term of several categories.
    """
    rows = lists.where(F.trim("term") != "").select("category", F.trim("term").alias("term")).distinct()
    known = F.create_map(*[x for k, v in P.PROBLEMATIC_TERMS.items() for x in (F.lit(k), F.lit(v))])
    problematic = rows.withColumn("detail", F.try_element_at(known, F.upper("term"))).where("detail is not null").select(F.lit("problematic").alias("issue"), "category", "term", "detail")
    short = short_terms(rows, safe=safe).select(F.lit("short").alias("issue"), "category", "term", F.length("term").cast("string").alias("detail"))
    common = rows.where(F.lower("term").isin(*P.COMMON_TERMS)).select(F.lit("common").alias("issue"), "category", "term", F.lit(None).cast("string").alias("detail"))
    again = duplicate_terms(rows).select(F.lit("duplicate").alias("issue"), F.lit(None).cast("string").alias("category"), "term", F.array_join("categories", ", ").alias("detail"))
    return problematic.unionByName(short).unionByName(common).unionByName(again)


def role_counts(entities: Column) -> Column:
    """struct(n_primary, n_context, primary, context, all) of a 'type:name; …' string.

    An entity is primary by its type, but a process word that is called an assay
    is context.  Parts without a colon are left out; a null string has none.
    """
    parts = F.filter(F.transform(F.split(F.coalesce(entities, F.lit("")), r"\s*;\s*"), lambda x: F.trim(x)), lambda x: F.contains(x, F.lit(":")))
    kind = lambda x: F.substring_index(x, ":", 1)
    name = lambda x: F.lower(F.trim(F.substr(x, F.length(kind(x)) + 2)))
    primary = lambda x: F.lower(F.trim(kind(x))).isin(*P.PRIMARY_TYPES) & ~((kind(x) == "assay") & name(x).isin(*P.PROCESS_WORDS))
    bound = F.array(F.struct(F.filter(parts, primary).alias("p"), F.filter(parts, lambda x: ~primary(x)).alias("c"), parts.alias("a")))
    joined = lambda x: F.array_join(x, "; ")
    made = F.transform(bound, lambda b: F.struct(F.size(b["p"]).alias("n_primary"), F.size(b["c"]).alias("n_context"), joined(b["p"]).alias("primary"), joined(b["c"]).alias("context"), joined(b["a"]).alias("all")))
    return F.get(made, F.lit(0))


def hours_since(run: Column, now: Column) -> Column:
    """Hours from a run's ISO-8601 time (UTC without a zone) to now; more than 1 means that a newer export should be there."""
    return (F.unix_micros(now) - F.unix_micros(iso_timestamp(run))) / F.lit(3_600_000_000.0)


def entity_quality(found: DataFrame, key: str) -> DataFrame:
    """Quality of the entities found per key: mean confidence, share of confident ones, variety of types.

    ``found``: key, entity_type, confidence (its hundredths count, so that the mean
    is the same in whatever order rows are added).  Score: at most 100.
    """
    rows = found.groupBy(key).agg(F.count("*").alias("n"), (F.sum(F.round(F.col("confidence") * 100).cast("bigint")) / (F.count("confidence") * 100.0)).alias("mean"), (F.count_if(F.col("confidence") >= 0.8) / F.count("*")).alias("sure"), F.count_distinct("entity_type").alias("types"))
    variety = F.col("types") / F.col("n")
    score = F.least(F.lit(100.0), F.col("mean") * 50 + F.col("sure") * 30 + variety * 20)
    issues = F.array_compact(F.array(F.when(F.col("mean") < 0.6, "low confidence"), F.when(F.col("sure") < 0.3, "few confident entities"), F.when(variety < 0.2, "few types")))
    return rows.select(key, "n", F.round("mean", 4).alias("mean_confidence"), F.round("sure", 4).alias("confident_share"), F.round(score, 4).alias("quality_score"), F.array_join(issues, "; ").alias("issues"))
