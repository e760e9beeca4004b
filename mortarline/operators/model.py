"""Keys, first-writer and last-writer rules, and consistency of the fact tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMAS = {
    "sources": "source_id string, title string, authors string, year int, publication_date string, venue string, doi string, url string, domain string, pdf_file string, imported_at string, last_seen_at string",
    "documents": "doc_id string, source_id string, file_path string, file_type string, sha256 string, created_at string",
    "chunks": "chunk_id string, doc_id string, source_id string, page_number int, section_guess string, chunk_text string",
    "entities": "entity_id string, entity_type string, entity_name string, entity_variant string, organism string",
    "research_events": "event_id string, research_domain string, event_type string, stage string, system_context string, application_context string, outcome string, failure_reason string, decision_taken string, decision_driver string, evidence_snippet string, evidence_strength string, confidence string, source_id string, doc_id string, chunk_id string, page_number int, created_at string",
    "event_entities": "event_id string, entity_id string, role string",
    "event_tags": "event_id string, tag string",
    "quantitative_measurements": "measurement_id string, event_id string, measurement_type string, value string, unit string, context string",
    "entity_relationships": "relationship_id string, source_entity_id string, target_entity_id string, relationship_type string",
}


def empty_table(spark, name: str) -> DataFrame:  # noqa: ANN001
    return spark.createDataFrame([], T.StructType.fromDDL(SCHEMAS[name]))


def hashed_id(*parts: Column) -> Column:
    """SHA-256 of the parts joined by '|'; a null part counts as empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def short_id(*parts: Column) -> Column:
    return F.substring(hashed_id(*parts), 1, 16)


def document_id(sha256: Column, source: Column, path: Column) -> Column:
    """From the file's own hash where there is one, else from source and path."""
    return F.when(F.trim(F.coalesce(sha256, F.lit(""))) != "", F.sha2(sha256, 256)).otherwise(hashed_id(source, path))


def event_id(source: Column, doc: Column, page: Column, kind: Column, snippet: Column) -> Column:
    """The snippet's first 180 characters count."""
    return hashed_id(source, doc, page, kind, F.substring(snippet, 1, 180))


def run_key(kind: Column, names: Column, page: Column, snippet: Column) -> Column:
    """The key under which one run keeps an event once."""
    return F.concat_ws("|", kind, F.array_join(F.array_sort(names), "|"), page.cast("string"), F.sha2(snippet, 256))


def keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order (a total one, to be repeatable).

    One combining aggregate, so a key that holds a third of all rows is cut down
    before the shuffle.  Null keys form groups like others.
    """
    rest = [c for c in rows.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)) if rest else F.count("*")
    out = rows.groupBy(*keys).agg(first.alias("_r"))
    return out.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*rows.columns)


def keep_last(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    out = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return out.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*rows.columns)


def insert_or_ignore(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Existing rows stay; of the incoming ones the first of each new key is added."""
    new = keep_first(incoming, keys, order).join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(new.select(*existing.columns))


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last incoming row of each key replaces the existing one."""
    last = keep_last(incoming, keys, order).select(*existing.columns)
    return existing.join(last.select(*keys), list(keys), "left_anti").unionByName(last)


def checked_measurements(rows: DataFrame) -> DataFrame:
    """Measurements with a type, value and unit; any other row raises when it is read."""
    bad = F.col("measurement_type").isNull() | F.col("value").isNull() | F.col("unit").isNull()
    return rows.where(F.coalesce(F.when(bad, F.raise_error(F.lit("measurement without type, value or unit")).cast("boolean")), F.lit(True)))


def source_mismatches(chunks: DataFrame, documents: DataFrame) -> DataFrame:
    """Pages whose source is not their document's."""
    docs = documents.select("doc_id", F.col("source_id").alias("doc_source_id"))
    return chunks.join(docs, "doc_id").where(~F.col("source_id").eqNullSafe(F.col("doc_source_id"))).select("chunk_id", "doc_id", "source_id", "doc_source_id")


def orphans(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not null and has no parent."""
    return children.where(F.col(key).isNotNull()).join(parents.select(key).distinct(), key, "left_anti")


def cascade(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """The children that remain when those without a parent are removed."""
    return children.join(parents.select(key).distinct(), key, "left_semi")


def set_null(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """The children, with the key nulled where it has no parent."""
    known = parents.select(key).distinct().withColumn("_known", F.lit(True))
    return children.join(known, key, "left").withColumn(key, F.when(F.col("_known"), F.col(key))).select(*children.columns)


def renamed_context(events: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Older event tables with today's column names; only if all old and no new names are there."""
    names = names or {"study_stage": "stage", "biological_system": "system_context", "application_area": "application_context"}
    have = set(events.columns)
    return events.withColumnsRenamed(dict(names)) if set(names) <= have and not have & set(names.values()) else events
