"""Exports: CSV and JSON files, replaced as a whole, and the text report."""

from __future__ import annotations

import os
import shutil
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortarline.functions import phrases as P


def fixed(c: Column, digits: int = 2, signed: bool = False) -> Column:
    """A number as text with so many digits."""
    return F.format_string(f"%{'+' if signed else ''}.{digits}f", c.cast("double"))


def entities_csv(scored: DataFrame, overlays: list[str]) -> DataFrame:
    """Entities with score and bucket per overlay as an export shows them; 'N/A' without a bucket."""
    return scored.select("entity_name", "entity_type", F.col("n_events").alias("event_count"), *[x for o in overlays for x in (fixed(F.col(f"{o}_score")).alias(f"{o}_score"), F.coalesce(f"{o}_bucket", F.lit("N/A")).alias(f"{o}_bucket"))])


def events_csv(events: DataFrame, scores: DataFrame, overlays: list[str]) -> DataFrame:
    """Events with a snippet of 200 characters and signed scores (0 without one)."""
    snippet = F.when(F.length("evidence_snippet") > 200, F.concat(F.substring("evidence_snippet", 1, 200), F.lit("..."))).otherwise(F.col("evidence_snippet"))
    rows = events.join(scores, "event_id", "left")
    return rows.select("event_id", "event_type", "stage", F.col("confidence").alias("confidence_original"), snippet.alias("evidence_snippet"), *[fixed(F.coalesce(F.col(o), F.lit(0.0)), 1, signed=True).alias(f"{o}_score") for o in overlays])


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files with header, written by all tasks and put in place when complete."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_one_file(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """A small export as one file, replaced in one step; for local paths."""
    tmp = f"{path}.{uuid.uuid4().hex}"
    try:
        out = os.path.join(tmp, "out")
        writer = df.coalesce(1).write.mode("overwrite")
        (writer.option("header", True).option("escape", '"').csv(out) if fmt == "csv" else writer.json(out))
        part = next(Path(out).glob("part-*"))
        os.replace(part, path)
    finally:
        shutil.rmtree(tmp, ignore_errors=True)


def run_summary(events: DataFrame, links: DataFrame, entities: DataFrame, n: int = 20) -> DataFrame:
    """One row of JSON: counts, confidence distribution, the n most linked entities, generic words among assays."""
    conf = events.agg(F.count("*").alias("n_events"), *[F.count_if(F.col("confidence") == c).alias(c) for c in ("high", "med", "low")])
    linked = links.groupBy("entity_id").agg(F.count("*").alias("n")).join(entities.select("entity_id", "entity_name", "entity_type"), "entity_id")
    best = linked.orderBy(F.desc("n"), "entity_id").limit(n).agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("order"), "entity_name", "n"))).alias("top_entities"))
    demoted = entities.where((F.col("entity_type") == "assay") & F.lower("entity_name").isin(*P.PROCESS_WORDS)).agg(F.count("*").alias("n_demoted"))
    row = conf.withColumn("n_entities", entities.agg(F.count("*")).scalar()).withColumn("n_demoted", demoted.scalar()).withColumn("top_entities", best.scalar())
    return row.select(F.to_json(F.struct("*")).alias("run_meta"))


def text_report(scored: DataFrame, overlays: list[str], n: int = 20) -> str:
    """Header, the n best entities and the bucket shares of each overlay, as text."""
    from mortarline.operators.overlays import bucket_distribution, overlay_top

    lines = [f"entities: {scored.count()}"]
    for o in overlays:
        lines += ["", f"TOP {n} - {o}"]
        lines += [f"{r['rank']:>3}. {r['entity_name']} ({r['entity_type']}) {r[f'{o}_score']:.2f} {r[f'{o}_bucket']}" for r in overlay_top(scored, o, n).orderBy("rank").collect()]
        lines += ["", *[f"{r['bucket']:<14} {r['n']:>6} {r['percent']:>6.1f}%" for r in bucket_distribution(scored, o).orderBy("position").collect()]]
    return "\n".join(lines) + "\n"
