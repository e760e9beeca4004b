"""The queries of this subpackage's operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.llm.canonical import map_values
from mortarline.llm.cooccurrence import associations
from mortarline.llm.format_duplicates import collapsed_records, copies_found
from mortarline.llm.leakage import find_leaks
from mortarline.llm.mixing import LARGEST, balance, mix, token_counts
from mortarline.llm.repeated_lines import cleaned_pages, repeated_lines
from mortarline.llm.scan_repair import found_noise, repaired_paragraphs
from mortarline.llm.sentences import split_sentences
from mortarline.llm.splitting import split_items, split_oversized
from mortarline.plans.session import stored, table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return repeated_lines(table(spark, d, "chunks"), table(spark, d, "sources")).select("chunk_id", "line_no")


def p1_clean_chunks(spark: SparkSession, d: str) -> DataFrame:
    return cleaned_pages(table(spark, d, "chunks"), table(spark, d, "sources")).select("chunk_id", "clean_text", "n_removed")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return copies_found(table(spark, d, "sources"))


def p2_collapsed(spark: SparkSession, d: str) -> DataFrame:
    return collapsed_records(table(spark, d, "sources"), "source_id").select("source_id", "title", "authors", "doi", "n_copies")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return associations(table(spark, d, "event_entities"), min_count=10, min_lift=3.0).select("entity_a", "entity_b")


def p3_pairs(spark: SparkSession, d: str) -> DataFrame:
    """All pairs of a support of five, with their lift."""
    pairs = associations(table(spark, d, "event_entities"), min_count=5)
    return pairs.select("entity_a", "entity_b", "n_ab", F.round("lift", 6).alias("lift"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """The entities of the types that the list holds."""
    names, listed = table(spark, d, "entities"), table(spark, d, "construction_science_aliases")
    return map_values(names.join(listed.select("entity_type").distinct(), "entity_type", "left_semi"), listed).select("entity_id", "canonical_id")


def p4_matches(spark: SparkSession, d: str) -> DataFrame:
    """Every entity with all rows within reach and their distances."""
    mapped = map_values(table(spark, d, "entities"), table(spark, d, "construction_science_aliases"))
    return mapped.select("entity_id", F.posexplode("matches").alias("position", "m")).select("entity_id", (F.col("position") + 1).alias("position"), "m.canonical_id", "m.distance")


def p4_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The names that match no row, those of types that the list does not hold among them."""
    mapped = map_values(table(spark, d, "entities"), table(spark, d, "construction_science_aliases")).where("canonical_id = 0")
    return mapped.groupBy("entity_type", "entity_name").agg(F.count("*").alias("n_entities"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return split_oversized(table(spark, d, "chunks")).where("piece_no = 1").select("chunk_id", "boundary")


def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    return split_items(table(spark, d, "chunks"))


def p5_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Per page, what its pieces say of the whole: its length, whether each starts within the one before, how long they are."""
    pieces = split_items(table(spark, d, "chunks")).where("piece is not null")
    ends = pieces.groupBy("chunk_id").agg(F.max("end_pos").alias("n_chars"), F.max(F.length("piece")).alias("longest"), F.sum(F.length("piece")).alias("total"), F.sum(F.col("end_pos") - F.col("start_pos")).alias("spans"), F.count("*").alias("n"), F.max("n_pieces").alias("n_pieces"))
    late = pieces.select("chunk_id", (F.col("piece_no") + 1).alias("piece_no"), F.col("end_pos").alias("before")).join(pieces.select("chunk_id", "piece_no", "start_pos"), ["chunk_id", "piece_no"])
    gaps = late.groupBy("chunk_id").agg(F.max(F.col("before") - F.col("start_pos")).alias("widest"), F.min(F.col("before") - F.col("start_pos")).alias("narrowest"))
    rows = ends.join(gaps, "chunk_id", "left")
    sound = (F.col("longest") <= 2000) & (F.col("total") == F.col("spans")) & (F.col("n") == F.col("n_pieces")) & F.coalesce((F.col("narrowest") >= 0) & (F.col("widest") <= 200), F.lit(True))
    return rows.select("chunk_id", "n_chars", sound.alias("sound"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return found_noise(table(spark, d, "chunks"), table(spark, d, "sources"))


def p6_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return repaired_paragraphs(table(spark, d, "chunks"), table(spark, d, "sources"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).where("verbatim").select("doc_id", "item_id").distinct()


def p8_leaked_items(spark: SparkSession, d: str) -> DataFrame:
    found = find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))
    return found.groupBy("item_id").agg(F.count_distinct("doc_id").alias("n_docs"), F.max("n_windows").alias("most_windows"), F.max("similarity").alias("similarity"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    report, _ = balance(table(spark, d, "documents"), table(spark, d, "mix_targets"), "n_chars")
    return report.where("not feasible").select("source")


def _mixed(spark: SparkSession, d: str, total: str | None) -> tuple[DataFrame, DataFrame]:
    """Mix and report in tokens, which are counted once."""
    counted = token_counts(table(spark, d, "documents").select("doc_id", "source", "text"))
    sized = stored(counted.select("doc_id", "source", "n_tokens"))
    return mix(sized, table(spark, d, "mix_targets"), "n_tokens", total)


def p9_goals(spark: SparkSession, d: str) -> DataFrame:
    """Goals of the largest mix that keeps the shares, in characters."""
    report, _ = balance(table(spark, d, "documents"), table(spark, d, "mix_targets"), "n_chars", LARGEST)
    return report.select("source", "n_docs", F.round("own_size", 3).alias("own_size"), F.round("goal", 3).alias("goal"), F.round("expected", 3).alias("expected"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """The largest mix in which every source that has documents keeps its share."""
    return _mixed(spark, d, LARGEST)[0].select("doc_id", "source", "n_tokens", "copies")


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d, LARGEST)[1]


def p9_full_mix(spark: SparkSession, d: str) -> DataFrame:
    """The mix as large as all documents, in which some sources cannot reach their share."""
    return _mixed(spark, d, None)[0].select("doc_id", "source", "n_tokens", "copies")


def p9_full_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d, None)[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return split_sentences(table(spark, d, "documents")).select("doc_id", "start_pos")


def p10_sentences(spark: SparkSession, d: str) -> DataFrame:
    return split_sentences(table(spark, d, "documents"))


def p10_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Per document the letters and digits of its sentences, and that they stand in order."""
    rows = split_sentences(table(spark, d, "documents"))
    late = rows.select("doc_id", (F.col("sentence_no") + 1).alias("sentence_no"), F.col("end_pos").alias("before")).join(rows.select("doc_id", "sentence_no", "start_pos"), ["doc_id", "sentence_no"])
    wrong = late.where("start_pos < before").groupBy("doc_id").agg(F.count("*").alias("wrong"))
    sums = rows.groupBy("doc_id").agg(F.sum(F.length(F.regexp_replace("sentence", r"[^\p{L}\p{N}]", ""))).alias("n_letters"))
    return sums.join(wrong, "doc_id", "left").select("doc_id", "n_letters", F.col("wrong").isNull().alias("in_order"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        p1_found, p1_clean_chunks, p2_found, p2_collapsed, p3_found, p3_pairs, p4_found, p4_matches, p4_unmatched, p5_found, p5_pieces, p5_coverage,
        p6_found, p6_paragraphs, p8_found, p8_leaked_items, p9_found, p9_goals, p9_mix, p9_shares, p9_full_mix, p9_full_shares, p10_found, p10_sentences, p10_coverage,
    )
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
