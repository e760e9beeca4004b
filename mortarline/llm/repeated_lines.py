"""Lines repeated across one source's documents (problem 1).

Each spelling of a line gets, per source, the set of documents it stands in as a
bitmap in containers of 32,768 consecutive document numbers; the containers
travel compressed, so that a sparse one is short.  The bitmaps of the spellings
of one line are united, their exact cardinalities are held against the
threshold, and a line is deleted from a document when its bit is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortarline.functions.normalize import fold_case, nfkc
from mortarline.plans.session import stored

#: Hash buckets per venue in which lines are counted before any bitmap is built.
BUCKETS = 4096
_LINES = "array<struct<k:bigint,spelling:int,line_no:int>>"


def _has(bits: Column, position: Column) -> Column:
    """Whether a position's bit is set in a container."""
    at = position.cast("int")
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(at, 3) + 1, 1)), 16, 10).cast("int")
    return F.call_function("getbit", byte, at.bitwiseAND(F.lit(7))) == 1


def _line_keys(text: Column) -> Column:
    """A text in which only letters, digits and line breaks are left, case and compatibility form aside."""
    folded = F.when(text.rlike(r"[^\x00-\x7F]"), fold_case(nfkc(text))).otherwise(F.lower(text))
    return F.regexp_replace(folded, r"[^\p{L}\p{N}\n]+", "")


def venue_pages(pages: DataFrame, page_source: DataFrame) -> DataFrame:
    """chunk_id, doc_id, venue, lines: the pages of sources with a venue, written once.

    ``pages``: chunk_id, doc_id (a whole number), source_id, chunk_text.
    ``page_source``: source_id, venue.  ``lines`` holds, for each line with a
    letter, k (a 64-bit key of its letters and digits), a hash of its spelling and
    line_no from 1.  A collision of keys matters only with one of the few hundred
    lines that a venue repeats; of a billion lines, fewer than one in ten million
    such venues would have one.  Pages without source, of a source without venue
    or without doc_id are left out; a page without text has no lines.
    """
    venue = page_source.select("source_id", "venue").dropna().dropDuplicates(["source_id"])
    numbered = F.transform(F.split(_line_keys(F.col("chunk_text")), "\n"), lambda k, i: F.struct(k.alias("key"), (i + 1).cast("int").alias("line_no")))
    keyed = F.zip_with(numbered, F.split("chunk_text", "\n"), lambda x, line: F.struct(F.when(x["key"].rlike(r"\p{L}"), F.xxhash64(x["key"])).alias("k"), F.hash(line).alias("spelling"), x["line_no"].alias("line_no")))
    lettered = F.filter(keyed, lambda x: x["k"].isNotNull())
    rows = pages.where(F.col("doc_id").isNotNull()).select("chunk_id", "doc_id", "source_id", F.coalesce(lettered, F.array()).cast(_LINES).alias("lines"))
    return stored(rows.join(venue, "source_id").drop("source_id"))


def _exploded(paged: DataFrame, *keep: str) -> DataFrame:
    return paged.select(*keep, "venue", F.explode("lines").alias("l")).select(*keep, "venue", "l.*")


def excess_lines(paged: DataFrame, min_docs: int = 3, min_share: float = 0.2) -> DataFrame:
    """Lines of a venue that stand in at least ``min_docs`` and ``min_share`` of its documents.

    ``paged`` is the result of venue_pages.  One row per line and container:
    venue, k, container, bits, n (documents of the line over all containers).
    """
    # distinct documents first: a venue may hold a third of all rows
    needed = paged.select("venue", "doc_id").distinct().groupBy("venue").agg(F.count("*").alias("n_docs"))
    needed = needed.select("venue", F.greatest(F.lit(float(min_docs)), F.col("n_docs") * min_share).alias("needed"))
    # a line has at most as many documents as it has occurrences, and those are at most its bucket's: what
    # stays below the threshold is no repeated line, and no bitmap is built for it
    enough = lambda counts: counts.join(needed, "venue").where(F.col("n_lines") >= F.col("needed"))
    bucket = F.pmod("k", F.lit(BUCKETS)).cast("int")
    full = enough(_exploded(paged).groupBy("venue", bucket.alias("bucket")).agg(F.count("*").alias("n_lines"))).select("venue", "bucket")
    lines = _exploded(paged, "doc_id").withColumn("bucket", bucket).join(full, ["venue", "bucket"], "left_semi").drop("bucket")
    often = enough(lines.groupBy("venue", "k").agg(F.count("*").alias("n_lines"))).select("venue", "k")
    lines = lines.join(often, ["venue", "k"], "left_semi")
    container = F.bitmap_bucket_number(F.col("doc_id"))
    by_spelling = lines.groupBy("venue", "k", "spelling", container.alias("container")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("doc_id"))).alias("bits"))
    united = by_spelling.groupBy("venue", "k", "container").agg(F.bitmap_or_agg("bits").alias("bits"))
    total = united.groupBy("venue", "k").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    kept = total.join(needed, "venue").where(F.col("n") >= F.col("needed")).drop("needed")
    return united.join(kept, ["venue", "k"])


def repeated_lines(pages: DataFrame, page_source: DataFrame, min_docs: int = 3, min_share: float = 0.2) -> DataFrame:
    """(chunk_id, line_no, venue, n): lines repeated excessively in their venue.

    Ties count: a line in exactly ``min_share`` of the documents is repeated.
    An empty table gives no rows.
    """
    paged = venue_pages(pages, page_source)
    excess = stored(excess_lines(paged, min_docs, min_share))
    # only lines with the key of a repeated one meet the bitmaps: few keys, and AQE broadcasts what is small
    lines = _exploded(paged, "chunk_id", "doc_id").join(excess.select("venue", "k").distinct(), ["venue", "k"], "left_semi")
    hit = lines.withColumn("container", F.bitmap_bucket_number("doc_id")).join(excess, ["venue", "k", "container"])
    return hit.where(_has(F.col("bits"), F.bitmap_bit_position("doc_id"))).select("chunk_id", F.col("line_no").cast("bigint").alias("line_no"), "venue", "n")


def cleaned_pages(pages: DataFrame, page_source: DataFrame, min_docs: int = 3, min_share: float = 0.2) -> DataFrame:
    """All pages with clean_text, the text without its repeated lines, and n_removed.

    Null text stays null; a page without repeated lines keeps its text as it is.
    Columns of the pages with these two names are replaced.
    """
    found = repeated_lines(pages, page_source, min_docs, min_share)
    gone = found.groupBy("chunk_id").agg(F.collect_set("line_no").alias("_gone"))
    kept = F.filter(F.split("chunk_text", "\n"), lambda line, i: ~F.array_contains(F.col("_gone"), (i + 1).cast("bigint")))
    pages = pages.drop("clean_text", "n_removed")
    out = pages.join(gone, "chunk_id", "left")
    return out.select(*pages.columns, F.when(F.col("_gone").isNull(), F.col("chunk_text")).otherwise(F.array_join(kept, "\n")).alias("clean_text"), F.coalesce(F.size("_gone"), F.lit(0)).alias("n_removed"))
