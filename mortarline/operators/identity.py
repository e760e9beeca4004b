"""Which existing source an incoming one is: by DOI, by title, or by a near title and a common author."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mortarline.functions.phrases import DOI_PREFIXES

RATIO = 0.97
PREFIX, LENGTH_GAP = 12, 20


def collapsed(c: Column) -> Column:
    """Lower case, outer white space cut, inner white space one space; '' for null."""
    return F.coalesce(F.trim(F.regexp_replace(F.lower(c), r"\s+", " ")), F.lit(""))


def normalized_doi(c: Column) -> Column:
    """Without the first known prefix, outer slashes and spaces."""
    s = collapsed(c)
    cut = F.coalesce(*[F.when(s.startswith(p), F.substring(s, len(p) + 1, 10_000)) for p in DOI_PREFIXES], s)
    return F.regexp_replace(cut, r"^[/ ]+|[/ ]+$", "")


def cleaned_doi(c: Column) -> Column:
    """Trailing punctuation and a trailing '(…)' removed."""
    return F.regexp_replace(F.regexp_replace(c, r"[.,;:]+$", ""), r"\([^)]*\)$", "")


def doi_in(c: Column) -> Column:
    """The first DOI in a text or address, null if there is none."""
    found = F.regexp_extract(c, r"10\.\d{4,9}/[-._;()/:A-Za-z0-9<>%+,]+", 0)
    return F.nullif(F.regexp_replace(found, r"[.,;:]+$", ""), F.lit(""))


def author_set(c: Column) -> Column:
    parts = F.split(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit(" and "), F.lit(",")), F.lit(" & "), F.lit(",")), ",")
    return F.array_distinct(F.filter(F.transform(parts, lambda x: F.lower(F.trim(x))), lambda x: x != ""))


@F.pandas_udf(T.DoubleType())
def matching_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of characters in matching blocks, for the few pairs that the filters before it leave."""
    return pd.Series([SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)])


def _near_titles(rows: DataFrame, known: DataFrame, earlier: bool) -> DataFrame:
    """(source_id, by_fuzzy): the known source whose title is nearly the same and that has an author in common.

    Pairs meet by the title's first characters, its length band and an author, so
    a beginning that many titles share is split by their authors.  A ratio of
    RATIO leaves no more than 1 - RATIO of all characters unmatched, and so many
    edits at most; what has more is dropped before the ratio is taken.
    """
    block = F.substring("title_n", 1, PREFIX)
    # the length gap is part of the key: a row meets only the length bands next to its own
    band = F.floor(F.length("title_n") / (LENGTH_GAP + 1))
    left = rows.where("title_n <> ''").select("source_id", "title_n", F.explode("author_set").alias("author"), block.alias("block"), band.alias("_band")).withColumn("band", F.explode(F.array(F.col("_band") - 1, F.col("_band"), F.col("_band") + 1))).drop("_band")
    right = known.where("title_n <> ''").select("known_id", F.col("title_n").alias("known_title"), F.explode("author_set").alias("author"), block.alias("block"), band.alias("band"))
    met = left.join(right, ["block", "band", "author"]).where(F.col("known_id") < F.col("source_id") if earlier else F.col("known_id") != F.col("source_id"))
    both = F.length("title_n") + F.length("known_title")
    close = (F.abs(F.length("title_n") - F.length("known_title")) <= LENGTH_GAP) & (F.levenshtein("title_n", "known_title") <= (1 - RATIO) * both)
    near = met.where(close).select("source_id", "title_n", "known_id", "known_title").distinct().where(matching_ratio("title_n", "known_title") >= RATIO)
    return near.groupBy("source_id").agg(F.min_by("known_id", F.struct(F.abs(F.length("title_n") - F.length("known_title")), F.col("known_id"))).alias("by_fuzzy"))


def _identified(sources: DataFrame, id_name: str) -> DataFrame:
    return sources.select(F.col("source_id").alias(id_name), normalized_doi(F.col("doi")).alias("doi_n"), collapsed(F.col("title")).alias("title_n"), author_set(F.col("authors")).alias("author_set"))


def resolve_sources(existing: DataFrame, incoming: DataFrame, fuzzy: bool = True, earlier: bool = False) -> DataFrame:
    """(source_id, resolved_id, matched_by) for every incoming source.

    First an equal DOI, then an equal title, then a title with the same first
    characters, about the same length, a matching ratio of at least RATIO and a
    common author; the smallest source_id wins a tie.  matched_by is doi, title,
    fuzzy or new.  With ``earlier`` only known sources of a smaller id count.
    """
    known, rows = _identified(existing, "known_id"), _identified(incoming, "source_id")
    dois = known.where("doi_n <> ''").groupBy("doi_n").agg(F.min("known_id").alias("by_doi"))
    titles = known.where("title_n <> ''").groupBy("title_n").agg(F.min("known_id").alias("by_title"))
    rows = rows.join(dois, "doi_n", "left").join(titles, "title_n", "left")
    if earlier:
        rows = rows.withColumns({c: F.when(F.col(c) < F.col("source_id"), F.col(c)) for c in ("by_doi", "by_title")})
    if fuzzy:
        rows = rows.join(_near_titles(rows.where("by_doi is null and by_title is null"), known, earlier), "source_id", "left")
    else:
        rows = rows.withColumn("by_fuzzy", F.lit(None).cast("string"))
    how = F.when(F.col("by_doi").isNotNull(), "doi").when(F.col("by_title").isNotNull(), "title").when(F.col("by_fuzzy").isNotNull(), "fuzzy").otherwise("new")
    return rows.select("source_id", F.coalesce("by_doi", "by_title", "by_fuzzy", "source_id").alias("resolved_id"), how.alias("matched_by"))


def resolve_all(sources: DataFrame, fuzzy: bool = True) -> DataFrame:
    """resolve_sources for a whole table: every source against all of smaller ids, as if they had come in that order."""
    return resolve_sources(sources, sources, fuzzy, earlier=True)


def source_rows(incoming: DataFrame) -> DataFrame:
    """Incoming source records as rows of the sources table.

    A list of authors becomes text joined by ', '; a year of digits a number; a
    missing publication_date is the year; a missing venue the journal.
    """
    kinds = {f.name: f.dataType.simpleString() for f in incoming.schema.fields}
    rows = incoming
    if kinds.get("authors", "").startswith("array"):
        rows = rows.withColumn("authors", F.array_join("authors", ", "))
    if "year" in kinds:
        rows = rows.withColumn("year", F.when(F.trim(F.col("year").cast("string")).rlike(r"^\d+$"), F.trim(F.col("year").cast("string")).try_cast("int")))
        rows = rows.withColumn("publication_date", F.coalesce(F.nullif(F.trim(F.col("publication_date")), F.lit("")) if "publication_date" in kinds else F.lit(None).cast("string"), F.col("year").cast("string")))
    if "journal" in kinds:
        rows = rows.withColumn("venue", F.coalesce(F.nullif(F.trim(F.col("venue")), F.lit("")) if "venue" in kinds else F.lit(None).cast("string"), F.col("journal"))).drop("journal")
    return rows
