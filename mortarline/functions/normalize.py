"""Unicode-aware column functions that stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nfkc(c: Column) -> Column:
    """Unicode compatibility composition (NFKC).

    Pure-ASCII values are returned as they are; the others go through the
    ICU library that ships with Spark, and a Spark without it is an error.  Null
    stays null.
    """
    composed = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))
    return F.when(c.rlike(r"[^\x00-\x7F]"), composed).otherwise(c)


def fold_case(c: Column) -> Column:
    """Case folding: capitals first, so that all cases of a letter agree; sharp s is ss."""
    return F.replace(F.lower(F.upper(c)), F.lit("ß"), F.lit("ss"))


def alnum_key(c: Column) -> Column:
    """Letters and digits of a value in order, case and compatibility form aside."""
    return F.regexp_replace(fold_case(nfkc(c)), r"[^\p{L}\p{N}]+", "")


def iso_timestamp(c: Column) -> Column:
    """ISO-8601 text in extended or basic notation as a timestamp.

    A value without zone is UTC whatever the session's time zone is.
    Null and unreadable values give null.
    """
    s = F.upper(F.trim(c))
    s = F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})(?=$|[T ])", "$1-$2-$3")
    s = F.regexp_replace(s, r"^(\d{4}-\d{2}-\d{2}[T ]\d{2})(\d{2})(\d{2})?(?=$|[.,Z+-])", "$1:$2:$3")
    s = F.regexp_replace(s, r":(?=$|[Z+-])", "")
    s = F.regexp_replace(s, r"(\d),(\d)", "$1.$2")
    s = F.regexp_replace(s, r"([T ][\d:.]+) ?([+-]\d{2}):?(\d{2})?$", "$1$2:$3")
    s = F.regexp_replace(s, r":$", ":00")
    s = F.when(s.rlike(r"^\d{4}-\d{2}-\d{2}"), s)
    zoned = F.when(s.rlike(r"[T ].*(Z|[+-]\d{2}:\d{2})$"), s).when(s.rlike("[T ]"), F.concat(s, F.lit("Z"))).otherwise(F.concat(s, F.lit("T00:00:00Z")))
    return zoned.try_cast("timestamp")


def iso_text(c: Column) -> Column:
    """A timestamp as ISO-8601 text in UTC to the second, with Z."""
    return F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def snake(c: Column) -> Column:
    """Lower case, trimmed, one underscore between words; a slash is kept."""
    s = F.lower(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")))
    s = F.regexp_replace(s, r"[\s\-_]+", "_")
    return F.regexp_replace(s, r"_*/_*", "/")


def exploded(rows: DataFrame, array: Column, name: str, *keep: str) -> DataFrame:
    """``keep`` with one row per element of an array that is not null.

    From a plain explode Spark infers a filter on the array and pushes it below,
    so that a costly array is made again for the filter, with all it is made of
    written out.  An outer explode has no such filter.
    """
    return rows.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())
