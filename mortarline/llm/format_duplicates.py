"""Records that differ only in how they are written (problem 2).

Every normalized (field, value part) pair is hashed, and the hashes of a record
are added up modulo 2^62 with two seeds: a multiset hash, for which the order of
the parts does not matter.  Records with one fingerprint are held against the
group's first record by counting parts, without sorting; the ones that differ
(a collision) are held against the first of what is left, until none is.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortarline.functions.normalize import fold_case, nfkc
from mortarline.plans.session import stored

MODULUS_BITS = 62


def squeezed(c: Column) -> Column:
    """One part: the value's letters, digits and symbols without white space and punctuation."""
    return F.array_compact(F.array(F.nullif(F.regexp_replace(fold_case(nfkc(c)), r"[^\p{L}\p{M}\p{N}\p{S}]+", ""), F.lit(""))))


def doi_part(c: Column) -> Column:
    """One part: the DOI without a label or resolver address in front of it."""
    return squeezed(F.regexp_replace(fold_case(nfkc(c)), r"^\s*(?:(?:https?://)?(?:dx\.)?doi\.org/|doi\b)[\s:.]*", ""))


def name_parts(c: Column) -> Column:
    """The words of an author list, whatever order and separators they stand in.

    A word "and" is a separator.
    """
    words = F.split(F.regexp_replace(fold_case(nfkc(c)), r"[^\p{L}\p{M}\p{N}]+", " "), " ")
    return F.filter(words, lambda w: (w != "") & (w != "and"))


RECORD_FIELDS: Mapping[str, tuple[str, object]] = {"title": ("title", squeezed), "doi": ("doi", doi_part), "authors": ("authors", name_parts)}


def _same_multiset(a: Column, b: Column) -> Column:
    count = lambda parts, x: F.size(F.filter(parts, lambda y: y == x))
    return (F.size(a) == F.size(b)) & F.forall(F.array_distinct(a), lambda x: count(a, x) == count(b, x))


def _pairs(field: str) -> Column:
    return F.transform(F.col(f"_{field}"), lambda p: F.struct(F.lit(field).alias("field"), p.alias("part")))


def _fingerprint(parts: Column, seed: int) -> Column:
    mask = F.lit((1 << MODULUS_BITS) - 1)
    return F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, p: (acc + F.xxhash64(F.lit(seed), p["field"], p["part"]).bitwiseAND(mask)).bitwiseAND(mask))


#: Fingerprints that hold at least this part of the rows are verified apart; there are at most so many of them.
HOT_PARTS = 1000


def _verified(members: DataFrame, names: list[str], few: bool) -> DataFrame:
    """Members of fingerprints of several rows, with ``same``: whether they agree with the group's first row."""
    firsts = members.where(F.col("_row") == F.col("first_row")).select("f1", "f2", F.struct(*names).alias("first"))
    checked = members.join(F.broadcast(firsts) if few else firsts, ["f1", "f2"])
    same = F.lit(True)
    for n in names:
        same = same & _same_multiset(F.col(n), F.col(f"first.{n}"))
    return checked.select("_key", "_row", *names, "f1", "f2", "first_id", same.alias("same"))


def _one_round(rows: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame]:
    """((first_id, _key) of the rows that agree with their fingerprint's first row, the other rows)."""
    groups = rows.groupBy("f1", "f2").agg(F.min(F.struct("_key", "_row")).alias("m"), F.count("*").alias("n"))
    groups = stored(groups.select("f1", "f2", "n", F.col("m._key").alias("first_id"), F.col("m._row").alias("first_row")))
    alone = groups.where("n = 1").select("first_id", F.col("first_id").alias("_key"))
    again = groups.where("n > 1")
    hot = again.where(F.col("n") * HOT_PARTS >= groups.agg(F.sum("n")).scalar()).select("f1", "f2", "first_id", "first_row")
    # at most HOT_PARTS fingerprints are hot: their rows stay where they are, the others are small enough to meet in one place
    in_hot = rows.join(F.broadcast(hot), ["f1", "f2"])
    cold = rows.join(F.broadcast(hot.select("f1", "f2")), ["f1", "f2"], "left_anti").join(again.select("f1", "f2", "first_id", "first_row"), ["f1", "f2"])
    checked = stored(_verified(cold, names, few=False).unionByName(_verified(in_hot, names, few=True)))
    agreed = alone.unionByName(checked.where("same").select("first_id", "_key"))
    return agreed, checked.where("not same").select("_key", "_row", *names, "f1", "f2")


def duplicate_members(records: DataFrame, key: str, fields: Mapping[str, tuple[str, object]] = RECORD_FIELDS) -> DataFrame:
    """(first_id, key): every record with the smallest key of its copies.

    A missing or blank value has no parts, so it agrees with another missing one
    and with no other.  Rows without ``key`` are dropped; rows that repeat a key
    count as one copy.  A record without copies is its own first.
    """
    rows = records.where(F.col(key).isNotNull())
    for name, (column, parts) in fields.items():
        rows = rows.withColumn(f"_{name}", F.coalesce(parts(F.col(column)), F.array().cast("array<string>")))
    names = [f"_{name}" for name in fields]
    pairs = F.concat(*[_pairs(name) for name in fields])
    rows = stored(rows.select(F.col(key).alias("_key"), *names, _fingerprint(pairs, 1).alias("f1"), _fingerprint(pairs, 2).alias("f2"), F.monotonically_increasing_id().alias("_row")))
    found, rest = _one_round(rows, names)
    # a round settles one record of each fingerprint; more than one is needed only where 124 bits of hash collide
    while not rest.isEmpty():
        agreed, rest = _one_round(stored(rest), names)
        found = found.unionByName(agreed)
    return found.distinct().withColumnRenamed("_key", key)


def collapsed_records(records: DataFrame, key: str, fields: Mapping[str, tuple[str, object]] = RECORD_FIELDS) -> DataFrame:
    """Each record once, in the writing of its smallest key, with n_copies.

    Of rows that repeat a key the one whose values come first is shown.  A column
    n_copies of the records is replaced.
    """
    records = records.drop("n_copies")
    sizes = duplicate_members(records, key, fields).groupBy(F.col("first_id").alias("_first")).agg(F.count("*").alias("n_copies"))
    rest = [c for c in records.columns if c != key]
    firsts = records.join(sizes, F.col(key) == F.col("_first")).groupBy(key, "n_copies").agg(F.min_by(F.struct(*rest), F.to_json(F.struct(*rest))).alias("_r"))
    return firsts.select(key, *[F.col(f"_r.{c}").alias(c) for c in rest], "n_copies").select(*records.columns, "n_copies")


def copies_found(records: DataFrame, key: str = "source_id") -> DataFrame:
    """(first_source_id, source_id): every copy but the first."""
    return duplicate_members(records, key).where(F.col("first_id") != F.col(key)).select(F.col("first_id").alias("first_source_id"), key)
