"""Items that appear together (problem 3).

The distinct items of an ordinary basket are paired within its row.  A basket of
more than ``block`` items is cut into chunks of about that size by the item's
hash, and each pair of chunks becomes a row of its own, so that the products of
one huge basket spread over many tasks.  Pair counts are combined before they
are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 64
#: Baskets with at least this part of all links are not shuffled by their key.
HOT_PARTS = 1000


def distinct_links(rows: DataFrame, basket: str, item: str) -> DataFrame:
    """(basket, item) once each; rows that lack either are left out."""
    return rows.select(F.col(basket).alias("basket"), F.col(item).alias("item")).dropna().distinct()


def _within(items: Column) -> Column:
    """All pairs a < b of one sorted array."""
    return F.flatten(F.transform(items, lambda a, i: F.transform(F.slice(items, i + 2, F.size(items)), lambda b: F.struct(a.alias("a"), b.alias("b")))))


def _across(left: Column, right: Column) -> Column:
    pair = lambda x, y: F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    return F.flatten(F.transform(left, lambda x: F.transform(right, lambda y: pair(x, y))))


def pair_counts(links: DataFrame, block: int = BLOCK) -> DataFrame:
    """(entity_a, entity_b, n_ab): baskets that hold both items, for each pair that any basket holds.

    ``links`` has distinct (basket, item) rows.
    """
    sizes = links.groupBy("basket").agg(F.count("*").alias("size"))
    chunks_of = F.ceil(F.col("size") / block).cast("int").alias("chunks")
    # at most HOT_PARTS baskets hold such a part of all links: they are marked where they stand, the others meet their size
    huge = sizes.where((F.col("size") > block) & (F.col("size") * HOT_PARTS >= sizes.agg(F.sum("size")).scalar())).select("basket", chunks_of)
    big = sizes.where(F.col("size") > block).select("basket", chunks_of)
    in_huge = links.join(F.broadcast(huge), "basket")
    others = links.join(F.broadcast(huge.select("basket")), "basket", "left_anti").join(big, "basket", "left")
    marked = in_huge.unionByName(others)
    chunk = F.coalesce(F.pmod(F.xxhash64("item"), F.col("chunks")), F.lit(0)).cast("int")
    chunks = marked.groupBy("basket", "chunks", chunk.alias("chunk")).agg(F.sort_array(F.collect_set("item")).alias("items"))
    pairs = chunks.where(F.size("items") > 1).select(F.explode(_within(F.col("items"))).alias("p"))
    # chunk i meets chunk j > i: one row for every such pair, keyed by both numbers
    split = chunks.where("chunks > 1")
    left = split.select("basket", F.col("chunk").alias("i"), F.col("items").alias("l"), F.explode(F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda j: j > F.col("chunk"))).alias("j"))
    right = split.select("basket", F.col("chunk").alias("j"), F.col("items").alias("r"), F.explode(F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda i: i < F.col("chunk"))).alias("i"))
    met = left.join(right, ["basket", "i", "j"]).select(F.explode(_across(F.col("l"), F.col("r"))).alias("p"))
    return pairs.unionByName(met).groupBy(F.col("p.a").alias("entity_a"), F.col("p.b").alias("entity_b")).agg(F.count("*").alias("n_ab"))


def associations(rows: DataFrame, basket: str = "event_id", item: str = "entity_id", min_count: int = 1, min_lift: float = 0.0, block: int = BLOCK) -> DataFrame:
    """(entity_a, entity_b, n_ab, n_a, n_b, n, lift, pmi): pairs of items with a < b.

    lift is n_ab * n / (n_a * n_b), pmi its binary logarithm.  Repeated links
    count once; rows without basket or item do not count at all.  With
    ``min_count`` or ``min_lift`` only pairs that reach both are returned: an
    item in fewer than min_count baskets, or in more than n / min_lift of them,
    can be in no such pair and is dropped before pairing.
    """
    links = distinct_links(rows, basket, item)
    n = links.agg(F.count_distinct("basket").alias("n"))
    items = links.groupBy("item").agg(F.count("*").alias("n_item")).withColumn("n", n.scalar())
    able = items.where((F.col("n_item") >= min_count) & (F.col("n_item") * min_lift <= F.col("n")))
    counts = pair_counts(links.join(able.select("item"), "item", "left_semi"), block).where(F.col("n_ab") >= min_count)
    a = able.select(F.col("item").alias("entity_a"), F.col("n_item").alias("n_a"), "n")
    b = able.select(F.col("item").alias("entity_b"), F.col("n_item").alias("n_b"))
    out = counts.join(a, "entity_a").join(b, "entity_b").where(F.col("n_ab") * F.col("n") >= min_lift * F.col("n_a") * F.col("n_b"))
    lift = F.col("n_ab") * F.col("n") / (F.col("n_a") * F.col("n_b"))
    return out.select("entity_a", "entity_b", "n_ab", "n_a", "n_b", "n", lift.alias("lift"), F.log2(lift).alias("pmi"))
