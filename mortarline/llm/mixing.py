"""Mixing sources to target weights (problem 9).

Entropy balancing: among all document rates that give each source its share of
the size, the ones closest to 1 in relative entropy are exp(lambda_s * size),
capped at the allowed repeats.  The multipliers are the solution of a convex
dual with one coordinate per source; each Newton step takes one aggregate over
the documents' sizes.  A source whose dual has no finite solution, since even
all its documents at their cap stay below its goal, cannot reach its share.
Rates are then rounded into whole copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from pathlib import Path

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.plans.session import stored

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: Sources that a target table may list; their multipliers are kept on the driver and sent to the tasks.
MAX_SOURCES = 10_000
#: Newton steps, bisection included; more are an error.
MAX_STEPS = 200
TOLERANCE = 1e-9
#: Bins of the rounding threshold per source and size class.
BINS = 4096
LARGEST = "largest"


def token_counts(docs: DataFrame, tokenizer: str = TOKENIZER, text: str = "text") -> DataFrame:
    """``docs`` with ``n_tokens``, counted by a tokenizer file of the tokenizers library; null text has 0.

    The file is read on the driver's machine and goes to the tasks with the job.
    """
    docs.sparkSession.sparkContext.addFile(tokenizer)
    name = Path(tokenizer).name

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(SparkFiles.get(name))
        t.encode_special_tokens = True
        t.no_truncation()
        for s in batches:
            texts = s.fillna("").tolist()
            n = []
            for a in range(0, len(texts), 64):
                n += [len(e.ids) for e in t.encode_batch_fast(texts[a : a + 64], add_special_tokens=False)]
            yield pd.Series(n, dtype="int64")

    return docs.withColumn("n_tokens", count(F.col(text)))


def _step(state: dict, got: float, slope: float) -> None:
    """One safeguarded Newton step on a source's dual coordinate."""
    gap = got - state["goal"]
    if abs(gap) <= TOLERANCE * max(1.0, state["goal"]):
        state["done"] = True
        return
    if gap > 0:
        state["high"] = state["rate"]
    else:
        state["low"] = state["rate"]
    x = state["rate"] - gap / slope if slope > 0 else math.nan
    low, high = state["low"], state["high"]
    if not low < x < high:
        if math.isinf(low):
            x = min(2 * high, high - 1.0) if high <= 0 else -1.0
        elif math.isinf(high):
            x = max(2 * low, low + 1.0) if low >= 0 else 1.0
        else:
            x = (low + high) / 2
    if x == state["rate"] or high - low < 1e-14 * max(1.0, abs(x)):
        state["done"] = True
    state["rate"] = x


def _sizes(docs: DataFrame, size: str, source: str) -> DataFrame:
    """(source, size, n): equal sizes of a source have equal rates, so the dual needs their number only."""
    sizes = docs.where(F.col(source).isNotNull()).select(F.col(source).alias("source"), F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("double").alias("size"))
    return stored(sizes.groupBy("source", "size").agg(F.count("*").alias("n")))


def balance(docs: DataFrame, targets: DataFrame, size: str, total: float | str | None = None, source: str = "source") -> tuple[DataFrame, dict[str, dict]]:
    """The report of a mix and, by source, what its rates are made of (rate, mean, cap).

    ``targets``: source, target_share, max_repeats.  The mix is to be as large
    as ``total``, by default all documents whose source is not null; "largest"
    makes it the largest mix in which every listed source that has documents
    keeps its share (the shares of those without any go to the others in
    proportion).  Report columns: source, target_share, max_repeats, n_docs,
    own_size, goal, capacity (own size times max_repeats), feasible (whether the
    source can reach its goal), expected (what the rates give).  A source without
    documents has own size 0.  Documents of sources not listed count towards the
    default total and are not in the mix; sizes that are null or not positive
    count as 0.
    """
    spark = docs.sparkSession
    wanted = targets.where(F.col(source).isNotNull()).select(source, "target_share", "max_repeats").limit(MAX_SOURCES + 1).collect()
    if len(wanted) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = _sizes(docs, size, source)
    listed = spark.createDataFrame([(s,) for s in dict.fromkeys(r[0] for r in wanted)], "source string")
    own = {r["source"]: r for r in sizes.join(F.broadcast(listed), "source").groupBy("source").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("size")).collect()}  # listed: at most MAX_SOURCES rows
    states = {}
    for s, share, cap in wanted:
        n, amount = (own[s]["n"], float(own[s]["size"])) if s in own else (0, 0.0)
        states[s] = {"share": share, "weight": share or 0.0, "cap": int(cap or 0), "n": n, "own": amount, "mean": amount / n if n and amount else 1.0, "rate": 0.0, "low": -math.inf, "high": math.inf, "done": False, "expected": 0.0}
    if total == LARGEST:
        able = {s: v for s, v in states.items() if v["weight"] > 0 and v["own"] * v["cap"] > 0}
        weight = sum(v["weight"] for v in able.values())
        for s, v in states.items():
            v["weight"] = v["weight"] / weight if s in able else 0.0
        whole = min((v["own"] * v["cap"] / v["weight"] for v in able.values()), default=0.0)
    elif total is None:
        whole = float(sizes.agg(F.coalesce(F.sum(F.col("n") * F.col("size")), F.lit(0.0))).first()[0])
    else:
        whole = float(total)
    for v in states.values():
        v["goal"] = v["weight"] * whole
    for step in range(MAX_STEPS):
        open_ = {s: v for s, v in states.items() if not v["done"]}
        if not open_:
            break
        found = {r["source"]: r for r in _dual(sizes, _state_rows(spark, open_)).collect()}
        for s, v in open_.items():
            got, slope, most = (found[s]["got"], found[s]["slope"], found[s]["most"]) if s in found else (0.0, 0.0, 0.0)
            if step == 0 and (most <= v["goal"] or v["goal"] <= 0):
                # the gradient stays on one side however far the multiplier goes: the rates are at their cap, or nothing
                up = v["goal"] > 0
                v |= {"done": True, "rate": math.inf if up else -math.inf, "expected": most if up else 0.0}
                continue
            v["expected"] = got
            _step(v, got, slope)
    else:
        raise RuntimeError(f"no balance after {MAX_STEPS} steps")
    rows = [(s, v["share"], v["cap"], v["n"], v["own"], v["goal"], v["own"] * v["cap"], not (v["rate"] == math.inf and v["expected"] < v["goal"] or total == LARGEST and (v["share"] or 0.0) > 0 and v["goal"] <= 0), v["expected"]) for s, v in states.items()]
    schema = "source string, target_share double, max_repeats int, n_docs bigint, own_size double, goal double, capacity double, feasible boolean, expected double"
    return spark.createDataFrame(rows, schema), states


def _state_rows(spark: SparkSession, states: Mapping[str, dict]) -> DataFrame:
    """The states as a table of at most MAX_SOURCES rows, small enough to be sent to every task."""
    rows = [(s, float(v["rate"]), float(v["mean"]), float(v["cap"])) for s, v in states.items()]
    return spark.createDataFrame(rows, "source string, _rate double, _mean double, _cap double")


def _dual(sizes: DataFrame, states: DataFrame) -> DataFrame:
    """Each source's expected size and its derivative at the present multipliers, and its size at the cap."""
    x = F.col("size") / F.col("_mean")
    tilt = F.exp(F.least(F.col("_rate") * x, F.lit(700.0)))
    amount = F.col("n") * F.col("size")
    rows = sizes.join(F.broadcast(states), "source")  # states: at most MAX_SOURCES rows
    return rows.groupBy("source").agg(F.sum(amount * F.least(tilt, F.col("_cap"))).alias("got"), F.sum(F.when(tilt < F.col("_cap"), amount * x * tilt).otherwise(0.0)).alias("slope"), F.sum(amount * F.col("_cap")).alias("most"))


def _rate(amount: Column) -> Column:
    tilt = F.least(F.exp(F.least(F.col("_rate") * amount / F.col("_mean"), F.lit(700.0))), F.col("_cap"))
    return F.when(F.col("_rate") == math.inf, F.col("_cap")).when(F.col("_rate") == -math.inf, 0.0).otherwise(tilt)


def mix(docs: DataFrame, targets: DataFrame, size: str, total: float | str | None = None, key: str = "doc_id", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(mix, report): documents with their copies (0 left out), and shares reached.

    ``total`` as for balance.  A rate is rounded down, and up for the documents
    whose hash comes first, as many as bring the source's size to its expected
    one: from the largest documents to the smallest, each size class (a power of
    two) makes up what the larger ones miss, so that in the end no more is missed
    than about half a small document or half a bin.  Copies never exceed
    max_repeats.  The report adds to that of balance n_copies, reached (size in
    the mix) and reached_share.  The mix has rate and copies besides the columns
    of the documents; theirs with these names are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("rate", "copies")
    report, states = balance(docs, targets, size, total, source)
    amount = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("double")
    # the documents' own columns travel in one, so that none of them can clash
    rows = docs.select(F.struct("*").alias("_doc"), F.col(source).alias("source"), F.col(key).alias("_key"), amount.alias("size"))
    rated = rows.join(F.broadcast(_state_rows(spark, states)), "source")  # at most MAX_SOURCES rows
    rated = rated.withColumn("rate", _rate(F.col("size"))).withColumn("_floor", F.floor("rate").cast("int"))
    unit = F.pmod(F.xxhash64(F.lit("copies"), F.col("_key")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # a document goes up if its hash lies little enough above the rate's fraction; half the bins are below it
    over = F.floor((unit - (F.col("rate") - F.col("_floor")) + 1.0) * (BINS / 2)).cast("int")
    rated = rated.withColumns({"_over": over, "class": F.floor(F.log2(F.greatest("size", F.lit(1.0)))).cast("int")})
    may = F.col("rate") > F.col("_floor")
    last = _rounding(rated.select("source", "size", "class", "_floor", "_over", "rate", may.alias("may")))
    up = F.when(may & (F.col("_over") <= F.col("_last")), 1).otherwise(0)
    # last: at most 64 rows for each of MAX_SOURCES sources
    chosen = rated.join(F.broadcast(last), ["source", "class"]).withColumn("copies", F.col("_floor") + up).where(F.col("copies") > 0)
    reached = chosen.groupBy("source").agg(F.sum("copies").alias("n_copies"), F.sum(F.col("copies") * F.col("size")).alias("reached"))
    out = report.join(F.broadcast(reached), "source", "left").fillna(0, ["n_copies", "reached"])  # reached: one row per listed source
    whole = reached.agg(F.sum("reached").alias("whole"))
    return chosen.select("_doc.*", "rate", "copies"), out.withColumn("reached_share", F.try_divide(F.col("reached"), whole.scalar()))


def _rounding(rated: DataFrame) -> DataFrame:
    """(source, class, _shift): by size class, the shift of the rounding threshold that brings a source next to its expected size.

    Sizes are added up in BINS bins of how far a document's hash lies over its
    fraction.  The classes of a source go from the largest down, and each makes up
    what those before it miss; at most 64 * (BINS + 1) rows of a source are left.
    """
    bins = F.when(F.col("may"), F.col("_over")).otherwise(F.lit(BINS))
    rows = rated.groupBy("source", "class", bins.alias("bin"))
    rows = rows.agg(F.sum(F.col("size") * (F.col("rate") - F.col("_floor"))).alias("lack"), F.sum(F.when(F.col("may"), F.col("size")).otherwise(0.0)).alias("extra"))

    def choose(cells: pd.DataFrame) -> pd.DataFrame:
        out, missing = [], 0.0
        for size_class, part in sorted(cells.groupby("class"), key=lambda x: -x[0]):
            wanted = part["lack"].sum() + missing
            some = part[part["bin"] < BINS].sort_values("bin")
            sums = [0.0, *some["extra"].cumsum()]
            best = min(range(len(sums)), key=lambda k: abs(sums[k] - wanted))
            missing = wanted - sums[best]
            out.append((cells["source"].iloc[0], size_class, int(some["bin"].iloc[best - 1]) if best else -1))
        return pd.DataFrame(out, columns=["source", "class", "_last"])

    return rows.groupBy("source").applyInPandas(choose, "source string, class int, _last int")
