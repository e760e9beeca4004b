"""Repeated lines, duplicates, co-occurrence, canonical names and mixing on small fixtures."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from mortarline.llm import canonical as K
from mortarline.llm import format_duplicates as D
from mortarline.llm.cooccurrence import associations
from mortarline.llm.mixing import LARGEST, balance, mix, token_counts
from mortarline.llm.repeated_lines import cleaned_pages, repeated_lines


def test_repeated_lines(spark):
    rows = [(f"c{i}", i, "s1", f"Text {i}\n  SHARE this, please » \n\n12") for i in range(4)] + [("c8", 8, "s1", "share this – please\nonce"), ("c9", 9, "s1", None), ("cx", 1, "s2", "Share this please"), ("cy", 7, None, "x"), ("cz", 5, "s1", "Ｓhare this please")]
    chunks = spark.createDataFrame(rows, "chunk_id string, doc_id long, source_id string, chunk_text string").withColumn("venue", F.lit("clash"))
    sources = spark.createDataFrame([("s1", "V"), ("s2", None), ("s3", "W")], "source_id string, venue string")
    got = {(r["chunk_id"], r["line_no"]) for r in repeated_lines(chunks, sources).collect()}
    assert got == {(f"c{i}", 2) for i in range(4)} | {("c8", 1), ("cz", 1)}
    clean = {r["chunk_id"]: r["clean_text"] for r in cleaned_pages(chunks, sources).collect()}
    assert clean["c0"] == "Text 0\n\n12" and clean["c8"] == "once" and clean["c9"] is None and clean["cx"] == "Share this please"
    assert repeated_lines(chunks.where("false"), sources).count() == 0


def test_dense_and_sparse_containers(spark):
    docs = spark.range(0, 5000).select(F.concat(F.lit("c"), "id").alias("chunk_id"), F.col("id").alias("doc_id"), F.lit("s").alias("source_id"), F.when(F.col("id") % 2 == 0, "Often here").otherwise(F.concat(F.lit("own "), "id")).alias("chunk_text"))
    sources = spark.createDataFrame([("s", "V")], "source_id string, venue string")
    got = repeated_lines(docs, sources)
    assert got.count() == 2500 and got.agg(F.max("n")).first()[0] == 2500
    assert got.where(F.substring("chunk_id", 2, 9).cast("int") % 2 == 1).count() == 0


def test_copies(spark):
    rows = [
        ("b", "On Creep: a study", "Lee, Ann; Ray, Bo", "10.1/AB"), ("a", "on  creep – A STUDY.", "Bo Ray & Ann Lee", " DOI: 10.1/ab."), ("c", "On Creep: a study", "Lee, Ann; Ray, Bo", None),
        ("d", "On Creep a study", "Ann Lee, Bo Ray", ""), ("e", "On Creep: a study", "Lee, Ann; Ray, Bo; Ray, Bo", "10.1/ab"), ("f", None, None, None), ("g", None, None, " "), ("h", "", None, None), (None, "x", "y", "z"), ("a", "on  creep – A STUDY.", "Bo Ray & Ann Lee", " DOI: 10.1/ab."),
    ]
    df = spark.createDataFrame(rows, "source_id string, title string, authors string, doi string").withColumn("first_id", F.lit(1)).withColumn("f1", F.lit(1))
    assert {tuple(r) for r in D.copies_found(df).collect()} == {("a", "b"), ("c", "d"), ("f", "g"), ("f", "h")}
    assert {r["source_id"]: r["n_copies"] for r in D.collapsed_records(df.drop("first_id", "f1"), "source_id").collect()} == {"a": 2, "c": 2, "e": 1, "f": 3}
    assert D.copies_found(df.where("false")).count() == 0


def test_collisions_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(D, "_fingerprint", lambda parts, seed: F.lit(1))
    df = spark.createDataFrame([("a", "x", "n", None), ("b", "y", "n", None), ("c", "Y", "n", None), ("d", "X!", "n", None)], "source_id string, title string, authors string, doi string")
    assert {tuple(r) for r in D.copies_found(df).collect()} == {("a", "d"), ("b", "c")}


@pytest.mark.parametrize("block", [2, 3, 64])
def test_pairs_against_brute_force(spark, block):
    rng = random.Random(1)
    rows = [(f"e{b}", f"i{rng.randrange(12)}", rng.choice(["r", None])) for b in range(40) for _ in range(rng.randrange(1, 9))]
    rows += [("big", f"i{k}", "r") for k in range(12)] + [("e1", None, "r"), (None, "i1", "r")]
    df = spark.createDataFrame(rows, "event_id string, entity_id string, role string")
    baskets = defaultdict(set)
    for b, i, _ in rows:
        if b and i:
            baskets[b].add(i)
    pairs = Counter(p for s in baskets.values() for p in combinations(sorted(s), 2))
    single = Counter(i for s in baskets.values() for i in s)
    n = len(baskets)
    got = {(r["entity_a"], r["entity_b"]): r["n_ab"] for r in associations(df, block=block).collect()}
    assert got == dict(pairs)
    want = {p for p, c in pairs.items() if c >= 5 and c * n >= 1.1 * single[p[0]] * single[p[1]]}
    assert {(r["entity_a"], r["entity_b"]) for r in associations(df, min_count=5, min_lift=1.1, block=block).collect()} == want
    assert associations(df.where("false")).count() == 0


def test_trie_search_against_brute_force():
    def osa(a, b):
        d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
        return d[-1][-1]

    rng = random.Random(2)
    names = ["".join(rng.choices("abc", k=rng.randrange(2, 7))) for _ in range(60)]
    trie = K.Trie()
    for i, x in enumerate(names):
        trie.add(x, i)
    for _ in range(200):
        q = "".join(rng.choices("abcd", k=rng.randrange(1, 8)))
        want = {i: osa(q, x) for i, x in enumerate(names) if osa(q, x) <= K.allowed_distance(len(x))}
        assert trie.search(q) == want


def test_canonical_names(spark):
    ref = spark.createDataFrame([(1, "material", "concrete", ["concrete", "cast stone mix"]), (2, "property", "compressive strength", ["compressive strength"]), (3, "property", "creep", ["creep"]), (4, "failure_mode", "creep", ["creep", "slow flow collapse"])], "canonical_id long, entity_type string, canonical string, aliases array<string>")
    cases = {"Concrête": 1, "соncrеte [12]": 1, "cats ston mix": 1, "Stone mix, cast": 1, "CONCRETES – sample 9": 1, "granite": 0, "unknown": 0, "": 0, None: 0}
    rows = [(f"m{i}", "material", v) for i, v in enumerate(cases)] + [("p1", "property", "Compre. strength"), ("p2", "property", "creep"), ("f1", "failure_mode", "CREPE"), ("z", "compound", "concrete"), ("n", None, "creep")]
    df = spark.createDataFrame(rows, "entity_id string, entity_type string, entity_name string").withColumn("canonical_id", F.lit(5))
    want = {f"m{i}": c for i, c in enumerate(cases.values())} | {"p1": 2, "p2": 3, "f1": 4, "z": 0, "n": 0}
    for size in (K.BLOCK_BYTES, 10):
        rows = K.map_values(df, ref, block_bytes=size).collect()
        assert {r["entity_id"]: r["canonical_id"] for r in rows} == want and len(rows) == len(want)
        assert all((r["canonical_id"] == 0) == (r["distance"] is None) == (not r["matches"]) for r in rows)
    near = spark.createDataFrame([(1, "material", "cement a", []), (2, "material", "cement b", None), (3, "material", "lime", ["cement"])], "canonical_id long, entity_type string, canonical string, aliases array<string>")
    got = K.map_values(df.where("entity_id = 'm0'").withColumn("entity_name", F.lit("cement b")), near).first()
    assert [tuple(m) for m in got["matches"]] == [(2, 0), (1, 1), (3, 2)] or [tuple(m) for m in got["matches"]] == [(2, 0), (1, 1)]
    assert K.map_values(df, ref.where("false")).where("canonical_id <> 0").count() == 0 and K.map_values(df.where("false"), ref).count() == 0


def test_mixing(spark):
    rng = random.Random(3)
    rows = [(i, "big" if i % 3 else "small", float(rng.randrange(10, 100))) for i in range(3000)] + [(9001, None, 5.0), (9002, "other", 50.0), (9003, "big", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size double")
    targets = spark.createDataFrame([("big", 0.3, 2), ("small", 0.5, 4), ("tiny", 0.2, 3)], "source string, target_share double, max_repeats int")
    report, rates = balance(df, targets, "size")
    got = {r["source"]: r for r in report.collect()}
    assert not got["tiny"]["feasible"] and got["big"]["feasible"]
    for s in ("big", "small"):
        assert got[s]["expected"] == pytest.approx(got[s]["goal"], rel=1e-6)
    chosen, shares = mix(df, targets, "size")
    out = {r["source"]: r for r in shares.collect()}
    for s in ("big", "small"):
        assert out[s]["reached"] == pytest.approx(out[s]["goal"], rel=0.08)
    caps = {"big": 2, "small": 4}
    assert all(0 < r["copies"] <= caps[r["source"]] for r in chosen.collect())
    for total in (None, LARGEST):
        out = {r["source"]: r for r in mix(df, targets, "size", total)[1].collect()}
        for s in ("big", "small"):
            assert out[s]["reached"] == pytest.approx(out[s]["expected"], rel=0.005)
    # the largest mix keeps the shares of the sources there are: 3 to 5
    assert out["big"]["reached_share"] == pytest.approx(0.375, abs=0.003) and out["small"]["reached_share"] == pytest.approx(0.625, abs=0.003)
    own = {s: sum(x for _, t, x in rows if t == s and x) for s in ("big", "small")}
    assert sum(r["goal"] for r in out.values()) == pytest.approx(min(own["big"] * 2 / 0.375, own["small"] * 4 / 0.625))
    assert not out["tiny"]["feasible"]
    # few and long documents at low rates: each source within a hundredth of its goal
    long = spark.createDataFrame([(i, f"s{i % 5}", float(rng.randrange(50, 500))) for i in range(4000)] + [(9000 + i, f"s{i % 5}", 9000.0) for i in range(10)], "doc_id long, source string, size double")
    five = spark.createDataFrame([(f"s{k}", x, 2) for k, x in enumerate((0.9, 0.04, 0.03, 0.02, 0.01))], "source string, target_share double, max_repeats int")
    for r in mix(long, five, "size", LARGEST)[1].collect():
        assert r["reached"] == pytest.approx(r["goal"], rel=0.011)
    assert balance(df.where("false"), targets, "size")[0].where("feasible").count() == 3
    assert mix(df, targets.where("false"), "size")[0].count() == 0


def test_token_counts(spark):
    df = spark.createDataFrame([("hello world",), ("",), (None,), ("<|endoftext|>",)], "text string")
    n = [r[0] for r in token_counts(df).select("n_tokens").collect()]
    assert n[0] == 2 and n[1] == n[2] == 0 and n[3] > 1
