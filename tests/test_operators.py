"""Keys, identity, features, overlays, patterns, governance, documents, sources, sinks and the stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from mortarline.functions.normalize import alnum_key, iso_timestamp, snake
from mortarline.operators import analytics as A
from mortarline.operators import documents as DOC
from mortarline.operators import features as FE
from mortarline.operators import governance as G
from mortarline.operators import model as M
from mortarline.operators import overlays as O
from mortarline.operators import patterns as R
from mortarline.operators.identity import normalized_doi, resolve_sources
from mortarline.sources import files, sinks
from mortarline.streaming import ingest


def test_normalization(spark):
    df = spark.createDataFrame([("Ｆｕｌｌ-width: STRAẞE 1",), ("",), (None,)], "s string")
    assert [r[0] for r in df.select(alnum_key(F.col("s"))).collect()] == ["fullwidthstrasse1", "", None]
    df = spark.createDataFrame([(" Stability Issue / Mid-Span ",), (None,)], "s string")
    assert [r[0] for r in df.select(snake(F.col("s"))).collect()] == ["stability_issue/mid_span", None]


def test_iso_timestamps(spark):
    same = ["2025-12-02T03:04:05Z", "20251202T030405Z", "2025-12-02 03:04:05", "2025-12-02T08:34:05+05:30", "2025-12-01T22:04:05-0500", "2025-12-02T03:04:05.000Z", "2025-12-02T04:04:05+01"]
    df = spark.createDataFrame([(s,) for s in [*same, "soon", "", None]], "s string")
    got = [r[0] for r in df.select(F.unix_seconds(iso_timestamp(F.col("s")))).collect()]
    want = int(dt.datetime(2025, 12, 2, 3, 4, 5, tzinfo=dt.timezone.utc).timestamp())
    assert got == [want] * len(same) + [None] * 3


def test_features(spark):
    ts = lambda d: f"2025-12-{d:02d}T00:00:00Z"
    events = spark.createDataFrame(
        [("e1", "A/x", "failed", ts(1), 1), ("e1", "a/x", "Improved", ts(2), 2), ("e2", "b/y", "odd", None, 1), (None, "a/x", "failed", ts(3), 1), ("e3", None, None, ts(4), 1)],
        "event_id string, event_type string, outcome string, created_at string, loaded_at int",
    )
    links = spark.createDataFrame([("e1", "n1", "r"), ("e1", "n1", "s"), ("e2", "n1", None), ("e3", "n2", None), ("e1", None, "r"), ("e9", "n1", "r")], "event_id string, entity_id string, role string")
    pairs = FE.entity_events(FE.latest_events(events), links)
    wide = FE.entity_features(pairs, ["a/x", "b/y"], as_of=F.lit("2025-12-04T00:00:00Z").cast("timestamp"))
    rows = {r["entity_id"]: r.asDict() for r in wide.collect()}
    assert rows["n1"]["a__x__n"] == 1 and rows["n1"]["a__x__improved"] == 1 and rows["n1"]["a__x__failed"] == 0
    assert rows["n1"]["a__x__days_since"] == 2.0 and rows["n1"]["b__y__last"] is None and rows["n1"]["b__y__n"] == 1
    assert rows["n2"]["other_types__n"] == 1
    got = {tuple(r) for r in FE.feature_rows(FE.feature_cells(pairs)).collect()}
    assert got == {("n1", "a/x", "improved", 1), ("n1", "b/y", "other_outcomes", 1), ("n2", "unknown", "unknown", 1)}
    assert FE.entity_features(pairs.where("false"), ["a/x"]).count() == 0 and FE.feature_cells(pairs.where("false")).count() == 0


def test_first_and_last_writer(spark):
    old = spark.createDataFrame([("k1", 1, "old")], "k string, o int, v string")
    new = spark.createDataFrame([("k1", 2, "new"), ("k2", 5, "b"), ("k2", 4, "a"), (None, 1, "n")], "k string, o int, v string")
    assert {(r["k"], r["v"]) for r in M.insert_or_ignore(old, new, ["k"], ["o"]).collect()} == {("k1", "old"), ("k2", "a"), (None, "n")}
    assert {(r["k"], r["v"]) for r in M.upsert(old, new, ["k"], ["o"]).where("k is not null").collect()} == {("k1", "new"), ("k2", "b")}


def test_consistency(spark):
    child = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, k string")
    parent = spark.createDataFrame([("a",), ("a",)], "k string")
    assert [r["id"] for r in M.orphans(child, parent, "k").collect()] == [2]
    assert sorted((r["id"], r["k"]) for r in M.set_null(child, parent, "k").collect() if r["k"]) == [(1, "a")]
    assert M.cascade(child, parent, "k").count() == 1
    bad = spark.createDataFrame([("kd", None, "nm")], "measurement_type string, value string, unit string")
    with pytest.raises(Exception, match="measurement without"):
        M.checked_measurements(bad).collect()
    assert M.empty_table(spark, "entities").count() == 0
    ids = spark.range(1).select(M.hashed_id(F.lit("abc")), M.short_id(F.lit("abc"), F.lit(None))).first()
    assert ids[0].startswith("ba7816bf") and len(ids[1]) == 16


def test_source_identity(spark):
    old = spark.createDataFrame([("s1", "A study of creep in concrete beams", "Ann Lee and Bo Ray", "doi:10.1/X"), ("s2", None, None, " ")], "source_id string, title string, authors string, doi string")
    new = spark.createDataFrame(
        [("n1", "other", None, "https://doi.org/10.1/x/"), ("n2", "  A STUDY of creep in  concrete beams ", None, None), ("n3", "A study of creep in concrete beam", "Bo Ray", None), ("n4", "A study of creep in concrete beam", "Cy", None), ("n5", None, None, None)],
        "source_id string, title string, authors string, doi string",
    )
    got = {r["source_id"]: (r["resolved_id"], r["matched_by"]) for r in resolve_sources(old, new).collect()}
    assert got == {"n1": ("s1", "doi"), "n2": ("s1", "title"), "n3": ("s1", "fuzzy"), "n4": ("n4", "new"), "n5": ("n5", "new")}
    assert spark.createDataFrame([("DOI: x",)], "d string").select(normalized_doi(F.col("d"))).first()[0] == "x"


def test_patterns(spark):
    rows = spark.createDataFrame([("Protein A", 12, False, 5.0), ("toxicity of B", 12, False, 5.0), ("C", 2, True, 10.0), ("D", 5, True, 5.0), ("E", 5, False, 5.0)], "name string, n int, e boolean, mean double")
    got = rows.select(F.expr(R.pattern_type(O.SPARK, "name", "n", "e")).alias("p"), F.expr(R.momentum(O.SPARK, "n", "mean")).alias("m")).collect()
    assert [r["p"] for r in got] == ["convergence", "stagnation", "abandonment", "escalation", "fragmentation"]
    assert [r["m"] for r in got] == ["increasing", "increasing", "decreasing", "stable", "stable"]
    votes = spark.createDataFrame([(4, 3, 0), (4, 1, 2), (4, 0, 1), (0, 0, 0)], "n int, h int, m int")
    assert [r[0] for r in votes.select(F.expr(R.confidence_vote(O.SPARK, "n", "h", "m"))).collect()] == ["high", "med", "low", "low"]
    ents = spark.createDataFrame([("e1", "Protein A", "target"), ("e2", "Protein B", "target"), ("e3", "C", "x")], "entity_id string, entity_name string, entity_type string")
    events = spark.createDataFrame([("v1", "improved and replicated in vivo", "high"), ("v2", "enhanced outcomes", "med"), ("v3", None, "low")], "event_id string, evidence_snippet string, confidence string")
    links = spark.createDataFrame([("v1", "e1"), ("v2", "e1"), ("v3", "e2")], "event_id string, entity_id string")
    out = R.analyze_patterns(ents, links, events).collect()
    assert [r["entity_id"] for r in out] == ["e1", "e2"] and out[0]["health_score"] >= out[1]["health_score"]
    assert (out[0]["positive"], out[0]["replication"]) == (1, 1)


def test_overlays(spark):
    df = spark.createDataFrame([("efficacy by a pathway in vivo",), ("",)], "s string")
    assert [r[0] for r in df.select(F.expr(O.event_score(O.SPARK, "science_research_v1", "s"))).collect()] == [2.0, 0.0]
    rows = spark.createDataFrame([(8.0, 10.0), (6.0, 10.0), (4.0, 10.0), (2.0, 10.0), (1.0, 10.0), (1.0, 0.0)], "x double, m double")
    assert [r[0] for r in rows.select(F.expr(O.bucket(O.SPARK, "x", "m"))).collect()] == ["strong", "promising", "exploratory", "stalled", "deprioritized", "deprioritized"]
    ents = spark.createDataFrame([("1", "material", " Concrete "), ("2", "material", "concrete"), ("3", "x", "neurons"), ("4", "assay", "analysis"), ("5", "peptide", "noise123"), ("6", None, "y"), ("7", "x", None)], "entity_id string, entity_type string, entity_name string")
    alias = spark.createDataFrame([(1, "material", "concrete", ["concrete", "cast stone"])], "canonical_id int, entity_type string, canonical string, aliases array<string>")
    merged, mapping = O.canonical_entities(ents, O.alias_rows(alias))
    assert {r["canonical_id"]: r["n_entities"] for r in merged.collect()} == {"material:concrete": 2, "neural_cell:neurons": 1}
    assert mapping.count() == 3
    dist = O.bucket_distribution(spark.createDataFrame([("strong",)], "o_bucket string"), "o").orderBy("position").collect()
    assert [(r["n"], r["percent"]) for r in dist] == [(1, 100.0)] + [(0, 0.0)] * 4


def test_governance(spark, tmp_path):
    p = G.profile_from(G.EXAMPLE_PROFILE)
    df = spark.createDataFrame([("BUY NOW while in stock",), ("samples",), ("a sample",), (None,)], "t string")
    assert [r[0] for r in df.select(p.excluded(F.col("t"))).collect()] == [True, False, True, False]
    with pytest.raises(ValueError, match="lacks"):
        G.profile_from({"id": "x"})
    for bad in ("../x", "", "a b"):
        with pytest.raises(ValueError, match="invalid"):
            G.valid_domain_id(bad)
    assert G.checked_memory("2GB") == 2000
    with pytest.raises(ValueError, match="range"):
        G.checked_memory("10M")
    feeds = spark.createDataFrame([("a", "u", "construction_science"), ("b", "u", None), ("c", "u", "zz")], "name string, url string, domain string")
    known = spark.createDataFrame([("construction_science",)], "domain_id string")
    assert {r["name"]: r["missing_reason"] for r in G.audit_feeds(feeds, known).collect()} == {"a": None, "b": "missing domain", "c": "unknown domain"}


def test_documents(spark):
    df = spark.createDataFrame([("see https://x.org/a.pdf, HTTPS://x.org/b.PDF?v=1 and https://x.org/a.pdf",), (None,)], "t string")
    assert [r[0] for r in df.select(DOC.pdf_links(F.col("t"))).collect()][1] == []
    long = "word " * 20
    html = spark.createDataFrame([(f'<div class="abstract">short</div> Abstract</h2> <p>{long}</p>',), ('<div id="abstract">short <b>one</b></div>',), ("none",), (None,)], "h string")
    assert [r[0] for r in html.select(DOC.html_abstract(F.col("h"))).collect()] == [long.strip(), "short one", None, None]
    page = spark.createDataFrame([("Journal of X, Vol 2\nCreep of timber\nAnn Lee, Bo Ray\nUniversity of Y, Z\ndoi: 10.1000/ab.c.\n(2019)\nReceived 2020",), ("",)], "p string")
    first = page.select(*[c.alias(k) for k, c in DOC.first_page(F.col("p")).items()]).collect()
    assert tuple(first[0]) == ("Creep of timber", "Ann Lee, Bo Ray", "10.1000/ab.c", 2020) and tuple(first[1]) == (None, None, None, None)
    got = spark.range(1).select(DOC.entry_links(F.lit("http://arxiv.org/abs/1"), F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("array<struct<href:string,type:string,title:string>>"))).first()[0]
    assert got == ["http://arxiv.org/pdf/1.pdf"]


def test_analytics_on_empty_tables(spark):
    events = spark.createDataFrame([], "event_id string, source_id string, created_at string")
    links = spark.createDataFrame([], "event_id string, entity_id string")
    assert A.coverage(events, links).first()["percent"] == 0.0
    assert A.entities_per_event(events, links).count() == 0
    quality = spark.createDataFrame([("d", "material", 0.8), ("d", "system", 0.4)], "d string, entity_type string, confidence double")
    assert A.entity_quality(quality, "d").first()["quality_score"] == 65.0


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.PDF").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "a" / "y.pdf").write_bytes(b"no")
    pdf = files.pdf_files(spark, str(tmp_path))
    assert sorted(r[0] for r in pdf.select(files.is_pdf(F.col("content"))).collect()) == [False, True]
    assert files.folder_counts(pdf).first()["n"] == 2
    (tmp_path / "terms").mkdir()
    (tmp_path / "terms" / "mat.txt").write_text("Concrete # c\n\n# only\nsteel\nSTEEL\n")
    assert {tuple(r) for r in files.term_list(spark, str(tmp_path / "terms")).collect()} == {("mat", "concrete"), ("mat", "steel")}
    feed = tmp_path / "f.xml"
    feed.write_text("<rss><channel><item><title>Creep</title><link>http://a/b.pdf</link></item><item><title>Other</title></item></channel></rss>")
    assert files.probe_feed(files.feed_entries(spark, str(feed)), ("creep",)).first()["n_matching"] == 1
    assert files.merged_config({"a": [2], "b": {"x": 1}, "c": 1}, {"a": [1, 2], "b": {"x": 9, "y": 2}, "c": 2, "d": 4}) == {"a": [1, 2], "b": {"x": 1, "y": 2}, "c": 1, "d": 4}
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "d.txt").write_text("one\f\ftwo")
    assert [r["page_number"] for r in files.text_pages(spark, str(tmp_path / "p")).orderBy("page_number").collect()] == [1, 3]
    out = tmp_path / "out.csv"
    sinks.write_one_file(spark.createDataFrame([("a,b", 1)], "x string, y int"), str(out))
    assert out.read_text().splitlines() == ["x,y", '"a,b",1']
    assert files.csv_export(spark, str(out)).first()["x"] == "a,b"


def test_stream_keeps_each_event_once(spark, tmp_path):
    now = dt.datetime(2026, 1, 1)
    pages = spark.createDataFrame([("d1", "s1", 1, "It was abandoned. It was abandoned. The weather was fine.", now)], ingest.PAGES)
    pages.union(pages).write.parquet(str(tmp_path / "in"))
    q = ingest.write_events(ingest.event_stream(ingest.page_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r["sentence"], r["decision"]) for r in rows] == [("It was abandoned.", "abandoned")]
