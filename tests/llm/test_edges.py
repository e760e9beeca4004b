"""Every operator on empty tables, nulls, repeated rows, very long texts, hot groups and columns with clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from mortarline.llm import canonical as K
from mortarline.llm import cooccurrence as C
from mortarline.llm import format_duplicates as D
from mortarline.llm import leakage as L
from mortarline.llm import mixing as X
from mortarline.llm import repeated_lines as P
from mortarline.llm import scan_repair as R
from mortarline.llm.char_editor import CharEditor
from mortarline.llm.sentences import paragraph_language, sentence_spans, split_sentences
from mortarline.llm.splitting import split_items, split_oversized

CHUNKS = "chunk_id string, doc_id long, source_id string, page_number int, chunk_text string, section_guess string"


def clash(df, *names):
    return df.withColumns({n: F.lit("clash") for n in names})


def test_repeated_lines_clash_and_repeats(spark):
    rows = [(f"c{i}", i, "s", 1, "Share this\nown " + str(i), None) for i in range(4)] * 2 + [("n", None, None, None, None, None)]
    chunks = clash(spark.createDataFrame(rows, CHUNKS), "gone", "clean_text", "n_removed", "venue", "k", "bits", "lines")
    sources = clash(spark.createDataFrame([("s", "V"), ("s", "V"), (None, "V")], "source_id string, venue string"), "chunk_id", "n")
    out = P.cleaned_pages(chunks, sources)
    got = {(r["chunk_id"], r["clean_text"], r["n_removed"]) for r in out.collect()}
    assert got == {(f"c{i}", f"own {i}", 1) for i in range(4)} | {("n", None, 0)} and len(out.columns) == len(set(out.columns))
    assert P.cleaned_pages(chunks.where("false"), sources).count() == 0 and P.cleaned_pages(chunks, sources.where("false")).where("n_removed > 0").count() == 0


def test_copies_in_a_hot_group(spark):
    n = 3000
    rows = [(f"k{i:05d}", "One Title" if i % 3 == 0 else f"t{i}", "A B" if i % 2 else "b, a", None) for i in range(n)]
    df = clash(spark.createDataFrame(rows, "source_id string, title string, authors string, doi string"), "n_copies", "first_id", "_r", "m")
    found = {tuple(r) for r in D.copies_found(df).collect()}
    assert found == {("k00000", f"k{i:05d}") for i in range(3, n, 3)}
    assert D.collapsed_records(df, "source_id").agg(F.max("n_copies")).first()[0] == n // 3
    empty = df.where("false")
    assert D.collapsed_records(empty, "source_id").count() == 0


def test_a_huge_basket(spark):
    links = [("huge", f"i{k:03d}") for k in range(300)] + [(f"b{j}", f"i{k:03d}") for j in range(5) for k in (1, 2, 3)] + [(None, "i1"), ("b1", None), ("b1", "i001")]
    df = clash(spark.createDataFrame(links, "event_id string, entity_id string"), "basket", "item", "n", "size")
    got = {(r["entity_a"], r["entity_b"]): r["n_ab"] for r in C.associations(df, block=16).collect()}
    assert len(got) == 300 * 299 // 2 and got["i001", "i002"] == 6 and got["i000", "i299"] == 1


def test_canonical_edges(spark):
    ref = clash(spark.createDataFrame([(1, "m", "concrete", None), (2, "m", None, ["lime", None, ""]), (None, "m", "x", []), (3, None, "y", [])], "canonical_id long, entity_type string, canonical string, aliases array<string>"), "distance")
    rows = [("a", "m", "lime"), ("a", "m", "lime"), ("b", "m", "x" * 20_000), ("c", "m", None), ("d", "m", ""), (None, "m", "Concrete")]
    df = clash(spark.createDataFrame(rows, "entity_id string, entity_type string, entity_name string"), "canonical_id", "matches", "k", "t", "v")
    got = sorted((str(r["entity_id"]), r["canonical_id"]) for r in K.map_values(df, ref).collect())
    assert got == [("None", 1), ("a", 2), ("a", 2), ("b", 0), ("c", 0), ("d", 0)]
    trie = K.Trie()
    trie.add("n" * 5000, 1)
    assert trie.search("n" * 4999) == {1: 1}


def test_splitting_edges(spark):
    long = "One. " * 30_000
    rows = [("a", 1, "s", 1, long, "x"), ("a", 1, "s", 1, long, "x"), ("b", 2, "s", 1, None, None), ("c", 3, "s", 1, "", None), ("d", 4, "s", 1, "z" * 5000, None), ("e", 5, "s", 1, " \n" * 1500, None)]
    df = clash(spark.createDataFrame(rows, CHUNKS), "piece", "piece_no", "boundary", "k")
    out = split_items(df).collect()
    assert max(len(r["piece"] or "") for r in out) <= 2000 and {r["chunk_id"] for r in out} == {"a", "b", "c", "d", "e"}
    assert sum(r["piece_no"] == 1 for r in out) == len(rows)
    assert {r["boundary"] for r in split_oversized(df).where("chunk_id = 'd'").collect()} == {"none"}
    assert split_items(df.where("false")).count() == 0


def test_scan_repair_edges(spark):
    line = "measured concrete moisture content of specimens"
    words = [f"{a}{b}" for a in ("moist", "stone", "brick", "joint", "frost", "plate", "crack") for b in ("ening", "ation", "work", "ness", "like")]
    rng = random.Random(5)
    prose = lambda k: "\n".join(" ".join(rng.sample(words, 6)) for _ in range(9)) + f" aa{k} "
    rows = [(f"u{k:03d}", 1, "s", None, prose(k), None) for k in range(20)] + [("e", 2, "s", 1, "", None), ("n", None, None, None, None, None), ("l", 3, "s", 1, (line + "\n") * 3000, None)]
    chunks = clash(spark.createDataFrame(rows + rows[:2], CHUNKS), "venue_lines", "what", "key", "line_no", "block")
    sources = spark.createDataFrame([("s", None)], "source_id string, venue string")
    editor = CharEditor(line.split())
    assert R.found_noise(chunks, sources, editor).where("chunk_id in ('e', 'n')").count() == 0
    text = {(r["doc_id"], r["paragraph_no"]): r["text"] for r in R.repaired_paragraphs(chunks, sources, editor).collect()}
    whole = " ".join(text[k] for k in sorted(text) if k[0] == 1) + " "
    places = [whole.index(f"aa{k} ") for k in range(20)]
    assert places == sorted(places)
    assert R.found_noise(chunks.where("false"), sources, editor).count() == 0
    trained = R.train_editor(chunks.where("false"))
    assert len(trained.lexicon) == 0 and R.found_noise(chunks.where("false"), sources).count() == 0


def test_leak_edges(spark):
    item = " ".join(f"w{i}" for i in range(40))
    items = spark.createDataFrame([(1, "en", item), (1, "en", item), (None, "en", item), (2, None, None), (3, "en", "...")], "item_id long, lang string, text string")
    docs = clash(spark.createDataFrame([(1, item.upper() * 2), (1, item), (2, "x " * 200_000 + item), (3, None), (None, item)], "doc_id long, text string"), "item_id", "similarity")
    got = {(r["doc_id"], r["item_id"]) for r in L.find_leaks(docs, items).where("verbatim").collect()}
    assert got == {(1, 1), (2, 1), (None, 1)}
    assert L.find_leaks(docs.where("false"), items).count() == 0 and L.find_leaks(docs, items.where("false")).count() == 0


def test_mix_edges(spark):
    rng = random.Random(2)
    docs = clash(spark.createDataFrame([(i, "a" if i % 3 else "b", rng.randrange(1, 50)) for i in range(900)] + [(901, None, 5), (902, "a", None), (902, "a", -4)], "doc_id long, source string, n int"), "rate", "copies", "_rate", "goal")
    targets = spark.createDataFrame([("a", 0.5, 3), ("b", 0.5, 2), ("gone", None, 1), (None, 0.1, 1), ("zero", 0.0, None)], "source string, target_share double, max_repeats int")
    chosen, report = X.mix(docs, targets, "n", X.LARGEST)
    assert len(chosen.columns) == len(set(chosen.columns)) and chosen.where("copies > 3").count() == 0
    assert {r["source"]: round(r["reached_share"] or 0, 1) for r in report.collect()} == {"a": 0.5, "b": 0.5, "gone": 0.0, "zero": 0.0}
    assert X.mix(docs.where("false"), targets, "n", X.LARGEST)[0].count() == 0


def test_sentence_edges(spark):
    assert len(sentence_spans("Ab cd. " * 50_000)) == 50_000
    assert paragraph_language("Der Beton und die Probe wurden nicht mit dem Mörtel verbunden") == "de" and paragraph_language("The end of the test is in the file") == "en" and paragraph_language("Heading") == "cased"
    # an abbreviation of one language does not act in another one
    parts = lambda t: [t[a:b] for a, b in sentence_spans(t)]
    assert parts("The value of the load in the test was at its max. The end of it is in the file.")[0].endswith("max.")
    assert parts("Der Wert und die Last sind nicht mit dem max. Versatz des Feldes verbunden.") == ["Der Wert und die Last sind nicht mit dem max. Versatz des Feldes verbunden."]
    assert parts("Испытание было на с. 5 и не по г. Москва. Это из другого.") == ["Испытание было на с. 5 и не по г. Москва.", "Это из другого."]
    df = clash(spark.createDataFrame([(None, "A b. C d."), (1, None)], "doc_id long, text string"), "start_pos", "k")
    assert [r["start_pos"] for r in split_sentences(df).collect()] == [0, 5] and split_sentences(df.where("false")).count() == 0


@pytest.mark.parametrize("master", ["spark://host:7077", "local-cluster[2,1,1024]", "yarn"])
def test_no_private_folder_on_a_cluster(master):
    from types import SimpleNamespace

    from mortarline.plans.session import shared_folder

    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: d)))
