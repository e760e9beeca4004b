"""Entity tagging, dictionaries, relations and scored extraction."""

from pyspark.sql import functions as F

from mortarline.operators import extractors as E
from mortarline.operators.entities import dictionary_match, peptide_sequences, relations, tag_entities


def tagged(spark, sentence, domain="methods_tooling", **more):
    rows = spark.createDataFrame([(sentence, domain)], "sentence string, research_domain string")
    return {(e["entity_type"], e["entity_name"]) for e in tag_entities(rows, **more).first()["entities"]}


def test_cells_models_and_precedence(spark):
    got = tagged(spark, "Activated microglia and reactive astrocytes were seen in HEK293 cells of a mouse.")
    assert {("neural_cell", "MICROGLIA"), ("neural_cell", "ASTROCYTES"), ("model", "HEK293"), ("model", "MOUSE")} == got
    assert ("neural_cell", "NEURONS") in tagged(spark, "Dopaminergic neurons were depleted.")
    assert tagged(spark, "The weather was sunny and warm with pleasant winds.") == set()
    assert tagged(spark, None) == set()


def test_short_targets_need_context(spark):
    assert ("target", "TAU") in tagged(spark, "tau protein rose", targets=["tau"])
    assert tagged(spark, "tau rose", targets=["tau"]) == set()


def test_construction_groups(spark):
    got = tagged(spark, "The concrete beam showed shear failure and moisture after the tensile test.", "construction_science")
    assert {("failure_mode", "SHEAR FAILURE"), ("material", "CONCRETE"), ("system", "BEAM"), ("environment", "MOISTURE"), ("test_method", "TENSILE TEST")} <= got
    names = [n for _, n in got]
    assert len(names) == len({n.replace(" ", "") for n in names})


def test_peptides(spark):
    df = spark.createDataFrame([("The sequence was GGGSGGGSGGG (SEQ ID NO: 1) in the CLIMATE.",)], "s string")
    assert df.select(peptide_sequences(F.col("s"))).first()[0] == ["GGGSGGGSGGG"]


def test_dictionary_needs_boundaries(spark):
    rows = spark.createDataFrame([(1, "Fly ash, slag and steelwork."), (2, None), (3, ""), (4, "fly  ash-free STEEL")], "id int, sentence string")
    lexicon = spark.createDataFrame([("fly ash", "material"), ("steel", "material"), ("", "x"), (None, "x")], "term string, kind string")
    got = {(r["id"], r["term"]) for r in dictionary_match(rows, lexicon, "id").collect()}
    assert got == {(1, "fly ash"), (4, "steel")}


def test_relations(spark):
    rows = spark.createDataFrame([("Alpha was more stable than Beta. Beta is an analog of Alpha.", [("Alpha",), ("Beta",)])], "sentence string, entities array<struct<entity_name:string>>")
    got = {tuple(r) for r in relations(rows).collect()}
    assert got == {("more_stable_than", "Alpha", "Beta"), ("analog_of", "Beta", "Alpha")}


def test_integrated_extraction_uses_fallback_when_thin(spark):
    rows = spark.createDataFrame([("Reinforced concrete cracking and corrosion of the Main Bridge Deck X12.",), ("",), (None,)], "sentence string")
    out = E.integrated_entities(rows).collect()
    first = out[0]["entities"]
    assert ("material", "CONCRETE") in {(e["entity_type"], e["entity_name"]) for e in first}
    assert all(0 < e["confidence"] <= 1 for e in first)
    assert [r["entities"] for r in out[1:]] == [[], []]
    stats = E.coverage_stats(E.integrated_entities(rows)).first()
    assert stats["n_entities"] == len(first)


def test_sequences_must_stand_alone(spark):
    df = spark.createDataFrame([("sequence: ACDEFGHIKL.",), ("sequence: AAAAAAAAAA",), ("peptide: ACDEFGHIKLO",)], "s string")
    assert [len(r[0]) for r in df.select(E.sequence_stage(F.col("s"))).collect()] == [1, 0, 0]
