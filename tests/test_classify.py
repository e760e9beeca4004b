"""Sentence functions, classifiers and lenses on literal sentences."""

import pytest
from pyspark.sql import functions as F

from mortarline.functions import classify as C
from mortarline.functions import lenses as X
from mortarline.functions.dialect import SPARK as D


def labels(spark, *sentences):
    rows = spark.createDataFrame([(i, s, False) for i, s in enumerate(sentences)], "id int, sentence string, has_entity boolean")
    return [r.asDict() for r in C.classify(rows).orderBy("id").collect()]


def test_sentences_keep_abbreviations(spark):
    df = spark.createDataFrame([("Dr. Smith et al. saw it,\ne.g. here. See Fig. 2! Why?  Because.",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(F.expr(C.sentences(D, "t"))).collect()]
    assert got == [["Dr. Smith et al. saw it, e.g. here.", "See Fig. 2!", "Why?", "Because."], [], None]


@pytest.mark.parametrize(
    ("sentence", "key", "value"),
    [
        ("The peptide was rapidly degraded.", "failure_reason", "stability_failure"),
        ("It showed no significant change.", "failure_reason", "no_activity"),
        ("The lead was abandoned.", "decision", "abandoned"),
        ("Results were replicated.", "decision", "replicated"),
        ("It failed to work but was improved.", "outcome", "negative"),
        ("Strength improved.", "outcome", "positive"),
        ("Tested in patients and in vivo.", "stage", "clinical"),
        ("A mouse was used.", "stage", "in_vivo"),
        ("Nitrosamine was found.", "event_type", "regulatory_risk"),
        ("It was measured by LC-MS, an expensive way.", "event_type", "cost_tradeoff"),
        ("It was measured by mass spec.", "event_type", "method_evaluation"),
        ("We conclude so.", "evidence_strength", "strong"),
        ("It may be so.", "evidence_strength", "weak"),
        ("The weather was fine.", "event_type", "other"),
        ("IC50 of 12 nM.", "has_measurement", True),
    ],
)
def test_labels(spark, sentence, key, value):
    assert labels(spark, sentence)[0][key] == value


def test_null_sentence_has_default_labels(spark):
    row = labels(spark, None)[0]
    assert (row["failure_reason"], row["outcome"], row["tags"], row["confidence"], row["keep"]) == ("unknown", "unknown", [], "low", 0)


def test_measurements_take_all_matches(spark):
    df = spark.createDataFrame([("ic50 of 12.5 nm and ic50 of 3 mm, half-life 4 hours",)], "s string")
    got = df.select(F.expr(C.measurements(D, "s"))).first()[0]
    assert [m.split("|")[:3] for m in got] == [["ic50", "12.5", "nm"], ["ic50", "3", "mm"], ["half_life", "4", "hour"]]


def test_phrase_gate_matches_within_words(spark):
    df = spark.createDataFrame([("the atoms moved",), ("nothing here",)], "s string")
    assert [r[0] for r in df.select(F.expr(C.phrase_gate(D, "s"))).collect()] == [True, False]


def test_boilerplate(spark):
    df = spark.createDataFrame([("canadian climate normals 1951-1980 volume pressure temperature humidity climate zone",), ("the wall failed under load",)], "s string")
    assert [r[0] for r in df.select(F.expr(C.boilerplate(D, "s"))).collect()] == [True, False]


LENS_CASES = [
    ("Cracking was observed in the concrete slab due to freeze-thaw cycling.", "failure", "negative"),
    ("Buckling of the steel column was caused by overload during the storm.", "failure", "negative"),
    ("The conference was well attended by delegates.", "failure", None),
    ("Concrete specimens showed improved compressive strength of 45 MPa after curing.", "materials", "positive"),
    ("Modulus decreased from 30 GPa to 22 GPa after high-temperature exposure.", "materials", "negative"),
    ("Specimens were tested to characterize long-term behaviour.", "materials", None),
    ("Energy consumption was significantly reduced after retrofitting the facade.", "building_physics", "positive"),
    ("Flood vulnerability was exacerbated by increased storm surge intensity.", "climate", "negative"),
    ("The wall assembly meets the IECC 2021 thermal requirements.", "compliance", "positive"),
    ("The beam is non-compliant with ACI 318 shear reinforcement provisions.", "compliance", "negative"),
]


@pytest.mark.parametrize("name", X.LENSES)
def test_lenses(spark, name):
    cases = [(s, o) for s, n, o in LENS_CASES if n == name]
    rows = spark.createDataFrame([(s,) for s, _ in cases] + [(None,)], "sentence string")
    got = {r["sentence"]: r["outcome"] for r in X.apply_lens(rows, name).collect()}
    assert got == {s: o for s, o in cases if o}


def test_lens_stack_ranks_and_takes_injected_order(spark):
    rows = spark.createDataFrame([("Concrete specimens complied with ASTM C150 and improved compressive strength to 45 MPa.",)], "sentence string")
    ranked = X.lens_stack(rows).orderBy("rank").collect()
    assert {"materials", "compliance"} <= {r["lens"] for r in ranked}
    assert [r["confidence"] for r in ranked] == sorted((r["confidence"] for r in ranked), key=["high", "med", "low"].index)
    turned = X.lens_stack(rows, confidence_rank={"low": 9, "med": 5, "high": 1}).orderBy("rank").collect()
    assert turned[0]["confidence"] != "high" or all(r["confidence"] == "high" for r in turned)
    with pytest.raises(ValueError, match="unknown lens"):
        X.lens(D, "nope", "s")


def test_units(spark):
    df = spark.createDataFrame([("the beam failed at 30 mpa",), ("shrinkage was 5% after 28 days",), ("no measurements here at all",)], "s string")
    assert [r[0] for r in df.select(F.expr(X.unit_signal(D, "s"))).collect()] == [True, True, False]
