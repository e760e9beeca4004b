"""A corpus of sentences made from order lines, the same in every engine.

Subjects, findings, contexts and templates are picked by key arithmetic, so that
every class, both sides of every threshold and the case without any match occur.
It grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mortarline.functions.dialect import SPARK, Dialect
from mortarline.plans.session import spread, table

SUBJECTS = ["Quercetin", "The EGFR receptor", "Concrete specimens", "The steel beam", "Fly ash concrete", "mTOR signaling", "The wall assembly", "Peptide ACDEFGHIK", "Microglia", "The HEK293 cell line", "Brick masonry"]
FINDINGS = [
    "was rapidly degraded", "showed no significant activity", "was cytotoxic in the assay", "was not reproducible", "required costly manufacturing and scale-up", "raised a regulatory safety concern", "improved compressive strength to 45 MPa",
    "complies with ASTM C150 requirements", "does not meet ACI 318 provisions", "cracking was caused by overload", "failed to improve stability", "was optimized and validated by LC-MS/MS", "was abandoned and not pursued further", "demonstrated robust efficacy",
    "reduced energy consumption by 12 percent", "increased flood risk under RCP 8.5", "may suggest a trend", "was tested under freeze-thaw cycling", "contained traces of nitrosamine", "was discussed briefly", "was more stable than the analog", "needed an expensive mass spectrometry method", "showed a half-life of 6 hours",
]
CONTEXTS = ["in vivo", "in vitro", "in clinical patients", "in plasma samples", "in a mouse model"]
TEMPLATES = ["{s} {f} {c}.", "In this study, {s} {f}; IC50 of {m} nM {c}.", "{s} {f} with Kd = {m} nM, e.g. {c}!", "We observed that {s} {f} and a stability of {m} percent {c}.", "Table {m}: {s} {f}.", "{s} {f}, moisture content and thermal conductivity were measured {c}.", "Climate normals {m} {m} temperature humidity pressure table {s}.", "{s} was more stable than {o} {c}.", "{s} is an analog of {o}.", "Here {o} is  less toxic than {s}, while it {f}."]
DOMAINS = ["construction_science", "drug_discovery", "neuroscience_cognition", "methods_tooling"]


def _sentence(d: Dialect) -> str:
    s, f, c = d.at(SUBJECTS, f"l_partkey % {len(SUBJECTS)}"), d.at(FINDINGS, f"(l_orderkey * 7 + l_linenumber) % {len(FINDINGS)}"), d.at(CONTEXTS, f"l_suppkey % {len(CONTEXTS)}")
    m = d.string(d.truncated("l_quantity"))
    text = d.at(TEMPLATES, f"(l_orderkey * 3 + l_linenumber) % {len(TEMPLATES)}")
    o = d.at(SUBJECTS, f"(l_partkey + l_suppkey + 1) % {len(SUBJECTS)}")
    for mark, value in (("{s}", s), ("{o}", o), ("{f}", f), ("{c}", c), ("{m}", m)):
        text = f"replace({text}, '{mark}', {value})"
    return text


def columns(d: Dialect) -> list[str]:
    return [
        "l_orderkey AS doc_id",
        "l_linenumber AS page_number",
        "l_partkey AS part",
        f"{d.at(DOMAINS, f'l_partkey % {len(DOMAINS)}')} AS research_domain",
        f"{_sentence(d)} AS sentence",
        f"(l_suppkey % 3 = 0) AS has_entity",
    ]


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")).selectExpr(*columns(SPARK))


def corpus_sql(d: Dialect) -> str:
    return f"SELECT {', '.join(columns(d))} FROM lineitem"


def lower_corpus_sql(d: Dialect) -> str:
    """The corpus with its sentences in lower case."""
    return f"SELECT doc_id, page_number, part, research_domain, has_entity, sentence AS original, lower(sentence) AS sentence FROM ({corpus_sql(d)}) AS c"
