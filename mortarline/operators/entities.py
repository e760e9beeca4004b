"""Entities in sentences: dictionaries, keywords, sequences, and rules for one name once."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortarline.functions import phrases as P
from mortarline.functions.dialect import SPARK
from mortarline.functions.normalize import exploded

def name_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"[\s\-_,.;:]+", "")


def _words(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def dictionary_match(sentences: DataFrame, lexicon: DataFrame, key: str, sentence: str = "sentence") -> DataFrame:
    """(key, term, …lexicon columns): the terms that stand in a sentence between non-letters.

    The distinct words of the sentences meet the longest word of each term in an
    equi-join that carries keys alone, so a lexicon of any size is no broadcast.
    A term of one word is thereby found; terms of several words are looked up
    once more in the text of the sentences that have their word.  Each pair is
    returned once; terms without a letter or digit, and null texts, match nothing.
    """
    rows = sentences.select(key, sentence).where(F.col(sentence).isNotNull())
    words = exploded(rows, F.array_distinct(_words(F.col(sentence))), "_word", key)
    terms = lexicon.where(F.col("term").isNotNull()).withColumn("_ws", _words(F.col("term"))).where(F.size("_ws") > 0)
    longest = F.element_at(F.array_sort(F.transform("_ws", lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))), 1)["w"]
    terms = terms.withColumn("_word", longest).withColumn("_alone", F.lower("term") == longest).drop("_ws")
    met = words.join(terms, "_word").drop("_word")
    alone = met.where("_alone").drop("_alone")
    inside = met.where("not _alone").drop("_alone").join(rows, key)
    low = F.lower(F.col(sentence))
    exact = F.contains(low, F.lower("term")) & F.expr(f"lower(`{sentence}`) RLIKE concat('(?<![\\\\p{{L}}\\\\p{{N}}])\\\\Q', lower(term), '\\\\E(?![\\\\p{{L}}\\\\p{{N}}])')")
    return alone.unionByName(inside.where(exact).drop(sentence)).distinct()


ENTITIES = "array<struct<entity_type:string,entity_name:string,entity_variant:string,role:string>>"


def word_pattern(phrase: str) -> str:
    return r"\b" + re.sub(r"([\\.^$*+?{}\[\]|()])", r"\\\1", phrase) + r"\b"


Entry = tuple[str, str, str | None, str | None, str, str]


def standing_in(entries: list[Entry], s: Column) -> Column:
    """The entries (type, name, variant, role, gate, pattern) whose gate is part of the text and whose pattern it matches.

    Patterns are constants, compiled once, and run only behind their gate.
    """
    struct = lambda t, n, v, r: F.struct(F.lit(t).alias("entity_type"), F.lit(n).alias("entity_name"), F.lit(v).cast("string").alias("entity_variant"), F.lit(r).cast("string").alias("role"))
    return F.array_compact(F.array(*[F.when(F.contains(s, F.lit(gate)) & s.rlike(pattern), struct(t, n, v, r)) for t, n, v, r, gate, pattern in entries]))


def _keywords(kind: str, variant: str, role: str | None, keywords: list[str]) -> list[tuple]:
    return [(kind, k.upper(), variant, role, k, word_pattern(k)) for k in keywords]


def model_variant(name: Column) -> Column:
    n = F.lower(name)
    return F.when(n.rlike(r"\d|-"), "cell_line").when(n.isin("mouse", "mice", "rat", "human"), "organism").when(n.contains("organoid") | n.contains("3d"), "3d_model").otherwise("unknown")


def peptide_sequences(sentence: Column) -> Column:
    """Names of amino-acid sequences: seven or more of their letters, or capitals with a SEQ ID NO."""
    plain = F.regexp_extract_all(sentence, F.lit(rf"\b[{P.AMINO_ACIDS}]{{7,}}\b"), F.lit(0))
    cited = F.regexp_extract_all(sentence, F.lit(r"([A-Z]{5,})\s*\(SEQ ID NO: \d+\)"), F.lit(1))
    letters = lambda x: F.regexp_replace(x, f"[^{P.AMINO_ACIDS}]", "")
    likely = lambda x: x.rlike(f"^[{P.AMINO_ACIDS}]{{7,}}$") | (F.upper(sentence).contains("SEQ ID NO") & (F.length(x) >= 5) & (F.length(letters(x)) / F.length(x) >= 0.8) & (F.size(F.array_distinct(F.split(letters(x), ""))) >= 3))
    return F.filter(F.array_distinct(F.concat(plain, cited)), lambda x: ~x.isin(*P.PEPTIDE_DENYLIST) & likely(x))


def _peptides(sentence: Column) -> Column:
    return F.transform(peptide_sequences(sentence), lambda x: F.struct(F.lit("peptide").alias("entity_type"), x.alias("entity_name"), F.lit("sequence").alias("entity_variant"), F.lit("tested").alias("role")))


def one_name_once(entities: Column) -> Column:
    """The first entity of each name, punctuation and case aside, whatever its type."""
    # keys are made once and bound by a one-element array, else the lambda would make them again for every element
    keyed = F.array(F.struct(entities.alias("es"), F.transform(entities, lambda e: name_key(e["entity_name"])).alias("keys")))
    firsts = F.transform(keyed, lambda b: F.filter(b["es"], lambda e, i: F.array_position(b["keys"], F.get(b["keys"], i)) == i + 1))
    return F.get(firsts, F.lit(0))


def biomedical_entities(sentence: Column, s: str = "_s", compounds: list[str] | None = None, targets: list[str] | None = None) -> Column:
    """Compounds, targets, stem cells, neural cells, models and peptides, in that order of precedence.

    ``compounds`` and ``targets`` are short lists of terms; long dictionaries go
    through dictionary_match.  Targets of up to three letters need a word of
    biology in the sentence.
    """
    text = F.col(s)
    near = F.expr(SPARK.has(s, P.TARGET_CONTEXT_TERMS))
    always = [t for t in targets or [] if len(t) > 3]
    models = [("model", k.upper(), "cell_line" if k in ("hela", "hek293") else "organism", None, k, word_pattern(k)) for k in P.FALLBACK_MODELS]
    first = [*_keywords("compound", "small_molecule", "tested", compounds or []), *_keywords("target", "protein", "target", always)]
    short = _keywords("target", "protein", "target", [t for t in targets or [] if len(t) <= 3])
    rest = [*_keywords("stem_cell", "stem_cell", None, P.STEM_CELL_KEYWORDS), *_keywords("neural_cell", "neural_cell", None, P.NEURAL_CELL_KEYWORDS), *models]
    groups = [standing_in(first, text)] if compounds or always else []
    if targets and len(always) < len(targets):
        groups.append(F.when(near, standing_in(short, text)).otherwise(F.array().cast(ENTITIES)))
    return one_name_once(F.concat(*groups, standing_in(rest, text), _peptides(sentence)))


def specific_failures(s: Column) -> Column:
    """Names such as 'SHEAR FAILURE' that a kind and a cause of failure make together."""
    kinds, causes = "|".join(P.FAILURE_KINDS), "|".join(P.FAILURE_CAUSES)
    full, by = f"({causes}) ({kinds}|spalling)", f"({kinds}|spalling) (due to|from|by) (shear|fatigue|stress|thermal|creep|corrosion)"
    found = [F.regexp_extract_all(s, F.lit(p), F.lit(0)) for p in (full, by, r"([a-z]+) (fracture|crack|failure|collapse)")]
    of = F.transform(F.regexp_extract_all(s, F.lit(r"(fracture|crack|failure|collapse) of ([a-z]+)"), F.lit(0)), lambda x: F.replace(x, F.lit(" of "), F.lit(" ")))
    return F.transform(F.concat(*found, of), F.upper)


def construction_entities(s: str = "_s") -> Column:
    """Specific failures first, then the groups of construction terms; a term of several words also matches by all its words."""
    text = F.col(s)
    failures = F.transform(specific_failures(text), lambda x: F.struct(F.lit("failure_mode").alias("entity_type"), x.alias("entity_name"), F.lit(None).cast("string").alias("entity_variant"), F.lit("failure_mode").alias("role")))
    entries = []
    for kind, terms in P.CONSTRUCTION_GROUPS.items():
        for t in terms:
            tokens = t.split()
            spread = "|^(?s)" + "".join(f"(?=.*{word_pattern(x)})" for x in tokens) if len(tokens) > 1 and len(t) > 4 else ""
            entries.append((kind, t.upper(), None, kind, tokens[0], word_pattern(t) + spread))
    return one_name_once(F.concat(failures, standing_in(entries, text)))


def tag_entities(rows: DataFrame, sentence: str = "sentence", domain: str = "research_domain", compounds: list[str] | None = None, targets: list[str] | None = None) -> DataFrame:
    """``rows`` with ``entities``: construction terms in that domain, biomedical ones in all others."""
    rows = rows.withColumn("_s", F.lower(F.coalesce(F.col(sentence), F.lit(""))))
    both = F.when(F.col(domain) == "construction_science", construction_entities()).otherwise(biomedical_entities(F.coalesce(F.col(sentence), F.lit("")), compounds=compounds, targets=targets))
    return rows.withColumn("entities", both).drop("_s")


def relations(rows: DataFrame, sentence: str = "sentence", entities: str = "entities", keep: tuple[str, ...] = ()) -> DataFrame:
    """(…keep, relationship_type, entity_1, entity_2): comparisons between two entities of one sentence."""
    pairs = rows.select(*keep, sentence, F.explode(f"{entities}.entity_name").alias("entity_1"), F.col(f"{entities}.entity_name").alias("_names"))
    pairs = pairs.where(F.col(sentence).rlike("(?i)than|analog of|derivative of")).select(*keep, sentence, "entity_1", F.explode("_names").alias("entity_2"))
    hits = [F.when(F.expr(f"`{sentence}` RLIKE concat('(?i)\\\\Q', entity_1, '\\\\E\\\\s+', {SPARK.text(p)}, '\\\\s+\\\\Q', entity_2, '\\\\E')"), F.lit(name)) for name, p in P.RELATIONS]
    return exploded(pairs, F.array_compact(F.array(*hits)), "relationship_type", *keep, "entity_1", "entity_2").select(*keep, "relationship_type", "entity_1", "entity_2").distinct()
