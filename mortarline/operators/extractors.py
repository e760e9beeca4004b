"""Scored entity extraction: ontology, context and sequence stages, a fallback for thin results, and both together."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mortarline.functions import phrases as P
from mortarline.functions.dialect import SPARK
from mortarline.functions.normalize import fold_case

ENTITY = "struct<entity_type:string,entity_name:string,entity_variant:string,confidence:double,source:string>"

# Labelled sequences, and names that are no entity.
SEQUENCES = [r"(?i)sequence[:\s]+([{aa}]{8,100})", r"(?i)seq[:\s]+([{aa}]{8,100})", r"(?i)peptide[:\s]+([{aa}]{8,100})", r"(?i)residues?\s+\d+[-–]\d+[:\s]+([{aa}]{8,100})", r"(?i)[nc]-terminus[:\s]+([{aa}]{8,100})", r"(?i)\(([{aa}]{8,100})\)", r"(?i)\[([{aa}]{8,100})\]"]
JUNK = [r"^[\[\]{}()]$", r"^[^\w\s]+$", r"^\d+$", r"^[a-z]{1,2}$", r"^indirect.*$", r"^unknown.*$", r"^unspecified.*$"]
BIOMEDICAL_WORDS = ["peptide", "compound", "target", "pathway", "indication", "assay", "protein", "gene"]
CONSTRUCTION_WORDS = ["concrete", "steel", "wood", "glass", "brick", "masonry", "foundation", "beam", "column"]


def plain_text(c: Column) -> Column:
    """Decomposed, without combining marks, one kind of hyphen, single spaces, lower case."""
    decomposed = F.when(c.rlike(r"[^\x00-\x7F]"), F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("decompose"), c, F.lit(True))).otherwise(c)
    s = F.regexp_replace(F.regexp_replace(decomposed, r"\p{Mn}+", ""), "[-–—]", "-")
    return fold_case(F.trim(F.regexp_replace(s, r"(?U)\s+", " ")))


def valid_for_domain(name: Column, kind: Column, domain: str) -> Column:
    """No junk, and nothing of the other field."""
    n = F.lower(F.trim(name))
    ok = ~n.rlike("|".join(JUNK))
    words = BIOMEDICAL_WORDS if domain == "construction_science" else CONSTRUCTION_WORDS if domain in ("methods_tooling", "biohacking_longevity") else []
    if words:
        ok = ok & ~n.rlike("|".join(words))
    return ok & ~kind.isin(*P.BIOMEDICAL_TYPES) if domain == "construction_science" else ok


def _entity(kind: Column, name: Column, variant: Column | None, confidence: float, source: str) -> Column:
    return F.struct(kind.alias("entity_type"), name.alias("entity_name"), (variant if variant is not None else F.lit(None).cast("string")).alias("entity_variant"), F.lit(confidence).alias("confidence"), F.lit(source).alias("source"))


def _none() -> Column:
    return F.array().cast(f"array<{ENTITY}>")


def _suits(name: str, kind: str, domain: str) -> bool:
    """valid_for_domain for a name that is known when the query is built."""
    n = name.lower().strip()
    if any(re.match(p, n) for p in JUNK):
        return False
    words = BIOMEDICAL_WORDS if domain == "construction_science" else CONSTRUCTION_WORDS if domain in ("methods_tooling", "biohacking_longevity") else []
    return not any(w in n for w in words) and not (domain == "construction_science" and kind in P.BIOMEDICAL_TYPES)


def preceding_type(name: str, kind: str, domain: str = "construction_science") -> str:
    """The type that a name has whatever list it stands in: the first group of the domain that holds it, else its own."""
    groups = P.DOMAIN_TYPES.items() if domain == "construction_science" else ()
    return next((t for t, names in groups if name.lower().strip() in names), kind)


Constant = tuple[str, str, str | None, float, str, str]


def _present(s: str, entries: Sequence[Constant]) -> Column:
    """The (type, name, variant, confidence, source, part) entries whose part the text has."""
    if not entries:
        return _none()
    text = F.col(s)
    return F.array_compact(F.array(*[F.when(F.contains(text, F.lit(part)), _entity(F.lit(kind), F.lit(name), F.lit(variant).cast("string"), score, source)) for kind, name, variant, score, source, part in entries]))


def ontology_stage(s: str, ontology: Mapping[str, Sequence[str]], domain: str = "construction_science") -> Column:
    """Terms of an ontology that are part of the text (0.8), and those of which another writing is (0.6)."""
    writings = P.ABBREVIATIONS_OF_TERMS if domain == "construction_science" else {}
    entries: list[Constant] = []
    for kind, terms in ontology.items():
        for t in terms:
            if _suits(t, kind, domain):
                entries.append((preceding_type(t, kind, domain), t.upper(), None, 0.8, "ontology_exact", t.lower()))
            for w in dict.fromkeys(writings.get(t.lower(), [])):
                if w.lower() != t.lower() and _suits(w, kind, domain):
                    entries.append((preceding_type(w, kind, domain), t.upper(), w.upper(), 0.6, "ontology_abbreviation", w.lower()))
    return _present(s, entries)


#: By list of names: type, variant, confidence and source of an entity found by it.
SEED_KINDS = {"assays": ("assay", "assay", 0.85, "json_assay"), "metrics": ("assay", "metric", 0.70, "json_metric"), "pathways": ("pathway", "pathway", 0.80, "json_pathway"), "indications": ("indication", "disease", 0.75, "json_indication")}


def seed_stage(s: str, seeds: Mapping[str, Sequence[str]], domain: str | None = None, source: str | None = None) -> Column:
    """Names of seed lists (assays, metrics, pathways, indications) that are part of the text, each type, name and variant once.

    With ``domain`` only names that suit it; ``source`` replaces the list's own.
    """
    entries = [(kind, n, variant, score, source or own, n.lower()) for key, (kind, variant, score, own) in SEED_KINDS.items() for n in dict.fromkeys(seeds.get(key, ())) if n and (domain is None or _suits(n, kind, domain))]
    return _present(s, entries)


def context_stage(s: str, field: str) -> Column:
    """Words next to a phrase that speaks of their kind (0.5)."""
    parts = []
    for context, triggers in P.CONTEXT_PATTERNS[field].items():
        if context not in P.CONTEXT_WORDS:
            continue
        kind, words = P.CONTEXT_WORDS[context]
        found = F.concat(*[F.regexp_extract_all(F.col(s), F.lit(w), F.lit(1)) for w in words])
        parts.append(F.when(F.expr(" OR ".join(SPARK.matches(s, t) for t in triggers)), _as_entities(found, kind, None, 0.5, "context_pattern")).otherwise(_none()))
    return F.concat(*parts) if parts else _none()


def _as_entities(names: Column, kind: str, variant: str | None, confidence: float, source: str) -> Column:
    v = F.lit(variant).cast("string")
    return F.transform(names, lambda w: _entity(F.lit(kind), F.upper(w), v, confidence, source))


def sequence_stage(sentence: Column) -> Column:
    """Labelled peptide sequences of 8 to 100 residues with four different ones, not part of a word (0.9)."""
    found = F.concat(*[F.transform(F.regexp_extract_all(sentence, F.lit(p.replace("{aa}", P.AMINO_ACIDS)), F.lit(1)), F.upper) for p in SEQUENCES])
    good = F.filter(F.array_distinct(found), lambda x: F.size(F.array_distinct(F.split(x, ""))) >= 4)
    at = lambda x: F.call_function("locate", x, F.upper(sentence))
    letter = lambda c: c.rlike(r"^\p{L}$")
    alone = F.filter(good, lambda x: ~letter(F.substr(sentence, at(x) - 1, F.when(at(x) > 1, 1).otherwise(0))) & ~letter(F.substr(sentence, at(x) + F.length(x), F.lit(1))))
    return F.transform(alone, lambda x: _entity(F.lit("peptide"), x, F.lit("sequence"), 0.9, "sequence_pattern"))


def keep_most_confident(entities: Column) -> Column:
    """One entity per type, name and variant: the most confident, ties by source."""
    ordered = F.array_sort(F.transform(entities, lambda e: F.struct((-e["confidence"]).alias("o"), e.alias("e"))))
    key = lambda x: F.concat_ws("\u0001", x["e"]["entity_type"], x["e"]["entity_name"], F.coalesce(x["e"]["entity_variant"], F.lit("\u0002")))
    bound = F.array(F.struct(ordered.alias("xs")))
    keyed = F.transform(bound, lambda b: F.struct(b["xs"].alias("xs"), F.transform(b["xs"], key).alias("keys")))
    firsts = F.transform(keyed, lambda b: F.transform(F.filter(b["xs"], lambda x, i: F.array_position(b["keys"], F.get(b["keys"], i)) == i + 1), lambda x: x["e"]))
    return F.get(firsts, F.lit(0))


def fallback_candidates(sentence: Column, s: str = "_s", field: str = "construction") -> Column:
    """Array of struct(text, position, confidence, source): phrases of the field (0.6), capitalized phrases (0.4), codes (0.3).

    A text that occurs again counts once, with its first position.
    """
    row = lambda conf, source: lambda x: F.struct(x.alias("text"), (F.call_function("locate", F.lower(x), F.lower(sentence)) - 1).alias("position"), F.lit(conf).alias("confidence"), F.lit(source).alias("source"))
    all_of = lambda patterns: F.array_distinct(F.concat(*[F.regexp_extract_all(F.col(s), F.lit(f"(?i){p}"), F.lit(0)) for p in patterns]))
    phrases = [F.transform(all_of(ps), row(0.6, f"pattern_{kind}")) for kind, ps in P.FALLBACK_PATTERNS[field].items()]
    capitals = F.filter(F.regexp_extract_all(sentence, F.lit(P.CAPITALIZED), F.lit(0)), lambda x: ~F.lower(x).rlike("|".join(P.NO_ENTITY_PHRASES)))
    codes = F.regexp_extract_all(sentence, F.lit(P.ENTITY_CODES), F.lit(0))
    return F.concat(*phrases, F.transform(F.array_distinct(capitals), row(0.4, "capitalized_phrase")), F.transform(F.array_distinct(codes), row(0.3, "alphanumeric_code")))


def fallback_types(sentence: Column, s: str = "_s", known: Column | None = None, field: str = "construction") -> Column:
    """Candidates with a type: the first group of which the text has two words, else the first whose pattern the candidate has; others are dropped.

    The words of a group are compared as they are written with the text in lower
    case, so a word in capitals matches nothing.
    """
    by_words = F.coalesce(*[F.when(F.expr(f"{SPARK.points((SPARK.has(s, [w]), 1) for w in words)} >= 2"), F.lit(g)) for g, words in P.FALLBACK_KEYWORDS[field].items()])
    by_pattern = lambda x: F.coalesce(*[F.when(F.lower(x).rlike("(?i)" + "|".join(ps)), F.lit(g)) for g, ps in P.FALLBACK_PATTERNS[field].items()])
    # the text's group is found once, not for every candidate
    bound = F.array(F.struct(by_words.alias("g"), fallback_candidates(sentence, s, field).alias("cs")))
    typed = F.flatten(F.transform(bound, lambda b: F.transform(b["cs"], lambda c: _entity_of(c, F.coalesce(b["g"], by_pattern(c["text"]))))))
    out = F.filter(typed, lambda e: e["entity_type"].isNotNull())
    if known is not None:
        out = F.filter(out, lambda e: ~F.exists(known, lambda k: F.lower(k["entity_name"]) == F.lower(e["entity_name"])))
    return out


def _entity_of(c: Column, kind: Column) -> Column:
    return F.struct(kind.alias("entity_type"), c["text"].alias("entity_name"), F.lit(None).cast("string").alias("entity_variant"), c["confidence"].alias("confidence"), c["source"].alias("source"))


def integrated_entities(rows: DataFrame, sentence: str = "sentence", domain: str = "construction_science", ontology: Mapping[str, Sequence[str]] | None = None, fewest: int = 3, seeds: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``rows`` with ``entities`` (see ENTITY) and ``fallback_used``.

    The scored stages first; where they find fewer than ``fewest`` entities, the
    fallback's are added; each entity once, the most confident.  Only entities
    that suit the domain are kept.  ``ontology`` has terms by type (for
    construction the built-in groups by default), ``seeds`` name lists for the
    other domains.
    """
    field = "construction" if domain == "construction_science" else "biomedical"
    ontology = ontology if ontology is not None else P.CONSTRUCTION_GROUPS if field == "construction" else {}
    text = F.coalesce(F.col(sentence), F.lit(""))
    rows = rows.withColumn("_s", plain_text(text))
    seeded = seed_stage("_s", seeds or {}, domain) if field == "biomedical" else _none()
    staged = F.concat(ontology_stage("_s", ontology, domain), seeded, context_stage("_s", field), sequence_stage(text))
    rows = rows.withColumn("_e", keep_most_confident(F.filter(staged, lambda e: valid_for_domain(e["entity_name"], e["entity_type"], domain))))
    rows = rows.withColumn("fallback_used", F.size("_e") < fewest)
    both = F.when(F.col("fallback_used"), keep_most_confident(F.concat("_e", fallback_types(text, "_s", F.col("_e"), field)))).otherwise(F.col("_e"))
    return rows.withColumn("entities", both).drop("_s", "_e")


def coverage_improvement(before: Column, after: Column) -> Column:
    """struct(original_count, enhanced_count, new_entities, coverage_improvement in percent, new_types) of two arrays of entities."""
    n, m = F.size(before), F.size(after)
    percent = F.when(n > 0, F.round((m - n) / n * 100, 2)).otherwise(0.0)
    kinds = F.array_except(F.transform(after, lambda e: e["entity_type"]), F.transform(before, lambda e: e["entity_type"]))
    return F.struct(n.alias("original_count"), m.alias("enhanced_count"), (m - n).alias("new_entities"), percent.alias("coverage_improvement"), F.array_sort(kinds).alias("new_types"))


def integrated_role(kind: Column, confidence: Column) -> Column:
    return F.when(confidence >= 0.8, F.when(kind.isin("material", "compound", "target", "assay"), "primary").otherwise("context")).when(confidence >= 0.5, F.when(kind.isin("system", "environment", "pathway"), "context").otherwise("supporting")).otherwise("supporting")


def event_confidence(entities: Column, s: str = "_s") -> Column:
    """0 to 1 from the types found and three cues; see event_confidence_label."""
    weight = lambda e: F.coalesce(F.try_element_at(F.create_map(*[x for k, v in P.TYPE_WEIGHTS.items() for x in (F.lit(k), F.lit(v))]), e["entity_type"]), F.lit(0.05))
    base = F.aggregate(entities, F.lit(0.0), lambda acc, e: acc + weight(e) * F.least(F.lit(1.0), e["confidence"]))
    cues = [["ic50", "ec50", "half-life", "auc"], ["lc-ms", "lc-ms/ms", "spr", "bli", "triple quadrupole", "quantitation"], ["in vivo", "clinical", "randomized", "phase i", "phase ii"]]
    return F.least(F.lit(1.0), base + sum((F.when(F.expr(SPARK.has(s, c)), 0.1).otherwise(0.0) for c in cues), F.lit(0.0)))


def event_confidence_label(score: Column) -> Column:
    return F.when(score >= 0.75, "high").when(score >= 0.45, "med").otherwise("low")


def coverage_stats(rows: DataFrame) -> DataFrame:
    """Over all texts: entities, shares of confidence, and how often the fallback was used.  ``rows`` as from integrated_entities."""
    flat = rows.select("fallback_used", F.explode_outer("entities").alias("e"))
    return flat.agg(F.count("e").alias("n_entities"), F.count_if(F.col("e.confidence") >= 0.8).alias("high"), F.count_if((F.col("e.confidence") >= 0.5) & (F.col("e.confidence") < 0.8)).alias("medium"), F.count_if(F.col("e.confidence") < 0.5).alias("low"), F.round(F.avg("e.confidence"), 4).alias("mean_confidence"), F.count_distinct("e.entity_type").alias("n_types"))


def expected_coverage(found: Column, expected: Column) -> Column:
    """struct(exact, partial): shares of expected names that are among the found ones, or part of one."""
    low = lambda c: F.transform(c, F.lower)
    exact = F.size(F.array_intersect(low(found), low(expected)))
    partial = F.size(F.filter(low(expected), lambda x: F.exists(low(found), lambda y: F.contains(y, x) | F.contains(x, y))))
    n = F.greatest(F.size(expected), F.lit(1))
    return F.struct((exact / n).alias("exact"), (partial / n).alias("partial"))
