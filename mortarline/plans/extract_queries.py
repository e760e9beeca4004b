"""Queries of entity tagging, scored extraction and document metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.functions import phrases as P
from mortarline.functions.classify import explode_sentences, sentences
from mortarline.functions.dialect import DUCKDB as D
from mortarline.functions.normalize import exploded
from mortarline.operators import documents as M
from mortarline.operators import extractors as E
from mortarline.operators.analytics import entity_quality
from mortarline.operators.entities import peptide_sequences, relations, tag_entities
from mortarline.operators.identity import cleaned_doi, doi_in
from mortarline.plans.corpus import SUBJECTS, corpus, corpus_sql
from mortarline.plans.session import table

COMPOUNDS = ["quercetin", "rapamycin", "metformin", "resveratrol"]
TARGETS = ["mtor", "egfr", "ros", "tau", "bdnf"]


def entities_tagged(spark: SparkSession, d: str) -> DataFrame:
    rows = tag_entities(corpus(spark, d), compounds=COMPOUNDS, targets=TARGETS)
    return exploded(rows, F.col("entities"), "e", "research_domain").groupBy("research_domain", F.col("e.entity_type").alias("entity_type"), F.col("e.entity_name").alias("entity_name")).agg(F.count("*").alias("n"))


def neural_and_stem_sentences(spark: SparkSession, d: str) -> DataFrame:
    """Sentences of all pages that name a neural or a stem cell."""
    rows = explode_sentences(table(spark, d, "chunks").select("chunk_id", "chunk_text"), "chunk_text").select(F.lower("sentence").alias("s"))
    return rows.agg(F.count_if(F.col("s").rlike(r"\b(?:" + "|".join(P.NEURAL_CELL_KEYWORDS) + r")\b")).alias("n_neural"), F.count_if(F.col("s").rlike(r"\b(?:" + "|".join(P.STEM_CELL_KEYWORDS) + r")\b")).alias("n_stem"))


def peptides_found(spark: SparkSession, d: str) -> DataFrame:
    return exploded(corpus(spark, d), peptide_sequences(F.col("sentence")), "peptide", "research_domain").groupBy("research_domain", "peptide").agg(F.count("*").alias("n"))


def relationships(spark: SparkSession, d: str) -> DataFrame:
    """Comparisons between two subjects that stand in one sentence."""
    named = F.array_compact(F.array(*[F.when(F.contains("sentence", F.lit(n)), F.struct(F.lit(n).alias("entity_name"))) for n in SUBJECTS]))
    rows = corpus(spark, d).select("doc_id", "page_number", "sentence", named.alias("entities"))
    return relations(rows, keep=("doc_id", "page_number")).groupBy("relationship_type", "entity_1", "entity_2").agg(F.count("*").alias("n"))


def integrated_extraction(spark: SparkSession, d: str) -> DataFrame:
    rows = E.integrated_entities(corpus(spark, d))
    return exploded(rows, F.col("entities"), "e", "fallback_used").groupBy("fallback_used", "e.entity_type", "e.source").agg(F.count("*").alias("n"), F.round(F.avg("e.confidence"), 4).alias("confidence"))


def fallback_candidates(spark: SparkSession, d: str) -> DataFrame:
    rows = corpus(spark, d).withColumn("_s", F.lower("sentence"))
    return exploded(rows, E.fallback_candidates(F.col("sentence")), "c").groupBy("c.source", "c.text").agg(F.count("*").alias("n"))


def extraction_stats(spark: SparkSession, d: str) -> DataFrame:
    return E.coverage_stats(E.integrated_entities(corpus(spark, d)))


def quality_score(spark: SparkSession, d: str) -> DataFrame:
    found = exploded(E.integrated_entities(corpus(spark, d)), F.col("entities"), "e", "doc_id").select("doc_id", "e.entity_type", "e.confidence")
    return entity_quality(found, "doc_id")


def scored_event_confidence(spark: SparkSession, d: str) -> DataFrame:
    rows = E.integrated_entities(corpus(spark, d)).withColumn("_s", F.lower("sentence"))
    return rows.groupBy(E.event_confidence_label(E.event_confidence(F.col("entities"))).alias("label"), "fallback_used").agg(F.count("*").alias("n"))


def html_abstract(spark: SparkSession, d: str) -> DataFrame:
    """Abstracts of web pages in all six layouts, made from the documents."""
    text = F.regexp_replace(F.col("text"), "[<>]", " ")
    layouts = [('<div class="abstract"><p>', "</p></div>"), ('<div class="x abstractSection" ><div class="abstractSection">', "</div>"), ('<p id="a" class="abstract">', "</p>"), ('<div id="abstract">', "</div>"), ("<h2>Abstract</h2> <p>", "</p>"), ("<h2>ABSTRACT</h2>\n<p>", "</p>")]
    page = F.coalesce(*[F.when(F.col("doc_id") % 6 == i, F.concat(F.lit(f"<html><p>menu</p>{a}"), text, F.lit(f"{b}</html>"))) for i, (a, b) in enumerate(layouts)])
    pages = exploded(table(spark, d, "documents"), F.array(page), "page", "doc_id")
    return pages.select("doc_id", F.sha2(M.html_abstract(F.col("page")), 256).alias("abstract_hash"))


def page_links(spark: SparkSession, d: str) -> DataFrame:
    """Links to PDF files in a feed entry's text."""
    rows = table(spark, d, "sources").select("source_id", F.concat(F.coalesce("url", F.lit("")), F.lit(" see https://a.example/"), "pdf_file", F.lit(" and https://a.example/x.pdf?v=1#p2 <b>")).alias("summary"))
    return rows.select("source_id", F.array_join(M.pdf_links(F.col("summary")), " ").alias("links"))


def doi_clean(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "sources").where("doi is not null")
    return rows.select("source_id", cleaned_doi(F.trim("doi")).alias("cleaned"), doi_in(F.concat(F.lit("https://doi.org/"), F.trim("doi"), F.lit("."))).alias("found"))


def publication_years(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "sources").select("source_id", M.year_in(F.coalesce("publication_date", F.lit(""))).alias("year_found"))


def first_page_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Title, authors, DOI and year guessed from a first page made of a source's own values."""
    page = F.concat_ws("\n", F.lit("Journal of Examples, Vol. 3"), "title", "authors", F.lit("Institute of Materials, a@b.edu"), F.concat(F.lit("DOI: "), "doi"), F.concat(F.lit("Published "), F.col("year").cast("string")))
    rows = table(spark, d, "sources").select("source_id", page.alias("page"))
    return rows.select("source_id", *[c.alias(k) for k, c in M.first_page(F.col("page")).items()])


QUERIES = {
    f.__name__: f
    for f in (entities_tagged, neural_and_stem_sentences, peptides_found, relationships, integrated_extraction, fallback_candidates, extraction_stats, quality_score, scored_event_confidence, html_abstract, page_links, doi_clean, publication_years, first_page_metadata)
}
_AA = P.AMINO_ACIDS
D_WORD = r"\b{}\b"


def _tagged_sql() -> str:
    """Entities of each distinct sentence from one vocabulary table, the first of each name kept."""
    rows: list[tuple[str, str, str, bool]] = []
    rows += [("b", "compound", c, False) for c in COMPOUNDS]
    rows += [("b", "target", t, False) for t in TARGETS if len(t) > 3] + [("b", "target", t, True) for t in TARGETS if len(t) <= 3]
    rows += [("b", "stem_cell", k, False) for k in P.STEM_CELL_KEYWORDS] + [("b", "neural_cell", k, False) for k in P.NEURAL_CELL_KEYWORDS] + [("b", "model", k, False) for k in P.FALLBACK_MODELS]
    rows += [("c", kind, t, False) for kind, terms in P.CONSTRUCTION_GROUPS.items() for t in terms]
    values = ", ".join(f"({i}, '{field}', '{kind}', {D.text(t)}, {D.text(D_WORD.format(t.replace('.', '[.]')))}, {short}, [{', '.join(D.text(D_WORD.format(w)) for w in t.split())}])" for i, (field, kind, t, short) in enumerate(rows))
    kinds, causes = "|".join(P.FAILURE_KINDS), "|".join(P.FAILURE_CAUSES)
    found = [f"({causes}) ({kinds}|spalling)", f"({kinds}|spalling) (due to|from|by) (shear|fatigue|stress|thermal|creep|corrosion)", "([a-z]+) (fracture|crack|failure|collapse)"]
    failures = " || ".join([*(f"regexp_extract_all(s, {D.text(p)})" for p in found), "list_transform(regexp_extract_all(s, '(fracture|crack|failure|collapse) of ([a-z]+)'), lambda x: replace(x, ' of ', ' '))"])
    return f"""WITH c AS (SELECT research_domain, sentence, lower(sentence) AS s, CASE WHEN research_domain = 'construction_science' THEN 'c' ELSE 'b' END AS field, count(*) AS k FROM ({corpus_sql(D)}) AS q GROUP BY 1, 2),
vocabulary(o, field, kind, term, pattern, short, parts) AS (VALUES {values}),
hits AS (SELECT c.*, o, kind, upper(term) AS name FROM c JOIN vocabulary v ON v.field = c.field
  WHERE (regexp_matches(s, pattern) OR (len(parts) > 1 AND length(term) > 4 AND len(list_filter(parts, lambda x: regexp_matches(s, x))) = len(parts))) AND (NOT short OR regexp_matches(s, '{"|".join(P.TARGET_CONTEXT_TERMS)}'))
  UNION ALL SELECT *, -1, 'failure_mode', upper(unnest({failures})) FROM c WHERE field = 'c'
  UNION ALL SELECT *, 9999, 'peptide', unnest(list_distinct(regexp_extract_all(sentence, '\\b[{_AA}]{{7,}}\\b'))) FROM c WHERE field = 'b'),
firsts AS (SELECT * FROM hits WHERE name NOT IN ({", ".join(D.text(x) for x in P.PEPTIDE_DENYLIST)}) OR kind <> 'peptide' QUALIFY row_number() OVER (PARTITION BY research_domain, sentence, regexp_replace(lower(name), '[\\s_,.;:-]+', '', 'g') ORDER BY o) = 1)
SELECT research_domain, kind AS entity_type, name AS entity_name, sum(k)::BIGINT AS n FROM firsts GROUP BY 1, 2, 3"""




def _found_sql() -> str:
    """Entities of each distinct sentence by the scored stages and, where they are few, the fallback: CTEs up to ``final``."""
    d = D.text
    entries = ", ".join(f"({d(kind)}, {d(t)}, {d(w) if w else 'NULL'})" for kind, terms in P.CONSTRUCTION_GROUPS.items() for t in terms for w in (None, *[x for x in dict.fromkeys(P.ABBREVIATIONS_OF_TERMS.get(t, [])) if x != t]))
    groups = " ".join(f"WHEN w IN ({', '.join(d(x) for x in names)}) THEN {d(kind)}" for kind, names in P.DOMAIN_TYPES.items())
    junk = lambda x: f"regexp_matches({x}, '^[\\[\\]{{}}()]$|^[^\\w\\s]+$|^\\d+$|^[a-z]{{1,2}}$|^indirect|^unknown|^unspecified') OR regexp_matches({x}, 'peptide|compound|target|pathway|indication|assay|protein|gene')"
    contexts = " UNION ALL ".join(f"SELECT sentence, {d(kind)}, upper(unnest(regexp_extract_all(s, {d(w)}, 1))), NULL, 0.5, 'context_pattern' FROM texts WHERE {' OR '.join(f'regexp_matches(s, {d(t)})' for t in P.CONTEXT_PATTERNS['construction'][c])}" for c, (kind, words) in P.CONTEXT_WORDS.items() for w in words)
    patterns = " UNION ALL ".join(f"SELECT sentence, s, unnest(list_distinct({' || '.join(f'regexp_extract_all(s, {d(f'(?i){x}')})' for x in ps)})) AS text, 0.6 AS score, 'pattern_{kind}' AS source FROM texts" for kind, ps in P.FALLBACK_PATTERNS["construction"].items())
    by_words = " ".join(f"WHEN len(list_filter([{', '.join(d(w) for w in ws)}], lambda x: contains(s, x))) >= 2 THEN {d(g)}" for g, ws in P.FALLBACK_KEYWORDS["construction"].items())
    by_pattern = " ".join(f"WHEN {' OR '.join(f'regexp_matches(lower(text), {d(f'(?i){x}')})' for x in ps)} THEN {d(g)}" for g, ps in P.FALLBACK_PATTERNS["construction"].items())
    return f"""corpus AS ({corpus_sql(D)}), texts AS (SELECT DISTINCT sentence, lower(trim(regexp_replace(sentence, '\\s+', ' ', 'g'))) AS s FROM corpus),
vocabulary(kind, term, writing) AS (VALUES {entries}),
named AS (SELECT CASE {groups} ELSE kind END AS kind, upper(term) AS name, upper(writing) AS variant, CASE WHEN writing IS NULL THEN 0.8 ELSE 0.6 END AS score, CASE WHEN writing IS NULL THEN 'ontology_exact' ELSE 'ontology_abbreviation' END AS source, w
  FROM (SELECT *, coalesce(writing, term) AS w FROM vocabulary) AS v WHERE NOT ({junk("w")}) AND NOT ({junk("term")})),
staged AS (SELECT sentence, kind, name, variant, score, source FROM texts JOIN named ON contains(s, w) UNION ALL {contexts}),
one AS (SELECT * FROM staged WHERE NOT ({junk("lower(name)")}) QUALIFY row_number() OVER (PARTITION BY sentence, kind, name, variant ORDER BY score DESC, source) = 1),
counted AS (SELECT t.sentence, t.s, count(o.name) < 3 AS fallback_used FROM texts t LEFT JOIN one o USING (sentence) GROUP BY 1, 2),
candidates AS ({patterns}
  UNION ALL SELECT sentence, s, text, 0.4, 'capitalized_phrase' FROM (SELECT sentence, s, unnest(list_distinct(regexp_extract_all(sentence, {d(P.CAPITALIZED)}))) AS text FROM texts) AS q WHERE NOT ({" OR ".join(f"regexp_matches(lower(text), {d(x)})" for x in P.NO_ENTITY_PHRASES)})
  UNION ALL SELECT sentence, s, unnest(list_distinct(regexp_extract_all(sentence, {d(P.ENTITY_CODES)}))), 0.3, 'alphanumeric_code' FROM texts),
typed AS (SELECT sentence, coalesce(CASE {by_words} END, CASE {by_pattern} END) AS kind, text AS name, NULL AS variant, score, source FROM candidates),
more AS (SELECT y.* FROM typed y JOIN counted USING (sentence) WHERE fallback_used AND y.kind IS NOT NULL AND NOT EXISTS (SELECT 1 FROM one o WHERE o.sentence = y.sentence AND lower(o.name) = lower(y.name))),
final AS (SELECT * FROM (SELECT * FROM one UNION ALL SELECT * FROM more) AS u QUALIFY row_number() OVER (PARTITION BY sentence, kind, name, variant ORDER BY score DESC, source) = 1)"""


_FOUND = _found_sql()
_SUMS = " ".join(f"WHEN {D.text(k)} THEN {v}" for k, v in P.TYPE_WEIGHTS.items())
_AWAY = "|".join(a.replace(".", "[.]") for a in P.AFFILIATIONS) + r"|@|https?://|www\."
_PAGE_SQL = rf"""WITH pages AS (SELECT source_id, list_filter(list_transform(string_split(array_to_string(list_filter(['Journal of Examples, Vol. 3', title, authors, 'Institute of Materials, a@b.edu', 'DOI: ' || doi, 'Published ' || year], lambda x: x IS NOT NULL), chr(10)), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS lines FROM sources)
SELECT source_id,
  list_filter(lines[1:10], lambda x: length(x) >= 5 AND NOT regexp_matches(x, '{M.HEADER_WORDS}'))[1] AS title,
  coalesce(list_filter(lines[2:10], lambda x: NOT regexp_matches(lower(x), '{_AWAY}') AND (contains(x, ',') OR contains(lower(x), ' and ')) AND length(x) > 3 AND length(x) < 200)[1], lines[2]) AS authors,
  nullif(regexp_replace(regexp_extract(coalesce(list_filter(lines, lambda x: contains(lower(x), 'doi') AND regexp_matches(x, '10\.\d{{4,9}}/'))[1], ''), '(?i)10\.\d{{4,9}}/[-._;()/:A-Z0-9<>%+,]+'), '[.,;:]+$', ''), '') AS doi,
  try_cast(regexp_extract(coalesce(list_filter(lines, lambda x: regexp_matches(x, '(19|20)\d{{2}}'))[-1], ''), '((?:19|20)\d{{2}})', 1) AS INTEGER) AS year
FROM pages"""
ORACLES = {
    "integrated_extraction": f"WITH {_FOUND} SELECT fallback_used, kind AS entity_type, source, count(*) AS n, round(avg(score::DOUBLE), 4) AS confidence FROM corpus JOIN final USING (sentence) JOIN counted USING (sentence) GROUP BY 1, 2, 3",
    "fallback_candidates": f"WITH {_FOUND} SELECT source, text, count(*) AS n FROM corpus JOIN candidates USING (sentence) GROUP BY 1, 2",
    "extraction_stats": f"WITH {_FOUND} SELECT count(*) AS n_entities, count(*) FILTER (WHERE score >= 0.8) AS high, count(*) FILTER (WHERE score >= 0.5 AND score < 0.8) AS medium, count(*) FILTER (WHERE score < 0.5) AS low, round(avg(score::DOUBLE), 4) AS mean_confidence, count(DISTINCT kind) AS n_types FROM corpus JOIN final USING (sentence)",
    "quality_score": f"""WITH {_FOUND}, q AS (SELECT doc_id, count(*) AS n, sum(round(score * 100)::BIGINT) / (count(*) * 100.0::DOUBLE) AS mean, count(*) FILTER (WHERE score >= 0.8) / count(*) AS sure, count(DISTINCT kind) / count(*) AS variety FROM corpus JOIN final USING (sentence) GROUP BY 1)
SELECT doc_id, n, round(mean, 4) AS mean_confidence, round(sure, 4) AS confident_share, round(least(100.0::DOUBLE, mean * 50 + sure * 30 + variety * 20), 4) AS quality_score,
  array_to_string(list_filter([CASE WHEN mean < 0.6 THEN 'low confidence' END, CASE WHEN sure < 0.3 THEN 'few confident entities' END, CASE WHEN variety < 0.2 THEN 'few types' END], lambda x: x IS NOT NULL), '; ') AS issues FROM q""",
    "scored_event_confidence": f"""WITH {_FOUND}, w AS (SELECT sentence, sum(CASE kind {_SUMS} ELSE 0.05 END * least(1.0, score))::DOUBLE AS base FROM final GROUP BY 1),
p AS (SELECT sentence, fallback_used, least(1.0::DOUBLE, coalesce(base, 0) + CASE WHEN regexp_matches(lower(sentence), 'ic50|ec50|half-life|auc') THEN 0.1 ELSE 0 END + CASE WHEN regexp_matches(lower(sentence), 'lc-ms|spr|bli|triple quadrupole|quantitation') THEN 0.1 ELSE 0 END + CASE WHEN regexp_matches(lower(sentence), 'in vivo|clinical|randomized|phase i') THEN 0.1 ELSE 0 END) AS x FROM counted LEFT JOIN w USING (sentence))
SELECT CASE WHEN x >= 0.75 - 1e-9 THEN 'high' WHEN x >= 0.45 - 1e-9 THEN 'med' ELSE 'low' END AS label, fallback_used, count(*) AS n FROM corpus JOIN p USING (sentence) GROUP BY 1, 2""",
    "entities_tagged": _tagged_sql(),
    "first_page_metadata": _PAGE_SQL,
    "neural_and_stem_sentences": f"SELECT count(*) FILTER (WHERE {D.word('sentence', P.NEURAL_CELL_KEYWORDS)}) AS n_neural, count(*) FILTER (WHERE {D.word('sentence', P.STEM_CELL_KEYWORDS)}) AS n_stem FROM (SELECT lower(unnest({sentences(D, 'chunk_text')})) AS sentence FROM chunks) AS c",
    "peptides_found": rf"SELECT research_domain, peptide, count(*) AS n FROM (SELECT research_domain, unnest(list_distinct(regexp_extract_all(sentence, '\b[{_AA}]{{7,}}\b'))) AS peptide FROM ({corpus_sql(D)}) AS c) AS p GROUP BY 1, 2",
    "relationships": " UNION ALL ".join(
        f"SELECT {D.text(name)} AS relationship_type, regexp_extract(sentence, {D.text(pattern)}, 1) AS entity_1, regexp_extract(sentence, {D.text(pattern)}, 2) AS entity_2, count(DISTINCT (doc_id, page_number)) AS n FROM ({corpus_sql(D)}) AS c WHERE regexp_matches(sentence, {D.text(pattern)}) GROUP BY ALL"
        for name, pattern in ((n, f"({'|'.join(SUBJECTS)}) +{words} +({'|'.join(SUBJECTS)})") for n, words in (("more_stable_than", "was +more +stable +than"), ("analog_of", "is +an +analog +of"), ("less_toxic_than", "is +less +toxic +than")))
    ),
    "html_abstract": r"SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(text, '[<>]', ' ', 'g'), '\s+', ' ', 'g'))) AS abstract_hash FROM documents",
    "page_links": r"SELECT source_id, array_to_string(regexp_extract_all(s, '(?i)https?://[^\s<>\"'']+\.pdf(?:\?[^\s<>\"'']*)?(?:#[^\s<>\"'']*)?'), ' ') AS links FROM (SELECT source_id, coalesce(url, '') || ' see https://a.example/' || pdf_file || ' and https://a.example/x.pdf?v=1#p2 <b>' AS s FROM sources) AS q",
    "doi_clean": r"SELECT source_id, regexp_replace(regexp_replace(trim(doi), '[.,;:]+$', ''), '\([^)]*\)$', '') AS cleaned, nullif(regexp_replace(regexp_extract('https://doi.org/' || trim(doi) || '.', '10\.\d{4,9}/[-._;()/:A-Za-z0-9<>%+,]+', 0), '[.,;:]+$', ''), '') AS found FROM sources WHERE doi IS NOT NULL",
    "publication_years": r"SELECT source_id, try_cast(regexp_extract(coalesce(publication_date, ''), '((?:19|20)\d{2})', 1) AS INTEGER) AS year_found FROM sources",
}
