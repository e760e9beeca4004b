"""Queries of the event, entity and source tables: joins, rollups, exports, checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortarline.functions import phrases as P
from mortarline.functions.dialect import DUCKDB as D
from mortarline.operators import analytics as A
from mortarline.operators import governance as G
from mortarline.operators import model as M
from mortarline.operators import overlays as O
from mortarline.operators.entities import dictionary_match
from mortarline.operators.identity import collapsed, normalized_doi, resolve_all
from mortarline.plans.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
EVENTS = "events AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY loaded_at DESC, created_at DESC) AS rn FROM research_events) AS e WHERE rn = 1)"
LINKS = "links AS (SELECT DISTINCT event_id, entity_id FROM event_entities WHERE event_id IS NOT NULL AND entity_id IS NOT NULL)"
PROFILE = G.profile_from(G.EXAMPLE_PROFILE)
WATCHED = ["concrete", "mortar", "hempcrete", "creep", "RT-9", "graphene aerogel", "kevlar"]


def _set(values) -> str:  # noqa: ANN001
    return f"SELECT unnest([{', '.join(D.text(v) for v in values)}])"


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def events(spark: SparkSession, d: str) -> DataFrame:
    return M.keep_last(table(spark, d, "research_events"), ["event_id"], ["loaded_at", "created_at"])


def links(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "event_entities").select("event_id", "entity_id").dropna().distinct()


def entities(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "entities")


for _column in ("event_type", "research_domain", "confidence", "outcome", "failure_reason", "stage", "system_context"):

    def _distribution(spark: SparkSession, d: str, column: str = _column) -> DataFrame:
        return A.distribution(events(spark, d), column)

    QUERIES[f"events_by_{_column}"] = _distribution
    ORACLES[f"events_by_{_column}"] = f"WITH {EVENTS} SELECT {_column}, count(*) AS n FROM events GROUP BY 1"


@query("SELECT entity_type, count(*) AS n, count(DISTINCT entity_name) AS n_names FROM entities GROUP BY 1")
def entities_by_type(spark, d):
    return entities(spark, d).groupBy("entity_type").agg(F.count("*").alias("n"), F.count_distinct("entity_name").alias("n_names"))


@query("SELECT role, count(*) AS n FROM event_entities GROUP BY 1")
def roles(spark, d):
    return A.distribution(table(spark, d, "event_entities"), "role")


@query(f"WITH {EVENTS} SELECT failure_reason, count(*) AS n FROM events WHERE research_domain = 'construction_science' AND failure_reason <> 'unknown' GROUP BY 1")
def known_failures_of_domain(spark, d):
    return A.distribution(events(spark, d).where("research_domain = 'construction_science' and failure_reason <> 'unknown'"), "failure_reason")


@query(f"WITH {EVENTS} SELECT confidence, count(*) AS n, CASE confidence WHEN 'high' THEN 1 WHEN 'med' THEN 2 WHEN 'low' THEN 3 ELSE 4 END AS position FROM events GROUP BY 1 ORDER BY 3")
def confidence_ordered(spark, d):
    rows = A.distribution(events(spark, d), "confidence")
    return rows.withColumn("position", A.confidence_rank(F.col("confidence"))).orderBy("position", "confidence")


@query(f"""WITH {EVENTS}, {LINKS} SELECT entity_type, entity_name, count(DISTINCT event_id) AS event_count, count(DISTINCT source_id) AS paper_count, min(created_at) AS first_seen, max(created_at) AS last_seen
FROM links JOIN entities e USING (entity_id) JOIN events v USING (event_id) GROUP BY 1, 2""".replace("min(created_at)", "min(v.created_at)").replace("max(created_at)", "max(v.created_at)"))
def entity_rollup(spark, d):
    return A.entity_rollup(entities(spark, d), links(spark, d), events(spark, d))


@query(f"WITH {LINKS} SELECT entity_id, entity_name, count(*) AS n FROM links JOIN entities USING (entity_id) GROUP BY 1, 2 ORDER BY n DESC, entity_id LIMIT 20")
def top_entities(spark, d):
    rows = links(spark, d).groupBy("entity_id").agg(F.count("*").alias("n")).join(entities(spark, d).select("entity_id", "entity_name"), "entity_id")
    return A.top(rows.select("entity_id", "entity_name", "n"), 20, "n", "entity_id")


@query(f"WITH {EVENTS} SELECT s.source_id, s.title, count(e.event_id) AS n_events FROM sources s LEFT JOIN events e ON e.source_id = s.source_id GROUP BY 1, 2")
def sources_with_event_counts(spark, d):
    return A.sources_with_event_counts(table(spark, d, "sources"), events(spark, d))


@query(f"WITH {LINKS} SELECT e.entity_id, e.entity_type, count(l.event_id) AS n_events FROM entities e LEFT JOIN links l ON l.entity_id = e.entity_id GROUP BY 1, 2")
def entities_with_zero_events(spark, d):
    counts = links(spark, d).groupBy("entity_id").agg(F.count("*").alias("n"))
    return entities(spark, d).join(counts, "entity_id", "left").select("entity_id", "entity_type", F.coalesce("n", F.lit(0)).alias("n_events"))


@query(f"WITH {EVENTS}, {LINKS} SELECT n_entities, count(*) AS n_events FROM (SELECT e.event_id, count(l.entity_id) AS n_entities FROM events e LEFT JOIN links l USING (event_id) GROUP BY 1) AS c GROUP BY 1")
def entities_per_event(spark, d):
    return A.entities_per_event(events(spark, d), links(spark, d))


@query(f"WITH {EVENTS}, {LINKS} SELECT event_id, event_type FROM events WHERE event_id NOT IN (SELECT event_id FROM links)")
def events_without_entities(spark, d):
    return A.events_without_entities(events(spark, d), links(spark, d)).select("event_id", "event_type")


@query(f"WITH {LINKS} SELECT event_id, count(*) FILTER (WHERE entity_type IN ('compound', 'material')) AS n_one, count(*) FILTER (WHERE entity_type IN ('cell_model', 'test_method')) AS n_other FROM links JOIN entities USING (entity_id) GROUP BY 1 HAVING n_one > 0 AND n_other > 0")
def compound_model_events(spark, d):
    return A.events_with_both(links(spark, d), entities(spark, d), ["compound", "material"], ["cell_model", "test_method"])


@query(f"""WITH {EVENTS}, {LINKS}, named AS (SELECT DISTINCT event_id, entity_type || ':' || entity_name AS e FROM links JOIN entities USING (entity_id)), listed AS (SELECT event_id, string_agg(e, '; ' ORDER BY e) AS entities FROM named GROUP BY 1)
SELECT event_id, event_type, coalesce(entities, '') AS entities FROM events LEFT JOIN listed USING (event_id)""")
def events_with_entities_concat(spark, d):
    return A.events_with_entities(events(spark, d), links(spark, d), entities(spark, d)).select("event_id", "event_type", "entities")


@query(f"""WITH {EVENTS}, {LINKS} SELECT e.event_id, e.research_domain AS domain, e.event_type, n.entity_type, n.entity_name, coalesce(n.entity_variant, '') AS entity_variant FROM events e JOIN links USING (event_id) JOIN entities n USING (entity_id)""")
def event_entity_detail(spark, d):
    rows = links(spark, d).join(events(spark, d).select("event_id", F.col("research_domain").alias("domain"), "event_type"), "event_id").join(entities(spark, d), "entity_id")
    return rows.select("event_id", "domain", "event_type", "entity_type", "entity_name", F.coalesce("entity_variant", F.lit("")).alias("entity_variant"))


@query(f"""WITH {EVENTS}, {LINKS} SELECT entity_id, count(DISTINCT CASE WHEN outcome = 'failed' THEN e.event_id END) AS n_failed, count(DISTINCT e.source_id) AS n_papers, min(s.year) AS first_year, max(s.year) AS last_year
FROM links JOIN events e USING (event_id) JOIN sources s USING (source_id) GROUP BY 1""")
def compound_summary(spark, d):
    rows = links(spark, d).join(events(spark, d).select("event_id", "source_id", "outcome"), "event_id").join(table(spark, d, "sources").select("source_id", "year"), "source_id")
    return rows.groupBy("entity_id").agg(F.count_distinct(F.when(F.col("outcome") == "failed", F.col("event_id"))).alias("n_failed"), F.count_distinct("source_id").alias("n_papers"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


@query(f"WITH {EVENTS}, {LINKS} SELECT event_id, count(DISTINCT entity_type) AS n_types FROM links JOIN entities USING (entity_id) GROUP BY 1 HAVING count(DISTINCT entity_type) > 1")
def multi_type_events(spark, d):
    rows = links(spark, d).join(entities(spark, d).select("entity_id", "entity_type"), "entity_id").groupBy("event_id").agg(F.count_distinct("entity_type").alias("n_types"))
    return rows.where("n_types > 1")


@query("SELECT name, n, types FROM (SELECT lower(entity_name) AS name, count(*) AS n, string_agg(DISTINCT entity_type || '/' || coalesce(entity_variant, 'none'), ', ' ORDER BY entity_type || '/' || coalesce(entity_variant, 'none')) AS types FROM entities GROUP BY 1) AS g WHERE n > 1")
def same_name_entities(spark, d):
    label = F.concat("entity_type", F.lit("/"), F.coalesce("entity_variant", F.lit("none")))
    rows = entities(spark, d).groupBy(F.lower("entity_name").alias("name")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set(label)), ", ").alias("types"))
    return rows.where("n > 1")


@query(f"WITH {EVENTS}, {LINKS} SELECT count(*) AS n_events, count(l.event_id) AS n_linked, round(count(l.event_id) * 100.0::DOUBLE / count(*), 4) AS percent, count(l.event_id) * 100.0 / count(*) >= 70 AS passed FROM events LEFT JOIN (SELECT DISTINCT event_id FROM links) AS l USING (event_id)")
def entity_coverage(spark, d):
    return A.coverage(events(spark, d), links(spark, d))


@query("SELECT column_name, n, round(n * 100.0::DOUBLE / total, 4) AS percent FROM (SELECT unnest(['entity_variant', 'organism', 'entity_name']) AS column_name, unnest([count(*) FILTER (WHERE trim(entity_variant) <> ''), count(*) FILTER (WHERE trim(organism) <> ''), count(*) FILTER (WHERE trim(entity_name) <> '')]) AS n, count(*) AS total FROM entities) AS q")
def variant_population(spark, d):
    return A.populated(entities(spark, d), "entity_variant", "organism", "entity_name")


@query(f"WITH w AS (SELECT unnest([{', '.join(D.text(w) for w in WATCHED)}]) AS wanted) SELECT wanted, count(e.entity_id) > 0 AS found, count(e.entity_id) AS n_entities FROM w LEFT JOIN entities e ON lower(e.entity_name) = lower(wanted) GROUP BY 1")
def watchlist_missing(spark, d):
    return A.watch_list(entities(spark, d), WATCHED)


@query(f"SELECT entity_type, count(*) AS n FROM entities WHERE entity_type IN ({_set(P.ALL_TYPES)} EXCEPT {_set(P.ALLOWED_TYPES['construction_science'])}) GROUP BY 1")
def contamination_check(spark, d):
    return G.contamination(entities(spark, d), "construction_science")


@query("SELECT count(*) AS n, count(DISTINCT entity_name) AS n_names FROM entities WHERE entity_name ILIKE '%concrete%'")
def name_like(spark, d):
    return entities(spark, d).where(F.col("entity_name").ilike("%concrete%")).agg(F.count("*").alias("n"), F.count_distinct("entity_name").alias("n_names"))


@query(f"WITH {EVENTS} SELECT event_id, created_at, confidence FROM events WHERE created_at IS NOT NULL ORDER BY created_at DESC, event_id LIMIT 30")
def recent_events(spark, d):
    return A.top(events(spark, d).select("event_id", "created_at", "confidence").where("created_at is not null"), 30, "created_at", "event_id")


@query("SELECT DISTINCT entity_type, organism FROM entities WHERE organism IS NOT NULL")
def distinct_organisms(spark, d):
    return entities(spark, d).where("organism is not null").select("entity_type", "organism").distinct()


@query(f"""WITH {EVENTS}, {LINKS},
aliased AS (SELECT entity_type AS kind, lower(unnest(aliases)) AS alias, canonical, canonical_id FROM construction_science_aliases), alias_first AS (SELECT kind, alias, arg_min(canonical, canonical_id) AS canonical FROM aliased GROUP BY 1, 2),
rows AS (SELECT l.event_id, v.source_id, e.entity_type, e.entity_name, nullif(trim(e.entity_variant), '') AS variant FROM links l JOIN events v USING (event_id) JOIN entities e USING (entity_id) WHERE v.research_domain = 'construction_science'),
one AS (SELECT entity_type, entity_name, count(DISTINCT event_id) AS event_count FROM rows GROUP BY 1, 2),
named AS (SELECT o.*, coalesce(a.canonical, trim(o.entity_name)) AS canonical_name FROM one o LEFT JOIN alias_first a ON a.kind = o.entity_type AND a.alias = lower(trim(o.entity_name))),
more AS (SELECT n.entity_type, n.canonical_name, string_agg(DISTINCT variant, ',' ORDER BY variant) AS entity_variant, count(DISTINCT source_id) AS n_papers FROM named n JOIN rows r USING (entity_type, entity_name) GROUP BY 1, 2)
SELECT canonical_name AS entity_name, entity_type, coalesce(any_value(entity_variant), '') AS entity_variant, sum(event_count)::BIGINT AS event_count, any_value(n_papers) AS n_papers, string_agg(entity_name, '|' ORDER BY entity_name) AS original_names
FROM named JOIN more USING (entity_type, canonical_name) GROUP BY 1, 2""")
def entity_export_domain(spark, d):
    ents = entities(spark, d)
    names = O.normalized_entities(ents.select("entity_type", "entity_name").distinct(), O.alias_rows(table(spark, d, "construction_science_aliases")))
    return A.domain_export(events(spark, d), links(spark, d), ents, names, "construction_science")


@query(f"WITH {EVENTS} SELECT event_id, substr(evidence_snippet, 1, 180) AS head, sha256(concat_ws('|', coalesce(source_id, ''), coalesce(doc_id::VARCHAR, ''), coalesce(page_number::VARCHAR, ''), coalesce(event_type, ''), coalesce(substr(evidence_snippet, 1, 180), ''))) AS hashed FROM events")
def event_ids(spark, d):
    rows = events(spark, d)
    return rows.select("event_id", F.substring("evidence_snippet", 1, 180).alias("head"), M.event_id(F.col("source_id"), F.col("doc_id"), F.col("page_number"), F.col("event_type"), F.col("evidence_snippet")).alias("hashed"))


@query("SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_events, count(*) - count(DISTINCT event_id) AS n_again FROM research_events")
def duplicate_deliveries(spark, d):
    return table(spark, d, "research_events").agg(F.count("*").alias("n_rows"), F.count_distinct("event_id").alias("n_events")).withColumn("n_again", F.col("n_rows") - F.col("n_events"))


@query("SELECT sha256, doc_id FROM (SELECT sha256, doc_id, row_number() OVER (PARTITION BY n_chars, text ORDER BY created_at, doc_id) AS r FROM documents) AS q WHERE r = 1")
def first_of_equal_documents(spark, d):
    rows = table(spark, d, "documents").withColumn("content", F.sha2("text", 256))
    return M.keep_first(rows.select("content", "sha256", "doc_id", "created_at"), ["content"], ["created_at", "doc_id"]).select("sha256", "doc_id")


@query("""WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY entity_type, entity_name ORDER BY created_at, entity_id) AS r FROM entities),
old AS (SELECT entity_type, entity_name, max(entity_id) AS entity_id FROM entities WHERE organism IS NOT NULL GROUP BY 1, 2)
SELECT entity_type, entity_name, coalesce(o.entity_id, r.entity_id) AS entity_id, o.entity_id IS NOT NULL AS was_there FROM ranked r LEFT JOIN old o USING (entity_type, entity_name) WHERE r.r = 1""")
def entities_insert_or_ignore(spark, d):
    """All entities put into a table that holds one row, not the first, of each name that ever had an organism: those stay as they are."""
    ents = entities(spark, d)
    keys, order = ["entity_type", "entity_name"], ["created_at", "entity_id"]
    old = M.keep_last(ents.where("organism is not null"), keys, ["entity_id"])
    merged = M.insert_or_ignore(old, ents, keys, order)
    there = old.select(*keys, F.lit(True).alias("was_there"))
    return merged.join(there, keys, "left").select(*keys, "entity_id", F.coalesce("was_there", F.lit(False)).alias("was_there"))


@query("""WITH d AS (SELECT doc_id, CASE WHEN sha256 IS NOT NULL THEN source_id END AS source_id FROM documents)
SELECT c.chunk_id, c.doc_id, c.source_id, d.source_id AS doc_source_id FROM chunks c JOIN d USING (doc_id) WHERE c.source_id IS DISTINCT FROM d.source_id""")
def chunk_source_violations(spark, d):
    """Pages whose source is not their document's, the documents without a hash having lost theirs (in the tables all agree)."""
    docs = table(spark, d, "documents").select("doc_id", F.when(F.col("sha256").isNotNull(), F.col("source_id")).alias("source_id"))
    return M.source_mismatches(table(spark, d, "chunks"), docs)


@query("SELECT event_id, count(*) AS n FROM event_entities WHERE event_id NOT IN (SELECT event_id FROM research_events) GROUP BY 1")
def orphan_links(spark, d):
    return M.orphans(table(spark, d, "event_entities"), table(spark, d, "research_events"), "event_id").groupBy("event_id").agg(F.count("*").alias("n"))


@query("SELECT e.event_id, c.chunk_id FROM research_events e LEFT JOIN chunks c ON c.chunk_id = e.chunk_id WHERE e.event_id IS NOT NULL")
def chunk_links_set_null(spark, d):
    return M.set_null(table(spark, d, "research_events").select("event_id", "chunk_id"), table(spark, d, "chunks"), "chunk_id")


_DOI = "regexp_replace(regexp_replace(regexp_replace(lower(trim(doi)), '\\s+', ' ', 'g'), '^(https?://(dx\\.)?doi\\.org/|doi:)', ''), '^[/ ]+|[/ ]+$', '', 'g')"
_TITLE = "trim(regexp_replace(lower(title), '\\s+', ' ', 'g'))"


@query(f"SELECT doi_n, count(*) AS n FROM (SELECT {_DOI} AS doi_n FROM sources WHERE trim(doi) <> '') AS q GROUP BY 1")
def doi_normalize(spark, d):
    return table(spark, d, "sources").where("trim(doi) <> ''").groupBy(normalized_doi(F.col("doi")).alias("doi_n")).agg(F.count("*").alias("n"))


@query(f"""WITH n AS (SELECT source_id, coalesce({_DOI}, '') AS doi_n, coalesce({_TITLE}, '') AS title_n FROM sources),
firsts AS (SELECT source_id, CASE WHEN doi_n <> '' THEN min(source_id) OVER (PARTITION BY doi_n) END AS by_doi, CASE WHEN title_n <> '' THEN min(source_id) OVER (PARTITION BY title_n) END AS by_title FROM n),
earlier AS (SELECT source_id, CASE WHEN by_doi < source_id THEN by_doi END AS by_doi, CASE WHEN by_title < source_id THEN by_title END AS by_title FROM firsts)
SELECT source_id, coalesce(by_doi, by_title, source_id) AS resolved_id, CASE WHEN by_doi IS NOT NULL THEN 'doi' WHEN by_title IS NOT NULL THEN 'title' ELSE 'new' END AS matched_by FROM earlier""")
def source_dedupe_exact(spark, d):
    """Every source against all of smaller ids, by DOI and title."""
    return resolve_all(table(spark, d, "sources"), fuzzy=False)


@query()
def source_dedupe_blocked(spark, d):
    """The same with near titles; tested against brute force."""
    return resolve_all(table(spark, d, "sources"))


@query(f"SELECT {_TITLE} AS title_n, count(*) AS n, min(source_id) AS first_id FROM sources WHERE title IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def equal_titles(spark, d):
    rows = table(spark, d, "sources").where("title is not null").groupBy(collapsed(F.col("title")).alias("title_n")).agg(F.count("*").alias("n"), F.min("source_id").alias("first_id"))
    return rows.where("n > 1")


_PREFERRED, _ALLOWED = _set(PROFILE.preferred_types), _set(P.ALLOWED_TYPES[PROFILE.id])
_TYPE_ISSUES = f"""(SELECT 'preferred_not_allowed' AS issue, t AS entity_type FROM ({_PREFERRED} AS t EXCEPT {_ALLOWED})) UNION ALL (SELECT 'allowed_not_preferred', t FROM ({_ALLOWED} AS t EXCEPT {_PREFERRED}))
UNION ALL (SELECT 'leakage', t FROM ({_PREFERRED} AS t INTERSECT {_set(["compound", "target", "pathway", "indication", "assay", "peptide"])}))"""


@query(f"SELECT 'construction_science' AS domain_id, issue, a.entity_type, count(e.entity_id) AS n_entities FROM ({_TYPE_ISSUES}) AS a LEFT JOIN entities e ON e.entity_type = a.entity_type GROUP BY ALL")
def domain_audit(spark, d):
    """What is wrong with a domain's types, and how many entities of such a type there are."""
    counts = A.distribution(entities(spark, d), "entity_type", name="k")
    return G.audit_domains(spark, [PROFILE]).join(counts, "entity_type", "left").select("domain_id", "issue", "entity_type", F.coalesce("k", F.lit(0)).alias("n_entities"))


@query(f"SELECT {G.excluded_sql(D, PROFILE, 's')} AS excluded, {D.has('s', PROFILE.forbidden)} AS forbidden, count(*) AS n FROM (SELECT lower(chunk_text) AS s FROM chunks) AS c GROUP BY ALL")
def excluded_pages(spark, d):
    t = F.col("chunk_text")
    return table(spark, d, "chunks").groupBy(PROFILE.excluded(t).alias("excluded"), PROFILE.forbidden_language(t).alias("forbidden")).agg(F.count("*").alias("n"))


@query("SELECT entity_type, count(*) AS n FROM entities WHERE entity_type IN ('material', 'system', 'failure_mode', 'environment', 'hazard', 'test_method', 'code', 'property') GROUP BY 1")
def allowed_types_only(spark, d):
    return A.distribution(G.allowed_only(entities(spark, d), "construction_science"), "entity_type")


@query("SELECT term, string_agg(category, ', ' ORDER BY category) AS categories FROM (SELECT DISTINCT lower(trim(unnest(aliases))) AS term, entity_type AS category FROM construction_science_aliases) AS q GROUP BY 1 HAVING count(*) > 1")
def seed_lint(spark, d):
    lists = table(spark, d, "construction_science_aliases").select(F.col("entity_type").alias("category"), F.explode("aliases").alias("term"))
    return A.duplicate_terms(lists).select("term", F.array_join("categories", ", ").alias("categories"))


TABLES = {"sources": 12, "documents": 10, "chunks": 7, "entities": 6, "research_events": 19, "event_entities": 3, "construction_science_aliases": 4}


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {t}) AS n_rows, {n}::BIGINT AS n_columns" for t, n in TABLES.items()))
def table_stats(spark, d):
    return G.table_stats(spark, d, list(TABLES))


_PARTS = r"list_filter(list_transform(string_split_regex(entities, '\s*;\s*'), lambda x: trim(x, ' ')), lambda x: contains(x, ':'))"
_PRIMARY = f"list_contains([{', '.join(D.text(t) for t in P.PRIMARY_TYPES)}], split_part(x, ':', 1)) AND NOT (split_part(x, ':', 1) = 'assay' AND list_contains([{', '.join(D.text(w) for w in P.PROCESS_WORDS)}], lower(substr(x, 7))))"


@query(f"""WITH {EVENTS}, {LINKS}, named AS (SELECT DISTINCT event_id, entity_type || ':' || replace(entity_name, ';', ',') AS e FROM links JOIN entities USING (entity_id) WHERE event_id IN (SELECT event_id FROM events)), listed AS (SELECT event_id, string_agg(e, '; ' ORDER BY e) AS entities FROM named GROUP BY 1)
SELECT event_id, len(list_filter({_PARTS}, lambda x: {_PRIMARY})) AS n_primary, len(list_filter({_PARTS}, lambda x: NOT ({_PRIMARY}))) AS n_context, array_to_string(list_filter({_PARTS}, lambda x: {_PRIMARY}), '; ') AS main FROM listed""")
def entity_roles_per_event(spark, d):
    """Main and side entities of each event's list."""
    ents = entities(spark, d).withColumn("entity_name", F.replace("entity_name", F.lit(";"), F.lit(",")))
    rows = A.events_with_entities(events(spark, d), links(spark, d), ents).where("entities <> ''")
    rows = rows.select("event_id", A.role_counts(F.col("entities")).alias("r"))
    return rows.select("event_id", F.col("r.n_primary").cast("bigint").alias("n_primary"), F.col("r.n_context").cast("bigint").alias("n_context"), F.col("r.primary").alias("main"))


@query(f"""WITH names AS (SELECT entity_type AS kind, lower(unnest(list_concat([canonical], aliases))) AS name, canonical_id, CASE WHEN canonical_id % 2 = 0 THEN 'context' ELSE 'primary' END AS r FROM construction_science_aliases),
firsts AS (SELECT kind, name, arg_min(r, canonical_id) AS r FROM names GROUP BY 1, 2)
SELECT role, count(*) AS n FROM (SELECT coalesce(f.r, CASE WHEN lower(trim(entity_type)) IN ({_set(P.PRIMARY_TYPES)}) THEN 'primary' ELSE 'unknown' END) AS role FROM entities e LEFT JOIN firsts f ON f.kind = lower(trim(e.entity_type)) AND f.name = lower(trim(e.entity_name))) AS q GROUP BY 1""")
def entity_roles_by_map(spark, d):
    """Roles by a map that gives every second canonical name the role context."""
    mapping = table(spark, d, "construction_science_aliases").select(F.col("entity_type").alias("kind"), "canonical", F.col("aliases").alias("variants"), F.col("canonical_id").alias("ord"), F.when(F.col("canonical_id") % 2 == 0, "context").alias("role"))
    return A.distribution(O.roles_by_map(entities(spark, d), mapping), "role")


@query(f"WITH {EVENTS}, {LINKS} SELECT entity_id, source_id, count(DISTINCT event_id) AS n_events FROM links JOIN events USING (event_id) WHERE source_id IS NOT NULL GROUP BY 1, 2")
def entity_papers(spark, d):
    return A.entity_papers(links(spark, d), events(spark, d))


@query(f"WITH {EVENTS} SELECT event_id, confidence FROM events WHERE confidence IN ('high', 'med', 'low') QUALIFY row_number() OVER (PARTITION BY confidence ORDER BY event_id) <= 5")
def confidence_samples(spark, d):
    return A.sample_by(events(spark, d).select("event_id", "confidence"), "confidence", A.CONFIDENCE_ORDER, 5, "event_id")


@query(f"""WITH lists AS (SELECT DISTINCT entity_type AS category, trim(unnest(aliases)) AS term FROM construction_science_aliases UNION SELECT entity_type, trim(entity_name) FROM entities WHERE trim(entity_name) <> ''),
again AS (SELECT lower(term) AS term, string_agg(DISTINCT category, ', ' ORDER BY category) AS detail FROM lists GROUP BY 1 HAVING count(DISTINCT category) > 1)
SELECT 'short' AS issue, category, term, length(term)::VARCHAR AS detail FROM lists WHERE length(term) <= 3 AND NOT regexp_matches(term, '[-/_.]')
UNION ALL SELECT 'common', category, term, NULL FROM lists WHERE lower(term) IN ({_set(P.COMMON_TERMS)})
UNION ALL SELECT 'duplicate', NULL, term, detail FROM again
UNION ALL SELECT 'problematic', category, term, v.detail FROM lists JOIN (VALUES {", ".join(f"({D.text(k)}, {D.text(x)})" for k, x in P.PROBLEMATIC_TERMS.items())}) AS v(k, detail) ON upper(term) = k""")
def seed_checks(spark, d):
    """All checks of term lists, over the canonical list and the names people entered."""
    lists = table(spark, d, "construction_science_aliases").select(F.col("entity_type").alias("category"), F.explode("aliases").alias("term"))
    return A.seed_issues(lists.unionByName(entities(spark, d).select(F.col("entity_type").alias("category"), F.col("entity_name").alias("term"))))


@query()
def terms_in_pages(spark, d):
    """Canonical terms and aliases in the pages, by broadcastable lexicon and n-gram join."""
    lexicon = table(spark, d, "construction_science_aliases").select("canonical_id", "entity_type", F.explode("aliases").alias("term"))
    pages = table(spark, d, "chunks").select("chunk_id", F.col("chunk_text").alias("sentence"))
    return dictionary_match(pages, lexicon, "chunk_id").groupBy("canonical_id", "entity_type").agg(F.count_distinct("chunk_id").alias("n_chunks"))


ORACLES["terms_in_pages"] = r"""WITH lexicon AS (SELECT canonical_id, entity_type, lower(unnest(aliases)) AS term FROM construction_science_aliases)
SELECT canonical_id, entity_type, count(DISTINCT chunk_id) AS n_chunks FROM chunks JOIN lexicon ON contains(lower(chunk_text), term)
WHERE regexp_matches(lower(chunk_text), '(^|[^\p{L}\p{N}])\Q' || term || '\E($|[^\p{L}\p{N}])') GROUP BY 1, 2"""
