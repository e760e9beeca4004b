"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_KEY = r"regexp_replace(lower(upper(nfc_normalize(replace(replace({0}, chr(160), ' '), '’', '''')))), '[^\p{{L}}\p{{N}}]+', '', 'g')"

P1_LINES = rf"""
lines AS (
  SELECT c.chunk_id, c.doc_id, s.venue, u.i AS line_no, {_KEY.format("string_split(c.chunk_text, chr(10))[u.i]")} AS k
  FROM chunks c JOIN sources s USING (source_id), LATERAL (SELECT unnest(range(1, len(string_split(c.chunk_text, chr(10))) + 1)) AS i) u
  WHERE s.venue IS NOT NULL),
docs AS (SELECT s.venue, count(DISTINCT c.doc_id) AS n_docs FROM chunks c JOIN sources s USING (source_id) WHERE s.venue IS NOT NULL GROUP BY 1),
often AS (
  SELECT venue, k FROM lines JOIN docs USING (venue) WHERE regexp_matches(k, '\p{{L}}')
  GROUP BY venue, k HAVING count(DISTINCT doc_id) >= 3 AND count(DISTINCT doc_id) * 5 >= max(n_docs))
"""

_TEXT = r"regexp_replace(lower(upper(nfc_normalize({0}))), '[^\p{{L}}\p{{M}}\p{{N}}\p{{S}}]+', '', 'g')"
P2_KEYS = rf"""
keys AS (
  SELECT source_id, coalesce({_TEXT.format("title")}, '') AS t,
    coalesce({_TEXT.format("regexp_replace(lower(trim(doi)), '^doi[ :]*', '')")}, '') AS d,
    coalesce(array_to_string(list_sort(list_filter(string_split(regexp_replace(lower(upper(nfc_normalize(authors))), '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '' AND x <> 'and')), ' '), '') AS a
  FROM sources),
firsts AS (SELECT *, min(source_id) OVER (PARTITION BY t, d, a) AS first_source_id, count(*) OVER (PARTITION BY t, d, a) AS n_copies FROM keys)
"""

P3_COUNTS = """
links AS (SELECT DISTINCT event_id, entity_id FROM event_entities WHERE event_id IS NOT NULL AND entity_id IS NOT NULL),
items AS (SELECT entity_id, count(*) AS n_item FROM links GROUP BY 1),
total AS (SELECT count(DISTINCT event_id) AS n FROM links),
pairs AS (
  SELECT a.entity_id AS entity_a, b.entity_id AS entity_b, count(*) AS n_ab
  FROM links a JOIN links b ON a.event_id = b.event_id AND a.entity_id < b.entity_id GROUP BY 1, 2),
scored AS (
  SELECT entity_a, entity_b, n_ab, x.n_item AS n_a, y.n_item AS n_b, n
  FROM pairs JOIN items x ON x.entity_id = entity_a JOIN items y ON y.entity_id = entity_b, total)
"""

P9_SIZES = """
own AS (SELECT source, sum(n_chars) AS size FROM documents WHERE source IS NOT NULL GROUP BY 1),
whole AS (SELECT sum(size) AS size FROM own)
"""

ORACLES = {
    "p1_found": f"WITH {P1_LINES} SELECT chunk_id, line_no FROM lines JOIN often USING (venue, k)",
    "p1_clean_chunks": f"""WITH {P1_LINES}, gone AS (SELECT chunk_id, list(line_no) AS g FROM lines JOIN often USING (venue, k) GROUP BY 1)
SELECT c.chunk_id, CASE WHEN g IS NULL THEN c.chunk_text ELSE array_to_string(list_filter(string_split(c.chunk_text, chr(10)), lambda x, i: NOT list_contains(g, i)), chr(10)) END AS clean_text,
  coalesce(len(g), 0)::INTEGER AS n_removed
FROM chunks c LEFT JOIN gone USING (chunk_id)""",
    "p2_found": f"WITH {P2_KEYS} SELECT first_source_id, source_id FROM firsts WHERE source_id <> first_source_id",
    "p2_collapsed": f"WITH {P2_KEYS} SELECT s.source_id, s.title, s.authors, s.doi, f.n_copies FROM firsts f JOIN sources s USING (source_id) WHERE f.source_id = f.first_source_id",
    "p3_found": f"WITH {P3_COUNTS} SELECT entity_a, entity_b FROM scored WHERE n_ab >= 10 AND n_ab * n >= 3 * n_a * n_b",
    "p3_pairs": f"WITH {P3_COUNTS} SELECT entity_a, entity_b, n_ab, round(n_ab * n / (n_a * n_b), 6) AS lift FROM scored WHERE n_ab >= 5",
    "p5_coverage": "SELECT chunk_id, length(chunk_text) AS n_chars, true AS sound FROM chunks WHERE chunk_text IS NOT NULL",
    "p8_found": rf"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(nfc_normalize(text)), '[\p{{L}}\p{{N}}\p{{M}}]+') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, lang, regexp_extract_all(lower(nfc_normalize(text)), '[\p{{L}}\p{{N}}\p{{M}}]+') AS w FROM eval_items),
item_words AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS k FROM i WHERE lang <> 'zh') AS q),
item_characters AS (SELECT DISTINCT item_id, substr(s, k, 20) AS g FROM (SELECT item_id, array_to_string(w, '') AS s, unnest(range(1, length(array_to_string(w, '')) - 18)) AS k FROM i WHERE lang = 'zh') AS q),
doc_words AS (SELECT doc_id, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d) AS q),
doc_characters AS (SELECT doc_id, substr(s, k, 20) AS g FROM (SELECT doc_id, array_to_string(w, '') AS s, unnest(range(1, length(array_to_string(w, '')) - 18)) AS k FROM d WHERE regexp_matches(array_to_string(w, ''), '[\x{{4e00}}-\x{{9fff}}]')) AS q)
SELECT doc_id, item_id FROM doc_words JOIN item_words USING (g) GROUP BY ALL UNION SELECT doc_id, item_id FROM doc_characters JOIN item_characters USING (g) GROUP BY ALL""",
    "p9_goals": """WITH own AS (SELECT source, count(*) AS n, sum(greatest(coalesce(n_chars, 0), 0))::DOUBLE AS size FROM documents WHERE source IS NOT NULL GROUP BY 1),
listed AS (SELECT m.source, target_share, max_repeats, coalesce(n, 0) AS n_docs, coalesce(size, 0.0) AS own_size, target_share > 0 AND coalesce(size, 0) * max_repeats > 0 AS able FROM mix_targets m LEFT JOIN own o ON o.source = m.source),
shares AS (SELECT *, CASE WHEN able THEN target_share / (SELECT sum(target_share) FROM listed WHERE able) ELSE 0 END AS share FROM listed),
whole AS (SELECT min(own_size * max_repeats / share) AS t FROM shares WHERE able)
SELECT source, n_docs, round(own_size, 3) AS own_size, round(share * t, 3) AS goal, round(share * t, 3) AS expected FROM shares, whole""",
    "p10_coverage": r"SELECT doc_id, length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g'))::BIGINT AS n_letters, true AS in_order FROM documents WHERE regexp_matches(text, '\S')",
    "p9_found": f"WITH {P9_SIZES} SELECT m.source FROM mix_targets m LEFT JOIN own o ON o.source = m.source, whole w WHERE coalesce(o.size, 0) * m.max_repeats < m.target_share * w.size",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
