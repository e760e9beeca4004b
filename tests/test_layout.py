"""The registry, and the border of the training-text subpackage."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from mortarline.plans import registry

ROOT = Path(__file__).resolve().parents[1]
DATA = Path("/root/testdata/sf0.001")


def test_core_does_not_import_the_subpackage():
    for path in (ROOT / "mortarline").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "mortarline.llm" not in path.read_text(encoding="utf-8"), path


def test_every_sql_has_its_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(callable(q) for q in entry.queries().values())


QUICK = ["failure_reason_distribution", "entity_rollup", "event_ids", "doi_normalize", "chunk_links_set_null", "entity_export_domain", "bucket_distribution", "lens_failure", "page_sections"]


@pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")
@pytest.mark.parametrize("name", QUICK)
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    df = registry.queries()[name](spark, str(DATA))
    cur = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    same = lambda rows: sorted(repr([round(v, 6) if isinstance(v, float) else str(v) for v in r]) for r in rows)
    assert same(tuple(r[c] for c in names) for r in df.collect()) == same(cur.fetchall())


@pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")
def test_entry_runs(spark):
    assert entry.entry(spark).count() >= 0
