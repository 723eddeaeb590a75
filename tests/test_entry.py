"""Every award query gives the rows of its SQL, and the entry stands without the text operators."""

import subprocess
import sys

import duckdb
import pytest

from ledgerline.plans.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else str(v)


@pytest.mark.parametrize("name", ["c06_table_many_metrics", "c11_agency_breakdown", "e01_award_summary", "d05_manifest_upsert", "b22_codebook", "h01b_stream_refresh", "i01_replace_guard"])
def test_query_equals_its_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    want = duck.execute(ORACLE_SQL[name])
    cols = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(cols)
    got = sorted(tuple(plain(v) for v in r) for r in df.select(cols).collect())
    assert got == sorted(tuple(plain(v) for v in r) for r in want.fetchall())


def test_entry_without_text_operators():
    code = "import sys\nfor m in ('ledgerline.llm', 'corpus_pipeline'): sys.modules[m] = None\nimport __spark_entry__ as e\nq = e.queries()\nassert q and not any(k.startswith('op') for k in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/", 2)[0])
