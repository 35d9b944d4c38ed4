"""Registered queries against their SQL on the smallest driver tables, where those are there."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import bench
from shelfmark.plans import catalogue

DATA = Path("/root/testdata/sf0.001")
ROOT = Path(__file__).resolve().parent.parent
#: The headline queries and those that write what they read; the driver compares all of them.
NAMES = sorted({*bench.HEADLINES, "k5_kept_claims", "k10_kept_facts", "k14_kept_specs", "s8_catalogue_files", "s1_mixed_batches", "s4_sitemap_files", "s6_mixed_bindings", "a4_rank_logos", "a13_toggle_log", "q12_audit_sample", "r20_brand_aliases"})


@pytest.mark.skipif(not DATA.exists(), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    got = catalogue.QUERIES[name](spark, str(DATA))
    columns = sorted(got.columns)
    rows = sorted([tuple(str(r[c]) for c in columns) for r in got.collect()])
    sql = con.sql(f"SELECT {', '.join(columns)} FROM ({catalogue.SQL[name]})").fetchall()
    assert rows == sorted(tuple(map(str, r)) for r in sql)


def test_every_query_has_sql():
    assert set(catalogue.SQL) == set(catalogue.QUERIES)


def test_entry_imports_without_the_training_data_part(tmp_path):
    """On a copy from which the folders and the pipeline are gone."""
    shutil.copytree(ROOT / "shelfmark", tmp_path / "shelfmark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q) and not any(n.startswith('op') or n == 'pipeline' for n in q); print(len(q))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) == len(catalogue.QUERIES)


def test_title_verdicts_decode_what_their_sql_decodes(spark, tmp_path):
    """Titles that end within an entity, and entities that the SQL leaves alone."""
    import duckdb

    titles = ["Hello the&amp;&amp", "Piano &amp; Organ &lt;x&gt; | X", "&quot;Synth&quot; &#39;x&#39; | X", "Tea &ampere | X", "Synth &amp;amp; Organ | X", "&eacute;", "Synth &#38; Drum | X", "Synth &AMP; Drum | X", "", "|", "a|b"]
    pages = spark.createDataFrame([(i, f"<html><title>{t}</title></html>") for i, t in enumerate(titles)] + [(98, "no title"), (99, None)], "page_id long, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = catalogue.QUERIES["c6_title_verdicts_over_tables"](spark, str(tmp_path)).collect()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.sql(f"SELECT page_id, verdict FROM ({catalogue.SQL['c6_title_verdicts_over_tables']})").fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
    assert dict(want)[0] == "not-instrument" and dict(want)[1] == "instrument"
