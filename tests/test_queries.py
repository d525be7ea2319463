"""Driver contract: entry() runs, queries and oracles line up, a sample agrees with DuckDB."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from subword_spark.plans import catalog as C
from tools.check_oracles import digest

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 50 and rows[0].rank == 0


def test_registry_has_oracles():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert set(C.QUERIES) <= set(o)


@pytest.mark.parametrize("name", ["byte_symbols", "pair_counts_chars", "top_pairs", "train_words", "encode_docs", "stats_report", "train_specials", "roundtrip_words", "decode_ids_null", "jobs", "merges_reload"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ["documents", "conversations", "benchmark"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    s = E.queries()[name](spark, SF).toPandas()
    d = con.sql(E.oracle_sql()[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert digest(s) == digest(d)


@pytest.mark.parametrize("how", ["folders gone", "library gone"])
def test_queries_stay_without_the_llm_subpackage(tmp_path, how):
    """The entry imports and registers all other queries when the subpackage, or a library that
    only it needs, is not there."""
    root = os.path.dirname(os.path.abspath(E.__file__))
    skip = shutil.ignore_patterns("llm", "__pycache__") if how == "folders gone" else shutil.ignore_patterns("__pycache__")
    shutil.copytree(f"{root}/subword_spark", tmp_path / "subword_spark", ignore=skip)
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    if how == "library gone":
        shutil.copy(f"{root}/corpus_pipeline.py", tmp_path)
    hide = "import sys; sys.modules['ahocorasick'] = None; " if how == "library gone" else ""
    code = hide + "import __spark_entry__ as E; q, o = E.queries(), E.oracle_sql(); print(len(q), len(o), 'pipeline' in q, any(x.startswith('op') and x[2].isdigit() for x in q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
    assert done.stdout.split() == [str(len(C.QUERIES)), str(len(C.QUERIES)), "False", "False"]
