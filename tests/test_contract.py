"""The registered queries against DuckDB; ``VERIGRID_FULL=1`` runs every one of them."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import verify
from verigrid.queries import all_queries, all_sql

FOLDER = "/root/testdata/sf0.001"
QUICK = "prj01 fn02 join13 agg05 agg12 win03 win05 win08 map03 mat01 mat11 mat17 dim05 fct01 mrt01 mrt02 mrt06 dq18 geo06 geo09 snk05 src02 src13".split()
NAMES = list(all_queries()) if os.environ.get("VERIGRID_FULL") else QUICK


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in verify.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("gone", [["verigrid/llm"], ["verigrid/llm", "corpus_pipeline.py"]])
def test_the_rest_loads_without_training_data_operators(tmp_path, gone):
    root = Path(contract.__file__).parent
    for name in ("verigrid", "__spark_entry__.py", "corpus_pipeline.py"):
        copy = shutil.copytree if (root / name).is_dir() else shutil.copy
        if (root / name).exists() and name not in gone:
            copy(root / name, tmp_path / name, **({"ignore": lambda _, names: {"llm"} & set(names)} if copy is shutil.copytree else {}))
    said = subprocess.run(
        [sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
        cwd=tmp_path, capture_output=True, text=True, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)},
    )
    assert said.stdout.split() == [str(len(all_queries()))] * 2


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    note, _, good = verify.compare(spark, duck, name, FOLDER)
    assert good, note
