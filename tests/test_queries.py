"""Every registered query against its SQL, and the driver contract."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as contract
from warehouse_queries import REGISTERED

SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
    "DOUBLE": "double", "FLOAT": "float", "DATE": "date",
}


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_matches_its_sql(spark, sf_dir, database, name):
    query, sql = REGISTERED[name]
    df = query(spark, sf_dir)
    found = spark_rows(df)
    assert sum(found[1].values()) > 0
    if sql is not None:
        assert found == sql_rows(database, sql)
        types = {d[0]: str(d[1]) for d in database.execute(sql).description}
        expected = {n: SPARK_TYPES.get(t, t.lower().replace(" ", "")) for n, t in types.items()}
        assert dict(df.dtypes) == expected


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(REGISTERED) <= set(contract.queries())
    assert contract.entry(spark).columns[0] == "order_id"


IMPORTED = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.WAREHOUSE), 'pipeline' in e.queries())"


@pytest.mark.parametrize("with_pipeline", [False, True])
def test_entry_imports_without_the_corpus_operators(tmp_path, with_pipeline):
    top = os.path.dirname(os.path.abspath(contract.__file__))
    tree = tmp_path / "tree"
    shutil.copytree(top, tree, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache"))
    if not with_pipeline and (tree / "corpus_pipeline.py").exists():
        (tree / "corpus_pipeline.py").unlink()
    run = subprocess.run([sys.executable, "-c", IMPORTED], cwd=tree, capture_output=True, text=True, timeout=120)
    assert run.stdout.split() == ["True", "False"], run.stderr
