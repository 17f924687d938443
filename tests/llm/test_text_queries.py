"""The registered text queries: names, SQL agreement, and that nothing else needs the package."""

import re
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tailwake.llm import queries

ROOT = Path(__file__).resolve().parents[2]
SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def test_one_query_per_operator():
    names = list(queries.queries())
    assert [re.match(r"op(\d+)_", n)[1] for n in names] == [str(i) for i in range(1, 14)]
    assert set(names) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql_agrees(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    cursor = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    found = queries.queries()[name](spark, SF_DIR)
    assert sorted(found.columns) == sorted(columns)
    rows = [tuple(r[c] for c in columns) for r in found.collect()]
    assert sorted(rows, key=repr) == sorted(cursor.fetchall(), key=repr)


def test_nothing_else_imports_the_package():
    for path in (ROOT / "tailwake").rglob("*.py"):
        if "llm" not in path.parts:
            assert "tailwake.llm" not in path.read_text(), path


def test_entry_works_without_the_package():
    code = (
        "import sys\n"
        "class Gone:\n"
        "    def find_spec(self, name, *rest):\n"
        "        if name.startswith(('tailwake.llm', 'corpus_pipeline')):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e\n"
        "assert not any(n.startswith('op') or n == 'pipeline' for n in e.queries())\n"
        "assert e.oracle_sql()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
