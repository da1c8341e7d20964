import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from factloom.plans import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def plain(v):
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else round(v, 6) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    r = con.sql(SQL[name])
    got = QUERIES[name](spark, DIR)
    assert sorted(got.columns) == sorted(r.columns)
    order = [got.columns.index(c) for c in r.columns]
    assert sorted(repr(plain([row[i] for i in order])) for row in got.collect()) == sorted(repr(plain(row)) for row in r.fetchall())


def test_library_stands_without_the_corpus_operators(tmp_path):
    """Nothing outside names the optional folder but the entry module, and that works without it."""
    root = Path(__spark_entry__.__file__).parent
    for f in (root / "factloom").rglob("*.py"):
        if "llm" not in f.relative_to(root).parts:
            assert "factloom.llm" not in f.read_text()
    import shutil

    shutil.copytree(root / "factloom", tmp_path / "factloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; assert len(e.queries()) > 40 and not any(q.startswith('op1') or q == 'pipeline' for q in e.queries()); print('fine')"], cwd=tmp_path, env={"PYTHONPATH": str(tmp_path), "PATH": "/usr/bin:/bin"}, capture_output=True, text=True)
    assert "fine" in said.stdout, said.stderr
