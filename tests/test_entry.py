"""The driver's contract, also where the training-data subpackage and its pipeline are gone."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__

ROOT = Path(__spark_entry__.__file__).parent


def test_entry(spark):
    rows = __spark_entry__.entry(spark)
    assert rows.columns == ["host", "pages"] and rows.count() > 0


def test_names_and_columns(spark, small):
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 50


def test_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT / "pressmill", tmp_path / "pressmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert q and s and not any(n.startswith('op') or n == 'pipeline' for n in q)"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True)


def test_without_a_module_that_the_subpackage_needs():
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; q = e.queries(); assert q and e.oracle_sql() and 'pipeline' not in q"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, check=True)
