"""The driver contract, with and without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parents[1]


def test_registry():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and all(callable(f) for f in queries.values())


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["conv_id", "srt", "n_cues"] and rows.count() > 0


def test_works_without_llm(tmp_path):
    shutil.copytree(ROOT / "lectern", tmp_path / "lectern", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(k.startswith('op') for k in q) and len(q) > 30 and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)


def test_works_where_llm_cannot_be_imported(tmp_path):
    shutil.copytree(ROOT / "lectern", tmp_path / "lectern", ignore=shutil.ignore_patterns("__pycache__", "llm"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "lectern" / "llm").mkdir()
    (tmp_path / "lectern" / "llm" / "__init__.py").write_text("import nothing_of_this_name\n")
    code = "import __spark_entry__ as e; q = e.queries(); assert not any(k.startswith('op') for k in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
