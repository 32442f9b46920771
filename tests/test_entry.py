"""The entry module works with and without the corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]


def test_entry_runs(spark, sf_dir):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.queries()["variant_summary"](spark, sf_dir).count() > 0


def test_imports_without_the_corpus_operators(tmp_path):
    shutil.copytree(REPO / "helixtext", tmp_path / "helixtext", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'tag_hgvs' in q and not any(n.startswith('op') for n in q); assert 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
