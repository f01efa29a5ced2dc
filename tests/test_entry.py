from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_flagship_query(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["date_key", "segment", "nation", "revenue", "line_count"] and df.limit(1).count() == 1
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()


def test_the_rest_stands_without_the_corpus_operators(tmp_path):
    shutil.copytree(ROOT / "tidegate", tmp_path / "tidegate", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 30 and not any(k.startswith('op') or k == 'pipeline' for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
