"""The entry module must import where Spark's own folder holds no jars."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from webtext.functions import stopwords

ROOT = Path(__file__).resolve().parent.parent


def test_entry_imports_without_jars(tmp_path):
    code = (
        f"import sys; sys.path.insert(0, {str(ROOT)!r}); import pyspark; import pyspark.ml.feature\n"
        f"pyspark.__path__[:] = [{str(tmp_path)!r}, *pyspark.__path__]\n"
        "import __spark_entry__ as entry\n"
        "assert len(entry.queries()) > 60 and set(entry.oracle_sql()) <= set(entry.queries())\n"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=tmp_path)
    assert done.returncode == 0, done.stderr


def test_stop_lists_are_plain_data():
    assert [len(stopwords.words(name)) for name in ("english", "french", "russian")] == [181, 156, 151]
    with pytest.raises(ValueError, match="known"):
        stopwords.words("klingon")
