"""The entry without the optional folders, and from a working folder that knows nothing of the package."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
REST = "import __spark_entry__ as e; assert set(e.oracle_sql()) <= set(e.queries()); print(len(e.queries()), 'pipeline' in e.queries())"


@pytest.mark.parametrize("also_pipeline", [True, False])
def test_entry_without_the_optional_folders(tmp_path, also_pipeline):
    shutil.copytree(ROOT / "tandem", tmp_path / "tandem", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    if also_pipeline and (ROOT / "corpus_pipeline.py").exists():
        shutil.copy(ROOT / "corpus_pipeline.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", REST], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    count, pipeline = out.stdout.split()
    assert int(count) > 80 and pipeline == "False"
