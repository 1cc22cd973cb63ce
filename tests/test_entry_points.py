"""The entry points import without the optional parts of the repository."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("left_out", [["ledgermill/llm"], ["ledgermill/llm", "corpus_pipeline.py"]])
def test_import_without_training_data_operators(tmp_path, left_out):
    shutil.copytree(ROOT / "ledgermill", tmp_path / "ledgermill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out and (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path / name)
    code = "import __spark_entry__ as e; assert e.queries() and e.oracle_sql(); assert not any(q.startswith('op') and '_' in q and q[2].isdigit() for q in e.queries()); assert 'pipeline' not in e.queries()"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
