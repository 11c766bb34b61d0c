"""The entry without the text operators, or without what they import."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SAYS = "import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') for n in e.queries()))"


@pytest.mark.parametrize("lost", ["folders", "package"])
def test_other_queries_stay(tmp_path, lost):
    for name in ("__spark_entry__.py", "cairn"):
        (shutil.copytree if (ROOT / name).is_dir() else shutil.copy)(ROOT / name, tmp_path / name)
    if lost == "folders":
        shutil.rmtree(tmp_path / "cairn" / "llm", ignore_errors=True)
    else:
        (tmp_path / "public_tokenizers.py").write_text("raise ImportError('public_tokenizers')")
    out = subprocess.run([sys.executable, "-c", SAYS], cwd=tmp_path, capture_output=True, text=True, timeout=120, check=True)
    n, text = map(int, out.stdout.split()[-2:])
    assert n >= 135 and text == 0
    assert ("no text operators" in out.stderr) == (lost == "package" and (tmp_path / "cairn" / "llm").exists())
