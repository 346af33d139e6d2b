"""The library without its optional text operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
CODE = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.oracle_sql()) - set(e.queries())), [q for q in e.queries() if q == 'pipeline' or q.startswith('op')])"


@pytest.mark.parametrize("left", [[], ["corpus_pipeline.py"], ["tidemark/llm/__pycache__/x.pyc"]], ids=["neither", "pipeline", "cache"])
def test_the_entry_imports_without_them(tmp_path, left):
    shutil.copytree(ROOT / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    for name in left:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes((ROOT / name).read_bytes() if name.endswith(".py") and (ROOT / name).exists() else b"")
    said = subprocess.run(
        [sys.executable, "-B", "-c", CODE], cwd=tmp_path, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True, timeout=120
    )
    assert said.returncode == 0, said.stderr
    n, *rest = said.stdout.split(maxsplit=1)
    assert int(n) > 100 and rest == ["[] []\n"]
