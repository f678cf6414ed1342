"""The training-data operators are an optional part of the repository."""

import os
import shutil
import subprocess
import sys

from paths import ROOT


def test_the_rest_works_without_them(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns("llm", ".git", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); print(*q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-1500:]
    names = done.stdout.split()
    assert "canonical_listens" in names and "pipeline" not in names and not any(n.startswith("op1_") for n in names)


def test_nothing_else_imports_them():
    for folder, _, files in os.walk(os.path.join(ROOT, "encore")):
        if os.path.basename(folder) == "llm":
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert "encore.llm" not in f.read(), name
