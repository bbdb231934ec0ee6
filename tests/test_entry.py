"""The entry point without the optional training-data subpackage."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

LIST = ("import __spark_entry__ as E; q = E.queries(); assert set(E.oracle_sql()) <= set(q); "
        "print(*sorted(q))")


def listed(folder) -> set[str]:
    done = subprocess.run([sys.executable, "-c", LIST], cwd=folder, capture_output=True, text=True,
                          env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert done.returncode == 0, done.stderr
    return set(done.stdout.split())


def copy_of(tmp_path, *left_out):
    skip = shutil.ignore_patterns(".git", "__pycache__", *left_out)
    return shutil.copytree(ROOT, tmp_path / "copy", ignore=skip)


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py")])
def test_entry_without_the_subpackage(tmp_path, left_out):
    names = listed(copy_of(tmp_path, *left_out))
    assert "daily_targets" in names and "pipeline" not in names
    assert not any(n.startswith("op") and n[2:3].isdigit() for n in names)


def test_entry_without_a_library_of_the_subpackage(tmp_path):
    folder = copy_of(tmp_path)
    (folder / "tiktoken.py").write_text("raise ImportError")
    (folder / "public_tokenizers.py").write_text("raise ImportError")
    assert "daily_targets" in listed(folder)


def test_nothing_else_imports_the_subpackage():
    for base, _, files in os.walk(os.path.join(ROOT, "tidemark")):
        if os.path.basename(base) != "llm":
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(base, f), encoding="utf-8") as text:
                        assert "tidemark.llm" not in text.read()
