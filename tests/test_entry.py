"""The entry file with the training-data operators taken away."""

import pathlib
import shutil
import subprocess
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("left", ["nothing", "caches"])
def test_entry_imports_without_the_training_data_operators(tmp_path, left):
    shutil.copytree(ROOT / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("__pycache__", "llm"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    pipeline = ROOT / "corpus_pipeline.py"
    if pipeline.exists():
        shutil.copy(pipeline, tmp_path)
    if left == "caches":
        (tmp_path / "tidemark/llm/__pycache__").mkdir(parents=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'psi_by_lang' in q and 'pipeline' not in q; print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"}, timeout=120)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) > 80


def test_entry_has_the_pipeline_only_with_its_operators():
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as entry

    names = entry.queries()
    assert ("pipeline" in names) == any(n.startswith("op10_") for n in names)
