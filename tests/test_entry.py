"""The contract module without the text operators."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def imported_from(folder) -> list[str]:
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=folder, env=env, capture_output=True, text=True, check=True)
    return [line.split() for line in run.stdout.splitlines()]


def copied(folder, *left_out):
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if name not in left_out:
            shutil.copy(os.path.join(ROOT, name), folder)
    ignored = shutil.ignore_patterns("__pycache__", *left_out)
    shutil.copytree(os.path.join(ROOT, "subscope"), folder / "subscope", ignore=ignored)
    return folder


def test_without_folder_and_pipeline(tmp_path):
    names, checked = imported_from(copied(tmp_path, "llm", "corpus_pipeline.py"))
    assert len(names) >= 49 and set(checked) == set(names)
    assert "pipeline" not in names and not [n for n in names if n.startswith("op")]


def test_pipeline_file_without_the_folder(tmp_path):
    names, _ = imported_from(copied(tmp_path, "llm"))
    assert len(names) >= 49 and "pipeline" not in names
