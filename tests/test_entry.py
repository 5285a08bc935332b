"""The entry module, also in a copy of the repository without the subpackage for training text."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
ASK = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


def listed(folder):
    answer = subprocess.run([sys.executable, "-c", ASK], cwd=folder, capture_output=True, text=True, check=True, timeout=300)
    return json.loads(answer.stdout.splitlines()[-1])


@pytest.mark.parametrize("with_pipeline_file", [True, False])
def test_entry_without_the_folders_for_training_text(tmp_path, with_pipeline_file):
    copy = tmp_path / "repo"
    left_out = shutil.ignore_patterns(".git", "__pycache__", "llm", *([] if with_pipeline_file else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, copy, ignore=left_out)
    names, with_sql = listed(copy)
    assert len(names) >= 180 and set(with_sql) <= set(names)
    assert "pipeline" not in names and not any(name.startswith("op") for name in names)


def test_entry_lists_what_is_there():
    names, with_sql = listed(ROOT)
    assert set(with_sql) <= set(names)
    numbered = {name.split("_")[0] for name in names if name.startswith("op")}
    if (ROOT / "wordgrove" / "llm").exists() and (ROOT / "corpus_pipeline.py").exists():
        assert numbered == {f"op{n}" for n in range(1, 14)} and "pipeline" in names
