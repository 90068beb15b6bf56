"""The driver's entry module without a session."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import mqstream
from tests.conftest import ROOT

ASK = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q); print(len(q), sum(n.startswith('op') for n in q))"


def without(tmp_path, *gone):
    """The repository without some of its files."""
    path = str(tmp_path / "repo")
    shutil.copytree(ROOT, path, ignore=shutil.ignore_patterns(".git", "__pycache__", "*.md", "*.json"))
    for name in gone:
        target = os.path.join(path, name)
        shutil.rmtree(target) if os.path.isdir(target) else os.remove(target)
    return subprocess.run([sys.executable, "-c", ASK], cwd=path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": path})


def test_the_rest_works_without_the_corpus_operators(tmp_path):
    said = without(tmp_path, "corpus_pipeline.py", "mqstream/llm", "tests/llm")
    assert said.returncode == 0, said.stderr
    assert int(said.stdout.split()[0]) > 60 and said.stdout.split()[1] == "0"


def test_what_is_broken_is_not_hidden(tmp_path):
    if os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")):
        assert without(tmp_path, "mqstream/operators/metrics.py").returncode != 0


def test_build_info(tmp_path):
    info = mqstream.build_info()
    assert info["version"] == mqstream.__version__ and all(info.values()) and info["built"].startswith("20")
    assert mqstream.commit_of(tmp_path) == "unknown"
    (tmp_path / ".git").mkdir()
    (tmp_path / ".git" / "HEAD").write_text("ref: refs/heads/main\n")
    (tmp_path / ".git" / "packed-refs").write_text("# pack-refs\n0123456789abcdef refs/heads/main\n")
    assert mqstream.commit_of(Path(tmp_path)) == "0123456789ab"


def test_imports_without_a_session():
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q)); assert set(o) <= set(q)"], cwd=ROOT, capture_output=True, text=True)
    assert said.returncode == 0, said.stderr
    assert int(said.stdout) > 60
