"""The entry module without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def run(folder, code):
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, timeout=120)


def copied(tmp_path, *without):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=lambda d, names: [n for n in names if n in (".git", "__pycache__", ".pytest_cache") or str(Path(d, n).relative_to(ROOT)) in without])
    return tmp_path / "copy"


def test_imports_without_the_operators(tmp_path):
    for gone in (("quarrystone/llm", "tests/llm"), ("quarrystone/llm", "tests/llm", "corpus_pipeline.py")):
        folder = copied(tmp_path / str(len(gone)), *gone)
        got = run(folder, "import __spark_entry__ as e; q = e.queries(); print(len(q), not any(k.startswith('op') or k == 'pipeline' for k in q), set(e.oracle_sql()) <= set(q))")
        assert got.returncode == 0 and got.stdout.split()[1:] == ["True", "True"], got.stderr


def test_errors_inside_are_raised(tmp_path):
    folder = copied(tmp_path)
    (folder / "quarrystone/llm").mkdir(exist_ok=True)
    (folder / "quarrystone/llm/__init__.py").touch()
    (folder / "quarrystone/llm/catalog.py").write_text("import not_there_at_all\n")
    got = run(folder, "import __spark_entry__")
    assert got.returncode != 0 and "not_there_at_all" in got.stderr
