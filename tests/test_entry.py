"""The entry without the corpus subpackage, and with a broken one."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
SAYS = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(e.oracle_sql()), any(x.startswith('op') for x in q))"


def run(folder):
    return subprocess.run([sys.executable, "-B", "-c", SAYS], cwd=folder, capture_output=True, text=True)


def test_entry_without_the_corpus_operators(tmp_path):
    for name in ("__spark_entry__.py", "corpus_pipeline.py", "tickforge"):
        source = ROOT / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__"))
        elif source.exists():
            shutil.copy(source, tmp_path / name)
    shutil.rmtree(tmp_path / "tickforge/llm", ignore_errors=True)
    (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
    bare = run(tmp_path)
    assert bare.returncode == 0 and bare.stdout.split()[2] == "False" and int(bare.stdout.split()[0]) > 60, bare.stderr
    (tmp_path / "tickforge/llm").mkdir()
    (tmp_path / "tickforge/llm/__init__.py").write_text("")
    (tmp_path / "tickforge/llm/registry.py").write_text("import nothing_of_this_name\n")
    broken = run(tmp_path)
    assert broken.returncode and "nothing_of_this_name" in broken.stderr
