"""The core does not know the subpackage for training data, and the entry point works without it."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_core_does_not_import_the_subpackage():
    for path in (ROOT / "shoplark").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text(encoding="utf-8"), path


def test_entry_point_without_the_subpackage(tmp_path):
    for path in ROOT.rglob("*.py"):
        place = path.relative_to(ROOT)
        if "llm" not in place.parts and place.parts[0] in ("shoplark", "__spark_entry__.py"):
            (tmp_path / place).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / place).write_bytes(path.read_bytes())
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
