"""Nothing outside the training-data subpackage imports it, and the entry module works without it."""

import re
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_no_imports():
    for p in [*ROOT.glob("vocabmill/**/*.py"), ROOT / "bench.py"]:
        if "llm" not in p.parts:
            assert not re.search(r"^\s*(from|import)\s+\S*llm", p.read_text(), re.M), p


def test_entry_without_it(tmp_path):
    (tmp_path / "vocabmill").symlink_to(ROOT / "vocabmill")
    code = "import sys; sys.modules['vocabmill.llm'] = None; import __spark_entry__ as e; assert 'closure_full' in e.queries() and 'op1_decontaminate' not in e.queries()"
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
