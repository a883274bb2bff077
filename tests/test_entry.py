"""The driver's contract, and that nothing outside of it imports the subpackage for model text."""

import re
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_queries_and_sql():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.queries()) > 100


def test_no_import_of_llm():
    for p in (ROOT / "folioforge").rglob("*.py"):
        if "llm" not in p.parts:
            assert not re.search(r"import .*llm|from folioforge\.llm", p.read_text()), p


def test_entry_without_llm():
    code = "import sys; sys.modules['folioforge.llm'] = None; import __spark_entry__ as e; assert 'p5_found' in e.queries() and 'p1_found' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(5).count() == 5
