"""The training-data operators can be taken out: nothing else needs them."""

import re
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_nothing_else_imports_them():
    for path in [*ROOT.glob("starloom/**/*.py"), ROOT / "bench.py", *ROOT.glob("tools/*.py"), *ROOT.glob("tests/*.py")]:
        if "llm" not in path.relative_to(ROOT).parts:
            assert not re.search(r"^\s*(from|import)\s+(starloom\.llm|corpus_pipeline)", path.read_text(), re.M), path


def test_entry_works_without_them():
    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "for name in ('starloom.llm', 'starloom.llm.queries', 'corpus_pipeline'): sys.modules[name] = None\n"
        "import __spark_entry__ as e\n"
        "assert not e.LLM_QUERIES and set(e.queries()) == set(e.oracle_sql()), set(e.queries()) ^ set(e.oracle_sql())\n"
        "assert 'star_sales_by_customer_attr' in e.queries()\n"
    )
    subprocess.run([sys.executable, "-c", code, str(ROOT)], check=True, timeout=120)
