"""The contract without the optional folders."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_document_operators():
    code = ("import sys; sys.modules['millwright.llm'] = None\n"
            "import __spark_entry__ as e; names = [*e.queries(), *e.oracle_sql()]\n"
            "assert 'q01_failure_rate' in names and 'pipeline' not in names and not any(n.startswith('op') for n in names)")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT, timeout=120)
