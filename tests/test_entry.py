"""The driver's contract where an optional library is absent."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

BLOCKED = """
import sys
sys.modules["xxhash"] = None  # importing it fails
import __spark_entry__ as contract
assert not [n for n in contract.queries() if n.startswith("op") or n == "pipeline"]
assert set(contract.oracle_sql()) <= set(contract.queries())
print(len(contract.queries()))
"""


def test_a_missing_library_costs_only_what_needs_it():
    run = subprocess.run([sys.executable, "-c", BLOCKED], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    assert int(run.stdout) > 80
