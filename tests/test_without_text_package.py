"""The rest registers and imports on a copy of the repository without the text package."""

from __future__ import annotations

import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

from catalog.oracles import oracles
from catalog.queries import all_queries

ROOT = Path(__file__).resolve().parent.parent
SAY = """
import json, __spark_entry__ as e, bench, tests.test_registry
print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))
"""


@pytest.mark.parametrize("leftover", [False, True])
def test_registers_without_it(tmp_path, leftover):
    copy = tmp_path / "copy"
    gone = shutil.ignore_patterns(".git", "__pycache__", "llm", "*.json")
    shutil.copytree(ROOT, copy, ignore=gone)
    if leftover:  # folders of compiled files may stay behind
        (copy / "parley" / "llm" / "__pycache__").mkdir(parents=True)
    env = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
    ran = subprocess.run(
        [sys.executable, "-c", SAY], cwd=copy, env=env, capture_output=True, text=True, timeout=120
    )
    assert ran.returncode == 0, ran.stderr
    queries, sql = json.loads(ran.stdout.splitlines()[-1])
    assert queries == sorted(all_queries()) and sql == sorted(oracles())
