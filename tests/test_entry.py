"""The driver's entry with and without the optional modules."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]


@pytest.mark.parametrize("blocked", ["trailmart.llm", "xxhash", "corpus_pipeline"])
def test_other_queries_stay_when_an_optional_import_fails(blocked):
    text = f"""
import sys, warnings
sys.modules[{blocked!r}] = None
warnings.simplefilter("ignore")
import __spark_entry__ as driver
names = driver.queries()
assert "daily_traffic" in names and set(driver.oracle_sql()) <= set(names)
assert "pipeline" not in names
"""
    done = subprocess.run([sys.executable, "-c", text], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
