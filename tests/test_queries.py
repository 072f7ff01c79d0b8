"""Every named query with SQL against DuckDB on the smallest tables; the rest must run."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from compare import compare, connect

from brightloom.plans.registry import PLANS

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# Minutes of model fits each; `python tests/compare.py` runs them with all others.
SLOW = ("model_compare", "best_model_choice", "permutation_importance")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n in PLANS if n not in SLOW])
def test_query(spark, connection, name):
    ok, note = compare(spark, connection, *PLANS[name], SF_DIR)
    spark.catalog.clearCache()
    assert ok, note


def test_contract_without_the_llm_package():
    """The other queries load where the llm package and its pipeline are not there, and no jar is looked for."""
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[:2] == ["brightloom", "llm"] or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
names = set(entry.queries())
assert "rfm" in names and not any(n.startswith("op") and n[2].isdigit() for n in names), names
"""
    root = Path(__file__).resolve().parents[1]
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
