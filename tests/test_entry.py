"""The driver's entry works without the optional training-data operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent
CODE = """
import sys
for name in {blocked!r}:
    sys.modules[name] = None
import __spark_entry__ as e
from stationlake.plans.registry import REGISTRY
assert set(e.queries()) == set(REGISTRY), set(e.queries()) ^ set(REGISTRY)
assert set(e.oracle_sql()) <= set(REGISTRY)
"""


def test_without_the_optional_modules():
    for blocked in (["corpus_pipeline"], ["stationlake.llm"]):
        subprocess.run([sys.executable, "-c", CODE.format(blocked=blocked)], cwd=ROOT, check=True)
