"""What runs in Python workers travels by value: a worker needs no copy of the library."""

import importlib
import inspect
import pkgutil
import subprocess
import sys

import pytest
from pyspark import cloudpickle

import skewloom.llm

MODULES = [m.name for m in pkgutil.iter_modules(skewloom.llm.__path__) if m.name not in ("oracles", "queries")]
LOAD = """
import pickle, sys
found = pickle.load(sys.stdin.buffer)
assert not any(name.startswith("skewloom") for name in sys.modules), sys.modules
print(len(found))
"""


def travels(member) -> bool:
    """Functions of frames stay with the driver; all others may be called in a worker."""
    text = str(inspect.signature(member)) if inspect.isfunction(member) else ""
    return not any(name in text for name in ("DataFrame", "SparkSession", "Column"))


@pytest.mark.parametrize("name", MODULES)
def test_functions_load_without_the_library(name, tmp_path):
    module = importlib.import_module(f"skewloom.llm.{name}")
    members = [m for m in vars(module).values() if getattr(m, "__module__", "") == module.__name__ and travels(m)]
    run = subprocess.run([sys.executable, "-I", "-c", LOAD], input=cloudpickle.dumps(members), capture_output=True, cwd=tmp_path)
    assert run.returncode == 0, run.stderr.decode()
    assert int(run.stdout) == len(members)
