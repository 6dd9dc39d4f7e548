"""The library works without the training-data subpackage."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
import sys
for name in {missing}:
    sys.modules[name] = None
import __spark_entry__ as e
names = set(e.queries())
assert names == set(e.QUERIES) and set(e.oracle_sql()) <= names and len(names) > 40
assert not any(n.startswith("op") or n == "pipeline" for n in names)
"""


def test_entry_without_the_subpackage():
    for missing in (["txrisk.llm", "corpus_pipeline"], ["txrisk.llm"], ["corpus_pipeline"]):
        done = subprocess.run([sys.executable, "-c", CODE.format(missing=missing)], cwd=ROOT, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr[-500:]


def test_nothing_else_imports_the_subpackage():
    for folder, _, files in os.walk(os.path.join(ROOT, "txrisk")):
        if "llm" in os.path.relpath(folder, ROOT).split(os.sep):
            continue
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as f:
                    assert "txrisk.llm" not in f.read(), name
