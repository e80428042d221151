from __future__ import annotations

import ast
import glob
import importlib
import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPTS = sorted(glob.glob(f"{ROOT}/examples/*.py"))


@pytest.mark.parametrize("path", SCRIPTS, ids=os.path.basename)
def test_example_names_exist(path):
    """The scripts run until stopped; here they parse and import existing names."""
    with open(path) as f:
        tree = ast.parse(f.read())
    assert ast.get_docstring(tree).startswith(os.path.basename(path))
    for node in ast.walk(tree):
        if isinstance(node, ast.ImportFrom) and node.module.startswith("sluiceworks"):
            module = importlib.import_module(node.module)
            assert all(hasattr(module, alias.name) for alias in node.names)


def test_examples_are_listed():
    with open(f"{ROOT}/examples/README.md") as f:
        text = f.read()
    assert all(f"`{os.path.basename(path)}`" in text for path in SCRIPTS)
