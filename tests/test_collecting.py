"""The tests load in one command, with and without the optional text operators."""

import ast
import os
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))


def test_no_test_imports_from_conftest():
    """Two folders hold a conftest.py; which of them the name means depends on the order."""
    for folder, _, names in os.walk(HERE):
        for name in names:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as source:
                    tree = ast.parse(source.read())
                found = {n.module for n in ast.walk(tree) if isinstance(n, ast.ImportFrom)}
                assert "conftest" not in found, name


@pytest.mark.parametrize("extra", [(), ("--ignore", os.path.join(HERE, "llm"))])
def test_everything_collects(extra):
    command = [sys.executable, "-m", "pytest", HERE, "--collect-only", "-q", *extra]
    done = subprocess.run(
        command, capture_output=True, text=True, cwd=os.path.dirname(HERE), timeout=300)
    assert done.returncode == 0, done.stdout[-2000:]
