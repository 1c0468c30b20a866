"""The tests of subpackages bring conftest modules of their own, so helpers lie in plain modules."""

import re
from pathlib import Path


def test_no_test_imports_from_a_conftest():
    for path in Path(__file__).parent.rglob("*.py"):
        assert not re.search(r"^\s*(from|import) conftest", path.read_text(), re.M), path
