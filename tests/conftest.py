import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tickspark.session import get_spark  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", 8)
    yield s


@pytest.fixture
def tmp_shared(spark, tmp_path):
    """A fresh per-test folder for sinks and checkpoints (pytest's own temporary tree)."""
    return str(tmp_path)
