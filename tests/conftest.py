import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from parcelyze.session import build_session
    s = build_session("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_model(spark):
    """Lazily planned star schema over the sf0.001 adapter (no materialization)."""
    from parcelyze.operators.model import StarModel
    from parcelyze.sources.adapter import raw_model
    return StarModel(raw_model(spark, SF001))
