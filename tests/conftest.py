from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vialflow.session import local_session

    session = local_session(cores="*", shuffle_partitions=8, app="vialflow-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from vialflow.sources.fixtures import derive_lims_tables

    return derive_lims_tables(spark, SF0001)
