import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session, shared_root

    s = build_session("tidemark-tests", master="local[*]", shuffle_partitions=8)
    from tidemark.operators.model import GBTParams
    from tidemark.plans import catalog

    catalog.TRAIN_PARAMS = GBTParams(max_iter=30, patience=5)  # the queries' own settings boost 100 rounds past the best
    shared_root(s)  # sets a temporary checkpoint folder only when none is configured
    yield s


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL
