from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lanewise.plans import cells, lanes  # noqa: E402
from lanewise.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture
def all_heavy(monkeypatch):
    """Cut every key, however small, into cells of a few rows, so that all carries are used."""
    find = lanes.heavy_keys
    monkeypatch.setattr(cells, "ROWS", 64)

    def every_key(df, key, min_rows, max_heavy):
        return find(df, key, 0, 10**6)

    monkeypatch.setattr(lanes, "heavy_keys", every_key)
    monkeypatch.setattr(lanes, "FEW", 0)
