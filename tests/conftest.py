from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from caselake.session import local_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4, app="caselake-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder() -> str:
    return SF


def as_rows(df):
    """Rows as comparable, order-free text."""
    names = sorted(df.columns)
    return sorted(tuple(str(r[n]) for n in names) for r in df.select(*names).collect())
