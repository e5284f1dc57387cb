from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from marquee.schema import RAW_SCHEMA  # noqa: E402
from marquee.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", 8, app="marquee-tests")
    yield s
    s.stop()


def raw_row(show_id, **kw):
    """A raw catalog row with sane defaults; override any column by name."""
    row = {
        "show_id": show_id, "type": "Movie", "title": f"T {show_id}", "director": "Dir",
        "cast": "A, B", "country": "France", "date_added": "January 5, 2021",
        "release_year": 2020, "rating": "PG", "duration": "90 min", "listed_in": "Dramas",
        "description": "d",
    }
    row.update(kw)
    return tuple(row[f.name] for f in RAW_SCHEMA.fields)


@pytest.fixture
def make_raw(spark):
    def _make(rows):
        return spark.createDataFrame(rows, RAW_SCHEMA)
    return _make
