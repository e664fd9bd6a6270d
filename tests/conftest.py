import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from geonet.session import local_session

    session = local_session("8", shuffle_partitions=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture
def segments(spark):
    """Segment table from (line_id, seg_idx, x1, y1, x2, y2[, road_type]) rows."""

    def make(rows, key="line_id"):
        rows = [(*r[:2], *map(float, r[2:6]), r[6] if len(r) > 6 else "path") for r in rows]
        return spark.createDataFrame(rows, f"{key} bigint, seg_idx int, x1 double, y1 double, x2 double, y2 double, road_type string")

    return make


@pytest.fixture
def points(spark):
    return lambda rows: spark.createDataFrame([(float(x), float(y)) for x, y in rows], "x double, y double")


@pytest.fixture
def forced_splits(monkeypatch):
    """Make every key, cell and block count as hot, so that small data takes the paths of skewed data."""
    from geonet.operators import discs, grid, scan, skew

    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    monkeypatch.setattr(grid, "HOT_CELL_ROWS", 3)
    monkeypatch.setattr(scan, "BLOCK_ROWS", 3)
