from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings, strategies as st

from minuteflow.sources import layout, storage

FORMATS = {4: "%Y", 7: "%Y/%m", 10: "%Y/%m/%d", 13: "%Y/%m/%d/%H", 16: "%Y/%m/%d/%H/%M"}
times = st.datetimes(datetime(2022, 11, 1), datetime(2024, 3, 1))


@settings(max_examples=60, deadline=None)
@given(times, st.integers(0, 60 * 24 * 40))
def test_covering_dirs_hold_exactly_the_range(start, minutes):
    start = layout.to_minute(start)
    stop = start + timedelta(minutes=minutes)
    dirs = layout.covering_dirs(start, stop)
    assert len(dirs) == len(set(dirs)) < 260
    def inside(ts):
        return any(ts.strftime(FORMATS[len(d)]) == d for d in dirs)
    for ts in {start, stop, start + (stop - start) / 2}:
        assert inside(layout.to_minute(ts))
    assert not inside(start - timedelta(minutes=1)) and not inside(stop + timedelta(minutes=1))


def test_whole_units_are_one_directory():
    assert layout.covering_dirs(datetime(2024, 1, 1), datetime(2024, 12, 31, 23, 59)) == ["2024"]
    assert layout.covering_dirs(datetime(2024, 2, 1), datetime(2024, 2, 29, 23, 59)) == ["2024/02"]


def test_named_roots():
    assert layout.named_roots(["/a", "/b"], "local") == {"cluster0": "/a", "cluster1": "/b"}
    with pytest.raises(ValueError):
        layout.named_roots(["/a", "/b"], "merged")
    with pytest.raises(ValueError):
        layout.named_roots([], "local")


def test_edges_skip_empty_branches(tmp_path):
    (tmp_path / "2023/12").mkdir(parents=True)
    (tmp_path / "2024/01/02/03/04").mkdir(parents=True)
    (tmp_path / "2024/01/05/06/07").mkdir(parents=True)
    (tmp_path / "2024/01/09").mkdir(parents=True)
    assert layout.edge_minute(str(tmp_path)) == datetime(2024, 1, 2, 3, 4)
    assert layout.edge_minute(str(tmp_path), last=True) == datetime(2024, 1, 5, 6, 7)
    assert layout.edge_minute(str(tmp_path / "none")) is None


def test_move_is_repeatable(tmp_path):
    (tmp_path / "a").write_text("x")
    for _ in range(2):
        storage.move(str(tmp_path / "a"), f"file:{tmp_path}/d/b")
    assert (tmp_path / "d/b").read_text() == "x"
    with pytest.raises(FileNotFoundError):
        storage.move(str(tmp_path / "none"), str(tmp_path / "none2"))
