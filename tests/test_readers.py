"""Text readers that take a file in many byte ranges."""

import json
import random

import pytest

from tarnworks.sources import files


@pytest.fixture
def small_ranges(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def many_tasks(df):
    return df.rdd.getNumPartitions() > 5


@pytest.mark.parametrize("form", [{}, {"indent": 1}, {"separators": (",", ":")}])
def test_edges_of_one_file_in_many_ranges(spark, tmp_path, small_ranges, form):
    rng = random.Random(1)
    for name in ("a", "b"):
        edges = [[rng.randrange(3), rng.randrange(-5, 10**6), rng.randrange(5), rng.randrange(10**12)] for _ in range(500)]
        (tmp_path / f"{name}.json").write_text(json.dumps({"meta": {"total_edges": 500, "box": [1, 2, 3, 4], "by": "[x, [y]"}, "edges": edges}, **form))
        assert many_tasks(files._pieces(spark, str(tmp_path / f"{name}.json"), "]"))
        got = files.read_edges(spark, str(tmp_path / f"{name}.json")).orderBy("pos").collect()
        assert [list(r) for r in got] == [[*e, k] for k, e in enumerate(edges)]
    both = files.read_edges(spark, str(tmp_path))
    assert both.count() == 2 * files.read_edges(spark, str(tmp_path / "a.json")).count()


def test_odd_edges(spark, tmp_path):
    def read(value):
        (tmp_path / "g.json").write_text(json.dumps(value))
        return [tuple(r) for r in files.read_edges(spark, str(tmp_path / "g.json")).orderBy("pos").collect()]

    assert read({"meta": {"total_edges": 0}, "edges": []}) == [] and read({}) == []
    assert read({"edges": [[1, None, 3], []], "meta": {}}) == [(1, None, 3, None, 0), (None,) * 4 + (1,)]


def test_grid_of_one_file_in_many_ranges(spark, tmp_path, small_ranges):
    rng = random.Random(2)
    grid = [[rng.choice([-9999, rng.randrange(100)]) for _ in range(40)] for _ in range(30)]
    head = "ncols 40\nnrows 30\nxllcorner 0\nyllcorner 0\ncellsize 1\nNODATA_value  -9999\n"
    (tmp_path / "d.asc").write_text(head + "".join("  " + "  ".join(map(str, r)) + " \r\n\n" for r in grid))
    (tmp_path / "e.asc").write_text("1 2\n3 4\n")
    assert many_tasks(files._pieces(spark, str(tmp_path / "d.asc")))
    got = files.read_ascii_grid(spark, str(tmp_path)).collect()
    d = {(r.col, r.row): r.value for r in got if r.path.endswith("d.asc")}
    assert d == {(c, 29 - k): None if v == -9999 else float(v) for k, row in enumerate(grid) for c, v in enumerate(row)}
    assert {(r.col, r.row): r.value for r in got if r.path.endswith("e.asc")} == {(0, 1): 1, (1, 1): 2, (0, 0): 3, (1, 0): 4}
