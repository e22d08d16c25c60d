import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from hourstar.operators.grid import Grid
from hourstar.operators.increments import add_batch, current_series
from hourstar.operators.series import complete_series

START = datetime(2024, 1, 1)
SCHEMA = "station string, at timestamp, pm decimal(10,1), id bigint"


def stamp(hour):
    return (START + timedelta(hours=hour)).strftime("%Y-%m-%d %H:%M:%S")


def grid(hours, chunk=48):
    return Grid(stamp(0), stamp(hours - 1), chunk=chunk)


class Batches:
    """Adds batches and holds each state against a full rebuild."""

    def __init__(self, spark, path):
        self.spark, self.path, self.rows, self.listed = spark, str(path), {}, {}

    def add(self, name, rows, stations, hours):
        df = self.spark.createDataFrame([(s, START + timedelta(hours=h), Decimal(v).quantize(Decimal("0.1")), k) for s, h, v, k in rows], SCHEMA)
        listed = self.spark.createDataFrame([(s,) for s in stations], "station string")
        self.rows[name], self.listed[name] = df, listed
        names = dict(entity="station", time="at", value="pm")
        touched = add_batch(self.path, name, df, listed, order="id", grid=grid(hours), **names)
        every, entities = None, None
        for n in self.rows:
            every = self.rows[n] if every is None else every.union(self.rows[n])
            entities = self.listed[n] if entities is None else entities.union(self.listed[n])
        whole = complete_series(every, entities, order="id", grid=grid(hours), **names)
        found = current_series(self.spark, self.path, entity_type="string", value_type="decimal(10,1)", grid=grid(hours), **names)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
        return {(r.station, r._chunk) for r in touched.collect()}


def test_batches_equal_a_full_rebuild(spark, tmp_path):
    rng, state = random.Random(1), Batches(spark, tmp_path)
    stations = ["a", "b", "c d"]
    first = [(s, h, rng.randint(0, 90), k) for k, (s, h) in enumerate((s, h) for s in stations for h in range(240) if rng.random() < 0.8)]
    assert len(state.add("1", first, [*stations, "silent"], 240)) == 4 * 5
    # Late readings, several of an hour, off the grid; a station's first ones.
    late = [(rng.choice(stations), rng.randint(0, 239), rng.randint(0, 90), 5000 + k) for k in range(30)] + [("a", 3.5, 7, 1), ("a", 900, 7, 2)]
    state.add("2", late + [("silent", 100, 4, 9000)], stations, 240)
    # The grid grows within the last chunk and beyond it; a new station.
    state.add("3", [(s, h, rng.randint(0, 90), 6000 + h) for s in stations for h in range(240, 270)] + [("new", 5, 1, 1)], [*stations, "new"], 270)
    state.add("4", [], [], 300)
    # A repeated batch changes nothing.
    state.add("2", late + [("silent", 100, 4, 9000)], stations, 300)


@pytest.mark.parametrize(("hour", "chunks"), [(100, {2}), (143, {2, 3}), (121, {2, 3}), (119, {2})])
def test_only_chunks_in_reach_are_touched(spark, tmp_path, hour, chunks):
    """Series without gaps and means that stay: the chunk of the reading, and the next one if its window reaches back."""
    state = Batches(spark, tmp_path)
    state.add("1", [(s, h, 20, h) for s in "ab" for h in range(480)], "ab", 480)
    assert state.add("2", [("a", hour, 20, -1)], "a", 480) == {("a", c) for c in chunks}


def test_changed_mean_touches_chunks_with_gaps(spark, tmp_path):
    state = Batches(spark, tmp_path)
    state.add("1", [(s, h, 20, h) for s in "ab" for h in range(480) if h not in (200, 300, 400)], "ab", 480)
    assert state.add("2", [("a", 10, 90_000, 1000)], "a", 480) == {("a", c) for c in (0, 4, 6, 8)}
