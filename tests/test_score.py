import pytest
from hypothesis import HealthCheck, given, settings as hyp, strategies as st
from pyspark.sql import functions as F

from helpers import DAY, HOUR, START, points
from tidewatch.config import Settings
from tidewatch.operators.baseline import build_missing, hourly_baseline, wanted_slots
from tidewatch.operators.cells import Grain, measure_grain
from tidewatch.operators.score import score_points, with_effective_reaction

BASELINE = "series_key string, slot_ms bigint, n bigint, avg double, dev double, min double, max double"


def baseline(spark, days=range(1, 8)):
    rows = [("s", START - d * DAY, 5, 10.0, 2.0, 5.0, 14.0) for d in days]
    return spark.createDataFrame(rows, BASELINE)


CASES = [
    (12, 0, 0, 0.0),
    (13, 0, 8, 30.0),
    (15, 0, 16, 50.0),
    (15, -1, 0, 0.0),
    (4, 0, -16, -60.0),
    (7, 0, -8, 0.0),
    (4, -2, 0, 0.0),
    (0, 0, -16, 0.0),
    (101, 100, 16, None),
    (100, 100, 0, 0.0),
    (15, -3, 0, 0.0),
    (15, -4, 0, 0.0),
    (15, -5, 0, 0.0),
]


def test_cases(spark):
    frame = points(spark, [(START + 1000 * i, v, r) for i, (v, r, _, _) in enumerate(CASES)])
    rows = score_points(frame, baseline(spark)).orderBy("seq").collect()
    for row, (value, reaction, weight, pct) in zip(rows, CASES):
        assert row.weight == weight, (value, reaction)
        assert row.weight_pct == (None if pct is None else pytest.approx(pct)), (value, reaction)


def test_missing_days_still_divide_by_seven(spark):
    row = score_points(points(spark, [(START, 13, 0)]), baseline(spark, (1, 2, 3))).first()
    assert (row.n_refs, row.weight, row.weight_pct) == (3, 3, pytest.approx(90 / 7))


def test_zero_average_gives_no_percent(spark):
    zero = spark.createDataFrame([("s", START - DAY, 2, 0.0, 0.0, 0.0, 0.0)], BASELINE)
    row = score_points(points(spark, [(START, 3, 0)]), zero).first()
    assert (row.weight, row.weight_pct) == (2, 0.0)


def test_late_and_disabled_points(spark):
    frame = points(spark, [(START, 15, 0), (START + HOUR, 15, 0), (START, 15, -3)])
    late = with_effective_reaction(frame, late_before_ms=F.lit(START + 1))
    assert [r.reaction for r in late.orderBy("seq").collect()] == [-4, 0, -3]
    off = with_effective_reaction(frame, Settings(checks_enabled=False))
    assert [r.reaction for r in off.orderBy("seq").collect()] == [-5, -5, -3]


@hyp(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9 * 24), st.floats(-50, 50), st.sampled_from([0, -1, -2])), min_size=1, max_size=40))
def test_weight_is_bounded(spark, rows):
    frame = points(spark, [(START + h * HOUR, v, r) for h, v, r in rows])
    for row in score_points(frame).collect():
        assert abs(row.weight) <= 16


@pytest.mark.parametrize("grain", [Grain(None, (("s", 60_000),)), Grain(600_000), Grain(DAY)])
def test_cell_length_does_not_matter(spark, grain):
    frame = points(spark, [(START + i * 137_000, (i * 37) % 101, (0, -1, -2)[i % 3]) for i in range(4000)])
    whole = score_points(frame).select("seq", "n_refs", "weight", F.round("weight_pct", 6)).orderBy("seq").collect()
    cells = score_points(frame, grain=grain).select("seq", "n_refs", "weight", F.round("weight_pct", 6)).orderBy("seq").collect()
    assert whole == cells


def test_measured_cells_keep_to_the_target(spark):
    hot = points(spark, [(START + i * 500, 1, 0) for i in range(20_000)], key="hot")
    cold = points(spark, [(START + i * HOUR, 1, 0) for i in range(50)], key="cold")
    grain = measure_grain(hot.unionByName(cold), target_rows=1000)
    assert grain.default_ms is None
    assert dict(grain.listed) == {"hot": 5 * 60_000}
    assert measure_grain(hot.unionByName(cold), target_rows=20, max_listed=1).default_ms is not None


def test_stored_slots_are_never_recomputed(spark):
    early = points(spark, [(START, 1, 0), (START + DAY, 1, 0)])
    stored = build_missing(wanted_slots(early), hourly_baseline(early.limit(0)), early).persist()
    later = early.unionByName(points(spark, [(START + 1, 99, 0), (START + 2 * DAY, 1, 0)]))
    again = build_missing(wanted_slots(later), stored, later)
    assert again.join(stored, ["series_key", "slot_ms"], "left_semi").count() == 0
    assert stored.where("n = 0").count() > 0
