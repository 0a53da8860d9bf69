import random

import pytest
from hypothesis import given, settings as hyp, strategies as st
from pyspark.sql import functions as F

from helpers import DAY, START, brute_states, level_samples, points
from tidewatch.functions.steps import compose, fixed_step, identity_step, next_level, step_of
from tidewatch.config import DEFAULTS, LevelRule
from tidewatch.operators.baseline import hourly_baseline
from tidewatch.operators.cells import Grain, WHOLE_SERIES
from tidewatch.operators.control import count_before
from tidewatch.operators.hysteresis import level_states, with_level_times
from tidewatch.operators.levels import levels_in_use, rules_literal, tenant_dead_letters, tenant_rules
from tidewatch.operators.regression import regression_totals, running_regression
from tidewatch.operators.resume import last_samples, merged_totals
from tidewatch.plans.monitor import monitor
from tidewatch.session import cut_lineage

DEFAULT_RECS = dict(enumerate((3, 3, 3, 2, 2, 1)))
LEVELS = tuple(range(6))
SMALL_CELLS = Grain(None, (("s", 5 * 60_000),))

steps = st.lists(st.integers(-1, 5), min_size=1, max_size=15).map(lambda x: step_of(x, x[-1], DEFAULT_RECS, LEVELS))


@given(steps, steps, steps)
def test_composition_is_associative(a, b, c):
    assert compose(compose(a, b), c) == compose(a, compose(b, c))
    assert compose(identity_step(LEVELS), a) == a == compose(a, identity_step(LEVELS))


@hyp(max_examples=200)
@given(st.lists(st.integers(-1, 5), max_size=60))
def test_step_function_matches_lists(levels):
    state, window, got = -1, [], []
    for level in levels:
        window = [*window, level][-15:]
        after = next_level(window, level, DEFAULT_RECS, state)
        got.append((state, after, max(window) > -1 or state != -1))
        state = after
    assert got == brute_states(levels)


def run(spark, levels, grain=WHOLE_SERIES):
    states = level_states(level_samples(spark, levels), grain)
    rows = states.orderBy("seq").select("prev_level", "state_level", "state", "emitted").collect()
    return [tuple(r) for r in rows]


def test_too_few_samples_stay_unchanged(spark):
    assert run(spark, [2, 2, 2]) == [(-1, -1, 1, True)] * 3


def test_fourth_sample_starts(spark):
    assert run(spark, [2, 2, 2, 2, 2])[3:] == [(-1, 2, 0, True), (2, 2, 1, True)]


def test_alert_ends_when_its_samples_leave_the_window(spark):
    rows = run(spark, [2] * 4 + [-1] * 19)
    assert rows[15] == (2, -1, 3, True)
    assert sum(r[3] for r in rows) == 18
    assert not any(r[3] for r in rows[18:])


def test_lower_level_needs_its_own_recurrence(spark):
    rows = run(spark, [5, 5] + [1] * 14)
    assert rows[1][:3] == (-1, 5, 0)
    assert [r[1] for r in rows[2:5]] == [5, 5, 5]
    assert rows[5][:3] == (5, 1, 2)
    assert sum(r[3] for r in rows) == 16


@pytest.mark.parametrize("grain", [WHOLE_SERIES, SMALL_CELLS, Grain(60_000), Grain(3_600_000)])
def test_random_levels_match_lists(spark, grain):
    rng = random.Random(7)
    levels = [rng.choice([-1, -1, -1, 0, 1, 2, 3, 4, 5]) for _ in range(400)] + [-1] * 40 + [3] * 30
    expected = brute_states(levels)
    assert [(r[0], r[1], r[3]) for r in run(spark, levels, grain)] == expected


def test_small_arrow_batches_change_nothing(spark):
    levels = [random.Random(3).choice([-1, 1, 2, 5]) for _ in range(300)]
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    try:
        assert [(r[0], r[1], r[3]) for r in run(spark, levels)] == brute_states(levels)
    finally:
        spark.conf.set(name, before)


@pytest.mark.parametrize("partitions", ["1", "32"])
def test_partition_count_changes_nothing(spark, partitions):
    levels = [random.Random(5).choice([-1, 0, 2, 4]) for _ in range(200)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert [(r[0], r[1], r[3]) for r in run(spark, levels, SMALL_CELLS)] == brute_states(levels)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


HIGH = tuple(LevelRule(level, 1.0, 0.0, 0.0, 0.0, count) for level, count in ((7, 3), (12, 2), (20, 1), (41, 0)))


@pytest.mark.parametrize("grain", [WHOLE_SERIES, SMALL_CELLS])
def test_high_levels_are_entered_and_left(spark, grain):
    rng = random.Random(13)
    samples = [rng.choice([-1, -1, 7, 12, 20, 41]) for _ in range(300)] + [-1] * 40
    frame = level_samples(spark, samples).withColumn("rules", rules_literal(HIGH))
    states = level_states(frame, grain, levels_used=[7, 12, 20, 41]).orderBy("seq").collect()
    expected, state, window = [], -1, []
    for sample in samples:
        window = [*window, sample][-15:]
        before, state = state, next_level(window, sample, {r.level: r.rec_count for r in HIGH}, state)
        expected.append((before, state))
    assert [(r.prev_level, r.state_level) for r in states] == expected
    assert {7, 12, 20, 41} <= {r.state_level for r in states}


def test_many_levels(spark):
    rules = tuple(LevelRule(level, 1.0, 0.0, 0.0, 0.0, 0) for level in range(0, 2000, 3))
    frame = level_samples(spark, [999, 1998, 3, 999]).withColumn("rules", rules_literal(rules))
    states = level_states(frame, levels_used=[r.level for r in rules]).orderBy("seq").collect()
    # The second 999 reaches as far down as the one sample beyond those that hold the state.
    assert [r.state_level for r in states] == [999, 1998, 999, 3]


def test_undivided_states_need_no_shuffle_after_the_workers(spark):
    plan = level_states(level_samples(spark, [1, 2, 3]))._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("ArrowEvalPython")]
    assert "Exchange" not in above and "Sort" not in above and "values" not in above


def test_levels_in_use_come_from_all_rules(spark):
    table = spark.createDataFrame([("a",)], "uuid string").withColumn("rules", rules_literal(HIGH))
    assert levels_in_use(DEFAULTS, table, None) == (0, 1, 2, 3, 4, 5, 7, 12, 20, 41)


def test_tenant_levels_that_are_none_are_refused(spark):
    texts = ['{"3":{},"14":{},"20":{}}', "{}", None, '{"-1":{}}', '{"x":{},"2":{}}', "[bad"]
    users = spark.createDataFrame(list(enumerate(texts)), "uuid int, AL string").withColumn("uuid", F.col("uuid").cast("string"))
    rules = {r.uuid: [x.level for x in r.rules] for r in tenant_rules(users).collect()}
    assert rules["0"] == [3, 14, 20]
    assert all(rules[u] == [0, 1, 2, 3, 4, 5] for u in "12345")
    assert sorted(map(tuple, tenant_dead_letters(users).collect())) == [("3", "bad_level"), ("4", "bad_level"), ("5", "bad_levels")]


def test_one_end_per_alert(spark):
    rng = random.Random(11)
    levels = [rng.choice([-1] * 6 + [0, 3, 5]) for _ in range(600)]
    codes = [r[2] for r in run(spark, levels) if r[2] in (0, 3)]
    assert codes == [0, 3] * (len(codes) // 2) + [0] * (len(codes) % 2)


def test_level_times(spark):
    states = with_level_times(level_states(level_samples(spark, [2] * 4 + [-1] * 19), SMALL_CELLS), SMALL_CELLS)
    last = states.orderBy(F.col("seq").desc()).first()
    start, end = START + 3 * 60_000, START + 15 * 60_000
    assert last.starttimes == {0: start, 1: start, 2: start}
    assert last.endtimes == {0: end, 1: end, 2: end}


@pytest.mark.parametrize("grain", [WHOLE_SERIES, SMALL_CELLS, Grain(10_000)])
def test_regression_matches_direct_fit(spark, grain):
    import numpy as np

    rng = random.Random(1)
    rows = [(START + 1500 + 7_300 * i, 50 + 0.01 * i + rng.random(), 0) for i in range(200)]
    got = running_regression(points(spark, rows), grain).orderBy("seq").collect()
    xs = np.array([r[0] // 1000 - START // 1000 for r in rows], dtype=float)
    ys = np.array([r[1] for r in rows])
    assert got[0].predict_pct == 0.0 and got[0].predicted is None
    for i in (1, 2, 50, 199):
        slope, intercept = np.polyfit(xs[: i + 1], ys[: i + 1], 1)
        assert got[i].predicted == pytest.approx(intercept + slope * xs[i], rel=1e-7)


@pytest.mark.parametrize("grain", [WHOLE_SERIES, SMALL_CELLS])
def test_regression_goes_on_from_stored_totals(spark, grain):
    rows = [(START + 1500 + 7_300 * i, 50 + (i * 31) % 17, 0) for i in range(120)]
    frame = points(spark, rows)
    first, second = frame.where("seq < 70"), frame.where("seq >= 70")
    whole = {r.seq: r.predicted for r in running_regression(frame).collect()}
    resumed = running_regression(second, grain, earlier=regression_totals(first, ["series_key"])).collect()
    assert len(resumed) == 50
    for row in resumed:
        assert row.predicted == pytest.approx(whole[row.seq], rel=1e-9)


def test_points_of_one_second_give_no_fit(spark):
    rows = running_regression(points(spark, [(START, 1, 0), (START + 10, 9, 0)])).collect()
    assert [r.predict_pct for r in rows] == [0.0, 0.0]


@pytest.mark.parametrize("few", [True, False, None])
@pytest.mark.parametrize("grain", [WHOLE_SERIES, SMALL_CELLS])
def test_controls_count_from_their_instant_on(spark, grain, few):
    frame = points(spark, [(START + 60_000 * i, 1, 0) for i in range(30)])
    marks = [("s", START + 60_000 * 3, 100), ("s", START + 60_000 * 20 + 1, 101), ("other", START, 102)]
    controls = spark.createDataFrame(marks, "series_key string, ts_ms bigint, seq bigint")
    rows = count_before(frame, controls, {"epoch": F.lit(True)}, grain=grain, few=few).orderBy("seq").collect()
    assert [r.epoch for r in rows] == [0] * 3 + [1] * 18 + [2] * 9


@pytest.mark.parametrize("grain", [Grain(None, (("s", 60_000 * 60),)), Grain(10 * 60_000)])
def test_whole_path_does_not_depend_on_cells(spark, grain):
    rng = random.Random(2)
    rows = [(START + 600_000 * i, abs(rng.gauss(50, 30)), rng.choice([0, 0, -1, -2, -3, 60])) for i in range(2500)]
    frame = points(spark, rows)
    columns = ["seq", "level", "prev_level", "state_level", "state", "emitted", "upstate", "values"]
    times = [F.to_json("starttimes").alias("s"), F.to_json("endtimes").alias("e")]
    one = monitor(frame).select(*columns, *times).orderBy("seq").collect()
    other = monitor(frame, grain=grain).select(*columns, *times).orderBy("seq").collect()
    assert one == other
    assert {r.state for r in one} == {0, 1, 2, 3}


def _noisy(n=500):
    rng = random.Random(3)
    rows = [(START + 1_200_000 * i, 10 + rng.random(), 0) for i in range(8 * 72)]
    wave = [(START + 8 * DAY + 60_000 * i, rng.choice([5, 10, 40, 60, 90]) * (3 if i // 60 % 2 else 1), rng.choice([0, 0, 0, -3])) for i in range(n)]
    return rows, wave


@pytest.mark.parametrize("grain", [WHOLE_SERIES, Grain(None, (("s", 3_600_000),))])
def test_runs_go_on_from_the_last_one(spark, grain):
    rows, wave = _noisy()
    all_points = points(spark, rows + wave)
    hourly = hourly_baseline(all_points)
    columns = ["seq", "level", "prev_level", "state_level", "state", "emitted", "upstate", "starttimes", "endtimes"]
    plain = lambda df: sorted(map(str, df.select(*columns).collect()))
    whole = plain(monitor(all_points, hourly, grain=grain))
    # The third run has fewer samples than a window, the fourth one none.
    cuts = [0, len(rows) + 200, len(rows) + 350, len(rows) + 355, len(rows) + 355, len(rows) + 500]
    left, totals, got, values = None, None, [], set()
    for a, b in zip(cuts, cuts[1:]):
        part = all_points.where((F.col("seq") >= a) & (F.col("seq") < b))
        states = monitor(part, hourly, grain=grain, earlier=left, earlier_totals=totals)
        got += plain(states)
        values |= {r.state_level for r in states.select("state_level").collect()}
        own = regression_totals(part, ["series_key"])
        left = cut_lineage(last_samples(states, earlier=left))
        totals = cut_lineage(own if totals is None else merged_totals(own, totals))
        assert left.count() <= DEFAULTS.window_samples
    assert sorted(got) == whole
    assert len(values) > 2
    expected = regression_totals(all_points, ["series_key"]).collect()[0].asDict()
    for name, value in totals.collect()[0].asDict().items():
        assert value == pytest.approx(expected[name]) if name != "series_key" else value == "s"


def test_a_run_that_goes_on_needs_a_baseline(spark):
    frame = points(spark, [(START, 1, 0)])
    with pytest.raises(ValueError, match="baseline"):
        monitor(frame, earlier_totals=regression_totals(frame, ["series_key"]))


@pytest.mark.parametrize("level", LEVELS)
def test_fixed_step_leads_to_its_level(level):
    assert {ord(c) - 0x100 for c in fixed_step(level, LEVELS)} == {level + 1}
    assert {ord(c) - 0x100 for c in fixed_step(4, (0, 2, 7))} == {2}
    assert {ord(c) - 0x100 for c in fixed_step(-1, LEVELS)} == {0}
