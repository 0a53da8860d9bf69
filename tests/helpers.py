"""Small frames for hand-made cases."""

from tidewatch.config import DEFAULT_LEVELS

POINT = "series_key string, name string, ts_ms bigint, value double, uuid string, type int, reaction int, seq bigint"
DAY = 86_400_000
HOUR = 3_600_000
# A Monday, 00:00 UTC.
START = 1_704_067_200_000


def points(spark, rows, key="s"):
    """Points from (ts_ms, value, reaction) in order of arrival."""
    full = [(key, key, ts, float(v), "t0", 0, r, i) for i, (ts, v, r) in enumerate(rows)]
    return spark.createDataFrame(full, POINT)


def level_samples(spark, levels, key="s"):
    """Sampled points that already have their level."""
    from tidewatch.operators.levels import rules_literal

    rows = [(key, START + 60_000 * i, i, lv, 1 if lv >= 0 else 0, float(lv)) for i, lv in enumerate(levels)]
    frame = spark.createDataFrame(rows, "series_key string, ts_ms bigint, seq bigint, level int, weight int, value double")
    return frame.withColumn("rules", rules_literal(DEFAULT_LEVELS))


def brute_states(levels, recs=(3, 3, 3, 2, 2, 1), window=15):
    """The level machine spelled out over lists: [(before, after, emitted)]."""
    state, kept, out = -1, [], []
    for sample in levels:
        kept = [*kept, sample][-window:]
        count = lambda j: sum(1 for x in kept if x >= j)
        before = state
        if max(kept) > -1:
            recurs = moved = False
            for j in range(max(kept), -1, -1):
                if count(j) > recs[j]:
                    recurs = True
                    if before < kept[-1] or count(j) - count(before) > recs[j]:
                        state, moved = j, True
                        break
            if not moved and not recurs:
                state = -1
            out.append((before, state, True))
        else:
            state = -1
            out.append((before, state, before != -1))
    return out
