"""State machines of one series, fed row by row by the streaming operators.

Pure Python and small: Spark partitions the rows by series and keeps the state between batches.
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, field

from tidewatch.functions.steps import next_level
from tidewatch.shipping import ship_by_value

ship_by_value(__name__)


def state_of(before: int, after: int) -> int:
    """Code of a transition: 0 start, 1 same, 2 change, 3 end."""
    if before == after:
        return 1
    if before == -1:
        return 0
    return 3 if after == -1 else 2


@dataclass
class Fit:
    """Sums of a running regression about its first second."""

    n: float = 0.0
    origin: int = 0
    sx: float = 0.0
    sy: float = 0.0
    sxx: float = 0.0
    sxy: float = 0.0

    def add(self, second: int, value: float) -> float:
        """Take in a point and return the percent it lies off its prediction."""
        if self.n == 0:
            self.origin = second
        x = float(second - self.origin)
        self.n += 1
        self.sx += x
        self.sy += value
        self.sxx += x * x
        self.sxy += x * value
        spread = self.sxx - self.sx * self.sx / self.n
        if spread == 0:
            return 0.0
        slope = (self.sxy - self.sx * self.sy / self.n) / spread
        predicted = self.sy / self.n + slope * (x - self.sx / self.n)
        if predicted == 0 or math.isnan(predicted):
            return 0.0
        return (value - predicted) / predicted * 100


@dataclass
class LevelMachine:
    """Regression, level, window and level state of one series."""

    window: int
    fit: Fit = field(default_factory=Fit)
    samples: list = field(default_factory=list)
    level: int = -1
    up: bool = False
    starts: dict = field(default_factory=dict)
    ends: dict = field(default_factory=dict)

    @classmethod
    def load(cls, stored: dict | None, window: int) -> LevelMachine:
        if stored is None:
            return cls(window)
        fit = Fit(**stored.pop("fit"))
        return cls(fit=fit, **stored)

    def dump(self) -> dict:
        return asdict(self)

    def forget(self) -> None:
        self.__init__(self.window)

    def reset_fit(self) -> None:
        self.fit = Fit()

    def point(self, ts_ms: int, value: float, reaction: int, weight: int, pct: float | None, rules: list) -> dict | None:
        """One scored point; the returned dict describes the sample, None a muted point."""
        off = self.fit.add(ts_ms // 1000, value)
        if reaction == -3:
            return None
        level = -1
        if weight != 0:
            for rule in rules:
                passes_pct = pct is None or math.isnan(pct) or abs(pct) >= rule["min_pct"]
                if (
                    abs(weight) >= rule["min_weight"]
                    and passes_pct
                    and abs(value) >= rule["min_value"]
                    and abs(off) >= rule["min_predict_pct"]
                ):
                    level = max(level, rule["level"])
        self.samples = [*self.samples, [level, value]][-self.window :]
        levels = [s[0] for s in self.samples]
        needed = {rule["level"]: max(rule["rec_count"], 0) for rule in rules}
        before, heard = self.level, max(levels) > -1
        after = next_level(levels, level, needed, before)
        if heard:
            self.up = weight > 0
        for passed in {*needed, *map(int, self.starts)}:
            if before < passed <= after:
                self.starts[str(passed)] = ts_ms
            elif after < passed <= before:
                self.ends[str(passed)] = ts_ms
        self.level = after
        return {
            "sample_level": level,
            "prev_level": before,
            "state_level": after,
            "state": state_of(before, after),
            "emitted": heard or before != -1,
            "upstate": self.up if heard or before != -1 else False,
        }


@dataclass
class Timer:
    """Last point of a special or heartbeat series, and the level it left."""

    tick_ms: int
    last_ms: int | None = None
    reaction: int = 0
    level: int = -1
    fired_ms: int | None = None

    def due_after(self, limit_ms: int) -> int:
        return ((self.last_ms + limit_ms) // self.tick_ms + 1) * self.tick_ms

    def next_special(self) -> int | None:
        """The next tick at which the point's reaction fires, if it still will."""
        if self.last_ms is None or self.reaction == 0:
            return None
        first = self.due_after(abs(self.reaction) * 60_000)
        if self.fired_ms is None:
            return first
        return None if self.reaction < 0 else self.fired_ms + self.tick_ms

    def fire_special(self, until_ms: int) -> list[tuple]:
        """Timer events on ticks up to and including ``until_ms``: (kind, tick, before, after)."""
        events = []
        tick = self.next_special()
        while tick is not None and tick <= until_ms:
            after = -1 if self.reaction < 0 else 5
            events.append(("autoclose" if after == -1 else "deadman", tick, self.level, after))
            self.level, self.fired_ms = after, tick
            tick = self.next_special()
        return events

    def special_point(self, ts_ms: int, reaction: int, level: int) -> list[tuple]:
        """Take in a point.  The last to arrive sets a closing timer; only a newer one a dead-man timer."""
        events = self.fire_special(ts_ms - 1)
        events.append(("status", ts_ms, self.level, level))
        self.level = level
        if reaction <= 0 or self.last_ms is None or self.reaction <= 0 or self.last_ms < ts_ms:
            self.last_ms, self.reaction, self.fired_ms = ts_ms, reaction, None
        return events

    def delete(self, ts_ms: int) -> list[tuple]:
        """Forget the series: what was due before still fires, nothing afterwards."""
        events = self.fire_special(ts_ms - 1)
        self.last_ms, self.reaction, self.fired_ms, self.level = None, 0, None, -1
        return events

    def fire_absence(self, until_ms: int, limit_ms: int) -> list[tuple]:
        """A silence event if one is due by ``until_ms``: (kind, time, last seen, before, after)."""
        if self.last_ms is None or self.fired_ms is not None or self.due_after(limit_ms) > until_ms:
            return []
        self.fired_ms = self.due_after(limit_ms)
        self.level = 5
        return [("absent", self.fired_ms, self.last_ms, -1, 5)]

    def heartbeat(self, ts_ms: int, limit_ms: int) -> list[tuple]:
        events = self.fire_absence(ts_ms - 1, limit_ms)
        if self.fired_ms is not None:
            events.append(("back", ts_ms, self.last_ms, 5, -1))
            self.fired_ms, self.level = None, -1
        if self.last_ms is None or self.last_ms < ts_ms:
            self.last_ms = ts_ms
        return events
