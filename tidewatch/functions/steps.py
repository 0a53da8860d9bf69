"""Steps of the level state machine: what one sample, or any number of them, does to every possible level.

The levels a state can have are numbered as places, place 0 standing for no level.  A step is a text with one character
per place that tells the place after it.  Steps compose, and composing is associative, so a series can be cut anywhere
and put together again.  There may be as many levels as there are characters.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

MEMO_ENTRIES = 200_000
# Places are characters from here on; the highest keeps clear of surrogates.
FIRST_PLACE = 0x100
MAX_PLACES = 0xD000
FIXED = "="


# Column side


def recurrence_text(rules: Column) -> Column:
    """How often each level of the rules has to recur, as ``level:count`` joined by commas."""
    pair = lambda r: F.concat(r["level"].cast("string"), F.lit(":"), F.greatest(r["rec_count"], F.lit(0)).cast("string"))
    return F.array_join(F.transform(rules, pair), ",")


def fixed_text(level: Column) -> Column:
    """In place of recurrences: a sample that leads to this level from every other."""
    return F.concat(F.lit(FIXED), level.cast("string"))


def level_after(step: str, start_place: Column, levels: Sequence[int]) -> Column:
    """The level a step leads to from a place."""
    place = F.ascii(F.substring(F.col(step), start_place + 1, F.lit(1))) - FIRST_PLACE
    return F.element_at(F.array(*[F.lit(j).cast("int") for j in (-1, *levels)]), place + 1)


# Worker side


def next_level(window: Sequence[int], last: int, needed: dict[int, int], level: int) -> int:
    """One evaluation of the level state machine.

    ``window`` holds the last samples, ``last`` is the newest of them.  From the top level downwards, the first level
    that recurs often enough wins when the state lies below the newest sample, or when it recurs often enough beyond
    the samples that reach the state.
    """
    if max(window) < 0:
        return -1
    holding = len(window) if level < 0 else sum(s >= level for s in window)
    recurs = False
    for candidate in sorted(needed, reverse=True):
        count = sum(s >= candidate for s in window)
        if count > needed[candidate]:
            recurs = True
            if level < last or count - holding > needed[candidate]:
                return candidate
    return level if recurs else -1


def identity_step(levels: Sequence[int]) -> str:
    return "".join(chr(FIRST_PLACE + k) for k in range(len(levels) + 1))


def step_of(window: Sequence[int], last: int, needed: dict[int, int], levels: Sequence[int]) -> str:
    """The step of one sample over the given levels, lowest first."""
    place = {level: k for k, level in enumerate((-1, *levels))}
    return "".join(chr(FIRST_PLACE + place[next_level(window, last, needed, level)]) for level in place)


def fixed_step(level: int, levels: Sequence[int]) -> str:
    """The step to one level; to the next one below it if it is no longer in use."""
    reached = sum(known <= level for known in levels)
    return chr(FIRST_PLACE + reached) * (len(levels) + 1)


def compose(first: str, then: str) -> str:
    """The step that does ``first`` and afterwards ``then``."""
    return "".join(then[ord(c) - FIRST_PLACE] for c in first)


def parse_recurrences(text: str) -> dict[int, int]:
    return {int(level): int(count) for level, count in (pair.split(":") for pair in text.split(",") if pair)}


class Composer:
    """Composes steps in order and remembers the compositions it has met."""

    def __init__(self, levels: Sequence[int]):
        self.start = self.so_far = identity_step(levels)
        self.memo: dict[tuple[str, str], str] = {}

    def add(self, step: str) -> str:
        key = self.so_far, step
        found = self.memo.get(key)
        if found is None:
            if len(self.memo) >= MEMO_ENTRIES:
                self.memo.clear()
            found = self.memo[key] = compose(*key)
        self.so_far = found
        return found

    def restart(self) -> None:
        self.so_far = self.start


def samples_so_far(levels: Sequence[int]):
    """A column function over sorted partitions: (steps before the sample, steps up to it) since the last first row.

    Takes the sorted samples of the window as text, the newest sample, the recurrences and whether the row is a first
    one.  Batches of a partition come in its order, so what is composed so far is carried from one to the next.
    """
    levels = tuple(levels)

    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        composer, memo = Composer(levels), {}
        for windows, lasts, recurrences, firsts in batches:
            before, after = [], []
            for key, first in zip(zip(windows, lasts, recurrences), firsts):
                step = memo.get(key)
                if step is None:
                    if len(memo) >= MEMO_ENTRIES:
                        memo.clear()
                    window, last, needed = key
                    if needed.startswith(FIXED):
                        step = fixed_step(int(needed[len(FIXED) :]), levels)
                    else:
                        step = step_of([int(s) for s in window.split(",")], int(last), parse_recurrences(needed), levels)
                    memo[key] = step
                if first:
                    composer.restart()
                before.append(composer.so_far)
                after.append(composer.add(step))
            yield pd.DataFrame({"before": before, "after": after})

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    # Not deterministic to the optimiser: no filter may thin out the rows it sees.
    return F.pandas_udf(run, "before string, after string").asNondeterministic()


def steps_so_far(levels: Sequence[int], step_column: str, first_column: str, out: str):
    """For ``mapInArrow`` on sorted partitions: compose ``step_column`` from each first row on."""
    levels = tuple(levels)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        composer = Composer(levels)
        for batch in batches:
            done = []
            for first, step in zip(batch.column(first_column).to_pylist(), batch.column(step_column).to_pylist()):
                if first:
                    composer.restart()
                done.append(composer.add(step))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done, pa.string())], names=[*batch.schema.names, out])

    return work
