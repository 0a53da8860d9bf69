"""A Bloom filter of the keys of a table, to let rows without a partner pass by a join."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.exact_dedup import BITS_PER_ROW, HASHES, MAX_BITS, SEGMENT, _slots
from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

_FILLED = "segment int, held binary"


def _fill(bits: int, k: int):
    """Per partition and filter segment: the slots that are set."""

    def run(batches):
        found = [np.unique(_slots(b.column(0).to_numpy(zero_copy_only=False), bits, k)) for b in batches]
        slots = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        parts = np.split(slots, np.flatnonzero(np.diff(slots // SEGMENT)) + 1) if len(slots) else []
        where = pa.array([int(p[0] // SEGMENT) for p in parts], pa.int32())
        held = pa.array([(p % SEGMENT).astype(np.uint16).tobytes() for p in parts], pa.binary())
        yield pa.RecordBatch.from_arrays([where, held], ["segment", "held"])

    return run


def _join_segments(batches):
    """The slots of each segment over all partitions, as a bit map."""
    filled: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, held in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
            filled.setdefault(segment, np.zeros(SEGMENT, bool))[np.frombuffer(held, np.uint16)] = True
    maps = [np.packbits(f, bitorder="little").tobytes() for f in filled.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(filled), pa.int32()), pa.array(maps, pa.binary())], ["segment", "held"])


def member_test(hashes: DataFrame, rows: int, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS, k: int = HASHES):
    """A test on arrays of hashes that is true for every hash of ``hashes`` (one bigint column of ``rows`` rows).

    It is also true for a few others, for more of them the fuller the filter is; ``max_bits`` bounds it on the driver and in
    the broadcast.  So what it lets through still has to be joined, and a full filter costs time and no result.
    """
    bits = SEGMENT
    while bits < min(max_bits, bits_per_row * rows):
        bits *= 2
    joined = hashes.mapInArrow(_fill(bits, k), _FILLED).repartition("segment").mapInArrow(_join_segments, _FILLED)
    filled = np.zeros(bits // 8, np.uint8)
    # At most max_bits in one job; toLocalIterator() would run one for each partition.
    for segment, held in joined.collect():
        filled[segment * (SEGMENT // 8) : (segment + 1) * (SEGMENT // 8)] = np.frombuffer(held, np.uint8)
    shared = hashes.sparkSession.sparkContext.broadcast(filled.tobytes())

    def may(column: np.ndarray) -> np.ndarray:
        held = np.frombuffer(shared.value, np.uint8)
        slots = _slots(column, bits, k)
        return ((held[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1).astype(bool).all(axis=1)

    return may


def as_column(test):
    """A test of :func:`member_test` as a column function."""

    @F.pandas_udf("boolean")
    def may_be_member(column: pd.Series) -> pd.Series:
        return pd.Series(test(column.to_numpy(np.int64)))

    return may_be_member


def member_filter(hashes: DataFrame, rows: int, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS, k: int = HASHES):
    """The test of :func:`member_test` as a column function."""
    return as_column(member_test(hashes, rows, bits_per_row, max_bits, k))
