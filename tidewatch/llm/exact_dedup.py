"""Exact deduplication in two Bloom passes: only rows whose hash may repeat are shuffled.

The first pass counts, per slot of a Bloom filter, whether it was set once or more often.  A text that
occurs twice has set all its slots twice; a row with one slot that was set once is alone, and passes straight
through in the second pass.  The rest is grouped by the SHA-256 of the normalised text.  False positives of
the filter cost a shuffled row and never a wrong result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import attach, stored
from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

BITS_PER_ROW = 16
HASHES = 3
# Bounds the filter on the driver and in the broadcast at 32 MB, whatever the input.
MAX_BITS = 1 << 28
SEGMENT = 1 << 14
WHITE_SPACE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def _slots(hashes: np.ndarray, bits: int, k: int) -> np.ndarray:
    h = hashes.view(np.uint64)
    step = (h >> np.uint64(33)) | np.uint64(1)
    return np.stack([(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(k)], axis=1).astype(np.int64)


def _count_slots(bits: int, k: int):
    """Per partition and filter segment: the slots set once, and those set more often."""

    def run(batches):
        seen = np.empty(0, np.int64)
        often = np.empty(0, np.int64)
        for batch in batches:
            slots, n = np.unique(_slots(batch.column(0).to_numpy(zero_copy_only=False), bits, k), return_counts=True)
            often = np.union1d(often, np.concatenate([slots[n > 1], np.intersect1d(seen, slots, assume_unique=True)]))
            seen = np.union1d(seen, slots)
        segments = seen // SEGMENT
        cuts = np.flatnonzero(np.diff(segments)) + 1
        parts = np.split(seen, cuts) if len(seen) else []
        if parts:
            where = [int(p[0] // SEGMENT) for p in parts]
            twice = [often[np.searchsorted(often, s * SEGMENT) : np.searchsorted(often, (s + 1) * SEGMENT)] for s in where]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(where, pa.int32()),
                    pa.array([(p % SEGMENT).astype(np.uint16).tobytes() for p in parts], pa.binary()),
                    pa.array([(t % SEGMENT).astype(np.uint16).tobytes() for t in twice], pa.binary()),
                ],
                ["segment", "once", "twice"],
            )

    return run


def _merge_segments(batches):
    """The slots of each segment that were set more than once over all partitions, as a bit map."""
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, once, twice in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            held = counts.setdefault(segment, np.zeros(SEGMENT, np.uint8))
            at = np.frombuffer(once, np.uint16)
            held[at] = np.minimum(held[at] + 1, 2)
            held[np.frombuffer(twice, np.uint16)] = 2
    names = ["segment", "bits"]
    found = [(s, np.packbits(c > 1, bitorder="little").tobytes()) for s, c in counts.items() if (c > 1).any()]
    yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.binary())], names)


def repeated_filter(hashes: DataFrame, rows: int, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS, k: int = HASHES):
    """A test, as a column function of the hash, that is true for every hash that occurs twice or more."""
    bits = SEGMENT
    while bits < min(max_bits, bits_per_row * rows):
        bits *= 2
    counted = hashes.mapInArrow(_count_slots(bits, k), "segment int, once binary, twice binary")
    merged = counted.repartition("segment").mapInArrow(_merge_segments, "segment int, bits binary")
    filled = np.zeros(bits // 8, np.uint8)  # at most max_bits / 8 bytes
    for segment, held in merged.toLocalIterator():
        filled[segment * (SEGMENT // 8) : (segment + 1) * (SEGMENT // 8)] = np.frombuffer(held, np.uint8)
    shared = hashes.sparkSession.sparkContext.broadcast(filled.tobytes())

    @F.pandas_udf("boolean")
    def may_repeat(column: pd.Series) -> pd.Series:
        held = np.frombuffer(shared.value, np.uint8)
        slots = _slots(column.to_numpy(np.int64), bits, k)
        return pd.Series(((held[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1).all(axis=1))

    return may_repeat


def exact_duplicates(docs: DataFrame, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space (space, tab to carriage return).  Of equal
    texts the one with the most code points stays, then the smallest doc_id (null first); of repeated rows
    exactly one is kept.  A null text counts as empty; all empty texts are equal.  An empty table gives no
    rows.  Other columns are ignored.
    """
    keys = stored(
        docs.select(
            "doc_id",
            F.coalesce(F.char_length("text"), F.lit(0)).alias("points"),
            F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("row"),
        ).withColumn("h", F.xxhash64("digest"))
    )
    total = keys.count()
    may_repeat = repeated_filter(keys.select("h"), total, bits_per_row, max_bits)
    marked = keys.withColumn("again", may_repeat("h"))
    hexed = F.lower(F.hex("digest")).alias("text_sha256")
    alone = marked.where(~F.col("again")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), hexed
    )
    rows = marked.where("again").drop("again", "h", "points")
    best = F.min(F.struct((-F.col("points")).alias("p"), "doc_id", "row"))
    groups = stored(
        marked.where("again")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), best.alias("best"))
        .select("digest", "group_size", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    )
    grouped = attach(rows, groups, "digest", "group_size", total).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), hexed
    )
    return alone.unionByName(grouped)
