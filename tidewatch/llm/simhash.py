"""SimHash near-duplicates with covering locality-sensitive hashing.

Bit i of a fingerprint gets a vector of r+1 bits, never zero.  Table v, for every non-zero v of r+1 bits, keeps
the bits whose vector has an odd product with v.  Any r differing bits leave some v orthogonal to all their
vectors, so two fingerprints within distance r agree on all bits that table v keeps: every such pair meets.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import attach, stored, unwrapped, wrapped
from tidewatch.llm.components import components
from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

BITS = 64
# Fingerprints compared with each other in memory; fuller buckets go the way of _wildcard_links.
BUCKET = 2048
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int) -> int:
    """A bit is 1 if it is set in over half of the hashes of all word shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        words, shingle = [b" ".join(words)], 1
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        lo, hi = starts[at : min(n, at + CHUNK)].tolist(), ends[at + shingle - 1 : min(n, at + CHUNK) + shingle - 1].tolist()
        h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(lo, hi, strict=True)), "<u8", len(lo))
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(2)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.view(np.int64))], ["row", "h", "fp"])

    return run


def covering_masks(radius: int) -> list[int]:
    """The masks of the 2^(r+1)-1 tables; each keeps about half of the bits."""
    vectors = 2 ** (radius + 1) - 1
    of_bit = [i % vectors + 1 for i in range(BITS)]
    return [sum(1 << i for i, m in enumerate(of_bit) if (m & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _spanning(fps: np.ndarray, radius: int):
    """A star for each set of fingerprints that links inside the bucket connect."""
    root = list(range(len(fps)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for at in range(0, len(fps), 256):
        close = np.bitwise_count(fps[at : at + 256, None] ^ fps[None, :]) <= radius
        for i, j in np.argwhere(close).tolist():
            if i + at < j:
                a, b = sorted((find(i + at), find(j)))
                root[b] = a
    return [(fps[i], fps[find(i)]) for i in range(len(fps)) if find(i) != i]


def _bucket_links(radius: int):
    """Runs over rows (t, key, fp) sorted by bucket; a bucket may go over the end of a batch."""

    def links(keys, fps):
        new = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = np.concatenate([[0], new, [len(fps)]])
        edges = []
        for k in np.flatnonzero(np.diff(bounds) > 1):
            edges.extend(_spanning(fps[bounds[k] : bounds[k + 1]].view(np.uint64), radius))
        found = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], ["a", "b"])

    def run(batches):
        keys, fps = np.empty((0, 2), np.int64), np.empty(0, np.int64)
        for batch in batches:
            t, key, fp = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            keys, fps = np.concatenate([keys, np.stack([t, key], axis=1)]), np.concatenate([fps, fp])
            if not len(fps):
                continue
            last = int((keys == keys[-1]).all(axis=1).argmax())
            if last:
                yield links(keys[:last], fps[:last])
            keys, fps = keys[last:], fps[last:]
        if len(fps):
            yield links(keys, fps)

    return run


def _wildcard_links(rows: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Links inside very full buckets, without comparing pairs.

    Two members of a bucket of table t differ in bits that t drops.  Each member is listed once for every
    choice of ``radius`` dropped bits, with these bits cleared; close members meet in such a list, which has at
    most 2^radius members.  The work grows with the members, not with their pairs.
    """
    lists = None
    for t, mask in enumerate(masks):
        dropped = [i for i in range(BITS) if not mask >> i & 1]
        cleared = [_signed((1 << 64) - 1 - sum(1 << i for i in some)) for some in combinations(dropped, radius)]
        own = rows.where(F.col("t") == t).select("fp", F.explode(F.array(*map(F.lit, cleared))).alias("m"))
        lists = own if lists is None else lists.unionByName(own)
    meet = lists.groupBy("m", F.col("fp").bitwiseAND(F.col("m")).alias("k")).agg(F.collect_set("fp").alias("fps"))
    return meet.where(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b"))


def covering_links(fps: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all fingerprints (column fp, distinct) within ``radius`` bits of each other."""
    masks = covering_masks(radius)
    tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)]))
    rows = fps.select("fp", tables.alias("x")).select("x.t", "x.key", "fp")
    full = stored(rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket).drop("n"))
    few = rows.join(full, ["t", "key"], "left_anti").select("t", "key", "fp")
    links = few.repartition("t", "key").sortWithinPartitions("t", "key", "fp").mapInArrow(_bucket_links(radius), "a bigint, b bigint")
    many = rows.join(full, ["t", "key"], "left_semi")
    return links.unionByName(_wildcard_links(many, masks, radius)) if full.head(1) else links


def _grouped(docs: DataFrame, shingle: int, radius: int, bucket: int) -> tuple[DataFrame, DataFrame, int]:
    """Stored rows (row, h, fp) of the documents, and per fingerprint the first (absent, row, h) reachable."""
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("row"), F.xxhash64(text).alias("h"), text.alias("text"))
    prints = stored(texts.mapInArrow(_fingerprints(shingle), "row bigint, h bigint, fp bigint"))
    order = F.min(F.struct(F.isnull("row").alias("absent"), "row", "h")).alias("first")
    distinct = stored(prints.groupBy("fp").agg(order, F.count(F.lit(1)).alias("n")))
    linked = components(covering_links(distinct.select("fp"), radius, bucket)).withColumnRenamed("node", "fp")
    roots = stored(distinct.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = stored(roots.groupBy("root").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("members")))
    total = prints.count()
    return prints, stored(attach(roots, least, "root", "members", total).select("root", "fp", "n", "least")), total


def simhash_groups(docs: DataFrame, shingle: int = 3, radius: int = 2, bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    A null text counts as empty; a text without words has fingerprint zero, linked like any other.  Repeated
    rows share their component.  A null doc_id counts only where a component has no other.  An empty table gives
    no rows; other columns are ignored.
    """
    prints, named, total = _grouped(docs, shingle, radius, bucket)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return attach(prints, named, "fp", "n", total).select(
        F.col("row").alias("doc_id"), digits, F.col("least.row").alias("component_id")
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The documents of which one of each SimHash group stays: that with the smallest doc_id, null last.

    Equal doc_ids are told apart by their texts, and of repeated rows one stays.  All columns are kept.
    """
    prints, named, _ = _grouped(docs, shingle, radius, BUCKET)
    chosen = named.groupBy("root").agg(F.first("least").alias("least")).select("least.row", "least.h")
    repeated = prints.groupBy("row", "h").agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
    same = lambda a, b: a["row"].eqNullSafe(b["row"]) & (a["h"] == b["h"])
    keep = stored(chosen.join(repeated, same(chosen, repeated), "left").select(chosen["row"], chosen["h"], "copies"))
    rows = wrapped(docs).select(
        "_row", F.col("_row").getField("doc_id").cast("bigint").alias("row"), F.xxhash64(F.coalesce(F.col("_row").getField("text"), F.lit(""))).alias("h")
    )
    once, often = keep.where(F.col("copies").isNull()), keep.where(F.col("copies").isNotNull())
    alone = rows.join(once, same(rows, once), "left_semi")
    first = rows.join(often, same(rows, often), "left_semi").groupBy("row", "h").agg(F.first("_row").alias("_row"))
    return alone.select("_row").unionByName(first.select("_row")).select(*unwrapped(docs.columns))
