"""Exact substring deduplication over all documents: suffix sorting of aligned contexts.

Every window of LENGTH bytes is assigned to the least hash among its GRAM-byte grams (the leftmost of equals), so equal
windows, wherever they are, meet under the same hash with the gram at the same place.  The windows of one document
that share their gram form a context, about LENGTH/2 windows in a run.

1. Contexts are grouped by that hash.  A hash that occurs once has no repeated window; one whose contexts are all
   identical has only repeated ones.  This settles nearly everything without any text being moved.
2. A window has half of its bytes besides the gram, or more, on one side of it.  A context that agrees in so many bytes,
   before or behind the gram, with no other one of its hash shares no window and drops out, by hashes of both sides.
3. Different contexts left under one hash are compared by text.  They are cut into blocks counted from the gram, so equal
   windows have equal blocks, and all suffixes of the block sequences are sorted by linear grouping.  Neighbours in that
   order that agree in all full blocks of a window form a class; two windows are equal when their class, their place
   in it and the bytes left over at their ends are equal.
4. A hash under which more than BUCKET different contexts are left is not gathered: what the windows of a block share, and
   then the bytes they don't, are counted in plain aggregations.

Rows move only where they are needed: Bloom filters of the hashes that recur and of the documents wanted let all others
pass by the joins.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import attach, stored
from tidewatch.llm.membership import as_column, member_filter, member_test
from tidewatch.llm.suffix_grouping import suffix_array
from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

LENGTH = 400
GRAM = 32
BLOCK = 16
BUCKET = 200
# Bytes of contexts whose suffixes are sorted together, and windows of a text looked at together.
BATCH_BYTES = 400_000
CHUNK = 1 << 18
# Rows with texts that are Python objects at a time, and contexts handed out together.
ROWS = 1000
CONTEXTS = 20_000
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_BYTES = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _slices(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _power_table(factor: int, n: int) -> np.ndarray:
    if factor not in _powers or len(_powers[factor]) < n:
        table = np.full(max(n, 1 << 14), factor, np.uint64)
        table[0] = 1
        _powers[factor] = np.multiply.accumulate(table)
    return _powers[factor][:n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def gram_hashes(raw: bytes, size: int = GRAM) -> np.ndarray:
    """A rolling hash of all grams, modulo 2^64."""
    x = np.frombuffer(raw, np.uint8)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[x] * _power_table(_FACTOR, len(x)), dtype=np.uint64)])
    return _mixed((sums[size:] - sums[:-size]) * _power_table(_INVERSE, len(x) - size + 1))


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    n = len(h)
    rows = np.concatenate([h, np.full(-n % width, np.iinfo(h.dtype).max, h.dtype)]).reshape(-1, width)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def contexts(raw: bytes, length: int, gram: int):
    """(hash, first window, windows, place of the gram) of every context of a text."""
    width = length - gram + 1
    for at in range(0, len(raw) - length + 1, CHUNK):
        part = raw[at : at + CHUNK + length - 1]
        h = gram_hashes(part, gram)
        least = _sliding_min(h, width)
        bounds = [0, *(np.flatnonzero(np.diff(least)) + 1).tolist(), len(least)]
        for a, end in zip(bounds, bounds[1:], strict=False):
            while a < end:
                p = a + int(h[a : a + width].argmin())
                stop = min(end, p + 1)
                yield int(least[a]), at + a, stop - a, at + p
                a = stop


def side_hashes(raw: bytes, first: int, end: int, p: int, length: int, gram: int):
    """Hashes of the gram at ``p`` with what is before it, and with what is behind it, of the context ``first`` to ``end``.

    Of any window one of the sides is in the window.  A side that the context does not have in full is None.
    """
    side = (length - gram + 1) // 2
    before = xxhash.xxh32_intdigest(raw[p - side : p + gram]) - (1 << 31) if p - side >= first else None
    behind = xxhash.xxh32_intdigest(raw[p : p + gram + side]) - (1 << 31) if p + gram + side <= end else None
    return before, behind


_CONTEXT = "doc bigint, t bigint, h bigint, c binary, first bigint, n bigint, gram bigint, before int, behind int"


def _all_contexts(length: int, gram: int):
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    names = [c.split()[0] for c in _CONTEXT.split(", ")]

    def run(batches):
        for batch in batches:
            out = [[] for _ in kinds]
            for doc, t, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                for h, first, n, p in contexts(raw, length, gram):
                    end = first + n + length - 1
                    digest = xxhash.xxh3_128_digest(raw[first:end])
                    row = doc, t, h - (1 << 64) if h >> 63 else h, digest, first, n, p, *side_hashes(raw, first, end, p, length, gram)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                if len(out[0]) > CONTEXTS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)
                    out = [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return run


def repeated_windows(texts: list[bytes], grams: list[int], counts: list[int], length: int, block: int) -> list[np.ndarray]:
    """For each context, which of its windows occur in another one.

    ``texts`` are distinct contexts of ``counts`` windows, ``grams`` the places of their grams.
    """
    full = length // block - 1  # whole blocks in every window, wherever it starts
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    buffer = np.concatenate([buffer, np.zeros(length + 2 * block, np.uint8)])
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])[:-1]]).astype(np.int64)
    # Blocks that lie whole inside a context, counted from its gram.
    places, ends = [], []
    for text, start, gram in zip(texts, starts.tolist(), grams, strict=True):
        own = np.arange(gram % block, len(text) - block + 1, block) + start
        places.append(own)
        ends.append(len(own))
    at = np.concatenate(places)
    blocks = buffer[at[:, None] + np.arange(block)].view(f"V{block}").ravel()
    _, symbols = np.unique(blocks, return_inverse=True)
    # Between contexts stands a symbol of its own, so that no class reaches into the next one.
    breaks = np.cumsum(ends)
    sequence = np.insert(symbols.astype(np.int64) + len(texts), breaks, np.arange(len(texts)))
    position = np.arange(len(at)) + np.repeat(np.arange(len(texts)), ends)
    order = np.array(suffix_array(sequence.tolist()), np.int64)
    padded = np.concatenate([sequence, np.full(full + 1, -1)])
    same = np.ones(len(order) - 1, bool)
    for k in range(full):
        same &= padded[order[1:] + k] == padded[order[:-1] + k]
    classes = np.empty(len(order), np.int64)
    classes[order] = np.concatenate([[0], np.cumsum(~same)])
    of_place = np.zeros(len(buffer), np.int64)
    of_place[at] = classes[position]
    # Every window: its class, how far before a block it starts, and the bytes that its whole blocks leave over.
    n = np.array(counts, np.int64)
    owner = np.repeat(np.arange(len(texts)), n)
    window = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    head = (np.array(grams, np.int64)[owner] - window) % block
    window = window + starts[owner]
    rest = np.empty((len(window), block), np.uint8)
    for k in range(block):
        rest[:, k] = buffer[window + k + np.where(k >= head, full * block, 0)]
    ids = of_place[window + head] * block + head
    key = np.zeros((len(window), 8 + block), np.uint8)
    key[:, :8], key[:, 8:] = ids.view(np.uint8).reshape(-1, 8), rest
    _, group, seen = np.unique(key.view(f"V{8 + block}").ravel(), return_inverse=True, return_counts=True)
    return np.split(seen[group] > 1, np.cumsum(n)[:-1])


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


_SPAN = "doc bigint, t bigint, first bigint, end bigint"


def _spans(rows):
    kinds, names = [pa.int64()] * 4, ["doc", "t", "first", "end"]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)


def _compare(length: int, block: int):
    """Spans of repeated windows of contexts that occur once; rows are sorted by hash and place, and may be repeated."""

    def settle(held):
        found = repeated_windows([r[6] for r in held], [r[4] for r in held], [r[3] for r in held], length, block)
        return [(r[0], r[1], r[2] + a, r[2] + b + length - 1) for r, flags in zip(held, found, strict=True) if r[5] for a, b in _runs(flags)]

    def run(batches):
        held, size, last = [], 0, (None,) * 4
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True):
                if row[:4] == last:
                    continue
                if row[0] != last[0] and size > BATCH_BYTES:
                    yield _spans(settle(held))
                    held, size = [], 0
                last = row[:4]
                held.append(row[1:])
                size += len(row[7])
        if held:
            yield _spans(settle(held))

    return run


_CUT = "h bigint, doc bigint, t bigint, first bigint, n bigint, gram bigint, alone boolean, crowded boolean, bytes binary"


def _cut_contexts(length: int):
    """The wanted contexts of each text, the gram counted from their start.

    Repeated rows have the same contexts: within a partition the first of them is enough to cut them from.
    """
    names = [c.split()[0] for c in _CUT.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.binary()]

    def run(batches):
        seen = set()
        for batch in _slices(batches):
            out = [[] for _ in kinds]
            for doc, t, text, wanted in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if (doc, t) in seen:
                    continue
                seen.add((doc, t))
                raw = (text or "").encode("utf-8", "surrogatepass")
                for w in wanted:
                    first, n = w["first"], w["n"]
                    row = w["h"], doc, t, first, n, w["gram"] - first, w["alone"], w["crowded"], raw[first : first + n + length - 1]
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return run


_PLACES = "w binary, kind binary, doc bigint, t bigint, at bigint, alone boolean, least int, most int, head binary, tail binary"


def _block_places(length: int, block: int):
    """One row for all windows that begin in the same block: what they share, and what is before and behind it.

    ``w`` digests the whole blocks from ``at`` on that all of them hold, with their place against the gram.  A window
    that begins k bytes before, ``least`` to ``most``, also holds the last k bytes of ``head`` and the first block - k
    of ``tail``.
    """
    whole = length - block

    def run(batches):
        for batch in _slices(batches):
            out = [[] for _ in range(10)]
            for h, doc, t, first, n, gram, alone, raw in zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True):
                for at in range(gram % block, n + block - 1, block):
                    least, most = max(0, at - n + 1), min(block - 1, at)
                    if least > most:
                        continue
                    digest = xxhash.xxh3_128(raw[at : at + whole])
                    digest.update(f"{h} {at - gram}")
                    w, head, tail = digest.digest(), raw[at - most : at], raw[at + whole : at + length - least]
                    digest.update(f" {least} {most} ".encode() + head + tail)
                    row = w, digest.digest(), doc, t, first + at, alone, least, most, head, tail
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            names = [c.split()[0] for c in _PLACES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return run


def _crowded_spans(contexts_with_bytes: DataFrame, length: int, block: int) -> DataFrame:
    """Spans of the contexts of crowded hashes, by counting alone: nothing is gathered, whatever many have in common."""
    places = stored(contexts_with_bytes.mapInArrow(_block_places(length, block), _PLACES))
    total = places.count()
    one = F.min(F.struct("doc", "t", "at", "alone", "least", "most", "head", "tail")).alias("one")
    kinds = stored(places.groupBy("kind").agg(F.count(F.lit(1)).alias("m"), F.first("w").alias("w"), one))
    alike = attach(places.where("alone"), kinds.where("m > 1").select("kind", "m"), "kind", "m", total)
    whole = alike.select("doc", "t", (F.col("at") - F.col("most")).alias("first"), (F.col("at") - F.col("least") + length).alias("end"))
    # Of every kind one place is compared with the other kinds that share its blocks; only kinds of one place are open.
    shared = kinds.groupBy("w").agg(F.count(F.lit(1)).alias("k"), F.min("m").alias("fewest"))
    shared = stored(shared.where("k > 1 AND fewest = 1").drop("fewest"))
    met = attach(kinds, shared, "w", "k", total).select("w", "one.*", (F.col("m") == 1).alias("open"))
    each = met.select("w", "doc", "t", "at", (F.col("open") & F.col("alone")).alias("alone"), "most", "head", "tail", F.explode(F.sequence("least", "most")).alias("k"))
    left = F.expr("substring(head, most - k + 1, k)"), F.expr(f"substring(tail, 1, {block} - k)")
    windows = stored(each.select(F.concat("w", F.encode(F.char("k"), "utf-8"), *left).alias("v"), "doc", "t", (F.col("at") - F.col("k")).alias("first"), "alone"))
    twice = stored(windows.groupBy("v").agg(F.count(F.lit(1)).alias("m")).where("m > 1"))
    found = attach(windows.where("alone"), twice, "v", "m", total)
    return whole.unionByName(found.select("doc", "t", "first", (F.col("first") + length).alias("end")))


def _same_text(a: DataFrame, b: DataFrame):
    return a["doc"].eqNullSafe(b["doc"]) & (a["t"] == b["t"])


def _candidates(keyed: DataFrame, lists: DataFrame):
    """Texts that may have a row in ``lists`` (stored, by doc and t), and the test, which is false for some of the others only."""
    key = F.xxhash64("doc", "t")
    may = member_test(lists.select(key.alias("k")), lists.count())
    return keyed.where(as_column(may)(key)), may


def _meeting(classes: DataFrame) -> DataFrame:
    """Of different contexts (stored) those that may share a window with another one, one of the two without a copy."""

    def key(side: str):
        return F.when(F.col(side).isNotNull(), F.xxhash64(F.lit(side), "h", side))

    sides = classes.select((F.col("m") == 1).alias("single"), F.explode(F.array(key("before"), key("behind"))).alias("k"))
    groups = sides.where("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("single").alias("open"))
    shared = stored(groups.where("n > 1 AND open").select("k"))
    may = member_filter(shared, shared.count())
    # A missing side is looked up as 0: at worst the context is compared in vain.
    return classes.where(may(F.coalesce(key("before"), F.lit(0))) | may(F.coalesce(key("behind"), F.lit(0))))


def repeated_spans(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """Spans (doc, t, first, end) of bytes, overlapping, that cover all repeated windows of texts (doc, t, text)."""
    found = stored(keyed.mapInArrow(_all_contexts(length, gram), _CONTEXT))
    total = found.count()
    hashes = stored(
        found.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.min("c").alias("lo"), F.max("c").alias("hi")).where(F.col("m") > 1)
    )
    recurs = member_filter(hashes.select(F.xxhash64("h").alias("k")), hashes.count())
    again = stored(attach(found.where(recurs(F.xxhash64("h"))), hashes.select("h", "m", (F.col("lo") == F.col("hi")).alias("pure")), "h", "m", total).drop("m"))
    span = ["doc", "t", "first", (F.col("first") + F.col("n") + length - 1).alias("end")]
    whole = again.where("pure").select(*span)

    mixed = again.where(~F.col("pure")).drop("pure")
    order = F.min(F.struct("doc", "t", "first", "n", "gram")).alias("one")
    of_text = [F.first(x).alias(x) for x in ("h", "before", "behind")]
    classes = stored(mixed.groupBy("c").agg(*of_text, F.count(F.lit(1)).alias("m"), order))
    copies = attach(mixed, classes.where("m > 1").select("c", "m"), "c", "m", total).select(*span)
    meeting = _meeting(classes)
    buckets = stored(
        meeting.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.sum((F.col("m") == 1).cast("bigint")).alias("singles")).where("singles > 0").drop("singles")
    )
    place = F.struct("h", "one.first", "one.n", "one.gram", (F.col("m") == 1).alias("alone"), (F.col("k") > bucket).alias("crowded"))
    wanted = attach(meeting, buckets, "h", "k", total).select("one.doc", "one.t", place.alias("w"))
    lists = stored(wanted.groupBy("doc", "t").agg(F.collect_list("w").alias("wanted")))
    some, _ = _candidates(keyed, lists)
    texts = some.join(lists, _same_text(some, lists)).select(some["doc"], some["t"], "text", "wanted")
    bytes_of = stored(texts.mapInArrow(_cut_contexts(length), _CUT))
    small = bytes_of.where(~F.col("crowded")).drop("crowded")
    compared = small.repartition("h").sortWithinPartitions("h", "doc", "t", "first").mapInArrow(_compare(length, block), _SPAN)

    big = bytes_of.where("crowded").drop("crowded").dropDuplicates(["doc", "t", "first", "h"])
    counted = _crowded_spans(big, length, block)
    return whole.unionByName(copies).unionByName(compared).unionByName(counted)


def _removed(may=None):
    """The result for rows of doc_id, text and spans; with ``may`` the third column is a hash, and rows it is true for are left out."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    kinds = [pa.int64()] * 4 + [pa.string()]

    def run(batches):
        for batch in _slices(batches):
            out = [[] for _ in kinds]
            if may:
                batch = batch.filter(pa.array(~may(batch.column(2).to_numpy(zero_copy_only=False))))
            spans_of = [None] * batch.num_rows if may else batch.column(2).to_pylist()
            for doc, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), spans_of, strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                kept, at, runs = hashlib.sha256(), 0, merged(spans or [])
                for first, end in runs:
                    kept.update(raw[at:first])
                    at = end
                kept.update(raw[at:])
                row = doc, len(raw), sum(b - a for a, b in runs), len(runs), kept.hexdigest()
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return run


def merged(spans) -> list[tuple[int, int]]:
    """Spans that touch or overlap as one."""
    out: list[list[int]] = []
    for first, end in sorted((s["first"], s["end"]) if isinstance(s, dict) else tuple(s) for s in spans):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([first, end])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK, bucket: int = BUCKET) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Removed is every byte covered by a string of ``length`` bytes that also starts anywhere else, in this or another
    document; matches never cross documents and are judged on the input.  Null texts count as empty.  Repeated rows are
    copies of each other, so all of a long enough text goes in each of them.  An empty table gives no rows; other
    columns are ignored.  ``length`` is a multiple of ``block`` and at least twice ``gram``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc"), F.xxhash64(text).alias("t"), text.alias("text"))
    spans = repeated_spans(keyed, length, gram, block, bucket)
    lists = stored(spans.groupBy("doc", "t").agg(F.collect_set(F.struct("first", "end")).alias("spans")))
    some, may = _candidates(keyed, lists)
    found = some.join(lists, _same_text(some, lists), "left").select(some["doc"], "text", "spans")
    # The other texts are told apart by the worker that handles them: a column function would be a second worker beside it.
    others = keyed.select("doc", "text", F.xxhash64("doc", "t"))
    kinds = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return found.mapInArrow(_removed(), kinds).unionByName(others.mapInArrow(_removed(may), kinds))
