"""Packing documents into sequences of equal length by multiway differencing.

Documents are cut every ``window`` ids; whole cuts are sequences of their own, what remains of each document is packed.
Remainders are dealt to groups of about GROUP windows by a hash of their row.  In a group, differencing (Karmarkar and
Karp, in its multiway form) starts with one partial partition per remainder, takes the two partitions of greatest
imbalance again and again and merges them so that the fullest windows of one meet the emptiest of the other, until
one partition is left: near-equal windows.  Where one of them exceeds the capacity, the number of windows rises and
the group is partitioned anew.

With a few remainders in a window, near-equal still leaves some hundredths of it empty.  So some remainders of each
group are kept out of the partition and cut to what its windows lack; only these are cut at other places.  What is
left of them is packed on the next level in the same way, until a level is one group; what that one leaves over is cut
into windows, and at last into powers of two.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import kept_in_worker, stored
from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

WINDOW = 2048
END_ID = 1
# Windows that a group fills.
GROUP = 128
# Ids kept out of the partition at first, for each id of a group; more are taken where the windows lack more.
SPARE = 0.05
# Remainders of over half a window, and one in so many of the others, carry their ids so that they can be cut.  Shorter
# ones come two to a window at least, so windows lack at most a third.
CUTTABLE = 3
# Words remembered with their ids in each worker, beside those of one text, and the longest string between spaces among
# them.
MEMO_WORDS = 600_000
MEMO_CHARS = 64
CHUNK = 2_000_000
_LEVEL_BITS, _SLOT_BITS = 36, 20
_PIECE = "row bigint, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary"
_PLACED = _PIECE + ", pack bigint, slot bigint, offset bigint"
_NAMES = [c.split()[0] for c in _PLACED.split(", ")]
_KINDS = [pa.int64()] * 6 + [pa.binary()] + [pa.int64()] * 3


def _batch(columns, n: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS[:n], strict=True)], _NAMES[:n])


class Ids:
    """Ids of whole texts, as little-endian unsigned 32-bit integers.

    The tokenizer lower-cases, drops white space and cuts the rest by one pattern.  A text of Latin letters and ASCII marks
    is cut here, by that pattern, and the library encodes each word once; any other text is handed to it at every
    space.
    """

    def __init__(self, content: str):
        from tokenizers import Tokenizer, pre_tokenizers

        spec = json.loads(content)
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        cuts = [s["pattern"]["Regex"] for s in steps if s["type"] == "Split" and s["behavior"] == "Removed" and s["invert"]]
        self.special = [t["content"] for t in spec["added_tokens"]]
        normal = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if [s["type"] for s in steps] != ["Split", "ByteLevel"] or len(cuts) != 1 or normal != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("only tokenizers that lower-case, cut by one pattern and drop white space are supported")
        if spec["post_processor"] or " " in "".join([*cuts, *self.special]):
            raise ValueError("tokens that reach over spaces or are added at the ends are not supported")
        self.words = re.compile(cuts[0].replace(r"\p{L}", LETTERS).replace(r"\p{N}", "0-9")).findall
        self.tokenizer = Tokenizer.from_str(content)
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.memo: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        found = self.bare.encode(words, is_pretokenized=True, add_special_tokens=False)
        raw = np.array(found.ids, "<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(np.array(found.word_ids, np.int64), minlength=len(words)))).tolist()
        self.memo.update(zip(words, (raw[a:b] for a, b in zip([0, *ends], ends)), strict=True))

    def _apart(self, text: str) -> bytes:
        out = []
        for word in text.split(" "):
            key = " " + word  # no word has a space
            packed = self.memo.get(key)
            if packed is None:
                ids = self.tokenizer.encode(word, add_special_tokens=False).ids
                packed = struct.pack(f"<{len(ids)}I", *ids)
                if len(word) <= MEMO_CHARS:
                    self.memo[key] = packed
            out.append(packed)
        return b"".join(out)

    def documents(self, texts: list[str]) -> list[bytes]:
        """All ids of each text, the end id last."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        plain = [bool(_PLAIN(t)) and not any(s in t for s in self.special) for t in texts]
        words = [self.words(t.lower()) if p else None for t, p in zip(texts, plain, strict=True)]
        new = list(set().union(*filter(None, words)).difference(self.memo))
        if new:
            self._learn(new)
        known, end, out = self.memo.__getitem__, struct.pack("<I", END_ID), []
        for text, those in zip(texts, words, strict=True):
            if those is None:
                for mark in "\n\t\r":
                    text = text.replace(mark, " ")
                out.append(self._apart(text) + end)
            else:
                out.append(b"".join(map(known, those)) + end)
        return out


# The letters among the characters of a plain text; on these, normalising is lower-casing alone.
LETTERS = "A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u012F\u0131-\u017F"
_PLAIN = re.compile("[\\x09-\\x0D -~\u00C0-\u012F\u0131-\u017F]*").fullmatch


def _documents(ids: Ids, batch: pa.RecordBatch):
    """(row, doc_id, ids) of the documents of a batch; those encoded together have about CHUNK characters."""
    held, texts, size = [], [], 0
    for row, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
        held.append((row, doc))
        texts.append(text.as_py() or "")
        size += len(texts[-1])
        if size >= CHUNK:
            yield from ((*h, raw) for h, raw in zip(held, ids.documents(texts), strict=True))
            held, texts, size = [], [], 0
    yield from ((*h, raw) for h, raw in zip(held, ids.documents(texts), strict=True))


def _cut(content: str, window: int):
    name = f"packing {hashlib.sha256(content.encode()).hexdigest()}"

    def run(batches):
        ids, size = kept_in_worker(name, lambda: Ids(content)), 4 * window
        for batch in batches:
            out = [[] for _ in range(7)]
            for row, doc, raw in _documents(ids, batch):
                for at in range(0, len(raw), size):
                    part = raw[at : at + size]
                    n = len(part) // 4
                    carried = window // 2 < n < window or (n < window and zlib.crc32(b"%d" % row) % CUTTABLE == 0)
                    values = row, doc, at // 4, n, zlib.crc32(part), len(raw) // 4, part if carried else None
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
            yield _batch(out, 7)

    return run


def _leaves(node) -> list[int]:
    out, open_nodes = [], [node]
    while open_nodes:
        node = open_nodes.pop()
        if isinstance(node, int):
            out.append(node)
        else:
            open_nodes += node
    return out


def _sum(window) -> int:
    return window[0]


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """``sizes`` dealt to ``k`` windows of near-equal sums: the indices in each, windows without any left out.

    A partial partition is the list of its windows that hold anything, fullest first; a window is its sum and a tree
    of the indices in it.
    """
    count = len(sizes)
    heap = [(-s, i, [(s, i)]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        b = heap[0][2][::-1]
        alone = k - len(b)  # so many of the fullest windows of a meet an empty one of b
        both = [(x[0] + y[0], (x[1], y[1])) for x, y in zip(a[alone:], b)]
        merged = sorted([*a[:alone], *both, *b[len(both) :]], key=_sum, reverse=True)
        count += 1
        imbalance = merged[0][0] - (merged[-1][0] if len(merged) == k else 0)
        heapq.heapreplace(heap, (-imbalance, count, merged))
    return [_leaves(w[1]) for w in heap[0][2]] if heap else []


def near_equal(sizes: list[int], window: int) -> list[list[int]]:
    """Windows of near-equal sums, none above ``window``: their number rises whenever one is."""
    k = -(-sum(sizes) // window)
    while True:
        windows = differencing(sizes, k)
        most = max((sum(sizes[i] for i in w) for w in windows), default=0)
        if most <= window:
            return windows
        k = max(k + 1, k + k * (most - window) // (8 * window))


def pack_group(sizes: list[int], cuttable: list[bool], window: int, last: bool):
    """(slot, i, start, length) of every part of item i in its window; slot -1: left for the next level."""
    total, cuts = sum(sizes), [i for i, c in enumerate(cuttable) if c]
    wanted = SPARE * total
    while True:
        spare, have = [], 0
        for i in cuts:
            if have >= wanted:
                break
            spare.append(i)
            have += sizes[i]
        chosen = set(spare)
        rest = [i for i in range(len(sizes)) if i not in chosen]
        windows = near_equal([sizes[i] for i in rest], window)
        lacking = len(windows) * window - (total - have)
        if have >= lacking or len(spare) == len(cuts):
            break
        wanted = max(1.05 * lacking, wanted * 1.2)
    room = []
    for slot, those in enumerate(windows):
        used = 0
        for j in sorted(those):
            yield slot, rest[j], 0, sizes[rest[j]]
            used += sizes[rest[j]]
        if used < window:
            room.append((slot, window - used))
    left = have - sum(r for _, r in room)
    if last and left > 0:
        fresh = [window] * (left // window) + [1 << b for b in range(window.bit_length(), -1, -1) if left % window >> b & 1]
        room += [(len(windows) + j, r) for j, r in enumerate(fresh)]
    room.reverse()
    for i in spare:
        at = 0
        while at < sizes[i]:
            slot, free = room.pop() if room else (-1, sizes[i])
            n = min(free, sizes[i] - at)
            yield slot, i, at, n
            at += n
            if slot >= 0 and free > n:
                room.append((slot, free - n))


def _pack(window: int, last: bool):
    """Rows (pack, then the columns of a piece), sorted by pack; what is left for the next level has a null slot."""

    def settle(pack, rows):
        # The cuttable ones of documents that are cut already come first, then the longest.
        rows.sort(key=lambda r: (r[2] == 0, -r[3], r[0], r[2]))
        out, filled = [], {}
        for slot, i, start, length in pack_group([r[3] for r in rows], [r[6] is not None for r in rows], window, last):
            row, doc, first, size, crc, tokens, ids = rows[i]
            if length < size:
                ids = ids[4 * start : 4 * (start + length)]
                crc = zlib.crc32(ids)
            place = (pack, slot, filled.get(slot, 0)) if slot >= 0 else (pack, None, None)
            filled[slot] = filled.get(slot, 0) + length
            out.append((row, doc, first + start, length, crc, tokens, ids if slot < 0 else None, *place))
        return _batch(zip(*out, strict=True), 10)

    def run(batches):
        held, pack = [], None
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(8)), strict=True):
                if row[0] != pack and held:
                    yield settle(pack, held)
                    held = []
                pack = row[0]
                held.append(row[1:])
        if held:
            yield settle(pack, held)

    return run


def _levels(rest: DataFrame, window: int, group: int) -> list[DataFrame]:
    """The placed pieces of each level; every level is a stored table."""
    out = []
    while True:
        total = rest.agg(F.sum("length")).first()[0]
        if not total:
            return out
        packs = -(-total // (group * window))
        pack = F.pmod(F.xxhash64("row", F.lit(len(out))), F.lit(packs)).alias("pack")
        dealt = rest.select(pack, *rest.columns).repartition("pack").sortWithinPartitions("pack")
        placed = stored(dealt.mapInArrow(_pack(window, packs == 1), _PLACED))
        out.append(placed.where("slot IS NOT NULL").withColumn("level", F.lit(len(out))))
        if packs == 1:
            return out
        rest = placed.where("slot IS NULL").drop("pack", "slot", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and the end id; a null or empty text is the end id alone.  No sequence is longer than
    ``window``, a power of two.  Repeated rows are documents of their own, also with a null id; other columns are
    ignored; an empty table gives no rows.

    A task holds the remainders of one group at a time, which have about ``group`` * ``window`` ids together and at least
    one id each.  Texts are not shuffled, and ids only of remainders that may be cut.
    """
    if window & (window - 1):
        raise ValueError("the window has to be a power of two")
    with open(tokenizer_path, encoding="utf-8") as file:
        content = file.read()
    Ids(content)
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    # Row numbers are stored before they are used as keys: read again, a lost part could be numbered differently.
    pieces = stored(texts.mapInArrow(_cut(content, window), _PIECE))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    whole = F.col("length") == window
    found = pieces.where(whole).select(
        *columns, (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    for placed in _levels(pieces.where(~whole), window, group):
        pack = F.shiftleft(F.shiftleft(F.col("level").cast("bigint"), _LEVEL_BITS) + F.col("pack"), _SLOT_BITS)
        found = found.unionByName(placed.select(*columns, ((pack + F.col("slot")) * 2 + 1).alias("sequence_id"), "offset"))
    return found
