"""Benchmark decontamination by templates: re-parameterised items are found as well as copied ones.

Words become template tokens: numbers, names and units give way to typed placeholders, other words to their lower
case.  Whether a capitalised word that begins a sentence is a name can't be seen, so texts are read both ways.  Windows
of template tokens of documents and items are joined by hash.  Along one alignment of a document with an item, which
may shift where words were put in or left out, the values behind the placeholders must be consistent: the same value in the item always stands for the same
value in the document, and the other way round.  An item whose windows are covered well enough is contained.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored, unwrapped, wrapped
from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

WINDOW = 5
COVERAGE = 0.8
# Tokens by which an alignment may shift from one window to the next: words put in or left out.
DRIFT = 5
# Measures whose names are replaced when they follow a number.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg gram grams kilogram kilograms lb lbs "
    "pound pounds oz ounce ounces ml l liter liters litre litres s sec second seconds min minute minutes h hour hours "
    "day days week weeks month months year years mph kmh percent dollar dollars euro euros cent cents usd eur "
    "meter meters metre metres kilometer kilometers kilometre kilometres".split()
)
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
# Item windows up to this many (8 bytes each) are sent along to sift document windows before the join.
SIFTED = 4_000_000
# Item windows up to this many are broadcast in the join; beyond, both sides are shuffled.
BROADCAST_WINDOWS = 50_000
_TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+|[.!?\n]")
_ENDS = frozenset(".!?\n")


END, NUMBER, UNIT, CAPITALISED, CAPITALISED_UNIT, PLAIN = range(6)


def _kind(word: str) -> tuple[int, str]:
    low = word.lower()
    if word in _ENDS:
        return END, low
    if word[0].isdecimal() or low in NUMBER_WORDS:
        return NUMBER, low
    if word[0].isupper() and not word.isupper():
        return (CAPITALISED_UNIT if low in UNITS else CAPITALISED), low
    return (UNIT if low in UNITS else PLAIN), low


def readings(text: str | None) -> tuple[tuple[list[str], list[str]], tuple[list[str], list[str]]]:
    """(template tokens, values behind placeholders, "" for plain words), in two readings.

    Numbers are digits or number words; units are measures right after a number; names are capitalised words that are
    not in capitals throughout, as all words of some texts are.  A capitalised word that begins a sentence is a plain
    word in the first reading and a name in the second.  Numbers or names that follow each other in a sentence are one
    token.
    """
    tokens, values, named, behind = [], [], [], []
    start, number = True, False
    for word in _TOKEN.findall(text or ""):
        kind, low = _kind(word)
        if kind == PLAIN:
            tokens.append(low)
            values.append("")
            named.append(low)
            behind.append("")
            start = number = False
            continue
        if kind == END:
            start, number = True, False
            continue
        if kind == NUMBER:
            one = other = "<number>"
        elif number and kind in (UNIT, CAPITALISED_UNIT):
            one = other = "<unit>"
        elif kind == UNIT:
            one = other = low
        else:
            one, other = low if start else "<name>", "<name>"
        number = kind == NUMBER
        for out, slots, token in ((tokens, values, one), (named, behind, other)):
            if token == low:
                out.append(token)
                slots.append("")
            elif not start and out and out[-1] == token:
                slots[-1] += " " + low
            else:
                out.append(token)
                slots.append(low)
        start = False
    return (tokens, values), (named, behind)


def template(text: str | None) -> tuple[list[str], list[str]]:
    """The first of the :func:`readings`."""
    return readings(text)[0]


_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _hash(token: str) -> int:
    raw = token.encode("utf-8", "surrogatepass")
    return zlib.crc32(raw) | zlib.crc32(raw, 0x5BD1E995) << 32


_NUMBER, _UNIT, _NAME = map(_hash, ("<number>", "<unit>", "<name>"))


def token_hashes(text: str | None, memo: dict) -> tuple[np.ndarray, np.ndarray | None]:
    """The hashes of the tokens of both :func:`readings`, made without the values; no second one if they are equal."""
    ids, marks, joined = [], [], []
    start, number = True, False
    for word in _TOKEN.findall(text or ""):
        known = memo.get(word)
        if known is None:
            if len(memo) > 500_000:
                memo.clear()
            kind, low = _kind(word)
            known = memo[word] = kind, _hash(low)
        kind, token = known
        if kind == PLAIN:
            ids.append(token)
            start = number = False
            continue
        if kind == END:
            start, number = True, False
            continue
        if kind == NUMBER:
            token, number = _NUMBER, True
        else:
            if number and kind != CAPITALISED:
                token = _UNIT
            elif kind != UNIT:
                if start:
                    marks.append(len(ids))
                else:
                    token = _NAME
            number = False
        if start or not ids or ids[-1] != token or token not in (_NUMBER, _UNIT, _NAME):
            if token == _NAME and marks and marks[-1] == len(ids) - 1:
                joined.append(len(ids))
            ids.append(token)
        start = False
    first = np.array(ids, np.uint64)
    if not marks:
        return first, None
    second = first.copy()
    second[marks] = _NAME
    return first, np.delete(second, joined) if joined else second


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """One hash per window of so many tokens, of which there are at least as many."""
    n = len(h)
    if not n:
        return np.empty(0, np.int64)
    total = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        part = h[k : n - width + 1 + k] * _MULTIPLIERS[k % len(_MULTIPLIERS)] + np.uint64(k)
        total = (total ^ (part ^ (part >> np.uint64(29)))) * np.uint64(0xBF58476D1CE4E5B9)
    return (total ^ (total >> np.uint64(32))).view(np.int64)


_SCHEMA = "id bigint, reading int, h bigint, pos bigint, n bigint, slots array<string>"


def _windows(window: int, widths: frozenset[int] | None, sift):
    """Rows (id, reading, hash, position, windows of the text, values behind the placeholders) of the windows sifted.

    Windows have each of the ``widths``; without them, one width, which is that of a text shorter than a window.
    """

    def run(batches):
        memo: dict[str, tuple[int, int]] = {}
        wanted = None if sift is None else sift.value
        for batch in batches:
            out = [[], [], [], [], [], []]
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text, values = text.as_py(), None
                for reading, tokens in enumerate(token_hashes(text, memo)):
                    if tokens is None:
                        continue
                    for width in (min(window, len(tokens)),) if widths is None else widths:
                        if width > len(tokens):
                            continue
                        hashes = window_hashes(tokens, width)
                        at = np.arange(len(hashes))
                        if wanted is not None:
                            where = np.minimum(np.searchsorted(wanted, hashes), max(0, len(wanted) - 1))
                            at = at[wanted[where] == hashes] if len(wanted) else at[:0]
                        if len(at) and values is None:
                            values = [v for _, v in readings(text)]
                        for p in at.tolist():
                            for column, value in zip(out, (i, reading, int(hashes[p]), p, len(hashes), values[reading][p : p + width]), strict=True):
                                column.append(value)
                if len(out[0]) > 20_000:
                    yield _batch(out)
                    out = [[], [], [], [], [], []]
            yield _batch(out)

    return run


def _batch(out):
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], ["id", "reading", "h", "pos", "n", "slots"])


def chains(hits: list[tuple[int, int]], drift: int = DRIFT) -> list[list[int]]:
    """Numbers of the hits (q, pos) of every alignment: each hit with equal pos - q, and the longest chains that
    increase in both and in which pos - q changes by no more than ``drift`` from one hit to the next.
    """
    order = sorted(range(len(hits)), key=hits.__getitem__)
    rigid: dict[int, list[int]] = {}
    for k in order:
        rigid.setdefault(hits[k][1] - hits[k][0], []).append(k)
    if len(rigid) == 1:
        return list(rigid.values())
    # Of each offset the longest chain that ends there: (hits, its last hit), and the hit before each.
    ends: dict[int, tuple[int, int]] = {}
    before: dict[int, int] = {}
    at = 0
    while at < len(order):
        q, added = hits[order[at]][0], {}
        while at < len(order) and hits[order[at]][0] == q:
            k = order[at]
            pos, length, last = hits[k][1], 0, -1
            for offset in range(pos - q - drift, pos - q + drift + 1):
                found = ends.get(offset)
                if found and found[0] > length and hits[found[1]][1] < pos:
                    length, last = found
            added[pos - q] = length + 1, k
            before[k] = last
            at += 1
        ends.update(added)
    out = list(rigid.values())
    for _, k in ends.values():
        chain = []
        while k >= 0:
            chain.append(k)
            k = before[k]
        out.append(chain[::-1])
    return out


def _judged(window: int, coverage: float):
    """(id, number, share, n_slots, n_changed, readings) of the best alignment that is consistent and long enough."""

    def best(of: int, hits: list[dict]):
        tops = None
        for chain in chains([(x["q"], x["pos"]) for x in hits]):
            share = len(chain) / of
            if share < coverage:
                continue
            slots = {(hits[k]["q"] + n, a, d) for k in chain for n, (a, d) in enumerate(zip(hits[k]["asked"], hits[k]["slots"], strict=True)) if a}
            pairs = {(a, d) for _, a, d in slots}
            if len({a for a, _ in pairs}) != len(pairs) or len({d for _, d in pairs}) != len(pairs):
                continue
            changed = sum(a != d for _, a, d in slots)
            # A short item without a plain word would fit any number or name.
            if changed and len(hits[0]["asked"]) < window and all(hits[0]["asked"]):
                continue
            one = share, -changed, len(slots)
            tops = one if tops is None or one > tops else tops
        return tops

    def run(batches):
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                found = best(x["of"], x["hits"])
                if found:
                    rows.append((x["id"], x["number"], found[0], -found[1], found[2], x["readings"]))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int32()]
            names = ["id", "number", "share", "n_changed", "n_slots", "readings"]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names)

    return run


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = COVERAGE, id_column: str = "doc_id") -> DataFrame:
    """Rows (doc_id, item_id, coverage, n_slots, n_changed) of documents that contain an item.

    ``coverage`` is the share of the item's template windows found along one alignment with consistent slots, the
    best of all alignments; ``n_slots`` and ``n_changed`` count its placeholders and those with another value.
    Null and empty texts contain nothing and are contained in nothing; an item shorter than a window is one window,
    looked for in that width, and without a plain word it has to keep its values.
    Items are told apart by item_id, of equal ones by their text; repeated rows of a document count once.  Empty
    tables give no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    texts = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    numbered = stored(texts.where("item_id is not null and text is not null").distinct().withColumn("number", F.monotonically_increasing_id()))
    asked = stored(numbered.select("number", "text").mapInArrow(_windows(window, None, None), _SCHEMA))
    distinct = asked.select("h").distinct()
    n = distinct.count()
    sift = None
    if n <= SIFTED:
        sift = spark.sparkContext.broadcast(np.sort(np.array([r.h for r in distinct.toLocalIterator()], np.int64)))
    widths = frozenset({window, *(r.width for r in asked.select(F.size("slots").alias("width")).distinct().collect())})
    found = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))
    found = found.where(F.col("text").isNotNull() & F.col("id").isNotNull()).mapInArrow(_windows(window, widths, sift), _SCHEMA)
    asked = asked.select(F.col("id").alias("number"), F.col("reading").alias("as"), "h", F.col("pos").alias("q"), F.col("n").alias("of"), F.col("slots").alias("asked"))
    asked = F.broadcast(asked) if n <= BROADCAST_WINDOWS and asked.count() <= BROADCAST_WINDOWS else asked
    met = found.join(asked, "h").where(F.size("slots") == F.size("asked"))
    # Only pairs that share enough windows, wherever they are, are aligned.
    pairs = met.groupBy("id", "number", "reading", "as").agg(
        F.any_value("of").alias("of"), F.collect_set(F.struct("q", "pos", "asked", "slots")).alias("hits")
    )
    pairs = pairs.where(F.size(F.array_distinct(F.col("hits.q"))) >= F.lit(coverage) * F.col("of"))
    pairs = pairs.select("id", "number", (F.col("reading") + F.col("as")).cast("int").alias("readings"), "of", "hits")
    judged = pairs.mapInArrow(_judged(window, coverage), "id bigint, number bigint, share double, n_changed bigint, n_slots bigint, readings int")
    rank = F.struct("share", (-F.col("n_changed")).alias("c"), (-F.col("readings")).alias("r"), "n_slots")
    best = judged.groupBy("id", "number").agg(F.max(rank).alias("b"))
    named = best.join(F.broadcast(numbered.select("number", "item_id")) if n <= BROADCAST_WINDOWS else numbered.select("number", "item_id"), "number")
    one = named.groupBy("id", "item_id").agg(F.max("b").alias("b"))
    return one.select(
        F.col("id").alias(id_column), "item_id", F.col("b.share").alias("coverage"), F.col("b.n_slots").cast("bigint").alias("n_slots"), (-F.col("b.c")).cast("bigint").alias("n_changed")
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """The documents that contain no item, with all their columns; null texts stay.

    Documents are told apart by a hash of doc_id and text, so a null or repeated doc_id does no harm.
    """
    key = F.xxhash64("doc_id", "text").alias("_key")
    found = stored(contaminated(docs.select(key, "text"), items, window, coverage, "_key").select("_key").distinct())
    rows = wrapped(docs).select("_row", F.xxhash64(F.col("_row").getField("doc_id"), F.col("_row").getField("text")).alias("_key"))
    return rows.join(found, "_key", "left_anti").select(*unwrapped(docs.columns))
