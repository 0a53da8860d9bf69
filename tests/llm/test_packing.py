import random
import struct
import zlib
from collections import defaultdict
from itertools import product

import pytest
from frames import documents, odd_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewatch.llm.packing import Ids, differencing, near_equal, pack_documents, pack_group
from tidewatch.llm.queries import word_tokenizer_path

LIBRARY = Tokenizer.from_file(word_tokenizer_path())
with open(word_tokenizer_path(), encoding="utf-8") as file:
    IDS = Ids(file.read())


def wanted(text):
    ids = [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]
    return struct.pack(f"<{len(ids)}I", *ids)


def check_packing(texts, rows, window):
    """Every id of every text in one piece, every sequence gapless and within its length; the padding."""
    ids = {k: wanted(t) for k, t in enumerate(texts)}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert zlib.crc32(ids[r.doc_id][4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32
        assert r.doc_tokens == len(ids[r.doc_id]) // 4 and r.length > 0
        pieces[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc, those in pieces.items():
        at = 0
        for start, length in sorted(those):
            assert start == at
            at += length
        assert 4 * at == len(ids[doc])
    assert set(pieces) == set(ids)
    padding = 0
    for those in sequences.values():
        at = 0
        for offset, length in sorted(those):
            assert offset == at
            at += length
        assert at <= window
        padding += window - at if at & (at - 1) else 0
    return padding


@pytest.mark.parametrize(("window", "group"), [(2048, 128), (64, 8), (64, 1000)])
def test_whole_table(spark, folder, window, group):
    table = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id")
    texts = {r.doc_id: r.text for r in table.collect()}
    assert sorted(texts) == list(range(len(texts)))
    rows = pack_documents(table, word_tokenizer_path(), window, group).collect()
    padding = check_packing([texts[k] for k in range(len(texts))], rows, window)
    assert padding < 0.005 * sum(r.length for r in rows)


def test_odd_documents(spark):
    table = odd_documents(spark)
    rows = pack_documents(table, word_tokenizer_path()).collect()
    assert sorted(str(r.doc_id) for r in rows if r.start == 0) == sorted(str(r.doc_id) for r in table.collect())
    assert sum(r.length for r in rows) == sum(len(wanted(r.text)) // 4 for r in table.collect())
    assert pack_documents(table.where("false"), word_tokenizer_path()).count() == 0


def test_one_very_long_text(spark):
    texts = ["some words of a long text, " * 200_000, None, "x" * 300_000]
    assert check_packing(texts, pack_documents(documents(spark, texts), word_tokenizer_path()).collect(), 2048) < 2048


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list("aB '\nséÉß×1٣́Σ_#\x1cİ .|<>語")) | st.characters(codec="utf-8"), max_size=40))
def test_ids_like_the_library(text):
    special = text[:3] + "<|endoftext|>" + text[3:]
    assert IDS.documents([text, special, text]) == [wanted(text), wanted(special), wanted(text)]


def test_a_full_memo_is_emptied(monkeypatch):
    monkeypatch.setattr("tidewatch.llm.packing.MEMO_WORDS", 10)
    for k in range(5):
        text = " ".join(f"w{chr(97 + k)}{chr(97 + j)}" for j in range(20))
        assert IDS.documents([text]) == [wanted(text)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=7), st.integers(1, 4))
def test_differencing_deals_all_and_nearly_equally(sizes, k):
    windows = differencing(sizes, k)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    assert len(windows) <= k
    if sizes:
        best = min(max(sum(s for s, p in zip(sizes, places) if p == j) for j in range(k)) for places in product(range(k), repeat=len(sizes)))
        assert max(sum(sizes[i] for i in w) for w in windows) <= best * 4 / 3


def test_differencing_merges_opposing_imbalances():
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in differencing([8, 7, 6, 5, 4], 2)) == [14, 16]
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in differencing([8, 7, 6, 5, 4], 3)) == [8, 11, 11]


def test_windows_rise_where_capacity_is_exceeded():
    assert len(near_equal([6, 6, 6], 10)) == 3  # two windows would hold 9 each on the average
    assert len(near_equal([5, 5, 5, 5], 10)) == 2
    assert near_equal([], 10) == []


@pytest.mark.parametrize("sizes", [[1500] * 90, [700] * 120, [1] * 5000, [1025] * 60, [2047] * 40, [5], [1024] * 9, list(range(1, 400))])
@pytest.mark.parametrize("last", [True, False])
def test_groups_of_any_sizes(sizes, last):
    r = random.Random(5)
    cuttable = [s > 1024 or r.random() < 1 / 3 for s in sizes]
    parts, sums = defaultdict(list), defaultdict(int)
    for slot, i, start, length in pack_group(sizes, cuttable, 2048, last):
        parts[i].append((start, length))
        sums[slot] += length
        assert (start, length) == (0, sizes[i]) or cuttable[i]
    for i, size in enumerate(sizes):
        ends = [0]
        for start, length in sorted(parts[i]):
            assert start == ends[-1]
            ends.append(start + length)
        assert ends[-1] == size
    left = sums.pop(-1, 0)
    assert max(sums.values(), default=0) <= 2048 and not (last and left)
    assert sum(2048 - s for s in sums.values() if s & (s - 1)) <= max(2047, 0.02 * sum(sizes))
