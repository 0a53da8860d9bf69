import hashlib
import random
from collections import Counter

import pytest
from frames import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm import substring_dedup
from tidewatch.llm.substring_dedup import contexts, merged, remove_repeats, side_hashes
from tidewatch.llm.suffix_grouping import suffix_array


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_suffix_array_is_sorted(symbols):
    assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        runs = merged([(i, i + length) for i in range(len(r) - length + 1) if seen[r[i : i + length]] > 1])
        gone = {k for a, b in runs for k in range(a, b)}
        out.append((len(r), len(gone), len(runs), hashlib.sha256(bytes(x for k, x in enumerate(r) if k not in gone)).hexdigest()))
    return out


@pytest.mark.parametrize("bucket", [200, 1])
def test_against_brute_force(spark, bucket):
    r = random.Random(8)
    parts = ["".join(r.choice("ab c") for _ in range(r.randint(50, 250))) for _ in range(10)]
    texts = []
    for _ in range(120):
        pick = lambda: r.choice(parts)[r.randint(0, 40) :] if r.random() < 0.6 else "".join(r.choice("abcdé ") for _ in range(50))
        texts.append("".join(pick() for _ in range(r.randint(0, 6))))
    texts += ["a" * 500, "ab" * 300, None, "", "xyz" * 50 + "q" + "xyz" * 50, "short", "short"]
    found = {x.doc_id: tuple(x)[1:] for x in remove_repeats(documents(spark, texts).repartition(5), 64, 16, 8, bucket).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts, 64)


def test_edges_of_the_length(spark):
    r = random.Random(1)
    common = "".join(r.choice("abcdefgh") for _ in range(401))
    noise = ["".join(r.choice("ijklmnop") for _ in range(300)) for _ in range(6)]
    texts = [noise[0] + common[:400] + noise[1], noise[2] + common[:400] + noise[3], noise[4] + common[:399] + noise[5], "x", "x"]
    found = {x.doc_id: x.n_removed for x in remove_repeats(documents(spark, texts)).collect()}
    assert found == {0: 400, 1: 400, 2: 0, 3: 0, 4: 0}


def test_contexts_that_share_no_window_are_not_cut(spark, monkeypatch):
    r = random.Random(3)
    noise = lambda n: "".join(r.choice("abcdefghijklmnop") for _ in range(n))
    sentence = noise(120)  # under half of what a window has besides its gram
    texts = [noise(r.randint(500, 700)) + sentence + noise(r.randint(500, 700)) for _ in range(60)]
    passage = noise(450)
    texts += [noise(300) + passage, passage + noise(300), noise(200) + passage + noise(200)]
    # Windows that begin and end far from their gram, in contexts that have one side only.
    texts += [passage[40:] + noise(5), noise(5) + passage[:405]]
    rows, stored, attach = [], substring_dedup.stored, substring_dedup.attach

    def seen(df):
        rows.append((df.columns, out := stored(df)))
        return out

    def attached(left, groups, key, size, total):
        if key == "h" and "doc" in left.columns:
            assert left.count() < total / 2  # contexts whose hash does not recur stay where they are
        return attach(left, groups, key, size, total)

    monkeypatch.setattr(substring_dedup, "stored", seen)
    monkeypatch.setattr(substring_dedup, "attach", attached)
    found = {x.doc_id: tuple(x)[1:] for x in remove_repeats(documents(spark, texts)).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts, 400)
    assert {x.doc for df in (df for names, df in rows if names == ["doc", "t", "wanted"]) for x in df.collect()} <= set(range(60, 65))
    assert any("bytes" in names and df.count() for names, df in rows)


@pytest.mark.parametrize("length, gram", [(40, 16), (40, 15), (33, 16)])
def test_equal_windows_agree_on_a_side(length, gram):
    r = random.Random(length + gram)
    met = 0
    for _ in range(300):
        common = bytes(r.choice(b"abcd") for _ in range(length))
        held = []
        for _ in range(2):
            raw = bytes(r.choice(b"abcd") for _ in range(r.randint(0, 60)))
            at, raw = len(raw), raw + common + bytes(r.choice(b"abcd") for _ in range(r.randint(0, 60)))
            (own,) = [x for x in contexts(raw, length, gram) if x[1] <= at < x[1] + x[2]]
            held.append((own, side_hashes(raw, own[1], own[1] + own[2] + length - 1, own[3], length, gram)))
        (one, a), (two, b) = held
        assert one[0] == two[0]
        assert any(x == y is not None for x, y in zip(a, b, strict=True))
        met += a != b
    assert met > 100
