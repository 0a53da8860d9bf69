import random
import re

import pytest
import xxhash
from frames import documents

from tidewatch.llm.components import components
from tidewatch.llm.exact_dedup import exact_duplicates, repeated_filter
from tidewatch.llm.simhash import BITS, covering_links, covering_masks, drop_near_duplicates, fingerprint, simhash_groups


def slow_fingerprint(text, shingle):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    counts = [sum(xxhash.xxh64_intdigest(s, 42) >> b & 1 for s in shingles) for b in range(BITS)]
    return sum(1 << b for b in range(BITS) if counts[b] * 2 > len(shingles))


def linked(values, radius):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {v: find(v) for v in values}


@pytest.mark.parametrize("text", [None, "", "One", "one TWO", "a b c d e", "É A é a " * 40, "x\x0by\x1cz w"])
def test_fingerprint(text):
    assert fingerprint(text, 3) == slow_fingerprint(text, 3)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_every_close_pair_meets_in_a_table(radius):
    masks, r = covering_masks(radius), random.Random(radius)
    for _ in range(3000):
        flipped = sum(1 << b for b in r.sample(range(BITS), radius))
        assert any(not flipped & m for m in masks)


@pytest.mark.parametrize("bucket", [2048, 2])
def test_links_against_brute_force(spark, bucket):
    r = random.Random(4)
    centres = [r.getrandbits(64) for _ in range(20)]
    values = {c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for c in centres for _ in range(12)}
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    frame = spark.createDataFrame([(signed(v),) for v in sorted(values)], "fp bigint").repartition(5)
    found = components(covering_links(frame, 2, bucket)).collect()
    groups = {}
    for x in found:
        groups.setdefault(x.root, set()).add(x.node % (1 << 64))
    wanted = {}
    for v, root in linked(values, 2).items():
        wanted.setdefault(root, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(sorted(g) for g in wanted.values() if len(g) > 1)


def test_components_of_a_path_a_star_and_nothing(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    frame = spark.createDataFrame([*path, *star, *star[:5], (7, 7)], "a bigint, b bigint")
    found = {x.node: x.root for x in components(frame).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(50)}}
    assert components(frame.where("false")).count() == 0


def test_groups_against_brute_force(spark):
    r = random.Random(9)
    base = [" ".join(f"w{r.randint(0, 400)}" for _ in range(120)) for _ in range(15)]
    texts = [" ".join(w if r.random() > 0.003 else "other" for w in t.split()) for t in base for _ in range(8)] + [None, "", " \n"]
    prints = {i: slow_fingerprint(t, 3) for i, t in enumerate(texts)}
    root = linked(set(prints.values()), 2)
    least = {}
    for i in sorted(prints):
        least.setdefault(root[prints[i]], i)
    found = {x.doc_id: (x.fingerprint, x.component_id) for x in simhash_groups(documents(spark, texts)).collect()}
    assert found == {i: (f"{p:016x}", least[root[p]]) for i, p in prints.items()}
    kept = {x.doc_id for x in drop_near_duplicates(documents(spark, texts)).collect()}
    assert kept == set(least.values())


def test_one_of_repeated_rows_stays(spark):
    found = drop_near_duplicates(documents(spark, ["a b c d", "a b c d", "z y x", None], [5, 5, None, None]))
    assert sorted((str(x.doc_id), str(x.text)) for x in found.collect()) == [("5", "a b c d"), ("None", "None"), ("None", "z y x")]


def test_exact_ties(spark):
    texts = ["a b", "ab ", "ab", "  a b", "q", "q", None, "", "Q"]
    ids = [9, 3, 1, 4, 7, 7, 20, 21, 22]
    found = [tuple(x)[:4] for x in exact_duplicates(documents(spark, texts, ids)).collect()]
    assert sorted(found, key=repr) == sorted(
        [(9, 4, 4, False), (3, 4, 4, False), (1, 4, 4, False), (4, 4, 4, True), (7, 7, 2, True), (7, 7, 2, False), (20, 20, 2, True), (21, 20, 2, False), (22, 22, 1, True)],
        key=repr,
    )


def test_filter_misses_no_repeat_even_when_it_is_far_too_small(spark):
    frame = spark.range(30_000).selectExpr("xxhash64(id % 20000) AS h").repartition(7)
    may = repeated_filter(frame, 30_000, 1, 1 << 14)
    again = {x.h for x in frame.groupBy("h").count().where("count > 1").collect()}
    assert again <= {x.h for x in frame.where(may("h")).distinct().collect()}
