"""HTML extraction and the WARC audit."""

import hashlib
import itertools
import math
import random
import time

import pytest
from pyspark.sql import functions as F

from tidewatch.llm.fixity import fixity_audit, record_index, warc_record
from tidewatch.llm.html_extract import extract, features, fit, main_text, marginals
from tidewatch.llm.html_layouts import known_label, layouts
from tidewatch.llm.html_tree import Node, parse
from tidewatch.llm.queries import replicated


@pytest.fixture(scope="module")
def weights():
    return fit([(n, known_label(n)) for n in map(parse, layouts())])


def test_marginals_against_all_labellings():
    r = random.Random(1)
    for _ in range(20):
        n = r.randint(1, 7)
        nodes = [Node("x", -1)] + [Node("x", r.randrange(i)) for i in range(1, n)]
        scores, edge = [r.uniform(-2, 2) for _ in range(n)], [[r.uniform(-1, 1) for _ in range(2)] for _ in range(2)]
        total, ones = 0.0, [0.0] * n
        for labels in itertools.product((0, 1), repeat=n):
            w = math.exp(sum(s for s, y in zip(scores, labels, strict=True) if y) + sum(edge[labels[nodes[i].parent]][labels[i]] for i in range(1, n)))
            total += w
            for i, y in enumerate(labels):
                ones[i] += w * y
        found, _ = marginals(nodes, scores, edge)
        assert found == pytest.approx([o / total for o in ones])


def test_unseen_layouts(weights):
    right = seen = 0
    for page in layouts(120, seed=77):
        nodes = parse(page)
        scores = [sum(weights.node.get(f, 0.0) for f in fs) for fs in features(nodes)]
        found, _ = marginals(nodes, scores, weights.edge)
        for x, p, y in zip(nodes, found, known_label(nodes), strict=True):
            if x.runs:
                seen += 1
                right += (p > 0.5) == y
    assert right / seen > 0.97


@pytest.mark.parametrize("start", ["<p>Article", "<div><p>Article", "<b>Article</b>", "Article", "</head><p>Article", "<body><p>Article"])
def test_head_ends_where_its_tags_are_left_out(start):
    nodes = parse(f"<html><head><title>x</title>\n<meta charset=utf-8><style>p {{}}</style>{start} text</p><p>More")
    assert " ".join(text for n in nodes for _, text, _ in n.runs if not n.hidden).split() == ["Article", "text", "More"]


def test_blocks_white_space_and_references(weights):
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body>
        <nav><ul><li><a href="/a">Home</a></li><li><a href="/b">More</a></li></ul></nav><!-- <p>no</p> -->
        <article><h1>One &amp; two</h1><p>First  <b>bold
        words</b> of a sentence, and more of it.<br><p>Second&nbsp;part &lt;x&gt; is here, too.</article>
        <footer>&copy; somebody</footer></body></html>"""
    assert extract(page, weights) == "One & two\nFirst bold words of a sentence, and more of it.\nSecond part <x> is here, too."


@pytest.mark.parametrize("page", [None, "", "<", "<p", "</div></div>", "<script>", "<!--", "&#x110000;&bogus;", "<a" * 500, "<div>" * 3000])
def test_broken_pages(page, weights):
    assert isinstance(extract(page, weights), str)


HOSTILE = {
    "tags that never end": "<a " * 1_700_000,
    "end tags that fit nothing": "<div>" * 20_000 + "</p></other>" * 20_000,
    "raw elements that never end": "<noscript>" * 100_000,
    "crossed quotes": "<a '\"b>" * 600_000,
    "one quote too many": "<p x=\"1' " * 500_000,
    "declarations": "<!" * 2_500_000,
    "a long attribute": "<div " + "x" * 5_000_000 + ">a",
    "closed below a border": "<p><button>" + "<foo>" * 20_000 + "<h1></h1>" * 20_000,
}


@pytest.mark.parametrize("name", HOSTILE)
def test_time_is_in_proportion_to_the_page(name, weights):
    begun = time.process_time()
    assert isinstance(extract(HOSTILE[name], weights), str)
    assert time.process_time() - begun < 20


def test_a_page_of_five_megabytes(weights):
    body = "".join(f"<p>Sentence number {i} of a long article, told in full.</p>" for i in range(90_000))
    page = f"<html><body><nav><a href='/'>Home</a></nav><article>{body}</article></body></html>"
    assert len(page) > 5_000_000
    assert extract(page, weights) == "\n".join(f"Sentence number {i} of a long article, told in full." for i in range(90_000))


def test_a_quote_that_never_ends(weights):
    nodes = parse('<div><p class="x>One</p><p title=a>b>Two</p></div>')
    assert [t for n in nodes for _, t, _ in n.runs] == ["One", "b>Two"]


def test_main_text_of_odd_rows(spark, weights):
    page = "<html><body><article><p>A sentence of the article, and more of it.</p></article></body></html>"
    rows = [(1, "u", page), (1, "u", page), (None, None, page), (2, "v", None), (3, None, "")]
    frame = spark.createDataFrame([(*r, "t", 5, True) for r in rows], "page_id bigint, url string, html string, text string, n_chars int, weight boolean")
    got = sorted(map(repr, map(tuple, main_text(frame, weights).collect())))
    text = "A sentence of the article, and more of it."
    expected = [(1, "u", text, len(text)), (1, "u", text, len(text)), (None, None, text, len(text)), (2, "v", "", 0), (3, None, "", 0)]
    assert got == sorted(map(repr, expected))
    empty = main_text(frame.where("false"), weights)
    assert empty.columns == ["page_id", "url", "text", "n_chars"] and empty.count() == 0


def test_main_text_of_the_pages(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    rows = {x.page_id: x for x in main_text(pages).collect()}
    assert len(rows) == pages.count()
    for x in pages.collect():
        found = rows[x.page_id]
        assert found.n_chars == len(found.text) and found.url == x.url
        assert "<" not in found.text or "&lt;" in x.html


def replicas(spark, n=400):
    pages = spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit("http://x/"), "id").alias("url"), F.repeat(F.lit("ab "), 900).alias("html")).repartition(3)
    return record_index(pages, warc_record(F.col("url"), F.col("html")), "page_id").cache()


def test_audit_finds_each_fault(spark):
    index = replicas(spark)
    changed, lost, more = {3, 250}, {7, 399}, {11}
    right = index.where(~F.col("page_id").isin(*lost)).withColumn("digest", F.when(F.col("page_id").isin(*changed), "bad").otherwise(F.col("digest")))
    right = right.unionByName(index.where(F.col("page_id").isin(*more)).withColumn("offset", F.col("offset") + 1))
    found = fixity_audit(index, right).join(index, ["file", "offset"], "left")
    assert sorted((x.fault, x.page_id if x.fault != "extra" else -1) for x in found.collect()) == [("changed", 3), ("changed", 250), ("extra", -1), ("missing", 7), ("missing", 399)]


def test_offsets_follow_lengths_and_equal_replicas_differ_in_nothing(spark):
    index = replicas(spark, 50)
    for file in {x.file for x in index.collect()}:
        at = 0
        for x in sorted((x for x in index.collect() if x.file == file), key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
    assert fixity_audit(index, index).count() == 0
    assert fixity_audit(index.where("false"), index.where("false")).count() == 0
    assert fixity_audit(index, index.where("false")).count() == 50


def test_replica_digests_are_hashes_of_its_bytes(spark):
    pages = spark.createDataFrame([(i, f"http://a/{i}", "é" * i) for i in range(400)], "page_id bigint, url string, html string")
    records = {r.page_id: bytes(r.b) for r in pages.select("page_id", warc_record(F.col("url"), F.col("html")).alias("b")).collect()}
    rows = replicated(pages).collect()
    hurt = [r for r in rows if r.fate in ("00", "01")]
    assert hurt and len(rows) == 400
    for r in rows:
        held = records[r.page_id][:-1] + b"\x00" if r in hurt else records[r.page_id]
        assert r.replica == hashlib.sha256(held).hexdigest() and r.length == len(held)


def test_audit_of_odd_rows(spark):
    schema = "file int, offset bigint, digest string, node bigint, above bigint, fault string"
    frame = lambda rows: spark.createDataFrame([(*r, 1, 2, "x") for r in rows], schema)
    audit = lambda a, b: sorted(map(tuple, fixity_audit(frame(a), frame(b)).collect()))
    left = [(0, 0, "a"), (0, 10, "b"), (1, 0, "c")]
    assert audit(left, left) == []
    # A null digest is an empty one; rows that can't be placed are left out.
    assert audit([(0, 0, None)], [(0, 0, "")]) == []
    assert audit([(0, 0, None)], [(0, 0, "a")]) == [(0, 0, "changed")]
    assert audit([*left, (None, 5, "z"), (0, None, "z")], left) == []
    # A repeated record is not a single one, but the same as one repeated as often.
    assert audit(left, [*left, left[1]]) == [(0, 10, "changed")]
    assert audit([*left, left[1]], [*left, left[1]]) == []
    assert audit([], left) == [(0, 0, "extra"), (0, 10, "extra"), (1, 0, "extra")]
    assert audit(left, []) == [(0, 0, "missing"), (0, 10, "missing"), (1, 0, "missing")]
    assert audit([], []) == []
