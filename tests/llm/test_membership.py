from pyspark.sql import functions as F
from test_substrings import brute

from tidewatch.llm.membership import member_filter
from tidewatch.llm.substring_dedup import remove_repeats


def test_no_member_is_refused_and_few_others_pass(spark):
    hashes = spark.range(3000).select(F.xxhash64("id").alias("h")).repartition(4)
    others = spark.range(3000, 9000).select(F.xxhash64("id").alias("h"))
    may = member_filter(hashes, 3000)
    assert hashes.where(~may("h")).count() == 0
    assert others.where(may("h")).count() < 120
    full = member_filter(hashes, 3000, max_bits=1)
    assert hashes.where(~full("h")).count() == 0
    nothing = member_filter(hashes.limit(0), 0)
    assert others.where(nothing("h")).count() == 0


def test_repeated_rows_null_ids_and_empty_tables(spark):
    word = "".join(chr(97 + k * k % 23) + str(k) for k in range(200))
    rows = [(1, word + "x" * 70), (1, word + "x" * 70), (1, "other " + word), (None, word[5:]), (None, None), (2, "short")] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = sorted(((x.doc_id is None, x.doc_id or 0), *tuple(x)[1:]) for x in remove_repeats(docs, 64, 16, 8).collect())
    wanted = brute([t for _, t in rows], 64)
    assert got == sorted(((d is None, d or 0), *w) for (d, _), w in zip(rows, wanted))
    assert remove_repeats(docs.limit(0), 64, 16, 8).count() == 0


def test_texts_without_spans_need_one_python_worker(spark):
    docs = spark.createDataFrame([(i, f"{i} " * 200) for i in range(20)], "doc_id bigint, text string")
    plan = remove_repeats(docs, 64, 16, 8)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2
    assert plan.count("ArrowEvalPython") == 1  # of the texts that go into the join
