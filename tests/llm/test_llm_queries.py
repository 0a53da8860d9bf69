"""Registered queries with a SQL counterpart on the smallest tables; the others over odd and empty tables."""

import pytest
from frames import documents, odd_documents
from pyspark.sql import functions as F

import corpus_pipeline
from tidewatch.llm import decontamination, exact_dedup, html_extract, licenses, line_templates, sentencepieces, simhash, substring_dedup, toxicity
from tidewatch.llm.queries import llm_oracles, llm_queries, tokenizer_path


def rows_of(frame):
    return sorted((tuple(sorted(r.asDict().items())) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_equals_sql(name, spark, folder, duck):
    found = duck.sql(llm_oracles()[name])
    wanted = sorted((tuple(sorted(zip(found.columns, r, strict=True))) for r in found.fetchall()), key=repr)
    assert rows_of(llm_queries()[name](spark, folder)) == wanted


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in llm_queries()} == set(range(1, 14))


def labels(spark):
    return spark.createDataFrame([(i, 1, i % 2) for i in range(12)], "doc_id bigint, quality int, toxic int")


def items(spark):
    return spark.createDataFrame([(1, "what is the sum of 3 apples and 5 apples"), (None, "x"), (2, None), (3, "")], "item_id bigint, text string")


PER_DOCUMENT = {
    "toxicity": lambda s, d: toxicity.toxicity(d, labels(s)),
    "substrings": lambda s, d: substring_dedup.remove_repeats(d),
    "exact": lambda s, d: exact_dedup.exact_duplicates(d),
    "simhash": lambda s, d: simhash.simhash_groups(d),
    "lines": lambda s, d: line_templates.line_report(d),
    "pieces": lambda s, d: sentencepieces.encode_decode(d, tokenizer_path()),
    "spans": lambda s, d: sentencepieces.encode_spans(d, tokenizer_path()),
}
FILTERS = {
    "toxicity": lambda s, d: toxicity.drop_toxic(d, labels(s)),
    "lines": lambda s, d: line_templates.drop_recurring_lines(d),
    "simhash": lambda s, d: simhash.drop_near_duplicates(d),
    "items": lambda s, d: decontamination.drop_contaminated(d, items(s)),
}
SEARCHES = {
    "licenses": lambda s, d: licenses.license_scan(d),
    "items": lambda s, d: decontamination.contaminated(d, items(s)),
}


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_odd_documents_each_get_a_row(name, spark):
    docs = odd_documents(spark)
    found = PER_DOCUMENT[name](spark, docs)
    assert sorted(map(str, (r.doc_id for r in found.select("doc_id").collect()))) == sorted(map(str, (r.doc_id for r in docs.collect())))


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_columns_of_odd_documents(name, spark):
    docs = odd_documents(spark)
    found = FILTERS[name](spark, docs)
    assert found.schema.simpleString() == docs.schema.simpleString()
    assert found.count() <= docs.count()


@pytest.mark.parametrize("name", SEARCHES)
def test_searches_pass_odd_documents(name, spark):
    assert SEARCHES[name](spark, odd_documents(spark)).count() == 0


@pytest.mark.parametrize("operator", [*PER_DOCUMENT.values(), *FILTERS.values(), *SEARCHES.values()])
def test_empty_table(operator, spark):
    assert operator(spark, odd_documents(spark).where("false")).count() == 0


def test_empty_pages(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert html_extract.main_text(pages).count() == 0


def test_pipeline_stages_chain(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "sentencepiece"]
    found = corpus_pipeline.run(spark, folder)
    ids = found.select("doc_id")
    assert 0 < ids.count() < docs.count()
    assert ids.distinct().count() == ids.count()
    assert ids.join(docs, "doc_id", "left_anti").count() == 0
    assert found.where(F.size("ids") != F.col("n_tokens")).count() == 0


def test_pipeline_drops_what_it_should(spark, tmp_path):
    clean = [f"a calm sentence about {w} and the weather in the village of {w}ton" for w in "wheat barley oats rye corn rice millet hops flax hemp".split()]
    bad = [f"you {w} idiot and {w} moron get lost you {w} scum" for w in "old big sad mad odd bad hot wet dry shy".split()]
    item = "how many tiles cover a floor that is seven metres long and four metres wide"
    texts = [*clean, *bad, clean[0], "before it " + item + " and after it", None]
    table = documents(spark, texts).select("doc_id", "text", "lang", "source", "n_chars")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(10 <= i < 20)) for i in range(20)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert 20 not in kept and 21 not in kept  # the copy and the leak
    assert not kept & set(range(10, 20))
    assert set(range(10)) <= kept and 22 in kept
