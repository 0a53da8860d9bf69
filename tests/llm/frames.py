"""Awkward documents that every operator has to withstand."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, _row string, row bigint, h bigint, fp bigint"


def documents(spark, texts, ids=None):
    """Documents with columns whose names operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "s", None if t is None else len(t), True, "r", k, k, k) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, DOCS)


ODD_TEXTS = [None, "", " ", "\n", "a", "a b", "a b c", "é ñ 語", "▁ ▁x", "0", "x" * 3000, "word " * 4000, "same text here", "same text here", "tab\tand\x0bmore\r\n"]


def odd_documents(spark):
    """Null ids, repeated ids and repeated rows among them."""
    texts = [*ODD_TEXTS, "same text here", "null id", "null id", None]
    ids = [*range(len(ODD_TEXTS)), 12, None, None, None]
    return documents(spark, texts, ids)
