import random
import struct
import sys

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewatch.llm.queries import tokenizer_path
from tidewatch.llm.sentencepieces import CharacterMap, Model, encode_decode

MODEL = Model.read(tokenizer_path())
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


def check(text):
    ids = LIBRARY.encode(text, add_bos=True, add_eos=True)
    packed = MODEL.encode(text)
    assert packed == struct.pack(f"<{len(ids)}I", *ids)
    assert MODEL.decode(np.frombuffer(packed, "<u4")) == LIBRARY.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_like_the_library(text):
    check(text)


@pytest.mark.parametrize("text", ["", " ", "  a", "▁x ▁▁y", "a\x00b", "<s></s><0x41>", "x" * 4000, " " * 700, "\r\n\t", "é́\U0001f600"])
def test_odd_texts_like_the_library(text):
    check(text)


def test_random_mixtures():
    r = random.Random(2)
    for _ in range(300):
        check("".join(r.choice(["a", "the ", " ", "▁", "é", "\n", "語", "1"]) for _ in range(r.randint(0, 40))))


def test_spans_cover_the_source_in_order():
    for text in ["The quick  brown fox", "naïve 語語 \U0001f600!", " lead", "a"]:
        raw, at = text.encode(), 0
        for piece, start, end in MODEL.spans(text):
            assert start == at and end >= start
            at = end
            shown = MODEL.pieces[piece]
            if MODEL.types[piece] == 1:
                assert raw[start:end].decode() == shown.replace("▁", " ") or start == 0
        assert at == len(raw)


def test_character_map_takes_the_longest_prefix_and_records_its_place():
    from sentencepiece import sentencepiece_model_pb2

    normaliser = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(normaliser.serialized_model_proto())
    table = CharacterMap(proto.normalizer_spec.precompiled_charsmap)
    text = "ﬁ①カﾞÅx"
    out, source = table.apply(text.encode())
    assert out.decode() == normaliser.normalize(text).lstrip("▁")
    assert len(source) == len(out) + 1 and source[-1] == len(text.encode())
    assert source[:2] == [0, 0]  # both letters of the ligature come from its first byte
    assert sorted(source) == source


def test_query_over_a_table_equals_the_library(spark, folder):
    import hashlib

    table = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in table.collect()}
    for r in encode_decode(table.repartition(3), tokenizer_path()).collect():
        ids = LIBRARY.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
        raw = texts[r.doc_id].encode()
        assert len(r.ends) == len(ids) - 2 and r.ends == sorted(r.ends) and (r.ends or [0])[-1] == len(raw)
        for piece, start, end in zip(ids[1:-1], [0, *r.ends], r.ends):
            if MODEL.types[piece] == 1:
                assert raw[start:end].decode() in (MODEL.pieces[piece].replace("▁", " "), MODEL.pieces[piece].replace("▁", " ")[1:])


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab ▁é語\U0001f600\n"), max_size=30))
def test_spans_of_spaces_and_marks(text):
    raw, at = text.encode(), 0
    for _, start, end in MODEL.spans(text):
        assert start == at <= end
        at = end
    assert at == len(raw)
    normal, source = MODEL.normalise_aligned(text)
    ends, at = [], 0
    for word in MODEL.words(normal):
        for _, width in MODEL.split(word):
            at += width
            ends.append(source[at])
    assert [e for _, _, e in MODEL.spans(text)] == ends


def test_five_megabytes(spark):
    from frames import documents

    text = "some words, é and 語 " * 240_000
    row = encode_decode(documents(spark, [text]), tokenizer_path()).first()
    assert row.ends[-1] == len(text.encode()) and row.n_tokens == len(row.ends) + 2


def test_a_worker_keeps_few_words(monkeypatch):
    monkeypatch.setattr("tidewatch.llm.sentencepieces.MEMO_WORDS", 50)
    model, r = Model.read(tokenizer_path()), random.Random(4)
    for _ in range(200):
        text = " ".join(["often", "é語", *("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(10))])
        assert model.encode(text) == MODEL.encode(text)
        # Two ages of words besides those of one text; what is met again and again is not forgotten.
        assert len(model.memo) + len(model.memo.older) <= 2 * (50 + 25)
        assert model.memo["▁often"] == model.known("▁often")


def test_a_kept_word_is_small():
    r = random.Random(5)
    model = Model.read(tokenizer_path())
    words = ["".join(r.choice("abcdefghij") for _ in range(8)) for _ in range(2000)]
    model.encode(" ".join(words))
    kept = [sys.getsizeof(k) + sys.getsizeof(v) + (sum(map(sys.getsizeof, v)) if isinstance(v, tuple) else 0) for k, v in model.memo.items()]
    assert sum(kept) / len(kept) < 200


def test_decoded_text_of_bytes_and_marks_like_the_library():
    for text in ["語 語語", "a\U0001f600b \U0001f600", "▁x ▁▁y 語▁", " 語", "\x00語", ""]:
        ids, _, decoded = MODEL.pieces_of(text)
        assert decoded == LIBRARY.decode(LIBRARY.encode(text)) == MODEL.decode(ids)


def test_ids_of_many_texts_leave_in_small_batches():
    import pyarrow as pa

    from tidewatch.llm.sentencepieces import _content, _encoded

    texts = [f"text {i} é" for i in range(2500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2500), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    out = list(_encoded(_content(tokenizer_path()), True)(iter([batch, batch.slice(0, 0)])))
    assert max(b.num_rows for b in out) <= 1000
    rows = pa.Table.from_batches(out).to_pylist()
    assert [r["doc_id"] for r in rows] == list(range(2500))
    assert all(struct.pack(f"<{r['n_tokens']}I", *r["ids"]) == MODEL.encode(t) for r, t in zip(rows, texts, strict=True))
