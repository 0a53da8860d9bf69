"""What recurs is dropped however often it occurs; copies of one document keep their prose."""

import pytest
from frames import documents

from tidewatch.llm.line_templates import line_report


def word(k, letters="bcdfghklmnprstvz"):
    out = ""
    k += 17
    while k:
        k, r = divmod(k, len(letters))
        out += letters[r] + "aeiou"[r % 5]
    return out


def prose(k, lines):
    return [f"{word(1000 * k + j)} {word(7 * k + j)} went {word(3 * k + 11 * j)} over {word(k * j + 5)} quietly" for j in range(lines)]


FOOTER = "All rights belong to the readers of this small and quiet paper"
CASES = {
    "footer": (lambda k: FOOTER, lambda k: 1 + k % 8),
    "footer of two-line documents": (lambda k: FOOTER, lambda k: 1),
    "footer of long documents": (lambda k: FOOTER, lambda k: 12),
    "two fields": (lambda k: f"Read all the news from our {word(k % 60)} desk in the town of {word(k // 60 * 7 + k % 61)} harbour", lambda k: 3),
    "two fields of some values": (lambda k: f"Read all the news from our {word(k % 3)} desk in the town of {word(k // 3 % 3)} harbour", lambda k: 3),
    "short line": (lambda k: f"Posted by {word(k % 50)} in {word(k % 37)}", lambda k: 2),
    "short line with a number": (lambda k: f"Posted by {word(k % 50)} in {word(k % 37)} {k}", lambda k: 2),
}


@pytest.mark.parametrize("n", [60, 300, 3000])
def test_recurring_lines_go_however_often(spark, n):
    """All cases in one table; each document has one planted line, first, in the middle or last."""
    texts, planted = [], []
    for c, (line, lines) in enumerate(CASES.values()):
        for k in range(n):
            own = prose(100_000 * c + k, lines(k))
            own.insert(k % (len(own) + 1), line(k))
            texts.append("\n".join(own))
            planted.append(line(k))
    rows = {r.doc_id: r for r in line_report(documents(spark, texts)).collect()}
    kept = {name: sum(planted[i] in rows[i].text.split("\n") for i in range(c * n, (c + 1) * n)) for c, name in enumerate(CASES)}
    assert kept == dict.fromkeys(CASES, 0)
    assert all(rows[i].n_dropped == 1 for i in rows)


@pytest.mark.parametrize("n", [3, 60, 300])
def test_copies_keep_their_prose(spark, n):
    copy = "\n".join([*prose(1, 6), FOOTER])
    others = ["\n".join([*prose(50 + k, 3), FOOTER]) for k in range(4)]
    rows = {r.doc_id: r for r in line_report(documents(spark, [copy] * n + others)).collect()}
    assert all(rows[i].n_dropped == 1 and rows[i].text == "\n".join(prose(1, 6)) for i in range(n))
    alone = {r.doc_id: r.n_dropped for r in line_report(documents(spark, [copy] * n)).collect()}
    assert set(alone.values()) == {0}


def test_a_line_in_two_documents_stays(spark):
    texts = ["\n".join([*prose(k, 3), FOOTER]) for k in range(2)]
    assert {r.n_dropped for r in line_report(documents(spark, texts)).collect()} == {0}


def test_one_very_long_text(spark):
    texts = ["\n".join(prose(9, 100_000)), "x" * 5_000_000, *("\n".join([*prose(k, 2), FOOTER]) for k in range(3))]
    rows = {r.doc_id: r.n_dropped for r in line_report(documents(spark, texts)).collect()}
    assert {k: rows[k] for k in (1, 2, 3, 4)} == {1: 0, 2: 1, 3: 1, 4: 1}


def test_a_document_of_recurring_lines_only_stays_whole(spark):
    texts = [FOOTER, f"{FOOTER}\n---", *("\n".join([*prose(k, 2), FOOTER]) for k in range(3))]
    rows = {r.doc_id: (r.n_dropped, r.text) for r in line_report(documents(spark, texts)).collect()}
    assert [rows[k] for k in (0, 1)] == [(0, texts[0]), (0, texts[1])]
    assert all(rows[k] == (1, "\n".join(prose(k - 2, 2))) for k in (2, 3, 4))
