"""License scan by patience alignment.

Words that occur once in a stretch of text and once in a template are anchors; the longest increasing subsequence of
their positions is kept, and the gaps between anchors are aligned in the same way.  The share of the template's words
that are aligned is its coverage.  What differs by a name, a version or a clause only is told apart by word sequences
that a place must hold, or must not.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.license_texts import FOREIGN, TELLING, TEMPLATES
from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

COVERAGE = 0.8
_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _anchors(a: list[str], b: list[str], a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """The longest increasing run of positions of words that are unique in both stretches."""
    in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
    at = {w: i for i, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
    pairs = [(i, at[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in at]
    tops, ends, back = [], [], []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        tops[p : p + 1] = [j]
        ends[p : p + 1] = [k]
        back.append(ends[p - 1] if p else -1)
    run, k = [], ends[-1] if ends else -1
    while k >= 0:
        run.append(pairs[k])
        k = back[k]
    return run[::-1]


def align(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Matching positions of two word lists, increasing in both."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        run = _anchors(a, b, a0, a1, b0, b1)
        if not run:
            continue
        for i, j in [*run, (a1, b1)]:
            todo.append((a0, i, b0, j))
            a0, b0 = i + 1, j + 1
        out.extend(run)
    return sorted(out)


Phrases = dict[str, list[str]]


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float, telling: Phrases = TELLING, foreign: Phrases = FOREIGN):
        self.coverage = coverage
        self.telling, self.foreign = ({n: [f" {p} " for p in ps] for n, ps in given.items()} for given in (telling, foreign))
        self.templates = []
        for name, text in templates.items():
            words = words_of(text)
            self.templates.append((name, words, Counter(words), int(np.ceil(coverage * len(words)))))

    def _tells(self, name: str, words: list[str]) -> bool:
        """Whether words that cover a template are those of its license and not of another."""
        must, no = self.telling.get(name, ()), self.foreign.get(name, ())
        text = f" {' '.join(words)} " if must or no else ""
        return all(p in text for p in must) and not any(p in text for p in no)

    def _places(self, name: str, words: list[str], inside: np.ndarray, template: list[str], least: int, at: int, end: int) -> list[tuple[float, int, int]]:
        """(coverage, first word, word after the last) of the places of a template among the words from at to end.

        Beside a place that is found, the words before and behind it are searched in the same way.  Copies that share
        a stretch leave few words that occur once; where that hides a place or draws it over several copies, pieces
        not much longer than the template are looked at.
        """
        if inside[end] - inside[at] < least:
            return []
        size = len(template)
        step = max(1, size // 4)
        pairs = align(words[at:end], template)
        covered = len(pairs) >= least
        first, last = (at + pairs[0][0], at + pairs[-1][0] + 1) if covered else (at, end)
        if covered and last - first > size:
            # A place that begins with words of the text before it is drawn together from its end.
            back = align(words[first:last][::-1], template[::-1])
            if len(back) >= len(pairs):
                pairs, first, last = back, last - back[-1][0] - 1, last - back[0][0]
        if last - first > size + step:
            pieces = range(first, max(first + 1, last - least + 1), step)
            found = [p for k in pieces for p in self._places(name, words, inside, template, least, k, min(last, k + size + step))]
            if found and not covered:
                return found
        else:
            found = []
        if not covered:
            return []
        if not found and self._tells(name, words[first:last]):
            found = [(len(pairs) / size, first, last)]
        return [
            *self._places(name, words, inside, template, least, at, first),
            *found,
            *self._places(name, words, inside, template, least, last, end),
        ]

    def scan(self, text: str | None) -> list[tuple[str, float, int, int]]:
        """(template, coverage, first word, word after the last) of every place where a template is covered.

        The text is looked at in stretches of twice the template's words, each beginning one template after the one
        before, so any place that the template fits is whole in one of them.  A stretch with too few of the
        template's words can't be covered and is passed over.  Where places overlap, of one template or of several,
        the one that is covered best stays, of equal ones the longest.
        """
        words = words_of(text)
        found = set()
        if not words:
            return []
        present = set(words)
        for name, template, counts, least in self.templates:
            if sum(n for w, n in counts.items() if w in present) < least:
                continue
            inside = np.concatenate([[0], np.cumsum(np.fromiter((w in counts for w in words), np.int64, len(words)))])
            size = len(template)
            for at in range(0, len(words), size):
                places = self._places(name, words, inside, template, least, at, min(len(words), at + 2 * size))
                found.update((name, *place) for place in places)
        kept = []
        for one in sorted(found, key=lambda f: (-f[1], f[2] - f[3], f[0], f[2])):
            if all(one[3] <= other[2] or other[3] <= one[2] for other in kept):
                kept.append(one)
        return sorted(kept, key=lambda f: f[2])


def _scanned(*given):
    def run(batches):
        scanner = Scanner(*given)
        for batch in batches:
            rows = [(i, *f) for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True) for f in scanner.scan(t.as_py())]
            kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "license", "coverage", "first_word", "end_word"])

    return run


def license_scan(docs: DataFrame, templates: dict[str, str] = TEMPLATES, coverage: float = COVERAGE, telling: Phrases = TELLING, foreign: Phrases = FOREIGN) -> DataFrame:
    """Rows (doc_id, license, coverage, first_word, end_word) of the places where documents cover a template.

    Words are counted from 0.  Several places of one template in a document give a row each.  Null and empty texts cover
    nothing; repeated rows give repeated results; an empty table gives none; other columns are ignored.  ``telling`` and
    ``foreign`` list by template the word sequences that its places must and must not hold.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_scanned(templates, coverage, telling, foreign), "doc_id bigint, license string, coverage double, first_word bigint, end_word bigint")
