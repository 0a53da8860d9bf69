"""Line templates, decontamination, licenses, toxicity."""

import random
import zlib

import pytest
from frames import documents

from tidewatch.llm.decontamination import _hash, contaminated, readings, template, token_hashes
from tidewatch.llm.license_texts import TEMPLATES
from tidewatch.llm.licenses import Scanner, align, words_of
from tidewatch.llm.line_templates import line_report
from tidewatch.llm.toxicity import fitted, score, toxicity


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(n))


def test_recurring_templates_go_and_copies_stay(spark):
    r = random.Random(3)
    texts = []
    for i in range(12):
        lines = [prose(r, 12) for _ in range(i + 1)]
        lines.insert(r.randint(0, len(lines)), f"Printed on page {i} of 30")
        lines.append(f"Read all the news from our {prose(r, 1)} desk in the town of old harbour")
        texts.append("\n".join(lines))
    copy = "\n".join(prose(r, 12) for _ in range(5))
    found = {x.doc_id: x for x in line_report(documents(spark, [*texts, *[copy] * 40])).collect()}
    for i in range(12):
        assert found[i].n_dropped == 2 and "Printed" not in found[i].text and "harbour" not in found[i].text
        assert found[i].n_lines == i + 3
    assert all(found[i].n_dropped == 0 and found[i].text == copy for i in range(12, 52))


def test_lines_without_letters_stay(spark):
    texts = ["\n".join(["---", "12", ""] + [f"only {chr(97 + i)}{chr(97 + k)} here" for k in range(i)]) for i in range(8)]
    assert all(x.n_dropped == 0 for x in line_report(documents(spark, texts)).where("doc_id < 2").collect())


def test_template_placeholders():
    assert template("He paid 3.50 dollars to Anna. Anna left")[0] == ["he", "paid", "<number>", "<unit>", "to", "<name>", "anna", "left"]
    assert template("THE WHOLE TEXT CRIES. AND I SAY A WORD")[0] == "the whole text cries and i say a word".split()
    assert template("twelve km")[0] == ["<number>", "<unit>"]
    assert template(None) == ([], [])


ITEM = "Yesterday Peter bought 12 apples and 5 pears from Maria and gave 12 apples back to her so how many fruits has Peter now"


@pytest.mark.parametrize(
    "text, there",
    [
        (ITEM, True),
        ("so it was. " + ITEM + " . the end", True),
        (ITEM.replace("12", "31").replace("5", "8").replace("Peter", "Olga").replace("Maria", "Igor"), True),
        (ITEM.replace("bought 12", "bought 31"), False),  # 12 would stand for two values
        (ITEM.replace("12", "5"), False),  # 12 and 5 would become one
        (ITEM[:60], False),
        ("another thing entirely that nobody asked of anyone here".upper(), None),
        ("nothing of the kind is said here at all", False),
    ],
)
def test_contamination(spark, text, there):
    items = spark.createDataFrame([(7, ITEM), (8, "another thing entirely that nobody asked of anyone here")], "item_id bigint, text string")
    found = contaminated(documents(spark, [text, None, ""]), items).collect()
    assert [(x.doc_id, x.item_id) for x in found] == ([(0, 8)] if there is None else [(0, 7)] if there else [])


def test_hashes_are_those_of_the_readings():
    r = random.Random(8)
    words = "Tom Anna Maria has buys 3 12 twenty five km Dollars minutes OK A . ! apples how How".split()
    for _ in range(300):
        text = " ".join(r.choice(words) for _ in range(r.randint(0, 25)))
        wanted = [[_hash(t) for t in tokens] for tokens, _ in readings(text)]
        found = token_hashes(text, {})
        assert found[0].tolist() == wanted[0] and (found[0] if found[1] is None else found[1]).tolist() == wanted[1]


TOM = "Tom has 3 apples. Tom buys 5 more apples. How many does Tom have?"
LONG = ITEM + " if each of the pears that were left over weighs as much as three of the red apples on the table"


def found_items(spark, text, item):
    items = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    return [x.doc_id for x in contaminated(documents(spark, [text]), items).collect()]


@pytest.mark.parametrize("text", [TOM.replace("Tom", "Olga"), TOM.replace("Tom", "Anna Maria"), "we ask: " + TOM.replace("Tom", "Olga").replace("3", "9")])
def test_names_that_begin_a_sentence(spark, text):
    assert found_items(spark, text, TOM) == [0]


@pytest.mark.parametrize("item, text, there", [("what is truth", "so i ask what is truth and go", True), ("what is truth", "so i ask what is the truth", False), ("12", "all of 13 of us", False)])
def test_items_shorter_than_a_window(spark, item, text, there):
    assert found_items(spark, text, item) == [0] * there


@pytest.mark.parametrize(
    "text",
    [
        LONG.replace("to her so", "to her gladly so"),
        LONG.replace("back to her", "to her"),
        LONG.replace("12", "twenty five"),
        LONG.replace("Peter", "Anna Maria"),
    ],
)
def test_items_with_words_put_in_or_left_out(spark, text):
    assert found_items(spark, "before it. " + text + " and after", LONG) == [0]


def test_alignment_increases_in_both():
    r = random.Random(5)
    for _ in range(200):
        a, b = [[r.choice("abcdefgh") for _ in range(r.randint(0, 15))] for _ in range(2)]
        pairs = align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:], strict=False))


def test_licenses_are_found_in_long_texts_and_told_apart():
    r = random.Random(6)
    scanner = Scanner(TEMPLATES, 0.8)
    for name, text in TEMPLATES.items():
        words = text.split()
        if len(words) > 20:
            words[3] = words[10] = "changed"
        found = scanner.scan(prose(r, 3000) + "\n" + " ".join(words) + "\n" + prose(r, 500))
        assert name in [f[0] for f in found]
        best = next(f for f in found if f[0] == name)
        assert best[2] >= 2990 and best[3] - best[2] <= len(words_of(text)) + 10
    assert scanner.scan(prose(r, 5000)) == []


WRONG = [
    ("Released under the Apache License.", []),
    ("Released under the BSD License.", []),
    ("Released under the MIT License.", ["MIT notice"]),
    ("Licensed under the Apache License, Version 1.1.", []),
    ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0 notice"]),
    ("This work is licensed under the GNU General Public License, version 2.", []),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", []),
    ("This work is licensed under the GNU Affero General Public License, version 3.", []),
    ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0 notice"]),
    ("Licensed under CC BY 3.0.", []),
    ("Licensed under CC BY-ND 4.0.", []),
    ("Licensed under CC BY-NC-SA 4.0.", []),
    ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0 notice"]),
    (TEMPLATES["GPL-3.0 header"].replace("version 3", "version 2"), []),
    (TEMPLATES["GPL-3.0 header"].replace("GNU General", "GNU Lesser General"), []),
    (TEMPLATES["Apache-2.0 header"].replace("2.0", "1.1"), []),
    (TEMPLATES["MPL-2.0 header"].replace("2.0", "1.1"), []),
    (TEMPLATES["BSD-3-Clause"].replace("Neither", "All advertising materials mentioning features must display this. Neither"), []),
    (TEMPLATES["ISC"].replace("provided that the above copyright notice and this permission notice appear in all copies", ""), []),
    (TEMPLATES["MIT"].replace("The above copyright notice and this permission notice shall be included in all copies", ""), []),
]


@pytest.mark.parametrize("around", [0, 40])
@pytest.mark.parametrize("k", range(len(WRONG)))
def test_other_licenses_of_nearly_the_same_words(k, around):
    r = random.Random(k)
    text, names = WRONG[k]
    got = [f[0] for f in Scanner(TEMPLATES, 0.8).scan(f"{prose(r, around)} {text} {prose(r, around)}")]
    assert got == names


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_each_license_is_itself_and_beside_another_of_its_kind(name):
    scanner = Scanner(TEMPLATES, 0.8)
    assert [f[:2] for f in scanner.scan(TEMPLATES[name])] == [(name, 1.0)]
    for text, names in WRONG:
        got = [f[0] for f in scanner.scan(f"{text} Then some words between. {TEMPLATES[name]}")]
        assert got == [*names, name], text


def _common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[j]))
    return row[-1]


def test_alignment_against_the_longest_common_subsequence():
    r = random.Random(12)
    for text in TEMPLATES.values():
        template = words_of(text)
        for share in (0.0, 0.05, 0.2):
            edited = [w for w in template for w in ([w] if r.random() >= share else r.choice([[], ["new"], [w, "more"]]))]
            found, best = len(align(edited, template)), _common(edited, template)
            assert found <= best
            assert found >= 0.9 * best if share else found == best == len(template)


def test_every_place_of_a_license_is_found():
    r = random.Random(9)
    scanner = Scanner(TEMPLATES, 0.8)
    for name, text in TEMPLATES.items():
        size = len(words_of(text))
        for between in (0, 3, size // 2, 500):
            found = [f for f in scanner.scan(prose(r, 5) + " " + text + " " + prose(r, between) + " " + text + " " + prose(r, 7)) if f[0] == name]
            assert [(f[1], f[2]) for f in found] == [(1.0, 5), (1.0, 5 + size + between)], (name, between)
    longest = max(TEMPLATES, key=lambda n: len(TEMPLATES[n]))
    short = min(TEMPLATES, key=lambda n: len(TEMPLATES[n]))
    names = [f[0] for f in scanner.scan(TEMPLATES[longest] + " " + prose(r, 300) + " " + TEMPLATES[short] + " " + prose(r, 300) + " " + TEMPLATES[short])]
    assert names.count(short) >= 2


def test_toxicity_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    rows = {x.doc_id: x for x in toxicity(docs, labels).collect()}
    assert all(x.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, x in rows.items())
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.7) for x in rows.values())
    known = [(x.toxic, rows[x.doc_id]) for x in labels.collect() if rows[x.doc_id].held_out]
    right = sum(t == x.predicted for t, x in known)
    assert right / len(known) > 0.88


def test_misspelt_words_are_caught(spark):
    r = random.Random(7)
    texts, toxic = [], []
    for i in range(200):
        words = prose(r, 60).split()
        if i % 4 == 0:
            for w in r.sample(["idiot", "moron", "stupid", "pathetic"], 2):
                words.insert(r.randint(0, 60), w)
        texts.append(" ".join(words))
        toxic.append(int(i % 4 == 0))
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id bigint, quality int, toxic int")
    model = fitted(documents(spark, texts), labels)
    base = prose(r, 20)
    assert score(base + " idiotic morons stupiid " + base, model) > score(base + " " + prose(r, 3) + " " + base, model)
