import random
import re

import pytest

from tidemark.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    inside = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 8)}
    symbols = sum(c in "#*$%&|<>" for c in text)
    return sum(map(len, words)), symbols, len(words), len(lines) - len(set(lines)), len(inside)


def texts():
    rng = random.Random(5)
    out = [None, "", " \t\n", "one", "a\n\na\na \n", "é# ü* \x0b\x0c x\r\ny", "w " * 40, "   ", "a b c d e f g h " * 3]
    for _ in range(40):
        words = [rng.choice("ab#") * rng.randint(1, 3) for _ in range(rng.randint(0, 60))]
        out.append("".join(w + rng.choice(" \n\t") for w in words))
    out.append(" ".join(str(i % 4000) for i in range(9000)))  # long, repeating at a distance
    return out


def test_statistics_equal_brute_force(spark):
    rows = list(enumerate(texts()[:-1]))
    df = spark.createDataFrame(rows + rows[:3], "i int, t string")
    got = quality.statistics(df, "i", "t").collect()
    assert len(got) == len(rows) + 3
    for r in got:
        assert (r.word_chars, r.n_symbols, r.n_words, r.n_dup_lines, r.n_repeat_words) == expected(rows[r.id][1])


def test_a_long_text(spark):
    r = quality.statistics(spark.createDataFrame([(0, texts()[-1])], "i int, t string"), "i", "t").first()
    assert (r.n_words, r.n_repeat_words) == (9000, 9000)


def test_verdict_does_not_depend_on_the_order(spark):
    plain = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(100))
    rows = [(0, plain), (1, plain.upper()), (2, plain.replace(" ", "## ")), (3, "x. " * 50), (4, "1 2 3 " * 2), (5, None)]
    df = spark.createDataFrame(rows, "i int, t string")
    measures = [(r, i + 1.0, 1 / (i + 1)) for i, r in enumerate(quality.RULES)]
    stats = quality.statistics(df, "i", "t")
    for order in (quality.ordered(measures), quality.ordered(measures)[::-1]):
        got = {r.id: (r.base_failed, r.kept) for r in quality.cascade(stats, order).collect()}
        assert got == {0: (False, True), 1: (False, False), 2: (False, False), 3: (True, False), 4: (True, False), 5: (True, False)}


def test_rules_by_rejection_per_cost():
    a, b, c = (quality.Rule(n, "true") for n in "abc")
    assert quality.ordered([(a, 2.0, 0.5), (b, 0.1, 0.1), (c, 1.0, 0.0)]) == [b, a, c]


@pytest.mark.parametrize("rows", [[], [(1, "some words", "clash", 1)]])
def test_empty_table_and_clashing_names(spark, rows):
    df = spark.createDataFrame(rows, "n_words int, text string, words string, id int")
    got = quality.apply_rules(df, "n_words", "text").collect()
    assert [(r.id, r.n_words, r.kept) for r in got] == [(1, 2, False)][: len(rows)]
