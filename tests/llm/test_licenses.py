import itertools
import random

import pytest

from tidemark.llm import licenses, queries

MIT = next(t for n, t in licenses.TEMPLATES if n == "MIT" and len(t) > 100)


def longest_rising(places):
    return max((len(c) for k in range(len(places) + 1) for c in itertools.combinations(places, k) if list(c) == sorted(c)), default=0)


def test_patience_run_is_longest():
    rng = random.Random(1)
    for _ in range(200):
        places = rng.sample(range(20), rng.randint(0, 9))
        run = [places[i] for i in licenses._rising(places)]
        assert run == sorted(run) and len(run) == longest_rising(places)


def test_alignment_is_rising_and_equal():
    rng = random.Random(2)
    template = licenses.words_of(MIT)
    for _ in range(30):
        text = [w for w in template if rng.random() > 0.1]
        for _ in range(8):
            text.insert(rng.randrange(len(text)), rng.choice(["x", "the", "software"]))
        pairs = licenses.align(text, template)
        assert all(text[i] == template[j] for i, j in pairs)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
        assert len(pairs) > 0.8 * len(template)


def found(text):
    return [(n[0], n[1]) for n in licenses.Scanner(licenses.TEMPLATES, 0.8).scan(text)]


@pytest.mark.parametrize("name, text", licenses.TEMPLATES)
def test_every_template_is_found_whole(name, text):
    noise = "Some words before.\nAnd more of the same license talk. "
    assert (name, 1.0) in found(noise + text.upper().replace(" ", "\n * ") + " and after")


def test_counts_gaps_and_clean_texts():
    line = "Released under the MIT License."
    assert found(f"{line}\ntext\n{line} {line}") == [("MIT", 1.0)] * 3
    part = MIT.replace("free of charge, ", "").replace("merge, ", "")
    assert [n for n, c in found(part) if 0.9 < c < 1] == ["MIT"]
    assert found("A license to write about any software, MIT and Apache and the public.") == []
    assert found(" ".join(MIT.split()[:20])) == []


@pytest.mark.parametrize(
    "line, names",
    [
        ("Released under the BSD License.", ["BSD"]),
        ("Released under the Apache License.", ["Apache"]),
        ("Released under the Foo License.", []),
        ("Released under the MIT-0 License.", ["MIT-0"]),
        ("Permitted by the MIT-0 License.", []),
        ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA-4.0"]),
        ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0"]),
        ("Licensed under CC BY-NC 3.0.", []),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]),
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
        ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
        ("This work is licensed under the GNU Library General Public License, version 2.", []),
        ("Licensed under the Apache License, Version 1.1.", ["Apache"]),
        ("Licensed under the Apache License 2.0.", ["Apache-2.0"]),
        ("(c) 2020 A. B. All rights reserved.", ["All rights reserved"]),
    ],
)
def test_licences_keep_their_names(line, names):
    assert [n for n, _ in found(f"Some words before. {line} And some after.")] == names


def test_any_missing_fifth_of_the_words_is_found():
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    scanner = licenses.Scanner((("Greek", " ".join(words)),), 0.8)
    for gone in itertools.combinations(range(20), 4):
        assert scanner.scan(" ".join(w for i, w in enumerate(words) if i not in gone))


def test_rows(spark):
    line = "Licensed under CC BY-NC 4.0."
    rows = [(1, None, 0), (2, "", 0), (3, "word " * 200_000 + line, 0), (4, line, 0), (4, line, 0), (None, line, 0)]
    df = spark.createDataFrame(rows, "i int, t string, notices int")
    got = licenses.scan(df, "t").collect()
    assert [[n.license for n in r.notices] for r in got] == [[], [], *[["CC-BY-NC-4.0"]] * 4]
    assert got[2].notices[0].first_word == 200_000 and got[2].notices[0].matched == 7
    assert licenses.scan(df.filter("i > 9"), "t").count() == 0


def test_query_equals_a_scan_around_every_word(spark):
    """A scanner without chosen keys, which aligns the stretch around every word of a template."""
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.8)
    scanner.keys.clear()
    for k, (_, words) in enumerate(scanner.templates):
        for i, word in enumerate(words):
            scanner.keys[word].append((k, i))
    scanner.known = frozenset(scanner.keys)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {}
    for r in docs.collect():
        found = scanner.scan(r.text or "")
        want[r.doc_id] = (len(found), ",".join(sorted({f[0] for f in found})), max((f[1] for f in found), default=0.0))
    got = {r.doc_id: (r.n_notices, r.licenses, r.best_coverage) for r in queries.op5_license_scan(spark, "/root/testdata/sf0.001").collect()}
    assert got == want and any(n for n, _, _ in want.values())
