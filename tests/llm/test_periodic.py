import random
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidemark.llm import periodic, queries


def runs_by_hand(words, repeats=4, least=6):
    """All lags, word by word."""
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    x = np.array([names[w] for w in words])
    best = {}
    for q in range(1, len(x) // repeats + 1):
        same = np.concatenate(([False], x[:-q] == x[q:], [False]))
        edges = np.flatnonzero(same[1:] != same[:-1])
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - begin + q >= max(least, repeats * q):
                best.setdefault((begin, end - begin + q), q)
    return sorted((s, n, q) for (s, n), q in best.items())


def left_by_hand(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng, n, letters):
    words = [str(rng.randrange(letters)) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        begin = rng.randrange(n)
        period = rng.randint(1, max(1, (n - begin) // 3))
        for i in range(begin, rng.randint(begin, n)):
            words[i] = words[begin + (i - begin) % period]
    return words


def test_equals_all_lags():
    rng, found = random.Random(7), 0
    for _ in range(600):
        docs = [repetitive(rng, rng.randint(0, 150), rng.choice([1, 2, 3, 40])) for _ in range(rng.randint(0, 6))]
        runs, left = periodic._searched(pa.array(docs, pa.list_(pa.string())), 4, 6)
        for words, got, text in zip(docs, runs.to_pylist(), left.to_pylist(), strict=True):
            want = runs_by_hand(words)
            found += len(want)
            assert [(r["start"], r["length"], r["period"]) for r in got] == want
            assert text == left_by_hand(words, want)
    assert found > 500


@pytest.mark.parametrize("period", [1, 4, 5, 6, 7, 9, 100, 1234, 5000])
def test_long_periods(period):
    rng = random.Random(period)
    part = [str(rng.randrange(50)) for _ in range(period)]
    words = ["a", "b", *part * 6, "c", "d"]
    runs, _ = periodic._searched(pa.array([words], pa.list_(pa.string())), 4, 6)
    assert [(r["start"], r["length"], r["period"]) for r in runs.to_pylist()[0]] == runs_by_hand(words)
    assert any(r["period"] == period for r in runs.to_pylist()[0])


def test_every_scale_covers_its_periods():
    covered = set(range(1, periodic.SHORT + 1))
    for below, w in periodic.scales(3000):
        assert all(2 * w <= 3 * q for q in range(below + 1, w + 1))
        covered |= set(range(below + 1, w + 1))
    assert covered >= set(range(1, 3001))


def test_edge_rows(spark):
    rows = [(1, None, 5), (2, [], 5), (3, ["x"] * 6, 5), (3, ["x"] * 6, 5), (4, [None] * 7, None), (5, ["x"] * 5, 1)]
    df = spark.createDataFrame(rows, "id bigint, words array<string>, runs int")
    got = sorted((r.id, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.collapse_runs(df, "words").collect())
    assert got == [(1, [], ""), (2, [], ""), (3, [(0, 6, 1)], "x"), (3, [(0, 6, 1)], "x"), (4, [(0, 7, 1)], ""), (5, [], "x x x x x")]
    assert periodic.collapse_runs(df.limit(0), "words").collect() == []
    with pytest.raises(ValueError):
        periodic.collapse_runs(df, "words", repeats=3)


def test_sequences_are_cut_between_documents(spark, monkeypatch):
    docs = [(i, ["a", "b"] * (i % 7)) for i in range(50)]
    df = spark.createDataFrame(docs, "id int, words array<string>").coalesce(1)
    whole = periodic.collapse_runs(df, "words").collect()
    monkeypatch.setattr(periodic, "SEQUENCE_WORDS", 10)
    assert sorted(periodic.collapse_runs(df, "words").collect()) == sorted(whole)


def spaced(text):
    return [w for w in "".join("\n" if c in " \t\n\v\f\r" else c for c in text or "").split("\n") if w]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_all_lags(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, sf_dir).collect()}
    table = pq.read_table(f"{sf_dir}/documents.parquet").to_pydict()
    assert sorted(got) == sorted(table["doc_id"])
    planted = 0
    for doc_id, text in zip(table["doc_id"], table["text"], strict=True):
        words = spaced(text)
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [*words[:a], *(words[a + (i - a) % p] for i in range(a, n))]
            planted += 1
        runs = runs_by_hand(words)
        row = got[doc_id]
        assert row.n_runs == len(runs), doc_id
        top = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        want = (None,) * 4 if top is None else (*top, 1000 * top[1] // top[2])
        assert (row.start, row.length, row.period, row.exponent_milli) == want
        assert row.runs_sha256 == sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == sha256(left_by_hand(words, runs).encode()).hexdigest()
    assert planted > 10
