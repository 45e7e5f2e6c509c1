import random
import zlib

import numpy as np

from tidemark.llm import queries, toxicity

FILLER = "the of and to in is was for on that with as at by from this have or had not but".split()


def documents(n, seed, words=("idiot", "moron", "scum")):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = [rng.choice(FILLER) + rng.choice(["", "", "s", "ing"]) for _ in range(rng.randint(20, 90))]
        toxic = i % 5 == 0
        for _ in range(rng.randint(2, 4) if toxic else 0):
            text.insert(rng.randrange(len(text)), rng.choice(words) + rng.choice(["", "###", ",", "!!"]))
        out.append((i, " ".join(text).upper() if i % 11 == 0 else " ".join(text), int(toxic)))
    return out


def test_held_out_documents(spark):
    rows = documents(1500, 1)
    docs = spark.createDataFrame([(i, t, "x", 9) for i, t, _ in rows], "doc_id bigint, text string, score string, predicted int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 3], "doc_id bigint, toxic int")
    machine = toxicity.fit(docs, "doc_id", "text", labels.union(labels.limit(5)), "doc_id", "toxic")
    got = {r.doc_id: r for r in toxicity.score(docs, "text", machine).collect()}
    held = [(got[i].predicted, y) for i, _, y in rows if i % 3 == 0]
    assert np.mean([p == y for p, y in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    again = toxicity.fit(docs.repartition(7), "doc_id", "text", labels, "doc_id", "toxic")
    assert np.array_equal(again.terms, machine.terms) and np.allclose(again.weights, machine.weights, atol=1e-4)


def test_a_pair_counts_where_single_terms_do_not():
    rng = np.random.default_rng(2)
    rows = (rng.random((4000, 6)) < 0.5).astype(np.float32)
    labels = ((rows[:, 0] + rows[:, 1]) == 1).astype(float)  # either, but not both: no linear weights do this
    bias, weights, factors = toxicity.fit_machine(rows, labels)
    machine = toxicity.Machine(np.arange(6), bias, weights, factors)
    assert ((machine.scores(rows) > 0.5) == (labels > 0)).mean() > 0.98


def test_terms_are_words_and_stems():
    def terms(text):
        return set(toxicity.terms_of([text])[0].tolist())

    assert terms("Idiot##") == terms("idiot") and terms("") == set()
    assert len(terms("idiot") & terms("idiotic")) == 3  # idi, idio, idiot as beginnings
    found, owner = toxicity.terms_of(["a b", "", "c"])
    assert owner.tolist() == [0, 0, 2] and len(set(found.tolist())) == 3


def test_nulls_empty_tables_and_one_label(spark):
    docs = spark.createDataFrame([(1, None), (None, "a b"), (2, ""), (3, "idiot " * 5000), (3, "idiot " * 5000)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    one = spark.createDataFrame([(1, 1), (3, 1), (None, 0), (2, None)], "doc_id bigint, toxic int")
    for labels in (none, one):
        machine = toxicity.fit(docs, "doc_id", "text", labels, "doc_id", "toxic")
        assert [r.score for r in toxicity.score(docs, "text", machine).collect()] == [0.0] * 5
    assert toxicity.score(docs.filter("doc_id > 9"), "text", machine).count() == 0
    both = spark.createDataFrame([(i, t) for i, t, _ in documents(60, 3)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in documents(60, 3)], "doc_id bigint, toxic int")
    machine = toxicity.fit(both, "doc_id", "text", labels, "doc_id", "toxic")
    scores = [r.score for r in toxicity.score(docs, "text", machine).collect()]
    assert scores[0] == scores[2] < 0.5 < scores[3] == scores[4]


def test_query_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.1"  # of sf0.01 only 18 toxic documents are held out
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r.toxic is not None}
    ids = [r.doc_id for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").collect()]
    rows = queries.op4_toxicity(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    hits, found, toxic = sum(p and y for p, y in held), sum(p for p, _ in held), sum(y for _, y in held)
    assert toxic and hits >= 0.9 * toxic and hits >= 0.9 * found
