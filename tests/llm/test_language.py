import random
import zlib

import numpy as np

from tidemark.llm import language, queries

WORDS = {
    "en": "the and that with from this have which their would about there other people water".split(),
    "de": "der und nicht sich auch nach werden einer durch können über diese haben zeit größe".split(),
    "el": "και του της από για που δεν είναι μια στην αυτό όταν".split(),
}


def rows(n, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        text = " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(6, 40)))
        out.append((i, text.title() if i % 7 == 0 else text, lang))
    return out


def test_held_out_accuracy_and_edge_cases(spark):
    docs = spark.createDataFrame([(*r, "clash", 3) for r in rows(300, 1)], "doc_id int, text string, lang string, score string, n int")
    profiles = language.learn(docs, "text", "lang", dimensions=512)
    assert profiles.languages == ("de", "el", "en")
    assert np.allclose(np.linalg.norm(profiles.vectors, axis=1), 1, atol=1e-5)
    other = rows(200, 2)
    extra = [(900, None, None), (901, "", None), (902, "123 !?", None), (903, "the " * 100_000, "en"), (904, "the", "en"), (904, "the", "en"), (905, "ありがとう", None)]
    held = spark.createDataFrame(other + extra, "doc_id int, text string, lang string")
    got = language.predict(held, "text", profiles, slice_bytes=2000).collect()
    assert [r.lang_pred for r in got[:200]] == [r.lang for r in got[:200]]
    assert [(r.lang_pred, r.score) for r in got[200:203]] == [("und", 0.0)] * 3
    assert [r.lang_pred for r in got[203:206]] == ["en"] * 3 and got[204] == got[205]
    assert got[206].lang_pred in profiles.languages and got[206].score < 0.3
    assert all(0 <= r.score <= 1 for r in got)
    assert language.predict(docs, "text", profiles).columns == ["doc_id", "text", "lang", "n", "lang_pred", "score"]


def test_learning_does_not_depend_on_partitions(spark):
    docs = spark.createDataFrame(rows(80, 3), "doc_id int, text string, lang string")
    a = language.learn(docs.coalesce(1), "text", "lang", dimensions=128)
    b = language.learn(docs.repartition(7), "text", "lang", dimensions=128, slice_bytes=100)
    assert a.languages == b.languages and np.allclose(a.vectors, b.vectors, atol=1e-4)


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id int, text string, lang string")
    profiles = language.learn(docs, "text", "lang")
    assert profiles.languages == ()
    assert [(r.lang_pred, r.score) for r in language.predict(docs, "text", profiles).collect()] == [("und", 0.0)] * 2
    assert language.predict(docs.filter("doc_id > 5"), "text", profiles).count() == 0


def test_vectors_follow_the_definition():
    bundler = language.Bundler(64, 7)
    want = np.zeros(64)
    text = [0, ord("a"), ord("b"), ord("a"), 0, ord("é"), 0]
    for x, y, z in zip(text, text[1:], text[2:]):
        if y:
            v = [language.letter_vector(c, 64, 7) for c in (x, y, z)]
            want += np.roll(v[0], 2).astype(int) * np.roll(v[1], 1) * v[2]
    got = bundler.bundle(["x", "  AbA, 12 é!", "", "abab"])
    assert np.allclose(got[1], want / np.linalg.norm(want), atol=1e-5)
    assert not got[2].any() and np.allclose(bundler.bundle(["abab"])[0], got[3], atol=1e-6)


def test_query_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op7_language_id(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in docs[r.doc_id].text or "")) for r in rows)
    held = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out and r.lang_pred != "und" and docs[r.doc_id].lang]
    assert len(held) > 100 and sum(held) >= 0.98 * len(held)
