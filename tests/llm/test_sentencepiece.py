import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from tidemark.llm import sentencepiece as op

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=MODEL)
TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "  a  b   ", "\n", " \n ", "▁", "a▁b ▁", "é漢字🙂 ok", "<s> </s> <unk> <0x0A>", "\x00x", "x" * 3000,
    "tab\tand\r\nline", " nbsp", "é", "Hello, world! 3.14", "many words " * 20_000, "﻿bom", " " * 5000,
]


def table(most=10**6):
    return op.ChunkTable(lambda words: LIBRARY.encode(words), LIBRARY.piece_to_id(op.MARK), most)


def test_equals_the_library(spark):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("ab é▁ \n漢") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(texts)], "doc_id int, text string, ids string, n_tokens int")
    for size in (1, 10**6):
        got = op.encode(df, "text", MODEL, decode=True, table_chunks=size, slice_bytes=5000).collect()
        for r in got:
            ids = LIBRARY.encode(texts[r.doc_id] or "")
            assert list(r.ids) == ids and r.decoded == LIBRARY.decode(ids)
    assert op.encode(df, "text", MODEL).columns == ["doc_id", "text", "n_tokens", "ids"]


def test_digests_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], "doc_id int, text string")
    got = op.digests(op.encode(df, "text", MODEL, decode=True)).collect()
    ids = LIBRARY.encode("a b")
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    row = (1, len(ids), sha(",".join(map(str, ids))), sha("a b"))
    assert [tuple(r) for r in got] == [row, row, (2, 0, sha(""), sha(""))]
    assert op.encode(df.filter("doc_id > 5"), "text", MODEL).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=30) | st.text("ab ▁é", max_size=20), max_size=4))
def test_any_text(texts):
    flat, ends = table().ids(texts)
    assert [flat[a:b].tolist() for a, b in zip(ends, ends[1:])] == [LIBRARY.encode(t) for t in texts]


def test_each_distinct_chunk_is_segmented_once():
    seen = []
    chunks = op.ChunkTable(lambda words: seen.extend(words) or LIBRARY.encode(words), LIBRARY.piece_to_id(op.MARK), 10**6)
    chunks.ids(["the cat the cat", "cat the"])
    chunks.ids(["the dog"])
    assert sorted(seen) == ["cat", "dog", "the"]


@pytest.mark.parametrize("text", TEXTS[1:])
def test_chunks_hold_the_whole_text(text):
    import re

    marked = op.MARK + text.replace(" ", op.MARK)
    assert "".join(re.findall(op.CHUNK, marked)) == marked
