"""SentencePiece encoding and decoding by a table of distinct marked words.

In a model whose pieces hold the white space marker only at their start, no merge crosses the border
between a word and the marker behind it. A text is therefore cut into chunks of markers and the word
that follows; each distinct chunk is segmented once by the library, and a text's ids are the chunks'
ids joined back by position. The result equals the library's on the whole text.

The table of distinct chunks belongs to a task and is emptied beyond ``table_chunks`` entries: texts
are not shuffled, memory is bounded, and a task that is run again needs nothing but its input.

Null text is read as empty and has no ids. Repeated rows give repeated results. An empty table gives an
empty result. Other columns are kept; input columns named like the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, parts_of, texts_of

MARK = "▁"
CHUNK = f"{MARK}*[^{MARK}]+|{MARK}+"


class ChunkTable:
    """Ids of distinct marked words, in one flat array."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], mark_id: int, most: int):
        self.encode, self.mark_id, self.most = encode, mark_id, most
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def add(self, chunks: set[str]) -> None:
        new = [c for c in chunks if c not in self.places]
        if not new:
            return
        # The library puts a marker before every text; an empty text has none and so no ids.
        ids = [x if c != MARK else [self.mark_id] for c, x in zip(new, self.encode([c[1:] for c in new]), strict=True)]
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new)), strict=True))
        self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), np.int32)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum([len(x) for x in ids])])

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and where each text's ids begin and end."""
        if len(self.places) > self.most:
            self.clear()
        cut = re.compile(CHUNK).findall
        chunks = [cut(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self.add(set().union(*chunks))
        places = self.places
        at = np.fromiter((places[c] for words in chunks for c in words), np.int64, sum(map(len, chunks)))
        sizes = np.diff(self.starts)[at]
        ends = np.cumsum(sizes)
        flat = self.flat[np.arange(sizes.sum()) + np.repeat(self.starts[at] - (ends - sizes), sizes)]
        words = np.cumsum([0, *map(len, chunks)])
        return flat, np.concatenate([[0], ends])[words]


def encode(
    df: DataFrame, text: str, model: str, *, decode: bool = False, table_chunks: int = 150_000, slice_bytes: int = 1 << 20
) -> DataFrame:
    """``df`` with ``ids`` (array of int) and, if asked for, ``decoded``: the library's ``decode(ids)``.

    ``model`` is the model file's path on every machine. No begin or end ids, no sampling.
    """
    new = [T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    new += [T.StructField("decoded", T.StringType())] * decode
    kept = [f for f in df.schema.fields if f.name not in {"ids", "decoded"}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=model)
        crossing = [p for p in map(library.id_to_piece, range(library.get_piece_size())) if re.search(f"[^{MARK}]{MARK}", p)]
        if crossing:
            raise ValueError(f"pieces of this model cross white space: {crossing[:3]}")
        table = ChunkTable(
            lambda words: library.encode(words, num_threads=1), library.piece_to_id(MARK), table_chunks
        )
        for batch in parts_of(batches, text, slice_bytes):
            flat, ends = table.ids(texts_of(batch, text))
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())))
            if decode:
                lists = [flat[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                columns.append(pa.array(library.decode(lists, num_threads=1) if lists else [], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in [*kept, *new]])

    return bounded_batches(df).mapInArrow(run, T.StructType([*kept, *new]))


def digests(encoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """One row per row of ``encode(..., decode=True)``: the number of ids and hashes of ids and decoded text."""
    return encoded.select(
        id_column,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
