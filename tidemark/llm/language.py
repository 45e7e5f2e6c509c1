"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A three-letter group of a
marked word is bound by multiplying its letters' vectors, each rotated by its place; a text is the bundle
(sum) of its groups, and a language the bundle of its texts' unit vectors. A text gets the language whose
profile is nearest by cosine; equal cosines go to the first language by name.

Learning adds whole numbers, so its result does not depend on the order of rows or tasks. Only the
profiles, languages x dimensions, reach the driver.

Null text, and text without a letter, gets ``und`` and score 0; so does every text if nothing was learned.
Letters that no profile has seen only lower the score. Repeated rows give repeated results. Other columns
are kept; input columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, parts_of, texts_of

UNKNOWN = "und"
UNIT = 1 << 20  # length of a learned text's vector, in whole numbers


@dataclass(frozen=True)
class Profiles:
    languages: tuple[str, ...]
    vectors: np.ndarray  # languages x dimensions, of unit length
    seed: int


def letter_vector(code: int, dimensions: int, seed: int) -> np.ndarray:
    bits = np.random.Generator(np.random.PCG64([seed, code])).integers(0, 2, dimensions, dtype=np.int8)
    return bits * 2 - 1


class Bundler:
    """Vectors of texts; letters' vectors are drawn when a letter is first seen."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.letters: dict[int, np.ndarray] = {0: letter_vector(0, dimensions, seed)}

    def vector(self, code: int) -> np.ndarray:
        if code not in self.letters:
            self.letters[code] = letter_vector(code, self.dimensions, self.seed)
        return self.letters[code]

    def bundle(self, texts: list[str]) -> np.ndarray:
        """Texts x dimensions, of unit length; zeros for a text without letters."""
        codes = np.frombuffer("".join(f"\n{t}" for t in [*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(len(texts) + 1, dtype=np.int32), [*(len(t) + 1 for t in texts), 1])
        out = np.zeros((len(texts), self.dimensions), np.float32)
        seen = np.flatnonzero(np.bincount(codes))
        lower = [ord(chr(c).lower()[0]) if chr(c).isalpha() else 0 for c in seen]
        alphabet = sorted({0, *lower})
        place = np.zeros(int(seen[-1]) + 1, np.int64)
        place[seen] = np.searchsorted(alphabet, lower)
        letters = place[codes]
        keep = letters != 0
        keep[1:] |= letters[:-1] != 0  # of a run of other characters the first stays, as the word's mark
        keep[0] = True
        letters, owner = letters[keep], owner[keep]
        n = len(alphabet)
        good = letters[1:-1] != 0  # a mark stands between any two texts
        groups = ((letters[:-2] * n + letters[1:-1]) * n + letters[2:])[good]
        owner = owner[1:-1][good]
        if not len(groups):
            return out
        if n**3 <= 1 << 22:
            distinct = np.flatnonzero(np.bincount(groups))
            number = np.zeros(int(distinct[-1]) + 1, np.int64)
            number[distinct] = np.arange(len(distinct))
            groups = number[groups]
        else:
            distinct, groups = np.unique(groups, return_inverse=True)
        vectors = np.stack([self.vector(c) for c in alphabet])
        first, second = np.roll(vectors, 2, axis=1), np.roll(vectors, 1, axis=1)
        for begin in range(0, len(distinct), 8192):
            own = distinct[begin : begin + 8192]
            bound = (first[own // (n * n)] * second[own // n % n] * vectors[own % n]).astype(np.float32)
            inside = (groups >= begin) & (groups < begin + len(own))
            cells = owner[inside].astype(np.int64) * len(own) + (groups[inside] - begin)
            counts = np.bincount(cells, minlength=len(texts) * len(own)).reshape(len(texts), len(own))
            out += counts.astype(np.float32) @ bound
        lengths = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, lengths, out=out, where=lengths > 0)


def learn(
    df: DataFrame, text: str, language: str, *, dimensions: int = 1024, seed: int = 7, slice_bytes: int = 1 << 20
) -> Profiles:
    """The profiles of all languages, from every row with text and language.

    A task adds up its rows; what is shuffled are one vector per task and language.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler, sums = Bundler(dimensions, seed), {}
        for batch in parts_of(batches, "text", slice_bytes):
            vectors = np.rint(bundler.bundle(texts_of(batch, "text")) * UNIT).astype(np.int64)
            names = np.array(batch.column(1).to_pylist(), dtype=object)
            for name in dict.fromkeys(names):
                sums[name] = sums.get(name, 0) + vectors[names == name].sum(axis=0)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))],
                names=["language", "vector"],
            )

    rows = (
        bounded_batches(df)
        .select(F.col(text).alias("text"), F.col(language).cast("string").alias("language"))
        .dropna()
        .mapInArrow(run, "language string, vector array<bigint>")
        .select("language", F.posexplode("vector"))
        .groupBy("language", "pos")
        .agg(F.sum("col").alias("whole"))
        .groupBy("language")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "whole"))).alias("cells"))
        .collect()
    )
    names, vectors = [], []
    for row in sorted(rows, key=lambda r: r.language):
        vector = np.array([float(c.whole) for c in row.cells])
        if length := np.linalg.norm(vector):
            names.append(row.language)
            vectors.append(vector / length)
    return Profiles(tuple(names), np.array(vectors).reshape(len(names), dimensions).astype(np.float32), seed)


def predict(df: DataFrame, text: str, profiles: Profiles, *, slice_bytes: int = 1 << 20) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``, the cosine to the nearest profile, from 0 to 1."""
    new = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    kept = [f for f in df.schema.fields if f.name not in {"lang_pred", "score"}]
    names, vectors, seed = profiles.languages, profiles.vectors, profiles.seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler = Bundler(vectors.shape[1], seed)
        for batch in parts_of(batches, text, slice_bytes):
            own = bundler.bundle(texts_of(batch, text))
            known = own.any(axis=1) if names else np.zeros(len(own), bool)
            cosines = own @ vectors.T if names else np.zeros((len(own), 1))
            best = np.round(cosines, 5).argmax(axis=1)
            score = np.where(known, np.round(np.clip(cosines.max(axis=1).astype(float), 0, 1), 5), 0.0)
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            columns.append(pa.array([names[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)], pa.string()))
            columns.append(pa.array(score, pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in [*kept, *new]])

    return bounded_batches(df).mapInArrow(run, T.StructType([*kept, *new]))
