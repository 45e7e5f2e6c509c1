"""Toxicity by a factorization machine over hashed terms.

A text's terms are its lower-cased words and their beginnings (stems of several lengths), hashed into 2^22
buckets; a term that occurs again, and often, counts as further terms. The machine scores a text by a
linear weight per term and, for every pair of its terms, the product of their latent vectors, so that a
word may count only beside another.

It is fitted on a bounded sample: at most ``sample_rows`` labelled rows, those with the smallest hash of
the id. Terms are chosen there: of the ``candidates`` most frequent ones in texts of label 1, the
``terms`` that differ most between the labels. Scoring covers whole texts of all rows and is narrow.

Null and empty texts have no terms and get the score of the bias alone. Without both labels in the sample
every score is 0. Labels given twice for an id count as 1 if one of them is. Null ids and labels teach
nothing. Repeated rows give repeated results. Other columns are kept; input columns named like the result
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, parts_of, stored
from tidemark.llm.minhash import ODD, mixed

BITS = 22
STEMS = (3, 4, 5, 6, 7)  # bytes
TIMES = (1, 2, 4)  # occurrences from which a term counts once more
LETTER = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


def terms_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word and stem of the texts, and the text it belongs to."""
    raw = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"".join(t + b"\n" for t in raw), np.uint8)
    letter = LETTER[data]
    before = np.concatenate([[False], letter[:-1]])
    starts, ends = np.flatnonzero(letter & ~before), np.flatnonzero(~letter & before)
    powers = np.cumprod(np.full(len(data), ODD, np.uint64))
    back = np.cumprod(np.full(len(data), pow(int(ODD), -1, 1 << 64), np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers)])
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in raw]), starts, side="right")
    found, owners = [], []
    for size in (0, *STEMS):
        use = slice(None) if not size else ends - starts >= size
        a, o = starts[use], owner[use]
        b = ends[use] if not size else a + size
        found.append(mixed((sums[b] - sums[a]) * back[a] + np.uint64(size)) >> np.uint64(64 - BITS))
        owners.append(o)
    return np.concatenate(found).astype(np.int64), np.concatenate(owners)


@dataclass(frozen=True)
class Machine:
    terms: np.ndarray  # buckets, sorted
    bias: float
    weights: np.ndarray  # terms x TIMES
    factors: np.ndarray  # as many x latent
    learned: bool = True

    def scores(self, rows: np.ndarray) -> np.ndarray:
        if not self.learned:
            return np.zeros(len(rows))
        mixed_terms = rows @ self.factors
        pairs = 0.5 * (mixed_terms**2 - rows @ self.factors**2).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(self.bias + rows @ self.weights + pairs, -30, 30)))


class Presence:
    """Which of the chosen terms a text has, and which of them often: a column per term and number in TIMES."""

    def __init__(self, terms: np.ndarray):
        self.place = np.full(1 << BITS, -1, np.int32)
        self.place[terms] = np.arange(len(terms))
        self.size = len(terms)

    def rows(self, texts: list[str]) -> np.ndarray:
        found, owner = terms_of(texts)
        place = self.place[found]
        cells = owner[place >= 0] * self.size + place[place >= 0]
        counts = np.bincount(cells, minlength=len(texts) * self.size).reshape(len(texts), self.size)
        return np.concatenate([counts >= n for n in TIMES], axis=1).astype(np.float32)


def fit_machine(rows: np.ndarray, labels: np.ndarray, *, latent: int = 8, steps: int = 2000, batch: int = 256, rate: float = 0.1, decay: float = 1e-5, seed: int = 5) -> tuple[float, np.ndarray, np.ndarray]:
    """Bias, weights and factors by Adagrad on the logistic loss, ``steps`` batches drawn at random."""
    random = np.random.Generator(np.random.PCG64(seed))
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    bias = np.array([np.log(share / (1 - share))], np.float32)
    weights, factors = np.zeros(rows.shape[1], np.float32), random.normal(0, 0.01, (rows.shape[1], latent)).astype(np.float32)
    state = [np.full_like(p, 1e-6) for p in (bias, weights, factors)]
    for _ in range(steps):
        pick = random.integers(0, len(rows), min(batch, len(rows)))
        x, y = rows[pick].astype(np.float32), labels[pick].astype(np.float32)
        sums = x @ factors
        raw = bias[0] + x @ weights + 0.5 * (sums**2 - x @ factors**2).sum(axis=1)
        error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) / len(pick)
        slopes = (
            np.array([error.sum()]),
            x.T @ error + decay * weights,
            x.T @ (error[:, None] * sums) - (x.T @ error)[:, None] * factors + decay * factors,
        )
        for value, slope, seen in zip((bias, weights, factors), slopes, state, strict=True):
            seen += slope**2
            value -= rate * slope / np.sqrt(seen)
    return float(bias[0]), weights, factors


def fit(
    docs: DataFrame, record_id: str, text: str, labels: DataFrame, label_id: str, label: str, *, sample_rows: int = 24_000,
    candidates: int = 40_000, terms: int = 384, least: int = 5, slice_bytes: int = 1 << 20,
) -> Machine:
    """The machine, from rows of ``docs`` that ``labels`` marks with 0 or 1. The sample's bound is ``sample_rows``."""
    marks = (
        labels.select(F.col(label_id).cast("long").alias("id"), F.col(label).cast("int").alias("label"))
        .dropna()
        .groupBy("id")
        .agg((F.max("label") > 0).cast("int").alias("label"))
    )
    # The bound proves the size of what is broadcast: 12 bytes a row.
    marks = marks.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = bounded_batches(docs).select(F.col(record_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sample = stored(rows.join(F.broadcast(marks), "id").select("text", "label"), "labelled")

    def positive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, "text", slice_bytes):
            found, owner = terms_of(batch.column(0).to_pylist())
            pairs = np.unique(owner * (1 << BITS) + found)
            term, n = np.unique(pairs & ((1 << BITS) - 1), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(n, pa.int64())], names=["term", "n"])

    frequent = (
        sample.filter("label = 1").select("text").mapInArrow(positive, "term bigint, n bigint")
        .groupBy("term").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
        .orderBy(F.desc("n"), "term").limit(candidates).collect()
    )
    nothing = Machine(np.zeros(0, np.int64), 0.0, np.zeros(0), np.zeros((0, 1)), learned=False)
    pool = np.array(sorted(r.term for r in frequent), np.int64)
    if not len(pool):
        return nothing

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << BITS, -1, np.int32)
        place[pool] = np.arange(len(pool))
        totals, rows = np.zeros((2, len(pool)), np.int64), np.zeros(2, np.int64)
        for batch in parts_of(batches, "text", slice_bytes):
            found, owner = terms_of(batch.column(0).to_pylist())
            at = place[found]
            pairs = np.unique(owner[at >= 0] * len(pool) + at[at >= 0])
            marks = np.array(batch.column(1).to_pylist())
            rows += np.bincount(marks, minlength=2)
            for mark in (0, 1):
                totals[mark] += np.bincount(pairs[marks[pairs // len(pool)] == mark] % len(pool), minlength=len(pool))
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array(rows, pa.int64()), pa.array(totals.tolist(), pa.list_(pa.int64()))],
            names=["label", "rows", "totals"],
        )

    # One row per label and task, each as long as the pool: bounded by ``candidates``.
    spread = sample.mapInArrow(counted, "label int, rows bigint, totals array<bigint>")
    sums = spread.select("label", "rows", F.posexplode("totals")).groupBy("label", "pos").agg(F.sum("col").alias("n"), F.sum("rows").alias("rows"))
    totals, sizes = np.zeros((2, len(pool))), np.zeros(2)
    for r in sums.collect():
        totals[r.label, r.pos], sizes[r.label] = r.n, r.rows
    if not sizes.all():
        return nothing
    # Chi-square of the term against the label.
    n, have, of = sizes.sum(), totals.sum(axis=0), sizes[1]
    cross = totals[1] * (n - have - of + totals[1]) - (have - totals[1]) * (of - totals[1])
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = np.nan_to_num(n * cross**2 / (have * (n - have) * of * (n - of)))
    chosen = np.sort(pool[np.argsort(-chi, kind="stable")[:terms]])

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence(chosen)
        for batch in parts_of(batches, "text", slice_bytes):
            bits = np.packbits(presence.rows(batch.column(0).to_pylist()) > 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.tobytes() for b in bits], pa.binary()), batch.column(1)], names=["bits", "label"]
            )

    data = sample.mapInArrow(present, "bits binary, label int").collect()
    data = sorted((bytes(r.bits), r.label) for r in data)  # the fit does not depend on the order of tasks
    rows = np.unpackbits(np.frombuffer(b"".join(bits for bits, _ in data), np.uint8).reshape(len(data), -1), axis=1)
    bias, weights, factors = fit_machine(rows[:, : len(chosen) * len(TIMES)], np.array([label for _, label in data], float))
    return Machine(chosen, bias, weights, factors)


def score(df: DataFrame, text: str, machine: Machine, *, threshold: float = 0.7, slice_bytes: int = 1 << 20) -> DataFrame:
    """``df`` with ``score`` from 0 to 1 and ``predicted``, 1 from the threshold on."""
    new = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    kept = [f for f in df.schema.fields if f.name not in {"score", "predicted"}]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presence = Presence(machine.terms)
        for batch in parts_of(batches, text, slice_bytes):
            texts = [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            scores = np.round(machine.scores(presence.rows(texts)), 6)
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            columns += [pa.array(scores, pa.float64()), pa.array(scores >= threshold, pa.bool_()).cast(pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in [*kept, *new]])

    return bounded_batches(df).mapInArrow(run, T.StructType([*kept, *new]))
