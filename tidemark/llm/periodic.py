"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and a length of at
least ``max(least_words, repeats * q)`` that no neighbouring word extends keeping the period.

Every scale w looks for periods from two thirds of w to w. Groups of w words are named exactly (by doubling:
a group's name is the pair of the names of its two halves), and of every w neighbouring groups the one whose
mixed name is smallest is a minimizer. Inside a run of four periods, a window of w >= q groups sees every
phase, so the same phase is smallest again and again, at distance q: a group of w >= q words does not recur
at less. Pairs of equal neighbouring minimizers up to w apart are the seeds; a seed's lag is followed to
both sides, word by word, to the run's ends. A lag that is a multiple of the smallest period gives the same
ends and the smallest lag counts. Periods below the first scale are found by comparing every word with
the one that many places later. No step is a guess: what is returned are all runs.

Many documents are searched as one sequence with a word of its own between any two, so no run crosses a
border; a scale leaves out the documents that are too short for it.

Null or no words: no run, and nothing is left. A null among the words is a word like any other, equal to other
nulls and left out of the text that is returned. Repeated rows are rows of their own. An empty table gives an
empty result. The columns ``runs`` and ``collapsed`` are added; a column of these names that the input has is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches

RUN = "struct<start: bigint, length: bigint, period: bigint>"
#: Periods up to this are compared directly.
SHORT = 4
#: Words searched as one sequence; a longer document is a sequence of its own.
SEQUENCE_WORDS = 1 << 20


def _mixed(names: np.ndarray, bits: int) -> np.ndarray:
    """The names in an order that has nothing to do with the text; of ``bits`` bits, different names stay different."""
    mask = np.uint64((1 << bits) - 1)
    x = names.astype(np.uint64)
    for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x * np.uint64(factor)) & mask
        x = x ^ (x >> np.uint64(bits // 2))
    return x


def _window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """The smallest value of every ``width`` neighbours: minima up to and from the borders of blocks of that width."""
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    table = padded.reshape(blocks, width)
    upto = np.minimum.accumulate(table, axis=1).ravel()
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return np.minimum(after[:n], upto[width - 1 : width - 1 + n])


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0]))))
    return edges[::2], edges[1::2]


def _follow(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """Ends of the widest stretch around ``at`` in which words ``lag`` apart are identical."""
    begin, step = at, 64
    while begin > 0:
        low = max(0, begin - step)
        other = np.flatnonzero(words[low:begin] != words[low + lag : begin + lag])
        if len(other):
            begin = low + int(other[-1]) + 1
            break
        begin, step = low, step * 2
    end, step, last = at + lag, 64, len(words)
    while end < last:
        high = min(last, end + step)
        other = np.flatnonzero(words[end:high] != words[end - lag : high - lag])
        if len(other):
            end += int(other[0])
            break
        end, step = high, step * 2
    return begin, end


def scales(longest: int) -> Iterator[tuple[int, int]]:
    """``(below, w)``: scale w is for the periods above ``below``, up to w, until ``longest`` is covered."""
    below = SHORT
    while below < longest:
        w = (3 * (below + 1)) // 2
        yield below, w
        below = w


def _seeds(pairs: np.ndarray, below: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and lags of neighbouring equal minimizers; ``pairs`` tells the groups of w words apart."""
    n = len(pairs)
    if n < w:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    bits = n.bit_length()
    place_bits, mask = np.uint64(bits), np.uint64((1 << bits) - 1)
    # Order first, then place: the smallest of a window is the first of its smallest groups.
    keys = (_mixed(pd.factorize(pairs)[0], 64 - bits) << place_bits) | np.arange(n, dtype=np.uint64)
    least = _window_minima(keys, w)
    marks = np.sort(least[np.concatenate(([True], least[1:] != least[:-1]))])
    values, places = marks >> place_bits, (marks & mask).astype(np.int64)
    lag = places[1:] - places[:-1]
    good = (values[1:] == values[:-1]) & (lag > below) & (lag <= w)
    return places[:-1][good], lag[good]


def runs_of(words: np.ndarray, begins: np.ndarray, repeats: int = 4, least_words: int = 6) -> np.ndarray:
    """All runs of the documents in ``words``: rows of (start, end, period), places in ``words``.

    ``words`` are numbers from 0; before each place of ``begins`` (and behind the last word) stands a number
    that occurs once.
    """
    if len(words) == 0:
        return np.empty((0, 3), np.int64)
    found: list[np.ndarray] = []
    for lag in range(1, min(SHORT, len(words) - 1) + 1):
        low, high = _stretches(words[:-lag] == words[lag:])
        high = high + lag
        long = high - low >= max(least_words, repeats * lag)
        found.append(np.stack([low[long], high[long], np.full(long.sum(), lag)], 1))
    sizes = np.diff(np.append(begins, len(words) + 1)) - 1
    place = np.arange(len(words))
    name, half, most = words.astype(np.int64), 1, len(words) + 1
    for below, w in scales(int(sizes.max(initial=0)) // repeats):
        # Only documents that can hold so long a run stay; their sequence keeps the words between them.
        stay = sizes >= repeats * (below + 1)
        if not stay.any():
            break
        if not stay.all():
            keep = np.repeat(stay, sizes + 1)[: len(words)]
            words, place, name = words[keep], place[keep], name[keep]
            begins = np.concatenate(([0], np.cumsum(sizes[stay] + 1)[:-1]))
            sizes = sizes[stay]
        while 2 * half <= w and len(name) > half:
            pairs = name[:-half] * most + name[half:]
            codes = pd.factorize(pairs)[0]
            # The last groups are cut short by the end of the sequence: each a name of its own.
            tail = np.arange(len(codes), len(codes) + half)
            name, half = np.concatenate([codes, tail]), 2 * half
        if 2 * half <= w:
            break
        n = max(0, len(words) - w + 1)
        seeds, lags = _seeds(name[:n] * most + name[w - half : w - half + n], below, w)
        by = np.lexsort((seeds, lags))
        last_lag, last_end = 0, -1
        for at, lag in zip(seeds[by].tolist(), lags[by].tolist(), strict=True):
            if lag == last_lag and at + lag <= last_end:
                continue
            low, high = _follow(words, at, lag)
            last_lag, last_end = lag, high
            if high - low >= max(least_words, repeats * lag):
                found.append(np.array([[place[low], place[high - 1] + 1, lag]], np.int64))
    rows = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1)  # of the same ends, the smallest lag
    return rows[first]


def _searched(lists: pa.ListArray, repeats: int, least_words: int) -> tuple[pa.Array, pa.Array]:
    """Runs and what is left of every list of words."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    codes = values.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n, docs = len(codes), len(sizes)
    # One place more behind every document, for the word that occurs once.
    begins = offsets[:-1] + np.arange(docs)
    words = np.empty(n + docs, np.int64)
    ends = begins + sizes
    real = np.ones(n + docs, bool)
    real[ends] = False
    words[real] = codes
    names = pd.factorize(np.concatenate([codes, [0]]))[0].max(initial=0) + 1
    words[ends] = names + np.arange(docs)
    rows = runs_of(words[:-1] if docs else words, begins, repeats, least_words)
    doc = np.searchsorted(begins, rows[:, 0], "right") - 1
    start, length = rows[:, 0] - begins[doc], rows[:, 1] - rows[:, 0]
    by = np.lexsort((rows[:, 2], start, doc))
    doc, start, length, period = doc[by], start[by], length[by], rows[by, 2]
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    items = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], fields=list(kind))
    per_doc = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=docs)))).astype(np.int32)
    runs = pa.ListArray.from_arrays(pa.array(per_doc), items)
    # A word goes if a run contains it behind the run's first period: +1 and -1 at the ends, summed up.
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, offsets[doc] + start + period, 1)
    np.add.at(depth, offsets[doc] + start + length, -1)
    stay = (np.cumsum(depth)[:n] == 0) & pc.is_valid(values).to_numpy(zero_copy_only=False)
    left = np.concatenate(([0], np.cumsum(stay)))[offsets].astype(np.int32)
    kept = pa.ListArray.from_arrays(pa.array(left), values.filter(pa.array(stay)))
    return runs, pc.binary_join(kept, " ")


def collapse_runs(df: DataFrame, words: str, repeats: int = 4, least_words: int = 6) -> DataFrame:
    """``df`` without ``words``, with ``runs`` (by start, then period) and ``collapsed``, the text with one period of every run.

    ``words`` is a column of lists of words. Documents are searched where they are, without a shuffle. ``repeats``
    must be four at least, as the scales need that many periods to see two equal minimizers.
    """
    if repeats < 4:
        raise ValueError("runs of less than four periods are not sure to be found")
    rest = [c for c in df.columns if c not in (words, "runs", "collapsed")]
    rows = df.select(*rest, F.coalesce(words, F.array().cast("array<string>")).alias("_words"))
    out = rows.drop("_words")
    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema), f"runs array<{RUN}>", "collapsed string"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("_words")).to_numpy(zero_copy_only=False)
            part = np.cumsum(sizes) // SEQUENCE_WORDS
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows] if batch.num_rows else []
            for low, high in zip(cuts, cuts[1:], strict=False):
                piece = batch.slice(low, high - low)
                runs, left = _searched(piece.column("_words"), repeats, least_words)
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(c) for c in rest), runs, left], names=[*rest, "runs", "collapsed"]
                )

    return bounded_batches(rows).mapInArrow(search, fields)
