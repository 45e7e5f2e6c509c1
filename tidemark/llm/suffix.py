"""Exact removal of repeated passages by merged Burrows-Wheeler transforms.

Every byte goes that is covered by a string of ``length`` bytes which also starts elsewhere, in the same or
another document; strings never cross documents and are judged on the input.

Where to look. The smallest hash among the ``gram``-byte groups of a window of ``length`` bytes is its
anchor; equal windows have equal anchors at equal places, so a run of windows with one anchor is a segment,
and only segments of one anchor can share a window. Segments are rows ``(anchor, content)``: an anchor that
occurs once has no repeated window; segments with equal content are repeated throughout; what is left are
distinct segments that share an anchor, mostly at the ends of passages.

Distinct segments of an anchor meet in a bucket, where their text is read as strings over an alphabet of
``STEP``-byte symbols, one string per residue. Blocks of segments (shards) get their suffix order and
Burrows-Wheeler transform; the transforms of all shards are merged by interleave refinement: each round
goes over the merged order and pushes the shard of every suffix to the bucket of the symbol before it,
which sorts by one more symbol, until ``length`` bytes are sorted. Suffixes are never sorted again; block
borders that appear in a round give the common prefixes, blocks that last through all rounds are the
repeated intervals. Suffixes whose symbols do not all occur twice are left out beforehand.

Skew. Copies collapse by partial aggregation. An anchor with more than ``most`` distinct segments is a crowd, mostly
around a passage that very many documents share. Its segments are cut again by second anchors, the smallest of another
hash, which fall to the texts around the passage as often as to the passage: so a crowd falls into segments that are
settled by counting or meet in many buckets, and what is still crowded is cut again, ``LEVELS`` times. Windows that are
crowded even then are counted as rows, which aggregates before the shuffle.

Null text is empty. Texts shorter than ``length`` bytes have no window. Every row is a document: repeated rows repeat each
other, and rows may share an id with other texts; a row without id is known by the hash of its text. Very long texts are cut into overlapping blocks of windows. An
empty table gives an empty result. Other columns are kept; input columns named like the results are replaced.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, dropped, parts_of, stored, with_text_key
from tidemark.llm.minhash import Substrings, mixed

LEVELS = 4  # of anchors beyond the first
STEP = 25  # bytes of a symbol; a window is a whole number of symbols


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[: len(keys) - (width - size)], keys[width - size :]) if width > size else keys


def segments_of(texts: list[bytes], length: int, gram: int, level: int = 0) -> tuple[np.ndarray, ...]:
    """Text, first window, windows, anchor's hash and content's hash of all segments of the texts; levels hash differently."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    nothing = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if len(data) < length:
        return nothing
    strings = Substrings(data)
    grams = strings.hashes(slice(None, -gram), slice(gram, None))
    for k in range(level):
        grams = mixed(grams ^ np.uint64(k + 1))
    low = np.uint64((1 << max(16, len(grams).bit_length())) - 1)
    best = _smallest((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - gram + 1) & low
    anchor = best.astype(np.int64)  # of equal hashes the leftmost
    ends = np.cumsum([len(t) for t in texts])
    owner = np.searchsorted(ends, np.arange(len(anchor)), side="right")
    inside = np.arange(len(anchor)) + length <= ends[owner]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(anchor)]]) - 1
    first, last = first[inside[first]], last[inside[first]]
    if not len(first):
        return nothing
    offset = (anchor[first] - first).astype(np.uint64)
    content = mixed(strings.hashes(first, last + length) ^ mixed(offset * np.uint64(1 << 20) + (last - first).astype(np.uint64)))
    begin = np.concatenate([[0], ends[:-1]])[owner[first]]
    return owner[first], first - begin, last - first + 1, grams[anchor[first]], content


def segments(df: DataFrame, *, length: int, gram: int, slice_bytes: int) -> DataFrame:
    """``(anchor, content, id, place)`` of rows ``(id, text)``; place is the first window and the number of windows."""

    def blocks(texts: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
        for i, text in enumerate(texts):
            for at in range(0, max(1, len(text) - length + 1), slice_bytes):
                yield i, at, text[at : at + slice_bytes + length - 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, "text", slice_bytes):
            ids = np.array(batch.column(0).to_pylist(), np.int64)
            pieces = list(blocks([(t or "").encode("utf-8", "surrogatepass") for t in batch.column(1).to_pylist()]))
            size = sum(len(b) for _, _, b in pieces)
            # A very long text's blocks are taken one by one.
            groups = [pieces] if size <= 2 * slice_bytes + 1000 * length else [[p] for p in pieces]
            for group in groups:
                owner, first, windows, anchor, content = segments_of([b for _, _, b in group], length, gram)
                rows = np.array([i for i, _, _ in group], np.int64)[owner]
                places = ((first + np.array([a for _, a, _ in group], np.int64)[owner]) << 16) | windows
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), pa.array(ids[rows]), pa.array(places)],
                    names=["anchor", "content", "id", "place"],
                )

    return bounded_batches(df).mapInArrow(run, "anchor bigint, content bigint, id bigint, place bigint")


def _finer(level: int, length: int, gram: int, slice_bytes: int):
    """Segments of segments, by the anchors of a level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, "bytes", slice_bytes):
            texts = batch.column("bytes").to_pylist()
            owner, first, windows, anchor, content = segments_of(texts, length, gram, level)
            above, ids, n, place = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "id", "n", "place"))
            key = mixed(anchor ^ mixed(above[owner].view(np.uint64)))  # equal windows agree in every level's anchor
            places = (((place[owner] >> 16) + first) << 16) | windows
            parts = [texts[o][f : f + w + length - 1] for o, f, w in zip(owner.tolist(), first.tolist(), windows.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(content.view(np.int64)), pa.array(ids[owner]), pa.array(places), pa.array(n[owner]), pa.array(parts, pa.binary())],
                names=["anchor", "content", "id", "place", "n", "bytes"],
            )

    return run


def _stable(keys: np.ndarray) -> np.ndarray:
    """A stable order by whole numbers below 2^32, by halves."""
    order = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    if len(keys) and keys.max() > 0xFFFF:
        order = order[np.argsort((keys[order] >> 16).astype(np.uint16), kind="stable")]
    return order


class Shard:
    """Suffix order and Burrows-Wheeler transform of some strings.

    ``symbols`` are above 0; ``before[i]`` is the place of the symbol before place i in its string, or -1;
    ``last`` says where a string ends.
    """

    def __init__(self, symbols: np.ndarray, before: np.ndarray, last: np.ndarray, longest: int):
        order = ends = np.flatnonzero(last)
        for _ in range(longest):  # after k rounds suffixes are sorted by k symbols
            rise = before[order]
            found = np.concatenate([ends, rise[rise >= 0]])
            order = found[_stable(symbols[found])]
        self.order = order
        rank = np.empty(len(symbols), np.int64)
        rank[order] = np.arange(len(order))
        rise = before[order]
        self.transform = np.where(rise >= 0, symbols[rise], 0)
        self.up = np.where(rise >= 0, rank[rise], -1)  # the place of each transform symbol in the order
        self.ends, self.first = rank[ends[_stable(symbols[ends])]], symbols[order]


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard and rank of all suffixes in merged order by ``depth`` symbols, and the common prefix with the one before.

    Common prefixes are in symbols, ``depth`` where they are at least that long.
    """
    base = np.cumsum([0, *(len(s.order) for s in shards)])
    transform = np.concatenate([s.transform for s in shards])
    up = np.concatenate([np.where(s.up >= 0, s.up + b, -1) for s, b in zip(shards, base, strict=False)])
    first = np.concatenate([s.first for s in shards])
    ends = np.concatenate([s.ends + b for s, b in zip(shards, base, strict=False)])
    # Round 1: by the first symbol; a shard's own order is kept within each symbol, as in every round.
    order = _stable(first)
    border = np.concatenate([[True], first[order][1:] != first[order][:-1]]) if len(order) else np.zeros(0, bool)
    common = np.where(border, 0, depth)
    for k in range(1, depth):
        block = np.cumsum(border)
        rise = up[order]
        has = rise >= 0
        # Suffixes of one symbol come first of their symbol: the end is before every symbol.
        found = np.concatenate([ends, rise[has]])
        key = np.concatenate([first[ends], transform[order][has]])
        under = np.concatenate([np.zeros(len(ends), np.int64), block[has]])
        place = _stable(key)
        order, key, under = found[place], key[place], under[place]
        border = np.concatenate([[True], (key[1:] != key[:-1]) | (under[1:] != under[:-1])])
        common = np.where(border, np.minimum(common, k), common)
    shard = np.searchsorted(base, order, side="right") - 1
    return shard, order - base[shard], common


def repeated_windows(texts: list[bytes], length: int, *, shard_symbols: int = 1 << 19) -> np.ndarray:
    """Which starts of the joined texts begin a string of ``length`` bytes that starts elsewhere too."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    out = np.zeros(len(data), bool)
    depth = length // STEP
    ends = np.cumsum([len(t) for t in texts])
    if not len(texts) or len(data) < length:
        return out
    hashes = Substrings(data).hashes(slice(None, -STEP), slice(STEP, None))
    text = np.searchsorted(ends, np.arange(len(data)), side="right")
    left = ends[text] - np.arange(len(data))  # bytes from here to the text's end
    whole = left[: len(hashes)] >= STEP
    values, number, times = np.unique(hashes, return_inverse=True, return_counts=True)
    twice = whole & (times[number] > 1)
    alive = left[: len(hashes)] >= length
    for k in range(depth):
        part = twice[k * STEP :]
        alive[: len(part)] &= part
        alive[len(part) :] = False
    starts = np.flatnonzero(alive)
    if not len(starts):
        return out
    used = np.zeros(len(hashes) + STEP, bool)
    for k in range(depth):
        used[starts + k * STEP] = True
    places = np.flatnonzero(used)
    index = np.full(len(used) + STEP, -1, np.int64)
    index[places] = np.arange(len(places))
    same = text[places]
    before = np.where(places >= STEP, index[places - STEP], -1)
    before[(before >= 0) & (same[before] != same)] = -1
    behind = index[places + STEP]
    last = (behind < 0) | (same[behind] != same)
    symbols = np.unique(number[places], return_inverse=True)[1].astype(np.int64) + 1
    longest = max(map(len, texts)) // STEP + 1
    # Shards of whole texts.
    cuts = [0]
    for border in np.flatnonzero(same[1:] != same[:-1]) + 1:
        if border - cuts[-1] >= shard_symbols:
            cuts.append(int(border))
    cuts.append(len(places))
    shards = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        own = before[a:b]
        shards.append(Shard(symbols[a:b], np.where(own >= 0, own - a, -1), last[a:b], longest))
    shard, rank, common = merge(shards, depth)
    order = np.array(cuts)[shard] + np.concatenate([s.order for s in shards])[np.cumsum([0, *(len(s.order) for s in shards)])[shard] + rank]
    long = common >= depth
    long = long | np.append(long[1:], False)  # in an interval of at least two
    hits = places[order[long]]
    out[hits[alive[hits]]] = True
    return out


def _spans(rows: DataFrame, first: Column, windows: Column, length: int) -> DataFrame:
    return rows.select("id", first.alias("begin"), (first + windows + F.lit(length - 1)).alias("end"))


def repeated_spans(df: DataFrame, *, length: int, gram: int, most: int, bucket_bytes: int, slice_bytes: int) -> DataFrame:
    """``(id, begin, end)``: byte ranges of rows ``(id, text)`` that are covered by repeated windows; they may overlap."""
    every = stored(segments(df, length=length, gram=gram, slice_bytes=slice_bytes), "segments")
    anchors = every.groupBy("anchor").agg(F.count("*").alias("n"), F.min("content").alias("low"), F.max("content").alias("high"))
    # Counts are written before they are joined: Spark splits a hot key only between plain shuffles.
    anchors = stored(anchors.filter("n > 1").select("anchor", (F.col("low") == F.col("high")).alias("equal")), "anchors")
    shared = stored(every.join(anchors, "anchor"), "shared")
    dropped(every)
    first, windows = F.shiftright("place", 16), F.col("place").bitwiseAND(0xFFFF)
    spans = _spans(shared.filter("equal"), first, windows, length)

    unequal = shared.filter("NOT equal").drop("equal")
    distinct = stored(unequal.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(F.struct("id", "place")).alias("one")), "distinct")
    copied = distinct.filter("n > 1").select("anchor", "content")
    spans = spans.union(_spans(unequal.join(copied, ["anchor", "content"]), first, windows, length))

    # The text of one segment for each distinct content.
    crowds = stored(distinct.groupBy("anchor").agg(F.count("*").alias("members")), "crowds")
    parts = distinct.join(crowds, "anchor").select("anchor", "n", "members", F.col("one.id").alias("id"), F.col("one.place").alias("place"))
    per_text = parts.groupBy("id").agg(F.collect_list(F.struct("anchor", "n", "members", "place")).alias("parts"))
    raw = df.select("id", F.col("text").cast("binary").alias("raw"))
    cut = F.transform(
        "parts",
        lambda p: F.struct(
            p["anchor"].alias("anchor"), p["n"].alias("n"), p["members"].alias("members"), p["place"].alias("place"),
            F.substring("raw", (F.shiftright(p["place"], 16) + 1).cast("int"), (p["place"].bitwiseAND(0xFFFF) + F.lit(length - 1)).cast("int")).alias("bytes"),
        ),
    )
    pieces = stored(raw.join(per_text, "id").select("id", F.inline(cut)), "pieces")

    cold, hot, level = [pieces.filter(F.col("members") <= most)], pieces.filter(F.col("members") > most), 1
    while level <= LEVELS and not hot.isEmpty():
        finer = bounded_batches(hot.select("anchor", "id", "n", "place", "bytes")).mapInArrow(
            _finer(level, length, gram, slice_bytes), "anchor bigint, content bigint, id bigint, place bigint, n bigint, bytes binary"
        )
        finer = stored(finer, "finer")
        known = finer.groupBy("anchor", "content").agg(
            F.sum("n").alias("n"), F.min(F.struct("id", "place")).alias("one"), F.any_value("bytes").alias("bytes")
        )
        known = stored(known, "known")
        # A segment that is no copy itself, and equals another's.
        again = finer.filter("n = 1").join(known.filter("n > 1").select("anchor", "content"), ["anchor", "content"])
        spans = spans.union(_spans(again, first, windows, length))
        crowds = stored(known.groupBy("anchor").agg(F.count("*").alias("members")).filter("members > 1"), "crowds")
        parts = known.join(crowds, "anchor").select(F.col("one.id").alias("id"), "anchor", "n", "members", F.col("one.place").alias("place"), "bytes")
        parts = stored(parts, "pieces")
        cold.append(parts.filter(F.col("members") <= most))
        hot, level = parts.filter(F.col("members") > most), level + 1
    cold = functools.reduce(DataFrame.unionByName, cold)

    size = cold.agg(F.sum(F.length("bytes"))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))

    def run(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_pylist() for c in ("id", "n", "place", "bytes")}
        found = repeated_windows(columns["bytes"], length)
        rows: list[tuple[int, int, int]] = []
        at = 0
        for record, n, place, text in zip(*columns.values(), strict=True):
            if n == 1:  # copies are known already
                own = found[at : at + len(text)]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                rows += [(record, (place >> 16) + int(a), (place >> 16) + int(b) - 1 + length) for a, b in edges.reshape(-1, 2)]
            at += len(text)
        ids, begins, ends = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.table([pa.array(x, pa.int64()) for x in (ids, begins, ends)], names=["id", "begin", "end"])

    bucket = F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket")
    merged = cold.select(bucket, "id", "n", "place", "bytes").groupBy("bucket").applyInArrow(run, "id bigint, begin bigint, end bigint")
    spans = spans.union(merged)

    # Windows that are crowded still, as rows.
    starts = F.sequence(F.lit(0), (F.col("place").bitwiseAND(0xFFFF) - 1).cast("int"))
    rows = hot.select("id", "n", "place", "bytes", F.explode(starts).alias("at"))
    text = F.substring("bytes", F.col("at") + 1, F.lit(length))
    rows = rows.select("id", "n", (F.shiftright("place", 16) + F.col("at")).alias("begin"), F.xxhash64(text, F.lit(1)).alias("one"), F.xxhash64(F.lit(2), text).alias("two"))
    twice = rows.groupBy("one", "two").agg(F.count("*").alias("windows")).filter("windows > 1").select("one", "two")
    again = rows.filter("n = 1").join(twice, ["one", "two"])
    return spans.union(again.select("id", "begin", (F.col("begin") + length).alias("end")))


def remove_repeats(
    df: DataFrame, record_id: str, text: str, *, length: int = 200, gram: int = 32, most: int = 2000,
    bucket_bytes: int = 1 << 20, slice_bytes: int = 1 << 20, decode: bool = False,
) -> DataFrame:
    """``df`` with ``kept`` (the bytes that are left), ``n_bytes``, ``n_removed`` and ``n_spans``.

    ``length`` is a multiple of ``STEP``. With ``decode`` what is left is text again; of a character
    that was cut, nothing stays.
    """
    if length % STEP:
        raise ValueError(f"length must be a multiple of {STEP}")
    named = {"kept", "n_bytes", "n_removed", "n_spans"}
    keep = [f for f in df.schema.fields if f.name not in named]
    key = "_" + "_".join(df.columns)  # a name no column has
    df, _ = with_text_key(df, record_id, text, key)
    df = df.withColumn(key, F.coalesce(key, F.xxhash64(text)))
    rows = df.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    spans = repeated_spans(rows, length=length, gram=gram, most=most, bucket_bytes=bucket_bytes, slice_bytes=slice_bytes)
    spans = stored(spans.groupBy("id").agg(F.collect_list(F.struct("begin", "end")).alias("spans")), "spans")

    joined = df.select(*(f.name for f in keep), key)
    spans = spans.select(F.col("id").alias(key), F.col("spans").alias(f"{key}_spans"))
    joined = joined.join(spans, key, "left").drop(key)
    new = T.StructType([*keep, T.StructField("kept", T.StringType() if decode else T.BinaryType()), *(T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, text, 4 * slice_bytes):
            column = batch.column(batch.schema.get_field_index(text))
            kept, counts = [], []
            for value, own in zip(column.to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                raw = (value or "").encode("utf-8", "surrogatepass")
                out, end, removed, runs = [], 0, 0, 0
                for a, b in sorted((s["begin"], s["end"]) for s in own or ()):
                    if a > end or not runs:
                        out.append(raw[end:a])
                        runs += 1
                        removed += b - a
                    else:
                        removed += max(0, b - end)
                    end = max(end, b)
                out.append(raw[end:])
                kept.append(b"".join(out))
                counts.append((len(raw), removed, runs))
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in keep]
            if decode:
                columns.append(pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()))
            else:
                columns.append(pa.array(kept, pa.binary()))
            columns += [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(columns, names=new.names)

    return bounded_batches(joined).mapInArrow(run, new)
