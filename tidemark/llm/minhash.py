"""Near duplicates by SuperMinHash, banding, verification and union-find.

A document's set are its distinct word shingles. Documents with equal sets are one node. Every shingle
ranks all slots of the signature by a random permutation of its own (drawn step by step, as in
Fisher-Yates): step j puts the value j + r, r in [0, 1), into its j-th slot. A slot keeps the smallest
value, so slots are not independent but spread evenly, which lowers the variance; a document stops as
soon as no later step can lower any slot. Bands of slots are buckets of candidates.

Links are confirmed on full sets. Inside a bucket not all pairs are compared: the member that shares the
most buckets is compared with all others, then links are joined to components, and only buckets that
still hold several components go on. What is left after a few such steps is compared across components: in
crowded buckets block by block, where a product of incidence matrices counts what sets share and only
links become rows. No candidate pair of a bucket is passed over unless its documents are in one
component, so no link is lost that any band has found.

Sets are compared as sets of 64-bit hashes of their shingles.

Null or blank text has an empty set and is linked with nothing. Rows of equal id and text are one document; rows that
share an id but not the text are documents of their own, told apart by ``text_hash``, and of those with the component's
smallest id one is kept. A null id is linked with nothing, has a null component and is kept. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, parts_of, stored, with_text_key
from tidemark.llm.graph import components

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
ODD = np.uint64(0x9E3779B97F4A7C15)
UNIT = np.uint64(1 << 40)  # fractions of a signature value have 40 bits
TINY = 4  # pairs per row that are compared without another step
FEW_MEMBERS = 32  # of a bucket whose pairs may be rows
BROADCAST_IDS = 1_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


PRIME = (1 << 31) - 1
BASES = (1_482_907_561, 837_461_029)  # drawn at random


def _modulo(x: np.ndarray) -> np.ndarray:
    """Numbers below 2^62 modulo PRIME, but for PRIME itself, which may stand for 0."""
    p, bits = np.uint64(PRIME), np.uint64(31)
    x = (x & p) + (x >> bits)
    return (x & p) + (x >> bits)


def _powers(base: int, places: int) -> np.ndarray:
    """The first powers of the base modulo PRIME, by doubling."""
    out = np.ones(places, np.uint64)
    done = 1
    while done < places:
        more = min(done, places - done)
        out[done : done + more] = _modulo(out[:more] * np.uint64(pow(base, done, PRIME)))
        done += more
    return out


class Substrings:
    """Hashes of any substrings of some bytes.

    Two polynomials modulo a prime, with drawn bases: unlike sums modulo a power of two, they have no strings that
    collide for every base. Strings of n bytes collide with probability (n / 2^31)^2.
    """

    def __init__(self, data: np.ndarray):
        self.sums, self.back = [], []
        for base in BASES:
            terms = (data.astype(np.uint64) + np.uint64(1)) * _powers(base, len(data))
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(_modulo(terms))]))
            self.back.append(_powers(pow(base, -1, PRIME), len(data) + 1))

    def hashes(self, starts: np.ndarray | slice, ends: np.ndarray | slice) -> np.ndarray:
        out = None
        for sums, back in zip(self.sums, self.back, strict=True):
            part = _modulo(_modulo(sums[ends] - sums[starts]) * back[starts])
            part = np.where(part == PRIME, np.uint64(0), part)
            out = part if out is None else (out << np.uint64(31)) | part
        return mixed(out)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts, and the text it belongs to."""
    data = np.frombuffer(b"".join(t + b"\n" for t in texts), np.uint8)
    blank = SPACE[data]
    before = np.concatenate([[True], blank[:-1]])
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(blank & ~before)
    hashes = Substrings(data).hashes(starts, ends)
    borders = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    return hashes, np.searchsorted(borders, starts, side="right")


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, owner = word_hashes(texts)
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    factors = mixed(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    whole = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        whole += words[k : k + len(whole)] * factors[k]
    whole = mixed(whole)
    out = []
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if b - a >= width:
            out.append(np.unique(whole[a : b - width + 1]))
        else:
            short = (words[a:b] * factors[: b - a]).sum(keepdims=True) + np.uint64(b - a)
            out.append(mixed(short[: b - a]))
    return out


def signatures(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """SuperMinHash signatures, sets x slots; an empty set keeps the largest number everywhere."""
    values = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    items = np.concatenate([np.zeros(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = None
    for step in range(slots):
        draw = mixed(items + np.uint64((step + 1) * int(ODD) % (1 << 64)))
        pick = step + ((draw >> np.uint64(44)) * np.uint64(slots - step) >> np.uint64(20)).astype(np.int64)
        rows = np.arange(len(items))
        if step == 0:
            slot = pick
        else:
            slot = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[rows, step]
        value = np.uint64(step) * UNIT + (draw & (UNIT - np.uint64(1)))
        np.minimum.at(values.reshape(-1), owner * slots + slot, value)
        going = (values.max(axis=1) >= np.uint64(step + 1) * UNIT)[owner]
        if not going.any():
            break
        if step == 0:
            order = np.tile(np.arange(slots, dtype=np.uint16), (int(going.sum()), 1))
            order[np.arange(len(order)), pick[going]] = 0
        else:
            order = order[going]
        items, owner = items[going], owner[going]
    return values


def _bytes(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass").lower() for t in batch.column(1).to_pylist()]  # bytes: A-Z only


def _int64(lists: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, lists)])
    flat = np.concatenate([np.zeros(0, np.uint64), *lists]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))


def sketches(df: DataFrame, record_id: str, text: str, *, width: int, bands: int, rows: int, slice_bytes: int = 1 << 20) -> DataFrame:
    """``(id, text_hash, n_shingles, content, buckets)`` of every row; rows of equal sets have equal content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, "text", slice_bytes):
            sets = shingle_sets(_bytes(batch), width)
            found = signatures(sets, bands * rows).reshape(len(sets), bands, rows)
            keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * ODD, (len(sets), 1))
            for k in range(rows):
                keys = mixed(keys * ODD + found[:, :, k])
            content = [b"".join(np.uint64(mixed(s + np.uint64(k)).sum()).tobytes() for k in (1, 2)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(content, pa.binary()), _int64(list(keys))],
                names=["id", "text_hash", "n_shingles", "content", "buckets"],
            )

    columns = (F.col(record_id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    return bounded_batches(df).select(*columns).mapInArrow(run, "id bigint, text_hash bigint, n_shingles bigint, content binary, buckets array<bigint>")


def full_sets(df: DataFrame, *, width: int, slice_bytes: int = 1 << 20) -> DataFrame:
    """``(id, items)`` of rows ``(id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, "text", slice_bytes):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _int64(shingle_sets(_bytes(batch), width))], names=["id", "items"]
            )

    return bounded_batches(df).mapInArrow(run, "id bigint, items array<bigint>")


def _near(a: Column, b: Column, percent: int) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough.

    Pairs of few enough rows are broadcast to the sets, so that only sets of pairs are shuffled, once.
    """
    pairs = stored(pairs, "pairs")
    ends = pairs.select(F.col("b").alias("id")).distinct()
    one = sets.select(F.col("id").alias("a"), F.col("items").alias("left")).join(_small(pairs), "a")
    two = sets.join(_small(ends), "id", "left_semi").select(F.col("id").alias("b"), F.col("items").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    return (
        one.join(two, "b")
        .filter(100 * both >= percent * (F.size("left") + F.size("right") - both))
        .select("a", "b")
    )


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _small(ids: DataFrame) -> DataFrame:
    """Rows of ids, to be broadcast if they are at most BROADCAST_IDS (about 16 MB an id), else as they are."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _rooted(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return rows.withColumn("root", F.col("id"))
    return rows.join(roots, rows["id"] == roots["node"], "left").withColumn("root", F.coalesce("root", "id")).drop("node")


def _spread(nodes: DataFrame, roots: DataFrame | None, bands: int) -> DataFrame:
    """``(bucket, id, size, score)`` of the first bands' buckets with several components; score: members met in them."""
    rows = _rooted(nodes, roots).select("id", "root", "size", F.explode(F.slice("buckets", 1, bands)).alias("bucket"))
    several = rows.groupBy("bucket").agg(F.count("*").alias("members"), F.min("root").alias("low"), F.max("root").alias("high"))
    several = stored(several.filter("low != high").select("bucket", "members"), "several")
    rows = stored(rows.join(several, "bucket").select("bucket", "id", "size", "members"), "members")
    scores = rows.groupBy("id").agg(F.sum("members").alias("score"))
    return rows.drop("members").join(scores, "id")


def _active(members: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The members of buckets with several components, with the bucket's size and the member to compare with."""
    now = _rooted(members, roots)
    centre = F.max_by(F.struct("id", "root", "size"), F.struct("score", -F.col("id"))).alias("centre")
    several = now.groupBy("bucket").agg(centre, F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members"))
    several = stored(several.filter("low != high").drop("low", "high"), "several")
    return stored(now.join(several, "bucket"), "active")


def _common(table: pa.Table, width: int = 4096) -> np.ndarray:
    """How many items any two sets of a table share: a product of incidence matrices, some columns at a time."""
    lists = table.column("items").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    _, item, times = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    number = np.cumsum(times > 1) - 1  # an item of one set is shared with none
    owner, item = owner[times[item] > 1], number[item[times[item] > 1]]
    order = np.argsort(item, kind="stable")
    owner, item = owner[order], item[order]
    out = np.zeros((len(lists), len(lists)), np.float32)
    for begin in range(0, int((times > 1).sum()), width):
        a, b = np.searchsorted(item, [begin, begin + width])
        part = np.zeros((len(lists), width), np.float32)
        part[owner[a:b], item[a:b] - begin] = 1
        out += part @ part.T
    return out


def _block_links(members: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links across components in crowded buckets: blocks of members against blocks, no pair is a row but a link."""
    sized = members.groupBy("bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = members.join(sized, "bucket").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least(k, "block").alias("i"), F.greatest(k, "block").alias("j")),
    )
    spread = placed.withColumn("task", F.explode(others)).join(sets, "id")

    def run(table: pa.Table) -> pa.Table:
        ids, roots, blocks = (table.column(c).to_numpy() for c in ("id", "root", "block"))
        both = _common(table)
        sizes = np.array([len(x) for x in table.column("items")], np.float32)
        near = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
        near &= (roots[:, None] != roots[None, :]) & (ids[:, None] < ids[None, :])
        if len(np.unique(blocks)) > 1:  # pairs within a block are its own task's
            near &= blocks[:, None] != blocks[None, :]
        a, b = np.nonzero(near)
        return pa.table({"a": pa.array(ids[a], pa.int64()), "b": pa.array(ids[b], pa.int64())})

    rows = spread.select("bucket", "task", "block", "id", "root", "items")
    return rows.groupBy("bucket", "task").applyInArrow(run, "a bigint, b bigint").distinct()


def _across(now: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """All links between components within a bucket: as pairs in small buckets, in blocks in crowded ones."""
    small = now.filter(F.col("members") <= FEW_MEMBERS)
    one = small.filter("root != centre.root").select("bucket", "id", "root", "size")
    two = small.select("bucket", *(F.col(c).alias(f"{c}2") for c in ("id", "root", "size")))
    apart = (F.col("root") != F.col("root2")) & _near(F.col("size"), F.col("size2"), percent)
    pairs = one.join(two, "bucket").filter(apart).select(*_pair("id", "id2")).distinct()
    found = _links(pairs, sets, percent)
    large = now.filter(F.col("members") > FEW_MEMBERS).select("bucket", "id", "root")
    return found if large.isEmpty() else found.union(_block_links(large, sets, percent, block))


def near_duplicates(
    df: DataFrame, record_id: str, text: str, *, width: int = 5, percent: int = 80, bands: int = 25, rows: int = 4, first_bands: int = 5, steps: int = 1, block: int = 1024
) -> DataFrame:
    """``(id, text_hash, n_shingles, component_id, kept)`` of every row; the smallest id of a component is kept.

    Documents are linked with ``100 * intersection >= percent * union`` of their sets. A pair of similarity
    s shares a band with probability ``1 - (1 - s ** rows) ** bands``: 0.999998 at 0.8 as given.
    """
    df = df.select(F.col(record_id).cast("long").alias("id"), F.col(text).alias("text"))
    df, shared = with_text_key(df, "id", "text", "key")
    docs = stored(sketches(df, "key", "text", width=width, bands=bands, rows=rows), "sketches")
    nodes = (
        docs.filter("n_shingles > 0 AND id IS NOT NULL")
        .groupBy("content")
        .agg(F.min("id").alias("id"), F.first("n_shingles").alias("size"), F.first("buckets").alias("buckets"))
    )
    nodes = stored(nodes, "nodes")
    places = nodes.select("id", F.explode("buckets").alias("bucket"))
    crowded = places.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1").select("bucket")
    # Counts are written before they are joined: Spark splits a hot key only between plain shuffles.
    crowded = stored(crowded, "crowded")
    candidates = stored(places.join(crowded, "bucket").select("id").distinct(), "candidates")
    texts = df.select(F.col("key").alias("id"), "text")
    texts = texts.join(_small(candidates), "id", "left_semi")
    sets = stored(full_sets(texts, width=width).dropDuplicates(["id"]), "sets")
    first = nodes.select("content", F.col("id").alias("first"))
    nodes = nodes.join(_small(candidates), "id", "left_semi")

    # A few bands first: they link most copies to their source, and what is one component is not looked at again.
    links = roots = None
    for used, turns in ((min(first_bands, bands), 1), (bands, steps)):
        members = _spread(nodes, roots, used)
        for turn in range(turns + (used == bands)):
            now = _active(members, roots)
            total, left = now.select(F.count("*"), F.sum("members") / 2).first()
            if not total:
                break
            rest = used == bands and (turn == turns or left <= TINY * total)
            if rest:
                found = _across(now, sets, percent, block)
            else:
                apart = (F.col("root") != F.col("centre.root")) & _near(F.col("size"), F.col("centre.size"), percent)
                found = _links(now.filter(apart).select(*_pair("id", "centre.id")).distinct(), sets, percent)
            found = stored(found, "links")
            links = found if links is None else links.union(found)
            roots = components(links)
            if rest:
                break
            members = now.filter("id != centre.id").select("bucket", "id", "size", "score")

    named = docs.join(first, "content", "left")
    if roots is not None:
        named = named.join(roots, named["first"] == roots.node, "left")
    else:
        named = named.withColumn("root", F.lit(None).cast("long"))
    own = F.when(F.col("id").isNotNull() & (F.col("n_shingles") > 0), F.coalesce("root", "first"))
    named = named.withColumn("component_id", F.coalesce(own, F.col("id")))
    named = named.select("id", "text_hash", "n_shingles", "component_id")
    kept = F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    if shared.isEmpty():
        return named.select("*", kept)
    # Keys back to ids: a component is named by its smallest id, whatever keys its documents have.
    own = stored(df.filter("key != id").select("key", F.col("id").alias("own")).distinct(), "shared-keys")
    named = named.join(own, named["id"] == own["key"], "left").withColumn("own", F.coalesce("own", "id")).drop("key")
    first = named.groupBy("component_id").agg(F.min(F.struct("own", "id")).alias("first")).withColumnRenamed("component_id", "root")
    named = named.join(first, named["component_id"] == first["root"], "left")
    return named.select(
        F.col("own").alias("id"), "text_hash", "n_shingles", F.col("first.own").alias("component_id"), F.col("id").eqNullSafe(F.col("first.id")).alias("kept")
    )
