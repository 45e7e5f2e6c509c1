"""Near duplicates among embeddings: spherical k-means cells, blocked cosine products, one representative per group.

Equal vectors are one node that counts as often as it occurs. Nodes are dealt to cells by spherical k-means,
fitted on at most ``sample_rows`` nodes of the cell that is being split. A cell with more than ``cell_rows``
nodes is split again in the same way, by its own sample, until it is small enough or splitting no longer
divides it (a tight group of near copies); levels follow the input, and no table of centres is ever broadcast.

Two nodes linked with cosine t are no further apart than d = sqrt(2 - 2 t). Somebody between them, their midpoint,
lies in one cell, and both ends are no more than d / 2 beyond that cell's borders. So a node goes to every
cell whose border is no more than ``reach * d / 2`` away. With ``reach=1`` no link can be lost; the price
grows with the dimensions. The default takes the border's distance to be that of a random direction,
``spread`` standard deviations (d / 2 divided by the root of the dimensions), where a link is lost with a
probability of about 1e-3; ``tests`` measure the recall against all pairs.

Inside a cell, products of blocks of ``block_rows`` unit vectors in double precision give all cosines; no
pair becomes a row. A pair that shares several cells counts in the smallest numbered of them. Links go
through union-find: the smallest id of every component is its representative.

Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; a vector that
is shorter than another is padded with zeros. Rows with equal ids are rows of their own; in components an id is one
place, whatever vectors it has. A row with a null id is linked with nothing, and its component is null. An empty
table gives an empty result. Only id and vector are read, so other columns can have any names.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, stored
from tidemark.llm.graph import components

#: Nodes that one task splits or compares at once, at most.
GROUP_ROWS = 8192
#: Cosines this close to the limit are computed again, exactly rounded.
CLOSE = 1e-10
NODE, KIND = ("node", "id", "copies", "unit"), "node binary, id bigint, copies bigint, unit binary"


def _matrix(vectors: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    data = b"".join(v.as_py() for v in vectors)
    return np.frombuffer(data, np.float64).reshape(-1, dims)


def spherical_kmeans(unit: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centres of ``unit``: begun far apart, then mean directions; cells that run empty go. Always the same."""
    rng = np.random.default_rng(len(unit) * 1009 + k)
    centres = unit[np.sort(rng.choice(len(unit), min(k, len(unit)), replace=False))]
    for _ in range(rounds):
        home = np.argmax(unit @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, unit)
        norm = np.linalg.norm(sums, axis=1)
        centres = sums[norm > 1e-9] / norm[norm > 1e-9, None]
    return np.unique(centres, axis=0)


def cells_within(unit: np.ndarray, centres: np.ndarray, slack: float) -> np.ndarray:
    """Whether each vector stands in a cell or no more than ``slack`` beyond its borders."""
    cosine = unit @ centres.T
    home = np.argmax(cosine, axis=1)
    gap = np.sqrt(np.maximum(0, 2 - 2 * centres @ centres.T))
    best = cosine[np.arange(len(unit)), home]
    return best[:, None] - cosine <= slack * gap[home] + 1e-9


def _split(dims: int, cell_rows: int, most_cells: int, slack: float):
    def fit(key: tuple, sample: pa.Table) -> pa.Table:
        unit = _matrix(sample.column("unit"), dims)
        total = sample.column("total")[0].as_py()
        k = max(2, min(most_cells, math.ceil(4 * total / cell_rows), len(unit) // 8))
        centres = spherical_kmeans(unit, k)
        return pa.table({"cell": pa.array([key[0].as_py()], pa.string()), "centres": [centres.tobytes()]})

    def deal(key: tuple, rows: pa.Table, fitted: pa.Table) -> pa.Table:
        rows = rows.select(list(NODE))
        if rows.num_rows == 0 or fitted.num_rows == 0:
            return rows.slice(0, 0).append_column("cell", pa.array([], pa.string()))
        centres = np.frombuffer(fitted.column("centres")[0].as_py(), np.float64).reshape(-1, dims)
        row, cell = np.nonzero(cells_within(_matrix(rows.column("unit"), dims), centres, slack))
        names = pa.array([f"{key[0].as_py()}.{c}" for c in range(len(centres))])
        return rows.take(pa.array(row)).append_column("cell", names.take(pa.array(cell)))

    return fit, deal


def _cells(nodes: DataFrame, dims: int, slack: float, cell_rows: int, sample_rows: int, most_cells: int) -> DataFrame:
    """Every node in each cell that it belongs to; ``nodes`` have a ``cell`` to begin with."""
    fit, deal = _split(dims, cell_rows, most_cells, slack)
    open_, done, level = nodes, [], 0
    sizes = open_.groupBy("cell").agg(F.count("*").alias("total")).withColumn("crowded", F.col("total") > cell_rows)
    while True:
        sizes = stored(sizes, "cells")
        large = sizes.filter("crowded").select("cell", "total")
        if large.isEmpty():
            return functools.reduce(DataFrame.unionByName, [*done, open_])
        if level:
            done.append(open_.join(sizes.filter("NOT crowded"), "cell", "left_semi").select(*NODE, "cell"))
        rows = open_.join(large, "cell")
        drawn = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < F.lit(float(sample_rows) * (1 << 30)) / F.col("total")
        fitted = rows.filter(drawn).select("cell", "total", "unit").groupBy("cell").applyInArrow(fit, "cell string, centres binary")
        parts = F.ceil(F.col("total") / GROUP_ROWS).cast("int")
        dealt = rows.select(*NODE, "cell", F.pmod(F.hash("node"), parts).alias("part"))
        each = stored(fitted, "centres").join(large, "cell")
        each = each.select("cell", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "centres")
        dealt = dealt.groupBy("cell", "part").cogroup(each.groupBy("cell", "part"))
        open_ = stored(dealt.applyInArrow(deal, f"{KIND}, cell string"), "dealt")
        level += 1
        # A split that leaves nine tenths in one cell divides nothing: it is a tight group.
        sizes = open_.groupBy("cell").agg(F.count("*").alias("total"))
        above = large.select(F.col("cell").alias("parent"), F.col("total").alias("was"))
        sizes = sizes.withColumn("parent", F.substring_index("cell", ".", level)).join(above, "parent")
        crowded = (F.col("total") > cell_rows) & (10 * F.col("total") < 9 * F.col("was"))
        sizes = sizes.select("cell", "total", crowded.alias("crowded"))


def _compare(dims: int, cosine: float):
    def exact(x: np.ndarray, y: np.ndarray) -> float:
        return math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y))

    def links(key: tuple, rows: pa.Table) -> pa.Table:
        """Per node the copies it is linked with here, and the smallest id it reaches here."""
        cell, low, high = (k.as_py() for k in key)
        block = rows.column("block").to_numpy()
        unit, ids = _matrix(rows.column("unit"), dims), rows.column("id").to_numpy()
        copies = rows.column("copies").to_numpy()
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        near = unit[left] @ unit[right].T
        linked = near >= cosine
        for i, j in zip(*np.nonzero(np.abs(near - cosine) < CLOSE), strict=True):
            linked[i, j] = exact(unit[left[i]], unit[right[j]]) >= cosine
        if low == high:
            np.fill_diagonal(linked, False)
        # Cells with smaller names that the two share, as a product of incidence matrices.
        lists = [[c for c in x if c < cell] for x in rows.column("cells").to_pylist()]
        names = {c: i for i, c in enumerate(sorted({c for x in lists for c in x}))}
        other = np.zeros((len(ids), max(1, len(names))), np.float32)
        for i, x in enumerate(lists):
            other[i, [names[c] for c in x]] = 1
        counted = linked & (other[left] @ other[right].T == 0)
        total = np.zeros(len(ids), np.int64)
        total[left] += counted @ copies[right]
        if low != high:
            total[right] += copies[left] @ counted
        root = _smallest(linked, left, right, ids)
        some = (total > 0) | (root != ids)
        nodes = rows.column("node").filter(pa.array(some))
        return pa.table({"node": nodes, "id": ids[some], "root": root[some], "n": total[some]})

    return links


def _smallest(linked: np.ndarray, left: np.ndarray, right: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The smallest id that every node reaches over the links of a block, by handing smaller ids on."""
    root = ids.copy()
    rows, columns = linked.any(1), linked.any(0)
    linked, left, right = linked[np.ix_(rows, columns)], left[rows], right[columns]
    top = np.iinfo(np.int64).max
    while linked.size:
        before = root.copy()
        for low in range(0, len(left), 512):
            part = slice(low, low + 512)
            least = np.where(linked[part], root[right][None, :], top).min(1)
            root[left[part]] = np.minimum(root[left[part]], least)
        for low in range(0, len(right), 512):
            part = slice(low, low + 512)
            least = np.where(linked[:, part], root[left][:, None], top).min(0)
            root[right[part]] = np.minimum(root[right[part]], least)
        if (root == before).all():
            break
    return root


def _units(dims: int):
    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with usable vectors: the digest of the vector, and its direction."""
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch.column("v")), 0).to_numpy()
            raw = np.zeros((batch.num_rows, dims))
            raw[np.arange(dims)[None, :] < sizes[:, None]] = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            raw += 0.0  # one zero only
            good = np.isfinite(raw).all(1) & raw.any(1) & pc.is_valid(batch.column("id")).to_numpy(zero_copy_only=False)
            raw = raw[good]
            unit = raw / np.abs(raw).max(1, keepdims=True)  # no square overflows
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([blake2b(x.tobytes(), digest_size=20).digest() for x in raw], pa.binary()),
                    batch.column("id").filter(pa.array(good)),
                    pa.array([x.tobytes() for x in unit], pa.binary()),
                ],
                names=["node", "id", "unit"],
            )

    return units


def near_duplicates(
    df: DataFrame,
    id_column: str,
    vector: str,
    cosine: float = 0.95,
    cell_rows: int = 4096,
    block_rows: int = 2048,
    sample_rows: int = 16384,
    most_cells: int = 64,
    spread: float = 3.5,
    reach: float | None = None,
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row of ``df``."""
    rows = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    dims = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 0)
    used = stored(bounded_batches(rows).mapInArrow(_units(dims), "node binary, id bigint, unit binary"), "vectors")
    nodes = used.groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.any_value("unit").alias("unit"))
    nodes = stored(nodes.withColumn("cell", F.lit("0")), "nodes")
    slack = math.sqrt(2 - 2 * cosine) / 2 * (min(1.0, spread / math.sqrt(dims)) if reach is None else reach)
    placed = _cells(nodes, dims, slack, cell_rows, sample_rows, most_cells)
    placed = placed.groupBy(*NODE).agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    placed = stored(placed.select(*NODE, "cells", F.explode("cells").alias("cell")), "placed")
    blocks = placed.groupBy("cell").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    placed = placed.join(blocks, "cell").withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("partner")
    placed = placed.select(*NODE, "cells", "cell", "block", partner)
    ends = (F.least("block", "partner").alias("low"), F.greatest("block", "partner").alias("high"))
    found = placed.groupBy("cell", *ends).applyInArrow(_compare(dims, cosine), "node binary, id bigint, root bigint, n bigint")
    found = stored(found, "links")
    roots = components(found.filter("id != root").select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    groups = nodes.select("node", "copies", F.col("id").alias("first")).join(counts, "node", "left")
    groups = groups.join(roots.withColumnRenamed("node", "first"), "first", "left").select(
        "node",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "first").alias("component_id"),
    )
    groups = stored(groups, "groups")
    linked = used.select("id", "node").join(groups, "node").select("id", "n_links", "component_id")
    # What takes no part is told by id; ids that occur with usable and other vectors are told apart by the vector.
    alone = rows.filter(~_usable("v") | F.col("id").isNull()).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def _usable(vector: str) -> Column:
    """Whether :func:`_units` keeps a row, asked of its list."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))
