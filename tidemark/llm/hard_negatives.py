"""Hard negatives by a multiway hyperplane tree with distance ranges between sibling subtrees (GNAT).

Similarity is the inner product of whole-number vectors. Vectors differ a little in length, so rows get one
more component that brings all to the length L of the longest, and a query gets a zero there: then the
squared distance is ``|q|^2 + L^2 - 2 * product``, and the best products are the nearest rows.

The tree is fitted on at most ``sample_rows`` rows: a node's split points are chosen far apart, and a point
belongs to the subtree of its nearest split point. All rows are then dealt to leaves, and for any split
point i and sibling subtree j the smallest and largest distance from i to the rows of j is kept, over all
rows. A query that wants products in a window wants distances in a ring; walking down, the distance d
to split point i rules out every sibling j whose range lies wholly off ``[d - ring's outer, d + outer]``, or
wholly inside the ring's hole. What is left are leaves that may hold an answer; there all products are computed.
Nothing is ruled out that could answer, so results are exact.

Searches go in two waves: the leaves nearest to a query first, which gives a bound; then all other
leaves that the ring beyond this bound does not rule out, of which only rows beyond the bound come back.
Leaves are compared in blocks of ``block_rows`` rows by ``chunk_rows`` queries, so a leaf that holds a
third of all rows is many tasks. Tree and ranges have a size bounded by ``most_leaves`` and travel to the
tasks in their code; queries and rows never do.

Rows with a null id or label, a null or empty vector or a null or non-finite component take no part; a vector that
is shorter than another is padded with zeros. Rows equal in id, label and vector are one row; rows that share an id
only are different rows, none of them "another" of the other: a query never finds its own id, and of several
anchors with one id the first by label and vector asks. Ties go to the smaller id. A query without positives
has no negatives. An empty table gives an empty result. Only id, label and vector are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import bounded_batches, stored

#: Components at most so large, so that products are exact in double precision.
LARGEST = 1 << 21
ROW = "id bigint, label bigint, vec binary"


def _vectors(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() for v in column), np.float64).reshape(-1, dims)


@dataclass
class Tree:
    """Split points by node, and for each node the distance ranges between its split points and subtrees.

    ``points[node]`` are the split points, ``children[node]`` the nodes below; a node without points is a leaf, numbered
    by ``leaf``. ``low[node][i, j]`` and ``high[node][i, j]`` bound the distance from point i to any row of subtree j.
    """

    points: list[np.ndarray | None]
    children: list[list[int]]
    leaf: list[int]
    radius2: float
    low: list[np.ndarray | None]
    high: list[np.ndarray | None]

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rest = np.maximum(0.0, self.radius2 - np.einsum("ij,ij->i", rows, rows))
        return np.concatenate([rows, np.sqrt(rest)[:, None]], 1)

    def distances(self, node: int, points: np.ndarray) -> np.ndarray:
        """Distances of lifted ``points`` to the split points of ``node``."""
        split = self.points[node]
        square = (points**2).sum(1)[:, None] + (split**2).sum(1)[None, :] - 2 * points @ split.T
        return np.sqrt(np.maximum(0.0, square))

    def deal(self, points: np.ndarray, see=None) -> np.ndarray:
        """The leaf of every lifted point; ``see(node, distances, child)`` is told what each node saw."""
        leaf = np.empty(len(points), np.int64)
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if self.points[node] is None:
                leaf[rows] = self.leaf[node]
                continue
            away = self.distances(node, points[rows])
            child = np.argmin(away, axis=1)
            if see is not None:
                see(node, away, child)
            todo += [(c, rows[child == j]) for j, c in enumerate(self.children[node]) if (child == j).any()]
        return leaf

    def may_answer(self, points: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> list[np.ndarray]:
        """For every query (lifted) the leaves that may hold rows at a distance from ``inner`` to ``outer``."""
        found: list[list[int]] = [[] for _ in points]
        todo = [(0, np.arange(len(points)))]
        slack = 1e-6 * math.sqrt(self.radius2) + 1e-6
        while todo:
            node, rows = todo.pop()
            if self.points[node] is None:
                for r in rows.tolist():
                    found[r].append(self.leaf[node])
                continue
            away = self.distances(node, points[rows])
            alive = np.ones((len(rows), len(self.children[node])), bool)
            for i in range(away.shape[1]):
                d = away[:, i, None]
                low, high = self.low[node][i][None, :], self.high[node][i][None, :]
                least = np.maximum(np.maximum(low - d, d - high), 0)  # of any row of the subtree to the query
                alive &= (least <= outer[rows][:, None] + slack) & (d + high >= inner[rows][:, None] - slack)
            todo += [(c, rows[alive[:, j]]) for j, c in enumerate(self.children[node]) if alive[:, j].any()]
        return [np.array(x, np.int64) for x in found]

    def nearest(self, points: np.ndarray, leaves: int) -> list[np.ndarray]:
        """For every query the ``leaves`` leaves it meets first, going down by nearest split points."""
        out = []
        for p in points:
            found: list[int] = []
            todo = [(0.0, 0)]
            while todo and len(found) < leaves:
                todo.sort(reverse=True)
                _, node = todo.pop()
                if self.points[node] is None:
                    found.append(self.leaf[node])
                    continue
                away = self.distances(node, p[None])[0]
                todo += [(float(away[j]), c) for j, c in enumerate(self.children[node])]
            out.append(np.array(found, np.int64))
        return out


def _far_apart(points: np.ndarray, k: int) -> np.ndarray:
    """``k`` of the points, each the one farthest from those chosen before."""
    chosen = [int(np.argmax(((points - points.mean(0)) ** 2).sum(1)))]
    away = ((points - points[chosen[0]]) ** 2).sum(1)
    while len(chosen) < k and away.max() > 0:
        chosen.append(int(np.argmax(away)))
        away = np.minimum(away, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def grow(sample: np.ndarray, radius2: float, rows: int, fanout: int, leaf_rows: int, most_leaves: int) -> Tree:
    """The tree over a sample of ``rows`` rows; leaves are to hold about ``leaf_rows`` of them."""
    tree = Tree([], [], [], radius2, [], [])
    points = tree.lifted(sample)
    share = rows / max(1, len(points))
    leaves = 0

    def add() -> int:
        for x in (tree.points, tree.low, tree.high):
            x.append(None)
        tree.children.append([])
        tree.leaf.append(-1)
        return len(tree.points) - 1

    todo = [(add(), points)]
    while todo:
        todo.sort(key=lambda x: len(x[1]))
        node, own = todo.pop()
        if len(own) * share > leaf_rows and len(own) >= 4 * fanout and leaves + len(todo) + fanout <= most_leaves:
            split = _far_apart(own, fanout)
            if len(split) > 1:
                tree.points[node] = split
                child = np.argmin(tree.distances(node, own), axis=1)
                tree.children[node] = [add() for _ in split]
                todo += [(c, own[child == j]) for j, c in enumerate(tree.children[node])]
                continue
        tree.leaf[node] = leaves
        leaves += 1
    return tree


def _with_ranges(tree: Tree, rows: DataFrame, dims: int) -> Tree:
    """``tree`` with the distance ranges of all rows: each task hands on one row per node, point and subtree."""

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low: dict[int, np.ndarray] = {}
        high: dict[int, np.ndarray] = {}

        def see(node: int, away: np.ndarray, child: np.ndarray) -> None:
            k = away.shape[1]
            lo, hi = low.setdefault(node, np.full((k, k), np.inf)), high.setdefault(node, np.full((k, k), -np.inf))
            for j in np.unique(child):
                lo[:, j] = np.minimum(lo[:, j], away[child == j].min(0))
                hi[:, j] = np.maximum(hi[:, j], away[child == j].max(0))

        for batch in batches:
            tree.deal(tree.lifted(_vectors(batch.column("vec"), dims)), see)
        seen = [(n, i, j, low[n][i, j], high[n][i, j]) for n in low for i, j in zip(*np.nonzero(np.isfinite(low[n])), strict=True)]
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("node", "i", "j", "low", "high"), map(_plain, x), strict=True)) for x in seen],
            schema=pa.schema([("node", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("low", pa.float64()), ("high", pa.float64())]),
        )

    seen = rows.select("vec").mapInArrow(ranges, "node int, i int, j int, low double, high double")
    for node, split in enumerate(tree.points):
        if split is not None:
            # A subtree without rows answers nothing: its range lies beyond every ring.
            tree.low[node] = np.full((len(split), len(split)), np.inf)
            tree.high[node] = np.full((len(split), len(split)), -np.inf)
    for r in seen.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        tree.low[r.node][r.i, r.j], tree.high[r.node][r.i, r.j] = r.low, r.high
    return tree


def _plain(x):
    return x.item() if isinstance(x, np.generic) else x


@dataclass
class Index:
    """Rows by ``leaf`` and ``block``, the number of blocks of each leaf, and the tree."""

    rows: DataFrame
    blocks: dict[int, int]
    tree: Tree
    dims: int


def usable(df: DataFrame, id_column: str, label: str, vector: str) -> DataFrame:
    """``(id, label, v)`` of the rows that take part; ``v`` are doubles."""
    v = F.col(vector).cast("array<double>")
    rows = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite & (F.size("v") > 0), F.lit(False)))


def build(
    rows: DataFrame, fanout: int = 16, leaf_rows: int = 4096, most_leaves: int = 4096, sample_rows: int = 16384, block_rows: int = 4096
) -> Index:
    """Index of ``rows (id, label, v)``, ``v`` whole numbers."""
    size = rows.agg(
        F.count("*").alias("n"),
        F.max(F.size("v")).alias("dims"),
        F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("radius2"),
        F.max(F.array_max(F.transform("v", F.abs))).alias("largest"),
    ).first()
    dims, radius2, n = size["dims"] or 1, size["radius2"] or 0.0, size["n"]
    if (size["largest"] or 0) > LARGEST or radius2 >= 1 << 52:
        raise ValueError(f"components of up to {size['largest']}: products would not be exact")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch.column("v")).to_numpy()
            x = np.zeros((batch.num_rows, dims))
            x[np.arange(dims)[None, :] < sizes[:, None]] = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            x += 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "label", "vec"]
            )

    rows = stored(bounded_batches(rows.select("id", "label", "v"), 5000).mapInArrow(packed, ROW), "vectors")
    drawn = F.pmod(F.xxhash64("vec", "id"), F.lit(1 << 30)) < F.lit(float(sample_rows) * (1 << 30) / max(1, n))
    sample = sorted(bytes(r.vec) for r in rows.filter(drawn).select("vec").collect())
    points = np.frombuffer(b"".join(sample), np.float64).reshape(-1, dims)
    tree = _with_ranges(grow(points, radius2, n, fanout, leaf_rows, most_leaves), rows, dims)

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.deal(tree.lifted(_vectors(batch.column("vec"), dims)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=[*batch.schema.names, "leaf"])

    dealt = stored(rows.mapInArrow(leaves, f"{ROW}, leaf int"), "leaves")
    # At most ``most_leaves`` counts come to the driver.
    blocks = {r.leaf: math.ceil(r.n / block_rows) for r in dealt.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    sizes = F.broadcast(rows.sparkSession.createDataFrame(list(blocks.items()), "leaf int, blocks int"))
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = dealt.join(sizes, "leaf").select("id", "label", "vec", "leaf", block.alias("block"))
    return Index(placed, blocks, tree, dims)


def _routes(index: Index, wanted: DataFrame, first: int, again: bool) -> DataFrame:
    """``wanted (id, vec, goals)`` with the places to search, one row per leaf and block.

    ``goals`` are (goal, least, most) products. Of a first search, the ``first`` nearest leaves; of a second, the others
    that may answer any goal.
    """
    tree, blocks, dims = index.tree, index.blocks, index.dims

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            q = _vectors(batch.column("vec"), dims)
            points = np.concatenate([q, np.zeros((len(q), 1))], 1)
            near = tree.nearest(points, first)
            if again:
                goals = batch.column("goals").to_pylist()
                # Distances of the widest ring: a goal's least product is its largest distance.
                base = (q**2).sum(1) + tree.radius2
                least = np.array([min(float(g["least"]) for g in x) for x in goals])
                most = np.array([max(float(g["most"]) for g in x) for x in goals])
                outer = np.sqrt(np.maximum(0, base - 2 * np.maximum(least, -base)))
                inner = np.sqrt(np.maximum(0, base - 2 * np.minimum(most, base)))
                places = [np.setdiff1d(x, y) for x, y in zip(tree.may_answer(points, inner, outer), near, strict=True)]
            else:
                places = near
            row = [i for i, x in enumerate(places) for leaf in x.tolist() for _ in range(blocks.get(leaf, 0))]
            leaf = [leaf for x in places for leaf in x.tolist() for _ in range(blocks.get(leaf, 0))]
            block = [b for x in places for leaf in x.tolist() for b in range(blocks.get(leaf, 0))]
            out = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*out.columns, pa.array(leaf, pa.int32()), pa.array(block, pa.int32())], names=[*out.schema.names, "leaf", "block"]
            )

    fields = "id bigint, label bigint, vec binary, goals array<struct<goal: bigint, least: bigint, most: bigint>>"
    return bounded_batches(wanted.select("id", "label", "vec", "goals")).mapInArrow(route, f"{fields}, leaf int, block int")


def _search(index: Index, wanted: DataFrame, same_label: bool, top: int, first: int, again: bool, chunk_rows: int) -> DataFrame:
    """``(id, goal, found, score)``: of each place searched the ``top`` best rows for every goal."""
    dims = index.dims
    routes = stored(_routes(index, wanted, first, again), "routes")
    # A place asked by more queries than one task may hold is searched by several.
    asked = routes.groupBy("leaf", "block").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks"))
    routes = routes.join(asked, ["leaf", "block"]).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    rows = index.rows.join(asked, ["leaf", "block"])
    rows = rows.select("id", "label", "vec", "leaf", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))

    def best(key: tuple, queries: pa.Table, rows: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        if rows.num_rows and queries.num_rows:
            ids, labels = rows.column("id").to_numpy(), rows.column("label").to_numpy()
            x = _vectors(rows.column("vec"), dims)
            by = np.lexsort((*x.T[::-1], labels, ids)) if len(np.unique(ids)) < len(ids) else np.argsort(ids)
            ids, labels, x = ids[by], labels[by], x[by]
            # Rows equal in id, label and vector stand together now and are one.
            again_ = np.concatenate(([False], (ids[1:] == ids[:-1]) & (labels[1:] == labels[:-1]) & (x[1:] == x[:-1]).all(1)))
            ids, labels, x = ids[~again_], labels[~again_], x[~again_]
            q = _vectors(queries.column("vec"), dims)
            asked_by, own = queries.column("id").to_numpy(), queries.column("label").to_numpy()
            goals = queries.column("goals").to_pylist()
            for low in range(0, len(q), 256):
                scores = q[low : low + 256] @ x.T
                for i in range(len(scores)):
                    k = low + i
                    fit = ((labels == own[k]) == same_label) & (ids != asked_by[k])
                    place = np.flatnonzero(fit)
                    score = scores[i, place]
                    for g in goals[k]:
                        inside = np.flatnonzero((score >= g["least"]) & (score <= g["most"]))
                        if len(inside) > top:
                            limit = -np.partition(-score[inside], top - 1)[top - 1]
                            inside = inside[score[inside] >= limit]
                        inside = inside[np.argsort(-score[inside], kind="stable")][:top]  # ids ascend: ties go to the smaller
                        for column, values in zip(
                            out, (np.full(len(inside), asked_by[k]), np.full(len(inside), g["goal"]), ids[place[inside]], score[inside]), strict=True
                        ):
                            column.append(values)
        columns = [np.concatenate(c).astype(np.int64) if c else np.empty(0, np.int64) for c in out]
        return pa.table(dict(zip(("id", "goal", "found", "score"), columns, strict=True)))

    place = ("leaf", "block", "chunk")
    pairs = routes.groupBy(*place).cogroup(rows.groupBy(*place))
    return stored(pairs.applyInArrow(best, "id bigint, goal bigint, found bigint, score bigint"), "found")


def _top(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("id", "goal").orderBy(F.desc("score"), "found")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def nearest(index: Index, wanted: DataFrame, same_label: bool, top: int, first: int = 2, chunk_rows: int = 2048) -> DataFrame:
    """``(id, goal, found, score, rank)``: for each goal of each query the ``top`` best rows of the same label, or of others.

    ``wanted`` has ``id, label, vec, goals``; a goal (goal, least, most) asks for products from least to most.
    """
    near = _search(index, wanted, same_label, top, first, False, chunk_rows)
    bound = F.when(F.count("*") >= top, F.min("score"))
    bounds = _top(near, top).groupBy("id", "goal").agg(bound.alias("bound")).filter("bound IS NOT NULL")
    goals = wanted.select("id", "label", "vec", F.inline("goals")).join(bounds, ["id", "goal"], "left")
    goal = F.struct("goal", F.greatest("least", F.coalesce("bound", "least")).alias("least"), "most")
    tighter = goals.groupBy("id", "label", "vec").agg(F.collect_list(goal).alias("goals"))
    rest = _search(index, tighter, same_label, top, first, True, chunk_rows)
    return _top(near.unionByName(rest), top)


def mine(index: Index, anchors: Column, positives: int = 5, negatives: int = 5, percent: int = 80) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Anchors are the index's rows for which ``anchors`` holds. Their positives are the best rows of their label; the hard
    negatives of a positive are the best rows of other labels with a score from ``percent`` % of its score up to its score.
    """
    everything = F.array(F.struct(F.lit(0).cast("bigint").alias("goal"), F.lit(-(1 << 53)).alias("least"), F.lit(1 << 53).alias("most")))
    asking = index.rows.filter(anchors).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("first"))
    wanted = stored(asking.select("id", "first.*", everything.alias("goals")), "anchors")
    found = stored(nearest(index, wanted, True, positives), "positives").withColumn("place", F.col("rank").cast("bigint"))
    least = F.expr(f"(({int(percent)} * score + 99) div 100)")
    window = F.struct(F.col("place").alias("goal"), least.alias("least"), F.col("score").alias("most"))
    # No product is from 80 % of a negative number up to it.
    goals = found.filter("score >= 0").groupBy("id").agg(F.collect_list(window).alias("goals"))
    hard = nearest(index, wanted.drop("goals").join(goals, "id"), False, negatives)
    scores = found.select("id", F.col("place").alias("goal"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    return hard.join(scores, ["id", "goal"]).select(
        F.col("id").alias("anchor_id"),
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("found").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
