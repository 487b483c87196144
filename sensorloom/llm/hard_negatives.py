"""Hard negatives by exact search in a multiway hyperplane tree whose split points keep distance ranges to sibling subtrees."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import discard, staged

FAR = np.inf


class Tree:
    """A multiway hyperplane tree over vectors of equal length once `height` is added to them as a last component.

    A row belongs to the child of its nearest split point. `low[i, j]` and `high[i, j]` of a node bound the distances from its split
    point i to all rows below child j. Nodes are numbered from the root, 0; children are nodes or, below zero, leaves.
    """

    def __init__(self, points: list[np.ndarray], heights: list[np.ndarray], children: list[np.ndarray], leaves: int):
        self.points, self.heights, self.children, self.leaves = points, heights, children, leaves
        self.low = [np.full((len(p), len(p)), FAR) for p in points]
        self.high = [np.full((len(p), len(p)), -FAR) for p in points]

    @staticmethod
    def grow(x: np.ndarray, height: np.ndarray, fanout: int, leaf: int, most: int, seed: int = 7) -> Tree:
        """Split points chosen far from each other, node by node, largest node first, until leaves hold `leaf` rows or are `most`."""
        rng = np.random.default_rng(seed)
        points, heights, children, leaves = [], [], [], 1
        open_nodes = [(np.arange(len(x)), None)]
        closed: list[tuple[int, int]] = []
        while open_nodes:
            open_nodes.sort(key=lambda o: len(o[0]))
            rows, place = open_nodes.pop()
            m = min(fanout, most - leaves + 1, math.ceil(len(rows) / leaf))
            own = choose_far(x[rows], height[rows], m, rng) if m > 1 else []
            if len(own) < 2:  # small enough, or one point repeated
                closed.append(place)
                continue
            node = len(points)
            if place is not None:
                children[place[0]][place[1]] = node
            points.append(x[rows[own]])
            heights.append(height[rows[own]])
            children.append(np.zeros(len(own), np.int64))
            leaves += len(own) - 1
            child = distances(x[rows], height[rows], points[node], heights[node]).argmin(1)
            open_nodes += [(rows[child == j], (node, j)) for j in range(len(own))]
        if points:
            for number, (node, j) in enumerate(closed):
                children[node][j] = ~number
        return Tree(points, heights, children, len(closed))

    def route(self, x: np.ndarray, height: np.ndarray, widen: Callable[[int, np.ndarray, np.ndarray], None] | None = None) -> np.ndarray:
        """The leaf of every row; `widen` gets each node with its rows' distances and children on the way."""
        leaf = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))] if self.points else []
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            d = distances(x[rows], height[rows], self.points[node], self.heights[node])
            child = d.argmin(1)
            if widen:
                widen(node, d, child)
            for j, below in enumerate(self.children[node].tolist()):
                mine = rows[child == j]
                if below < 0:
                    leaf[mine] = ~below
                else:
                    todo.append((below, mine))
        return leaf

    def fit_ranges(self, x: np.ndarray, height: np.ndarray) -> np.ndarray:
        """Widen the ranges by rows; their leaves come back."""
        def widen(node: int, d: np.ndarray, child: np.ndarray) -> None:
            for j in np.unique(child).tolist():
                self.low[node][:, j] = np.minimum(self.low[node][:, j], d[child == j].min(0))
                self.high[node][:, j] = np.maximum(self.high[node][:, j], d[child == j].max(0))

        return self.route(x, height, widen)

    def survivors(self, x: np.ndarray, height: np.ndarray, near: np.ndarray, far: np.ndarray, slack: float) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, queries) that may hold a row at a distance from `near` to `far` of a query.

        `near` and `far` have a row per query and a column per annulus. A child is eliminated for a query if some split
        point's range to it, turned into a range of distances to the query, meets none of the query's annuli.
        """
        if not self.points:
            yield 0, np.arange(len(x))
            return
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            d = distances(x[rows], height[rows], self.points[node], self.heights[node])
            low, high = self.low[node], self.high[node]
            for j, below in enumerate(self.children[node].tolist()):
                filled = low[:, j] <= high[:, j]
                if not filled.any():
                    continue
                least = np.maximum(d - high[:, j], low[:, j] - d).max(1)  # triangle inequality, each split point's bound
                most = (d + high[:, j]).min(1)
                meets = ((near[rows] <= most[:, None] + slack) & (far[rows] >= least[:, None] - slack)).any(1)
                if not meets.any():
                    continue
                if below < 0:
                    yield ~below, rows[meets]
                else:
                    todo.append((below, rows[meets]))


def distances(x: np.ndarray, height: np.ndarray, points: np.ndarray, heights: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows to points, both with their heights as one more component."""
    squares = (x * x).sum(1)[:, None] + (points * points).sum(1) - 2 * (x @ points.T) + (height[:, None] - heights) ** 2
    return np.sqrt(np.maximum(squares, 0))


def choose_far(x: np.ndarray, height: np.ndarray, m: int, rng: np.random.Generator) -> list[int]:
    """Up to m rows at different places: of a few times as many at random, each the farthest from those before it."""
    pool = rng.choice(len(x), min(len(x), 4 * m), replace=False)
    own = [int(pool[0])]
    gap = distances(x[pool], height[pool], x[own], height[own])[:, 0]
    while len(own) < m and gap.max() > 0:
        own.append(int(pool[gap.argmax()]))
        gap = np.minimum(gap, distances(x[pool], height[pool], x[own[-1:]], height[own[-1:]])[:, 0])
    return own


def labelled(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", scale: int = 256,
             swap: int | None = 7, labels: int = 10) -> DataFrame:
    """(id, label, x ARRAY<DOUBLE> of whole numbers, size, norm) of the rows that take part.

    Left out: rows with a null id, label or vector, an empty vector, or any null or non-finite component. Components become
    floor(scale * x). Where the id is divisible by `swap` the label is moved on by one, modulo `labels`. Of rows with the same
    id the one with the smallest label, then vector, counts.
    """
    v = F.col(embedding).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kind = F.col(label).cast("long")
    if swap:
        kind = F.when(F.col(vec_id) % swap == 0, (kind + 1) % labels).otherwise(kind)
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & v.isNotNull()).where(fine & (F.size(v) > 0)).select(
        F.col(vec_id).cast("long").alias("id"), kind.alias("label"),
        F.transform(v, lambda c: F.floor(c * scale).cast("double")).alias("x"))
    one = rows.groupBy("id").agg(F.min(F.struct("label", "x")).alias("r")).select("id", "r.label", "r.x")
    return one.withColumn("size", F.size("x")).withColumn("norm", F.aggregate("x", F.lit(0.0), lambda s, c: s + c * c))


BLOCK = "size int, cell int, part int, n int, ids binary, labels binary, x binary, heights binary"


class Index:
    """A tree of `cells` over all rows, of one vector size, and blocks of its cells' rows with a tree in each."""

    def __init__(self, size: int, tree: Tree, top: float, blocks: DataFrame, parts: dict[int, int]):
        self.size, self.tree, self.top, self.blocks, self.parts = size, tree, top, blocks, parts

    @property
    def slack(self) -> float:
        """More than what rounding can move a distance."""
        return 1e-6 * (1 + math.sqrt(self.top))


def build_index(rows: DataFrame, size: int, block: int = 4096, cells: int = 1024, sample: int = 16384, fanout: int = 16, seed: int = 7) -> Index:
    """Index all rows of `labelled` with vectors of `size` components.

    Vectors get a last component that makes them all as long as the longest, so that the nearest are those of the largest inner
    product. The tree of at most `cells` cells is grown on the driver from a sample of about `sample` rows; both are bounds
    whatever the table holds. Every row goes down it in its own task; the ranges are minima and maxima over every row, taken in
    the tasks first. A cell of more than `block` rows is dealt to parts by a hash of the id, so neither a crowded place nor one
    vector in many rows becomes one group.
    """
    total, top = rows.agg(F.count("*"), F.coalesce(F.max("norm"), F.lit(0.0))).first()
    if top * 4 >= 2.0 ** 53:
        raise ValueError("inner products of these vectors are not exact in double precision")
    some = rows.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < int(min(1.0, sample / max(total, 1)) * (1 << 30))).limit(2 * sample)
    taken = some.select("id", "x", "norm").orderBy("id").toPandas()
    x = np.array(taken["x"].tolist(), np.float64).reshape(-1, size)
    height = np.sqrt(top - taken["norm"].to_numpy(np.float64))
    wanted = min(cells, math.ceil(total / block))
    tree = Tree.grow(x, height, fanout, max(1, math.ceil(len(x) / max(1, wanted))), wanted, seed)

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.asarray(batch.column("x").flatten()).reshape(-1, size)
            cell = tree.route(v, np.sqrt(top - batch.column("norm").to_numpy()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], [*batch.schema.names, "cell"])

    placed = staged(rows.mapInArrow(down, "id long, label long, x array<double>, size int, norm double, cell int"))

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tree(tree.points, tree.heights, tree.children, tree.leaves)
        for batch in batches:
            own.fit_ranges(np.asarray(batch.column("x").flatten()).reshape(-1, size), np.sqrt(top - batch.column("norm").to_numpy()))
        out = [(k, i, j, low, high) for k, (lows, highs) in enumerate(zip(own.low, own.high, strict=True))
               for i in range(len(lows)) for j, (low, high) in enumerate(zip(lows[i].tolist(), highs[i].tolist(), strict=True)) if low <= high]
        cols = list(zip(*out, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int32()] * 3 + [pa.float64()] * 2, strict=True)], ["k", "i", "j", "low", "high"])

    if tree.points:
        for r in placed.select("x", "norm").mapInArrow(ranges, "k int, i int, j int, low double, high double").groupBy("k", "i", "j").agg(
                F.min("low").alias("low"), F.max("high").alias("high")).collect():  # a bounded number: the tree's own
            tree.low[r.k][r.i, r.j], tree.high[r.k][r.i, r.j] = r.low, r.high
    parts = {r.cell: math.ceil(r["count"] / block) for r in placed.groupBy("cell").count().collect()}
    crowded = [F.lit(x) for cell, n in parts.items() if n > 1 for x in (cell, n)]
    split = F.coalesce(F.try_element_at(F.create_map(*crowded), F.col("cell")), F.lit(1)) if crowded else F.lit(1)

    def pack(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        v = np.array(group["x"].tolist(), np.float64).reshape(-1, size)
        return pd.DataFrame([{
            "size": size, "cell": key[0], "part": key[1], "n": len(group), "ids": group["id"].to_numpy("<i8").tobytes(),
            "labels": group["label"].to_numpy("<i8").tobytes(), "x": v.astype("<f8").tobytes(),
            "heights": np.sqrt(top - group["norm"].to_numpy(np.float64)).astype("<f8").tobytes()}])

    dealt = placed.withColumn("part", F.pmod(F.xxhash64("id"), split.cast("long")).cast("int"))
    blocks = staged(dealt.groupBy("cell", "part").applyInPandas(pack, BLOCK))
    discard(placed)
    return Index(size, tree, top, blocks, parts)


def annuli(index: Index, squares: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances to a query of squared length `squares` that scores from `low` to `high` stand for."""
    base = index.top + squares[:, None]
    with np.errstate(invalid="ignore"):
        near = np.sqrt(np.maximum(base - 2 * np.where(np.isinf(high), base, high), 0))
        far = np.where(np.isneginf(low), FAR, np.sqrt(np.maximum(base - 2 * np.where(np.isneginf(low), 0, low), 0)))
    return np.where(low > high, FAR, near), np.where(low > high, -FAR, far)


def search(index: Index, queries: DataFrame, k: int, same: bool, query_block: int = 1024, leaf: int = 256, fanout: int = 16) -> DataFrame:
    """The best k rows in each window of each query: (query_id, window, id, score), exact.

    `queries` has (id, label, x, norm, lows ARRAY<DOUBLE>, highs ARRAY<DOUBLE>): a window takes scores from low to high. Rows
    of the query's label are looked at if `same`, rows of other labels else, never the query's own; higher scores are better, ties go
    to the smaller id. Queries meet the block they would lie in first; what they find there raises their lower bounds, and only cells
    and leaves whose ranges still meet an annulus are read after that.
    """
    size, slack = index.size, index.slack
    q_schema = "q_ids binary, q_labels binary, q binary, lows binary, highs binary, windows int"
    tree, top, parts = index.tree, index.top, index.parts

    def deal(home: bool):
        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids, v = batch.column("id"), np.asarray(batch.column("x").flatten()).reshape(-1, size)
                lows = np.asarray(batch.column("lows").flatten()).reshape(len(v), -1)
                highs = np.asarray(batch.column("highs").flatten()).reshape(len(v), -1)
                squares = batch.column("norm").to_numpy()
                cell = tree.route(v, np.zeros(len(v)))
                if home:
                    met = [(c, np.flatnonzero(cell == c)) for c in np.unique(cell).tolist()]
                else:
                    near, far = annuli(index_like, squares, lows, highs)
                    met = [(c, rows[cell[rows] != c]) for c, rows in tree.survivors(v, np.zeros(len(v)), near, far, slack)]
                out = [(c, part, rows[a:a + query_block]) for c, rows in met for a in range(0, len(rows), query_block) for part in range(parts.get(c, 0))]
                columns = [pa.array([c for c, _, _ in out], pa.int32()), pa.array([p for _, p, _ in out], pa.int32())]
                for values in (np.asarray(ids), np.asarray(batch.column("label")), v, lows, highs):
                    columns.append(pa.array([values[rows].tobytes() for _, _, rows in out], pa.binary()))
                columns.append(pa.array([lows.shape[1]] * len(out), pa.int32()))
                yield pa.RecordBatch.from_arrays(columns, ["cell", "part", "q_ids", "q_labels", "q", "lows", "highs", "windows"])

        return cut

    index_like = Index(size, tree, top, None, parts)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in batch.to_pylist():
                found = best_in_block(index_like, pair, k, same, leaf, fanout)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[0]), pa.array(found[1].astype(np.int32)), pa.array(found[2]), pa.array(found[3])], ["query_id", "window", "id", "score"])

    def run(home: bool, asked: DataFrame) -> DataFrame:
        packets = asked.select("id", "label", "x", "norm", "lows", "highs").mapInArrow(deal(home), f"cell int, part int, {q_schema}")
        met = packets.join(index.blocks.drop("size").hint("merge"), ["cell", "part"])
        return met.mapInArrow(scan, "query_id long, window int, id long, score double")

    order = Window.partitionBy("query_id", "window").orderBy(F.desc("score"), "id")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = staged(best(run(True, queries)).drop("rank"))
    bounds = first.groupBy("query_id", "window").agg(F.min("score").alias("s"), F.count("*").alias("n")).where(F.col("n") == k).groupBy("query_id").agg(
        F.map_from_entries(F.collect_list(F.struct("window", "s"))).alias("reached"))
    raised = queries.join(bounds, queries["id"] == bounds["query_id"], "left").withColumn(
        "lows", F.when(F.col("reached").isNull(), F.col("lows")).otherwise(
            F.transform("lows", lambda low, w: F.greatest(low, F.coalesce(F.try_element_at("reached", w), F.lit(float("-inf")))))))
    rest = staged(run(False, raised))
    out = staged(best(first.union(rest)))
    discard(first)
    discard(rest)
    return out


def best_in_block(index: Index, pair: dict, k: int, same: bool, leaf: int, fanout: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query id, window, id, score) of the best k of a block's rows in each window of each query of a packet, by the block's own tree."""
    size, n = index.size, pair["n"]
    ids, labels = np.frombuffer(pair["ids"], "<i8"), np.frombuffer(pair["labels"], "<i8")
    x, heights = np.frombuffer(pair["x"], "<f8").reshape(n, size), np.frombuffer(pair["heights"], "<f8")
    q_ids, q_labels = np.frombuffer(pair["q_ids"], "<i8"), np.frombuffer(pair["q_labels"], "<i8")
    q = np.frombuffer(pair["q"], "<f8").reshape(len(q_ids), size)
    low = np.frombuffer(pair["lows"], "<f8").reshape(len(q_ids), -1).copy()
    high = np.frombuffer(pair["highs"], "<f8").reshape(len(q_ids), -1)
    squares = (q * q).sum(1)
    tree = Tree.grow(x, heights, fanout, leaf, n, seed=3)
    leaf_of = tree.fit_ranges(x, heights)
    members = np.split(np.argsort(leaf_of, kind="stable"), np.cumsum(np.bincount(leaf_of, minlength=max(1, tree.leaves)))[:-1])
    near, far = annuli(index, squares, low, high)
    found: list[tuple[np.ndarray, ...]] = []
    for number, rows in tree.survivors(q, np.zeros(len(q)), near, far, index.slack):
        own = members[number]
        scores = q[rows] @ x[own].T
        fits = (labels[own] == q_labels[rows, None]) == same
        fits &= ids[own] != q_ids[rows, None]
        scores[~fits] = -np.inf
        for w in range(low.shape[1]):
            # Rows within the window and not below the k-th best so far; rows of a leaf come by id.
            inside = (scores >= low[rows, w, None]) & (scores <= high[rows, w, None]) & (scores > -np.inf)
            hit = np.flatnonzero(inside.any(1))
            if not len(hit):
                continue
            s = np.where(inside[hit], scores[hit], -np.inf)
            order = np.argsort(-s, axis=1, kind="stable")[:, :k]
            s = np.take_along_axis(s, order, 1)
            at, nth = np.nonzero(s > -np.inf)
            found.append((rows[hit][at], np.full(len(at), w), ids[own[order[at, nth]]], s[at, nth]))
            if order.shape[1] == k:
                low[rows[hit], w] = np.maximum(low[rows[hit], w], s[:, k - 1])
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0)
    of, window, other, score = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((other, -score, window, of))
    key = of[order] * low.shape[1] + window[order]
    nth = np.arange(len(order)) - np.searchsorted(key, key, "left")
    order = order[nth < k]
    return q_ids[of[order]], window[order], other[order], score[order]


def hard_negatives(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", every: int = 50,
                   positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, **index_options) -> DataFrame:
    """Hard negatives of anchors: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are rows whose id is divisible by `every`; scores are inner products of whole-number vectors. An anchor's positives are
    its best `positives` other rows of the same label; for each, the best `negatives` rows of another label whose score is from
    `least` to `most` per cent of the positive's are returned. Higher scores are better, ties go to the smaller id. Positives
    and negatives both come from the tree: the first with an open window, the others with a window for each positive, whose
    ends are annuli of distance around the anchor.

    Rows that `labelled` leaves out take no part; vectors meet those of their own length; rows that repeat an id count once; labels
    of any value may occur, and an anchor alone with its label has no positives and no rows. Other columns are not looked
    at. An empty table gives an empty result.
    """
    rows = staged(labelled(vectors, vec_id, embedding, label))
    sizes = [r["size"] for r in rows.select("size").distinct().orderBy("size").collect()]
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    out = vectors.sparkSession.createDataFrame([], schema)
    for size in sizes:
        own = rows.where(F.col("size") == size)
        index = build_index(own, size, **index_options)
        anchors = own.where(F.col("id") % every == 0)
        open_window = anchors.withColumn("lows", F.array(F.lit(float("-inf")))).withColumn("highs", F.array(F.lit(float("inf"))))
        best = search(index, open_window, positives, same=True)
        # A window without room, as below a negative score, is left as it is and holds nothing.
        windows = staged(best.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("p")).join(
            anchors.hint("merge"), F.col("query_id") == anchors["id"]).select(
            anchors["id"], "label", "x", "norm", "p",
            F.transform("p", lambda p: F.ceil(p["score"] * least / 100).cast("double")).alias("l"),
            F.transform("p", lambda p: F.floor(p["score"] * most / 100).cast("double")).alias("h")))
        # All anchors of a packet have as many windows; missing ones are empty.
        empty = F.array_repeat(F.lit(float("inf")), positives), F.array_repeat(F.lit(float("-inf")), positives)
        padded = windows.select("id", "label", "x", "norm", F.slice(F.concat("l", empty[0]), 1, positives).alias("lows"),
                                F.slice(F.concat("h", empty[1]), 1, positives).alias("highs"))
        mined = search(index, padded, negatives, same=False)
        found = mined.join(windows.select(F.col("id").alias("query_id"), "p"), "query_id").withColumn("pos", F.element_at("p", F.col("window") + 1))
        out = out.union(found.select(
            F.col("query_id").alias("anchor_id"), F.col("pos.id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
            F.col("pos.score").cast("long").alias("positive_score"), F.col("score").cast("long").alias("negative_score")))
        discard(best)
        discard(index.blocks)
    return out
