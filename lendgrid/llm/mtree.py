"""Exact top-k by inner product: best-first search in M-trees of pages."""

from __future__ import annotations

import heapq
import pickle
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .scratch import Tables, few, written
from .vectors import matrix, usable

#: Vectors of a tree, entries of a page, queries of a block, and partitions at most.
TREE_ROWS, PAGE, BLOCK, WIDEST = 8192, 256, 256, 20_000


class Tree:
    """Vectors of integers in pages of at most ``PAGE`` entries.

    Every vector gets one more coordinate that lifts it to the largest norm, so the Euclidean
    distance to a query (lifted by 0) falls as the inner product grows, and the metric's triangle
    inequality holds. An entry of an inner page is a routing vector with covering radius and child;
    every entry stores its distance to its page's own routing vector.
    """

    def __init__(self, ids: np.ndarray, v: np.ndarray):
        self.square = float((v * v).sum(axis=1).max(initial=0))
        self.ids = ids
        self.pages: list[tuple] = []
        lift = np.sqrt(np.maximum(self.square - (v * v).sum(axis=1), 0))
        self.root = self._page(np.arange(len(ids)), v, lift, None, np.random.default_rng(len(ids)))

    def _gap(self, v, lift, k, at):
        return np.sqrt(np.maximum(((v[at] - v[k]) ** 2).sum(axis=1) + (lift[at] - lift[k]) ** 2, 0))

    def _page(self, at: np.ndarray, v, lift, parent, rng) -> int:
        to_parent = self._gap(v, lift, parent, at) if parent is not None else np.zeros(len(at))
        if len(at) <= PAGE:
            self.pages.append((True, at, v[at], to_parent, None, None))
            return len(self.pages) - 1
        pivots = at[rng.choice(len(at), min(PAGE, -(-len(at) // (PAGE // 2))), replace=False)]
        gaps = np.stack([self._gap(v, lift, k, at) for k in pivots])
        owner = gaps.argmin(axis=0)
        if len(np.unique(owner)) == 1:  # equal vectors: split by position
            owner = np.arange(len(at)) % len(pivots)
        own = np.unique(owner)
        parts = [at[owner == i] for i in own]
        radius = np.array([gaps[i, owner == i].max() for i in own])
        children = [self._page(part, v, lift, pivots[i], rng) for i, part in zip(own, parts)]
        routes = pivots[own]
        gap = self._gap(v, lift, parent, routes) if parent is not None else np.zeros(len(own))
        self.pages.append((False, routes, v[routes], gap, radius, children))
        return len(self.pages) - 1

    def top(self, own: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, -vec_id) without the vector ``own``; equal scores go by the smaller id.

        A page or entry is skipped only if its distance is certainly above the k-th best; entries whose
        stored parent distance already shows that are skipped before their distance is computed.
        """
        both = float(q @ q) + self.square
        slack = 1e-6 * (1 + np.sqrt(both))
        best: list[tuple[int, int]] = []
        worst = np.inf
        todo = [(0.0, 0, self.root, None)]
        count = 0
        while todo:
            bound, _, page, to_route = heapq.heappop(todo)
            if bound > worst:
                break
            leaf, at, v, gap, radius, children = self.pages[page]
            if to_route is not None and worst < np.inf:
                near = np.abs(to_route - gap) - (0 if leaf else radius) <= worst
                if not near.all():
                    at, v = at[near], v[near]
                    if not leaf:
                        radius, children = radius[near], [c for c, y in zip(children, near) if y]
                    if not len(at):
                        continue
            score = v @ q
            if leaf:
                order = np.flatnonzero(score >= best[0][0]) if len(best) == k else range(len(score))
                for i in order:
                    name = int(self.ids[at[i]])
                    if name == own:
                        continue
                    entry = (int(score[i]), -name)
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                if len(best) == k:
                    worst = np.sqrt(max(both - 2.0 * best[0][0], 0.0)) + slack
            else:
                dist = np.sqrt(np.maximum(both - 2.0 * score, 0))
                low = np.maximum(dist - radius, 0)
                for i in np.flatnonzero(low <= worst):
                    count += 1
                    heapq.heappush(todo, (float(low[i]), count, children[i], float(dist[i])))
        return best


def _integers(column) -> np.ndarray:
    return np.floor(matrix(column) * 256.0)


def _grow(tree_rows: int):
    """Rows (dim, tree): every ``tree_rows`` vectors of one length in a partition, and what is left of each at its end."""

    def grow(batches):
        held: dict[int, list] = defaultdict(list)

        def tree(dim):
            ids, rows = zip(*held.pop(dim))
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([pickle.dumps(Tree(np.concatenate(ids), np.concatenate(rows)))], pa.binary())], ["dim", "tree"])

        for batch in batches:
            for dim, names, v in _by_length(batch):
                while len(v):
                    room = tree_rows - sum(len(x) for x, _ in held[dim])
                    held[dim].append((names[:room], v[:room]))
                    names, v = names[room:], v[room:]
                    if sum(len(x) for x, _ in held[dim]) == tree_rows:
                        yield tree(dim)
        for dim in list(held):
            yield tree(dim)

    return grow


def _by_length(batch):
    """(length, ids, vectors) of each length in a batch of ids and vectors."""
    size = np.diff(batch.column(1).offsets.to_numpy())
    for dim in np.unique(size):
        b = batch.filter(pa.array(size == dim))
        yield int(dim), b.column(0).to_numpy(zero_copy_only=False), _integers(b.column(1))


def _blocks(batches):
    for batch in batches:
        for dim, names, v in _by_length(batch):
            for at in range(0, len(v), BLOCK):
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([pickle.dumps((names[at : at + BLOCK], v[at : at + BLOCK]))], pa.binary())], ["dim", "block"])


def _search(k: int):
    """Rows (slot, kind, payload) in order, a slot's tree (kind 0) before its blocks -> each block's best in the tree."""

    def search(batches):
        tree = None
        for batch in batches:
            for kind, payload in zip(batch.column(1).to_pylist(), batch.column(2)):
                if kind == 0:
                    tree = pickle.loads(payload.as_py())
                    continue
                names, v = pickle.loads(payload.as_py())
                rows = [(int(n), -i, s) for n, q in zip(names, v) for s, i in tree.top(int(n), q, k)]
                yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(3)], ["query_id", "vec_id", "score"])

    return search


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = 5, tree_rows: int = TREE_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of ``vectors`` for each row of ``queries``, exactly.

    Both have vec_id and embedding; each component x counts as floor(256 x). Vectors go into trees of up to
    ``tree_rows`` of one length, in about as few partitions as that takes, written as rows and numbered; queries go into
    blocks, and each block to every tree of its length. A tree and its blocks have a partition of their own, so
    neither side is ever whole in one task, and each tree sends k rows a query. All lengths are one job. A query
    never finds its own vec_id. Equal scores: smaller vec_id first. Vectors null or with null or non-finite components take
    no part; without others a query has fewer rows or none. Repeated rows count each; empty tables give none; other columns are not read.
    """
    fit = lambda d: d.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null").where(usable(F.col("embedding")) & (F.size("embedding") > 0))
    v, q = fit(vectors), fit(queries)
    with Tables() as tables:
        most = max(1, -(-vectors.count() // tree_rows))
        trees = tables.written(v.coalesce(most).mapInArrow(_grow(tree_rows), "dim int, tree binary").withColumn("name", F.monotonically_increasing_id()))
        number = (F.row_number().over(Window.orderBy("dim", "name")) - 1).cast("int")  # of names alone: a row for each thousands of vectors
        slots = tables.written(trees.select("dim", "name", number.alias("slot")))
        n = slots.count()
        blocks = q.mapInArrow(_blocks, "dim int, block binary").join(few(slots.select("dim", "slot")), "dim")
        rows = trees.join(few(slots.select("name", "slot")), "name").select("slot", F.lit(0).alias("kind"), F.col("tree").alias("payload"))
        rows = rows.union(blocks.select("slot", F.lit(1), "block"))
        rows = rows.repartitionById(max(1, min(n, WIDEST)), F.col("slot") % max(1, min(n, WIDEST))).sortWithinPartitions("slot", "kind")
        found = rows.mapInArrow(_search(k), "query_id long, vec_id long, score long")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return written(found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k))
