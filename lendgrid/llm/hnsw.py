"""Near-duplicate vectors over hierarchical navigable small-world graphs, one per shard."""

from __future__ import annotations

import heapq
import pickle
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .components import connected_components
from .scratch import Tables, few, written
from .vectors import matrix, nonzero, usable

SHARD_ROWS, LINKS, BUILD_BEAM, BEAM, WIDEST, AUDITED, SIMILAR = 8192, 12, 40, 24, 384, 48, 0.98
#: Partitions that graphs are spread over at most.
WIDE = 20_000


class Graph:
    """A small-world graph over unit vectors, built by insertion in id order from a fixed seed."""

    def __init__(self, unit: np.ndarray, seed: int = 7):
        self.v = unit
        n = len(unit)
        rng = np.random.default_rng(seed)
        self.level = np.minimum((-np.log(1 - rng.random(n)) / np.log(LINKS)).astype(int), 8)
        self.near: list[dict[int, list[int]]] = [{} for _ in range(int(self.level.max(initial=0)) + 1)]
        self.entry = -1
        for k in range(n):
            self._insert(k)

    def _insert(self, k: int) -> None:
        top = int(self.level[k])
        for layer in range(top + 1):
            self.near[layer][k] = []
        if self.entry < 0:
            self.entry = k
            return
        q, start, highest = self.v[k], [self.entry], int(self.level[self.entry])
        for layer in range(highest, -1, -1):
            if layer > top:
                start = [self.beam(q, start, 1, layer)[0][1]]
                continue
            found = self.beam(q, start, BUILD_BEAM, layer)
            most = LINKS * 2 if layer == 0 else LINKS
            chosen = self._spread(found, LINKS)
            self.near[layer][k] = chosen
            for j in chosen:
                links = self.near[layer][j]
                links.append(k)
                if len(links) > most:
                    sims = self.v[links] @ self.v[j]
                    self.near[layer][j] = self._spread(sorted(zip(sims.tolist(), links), reverse=True), most)
            start = [j for _, j in found]
        if top > highest:
            self.entry = k

    def _spread(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Nearest first, those nearer to a chosen one than to the centre put last: links lead in all directions."""
        if len(found) <= most:
            return [j for _, j in found]
        ids = [j for _, j in found]
        near = self.v[ids] @ self.v[ids].T
        chosen, rest = [], []
        for i, (s, _) in enumerate(found):
            (rest if chosen and near[i, chosen].max() > s else chosen).append(i)
            if len(chosen) == most:
                break
        return [ids[i] for i in (chosen + rest)[:most]]

    def beam(self, q: np.ndarray, start: list[int], width: int, layer: int = 0) -> list[tuple[float, int]]:
        """Best-first search that keeps the ``width`` most similar; most similar first."""
        links, v = self.near[layer], self.v
        seen = set(start)
        best = sorted(zip((v[start] @ q).tolist(), start))[-width:]
        todo = [(-s, j) for s, j in best]
        heapq.heapify(todo)
        heapq.heapify(best)
        while todo:
            s, j = heapq.heappop(todo)
            if len(best) >= width and -s < best[0][0]:
                break
            fresh = [i for i in links[j] if i not in seen]
            if not fresh:
                continue
            seen.update(fresh)
            for s, i in zip((v[fresh] @ q).tolist(), fresh):
                if len(best) < width:
                    heapq.heappush(best, (s, i))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, i))
                else:
                    continue
                heapq.heappush(todo, (-s, i))
        return sorted(best, reverse=True)

    def within(self, q: np.ndarray, least: float, width: int) -> np.ndarray | None:
        """Candidates of similarity ``least`` or more; the beam doubles until its worst lies below. None: too many."""
        start = [self.entry]
        for layer in range(int(self.level[self.entry]), 0, -1):
            start = [self.beam(q, start, 1, layer)[0][1]]
        while width <= WIDEST:
            got = self.beam(q, start, width)
            if len(got) < width or got[-1][0] < least:
                return np.array([j for s, j in got if s >= least], dtype=np.int64)
            width *= 2
        return None


def links(graph: Graph, queries: np.ndarray, least: float) -> list[np.ndarray]:
    """For each unit query the rows of the graph's shard at cosine ``least`` or more.

    A sample is audited against all of the shard, drawn until it has ``AUDITED`` queries and as many links or an eighth of
    all queries; while a link is missing the beam doubles and
    everything is searched again. A query with more links than ``WIDEST`` reads its shard exactly. So
    does every query if the beam grows that far.
    """
    n, slack = len(queries), least - 1e-9
    audit, truth, seen = [], [], 0
    for at in np.random.default_rng(n).permutation(n).tolist():
        audit.append(at)
        truth.append(np.flatnonzero(graph.v @ queries[at] >= least))
        seen += len(truth[-1]) - (graph.v is queries)
        if len(audit) >= AUDITED and (seen >= AUDITED or len(audit) >= n // 8):
            break
    width = BEAM
    while width <= WIDEST:
        missed = 0
        for k, t in zip(audit, truth):
            got = graph.within(queries[k], slack, width)
            missed += got is not None and len(np.setdiff1d(t, got, assume_unique=True))
        if not missed:
            break
        width *= 2
    out: list[np.ndarray | None] = [graph.within(q, slack, width) if width <= WIDEST else None for q in queries]
    wide = [k for k, got in enumerate(out) if got is None]
    for at in range(0, len(wide), 256):
        part = wide[at : at + 256]
        hits = queries[part] @ graph.v.T >= least
        for k, row in zip(part, hits):
            out[k] = np.flatnonzero(row)
    return [got[graph.v[got] @ queries[k] >= least] for k, got in enumerate(out)]


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _roots(n: int, found: list[np.ndarray]) -> np.ndarray:
    root = list(range(n))

    def top(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for k, got in enumerate(found):
        a = top(k)
        for j in got.tolist():
            b = top(j)
            if a != b:
                a, b = min(a, b), max(a, b)
                root[b] = a
    return np.array([top(k) for k in range(n)])


def _build(least: float):
    """Rows (slot, name, copies, embedding) of some whole shards -> one row a shard: its graph, what it asks of others, its own links."""

    def build(batches):
        held = defaultdict(list)
        for batch in batches:
            for slot in np.unique(batch.column(0).to_numpy()).tolist():
                b = batch.filter(pa.array(batch.column(0).to_numpy() == slot))
                held[slot].append((b.column(1).to_numpy(), b.column(2).to_numpy(), matrix(b.column(3))))
        for slot in list(held):
            names, weight, v = map(np.concatenate, zip(*held.pop(slot)))
            order = np.argsort(names)
            names, weight, unit = names[order], weight[order], _unit(v[order])
            graph = Graph(unit)
            found = links(graph, unit, least)
            n_links = weight - 1 + np.array([weight[got[got != k]].sum() for k, got in enumerate(found)])  # a beam may miss the vector itself
            roots = names[_roots(len(names), found)]
            parts = ((names, weight, roots, graph), (names, weight, unit), (names, n_links, roots))
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), *[pa.array([pickle.dumps(x)], pa.binary()) for x in parts]], ["slot", "graph", "ask", "local"])

    return build


def _local(batches):
    for batch in batches:
        for x in batch.column(0):
            names, n, roots = pickle.loads(x.as_py())
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n, pa.int64()), pa.array(roots)], ["name", "n", "root"])


def _across(least: float):
    """Rows (slot, kind, payload) in order, a slot's graph (kind 0) before the vectors of other shards that ask it -> counts and edges both ways."""

    def across(batches):
        own = None
        for batch in batches:
            for kind, payload in zip(batch.column(1).to_pylist(), batch.column(2)):
                if kind == 0:
                    own = pickle.loads(payload.as_py())
                    continue
                names2, weight2, roots2, graph = own
                names, weight, v = pickle.loads(payload.as_py())
                found = links(graph, v, least)
                back = np.zeros(len(names2), np.int64)
                name, n, root = [], [], []
                for k, got in enumerate(found):
                    if len(got):
                        back[got] += weight[k]
                        tops = np.unique(roots2[got])
                        name += [names[k]] * len(tops)
                        n += [int(weight2[got].sum())] + [0] * (len(tops) - 1)
                        root += tops.tolist()
                hit = np.flatnonzero(back)
                name, n, root = np.concatenate([np.array(name, np.int64), names2[hit]]), np.concatenate([np.array(n, np.int64), back[hit]]), np.concatenate([np.array(root, np.int64), names2[hit]])
                yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(n), pa.array(root)], ["name", "n", "root"])

    return across


def _keys() -> list:
    """Two independent 64-bit hashes of a label and a vector: equal vectors are those equal in both; the first is also their name."""
    return [F.xxhash64("label", "embedding").alias("name"), F.xxhash64("label", "embedding", F.lit(1)).alias("name2")]


def near_vectors(vectors: DataFrame, least: float = SIMILAR, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``vectors`` (vec_id, embedding, label).

    Vectors link if their labels are equal and their cosine is ``least`` or more. Equal vectors of a
    label collapse to one with a count. The distinct ones of each label and length are dealt by hash
    into shards of about ``shard_rows``; each shard's task builds a graph, searches it with its own
    vectors and writes graph and local components as one row. Then every shard's graph is asked by the vectors of the
    shards of its label before it; a graph moves once, to a partition of its own. A vector passes on one edge per
    local component it touches, never its pairs, and its links are counted where they are found.

    Null labels and null, zero or empty vectors, or such with null or non-finite components, have no
    links and are their own component; so do vectors of a length nobody else has. A repeated or null vec_id
    is a vector of its own; the id of a component is its least vec_id, null if all are. Other columns are not read. An empty table
    gives no rows.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding", "label")
    good = F.coalesce(F.col("label").isNotNull() & usable(F.col("embedding")) & nonzero(F.col("embedding")), F.lit(False))
    with Tables() as tables:
        fine = tables.written(rows.where(good).select("vec_id", "label", "embedding", *_keys()))
        groups = tables.written(
            fine.groupBy("name", "name2").agg(F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding"), F.min("vec_id").alias("first"), F.count("*").alias("copies"))
            .withColumn("dim", F.size("embedding"))
        )
        counts = groups.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
        # One row per label and length: where the numbers of its shards begin.
        before = F.coalesce(F.sum("shards").over(Window.orderBy("label", "dim").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("int")
        counts = tables.written(counts.withColumn("start", before))
        dealt = groups.join(few(counts), ["label", "dim"]).withColumn("slot", F.col("start") + F.pmod("name", F.col("shards")).cast("int"))
        wide = max(1, min(counts.agg(F.sum("shards")).first()[0] or 0, WIDE))
        dealt = dealt.select("slot", "name", "copies", F.col("embedding").cast("array<double>").alias("embedding")).repartitionById(wide, F.col("slot") % wide)
        graphs = tables.written(dealt.mapInArrow(_build(least), "slot int, graph binary, ask binary, local binary"))
        local = graphs.select("local").mapInArrow(_local, "name long, n long, root long")
        slots = counts.where("shards > 1").select((F.col("start") + F.col("shards") - 1).alias("end"), F.explode(F.sequence("start", F.col("start") + F.col("shards") - 1)).alias("slot"))
        several = graphs.join(few(tables.written(slots)), "slot")
        asks = several.where("slot < end").select(F.explode(F.sequence(F.col("slot") + 1, F.col("end"))).alias("slot"), F.lit(1).alias("kind"), F.col("ask").alias("payload"))
        both = several.select("slot", F.lit(0).alias("kind"), F.col("graph").alias("payload")).union(asks)
        both = both.repartitionById(wide, F.col("slot") % wide).sortWithinPartitions("slot", "kind")
        found = tables.written(local.union(both.mapInArrow(_across(least), "name long, n long, root long")))
        roots = tables.keep(connected_components(found.select(F.col("name").alias("a"), F.col("root").alias("b"))))
        n = found.groupBy("name").agg(F.sum("n").alias("n_links"))
        known = groups.select("name", "name2", "first").join(n, "name").join(roots.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
        known = tables.written(known)
        top = known.groupBy("root").agg(F.min("first").alias("component_id"))
        known = known.join(top, "root").select("name", "name2", "n_links", "component_id")
        linked = fine.select("vec_id", "name", "name2").join(known, ["name", "name2"]).select("vec_id", "n_links", "component_id")
        alone = rows.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
        return written(linked.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id")))
