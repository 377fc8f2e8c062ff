"""Embedding near-dedup: a navigable small-world graph per shard, searched by every vector of the same label."""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import components, stored

LINKS = 12
BUILD_BEAM = 48
BEAM = 32
AUDIT_ROWS = 64
RECALL = 0.95
SHARDS = 4
SHARD_ROWS = 65_536
BLOCK_ROWS = 16_384
BATCH = 256
WIDTH = 4


def _spread(ids: np.ndarray, seed: int) -> np.ndarray:
    """A fixed pseudo-random number in (0, 1] of each id."""
    with np.errstate(over="ignore"):
        x = (ids.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
    return (x >> np.uint64(11)).astype(np.float64) / (1 << 53) + 2.0**-54


def beam_search(graph: np.ndarray, x: np.ndarray, asked: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest nodes each query finds: (ids, cosines), best first, -1 where fewer than `beam` were met.

    All queries walk in step: each expands its best few unexpanded nodes until
    none is left among the `beam` best it has seen.
    """
    n, q = len(x), len(asked)
    ids = np.full((q, beam), -1, np.int32)
    near = np.full((q, beam), -np.inf, np.float32)
    fresh = np.zeros((q, beam), bool)
    seen = np.zeros((q, n), bool)
    k = min(entries.shape[1], beam)
    ids[:, :k] = entries[:, :k]
    known = ids[:, :k] >= 0
    near[:, :k] = np.where(known, np.einsum("qd,qkd->qk", asked, x[ids[:, :k]]), -np.inf)
    fresh[:, :k] = known
    rows = np.arange(q)
    seen[rows[:, None], np.where(known, ids[:, :k], entries[:, :1])] = True
    while len(rows := np.flatnonzero(fresh.any(axis=1))):
        open_near = np.where(fresh[rows], near[rows], -np.inf)
        width = min(WIDTH, beam)
        pick = np.argpartition(-open_near, width - 1, axis=1)[:, :width]
        r = rows[:, None]
        live = fresh[r, pick]
        fresh[r, pick] = False
        found = graph[np.where(live, ids[r, pick], 0)]
        found = np.where(live[:, :, None], found, -1).reshape(len(rows), -1)
        good = (found >= 0) & ~seen[r, np.maximum(found, 0)]
        order = np.sort(np.where(good, found, n), axis=1)
        good = (order < n) & np.concatenate((np.ones((len(rows), 1), bool), order[:, 1:] != order[:, :-1]), axis=1)
        keep = int(good.sum(axis=1).max(initial=0))
        if not keep:
            continue
        at = np.argsort(~good, axis=1, kind="stable")[:, :keep]
        order, good = np.take_along_axis(order, at, 1), np.take_along_axis(good, at, 1)
        safe = np.where(good, order, 0)
        a, b = np.nonzero(good)
        seen[rows[a], order[a, b]] = True
        cosines = np.where(good, np.einsum("qd,qkd->qk", asked[rows], x[safe]), -np.inf).astype(np.float32)
        all_ids = np.concatenate((ids[rows], np.where(good, order, -1)), axis=1)
        all_near = np.concatenate((near[rows], cosines), axis=1)
        all_fresh = np.concatenate((fresh[rows], good), axis=1)
        top = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
        ids[rows], near[rows], fresh[rows] = (np.take_along_axis(y, top, 1) for y in (all_ids, all_near, all_fresh))
    order = np.argsort(-near, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)


def _diverse(x: np.ndarray, ids: np.ndarray, near: np.ndarray, links: int) -> np.ndarray:
    """Of each row's candidates, best first, those nearer to the row than to any taken before; filled up with the nearest."""
    q, k = ids.shape
    safe = np.maximum(ids, 0)
    pairs = np.einsum("qad,qbd->qab", x[safe], x[safe])
    taken = np.zeros((q, k), bool)
    blocked = np.full((q, k), -np.inf, np.float32)
    count = np.zeros(q, int)
    for j in range(k):
        ok = (ids[:, j] >= 0) & (count < links) & (near[:, j] > blocked[:, j])
        taken[:, j] = ok
        count += ok
        blocked = np.where(ok[:, None], np.maximum(blocked, pairs[:, j]), blocked)
    rank = np.where(taken, 0, np.where(ids >= 0, 1, 2))
    order = np.argsort(rank, axis=1, kind="stable")[:, :links]
    return np.take_along_axis(ids, order, 1)


class Graph:
    """Layers of neighbour lists over vectors of length 1; node i of layer 0 is row i, upper layers hold ever fewer nodes."""

    def __init__(self, x: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.x, self.layers = x, layers

    @classmethod
    def build(cls, ids: np.ndarray, x: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM, seed: int = 3) -> Graph:
        level = np.floor(-np.log(_spread(ids, seed)) / np.log(links)).astype(int)
        graph = cls(x, [])
        for depth in range(int(level.max(initial=0)), -1, -1):
            nodes = np.flatnonzero(level >= depth)
            order = np.lexsort((_spread(ids[nodes], seed + 1), -level[nodes]))
            graph.layers.insert(0, (nodes[order], graph._layer(nodes[order], 2 * links if depth == 0 else links, beam)))
        return graph

    def _layer(self, nodes: np.ndarray, degree: int, beam: int) -> np.ndarray:
        """Neighbour lists of a new bottom layer; nodes come in batches that double and see each other."""
        x = self.x[nodes]
        table = np.full((len(nodes), degree), -1, np.int32)
        done = 0
        while done < len(nodes):
            stop = min(len(nodes), done + max(8, min(BATCH, done)))
            new = np.arange(done, stop)
            inside = x[new] @ x[new].T
            np.fill_diagonal(inside, -np.inf)
            ids = np.broadcast_to(new, inside.shape)
            if done:
                start = self.descend(x[new], 1) if self.layers else None
                place = np.zeros((len(new), 1), int) if start is None else self._place(nodes, start)
                place = np.where(place < done, place, 0)
                found, near = beam_search(table[:done], x[:done], x[new], place, min(beam, done))
                ids, inside = np.concatenate((found, ids), axis=1), np.concatenate((near, inside), axis=1)
            order = np.argsort(-inside, axis=1, kind="stable")[:, :beam]
            ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(inside, order, 1)
            ids = np.where(np.isfinite(near), ids, -1)
            chosen = _diverse(x, ids, near, degree // 2)
            table[new, : chosen.shape[1]] = chosen
            # Back links: each linked node keeps the best spread of old and new neighbours.
            a, b = np.nonzero(chosen >= 0)
            done = stop
            if not len(a):
                continue
            target, source = chosen[a, b], new[a]
            order = np.argsort(target, kind="stable")
            target, source = target[order], source[order]
            first = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1])))
            size = np.diff(np.append(first, len(target)))
            more = np.full((len(first), int(size.max(initial=0))), -1, np.int32)
            more[np.repeat(np.arange(len(first)), size), np.arange(len(target)) - np.repeat(first, size)] = source
            touched = target[first]
            for at in range(0, len(touched), BATCH):
                t = touched[at : at + BATCH]
                every = np.concatenate((table[t], more[at : at + BATCH]), axis=1)
                near = np.where(every >= 0, np.einsum("qd,qkd->qk", x[t], x[np.maximum(every, 0)]), -np.inf)
                order = np.argsort(-near, axis=1, kind="stable")[:, : 2 * degree]
                every, near = np.take_along_axis(every, order, 1), np.take_along_axis(near, order, 1)
                twice = np.concatenate((np.zeros((len(t), 1), bool), every[:, 1:] == every[:, :-1]), axis=1)
                table[t] = _diverse(x, np.where(twice, -1, every), near, degree)[:, :degree] if every.shape[1] >= degree else np.pad(every, ((0, 0), (0, degree - every.shape[1])), constant_values=-1)
        return table

    @staticmethod
    def _place(nodes: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Positions of rows in a layer's nodes."""
        order = np.argsort(nodes)
        return order[np.searchsorted(nodes, rows, sorter=order)]

    def descend(self, asked: np.ndarray, stop: int = 0) -> np.ndarray:
        """Rows nearest to each query, found through all layers from the top down."""
        entry = np.broadcast_to(self.layers[-1][0][:1], (len(asked), 1))
        for nodes, table in reversed(self.layers[stop - 1 if stop else 1 :]):
            ids, _ = beam_search(table, self.x[nodes], asked, self._place(nodes, entry), 4)
            entry = np.where(ids >= 0, nodes[np.maximum(ids, 0)], nodes[ids[:, :1]])
        return entry

    def search(self, asked: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, cosines) of the nearest vectors each query finds."""
        nodes, table = self.layers[0]
        entry = self.descend(asked) if len(self.layers) > 1 else np.broadcast_to(nodes[:1], (len(asked), 1))
        ids, near = beam_search(table, self.x[nodes], asked, self._place(nodes, entry), min(beam, len(nodes)))
        return np.where(ids >= 0, nodes[np.maximum(ids, 0)], -1), near

    def dumped(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, *[y for layer in self.layers for y in layer])
        return out.getvalue()

    @classmethod
    def loaded(cls, x: np.ndarray, data: bytes) -> Graph:
        with np.load(io.BytesIO(data)) as found:
            arrays = [found[f"arr_{i}"] for i in range(len(found.files))]
        return cls(x, list(zip(arrays[::2], arrays[1::2], strict=True)))


def unit(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def links_of(graph: Graph, asked: np.ndarray, least: float, names: np.ndarray, beam: int = BEAM, audit: int = AUDIT_ROWS, recall: float = RECALL):
    """(query, row) pairs of cosine about `least` or more; the beam doubles until an audit against brute force passes.

    The audit takes `audit` queries by hash of their names; each wants its
    links, or else the two nearest rows. A query whose whole
    beam is near enough may have more: it is asked again with a wider one,
    up to the whole shard.
    """
    n, slack = len(graph.x), least - 1e-4
    tested = np.argsort(_spread(names, 11), kind="stable")[:audit]
    truth = asked[tested] @ graph.x.T
    top = min(2, n)
    bound = np.minimum(slack, np.partition(truth, n - top, axis=1)[:, n - top])[:, None]
    wanted = truth >= bound
    while beam < n:
        found, _ = graph.search(asked[tested], beam)
        hit = np.zeros(wanted.shape, bool)
        a, b = np.nonzero(found >= 0)
        hit[a, found[a, b]] = True
        # Rows that fill their beam are widened below, one by one.
        room = wanted.sum(axis=1) < beam
        if not room.any() or (hit & wanted)[room].sum() >= recall * wanted[room].sum():
            break
        beam *= 2
    queries, rows = [], []
    todo = np.arange(len(asked))
    while len(todo):
        wider = []
        for at in range(0, len(todo), BATCH):
            some = todo[at : at + BATCH]
            ids, near = graph.search(asked[some], beam)
            full = (near[:, -1] >= slack) & (ids.shape[1] < n)
            wider.append(some[full])
            a, b = np.nonzero((near >= slack) & (ids >= 0) & ~full[:, None])
            queries.append(some[a])
            rows.append(ids[a, b])
        todo, beam = np.concatenate(wider), 2 * beam
    return np.concatenate(queries or [np.array([], int)]), np.concatenate(rows or [np.array([], int)]), beam


def _vectors(column: pd.Series) -> np.ndarray:
    """The vectors of a column, each times the power of two that brings its largest component near one: squares stay in range, cosines stay the same."""
    found = np.stack([np.asarray(v, np.float64) for v in column])
    return np.ldexp(found, -np.frexp(np.abs(found).max(axis=1, keepdims=True))[1])


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.93, shards: int = SHARDS, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, recall: float = RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row.

    Vectors of one label and the same components are one class. The classes of
    a label are dealt to shards by hash: `shards` of them, more once they'd
    exceed `shard_rows`. Each shard's graph is built by one task and searched by
    blocks of all classes of the label. Pairs are checked in double precision
    and count when either side found the other; n_links weighs a class by its
    rows. A class of several rows links them all, whatever the search finds.

    Null labels, null, empty and zero vectors and vectors with null or
    non-finite components link with nothing; vectors of one length are compared
    with each other only. Entries may be as large or small as doubles are. Ids are whole numbers; of rows without id each is its own class.
    Other columns aren't read; an empty table gives an empty one.
    """
    given = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(F.col("label").isNotNull() & F.col("vec_id").isNotNull() & fine, F.lit(False))
    # Adding zero makes the two zeros one.
    key = F.transform("v", lambda x: x + F.lit(0.0))
    classes = given.where(usable).groupBy("label", key.alias("v")).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("rows"))
    classes = stored(classes.withColumn("size", F.size("v")), "vector-classes")
    sizes = classes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n"))
    sizes = stored(sizes.withColumn("shards", F.greatest(F.least(F.lit(shards), F.ceil(F.col("n") / 64)), F.ceil(F.col("n") / shard_rows)).cast("int")).withColumn("blocks", F.ceil(F.col("n") / block_rows).cast("int")), "vector-labels")
    placed = classes.join(sizes, ["label", "size"])
    placed = placed.withColumn("shard", F.pmod(F.xxhash64("rep"), "shards")).withColumn("block", F.pmod(F.xxhash64("rep", F.lit(1)), "blocks"))
    label_kind = classes.schema["label"].dataType.simpleString()

    def built(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep", ignore_index=True)
        graph = Graph.build(rows["rep"].to_numpy(), unit(_vectors(rows["v"])))
        first = rows.iloc[0]
        found = {"label": first["label"], "size": first["size"], "shard": first["shard"], "blocks": first["blocks"], "graph": graph.dumped()}
        return pd.DataFrame({**{k: [x] for k, x in found.items()}, "reps": [rows["rep"].to_numpy()], "weights": [rows["rows"].to_numpy()], "flat": [_vectors(rows["v"]).ravel()]})

    graphs = placed.groupBy("label", "size", "shard").applyInPandas(
        built, f"label {label_kind}, size int, shard long, blocks int, graph binary, reps array<long>, weights array<long>, flat array<double>"
    )
    graphs = stored(graphs, "graphs").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("blocks") - 1).cast("long"))))
    asking = placed.withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), (F.col("shards") - 1).cast("long"))))
    asking = asking.select("label", "size", "block", F.col("to").alias("shard"), "rep", "rows", "v")

    def linked(index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(index) or not len(asked):
            return pd.DataFrame({"u": [], "v": [], "u_rows": [], "v_rows": []}).astype("int64")
        shard = index.iloc[0]
        reps, weights = np.asarray(shard["reps"]), np.asarray(shard["weights"])
        exact = np.asarray(shard["flat"]).reshape(len(reps), -1)
        asked = asked.sort_values("rep", ignore_index=True)
        own = _vectors(asked["v"])
        names, rows = asked["rep"].to_numpy(), asked["rows"].to_numpy()
        q, r, _ = links_of(Graph.loaded(unit(exact), shard["graph"]), unit(own), least, names, recall=recall)
        lengths, own_lengths = np.linalg.norm(exact, axis=1), np.linalg.norm(own, axis=1)
        out = []
        for at in range(0, len(q), 1 << 16):
            a, b = q[at : at + (1 << 16)], r[at : at + (1 << 16)]
            cosine = np.einsum("ij,ij->i", own[a], exact[b]) / (own_lengths[a] * lengths[b])
            ok = (cosine >= least) & (names[a] != reps[b])
            a, b = a[ok], b[ok]
            low = names[a] < reps[b]
            out.append(np.stack([np.where(low, names[a], reps[b]), np.where(low, reps[b], names[a]), np.where(low, rows[a], weights[b]), np.where(low, weights[b], rows[a])], axis=1))
        found = np.concatenate(out) if out else np.zeros((0, 4), np.int64)
        return pd.DataFrame(found, columns=["u", "v", "u_rows", "v_rows"])

    keys = ["label", "size", "shard", "block"]
    pairs = graphs.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInPandas(linked, "u long, v long, u_rows long, v_rows long")
    pairs = stored(pairs.distinct(), "vector-links")
    ends = pairs.select(F.col("u").alias("rep"), F.col("v_rows").alias("n")).union(pairs.select("v", "u_rows"))
    counts = ends.groupBy("rep").agg(F.sum("n").alias("others"))
    labels = components(pairs).withColumnRenamed("node", "rep")
    return _result(given, usable, key, classes, counts, labels)


def _result(given: DataFrame, usable, key, classes: DataFrame, counts: DataFrame, labels: DataFrame) -> DataFrame:
    named = labels.withColumnRenamed("label", "component")
    known = classes.join(counts, "rep", "left").join(named, "rep", "left").select(
        F.col("label").alias("_label"), F.col("v").alias("_v"),
        (F.coalesce("others", F.lit(0)) + F.col("rows") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"),
    )
    keyed = given.select("vec_id", F.when(usable, F.col("label")).alias("_label"), F.when(usable, key).alias("_v"))
    found = keyed.join(known, ["_label", "_v"], "left")
    component = F.coalesce("component_id", "vec_id").alias("component_id")
    return found.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component, F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
