"""SimHash near-dedup over a Gray-ordered hierarchical index of masked bit patterns."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import components, packed, stored

BITS = 64
FANOUT = 8
GROUP_ROWS = 1024
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def simhash(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The fingerprint of one text; bit i is set when more than half of the shingle hashes have it set."""
    import xxhash

    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(shingle, len(words))
    starts, ends = starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist()
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), 1 << 15):
        spans = zip(starts[at : at + (1 << 15)], ends[at : at + (1 << 15)], strict=True)
        digests = b"".join([xxhash.xxh64_digest(joined[a:b], seed) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint of every whole text as a signed 64-bit integer; null and empty texts have 0."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [simhash(x.as_py(), shingle, seed) for x in part.column(1)]
                signed = pa.array(np.array(found, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), signed], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(hashed, f"doc_id {kind}, fp bigint")


def masks(distance: int, more: int = 1) -> list[int]:
    """Masks of which one at least covers no differing bit of any pair within `distance`.

    The bits are cut into distance + 1 + more blocks; a pair differs in
    `distance` of them at most, so 1 + more blocks are equal.
    """
    edges = np.linspace(0, BITS, distance + 2 + more).round().astype(int).tolist()
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(blocks[i] for i in chosen) for chosen in combinations(range(len(blocks)), 1 + more)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def gray_rank(fp: Column) -> Column:
    """The position of a bit pattern in the reflected Gray sequence, as the bits of a signed integer."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


class Index:
    """Trees over runs of one group each, given in Gray order.

    An upper node holds the bits all fingerprints below it share; a child adds
    only the bits its parent doesn't have, so differences add up on the way
    down and a whole subtree goes when they exceed the distance.
    """

    def __init__(self, groups: np.ndarray, fps: np.ndarray):
        self.levels = [(fps, fps, np.arange(len(fps)), np.arange(1, len(fps) + 1))]
        last, ones, zeros = np.arange(1, len(fps) + 1), fps, fps
        while True:
            first = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
            if len(self.levels) > 1 and len(first) == len(groups):
                break
            within = np.arange(len(groups)) - np.repeat(first, np.diff(np.append(first, len(groups))))
            cut = np.flatnonzero(within % FANOUT == 0)
            ones, zeros = np.bitwise_and.reduceat(ones, cut), np.bitwise_or.reduceat(zeros, cut)
            stop = np.append(cut[1:], len(groups))
            last, groups = last[stop - 1], groups[cut]
            self.levels.append((ones, zeros, cut, stop))
            self.lasts = [*getattr(self, "lasts", [np.arange(1, len(fps) + 1)]), last]
        self.roots = groups

    def search(self, fps: np.ndarray, roots: np.ndarray, distance: int, after: np.ndarray | None = None):
        """Pairs (query, entry) within `distance`; with `after`, only entries at later positions than after[query]."""
        query, node = np.arange(len(fps)), roots
        apart, known = np.zeros(len(fps), np.int64), np.zeros(len(fps), np.uint64)
        for depth in range(len(self.levels) - 1, -1, -1):
            ones, zeros, start, stop = self.levels[depth]
            shared = ~(ones[node] ^ zeros[node])
            apart = apart + np.bitwise_count((fps[query] ^ ones[node]) & shared & ~known)
            keep = apart <= distance
            if after is not None:
                keep &= self.lasts[depth][node] - 1 > after[query]
            query, node, apart, known = query[keep], node[keep], apart[keep], shared[keep]
            if depth:
                count = stop[node] - start[node]
                base = np.repeat(start[node] - np.cumsum(count) + count, count)
                node = base + np.arange(len(base))
                query, apart, known = (np.repeat(x, count) for x in (query, apart, known))
        return query, node


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (smallest position) after joining a[i] with b[i]."""
    while len(a):
        a, b = labels[a], labels[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while (labels[labels] != labels).any():
            labels = labels[labels]
    return labels


def _linked(groups: np.ndarray, fps: np.ndarray, asks: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest that connects what is within `distance` inside each group. Sorted by group, entries before queries, Gray rank."""
    entries = np.flatnonzero(~asks)
    labels = np.arange(len(fps))
    if len(entries):
        index = Index(groups[entries], fps[entries])
        apart = asks.any()
        queries = np.flatnonzero(asks) if apart else entries
        roots = np.searchsorted(index.roots, groups[queries])
        inside = roots < len(index.roots)
        queries, roots = queries[inside], roots[inside]
        same = index.roots[roots] == groups[queries]
        queries, roots = queries[same], roots[same]
        for at in range(0, len(queries), 2048):
            some = slice(at, at + 2048)
            after = None if apart else np.arange(len(queries))[some]
            q, e = index.search(fps[queries[some]], roots[some], distance, after)
            labels = _merge(labels, queries[some][q], entries[e])
    moved = np.flatnonzero(labels != np.arange(len(fps)))
    return moved, labels[moved]


def _forests(rows: DataFrame, distance: int) -> DataFrame:
    """Edges (u, v) inside the groups of rows (mask, pattern, tile, other, ask, fp)."""
    key = ["mask", "pattern", "tile", "other"]

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def edges(some: np.ndarray):
            starts = np.concatenate(([True], (some[1:, :4] != some[:-1, :4]).any(axis=1)))
            groups = np.cumsum(starts) - 1
            u, v = _linked(groups, some[:, 5].view(np.uint64), some[:, 4] != 0, distance)
            return pa.RecordBatch.from_arrays([pa.array(some[u, 5]), pa.array(some[v, 5])], names=["u", "v"])

        for batch in batches:
            now = np.stack([batch.column(i).to_numpy() for i in range(6)], axis=1)
            now = np.concatenate([*held, now]) if held else now
            cut = np.flatnonzero((now[1:, :4] != now[:-1, :4]).any(axis=1))
            if len(cut):
                yield edges(np.ascontiguousarray(now[: cut[-1] + 1]))
                now = now[cut[-1] + 1 :]
            held = [now]
        if held and len(held[0]):
            yield edges(np.ascontiguousarray(held[0]))

    placed = rows.repartition(*key).withColumn("gray", gray_rank(F.col("fp")))
    ordered = placed.sortWithinPartitions(*key, "ask", "gray", "fp")
    ordered = ordered.select(*[F.col(c).cast("bigint") for c in (*key, "ask", "fp")])
    return ordered.mapInArrow(linked, "u bigint, v bigint")


def link_components(fps: DataFrame, distance: int = 4, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(node, label): components of distinct fingerprints (column fp) under links of `distance` or fewer differing bits.

    A fingerprint goes to one group per mask, the masked bits being the group's
    top pattern; each pair within the distance meets in one group at least.
    Groups of over `group_rows` are cut into tiles. Pairs inside tiles come
    first; then only fingerprints outside their group's largest component meet
    the other tiles, since links inside a component change nothing. So a dense
    group costs about its size, and none is skipped.
    """
    tops = [F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("pattern")) for i, m in enumerate(masks(distance))]
    keyed = fps.select("fp", F.explode(F.array(*tops)).alias("top")).select("fp", "top.*")
    large = keyed.groupBy("mask", "pattern").count().where(F.col("count") > group_rows)
    large = stored(large.withColumnRenamed("count", "rows"), "large-groups")
    tiles = F.ceil(F.col("rows") / group_rows)
    spot = F.xxhash64("fp", F.lit(7))
    tiled = keyed.join(large, ["mask", "pattern"], "left").withColumn(
        "tile", F.coalesce(F.pmod(spot, tiles), F.lit(0))
    )
    plain = tiled.select("mask", "pattern", "tile", F.lit(0).alias("other"), F.lit(0).alias("ask"), "fp")
    edges = stored(_forests(plain, distance).distinct(), "links")
    labels = components(edges)
    if not large.limit(1).count():
        return labels

    inside = tiled.where("rows IS NOT NULL").join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    inside = stored(inside.withColumn("label", F.coalesce("label", "fp")), "large-members")
    counted = inside.groupBy("mask", "pattern", "label").count()
    most = counted.groupBy("mask", "pattern").agg(F.max_by("label", F.struct("count", "label")).alias("most"))
    outside = inside.join(most, ["mask", "pattern"]).where("label != most")
    parts = outside.groupBy("mask", "pattern").agg(F.ceil(F.count(F.lit(1)) / group_rows).alias("parts"))
    parts = stored(parts, "outside-parts")
    asks = (
        outside.join(parts, ["mask", "pattern"])
        .withColumn("other", F.pmod(spot, "parts"))
        .withColumn("tile", F.explode(F.sequence(F.lit(0), (tiles - 1).cast("int"))))
        .select("mask", "pattern", "tile", "other", F.lit(1).alias("ask"), "fp")
    )
    entries = (
        inside.join(parts, ["mask", "pattern"])
        .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))))
        .select("mask", "pattern", "tile", "other", F.lit(0).alias("ask"), "fp")
    )
    across = stored(_forests(asks.union(entries), distance).distinct(), "links-across")
    return components(edges.union(across))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    seed: int = 42,
    distance: int = 4,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    Only distinct fingerprints are compared; rows of equal fingerprints are one
    node. Null and empty texts, and texts of white space, have fingerprint 0
    and link like any other. component_id is the smallest id of the component
    and null when none of its rows has an id. Rows may repeat; other columns
    aren't read; an empty table gives an empty one.
    """
    prints = stored(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    labels = link_components(nodes.select("fp"), distance, group_rows).withColumnRenamed("node", "fp")
    nodes = nodes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    smallest = nodes.groupBy("label").agg(F.min("first").alias("component_id"))
    named = nodes.join(smallest, "label").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(named, "fp").select("doc_id", hexed, "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """`docs` with the row of the smallest id of each component only (a row without an id stays if none has one)."""
    prints = near_duplicates(docs, id_col, text_col, **params)
    kept = prints.where(F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id")))
    kept = kept.select(F.col("doc_id").alias("of_doc")).distinct()
    given = docs.select(packed(docs).alias("row"), F.col(id_col).alias("doc_id"))
    return given.join(kept, F.col("doc_id").eqNullSafe(F.col("of_doc")), "left_semi").select("row.*")
