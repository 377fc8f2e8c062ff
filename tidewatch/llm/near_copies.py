"""Near copies: fingerprints and min-hash bands name candidates, whole shingle sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import simhash
from tidewatch.llm.common import components, packed, stored, text_or_empty

BANDS = 20
ROWS = 4
GROUP_ROWS = 256
# Bands whose groups are compared before those of all others.
FIRST_BANDS = 6
# Shingle hashes of one tile's texts, about: 16 MB.
TILE_HASHES = 1 << 21
DICE = np.random.default_rng(8)
SPINS = DICE.integers(0, 2**63, (BANDS * ROWS, 1), dtype=np.uint64)
ODDS = DICE.integers(0, 2**63, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)
KEY = ["band", "key", "tile", "other"]


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles, letters A to Z in small; a shorter text is one shingle."""
    import xxhash

    words = (text or "").encode().translate(simhash.LOWER).split()
    size = min(size, len(words))
    grams = (b" ".join(words[i : i + size]) for i in range(len(words) - size + 1 if words else 0))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(g) for g in grams), np.uint64))


def bands(hashes: np.ndarray) -> np.ndarray:
    """One key per band of four least hashes; texts of similarity s share a band with probability 1 - (1 - s^4)^20."""
    import xxhash

    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 1 << 14):
        least = np.minimum(least, ((hashes[None, at : at + (1 << 14)] ^ SPINS) * ODDS).min(axis=1))
    return np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in least.reshape(BANDS, ROWS)], np.uint64)


def signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, text, node, fp, size, keys): node is the hash of the set of `size` shingles, `text` that of the text."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = part.column(2).to_pylist()
                sets = [shingles(x, shingle) for x in texts]
                nodes = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
                prints = np.array([simhash.simhash(x, shingle) for x in texts], np.uint64).view(np.int64)
                keys = pa.array([bands(s).view(np.int64) for s in sets], pa.list_(pa.int64()))
                sizes = pa.array([len(s) for s in sets], pa.int64())
                columns = [part.column(0), part.column(1), pa.array(nodes), pa.array(prints), sizes, keys]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "node", "fp", "size", "keys"])

    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_or_empty(text_col)).alias("hash"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(signed, f"doc_id {kind}, text bigint, node bigint, fp bigint, size bigint, keys array<bigint>")


def alike(values: np.ndarray, sizes: np.ndarray, asks: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets, given one after another, with a Jaccard similarity of `percent` or more; with asks, each has one of them."""
    _, which = np.unique(values, return_inverse=True)
    owners = np.repeat(np.arange(len(sizes)), sizes)[np.argsort(which, kind="stable")]
    starts = np.concatenate(([0], np.cumsum(np.bincount(which)))) if len(which) else np.zeros(1, np.int64)
    ends = np.cumsum(sizes)
    entry, across = ~asks, asks.any()
    found: list[np.ndarray] = []
    for i in np.flatnonzero(asks) if across else range(len(sizes)):
        mine = which[ends[i] - sizes[i] : ends[i]]
        count = starts[mine + 1] - starts[mine]
        place = np.repeat(starts[mine] - np.cumsum(count) + count, count)
        shared = np.bincount(owners[place + np.arange(len(place))], minlength=len(sizes))
        good = entry & ((100 + percent) * shared >= percent * (sizes + sizes[i])) & (shared > 0)
        good[: 0 if across else i + 1] = False
        found.append(np.stack([np.full(good.sum(), i), np.flatnonzero(good)]))
    pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return pairs[0], pairs[1]


def _forests(rows: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Edges (u, v) that connect what is alike inside the groups of rows (band, key, tile, other, ask, node, text)."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def edges(group: pa.RecordBatch) -> pa.RecordBatch:
            asks, nodes = (group.column(i).to_numpy() for i in (4, 5))
            sets = [shingles(x.as_py(), shingle) for x in group.column(6)]
            u, v = alike(np.concatenate(sets), np.array([len(s) for s in sets]), asks != 0, percent)
            labels = simhash._merge(np.arange(len(nodes)), u, v)
            moved = np.flatnonzero(labels != np.arange(len(nodes)))
            return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[labels[moved]])], names=["u", "v"])

        for batch in batches:
            now = pa.concat_batches([*held, batch]) if held else batch
            keys = np.stack([now.column(i).to_numpy() for i in range(4)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist()]
            for a, b in zip(cuts, cuts[1:]):
                yield edges(now.slice(a, b - a))
            held = [now.slice(cuts[-1])]
        if held and held[0].num_rows:
            yield edges(held[0])

    ordered = rows.repartition(*KEY).sortWithinPartitions(*KEY, "ask", "node")
    ordered = ordered.select(*[F.col(c).cast("bigint") for c in (*KEY, "ask", "node")], "text")
    return ordered.mapInArrow(linked, "u bigint, v bigint")


def _digest(node: str) -> list[Column]:
    """128 bits that name a set of distinct nodes, added up inside tasks."""
    return [F.bit_xor(F.xxhash64(node, F.lit(seed))).alias(f"digest{seed}") for seed in (1, 2)]


def _groups(signed: DataFrame, nodes: DataFrame, distance: int) -> DataFrame:
    """(band, key, node, size, rows, hashes): candidate groups of two nodes or more, one of those with the same members."""
    near = simhash.link_components(signed.select("fp").distinct(), distance).withColumnRenamed("node", "fp")
    by_print = signed.select("fp", "node", "size").join(near, "fp").select(F.lit(BANDS).alias("band"), F.col("label").alias("key"), "node", "size")
    # Texts without words have no shingles; they are one node.
    by_band = nodes.where("size > 0").select(F.posexplode("keys").alias("band", "key"), "node", "size")
    keyed = by_band.union(by_print.distinct())
    counted = keyed.groupBy("band", "key").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("hashes"), *_digest("node"))
    # The same members usually share several bands, and are compared once.
    first = F.min(F.struct("band", "key")).alias("first")
    once = counted.where("rows > 1").groupBy("rows", "hashes", "digest1", "digest2").agg(first)
    once = once.select("first.*", "rows", "hashes")
    return stored(keyed.join(once, ["band", "key"]), "candidate-groups")


def _compare(members: DataFrame, labels: DataFrame | None, texts: DataFrame, percent: int, shingle: int, group_rows: int) -> DataFrame:
    """Edges that connect what is alike in the groups of `members`, as far as `labels` do not connect it yet.

    Only ids make up the groups; a text joins when its tiles are known, once
    for each. A group is cut into tiles of about `group_rows` texts and
    TILE_HASHES shingles at most. Pairs inside tiles come first; then only
    nodes outside their group's largest component meet the other tiles, since
    links inside a component change nothing.
    """
    if labels is not None:
        members = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = members.groupBy("band", "key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
        members = members.join(mixed.select("band", "key"), ["band", "key"]).drop("label")
    spot = F.xxhash64("node", F.lit(7))
    tiles = F.ceil(F.greatest(F.col("rows") / group_rows, F.col("hashes") / TILE_HASHES))
    members = members.withColumn("tiles", tiles).withColumn("tile", F.pmod(spot, "tiles"))
    members = stored(members.select("band", "key", "node", "size", "tiles", "tile"), "candidate-members")

    def found(placed: DataFrame, name: str) -> DataFrame:
        return stored(_forests(texts.hint("merge").join(placed, "node"), percent, shingle).distinct(), name)

    plain = members.select("band", "key", "tile", F.lit(0).alias("other"), F.lit(0).alias("ask"), "node")
    edges = found(plain, "verified")
    large = members.where("tiles > 1")
    if not large.limit(1).count():
        return edges

    known = components(edges if labels is None else edges.union(labels.select("node", "label")))
    inside = stored(large.join(known, "node", "left").withColumn("label", F.coalesce("label", "node")), "large-members")
    counted = inside.groupBy("band", "key", "label").count()
    most = counted.groupBy("band", "key").agg(F.max_by("label", F.struct("count", "label")).alias("most"))
    outside = inside.join(most, ["band", "key"]).where("label != most")
    many = F.ceil(F.greatest(F.count(F.lit(1)) / group_rows, F.sum("size") / TILE_HASHES))
    parts = stored(outside.groupBy("band", "key").agg(many.alias("parts")), "outside-parts")
    asks = (
        outside.join(parts, ["band", "key"])
        .withColumn("other", F.pmod(spot, "parts"))
        .withColumn("tile", F.explode(F.sequence(F.lit(0), (F.col("tiles") - 1).cast("int"))))
        .select("band", "key", "tile", "other", F.lit(1).alias("ask"), "node")
    )
    entries = (
        inside.join(parts, ["band", "key"])
        .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("parts") - 1).cast("int"))))
        .select("band", "key", "tile", "other", F.lit(0).alias("ask"), "node")
    )
    return edges.union(found(asks.union(entries), "verified-across"))


def verified_components(given: DataFrame, signed: DataFrame, shingle: int, distance: int, percent: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(node, label): components of shingle sets under links of `percent` similarity or more; `given` has doc_id, hash, text.

    Candidates share a component of near fingerprints or a min-hash band; each
    pair of such a group is decided on its whole sets. The fingerprints and
    the first bands are compared first, which connects most copies; of the
    other bands only groups that still hold more than one component are.
    """
    about = F.first(F.struct("keys", "size")).alias("of")
    nodes = signed.groupBy("node").agg(about, F.min(F.struct("doc_id", "text")).alias("first"))
    nodes = stored(nodes.select("node", "of.*", F.col("first.doc_id").alias("doc_id"), F.col("first.text").alias("hash")), "shingle-sets")
    groups = _groups(signed, nodes, distance)
    # One shuffle of the texts leaves the candidates' alone, each of them once; it costs the same share at any size.
    wanted = nodes.select("node", "doc_id", "hash").join(groups.select("node").distinct(), "node", "left_semi")
    wanted = wanted.select("node", F.col("doc_id").alias("of_doc"), F.col("hash").alias("of_text"))
    same = given["doc_id"].eqNullSafe(F.col("of_doc")) & (F.col("hash") == F.col("of_text"))
    texts = stored(given.select("doc_id", "hash", "text").hint("merge").join(wanted, same).select("node", "text"), "candidate-texts")
    early = (F.col("band") == BANDS) | (F.col("band") < FIRST_BANDS)
    edges = _compare(groups.where(early), None, texts, percent, shingle, group_rows)
    labels = components(edges)
    return components(edges.union(_compare(groups.where(~early), labels, texts, percent, shingle, group_rows)))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, distance: int = 8, percent: int = 80, group_rows: int = GROUP_ROWS) -> DataFrame:
    """`docs`, all its columns, with one row of each component: that of the smallest id.

    A row without an id stays only if no row of its component has one; of rows
    that repeat the id, the one of the smallest text hash, then of the
    smallest row hash stays. Texts of fewer words than a shingle are one
    shingle; null and empty texts, and texts of white space, have none and are
    copies of each other. Texts are compared whole, whatever their length.
    Columns may have any names; an empty table gives an empty one.
    """
    text = text_or_empty(text_col)
    given = docs.select(packed(docs).alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    signed = stored(signatures(docs, id_col, text_col, shingle), "signatures")
    twice = signed.groupBy(F.col("doc_id").alias("of_doc"), F.col("text").alias("of_text")).count().where("count > 1")
    twice = stored(twice.drop("count"), "repeated")
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("hash") == F.col("of_text"))
    if twice.limit(1).count():
        one = given.join(twice, same, "left_semi").groupBy("doc_id", "hash").agg(F.min_by("row", F.xxhash64("row")).alias("row"), F.first("text").alias("text"))
        given = stored(given.join(twice, same, "left_anti").unionByName(one), "distinct-rows")
    labels = verified_components(given, signed, shingle, distance, percent, group_rows)
    named = signed.select("doc_id", "text", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text")).alias("first")
    kept = named.groupBy("label").agg(smallest).select(F.col("first.doc_id").alias("of_doc"), F.col("first.text").alias("of_text"))
    return given.join(stored(kept, "kept"), same, "left_semi").select("row.*")
