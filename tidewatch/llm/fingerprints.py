"""Document fingerprints: bottom-k sketches of word-shingle hashes, mergeable, compared without the texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import WHITE, computed, stored, text_or_empty

K = 128
SHINGLE = 5
SIGN = -(1 << 63)
# Shingles sketched at once: what a task holds beyond a text's words does not grow with the text.
PART = 4096
# Documents of neighbouring ids that meet in one group, on average.
GROUP = 256


def no_hashes() -> Column:
    return F.array().cast("array<bigint>")


def codes(text: Column) -> Column:
    """The CRC-32 of each word of a text, words being parted by ASCII white space."""
    return F.transform(F.filter(F.split(text, WHITE), lambda w: w != ""), lambda w: F.crc32(w))


def sketch(words: Column, k: int = K, shingle: int = SHINGLE) -> Column:
    """The `k` least distinct shingle hashes of an array of word codes, ascending; fewer words than a shingle are one shingle.

    A hash is the XXH64 of a shingle's codes. Parts of the text are sketched by
    themselves and merged. `words` should be a stored column (`computed`),
    since every shingle reads it.
    """
    n = F.size(words)
    shingles = F.when(n < shingle, F.least(n, F.lit(1))).otherwise(n - (shingle - 1))

    def part(at: Column) -> Column:
        places = F.sequence(at, F.least(at + (PART - 1), shingles - 1))
        # Words beyond the end are null, and a null leaves the hash as it is.
        return least(F.transform(places, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(shingle)])), k)

    starts = F.sequence(F.lit(0), shingles - 1, F.lit(PART))
    parts = F.when(n > 0, least(F.flatten(F.transform(starts, part)), k))
    return F.coalesce(parts, no_hashes())


def least(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two shingle sets, from their sketches."""
    return least(F.concat(a, b), k)


def merged_groups(sketches: DataFrame, keys: list[str], sketch_col: str = "sketch", k: int = K) -> DataFrame:
    """One sketch per group, that of all its rows' shingles together.

    Every task first reduces a group to `k` hashes, so a group that holds a
    third of all rows sends `k` hashes per task to its one row.
    """
    hashes = sketches.select(*keys, F.explode(sketch_col).alias("_hash"))
    ranked = Window.partitionBy(*keys).orderBy("_hash")
    lowest = hashes.groupBy(*keys, "_hash").agg(F.lit(1).alias("_one")).withColumn("_place", F.row_number().over(ranked))
    found = lowest.where(F.col("_place") <= k).groupBy(*keys).agg(F.sort_array(F.collect_list("_hash")).alias(sketch_col))
    groups = sketches.select(*keys).distinct()
    same = [groups[c].eqNullSafe(found[c]) for c in keys]
    joined = groups.join(found, same, "left").select(*[groups[c] for c in keys], F.coalesce(found[sketch_col], no_hashes()).alias(sketch_col))
    return joined


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of shingles common to both among all of both; two empty sketches are alike."""
    union = merged(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(union, a), b))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(common / F.size(union))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """The number of distinct shingles: exact below `k`, else estimated from the place of the k-th least hash."""
    share = (F.get(a, k - 1).cast("double") - F.lit(float(SIGN))) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """The estimated share of the first text's shingles that the second one has.

    Taken over the first sketch's hashes up to where both sketches are whole;
    null where there is none, 1 for an empty first sketch.
    """
    top = F.least(*[F.when(F.size(s) >= k, F.get(s, k - 1)).otherwise(F.lit((1 << 63) - 1)) for s in (a, b)])
    seen = F.filter(a, lambda h: h <= top)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(seen, b)) / F.nullif(F.size(seen), F.lit(0)))


def as_text(hashes: Column) -> Column:
    """A sketch as a string of 16 hex digits a hash; strings sort as sketches do."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h.bitwiseXOR(F.lit(SIGN))), 16, "0"))), "")


def as_hashes(text: Column) -> Column:
    """The sketch a string of `as_text` holds."""
    count = (F.length(text) / 16).cast("int")

    def half(at: Column) -> Column:
        return F.conv(F.substring(text, at, F.lit(8)), 16, 10).cast("long")

    def read(i: Column) -> Column:
        high, low = half(i * 16 + 1), half(i * 16 + 9)
        return F.shiftleft(high, 32).bitwiseOR(low).bitwiseXOR(F.lit(SIGN))

    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), read)).otherwise(no_hashes())


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, sketch) of every row's whole text, words being parted by ASCII white space.

    Null and empty texts have an empty sketch. Rows may repeat, ids may be
    null, other columns are not read, an empty table gives an empty one.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return computed(texts, words=codes(F.col("text"))).select("doc_id", sketch(F.col("words"), k, shingle).alias("sketch"))


def _givers(ids: DataFrame, group: Column) -> DataFrame:
    """(giver, taker): for each group of neighbouring ids the largest id of the next lower group; the lowest takes the top id.

    `ids` are distinct; a null id is below all others. Groups look for their
    neighbour inside blocks of 2^16 groups, then blocks do inside blocks of
    blocks, and so on, so that no window holds more than 2^16 rows.
    """
    level = stored(ids.groupBy(group.alias("key")).agg(F.max("id").alias("high"), F.first(group).alias("first")), "id-groups")
    found = []
    for height in range(4):
        block = F.shiftright("key", 16) if height < 3 else F.lit(0)
        below = Window.partitionBy("block").orderBy("key")
        ranked = level.withColumn("block", block).withColumn("before", F.lag(F.struct("high")).over(below))
        found.append(ranked.where("before IS NOT NULL").select(F.col("before.high").alias("giver"), F.col("first").alias("taker")))
        level = ranked.groupBy(F.col("block").cast("long").alias("key")).agg(F.max_by("high", "key").alias("high"), F.min_by("first", "key").alias("first"))
    ends = level.select(F.col("high").alias("giver"), F.col("first").alias("taker"))
    for part in found:
        ends = ends.unionByName(part)
    return ends


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch): every row with the row after it in descending order of ids.

    Rows without an id come after all others, rows of equal id follow each
    other by their text's SHA-256, and the first row comes after the last one
    (a single row follows itself). Null texts are empty. Ids are integers.

    Texts are sketched and shuffled once, by groups of neighbouring ids. Of
    each group the last row's successor is the first row of another group:
    those rows, one of `GROUP` on average, are sent to both. A group is one
    sorted run that spills, so ids that repeat very often cost time, not memory.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    about = base.agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("rows")).first()
    width = 1 if about.low is None else max(1, -(-(about.high - about.low + 1) * GROUP // about.rows))
    # Division in doubles never changes the order of ids, so a group is an interval whatever the ids are.
    group = F.coalesce(F.floor((F.col("id").cast("double") - F.lit(float(about.low or 0))) / F.lit(float(width))), F.lit(-1))
    givers = _givers(base.select("id").distinct(), group).groupBy("giver").agg(F.collect_list("taker").alias("takers"))
    givers = stored(givers, "id-givers")
    sketched = computed(base, words=codes(F.col("text")), sha=F.sha2("text", 256))
    sketched = sketched.select("id", "text", "sha", sketch(F.col("words"), k, shingle).alias("sketch"))
    marked = sketched.join(givers, sketched["id"].eqNullSafe(givers["giver"]), "left")
    # `turn` 0 is the row in its own group, 1 the row as a group's successor.
    own = F.array(F.struct(group.alias("group"), F.lit(0).alias("turn")))
    others = F.transform(
        F.coalesce("takers", F.array().cast("array<bigint>")), lambda t: F.struct(t.alias("group"), F.lit(1).alias("turn"))
    )
    placed = marked.select("id", "text", "sha", "sketch", F.inline(F.concat(own, others)))
    order = Window.partitionBy("group").orderBy("turn", F.col("id").desc_nulls_last(), "sha")
    after = {"next_text": F.lead("text").over(order), "next_sketch": F.lead("sketch").over(order)}
    followed = placed.withColumns(after).where("turn = 0")
    return followed.select(F.col("id").alias("doc_id"), "text", "sketch", *after)


def half_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Every document's fingerprint beside those of an edited text and of the next document.

    The edited text has its last floor(n_chars / 2) code points replaced by as
    many of the next document's first ones (or all of them, if it has fewer).
    Order, null and repeated rows are those of `with_next`; columns doc_id,
    n_chars, edited, sketch, edited_sketch, next_sketch.
    """
    rows = with_next(docs, id_col, text_col, k, shingle)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", n - half), F.left("next_text", half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    words = computed(rows, words=codes(F.col("edited")))
    return words.select("doc_id", "n_chars", "edited", "sketch", sketch(F.col("words"), k, shingle).alias("edited_sketch"), "next_sketch")


# The five primes of XXH64, and the polynomial of CRC-32.
PRIMES = (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
CRC_POLYNOMIAL = 3988292384


def oracle() -> str:
    """DuckDB SQL of the registered query; XXH64 is written out in 128-bit arithmetic modulo 2^64."""
    p1, p2, p3, p4, p5 = (f"{p}::UHUGEINT" for p in PRIMES)
    mask = f"{(1 << 64) - 1}::UHUGEINT"

    def turned(value: str, by: int) -> str:
        return f"((({value} * {1 << by}::UHUGEINT) & {mask}) + ({value} >> {64 - by}))"

    rows = f"SELECT doc_id, kind, i, {', '.join(f'k{j}' for j in range(SHINGLE))}, 42::UHUGEINT AS h FROM shingles"
    keep = f"doc_id, kind, i, {', '.join(f'k{j}' for j in range(SHINGLE))}"
    for j in range(SHINGLE):
        rows = f"SELECT {keep}, h AS h0, xor((h + {p5} + 8) & {mask}, coalesce(k{j}, 0)) AS h FROM ({rows})"
        rows = f"SELECT {keep}, h0, ({turned('h', 27)} * {p1} + {p4}) & {mask} AS h FROM ({rows})"
        for by, prime in ((33, p2), (29, p3)):
            rows = f"SELECT {keep}, h0, (xor(h, h >> {by}) * {prime}) & {mask} AS h FROM ({rows})"
        rows = f"SELECT {keep}, CASE WHEN k{j} IS NULL THEN h0 ELSE xor(h, h >> 32) END AS h FROM ({rows})"
    pieces = ", ".join(f"words[i + {j + 1}] AS w{j}" for j in range(SHINGLE))
    joins = " ".join(f"LEFT JOIN vocabulary v{j} ON v{j}.w = w{j}" for j in range(SHINGLE))
    keys = ", ".join(f"v{j}.k AS k{j}" for j in range(SHINGLE))

    def alike(a: str, b: str) -> str:
        union = f"list_sort(list_distinct(list_concat({a}, {b})))[1:{K}]"
        return f"CASE WHEN len({union}) = 0 THEN 1.0 ELSE len(list_intersect(list_intersect({union}, {a}), {b})) / len({union}) END"

    return rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        placed AS (
            SELECT doc_id, text, coalesce(lead(doc_id) OVER w, first_value(doc_id) OVER w) AS next_id,
                   coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text
            FROM d WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, sha256(text) ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
        ),
        edits AS (
            SELECT doc_id, next_id, text, length(text) AS n_chars,
                   left(text, length(text) - length(text) // 2) || left(next_text, length(text) // 2) AS edited
            FROM placed
        ),
        split AS (
            SELECT doc_id, kind, regexp_extract_all(t, '[^ 	-
]+') AS words
            FROM (SELECT doc_id, 0 AS kind, text AS t FROM edits UNION ALL SELECT doc_id, 1, edited FROM edits)
        ),
        crc AS (
            SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, s: CASE WHEN c % 2 = 1
                   THEN xor({CRC_POLYNOMIAL}, c // 2) ELSE c // 2 END, n)) AS steps
        ),
        distinct_words AS (SELECT DISTINCT unnest(words) AS w FROM split),
        coded AS (
            SELECT w, xor(list_reduce(list_transform(range(octet_length(encode(w))),
                     lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT),
                   lambda c, b: xor(steps[xor(c, b) % 256 + 1], c // 256), 4294967295::BIGINT), 4294967295)::UHUGEINT AS code
            FROM distinct_words, crc
        ),
        first_step AS (SELECT w, (code * {p2}) & {mask} AS a FROM coded),
        vocabulary AS (SELECT w, ({turned('a', 31)} * {p1}) & {mask} AS k FROM first_step),
        places AS (SELECT doc_id, kind, words, unnest(range(greatest(least(len(words), 1), len(words) - {SHINGLE - 1}))) AS i FROM split),
        shingle_words AS (SELECT doc_id, kind, i, {pieces} FROM places),
        shingles AS (SELECT doc_id, kind, i, {keys} FROM shingle_words {joins}),
        hashed AS ({rows}),
        ranked AS (
            SELECT doc_id, kind, v, row_number() OVER (PARTITION BY doc_id, kind ORDER BY v) AS place
            FROM (SELECT DISTINCT doc_id, kind, xor(h, {1 << 63}::UHUGEINT)::UBIGINT AS v FROM hashed)
        ),
        sketches AS (SELECT doc_id, kind, list(v ORDER BY v) AS hashes FROM ranked WHERE place <= {K} GROUP BY doc_id, kind),
        found AS (
            SELECT e.doc_id, e.n_chars, e.edited, coalesce(a.hashes, []) AS a, coalesce(b.hashes, []) AS b, coalesce(c.hashes, []) AS c
            FROM edits e LEFT JOIN sketches a ON a.doc_id = e.doc_id AND a.kind = 0
            LEFT JOIN sketches b ON b.doc_id = e.doc_id AND b.kind = 1 LEFT JOIN sketches c ON c.doc_id = e.next_id AND c.kind = 0
        )
        SELECT doc_id, n_chars, sha256(edited) AS edited_sha256,
               array_to_string(list_transform(a, lambda v: lower(lpad(to_hex(v), 16, '0'))), '') AS fingerprint,
               array_to_string(list_transform(b, lambda v: lower(lpad(to_hex(v), 16, '0'))), '') AS edited_fingerprint,
               {alike('a', 'b')}::DOUBLE AS near_edited, {alike('a', 'c')}::DOUBLE AS near_next
        FROM found
    """
