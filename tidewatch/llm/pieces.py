"""SentencePiece encoding and decoding as a max-plus scan over chunks of documents."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import stored

CHUNK_CHARS = 16_384
FAN = 64
SPACE = "▁"
NEVER = float("-inf")
CACHE = 400_000
HEAD = 4
SPACED = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

# A boundary state is the piece that covers the last character before the
# boundary, as (start, end) relative to the boundary: start < 0 <= end.
START = (0, 0)


class Vocabulary:
    """Pieces, their scores and which may follow which.

    kind "unigram": any piece may follow any; the best path has the largest sum
    of scores. kind "bpe": every weight is 0 or -inf, and a piece may follow
    another exactly when merging their joint text by score gives these two
    again. Merges work locally, so a sequence is the merge result of a text if
    and only if each neighbouring pair is: one path has weight 0, all others
    -inf. The same max-plus algebra thus serves both.
    """

    def __init__(self, pieces: list[str], scores: list[float], kind: str, controls: set[int] = frozenset(), raw_bytes: dict[int, int] | None = None, unknown: int = 0, dummy_prefix: bool = True):
        self.pieces, self.kind, self.unknown, self.dummy_prefix = pieces, kind, unknown, dummy_prefix
        self.bytes = raw_bytes or {}
        self.of_byte = {b: i for i, b in self.bytes.items()}
        skip = set(controls) | set(self.bytes)
        self.ids = {p: i for i, p in enumerate(pieces) if i not in skip}
        self.names = {p: p for p in self.ids}
        self.scores = {p: scores[i] for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids), default=1)
        # Pieces by their first four characters, and of each start met the valid pieces there, longest first.
        self.heads: dict[str, list[str]] = {}
        for p in self.ids:
            self.heads.setdefault(p[:HEAD], []).append(p)
        self.starts: dict[str, tuple[str, ...]] = {}
        self.lowest = min(self.scores.values(), default=0.0) - 10.0
        inner = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.inner = inner
        self.space_cuts = not any(x[1] == SPACE and x[0] != SPACE for x in inner)
        self.line_cuts = not any("\n" in p for p in self.ids)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.reached: dict[str, bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.bare: dict[str, tuple[int, ...]] = {}
        table = {i: p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)}
        table.update({i: b"" for i in controls})
        table.update({i: bytes([b]) for i, b in self.bytes.items()})
        self.table = table

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging the best-scored neighbours first, leftmost of equals."""
        parts, score = list(text), self.scores.get
        gains = [score(a + b) for a, b in zip(parts, parts[1:])]
        while True:
            best, at = None, -1
            for i, gain in enumerate(gains):
                if gain is not None and (best is None or gain > best):
                    best, at = gain, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del gains[at]
            if at < len(gains):
                gains[at] = score(parts[at] + parts[at + 1])
            if at:
                gains[at - 1] = score(parts[at - 1] + parts[at])

    def follows(self, a: str, b: str) -> bool:
        if self.kind == "unigram":
            return True
        key = (a, b)
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            known = self.pairs[key] = a[-1] + b[0] not in self.inner or self.merged(a + b) == [a, b]
        return known

    def valid(self, piece: str) -> bool:
        """In the vocabulary and reachable by merges, or a single character of its own."""
        if len(piece) == 1 or piece not in self.ids:
            return len(piece) == 1
        if self.kind == "unigram":
            return True
        if (known := self.reached.get(piece)) is None:
            known = self.reached[piece] = self.merged(piece) == [piece]
        return known

    def weight(self, piece: str) -> float:
        return 0.0 if self.kind == "bpe" else self.scores.get(piece, self.lowest)

    def paths(self, text: str, first: int, last: str | None, stop: int) -> list[tuple[float, int, str] | None]:
        """Best (weight, start, piece) of the pieces ending at each position from `first` to `stop`; `last` ends at first."""
        best: list[tuple[float, int, str] | None] = [None] * (stop + 1)
        best[first] = (0.0, first, last or "")
        ids, longest, unigram = self.ids, self.longest, self.kind == "unigram"
        for end in range(first + 1, stop + 1):
            found = None
            for start in range(max(first, end - longest), end):
                before = best[start]
                if before is None:
                    continue
                piece = text[start:end]
                if piece not in ids and end - start > 1:
                    continue
                if unigram:
                    total = before[0] + self.scores.get(piece, self.lowest)
                    if found is None or total > found[0]:
                        found = (total, start, piece)
                elif self.valid(piece) and (not before[2] or self.follows(before[2], piece)):
                    found = (0.0, start, piece)
                    break
            best[end] = found
        return best

    def back(self, best: list, first: int, stop: int) -> list[str]:
        found = []
        while stop > first:
            _, start, piece = best[stop]
            found.append(piece)
            stop = start
        return found[::-1]

    def to_ids(self, pieces: list[str]) -> list[int]:
        found = []
        for p in pieces:
            if (i := self.ids.get(p)) is not None:
                found.append(i)
            elif self.of_byte:
                found += [self.of_byte[b] for b in p.encode()]
            else:
                found.append(self.unknown)
        return found

    def starting(self, head: str) -> tuple[str, ...]:
        """The valid pieces a text may begin with whose first characters are `head`, longest first, and its first character."""
        found = self.heads.get(head, []) if len(head) == HEAD else []
        found = found + [self.names[head[:n]] for n in range(2, min(len(head) + 1, HEAD)) if head[:n] in self.names]
        first = self.names.get(head[0], head[0])
        if len(self.starts) >= CACHE:
            self.starts.clear()
        ordered = sorted((p for p in found if len(p) > 1 and self.valid(p)), key=len, reverse=True)
        self.starts[head] = (*ordered, first)
        return self.starts[head]

    def walk(self, text: str) -> list[str]:
        """The path of weight 0 through a text between cuts: longest pieces first, and back from dead ends."""
        path, dead, at, stop = [], set(), 0, len(text)
        starts, pairs = self.starts, self.pairs
        most, last = stop, ""
        while at < stop:
            head = text[at : at + HEAD]
            # One string stands for each piece, however many pairs hold it.
            for piece in starts.get(head) or self.starting(head):
                if text.startswith(piece, at) and len(piece) <= most:
                    if not last:
                        break
                    if (fits := pairs.get((last, piece))) is None:
                        fits = self.follows(last, piece)
                    if fits and not (dead and (at, piece) in dead):
                        break
            else:
                piece = path.pop()
                last = path[-1] if path else ""
                at -= len(piece)
                dead.add((at, piece))
                most = len(piece) - 1
                continue
            path.append(piece)
            last = piece
            at += len(piece)
            most = stop
        return path

    def best(self, text: str) -> list[str]:
        """The pieces of the best path through a text between cuts."""
        if self.kind == "bpe":
            return self.walk(text)
        return self.back(self.paths(text, 0, None, len(text)), 0, len(text))

    def segment(self, text: str) -> tuple[int, ...]:
        """Ids of a text between two cuts no piece can cross."""
        if (found := self.known.get(text)) is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            found = self.known[text] = tuple(self.to_ids(self.best(text)))
        return found

    def between_cuts(self, text: str) -> list[int]:
        """Ids of a text that starts and ends at cuts."""
        out: list[int] = []
        for i, line in enumerate(text.split("\n")) if self.line_cuts else enumerate([text]):
            if i:
                out += self.segment("\n")
            if not self.space_cuts:
                out += self.segment(line) if line else ()
            elif SPACE + SPACE in line or line.endswith(SPACE):
                for x in SPACED.findall(line):
                    out += self.segment(x)
            else:
                head, *rest = line.split(SPACE)
                if head:
                    out += self.segment(head)
                bare = self.bare
                for word in rest:
                    if (found := bare.get(word)) is None:
                        if len(bare) >= CACHE:
                            bare.clear()
                        # A last character no piece joins to the one before is a segment of its own.
                        stem = word[:-1] if word[-2:] not in self.inner and len(word) > 1 else word
                        if (found := bare.get(stem)) is None:
                            found = bare[stem] = tuple(self.to_ids(self.best(SPACE + stem)))
                        if stem is not word:
                            found = bare[word] = found + self.segment(word[-1])
                    out += found
        return out

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text

    def cuts(self, text: str, low: int, high: int) -> tuple[int, int] | None:
        """First and last position in [low, high) that no piece can cross; the start of a document is one."""

        def cut(p: int) -> bool:
            return p == 0 or text[p - 1] + text[p] not in self.inner

        first = next((p for p in range(low, high) if cut(p)), None)
        if first is None:
            return None
        return first, next(p for p in range(high - 1, first - 1, -1) if cut(p))

    def states(self, text: str, at: int) -> list[tuple[int, int]]:
        """Boundary states at position `at`, relative to it."""
        if at == 0:
            return [START]
        found = []
        for start in range(max(0, at - self.longest), at):
            for end in range(at, min(len(text), start + self.longest) + 1):
                if end > start and self.valid(text[start:end]) and (text[start:end] in self.ids or end - start == 1):
                    found.append((start - at, end - at))
        return found


def chunk(text: str, at: int, size: int, around: int) -> tuple[str, int, int]:
    """The text of one chunk with `around` characters on both sides, and where the chunk starts and stops in it."""
    low = max(0, at - around)
    stop = min(len(text), at + size)
    return text[low : stop + around], at - low, stop - low


def transfer(v: Vocabulary, text: str, start: int, stop: int) -> dict[tuple[int, int], dict[tuple[int, int], float]]:
    """Weight of the best path from each state at `start` to each state at `stop` (at the text's end: to the end itself)."""
    ends = [s for s in v.states(text, stop) if stop + s[1] <= len(text)]
    if stop == len(text):
        ends = [s for s in ends if s[1] == 0]
    cuts = v.cuts(text, start, stop)
    tails: dict[tuple[int, int], float] = {}
    if cuts:
        best = v.paths(text, cuts[1], None, stop)
        for s in ends:
            tails[s] = _reach(v, text, best, cuts[1], stop, s)
        middle = _middle(v, text, *cuts)
    matrix = {}
    for s in v.states(text, start):
        at, last = start + s[1], text[start + s[0] : start + s[1]] or None
        if cuts and at <= cuts[0]:
            head = v.paths(text, at, last, cuts[0])[cuts[0]]
            if head is not None:
                matrix[s] = {e: head[0] + middle + w for e, w in tails.items() if w > NEVER}
        elif not cuts and at <= stop:
            best = v.paths(text, at, last, stop)
            row = {e: w for e in ends if (w := _reach(v, text, best, at, stop, e, last, start + s[0])) > NEVER}
            matrix[s] = row
    return matrix


def _middle(v: Vocabulary, text: str, low: int, high: int) -> float:
    if v.kind == "bpe" or low == high:
        return 0.0
    return v.paths(text, low, None, high)[high][0]


def _reach(v, text, best, first, stop, state, last=None, came=None) -> float:
    """Weight of the path from `first` whose last piece is the state's one."""
    start, end = stop + state[0], stop + state[1]
    if start < first:
        # The state's piece is the one the path came with.
        return 0.0 if came == start and end == first and last else NEVER
    before = best[start]
    piece = text[start:end]
    if before is None or (before[2] and not v.follows(before[2], piece)):
        return NEVER
    return before[0] + v.weight(piece)


def times(a: dict, b: dict) -> dict:
    """Max-plus product of two transfer matrices."""
    out = {}
    for s, row in a.items():
        best: dict = {}
        for m, w in row.items():
            for e, x in b.get(m, {}).items():
                if w + x > best.get(e, NEVER):
                    best[e] = w + x
        out[s] = best
    return out


def pack(matrix: dict) -> list[dict]:
    return [{"a": s[0], "b": s[1], "c": e[0], "d": e[1], "w": w} for s, row in matrix.items() for e, w in row.items()]


def unpack(cells) -> dict:
    matrix: dict = {}
    for x in cells:
        matrix.setdefault((x["a"], x["b"]), {})[(x["c"], x["d"])] = x["w"]
    return matrix


def backtrace(v: Vocabulary, text: str, start: int, stop: int, came: tuple[int, int], left: tuple[int, int]) -> list[int]:
    """Ids of the pieces that start in [start, stop), given the states at both boundaries."""
    at, last = start + came[1], text[start + came[0] : start + came[1]] or None
    end_start, end = stop + left[0], stop + left[1]
    if end_start < start:
        return []
    cuts = v.cuts(text, start, stop)
    if cuts and at <= cuts[0]:
        head = v.back(v.paths(text, at, last, cuts[0]), at, cuts[0])
        ids = v.to_ids(head) + v.between_cuts(text[cuts[0] : cuts[1]])
        best = v.paths(text, cuts[1], None, end_start)
        return ids + v.to_ids([*v.back(best, cuts[1], end_start), text[end_start:end]])
    best = v.paths(text, at, last, end_start)
    return v.to_ids([*v.back(best, at, end_start), text[end_start:end]])


CELL = "array<struct<a:int,b:int,c:int,d:int,w:double>>"
MODELS: dict[int, Vocabulary] = {}


def _key(model: dict) -> int:
    return zlib.crc32(repr((model["pieces"], model["scores"], model["kind"])).encode())


def _model(key: int, sent) -> Vocabulary:
    """The vocabulary of this worker, with the words it has met in earlier tasks."""
    if (found := MODELS.get(key)) is None:
        MODELS.clear()
        found = MODELS[key] = Vocabulary(**sent.value)
    return found


def load(path: str, kind: str = "bpe") -> dict:
    """What a vocabulary is made of, read on the driver; its size is that of the model file."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in ids]
    return {
        "pieces": pieces,
        "scores": [model.get_score(i) for i in ids],
        "kind": kind,
        "controls": {i for i in ids if model.is_control(i) or model.is_unknown(i)},
        "raw_bytes": {i: int(pieces[i][3:5], 16) for i in ids if model.is_byte(i)},
        "unknown": model.unk_id(),
    }


def escaped(v: Vocabulary, text: str | None) -> str:
    return (SPACE if v.dummy_prefix else "") + text.replace(" ", SPACE) if text else ""


def encode_whole(v: Vocabulary, text: str) -> list[int]:
    """Ids of an escaped text as one chunk."""
    if not text:
        return []
    row = transfer(v, text, 0, len(text))[START]
    return backtrace(v, text, 0, len(text), START, max(row, key=row.get))


def _product(matrices: list[dict]) -> list[dict]:
    """One matrix of consecutive ones."""
    found = unpack(matrices[0]["cells"])
    for x in matrices[1:]:
        found = times(found, unpack(x["cells"]))
    return pack(found)


def _states(matrices: list[dict], first: tuple[int, int], at: tuple[int, int]) -> list[tuple[int, ...]]:
    """The states (a, b, c, d) at both ends of each of a parent's matrices, on the best path between the parent's two states."""
    here = {first: 0.0}
    steps = []
    for x in matrices:
        came: dict = {}
        for s, row in unpack(x["cells"]).items():
            if s in here:
                for e, w in row.items():
                    if here[s] + w > came.get(e, (NEVER,))[0]:
                        came[e] = (here[s] + w, s)
        steps.append(came)
        here = {e: w for e, (w, _) in came.items()}
    if at[0] > 0:  # the last matrix of a document: its best end
        at = max(here, key=here.get)
    ends = []
    for came in reversed(steps):
        ends.append((*came[at][1], *at))
        at = came[at][1]
    return ends[::-1]


def encode(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS, fan: int = FAN) -> DataFrame:
    """(doc_id, n_chunks, ids) of every whole text.

    Texts of up to `chunk_chars` characters are one chunk. A longer text is cut
    anywhere into chunks; each gives the matrix of best weights from the pieces
    that may cover its left border to those that may cover its right one.
    Matrices are multiplied `fan` at a time up a tree, the states at all
    borders follow on the way down, and each chunk is then traced back alone.
    Null and empty texts have no ids. Ids may be null and rows may repeat;
    other columns aren't read; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    key, sent = _key(model), spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _model(key, sent)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids = [encode_whole(v, escaped(v, x.as_py())) for x in part.column(1)]
                some = pa.array([min(1, len(x)) for x in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), some, pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "n_chunks", "ids"])

    size = F.coalesce(F.char_length("text"), F.lit(0)) + 1
    short = given.where(size <= chunk_chars).mapInArrow(whole, f"doc_id {kind}, n_chunks long, ids array<int>")
    long = stored(given.where(size > chunk_chars).withColumn("key", F.monotonically_increasing_id()), "long-texts")
    if not long.limit(1).count():
        return short

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _model(key, sent)
        for batch in batches:
            for i in range(batch.num_rows):
                doc, text = batch.column(0)[i].as_py(), escaped(v, batch.column(1)[i].as_py())
                for no, at in enumerate(range(0, len(text), chunk_chars)):
                    # A last chunk shorter than a piece would hold none of its own.
                    if at and len(text) - at <= v.longest:
                        break
                    size = chunk_chars if len(text) - at - chunk_chars > v.longest else len(text) - at
                    window, start, stop = chunk(text, at, size, v.longest)
                    cells = pack(transfer(v, window, start, stop))
                    row = {"key": doc, "no": no, "window": window, "start": start, "stop": stop, "cells": cells}
                    yield pa.RecordBatch.from_pylist([row], schema)

    cell = pa.struct([(x, pa.int32()) for x in "abcd"] + [("w", pa.float64())])
    schema = pa.schema([("key", pa.int64()), ("no", pa.int64()), ("window", pa.string()), ("start", pa.int32()), ("stop", pa.int32()), ("cells", pa.list_(cell))])
    spread = long.select("key", "text").repartition("key")
    chunks = stored(spread.mapInArrow(cut, f"key long, no long, window string, start int, stop int, cells {CELL}"), "chunks")
    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [_product(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells, schema.field("cells").type)], names=["key", "no", "cells"])

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.to_pylist():
                states = _states(x["matrices"], (x["a"], x["b"]), (x["c"], x["d"]))
                rows += [(x["key"], m["no"], *s) for m, s in zip(x["matrices"], states, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), borders, strict=True)], schema=borders) if rows else borders.empty_table().to_batches()[0]

    borders = pa.schema([("key", pa.int64()), ("no", pa.int64()), *[(x, pa.int32()) for x in "abcd"]])
    # A parent's matrices in one row, `fan` at most.
    matrices = F.array_sort(F.collect_list(F.struct("no", "cells"))).alias("matrices")
    up = F.floor(F.col("no") / fan).cast("long").alias("up")
    levels = [chunks.select("key", "no", "cells")]
    most = chunks.agg(F.max("no")).first()[0] + 1
    while most > 1:
        grouped = levels[-1].groupBy("key", up).agg(matrices).select("key", "up", "matrices")
        levels.append(stored(grouped.mapInArrow(multiplied, f"key long, no long, cells {CELL}"), "products"))
        most = -(-most // fan)
    border = [F.lit(x).alias(n) for n, x in (("a", 0), ("b", 0), ("c", 1), ("d", 0))]
    states = levels[-1].select("key", F.col("no").alias("up"), *border)
    for level in reversed(levels[:-1]):
        below = level.groupBy("key", up).agg(matrices).join(states, ["key", "up"])
        states = below.mapInArrow(entered, "key long, no long, a int, b int, c int, d int")
        states = stored(states, "states").withColumnRenamed("no", "up")

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _model(key, sent)
        for batch in batches:
            for x in batch.to_pylist():
                left = (x["c"], x["d"])
                ids = backtrace(v, x["window"], x["start"], x["stop"], (x["a"], x["b"]), left)
                yield pa.RecordBatch.from_pylist([{"key": x["key"], "no": x["no"], "ids": ids}], traces)

    traces = pa.schema([("key", pa.int64()), ("no", pa.int64()), ("ids", pa.list_(pa.int32()))])
    traced_chunks = chunks.drop("cells").join(states.withColumnRenamed("up", "no"), ["key", "no"])
    traced_chunks = traced_chunks.mapInArrow(traced, "key long, no long, ids array<int>")
    ids = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("no", "ids"))), lambda x: x["ids"]))
    joined = traced_chunks.groupBy("key").agg(F.count(F.lit(1)).alias("n_chunks"), ids.alias("ids"))
    found = long.select("key", "doc_id").join(joined, "key").select("doc_id", "n_chunks", "ids")
    return short.union(found)


def decode(encoded: DataFrame, model: dict, ids_col: str = "ids") -> DataFrame:
    """`encoded` with the ids replaced by `text` and their number and checksum (n_tokens, ids_crc32)."""
    key, sent = _key(model), encoded.sparkSession.sparkContext.broadcast(model)
    others = [c for c in encoded.columns if c != ids_col]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _model(key, sent)
        names = [*others, "n_tokens", "ids_crc32", "text"]
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                lists = [x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.array([], np.int32) for x in part.column(ids_col)]
                texts = pa.array([v.decode(x.tolist()) for x in lists], pa.string())
                sums = pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in lists], pa.int64())
                counts = pa.array([len(x) for x in lists], pa.int64())
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in others], counts, sums, texts], names=names)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != ids_col)
    return encoded.mapInArrow(decoded, f"{kinds}, n_tokens long, ids_crc32 long, text string")
