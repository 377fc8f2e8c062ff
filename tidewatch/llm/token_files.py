"""Token ids in binary files: patched frame-of-reference blocks with an index of block starts."""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import stored
from tidewatch.session import working_folder

BLOCK = 128
SEGMENT = 1 << 14
PERCENTILE = 95
END_ID = 2
CACHE = 700_000
MAGIC = b"TWPF1\0\0\0"
HEAD = struct.Struct("<8sQQQ")  # magic, ids, documents, blocks
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
MARKS = re.compile("[\u0300-\u036f]")


def byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_CHARS = byte_chars()


def _widths(above: np.ndarray, percentile: int) -> np.ndarray:
    """Bits that hold the value at the percentile of each row."""
    spare = BLOCK - 1 - min(BLOCK - 1, BLOCK * percentile // 100)
    widths = np.zeros(len(above), np.uint8)
    for bits in range(int(above.max()).bit_length()):
        widths += np.count_nonzero(above >= (1 << bits), axis=1) > spare
    return widths


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width as rows of 64-bit words."""
    out = np.zeros((len(values), BLOCK * width // 64), np.uint64)
    columns = np.ascontiguousarray(values.T).astype(np.uint64)
    for k in range(BLOCK):
        word, shift = divmod(k * width, 64)
        out[:, word] |= columns[k] << np.uint64(shift)
        if shift + width > 64:
            out[:, word + 1] |= columns[k] >> np.uint64(64 - shift)
    return out


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    columns, mask = np.empty((BLOCK, len(words)), np.uint64), np.uint64((1 << width) - 1)
    words = np.ascontiguousarray(words.T)
    for k in range(BLOCK):
        word, shift = divmod(k * width, 64)
        column = words[word] >> np.uint64(shift)
        if shift + width > 64:
            column |= words[word + 1] << np.uint64(64 - shift)
        columns[k] = column & mask
    return columns.T


def _packed_blocks(padded: np.ndarray, percentile: int):
    """(payload, sizes, minima, widths, numbers of exceptions) of rows of BLOCK ids."""
    least = padded.min(axis=1)
    above = padded - least[:, None]
    widths = _widths(above, percentile)
    low = ((np.uint64(1) << widths.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
    out = above > low[:, None]
    counts = out.sum(axis=1)
    sizes = BLOCK // 8 * widths.astype(np.int64) + 5 * counts
    starts = np.cumsum(sizes) - sizes
    payload = np.zeros(int(sizes.sum()), np.uint8)
    for width in np.unique(widths[widths > 0]):
        rows = np.flatnonzero(widths == width)
        packed = _pack(above[rows] & low[rows, None], int(width)).astype("<u8").view(np.uint8).reshape(len(rows), -1)
        payload[(starts[rows, None] + np.arange(packed.shape[1])).ravel()] = packed.ravel()
    block, position = np.nonzero(out)
    if len(block):
        high = (above[block, position].astype(np.uint64) >> widths[block].astype(np.uint64)).astype("<u4")
        nth = np.arange(len(block)) - (np.cumsum(counts) - counts)[block]
        at = starts[block] + BLOCK // 8 * widths[block].astype(np.int64)
        payload[at + nth] = position
        at = at + counts[block] + 4 * nth
        payload[(at[:, None] + np.arange(4)).ravel()] = high.view(np.uint8)
    return payload, sizes, least, widths, counts


def write_ids(ids: np.ndarray, lengths: np.ndarray, names: list[int | None], percentile: int = PERCENTILE) -> bytes:
    """A file of unsigned 32-bit ids of documents of the given lengths and names (whole numbers or none).

    Layout: head; documents' lengths (u32), names (i64), whether named (u8);
    for every block its start in the payload (u64), minimum (u32), width (u8)
    and number of exceptions (u8); payload. A block's payload is its low bits,
    then its exceptions' positions (u8) and high bits (u32). The width holds
    the given percentile of the block's differences from its minimum. The last
    block is filled up with its minimum.
    """
    blocks = -(-len(ids) // BLOCK)
    named = np.array([x is not None for x in names], np.uint8)
    parts = [
        HEAD.pack(MAGIC, len(ids), len(lengths), blocks),
        np.asarray(lengths, "<u4").tobytes(),
        np.array([x or 0 for x in names], "<i8").tobytes(),
        named.tobytes(),
    ]
    found = []
    for at in range(0, len(ids), SEGMENT * BLOCK):
        some = ids[at : at + SEGMENT * BLOCK].astype(np.uint32)
        last = some[(len(some) - 1) // BLOCK * BLOCK :]
        some = np.concatenate((some, np.full(-len(some) % BLOCK, last.min(), np.uint32)))
        found.append(_packed_blocks(some.reshape(-1, BLOCK), percentile))
    if found:
        payloads, sizes, least, widths, counts = zip(*found, strict=True)
        sizes = np.concatenate(sizes)
        starts = (np.cumsum(sizes) - sizes).astype("<u8")
        columns = (starts, np.concatenate(least).astype("<u4"), np.concatenate(widths), np.concatenate(counts).astype(np.uint8))
        parts += [x.tobytes() for x in (*columns, *payloads)]
    return b"".join(parts)


def read_ids(data: bytes, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids, lengths, names, named) of a file; with `first` and `last`, only the ids of those blocks are decoded."""
    magic, n, docs, blocks = HEAD.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = HEAD.size

    def column(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(data, kind, count, at)
        at += found.nbytes
        return found

    about = column("<u4", docs), column("<i8", docs), column("u1", docs).astype(bool)
    if not blocks:
        return np.array([], np.uint32), *about
    starts, least = column("<u8", blocks).astype(np.int64), column("<u4", blocks)
    widths, counts = column("u1", blocks), column("u1", blocks).astype(np.int64)
    payload = np.frombuffer(data, np.uint8, offset=at)
    last = blocks if last is None else last
    ids = np.empty((last - first, BLOCK), np.uint32)
    for at in range(first, last, SEGMENT):
        some = slice(at, min(last, at + SEGMENT))
        ids[some.start - first : some.stop - first] = _blocks(payload, starts[some], least[some], widths[some], counts[some])
    return ids.ravel()[: max(0, n - first * BLOCK)], *about


def _blocks(payload: np.ndarray, starts: np.ndarray, least: np.ndarray, widths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    above = np.zeros((len(starts), BLOCK), np.uint32)
    for width in np.unique(widths[widths > 0]):
        rows = np.flatnonzero(widths == width)
        packed = payload[starts[rows, None] + np.arange(BLOCK // 8 * int(width))]
        above[rows] = _unpack(packed.view("<u8"), int(width))
    block = np.repeat(np.arange(len(starts)), counts)
    if len(block):
        nth = np.arange(len(block)) - (np.cumsum(counts) - counts)[block]
        where = starts[block] + BLOCK // 8 * widths[block].astype(np.int64)
        position = payload[where + nth]
        high = payload[(where + counts[block] + 4 * nth)[:, None] + np.arange(4)].view("<u4").ravel()
        above[block, position] |= (high.astype(np.uint64) << widths[block].astype(np.uint64)).astype(np.uint32)
    return above + least[:, None]


class WordEncoder:
    """Ids of whole texts by the tokenizers library, each word looked up once.

    The tokenizer drops white space, so a text's ids are those of its words in
    turn, and lower-cases, so ASCII capitals may go first where no mark that
    could join an ASCII letter follows. Special strings and texts this can't
    be said of go to the library whole.
    """

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        self.model = self.tokenizer.model
        vocab = self.tokenizer.get_vocab_size()
        self.code = "H" if vocab <= 1 << 16 else "I"
        self.kind = np.dtype(self.code)
        encoder = self

        class Words(dict):
            def __missing__(self, word: bytes) -> bytes:
                if len(self) >= CACHE:
                    self.clear()
                self[word] = found = encoder.word(word)
                return found

        self.words = Words()

    def packed(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def word(self, word: bytes) -> bytes:
        core = word.rstrip(b".,")
        if 0 < len(core) < len(word):
            return self.words[core] + self.words[word[len(core) :]] if core.isalpha() else self.whole(word.decode())
        text = word.decode()
        if text.isalpha() and text == text.lower() and (text.isascii() or is_normalized("NFC", text)):
            # Letters only, normalised and small: what the library's model is given after its own preparation.
            return self.packed([x.id for x in self.model.tokenize(word.decode("latin-1").translate(BYTE_CHARS))])
        return self.whole(text)

    def whole(self, text: str) -> bytes:
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.array([], self.kind)
        if "<|" in text:
            return np.frombuffer(self.whole(text), self.kind)
        data = text.encode()
        if text.isascii() or not MARKS.search(text):
            data = data.translate(LOWER)
        return np.frombuffer(b"".join(map(self.words.__getitem__, data.split())), self.kind)


ENCODERS: dict[int, WordEncoder] = {}


def _encoder(key: int, sent) -> WordEncoder:
    """The encoder of this worker, with the words it has met in earlier tasks."""
    if (found := ENCODERS.get(key)) is None:
        ENCODERS.clear()
        found = ENCODERS[key] = WordEncoder(sent.value)
    return found


def _files(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri if re.match(r"\w+:", uri) else f"file://{uri}")


def write_files(docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Token files of all documents in ascending id order; returns their manifest (part, path, n_docs, n_ids), stored.

    Documents are ranged by id, each range is one file, written under a name of
    its own try and known only through the manifest, so a task that runs again
    leaves at most a file nobody reads. A range's ids stay in the task that
    writes it. Null texts are empty; null ids come first; rows of equal ids are
    ordered by text. Ids are whole numbers of up to 64 bits. Extra columns
    aren't read; an empty table gives no file.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        source = file.read()
    key, sent = zlib.crc32(source.encode()), spark.sparkContext.broadcast(source)  # as large as the tokenizer's file
    given = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, ids, lengths, names = None, [], [], []
        end = np.array([end_id], np.uint32)
        for batch in batches:
            encoder = encoder or _encoder(key, sent)
            for at in range(0, batch.num_rows, 64):
                names += batch.column(0).slice(at, 64).to_pylist()
                for x in batch.column(1).slice(at, 64):
                    found = encoder.encode(x.as_py())
                    ids += [found, end.astype(encoder.kind)]
                    lengths.append(len(found) + 1)
        if encoder is None:
            return
        data = write_ids(np.concatenate(ids), np.array(lengths), names)
        part = TaskContext.get().partitionId()
        files, path = _files(f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.twpf")
        files.create_dir(path.rpartition("/")[0])
        with files.open_output_stream(path) as out:
            out.write(data)
        row = {"part": part, "path": path, "n_docs": len(lengths), "n_ids": int(sum(lengths))}
        yield pa.RecordBatch.from_pylist([row])

    ranged = given.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    return ranged.select(F.col("doc_id").cast("long"), "text").mapInArrow(written, "part long, path string, n_docs long, n_ids long")


def read_files(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of a stored manifest, read back from them by about a task a file."""
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # over one row a file
    placed = manifest.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, _ = _files(folder)
                with files.open_input_file(row["path"]) as file:
                    ids, lengths, names, named = read_ids(file.read())
                lengths = lengths.astype(np.int64)
                ends = np.cumsum(lengths)
                sums = [zlib.crc32(ids[e - n : e].astype("<u4").tobytes()) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                found = [pa.array(names, mask=~named), *map(pa.array, (row["first"] + ends - lengths, lengths, np.array(sums, np.int64)))]
                yield pa.RecordBatch.from_arrays(found, names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # A stated number of partitions is one AQE doesn't join into few.
    spread = placed.repartition(max(1, manifest.count()), "part").select("path", "first")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """Writes the files into `folder` (the shared one unless given) and returns what `read_files` finds in them."""
    folder = folder or working_folder(docs.sparkSession, "token-files")
    manifest = stored(write_files(docs, tokenizer_path, folder, id_col, text_col), "token-manifest")
    return read_files(manifest, folder)
