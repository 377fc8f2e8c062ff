"""Periodic runs of words: dyadic blocks look for themselves in neighbouring windows, progressions of finds name periods."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import WHITE, computed, text_or_empty

# A run has at least LEAST words and TIMES periods. The smallest block fits a run of any period up to its size.
LEAST = 24
TIMES = 3
BASE = 3
# Words of short texts searched at once.
BATCH_WORDS = 1 << 17


class Ranks:
    """A text's suffix order by prefix doubling.

    `levels[k][i]` is the number of suffixes that sort before all those which
    share the 2^k words from i on, so two places have equal ranks if and only
    if 2^k words are equal there. `repeated[k]` are the places whose 2^k words
    occur again, with the number of their occurrences. Only those are sorted
    further, so a level costs what is still undecided. The text's words are
    numbered from 0 without gaps and its last word occurs once.
    """

    def __init__(self, words: np.ndarray):
        counts = np.bincount(words)
        rank = (np.cumsum(counts) - counts)[words]
        active = np.flatnonzero(counts[words] > 1)
        self.levels = [rank.astype(np.int32)]
        self.repeated = [(active, counts[words[active]])]
        step, size = 1, len(words) + 1
        while len(active):
            key = rank[active] * size + rank[active + step]
            order = np.argsort(key)
            active, key = active[order], key[order]
            before = key // size
            places = np.arange(len(key))
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            group = np.maximum.accumulate(np.where(np.concatenate(([True], before[1:] != before[:-1])), places, 0))
            sizes = np.diff(np.append(starts, len(key)))
            rank[active] = before + np.repeat(starts, sizes) - group
            self.levels.append(rank.astype(np.int32))
            again = np.repeat(sizes, sizes)
            active, again = active[again > 1], again[again > 1]
            self.repeated.append((active, again))
            step *= 2

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on."""
        same = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 2, -1, -1):
            rank = self.levels[k]
            same += (rank[i + same] == rank[j + same]).astype(np.int64) << k
        return same

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i equal those before j, i being the smaller place."""
        same = np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 2, -1, -1):
            rank, left = self.levels[k], i - same - (1 << k)
            equal = (left >= 0) & (rank[np.maximum(left, 0)] == rank[np.maximum(j - same - (1 << k), 0)])
            same += equal.astype(np.int64) << k
        return same


class WaveletTree:
    """Order statistics of ranges of a sequence of distinct numbers 0 … m − 1, for many ranges at a time."""

    def __init__(self, values: np.ndarray):
        self.height = max(1, int(len(values)).bit_length())
        self.zeros = []
        for bit in range(self.height - 1, -1, -1):
            ones = (values >> bit) & 1 == 1
            self.zeros.append(np.concatenate(([0], np.cumsum(~ones))))
            values = np.concatenate((values[~ones], values[ones]))

    def below(self, left: np.ndarray, right: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many numbers of each range are smaller than its bound (m at most)."""
        count = np.zeros(len(left), np.int64)
        for zeros, bit in zip(self.zeros, range(self.height - 1, -1, -1), strict=True):
            low, high = zeros[left], zeros[right]
            one = (bound >> bit) & 1 == 1
            count += np.where(one, high - low, 0)
            left = np.where(one, left - low + zeros[-1], low)
            right = np.where(one, right - high + zeros[-1], high)
        return count

    def smallest(self, left: np.ndarray, right: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The nth smallest number of each range, counted from 0."""
        value = np.zeros(len(left), np.int64)
        for zeros, bit in zip(self.zeros, range(self.height - 1, -1, -1), strict=True):
            low, high = zeros[left], zeros[right]
            one = nth >= high - low
            nth = np.where(one, nth - (high - low), nth)
            value |= one.astype(np.int64) << bit
            left = np.where(one, left - low + zeros[-1], low)
            right = np.where(one, right - high + zeros[-1], high)
        return value


def candidates(ranks: Ranks, origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs that include one inside every run; `origin` is where the place's text starts.

    Block sizes are 2^k words, k >= BASE, blocks lie at multiples of their size.
    For every run of period q one block has size q or less, more than half of q
    (the smallest size for q up to it), and lies in the run with q more words
    after it. So q is the distance to one of its occurrences. Periods up to
    the smallest size are the distance to the next one. Others are in the
    window [size, 2 size): up to two occurrences there are tried as they are.
    More than two form a progression, whose difference d is the block's own
    period; then the run's period shifts the stretch of period d around the
    block, whole on one side at least, to that around the progression, so the
    distances of their ends are the candidates.
    """
    places, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if len(ranks.repeated) <= BASE or not len(ranks.repeated[BASE][0]):
        return places[0], periods[0]
    known = np.sort(ranks.repeated[BASE][0])
    suffixes = known[np.argsort(ranks.levels[-1][known])]
    order = ranks.levels[-1][suffixes]
    tree = WaveletTree(np.searchsorted(known, suffixes))
    for k in range(BASE, len(ranks.repeated)):
        size = 1 << k
        place, often = ranks.repeated[k]
        aligned = (place - origin[place]) & (size - 1) == 0
        place, often = place[aligned], often[aligned]
        left = np.searchsorted(order, ranks.levels[k][place])
        right = left + often

        def find(rows: np.ndarray, nth: np.ndarray) -> np.ndarray:
            return known[tree.smallest(left[rows], right[rows], nth)]

        def offer(rows: np.ndarray, period: np.ndarray) -> None:
            places.append(place[rows])
            periods.append(period)

        if k == BASE:
            nth = tree.below(left, right, np.searchsorted(known, place + 1))
            rows = np.flatnonzero(nth < often)
            period = find(rows, nth[rows]) - place[rows]
            offer(rows[period <= size], period[period <= size])
        first = tree.below(left, right, np.searchsorted(known, place + size))
        many = tree.below(left, right, np.searchsorted(known, place + 2 * size)) - first
        for nth in (0, 1):
            rows = np.flatnonzero(many > nth)
            offer(rows, find(rows, first[rows] + nth) - place[rows])
        rows = np.flatnonzero(many > 2)
        p, a = place[rows], find(rows, first[rows])
        step = find(rows, first[rows] + 1) - a
        ends = a + ranks.forward(a, a + step) - p - ranks.forward(p, p + step)
        begins = a - ranks.backward(a, a + step) - p + ranks.backward(p, p + step)
        for period in (ends, begins):
            fits = (period >= size) & (period < 2 * size)
            offer(rows[fits], period[fits])
    return np.concatenate(places), np.concatenate(periods)


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """The runs of each text of numbered words: rows (start, length, period) by start, then period."""
    parts, base = [], 0
    for words in texts:
        # No word is shared between texts, and an end mark of its own closes each: no match crosses a border.
        parts.append(np.append(words, words.max(initial=-1) + 1) + base)
        base = int(parts[-1][-1]) + 1
    text = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    starts = np.cumsum([0, *map(len, parts)])
    found = np.zeros((0, 3), np.int64)
    if len(text):
        ranks = Ranks(text)
        place, period = candidates(ranks, np.repeat(starts[:-1], np.diff(starts)))
        pairs = np.unique(np.stack([place, period], axis=1), axis=0)
        place, period = pairs[:, 0], pairs[:, 1]
        start = place - ranks.backward(place, place + period)
        length = place + period + ranks.forward(place, place + period) - start
        long = length >= np.maximum(LEAST, TIMES * period)
        found = np.unique(np.stack([start, length, period], axis=1)[long], axis=0)
        # Of equal stretches the smallest period comes first; multiples of it follow.
        found = found[np.concatenate(([True], (found[1:, :2] != found[:-1, :2]).any(axis=1)))[: len(found)]]
        found = found[np.lexsort((found[:, 2], found[:, 0]))]
    cuts = np.searchsorted(found[:, 0], starts)
    return [found[a:b] - [origin, 0, 0] for a, b, origin in zip(cuts, cuts[1:], starts)]


def _numbered(words: list[bytes]) -> np.ndarray:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def _collapsed(words: list[bytes], runs: np.ndarray) -> str:
    if not len(runs):
        return b" ".join(words).decode()
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept]).decode()


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row.

    A run is a stretch of words with smallest period q (words q apart are
    equal), of at least `LEAST` words and `TIMES` periods, that no neighbouring
    word continues. `runs` are structs (start, length, period), words counted
    from 0, by start, then period; `collapsed` is the text without each run's
    words after its first period, joined by one space.

    Words are parted by ASCII white space. Null and empty texts have no words,
    no runs and an empty collapsed text. A text is searched whole, whatever its
    length; a task holds one long text, or short ones of `BATCH_WORDS` words
    together. Rows may repeat, ids may be null, other columns are not read; an
    empty table gives an empty one.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    of_runs = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, total = [], 0
                while at + len(texts) < batch.num_rows and total < BATCH_WORDS:
                    texts.append(batch.column(1)[at + len(texts)].as_py().encode().split())
                    total += len(texts[-1])
                long = [words for words in texts if len(words) >= LEAST]
                results = iter(find_runs([_numbered(words) for words in long]))
                runs = [next(results) if len(words) >= LEAST else np.zeros((0, 3), np.int64) for words in texts]
                rows = np.concatenate(runs)
                structs = pa.StructArray.from_arrays([pa.array(c) for c in np.ascontiguousarray(rows.T)], fields=list(of_runs.value_type))
                offsets = pa.array(np.cumsum([0, *map(len, runs)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, len(texts)),
                        pa.array([len(words) for words in texts], pa.int64()),
                        pa.ListArray.from_arrays(offsets, structs),
                        pa.array([_collapsed(words, r) for words, r in zip(texts, runs, strict=True)], pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )
                at += len(texts)

    given = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    runs = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return given.mapInArrow(searched, f"doc_id {kind}, n_words bigint, runs {runs}, collapsed string")


def best_run(runs: Column) -> Column:
    """The run of greatest length by period, compared as fractions; of equal ones the first, then that of the smallest period."""

    def better(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return F.when(left > right, -1).when(left < right, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(F.signum(a["period"] - b["period"]).cast("int"))

    return F.get(F.array_sort(runs, better), 0)


def repeated_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) with made-up repetitions in about every tenth text, chosen by the CRC-32 of its id.

    With h the CRC-32 of the decimal id, g = floor(h / 10) and n words, texts
    with h % 10 = 0 repeat, from word a = g % n on, their next
    1 + floor((n - a) / (3 + g % 8)) words until the end. Texts without words
    or without an id stay as they are; null texts are empty.
    """
    h = F.crc32(F.col(id_col).cast("string"))
    split = F.filter(F.split(text_or_empty(text_col), WHITE), lambda w: w != "")
    given = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), F.floor(h / 10).alias("g"), F.when(h % 10 == 0, split).alias("words"))
    given = computed(given, n=F.size("words"))
    given = computed(given.select("doc_id", "text", "words", "g", "n", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int").alias("a")), p=(1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    tail = F.transform(F.sequence(F.col("a"), F.col("n") - 1), lambda i: F.get("words", F.col("a") + (i - F.col("a")) % F.col("p")))
    edited = F.array_join(F.concat(F.slice("words", 1, F.col("a")), tail), " ")
    return given.select("doc_id", F.when(F.col("n") > 0, edited).otherwise(F.col("text")).alias("text"))
