"""Benchmark decontamination with suffix arrays over shards of the training texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import apart, map_arrow, record, schema, shards, text_bytes, together

WINDOW_WORDS = 10
# Benchmark text that is broadcast at once; a larger benchmark takes one pass for each so many bytes.
BLOCK_BYTES = 8 << 20

# Text whose suffixes are sorted together.
SHARD_BYTES = 2 << 20

# Bytes of words after lower-casing A-Z: digits, a-z and everything beyond ASCII.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True

# Bytes of a word up to which its hash is a sum over its bytes.
LONG_WORD = 64
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(0, np.uint64)] * 2


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        for at, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            table = np.full(n, base, np.uint64)
            table[0] = 1
            _powers[at] = np.cumprod(table)
    return _powers


class Words:
    """The words of several texts: byte ranges, owning text and a 64-bit hash each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = low = _LOWER[data]
        mask = _IS_WORD[low]
        begin, end = mask.copy(), mask.copy()
        begin[1:] &= ~mask[:-1]
        end[:-1] &= ~mask[1:]
        inner = offsets[(offsets > 0) & (offsets < len(low))]
        begin[inner] = mask[inner]
        end[inner - 1] = mask[inner - 1]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.owner = np.searchsorted(offsets, self.starts, "right") - 1
        power, inverse = _power_tables(max(len(low), 1))
        sums = np.zeros(len(low) + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[: len(low)], out=sums[1:])
        self.hashes = (sums[self.ends] - sums[self.starts]) * inverse[self.starts]
        # Sums modulo 2**64 have well-known long words of one value: those are hashed by themselves.
        for i in np.flatnonzero(self.ends - self.starts > LONG_WORD).tolist():
            self.hashes[i] = xxhash.xxh64_intdigest(low[self.starts[i] : self.ends[i]].tobytes())

    def __len__(self) -> int:
        return len(self.starts)

    def differs(self, mine: np.ndarray, other: Words, theirs: np.ndarray) -> np.ndarray:
        """For pairs of words, whether their bytes differ."""
        length = self.ends[mine] - self.starts[mine]
        unequal = length != other.ends[theirs] - other.starts[theirs]
        some = np.flatnonzero(~unequal)
        length = length[some]
        if len(some):
            before = np.cumsum(length) - length
            step = np.arange(length.sum()) - np.repeat(before, length)
            wrong = self.data[np.repeat(self.starts[mine[some]], length) + step] != other.data[
                np.repeat(other.starts[theirs[some]], length) + step
            ]
            unequal[some] = np.add.reduceat(wrong, before) > 0
        return unequal


class TestSet:
    """A block of benchmark items: its vocabulary, its text as word numbers and its windows."""

    __test__ = False

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        names = [name for name, _ in items]
        data, offsets = text_bytes(pa.array([text or "" for _, text in items], pa.string()))
        self.words = Words(data, offsets)
        self.hashes, self.sample, number = np.unique(self.words.hashes, return_index=True, return_inverse=True)
        if self.words.differs(np.arange(len(number)), self.words, self.sample[number]).any():
            raise ValueError("two benchmark words with one hash")
        self.text = np.append(number + 1, 0).astype(np.int64)  # 0 ends a text
        counts = np.bincount(self.words.owner, minlength=len(items))
        ends = np.cumsum(counts)
        self.item = np.repeat(np.arange(len(items)), counts)
        self.names = names
        #: Words from each suffix to the end of its item.
        self.length = np.repeat(ends, counts) - np.arange(len(number))
        self.offset = np.arange(len(number)) - np.repeat(ends - counts, counts)
        self.longest = int(counts.max(initial=0))
        classes: dict[tuple, tuple[int, set[str]]] = {}
        for begin, count, name in zip((ends - counts).tolist(), counts.tolist(), names):
            size = min(window, count)
            for at in range(begin, begin + count - size + 1) if size else ():
                classes.setdefault(tuple(self.text[at : at + size].tolist()), (at, set()))[1].add(name)
        #: Distinct windows: where one occurs, its words, the items that contain it.
        self.window_at = np.array([at for at, _ in classes.values()], np.int64)
        self.window_words = np.array([len(k) for k in classes], np.int64)
        self.window_items = [names for _, names in classes.values()]


class SuffixArray:
    """Suffixes of a text of word numbers (0: a break), sorted as far as a test suffix reaches."""

    def __init__(self, text: np.ndarray, vocabulary: int, reach: int):
        self.text = text
        at = np.flatnonzero(text)
        bits = max(1, int(vocabulary).bit_length())
        step = max(1, 62 // bits)
        padded = np.append(text, np.zeros(step, np.int64))
        key = np.zeros(len(at), np.int64)
        for k in range(step):
            key = (key << bits) | padded[at + k]
        order, rank_of = self._rank(key)
        rank = np.zeros(len(text) + 1, np.int64)
        while step < reach and len(at) and rank_of[order[-1]] < len(at):
            rank[at] = rank_of
            order, rank_of = self._rank(rank_of * (len(at) + 1) + rank[np.minimum(at + step, len(text))])
            step *= 2
        self.suffixes = at[order]

    @staticmethod
    def _rank(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(np.append(True, ordered[1:] != ordered[:-1])) if len(key) else 0
        return order, rank

    def compare(self, at: np.ndarray, test: np.ndarray, start: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Common words (at most ``limit``) of text suffixes and test suffixes, and the sign of the difference."""
        common = np.zeros(len(at), np.int64)
        sign = np.zeros(len(at), np.int64)
        active = np.arange(len(at))
        k = 0
        while len(active):
            active = active[limit[active] > k]
            place = at[active] + k
            mine = np.where(place < len(self.text), self.text[np.minimum(place, len(self.text) - 1)], 0)
            theirs = test[start[active] + k]
            same = mine == theirs
            sign[active[~same]] = np.sign(mine - theirs)[~same]
            active = active[same]
            k += 1
            common[active] = k
        return common, sign

    def bound(self, test: np.ndarray, start: np.ndarray, limit: np.ndarray, after: bool) -> np.ndarray:
        """Binary search: the first suffix not before (``after``: behind) the first ``limit`` words of each test suffix."""
        low = np.zeros(len(start), np.int64)
        high = np.full(len(start), len(self.suffixes), np.int64)
        while len(active := np.flatnonzero(low < high)):
            middle = (low[active] + high[active]) >> 1
            _, sign = self.compare(self.suffixes[middle], test, start[active], limit[active])
            right = sign <= 0 if after else sign < 0
            low[active[right]] = middle[right] + 1
            high[active[~right]] = middle[~right]
        return low

    def longest(self, test: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Words of the longest match of each test suffix, and a place where it occurs."""
        best = np.zeros(len(start), np.int64)
        place = np.zeros(len(start), np.int64)
        if len(self.suffixes):
            bound = self.bound(test, start, length, after=False)
            for shift in (-1, 0):
                at = self.suffixes[np.clip(bound + shift, 0, len(self.suffixes) - 1)]
                common, _ = self.compare(at, test, start, length)
                place = np.where(common > best, at, place)
                best = np.maximum(best, common)
        return best, place


class Shard:
    """Texts with the suffix array of those of their words that the test set knows."""

    def __init__(self, column: pa.Array, tests: TestSet):
        data, offsets = text_bytes(column)
        self.words, self.tests = Words(data, offsets), tests
        self.rows = len(column)
        self.counts = np.bincount(self.words.owner, minlength=self.rows)
        #: Where each text begins in the sequence; a break follows each text.
        self.begins = np.cumsum(self.counts + 1) - (self.counts + 1)
        self.place = np.arange(len(self.words)) + self.words.owner
        found = np.searchsorted(tests.hashes, self.words.hashes)
        found = np.minimum(found, max(len(tests.hashes) - 1, 0))
        known = tests.hashes[found] == self.words.hashes if len(tests.hashes) else np.zeros(len(found), bool)
        self.sequence = np.zeros(len(self.words) + self.rows, np.int64)
        self.sequence[self.place[known]] = found[known] + 1
        self.sort()

    def sort(self) -> None:
        self.array = SuffixArray(self.sequence, len(self.tests.hashes) + 1, self.tests.longest)

    def occurrences(self) -> tuple[np.ndarray, np.ndarray]:
        """Window numbers and places of all occurrences, every word compared by its bytes."""
        tests = self.tests
        while True:
            windows = np.arange(len(tests.window_at))
            longest, _ = self.array.longest(tests.text, tests.window_at, tests.window_words)
            windows = windows[longest >= tests.window_words]
            at, size = tests.window_at[windows], tests.window_words[windows]
            low = self.array.bound(tests.text, at, size, after=False)
            count = self.array.bound(tests.text, at, size, after=True) - low
            step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            places = self.array.suffixes[np.repeat(low, count) + step]
            windows = np.repeat(windows, count)
            covered = np.flatnonzero(self.cover(places, tests.window_words[windows]))
            word = covered - (np.searchsorted(self.begins, covered, "right") - 1)
            wrong = self.words.differs(word, tests.words, tests.sample[self.sequence[covered] - 1])
            if not wrong.any():
                return windows, places
            self.sequence[covered[wrong]] = 0  # a hash met by chance: the word is unknown
            self.sort()

    def cover(self, places: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        edges = np.bincount(places, minlength=len(self.sequence) + 1)
        edges = edges - np.bincount(places + sizes, minlength=len(self.sequence) + 1)
        return np.cumsum(edges[:-1]) > 0


def _lists(values: pa.Array | np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int) -> Iterator[list[tuple[str, str | None]]]:
    """The distinct items in blocks of about ``block_bytes``, one at a time on the driver."""
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.col(text).alias("t"))
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = size // block_bytes + 1
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block).distinct().collect()
        yield sorted(((r["i"], r["t"] or "") for r in rows))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
    keep_text: bool = False,
) -> DataFrame:
    """For every row: its key, ``n_words``, the hit word ranges and the items found.

    ``span_starts`` and ``span_ends`` are the maximal runs of words inside
    occurrences of benchmark windows, ``items`` the ids (as text, sorted) whose
    windows occur. Each task sorts the suffixes of its shards (a few MB of
    text) and searches every test suffix in them by halving; the longest match
    tells which windows occur, and the suffixes between two bounds are all
    their places. Hits are checked byte by byte.

    The benchmark is broadcast in blocks of ``block_bytes``, each a further
    pass that adds to the ranges and items: no shuffle at any size. Null texts
    have no words; null and repeated keys are rows like others; an item without
    id counts under the empty name; an empty benchmark hits nothing. ``keep_text``
    adds the text as ``body``.
    """
    spark = docs.sparkSession
    out = schema(
        docs.schema[key],
        ("n_words", "long"),
        ("span_starts", "array<long>"),
        ("span_ends", "array<long>"),
        ("items", "array<string>"),
    )
    empty = F.array().cast("array<long>")
    frame = docs.select(F.col(key), F.lit(0).cast("long").alias("n_words"), empty.alias("span_starts"), empty.alias("span_ends"), F.array().cast("array<string>").alias("items"), F.col(text).alias("body"))
    carried = schema(*out.fields, ("body", "string"))

    def step(frame: DataFrame, block: list) -> DataFrame:
        shared = spark.sparkContext.broadcast((block, window))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = TestSet(*shared.value)
            for batch in shards(batches, "body", SHARD_BYTES):
                shard = Shard(batch.column("body"), tests)
                windows, places = shard.occurrences()
                old = [batch.column(c) for c in ("span_starts", "span_ends")]
                before = [shard.begins.repeat(np.diff(c.offsets.to_numpy())) + c.flatten().to_numpy() for c in old]
                covered = shard.cover(
                    np.concatenate((places, before[0])),
                    np.concatenate((tests.window_words[windows], before[1] - before[0])),
                )
                edges = np.diff(np.concatenate(([0], covered.view(np.int8), [0])))
                starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
                row = np.searchsorted(shard.begins, starts, "right") - 1
                spans = np.bincount(row, minlength=shard.rows)
                items = batch.column("items").to_pylist()
                owner = np.searchsorted(shard.begins, places, "right") - 1
                hits = np.unique(owner * max(len(tests.window_at), 1) + windows)
                found: dict[int, set[str]] = {}
                for hit in hits.tolist():
                    r, w = divmod(hit, len(tests.window_at))
                    found.setdefault(r, set()).update(tests.window_items[w])
                for r, names in found.items():
                    items[r] = sorted(names.union(items[r]))
                yield record(
                    carried,
                    {
                        key: batch.column(key),
                        "n_words": shard.counts,
                        "span_starts": _lists(starts - shard.begins[row], spans, pa.int64()),
                        "span_ends": _lists(ends - shard.begins[row], spans, pa.int64()),
                        "items": items,
                        "body": batch.column("body"),
                    },
                )

        return map_arrow(frame, search, carried)

    for block in _blocks(benchmark, item, item_text, block_bytes):
        frame = step(frame, block)
    return frame if keep_text else frame.drop("body")


def longest_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """For each suffix of an item that matches anything: the longest verbatim match and a place of it.

    Every shard names its best place of a test suffix; the best of the corpus
    is an aggregate over shards, combined before the shuffle.
    """
    spark = docs.sparkSession
    out = schema(("item", "string"), ("item_word", "long"), ("words", "long"), docs.schema[key], ("word", "long"))

    def search_block(block: list) -> DataFrame:
        shared = spark.sparkContext.broadcast((block, 1))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tests = TestSet(*shared.value)
            start = np.arange(len(tests.length))
            for batch in shards(batches, text, SHARD_BYTES):
                shard = Shard(batch.column(text), tests)
                shard.occurrences()  # words that only share a hash are unknown from here on
                words, place = shard.array.longest(tests.text, start, tests.length)
                some = np.flatnonzero(words)
                row = np.searchsorted(shard.begins, place[some], "right") - 1
                yield record(
                    out,
                    {
                        "item": [tests.names[i] for i in tests.item[some].tolist()],
                        "item_word": tests.offset[some],
                        "words": words[some],
                        key: batch.column(key).take(pa.array(row)),
                        "word": place[some] - shard.begins[row],
                    },
                )

        return map_arrow(docs.select(key, text), search, out)

    found = None
    for block in _blocks(benchmark, item, item_text, block_bytes):
        part = search_block(block)
        found = part if found is None else found.union(part)
    best = F.max_by(F.struct(key, "word"), F.struct("words", -F.col(key), -F.col("word")))
    return (
        found.groupBy("item", "item_word")
        .agg(F.max("words").alias("words"), best.alias("_at"))
        .select("item", "item_word", "words", f"_at.{key}", "_at.word")
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """The documents without those that a benchmark window occurs in, whole rows; each is judged by its own text."""
    rows = apart(docs, text)
    judged = contamination(rows, benchmark, key="row", text="body", keep_text=True, **options)
    return judged.where(F.size("items") == 0).select(*together(judged, docs.columns, text))
