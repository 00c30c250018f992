"""Sum-of-squares packing of tokenised documents into windows of fixed length."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from ledgerflow.llm.common import map_arrow, record, schema, shards, text_bytes

WINDOW = 4096
END_ID = 2
# Encoded words that a worker remembers: two generations of this many.
CACHED_WORDS = 500_000
# Words that one call of the tokenizer gets.
WORDS_A_CALL = 200
# Windows that a task keeps open at most before it empties them into full ones.
OPEN_WINDOWS = 2048
# Sequence ids: the task's number above these bits, the window's number below.
SEQUENCE_BITS = 33

# A word of Latin letters, which the vocabulary takes as one piece whatever its case, and the marks behind it,
# which are a piece of their own.
_SIMPLE = r"^(?P<letters>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<marks>[!-/:-@\[-`{-~]*)$"
_LETTERS = re.compile("[a-zà-öø-ÿ]+")
_END_OF_WORD = "</w>"


class Encoder:
    """Token ids of a text as little-endian 32-bit bytes, word by word.

    The vocabulary drops white space and never joins across it, hence a text's
    ids are those of its words in order. The distinct words of a call are cut
    into letters and the marks behind them, and each of these is encoded once.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # The same merges for words of lower-case letters, which need no preparation.
        self.pieces = Tokenizer.from_file(path)
        self.pieces.normalizer = normalizers.Sequence([])
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        for tokenizer in (self.tokenizer, self.pieces):
            tokenizer.model._resize_cache(0)  # words are remembered here, and each is asked for once
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(_END_OF_WORD)]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        words = pc.split_pattern(pa.array([_lowered(t).replace("\n", " ") for t in texts], pa.string()), " ")
        coded = words.flatten().dictionary_encode()
        data, offsets = text_bytes(self._ids(coded.dictionary).take(coded.indices))
        edges = offsets[words.offsets.to_numpy()].tolist()
        return [data[a:b].tobytes() for a, b in zip(edges, edges[1:])]

    def _ids(self, words: pa.Array) -> pa.Array:
        """The ids of these words: of letters and marks the ones after the others, of any other word as it is."""
        parts = pc.extract_regex(words, _SIMPLE)
        letters, marks = pc.struct_field(parts, "letters"), pc.struct_field(parts, "marks")
        ids = []
        for part in (pc.coalesce(pc.utf8_lower(letters), words), pc.fill_null(marks, "")):
            coded = part.dictionary_encode()
            ids.append(self._known(coded.dictionary).take(coded.indices))
        return pc.binary_join_element_wise(*ids, pa.scalar(b"", pa.large_binary()))

    def _known(self, distinct: pa.Array) -> pa.Array:
        """The ids of these words and parts of words, remembered or new."""
        words = distinct.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.young.get, words))
        missing = {words[at]: at for at, found in enumerate(ids) if found is None}
        if missing:
            if len(self.young) + len(missing) > CACHED_WORDS:
                self.old, self.young = self.young, {}
            found = self._learned(list(missing))
            for word, at in missing.items():
                ids[at] = found[word]
            self.young.update(found)
        return pa.array(ids, pa.large_binary())

    def _learned(self, words: list[str]) -> dict[str, bytes]:
        found = {w: ids for w in words if (ids := self.old.get(w)) is not None}
        letters, other = [], []
        for word in words:
            if word not in found:
                (letters if _LETTERS.fullmatch(word) else other).append(word)
        self._encode_pieces(letters, found)
        self._encode_others(other, found)
        return found

    @staticmethod
    def _groups(words: list[str]) -> tuple[list[list[str]], list[str]]:
        groups = [words[at : at + WORDS_A_CALL] for at in range(0, len(words), WORDS_A_CALL)]
        return groups, [" ".join(g) for g in groups]

    def _encode_pieces(self, words: list[str], into: dict[str, bytes]) -> None:
        """Words that are one piece each: each ends with its only token that ends a word."""
        groups, texts = self._groups(words)
        for group, found in zip(groups, self.pieces.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            cuts = ((np.flatnonzero(self.ends_word[ids]) + 1) * 4).tolist()
            if len(cuts) != len(group):
                raise ValueError("a word of letters is not one piece of this vocabulary")
            ids = ids.tobytes()
            into.update(zip(group, [ids[a:b] for a, b in zip([0, *cuts], cuts)]))

    def _encode_others(self, words: list[str], into: dict[str, bytes]) -> None:
        """Any words: a token belongs to the word it starts in."""
        groups, texts = self._groups(words)
        for group, found in zip(groups, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
            starts = np.cumsum([0] + [len(w) + 1 for w in group])
            ids = np.array(found.ids, "<u4").tobytes()
            begins = np.fromiter((b for b, _ in found.offsets), np.int64, len(found))
            cuts = (np.searchsorted(begins, starts) * 4).tolist()
            into.update(zip(group, [ids[a:b] for a, b in zip(cuts, cuts[1:])]))


def _lowered(text: str) -> str:
    """The vocabulary's lower case, where Python's is the same; special tokens are matched as written."""
    return text.lower() if text.isascii() and "<|" not in text else text


class Levels:
    """Open windows by fill level; a piece goes where the sum of squared counts grows least.

    ``count[h]`` is the number of open windows filled to ``h``. Putting ``s`` ids
    on level ``h`` takes one window from ``h`` and gives one to ``h + s``; empty
    and full windows are not counted.
    """

    def __init__(self, window: int):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[int]] = {}
        # Change of the sum of squares by arriving at / leaving each level.
        self.arrive = np.ones(window + 1, np.int64)
        self.leave = np.ones(window + 1, np.int64)
        self.arrive[window] = 0
        self.leave[0] = 0

    def _set(self, level: int, change: int) -> None:
        if 0 < level < self.window:
            self.count[level] += change
            self.arrive[level] = 2 * self.count[level] + 1
            self.leave[level] = 1 - 2 * self.count[level]

    def best(self, size: int) -> int:
        """The level with the least growth; of equals, the fullest."""
        top = self.window - size
        levels = np.append(np.flatnonzero(self.count[: top + 1]), 0)
        change = self.arrive[levels + size] + self.leave[levels]
        least = change.min()
        return int(levels[change == least].max())

    def place(self, size: int, new: int) -> tuple[int, int]:
        """The window and the offset in it; ``new`` is the number of a window not yet begun."""
        level = self.best(size)
        if level:
            window = self.open[level].pop()
            self._set(level, -1)
        else:
            window = new
        if level + size < self.window:
            self.open.setdefault(level + size, []).append(window)
            self._set(level + size, 1)
        return window, level

    def drain(self) -> list[int]:
        """All open windows, fullest first; none stays open."""
        windows = [w for level in sorted(self.open, reverse=True) for w in self.open[level]]
        self.__init__(self.window)
        return windows


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    text: str = "text",
    key: str = "doc_id",
    window: int = WINDOW,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document in a window of at most ``window`` ids.

    A document is its ids followed by ``end_id``; a null or blank text is
    ``end_id`` alone. What fills whole windows is cut off first; each rest goes
    online to the level that keeps the sum of squared level counts least. When
    a task ends (or has ``OPEN_WINDOWS`` open), the windows still open are
    emptied into full ones, cutting a piece where a window ends, so one window
    per task remains padded. Tasks pack their own rows and share nothing:
    no shuffle, and a retried task repeats its result since it reads the same
    split. ``sequence_id`` is the task's number and a running number.

    Rows with a null or repeated key are documents of their own. An empty table
    has no pieces. Other columns are not read. ``with_ids`` adds the ids.
    """
    out = schema(
        docs.schema[key],
        ("start", "long"),
        ("length", "long"),
        ("ids_crc32", "long"),
        ("doc_tokens", "long"),
        ("sequence_id", "long"),
        ("offset", "long"),
        *([("ids", "binary")] if with_ids else []),
    )
    names = out.fieldNames()
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_path)
        levels = Levels(window)
        number = TaskContext.get().partitionId() << SEQUENCE_BITS
        held: dict[int, list[tuple]] = {}  # pieces of the open windows: document, start, ids, tokens
        rows: list[list] = [[] for _ in names]

        def emit(at: int, offset: int, doc, start: int, ids: bytes, tokens: int) -> None:
            values = (doc, start, len(ids) >> 2, zlib.crc32(ids), tokens, at, offset, ids)
            for column, value in zip(rows, values):
                column.append(value)

        def close(at: int, pieces: list[tuple]) -> None:
            offset = 0
            for doc, start, ids, tokens in pieces:
                emit(at, offset, doc, start, ids, tokens)
                offset += len(ids) >> 2

        def flush(last: bool) -> None:
            """The open windows' pieces in full windows; the rest is a window that stays open."""
            nonlocal number
            current, room = [], window
            for at in levels.drain():
                for doc, start, ids, tokens in held.pop(at):
                    while ids:
                        cut = ids[: room << 2]
                        current.append((doc, start, cut, tokens))
                        start, ids, room = start + (len(cut) >> 2), ids[room << 2 :], room - (len(cut) >> 2)
                        if not room:
                            close(number, current)
                            number, current, room = number + 1, [], window
            if current and last:
                close(number, current)
            elif current:
                levels.place(window - room, number)
                held[number] = current
            number += bool(current)

        def batch() -> pa.RecordBatch:
            done = record(out, dict(zip(names, rows)))
            for column in rows:
                column.clear()
            return done

        for shard in shards(batches, text):
            texts = [value or "" for value in shard.column(text).to_pylist()]
            for doc, ids in zip(shard.column(key).to_pylist(), encode(texts)):
                ids += end
                tokens = len(ids) >> 2
                start = 0
                while tokens - start >= window:
                    emit(number, 0, doc, start, ids[start << 2 : (start + window) << 2], tokens)
                    start, number = start + window, number + 1
                rest = ids[start << 2 :]
                if not rest:
                    continue
                at, offset = levels.place(len(rest) >> 2, number)
                number += at == number
                held.setdefault(at, []).append((doc, start, rest, tokens))
                if offset + (len(rest) >> 2) == window:
                    close(at, held.pop(at))
                elif len(held) > OPEN_WINDOWS:
                    flush(last=False)
            if rows[0]:
                yield batch()
        flush(last=True)
        if rows[0]:
            yield batch()

    return map_arrow(docs.select(key, text), pack, out)


_encoders: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """The worker's encoder: workers live longer than tasks, so do the words they know."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
