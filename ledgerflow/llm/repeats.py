"""Repeated passages: bytes of strings that also start in a document with a smaller key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerflow.llm.common import map_arrow, record, schema, shards, text_bytes, written
from ledgerflow.llm.lyndon import suffix_places

LENGTH = 50
# Bytes of a gram. Every string of ``LENGTH`` bytes is named by the least hash of its grams.
GRAM = 20
# Places hashed at once: their arrays stay in a core's cache.
HASHED = 1 << 15
# Text of one batch of documents, and bytes of the contexts whose suffixes are sorted together.
BATCH_BYTES = 8 << 20
SORT_BYTES = 3 << 19
# Contexts copied from a text at once.
GATHERED = 1 << 12
# Strings that one context joins at most.
CONTEXT = 64
# Contexts, of whole names, whose suffixes are sorted at once.
SORTED_CONTEXTS = 5_000
# Contexts of one name beyond which its strings are dealt out by their own hash.
HOT_CONTEXTS = 20_000


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``GRAM`` (16 to 24) bytes from each place on."""
    eight = np.ndarray((len(data) - 7,), np.uint64, np.ascontiguousarray(data), strides=(1,)).copy()
    last = GRAM - 8
    mixed = eight[:-last] * np.uint64(0x9E3779B97F4A7C15)
    shifted = np.empty_like(mixed)
    for at in dict.fromkeys((8, last)):
        mixed ^= np.right_shift(mixed, np.uint64(29), out=shifted)
        mixed += eight[at : len(mixed) + at]
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= np.right_shift(mixed, np.uint64(32), out=shifted)
    mixed *= np.uint64(0x94D049BB133111EB)
    return mixed


def _names_of(data: np.ndarray, length: int) -> np.ndarray:
    """The least hash of the grams of the ``length`` bytes from each place on."""
    names = np.empty(len(data) - length + 1, np.uint64)
    for at in range(0, len(names), HASHED):
        least = _gram_hashes(data[at : at + HASHED + length - 1])
        have, want = 1, length - GRAM + 1
        while have < want:
            step = min(have, want - have)
            least = np.minimum(least[:-step], least[step:], out=least[: len(least) - step])
            have += step
        names[at : at + HASHED] = least
    return names


def named_runs(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring strings of one name: name, first place, number of strings, text.

    A string's name depends on its bytes alone, so equal strings meet under one name.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none.astype(np.uint64), none, none, none
    least = _names_of(data, length)
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    valid = text[: len(least)] == text[length - 1 :]
    new = np.empty(len(least), bool)
    new[0] = True
    np.not_equal(least[1:], least[:-1], out=new[1:])
    new[offsets[(offsets > 0) & (offsets < len(least))]] = True
    # A text's strings are neighbours; what follows its last one is not valid.
    edges = np.flatnonzero(np.logical_or(new, ~valid, out=new))
    first = valid[edges]
    count = np.diff(edges, append=len(least))[first]
    first = edges[first]
    pieces = -(-count // CONTEXT)
    part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first, whole = np.repeat(first, pieces) + part * CONTEXT, np.repeat(count, pieces) - part * CONTEXT
    return least[first], first, np.minimum(whole, CONTEXT), text[first]


def _by_name(name: np.ndarray, owner: np.ndarray, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of these names and rows ordered by name, batch and row: name, row, batch; ``batch`` is that of each row."""
    rows = np.argsort(batch, kind="stable")
    place = np.empty(len(rows), np.int64)
    place[rows] = np.arange(len(rows))
    order = np.argsort(name)
    name = name[order]
    group = np.cumsum(np.append(False, name[1:] != name[:-1])[: len(name)])
    # Within a name only the rows are sorted, and a number says all of a run.
    owner = rows[np.sort(group * len(rows) + place[owner[order]]) % max(len(rows), 1)]
    return name, owner, batch[owner]


def _sorted_rows(docs: pa.Table) -> pa.RecordBatch | None:
    """The rows by key and text, so that every step numbers the contexts alike; rows without key are last."""
    order = pc.sort_indices(docs, sort_keys=[("id", "ascending"), ("body", "ascending")])
    docs = docs.take(order).combine_chunks()
    return docs.to_batches()[0] if docs.num_rows else None


class Contexts:
    """The contexts of a batch of documents that the corpus may repeat, numbered as they first occur.

    Documents come in the order of their keys, so a context's first document is its least.
    """

    def __init__(self, docs: pa.RecordBatch, shared: np.ndarray, hot: np.ndarray, length: int):
        keyed = docs.column("id").is_valid().to_numpy(zero_copy_only=False)
        #: The key of each row of ``docs`` (0 for none, such a row has no run).
        self.ids = pc.fill_null(docs.column("id"), 0).to_numpy()
        pieces, runs, begin = [pa.array([], pa.binary())], [], 0
        for shard in shards(iter([docs]), "body"):
            data, offsets = text_bytes(shard.column("body"))
            name, first, count, text = named_runs(data, offsets, length)
            known = _among(name, shared) & keyed[begin + text]
            name, first, count, text = name[known], first[known], count[known], text[known]
            single = _among(name, hot)
            if single.any():
                times = np.where(single, count, 1)
                step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                first = np.repeat(first, times) + step
                name, text = np.repeat(name, times), np.repeat(text, times)
                count = np.repeat(np.where(single, 1, count), times)
                single = np.repeat(single, times)
            for at in range(0, len(first), GATHERED):
                pieces.append(_slices(data, first[at : at + GATHERED], count[at : at + GATHERED] + length - 1))
            runs.append((name, single, begin + text, first - offsets[text], count))
            begin += shard.num_rows
        name, single, self.row, self.place, self.count = map(np.concatenate, zip(*runs))
        coded = pa.concat_arrays(pieces).dictionary_encode()
        #: The distinct contexts, and the number of that of each run; a run has a row of ``docs``, place and strings.
        self.contexts, self.number = coded.dictionary, coded.indices.to_numpy()
        self.least = np.full(len(self.contexts), np.iinfo(np.int64).max)
        np.minimum.at(self.least, self.number, self.ids[self.row])
        self.name = np.empty(len(self.contexts), np.uint64)
        self.name[self.number] = name
        # Strings of a hot name are dealt out by what they are.
        alone = np.unique(self.number[single])
        strings = _values(self.contexts.take(pa.array(alone)))
        self.name[alone] = np.array([xxhash.xxh64_intdigest(c) for c in strings], np.uint64)


def _slices(data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bytes from these places on, as values."""
    ends = np.cumsum(sizes)
    body = data[np.arange(ends[-1]) + np.repeat(first - ends + sizes, sizes)]
    offsets = np.append(0, ends).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(body)])


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _names(table: pa.Table, column: str) -> np.ndarray:
    values = pc.list_flatten(table[column].combine_chunks()).to_numpy(zero_copy_only=False)
    return np.unique(values.astype(np.int64).view(np.uint64))


def _values(column: pa.Array | pa.ChunkedArray) -> list:
    """The values as Python objects; a column of numbers holds no null."""
    return (column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)).tolist()


def holders_of(contexts: pa.Array, least: np.ndarray, length: int) -> list[int | np.ndarray]:
    """For each context the least key that holds its strings: one for all, or one for each.

    Strings of one name are in contexts of that name only. A context alone
    under its name is like no other; where a name has several, their suffixes
    are sorted.
    """
    data, offsets = text_bytes(contexts)
    # The strings of a context have one least gram, which is that of the whole.
    grams = np.append(_names_of(data, GRAM), np.uint64(0))
    name = np.minimum.reduceat(grams, np.column_stack([offsets[:-1], offsets[1:] - GRAM + 1]).ravel())[::2]
    _, number, times = np.unique(name, return_inverse=True, return_counts=True)
    found: list[int | np.ndarray] = least.tolist()
    several = np.flatnonzero(times[number] > 1)
    several = several[np.argsort(number[several], kind="stable")]
    cuts = np.flatnonzero(np.append(True, np.diff(number[several]) > 0)) if len(several) else several
    begin = 0
    while begin < len(several):
        end = np.append(cuts[cuts >= begin + SORTED_CONTEXTS], len(several))[0]
        own = several[begin:end]
        for i, holders in zip(own.tolist(), least_holders(_values(contexts.take(pa.array(own))), least[own], length)):
            found[i] = holders
        begin = end
    return found


def least_holders(contexts: list[bytes], least: np.ndarray, length: int) -> list[int | np.ndarray]:
    """For each string of each context the least key that holds it, given each context's own least key.

    The suffixes of all contexts are sorted; neighbours that agree in
    ``length`` bytes are one string.
    """
    row, place, position, data = suffix_places(contexts)
    whole = place + length <= data.lengths[row]
    order = np.empty(len(row), np.int64)
    order[position] = np.arange(len(row))
    order = order[whole[order]]
    r, at = row[order], data.places(row[order], place[order])
    new = np.zeros(len(order), bool)
    new[0] = True
    for step in range(0, length, 8):
        word = data.word(at + step)
        if (spare := step + 8 - length) > 0:
            word = word >> np.uint64(8 * spare)
        new[1:] |= word[1:] != word[:-1]
    starts = np.flatnonzero(new)
    best = np.repeat(np.minimum.reduceat(least[r], starts), np.diff(np.append(starts, len(order))))
    by_place = np.empty(len(row), np.int64)
    by_place[order] = best
    by_row = by_place[whole]
    counts = data.lengths - length + 1
    first = np.cumsum(counts) - counts
    low, high = np.minimum.reduceat(by_row, first), np.maximum.reduceat(by_row, first)
    return [
        a if a == b else by_row[i : i + n].copy()
        for a, b, i, n in zip(low.tolist(), high.tolist(), first.tolist(), counts.tolist())
    ]


def without_repeats(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    batch_bytes: int = BATCH_BYTES,
    sort_bytes: int = SORT_BYTES,
    hot_contexts: int = HOT_CONTEXTS,
) -> DataFrame:
    """One row per row: ``key``, ``n_bytes``, the removed byte ranges and ``kept``, the other bytes.

    A byte goes if a string of ``length`` bytes over it also starts in a
    document with a smaller key; strings are those of the input, and none
    crosses documents. ``kept`` is binary, since a cut may split a character.

    1. Each string is named by the least hash of its grams; neighbours mostly
       share a name, so a run of about eighteen strings is one row (name, batch
       of documents, how many documents and runs of this shard). A window over
       the name finds those of more than one document. A name has at most one
       row for each shard of text, whatever number of documents hold it.
    2. Each batch gets back its shared names and sends the contexts (the bytes
       of a run) under them, each once with its least key.
    3. Contexts of like names are sorted by suffix (``lyndon``), and every
       string gets the least key that holds it; a context alone under its name
       needs no sorting. A name of more than
       ``hot_contexts`` contexts is sent string by string, dealt out by the
       strings' own hashes, so no group is bound to one task.
    4. Each batch cuts its texts.

    Rows without key neither lose bytes nor cause others to. Rows repeating a
    key are one document: neither is smaller. Null texts are empty; keys are
    whole numbers; an empty table gives no row.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(body))).first()[0] or 0
    batches = int(size // batch_bytes + 1)
    rows = docs.select(
        F.pmod(F.xxhash64(key, text), F.lit(batches)).cast("int").alias("batch"),
        F.col(key).cast("long").alias("id"),
        body.alias("body"),
        F.col(key).alias("key"),
    )
    some = rows.where(F.col("id").isNotNull() & (F.octet_length("body") >= length))
    sketch_schema = schema(("name", "long"), ("batch", "int"), ("docs", "int"), ("runs", "int"))

    def sketch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(parts, "body", 2 << 20):
            data, offsets = text_bytes(shard.column("body"))
            name, _, _, owner = named_runs(data, offsets, length)
            name, owner, batch = _by_name(name, owner, shard.column("batch").to_numpy())
            new_pair = np.append(True, (name[1:] != name[:-1]) | (batch[1:] != batch[:-1]))[: len(name)]
            new_doc = new_pair | np.append(True, owner[1:] != owner[:-1])[: len(name)]
            starts = np.flatnonzero(new_pair)
            if len(starts):
                yield record(
                    sketch_schema,
                    {
                        "name": name[starts].view(np.int64),
                        "batch": batch[starts],
                        "docs": np.add.reduceat(new_doc.astype(np.int32), starts),
                        "runs": np.diff(np.append(starts, len(name))),
                    },
                )

    over = Window.partitionBy("name")
    shared = written(
        map_arrow(some.select("batch", "body"), sketch, sketch_schema)
        .withColumn("all_docs", F.sum("docs").over(over))
        .withColumn("all_runs", F.sum("runs").over(over))
        .where("all_docs > 1")
        .select("name", "batch", "runs", (F.col("all_runs") > hot_contexts).alias("hot")),
        "names",
    )
    runs = shared.agg(F.sum("runs")).first()[0] or 0
    buckets = int(runs * (length + 18) // sort_bytes + 1)
    lists = shared.groupBy("batch").agg(
        F.collect_set("name").alias("names"), F.collect_set(F.when(F.col("hot"), F.col("name"))).alias("hot")
    )
    context_schema = schema(
        ("bucket", "int"), ("context", "binary"), ("least", "long"), ("batch", "int"), ("number", "int")
    )

    def send(docs_: pa.Table, names: pa.Table) -> pa.Table:
        batch = _sorted_rows(docs_)
        if batch is None or not names.num_rows:
            return pa.Table.from_batches([record(context_schema, {c: [] for c in context_schema.names})])
        own = Contexts(batch, _names(names, "names"), _names(names, "hot"), length)
        name = own.name
        return pa.Table.from_batches(
            [
                record(
                    context_schema,
                    {
                        "bucket": ((name ^ (name >> np.uint64(32))) % np.uint64(buckets)).astype(np.int32),
                        "context": own.contexts,
                        "least": own.least,
                        "batch": np.full(len(name), docs_["batch"][0].as_py(), np.int32),
                        "number": np.arange(len(name), dtype=np.int32),
                    },
                )
            ]
        )

    answer_schema = schema(("batch", "int"), ("number", "int"), ("holders", "binary"))

    def solve(part: pa.Table) -> pa.Table:
        given = part["context"].combine_chunks().dictionary_encode()
        own = part["least"].to_numpy()
        which = given.indices.to_numpy()
        least = np.full(len(given.dictionary), np.iinfo(np.int64).max)
        np.minimum.at(least, which, own)
        holders = holders_of(given.dictionary, least, length)
        # A batch knows its own least key: what is no smaller need not be told.
        packed = [h.tobytes() if isinstance(h, np.ndarray) else h.to_bytes(8, "little", signed=True) for h in holders]
        smallest = np.array([h.min() if isinstance(h, np.ndarray) else h for h in holders], np.int64)
        told = np.flatnonzero(smallest[which] < own)
        return pa.Table.from_batches(
            [
                record(
                    answer_schema,
                    {
                        "batch": part["batch"].to_numpy()[told],
                        "number": part["number"].to_numpy()[told],
                        "holders": [packed[w] for w in which[told].tolist()],
                    },
                )
            ]
        )

    contexts = some.select("batch", "id", "body").groupBy("batch").cogroup(lists.groupBy("batch")).applyInArrow(send, context_schema)
    answers = written(contexts.groupBy("bucket").applyInArrow(solve, answer_schema), "holders")

    # The last step sees all rows; names and answers come as rows of one table.
    none = F.lit(None)
    told = lists.select(
        "batch", "names", "hot", none.cast("int").alias("number"), none.cast("binary").alias("holders")
    ).union(
        answers.select(
            "batch", none.cast("array<long>").alias("names"), none.cast("array<long>").alias("hot"), "number", "holders"
        )
    )
    out = schema(
        rows.schema["key"], ("n_bytes", "long"), ("span_starts", "array<long>"), ("span_ends", "array<long>"), ("kept", "binary")
    )

    def cut(docs_: pa.Table, info: pa.Table) -> pa.Table:
        batch = _sorted_rows(docs_)
        columns: dict[str, list] = {c: [] for c in out.names}
        if batch is not None:
            own = Contexts(batch, _names(info, "names"), _names(info, "hot"), length)
            given = info.filter(pc.is_valid(info["number"]))
            bodies = batch.column("body").to_pylist()
            columns["key"] = batch.column("key").to_pylist()
            for value, spans in zip(bodies, _spans(own, given["number"], given["holders"], batch.num_rows, length)):
                raw = value.encode()
                columns["n_bytes"].append(len(raw))
                columns["span_starts"].append([a for a, _ in spans])
                columns["span_ends"].append([b for _, b in spans])
                edges = [0, *(x for s in spans for x in s), len(raw)]
                columns["kept"].append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
        return pa.Table.from_batches([record(out, columns)])

    done = rows.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(cut, out)
    return done.withColumnRenamed("key", key)


def _spans(
    own: Contexts, number: pa.ChunkedArray, holders: pa.ChunkedArray, rows: int, length: int
) -> list[list[tuple[int, int]]]:
    """The maximal removed ranges of each row, given what holds the strings of the contexts of these numbers."""
    found: list[list[tuple[int, int]]] = [[] for _ in range(rows)]
    one = pc.equal(pc.binary_length(holders), 8)
    holder = own.least.copy()
    told, _ = text_bytes(holders.filter(one).combine_chunks())
    holder[number.filter(one).to_numpy()] = np.frombuffer(told.tobytes(), np.int64)
    each = pc.invert(one)
    apart = {n: np.frombuffer(h, np.int64) for n, h in zip(_values(number.filter(each)), _values(holders.filter(each)))}
    mixed = np.zeros(len(holder), bool)
    mixed[list(apart)] = True

    def add(spans: list[tuple[int, int]], start: int, end: int) -> None:
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))

    key = own.ids[own.row]
    runs = np.flatnonzero(mixed[own.number] | (holder[own.number] < key))
    for row, at, count, n, id_ in zip(*(x[runs].tolist() for x in (own.row, own.place, own.count, own.number, key))):
        if n not in apart:
            add(found[row], at, at + count + length - 1)
            continue
        smaller = np.flatnonzero(np.diff(np.concatenate(([0], (apart[n] < id_).view(np.int8), [0]))))
        for a, b in zip(smaller[::2].tolist(), smaller[1::2].tolist()):
            add(found[row], at + a, at + b + length - 1)
    return found
