"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the windows of consecutive item words. A text is read through a window of the shortest pattern
length; the block of its last words gives, from the shift table, how far it can move without skipping an
occurrence. Where the shift is 0, the block's bucket and a hash of the window select patterns, and a direct
comparison of the words confirms them. Windows that are shorter than the rest (items of few words) have tables of
their own, so they do not shorten the shifts of the others.

Words are numbers, tables are sorted arrays, and many stretches of text are searched side by side, each with its own
shifts: a stretch is LANE places at which an occurrence may end, so any number of long texts is searched in as many
steps as one stretch takes.

Null or wordless texts have no words and no hits; items without words have no windows; equal windows of several
items count for each of them; items without an id are one item, whose id is the empty string; rows with equal or null
ids are searched each for itself; an empty benchmark hits nothing, an empty table gives no rows. Only the id and text
columns of both tables are read.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import array_slices, as_list, hold_memory, mix64, ragged, stored
from .tokens import cut_words, ends_of

#: Bytes to blanks, A-Z to lower case; digits, letters and all bytes of non-ASCII characters are word bytes.
WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
WORD_TABLE = np.frombuffer(WORD_BYTES, np.uint8)
#: Items searched for in one pass over the texts; more items take more passes. Bounds what is broadcast.
ITEM_BYTES = 16 << 20
#: Places of a text that are searched one after the other.
LANE = 64
UNKNOWN = 0


def split_words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def word_texts(texts: pa.Array) -> pa.Array:
    """Texts of the same lengths with blanks between words."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(texts) else np.zeros(0, np.uint8)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(offsets - offsets[0]), pa.py_buffer(WORD_TABLE[data]))


class WuManber:
    """Tables of the patterns of one length: windows of the item words that begin at the places starts."""

    def __init__(self, words: np.ndarray, begin: np.ndarray, size: np.ndarray, items: np.ndarray, length: int) -> None:
        """Of the items whose size words begin at the places begin."""
        self.words, self.length, self.block = words, length, min(3, length)
        self.longest = length - self.block + 1
        starts, owner = ragged(begin, size - length + 1), np.repeat(items, size - length + 1)
        # Each block's least distance to the end of a pattern: from an item's first whole window on, every place is such
        # an end. Equal keys of different blocks only make shifts smaller.
        places = ragged(begin + self.block - 1, size - self.block + 1)
        distance = np.maximum(np.repeat(begin + length - 1, size - self.block + 1) - places, 0).astype(np.int32)
        keys = self._keys(words, places)
        order = np.lexsort((distance, keys))
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.blocks, self.shift = keys[first], distance[order][first]
        # Patterns by bucket (the place of their last block) and the hash of the window, with the items of each.
        select = self._select(words, starts, np.searchsorted(self.blocks, self._keys(words, starts + length - 1)))
        order = np.lexsort((owner, select))
        self.select, self.starts, self.items = select[order], starts[order].astype(np.int32), owner[order].astype(np.int32)

    def _keys(self, words: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Of the blocks that end at the given places."""
        key = np.zeros(len(last), np.uint64)
        for back in range(self.block - 1, -1, -1):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + words[last - back].astype(np.uint64))
        return key

    def _select(self, words: np.ndarray, starts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        value = np.zeros(len(starts), np.uint64)
        for i in range(self.length):
            value = mix64(value * np.uint64(0x9E3779B97F4A7C15) + words[starts + i].astype(np.uint64))
        return bucket.astype(np.uint64) << np.uint64(32) | value >> np.uint64(32)

    def search(self, words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, item) of every occurrence in the texts words[begin:end]; an item is there once for a place."""
        m = self.length
        long = end - begin >= m
        first, last = begin[long] + m - 1, end[long]
        lanes = -(-(last - first) // LANE)
        at = ragged(np.zeros(len(lanes), np.int64), lanes) * LANE + np.repeat(first, lanes)
        stop = np.minimum(at + LANE, np.repeat(last, lanes))
        ends, buckets = [], []
        while len(at):
            key = self._keys(words, at)
            place = np.minimum(np.searchsorted(self.blocks, key), len(self.blocks) - 1)
            step = np.where(self.blocks[place] == key, self.shift[place], self.longest)
            hit = step == 0
            ends.append(at[hit])
            buckets.append(place[hit])
            at = at + np.maximum(step, 1)
            go = at < stop
            at, stop = at[go], stop[go]
        found = np.concatenate(ends) - (m - 1) if ends else np.zeros(0, np.int64)
        select = self._select(words, found, np.concatenate(buckets)) if len(found) else np.zeros(0, np.uint64)
        low = np.searchsorted(self.select, select)
        many = np.searchsorted(self.select, select, "right") - low
        pattern, place = ragged(low, many), np.repeat(found, many)
        same = np.ones(len(pattern), bool)
        for i in range(m):
            same &= self.words[self.starts[pattern] + i] == words[place + i]
        return place[same], self.items[pattern[same]]


class Matcher:
    def __init__(self, items: list[tuple[str, bytes]], window: int) -> None:
        self.names = sorted({x for x, _ in items})
        number = {x: i for i, x in enumerate(self.names)}
        self.vocabulary: dict[str, int] = {}
        by_length: dict[int, list] = defaultdict(list)
        flat: list[int] = []
        for item_id, text in items:
            own = [self.vocabulary.setdefault(w.decode("utf-8", "replace"), len(self.vocabulary) + 1) for w in split_words(text)]
            if own:
                by_length[min(window, len(own))].append((len(flat), len(own), number[item_id]))
                flat += own
        words = np.array(flat, np.int32)
        self.tables = []
        for size, rows in sorted(by_length.items()):
            begin, length, item = (np.array(x, np.int64) for x in zip(*rows))
            self.tables.append(WuManber(words, begin, length, item, size))

    def find(self, texts: pa.Array) -> tuple[np.ndarray, list[list[int]], list[list[str]]]:
        """Of each text: how many words, the bounds of disjoint ascending spans of hit words, and the items found, sorted."""
        distinct, at, counts = cut_words(word_texts(texts))
        names = as_list(distinct)
        there = np.fromiter(map(bool, names), bool, len(names))[at]
        known = np.fromiter((self.vocabulary.get(x, UNKNOWN) for x in names), np.int32, len(names))
        words, sizes = known[at[there]], ends_of(there, counts)
        end = np.cumsum(sizes)
        begin = end - sizes
        cover = np.zeros(len(words) + 1, np.int64)
        owners, items = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for t in self.tables:
            place, item = t.search(words, begin, end)
            hit = np.unique(place)
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + t.length, -1)
            owners.append(np.searchsorted(end, place, "right"))
            items.append(item.astype(np.int64))
        bounds: list[list[int]] = [[] for _ in range(len(texts))]
        inside = np.concatenate([[False], np.cumsum(cover[:-1]) > 0, [False]])
        # A hit word at the end of a text and one at the beginning of the next are two spans.
        ups = np.flatnonzero(inside[1:-1] & (~inside[:-2] | np.isin(np.arange(len(words)), begin)))
        downs = np.flatnonzero(inside[1:-1] & (~inside[2:] | np.isin(np.arange(1, len(words) + 1), begin)))
        for a, b, k in zip(ups.tolist(), downs.tolist(), np.searchsorted(end, ups, "right").tolist()):
            bounds[k] += [a - int(begin[k]), b + 1 - int(begin[k])]
        found: list[list[str]] = [[] for _ in range(len(texts))]
        pairs = np.unique(np.concatenate(owners) * (len(self.names) + 1) + np.concatenate(items))
        for x in pairs.tolist():
            found[x // (len(self.names) + 1)].append(self.names[x % (len(self.names) + 1)])
        return sizes, bounds, found


#: The worker's last tables, by the name of the block; later tasks of a pass find them here.
_built: dict[str, Matcher] = {}


def matcher_of(name: str, sent: Broadcast, window: int) -> Matcher:
    """A function of the module, so that it finds the worker's own dictionary; a nested one would be sent a copy."""
    hold_memory("patterns", _built.clear)
    if name not in _built:
        _built.clear()
        _built[name] = Matcher(sent.value, window)
    return _built[name]


def find_benchmark_spans(
    docs: DataFrame, benchmark: DataFrame, *, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", item_bytes: int = ITEM_BYTES, carry: bool = False
) -> DataFrame:
    """doc_id, n_words, spans (word ranges that items cover) and items (ids as strings) of every document; carry adds the whole document as a struct named row.

    The benchmark is collected in blocks of item_bytes, each of which is one pass of a narrow operator; passes are
    written between, so that the tables of one block are alive at a time. Spans and items of the passes are united, so
    the result is the same for any number of blocks.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(item_text_col).cast("binary"), F.lit(b"")).alias("text"))
    total = items.agg(F.coalesce(F.sum(F.length("text") + 32), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // item_bytes))
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.array().cast("array<bigint>").alias("bounds"), F.array().cast("array<string>").alias("items"), *[F.struct("*").alias("row")] * carry)
    names = ["doc_id", "text", "bounds", "items", *["row"] * carry]
    schema = T.StructType([*rows.schema, T.StructField("n_words", T.LongType())])
    for block in range(blocks):
        some = items if blocks == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast([(r.id, bytes(r.text)) for r in some.toLocalIterator()])
        last, name = block == blocks - 1, uuid.uuid4().hex

        def step(batches: Iterator[pa.RecordBatch], sent=sent, last=last, name=name) -> Iterator[pa.RecordBatch]:
            matcher = matcher_of(name, sent, window)
            for rows, texts in array_slices(batches, "text"):
                counts, bounds, found = matcher.find(texts)
                for i, (b, x) in enumerate(zip(rows.column("bounds").to_pylist(), rows.column("items").to_pylist())):
                    if b:
                        bounds[i] = _united([*zip(b[::2], b[1::2]), *zip(bounds[i][::2], bounds[i][1::2])])
                    if x:
                        found[i] = sorted({*found[i], *x})
                text = pa.nulls(len(rows), pa.string()) if last else rows.column("text")
                whole = [rows.column("row")] if carry else []
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), text, pa.array(bounds, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.string())), *whole, pa.array(counts, pa.int64())], names=[*names, "n_words"]
                )

        rows = rows.select(*names).mapInArrow(step, schema)
        if not last:
            rows = stored(rows, "searched")
    spans = F.transform(F.sequence(F.lit(0), F.expr("cast(size(bounds) / 2 as int) - 1")), lambda i: F.struct(F.get("bounds", i * 2).alias("begin"), F.get("bounds", i * 2 + 1).alias("end")))
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    return rows.select("doc_id", "n_words", F.when(F.size("bounds") > 0, spans).otherwise(none).alias("spans"), "items", *["row"] * carry)


def _united(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(b, out[-1])
        else:
            out += [a, b]
    return out


def decontamination_digest(spans: DataFrame) -> DataFrame:
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return spans.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated")
    )
