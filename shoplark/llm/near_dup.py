"""Near duplicates by HyperMinHash: compressed registers are banded, candidates estimated, links confirmed on full sets.

A document's set is its distinct 5-word shingles (lower-cased A-Z, words parted by ASCII white space); with fewer
words the whole sequence is one shingle; without words the set is empty and the document is linked with nothing.
Documents are linked if 100 * intersection >= 75 * union.

1. One pass makes each document's sketch: 128 buckets, for each the leading-zero count and ten mantissa bits of
   its smallest hash, and a 128-bit fingerprint of the whole set. Documents with equal sets are one class.
2. 32 bands of 4 registers are the keys under which classes meet. At the threshold a pair shares no band with a
   probability of (1 - 0.75**4)**32, 5e-6. Bands without any hash are no keys.
3. Within each key's group a breadth-first search over collision-corrected estimates links classes into candidate
   clusters; it emits a tree, so a group of n gives less than n rows, and it compares a class only with those that
   are not yet reached. Groups beyond a size are searched in pairs of blocks.
4. The full sets of a cluster's classes meet once (large clusters again in pairs of blocks), and the same search
   over confirmed links gives the trees whose components are the result. Whatever pair of classes is not in one
   tree was compared, so no link between different texts is lost; no pairs are made that are not links.

Estimates only set aside pairs whose estimate is more than four standard errors below the threshold.

Rows with a null doc_id are returned as kept, without a component. Repeated rows are of one component; rows that
share a doc_id are one node, whatever their texts: what is near to one of them is in one component with all. An empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, hold_memory, map_arrow, mix64, stored, text_slices

BANDS, ROWS = 32, 4
BUCKETS = BANDS * ROWS
BUCKET_BITS, MANTISSA_BITS = 7, 10
NO_HASH = 0xFFFF
#: Words that one worker keeps the hashes of.
WORDS = 300_000
#: Classes of one key's group that are searched together, and classes and bytes of full sets; beyond, blocks meet in pairs.
BLOCK, SET_ROWS, SET_BYTES = 4096, 1024, 8 << 20
#: Bits of the map of ids that is sent to all tasks, at least and at most (16 MB); for more ids the texts are joined.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()


def hold_hashes() -> None:
    """A function of the module, so that it finds the worker's own dictionary; a nested one would be sent a copy."""
    hold_memory("hashes", _hashes.clear)


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    if len(_hashes) > WORDS:
        _hashes.clear()
    words = [t.lower().split() for t in texts]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter(map(_hashes.__getitem__, chain.from_iterable(words)), np.uint64, int(sizes.sum()))
    out, ends = [], np.cumsum(sizes)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(flat) - width + 1), np.uint64)
        for i in range(width):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + flat[i : i + len(rolled)]
        rolled = mix64(rolled)
        for n, end in zip(sizes.tolist(), ends.tolist()):
            if n >= width:
                out.append(np.unique(rolled[end - n : end - width + 1]))
            elif n:
                h = np.uint64(n)
                for x in flat[end - n : end]:
                    h = h * np.uint64(0x9E3779B97F4A7C15) + x
                out.append(mix64(np.array([h], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def registers(hashes: np.ndarray) -> np.ndarray:
    """128 registers of a sorted set: leading zeros and mantissa of the smallest hash of each bucket."""
    out = np.full(BUCKETS, NO_HASH, np.uint16)
    if len(hashes):
        bucket = (hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
        least = np.zeros(BUCKETS, np.uint64)
        least[bucket[::-1]] = hashes[::-1]  # of equal buckets the last assignment stays, which is the smallest hash
        used = np.unique(bucket)
        value = least[used] >> np.uint64(BUCKET_BITS)
        bits = 64 - BUCKET_BITS
        # Doubles hold the exponent of 57-bit numbers up to rounding at the top, which is undone.
        length = np.frexp(value.astype(np.float64))[1].astype(np.int64)
        length -= (value >> np.maximum(length - 1, 0).astype(np.uint64)) == 0
        zeros = bits - length
        shift = length - 1 - MANTISSA_BITS
        mantissa = np.where(shift >= 0, value >> np.maximum(shift, 0).astype(np.uint64), value << np.maximum(-shift, 0).astype(np.uint64)) & np.uint64((1 << MANTISSA_BITS) - 1)
        out[used] = (zeros << MANTISSA_BITS).astype(np.uint16) | mantissa.astype(np.uint16)
    return out


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of register rows, and their standard errors at 0.75.

    Two different hashes fall on one register value with a probability of about 2**-MANTISSA_BITS / 3 (a third for
    equal leading-zero counts); the expected number of such collisions is taken off. Registers are a sample of the
    union without replacement, so the error shrinks as they come to hold all of it.
    """
    some = (a != NO_HASH) | (b != NO_HASH)
    both = (a != NO_HASH) & (b != NO_HASH)
    n = np.maximum(some.sum(-1), 1)
    collisions = both.sum(-1) * (2.0**-MANTISSA_BITS / 3)
    equal = ((a == b) & both).sum(-1)
    union = np.maximum((na + nb) / 1.75, n)
    error = np.sqrt(0.75 * 0.25 / n * (union - n + 0.5) / np.maximum(union - 1, 1))
    return np.clip((equal - collisions) / np.maximum(n - collisions, 1e-9), 0, 1), error


def promising(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: int) -> np.ndarray:
    """Which pairs may reach the threshold. Sizes alone rule out 100 * smaller < threshold * larger."""
    value, error = estimate(a, b, na, nb)
    sizes = 100 * np.minimum(na, nb) >= threshold * np.maximum(na, nb)
    return sizes & (value >= threshold / 100 - 4 * error)


def search(count: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """(reached from, reached) of a breadth-first search of all components; linked tells which of the others a row is linked to.

    Rows are only compared with those not reached yet. Two rows of different trees were compared: when the earlier
    one was looked from, the later one was not reached.
    """
    unseen = np.arange(count)
    while len(unseen):
        queue, unseen = [int(unseen[0])], unseen[1:]
        while queue and len(unseen):
            row = queue.pop()
            hit = linked(row, unseen)
            if hit.any():
                found, unseen = unseen[hit], unseen[~hit]
                yield row, found
                queue += found.tolist()


def groups_of(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """The rows of each key from batches that are sorted by it."""
    held: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        keys = np.stack([batch.column(x).to_numpy() for x in key])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a == b:
                continue
            now = tuple(keys[:, a].tolist())
            if now != at and held:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            at = now
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _edges(ids: np.ndarray, found: Iterator[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    a, b = [], []
    for row, others in found:
        a.append(np.full(len(others), ids[row]))
        b.append(ids[others])
    none = [np.zeros(0, np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a or none)), pa.array(np.concatenate(b or none))], names=["a", "b"])


def in_block_pairs(rows: DataFrame, blocks: Column) -> DataFrame:
    """Each row once for every pair (i, j) of blocks of its group that its own block is in; one block: once."""
    own = rows.withColumn("blocks", F.greatest(blocks, F.lit(1)).cast("int")).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # Two blocks and more meet as pairs of different ones, which look at both blocks' inner links too.
    dealt = dealt.where((F.col("blocks") == 1) | (F.col("own") != F.col("other")))
    return dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("blocks", "own", "other")


def _register_rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint16).reshape(len(column), BUCKETS)


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_shingles, set_hi and set_lo (fingerprint), regs (a long a band) of every row."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        hold_hashes()
        for rows, texts in text_slices(batches, "text"):
            sets = shingle_sets(texts)
            prints = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.tobytes()) for x in sets), np.int64).reshape(-1, 2)
            regs = np.stack([registers(x) for x in sets]).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(regs.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1]), lists], names=["doc_id", "n_shingles", "set_hi", "set_lo", "regs"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return map_arrow(rows, step, "doc_id long, n_shingles long, set_hi long, set_lo long, regs array<bigint>")


def full_sets(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, set (sorted hashes as bytes) of the documents in ids, from their whole texts.

    A bitmap of hashed ids, sixteen bits an id, is tested before texts are looked at, and the exact join comes after:
    the texts are not shuffled. For more ids than the largest map is good for, texts are joined with the ids first.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")).where("id is not null")
    count = ids.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (16 * count).bit_length()))
    if 4 * count > MOST_BITS:
        rows = rows.join(ids.select("id"), "id", "left_semi")
    bit = F.pmod(F.xxhash64("id"), F.lit(bits)) + 1
    maps = ids.select(bit.alias("bit")).groupBy(F.expr("bitmap_bucket_number(bit)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(bit))").alias("bits"))
    bitmap = np.zeros(bits // 8, np.uint8)
    for r in maps.toLocalIterator():  # 4,096 rows of 4 KB at most; positive numbers begin with bucket 1
        part = bitmap[(r.bucket - 1) * 4096 : r.bucket * 4096]
        part[:] = np.frombuffer(bytes(r.bits), np.uint8)[: len(part)]
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_hashes()
        for batch in batches:
            bits = batch.column("bit").to_numpy() - 1
            there = (sent.value[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1
            for rows, texts in text_slices([batch.filter(pa.array(there.astype(bool)))], "text"):
                yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array([x.tobytes() for x in shingle_sets(texts)], pa.binary())], names=["id", "set"])

    found = map_arrow(rows.withColumn("bit", bit).select("id", "text", "bit"), step, "id long, set binary")
    return found.join(ids.select("id"), "id", "left_semi").dropDuplicates(["id", "set"])


def candidate_edges(active: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """Trees (a, b) of the classes of each key whose estimates may reach the threshold. active has key, id, size."""
    dealt = in_block_pairs(active, F.ceil(F.col("size") / BLOCK)).select("key", "i", "j", "id")
    met = dealt.join(classes.select("id", "n", "regs"), "id").select("key", "i", "j", "id", "n", "regs").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_memory("sets", lambda: None)
        for group in groups_of(batches, ["key", "i", "j"]):
            ids, n, regs = group.column("id").to_numpy(), group.column("n").to_numpy(), _register_rows(group.column("regs").combine_chunks())
            yield _edges(ids, search(len(ids), lambda row, others: promising(regs[row], regs[others], n[row], n[others], threshold)))

    return map_arrow(met, step, "a long, b long").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()


def is_linked(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """Of two sorted sets, exactly."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < threshold * len(large):
        return False
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    inter = int((large[at] == small).sum())
    return 100 * inter >= threshold * (len(small) + len(large) - inter)


def confirmed_edges(docs: DataFrame, clusters: DataFrame, threshold: int, id_col: str, text_col: str) -> DataFrame:
    """Trees (a, b) of confirmed links within clusters (id, comp)."""
    sets = stored(full_sets(docs, clusters, id_col, text_col).join(clusters, "id"), "sets", compression="none")
    sizes = sets.groupBy("comp").agg(F.sum(F.length("set")).alias("bytes"), F.count("*").alias("rows"))
    dealt = in_block_pairs(sets.join(sizes, "comp"), F.greatest(F.ceil(F.col("bytes") / SET_BYTES), F.ceil(F.col("rows") / SET_ROWS)))
    met = dealt.select("comp", "i", "j", "id", "set").repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_memory("sets", lambda: None)
        for group in groups_of(batches, ["comp", "i", "j"]):
            ids = group.column("id").to_numpy()
            own = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("set").combine_chunks()]
            regs, n = np.stack([registers(x) for x in own]), np.array([len(x) for x in own])

            def linked(row: int, others: np.ndarray, own=own, regs=regs, n=n) -> np.ndarray:
                fit = promising(regs[row], regs[others], n[row], n[others], threshold)
                for k in np.flatnonzero(fit):
                    fit[k] = is_linked(own[row], own[others[k]], threshold)
                return fit

            yield _edges(ids, search(len(ids), linked))

    return map_arrow(met, step, "a long, b long").where("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """id, comp (smallest id of its component) of all ids in edges (a, b): smallest-label passing with pointer jumps."""
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("comp")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("comp").alias("m"))
        moved = labels.join(near.withColumnRenamed("a", "id"), "id").select("id", "comp", F.least("comp", "m").alias("to"))
        there = labels.select(F.col("id").alias("to"), F.col("comp").alias("jump"))
        after = stored(moved.join(there, "to", "left").select("id", F.col("comp").alias("was"), F.least("to", "jump").alias("comp")), "labels")
        last, labels = labels, after.select("id", "comp")
        labels.stored_at = after.stored_at
        forget(last)
        if after.where("was <> comp").isEmpty():
            forget(both)
            return labels


def near_duplicates(docs: DataFrame, *, threshold: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    rows = stored(sketches(docs, id_col, text_col), "sketches")
    print_of = ["set_hi", "set_lo", "n_shingles"]
    usable = rows.where("doc_id is not null and n_shingles > 0")
    classes = stored(usable.groupBy(*print_of).agg(F.min("doc_id").alias("id"), F.min_by("regs", "doc_id").alias("regs")).withColumnRenamed("n_shingles", "n"), "classes")
    keyed = classes.select("id", F.posexplode("regs")).where("col <> -1").select(F.xxhash64("pos", "col").alias("key"), "id")
    shared = keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    near = stored(candidate_edges(keyed.join(shared, "key"), classes, threshold), "candidates")
    links = None if near.isEmpty() else stored(confirmed_edges(docs, components(near), threshold, id_col, text_col), "links")

    names = classes.select(F.col("set_hi"), F.col("set_lo"), F.col("n").alias("n_shingles"), F.col("id"))
    # Different texts under one id link the classes that they are in.
    several = usable.groupBy("doc_id").agg(*(f(c).alias(f"{n}_{c}") for c in print_of for n, f in (("low", F.min), ("high", F.max)))).where(" or ".join(f"low_{c} <> high_{c}" for c in print_of))
    several = stored(several.select("doc_id"), "several")
    if not several.isEmpty():
        of = usable.join(several, "doc_id", "left_semi").join(names, print_of).where("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
        links = stored(of if links is None else links.unionByName(of), "links")
    labels = None if links is None or links.isEmpty() else components(links)
    if labels is not None:
        names = names.join(labels, "id", "left")
    names = names.select(*print_of, (F.coalesce("comp", "id") if labels is not None else F.col("id")).alias("component_id"))
    joined = rows.select("doc_id", *print_of).join(names, print_of, "left")
    empty = stored(rows.where("doc_id is not null and n_shingles = 0").select("doc_id").distinct().join(usable.select("doc_id"), "doc_id", "left_semi"), "empty")
    if not empty.isEmpty():
        # A row without words is of the component that the other rows of its id are in.
        own = joined.join(empty, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("own"))
        joined = joined.join(own, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "own"))
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("long")).otherwise(F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
