"""Token counts by rank-synchronous merging: byte-pair merges on ragged numpy arrays, without the tokenizer's own code.

Pre-tokens lie one after the other in one array; in each round every sequence's lowest-rank pair is applied at all its
places at once. Long pre-tokens, which take many rounds of few merges, keep the places of each rank and look up only
the pairs next to a merge, so their work does not grow as the square of their length.

Null and empty texts have no tokens; repeated rows are counted each; an empty table gives no rows; only the id
and text columns are read. Special strings inside a text are one token each, as is the library's default.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Interned, array_slices, as_list, hold_memory
from .tokens import BYTES, PIECE_CHARS, PIECES, cut_spaced, ends_of

#: Bytes from which a pre-token is long.
LONG = 192


class MergeCounter:
    """Counts tokens of pieces. Ranks are looked up by binary search in the sorted merges."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError(f"{path}: only byte-level BPE without a normalizer is supported")
        added = [x for x in spec.get("added_tokens") or [] if x["content"]]
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in added):
            raise ValueError(f"{path}: added tokens that take in their surroundings are not supported")
        self.names = sorted((x["content"] for x in added), key=lambda x: -len(x))
        self.special = re.compile("|".join(map(re.escape, self.names))) if added else None
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        vocab = model["vocab"]
        self.byte_ids = np.array([vocab[x] for x in BYTES], np.int64)
        self.size = max(vocab.values()) + 1
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        left, right = (np.array([vocab[x[i]] for x in pairs], np.int64) for i in (0, 1))
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left * self.size + right
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made, self.made_of = key[order], order.astype(np.int64), made[order], made
        self.none = np.int64(len(pairs))
        self._reset()

    def _reset(self) -> None:
        self.memo, self.counts, self.chars = Interned(), np.zeros(0, np.int64), 0

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of pairs of symbols; none where no merge takes them."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.none)

    def merge_long(self, word: bytes) -> int:
        """Symbols that survive in one long word. Places are linked in both directions; each round takes all places of
        the lowest rank, left to right."""
        symbols = self.byte_ids[np.frombuffer(word, np.uint8)]
        n = len(symbols)
        after, before, alive = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        rank = np.append(self._ranks(symbols[:-1], symbols[1:]), self.none)
        order = np.argsort(rank, kind="stable")
        cuts = np.flatnonzero(np.diff(rank[order], prepend=-1))
        places = {int(rank[order[a]]): [order[a:b]] for a, b in zip(cuts, [*cuts[1:], n]) if rank[order[a]] != self.none}
        heap = sorted(places)
        left = n
        while heap:
            now = heapq.heappop(heap)
            at = np.unique(np.concatenate(places.pop(now)))
            at = at[alive[at] & (rank[at] == now)]
            # Of places that follow each other (a pair of equal symbols in a run) every second one counts, from the left.
            new_run = np.ones(len(at), bool)
            new_run[1:] = after[at[:-1]] != at[1:]
            begin = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - begin) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            symbols[at] = self.made_of[now]
            alive[gone] = False
            after[at] = after[gone]
            inner = at[after[at] < n]
            before[after[inner]] = inner
            left -= len(at)
            changed = np.union1d(at, before[at[before[at] >= 0]])
            end = after[changed] >= n
            fresh = self._ranks(symbols[changed], symbols[np.where(end, 0, after[changed])])
            fresh[end] = self.none
            rank[changed] = fresh
            for r in np.unique(fresh[fresh != self.none]).tolist():
                if r not in places:
                    places[r] = []
                    heapq.heappush(heap, r)
                places[r].append(changed[fresh == r])
        return left

    def merge(self, words: list[bytes]) -> np.ndarray:
        """Symbols that survive in each word.

        All words lie one after the other in one array. Each round looks up the rank of every adjacent pair,
        takes the lowest rank of each word and merges all its occurrences from left to right, in all words at
        once; words without a mergeable pair leave.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        out = lengths.copy()
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        while len(symbols) > 1:
            key = symbols[:-1] * self.size + symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (owner[:-1] == owner[1:])
            rank = np.where(known, self.ranks[at], self.none)
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            lowest = np.minimum.reduceat(np.append(rank, self.none), first)
            row = np.cumsum(np.diff(owner, prepend=owner[0]) != 0)
            hit = known & (rank == lowest[row[:-1]])
            # Of overlapping occurrences (a pair of equal symbols in a run) every second one counts, from the left.
            place = np.flatnonzero(hit)
            new_run = np.diff(place, prepend=-2) != 1
            begin = np.maximum.accumulate(np.where(new_run, np.arange(len(place)), 0))
            place = place[(np.arange(len(place)) - begin) % 2 == 0]
            if not len(place):
                break
            symbols[place] = self.made[at[place]]
            keep = np.ones(len(symbols), bool)
            keep[place + 1] = False
            out -= np.bincount(owner[place], minlength=len(out))
            keep &= (lowest != self.none)[row]
            symbols, owner = symbols[keep], owner[keep]
        return out

    def _fill(self) -> None:
        """Pieces are cut into pre-tokens; equal pre-tokens of a batch are merged once."""
        pending = self.memo.pending
        if not pending:
            return
        found = [self.pattern.findall(x) for x in pending]
        distinct: dict[str, int] = {}
        at = np.fromiter((distinct.setdefault(x, len(distinct)) for x in chain.from_iterable(found)), np.int64)
        words = [x.encode() for x in distinct]
        # Words of like length together: those that take many rounds do not hold up the rest.
        order = sorted((i for i in range(len(words)) if len(words[i]) < LONG), key=lambda i: len(words[i]))
        counts = np.zeros(len(words), np.int64)
        for i in range(0, len(order), 50_000):
            some = order[i : i + 50_000]
            counts[some] = self.merge([words[j] for j in some])
        for i, word in enumerate(words):
            if len(word) >= LONG:
                counts[i] = self.merge_long(word)
        self.counts = np.concatenate([self.counts, ends_of(counts[at], np.fromiter(map(len, found), np.int64, len(found)))])
        self.chars += sum(map(len, pending))
        pending.clear()

    def count(self, texts: pa.Array | list[str]) -> np.ndarray:
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        if len(self.memo) > PIECES or self.chars > PIECE_CHARS:
            self._reset()
        special, parted = np.zeros(len(texts), np.int64), np.ones(len(texts), np.int64)
        if self.special:
            there = np.zeros(len(texts), bool)
            for x in self.names:
                there |= pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
            if there.any():
                parts = [self.special.split(t) if x else [t] for t, x in zip(as_list(texts), there)]
                parted = np.fromiter(map(len, parts), np.int64, len(parts))
                special, texts = parted - 1, pa.array(list(chain.from_iterable(parts)), pa.string())
        pieces, at, sizes = cut_spaced(texts)
        names = as_list(pieces)
        own = np.fromiter(map(self.memo.__getitem__, names), np.int64, len(names))
        self._fill()
        return ends_of(ends_of(self.counts[own][at], sizes), parted) + special


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    return MergeCounter(path)


def count_tokens(docs: DataFrame, tokenizer: str, *, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document; no shuffle."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_memory("counter", counter.cache_clear)
        own = counter(tokenizer)
        for rows, texts in array_slices(batches, "text"):
            n = own.count(texts)
            sizes = pc.fill_null(pc.binary_length(rows.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), sizes, pa.array(n), pa.array(n > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(step, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
