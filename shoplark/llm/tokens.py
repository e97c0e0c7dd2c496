"""Memoised use of public tokenizers: every distinct unit of text is encoded once per worker.

A text is cut where the tokenizer's own pre-tokenizer cuts for certain, so that the ids of the pieces,
put together, are the ids of the text; letters with marks after them are two units. Cutting and finding the distinct
pieces of a slice is done in Arrow, so that Python sees those only. Texts for which that is not certain (special strings inside,
an unknown kind of tokenizer) are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import Interned, as_list, ragged

#: Unicode White_Space, which is what \s means to the tokenizers (Python's own \s also has U+001C to U+001F).
WIDE = "".join(map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
SPACE = f"\t-\r {WIDE}"
COARSE = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: White space other than single blanks and newlines between words.
IRREGULAR = f"[\t\x0b-\r{WIDE}]|\\A[ \n]|[ \n]\\z|[ \n][ \n]"
#: Latin letters that are NFC as they stand and lower-cased alike everywhere; ASCII marks other than "'".
LETTERS, MARKS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f", "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Units kept by one worker, and characters of them; beyond, it begins anew, so memory stays bounded.
PIECES, PIECE_CHARS = 600_000, 32 << 20
RAW = "\r"
#: The pattern by which "words" tokenizers cut what is left between white space (a fixed value of their files).
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def byte_symbols() -> list[str]:
    """The characters by which byte-level vocabularies write the 256 bytes: printable ones themselves, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names, extra = {b: chr(b) for b in plain}, 0
    for b in range(256):
        if b not in names:
            names[b] = chr(0x100 + extra)
            extra += 1
    return [names[b] for b in range(256)]


BYTES = byte_symbols()


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cut_spaced(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Pieces for byte-level pre-tokenizers that keep a blank with the word after it: distinct pieces, the piece at
    each place of the texts one after the other, and the number of places of each text."""
    odd = pc.match_substring_regex(texts, IRREGULAR)
    plain = texts.filter(pc.invert(odd))
    # Words parted by single blanks and newlines; the first one is told from those that have a blank before them.
    lists = pc.split_pattern(pc.replace_substring(pc.binary_join_element_wise(RAW, plain, ""), "\n", " \n"), " ")
    flat, counts = lists.flatten(), pc.list_value_length(lists).to_numpy().astype(np.int64)
    order = None
    if len(plain) < len(texts):
        found = [COARSE.findall(t) for t in texts.filter(odd).to_pylist()]
        flat = pa.concat_arrays([flat, pa.array([RAW + x for y in found for x in y], pa.string())])
        sizes = np.concatenate([counts, np.fromiter(map(len, found), np.int64, len(found))])
        rank = np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable")
        begin, counts = np.empty_like(sizes), np.empty_like(sizes)
        begin[rank], counts[rank] = np.cumsum(sizes) - sizes, sizes
        order = ragged(begin, counts)
    coded = flat.dictionary_encode()
    at, own = coded.indices.to_numpy(), coded.dictionary
    raw, line = pc.starts_with(own, RAW), pc.starts_with(own, "\n")
    own = pc.if_else(raw, pc.utf8_slice_codeunits(own, 1), pc.if_else(line, own, pc.binary_join_element_wise(" ", own, "")))
    return own, at if order is None else at[order], counts


def cut_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The same for tokenizers that drop white space, so that any ASCII white space parts pieces."""
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), pc.list_value_length(lists).to_numpy().astype(np.int64)


def ends_of(sizes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive sizes, as many as each of counts says."""
    return np.diff(np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])])


class Encoder:
    """Ids of texts as the tokenizers library gives them for a .json file, add_special_tokens=False."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        added = [x for x in spec.get("added_tokens") or [] if x["content"]]
        self.special = [x["content"] for x in added]
        plain = [x for x in added if not (x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"])]
        self.mark = plain[-1] if plain and len(plain) == len(added) else None
        self.kind = self._kind(spec) if self.mark else "whole"
        self.model = self.library.model
        #: Letters with marks after them, which are two pre-tokens, and those of one pre-token.
        blank = " ?" if self.kind == "spaced" else ""
        self.pair = f"\\A{blank}[{LETTERS}]+[{re.escape(MARKS)}]*\\z"
        self.unit = re.compile(f"{blank}(?:[{LETTERS}]+|[{re.escape(MARKS)}]+)").fullmatch
        self._reset()

    @staticmethod
    def _kind(spec: dict) -> str:
        """Which of the cuts is sure for this file; whatever is not exactly known is encoded whole."""
        pre, norm, model = spec.get("pre_tokenizer") or {}, spec.get("normalizer"), spec["model"]
        if model.get("type") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix"):
            return "whole"
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not norm:
            return "spaced"
        steps = (norm or {}).get("normalizers") or []
        blanks = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
        cuts = pre.get("pretokenizers") or []
        words = {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True}
        bytes_after = len(cuts) == 2 and cuts[1].get("type") == "ByteLevel" and not cuts[1].get("add_prefix_space") and not cuts[1].get("use_regex")
        if steps == [{"type": "NFC"}, blanks, {"type": "Lowercase"}] and bytes_after and cuts[0] == words:
            return "words"
        return "whole"

    def _reset(self) -> None:
        self.memo, self.chars = Interned(), 0
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat, self.uses = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Drop the units that were met once, as most are; if that does not free half of the places, all."""
        keep = np.flatnonzero(self.uses > 1)
        names = list(self.memo)
        if len(keep) > PIECES // 2 or sum(len(names[i]) for i in keep.tolist()) > PIECE_CHARS // 2:
            return self._reset()
        self.memo = Interned()
        self.memo.update((names[i], n) for n, i in enumerate(keep.tolist()))
        self.chars = sum(map(len, self.memo))
        self.flat = self.flat[ragged(self.start[keep], self.length[keep])]
        self.length = self.length[keep]
        self.start = np.cumsum(self.length) - self.length
        self.uses = np.zeros(len(keep), np.int64)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _fill(self) -> None:
        """Encode the pending units: those of one pre-token by the library's model itself, the others many at once, held
        apart by a special token."""
        pending = self.memo.pending
        if not pending:
            return
        unit, tokenize, found, others = self.unit, self.model.tokenize, [], []
        for i, x in enumerate(pending):
            if unit(x):
                # Byte symbols of ASCII are the characters themselves, but for the blank.
                word = (BYTES[32] + x[1:] if x[0] == " " else x) if x.isascii() else "".join([BYTES[b] for b in x.encode()])
                found.append([t.id for t in tokenize(word)])
            else:
                found.append([])
                if x:
                    others.append(i)
        for i in range(0, len(others), 10_000):
            some = [pending[j] for j in others[i : i + 10_000]]
            joined = [self.mark["content"].join(some[j : j + 100]) + self.mark["content"] for j in range(0, len(some), 100)]
            j = i
            for ids in self._library(joined):
                begin = 0
                for end in np.flatnonzero(np.array(ids) == self.mark["id"]).tolist():
                    found[others[j]] = ids[begin:end]
                    begin, j = end + 1, j + 1
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum()))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(lengths) - lengths])
        self.length = np.concatenate([self.length, lengths])
        self.flat = np.concatenate([self.flat, ids])
        self.uses = np.concatenate([self.uses, np.zeros(len(lengths), np.int64)])
        self.chars += sum(map(len, pending))
        pending.clear()

    def _units(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the one or two units of each piece (letters, then marks; -1 for no second one)."""
        pair = pc.match_substring_regex(pieces, self.pair)
        body = pc.ascii_rtrim(pieces, characters=MARKS)
        body = pc.if_else(pair, pc.utf8_lower(body) if self.kind == "words" else body, pieces)
        rest = np.where(pair.to_numpy(zero_copy_only=False), pc.binary_length(pieces).to_numpy() - pc.binary_length(body).to_numpy(), 0)
        two = np.flatnonzero(rest)
        offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
        marks = np.frombuffer(pieces.buffers()[2] or b"", np.uint8)[ragged(offsets[1:][two] - rest[two], rest[two])]
        bounds = np.concatenate([[0], np.cumsum(rest[two])]).astype(np.int32)
        units = pa.concat_arrays([body, pa.StringArray.from_buffers(len(two), pa.py_buffer(bounds), pa.py_buffer(marks))]).dictionary_encode()
        names = as_list(units.dictionary)
        at = np.fromiter(map(self.memo.__getitem__, names), np.int64, len(names))[units.indices.to_numpy()]
        second = np.full(len(pieces), -1)
        second[two] = at[len(pieces) :]
        self._fill()
        self.uses += np.bincount(at, minlength=len(self.uses))
        return at[: len(pieces)], second

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces, at, counts = (cut_spaced if self.kind == "spaced" else cut_words)(texts)
        first, second = self._units(pieces)
        starts = np.stack([self.start[first], self.start[second]], 1) if len(first) else np.zeros((0, 2), np.int64)
        lengths = np.stack([self.length[first], np.where(second < 0, 0, self.length[second])], 1) if len(first) else starts
        ids, lengths = self.flat[ragged(starts.ravel(), lengths.ravel())], lengths.sum(1)
        begin, sizes = np.cumsum(lengths) - lengths, lengths[at]
        return ids[ragged(begin[at], sizes)], ends_of(sizes, counts)

    def encode(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)."""
        texts = pa.array(texts, pa.string()) if isinstance(texts, list) else texts
        if len(self.memo) > PIECES or self.chars > PIECE_CHARS:
            self._forget()
        whole = np.full(len(texts), self.kind == "whole")
        for x in self.special if self.kind != "whole" else ():
            whole |= pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._cut(texts)
        ids, sizes = self._cut(texts.filter(pa.array(~whole))) if not whole.all() else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        found = self._library(texts.filter(pa.array(whole)).to_pylist())
        flat = np.concatenate([ids, *(np.array(x, np.int32) for x in found)])
        lengths = np.concatenate([sizes, np.fromiter(map(len, found), np.int64, len(found))])
        rank = np.argsort(whole, kind="stable")
        begin, sizes = np.empty_like(lengths), np.empty_like(lengths)
        begin[rank], sizes[rank] = np.cumsum(lengths) - lengths, lengths
        return flat[ragged(begin, sizes)], sizes


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """The worker's own encoder of a file; workers are reused by later tasks."""
    return Encoder(path)
