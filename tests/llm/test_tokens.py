import random
import struct
import zlib
from itertools import product

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shoplark.llm import tokens
from shoplark.llm.common import shared_path
from shoplark.llm.packing import differencing, pack, windows
from shoplark.llm.token_counts import MergeCounter, count_tokens
from shoplark.llm.token_files import read_token_metadata, read_tokens, token_file_digest, write_token_files
from shoplark.llm.tokens import Encoder

from .cases import documents, texts

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_pieces_give_the_librarys_ids(name):
    own, lib = Encoder(public_tokenizers.path(name)), library(name)
    values = [t or "" for t in texts()]
    blanks = ["a", "b\xe9", " ", "\n", "\t", "\xa0", "!", "'s", "\u3000"]
    values += ["".join(x) for n in (1, 2, 3, 4) for x in product(blanks, repeat=n)]
    for some in (values, values[::-1], values[:3]):
        ids, sizes = own.encode(some)
        want = [lib.encode(t, add_special_tokens=False).ids for t in some]
        assert sizes.tolist() == [len(x) for x in want]
        assert ids.tolist() == [y for x in want for y in x]


def test_forgetting_pieces_changes_nothing(monkeypatch):
    lib, own = library(WORD), Encoder(public_tokenizers.path(WORD))
    monkeypatch.setattr(tokens, "PIECES", 40)
    rng = random.Random(6)
    for _ in range(30):
        some = [" ".join(rng.choice(("a", "bc", f"w{rng.randint(0, 500)}", "x.", "d\xe9f")) for _ in range(30)) for _ in range(3)]
        ids, sizes = own.encode(some)
        assert ids.tolist() == [y for t in some for y in lib.encode(t, add_special_tokens=False).ids]


def test_rank_synchronous_merging_counts_as_the_library_does():
    own, lib = MergeCounter(public_tokenizers.path(BYTE)), library(BYTE)
    rng = random.Random(3)
    values = [t or "" for t in texts()] + ["".join(rng.choice("aab\xe9 \n'st") for _ in range(rng.randint(1, 40))) for _ in range(2000)]
    assert own.count(values).tolist() == [len(lib.encode(t, add_special_tokens=False).ids) for t in values]


def test_count_tokens_rows(spark):
    lib, values = library(BYTE), texts()
    got = {r.doc_id: r for r in count_tokens(documents(spark), public_tokenizers.path(BYTE), limit=100).collect()}
    assert len(got) == len(values)
    for i, t in enumerate(values):
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_bytes, got[i].n_tokens, got[i].over_limit) == (len((t or "").encode()), n, n > 100)
    assert count_tokens(documents(spark, []), public_tokenizers.path(BYTE)).count() == 0


def test_token_files_round_trip(spark):
    lib, values = library(WORD), texts()
    docs = documents(spark).repartition(5)
    got = sorted(token_file_digest(docs, public_tokenizers.path(WORD), end_id=2, partitions=3).collect())
    at = 0
    for i, (t, row) in enumerate(zip(values, got, strict=True)):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [2]
        assert tuple(row) == (i, at, len(ids), crc(ids))
        at += len(ids)
    assert token_file_digest(documents(spark, []), public_tokenizers.path(WORD), end_id=2).count() == 0


def test_token_files_are_sorted_encoded_and_selective(spark):
    path = shared_path(spark, "t")
    write_token_files(documents(spark), path, public_tokenizers.path(WORD), end_id=2, partitions=2)
    files = [r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()]
    import pyarrow.parquet as pq

    for file in files:
        meta = pq.ParquetFile(file.removeprefix("file://").removeprefix("file:")).metadata
        columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
        assert any("DICTIONARY" in x for x in columns["ids.list.element"].encodings)
        assert columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index
    plan = read_token_metadata(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan
    one = read_tokens(spark, path).where("doc_id = 30").collect()
    assert len(one) == 1 and one[0].ids[-1] == 2


def test_differencing_is_near_equal():
    rng = random.Random(1)
    for n, k in ((8, 3), (100, 7), (300, 120), (2, 5), (1, 1)):
        sizes = [rng.randint(1, 2047) for _ in range(n)]
        parts = differencing(sizes, k)
        assert len(parts) == k and sorted(i for p in parts for i in p) == list(range(n))
    loads = [sum(sizes for sizes in p) for p in [[8, 7], [6, 5, 4]]]
    assert [sorted(sum([8, 7, 6, 5, 4][i] for i in p) for p in differencing([8, 7, 6, 5, 4], 2))] == [[14, 16]] and loads == [15, 15]
    many = [rng.randint(1, 200) for _ in range(500)]
    sums = [sum(many[i] for i in p) for p in differencing(many, 20)]
    assert max(sums) - min(sums) <= 3


def test_windows_hold_everything_with_little_padding():
    rng = random.Random(2)
    for sizes in ([2047] * 9, [1], [5, 6, 7], [rng.randint(1, 2047) for _ in range(700)], []):
        got = windows(sizes, 2048)
        assert all(0 < sum(x[2] for x in w) <= 2048 for w in got)
        seen = {}
        for w in got:
            for i, begin, length in w:
                seen.setdefault(i, []).append((begin, length))
        assert {i: sum(n for _, n in x) for i, x in seen.items()} == dict(enumerate(sizes))
        for x in seen.values():
            x.sort()
            assert all(a + n == b for (a, n), (b, _) in zip(x, x[1:])) and x[0][0] == 0
        least = -(-sum(sizes) // 2048)
        assert least <= len(got) <= least + 1 + least // 50
        loads = [sum(x[2] for x in w) for w in got]
        assert not loads or max(loads) - min(loads) < 256


def test_the_window_count_rises_where_capacity_is_exceeded():
    # Two items of 4 at most fit into a window of 10, so twelve of them take more than the five that hold 49.
    assert len(windows([1] + [4] * 12, 10)) == 6
    for capacity in (1, 2, 3, 7, 10):
        for sizes in ([3] * 7, [capacity] * 5, [1, 2, 3, 4, 5, 6]):
            got = windows(sizes, capacity)
            assert all(0 < sum(x[2] for x in w) <= capacity for w in got) and sum(x[2] for w in got for x in w) == sum(sizes)


def test_rows_with_equal_and_null_ids(spark):
    rows = spark.createDataFrame([(None, "a b"), (4, "a b"), (4, "a b"), (4, None), (9, "c " * 3000)], "doc_id long, text string")
    packed = pack(rows, public_tokenizers.path(BYTE), end_id=1).collect()
    assert sum(r.length for r in packed) == sum(len(library(BYTE).encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows.collect())
    assert sorted(str(r.doc_id) for r in packed if r.doc_id != 9) == ["4", "4", "4", "None"]
    got = token_file_digest(rows, public_tokenizers.path(WORD), end_id=2, partitions=2).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 4, 4, 4, 9]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(5)]


def test_a_very_long_word_is_counted_in_time():
    own, lib = MergeCounter(public_tokenizers.path(BYTE)), library(BYTE)
    rng = random.Random(9)
    for alphabet in ("a", "ab", "the ", "abcdefghij\xe9"):
        for n in (190, 193, 1000, 60_000):
            word = "".join(rng.choice(alphabet) for _ in range(n)).replace(" ", "")
            assert own.count([word]).tolist() == [len(lib.encode(word, add_special_tokens=False).ids)]


def test_unknown_files_are_encoded_whole(tmp_path):
    import json

    spec = json.load(open(public_tokenizers.path(WORD), encoding="utf-8"))
    spec["normalizer"]["normalizers"].pop()  # it no longer lower-cases
    (tmp_path / "own.json").write_text(json.dumps(spec), encoding="utf-8")
    own, lib = Encoder(str(tmp_path / "own.json")), Tokenizer.from_file(str(tmp_path / "own.json"))
    assert own.kind == "whole"
    assert own.encode(["Ab Ab, c"])[0].tolist() == lib.encode("Ab Ab, c", add_special_tokens=False).ids


def test_packed_pieces(spark):
    lib, values = library(BYTE), texts()
    rows = pack(documents(spark).repartition(2), public_tokenizers.path(BYTE), end_id=1, with_ids=True).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, t in enumerate(values):
        ids = lib.encode(t or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids == ids[at : at + r.length] and r.ids_crc32 == crc(r.ids)
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert pack(documents(spark, []), public_tokenizers.path(BYTE), end_id=1).count() == 0
    assert np.mean([sum(r.length for r in p) for p in by_sequence.values()]) > 1500
