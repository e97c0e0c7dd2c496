import random
import re

import numpy as np

from shoplark.llm import near_dup
from shoplark.llm.near_dup import estimate, near_duplicates, registers, search, shingle_sets

from .cases import documents, texts

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(values):
    sets = []
    for t in values:
        w = re.findall("[^\\x20\\x09-\\x0D]+", (t or "").translate(LOWER))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    comp = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 75 * len(sets[i] | sets[j]):
                a, b = comp[i], comp[j]
                comp = [min(a, b) if c in (a, b) else c for c in comp]
    return [(i, len(s), c, i == c) for i, (s, c) in enumerate(zip(sets, comp))]


def near_copies(rng, count, group):
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 7)))
    passage = [word() for _ in range(40)]
    out = []
    for _ in range(count):
        base = [word() for _ in range(rng.choice([5, 6, 8, 12, 30, 80, 200]))]
        if rng.random() < 0.5:
            base = passage + base
        for _ in range(rng.randint(1, group)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            out.append(" ".join(copy) if rng.random() < 0.8 else " ".join(copy).upper() + "\n")
    return out


def test_links_equal_brute_force(spark):
    rng = random.Random(11)
    long = [t for t in texts() if t and len(t) >= 50_000]
    values = texts() + [long[0] + " one more", long[0].upper()] + near_copies(rng, 120, 5) + near_copies(rng, 4, 60)
    got = sorted(map(tuple, near_duplicates(documents(spark, values)).collect()))
    assert got == brute(values)
    assert sum(not r[3] for r in got) > 150


def test_small_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 3)
    monkeypatch.setattr(near_dup, "SET_BYTES", 600)
    values = near_copies(random.Random(4), 12, 9)
    assert sorted(map(tuple, near_duplicates(documents(spark, values)).collect())) == brute(values)


def test_search_compares_what_it_parts():
    rng = np.random.default_rng(5)
    for n in (1, 2, 30):
        for density in (0.02, 0.1, 0.5):
            matrix = np.triu(rng.random((n, n)) < density, 1)
            matrix |= matrix.T
            comp = np.arange(n)
            for a, others in search(n, lambda i, x: matrix[i, x]):
                for b in others:
                    assert matrix[a, b]
                    comp[comp == comp[b]] = comp[a]
            a, b = np.nonzero(matrix)
            assert (comp[a] == comp[b]).all()


def test_null_ids_repeats_and_empty_table(spark):
    text = "one two three four five six seven eight"
    rows = spark.createDataFrame([(None, text), (5, text), (5, text), (7, text + " nine"), (8, None), (9, "")], "doc_id long, text string")
    got = sorted(map(tuple, near_duplicates(rows).collect()), key=str)
    assert got == sorted([(None, 4, None, True), (5, 4, 5, True), (5, 4, 5, True), (7, 5, 5, False), (8, 0, 8, True), (9, 0, 9, True)], key=str)
    assert near_duplicates(rows.limit(0)).count() == 0


def test_rows_that_share_an_id_are_one_node(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (9, b), (9, ""), (11, b + " more"), (12, c), (13, ""), (14, c), (14, a + " more")]
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(3, 3), (5, 3), (9, 3), (11, 3), (12, 3), (13, 13), (14, 3)}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_more_ids_than_the_map_is_good_for(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "MOST_BITS", 1 << 6)
    monkeypatch.setattr(near_dup, "LEAST_BITS", 1 << 6)
    monkeypatch.setattr(near_dup, "SET_ROWS", 4)
    values = near_copies(random.Random(5), 12, 9)
    assert sorted(map(tuple, near_duplicates(documents(spark, values)).collect())) == brute(values)


def test_estimates_are_near_the_truth():
    rng = np.random.default_rng(1)
    for truth in (0.0, 0.5, 0.75, 0.9):
        n = 3000
        common = rng.integers(0, 2**63, int(n * truth), dtype=np.uint64)
        own = [np.unique(np.concatenate([common, rng.integers(0, 2**63, (n - len(common)) // 2, dtype=np.uint64)])) for _ in range(2)]
        spread = [np.sort(near_dup.mix64(x)) for x in own]
        value, error = estimate(*(registers(x)[None] for x in spread), *map(len, spread))
        assert abs(value[0] - truth) < 4 * error[0] + 0.01
    assert [len(x) for x in shingle_sets([b"", b"a", b"a b c d e", b"a b c d e f", b"A a a a a a a a"])] == [0, 1, 1, 2, 1]
