import os

import corpus_pipeline
from shoplark.llm.decontaminate import split_words
from shoplark.llm.queries import ORACLES, QUERIES

from .test_near_dup import brute as linked
from .test_text_rules import brute_counts

DATA = "/root/testdata/sf0.001"


def test_stages_act_on_what_is_left(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, left = docs.columns, docs
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = left
        path = f"/tmp/shoplark-pipeline-{os.getpid()}/{name}"
        stage(spark, left, DATA).write.mode("overwrite").parquet(path)
        left = spark.read.parquet(path)
        assert left.columns == columns
        assert left.join(before, columns, "left_anti").count() == 0
        kept[name] = {r.doc_id: r.text for r in left.collect()}
        assert len(kept[name]) == left.count() <= before.count()
    for text in kept["quality_rules"].values():
        n, *_, repeats = brute_counts(text)
        assert n >= 50 and 2 * repeats <= n
    ids = sorted(kept["quality_rules"])
    want = {ids[i] for i, _, _, first in linked([kept["quality_rules"][i] for i in ids]) if first}
    assert set(kept["near_dedup"]) == want
    windows = set()
    for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect():
        words = split_words(r.text.encode())
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))}
    clean = {i for i, t in kept["near_dedup"].items() if not windows & {tuple(w[k : k + m]) for w in [split_words(t.encode())] for m in {len(x) for x in windows} for k in range(len(w) - m + 1)}}
    assert set(kept["decontamination"]) == clean
    pieces = corpus_pipeline.STAGES[-1][1](spark, left, DATA).collect()
    assert {r.doc_id for r in pieces} == clean
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())


def test_every_operator_has_one_query():
    assert [sum(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 11)] == [1] * 10
    assert set(ORACLES) <= set(QUERIES)


def test_texts_under_one_id_are_documents_of_their_own(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(7, a), (7, b), (7, b), (3, b + " more"), (9, c), (9, "few"), (9, "few"), (None, a)]
    got = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), DATA).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(7, a), (3, b + " more"), (9, c), (9, "few"), (None, a)], key=str)


def test_stages_take_odd_documents_and_empty_tables(spark):
    prose = " ".join(f"word{i}" for i in range(80))
    rows = [(1, prose, "en", "s", 9, "x"), (1, prose, "en", "s", 9, "x"), (2, None, None, None, None, None), (None, prose + " more", "xx", "s", 9, "x"), (3, "", "en", "s", 0, "x"), (4, " ".join(f"other{i % 700}" for i in range(40_000)), "en", "s", 9, "x")]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, f"{names}, row string")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns, name
        kept = sorted(str(r.doc_id) for r in out.collect())
        assert kept == {"quality_rules": kept, "near_dedup": ["1", "2", "3", "4", "None"], "decontamination": ["1", "1", "2", "3", "4", "None"]}[name]
        assert name != "quality_rules" or not {"2", "3"} & set(kept)
    assert {r.doc_id for r in corpus_pipeline.packing(spark, docs, DATA).collect()} == {1, 2, 3, 4, None}
    empty = spark.createDataFrame([], f"{names}, row string")
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, empty, DATA).count() == 0, name
