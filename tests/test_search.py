"""Successors, gram index and fused words, against brute force."""

import random

from helixtext.operators import documents, normalize, spans


def test_successors(spark):
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randrange(1, 7)))
    keys, asked = sorted({word() for _ in range(120)} - {"é" * 6}), sorted({word() for _ in range(300)} | {"ééééééé"})
    make = lambda xs, n: spark.createDataFrame([(x,) for x in xs], "key string").repartition(n)
    want = {a: next((k for k in keys if k >= a), None) for a in asked}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert dict(map(tuple, spans.successors(make(keys, 3), make(asked, 2)).collect())) == want
        # all keys before, all behind
        assert dict(map(tuple, spans.successors(make(["a"], 1), make(["b", "c"], 1)).collect())) == {"b": None, "c": None}
        assert dict(map(tuple, spans.successors(make(["z"], 1), make(asked, 1)).collect()))["a"] == "z"
        assert spans.successors(make(keys, 1), make([], 1)).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_lookup_of_odd_mentions(spark):
    lexicon = spark.createDataFrame([("Alpha-Gene 1", "7"), ("alpha gene 12", None), ("...", "9"), (None, "8")], "name string, ident string")
    mentions = spark.createDataFrame([("alphagene1",), ("ALPHA gene 12",), ("alphagen",), ("alphagene2",), ("",), (None,), ("?",), ("alphagene1",)], "mention string")
    got = sorted((r.mention or "", r.status) for r in spans.lookup_mentions(mentions, lexicon).collect())
    assert got == sorted([("alphagene1", "7"), ("ALPHA gene 12", "-1"), ("alphagen", "-2"), ("alphagene2", "-3"), ("", "-3"), ("", "-3"), ("?", "-3"), ("alphagene1", "7")])


def test_containing(spark):
    rng = random.Random(2)
    forms = ["".join(rng.choice("ab|") for _ in range(rng.randrange(0, 9))) for _ in range(150)] + [None]
    needles = ["".join(rng.choice("ab|") for _ in range(rng.randrange(0, 6))) for _ in range(80)] + [None, "zzz", "é"]
    make = lambda xs, c: spark.createDataFrame([(x,) for x in xs], f"{c} string")
    got = sorted(tuple(r) for r in normalize.containing(normalize.gram_index(make(forms, "form")), make(needles, "needle")).collect())
    assert got == sorted({(n, f) for n in needles if n for f in forms if f and n in f})


def test_search_reads_its_own_postings(spark, tmp_path):
    forms = spark.createDataFrame([(f"p|SUB|{a}|{n}|{b}",) for a in "ACD" for b in "EFG" for n in range(50)], "form string")
    normalize.gram_index(forms).write.partitionBy("part").parquet(str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index"))
    # (a filter on the asking side lets the optimiser expect something of pruning)
    asked = spark.createDataFrame([("|A|17",), ("x",)], "needle string").where("needle <> 'x'")
    found = normalize.containing(stored, asked)
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_broken_words(spark):
    genes = spark.createDataFrame([("PTEN",), ("TP53",), ("TP",), ("K2",), (None,), ("B",)], "name string")
    words = ["PTENK289E", "K289EPTEN", "TP53R175H", "PTENK289ETP53R175H", "PTEN", "K289E", "XXK289E", "PTENxK289E", "TPR175fs", "", None, "K289E" * 30 + "PTEN"]
    got = {r.word: [(r.word[p.first : p.last], p.gene) for p in r.pieces] for r in documents.break_words(spark.createDataFrame([(w,) for w in words], "word string"), genes).collect()}
    assert got == {
        "PTENK289E": [("PTEN", True), ("K289E", False)],
        "K289EPTEN": [("K289E", False), ("PTEN", True)],
        "TP53R175H": [("TP53", True), ("R175H", False)],
        "PTENK289ETP53R175H": [("PTEN", True), ("K289E", False), ("TP53", True), ("R175H", False)],
        "TPR175fs": [("TP", True), ("R175fs", False)],
        "K289E" * 30 + "PTEN": [("K289E", False)] * 30 + [("PTEN", True)],
    }


def test_tokens_of_fused_words(spark):
    genes = spark.createDataFrame([("PTEN",)], "name string")
    docs = spark.createDataFrame([("a", "In PTENK289E cells, PTEN."), ("b", None), ("c", "")], "doc_id string, text string")
    got = [(r.tok_no, r.token) for r in documents.tokenize_fused(docs, genes).orderBy("tok_no").collect()]
    assert [t for _, t in got] == ["In", "PTEN", "K", "289", "E", "cells", ",", "P", "T", "E", "N", "."]
    assert [n for n, _ in got] == list(range(12))
