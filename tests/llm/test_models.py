"""Classifiers: held-out accuracy, gradients, and defined results of odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixtext.llm import common, langid, queries, toxicity

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def odd(spark):
    common.package_to_executors(spark)
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \n ", "fr", None), (None, "a b c d e f", "en", "b"), (2**53 + 1, "Hello there this is a text", "en", "c"), (2**53 + 1, "Hello there this is a text", "en", "c"), (5, "x " * 20000, "de", ""), (6, "bonjour le monde est ici", "fr", ""), (7, "12 34 !!", None, "")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_language_on_held_out_documents(spark):
    out = queries.op3_language(spark, SF)
    truth = common.table(spark, SF, "documents").select("doc_id", "lang")
    r = out.where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.count("*").alias("n")).first()
    assert r["n"] > 150 and r["right"] > 0.97


def test_language_of_odd_rows(spark, odd):
    net = langid.train(spark, odd, steps=3)
    out = langid.predict(odd, net)
    assert out.columns == ["doc_id", "lang", "lang_pred", "score"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert out.count() == 9 and got[1] == got[2] == got[3] == got[7] == ("und", 0.0)
    assert all(0 <= s <= 1 for _, s in got.values()) and 2**53 + 1 in got
    assert langid.predict(odd.limit(0), net).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, langid.train(spark, odd.limit(0))).collect()} == {"und"}


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in langid.start(3).items()}
    x, lengths = langid.windows([b"abc", b"de", b"f"])
    y = np.array([0, 2, 1])
    _, g = langid.gradients(x[:, :3], lengths, y, w)
    for k in w:
        for _ in range(3):
            at = tuple(rng.integers(0, n) for n in w[k].shape)
            if k[0] == "e":
                at = (rng.choice([97, 98, 99, 100]), at[1])
            old, d = w[k][at], 1e-3
            w[k][at] = old + d
            up = langid.gradients(x[:, :3], lengths, y, w)[0]
            w[k][at] = old - d
            down = langid.gradients(x[:, :3], lengths, y, w)[0]
            w[k][at] = old
            assert abs((up - down) / (2 * d) - g[k][at]) < 1e-3


def test_equal_words_get_equal_sums_whatever_the_batch():
    w = langid.start(4)
    words = ["the", "a", "x" * 100, "été", "the"]
    many = langid.word_sums(words, w)
    alone = np.stack([langid.word_sums([x], w)[0] for x in words])
    assert np.allclose(many, alone, atol=1e-4) and many[2, -1] == 100 and many[3, -1] == len("été".encode())


def test_toxicity_on_held_out_documents(spark):
    out = queries.op8_toxicity(spark, "/root/testdata/sf0.1")
    labels = common.table(spark, "/root/testdata/sf0.1", "labels")
    r = out.where("held_out").join(labels, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("p"), F.avg("score").alias("s")).collect()
    by = {x["toxic"]: x for x in r}
    assert by[0]["p"] < 0.02 and by[1]["p"] > 0.8
    assert out.where("score < 0 or score > 1 or score is null").count() == 0
    assert out.where("(score >= 0.3) <> (predicted = 1)").count() == 0


def test_toxicity_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(2**53 + 1, 0), (6, 1), (5, 0), (None, 1), (2, None)], "doc_id long, toxic int")
    out = toxicity.score(odd, toxicity.train(spark, odd, labels))
    assert out.count() == 9 and out.columns == ["doc_id", "lang", "score", "predicted"]
    none = toxicity.score(odd, toxicity.train(spark, odd, labels.limit(0)))
    assert {(r.score, r.predicted) for r in none.collect()} == {(0.0, 0)}


def test_toxicity_counts_all_labelled_documents_but_the_curves(spark):
    texts = [f"plain words number{i} stay" for i in range(300)] + [f"foul things number{i} go" for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") >= 300).cast("int").alias("toxic"))
    model = toxicity.train(spark, docs, labels, most=20)
    # four words a document; of 600 documents at most 20 a class are the curve's
    assert model.seen[:, model.beginnings == 0].ravel().tolist() == [4 * 280, 4 * 280]
    rows = [("plain", 0, 280), ("foul", 1, 280), ("a" * 15, 0, 3), ("ab", 1, 1)]
    words = spark.createDataFrame(rows, "word string, toxic int, n long").repartition(3)
    chars = "".join(sorted(set("".join(w for w, _, _ in rows))))
    got = toxicity.count(words, chars, [283, 281], common.Scratch(spark))
    code, starts, lengths = toxicity.codes([w for w, _, _ in rows], chars)
    h = np.zeros(len(rows), np.uint64)
    for k in range(1, 4):  # each word's first letters
        live = [i for i, (w, _, _) in enumerate(rows) if len(w) + 1 >= k]
        h[live] = toxicity.beginnings(code, starts[live], lengths[live], k, h[live])
        for i in live:
            alike = [r for r in rows if (r[0] + "\x00")[:k] == (rows[i][0] + "\x00")[:k]]
            if sum(n for _, _, n in alike) >= 2:
                assert got.seen[:, got.beginnings == h[i]].ravel().tolist() == [sum(n for _, t, n in alike if t == c) for c in (0, 1)]
    assert got.follow[:, got.beginnings == 0].ravel().tolist() == [2, 2]


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(1)
    base = 5
    counts = rng.poisson(0.1, (2, base**toxicity.ORDER)).astype(float)
    logs = toxicity.kneser_ney(counts)
    assert np.allclose(np.exp(logs).reshape(2, -1, base).sum(2), 1)


def plain_kneser_ney(rows):
    """The same models over dictionaries: the log-probability of each character of a word in each class, one by one."""
    from collections import defaultdict

    n = [defaultdict(int), defaultdict(int)]
    beginnings, grams, order = set(), [defaultdict(set), defaultdict(set)], toxicity.ORDER
    late = [defaultdict(int), defaultdict(int)]
    for word, toxic, count in rows:
        whole = word + "\0"
        for k in range(len(whole)):
            gram = ("\0" * (order - 1) + whole)[k : k + order]
            if k < toxicity.LONGEST:
                n[toxic][whole[: k + 1]] += count
                beginnings.add(whole[: k + 1])
                grams[toxic][gram].add(whole[: k + 1])
            else:
                late[toxic][gram] += 1
    counts = [{g: len(grams[c][g]) + late[c][g] for g in {*grams[c], *late[c]}} for c in (0, 1)]
    seen = {*counts[0], *counts[1]}
    kept = {b for b in beginnings if n[0][b] + n[1][b] >= 2}
    chars = sorted({c for w, _, _ in rows for c in w})
    base, d = len(chars) + 2, toxicity.DISCOUNT

    def discounted(table, context, char, lower):
        total = sum(v for g, v in table.items() if g[:-1] == context)
        follow = sum(g[:-1] == context and v > 0 for g, v in table.items())
        return lower if not total else max(table.get(context + char, 0) - d, 0) / total + d * follow / total * lower

    def gram_probability(c, gram):
        p = 1 / base
        for k in range(1, order):
            before = {}
            for g in seen:
                before.setdefault(g[-k:], set()).add(g[-k - 1 :])
            p = discounted({g: len(v) for g, v in before.items()}, gram[-k:-1] if k > 1 else "", gram[-1], p)
        return discounted(counts[c], gram[:-1], gram[-1], p)

    def probability(c, begun, char):
        gram = ("\0" * (order - 1) + begun + char)[-order:]
        p = gram_probability(c, gram)
        total = n[c][begun] if begun else sum(count for _, t, count in rows if t == c)
        if len(begun) >= toxicity.LONGEST or begun and begun not in kept or not total:
            return p
        children = [b for b in beginnings if b[:-1] == begun]
        fall = sum(d * (n[c][b] > 0) if b in kept else n[c][b] for b in children)
        own = max(n[c][begun + char] - d, 0) if begun + char in kept else 0
        return own / total + fall / total * p

    return "".join(chars), probability


def test_word_scores_equal_plain_dictionaries(spark):
    rows = [("plain", 0, 9), ("plane", 0, 1), ("foul", 1, 4), ("four", 0, 2), ("a" * 15, 0, 3), ("ab", 1, 1), ("foul", 0, 1)]
    chars, probability = plain_kneser_ney(rows)
    totals = [sum(n for _, t, n in rows if t == c) for c in (0, 1)]
    model = toxicity.count(spark.createDataFrame(rows, "word string, toxic int, n long").repartition(3), chars, totals, common.Scratch(spark))
    words = ["plain", "foul", "fo", "abba", "a" * 14, "lane", "x"]
    got = toxicity.word_ratios(words, model)
    for word, (ratio, length) in zip(words, got, strict=True):
        whole = word.replace("x", "\1") + "\0"
        want = sum(np.log(probability(1, whole[:k], whole[k])) - np.log(probability(0, whole[:k], whole[k])) for k in range(len(whole)))
        assert length == len(word) + 1 and abs(ratio - want) < 1e-4, word
    # all characters after a beginning together have probability one, the rare ones included
    for begun in ("", "pla", "plan", "fo"):
        for c in (0, 1):
            assert abs(sum(probability(c, begun, x) for x in [*chars, "\0", "\1"]) - 1) < 1e-9


def test_bounded_sample_is_bounded_and_fixed(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("by"))
    one = common.bounded_sample(df, "doc_id", "by", 100)
    again = common.bounded_sample(df.repartition(7), "doc_id", "by", 100)
    assert one.count() == 200 and sorted(one.collect()) == sorted(again.collect())


def test_stored_beginnings_count_like_held_ones(spark, monkeypatch):
    """However few beginnings tasks hold, every document gets the same score."""
    sf = "/root/testdata/sf0.01"
    docs, labels = common.table(spark, sf, "documents").select("doc_id", "text"), common.table(spark, sf, "labels")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "never seen zqxjkv zqxjkv"), (-3, "never seen zqxjkv zqxjkv")], "doc_id long, text string")
    got, models = [], []
    for most in (toxicity.BEGINNINGS, 300):
        monkeypatch.setattr(toxicity, "BEGINNINGS", most)
        monkeypatch.setattr(toxicity, "BUCKET", 1000)
        models.append(toxicity.train(spark, docs, labels))
        got.append(sorted((r.doc_id, r.score) for r in toxicity.score(docs.unionByName(odd), models[-1]).collect()))
    assert len(models[0].beginnings) > 5000 > len(models[1].beginnings)
    assert got[0] == got[1] and len(got[0]) == docs.count() + 4
    assert models[0].curve.tolist() == models[1].curve.tolist()
