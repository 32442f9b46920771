"""Nearest genes and species, against a loop over all pairs."""

import random
import re

import pytest

from helixtext.operators import associate

ANN = "ann_id long, doc_id string, sentence int, passage_no int, start_off int, end_off int"
GENE = "doc_id string, sentence int, passage_no int, start_off int, end_off int, gene string"


def rows(seed, n, longest):
    """ann, genes: sentences of 30 characters; spans may reach into the next ones."""
    rng = random.Random(seed)
    ann, genes = [], []
    for k in range(n):
        start, doc = rng.randrange(300), f"d{rng.randrange(9)}"
        end = start + rng.randrange(1, longest)
        if rng.random() < 0.5:
            ann.append((k, doc, start // 30, start // 100, start, end))
        else:
            genes.append((doc, start // 30, start // 100, start, end, rng.choice("abcdef")))
    return ann, genes + genes[:5]


def brute_sentence(ann, genes):
    out = []
    for i, doc, s, _, a, b in ann:
        found = []
        for d, t, _, c, e, gene in genes:
            if d != doc:
                continue
            over = c < b and a < e
            tier = 0 if t == s and not over else 1 if t == s - 1 else 2 if t == s + 1 else 3 if t == 0 else 4 if t < s else None
            if tier is not None:
                gap = max(c - b, a - e, 0)
                found.append((tier, -e if tier == 4 else gap, gene, gap))
        if found:
            tier, _, gene, gap = min(found)
            out.append((i, gene, gap + 1000 * tier, tier))
    return sorted(out)


@pytest.mark.parametrize(("seed", "n", "longest"), [(0, 60, 10), (1, 300, 8), (2, 300, 45), (3, 40, 80)])
def test_sentence_tiers(spark, seed, n, longest):
    ann, genes = rows(seed, n, longest)
    got = associate.nearest_gene_sentence(spark.createDataFrame(ann, ANN), spark.createDataFrame(genes, GENE))
    assert sorted(tuple(r) for r in got.collect()) == brute_sentence(ann, genes)


def brute_passage(ann, genes, texts):
    out = []
    for i, doc, _, p, a, b in ann:
        kind, text = texts[doc, p]
        offset = 100 * p
        m = re.search(r"\([^()]*$", text[: a - offset])
        bracket = offset + m.start() if m else a
        stop = re.search(r"[.!?]\s", text[max(0, b - offset) :])
        found = []
        for d, _, q, c, e, gene in genes:
            if (d, q) != (doc, p):
                continue
            if c >= b:
                if kind.lower() != "table" and (not stop or c <= b + stop.start() + 1):
                    found.append((c - b, gene))
            else:
                found.append((max(bracket - e, 0), gene))
        if found:
            out.append((i, min(found)[1], min(found)[0]))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_passages(spark, seed):
    ann, genes = rows(seed + 10, 300, 12)
    rng = random.Random(seed)
    texts = {(f"d{d}", p): (rng.choice(("body", "Table")), "".join(rng.choice("abc ().? ") if rng.random() < 0.2 else "x" for _ in range(130))) for d in range(9) for p in range(4)}
    passages = spark.createDataFrame([(d, p, k, t, 100 * p) for (d, p), (k, t) in texts.items()], "doc_id string, passage_no int, ptype string, text string, offset int")
    got = associate.nearest_in_passage(spark.createDataFrame(ann, ANN), spark.createDataFrame(genes, GENE), "gene", passages)
    assert sorted(tuple(r) for r in got.collect()) == brute_passage(ann, genes, texts)


def test_nothing_near(spark):
    ann, genes = spark.createDataFrame([(1, "a", 0, 0, 5, 9), (2, "b", None, 0, 5, 9)], ANN), spark.createDataFrame([("c", 0, 0, 1, 2, "g")], GENE)
    assert associate.nearest_gene_sentence(ann, genes).count() == 0
    assert associate.nearest_gene_sentence(ann.limit(0), genes).count() == 0
    passages = spark.createDataFrame([("a", 0, "body", None, 0)], "doc_id string, passage_no int, ptype string, text string, offset int")
    assert associate.nearest_in_passage(ann, genes, "gene", passages).count() == 0


def test_no_pairs_in_the_plan(spark):
    ann, genes = rows(1, 20, 8)
    plan = associate.nearest_gene_sentence(spark.createDataFrame(ann, ANN), spark.createDataFrame(genes, GENE))._jdf.queryExecution().optimizedPlan().toString()
    # mentions meet genes in windows; the two joins left are by block, for what touches, and one row a sentence
    assert plan.count("Join ") == 2 and plan.count("Window ") >= 4
