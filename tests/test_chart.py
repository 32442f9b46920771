"""Mentions in plain language."""

import pytest

from helixtext.operators import canon, chart

CASES = {
    "glycine to arginine at codon 12": "p|SUB|G|12|R",
    "arginine for glycine at position 12": "p|SUB|G|12|R",
    "serine instead of glycine at amino acid 99": "p|SUB|G|99|S",
    "valine substituted for glycine at residue 12": "p|SUB|G|12|V",
    "glycine replaced by valine at residue 12": "p|SUB|G|12|V",
    "methionine 129 valine": "p|SUB|M|129|V",
    "deletion of three bases at position 45": "c|DEL|45|3",
    "3 bp deletion at nucleotide 508": "c|DEL|508|3",
    "deletion of nucleotides 45 to 48": "c|DEL|45_48|",
    "insertion of alanine at codon 7": "p|INS|7|A",
    "G-to-A transition at nucleotide 20210": "c|SUB|G|20210|A",
    "adenine to guanine at nucleotide 1234": "c|SUB|A|1234|G",
    "stop codon for arginine at codon 55": "p|SUB|R|55|X",
    "arginine to stop codon at position 55": "p|SUB|R|55|X",
    "Gly 12 frameshift": "p|FS|G|12||",
    "aspartic acid to glutamic acid at position 614": "p|SUB|D|614|E",
}


@pytest.fixture(scope="module")
def read(spark):
    rows = [(m,) for m in [*CASES, "hello world", "12", "codon", "the", "glycine", "A134T", "", None, "to " * 200]]
    df = spark.createDataFrame(rows, "mention string").selectExpr("mention", "'' etype")
    return {r.mention: r for r in canon.canonicalise(df).collect()}


@pytest.mark.parametrize("mention", CASES)
def test_identifier(read, mention):
    assert read[mention].ident == CASES[mention]


def test_no_variant(read):
    for m in ("hello world", "12", "codon", "the", "glycine", "", "to " * 200):
        assert all(read[m].c[x] == "" for x in "tpwmfsdr"), m
    assert read["A134T"].ident == "p|SUB|A|134|T" or read["A134T"].ident == "c|SUB|A|134|T"


def test_found_in_text(spark):
    text = "The G12V form. A substitution of leucine by proline at residue 858 was seen; the patient went to codon 5 for help. Deletion of two amino acids at positions 3 to 4, and codon 61: glutamine to histidine."
    got = [(r.mention, text[r.start_off : r.end_off]) for r in chart.tag_phrases(spark.createDataFrame([("a", text), ("b", None), ("c", "")], "doc_id string, text string")).collect()]
    assert sorted(m for m, _ in got) == ["Deletion of two amino acids at positions 3 to 4", "codon 61: glutamine to histidine", "substitution of leucine by proline at residue 858"]
    assert all(a == b for a, b in got)


def test_work_grows_with_the_words(spark):
    import time

    long = "glycine to arginine " * 19
    rows = [(f"{long} {k}",) for k in range(300)]
    df = spark.createDataFrame(rows, "mention string").selectExpr("mention", "'' etype")
    start = time.time()
    assert canon.canonicalise(df).count() == 300
    assert time.time() - start < 20


def test_phrases_are_sought_around_numbers_only(spark):
    import re

    import pyarrow as pa

    from helixtext.operators import spans

    pattern = f"{spans.EDGE_L}(?:{chart.phrase_pattern()}){spans.EDGE_R}"
    far = "a glycine to arginine change " * 300
    texts = [*CASES, far, f"{far}codon 12{' ,:' * 2000}glycine to arginine{far}", " ".join(CASES), (far[:240] + "; ").join(CASES), *[f"{'x' * n} {m}{' ' * n}7" for n in (100, 255, 256, 257, 600) for m in CASES], "7" * 5000 + " glycine to arginine at codon " + "1" * 5000, "", None]

    def finder(**more):
        return [a for b in spans.span_finder(**more).func(iter([(pa.array(texts), pa.array([pattern] * len(texts)))])) for a in b.to_pylist()]

    got = finder(core=chart.PHRASE_CORE, around=chart.PHRASE_AROUND)
    assert got == finder() and sum(len(x or []) for x in got) > 90
    # what may be of any length in a phrase are numbers and the separators behind them
    parts = chart.phrase_pattern().replace("[0-9]+", "0").replace("[ ,:]+", " ")
    assert not re.search(r"(?<!\\)[+*{]", parts)


def test_texts_are_read_once(spark):
    docs = spark.createDataFrame([(str(i), f"We saw {m}. It ended.") for i, m in enumerate(CASES)], "doc_id string, text string")
    for rows in (chart.tag_phrases(docs), canon.variants_of(docs)):
        assert rows.count() >= 12 and "text#" not in rows._jdf.queryExecution().optimizedPlan().toString()
