"""Layouts of mentions, against masked text that is searched by one expression for each layout."""

import random
import re

from helixtext.operators import layouts

GAPS = [" (", "(", ") (", ")[", ", ", "; ", " ,; ", " with ", " polymorphism (", " Polymorphism [", ", protein ", " gene ", ": dbSNP ID: ", " dbSNP ", "), dbSNP ", ") (dbSNP ", " (dbSNP ", " 5'UTR (", " 3'UTR(", " polymorphism in exon 3 (", " polymorphism in intron 12(", " and ", " or ", " x ", "", " "]
EDGES = ["(", "[ ", " ", "x", ")"]
BEHIND = [")", " ]", "A", ", ", "; ", " foo ", ""]


def document(rng):
    """text, mentions (start, end, kind)."""
    text, mentions = "", []
    for _ in range(rng.randrange(2, 9)):
        text += rng.choice(EDGES + BEHIND) if rng.random() < 0.4 else ""
        row = rng.choice(layouts.table()) if rng.random() < 0.7 else None
        text += "[ " if row and row[0] else ""
        for k in range(len(row[1]) if row else rng.randrange(1, 4)):
            if k:
                fits = [g for g in GAPS if row and re.fullmatch(layouts.GAPS[row[2][k - 1]], g)]
                text += rng.choice(fits or GAPS)
            kind = row[1][k] if row else rng.choice("PDS")
            size = rng.choice((3, 5) if row else (2, 3, 5))
            # a letter of each mention's own, so that neighbours don't run together
            mentions.append((len(text), len(text) + size, kind))
            text += "é" * size
        text += rng.choice([x for x in BEHIND if not row or not row[3] or re.match(layouts.AFTER[row[3]], x)]) + rng.choice((" . ", ""))
    return text, mentions


def brute(text, mentions):
    """(row, first) pairs, in the order of the table; what is found is masked."""
    found = []
    masked = list(text)
    for start, end, kind in mentions:
        masked[start:end] = kind * (end - start)
    masked = "".join(masked)
    ends = {start: end for start, end, _ in mentions}
    index = {start: i for i, (start, _, _) in enumerate(mentions)}
    for row, (before, kinds, gaps, after) in enumerate(layouts.table()):
        pattern = f"(?:{layouts.BEFORE[before].rstrip('$')})" if before else ""
        for k, t in enumerate(kinds):
            pattern += f"({t}{{3,}})" + (f"(?:{layouts.GAPS[gaps[k]]})" if k < len(gaps) else "")
        pattern += f"(?:{layouts.AFTER[after]})" if after else ""
        at = 0
        while m := re.compile(pattern).search(masked, at):
            groups = [m.span(k + 1) for k in range(len(kinds))]
            if all(ends.get(a) == b for a, b in groups):
                found.append((row, index[groups[0][0]], len(kinds)))
                masked = masked[: m.start()] + "F" * (m.end() - m.start()) + masked[m.end() :]
                at = 0
            else:
                at = m.start() + 1
    return sorted(found)


def test_equal_to_a_search_in_masked_text(spark):
    rng = random.Random(1)
    docs, ann, want = [], [], []
    for d in range(1500):
        text, mentions = document(rng)
        # mentions that touch would be one run in masked text
        if any(a[1] == b[0] for a, b in zip(mentions, mentions[1:], strict=False)):
            continue
        docs.append((str(d), text))
        kinds = {"P": "ProteinMutation", "D": "DNAAllele", "S": "SNP"}
        ann += [(str(d), a, b, d * 100 + i, kinds[k], f"rs{d}" if k == "S" else f"{k}{i}") for i, (a, b, k) in enumerate(mentions)]
        want += [(str(d), row, d * 100 + first, n) for row, first, n in brute(text, mentions)]
    found = layouts.find_layouts(spark.createDataFrame(ann, "doc_id string, start_off int, end_off int, ann_id long, etype string, ident string"), spark.createDataFrame(docs, "doc_id string, text string"))
    got = sorted((r.doc_id, r.layout, r.members[0].ann_id, len(r.members)) for r in found.collect())
    assert len({w[1] for w in want}) > 45
    assert got == sorted(want)


def test_rs_for_all_mentions_of_an_identifier(spark):
    text = "c.1A>G (p.K1E, rs77) and again c.1A>G; (p.K9E or rs5)"
    rows = [("a", text.index(m, k), text.index(m, k) + len(m), n, t, i) for n, (m, k, t, i) in enumerate([("c.1A>G", 0, "DNAMutation", "c|1"), ("p.K1E", 0, "ProteinMutation", "p|1"), ("rs77", 0, "SNP", "rs77"), ("c.1A>G", 9, "DNAMutation", "c|1"), ("p.K9E", 0, "ProteinMutation", "p|9"), ("rs5", 0, "SNP", "rs5")])]
    ann = spark.createDataFrame(rows, "doc_id string, start_off int, end_off int, ann_id long, etype string, ident string")
    docs = spark.createDataFrame([("a", text), ("b", None)], "doc_id string, text string")
    found = layouts.find_layouts(ann, docs)
    # DPS is no layout, but (P, S) is one
    assert sorted(tuple(r) for r in layouts.layout_rs(found, ann).collect()) == [(1, 77, "Pattern")]
    assert [tuple(r) for r in layouts.layout_links(found).collect()] == [("a", 1, 2)]
    # the same with the types in an order that is a layout
    other = text.replace("c.1A>G (p.K1E, rs77)", "p.K1E (c.1A>G, rs77)")
    rows = [("a", 7, 13, 0, "DNAMutation", "c|1"), ("a", 0, 5, 1, "ProteinMutation", "p|1"), ("a", 15, 19, 2, "SNP", "rs77"), ("a", 31, 37, 3, "DNAMutation", "c|1")]
    ann = spark.createDataFrame(rows, "doc_id string, start_off int, end_off int, ann_id long, etype string, ident string")
    found = layouts.find_layouts(ann, spark.createDataFrame([("a", other)], "doc_id string, text string"))
    assert sorted(tuple(r) for r in layouts.layout_rs(found, ann).collect()) == [(0, 77, "Pattern"), (1, 77, "Pattern"), (3, 77, "Pattern")]
    assert layouts.find_layouts(ann.limit(0), spark.createDataFrame([("a", other)], "doc_id string, text string")).count() == 0
