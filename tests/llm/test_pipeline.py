"""Stages of the pipeline against plain loops over their own input; none of these calls the operators' scoring, linking or packing."""

import math
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from helixtext.llm import common, langid, queries, toxicity

SF = "/root/testdata/sf0.001"


def recorded(monkeypatch, module):
    """What the module's ``train`` returns while a stage runs: the model is given, its use is what is tested."""
    seen, train = [], module.train

    def run(*args, **more):
        seen.append(train(*args, **more))
        return seen[-1]

    monkeypatch.setattr(module, "train", run)
    return seen


def word_ratio(word, m, rows):
    """Toxic less ordinary log-likelihood of a word, one character after another."""
    base = len(m.chars) + 2
    code = [0] * (toxicity.ORDER - 1) + [m.chars.index(c) + 2 if c in m.chars else 1 for c in word] + [0]
    total, h, row = 0.0, 0, rows[0]
    for k in range(len(word) + 1):
        gram = 0
        for c in code[k : k + toxicity.ORDER]:
            gram = gram * base + c
        logs = [float(m.tables[c, gram]) for c in (0, 1)]
        if row is not None and k < toxicity.LONGEST:
            h = ((h ^ (code[k + toxicity.ORDER - 1] + 1)) * 0x9E3779B97F4A7C15) % 2**64
            h ^= h >> 29
            next_row = rows.get(h)
            for c in (0, 1):
                seen = float(m.seen[c, row])
                if seen > 0:
                    n = float(m.seen[c, next_row]) if next_row is not None else 0.0
                    fall = (toxicity.DISCOUNT * float(m.follow[c, row]) + float(m.lost[c, row])) / seen
                    logs[c] = math.log(max(n - toxicity.DISCOUNT, 0) / seen + fall * math.exp(logs[c]))
            row = next_row
        total += logs[1] - logs[0]
    return total


def toxic_score(text, m, rows):
    words = [w for w in (w.strip(toxicity.MARKS) for w in (text or "").lower().split()) if w]
    x = [1.0] + [0.0] * (toxicity.TOP + 2)
    if words:
        ratios = [word_ratio(w, m, rows) for w in words]
        x[1] = sum(ratios) / sum(len(w) + 1 for w in words)
        means = sorted({np.float32(r) / max(len(w) + 1, toxicity.USUAL) for w, r in zip(words, ratios, strict=True)}, reverse=True)
        best = 0.0
        for k in range(toxicity.TOP):
            best = means[k] if k < len(means) else min(best, 0.0)
            x[2 + k] = float(best)
        x[-1] = math.log(len(words))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(x, m.curve, strict=True))))))


def byte_probabilities(raw, w):
    """One window of bytes through both directions, a byte at a time."""
    h_size = langid.HIDDEN

    def states(order, way):
        h, out = np.zeros(h_size), {}
        for i in order:
            e, r = w[f"e{way}"][raw[i]].astype(float), h @ w[f"u{way}"].astype(float)
            z = 1 / (1 + np.exp(-(e[:h_size] + r[:h_size])))
            reset = 1 / (1 + np.exp(-(e[h_size : 2 * h_size] + r[h_size : 2 * h_size])))
            h = z * h + (1 - z) * np.tanh(e[2 * h_size :] + reset * r[2 * h_size :])
            out[i] = h
        return out

    f, b = states(range(len(raw)), "f"), states(reversed(range(len(raw))), "b")
    out = []
    for i in range(len(raw)):
        p = np.exp(f[i] @ w["of"] + b[i] @ w["ob"] + w["c"])
        out.append(p / p.sum())
    return out


def language_of(text, network):
    if not any(map(str.isalpha, text or "")):
        return langid.UNKNOWN, 0.0
    found = []
    for word in text.split():
        raw = word.encode("utf-8", "replace")
        for k in range(0, len(raw), langid.WINDOW):
            found += byte_probabilities(raw[k : k + langid.WINDOW], network.weights)
    mean = np.mean(found, axis=0)
    return network.languages[int(mean.argmax())], float(mean.max())


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, n = re.findall(r"[^\x20\x09-\x0D]+", low), corpus_pipeline.SHINGLE
    return {tuple(words)} if 0 < len(words) < n else {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def smallest_of_groups(rows):
    """The ids that stay: every pair is compared, links are followed."""
    sets = [(i, shingles(t)) for i, t in rows]
    links = defaultdict(set)
    for a, (i, x) in enumerate(sets):
        for j, y in sets[a + 1 :]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                links[i].add(j)
                links[j].add(i)
    seen, stay = set(), []
    for i, _ in sorted(sets, key=lambda s: s[0]):
        if i not in seen:
            stay.append(i)
            todo = [i]
            while todo:
                seen.add(k := todo.pop())
                todo += links[k] - seen
    return stay


def packed(pieces, most):
    """First fit, longest first, by a walk over all bins."""
    bins, out = [], {}
    for p in sorted(pieces, key=lambda p: (-p.length, p.doc_id, p.start, p.ids_crc32)):
        at = next((k for k, used in enumerate(bins) if used + p.length <= most), len(bins))
        if at == len(bins):
            bins.append(0)
        out[p.doc_id, p.start] = at, bins[at]
        bins[at] += p.length
    return out


def documents(spark):
    return common.Scratch(spark).table(common.table(spark, SF, "documents"))


def test_toxicity_stage(spark, monkeypatch):
    sf = "/root/testdata/sf0.01"
    docs = common.table(spark, sf, "documents")
    seen = recorded(monkeypatch, toxicity)
    got = corpus_pipeline.drop_toxic(spark, docs, sf)
    kept = sorted(r.doc_id for r in got.select("doc_id").collect())
    (m,) = seen
    rows = {int(h): k for k, h in enumerate(m.beginnings)}
    scores = {r.doc_id: toxic_score(r.text, m, rows) for r in docs.select("doc_id", "text").collect()}
    sure = {i: s for i, s in scores.items() if abs(s - corpus_pipeline.TOXIC) > 1e-3}
    assert got.columns == docs.columns and len(sure) > 0.99 * len(scores)
    assert [i for i in kept if i in sure] == sorted(i for i, s in sure.items() if s < corpus_pipeline.TOXIC)
    assert 0 < len(kept) < len(scores)


def test_language_stage(spark, monkeypatch):
    plain = documents(spark).limit(60)
    more = spark.createDataFrame([(9001, None), (9002, ""), (9003, "12 34 !!"), (9004, "qx zzk wvvw")], "doc_id long, text string")
    docs = common.Scratch(spark).table(plain.unionByName(more, allowMissingColumns=True))
    seen = recorded(monkeypatch, langid)
    got = corpus_pipeline.drop_unknown_language(spark, docs, SF)
    kept = sorted(r.doc_id for r in got.select("doc_id").collect())
    (network,) = seen
    found = {r.doc_id: language_of(r.text, network) for r in docs.select("doc_id", "text").collect()}
    assert got.columns == docs.columns and all(abs(s - corpus_pipeline.SURE) > 1e-4 for _, s in found.values())
    assert kept == sorted(i for i, (lang, s) in found.items() if lang != langid.UNKNOWN and s >= corpus_pipeline.SURE)
    assert not {9001, 9002, 9003} & set(kept)
    # the same scores, position by position pooled, as the operator's
    for r in langid.predict(docs.select("doc_id", "text"), network).collect():
        assert r.lang_pred == found[r.doc_id][0] and abs(r.score - found[r.doc_id][1]) < 1e-4


def test_near_copies_stage(spark):
    docs = documents(spark)
    long = docs.where("length(text) > 300").orderBy("doc_id").limit(5)
    copies = long.withColumn("doc_id", F.col("doc_id") + 100_000).withColumn("text", F.concat(F.upper("text"), F.lit(" one more")))
    docs = common.Scratch(spark).table(docs.unionByName(copies))
    got = corpus_pipeline.drop_near_copies(spark, docs, SF)
    stay = smallest_of_groups([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert got.columns == docs.columns and sorted(r.doc_id for r in got.select("doc_id").collect()) == stay
    assert len(stay) <= docs.count() - 5


def test_personal_data_stage(spark):
    base = [
        ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("PHONE", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ]
    texts = ["write to a.b@c.org or +49 (151) 234-5678 now", "nothing here", "", None, "x@y.z " * 500]
    docs = spark.createDataFrame([(i, t, len(t or ""), 1.5) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int, score double")
    got = {r.doc_id: r for r in corpus_pipeline.redact(spark, docs, SF).collect()}
    for i, t in enumerate(texts):
        want = t
        for kind, pattern in base:
            want = None if want is None else re.sub(pattern, f"[{kind}]", want)
        assert got[i].text == want and got[i].score == 1.5 and got[i].n_chars == (None if want is None else len(want))


def test_packing_stage(spark):
    docs = documents(spark)
    tokens = Tokenizer.from_file(queries.tokenizer_path("byte_bpe_50k.json"))
    rows = corpus_pipeline.pack(spark, docs, SF).collect()
    lengths = {r.doc_id: len(tokens.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in docs.select("doc_id", "text").collect()}
    of = defaultdict(list)
    for r in rows:
        of[r.doc_id].append((r.start, r.length))
    assert set(of) == set(lengths)
    for i, n in lengths.items():
        assert sorted(of[i]) == [(a, min(1024, n - a)) for a in range(0, n, 1024)]
    groups = defaultdict(list)
    for r in rows:
        groups[r.sequence_id >> 32].append(r)
    for pieces in groups.values():
        want = packed(pieces, 1024)
        assert all((p.sequence_id % 2**32, p.offset) == want[p.doc_id, p.start] for p in pieces)


@pytest.fixture(scope="module")
def odd(spark):
    text = "hello there this is a plain text of some words that anyone can read"
    rows = [(1, None), (2, ""), (3, " \n "), (None, text), (2**53 + 1, text + " again"), (2**53 + 1, text + " again"), (5, "the cat sat on a mat " * 5000), (6, "12 !!")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name, value in [("lang", "en"), ("source", None), ("Score", 123.0), ("predicted", "mine"), ("lang_pred", "mine"), ("row_key", 7), ("component", "mine"), ("kept", "mine"), ("toxicity_features", "mine")]:
        docs = docs.withColumn(name, F.lit(value).cast("string") if value is None else F.lit(value))
    return docs


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_the_callers_columns(spark, odd, stage):
    out = stage(spark, odd, SF)
    assert out.columns == odd.columns and out.dtypes == odd.dtypes
    others = [c for c in odd.columns if c not in ("doc_id", "text")]
    found = out.select(*others).distinct().collect()
    assert found == odd.select(*others).distinct().collect()
    none = stage(spark, odd.limit(0), SF)
    assert none.columns == odd.columns and none.count() == 0


def test_odd_rows_by_stage(spark, odd):
    def ids(df):
        return sorted((r.doc_id is None, r.doc_id or 0) for r in df.select("doc_id").collect())

    known = [(False, i) for i in (1, 2, 3, 5, 6, 2**53 + 1, 2**53 + 1)] + [(True, 0)]
    assert ids(corpus_pipeline.drop_toxic(spark, odd, SF)) == known
    assert not {1, 2, 3, 6} & {i for _, i in ids(corpus_pipeline.drop_unknown_language(spark, odd, SF))}
    assert ids(corpus_pipeline.drop_near_copies(spark, odd, SF)) == [x for k, x in enumerate(known) if k != 6]
    assert ids(corpus_pipeline.redact(spark, odd, SF)) == known
    packed_rows = corpus_pipeline.pack(spark, odd, SF).collect()
    assert [r.length for r in packed_rows if r.doc_id in (1, 2)] == [1, 1] and any(r.doc_id is None for r in packed_rows)
    assert corpus_pipeline.pack(spark, odd.limit(0), SF).count() == 0
