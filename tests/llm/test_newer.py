"""Chat formatting, whitening and phrase mining, against brute force."""

import collections
import hashlib
import json
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helixtext.llm import chat, common, phrases, queries, whitening

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", ["op11_chat_format", "op13_phrases"])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF).select(*want.columns)
    assert rows_of(got) == sorted(want.fetchall())


# chat

LAYOUTS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}], "id": 3}, [("user", "a"), ("assistant", "b")]),
    ({"system": "s", "messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "image"}, {"type": "text", "text": "c"}]}]}, [("system", "s"), ("user", "ac")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "tool", "value": "c"}]}, [("user", "a"), ("assistant", "b"), ("tool", "c")]),
    ({"instruction": "do", "input": "it", "output": "done", "history": [["q", "r"]]}, [("user", "q"), ("assistant", "r"), ("user", "do\n\nit"), ("assistant", "done")]),
    ({"instruction": "do", "input": "", "output": ""}, [("user", "do"), ("assistant", "")]),
    ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    ({"prompt": "p", "response": "c", "meta": {"deep": [{"x": 1.5}]}}, [("user", "p"), ("assistant", "c")]),
    ({"question": "q", "answer": "a", "context": "k"}, [("user", "k\n\nq"), ("assistant", "a")]),
    ({"role": "user", "content": "x"}, [("user", "x")]),
    ({"text": "only"}, [("", "only")]),
    ({"unknown": 1}, []),
    ({"messages.role": "user", "messages[].content": "a"}, []),
]


@pytest.mark.parametrize(("record", "want"), LAYOUTS)
def test_layouts(record, want):
    assert (lambda m: m.turns(record) if m else [])(chat.Layouts(chat.MAPPINGS).of(record)[1]) == want


def test_fingerprints_tell_schemas_not_values():
    f = lambda r: chat.Layouts(chat.MAPPINGS).of(r)[0]
    assert f({"prompt": "a", "completion": "b"}) == f({"completion": "z", "prompt": "y", "none": None})
    assert f({"prompt": "a"}) != f({"prompt": 1})
    assert f({"a": {"b": 1}}) != f({"a.b": 1})


texts = st.text(st.sampled_from("<|\\>nim_startend\n é"), max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(texts, texts), max_size=6))
def test_formatted_text_reads_back(turns):
    whole = "".join(f"{chat.START}{chat.escape_role(r)}\n{chat.escape(t)}{chat.END}" for r, t in turns)
    assert list(chat.read_back(whole)) == turns
    assert whole.count("<|") == 2 * len(turns)


def brute_digests(rows):
    """rows: conv_id, role, text in order."""
    out = {}
    for conv, role, text in rows:
        out.setdefault(conv, []).append((role or "", text or ""))
    found = []
    for conv, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        chars = sum(len("<|im_start|>\n<|im_end|>\n") + len(r.replace("\\", "\\\\").replace("\n", "\\n")) + len(t) + len(re.findall(r"<\\*\|", t)) for r, t in turns)
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        found.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    return sorted(found)


def test_long_conversation_over_many_ranges(spark):
    common.package_to_executors(spark)
    rng = np.random.default_rng(3)
    rows = [(7, k, ("user", "assistant")[k % 2], "<|" * int(rng.integers(0, 40)) + f" turn {k}") for k in range(3000)]
    rows += [(int(c), k, "assistant", "x\\" * k) for c in range(60) for k in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    records = df.select("conv_id", "turn", F.struct("role", "text").alias("record"), F.lit(1).alias("seq"), F.lit("clash").alias("mask"))
    want = brute_digests([(c, r, t) for c, _, r, t in rows if c != 7])
    for part in (40, 1 << 18):
        parts = chat.formatted(chat.canonical(records), part)
        got = {r[0]: tuple(r) for r in chat.digests(parts).collect()}
        assert [got[c[0]] for c in want] == want
        assert len(got) == 60 and got[7][1] == 3003
    only = records.where("conv_id = 7 and turn > 2")
    want = brute_digests([(c, r, t) for c, k, r, t in rows if c == 7 and k > 2])
    parts = chat.formatted(chat.canonical(only), 1000)
    assert parts.where("whole").count() == 0 and parts.count() > 20
    assert rows_of(chat.digests(parts)) == want


def test_odd_records(spark):
    common.package_to_executors(spark)
    deep = "[" * 100_000
    rows = [(1, 0, None), (1, 1, "{"), (1, 2, deep), (2, None, json.dumps({"text": None, "role": "user"})), (2, 0, json.dumps({"text": "\ud800x", "role": "assistant"})), (None, 1, json.dumps({"prompt": "p" * 300_000, "completion": "c"})), (3, 0, json.dumps({"x": 1})), (4, 0, json.dumps({"text": "same"})), (4, 0, json.dumps({"text": "same"}))]
    records = spark.createDataFrame(rows, "conv_id long, turn long, record string")
    got = {r["conv_id"]: tuple(r)[1:] for r in chat.digests(chat.formatted(chat.canonical(records))).collect()}
    assert set(got) == {2, None, 4}
    assert got[2] == brute_digests([(2, "user", ""), (2, "assistant", "�x")])[0][1:]
    assert got[None] == brute_digests([(0, "user", "p" * 300_000), (0, "assistant", "c")])[0][1:]
    assert got[4] == brute_digests([(4, "", "same"), (4, "", "same")])[0][1:]
    counts = {(r["layout"], tuple(r["paths"])): r["n"] for r in chat.layouts(records).collect()}
    assert counts[None, ("x:number",)] == 1 and counts["turn", ("text:string",)] == 2 and counts[None, ()] == 3
    assert chat.digests(chat.formatted(chat.canonical(records.limit(0)))).count() == 0


# whitening


def test_factorisation():
    rng = np.random.default_rng(1)
    for d, rank in ((1, 1), (5, 5), (12, 7), (30, 30)):
        b = rng.normal(size=(d, rank)) * 10 ** rng.uniform(-2, 2, rank)
        a = b @ b.T
        factor, order = whitening.pivoted_cholesky(a)
        assert factor.shape[1] == rank
        assert np.allclose(factor @ factor.T, a[order][:, order], rtol=0, atol=1e-12 * np.abs(a).max())
        assert np.allclose(np.triu(factor, 1), 0)
        values, vectors = whitening.components(a)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-9)
        assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-12)
        assert np.allclose(a @ vectors, vectors * values, atol=1e-11 * values[0])
    assert whitening.pivoted_cholesky(np.zeros((3, 3)))[0].shape == (3, 0)


def test_every_pair_meets_once():
    for n in (2, 3, 7, 8):
        met = [p for i, j in whitening.rounds(n) for p in zip(i.tolist(), j.tolist(), strict=True)]
        assert sorted(met) == [(a, b) for a in range(n) for b in range(a + 1, n)]


def brute_whitening(rows):
    good = [(i, [int(np.floor(256 * np.float64(c))) for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in good)
    good = [(i, v + [0] * (width - len(v))) for i, v in good]
    fit = np.array(sorted({tuple(v) for _, v in good}), dtype=object)
    n, s = len(fit), [int(c) for c in fit.sum(axis=0)]
    off = np.array([[n * a - b for a, b in zip(v, s, strict=True)] for v in fit], float) / n
    values, axes = np.linalg.eigh(off.T @ off / n)
    values, axes = values[::-1], axes[:, ::-1]
    return good, n, s, values, axes


def test_whitening_equals_brute_force(spark):
    common.package_to_executors(spark)
    rng = np.random.default_rng(2)
    rows = [(k, (rng.normal(size=6) * [3, 2, 1.5, 1, 0.7, 0.5] + 100).tolist()) for k in range(300)]
    rows += [(k, rows[0][1]) for k in range(1000, 1400)]
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 6), (2003, [float("-inf")] * 6), (2004, [-0.0, 1.0]), (2005, []), (None, [2.0] * 6), (3, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit("clash")).withColumn("n", F.lit(0)).repartition(5)
    good, n, s, values, axes = brute_whitening(rows)
    got = whitening.whiten(df).collect()
    assert len(got) == 4 * len(good)
    assert {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] < 1e-9
    by = collections.defaultdict(list)
    for r in got:
        by[r["vec_id"]].append(r)
    sign = {}
    for i, v in good:
        far = sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True))
        off = np.array([n * a - b for a, b in zip(v, s, strict=True)], float) / n
        for r in (r for r in by[i] if r["deviation"] == far):
            k = r["component"] - 1
            want = off @ axes[:, k] / np.sqrt(values[k])
            if abs(want) > 1e-3:
                sign.setdefault(k, np.sign(want) * np.sign(r["whitened"]))
            assert abs(r["whitened"] - want * sign.get(k, 1)) < 1e-8
            assert abs(r["explained"] / (values[k] / values.sum()) - 1) < 1e-9
        assert far in {r["deviation"] for r in by[i]}


def test_whitening_of_few_and_large(spark):
    common.package_to_executors(spark)
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whiten(make([(1, None)])).count() == 0
    assert whitening.whiten(make([(1, [0.5, 2.0]), (2, [0.5, 2.0])])).count() == 0
    one = whitening.whiten(make([(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [1.0, 1.0])])).orderBy("vec_id").collect()
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"], abs(round(r["whitened"], 9)), r["explained"]) for r in one] == [(1, 1, 2, 65536, 1.0, 1.0), (2, 1, 2, 65536, 1.0, 1.0), (3, 1, 2, 65536, 1.0, 1.0)]
    large = whitening.whiten(make([(1, [1e15]), (2, [-1e15]), (3, [0.0])])).orderBy("vec_id").collect()
    assert [r["deviation"] for r in large] == [whitening.LARGEST, whitening.LARGEST, 0]
    assert large[0]["identity_error"] < 1e-9


# phrases


def brute_counts(rows, n):
    out = collections.Counter()
    for lang, text in rows:
        low = (text or "").translate({c: c + 32 for c in range(65, 91)})
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = [x for x in re.split("[ \t]", piece) if x]
            out.update((lang, " ".join(w[k : k + n])) for k in range(len(w) - n + 1))
    return out


def random_texts(seed, n, words=30):
    rng = np.random.default_rng(seed)
    vocabulary = ["A", "b", "É", "the", "x\x00y", "\x1c", "ß", "日本", *[f"w{k}" for k in range(words)]]
    marks = [" ", "  ", "\t", ". ", "\n", "\r\n", ";", " ? ", "\x0b"]
    return ["".join(f"{vocabulary[min(int(rng.exponential(6)), len(vocabulary) - 1)]}{marks[min(int(rng.exponential(1.2)), len(marks) - 1)]}" for _ in range(rng.integers(0, 200))) for _ in range(n)]


def test_trie_counts_like_a_dictionary(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 20)
    rng = np.random.default_rng(0)
    for n in (1, 2, 3):
        trie, want, spilled = phrases.HatTrie(n), collections.Counter(), collections.Counter()
        for _ in range(30):
            ids = np.minimum(rng.geometric(0.01, (2000, n)), 5000).astype(np.int64)
            ids[:500, 0] = 33
            keys = ids[:, 0]
            for k in range(1, n):
                keys = keys << phrases.BITS | ids[:, k]
            want.update(keys.tolist())
            trie.add(*np.unique(keys, return_counts=True))
            assert trie.size == len(trie.items()[0])
            for keys, counts in trie.spill(300):
                assert len(keys) == len(set(keys.tolist()))
                for k, c in zip(keys.tolist(), counts.tolist(), strict=True):
                    spilled[k] += c
            assert trie.size <= 300
        assert trie.table is None
        assert spilled + collections.Counter(dict(zip(*(x.tolist() for x in trie.items()), strict=True))) == want


def test_container_with_keys_that_collide():
    table = phrases.Container(4)
    want = collections.Counter()
    rng = np.random.default_rng(4)
    for n in (1, 2, 50, 3000, 3000):
        keys, counts = np.unique(rng.integers(0, 4000, n), return_counts=True)
        want.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        table.add(keys, counts)
        assert table.size == len(want)
    assert dict(zip(*(x.tolist() for x in table.items()), strict=True)) == want


def counts_of(counter):
    out = collections.Counter()
    for batch in counter.run(*counter.trie.items()):
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("head", "tail", "f")), strict=True))
        assert rows == sorted(rows, key=lambda r: [*r[0].encode().split(b" "), r[1].encode()])
        out.update({("x", f"{h} {t}" if h else t): c for h, t, c in rows})
    return out


def test_windows_carry_words_over(monkeypatch):
    monkeypatch.setattr(phrases, "WINDOW", 7)
    data = random_texts(5, 40)
    for n in (1, 2, 3):
        counter, got = phrases.Counter("x", n, None), collections.Counter()
        for k, text in enumerate(data):
            counter.begin()
            for window in phrases.windows(text.encode().translate(phrases._TABLE)):
                counter.add(window)
                if k % 7 == 0 and len(window) % 2:
                    # counts are taken out; the words before go along
                    got += counts_of(counter)
                    counter = counter.renewed()
        assert got + counts_of(counter) == brute_counts([("x", t) for t in data], n)


def test_hashes_equal_sparks(spark):
    words = ["a", "", "héllo", "x" * 40, "12345678"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64(F.lit("en"), "w").alias("h"), F.xxhash64(F.xxhash64(F.lit("en"), "w"), F.xxhash64(F.lit("en"), F.reverse("w"))).alias("p")).collect()
    c = phrases.Counter("en", 2, None)
    c.words.listed += [w.encode() for w in words] + [w[::-1].encode() for w in words]
    c._hash_new()
    h = c.hashes[1 : 1 + 2 * len(words)]
    assert h[: len(words)].astype(np.int64).tolist() == [r["h"] for r in got]
    assert phrases.hash_longs(h[len(words) :], phrases.hash_longs(h[: len(words)], 42)).astype(np.int64).tolist() == [r["p"] for r in got]


def test_bit_table_misses_nothing(spark):
    df = spark.range(5000).select(F.xxhash64("id").alias("h"))
    table = phrases.bit_table(df, F.col("h"))
    mine = np.array([r["h"] for r in df.collect()], np.int64).astype(np.uint64)
    assert table.has(mine).all()
    assert table.has(mine ^ np.uint64(0x5555555)).mean() < 0.05


def brute_phrases(rows, best, least):
    rows = [(lang or "und", t) for lang, t in rows]
    f = collections.Counter()
    for n in (1, 2, 3):
        f.update(brute_counts(rows, n))
    n = collections.Counter()
    for (lang, p), c in f.items():
        if " " not in p:
            n[lang] += c
    out = collections.defaultdict(list)
    for (lang, p), a in f.items():
        w = p.split(" ")
        if len(w) == 1 or a < least:
            continue
        if any(len(q.split(" ")) > len(w) and f" {p} " in f" {q} " and c >= least and 100 * c >= 50 * a for (g, q), c in f.items() if g == lang):
            continue
        cuts = [(10**6 * a * a // (f[lang, " ".join(w[:k])] * f[lang, " ".join(w[k:])]), k) for k in range(1, len(w))]
        s, k = min(cuts)
        out[lang].append((-s, -a, p.encode(), f[lang, " ".join(w[:k])], f[lang, " ".join(w[k:])]))
    return sorted((lang, r, p.decode(), -a, left, right, n[lang], -s) for lang, v in out.items() for r, (s, a, p, left, right) in enumerate(sorted(v)[:best], 1))


def test_phrases_equal_brute_force(spark):
    common.package_to_executors(spark)
    rows = [((None, "en", "und", "fr")[k % 4], t) for k, t in enumerate(random_texts(9, 120))]
    rows += [("en", None), ("en", ""), (None, " \t. "), ("solo", "one two three"), ("rep", "again and again " * 500)] + [("en", "hot words here, hot words here")] * 100
    df = spark.createDataFrame(rows, "lang string, text string").withColumn("f", F.lit(1)).withColumn("head", F.lit("clash")).repartition(6)
    assert rows_of(phrases.mine(df, best=40)) == brute_phrases(rows, 40, 10)
    assert phrases.mine(df.limit(0)).count() == 0


def test_tasks_that_spill_and_renew_count_the_same(spark, monkeypatch):
    common.package_to_executors(spark)
    rows = [("en", t) for t in random_texts(11, 150, 200)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    monkeypatch.setattr(phrases, "MOST_SEQUENCES", 50)
    monkeypatch.setattr(phrases, "MOST_WORDS", 40)
    for n in (1, 2, 3):
        got = phrases.merged(phrases.runs(df, n), 2).where("tail is not null").collect()
        want = {k: c for k, c in brute_counts(rows, n).items() if c >= 2}
        assert {(r["lang"], f"{r['head']} {r['tail']}" if r["head"] else r["tail"]): r["f"] for r in got} == want
