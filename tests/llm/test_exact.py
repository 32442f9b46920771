"""Operators with exact results, against brute force and round trips."""

import hashlib
import itertools
import random
import time
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helixtext.llm import common, extract, media, neardup, packing, pieces, pii, queries, sharding, topk

SF = "/root/testdata/sf0.001"
BPE = queries.tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def odd(spark):
    common.package_to_executors(spark)
    rows = [(1, None), (2, ""), (3, " \n "), (None, "a b c d e f"), (2**53 + 1, "Hello there this is a text"), (2**53 + 1, "Hello there this is a text"), (5, "x " * 20000), (6, "y" * 5000), (7, "Hello there this is a text")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("component", F.lit("clash"))


def documents(spark):
    return common.table(spark, SF, "documents").select("doc_id", "text").toPandas()


# top-k


def test_top_k_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.sql(queries.OP1_SQL).df().sort_values(["query_id", "rank"])
    got = queries.op1_top_k(spark, SF).toPandas().sort_values(["query_id", "rank"])
    assert got[want.columns].values.tolist() == want.values.tolist()


def test_threshold_search_stops_early_and_breaks_ties():
    rng = np.random.default_rng(0)
    v = np.floor(256 * rng.normal(0, 1, (400, 3)))
    v[::7] = v[0]
    ids = np.arange(400)
    orders = np.stack([np.argsort(-v[:, d], kind="stable") for d in range(3)])
    depths = []
    for q in range(0, 400, 9):
        got, depth = topk.threshold_search(v, ids, orders, v[q], q, 5)
        s = v @ v[q]
        want = sorted(((-int(s[i]), i) for i in range(400) if i != q))[:5]
        assert got == [(-a, b) for a, b in want]
        depths.append(depth)
    assert min(depths) < 200


def test_top_k_odd_rows(spark):
    common.package_to_executors(spark)
    v = spark.createDataFrame([(0, [0.5, 0.5]), (1, [1.0, float("nan")]), (2, None), (3, [0.5, 0.5]), (50, [0.25]), (50, [0.25]), (None, [1.0]), (6, []), (7, [-1.0, None]), (8, [float("inf")])], "vec_id long, embedding array<double>")
    q = v.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(v, q).collect())
    assert got == [(0, 1, 3, 32768), (0, 2, 50, 8192), (0, 3, 50, 8192), (50, 1, 0, 8192), (50, 2, 3, 8192)]
    assert topk.top_k(v.limit(0), q.limit(0)).count() == 0


# personal data


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("a@b.c, d@e.f.g. 1.2.3.4.5 256.1.1.1", "email:0:5,email:7:14,ip:16:23"),
        ("card 4111 1111 1111 1111 and +1 (415) 555-2671", "card:5:24,phone:29:46"),
        ("4111 1111 1111 1112", ""),
        ("bob [at] example [dot] com", "email:0:26"),
        ("look at the dot here, he is at work", ""),
        ("call plus one four one five five five five two six seven one", "phone:5:60"),
        ("аdmin@exаmple.com", "email:0:17"),
        ("one two three of five", ""),
    ],
)
def test_spans(text, spans):
    assert pii.joined(pii.all_spans(text)[1]) == spans


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("one nine two dot one six eight dot zero dot one", "ip:0:47"),
        ("at one nine two . one six eight . zero . one now", "ip:3:44"),
        ("one nine two.one six eight.zero.one", "ip:0:35"),
        ("192 [dot] one six eight [dot] 0 [dot] one", "ip:0:41"),
        ("nine nine nine dot one dot one dot one", ""),
        ("One. Two. Three. Four.", ""),
        ("call +49 one five one 2 3 4 5 6 7 8", "phone:5:35"),
        ("call +49 151 two three 45 678 90 today", "phone:5:32"),
        ("card 4111 one one 11 1111 1111", "card:5:30"),
        ("+1 415 555 2671 one of us", "phone:0:15"),
        ("in 2019 one of 20 and two of 30", ""),
        ("write john at example.com soon", "email:6:25"),
        ("john at example dot pl", "email:0:22"),
        ("find us at example.com or look at this.it was", ""),
    ],
)
def test_spelled_and_bare_disguises(text, spans):
    assert pii.joined(pii.all_spans(text)[1]) == spans


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1@.+-_% (9)0\n", max_size=60))
def test_plain_spans_equal_the_patterns(text):
    import re

    email = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    ip = [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    assert pii.emails(text) == email and pii.ips(text) == ip


@pytest.mark.parametrize("part", ["zero one two three ", "a dot ", "a at ", "a [dot] ", "a@", "a dot b at c ", "1 dot ", "x at b dot com 1 dot 2 dot 3 dot 4 ", "a@b.co x [at] y [dot] com "])
def test_time_grows_with_the_text(part):
    text = part * (200_000 // len(part)) + "x" * 50_000 + "@" + "1" * 50_000
    start = time.process_time()
    spans = pii.all_spans(text)[1]
    assert time.process_time() - start < 2
    assert all(0 <= a < b <= len(text) for _, a, b in spans)


def test_addresses_equal_one_pattern_tried_from_every_place():
    import re

    whole = re.compile(rf"(?<!{pii._LOCAL})({pii._LOCAL}++(?:{pii._HIDDEN_DOT}{pii._LOCAL}++)*)({pii.AT_MARK})([A-Za-z0-9-]++)((?:{pii.DOT_MARK}[A-Za-z0-9-]++)+)", re.IGNORECASE | re.ASCII)
    words = ["a", "b.c", "dot", "at", "[at]", "(dot)", "@", ".", "com", "x_y", "1", "{ @ }", "\n", "-", "  "]
    rng, found = random.Random(5), 0
    for _ in range(20_000):
        text = "".join(rng.choice(words) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(2, 14)))
        got = [(start, m.end()) for start, m in pii.addresses(text)]
        assert got == [m.span() for m in whole.finditer(text)], text
        found += len(got)
    assert found > 1000


def test_added_spans_equal_all_pairs():
    rng = random.Random(7)
    for _ in range(2000):
        cuts = [sorted(rng.sample(range(30), 2 * rng.randrange(5))) for _ in range(2)]
        base, hidden = [[("email", a, b) for a, b in zip(c[::2], c[1::2], strict=True)] for c in cuts]
        want = [h for h in hidden if all(h[1] >= b or a >= h[2] or h[1] <= a and b <= h[2] and h != (k, a, b) for k, a, b in base)]
        assert pii.added_spans(base, hidden) == want


def test_pii_odd_rows(spark, odd):
    out = pii.find(odd)
    assert out.count() == 9 and out.where("spans <> ''").count() == 0
    assert pii.find(odd.limit(0)).count() == 0
    assert pii.redact(odd).columns == odd.columns
    d = spark.createDataFrame([(1, "mail a@b.c now", 14)], "doc_id long, text string, n_chars long")
    assert tuple(pii.redact(d).first()) == (1, "mail [EMAIL] now", 16)


# shards


def test_shards_are_full_and_slots_gapless(spark):
    out = queries.op4_sharding(spark, SF).toPandas()
    sizes = out.groupby("shard").slot.agg(["count", "max", "nunique"])
    assert len(out) == 200 and sizes["count"].max() - sizes["count"].min() <= 1
    assert (sizes["count"] == sizes["nunique"]).all() and (sizes["max"] == sizes["count"] - 1).all()
    for r, (i, t) in zip(out.sort_values("doc_id").itertuples(), documents(spark).sort_values("doc_id").itertuples(index=False), strict=True):
        assert r.doc_id == i and r.size == len(t.encode()) + 8 and r.text_crc32 == zlib.crc32(t.encode())


def test_flow_equals_one_document_after_another():
    nodes = sharding.ring(5, 4)
    rng = random.Random(3)
    counts = [rng.randrange(30) for _ in nodes]
    capacity = sharding.bounds(sum(counts), 5)
    got = sharding.flow(nodes, counts, capacity)
    left, room, used, moved = list(counts), list(capacity), [0] * 5, []
    for step in itertools.count():
        if not any(left):
            break
        for k in range(len(nodes)):
            shard = nodes[(k + step) % len(nodes)].shard
            while left[k] and room[shard]:
                moved.append((k, shard, used[shard]))
                left[k], room[shard], used[shard] = left[k] - 1, room[shard] - 1, used[shard] + 1
    assert moved == [(p.node, p.shard, p.slot + i) for p in got for i in range(p.last - p.first)]


def test_shards_of_odd_rows(spark, odd):
    out = sharding.shard(odd).toPandas()
    assert len(out) == 9 and out.groupby("shard").size().max() == 1
    assert sharding.shard(odd.limit(0)).count() == 0


# media


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=4000))
def test_streams_round_trip(raw):
    s = media.demux(media.mux(media.padded(raw)))
    assert s.payload == media.padded(raw) and s.payload[: len(raw)] == raw
    assert s.continuity_errors == s.sync_errors == s.table_errors == 0
    assert s.stamps == [media.TICKS * (k + 1) for k in range(len(s.payload) // media.UNIT)]
    assert s.access_units == list(range(0, len(s.stamps), media.ACCESS_EVERY))


def test_lost_and_repeated_packets_are_seen():
    x = media.mux(media.padded(bytes(range(256)) * 40))
    p = media.PACKET
    assert media.demux(x[: 20 * p] + x[21 * p :]).continuity_errors == 1
    twice = media.demux(x[: 20 * p] + x[19 * p :])
    assert twice.continuity_errors == 0 and twice.payload == media.demux(x).payload
    assert media.demux(b"").payload == b"" and media.demux(b"\0" * 500).sync_errors > 0


def test_media_query(spark, odd):
    out = queries.op6_transport_stream(spark, SF).toPandas().set_index("doc_id")
    for i, t in documents(spark).itertuples(index=False):
        payload = media.padded(t.encode())
        assert out.loc[i, "payload_sha256"] == hashlib.sha256(payload).hexdigest() and out.loc[i, "tail_crc32"] == zlib.crc32(payload[-32:])
    assert media.store(odd).count() == 9 and media.store(odd.limit(0)).count() == 0


# near duplicates


def components(docs, size, link=(80, 100)):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return frozenset(tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))) if w else frozenset()

    sets = [shingles(t) for t in docs.text]
    ids = docs.doc_id.tolist()
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(range(len(ids)), 2):
        n = len(sets[a] & sets[b])
        if n and link[1] * n >= link[0] * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(ids[a]), root(ids[b])
            up[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}, {i: len(s) for i, s in zip(ids, sets, strict=True)}


def test_classes_equal_brute_force(spark):
    d = documents(spark)
    want, sizes = components(d, 4)
    got = queries.op7_setsketch(spark, SF).toPandas()
    assert dict(zip(got.doc_id, got.component_id)) == want and dict(zip(got.doc_id, got.n_shingles)) == sizes


def test_repeated_and_null_ids_link_by_their_texts(spark):
    words = [f"w{i}" for i in range(40)]
    b = " ".join(words)
    rows = [(5, "something else altogether in this text"), (5, b), (7, b + " tail"), (None, b), (3, b + " tail end"), (9, "alone in the world with these words"), (9, None), (None, None), (5, b)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.classes(d, size=4).collect()), key=str)
    want = [(5, 3, 5, True), (5, 37, 3, False), (5, 37, 3, False), (7, 38, 3, False), (None, 37, None, True), (3, 39, 3, True), (9, 4, 9, True), (9, 0, 9, True), (None, 0, None, True)]
    assert got == sorted(want, key=str)
    left = neardup.without_copies(d.withColumn("row_key", F.lit("clash")), size=4)
    assert left.columns == ["doc_id", "text", "row_key"]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([rows[0], rows[3], rows[4], rows[5], rows[6], rows[7]], key=str)


def test_a_group_whose_pivot_is_far_from_most(spark):
    common.package_to_executors(spark)
    rng = random.Random(5)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = []
    for i in range(120):
        w = list(base)
        for k in rng.sample(range(300), 2 if i % 3 else 14):
            w[k] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    d = pd.DataFrame(rows, columns=["doc_id", "text"])
    want, _ = components(d, 5)
    got = neardup.classes(spark.createDataFrame(d), block=16).toPandas()
    assert dict(zip(got.doc_id, got.component_id)) == want


def test_estimates_are_near():
    rng = np.random.default_rng(2)
    common_part = rng.integers(0, 2**63, 800, dtype=np.uint64)
    a = np.unique(np.concatenate([common_part, rng.integers(0, 2**63, 100, dtype=np.uint64)]))
    b = np.unique(np.concatenate([common_part, rng.integers(0, 2**63, 100, dtype=np.uint64)]))
    r = neardup.registers(np.concatenate([a, b]), np.array([len(a), len(b)]))
    got = neardup.estimate(r[:1], r[1:], np.array([900.0]), np.array([900.0]))[0]
    assert abs(got - 0.8) < 5 * np.sqrt(0.8 * 0.2 / 240)
    union = neardup.registers(np.unique(np.concatenate([a, b])), np.array([1000]))
    assert (union[0] == np.maximum(r[0], r[1])).all()


def test_near_duplicates_of_odd_rows(spark, odd):
    got = [(r.doc_id, r.component_id, r.kept) for r in neardup.classes(odd).collect()]
    assert len(got) == 9 and sum(k for _, _, k in got) == 7
    assert (2**53 + 1, 7, False) in got and (None, None, True) in got
    assert neardup.classes(odd.limit(0)).count() == 0
    assert neardup.without_copies(odd).count() == 7


# page texts


def test_pages():
    p = '<html><head><title>t</title></head><body><header><a href=x>Home</a></header><div class="cookie-notice">We use cookies to make this better for you today.</div><main><h1>T &amp; U</h1><p>The first   paragraph is long\nenough to count as content here.<p>Second one, with some more words in it.<div class="comments"><p>A reader said a long sentence in the comments of this page.</p></div><form>Sign up <input></form></main><aside><p>See also other things in the sidebar that are long too.</p></aside><footer>© x</footer>'
    assert extract.main_text(p) == "T & U\n\nThe first paragraph is long enough to count as content here.\n\nSecond one, with some more words in it."
    assert extract.main_text("") == "" and extract.main_text("<p>x") == "x" and extract.main_text("<script>alert(1)") == ""


def test_a_run_of_content_carries_a_short_block():
    p = "<p>A long paragraph of the text, with enough words in it to look like one.</p>"
    page = f"<body><div>{p * 3}<p>Or not</p>{p * 3}</div><p>Or not</p></body>"
    found, elements = extract.blocks(page)
    w = np.array(extract.START)
    alone = [extract.score(b, w) > 0 for b in found]
    assert alone == [True] * 3 + [False] + [True] * 3 + [False]
    assert extract.content(found, elements, w) == [True] * 7 + [False]


def test_names_are_weak_and_plain_pages_whole():
    text = "Our work builds on that of others, as the list in this text shows. " * 3
    page = f'<div class="content"><p>{text}</p><div class="related-work"><p>{text}</p></div><p>{text}</p><div class="ad">Buy this now, it is cheap.</div></div>'
    assert extract.main_text(page).count("Our work") == 9 and "cheap" not in extract.main_text(page)
    assert extract.main_text("Hello") == "Hello" and extract.main_text("Hello &amp;\n world") == "Hello & world"


def test_deep_pages_take_time_in_proportion():
    import time

    def seconds(k):
        start = time.process_time()
        assert extract.main_text("<div>" * k + "<p>x") is not None and extract.blocks("<div>a b" * k + "</p>" * k)[0]
        return time.process_time() - start

    assert seconds(100_000) < 12 * max(seconds(20_000), 0.05)


def test_texts_equal_those_of_another_parser(spark):
    from html.parser import HTMLParser

    class Article(HTMLParser):
        def __init__(self):
            super().__init__()
            self.inside, self.parts = False, [""]

        def handle_starttag(self, tag, attributes):
            self.inside |= tag == "article"
            self.parts += [""] if tag in ("p", "h1") else []
            self.parts[-1] += " " if tag == "br" else ""

        def handle_endtag(self, tag):
            self.inside &= tag != "article"
            self.parts += [""] if tag in ("p", "h1", "article") else []

        def handle_data(self, data):
            self.parts[-1] += data if self.inside else ""

    pages = common.table(spark, SF, "pages").toPandas()
    got = queries.op9_main_text(spark, SF).toPandas().set_index("page_id")
    for r in pages.itertuples():
        other = Article()
        other.feed(r.html or "")
        other.close()
        want = "\n\n".join(t for t in (" ".join(x.split()) for x in other.parts) if t)
        assert got.text[r.page_id] == want and got.n_chars[r.page_id] == len(want)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-5, 5), min_size=1, max_size=8), st.floats(0, 3))
def test_cut_is_the_cheapest(scores, tie):
    n = len(scores)
    net = extract.Network(n + 2)
    for i, s in enumerate(scores):
        net.edge(n, i, s) if s > 0 else net.edge(i, n + 1, -s)
        if i:
            net.edge(i - 1, i, tie, tie)
    side = net.source_side(n, n + 1)[:n]

    def cost(keep):
        return sum((s > 0) * s * (not k) + (s < 0) * -s * k for s, k in zip(scores, keep, strict=True)) + tie * sum(a != b for a, b in itertools.pairwise(keep))

    assert cost(side) <= min(map(cost, itertools.product([False, True], repeat=n))) + 1e-6


def test_pages_of_odd_rows(spark):
    p = spark.createDataFrame([(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (1, "u", None)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    assert sorted((r.text, r.n_chars) for r in extract.extract(p).collect()) == [("", 0), ("", 0), ("", 0), ("x", 1)]


# packing


def test_packing_loses_nothing(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    t.encode_special_tokens = True
    out = queries.op10_packing(spark, SF).toPandas()
    whole = out.sort_values(["sequence_id", "offset"])
    assert (whole.groupby("sequence_id").length.cumsum() - whole.length == whole.offset).all()
    assert whole.groupby("sequence_id").length.sum().max() <= 1024
    assert whole.length.sum() / (1024 * whole.sequence_id.nunique()) > 0.97
    by = dict(list(out.sort_values("start").groupby("doc_id")))
    for i, text in documents(spark).itertuples(index=False):
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 0], "<u4")
        p = by[i]
        assert p.start.tolist() == list(range(0, len(ids), 1024)) and p.length.sum() == len(ids) == p.doc_tokens.iloc[0]
        assert [zlib.crc32(ids[a : a + n].tobytes()) for a, n in zip(p.start, p.length)] == p.ids_crc32.tolist()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=" ab\n\t.é　'<|endoftext|>1", max_size=40), min_size=1, max_size=4))
def test_ids_equal_the_tokenizers(texts):
    from tokenizers import Tokenizer

    if not hasattr(test_ids_equal_the_tokenizers, "t"):
        test_ids_equal_the_tokenizers.t = Tokenizer.from_file(BPE)
        test_ids_equal_the_tokenizers.t.encode_special_tokens = True
        test_ids_equal_the_tokenizers.own = packing.Tokens(BPE)
    t, own = test_ids_equal_the_tokenizers.t, test_ids_equal_the_tokenizers.own
    assert [x.tolist() for x in own.of(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_added_tokens_keep_their_ids():
    from tokenizers import Tokenizer

    t, own = Tokenizer.from_file(BPE), packing.Tokens(BPE)
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, end * 2, f"{end} {end}", f" {end}\n", f"a{end}b c", f"x  {end}  y z {end}", f"<|endoftext{end}|>", "<|endoftext|", f"a b\n{end}\n\nb", ""]
    assert own.of([texts[0]])[0].tolist() == [64, 220, 50256, 275]
    assert [x.tolist() for x in own.of(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_first_fit_takes_the_leftmost_bin():
    tree = packing.FirstFit(10, 5)
    assert [tree.put(n) for n in (6, 5, 4, 5, 1)] == [(0, 0), (1, 0), (0, 6), (1, 5), (2, 0)]


def test_packing_of_odd_rows(spark, odd):
    out = packing.pack(odd, BPE)
    assert out.where("doc_id = 1").first()["length"] == 1 and out.where("doc_id is null").count() == 1
    assert packing.pack(odd.limit(0), BPE).count() == 0


# pieces


def test_pieces_equal_the_library_and_come_back(spark, odd):
    import sentencepiece

    path = queries.tokenizer_path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    model = pieces.load(path)
    texts = documents(spark).head(40).text.tolist() + ["  hello  world\nfoo\tbar \n x", "日本語 😀 test", "x" * 3000 + " " + "ab" * 400, " ", ""]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    enc = pieces.encode(d, model)
    assert {r.doc_id: r.ids for r in enc.collect()} == {i: sp.encode(t) for i, t in enumerate(texts)}
    assert {r.doc_id: r.text for r in pieces.decode(enc, model).collect()} == dict(enumerate(texts))
    assert pieces.encode(odd, model).count() == 9 and pieces.encode(odd.limit(0), model).count() == 0


def test_unigram_fold_is_the_best_path(spark):
    table = (("▁", 0, -3.0), ("▁a", 1, -2.0), ("a", 2, -2.5), ("b", 3, -2.5), ("ab", 4, -3.0), ("▁ab", 5, -5.5), ("bb", 6, -2.0))
    model = pieces.Model(table, -1, 99, 3, True)
    d = spark.createDataFrame([(1, "ab"), (2, "abb"), (3, "aab")], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in pieces.encode(d, model).collect()}
    assert got == {1: [1, 3], 2: [1, 6], 3: [1, 4]}


def test_digests_are_those_of_the_ids(spark):
    model = pieces.load(queries.tokenizer_path("piece_bpe_32k.model"))
    d = spark.createDataFrame(list(enumerate(documents(spark).head(60).text.tolist())), "doc_id long, text string").unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, " 日本 " * 50)], "doc_id long, text string"))
    ids = {r.doc_id: (r.ids, r.whole) for r in pieces.encode(d, model).collect()}
    got = {r.doc_id: (r.n_ids, r.ids_sha256, r.whole) for r in pieces.encode(d, model, digests=True).collect()}
    assert got == {k: (len(v), hashlib.sha256(",".join(map(str, v)).encode()).hexdigest(), w) for k, (v, w) in ids.items()}


def test_words_of_a_chunk_are_not_walked_for_each_portion():
    class Words(dict):
        walked = 0

        def keys(self):
            Words.walked += 1
            return super().keys()

    model = pieces.Model((("▁", 0, -1.0), ("▁a", 1, -2.0), ("b", 2, -3.0)), -1, 99, 2, False)
    d = pieces.Dictionary(model)
    d.words = Words()
    d.add(["▁a", "b"], [b"\1\0", b"\2\0"])
    d.learn({"a", "ab"})
    d.learn({"ab", "abb"})
    assert dict(d.words) == {"a": b"\1\0", "ab": b"\1\0\2\0", "abb": b"\1\0\2\0\2\0"} and Words.walked == 0


def test_no_null_list_goes_to_python(spark):
    """Arrow's writer fills the offsets of null lists anew with each row."""
    model = pieces.load(queries.tokenizer_path("piece_bpe_32k.model"))
    d = spark.createDataFrame([(1, "hello world"), (2, None)], "doc_id long, text string")
    kind = type(d)
    seen, old = [], kind.mapInArrow

    def spy(df, *args, **more):
        seen.append(df)
        return old(df, *args, **more)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(kind, "mapInArrow", spy)
        pieces.encode(d, model).count()
    for df in seen:
        for c in [f.name for f in df.schema.fields if f.dataType.typeName() == "array"]:
            assert df.where(F.col(c).isNull()).count() == 0
