"""Near-duplicate documents: SetSketch registers, bands of register values, exact confirmation.

A document's set is that of its word shingles. A register keeps the least of
exponentially distributed hashes over the set, on an exponential scale and
truncated to 16 bits. Registers of unions are maxima of registers, and two sets
share a register's value about as often as their similarity says.

1. Documents with the same set are one row, known by a number made of the set.
2. Bands of register values are keys. In each bucket every member is paired with
   the bucket's smallest member, its pivot: as many pairs as members.
3. Pairs whose similarity, jointly estimated by likelihood from both sketches,
   is far too low are left; all others are confirmed on the full sets.
4. Links give components. Only buckets whose members (the pivot aside) are still
   in different components are looked at again: in blocks of members, with all
   intersections of a block computed at once, and only links between different
   components are returned. So no link of a bucket is missed, and no list of all
   its pairs is ever made.
5. The components of all links are the classes, each named by its smallest doc_id.

Defined cases: a text with fewer words than a shingle has is one shingle; a null,
empty or blank text has no set, is linked with nothing and kept; equal texts have
equal sets, whatever their number; each row counts by its own text, so rows with
the same doc_id share a class only by their texts; a row with a null doc_id is
linked with nothing, kept, and has a null component; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SHINGLE = 5
#: Similarity of a link, as a fraction of whole numbers.
LINK = (80, 100)
#: Registers: BANDS of ROWS. At the link's similarity a pair shares no band with probability (1 - 0.8**ROWS)**BANDS = 5e-6.
ROWS, BANDS = 6, 40
#: The scale of the registers.
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 2
#: Pairs are left if the estimate is below the link's similarity by so many standard errors.
ERRORS = 5.0
#: Members of a block.
BLOCK = 256
#: Bits of the filter before texts are fetched: so many for each text, within a broadcast of 1 to 16 MB.
FILTER_EACH, FILTER_LEAST, FILTER_MOST = 16, 1 << 23, 1 << 27
#: Parts that the rows of one cluster are dealt to.
SALTS = 32


@functools.lru_cache(maxsize=4)
def multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(2024)
    return (rng.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32), rng.integers(0, 2**31, n, dtype=np.uint64).astype(np.uint32) * np.uint32(2) + np.uint32(1))


def words_of(text: str | None) -> list[bytes]:
    """Words between blanks and the control characters 9 to 13, A-Z in small letters."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class WordHashes:
    """64-bit hashes of words; frequent ones are kept."""

    def __init__(self, most: int = 300_000):
        self.scores, self.most = {}, most
        self.ids, self.values = common.WordIds(), np.zeros(0, np.uint64)

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self.ids) > self.most:
            self.ids, self.values = common.WordIds(), np.zeros(0, np.uint64)
        at = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        if (n := len(self.ids) - len(self.values)) > 0:
            new = pd.util.hash_array(np.array([w.decode("latin-1") for w in common.newest(self.ids, n)], dtype=object), categorize=False)
            self.values = np.concatenate([self.values, mixed(new.astype(np.uint64))])
        return self.values[at]


def word_hashes() -> WordHashes:
    return common.kept("word hashes", WordHashes)


def shingle_sets(texts: list[str | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the sets of all texts end to end, each sorted, and the size of each."""
    cut = [words_of(t) for t in texts]
    counts = np.array([len(w) for w in cut], np.int64)
    h = word_hashes().of([w for words in cut for w in words])
    n = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    doc = np.repeat(np.arange(len(texts)), n)
    starts = np.cumsum(counts) - counts
    at = np.repeat(starts - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
    short = np.repeat(counts < size, n)
    padded = np.concatenate([h, np.zeros(size, np.uint64)])
    out = np.zeros(len(at), np.uint64)
    length = np.minimum(counts, size)[doc]
    with np.errstate(over="ignore"):
        for k in range(size):
            value = padded[at + k]
            if short.any():
                value = np.where(k < length, value, np.uint64(0))
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + value + np.uint64(k))
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[keep], np.bincount(doc[keep], minlength=len(texts)).astype(np.int64)


def registers(hashes: np.ndarray, sizes: np.ndarray, m: int = ROWS * BANDS) -> np.ndarray:
    """SetSketch registers, documents x m; sets without elements have zeros."""
    out = np.zeros((len(sizes), m), np.uint16)
    has = np.flatnonzero(sizes)
    if not len(has):
        return out
    starts = (np.cumsum(sizes) - sizes)[has]
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    salt, factor = multipliers(m)
    least = np.empty((m, len(has)), np.uint32)
    with np.errstate(over="ignore"):
        for i in range(m):
            least[i] = np.minimum.reduceat((low ^ salt[i]) * factor[i], starts)
    u = (least.astype(np.float64) + 0.5) / 2.0**32
    x = -np.log1p(-u) / RATE
    out[has] = np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, LIMIT + 1).astype(np.uint16).T
    return out


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, grid: int = 201) -> np.ndarray:
    """Joint maximum-likelihood estimates of the similarities of pairs of sketches, with the sets' sizes known."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u, v = (na / (na + nb))[:, None], (nb / (na + nb))[:, None]
    top = np.minimum(na, nb) / np.maximum(na, nb)
    j = np.linspace(0, 1, grid)[None] * top[:, None]

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    pa, pb = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
    likely = more[:, None] * np.log(pa) + less[:, None] * np.log(pb) + same[:, None] * np.log(np.maximum(1 - pa - pb, 1e-12))
    return j[np.arange(len(a)), likely.argmax(1)]


def linked(common_: np.ndarray, na: np.ndarray, nb: np.ndarray, link: tuple[int, int] = LINK) -> np.ndarray:
    return (link[1] * common_ >= link[0] * (na + nb - common_)) & (common_ > 0)


def intersections(hashes: np.ndarray, sizes: np.ndarray, columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections of some sets: a product of their shared elements' indicator rows, some columns at a time."""
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    unique, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    column = np.full(len(unique), -1)
    shared = np.flatnonzero(counts > 1)
    column[shared] = np.arange(len(shared))
    col = column[inverse]
    keep = col >= 0
    owner, col = owner[keep], col[keep]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    out = np.zeros((n, n), np.float32)
    for first in range(0, len(shared), columns):
        a, b = np.searchsorted(col, [first, first + columns])
        part = np.zeros((n, min(columns, len(shared) - first)), np.float32)
        part[owner[a:b], col[a:b] - first] = 1
        out += part @ part.T
    np.fill_diagonal(out, sizes)
    return out.astype(np.int64)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, row_key (passed through), n_shingles, set_key (of the set, null without one), registers (binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in common.slices(texts, 1_000_000):
                hashes, sizes = shingle_sets(texts[a:b], size)
                regs = registers(hashes, sizes)
                with np.errstate(over="ignore"):
                    ends = np.concatenate([[0], np.cumsum(sizes)])
                    sums = np.concatenate([[0], np.cumsum(hashes, dtype=np.uint64)]).astype(np.uint64)
                    total = sums[ends[1:]] - sums[ends[:-1]]
                    twice = np.concatenate([[0], np.cumsum(mixed(hashes), dtype=np.uint64)]).astype(np.uint64)
                    other = twice[ends[1:]] - twice[ends[:-1]]
                keys = [f"{x:016x}{y:016x}{n:x}" if n else None for x, y, n in zip(total.tolist(), other.tolist(), sizes.tolist(), strict=True)]
                arrays = [batch.column("doc_id").slice(a, b - a), batch.column("row_key").slice(a, b - a), pa.array(sizes), pa.array(keys, pa.string()), pa.array([r.tobytes() for r in regs], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "row_key", "n_shingles", "set_key", "registers"])

    return docs.select("doc_id", "row_key", "text").mapInArrow(run, "doc_id long, row_key long, n_shingles long, set_key string, registers binary")


def components(spark: SparkSession, edges: DataFrame, scratch: common.Scratch) -> DataFrame:
    """node, component (the smallest node reachable) of all nodes of edges (a, b).

    Large-star and small-star steps in turn: each shortens the way to the
    smallest node, and no node ever gathers more than its own edges.
    """
    now = scratch.table(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        new = scratch.table(small)
        state = new.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b") % 1_000_000_007), F.lit(0))).first()
        scratch.drop(now)
        now = new
        if state == before:
            break
        before = state
    # now every edge leads to the smallest node of its component
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, link: tuple[int, int]) -> DataFrame:
    """Of the pairs (a, b) those whose full sets are linked; texts: rep, text."""
    left = texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")).hint("merge")
    right = texts.select(F.col("rep").alias("b"), F.col("text").alias("tb")).hint("merge")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sizes = [len(x) + len(y) for x, y in zip(pdf["ta"], pdf["tb"], strict=True)]
            for k, stop in _ranges(sizes, 1_000_000):
                part = pdf.iloc[k:stop]
                hashes, n = shingle_sets([t for p in zip(part["ta"], part["tb"], strict=True) for t in p], size)
                pair = np.repeat(np.arange(len(part)), n[0::2] + n[1::2])
                order = np.lexsort((hashes, pair))
                h, p = hashes[order], pair[order]
                twice = np.bincount(p[1:][(h[1:] == h[:-1]) & (p[1:] == p[:-1])], minlength=len(part))
                yield part.loc[linked(twice, n[0::2], n[1::2], link), ["a", "b"]]

    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInPandas(run, "a long, b long")


def _ranges(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def _block_links(pdf: pd.DataFrame, size: int, link: tuple[int, int]) -> pd.DataFrame:
    """Links between different components among the members of a block, or of two: as few as join what they join."""
    pdf = pdf.drop_duplicates("rep").reset_index(drop=True)
    hashes, n = shingle_sets(pdf["text"].tolist(), size)
    both = intersections(hashes, n)
    comp = pdf["component"].to_numpy()
    a, b = np.nonzero(linked(both, n[:, None], n[None], link) & (comp[:, None] < comp[None]))
    _, first = np.unique(np.stack([comp[a], comp[b]], 1), axis=0, return_index=True) if len(a) else (None, [])
    rep = pdf["rep"].to_numpy()
    return pd.DataFrame({"a": rep[a[first]], "b": rep[b[first]]}, dtype="int64")


def keyed_rows(docs: DataFrame) -> DataFrame:
    """doc_id, text and a key of both."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("row_key", F.xxhash64("doc_id", "text"))


def classes(docs: DataFrame, size: int = SHINGLE, link: tuple[int, int] = LINK, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs (doc_id, text)."""
    scratch = common.Scratch(docs.sparkSession)
    return row_classes(docs, size, link, block, scratch).drop("row_key")


def row_classes(docs: DataFrame, size: int, link: tuple[int, int], block: int, scratch: common.Scratch) -> DataFrame:
    """The rows of classes, each with the key of its id and text."""
    spark = docs.sparkSession
    common.package_to_executors(spark)
    texts = keyed_rows(docs)
    sketched = scratch.table(sketches(texts, size))
    # 1. one row for each set, known by a number made of it, with its smallest id and the key of that row
    reps = sketched.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull()).groupBy("set_key").agg(F.min(F.struct("doc_id", "row_key")).alias("first"), F.min("registers").alias("registers"), F.min("n_shingles").alias("n"))
    one = scratch.table(reps.select("set_key", F.xxhash64("set_key").alias("rep"), "first.doc_id", "first.row_key", "registers", "n"))
    # 2. buckets
    band = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substring("registers", k * (2 * ROWS) + 1, F.lit(2 * ROWS)))))
    keyed = one.select("rep", band.alias("band", "key")).select("rep", "key")
    buckets = keyed.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("n")).where("n > 1").select("key", "pivot")
    member = scratch.table(keyed.join(buckets, "key").where("rep <> pivot"))
    # texts and sketches of the documents in any bucket, fetched once
    wanted = member.select(F.explode(F.array("rep", "pivot")).alias("rep")).distinct()
    near = scratch.table(_fetch(texts, one, scratch.table(wanted)))
    # 3. pairs with the pivot, estimated, then confirmed
    star = member.select(F.col("rep").alias("b"), F.col("pivot").alias("a")).distinct()
    spread = np.sqrt(link[0] / link[1] * (1 - link[0] / link[1]) / (ROWS * BANDS))
    least = link[0] / link[1] - ERRORS * spread

    def likely(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = np.frombuffer(b"".join(pdf["ra"]), np.uint16).reshape(len(pdf), -1)
            y = np.frombuffer(b"".join(pdf["rb"]), np.uint16).reshape(len(pdf), -1)
            yield pdf.loc[estimate(x, y, pdf["na"].to_numpy(float), pdf["nb"].to_numpy(float)) >= least, ["a", "b"]] if len(pdf) else pdf[["a", "b"]]

    left = near.select(F.col("rep").alias("a"), F.col("registers").alias("ra"), F.col("n").alias("na")).hint("merge")
    right = near.select(F.col("rep").alias("b"), F.col("registers").alias("rb"), F.col("n").alias("nb")).hint("merge")
    # sizes too far apart can't be linked
    joined = star.join(left, "a").join(right, "b").where(link[1] * F.least("na", "nb") >= link[0] * F.greatest("na", "nb"))
    pairs = scratch.table(joined.select("a", "b", "ra", "rb", "na", "nb").mapInPandas(likely, "a long, b long"))
    links = scratch.table(_confirm(pairs, near.select("rep", "text"), size, link))
    # 4. buckets that are not yet of one component
    found = scratch.table(components(spark, links, scratch))
    inside = member.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_ = inside.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"), F.sum(F.xxhash64("rep") % 2_147_483_629).alias("members")).where("low < high")
    # the same members in many buckets are looked at once
    open_ = open_.groupBy("n", "members", "low", "high").agg(F.min("key").alias("key")).select("key", "n")
    groups = scratch.table(_groups(inside.join(open_, "key").select("key", "rep", "component"), block, scratch))
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64(F.lit("block"), "rep"), blocks.cast("long")).cast("int")
    rest = groups.select("key", "rep", "component", own.alias("mine"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    rest = rest.select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "rep", "component")
    more = rest.join(near.select("rep", "text").hint("merge"), "rep").groupBy("key", "i", "j").applyInPandas(lambda pdf: _block_links(pdf, size, link), "a long, b long")
    every = scratch.table(links.unionByName(more).distinct())
    # 5. classes
    final = components(spark, every, scratch).withColumnRenamed("node", "rep")
    of_set = one.select("set_key", "rep", "doc_id").join(final, "rep", "left").select("set_key", "doc_id", F.coalesce("component", "rep").alias("component"))
    named = of_set.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_set = of_set.join(named, "component").select("set_key", "component_id")
    # rows without a set or an id meet nothing
    rows = sketched.select("doc_id", "row_key", "n_shingles", "set_key")
    lone = "set_key is null or doc_id is null"
    out = rows.where(f"not ({lone})").join(of_set, "set_key").unionByName(rows.where(lone).withColumn("component_id", F.col("doc_id")))
    return out.select("doc_id", "row_key", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _groups(members: DataFrame, block: int, scratch: common.Scratch) -> DataFrame:
    """key, n, rep, component: the groups whose pairs are to be looked at, from the members of open buckets (key, rep, component).

    Bands cut a group of near copies into many buckets that share most members.
    Buckets that meet, over a member or two, are one group where that makes fewer
    rows than the buckets by themselves, and stay apart where it doesn't; every
    pair of a bucket is in a group either way.
    """
    members = scratch.table(members)
    near = members.groupBy("key").agg(F.min("rep").alias("cluster"))
    for _ in range(2):
        least = members.join(near, "key").groupBy("rep").agg(F.min("cluster").alias("cluster"))
        near = members.join(least, "rep").groupBy("key").agg(F.min("cluster").alias("cluster"))
    placed = scratch.table(members.join(near, "key"))
    cost = lambda n: n * F.ceil(n / block)
    buckets = placed.groupBy("cluster", "key").agg(F.count("*").alias("n"))
    whole = placed.select("cluster", "rep").distinct().groupBy("cluster").agg(F.count("*").alias("size"))
    apart = buckets.groupBy("cluster").agg(F.sum(cost(F.col("n"))).alias("apart"))
    choice = whole.join(apart, "cluster").select("cluster", "size", (cost(F.col("size")) <= F.col("apart")).alias("one"))
    # a cluster can hold most members: its rows are dealt to SALTS parts
    choice = scratch.table(choice.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = placed.withColumn("salt", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).cast("int"))
    on = ["cluster", "salt"]
    one = salted.select(*on, "rep", "component").distinct().join(choice.where("one"), on).select(F.concat(F.lit("c"), F.col("cluster").cast("string")).alias("key"), F.col("size").alias("n"), "rep", "component")
    many = salted.join(choice.where("not one").select(*on), on).join(buckets.select("key", "n"), "key").select(F.concat(F.lit("b"), F.col("key").cast("string")).alias("key"), "n", "rep", "component")
    return one.unionByName(many)


def without_copies(docs: DataFrame, size: int = SHINGLE, link: tuple[int, int] = LINK) -> DataFrame:
    """One document of each class, the one with the smallest id; of rows that repeat an id and its text one stays."""
    scratch = common.Scratch(docs.sparkSession)
    found = scratch.table(row_classes(docs, size, link, BLOCK, scratch).select("doc_id", "row_key", "kept"))
    gone = found.where("not kept").select("row_key").distinct()
    repeated = found.where("kept and doc_id is not null").groupBy("row_key").count().where("count > 1").select("row_key")
    key = common.unused("row_key", docs.columns)
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    left = keyed.join(gone.withColumnRenamed("row_key", key), key, "left_anti")
    if repeated.isEmpty():
        return left.select(*docs.columns)
    repeated = repeated.withColumnRenamed("row_key", key)
    twice = left.join(repeated, key, "left_semi").dropDuplicates([key])
    return left.join(repeated, key, "left_anti").select(*docs.columns).unionByName(twice.select(*docs.columns))


def _maybe_in(rows: DataFrame, key: str, wanted: DataFrame, bits: int) -> DataFrame:
    """The rows whose key may be among the wanted: a bit for each hash, in a table of bits / 8 bytes at most.

    Its size is fixed, so it may be broadcast; rows that it lets through by
    chance are for an exact join to tell.
    """
    def place(name: str) -> tuple:
        h = F.pmod(F.xxhash64(F.lit("filter"), name), F.lit(bits))
        return F.floor(h / 32768).cast("int"), (h % 32768).cast("int")

    bucket, bit = place(key)
    maps = wanted.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_map"))
    at = rows.withColumns({"_bucket": bucket, "_bit": bit}).join(F.broadcast(maps), "_bucket")
    byte = F.conv(F.hex(F.substring("_map", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return at.withColumn("_byte", byte).where(F.expr("shiftright(_byte, _bit % 8) & 1 = 1")).select(*rows.columns)


def _fetch(texts: DataFrame, one: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep, text, registers, n of the sets wanted (rep)."""
    bits = FILTER_LEAST
    while bits < min(FILTER_EACH * wanted.count(), FILTER_MOST):
        bits *= 2
    sets = _maybe_in(one.select("rep", "row_key", "registers", "n"), "rep", wanted, bits).join(wanted.hint("merge"), "rep")
    keys = one.select("rep", "row_key").join(wanted.hint("merge"), "rep").select("row_key")
    some = _maybe_in(texts.where("text is not null and doc_id is not null"), "row_key", keys, bits).select("row_key", "text")
    found = some.join(keys.hint("merge"), "row_key", "left_semi").groupBy("row_key").agg(F.max("text").alias("text"))
    return found.join(sets.hint("merge"), "row_key").select("rep", "text", "registers", "n")
