"""Toxicity by class-conditional Kneser-Ney models over the characters of words.

Two models, one of toxic and one of ordinary text, give each word two
log-likelihoods. Their top orders count in the class alone; the lower orders hold
the continuation counts of both classes together, so that an expression that is
rare in one class falls back to what both share. Differences are normalised by
length over each word and over the document; a logistic curve, fitted on
labelled documents that no count came from, turns them into a probability.

Beginnings of words that are seen twice or more have counts of their own; what
was seen once falls back. Tasks hold the most frequent beginnings. All others
stay in a stored table: words that may lead to one of them are found in the pass
over the texts, meet the table once each, by their first characters, and their
values are joined back to the documents. What a word gets doesn't depend on where
its beginnings are held.

Defined cases: a null or empty text gets the score of a document without words;
documents without a label row are scored like the rest; repeated rows get equal
scores; without labels of both classes every score is the share of toxic labels
(0 without any); columns other than those named are not read.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Labelled documents of each class that the curve is fitted on, at most; all others are counted.
MOST_OF_CLASS = 2500
#: Characters that the models tell apart: the most frequent of the counted words; two more stand for a word's edge and the rest.
CHARS = 38
ORDER = 4
#: Characters of a word's beginning that the top order looks back on.
LONGEST = 12
DISCOUNT = 0.75
#: Beginnings of more than START characters that each task holds, at most: the most frequent. The others are stored and joined.
BEGINNINGS = 400_000
#: Characters that a stored beginning shares with the words that ask for it; shorter beginnings are always held, and are (CHARS + 2) ** START at most.
START = 3
#: Stored beginnings that a task looks words up in at a time, on average.
BUCKET = 50_000
#: Values of words are multiples of this, so that sums over documents don't depend on their order.
GRAIN = 2.0**-16
#: Words whose normalised differences count one by one, and the length below which a word is as noisy as that.
TOP = 3
USUAL = 6.0
#: Marks that are no part of a word when around it.
MARKS = ".,;:!?()[]{}<>\"'*#%&$|/\\=+-_~`"
#: White space between words, for Spark, as ``str.split`` has it.
BLANKS = r"[\p{IsWhite_Space}\x1c-\x1f]+"
THRESHOLD = 0.3
FEATURES = "toxicity_features"


@dataclass
class Model:
    chars: str
    #: log-probability of a character after the ORDER - 1 before it: class x ORDER-gram.
    tables: np.ndarray
    #: Hashes of the word beginnings seen, in order, and for each: how often in either class, and how many characters follow.
    beginnings: np.ndarray
    seen: np.ndarray
    follow: np.ndarray
    #: How often in either class characters follow whose own beginning was seen once: all of it falls back.
    lost: np.ndarray
    curve: np.ndarray
    prior: float
    #: Whether a beginning is followed by stored ones.
    open: np.ndarray | None = None
    #: The folder of the stored beginnings and how many there are.
    stored: str = ""
    stored_rows: int = 0
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def codes(words: list[str], chars: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all words end to end, each with ORDER - 1 edges before and one behind; where words start, and their length with one edge."""
    table = np.full(max(map(ord, chars), default=0) + 1, 1, np.int16)
    for i, c in enumerate(chars):
        table[ord(c)] = i + 2
    edge = "\x00" * (ORDER - 1)
    points = np.frombuffer((edge + edge.join(w.replace("\x00", " ") + "\x00" for w in words)).encode("utf-32-le", "replace"), "<u4")
    out = np.where(points < len(table), table[np.minimum(points, len(table) - 1)], 1).astype(np.int64)
    out[points == 0] = 0
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return out, np.cumsum(lengths + ORDER - 1) - lengths - ORDER + 1, lengths


def grams(code: np.ndarray, starts: np.ndarray, lengths: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """For each character of each word and its closing edge the number of its ORDER-gram; where words start in them."""
    at = np.cumsum(lengths) - lengths
    here = np.repeat(starts - at, lengths) + np.arange(lengths.sum())
    number = np.zeros(len(here), np.int64)
    for k in range(ORDER):
        number = number * base + code[here + k]
    return number, at


def beginnings(code: np.ndarray, starts: np.ndarray, lengths: np.ndarray, k: int, before: np.ndarray) -> np.ndarray:
    """Hashes of the words' first k characters from those of their first k - 1."""
    with np.errstate(over="ignore"):
        h = (before ^ (code[starts + ORDER - 2 + k] + 1).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))


def kneser_ney(counts: np.ndarray) -> np.ndarray:
    """Log-probabilities: class x ORDER-gram. counts: the same shape, continuation counts at the top order.

    A lower order's counts are continuation counts: how many characters come
    before, in either class together, so both classes fall back to the same.
    """
    classes, size = counts.shape
    base = round(size ** (1 / ORDER))
    lower = np.full((1, base), 1.0 / base)

    def step(n: np.ndarray, lower: np.ndarray) -> np.ndarray:
        # contexts that end alike share a row of the lower order
        n = n.reshape(-1, len(lower), base).astype(float)
        total = n.sum(2, keepdims=True)
        weight = np.where(total > 0, DISCOUNT * np.minimum(n, 1).sum(2, keepdims=True) / np.maximum(total, 1), 1.0)
        n -= DISCOUNT
        np.maximum(n, 0, out=n)
        n /= np.maximum(total, 1)
        n += weight * lower
        return n.reshape(-1, base)

    for order in range(1, ORDER):
        seen = (counts.sum(0) > 0).reshape(-1, base ** (order + 1)).any(0)
        lower = step(seen.reshape(base, -1).sum(0), lower)
    out = np.empty((classes, size), np.float32)
    for c in range(classes):
        out[c] = np.log(step(counts[c], lower)).reshape(-1)
    return out


def word_ratios(words: list[str], model: Model) -> np.ndarray:
    """For each word the toxic less the ordinary log-likelihood, and the characters it counts for."""
    return word_values(words, model)[:, :2]


def word_values(words: list[str], model: Model) -> np.ndarray:
    """For each word its ratio, the characters it counts for, and 1 if stored beginnings are needed for the ratio.

    The top order conditions each character on all of the word before it (up to
    LONGEST characters); it falls back to the ORDER-gram of the class.
    """
    if not words:
        return np.empty((0, 3))
    code, starts, lengths = codes(words, model.chars)
    number, at = grams(code, starts, lengths, len(model.chars) + 2)
    low = model.tables[:, number]
    ratio = (low[1] - low[0]).astype(float)
    asks = np.zeros(len(words), bool)
    live = np.arange(len(words))
    h = np.zeros(len(words), np.uint64)
    slot = np.searchsorted(model.beginnings, h[:1])[:1].repeat(len(words))
    for k in range(1, LONGEST + 1):
        keep = lengths[live] >= k
        live, h, slot = live[keep], h[keep], slot[keep]
        if not len(live):
            break
        h = beginnings(code, starts[live], lengths[live], k, h)
        found = np.minimum(np.searchsorted(model.beginnings, h), len(model.beginnings) - 1)
        hit = model.beginnings[found] == h
        place = at[live] + k - 1
        logs = []
        for c in (0, 1):
            total = model.seen[c, slot].astype(float)
            n = np.where(hit, model.seen[c, found], 0)
            back = np.exp(low[c, place])
            p = np.where(total > 0, np.maximum(n - DISCOUNT, 0) / np.maximum(total, 1) + np.where(total > 0, (DISCOUNT * model.follow[c, slot] + model.lost[c, slot]) / np.maximum(total, 1), 1) * back, back)
            logs.append(np.log(p))
        ratio[place] = logs[1] - logs[0]
        if model.open is not None:
            asks[live[~hit & model.open[slot]]] = True
        live, h, slot = live[hit], h[hit], found[hit]
    return np.stack([np.round(np.add.reduceat(ratio, at) / GRAIN) * GRAIN, lengths, asks], 1)


def starts_of(words: list[str], chars: str) -> np.ndarray:
    """Hashes of the words' first START characters, their closing edge included; the words have so many."""
    code, starts, lengths = codes(words, chars)
    h = np.zeros(len(words), np.uint64)
    for k in range(1, START + 1):
        h = beginnings(code, starts, lengths, k, h)
    return h.view(np.int64)


def partial_counts(words: list[str], toxic: np.ndarray, n: np.ndarray, chars: str) -> Iterator[tuple[np.ndarray | None, ...]]:
    """Counts of some distinct rows word, toxic, n: columns hash, parent, gram, late, start, n0, n1.

    A beginning has its hash, that of one character less, its last ORDER-gram, the
    hash of its first START characters if it has more, and how often it occurs in either class. Beyond the longest beginning there is
    only the ORDER-gram (late) and in how many words it occurs.
    """
    code, starts, lengths = codes(words, chars)
    h = np.zeros(len(words), np.uint64)
    begin = np.zeros(len(words), np.uint64)
    live = np.arange(len(words))
    number, at = grams(code, starts, lengths, len(chars) + 2)
    for k in range(1, LONGEST + 1):
        keep = lengths[live] >= k
        live, h = live[keep], h[keep]
        if not len(live):
            break
        before = h
        h = beginnings(code, starts[live], lengths[live], k, h)
        if k <= START:
            begin[live] = h
        unique, first, back = np.unique(h, return_index=True, return_inverse=True)
        got = [np.bincount(back, np.where(toxic[live] == c, n[live], 0), len(unique)).astype(np.int64) for c in (0, 1)]
        yield unique.view(np.int64), before[first].view(np.int64), number[at[live] + k - 1][first], None, begin[live][first].view(np.int64) if k > START else None, *got
    late = np.arange(len(number)) - np.repeat(at, lengths) >= LONGEST
    if late.any():
        unique, back = np.unique(number[late], return_inverse=True)
        of = np.repeat(toxic, lengths)[late]
        yield None, None, None, unique, None, *(np.bincount(back, of == c, len(unique)).astype(np.int64) for c in (0, 1))


def least_count(begun: DataFrame, most: int) -> int:
    """The least count, 2 or more, that at most so many beginnings reach; counts are told apart in eighths of a doubling."""
    step = F.floor(F.log2(F.col("n0") + F.col("n1")) * 8).cast("int")
    sizes = begun.where("n0 + n1 >= 2").groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min(F.col("n0") + F.col("n1")).alias("least")).orderBy(F.desc("step")).collect()
    total, least = 0, None
    for r in sizes:
        total += r["n"]
        if total > most:
            return least or r["least"] + 1
        least = r["least"]
    return 2


def count(words: DataFrame, chars: str, totals: list[int], scratch: common.Scratch) -> Model:
    """The models of both classes from distinct rows toxic, word, n; totals: the sums of n.

    Tasks count, Spark adds up, over all words. The driver sees the most frequent
    beginnings, up to a fixed number of them, and a table of ORDER-grams whose size is
    fixed. Other beginnings seen twice or more are stored with the same columns. One that
    was seen once has its whole count as discount: it falls back to the ORDER-gram, so
    probabilities still sum to one.
    """
    names = ["hash", "parent", "gram", "late", "start", "n0", "n1"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("toxic", "n"))
            for columns in partial_counts(batch.column("word").to_pylist(), toxic, n, chars):
                rows = len(columns[-1])
                yield pa.RecordBatch.from_arrays([pa.nulls(rows, pa.int64()) if c is None else pa.array(c, pa.int64()) for c in columns], names)

    parts = words.select("toxic", "word", "n").mapInArrow(run, ", ".join(f"{c} long" for c in names))
    found = scratch.table(parts.groupBy("hash", "late").agg(*(F.min(c).alias(c) for c in ("parent", "gram", "start")), *(F.sum(c).alias(c) for c in ("n0", "n1"))))
    has = [F.sum((F.col(c) > 0).cast("long")).alias(f) for c, f in (("n0", "f0"), ("n1", "f1"))]
    begun = found.where("hash is not null")
    least = least_count(begun.where("start is not null"), BEGINNINGS)
    counts = F.col("n0") + F.col("n1") >= 2
    held = F.col("start").isNull() | (F.col("n0") + F.col("n1") >= least)
    children = [x for c, f, l in (("n0", "f0", "l0"), ("n1", "f1", "l1")) for x in (F.sum((counts & (F.col(c) > 0)).cast("long")).alias(f), F.sum(F.when(counts, 0).otherwise(F.col(c))).alias(l))]
    follow = begun.groupBy(F.col("parent").alias("hash")).agg(*children, F.max(counts & ~held).alias("open"))
    # the empty beginning is no child of any, so it is only found as a parent
    root = words.sparkSession.createDataFrame([(0, None, *totals)], "hash long, start long, n0 long, n1 long")
    kept = begun.where(counts).select("hash", "start", "n0", "n1").unionByName(root).withColumn("held", held)
    joined = kept.join(follow, "hash", "left").select(*kept.columns, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("f0", "f1", "l0", "l1")), F.coalesce("open", F.lit(False)).alias("open"))
    stored = scratch.table(joined) if least > 2 else None
    table = (stored if least > 2 else joined).where("held").drop("start", "held").toArrow()
    # what lies beyond the longest beginning counts as it occurs
    late = found.where("late is not null").select(F.col("late").alias("gram"), F.col("n0").alias("f0"), F.col("n1").alias("f1"))
    low = begun.groupBy("gram").agg(*has).unionByName(late).groupBy("gram").agg(F.sum("f0").alias("f0"), F.sum("f1").alias("f1")).toArrow()
    top = np.zeros((2, (len(chars) + 2) ** ORDER), np.float32)
    for c in (0, 1):
        top[c, low["gram"].to_numpy()] = low[f"f{c}"].to_numpy()
    keys = table["hash"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    seen = np.stack([table[c].to_numpy()[order].astype(np.float32) for c in ("n0", "n1")])
    following = np.stack([table[c].to_numpy()[order].astype(np.int16) for c in ("f0", "f1")])
    lost = np.stack([table[c].to_numpy()[order].astype(np.float32) for c in ("l0", "l1")])
    scratch.drop(found)
    model = Model(chars, kneser_ney(top), keys[order], seen, following, lost, np.zeros(TOP + 3), 0.0)
    if stored is not None:
        model.open, model.stored, model.stored_rows = table["open"].to_numpy()[order].astype(bool), stored.scratch_path, stored.where("not held").count()
    return model


def with_stored(model: Model, batches: list[pa.RecordBatch]) -> Model:
    """The model with these stored beginnings beside those it holds: it asks for none more."""
    table = pa.Table.from_batches(batches)
    keys = np.concatenate([model.beginnings, table["hash"].to_numpy().view(np.uint64)])
    order = np.argsort(keys)
    both = lambda held, names: np.concatenate([held, np.stack([table[c].to_numpy().astype(held.dtype) for c in names])], 1)[:, order]
    return replace(model, beginnings=keys[order], seen=both(model.seen, ("n0", "n1")), follow=both(model.follow, ("f0", "f1")), lost=both(model.lost, ("l0", "l1")), open=None)


def means(values: np.ndarray) -> np.ndarray:
    """Ratios by length: a short word counts as if it had the usual length, as chance weighs more on it."""
    return (values[:, 0].astype(np.float32) / np.maximum(values[:, 1], USUAL).astype(np.float32)).astype(float)


def asked_values(words: DataFrame, model: Model, broadcast) -> DataFrame:
    """word, ratio, mean of distinct words (word, start) that need stored beginnings.

    Both sides are dealt by the first START characters. A task holds the stored
    beginnings of one bucket; words stream through.
    """
    spark = words.sparkSession
    table = spark.read.schema("hash long, start long, n0 long, n1 long, held boolean, f0 long, f1 long, l0 long, l1 long").parquet(model.stored).where("not held").drop("held")
    bucket = F.pmod(F.xxhash64("start"), F.lit(-(-model.stored_rows // BUCKET))).alias("bucket")
    rows = table.select(bucket, F.lit(0).alias("kind"), "hash", "n0", "n1", "f0", "f1", "l0", "l1").unionByName(words.select(bucket, F.lit(1).alias("kind"), "word"), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, own = None, [], None
        for batch in batches:
            buckets, kinds = (batch.column(c).to_numpy() for c in ("bucket", "kind"))
            ends = [0, *(np.flatnonzero((np.diff(buckets) != 0) | (np.diff(kinds) != 0)) + 1).tolist(), len(buckets)]
            for a, b in zip(ends[:-1], ends[1:], strict=True):
                part = batch.slice(a, b - a)
                if buckets[a] != now:
                    now, held, own = buckets[a], [], None
                if not kinds[a]:
                    held.append(part)
                    continue
                if own is None:
                    own, held = with_stored(broadcast.value, held) if held else replace(broadcast.value, open=None), []
                values = word_values(part.column("word").to_pylist(), own)[:, :2]
                yield pa.RecordBatch.from_arrays([part.column("word"), pa.array(values[:, 0].astype(np.float32).astype(float)), pa.array(means(values))], ["word", "ratio", "mean"])

    return rows.repartition("bucket").sortWithinPartitions("bucket", "kind").mapInArrow(run, "word string, ratio double, mean double")


def partial(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[list[float]]]:
    """Of each document: the sum of ratios, the characters, and the TOP highest means of different words, but for words that ask.

    values: a row for each word; counts: words of each document. Characters are those of all words.
    """
    sums, chars, tops = np.zeros(len(counts)), np.zeros(len(counts)), [[] for _ in counts]
    starts = np.cumsum(counts) - counts
    has = np.flatnonzero(counts)
    if not len(has):
        return sums, chars, tops
    sure = values[:, 2] == 0
    sums[has] = np.add.reduceat(np.where(sure, values[:, 0], 0).astype(float), starts[has])
    chars[has] = np.add.reduceat(values[:, 1].astype(float), starts[has])
    mean = np.where(sure, means(values), -np.inf)
    for _ in range(TOP):
        top = np.maximum.reduceat(mean, starts[has])
        for i, x in zip(has.tolist(), top.tolist(), strict=True):
            if x > -np.inf:
                tops[i].append(x)
        mean = np.where(mean == np.repeat(top, counts[has]), -np.inf, mean)
    return sums, chars, tops


def features() -> Column:
    """Bias, mean per character, the TOP highest means of different words, log of the words; columns ratio, chars, tops, words."""
    out = [F.lit(1.0), F.when(F.col("toxicity_words") > 0, F.col("toxicity_ratio") / F.col("toxicity_chars")).otherwise(0.0)]
    best = F.lit(0.0)
    for k in range(TOP):
        best = F.when(F.col("toxicity_words") > 0, F.coalesce(F.get("toxicity_tops", F.lit(k)), F.least(best, F.lit(0.0)))).otherwise(0.0)
        out.append(best)
    return F.array(*out, F.when(F.col("toxicity_words") > 0, F.log("toxicity_words")).otherwise(0.0))


def split_words(text: str | None) -> list[str]:
    """Words in small letters, without the marks around them."""
    return [w for w in [w.strip(MARKS) for w in text.lower().split()] if w] if text else []


def _scores(key: str, broadcast) -> common.WordScores:
    model = broadcast.value
    return common.kept(f"toxicity {key}", lambda: common.WordScores(lambda words: word_values(words, model), 3))


PARTIAL = {"toxicity_ratio": pa.float64(), "toxicity_chars": pa.float64(), "toxicity_tops": pa.list_(pa.float64()), "toxicity_words": pa.int64(), "toxicity_asked": pa.list_(pa.struct([("word", pa.string()), ("start", pa.int64()), ("n", pa.int64())]))}
ASKED = "array<struct<word:string,start:bigint,n:bigint>>"


def document_features(docs: DataFrame, model: Model, broadcast, key: str, keep_text: bool = False) -> DataFrame:
    """The features of each document beside its other columns."""
    kept = [c for c in docs.columns if keep_text or c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, chars = _scores(key, broadcast), broadcast.value.chars
        for batch in common.small(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in common.slices(texts):
                cut = [split_words(t) for t in texts[a:b]]
                words = [w for some in cut for w in some]
                values, counts = scores.of(words), np.array([len(w) for w in cut])
                asked = [[] for _ in cut]
                places = np.flatnonzero(values[:, 2])
                if len(places):
                    of = np.searchsorted(np.cumsum(counts), places, side="right").tolist()
                    found = Counter(zip(of, map(words.__getitem__, places.tolist()), strict=True))
                    for ((i, w), n), h in zip(found.items(), starts_of([w for _, w in found], chars).tolist(), strict=True):
                        asked[i].append({"word": w, "start": h, "n": n})
                sums, lengths, tops = partial(values, counts)
                columns = [pa.array(c, t) for c, t in zip((sums, lengths, tops, counts, asked), PARTIAL.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in kept), *columns], [*kept, *PARTIAL])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in kept)
    out = docs.mapInArrow(run, f"{schema}, toxicity_ratio double, toxicity_chars double, toxicity_tops array<double>, toxicity_words long, toxicity_asked {ASKED}")
    if model.stored:
        out = with_asked(out, model, broadcast)
    return out.select(*kept, features().alias(FEATURES))


def with_asked(docs: DataFrame, model: Model, broadcast) -> DataFrame:
    """docs with the values of the words that they ask for added in; rows are told apart by a number of their own."""
    rows = common.Scratch(docs.sparkSession).table(docs.withColumn("toxicity_row", F.monotonically_increasing_id()))
    asked = rows.select("toxicity_row", F.explode("toxicity_asked").alias("a")).select("toxicity_row", "a.*")
    values = asked_values(asked.select("word", "start").distinct(), model, broadcast)
    more = asked.select("toxicity_row", "word", "n").join(values.hint("merge"), "word").groupBy("toxicity_row").agg(F.sum(F.col("ratio") * F.col("n")).alias("toxicity_more"), F.collect_set("mean").alias("toxicity_means"))
    both = rows.drop("toxicity_asked").join(more.select("toxicity_row", "toxicity_more", F.slice(F.sort_array("toxicity_means", False), 1, TOP).alias("toxicity_means")).hint("merge"), "toxicity_row", "left")
    tops = F.slice(F.sort_array(F.array_distinct(F.concat("toxicity_tops", F.coalesce("toxicity_means", F.array().cast("array<double>")))), False), 1, TOP)
    return both.withColumns({"toxicity_ratio": F.col("toxicity_ratio") + F.coalesce("toxicity_more", F.lit(0.0)), "toxicity_tops": tops})


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weighted logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (y - p)) - ridge * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, most: int = MOST_OF_CLASS) -> Model:
    """Fit the curve on a third of the labelled documents, at most ``most`` of each class, and count in all others.

    labels: doc_id, toxic (0 or 1).
    """
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    sizes = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    prior = sizes.get(1, 0) / total if total else 0.0
    third = F.pmod(common.hash_order(F.lit("half"), F.col("doc_id")), F.lit(3)) == 0
    scratch = common.Scratch(spark)
    # the curve's sample is bounded by its parameter, so it may be broadcast
    chosen = scratch.table(common.bounded_sample(labels.where(third), "doc_id", "toxic", most).dropDuplicates())
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sample = scratch.table(texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text"))
    counted = labels.distinct().join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_anti")
    # labels grow with the documents: the same join at every size
    words = scratch.table(
        texts.join(counted.hint("merge"), "doc_id")
        .select("toxic", F.explode(F.split(F.lower("text"), BLANKS)).alias("word"))
        .select("toxic", F.btrim("word", F.lit(MARKS)).alias("word"))
        .where("word <> ''")
        .groupBy("toxic", "word")
        .agg(F.count("*").alias("n"))
    )
    totals = {r["toxic"]: r["n"] for r in words.groupBy("toxic").agg(F.sum("n").alias("n")).collect()}
    if len(totals) < 2:
        return Model("", *[np.zeros(0)] * 5, np.zeros(TOP + 3), prior)
    letters = words.select("n", F.explode(F.split("word", "")).alias("c")).where("c <> ''").groupBy("c").agg(F.sum("n").alias("n"))
    chars = "".join(sorted(r["c"] for r in letters.orderBy(F.desc("n"), "c").limit(CHARS).collect()))
    model = count(words, chars, [totals[0], totals[1]], scratch)
    model.prior = prior
    broadcast = spark.sparkContext.broadcast(model)
    fit = document_features(sample, model, broadcast, f"{model.key}-fit").select("toxic", FEATURES, "doc_id").toPandas().sort_values(["doc_id", "toxic"])
    y = fit["toxic"].to_numpy(float)
    if 0 < y.sum() < len(y):
        weight = np.where(y == 1, prior * len(y) / y.sum(), (1 - prior) * len(y) / (len(y) - y.sum()))
        model.curve = logistic(np.stack(fit[FEATURES].tolist()), y, weight)
    for done in (chosen, sample, words):
        scratch.drop(done)
    return model


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD, keep_text: bool = False) -> DataFrame:
    """The columns of docs (text if wanted) but any score and predicted, with those two anew."""
    spark = docs.sparkSession
    docs = docs.drop("score", "predicted", FEATURES)
    if not model.chars:
        out = docs if keep_text else docs.drop("text")
        return out.select("*", F.lit(model.prior).cast("double").alias("score"), F.lit(int(model.prior >= threshold)).alias("predicted"))
    out = document_features(docs, model, spark.sparkContext.broadcast(model), model.key, keep_text)
    linear = F.lit(0.0)
    for i, w in enumerate(model.curve):
        linear = linear + F.lit(float(w)) * F.col(FEATURES)[i]
    probability = F.round(1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), linear)))), 9)
    return out.withColumn("score", probability).withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop(FEATURES)
