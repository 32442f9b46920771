"""Phrase collocation mining: HAT-trie counts, cut scores, and the best phrases of each language.

A task counts word sequences in a trie over its own word numbers: a container
is a hash table of all sequences below a node and, grown too large, bursts into
containers that branch on the next bits of a word's number. When a task's tries hold too much, the largest subtrees are
spilled as sorted runs; Spark's shuffle brings the runs of a prefix together
(the tail is part of the key, so a frequent prefix is spread) and adds them up.

Levels: words, then pairs of frequent words, then triples of two frequent pairs,
since no phrase is more frequent than its parts. What is frequent reaches the
tasks as a bit table of bounded size. A bit set by chance only lets more be
counted, never less: the counts decide.

Defined cases: a null text is empty, a null language ``und``; texts without words
give nothing; a repeated row counts as often as it is there; a text of any
length is read in windows with the words before carried over; an empty table
gives no rows; doc_id and other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import common

#: Marks that end a piece; they and the blanks are fixed values.
BREAKS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
LEAST = 10
SUPPRESS = 50
BEST = 2000
UNKNOWN = "und"
#: Bits of a word number; a task starts anew before it runs out of numbers.
BITS = 21
MOST_WORDS = 500_000
#: Bits of a word's number that one level of the trie branches on.
DIGIT = 5
#: Sequences in a container before it bursts, and in all tries of a task before subtrees are spilled.
BURST = 1 << 17
MOST_SEQUENCES = 2_500_000
#: Bytes of text that are split at once.
WINDOW = 1 << 20
#: Bits of the table for each frequent sequence, and the fewest and most in all (16 MB).
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 1 << 20, 1 << 27
RUNS = "lang string, head string, tail string, f long"

_TABLE = bytes(ord("\n") if c in BREAKS else ord(" ") if c in BLANKS else c + 32 if 65 <= c <= 90 else c for c in range(256))


class Container:
    """A hash table of sequences and counts with open addressing, at most half full; a batch is put in by array operations."""

    def __init__(self, slots: int = 1024):
        self.size = 0
        self.keys, self.counts = np.full(slots, -1, np.int64), np.zeros(slots, np.int64)

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """keys: distinct."""
        slots = len(self.keys)
        while slots < 2 * (self.size + len(keys)):
            slots *= 2
        if slots > len(self.keys):
            old = self.items()
            self.keys, self.counts = np.full(slots, -1, np.int64), np.zeros(slots, np.int64)
            self.size = 0
            self._put(*old)
        self._put(keys, counts)

    def _put(self, keys: np.ndarray, counts: np.ndarray) -> None:
        mask = len(self.keys) - 1
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        at = (spread >> np.uint64(64 - mask.bit_length())).astype(np.int64) if mask else np.zeros(len(keys), np.int64)
        new = 0
        while len(keys):
            free = np.flatnonzero(self.keys[at] == -1)
            # of those that find the same free slot one stays, the others see it there
            self.keys[at[free]] = keys[free]
            mine = self.keys[at] == keys
            new += int(mine[free].sum())
            self.counts[at[mine]] += counts[mine]
            rest = ~mine
            keys, counts, at = keys[rest], counts[rest], (at[rest] + 1) & mask
        self.size += new

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        used = self.keys >= 0
        return self.keys[used], self.counts[used]


class HatTrie:
    """Counts of sequences of n word numbers, packed into whole numbers with the first word on top.

    A node is a container, or branches on some bits of a word's number, the first
    word's before the second's: what lies below shares a part of its prefix.
    """

    def __init__(self, n: int, level: int = 0):
        levels = -(-BITS // DIGIT)
        self.n, self.level = n, level
        # lower bits of a number come first: words are numbered as they come, so those are dealt evenly
        self.shift = BITS * (n - 1 - level // levels) + DIGIT * (level % levels)
        self.low = (1 << min(DIGIT, BITS - DIGIT * (level % levels))) - 1
        self.last = level >= n * levels
        self.table: Container | None = Container()
        self.children: dict[int, HatTrie] = {}
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add to the counts of distinct keys."""
        if self.table is not None:
            self.table.add(keys, counts)
            self.size = self.table.size
            if self.size > BURST and not self.last:
                keys, counts = self.table.items()
                self.table = None
                self._deal(keys, counts)
        else:
            self._deal(keys, counts)

    def _deal(self, keys: np.ndarray, counts: np.ndarray) -> None:
        digit = (keys >> self.shift & self.low).astype(np.uint8)
        order = np.argsort(digit, kind="stable")
        keys, counts, digit = keys[order], counts[order], digit[order]
        starts = np.flatnonzero(np.concatenate([[True], digit[1:] != digit[:-1]]))
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True):
            d = int(digit[a])
            if d not in self.children:
                self.children[d] = HatTrie(self.n, self.level + 1)
            self.children[d].add(keys[a:b], counts[a:b])
        self.size = sum(c.size for c in self.children.values())

    def items(self) -> tuple[np.ndarray, np.ndarray]:
        if self.table is not None:
            return self.table.items()
        parts = [c.items() for c in self.children.values()]
        return np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts])

    def spill(self, keep: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out whole subtrees, the largest first, until at most so many sequences stay."""
        if self.table is not None:
            if self.size > keep:
                yield self.table.items()
                self.table, self.size = Container(), 0
            return
        for d in sorted(self.children, key=lambda d: -self.children[d].size):
            if self.size <= keep:
                break
            child = self.children.pop(d)
            self.size -= child.size
            yield child.items()
        if not self.children:
            self.table = Container()


def hash_longs(values: np.ndarray, seed: np.ndarray | int) -> np.ndarray:
    """XXH64 of 64-bit numbers, as Spark's xxhash64 has it for a column of longs."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))
    turn = lambda x, n: (x << np.uint64(n)) | (x >> np.uint64(64 - n))
    with np.errstate(over="ignore"):
        h = np.asarray(seed, np.uint64) + p5 + np.uint64(8)
        h = h ^ (turn(values * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))


class BitTable:
    """Which hashes may be among those put in; two bits each."""

    def __init__(self, bits: int, blocks: dict[int, bytes]):
        self.bits = bits
        self.table = np.zeros(bits // 8, np.uint8)
        for k, block in blocks.items():
            self.table[k * 4096 : k * 4096 + 4096] = np.frombuffer(block, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        low = np.uint64(self.bits - 1)
        out = np.ones(len(hashes), bool)
        for h in (hashes, hashes >> np.uint64(34)):
            at = h & low
            out &= (self.table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def bit_table(frequent: DataFrame, key: Column) -> BitTable:
    """Made in Spark in blocks of 4 KB; at most MOST_BITS / 8 bytes reach the driver."""
    bits = LEAST_BITS
    while bits < min(BITS_EACH * frequent.count(), MOST_BITS):
        bits *= 2
    hashes = frequent.select(key.alias("h"))
    places = hashes.select(F.explode(F.array(*[h.bitwiseAND(F.lit(bits - 1)) for h in (F.col("h"), F.shiftrightunsigned("h", 34))])).alias("at"))
    # (blocks of 32768 bits; bit numbers in a block count from the lowest bit of the first byte)
    blocks = places.groupBy(F.shiftright("at", 15).alias("block")).agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(F.lit(32767))).alias("bytes"))
    return BitTable(bits, {r["block"]: bytes(r["bytes"]) for r in blocks.toLocalIterator()})


class Words(dict):
    """word -> number, given on first sight; 0 is the end of a piece."""

    def __init__(self):
        super().__init__()
        self[b"."] = 0
        self.listed = [b"."]

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self.listed)
        self.listed.append(word)
        return n


def windows(data: bytes) -> Iterator[bytes]:
    """Parts of about a megabyte that end between words."""
    at = 0
    while at < len(data):
        end = at + WINDOW
        if end < len(data):
            found = re.compile(b"[ \n]").search(data, end)
            end = found.end() if found else len(data)
        yield data[at:end]
        at = end


class Counter:
    """The sequences of n words of one language, as a task counts them."""

    def __init__(self, lang: str, n: int, frequent: BitTable | None):
        self.lang, self.n, self.frequent = lang, n, frequent
        self.words, self.trie = Words(), HatTrie(n)
        self.hashes, self.hashed, self.total = np.zeros(1024, np.uint64), 1, 0
        self.ranked: tuple[pa.Array, np.ndarray] | None = None
        self.begin()

    def _hash_new(self) -> None:
        """Spark's xxhash64(lang, word) of the words that came since."""
        new = len(self.words.listed)
        if new > len(self.hashes):
            self.hashes = np.concatenate([self.hashes[: self.hashed], np.zeros(2 * new - self.hashed, np.uint64)])
        seed = xxhash.xxh64_intdigest(self.lang.encode(), 42)
        digest = xxhash.xxh64_intdigest
        self.hashes[self.hashed : new] = [digest(w, seed) for w in self.words.listed[self.hashed :]]
        self.hashed = new

    def begin(self) -> None:
        """The next window starts a text."""
        self.before = np.zeros(0, np.int64)

    def add(self, window: bytes) -> None:
        tokens = window.replace(b"\n", b" . ").split()
        ids = np.fromiter(map(self.words.__getitem__, tokens), np.int64, len(tokens))
        self.total += int((ids > 0).sum())
        ids = np.concatenate([self.before, ids])
        self.before = ids[len(ids) - min(len(ids), self.n - 1) :]
        if len(ids) >= self.n:
            keys = self._keys(ids)
            if len(keys):
                self.trie.add(*np.unique(keys, return_counts=True))

    def renewed(self) -> "Counter":
        """An empty one that goes on where this one stands in its text."""
        out = Counter(self.lang, self.n, self.frequent)
        out.before = np.array([out.words[self.words.listed[k]] for k in self.before.tolist()], np.int64)
        return out

    def _keys(self, ids: np.ndarray) -> np.ndarray:
        n = self.n
        columns = [ids[k : len(ids) - n + 1 + k] for k in range(n)]
        keep = np.logical_and.reduce([c > 0 for c in columns])
        columns = [c[keep] for c in columns]
        if self.frequent is not None and n > 1:
            if self.hashed < len(self.words.listed):
                self._hash_new()
            h = [self.hashes[c] for c in columns]
            parts = h if n == 2 else [hash_longs(b, hash_longs(a, 42)) for a, b in zip(h, h[1:], strict=False)]
            keep = np.logical_and.reduce([self.frequent.has(p) for p in parts])
            columns = [c[keep] for c in columns]
        out = columns[0]
        for c in columns[1:]:
            out = out << BITS | c
        return out

    def _sorted_words(self) -> tuple[pa.Array, np.ndarray]:
        """The words so far, and the place of each in byte order."""
        if self.ranked is None or len(self.ranked[0]) < len(self.words.listed):
            words = pa.array(self.words.listed, pa.binary())
            ranks = np.empty(len(words), np.int64)
            ranks[pc.sort_indices(words).to_numpy()] = np.arange(len(words))
            self.ranked = words.cast(pa.string()), ranks
        return self.ranked

    def run(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """A sorted run: lang, head (all words but the last), tail, count."""
        words, ranks = self._sorted_words()
        ids = [keys >> BITS * k & ((1 << BITS) - 1) for k in range(self.n - 1, -1, -1)]
        order = np.lexsort([ranks[i] for i in reversed(ids)])
        for a in range(0, len(order), 100_000):
            some = order[a : a + 100_000]
            *head, tail = (words.take(pa.array(i[some])) for i in ids)
            first = pa.repeat("", len(some)) if not head else head[0] if len(head) == 1 else pc.binary_join_element_wise(*head, " ")
            yield pa.RecordBatch.from_arrays([pa.repeat(self.lang, len(some)), first, tail, pa.array(counts[some])], ["lang", "head", "tail", "f"])


def runs(docs: DataFrame, n: int, frequent: BitTable | None = None) -> DataFrame:
    """lang, head, tail, f: counts of sequences of n words, by task and spilled subtree; a row without tail for all words of a task."""
    shared = None if frequent is None else docs.sparkSession.sparkContext.broadcast(frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value if shared else None
        counters: dict[str, Counter] = {}
        totals: dict[str, int] = {}

        def emptied(c: Counter, keep: int) -> Iterator[pa.RecordBatch]:
            for keys, counts in c.trie.spill(keep):
                yield from c.run(keys, counts)

        def closed() -> Iterator[pa.RecordBatch]:
            for lang, c in counters.items():
                yield from emptied(c, 0)
                totals[lang] = totals.get(lang, 0) + c.total
                counters[lang] = c.renewed()

        for batch in common.small(batches, 2048):
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("bytes").to_pylist(), strict=True):
                texts.setdefault(lang, []).append(text)
            for lang, some in texts.items():
                counters.setdefault(lang, Counter(lang, n, table)).begin()
                for window in windows(b"\n".join(some).translate(_TABLE)):
                    counters[lang].add(window)
                    if sum(c.trie.size for c in counters.values()) > MOST_SEQUENCES:
                        for c in counters.values():
                            yield from emptied(c, c.trie.size // 2)
                    if sum(len(c.words) for c in counters.values()) > MOST_WORDS:
                        yield from closed()
        yield from closed()
        if n == 1 and totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals)), pa.repeat("", len(totals)), pa.nulls(len(totals), pa.string()), pa.array(list(totals.values()))], ["lang", "head", "tail", "f"])

    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), data.alias("bytes")).where(F.octet_length("bytes") > 0).mapInArrow(count, RUNS)


def merged(found: DataFrame, least: int) -> DataFrame:
    """The runs added up by partition of prefix and tail; what is at least so frequent, and the totals."""
    dealt = found.repartition("lang", "head", "tail")
    total = dealt.groupBy("lang", "head", "tail").agg(F.sum("f").alias("f"))
    return total.where(F.col("tail").isNull() | (F.col("f") >= least)).select("lang", "head", "tail", "f")


def counted(docs: DataFrame, least: int, scratch: common.Scratch) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(totals, words, pairs, triples), each of the frequent ones with its count f."""
    first = scratch.table(merged(runs(docs, 1), least))
    words = first.where("tail is not null").select("lang", F.col("tail").alias("w1"), "f")
    table = bit_table(words, F.xxhash64("lang", "w1"))
    second = scratch.table(merged(runs(docs, 2, table), least))
    pairs = second.select("lang", F.col("head").alias("w1"), F.col("tail").alias("w2"), "f")
    table = bit_table(pairs, F.xxhash64(F.xxhash64("lang", "w1"), F.xxhash64("lang", "w2")))
    third = scratch.table(merged(runs(docs, 3, table), least))
    cut = F.split("head", " ")
    triples = third.select("lang", cut[0].alias("w1"), cut[1].alias("w2"), F.col("tail").alias("w3"), "f")
    return first.where("tail is null").select("lang", F.col("f").alias("n")), words, pairs, triples


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (l * r)), exact for counts of up to 15 digits."""
    big = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * big(a) * big(a), big(left) * big(right))


def mine(docs: DataFrame, best: int = BEST, least: int = LEAST, suppress: int = SUPPRESS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language of docs (text, lang)."""
    totals, words, pairs, triples = counted(docs, least, common.Scratch(docs.sparkSession))
    word = lambda at, name: words.select("lang", F.col("w1").alias(at), F.col("f").alias(name))
    pair = lambda a, b, name: pairs.select("lang", F.col("w1").alias(a), F.col("w2").alias(b), F.col("f").alias(name))
    # pairs inside a frequent enough triple go
    inside = triples.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "f")
    longest = inside.groupBy("lang", "p.w1", "p.w2").agg(F.max("f").alias("longer"))
    two = pairs.withColumnRenamed("f", "a").join(longest, ["lang", "w1", "w2"], "left").where(F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * suppress))
    two = two.join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"])
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", cut_score(F.col("a"), F.col("l"), F.col("r")).alias("score"))
    three = triples.withColumnRenamed("f", "a").join(pair("w1", "w2", "l2"), ["lang", "w1", "w2"]).join(pair("w2", "w3", "r1"), ["lang", "w2", "w3"]).join(word("w1", "l1"), ["lang", "w1"]).join(word("w3", "r2"), ["lang", "w3"])
    three = three.withColumn("s1", cut_score(F.col("a"), F.col("l1"), F.col("r1"))).withColumn("s2", cut_score(F.col("a"), F.col("l2"), F.col("r2")))
    early = F.col("s1") <= F.col("s2")
    three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    top = two.unionByName(three).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return top.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
