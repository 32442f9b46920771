"""SentencePiece encoding and decoding as a relational lattice.

A text is cut into words before each run of word marks, and a word into parts
where no piece holds both neighbours, so that no edge can cross. Parts are
distinct rows, each encoded once: their substrings of bounded length are exploded
and joined to the piece table, the edges found are grouped by part and folded
with Spark's higher-order aggregate.

- Unigram models: Viterbi's fold, the least cost of each place from those after it,
  then forth along the way. A byte-pair file can be read as a unigram model too,
  where a piece costs the logarithm of its rank.
- Byte-pair models: their ids are those of merges, which Viterbi over their scores
  does not give. Their fold takes, step by step, the best edge that spans exactly two
  symbols. The places between symbols are bits of a number, WINDOW of them at most.
  Longer parts are folded in windows, the next from the last but one place of the
  one before: two encodings that share a piece go together there. Should they
  share none, the part is folded as a whole.

Distinct parts are collected for each chunk, the rows of one input partition up to
CHUNK characters. Their cuts come back to the chunk, where each text is encoded
word by word: no word occurrence is ever a row, and no text meets a table that
grows with the corpus.

Defined cases: a null or empty text has no ids; characters without a piece
become those of their bytes, or the unknown id where the model has none; rows
that repeat a document id are encoded one by one; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

MARK = "▁"
#: Characters whose cuts fit the bits of one number.
WINDOW = 48
#: Characters of the texts that share a dictionary of parts.
CHUNK = 1 << 26
#: Documents that are compressed together, at most; a batch has fewer where its bytes are bounded.
PACK = 1024
#: What a character without a piece costs: more than any piece.
UNKNOWN_COST = 50.0
WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass(frozen=True)
class Model:
    """What a model file says; its size bounds all that is broadcast."""

    pieces: tuple[tuple[str, int, float], ...]
    bytes_first: int
    unknown: int
    longest: int
    unigram: bool

    @functools.cached_property
    def ids(self) -> dict[str, int]:
        return {p: i for p, i, _ in self.pieces}

    @functools.cached_property
    def greatest(self) -> int:
        return max([i for _, i, _ in self.pieces] + [self.bytes_first + 255, self.unknown])

    @functools.cached_property
    def kind(self) -> str:
        """The numbers that ids are kept as between stages."""
        return "<u2" if self.greatest < 1 << 16 else "<u4"

    @functools.cached_property
    def written(self) -> np.ndarray:
        """Each id in decimal digits and a comma, zero bytes behind."""
        return np.array([f"{i}," for i in range(self.greatest + 1)], "S")

    def digest(self, ids: bytes) -> str:
        """sha256 of ids (numbers of ``kind``) in decimal digits, joined by commas."""
        if not ids:
            return hashlib.sha256(b"").hexdigest()
        digits = self.written[np.frombuffer(ids, self.kind)].view(np.uint8)
        return hashlib.sha256(digits[digits != 0][:-1]).hexdigest()

    @functools.cached_property
    def names(self) -> list[bytes]:
        """What each id stands for."""
        out = [b"?"] * (self.greatest + 1)
        if self.bytes_first >= 0:
            out[self.bytes_first : self.bytes_first + 256] = [bytes([b]) for b in range(256)]
        for p, i, _ in self.pieces:
            out[i] = p.encode()
        return out

    @functools.cached_property
    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """The class of each character, and which two classes follow one another in a piece."""
        pairs = {p[k : k + 2] for p, _, _ in self.pieces for k in range(len(p) - 1)}
        chars = sorted({c for pair in pairs for c in pair})
        of = np.zeros(0x110000, np.int16)
        of[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        near = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for x, y in pairs:
            near[of[ord(x)], of[ord(y)]] = True
        return of, near

    def cut(self, words: list[str]) -> tuple[list[str], list[int]]:
        """All words (each without its first mark) cut wherever no piece can reach over: the parts end to end, and how many each word has."""
        if not words:
            return [], []
        whole = MARK + MARK.join(words)
        of, near = self.neighbours
        kinds = of[np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), "<u4")]
        starts = np.cumsum([0, *(len(w) + 1 for w in words)])
        open_ = np.concatenate([[True], ~near[kinds[:-1], kinds[1:]]])
        open_[starts[:-1]] = True
        places = np.flatnonzero(open_).tolist()
        counts = np.diff(np.concatenate([[0], np.cumsum(open_)])[starts]).tolist()
        return [whole[a:b] for a, b in zip(places, [*places[1:], len(whole)], strict=True)], counts

    def ids_of(self, part: str, mask: int | None, sizes: list[int] | None) -> list[int]:
        """Ids of the part's pieces, whose places are bits of mask or whose sizes are listed."""
        out, at = [], 0
        if mask is not None:
            places = [i for i in range(1, len(part) + 1) if mask >> i & 1]
        else:
            places = np.cumsum(sizes).tolist()
        for end in places:
            piece = part[at:end]
            found = self.ids.get(piece)
            if found is not None:
                out.append(found)
            else:
                out += [self.bytes_first + b for b in piece.encode("utf-8", "replace")] if self.bytes_first >= 0 else [self.unknown]
            at = end
        return out

    def raw_of(self, ids: list[int]) -> bytes:
        return b"".join(map(self.names.__getitem__, ids))


@functools.lru_cache(maxsize=2)
def load(path: str, unigram: bool = False, ranked: bool = True) -> Model:
    """The model of a file. unigram: encode by the best path; ranked: the file's scores only rank its pieces, which then score less the logarithm of their rank."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.vocab_size()
    plain = [(sp.id_to_piece(i), i, float(sp.get_score(i))) for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    if unigram and ranked:
        plain = [(p, i, -math.log(k + 2)) for k, (p, i, _) in enumerate(sorted(plain, key=lambda x: -x[2]))]
    first = sp.piece_to_id("<0x00>")
    return Model(tuple(plain), first if sp.is_byte(first) else -1, sp.unk_id(), max(len(p) for p, _, _ in plain), unigram)


def text_words(text: str) -> list[str]:
    """The words of a text, each without the mark that all of them begin with."""
    if not text:
        return []
    if MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [w[1:] for w in WORDS.findall(MARK + text.replace(" ", MARK))]


def piece_table(spark: SparkSession, model: Model) -> DataFrame:
    """piece, id, rank (0: merged first), cost (negative logarithm of its likelihood, without the common factor)."""
    import pandas as pd  # only the driver needs it

    ranked = sorted(model.pieces, key=lambda p: -p[2])
    rows = pd.DataFrame([(p, i, k, -s) for k, (p, i, s) in enumerate(ranked)], columns=["piece", "id", "rank", "cost"])
    return spark.createDataFrame(rows, "piece string, id int, rank int, cost double")


# The folds


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once."""
    return F.transform(F.array(value), then)[0]


def bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), at)


def merges(edges: Column, at: Column | None = None) -> Column:
    """Of sorted edges those over two characters or more: bits of both ends and of the places between, counted from ``at``, and their number."""
    first, last = (lambda e: e["first"]) if at is None else (lambda e: e["first"] - at), (lambda e: e["last"]) if at is None else (lambda e: e["last"] - at)
    longer = F.filter(edges, lambda e: e["last"] - e["first"] > 1)
    return F.transform(longer, lambda e, i: F.struct(bit(first(e)).bitwiseOR(bit(last(e))).alias("ends"), (bit(last(e)) - bit(first(e) + 1)).alias("inner"), i.alias("i")))


def spans_two(mask: Column, e: Column) -> Column:
    return (mask.bitwiseAND(e["ends"]) == e["ends"]) & (F.bit_count(mask.bitwiseAND(e["inner"])) == 1)


def merged(found: Column, n: Column) -> Column:
    """The bits of the places between the symbols of n characters after all merges.

    One walk over the edges, best first, is right as long as no merge lets a
    better edge span two symbols; where one does, each step looks for the best.
    """
    every = bit(n + 1) - 1

    def walk(mask: Column, e: Column) -> Column:
        new = mask.bitwiseAND(F.bitwise_not(e["inner"]))
        opened = F.exists(F.slice(found, F.lit(1), e["i"]), lambda f: spans_two(new, f))
        return F.when(mask < 0, mask).when(spans_two(mask, e), F.when(opened, F.lit(-1).cast("long")).otherwise(new)).otherwise(mask)

    def step(mask: Column, _: Column) -> Column:
        best = F.try_element_at(F.filter(found, lambda e: spans_two(mask, e)), F.lit(1))
        return F.coalesce(mask.bitwiseAND(F.bitwise_not(best["inner"])), mask)

    slow = F.aggregate(F.slice(found, F.lit(1), F.greatest(n - 1, F.lit(0))), every, step)
    return let(F.aggregate(found, every, walk), lambda mask: F.when(mask < 0, slow).otherwise(mask))


def lengths(places: Column) -> Column:
    """The lengths between places."""
    return F.zip_with(F.slice(places, F.lit(2), F.greatest(F.size(places) - 1, F.lit(0))), F.slice(places, F.lit(1), F.greatest(F.size(places) - 1, F.lit(0))), lambda b, a: b - a)


def merged_whole(n: Column, edges: Column) -> Column:
    """The same for any number of characters, with the places as an array."""
    longer = F.sort_array(F.filter(edges, lambda e: e["last"] - e["first"] > 1))

    def step(places: Column, _: Column) -> Column:
        fits = F.filter(longer, lambda e: (F.array_position(places, e["first"]) > 0) & (F.array_position(places, e["last"]) == F.array_position(places, e["first"]) + 2))
        best = F.try_element_at(fits, F.lit(1))
        middle = F.try_element_at(places, (F.array_position(places, best["first"]) + 1).cast("int"))
        return F.when(best.isNull(), places).otherwise(F.array_remove(places, middle))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), F.sequence(F.lit(0), n), step)


def merged_windows(n: Column, blocks: Column, longest: int) -> Column:
    """Places of a long part, window by window; blocks: (block, edges), edges in the block where they begin."""
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("seen"), F.lit(True).alias("good"), F.array(F.array(F.lit(0))).alias("places"))

    def step(s: Column, _: Column) -> Column:
        size = F.least(F.lit(WINDOW), n - s["at"])
        end = s["at"] + size
        near = F.flatten(F.transform(F.filter(blocks, lambda b: (b["block"] * WINDOW < end) & ((b["block"] + 1) * WINDOW > s["at"])), lambda b: b["edges"]))
        inside = F.sort_array(F.filter(near, lambda e: (e["first"] >= s["at"]) & (e["last"] <= end)))

        def after(places: Column) -> Column:
            last = F.when(end >= n, n).otherwise(F.array_max(F.filter(places, lambda p: p <= end - longest)))
            again = F.array_max(F.filter(places, lambda p: p < last))
            good = s["good"] & ((s["seen"] == 0) | (places[1] == s["seen"]))
            return F.struct(again.alias("at"), last.alias("seen"), good.alias("good"), F.concat(s["places"], F.array(F.filter(places, lambda p: (p > s["seen"]) & (p <= last)))).alias("places"))

        mask = let(merges(inside, s["at"]), lambda found: merged(found, size))
        places = let(mask, lambda m: F.transform(F.filter(F.sequence(F.lit(0), size), lambda i: m.bitwiseAND(bit(i)) != 0), lambda p: p + s["at"]))
        return F.when(s["seen"] >= n, s).otherwise(let(places, after))

    steps = F.sequence(F.lit(1), F.ceil(n / (WINDOW - 2 * longest)).cast("int"))
    every = F.flatten(F.transform(blocks, lambda b: b["edges"]))
    return let(F.aggregate(F.when(F.lit(2 * longest < WINDOW), steps), start, step), lambda s: F.when(s["good"] & (s["seen"] >= n), F.flatten(s["places"])).otherwise(merged_whole(n, every)))


def best_lengths(n: Column, blocks: Column, longest: int) -> Column:
    """Viterbi: lengths of the pieces of the path of least cost, the longer first piece in ties.

    The fold goes from the end to the start; the costs of ``longest`` places are
    kept, and for each place the length of its first piece, by blocks. So is the
    way that then leads through them. blocks: (block, edges), edges by where they begin.
    """
    none = F.array().cast("array<array<int>>")
    last = F.floor((n - 1) / WINDOW).cast("int")

    def back(s: Column, k: Column) -> Column:
        top = F.least((k + 1) * WINDOW, n)
        edges = F.flatten(F.transform(F.filter(blocks, lambda b: b["block"] == k), lambda b: F.reverse(b["edges"])))

        def relax(t: Column, e: Column) -> Column:
            # the costs end with that of the place after, or with this place's own
            own = F.size(t["firsts"]) == top - e["first"]
            size = e["last"] - e["first"]

            def compared(cost: Column) -> Column:
                better = F.struct(F.concat(F.slice(t["costs"], F.lit(1), F.size(t["costs"]) - own.cast("int")), F.array(cost)).alias("costs"), F.concat(F.slice(t["firsts"], F.lit(1), F.size(t["firsts"]) - own.cast("int")), F.array(size)).alias("firsts"))
                return F.when(~own | (cost < F.element_at(t["costs"], -1)), better).otherwise(t)

            return let(e["cost"] + F.element_at(t["costs"], -size - own.cast("int")), compared)

        t = F.aggregate(edges, F.struct(s["costs"].alias("costs"), F.array().cast("array<int>").alias("firsts")), relax)
        return let(t, lambda t: F.struct(F.slice(t["costs"], -F.least(F.size(t["costs"]), F.lit(longest)), F.lit(longest)).alias("costs"), F.concat(s["firsts"], F.array(t["firsts"])).alias("firsts")))

    def way(firsts: Column) -> Column:
        def block(s: Column, k: Column) -> Column:
            top = F.least((k + 1) * WINDOW, n)
            here = firsts[last - k]

            def place(t: Column, _: Column) -> Column:
                return F.when(t["at"] < top, let(here[top - 1 - t["at"]], lambda x: F.struct((t["at"] + x).alias("at"), F.concat(t["path"], F.array(x)).alias("path")))).otherwise(t)

            t = F.aggregate(here, F.struct(s["at"].alias("at"), F.array().cast("array<int>").alias("path")), place)
            return let(t, lambda t: F.struct(t["at"].alias("at"), F.concat(s["path"], F.array(t["path"])).alias("path")))

        return F.flatten(F.aggregate(F.sequence(F.lit(0), last), F.struct(F.lit(0).alias("at"), none.alias("path")), block)["path"])

    return let(F.aggregate(F.sequence(last, F.lit(0)), F.struct(F.array(F.lit(0.0)).alias("costs"), none.alias("firsts")), back)["firsts"], way)


# The lattice


def found_edges(parts: DataFrame, model: Model) -> DataFrame:
    """key, part, edge of each piece in the parts (key, part, size).

    For the best path these are all pieces, and characters without one, by their
    places. For merges they are the pieces of two characters or more, best first;
    each part's first character stands for parts that have none.
    """
    starts = parts.select("key", "part", "size", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("first"))
    left = F.least(F.col("size") - F.col("first"), F.lit(model.longest))
    least = F.lit(1) if model.unigram else F.when(F.col("first") == 0, 1).otherwise(2)
    spans = starts.select("key", "part", "first", F.explode(F.when(left >= least, F.sequence(least, left))).alias("n"))
    spans = spans.withColumn("piece", F.substring("part", F.col("first") + 1, F.col("n")))
    table = F.broadcast(piece_table(parts.sparkSession, model).select("piece", "rank", "cost"))
    found = spans.join(table, "piece", "left").where("rank is not null or n = 1")
    last = (F.col("first") + F.col("n")).alias("last")
    edge = F.struct("first", last, F.coalesce("cost", F.lit(UNKNOWN_COST)).alias("cost")) if model.unigram else F.struct(F.coalesce("rank", F.lit(-1)).alias("rank"), "first", last)
    return found.select("key", "part", edge.alias("edge"))


def encode_parts(parts: DataFrame, model: Model) -> DataFrame:
    """part, ids of distinct parts (part, size: its characters): as bytes of numbers, and one byte more where they don't decode to the part."""
    n = F.length("part")
    # a short key before the part: what groups and sorts compare first
    keyed = parts.select(F.xxhash64("part").alias("key"), "part", "size")
    short = found_edges(keyed.where(F.col("size") <= WINDOW), model).groupBy("key", "part").agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    one = F.array(F.struct(F.lit(0).alias("block"), F.col("edges").alias("edges")))
    # longer ones by block first, so that no fold looks through all edges
    edges = found_edges(keyed.where(F.col("size") > WINDOW), model)
    by = edges.groupBy("key", "part", F.floor(F.col("edge.first") / WINDOW).cast("int").alias("block")).agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    long = by.groupBy("key", "part").agg(F.sort_array(F.collect_list(F.struct("block", "edges"))).alias("blocks"))
    # (no null lists on the way to Python: with each row that Arrow's writer measures, it fills the offsets of all nulls since the last list)
    mask = F.lit(None).cast("long") if model.unigram else let(merges(F.col("edges")), lambda found: merged(found, n))
    sizes = best_lengths(n, one, model.longest) if model.unigram else F.array().cast("array<int>")
    long_sizes = best_lengths(n, F.col("blocks"), model.longest) if model.unigram else lengths(merged_windows(n, F.col("blocks"), model.longest))
    out = short.select("part", mask.alias("mask"), sizes.alias("sizes")).unionByName(long.select("part", F.lit(None).cast("long").alias("mask"), long_sizes.alias("sizes")))
    shared = parts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("part", "mask", "sizes")), strict=True)
            ids = []
            for part, mask, sizes in rows:
                found = model.ids_of(part, mask, sizes)
                ids.append(np.array(found, model.kind).tobytes() + (b"" if model.raw_of(found) == part.encode("utf-8", "replace") else b"?"))
            yield pa.RecordBatch.from_arrays([batch.column("part"), pa.array(ids, pa.binary())], ["part", "ids"])

    return out.mapInArrow(run, "part string, ids binary")


# Texts


class Chunks:
    """Numbers the chunks of a partition: its own number, and how many times CHUNK characters were read."""

    def __init__(self):
        self.chars = 0

    def of(self, place: int, text: str) -> int:
        here = (place << 24) + self.chars // CHUNK
        self.chars += len(text)
        return here


def runs(values: list[int], most: int) -> Iterator[tuple[int, int, int]]:
    """Ranges of equal values, of at most so many: value, first, end."""
    start = 0
    for i in range(1, len(values) + 1):
        if i == len(values) or values[i] != values[start] or i - start == most:
            yield values[start], start, i
            start = i


def parts_of(docs: DataFrame, model: Model) -> DataFrame:
    """chunk, part: the distinct parts of each chunk's texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, chunks, now = shared.value, Chunks(), None
        for batch in batches:
            of, found = [], []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            mine = [chunks.of(p, t) for p, t in zip(batch.column("place").to_pylist(), texts, strict=True)]
            for chunk, a, b in runs(mine, 256):
                if chunk != now:
                    now, words, parts = chunk, set(), set()
                new = set().union(*map(text_words, texts[a:b])) - words
                words |= new
                some = set(model.cut(list(new))[0]) - parts
                parts |= some
                found += some
                of += [chunk] * len(some)
            yield pa.RecordBatch.from_arrays([pa.array(of, pa.int64()), pa.array(found, pa.string())], ["chunk", "part"])

    return docs.select(F.spark_partition_id().alias("place"), "text").mapInArrow(run, "chunk long, part string")


def packed_texts(docs: DataFrame) -> DataFrame:
    """chunk, data: documents of a chunk that arrive together, as a compressed Arrow stream of doc_id, text; in the chunks of parts_of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        chunks, pack = Chunks(), zstandard.ZstdCompressor(level=5).compress
        for batch in batches:
            mine = [chunks.of(p, t or "") for p, t in zip(batch.column("place").to_pylist(), batch.column("text").to_pylist(), strict=True)]
            rows, parts, data = batch.select(["doc_id", "text"]), list(runs(mine, PACK)), []
            for _, a, b in parts:
                out = pa.BufferOutputStream()
                with pa.ipc.new_stream(out, rows.schema) as stream:
                    stream.write_batch(rows.slice(a, b - a))
                data.append(pack(out.getvalue()))
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _, _ in parts], pa.int64()), pa.array(data, pa.binary())], ["chunk", "data"])

    return docs.select(F.spark_partition_id().alias("place"), "doc_id", "text").mapInArrow(run, "chunk long, data binary")


class Dictionary:
    """Words of one chunk to their ids, as bytes, from those of its parts."""

    def __init__(self, model: Model):
        self.model = model
        self.parts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.broken_parts: set[str] = set()
        self.broken: set[str] = set()

    def add(self, parts: list[str], ids: list[bytes]) -> None:
        self.parts.update(zip(parts, ids, strict=True))
        for part, b in zip(parts, ids, strict=True):
            if len(b) & 1:
                self.broken_parts.add(part)
                self.parts[part] = b[:-1]

    def learn(self, words: set[str]) -> None:
        # (a set less the keys of a dictionary is a walk over all keys)
        known = self.words
        new = [w for w in words if w not in known]
        parts, counts = self.model.cut(new)
        ids = list(map(self.parts.__getitem__, parts))
        for w, (a, b) in zip(new, itertools.pairwise(itertools.accumulate(counts, initial=0)), strict=True):
            known[w] = ids[a] if b - a == 1 else b"".join(ids[a:b])
            if self.broken_parts and not self.broken_parts.isdisjoint(parts[a:b]):
                self.broken.add(w)


def encode(docs: DataFrame, model: Model, stable: bool = False, digests: bool = False) -> DataFrame:
    """doc_id, ids, whole of every row of docs (doc_id, text); whole: each word was decoded to itself.

    digests: n_ids (long) and ids_sha256, of the ids as numbers joined by commas, in place of ids.

    stable: the rows of a partition are the same whenever docs is read, as those of
    files are. Others are written to the shared folder first.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    common.package_to_executors(docs.sparkSession)
    if not stable:
        docs = common.Scratch(docs.sparkSession).table(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # one exchange by part serves the distinct parts, their lattice, and the way back to the chunks
    # (the join asks for parts that are not null: asked for here, both sides read the same rows)
    parts = parts_of(docs, model).where("part is not null").repartition("part")
    # (the least chunk is only asked for so that both read the same columns, and one exchange;
    # the size comes from the aggregate, as a filter by length would move below the exchange and keep it apart)
    distinct = parts.groupBy("part").agg(F.min("chunk").alias("chunk"), F.max(F.length("part")).alias("size"))
    known = encode_parts(distinct.where("chunk is not null").select("part", "size"), model)
    entries = parts.join(known.hint("merge"), "part").select("chunk", "part", F.col("ids").alias("data"))
    texts = packed_texts(docs).select("chunk", F.lit(None).cast("string").alias("part"), "data")
    # the parts of a chunk come before its texts, which have none
    rows = entries.unionByName(texts).repartition("chunk").sortWithinPartitions("chunk", F.col("part").isNull())

    def listed(of: list[bytes], kind: str) -> pa.Array:
        numbers = np.frombuffer(b"".join(of), kind).astype(np.int32)
        ends = np.cumsum([0, *map(len, of)], dtype=np.int64) // np.dtype(kind).itemsize
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(numbers))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        now, words, unpack = None, None, zstandard.ZstdDecompressor().decompress
        width, digest = np.dtype(shared.value.kind).itemsize, shared.value.digest
        for batch in batches:
            chunks, kinds = batch.column("chunk").to_numpy(), batch.column("part").is_null().to_numpy(zero_copy_only=False)
            ends = [0, *(np.flatnonzero((np.diff(chunks) != 0) | (kinds[1:] != kinds[:-1])) + 1).tolist(), len(chunks)]
            for start, end in itertools.pairwise(ends):
                rows = batch.slice(start, end - start)
                if chunks[start] != now:
                    now, words = chunks[start], Dictionary(shared.value)
                if not kinds[start]:
                    words.add(rows.column("part").to_pylist(), rows.column("data").to_pylist())
                    continue
                for raw in rows.column("data").to_pylist():
                    for docs in common.small(pa.ipc.open_stream(unpack(raw)), 64):
                        cut = [text_words(t or "") for t in docs.column("text").to_pylist()]
                        words.learn(set().union(*cut))
                        ids = [b"".join(map(words.words.__getitem__, c)) for c in cut]
                        found = [pa.array([len(b) // width for b in ids], pa.int64()), pa.array(list(map(digest, ids)), pa.string())] if digests else [listed(ids, shared.value.kind)]
                        whole = pa.array([not words.broken or words.broken.isdisjoint(c) for c in cut], pa.bool_())
                        yield pa.RecordBatch.from_arrays([docs.column("doc_id"), *found, whole], ["doc_id", *names, "whole"])

    kinds = {"n_ids": "long", "ids_sha256": "string"} if digests else {"ids": "array<int>"}
    names = list(kinds)
    return rows.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {', '.join(f'{n} {k}' for n, k in kinds.items())}, whole boolean")


def decode_ids(ids: DataFrame, key: str, model: Model) -> DataFrame:
    """key, text: ids joined to their pieces, bytes put together, marks as blanks again; ids: key, ids."""
    table = piece_table(ids.sparkSession, model).select("id", F.encode("piece", "utf-8").alias("raw"))
    flat = ids.select(key, F.posexplode_outer("ids").alias("at", "id"))
    byte = F.col("id") - model.bytes_first
    is_byte = (model.bytes_first >= 0) & byte.between(0, 255) if model.bytes_first >= 0 else F.lit(False)
    raw = F.when(is_byte, F.unhex(F.lpad(F.hex(byte.cast("long")), 2, "0"))).otherwise(F.col("raw"))
    joined = flat.join(F.broadcast(table), "id", "left").select(key, "at", raw.alias("raw"))
    whole = joined.groupBy(key).agg(F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "raw")))).alias("parts"))
    text = F.decode(F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["raw"])), "")), "utf-8")
    return whole.select(key, F.replace(text, F.lit(MARK), F.lit(" ")).alias("text"))


def decode(encoded: DataFrame, model: Model) -> DataFrame:
    """doc_id, text of rows doc_id, ids; the first blank, added in encoding, goes."""
    rows = encoded.select(F.struct("doc_id", F.monotonically_increasing_id().alias("row")).alias("key"), "ids")
    out = decode_ids(rows, "key", model)
    return out.select("key.doc_id", F.regexp_replace("text", "^ ", "").alias("text"))
