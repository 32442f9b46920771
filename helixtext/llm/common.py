"""What the operators of this subpackage share: tables, held-out rule, bounded samples, scratch tables."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtext.functions import ship

#: Bytes of a batch of rows between Spark and Python, at most, where the session has no lower limit: both sides hold some batches for each running task.
BATCH_BYTES = 4 << 20
BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def package_to_executors(spark: SparkSession) -> None:
    """This package for the executors, and batches of bounded size for the session's Arrow functions."""
    ship.package_to_executors(spark)
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_LIMIT))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(BATCH_LIMIT, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark so that any file system works."""
    package_to_executors(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's text leaves 2 modulo 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir; a folder of one machine would be lost to the others."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return found


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/scratch-{uuid.uuid4().hex}"
        self.n = 0

    def table(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out.scratch_path = path
        return out

    def drop(self, df: DataFrame) -> None:
        """Delete a scratch table that no later step reads."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(name: str, taken: list[str]) -> str:
    """The name, with as many underscores before it as keep it apart from those taken."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def hash_order(*cols: Column) -> Column:
    """A fixed pseudo-random order of rows, the same on every run and partitioning."""
    return F.xxhash64(F.lit(20240229), *cols)


def bounded_sample(ids: DataFrame, key: str, by: str, most: int) -> DataFrame:
    """At most ``most`` rows for each value of ``by``, the first in hash order of ``key``.

    A hash threshold from the counts comes first, so that only about twice the
    bound is ever sorted, however large the table. Rows with a null key or value
    are left out.
    """
    rows = ids.where(F.col(key).isNotNull() & F.col(by).isNotNull())
    counts = {r[by]: r["n"] for r in rows.groupBy(by).agg(F.count("*").alias("n")).collect()}
    parts = []
    for value, n in sorted(counts.items(), key=lambda x: str(x[0])):
        share = min(1.0, 1.5 * (most + 20) / n)
        near = F.pmod(hash_order(F.col(key).cast("string")), F.lit(1_000_003)) < int(share * 1_000_003) + 1
        parts.append(rows.where((F.col(by) == F.lit(value)) & near).orderBy(hash_order(F.col(key).cast("string")), key).limit(most))
    if not parts:
        return rows.limit(0)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class WordIds(dict):
    """word -> number, given on first sight: the words of a task are scored once each."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class WordScores:
    """Scores of distinct words, at most about ``most`` kept; ``score`` maps a list of words to a 2-d array."""

    def __init__(self, score, width: int, most: int = 100_000):
        self.score, self.width, self.most = score, width, most
        self.ids, self.values, self.listed = WordIds(), np.empty((0, width), np.float32), 0

    def of(self, words: list[str]) -> np.ndarray:
        """One row of scores for each word, in order."""
        if len(self.ids) > self.most:
            self.ids, self.values, self.listed = WordIds(), np.empty((0, self.width), np.float32), 0
        at = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        if len(self.ids) > self.listed:
            new = newest(self.ids, len(self.ids) - self.listed)
            # some words at a time: what a score needs beside its result stays small
            parts = [self.score(new[k : k + 20_000]) for k in range(0, len(new), 20_000)]
            got = np.concatenate([p.astype(np.float32).reshape(-1, self.width) for p in parts])
            if len(self.ids) > len(self.values):
                room = np.empty((max(len(self.ids), 2 * len(self.values), 1024), self.width), np.float32)
                room[: self.listed] = self.values[: self.listed]
                self.values = room
            self.values[self.listed : len(self.ids)] = got
            self.listed = len(self.ids)
        return self.values[at]


_KEPT: dict[str, object] = {}


def kept(key: str, make):
    """What a worker process keeps from task to task: one thing at a time, so that operators run one after another don't add up."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def newest(d: dict, n: int) -> list:
    """The last n keys, in order; reversed() reaches them without a walk over all."""
    return list(itertools.islice(reversed(d), n))[::-1]


def small(batches: Iterator, rows: int = 512) -> Iterator:
    """The batches in portions of some rows, so that a task never holds all texts of a batch as strings."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def slices(texts: list[str], chars: int = 500_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many characters; one long text is a range of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > chars:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)
