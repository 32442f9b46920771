"""Packing documents into fixed-length sequences: first-fit decreasing on a tournament tree.

Tokens: the byte-level BPE that the ``tokenizers`` library reads from a file.
The vocabulary is taken from there; a faster encoder of the same ids runs it
between the file's added tokens, which keep their own ids. A document is cut into
runs of ``length`` ids and a rest; each run fills a sequence, the rests are
packed by first-fit decreasing inside randomised groups of documents. The group
is chosen by a hash, so groups are alike in size and need nothing of each other.

Defined cases: a null or empty text is one piece holding the end id alone; a
repeated row is packed once for each time it occurs; an empty table gives no
rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Documents in a randomised group, on average.
GROUP = 1024
LENGTH = 1024
END_ID = 0
#: Distinct chunks whose ids a worker keeps.
KEPT_CHUNKS = 700_000

# Fixed value: the tokenizer's pre-token pattern.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, grp long"


#: What makes a text's blanks irregular: two together, or next to other white space.
IRREGULAR = ("  ", " \n", "\n ", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x1f")
#: And white space outside ASCII.
WIDE = tuple("\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000") + tuple(map(chr, range(0x2000, 0x200B)))


class _First(str):
    """A chunk without a blank before it."""

    __slots__ = ()

    def __hash__(self) -> int:
        return ~str.__hash__(self)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _First) and str.__eq__(self, other)


class _Added(str):
    """An added token of the file, which is no chunk of text."""

    __slots__ = ()

    def __hash__(self) -> int:
        return str.__hash__(self) ^ 1

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _Added) and str.__eq__(self, other)


def chunks_of(text: str) -> list[str]:
    """The text cut before single blanks between visible characters; the blanks themselves are left out.

    The tokenizer's pre-tokens never cross such a place, so the ids of a text are
    those of its chunks in order.
    """
    parts = text.split(" ")
    if not (any(w in text for w in IRREGULAR) or text[:1].isspace() or text[-1:].isspace() or not text.isascii() and any(w in text for w in WIDE)):
        parts[0] = _First(parts[0])
        return parts
    out = [parts[0]]
    for p in parts[1:]:
        last = out[-1]
        if p and last and not p[0].isspace() and not last[-1].isspace():
            out.append(p)
        else:
            out[-1] = last + " " + p
    out[0] = _First(out[0])
    return out


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


class Tokens:
    """Token ids of texts; equal chunks are encoded once.

    New chunks are encoded as one text, and its ids dealt back to them by their
    bytes: every id stands for a fixed number of them.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        known = Tokenizer.from_file(path)
        letters = {c: b for b, c in byte_letters().items()}
        vocabulary = known.get_vocab(with_added_tokens=False)
        ranks = {bytes(letters[c] for c in piece): i for piece, i in vocabulary.items() if all(c in letters for c in piece) and piece not in known.get_added_tokens_decoder().values()}
        special = {str(t) for t in known.get_added_tokens_decoder().values()}
        ranks = {k: i for k, i in ranks.items() if known.id_to_token(i) not in special}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})
        added = known.get_added_tokens_decoder()
        self.added = {t.content: i for i, t in added.items()}
        # of tokens that start together the longest counts; some take the white space beside them
        tokens = sorted(added.values(), key=lambda t: -len(t.content))
        self.cut = re.compile("|".join((r"\s*" if t.lstrip else "") + (r"(?<!\w)" if t.single_word else "") + f"({re.escape(t.content)})" + (r"(?!\w)" if t.single_word else "") + (r"\s*" if t.rstrip else "") for t in tokens)) if tokens else None
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for k, i in ranks.items():
            self.width[i] = len(k)
        self.clear()

    def clear(self) -> None:
        self.ids, self.listed = common.WordIds(), 0
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(0, "<u4"), 0

    def chunks(self, text: str) -> list[str]:
        """The added tokens, and the chunks of what lies between them as of texts of their own."""
        if not any(t in text for t in self.added):
            return chunks_of(text)
        out, done = [], 0
        for m in self.cut.finditer(text):
            if m.start() > done:
                out += chunks_of(text[done : m.start()])
            out.append(_Added(m[m.lastindex]))
            done = m.end()
        return out + chunks_of(text[done:]) if done < len(text) else out

    def _learn(self, new: list[str]) -> None:
        raw = [c.encode("utf-8", "replace") if type(c) is _First else b" " + c.encode("utf-8", "replace") for c in new]
        counts, pools = [], []
        # a chunk without a blank before it can't follow another, so each of them is a text of its own
        run: list[bytes] = []

        def flush() -> None:
            if run:
                ids = np.array(self.encoding.encode_ordinary(b"".join(run).decode("utf-8")), "<u4")
                ends = np.cumsum([len(r) for r in run])
                at = np.searchsorted(np.cumsum(self.width[ids]), ends, side="left") + 1
                counts.append(np.diff(at, prepend=0))
                pools.append(ids)
                run.clear()

        for c, r in zip(new, raw, strict=True):
            if type(c) is _Added:
                flush()
                counts.append(np.array([1]))
                pools.append(np.array([self.added[str(c)]], "<u4"))
            elif type(c) is _First or c[:1].isspace() or c[-1:].isspace() or not c:
                flush()
                ids = np.array(self.encoding.encode_ordinary(r.decode("utf-8")), "<u4")
                counts.append(np.array([len(ids)]))
                pools.append(ids)
            else:
                run.append(r)
        flush()
        counts, pool = np.concatenate(counts), np.concatenate(pools)
        self.first = np.concatenate([self.first, self.used + np.cumsum(counts) - counts])
        self.count = np.concatenate([self.count, counts])
        if self.used + len(pool) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.empty(max(len(pool), self.used), "<u4")])
        self.pool[self.used : self.used + len(pool)] = pool
        self.used += len(pool)

    def of(self, texts: list[str]) -> list[np.ndarray]:
        """For each text its ids as little-endian unsigned 32-bit numbers."""
        if len(self.ids) > KEPT_CHUNKS:
            self.clear()
        cut = [self.chunks(t) for t in texts]
        sizes = np.array([len(c) for c in cut])
        at = np.fromiter(map(self.ids.__getitem__, itertools.chain.from_iterable(cut)), np.int64, int(sizes.sum()))
        if len(self.ids) > self.listed:
            self._learn(common.newest(self.ids, len(self.ids) - self.listed))
            self.listed = len(self.ids)
        n = self.count[at]
        ends = np.cumsum(n)
        flat = self.pool[np.repeat(self.first[at] - ends + n, n) + np.arange(int(ends[-1]))] if len(at) else self.pool[:0]
        stops = np.concatenate([[0], ends])[np.cumsum(sizes)]
        return np.split(flat, stops[:-1])


def tokens_of(path: str) -> Tokens:
    """One for each worker process, which runs many tasks."""
    return common.kept(f"tokens {path}", lambda: Tokens(path))


class FirstFit:
    """First-fit over bins of one capacity; a tournament tree holds the most room below each node.

    The winner's path leads to the leftmost bin with room in log2(bins) steps.
    """

    def __init__(self, capacity: int, most_bins: int):
        self.leaves = 1 << max(0, math.ceil(math.log2(max(1, most_bins))))
        self.room = [capacity] * (2 * self.leaves)
        self.capacity = capacity

    def put(self, size: int) -> tuple[int, int]:
        """The bin and the offset in it."""
        room, node = self.room, 1
        while node < self.leaves:
            node *= 2
            if room[node] < size:
                node += 1
        at = self.capacity - room[node]
        found = node - self.leaves
        room[node] -= size
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
        return found, at


def pack_group(pieces: pd.DataFrame, length: int = LENGTH) -> pd.DataFrame:
    """First-fit decreasing over the pieces of one group: columns bin and offset."""
    order = pieces.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
    tree = FirstFit(length, len(order))
    got = [tree.put(n) for n in order["length"].tolist()]
    return order.assign(bin=[b for b, _ in got], offset=[o for _, o in got])


def tokenize(docs: DataFrame, path: str, groups: int, length: int = LENGTH) -> DataFrame:
    """One row for each piece of each document, with the group it is packed in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = tokens_of(path)
        end = np.array([END_ID], "<u4")
        for batch in batches:
            texts, keys, groups_of = (batch.column(c).to_pylist() for c in ("text", "doc_id", "grp"))
            for a, b in common.slices(texts, 1_000_000):
                rows = []
                for doc_id, grp, ids in zip(keys[a:b], groups_of[a:b], tokens.of(texts[a:b]), strict=True):
                    ids = np.concatenate([ids, end])
                    for start in range(0, len(ids), length):
                        piece = ids[start : start + length]
                        rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids), grp))
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "grp"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    grp = F.pmod(F.xxhash64(F.lit(10), F.col("doc_id"), F.crc32(text.cast("binary"))), F.lit(groups))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), grp.alias("grp")).mapInArrow(run, PIECES)


def pack(docs: DataFrame, path: str, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: a row for each piece."""
    groups = max(1, math.ceil(docs.count() / group))
    pieces = tokenize(docs, path, groups, length)

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pack_group(pdf, length)
        return out.assign(sequence_id=out["grp"] * (1 << 32) + out["bin"]).astype({"doc_id": "Int64"})[
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        ]

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return pieces.groupBy("grp").applyInPandas(one, schema)
