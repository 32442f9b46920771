"""Chat formatting: records of many layouts to canonical turns, turns to one template with a loss mask.

A record's schema fingerprint is a hash of its nested field paths with their
types. A fingerprint selects one of the declared mappings (the first whose needs
the paths meet), once for each fingerprint that a task meets; the mapping tells
how prompt, instruction and message layouts become turns.

Turns are sorted over ranges of (conversation, turn), so that one very long
conversation is formatted by many tasks. A task writes a conversation's turns
behind each other, in parts of bounded length; only what touches the edge of a
range, or has more than one part, meets by conversation afterwards, in order,
and is read there as a stream.

Texts may hold anything: ``<|`` never stays as it is, a backslash goes between,
and one more where there are some, so control strings only come from the
template and every text can be read back.

Defined cases: a null role or text is empty; a record that is null, no JSON or of no known
layout gives no turns and is counted by ``layouts``; a null conversation id is an id
like any other; null turn numbers come first; records of one turn number go in
the order of a hash of theirs, equal ones turn beside turn; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

START, END = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"
#: Characters of a part, at least, before a new one begins.
PART = 1 << 18

#: Names that layouts give to roles (fixed values).
ROLE_NAMES = {"human": "user", "user": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "assistant": "assistant", "system": "system"}


@dataclass(frozen=True)
class Said:
    """A turn made of some fields, joined by an empty line; an optional one is left out where it would be empty."""

    role: str
    fields: tuple[str, ...]
    optional: bool = False

    def turns(self, record: dict) -> Iterator[tuple[str, str]]:
        text = "\n\n".join(t for t in (text_of(record.get(f)) for f in self.fields) if t)
        if text or not self.optional:
            yield self.role, text


@dataclass(frozen=True)
class Listed:
    """A list of turns, each with its own role and text."""

    at: str
    role: str
    text: str
    names: dict[str, str] = field(default_factory=dict)

    def turns(self, record: dict) -> Iterator[tuple[str, str]]:
        for item in record.get(self.at) or []:
            if isinstance(item, dict):
                role = text_of(item.get(self.role))
                yield self.names.get(role, role), text_of(item.get(self.text))


@dataclass(frozen=True)
class Pairs:
    """A list of (question, answer) pairs, each two turns."""

    at: str

    def turns(self, record: dict) -> Iterator[tuple[str, str]]:
        for pair in record.get(self.at) or []:
            if isinstance(pair, list):
                yield from zip(("user", ASSISTANT), map(text_of, pair), strict=False)


@dataclass(frozen=True)
class Single:
    """The record is a turn itself."""

    role: str
    text: str

    def turns(self, record: dict) -> Iterator[tuple[str, str]]:
        yield text_of(record.get(self.role)), text_of(record.get(self.text))


@dataclass(frozen=True)
class Mapping:
    """needs: of each group of paths the record has one at least."""

    name: str
    needs: tuple[tuple[str, ...], ...]
    rules: tuple[Said | Listed | Pairs | Single, ...]

    def fits(self, paths: frozenset[str]) -> bool:
        return all(not paths.isdisjoint(group) for group in self.needs)

    def turns(self, record: dict) -> list[tuple[str, str]]:
        return [t for rule in self.rules for t in rule.turns(record)]


SYSTEM = Said("system", ("system",), optional=True)

#: Layouts by name, the more particular first.
MAPPINGS = (
    Mapping("messages", (("messages[].role:string",), ("messages[].content:string", "messages[].content[].text:string")), (SYSTEM, Listed("messages", "role", "content"))),
    Mapping("conversations", (("conversations[].from:string",), ("conversations[].value:string",)), (SYSTEM, Listed("conversations", "from", "value", ROLE_NAMES))),
    Mapping("instruction", (("instruction:string",), ("output:string",)), (SYSTEM, Pairs("history"), Said("user", ("instruction", "input")), Said(ASSISTANT, ("output",)))),
    Mapping("prompt", (("prompt:string",), ("completion:string",)), (SYSTEM, Said("user", ("prompt",)), Said(ASSISTANT, ("completion",)))),
    Mapping("response", (("prompt:string",), ("response:string",)), (SYSTEM, Said("user", ("prompt",)), Said(ASSISTANT, ("response",)))),
    Mapping("question", (("question:string",), ("answer:string",)), (SYSTEM, Said("user", ("context", "question")), Said(ASSISTANT, ("answer",)))),
    Mapping("message", (("content:string", "content[].text:string"), ("role:string",)), (Single("role", "content"),)),
    Mapping("turn", (("text:string", "role:string"),), (Single("role", "text"),)),
)


def text_of(value: object) -> str:
    """The text of a field: parts of a list behind each other, numbers as JSON writes them."""
    if isinstance(value, str):
        return whole(value)
    if isinstance(value, list):
        return "".join(text_of(p.get("text") if isinstance(p, dict) else p) for p in value)
    return "" if value is None or isinstance(value, dict) else json.dumps(value)


def whole(text: str) -> str:
    """The text, halves of surrogate pairs (from JSON escapes) made whole or replaced."""
    try:
        text.encode()
    except UnicodeEncodeError:
        return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return text


def field_paths(record: object) -> frozenset[str]:
    """Paths of all fields that are not null, with types: ``messages[].role:string``. Marks inside a name are escaped."""
    found, todo = set(), [("", record)]
    while todo:
        path, value = todo.pop()
        if isinstance(value, dict):
            todo += [(f"{path}.{name}" if path else name, v) for k, v in value.items() for name in [re.sub(r"([\\.:\[])", r"\\\1", k)]]
        elif isinstance(value, list):
            todo += [(f"{path}[]", v) for v in value]
        elif value is not None:
            found.add(f"{path}:{'string' if isinstance(value, str) else 'boolean' if isinstance(value, bool) else 'number'}")
    return frozenset(found)


def fingerprint(paths: frozenset[str]) -> str:
    return hashlib.blake2b("\n".join(sorted(map(whole, paths))).encode(), digest_size=16).hexdigest()


class Layouts:
    """fingerprint -> mapping; each fingerprint is decided once, so many as fit are kept."""

    def __init__(self, mappings: tuple[Mapping, ...], most: int = 10_000):
        self.mappings, self.most = mappings, most
        self.known: dict[str, Mapping | None] = {}

    def of(self, record: object) -> tuple[str, Mapping | None]:
        paths = field_paths(record)
        key = fingerprint(paths)
        if key not in self.known:
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[key] = next((m for m in self.mappings if isinstance(record, dict) and m.fits(paths)), None)
        return key, self.known[key]


def parsed(text: str | None) -> object:
    """The JSON value, None where there is none."""
    try:
        return None if text is None else json.loads(text)
    except (ValueError, RecursionError):
        return None


def _as_json(records: DataFrame) -> Column:
    kind = records.schema["record"].dataType.typeName()
    return F.col("record") if kind == "string" else F.to_json("record")


def canonical(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """conv_id, turn, rec, pos, role, text of records (conv_id, turn, record: JSON or a nested column).

    rec tells records of the same turn number apart; pos is the place in a record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layouts = Layouts(mappings)
        for batch in common.small(batches):
            at, pos, roles, texts = [], [], [], []
            for k, text in enumerate(batch.column("record").to_pylist()):
                record = parsed(text)
                mapping = layouts.of(record)[1]
                for p, (role, said) in enumerate(mapping.turns(record) if mapping else []):
                    at.append(k)
                    pos.append(p)
                    roles.append(role)
                    texts.append(said)
            keys = batch.select(["conv_id", "turn", "rec"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*keys.columns, pa.array(pos, pa.int32()), pa.array(roles, pa.string()), pa.array(texts, pa.string())], ["conv_id", "turn", "rec", "pos", "role", "text"])

    source = records.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), _as_json(records).alias("record")).select("*", F.xxhash64("record").alias("rec"))
    return source.mapInArrow(run, "conv_id long, turn long, rec long, pos int, role string, text string")


def layouts(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """fingerprint, layout (null: none known), paths, n: how many records of each schema there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Layouts(mappings)
        for batch in common.small(batches):
            rows = []
            for text in batch.column("record").to_pylist():
                record = parsed(text)
                key, mapping = known.of(record)
                rows.append((key, mapping and mapping.name, sorted(map(whole, field_paths(record)))))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.list_(pa.string()))], ["fingerprint", "layout", "paths"])

    found = records.select(_as_json(records).alias("record")).mapInArrow(run, "fingerprint string, layout string, paths array<string>")
    return found.groupBy("fingerprint", "layout", "paths").agg(F.count("*").alias("n"))


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text) if "|" in text else text


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text) if "|" in text else text


def escape_role(role: str) -> str:
    """A role is one line: line ends are written as a backslash and n."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


PARTS = "conv_id long, seq long, whole boolean, formatted string, mask array<struct<first:int,last:int>>"
MASK = pa.list_(pa.struct([pa.field("first", pa.int32()), pa.field("last", pa.int32())]))


def _parts_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.string(), MASK)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "seq", "whole", "formatted", "mask"])


def formatted(turns: DataFrame, part: int = PART) -> DataFrame:
    """conv_id, seq, whole, formatted, mask: the parts of each conversation, in order of seq.

    whole: the part is all of its conversation. mask: ranges of the part's code
    points that hold what assistants say, escaped, where a model has a loss.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 32
        done, done_size, seq = [], 0, base
        now, pieces, mask, size, first, cut = None, [], [], 0, True, False
        started = False

        def close(whole_part: bool) -> None:
            nonlocal pieces, mask, size, seq, done_size
            done.append((now, seq, whole_part, "".join(pieces), mask))
            seq += 1
            done_size += size
            pieces, mask, size = [], [], 0

        for batch in common.small(batches):
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if not started or conv != now:
                    if started:
                        close(not first and not cut)
                        first = False
                    started, now, cut = True, conv, False
                elif size >= part:
                    close(False)
                    cut = True
                head, body = f"{START}{escape_role(role or '')}\n", escape(text or "")
                if role == ASSISTANT:
                    mask.append({"first": size + len(head), "last": size + len(head) + len(body)})
                pieces += (head, body, END)
                size += len(head) + len(body) + len(END)
                if done_size > common.BATCH_BYTES:
                    yield _parts_batch(done)
                    done, done_size = [], 0
        if started:
            close(False)
        if done:
            yield _parts_batch(done)

    keys = ["conv_id", "turn", "rec", "pos"]
    return turns.select(*keys, "role", "text").repartitionByRange(*keys).sortWithinPartitions(*keys, "role", "text").select("conv_id", "role", "text").mapInArrow(run, PARTS)


def read_back(text: str) -> Iterator[tuple[str, str]]:
    """The (role, text) pairs of formatted text; an error where it is none."""
    at = 0
    while at < len(text):
        line = text.find("\n", at)
        end = text.find(END, line + 1)
        if not text.startswith(START, at) or line < 0 or end < 0:
            raise ValueError(f"no turn at {at}")
        yield unescape_role(text[at + len(START) : line]), unescape(text[line + 1 : end])
        at = end + len(END)


class Digest:
    """Of a conversation's parts, read in order."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, text: str, mask: list[dict]) -> None:
        for role, said in read_back(text):
            self.turns.update(f"{role}\n{said}\n".encode())
            self.n += 1
        for m in mask:
            said = unescape(text[m["first"] : m["last"]])
            self.loss.update(said.encode())
            self.loss_chars += len(said)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
KINDS = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())


def digests(parts: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each conversation, read back from its parts.

    Parts that are whole are read where they were made; the others meet by conversation.
    """
    names = [c.split()[0] for c in DIGESTS.split(", ")]

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, seq, is_whole, text, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "seq", "whole", "formatted", "mask")), strict=True):
                if is_whole:
                    d = Digest()
                    d.add(text, mask)
                    rows.append((conv, *d.row(), None, None, None))
                else:
                    rows.append((conv, None, None, None, None, None, seq, text, mask))
            columns = zip(*rows, strict=True) if rows else [()] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (*KINDS, pa.int64(), pa.string(), MASK), strict=True)], [*names, "seq", "formatted", "mask"])

    def far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, d = None, None
        for batch in batches:
            rows = []
            for row in zip(*(batch.column(c).to_pylist() for c in (*names, "seq", "formatted", "mask")), strict=True):
                conv, text, mask = row[0], row[-2], row[-1]
                if d and (text is None or conv != now):
                    rows.append((now, *d.row()))
                    d = None
                if text is None:
                    rows.append(row[:6])
                else:
                    now, d = conv, d or Digest()
                    d.add(text, mask)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), KINDS, strict=True)], names)
        if d:
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip((now, *d.row()), KINDS, strict=True)], names)

    some = parts.mapInArrow(near, f"{DIGESTS}, seq long, formatted string, mask array<struct<first:int,last:int>>")
    return some.repartition("conv_id").sortWithinPartitions("conv_id", "seq").mapInArrow(far, DIGESTS)
