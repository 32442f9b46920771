"""Personal data in texts, plain and disguised, with the offsets of the text as written.

Plain identifiers are found by fixed patterns. Disguised ones go through three
transducers, each of which writes a plainer text and keeps for every character
the range it came from: look-alike characters and invisible ones, spelled
digits, and words or brackets for "at" and "dot". The same patterns run over the
result, and what they find is mapped back through the ranges.

Defined cases: a null text is empty; an empty text has no spans; offsets are
code points, ends exclusive; a disguised find that overlaps a plain one of its
kind is added only if it holds all of it and more; equal texts have equal spans; columns other than doc_id and
text are kept by ``redact`` and not read.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The patterns of plain identifiers. A run of digits or of local
# characters is only tried from its start; later starts in it can't match either.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGIT = re.compile("[0-9]")

# Characters that look like ASCII ones.
LOOKALIKES = (
    dict(zip("аеорсухіјѕԁһкмтвнАВЕКМНОРСТХІЈЅУЗ", "aeopcyxijsdhkmtbhABEKMHOPCTXIJSY3", strict=True))
    | dict(zip("αορνικτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aopviktuxABEZHIKMNOPTYX", strict=True))
    | dict(zip("ıℓ∙․。·‐‑‒–—−", "il....------", strict=True))
)
INVISIBLE = "​‌‍⁠﻿­"

# The digits as words, and words for "at", "dot" and "plus".
DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
AT_WORDS = ("at", "arobase", "arroba", "klammeraffe")
DOT_WORDS = ("dot", "punkt", "point", "punto")
PLUS_WORDS = ("plus", "más")
ENDINGS = frozenset("com org net edu gov mil int info biz io co uk us eu de fr es it nl ch at be ca au jp cn in ru br test example".split())
ENDINGS |= frozenset("pl se fi dk pt cz gr hu ro ie nz kr mx ar cl za tr ua il sg hk tw lu sk lt lv ee bg hr app dev xyz online site shop eus cat".split())
#: Words that come before a plain "at" in a sentence and are no local part.
NO_LOCAL = frozenset(
    "look looks looking looked us me him her them it is are was were be been am here there now more available found find visit online published posted hosted"
    " live see read page pages site website blog home store shop shopping and or of the a an this that these those out up down in on contact work works working"
    " order orders free only also directly details information register sign join download start starting listed sold buy guide article document program code"
    " day night time least best worst once all not just still back again over arrive arrived meet met stay stayed anyone someone everyone everything you we they i".split()
)
#: Digit words that must follow one another to be read as digits.
LEAST_SPELLED = 4

_DIGIT = "|".join(sorted(DIGIT_WORDS, key=len, reverse=True))
_AT, _DOT = "|".join(AT_WORDS), "|".join(DOT_WORDS)
# one digit may be written as such between spelled ones
SPELLED = re.compile(rf"(?<![^\W_])(?:(?:{'|'.join(PLUS_WORDS)})[ ,.-]+)?(?:{_DIGIT}|[0-9])(?:[ ,.-]{{1,3}}(?:{_DIGIT}|[0-9])){{{LEAST_SPELLED - 1},}}(?![^\W_])", re.IGNORECASE)
# written and spelled digits of any number side by side, and four dotted parts of them
_SEP = r"[ ,.()-]{1,3}"
_TOKEN = rf"(?:{'|'.join(PLUS_WORDS)}|{_DIGIT}|[0-9]++)(?![^\W_])"
MIXED = re.compile(rf"(?<![^\W_])\+?{_TOKEN}(?:{_SEP}\+?{_TOKEN})++", re.IGNORECASE)
SPELLED_WORD = re.compile(rf"(?<![^\W_])(?:{_DIGIT}|{'|'.join(PLUS_WORDS)})(?![^\W_])", re.IGNORECASE)
_OPEN, _CLOSE = r"[ ]{0,2}[\[({<][ ]?", r"[ ]?[\])}>][ ]{0,2}"
AT_MARK = rf"(?:{_OPEN}(?:{_AT}|@){_CLOSE}|[ ]+(?:{_AT}|@)[ ]+|[ ]+@|@[ ]+|@)"
_HIDDEN_DOT = rf"(?:{_OPEN}(?:{_DOT}){_CLOSE}|[ ]+(?:{_DOT})[ ]+)"
DOT_MARK = rf"(?:{_OPEN}(?:{_DOT}|\.){_CLOSE}|[ ]+(?:{_DOT})[ ]+|\.)"
_LOCAL = "[A-Za-z0-9._%+-]"
# an "at" after a local part, with the domain behind it; what links two words of a local part. Local parts are found
# backwards from the "at", since tried forwards a row of dots would be walked again from each of its words
FROM_AT = re.compile(rf"(?<={_LOCAL})({AT_MARK})([A-Za-z0-9-]++)((?:{DOT_MARK}[A-Za-z0-9-]++)+)", re.IGNORECASE | re.ASCII)
LINK = re.compile(rf"(?<={_LOCAL})(?=({_HIDDEN_DOT}){_LOCAL})", re.IGNORECASE | re.ASCII)
NUMBER_DOTS = re.compile(rf"(?<![0-9])[0-9]++(?:{DOT_MARK}[0-9]++){{3}}", re.IGNORECASE)
PART = re.compile(DOT_MARK, re.IGNORECASE)
# a full stop with a blank behind it alone ends a sentence
_ANY_DOT = rf"(?:{_OPEN}(?:{_DOT}|\.){_CLOSE}|[ ]+(?:{_DOT})[ ]+|[ ]\.[ ]|\.)"
_NUMBER = rf"(?:[0-9]{{1,3}}|(?:{_DIGIT}|[0-9])(?:[ ,-]{{1,3}}(?:{_DIGIT}|[0-9])){{0,2}})"
SPELLED_IP = re.compile(rf"(?<![^\W_]){_NUMBER}(?:{_ANY_DOT}{_NUMBER}){{3}}(?![^\W_])", re.IGNORECASE)
ANY_DOT = re.compile(_ANY_DOT, re.IGNORECASE)
AT_DOMAIN = re.compile(rf"[ ](?:{_AT})[ ]+[a-z0-9-]+\.[a-z]")

Span = tuple[int, int]
Edit = tuple[int, int, str]


def _lookalikes() -> dict[str, str]:
    out = dict(LOOKALIKES)
    out |= {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    for first in (0x660, 0x6F0, 0x966, 0x9E6, 0xE50, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6):
        out |= {chr(first + k): str(k) for k in range(10)}
    for c in range(0x1D400, 0x1D6A4):
        plain = unicodedata.normalize("NFKC", chr(c))
        if len(plain) == 1 and plain.isascii():
            out[chr(c)] = plain
    return out


PLAIN = _lookalikes()
ODD = frozenset(PLAIN) | frozenset(INVISIBLE)
ODD_LATIN = sorted(c for c in ODD if ord(c) < 256)


def has_marks(low: str) -> bool:
    """Whether a disguised "at" or "dot" may occur; a quick look before the patterns."""
    if any(w in low for w in DOT_WORDS):
        return True
    if AT_DOMAIN.search(low):
        return True
    if "@" in low and (" @" in low or "@ " in low):
        return True
    return any(b in low for b in "[({<") and any(f"{b}{s}{w}" in low for b in "[({<" for s in ("", " ") for w in (".", "@", *AT_WORDS))


def emails(text: str) -> list[Span]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def _in_range(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def ips(text: str) -> list[Span]:
    return [m.span() for m in IP.finditer(text) if all(map(_in_range, m[0].split(".")))]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def cards(text: str) -> list[Span]:
    return [m.span() for m in CARD.finditer(text) if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]


def phones(text: str) -> list[Span]:
    return [m.span() for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15] if "+" in text else []


FINDERS: dict[str, Callable[[str], list[Span]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the fixed patterns, in order of start, then kind."""
    out = [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        for kind in KINDS[1:]:
            out += [(kind, a, b) for a, b in FINDERS[kind](text)]
    return in_order(out)


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


class Traced:
    """A text and, for each of its characters, the range of the source it stands for."""

    def __init__(self, text: str):
        self.text = text
        self.start: list[int] | range = range(len(text))
        self.end: list[int] | range = range(1, len(text) + 1)
        self.changed: set[int] = set()

    def edit(self, edits: list[Edit]) -> None:
        """Replace ranges, in order and apart; each new character stands for its whole range."""
        if not edits:
            return
        text, start, end, changed, done = [], [], [], set(), 0
        n = 0

        def keep(a: int, b: int) -> None:
            nonlocal n
            text.append(self.text[a:b])
            start.extend(self.start[a:b])
            end.extend(self.end[a:b])
            if self.changed:
                changed.update(n + k - a for k in range(a, b) if k in self.changed)
            n += b - a

        for a, b, new in edits:
            keep(done, a)
            text.append(new)
            start.extend([self.start[a]] * len(new))
            end.extend([self.end[b - 1]] * len(new))
            changed.update(range(n, n + len(new)))
            if not new and n:  # what is left out makes its neighbours count as changed
                changed.add(n - 1)
                changed.add(n)
            n += len(new)
            done = b
        keep(done, len(self.text))
        self.text, self.start, self.end, self.changed = "".join(text), start, end, changed


def has_odd(text: str) -> bool:
    """Whether any look-alike or invisible character occurs; Latin texts are told by their encoding."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return not ODD.isdisjoint(text)
    return any(c in text for c in ODD_LATIN)


def look_alike_edits(text: str) -> list[Edit]:
    return [(i, i + 1, PLAIN.get(c, "")) for i, c in enumerate(text) if c in ODD]


def has_spelled(low: str) -> bool:
    """Whether enough words are digits; a quick look before the patterns."""
    words = low
    for c in "-,.[](){}<>":
        words = words.replace(c, " ")
    n = sum(map(DIGIT_WORDS.__contains__, words.split()))
    return n >= LEAST_SPELLED - 1 or n > 0 and (DIGIT.search(low) is not None or any(w in low for w in (*PLUS_WORDS, *DOT_WORDS)))


def _digits_of(text: str, start: int, end: int) -> list[Edit]:
    """Spelled digits and plus words of a range, and digits written alone, as edits."""
    spots = [(m.start(), m.end(), "+" if m[0].lower() in PLUS_WORDS else DIGIT_WORDS[m[0].lower()]) for m in SPELLED_WORD.finditer(text, start, end)]
    return sorted(spots + [(m.start() + start, m.end() + start, m[0]) for m in re.finditer(r"(?<![^\W_])[0-9]+(?![^\W_])", text[start:end])])


def _together(spots: list[Edit]) -> list[Edit]:
    """Separators between the digits become nothing, so the digits stand together."""
    out: list[Edit] = []
    for i, (a, b, new) in enumerate(spots):
        if i and spots[i - 1][1] < a:
            out.append((spots[i - 1][1], a, ""))
        out.append((a, b, new))
    return out


def _address_edits(text: str) -> Iterator[tuple[Span, list[Edit]]]:
    """Four dotted parts with a spelled digit among them; the dots stay."""
    for m in SPELLED_IP.finditer(text):
        if not SPELLED_WORD.search(text, *m.span()):
            continue
        edits, at, parts = [], m.start(), []
        for d in [*ANY_DOT.finditer(text, *m.span()), None]:
            spots = _digits_of(text, at, d.start() if d else m.end())
            parts.append("".join(new for _, _, new in spots))
            edits += _together(spots)
            if d:
                edits.append((d.start(), d.end(), "."))
                at = d.end()
        if len(parts) == 4 and all(p.isdigit() and _in_range(p) for p in parts):
            yield m.span(), edits


def _number_edits(text: str) -> Iterator[tuple[Span, list[Edit]]]:
    """Numbers of spelled and written digits that are long enough for a phone or a card, and none without the spelled ones."""
    for m in MIXED.finditer(text):
        a, b = m.span()
        if not SPELLED_WORD.search(text, a, b):
            continue
        spots = _digits_of(text, a, b)
        size = sum(len(_digits(new)) for _, _, new in spots)
        plus = "+" in m[0] or any(new == "+" for _, _, new in spots)
        if (12 <= size <= 19 or plus and 9 <= size <= 15) and not plain_spans(text[a:b]):
            # a written plus stays in front of its digits
            yield (a, b), [e for e in _together(spots) if e[2] or "+" not in text[e[0] : e[1]]]


def spelled_edits(text: str) -> list[Edit]:
    found: list[tuple[Span, list[Edit]]] = list(_address_edits(text))

    def add(more: list[tuple[Span, list[Edit]]]) -> None:
        taken = sorted(s for s, _ in found)
        at = 0
        for span, edits in more:
            while at < len(taken) and taken[at][1] <= span[0]:
                at += 1
            if at == len(taken) or taken[at][0] >= span[1]:
                found.append((span, edits))

    add(list(_number_edits(text)))
    runs = []
    for run in SPELLED.finditer(text):
        if sum(1 for _ in SPELLED_WORD.finditer(text, *run.span())) >= LEAST_SPELLED:
            runs.append((run.span(), _together(_digits_of(text, *run.span()))))
    add(runs)
    return [e for _, edits in sorted(found) for e in edits]


def addresses(text: str) -> Iterator[tuple[int, re.Match]]:
    """The start of each local part and the match of the rest, by their "at" from left to right, none overlapping.

    A word of a local part has one "at" it can lead to, so all walks together are linear in the text.
    """
    before: dict[int, int] | None = None
    done, found = 0, FROM_AT.search(text)
    while found:
        if before is None:
            before = {m.end(1): m.start() for m in LINK.finditer(text)}
        start = end = found.start()
        while end is not None:
            word = end
            while word > done and text[word - 1] in LOCAL:
                word -= 1
            # a word that the last address has a part of is none
            if word == end or word == done and word and text[word - 1] in LOCAL:
                break
            start = word
            end = before.get(word)
            if end is not None and end <= done:
                break
        if start < found.start():
            yield start, found
            done = found.end()
            found = FROM_AT.search(text, done)
        else:
            found = FROM_AT.search(text, found.start() + 1)


def mark_edits(text: str) -> list[Edit]:
    out: list[Edit] = []
    for start, m in addresses(text):
        local = text[start : m.start()]
        inner = [p for p in PART.finditer(local) if p[0] != "."]
        parts = list(PART.finditer(m[3]))
        plain_at = m[1].strip().lower() in AT_WORDS
        # a bare word "at" is only read so before a disguised dot or a usual ending, a bare "dot" only before a usual ending
        dots = [p[0].strip().lower() for p in parts]
        ending = m[3].rpartition(".")[2].lower()
        disguised = m[1] != "@" or inner or any(p[0] != "." for p in parts)
        if not disguised or plain_at and set(dots) == {"."} and (ending not in ENDINGS or local.lower() in NO_LOCAL):
            continue
        if plain_at and any(d in DOT_WORDS for d in dots) and m[3].rpartition(" ")[2].rpartition(".")[2].lower() not in ENDINGS:
            continue
        out += [(start + p.start(), start + p.end(), ".") for p in inner]
        out.append((m.start(1), m.end(1), "@"))
        out += [(m.start(3) + p.start(), m.start(3) + p.end(), ".") for p in parts if p[0] != "."]
    numbers, at = [], 0
    for m in NUMBER_DOTS.finditer(text):
        while at < len(out) and out[at][1] <= m.start():
            at += 1
        if at == len(out) or out[at][0] >= m.end():
            numbers += [(m.start() + p.start(), m.start() + p.end(), ".") for p in PART.finditer(m[0]) if p[0] != "."]
    return sorted(out + numbers)


def hidden_spans(text: str) -> list[tuple[str, int, int]]:
    """What the patterns find only after the transducers, in places of the source text."""
    traced: Traced | None = None
    if has_odd(text):
        traced = Traced(text)
        traced.edit(look_alike_edits(text))
    now = traced.text if traced else text
    if has_spelled(now.lower()):
        if edits := spelled_edits(now):
            traced = traced or Traced(text)
            traced.edit(edits)
            now = traced.text
    if has_marks(now.lower()):
        if edits := mark_edits(now):
            traced = traced or Traced(text)
            traced.edit(edits)
    if traced is None or not traced.changed:
        return []
    out = []
    for kind, a, b in plain_spans(traced.text):
        if any(k in traced.changed for k in range(a, b)):
            out.append((kind, traced.start[a], traced.end[b - 1]))
    return out


def added_spans(base: list[tuple[str, int, int]], hidden: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The hidden spans that meet no plain one of their kind but such as lie in them; each kind is one merge of two sorted lists."""
    out = []
    for kind in KINDS:
        plain = [(a, b) for k, a, b in base if k == kind]
        at = 0
        for a, b in sorted({(a, b) for k, a, b in hidden if k == kind}):
            while at < len(plain) and plain[at][1] <= a:
                at += 1
            last = at
            while last < len(plain) and plain[last][0] < b:
                last += 1
            met = plain[at:last]
            if not met or a <= met[0][0] and met[-1][1] <= b and met != [(a, b)]:
                out.append((kind, a, b))
    return out


def all_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The plain spans, and those with the disguised ones added."""
    base = plain_spans(text)
    more = added_spans(base, hidden_spans(text))
    return base, in_order(base + more) if more else base


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def redact_text(text: str) -> str:
    """Every span as its kind in square brackets; spans that overlap are one."""
    out, done = [], 0
    for kind, a, b in all_spans(text)[1]:
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:] if out else text


def find(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the plain spans by kind, base_sha256, spans, and n_added of the method's own."""

    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                base, every = all_spans(text)
                kinds = [k for k, _, _ in base]
                rows.append((*map(kinds.count, KINDS), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), len(every) - len(base)))
            columns = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            kinds = [pa.string() if n in ("base_sha256", "spans") else pa.int64() for n in names]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns, kinds)], ["doc_id", *names])

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).mapInArrow(run, schema)


def redact(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced; n_chars, where there is one, is counted anew. A null text stays null."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else redact_text(t))

    out = docs.withColumn("text", clean("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
