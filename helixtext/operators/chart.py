"""Components of mentions in plain language, by a chart over their words.

Words and short runs of them are edges of a lattice: a residue or base, a place
(``codon 12``, ``nucleotides 45 to 47``), a number of units (``three bases``), a
type word, a frame shift, or a connective that says which side is the new one. The
best way through the words fills each slot once; what is no edge may be passed
over at a cost. A state of the chart is the set of filled slots and the
direction, so the work for a mention is linear in its words.

``X to Y``, ``X replaced by Y``: X is the wild part. ``Y for X``, ``Y instead of X``,
``Y replacing X``: Y is the new one. Defined cases: null and empty mentions, those
of more than 60 words and those with fewer than two slots have no components.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixtext.functions import lexicon
from helixtext.functions.shared import checkpointed

from .spans import find

SLOTS = "atpwmfsdr"
#: Mentions are at most 200 characters; longer ones aren't parsed.
MOST_WORDS = 60
#: Each phrase with a variant holds a number; only separators behind one may be of any length, all the rest of a phrase is shorter than PHRASE_AROUND.
PHRASE_CORE = "[0-9][0-9 ,:]*"
PHRASE_AROUND = 256

FORWARD = ("to", "into", "by", "with", "replaced by", "replaced with", "substituted by", "substituted with", "changed to", "mutated to", "converted to", "becomes", "→", ">", "->")
BACKWARD = ("for", "instead of", "in place of", "rather than", "replaces", "replacing", "to replace", "substituted for", "substitution for", "substitutions for", "replacement of", "replacements of", "mutant of", "mutants of", "from")
#: Words before a place, and the level that they tell.
PLACES = {"position": "", "positions": "", "pos": "", "codon": "", "codons": "", "residue": "p", "residues": "p", "amino acid": "p", "amino acids": "p", "aa": "p", "nucleotide": "c", "nucleotides": "c", "nt": "c", "base": "c", "bases": "c", "base pair": "c", "bp": "c"}
#: Units that are counted, and the level that they tell.
UNITS = {"base": "c", "bases": "c", "base pair": "c", "base pairs": "c", "bp": "c", "nt": "c", "nucleotide": "c", "nucleotides": "c", "amino acid": "p", "amino acids": "p", "aa": "p", "residue": "p", "residues": "p", "codon": "p", "codons": "p"}
SHIFTS = ("fs", "frameshift", "frame shift", "frame-shift")
#: Words that cost nothing to pass over.
LOOSE = ("a", "an", "the", "of", "at", "in", "on", "and", "was", "is", "were", "are", "has", "been", "number", "no", "amino", "acid", "position", "change", "changes", "changed", "substitution", "substitutions", "replacement", "mutation", "mutations", "variant", "transition", "transversion", "point", "missense", "between", "after", "before", "which", "that", "results", "resulting", "leading", "codon")


def _words() -> dict[tuple[str, ...], list[tuple[str, str, float]]]:
    """Runs of words in small letters to their (kind, value, score)."""
    out: dict[tuple[str, ...], list[tuple[str, str, float]]] = {}

    def put(phrase: str, kind: str, value: str, score: float) -> None:
        out.setdefault(tuple(phrase.lower().replace("-", " - ").split()), []).append((kind, value, score))

    spoken = {"ASPARTICACID": "aspartic acid", "GLUTAMICACID": "glutamic acid", "STOPCODON": "stop codon", "TERMINATIONCODON": "termination codon"}
    for name in lexicon.NAME_TO_THREE:
        if not name.endswith("CODON") or name in spoken:
            put(spoken.get(name, name), "residue", name, 3.0 + 0.5 * (name in spoken))
    for three in lexicon.THREE_TO_ONE:
        put(three, "residue", three, 2.5)
    for base in lexicon.BASES:
        put(base, "residue", base, 3.0)
    for word in lexicon.TYPE_WORDS:
        if len(word) > 1 and "/" not in word:
            put(word, "type", word, 2.0)
    for word in ("del", "ins", "dup", "indel"):
        put(word, "type", word.upper(), 2.0)
    for kind, words in (("forward", FORWARD), ("backward", BACKWARD)):
        for w in words:
            put(w, kind, "", 1.0 + 0.5 * w.count(" "))
    for w in SHIFTS:
        put(w, "shift", "fs", 2.0)
    return out


@functools.cache
def chart_parser() -> Callable[[Column], Column]:
    """A function of mentions that gives their components; it needs nothing of this package in the executors."""
    known, places, units, loose = _words(), {tuple(k.split()): v for k, v in PLACES.items()}, {tuple(k.split()): v for k, v in UNITS.items()}, set(LOOSE)
    numbers = {k.lower(): v for k, v in lexicon.NUMBER_WORDS.items()}
    residues, slots, most = set("ACDEFGHIKLMNPQRSTVWXY"), SLOTS, MOST_WORDS

    def edges(words: list[str], i: int):
        """(end, kind, value, level, score) of all edges from word i."""
        low = [w.lower() for w in words[i : i + 7]]
        for n in range(1, 5):
            for kind, value, score in known.get(tuple(low[:n]), ()) if len(low) >= n else ():
                yield i + n, kind, value, "", score
        if words[i] in residues:
            yield i + 1, "residue", words[i], "", 1.5

        def ranged(k: int):
            """(words used, place) of a number or a range of two."""
            if k < len(low) and low[k].isdigit():
                yield 1, low[k]
                if k + 2 < len(low) and low[k + 1] in ("to", "-", "–", "_", "and", "through") and low[k + 2].isdigit() and int(low[k]) < int(low[k + 2]):
                    yield 3, f"{low[k]}_{low[k + 2]}"
            elif k + 1 < len(low) and low[k] in "+-" and low[k + 1].isdigit():
                yield 2, low[k] + low[k + 1]

        for n, place in ranged(0):
            yield i + n, "place", place, "", 1.5 + 0.5 * n
        for n in (1, 2):
            level = places.get(tuple(low[:n])) if len(low) >= n else None
            if level is None:
                continue
            skip = n
            while skip < len(low) and low[skip] in (":", "#", "number", "no", ".", "-"):
                skip += 1
            for used, place in ranged(skip):
                yield i + skip + used, "place", ("codon" if low[0] == "codon" and used == 1 else "") + place, level, 3.5 + 0.5 * used
        if low[0].isdigit() or low[0] in numbers:
            for n in (1, 2):
                level = units.get(tuple(low[1 : 1 + n])) if len(low) > n else None
                if level is not None:
                    yield i + 1 + n, "count", numbers.get(low[0], low[0]), level, 3.5

    def parsed(mention: str) -> dict[str, str] | None:
        import re

        words = re.findall(r"[A-Za-z]+|[0-9]+|->|[^\sA-Za-z0-9]", mention)
        if not words or len(words) > most:
            return None
        # state: filled slots and direction -> best (score, slots in order, level)
        chart: list[dict] = [{} for _ in range(len(words) + 1)]
        chart[0][frozenset(), ""] = (0.0, (), "")

        def put(at: int, key, score: float, filled, level: str) -> None:
            if key not in chart[at] or chart[at][key][0] < score:
                chart[at][key] = (score, filled, level)

        for i, word in enumerate(words):
            cost = 0.0 if word.lower() in loose or not word[0].isalnum() else 1.0
            some = list(edges(words, i))
            for (have, way), (score, filled, level) in chart[i].items():
                put(i + 1, (have, way), score - cost, filled, level)
                for end, kind, value, told, gain in some:
                    if kind in ("forward", "backward"):
                        if "first" in have and "second" not in have and not way:
                            put(end, (have, kind), score + gain, filled, level)
                        continue
                    slot = kind
                    if kind == "residue":
                        slot = "first" if "first" not in have else "second"
                        # two residues side by side, without a word or a place between, are less sure
                        gain -= 1.0 if slot == "second" and not way and filled and filled[-1][0] == "first" else 0.0
                    if slot in have or (kind == "type" and "shift" in have):
                        continue
                    put(end, (have | {slot}, way), score + gain, (*filled, (slot, value)), level or told)
        best = None
        for (have, way), (score, filled, level) in chart[-1].items():
            score -= 2.0 if way and "second" not in have else 0.0
            if len(have) >= 2 and (best is None or score > best[0]):
                best = score, dict(filled), way, level, [s for s, _ in filled]
        if best is None:
            return None
        _, got, way, level, order = best
        first, second = got.get("first", ""), got.get("second", "")
        wild, mutant = (second, first) if way == "backward" and second else (first, second)
        if first and not second and not got.get("type") and "place" in order and order.index("place") < order.index("first"):
            wild, mutant = "", first
        out = dict.fromkeys(slots, "")
        out.update(a=level, t=got.get("type", ""), p=got.get("place", ""), w=wild, m=mutant or got.get("count", ""), f=got.get("shift", ""))
        return out

    def run(mentions):
        import pyarrow as pa

        return pa.array([parsed(m) if m else None for m in mentions.to_pylist()], pa.struct([pa.field(s, pa.string()) for s in slots]))

    import pyarrow

    run.__annotations__ = {"mentions": pyarrow.Array, "return": pyarrow.Array}
    return F.arrow_udf(run, f"struct<{','.join(f'{s}:string' for s in SLOTS)}>")


def phrase_components(mention: Column) -> Column:
    """Struct a, t, p, w, m, f, s, d, r of mentions in plain language; empty fields where there are none."""
    return with_empty(chart_parser()(F.when(mention != "", mention)))


def phrase_pattern() -> str:
    """A pattern of the phrases that hold a variant: two residues and a connective, or a type word, beside a place."""

    def one_of(words) -> str:
        return "(?:" + "|".join(re.escape(w).replace(r"\ ", "[ -]") for w in sorted(set(words), key=lambda w: (-len(w), w))) + ")"

    singular = {n.capitalize() for n in lexicon.NAME_TO_THREE if not n.endswith("CODON") and "ACID" not in n} | set(lexicon.ONE_TO_THREE.values()) | {b.capitalize() for b in lexicon.BASES}
    residue = f"(?:(?i:{one_of([*singular, 'aspartic acid', 'glutamic acid', 'stop codon'])})|[ACDEFGHIKLMNPQRSTVWY](?= ))"
    kinds = f"(?i:{one_of(w for w in lexicon.TYPE_WORDS if len(w) > 4 and w.isalpha())})"
    place = f"(?i:{one_of(PLACES)}) (?:number )?[0-9]+(?: ?(?:to|-|–|and|through) ?[0-9]+)?"
    change = "(?: (?:substitution|mutation|change|transition|transversion|replacement))?"
    link = f"(?: (?:is|was|are|were))?[ -]{one_of([*FORWARD[:-3], *BACKWARD])}[ -]"
    where = f"(?: (?:at|in|of|on)(?: the)?)? (?:{place}|[0-9]+)"
    amount = f"(?: of)?(?: the)?(?: (?:[0-9]+|{one_of(n.lower() for n in lexicon.NUMBER_WORDS)}) {one_of(UNITS)}| {residue})?"
    return "|".join([
        rf"{place}[ ,:]+(?:from )?{residue}{link}{residue}",
        rf"(?:(?i:substitution|replacement|change|mutation) (?:of|from) )?{residue}{link}{residue}{change}{where}",
        rf"{residue} [0-9]+{link}{residue}",
        rf"{kinds}{amount}{where}",
        rf"(?:[0-9]+) {one_of(UNITS)} {kinds}{where}",
    ])


def tag_phrases(docs: DataFrame) -> DataFrame:
    """Mentions in plain language as spans doc_id, start_off, end_off, mention, etype; those that the chart can't read go."""
    # texts are read once: what is found is small and asked for twice
    found = checkpointed(find(docs, phrase_pattern(), "ProteinMutation", core=PHRASE_CORE, around=PHRASE_AROUND))
    distinct = found.select("mention").distinct().withColumn("c", phrase_components(F.col("mention")))
    read = distinct.where((F.col("c.p") != "") & ((F.col("c.w") != "") & (F.col("c.m") != "") | (F.col("c.t") != "") | (F.col("c.f") != "")))
    return found.join(read.select("mention"), "mention", "left_semi").select("doc_id", "start_off", "end_off", "mention", "etype")


def with_empty(c: Column) -> Column:
    return F.struct(*[F.coalesce(c[s], F.lit("")).alias(s) for s in SLOTS])
