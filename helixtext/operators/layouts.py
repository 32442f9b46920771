"""Mentions written together in one of a table of layouts.

A layout is a row of typed mentions (P protein, D DNA, S rs number) with a class
of text between neighbours, and perhaps before the first and behind the last.
All rows together are one automaton: a bit for each mention of each row. A fold
over a document's sorted mentions moves the bits along: those whose gap fits and
whose next mention has the right type. Of layouts that share a mention the first of the
table stays, of one row's the first in the text.

Defined cases: mentions of fewer than three characters and other types belong
to no layout; a null text has none; equal spans are looked at in the order of their
ids, one behind the other; layouts with ``and`` or ``or`` in a gap don't exist,
since no class has these words.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .spans import keep_apart

KINDS = {"ProteinMutation": "P", "ProteinAllele": "P", "ProteinAcidChange": "P", "DNAMutation": "D", "DNAAllele": "D", "DNAAcidChange": "D", "SNP": "S"}

MARK, OPEN, CLOSE = r"[/;,:\-]", r"[(\[]", r"[)\]]"
#: What stands between two mentions, by class; blanks as each allows them.
GAPS = {
    "mark": rf" *{MARK} *",
    "marks": rf" *{MARK}* *",
    "open": rf" *{OPEN} *",
    "close open": rf" *{CLOSE} *{OPEN} *",
    "with": r" +with +",
    "polymorphism": rf" *[Pp]olymorphism *{OPEN} *",
    "protein": rf" *{MARK}* *protein *",
    "gene": rf" *{MARK}* *gene *",
    "dbSNP id": rf" *{MARK}* *dbSNP *ID: *",
    "dbSNP": rf" *{MARK}* *dbSNP *",
    "close dbSNP": rf" *{CLOSE} *{MARK}* *dbSNP *",
    "close open dbSNP": rf" *{CLOSE} *{MARK}* *{OPEN} *dbSNP *",
    "open dbSNP": rf" *{OPEN} *dbSNP *",
    "utr": rf" *[53]'UTR *{OPEN}",
    "part": rf" *polymorphism in (?:exon|intron) [0-9]+ *{OPEN}",
}
#: What stands before the first mention, and behind the last.
BEFORE = {"open": rf"{OPEN} *$"}
AFTER = {"close": rf" *{CLOSE}", "at once close": CLOSE, "mark": rf" *{MARK}", "base": "[ATCGatcgu]"}

# The orders in which three and two types are written together. (DPS is no layout.)
THREE = ("PDS", "DSP", "PSD", "SPD", "SDP")
TWO_RS_FIRST, TWO_PLAIN_FIRST, TWO_OPEN = ("SP", "SD", "DS", "PS", "DP", "PD"), ("SP", "SD", "DP", "PD", "PS", "DS"), ("SP", "SD", "DS", "PS")


def table() -> list[tuple[str | None, str, tuple[str, ...], str | None]]:
    """(before, types, gaps, after) of all layouts, in the order in which they are tried."""
    rows = [("open", k, ("mark", "mark"), "close") for k in THREE]
    for gaps in (("open", "close open"), ("open", "mark")):
        rows += [(None, k, gaps, "close") for k in THREE]
    rows += [(None, k, ("polymorphism",), "close") for k in TWO_RS_FIRST]
    rows += [(None, k, ("open", "with"), "close") for k in THREE]
    rows += [("open", k, ("marks",), "close") for k in TWO_PLAIN_FIRST]
    rows += [(None, k, ("open",), "mark") for k in TWO_OPEN]
    rows += [(None, k, ("open",), "close") for k in TWO_RS_FIRST]
    rows += [(None, "SP", ("protein",), None), (None, "SD", ("gene",), None), (None, "PS", ("dbSNP id",), None), (None, "PS", ("dbSNP",), None)]
    rows += [("open", "PS", ("close dbSNP",), None), ("open", "PS", ("close open dbSNP",), "at once close")]
    for gap, after in (("open dbSNP", "base"), ("utr", "at once close"), ("part", "at once close")):
        rows += [(None, k, (gap,), after) for k in ("PS", "DS")]
    return rows


@functools.cache
def layout_finder() -> Callable[..., Column]:
    """A function of a text and its sorted mentions (starts, ends, types) that gives every layout met: first and last mention, and the row."""
    rows = table()
    gap_text, before_text, after_text = dict(GAPS), dict(BEFORE), dict(AFTER)

    def found(texts, starts, ends, kinds):
        import re

        import pyarrow as pa

        # one bit for each mention of each row; a row's bits stand side by side
        kind_bits, gap_bits, first, accept = dict.fromkeys("PDS", 0), dict.fromkeys(gap_text, 0), {None: 0, **dict.fromkeys(before_text, 0)}, {None: [], **{a: [] for a in after_text}}
        at = 0
        for row, (before, types, gaps, after) in enumerate(rows):
            first[before] |= 1 << at
            for k, t in enumerate(types):
                kind_bits[t] |= 1 << (at + k)
                if k < len(gaps):
                    gap_bits[gaps[k]] |= 1 << (at + k)
            at += len(types)
            accept[after].append((1 << (at - 1), len(types), row))
        final = {after: sum(b for b, _, _ in some) for after, some in accept.items()}
        gap_re = {c: re.compile(p, re.ASCII) for c, p in gap_text.items()}
        before_re, after_re = ({c: re.compile(p, re.ASCII) for c, p in t.items()} for t in (before_text, after_text))
        out = []
        for text, a, b, k in zip(*(x.to_pylist() for x in (texts, starts, ends, kinds)), strict=True):
            met, state, end = [], 0, 0
            for i, (start, last, kind) in enumerate(zip(a or (), b or (), k or (), strict=True)):
                if text is None or start < end or kind not in kind_bits or last - start < 3:
                    state, end = 0, max(end, last)
                    continue
                if state:
                    gap = text[end:start]
                    state &= sum(bits for c, bits in gap_bits.items() if bits & state and gap_re[c].fullmatch(gap))
                ahead = start
                while ahead > end and text[ahead - 1] == " ":
                    ahead -= 1
                begins = first[None]
                for c, p in before_re.items():
                    if p.match(text, max(ahead - 1, 0), start):
                        begins |= first[c]
                state = (state << 1 | begins) & kind_bits[kind]
                end = last
                for after, some in accept.items():
                    if state & final[after] and (after is None or after_re[after].match(text, last)):
                        met += [{"first": i + 1 - n, "last": i + 1, "row": row} for bit, n, row in some if state & bit]
            out.append(met)
        return pa.array(out, pa.list_(pa.struct([pa.field(f, pa.int32()) for f in ("first", "last", "row")])))

    import pyarrow

    found.__annotations__ = dict.fromkeys(("texts", "starts", "ends", "kinds", "return"), pyarrow.Array)
    return F.arrow_udf(found, "array<struct<first:int,last:int,row:int>>")


def find_layouts(ann: DataFrame, docs: DataFrame) -> DataFrame:
    """doc_id, layout (row of the table), members: array of ann_id, etype, ident in text order. docs: doc_id, text."""
    ident = F.col("ident") if "ident" in ann.columns else F.lit(None).cast("string").alias("ident")
    typed = ann.where(F.col("etype").isin(*KINDS)).select("doc_id", "start_off", "end_off", "ann_id", "etype", ident)
    grouped = typed.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start_off", "end_off", "ann_id", "etype", "ident"))).alias("items")).where(F.size("items") > 1)
    kind = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    part = lambda f: F.transform("items", f)
    met = layout_finder()(F.col("text"), part(lambda x: x["start_off"].cast("int")), part(lambda x: x["end_off"].cast("int")), part(lambda x: kind[x["etype"]]))
    joined = docs.select("doc_id", "text").join(grouped, "doc_id").select("doc_id", "items", F.explode(met).alias("l"))
    members = F.transform(F.slice("items", F.col("l.first") + 1, F.col("l.last") - F.col("l.first")), lambda x: F.struct(x["ann_id"].alias("ann_id"), x["etype"].alias("etype"), x["ident"].alias("ident")))
    some = joined.select("doc_id", F.col("l.first").alias("start_off"), F.col("l.last").alias("end_off"), F.col("l.row").alias("priority"), members.alias("members"))
    return keep_apart(some, "priority, start_off").select("doc_id", F.col("priority").alias("layout"), "members")


def layout_links(found: DataFrame) -> DataFrame:
    """doc_id, ann_a, ann_b: each other member beside the rs number's, or the first two where there is none."""
    rs = F.filter("members", lambda m: m["etype"] == "SNP")
    others = F.filter("members", lambda m: m["etype"] != "SNP")
    by_rs = found.where(F.size(rs) > 0).select("doc_id", F.explode(others).alias("o"), F.get(rs, F.lit(0))["ann_id"].alias("ann_b")).select("doc_id", F.col("o.ann_id").alias("ann_a"), "ann_b")
    return by_rs.unionByName(found.where(F.size(rs) == 0).select("doc_id", F.get("members", F.lit(0))["ann_id"].alias("ann_a"), F.get("members", F.lit(1))["ann_id"].alias("ann_b")))


def layout_rs(found: DataFrame, ann: DataFrame) -> DataFrame:
    """ann_id, rs, source: the rs number of a layout for all mentions of its other identifiers in the document; the least of several."""
    rs = F.filter("members", lambda m: m["etype"] == "SNP")
    number = F.regexp_extract(F.get(rs, F.lit(0))["ident"], "[Rr][Ss]([0-9]+)$", 1).try_cast("bigint")
    given = found.select("doc_id", number.alias("rs"), F.explode(F.filter("members", lambda m: m["etype"] != "SNP")).alias("m"))
    one = given.select("doc_id", "rs", "m.ident").where("rs is not null and ident is not null").groupBy("doc_id", "ident").agg(F.min("rs").alias("rs"))
    return ann.where(F.col("etype").isin(*[k for k in KINDS if k != "SNP"])).join(one, ["doc_id", "ident"]).select("ann_id", "rs", F.lit("Pattern").alias("source"))
