"""Column functions of variant components, identifiers and names.

An identifier is ``level|TYPE|...``; a component struct has the fields a (level),
t (type), p (position), w and m (wild and mutant), f (frame shift), s (its
position), d (number of copies), r (rs number), all strings, empty if absent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import lexicon

PROTEIN_ONLY = "[ISQMNPKDFHLRWVEYX]"


def part(ident: Column, k: int) -> Column:
    """The k-th field of an identifier (from 0), empty if there is none."""
    return F.coalesce(F.try_element_at(F.split(ident, r"\|"), F.lit(k + 1)), F.lit(""))


def parse_identifier(ident: Column) -> Column:
    """Struct seq, vtype, wild, pos, mut, fs_pos, dup_n of an identifier."""
    p = [part(ident, k) for k in range(6)]
    vtype = p[1]
    none = F.lit("")
    sub, fs, allele = vtype == "SUB", vtype == "FS", vtype == "Allele"
    return F.struct(
        p[0].alias("seq"),
        vtype.alias("vtype"),
        F.when(sub | fs, p[2]).otherwise(none).alias("wild"),
        F.when(sub | fs | allele, p[3]).otherwise(p[2]).alias("pos"),
        F.when(sub | fs, p[4]).when(allele, p[2]).otherwise(p[3]).alias("mut"),
        F.when(fs, p[5]).otherwise(none).alias("fs_pos"),
        F.when(vtype == "DUP", p[4]).otherwise(none).alias("dup_n"),
    )


def build_identifier(c: Column) -> Column:
    """The identifier of a component struct."""
    a, t, p, w, m, f, s, d, r = (c[x] for x in "atpwmfsdr")
    bar = lambda *x: F.concat_ws("|", *x)
    return (
        F.when((t == "DUP") & (d != ""), bar(a, t, p, m, d))
        .when(t == "DUP", bar(a, t, p, m, F.lit("")))
        .when(t != "", bar(a, t, p, m))
        .when(f != "", bar(a, F.lit("FS"), w, p, m, s))
        .when(r != "", r)
        .when((w == "") & (m != ""), bar(a, F.lit("Allele"), m, p))
        .when((m == "") & (w != ""), bar(a, F.lit("Allele"), w, p))
        .otherwise(bar(a, F.lit("SUB"), w, p, m))
    )


def canonical_type(t: Column) -> Column:
    """Type words to INS, DEL, DUP, INDEL (D3)."""
    up = F.upper(t)
    return (
        F.when(lexicon.lookup(lexicon.TYPE_WORDS)[up].isNotNull(), lexicon.lookup(lexicon.TYPE_WORDS)[up])
        .when(up.rlike("INS.*DEL|DEL.*INS|INDEL"), F.lit("INDEL"))
        .when(up.rlike("DUPLICATION"), F.lit("DUP"))
        .when(up.rlike("INSERTION"), F.lit("INS"))
        .when(up.rlike("DELETION"), F.lit("DEL"))
        .otherwise(up)
    )


def settle_type(c: Column) -> Column:
    """Moves a type found among the residues to its place, and number words to digits (D3)."""
    a, t, p, w, m, f, s, d, r = (c[x] for x in "atpwmfsdr")
    kinds = "^(DEL|INS|DUP|INDEL)$"
    takes_w = t.rlike(kinds) & (w != "") & (m == "")
    m_type = ~takes_w & m.rlike(kinds)
    w_type = ~takes_w & ~m_type & w.rlike(kinds)
    copies = ~takes_w & ~m_type & ~w_type & (d != "")
    new_m = F.when(takes_w, w).when(m_type, F.lit("")).otherwise(m)
    return F.struct(
        a.alias("a"),
        F.when(m_type, m).when(w_type, w).when(copies, F.lit("DUP")).otherwise(t).alias("t"),
        p.alias("p"),
        F.when(w_type, F.lit("")).otherwise(w).alias("w"),
        lexicon.mapped(lexicon.NUMBER_WORDS, new_m, new_m).alias("m"),
        f.alias("f"), s.alias("s"), d.alias("d"), r.alias("r"),
    )


def canonical_position(p: Column, protein: Column, codon: Column) -> Column:
    """Ranges as a_b when increasing; words before numbers stripped; codon kept for DNA only."""
    up = F.upper(p)
    first, last = F.regexp_extract(up, r"^([0-9]+)[^0-9,]+([0-9]{1,8})$", 1), F.regexp_extract(up, r"^([0-9]+)[^0-9,]+([0-9]{1,8})$", 2)
    a, b = F.expr("try_cast(null as bigint)"), None
    a, b = first.try_cast("bigint"), last.try_cast("bigint")
    ranged = F.when((F.length(first).between(1, 9)) & (a < b), F.concat(first, F.lit("_"), last)).otherwise(up)
    words = r"^(POSITION|NUCLEOTIDE|BASE|PAIRS?|NT|AA|:)"
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(ranged, r"[-\[]+$", ""), words, ""), words, "")
    return F.when(protein, F.regexp_replace(bare, "^CODON", "")).when(codon & bare.rlike("^[0-9]+$"), F.concat(F.lit("CODON"), bare)).otherwise(bare)


def translate_residues(values: Column) -> Column:
    """A comma list of names or codes to one-letter codes, repeats removed.

    Struct value, translated (a residue was named), base (a base was named),
    codon (a codon was translated: only when neither was).
    """
    items = F.transform(F.split(F.upper(values), ","), lambda x: F.trim(x))
    names, bases, codes = lexicon.lookup(lexicon.NAME_TO_THREE), lexicon.lookup(lexicon.BASES), lexicon.lookup(lexicon.codons())
    three = lexicon.lookup(lexicon.THREE_TO_ONE)
    named = F.exists(items, lambda x: names[x].isNotNull() | three[x].isNotNull())
    based = F.exists(items, lambda x: bases[x].isNotNull() & names[x].isNull())
    by_codon = ~named & ~based
    out = F.transform(items, lambda x: F.coalesce(three[F.coalesce(names[x], x)], bases[x], F.when(by_codon, codes[x]), x))
    return F.struct(
        F.array_join(F.array_distinct(out), ",").alias("value"),
        named.alias("translated"),
        based.alias("base"),
        (by_codon & F.exists(items, lambda x: codes[x].isNotNull())).alias("codon"),
    )


def infer_level(c: Column, named_residue: Column, named_base: Column) -> Column:
    """Level letter of components: explicit prefix first, then what only a residue or only a base can be."""
    a, p, w, m = (c[x] for x in "apwm")
    bases = w.rlike("^[ACGTU]+$") & m.rlike("^[ACGTU]+$")
    return (
        F.when(F.lower(a).isin("c", "g", "m", "r", "n", "p"), F.lower(a))
        .when(p.rlike("^(EX|INTRON|IVS|Ex|ex|Intron|intron|Ivs|ivs)"), "c")
        .when(w.rlike(f"^{PROTEIN_ONLY}$") | m.rlike(f"^{PROTEIN_ONLY}$"), "p")
        .when(p.rlike(r"[+\-?]"), "c")
        .when(bases & (p.try_cast("bigint") > 3000), "c")
        .when(named_base, "c")
        .when(named_residue, "p")
        .otherwise("c")
    )


def mention_type(level: Column, c: Column) -> Column:
    """ProteinMutation, DNAMutation, their acid changes (no position), or SNP."""
    both = (c["w"] != "") & (c["m"] != "") & (c["p"] == "")
    kind = F.when(level == "p", "Protein").otherwise("DNA")
    return F.when(c["r"] != "", "SNP").when(both, F.concat(kind, F.lit("AcidChange"))).otherwise(F.concat(kind, F.lit("Mutation")))


def identifier_drop_reason(c: Column, etype: Column, ident: Column) -> Column:
    """Why an identifier is no variant, null if it is one."""
    t, p, w, m = (c[x] for x in "tpwm")
    protein_letter = w.rlike(f"^{PROTEIN_ONLY}$") | m.rlike(f"^{PROTEIN_ONLY}$")
    months = "^(JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC)$"
    rs = etype == "SNP"
    return (
        F.when(protein_letter & p.rlike("^[6-9][0-9]{3,}$"), "protein position too large")
        .when(rs & ident.rlike("^RS[0-9]+$"), "upper-case rs")
        .when(rs & ident.rlike("^[Rr][Ss][0-9]{1,2}$"), "rs too short")
        .when(rs & ident.rlike("^[Rr][Ss]0"), "rs starts with 0")
        .when(rs & ident.rlike("^[Rr][Ss]([0-9]{11,}|[5-9][0-9]{9,})$"), "rs too long")
        .when(~rs & (t != "") & (p == ""), "type without position")
        .when(p.rlike(r"^[-<)\]][0-9]+$") & (etype == "ProteinMutation"), "negative protein position")
        .when(p.contains(">"), "arrow in position")
        .when(w.rlike("^[BJOUZ]") | m.rlike("^[BJOUZ]"), "no residue")
        .when(~rs & (w == "") & (m == "") & (t == "") & ~p.contains("?"), "no components")
        .when(p.rlike("^[21][0-9]{3}$") & (w.rlike(months) | m.rlike(months)), "date")
        .when(etype.isin("DNAMutation", "ProteinMutation") & (t == "") & (w != "") & (m != "") & (F.length(w) != F.length(m)) & ~w.contains(",") & ~m.contains(","), "unequal lengths")
    )


def render_hgvs(ident: Column, style: str = "normaliser") -> Column:
    """HGVS name of an identifier, empty if it has none.

    Style ``normaliser`` puts the residue of a protein change before its position
    (p.F508del), ``converter`` behind the type (p.508delF).
    """
    v = parse_identifier(ident)
    level = F.when(v["seq"] == "", F.when(v["vtype"] == "FS", "p").otherwise("c")).otherwise(v["seq"])
    protein, dna = level == "p", level.isin("c", "g") if style == "normaliser" else level.isin("c", "g", "m", "r", "n")
    suffix = F.when(v["vtype"] == "INS", "ins").when(v["vtype"] == "DEL", "del").when(v["vtype"] == "INDEL", "delins").when(v["vtype"] == "DUP", "dup")
    dot = F.concat(level, F.lit("."))
    fields = F.size(F.split(ident, r"\|"))
    shift = F.concat(dot, v["wild"], v["pos"], v["mut"], F.lit("fsX"), v["fs_pos"])
    behind = F.concat(dot, v["pos"], suffix, v["mut"])
    out = (
        F.when((v["vtype"] == "SUB") & (fields >= 5) & protein, F.concat(dot, v["wild"], v["pos"], v["mut"]))
        .when((v["vtype"] == "SUB") & (fields >= 5) & dna, F.concat(dot, v["pos"], v["wild"], F.lit(">"), v["mut"]))
        .when((v["vtype"] == "FS") & (fields >= 6) & (protein | dna), shift)
        .when(suffix.isNotNull() & (fields >= 4) & protein, F.concat(dot, v["mut"], v["pos"], suffix) if style == "normaliser" else behind)
        .when(suffix.isNotNull() & (fields >= 4) & dna, behind)
    )
    return F.when((v["vtype"] == "SUB") & (v["pos"] == ""), "").otherwise(F.coalesce(out, F.lit("")))


def without_alternative(x: Column) -> Column:
    """An identifier without a single capital behind a comma at its end."""
    return F.regexp_replace(x, ",[A-Z]$", "")


def render_hgvs_item(item: Column, original: Column) -> Column:
    """The name of one normalised identifier (D11): rs ids stay, a frame shift with its place and both residues ends in fsX and the distance, one with less is the original mention.

    Empty where an identifier has no name; null stays null. Give columns, not long expressions: item is read many times.
    """
    v = parse_identifier(item)
    level = F.when(v["seq"] == "", "p").otherwise(v["seq"])
    shift = F.when(F.size(F.split(item, r"\|")) >= 5, F.concat(level, F.lit("."), v["wild"], v["pos"], v["mut"], F.lit("fsX"), v["fs_pos"])).otherwise(original)
    return F.when(item.rlike("^rs[0-9]+$"), item).when((v["vtype"] == "FS") & level.isin("p", "c", "g"), shift).otherwise(render_hgvs(item, "converter"))


def lookup_forms(ident: Column) -> Column:
    """Dictionary keys of a variant, each with its kind, without repeats.

    Struct kind, rank, key: the form itself, each pair of listed residues (of a
    listed wild residue with its own position, if there are as many), its
    reverse, a synonymous change as ``=``, the genomic form of a far position,
    the protein form of a short coding one, and the places next to it. DEL, INS,
    INDEL and DUP also have a key without residues, FS one without its place.
    """
    v = parse_identifier(ident)
    bar = lambda *x: F.concat_ws("|", *x)
    form = lambda kind, rank, key: F.struct(F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), key.alias("key"))
    seq, pos, near = v["seq"], v["pos"], v["pos"].try_cast("bigint")
    wilds, places = F.split(v["wild"], ","), F.split(v["pos"], ",")
    zipped = (F.size(wilds) == F.size(places)) & (F.size(wilds) > 1)
    placed = F.transform(wilds, lambda w, i: F.struct(w.alias("w"), F.when(zipped, F.get(places, i)).otherwise(pos).alias("p")))
    pairs = F.flatten(F.transform(placed, lambda x: F.transform(F.split(v["mut"], ","), lambda m: F.struct(x["w"].alias("w"), x["p"].alias("p"), m.alias("m")))))
    none = F.array().cast("array<struct<kind:string,rank:int,key:string>>")
    listed = F.when(F.size(pairs) > 1, F.array(form("direct", 0, bar(seq, F.lit("SUB"), v["wild"], pos, v["mut"])))).otherwise(none)
    direct = F.transform(pairs, lambda p: form("direct", 0, bar(seq, F.lit("SUB"), p["w"], p["p"], p["m"])))
    back = F.transform(pairs, lambda p: form("reversed", 1, bar(seq, F.lit("SUB"), p["m"], p["p"], p["w"])))
    same = F.transform(F.filter(pairs, lambda p: p["w"] == p["m"]), lambda p: form("direct", 0, bar(seq, F.lit("SUB"), p["w"], p["p"], F.lit("="))))
    far = F.when((seq == "c") & (F.length(pos) >= 5) & ~zipped, F.transform(pairs, lambda p: form("genomic", 2, bar(F.lit("g"), F.lit("SUB"), p["w"], p["p"], p["m"])))).otherwise(none)
    short = F.filter(pairs, lambda p: (seq == "c") & (p["p"].try_cast("bigint") < 3000))
    fallback = F.transform(short, lambda p: form("protein", 3, bar(F.lit("p"), F.lit("SUB"), p["w"], p["p"], p["m"])))
    beside = F.when(near.isNotNull(), F.flatten(F.transform(pairs, lambda p: F.array(*[form("beside", 4, bar(seq, F.lit("SUB"), p["w"], (near + k).cast("string"), p["m"])) for k in (-1, 1)])))).otherwise(none)
    subs = F.concat(listed, direct, back, same, far, fallback, beside)
    itself = form("direct", 0, ident)
    bare = F.array(itself, form("direct", 0, bar(seq, v["vtype"], pos, F.lit(""), F.when(v["vtype"] == "DUP", F.lit("")))))
    shift = F.array(itself, form("direct", 0, bar(seq, F.lit("FS"), v["wild"], pos, v["mut"], F.lit(""))))
    return F.array_distinct(F.when(v["vtype"] == "SUB", subs).when(v["vtype"].isin("DEL", "INS", "INDEL", "DUP"), bare).when(v["vtype"] == "FS", shift).otherwise(F.array(itself)))
