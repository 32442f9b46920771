"""Derived input views: one SQL text for Spark and for the engine that checks it.

Names in braces are tables. Variant mentions are put into whole documents, and
annotations and knowledge-base rows are made from the other tables, by
arithmetic that both engines do alike.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

AA = "ACDEFGHIKLMNPQRSTVWY"

# Names of residues for sentences in plain language: (letter, code, name).
NAMES = [("G", "Gly", "glycine"), ("R", "Arg", "arginine"), ("D", "Asp", "aspartic acid"), ("L", "Leu", "leucine"), ("V", "Val", "valine"), ("K", "Lys", "lysine"), ("S", "Ser", "serine")]


def named(k: int, number: str) -> str:
    """SQL: the k-th kind of name by a number."""
    return f"case {number} " + " ".join(f"when {i} then '{n[k]}'" for i, n in enumerate(NAMES)) + " end"


FIXTURES = {
    # a phrase behind each text, by the document's number, and the identifier that it means
    "fx_phrases": f"""
select doc_id, k, phrase, ident, length(text) + 8 start_off, concat(text, ' We saw ', phrase, '. It ended.') text from (
 select doc_id, k, text, case k
  when 0 then concat(wn, ' to ', mn, ' at codon ', p) when 1 then concat(mn, ' for ', wn, ' at position ', p) when 2 then concat('substitution of ', wn, ' by ', mn, ' at residue ', p)
  when 3 then concat('deletion of three bases at position ', p) when 4 then concat(mn, ' instead of ', wn, ' at amino acid ', p) when 5 then concat('insertion of ', wn, ' at codon ', p)
  when 6 then concat('codon ', p, ' ', wn, ' to ', mn) when 7 then concat(wc, ' ', p, ' is replaced with ', mc) when 8 then concat('adenine to guanine at nucleotide ', p)
  when 9 then concat('deletion of nucleotides ', p, ' to ', q) when 10 then concat(mn, ' replaces ', wn, ' at codon ', p) when 11 then concat('duplication of two amino acids at position ', p)
  when 12 then concat(wn, '-to-', mn, ' substitution at codon ', p) else concat('4 bp deletion at codon ', p) end phrase,
  case when k in (0, 1, 2, 4, 6, 7, 10, 12) then concat('p|SUB|', w, '|', p, '|', m) when k = 3 then concat('c|DEL|', p, '|3') when k = 5 then concat('p|INS|', p, '|', w)
   when k = 8 then concat('c|SUB|A|', p, '|G') when k = 9 then concat('c|DEL|', p, '_', q, '|') when k = 11 then concat('p|DUP|', p, '|2|') else concat('c|DEL|CODON', p, '|4') end ident
 from (select doc_id, text, n % 14 k, cast(n % 900 + 10 as string) p, cast(n % 900 + 13 as string) q, {named(0, "n % 7")} w, {named(1, "n % 7")} wc, {named(2, "n % 7")} wn,
  {named(0, "(n + 3) % 7")} m, {named(1, "(n + 3) % 7")} mc, {named(2, "(n + 3) % 7")} mn from (select doc_id, text, cast(doc_id as bigint) n from fx_docs) x) y) z
""",
    "fx_docs": f"""
select cast(doc_id as string) doc_id,
 concat(replace(replace(coalesce(text, ''), chr(10), ' '), chr(9), ' '), ' Mutation ',
  substr('{AA}', cast(doc_id % 20 + 1 as int), 1), cast(doc_id % 900 + 10 as string),
  substr('{AA}', cast((doc_id * 7 + 3) % 20 + 1 as int), 1),
  ' (c.', cast(3 * (doc_id % 900 + 10) - 1 as string),
  substr('ACGT', cast(doc_id % 4 + 1 as int), 1), '>',
  substr('ACGT', cast((doc_id + 1) % 4 + 1 as int), 1),
  ', rs', cast(100000 + doc_id as string), ') in GENE', cast(doc_id % 50 as string), '.') text,
 length(coalesce(text, '')) + 10 m_start,
 concat(substr('{AA}', cast(doc_id % 20 + 1 as int), 1), cast(doc_id % 900 + 10 as string), substr('{AA}', cast((doc_id * 7 + 3) % 20 + 1 as int), 1)) m1,
 concat('c.', cast(3 * (doc_id % 900 + 10) - 1 as string), substr('ACGT', cast(doc_id % 4 + 1 as int), 1), '>', substr('ACGT', cast((doc_id + 1) % 4 + 1 as int), 1)) m2,
 concat('rs', cast(100000 + doc_id as string)) m3
from {{documents}}
""",
    "fx_ann": f"""
select (l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey ann_id, cast(l_orderkey % 1000 as string) doc_id,
 cast(l_linenumber * 97 + l_partkey % 50 as int) start_off,
 cast(l_linenumber * 97 + l_partkey % 50 + length(concat(w, p, u)) as int) end_off,
 concat(w, p, u) mention,
 case when l_linenumber % 4 = 0 then 'Gene' when l_linenumber % 4 = 3 then 'Species' else 'ProteinMutation' end etype,
 case when l_linenumber % 4 = 0 then cast(l_suppkey % 50 as string)
      when l_linenumber % 4 = 3 then cast(l_suppkey % 5 + 9600 as string)
      else concat('p|SUB|', w, '|', p, '|', u) end ident,
 cast((l_linenumber * 97 + l_partkey % 50) / 150 as int) sentence,
 cast(l_linenumber % 2 as int) passage_no, w, p, u
from (select l_orderkey, l_linenumber, l_suppkey, l_partkey,
  substr('{AA}', cast(l_partkey % 20 + 1 as int), 1) w, cast(l_partkey % 300 + 10 as string) p,
  substr('{AA}', cast(l_suppkey % 20 + 1 as int), 1) u from {{lineitem}}) m
""".replace("cast((l_linenumber * 97 + l_partkey % 50) / 150 as int)", "cast((l_linenumber * 97 + l_partkey % 50 - (l_linenumber * 97 + l_partkey % 50) % 150) / 150 as int)"),
    "fx_var2rs": f"""
select 'p' seq, concat('p|SUB|', substr('{AA}', cast(p_partkey % 20 + 1 as int), 1), '|', cast(p_partkey % 300 + 10 as string), '|', substr('{AA}', cast(p_size % 20 + 1 as int), 1)) form,
 100000 + p_partkey rs from {{part}}
""",
    "fx_gene2rs": "select cast(p_partkey % 50 as string) gene, 100000 + p_partkey rs from {part}",
    "fx_merged": "select 100000 + p_partkey origin, 200000 + p_partkey merged from {part} where p_partkey % 11 = 0",
    "fx_expired": "select 100000 + p_partkey rs from {part} where p_partkey % 13 = 0",
    "fx_history": "select form, cast(rs % 50 as string) gene, rs from fx_var2rs where rs % 3 = 0",
    "fx_components": f"""
select (l_orderkey * 10 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey id,
 case when l_linenumber % 2 = 0 then 'c' else 'p' end a,
 case when l_linenumber % 5 = 0 then 'deletion' when l_linenumber % 5 = 1 then 'INSERTED' when l_linenumber % 7 = 6 then 'duplication' else '' end t,
 case when l_partkey % 4 = 0 then concat(cast(l_partkey % 300 + 10 as string), '-', cast(l_partkey % 300 + 15 as string))
      when l_partkey % 4 = 1 then concat('codon', cast(l_partkey % 300 as string))
      when l_partkey % 4 = 2 then '' else cast(l_partkey % 300 + 10 as string) end p,
 case when l_suppkey % 3 = 0 then '' else substr('{AA}', cast(l_partkey % 20 + 1 as int), 1) end w,
 case when l_suppkey % 5 = 0 then '' else substr('{AA}', cast(l_suppkey % 20 + 1 as int), 1) end m,
 case when l_linenumber % 5 = 3 and l_linenumber % 2 = 1 then 'fs' else '' end f,
 case when l_linenumber % 5 = 3 and l_linenumber % 2 = 1 then cast(l_suppkey % 30 as string) else '' end s,
 case when l_linenumber % 7 = 6 and l_suppkey % 2 = 0 then cast(l_suppkey % 6 as string) else '' end d, '' r
from {{lineitem}}
""",
    # one row in 18 for each way in which components make no variant
    "fx_drop": """
select id, k, etype, case k when 0 then 'B' when 1 then 'K' when 5 then 'Ab' when 6 then 'T' when 7 then 'infinity' when 13 then 'Top' else w end w,
 case when k = 1 then '7123' when k in (2, 3) then '' when k = 4 then '-12' else p end p,
 case when k = 2 then 'EVIL' when k = 3 then '' when k = 6 then 'infinity' when k = 7 then 'T' when k = 14 then 'Xyz' when k in (8, 9, 10, 11, 12, 13, 15, 16) then 'R' else m end m,
 case when k in (2, 3) then 'delta' when k > 4 then 'SUB' else t end t, f, d,
 case k when 8 then 'Arg)3(Ser' when 9 then 'G>T>C' when 10 then 'Glu207,Thr209' when 11 then 'Glu207,Thr209,Gly211' when 12 then '450 G/L' when 15 then repeat('A', 201) else concat(w, p, m) end mention,
 case when k = 16 then 'C' else ' ' end behind
from (select *, id % 18 k, case when a = 'p' then 'ProteinMutation' else 'DNAMutation' end etype from fx_components) x
""",
    "fx_rs_rows": "select l_orderkey id, cast(l_orderkey % 1000 as string) doc_id, l_linenumber line, cast(l_linenumber as bigint) * 1000000000 + l_partkey * 10000 + l_suppkey n, 100000 + l_partkey rs from {lineitem}",
    "fx_freq": "select 100000 + p_partkey rs, cast(p_partkey % 17 as int) freq from {part}",
    "fx_rs2ca": f"""
select 100000 + p_partkey rs, concat('CA', cast(p_partkey * 3 + k as string)) ca,
 concat('c|SUB|', substr('ACGT', cast((p_partkey + k) % 4 + 1 as int), 1), '|', cast(p_partkey % 300 + 10 as string), '|', substr('ACGT', cast((p_partkey + k + 1) % 4 + 1 as int), 1)) dna_form,
 concat('p|SUB|', substr('{AA}', cast((p_partkey + k) % 20 + 1 as int), 1), '|', cast(p_partkey % 300 + 10 as string), '|', substr('{AA}', cast((p_size + k) % 20 + 1 as int), 1)) protein_form
from {{part}}, (select 0 k union all select 1 k union all select 2 k) ks
""",
    "fx_refseq": f"""
select cast(s_suppkey % 50 as string) gene, concat('NP_', cast(s_suppkey as string)) seqid, 'p' level,
 repeat(concat(substr('{AA}', cast(s_suppkey % 20 + 1 as int)), substr('{AA}', 1, cast(s_suppkey % 20 as int))), 20) seq from {{supplier}}
""",
    "fx_passages": """
select cast(doc_id as string) doc_id, k passage_no,
 case when k = 0 then 'title' when k = 1 then 'abstract' else 'table' end ptype,
 case when k = 0 then substr(t, 1, cast(length(t) % 60 as int)) when k = 1 then t else concat('a > b ', t) end text
from (select doc_id, replace(replace(replace(coalesce(text, ''), chr(10), ' '), chr(9), ' '), '|', '/') t from {documents}) d, (select 0 k union all select 1 k union all select 2 k) ks
""",
    # words of a gene and one or two variants, or of neither, behind each text
    "fx_fused": """
select doc_id, n % 6 k, gene, m1, length(text) + 1 start_off, word, concat(text, ' ', word, ' end') text from (
 select doc_id, text, n, gene, m1, case n % 6 when 0 then concat(gene, m1) when 1 then concat(m1, gene) when 2 then concat(gene, m1, gene, m1) when 3 then concat('QQ', m1) when 4 then gene else concat(gene, 'x', m1) end word
 from (select doc_id, text, m1, cast(doc_id as bigint) n, case cast(doc_id as bigint) % 5 when 0 then 'PTEN' when 1 then 'BRAF' when 2 then 'KRAS' when 3 then 'TP53' else 'EGFR' end gene from fx_docs) a) b
""",
    "fx_asked": "select substr(form, cast(p_partkey % 4 + 3 as int), cast(p_partkey % 7 + 1 as int)) needle, cast(p_partkey % 50 as string) gene from (select p_partkey, form, rs from {part} join fx_var2rs on rs = 100000 + p_partkey) x where p_partkey % 5 = 0",
    # a layout behind each text, by the document's number; # and a letter stand for its mentions
    "fx_layouts": """
select doc_id, k, m1, m2, m3, length(text) base, concat(text, ' ', tail, ' end') text, tail from (
 select doc_id, k, m1, m2, m3, text, replace(replace(replace(case k
  when 0 then '(#p, #d; #s)' when 1 then '#d (#s) [#p]' when 2 then '#s (#p/ #d)' when 3 then '#p polymorphism (#s)'
  when 4 then '#d (#s with #p)' when 5 then '[#d, #p]' when 6 then '(#s #d)' when 7 then '#p (#s; other' when 8 then '#p (#d)'
  when 9 then '#s, protein #p' when 10 then '#s gene #d' when 11 then '#p: dbSNP ID: #s' when 12 then '#p dbSNP #s' when 13 then '(#p), dbSNP #s'
  when 14 then '(#p), (dbSNP #s)' when 15 then '#d (dbSNP #sA' when 16 then '#d 5''UTR (#s)' when 17 then '#p polymorphism in intron 12 (#s)'
  when 18 then '(#d and #p)' when 19 then '#d (#p, #s)' when 20 then '#d or (#s)' when 21 then '#s, protein #p (#d)' when 22 then '#p (#d) (#s' else '#p #d #s' end,
  '#p', m1), '#d', m2), '#s', m3) tail from (select *, cast(doc_id as bigint) % 24 k from fx_docs) x) y
""",
    "fx_layout_ann": """
select cast(doc_id as bigint) * 3 + t ann_id, doc_id, base + instr(tail, m) start_off, base + instr(tail, m) + length(m) end_off, m mention, etype, ident, text, k
from (select l.*, t, case t when 0 then m1 when 1 then m2 else m3 end m, case t when 0 then 'ProteinMutation' when 1 then 'DNAMutation' else 'SNP' end etype,
 case t when 0 then concat('p|', m1) when 1 then concat('c|', m2) else m3 end ident from fx_layouts l, (select 0 t union all select 1 t union all select 2 t) ts) z
where instr(tail, m) > 0
""",
    "fx_stats": """
select case when o_orderpriority < '3' then 'a' else 'b' end kind, concat('file', cast(o_custkey % 500 as string)) label,
 cast(o_orderkey % 3 + 1 as int) step, case when o_orderkey % 3 = 0 then 'extract' when o_orderkey % 3 = 1 then 'genes' else 'variants' end step_name,
 o_orderkey % 100000 chars, o_orderkey % 20000 words, o_custkey % 7200 as seconds, o_orderkey uid from {orders}
""",
}
#: Fixtures that a fixture reads.
USES = {"fx_phrases": ["fx_docs"], "fx_fused": ["fx_docs"], "fx_asked": ["fx_var2rs"], "fx_drop": ["fx_components"], "fx_history": ["fx_var2rs"], "fx_layouts": ["fx_docs"], "fx_layout_ann": ["fx_docs", "fx_layouts"]}


def needs(sql: str) -> list[str]:
    """The fixtures that a text names, those they read first."""
    out: list[str] = []
    for name in FIXTURES:
        if re.search(rf"\b{name}\b", sql):
            for n in [*USES.get(name, []), name]:
                if n not in out:
                    out.append(n)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a DataFrame."""
    sql = FIXTURES[name]
    frames = {t: table(spark, sf_dir, t) for t in re.findall(r"\{(\w+)\}", sql)}
    for n in USES.get(name, []) if name != "fx_layout_ann" else ["fx_layouts"]:
        frames[n] = fixture(spark, sf_dir, n)
        sql = re.sub(rf"\b{n}\b", f"{{{n}}}", sql)
    return spark.sql(sql, **frames)


def oracle(sql: str) -> str:
    """The checking engine's query: the fixtures it needs as common tables, then the query itself."""
    parts = [f"{n} AS ({FIXTURES[n].format(**{t: t for t in re.findall(r'{(\w+)}', FIXTURES[n])}).strip()})" for n in needs(sql)]
    head = ",\n".join(parts)
    body = sql.strip()
    if not head:
        return body
    if re.match(r"(?i)with\s+recursive\b", body):
        return f"WITH RECURSIVE {head},\n{body[len('with recursive'):]}"
    if re.match(r"(?i)with\b", body):
        return f"WITH {head},\n{body[len('with'):]}"
    return f"WITH {head}\n{body}"
