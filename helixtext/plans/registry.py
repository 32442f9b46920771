"""All registered queries of the text-mining operators and the SQL that checks them."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtext.functions import lexicon, text, variants
from helixtext.functions.shared import checkpointed, shared_path
from helixtext.operators import associate, canon, chart, documents, layouts, normalize, report, spans
from helixtext.sources import bioc, knowledge, pubtator, store
from helixtext.streaming import ingest

from . import fixtures

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
AA = fixtures.AA


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a function under its name, with SQL over fixtures and tables where SQL can say it."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = fixtures.oracle(sql)
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


class Inputs:
    """The fixtures of one data folder by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in fixtures.FIXTURES:
            return fixtures.fixture(self.spark, self.sf_dir, name)
        return fixtures.table(self.spark, self.sf_dir, name)


def cased(column: str, mapping: dict[str, str], default: str) -> str:
    return f"case {column} " + " ".join(f"when '{k}' then '{v}'" for k, v in mapping.items()) + f" else {default} end"


# --- spans -----------------------------------------------------------------

INSERTED = """
select doc_id, cast(m_start as int) start_off, cast(m_start + length(m1) as int) end_off, m1 mention, 'ProteinMutation' etype from fx_docs
union all select doc_id, cast(m_start + length(m1) + 2 as int), cast(m_start + length(m1) + 2 + length(m2) as int), m2, 'DNAMutation' from fx_docs
union all select doc_id, cast(m_start + length(m1) + length(m2) + 4 as int), cast(m_start + length(m1) + length(m2) + length(m3) + 4 as int), m3, 'SNP' from fx_docs
"""


@query(INSERTED)
def tag_hgvs(spark, sf_dir):
    return spans.tag_hgvs(Inputs(spark, sf_dir).fx_docs)


@query(f"""
select doc_id, cast(m_start + length(m1) + length(m2) + length(m3) + 9 as int) start_off,
 cast(m_start + length(m1) + length(m2) + length(m3) + 9 + length(concat('GENE', cast(cast(doc_id as bigint) % 50 as string))) as int) end_off,
 concat('GENE', cast(cast(doc_id as bigint) % 50 as string)) mention, 'Gene' etype from fx_docs
union all {INSERTED.split("union all")[2]}
""")
def tag_pattern_table(spark, sf_dir):
    return spans.tag_pattern_table(Inputs(spark, sf_dir).fx_docs, [("GENE[0-9]+", "Gene"), ("rs[0-9]{6,}", "SNP")])


@query("""
with a as (select doc_id, m_start, concat(m1, ' ', m3) x, length(m1) n1, length(m3) n3, m1, m3 from fx_docs)
select doc_id, cast(m_start as int) start_off, cast(m_start + n1 as int) end_off, m1 mention, 'ProteinMutation' etype from a
union all select doc_id, cast(m_start + n1 + 1 as int), cast(m_start + n1 + 1 + n3 as int), m3, 'SNP' from a
""")
def split_composites(spark, sf_dir):
    joint = F.concat("m1", F.lit(" "), "m3")
    d = Inputs(spark, sf_dir).fx_docs.select("doc_id", F.col("m_start").cast("int").alias("start_off"), (F.col("m_start") + F.length(joint)).cast("int").alias("end_off"), joint.alias("mention"), F.lit("ProteinMutation").alias("etype"))
    return spans.split_composites(d)


@query("""
select doc_id, start_off, end_off, min(mention) mention, count(*) n from (
 select distinct doc_id, start_off, end_off, mention, etype from fx_ann a where not exists (
  select 1 from fx_ann b where b.doc_id = a.doc_id and a.start_off < b.end_off and b.start_off < a.end_off
   and (b.end_off - b.start_off > a.end_off - a.start_off or (b.end_off - b.start_off = a.end_off - a.start_off and b.start_off < a.start_off)))
) x group by doc_id, start_off, end_off
""")
def resolve_span_conflicts(spark, sf_dir):
    kept = spans.resolve_conflicts(Inputs(spark, sf_dir).fx_ann.select("doc_id", "start_off", "end_off", "mention", "etype"))
    return kept.groupBy("doc_id", "start_off", "end_off").agg(F.min("mention").alias("mention"), F.count("*").alias("n"))


@query("""
with l as (select cast(l_orderkey as string) doc_id, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity) tok_no, cast(l_partkey as string) token,
   case when l_suppkey % 4 = 0 then 'O' when l_suppkey % 4 = 1 then 'W' when l_suppkey % 4 = 2 then 'P' else 'M' end label from lineitem),
 o as (select *, lag(label, 1, 'O') over (partition by doc_id order by tok_no) before from l),
 r as (select *, sum(case when label <> 'O' and before = 'O' then 1 else 0 end) over (partition by doc_id order by tok_no) run from o),
 i as (select *, lag(label, 1, '') over (partition by doc_id, run order by tok_no) inside from r where label <> 'O'),
 q as (select *, sum(case when label <> inside then 1 else 0 end) over (partition by doc_id, run order by tok_no) part from i),
 g as (select doc_id, run, part, label, min(tok_no) s, max(tok_no) e, string_agg(token, '' order by tok_no) v from q group by all)
select doc_id, cast(min(s) * 10 as int) start_off, cast(max(e) * 10 + 5 as int) end_off,
 coalesce(string_agg(v, ',' order by part) filter (label = 'W'), '') w, coalesce(string_agg(v, ',' order by part) filter (label = 'P'), '') p,
 coalesce(string_agg(v, ',' order by part) filter (label = 'M'), '') m
from g group by doc_id, run
""")
def label_runs(spark, sf_dir):
    tag = F.when(F.col("l_suppkey") % 4 == 0, "O").when(F.col("l_suppkey") % 4 == 1, "W").when(F.col("l_suppkey") % 4 == 2, "P").otherwise("M")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    rows = Inputs(spark, sf_dir).lineitem.withColumn("tok_no", F.row_number().over(order)).select(F.col("l_orderkey").cast("string").alias("doc_id"), "tok_no", F.col("l_partkey").cast("string").alias("token"), (F.col("tok_no") * 10).alias("start_off"), (F.col("tok_no") * 10 + 5).alias("end_off"), tag.alias("label"))
    return spans.label_runs(rows).select("doc_id", "start_off", "end_off", "w", "p", "m")


@query("""
select ann_id, case when w in ('B','J','O','U','Z') then 'no residue'
 when etype = 'ProteinMutation' and cast(p as int) < 0 then 'negative protein position' end drop_reason from fx_ann where etype = 'ProteinMutation'
""")
def filter_mentions(spark, sf_dir):
    a = Inputs(spark, sf_dir).fx_ann.where("etype = 'ProteinMutation'")
    return a.select("ann_id", spans.mention_drop_reason(F.col("mention"), F.col("etype")).alias("drop_reason"))


@query("""
select ann_id, case when s.mention is not null then 'stop mention' when a.mention like 'C%H' and regexp_full_match(a.mention, 'C[0-9]+H') then 'hydrocarbon' end drop_reason
from fx_ann a left join (select distinct mention from fx_ann where ann_id % 7 = 0) s on a.mention = s.mention
""")
def filter_lexicon(spark, sf_dir):
    a = Inputs(spark, sf_dir).fx_ann
    return spans.filter_lexicon(a, a.where("ann_id % 7 = 0").select("mention")).select("ann_id", "drop_reason")


@query("""
select ann_id, case when exists (select 1 from (select substr('ACDEF', cast(k as int), 1) a, substr('WYVTS', cast(k as int), 1) b from range(1, 6) t(k)) x
  where (x.a = w and x.b = u) or (x.b = w and x.a = u)) then 'unlikely pair' end drop_reason from fx_ann
""")
def filter_unlikely_pairs(spark, sf_dir):
    pairs = spark.createDataFrame(list(zip("ACDEF", "WYVTS", strict=True)), "a string, b string")
    a = Inputs(spark, sf_dir).fx_ann.select("ann_id", F.col("w").alias("wild"), F.col("u").alias("mut"))
    return spans.filter_unlikely_pairs(a, pairs).select("ann_id", "drop_reason")


CUES = (" see Figure ", " in Figs. ", " of table 2A and ", " in Tabs 1, ", " see figures ", " in the text, of ", " configured as ", " Tableau of a 3 ")


@query(f"select doc_id, case when cast(doc_id as bigint) % {len(CUES)} < 5 then 'figure or table' end drop_reason from fx_docs")
def filter_context(spark, sf_dir):
    cue = F.array(*map(F.lit, CUES))[(F.col("doc_id").cast("long") % len(CUES)).cast("int")]
    d = Inputs(spark, sf_dir).fx_docs.withColumn("text", F.concat("text", cue, "m1"))
    s = d.select("doc_id", (F.length("text") - F.length("m1")).alias("start_off"), F.length("text").alias("end_off"), F.col("m1").alias("mention"))
    return spans.filter_context(s, d).select("doc_id", "drop_reason")


@query("""
select doc_id, k.kind etype, m_start + length(pre) start_off, m_start + length(pre) + length(t) end_off, t mention from (
 select doc_id, length(text) m_start, ' on ' pre, concat('chr', cast(cast(doc_id as int) % 22 + 1 as string), ':', cast(cast(doc_id as int) * 1000 + 5 as string), '-', cast(cast(doc_id as int) * 1000 + 900 as string)) t from fx_docs
) x, (select 'GenomicRegion' kind) k
""")
def tag_regions(spark, sf_dir):
    n = F.col("doc_id").cast("int")
    t = F.concat(F.lit("chr"), (n % 22 + 1).cast("string"), F.lit(":"), (n * 1000 + 5).cast("string"), F.lit("-"), (n * 1000 + 900).cast("string"))
    d = Inputs(spark, sf_dir).fx_docs.select("doc_id", F.concat("text", F.lit(" on "), t, F.lit(".")).alias("text"))
    return spans.tag_regions(d).select("doc_id", "etype", F.col("start_off").cast("bigint").alias("start_off"), F.col("end_off").cast("bigint").alias("end_off"), "mention")


@query("""
select doc_id, cast(n + 4 as int) start_off, cast(n + 4 + length(t) as int) end_off, t mention, 'RefSeq' etype
from (select doc_id, length(text) n, concat('NM_', cast(100000 + cast(doc_id as int) as string), '.', cast(cast(doc_id as int) % 9 + 1 as string)) t from fx_docs) x
""")
def tag_refseq(spark, sf_dir):
    n = F.col("doc_id").cast("int")
    d = Inputs(spark, sf_dir).fx_docs.select("doc_id", F.concat("text", F.lit(" in "), F.lit("NM_"), (n + 100000).cast("string"), F.lit("."), (n % 9 + 1).cast("string"), F.lit(". End")).alias("text"))
    return spans.tag_refseq(d)


@query("""
select distinct doc_id, cast(length(text) + 5 as int) start_off, cast(length(text) + 5 + length(m1) - 1 as int) end_off, substr(m1, 1, length(m1) - 1) mention from fx_docs
""")
def tag_document_alleles(spark, sf_dir):
    d = Inputs(spark, sf_dir).fx_docs
    docs = d.select("doc_id", F.concat("text", F.lit(" and "), F.expr("substr(m1, 1, length(m1) - 1)"), F.lit(" too")).alias("text"))
    parts = d.select("doc_id", F.lit("ProteinMutation").alias("etype"), F.substring("m1", 1, 1).alias("wild"), F.expr("substr(m1, 2, length(m1) - 2)").alias("pos"), F.expr("right(m1, 1)").alias("mut"))
    return spans.tag_document_alleles(docs, parts).drop("etype")


@query("""
select doc_id, cast(n + 7 as int) start_off, cast(n + 7 + length(concat('GENE', g, m1)) as int) end_off, concat('GENE', g, m1) mention, 'ProteinMutation' etype, concat('id', m1) ident
from (select doc_id, m1, length(text) n, cast(cast(doc_id as int) % 50 as string) g from fx_docs) x
""")
def tag_fused_lexicon(spark, sf_dir):
    d = Inputs(spark, sf_dir).fx_docs
    fused = F.concat(F.lit("GENE"), (F.col("doc_id").cast("int") % 50).cast("string"), "m1")
    tokens = documents.tokenize(d.select("doc_id", F.concat("text", F.lit(" Here, "), fused, F.lit(" is found.")).alias("text")))
    lex = d.select(spans.normal_key(fused).alias("key"), F.lit("ProteinMutation").alias("etype"), F.concat(F.lit("id"), "m1").alias("ident")).distinct()
    return spans.tag_fused_lexicon(tokens, lex, 10)


@query("""
with e as (select distinct lower(mention) k from fx_ann where ann_id % 3 = 0), p as (select distinct substr(k, 1, cast(n as int)) k from e, range(1, 12) t(n) where n < length(k) or (n = 1))
select m.mention, case when e.k is not null then concat('c', m.mention) when p.k is not null then '-2' else '-3' end status
from (select distinct case when ann_id % 5 = 0 then substr(mention, 1, 2) else mention end mention from fx_ann) m left join e on lower(m.mention) = e.k left join p on lower(m.mention) = p.k
""")
def lookup_mentions(spark, sf_dir):
    a = Inputs(spark, sf_dir).fx_ann
    lex = a.where("ann_id % 3 = 0").select(F.col("mention").alias("name"), F.concat(F.lit("c"), "mention").alias("ident")).distinct()
    return spans.lookup_mentions(a.select(F.expr("case when ann_id % 5 = 0 then substr(mention, 1, 2) else mention end").alias("mention")).distinct(), lex)


@query("select mention, w, p, u m, concat('p|SUB|', w, '|', p, '|', u) ident, 'ProteinMutation' etype from (select distinct mention, w, p, u from fx_ann) x")
def parse_components(spark, sf_dir):
    m = Inputs(spark, sf_dir).fx_ann.select("mention").distinct().withColumn("etype", F.lit(""))
    return canon.canonicalise(m).select("mention", F.col("c.w").alias("w"), F.col("c.p").alias("p"), F.col("c.m").alias("m"), "ident", "etype")


@query("select distinct phrase mention, ident from fx_phrases")
def parse_phrases(spark, sf_dir):
    mentions = Inputs(spark, sf_dir).fx_phrases.select(F.col("phrase").alias("mention")).distinct().withColumn("etype", F.lit(""))
    return canon.canonicalise(mentions).select("mention", "ident")


@query("select doc_id, cast(start_off as int) start_off, cast(start_off + length(phrase) as int) end_off, phrase mention, ident from fx_phrases")
def tag_phrases(spark, sf_dir):
    found = chart.tag_phrases(Inputs(spark, sf_dir).fx_phrases.select("doc_id", "text"))
    return canon.canonicalise(found).select("doc_id", "start_off", "end_off", "mention", "ident")


@query("select distinct mention, concat('p|SUB|', w, '|', p, '|', u) ident, 'ProteinMutation' etype from fx_ann")
def mention_list_to_form(spark, sf_dir):
    return canon.mention_list_to_form(Inputs(spark, sf_dir).fx_ann)


@query("""
select doc_id, cast(n + 4 as int) start_off,
 cast(n + 4 + length(x) as int) end_off, x mention from (select doc_id, length(text) n, case when cast(doc_id as int) % 2 = 0 then concat('NM_1234.5:', m2) else m2 end x from fx_docs) y
""")
def attach_refseq_prefix(spark, sf_dir):
    d = Inputs(spark, sf_dir).fx_docs
    prefix = F.when(F.col("doc_id").cast("int") % 2 == 0, "NM_1234.5:").otherwise("")
    docs = d.select("doc_id", "m2", F.concat("text", F.lit("see "), prefix, "m2").alias("text"))
    s = docs.select("doc_id", (F.length("text") - F.length("m2")).alias("start_off"), F.length("text").alias("end_off"), F.col("m2").alias("mention"))
    return spans.attach_refseq_prefix(s, docs)


@query("""
select doc_id, cast(length(text) + 3 as int) start_off, cast(length(text) + 5 + length(m2) as int) end_off, concat('(', m2, ')') mention, 'DNAMutation' etype from fx_docs where cast(doc_id as int) % 2 = 0
union all select doc_id, cast(length(text) + 4 as int), cast(length(text) + 4 + length(m2) + 2 as int), concat(m2, '/A'), 'DNAMutation' from fx_docs where cast(doc_id as int) % 2 = 1
""")
def repair_boundaries(spark, sf_dir):
    d = Inputs(spark, sf_dir).fx_docs
    even = F.col("doc_id").cast("int") % 2 == 0
    docs = d.select("doc_id", "m2", F.length("text").alias("n"), F.when(even, F.concat("text", F.lit("in ("), "m2", F.lit(") x"))).otherwise(F.concat("text", F.lit("see "), "m2", F.lit("/A x"))).alias("text"))
    s = docs.select("doc_id", (F.col("n") + F.when(F.col("doc_id").cast("int") % 2 == 0, 3).otherwise(4)).alias("start_off"), (F.col("n") + F.length("m2") + 4).alias("end_off"), F.when(F.col("doc_id").cast("int") % 2 == 0, F.concat(F.lit("("), "m2")).otherwise(F.col("m2")).alias("mention"), F.lit("DNAMutation").alias("etype"))
    return spans.repair_boundaries(s, docs)


# --- canonical forms -------------------------------------------------------

HGVS_P = "concat('p.', w, p, u)"


@query(f"select ident, {HGVS_P} normaliser, {HGVS_P} converter from (select distinct ident, w, p, u from fx_ann where etype = 'ProteinMutation') x")
def render_hgvs(spark, sf_dir):
    d = Inputs(spark, sf_dir).fx_ann.where("etype = 'ProteinMutation'").select("ident").distinct()
    return d.select("ident", variants.render_hgvs(F.col("ident")).alias("normaliser"), variants.render_hgvs(F.col("ident"), "converter").alias("converter"))


@query("""
with i as (select id, a, case when t in ('deletion') then 'DEL' when t = 'INSERTED' then 'INS' when t = 'duplication' then 'DUP' else '' end t, p, w, m, f, s, d from fx_components)
select id, case when t = 'DUP' and d <> '' then concat(a, '|DUP|', p, '|', m, '|', d) when t = 'DUP' then concat(a, '|DUP|', p, '|', m, '|')
 when t <> '' then concat(a, '|', t, '|', p, '|', m) when f <> '' then concat(a, '|FS|', w, '|', p, '|', m, '|', s)
 when w = '' and m <> '' then concat(a, '|Allele|', m, '|', p) when m = '' and w <> '' then concat(a, '|Allele|', w, '|', p)
 else concat(a, '|SUB|', w, '|', p, '|', m) end ident, t from i
""")
def build_identifier(spark, sf_dir):
    c = Inputs(spark, sf_dir).fx_components.withColumn("t", variants.canonical_type(F.col("t")))
    return c.select("id", variants.build_identifier(F.struct(*[F.col(x) for x in "atpwmfsdr"])).alias("ident"), "t")


@query("""
select id, case when a = 'p' then x else case when x like 'CODON%' then x else x end end p from (
 select id, a, case when contains(p, '-') then replace(p, '-', '_') when a = 'p' then replace(upper(p), 'CODON', '') else upper(p) end x from fx_components) y
""")
def canonical_position(spark, sf_dir):
    c = Inputs(spark, sf_dir).fx_components
    return c.select("id", variants.canonical_position(F.col("p"), F.col("a") == "p", F.lit(False)).alias("p"))


@query(f"""
with c as (select id, w, m, substr('{AA}', 1, 0) z from fx_components where w <> '' and m <> ''),
 t(one, three) as (values {", ".join(f"('{k}', '{v}')" for k, v in lexicon.ONE_TO_THREE.items())})
select id, case when w = m then w else concat(w, ',', m) end value, true translated from c
""")
def translate_residues(spark, sf_dir):
    c = Inputs(spark, sf_dir).fx_components.where("w <> '' and m <> ''")
    three = lexicon.lookup(lexicon.ONE_TO_THREE)
    r = variants.translate_residues(F.concat_ws(",", three[F.col("w")], three[F.col("m")]))
    return c.select("id", r["value"].alias("value"), r["translated"].alias("translated"))


@query("""
with x as (select ann_id, doc_id, case when ann_id % 11 = 0 then concat('c.', p, 'A>G') else mention end mention, etype from fx_ann),
 e as (select doc_id, count(*) filter (regexp_matches(mention, '[ACGT]>[ACGT]')) arrows,
  count(*) filter (regexp_full_match(mention, '[A-Z][0-9]+[A-Z]') and (regexp_matches(mention, '^[^ACGT][0-9]') or regexp_matches(mention, '[0-9][^ACGT]$'))) residues
 from x group by doc_id)
select ann_id, mention, case when regexp_matches(mention, '^[cgmr][.]|>') then 'DNAMutation'
 when regexp_full_match(mention, '[ACGT][0-9]+[ACGT]') and ((residues > 0 and arrows > 0) or residues > 50) then 'ProteinMutation'
 when regexp_full_match(mention, '[ACGT][0-9]+[ACGT]') then 'DNAMutation' else etype end etype
from x join e using (doc_id)
""")
def retype_by_evidence(spark, sf_dir):
    a = Inputs(spark, sf_dir).fx_ann.withColumn("mention", F.expr("case when ann_id % 11 = 0 then concat('c.', p, 'A>G') else mention end"))
    return canon.retype_by_evidence(a.select("ann_id", "doc_id", "mention", "etype")).select("ann_id", "mention", "etype")


@query("""
with i as (select distinct ident, w, p, u, cast(p as int) n from fx_ann where etype = 'ProteinMutation')
select distinct * from (
 select ident, 'direct' kind, 0 rank, ident key from i union all
 select ident, 'reversed', 1, concat('p|SUB|', u, '|', p, '|', w) from i union all
 select ident, 'direct', 0, concat('p|SUB|', w, '|', p, '|=') from i where w = u union all
 select ident, 'beside', 4, concat('p|SUB|', w, '|', cast(n - 1 as string), '|', u) from i union all
 select ident, 'beside', 4, concat('p|SUB|', w, '|', cast(n + 1 as string), '|', u) from i) x
""")
def lookup_forms(spark, sf_dir):
    d = Inputs(spark, sf_dir).fx_ann.where("etype = 'ProteinMutation'").select("ident").distinct()
    return d.select("ident", F.explode(variants.lookup_forms(F.col("ident"))).alias("f")).select("ident", "f.*")


@query("""
select ann_id, x.rs, case when k.pos is not null then 'c' else 'p' end level, case when k.pos is not null then concat('c', substr(ident, 2)) else ident end ident, case when k.pos is not null then 'DNAMutation' else etype end etype
from (select ann_id, 100000 + cast(p as bigint) rs, p, ident, etype from fx_ann where etype = 'ProteinMutation') x
left join (select distinct 100000 + cast(p as bigint) rs, p pos from fx_ann where cast(p as int) % 3 = 0) k on x.rs = k.rs and x.p = k.pos
""")
def override_sequence(spark, sf_dir):
    a = Inputs(spark, sf_dir).fx_ann.where("etype = 'ProteinMutation'").select("ann_id", (F.col("p").cast("bigint") + 100000).alias("rs"), "ident", "etype", "p")
    known = a.where(F.col("p").cast("int") % 3 == 0).select("rs", F.col("p").alias("pos"), F.lit("c").alias("seq")).distinct()
    out = canon.override_sequence(a.drop("p"), known)
    return out.select("ann_id", "rs", variants.part(F.col("ident"), 0).alias("level"), "ident", "etype")


# --- normalisation ---------------------------------------------------------


@query("""
select g.gene, g.rs, case when e.rs is not null then g.rs else coalesce(m.merged, g.rs) end resolved,
 case when e.rs is not null then 'expired' when m.merged is not null then 'merged' else 'current' end status
from fx_gene2rs g left join fx_expired e on g.rs = e.rs left join fx_merged m on g.rs = m.origin
""")
def resolve_rs_status(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return normalize.resolve_rs_status(x.fx_gene2rs, x.fx_merged, x.fx_expired)


HITS = """
v as (select * from fx_ann where etype = 'ProteinMutation'),
f as (select ann_id, doc_id, ident form, 0 r from v union all select ann_id, doc_id, concat('p|SUB|', u, '|', p, '|', w), 1 from v),
h as (select ann_id, doc_id, rs, min(r) form_rank from f join fx_var2rs using (form) group by ann_id, doc_id, rs)
"""


def _variants(x: Inputs) -> DataFrame:
    return x.fx_ann.where("etype = 'ProteinMutation'")


def _hits(x: Inputs) -> DataFrame:
    return normalize.match_var2rs(_variants(x), x.fx_var2rs)


def _reached(x: Inputs) -> DataFrame:
    return normalize.reached_rs(_variants(x), x.fx_var2rs)


def _genes(x: Inputs) -> DataFrame:
    return x.fx_ann.where("etype = 'Gene'").withColumn("gene", F.col("ident"))


def _snps(x: Inputs) -> DataFrame:
    return x.fx_rs_rows.where("line = 1").select("doc_id", "rs")


@query(f"with {HITS} select ann_id, doc_id, rs, case form_rank when 0 then 'direct' else 'reversed' end kind, form_rank from h")
def match_var2rs(spark, sf_dir):
    return _hits(Inputs(spark, sf_dir))


@query("""
select distinct a.ann_id, h.rs, 'Mapping' source from fx_ann a join fx_history h on a.ident = h.form join fx_ann g on g.doc_id = a.doc_id and g.etype = 'Gene' and g.ident = h.gene where a.etype = 'ProteinMutation'
""")
def match_history(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return normalize.match_history(_variants(x), _genes(x), x.fx_history)


@query(f"with {HITS} select distinct ann_id, h.rs, 'SNPinText' source from h join fx_rs_rows s on s.line = 1 and s.doc_id = h.doc_id and s.rs = h.rs")
def match_rs_in_text(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return normalize.match_rs_in_text(_variants(x), _reached(x), _snps(x))


@query(f"""
with {HITS} select distinct ann_id, h.rs, 'RefSeq' source from h where exists (select 1 from fx_ann d where d.etype = 'Gene' and d.doc_id = h.doc_id and cast(d.ident as int) % 5 = h.rs % 5)
""")
def match_refseq(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    refs = x.fx_gene2rs.select("rs", F.concat(F.lit("NM_"), (F.col("rs") % 5).cast("string")).alias("refseq"))
    mentioned = _genes(x).select("doc_id", F.concat(F.lit("NM_"), (F.col("gene").cast("int") % 5).cast("string")).alias("refseq"))
    return normalize.match_refseq(_variants(x), _reached(x), refs, mentioned)


@query("""
with k as (select form, cast(rs % 50 as string) gene, rs, rs % 2 asks from fx_var2rs)
select distinct a.ann_id, k.gene, k.rs, 'Mapping' source from fx_ann a join k on a.ident = k.form
where a.etype = 'ProteinMutation' and (asks = 0 or exists (select 1 from fx_ann t where t.doc_id = a.doc_id and t.etype = 'Gene' and t.ident = k.gene))
""")
def match_var2gene(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    gene = (F.col("rs") % 50).cast("string")
    kb = x.fx_var2rs.select(F.col("form").alias("key"), gene.alias("gene"), "rs", F.when(F.col("rs") % 2 == 1, F.array(F.concat(F.lit("GENE"), gene))).otherwise(F.array().cast("array<string>")).alias("gene_tokens"), F.array().cast("array<string>").alias("species_tokens"))
    tokens = _genes(x).select("doc_id", F.concat(F.lit("gene"), "gene").alias("token"))
    return normalize.match_var2gene(_variants(x), kb, tokens)


BY_GENE = f"""
{HITS},
n as (select a.ann_id, g.ident gene, min(greatest(g.start_off - a.end_off, a.start_off - g.end_off, 0) + case when g.sentence <> a.sentence then 1000 else 0 end) distance
 from v a join fx_ann g on g.doc_id = a.doc_id and g.etype = 'Gene' group by a.ann_id, g.ident),
b as (select n.ann_id, n.gene, distance, h.rs, form_rank, dense_rank() over (partition by n.ann_id order by distance, n.gene) g
 from n join h on n.ann_id = h.ann_id join fx_gene2rs x on x.rs = h.rs and x.gene = n.gene),
c as (select *, dense_rank() over (partition by ann_id order by form_rank) k from b where g = 1),
bg as (select distinct ann_id, gene, rs, distance, 'GeneNormalized' source from c where k = 1)
"""


@query(f"with {BY_GENE} select * from bg")
def match_by_gene(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return normalize.match_by_gene(_variants(x), _genes(x), _reached(x), x.fx_gene2rs)


@query(f"""
with {BY_GENE},
every as (select distinct a.ann_id, h.rs, 'Mapping' source, 4 r from fx_ann a join fx_history h on a.ident = h.form join fx_ann g on g.doc_id = a.doc_id and g.etype = 'Gene' and g.ident = h.gene where a.etype = 'ProteinMutation'
 union all select distinct ann_id, h.rs, 'SNPinText', 5 from h join fx_rs_rows s on s.line = 1 and s.doc_id = h.doc_id and s.rs = h.rs
 union all select ann_id, rs, source, 7 from bg),
best as (select ann_id, min(r) r from every group by ann_id)
select ann_id, min(source) source, string_agg(cast(rs as string), ',' order by rs) rs from (select distinct ann_id, rs, source, r from every) e join best using (ann_id, r) group by ann_id
""")
def normalize_cascade(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    a, g = _variants(x), _genes(x)
    # two strategies read the same hits
    reached = checkpointed(_reached(x))
    found = [("Mapping", normalize.history_lists(a, g, x.fx_history)), ("SNPinText", normalize.in_text_lists(a, reached, _snps(x))), ("GeneNormalized", normalize.by_gene_lists(a, g, reached, x.fx_gene2rs))]
    return normalize.cascade_lists(found, normalize.joined)


# Eight sources: three known tables, four joins, and partners; the first that finds anything wins.
STAGED = """
known as (select ann_id, 500000 + ann_id % 97 * 1000 + ann_id % 1000 rs, case ann_id % 97 when 0 then 'Pattern' when 1 then 'Recognized' else 'Foundbefore' end source, ann_id % 97 + 1 r from fx_ann where etype = 'ProteinMutation' and ann_id % 97 < 3),
every as (select * from known
 union all select distinct a.ann_id, h.rs, 'Mapping' source, 4 r from fx_ann a join fx_history h on a.ident = h.form join fx_ann g on g.doc_id = a.doc_id and g.etype = 'Gene' and g.ident = h.gene where a.etype = 'ProteinMutation'
 union all select distinct ann_id, h.rs, 'SNPinText', 5 from h join fx_rs_rows s on s.line = 1 and s.doc_id = h.doc_id and s.rs = h.rs
 union all select distinct ann_id, h.rs, 'RefSeq', 6 from h where rs % 7 = 0 and exists (select 1 from fx_ann d where d.etype = 'Gene' and d.doc_id = h.doc_id and cast(d.ident as int) % 5 = h.rs % 5)
 union all select ann_id, rs, source, 7 from bg),
best as (select ann_id, min(r) r from every group by ann_id),
direct as (select distinct ann_id, rs, source from every join best using (ann_id, r)),
pairs as (select * from (select min(ann_id) over (partition by doc_id) a, ann_id b from fx_ann where etype = 'ProteinMutation') x where b % 5 = 3 and a <> b),
links as (select a, b from pairs union select b, a from pairs),
whole as (select * from direct union all select distinct l.b, d.rs, 'Extended' from links l join direct d on d.ann_id = l.a where l.b not in (select ann_id from direct))
"""


@query(f"with {BY_GENE}, {STAGED} select ann_id, min(source) source, string_agg(cast(rs as string), ',' order by rs) rs from whole group by ann_id")
def normalize_staged(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    a, g = _variants(x), _genes(x)
    known = a.where("ann_id % 97 < 3").select("ann_id", (500000 + F.col("ann_id") % 97 * 1000 + F.col("ann_id") % 1000).alias("rs"))
    refs = x.fx_gene2rs.where("rs % 7 = 0").select("rs", F.concat(F.lit("NM_"), (F.col("rs") % 5).cast("string")).alias("refseq"))
    mentioned = g.select("doc_id", F.concat(F.lit("NM_"), (F.col("gene").cast("int") % 5).cast("string")).alias("refseq"))
    links = a.select(F.min("ann_id").over(Window.partitionBy("doc_id")).alias("ann_a"), F.col("ann_id").alias("ann_b")).where("ann_b % 5 = 3 and ann_a <> ann_b")
    reached = lambda open_: normalize.reached_rs(open_, x.fx_var2rs)
    stages = [(source, lambda open_, k=k: known.where(F.col("ann_id") % 97 == k)) for k, source in enumerate(("Pattern", "Recognized", "Foundbefore"))]
    stages += [
        ("Mapping", lambda open_: normalize.history_lists(open_, g, x.fx_history)),
        ("SNPinText", lambda open_: normalize.in_text_lists(open_, reached(open_), _snps(x))),
        ("RefSeq", lambda open_: normalize.refseq_lists(open_, reached(open_), refs, mentioned)),
        ("GeneNormalized", lambda open_: normalize.by_gene_lists(open_, g, reached(open_), x.fx_gene2rs)),
    ]
    out, _ = normalize.resolve_in_stages(a, stages, links)
    return out.select("ann_id", "source", F.array_join(F.col("rs").cast("array<string>"), ",").alias("rs"))


_DROP = [
    ("(regexp_full_match(m, '[ISQMNPKDFHLRWVEYX]') or regexp_full_match(w, '[ISQMNPKDFHLRWVEYX]')) and regexp_full_match(p, '[6-9][0-9]{3,}')", "position too large"),
    ("m = '' and t = '' and f = '' and p = ''", "no position"),
    ("w = '' and t = '' and f = '' and d = '' and m <> ''", "no wild part"),
    ("m = '' and t = '' and f = '' and d = '' and w <> ''", "no mutant part"),
    ("t = 'delta' and p = '' and (m = '' or not regexp_full_match(m, '[ATCG0-9]*'))", "delta without place"),
    ("p[1] = '-' and etype = 'ProteinMutation'", "negative protein position"),
    ("w in ('B','J','O','U','Z') or m in ('B','J','O','U','Z')", "no residue"),
    ("w = 'Ab' or m = 'Ab'", "two letters"),
    ("(length(w) = 1 and m = 'infinity') or (length(m) = 1 and w = 'infinity')", "a word"),
    ("length(w) = 1 and m = 'Xyz' or length(m) = 1 and w = 'Top'", "a word"),
    ("behind = 'C'", "runs on"),
    ("contains(mention, ')3(')", "brackets turned round"),
    ("mention = 'G>T>C'", "two arrows"),
    ("mention[1:6] = 'Glu207'", "list of places"),
    ("contains(mention, 'G/L')", "grams per litre"),
    ("w = 'Top' or m = 'Xyz'", "no triplet"),
    ("length(mention) > 200", "too long"),
]


@query("select id, case " + " ".join(f"when {c} then '{r}'" for c, r in _DROP) + " end drop_reason from fx_drop")
def filter_components(spark, sf_dir):
    c = [F.col(x) for x in ("w", "p", "m", "t", "f", "d", "etype", "mention", "behind")]
    return Inputs(spark, sf_dir).fx_drop.select("id", spans.component_drop_reason(*c).alias("drop_reason"))


def _rs_lists(x: Inputs) -> DataFrame:
    return x.fx_rs_rows.groupBy("id", "doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "rs"))), lambda r: r["rs"]).alias("rs"))


@query("select r.id, string_agg(cast(r.rs as string), ',' order by coalesce(f.freq, 0) desc, r.rs) rs from fx_rs_rows r left join fx_freq f using (rs) group by r.id")
def order_rs(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return normalize.order_rs(_rs_lists(x), x.fx_freq).select("id", F.array_join(F.col("rs").cast("array<string>"), ",").alias("rs"))


@query("select id, rs from (select r.id, r.rs, row_number() over (partition by r.id order by coalesce(f.freq, 0) desc, r.n) k from fx_rs_rows r left join fx_freq f using (rs)) x where k = 1")
def top_rs(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return normalize.top_rs(_rs_lists(x), x.fx_freq)


@query("""
with n as (select id, doc_id, count(*) c, min(rs) one from fx_rs_rows group by id, doc_id), u as (select distinct doc_id, one from n where c = 1),
 k as (select distinct r.id, r.rs from fx_rs_rows r join u on u.doc_id = r.doc_id and u.one = r.rs join n on n.id = r.id where n.c > 1)
select r.doc_id, r.id, case when exists (select 1 from k where k.id = r.id) then (select string_agg(cast(rs as string), ',' order by rs) from k where k.id = r.id)
 else string_agg(cast(r.rs as string), ',' order by r.n) end rs from fx_rs_rows r group by r.doc_id, r.id
""")
def disambiguate_by_unique(spark, sf_dir):
    out = normalize.disambiguate_by_unique(_rs_lists(Inputs(spark, sf_dir)))
    return out.select("doc_id", "id", F.array_join(F.col("rs").cast("array<string>"), ",").alias("rs"))


@query("""
with g as (select rs, min(gene) kb from fx_gene2rs group by rs)
select r.id, r.n, r.rs, case when r.n % 2 = 0 then 'own' else g.kb end gene from fx_rs_rows r left join g using (rs)
""")
def rs_to_gene(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return normalize.rs_to_gene(x.fx_rs_rows.select("id", "n", "rs", F.when(F.col("n") % 2 == 0, "own").alias("gene")), x.fx_gene2rs)


@query("""
with h as (select cast(s_suppkey % 50 as string) gene, concat('h', cast(min(s_suppkey % 7) as string)) hg from supplier where s_suppkey % 50 < 20 group by s_suppkey % 50),
 o as (select cast(s_suppkey % 50 as string) gene, concat('o', cast(min(s_suppkey % 9) as string)) og from supplier where s_suppkey % 50 between 10 and 35 group by s_suppkey % 50),
 x as (select ann_id, a.ident gene, coalesce(hg, og, a.ident) human from fx_ann a left join h on h.gene = a.ident left join o on o.gene = a.ident where etype = 'Gene')
select ann_id, human gene, case when human <> gene then gene end original_gene, case when cast(gene as int) % 2 = 0 then 9606 else 10090 end tax from x
""")
def to_human_gene(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    k = F.col("s_suppkey")
    rows = lambda where, letter, m: x.supplier.where(where).select((k % 50).cast("string").alias("gene"), F.concat(F.lit(letter), (k % m).cast("string")).alias("human_gene"))
    out = normalize.to_human_gene(_genes(x).select("ann_id", "gene"), rows(k % 50 < 20, "h", 7), rows((k % 50).between(10, 35), "o", 9))
    tax = x.supplier.select((k % 50).cast("string").alias("gene"), F.when(k % 2 == 0, 9606).otherwise(10090).alias("tax")).distinct()
    return normalize.gene_to_taxon(out, tax)


@query("""
with v as (select ann_id, ident, 'p' s, w, u, 100000 + cast(p as bigint) rs from fx_ann where etype = 'ProteinMutation'),
 j as (select v.ann_id, c.ca, case when ident = protein_form then 2 when split_part(dna_form, '|', 3) = w and split_part(dna_form, '|', 5) = u then 3
  when split_part(dna_form, '|', 3) = translate(w, 'ACGT', 'TGCA') and split_part(dna_form, '|', 5) = translate(u, 'ACGT', 'TGCA') then 4
  when split_part(dna_form, '|', 3) = u and split_part(dna_form, '|', 5) = w then 5
  when split_part(dna_form, '|', 3) = translate(u, 'ACGT', 'TGCA') and split_part(dna_form, '|', 5) = translate(w, 'ACGT', 'TGCA') then 6
  when split_part(protein_form, '|', 3) = w and split_part(protein_form, '|', 5) = u then 7 when split_part(protein_form, '|', 3) = u and split_part(protein_form, '|', 5) = w then 8 end fit
  from v join fx_rs2ca c using (rs))
select ann_id, ca, fit from (select *, row_number() over (partition by ann_id order by fit, ca) k from j where fit is not null) x where k = 1
""")
def assign_allele_registry(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return normalize.assign_registry(_variants(x).select("ann_id", "ident", (F.col("p").cast("bigint") + 100000).alias("rs")), x.fx_rs2ca)


@query("select distinct v.rs from fx_var2rs v join fx_gene2rs g on g.rs = v.rs where contains(v.form, '|A|') and g.gene = '7'")
def intersect_var_gene(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return normalize.intersect_var_gene(x.fx_var2rs, x.fx_gene2rs, F.lit("|A|"), F.lit("7"), True)


@query("select distinct a.needle, a.gene, v.rs from fx_asked a join fx_var2rs v on contains(v.form, a.needle) join fx_gene2rs g on g.rs = v.rs and g.gene = a.gene")
def rs_containing(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return normalize.rs_containing(normalize.gram_index(x.fx_var2rs), x.fx_asked, x.fx_var2rs, x.fx_gene2rs)


@query("select r.id ann_id, r.rs, g.gene from fx_rs_rows r left join (select distinct rs, gene from fx_gene2rs) g using (rs)")
def genes_of_rs(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return normalize.genes_of_rs(_rs_lists(x).select(F.col("id").alias("ann_id"), "rs"), x.fx_gene2rs)


@query("""
with f as (select distinct form i, form from fx_history union select distinct form, concat('p|SUB|', split_part(form, '|', 5), '|', split_part(form, '|', 4), '|', split_part(form, '|', 3)) from fx_history),
 h as (select distinct i, rs from f join fx_var2rs using (form)), l as (select i, string_agg(cast(rs as string), ',' order by rs) found from h group by i)
select x.form, x.rs, l.found, exists (select 1 from h where h.i = x.form and h.rs = x.rs) agrees from fx_history x left join l on l.i = x.form
""")
def rebuild_history(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    out = normalize.rebuild_history(x.fx_history, x.fx_var2rs)
    return out.select("form", "rs", F.array_join(F.col("found").cast("array<string>"), ",").alias("found"), "agrees")


@query("""
select ann_id, 100000 + cast(p as bigint) rs, concat('NM_', cast(cast(p as bigint) % 10 as string)) transcript, (cast(p as bigint) + 50 - 1 = cast(p as bigint) + 49 + cast(p as bigint) % 2) agrees from fx_ann where etype = 'ProteinMutation'
""")
def check_cds_location(spark, sf_dir):
    a = _variants(Inputs(spark, sf_dir)).select("ann_id", "ident", F.col("p").cast("bigint").alias("n"), (F.col("p").cast("bigint") + 100000).alias("rs"))
    name = F.concat(F.lit("NM_"), (F.col("n") % 10).cast("string"))
    places = a.select("rs", name.alias("transcript"), (F.col("n") + 49 + F.col("n") % 2).alias("transcript_pos")).distinct()
    return normalize.check_cds_location(a, places, places.select("transcript", F.lit(50).alias("cds_start")).distinct())


@query("""
with a as (select ann_id, w, u, cast(p as int) n, cast(cast(p as int) % 50 as string) gene from fx_ann where etype = 'ProteinMutation'),
 j as (select ann_id, seqid, case when substr(seq, n, 1) = w then 'Matched-W' when substr(seq, n, 1) = u then 'Matched-M' when substr(seq, n + 1, 1) = w then 'PlusMatched-W' when substr(seq, n + 1, 1) = u then 'PlusMatched-M' end result from a join fx_refseq using (gene))
select ann_id, seqid, result from (select *, row_number() over (partition by ann_id order by seqid desc) k from j where result is not null) x where k = 1
""")
def check_sequence(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    a = _variants(x).select("ann_id", "ident", (F.col("p").cast("int") % 50).cast("string").alias("gene"))
    return normalize.check_sequence(a, x.fx_refseq)


# --- documents -------------------------------------------------------------


@query("select cast(doc_id as string) doc_id, cast(length(coalesce(text, '')) as bigint) chars, cast(len(list_filter(regexp_split_to_array(trim(regexp_replace(coalesce(text, ''), '[ \\t\\n\\v\\f\\r]+', ' ', 'g')), ' '), lambda x: x <> '')) as bigint) words from documents")
def char_word_counts(spark, sf_dir):
    return Inputs(spark, sf_dir).documents.select(F.col("doc_id").cast("string").alias("doc_id"), text.char_count(F.col("text")).alias("chars"), text.word_count(F.col("text")).alias("words"))


@query("""
with k as (select * from fx_passages where length(text) > 0)
select doc_id, passage_no, ptype, cast(coalesce(sum(length(text) + 1) over (partition by doc_id order by passage_no rows between unbounded preceding and 1 preceding), 0) as int) "offset", length(text) n from k
""")
def assemble_document(spark, sf_dir):
    return documents.assemble(Inputs(spark, sf_dir).fx_passages).select("doc_id", "passage_no", "ptype", "offset", F.length("text").cast("bigint").alias("n"))


@query("select cast(doc_id as string) doc_id, length(text) chars, length(text) > 5000 skipped from documents where text is not null")
def drop_oversize(spark, sf_dir):
    d = Inputs(spark, sf_dir).documents.where("text is not null").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    kept, log = documents.drop_oversize(d, 5000)
    return kept.select("doc_id", F.length("text").cast("bigint").alias("chars"), F.lit(False).alias("skipped")).unionByName(log.select("doc_id", "chars", F.lit(True).alias("skipped")))


@query("select doc_id, sha256(translate(text, '" + text.GREEK + text.SIGNS.replace("'", "''") + "', '" + text.GREEK_ASCII + text.SIGNS_ASCII.replace("'", "''") + "')) folded from fx_docs")
def fold_unicode(spark, sf_dir):
    return Inputs(spark, sf_dir).fx_docs.select("doc_id", F.sha2(text.fold_unicode(F.col("text")), 256).alias("folded"))


@query("""
select distinct source stem, case when regexp_full_match(source, '[0-9]+') then source else cast(cast(concat('0x', substr(h, 1, 16)) as ubigint) % 100000000 * (18446744073709551616::hugeint % 100000000) % 100000000 + cast(concat('0x', substr(h, 17, 16)) as ubigint) % 100000000 as hugeint) % 100000000 || '' end doc_key
from (select source, md5(source) h from documents where source is not null) x
""".replace("case when regexp_full_match(source, '[0-9]+') then source else cast(", "cast((").replace(" as hugeint) % 100000000 || '' end doc_key", ") % 100000000 as varchar) doc_key"))
def document_key(spark, sf_dir):
    d = Inputs(spark, sf_dir).documents.where("source is not null").select(F.col("source").alias("stem")).distinct()
    return d.select("stem", text.document_key(F.col("stem")).alias("doc_key"))


def _matches(pattern: str) -> str:
    """SQL: doc_id, i, tok, gap (what is before it since the last), last (its end) of all matches in fx_docs."""
    return rf"""
p as (select doc_id, regexp_extract_all(text, '{pattern}') m, regexp_split_to_array(text, '{pattern}') g from fx_docs),
q as (select doc_id, unnest(m) tok, unnest(g[1:len(m)]) gap, generate_subscripts(m, 1) i from p),
r as (select *, cast(sum(length(gap) + length(tok)) over (partition by doc_id order by i) as bigint) last_ from q)"""


@query("with " + _matches(r"[.!?]\s+[A-Z0-9(]") + " select doc_id, cast(i as int) sentence_no, cast(last_ - 1 as int) start_off from r union all select doc_id, 0, 0 from fx_docs")
def sentence_offsets(spark, sf_dir):
    return documents.sentence_offsets(Inputs(spark, sf_dir).fx_docs)


@query("with " + _matches(r"[0-9]+|[A-Z]?[a-z]+|[A-Z]|[^0-9A-Za-z\s]") + """
select doc_id, count(*) tokens, cast(sum(length(tok)) as bigint) chars, max(last_) last_end, cast(sum((last_ - length(tok)) * (i % 7)) as bigint) starts, cast(sum(ascii(tok) * (i % 5)) as bigint) firsts from r group by doc_id""")
def tokenize(spark, sf_dir):
    t = documents.tokenize(Inputs(spark, sf_dir).fx_docs)
    i = (F.col("tok_no") + 1).cast("long")
    return t.groupBy("doc_id").agg(F.count("*").alias("tokens"), F.sum(F.length("token")).alias("chars"), F.max("end_off").cast("long").alias("last_end"), F.sum(F.col("start_off") * (i % 7)).alias("starts"), F.sum(F.ascii("token") * (i % 5)).alias("firsts"))


GENE_NAMES = ("PTEN", "BRAF", "KRAS", "TP53", "EGFR")


@query("""
select doc_id, cast(start_off + o as int) start_off, gene token from fx_fused join (values (0, 0), (2, 0), (2, 1)) t(k, second) using (k), lateral (select case when second = 1 then length(gene) + length(m1) else 0 end o)
union all select doc_id, cast(start_off + length(m1) as int), gene from fx_fused where k = 1
""")
def tokenize_fused(spark, sf_dir):
    d = Inputs(spark, sf_dir).fx_fused
    genes = spark.createDataFrame([(g,) for g in GENE_NAMES], "name string")
    return documents.tokenize_fused(d.select("doc_id", "text"), genes).where(F.col("token").isin(*GENE_NAMES)).select("doc_id", "start_off", "token")


@query()
def token_features(spark, sf_dir):
    d = Inputs(spark, sf_dir).fx_docs
    return documents.token_features(documents.tagged_tokens(d, spans.tag_hgvs(d)))


@query("""
with m as (select distinct mention, w, p, u from fx_ann),
t as (select mention, 1 k, w token, '' before, p after from m union all select mention, 2, p, w, u from m union all select mention, 3, u, p, '' from m)
select mention, k, token, 'O' level, case when token = 'D' then 'type' else 'O' end type_word, case when k = 2 then 'O' when token in ('A', 'C', 'G', 'T') then 'base' else 'residue' end symbol,
 'O' region, 'O' shift, case when k = 2 then 'number' else 'O' end place, 'O' place_word, 'O' rs, before, after from t
""")
def mention_token_features(spark, sf_dir):
    f = documents.mention_token_features(Inputs(spark, sf_dir).fx_ann.select("mention"))
    return f.withColumn("k", F.row_number().over(Window.partitionBy("mention").orderBy("tok_no"))).drop("tok_no")


@query("""
select id, tok_no, regexp_full_match(token, '[a-z]{2}') and regexp_full_match(coalesce(before, ''), '[CISQMNPKDTFAGHLRWVEYX]') continues_residue
from (select cast(n_nationkey as string) id, t.k tok_no, case t.k when 0 then substr(n_name, 1, 1) when 1 then lower(substr(n_name, 2, 2)) else n_name end token,
 case t.k when 1 then substr(n_name, 1, 1) when 2 then lower(substr(n_name, 2, 2)) end before from nation, (select 0 k union all select 1 union all select 2) t) x
""")
def previous_token(spark, sf_dir):
    k = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))
    t = Inputs(spark, sf_dir).nation.select(F.col("n_nationkey").cast("string").alias("doc_id"), "n_name", k.alias("tok_no"))
    token = F.when(F.col("tok_no") == 0, F.substring("n_name", 1, 1)).when(F.col("tok_no") == 1, F.lower(F.substring("n_name", 2, 2))).otherwise(F.col("n_name"))
    start = F.when(F.col("tok_no") == 0, 0).when(F.col("tok_no") == 1, 1).otherwise(3)
    end = F.when(F.col("tok_no") == 0, 1).when(F.col("tok_no") == 1, 3).otherwise(20)
    rows = t.select("doc_id", "tok_no", token.alias("token"), start.alias("start_off"), end.alias("end_off"))
    return documents.previous_token(rows).select(F.col("doc_id").alias("id"), "tok_no", "continues_residue")


@query()
def previous_token_of_documents(spark, sf_dir):
    return documents.tokens_with_previous(Inputs(spark, sf_dir).fx_docs).select("doc_id", "tok_no", "token", "start_off", "end_off", "continues_residue")


@query("select doc_id, passage_no, sha256(case when ptype = 'table' then replace(replace(text, ' ', ';'), ';>;', ' > ') else text end) delimited, length(text) cleaned from fx_passages")
def clean_and_delimit(spark, sf_dir):
    p = Inputs(spark, sf_dir).fx_passages
    return p.select("doc_id", "passage_no", F.sha2(text.delimit_table_passage(F.col("ptype"), F.col("text")), 256).alias("delimited"), F.length(text.clean_text(F.concat(F.lit("\x07"), "text"))).cast("bigint").alias("cleaned"))


FILES = "select cast(doc_id as string) doc_id, case doc_id % 3 when 0 then concat('f', cast(doc_id as string), '.pdf') when 1 then concat('supp/s', cast(doc_id as string), '.pdf') else concat('supp/book', cast(doc_id % 7 as string), '/tab_', cast(doc_id as string), '.xlsx') end rel from documents"


def _files(x: Inputs) -> DataFrame:
    n, s = F.col("doc_id") % 3, F.col("doc_id").cast("string")
    rel = F.when(n == 0, F.concat(F.lit("f"), s, F.lit(".pdf"))).when(n == 1, F.concat(F.lit("supp/s"), s, F.lit(".pdf"))).otherwise(F.concat(F.lit("supp/book"), (F.col("doc_id") % 7).cast("string"), F.lit("/tab_"), s, F.lit(".xlsx")))
    return x.documents.select(s.alias("doc_id"), rel.alias("rel"))


@query(f"""
with f as ({FILES}), a as (select doc_id, count(*) n from fx_ann group by doc_id)
select f.doc_id, concat(case when contains(rel, '/') then 's' else 'm' end, cast(row_number() over (partition by contains(rel, '/') order by rel, f.doc_id) as string)) doc_key,
 case when len(string_split(rel, '/')) = 3 then concat(split_part(rel, '/', 2), ' / ', regexp_replace(split_part(rel, '/', 3), '[.][^.]*$', '')) else regexp_replace(list_last(string_split(rel, '/')), '[.][^.]*$', '') end label,
 case len(string_split(rel, '/')) when 1 then 'Main Publication' when 2 then 'Supplementary PDF' else 'Supplementary Spreadsheet' end category, coalesce(n, 0) annotations
from f left join a on a.doc_id = f.doc_id
""")
def document_index(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return report.document_index(_files(x), x.fx_ann)


@query(f"""
with f as ({FILES}), t as (select doc_id, text title from fx_passages where ptype = 'title' and length(text) > 0)
select f.doc_id, coalesce(title, case when contains(rel, 'book') then concat('stem', f.doc_id, ' — book') else concat('stem', f.doc_id) end) title from f left join t using (doc_id)
""")
def pick_title(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    files = _files(x).select("doc_id", text.path_category(F.col("rel")).alias("category"), F.concat(F.lit("stem"), "doc_id").alias("stem"), F.when(F.col("rel").contains("book"), "book").otherwise("").alias("parent"))
    return documents.pick_title(x.fx_passages, files)


@query("""
select file, sheet_no, row_no, lpad(cast(sheet_no as string), 2, '0') tab, id from (
 select l_suppkey file, l_linenumber sheet_no, cast(row_number() over (partition by l_suppkey, l_linenumber order by l_orderkey, l_partkey, l_quantity, l_extendedprice) as int) row_no, l_orderkey id from lineitem) x where row_no <= 100
""")
def cap_rows_per_sheet(spark, sf_dir):
    rows = Inputs(spark, sf_dir).lineitem.select(F.col("l_suppkey").alias("file"), F.col("l_linenumber").alias("sheet_no"), F.col("l_orderkey").alias("id"), F.struct("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice").alias("o"))
    return documents.cap_rows_per_sheet(rows, F.col("o"), 100).select("file", "sheet_no", "row_no", F.substring("tab", 5, 2).alias("tab"), "id")


# Of each second mention one component is written otherwise than in the text.
@query("""
with x as (select doc_id, cast(m_start as int) o, m1, length(m1) n, cast(doc_id as bigint) % 2 k from fx_docs)
select doc_id, substr(m1, 1, 1) token, o start_off, o + 1 end_off, 'W' label from x
union all select doc_id, substr(m1, 2, n - 2), o + 1, o + n - 1, case when k = 0 then 'P' else 'I' end from x
union all select doc_id, substr(m1, n, 1), o + n - 1, o + n, 'M' from x
union all select doc_id, concat('missing ', substr(m1, 2, n - 2), '?'), o, null, 'P' from x where k = 1
""")
def project_component_labels(spark, sf_dir):
    d = Inputs(spark, sf_dir).fx_docs
    place = F.expr("concat(substr(m1, 2, length(m1) - 2), if(cast(doc_id as bigint) % 2 = 1, '?', ''))")
    gold = d.select("doc_id", F.col("m_start").cast("int").alias("start_off"), (F.col("m_start") + F.length("m1")).cast("int").alias("end_off"), F.col("m1").alias("mention"), F.substring("m1", 1, 1).alias("w"), place.alias("p"), F.expr("right(m1, 1)").alias("m"), *[F.lit("").alias(x) for x in "atfsdr"])
    labelled = spans.project_component_labels(gold, documents.tokenize(d)).where("label <> 'O'").select("doc_id", "token", "start_off", "end_off", "label")
    missing = spans.missing_components(gold).select("doc_id", F.concat(F.lit("missing "), "value").alias("token"), "start_off", F.lit(None).cast("int").alias("end_off"), "label")
    return labelled.unionByName(missing)


@query("select doc_id, substr(m1, length(m1), 1) w, substr(m1, 1, 1) m from fx_docs")
def swap_direction(spark, sf_dir):
    d = Inputs(spark, sf_dir).fx_docs
    c = F.struct(*[{"w": F.substring("m1", 1, 1), "m": F.expr("right(m1, 1)")}.get(x, F.lit("")).alias(x) for x in "atpwmfsdr"])
    s = spans.swap_direction(c, F.concat(F.substring("m1", 1, 1), F.lit(" for "), F.expr("right(m1, 1)")))
    return d.select("doc_id", s["w"].alias("w"), s["m"].alias("m"))


@query("""
select id, case when p = '' or p like 'codon%' then (case when w in ('I','S','Q','M','N','P','K','D','F','H','L','R','W','V','E','Y','X') or m in ('I','S','Q','M','N','P','K','D','F','H','L','R','W','V','E','Y','X') then 'p' else 'c' end)
 when w in ('I','S','Q','M','N','P','K','D','F','H','L','R','W','V','E','Y','X') or m in ('I','S','Q','M','N','P','K','D','F','H','L','R','W','V','E','Y','X') then 'p' else 'c' end level from fx_components
""")
def infer_sequence_level(spark, sf_dir):
    c = Inputs(spark, sf_dir).fx_components.withColumn("a", F.lit(""))
    return c.select("id", variants.infer_level(F.struct(*[F.col(x) for x in "atpwmfsdr"]), F.lit(False), F.lit(False)).alias("level"))


@query("""
select id, case when w in ('I','S','Q','M','N','P','K','D','F','H','L','R','W','V','E','Y','X') and false then '' when t <> '' and p = '' then 'type without position' when w = '' and m = '' and t = '' then 'no components' end drop_reason from fx_components
""")
def filter_identifiers(spark, sf_dir):
    c = Inputs(spark, sf_dir).fx_components
    s = F.struct(*[F.col(x) for x in "atpwmfsdr"])
    return c.select("id", variants.identifier_drop_reason(s, F.lit("ProteinMutation"), F.lit("")).alias("drop_reason"))


# --- association -----------------------------------------------------------


@query("""
select ann_id from fx_ann g where etype = 'Gene' and not exists (select 1 from fx_ann v where v.etype = 'ProteinMutation' and v.doc_id = g.doc_id and g.start_off >= v.start_off and g.start_off < v.end_off)
""")
def drop_genes_on_variants(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return associate.drop_genes_on_variants(_genes(x), _variants(x)).select("ann_id")


@query("""
select ann_id, g gene from (select ann_id, unnest(string_split(concat(ident, ';', cast(cast(ident as int) + 100 as string)), ';')) g from fx_ann where etype = 'Gene') x
union all select ann_id, '673' from fx_ann where etype = 'Gene' and cast(ident as int) % 10 = 0
""")
def explode_gene_ids(spark, sf_dir):
    g = _genes(Inputs(spark, sf_dir)).withColumn("mention", F.when(F.col("ident").cast("int") % 10 == 0, "RAF").otherwise("x")).withColumn("ident", F.concat("ident", F.lit(";"), (F.col("ident").cast("int") + 100).cast("string")))
    return associate.explode_gene_ids(g).select("ann_id", "gene")


@query("select ann_id from fx_ann a where exists (select 1 from fx_ann m where m.doc_id = a.doc_id and m.etype = 'ProteinMutation')")
def gate_documents(spark, sf_dir):
    return associate.gate_documents(Inputs(spark, sf_dir).fx_ann).select("ann_id")


@query("""
with n as (select doc_id, ident gene, count(*) n from fx_ann where etype = 'Gene' group by all), r as (select *, row_number() over (partition by doc_id order by n desc, gene desc) k, sum(case when n >= 3 then 1 else 0 end) over (partition by doc_id) often from n)
select doc_id, gene, n, (often = 1 and n >= 3) fallback from r where k = 1
""")
def major_gene(spark, sf_dir):
    return associate.major_gene(_genes(Inputs(spark, sf_dir)))


@query("""
with j as (select a.ann_id, g.ident gene, greatest(g.start_off - a.end_off, a.start_off - g.end_off, 0) gap,
 case when g.sentence = a.sentence and not (g.start_off < a.end_off and a.start_off < g.end_off) then 0 when g.sentence = a.sentence - 1 then 1 when g.sentence = a.sentence + 1 then 2 when g.sentence = 0 then 3 when g.sentence < a.sentence then 4 end tier
 from fx_ann a join fx_ann g on g.doc_id = a.doc_id and g.etype = 'Gene' where a.etype = 'ProteinMutation')
select ann_id, gene, gap + 1000 * tier distance, tier from (select *, row_number() over (partition by ann_id order by tier, gap, gene) k from j where tier is not null) x where k = 1
""")
def nearest_gene_sentence(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return associate.nearest_gene_sentence(_variants(x), _genes(x))


def _flat_passages(x: Inputs) -> DataFrame:
    return x.fx_ann.select("doc_id", "passage_no").distinct().select("doc_id", "passage_no", F.when(F.col("passage_no") == 0, "body").otherwise("table").alias("ptype"), F.repeat(F.lit("a"), 1000).alias("text"), F.lit(0).alias("offset"))


@query("""
with j as (select a.ann_id, g.ident gene, case when g.start_off >= a.end_off then g.start_off - a.end_off else greatest(a.start_off - g.end_off, 0) end distance, g.start_off >= a.end_off after, a.passage_no
 from fx_ann a join fx_ann g on g.doc_id = a.doc_id and g.passage_no = a.passage_no and g.etype = 'Gene' where a.etype = 'ProteinMutation')
select ann_id, gene, distance from (select *, row_number() over (partition by ann_id order by distance, gene) k from j where not (after and passage_no = 1)) x where k = 1
""")
def nearest_gene_passage(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return associate.nearest_in_passage(_variants(x), _genes(x), "gene", _flat_passages(x))


@query("""
with j as (select a.ann_id, cast(g.ident as int) tax, case when g.start_off >= a.end_off then g.start_off - a.end_off else greatest(a.start_off - g.end_off, 0) end distance, g.start_off >= a.end_off after, a.passage_no
 from fx_ann a join fx_ann g on g.doc_id = a.doc_id and g.passage_no = a.passage_no and g.etype = 'Species' and g.ident <> '9602' where a.etype = 'ProteinMutation'),
 b as (select * from (select *, row_number() over (partition by ann_id order by distance, tax) k from j where not (after and passage_no = 1)) x where k = 1)
select a.ann_id, case when tax <> 9606 and distance <= 50 then tax else 9606 end tax from fx_ann a left join b using (ann_id) where a.etype = 'ProteinMutation'
""")
def nearest_species(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    species = x.fx_ann.where("etype = 'Species'").withColumn("tax", F.col("ident").cast("int"))
    return associate.nearest_species(_variants(x), species, _flat_passages(x), (9602,))


@query("""
with a as (select *, case when passage_no = 0 then 'body' else 'ref' end pt from fx_ann where etype = 'ProteinMutation')
select ann_id from a where pt = 'body' or exists (select 1 from a b where b.doc_id = a.doc_id and b.pt = 'body' and lower(b.mention) = lower(a.mention))
""")
def filter_reference_passages(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    p = _flat_passages(x).withColumn("ptype", F.when(F.col("passage_no") == 0, "body").otherwise("ref"))
    return associate.filter_reference_passages(_variants(x), p).select("ann_id")


EDGES = f"""
{HITS}, nodes as (select distinct doc_id, ident, p pos from v),
 r as (select distinct v.doc_id, ident, rs from v join h using (ann_id)), rl as (select doc_id, rs, min(ident) a from r group by all),
 pl as (select doc_id, pos, min(ident) a from nodes group by all),
 edges as (select r.doc_id, a, ident b, 'rs' reason from r join rl using (doc_id, rs) where ident <> a union select nodes.doc_id, a, ident, 'place' from nodes join pl using (doc_id, pos) where ident <> a)
"""


def _edges(x: Inputs) -> DataFrame:
    v = _variants(x)
    none = v.select(F.col("ann_id").alias("ann_a"), F.col("ann_id").alias("ann_b")).where("false")
    return associate.variant_edges(v, _reached(x), none)


@query(f"with {EDGES} select distinct * from edges")
def variant_edges(spark, sf_dir):
    return _edges(Inputs(spark, sf_dir))


@query(f"""
with recursive {HITS}, nodes as (select distinct doc_id, ident, p pos from v),
 r as (select distinct v.doc_id, ident, rs from v join h using (ann_id)), rl as (select doc_id, rs, min(ident) a from r group by all),
 pl as (select doc_id, pos, min(ident) a from nodes group by all),
 edges as (select r.doc_id, a, ident b from r join rl using (doc_id, rs) where ident <> a union select nodes.doc_id, a, ident from nodes join pl using (doc_id, pos) where ident <> a),
 sym as (select doc_id, a, b from edges union select doc_id, b, a from edges),
 reach as (select doc_id, ident, ident other from nodes union select reach.doc_id, reach.ident, sym.b from reach join sym on sym.doc_id = reach.doc_id and sym.a = reach.other),
 lab as (select doc_id, ident, min(other) label from reach group by all), fm as (select doc_id, ident, min(start_off) first from v group by all),
 g as (select lab.doc_id, lab.ident, label, min(first) over (partition by lab.doc_id, label) gf from lab join fm on fm.doc_id = lab.doc_id and fm.ident = lab.ident)
select doc_id, ident, cast(dense_rank() over (partition by doc_id order by gf, label) - 1 as int) group_id from g
""")
def variant_groups(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return associate.variant_groups(_variants(x), _edges(x))


MEMBERS = "select doc_id, ann_id, cast(p as int) % 40 group_id, case when ann_id % 3 = 0 then cast(p as int) + 100000 end rs, case when ann_id % 4 = 1 then u end gene, case when ann_id % 6 = 0 then 'Pattern' else 'Mapping' end source from fx_ann where etype = 'ProteinMutation'"


@query(f"""
with m as ({MEMBERS}), g as (select *, min_by(rs, ann_id) filter (rs is not null and source = 'Pattern') over w grs, min_by(gene, ann_id) filter (gene is not null) over w gg from m window w as (partition by doc_id, group_id))
select doc_id, ann_id, group_id, case when rs <> grs then rs end split_rs, coalesce(rs, grs) rs, coalesce(gene, case when grs is null then gg end) gene, case when rs is null and grs is not null then 'SameGroup' else source end source from g
""")
def propagate_group(spark, sf_dir):
    m = _variants(Inputs(spark, sf_dir)).selectExpr("doc_id", "ann_id", "cast(p as int) % 40 group_id", "case when ann_id % 3 = 0 then cast(p as int) + 100000 end rs", "case when ann_id % 4 = 1 then u end gene", "case when ann_id % 6 = 0 then 'Pattern' else 'Mapping' end source")
    return associate.propagate_group(m)


@query("""
select cast(d.doc_id as bigint) * 2 ann_a, cast(d.doc_id as bigint) * 2 + 1 ann_b, d.doc_id from fx_docs d
""")
def link_bracketed_mentions(spark, sf_dir):
    d = Inputs(spark, sf_dir).fx_docs
    n = F.col("doc_id").cast("bigint")
    one = d.select("doc_id", (n * 2).alias("ann_id"), F.col("m_start").cast("int").alias("start_off"), (F.col("m_start") + F.length("m1")).cast("int").alias("end_off"), F.lit("ProteinMutation").alias("etype"))
    two = d.select("doc_id", (n * 2 + 1).alias("ann_id"), (F.col("m_start") + F.length("m1") + 2).cast("int").alias("start_off"), (F.col("m_start") + F.length("m1") + F.length("m2") + 2).cast("int").alias("end_off"), F.lit("DNAMutation").alias("etype"))
    return normalize.link_bracketed(one.unionByName(two), d)


# What each of fx_layouts' texts links: the members (p, d, s) that are linked, ``rs`` where the rs number is given to the others.
LAYOUT_FACTS = """
f as (select * from (values (0, 0, 2), (0, 1, 2), (1, 0, 2), (1, 1, 2), (2, 0, 2), (2, 1, 2), (3, 0, 2), (4, 0, 2), (4, 1, 2), (5, 1, 0), (6, 1, 2), (7, 0, 2), (8, 0, 1),
 (9, 0, 2), (10, 1, 2), (11, 0, 2), (12, 0, 2), (13, 0, 2), (14, 0, 2), (15, 1, 2), (16, 1, 2), (17, 0, 2), (19, 0, 2), (21, 0, 1), (22, 0, 1)) t(k, a, b))
"""


@query(f"with {LAYOUT_FACTS} select doc_id, cast(doc_id as bigint) * 3 + a ann_a, cast(doc_id as bigint) * 3 + b ann_b from fx_layouts join f using (k)")
def link_layouts(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return layouts.layout_links(layouts.find_layouts(x.fx_layout_ann, x.fx_layouts.select("doc_id", "text")))


@query(f"with {LAYOUT_FACTS} select cast(doc_id as bigint) * 3 + a ann_id, cast(doc_id as bigint) + 100000 rs, 'Pattern' source from fx_layouts join f using (k) where b = 2")
def layout_rs(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return layouts.layout_rs(layouts.find_layouts(x.fx_layout_ann, x.fx_layouts.select("doc_id", "text")), x.fx_layout_ann)


@query("""
with l as (select l_orderkey a, l_orderkey + 1 b from lineitem where l_linenumber = 1 group by l_orderkey), f as (select distinct l_orderkey id, 100000 + l_partkey rs from lineitem where l_orderkey % 3 = 0),
 e as (select a, b from l union select b, a from l)
select distinct e.b ann_id, f.rs, 'Extended' source from e join f on f.id = e.a where not exists (select 1 from f x where x.id = e.b)
""")
def extend_to_partner(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    links = x.lineitem.where("l_linenumber = 1").select(F.col("l_orderkey").alias("ann_a"), (F.col("l_orderkey") + 1).alias("ann_b")).distinct()
    found = x.lineitem.where("l_orderkey % 3 = 0").select(F.col("l_orderkey").alias("ann_id"), (F.col("l_partkey") + 100000).alias("rs")).distinct()
    return normalize.extend_to_partner(found, links)


@query("select ann_id, etype, case when etype <> 'Species' then ident end gene from (select ann_id, case when etype = 'Species' then 'Chromosome' else etype end t, etype, ident from fx_ann) x where t <> 'ProteinMutation' or true")
def display_filter(spark, sf_dir):
    a = Inputs(spark, sf_dir).fx_ann.select("ann_id", F.when(F.col("etype") == "Species", "Chromosome").otherwise(F.col("etype")).alias("etype"), F.col("ident").alias("gene"))
    return associate.display_filter(a, refseq=False).withColumn("etype", F.when(F.col("etype") == "Chromosome", "Species").otherwise(F.col("etype")))


@query("select id ann_id, min_by(rs, n) rs, case when id % 4 = 0 then null else concat('g', cast(id % 4 as string)) end gene from fx_rs_rows group by id")
def strip_provenance(spark, sf_dir):
    n = F.col("id") % 4
    gene = F.when(n == 0, "null").otherwise(F.concat(F.lit("g"), n.cast("string"), F.lit(";x")))
    return associate.strip_provenance(_rs_lists(Inputs(spark, sf_dir)).select(F.col("id").alias("ann_id"), "rs", gene.alias("gene")))


# --- reports ---------------------------------------------------------------


@query("""
with v as (select doc_id, m1 mention, case when regexp_full_match(substr(m1, 1, 1) || right(m1, 1), '[ACGT]{2}') then 'DNAMutation' else 'ProteinMutation' end etype from fx_docs
 union all select doc_id, m2, 'DNAMutation' from fx_docs union all select doc_id, m3, 'SNP' from fx_docs)
select mention, etype, case when mention like 'c.%' then mention when etype = 'SNP' then '' when etype = 'DNAMutation' then concat('c.', substr(mention, 2, length(mention) - 2), left(mention, 1), '>', right(mention, 1)) else concat('p.', mention) end hgvs,
 '' gene, count(*) n, count(distinct doc_id) n_docs, array_to_string(list_sort(list(distinct doc_id)), ',') docs from v group by all
""")
def variant_summary_of_documents(spark, sf_dir):
    found = canon.variants_of(Inputs(spark, sf_dir).fx_docs.select("doc_id", "text"))
    return report.variant_summary(found.withColumn("gene", F.lit("")))


@query("""
select mention, etype, concat('p.', mention) hgvs, '' gene, count(*) n, count(distinct doc_id) n_docs, array_to_string(list_sort(list(distinct doc_id)), ',') docs from fx_ann where etype = 'ProteinMutation' group by mention, etype
""")
def variant_summary(spark, sf_dir):
    a = Inputs(spark, sf_dir).fx_ann
    # names are made once for each distinct identifier
    names = a.where("etype = 'ProteinMutation'").select("ident").distinct().withColumn("hgvs", variants.render_hgvs(F.col("ident")))
    return report.variant_summary(a.join(names, "ident", "left").withColumn("gene", F.lit("")))


@query("select mention, ident, count(*) n, count(distinct doc_id) n_docs, array_to_string(list_sort(list(distinct doc_id)), ',') docs from fx_ann where etype = 'Gene' group by mention, ident")
def gene_summary(spark, sf_dir):
    return report.gene_summary(Inputs(spark, sf_dir).fx_ann)


@query("select doc_id, lower(mention) mention, etype, ident, count(*) n from fx_ann where etype = 'Species' group by all")
def organism_summary(spark, sf_dir):
    return report.organism_summary(Inputs(spark, sf_dir).fx_ann, per_document=True)


@query("select mention, etype, n, cast(25 as bigint) shown, total from (select mention, etype, count(*) n, count(*) over () total from fx_ann group by mention, etype) x order by n desc, mention, etype limit 25")
def top_n_by_type(spark, sf_dir):
    n = Inputs(spark, sf_dir).fx_ann.groupBy("mention", "etype").agg(F.count("*").alias("n"))
    return report.top_n(n, 25, "n")


@query("""
with k as (select *, row_number() over (partition by doc_id, start_off, end_off, mention, etype order by ann_id) r from fx_ann)
select doc_id, start_off, end_off, mention, etype, count(*) n from (
 select * from fx_ann where etype <> 'Species' union all select * exclude (r) from k where etype = 'Species' and r = 1) x group by all
""")
def enrich_entities(spark, sf_dir):
    a = Inputs(spark, sf_dir).fx_ann
    more = a.withColumn("ident", F.concat(F.lit("*"), "ident"))
    out = report.enrich_entities(a.where("etype <> 'Species'"), more)
    return out.groupBy(*report.ENTITY_KEYS).agg(F.count("*").alias("n"))


@query("select ann_id, case etype when 'Gene' then 'Gene' when 'Species' then 'Species' else 'Protein Mutation' end label from fx_ann")
def entity_labels(spark, sf_dir):
    return report.entity_labels(Inputs(spark, sf_dir).fx_ann).select("ann_id", "label")


@query("select ann_id, ident hgvs, concat('x:', mention) last, 3 keys from fx_ann")
def parse_details(spark, sf_dir):
    a = Inputs(spark, sf_dir).fx_ann
    details = F.concat(F.lit("HGVS:"), "ident", F.lit(";x;Key:1;Key:x:"), "mention", F.lit(";RS#:5"))
    # a map is made once for each row, whatever is read from it
    m = F.col("m")
    return a.select("ann_id", text.parse_details(details).alias("m")).select("ann_id", m["HGVS"].alias("hgvs"), m["Key"].alias("last"), F.size(m).alias("keys"))


@query("select doc_id, cast(m_start as int) start_off, m1 mention from fx_docs")
def reanchor(spark, sf_dir):
    d = Inputs(spark, sf_dir).fx_docs
    a = d.select("doc_id", (F.col("m_start") - F.col("doc_id").cast("int") % 8).cast("int").alias("start_off"), F.length("m1").alias("n"), F.col("m1").alias("mention"))
    a = a.withColumn("end_off", F.col("start_off") + F.col("n")).select("doc_id", "start_off", "end_off", "mention")
    return report.reanchor(a, d).select("doc_id", "start_off", "mention")


@query("""
select doc_id, 0 seg_no, 'plain' kind, sha256(substr(text, 1, cast(m_start as int))) piece from fx_docs
union all select doc_id, 1, 'ProteinMutation', sha256(m1) from fx_docs
union all select doc_id, 2, 'plain', sha256(substr(text, cast(m_start + length(m1) + 1 as int))) from fx_docs
""")
def text_segments(spark, sf_dir):
    d = Inputs(spark, sf_dir).fx_docs
    one = d.select("doc_id", F.col("m_start").cast("int").alias("start_off"), (F.col("m_start") + F.length("m1")).cast("int").alias("end_off"), F.lit("ProteinMutation").alias("etype"))
    inside = one.select("doc_id", (F.col("start_off") + 1).alias("start_off"), "end_off", F.lit("Gene").alias("etype"))
    return report.text_segments(d, one.unionByName(inside)).withColumn("piece", F.sha2("piece", 256))


@query("""
with s as (select * from fx_stats)
select label, max(seconds) filter (step_name = 'extract' and uid = e) extract, max(seconds) filter (step_name = 'genes' and uid = g) genes, max(seconds) filter (step_name = 'variants' and uid = v) variants
from s join (select label, max(uid) filter (step_name = 'extract') e, max(uid) filter (step_name = 'genes') g, max(uid) filter (step_name = 'variants') v from s group by label) m using (label) group by label
""")
def pipeline_stats_pivot(spark, sf_dir):
    s = Inputs(spark, sf_dir).fx_stats
    # runs of a step are told apart by their number: the last counts
    out = report.pipeline_stats(s.withColumn("step", F.struct("step", "uid")), ["extract", "genes", "variants"])
    return out.select("label", "extract", "genes", "variants")


@query("""
select step_name, label, cast(sum(chars) as bigint) chars, cast(sum(words) as bigint) words from fx_stats group by step_name, label
union all select step_name, 'TOTAL', cast(sum(chars) as bigint), cast(sum(words) as bigint) from fx_stats group by step_name
""")
def step_totals(spark, sf_dir):
    return report.step_totals(Inputs(spark, sf_dir).fx_stats)


@query("select ann_id, coalesce(concat('Sp', cast(cast(ident as int) - 9600 as string)), ident) name from fx_ann where etype = 'Species' and cast(ident as int) < 9603 union all select ann_id, ident from fx_ann where etype = 'Species' and cast(ident as int) >= 9603")
def display_names(spark, sf_dir):
    names = Inputs(spark, sf_dir).nation.where("n_nationkey < 3").select((F.col("n_nationkey") + 9600).cast("string").alias("id"), F.concat(F.lit("Sp"), F.col("n_nationkey").cast("string")).alias("name"))
    a = Inputs(spark, sf_dir).fx_ann.where("etype = 'Species'").select("ann_id", F.col("ident").alias("taxon"))
    return report.display_names(a, "taxon", names).select("ann_id", "name")


# --- sources and sinks -----------------------------------------------------


def _annotations(x: Inputs) -> DataFrame:
    return x.fx_docs.select("doc_id", F.col("m_start").cast("int").alias("start_off"), (F.col("m_start") + F.length("m1")).cast("int").alias("end_off"), F.col("m1").alias("mention"), F.lit("ProteinMutation").alias("etype"), F.concat(F.lit("p|"), "m1").alias("ident"))


def _one_passage(x: Inputs) -> DataFrame:
    d = x.fx_docs.select("doc_id", F.translate("text", "|\r\x0b\x0c\x85  ", "/      ").alias("text"))
    return d.select("doc_id", F.lit(0).alias("passage_no"), F.lit("body").alias("ptype"), "text")


ANNOTATIONS = "select doc_id, cast(m_start as int) start_off, cast(m_start + length(m1) as int) end_off, m1 mention, 'ProteinMutation' etype, concat('p|', m1) ident, cast(length(text) as int) n from fx_docs"


@query(ANNOTATIONS)
def pubtator_roundtrip(spark, sf_dir):
    x, path = Inputs(spark, sf_dir), shared_path(spark)
    pubtator.write_pubtator(_one_passage(x), _annotations(x), path)
    passages, ann = pubtator.read_pubtator(spark, path, pubtator.REPORT_TYPES)
    return ann.join(passages.select("doc_id", F.length("text").alias("n")), "doc_id")


@query(ANNOTATIONS)
def bioc_roundtrip(spark, sf_dir):
    x, path = Inputs(spark, sf_dir), shared_path(spark)
    bioc.write_bioc(_one_passage(x), _annotations(x), path)
    passages, ann = bioc.read_bioc(spark, path)
    return ann.drop("passage_no").join(passages.select("doc_id", F.length("text").alias("n")), "doc_id")


@query("""
with p as (select doc_id, passage_no, cast(coalesce(sum(length(text) + 1) over (partition by doc_id order by passage_no rows between unbounded preceding and 1 preceding), 0) as int) o, length(text) n from fx_passages)
select a.doc_id, a.ann_id, p.passage_no, p.o "offset" from (select ann_id, doc_id, start_off from fx_ann) a join p on p.doc_id = a.doc_id and a.start_off >= o and a.start_off < o + greatest(n, 1)
""")
def pubtator_to_bioc(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    return pubtator.route_annotations(x.fx_passages, x.fx_ann.select("doc_id", "ann_id", "start_off")).select("doc_id", "ann_id", "passage_no", "offset")


@query("""
select file, problem, count(*) n from (
 select concat('f', cast(cast(doc_id as bigint) % 10 as string)) file, 'missing blank' problem, doc_id, row_number() over (partition by cast(doc_id as bigint) % 10 order by cast(doc_id as bigint)) r from fx_docs) x where r > 1 group by all
union all select distinct concat('f', cast(cast(doc_id as bigint) % 10 as string)), 'missing final blank', 1 from fx_docs
""")
def validate_pubtator(spark, sf_dir):
    d = Inputs(spark, sf_dir).fx_docs
    n = F.col("doc_id").cast("bigint")
    lines = d.select(F.concat(F.lit("f"), (n % 10).cast("string")).alias("file"), n.alias("line_no"), F.concat("doc_id", F.lit("|t|"), "m1").alias("line"))
    return pubtator.validate(lines).groupBy("file", "problem").agg(F.count("*").alias("n"))


@query("select form, rs, refseqs from (select form, rs, concat('NM_', cast(rs % 9 as string), '/NP_', cast(rs % 7 as string)) refseqs from fx_var2rs) x")
def load_var2rs(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    item = F.concat(F.col("rs").cast("string"), F.lit("-NM_"), (F.col("rs") % 9).cast("string"), F.lit("/NP_"), (F.col("rs") % 7).cast("string"))
    raw = x.fx_var2rs.groupBy(F.col("form").alias("var")).agg(F.array_join(F.collect_list(item), "|").alias("rs"))
    return knowledge.explode_var2rs(raw, "test").select("form", "rs", F.array_join("refseqs", "/").alias("refseqs"))


# A knowledge base built from lines as they are delivered, stored, and asked.
STORED = f"""
{HITS},
asked as (select distinct rs from h),
st as (select r.rs, case when e.rs is not null then r.rs else coalesce(m.merged, r.rs) end resolved, case when e.rs is not null then 'expired' when m.merged is not null then 'merged' else 'current' end status
 from asked r left join (select distinct rs from fx_expired) e on e.rs = r.rs left join (select origin, min(merged) merged from fx_merged group by origin) m on m.origin = r.rs),
lg as (select rs, min(gene) gene from fx_gene2rs group by rs),
facts as (select s.rs, resolved, status, g.gene, cast(case when s.resolved % 10 < 9 then s.resolved % 23 + 1 end as string) chromosome from st s left join lg g on g.rs = s.resolved)
select ann_id, h.rs, form_rank, resolved, status, gene, case when cast(gene as int) % 4 = 1 then concat('h', gene) when cast(gene as int) % 4 = 3 then concat('o', gene) else gene end human_gene,
 case when cast(gene as int) % 7 > 0 then cast(9600 + cast(gene as int) % 5 as string) end tax, case when gene is null then null else chromosome end chromosome
from h join facts f on f.rs = h.rs
"""


def _stored(x: Inputs, buckets: int = 4) -> store.Store:
    """All tables of a knowledge base, from lines made of the fixtures."""
    spark, lines = x.spark, lambda d, *c: d.select(F.concat_ws("\t", *[F.expr(e).cast("string") for e in c]).alias("value"))
    path = shared_path(spark)
    kb = store.Store(spark, "kb_" + path.rsplit("-", 1)[1], path, buckets)
    forms = x.fx_var2rs.groupBy(F.col("form").alias("var")).agg(F.array_join(F.collect_list(F.concat(F.col("rs").cast("string"), F.lit("-NM_1/NP_2"))), "|").alias("rs"))
    genes = x.fx_gene2rs.select("gene").distinct()
    known = knowledge.explode_gene2rs(x.fx_gene2rs.withColumn("rs", F.col("rs").cast("string")))
    kb.write("var2rs", knowledge.explode_var2rs(forms, "test"))
    kb.write("gene2rs", known)
    kb.write("rs2gene", knowledge.rs2gene(known))
    kb.write("merged", store.merged_rows(lines(x.fx_merged, "concat('rs', origin)", "merged")))
    kb.write("expired", store.expired_rows(lines(x.fx_expired, "rs")))
    kb.write("chromosome", store.chromosome_rows(lines(x.fx_gene2rs, "rs", "case when rs % 10 < 9 then rs % 23 + 1 end")))
    kb.write("taxon", store.taxon_rows(lines(genes.where("cast(gene as int) % 7 > 0"), "9600 + cast(gene as int) % 5", "gene")))
    kb.write("ortholog", store.ortholog_rows(lines(genes.where("cast(gene as int) % 2 = 1"), "'9606'", "concat('o', gene)", "'Ortholog'", "'10090'", "gene")))
    kb.write("homolog", store.homolog_rows(lines(genes, "gene", "concat('g', gene)"), lines(genes, "concat('g', gene)", "case when cast(gene as int) % 4 = 1 then concat('h', gene) else gene end")))
    return kb


@query(f"with {STORED}")
def stored_knowledge(spark, sf_dir):
    x = Inputs(spark, sf_dir)
    kb = _stored(x)
    return normalize.describe_stored(_variants(x), kb).select("ann_id", "rs", "form_rank", "resolved", "status", "gene", "human_gene", "tax", "chromosome")


@query("select distinct rs, gene from fx_gene2rs")
def load_gene2rs(spark, sf_dir):
    raw = Inputs(spark, sf_dir).fx_gene2rs.groupBy("gene").agg(F.array_join(F.collect_list(F.col("rs").cast("string")), "|").alias("rs"))
    return knowledge.rs2gene(knowledge.explode_gene2rs(raw))


@query("select seqid, gene, length(seq) n from fx_refseq where cast(gene as int) % 2 = 1")
def new_sequences(spark, sf_dir):
    r = Inputs(spark, sf_dir).fx_refseq
    odd = F.col("gene").cast("int") % 2 == 1
    return knowledge.new_sequences(r.where(~odd), r.select("seqid", "level", "seq"), r.select("seqid", "gene")).select("seqid", "gene", F.length("seq").cast("bigint").alias("n"))


@query("""
select name, ident, etype from (select distinct concat(p_name, k) name, cast(p_partkey as string) ident, 'Gene' etype from part, (select '' k union all select ' x' k) ks) y
where length(regexp_replace(name, '[^A-Za-z]', '', 'g')) >= 3 and lower(name) not in (select distinct lower(p_name) from part where p_partkey % 9 = 0)
""")
def build_lexicon(spark, sf_dir):
    part = Inputs(spark, sf_dir).part
    rows = part.select(F.lit("Gene").alias("etype"), F.col("p_partkey").cast("string").alias("ident"), F.concat("p_name", F.lit("|"), "p_name", F.lit(" x")).alias("names"))
    return knowledge.build_lexicon(rows, part.where("p_partkey % 9 = 0").select(F.col("p_name").alias("name")))


# Rows of identifiers of each kind, of rs numbers, and lines that are no rows.
HGVS_LINES = """
select n, k, pmid, pmcid, mention, w, p, u, case k when 0 then concat('p|SUB|', w, '|', p, '|', u) when 1 then concat('rs', p) when 2 then concat('c|SUB|', w, '|', p, '|', u, ',A') when 3 then concat('g|INS|', p, '|', u)
  when 4 then concat('p|DEL|', p, '|', u) when 5 then concat('p|FS|', w, '|', p, '|', u, '|3') when 6 then concat('c|FS|', w, '|', p, '|', u) when 7 then concat('|FS|', w) when 8 then concat('c|DUP|', p, '||')
  when 9 then concat('|SUB|', w, '|', p, '|', u) when 10 then concat('|INDEL|', p, '_', p, '|', u) when 11 then concat('|Allele|', w, '|', p) else '' end norm
from (select ann_id n, ann_id % 13 k, doc_id pmid, concat('PMC', cast(ann_id as string)) pmcid, mention, w, p, u from fx_ann where etype = 'ProteinMutation') x
"""


@query(f"""
with l as ({HGVS_LINES})
select case when k = 12 then concat('a line of ', mention) else concat(pmid, chr(9), pmcid, chr(9), case k when 0 then concat('p.', w, p, u) when 1 then concat('rs', p) when 2 then concat('c.', p, w, '>', u)
 when 3 then concat('g.', p, 'ins', u) when 4 then concat('p.', p, 'del', u) when 5 then concat('p.', w, p, u, 'fsX3') when 6 then concat('c.', w, p, u, 'fsX') when 7 then concat(mention, '|', p) when 8 then concat('c.', p, 'dup')
 when 9 then concat('c.', p, w, '>', u) when 10 then concat('c.', p, '_', p, 'delins', u) else '' end, chr(9), mention, '|', p) end "value" from l
""")
def convert_hgvs_rows(spark, sf_dir):
    x, path = Inputs(spark, sf_dir), shared_path(spark)
    rows = spark.sql(HGVS_LINES.replace("fx_ann", "{fx_ann}"), fx_ann=x.fx_ann)
    tab = F.lit("\t")
    line = F.concat("pmid", tab, "pmcid", tab, "norm", tab, "mention", F.lit(",B|"), "p", F.lit(",C"), tab, F.lit("more"))
    rows.select(F.when(F.col("k") == 12, F.concat(F.lit("a line of "), "mention")).otherwise(line).alias("value")).write.text(f"{path}/in")
    knowledge.convert_hgvs_rows(spark, f"{path}/in", f"{path}/out")
    return spark.read.text(f"{path}/out")


# Word lists as files, made of the parts' table.
@query("""
with a as (select p_partkey k, p_name, p_size, p_type from part)
select distinct 'stop' list, p_name a, '' b, '' c from a
union all select 'pairs', x, y, '' from (select substr('ACDEFGHIKL', cast(k % 10 + 1 as int), 1) x, substr('MNPQRSTVWY', cast(p_size % 10 + 1 as int), 1) y from a) z group by x, y
union all select 'pairs', y, x, '' from (select substr('ACDEFGHIKL', cast(k % 10 + 1 as int), 1) x, substr('MNPQRSTVWY', cast(p_size % 10 + 1 as int), 1) y from a) z group by x, y
union all select distinct 'codon', substr('ACDEFGHIKL', cast(k % 10 + 1 as int), 1), 'Y', concat(substr('ACGT', cast(k % 4 + 1 as int), 1), 'T') from a
union all select distinct 'types', concat('WORD', cast(p_size as string)), 'DEL', '' from a
union all select 'fused', concat('gene', cast(k as string), cast(p_size as string), 'x'), 'DNAMutation', concat('c|SUB|C|', cast(p_size as string), '|T') from a
""")
def load_lexicons(spark, sf_dir):
    x, path = Inputs(spark, sf_dir), shared_path(spark)
    part = x.part.select(F.col("p_partkey").alias("k"), "p_name", F.col("p_size").cast("string").alias("size"))
    one, other = F.expr("substr('ACDEFGHIKL', cast(k % 10 + 1 as int), 1)"), F.expr("substr('MNPQRSTVWY', cast(size % 10 + 1 as int), 1)")

    def put(name, *values):
        part.select(F.explode(F.array(*[F.concat(*v) for v in values])).alias("value")).write.text(f"{path}/{name}")
        return f"{path}/{name}"

    node, tab = F.col("k").cast("string"), F.lit("\t")
    files = [
        put("stop", [F.col("p_name")], [F.lit("")]),
        put("pairs", [one, F.lit(" "), other, F.lit("  -7")], [F.lit("lone")]),
        put("codon", [F.lit("aa_w\taa_m\tnu_w\tnu_m")], [one, F.lit("\tY\t"), F.expr("substr('ACGT', cast(k % 4 + 1 as int), 1)"), F.lit("\tT")]),
        put("types", [F.lit("word"), F.col("size"), F.lit("\tDEL\tM")]),
        put("fused", [node, tab, F.lit("gene"), node], [node, F.lit("-1\t"), F.col("size")], [node, F.lit("-1-1\tx\tDNAMutation\tc|SUB|C|"), F.col("size"), F.lit("|T")]),
    ]
    lists, none = knowledge.load_lexicons(spark, *files), F.lit("")
    shown = {"stop": ["mention", none, none], "pairs": ["a", "b", none], "codon": ["aa_w", "aa_m", F.concat("nu_w", "nu_m")], "types": ["word", "vtype", none], "fused": ["key", "etype", "ident"]}
    frames = [lists[n].select(F.lit(n).alias("list"), *[(F.col(c) if isinstance(c, str) else c).alias(a) for a, c in zip("abc", cs, strict=True)]) for n, cs in shown.items()]
    return functools.reduce(DataFrame.unionByName, frames)


@query("select n_nationkey nation, octet_length(encode(n_name)) + 1 size from nation")
def file_inventory(spark, sf_dir):
    x, path = Inputs(spark, sf_dir), shared_path(spark)
    x.nation.select(F.col("n_nationkey").alias("nation"), "n_name").repartition("nation").write.partitionBy("nation").text(path)
    found = knowledge.file_inventory(spark, path, "*.txt")
    return found.select(F.regexp_extract("path", "nation=([0-9]+)", 1).cast("bigint").alias("nation"), F.col("size").cast("bigint").alias("size"))


@query("""
select 'gene' kind, cast(p_partkey as string) id, p_name "name" from part where p_partkey % 7 > 1
union all select 'taxon', cast(s_suppkey as string), s_name from supplier
""")
def read_names(spark, sf_dir):
    x, path = Inputs(spark, sf_dir), shared_path(spark)
    shown = F.when(F.col("p_partkey") % 7 == 0, "NEWENTRY").when(F.col("p_partkey") % 7 == 1, "-").otherwise(F.col("p_name"))
    x.part.select(F.explode(F.array(F.lit("#tax\tid\tsymbol"), F.concat_ws("\t", F.lit("9606"), F.col("p_partkey").cast("string"), shown, F.lit("more")))).alias("value")).write.option("compression", "gzip").text(f"{path}/genes")
    x.supplier.select(F.concat_ws("\t", F.col("s_suppkey").cast("string"), "s_name").alias("value")).write.text(f"{path}/taxa")
    genes, taxa = knowledge.read_gene_info(spark, f"{path}/genes"), knowledge.read_taxon_names(spark, f"{path}/taxa")
    return genes.select(F.lit("gene").alias("kind"), "id", "name").unionByName(taxa.select(F.lit("taxon").alias("kind"), "id", "name"))


# Articles as XML: a title, two paragraphs that are the text, a figure whose caption repeats its head or not, a table.
@query("""
with d as (select cast(doc_id as string) id, doc_id % 2 k, trim(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', ' ', 'g')) t from documents),
p as (select id, 'title' ptype, concat('Article ', id) text from d union all select id, 'body', concat('Begin ', t, ' end Next ', id) from d
 union all select id, 'fig_caption', case when k = 0 then 'Fig shows' else 'Fig A plot' end from d union all select id, 'table', concat('a b c ', id) from d)
select ptype, text, count(*) n from p group by ptype, text
""")
def tei_to_passages(spark, sf_dir):
    x, path = Inputs(spark, sf_dir), shared_path(spark)
    clean = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]+", " "))
    d = x.documents.select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("doc_id") % 2 == 0, "Fig shows").otherwise("A plot").alias("caption"), clean.alias("t"))
    xml = "<TEI><teiHeader><fileDesc><titleStmt><title>Article %s</title></titleStmt></fileDesc></teiHeader><text><body><div><head>H</head><p>Begin %s end</p><p>Next %s</p></div><figure><head>Fig</head><figDesc>%s</figDesc><table><row><cell>a</cell><cell>b</cell></row><row><cell>c</cell><cell>%s</cell></row></table></figure></body></text></TEI>"
    articles = d.select(F.from_xml(F.format_string(xml, "id", "t", "id", "caption", "id"), bioc.TEI_SCHEMA, {"rowTag": "TEI"}).alias("x")).select("x.*")
    articles.write.format("xml").option("rootTag", "teiCorpus").option("rowTag", "TEI").save(path)
    return bioc.tei_to_passages(spark, path).groupBy("ptype", "text").agg(F.count("*").alias("n"))


@query("select label, step_name, cast(chars as string) chars, '' runtime from fx_stats")
def step_stats_roundtrip(spark, sf_dir):
    path = shared_path(spark)
    s = Inputs(spark, sf_dir).fx_stats.select(F.col("step").cast("string").alias("step"), "step_name", "label", F.col("chars").cast("string").alias("chars"), F.col("words").cast("string").alias("words"), F.lit("").alias("runtime"), F.lit("").alias("input_name"), F.lit("").alias("output_file"))
    knowledge.append_step_stats(s, path)
    return knowledge.read_step_stats(spark, path).select("label", "step_name", "chars", "runtime")


@query("select cast(doc_id as string) name from documents where doc_id % 3 <> 0 and doc_id % 100 between 0 and 99")
def ingest_new(spark, sf_dir):
    d = Inputs(spark, sf_dir).documents.select(F.col("doc_id").cast("string").alias("name"))
    return ingest.new_inputs(d, d.where(F.col("name").cast("bigint") % 3 == 0))


@query(INSERTED)
def ingest_new_stream(spark, sf_dir):
    """Files of documents through the stream, tagged as in a batch."""
    x, root = Inputs(spark, sf_dir), shared_path(spark)
    docs = x.fx_docs.select("doc_id", "text")
    docs.write.parquet(f"{root}/in")
    ingest.stream_documents(spark, f"{root}/in", docs.schema.simpleString()[7:-1].replace(":", " "), spans.tag_hgvs, f"{root}/out", f"{root}/log").awaitTermination()
    return spark.read.option("basePath", f"{root}/out").parquet(f"{root}/out").drop("batch")
