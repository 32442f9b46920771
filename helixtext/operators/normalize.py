"""Variants to rs numbers, genes, species and registry ids, by joins to the knowledge base.

ann: ann_id, doc_id, start_off, end_off, mention, etype, ident. Strategies
return ann_id, rs, source, rank; ``cascade`` keeps the first that succeeds.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtext.functions import variants
from helixtext.functions.shared import checkpointed
from helixtext.sources.store import Store

#: Provenance in order of trust.
SOURCES = ("Pattern", "Recognized", "Foundbefore", "Mapping", "SNPinText", "RefSeq", "GeneNormalized", "Extended")


def resolve_rs_status(rs: DataFrame, merged: DataFrame, expired: DataFrame) -> DataFrame:
    """rs, resolved, status (E1). Each rs on its own: expired stays and is marked, merged is replaced."""
    m = merged.groupBy(F.col("origin").alias("rs")).agg(F.min("merged").alias("to"))
    e = expired.select("rs").distinct().withColumn("gone", F.lit(True))
    status = F.when(F.col("gone"), "expired").when(F.col("to").isNotNull(), "merged").otherwise("current")
    return rs.join(e, "rs", "left").join(m, "rs", "left").select(*rs.columns, F.when(F.col("gone"), F.col("rs")).otherwise(F.coalesce("to", "rs")).alias("resolved"), status.alias("status"))


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """rows in all partitions of the session, by keys.

    For rows whose lists are unfolded next: by their own bytes they would be put
    together in a few, but the work is that of the rows that they make. Nor are they sent whole to
    the few tasks of their lists, which a planner does that takes them for small.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).hint("merge")


def values_of(c: str) -> Column:
    """The distinct values of a group as a list; a null, which collect_set leaves out, is a value as any other."""
    found = F.collect_set(c)
    return F.when(F.count("*") > F.count(c), F.array_append(found, F.lit(None))).otherwise(found)


def spread(keyed: DataFrame, lists: DataFrame, keys: list[str], value: str = "rs") -> DataFrame:
    """ann_id, what lists have beside keys, and value: the rows of each annotation's lists, each once.

    keyed: ann_id and keys; lists: keys, found (array without repeats of plain values) and more.
    Lists are unfolded behind the last join, so what is shuffled grows with annotations
    and lists, not with the rows that they make. Only annotations of several
    keys, whose lists may share rows, go through a distinct.
    """
    counted = keyed.withColumn("n", F.count("*").over(Window.partitionBy("ann_id")))
    more = [c for c in lists.columns if c not in (*keys, "found")]

    def unfolded(rows: DataFrame) -> DataFrame:
        return dealt(rows.drop("n"), *keys).join(lists, keys).select("ann_id", *more, F.explode("found").alias(value))

    return unfolded(counted.where("n = 1")).unionByName(unfolded(counted.where("n > 1")).distinct())


def met_where(ann: DataFrame, reached: DataFrame, condition: list[str], values: list[str], holds: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(met: doc_id, name, met; lists: name, met, all values but the last, found): the conditions that a document meets of a name, and what the name reaches under them.

    ann: ann_id, doc_id, name; reached: name, condition, values; holds: takes
    doc_id, name, condition and keeps the rows that hold. Conditions are tried for distinct
    (document, name). found has the last of the values, so that unfolding a list copies plain numbers.
    """
    pairs = ann.select("doc_id", "name").distinct()
    met = holds(pairs.join(reached.select("name", *condition).distinct(), "name")).groupBy("doc_id", "name").agg(F.sort_array(F.collect_set(F.struct(*condition))).alias("met"))
    some = met.select("name", "met").distinct().select("name", "met", F.inline("met")).join(reached, ["name", *condition])
    return met, some.groupBy("name", "met", *values[:-1]).agg(values_of(values[-1]).alias("found"))


def spread_where(ann: DataFrame, reached: DataFrame, condition: list[str], values: list[str], holds: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """ann_id and values that its name reaches under a condition that its document meets, each once; arguments as ``met_where`` has them."""
    met, lists = met_where(ann, reached, condition, values, holds)
    return spread(ann.select("ann_id", "doc_id", "name").join(met, ["doc_id", "name"]).select("ann_id", "name", "met"), lists, ["name", "met"], values[-1])


#: rs numbers not yet unfolded: pairs of keyed (ann_id, a, b) and lists (a, b, found: array<bigint>, not empty). Each
#: list is held once, whatever the number of annotations that have it; an annotation of several keys has all their rs.
Listed = list[tuple[DataFrame, DataFrame]]


def rs_lists(found: str = "found") -> Column:
    return F.col(found).cast("array<bigint>").alias("found")


def as_lists(rows: DataFrame) -> Listed:
    """Rows ann_id, rs as a list for each annotation."""
    known = rows.where("rs is not null")
    key = [F.col("ann_id").cast("string").alias("a"), F.lit("").alias("b")]
    lists = known.groupBy("ann_id").agg(F.collect_set(F.col("rs").cast("bigint")).alias("found")).select(*key, "found")
    return [(known.select("ann_id").distinct().select("ann_id", *key), lists)]


def lists_where(ann: DataFrame, reached: DataFrame, condition: list[str], holds: Callable[[DataFrame], DataFrame]) -> Listed:
    """The rs numbers of ``spread_where`` as lists. They are numbered, so that an annotation carries a number and not its conditions."""
    met, lists = met_where(ann, reached.where("rs is not null"), condition, ["rs"], holds)
    lists = checkpointed(lists.select("name", "met", rs_lists(), F.monotonically_increasing_id().cast("string").alias("a"), F.lit("").alias("b")))
    pairs = met.join(lists.select("name", "met", "a", "b"), ["name", "met"]).select("doc_id", "name", "a", "b")
    return [(ann.select("ann_id", "doc_id", "name").join(pairs, ["doc_id", "name"]).select("ann_id", "a", "b"), lists.select("a", "b", "found"))]


def _history(ann: DataFrame, genes: DataFrame, history: DataFrame) -> tuple:
    g = genes.select("doc_id", "gene").distinct()
    known = history.select(F.col("form").alias("name"), "gene", "rs")
    return ann.withColumn("name", F.col("ident")), known, ["gene"], lambda asked: asked.join(g, ["doc_id", "gene"], "left_semi")


def match_history(ann: DataFrame, genes: DataFrame, history: DataFrame) -> DataFrame:
    """(form, gene of the document) seen before (E2). genes: doc_id, gene; history: form, gene, rs."""
    a, known, condition, holds = _history(ann, genes, history)
    return spread_where(a, known, condition, ["rs"], holds).withColumn("source", F.lit("Mapping"))


def history_lists(ann: DataFrame, genes: DataFrame, history: DataFrame) -> Listed:
    """What ``match_history`` finds, as lists."""
    return lists_where(*_history(ann, genes, history))


def candidate_forms(ann: DataFrame, kinds: tuple[str, ...] = ("direct", "reversed", "genomic", "protein")) -> DataFrame:
    """ann_id, doc_id, kind, form_rank, key: forms are made once for each distinct identifier."""
    forms = ann.select("ident").distinct().select("ident", F.explode(variants.lookup_forms(F.col("ident"))).alias("f")).select("ident", F.col("f.kind").alias("kind"), F.col("f.rank").alias("form_rank"), F.col("f.key").alias("key"))
    return ann.select("ann_id", "doc_id", "ident").join(forms.where(F.col("kind").isin(*kinds)), "ident")


def forms_asked(ann: DataFrame) -> DataFrame:
    """ident, kind, form_rank, form: all forms of each distinct identifier but those beside it."""
    forms = ann.select("ident").distinct().select("ident", F.explode(variants.lookup_forms(F.col("ident"))).alias("f"))
    return forms.select("ident", F.col("f.kind").alias("kind"), F.col("f.rank").alias("form_rank"), F.col("f.key").alias("form")).where("kind <> 'beside'")


def best_forms(ann: DataFrame, met: DataFrame) -> DataFrame:
    """ann_id, doc_id, rs and the best kind of form that led to it. met: ident, kind, form_rank, rs.

    The rs of an identifier are a list for each kind, unfolded behind the last join: it meets
    annotations and lists, and only the result has a row for each annotation and rs.
    """
    # collect_list leaves a null out, which is a row as any other
    found = F.collect_list("rs")
    found = F.when(F.count("*") > F.count("rs"), F.array_append(found, F.lit(None))).otherwise(found)
    lists = best_kinds(met).groupBy("ident", "kind", "form_rank").agg(found.alias("found"))
    return dealt(ann.select("ann_id", "doc_id", "ident"), "ident").join(lists, "ident").select("ann_id", "doc_id", F.explode("found").alias("rs"), "kind", "form_rank")


def best_kinds(met: DataFrame) -> DataFrame:
    return met.groupBy("ident", "rs").agg(F.min("form_rank").alias("form_rank"), F.min_by("kind", "form_rank").alias("kind"))


def match_var2rs(ann: DataFrame, var2rs: DataFrame, protein_change: DataFrame | None = None) -> DataFrame:
    """Dictionary hits of all forms with the kind of form they came by (E3). var2rs and protein_change: form, rs.

    Distinct identifiers meet the knowledge base, then annotations are joined back.
    """
    return best_forms(ann, met_forms(ann, var2rs, protein_change))


def reached_rs(ann: DataFrame, var2rs: DataFrame, protein_change: DataFrame | None = None) -> DataFrame:
    """ident, rs, form_rank, kind: the hits of ``match_var2rs`` by identifier, not yet joined back to annotations."""
    return best_kinds(met_forms(ann, var2rs, protein_change))


def met_forms(ann: DataFrame, var2rs: DataFrame, protein_change: DataFrame | None = None) -> DataFrame:
    """ident, kind, form_rank, form, rs: the forms of each identifier that the dictionary has.

    With a dictionary of protein changes its direct and reversed hits rank 3 and 4,
    before the protein form of a coding change, which then is 5.
    """
    forms = forms_asked(ann)
    met = forms.join(var2rs.select("form", "rs"), "form")
    if protein_change is not None:
        changes = forms.where(F.col("kind").isin("direct", "reversed")).join(protein_change.select("form", "rs"), "form")
        changes = changes.withColumns({"kind": F.when(F.col("kind") == "direct", "protein change").otherwise("reversed protein change"), "form_rank": F.col("form_rank") + 3})
        met = met.withColumn("form_rank", F.when(F.col("kind") == "protein", 5).otherwise(F.col("form_rank"))).unionByName(changes)
    return met


def match_stored(ann: DataFrame, store: Store) -> DataFrame:
    """``match_var2rs`` on a stored dictionary: only asked forms move, only the parts they can be in are read."""
    return best_forms(ann, store.forms(checkpointed(forms_asked(ann))))


def describe_stored(ann: DataFrame, store: Store) -> DataFrame:
    """ann_id, rs, form_rank and what ``describe_rs`` knows of the rs: ``match_stored`` with facts.

    Facts are put beside the rs numbers of identifiers, so no row of an annotation and an rs is shuffled: an
    identifier has a list of rs numbers for each set of facts that they share, unfolded behind the last join.
    """
    reached = checkpointed(best_kinds(store.forms(checkpointed(forms_asked(ann)))).select("ident", "rs", "form_rank"))
    facts = reached.join(describe_rs(reached, store), "rs")
    shared, own = ["form_rank", "status", "gene", "human_gene", "tax"], ["rs", "resolved", "chromosome"]
    lists = facts.groupBy("ident", *shared).agg(F.collect_list(F.struct(*own)).alias("found"))
    rows = dealt(ann.select("ann_id", "ident"), "ident").join(lists, "ident").select("ann_id", *shared, F.inline("found"))
    return rows.select("ann_id", *[c for c in facts.columns if c != "ident"])


def describe_rs(rs: DataFrame, store: Store) -> DataFrame:
    """rs, resolved, status, gene, human_gene, tax, chromosome of each distinct rs, from the stored tables.

    Gene and chromosome are those of the resolved rs, the species is that of its own gene, not of
    the human one. Null where nothing is known; of several the least counts. A null rs is left out.
    """
    status = resolve_rs_status(rs.select("rs").where("rs is not null").distinct(), store.read("merged").withColumnRenamed("rs", "origin"), store.read("expired"))
    of = {t: store.read(t).groupBy("rs").agg(F.min(c).alias(c)).withColumnRenamed("rs", "resolved") for t, c in (("rs2gene", "gene"), ("chromosome", "chromosome"))}
    facts = status.join(of["rs2gene"], "resolved", "left").join(of["chromosome"], "resolved", "left")
    # genes once each, so that one with many rs is not sent to one bucket with all of them
    genes = facts.select("gene").where("gene is not null").distinct()
    human = to_human_gene(genes, store.read("homolog"), store.read("ortholog")).select(F.coalesce("original_gene", "gene").alias("gene"), F.col("gene").alias("human_gene"))
    tax = store.read("taxon").groupBy("gene").agg(F.min("tax").alias("tax"))
    return facts.join(human.join(tax, "gene", "left"), "gene", "left").select("rs", "resolved", "status", "gene", "human_gene", "tax", "chromosome")


def match_rs_in_text(ann: DataFrame, reached: DataFrame, snps: DataFrame) -> DataFrame:
    """Candidate rs that the document also writes (E4). reached: ident, rs (``reached_rs``); snps: doc_id, rs."""
    return spread(ann.select("ann_id", "doc_id", "ident"), _in_text(reached, snps), ["doc_id", "ident"]).withColumn("source", F.lit("SNPinText"))


def _in_text(reached: DataFrame, snps: DataFrame) -> DataFrame:
    return snps.select("doc_id", "rs").distinct().join(reached.select("ident", "rs"), "rs").groupBy("doc_id", "ident").agg(F.collect_set("rs").alias("found"))


def in_text_lists(ann: DataFrame, reached: DataFrame, snps: DataFrame) -> Listed:
    """What ``match_rs_in_text`` finds, as lists."""
    lists = checkpointed(_in_text(reached, snps).select(F.col("ident").alias("a"), F.col("doc_id").cast("string").alias("b"), rs_lists()))
    keyed = ann.select("ann_id", F.col("ident").alias("a"), F.col("doc_id").cast("string").alias("b")).join(lists.select("a", "b"), ["a", "b"], "left_semi")
    return [(keyed.select("ann_id", "a", "b"), lists)]


def _refseq(ann: DataFrame, reached: DataFrame, rs_refseqs: DataFrame, mentioned: DataFrame) -> tuple:
    m = mentioned.select("doc_id", "refseq").distinct()
    known = reached.select(F.col("ident").alias("name"), "rs").join(rs_refseqs.select("rs", "refseq").distinct(), "rs")
    return ann.withColumn("name", F.col("ident")), known, ["refseq"], lambda asked: asked.join(m, ["doc_id", "refseq"], "left_semi")


def match_refseq(ann: DataFrame, reached: DataFrame, rs_refseqs: DataFrame, mentioned: DataFrame) -> DataFrame:
    """Candidate rs with a RefSeq of the document (E5). reached: ident, rs; rs_refseqs: rs, refseq; mentioned: doc_id, refseq."""
    a, known, condition, holds = _refseq(ann, reached, rs_refseqs, mentioned)
    return spread_where(a, known, condition, ["rs"], holds).withColumn("source", F.lit("RefSeq"))


def refseq_lists(ann: DataFrame, reached: DataFrame, rs_refseqs: DataFrame, mentioned: DataFrame) -> Listed:
    """What ``match_refseq`` finds, as lists."""
    return lists_where(*_refseq(ann, reached, rs_refseqs, mentioned))


def match_var2gene(ann: DataFrame, var2gene: DataFrame, tokens: DataFrame) -> DataFrame:
    """Best-known gene of a form or mention, if the document names it (and the species, where listed).

    var2gene: key, gene, rs, gene_tokens, species_tokens; tokens: doc_id, token.
    An empty list asks for nothing.
    """
    # the name of an annotation is both of its keys
    a = ann.withColumn("name", F.array_distinct(F.array("ident", F.lower("mention"))))
    known = a.select("name").distinct().select("name", F.explode("name").alias("key")).join(var2gene, "key")
    words = tokens.select("doc_id", F.lower("token").alias("token")).distinct()

    def met(rows: DataFrame, column: str) -> DataFrame:
        lists = rows.select("doc_id", column).where(F.size(column) > 0).distinct()
        named = lists.withColumn("token", F.explode(column)).withColumn("token", F.lower("token")).join(words, ["doc_id", "token"], "left_semi").select("doc_id", column).distinct()
        return rows.where(F.size(column) > 0).join(named, ["doc_id", column], "left_semi").unionByName(rows.where(F.size(column) == 0))

    rows = spread_where(a, known, ["gene_tokens", "species_tokens"], ["gene", "rs"], lambda asked: met(met(asked, "gene_tokens"), "species_tokens"))
    return rows.withColumn("source", F.lit("Mapping"))


def gene_distance(gs: Column, ge: Column, vs: Column, ve: Column, g_sentence: Column, v_sentence: Column) -> Column:
    """0 on overlap, else the gap; 1000 more in another sentence."""
    gap = F.greatest(gs - ve, vs - ge, F.lit(0))
    return gap + F.when(g_sentence != v_sentence, 1000).otherwise(0)


def match_by_gene(ann: DataFrame, genes: DataFrame, reached: DataFrame, gene2rs: DataFrame) -> DataFrame:
    """The nearest gene of the document whose rs numbers meet the candidates.

    ann and genes (doc_id, start_off, end_off, gene, sentence) carry a sentence; reached: ident, rs, form_rank
    (``reached_rs``). Candidates meet the (gene, rs) pairs by identifier; only the genes they lead to are looked
    for in the document, so neither a gene with very many rs nor a document with very
    many genes is spread over all mentions. Of the nearest gene the first kind of
    form wins. Its rs numbers are a list of (identifier, gene) that is unfolded last.
    """
    near, lists, best = _by_gene(ann, genes, reached, gene2rs)
    rows = dealt(near, "ident", "gene").join(lists, ["ident", "gene"]).select("ann_id", "gene", F.explode("found").alias("rs"), "distance")
    return rows.unionByName(best).withColumn("source", F.lit("GeneNormalized"))


def by_gene_lists(ann: DataFrame, genes: DataFrame, reached: DataFrame, gene2rs: DataFrame) -> Listed:
    """What ``match_by_gene`` finds, as lists."""
    near, lists, best = _by_gene(ann, genes, reached, gene2rs)
    key = [F.col("ident").alias("a"), F.col("gene").cast("string").alias("b")]
    return [(near.select("ann_id", *key), lists.select(*key, F.col("found").cast("array<bigint>").alias("found"))), *as_lists(best.select("ann_id", "rs"))]


def _by_gene(ann: DataFrame, genes: DataFrame, reached: DataFrame, gene2rs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ann_id, ident, distance, gene: nearest gene; lists of rs of identifier and gene; rows of ids that stand for several annotations)."""
    possible = reached.select("ident", "rs", "form_rank").join(gene2rs.select("gene", "rs").distinct(), "rs")
    g = genes.select("doc_id", F.col("start_off").alias("gs"), F.col("end_off").alias("ge"), "gene", F.col("sentence").alias("g_sentence")).distinct()
    distance = gene_distance(F.col("gs"), F.col("ge"), F.col("start_off"), F.col("end_off"), F.col("g_sentence"), F.col("sentence"))
    a = ann.select("ann_id", "doc_id", "ident", "start_off", "end_off", "sentence").withColumn("n", F.count("*").over(Window.partitionBy("ann_id")))
    once, again = a.where("n = 1").drop("n"), a.where("n > 1").drop("n")
    near = once.join(possible.select("ident", "gene").distinct(), "ident").join(g, ["doc_id", "gene"]).groupBy("ann_id").agg(F.min(F.struct(distance.alias("distance"), "gene", "ident")).alias("b")).select("ann_id", "b.*")
    first = possible.groupBy("ident", "gene").agg(F.min("form_rank").alias("form_rank"))
    lists = possible.join(first, ["ident", "gene", "form_rank"]).groupBy("ident", "gene").agg(F.collect_set("rs").alias("found"))
    # the rows of an id that stands for several annotations share all candidates and places
    wide = again.select("ann_id", "ident").distinct().join(possible, "ident").select("ann_id", "gene", "rs", "form_rank").distinct()
    places = again.join(wide.select("ann_id", "gene").distinct(), "ann_id").join(g, ["doc_id", "gene"]).groupBy("ann_id", "gene").agg(F.min(distance).alias("distance"))
    w = Window.partitionBy("ann_id").orderBy("distance", "gene")
    best = places.join(wide, ["ann_id", "gene"]).withColumn("g", F.dense_rank().over(w)).where("g = 1")
    w = Window.partitionBy("ann_id").orderBy("form_rank")
    best = best.withColumn("k", F.dense_rank().over(w)).where("k = 1").select("ann_id", "gene", "rs", "distance").distinct()
    return near, lists, best


def link_bracketed(ann: DataFrame, docs: DataFrame) -> DataFrame:
    """Neighbouring mentions written together: ``c.169G>C (p.Gly57Arg, rs1)`` (E8). ann_a, ann_b.

    Told by the text between neighbours (blanks, brackets, one mark); ``and`` and
    ``or`` don't link.
    """
    w = Window.partitionBy("doc_id").orderBy("start_off", "end_off", "ann_id")
    v = ann.where(F.col("etype").isin("DNAMutation", "ProteinMutation", "SNP"))
    nxt = v.select("doc_id", "ann_id", "end_off", "etype", F.lead("ann_id").over(w).alias("b"), F.lead("start_off").over(w).alias("b_start"), F.lead("etype").over(w).alias("b_type"))
    near = nxt.where((F.col("b_start") - F.col("end_off")).between(0, 8) & (F.col("etype") != F.col("b_type")))
    between = F.substring("text", F.col("end_off") + 1, F.col("b_start") - F.col("end_off"))
    return near.join(docs.select("doc_id", "text"), "doc_id").where(between.rlike(r"^ *[\[(]? *$|^ *[)\]]? *[,;:/=-] *[\[(]? *$|^ *[)\]] *[\[(]? *$")).select("doc_id", F.col("ann_id").alias("ann_a"), F.col("b").alias("ann_b"))


def extend_to_partner(found: DataFrame, links: DataFrame) -> DataFrame:
    """The rs of one linked mention for a partner that has none (E9). found: ann_id, rs; links: ann_a, ann_b."""
    both = links.select("ann_a", "ann_b").unionByName(links.select(F.col("ann_b").alias("ann_a"), F.col("ann_a").alias("ann_b")))
    has = found.select("ann_id").distinct()
    given = both.join(found.select(F.col("ann_id").alias("ann_a"), "rs"), "ann_a").select(F.col("ann_b").alias("ann_id"), "rs").distinct()
    return given.join(has, "ann_id", "left_anti").withColumn("source", F.lit("Extended"))


def cascade(*found: DataFrame) -> DataFrame:
    """ann_id, source, rs (sorted list): of each annotation the most trusted source that found any."""
    rank = F.array_position(F.array(*[F.lit(s) for s in SOURCES]), F.col("source"))
    every = None
    for f in found:
        one = f.select("ann_id", F.col("rs").cast("bigint").alias("rs"), "source").where("rs is not null")
        every = one if every is None else every.unionByName(one)
    by_source = every.groupBy("ann_id", "source").agg(F.sort_array(F.collect_set("rs")).alias("rs")).withColumn("r", rank)
    return by_source.groupBy("ann_id").agg(F.min_by(F.struct("source", "rs"), "r").alias("b")).select("ann_id", "b.source", "b.rs")


def numbered(found: Listed, first: int) -> tuple[DataFrame, DataFrame]:
    """(ann_id, key; key, found): keys of several pairs told apart by a number from ``first`` on."""
    key = lambda k: F.struct(F.lit(k).alias("pair"), "a", "b").alias("key")
    keyed = [x.select("ann_id", key(k)) for k, (x, _) in enumerate(found, first)]
    lists = [x.select(key(k), "found") for k, (_, x) in enumerate(found, first)]
    return functools.reduce(DataFrame.unionByName, keyed), functools.reduce(DataFrame.unionByName, lists)


#: What a cascade gives for a sorted list of rs numbers.
Form = Callable[[Column], Column]


def as_is(rs: Column) -> Column:
    return rs


def joined(rs: Column) -> Column:
    """The numbers of a list as one text, commas between."""
    return F.array_join(rs.cast("array<string>"), ",")


def unfold(keyed: DataFrame, lists: DataFrame, form: Form = as_is) -> DataFrame:
    """ann_id, source, rs (sorted list in its form). keyed: ann_id, source, keys (array); lists: key, found.

    An annotation of one key meets its list last, so what is shuffled grows with
    annotations and lists, and a list gets its form once; only those of several keys have their lists merged.
    """
    one = keyed.where(F.size("keys") == 1).select("ann_id", "source", F.col("keys")[0].alias("key"))
    # (an aggregate keeps the planner from giving lists their form behind the join, once for each annotation)
    formed = lists.groupBy("key").agg(form(F.sort_array(F.array_distinct(F.first("found")))).alias("rs"))
    alone = dealt(one, "key").join(formed, "key").select("ann_id", "source", "rs")
    many = keyed.where(F.size("keys") > 1).select("ann_id", "source", F.explode("keys").alias("key")).join(lists, "key").select("ann_id", "source", F.explode("found").alias("rs"))
    return alone.unionByName(many.groupBy("ann_id", "source").agg(form(F.sort_array(F.collect_set("rs"))).alias("rs")))


def cascade_lists(found: list[tuple[str, Listed]], form: Form = as_is) -> DataFrame:
    """``cascade`` over sources whose rs numbers are lists: sources are chosen by their keys, lists come last (E10). form: see ``unfold``."""
    every, lists, n = None, None, 0
    for source, pairs in found:
        keyed, of = numbered(pairs, n)
        keyed, n = keyed.select("ann_id", F.lit(SOURCES.index(source)).alias("r"), "key"), n + len(pairs)
        every, lists = (keyed, of) if every is None else (every.unionByName(keyed), lists.unionByName(of))
    first = every.withColumn("best", F.min("r").over(Window.partitionBy("ann_id"))).where("r = best")
    keys = first.groupBy("ann_id", "r").agg(F.collect_set("key").alias("keys"))
    return unfold(keys.select("ann_id", F.array(*[F.lit(s) for s in SOURCES])[F.col("r")].alias("source"), "keys"), lists, form)


def resolve_in_stages(ann: DataFrame, stages: list[tuple[str, Callable[[DataFrame], DataFrame | Listed]]], links: DataFrame | None = None) -> tuple[DataFrame, dict[str, int]]:
    """(ann_id, source, rs (sorted list); number found by source): each source in turn for what those before left open.

    stages: (source, function of the open annotations that gives ann_id, rs, or both as ``Listed``). Which keys of lists a
    stage finds and what stays open are written down, so no stage is computed again
    by the next ones; a stage that finds nothing costs no further pass. Lists meet their annotations
    at the end. links (ann_a, ann_b): the rs of one linked mention goes to a partner without any, as source Extended.
    """
    open_, found, counts, lists = checkpointed(ann), [], {}, []
    pairs = 0

    def keep(source: str, keyed: DataFrame) -> DataFrame | None:
        seen = Observation()
        rows = keyed.groupBy("ann_id").agg(F.collect_set("key").alias("keys")).select("ann_id", F.lit(source).alias("source"), "keys")
        kept = checkpointed(rows.observe(seen, F.count("*").alias("n")))
        counts[source] = counts.get(source, 0) + seen.get["n"]
        return kept if seen.get["n"] else None

    for source, find in stages:
        hits = find(open_)
        hits = as_lists(hits.select("ann_id", "rs")) if isinstance(hits, DataFrame) else hits
        keyed, of = numbered(hits, pairs)
        pairs += len(hits)
        kept = keep(source, keyed.join(open_.select("ann_id"), "ann_id", "left_semi"))
        if kept is not None:
            found.append(kept)
            lists.append(checkpointed(of))
            open_ = checkpointed(open_.join(kept.select("ann_id"), "ann_id", "left_anti"))
    if not found:
        return ann.sparkSession.createDataFrame([], "ann_id long, source string, rs array<bigint>"), counts
    every = functools.reduce(DataFrame.unionByName, found)
    if links is not None:
        given = extend_to_partner(every.select("ann_id", F.explode("keys").alias("rs")), links).withColumnRenamed("rs", "key")
        kept = keep("Extended", given.join(open_.select("ann_id"), "ann_id", "left_semi"))
        every = every if kept is None else every.unionByName(kept)
    return unfold(every, functools.reduce(DataFrame.unionByName, lists)), counts


def order_rs(lists: DataFrame, rank: DataFrame) -> DataFrame:
    """id, rs lists in descending corpus rank, ties by number (E11). lists: id, rs (array); rank: rs, freq."""
    rows = lists.select("id", F.explode("rs").alias("rs")).join(rank.select("rs", "freq"), "rs", "left")
    return rows.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.coalesce("freq", F.lit(0))).alias("f"), F.col("rs")))), lambda x: x["rs"]).alias("rs"))


def disambiguate_by_unique(lists: DataFrame) -> DataFrame:
    """Lists that hold an rs which is the only hit of another mention shrink to it (E12). lists: doc_id, id, rs."""
    unique = lists.where(F.size("rs") == 1).groupBy("doc_id").agg(F.collect_set(F.col("rs")[0]).alias("known"))
    j = lists.join(unique, "doc_id", "left")
    common = F.sort_array(F.array_intersect("rs", F.coalesce("known", F.array().cast("array<bigint>"))))
    return j.select("doc_id", "id", F.when((F.size("rs") > 1) & (F.size(common) > 0), common).otherwise(F.col("rs")).alias("rs"))


def top_rs(lists: DataFrame, freq: DataFrame) -> DataFrame:
    """The most frequent rs of each list, of equals the first."""
    rows = lists.select("id", F.posexplode("rs").alias("at", "rs")).join(freq.select("rs", "freq"), "rs", "left")
    return rows.groupBy("id").agg(F.max_by("rs", F.struct(F.coalesce("freq", F.lit(0)), -F.col("at"))).alias("rs"))


def rs_to_gene(ann: DataFrame, rs2gene: DataFrame) -> DataFrame:
    """The gene already linked, else the lowest of the rs (E14). ann: ann_id, rs, gene (may be null)."""
    low = rs2gene.groupBy("rs").agg(F.min("gene").alias("kb_gene"))
    return ann.join(low, "rs", "left").select(*[c for c in ann.columns if c != "gene"], F.coalesce("gene", "kb_gene").alias("gene"))


def to_human_gene(ann: DataFrame, homologs: DataFrame, orthologs: DataFrame) -> DataFrame:
    """Human genes in the place of others, which stay as original_gene (E15). homologs, orthologs: gene, human_gene."""
    h = homologs.groupBy("gene").agg(F.min("human_gene").alias("h"))
    o = orthologs.groupBy("gene").agg(F.min("human_gene").alias("o"))
    human = F.coalesce("h", "o", "gene")
    return ann.join(h, "gene", "left").join(o, "gene", "left").select(*[c for c in ann.columns if c != "gene"], human.alias("gene"), F.when(human != F.col("gene"), F.col("gene")).alias("original_gene"))


def gene_to_taxon(ann: DataFrame, gene2tax: DataFrame) -> DataFrame:
    """The species of the original gene."""
    t = gene2tax.groupBy(F.col("gene").alias("tax_gene")).agg(F.min("tax").alias("tax"))
    key = F.coalesce("original_gene", "gene") if "original_gene" in ann.columns else F.col("gene")
    return ann.join(t, key == F.col("tax_gene"), "left").drop("tax_gene")


def complement(c: Column) -> Column:
    return F.translate(c, "ACGT", "TGCA")


def assign_registry(ann: DataFrame, rs2ca: DataFrame) -> DataFrame:
    """ann_id, ca: of the registry rows of an rs the one that fits best (E17). ann: ann_id, rs, ident; rs2ca: rs, ca, dna_form, protein_form."""
    v, d, p = variants.parse_identifier(F.col("ident")), variants.parse_identifier(F.col("dna_form")), variants.parse_identifier(F.col("protein_form"))
    w, m = v["wild"], v["mut"]
    pair = lambda x, a, b: (x["wild"] == a) & (x["mut"] == b)
    fit = (
        F.when(F.col("ident") == F.col("dna_form"), 1)
        .when(F.col("ident") == F.col("protein_form"), 2)
        .when(pair(d, w, m), 3)
        .when(pair(d, complement(w), complement(m)), 4)
        .when(pair(d, m, w), 5)
        .when(pair(d, complement(m), complement(w)), 6)
        .when(pair(p, w, m), 7)
        .when(pair(p, m, w), 8)
        .when(v["vtype"].isin("DEL", "INS") & (v["vtype"] == d["vtype"]) & (m == d["mut"]), 9)
    )
    # one answer for each distinct question, so rows of registry and annotations do not multiply
    asked = ann.select("rs", "ident").distinct()
    best = asked.join(rs2ca, "rs").withColumn("fit", fit).where("fit is not null").groupBy("rs", "ident").agg(F.min(F.struct("fit", "ca")).alias("best"))
    return ann.select("ann_id", "rs", "ident").join(best, ["rs", "ident"]).groupBy("ann_id").agg(F.min("best").alias("b")).select("ann_id", "b.ca", "b.fit")


def intersect_var_gene(var2rs: DataFrame, gene2rs: DataFrame, form: Column, gene: Column, substring: bool = False) -> DataFrame:
    """rs numbers of a variant (or of forms that contain it) that are also the gene's."""
    hit = F.col("form").contains(form) if substring else F.col("form") == form
    return var2rs.where(hit).select("rs").distinct().join(gene2rs.where(F.col("gene") == gene).select("rs").distinct(), "rs")


#: Longest grams of the index, and how many of a search's grams are looked up.
GRAM, LOOKED_UP = 3, 2
#: Parts of a stored index.
PARTS = 256


def part_of(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(PARTS)).cast("int")


def gram_index(forms: DataFrame) -> DataFrame:
    """part, gram, form: postings of all grams of one to three characters of each form. Stored ``partitionBy("part")``, a search reads the parts of its own grams."""

    def grams(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length("form") - (n - 1))
        return F.when(F.length("form") >= n, F.transform(starts, lambda i: F.substring(F.col("form"), i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    return forms.select("form").where("form <> ''").distinct().select(F.explode(F.array_distinct(F.concat(*[grams(n) for n in range(1, GRAM + 1)]))).alias("gram"), "form").select(part_of(F.col("gram")).alias("part"), "gram", "form")


def containing(index: DataFrame, asked: DataFrame) -> DataFrame:
    """needle, form: the forms that contain each needle of asked.

    A needle of up to three characters is a gram itself. Of a longer one the
    rarest grams are looked up; forms in the postings of all of them are then
    compared with the needle. Empty and null needles are in no form.
    """
    needle = F.col("needle")
    n = F.length("needle")
    grams = F.when(n <= GRAM, F.array("needle")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), n - (GRAM - 1)), lambda i: F.substring(needle, i, F.lit(GRAM)))))
    parts = asked.select("needle").where("needle <> ''").distinct().select("needle", F.explode(grams).alias("gram")).withColumn("part", part_of(F.col("gram")))
    wanted = parts.select("part", "gram").distinct()
    often = index.join(wanted, ["part", "gram"]).groupBy("gram").agg(F.count("*").alias("n"))
    rare = Window.partitionBy("needle").orderBy(F.coalesce("n", F.lit(0)), "gram")
    some = parts.join(often, "gram", "left").withColumn("k", F.row_number().over(rare)).where(F.col("k") <= LOOKED_UP).select("needle", "part", "gram", F.count("*").over(Window.partitionBy("needle")).alias("grams"))
    hits = some.join(index, ["part", "gram"]).groupBy("needle", "form").agg(F.count("*").alias("met"), F.first("grams").alias("grams"))
    return hits.where((F.col("met") == F.col("grams")) & F.col("form").contains(F.col("needle"))).select("needle", "form")


def rs_containing(index: DataFrame, asked: DataFrame, var2rs: DataFrame, gene2rs: DataFrame) -> DataFrame:
    """needle, gene, rs: rs numbers of forms that contain the needle and of the gene asked for with it (E18). asked: needle, gene."""
    wanted = asked.select("needle", "gene").where("gene is not null").distinct()
    # needles meet lists of the rs numbers that a form and a gene share, never all rs numbers of a form
    lists = var2rs.select("form", "rs").distinct().join(gene2rs.select("gene", "rs").distinct(), "rs").groupBy("form", "gene").agg(F.collect_set("rs").alias("found"))
    met = containing(index, asked).join(wanted, "needle").join(lists, ["form", "gene"])
    return met.select("needle", "gene", F.explode("found").alias("rs")).distinct()


def genes_of_rs(ann: DataFrame, rs2gene: DataFrame) -> DataFrame:
    """Each rs of each annotation beside its gene, null if it has none (E19). ann: ann_id, rs (array)."""
    return ann.select("ann_id", F.explode("rs").alias("rs")).join(rs2gene.select("rs", "gene").distinct(), "rs", "left").select("ann_id", "rs", "gene")


def rebuild_history(history: DataFrame, var2rs: DataFrame) -> DataFrame:
    """Every history form normalised anew: form, rs, found, agrees."""
    forms = history.select(F.col("form").alias("ann_id"), F.lit("").alias("doc_id"), F.col("form").alias("ident")).distinct()
    again = match_var2rs(forms, var2rs).groupBy(F.col("ann_id").alias("form")).agg(F.sort_array(F.collect_set("rs")).alias("found"))
    return history.join(again, "form", "left").select("form", "rs", F.coalesce("found", F.array().cast("array<bigint>")).alias("found"), F.coalesce(F.array_contains("found", F.col("rs")), F.lit(False)).alias("agrees"))


def check_cds_location(ann: DataFrame, rs_transcript: DataFrame, cds: DataFrame) -> DataFrame:
    """Whether the place in a name and the start of the coding sequence give the transcript's place."""
    pos = variants.part(F.col("ident"), 3).try_cast("bigint")
    j = ann.join(rs_transcript.select("rs", "transcript", "transcript_pos"), "rs").join(cds.select("transcript", "cds_start"), "transcript")
    return j.select("ann_id", "rs", "transcript", (pos + F.col("cds_start") - 1 == F.col("transcript_pos")).alias("agrees"))


def check_sequence(ann: DataFrame, refseq: DataFrame) -> DataFrame:
    """ann_id, seqid, result: whether the linked gene's sequence has W or M at the place or one before.

    Sequences by id descending; the first that fits wins. refseq: gene, seqid, level, seq.
    """
    v = variants.parse_identifier(F.col("ident"))
    pos = v["pos"].try_cast("int")
    level = F.when(v["seq"] == "p", "p").otherwise("c")
    a = ann.select("ann_id", "gene", level.alias("level"), v["wild"].alias("w"), v["mut"].alias("m"), pos.alias("pos")).where("pos > 0")
    # letters are cut from a sequence once for each place asked for; sequences with equal letters at a place
    # count as the one that wins among them, and each distinct question is answered once
    places = a.select("gene", "level", "pos").distinct()
    here, behind = F.substring("seq", F.col("pos"), F.lit(1)).alias("here"), F.substring("seq", F.col("pos") + 1, F.lit(1)).alias("behind")
    letters = places.join(refseq, ["gene", "level"]).select("gene", "level", "pos", "seqid", here, behind).where("here <> ''").groupBy("gene", "level", "pos", "here", "behind").agg(F.max("seqid").alias("seqid"))
    w, m = F.col("w"), F.col("m")
    result = F.when((F.col("here") == w) & (w != ""), "Matched-W").when((F.col("here") == m) & (m != ""), "Matched-M").when((F.col("behind") == w) & (w != ""), "PlusMatched-W").when((F.col("behind") == m) & (m != ""), "PlusMatched-M")
    keys = ["gene", "level", "pos"]
    # (a missing letter is asked for as an empty one: neither fits anything)
    a = a.fillna("", ["w", "m"])
    answers = a.select(*keys, "w", "m").distinct().join(letters, keys).withColumn("result", result).where("result is not null").groupBy(*keys, "w", "m").agg(F.max(F.struct("seqid", "result")).alias("x"))
    return a.join(answers, [*keys, "w", "m"]).groupBy("ann_id").agg(F.max("x").alias("x")).select("ann_id", "x.seqid", "x.result")
