"""Genes and species of variants, and groups of equivalent variants."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtext.functions import lexicon, variants
from helixtext.functions.shared import checkpointed

BLOCK = 512
#: Taxa never given as a variant's species: a parameter's default.
HUMAN = 9606


def blocks(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(F.floor(start / BLOCK), F.floor(F.greatest(end - 1, start) / BLOCK)))


def drop_genes_on_variants(genes: DataFrame, spans: DataFrame) -> DataFrame:
    """Gene mentions that start inside a variant span are left out (F1)."""
    v = spans.select(F.col("doc_id").alias("v_doc"), F.col("start_off").alias("v_start"), F.col("end_off").alias("v_end"), blocks(F.col("start_off"), F.col("end_off")).alias("v_block"))
    inside = (F.col("doc_id") == F.col("v_doc")) & (F.floor(F.col("start_off") / BLOCK) == F.col("v_block")) & (F.col("start_off") >= F.col("v_start")) & (F.col("start_off") < F.col("v_end"))
    return genes.join(v, inside, "left_anti")


def explode_gene_ids(genes: DataFrame, human: DataFrame | None = None) -> DataFrame:
    """One row for each id of a ``;`` list; raf also means 673; mapped to human where a map is given (F2)."""
    ids = F.split("ident", ";")
    with_raf = F.when(F.lower("mention") == "raf", F.array_union(ids, F.array(F.lit("673")))).otherwise(ids)
    out = genes.withColumn("gene", F.explode(with_raf)).where("gene <> ''")
    if human is None:
        return out
    m = human.groupBy(F.col("gene").alias("own")).agg(F.min("human_gene").alias("human_gene"))
    return out.join(m, F.col("gene") == F.col("own"), "left").withColumn("gene", F.coalesce("human_gene", "gene")).drop("own", "human_gene")


def gate_documents(ann: DataFrame) -> DataFrame:
    """Annotations of documents with a mutation; lone alleles go unless long or like a region."""
    docs = ann.where(F.col("etype").isin("DNAMutation", "ProteinMutation", "SNP")).select("doc_id").distinct()
    allele = F.col("etype").isin("DNAAllele", "ProteinAllele")
    region = F.col("mention").rlike("^(?i:chr)|[0-9]+[pq][0-9]+")
    return ann.join(docs, "doc_id", "left_semi").unionByName(ann.join(docs, "doc_id", "left_anti").where(allele & ((F.length("mention") > 20) | region)))


def major_gene(genes: DataFrame) -> DataFrame:
    """doc_id, gene, n, fallback: the most frequent gene; a fallback only if it alone has three mentions."""
    n = genes.groupBy("doc_id", "gene").agg(F.count("*").alias("n"))
    best = n.groupBy("doc_id").agg(F.max_by(F.struct("gene", "n"), F.struct("n", F.col("gene"))).alias("b"), F.sum((F.col("n") >= 3).cast("int")).alias("often"))
    return best.select("doc_id", "b.gene", "b.n", ((F.col("often") == 1) & (F.col("b.n") >= 3)).alias("fallback"))


def last_before(things: DataFrame, asks: DataFrame, keys: list[str], touching: bool) -> DataFrame:
    """asks with hit: struct of the greatest pos of things up to at, and its value, by one sort of both; null if there is none (as-of join).

    things: keys, pos, value, one for each pos; asks: keys, at. touching: also
    value_from, the least value of things at pos or behind it.
    """
    rows = things.select(*keys, F.col("pos").alias("_at"), F.struct("pos", "value").alias("_thing")).unionByName(asks.withColumnRenamed("at", "_at").withColumn("_ask", F.lit(True)), allowMissingColumns=True)
    order = Window.partitionBy(*keys)
    found = rows.withColumn("hit", F.last("_thing", ignorenulls=True).over(order.orderBy("_at", F.col("_ask").asc_nulls_first())))
    if touching:
        found = found.withColumn("value_from", F.min("_thing.value").over(order.orderBy(F.desc("_at"), F.col("_ask").asc_nulls_first())))
    return found.where("_ask").withColumnRenamed("_at", "at").drop("_thing", "_ask")


def first_after(things: DataFrame, asks: DataFrame, keys: list[str], touching: bool) -> DataFrame:
    """As last_before, seen from the other end: the least pos from at on; value_from is of things at pos or before it."""
    turned = last_before(things.withColumn("pos", -F.col("pos")), asks.withColumn("at", -F.col("at")), keys, touching)
    hit = F.when(F.col("hit").isNotNull(), F.struct((-F.col("hit.pos")).alias("pos"), F.col("hit.value").alias("value")))
    return turned.withColumn("at", -F.col("at")).withColumn("hit", hit)


def touching_pairs(asks: DataFrame, things: DataFrame, keys: list[str], first: str, last: str) -> DataFrame:
    """ann_id, value: the least value of things (pos_start, pos_end, value) that touch first..last of an ask; they meet in fixed blocks, so only neighbours do."""
    a = asks.withColumn("block", blocks(F.col(first), F.col(last)))
    t = things.withColumn("block", blocks(F.col("pos_start"), F.col("pos_end") + 1))
    both = a.join(t, [*keys, "block"]).where((F.col("pos_start") < F.col(last)) & (F.col("pos_end") >= F.col(first)))
    return both.groupBy("ann_id").agg(F.min("value").alias("value"))


def nearest_gene_sentence(ann: DataFrame, genes: DataFrame) -> DataFrame:
    """ann_id, gene, distance, tier: the first tier with a gene, there the nearest.

    ann and genes carry a sentence number; sentences follow one another in the text. Tiers: same
    sentence (genes on the mention don't count), the one before, the one after, the title
    (sentence 0), any earlier one, there the gene that ends last. The last gene
    before a mention and the first one after it come from as-of joins: genes and
    mentions in one sort for each tier, so no pair of both is made. Two
    genes that reach a mention of another sentence are equally near: the least counts.
    """
    keys = ["doc_id", "tier", "gs"]
    sentence = ann.schema["sentence"].dataType
    g = genes.select("doc_id", F.col("sentence").alias("t"), F.col("gene").alias("value"), F.col("start_off").alias("g_start"), F.col("end_off").alias("g_end"))
    a = ann.select("ann_id", "doc_id", F.col("sentence").alias("s"), "start_off", "end_off")

    def in_tiers(rows: DataFrame, *tiers: tuple[int, Column, Column]) -> DataFrame:
        """A row for each (tier, sentence) whose condition holds."""
        each = F.filter(F.array(*[F.struct(F.lit(k).alias("tier"), at.cast(sentence).alias("gs"), on.alias("on")) for k, at, on in tiers]), lambda x: x["on"])
        return rows.withColumn("_t", F.explode(each)).select("*", "_t.tier", "_t.gs").drop("_t")

    t, s, yes = F.col("t"), F.col("s"), F.lit(True)
    ends = in_tiers(g.groupBy("doc_id", "t", F.col("g_end").alias("pos")).agg(F.min("value").alias("value")), (0, t, yes), (1, t + 1, yes), (3, F.lit(0), t == 0)).drop("t")
    starts = in_tiers(g.groupBy("doc_id", "t", F.col("g_start").alias("pos")).agg(F.min("value").alias("value")), (0, t, yes), (2, t - 1, yes)).drop("t")
    # (several sentences' genes at one place of a tier: none, a tier's sentence holds one sentence's genes)
    asked = a.drop("end_off").withColumnRenamed("start_off", "at")
    back = last_before(ends, in_tiers(asked, (0, s, yes), (1, s, yes), (3, F.lit(0), s >= 2)).drop("s"), keys, True)
    asked = a.drop("start_off").withColumnRenamed("end_off", "at")
    ahead = first_after(starts, in_tiers(asked, (0, s, yes), (2, s, yes)).drop("s"), keys, True)
    gap = F.abs(F.col("hit.pos") - F.col("at"))
    near = back.unionByName(ahead)
    reached = (F.col("tier") > 0) & F.col("value_from").isNotNull()
    near = near.where(reached | F.col("hit").isNotNull()).select("ann_id", "tier", F.when(reached, 0).otherwise(gap).alias("gap"), F.when(reached, F.col("value_from")).otherwise(F.col("hit.value")).alias("gene"))
    # in the title itself, genes on the mention come as the title's
    on = touching_pairs(a.where("s = 0"), g.where("t = 0").select("doc_id", F.col("g_start").alias("pos_start"), (F.col("g_end") - 1).alias("pos_end"), "value"), ["doc_id"], "start_off", "end_off")
    near = near.unionByName(on.select("ann_id", F.lit(3).alias("tier"), F.lit(0).alias("gap"), F.col("value").alias("gene")))
    # (ends are counted down, so that the least is the last end, then the first gene)
    last = g.groupBy("doc_id", F.col("t").alias("gs")).agg(F.min(F.struct((-F.col("g_end")).alias("back"), F.col("value").alias("gene"))).alias("best"))
    asks = a.select("doc_id", F.col("s").alias("gs")).distinct()
    before = Window.partitionBy("doc_id").orderBy("gs").rangeBetween(Window.unboundedPreceding, -2)
    running = last.unionByName(asks.withColumn("best", F.lit(None).cast(last.schema["best"].dataType))).withColumn("best", F.min("best").over(before))
    running = running.where("best is not null").groupBy("doc_id", "gs").agg(F.min("best").alias("best")).select("doc_id", F.col("gs").alias("s"), "best.gene", (-F.col("best.back")).alias("g_end"))
    early = a.join(running, ["doc_id", "s"]).select("ann_id", F.lit(4).alias("tier"), F.greatest(F.col("start_off") - F.col("g_end"), F.lit(0)).alias("gap"), "gene")
    every = near.unionByName(early).withColumn("distance", F.col("gap") + 1000 * F.col("tier"))
    return every.groupBy("ann_id").agg(F.min(F.struct("tier", "distance", "gene")).alias("b")).select("ann_id", "b.gene", "b.distance", "b.tier")


@functools.cache
def mark_finder() -> Callable[..., Column]:
    """A function of a text and spans in it: for each span the bracket that is open at its start, and the first sentence end behind it; -1 for none."""

    def found(batches):
        import re
        from array import array
        from bisect import bisect_left

        import pyarrow as pa

        fields = [pa.field("bracket", pa.int32()), pa.field("stop", pa.int32())]
        for texts, starts, ends in batches:
            for text, a, b in zip(texts, starts, ends, strict=True):
                # one row at a time: its spans may be many, a batch's are not held together
                text, a, b = text.as_py(), a.as_py(), b.as_py()
                brackets = [m.start() for m in re.finditer("[()]", text or "")]
                stops = [m.start() for m in re.finditer(r"[.!?]\s", text or "", re.ASCII)]
                opened, ended = array("i"), array("i")
                for start, end in zip(a or (), b or (), strict=True):
                    k, n = bisect_left(brackets, start) - 1, bisect_left(stops, end)
                    is_open = k >= 0 and text[brackets[k]] == "("
                    opened.append(brackets[k] if is_open else -1)
                    ended.append(stops[n] if n < len(stops) else -1)
                marks = pa.StructArray.from_arrays([pa.array(opened, pa.int32()), pa.array(ended, pa.int32())], fields=fields)
                yield pa.ListArray.from_arrays(pa.array([0, len(marks)], pa.int32()), marks)

    from collections.abc import Iterator

    import pyarrow

    found.__annotations__ = {"batches": Iterator[tuple[pyarrow.Array, pyarrow.Array, pyarrow.Array]], "return": Iterator[pyarrow.Array]}
    return F.arrow_udf(found, "array<struct<bracket:int,stop:int>>")


def nearest_in_passage(ann: DataFrame, other: DataFrame, value: str, passages: DataFrame, limit: int = 10_000) -> DataFrame:
    """ann_id, value, distance: the nearest in the same passage.

    One before the variant is always allowed; one after it only outside tables
    and without a sentence end between. A variant inside brackets starts at the
    bracket. passages: doc_id, passage_no, ptype, text, offset. Each text is
    looked through once for all its variants; the nearest come from as-of
    joins, and only what touches a variant meets it.
    """
    keys = ["doc_id", "passage_no"]
    spans = ann.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("start_off", "end_off", "ann_id"))).alias("spans"))
    at = lambda f: F.transform("spans", lambda x: (x[f] - F.col("offset")).cast("int"))
    marked = spans.join(passages.select(*keys, "ptype", "text", "offset"), keys).select(*keys, "ptype", "offset", "spans", mark_finder()(F.col("text"), at("start_off"), at("end_off")).alias("marks"))
    v = marked.select(*keys, "ptype", "offset", F.explode(F.arrays_zip("spans", "marks")).alias("x"))
    bracket = F.when(F.col("x.marks.bracket") >= 0, F.col("x.marks.bracket") + F.col("offset")).otherwise(F.col("x.spans.start_off"))
    # one that starts up to here has no sentence end before it
    reach = F.when(F.lower("ptype") == "table", -1).when(F.col("x.marks.stop") >= 0, F.col("x.marks.stop") + F.col("offset") + 1).otherwise(F.lit(2**31 - 1))
    v = v.select(*keys, "x.spans.ann_id", F.col("x.spans.end_off").alias("end_off"), bracket.cast("int").alias("bracket"), reach.cast("int").alias("reach"))
    o = other.select(*keys, F.col("start_off").alias("pos_start"), F.col("end_off").alias("pos_end"), F.col(value).alias("value"))
    ends = o.groupBy(*keys, F.col("pos_end").alias("pos")).agg(F.min("value").alias("value"))
    starts = o.groupBy(*keys, F.col("pos_start").alias("pos")).agg(F.min("value").alias("value"))
    back = last_before(ends, v.select(*keys, "ann_id", "reach", F.col("bracket").alias("at")), keys, False)
    ahead = first_after(starts, v.select(*keys, "ann_id", "reach", F.col("end_off").alias("at")), keys, False).where(F.col("hit.pos") <= F.col("reach"))
    near = back.unionByName(ahead).where("hit is not null").select("ann_id", F.abs(F.col("hit.pos") - F.col("at")).alias("distance"), F.col("hit.value").alias("value"))
    on = touching_pairs(v.select(*keys, "ann_id", "bracket", "end_off"), o, keys, "bracket", "end_off")
    near = near.unionByName(on.select("ann_id", F.lit(0).alias("distance"), "value")).where(F.col("distance") <= limit)
    return near.groupBy("ann_id").agg(F.min(F.struct("distance", "value")).alias("b")).select("ann_id", F.col("b.value").alias(value), "b.distance")


def nearest_species(ann: DataFrame, species: DataFrame, passages: DataFrame, blacklist: tuple[int, ...] = (), limit: int = 50) -> DataFrame:
    """ann_id, tax: the nearest species if not human and within the limit, else human (F7). species: doc_id, passage_no, start_off, end_off, tax."""
    kept = species.where(~F.col("tax").isin(*blacklist)) if blacklist else species
    near = nearest_in_passage(ann, kept, "tax", passages)
    found = ann.select("ann_id").join(near, "ann_id", "left")
    return found.select("ann_id", F.when((F.col("tax") != HUMAN) & (F.col("distance") <= limit), F.col("tax")).otherwise(HUMAN).alias("tax"))


def filter_reference_passages(ann: DataFrame, passages: DataFrame) -> DataFrame:
    """Variants in reference lists stay only if the main text has the mention too (F8)."""
    types = passages.select("doc_id", "passage_no", F.lower("ptype").alias("ptype"))
    a = ann.join(types, ["doc_id", "passage_no"])
    main = a.where("ptype <> 'ref'").select("doc_id", F.lower("mention").alias("low")).distinct()
    kept = a.where("ptype <> 'ref'").unionByName(a.where("ptype = 'ref'").withColumn("low", F.lower("mention")).join(main, ["doc_id", "low"], "left_semi").drop("low"))
    return kept.select(*ann.columns)


def variant_edges(ann: DataFrame, found: DataFrame, links: DataFrame, inclusive: bool = False) -> DataFrame:
    """doc_id, a, b, reason (a < b) between distinct identifiers of a document.

    Edges go from each member to the smallest of its group, so a group of n has
    n - 1 of them: same rs, same (level, type, position); bracket links; and
    protein and coding changes that one base of the codon can turn into one
    another, with ``3(P-1) < pos < 3P`` (up to 3P if inclusive).
    found: rs by ann_id, or by ident where that alone decides; identifiers that share
    several rs then meet once, not once for each.
    """
    p = variants.parse_identifier(F.col("ident"))
    nodes = ann.select("doc_id", "ident").distinct().select("doc_id", "ident", p["seq"].alias("seq"), p["vtype"].alias("vtype"), p["pos"].alias("pos"), p["wild"].alias("w"), p["mut"].alias("m"))

    def star(rows: DataFrame, keys: list[str], reason: str) -> DataFrame:
        low = rows.groupBy(*keys).agg(F.min("ident").alias("a"))
        return rows.join(low, keys).where(F.col("ident") != F.col("a")).select("doc_id", "a", F.col("ident").alias("b"), F.lit(reason).alias("reason"))

    if "ann_id" in found.columns:
        by_rs = star(ann.select("doc_id", "ann_id", "ident").join(found.select("ann_id", "rs"), "ann_id").select("doc_id", "ident", "rs").distinct(), ["doc_id", "rs"], "rs")
    else:
        together = found.where("rs is not null").groupBy("rs").agg(F.sort_array(F.collect_set("ident")).alias("all")).where(F.size("all") > 1).select("all").distinct()
        by_rs = star(nodes.select("doc_id", "ident").join(together.select("all", F.explode("all").alias("ident")), "ident"), ["doc_id", "all"], "rs")
    place = star(nodes.where("pos <> ''").withColumn("family", F.when(F.col("vtype") == "Allele", "SUB").otherwise(F.col("vtype"))), ["doc_id", "seq", "family", "pos"], "place")
    name = ann.select("ann_id", "doc_id", "ident").distinct()
    linked = links.join(name.select(F.col("ann_id").alias("ann_a"), F.col("ident").alias("x"), F.col("doc_id").alias("d")), "ann_a").join(name.select(F.col("ann_id").alias("ann_b"), F.col("ident").alias("y")), "ann_b")
    linked = linked.where("x <> y").select(F.col("d").alias("doc_id"), F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.lit("bracket").alias("reason"))
    spark = ann.sparkSession
    code = F.broadcast(spark.createDataFrame(lexicon.single_base_changes(), "aa_w string, aa_m string, nu_w string, nu_m string"))
    number = F.col("pos").try_cast("bigint")
    protein = nodes.where("seq = 'p' and vtype = 'SUB'").select("doc_id", F.col("ident").alias("pi"), F.col("w").alias("aa_w"), F.col("m").alias("aa_m"), number.alias("codon"))
    # the codon of a coding place makes the range join an equi-join
    at = F.ceil(number / 3)
    coding = nodes.where("seq = 'c' and vtype = 'SUB'").select("doc_id", F.col("ident").alias("ci"), F.col("w").alias("nu_w"), F.col("m").alias("nu_m"), number.alias("n"), at.alias("codon")).where(F.lit(inclusive) | (F.col("n") % 3 != 0))
    codon = protein.join(coding, ["doc_id", "codon"]).join(code, ["aa_w", "aa_m", "nu_w", "nu_m"]).select("doc_id", F.least("pi", "ci").alias("a"), F.greatest("pi", "ci").alias("b"), F.lit("codon").alias("reason"))
    return by_rs.unionByName(place).unionByName(linked).unionByName(codon).distinct()


def variant_groups(ann: DataFrame, edges: DataFrame) -> DataFrame:
    """doc_id, ident, group_id: connected identifiers, groups numbered from 0 by their first mention.

    Edges never leave a document. Large-star and small-star steps in turn, until
    nothing changes: each shortens the way to the smallest identifier, and no
    identifier gathers more than its own edges. Lineage is cut by checkpoints in
    the shared folder.
    """
    nodes = ann.groupBy("doc_id", "ident").agg(F.min("start_off").alias("first"))
    now = edges.where("a <> b").select("doc_id", F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = checkpointed(now)
    while True:
        both = now.unionByName(now.select("doc_id", F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("doc_id", "a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, ["doc_id", "a"]).where("b > a").select("doc_id", F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("doc_id", "a").agg(F.min("b").alias("m"))
        small = large.join(low, ["doc_id", "a"]).where("b <> m").select("doc_id", F.col("b").alias("a"), F.col("m").alias("b"))
        new = checkpointed(small.unionByName(low.select("doc_id", "a", F.col("m").alias("b"))).distinct())
        changed = new.join(now, ["doc_id", "a", "b"], "left_anti").limit(1).count() or now.join(new, ["doc_id", "a", "b"], "left_anti").limit(1).count()
        now = new
        if not changed:
            break
    # now every edge leads to the smallest identifier of its group
    label = nodes.join(now.select("doc_id", F.col("a").alias("ident"), F.col("b").alias("label")), ["doc_id", "ident"], "left").select("doc_id", "ident", F.coalesce("label", "ident").alias("label"))
    first = nodes.join(label, ["doc_id", "ident"]).withColumn("group_first", F.min("first").over(Window.partitionBy("doc_id", "label")))
    w = Window.partitionBy("doc_id").orderBy("group_first", "label")
    return first.select("doc_id", "ident", (F.dense_rank().over(w) - 1).alias("group_id"))


def propagate_group(members: DataFrame) -> DataFrame:
    """A group's rs for members without one; a member with another leaves for a group of its own.

    members: doc_id, ann_id, group_id, rs (may be null), gene (may be null), source.
    """
    w = Window.partitionBy("doc_id", "group_id")
    trusted = F.col("source").isin("Pattern", "GeneNormalized", "Extended", "Recognized")
    group_rs = F.min_by("rs", F.when(F.col("rs").isNotNull() & trusted, F.col("ann_id"))).over(w)
    group_gene = F.min_by("gene", F.when(F.col("gene").isNotNull(), F.col("ann_id"))).over(w)
    out = members.withColumns({"group_rs": group_rs, "group_gene": group_gene})
    leaves = F.col("rs").isNotNull() & F.col("group_rs").isNotNull() & (F.col("rs") != F.col("group_rs"))
    source = F.when(F.col("rs").isNull() & F.col("group_rs").isNotNull(), F.lit("SameGroup")).otherwise(F.col("source"))
    gene = F.coalesce("gene", F.when(F.col("group_rs").isNull(), F.col("group_gene")))
    return out.select("doc_id", "ann_id", "group_id", F.when(leaves, F.col("rs")).alias("split_rs"), F.coalesce("rs", "group_rs").alias("rs"), gene.alias("gene"), source.alias("source"))


def display_filter(ann: DataFrame, chromosome: bool = True, refseq: bool = True, region: bool = True) -> DataFrame:
    """Rows of kinds that are switched off go; regions carry no gene."""
    off = [k for k, on in (("Chromosome", chromosome), ("RefSeq", refseq), ("GenomicRegion", region)) if not on]
    out = ann.where(~F.col("etype").isin(*off)) if off else ann
    if "gene" in ann.columns:
        out = out.withColumn("gene", F.when(~F.col("etype").isin("Chromosome", "GenomicRegion", "CopyNumberVariant"), F.col("gene")))
    return out


def strip_provenance(found: DataFrame) -> DataFrame:
    """ann_id, rs, gene without how they were found: one rs and one gene for each."""
    return found.select("ann_id", F.col("rs")[0].alias("rs"), F.when(~F.col("gene").isin("null", ""), F.split("gene", "[,;|]")[0]).alias("gene"))
