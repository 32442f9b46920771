"""Enrichment and corpus-wide summaries. ann: doc_id, start_off, end_off, mention, etype, ident, and more."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtext.functions import lexicon, text
from helixtext.functions.shared import checkpointed

ENTITY_KEYS = ["doc_id", "start_off", "end_off", "mention", "etype"]


def enrich_entities(ann: DataFrame, more: DataFrame) -> DataFrame:
    """Gene, species and cell line rows that are not there yet; a leading * of taxon ids goes (G1)."""
    new = more.where(F.col("etype").isin(*lexicon.GENE_TYPES, *lexicon.ORGANISM_TYPES)).withColumn("ident", F.when(F.col("etype") == "Species", F.ltrim("ident", F.lit("*"))).otherwise(F.col("ident")))
    return ann.unionByName(new.dropDuplicates(ENTITY_KEYS).join(ann.select(*ENTITY_KEYS), ENTITY_KEYS, "left_anti").select(*ann.columns))


def is_variant(etype: Column) -> Column:
    return ~etype.isin(*lexicon.GENE_TYPES, *lexicon.ORGANISM_TYPES)


def summary(rows: DataFrame, keys: list[str], per_document: bool) -> DataFrame:
    """Counts and documents of each group; most frequent first is left to ``top_n``."""
    if per_document:
        return rows.groupBy("doc_id", *keys).agg(F.count("*").alias("n"))
    # two steps: a document's own rows meet before documents are collected
    by_doc = rows.groupBy(*keys, "doc_id").agg(F.count("*").alias("n"))
    return by_doc.groupBy(*keys).agg(F.sum("n").alias("n"), F.count("*").alias("n_docs"), F.array_join(F.sort_array(F.collect_list("doc_id")), ",").alias("docs"))


def variant_summary(ann: DataFrame, per_document: bool = False) -> DataFrame:
    """By mention, type, HGVS name and gene."""
    return summary(ann.where(is_variant(F.col("etype"))), ["mention", "etype", "hgvs", "gene"], per_document)


def gene_summary(ann: DataFrame, per_document: bool = False) -> DataFrame:
    """By mention and identifier."""
    return summary(ann.where(F.col("etype").isin(*lexicon.GENE_TYPES)), ["mention", "ident"], per_document)


def organism_summary(ann: DataFrame, per_document: bool = False) -> DataFrame:
    """By mention (in small letters for species only), type and identifier."""
    rows = ann.where(F.col("etype").isin(*lexicon.ORGANISM_TYPES)).withColumn("mention", F.when(F.col("etype") == "Species", F.lower("mention")).otherwise(F.col("mention")))
    return summary(rows, ["mention", "etype", "ident"], per_document)


def numbered(rows: DataFrame, group: str, order: list[str], name: str, parts: int | None = None) -> DataFrame:
    """The rows with their number in each group, from 1, in an order; no task holds a group.

    Rows are sorted over ranges and written once, then counted: one row for each range and
    group in it tells how many come before. group is never null and has few values (a
    kind, not an id): ranges and groups bound what is broadcast. Of equal rows each has a number.
    """
    width = [parts] if parts else []
    dealt = rows.repartitionByRange(*width, group, *order).sortWithinPartitions(group, *order)
    placed = checkpointed(dealt.withColumn("_at", F.monotonically_increasing_id())).withColumn("_range", F.shiftright("_at", 33))
    counts = placed.groupBy(group, "_range").agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    before = F.sum("n").over(Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(group, "_range", (F.coalesce(before, F.lit(0)) + 1 - F.col("first")).alias("_move"))
    return placed.join(F.broadcast(starts), [group, "_range"]).select(*rows.columns, (F.col("_at") + F.col("_move")).alias(name))


def document_index(docs: DataFrame, ann: DataFrame) -> DataFrame:
    """Keys m1… and s1…, label, category, number of annotations (G6). docs: doc_id, rel (path)."""
    category = text.path_category(F.col("rel"))
    kind = F.when(category == "Main Publication", "m").otherwise("s")
    n = ann.groupBy("doc_id").agg(F.count("*").alias("annotations"))
    placed = docs.select("doc_id", "rel", category.alias("category"), kind.alias("kind"), text.path_label(F.col("rel")).alias("label"))
    keyed = numbered(placed, "kind", ["rel", "doc_id"], "number")
    return keyed.join(n, "doc_id", "left").select("doc_id", F.concat("kind", F.col("number").cast("string")).alias("doc_key"), "label", "category", F.coalesce("annotations", F.lit(0)).alias("annotations"))


def display_names(rows: DataFrame, key: str, names: DataFrame) -> DataFrame:
    """Names of ids; unknown ids are shown as they are (G7). names: id, name."""
    one = names.groupBy(F.col("id").alias(key)).agg(F.min("name").alias("name"))
    return rows.join(one, key, "left").withColumn("name", F.coalesce("name", key))


def pipeline_stats(stats: DataFrame, steps: list[str]) -> DataFrame:
    """One row for each label: seconds of every step, characters of the last step that has any, and display units."""
    wide = stats.groupBy("label").pivot("step_name", steps).agg(F.max_by("seconds", "step").alias("seconds"))
    chars = stats.where("chars is not null").groupBy("label").agg(F.max_by("chars", "step").alias("chars"), F.max_by("words", "step").alias("words"))
    return wide.join(chars, "label", "left").withColumn("chars_shown", text.display_count(F.col("chars")))


def step_totals(stats: DataFrame) -> DataFrame:
    """Characters and words of each step's files, and its total."""
    r = stats.rollup("step_name", "label").agg(F.sum("chars").alias("chars"), F.sum("words").alias("words"), F.grouping_id().alias("g"))
    return r.where("g < 3").select("step_name", F.when(F.col("g") == 1, "TOTAL").otherwise(F.col("label")).alias("label"), "chars", "words")


def reanchor(ann: DataFrame, docs: DataFrame, far: int = 7) -> DataFrame:
    """Offsets moved to the nearest place where the mention is, the earlier first; else left."""
    shifts = F.array(*[F.lit(s) for k in range(far + 1) for s in ((-k, k) if k else (0,))])
    n = F.length("mention")
    fits = F.filter(shifts, lambda s: (F.col("start_off") + s >= 0) & (F.substring("text", F.col("start_off") + s + 1, n) == F.col("mention")))
    move = F.coalesce(F.try_element_at(fits, F.lit(1)), F.lit(0))
    j = ann.join(docs.select("doc_id", "text"), "doc_id").withColumn("move", move)
    return j.withColumn("start_off", F.col("start_off") + F.col("move")).withColumn("end_off", F.col("end_off") + F.col("move")).select(*ann.columns)


def text_segments(docs: DataFrame, ann: DataFrame) -> DataFrame:
    """doc_id, seg_no, kind, piece: plain and marked pieces in turn; a span that starts inside the last kept is skipped."""
    spans = ann.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start_off", "end_off", "etype"))).alias("spans"))
    kind = "array<struct<kind:string,piece:string>>"
    cut = lambda a, b: F.substring("text", a + 1, b - a)

    def step(acc: Column, s: Column) -> Column:
        plain = F.when(s["start_off"] > acc["at"], F.array(F.struct(F.lit("plain").alias("kind"), cut(acc["at"], s["start_off"]).alias("piece")))).otherwise(F.array().cast(kind))
        mark = F.array(F.struct(s["etype"].alias("kind"), cut(s["start_off"], s["end_off"]).alias("piece")))
        new = F.struct(s["end_off"].alias("at"), F.concat(acc["out"], plain, mark).alias("out"))
        return F.when(s["start_off"] >= acc["at"], new).otherwise(acc)

    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
    whole = F.coalesce("spans", F.array().cast("array<struct<start_off:int,end_off:int,etype:string>>"))
    done = F.aggregate(whole, start, step)
    rest = F.when(F.length("text") > done["at"], F.array(F.struct(F.lit("plain").alias("kind"), F.substring("text", done["at"] + 1, F.length("text")).alias("piece")))).otherwise(F.array().cast(kind))
    j = docs.select("doc_id", "text").join(spans, "doc_id", "left")
    return j.select("doc_id", F.posexplode(F.concat(done["out"], rest)).alias("seg_no", "s")).select("doc_id", "seg_no", "s.kind", "s.piece")


def top_n(rows: DataFrame, n: int | None, by: str, etype: str | None = None) -> DataFrame:
    """The first n rows by a column, descending, numbers as numbers; with shown and total counts."""
    kept = rows.where(F.col("etype") == etype) if etype else rows
    number = F.replace(F.col(by).cast("string"), F.lit(","), F.lit("")).try_cast("double")
    rest = [F.col(c) for c in kept.columns if c != by and not c.startswith("docs")]
    ordered = kept.orderBy(number.desc_nulls_last(), F.col(by).desc(), *rest)
    total = kept.agg(F.count("*")).scalar()
    first = ordered.limit(n) if n else kept
    return first.withColumn("total", total).withColumn("shown", F.least(F.col("total"), F.lit(n).cast("bigint")) if n else F.col("total"))


def entity_labels(ann: DataFrame) -> DataFrame:
    """Display label of each type."""
    default = F.when(is_variant(F.col("etype")), "Sequence ID").otherwise("Other")
    return ann.withColumn("label", F.coalesce(lexicon.lookup(lexicon.LABELS)[F.col("etype")], default))
