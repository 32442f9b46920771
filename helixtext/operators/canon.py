"""Mentions to canonical variants. Everything is done once for each distinct mention and joined back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixtext.functions import variants
from helixtext.functions.shared import checkpointed

from .chart import phrase_components, tag_phrases
from .spans import component_drop_reason, keep_apart, parse_components, tag_hgvs


def settle(components: DataFrame) -> DataFrame:
    """Columns c (component struct), level, etype and ident of rows mention, c."""
    c = F.col("c")
    x = components.withColumn("w_", variants.translate_residues(c["w"])).withColumn("m_", variants.translate_residues(c["m"])).withColumn("t_", variants.canonical_type(c["t"]))
    bag = lambda **k: F.struct(*[k.get(n, c[n]).alias(n) for n in "atpwmfsdr"])
    m = F.when(F.col("m_.value") == "CODON", "").otherwise(F.col("m_.value"))
    x = x.withColumn("c", variants.settle_type(bag(w=F.col("w_.value"), m=m, t=F.col("t_"))))
    named = F.col("w_.translated") | F.col("m_.translated") | F.col("w_.codon") | F.col("m_.codon")
    base = F.col("w_.base") | F.col("m_.base")
    x = x.withColumn("level", variants.infer_level(c, named, base))
    codon = F.upper(c["p"]).startswith("CODON")
    x = x.withColumn("c", bag(a=F.col("level"), p=variants.canonical_position(c["p"], F.col("level") == "p", codon)))
    return x.withColumn("etype", variants.mention_type(F.col("level"), c)).withColumn("ident", variants.build_identifier(c)).drop("w_", "m_", "t_")


def canonicalise(spans: DataFrame) -> DataFrame:
    """Spans with level, etype, ident, hgvs and drop_reason.

    Forms of the grammar are read by patterns, all others as plain language by the chart.
    """
    distinct = spans.select("mention").distinct()
    by_grammar = distinct.select("mention", parse_components(F.col("mention")).alias("g"))
    known = F.exists(F.array(*[F.col(f"g.{x}") for x in "atpwmfsdr"]), lambda x: x != "")
    read = by_grammar.select("mention", "g", known.alias("known"), phrase_components(F.when(~known, F.col("mention"))).alias("l"))
    parsed = read.select("mention", F.when(F.col("known"), F.col("g")).otherwise(F.col("l")).alias("c")).withColumn("raw", F.col("c"))
    done = settle(parsed)
    raw = [F.col(f"raw.{x}") for x in "wpmtfd"]
    # the parts as they are written, then the identifier that they make
    reason = F.coalesce(component_drop_reason(*raw, F.col("etype"), F.col("mention"), F.lit("")), variants.identifier_drop_reason(F.col("c"), F.col("etype"), F.col("ident")))
    forms = done.select("mention", F.struct("level", "etype", "ident", variants.render_hgvs(F.col("ident")).alias("hgvs"), reason.alias("drop_reason"), "c").alias("f"))
    # (mentions are distinct and dealt by themselves already; a filter on what comes out would otherwise be unfolded into all rules)
    forms = forms.groupBy("mention").agg(F.first("f").alias("f")).select("mention", "f.*")
    return spans.drop("etype").join(forms, "mention")


def variants_of(docs: DataFrame) -> DataFrame:
    """From texts (doc_id, text) to variants: names and phrases are tagged, the named go first where both overlap, read, and kept without a reason against them."""
    named = tag_hgvs(docs).withColumn("priority", F.lit(0))
    said = tag_phrases(docs).withColumn("priority", F.lit(1))
    # spans are few beside the texts and asked for twice: texts are read once
    found = canonicalise(checkpointed(keep_apart(named.unionByName(said)).drop("priority")))
    return found.where("drop_reason is null").drop("drop_reason")


def mention_list_to_form(mentions: DataFrame) -> DataFrame:
    """mention, ident, etype of bare mention strings."""
    return canonicalise(mentions.select("mention").distinct()).select("mention", "ident", "etype")


def document_evidence(ann: DataFrame) -> DataFrame:
    """Of each document: mentions with an arrow, and mentions that only residues can be."""
    arrow = F.col("mention").rlike("[ACGT]>[ACGT]")
    residue = F.col("mention").rlike("^[A-Z][0-9]+[A-Z]$") & F.col("mention").rlike("^[^ACGT][0-9]|[0-9][^ACGT]$")
    return ann.groupBy("doc_id").agg(F.count_if(arrow).alias("arrows"), F.count_if(residue).alias("residues"))


def retype_by_evidence(ann: DataFrame, many: int = 50) -> DataFrame:
    """Mentions like A154T, all of A, C, G and T, become protein or DNA by what their document shows."""
    unclear = F.col("mention").rlike("^[ACGT][0-9]+[ACGT]$")
    protein = ((F.col("residues") > 0) & (F.col("arrows") > 0)) | (F.col("residues") > many)
    sure_p, sure_c = F.col("mention").rlike("^p\\.|[A-Z][a-z]{2}[0-9]"), F.col("mention").rlike("^[cgmr]\\.|>")
    etype = F.when(sure_p, "ProteinMutation").when(sure_c, "DNAMutation").when(unclear & protein, "ProteinMutation").when(unclear, "DNAMutation").otherwise(F.col("etype"))
    return ann.join(document_evidence(ann), "doc_id").withColumn("etype", etype).drop("arrows", "residues")


def override_sequence(ann: DataFrame, known: DataFrame) -> DataFrame:
    """The level letter and type that (rs, position) is known to have (D15). ann: ann_id, rs, ident, etype; known: rs, pos, seq."""
    v = variants.parse_identifier(F.col("ident"))
    one = known.groupBy(F.col("rs").alias("known_rs"), F.col("pos").alias("known_pos")).agg(F.min("seq").alias("known_seq"))
    j = ann.withColumn("_pos", v["pos"]).join(one, (F.col("rs") == F.col("known_rs")) & (F.col("_pos") == F.col("known_pos")), "left")
    ident = F.when(F.col("known_seq").isNotNull(), F.regexp_replace("ident", r"^[a-z]?\|", F.concat("known_seq", F.lit("|")))).otherwise(F.col("ident"))
    etype = F.when(F.col("known_seq") == "p", "ProteinMutation").when(F.col("known_seq").isNotNull(), "DNAMutation").otherwise(F.col("etype"))
    return j.withColumn("ident", ident).withColumn("etype", etype).select(*ann.columns)
