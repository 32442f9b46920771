"""BioC XML: collections of documents with passages, infons and annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .pubtator import passage_offsets, route_annotations

INFON = "infon array<struct<_VALUE:string,_key:string>>"
SCHEMA = f"id string, passage array<struct<{INFON.replace(' ', ':', 1)},offset:int,text:string,annotation:array<struct<_id:string,{INFON.replace(' ', ':', 1)},location:array<struct<_length:int,_offset:int>>,text:string>>>>"


def infon(c: Column, *keys: str) -> Column:
    """The first of some keys that an infon array has."""
    def value(key: str) -> Column:
        return F.try_element_at(F.filter(c, lambda x: x["_key"] == key), F.lit(1))["_VALUE"]

    return F.coalesce(*map(value, keys), F.lit(""))


def read_bioc(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """passages and annotations; offsets are moved to the running text (A2)."""
    docs = spark.read.format("xml").option("rowTag", "document").schema(SCHEMA).load(path)
    p = docs.select(F.col("id").alias("doc_id"), F.posexplode("passage").alias("passage_no", "p"))
    flat = p.select("doc_id", "passage_no", infon(F.col("p.infon"), "type", "section_type").alias("ptype"), F.coalesce("p.offset", F.lit(0)).alias("own"), F.coalesce("p.text", F.lit("")).alias("text"), "p.annotation")
    placed = passage_offsets(flat)
    passages = placed.select("doc_id", "passage_no", "ptype", "offset", "text")
    a = placed.select("doc_id", "passage_no", "own", "offset", F.explode("annotation").alias("a"))
    first = F.col("a.location")[0]
    start = first["_offset"] - F.col("own") + F.col("offset")
    ann = a.select("doc_id", "passage_no", start.alias("start_off"), (start + first["_length"]).alias("end_off"), F.col("a.text").alias("mention"), infon(F.col("a.infon"), "type").alias("etype"), infon(F.col("a.infon"), "identifier", "NCBI Gene", "Identifier").alias("ident"))
    return passages, ann.where("start_off is not null")


def to_documents(passages: DataFrame, ann: DataFrame) -> DataFrame:
    """Nested documents: annotations in their passages, numbered within the document (A4, A5)."""
    placed = passage_offsets(passages)
    inside = route_annotations(passages, ann)
    w = Window.partitionBy("doc_id").orderBy("start_off", "end_off", "etype", "mention")
    key = F.when(F.col("etype") == "Gene", "NCBI Gene").when(F.col("etype") == "Species", "NCBI Taxonomy").otherwise("Identifier")
    pair = lambda k, v: F.struct(v.alias("_VALUE"), k.alias("_key"))
    a = inside.withColumn("no", F.row_number().over(w)).select(
        "doc_id",
        "passage_no",
        F.struct(
            F.col("no").cast("string").alias("_id"),
            F.array(pair(F.lit("type"), F.col("etype")), pair(key, F.col("ident"))).alias("infon"),
            F.array(F.struct((F.col("end_off") - F.col("start_off")).alias("_length"), F.col("start_off").alias("_offset"))).alias("location"),
            F.col("mention").alias("text"),
        ).alias("a"),
        "no",
    )
    grouped = a.groupBy("doc_id", "passage_no").agg(F.transform(F.sort_array(F.collect_list(F.struct("no", "a"))), lambda x: x["a"]).alias("annotation"))
    p = placed.join(grouped, ["doc_id", "passage_no"], "left").select("doc_id", "passage_no", F.struct(F.array(pair(F.lit("type"), F.col("ptype"))).alias("infon"), F.col("offset"), F.col("text"), F.col("annotation")).alias("p"))
    return p.groupBy(F.col("doc_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("passage_no", "p")), lambda x, y: x["passage_no"] - y["passage_no"]), lambda x: x["p"]).alias("passage"))


def write_bioc(passages: DataFrame, ann: DataFrame, path: str) -> None:
    to_documents(passages, ann).write.format("xml").option("rowTag", "document").option("rootTag", "collection").save(path)


TEI_SCHEMA = "teiHeader struct<fileDesc:struct<titleStmt:struct<title:string>>,profileDesc:struct<abstract:struct<p:array<string>,div:array<struct<p:array<string>>>>>>, text struct<body:struct<div:array<struct<head:string,p:array<string>>>,figure:array<struct<head:string,figDesc:string,table:struct<row:array<struct<cell:array<string>>>>>>>>"


def tei_to_passages(spark: SparkSession, path: str, supplement: bool = False) -> DataFrame:
    """doc_id, passage_no, ptype, text of article XML (A13); a supplement is one body."""
    d = spark.read.format("xml").option("rowTag", "TEI").schema(TEI_SCHEMA).load(path).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.tei)?\.xml$", 1).alias("doc_id"), "*")
    none = F.array().cast("array<string>")
    paragraphs = F.flatten(F.transform(F.coalesce("text.body.div", F.array().cast("array<struct<head:string,p:array<string>>>")), lambda x: F.coalesce(x["p"], none)))
    figures = F.coalesce("text.body.figure", F.array().cast("array<struct<head:string,figDesc:string,table:struct<row:array<struct<cell:array<string>>>>>>"))
    caption = F.transform(figures, lambda f: F.when(F.coalesce(f["figDesc"].startswith(f["head"]), F.lit(False)), f["figDesc"]).otherwise(F.concat_ws(" ", f["head"], f["figDesc"])))
    tables = F.transform(F.filter(figures, lambda f: f["table"].isNotNull()), lambda f: F.array_join(F.transform(f["table"]["row"], lambda r: F.array_join(r["cell"], " ")), " "))
    abstract = F.concat(F.coalesce("teiHeader.profileDesc.abstract.p", none), F.flatten(F.transform(F.coalesce("teiHeader.profileDesc.abstract.div", F.array().cast("array<struct<p:array<string>>>")), lambda x: F.coalesce(x["p"], none))))
    title = F.coalesce("teiHeader.fileDesc.titleStmt.title", F.lit(""))
    part = lambda kind, x: F.struct(F.lit(kind).alias("ptype"), x.alias("text"))
    if supplement:
        parts = F.array(part("body", F.array_join(F.filter(F.concat(F.array(title), abstract, paragraphs, caption, tables), lambda x: x != ""), " ")))
    else:
        parts = F.concat(
            F.array(part("title", title), part("abstract", F.array_join(abstract, " ")), part("body", F.array_join(paragraphs, " "))),
            F.transform(caption, lambda x: part("fig_caption", x)),
            F.transform(tables, lambda x: part("table", x)),
        )
    return d.select("doc_id", F.posexplode(F.filter(parts, lambda p: p["text"] != "")).alias("passage_no", "p")).select("doc_id", "passage_no", "p.*")
