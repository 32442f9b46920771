"""Line-based annotated articles: ``id|type|text`` lines, annotation rows, a blank line behind each document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Passage types of the report reader.
REPORT_TYPES = ("title", "abstract", "body", "t", "a", "fig_caption", "table")
PASSAGE = r"^([^|\t]+)\|([^|\t]+)\|(.*)$"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    blocks = spark.read.option("lineSep", "\n\n").text(path)
    return blocks.select(F.posexplode(F.split("value", "\n")).alias("line_no", "line")).where("line <> ''")


def parse_lines(lines: DataFrame, types: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """Passages and annotations of lines (line_no, line)."""
    g = lambda k: F.regexp_extract("line", PASSAGE, k)
    passages = lines.where(F.col("line").rlike(PASSAGE)).select(g(1).alias("doc_id"), F.col("line_no").alias("passage_no"), g(2).alias("ptype"), g(3).alias("text"))
    if types:
        passages = passages.where(F.lower("ptype").isin(*types))
    f = F.split("line", "\t")
    at = lambda k: F.try_element_at(f, F.lit(k + 1))
    rows = lines.where(~F.col("line").rlike(PASSAGE) & (F.size(f) >= 5))
    ann = rows.select(at(0).alias("doc_id"), at(1).try_cast("int").alias("start_off"), at(2).try_cast("int").alias("end_off"), at(3).alias("mention"), at(4).alias("etype"), F.coalesce(at(5), F.lit("")).alias("ident"))
    return passages, ann.where("start_off is not null and end_off is not null")


def read_pubtator(spark: SparkSession, path: str, types: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """passages (doc_id, passage_no, ptype, text) and annotations of files (A1); types None: any."""
    return parse_lines(_lines(spark, path), types)


def to_blocks(passages: DataFrame, ann: DataFrame) -> DataFrame:
    """One text block for each document: passages in order, annotations by start (A3)."""
    p = passages.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("passage_no", F.concat_ws("|", "doc_id", "ptype", "text").alias("line")))).alias("p"))
    row = F.concat_ws("\t", "doc_id", F.col("start_off").cast("string"), F.col("end_off").cast("string"), "mention", "etype", F.coalesce("ident", F.lit("")))
    a = ann.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start_off", "end_off", row.alias("line")))).alias("a"))
    lines = F.concat(F.transform("p", lambda x: x["line"]), F.coalesce(F.transform("a", lambda x: x["line"]), F.array().cast("array<string>")))
    return p.join(a, "doc_id", "left").select("doc_id", F.array_join(lines, "\n").alias("value"))


def write_pubtator(passages: DataFrame, ann: DataFrame, path: str) -> None:
    to_blocks(passages, ann).select("value").write.option("lineSep", "\n\n").text(path)


def passage_offsets(passages: DataFrame) -> DataFrame:
    """Offset of each passage: running length + 1."""
    order = Window.partitionBy("doc_id").orderBy("passage_no").rowsBetween(Window.unboundedPreceding, -1)
    return passages.withColumn("offset", F.coalesce(F.sum(F.length("text") + 1).over(order), F.lit(0)).cast("int"))


def route_annotations(passages: DataFrame, ann: DataFrame) -> DataFrame:
    """Annotations beside the passage that holds their start (A5)."""
    p = passage_offsets(passages).select("doc_id", "passage_no", "offset", F.length("text").alias("n"))
    return ann.join(p, "doc_id").where((F.col("start_off") >= F.col("offset")) & (F.col("start_off") < F.col("offset") + F.greatest(F.col("n"), F.lit(1)))).select(*[ann[c] for c in ann.columns], "passage_no", "offset")


def line_kind(line: Column) -> Column:
    return F.when(line == "", "blank").when(line.rlike(PASSAGE), "passage").when(F.size(F.split(line, "\t")) >= 4, "annotation").otherwise("neither")


def validate(lines: DataFrame) -> DataFrame:
    """file, line_no, problem (A6). lines: file, line_no, line in file order."""
    w = Window.partitionBy("file").orderBy("line_no")
    kind = line_kind(F.col("line"))
    doc = F.when(kind == "passage", F.regexp_extract("line", PASSAGE, 1)).when(kind == "annotation", F.substring_index("line", "\t", 1))
    x = lines.withColumns({"kind": kind, "doc": doc})
    x = x.withColumns({"before": F.lag("kind").over(w), "doc_before": F.lag("doc").over(w), "after": F.lead("kind").over(w)})
    problem = (
        F.when(F.col("kind") == "neither", "neither format")
        .when((F.col("kind") == "blank") & (F.coalesce("before", F.lit("blank")) == "blank"), "redundant blank")
        .when((F.col("kind") == "passage") & (F.col("before") != "blank") & (F.col("doc_before") != F.col("doc")), "missing blank")
    )
    last = F.when((F.col("kind") != "blank") & F.col("after").isNull(), "missing final blank")
    found = x.select("file", "line_no", F.explode(F.array(problem, last)).alias("problem")).where("problem is not null")
    start = x.where((F.col("kind") == "passage") & (F.coalesce("before", F.lit("blank")) == "blank"))
    twice = start.groupBy("doc").agg(F.count("*").alias("n"), F.min_by("file", F.struct("file", "line_no")).alias("file"), F.min(F.struct("file", "line_no"))["line_no"].alias("line_no")).where("n > 1")
    return found.unionByName(twice.select("file", "line_no", F.lit("duplicate document").alias("problem")))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no, line of whole files: lines of one file stay in order."""
    whole = spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("file"), "value")
    body = F.regexp_replace("value", r"\n\z", "")
    return whole.select("file", F.posexplode(F.split(body, "\n")).alias("line_no", "line"))
