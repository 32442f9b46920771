"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last
return the columns of documents. The result of a stage, written as Parquet, is
the next one's docs.

Defined cases, in every stage: a null or empty text scores as an ordinary
document without words, so ``toxicity`` keeps it; it has no language, so
``language`` rejects it; ``near_copies`` links it with nothing, ``personal_data``
leaves it as it is (null stays null), and ``packing`` gives it its closing id
alone. A row with a null id is kept by the same rules and never joined to
another. Rows that repeat an id and its text stay in the first two stages and
are one after ``near_copies``. An empty table gives an empty one. Columns of any
other name are the caller's, also such as an operator would give: they pass
through all stages but the last unchanged (n_chars is counted anew where a
text has changed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixtext.llm import common, langid, neardup, packing, pii, toxicity
from helixtext.llm.queries import tokenizer_path

#: Documents at least this likely toxic go.
TOXIC = 0.5
#: Documents whose language is at least this sure stay; ``und`` goes. Chance is 0.25 with four languages; short clean texts reach 0.33.
SURE = 0.3
#: Words of a shingle of the near-copies stage, as in the query.
SHINGLE = 4


def put_aside(docs: DataFrame) -> DataFrame:
    """docs with all columns but id and text named by number, so that no operator's own column meets one of them."""
    return docs.toDF(*[c if c in ("doc_id", "text") else f"kept_{i}" for i, c in enumerate(docs.columns)])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = common.table(spark, sf_dir, "labels").where(~common.held_out(F.col("doc_id")))
    model = toxicity.train(spark, docs, labels)
    aside = put_aside(docs)
    return toxicity.score(aside, model, TOXIC, keep_text=True).where("predicted = 0").select(*aside.columns).toDF(*docs.columns)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.package_to_executors(spark)
    network = langid.train(spark, docs.where(~common.held_out(F.col("doc_id"))))
    aside = put_aside(docs)
    found = langid.predict(aside, network, keep_text=True)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= SURE)).select(*aside.columns).toDF(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.package_to_executors(spark)
    return neardup.without_copies(put_aside(docs), size=SHINGLE).toDF(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.package_to_executors(spark)
    return pii.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    common.package_to_executors(spark)
    return packing.pack(docs.select("doc_id", "text"), tokenizer_path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_copies", drop_near_copies),
    ("personal_data", redact),
    ("packing", pack),
]

#: Models and a tokenizer can't be put in SQL. The tests hold each stage's decisions against plain loops over its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = common.Scratch(spark)
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
