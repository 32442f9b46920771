"""The stored knowledge base: its rows, and plans that move the asking side only."""

import re

import pytest

from helixtext.functions.shared import shared_path
from helixtext.operators import normalize, report
from helixtext.plans import registry
from helixtext.sources import knowledge, store


@pytest.fixture(scope="module")
def kb(spark):
    s = store.Store(spark, "kb_test", shared_path(spark), 4)
    forms = [(f"{q}|SUB|A|{p}|G", str(1000 + p)) for q in "pq" for p in (*range(10, 20), 123)] + [("c|SUB|A||G", "7"), ("nonsense", "8")]
    s.write("var2rs", knowledge.explode_var2rs(spark.createDataFrame(forms, "var string, rs string"), "t"))
    yield s
    s.drop()


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def got(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def plan_of(frame):
    frame.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_builders(spark):
    assert got(store.merged_rows(lines(spark, "rs1\t2", "1\t2", "3\t", "x\t4", "", None, "5"))) == [(1, 2)]
    assert got(store.expired_rows(lines(spark, "7", "rs7", "", "a", None, "9 \tmore"))) == [(7,), (9,)]
    assert got(store.taxon_rows(lines(spark, "9606\t672", "9606\t", "9606"))) == [("672", "9606")]
    assert got(store.ortholog_rows(lines(spark, "a\th\tb\tc\tg\tmore", "a\th\tb\tc"))) == [("g", "h")]
    assert got(store.homolog_rows(lines(spark, "g\t1", "h\t1", "k\t2"), lines(spark, "1\th", "3\tz"))) == [("g", "h")]
    assert got(store.chromosome_rows(lines(spark, "12\tX", "13", "14\t"))) == [(12, "X")]


def test_lookup_reads_asked_parts_and_moves_no_stored_row(spark, kb):
    asked = spark.createDataFrame([("p|SUB|A|123|G", 1), ("p|SUB|A|12|G", 2), ("g|SUB|A|9999|G", 3)], "form string, id int").repartition(3)
    asked.write.mode("overwrite").parquet(f"{kb.path}/asked")
    found = kb.forms(spark.read.parquet(f"{kb.path}/asked"))
    # the asking side is small here: without this the planner would send it to all tasks
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got(found.select("id", "rs")) == [(1, 1123), (2, 1012)]
    final = plan.split("== Initial Plan ==")[0]
    scan = next(x for x in final.splitlines() if "kb_test_var2rs" in x and "Scan" in x)
    assert "dynamicpruning" in scan
    assert "SelectedBucketsCount: 4 out of 4" in scan
    # one exchange by form (of those who ask), none over the stored rows
    assert len(re.findall(r"Exchange hashpartitioning\(form", final)) == 1


def test_parts_of_odd_forms(spark, kb):
    asked = spark.createDataFrame([("c|SUB|A||G",), ("nonsense",), ("q|SUB|A|17|G",), (None,), ("",)], "form string")
    assert got(kb.forms(asked).select("form", "rs")) == [("c|SUB|A||G", 7), ("nonsense", 8), ("q|SUB|A|17|G", 1017)]


def test_stored_tables_are_joined_in_place(spark, sf_dir):
    x = registry.Inputs(spark, sf_dir)
    stored = registry._stored(x, 4)
    rs = stored.read("rs2gene").select("rs")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        status = normalize.resolve_rs_status(rs, stored.read("merged").withColumnRenamed("rs", "origin"), stored.read("expired"))
        plan = plan_of(status)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan.split("== Initial Plan ==")[0]
    stored.drop()


def test_append(spark):
    s = store.Store(spark, "kb_more", shared_path(spark), 4)
    s.write("refseq", spark.createDataFrame([("672", "NP_1", "p", "MA")], "gene string, seqid string, level string, seq string"))
    fresh = spark.createDataFrame([("672", "NP_1", "p", "MX"), ("673", "NP_2", "p", "MB"), ("673", "NP_2", "p", "MB"), ("1", None, "p", "M")], "gene string, seqid string, level string, seq string")
    s.append("refseq", fresh)
    s.append("refseq", fresh)
    assert got(s.read("refseq").select("seqid", "seq")) == [("NP_1", "MA"), ("NP_2", "MB")]
    s.drop()


def test_empty_tables(spark, kb):
    none = spark.createDataFrame([], "form string, id int")
    assert kb.forms(none).count() == 0


def test_numbers_by_ranges(spark):
    rows = spark.range(100_000).selectExpr("case when id % 5 = 0 then 'm' else 's' end kind", "concat('supp/article/with/one/long/beginning/', lpad(id * 7919 % 100000, 6, '0')) rel", "id _n")
    out = report.numbered(rows, "kind", ["rel", "_n"], "number", 8)
    seen = {}
    for r in out.orderBy("kind", "rel").collect():
        seen[r.kind] = seen.get(r.kind, 0) + 1
        assert r.number == seen[r.kind]
    assert seen == {"m": 20_000, "s": 80_000}
    ranges = rows.repartitionByRange(8, "kind", "rel", "_n").selectExpr("spark_partition_id() p").groupBy("p").count().collect()
    assert max(r["count"] for r in ranges) <= 2 * 100_000 / 8


def test_numbers_of_ties_and_nothing(spark):
    same = spark.createDataFrame([("m", "a")] * 5 + [("s", "a"), ("s", None)], "kind string, rel string")
    assert sorted((r.kind, r.number) for r in report.numbered(same, "kind", ["rel"], "number").collect()) == [*(("m", k) for k in range(1, 6)), ("s", 1), ("s", 2)]
    assert report.numbered(same.where("false"), "kind", ["rel"], "number").count() == 0
