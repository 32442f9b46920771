"""The cascade in stages: each source sees what is still open only."""

from helixtext.operators import normalize


def test_each_source_sees_what_is_open(spark):
    ann = spark.createDataFrame([(k, f"i{k}") for k in range(8)], "ann_id long, ident string")
    seen = {}

    def source(name, rows):
        def find(open_):
            seen[name] = sorted(r.ann_id for r in open_.collect())
            return spark.createDataFrame(rows, "ann_id long, rs long")

        return name, find

    stages = [source("Pattern", [(0, 5), (0, 3), (0, 5)]), source("Recognized", [(1, None)]), source("Mapping", [(0, 9), (1, 7), (2, 8)]), source("RefSeq", [(99, 1)])]
    links = spark.createDataFrame([(0, 3), (4, 2), (5, 6), (1, 0)], "ann_a long, ann_b long")
    out, counts = normalize.resolve_in_stages(ann, stages, links)
    assert seen == {"Pattern": list(range(8)), "Recognized": list(range(1, 8)), "Mapping": list(range(1, 8)), "RefSeq": list(range(3, 8))}
    assert sorted(map(tuple, out.collect())) == [(0, "Pattern", [3, 5]), (1, "Mapping", [7]), (2, "Mapping", [8]), (3, "Extended", [3, 5]), (4, "Extended", [8])]
    assert counts == {"Pattern": 1, "Recognized": 0, "Mapping": 2, "RefSeq": 0, "Extended": 2}


def test_nothing_found(spark):
    ann = spark.createDataFrame([(1, "a")], "ann_id long, ident string")
    out, counts = normalize.resolve_in_stages(ann, [("Pattern", lambda open_: open_.selectExpr("ann_id", "cast(null as long) rs"))])
    assert out.count() == 0 and counts == {"Pattern": 0}


def test_every_source_wins_somewhere(spark, sf_dir):
    from helixtext.plans import registry

    got = {r.source for r in registry.queries()["normalize_staged"](spark, sf_dir).select("source").distinct().collect()}
    assert got == set(normalize.SOURCES)
