"""Hand-typed rows of the rules."""

import pytest
from pyspark.sql import functions as F

from helixtext.functions import text, variants
from helixtext.operators import associate, canon, documents, normalize, report, spans
from helixtext.sources import bioc, knowledge, pubtator


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


def found(spark, body):
    d = spark.createDataFrame([("1", body)], "doc_id string, text string")
    return sorted((r.start_off, r.end_off, r.mention, r.etype) for r in spans.tag_hgvs(d).collect())


def test_spans_and_their_offsets(spark):
    assert [r[:3] for r in found(spark, "mut p.V600E, c.1799T>A; V600E (rs113488022).")] == [(4, 11, "p.V600E"), (13, 22, "c.1799T>A"), (24, 29, "V600E"), (31, 42, "rs113488022")]


def test_two_rs_and_mixed_mentions(spark):
    assert [r[2:] for r in found(spark, "rs123456 and rs234567")] == [("rs123456", "SNP"), ("rs234567", "SNP")]
    assert [r[2:] for r in found(spark, "A134T rs234567")] == [("A134T", "ProteinMutation"), ("rs234567", "SNP")]


def test_span_text_is_the_substring_and_spans_are_apart(spark):
    body = "x p.Val600Glu, Ala12Thr; c.34_35insG IVS3+1G>A (Arg5*)" * 40
    last = 0
    for a, b, m, _ in found(spark, body):
        assert body[a:b] == m and a >= last
        last = b


def test_empty_and_null_texts(spark):
    d = spark.createDataFrame([("1", None), ("2", "")], "doc_id string, text string")
    assert spans.tag_hgvs(d).count() == 0
    assert documents.tokenize(d).count() == 0


@pytest.mark.parametrize(
    ("ident", "style", "name"),
    [
        ("p|FS|V|35|A|25", "normaliser", "p.V35AfsX25"),
        ("c|DEL|104|T", "normaliser", "c.104delT"),
        ("p|DEL|508|F", "normaliser", "p.F508del"),
        ("p|DEL|508|F", "converter", "p.508delF"),
        ("c|SUB|C|677|T", "converter", "c.677C>T"),
        ("|Allele|C|", "normaliser", ""),
        ("p|SUB|V||E", "normaliser", ""),
    ],
)
def test_names(spark, ident, style, name):
    assert one(spark, variants.render_hgvs(F.col("i"), style), i=ident) == name


@pytest.mark.parametrize(
    ("mention", "ident"),
    [("V600E", "p|SUB|V|600|E"), ("p.Val600Glu", "p|SUB|V|600|E"), ("c.1799T>A", "c|SUB|T|1799|A"), ("c.104delT", "c|DEL|104|T"), ("p.V35AfsX25", "p|FS|V|35|A|25"), ("rs113488022", "rs113488022")],
)
def test_mentions_to_identifiers(spark, mention, ident):
    m = spark.createDataFrame([(mention,)], "mention string")
    assert canon.mention_list_to_form(m).first()["ident"] == ident


def test_details(spark):
    assert one(spark, text.parse_details(F.col("d")), d="a:b:c;x;a:d") == {"a": "d"}


@pytest.mark.parametrize(("n", "shown"), [(999, "999"), (1500, "1.5k"), (142381, "142k"), (1400000, "1.4m")])
def test_display_counts(spark, n, shown):
    assert spark.range(1).select(text.display_count(F.lit(n)).alias("x")).first()["x"] == shown


def test_document_key_is_exact(spark):
    import hashlib

    for stem in ("paper one", "x", "ä"):
        assert one(spark, text.document_key(F.col("s")), s=stem) == str(int(hashlib.md5(stem.encode()).hexdigest(), 16) % 10**8)
    assert one(spark, text.document_key(F.col("s")), s="36922589") == "36922589"


def test_codon_links_and_groups(spark):
    ann = spark.createDataFrame([("d", 1, 0, "p|SUB|V|600|E"), ("d", 2, 10, "c|SUB|T|1799|A"), ("d", 3, 20, "c|Allele|T|1858"), ("d", 4, 30, "c|SUB|C|1858|T"), ("d", 5, 40, "p|SUB|A|1|T")], "doc_id string, ann_id long, start_off int, ident string")
    none = spark.createDataFrame([], "ann_id long, rs long")
    links = spark.createDataFrame([], "ann_a long, ann_b long")
    edges = associate.variant_edges(ann, none, links)
    assert {r.reason for r in edges.collect()} == {"codon", "place"}
    groups = {r.ident: r.group_id for r in associate.variant_groups(ann, edges).collect()}
    assert groups == {"p|SUB|V|600|E": 0, "c|SUB|T|1799|A": 0, "c|Allele|T|1858": 1, "c|SUB|C|1858|T": 1, "p|SUB|A|1|T": 2}


def test_a_long_chain_is_one_group(spark):
    # the smallest identifier hangs on the far end
    names = [f"v{i:03d}" for i in range(1, 201)] + ["v000"]
    ann = spark.createDataFrame([("d", i, n) for i, n in enumerate(names)] + [("e", 0, "v001")], "doc_id string, start_off int, ident string")
    edges = spark.createDataFrame([("d", min(a, b), max(a, b), "place") for a, b in zip(names, names[1:])], "doc_id string, a string, b string, reason string")
    groups = associate.variant_groups(ann, edges).collect()
    assert len(groups) == 202 and {(r.doc_id, r.group_id) for r in groups} == {("d", 0), ("e", 0)}


@pytest.mark.parametrize(
    ("ident", "keys"),
    [
        ("c|DEL|123|A", {"c|DEL|123|A", "c|DEL|123|"}),
        ("c|INS|34_35|G", {"c|INS|34_35|G", "c|INS|34_35|"}),
        ("c|INDEL|5_7|TC", {"c|INDEL|5_7|TC", "c|INDEL|5_7|"}),
        ("c|DUP|9|T|", {"c|DUP|9|T|", "c|DUP|9||"}),
        ("p|FS|V|35|A|25", {"p|FS|V|35|A|25", "p|FS|V|35|A|"}),
        ("p|SUB|V,A|600,12|E", {"p|SUB|V,A|600,12|E", "p|SUB|V|600|E", "p|SUB|A|12|E"}),
        ("rs12345", {"rs12345"}),
    ],
)
def test_direct_keys(spark, ident, keys):
    forms = one(spark, variants.lookup_forms(F.col("i")), i=ident)
    assert {f.key for f in forms if f.kind == "direct"} == keys


def test_rows_without_residues_and_protein_changes_are_met(spark):
    ann = spark.createDataFrame([(1, "d", "c|DEL|123|A"), (2, "d", "p|SUB|V|600|E"), (3, "d", "c|SUB|V|30|E")], "ann_id long, doc_id string, ident string")
    var2rs = spark.createDataFrame([("c|DEL|123|", 10), ("p|SUB|V|30|E", 40)], "form string, rs long")
    changes = spark.createDataFrame([("p|SUB|V|600|E", 20), ("p|SUB|E|600|V", 30)], "form string, rs long")
    got = {(r.ann_id, r.rs, r.kind, r.form_rank) for r in normalize.match_var2rs(ann, var2rs, changes).collect()}
    assert got == {(1, 10, "direct", 0), (2, 20, "protein change", 3), (2, 30, "reversed protein change", 4), (3, 40, "protein", 5)}
    assert {(r.rs, r.form_rank) for r in normalize.match_var2rs(ann, var2rs).collect()} == {(10, 0), (40, 3)}


def test_most_frequent_rs(spark):
    lists = spark.createDataFrame([(1, [121913377, 113488022])], "id int, rs array<long>")
    freq = spark.createDataFrame([(113488022, 90), (121913377, 5)], "rs long, freq int")
    assert normalize.top_rs(lists, freq).first()["rs"] == 113488022


def test_status_of_rs(spark):
    rs = spark.createDataFrame([(1,), (2,), (3,)], "rs long")
    out = normalize.resolve_rs_status(rs, spark.createDataFrame([(2, 9)], "origin long, merged long"), spark.createDataFrame([(3,)], "rs long"))
    assert {(r.rs, r.resolved, r.status) for r in out.collect()} == {(1, 1, "current"), (2, 9, "merged"), (3, 3, "expired")}


def test_segments_skip_inner_spans(spark):
    d = spark.createDataFrame([("1", "a V600E b"), ("2", "none")], "doc_id string, text string")
    a = spark.createDataFrame([("1", 2, 7, "P"), ("1", 3, 5, "Q")], "doc_id string, start_off int, end_off int, etype string")
    assert sorted((r.doc_id, r.seg_no, r.kind, r.piece) for r in report.text_segments(d, a).collect()) == [("1", 0, "plain", "a "), ("1", 1, "P", "V600E"), ("1", 2, "plain", " b"), ("2", 0, "plain", "none")]


def test_pubtator_blocks(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1|t|Title here\n1|a|Body V600E\n1\t11\t16\tV600E\tProteinMutation\tp|SUB|V|600|E\n1\tx\t3\tbad\tGene\t1\n\n2|t|Other\n\n")
    passages, ann = pubtator.read_pubtator(spark, str(tmp_path / "a.txt"))
    assert passages.count() == 3
    assert [(r.doc_id, r.start_off, r.mention) for r in ann.collect()] == [("1", 11, "V600E")]


def test_bioc_identifiers(spark, tmp_path):
    (tmp_path / "a.xml").write_text('<collection><document><id>7</id><passage><infon key="type">title</infon><offset>0</offset><text>TP53 here</text><annotation id="1"><infon key="type">Gene</infon><infon key="NCBI Gene">7157</infon><location offset="0" length="4"/><text>TP53</text></annotation></passage></document></collection>')
    passages, ann = bioc.read_bioc(spark, str(tmp_path / "a.xml"))
    r = ann.first()
    assert (r.doc_id, r.start_off, r.end_off, r.mention, r.etype, r.ident) == ("7", 0, 4, "TP53", "Gene", "7157")


def test_tei(spark, tmp_path):
    (tmp_path / "p.tei.xml").write_text("<TEI><teiHeader><fileDesc><titleStmt><title>T</title></titleStmt></fileDesc><profileDesc><abstract><p>A</p></abstract></profileDesc></teiHeader><text><body><div><head>H</head><p>one</p><p>two</p></div><figure><head>Fig 1</head><figDesc>Fig 1 shows</figDesc></figure></body></text></TEI>")
    got = [(r.doc_id, r.ptype, r.text) for r in bioc.tei_to_passages(spark, str(tmp_path / "p.tei.xml")).orderBy("passage_no").collect()]
    assert got == [("p", "title", "T"), ("p", "abstract", "A"), ("p", "body", "one two"), ("p", "fig_caption", "Fig 1 shows")]


def test_inventory_and_names(spark, tmp_path):
    for n in ("a.pdf", ".hidden.pdf", "~$b.pdf", "c.txt"):
        (tmp_path / n).write_bytes(b"xy")
    assert [(r.name, r.size) for r in knowledge.file_inventory(spark, str(tmp_path)).collect()] == [("a.pdf", 2)]
    (tmp_path / "genes").write_text("#h\n9606\t1\tA1BG\n9606\t2\tNEWENTRY\n")
    assert [(r.id, r.name) for r in knowledge.read_gene_info(spark, str(tmp_path / "genes")).collect()] == [("1", "A1BG")]
