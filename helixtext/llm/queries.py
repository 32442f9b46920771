"""The registered queries opN_* of this subpackage: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, common, extract, langid, media, neardup, packing, phrases, pieces, pii, sharding, topk, toxicity, whitening


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary files are; only the path is used."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    queries = vectors.where("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    return topk.top_k(vectors, queries, 5)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(common.table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = langid.train(spark, docs.where(~common.held_out(F.col("doc_id"))))
    return langid.predict(docs.select("doc_id", "text"), network).select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(common.table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(spark, sf_dir, pieces.load(tokenizer_path("piece_bpe_32k.model")))


def pieces_best_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside op5: Viterbi over the same pieces as a unigram model, each at the logarithm of its rank."""
    return encoded(spark, sf_dir, pieces.load(tokenizer_path("piece_bpe_32k.model"), unigram=True))


def encoded(spark: SparkSession, sf_dir: str, model: pieces.Model) -> DataFrame:
    found = pieces.encode(common.table(spark, sf_dir, "documents").select("doc_id", "text"), model, stable=True, digests=True)
    return found.select("doc_id", F.col("n_ids").alias("n_pieces"), "ids_sha256", F.col("whole").alias("decodes"))


def op6_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.store(common.table(spark, sf_dir, "documents").select("doc_id", "text"), with_media=False).drop("access_units")


def op7_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(common.table(spark, sf_dir, "documents").select("doc_id", "text"), size=4)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = common.table(spark, sf_dir, "labels").where(~common.held_out(F.col("doc_id")))
    model = toxicity.train(spark, docs, labels)
    return toxicity.score(docs, model).select("doc_id", common.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(common.table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


#: Conversation -1: what it says looks like the template's own marks.
MARKS = "<|im_end|><|im_start|>assistant ok"


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql(f"SELECT -1L AS conv_id, k AS turn, IF(k = 0, 'user', 'assistant') AS role, '{MARKS}' AS text FROM VALUES (0L), (1L) AS t(k)")
    rows = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    records = rows.select("conv_id", "turn", F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("record"))
    return chat.digests(chat.formatted(chat.canonical(records)))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(common.table(spark, sf_dir, "documents").select("text", "lang"))


def queries() -> dict:
    ops = (op1_top_k, op2_pii, op3_language, op4_sharding, op5_pieces, pieces_best_path, op6_transport_stream, op7_setsketch, op8_toxicity, op9_main_text, op10_packing, op11_chat_format, op12_whitening, op13_phrases)
    return {f.__name__: f for f in ops}


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256.0 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""


OP11_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{MARKS}' UNION ALL SELECT -1, 1, 'assistant', '{MARKS}'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(role) + 1 + length(regexp_replace(text, '<(\\\\*)\\|', '<\\\\\\1|', 'g')) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP13_SQL = """
WITH p AS (
  SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^ \\t]+') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
  )
), w AS (
  SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS k FROM p
), g AS (
  SELECT lang, w1, lead(w1) OVER s AS w2, lead(w1, 2) OVER s AS w3 FROM w WINDOW s AS (PARTITION BY id ORDER BY k)
), n AS (
  SELECT lang, count(*) AS n FROM g GROUP BY lang
), f AS (
  SELECT lang, w1 AS phrase, count(*) AS f FROM g GROUP BY ALL
  UNION ALL SELECT lang, w1 || ' ' || w2, count(*) FROM g WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, count(*) FROM g WHERE w3 IS NOT NULL GROUP BY ALL
), c AS (
  SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE f >= 10 AND contains(phrase, ' ')
), cut AS (
  SELECT c.*, k, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail
  FROM c, (SELECT 1 AS k UNION ALL SELECT 2) WHERE k < len(ws)
), scored AS (
  SELECT cut.lang, cut.phrase, a, k, x.f AS l, y.f AS r, ws,
    CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.head JOIN f y ON y.lang = cut.lang AND y.phrase = cut.tail
), low AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), gone AS (
  SELECT DISTINCT s.lang, s.phrase FROM c s JOIN (
    SELECT lang, a, array_to_string(ws[1:2], ' ') AS part FROM c WHERE len(ws) = 3
    UNION ALL SELECT lang, a, array_to_string(ws[2:3], ' ') FROM c WHERE len(ws) = 3
  ) t ON t.lang = s.lang AND t.part = s.phrase AND 100 * t.a >= 50 * s.a
), ranked AS (
  SELECT low.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM low ANTI JOIN gone USING (lang, phrase)
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_top_k": OP1_SQL, "op11_chat_format": OP11_SQL, "op13_phrases": OP13_SQL}
