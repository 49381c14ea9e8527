"""The registered queries of this folder. Each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from caseloom.llm.registry import query, table
from caseloom.session import scratch_path

CHAT_CONTROL = r"[\[<]\\*(?:/?(?:SYS|INST|OUT|ROLE)|/s>)"


@query(
    "op1_exact_top_k",
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
)
def exact_top_k_query(spark, folder):
    from caseloom.llm.topk import exact_top_k

    vectors = table(spark, folder, "embeddings")
    return exact_top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5).drop("query_mark")


@query("op4_token_files")
def token_files_query(spark, folder):
    from caseloom.llm.tokenfile import token_table

    found = token_table(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


@query(
    "op5_chat_format",
    rf"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
      CAST(sum(length(text) + len(regexp_extract_all(text, '{CHAT_CONTROL}'))
        + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 10 ELSE 16 + length(url_encode(role)) END) AS BIGINT) AS formatted_chars
    FROM t GROUP BY conv_id""",
)
def chat_format_query(spark, folder):
    from caseloom.llm.chat import format_conversations, read_conversations

    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    clash = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", clash), (-1, 1, "assistant", clash)], turns.schema)
    return read_conversations(format_conversations(turns.unionByName(probe), scratch_path(spark, "chat")))


@query("op6_byte_bpe")
def byte_bpe_query(spark, folder):
    from caseloom.llm.bpe import encode_documents

    return encode_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query(
    "op8_warc",
    """WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
    d AS (SELECT page_id, strlen(h) AS payload_bytes, min(page_id) OVER (PARTITION BY x) AS first, array_to_string(list_transform(range(0, 32),
      lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(x, 1 + 5 * (i // 4), 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)), '') AS payload_digest FROM p)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id <> first THEN first END AS refers_to FROM d""",
)
def warc_query(spark, folder):
    from caseloom.llm.warc import read_archives, write_archives

    base = scratch_path(spark, "warc")
    found = read_archives(write_archives(table(spark, folder, "pages"), base, min_bytes=0), base)
    return found.where("kind = 'record'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op7_quality")
def quality_query(spark, folder):
    from caseloom.llm.quality import quality_scores

    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op9_toxicity")
def toxicity_query(spark, folder):
    from caseloom.llm.toxicity import toxicity_scores

    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op2_decontaminate")
def decontaminate_query(spark, folder):
    from caseloom.llm.decontaminate import contamination

    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("mark")


@query("op3_ngram_jaccard")
def ngram_jaccard_query(spark, folder):
    from caseloom.llm.jaccard import near_duplicates

    return near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id", "n_links", "n_equal")


@query("op10_suffix_array")
def suffix_array_query(spark, folder):
    from caseloom.llm.suffix import removed_bytes

    return removed_bytes(table(spark, folder, "documents"))


@query(
    "op11_periodic_runs",
    r"""WITH t AS (SELECT list(list_reduce(list_concat([n], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS crc
      FROM (SELECT unnest(range(256)) AS n)),
    d AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
      xor(list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)])), 4294967295) AS h FROM documents, t),
    e AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
    f AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM e),
    w AS (SELECT d, n, i, w[1 + CASE WHEN a IS NULL OR i < a THEN i ELSE a + (i - a) % p END] AS x FROM (SELECT *, unnest(range(n)) AS i FROM f)),
    s AS (SELECT u.d, u.i, v.i - u.i AS q FROM w AS u JOIN w AS v ON u.d = v.d AND u.x = v.x AND v.i > u.i AND 4 * (v.i - u.i) <= u.n),
    k AS (SELECT d, q, i, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS streak FROM s),
    m AS (SELECT d, q, min(i) AS start, count(*) + q AS length FROM k GROUP BY d, q, streak HAVING count(*) + q >= greatest(6, 4 * q)),
    r AS (SELECT d, start, length, min(q) AS period FROM m GROUP BY d, start, length),
    b AS (SELECT d, start, length, period FROM (SELECT *, row_number() OVER (PARTITION BY d ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) AS o FROM r) WHERE o = 1),
    l AS (SELECT d, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS runs FROM r GROUP BY d),
    g AS (SELECT DISTINCT d, unnest(range(start + period, start + length)) AS i FROM r),
    c AS (SELECT w.d, string_agg(x, ' ' ORDER BY w.i) AS kept FROM w ANTI JOIN g ON w.d = g.d AND w.i = g.i GROUP BY w.d)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
      sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM d LEFT JOIN b USING (d) LEFT JOIN l USING (d) LEFT JOIN c USING (d)""",
)
def periodic_runs_query(spark, folder):
    from caseloom.llm.runs import greatest_run, tiled, word_runs

    docs = table(spark, folder, "documents")
    code = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0)
    planted = F.array_join(tiled(words, F.floor(code / 10)), " ")
    text = F.when((code % 10 == 0) & F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")), planted).otherwise(F.col("text"))
    found = word_runs(docs.select("doc_id", text.alias("text"))).withColumn("best", greatest_run(F.col("runs")))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op12_hard_negatives",
    """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
      FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS anchor_id, v.vec_id, q.label = v.label AS same, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
      FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
)
def hard_negatives_query(spark, folder):
    from caseloom.llm.negatives import hard_negatives

    vectors = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.select("vec_id", label.alias("label"), "embedding")
    return hard_negatives(vectors, vectors.where(F.col("vec_id") % 50 == 0)).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@query("op13_license_scan")
def license_scan_query(spark, folder):
    from caseloom.llm.licenses import license_places, license_summary

    return license_summary(license_places(table(spark, folder, "documents"))).drop("places")
