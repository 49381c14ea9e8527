"""Queries over tokens, terms and topic models."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.functions.text import ACCENTED, UNACCENTED, WORD_PATTERN, clean_text, run_lengths, sorted_runs, terms, tokenize
from caseloom.operators import topic_fit, topics
from caseloom.operators.ml import array_features, kmeans
from caseloom.registry.core import Tables, query

STOP_WORDS = ["the", "of", "and", "to", "in", "is", "it", "that", "on", "for", "le", "la", "les", "der", "die", "und", "el", "los"]
_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)

TOKENS_SQL = f"""k AS (SELECT doc_id, unnest(list_filter(regexp_extract_all(translate(lower(text), '{ACCENTED}', '{UNACCENTED}'), '{WORD_PATTERN}'),
    lambda w: length(w) BETWEEN 2 AND 15 AND NOT starts_with(w, '_'))) AS token FROM documents)"""


@query("tokenize", f"WITH {TOKENS_SQL} SELECT doc_id, token, count(*) AS n FROM k GROUP BY 1, 2")
def tokenize_query(t: Tables):
    """Counted inside the row: a document is one row, so no token is shuffled."""
    ordered = t.texts().select("doc_id", F.array_sort(tokenize("text")).alias("s"))
    runs = ordered.select("doc_id", "s", sorted_runs(F.col("s")).alias("e"))
    return runs.select("doc_id", F.inline(run_lengths(F.col("s"), F.col("e")))).select("doc_id", F.col("term").alias("token"), F.col("n").cast("bigint").alias("n"))


# A small lexicon; at scale this is a table of the caller.
LEXICON = [
    ("the", "the", "DET"), ("of", "of", "ADP"), ("and", "and", "CCONJ"), ("is", "be", "VERB"), ("are", "be", "VERB"), ("was", "be", "VERB"),
    ("on", "on", "ADP"), ("that", "that", "PRON"), ("for", "for", "ADP"), ("ores", "ore", "NOUN"),
]
_LEXICON = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in LEXICON)


@query(
    "lemmatize_lookup",
    f"""WITH d AS (SELECT doc_id, list_filter(regexp_extract_all(translate(lower(text), '{ACCENTED}', '{UNACCENTED}'), '{WORD_PATTERN}'),
      lambda w: length(w) BETWEEN 2 AND 15 AND NOT starts_with(w, '_')) AS ws FROM documents),
    k AS (SELECT doc_id, i, ws[i] AS form FROM d, range(1, len(ws) + 1) r(i)),
    x(form, lemma, pos) AS (VALUES {_LEXICON}),
    j AS (SELECT doc_id, i, coalesce(lemma, k.form) AS w FROM k LEFT JOIN x ON k.form = x.form WHERE lemma IS NULL OR pos IN ('NOUN', 'ADJ', 'VERB', 'ADV'))
    SELECT documents.doc_id, coalesce(l, '') AS lemmas FROM documents LEFT JOIN (SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS l FROM j GROUP BY 1) USING (doc_id)""",
)
def lemmatize_lookup(t: Tables):
    lexicon = t.spark.createDataFrame(LEXICON, "form string, lemma string, pos string")
    tokens = t.texts().select("doc_id", tokenize("text").alias("tokens"))
    lemmas = topics.lemmatize(tokens, "doc_id", "tokens", lexicon)
    return lemmas.select("doc_id", F.array_join("lemmas", " ").alias("lemmas"))


TERMS_SQL = f"""k AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-zA-Z0-9]{{1,}}')) AS term FROM documents),
    c AS (SELECT doc_id, term, count(*) AS n FROM k WHERE term NOT IN ({_STOPS}) GROUP BY 1, 2),
    m AS (SELECT * FROM c WHERE term IN (SELECT term FROM c GROUP BY 1 HAVING count(*) >= 2))"""


def _term_counts(t: Tables):
    return topics.term_counts(t.texts().select("doc_id", terms("text", STOP_WORDS).alias("terms")), "doc_id", "terms")


@query("doc_term_counts", f"WITH {TERMS_SQL} SELECT doc_id, term, n FROM m")
def doc_term_counts(t: Tables):
    return _term_counts(t)


@query(
    "dtm_sparsity",
    f"""WITH {TERMS_SQL} SELECT count(*) AS nonzero, count(DISTINCT term) AS vocabulary,
    round(100.0::DOUBLE * count(*) / (count(DISTINCT term) * (SELECT count(*) FROM documents)), 8) AS sparsity FROM m""",
)
def dtm_sparsity(t: Tables):
    return topics.sparsity(_term_counts(t), t("documents")).withColumn("sparsity", F.round("sparsity", 8))


WEIGHTS_SQL = "w AS (SELECT vec_id, list_transform(embedding, lambda x: round_even(CAST(x AS DOUBLE), 2)) AS ws FROM embeddings)"


@query(
    "dominant_topic",
    f"""WITH {WEIGHTS_SQL} SELECT vec_id, CAST(i - 1 AS INTEGER) AS topic, ws[i] AS weight, CAST(list_position(ws, list_max(ws)) - 1 AS BIGINT) AS dominant_topic
    FROM w, range(1, 65) r(i)""",
)
def dominant_topic(t: Tables):
    return _dominant(t).select("vec_id", F.posexplode("weights").alias("topic", "weight"), "dominant_topic")


def _dominant(t: Tables):
    rows = t("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    return topics.with_dominant_topic(rows, F.col("e")).drop("e")


@query(
    "topic_distribution",
    f"""WITH {WEIGHTS_SQL}, d AS (SELECT list_max(ws) AS top, CAST(list_position(ws, list_max(ws)) - 1 AS BIGINT) AS dominant_topic FROM w)
    SELECT dominant_topic, count(*) AS num_documents, count(*) FILTER (top > 0.3) AS num_documents_in_threshold FROM d GROUP BY 1 HAVING count(*) FILTER (top > 0.3) > 0""",
)
def topic_distribution(t: Tables):
    wide = topics.topic_columns(_dominant(t), "weights", 64)
    return topics.topic_distribution(wide, [f"topic{i}" for i in range(64)], "dominant_topic", 0.3)


# Dealt documents, fitted models and grids by session and folder: the queries below read one fit.
_FITS: dict[tuple, object] = {}


def _once(t: Tables, name: str, build):
    """What an earlier query of this session made of the folder."""
    key = (t.spark.sparkContext.applicationId, t.folder, name)
    if key not in _FITS:
        _FITS[key] = build()
    return _FITS[key]


def _corpus(t: Tables) -> topic_fit.Corpus:
    return _once(t, "corpus", lambda: topic_fit.deal_documents(t.texts().select("doc_id", terms(clean_text("text"), STOP_WORDS).alias("terms")), "doc_id", "terms"))


def _topics(t: Tables) -> tuple[topic_fit.Corpus, topic_fit.TopicModels]:
    corpus = _corpus(t)
    return corpus, _once(t, "topics", lambda: topic_fit.fit_topics(corpus, [topic_fit.Setting(20)]))


def _weights(t: Tables):
    corpus, models = _topics(t)
    return models.weights(corpus).withColumnRenamed("key", "doc_id")


def _grid(t: Tables):
    """All 45 settings and folds side by side, as many passes as a fit of one setting."""
    return _once(t, "grid", lambda: topic_fit.topic_grid(_corpus(t)))


@query("lda_topics")
def lda_topics(t: Tables):
    return _weights(t).select("doc_id", F.posexplode("topic_weights").alias("topic", "weight"))


@query("lda_quality")
def lda_quality(t: Tables):
    corpus, models = _topics(t)
    found = models.bounds(corpus)[0]
    return t.spark.createDataFrame([(found["bound"], found["perplexity"])], "log_likelihood double, perplexity double")


@query(
    "lda_batches",
    """SELECT 10::BIGINT AS passes, count(*) * 10 AS uses, count(DISTINCT doc_id) AS documents, CAST(ceil(count(*) / 128.0) AS BIGINT) AS batches,
    CAST(least(128, count(*)) AS BIGINT) AS largest, 1::BIGINT AS uses_a_pass FROM documents""",
)
def lda_batches(t: Tables):
    """How the documents are dealt: no batch above 128, every document once a pass."""
    documents = _corpus(t).documents
    uses = documents.groupBy("key").agg(F.count(F.lit(1)).alias("uses"))
    dealt = documents.groupBy("batch").agg(F.count(F.lit(1)).alias("rows")).agg(F.count(F.lit(1)).alias("batches"), F.max("rows").alias("largest")).first()
    return uses.agg((F.sum("uses") * 10).alias("uses"), F.count(F.lit(1)).alias("documents"), F.max("uses").alias("uses_a_pass")).select(
        F.lit(10).cast("bigint").alias("passes"), "uses", "documents", F.lit(dealt["batches"]).cast("bigint").alias("batches"),
        F.lit(dealt["largest"]).cast("bigint").alias("largest"), "uses_a_pass")


@query("lda_grid")
def lda_grid(t: Tables):
    return topics.grid_summary(_grid(t), (0.7, 0.8, 0.9))


@query(
    "lda_grid_settings",
    """WITH d AS (SELECT CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 5 AS fold FROM documents),
    f AS (SELECT fold, count(*) AS n_held, (SELECT count(*) FROM d) - count(*) AS n_train FROM d GROUP BY fold)
    SELECT topics, decay, CAST(fold AS INTEGER) AS fold, n_train, n_held, true AS scored
    FROM f, (SELECT unnest([5, 10, 15]) AS topics), (SELECT unnest([0.7::DOUBLE, 0.8::DOUBLE, 0.9::DOUBLE]) AS decay)""",
)
def lda_grid_settings(t: Tables):
    """A row for every setting and fold of the grid: on how many documents it learnt and was scored."""
    scored = ~F.isnan("score") & (F.col("score") < 0)
    return _grid(t).select("topics", "decay", "fold", "n_train", "n_held", scored.alias("scored"))


@query("lda_best")
def lda_best(t: Tables):
    """The best setting of the grid, fitted again on all documents."""
    best = topics.best_setting(_grid(t)).first()
    corpus = _corpus(t)
    found = topic_fit.fit_topics(corpus, [topic_fit.Setting(best["topics"], best["decay"])]).bounds(corpus)[0]
    row = (best["topics"], best["decay"], best["score"], found["bound"], found["perplexity"])
    return t.spark.createDataFrame([row], "topics int, decay double, score double, log_likelihood double, perplexity double")


@query("lda_weights_sum", "SELECT doc_id, 20::BIGINT AS topics, true AS sums_to_one FROM documents")
def lda_weights_sum(t: Tables):
    """The weights of every document are a distribution over all topics."""
    total = F.aggregate("topic_weights", F.lit(0.0), lambda a, x: a + x)
    return _weights(t).select("doc_id", F.size("topic_weights").cast("bigint").alias("topics"), (F.abs(total - 1) < 1e-6).alias("sums_to_one"))


@query("topic_keywords")
def topic_keywords(t: Tables):
    return topics.keyword_columns(_topics(t)[1].keywords(15), 15)


@query("topic_clusters")
def topic_clusters(t: Tables):
    _, clustered = kmeans(array_features(_weights(t), "topic_weights"), 10, 100)
    return clustered.select("doc_id", "cluster")


@query("classified_documents")
def classified_documents(t: Tables):
    weights = topics.with_dominant_topic(_weights(t), F.col("topic_weights"))
    wide = topics.topic_columns(weights, "weights", 20).drop("topic_weights", "weights")
    return t("documents").select("doc_id", "text").join(wide, "doc_id")
