"""Queries for splits, features, classifiers and metrics."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.functions import clean
from webtext.operators import blocks, classify, cooccurrence, metrics, sparse, splits, tfidf
from webtext.operators.embedding import WordVectors
from webtext.plans import sql, text
from webtext.plans.text import _cleaned, _tokens
from webtext.session import discard, materialise
from webtext.sources import collections as store


def _documents(spark, folder):
    return store.scan(spark, folder, "documents").select("doc_id", "text")


def _parts(first: DataFrame, second: DataFrame, names: tuple[str, str]) -> DataFrame:
    shown = [df.select("doc_id", F.lit(name).alias("part")) for df, name in zip((first, second), names)]
    return shown[0].unionByName(shown[1])


def half_split(spark, folder):
    return _parts(*splits.half_split(_documents(spark, folder), "doc_id"), ("train", "test"))


def _split(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of the first half, cleaned. The split filters run before the cleaning."""
    first, _ = splits.half_split(_documents(spark, folder), "doc_id")
    cleaned = clean.preprocess(F.col("text")).alias("clean_text")
    train, test = splits.train_test_split(first, "doc_id")
    return train.select("doc_id", cleaned), test.select("doc_id", cleaned)


def _final(spark, folder) -> DataFrame:
    """All documents with stop words out and lemmas in, where the others have the cleaned text."""
    used: list[DataFrame] = []
    final = text.final_text(spark, folder, used).select("doc_id", F.col("final_text").alias("clean_text"))
    final = materialise(final, "final-text")
    discard(*used)
    return final


def _final_split(spark, folder) -> tuple[DataFrame, DataFrame]:
    first, _ = splits.half_split(_final(spark, folder), "doc_id")
    return splits.train_test_split(first, "doc_id")


def _final_tokens(spark, folder) -> DataFrame:
    return _final(spark, folder).select("doc_id", clean.clean_words(F.col("clean_text")).alias("tokens"))


def train_test_split(spark, folder):
    return _parts(*_split(spark, folder), ("train", "test"))


def tfidf_vocab(spark, folder, split=_split):
    train, _ = split(spark, folder)
    model = tfidf.TfidfModel.fit(train, "doc_id", "clean_text")
    return model.vocabulary.select("term", "df", F.round("idf", 6).alias("idf"))


def _shown_weights(weights: DataFrame) -> DataFrame:
    return weights.select("doc_id", "term", F.round("value", 6).alias("value"))


def tfidf_train(spark, folder, split=_split):
    train, _ = split(spark, folder)
    return _shown_weights(tfidf.TfidfModel.fit_transform(train, "doc_id", "clean_text")[1])


def tfidf_test(spark, folder, split=_split):
    train, test = split(spark, folder)
    model = tfidf.TfidfModel.fit(train, "doc_id", "clean_text")
    return _shown_weights(model.transform(test, "doc_id", "clean_text"))


def bow_counts(spark, folder, texts=_cleaned):
    return tfidf.bag_of_words(texts(spark, folder), "doc_id", "clean_text")


def _given_vectors(spark, folder, share: int, tokens: DataFrame) -> WordVectors:
    """Vectors for about one in ``share`` words of the documents' tokens, picked by hash of the word."""
    vectors = store.table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    words = blocks.counted(tokens, "tokens").select("word")
    digest = F.conv(F.substring(F.md5("word"), 1, 13), 16, 10).cast("long")
    size = vectors.agg(F.count("*")).scalar()
    keyed = words.withColumn("vec_id", F.pmod(digest, size * share))
    return WordVectors.of(materialise(keyed.join(vectors, "vec_id").select("word", "vector"), "given-vectors"))


def mean_embedding(spark, folder, tokens=_tokens):
    held = materialise(tokens(spark, folder), "tokens")
    means = _given_vectors(spark, folder, 2, held).mean(held, "doc_id", F.col("tokens"))
    cells = means.select("doc_id", F.posexplode_outer("vector").alias("dim", "value"))
    return cells.select("doc_id", "dim", F.round("value", 5).alias("value"))


def mean_embedding_zero(spark, folder):
    held = materialise(_tokens(spark, folder), "tokens")
    means = _given_vectors(spark, folder, 20, held).mean(held, "doc_id", F.col("tokens"))
    return means.select(
        "doc_id", F.size("vector").alias("dims"), F.forall("vector", lambda v: v == 0.0).alias("all_zero")
    )


def _trained(spark, folder, tokens=_tokens) -> WordVectors:
    """On all documents, as a vocabulary has to know every text."""
    return WordVectors.train(tokens(spark, folder), "tokens")


def word2vec_vectors(spark, folder):
    return _trained(spark, folder).table


def word2vec_vocab(spark, folder, tokens=_tokens):
    return _trained(spark, folder, tokens).table.select("word", F.size("vector").alias("dims"))


def _labels(spark, folder):
    return store.table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("target"))


def logreg_predictions(spark, folder):
    vectors = _given_vectors(spark, folder, 2, _tokens(spark, folder))
    parts = [part.select("doc_id", clean.clean_words(F.col("clean_text")).alias("tokens")) for part in _split(spark, folder)]
    train, test = [vectors.mean(materialise(part, "tokens"), "doc_id", F.col("tokens")) for part in parts]
    return classify.logistic_regression(
        train.join(_labels(spark, folder), "doc_id"), test, "doc_id", "vector", "target"
    )


def word_pmi(spark, folder):
    found = cooccurrence.shifted_pmi(_final(spark, folder), "clean_text", window=2, min_count=5, shift=2.0)
    return found.select("a", "b", F.round("pmi", 6).alias("pmi"))


def pmi_vectors_vocab(spark, folder):
    """Words with the number of their dimensions; vectors from the final texts, without a model on the driver."""
    vectors = cooccurrence.train(_final(spark, folder), "clean_text", size=32, window=2, min_count=5, rounds=3)
    return vectors.table.select("word", F.size("vector").alias("dims"))


def tfidf_logreg_predictions(spark, folder, split=_final_split):
    """Classes of the test half's rows from the sparse TF-IDF matrix of the final texts."""
    train, test = split(spark, folder)
    model, cells = tfidf.TfidfModel.fit_transform(train, "doc_id", "clean_text")
    fitted = sparse.SparseLogisticModel.fit(cells, train.select("doc_id").join(_labels(spark, folder), "doc_id"), "doc_id", "target")
    return fitted.predict(model.transform(test, "doc_id", "clean_text"), test, "doc_id")


def nb_predictions(spark, folder, split=_split):
    train, test = split(spark, folder)
    model = classify.NaiveBayesModel.fit(
        train.join(_labels(spark, folder), "doc_id"), "doc_id", "clean_text", "target"
    )
    return model.predict(test, "doc_id", "clean_text")


def _scored(spark, folder):
    """Labelled documents with a score and a prediction from a fixed formula."""
    documents = store.table(spark, folder, "documents").select(
        "doc_id",
        (F.col("n_chars") % 1000 / 1000).alias("score"),
        (F.col("n_chars") % 7 < 2).cast("int").alias("prediction"),
    )
    return documents.join(_labels(spark, folder), "doc_id")


def class_report(spark, folder):
    report = metrics.class_report(_scored(spark, folder), "target", "prediction")
    return report.select("cls", *[F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")], "support")


def roc_curve(spark, folder):
    points = metrics.roc_curve(_scored(spark, folder), "target", "score")
    return points.select("threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


QUERIES = {
    "half_split": half_split,
    "train_test_split": train_test_split,
    "tfidf_vocab": tfidf_vocab,
    "tfidf_train": tfidf_train,
    "tfidf_test": tfidf_test,
    "bow_counts": bow_counts,
    "mean_embedding": mean_embedding,
    "mean_embedding_zero": mean_embedding_zero,
    "word2vec_vectors": word2vec_vectors,
    "word2vec_vocab": word2vec_vocab,
    "logreg_predictions": logreg_predictions,
    "nb_predictions": nb_predictions,
    "word_pmi": word_pmi,
    "pmi_vectors_vocab": pmi_vectors_vocab,
    "tfidf_logreg_predictions": tfidf_logreg_predictions,
    "final_mean_embedding": partial(mean_embedding, tokens=_final_tokens),
    "final_tfidf_vocab": partial(tfidf_vocab, split=_final_split),
    "final_tfidf_train": partial(tfidf_train, split=_final_split),
    "final_tfidf_test": partial(tfidf_test, split=_final_split),
    "final_bow_counts": partial(bow_counts, texts=_final),
    "final_word2vec_vocab": partial(word2vec_vocab, tokens=_final_tokens),
    "final_nb_predictions": partial(nb_predictions, split=_final_split),
    "confusion_matrix": lambda spark, folder: metrics.confusion_matrix(_scored(spark, folder), "target", "prediction"),
    "class_report": class_report,
    "roc_curve": roc_curve,
    "roc_auc": lambda spark, folder: metrics.roc_auc(_scored(spark, folder), "target", "score").select(
        F.round("auc", 6).alias("auc")
    ),
}

_CLEAN = sql.clean_text("text")
_TRAIN_TERMS = f"""{sql.SPLIT},
tf AS (SELECT doc_id, in_test, term, count(*) AS tf
  FROM (SELECT doc_id, in_test, unnest({sql.terms('clean_text')}) AS term FROM split) GROUP BY ALL),
vocab AS (
  SELECT term, count(*) AS df, ln((1.0 + (SELECT count(*) FROM split WHERE NOT in_test)) / (1 + count(*))) + 1 AS idf
  FROM tf WHERE NOT in_test GROUP BY term
)"""


def _tfidf_sql(part: str) -> str:
    return f"""WITH {_TRAIN_TERMS},
weighted AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN vocab USING (term) WHERE {part})
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS value FROM weighted"""


def _means_sql(share: int) -> str:
    return f"""
tok AS (SELECT doc_id, {sql.words(_CLEAN)} AS t FROM documents),
pairs AS (SELECT doc_id, word, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS word FROM tok) GROUP BY ALL),
vectors AS (
  SELECT word, embedding FROM (SELECT DISTINCT word FROM pairs) JOIN embeddings
    ON vec_id = ('0x' || substr(md5(word), 1, 13))::bigint % ((SELECT count(*) FROM embeddings) * {share})
),
cells AS (
  SELECT doc_id, tf, unnest(embedding)::double AS v, unnest(range(len(embedding)))::int AS dim
  FROM pairs JOIN vectors USING (word)
),
grid AS (SELECT doc_id, unnest(range(64))::int AS dim FROM documents),
means AS (SELECT doc_id, dim, sum(tf * v) / sum(tf) AS value FROM cells GROUP BY ALL)"""


_SCORED = """scored AS (
  SELECT doc_id, (n_chars % 1000) / 1000.0::double AS score, (n_chars % 7 < 2)::int AS prediction, toxic AS target
  FROM documents JOIN labels USING (doc_id)
)"""

SQL = {
    "half_split": f"WITH {sql.HALF} SELECT doc_id, CASE WHEN first_half THEN 'train' ELSE 'test' END AS part FROM half",
    "train_test_split": f"WITH {sql.SPLIT} SELECT doc_id, CASE WHEN in_test THEN 'test' ELSE 'train' END AS part FROM split",
    "tfidf_vocab": f"WITH {_TRAIN_TERMS} SELECT term, df, round(idf, 6) AS idf FROM vocab",
    "tfidf_train": _tfidf_sql("NOT in_test"),
    "tfidf_test": _tfidf_sql("in_test"),
    "bow_counts": f"""
SELECT doc_id, term, count(*)::int AS n
FROM (SELECT doc_id, unnest({sql.terms(_CLEAN)}) AS term FROM documents) GROUP BY ALL""",
    "mean_embedding": f"""WITH {_means_sql(2)}
SELECT doc_id, dim, round(coalesce(value, 0), 5) + 0.0 AS value FROM grid LEFT JOIN means USING (doc_id, dim)""",
    "mean_embedding_zero": f"""WITH {_means_sql(20)}
SELECT doc_id, count(*)::int AS dims, bool_and(coalesce(value, 0) = 0) AS all_zero
FROM grid LEFT JOIN means USING (doc_id, dim) GROUP BY doc_id""",
    "word2vec_vocab": f"""
SELECT DISTINCT word, 100 AS dims FROM (SELECT unnest({sql.words(_CLEAN)}) AS word FROM documents)""",
    "nb_predictions": f"""WITH {_TRAIN_TERMS},
training AS (SELECT doc_id, toxic FROM split JOIN labels USING (doc_id) WHERE NOT in_test),
prior AS (SELECT toxic, ln(count(*) / (SELECT count(*) FROM training)) AS lp FROM training GROUP BY toxic),
seen AS (SELECT toxic, term, sum(tf) AS n FROM tf JOIN training USING (doc_id) GROUP BY ALL),
known AS (SELECT DISTINCT term FROM seen),
total AS (SELECT toxic, sum(n) AS t FROM seen GROUP BY toxic),
likelihood AS (
  SELECT toxic, term, ln((coalesce(n, 0) + 1) / (t + (SELECT count(*) FROM known))) AS ll
  FROM known CROSS JOIN total LEFT JOIN seen USING (toxic, term)
),
scores AS (
  SELECT split.doc_id, prior.toxic, any_value(lp) + coalesce(sum(tf * ll), 0) AS s
  FROM split CROSS JOIN prior LEFT JOIN tf ON tf.doc_id = split.doc_id
  LEFT JOIN likelihood ON likelihood.term = tf.term AND likelihood.toxic = prior.toxic
  WHERE split.in_test GROUP BY split.doc_id, prior.toxic
)
SELECT doc_id, arg_max(toxic, s) AS prediction FROM scores GROUP BY doc_id""",
    "confusion_matrix": f"""WITH {_SCORED}
SELECT target AS label, prediction, count(*) AS n FROM scored GROUP BY ALL""",
    "class_report": f"""WITH {_SCORED},
classes AS (SELECT target AS c FROM scored UNION SELECT prediction FROM scored),
counts AS (
  SELECT c, count(*) FILTER (target = c AND prediction = c) AS tp, count(*) FILTER (target = c) AS support,
    count(*) FILTER (prediction = c) AS predicted
  FROM classes, scored GROUP BY c
),
rated AS (
  SELECT c, tp, support, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS p,
    CASE WHEN support = 0 THEN 0 ELSE tp / support END AS r, 2 * tp / (predicted + support) AS f FROM counts
)
SELECT c::varchar AS cls, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM rated
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 6), round(sum(tp) / sum(support), 6),
  round(sum(tp) / sum(support), 6), sum(support)::bigint FROM rated
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)::bigint FROM rated
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), sum(support)::bigint FROM rated""",
    "roc_curve": f"""WITH {_SCORED},
per_score AS (SELECT score, count(*) FILTER (target = 1) AS pos, count(*) FILTER (target <> 1) AS neg FROM scored GROUP BY score)
SELECT score AS threshold, round(sum(neg) OVER (ORDER BY score DESC) / (SELECT sum(neg) FROM per_score), 6) AS fpr,
  round(sum(pos) OVER (ORDER BY score DESC) / (SELECT sum(pos) FROM per_score), 6) AS tpr FROM per_score
UNION ALL SELECT 'inf'::double, 0, 0""",
    "roc_auc": f"""WITH {_SCORED}
SELECT round(sum(CASE WHEN a.score > b.score THEN 1 WHEN a.score = b.score THEN 0.5 ELSE 0 END) / count(*), 6)::double AS auc
FROM scored a JOIN scored b ON a.target = 1 AND b.target = 0""",
}


def _final_sql(name: str) -> str:
    """The statement of ``name`` over the final texts."""
    body = SQL[name].strip().replace("FROM documents", "FROM final_documents")
    final = f"WITH final_documents AS (SELECT doc_id, final_text AS text FROM ({text.SQL['final_text']}))"
    return f"{final}, {body.removeprefix('WITH')}" if body.startswith("WITH") else f"{final} {body}"


SQL |= {
    f"final_{name}": _final_sql(name)
    for name in ("tfidf_vocab", "tfidf_train", "tfidf_test", "bow_counts", "word2vec_vocab", "nb_predictions", "mean_embedding")
}

_FINAL_TOKENS = f"tok AS (SELECT doc_id, {sql.words('final_text')} AS t FROM ({text.SQL['final_text']}))"
_FREQUENT = "frequent AS (SELECT word FROM (SELECT unnest(t) AS word FROM tok) GROUP BY word HAVING count(*) >= 5)"

SQL |= {
    "word_pmi": f"""WITH {_FINAL_TOKENS}, {_FREQUENT},
near AS (
  SELECT t[i] AS x, t[i + gap] AS y FROM tok, unnest(range(1, len(t) + 1)) AS r(i), (VALUES (1), (2)) AS g(gap) WHERE i + gap <= len(t)
),
counted AS (
  SELECT a, b, count(*) AS n FROM (SELECT x AS a, y AS b FROM near UNION ALL SELECT y, x FROM near)
  WHERE a IN (FROM frequent) AND b IN (FROM frequent) GROUP BY a, b
),
sums AS (SELECT a, sum(n) AS s FROM counted GROUP BY a),
weighed AS (
  SELECT counted.a, counted.b, ln(n * (SELECT sum(n) FROM counted)::double / (x.s::double * y.s)) - ln(2.0) AS pmi
  FROM counted JOIN sums x ON x.a = counted.a JOIN sums y ON y.a = counted.b
)
SELECT a, b, round(pmi, 6) AS pmi FROM weighed WHERE pmi > 0""",
    "pmi_vectors_vocab": f"WITH {_FINAL_TOKENS}, {_FREQUENT} SELECT word, 32 AS dims FROM frequent",
}
