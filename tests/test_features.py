import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from webtext.functions import clean
from webtext.operators import classify, lemmas, lookup, metrics, splits
from webtext.operators.embedding import WordVectors
from webtext.operators.tfidf import TfidfModel, bag_of_words


@pytest.fixture(params=["broadcast", "salted"])
def join_mode(request, monkeypatch):
    """Run a test with a small table and as if the table were too large to broadcast."""
    if request.param == "salted":
        monkeypatch.setattr(lookup, "fits_broadcast", lambda table, limit: False)
    return request.param


def values(df, *names):
    return {tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*names).collect()}


def test_token_counts(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["x"])], "id int, t array<string>")
    inner = lookup.token_counts(df, "id", F.col("t"))
    assert values(inner, "id", "token", "tf") == {(1, "a", 1), (1, "b", 2), (4, "x", 1)}
    outer = lookup.token_counts(df, "id", F.col("t"), outer=True)
    assert values(outer, "id", "token", "tf") == {(1, "a", 1), (1, "b", 2), (2, None, None), (3, None, None), (4, "x", 1)}


def test_token_counts_of_documents(documents):
    tokens = clean.words(F.col("text"))
    rows = documents.select("doc_id", tokens.alias("t")).collect()
    expected = {(r["doc_id"], token, n) for r in rows for token, n in Counter(r["t"]).items()}
    assert values(lookup.token_counts(documents, "doc_id", tokens), "doc_id", "token", "tf") == expected


def test_token_counts_need_no_shuffle(documents):
    plan = lookup.token_counts(documents, "doc_id", clean.words(F.col("text")))._jdf.queryExecution().executedPlan()
    assert "Exchange" not in plan.toString()


def test_hot_token_is_spread(spark):
    """A token with half of all rows ends up in several partitions, and nothing is lost."""
    rows = spark.range(20000).select(
        "id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id"))).alias("token")
    )
    table = rows.select("token").distinct().withColumn("n", F.length("token"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = lookup.lookup(rows, table, ["token"], "id", broadcast_bytes=0)
        hot = joined.filter("token = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(hot) > 1 and sum(r["count"] for r in hot) == 10000
        assert joined.count() == 20000
        small = lookup.lookup(rows, table, ["token"], "id")
        assert joined.exceptAll(small).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_broadcast_is_checked(spark):
    table = spark.createDataFrame([("a", [1.0] * 10), ("é", None)], "w string, v array<double>")
    assert lookup.fits_broadcast(table, 200) and not lookup.fits_broadcast(table, 150)
    assert lookup.fits_broadcast(table.filter("w = 'q'"), 0)


def test_tfidf(spark, join_mode):
    train = spark.createDataFrame([(1, "aa bb aa"), (2, "bb cc")], "id int, text string")
    test = spark.createDataFrame([(3, "zz bb x"), (4, ""), (5, None)], "id int, text string")
    model = TfidfModel.fit(train, "id", "text")
    assert values(model.transform(train, "id", "text"), "id", "term", "value") == {
        (1, "aa", 0.942156),
        (1, "bb", 0.335176),
        (2, "bb", 0.579739),
        (2, "cc", 0.814802),
    }
    assert values(model.transform(test, "id", "text"), "id", "term", "value") == {(3, "bb", 1.0)}
    assert values(model.vocabulary, "term", "df") == {("aa", 1), ("bb", 2), ("cc", 1)}


def test_tfidf_rows_have_length_one(documents, join_mode):
    model, weights = TfidfModel.fit_transform(documents, "doc_id", "text")
    again = model.transform(documents, "doc_id", "text")
    assert weights.count() == again.count() and weights.select("doc_id", "term", F.round("value", 9)).exceptAll(
        again.select("doc_id", "term", F.round("value", 9))
    ).count() == 0
    norms = model.transform(documents, "doc_id", "text").groupBy("doc_id").agg(F.sum(F.col("value") ** 2).alias("s"))
    assert norms.filter(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_bag_of_words_lowers_and_skips_single_letters(spark):
    df = spark.createDataFrame([(1, "Aa a AA b_c")], "id int, text string")
    assert values(bag_of_words(df, "id", "text"), "id", "term", "n") == {(1, "aa", 2), (1, "b_c", 1)}


def test_lemmatize(spark, join_mode):
    table = spark.createDataFrame([("cats", "n", "cat"), ("ran", "v", "run")], "token string, cls string, lemma string")
    df = spark.createDataFrame(
        [
            (1, ["cats", "ran", "cats", "xyz"], ["С", "Г", "NNS", "Р"]),
            (2, ["ran"], ["С"]),
            (3, [], []),
            (4, None, None),
        ],
        "id int, t array<string>, g array<string>",
    )
    got = lemmas.lemmatize(df, "id", F.col("t"), table, F.col("g"))
    assert values(got, "id", "lemmatized") == {(1, "cat run cat xyz"), (2, "ran"), (3, ""), (4, None)}
    untagged = lemmas.lemmatize(df, "id", F.col("t"), table)
    assert (1, "cat ran cat xyz") in values(untagged, "id", "lemmatized")


def test_base_forms_in_the_row_equal_the_join(spark, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    table = spark.createDataFrame([(w, c, f"{w}{c}") for w in words[::2] for c in "nv"] + [("w2x", "n", None)], "token string, cls string, lemma string")
    rows = [(i, [*words[i::7], None, "other", "w2x", words[i]], ["С", None, "Г"] * 9, "x") for i in range(40)] + [(98, [], None, "x"), (99, None, [], "x")]
    df = spark.createDataFrame(rows, "id int, t array<string>, g array<string>, lemma string")
    for tags in (F.col("g"), None):
        for forms in (table, table.limit(0)):
            inside = lemmas.lemmatize(df, "id", F.col("t"), forms, tags)
            with monkeypatch.context() as m:
                m.setattr(lemmas, "IN_ROW_BYTES", -1)
                joined = lemmas.lemmatize(df, "id", F.col("t"), forms, tags)
            assert inside.count() == 42 and values(inside, "id", "lemmatized") == values(joined, "id", "lemmatized")
    stems = table.filter("cls = 'n'").select("token", F.col("lemma").alias("stem"))
    got = lemmas.stem(df, "id", F.col("t"), stems)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The table is one value beside the rows: no row carries it, and no token is unfolded.
    assert "_held" not in plan and "Generate" not in plan
    with monkeypatch.context() as m:
        m.setattr(lemmas, "IN_ROW_BYTES", -1)
        assert values(got, "id", "stemmed") == values(lemmas.stem(df, "id", F.col("t"), stems), "id", "stemmed")


def test_final_text_and_stems(spark, join_mode):
    df = spark.createDataFrame([(1, "И <b>Кошки</b>, и 7 собак!"), (2, None)], "id int, text string")
    table = spark.createDataFrame([("кошки", "n", "кошка")], "token string, cls string, lemma string")
    got = lemmas.final_text(df, "id", "text", table, clean.stop_words())
    assert values(got, "id", "final_text") == {(1, "кошка собак"), (2, None)}
    stems = spark.createDataFrame([("кошки", "кошк")], "token string, stem string")
    stemmed = lemmas.stem(df.select("id", clean.clean_words(clean.preprocess(F.col("text"))).alias("t")), "id", F.col("t"), stems)
    assert values(stemmed, "id", "stemmed") == {(1, "и кошк и собак"), (2, None)}


def test_mean_vectors(spark, join_mode):
    vectors = WordVectors.of(
        spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "word string, vector array<double>")
    )
    df = spark.createDataFrame(
        [(1, ["a", "a", "b", "zz"]), (2, ["zz"]), (3, []), (4, None)], "id int, t array<string>"
    )
    rows = {r["id"]: r["vector"] for r in vectors.mean(df, "id", F.col("t")).collect()}
    assert rows[1] == pytest.approx([2 / 3, 1 / 3])
    assert rows[2] == rows[3] == rows[4] == [0.0, 0.0]


def test_trained_vectors_cover_the_vocabulary(documents):
    tokens = documents.select(clean.words(F.col("text")).alias("t"))
    vectors = WordVectors.train(tokens, "t", size=8, partitions=2)
    words = clean.each_token(tokens, "t", name="word").distinct()
    assert vectors.table.select("word").exceptAll(words).count() == 0 and vectors.table.count() == words.count()
    assert vectors.table.filter(F.size("vector") != 8).count() == 0
    means = vectors.mean(documents.withColumn("t", clean.words(F.col("text"))), "doc_id", F.col("t"))
    assert means.count() == documents.count()


def test_naive_bayes_takes_many_classes(spark):
    df = spark.createDataFrame([(i, f"word{i} common", i) for i in range(120)], "id int, text string, label int")
    model = classify.NaiveBayesModel.fit(df, "id", "text", "label")
    got = model.predict(df.filter("id IN (0, 77, 119)"), "id", "text").collect()
    assert len(model.classes) == 120 and all(r["prediction"] == r["id"] for r in got)


def test_naive_bayes_against_plain_python(documents, spark, data, join_mode):
    labelled = documents.join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").select("doc_id", "text", "quality")
    train, test = splits.train_test_split(labelled, "doc_id")
    model = classify.NaiveBayesModel.fit(train, "doc_id", "text", "quality")
    got = {r["doc_id"]: r["prediction"] for r in model.predict(test, "doc_id", "text").collect()}

    counts = {r["doc_id"]: {} for r in labelled.collect()}
    for r in bag_of_words(labelled, "doc_id", "text").collect():
        counts[r["doc_id"]][r["term"]] = r["n"]
    rows = train.collect()
    classes = sorted({r["quality"] for r in rows})
    per_class = {c: Counter() for c in classes}
    for r in rows:
        per_class[r["quality"]].update(counts[r["doc_id"]])
    vocabulary = set().union(*per_class.values())

    def score(c, terms):
        total = sum(per_class[c].values()) + len(vocabulary)
        prior = math.log(sum(r["quality"] == c for r in rows) / len(rows))
        return prior + sum(n * math.log((per_class[c][t] + 1) / total) for t, n in terms.items() if t in vocabulary)

    expected = {
        r["doc_id"]: max(classes, key=lambda c: score(c, counts[r["doc_id"]])) for r in test.collect()
    }
    assert got == expected


def test_naive_bayes_without_known_terms_takes_the_prior(spark):
    train = spark.createDataFrame([(1, "aa", "x"), (2, "bb", "y"), (3, "bb", "y")], "id int, text string, c string")
    test = spark.createDataFrame([(9, "zz"), (8, None), (7, "aa aa aa")], "id int, text string")
    model = classify.NaiveBayesModel.fit(train, "id", "text", "c")
    assert values(model.predict(test, "id", "text"), "id", "prediction") == {(9, "y"), (8, "y"), (7, "x")}


def test_logistic_regression_separates(spark):
    train = spark.createDataFrame([(i, [float(i), 1.0], int(i >= 10)) for i in range(20)], "id int, v array<double>, c int")
    test = spark.createDataFrame([(100, [0.0, 1.0]), (101, [19.0, 1.0])], "id int, v array<double>")
    got = {r["id"]: (r["prediction"], r["probability"]) for r in classify.logistic_regression(train, test, "id", "v", "c").collect()}
    assert got[100][0] == 0 and got[101][0] == 1 and got[100][1] < 0.5 < got[101][1]


@pytest.fixture
def scored(spark):
    rows = [(i % 3 == 0, (i * 37 % 11) / 10, i % 2) for i in range(50)]
    return spark.createDataFrame([(int(a), s, p) for a, s, p in rows], "label int, score double, prediction int")


def test_report(scored):
    rows = [tuple(r) for r in scored.collect()]
    report = {r["cls"]: r for r in metrics.class_report(scored, "label", "prediction").collect()}
    for c in (0, 1):
        tp = sum(a == c and p == c for a, _, p in rows)
        assert report[str(c)]["precision"] == pytest.approx(tp / sum(p == c for *_, p in rows))
        assert report[str(c)]["recall"] == pytest.approx(tp / sum(a == c for a, *_ in rows))
    assert report["accuracy"]["f1"] == pytest.approx(sum(a == p for a, _, p in rows) / 50)
    assert report["weighted avg"]["support"] == 50
    matrix = {(r["label"], r["prediction"]): r["n"] for r in metrics.confusion_matrix(scored, "label", "prediction").collect()}
    assert sum(matrix.values()) == 50


def test_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "b")], "label string, prediction string")
    report = {r["cls"]: tuple(r)[1:] for r in metrics.class_report(df, "label", "prediction").collect()}
    assert report["a"] == (0.0, 0.0, 0.0, 1) and report["b"] == (0.5, 1.0, pytest.approx(2 / 3), 1)


def test_auc_counts_pairs(scored):
    rows = [tuple(r) for r in scored.collect()]
    pairs = [(s, t) for a, s, _ in rows if a for b, t, _ in rows if not b]
    expected = sum(1.0 if s > t else 0.5 if s == t else 0.0 for s, t in pairs) / len(pairs)
    assert metrics.roc_auc(scored, "label", "score").first()["auc"] == pytest.approx(expected)


def test_curve_over_several_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 7 == 0).cast("int").alias("label"), (F.col("id") * 31 % 4999 / 4999).alias("score"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        points = metrics.running_counts(df, "label", "score")
        rows = sorted(points.collect(), key=lambda r: -r["score"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    tp = fp = 0
    for row in rows:
        tp, fp = tp + row["pos"], fp + row["neg"]
        assert (row["tp"], row["fp"]) == (tp, fp)
    curve = metrics.roc_curve(df, "label", "score").orderBy(F.desc("threshold")).collect()
    assert tuple(curve[0])[1:] == (0.0, 0.0) and tuple(curve[-1])[1:] == (1.0, 1.0)


def test_final_queries_work_on_the_final_text(spark, data):
    from webtext.plans.registry import QUERIES

    words = {w for r in QUERIES["final_text"](spark, data).collect() for w in (r.final_text or "").split()}
    cleaned = {r.term for r in QUERIES["bow_counts"](spark, data).collect()}
    terms = {r.term for r in QUERIES["final_bow_counts"](spark, data).collect()}
    assert terms <= words and cleaned - words and not terms & (cleaned - words)
