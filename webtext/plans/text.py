"""Queries that profile, clean and lemmatize the documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from webtext.functions import clean, stopwords
from webtext.operators import blocks, lemmas, profile
from webtext.plans import sql
from webtext.session import materialise
from webtext.sources import collections as store

# The part-of-speech tags of the class table.
TAGS = ("С", "Г", "NNS", "Р", "П")


def _documents(spark, folder):
    return store.scan(spark, folder, "documents").select("doc_id", "text")


def _frame(spark, folder):
    """Counts with the class where there is one; only numbers are joined, never the text."""
    counted = _documents(spark, folder).select(
        "doc_id",
        clean.word_count(F.col("text")).alias("word_count"),
        clean.char_count(F.col("text")).alias("char_count"),
    )
    labels = store.table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("target"))
    return counted.join(labels, "doc_id", "left")


def _cleaned(spark, folder):
    return _documents(spark, folder).select("doc_id", clean.preprocess(F.col("text")).alias("clean_text"))


def _split(cleaned):
    return cleaned.select("doc_id", clean.clean_words(F.col("clean_text")).alias("tokens"))


def _tokens(spark, folder):
    return _split(_cleaned(spark, folder))


def clean_steps(spark, folder):
    steps = _documents(spark, folder).select("doc_id", *clean.cleaning_steps(F.col("text")))
    return steps.select("doc_id", *[F.md5(name).alias(name) for name, _ in clean.STEPS])


def strip_refs(spark, folder):
    return _documents(spark, folder).select("doc_id", clean.strip_reference_marks(F.col("text")).alias("text"))


def stopwords_removed(spark, folder):
    kept = clean.remove_stop_words(F.col("clean_text"), clean.stop_words("english"))
    return _cleaned(spark, folder).select("doc_id", kept.alias("text"))


def _tag(token: Column) -> Column:
    """Made-up but repeatable tags: the test tables hold none."""
    return F.element_at(F.array(*[F.lit(tag) for tag in TAGS]), F.length(token) % len(TAGS) + 1)


def pos_class(spark, folder):
    tagged = clean.each_token(_tokens(spark, folder), "tokens").select(_tag(F.col("token")).alias("tag"))
    return tagged.groupBy("tag", clean.word_class(F.col("tag")).alias("cls")).agg(F.count("*").alias("n"))


def _plurals(rows, tokens):
    """Words of the tokens that lose a final ``s``: a base-form table from the data."""
    words = blocks.counted(rows, tokens, "token").select("token")
    long = (F.length("token") > 3) & (F.length("token") % 2 == 0) & F.endswith("token", F.lit("s"))
    base = F.substr("token", F.lit(1), F.length("token") - 1)
    return words.filter(long).select("token", base.alias("base"))


def lemmatized(spark, folder):
    # Written as text: arrays of words take several times as long to write and to read.
    cleaned = materialise(_cleaned(spark, folder), "clean-text")
    table = _plurals(cleaned, "clean_text").select(
        "token", clean.word_class(_tag(F.col("token"))).alias("cls"), F.col("base").alias("lemma")
    )
    table = materialise(table.filter(F.col("cls") != "v"), "lemmas")
    tokens = _split(cleaned)
    return lemmas.lemmatize(tokens, "doc_id", F.col("tokens"), table, F.transform("tokens", _tag))


def stemmed(spark, folder):
    cleaned = materialise(_cleaned(spark, folder), "clean-text")
    table = materialise(_plurals(cleaned, "clean_text").select("token", F.col("base").alias("stem")), "stems")
    return lemmas.stem(_split(cleaned), "doc_id", F.col("tokens"), table)


def final_text(spark, folder, written=None):
    def table(cleaned):
        found = _plurals(cleaned, "clean_text").select("token", F.lit("n").alias("cls"), F.col("base").alias("lemma"))
        return materialise(found, "lemmas")

    return lemmas.final_text(_documents(spark, folder), "doc_id", "text", table, clean.stop_words("french"), written=written)


def _rounded_mean(spark, folder, value, name):
    return profile.mean_by(_frame(spark, folder), "target", value, "m").select("target", F.round("m", 6).alias(name))


QUERIES = {
    "target_counts": lambda spark, folder: profile.value_counts(_frame(spark, folder).select("target"), "target"),
    "null_counts": lambda spark, folder: profile.null_counts(_frame(spark, folder)),
    "word_count": lambda spark, folder: _documents(spark, folder).select(
        "doc_id", clean.word_count(F.col("text")).alias("word_count")
    ),
    "char_count": lambda spark, folder: _documents(spark, folder).select(
        "doc_id", clean.char_count(F.col("text")).alias("char_count")
    ),
    "word_count_by_target": lambda spark, folder: _rounded_mean(spark, folder, "word_count", "mean_words"),
    "char_count_by_target": lambda spark, folder: _rounded_mean(spark, folder, "char_count", "mean_chars"),
    "word_hist": lambda spark, folder: profile.histogram_by(_frame(spark, folder), "target", "word_count"),
    "clean_steps": clean_steps,
    "strip_refs": strip_refs,
    "clean_text": _cleaned,
    "stopwords_removed": stopwords_removed,
    "tokens": lambda spark, folder: _tokens(spark, folder)
    .select("doc_id", F.posexplode_outer("tokens").alias("pos", "token"))
    .filter(F.col("token").isNotNull()),
    "pos_class": pos_class,
    "lemmatized": lemmatized,
    "stemmed": stemmed,
    "final_text": final_text,
}

_FRAME = f"""frame AS (
  SELECT doc_id, len({sql.words('text')})::int AS word_count, length(text)::int AS char_count, toxic AS target
  FROM documents LEFT JOIN labels USING (doc_id)
)"""
_WORDS = sql.words(sql.clean_text("text"))
_TAG_LIST = ", ".join(sql.quote(tag) for tag in TAGS)
# Word class by tag, as in the class table.
_CLASS = "CASE left({0}, 1) WHEN 'П' THEN 'a' WHEN 'Г' THEN 'v' WHEN 'Р' THEN 'r' ELSE 'n' END"
_TAG = f"([{_TAG_LIST}])[length(x) % {len(TAGS)} + 1]"
_PLURAL = "length(x) > 3 AND length(x) % 2 = 0 AND suffix(x, 's')"


def _stop_list(language: str) -> str:
    return ", ".join(sql.quote(word) for word in stopwords.words(language))


SQL = {
    "target_counts": f"""WITH {_FRAME}
SELECT target, count(*) AS n FROM frame WHERE target IS NOT NULL GROUP BY target""",
    "null_counts": f"WITH {_FRAME} "
    + " UNION ALL ".join(
        f'SELECT \'{name}\' AS "column", count(*) FILTER ({name} IS NULL) AS nulls FROM frame'
        for name in ("doc_id", "word_count", "char_count", "target")
    ),
    "word_count": f"WITH {_FRAME} SELECT doc_id, word_count FROM frame",
    "char_count": f"WITH {_FRAME} SELECT doc_id, char_count FROM frame",
    "word_count_by_target": f"""WITH {_FRAME}
SELECT target, round(avg(word_count), 6) AS mean_words FROM frame WHERE target IS NOT NULL GROUP BY target""",
    "char_count_by_target": f"""WITH {_FRAME}
SELECT target, round(avg(char_count), 6) AS mean_chars FROM frame WHERE target IS NOT NULL GROUP BY target""",
    "word_hist": f"""WITH {_FRAME},
bounds AS (SELECT target, min(word_count) AS lo, max(word_count) AS hi FROM frame WHERE target IS NOT NULL GROUP BY target)
SELECT target, CASE WHEN lo = hi THEN 5
  ELSE least(floor((word_count - lo)::double * 10 / (hi - lo)), 9) END::int AS bin, count(*) AS n
FROM frame JOIN bounds USING (target) GROUP BY ALL""",
    "clean_steps": "SELECT doc_id, "
    + ", ".join(
        f"md5({step}) AS {name}"
        for step, name in zip(
            sql.clean("text"),
            (
                "lower",
                "trimmed",
                "untagged",
                "unpunctuated",
                "single_spaced",
                "word_characters",
                "undigited",
                "cleaned",
            ),
        )
    )
    + " FROM documents",
    "strip_refs": r"SELECT doc_id, regexp_replace(text, '\[[0-9]*\]', ' ', 'g') AS text FROM documents",
    "clean_text": f"SELECT doc_id, {sql.clean_text('text')} AS clean_text FROM documents",
    "stopwords_removed": f"""
SELECT doc_id, array_to_string(list_filter({_WORDS}, lambda x: x NOT IN ({_stop_list('english')})), ' ') AS text
FROM documents""",
    "tokens": f"""
SELECT doc_id, pos::int AS pos, token FROM (
  SELECT doc_id, unnest(t) AS token, unnest(range(len(t))) AS pos FROM (SELECT doc_id, {_WORDS} AS t FROM documents))""",
    "pos_class": f"""
SELECT tag, {_CLASS.format('tag')} AS cls, count(*) AS n
FROM (SELECT {_TAG} AS tag FROM (SELECT unnest({_WORDS}) AS x FROM documents)) GROUP BY ALL""",
    "lemmatized": f"""
SELECT doc_id, array_to_string(list_transform({_WORDS}, lambda x:
  CASE WHEN {_PLURAL} AND {_CLASS.format(_TAG)} <> 'v' THEN x[:-2] ELSE x END), ' ') AS lemmatized FROM documents""",
    "stemmed": f"""
SELECT doc_id, array_to_string(list_transform({_WORDS}, lambda x:
  CASE WHEN {_PLURAL} THEN x[:-2] ELSE x END), ' ') AS stemmed FROM documents""",
    "final_text": f"""
SELECT doc_id, array_to_string(list_transform(
  list_filter({_WORDS}, lambda x: x NOT IN ({_stop_list('french')})),
  lambda x: CASE WHEN {_PLURAL} THEN x[:-2] ELSE x END), ' ') AS final_text FROM documents""",
}
