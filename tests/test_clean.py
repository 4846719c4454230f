import re
import string

import pytest
from pyspark.sql import functions as F

from webtext.functions import clean

CASES = [
    ("  <b>Hello</b>, World!  ", "hello world"),
    ("a[12]b", "a b"),
    ("« Цена: 100 руб. »", " цена руб "),
    ("x_y-z", "x y z"),
    ("7 дней", " дней"),
    ("<a\nb>c", "a b c"),
    ("naïve ½ café—bar", "naïve ½ cafébar"),
    ("<p>один</p><p>два</p>", "одиндва"),
    ("", ""),
    (None, None),
]


def plain_python(text):
    """The cleaning rule in plain Python, written from its description."""
    text = re.sub("<[^\n]*?>", "", text.lower().strip())
    text = "".join(" " if c in string.punctuation else c for c in text)
    text = " ".join(re.split(r"\s+", text)).strip()
    text = "".join(c for c in text if c.isalnum() or c.isspace())
    text = "".join(" " if c.isdecimal() else c for c in text)
    return re.sub(r"\s+", " ", text)


@pytest.mark.parametrize("text, expected", CASES)
def test_preprocess(spark, text, expected):
    df = spark.createDataFrame([(text,)], "text string")
    assert df.select(clean.preprocess(F.col("text"))).first()[0] == expected


def test_steps_end_in_preprocess(spark, documents):
    last = clean.cleaning_steps(F.col("text"))[-1]
    assert documents.filter(~last.eqNullSafe(clean.preprocess(F.col("text")))).count() == 0


def test_documents_against_plain_python(documents):
    rows = documents.select("text", clean.preprocess(F.col("text")).alias("c")).collect()
    assert [r["c"] for r in rows] == [plain_python(r["text"]) for r in rows]


def test_every_code_point_step_by_step(spark):
    """Folded and stepwise cleaning agree on each character in four positions."""
    points = spark.range(1, 0x20000).filter("id < 55296 OR id > 57343")
    c = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    for text in (c, F.concat(F.lit("a "), c, F.lit(" b")), F.concat(c, F.lit("a7b"), c), F.concat(F.lit("!« "), c, F.lit(" » ."))):
        df = points.select(text.alias("t"))
        last = clean.cleaning_steps(F.col("t"))[-1]
        assert df.filter(~last.eqNullSafe(clean.preprocess(F.col("t")))).count() == 0


def test_reference_marks(spark):
    df = spark.createDataFrame([("a[12]b[]c[x]",)], "t string")
    assert df.select(clean.strip_reference_marks(F.col("t"))).first()[0] == "a b c[x]"


def test_words_and_counts_match_python(spark):
    texts = ["", "  ", "a b", " a b\x1cc\x85d e ", "один  два", "😀 x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", clean.word_count(F.col("t")).alias("w"), clean.char_count(F.col("t")).alias("n")).collect()
    assert [(r["w"], r["n"]) for r in rows] == [(len(t.split()), len(t)) for t in texts]


def test_counts_of_null_are_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert tuple(df.select(clean.word_count(F.col("t")), clean.char_count(F.col("t"))).first()) == (None, None)


def test_stop_words(spark):
    df = spark.createDataFrame([("и это не кот  и пёс",)], "t string")
    assert len(clean.stop_words()) > 100
    assert df.select(clean.remove_stop_words(F.col("t"), clean.stop_words())).first()[0] == "это кот пёс"
    assert df.select(clean.remove_stop_words(F.col("t"), [])).first()[0] == "и это не кот и пёс"


def test_word_class(spark):
    tags = ["П", "ПРИЛ", "Г", "С", "Р", "NN", "", None]
    df = spark.createDataFrame([(t,) for t in tags], "t string")
    assert [r[0] for r in df.select(clean.word_class(F.col("t"))).collect()] == list("aavnrnnn")


def test_cleaning_stays_in_the_jvm(documents):
    plan = documents.select(clean.preprocess(F.col("text")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "*(1) Project" in plan
