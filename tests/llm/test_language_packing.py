"""The language stage decides which documents share a packed sequence."""

from __future__ import annotations

import corpus_pipeline
from webtext.llm import packing

TEXTS = {
    "en": "the house is red and the water is cold when we walk to the river with them " * 6,
    "de": "das haus ist rot und das wasser ist kalt wenn wir mit ihnen zum fluss gehen " * 6,
}


def test_packing_goes_by_the_predicted_language(spark):
    rows = [(i, TEXTS[name], name, "web", 1) for i, name in enumerate(["en", "de"] * 4)]
    # Null or wrong languages: the texts tell.
    rows += [(100, TEXTS["de"], None, "web", 1), (101, TEXTS["en"], "de", "web", 1), (102, "12 345 ---", "en", "web", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labelled = corpus_pipeline.reject_unknown_language(spark, docs, "")
    assert labelled.schema == docs.schema
    named = {row.doc_id: row.lang for row in labelled.collect()}
    assert named == {i: "de" if text == TEXTS["de"] else "en" for i, text, *_ in rows if i != 102}
    of = {}
    for row in corpus_pipeline.pack_sequences(spark, labelled, "").collect():
        of.setdefault(row.sequence_id, set()).add(named[row.doc_id])
    assert sorted(of.values(), key=sorted) == [{"de"}, {"en"}]


def test_a_null_group_is_packed_apart(spark):
    rows = [(1, 0, 3, "a"), (2, 0, 2, None), (3, 0, 2, "a"), (4, 0, 2, None), (5, 0, 4, "b")]
    pieces = spark.createDataFrame(rows, "doc_id bigint, piece int, length bigint, kind string")
    got = packing.pack(pieces, 5, by="kind").collect()
    assert len(got) == 5
    of = {}
    for row in got:
        of.setdefault(row.sequence_id, set()).add((row.kind, row.doc_id))
    assert sorted(sorted(i for _, i in group) for group in of.values()) == [[1, 3], [2, 4], [5]]
