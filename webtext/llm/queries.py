"""The registered queries of the numbered operators: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from webtext.llm import ann, idfile, jaccard, langid, neardup, packing, pieces, ranked, replytrees, secretscan, spelling, tokencount, toxicity
from webtext.llm.rows import table
from webtext.session import fresh_dir, materialise

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def op1_best_fit_packing(spark, folder):
    pieces = packing.cut_documents(table(spark, folder, "documents"), WORD_VOCABULARY, end_id=1, capacity=4096)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(materialise(digests, "piece-digests"), 4096, ("doc_id", "piece", "ids_crc32"))


def op2_toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    held_out = toxicity.remainder("doc_id", 3) == 1
    model = toxicity.fit(docs, labels.filter(~held_out))
    return model.score(docs).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op3_approximate_nearest_neighbours(spark, folder):
    return ann.MultiIndex().search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op4_token_id_output(spark, folder):
    path = fresh_dir(spark, "token-ids")
    idfile.write(table(spark, folder, "documents"), path, BYTE_VOCABULARY, end_id=0)
    return idfile.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op5_language_id(spark, folder):
    docs = table(spark, folder, "documents")
    held_out = toxicity.remainder("doc_id", 4) == 2
    model = langid.fit(docs.filter(~held_out))
    return model.predict(docs).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_embedding_near_dedup(spark, folder):
    return neardup.near_duplicates(table(spark, folder, "embeddings"))


def op7_secret_scans(spark, folder):
    found = secretscan.scan(table(spark, folder, "documents"))
    base = F.filter("spans", lambda span: span["depth"] == 0)

    def number(kind):
        return F.size(F.filter(base, lambda span: span["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [number(kind) for kind in secretscan.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(secretscan.joined(base).cast("binary"), 256).alias("base_sha256"), secretscan.joined(F.col("spans")).alias("spans")
    )


def op8_token_counts(spark, folder):
    return tokencount.count_tokens(table(spark, folder, "documents"), BYTE_VOCABULARY)


def op9_sentencepiece(spark, folder):
    """Digests of each document's ids with merge-dropout and of the text that they decode to."""
    docs = table(spark, folder, "documents")
    decoded = pieces.decode(pieces.encode(docs, PIECE_MODEL), PIECE_MODEL)
    return decoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )


def op10_ngram_jaccard_join(spark, folder):
    return jaccard.join(table(spark, folder, "documents"))


def op11_spelling_variant_grouping(spark, folder):
    return spelling.variants(spelling.vocabulary(table(spark, folder, "documents")))


def op12_ranked_lexical_search(spark, folder):
    return ranked.search(table(spark, folder, "benchmark"), table(spark, folder, "documents"), 50)


#: Fixed value: the conversation that the contract adds to the table.
PLANTED_TEXT = "\\### Assistant: </turn> ok"


def op13_chat_formatting(spark, folder):
    """Digests of the formatted conversations, all of them read back from the formatted text."""
    kept = ("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PLANTED_TEXT).alias("text")
    )
    messages = replytrees.chained(table(spark, folder, "conversations").select(*kept).unionByName(planted))
    template = replytrees.Template()
    formatted = replytrees.Trees(messages).conversations(1, template)
    turns = template.turns(F.col("formatted"))
    said = F.array_join(F.transform(turns, lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n"))), "")
    learned = F.array_join(template.learned_texts(F.col("formatted"), F.col("loss")), "")
    return formatted.select(
        F.col("tree").alias("conv_id"),
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_toxicity": op2_toxicity,
    "op3_approximate_nearest_neighbours": op3_approximate_nearest_neighbours,
    "op4_token_id_output": op4_token_id_output,
    "op5_language_id": op5_language_id,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_secret_scans": op7_secret_scans,
    "op8_token_counts": op8_token_counts,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_ngram_jaccard_join": op10_ngram_jaccard_join,
    "op11_spelling_variant_grouping": op11_spelling_variant_grouping,
    "op12_ranked_lexical_search": op12_ranked_lexical_search,
    "op13_chat_formatting": op13_chat_formatting,
}

_ESCAPED = r"replace(replace(replace({}, '\', '\\'), '### ', '#\## '), '</turn>', '<\/turn>')"

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op11_spelling_variant_grouping": f"""
WITH RECURSIVE bits AS (
  SELECT i, 0 AS step, i::bigint AS c FROM range(256) AS r(i)
  UNION ALL SELECT i, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE step < 8
),
crc AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE step = 8),
runs AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS c FROM runs GROUP BY doc_id, run),
bytes AS (
  SELECT doc_id, run, c, hex(encode(coalesce(doc_id::varchar, '') || ':' || run)) AS x FROM counted
),
hashed AS (
  SELECT run, c, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(len(x) // 2), lambda j: ('0x' || substr(x, 2 * j + 1, 2))::bigint)),
    lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h FROM bytes, crc
),
changed AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
words AS (SELECT word, sum(c)::bigint AS n FROM changed WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
rests AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) AS r(i)),
pairs AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM rests a JOIN rests b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM rests a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM rests a JOIN words b ON a.rest = b.word
),
grouped AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, near)) AS form, max(near_n) AS form_n FROM pairs GROUP BY word),
found AS (
  SELECT word, n, coalesce(n_near, 0)::bigint AS n_near, CASE WHEN form_n >= 2 * n THEN form END AS form, CASE WHEN form_n >= 2 * n THEN form_n END AS form_n
  FROM words LEFT JOIN grouped USING (word)
),
chain AS (
  SELECT word, form AS root, 1 AS step FROM found WHERE form IS NOT NULL
  UNION ALL SELECT chain.word, found.form, step + 1 FROM chain JOIN found ON found.word = chain.root WHERE found.form IS NOT NULL
),
ends AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM found LEFT JOIN ends USING (word)""",
    "op12_ranked_lexical_search": f"""
WITH docs AS (SELECT doc_id, {_TERMS} AS t FROM documents),
corpus AS (SELECT count(*)::bigint AS n, sum(len(t))::bigint AS l FROM docs WHERE len(t) > 0),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS (
  SELECT doc_id, term, count(*)::bigint AS tf, any_value(dl)::bigint AS dl FROM (SELECT doc_id, len(t) AS dl, unnest(t) AS term FROM docs)
  WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1)))::bigint AS w FROM tf, corpus GROUP BY term),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * dl * n) // l))))::bigint AS score
  FROM asked JOIN tf USING (term) JOIN weights USING (term), corpus GROUP BY item_id, doc_id
),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::int AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 50""",
    "op13_chat_formatting": rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::bigint AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || replace({_ESCAPED.format('role')}, ': ', ':\ ') || ': ' || {_ESCAPED.format('text')} || '</turn>' || chr(10)))::bigint AS formatted_chars
FROM rows GROUP BY conv_id""",
}
