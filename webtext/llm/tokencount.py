"""Token counts of the fields or lines of documents by the offsets of one encoding.

A document is encoded once as a whole: its fields one after another with a separator between them.
Byte-level ids have a known length in bytes, so the running sum of the lengths is each token's span.
The spans are joined to the sections by a search in the ordered section starts (an interval join
within the task, without a shuffle). A section is a field or a line; a separator or line end belongs
to the section before it, so every byte has one section. A token over a boundary counts for exactly
one section: that of its first byte (``first``), of its last byte (``last``), or the one that holds
most of its bytes, the earlier one in a tie (``most``). The counts add up to the document's tokens.

Defined results: null fields are empty; a document has at least one section; a line end at the end
opens no further section; equal rows are counted each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webtext.llm.encode import encoder
from webtext.llm.rows import slices, texts_of

RULES = ("first", "last", "most")
COUNTS = "doc_id bigint, section int, start bigint, end bigint, n_tokens bigint"

_sizes: dict[str, np.ndarray] = {}


def _token_bytes(file: str) -> np.ndarray:
    """Bytes of each id; in a byte-level vocabulary a token's text has one character per byte, but an added token is plain."""
    if file not in _sizes:
        vocabulary = encoder(file).whole.get_vocab()
        sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        sizes[list(vocabulary.values())] = [len(token) for token in vocabulary]
        for i, token in encoder(file).whole.get_added_tokens_decoder().items():
            sizes[i] = len(token.content.encode())
        _sizes[file] = sizes
    return _sizes[file]


def assign(token_ends: np.ndarray, section_starts: np.ndarray, rule: str) -> np.ndarray:
    """Section number of each token; tokens and sections follow one another without gaps from 0."""
    token_starts = np.concatenate(([0], token_ends[:-1]))
    first = np.searchsorted(section_starts, token_starts, side="right") - 1
    if rule == "first":
        return first
    last = np.searchsorted(section_starts, token_ends - 1, side="right") - 1
    if rule == "last":
        return last
    best = first.copy()
    bounds = np.append(section_starts, np.iinfo(np.int64).max)
    for i in np.flatnonzero(first != last):
        inside = np.arange(first[i], last[i] + 1)
        held = np.minimum(bounds[inside + 1], token_ends[i]) - np.maximum(bounds[inside], token_starts[i])
        best[i] = inside[held.argmax()]
    return best


def count_tokens(
    docs: DataFrame, file: str, fields: tuple[str, ...] = ("text",), by: str = "line", rule: str = "first", key: str = "doc_id", separator: str = "\n"
) -> DataFrame:
    """``(doc_id, section, start, end, n_tokens)``; start and end are code points of the joined fields.

    ``by`` is ``field`` or ``line``.
    """
    if rule not in RULES or by not in ("field", "line"):
        raise ValueError(f"rule must be one of {RULES}, by must be field or line")
    schema = pa.schema([("doc_id", pa.int64()), ("section", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("n_tokens", pa.int64())])
    gap = len(separator.encode())
    values = [F.coalesce(F.col(field).cast("string"), F.lit("")) for field in fields]
    sizes = F.array(*[F.octet_length(value).cast("bigint") for value in values])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, token_bytes = encoder(file), _token_bytes(file)
        for part in slices(batches, "text"):
            texts = texts_of(part)
            data = "".join(texts).encode("utf-8", "surrogatepass")
            raw = np.frombuffer(data, np.uint8)
            lengths = np.fromiter((len(t.encode("utf-8", "surrogatepass")) for t in texts), np.int64, len(texts))
            doc_ends = np.cumsum(lengths)
            doc_starts = doc_ends - lengths
            if by == "line":
                after = np.flatnonzero(raw == 10) + 1
                inner = after[~np.isin(after, doc_ends)]
                starts = np.concatenate((doc_starts, inner))
                owner = np.concatenate((np.arange(len(texts)), np.searchsorted(doc_ends, inner, side="right")))
            else:
                widths = np.array(part.column("sizes").to_pylist(), np.int64).reshape(len(texts), -1) + gap
                starts = (doc_starts[:, None] + np.cumsum(widths, axis=1) - widths).ravel()
                owner = np.repeat(np.arange(len(texts)), len(fields))
            order = np.lexsort((starts, owner))
            starts, owner = starts[order], owner[order]
            ids, _ = encode.encode(texts)
            token_ends = np.cumsum(token_bytes[ids])
            if len(ids) and token_ends[-1] != len(raw):
                raise ValueError(f"{file} is not a byte-level vocabulary")
            counts = np.bincount(assign(token_ends, starts, rule), minlength=len(starts)) if len(ids) else np.zeros(len(starts), np.int64)
            points = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
            ends = np.where(np.append(owner[1:], -1) == owner, np.append(starts[1:], 0), doc_ends[owner])
            base = points[doc_starts[owner]]
            begins = np.searchsorted(owner, owner, side="left")
            columns = [
                part.column("doc_id").take(pa.array(owner)),
                pa.array((np.arange(len(owner)) - begins).astype(np.int32)),
                pa.array(points[starts] - base),
                pa.array(points[ends] - base),
                pa.array(counts.astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    chosen = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.concat_ws(separator, *values).alias("text"), sizes.alias("sizes"))
    return chosen.mapInArrow(count, COUNTS)
