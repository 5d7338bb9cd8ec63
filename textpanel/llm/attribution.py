"""Token counts of a document's sections, from one encoding of the whole document.

A section is a run of characters [start, end); by default the lines of a text, each with the line break that ends it.
The document is encoded once, and the spans of its tokens are joined to the sections by interval. A token that crosses
a boundary belongs to the section in which its first character lies; so each token counts once, and a document's
sections add up to its tokens. Spans come from the number of bytes that each token of a byte-level vocabulary stands
for. Spans and sections are both sorted, so that the join is a search per document.

Edge cases: a null or empty text has one empty section and no tokens; a section without a token of its own (a single
character inside a token) counts 0; repeated rows give repeated results; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textpanel.llm.common import small_batches, table
from textpanel.llm.tokens import byte_lengths, memo, token_starts


def lines(text: str) -> list[int]:
    """Where the lines of a text begin."""
    return [0, *[m.end() for m in re.finditer("\n", text) if m.end() < len(text)]]


def attribute(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", sections: Callable[[str], list[int]] = lines) -> DataFrame:
    """Per section: key, section (from 0), section_start, section_end (characters), n_tokens, n_crossing (of those, tokens that reach into the next section)."""
    small_batches(docs.sparkSession)
    src = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lengths = memo(tokenizer, True), byte_lengths(tokenizer)
        for batch in batches:
            out = [[], [], [], [], [], []]
            bodies = [x or "" for x in batch.column(1).to_pylist()]
            for row, (body, ids) in enumerate(zip(bodies, known.encode_all(bodies), strict=True)):
                begin = np.array(sections(body), np.int64)
                stop = np.append(begin[1:], len(body))
                first = token_starts(body, ids, lengths)
                last = np.append(first[1:], len(body)) - 1
                home = np.searchsorted(begin, first, "right") - 1
                counts = np.bincount(home, minlength=len(begin))
                crossing = np.bincount(home[last >= stop[home]], minlength=len(begin)) if len(first) else counts
                for column, values in zip(out, (np.full(len(begin), row), np.arange(len(begin)), begin, stop, counts, crossing), strict=True):
                    column.append(values)
            if out[0]:
                at, *rest = [np.concatenate(x).astype(np.int64) for x in out]
                columns = [batch.column(0).take(pa.array(at)), pa.array(rest[0].astype(np.int32)), *[pa.array(x) for x in rest[1:]]]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "section", "section_start", "section_end", "n_tokens", "n_crossing"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, section int, section_start long, section_end long, n_tokens long, n_crossing long")


def op6_query(spark, sf_dir):
    import public_tokenizers

    return attribute(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
