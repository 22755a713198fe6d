"""Token counts by heap-and-linked-list byte-pair merging.

Counts the tokens of every whole text without making identifiers (see
`wordbpe.merge_count`).  One narrow pass, no shuffle.

Defined results: a null text counts as empty (0 bytes, 0 tokens); special strings inside
a text count as the one token that the library makes of them; repeated rows are counted
one by one; an empty table gives an empty result; only the id and the text are read.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from playlog.llm import wordbpe
from playlog.llm.common import slices, text_of


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Per row of `docs`: its key, n_bytes, n_tokens and over_limit."""

    def count(batches):
        bpe = wordbpe.load(vocabulary)
        for b in slices(batches):
            texts = b.column(1)
            n = pa.array([bpe.count(t.as_py()) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pc.binary_length(texts).cast(pa.int64()), n,
                 pc.greater(n, limit)], ["key", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(docs[key].alias("key"), text_of(text).alias("text"))
    return rows.mapInArrow(
        count, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean"
    ).withColumnRenamed("key", key)
