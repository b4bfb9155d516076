"""Token counts: batches balanced by bytes, encoded inside Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldheat.llm.common import arrow_map, text_bytes
from fieldheat.llm.word_encoder import encoder


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes and tokens of every text, by a tokenizers file.

    Returns the id, `n_bytes` (UTF-8) and `n_tokens`, one row per row of `docs`, without begin, end or added special
    tokens. Nulls count as empty texts, with 0 bytes and 0 tokens; a null id stays null; repeated rows are counted
    each; other columns are not read. Long texts are cut before white space, where no token can cross.
    There is no shuffle: a row never leaves the task that reads it.
    """

    def counts(stream: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        known = encoder(tokenizer)
        for batch in stream:
            texts = batch.column(1).to_pylist()
            tokens = [0] * len(texts)
            for number, ids in known.pieces(texts):
                tokens[number] += len(ids) // 4
            yield {
                "id": batch.column(0),
                "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
                "n_tokens": pa.array(tokens, pa.int64()),
            }

    picked = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    return arrow_map(picked, counts, f"id {kind}, n_bytes long, n_tokens long").withColumnRenamed("id", id_col)
