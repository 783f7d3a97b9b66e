"""Sizes of texts in tokens of a public tokenizer, counted in Arrow batches."""

from __future__ import annotations

import base64
from functools import lru_cache

from pyspark.sql import DataFrame

#: Vocabulary file (ranks of a byte-level BPE); a parameter everywhere, never copied.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how that vocabulary's texts are cut into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoding(ranks: str):
    """The tokenizer of a rank file, loaded once in each Python worker."""
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def token_counts(docs: DataFrame, keep: list[str], text: str = "text", ranks: str = RANKS) -> DataFrame:
    """``keep`` columns and ``n_tokens`` of each row; null texts have 0 tokens."""
    slim = docs.select(*keep, text)
    schema = slim.drop(text).schema.add("n_tokens", "long")

    def count(it):
        import pyarrow as pa

        enc = encoding(ranks)
        for batch in it:
            n = [0 if (s := v.as_py()) is None else len(enc.encode_ordinary(s)) for v in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(n, pa.int64())], [*keep, "n_tokens"])

    return slim.mapInArrow(count, schema)
