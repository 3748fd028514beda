"""Token counts of texts under a public byte-level tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Pre-tokenisation of the byte-level vocabulary (fixed value).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load(path: str = TOKENIZER):
    """The encoder whose ranks stand in ``path``: a line has a token in base 64 and its rank."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), path: str = TOKENIZER) -> DataFrame:
    """(id, keep..., tokens): 0 for NULL and empty texts. Whole texts are encoded, batch by batch, without a shuffle."""
    names = list(keep)
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    df.sparkSession.sparkContext.addFile(path)  # an executor without the file gets it with the job

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = load(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))
        for b in batches:
            tokens = [len(encoder.encode_ordinary(t)) if t else 0 for t in b["text"]]
            yield b[["id", *names]].assign(tokens=pd.Series(tokens, index=b.index, dtype="int64"))

    lean = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), *[F.col(f"`{c}`") for c in names], F.col(f"`{text_col}`").alias("text"))
    shape = "id bigint, " + "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in names) + "tokens bigint"
    return lean.mapInPandas(count, shape)
