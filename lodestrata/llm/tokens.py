"""Text sizes in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Where the vocabulary lies; a parameter of every operator that counts tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary's tokenizer cuts text before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
#: Texts are encoded in blocks cut at a blank after this many characters, as a run without blanks costs quadratic time.
BLOCK = 100_000


@lru_cache(2)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def blocks(text: str):
    """The text in blocks that end before a blank, or after BLOCK characters without one."""
    start = 0
    while len(text) - start > BLOCK:
        end = text.rfind(" ", start + BLOCK // 2, start + BLOCK)
        end = end if end > start else start + BLOCK
        yield text[start:end]
        start = end
    yield text[start:]


def count_tokens(text: str, path: str = VOCABULARY) -> int:
    return sum(len(encoder(path).encode_ordinary(b)) for b in blocks(text))


def token_count(path: str = VOCABULARY):
    """A column function: the tokens of a text, 0 for null."""

    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([count_tokens(t, path) if t else 0 for t in texts], dtype="int64")

    return F.pandas_udf(count, T.LongType())
