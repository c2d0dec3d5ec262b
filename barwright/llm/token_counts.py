"""Token counts with a byte-level BPE vocabulary, whole-token pre-tokens being counted without merging."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, table

#: Chunks whose counts a task keeps, and their length at most; it starts anew beyond that number.
MEMO, MEMO_LENGTH = 400_000, 48
#: Characters on whose class regular-expression libraries differ; text with one of them goes to the library.
DOUBTFUL = frozenset("\x1c\x1d\x1e\x1f\x85᠎​﻿")


def whole_tokens(vocabulary: str) -> frozenset[str]:
    """Strings of the vocabulary (the tokenizer's JSON) that, encoded alone, give one token.

    Proven by encoding each one, so an entry that its own merges cannot reach is left out.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(vocabulary)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    texts = tokenizer.decode_batch([[i] for i in sorted(tokenizer.get_vocab().values())], skip_special_tokens=False)
    texts = [t for t in texts if t and "�" not in t and t not in special]
    return frozenset(t for t, e in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False), strict=True) if len(e.ids) == 1)


class TokenCounter:
    """Counts the tokens of texts as the library does.

    A text is cut before every single blank that stands between two visible characters: no pre-token spans such a place, so the
    counts of the chunks add up. A chunk is split by the vocabulary's pattern; a pre-token in the whole-token set counts one, the
    rest is merged by the library. A text with a special token's string goes to the library as it is.
    """

    def __init__(self, vocabulary: str, whole: frozenset[str], pattern: str, memo: int = MEMO):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole, self.split, self.limit = whole, regex.compile(pattern).findall, memo
        self.memo: dict[str, int] = {}

    def merged(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def chunk(self, text: str) -> int:
        if not DOUBTFUL.isdisjoint(text):
            return self.merged(text)
        return sum(1 if p in self.whole else self.merged(p) for p in self.split(text))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if any(s in text for s in self.special):
            return self.merged(text)
        if len(self.memo) > self.limit:
            self.memo.clear()
        memo, total = self.memo, 0
        parts = text.split(" ")
        held = parts[0]
        for part in parts[1:]:
            if part and held and not part[0].isspace() and not held[-1].isspace():
                n = memo.get(held)
                if n is None:
                    n = self.chunk(held)
                    if len(held) <= MEMO_LENGTH:
                        memo[held] = n
                total += n
                held = " " + part
            else:
                held += " " + part
        return total + (self.chunk(held) if held else 0)


def token_counts(docs: DataFrame, vocabulary: str, pattern: str, limit: int, text: str = "text") -> DataFrame:
    """Adds n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of the whole text; a null text counts as empty.

    vocabulary: the tokenizer's JSON itself, so that executors need no file. Nothing is shuffled: every row, repeated or not, is counted by
    itself, and an empty table stays empty. Columns of docs with these names are replaced, all others stay.
    """
    shared = bounded_batches(docs.sparkSession).sparkContext.broadcast((vocabulary, whole_tokens(vocabulary)))  # bounded by the vocabulary

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = TokenCounter(*shared.value, pattern)
        for batch in batches:
            yield pd.Series(np.fromiter(map(counter.count, batch), np.int64, len(batch)))

    out = docs.withColumn("n_bytes", F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long")).withColumn("n_tokens", n_tokens(F.col(text)))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text, and whether it is over 1024 tokens."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        vocabulary = f.read()
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts(docs, vocabulary, public_tokenizers.PATTERN, 1024).select("doc_id", "n_bytes", "n_tokens", "over_limit")
