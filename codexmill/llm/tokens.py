"""Token counts of whole texts with a public byte-level BPE vocabulary."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The vocabulary's published pre-tokenisation pattern (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose counts a Python worker keeps; beyond it the cache starts anew.
CACHE_WORDS = 400_000


def encoder(vocabulary: str = VOCABULARY) -> Callable[[str], list[int]]:
    import tiktoken

    with open(os.path.realpath(vocabulary), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("codexmill", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class WordCodes(dict):
    """Word (with its leading space) to a number made of its token count.

    The pattern never joins across a single space between two other
    characters, so a text's count is the sum over its space-led words. Texts
    with two spaces in a row are encoded whole.
    """

    def __init__(self, encode: Callable[[str], list[int]]) -> None:
        super().__init__()
        self.encode = encode

    def code(self, word: str) -> int:
        return len(self.encode(word))

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        self[word] = v = self.code(word)
        return v

    @staticmethod
    def words(text: str) -> list[str]:
        return text.replace(" ", "\x00 ").split("\x00")


def counter(vocabulary: str = VOCABULARY) -> Callable[[str | None], int]:
    """A function from text to its number of tokens; NULL and '' have none."""
    codes = WordCodes(encoder(vocabulary))

    def count(text: str | None) -> int:
        if not text:
            return 0
        if "  " in text or "\x00" in text:
            return len(codes.encode(text))
        return sum(map(codes.__getitem__, codes.words(text)))

    return count


def counted_texts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) of (doc_id, text)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = counter(vocabulary)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_tokens": [n(t) for t in b["text"]]})

    return docs.select("doc_id", "text").mapInPandas(count, "doc_id bigint, n_tokens bigint")
