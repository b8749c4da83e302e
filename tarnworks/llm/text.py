"""What several operators share: the word pattern, columns of documents, stable hashes.

White space is always ``[\\x20\\x09-\\x0D]``; ``bytes.split()`` without arguments
splits on exactly these six, and ``bytes.lower()`` lower-cases A-Z only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The six white-space characters and the pattern of a word.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

#: The columns of the documents table, in order.
DOCUMENT = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def document_columns(docs: DataFrame) -> DataFrame:
    """Only the columns of documents, so that others cannot clash with what operators add."""
    return docs.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in DOCUMENT.items()])


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


class WordHashes(dict):
    """64-bit hashes of words, computed once for each word while the mapping lives."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _B
    return x ^ (x >> np.uint64(29))


def shingle_hashes(text: str | None, words: WordHashes, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words, A-Z lower-cased.

    Fewer words make one run of them all; no words or no text make an empty set.
    """
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    runs = max(1, len(h) - width + 1)
    out = np.full(runs, np.uint64(min(width, len(h))), np.uint64)
    for k in range(min(width, len(h))):
        out = _mixed(out * _A + h[k : k + runs] + _C)
    return np.unique(out)


def digest16(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
