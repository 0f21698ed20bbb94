"""Byte-level BPE encoding of text columns (problem 6).

Each pre-token is merged with a segment tree over its byte positions. A leaf holds
the rank of the pair that starts at that byte (or "none"), an inner node the
leftmost smallest leaf below it. The root names the next merge; carrying it out
rewrites three leaves: the merged position, its dead right neighbour and its live
left neighbour. So a pre-token of n bytes takes O(n log n), which matters for the
runs of thousands of signs that web text contains.

Results: null and empty texts give an empty list. Text is taken as it is, with no
normalisation and no special tokens.
"""

from __future__ import annotations

import base64
import importlib
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

#: Folder of the vocabulary files; a parameter of every public function here.
VOCABULARIES = "/opt/tokenizers"
#: Pre-tokens kept per Python worker; the memo is emptied when it is full.
MEMO = 200_000
NONE = 1 << 62


def split_pattern(vocabularies: str = VOCABULARIES) -> str:
    """The pre-tokeniser's pattern, which is published beside the vocabularies."""
    spec = importlib.util.spec_from_file_location("_vocabularies", os.path.join(vocabularies, "__init__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module.PATTERN


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    """Encodes texts with one vocabulary; one object per Python worker."""

    def __init__(self, name: str, vocabularies: str = VOCABULARIES):
        import regex

        self.ranks = load_ranks(os.path.join(vocabularies, f"{name}.tiktoken"))
        self.single = [self.ranks[bytes([b])] for b in range(256)]
        self.pieces = regex.compile(split_pattern(vocabularies)).findall
        self.memo: dict[str, list[int]] = {}

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        n = len(data)
        if n < 2:
            return [self.single[b] for b in data]
        ranks, width = self.ranks, 1 << (n - 1).bit_length()
        end = list(range(1, n + 1))  # end[i]: end of the live token that starts at i
        before = list(range(-1, n - 1))
        tree = [NONE] * (2 * width)
        get = ranks.get
        for i in range(n - 1):
            rank = get(data[i : i + 2])
            if rank is not None:
                tree[width + i] = (rank << 32) | i  # the smallest key is the leftmost smallest rank
        for k in range(width - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b

        def put(at: int, key: int) -> None:
            k = width + at
            if tree[k] == key:
                return
            tree[k] = key
            while k > 1:
                other = tree[k ^ 1]
                least = key if key < other else other
                k >>= 1
                if tree[k] == least:
                    return
                tree[k] = key = least

        def pair(at: int) -> int:
            mid = end[at]
            if mid >= n:
                return NONE
            rank = get(data[at : end[mid]])
            return NONE if rank is None else (rank << 32) | at

        while (top := tree[1]) != NONE:
            i = top & 0xFFFFFFFF
            dead = end[i]
            end[i] = end[dead]
            put(dead, NONE)
            if end[i] < n:
                before[end[i]] = i
            put(i, pair(i))
            if (left := before[i]) >= 0:
                put(left, pair(left))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return out

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        memo, out = self.memo, []
        for piece in self.pieces(text):
            ids = memo.get(piece)
            if ids is None:
                ids = self.merge(piece.encode("utf-8", "replace"))
                if len(piece) <= 64:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[piece] = ids
            out += ids
        return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(name: str, vocabularies: str) -> Encoder:
    """The worker's encoder: loaded once, kept while the worker is reused."""
    key = (name, vocabularies)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(name, vocabularies)
    return _ENCODERS[key]


def token_ids(text: Column, name: str = "byte_bpe_50k", vocabularies: str = VOCABULARIES) -> Column:
    """ARRAY<INT> of ids; null and '' give an empty array."""

    @F.pandas_udf(ArrayType(IntegerType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(name, vocabularies)
        for s in batches:
            yield pd.Series([enc.encode(t) for t in s], dtype=object)

    return run(text)


def token_count(text: Column, name: str = "byte_bpe_50k", vocabularies: str = VOCABULARIES) -> Column:
    """Number of ids; only the number leaves the worker. Null and '' give 0."""

    @F.pandas_udf(IntegerType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(name, vocabularies)
        for s in batches:
            yield pd.Series([len(enc.encode(t)) for t in s], dtype="int32")

    return run(text)
