"""Hashed features: token n-gram and character k-gram shingles, folded to a
fixed bit width with an md5 prefix (reproducible in SQL:
``('0x' || substr(md5(s), 1, 8))::UBIGINT % nbits``). Arrow functions over the
keys: each distinct shingle of a text is hashed once."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Character shingles whose bits a batch keeps.
KEPT_SHINGLES = 100_000


def md5_bit(s: str, nbits: int) -> int:
    """First 32 bits of md5(s), as an unsigned integer, modulo ``nbits``."""
    return int.from_bytes(md5(s.encode()).digest()[:4], "big") % nbits


def word_shingles(key: str, min_n: int, max_n: int) -> set[str]:
    """All runs of min_n..max_n consecutive words (single-space separated, empty ones left
    out), joined by one space."""
    words = [w for w in key.split(" ") if w]
    out: set[str] = set()
    for n in range(min_n, max_n + 1):
        out.update(words if n == 1 else map(" ".join, zip(*[words[i:] for i in range(n)])))
    return out


def char_shingles(key: str, min_k: int, max_k: int) -> set[str]:
    """All runs of min_k..max_k consecutive characters; an empty key has one empty character."""
    if not key:
        return {""} if min_k <= 1 <= max_k else set()
    return {key[i:i + k] for k in range(min_k, max_k + 1) for i in range(len(key) - k + 1)}


def int_lists(keys: pa.Array, of: Callable[[str], Iterable[int]]) -> pa.Array:
    """array<int> of each key; null keys give null."""
    lists = [None if k is None else np.fromiter(of(k), np.int32) for k in keys.to_pylist()]
    ends = np.cumsum([0] + [0 if x is None else len(x) for x in lists]).astype(np.int32)
    some = [x for x in lists if x is not None]
    flat = np.concatenate(some) if some else np.zeros(0, np.int32)
    nulls = pa.array([x is None for x in lists], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat), mask=nulls)


def bitset(key: Column, shingles: Callable[[str], set[str]], nbits: int, kept: int = 0) -> Column:
    """Sorted distinct bit positions of all shingles of a key (a sparse binary vector).
    ``kept`` shingles of a batch stay in a table, which pays where texts share most of theirs."""

    def bits(keys: pa.Array) -> pa.Array:
        known: dict[str, int] = {}

        def hashed(text: str) -> np.ndarray:
            digests = b"".join([md5(s.encode()).digest() for s in shingles(text)])
            return np.unique(np.frombuffer(digests, ">u4")[::4] % nbits)

        def looked_up(text: str) -> list[int]:
            found = set()
            for s in shingles(text):
                b = known.get(s)
                if b is None:
                    b = md5_bit(s, nbits)
                    if len(known) < kept:
                        known[s] = b
                found.add(b)
            return sorted(found)

        return int_lists(keys, looked_up if kept else hashed)

    return F.arrow_udf(bits, "array<int>")(key)
