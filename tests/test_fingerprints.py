import hashlib

import numpy as np
from pyspark.sql import functions as F

from curlew.functions import hashing as H
from curlew.operators import features as FE


def bit(s, nbits):
    return int(hashlib.md5(s.encode()).hexdigest()[:8], 16) % nbits


def test_fingerprints_of_odd_keys(spark):
    keys = [None, "", "a", "a b", "a  b a b", "éa😀b éa😀b", " lead", "x" * 5, "1, 2"]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "id long, key string")
    for n in (64, 100):
        words = {r.id: r.bits for r in FE.hashed_fingerprint(df, nbits=n, min_n=1, max_n=3).collect()}
        chars = {r.id: r.bits for r in FE.path_fingerprint(df, nbits=n, min_k=1, max_k=3).collect()}
        for i, k in enumerate(keys):
            if k is None:
                assert words[i] is None and chars[i] is None
                continue
            w, c = [x for x in k.split(" ") if x], list(k) or [""]
            assert words[i] == sorted({bit(" ".join(w[j:j + m]), n) for m in (1, 2, 3) for j in range(len(w) - m + 1)})
            assert chars[i] == sorted({bit("".join(c[j:j + m]), n) for m in (1, 2, 3) for j in range(len(c) - m + 1)})
    keyed = {r.id: r.bits for r in FE.keyed_fingerprint(df).collect()}
    assert keyed[0] is None and keyed[1] == []
    assert keyed[4] == [b for b, c, t in FE.keyed_patterns() if keys[4].count(c) >= t]


def test_shingles_are_hashed_in_python_batches(spark):
    """The bits are one Arrow function of the key: no higher-order functions that an
    executor interprets for each element."""
    df = spark.createDataFrame([("a b c",)], "key string")
    for f in (FE.hashed_fingerprint, FE.path_fingerprint, FE.keyed_fingerprint):
        plan = f(df).select(F.size("bits"))._jdf.queryExecution().executedPlan().toString()
        assert "lambda" not in plan and "ArrowEvalPython" in plan
    assert H.char_shingles("abcd", 3, 4) == {"abc", "bcd", "abcd"}
    assert np.array_equal(sorted(H.word_shingles("a  b", 1, 2)), ["a", "a b", "b"])
