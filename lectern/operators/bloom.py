"""A Bloom filter of many keys, small enough to reach every task."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The filter is never larger: with more keys more rows pass by chance, about 1 % at 10 million keys.
FILTER_BYTES = 16 * 1024 * 1024
HASHES = 5


def _place(key: Column | str, number: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(number)), F.lit(bits))


def filter_words(keys: DataFrame, bits: int) -> np.ndarray:
    """Words of 64 bits; the tasks combine the bits of a word, the driver gets one number per word in use."""
    key = keys.columns[0]
    places = keys.select(F.explode(F.array(*[_place(key, n, bits) for n in range(HASHES)])).alias("place"))
    one = F.expr("shiftleft(1L, cast(place % 64 as int))")
    words = places.groupBy(F.floor(F.col("place") / 64).alias("word")).agg(F.bit_or(one).alias("mask")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("mask").to_numpy()
    return out


def in_filter(key: str, keys: DataFrame, size: int | None = None) -> Column:
    """True for every row whose ``key`` is among ``keys`` (one column), and by chance for some others. Rows stay in place."""
    bits = 8 * (size or FILTER_BYTES)
    sent = keys.sparkSession.sparkContext.broadcast(filter_words(keys, bits))

    @F.pandas_udf("boolean")
    def found(*places: pd.Series) -> pd.Series:
        words, held = sent.value, None
        for p in places:
            p = p.to_numpy()
            here = (words[p >> 6] >> (p & 63)) & 1 == 1
            held = here if held is None else held & here
        return pd.Series(held)

    return found(*[_place(key, n, bits) for n in range(HASHES)])
