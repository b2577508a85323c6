"""Fixed-size bitmaps of 64-bit keys, for dropping or sparing rows before a shuffle."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.session import materialize


class Flags:
    """Holds all keys (column `key`, long, evenly spread) that were put in, and some others.

    2**(bits - 5) rows of 16 bytes come to the driver and 2**(bits - 3) bytes are broadcast, at
    any number of keys. With very many keys it holds nearly all: right, but of no more use.
    """

    def __init__(self, keys: DataFrame, bits: int = 24):
        self.bits = bits
        place = F.shiftrightunsigned("key", 64 - bits)
        words = keys.select(F.shiftright(place, 5).alias("word"), (place % 32).cast("int").alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("flags"))
        found = words.toArrow()
        flags = np.zeros(1 << (bits - 5), np.uint32)
        flags[found["word"].to_numpy()] = found["flags"].to_numpy()
        self.any = found.num_rows > 0
        self.shared = keys.sparkSession.sparkContext.broadcast(flags)

    def hold(self, keys: np.ndarray) -> np.ndarray:
        place = keys >> np.uint64(64 - self.bits)
        return (self.shared.value[place >> np.uint64(5)] >> (place & np.uint64(31)).astype(np.uint32)) & np.uint32(1) == 1


def without(docs: DataFrame, gone: DataFrame, keys: list[str], most_bits: int = 26) -> DataFrame:
    """The rows of `docs` whose `keys` aren't among those of `gone`; a null key equals a null.

    A bitmap of the keys that go (at most 2**(most_bits - 5) rows, broadcast) lets all rows that
    miss it pass where they are; only the others are dealt out and looked up exactly. So what is
    shuffled are the rows that go and few more, as long as there are fewer keys than bits.
    """
    gone = materialize(gone.select(*keys).distinct(), "gone")
    n = gone.count()
    if not n:
        return docs
    bits = min(most_bits, max(12, n.bit_length() + 3))
    place = F.shiftrightunsigned(F.xxhash64(*keys), 64 - bits)
    word, flags = "flag_word", "flag_bits"
    while {word, flags} & set(docs.columns):
        word, flags = f"{word}_", f"{flags}_"
    words = gone.select(F.shiftright(place, 5).alias(word), (place % 32).cast("int").alias("bit")).groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias(flags))
    words = materialize(words, "flags")
    near = docs.join(F.broadcast(words), F.shiftright(place, 5) == F.col(word), "left")
    near = near.withColumn(flags, F.coalesce(flags, F.lit(0)))
    hit = F.call_function("bit_get", F.col(flags), (place % 32).cast("int")) == 1
    known = gone.select(*(F.col(k).alias(f"gone_{i}") for i, k in enumerate(keys)))
    same = [F.col(k).eqNullSafe(F.col(f"gone_{i}")) for i, k in enumerate(keys)]
    left = near.where(hit).select(*docs.columns)
    return near.where(~hit).select(*docs.columns).union(left.join(known, same, "left_anti").select(*docs.columns))
