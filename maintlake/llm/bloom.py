"""Bloom filters of bounded size, built by aggregation and probed by column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from maintlake.llm.shared import saved


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    number: int
    #: One row, one column: the filter as array<long>.
    words: DataFrame

    def lets_through(self, key: Column) -> Column:
        return self.passes(places(key, self.bits, self.hashes, self.number))

    def passes(self, places: list[Column]) -> Column:
        words = self.words.scalar()
        passed = F.lit(True)
        for place in places:
            word = F.element_at(words, (F.shiftright(place, 6) + 1).cast("int"))
            passed = passed & (F.call_function("getbit", word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return passed


def places(key: Column, bits: int, hashes: int, number: int) -> list[Column]:
    """Bit numbers of a key in a level; each level hashes anew, so that what one lets through is spread by the next."""
    return spread_bits(*key_hashes(key, number), bits, hashes)


def key_hashes(key: Column, number: int) -> tuple[Column, Column]:
    """The two hashes of a key from which its bits in a level follow."""
    return F.xxhash64(F.lit(2 * number), key), F.xxhash64(F.lit(2 * number + 1), key)


def spread_bits(a: Column, b: Column, bits: int, hashes: int) -> list[Column]:
    first, second = F.pmod(a, F.lit(bits)), F.pmod(b, F.lit(bits))
    return [F.pmod(first + second * i, F.lit(bits)) for i in range(hashes)]


def build_level(keys: DataFrame, n: int, number: int, bits_per_key: float, min_words: int = 1) -> Level:
    """A filter of ``n`` keys (column key), at ``bits_per_key`` bits each."""
    n_words = max(min_words, math.ceil(n * bits_per_key / 64))
    bits, hashes = n_words * 64, max(1, round(bits_per_key * math.log(2)))
    place = keys.select(F.explode(F.array(*places(F.col("key"), bits, hashes, number))).alias("place"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    words = place.groupBy(F.shiftright("place", 6).alias("id")).agg(F.bit_or(bit).alias("w"))
    ids = keys.sparkSession.range(n_words)
    dense = ids.join(words, "id", "left").select("id", F.coalesce("w", F.lit(0).cast("long")).alias("w"))
    row = dense.agg(F.sort_array(F.collect_list(F.struct("id", "w"))).alias("all")).select(F.col("all.w").alias("words"))
    return Level(bits, hashes, number, saved(row))


def possible(keys: DataFrame, max_bytes: int = 4 << 20, bits_per_key: float = 8.0) -> Level | None:
    """A filter to thin out rows before they are shuffled to a join with ``keys`` (saved; column key, one row a key).

    Of at most ``max_bytes``, whatever the number of keys; None if so many keys would leave it without effect. What it
    lets through still has to be joined: it never decides by itself.
    """
    n = keys.count()
    bits = min(bits_per_key, max_bytes * 8 / max(n, 1))
    return build_level(keys, n, 0, bits) if bits >= 1.5 else None


def thinned(df: DataFrame, key: Column, level: Level | None) -> DataFrame:
    return df if level is None else df.filter(level.lets_through(key))
