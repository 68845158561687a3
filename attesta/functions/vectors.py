"""Vector, set and bit functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Dot product in double precision; of unit vectors, their cosine."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two sets; 0 if either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(both / (F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - both))


def hash_bits(hex16: Column) -> Column:
    """A 64-bit hash in hex as a signed long."""
    return F.conv(hex16, 16, -10).cast("bigint")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def histogram_mean(counts: Column, top: int = 255) -> Column:
    """Mean bin of a histogram as a share of the top bin; 0 if it is empty."""
    weighted = F.aggregate(F.transform(counts, lambda c, i: c.cast("double") * i), F.lit(0.0), lambda s, x: s + x)
    total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x.cast("double"))
    return F.when(total > 0, weighted / total / top).otherwise(0.0)


def usage_cost(tokens: list[tuple[Column, Column]]) -> Column:
    """Sum of tokens times the price of a million; a missing price is 0."""
    total = F.lit(0.0)
    for n, price in tokens:
        total = total + n / 1e6 * F.coalesce(price, F.lit(0.0))
    return total


def token_estimate(chars: Column, images: Column | None = None) -> Column:
    """A token for every 3.5 characters, one at least, and 1700 for an image."""
    return F.greatest(F.lit(1), F.floor(chars / 3.5)) + 1700 * (images if images is not None else F.lit(0))
