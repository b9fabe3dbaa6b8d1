"""Hash expressions that give the same number in Spark and in other SQL engines."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_int(value: Column, hex_digits: int = 8) -> Column:
    """The first ``hex_digits`` of the MD5 of a string as BIGINT (8 digits = 32 bits, 15 = 60)."""
    if not 1 <= hex_digits <= 15:
        raise ValueError("hex_digits must be between 1 and 15 to fit a BIGINT")
    prefix = F.substring(F.md5(value), 1, hex_digits)
    return F.conv(prefix, 16, 10).cast("bigint")


def set_digest(value: Column) -> list[Column]:
    """Aggregates that identify a set of distinct values without collecting it.

    Every part merges map-side, so a group of any size costs one small row per task. Two sets
    are taken as equal when size, smallest value and two independent 64-bit XOR digests agree.
    """
    return [
        F.count(F.lit(1)).alias("n"),
        F.min(value).alias("first_member"),
        F.bit_xor(F.xxhash64(value)).alias("digest_a"),
        F.bit_xor(F.xxhash64(F.lit("second"), value)).alias("digest_b"),
    ]


DIGEST_COLUMNS = ["n", "first_member", "digest_a", "digest_b"]
