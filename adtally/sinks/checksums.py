"""One checksum for a file that was written in parts, whatever the parts.

CRC-32 is linear: the value of a joined file is the XOR of its parts' values, each moved over the bytes that follow it.
Moving by one zero byte is a 32 x 32 matrix over GF(2), by 2^k bytes its k-th square, so a move by any length takes at most
63 matrix products, in built-in expressions on one row per part.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from adtally.operators.ranges import running_before

# Fixed value: the CRC-32 polynomial, lowest power in the highest bit.
POLYNOMIAL = 0xEDB88320
BITS, LENGTH_BITS = 32, 63


def _product(matrix: Sequence[int], vector: int) -> int:
    out = 0
    for column in matrix:
        out ^= column if vector & 1 else 0
        vector >>= 1
    return out


@cache
def zero_byte_matrices() -> list[list[int]]:
    """Matrices, as lists of columns, that move a CRC over 1, 2, 4, ... zero bytes."""
    one = []
    for j in range(BITS):
        value = 1 << j
        for _ in range(8):
            value = (value >> 1) ^ (POLYNOMIAL if value & 1 else 0)
        one.append(value)
    out = [one]
    while len(out) < LENGTH_BITS:
        out.append([_product(out[-1], column) for column in out[-1]])
    return out


def moved_crc32(crc: Column, n_bytes: Column) -> Column:
    """The CRC's contribution to a file in which ``n_bytes`` more bytes follow."""
    matrices = F.array(*[F.array(*[F.lit(c).cast("long") for c in m]) for m in zero_byte_matrices()])
    long = lambda k: F.lit(k).cast("long")

    def over(value: Column, step: Column) -> Column:
        columns = F.get(matrices, step)
        product = F.aggregate(
            F.sequence(F.lit(0), F.lit(BITS - 1)), long(0),
            lambda s, j: F.when(F.getbit(value, j) == 1, s.bitwiseXOR(F.get(columns, j))).otherwise(s),
        )
        return F.when(F.getbit(n_bytes, step) == 1, product).otherwise(value)

    return F.aggregate(F.sequence(F.lit(0), F.lit(LENGTH_BITS - 1)), crc.cast("long"), over)


def combined_crc32(parts: DataFrame, keys: Sequence[str], order: Sequence[Column], crc: str = "crc32", n_bytes: str = "n_bytes", ranges: int | None = None) -> DataFrame:
    """``keys, crc32, n_bytes, parts``: the checksum of the files that the parts, joined in order, make up.

    ``order`` is the order of the parts from the last to the first, as each is moved over what follows it.
    """
    placed = running_before(parts, keys, order, {"_after": n_bytes}, ranges)
    return placed.groupBy(*keys).agg(
        F.bit_xor(moved_crc32(F.col(crc), F.col("_after"))).alias("crc32"), F.sum(n_bytes).alias("n_bytes"), F.count("*").alias("parts")
    )


def export_checksums(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """``file, crc32, n_bytes, parts`` for every folder of part files below ``path``: eight hex digits of the joined parts.

    A part is read and summed in one task; parts follow one another by the numbers of the tasks that wrote them, then by the
    number within the task, so more than 99,999 parts do not come out of order.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    number = lambda mark: F.regexp_extract(name, mark, 1).try_cast("long")
    parts = files.select(
        F.element_at(F.split("path", "/"), -2).alias("file"), number(r"^part-(\d+)").alias("task"), number(r"c(\d+)\.").alias("nth"), name.alias("part"),
        F.crc32("content").alias("crc32"), F.octet_length("content").cast("long").alias("n_bytes"),
    )
    whole = combined_crc32(parts, ["file"], [F.desc("task"), F.desc("nth"), F.desc("part")])
    return whole.withColumn("crc32", F.lower(F.lpad(F.hex("crc32"), 8, "0")))
