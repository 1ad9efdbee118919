"""Pieces of reference SQL."""

from __future__ import annotations


def crc32(number: str) -> str:
    """CRC-32 of a number's decimal text, bit by bit: a byte is mixed in, then eight shifts follow (-1 stands for one)."""
    steps = f"flatten(list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    mixed = "CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, 3988292384 * (x & 1)) END"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda x, y: {mixed}), 4294967295)"
