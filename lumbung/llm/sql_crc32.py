"""crc32 in DuckDB's SQL, half a byte at a time; its table follows from the polynomial."""

from __future__ import annotations

POLYNOMIAL = 0xEDB88320


def table() -> list[int]:
    """What four steps of the shift register make of each half byte."""
    values = list(range(16))
    for _ in range(4):
        values = [v >> 1 ^ (POLYNOMIAL if v & 1 else 0) for v in values]
    return values


def crc32(text: str) -> str:
    """An expression for the unsigned crc32 of the UTF-8 bytes of the expression ``text``."""
    halves = (
        f"list_transform(range(2 * strlen({text})), lambda i: "
        f"(instr('0123456789ABCDEF', substr(hex(encode({text})), (xor(i, 1) + 1)::BIGINT, 1)) - 1)::BIGINT)"
    )
    step = f"lambda c, n: xor(c >> 4, {table()}[((xor(c, n) & 15) + 1)::BIGINT]::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {halves}), {step}), 4294967295::BIGINT)"
