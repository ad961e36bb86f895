"""CRC-32 of many byte spans at once, from a table of positions.

The register after a message is linear in its bytes: byte b with d bytes
behind it always contributes ``TABLE[d, b]``, whatever else the message holds,
and the start value contributes a constant of the length. The checksum of a span
is therefore the exclusive or of looked-up values, which ``bitwise_xor.reduceat``
takes for all spans of a buffer in one call. A span longer than the table is cut
into blocks from its end, whose registers are folded from the left: a register
with a whole block behind it is itself four bytes with known distances.
"""

from __future__ import annotations

import zlib

import numpy as np

#: Bytes of a block, and rows of the table.
DEPTH = 256
#: Reflected polynomial of zlib's crc32.
POLYNOMIAL = 0xEDB88320
ONES = np.uint32(0xFFFFFFFF)


def _table(depth: int) -> np.ndarray:
    """TABLE[d, b]: register after byte b and d zero bytes, from a zero register."""
    now = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        now = np.where(now & np.uint32(1), (now >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), now >> np.uint32(1))
    one, rows = now, [now]
    for _ in range(depth - 1):
        now = (now >> np.uint32(8)) ^ one[now & np.uint32(255)]
        rows.append(now)
    return np.stack(rows)


TABLE = _table(DEPTH)
FLAT = TABLE.ravel()
#: Start value 0xFFFFFFFF after n zero bytes, n up to a block.
START = np.array([zlib.crc32(bytes(n)) for n in range(DEPTH + 1)], dtype=np.uint32) ^ ONES


def behind_block(register: np.ndarray) -> np.ndarray:
    """Registers with a block of zero bytes behind them."""
    out = np.zeros_like(register)
    for place in range(4):
        out ^= TABLE[DEPTH - 1 - place, (register >> np.uint32(8 * place)) & np.uint32(255)]
    return out


def crc32(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """zlib.crc32 of each ``data[starts[i]:ends[i]]`` (uint8), as uint32.

    Spans may overlap, repeat and stand in any order; an empty one gives 0.
    Besides the result it takes a few numbers for each byte of the spans.
    """
    out = np.zeros(len(starts), np.uint32)
    some = np.flatnonzero(ends > starts)
    if not len(some):
        return out
    starts, ends = starts[some], ends[some]
    blocks = (ends - starts + DEPTH - 1) // DEPTH
    first = np.cumsum(blocks) - blocks
    # Each block by its last byte: whole blocks count back from the end of the span.
    of = np.repeat(np.arange(len(some)), blocks)
    after = np.repeat(blocks, blocks) - 1 - (np.arange(len(of)) - first[of])
    to = ends[of] - after * DEPTH
    size = to - np.maximum(to - DEPTH, starts[of])
    at = np.cumsum(size) - size
    distance = np.repeat(at + size, size) - 1 - np.arange(int(size.sum()))
    values = FLAT[distance * 256 + data[np.repeat(to, size) - 1 - distance]]
    register = np.bitwise_xor.reduceat(values, at)
    folded = register[first] ^ START[size[first]]
    for step in range(1, int(blocks.max())):
        more = np.flatnonzero(blocks > step)
        folded[more] = behind_block(folded[more]) ^ register[first[more] + step]
    out[some] = folded ^ ONES
    return out
