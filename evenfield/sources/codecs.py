"""Bytes of chunks: zstd, gzip, checksums and the layouts of the public n5 and zarr formats."""

from __future__ import annotations

import gzip
import struct
import zlib
from functools import lru_cache

import numpy as np


@lru_cache(maxsize=1)
def _crc_table() -> list[int]:
    table = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (0x82F63B78 if n & 1 else 0)
        table.append(n)
    return table


def crc32c(data: bytes) -> int:
    """The Castagnoli checksum that shard indexes carry."""
    table, crc = _crc_table(), 0xFFFFFFFF
    for b in data:
        crc = table[(crc ^ b) & 255] ^ (crc >> 8)
    return crc ^ 0xFFFFFFFF


@lru_cache(maxsize=8)
def _zstd(level: int | None):
    """A compressor of a level, or for None a decompressor: to make one costs more than a small chunk's work."""
    import zstandard

    return zstandard.ZstdDecompressor() if level is None else zstandard.ZstdCompressor(level=level)


def compress(data: bytes, name: str | None, level: int = 3) -> bytes:
    if name in (None, "raw", "bytes"):
        return data
    if name == "zstd":
        return _zstd(level).compress(data)
    if name == "gzip":
        return gzip.compress(data, mtime=0)
    if name == "zlib":
        return zlib.compress(data)
    raise ValueError(f"compression {name!r} isn't known")


def decompress(data: bytes, name: str | None) -> bytes:
    if name in (None, "raw", "bytes"):
        return data
    if name == "zstd":
        return _zstd(None).decompressobj().decompress(data)
    if name == "gzip":
        return gzip.decompress(data)
    if name == "zlib":
        return zlib.decompress(data)
    raise ValueError(f"compression {name!r} isn't known")


MISSING = 0xFFFFFFFFFFFFFFFF


def pack_shard(chunks: list[bytes | None]) -> bytes:
    """Chunks in C order, then the index of (offset, size) pairs and its checksum."""
    body, index, at = [], [], 0
    for c in chunks:
        if c is None:
            index += [MISSING, MISSING]
        else:
            index += [at, len(c)]
            body.append(c)
            at += len(c)
    told = struct.pack(f"<{len(index)}Q", *index)
    return b"".join(body) + told + struct.pack("<I", crc32c(told))


def unpack_shard(data: bytes, n: int) -> list[bytes | None]:
    told, (crc,) = data[-16 * n - 4 : -4], struct.unpack("<I", data[-4:])
    if crc32c(told) != crc:
        raise ValueError("the shard's index fails its checksum")
    index = struct.unpack(f"<{2 * n}Q", told)
    return [None if index[2 * k] == MISSING else data[index[2 * k] : index[2 * k] + index[2 * k + 1]] for k in range(n)]


def n5_block(block: np.ndarray, compression: str) -> bytes:
    """A block whose first axis runs fastest, behind its header, big-endian."""
    head = struct.pack(f">HH{block.ndim}I", 0, block.ndim, *block.shape)
    return head + compress(block.astype(">u2").tobytes(order="F"), compression)


def read_n5_block(data: bytes, compression: str) -> np.ndarray:
    mode, ndim = struct.unpack(">HH", data[:4])
    shape = struct.unpack(f">{ndim}I", data[4 : 4 + 4 * ndim])
    at = 4 + 4 * ndim + (4 if mode == 1 else 0)
    return np.frombuffer(decompress(data[at:], compression), ">u2").reshape(shape, order="F")


# TIFF's variable-length codes, most significant bit first, a bit longer one code before they would have to be.
CLEAR, ENDED, FIRST_CODE, WIDEST = 256, 257, 258, 12


def lzw_decode(data: bytes) -> bytes:
    """Codes of TIFF's LZW. A loop over codes, as each may need the one before."""
    table, out = [bytes([k]) for k in range(256)] + [b"", b""], []
    held = bits = 0
    width, before = 9, b""
    for byte in data:
        held, bits = (held << 8) | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == ENDED:
            break
        if code == CLEAR:
            del table[FIRST_CODE:]
            width, before = 9, b""
            continue
        if code < len(table):
            entry = table[code]
        elif code == len(table) and before:
            entry = before + before[:1]
        else:
            raise ValueError(f"code {code} isn't known yet")
        out.append(entry)
        if before:
            table.append(before + entry[:1])
        before = entry
        width = min(WIDEST, (len(table) + 1).bit_length())
    return b"".join(out)


def lzw_encode(data: bytes) -> bytes:
    out, held, bits = bytearray(), 0, 0
    table: dict[bytes, int] = {}
    width = 9

    def put(code: int) -> None:
        nonlocal held, bits
        held, bits = (held << width) | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits)
            held &= (1 << bits) - 1

    def clear() -> None:
        nonlocal table, width
        put(CLEAR)
        table, width = {bytes([k]): k for k in range(256)}, 9

    clear()
    own = b""
    for k in range(len(data)):
        longer = own + data[k : k + 1]
        if longer in table:
            own = longer
            continue
        put(table[own])
        table[longer] = len(table) + 2
        width = min(WIDEST, (len(table) + 3 - 1).bit_length())
        if len(table) + 2 >= (1 << WIDEST) - 2:
            clear()
        own = data[k : k + 1]
    if own:
        put(table[own])
        # the reader's table grows with this code too
        width = min(WIDEST, (len(table) + 3).bit_length())
    put(ENDED)
    if bits:
        out.append((held << (8 - bits)) & 255)
    return bytes(out)
