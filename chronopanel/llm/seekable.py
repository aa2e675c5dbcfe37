"""Seekable Zstandard files: independent frames and a trailing seek table.

The layout is the public Zstandard seekable format: each frame decompresses
on its own; the last, skippable frame lists for every frame its compressed
size, its decompressed size and a checksum (the low 32 bits of XXH64 of the
decompressed bytes), and ends with the frame count, a descriptor byte and the
magic number. One more skippable frame before it holds this library's index
(which record lies where inside which frame). Plain ``zstd -d`` skips both
and yields the frames' contents one after the other.
"""

from __future__ import annotations

import struct

import numpy as np
import xxhash
import zstandard

# Fixed values of the Zstandard seekable format.
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SKIPPABLE_INDEX = 0x184D2A50
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

_ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
FRAME_LIMIT = 1 << 30


class SeekableWriter:
    def __init__(self, out, level: int = 3):
        self.out, self.frames, self.at = out, [], 0
        self.zstd = zstandard.ZstdCompressor(level=level, write_content_size=True)

    def frame(self, plain: bytes) -> int:
        """Write one frame and return its number."""
        if len(plain) > FRAME_LIMIT:
            raise ValueError("a frame holds at most 1 GiB; split the record")
        packed = self.zstd.compress(plain)
        self.out.write(packed)
        self.at += len(packed)
        self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        return len(self.frames) - 1

    def close(self, index: bytes) -> None:
        packed = self.zstd.compress(index)
        self.out.write(struct.pack("<II", SKIPPABLE_INDEX, len(packed) + 4) + packed + struct.pack("<I", len(packed)))
        table = np.array(self.frames, dtype=_ENTRY).tobytes()
        foot = struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table) + len(foot)) + table + foot)


class SeekableReader:
    """Reads the seek table and the index, then only the frames asked for."""

    def __init__(self, file):
        self.file = file
        end = file.size()
        count, flag, magic = struct.unpack("<IBI", file.read_at(9, end - 9))
        if magic != SEEKABLE_MAGIC or not flag & CHECKSUM_FLAG:
            raise ValueError("not a seekable file with checksums")
        size = count * _ENTRY.itemsize
        self.frames = np.frombuffer(file.read_at(size, end - 9 - size), _ENTRY) if count else np.zeros(0, _ENTRY)
        self.begin = np.concatenate([[0], np.cumsum(self.frames["packed"].astype(np.int64))])
        self.zstd = zstandard.ZstdDecompressor()
        last = end - 9 - size - 8
        (packed,) = struct.unpack("<I", file.read_at(4, last - 4))
        self.index = self.zstd.decompress(file.read_at(packed, last - 4 - packed))

    def frame(self, k: int) -> bytes:
        e = self.frames[k]
        plain = self.zstd.decompress(self.file.read_at(int(e["packed"]), int(self.begin[k])), max_output_size=int(e["plain"]) or 1)
        if len(plain) != e["plain"] or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != e["check"]:
            raise ValueError(f"frame {k} fails its checksum")
        return plain
