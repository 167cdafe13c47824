"""Files of token ids: independent zstandard frames and a trailing seek table.

A file holds, in this order,

- frames: the ids of one document as little-endian unsigned 32-bit integers, in one frame or, for a
  long document, in several; each with a content checksum;
- a skippable frame with the directory of documents: their ids, numbers of tokens and of frames;
- the seek table of the public "seekable format" of zstandard, with the low half of XXH64 of each
  frame's content as its checksum.

Any zstandard decoder reads such a file from the start; ``Reader`` decompresses only the frames of
the documents asked for.
"""

from __future__ import annotations

import struct
import sys
from collections.abc import Iterator

import numpy as np
import xxhash
import zstandard
from pyspark import cloudpickle

# Fixed values of the public format.
SKIPPABLE_MAGIC = 0x184D2A50
TABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80

FRAME_IDS = 1 << 20
LEVEL = 3
_ENTRY = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("checksum", "<u4")])
_DOCUMENT = np.dtype([("doc_id", "<i8"), ("is_null", "u1"), ("n_tokens", "<u8"), ("n_frames", "<u4")])
_FOOTER = "<IBI"


def checksum(content: bytes) -> int:
    return xxhash.xxh64_intdigest(content) & 0xFFFFFFFF


class Writer:
    """Writes documents to a binary stream, in the order they come."""

    def __init__(self, stream, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        self.stream, self.frame_ids = stream, frame_ids
        self.pack = zstandard.ZstdCompressor(level, write_checksum=True, write_content_size=True).compress
        self.entries: list[tuple[int, int, int]] = []
        self.documents: list[tuple[int, int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        n_frames = max(1, -(-len(ids) // self.frame_ids))
        for k in range(n_frames):
            content = ids[k * self.frame_ids : (k + 1) * self.frame_ids].astype("<u4").tobytes()
            packed = self.pack(content)
            self.entries.append((len(packed), len(content), checksum(content)))
            self.stream.write(packed)
        self.documents.append((doc_id or 0, doc_id is None, len(ids), n_frames))

    def close(self) -> None:
        """Write directory and seek table; the stream stays open."""
        for magic, body in (
            (SKIPPABLE_MAGIC, np.array(self.documents, _DOCUMENT).tobytes()),
            (
                TABLE_MAGIC,
                np.array(self.entries, _ENTRY).tobytes()
                + struct.pack(_FOOTER, len(self.entries), HAS_CHECKSUMS, SEEKABLE_MAGIC),
            ),
        ):
            self.stream.write(struct.pack("<II", magic, len(body)) + body)


class Reader:
    """Reads the documents asked for from a stream that can seek."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.seek(0, 2)
        footer = struct.calcsize(_FOOTER)
        n, flags, magic = struct.unpack(_FOOTER, self._at(size - footer, footer))
        if magic != SEEKABLE_MAGIC or flags != HAS_CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        table = size - footer - n * _ENTRY.itemsize
        self.entries = np.frombuffer(self._at(table, n * _ENTRY.itemsize), _ENTRY)
        self.starts = np.concatenate([[0], np.cumsum(self.entries["packed"], dtype=np.int64)])
        magic, length = struct.unpack("<II", self._at(int(self.starts[-1]), 8))
        if magic != SKIPPABLE_MAGIC:
            raise ValueError("no directory of documents behind the frames")
        self.documents = np.frombuffer(self._at(int(self.starts[-1]) + 8, length), _DOCUMENT)
        self.first_frame = np.cumsum(self.documents["n_frames"]) - self.documents["n_frames"]
        self.unpack = zstandard.ZstdDecompressor().decompress

    def _at(self, start: int, length: int) -> bytes:
        self.stream.seek(start)
        return self.stream.read(length)

    def ids(self, k: int) -> np.ndarray:
        """Ids of the document at position ``k`` of the file."""
        first = int(self.first_frame[k])
        last = first + int(self.documents["n_frames"][k])
        start = int(self.starts[first])
        packed = self._at(start, int(self.starts[last]) - start)
        parts = []
        for f in range(first, last):
            a = int(self.starts[f]) - start
            content = self.unpack(packed[a : a + int(self.entries["packed"][f])])
            if checksum(content) != self.entries["checksum"][f]:
                raise ValueError(f"frame {f} does not match its checksum")
            parts.append(content)
        return np.frombuffer(b"".join(parts), "<u4")

    def doc_id(self, k: int) -> int | None:
        found = self.documents[k]
        return None if found["is_null"] else int(found["doc_id"])

    def find(self, doc_id: int | None) -> Iterator[int]:
        """Positions of the documents with this id."""
        same = self.documents["is_null"] == (doc_id is None)
        yield from np.flatnonzero(same & (self.documents["doc_id"] == (doc_id or 0))).tolist()


cloudpickle.register_pickle_by_value(sys.modules[__name__])
