"""Words of many texts at once, as byte ranges and 64-bit hashes, in numpy.

Only ASCII bytes separate words or change case, so UTF-8 bytes can be cut
without decoding.  Texts come in slices of bounded size, so that memory does
not follow the size of an Arrow batch; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Bytes of words between ASCII white space.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words of ASCII letters, digits and everything beyond ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), np.uint64(0xD1342543DE82EF95))
    out[0] = 1
    return np.multiply.accumulate(out)


_few_powers = _powers(4096)


@dataclass
class Words:
    """``data`` holds lower-cased texts joined by line feeds; word i is data[start[i]:end[i]] of text doc[i].

    ``first`` has one entry more than there are texts: words first[d]:first[d + 1] are those of text d.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        length = self.end - self.start
        if not len(length):
            return np.zeros(0, dtype=np.uint64)
        powers = _few_powers if length.max() <= len(_few_powers) else _powers(int(length.max()))
        total = np.zeros(len(length), dtype=np.uint64)
        # Byte j of all words that have one: as many steps as the longest word of the slice, each over fewer words.
        live = np.arange(len(length))
        j = 0
        while len(live) > 64:
            total[live] += _BYTE[self.data[self.start[live] + j]] * powers[j]
            j += 1
            live = live[length[live] > j]
        for i in live:
            rest = self.data[self.start[i] + j : self.end[i]]
            total[i : i + 1] += (_BYTE[rest] * powers[j : j + len(rest)]).sum(dtype=np.uint64)
        return mix(total + length.astype(np.uint64) * _ODD)


def cut(texts: list[bytes | None], is_word: np.ndarray) -> Words:
    """Lower-case ASCII and cut into runs of word bytes; None has no words."""
    joined = b"\n".join(t or b"" for t in texts) + b"\n"
    data = LOWER[np.frombuffer(joined, dtype=np.uint8)]
    inside = is_word[data]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    start, end = edge[::2], edge[1::2]
    ends = np.cumsum(np.fromiter((len(t or b"") + 1 for t in texts), dtype=np.int64, count=len(texts)))
    first = np.concatenate(([0], np.searchsorted(start, ends)))
    return Words(data, start, end, first)


def slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Runs of rows with about ``size`` bytes of text (one row at least), and their texts as UTF-8."""
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
    lengths = np.asarray(column.is_valid()).astype(np.int64)
    lengths *= np.diff(np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]) if len(column) else 0
    lengths += 1
    at = 0
    total = np.cumsum(lengths)
    while at < len(column):
        before = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + size, side="right")))
        yield batch.slice(at, to - at), column.slice(at, to - at).to_pylist()
        at = to


def runs(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words within a text, and the bounds of each text's runs.

    A text of fewer words, but not none, gives one run of all its words.
    """
    n = np.diff(first)
    out = hashes * np.uint64(0x9E3779B97F4A7C15)
    full = max(len(hashes) - width + 1, 0)
    total = np.zeros(full, dtype=np.uint64)
    for j in range(width):
        total = mix(total + hashes[j : j + full] * np.uint64(2 * j + 0x632BE59BD9B4E019))
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    bounds = np.concatenate(([0], np.cumsum(count)))
    inside = np.repeat(first[:-1] - bounds[:-1], count) + np.arange(bounds[-1])
    result = np.zeros(bounds[-1], dtype=np.uint64)
    long_enough = np.repeat(n >= width, count)
    result[long_enough] = total[inside[long_enough]]
    for d in np.flatnonzero((n > 0) & (n < width)):
        h = np.array([n[d]], dtype=np.uint64)
        for i in range(first[d], first[d + 1]):
            h = mix(h * np.uint64(31) + out[i : i + 1])
        result[bounds[d]] = h[0]
    return result, bounds
