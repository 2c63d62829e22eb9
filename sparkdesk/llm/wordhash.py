"""64-bit hashes of words and word runs of whole texts, by numpy inside tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handed out in blocks of about so many bytes.
BLOCK = 4_000_000


def _numbers(name: str, n: int) -> np.ndarray:
    """Odd 64-bit numbers that are the same in every process."""
    raw = b"".join(hashlib.blake2b(f"{name} {i}".encode(), digest_size=64).digest() for i in range(n // 8 + 1))
    return np.frombuffer(raw, dtype=np.uint64)[:n] | np.uint64(1)


BYTES = _numbers("byte", 256)
STEP, RUN = _numbers("step", 2)
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalising steps of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: np.uint64 = STEP) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def bounds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and the byte after the last of each word; words are parted by the blank and bytes 9 to 13."""
    word = np.empty(len(raw) + 2, dtype=np.int8)
    word[0] = word[-1] = 0
    word[1:-1] = (raw != 32) & ((raw < 9) | (raw > 13))
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(text: bytes) -> np.ndarray:
    """One hash for each word of a UTF-8 text."""
    raw = np.frombuffer(text, dtype=np.uint8)
    starts, ends = bounds(raw)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sizes = ends - starts
    at = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum()) - np.repeat(at, sizes)
    values = BYTES[raw[np.repeat(starts, sizes) + place]] * powers(int(sizes.max()))[place]
    return mixed(np.add.reduceat(values, at) + sizes.astype(np.uint64) * RUN)


def run_hashes(words: np.ndarray, size: int, base: np.uint64 = RUN) -> np.ndarray:
    """One hash for each run of ``size`` words."""
    count = max(0, len(words) - size + 1)
    total = np.zeros(count, dtype=np.uint64)
    for i in range(size):
        total = total * base + words[i : i + count]
    return mixed(total)


def slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """The batches in slices of about BLOCK bytes of text, with the texts as bytes."""
    for batch in batches:
        values = batch.column(column).cast(pa.binary())
        sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for row, size in enumerate(sizes):
            total += size
            if total >= BLOCK:
                yield batch.slice(start, row + 1 - start), values.slice(start, row + 1 - start).to_pylist()
                start, total = row + 1, 0
        if start < len(values):
            yield batch.slice(start), values.slice(start).to_pylist()
