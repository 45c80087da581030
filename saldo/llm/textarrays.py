"""Whole batches of texts as flat numpy arrays: code points, words, word shingles.

Arrow hands a task thousands of texts at a time. Working on one flat array for
many texts costs a few nanoseconds a character; the batches are cut by length so
that memory depends on the limit, or on the longest single text, and not on how
many rows Arrow sends.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import SparkSession

CHUNK_CHARS = 1_000_000
#: Bytes of an Arrow batch, which a task holds several times over: in the JVM, as Arrow and as Python objects.
BATCH_BYTES, BATCH_SETTING = 8 * 1024 * 1024, "spark.sql.execution.arrow.maxBytesPerBatch"
BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's limit for Arrow batches to ``BATCH_BYTES``; a lower limit stays."""
    now = spark.conf.get(BATCH_SETTING)
    if not now.rstrip("b").isdigit() or int(now.rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def chunks(texts: Sequence[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts that hold about ``limit`` characters each."""
    start = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of the texts in one array, and the offset of each text (one more at the end)."""
    joined = "".join(texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=offsets[1:])
    return points, offsets


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """Word hashes of a batch. Words are runs of bytes outside 0x20 and 0x09-0x0D.

    ``hashes`` has one number per word in reading order, ``first`` the index of
    each text's first word (one more at the end), ``starts``/``ends`` the byte
    span of each word and ``data`` the bytes.
    """

    def __init__(self, texts: Sequence[str]):
        encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = b"\n".join(encoded) + b"\n"
        raw = np.frombuffer(self.data, dtype=np.uint8)
        gap = (raw == 32) | ((raw >= 9) & (raw <= 13))
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        if len(raw) and not gap[0]:
            edge = np.concatenate(([0], edge))
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(e) + 1 for e in encoded], out=self.offsets[1:])
        self.first = np.searchsorted(self.starts, self.offsets)
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(raw)), out=sums[1:])
        value = (sums[self.ends] - sums[self.starts]) * _powers(_INVERSE, len(raw))[self.starts]
        self.hashes = mix(value + (self.ends - self.starts).astype(np.uint64))


def shingles(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Hashes of all runs of ``size`` words; a shorter text has one shingle of all its words."""
    if not len(words):
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        out = out * BASE + words[k : len(words) - size + 1 + k]
    return mix(out + np.uint64(size))
