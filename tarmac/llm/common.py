"""What several operators share: tables, batch sizes, words and shingles as numbers."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are cut into pieces of about this many characters while their words are hashed.
PIECE_CHARS = 1_000_000
SHINGLE_WORDS = 5
SIMILARITY = 0.8

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> SparkSession:
    """Bound what a Python worker gets at once, in rows and in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def crc_of_id(name: str = "doc_id"):
    """crc32 of the id written as text, the number that deals documents into folds."""
    return F.crc32(F.col(name).cast("string").cast("binary"))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@functools.lru_cache(1)
def _word_chars() -> np.ndarray:
    return np.array([chr(i).isalnum() or i == 95 for i in range(1 << 16)])


@functools.lru_cache(2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def _inside(points: np.ndarray) -> np.ndarray:
    """Which code points belong to words; all beyond the basic plane do."""
    if len(points) and points.max() >= 65536:
        points = np.where(points < 65536, points, 97)
    return _word_chars()[points]


def _piece_words(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in an array of code points, and where they start."""
    inside = np.zeros(len(points) + 2, bool)
    inside[1:-1] = _inside(points)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    size = max(1 << 21, 1 << int(len(points) + 1).bit_length())
    with np.errstate(over="ignore"):
        total = np.zeros(len(points) + 1, np.uint64)
        np.multiply(points, _powers(_BASE, size)[: len(points)], out=total[1:], dtype=np.uint64)
        np.cumsum(total, out=total)
        own = (total[ends] - total[starts]) * _powers(_INVERSE, size)[starts]
        return mix(own + (ends - starts).astype(np.uint64)), starts


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def _pieces(text: str):
    """Parts of a lower-case text, cut between words."""
    at = 0
    while len(text) - at > PIECE_CHARS:
        end = at + PIECE_CHARS
        while end < len(text) and (text[end - 1].isalnum() or text[end - 1] == "_"):
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """For each text, the 64-bit hashes of its words: lower-case runs of letters and digits.

    Short texts are hashed together, long ones piece by piece.
    """
    out: list[np.ndarray] = [np.empty(0, np.uint64)] * len(texts)
    waiting: list[tuple[int, str]] = []
    held = 0

    def flush() -> None:
        nonlocal held
        if not waiting:
            return
        # The separator is no word character.
        found, starts = _piece_words(_points("\n".join(t for _, t in waiting)))
        ends = np.cumsum([len(t) + 1 for _, t in waiting])
        for (i, _), part in zip(waiting, np.split(found, np.searchsorted(starts, ends[:-1]))):
            out[i] = part
        waiting.clear()
        held = 0

    for i, text in enumerate(texts):
        text = (text or "").lower()
        if len(text) > PIECE_CHARS:
            out[i] = np.concatenate([_piece_words(_points(p))[0] for p in _pieces(text)])
            continue
        waiting.append((i, text))
        held += len(text)
        if held > PIECE_CHARS:
            flush()
    flush()
    return out


def shingles(words: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the runs of k words; a shorter text is one shingle, a text without words none."""
    n = len(words)
    if n == 0:
        return words
    k = min(k, n)
    with np.errstate(over="ignore"):
        total = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            total = total * np.uint64(_BASE) + words[j : n - k + 1 + j]
        return mix(total + np.uint64(k))
