"""Benchmark passages in documents: SimHash windows of the items' sizes, verified exactly.

A window has as many words as a benchmark item. Its fingerprint is the 64-bit SimHash of its
five-word shingles, weighted by how often they occur; an item's likewise. Fingerprints are split
into eight blocks of eight bits: two fingerprints within RADIUS bits have a block within RADIUS // 8
bits, so tables of the near values of each block find every item within the radius, and none is
missed. What they find is verified by the weighted similarity of the shingles themselves: the sum
of the smaller weights over that of the larger ones, SIMILARITY or more.

A window that shares no shingle with an item has similarity 0, so only windows around shared
shingles are fingerprinted; that leaves out nothing. An item of fewer than five words is one shingle
of its own length, and is found where its words stand in a row.

Documents are read once and never shuffled. Items go to the tasks in blocks of at most
BLOCK_ITEMS; a larger benchmark takes as many passes in a row over the documents' batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import SHINGLE_WORDS, SIMILARITY, shingles, small_batches, table, word_hashes

#: Shingle sets with similarity 0.8 differ in 9.7 of 64 bits on average, with a deviation of 2.9.
RADIUS = 23
BLOCKS = 8
#: Items sent to the tasks at once, and characters of theirs.
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 32 << 20
#: Windows fingerprinted at once.
_PART = 4096

_BITS = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def bit_signs(hashes: np.ndarray) -> np.ndarray:
    """+1 and -1 for the 64 bits of each hash."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int8) * 2 - 1


def pack(sums: np.ndarray) -> np.ndarray:
    """Fingerprints as eight bytes from sums of signs; a sum of zero counts as a zero bit."""
    return np.packbits(sums > 0, axis=1)


def fingerprint(own: np.ndarray) -> np.ndarray:
    return pack(bit_signs(own).sum(axis=0, dtype=np.int32)[None, :])[0]


class HammingIndex:
    """Finds all fingerprints within RADIUS of a query, by blocks."""

    def __init__(self, prints: np.ndarray, radius: int = RADIUS):
        self.prints, self.radius = prints, radius
        near = _BITS[np.arange(256)[:, None] ^ np.arange(256)[None, :]] <= radius // BLOCKS
        #: For each block and byte value, the fingerprints whose block is near it.
        self.tables = [
            [np.flatnonzero(near[value][prints[:, b]]) for value in range(256)] for b in range(BLOCKS)
        ]

    def within(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, fingerprint) within the radius."""
        n = len(self.prints)
        pairs = []
        for b in range(BLOCKS):
            lists = [self.tables[b][value] for value in queries[:, b]]
            sizes = [len(found) for found in lists]
            if sum(sizes):
                pairs.append(np.repeat(np.arange(len(queries)), sizes) * n + np.concatenate(lists))
        if not pairs:
            return np.empty(0, int), np.empty(0, int)
        both = np.unique(np.concatenate(pairs))
        q, p = both // n, both % n
        ok = _BITS[queries[q] ^ self.prints[p]].sum(axis=1) <= self.radius
        return q[ok], p[ok]


@dataclass
class _Item:
    id: int
    words: int
    hashes: np.ndarray  # distinct shingles
    counts: np.ndarray
    print: np.ndarray


class ItemSet:
    """Items with a window size each, and short ones as single shingles; without a word there is no item."""

    def __init__(self, rows: list[tuple[int | None, str | None]]):
        self.items: list[_Item] = []
        self.short: dict[int, list[tuple[np.uint64, int | None]]] = {}
        for (item_id, _), words in zip(rows, word_hashes([t for _, t in rows])):
            if 0 < len(words) < SHINGLE_WORDS:
                self.short.setdefault(len(words), []).append((shingles(words)[0], item_id))
            elif len(words):
                own = shingles(words)
                self.items.append(_Item(item_id, len(words), *np.unique(own, return_counts=True), fingerprint(own)))
        flat = np.concatenate([i.hashes for i in self.items] or [np.empty(0, np.uint64)])
        of = np.repeat(np.arange(len(self.items)), [len(i.hashes) for i in self.items])
        order = np.argsort(flat, kind="stable")
        self.hashes, self.of = flat[order], of[order].astype(np.int64)
        self.rough = np.zeros(1 << 22, bool)
        self.rough[(self.hashes & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        self.sizes = np.array([i.words for i in self.items], np.int64)
        self.by_size = {}
        for size in np.unique(self.sizes):
            own = np.flatnonzero(self.sizes == size)
            self.by_size[int(size)] = own, HammingIndex(np.array([self.items[i].print for i in own]))

    def hits(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the shingle, item) for shingles that items have."""
        at = np.flatnonzero(self.rough[(own & np.uint64((1 << 22) - 1)).astype(np.int64)])
        low = np.searchsorted(self.hashes, own[at])
        n = np.searchsorted(self.hashes, own[at], "right") - low
        at, low, n = at[n > 0], low[n > 0], n[n > 0]
        before = np.cumsum(n) - n
        places = np.repeat(at, n)
        return places, self.of[np.repeat(low - before, n) + np.arange(len(places))]

    def search(self, words: np.ndarray, least: float = SIMILARITY) -> list[tuple[int, float, int, int]]:
        """(item id, similarity, first word, last word + 1) of each item found, its best window."""
        return self._short(words) + self._long(words, least)

    def _short(self, words: np.ndarray) -> list[tuple[int, float, int, int]]:
        """Short items in the words, each where it comes first."""
        out = []
        for n, items in self.short.items():
            if len(words) >= n:
                runs, first = np.unique(shingles(words, n), return_index=True)
                for own, item_id in items:
                    at = np.searchsorted(runs, own)
                    if at < len(runs) and runs[at] == own:
                        out.append((item_id, 1.0, int(first[at]), int(first[at]) + n))
        return out

    def _long(self, words: np.ndarray, least: float) -> list[tuple[int, float, int, int]]:
        if len(words) < SHINGLE_WORDS or not self.items:
            return []
        own = shingles(words)
        places, items = self.hits(own)
        if not len(places):
            return []
        best: dict[int, tuple[float, int, int]] = {}
        sizes = self.sizes[items]
        for size in np.unique(sizes):
            members, index = self.by_size[int(size)]
            # A shorter document is one window.
            window = min(int(size), len(words)) - SHINGLE_WORDS + 1  # in shingles
            last = len(own) - window
            mine = np.unique(places[sizes == size])
            starts = np.zeros(last + 2, np.int64)
            np.add.at(starts, np.clip(mine - window + 1, 0, last + 1), 1)
            np.add.at(starts, np.minimum(mine, last) + 1, -1)
            starts = np.flatnonzero(np.cumsum(starts[:-1]) > 0)
            for part in np.split(starts, range(_PART, len(starts), _PART)):
                self._windows(own, part, window, members, index, least, best, int(size))
        return [(self.items[i].id, *found) for i, found in sorted(best.items())]

    def _windows(self, own, starts, window, members, index, least, best, size) -> None:
        # Sums over windows from running sums over the runs of shingles that the windows cover.
        cover = np.unique((starts[:, None] + np.array([0, window])).ravel())
        begin, end = int(cover[0]), int(cover[-1])
        if end - begin > 4 * len(starts) + 4 * window:  # far apart: one by one
            half = len(starts) // 2
            if half:
                for part in (starts[:half], starts[half:]):
                    self._windows(own, part, window, members, index, least, best, size)
                return
        sums = np.zeros((end - begin + 1, 64), np.int32)
        np.cumsum(bit_signs(own[begin:end]), axis=0, out=sums[1:])
        prints = pack(sums[starts - begin + window] - sums[starts - begin])
        for q, p in zip(*index.within(prints)):
            item = self.items[members[p]]
            start = int(starts[q])
            value = similarity(item, own[start : start + window])
            if value >= least:
                found = (value, start, start + window + SHINGLE_WORDS - 1)
                known = best.get(members[p])
                if known is None or value > known[0]:
                    best[members[p]] = found


def similarity(item: _Item, own: np.ndarray) -> float:
    """Weighted similarity of an item and a window's shingles."""
    at = np.searchsorted(item.hashes, own)
    at[at == len(item.hashes)] = 0
    at = at[item.hashes[at] == own]
    both = int(np.minimum(np.bincount(at, minlength=len(item.hashes)), item.counts).sum())
    return both / (int(item.counts.sum()) + len(own) - both)


FOUND = "array<struct<item_id:long,similarity:double,begin:int,end:int>>"
_FOUND_ARROW = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("similarity", pa.float64()), ("begin", pa.int32()), ("end", pa.int32()),
]))


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str | None]]]:
    """The items in blocks of bounded size, by a hash of their ids; null texts are left out."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text is not null")
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = int(max(1, -(-n // (BLOCK_ITEMS // 2)), -(-chars // (BLOCK_CHARS // 2))))
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield [tuple(r) for r in own.orderBy("item_id", "text").collect()]


def search(docs: DataFrame, benchmark: DataFrame, text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """Rows of `docs` as a struct `row`, with `found`: the items (FOUND) that the text holds.

    Null and empty texts hold none; an empty benchmark is found nowhere. Items that occur more than
    once in the benchmark are found each time, items with a null id under a null id. All rows stay.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.struct("*").alias("row"), F.array().cast(FOUND).alias("found")
    )
    schema = f"row {rows.schema['row'].dataType.simpleString()}, found {FOUND}"
    for block in item_blocks(benchmark):

        def look(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            items = ItemSet(block)
            for batch in batches:
                texts = batch.column("row").field(text).to_pylist()
                found = [
                    (before or []) + [dict(zip(("item_id", "similarity", "begin", "end"), x)) for x in items.search(words, least)]
                    for before, words in zip(batch.column("found").to_pylist(), word_hashes(texts))
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.array(found, _FOUND_ARROW)], names=["row", "found"]
                )

        rows = rows.mapInArrow(look, schema)
    return rows


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = search(docs, table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("found", lambda x: x["item_id"])))
    return found.select(
        "row.doc_id", (F.size("found") > 0).alias("contaminated"), items.alias("item_ids"),
        F.array_max(F.transform("found", lambda x: x["similarity"])).alias("similarity"),
    )
