"""Exact dedup against a minimal perfect hash of the texts known before.

What was delivered earlier is kept as an index. The distinct digests of its texts are dealt into
shards by their first bits; each shard has a minimal perfect hash, a cascade of bit arrays in which
every digest owns one bit, whose rank is its slot. A slot holds the full digest, the locator of the
row that stays and the number of copies. A delivery is summed by digest, so that a text repeated any
number of times is one question; a question finds its slot, and the digest kept there is compared
byte for byte. Members are repeats of known texts, the others are groups of their own.

Texts are equal if they are identical after lower-casing A-Z; a null text counts as an empty one.
Equality is that of SHA-256.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import crc_of_id, mix, table
from tarmac.session import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Digests of a shard, and of the questions that meet a shard at once, on average.
SHARD = 1 << 12
#: Bits of the first array of the cascade for each digest.
SPARE = 2


# The hash of one shard.


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(len(digests), 4)


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where digests fall in the bit array of a level; all their bits take part."""
    with np.errstate(over="ignore"):
        h = np.full(len(words), (level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
        for j in range(4):
            h = mix(h * np.uint64(0xA24BAED4963EE407) + words[:, j])
    return (h % np.uint64(size)).astype(np.int64)


def cascade(words: np.ndarray) -> list[bytes]:
    """Bit arrays, one for each level: a digest alone at its place owns the bit, others go on."""
    levels = []
    while len(words):
        size = -(-SPARE * len(words) // 8) * 8
        at = _places(words, len(levels), size)
        hits = np.bincount(at, minlength=size)
        levels.append(np.packbits(hits == 1).tobytes())
        words = words[hits[at] > 1]
    return levels


def slots(words: np.ndarray, levels: list[bytes]) -> np.ndarray:
    """The slot of each digest, from 0 without gaps; -1 or any slot for a digest that has none."""
    out = np.full(len(words), -1, np.int64)
    left = np.arange(len(words))
    before = 0
    for level, packed in enumerate(levels):
        bits = np.unpackbits(np.frombuffer(packed, np.uint8))
        at = _places(words[left], level, len(bits))
        own = bits[at] == 1
        out[left[own]] = before + np.cumsum(bits, dtype=np.int64)[at[own]] - 1
        before += int(bits.sum())
        left = left[~own]
    return out


# The index over Spark.


def digests(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Rows of `docs` as a struct `row` (its columns `keep`) with `digest` and `uid`, the row's number.

    Stored, since the numbers depend on how the scan was split.
    """
    normal = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    rows = docs.select(F.struct(*(keep or ["*"])).alias("row"), F.unhex(F.sha2(normal, 256)).alias("digest"))
    return stored(rows.withColumn("uid", F.monotonically_increasing_id()), "digests")


def groups(rows: DataFrame, by: str = "doc_id") -> DataFrame:
    """(digest, winner, copies): the row with the largest `by` stays, of equal ones the first.

    Nulls in `by` are smallest. Sums and maxima are taken before the shuffle.
    """
    winner = F.struct(F.col("row")[by].alias("by"), F.negative("uid").alias("before"))
    return rows.groupBy("digest").agg(F.max(winner).alias("winner"), F.count("*").alias("copies"))


def _shard(shards: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long"), F.lit(shards))


def _block(blocks: int) -> Column:
    return F.pmod(F.conv(F.hex(F.substring("digest", 7, 6)), 16, 10).cast("long"), F.lit(blocks))


def _parts(rows: int) -> int:
    return max(1, -(-rows // SHARD))


def build(known: DataFrame) -> DataFrame:
    """The index of `known` (digest, winner, copies; digests are distinct): a row for each shard.

    A row has `shard` and `shards`, the levels of its hash, and the slots as lists in their order.
    Shards are filled by the digests' bits, so all are of about the same size.
    """
    known = stored(known, "known")
    shards = _parts(known.count())
    kind = known.schema["winner"].dataType.simpleString()
    filled = known.groupBy(_shard(shards).alias("shard")).agg(
        F.collect_list(F.struct("digest", "winner", "copies")).alias("entries")
    )

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                entries = batch.column("entries").slice(i, 1).flatten()
                words = _words(entries.field("digest").to_pylist())
                levels = cascade(words)
                entries = entries.take(pa.array(np.argsort(slots(words, levels))))
                one = pa.array([0, len(entries)], pa.int32())
                columns = [pa.ListArray.from_arrays(one, entries.field(n)) for n in ("digest", "winner", "copies")]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("shard").slice(i, 1), pa.array([levels], pa.list_(pa.binary())), *columns],
                    names=["shard", "levels", "digests", "winners", "copies"],
                )

    return stored(
        filled.select("shard", "entries").mapInArrow(
            make, f"shard long, levels array<binary>, digests array<binary>, winners array<{kind}>, copies array<long>"
        ).withColumn("shards", F.lit(shards).cast("long")),
        "index",
    )


def look_up(arrivals: DataFrame, index: DataFrame) -> DataFrame:
    """`arrivals` (digest, winner, copies) with `member` and the slot's `known_winner`, `known_copies`.

    Questions meet their shard in blocks of about SHARD, however many there are.
    """
    arrivals = stored(arrivals, "arrivals")
    first = index.select("shards").first()
    shards = first[0] if first else 1
    blocks = _parts(-(-arrivals.count() // shards))
    asked = arrivals.groupBy(_shard(shards).alias("shard"), _block(blocks).alias("block")).agg(
        F.collect_list(F.struct("digest", "winner", "copies")).alias("asked")
    )
    kind = arrivals.schema["winner"].dataType.simpleString()
    met = asked.join(index.withColumnRenamed("copies", "known"), "shard", "left").select(
        "asked", "levels", "digests", "winners", "known"
    )

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                asked, levels, digests, winners, known = (batch.column(c).slice(i, 1) for c in range(5))
                asked, n = asked.flatten(), len(asked.flatten())
                own = asked.field("digest")
                at = np.full(n, -1, np.int64)
                if levels.null_count == 0:
                    at = slots(_words(own.to_pylist()), levels[0].as_py())
                slot = pa.array(at, mask=at < 0)
                same = pa.compute.equal(digests.flatten().take(slot), own).fill_null(False)
                slot = pa.compute.if_else(same, slot, None)
                yield pa.RecordBatch.from_arrays(
                    [own, asked.field("winner"), asked.field("copies"), same, winners.flatten().take(slot), known.flatten().take(slot)],
                    names=["digest", "winner", "copies", "member", "known_winner", "known_copies"],
                )

    return stored(
        met.mapInArrow(
            probe,
            f"digest binary, winner {kind}, copies long, member boolean, known_winner {kind}, known_copies long",
        ),
        "answers",
    )


def absorb(answers: DataFrame, index: DataFrame) -> DataFrame:
    """(digest, winner, copies) of all texts known after a delivery; `build` makes the next index of it."""
    hits = answers.where("member").select(
        "digest", F.col("winner").alias("new_winner"), F.col("copies").alias("new_copies")
    )
    held = index.select(F.inline(F.arrays_zip("digests", "winners", "copies"))).toDF("digest", "winner", "copies")
    known = held.join(hits, "digest", "left").select(
        "digest", F.greatest("winner", F.coalesce("new_winner", "winner")).alias("winner"),
        (F.col("copies") + F.coalesce("new_copies", F.lit(0))).alias("copies"),
    )
    return known.unionByName(answers.where("not member").select("digest", "winner", "copies"))


def classes(docs: DataFrame, earlier: Column, text: str = "text", by: str = "doc_id",
            keep: list[str] | None = None) -> DataFrame:
    """Rows of `docs` as a struct `row` with `digest`, `keep_id`, `group_size` and `kept`.

    Rows for which `earlier` (an expression over the columns of `row`) holds make the index; the
    rest, also where it is null, is the delivery that is looked up in it. The result does not depend
    on `earlier`. `keep_id` is the largest `by` of the group, null if all are null. One row of each
    group is kept, also of rows that repeat as a whole. An empty table gives no rows.
    """
    rows = digests(docs, text, keep)
    was = F.coalesce(earlier, F.lit(False))
    index = build(groups(rows.where(was), by))
    answers = look_up(groups(rows.where(~was), by), index)
    # Stored, so that the join can split the rows of a digest that very many share.
    told = stored(absorb(answers, index), "groups")
    return rows.join(told, "digest").select(
        "row", "digest", F.col("winner.by").alias("keep_id"), F.col("copies").alias("group_size"),
        (F.col("uid") == -F.col("winner.before")).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents whose crc32(doc_id) is even are the earlier delivery."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    told = classes(docs, crc_of_id("row.doc_id") % 2 == 0, keep=["doc_id"])
    return told.select(
        "row.doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


SQL = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM (
  SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256 FROM documents
)
WINDOW same AS (PARTITION BY text_sha256)
"""
