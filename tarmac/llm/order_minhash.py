"""Near-duplicates by Order MinHash, verified by banded alignment.

A sketch of a text samples, for each of SKETCHES hash functions, the KEPT least of its five-word
shingles, each labelled with how often it occurred before, and keeps them in text order. Two texts
share a sketch entry if they sampled the same shingles in the same order, which follows their edit
similarity. Texts with the same words are one: only the first is sketched on.

Texts that share an entry form a bucket. Each is compared with the bucket's hub, its member that
shares entries with most others; so a bucket costs its size. What is left are members unlike their
hub. In small buckets, all pairs of different classes are compared. Members of large ones are
joined on what sets them apart from their hub (see by_differences): similar texts of which one is
unlike the hub share differences, the rare ones suffice to find them, and no pair is lost.

A pair is confirmed by an alignment in a band of diagonals. Its anchors are the longest chain of
labelled shingles that both texts hold in the same order; between anchors the words are aligned with
the fewest edits, where matched runs of L >= 5 words share L - 4 shingles. The shared ones over all
must reach SIMILARITY. Classes are the connected components of the links.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarmac.llm.common import SHINGLE_WORDS, SIMILARITY, mix, shingles, small_batches, table, word_hashes
from tarmac.llm.components import components
from tarmac.session import stored

SKETCHES = 16
KEPT = 3
#: In buckets of up to this many members, members unlike the hub are compared pair by pair.
SMALL_BUCKET = 24
#: Cells, as a power of two, that count the tokens of a hub at most; more texts share a cell then.
MOST_CELL_BITS = 18
#: Cells that a task holds before it hands them on, and texts that are cut in one group.
COUNTS_HELD = 1 << 25
TEXTS_AT_ONCE = 1024

#: Shingles in which two texts of SIMILARITY differ, over the shingles of both.
_APART = (1 - SIMILARITY) / (1 + SIMILARITY)
_SEEDS = mix(np.arange(1, 2 * SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def labelled(own: np.ndarray) -> np.ndarray:
    """Hashes of shingles with the number of earlier occurrences of the same shingle."""
    if not len(own):
        return own
    order = np.argsort(own, kind="stable")
    same = own[order]
    starts = np.flatnonzero(np.append(True, same[1:] != same[:-1]))
    if len(starts) == len(own):
        return own
    before = np.arange(len(own)) - np.repeat(starts, np.diff(np.append(starts, len(own))))
    out = own.copy()
    again = before > 0
    with np.errstate(over="ignore"):
        out[order[again]] = mix(same[again] + before[again].astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    return out


def sketch(words: np.ndarray) -> np.ndarray:
    """The SKETCHES entries of a text as numbers; none for a text without words."""
    own = labelled(shingles(words))
    n = len(own)
    if not n:
        return own
    keys = np.empty(SKETCHES, np.uint64)
    kept = min(KEPT, n)
    step = max(1, min(SKETCHES, 1_000_000 // n))
    with np.errstate(over="ignore"):
        for first in range(0, SKETCHES, step):
            part = slice(first, min(first + step, SKETCHES))
            values = (own[None, :] ^ _SEEDS[part, None]) * (_SEEDS[SKETCHES:][part, None] | np.uint64(1))
            values ^= values >> np.uint64(29)
            if n > kept:
                places = np.sort(np.argpartition(values, kept - 1, axis=1)[:, :kept], axis=1)
            else:
                places = np.broadcast_to(np.arange(n), (part.stop - part.start, n))
            total = _SEEDS[part].copy()
            for j in range(kept):
                total = mix(total * np.uint64(0x9E3779B97F4A7C15) + own[places[:, j]])
            keys[part] = total
    return keys


def _digest(words: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        at = np.arange(1, len(words) + 1, dtype=np.uint64)
        a = mix(words * (at * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1))).sum(dtype=np.uint64)
        b = mix(words + mix(at)).sum(dtype=np.uint64)
    return int(np.int64(np.uint64(a))) if a < 1 << 63 else int(a) - (1 << 64), int(b) if b < 1 << 63 else int(b) - (1 << 64)


# Alignment.


def anchors(x: np.ndarray, y: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Places, in two lists without repeats, of the longest chain of common values in one order.

    Only values at most `band` places apart take part.
    """
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= band
    order = np.argsort(i[near])
    i, j = i[near][order], j[near][order]
    if not len(i):
        return i, j
    if (np.diff(j) > 0).all():
        return i, j
    # ends[n] is the smallest last place of a chain of n + 1 values, at[n] the value there.
    ends: list[int] = []
    at: list[int] = []
    before = np.empty(len(j), np.int64)
    for k, place in enumerate(j.tolist()):
        n = bisect_left(ends, place)
        before[k] = at[n - 1] if n else -1
        ends[n : n + 1], at[n : n + 1] = [place], [k]
    chain = []
    k = at[-1]
    while k >= 0:
        chain.append(k)
        k = before[k]
    return i[chain[::-1]], j[chain[::-1]]


def _within(x: np.ndarray, y: np.ndarray, band: int) -> int:
    """How many of x are somewhere in y at most `band` places apart."""
    _, own = np.unique(np.concatenate([x, y]), return_inverse=True)
    apart = len(x) + len(y) + band + 1  # places of different values are never near
    there = np.sort(own[len(x) :] * apart + np.arange(len(y)))
    here = own[: len(x)] * apart + np.arange(len(x))
    at = np.searchsorted(there, here)
    left = here - there[np.maximum(at - 1, 0)]
    right = there[np.minimum(at, len(there) - 1)] - here
    return int(((np.abs(left) <= band) | (np.abs(right) <= band)).sum())


def aligned_shingles(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, band: int, need: float = 0) -> int:
    """Shingles shared by an alignment of the words `a` and `b`; x and y are their labelled shingles.

    What lies between two neighbouring anchors is aligned by itself, if it has a shingle in common
    within the band. 0 if `need` shingles are out of reach.
    """
    i, j = anchors(x, y, band)
    total = len(i)
    i, j = np.concatenate([[-1], i, [len(x)]]), np.concatenate([[-1], j, [len(y)]])
    gaps, most = [], 0
    # A gap's own shingles lie strictly between the anchors' ones.
    for k in np.flatnonzero((np.diff(i) > 1) & (np.diff(j) > 1)):
        one = a[i[k] + 1 : i[k + 1] + SHINGLE_WORDS - 1]
        two = b[j[k] + 1 : j[k + 1] + SHINGLE_WORDS - 1]
        own = band + abs(int(i[k] - j[k]))
        if near := _within(shingles(one.astype(np.uint64)), shingles(two.astype(np.uint64)), own):
            gaps.append((one, two))
            most += near
    if total + most < need:
        return 0
    return total + sum(shared_shingles(one, two, min(band, len(one) + len(two))) for one, two in gaps)


def shared_shingles(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Shingles on the matched runs of an alignment with the fewest edits, if `band` edits do; else 0.

    Furthest-reaching points on the diagonals within the band, one edit more at a time; runs of
    equal words are found from each diagonal's list of mismatches.
    """
    n, m = len(a), len(b)
    mismatches: dict[int, list[int]] = {}

    def slide(diagonal: int, i: int) -> int:
        """The end of the run of equal words from a[i] on."""
        found = mismatches.get(diagonal)
        if found is None:
            low, high = max(0, -diagonal), min(n, m - diagonal)
            found = (np.flatnonzero(a[low:high] != b[low + diagonal : high + diagonal]) + low).tolist()
            found.append(max(high, low))
            mismatches[diagonal] = found
        return max(i, found[min(bisect_left(found, i), len(found) - 1)])

    goal = m - n
    if abs(goal) > band:
        return 0
    # reach[e][k + e]: the furthest word of a after e edits on diagonal k, and where its run began.
    reach: list[array] = []
    begins: list[array] = []
    for e in range(band + 1):
        now, began = array("i"), array("i")
        last = reach[-1] if reach else None
        for k in range(-e, e + 1):
            if e == 0:
                i = 0
            else:
                at = k + e - 1  # this diagonal in the round before
                i = -1
                if 0 <= at < len(last):
                    i = last[at] + 1 if last[at] >= 0 else -1  # a word replaced
                if 0 <= at + 1 < len(last) and last[at + 1] >= 0:
                    i = max(i, last[at + 1] + 1)  # a word of a left out
                if 0 <= at - 1 < len(last):
                    i = max(i, last[at - 1])  # a word of b put in
                if i > n or i + k > m or i < 0 or i + k < 0:
                    now.append(-1 if i < 0 or i + k < 0 else min(i, n, m - k)), began.append(min(i, n))
                    continue
            now.append(slide(k, i))
            began.append(i)
        reach.append(now)
        begins.append(began)
        if abs(goal) <= e and now[goal + e] >= n:
            break
    else:
        return 0
    # Back along the path, adding up the runs.
    total, k = 0, goal
    end = n
    for back in range(e, -1, -1):
        start = begins[back][k + back]
        total += max(0, end - start - SHINGLE_WORDS + 1)
        if back == 0:
            break
        last, at = reach[back - 1], k + back - 1
        options = []
        if 0 <= at < len(last) and last[at] >= 0:
            options.append((last[at] + 1, k, last[at]))
        if 0 <= at + 1 < len(last) and last[at + 1] >= 0:
            options.append((last[at + 1] + 1, k + 1, last[at + 1]))
        if 0 <= at - 1 < len(last) and last[at - 1] >= 0:
            options.append((last[at - 1], k - 1, last[at - 1]))
        _, k, end = max(options, key=lambda x: x[0])
    return total


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Shared shingles of an alignment over all shingles; 0 if it cannot reach `least`."""
    if len(a) == len(b) and (a == b).all():
        return 1.0
    if min(len(a), len(b)) < SHINGLE_WORDS:
        return 0.0
    x, y = shingles(a.astype(np.uint64)), shingles(b.astype(np.uint64))
    n = len(x) + len(y)
    # No alignment shares more shingles than the texts have in common in any order.
    x, y = labelled(x), labelled(y)
    most = len(np.intersect1d(x, y, assume_unique=True))
    if most < least * (n - most):
        return 0.0
    # Every edit costs a shingle of the one or the other text at least.
    band = int(n - 2 * least / (1 + least) * n) + 1
    shared = aligned_shingles(a, b, x, y, band, least / (1 + least) * n - 1e-9)
    return shared / (n - shared)


# The same over Spark.

_SKETCHED = "row {}, a long, b long, n int, words binary, keys array<long>"


def sketched(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Rows of `docs` as a struct `row` with digests (a, b), words and sketch, numbered by uid."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct(*(keep or ["*"])).alias("row"), F.col(text).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = word_hashes(batch.column("text").to_pylist())
            digests = [_digest(w) for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    pa.array([len(w) for w in words], pa.int32()),
                    pa.array([(w >> np.uint64(32)).astype("<u4").tobytes() for w in words], pa.binary()),
                    pa.array([sketch(w).astype(np.int64) for w in words], pa.list_(pa.int64())),
                ],
                names=["row", "a", "b", "n", "words", "keys"],
            )

    # Numbers are given while the table is written and fixed from then on.
    made = rows.mapInArrow(make, _SKETCHED.format(kind))
    return made.withColumn("uid", F.monotonically_increasing_id())


def verify(pairs: DataFrame, words: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The pairs (a, b) of uids whose texts are similar; `words` has uid and words."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                similarity(np.frombuffer(x.as_py(), "<u4"), np.frombuffer(y.as_py(), "<u4"), least) >= least
                for x, y in zip(batch.column("x"), batch.column("y"))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    one = words.select(F.col("uid").alias("a"), F.col("words").alias("x"))
    two = words.select(F.col("uid").alias("b"), F.col("words").alias("y"))
    return (
        pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "x", "y")
        .mapInArrow(check, "a long, b long")
    )


def _fits(x: str, y: str):
    """Sizes in shingles allow the similarity."""
    return F.least(F.col(x), F.col(y)) >= SIMILARITY * F.greatest(F.col(x), F.col(y))


def hub_pairs(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored buckets (key, uid, size, members, hub) of two and more, and the pairs with the hub.

    `members` has key, uid and size. A member's weight is the number of texts it meets in all its
    buckets; the heaviest is the hub. Sums and maxima are taken before the shuffles. What was summed
    by key is stored before it is joined by key: straight from the sum, Spark could not split a
    large key in the join.
    """
    counts = stored(
        members.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "counts"
    )
    shared = members.join(counts, "key")
    weights = shared.groupBy("uid").agg(F.sum("members").alias("weight"))
    shared = stored(shared.join(weights, "uid"), "buckets")
    hubs = stored(
        shared.groupBy("key").agg(
            F.max(F.struct("weight", F.negative("uid").alias("least"), "size")).alias("hub")
        ),
        "heaviest",
    )
    buckets = stored(
        shared.join(hubs, "key").select(
            "key", "uid", "size", "members", F.negative("hub.least").alias("hub"), F.col("hub.size").alias("hub_size")
        ),
        "hubs",
    )
    pairs = (
        buckets.where("uid <> hub").where(_fits("size", "hub_size"))
        .select(F.least("uid", "hub").alias("a"), F.greatest("uid", "hub").alias("b")).distinct()
    )
    return buckets, pairs


def differences(x: np.ndarray, hub: np.ndarray) -> np.ndarray:
    """What a text's labelled shingles have more or less than its hub's, told apart by hash."""
    x, hub = labelled(shingles(x)), labelled(shingles(hub))
    return np.concatenate([
        np.setdiff1d(x, hub, assume_unique=True),
        mix(np.setdiff1d(hub, x, assume_unique=True) ^ np.uint64(0x5851F42D4C957F2D)),
    ])


def _counted(batches: Iterator[pa.RecordBatch], values) -> Iterator[pa.RecordBatch]:
    """(hub, part, counts) from batches of (hub, part, ..): counts added up by hub, COUNTS_HELD at most.

    Counts end at 255 and go on packed, since most cells of a task are empty.
    """
    held: dict[tuple[int, int], np.ndarray] = {}
    size = 0

    def made() -> pa.RecordBatch:
        keys = list(zip(*held))
        return pa.RecordBatch.from_arrays(
            [*(pa.array(k, pa.int64()) for k in keys), pa.array([zlib.compress(c, 1) for c in held.values()], pa.binary())],
            names=["hub", "part", "counts"],
        )

    for batch in batches:
        for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in ("hub", "part")))):
            cells, at, counts = values(batch, i)
            if key not in held:
                if size + cells > COUNTS_HELD and held:
                    yield made()
                    held.clear()
                    size = 0
                held[key] = np.zeros(cells, np.uint8)
                size += cells
            own = held[key]
            own[at] = np.minimum(own[at].astype(np.int64) + counts, 255)
    if held:
        yield made()


def token_counts(told: DataFrame) -> DataFrame:
    """Stored (hub, counts): for each hub, how many texts have a token of each of its cells.

    `told` has hub, cells and tokens. A token's cell follows from its number, so a cell counts a text
    too many at times, never one too few. Tasks add up their own counts; the counts of a hub meet in
    two steps.
    """
    def of_tokens(batch: pa.RecordBatch, i: int):
        cells = batch.column("cells")[i].as_py()
        tokens = batch.column("tokens")[i].values.to_numpy(zero_copy_only=False)
        return cells, *np.unique(tokens & (cells - 1), return_counts=True)

    def of_counts(batch: pa.RecordBatch, i: int):
        counts = np.frombuffer(zlib.decompress(batch.column("counts")[i].as_py()), np.uint8)
        return len(counts), slice(None), counts

    kind = "hub long, part long, counts binary"
    part = F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(32))
    counts = told.select("hub", F.lit(0).cast("long").alias("part"), "cells", "tokens").mapInArrow(
        lambda batches: _counted(batches, of_tokens), kind
    )
    for key in (part, F.lit(0)):
        counts = (
            counts.withColumn("part", key.cast("long")).repartition("hub", "part").sortWithinPartitions("hub", "part")
            .mapInArrow(lambda batches: _counted(batches, of_counts), kind)
        )
    # What was added up in more than one go, if a task's counts were many, is added up at the end.
    return stored(counts.select("hub", "counts"), "token-counts")


def rarest(told: DataFrame) -> DataFrame:
    """(hub, token, uid, label, n, d, rest): the rare tokens that suffice, see by_differences.

    Tokens are ordered by the counts of their hub's cells, then by number, the same for all texts of
    a hub; tokens of one text alone are left out. A text's whole list stays within its row.
    """
    sizes = stored(
        told.groupBy("hub").agg(F.sum("d").alias("total"), F.count("*").alias("texts")), "sizes"
    ).withColumn("cells", F.lit(1).cast("long"))
    bits = F.least(F.greatest(F.ceil(F.log2(F.greatest("total", F.lit(1)) * 4.0)), F.lit(6)), F.lit(MOST_CELL_BITS))
    sizes = sizes.withColumn("cells", F.pow(F.lit(2), bits).cast("long")).withColumn(
        "parts", F.ceil(F.col("texts") / TEXTS_AT_ONCE).cast("int")
    )
    dealt = told.join(sizes.select("hub", "cells", "parts"), "hub")
    counts = token_counts(dealt)
    spread = sizes.join(counts, "hub").select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "counts"
    )

    def cut(texts: pa.Table, counts: pa.Table) -> pa.Table:
        many = np.sum(
            [np.frombuffer(zlib.decompress(c.as_py()), np.uint8) for c in counts.column("counts")], axis=0, dtype=np.int64
        )
        rows, tokens, rests = [], [], []
        for i, (own, least) in enumerate(zip(texts.column("tokens"), texts.column("least").to_pylist())):
            own = own.values.to_numpy(zero_copy_only=False)
            often = many[own & (len(many) - 1)]
            own, often = own[often > 1], often[often > 1]  # what is left may be shared
            own = own[np.lexsort((own, often))][: max(0, len(own) - least + 1)]
            rows.append(np.full(len(own), i))
            tokens.append(own)
            rests.append(len(often) - 1 - np.arange(len(own)))
        kept = texts.select(["hub", "uid", "label", "n", "d"]).take(pa.array(np.concatenate(rows).astype(np.int64)))
        for name, parts in (("token", tokens), ("rest", rests)):
            kept = kept.append_column(name, pa.array(np.concatenate(parts).astype(np.int64)))
        return kept.select(["hub", "token", "uid", "label", "n", "d", "rest"])

    parted = dealt.withColumn("part", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"))
    return parted.select("hub", "part", "uid", "label", "n", "d", "least", "tokens").groupBy("hub", "part").cogroup(
        spread.groupBy("hub", "part")
    ).applyInArrow(cut, "hub long, token long, uid long, label long, n int, d int, rest long")


def by_differences(members: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs (a, b) of different labels with one hub that may be similar.

    `members` has uid, hub and their labels; the hub may be any text. Members that are like it but
    carry another label are paired with it.

    With d the number of a text's differences from the hub and n its shingles, two texts are similar
    if their differences differ in no more than (n + n') / 9; so they share at least half of
    d + d' - (n + n') / 9. For a text unlike the hub, with d = (n + h) / 9 + e, that is 0.9 e or
    more whatever the other one is; for a text like the hub, 4 d / 9 with any text unlike it. A
    difference of one text alone is shared with none. Similarity here is that of sets, which bounds the
    aligned one. So of the others, rarest first, all but the
    last few suffice to meet every partner, and the `rest` behind a token bounds what can be shared.
    """

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, sizes, least, like = [], [], [], []
            for x, hub in zip(batch.column("x"), batch.column("y")):
                x, hub = (np.frombuffer(w.as_py(), "<u4").astype(np.uint64) for w in (x, hub))
                own = differences(x, hub)
                n, h = len(x) - SHINGLE_WORDS + 1, len(hub) - SHINGLE_WORDS + 1
                beyond = len(own) - (n + h) * _APART
                lists.append(own.astype(np.int64))
                like.append(beyond <= 1e-9)
                sizes.append(n)
                least.append(max(1, int(np.ceil((0.9 * beyond if beyond > 0 else 4 / 9 * len(own)) - 1e-9))))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.select(["uid", "hub", "label", "hub_label"]).columns,
                    pa.array(sizes, pa.int32()), pa.array([len(t) for t in lists], pa.int32()),
                    pa.array(least, pa.int32()), pa.array(like, pa.bool_()), pa.array(lists, pa.list_(pa.int64())),
                ],
                names=["uid", "hub", "label", "hub_label", "n", "d", "least", "like", "tokens"],
            )

    told = stored(
        members.join(words.select("uid", F.col("words").alias("x")), "uid")
        .join(words.select(F.col("uid").alias("hub"), F.col("words").alias("y")), "hub")
        .select("uid", "hub", "label", "hub_label", "x", "y")
        .mapInArrow(
            tell,
            "uid long, hub long, label long, hub_label long, n int, d int, least int, like boolean, "
            "tokens array<long>",
        ),
        "differences",
    )
    first = stored(rarest(told), "rare")
    # Only tokens of two labels can link anything.
    mixed = stored(
        first.groupBy("hub", "token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high").select("hub", "token"),
        "mixed-tokens",
    )
    first = stored(first.join(mixed, ["hub", "token"], "left_semi"), "mixed-rare")
    other = first.select("hub", "token", *[F.col(c).alias(f"{c}_2") for c in ("uid", "label", "n", "d", "rest")])
    # A pair's first common token has all it shares at or behind it; later ones need not find it again.
    bound = F.least("rest", "rest_2") + 1
    need = (F.col("d") + F.col("d_2") - (F.col("n") + F.col("n_2")) * _APART) / 2 - 1e-9
    shared = first.join(other, ["hub", "token"]).where("uid < uid_2 and label <> label_2").where(
        _fits("n", "n_2") & (bound >= need)
    ).select(F.col("uid").alias("a"), F.col("uid_2").alias("b"))
    with_hub = told.where("like and label <> hub_label").select(
        F.least("uid", "hub").alias("a"), F.greatest("uid", "hub").alias("b")
    )
    return shared.unionByName(with_hub).distinct()


def left_pairs(buckets: DataFrame, labels: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs (a, b) of different classes that share a bucket and may be similar.

    `labels` has node and label of the texts linked so far.
    """
    marked = buckets.join(
        labels.select(F.col("node").alias("uid"), "label"), "uid", "left"
    ).withColumn("label", F.coalesce("label", "uid"))
    mixed = stored(
        marked.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .where("low <> high").select("key"),
        "mixed",
    )
    marked = stored(marked.join(mixed, "key").select("key", "uid", "size", "members", "hub", "label"), "left")

    small = marked.where(F.col("members") <= SMALL_BUCKET)
    other = small.select("key", *[F.col(c).alias(f"{c}_2") for c in ("uid", "size", "label", "hub")])
    near = small.join(other, "key").where(
        "uid < uid_2 and label <> label_2 and uid <> hub and uid_2 <> hub"
    ).where(_fits("size", "size_2")).select(F.col("uid").alias("a"), F.col("uid_2").alias("b")).distinct()

    large = marked.where(F.col("members") > SMALL_BUCKET)
    hubs = large.where("uid = hub").select("hub", F.col("label").alias("hub_label"), "members")
    # Buckets whose hubs are linked refer to one of them, the hub of the largest.
    heads = stored(
        hubs.groupBy("hub_label").agg(F.max(F.struct("members", "hub")).alias("head"))
        .select("hub_label", F.col("head.hub").alias("head")),
        "heads",
    )
    of_hub = stored(hubs.select("hub", "hub_label").distinct().join(heads, "hub_label"), "references")
    far = by_differences(
        large.join(of_hub, "hub").select("uid", F.col("head").alias("hub"), "label", "hub_label")
        .where("uid <> hub").distinct(),
        words,
    )
    return near.unionByName(far).distinct()


def classes(docs: DataFrame, text: str = "text", order_by: str = "doc_id",
            keep: list[str] | None = None) -> DataFrame:
    """Rows of `docs` as a struct `row` (its columns `keep`), with `class_id`, `first` and `links`.

    `class_id` is the least `order_by` of the class, `first` marks one row of it, the first by
    `order_by` (nulls last). `links` counts the similar texts found for the row's text, copies not
    counted. Texts with the same words, in whatever case and punctuation, are in one class. Texts
    without a word (null and empty ones too) are all alike and form one class; texts of one to four
    words are like none but their own copies. Rows that repeat are rows of one class.
    """
    rows = stored(sketched(docs, text, keep), "sketches")
    by = F.col("row")[order_by]
    place = F.struct(by.isNull().alias("null"), by.alias("by"), F.col("uid").alias("at"))
    texts = rows.groupBy("a", "b").agg(
        F.min("uid").alias("uid"), F.min(place).alias("first"), F.any_value("keys").alias("keys"),
        F.max("n").alias("n"),
    )
    texts = stored(texts, "texts")
    members = texts.where(f"n >= {SHINGLE_WORDS}").select(
        F.explode("keys").alias("key"), "uid", (F.col("n") - SHINGLE_WORDS + 1).alias("size")
    )
    buckets, pairs = hub_pairs(members)
    known = stored(buckets.select("uid").distinct(), "known")
    words = stored(rows.select("uid", "words").join(known, "uid"), "words")
    links = stored(verify(pairs, words), "links")
    more = left_pairs(buckets, components(links), words)
    links = stored(links.unionByName(verify(more, words)).distinct(), "links")
    labels = components(links)
    degrees = (
        links.select(F.explode(F.array("a", "b")).alias("uid")).groupBy("uid").agg(F.count("*").alias("links"))
    )
    labelled_texts = (
        texts.select("a", "b", "uid", "first")
        .join(labels.select(F.col("node").alias("uid"), "label"), "uid", "left")
        .join(degrees, "uid", "left")
        .withColumn("label", F.coalesce("label", "uid"))
    )
    heads = stored(labelled_texts.groupBy("label").agg(F.min("first").alias("head")), "heads")
    named = stored(
        labelled_texts.join(heads, "label").select(
            "a", "b", "head", F.coalesce("links", F.lit(0)).cast("long").alias("links")
        ),
        "named",
    )
    return rows.select("row", "a", "b", "uid").join(named, ["a", "b"]).select(
        "row", F.col("head.by").alias("class_id"), "links", (F.col("uid") == F.col("head.at")).alias("first"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return classes(docs, keep=["doc_id"]).select("row.doc_id", "class_id", "links")
