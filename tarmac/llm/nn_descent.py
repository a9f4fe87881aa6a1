"""Approximate nearest neighbours by inner product: NN-descent builds the graph, greedy search asks it.

Vectors get one coordinate more, so that all are equally long and the largest inner product with a
query is the nearest vector. Equal vectors are one node. The graph starts from leaves of random
hyperplane trees; then, round by round, the neighbours of each node meet there, and each takes over
those of the others that are nearer than its farthest neighbour. Only pairs with a neighbour that is
new since the last round meet. A meeting gets the vectors in eight bits; scores that are returned
are computed on the original vectors in double precision.

A query starts from some pivots, and from its own node's neighbours if it is in the table. In each
round the neighbours of its best candidates not yet asked become candidates, until the best
BEAM have all been asked or ROUNDS are over.

NEIGHBOURS, MEETING and BEAM bound work by node, as the method does; they bound no result. What the
graph misses is measured as recall.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from tarmac.llm.common import small_batches, table
from tarmac.session import stored

NEIGHBOURS = 40
#: Leaves have about this many nodes; each tree gives a node its nearest of the leaf.
LEAF = 1024
TREES = 16
PER_TREE = 16
ITERATIONS = 3
#: Forward neighbours of either kind (new, old) that a node invites, and reverse ones it accepts.
MEETING = 20
#: Nearest that a member takes home from one meeting.
PER_MEETING = 4
BEAM = 64
ASKED = 16
ROUNDS = 5
#: Entries to the graph for queries: so many nodes by a hash, and so many of the longest vectors.
PIVOTS = 256
LONG_PIVOTS = 64
ENTRIES = 12
#: Vectors, first by a hash of their ids, on which the trees' thresholds are set.
SAMPLE = 10_000


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part, each row once.

    Null, empty and zero vectors, vectors with null or non-finite components and null ids take no
    part; nor do vectors of another length than the most frequent one (the smallest of equals).
    """
    v = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull()
        & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    top = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (top["n"] if top else 0)).distinct()


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _digest() -> Column:
    return F.struct(F.xxhash64("v").alias("a"), F.xxhash64("v", F.lit(7)).alias("b"))


def nodes_of(rows: DataFrame, k: int) -> DataFrame:
    """(uid, vec_id, nth, digest, v): the k + 1 smallest ids of each vector; uid is the smallest."""
    same = Window.partitionBy("digest").orderBy("vec_id")
    ranked = rows.withColumn("digest", _digest()).withColumn("nth", F.row_number().over(same))
    kept = ranked.where(F.col("nth") <= k + 1)
    firsts = kept.where("nth = 1").select("digest", F.col("vec_id").alias("uid"))
    return kept.join(firsts, "digest").select("uid", "vec_id", "nth", "digest", "v")


def _eight_bits(x: np.ndarray) -> list[bytes]:
    """Rows as a 32-bit scale and signed bytes."""
    scale = np.maximum(np.abs(x).max(axis=1), 1e-30) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    return [s.tobytes() + c.tobytes() for s, c in zip(scale.astype("<f4"), codes)]


def _unpacked(column, width: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column), np.uint8).reshape(-1, 4 + width)
    scale = np.ascontiguousarray(raw[:, :4]).view("<f4")
    return raw[:, 4:].view(np.int8).astype(np.float32) * scale


def packed(nodes: DataFrame, longest: float, query: bool = False) -> DataFrame:
    """(uid, code): vectors with their extra coordinate in eight bits, scaled to length one.

    A query's extra coordinate is zero, so products with it rank by the inner product.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("v").flatten().to_numpy().reshape(batch.num_rows, -1) / longest
                rest = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))
                if query:
                    rest = np.zeros_like(rest)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("uid"), pa.array(_eight_bits(np.hstack([x, rest])), pa.binary())],
                    names=["uid", "code"],
                )

    return nodes.select("uid", "v").mapInArrow(pack, "uid long, code binary")


def _top(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest of each node, each pair once; a pair known before stays old."""
    once = edges.groupBy("a", "b").agg(F.max("score").alias("score"), F.min("new").alias("new"))
    best = Window.partitionBy("a").orderBy(F.desc("score"), "b")
    return once.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).drop("r")


def first_graph(codes: DataFrame, n: int, width: int, seed: int = 1) -> DataFrame:
    """Edges (a, b, score, new) to the nearest in the leaves of random hyperplane trees."""
    depth = int(np.ceil(np.log2(n / LEAF))) if n > LEAF else 0
    trees, per_tree = (TREES, PER_TREE) if depth else (1, NEIGHBOURS)
    planes = np.random.default_rng(seed).standard_normal((trees, width, max(depth, 1))).astype(np.float32)
    sample = codes.orderBy(F.xxhash64("uid"), "uid").limit(SAMPLE).toPandas()
    middle = np.median(np.einsum("nw,twd->tnd", _unpacked(sample["code"], width), planes), axis=1)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unpacked(batch.column("code").to_pylist(), width)
            for t in range(trees):
                leaf = ((x @ planes[t]) > middle[t]) @ (1 << np.arange(planes.shape[2])) if depth else np.zeros(len(x), int)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((t << 40) + leaf.astype(np.int64)), *batch.columns], names=["leaf", "uid", "code"]
                )

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        x, ids = _unpacked(frame["code"], width), frame["uid"].to_numpy()
        out = []
        k = min(per_tree, len(x) - 1)
        for at in range(0, len(x) if k > 0 else 0, 512):
            s = x[at : at + 512] @ x.T
            s[np.arange(len(s)), at + np.arange(len(s))] = -np.inf
            near = np.argpartition(-s, k - 1, axis=1)[:, :k]
            out.append(pd.DataFrame({
                "a": np.repeat(ids[at : at + 512], k), "b": ids[near].ravel(),
                "score": np.take_along_axis(s, near, 1).ravel(),
            }))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": [], "score": []})

    dealt = codes.mapInArrow(deal, "leaf long, uid long, code binary")
    # Leaves that came out too large are cut by a hash.
    sizes = dealt.groupBy("leaf").agg(F.count("*").alias("size"))
    part = F.pmod(F.xxhash64("uid"), F.ceil(F.col("size") / (2 * LEAF)))
    edges = (
        dealt.join(sizes, "leaf").select("leaf", part.alias("part"), "uid", "code")
        .groupBy("leaf", "part").applyInPandas(meet, "a long, b long, score float")
    )
    return _top(edges.withColumn("new", F.lit(True)), NEIGHBOURS)


def descend(graph: DataFrame, codes: DataFrame, n: int, width: int, turn: int) -> DataFrame:
    """One round: neighbours of a node meet there, and the graph keeps the nearest found."""
    chance = F.xxhash64("a", "b", F.lit(turn))
    some = Window.partitionBy("a", "new").orderBy(chance)
    invited = stored(
        graph.withColumn("r", F.row_number().over(some)).withColumn("asked", F.col("r") <= MEETING).drop("r"),
        "asked",
    )
    forward = invited.where("asked").select(F.col("a").alias("at"), F.col("b").alias("uid"), "new")
    accepted = Window.partitionBy("at", "new").orderBy(F.xxhash64("at", "uid", F.lit(turn)))
    reverse = (
        forward.select(F.col("uid").alias("at"), F.col("at").alias("uid"), "new")
        .withColumn("r", F.row_number().over(accepted)).where(F.col("r") <= MEETING).drop("r")
    )
    farthest = graph.groupBy("a").agg(F.min("score").alias("least"), F.count("*").alias("n"))
    guests = codes.join(farthest.withColumnRenamed("a", "uid"), "uid", "left").select(
        "uid", "code", F.when(F.col("n") >= NEIGHBOURS, F.col("least")).otherwise(F.lit(-9.0)).cast("float").alias("least")
    )
    places = max(8, n // 512)

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        at, uid, new = (frame[c].to_numpy() for c in ("at", "uid", "new"))
        order = np.lexsort((~new, uid, at))
        at, uid, new = at[order], uid[order], new[order]
        once = np.append(True, (at[1:] != at[:-1]) | (uid[1:] != uid[:-1]))
        order, at, uid, new = order[once], at[once], uid[once], new[once]
        x, least = _unpacked(frame["code"].to_numpy()[order], width), frame["least"].to_numpy()[order]
        bounds = np.append(np.flatnonzero(np.append(True, at[1:] != at[:-1])), len(at))
        out = []
        for i, j in zip(bounds[:-1], bounds[1:]):
            f = new[i:j]
            if j - i < 2 or not f.any():
                continue
            s = x[i:j] @ x[i:j].T
            s[~(f[:, None] | f[None, :])] = -9
            np.fill_diagonal(s, -9)
            s[s <= least[i:j, None]] = -9
            k = min(PER_MEETING, j - i)
            near = np.argpartition(-s, k - 1, axis=1)[:, :k]
            values = np.take_along_axis(s, near, 1)
            rows, columns = np.nonzero(values > -9)
            out.append((uid[i:j][rows], uid[i:j][near[rows, columns]], values[rows, columns]))
        a, b, score = (np.concatenate(c) for c in zip(*out)) if out else ([], [], [])
        return pd.DataFrame({"a": a, "b": b, "score": score})

    found = (
        forward.unionByName(reverse).join(guests, "uid")
        .withColumn("place", F.pmod(F.xxhash64("at"), F.lit(places)))
        .groupBy("place").applyInPandas(meet, "a long, b long, score float")
    )
    old = invited.select("a", "b", "score", (F.col("new") & ~F.col("asked")).alias("new"))
    return _top(old.unionByName(found.withColumn("new", F.lit(True))), NEIGHBOURS)


def build(nodes: DataFrame, longest: float, n: int, width: int, iterations: int = ITERATIONS) -> DataFrame:
    """The neighbour graph (a, b, score) of nodes (uid, v)."""
    codes = stored(packed(nodes, longest), "codes")
    graph = stored(first_graph(codes, n, width), "graph")
    if n > LEAF:  # else the first graph is exact
        for turn in range(iterations):
            graph = stored(descend(graph, codes, n, width, turn), "graph")
    return graph.select("a", "b", "score")


def search(graph: DataFrame, nodes: DataFrame, asked: DataFrame, longest: float, width: int) -> DataFrame:
    """(q, b, score): the BEAM best nodes found for each query (uid, v) by greedy search.

    The uid of a query that is a node is that node's; others have a uid of their own.
    """
    codes = stored(packed(nodes, longest), "codes")
    queries = stored(packed(asked, longest, query=True), "queries")
    long = nodes.orderBy(F.desc(dot(F.col("v"), F.col("v"))), "uid").limit(LONG_PIVOTS).select("uid")
    some = codes.select("uid").orderBy(F.xxhash64("uid", F.lit(3)), "uid").limit(PIVOTS)
    pivots = codes.join(F.broadcast(long.unionByName(some).distinct()), "uid").toPandas()  # a few hundred
    ids, places = pivots["uid"].to_numpy(), _unpacked(pivots["code"], width)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not len(ids):
                continue
            s = _unpacked(batch.column("code").to_pylist(), width) @ places.T
            k = min(ENTRIES, len(ids))
            near = np.argpartition(-s, k - 1, axis=1)[:, :k]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("uid").to_numpy(), k)), pa.array(ids[near].ravel())], names=["q", "b"]
            )

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (_unpacked(batch.column(c).to_pylist(), width) for c in ("x", "y"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("q"), batch.column("b"), pa.array(np.einsum("ij,ij->i", x, y), pa.float32())],
                    names=["q", "b", "score"],
                )

    def scored(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(codes.select(F.col("uid").alias("b"), F.col("code").alias("y")), "b")
            .join(queries.select(F.col("uid").alias("q"), F.col("code").alias("x")), "q")
            .select("q", "b", "x", "y").mapInArrow(weigh, "q long, b long, score float")
        )

    own = queries.select(F.col("uid").alias("q"))
    entries = (
        queries.mapInArrow(enter, "q long, b long")
        .unionByName(own.join(codes.select(F.col("uid").alias("q")), "q").select("q", F.col("q").alias("b")))
        .unionByName(own.join(graph, F.col("a") == F.col("q")).select("q", "b"))
        .distinct()
    )
    state = stored(scored(entries).withColumn("asked", F.col("q") == F.col("b")), "beam")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "b")
    for _ in range(ROUNDS):
        ranked = state.withColumn("r", F.row_number().over(best))
        open_ = ranked.where((F.col("r") <= BEAM) & ~F.col("asked")).withColumn("r", F.row_number().over(best))
        chosen = stored(open_.where(F.col("r") <= ASKED).select("q", "b"), "chosen")
        if chosen.isEmpty():
            break
        new = (
            chosen.join(graph.select(F.col("a").alias("b"), F.col("b").alias("next")), "b")
            .select("q", F.col("next").alias("b")).distinct().join(state.select("q", "b"), ["q", "b"], "left_anti")
        )
        marked = state.join(chosen.withColumn("now", F.lit(True)), ["q", "b"], "left").select(
            "q", "b", "score", (F.col("asked") | F.coalesce("now", F.lit(False))).alias("asked")
        )
        state = stored(marked.unionByName(scored(new).withColumn("asked", F.lit(False))), "beam")
    return state.withColumn("r", F.row_number().over(best)).where(F.col("r") <= BEAM).select("q", "b", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query among the other rows.

    `vectors` has vec_id and embedding, other columns are not read; `is_query` is a condition on
    vec_id. Nearest first by inner product in double precision, ties to the smaller id. Rows with the
    same id and vector are one; a query's candidates leave out rows with its own id. Fewer than k
    other rows give them all; no usable vector gives no row.
    """
    spark = small_batches(vectors.sparkSession)
    rows = stored(usable(vectors), "vectors")
    known = stored(nodes_of(rows, k), "nodes")
    nodes = known.where("nth = 1").select("uid", "digest", "v")
    n, square, size = nodes.agg(F.count("*"), F.max(dot(F.col("v"), F.col("v"))), F.max(F.size("v"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest, width = float(np.sqrt(square)) * (1 + 1e-9), size + 1
    queries = stored(
        rows.where(is_query).select("vec_id", _digest().alias("digest"))
        .join(nodes.select("digest", "uid"), "digest").select(F.col("vec_id").alias("query_id"), "uid"),
        "asked",
    )
    asked = nodes.join(queries.select("uid").distinct(), "uid")
    graph = build(nodes, longest, n, width)
    found = search(graph, nodes, asked, longest, width)
    exact = (
        found.join(known.select(F.col("uid").alias("b"), "vec_id", F.col("v").alias("y")), "b")
        .join(asked.select(F.col("uid").alias("q"), F.col("v").alias("x")), "q")
        .select("q", "vec_id", dot(F.col("x"), F.col("y")).alias("score"))
    )
    # One more than asked for, as the query itself may be among them.
    first = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    short = stored(exact.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).drop("r"), "short")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        queries.withColumnRenamed("uid", "q").join(short, "q").where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
