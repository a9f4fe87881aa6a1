"""Ranked lexical search: NRA over impact-sorted lists.

Only the items' terms are indexed: one pass over the texts counts them per document, and a posting
holds its impact, what the term adds to the document's score. Documents are dealt into shards, and
each shard has, for each term, its postings in falling order of impact.

An item is searched in a shard by sequential reads of its terms' lists alone. Every document has an
interval: below, what its postings read so far add up to; above, that and for each term not met yet
the last impact read from its list, as nothing later in it can be higher. Reading goes on, twice as
deep each time, until every document whose upper end reaches the k-th best lower end is read
completely. So membership, ties and scores are exact. The best of all shards are ranked last.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import table
from tarmac.llm.exact_dedup import LOWER, UPPER
from tarmac.session import fits_broadcast, stored

#: What stands between terms: all ASCII characters but letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
#: How far a term's weight is spread, and the parts of the length norm.
SCALE, SPREAD, NORM, SHARE = 1000, 1_000_000_000, 8, 75
#: Postings of a shard, and (item, term) rows of a block of items, on average.
SHARD_POSTINGS = 1 << 17
BLOCK_TERMS = 1 << 16
#: Depth of the first read of a list.
FIRST_READ = 128


def terms(text: Column) -> Column:
    """The terms of a text in order, with an empty one where the text begins or ends between terms."""
    return F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), BETWEEN)


def _length(found: str) -> Column:
    """How many terms are in an array made by `terms`."""
    many = F.size(found)
    return (
        many - (F.element_at(found, 1) == "").cast("int")
        - ((many > 1) & (F.element_at(found, -1) == "")).cast("int")
    ).cast("long")


def _joined(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """`left` joined with a stored `right`, which is sent to all executors only if it is small."""
    return left.join(F.broadcast(right) if fits_broadcast(right) else right, on)


def item_terms(items: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored (item, row) of `items`, (word, term) of their terms by number, (item, term, times)."""
    rows = stored(
        items.select(F.struct("*").alias("row"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("item")),
        "items",
    )
    words = stored(
        rows.select("item", F.explode(terms(F.col("text"))).alias("word")).where("word <> ''")
        .groupBy("item", "word").agg(F.count("*").alias("times")),
        "item-words",
    )
    vocabulary = stored(
        words.select("word").distinct().withColumn("term", F.monotonically_increasing_id()), "vocabulary"
    )
    entries = stored(words.join(vocabulary, "word").select("item", "term", "times"), "item-terms")
    return rows.select("item", "row"), vocabulary, entries


def postings(docs: DataFrame, vocabulary: DataFrame, text: str = "text", by: str = "doc_id") -> DataFrame:
    """Stored (by, uid, term, impact): what each term of `vocabulary` adds to the score of each row.

    `uid` is the row's number. Impacts of 0 are left out. The empty word, which every array of
    terms is given, keeps a row of each document with its length, so one pass over the texts counts
    the whole table too.
    """
    found = docs.select(
        F.col(by).alias("by"), F.monotonically_increasing_id().alias("uid"), terms(F.col(text)).alias("all")
    )
    words = found.select("by", "uid", _length("all").alias("n"), F.explode(F.concat(F.array(F.lit("")), "all")).alias("word"))
    wanted = stored(vocabulary.unionByName(vocabulary.sparkSession.createDataFrame([("", -1)], "word string, term long")), "wanted")
    counts = stored(
        _joined(words, wanted, "word").groupBy("by", "uid", "n", "term").agg(F.count("*").alias("tf")), "counts"
    )
    many, total = counts.where("term = -1 and n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(1))).first()
    counts = counts.where("term >= 0")
    weights = stored(
        counts.groupBy("term").agg(F.count("*").alias("df")).select(
            "term", F.floor(1000 * F.log(F.lit(2.0 * many + 2) / (2 * F.col("df") + 1))).cast("long").alias("weight")
        ),
        "weights",
    )
    norm = f"({100 - SHARE} + (({SHARE} * n * {many}L) div {total}L))"
    impact = F.expr(f"weight * (({SPREAD}L * tf) div ({SCALE} * tf + {NORM} * {norm}))")
    return stored(
        _joined(counts, weights, "term").select("by", "uid", "term", impact.alias("impact")).where("impact > 0"),
        "postings",
    )


# One shard.


def nra(lists: list[tuple[np.ndarray, np.ndarray]], documents: int, k: int = TOP) -> tuple[np.ndarray, np.ndarray]:
    """The k best documents and their scores, best first, ties to the smaller number.

    A list has the documents of one term and what it adds to each, in falling order.
    """
    below = np.zeros(documents, np.int64)
    seen = np.zeros((len(lists), documents), bool)
    last = np.array([scores[0] if len(scores) else 0 for _, scores in lists], np.int64)
    start, end = 0, FIRST_READ
    while True:
        for i, (where, scores) in enumerate(lists):
            if start < len(where):
                read = where[start:end]
                below[read] += scores[start:end]
                seen[i, read] = True
                last[i] = scores[end - 1] if end < len(scores) else 0
        above = below + last.sum() - last @ seen
        least = max(1, np.partition(below, documents - k)[documents - k] if documents > k else 1)
        alive = np.flatnonzero(above >= least)
        if (above[alive] == below[alive]).all():
            alive = alive[below[alive] > 0]
            best = alive[np.lexsort((alive, -below[alive]))][:k]
            return best, below[best]
        start, end = end, 2 * end


def _numbered(shard: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The shard's documents in order of `by` (nulls last) and uid, and each posting's document."""
    uids, first, own = np.unique(shard.column("uid").to_numpy(), return_index=True, return_inverse=True)
    docs = shard.select(["by", "uid"]).take(pa.array(first))
    order = pa.compute.sort_indices(docs, [("by", "ascending"), ("uid", "ascending")], null_placement="at_end").to_numpy()
    place = np.empty(len(uids), np.int64)
    place[order] = np.arange(len(uids))
    return docs.take(pa.array(order)), place[own]


def _search_shard(shard: pa.Table, block: pa.Table, k: int) -> Iterator[tuple[int, pa.Table, np.ndarray]]:
    """For each item of the block, its number, its best documents of the shard and their scores."""
    docs, own = _numbered(shard)
    term, impact = shard.column("term").to_numpy(), shard.column("impact").to_numpy()
    order = np.lexsort((own, -impact, term))
    term, impact, own = term[order], impact[order], own[order]
    names, starts = np.unique(term, return_index=True)
    ends = np.append(starts[1:], len(term))
    entries = pa.compute.list_flatten(block.column("entries")).combine_chunks()
    item, wanted, times = (entries.field(n).to_numpy() for n in ("item", "term", "times"))
    at = np.searchsorted(names, wanted)
    there = np.flatnonzero(names[np.minimum(at, len(names) - 1)] == wanted)
    there = there[np.argsort(item[there], kind="stable")]
    for part in np.split(there, np.flatnonzero(np.diff(item[there])) + 1) if len(there) else []:
        lists = [(own[starts[at[j]] : ends[at[j]]], impact[starts[at[j]] : ends[at[j]]] * times[j]) for j in part]
        best, scores = nra(lists, len(docs), k)
        yield item[part[0]], docs.take(pa.array(best)), scores


# All shards.


def search(docs: DataFrame, items: DataFrame, text: str = "text", by: str = "doc_id",
           item_text: str = "text", k: int = TOP) -> DataFrame:
    """(row, rank, by, score): the k best documents for each row of `items`, itself the struct `row`.

    Equal scores rank by ascending `by`, nulls last, then by place in the table. Rows that repeat, of
    either table, count as documents or items of their own. Null texts have no terms; items without a
    term of any document, and empty tables, give no rows.
    """
    rows, vocabulary, entries = item_terms(items, item_text)
    found = postings(docs, vocabulary, text, by)
    shards = max(1, -(-found.count() // SHARD_POSTINGS))
    blocks = max(1, -(-entries.count() // BLOCK_TERMS))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    lists = found.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int")).withColumn("block", numbers(blocks))
    packed = stored(
        entries.groupBy(F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block"))
        .agg(F.collect_list(F.struct("item", "term", "times")).alias("entries")),
        "blocks",
    ).withColumn("shard", numbers(shards))
    kind = found.schema["by"].dataType.simpleString()

    def best(shard: pa.Table, block: pa.Table) -> pa.Table:
        parts = _search_shard(shard, block, k) if len(shard) and len(block) else ()
        tables = [
            there.append_column("item", pa.array(np.full(len(there), item)))
            .append_column("score", pa.array(scores)).select(["item", "by", "uid", "score"])
            for item, there, scores in parts
        ]
        if tables:
            return pa.concat_tables(tables)
        return shard.select(["by", "uid"]).slice(0, 0).append_column("item", pa.array([], pa.int64())).append_column(
            "score", pa.array([], pa.int64())).select(["item", "by", "uid", "score"])

    keys = ["shard", "block"]
    told = lists.groupBy(*keys).cogroup(packed.groupBy(*keys)).applyInArrow(
        best, f"item long, by {kind}, uid long, score long"
    )
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("by"), "uid")
    ranked = told.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(rows, "item").select("row", "rank", "by", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return told.select("row.item_id", "rank", F.col("by").alias("doc_id"), "score")


_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^{BETWEEN[1:-2]}]+')"

SQL = f"""
WITH d AS (SELECT doc_id, {_TERMS} AS terms FROM documents),
size AS (SELECT count(*) FILTER (len(terms) > 0) AS docs, coalesce(sum(len(terms)), 1)::BIGINT AS total FROM d),
tf AS (
  SELECT doc_id, any_value(n) AS n, term, count(*) AS tf
  FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY doc_id, term
),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
impact AS (
  SELECT doc_id, term,
    floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
    * (({SPREAD} * tf) // ({SCALE} * tf + {NORM} * ({100 - SHARE} + (({SHARE} * n * docs) // total)))) AS impact
  FROM tf JOIN df USING (term), size
),
scores AS (
  SELECT item_id, doc_id, sum(impact)::BIGINT AS score
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) JOIN impact USING (term)
  GROUP BY item_id, doc_id HAVING sum(impact) > 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= {TOP}
"""
