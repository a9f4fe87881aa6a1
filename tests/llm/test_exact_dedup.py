"""Exact dedup: the hash of a shard, the index over deliveries, and the classes."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from tarmac.llm import exact_dedup


def sha(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return hashlib.sha256(low.encode()).digest()


def test_slots_are_minimal_and_perfect():
    for n in (0, 1, 2, 7, 500, 6000):
        words = exact_dedup._words([sha(str(i)) for i in range(n)])
        levels = exact_dedup.cascade(words)
        assert sorted(exact_dedup.slots(words, levels)) == list(range(n))
        other = exact_dedup._words([sha(f"x{i}") for i in range(100)])
        assert ((exact_dedup.slots(other, levels) >= -1) & (exact_dedup.slots(other, levels) < max(n, 1))).all()


def brute(rows):
    groups = {}
    for i, (doc, text) in enumerate(rows):
        groups.setdefault(sha(text), []).append((doc is not None, doc or 0, -i, doc))
    return sorted(
        ((doc, max(groups[sha(text)])[3], len(groups[sha(text)]), sha(text).hex()) for doc, text in rows), key=str
    )


def told(frame):
    return sorted(
        ((r.doc_id, r.keep_id, r.group_size, r.sha) for r in frame.select("row.doc_id", "keep_id", "group_size", F.lower(F.hex("digest")).alias("sha")).collect()),
        key=str,
    )


def test_classes_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARD", 16)
    rng = np.random.default_rng(3)
    texts = [f"Text {i} ÀÉ" for i in range(150)] + ["", None, " ", "TEXT 1 ÀÉ", "text 1 àé", "long " * 200_000]
    rows = [(i, texts[j]) for i, j in enumerate(rng.integers(0, len(texts), 500))]
    rows += [(None, "Text 3 ÀÉ"), (None, "alone"), (None, "alone"), (7, "Same"), (7, "same"), (7, "same")]
    rows += [(1000 + i, "very common") for i in range(250)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"digest": F.lit("x"), "winner": F.lit(1), "uid": F.lit(2), "copies": F.lit("c"), "row": F.lit(3)}
    ).repartition(3)
    want = brute(rows)
    # Whatever the index holds: some, nothing, all.
    for earlier in (F.col("row.doc_id") % 3 == 0, F.lit(False), F.lit(True), F.lit(None).cast("boolean")):
        got = exact_dedup.classes(docs, earlier).cache()
        assert told(got) == want
        assert got.where("kept").groupBy("digest").count().where("count = 1").count() == len({w[3] for w in want})
        assert got.where("kept and not (keep_id <=> row.doc_id)").isEmpty()


def test_index_over_three_deliveries(spark):
    rows = [(i, f"t{i * i % 23}") for i in range(60)]
    docs = exact_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string"))
    index = exact_dedup.build(exact_dedup.groups(docs.where("false")))
    for part in range(3):
        answers = exact_dedup.look_up(exact_dedup.groups(docs.where(f"row.doc_id % 3 = {part}")), index)
        index = exact_dedup.build(exact_dedup.absorb(answers, index))
    got = {(bytes(r.digest), r.by, r.copies) for r in index.select(F.inline(F.arrays_zip("digests", "winners.by", "copies"))).toDF("digest", "by", "copies").collect()}
    assert got == {(bytes.fromhex(s), keep, size) for _, keep, size, s in brute(rows)}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.classes(empty, F.lit(True)).isEmpty()
