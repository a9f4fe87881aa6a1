"""Ranked lexical search: intervals against full sums, and whole searches against brute force."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarmac.llm import lexical_search


@pytest.mark.parametrize("seed", range(8))
def test_intervals_against_full_sums(seed, monkeypatch):
    monkeypatch.setattr(lexical_search, "FIRST_READ", 1 + seed % 3)
    rng = np.random.default_rng(seed)
    n, k = int(rng.integers(1, 60)), int(rng.integers(1, 12))
    lists, total = [], np.zeros(n, np.int64)
    for _ in range(int(rng.integers(1, 7))):
        docs = rng.permutation(n)[: rng.integers(1, n + 1)]
        scores = -np.sort(-rng.integers(1, 6, len(docs)))
        total[docs] += scores
        lists.append((docs, scores))
    best, scores = lexical_search.nra(lists, n, k)
    want = [d for d in np.lexsort((np.arange(n), -total)) if total[d] > 0][:k]
    assert best.tolist() == want and scores.tolist() == total[want].tolist()


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, k=10):
    found = [(d, Counter(words(t)), len(words(t))) for d, t in docs]
    many, total = sum(n > 0 for *_, n in found), sum(n for *_, n in found)
    df = Counter(w for _, c, _ in found for w in c)
    out = []
    for item, text in items:
        scores = []
        for place, (doc, c, n) in enumerate(found):
            s = 0
            for w in words(text):
                if c[w]:
                    weight = math.floor(1000 * math.log((2 * many + 2) / (2 * df[w] + 1)))
                    s += weight * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * (25 + (75 * n * many) // total)))
            if s > 0:
                scores.append((-s, doc is None, doc or 0, place))
        out += [(item, i + 1, None if no else doc, -s) for i, (s, no, doc, _) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def test_search_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "SHARD_POSTINGS", 300)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 40)
    monkeypatch.setattr(lexical_search, "FIRST_READ", 2)
    rng = np.random.default_rng(5)
    vocabulary = ["The", "the", "a", "Élan", "élan", "x1", "42", "日本", "𝄞z", "q"] + [f"w{i}" for i in range(40)]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    text = lambda n: " ".join(rng.choice(vocabulary, n, p=weights / weights.sum())) + "."
    docs = [(i, text(int(rng.integers(1, 60)))) for i in range(200)]
    docs += [(300 + i, docs[i][1]) for i in range(20)] + [(5, docs[5][1])] * 3 + [(None, docs[7][1]), (None, docs[7][1])]
    docs += [(400, None), (401, ""), (402, " !?\0 "), (403, "the " * 50_000)]
    items = [(i, text(12)) for i in range(15)] + [(15, None), (16, "nowhere"), (None, "the w3 w3"), (3, "élan élan x1"), (3, "élan élan x1")]
    made = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1).withColumns({"term": F.lit(1), "uid": F.lit("u"), "n": F.lit(0)})
    asked = spark.createDataFrame(items, "item_id long, text string").coalesce(1).withColumns({"rank": F.lit(9), "by": F.lit(9), "item": F.lit(1)})
    got = [tuple(r) for r in lexical_search.search(made, asked).select("row.item_id", "rank", "by", "score").collect()]
    assert sorted(got, key=str) == brute(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(docs.where("false"), items).isEmpty()
    assert lexical_search.search(docs, items.where("false")).isEmpty()
    assert lexical_search.search(docs, items).count() == 1
