"""Language identification as mixture inference.

Learning counts the letter trigrams of labelled texts per language. A document is a mixture of
languages: expectation-maximisation estimates their shares from the trigram likelihoods, and
languages join the set one by one as long as the penalised likelihood gains. The language with the
largest share is the prediction, its share the score.

Counting runs in tasks that keep one array per language and emit sums; the model (languages x
BUCKETS numbers) is what travels, whatever the size of the corpus.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import PIECE_CHARS, crc_of_id, small_batches, table

BUCKETS = 1 << 16
#: More values in the language column than this are refused: the model would not be small.
MOST_LANGUAGES = 256
UNKNOWN = "und"
_SMOOTHING = 0.5
_STEPS = 50
#: Neighbouring trigrams share letters; a third of them counts as independent evidence.
_EVIDENCE = 1 / 3


@functools.lru_cache(1)
def _letters() -> np.ndarray:
    """1 for letters, 2 for marks, 0 for all else in the basic plane."""
    kinds = {"L": 1, "M": 2}
    return np.array([kinds.get(unicodedata.category(chr(i))[0], 0) for i in range(1 << 16)], np.uint8)


def _piece_trigrams(text: str) -> tuple[np.ndarray, bool]:
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "replace"), np.uint32)
    kind = _letters()[np.where(points < 65536, points, 97)]
    space = kind == 0
    keep = np.ones(len(points), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    c = np.where(space, np.uint32(32), points)[keep]
    h = c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA77) + c[2:] * np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(16), bool((kind == 1).any())


def trigram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets and counts of a text's letter trigrams; None for null or without a letter."""
    if not text:
        return None
    text = text.lower()
    if len(text) <= PIECE_CHARS:
        found, letters = _piece_trigrams(text)
        if not letters:
            return None
        if len(found) <= BUCKETS:
            return found, np.ones(len(found), np.float32)
        counts = np.bincount(found, minlength=BUCKETS)
    else:
        counts, letters = np.zeros(BUCKETS, np.int64), False
        for at in range(0, len(text), PIECE_CHARS):
            found, any_letter = _piece_trigrams(text[max(at - 2, 0) : at + PIECE_CHARS])
            counts += np.bincount(found, minlength=BUCKETS)
            letters |= any_letter
        if not letters:
            return None
    some = np.flatnonzero(counts)
    return some, counts[some].astype(np.float32)


@dataclass
class Model:
    languages: list[str]
    #: BUCKETS x languages, each column summing to one.
    chances: np.ndarray


def count_trigrams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all rows with text and language, summed per task and then overall."""
    small_batches(docs.sparkSession)
    names = ["lang", "bucket", "n"]

    def emit(held: dict) -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)),
                 pa.array(counts[some])], names=names,
            )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for words, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                found = trigram_counts(words.as_py())
                if found is not None:
                    if lang not in held and len(held) >= 64:  # bounds the task's memory
                        yield from emit(held)
                        held.clear()
                    own = held.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    if len(found[0]) > BUCKETS // 4:
                        own += np.bincount(found[0], found[1], BUCKETS).astype(np.int64)
                    else:
                        np.add.at(own, found[0], found[1].astype(np.int64))
        yield from emit(held)

    labelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).cast("string"), F.col(lang).cast("string")
    )
    parts = labelled.mapInArrow(count, "lang string, bucket int, n long")
    return parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """The model of all labelled rows; no languages if there is none."""
    sums = count_trigrams(docs, text, lang)
    rows = sums.limit(BUCKETS * MOST_LANGUAGES + 1).toPandas()  # at most a row per bucket and language
    languages = sorted(rows["lang"].unique())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    chances = np.full((BUCKETS, len(languages)), _SMOOTHING)
    for j, one in enumerate(languages):
        own = rows[rows["lang"] == one]
        chances[own["bucket"].to_numpy(), j] += own["n"].to_numpy()
    return Model(languages, (chances / chances.sum(axis=0)).astype(np.float32))


def _shares(own: np.ndarray, weights: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, float]:
    """Shares of the columns of `own` by expectation-maximisation, and the log-likelihood."""
    total, last = weights.sum(), -np.inf
    for _ in range(_STEPS):
        mixed = own @ shares
        now = float(weights @ np.log(mixed))
        shares = shares * ((weights / mixed) @ own) / total
        if now - last < 0.01:
            break
        last = now
    return shares, now


def mixture(found: tuple[np.ndarray, np.ndarray], model: Model) -> tuple[list[int], np.ndarray]:
    """The language set of a document, largest share first, and the shares."""
    buckets, weights = found
    chances = model.chances[buckets]
    alone = weights @ np.log(chances)
    chosen, best = [int(alone.argmax())], float(alone.max())
    shares = np.ones(1)
    penalty = 0.5 * np.log(weights.sum() * _EVIDENCE + 1) / _EVIDENCE
    while len(chosen) < len(model.languages):
        # The gain of the likelihood for a first bit of each language.
        pull = (weights / (chances[:, chosen] @ shares)) @ chances / weights.sum()
        pull[chosen] = 0
        one = int(pull.argmax())
        if pull[one] <= 1:
            break
        trial = [*chosen, one]
        begin = np.append(shares * 0.8, 0.2).astype(np.float32)
        new, value = _shares(chances[:, trial], weights, begin)
        if value - best <= penalty:
            break
        chosen, best, shares = trial, value, new
    order = np.lexsort((chosen, -shares))
    return [chosen[i] for i in order], shares[order] / shares.sum()


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Rows of `docs` as a struct `row`, with lang_pred, score and languages (set with shares).

    Only the text column is looked at. Null texts and texts without a letter get `und`, score 0;
    so does every text if the model knows no language. Equal likelihoods go to the language that
    sorts first. All rows stay.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("row"))
    names = model.languages

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops, scores, sets = [], [], []
            for words in batch.column("row").field(text):
                found = trigram_counts(words.as_py()) if names else None
                if found is None:
                    tops.append(UNKNOWN), scores.append(0.0), sets.append("")
                    continue
                chosen, shares = mixture(found, model)
                tops.append(names[chosen[0]])
                scores.append(float(min(max(shares[0], 0), 1)))
                sets.append(",".join(f"{names[i]}:{s:.3f}" for i, s in zip(chosen, shares)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(tops, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(sets, pa.string())],
                names=["row", "lang_pred", "score", "languages"],
            )

    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double, languages string"
    return rows.mapInArrow(judge, schema)


def fold(name: str = "doc_id"):
    """Which of three folds a document is in; fold 1 is held out. Null ids are in none."""
    return crc_of_id(name) % 3


def learn_from_table(spark: SparkSession, sf_dir: str) -> Model:
    """The model of the documents that are not held out."""
    return learn(table(spark, sf_dir, "documents").select("doc_id", "text", "lang").where(fold() != 1))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return predict(docs, learn_from_table(spark, sf_dir)).select(
        F.col("row.doc_id").alias("doc_id"),
        F.coalesce(fold("row.doc_id") == 1, F.lit(False)).alias("held_out"),
        "lang_pred", "score", "languages",
    )
