"""Secrets in texts: a trigram index chooses the texts, regular expressions confirm.

Each rule's expression yields a Boolean query over trigrams (see trigrams.py). The trigrams that
some query names are looked up in every text, which gives postings (trigram, text); postings are
intersected per text, and a rule's expression runs only on the texts its query leaves. Rules
without a mandatory trigram (a run of hex digits) scan every text. Everything is built-in Spark
expressions.

Texts are known by a 128-bit digest of their content, so copies are indexed once and neither null
nor repeated ids matter.

Positions come from splitting the text at the matches: a match starts after the pieces and
matches before it. Positions are code points, ends exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import table
from tarmac.llm.trigrams import trigram_query
from tarmac.session import settle


@dataclass(frozen=True)
class Rule:
    """A match counts if `group` of it has `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


_ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
#: The base rules; each finds its leftmost non-overlapping matches and drops the failing ones.
BASE = [
    Rule("assign", _ASSIGN, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    # Runs of 24 are the long ones among all runs: a greedy run cannot start inside another.
    Rule("hex", r"[0-9a-f]{24,}"),
]
#: Published formats of keys and tokens.
ADDED = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
]
RULES = BASE + ADDED
#: Candidates of up to this many bytes (24 a row) go to every executor.
BROADCAST_BYTES = 8 << 20


def _digest(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(7)).alias("b"))


def trigram_postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, key) for each of the trigrams in each lower-case text of (key, text)."""
    # The one-element array keeps the lower-case text from being made anew for each trigram.
    found = F.transform(
        F.array(F.lower("text")),
        lambda low: F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(low, t)),
    )
    return texts.select("key", F.explode(found[0]).alias("trigram"))


def candidates(texts: DataFrame, rules: list[Rule]) -> DataFrame:
    """(key, kinds): the rules whose trigram query holds for the text, for texts with any such."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    trigrams = sorted({t for q in queries.values() for alternative in q for t in alternative})
    lists = (
        trigram_postings(texts, trigrams)
        .groupBy("key").agg(F.collect_set("trigram").alias("has"))  # no more than the queries name
    )
    kinds = [
        F.when(
            F.exists(
                F.array(*[F.array(*map(F.lit, a)) for a in query]),
                lambda a: F.size(F.array_intersect(a, F.col("has"))) == F.size(a),
            ),
            F.lit(kind),
        )
        for kind, query in queries.items()
    ]
    return lists.select("key", F.array_compact(F.array(*kinds)).alias("kinds")).where(
        F.size("kinds") > 0
    )


def _spans(text: Column, rule: Rule) -> Column:
    """The rule's matches in a text as an array of (start, kind place, kind, end)."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    told = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    pieces = F.split(text, rule.pattern, -1)
    # (place in the text, matches so far) carried over the matches.
    start = F.struct(
        F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out")
    )

    def step(state: Column, match: Column) -> Column:
        begin = state["at"] + F.length(match["before"])
        end = begin + F.length(match["whole"])
        span = F.struct(begin.alias("start"), end.alias("end"))
        kept = F.length(match["told"]) >= rule.least
        return F.struct(
            end.alias("at"),
            F.when(kept, F.concat(state["out"], F.array(span))).otherwise(state["out"]).alias("out"),
        )

    matches = F.arrays_zip(
        found.alias("whole"),
        told.alias("told"),
        F.slice(pieces, 1, F.size(found)).alias("before"),
    )
    return F.aggregate(matches, start, step)["out"]


def find(docs: DataFrame, rules: list[Rule] = RULES, text: str = "text") -> DataFrame:
    """Rows of `docs` as a struct `row`, with `spans`: array of (start, place, kind, end).

    Spans are sorted by start, then by the place of their rule. Null texts count as empty and
    have no spans; every row stays, repeated or not, whatever its other columns are called.
    """
    rows = docs.select(
        F.struct("*").alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    keyed = rows.withColumn("key", _digest(F.col("text")))
    chosen = settle(candidates(keyed.select("key", "text"), rules))
    small = chosen.count() * 24 <= BROADCAST_BYTES
    # Without the small side's hint, rows move once by key; AQE splits the keys of large groups.
    marked = keyed.join(F.broadcast(chosen) if small else chosen, "key", "left")
    parts = []
    for place, rule in enumerate(rules):
        nothing = F.array().cast("array<struct<start:int,place:int,kind:string,end:int>>")
        spans = F.transform(
            _spans(F.col("text"), rule),
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(place).alias("place"),
                F.lit(rule.kind).alias("kind"), s["end"].alias("end"),
            ),
        )
        if trigram_query(rule.pattern) is not None:
            wanted = F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False))
        else:
            wanted = F.col("text").rlike(rule.pattern)
        parts.append(F.when(wanted, spans).otherwise(nothing))
    return marked.select("row", F.array_sort(F.concat(*parts)).alias("spans"))


def spans_text(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """`docs` (with text and n_chars) with every found span replaced by `mark`.

    Overlapping spans become one mark. Null texts stay null; texts without a span stay as they are.
    """
    found = find(docs)
    text = F.col("row.text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        apart = span["start"] >= state["at"]
        before = F.substring(text, state["at"] + F.lit(1), span["start"] - state["at"])
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(apart, F.concat(state["out"], before, F.lit(mark)))
            .otherwise(state["out"]).alias("out"),
        )

    done = F.aggregate("spans", start, step)
    clean = F.concat(done["out"], F.substring(text, done["at"] + F.lit(1), F.length(text)))
    new = F.when(F.size("spans") > 0, clean).otherwise(text)
    columns = {c: F.col("row")[c] for c in docs.columns}
    columns["text"] = new
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.size("spans") > 0, F.length(new).cast("long")).otherwise(
            columns["n_chars"]
        )
    return found.select(*[value.alias(name) for name, value in columns.items()])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = [r.kind for r in BASE]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    of_base = F.filter("spans", lambda s: s["place"] < len(base))
    return find(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        *[count(kind).alias(f"n_{kind}") for kind in base],
        F.sha2(spans_text(of_base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def _sql() -> str:
    """The same spans in DuckDB, every rule scanning every text."""
    quoted = {r.kind: r.pattern.replace("'", "''") for r in RULES}
    parts = []
    for place, r in enumerate(RULES):
        parts.append(f"""
    SELECT n, {place} AS place, '{r.kind}' AS kind, whole[i] AS whole,
        list_sum([length(x) FOR x IN pieces[1:i]]) + coalesce(list_sum([length(x) FOR x IN whole[1:i - 1]]), 0) AS s
    FROM (SELECT n, regexp_extract_all(text, '{quoted[r.kind]}', 0) AS whole,
            regexp_extract_all(text, '{quoted[r.kind]}', {r.group}) AS told,
            string_split_regex(text, '{quoted[r.kind]}') AS pieces
        FROM docs WHERE regexp_matches(text, '{quoted[r.kind]}')), unnest(range(1, len(whole) + 1)) t(i)
    WHERE length(told[i]) >= {r.least}""")
    named = "kind || ':' || s || ':' || (s + length(whole))"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(parts)}),
told AS (
    SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg({named}, ',' ORDER BY s, place) FILTER (place < {len(BASE)}) AS base,
        string_agg({named}, ',' ORDER BY s, place) AS spans
    FROM spans GROUP BY n)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
    coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN told USING (n)
"""


SQL = _sql()
