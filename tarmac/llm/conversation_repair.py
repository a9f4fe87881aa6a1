"""Conversation repair: the cheapest edits that make turns alternate, found on a suffix-shared automaton.

A row's signature is one letter, its role and its fault; a conversation's is the word of its rows.
Words are cut into chunks of CHUNK letters, and all chunks of all conversations share one acyclic
automaton, minimised from the end: chunks with the same rest share the node of that rest. A node has,
for each grammar state before and after, the cost to go and the best audit, and they are worked out
once, level by level from the end, from those of the node one letter shorter. A conversation of more
than one chunk combines its chunks pairwise, which is associative.

The grammar of role initials is `(s?(ua)+)?`. Its states are START, after a system turn, after a user
turn and after an assistant turn; which role is inserted, or given to a row, follows from the state.
Keep, Rerole, Delete and Insert cost 0, 1, 2 and 5; an undeleted truncated row 5 more. Of cheapest
audits the least in ASCII order is taken. That order survives concatenation here: two audits of the
same rows between the same states end in a row's letter, so neither is the beginning of the other.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import small_batches, table
from tarmac.session import scratch, stored

#: Letters of a chunk, which bounds the levels of the automaton.
CHUNK = 16

START, SYSTEM, USER, ASSISTANT = "0", "s", "u", "a"
#: The state after a row that is given the role due, and that role.
DUE = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state after a row kept with its own role's initial.
KEPT = {
    (START, SYSTEM): SYSTEM, (START, USER): USER, (SYSTEM, USER): USER,
    (USER, ASSISTANT): ASSISTANT, (ASSISTANT, USER): USER,
}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: What is still to be inserted at the end.
ENDING = {START: 0, ASSISTANT: 0, USER: 1, SYSTEM: 2}
#: States a chunk can lead to from each state; system turns only come first.
REACHED = {START: "0sua", SYSTEM: "sua", USER: "ua", ASSISTANT: "ua"}
PATHS = [(q, r) for q, ends in REACHED.items() for r in ends]

#: Signature letters: role initial or o for any other, upper case if truncated, d if it has to go.
MUST_GO, OTHER = "d", "o"
SPACES = r"\x20\x09-\x0D"


def damage(conversations: DataFrame) -> DataFrame:
    """(conv, turn, role, text): the rows with their faults put in, chosen by a hash of conv_id and turn.

    Of crc32(`conv_id:turn`) modulo 20, 0 drops a row, 1 empties its text, 2 takes out its `.!?`, 3
    repeats it and 4 makes it the user's. Nulls are one space, but for conv_id and turn themselves.
    """
    space = F.lit(" ")
    text_of = lambda name: F.coalesce(F.col(name).cast("string"), space)
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").alias("conv"), "turn", text_of("role").alias("role"), text_of("text").alias("text"),
        kind.alias("kind"),
    ).where("kind <> 0")
    return rows.select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def numbered(rows: DataFrame) -> DataFrame:
    """Stored rows with `key`, the digest of role and text, and `uid`.

    A conversation's order is by turn, nulls first, then by key; the rest are equal rows.
    """
    key = F.unhex(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    return stored(rows.withColumn("key", key).withColumn("uid", F.monotonically_increasing_id()), "turns")


def signed(rows: DataFrame) -> DataFrame:
    """Stored (conv, turn, key, uid, initial, fault, letter) of numbered rows, without their texts.

    A row's fault is the first of blank, duplicate (an equal row of the conversation comes before)
    and truncated, or null.
    """
    place = F.struct(F.col("turn").isNotNull().alias("set"), "turn", "uid")
    again = stored(
        rows.groupBy("conv", "key").agg(F.min(place).alias("first"), F.count("*").alias("times"))
        .where("times > 1").select(F.col("conv").alias("conv_2"), F.col("key").alias("key_2"), "first.uid"),
        "repeated",
    ).withColumnRenamed("uid", "first")
    slim = rows.select(
        "conv", "turn", "key", "uid", F.substring("role", 1, 1).alias("initial"),
        F.col("text").rlike(f"[^{SPACES}]").alias("filled"),
        F.col("text").rlike(rf"[.!?][{SPACES}]*\z").alias("ended"),
    )
    marked = slim.join(again, F.col("conv").eqNullSafe(F.col("conv_2")) & (F.col("key") == F.col("key_2")), "left")
    fault = (
        F.when(~F.col("filled"), "blank").when(F.col("first") != F.col("uid"), "duplicate")
        .when(~F.col("ended"), "truncated")
    )
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise(OTHER)
    letter = (
        F.when(F.col("fault").isin("blank", "duplicate"), MUST_GO)
        .when(F.col("fault") == "truncated", F.upper(known)).otherwise(known)
    )
    return stored(
        marked.withColumn("fault", fault).select("conv", "turn", "key", "uid", "initial", "fault", letter.alias("letter")),
        "letters",
    )


def _illegal(before: Column, after: Column) -> Column:
    return (before.isNotNull() & ~F.concat(before, after).isin("su", "ua", "au")).cast("long")


def chunks(letters: DataFrame) -> DataFrame:
    """Stored (conv, seq, word, illegal): the chunks of each conversation in order.

    Rows are ordered by ranges, so that a long conversation is spread over tasks. It is cut after
    CHUNK rows, and where a range ends; chunks are numbered within ranges and ranges by their counts.
    `illegal` counts the adjacent initials, also across the cut before the chunk, that are not allowed.
    """
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("key"), F.asc("uid")]
    ordered = stored(
        letters.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv", "initial", "letter", F.monotonically_increasing_id().alias("at")),
        "ordered",
    ).withColumn("range", F.shiftright("at", 33))
    run = Window.partitionBy("conv", "range").orderBy("at")
    cut = ordered.select(
        "conv", "range", "at", "letter", "initial",
        F.floor((F.row_number().over(run) - 1) / CHUNK).cast("long").alias("block"),
        _illegal(F.lag("initial").over(run), F.col("initial")).alias("illegal"),
    )
    word = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "letter"))), lambda x: x.letter), "")
    pieces = stored(
        cut.groupBy("conv", "range", "block").agg(
            word.alias("word"), F.sum("illegal").alias("illegal"),
            F.min_by("initial", "at").alias("first"), F.max_by("initial", "at").alias("last"),
        ),
        "pieces",
    )
    ranges = Window.partitionBy("conv").orderBy("range")
    runs = stored(
        pieces.groupBy("conv", "range").agg(
            F.count("*").alias("blocks"), F.min_by("first", "block").alias("first"), F.max_by("last", "block").alias("last")
        ).select(
            F.col("conv").alias("conv_2"), F.col("range").alias("range_2"),
            (F.sum("blocks").over(ranges) - F.col("blocks")).alias("before"),
            _illegal(F.lag("last").over(ranges), F.col("first")).alias("across"),
        ),
        "runs",
    )
    same = F.col("conv").eqNullSafe(F.col("conv_2")) & (F.col("range") == F.col("range_2"))
    return stored(
        pieces.join(runs, same).select(
            "conv", (F.col("before") + F.col("block")).alias("seq"), "word",
            (F.col("illegal") + F.when(F.col("block") == 0, F.col("across")).otherwise(0)).alias("illegal"),
        ),
        "chunks",
    )


# The automaton.


def _best(q: str, r: str) -> str:
    return f"best_{q}{r}"


def _then(cost: Column | int, audit: str, rest: Column) -> Column:
    """Edits before `rest`, which is null where there is no way."""
    return F.when(
        rest.isNotNull(),
        F.struct((rest.cost + cost).alias("cost"), F.concat(F.lit(audit), rest.audit).alias("audit")),
    )


def _least(ways: list[Column]) -> Column:
    return F.least(*ways) if len(ways) > 1 else ways[0]


def _steps() -> tuple[list[Column], list[Column]]:
    """Bests of nodes by their first edit, from `letter` and the bests of the rest; then with inserts."""
    late = F.when(F.col("letter") == F.upper("letter"), TRUNCATED).otherwise(0)
    role = F.lower("letter")
    edited = {}
    for q, r in PATHS:
        rest = lambda state, r=r: F.col(_best(state, r)) if r in REACHED[state] else None
        ways = [_then(DELETE, "D", rest(q))]
        if rest(DUE[q]) is not None:
            ways.append(F.when(F.col("letter") != MUST_GO, _then(late + REROLE, "R", rest(DUE[q]))))
        for (state, own), after in KEPT.items():
            if state == q and rest(after) is not None:
                ways.append(F.when(role == own, _then(late, "K", rest(after))))
        edited[q, r] = _least(ways)
    edits = [way.alias(f"edit_{q}{r}") for (q, r), way in edited.items()]
    out = []
    for q, r in PATHS:
        ways, state = [], q
        for inserts in range(3):
            if r in REACHED[state]:
                ways.append(_then(INSERT * inserts, "I" * inserts, F.col(f"edit_{state}{r}")))
            state = DUE[state]
        out.append(_least(ways).alias(_best(q, r)))
    return edits, out


def automaton(words: DataFrame) -> DataFrame:
    """(word, best_..): cost and audit from each state to each other, for all `words` and their rests.

    `words` has distinct words. There is one small job for each level, CHUNK at most.
    """
    spark = words.sparkSession
    path = scratch(spark, "nodes")
    starts = F.sequence(F.lit(1), F.length("word"))
    words.select(F.explode(F.transform(starts, lambda i: F.substring("word", i, F.length("word")))).alias("word")) \
        .distinct().withColumn("size", F.length("word")).write.partitionBy("size").parquet(path)
    nodes = spark.read.schema("word string, size int").parquet(path)
    none = F.lit(None).cast("struct<cost: bigint, audit: string>")
    here = F.struct(F.lit(0).cast("long").alias("cost"), F.lit("").alias("audit"))
    level = spark.range(1).select(F.lit("").alias("word"), *[(here if q == r else none).alias(_best(q, r)) for q, r in PATHS])
    edits, bests = _steps()
    levels = []
    longest = nodes.agg(F.max("size")).first()[0] or 0
    for size in range(1, longest + 1):
        grown = nodes.where(F.col("size") == size).select(
            "word", F.substring("word", 1, 1).alias("letter"), F.expr("substring(word, 2)").alias("rest")
        )
        grown = grown.join(level.withColumnRenamed("word", "rest"), "rest")
        level = stored(grown.select("word", *edits).select("word", *bests), "level")
        levels.append(level)
    return functools.reduce(DataFrame.unionByName, levels) if levels else level


def _combined(left: str, right: str) -> list[Column]:
    """The bests of two chunks one after the other."""
    out = []
    for q, r in PATHS:
        ways = []
        for m in REACHED[q]:
            if r in REACHED[m]:
                one, two = F.col(f"{left}.{_best(q, m)}"), F.col(f"{right}.{_best(m, r)}")
                ways.append(F.when(
                    one.isNotNull() & two.isNotNull(),
                    F.struct((one.cost + two.cost).alias("cost"), F.concat(one.audit, two.audit).alias("audit")),
                ))
        out.append(_least(ways).alias(_best(q, r)))
    return out


def audits(cut: DataFrame) -> DataFrame:
    """(conv, illegal, cost, audit) of each conversation, from its chunks."""
    bests = [_best(q, r) for q, r in PATHS]
    values = automaton(cut.select("word").distinct())
    solved = stored(cut.join(values, "word").drop("word"), "solved")
    long = stored(cut.where("seq = 1").select(F.col("conv").alias("conv_2")), "long")
    same = F.col("conv").eqNullSafe(F.col("conv_2"))
    combined = [
        F.when(F.col("y").isNull(), F.col(f"x.{name}")).otherwise(best).alias(name)
        for name, best in zip(bests, _combined("x", "y"))
    ]
    done = [solved.join(long, same, "left_anti")]
    many = solved.join(long, same, "left_semi")
    left = not long.isEmpty()
    while left:
        many = stored(many, "combined")
        done.append(many.where("seq = 0"))
        left = not many.where("seq = 1").isEmpty()
        if not left:
            break
        done.pop()
        pair = F.floor(F.col("seq") / 2).cast("long").alias("pair")
        one = many.where("seq % 2 = 0").select("conv", pair, F.struct("illegal", *bests).alias("x"))
        two = many.where("seq % 2 = 1").select(
            F.col("conv").alias("conv_2"), pair.alias("pair_2"), F.struct("illegal", *bests).alias("y")
        )
        met = one.join(two, same & (F.col("pair") == F.col("pair_2")), "left")
        many = met.select(
            "conv", F.col("pair").alias("seq"),
            (F.col("x.illegal") + F.coalesce("y.illegal", F.lit(0))).alias("illegal"), *combined,
        )
    ends = [
        F.when(F.col(_best(START, r)).isNotNull(), F.struct(
            (F.col(_best(START, r)).cost + INSERT * n).alias("cost"),
            F.concat(F.col(_best(START, r)).audit, F.lit("I" * n)).alias("audit"),
        ))
        for r, n in ENDING.items()
    ]
    return functools.reduce(
        DataFrame.unionByName, [part.select("conv", "illegal", _least(ends).alias("best")) for part in done]
    ).select("conv", "illegal", "best.cost", "best.audit")


# The repaired conversations.

_AFTER = "conv {0}, place long, edit string, role string, text string"


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(conv, edit, role, text) from (conv, audit, role, text), an audit ahead of each conversation's rows.

    Only deleted rows are left out. Ends with (conv, None, None, None) after each conversation.
    """
    def rest() -> Iterator[tuple]:
        nonlocal at, state
        while audit is not None and at < len(audit) and audit[at] == "I":
            state = DUE[state]
            at += 1
            yield conv, "I", ROLES[state], ""

    conv, audit, at, state = None, None, 0, START
    for new, plan, role, text in rows:
        if plan is not None:
            if audit is not None:
                yield from rest()
                yield conv, None, None, None
            conv, audit, at, state = new, plan, 0, START
            continue
        yield from rest()
        edit = audit[at]
        at += 1
        if edit == "D":
            continue
        if edit == "R":
            state = DUE[state]
            role = ROLES[state]
        else:
            state = KEPT[state, role[0]]
        yield conv, edit, role, text
    if audit is not None:
        yield from rest()
        yield conv, None, None, None


def _streamed(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The plan of each conversation followed by its rows in order, whole conversations in a task."""
    heads = plans.select("conv", F.lit(0).alias("kind"), "audit", F.struct("*").alias("head"))
    empty = F.lit(None).cast(heads.schema["head"].dataType)
    turns = rows.select(
        "conv", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), empty.alias("head"),
        "turn", "key", "uid", "role", "text",
    )
    order = [F.asc_nulls_first("conv"), "kind", F.asc_nulls_first("turn"), "key", "uid"]
    return (
        heads.unionByName(turns, allowMissingColumns=True).repartition("conv")
        .sortWithinPartitions(*order).select("conv", "audit", "role", "text", "head")
    )


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv, place, edit, role, text): the turns of each conversation after its edits, from place 1.

    Tasks read a conversation's rows in order and hold one batch and the audit at a time.
    """
    small_batches(rows.sparkSession)
    kind = rows.schema["conv"].dataType
    names = ["conv", "place", "edit", "role", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place, held, types = [], 0, 0, None

        def flow():
            nonlocal types
            for batch in batches:
                types = [batch.schema.field("conv").type, pa.int64(), pa.string(), pa.string(), pa.string()]
                yield from zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text")))

        def made():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        for conv, edit, role, text in _edited(flow()):
            if edit is None:
                place = 0
                continue
            place += 1
            held += len(text)
            out.append((conv, place, edit, role, text))
            if len(out) >= 1000 or held > 1 << 22:
                yield made()
                out, held = [], 0
        if out:
            yield made()

    return _streamed(rows, plans).select("conv", "audit", "role", "text").mapInArrow(run, _AFTER.format(kind.simpleString()))


def with_digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """`plans` with `repaired_sha256`, of the repaired `role:text` lines joined by newlines.

    A digest reads its text in order, so a conversation is hashed by one task, row by row.
    """
    small_batches(rows.sparkSession)
    schema = plans.schema.add("repaired_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: list[pa.Array] = []

        def flow():
            for batch in batches:
                heads.append(batch.column("head").filter(batch.column("audit").is_valid()))
                yield from zip(*(batch.column(c).to_pylist() for c in ("conv", "audit", "role", "text")))

        digest, begun, done = hashlib.sha256(), False, []

        def made():
            nonlocal heads, done
            ready = pa.concat_arrays(heads)
            out = ready.slice(0, len(done)).flatten() + [pa.array(done, pa.string())]
            heads, done = [ready.slice(len(done))], []
            return pa.RecordBatch.from_arrays(out, names=schema.names)

        for _, edit, role, text in _edited(flow()):
            if edit is None:
                done.append(digest.hexdigest())
                digest, begun = hashlib.sha256(), False
                if len(done) >= 1000:
                    yield made()
                continue
            digest.update((("\n" if begun else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            begun = True
        if done:
            yield made()

    return _streamed(rows, plans).mapInArrow(run, schema)


def planned(rows: DataFrame) -> DataFrame:
    """Stored (conv, gaps, blank, duplicate, truncated, illegal, cost, audit) of numbered rows."""
    letters = signed(rows)
    counts = letters.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"),
        *[F.count(F.when(F.col("fault") == name, 1)).alias(name) for name in ("blank", "duplicate", "truncated")],
    )
    found = audits(chunks(letters)).withColumnRenamed("conv", "conv_2")
    return stored(
        counts.join(found, F.col("conv").eqNullSafe(F.col("conv_2"))).drop("conv_2")
        .select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"),
        "plans",
    )


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plans and repaired turns of `turns` (conv, turn, role, text; role and text are not null).

    A null conv is a conversation of its own. Rows that repeat are duplicates of the first. Equal turns
    are ordered by a digest of role and text. A role that begins with s, u or a counts as system,
    user or assistant, any other must be changed or go. Empty tables give no rows.
    """
    rows = numbered(turns.select("conv", "turn", "role", "text"))
    plans = planned(rows)
    return plans, repaired_turns(rows, plans)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    rows = numbered(damage(conversations))
    told = with_digests(rows, planned(rows))
    ids = conversations.select("conv_id").distinct()
    zero = {name: F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return ids.join(told, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id", *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


# crc32 is worked out byte by byte, eight shifts each; the best ways to each state go on row by row.
SQL = r"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(
        string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
        lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
      ))),
      lambda h, x: CASE WHEN x >= 0 THEN xor(h, x) ELSE xor(h >> 1, 3988292384 * (h & 1)) END
    ), 4294967295) % 20 AS kind
  FROM conversations
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM hashed WHERE kind <> 0)
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS previous
  FROM ordered
),
faulty AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE 'none' END AS fault
  FROM placed
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (previous || role[1] NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faulty GROUP BY conv_id
),
due(state, next) AS (VALUES ('0', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
kept(state, next) AS (VALUES ('0', 's'), ('0', 'u'), ('s', 'u'), ('u', 'a'), ('a', 'u')),
inserts(state, next, n, lines) AS (
  SELECT state, state, 0, []::VARCHAR[] FROM due
  UNION ALL
  SELECT i.state, d.next, i.n + 1, list_append(lines, CASE d.next WHEN 'u' THEN 'user:' ELSE 'assistant:' END)
  FROM inserts i JOIN due d ON i.next = d.state WHERE i.n < 2
),
edits AS (
  SELECT state, state AS next, 'D' AS letter, 2 AS cost FROM due
  UNION ALL SELECT state, next, 'R', 1 FROM due
  UNION ALL SELECT state, next, 'K', 0 FROM kept
),
ways AS (
  SELECT conv_id, 0::BIGINT AS i, '0' AS state, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS way
  FROM counts
  UNION ALL
  SELECT w.conv_id, w.i + 1, e.next, min({
    'cost': w.way.cost + 5 * s.n + e.cost + CASE WHEN e.letter <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END,
    'audit': w.way.audit || repeat('I', s.n) || e.letter,
    'lines': list_concat(w.way.lines, s.lines, CASE e.letter WHEN 'D' THEN []::VARCHAR[]
      WHEN 'K' THEN [f.role || ':' || f.text]
      ELSE [CASE e.next WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text] END)
  })
  FROM ways w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
  JOIN inserts s ON s.state = w.state JOIN edits e ON e.state = s.next
  WHERE (e.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate')) AND (e.letter <> 'K' OR f.role[1] = e.next)
  GROUP BY w.conv_id, w.i, e.next
),
best AS (
  SELECT c.conv_id, min({'cost': way.cost + 5 * s.n, 'audit': way.audit || repeat('I', s.n),
    'lines': list_concat(way.lines, s.lines)}) AS way
  FROM counts c JOIN ways w ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = c.n
  JOIN inserts s ON s.state = w.state WHERE s.next IN ('0', 'a') GROUP BY c.conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0) AS cost,
  coalesce(way.audit, '') AS audit, sha256(coalesce(array_to_string(way.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON o.conv_id IS NOT DISTINCT FROM b.conv_id
"""
