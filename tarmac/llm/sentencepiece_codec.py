"""SentencePiece encoding and decoding, giant texts by a max-plus parallel scan.

The vocabulary is a byte-pair one: pieces merge in the order of their scores. A sequence of pieces
is the encoding of its text exactly if every two neighbours are the encoding of what they spell
together, so an encoding is a path whose steps look at two pieces only, and there is one path
for each text. Steps that fit weigh -1 (a piece), others minus infinity.

A text of more than CHUNK_CHARS is cut into chunks, wherever the cut falls. For each chunk, a matrix
holds the best weight from each state at its left boundary (the piece that reaches the boundary:
how far back it starts and how long it is) to each state at its right one. Matrices combine
associatively in the max-plus algebra; the scan of a text's matrices gives the states on its path,
and each chunk, alone again, is traced between its two states.

No piece spans the start of a run of spaces or a barrier character, so inside a chunk all but its
ends is encoded word by word, and the matrices have few entries. Where a chunk is one giant word,
its pieces are followed from each state at its left.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import small_batches, table
from tarmac.session import stored

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_CHARS = 1 << 16
#: Chunks whose matrices are combined before the scan of a text.
GROUP = 256
#: Words whose pieces a worker remembers.
KNOWN_WORDS = 400_000
_KNOWN_PAIRS = 200_000
#: Bytes of texts whose words are looked up together, and ids that are spelled together.
_TOGETHER = 1 << 22

SYNC = 0  # the state at a boundary that no piece spans


@dataclass
class Vocabulary:
    """Pieces with spaces for the space mark; unknown characters are spelled in bytes."""

    ranks: dict[str, float]
    ids: dict[str, int]
    byte_ids: list[int]
    spelled: list[bytes]
    longest: int = 1
    #: For each id, whether it begins a piece or character: bytes inside of a character do not.
    begins: np.ndarray = field(default_factory=lambda: np.empty(0, bool))
    #: Ids of words met, by the words' UTF-8.
    words: dict[bytes, bytes] = field(default_factory=dict)
    pairs: dict[tuple[str, str], bool] = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "words": {}, "pairs": {}}

    def merged(self, word: str) -> list[str]:
        """The pieces and unknown characters of a word: best merges first, leftmost of equals."""
        parts, get, none = list(word), self.ranks.get, float("inf")
        ranks = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = get(parts[at] + parts[at + 1], none)
            if at:
                ranks[at - 1] = get(parts[at - 1] + parts[at], none)
        return parts

    def numbers(self, parts: list[str]) -> bytes:
        """Ids of pieces as 32-bit numbers."""
        out = []
        for part in parts:
            own = self.ids.get(part)
            if own is None:
                out.extend(self.byte_ids[b] for b in part.encode("utf-8", "replace"))
            else:
                out.append(own)
        return np.array(out, "<i4").tobytes()

    def long_word(self, word: str) -> bytes:
        """Ids of a word of any length: long ones are followed piece by piece, in linear time."""
        if len(word) <= 64:
            return self.numbers(self.merged(word))
        return self.numbers(_path(_follow(self, word, 0, None, len(word)), 0, len(word), word))

    def word(self, word: bytes) -> bytes:
        text = word.decode()
        found = self.long_word(text)
        if len(self.words) < KNOWN_WORDS and len(text) <= 64:
            self.words[word] = found
        return found

    def text(self, text: str) -> bytes:
        """Ids of a text that begins at a boundary and ends at one."""
        return self._joined([text.encode()])[1].tobytes()

    def texts(self, texts: list[str]) -> pa.Array:
        """Lists of the ids of such texts."""
        data = [t.encode() for t in texts]
        found = [self._joined(data[a:b]) for a, b in _runs([len(d) for d in data])]
        lists = [pa.ListArray.from_arrays(pa.array(b, pa.int32()), pa.array(ids, pa.int32())) for b, ids in found]
        return pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32()))

    def _joined(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each text begin and end, and the ids; each different word is looked up once."""
        ends = np.cumsum([0, *map(len, texts)])
        data = b"".join(texts)
        starts = _word_starts(np.frombuffer(data, np.uint8), ends)
        if not len(starts):
            return np.zeros(len(ends), np.int64), np.empty(0, "<i4")
        words = _binary(np.append(starts, len(data)), data).dictionary_encode()
        known, new = self.words.get, self.word
        different = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = pa.array([known(w) or new(w) for w in different], pa.large_binary()).take(words.indices)
        places, values = _parts(ids)
        return places[np.searchsorted(starts, ends)] // 4, np.frombuffer(values, "<i4")

    def fits(self, left: str | None, right: str) -> bool:
        """Whether two neighbours are the encoding of what they spell."""
        if left is None:
            return len(right) == 1 or self.merged(right) == [right]
        found = self.pairs.get((left, right))
        if found is None:
            found = self.merged(left + right) == [left, right]
            if len(self.pairs) >= _KNOWN_PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = found
        return found


def _runs(sizes: list[int]) -> list[tuple[int, int]]:
    """Runs of rows, from first to end, each of about _TOGETHER in size or with a larger row in it."""
    if not len(sizes):
        return []
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // _TOGETHER)) + 1
    edges = [0, *cuts.tolist(), len(sizes)]
    return list(zip(edges, edges[1:]))


def _binary(places: np.ndarray, data: bytes) -> pa.Array:
    """The parts of `data` between places, as an Arrow array on the same memory."""
    buffers = [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(places) - 1, buffers)


def _parts(array: pa.Array) -> tuple[np.ndarray, pa.Buffer]:
    """The places between the parts of a new binary array, and its bytes."""
    _, places, data = array.buffers()
    return np.frombuffer(places, np.int64, len(array) + 1), data


def _word_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where words start in the UTF-8 of texts with these ends, by the rule of `_is_sync`.

    A word is spaces with what is behind them, a line break, or the rest of a line without a space.
    """
    space, line = data == 32, data == 10
    begins = space | line
    begins[1:] &= ~(space[1:] & space[:-1])
    begins[1:] |= line[:-1]
    begins[ends[:-1][ends[:-1] < ends[1:]]] = True
    return np.flatnonzero(begins)


@functools.lru_cache(2)
def load(path: str = VOCABULARY) -> Vocabulary:
    """The vocabulary of a SentencePiece byte-pair model file without normalisation rules."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    ranks, ids, spelled, byte_ids = {}, {}, [], [0] * 256
    for i in range(n):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value] = i
            spelled.append(bytes([value]))
        elif model.is_control(i):
            spelled.append(b"")
        elif model.is_unknown(i):
            spelled.append(" ⁇ ".encode())
        else:
            text = piece.replace("▁", " ")
            ranks[text], ids[text] = -model.get_score(i), i
            spelled.append(text.encode())
    if any("\n" in p or re.search(r"[^ ] ", p) for p in ranks):
        raise ValueError("a piece spans the start of a word or a line break")
    begins = np.ones(n, bool)
    begins[byte_ids[0x80:0xC0]] = False
    return Vocabulary(ranks, ids, byte_ids, spelled, max(map(len, ranks)), begins)


def _marked(text: str) -> str:
    """The text as the model sees it: a space in front, space marks like spaces."""
    return " " + text.replace("▁", " ") if text else ""


# Paths within a chunk. A step table maps each reachable place to the piece that ends there.


def _follow(v: Vocabulary, text: str, at: int, left: str | None, stop: int) -> dict[int, str | None]:
    """Pieces that end at each place up to `stop`, on the path that begins with `left` at `at`."""
    ends: dict[int, str | None] = {at: left}
    for place in range(at, stop):
        if place not in ends:
            continue
        last = ends[place]
        for length in range(1, min(v.longest, stop - place) + 1):
            piece = text[place : place + length]
            if place + length in ends or (length > 1 and piece not in v.ranks):
                continue
            if v.fits(last, piece):
                ends[place + length] = piece
    return ends


def _path(ends: dict[int, str | None], begin: int, end: int, text: str) -> list[str]:
    out = []
    while end > begin:
        piece = ends[end]
        out.append(piece)
        end -= len(piece)
    return out[::-1]


def _is_sync(text: str, at: int) -> bool:
    """Whether no piece can span this place: at a text's ends, before spaces, at a line break."""
    if at <= 0 or at >= len(text):
        return True
    a, b = text[at - 1], text[at]
    return (b == " " and a != " ") or a == "\n" or b == "\n"


_STARTS = re.compile(r"(?<! ) |\n|(?<=\n)")


@dataclass
class _Chunk:
    """text[begin:end] is the chunk; what is around it lets pieces reach over."""

    text: str
    begin: int
    end: int

    def syncs(self) -> tuple[int, int] | None:
        """The first and the last place in the chunk that no piece spans."""
        if _is_sync(self.text, self.begin):
            first = self.begin
        else:
            found = _STARTS.search(self.text, self.begin + 1)
            first = found.start() if found else len(self.text)
        if first > self.end or (first == self.end and not _is_sync(self.text, first)):
            return None
        last = self.end
        while not _is_sync(self.text, last):
            last -= 1
        return first, last


def _states(v: Vocabulary, text: str, at: int) -> dict[int, str]:
    """Pieces that reach a boundary, by state: how far back they start and how long they are."""
    out = {}
    for back in range(1, min(v.longest, at) + 1):
        for length in range(back, min(v.longest, len(text) - at + back) + 1):
            piece = text[at - back : at - back + length]
            if (length == 1 or piece in v.ranks) and v.fits(None, piece):
                out[back * 256 + length] = piece
    return out


def _rights(v: Vocabulary, c: _Chunk, ends: dict[int, str | None], begin: int) -> list[tuple[int, int]]:
    """States at the right boundary that continue a path, with the place their piece starts."""
    return [
        (state, c.end - state // 256)
        for state, piece in _states(v, c.text, c.end).items()
        if (at := c.end - state // 256) >= begin and at in ends and v.fits(ends[at], piece)
    ]


def _lefts(v: Vocabulary, c: _Chunk) -> list[tuple[int, str | None, int]]:
    """(state, piece, where it ends) at the left boundary."""
    if _is_sync(c.text, c.begin):
        return [(SYNC, None, c.begin)]
    return [
        (s, piece, c.begin - s // 256 + s % 256) for s, piece in _states(v, c.text, c.begin).items()
    ]


def transfer(v: Vocabulary, c: _Chunk) -> list[tuple[int, int, int]]:
    """(left state, right state, weight) of a chunk; the weight is minus its number of pieces."""
    syncs = c.syncs()
    out = []
    if syncs is None:
        for left, piece, at in _lefts(v, c):
            ends = _follow(v, c.text, at, piece, c.end)
            for right, begin in _rights(v, c, ends, at):
                out.append((left, right, -len(_path(ends, at, begin, c.text)) - 1))
        return out
    first, last = syncs
    heads = []
    for left, piece, at in _lefts(v, c):
        if at <= first and first in (ends := _follow(v, c.text, at, piece, first)):
            heads.append((left, len(_path(ends, at, first, c.text))))
    # Pieces, as in heads and tails: an unknown character is one, though it has several ids.
    middle = int(v.begins[np.frombuffer(v.text(c.text[first:last]), "<i4")].sum())
    if last == c.end:
        tails = [(SYNC, 0)]
    else:
        ends = _follow(v, c.text, last, None, c.end)
        tails = [
            (right, len(_path(ends, last, begin, c.text)) + 1)
            for right, begin in _rights(v, c, ends, last)
        ]
    return [(a, b, -n - middle - m) for a, n in heads for b, m in tails]


def combine(a: list[tuple[int, int, int]], b: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The max-plus product of two matrices; associative."""
    rows: dict[int, list[tuple[int, int]]] = {}
    for left, right, weight in b:
        rows.setdefault(left, []).append((right, weight))
    best: dict[tuple[int, int], int] = {}
    for left, middle, weight in a:
        for right, more in rows.get(middle, ()):
            best[left, right] = max(best.get((left, right), weight + more), weight + more)
    return [(left, right, weight) for (left, right), weight in best.items()]


def product(matrices: list[list[tuple[int, int, int]]]) -> list[tuple[int, int, int]]:
    """The matrix of neighbouring chunks as one, combined in a balanced tree."""
    while len(matrices) > 1:
        matrices = [
            combine(*matrices[i : i + 2]) if i + 1 < len(matrices) else matrices[i]
            for i in range(0, len(matrices), 2)
        ]
    return matrices[0]


def scan(matrices: list[list[tuple[int, int, int]]], start: int = SYNC, end: int = SYNC) -> list[tuple[int, int]]:
    """The (left, right) states of each chunk on the best path from `start` to `end`."""
    reached = [[(start, start, 0)]]
    for matrix in matrices:
        reached.append(combine(reached[-1], matrix))
    out, right = [], end
    for matrix, before in zip(matrices[::-1], reached[-2::-1]):
        weights = {state: weight for _, state, weight in before}
        left = max(
            (a for a, b, _ in matrix if b == right and a in weights),
            key=lambda a: weights[a] + next(w for x, y, w in matrix if (x, y) == (a, right)),
        )
        out.append((left, right))
        right = left
    return out[::-1]


def trace(v: Vocabulary, c: _Chunk, left: int, right: int) -> bytes:
    """Ids of the pieces that start in a chunk, between its two states."""
    piece, at = None, c.begin
    if left != SYNC:
        start = c.begin - left // 256
        at = start + left % 256
        piece = c.text[start:at]
    syncs = c.syncs()
    out = []
    begin, last = at, piece
    if syncs is not None:
        first, begin = syncs
        out.append(v.numbers(_path(_follow(v, c.text, at, piece, first), at, first, c.text)))
        out.append(v.text(c.text[first:begin]))
        last = None
    if right != SYNC:
        start = c.end - right // 256
        ends = _follow(v, c.text, begin, last, start)
        out.append(v.numbers(_path(ends, begin, start, c.text)))
        out.append(v.numbers([c.text[start : start + right % 256]]))
    return b"".join(out)


# The same over Spark.


def _ids_column(parts: list[bytes]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
    values = np.frombuffer(b"".join(parts), "<i4")
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _key(text):
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(text, F.lit(7)).alias("b"))


def encode_giants(texts: DataFrame, v: Vocabulary, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """(key, ids) of the texts in (key, text), whose keys differ: cut, scan, trace."""
    over = v.longest
    if chunk_chars <= 2 * over:
        raise ValueError("chunks must be longer than two pieces")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(1)):
                text = _marked(text.as_py())
                key = batch.column(0).slice(i, 1)
                n = -(-len(text) // chunk_chars)
                for first in range(0, n, 16):
                    places = [k * chunk_chars for k in range(first, min(first + 16, n))]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.concat_arrays([key] * len(places)),
                            pa.array(range(first, first + len(places)), pa.int32()),
                            pa.array([text[max(p - over, 0) : p + chunk_chars + over] for p in places]),
                            pa.array([min(p, over) for p in places], pa.int32()),
                            pa.array([min(p, over) + min(chunk_chars, len(text) - p) for p in places], pa.int32()),
                        ],
                        names=["key", "chunk", "text", "begin", "end"],
                    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                transfer(v, _Chunk(*row))
                for row in zip(*(batch.column(c).to_pylist() for c in ("text", "begin", "end")))
            ]
            flat = np.array([x for matrix in found for x in matrix], np.int64).reshape(-1, 3)
            n = [len(matrix) for matrix in found]
            keys = batch.select(["key", "chunk"]).take(pa.array(np.repeat(np.arange(len(n)), n)))
            yield pa.RecordBatch.from_arrays(
                [*keys.columns, *(pa.array(flat[:, j]) for j in range(3))],
                names=["key", "chunk", "left", "right", "weight"],
            )

    def by_chunk(frame: pd.DataFrame) -> tuple[list[int], list[list[tuple[int, int, int]]]]:
        """The chunks (or groups of them) in order, and their matrices."""
        parts = list(frame.sort_values("chunk", kind="stable").groupby("chunk"))
        return [k for k, _ in parts], [list(zip(own["left"], own["right"], own["weight"])) for _, own in parts]

    def join_up(frame: pd.DataFrame) -> pd.DataFrame:
        whole = np.array(product(by_chunk(frame)[1]), np.int64).reshape(-1, 3)
        return pd.DataFrame({
            "a": frame["a"].iat[0], "b": frame["b"].iat[0], "chunk": frame["group"].iat[0],
            "left": whole[:, 0], "right": whole[:, 1], "weight": whole[:, 2],
        })

    def follow(frame: pd.DataFrame) -> pd.DataFrame:
        """The states of a group's chunks between those at its ends; of all groups, from end to end."""
        first = frame.iloc[0]
        chunks, matrices = by_chunk(frame)
        states = scan(matrices, first["from"], first["to"])
        return pd.DataFrame({
            "a": first["a"], "b": first["b"], "chunk": chunks,
            "left": [s[0] for s in states], "right": [s[1] for s in states],
        })

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                trace(v, _Chunk(text, begin, end), left, right)
                for text, begin, end, left, right in zip(
                    *(batch.column(c).to_pylist() for c in ("text", "begin", "end", "left", "right"))
                )
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["key", "chunk"]).columns, _ids_column(found)],
                names=["key", "chunk", "ids"],
            )

    kind = "key struct<a:long,b:long>, chunk int, "
    chunks = texts.select("key", "text").mapInArrow(cut, kind + "text string, begin int, end int")
    spread = chunks.repartition("key", "chunk")
    matrices = spread.mapInArrow(measure, kind + "left long, right long, weight long")
    # The matrices of GROUP neighbouring chunks are combined, the products of a text scanned, and the
    # states found at the ends of each group lead back through its chunks.
    flat = stored(matrices.select(
        "key.a", "key.b", F.floor(F.col("chunk") / GROUP).cast("int").alias("group"), "chunk", "left", "right", "weight"
    ), "matrices")
    path = "a long, b long, chunk int, left long, right long"
    ends = F.lit(SYNC).cast("long")
    groups = (
        flat.groupBy("a", "b", "group").applyInPandas(join_up, path + ", weight long")
        .select("*", ends.alias("from"), ends.alias("to")).groupBy("a", "b").applyInPandas(follow, path)
    )
    between = groups.select("a", "b", F.col("chunk").alias("group"), F.col("left").alias("from"), F.col("right").alias("to"))
    states = (
        flat.join(between, ["a", "b", "group"]).groupBy("a", "b", "group").applyInPandas(follow, path)
        .select(F.struct("a", "b").alias("key"), "chunk", "left", "right")
    )
    traced = chunks.join(states, ["key", "chunk"]).select(
        "key", "chunk", "text", "begin", "end", "left", "right"
    ).mapInArrow(spell, kind + "ids array<int>")
    return traced.groupBy("key").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda x: x["ids"]))
        .alias("ids")
    )


def encode(docs: DataFrame, path: str = VOCABULARY, text: str = "text",
           chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Rows of `docs` as a struct `row`, with `ids`, the text's pieces.

    The ids are those of the model's own encoder. Null and empty texts have no pieces. All rows
    stay; a giant text that occurs many times is encoded once.
    """
    small_batches(docs.sparkSession)
    v = load(path)
    rows = docs.select(F.struct("*").alias("row"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, ids array<int>"

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = v.texts([_marked(x.as_py() or "") for x in batch.column("row").field(text)])
            yield pa.RecordBatch.from_arrays([batch.column("row"), found], names=["row", "ids"])

    own = F.col("row")[text]
    giant = F.coalesce(F.length(own) > chunk_chars, F.lit(False))
    short = rows.where(~giant).mapInArrow(whole, schema)
    giants = rows.where(giant).select("row", _key(own).alias("key"))
    texts = rows.where(giant).select(_key(own).alias("key"), own.alias("text")).dropDuplicates(["key"])
    long = giants.join(encode_giants(texts, v, chunk_chars), "key").select("row", "ids")
    return short.unionByName(long)


def _spelled(spelled: pa.Array, lists: pa.Array) -> list[str]:
    """What lists of ids spell, without the space in front."""
    flat = lists.flatten()
    ids = flat.cast(pa.int64()).fill_null(-1).to_numpy()
    odd = np.flatnonzero((ids < 0) | (ids >= len(spelled)))
    if len(odd):
        raise ValueError(f"no piece has the id {flat[int(odd[0])].as_py()}")
    sizes = lists.value_lengths().fill_null(0).to_numpy()
    ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    out = []
    for a, b in _runs(sizes):
        own = ends[a : b + 1]
        places, data = _parts(spelled.take(pa.array(ids[own[0] : own[-1]])))
        data = memoryview(data or b"")
        cuts = places[own - own[0]].tolist()
        out.extend(str(data[c:d], "utf-8", "replace").removeprefix(" ") for c, d in zip(cuts, cuts[1:]))
    return out


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """`encoded` (with `ids`) as a struct `row`, with `text`, what the ids spell.

    A null list and no ids spell an empty text. Bytes that are no UTF-8 become replacement marks. An
    id outside the vocabulary, below 0 or null, raises a ValueError that names it.
    """
    small_batches(encoded.sparkSession)
    spelled = pa.array(load(path).spelled, pa.large_binary())
    rows = encoded.select(F.struct("*").alias("row"))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = _spelled(spelled, batch.column("row").field("ids"))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], names=["row", "text"])

    return rows.mapInArrow(spell, f"row {rows.schema['row'].dataType.simpleString()}, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode(docs).select(
        F.col("row.doc_id").alias("doc_id"), F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("sha"), "ids"
    )
    back = decode(encoded)
    return back.select(
        "row.doc_id", F.size("row.ids").cast("long").alias("n_tokens"), "row.ids",
        (F.sha2("text", 256) == F.col("row.sha")).alias("round_trip"),
    )
