"""Language ID, SentencePiece, decontamination, toxicity and near-duplicates."""

import functools
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tarmac.llm import decontaminate, language_id, order_minhash, toxicity
from tarmac.llm import sentencepiece_codec as codec
from tarmac.llm.common import PIECE_CHARS, shingles, word_hashes
from tarmac.llm.components import components

#: Columns whose names the operators use inside.
CLASH = "doc_id long, text string, row string, key long, ids string, found string, uid long, words string, label string"


def documents(spark, rows):
    """Rows of (doc_id, text) with columns of clashing names."""
    return spark.createDataFrame([(i, t, "r", 1, "i", "f", 2, "w", "l") for i, t in rows], CLASH)


def prose(seed, n, words="the of and heron river stone light under walking softly".split()):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))


def test_words_are_runs_of_letters_and_digits():
    texts = ["", None, "A b_c, d!", "été 漢字 x\u0301 🎉", " . ", "one\ntwo", "x" * 10]
    found = word_hashes(texts)
    # Characters beyond the basic plane count as letters.
    assert [len(f) for f in found] == [len(re.findall(r"\w+", (t or "").lower().replace("🎉", "w"))) for t in texts]
    assert word_hashes(["A b"])[0].tolist() == word_hashes(["a, B!"])[0].tolist()
    long = "word " * (PIECE_CHARS // 4) + "end"
    assert word_hashes([long])[0].tolist()[-1] == word_hashes(["end"])[0][0]
    assert len(word_hashes([long])[0]) == PIECE_CHARS // 4 + 1
    assert len(shingles(word_hashes(["a b c"])[0])) == 1 and len(shingles(word_hashes([""])[0])) == 0


# Language ID

LANGUAGES = {
    "aa": "lorem dolor sit amet consectetur adipiscing elit sed",
    "bb": "the quick brown fox jumps over lazy dogs when winter comes",
    "cc": "zwölf boxkämpfer jagen viktor quer über großen sylter deich",
}


def sentences(lang, seed, n):
    return prose(seed, n, [w for w in LANGUAGES[lang].split()]).translate({ord(c): None for c in "0123456789"})


@pytest.fixture(scope="module")
def model(spark):
    rows = [(sentences(lang, seed, 60), lang) for lang in LANGUAGES for seed in range(5)]
    rows += [(None, "aa"), ("", "bb"), ("123", "cc"), ("words", None)]
    return language_id.learn(spark.createDataFrame(rows, "text string, lang string"))


def test_languages_and_mixtures(spark, model):
    assert model.languages == ["aa", "bb", "cc"]
    mixed = sentences("bb", 99, 70) + " " + sentences("cc", 98, 30)
    rows = [(1, sentences("aa", 50, 20)), (2, sentences("cc", 51, 3)), (3, mixed), (4, None), (5, ""), (6, "12 !?"),
            (7, sentences("bb", 3, 400_000)), (1, sentences("aa", 50, 20))]
    got = language_id.predict(documents(spark, rows), model).select("row.doc_id", "lang_pred", "score", "languages").collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in range(1, 8)] == ["aa", "cc", "bb", "und", "und", "und", "bb"]
    assert by[3].languages.startswith("bb:") and "cc:" in by[3].languages and 0.55 < by[3].score < 0.85
    assert by[4].score == by[6].score == 0.0 and by[1].score == 1.0


def test_language_of_empty_tables(spark, model):
    none = language_id.learn(spark.createDataFrame([], "text string, lang string"))
    assert none.languages == []
    assert language_id.predict(documents(spark, [(1, "abc")]), none).first().lang_pred == "und"
    assert language_id.predict(documents(spark, []), model).count() == 0


def test_long_text_counts_are_those_of_the_whole(model):
    text = sentences("aa", 1, 300_000)
    assert len(text) > PIECE_CHARS
    found = language_id.trigram_counts(text)
    assert abs(found[1].sum() - (len(text) + 0)) <= 4 * (len(text) // PIECE_CHARS + 1)


def test_held_out_accuracy(spark, tables):
    from tarmac.llm.queries import QUERIES

    got = QUERIES["op5_language_id"](spark, tables)
    docs = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "lang")
    held = got.where("held_out").join(docs, "doc_id")
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count() > 0


# SentencePiece


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=codec.VOCABULARY)


def ids_of(data):
    return np.frombuffer(data, "<i4").tolist()


def odd_texts():
    rng = random.Random(4)
    some = ["".join(rng.choice("theran ing \n é漢🎉▁.  <s>") for _ in range(rng.randrange(1, 300))) for _ in range(60)]
    return [*some, "", " ", "a" * 300, " " * 200, "thereandinteresting" * 20, "\n\n  \n" * 30, "é" * 90, "<s></s><0x0A>", "\t\r\x00"]


def test_encoding_is_the_librarys(library):
    v = codec.load()
    for text in odd_texts():
        assert ids_of(v.text(codec._marked(text))) == library.encode(text), text


def test_batches_of_texts_give_the_librarys_ids(library, monkeypatch):
    v = codec.load()
    texts = ["", "", *odd_texts(), "", *odd_texts()[:5], ""]
    for together in (1, 500, codec._TOGETHER):  # words never meet those of the next text
        monkeypatch.setattr(codec, "_TOGETHER", together)
        got = v.texts([codec._marked(t) for t in texts])
        assert got.to_pylist() == library.encode(texts)
    assert v.texts([]).to_pylist() == [] and v.texts(["", ""]).to_pylist() == [[], []]


def test_each_different_word_is_encoded_once_a_batch(library, monkeypatch):
    met = []
    encode = codec.Vocabulary.long_word
    monkeypatch.setattr(codec.Vocabulary, "long_word", lambda v, word: met.append(word) or encode(v, word))
    monkeypatch.setattr(codec, "KNOWN_WORDS", 0)
    v, text = codec.load.__wrapped__(), " ".join(["q" * 90, "heron", "rivers"] * 40)
    assert ids_of(v.text(codec._marked(text))) == library.encode(text)
    assert sorted(met) == sorted({" " + "q" * 90, " heron", " rivers"})


def test_spelled_lists_are_those_of_single_pieces(library):
    v = codec.load()
    spelled = pa.array(v.spelled, pa.large_binary())
    rng = random.Random(8)
    rows = [[rng.randrange(len(v.spelled)) for _ in range(rng.randrange(40))] for _ in range(50)]
    rows = [None, [], *rows, [v.byte_ids[0xC3]], [], None, *(library.encode(t) for t in odd_texts()), None]
    want = [b"".join(v.spelled[i] for i in r or []).decode("utf-8", "replace").removeprefix(" ") for r in rows]
    lists = pa.array(rows, pa.list_(pa.int32()))
    assert codec._spelled(spelled, lists) == want
    assert codec._spelled(spelled, lists[3:40]) == want[3:40]
    assert codec._spelled(spelled, lists[:0]) == [] and codec._spelled(spelled, lists[:2]) == ["", ""]
    for odd in (-1, None, len(v.spelled)):
        with pytest.raises(ValueError, match=f"id {odd}"):
            codec._spelled(spelled, pa.array([[1], None, [5, odd, -7]], pa.list_(pa.int64())))


@pytest.mark.parametrize("size", [33, 50, 128])
def test_scanned_chunks_give_the_same_encoding(library, size):
    v, over = codec.load(), codec.load().longest
    for text in odd_texts():
        t = codec._marked(text)
        chunks = [
            codec._Chunk(t[max(p - over, 0) : p + size + over], min(p, over), min(p, over) + min(size, len(t) - p))
            for p in range(0, len(t), size)
        ]
        matrices = [codec.transfer(v, c) for c in chunks]
        states = codec.scan(matrices)
        got = ids_of(b"".join(codec.trace(v, c, a, b) for c, (a, b) in zip(chunks, states)))
        assert got == library.encode(text), (size, text)
        if matrices:
            assert codec.product(matrices) == functools.reduce(codec.combine, matrices)
        if len(matrices) > 2:  # any bracketing has the same product
            a, b, c = matrices[:3]
            assert sorted(codec.combine(codec.combine(a, b), c)) == sorted(codec.combine(a, codec.combine(b, c)))
            total = matrices[0]
            for matrix in matrices[1:]:
                total = codec.combine(total, matrix)
            n_units = len(codec._path(codec._follow(v, t, 0, None, len(t)), 0, len(t), t))
            assert total == [(codec.SYNC, codec.SYNC, -n_units)]


@pytest.mark.parametrize("odd", [-1, None, 32_000_000])
def test_odd_ids_raise(spark, odd):
    rows = spark.createDataFrame([([5, odd],)], "ids array<int>")
    with pytest.raises(Exception, match=f"no piece has the id {odd}"):
        codec.decode(rows).collect()


def test_groups_of_chunks_lead_to_the_same_path(spark, library, monkeypatch):
    monkeypatch.setattr(codec, "GROUP", 3)
    texts = [prose(4, 900), "giant" * 700, "é漢🎉 " * 500]
    got = codec.encode(documents(spark, list(enumerate(texts))), chunk_chars=100).select("row.doc_id", "ids").collect()
    assert {r.doc_id: r.ids for r in got} == {i: library.encode(t) for i, t in enumerate(texts)}


def test_round_trip_on_spark(spark, library):
    texts = [None, "", "short text", prose(1, 400), prose(1, 400), "giant" * 200, prose(2, 300) + "\n", "  a  "]
    docs = documents(spark, list(enumerate(texts)))
    encoded = codec.encode(docs, chunk_chars=400)
    got = {r.doc_id: (r.text, r.ids) for r in encoded.select("row.doc_id", "row.text", "ids").collect()}
    assert {i: ids for i, (_, ids) in got.items()} == {i: library.encode(t or "") for i, t in enumerate(texts)}
    back = codec.decode(encoded.select("row.doc_id", "ids"))
    assert {r.doc_id: r.text for r in back.select("row.doc_id", "text").collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert codec.encode(documents(spark, [])).count() == 0


# Decontamination


def brute_items(items, words):
    out = {}
    own = shingles(words)
    for item in items.items:
        window = min(item.words, len(words)) - 4
        if len(words) < 5:
            continue
        best = max(decontaminate.similarity(item, own[s : s + window]) for s in range(len(own) - window + 1))
        if best >= 0.8:
            out[item.id] = best
    return out


def test_windows_against_brute_force():
    rng = random.Random(7)
    bench = [(i, prose(100 + i, rng.randrange(5, 40))) for i in range(25)] + [(90, "too short"), (91, None), (92, bench_twice := prose(100, 30)), (93, bench_twice)]
    items = decontaminate.ItemSet(bench)
    texts = []
    for k in range(60):
        body = prose(500 + k, rng.randrange(0, 60)).split()
        item = (bench[rng.randrange(25)][1]).split()
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            at = rng.randrange(len(item))
            item[at : at + 1] = rng.choice([[], ["new"], [item[at], "more"]])
        at = rng.randrange(len(body) + 1)
        texts.append(" ".join(body[:at] + item + body[at:]))
    for words in word_hashes(texts):
        got = {i: s for i, s, _, _ in items.search(words)}
        assert got == brute_items(items, words)


def test_short_items_against_brute_force():
    rng = random.Random(9)
    vocabulary = "a b c d e f".split()
    bench = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 5)))) for i in range(30)] + [(None, "A, b!"), (40, " ! "), (41, None)]
    items = decontaminate.ItemSet(bench)
    for _ in range(200):
        text = rng.choices(vocabulary, k=rng.randrange(0, 9))
        want = []
        for i, t in bench:
            own = re.findall("[a-z]", (t or "").lower())
            at = [k for k in range(len(text) - len(own) + 1) if text[k : k + len(own)] == own]
            if own and at:
                want.append((i, 1.0, at[0], at[0] + len(own)))
        got = items.search(word_hashes([" ".join(text)])[0])
        assert sorted(got, key=str) == sorted(want, key=str)


def test_hamming_blocks_find_all_within_the_radius():
    rng = np.random.default_rng(3)
    prints = rng.integers(0, 256, (300, 8), dtype=np.uint8)
    queries = prints[:100] ^ np.packbits(rng.random((100, 64)) < 0.3, axis=1)
    index = decontaminate.HammingIndex(prints)
    distances = np.unpackbits(queries[:, None, :] ^ prints[None, :, :], axis=2).sum(axis=2)
    assert set(zip(*index.within(queries))) == set(zip(*np.nonzero(distances <= decontaminate.RADIUS)))


def test_decontamination_on_spark(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 4)  # several passes
    bench = spark.createDataFrame([(i, prose(i, 20)) for i in range(9)] + [(None, prose(70, 20)), (50, None), (51, "zebra crossing")], "item_id long, text string")
    clean = prose(77, 50)
    rows = [(1, clean), (2, f"{clean} {prose(3, 20).upper()} {clean}"), (3, None), (4, ""), (5, prose(4, 20)), (5, prose(4, 20)), (6, prose(5, 8)), (7, prose(70, 20)), (8, "A Zebra crossing"), (9, "crossing zebra")]
    got = decontaminate.search(documents(spark, rows), bench).select("row.doc_id", "found.item_id").collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, []), (2, [3]), (3, []), (4, []), (5, [4]), (5, [4]), (6, []), (7, [None]), (8, [51]), (9, [])]
    nothing = bench.where("false")
    assert decontaminate.search(documents(spark, rows), nothing).where(F.size("found") > 0).count() == 0
    assert decontaminate.search(documents(spark, []), bench).count() == 0


# Toxicity


def toxic_table(spark, n=240):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = prose(i, 30).split()
        if bad:
            words[5:5] = [["idiotic", "wretched", "vilefoo", "vilebar"][i // 4 % 4]]
            if i % 8 == 0:
                words.append("women")
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    labels += [(0, 1), (None, 1), (3, None), (9999, 1)]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_words_and_identity_terms(spark, monkeypatch):
    docs, labels = toxic_table(spark)
    learned = toxicity.learn(docs, labels)
    tests = [(1, "the wretched light"), (2, "the light"), (3, None), (4, ""), (5, "women under the river"), (6, "x " * 700_000 + "idiotic")]
    got = {r.doc_id: r for r in toxicity.score(documents(spark, tests), learned).select("row.doc_id", "score", "predicted").collect()}
    assert [got[i].predicted for i in range(1, 7)] == [1, 0, 0, 0, 0, 1]
    assert got[3].score == got[4].score and all(0 <= r.score <= 1 for r in got.values())
    # Without the penalty, naming the group moves the score; with it, hardly.
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    texts = [r.text for r in docs.select("text").collect()]
    found = [toxicity.features(t) for t in texts]
    y = np.array([i % 4 == 0 for i in range(len(texts))])

    def moved(m):
        own = np.isin(m.hashes, toxicity.features("women")), np.isin(m.hashes, toxicity.features("men"))
        return abs(m.weights[own[0]].sum() - m.weights[own[1]].sum())

    free = moved(toxicity.train(y, found))
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 1.0)
    assert moved(toxicity.train(y, found)) < 0.5 * free


def test_toxicity_of_empty_tables(spark):
    docs, labels = toxic_table(spark, 8)
    none = toxicity.learn(docs, labels.where("false"))
    assert len(none.hashes) == 0
    assert toxicity.score(docs, none).agg(F.max("predicted")).first()[0] == 0
    assert toxicity.learn(docs, labels.where("toxic = 1")).bias > 0
    assert toxicity.score(documents(spark, []), none).count() == 0


# Near-duplicates


def brute_classes(rows):
    words = word_hashes([t for _, t in rows])
    sets = [set(order_minhash.labelled(shingles(w)).tolist()) for w in words]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        alike = words[i].tolist() == words[j].tolist() or (
            min(len(words[i]), len(words[j])) >= 5 and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both)
        )
        if alike:
            parent[root(i)] = root(j)
    out = {}
    for i, (doc, _) in enumerate(rows):
        out.setdefault(root(i), []).append(doc)
    return sorted(sorted(v) for v in out.values())


def near_rows():
    rng = random.Random(5)
    rows = [(None, None), (1, None), (2, ""), (3, "a b"), (4, "A, b!"), (5, "c d e f")]
    n = 10
    for k in range(12):
        base = prose(k, rng.randrange(20, 120)).split()
        for _ in range(rng.randrange(1, 6)):
            copy = base[:]
            for _ in range(rng.choice([0, 1, 1, 2, 5])):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([[], ["changed"], [copy[at], "added"]])
            rows.append((n, " ".join(copy)))
            n += 1
    passage = prose(700, 25)  # many texts share it, none is alike
    return rows + [(n + k, f"{prose(800 + k, 60)} {passage}") for k in range(30)]


@pytest.mark.parametrize("small", [order_minhash.SMALL_BUCKET, 2])
def test_classes_against_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(order_minhash, "SMALL_BUCKET", small)  # 2: the join on rare shingles does the rest
    rows = near_rows()
    docs = documents(spark, rows)
    got = order_minhash.classes(docs, keep=["doc_id"]).select("row.doc_id", "class_id", "first", "links").collect()
    assert len(got) == len(rows)
    classes = {}
    for r in got:
        classes.setdefault(r.class_id, []).append(r.doc_id)
    want = brute_classes([(-1 if i is None else i, t) for i, t in rows])
    assert sorted(sorted(-1 if i is None else i for i in v) for v in classes.values()) == want
    assert sum(r.first for r in got) == len(classes)
    assert all(r.doc_id == r.class_id for r in got if r.first)


def test_alignment_against_shared_shingles():
    rng = random.Random(1)
    for k in range(150):
        a = [rng.randrange(5000) for _ in range(rng.randrange(5, 120))]
        b = a[:]
        for _ in range(rng.randrange(6)):
            at = rng.randrange(len(b))
            b[at : at + 1] = rng.choice([[], [9000 + k], [b[at], 7777]])
            b = b or [1]
        x, y = np.array(a, np.uint32), np.array(b, np.uint32)
        s, t = set(shingles(x.astype(np.uint64)).tolist()), set(shingles(y.astype(np.uint64)).tolist())
        want = len(s & t) / len(s | t)
        if min(len(a), len(b)) >= 5 and abs(want - 0.8) > 0.03:
            assert (order_minhash.similarity(x, y) >= 0.8) == (want >= 0.8)
    swapped = np.arange(40_000, dtype=np.uint32)  # 20,000-word halves, in no time
    assert order_minhash.similarity(swapped, np.roll(swapped, 20_000)) == 0
    moved = np.arange(100, dtype=np.uint32)  # order counts: halves swapped are no copy
    assert order_minhash.similarity(moved, np.roll(moved, 50)) == 0


def test_near_duplicates_of_an_empty_table(spark):
    assert order_minhash.classes(documents(spark, [])).count() == 0


def test_components_of_a_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
