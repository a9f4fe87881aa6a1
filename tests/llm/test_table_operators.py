"""Pages, URLs, secrets, vectors, archives, the pipeline, and the queries' SQL."""

import hashlib
import random
import re
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from check import rows_of
from tarmac.llm import nn_descent, secrets, template, url_filter, warc
from tarmac.llm.queries import ORACLES, QUERIES
from tarmac.llm.trigrams import trigram_query
from tarmac.session import scratch


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, tables, name):
    db = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet'")
    frame = QUERIES[name](spark, tables)
    result = db.execute(ORACLES[name])
    assert rows_of(frame.columns, frame.collect()) == rows_of([c[0] for c in result.description], result.fetchall())


# URLs


def judged(host, path, rules):
    best = None
    for h, p, verdict in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            rank = (len(h) + len(p), len(h), h + p, verdict)
            best = max(best or rank, rank)
    return (best[2], best[3]) if best else (None, "allow")


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1], maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), slash + path


def test_urls_against_brute_force(spark):
    rules = url_filter.RULES + [("a.example.com", "/d", "allow"), ("example.com", "/de/x/y", "allow"), ("com", "/", "block"), ("com", "/", "allow"), ("m.b.org", "/fr/", "block"), ("b.org", "/fr/aa", "allow")]
    hosts = ["example.net", "x.example.net", "notexample.net", "EXAMPLE.com", "a.example.com", "q.a.example.com", "org", "m.b.org", "net", ""]
    paths = ["", "/", "/en/", "/en", "/en/a/b/c/d/e", "/de/x/yz", "/de//", "/d", "/fr/aa/b", "?x=/en/", "#/de/", "/fr/?q#f"]
    urls = [None, "", "no scheme", "http//x", "a://b://c/de/"] + [f"http://{h}{p}" for h in hosts for p in paths]
    rows = [(i, u, "h", "p") for i, u in enumerate(urls)] + [(1, urls[9], "h", "p")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    got = url_filter.judge(pages, url_filter.rule_table(spark, rules)).collect()
    want = [(i, *cut(u), *judged(*cut(u), dict.fromkeys(rules))) for i, u, *_ in rows]
    blocks = [(i, h, p, r, "block" if r == "com/" else v) for i, h, p, r, v in want]
    assert sorted(map(tuple, got), key=str) == sorted(blocks, key=str)


def test_urls_of_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://x.net/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_filter.judge(pages, none).collect() == [(1, "x.net", "/", None, "allow")]
    assert url_filter.judge(pages.where("false"), url_filter.rule_table(spark, url_filter.RULES)).count() == 0


# Secrets


def brute_spans(text):
    out = []
    for place, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.group]) >= rule.least:
                out.append((m.start(), place, rule.kind, m.end()))
    return sorted(out)


def test_trigram_queries():
    assert trigram_query("AKIA[A-Z0-9]+") == [["aki", "kia"]]
    assert trigram_query("[0-9a-f]{24,}") is None
    assert trigram_query("(abc|x)") is None and trigram_query("ab[cd]") == [["abc"], ["abd"]]
    assert trigram_query("(?:abcd)?") is None and trigram_query("(?:abcd)+") == [["abc", "bcd"]]
    rng = random.Random(1)
    for rule in secrets.RULES:
        query = trigram_query(rule.pattern)
        for _ in range(40):
            text = "".join(rng.choice(["pass", "word", "Token", "api", "_", "KEY", "=", ": ", "AKIA", "eyJ", "x", "Z9", "ghp_", '"']) for _ in range(12))
            if query and re.search(rule.pattern, text):
                assert any(all(t in text.lower() for t in a) for a in query)


def secret_texts():
    rng = random.Random(2)
    parts = ["password", "PassWd", "secret", "ToKeN", "api_key", "apikey", "=", " : ", '"', "'", " ", "abc", "abcdef12", "é🎉", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "\n", "ghp_" + "a1" * 18, "xoxb-1234567890-a", "sk_live_" + "a" * 16, "-----BEGIN RSA PRIVATE KEY-----", ".", "eyJ" + "a" * 10]
    return [None, "", "token:token:abcdefg", "token=secret=abcdefgh", "AKIA" + "A" * 16, "AKIA" + "A" * 15, "f" * 24, "f" * 23, "password = hunter22 " * 300] + [
        "".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(150)
    ]


def test_spans_against_brute_force(spark):
    texts = secret_texts()
    rows = [(None if i == 3 else i, t, "k", [1], "s") for i, t in enumerate([*texts, texts[4], texts[4]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, kinds array<int>, spans string")
    got = secrets.find(docs).select("row.text", "spans").collect()
    assert len(got) == len(rows)
    for r in got:
        assert [tuple(s) for s in r.spans] == brute_spans(r.text)
    assert secrets.find(docs.where("false")).count() == 0


def test_redaction(spark):
    texts = secret_texts()
    docs = spark.createDataFrame([(i, t, None if t is None else len(t), "x") for i, t in enumerate(texts)], "doc_id long, text string, n_chars long, at string")
    got = {r.doc_id: r for r in secrets.redact(docs).collect()}
    for i, text in enumerate(texts):
        out, at = "", 0
        for begin, _, _, end in brute_spans(text):
            if begin >= at:
                out += text[at:begin] + "[SECRET]"
            at = max(at, end)
        want = None if text is None else out + text[at:]
        assert (got[i].text, got[i].n_chars, got[i].at) == (want, None if want is None else len(want), "x")


# Archives


def page_rows():
    big = "<p>" + "x" * 700_000
    return [(3, "http://a/", "same"), (1, "http://b c/%", "same"), (1, "http://b c/%", "same"), (2, None, None), (4, "u\r\nv", ""), (5, "u", "ü" * 9), (None, "n", "same"), (6, "u", big), (7, "u", big), (8, "u", "WARC/1.1\r\n\r\n")]


@pytest.mark.parametrize("least", [0, 10])
def test_archives_round_trip(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "BUNDLE_BYTES", 200)
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "d", True) for r in rows], "page_id long, url string, html string, digest string, revisit boolean")
    folder = scratch(spark, "test-warc")
    index = warc.write_bundles(warc.plan_records(pages, least), folder)
    got = warc.read_bundles(index).collect()
    assert len(got) == len(rows) == index.count()
    size = {i: len((h or "").encode()) for i, _, h in rows}
    assert all(r.payload_bytes == size[r.page_id] for r in got)
    kinds = sorted((str(r.page_id), r.record_type, r.refers_to) for r in got)
    if least == 0:
        assert kinds == sorted([("1", "response", None), ("1", "revisit", 1), ("3", "revisit", 1), ("None", "revisit", 1), ("2", "response", None), ("4", "revisit", 2), ("5", "response", None), ("6", "response", None), ("7", "revisit", 6), ("8", "response", None)])
    else:
        assert [k for k in kinds if k[1] == "revisit"] == [("7", "revisit", 6)]
    import base64
    for r in got:
        html = next(h for i, _, h in rows if i == r.page_id)
        assert r.payload_digest == base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
    # One record by its place in the index.
    one = warc.read_records(index.where("page_id = 6")).collect()
    assert [(r.page_id, len(r.payload)) for r in one] == [(6, 700_003)]


def test_bundles_end_with_a_seek_table(spark):
    import zstandard

    pages = spark.createDataFrame([(i, "u", f"page {i} " * 5000) for i in range(40)], "page_id long, url string, html string")
    index = warc.write_bundles(warc.plan_records(pages).coalesce(1), scratch(spark, "test-warc"))
    uri = index.first().bundle
    system, path = warc._open_fs(uri)
    with system.open_input_file(path) as source:
        frames = warc.seek_table(source)
        whole = zstandard.ZstdDecompressor().stream_reader(source.read_at(source.size(), 0), read_across_frames=True).read()
        assert len(frames) > 1 and b"".join(warc.read_frame(source, f) for f in frames) == whole
    empty = warc.write_bundles(warc.plan_records(pages.where("false")), scratch(spark, "test-warc"))
    assert warc.read_bundles(empty).count() == 0


# Vectors


def brute_nearest(rows, k):
    out = {}
    for q, x in rows:
        if q % 20 == 0:
            ranked = sorted((-float(np.dot(np.array(x, float), np.array(y, float))), i) for i, y in rows if i != q)
            out[q] = ranked[:k]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "u") for i, v in rows], "vec_id long, embedding array<float>, label int, uid string")


def test_nearest_of_all_when_few(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (20, [-3.0, 1.0]), (3, [2.0, 2.0]), (40, [0.5, 0.5])]
    none = [(100, None), (120, []), (140, [0.0, 0.0]), (160, [float("nan"), 1.0]), (180, [None, 1.0]), (200, [float("inf"), 1.0]), (220, [1.0]), (None, [1.0, 1.0])]
    got = nn_descent.nearest(vectors(spark, rows + none + [rows[1]]), F.col("vec_id") % 20 == 0).collect()
    want = brute_nearest(rows, 20)
    assert {q: [(i, s) for _, i, s in sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)] for q in want} == {
        q: [(i, -s) for s, i in ranked] for q, ranked in want.items()
    }
    assert {r.query_id for r in got} == set(want)
    assert nn_descent.nearest(vectors(spark, none), F.lit(True)).count() == 0
    assert nn_descent.nearest(vectors(spark, []), F.lit(True)).count() == 0


def test_recall_of_the_graph(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "LEAF", 64)  # trees and rounds, though there are few vectors
    monkeypatch.setattr(nn_descent, "TREES", 4)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((700, 12)) * rng.uniform(0.5, 2, (700, 1))
    x[300:420] = x[0]  # many copies
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    got = {}
    for r in nn_descent.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want, hits = brute_nearest(rows, 20), 0
    for q, ranked in want.items():
        found = sorted(got[q])
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(a[2] > b[2] or (a[2] == b[2] and a[1] < b[1]) for a, b in zip(found, found[1:]))
        hits += sum(s >= -ranked[-1][0] - 1e-9 for _, _, s in found)
    assert hits >= 0.9 * 20 * len(want)


# Pages

PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style><script>var a="</p>";</script></head><body class="home">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li>More {n}</ul></nav><!-- <p>no</p> -->
<div class="cookie-notice"><p>We use cookies</p></div><div class="ad">Buy {n}</div>
{open}<h1>Title &amp; {n}</h1><p><b>First  of
{n}&nbsp;x<br>line<p>Second &lt;{n}&gt; <i>it</i>alic<form><p>Name</p></form><ul><li>one<li>two</ul>
<div id="comments"><p>reader says</p></div><aside>related</aside>{close}
<div class="sidebar">side</div><footer>&copy; {n}</footer></body></html>"""


def test_main_text_of_templates(spark):
    forms = [("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-content">', "</div>")]
    rows, want = [], {}
    for k, (open_, close) in enumerate(forms):
        for n in range(12):
            i = 100 * k + n
            rows.append((i, f"http://host{k}.org/{n}", PAGE.format(n=n, open=open_, close=close), "h", "t"))
            want[i] = f"Title & {n}\n\nFirst of {n} x line\n\nSecond <{n}> italic\n\none\n\ntwo"
    rows += [(900, None, rows[0][2], "h", "t"), (901, "http://host0.org/x", None, "h", "t"), (902, "http://host0.org/y", "", "h", "t"), (903, "http://new.org/", "<article>only &eacute;<", "h", "t"), (903, "http://new.org/", "<article>only &eacute;<", "h", "t"), (904, "http://host0.org/z", "<p>a<p>" + "b " * 400_000, "h", "t")]
    want |= {900: want[0], 901: "", 902: "", 903: "only é<", 904: "a\n\n" + ("b " * 400_000).strip()}
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string, text string")
    got = template.extract(pages).select("row.page_id", "text").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.text == want[r.page_id], r.page_id
    assert template.extract(pages.where("false")).count() == 0


def test_classes_nest_by_vector(spark):
    pages = spark.createDataFrame(
        [("h", i, "<html><body><ul>" + "<li><a>x</a></li>" * n + "</ul><article><p>t</article></body></html>") for i, n in enumerate([3, 4, 5] * 4)],
        "host string, key long, html string",
    )
    found = {r.host: r for r in template.contents(template.templates(pages)).collect()}
    classes = [sorted(c) for c in found["h"].classes]
    assert ["/html/body/ul/li"] in classes  # occurs 3, 4 or 5 times
    assert ["/html", "/html/body", "/html/body/article", "/html/body/article/p", "/html/body/ul"] in classes
    assert found["h"].roots == ["/html/body/article"]


def test_template_of_repeated_wrappers(spark):
    page = "<html><body><div><p>Menu {n}</div><div><article><h1>Title {n}</h1><p>Text {n}</article></div><div><p>Other {n}</div></body></html>"
    pages = spark.createDataFrame([(n, f"http://h.org/{n}", page.format(n=n)) for n in range(9)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in template.extract(pages).select("row.page_id", "text").collect()}
    assert got == {n: f"Title {n}\n\nText {n}" for n in range(9)}


def slots(seed):
    return " ".join(f"w{seed}x{k}" for k in range(20 + seed))


def test_constant_text_of_a_host_is_template(spark):
    forms = [
        ("<div class='c7'>Inicio Noticias Contacto</div><div class='publicidad'><p>Compre ya<p>hoy</div>"
         "<div class='c9'>{t}</div><div class='c8'>Aviso</div>", "{t}"),
        ("<article><p>{t}</p><p>All rights on this page are held by us and by you</p><div class='c7'><li>Home<li>News<li>Sport</div></article>", "{t}"),
        ("<div class='c9'><p>Posted by {a} on {b}<p>{t}</div>", "Posted by {a} on {b}\n\n{t}"),
        ("<div class='c9'><p>The mayor of Paris said on day {a} that the Rome line opens.<p>It costs {b} euros. {t}</div><div class='c3'><p>Alle Rechte</div>",
         "The mayor of Paris said on day {a} that the Rome line opens.\n\nIt costs {b} euros. {t}"),
        ("<article><header><h1>About {a}</h1></header><h2 class='entry-header'>More on {b}</h2><p class='side'>An area of <math><mi>x</mi><mo>=</mo><mn>2</mn></math> in {t}</article>"
         "<article class='teaser'><p>Read {b}</article>", "About {a}\n\nMore on {b}\n\nAn area of x=2 in {t}"),
    ]
    rows, want = [], {}
    for k, (form, text) in enumerate(forms):
        for n in range(9):
            own = {"t": slots(n), "a": f"a{n}", "b": f"b{n}"}
            rows.append((10 * k + n, f"http://h{k}.org/{n}", f"<html><body>{form.format(**own)}</body></html>"))
            want[10 * k + n] = text.format(**own)
    # Pages that are copies of each other have no slots; their text is not their template.
    rows += [(90 + n, f"http://copy.org/{n}", "<html><body><article><p>one and the same long text") for n in range(9)]
    want |= {90 + n: "one and the same long text" for n in range(9)}
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in template.extract(pages).select("row.page_id", "text").collect()}
    assert got == want


def test_odd_markup_takes_linear_time():
    """A megabyte of open tags, quotes, nested or different elements: well under the old hours."""
    size = 1 << 20
    pages = ["<a " * (size // 3), "<a title=\"" * (size // 10), "<p>x" + "<div>" * (size // 50), "<!--" * (size // 4), "<i x='" * (size // 7) + ">"]
    pages.append("".join(f"<div class='k{chr(97 + n % 26)}{chr(97 + n // 26 % 26)}{chr(97 + n // 676)}'>t</div>" for n in range(9000)))
    for page in pages:
        start = time.time()
        template.main_text(page, [])
        assert time.time() - start < 5
    assert template.main_text("<p>one <b title='x>two</b> <p>three <a href=x", []) == "one two\n\nthree"


def test_hosts_with_few_pages_have_their_own_template(spark):
    page = "<html><body><p>Read our terms of use<div class='x'><div class='post-content'><p>{t}</p><p>Text of page {n} and more</div></div></body></html>"
    rows = [(n, f"http://few.org/{n}", page.format(n=n, t=slots(n))) for n in range(2)]
    rows += [(10 + n, f"http://many.org/{n}", f"<html><body><div class='x'><p>{slots(n)}</div></body></html>") for n in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.host: r.roots for r in template.contents(template.templates(
        pages.select(F.regexp_extract("url", "//([^/]*)", 1).alias("host"), F.col("page_id").alias("key"), "html")
    )).collect()}
    assert found["few.org"] == ["/html/body/div[class=x]/div[class=post-content]"]
    got = {r.page_id: r.text for r in template.extract(pages).select("row.page_id", "text").collect()}
    assert [got[n] for n in range(2)] == [f"{slots(n)}\n\nText of page {n} and more" for n in range(2)]


def test_names_of_deep_and_long_elements():
    deep = "<div>" * 100
    page = f"<html><body>{deep}<nav><div><p>menu</div></nav><article><div><p>text</p><div class='ad'>buy</div></div></article><p>other"
    assert template.main_text(page, []) == "text"
    classes = " ".join(f"x{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
    assert template.main_text(f"<article><p>text<div class='{classes} sidebar'>side</div></article>", []) == "text"
    assert template.main_text(f"<p>a<div class='{classes} post-content'><p>text</div>", []) == "text"
    paths = [value for kind, value in template.walk("<div>" * 3000) if kind == "tag"]
    assert max(map(len, paths)) < 400


# The pipeline


def test_pipeline_stages(spark, tables):
    import corpus_pipeline

    docs = spark.read.parquet(f"{tables}/documents.parquet")
    more = spark.createDataFrame([(10_001, "12 34", "en", "s", 5), (10_002, None, None, None, None)], docs.schema)
    docs = docs.unionByName(more)
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        path = scratch(spark, f"test-{name}")
        stage(spark, docs, tables).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == before or name == "sentencepiece"
        kept.append(docs.count())
    assert kept[1] == kept[0] - 2 and kept[1] > kept[2] > kept[3] == kept[4] == kept[5]
    assert docs.where(F.size("ids") != F.col("n_tokens")).count() == 0
