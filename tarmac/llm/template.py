"""Main text of pages by deducing the templates of their hosts.

A page's tags and words, each with the path of the elements around it, are its tokens. Tokens that
occur equally often on every page of a host share their occurrence vector and form an equivalence
class. Classes of the tokens that most of the host's pages have are valid; nested by their paths,
they are the host's template, and the text between template tokens sits in slots. A slot is part of
the main text if it lies in the template's content element and in none that its tag or attributes
name a menu, header, footer, sidebar, notice, advert, form or comment.

A word is a template word if its class holds a template tag or LEAST_WORDS words. Only whole blocks
go: a block all of whose words are template words has no slot, and it goes with the constant blocks
next to it if they hold LEAST_WORDS words together or, outside of elements named as content, a word of
a tag's class. A sentence with a slot stays as it is. A page keeps its text if all of it would go, or more than half of what is in elements
named as content: then it is a copy of other pages and not their template.

Occurrence vectors are never gathered: a token's vector is known by the sum of a hash of (page,
count) over its pages, with the number of pages and occurrences, so a host with a third of all
pages costs a sum. In an element named as content a constant block goes only if LEAST_PAGES pages of
the host bear it out: on fewer, it is as likely a passage that some articles share. The only page of a
host uses the template of all hosts together.

A tag that the page ends in is dropped with what is in it; a quote that is never closed is an ordinary
character of its tag. An article's own heading is part of it, whatever its name, and so is a header
within an article but for what else in it is boilerplate; formulas are part of the text around them.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.common import small_batches, table
from tarmac.llm.url_filter import host_and_path
from tarmac.session import stored

#: Pages that must bear out a constant block in an element named as content.
LEAST_PAGES = 8
#: Words that make a class without a tag, and a constant block without a word of a tag's class.
LEAST_WORDS = 3
#: A token belongs to a template if this part of the pages has it.
LEAST_SHARE = 0.5
#: Paths hold elements nested deeper than this by a hash, but for the first of each kind that is
#: named as content or as other than main text.
MOST_DEPTH = 64
#: Longer values of class, id and role are held by a hash and the words that name what they are.
MOST_VALUE = 200
#: Bits that mark word tokens which may be on enough pages, and words counted at once to find them.
MARK_BITS = 1 << 25
MARK_WORDS = 500_000
#: Templates of up to this many bytes go to every executor.
BROADCAST_BYTES = 16 << 20
ALL_HOSTS = ""

# Fixed values of HTML: elements without content, without a box of their own, with raw text,
# and blocks that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle msub msup msubsup munder mover munderover".split()
)
RAW = frozenset("script style textarea noscript template iframe svg title select button".split())
#: Sibling elements that end an open element of the kind named.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
#: Lists and tables within which such an element ends its siblings only.
SCOPES = frozenset("ul ol dl table thead tbody tfoot article section main div body html".split())
CONTENT = ("article", "main")
BOILERPLATE_TAGS = frozenset("nav header footer aside form head dialog menu".split()) | RAW
#: Words of class, id and role that name what is not the main text.
BOILERPLATE_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert|advertisement|adverts|banner|promo|promoted|promotion|sponsor|"
    r"sponsored|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|header|masthead|footer|sidebar|"
    r"side|aside|widget|cookie|cookies|consent|gdpr|notice|popup|modal|overlay|newsletter|subscribe|"
    r"signup|login|share|sharing|social|related|recommended|comment|comments|reply|replies|"
    r"respond|disqus|copyright|search|toolbar|pagination|pager)(?:$|[\s_-])",
    re.IGNORECASE,
)
CONTENT_WORDS = re.compile(
    r"(?:^|[\s_-])(?:article|content|main|post|entry|story|body|text)(?:$|[\s_-])", re.IGNORECASE
)

#: Of these words, the ones that say nothing about a heading or paragraph of an article.
PLACE_WORDS = re.compile(r"(?:^|[\s_-])(?:header|masthead|side|aside|banner)(?:$|[\s_-])", re.IGNORECASE)
#: Names of an article element that make it no main text.
OTHER_ARTICLES = re.compile(
    r"(?:^|\s)(?:teaser|related|recommended|promo|promoted|sponsored|advert|advertisement|comment|reply)(?:$|\s)",
    re.IGNORECASE,
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)", re.DOTALL)
#: A tag without angle brackets in its attributes; a match ends before the next "<" or not at all.
_PLAIN = re.compile(r"""<(/?)([a-zA-Z][^\s/<>"']*+)((?:[^<>"']++|"[^"<>]*+"|'[^'<>]*+')*+)>""")
_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile("[>\"']")
_ATTRIBUTE = re.compile(
    r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE
)


def _name(tag: str, attributes: str) -> str:
    """An element in a path: its tag with class, id and role, digits as one (ids often count)."""
    if tag in INLINE or "=" not in attributes:
        return tag
    found = sorted({
        (k.lower(), re.sub(r"\d+", "0", entities.unescape(value.strip("\"'"))).strip())
        for k, value in _ATTRIBUTE.findall(attributes)
    })
    return tag + "".join(f"[{k}={_short(v.replace('/', ' '))}]" for k, v in found)


def _short(value: str) -> str:
    """An attribute's value, a long one by the words that name its kind and a hash."""
    if len(value) <= MOST_VALUE:
        return value
    found = [m[0].strip().strip("_-") for m in (BOILERPLATE_WORDS.search(value), CONTENT_WORDS.search(value)) if m]
    return " ".join([*found, xxhash.xxh64_hexdigest(value)])


def _kind(name: str) -> str:
    """What an element is named as: other than main text, article, main, content, or nothing."""
    element = _elements(f"/{name}")[0]
    if is_boilerplate(f"/{name}"):
        return "boilerplate"
    return element[0] if element[0] in CONTENT else "content" if _is_content(element) else ""


def tags_of(page: str, at: int = 0) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, "/" or "", name, attributes) of tags from `at` on; what is skipped has no name.

    One pass: each character is looked at a bounded number of times.
    """
    last = {quote: page.rfind(quote) for quote in "\"'"}
    while (start := page.find("<", at)) >= 0:
        if found := _PLAIN.match(page, start):
            at = found.end()
            yield start, at, found[1], found[2].lower(), found[3]
            continue
        if found := _COMMENT.match(page, start):
            at = found.end()
            yield start, at, "", "", ""
            continue
        found = _OPEN.match(page, start)
        if not found:
            at = start + 1
            continue
        end = found.end()
        while (stop := _STOP.search(page, end)) and stop[0] != ">":
            end = stop.end()
            if end <= last[stop[0]]:
                end = page.index(stop[0], end) + 1
        at = stop.end() if stop else len(page)
        if stop:
            yield start, at, found[1], found[2].lower(), page[found.end() : stop.start()]
        else:
            yield start, at, "", "", ""


def walk(page: str) -> Iterator[tuple[str, str]]:
    """("tag", path), ("text", raw text) and ("break", "") of a page in order.

    Unclosed elements end with the element around them, paragraphs with the next block, list
    items and cells with the next one. Inline elements are part of the text around them.
    Comments, declarations and the inside of raw elements are skipped.
    """
    tags: list[str] = []
    there: Counter = Counter()  # open elements by tag
    paths = [""]
    # The path that an element's children extend, and the kinds of the deep elements on it.
    bases: list[tuple[str, frozenset[str]]] = [("", frozenset())]
    at = 0

    def pop(to: int) -> None:
        for tag in tags[to:]:
            there[tag] -= 1
        del tags[to:], paths[to + 1 :], bases[to + 1 :]

    def pop_last(tag: str) -> None:
        to = len(tags) - 1
        while tags[to] != tag:
            to -= 1
        pop(to)

    found = tags_of(page)
    while True:
        start, end, closing, tag, attributes = next(found, (len(page), len(page), "", None, ""))
        if start > at:
            yield "text", page[at:start]
        if tag is None:
            return
        at = end
        if not tag:
            continue
        if closing:
            if tag in INLINE or tag in VOID:
                continue
            yield "break", paths[-1]
            if there[tag]:
                pop_last(tag)
            yield "break", paths[-1]
            continue
        if tag in VOID:
            yield ("text", " ") if tag == "br" else ("void", tag)
            continue
        if tag in INLINE:
            continue
        yield "break", paths[-1]
        if there["p"]:
            pop_last("p")
        ends = CLOSES.get(tag)
        if ends and any(there[other] for other in ends):
            for depth in range(len(tags) - 1, -1, -1):
                if tags[depth] in ends:
                    pop(depth)
                elif tags[depth] in SCOPES:
                    break
        name = _name(tag, attributes)
        base, kinds = bases[-1]
        path = f"{base}/{name}"
        if len(tags) < MOST_DEPTH:
            base = path
        else:
            path += f"[deep={xxhash.xxh64_hexdigest(paths[-1])}]"
            kind = _kind(name)
            if kind and kind not in kinds:
                base, kinds = path, kinds | {kind}
        yield "tag", path
        if tag in RAW:
            ending = re.compile(rf"</{re.escape(tag)}\s*>", re.IGNORECASE).search(page, at)
            at = ending.end() if ending else len(page)
            found = tags_of(page, at)
            continue
        tags.append(tag), paths.append(path), bases.append((base, kinds))
        there[tag] += 1
        yield "break", path


def blocks(events: Iterator[tuple[str, str]]) -> Iterator[tuple[str, list[str]]]:
    """(path, words) of the blocks of text of a page in order."""
    parts, path = [], ""
    for kind, value in [*events, ("break", "")]:
        if kind == "text":
            parts.append(value)
            continue
        if kind == "void":
            if value == "hr":
                kind, value = "break", path
            else:
                continue
        if parts:
            words = entities.unescape("".join(parts)).split()
            if words:
                yield path, words
            parts = []
        if kind == "break":
            path = value


def _number(text: str) -> int:
    """A hash that fits a long."""
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _word_token(path: str, word: str) -> int:
    return _number(f"{path} {word}")


def _elements(path: str) -> list[tuple[str, str]]:
    """(tag, words of the attributes) of the elements on a path."""
    out = []
    for name in path.split("/")[1:]:
        tag, _, rest = name.partition("[")
        out.append((tag, " ".join(x.partition("=")[2].rstrip("]") for x in rest.split("[")) if rest else ""))
    return out


def _is_other(tag: str, words: str, within: bool) -> bool:
    """Whether an element is named as other than main text; `within` an article or main element."""
    if tag in ("html", "body"):
        return False
    if tag in CONTENT:
        return bool(OTHER_ARTICLES.search(words))
    if tag in HEADINGS or tag == "p":
        words = PLACE_WORDS.sub(" ", words)
    if tag in BOILERPLATE_TAGS:
        return not (within and tag == "header")
    return bool(BOILERPLATE_WORDS.search(words))


def is_boilerplate(path: str) -> bool:
    """Whether an element on the path is named as other than main text."""
    within = False
    for tag, words in _elements(path):
        if _is_other(tag, words, within):
            return True
        within = within or tag in CONTENT
    return False


def _is_content(name: tuple[str, str]) -> bool:
    return name[0] in CONTENT or bool(CONTENT_WORDS.search(name[1]))


def _above(path: str) -> Iterator[str]:
    """The paths of the elements around an element."""
    while path := path.rpartition("/")[0]:
        yield path


def _is_named(root: str) -> bool:
    """Whether a content element was found by its name."""
    last = _elements(root)[-1:]
    return bool(last) and last[0][0] not in ("html", "body") and _is_content(last[0])


def content_of(tokens: list[tuple[str, float]]) -> list[str]:
    """The content elements of a template: paths whose texts are the main text.

    `tokens` are the template's paths with their average number of characters a page. Article and
    main elements come first, the outermost of each branch; then elements named as content; then
    the deepest element that holds at least half of the text outside of boilerplate.
    """
    clean = sorted((p, n) for p, n in tokens if not is_boilerplate(p))
    lasts = {p: _elements(f"/{p.rpartition('/')[2]}")[0] if p else ("", "") for p, _ in clean}
    for wanted in (
        lambda e: e[0] == "article",
        lambda e: e[0] == "main",
        lambda e: _is_content(e) and e[0] not in ("html", "body"),
    ):
        hits = [p for p in lasts if wanted(lasts[p])]
        own = set(hits)
        outer = [p for p in hits if own.isdisjoint(_above(p))]
        if outer:
            return outer
    total = sum(n for _, n in clean)
    best = ""
    sums: dict[str, float] = {}
    for path, n in clean:
        for p in (path, *_above(path)):
            sums[p] = sums.get(p, 0.0) + n
    for path, _ in clean:
        held = sums[path]
        if held * 2 >= total and held > 0 and len(path) > len(best) and lasts[path][0] not in ("p", "h1", "h2", "li"):
            best = path
    return [best]


def _mark(host: int, token: int) -> int:
    """The bit of a host's word token."""
    return (host + token) % MARK_BITS


def marks(pages: DataFrame) -> np.ndarray:
    """Bits of the word tokens that LEAST_SHARE of their host's pages may have.

    A token on that share of all pages of a host is on that share of them in one of any groups of
    pages at least, so none is missed. Others are let through by chance or from groups with few
    pages of a host; the counts over all pages decide about them.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes: Counter = Counter()
        held: dict[str, dict[str, Counter]] = {}

        def flush() -> pa.RecordBatch:
            bits = np.zeros(MARK_BITS >> 6, np.uint64)
            for host, own in held.items():
                number, least = _number(host), sizes[host] * LEAST_SHARE
                for path, counts in own.items():
                    for word, n in counts.items():
                        if n >= least:
                            bit = _mark(number, _word_token(path, word))
                            bits[bit >> 6] |= np.uint64(1 << (bit & 63))
            sizes.clear(), held.clear()
            at = np.flatnonzero(bits)
            return pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits[at].view(np.int64))], names=["at", "bits"])

        words = 0
        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1)):
                sizes[host] += 1
                if host == ALL_HOSTS:
                    continue
                own: dict[str, set[str]] = {}
                for path, found in blocks(walk(page.as_py() or "")):
                    own.setdefault(path, set()).update(found)
                to = held.setdefault(host, {})
                for path, found in own.items():
                    counts = to.setdefault(path, Counter())
                    words -= len(counts)
                    counts.update(found)
                    words += len(counts)
                if words > MARK_WORDS:
                    yield flush()
                    words = 0
        yield flush()

    found = pages.select("host", "html").mapInArrow(find, "at long, bits long")
    out = np.zeros(MARK_BITS >> 6, np.uint64)
    for at, bits in found.groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas().itertuples(index=False):
        out[at] = np.int64(bits).view(np.uint64)
    return out


def occurrences(pages: DataFrame) -> DataFrame:
    """A row for each token of a host that may be on enough pages, and for each tag of all hosts.

    `pages` has host, key (a number of the row) and html. Tags have their path, words a null path, a
    hash `token` of path and word, and the hash `near` of the path. Sums are taken in the tasks first.
    """

    marked = marks(pages).tobytes()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            held: dict[tuple[str, str, str | None], list[int]] = {}
            seen: dict[tuple[str, str], dict[str, bool]] = {}
            numbers = {host: _number(host) for host in set(hosts)}
            for host, key, page in zip(hosts, keys, batch.column(2)):
                tags: dict[str, list[int]] = {}
                words: dict[str, Counter] = {}
                events = list(walk(page.as_py() or ""))
                for kind, value in events:
                    if kind == "tag":
                        tags.setdefault(value, [0, 0])[0] += 1
                for path, found in blocks(events):
                    if path in tags:
                        tags[path][1] += sum(map(len, found)) + len(found)
                    if host != ALL_HOSTS:
                        words.setdefault(path, Counter()).update(found)
                vectors: dict[int, int] = {}

                def add(to, path, word, n, chars):
                    vector = vectors.get(n)
                    if vector is None:
                        vector = vectors[n] = xxhash.xxh64_intdigest(f"{key} {n}") >> 24
                    sums = held.get((to, path, word))
                    if sums is None:
                        held[to, path, word] = [vector, 1, n, chars]
                    else:
                        sums[0] += vector
                        sums[1] += 1
                        sums[2] += n
                        sums[3] += chars

                for path, (n, chars) in tags.items():
                    for to in {host, ALL_HOSTS}:
                        add(to, path, None, n, chars)
                for path, counts in words.items():
                    own = seen.setdefault((host, path), {})
                    for word, n in counts.items():
                        wanted = own.get(word)
                        if wanted is None:
                            bit = _mark(numbers[host], _word_token(path, word))
                            wanted = own[word] = bool(marked[bit >> 3] >> (bit & 7) & 1)
                        if wanted:
                            add(host, path, word, n, n * (len(word) + 1))
            near = {path: _number(path) for _, path, _ in held}
            yield pa.RecordBatch.from_arrays(
                [pa.array([to for to, _, _ in held], pa.string()),
                 pa.array([path if word is None else None for _, path, word in held], pa.string()),
                 pa.array([near[path] for _, path, _ in held], pa.int64()),
                 pa.array([0 if word is None else _word_token(path, word) for _, path, word in held], pa.int64()),
                 *(pa.array([v[j] for v in held.values()], pa.int64()) for j in range(4))],
                names=["host", "path", "near", "token", "vector", "pages", "count", "chars"],
            )

    parts = pages.select("host", "key", "html").mapInArrow(
        count, "host string, path string, near long, token long, vector long, pages long, count long, chars long"
    )
    return parts.groupBy("host", "path", "near", "token").agg(
        # Sums of 40-bit numbers; they wrap at the size of a long without harm to equality.
        F.sum(F.col("vector").cast("decimal(38,0)")).alias("vector"),
        *[F.sum(c).alias(c) for c in ("pages", "count", "chars")],
    )


def templates(pages: DataFrame) -> DataFrame:
    """(host, tokens, size): the template of each host of two pages or more, and of all hosts (host '').

    A token is (path, near, token, class); the class is numbered by vector within the host, the class of the
    tokens that every page has once being the root. Tokens on fewer than LEAST_SHARE of the
    host's pages are data, not template.
    """
    sums = occurrences(pages)
    sizes = pages.groupBy("host").agg(F.count("*").alias("size"))
    sizes = sizes.where((F.col("size") > 1) & (F.col("host") != ALL_HOSTS)).unionByName(
        sizes.agg(F.lit(ALL_HOSTS).alias("host"), F.sum("size").alias("size")).where("size is not null")
    )
    # A word on a single page is no template, though it may be half of a host's pages.
    kept = sums.join(sizes, "host").where(
        (F.col("pages") >= F.col("size") * LEAST_SHARE) & (F.col("path").isNotNull() | (F.col("pages") > 1))
    )
    vector = F.concat_ws(":", F.col("vector").cast("string"), "pages", "count")
    return kept.groupBy("host").agg(
        F.collect_list(
            F.struct("path", "near", "token", vector.alias("vector"), (F.col("chars") / F.col("size")).alias("chars"))
        ).alias("tokens"),
        F.first("size").alias("size"),
    )


def contents(found: DataFrame) -> DataFrame:
    """(host, roots, classes, words, runs, whole): the content elements of each template, and its classes.

    `classes` lists the template's classes as path lists. `words` are the template words whose class
    holds a tag of the template, `runs` those of classes of LEAST_WORDS and more. `whole` says that the
    elements named as content stay whole.
    """

    def nest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for host, tokens, pages in zip(frame["host"], frame["tokens"], frame["size"]):
                groups: dict[str, list[str]] = {}
                texts: dict[str, list] = {}
                for t in sorted(tokens, key=lambda t: t["path"] or ""):
                    if t["path"] is None:
                        texts.setdefault(t["vector"], []).append(t)
                    else:
                        groups.setdefault(t["vector"], []).append(t["path"])
                # A class is valid if its tokens nest in the template; one class may hold the parents of
                # another and children of its elements, so the pass is repeated until nothing is added.
                order = sorted(groups.values(), key=lambda g: (min(p.count("/") for p in g), g[0]))
                template: set[str] = {""}
                size = 0
                while len(template) > size:
                    size = len(template)
                    for group in order:
                        for path in group:
                            if path.rpartition("/")[0] in template:
                                template.add(path)
                tags = {v for v, group in groups.items() if not template.isdisjoint(group)}
                words = [t for v, group in texts.items() if v in tags for t in group]
                runs = [t for v, group in texts.items() if v not in tags and len(group) >= LEAST_WORDS for t in group]
                whole = bool(pages < LEAST_PAGES)
                fixed: dict[int, float] = {}
                for t in words:
                    fixed[t["near"]] = fixed.get(t["near"], 0.0) + float(t["chars"])
                own = [
                    (t["path"], max(float(t["chars"]) - fixed.get(t["near"], 0.0), 0.0))
                    for t in tokens if t["path"] is not None and t["path"] in template
                ]
                rows.append((host, content_of(own), [g for g in order if g[0] in template],
                             sorted(t["token"] for t in words), sorted(t["token"] for t in runs), whole))
            yield pd.DataFrame(rows, columns=["host", "roots", "classes", "words", "runs", "whole"])

    return found.mapInPandas(
        nest, "host string, roots array<string>, classes array<array<string>>, words array<long>, runs array<long>, whole boolean"
    )


def _cut(held: list[tuple[str, list[str]]], roots: list[str], words: frozenset[int], runs: frozenset[int],
         whole_only: bool, known: dict[str, dict[str, int]]) -> list[list[str]]:
    """What is left of blocks of main text without the words of the template."""
    marks = []
    for path, block in held:
        tokens = known.setdefault(path, {})
        for word in block:
            if word not in tokens:
                tokens[word] = _word_token(path, word)
        own = [2 if tokens[w] in words else int(tokens[w] in runs) for w in block]
        marks.append((len(own), max(own)) if all(own) else None)
    roots = [r for r in roots if _is_named(r)]
    left, named, named_left = [], 0, 0
    at = 0
    while at < len(held):
        to = at + 1
        while marks[at] and to < len(held) and marks[to]:
            to += 1
        # Constant blocks next to each other are template together.
        long = marks[at] and sum(n for n, _ in marks[at:to]) >= LEAST_WORDS
        goes = long or marks[at] and max(m for _, m in marks[at:to]) == 2
        for path, block in held[at:to]:
            is_named = any(path == r or path.startswith(f"{r}/") for r in roots)
            left.append([] if (long and not whole_only if is_named else goes) else block)
            if is_named:
                named += len(block)
                named_left += len(left[-1])
        at = to
    if not any(left) or named_left * 2 < named:
        return [block for _, block in held]
    return left


def main_text(page: str | None, roots: list[str], words: frozenset[int] = frozenset(),
              runs: frozenset[int] = frozenset(), whole: bool = False, known: dict[str, dict[str, int]] | None = None) -> str:
    """The blocks of a page that lie in one of the content elements, without boilerplate.

    A page without any of the template's content elements falls back on its own: its article or
    main element, or what is outside of boilerplate. `words`, `runs` and `whole` are the template's; `known`
    holds tokens of words by path from page to page.
    """
    if not page:
        return ""
    events = list(walk(page))
    paths = {value for kind, value in events if kind == "tag"}
    inside = [r for r in roots if r in paths or r == ""]
    if not inside:
        inside = content_of([(p, 1.0) for p in paths])
    verdicts: dict[str, bool] = {}

    def counts(path: str) -> bool:
        if path not in verdicts:
            verdicts[path] = any(
                r == "" or path == r or path.startswith(f"{r}/") for r in inside
            ) and not is_boilerplate(path)
        return verdicts[path]

    held = [(path, block) for path, block in blocks(events) if counts(path)]
    left = [block for _, block in held]
    if words or runs:
        left = _cut(held, inside, words, runs, whole, {} if known is None else known)
    return "\n\n".join(" ".join(block) for block in left if block)


def extract(pages: DataFrame, html: str = "html", url: str = "url",
            keep: list[str] | None = None) -> DataFrame:
    """Rows of `pages` as a struct `row` (its columns `keep`), with `host` and `text`, the main text.

    Null and empty pages have an empty text, and so have pages without text in their content.
    Pages with a null or malformed URL use the template of all pages. All rows stay, repeated ones
    too; an empty table gives none.
    """
    small_batches(pages.sparkSession)
    host, _ = host_and_path(F.col(url))
    rows = pages.select(F.struct(*(keep or ["*"])).alias("row"), host.alias("host"), F.col(html).alias("html"))
    keyed = rows.select("host", F.xxhash64("html", "host").alias("key"), "html")
    found = stored(contents(templates(keyed)).select("host", "roots", "words", "runs", "whole"), "templates")
    common = found.where(F.col("host") == ALL_HOSTS).select("roots").first()
    fallback = list(common["roots"]) if common else []
    size = found.agg(F.sum(
        F.length("host") + F.aggregate("roots", F.lit(0), lambda n, r: n + F.length(r)) + 8 * (F.size("words") + F.size("runs"))
    )).first()[0]
    side = F.broadcast(found) if (size or 0) <= BROADCAST_BYTES else found
    kind = f"row {rows.schema['row'].dataType.simpleString()}, host string, text string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, dict[str, int]] = {}
            of: dict[str, tuple[frozenset[int], frozenset[int], bool]] = {}
            texts = []
            for i, (host, roots) in enumerate(zip(batch.column("host").to_pylist(), batch.column("roots").to_pylist())):
                if host not in of:
                    words, runs = (frozenset(batch.column(c)[i].as_py() or ()) for c in ("words", "runs"))
                    of[host] = words, runs, bool(batch.column("whole")[i].as_py())
                page = batch.column("html")[i].as_py()
                texts.append(main_text(page, roots if roots is not None else fallback, *of[host], known))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("host"), pa.array(texts, pa.string())],
                names=["row", "host", "text"],
            )

    return rows.join(side, "host", "left").select("row", "host", "html", "roots", "words", "runs", "whole").mapInArrow(read, kind)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, keep=["page_id", "url"]).select(
        "row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars")
    )
