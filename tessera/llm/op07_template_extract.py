"""Main text of web pages by template deduction over the pages of a host.

Tokens are tags at their place in the page's tree and whole runs of text there. Tokens with one occurrence vector over
the pages of a host form an equivalence class; classes that nearly all pages hold, in one order, are valid and nest
into the host's template. What the template leaves open are slots. Template text goes, inside an article too, but for headings and labels in front
of a slot, which a host may well repeat (Ingredients, Method). Tags and class names only check the slots: menus, notices and the like never are main text.
A page is read by one scan forward, whose time grows with its length, however malformed it is.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]+|=\s*+(?:"[^"]*"|'[^']*')|=)*+)>""")
#: A tag that ends at the first > there is, for pages whose quotes don't close.
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>")
START = re.compile(r"</?[a-zA-Z]")
UNFINISHED = re.compile(r"<[a-zA-Z/!?][^>]*$")
FIRST_CLASS = re.compile(r"""class\s*=\s*["']?([\w-]+)""")
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
#: Elements that end a block of text, elements without content, and elements that hold no main text.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("aside button dialog footer form head menu nav option title".split())
HEADINGS = frozenset("caption dt figcaption h1 h2 h3 h4 h5 h6 summary th".split())
#: Elements whose content is no markup (left out up to the end where they don't close), and others without main text.
RAW = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in ("script", "style", "textarea", "iframe")}
SKIPPED = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in ("noscript", "template", "svg", "select")}
#: Words in class, id and role that name menus, notices, adverts, comments and the like.
MARKS = frozenset("ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies dialog disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice paywall popup promo related replies respond search share sharing sidebar social sponsor sponsored subscribe subscription toolbar topbar widget".split())
#: Words that say of what form or where such a part is.
FORMS = frozenset("area article bar block blog body bottom box button buttons center col column container content desktop entry fixed float footer form global group header holder icon icons image img inner item items js left link links list main message mobile outer page panel placeholder post primary reader right row secondary section site slot sticky text thread title top unit user widget wrap wrapper".split())
WORDS = re.compile(r"[a-z]+")


@lru_cache(maxsize=20_000)
def marked(attributes: str) -> bool:
    """Whether a name in class, id or role is that of something beside the main text, or the element is hidden.

    All words of such a name speak of the thing or its form (comment-list); a name that only holds such a word
    (share-price-table, comment-enabled) does not count.
    """
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name in ("class", "id", "role") and any(not MARKS.isdisjoint(own) and (MARKS | FORMS).issuperset(own) for own in map(WORDS.findall, value.split())):
            return True
    return False


class Place(NamedTuple):
    """Where something stands: a hash of the path of elements, whether one around holds no main text, the article (2, or 1 where
    its name is that of a comment or the like, 0 for none), and the block around with the path that this block is in."""

    path: int
    aside: bool
    article: int
    block: str
    parent: int


def path_hash(parent: int, name: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{parent} {name}")


def parsed(page: str) -> Iterator[tuple[str, str, Place]]:
    """(kind, text or name, place) for each run of text and each tag, in page order; kind is text, open or end.

    A paragraph ends where a block begins; an end tag without its start is passed over; raw text elements and
    comments are left out.
    """
    root = Place(0, False, 0, "", 0)
    stack: list[tuple[str, Place, int]] = [("", root, 0)]  # name, place, where a paragraph is open in the block around (0: nowhere)
    open_, unclosed = Counter(), set()
    last, quoted, start, at = page.rfind(">"), True, 0, 0

    def cut(i: int) -> None:
        for name, _, _ in stack[i:]:
            open_[name] -= 1
        del stack[i:]

    while (i := page.find("<", at)) >= 0 and i < last:
        m = None
        if START.match(page, i):
            m = TAG.match(page, i) if quoted else None
            if not m:  # quotes run to the end of the page: from here on they don't count
                quoted, m = False, PLAIN_TAG.match(page, i)
            end = m.end()
        elif page.startswith("<!--", i):
            end = page.find("-->", i + 4) + 3
            end = end if end > 2 else len(page)
        elif page.startswith(("<!", "<?"), i):
            end = page.find(">", i) + 1
        else:
            at = i + 1
            continue
        if i > start:
            yield "text", page[start:i], stack[-1][1]
        start = at = end
        if not m:
            continue
        name, attributes = m[2].lower(), m[3]
        if m[1]:
            if open_[name]:
                k = len(stack) - 1
                while stack[k][0] != name:
                    k -= 1
                cut(k)
            yield "end", name, root
            continue
        if name in RAW or name in SKIPPED and name not in unclosed:
            close = (RAW.get(name) or SKIPPED[name]).search(page, end)
            if not close:
                unclosed.add(name)
            if close or name in RAW:
                start = at = close.end() if close else len(page)
                continue
        if name in BLOCKS and stack[-1][2]:
            cut(stack[-1][2])
        _, place, paragraph = stack[-1]
        own = FIRST_CLASS.search(attributes) if attributes else None
        path = path_hash(place.path, f"{name}.{own[1]}" if own else name)
        aside, article = place.aside, place.article
        beside = bool(attributes) and marked(attributes)
        if name in ("article", "main"):
            if beside and article:
                aside = True
            article = max(article, 1 if beside else 2)
        elif name in ASIDE or name in SKIPPED or name == "header" and not article or beside and name not in ("html", "body"):
            aside = True
        block = name in BLOCKS
        here = Place(path, aside, article, name if block else place.block, place.path if block else place.parent)
        yield "open", name, here
        if name not in VOID and not attributes.endswith("/"):
            stack.append((name, here, len(stack) if name == "p" else 0 if block else paragraph))
            open_[name] += 1
    if start < len(page):
        yield "text", UNFINISHED.sub("", page[start:]), stack[-1][1]


def squeezed(text: str) -> str:
    return " ".join(html.unescape(text).split())


def token_of(kind: str, path: int, text: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind} {path} {text}") - (1 << 63)


def page_tokens(page: str | None) -> tuple[int, dict[int, list[int]]]:
    """A hash of a page's content (its text in the article, or else beside no aside), and the places of each token, counted in tokens."""
    out: dict[int, list[int]] = {}
    at, texts = 0, ([], [], [])
    for kind, text, place in parsed(page or ""):
        if kind == "end" or kind == "text" and not (text := squeezed(text)):
            continue
        if kind == "text" and not place.aside:
            texts[place.article].append(text)
        out.setdefault(token_of(kind, place.path, "" if kind == "open" else text), []).append(at)
        at += 1
    return token_of("page", 0, " ".join(texts[2] or texts[1] or texts[0])), out


class Block(NamedTuple):
    article: int
    fixed: bool  # all of its runs of text are the template's
    heading: bool
    parent: int
    text: str


def blocks_of(page: str | None, template: frozenset[int]) -> list[Block]:
    """The blocks of text that are beside no aside, in page order."""
    out: list[Block] = []
    runs: list[tuple[Place, bool, str]] = []

    def flush() -> None:
        own = [r for r in runs if not r[0].aside]
        if own and (text := squeezed("".join(r[2] for r in own))):
            first = next(r[0] for r in own if r[2].strip())
            out.append(Block(max(r[0].article for r in own), all(r[1] or not r[2].strip() for r in own), first.block in HEADINGS, first.parent, text))
        runs.clear()

    for kind, text, place in parsed(page or ""):
        if kind == "text":
            runs.append((place, bool(template) and token_of("text", place.path, squeezed(text)) in template, text))
        elif text in BLOCKS:
            flush()
        elif kind == "open" and text == "br":
            runs.append((place, True, " "))
    flush()
    return out


def main_text(page: str | None, template: frozenset[int] = frozenset()) -> str:
    """The main text of one page: its blocks in page order, joined by two line ends.

    Where the page has an article (or main) element, only blocks in it count, and those of an article with a name like comment
    only where there is no other. Template blocks go, but for headings and labels before a slot, which are part of the text
    (outside an article only right before it, in the same element). An article without any slot stays whole.
    """
    every = blocks_of(page, template)
    article = max((b.article for b in every), default=0)
    own = [b for b in every if b.article == article]
    slots = [i for i, b in enumerate(own) if not b.fixed]
    if article:
        kept = [b for i, b in enumerate(own) if not slots or not b.fixed or b.heading and i < slots[-1]]
    else:
        kept, leads = [], None
        for b in reversed(own):
            stays = not b.fixed or b.heading and leads == b.parent
            leads = b.parent if stays else None
            if stays:
                kept.append(b)
        kept.reverse()
    return "\n\n".join(b.text for b in kept)


def host_of(url: str = "url"):  # noqa: ANN201
    return F.lower(F.coalesce(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit("")))


def templates(pages: DataFrame, share: float = 0.9, least_pages: int = 3) -> DataFrame:
    """host, class, parent, gap, tokens: the valid classes of each host's pages, nested.

    A class is all tokens of one occurrence vector over the distinct contents of the host's pages (compared by a sum of
    hashes of content and count), so that copies of a page, whatever stands around the main text, are no template. It is
    valid with two tokens or more, on the share ``share`` of the host's contents and ``least_pages`` at least, where the
    tokens stand in one order on every page. Its parent is the class whose tokens enclose it most
    tightly, gap the place among them; null at the root. A class that is not in one gap of one parent on the share ``share`` of
    its pages does not nest and is no part of the template. Pages without a host are one host; a null html is empty.
    """
    spark = pages.sparkSession
    own = pages.select(host_of().alias("host"), F.col("html"))
    # a host's token rows are grouped by content, then summed up in each task, so that a host with many pages is no large
    # group; the row without a token stands for the content itself
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for host, text in zip(*(b.column(c).to_pylist() for c in ("host", "html")), strict=True):
                content, places = page_tokens(text)
                rows += [(host, content, None, 1), *((host, content, token, len(at)) for token, at in places.items())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["host", "content", "token", "n"])

    distinct = own.mapInArrow(tokens, "host string, content long, token long, n long").groupBy("host", "token", "content").agg(F.max("n").alias("n"))
    vectors = distinct.groupBy("host", "token").agg(F.count("*").alias("support"), F.sum(F.pmod(F.xxhash64("content", "n"), F.lit(1 << 40))).alias("vector"))
    vectors = stored(vectors.where(F.col("support") >= least_pages), "vectors")
    sizes = vectors.where("token IS NULL").select("host", F.col("support").alias("contents"))
    often = vectors.where("token IS NOT NULL").join(sizes, "host").where(F.col("support") >= share * F.col("contents"))
    classes = often.groupBy("host", "vector", "support").agg(F.sort_array(F.collect_list("token")).alias("tokens")).where(F.size("tokens") > 1)
    classes = stored(classes.select("host", F.col("vector").alias("class"), "tokens"), "classes")
    by_host = stored(classes.groupBy("host").agg(F.collect_list(F.struct("class", "tokens")).alias("classes")), "host-classes")

    def orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for host, text, known in zip(*(b.column(c).to_pylist() for c in ("host", "html", "classes")), strict=True):
                at = page_tokens(text)[1]
                places = {c["class"]: sorted((p, t) for t in c["tokens"] for p in at.get(t, ())) for c in known}
                spans = {c: (p[0][0], p[-1][0]) for c, p in places.items() if p}
                for c, (s, e) in spans.items():
                    around = [(spans[o][1] - spans[o][0], o) for o in spans if spans[o][0] < s and e < spans[o][1]]
                    parent = min(around)[1] if around else None
                    gap = sum(p < s for p, _ in places[parent]) if around else None
                    rows.append((host, c, xxhash.xxh3_64_intdigest(repr([t for _, t in places[c]])) - (1 << 63), parent, gap))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))], ["host", "class", "ordered", "parent", "gap"])

    seen = own.join(by_host, "host").select("host", "html", "classes").mapInArrow(orders, "host string, class long, ordered long, parent long, gap long")
    # tokens that occur alike but in another order on some page are no frame; nor are those that don't nest
    by_place = seen.groupBy("host", "class", "parent", "gap").agg(F.count("*").alias("n"), F.min("ordered").alias("a"), F.max("ordered").alias("b"))
    place = F.struct("n", "parent", "gap")
    nested = by_place.groupBy("host", "class").agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("n").alias("n"), F.max(place).alias("p"))
    nested = nested.where(F.col("a") == F.col("b")).where(F.col("p.n") >= share * F.col("n"))
    return classes.join(nested.select("host", "class", "p"), ["host", "class"]).select("host", "class", "p.parent", "p.gap", "tokens")


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) for every row of ``pages`` (page_id, url, html).

    A null or empty html, or one without main text, gives the empty text; pages of any length are read whole. Null ids and
    urls stay (pages without a host are one host); repeated rows give repeated results; other columns are not read. An empty
    table gives no rows.
    """
    frames = templates(pages).groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("tokens"))
    frames = stored(frames.select(F.col("host").alias("of_host"), "tokens"), "templates")
    own = pages.select(F.col("page_id").cast("long"), "url", "html").withColumn("of_host", host_of())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, template = None, frozenset()
        for b in batches:
            texts = []
            for text, tokens in zip(b.column("html").to_pylist(), b.column("tokens"), strict=True):
                if tokens.is_valid:
                    key = tokens.values.to_numpy()
                    if last is None or len(key) != len(last) or (key != last).any():
                        last, template = key, frozenset(key.tolist())
                texts.append(main_text(text, template if tokens.is_valid else frozenset()))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return own.join(frames, "of_host", "left").select("page_id", "url", "html", "tokens").mapInArrow(run, "page_id long, url string, text string, n_chars long")
