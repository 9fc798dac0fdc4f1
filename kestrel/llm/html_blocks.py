"""Main text of web pages by a recurrent block labeller.

A page is read into its leaf blocks: runs of text without a block-level tag
between them, each with the path of open tags.  A block's vector holds its hashed
path (tag names and the words of class, id and role), its hashed words and a few
measures.  A bidirectional LSTM in numpy reads a page's blocks in order, so each
is labelled in the context of the whole page, and blocks labelled as content make
the text.

The network is trained on a bounded sample of the pages.  Their blocks are
labelled by what HTML itself says of a section (elements for navigation, asides,
footers, forms, and words that name such sections in class, id and role), and the
same blocks are put into page layouts drawn at random, where the label is known.

Defined results: null html is an empty page with empty text; character references
are decoded once; white space (that of Unicode) inside a block becomes one blank;
scripts, styles, templates, noscript, titles, iframes and comments are never text;
svg, math, object and canvas are, as part of the block they stand in; unclosed
elements end with the page.  Rows that repeat give repeated results; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm import lstm
from kestrel.llm.common import map_batches, text_of
from kestrel.llm.shingles import span_hashes

#: Pages that the network is trained on at most, and layouts drawn for all of them together.
TRAIN_PAGES, LAYOUTS = 250, 750
PATH_DIMS, WORD_DIMS, MEASURES = 192, 32, 6
UNITS, EPOCHS, BATCH, RATE, SEED = 24, 6, 32, 0.01, 3
#: Pages read by the network at once, and pages times the blocks of the longest; a longer page is read in parts.
READ, READ_BLOCKS = 128, 8192
#: Bytes of the pages sampled, characters of one of them, and blocks of all training pages, about.
TRAIN_BYTES, TRAIN_CHARS, TRAIN_BLOCKS = 1 << 25, 1 << 20, 200_000

# fixed values: elements of HTML
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math object q rp rt ruby s samp small "
                    "span strike strong sub sup svg time tt u var wbr canvas".split())
# fixed values: elements whose content is not HTML, and the HTML elements that end it all the same
_FOREIGN = frozenset(["svg", "math"])
_ENDS_FOREIGN = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta "
                          "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CLOSED_BY_BLOCK = frozenset(["p"])
_CLOSED_BY_SAME = frozenset("li dt dd tr td th option thead tbody tfoot".split())
# fixed values: sections that are not the article, by element and by the words that name them
_ASIDE_TAGS = frozenset("nav footer aside form menu dialog button select textarea fieldset label".split())
_ASIDE_WORDS = frozenset("ad ads advert advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
                         "notice alert modal popup overlay dialog menu nav navbar navigation breadcrumb breadcrumbs topbar masthead "
                         "sidebar aside widget widgets related recommended share sharing social newsletter subscribe signup login "
                         "search footer copyright legal comment comments reply replies respond disqus discussion pagination pager "
                         "toolbar skip tags complementary contentinfo search form".split())

def _tokens(raw_end: str) -> re.Pattern[str]:
    return re.compile(
        r"<!--.*?(?:-->|\Z)"
        r"|<(?P<raw>script|style|noscript|template|title|iframe)(?=[\s/>])[^>]*" + raw_end + r">.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
        r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
        r"|</?[a-zA-Z][^\s/>]*(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+\Z"
        r"|</?[a-zA-Z!?][^>]*(?:>|\Z)", re.S | re.I)


#: In svg and math, '/>' closes any element.
_TOKEN, _FOREIGN_TOKEN = _tokens(""), _tokens("(?<!/)")
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")


@lru_cache(maxsize=20_000)
def _tag(name: str, attrs: str) -> tuple[tuple[int, ...], bool]:
    """Path dimensions of an open tag, and whether it says that its section is not the article."""
    words = [name]
    for m in _ATTR.finditer(attrs):
        words += _WORD.findall((m[2] or m[3] or m[4] or "").lower())
    dims = tuple(crc32(w.encode()) % PATH_DIMS if i else crc32(b"<" + w.encode()) % PATH_DIMS for i, w in enumerate(words))
    return dims, name in _ASIDE_TAGS or any(w in _ASIDE_WORDS for w in words[1:])


class Block:
    """A leaf block: its text, the dimensions of its path, characters in links, and what its path says of it."""
    __slots__ = ("aside", "linked", "path", "text")

    def __init__(self, text: str, path: list[int], linked: int, aside: bool):
        self.text, self.path, self.linked, self.aside = text, path, linked, aside


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, empty ones left out."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[int, ...], bool]] = []
    parts: list[str] = []
    linked = links = at = 0
    foreign = ""            # svg or math, when inside

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                header = any(s[0] == "header" for s in stack) and not any(s[0] in ("article", "main") for s in stack)
                out.append(Block(text, list({d for s in stack for d in s[1]}), linked, header or any(s[2] for s in stack)))
            parts.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if links:
            linked += len(text)

    while m := (_FOREIGN_TOKEN if foreign else _TOKEN).search(page, at):
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        name = m["tag"]
        if name is None:
            continue
        name = name.lower()
        if foreign and (any(s[0] == name for s in stack) if m["end"] else name in _ENDS_FOREIGN):
            foreign = ""
        if foreign:
            if m["end"] and name == foreign:
                foreign = ""
            elif foreign == "svg":
                parts.append(" ")
        elif name in _FOREIGN and not m["end"]:
            foreign = "" if m["attrs"].endswith("/") else name
        elif name == "br":
            parts.append(" ")
        elif name in _INLINE:
            if name == "a":
                links = max(0, links + (-1 if m["end"] else 1))
        elif m["end"]:
            flush()
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
        else:
            flush()
            if name in _VOID:
                continue
            while stack and (stack[-1][0] in _CLOSED_BY_BLOCK or stack[-1][0] == name and name in _CLOSED_BY_SAME):
                stack.pop()
            stack.append((name, *_tag(name, m["attrs"])))
            links = 0
    if at < len(page):
        say(page[at:])
    flush()
    return out


def vectors(pages: list[list[Block]]) -> np.ndarray:
    """One row for each block of all pages: hashed path, hashed words, measures."""
    flat = [b for page in pages for b in page]
    n = len(flat)
    x = np.zeros((n, PATH_DIMS + WORD_DIMS + MEASURES), dtype=np.float32)
    if not n:
        return x
    size = np.array([len(b.path) for b in flat])
    row = np.repeat(np.arange(n), size)
    x[row, np.fromiter((d for b in flat for d in b.path), dtype=np.int64, count=int(size.sum()))] = 1
    raw = [b.text.lower().encode("utf-8", "surrogatepass") for b in flat]
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], ends[:-1] + 1])
    bucket = (span_hashes(data, starts, ends) % np.uint64(WORD_DIMS)).astype(np.int64)
    words = np.array([r.count(b" ") + 1 for r in raw])
    bag = np.bincount(np.repeat(np.arange(n), words) * WORD_DIMS + bucket, minlength=n * WORD_DIMS).reshape(n, WORD_DIMS)
    x[:, PATH_DIMS:PATH_DIMS + WORD_DIMS] = bag / np.sqrt((bag * bag).sum(axis=1, keepdims=True))
    length = np.array([len(b.text) for b in flat])
    count = np.array([len(p) for p in pages if p])
    place = np.arange(n) - np.repeat(np.cumsum(count) - count, count)
    x[:, -6] = np.log1p(length) / 8
    x[:, -5] = np.array([b.linked for b in flat]) / np.maximum(length, 1)
    x[:, -4] = np.log1p(words) / 6
    x[:, -3] = [b.text[-1] in ".!?…\"'”)" for b in flat]
    x[:, -2] = place / np.repeat(count, count)
    x[:, -1] = 1
    return x


def initial(seed: int = SEED) -> dict[str, np.ndarray]:
    r, dims = np.random.default_rng(seed), PATH_DIMS + WORD_DIMS + MEASURES
    p = {}
    for d in "fb":
        p["x" + d] = r.normal(0, 0.1, (dims, 4 * UNITS)).astype(np.float32)
        p["x" + d][-1, UNITS:2 * UNITS] = 1             # the last measure is constant: remember at first
        p["h" + d] = r.normal(0, 0.2, (UNITS, 4 * UNITS)).astype(np.float32)
    p["o"], p["e"], p["b"] = (r.normal(0, s, d).astype(np.float32) for s, d in ((0.2, 2 * UNITS), (0.01, dims), (0.0, 1)))
    return p


def _scores(p: dict, x: np.ndarray, sizes: np.ndarray, keep: bool = False) -> tuple[np.ndarray, np.ndarray, tuple]:
    """Content scores (time, batch) of pages whose blocks are x (time, batch, dims), each read from both its ends."""
    steps = np.arange(len(x))[:, None]
    turned = np.where(steps < sizes, sizes - 1 - steps, steps)           # the way back starts at the last block
    batch = np.arange(x.shape[1])
    ahead, kf = lstm.forward(x @ p["xf"], p["hf"], keep)
    behind, kb = lstm.forward((x @ p["xb"])[turned, batch], p["hb"], keep)
    both = np.concatenate([ahead, behind[turned, batch]], axis=2)
    return both @ p["o"] + x @ p["e"] + p["b"], both, (kf, kb, turned, batch)


def _padded(x: np.ndarray, sizes: list[int]) -> np.ndarray:
    out, at = np.zeros((max(sizes), len(sizes), x.shape[1]), dtype=np.float32), 0
    for i, n in enumerate(sizes):
        out[:n, i] = x[at:at + n]
        at += n
    return out


def train(pages: list[tuple[list[Block], list[bool]]], epochs: int = EPOCHS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Parameters from labelled pages (True: content); logistic loss, Adam."""
    p, r = initial(seed), np.random.default_rng(seed)
    adam = lstm.Adam(p)
    pages = [x for x in pages if x[0]]
    ready = [(vectors([b]), np.array(y, dtype=np.float32)) for b, y in pages]
    for epoch in range(epochs):
        order = r.permutation(len(ready))
        for at in range(0, len(order), BATCH):
            part = sorted((ready[i] for i in order[at:at + BATCH]), key=lambda v: len(v[1]))
            sizes = np.array([len(y) for _, y in part])
            x = _padded(np.concatenate([v for v, _ in part]), sizes.tolist())
            y = _padded(np.concatenate([v for _, v in part])[:, None], sizes.tolist())[:, :, 0]
            score, both, (kf, kb, turned, batch) = _scores(p, x, sizes, keep=True)
            real = np.arange(len(x))[:, None] < sizes
            ds = ((lstm.sigmoid(score) - y) * real / real.sum()).astype(np.float32)
            flat = x.reshape(-1, x.shape[2])
            grad = {"o": ds.reshape(-1) @ both.reshape(-1, 2 * UNITS), "e": ds.reshape(-1) @ flat, "b": ds.sum(keepdims=True).reshape(1)}
            dboth = ds[:, :, None] * p["o"]
            dz, grad["hf"] = lstm.back(dboth[:, :, :UNITS], kf, p["hf"])
            grad["xf"] = flat.T @ dz.reshape(-1, 4 * UNITS)
            dz, grad["hb"] = lstm.back(dboth[:, :, UNITS:][turned, batch], kb, p["hb"])
            grad["xb"] = x[turned, batch].reshape(flat.shape).T @ dz.reshape(-1, 4 * UNITS)
            adam.apply(grad, RATE * (1 - epoch / epochs))
    return p


def label(p: dict, pages: list[list[Block]]) -> list[np.ndarray]:
    """For each page, which blocks are content."""
    out: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(pages)
    order = sorted((i for i, b in enumerate(pages) if b), key=lambda i: len(pages[i]))
    while order:
        n = next((k for k, i in enumerate(order[:READ]) if (k + 1) * len(pages[i]) > READ_BLOCKS), len(order[:READ]))
        if not n:       # this page and all after it are over the bound
            break
        part, order = order[:n], order[n:]
        sizes = [len(pages[i]) for i in part]
        score, _, _ = _scores(p, _padded(vectors([pages[i] for i in part]), sizes), np.array(sizes))
        for k, i in enumerate(part):
            out[i] = score[:sizes[k], k] > 0
    for i in order:
        out[i] = _long_scores(p, pages[i]) > 0
    return out


def _long_scores(p: dict, page: list[Block]) -> np.ndarray:
    """Content scores of one page, READ_BLOCKS blocks at a time; the states are carried on."""
    score = np.zeros(len(page), dtype=np.float32)
    starts, ahead, behind = range(0, len(page), READ_BLOCKS), [], []
    for way, lows in ((1, starts), (-1, reversed(starts))):
        for lo in lows:
            part = page[lo:lo + READ_BLOCKS]
            x = vectors([part])
            x[:, -2] = (lo + np.arange(len(part))) / len(page)
            if way > 0:
                got, _ = lstm.forward((x @ p["xf"])[:, None], p["hf"], state=ahead)
                score[lo:lo + len(part)] += got[:, 0] @ p["o"][:UNITS] + x @ p["e"] + p["b"]
            else:
                got, _ = lstm.forward((x @ p["xb"])[::-1, None], p["hb"], state=behind)
                score[lo:lo + len(part)] += got[::-1, 0] @ p["o"][UNITS:]
    return score


# ---- training pages ----

def _layout(content: list[str], other: list[str], r: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """A page drawn at random around the content, its sections filled with the texts ``other``."""
    def pick(*options: str) -> str:
        return options[r.integers(len(options))]

    def words(n: int) -> str:
        return " ".join(" ".join(other[r.integers(len(other))].split()[:n]) for _ in range(1 + int(r.integers(2)))) if other else "x"

    def link() -> str:
        return f'<a href="/x">{words(2)}</a>'

    def listing(n: int) -> str:
        return "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(n)) + "</ul>"

    def wrap(spec: str, inner: str) -> str:
        return f"<{spec}>{inner}</{spec.split()[0]}>"

    def aside() -> str:
        kind = r.integers(8)
        if kind == 0:
            return wrap(pick("nav", 'div class="menu"', 'div id="navbar"', 'ul class="nav main-nav"', 'div class="breadcrumbs"',
                             'div role="navigation"', 'nav class="pagination"'), listing(2 + int(r.integers(6))))
        if kind == 1:
            return wrap(pick("header", 'div class="header"', 'div id="masthead"', 'header class="site-header"', 'div class="topbar"'),
                        pick(f"<h1>{words(3)}</h1>", f"<p>{words(5)}</p>", f"<div>{words(3)}</div>") + (listing(3) if r.integers(2) else ""))
        if kind == 2:
            return wrap(pick("aside", 'div class="sidebar"', 'div id="sidebar"', 'section class="widget related"', 'div class="recommended"',
                             'aside class="more"', 'div class="share social"'),
                        f"<h3>{words(3)}</h3>" + pick(listing(4), f"<p>{words(20)}</p>", f"<p>{words(12)}</p><p>{words(9)}</p>"))
        if kind == 3:
            return wrap(pick('div class="cookie-banner"', 'div id="cookie-consent"', 'div class="notice"', 'div role="alert"',
                             'div class="modal popup"', 'div role="dialog"', 'p class="notice"', "dialog", 'div class="gdpr"'),
                        words(15) + pick("", f"<button>{words(1)}</button>"))
        if kind == 4:
            return wrap(pick('div class="ad"', 'div class="ads banner"', 'div id="ad-top"', 'div class="advertisement"',
                             'section class="sponsored promo"', 'aside class="ad"', 'ins class="ad"', 'div class="promo"'),
                        pick(words(10), f"<p>{words(25)}</p>", link()))
        if kind == 5:
            return wrap(pick("form", 'form class="search"', 'div class="newsletter"', 'form id="login"', 'div class="subscribe"', 'form class="signup"'),
                        f"<label>{words(2)}</label><input name='q'><button>{words(1)}</button>" + pick("", f"<p>{words(9)}</p>"))
        if kind == 6:
            one = pick('div class="comment"', "li", "article", 'div class="reply"', 'li class="comment"', "p")
            return wrap(pick('div class="comments"', 'section id="comments"', 'div id="disqus"', 'ol class="comment-list"',
                             'section class="comments"', 'div class="discussion comments"'),
                        f"<h3>{words(2)}</h3>" + "".join(wrap(one, pick(f"<p>{words(30)}</p>", words(20))) for _ in range(1 + int(r.integers(4)))))
        return wrap(pick("footer", 'div class="footer"', 'div id="footer"', 'footer class="site"', 'div class="copyright legal"',
                         'div role="contentinfo"'), pick(f"&copy; {words(6)}", f"<p>{words(12)}</p>", listing(3) + f"<p>{words(4)}</p>"))

    mark = "\x01"       # content is marked while the page is made
    body = []
    for i, text in enumerate(content):
        tag = pick("p", "p", "p", "p", "div", "blockquote", "li", "td", "pre") if i else pick("h1", "h1", "h2", "p")
        part = f"<{tag}>{mark}{html.escape(text)}</{tag}>"
        body.append({"li": f"<ul>{part}</ul>", "td": f"<table><tr>{part}</tr></table>"}.get(tag, part))
        if r.random() < 0.06:
            body.append(aside())
        if r.random() < 0.04:
            body.append(f"<h2>{mark}{words(3)}</h2>")
    if body and r.random() < 0.25:
        body[0] = wrap("header", body[0])
    shell = pick("article", "main", 'div class="content"', 'div id="content"', 'div class="post"', 'div class="entry-content"',
                 'div class="article-body"', "div", "section", 'div class="text"', 'article class="post"', 'div role="main"')
    inner = wrap(shell, "".join(body))
    if r.random() < 0.4:
        inner = wrap(pick("main", 'div id="main"', 'div class="container"', 'div class="wrapper"', "div", "article"), inner)
    before, after = "".join(aside() for _ in range(r.integers(4))), "".join(aside() for _ in range(r.integers(5)))
    found = blocks(f"<html><body>{before}{inner}{after}</body></html>")
    good = [mark in b.text for b in found]
    for b in found:
        b.text = b.text.replace(mark, "") or "x"
    return found, good


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most: int = TRAIN_PAGES) -> dict[str, np.ndarray] | None:
    """Train on a sample of about ``most`` pages, those with the smallest hashes of id and page; at least one.

    Training reads the beginning and the end of long pages; what is trained labels every page whole.  None
    only when no page has html.
    """
    unit = F.pmod(F.xxhash64(F.lit("layout"), F.col(id_col), F.col(html_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    full = pages.where(F.length(html_col) > 0).withColumn("__unit", unit)
    n, least = full.agg(F.count(F.lit(1)), F.min("__unit")).first()
    if not n:
        return None
    rows = full.where((F.col("__unit") * n < most) | (F.col("__unit") == least)).select(
        F.xxhash64(id_col, html_col).alias("k"), F.substring(html_col, 1, TRAIN_CHARS).alias("h"))
    chosen, held = [], 0
    for x in rows.select("k", F.octet_length("h").alias("bytes")).orderBy("k").limit(2 * most).collect():
        if not chosen or held + x.bytes <= TRAIN_BYTES:
            chosen.append(x.k)
            held += x.bytes
    if not chosen:
        return None
    # equal pages have one hash: they are taken as often as they were counted
    texts = {x.k: x.h for x in rows.where(F.col("k").isin(list(set(chosen)))).groupBy("k").agg(F.first("h").alias("h")).collect()}
    longest = TRAIN_BLOCKS // (len(chosen) + LAYOUTS)
    read = []
    for k in chosen:
        page = blocks(texts[k])
        read.append(page if len(page) <= longest else page[:longest // 2] + page[-(longest // 2):])
    r = np.random.default_rng(SEED)
    other = [b.text for page in read for b in page if b.aside] or ["more"]
    out = []
    for page in read:
        out.append((page, [not b.aside for b in page]))
        content = [b.text for b in page if not b.aside]
        for _ in range(-(-LAYOUTS // len(read))):
            # sections may hold as much prose as the article does
            strange = read[r.integers(len(read))]
            out.append(_layout(content, [*other[:50], *(b.text for b in strange)] if content else other, r))
    return train(out)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, n_blocks and n_content of every page."""
    sent = pages.sparkSession.sparkContext.broadcast(learn(pages, id_col, html_col))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, counts = [], []
        for part in _bounded(batch.column(2).to_pylist()):
            read = [blocks(h) for h in part]
            for page, good in zip(read, label(sent.value, read) if sent.value else [()] * len(read)):
                texts.append(" ".join(b.text for b, ok in zip(page, good) if ok))
                counts.append((len(page), int(sum(good))))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
             *(pa.array([c[i] for c in counts], pa.int64()) for i in (0, 1))],
            ["page_id", "url", "text", "n_chars", "n_blocks", "n_content"])
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), text_of(html_col).alias("html"))
    return map_batches(src, "page_id long, url string, text string, n_chars long, n_blocks long, n_content long", run)


def _bounded(pages: list[str], size: int = 1 << 22) -> Iterator[list[str]]:
    """The pages in order, in lists of about ``size`` characters."""
    held, n = [], 0
    for page in pages:
        held.append(page)
        n += len(page)
        if n >= size:
            yield held
            held, n = [], 0
    if held:
        yield held
