"""Main text of web pages: sum-product inference on the DOM tree.

Every block element, and every element within a block that has a class, id or role, is a binary variable (content or not). Unary potentials are linear in its tag, class and id
words, text length and link share; a 2 x 2 table couples parent and child, one for blocks and one for elements within a block. Messages run from the leaves to the root and
back, level by level for a whole batch of pages, and give each element's content marginal; elements from 0.5 on are kept.
The weights are trained by gradient ascent on the likelihood of labelled pages, made by ``labelled_pages`` from a
small grammar of articles and page furniture.

Scripts, styles, head, comments and form controls hold no text by definition and never enter the tree.

Edge cases: null and empty html give an empty text; unclosed, misnested and cut off markup is closed at the next
block; a cut off tag at the end is dropped; text right in html or body is a block of its own between its neighbours;
repeated rows extract alike; deep trees are walked without recursion; extra columns are kept; an empty table gives an
empty result.
"""

from __future__ import annotations

import functools
import html as entities
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

#: Comments, CDATA and declarations; tags with their attributes as HTML reads them (a quote only counts after an equals sign);
#: text. Runs are possessive, so that no page takes more than linear time.
_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([A-Za-z][A-Za-z0-9:-]*+)"""
                    r"""((?:[\s/]++|[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?)?|=)*+)>|[^<]++|<""", re.S)
_CUT = re.compile(r"""<(?:[A-Za-z/!?][^<>]*)?$""")
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[A-Za-z]+")
SILENT = frozenset("script style noscript template head title svg math iframe object select textarea button canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html body div p article section main nav header footer aside h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody"
    " tfoot tr td th caption blockquote pre figure figcaption form fieldset address details summary dialog menu center hr".split())
#: A start tag closes an open element of these names.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
INLINE = "span"  # stands for every named element within a block
TAGS = sorted(BLOCK | {INLINE})
HASHED = 4096
N_FEATURES = 2 * len(TAGS) + HASHED + 10


def parse(page: str):
    """(tags, parents, names, lines): elements in page order, and the blocks' text as lines of (element, text, linked characters).

    Elements are the blocks and, within them, those with a class, id or role of their own.
    """
    tags, parents, names, lines = ["html"], [-1], [""], []
    stack: list[tuple[str, int]] = [("html", 0)]  # open tags with their nearest element
    text: list[list] = []  # of the open block: element, text, linked characters
    links = 0

    def flush():
        line = [(at, entities.unescape(s), k) for at, s, k in text]
        text.clear()
        if not any(s.strip() for _, s, _ in line):
            return
        if any(not at and s.strip() for at, s, _ in line):  # text right in the page is a block of its own, named body
            tags.append("body")
            parents.append(0)
            names.append("")
            line = [(at or len(tags) - 1, s, k) for at, s, k in line]
        lines.append(line)

    def add(s):
        at = stack[-1][1]
        if text and text[-1][0] == at:
            text[-1][1] += s
        else:
            text.append([at, s, 0])
        text[-1][2] += len(s) if links else 0

    pos, page = 0, _CUT.sub("", page)
    while m := _TOKEN.match(page, pos):
        pos = m.end()
        name = m[2]
        if name is None:
            if not m[0].startswith(("<!", "<?")):
                add(m[0])
            continue
        tag = name.lower()
        if tag in SILENT:
            if not m[1] and not m[3].endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, pos)
                if tag == "head" and end is None:
                    continue
                pos = end.end() if end else len(page)
            continue
        block = tag in BLOCK
        if tag == "br":
            add(" ")
        if tag == "a":
            links = max(0, links - 1) if m[1] else links + 1
        if m[1]:
            at = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == tag), 0)
            if at and (block or not any(t in BLOCK for t, _ in stack[at + 1:])):
                if block:
                    flush()
                del stack[at:]
            continue
        if tag in VOID:
            if block:
                flush()
            continue
        if tag in ("html", "body"):
            names[0] += " " + m[3]
            continue
        if block:
            flush()
            gone = CLOSES.get(tag, ())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in gone or stack[i][0] == "p":
                    del stack[i:]
                    break
                if stack[i][0] in ("ul", "ol", "table", "dl", "div", "article", "section"):
                    break
            tags.append(tag)
            parents.append(stack[-1][1])
            names.append(m[3])
            stack.append((tag, len(tags) - 1))
        elif "=" in m[3] and _NAMES.search(m[3]):
            tags.append(INLINE)
            parents.append(stack[-1][1])
            names.append(m[3])
            stack.append((tag, len(tags) - 1))
        else:
            stack.append((tag, stack[-1][1]))
    flush()
    return tags, parents, names, lines


_TAG_AT = {t: i for i, t in enumerate(TAGS)}


def featurize(pages: list[tuple]):
    """Nodes of all pages: parent (global), depth, sparse features (node, feature, value), first node of each page."""
    parent, depth, node, feat, val, first = [], [], [], [], [], []
    for tags, parents, names, lines in pages:
        base = len(parent)
        first.append(base)
        n = len(tags)
        length, linked = [0] * n, [0] * n
        for i, s, k in (piece for line in lines for piece in line):
            size = len(" ".join(s.split()))
            length[i] += size
            linked[i] += min(k, size)
        whole, whole_linked = length[:], linked[:]
        level = [0] * n
        for i in range(n - 1, 0, -1):
            whole[parents[i]] += whole[i]
            whole_linked[parents[i]] += whole_linked[i]
        for i in range(n):
            if i:
                level[i] = level[parents[i]] + 1
            t = _TAG_AT[tags[i]]
            share = whole_linked[i] / whole[i] if whole[i] else 0.0
            found = [(t, 1.0), (2 * len(TAGS) + HASHED, 1.0), (2 * len(TAGS) + HASHED + 1, share),
                     (2 * len(TAGS) + HASHED + 2, min(1.0, np.log1p(whole[i]) / 10)),
                     (2 * len(TAGS) + HASHED + 3, 1.0 if share > 0.5 else 0.0),
                     (2 * len(TAGS) + HASHED + 4, whole[i] / whole[0] if whole[0] else 0.0),
                     (2 * len(TAGS) + HASHED + 5, 1.0 if not whole[i] else 0.0)]
            if i:
                found.append((len(TAGS) + _TAG_AT[tags[parents[i]]], 1.0))
            if tags[i] == "body":  # only its text tells what it is
                found += [(2 * len(TAGS) + HASHED + 6, share), (2 * len(TAGS) + HASHED + 7, min(1.0, np.log1p(whole[i]) / 10)),
                          (2 * len(TAGS) + HASHED + 8, whole[i] / whole[0] if whole[0] else 0.0),
                          (2 * len(TAGS) + HASHED + 9, 1.0 if whole[i] > 60 else 0.0)]
            if "=" in names[i]:
                words = {w.lower() for a in _NAMES.findall(names[i]) for w in _PART.findall("".join(a))}
                found += [(2 * len(TAGS) + zlib.crc32(w.encode()) % HASHED, 1.0) for w in words]
            node += [base + i] * len(found)
            feat += [f for f, _ in found]
            val += [v for _, v in found]
        parent += [base + p if p >= 0 else -1 for p in parents]
        depth += level
    return (np.array(parent), np.array(depth), np.array(node), np.array(feat), np.array(val, np.float64),
            np.array(first, np.int64))


def _logsum(a: np.ndarray) -> np.ndarray:
    top = a.max(axis=-1, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=-1, keepdims=True)))[..., 0]


def infer(unary: np.ndarray, pair: np.ndarray, parent: np.ndarray, depth: np.ndarray):
    """Sum-product on a forest: node marginals of content, and pair marginals (parent value, child value) by child.

    ``pair``: one table of (parent value, child value), or one for every child.
    """
    n = len(unary)
    pair = np.broadcast_to(pair, (n, 2, 2))
    local = np.zeros((n, 2))
    local[:, 1] = unary
    up = np.zeros((n, 2))  # message of a node to its parent, by the parent's value
    inside = local.copy()
    levels = [np.flatnonzero(depth == d) for d in range(depth.max(initial=0) + 1)]
    for at in reversed(levels[1:]):
        up[at] = _logsum(inside[at][:, None, :] + pair[at])
        np.add.at(inside, parent[at], up[at])
    down = np.zeros((n, 2))
    outside = np.zeros((n, 2))  # belief of the parent without this child
    for at in levels[1:]:
        p = parent[at]
        outside[at] = inside[p] + down[p] - up[at]
        down[at] = _logsum(outside[at][:, None, :] + pair[at].transpose(0, 2, 1))
    belief = inside + down
    marginal = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))
    joint = outside[:, :, None] + pair + inside[:, None, :]
    joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    return marginal, joint


def kinds(n: int, node: np.ndarray, feat: np.ndarray) -> np.ndarray:
    """Which table couples each element with its parent: 0 for blocks, 1 for named elements within a block."""
    out = np.zeros(n, np.int64)
    out[node[feat == _TAG_AT[INLINE]]] = 1
    return out


def content(features, w: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Marginal of each element of ``featurize``'s pages."""
    parent, depth, node, feat, val, _ = features
    unary = np.bincount(node, weights=w[feat] * val, minlength=len(parent))
    return infer(unary, pair[kinds(len(parent), node, feat)], parent, depth)[0]


#: Labelled material (fixed values): page furniture and article parts; {t} is a short text, {l} a longer one.
FURNITURE = [
    "<nav><ul><li><a href='/a'>{t}</a></li><li><a href='/b'>{t}</a></li><li><a href='/c'>{t}</a></li></ul></nav>",
    "<div class='menu'><a href='/x'>{t}</a> <a href='/y'>{t}</a></div>", "<ul class='breadcrumb nav'><li><a>{t}</a></li><li>{t}</li></ul>",
    "<div class='ad'>{l}</div>", "<div class='advert banner'><p>{l}</p></div>", "<div id='sponsored-ads'>{t}</div>",
    "<header><h1>{t}</h1><p>{t}</p></header>", "<header class='site-header'><a href='/'>{t}</a></header>", "<div id='header'><p>{l}</p></div>",
    "<footer>&copy; {t} &middot; {l}</footer>", "<footer><p>{l}</p><ul><li><a>{t}</a></li></ul></footer>", "<div class='footer'><p>{t}</p></div>",
    "<aside><h2>{t}</h2><p>{l}</p></aside>", "<aside class='sidebar'><ul><li><a>{t}</a></li><li>{t}</li></ul></aside>",
    "<div id='sidebar'><h3>{t}</h3><p>{l}</p></div>", "<div class='related'><h3>{t}</h3><ul><li><a>{t}</a></li></ul></div>",
    "<div class='cookie-notice'>{l}</div>", "<div class='notice'><p>{l}</p></div>", "<div class='cookie consent banner'><p>{l}</p></div>",
    "<form><p>{t}</p><fieldset><p>{l}</p></fieldset></form>", "<form class='newsletter signup'>{l}</form>", "<div class='newsletter subscribe'><p>{l}</p></div>",
    "<section class='comments'><h2>{t}</h2><div class='comment'><p>{l}</p></div><div class='comment'><p>{l}</p></div></section>",
    "<div id='comments'><ol><li><p>{l}</p></li><li>{l}</li></ol></div>", "<div class='share social'><a>{t}</a><a>{t}</a></div>",
    "<div class='discussion'><h3>{t}</h3><p>{l}</p></div>", "<section class='discussion thread'><div><p>{l}</p></div><div>{l}</div></section>",
    "<div class='respond'><h3>{t}</h3><p>{l}</p></div>", "<div id='respond'>{l}</div>", "<ol class='replies'><li><p>{l}</p></li></ol>",
    "<div class='reply'><p>{l}</p></div>", "<div class='reactions feedback'><p>{l}</p></div>", "<ul class='responses'><li>{l}</li></ul>",
    "<div class='toolbar'><a>{t}</a> <a>{t}</a></div>", "<div class='pagination pager'><a>{t}</a></div>", "<div class='disclaimer alert'><p>{l}</p></div>",
    "<div class='popup modal'><p>{l}</p></div>", "<dialog><p>{l}</p></dialog>", "<menu><li><a>{t}</a></li></menu>", "<div class='promo'>{l}</div>",
]
INSIDE = [f for f in FURNITURE if not f.startswith(("<header", "<nav", "<footer"))]
PARTS = ["<p>{l}</p>", "<p>{l}</p>", "<p>{t}</p>", "<p><b>{l}<br>", "<p>{l} <a href='/z'>{t}</a> {l}</p>", "<h2>{t}</h2>", "<h3>{t}</h3>",
         "<ul><li>{l}</li><li>{t}</li></ul>", "<ol><li><p>{l}</p></li></ol>", "<blockquote><p>{l}</p></blockquote>", "<pre>{l}</pre>",
         "<table><tr><td>{t}</td><td>{l}</td></tr></table>", "<div>{l}</div>", "<section><h2>{t}</h2><p>{l}</p></section>",
         "<dl><dt>{t}</dt><dd>{l}</dd></dl>", "<figure><figcaption>{l}</figcaption></figure>"]
#: Named elements within a block: of adverts and page tools (0), of the article's own text (1); {c} is a made-up name.
INLINE_0 = ["<span class='ad'>{t}</span>", "<span class='advert'>{t}</span>", "<span class='sponsored ads'>{t}</span>", "<a class='share' href='/s'>{t}</a>",
            "<span class='promo'>{t}</span>", "<a class='related' href='/r'>{t}</a>", "<span class='notice'>{t}</span>", "<span class='banner'>{t}</span>"]
INLINE_1 = ["<span class='{c}'>{t}</span>", "<em class='{c}'>{t}</em>", "<a class='link' href='/l'>{t}</a>", "<span id='{c}'>{l}</span>",
            "<b class='name'>{t}</b>", "<a class='{c}' href='/m'>{t}</a>", "<time class='date'>{t}</time>", "<span class='text'>{l}</span>"]
SHELLS = ["div", "div", "div id='{c}'", "div class='{c}'", "section id='{c}'", "div class='{c} {c}'", "article", "main", "div class='content'", "div id='content'", "div class='article body'", "div class='post entry'", "main class='main'",
          "section class='story article'", "article class='post'", "div class='main text'", "article"]


#: Short texts that stand right in the body beside the article.
STRAY = ["<a href='#main'>{t}</a>", "&copy; {t}", "<a href='/a'>{t}</a> | <a href='/b'>{t}</a> | <a href='/c'>{t}</a>", "{t}"]
BARE = "\x01"  # marks article text right in the body


def labelled_pages(count: int = 800, seed: int = 3):
    """(parsed page, labels of its nodes): furniture is 0, the article's shell and its parts 1.

    A quarter of the pages have no shell: their article is text or parts right in the body, and the root is 1.
    """
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("aeinorst"), rng.integers(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    out = []

    def fill(s):
        s = re.sub(r"\{c\}", lambda _: word() + word(), s)
        s = re.sub(r"\{t\}", lambda _: text(rng.integers(1, 8)), s)
        return re.sub(r"\{l\}", lambda _: text(int(rng.choice([1, 3, 10, 30, 80]))), s)

    def some(items, lo, hi):
        return [items[i] for i in rng.integers(0, len(items), rng.integers(lo, hi))]

    def part(s):
        """An article part, now and then with named elements in its text."""
        s = mark(fill(s), 1)
        if rng.random() < 0.25 and (m := list(re.finditer(r"(?<=[a-z]) (?=[a-z])", re.sub(r"<[^>]*>", lambda t: "<" * len(t[0]), s)))):
            at = m[rng.integers(len(m))].start()
            y = int(rng.random() < 0.5)
            named = (INLINE_0, INLINE_1)[y]
            s = f"{s[:at]} {mark(fill(named[rng.integers(len(named))]), y)} {s[at:]}"
        return s

    def mark(s, value):
        return re.sub(r"<([a-z][a-z0-9]*)", rf"<\1 data-y{value}", s)

    def bare_text():
        long = [text(int(rng.choice([5, 15, 30, 80]))) for _ in range(rng.integers(1, 9))]
        if rng.random() < 0.3:
            long[-1] += f" <a href='/z'>{text(2)}</a> {text(12)}"
        return BARE + str(rng.choice(["<br>", "<br><br>", "<br/>\n", " "])).join(long)

    def add(page, root):
        bare = {i for line in page[3] for i, s, _ in line if BARE in s}
        page = (*page[:3], [[(i, s.replace(BARE, ""), k) for i, s, k in line] for line in page[3]])
        out.append((page, [root] + [int("data-y1" in a or i in bare) for i, a in enumerate(page[2][1:], 1)]))

    for _ in range(count):
        if rng.random() < 0.25:
            kind = rng.integers(3)  # text only, parts only, both
            inner = [] if kind == 0 else [part(p) for p in ["<h1>{t}</h1>"] * int(rng.random() < 0.7) + some(PARTS, 1, int(rng.choice([2, 4, 9])))]
            if kind != 1:
                inner.insert(int(rng.integers(0, len(inner) + 1)), bare_text())
            around = [mark(fill(f), 0) for f in some(FURNITURE, 0, 4)]
            after = [mark(fill(f), 0) for f in some(FURNITURE, 0, 3)]
            add(parse("".join(around + inner + after)), 1)
            continue
        shell = SHELLS[rng.integers(len(SHELLS))]
        inner = [part(p) for p in ["<h1>{t}</h1>"] * int(rng.random() < 0.7) + some(PARTS, 1, int(rng.choice([2, 4, 9])))]
        for f in some(INSIDE, 0, 2):
            inner.insert(int(rng.integers(0, len(inner) + 1)), mark(fill(f), 0))
        shell = fill(shell)
        body = mark(f"<{shell}>", 1) + "".join(inner) + f"</{shell.split()[0]}>"
        if rng.random() < 0.3:
            body = mark(f"<div class='{rng.choice(['page', 'wrapper', 'container', 'layout'])}'>", 0) + body + "</div>"
        around = [mark(fill(f), 0) for f in some(FURNITURE, 0, 4)]
        after = [mark(fill(f), 0) for f in some(FURNITURE, 0, 3)]
        for f in some(STRAY, 0, 2):
            (around if rng.random() < 0.5 else after).append(fill(f))
        add(parse("".join(around) + body + "".join(after)), 0)
    return out


@functools.lru_cache(maxsize=1)
def trained() -> tuple[np.ndarray, np.ndarray]:
    """(unary weights, 2 x 2 pair tables by ``kinds``) by gradient ascent on the regularised likelihood; exact marginals."""
    pages = labelled_pages()
    parent, depth, node, feat, val, _ = featurize([p for p, _ in pages])
    y = np.concatenate([labels for _, labels in pages]).astype(np.int64)
    kind = kinds(len(parent), node, feat)
    w, pair = np.zeros(N_FEATURES), np.zeros((2, 2, 2))
    child = np.flatnonzero(parent >= 0)
    seen = np.zeros((2, 2, 2))
    np.add.at(seen, (kind[child], y[parent[child]], y[child]), 1)
    sw, sp = np.full(N_FEATURES, 1e-3), np.full((2, 2, 2), 1e-3)
    for _ in range(500):
        unary = np.bincount(node, weights=w[feat] * val, minlength=len(y))
        marginal, joint = infer(unary, pair[kind], parent, depth)
        gw = np.bincount(feat, weights=(y - marginal)[node] * val, minlength=N_FEATURES) / len(y) - 2e-5 * w
        met = np.stack([joint[child[kind[child] == k]].sum(axis=0) for k in (0, 1)])
        gp = (seen - met) / len(y) - 2e-5 * pair
        sw += gw * gw
        sp += gp * gp
        w += 0.3 * gw / np.sqrt(sw)
        pair += 0.3 * gp / np.sqrt(sp)
    return w, pair


def extract_batch(pages: list[str | None], w: np.ndarray, pair: np.ndarray) -> list[str]:
    parsed = [parse(p or "") for p in pages]
    if not parsed:
        return []
    features = featurize(parsed)
    keep, first, out = content(features, w, pair) >= 0.5, features[-1], []
    for base, (_, _, _, lines) in zip(first, parsed, strict=True):
        text = (" ".join("".join(s for i, s, _ in line if keep[base + i]).split()) for line in lines)
        out.append("\n".join(t for t in text if t))
    return out


def extract(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``pages`` with ``out_col``: main text, one block a line."""
    w, pair = trained()
    source = pages.select(*(F.col(f"`{c}`") for c in pages.columns if c != out_col))
    at = source.columns.index(html_col)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 128):
                part = batch.slice(lo, 128)
                text = pa.array(extract_batch(part.column(at).to_pylist(), w, pair), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, text], names=[*part.schema.names, out_col])

    return source.mapInArrow(run, StructType([*source.schema.fields]).add(out_col, StringType()))
