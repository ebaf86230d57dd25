"""Main text of web pages by gradient-boosted trees over DOM nodes.

A page is cut into a tree of block elements; inline markup only passes its text on.  Each node gets
features: its kind, the densities of text and links in its subtree, hits of its attribute tokens among
words that name content or clutter, the same for its ancestors, depth, and how it compares with its
siblings.  Boosted regression trees give the log-odds that a node holds main text.  Decoding is
hierarchical: the likeliest choice under which no node is kept below one that is dropped, found in one
pass up and one down.

Pages carry no labels, so the trees are trained on pages that a generator writes from a fixed seed, with
the wanted nodes marked; markup, tag names, class names and nesting vary, as does what they leave out.

A kept node's text is cut into blocks where block elements begin or end.  Character references are
decoded, white space inside a block becomes one space, and blocks are joined by a newline in page order.

Text beside block elements, at any level, is a node of its own.  An attribute's quoted value may hold
anything and be of any length; a quote that is never closed, or that would swallow the rest of the page,
is an ordinary character.  Reading takes time in proportion to the page, and nothing in it is cut.

Edge cases: null or empty HTML, or a page without main text, gives an empty text; the text of a page
without any block element counts as kept; stray tags, unclosed blocks and comments are tolerated, a bracket
that opens no tag is text, and an unclosed silent element (a script, say), comment or last tag hides what
follows, as in browsers; very long or deeply nested pages are read whole; equally good choices keep less;
repeated rows are extracted alike; an empty table gives an empty result; columns beside id, url and html
are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The start of a tag, comment or declaration; what follows a tag's name up to its end: quoted values stand after an equals sign.
_MARKUP = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*+)|!--|[!?/])")
_REST = re.compile(r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+|["'])*+""")
_ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Fixed element kinds.
_KINDS = {
    "article": ("article", "main"), "section": ("section",), "div": ("div", "center", "body", "html", "root"), "p": ("p", "pre", "blockquote", "address"), "head": ("h1", "h2", "h3", "h4", "h5", "h6", "hgroup"),
    "nav": ("nav", "menu", "dialog", "template"), "header": ("header",), "footer": ("footer",), "aside": ("aside", "ins"), "form": ("form", "fieldset", "label", "legend", "button", "select", "option"),
    "list": ("ul", "ol", "dl"), "item": ("li", "dt", "dd"), "loose": ("#text",), "table": ("table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption"), "figure": ("figure", "figcaption", "details", "summary"),
}
_KIND = {tag: k for k, tags in enumerate(_KINDS.values()) for tag in tags}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Fixed elements whose content is no text of the page.
_SILENT = frozenset("script style title noscript template textarea iframe svg math object canvas audio video select head".split())
_RAW = frozenset("script style title textarea iframe noscript".split())
#: Fixed: open elements that an element closes before it opens, and those beyond which it does not look.
_ROWS, _CELLS = ("thead", "tbody", "tfoot"), ("td", "th", "caption")
_IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "thead": _ROWS, "tbody": _ROWS, "tfoot": _ROWS}
_BEYOND = {"li": ("ul", "ol", "menu", *_CELLS, "article", "section", "nav", "aside", "blockquote", "form"), "dt": ("dl", *_CELLS), "dd": ("dl", *_CELLS), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "thead": ("table",), "tbody": ("table",), "tfoot": ("table",)}
_NO_P_BEYOND, _TABLE = (*_CELLS, "table", "button"), frozenset(("table", "tr", *_ROWS, *_CELLS))
#: Fixed attribute tokens that name content, and clutter.
_CONTENT = frozenset("article content main post entry story body text prose copy longform lead hentry".split())
_CLUTTER = frozenset(
    "nav navigation navbar menu header masthead footer foot sidebar side rail ad ads advert advertisement banner promo promotion sponsor sponsored cookie cookies consent gdpr notice alert popup modal overlay "
    "newsletter subscribe subscription signup share sharing social related recommended more comment comments discussion disqus reply replies respond breadcrumb breadcrumbs crumbs pagination pager login form search widget toolbar copyright legal tags skip".split()
)
_MARKS = re.compile(r"[.,;:!?…]")


class Page:
    """A page's block elements and texts, in order."""

    def __init__(self, html: str) -> None:
        self.kind, self.parent, self.depth, self.attributes = [_KIND["root"]], [-1], [0], ["data-keep"]
        self.tags, self.links, self.order = [1], [0], [0]  # order: the page's place where a node begins
        #: (node, raw text, whether it is in a link); a change of node or a None ends a block.
        self.texts: list[tuple[int, str, bool] | None] = []
        self._read(html)
        self._part()
        self.inner, self.linked = [0] * len(self.kind), [0] * len(self.kind)
        for t in self.texts:
            if t is not None:
                size = len(t[1].strip())
                self.inner[t[0]] += size
                self.linked[t[0]] += size if t[2] else 0

    def _node(self, tag: str, attributes: str, above: int, place: int) -> int:
        self.order.append(place)
        self.kind.append(_KIND[tag])
        self.parent.append(above)
        self.depth.append(self.depth[above] + 1)
        self.attributes.append(attributes)
        self.tags.append(1)
        self.links.append(0)
        return len(self.kind) - 1

    def _part(self) -> None:
        """Runs of text whose node has elements below become nodes."""
        full, own, run = set(self.parent), [], []
        for at, t in enumerate([*self.texts, None]):
            if t is not None and (not run or run[-1][0] == t[0]):
                run.append(t)
                continue
            if run and run[0][0] in full and any(x[1].strip() for x in run):
                node = self._node("#text", "data-keep" if "data-keep" in self.attributes[run[0][0]] else "", run[0][0], at - len(run))
                run = [(node, x[1], x[2]) for x in run]
            own += run
            run = []
            if t is None:
                own.append(None)
            else:
                run.append(t)
        self.texts = own

    def _read(self, html: str) -> None:
        stack: list[tuple[str, int]] = [("root", 0)]
        places: dict[str, list[int]] = {}  # of each tag, where it is open in the stack
        silent: list[str] = []
        at, anchor, quoted = 0, False, True
        last = lambda tags: max((places[t][-1] for t in tags if places.get(t)), default=0)

        def close(to: int) -> None:
            while len(stack) > to:
                places[stack.pop()[0]].pop()

        while True:
            m = _MARKUP.search(html, at)
            end = m.start() if m else len(html)
            if end > at and not silent:
                self.texts.append((stack[-1][1], html[at:end], anchor))
            if not m:
                return
            at = m.end()
            if m.group(2) is None:
                if m.group(0) == "<!--":
                    at -= 2  # <!--> and <!---> are whole comments
                    stop = html.find("-->", at)
                    at = stop + 3
                else:
                    stop = html.find(">", at)
                    at = stop + 1
                if stop < 0:
                    return
                continue
            tag, attributes = m.group(2).lower(), ""
            stop = _REST.match(html, at).end() if quoted else html.find(">", at)
            if quoted and stop == len(html):
                quoted = False  # from here on quotes pair with nothing
                stop = html.find(">", at)
            if stop < 0:
                return
            attributes, at = html[at:stop], stop + 1
            if m.group(1):
                if silent:
                    if tag == silent[-1]:
                        silent.pop()
                elif tag == "a":
                    anchor = False
                elif places.get(tag) and (tag in _TABLE or places[tag][-1] > last(_CELLS)):
                    close(places[tag][-1])
                    self.texts.append(None)
                continue
            if tag in _VOID:
                if tag in ("br", "hr") and not silent:
                    self.texts.append((stack[-1][1], " ", anchor))
                continue
            if tag in _SILENT and not attributes.endswith("/"):
                if tag in _RAW:
                    found = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.IGNORECASE).search(html, at)
                    if not found:
                        return
                    at = found.end()
                else:
                    silent.append(tag)
                continue
            if silent:
                if silent == ["head"] and tag in _KIND:  # an unclosed head
                    silent.clear()
                else:
                    continue
            if tag in _KIND:
                self.texts.append(None)
                if (p := last(("p",))) > last(_NO_P_BEYOND):
                    close(p)
                if tag in _IMPLIED and (k := last(_IMPLIED[tag])) > last(_BEYOND[tag]):
                    close(k)
                places.setdefault(tag, []).append(len(stack))
                stack.append((tag, self._node(tag, attributes, stack[-1][1], len(self.texts))))
            else:
                node = stack[-1][1]
                self.tags[node] += 1
                if tag == "a":
                    self.links[node] += 1
                    anchor = True

    def blocks(self, keep: np.ndarray) -> list[str]:
        """The kept nodes' texts, a string a block."""
        out, run, last = [], [], None
        for t in [*self.texts, None]:
            if t is None or t[0] != last:
                if run and (joined := " ".join(entities.unescape("".join(run)).split())):
                    out.append(joined)
                run, last = [], None if t is None else t[0]
            if t is not None and keep[t[0]]:
                run.append(t[1])
        return out


@lru_cache(maxsize=1 << 14)
def _hits(attributes: str) -> tuple[int, int]:
    """How many attribute tokens name content, and clutter."""
    tokens = {p.lower() for m in _ATTRIBUTE.finditer(attributes) for p in _PART.findall(m.group(2) or m.group(3) or m.group(4) or "")}
    return len(tokens & _CONTENT), len(tokens & _CLUTTER)


FEATURES = len(_KINDS) + 19


def features(page: Page) -> np.ndarray:
    """A row for each node."""
    n = len(page.kind)
    kind, parent, depth = (np.array(x) for x in (page.kind, page.parent, page.depth))
    text, tags, links, linked = (np.array(x, float) for x in (page.inner, page.tags, page.links, page.linked))
    own = text.copy()
    marks = np.zeros(n)
    for t in page.texts:
        if t is not None and len(t[1]) > 20:
            marks[t[0]] += len(_MARKS.findall(t[1]))
    kids, paragraphs = np.zeros(n), (kind == _KIND["p"]).astype(float)
    for k in range(n - 1, 0, -1):
        p = parent[k]
        text[p] += text[k]
        tags[p] += tags[k]
        links[p] += links[k]
        linked[p] += linked[k]
        marks[p] += marks[k]
        paragraphs[p] += paragraphs[k]
        kids[p] += 1
    hits = np.array([_hits(a) if a else (0, 0) for a in page.attributes], float)
    good, bad, clutter, inside = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    apart = np.isin(kind, [_KIND[t] for t in ("nav", "header", "footer", "aside", "form")])
    same, place = np.zeros(n), np.zeros(n)
    by = np.lexsort((page.order, parent))
    place[by] = np.arange(n) - np.searchsorted(parent[by], parent[by])
    place /= np.maximum(1, kids[np.maximum(parent, 0)] - 1)
    count = np.zeros((n, len(_KINDS)))
    np.add.at(count, (parent[1:], kind[1:]), 1)
    for k in range(1, n):
        p = parent[k]
        good[k] = good[p] + hits[p, 0]
        bad[k] = bad[p] + hits[p, 1]
        clutter[k] = clutter[p] + apart[p]
        inside[k] = inside[p] + (kind[p] == 0)
        same[k] = count[p, kind[k]] / kids[p]
    up = np.maximum(parent, 0)
    out = np.zeros((n, FEATURES), np.float32)
    out[np.arange(n), kind] = 1
    all_text = max(text[0], 1)
    out[:, len(_KINDS) :] = np.stack(
        [depth, np.log1p(text), np.log1p(own), linked / np.maximum(text, 1), text / tags, np.log1p(kids), np.log1p(links), marks / np.maximum(text, 1) * 100, hits[:, 0], hits[:, 1], good, bad, clutter, inside, place, same, text / all_text, text / np.maximum(text[up], 1), np.log1p(paragraphs)], axis=1
    )
    return out


class Trees:
    """Boosted regression trees of equal depth on log-loss, with quantile bins."""

    DEPTH, BINS = 4, 48

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 80, rate: float = 0.25) -> None:
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.BINS + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
        score = np.full(len(y), 0.0)
        self.feature, self.cut, self.leaf = [], [], []
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            node = np.zeros(len(y), int)
            feature, cut = np.zeros(2**self.DEPTH - 1, int), np.full(2**self.DEPTH - 1, np.inf, np.float32)
            for level in range(self.DEPTH):
                width = 2**level
                gain, pick, where = np.zeros(width), np.zeros(width, int), np.full(width, np.inf, np.float32)
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    key = node * (len(c) + 1) + binned[:, f]
                    G, H = (np.bincount(key, v, width * (len(c) + 1)).reshape(width, -1).cumsum(1) for v in (g, h))
                    left_g, left_h, all_g, all_h = G[:, :-1], H[:, :-1], G[:, -1:], H[:, -1:]
                    right_g, right_h = all_g - left_g, all_h - left_h
                    gains = left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - all_g**2 / (all_h + 1)
                    gains[(left_h < 0.5) | (right_h < 0.5)] = 0
                    best = gains.argmax(1)
                    better = gains[np.arange(width), best] > gain
                    gain[better], pick[better], where[better] = gains[np.arange(width), best][better], f, c[best[better]]
                feature[width - 1 : 2 * width - 1], cut[width - 1 : 2 * width - 1] = pick, where
                node = 2 * node + (x[np.arange(len(y)), pick[node]] > where[node])
            G, H = (np.bincount(node, v, 2**self.DEPTH) for v in (g, h))
            leaf = rate * G / (H + 1)
            self.feature.append(feature)
            self.cut.append(cut)
            self.leaf.append(leaf.astype(np.float32))
            score += leaf[node]

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x), np.float32), np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), int)
            for _ in range(self.DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += leaf[node - (2**self.DEPTH - 1)]
        return total


def decode(parent: list[int], score: np.ndarray) -> np.ndarray:
    """The likeliest nodes to keep such that none is kept below a dropped one.  The root is kept."""
    gain = score.astype(float).copy()
    for k in range(len(parent) - 1, 0, -1):
        if gain[k] > 0:
            gain[parent[k]] += gain[k]
    keep = gain > 0
    keep[0] = True
    for k in range(1, len(parent)):
        keep[k] &= keep[parent[k]]
    return keep


class Writer:
    """Writes pages for training; wanted nodes carry the attribute data-keep."""

    SYLLABLES = "ba ce di fo gu la me ni ro su ta ve wi xo yu zan ker lin mor pol ent ion ing er es".split()

    def __init__(self, seed: int) -> None:
        self.r = np.random.default_rng(seed)

    def pick(self, some):
        return some[int(self.r.integers(len(some)))]

    def chance(self, p: float) -> bool:
        return self.r.random() < p

    def words(self, low: int, high: int) -> str:
        words = ["".join(self.pick(self.SYLLABLES) for _ in range(self.r.integers(1, 4))) for _ in range(self.r.integers(low, high))]
        for k in range(len(words)):
            if self.chance(0.1):
                words[k] += self.pick([",", ".", ".", "!", "?", ";"])
            if k == 0 or words[k - 1].endswith("."):
                words[k] = words[k].title()
        return " ".join(words)

    def tag(self, name: str, inside: str, attribute: str = "", keep: bool = False) -> str:
        return f"<{name}{f' {attribute}' if attribute else ''}{' data-keep' if keep else ''}>{inside}</{name}>"

    def named(self, names: list[str], often: float = 0.85) -> str:
        if not self.chance(often):
            return self.pick(["", 'class="row"', 'class="col-8"', 'class="block"', 'id="x1"', 'class="inner wrap"'])
        name = self.pick(names)
        return self.pick([f'class="{name}"', f'id="{name}"', f'class="{name} clearfix"', f'class="site-{name}"', f'class="{name}-wrap"'])

    def links(self, n: int, tag: str = "li") -> str:
        return "".join(self.tag(tag, f'<a href="/{k}">{self.words(1, 4)}</a>') for k in range(n))

    def menu(self, names: list[str]) -> str:
        inside = self.tag("ul", self.links(self.r.integers(3, 12))) if self.chance(0.8) else self.links(self.r.integers(3, 10), "span")
        return self.tag(*self.pick([("nav", inside), ("div", inside, self.named(names))]))

    def prose(self, keep: bool) -> str:
        kind = self.r.random()
        text = self.words(*self.pick([(4, 20), (20, 60), (60, 160)]))
        if self.chance(0.2):
            text = text.replace(" ", f' <a href="/q">{self.words(1, 3)}</a> ', 1)
        if self.chance(0.2):
            text = f"<b>{text}<br>" if self.chance(0.5) else f"<em>{text}</em>"
        if kind < 0.7:
            return f"<p{' data-keep' if keep else ''}>{text}" + ("</p>" if self.chance(0.85) else "")
        if kind < 0.78:
            return self.tag(self.pick(["h2", "h3"]), self.words(2, 8), "", keep)
        if kind < 0.86:
            return self.tag(self.pick(["ul", "ol"]), "".join(self.tag("li", self.words(3, 25), "", keep) for _ in range(self.r.integers(2, 6))), "", keep)
        if kind < 0.92:
            return self.tag("blockquote", self.tag("p", text, "", keep), "", keep)
        if kind < 0.95:
            return self.tag("div", text, "", keep)
        if kind < 0.97 and keep:
            return f"{text}<br>"  # beside the blocks
        return self.tag("table", self.tag("tr", "".join(self.tag("td", self.words(1, 12), "", keep) for _ in range(3)), "", keep), "", keep)

    def clutter(self) -> str:
        r = self.r
        paragraph = lambda a, b: self.tag("p", self.words(a, b))
        return self.pick([
            lambda: self.tag("div", self.pick([self.words(3, 30), paragraph(3, 30)]), self.named(["ad", "ads", "advert", "banner", "promo", "sponsored", "ad-slot"])),
            lambda: self.tag(self.pick(["aside", "div"]), "".join(paragraph(5, 50) for _ in range(r.integers(1, 4))) + self.tag("ul", self.links(r.integers(2, 8))), self.named(["sidebar", "side", "widget", "related", "right-rail"], 0.95)),
            lambda: self.tag("aside", paragraph(4, 60)),
            lambda: self.tag("div", self.words(2, 20) + self.tag("ul", self.links(r.integers(2, 6))), self.named(["ad", "sidebar", "promo", "notice", "related"], 0.95)),
            lambda: self.tag("div", paragraph(6, 40) + self.tag("button", self.words(1, 3)), self.named(["cookie-notice", "cookie", "consent", "notice", "gdpr-banner", "alert", "popup"], 0.97)),
            lambda: self.tag("form", self.tag("label", self.words(1, 4)) + "<input>" + self.tag("button", self.words(1, 3)) + (paragraph(3, 20) if self.chance(0.4) else ""), self.named(["search", "newsletter", "subscribe", "login", "signup"])),
            lambda: self.tag("div", self.links(r.integers(3, 7), "span"), self.named(["share", "social", "sharing", "tags", "breadcrumb"])),
            lambda: self.tag(self.pick(["div", "section"]), self.tag("h3", self.words(1, 4)) + self.tag("ul", self.links(r.integers(3, 8))), self.named(["related", "more", "recommended", "related-posts"], 0.95)),
        ])()

    def comments(self) -> str:
        one = lambda: self.tag(self.pick(["div", "li", "article", "section"]), self.tag(self.pick(["span", "h4", "div"]), self.words(1, 3)) + self.tag("p", self.words(5, 70)), self.named(["comment", "reply", "comment-body"], 0.9))
        inside = self.tag(self.pick(["h2", "h3"]), self.words(1, 4)) + "".join(one() for _ in range(self.r.integers(1, 7)))
        return self.tag(self.pick(["div", "section", "ol"]), inside, self.pick(['class="comments"', 'id="comments"', 'class="comment-list"', 'id="disqus_thread"', 'class="discussion"', 'class="reader-comments"', 'class="responses comments-area"']))

    def page(self) -> str:
        parts = [self.tag(self.pick(["h1", "h2"]), self.words(3, 12), "", True)] if self.chance(0.9) else []
        for _ in range(self.r.integers(1, 12)):
            parts.append(self.prose(True))
            if self.chance(0.08):
                parts.append(self.clutter())
        if self.chance(0.15):
            parts.insert(min(1, len(parts)), self.tag("div", self.links(3, "span"), self.named(["share", "social", "tags"])))
        inside_comments = self.chance(0.2)
        if inside_comments:
            parts.append(self.comments())
        if self.chance(0.15):  # an own head and foot of the article
            parts.insert(0, self.tag("header", parts.pop(0), "", True)) if "data-keep" in parts[0] and parts[0][:2] == "<h" else None
        main = "".join(parts)
        if self.chance(0.12):  # a bare piece of a page
            return "".join([self.words(4, 60), *(p for p in parts if self.chance(0.6))]) if self.chance(0.7) else main
        for _ in range(self.r.integers(0, 2) if self.chance(0.5) else 0):
            main = self.tag(self.pick(["div", "section"]), main, self.named(["content", "post-body", "entry-content", "text", "prose"], 0.6), True)
        if self.chance(0.75):
            main = self.tag(self.pick(["article", "article", "main"]), main, self.pick(["", "", self.named(["post", "story", "hentry"], 0.8)]), True)
        else:
            main = self.tag("div", main, self.named(["content", "article", "main", "post", "entry", "article-body", "story"], 0.85), True)
        before = [self.pick([self.tag("header", self.tag("a", self.words(1, 4)) + (self.tag("p", self.words(2, 12)) if self.chance(0.4) else "") + (self.menu(["menu"]) if self.chance(0.5) else "")), self.tag("div", self.tag("h2", self.words(1, 4)) + self.tag("p", self.words(2, 12)), self.named(["header", "masthead", "top-header"], 0.97))])] if self.chance(0.6) else []
        before += [self.menu(["menu", "nav", "navbar", "navigation", "main-menu"])] if self.chance(0.85) else []
        before += [self.clutter() for _ in range(self.r.integers(0, 3))]
        after = [self.clutter() for _ in range(self.r.integers(0, 3))]
        if not inside_comments and self.chance(0.35):
            after.insert(0, self.comments())
        foot = self.words(3, 40) if self.chance(0.6) else self.tag("p", self.words(3, 30)) + self.tag("ul", self.links(self.r.integers(2, 9)))
        foot = [self.pick([self.tag("footer", f"&copy; {foot}"), self.tag("div", f"&copy; {foot}", self.named(["footer", "site-footer", "copyright", "foot"], 0.97))])] if self.chance(0.9) else []
        if self.chance(0.3):
            side = self.clutter() + self.clutter()
            main, after = self.tag("div", main + "".join(after) + side, self.named(["container", "wrapper", "page", "layout"], 0.7), True), []
        body = "".join([*before, main, *after, *foot])
        if self.chance(0.3):
            body = self.tag("div", body, self.named(["page", "wrapper", "container", "site"], 0.8), True)
        return f"<!DOCTYPE html><html data-keep><head><title>{self.words(2, 8)}</title><style>p{{}}</style></head><body data-keep>{body}</body></html>"


@lru_cache(maxsize=1)
def model(pages: int = 500, seed: int = 3) -> Trees:
    """The trees, trained on written pages."""
    writer, x, y = Writer(seed), [], []
    for _ in range(pages):
        page = Page(writer.page())
        x.append(features(page)[1:])
        y.append(np.array(["data-keep" in a for a in page.attributes[1:]], float))
    return Trees(np.concatenate(x), np.concatenate(y))


def extract(pages: list[str | None], trees: Trees) -> list[str]:
    """The main texts of some pages."""
    read = [Page(h or "") for h in pages]
    x = [features(p) for p in read]
    scores = np.split(trees.score(np.concatenate(x)), np.cumsum([len(r) for r in x])[:-1]) if x else []
    return ["\n".join(p.blocks(_page_keep(p, s))) for p, s in zip(read, scores, strict=True)]


def _page_keep(page: Page, score: np.ndarray) -> np.ndarray:
    keep = decode(page.parent, score)
    keep[0] = len(page.parent) == 1  # loose text counts only where there is nothing else
    return keep


def _run(trees: Trees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                yield part.set_column(2, "text", pa.array(extract(part.column(2).to_pylist(), trees), pa.string()))

    return run


def main_text(pages: DataFrame, html: str = "html", url: str = "url", id_col: str = "page_id") -> DataFrame:
    """One row per page: id, url, text."""
    kind = pages.schema[id_col].dataType.simpleString()
    out = pages.select(F.col(id_col).alias("_id"), F.col(url).alias("_url"), F.col(html).alias("_html"))
    return out.mapInArrow(_run(model()), f"_id {kind}, _url string, text string").withColumnsRenamed({"_id": id_col, "_url": url})


def op8_boosted_dom_extraction(spark, sf_dir: str) -> DataFrame:
    out = main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
