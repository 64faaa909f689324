"""Operator 10: main-text extraction with a tree-structured graphical model.

A page becomes a tree of block elements whose leaves are runs of text.  Every
node has a hidden label (content or not); features give it a potential, and
every parent-child edge has a potential by kind of edge.  Sum-product messages
upward and downward give exact marginals; runs whose marginal is above one half
are the text.  The potentials are the maximum of the conditional likelihood of
labelled pages (:mod:`html_pages`).

Cases: null, empty and tag-free html have the empty text or the text itself as
one run; broken markup (unclosed or stray tags, unclosed quotes and comments) is
read leniently; pages of any length and depth are read whole (no recursion);
elements with a ``hidden`` attribute or style are judged like others;
repeated rows give repeated results; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import table
from .common import small_batches, spread_rows

# fixed values: classes of HTML elements
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noframes".split())
# no text that a page shows (code, metadata, what stands in for media) or a form control; all other elements are judged by the model
DROPPED = set("script style textarea title head noscript template iframe select button option canvas audio video datalist noframes".split())
BLOCK = set("address article aside blockquote body center dd details dir div dl dt fieldset figcaption figure footer form "
            "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table caption "
            "thead tbody tfoot tr td th ul head title script style noscript template svg iframe object select button "
            "option textarea canvas audio video dialog xmp noframes".split())
CLOSES_P = BLOCK - set("html body head title script style noscript template svg iframe object select button option "
                       "textarea canvas audio video caption thead tbody tfoot tr td th".split())
IMPLIED = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
           "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th")}
FENCE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"},
         "tbody": {"table"}, "tfoot": {"table"}, "option": {"select"}}
P_FENCE = {"table", "td", "th", "caption", "button", "object", "template", "html"}

MARKUP = re.compile(r"<!--(?:.*?--!?>|>|.*\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]++|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
# an attribute with its value; an unclosed quote goes on to the end of the tag
ATTR = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)(?:"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?""")
HINTED = {"class", "id", "role", "itemprop", "aria-label"}

#: words of class, id, role and the like, by what they hint at
HINTS = {
    "nav": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager tabs toc submenu sitemap skip",
    "side": "sidebar side aside related recommended recommend widget trending popular archive tags complementary more rail",
    "foot": "footer foot copyright colophon legal contentinfo bottom imprint",
    "head": "header masthead banner topbar logo branding site",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted banner adsense commercial",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription paywall toast warning message disclaimer signup",
    "comment": "comment comments reply replies discussion disqus respond feedback reviews guestbook",
    "share": "share sharing social follow print tools toolbar buttons author-links",
    "form": "form login search searchbox contact register poll survey",
    "main": "content article post entry story main body text articlebody maincontent prose copy",
}
_HINT = {w: k for k, ws in HINTS.items() for w in ws.split()}
_SPLIT = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")


def hints_of(attrs: str) -> list[str]:
    found = set()
    for m in ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            found.add("hidden")
        elif name in HINTED:
            value = _CAMEL.sub(r"\1 \2", value).lower()
            found.update(_HINT[w] for w in _SPLIT.split(value) if w in _HINT)
    return sorted(found)


class Page:
    """Nodes in document order: parent, tag, hints, dropped, and for runs of text their text and link characters."""

    __slots__ = ("parent", "depth", "tag", "hints", "gone", "text", "links")

    def __init__(self, source: str):
        self.parent, self.depth, self.tag, self.hints, self.gone = [-1], [0], ["#page"], [[]], [False]
        self.text: list[str | None] = [None]
        self.links = [0]
        self._read(source)

    def _add(self, parent, tag, hints, gone, text=None, links=0):
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.tag.append(tag)
        self.hints.append(hints)
        self.gone.append(gone)
        self.text.append(text)
        self.links.append(links)
        return len(self.tag) - 1

    def _read(self, s: str) -> None:
        stack = [("#page", 0)]  # open elements; an inline element has the number of the block around it
        run, linked, at, n, in_link = [], 0, 0, len(s), 0

        def flush():
            nonlocal run, linked
            if run:
                text = " ".join("".join(run).split())
                block = stack[-1][1]
                if text and not self.gone[block]:
                    self._add(block, "#text", (), False, text, min(linked, len(text)))
                run, linked = [], 0

        def close(depth):
            nonlocal in_link
            if any(t in BLOCK for t, _ in stack[depth:]):
                flush()
            in_link -= sum(t == "a" for t, _ in stack[depth:])
            del stack[depth:]

        def add_text(raw):
            nonlocal linked
            t = html.unescape(raw) if "&" in raw else raw
            run.append(t)
            if in_link:
                linked += len(t)

        for m in iter(lambda: MARKUP.search(s, at), None):
            if m.start() > at:
                add_text(s[at:m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if tag is None:
                continue
            tag, ends, attrs = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
            if ends:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == tag:
                        close(k)
                        break
                    if tag not in BLOCK and stack[k][0] in BLOCK:
                        break  # an inline end tag doesn't close blocks
                continue
            if tag in VOID:
                if tag == "hr":
                    flush()
                else:
                    run.append(" ")
                continue
            if tag in CLOSES_P:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "p":
                        close(k)
                        break
                    if stack[k][0] in P_FENCE or (stack[k][0] in BLOCK and stack[k][0] != "p"):
                        break
            if tag in IMPLIED:
                cut = None
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in FENCE[tag]:
                        break
                    if stack[k][0] in IMPLIED[tag]:
                        cut = k
                if cut is not None:
                    close(cut)
            if tag == "a" and in_link:  # links don't nest
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] == "a":
                        if not any(t in BLOCK for t, _ in stack[k:]):
                            close(k)
                        break
            block = stack[-1][1]
            if tag in BLOCK:
                flush()
                hints = hints_of(attrs) if attrs and not attrs.isspace() else []
                block = self._add(block, tag, hints, self.gone[block] or tag in DROPPED)
            if attrs.endswith("/") and tag in ("svg", "math", "iframe"):
                continue
            stack.append((tag, block))
            in_link += tag == "a"
            if tag in RAW:
                e = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(s, at)
                if tag == "xmp":  # shown as it stands
                    run.append(s[at:e.start() if e else n])
                at = e.end() if e else n
                flush()
                stack.pop()
        if at < n:
            add_text(s[at:])
        flush()


def bucket(x: float, cuts) -> int:
    return sum(x >= c for c in cuts)


def features(page: Page) -> tuple[list[list[str]], list[str]]:
    """Names of the features of every node, and the kind of the edge to its parent."""
    n = len(page.tag)
    chars, links, runs, stops, heads = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n
    for k in range(n - 1, 0, -1):
        t = page.text[k]
        if t is not None:
            chars[k], links[k], runs[k] = len(t), page.links[k], 1
            stops[k] = t.count(". ") + t.count(", ") + t.endswith((".", "!", "?"))
        p = page.parent[k]
        for x in (chars, links, runs, stops):
            x[p] += x[k]
        heads[p] += heads[k] + (page.tag[k] == "h1")
    out, kinds = [], []
    p_main = [False] * n  # below an article or main element or hint, with no other hint in between
    for k in range(1, n):
        p = page.parent[k]
        tag, hints = page.tag[p], [h for h in page.hints[p] if h != "hidden"]
        p_main[k] = tag in ("article", "main") or "main" in hints and len(hints) == 1 or (
            p_main[p] and not hints and tag not in ("nav", "aside", "footer", "form"))
    for k in range(n):
        tag, t = page.tag[k], page.text[k]
        c = max(1, chars[k])
        density = bucket(links[k] / c, (0.02, 0.3, 0.6, 0.9))
        f = [f"tag={tag}", f"links={density}"]
        hints = page.hints[k]
        f += [f"hint={h}" for h in hints]
        if t is not None:
            up = page.tag[page.parent[k]]
            if p_main[k]:
                f.append("text under main")
            f += [f"len={bucket(c, (15, 40, 80, 200))}", f"stops={bucket(stops[k], (1, 3))}", f"in={up}", f"in={up},links={density}"]
            if "©" in t or "opyright" in t or "ll rights reserved" in t:
                f.append("copyright")
            kinds.append("text")
        else:
            if p_main[k]:
                f.append("under main")
            f += [f"mean={bucket(c / max(1, runs[k]), (15, 40, 80, 200))}", f"runs={bucket(runs[k], (1, 3, 8))}",
                  f"tag={tag},links={density}", f"stops={bucket(stops[k] / max(1, runs[k]), (0.5, 2))}", f"h1={heads[k] > 0}"]
            bad = [h for h in hints if h not in ("main", "hidden")]
            kinds.append("hinted" if bad else "main" if "main" in hints or tag in ("article", "main")
                         else tag if tag in ("nav", "header", "footer", "aside", "form", "ul", "ol", "table", "section", "div", "p")
                         else "heading" if tag in ("h1", "h2", "h3", "h4", "h5", "h6") else "block")
        out.append(f)
    return out, kinds


class Forest:
    """Trees of several pages as arrays, for messages level by level."""

    def __init__(self, pages: list[Page], names: dict[str, int], kinds: dict[str, int]):
        parent, depth, node, feat, kind, base = [], [], [], [], [], 0
        self.starts = []
        for page in pages:
            self.starts.append(base)
            fs, ks = features(page)
            parent += [base + p if p >= 0 else -1 for p in page.parent]
            depth += page.depth
            for k, f in enumerate(fs):
                for x in f:
                    if (i := names.get(x)) is not None:
                        node.append(base + k)
                        feat.append(i)
            kind += [kinds.get(x, 0) for x in ks]
            base += len(fs)
        self.n = base
        self.parent, self.kind = np.array(parent), np.array(kind)
        self.node, self.feat = np.array(node, np.int64), np.array(feat, np.int64)
        depth = np.array(depth)
        order = np.argsort(depth, kind="stable")
        cuts = np.searchsorted(depth[order], np.arange(depth.max() + 2))
        self.levels = [order[a:b] for a, b in zip(cuts, cuts[1:])]

    def marginals(self, w: np.ndarray, edge: np.ndarray):
        """P(content) of every node, P(parent label, label) of every edge, log of the partition sum."""
        own = np.zeros((self.n, 2))
        own[:, 1] = np.bincount(self.node, w[self.feat], self.n)
        up = own.copy()                       # own potential and the messages from children
        message = np.zeros((self.n, 2))       # to the parent, by the parent's label
        for ids in self.levels[:0:-1]:
            message[ids] = np.logaddexp(edge[self.kind[ids], :, 0] + up[ids, None, 0], edge[self.kind[ids], :, 1] + up[ids, None, 1])
            np.add.at(up, self.parent[ids], message[ids])
        belief = up.copy()
        pair = np.zeros((self.n, 2, 2))
        for ids in self.levels[1:]:
            p = self.parent[ids]
            rest = belief[p] - message[ids]   # the parent without this child
            joint = rest[:, :, None] + edge[self.kind[ids]] + up[ids][:, None, :]
            belief[ids] = np.logaddexp(joint[:, 0], joint[:, 1])
            pair[ids] = joint
        z = np.logaddexp(belief[:, 0], belief[:, 1])
        return np.exp(belief[:, 1] - z), np.exp(pair - z[:, None, None]), z[self.levels[0]].sum()


class Model:
    def __init__(self, names, kinds, w, edge):
        self.names, self.kinds, self.w, self.edge = names, kinds, w, edge

    def texts(self, sources: list[str | None]) -> list[str]:
        pages = [Page(s or "") for s in sources]
        forest = Forest(pages, self.names, self.kinds)
        p = forest.marginals(self.w, self.edge)[0]
        return ["\n".join(t for k, t in enumerate(page.text) if t is not None and p[base + k] > 0.5)
                for base, page in zip(forest.starts, pages)]


def train(pages: list[Page], labels: list[list[int]], rounds: int = 150, ridge: float = 0.3) -> Model:
    """Maximum penalised conditional likelihood, by adaptive gradient steps over exact marginals."""
    names: dict[str, int] = {}
    kinds: dict[str, int] = {}
    for page in pages:
        fs, ks = features(page)
        for f in fs:
            for x in f:
                names.setdefault(x, len(names))
        for x in ks:
            kinds.setdefault(x, len(kinds))
    forest = Forest(pages, names, kinds)
    y = np.concatenate([np.array(x) for x in labels])
    w, edge = np.zeros(len(names)), np.zeros((len(kinds), 2, 2))
    inner = np.concatenate(forest.levels[1:])
    seen_w = np.bincount(forest.feat, y[forest.node], len(names)).astype(float)
    seen_e = np.zeros_like(edge)
    np.add.at(seen_e, (forest.kind[inner], y[forest.parent[inner]], y[inner]), 1)
    m = [np.zeros_like(w), np.zeros_like(edge)]
    v = [np.zeros_like(w), np.zeros_like(edge)]
    for step in range(1, rounds + 1):
        p, pair, _ = forest.marginals(w, edge)
        exp_e = np.zeros_like(edge)
        np.add.at(exp_e, forest.kind[inner], pair[inner])
        grads = (seen_w - np.bincount(forest.feat, p[forest.node], len(names)) - ridge * w, seen_e - exp_e - ridge * edge)
        for k, (x, g) in enumerate(zip((w, edge), grads)):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            x += 0.15 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
    return Model(names, kinds, w, edge)


def extract(df: DataFrame, model: Model, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """All columns but the html, and ``text``."""
    keep = [c for c in df.columns if c not in (html_col, "text")]
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few hundred weights
    schema = ", ".join(f"`{c}` {t}" for c, t in df.dtypes if c in keep) + ", text string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(0, len(b), 100):
                part = b.iloc[k: k + 100]
                yield part[keep].assign(text=shared.value.texts(part[html_col].tolist()))

    return spread_rows(df.select(*keep, html_col)).mapInPandas(run, schema)


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_pages import default_model
    small_batches(spark)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    out = extract(pages, default_model())
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
