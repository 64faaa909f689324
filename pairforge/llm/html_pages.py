"""Labelled pages that the extraction model is trained on.

Layouts are drawn from parts that pages have (menus, banners, side columns,
adverts, notices, forms, comments, footers, articles in several kinds of
markup).  ``data-y`` labels an element: 1 content, 0 not; inner elements
inherit it.  The mark is read and removed before features are taken.
"""

from __future__ import annotations

import functools
import random
import re

from .html_extract import Model, Page, train

PAGES = 500
#: further pages with hidden elements and elements that pages rarely have
RARE = 60
_SYLLABLES = "an ta ri mo el su ne ka do vi lo pe ra ti ma en or is ul che der ung tion que ment ado".split()


class _Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self):
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 3)))

    def words(self, a, b):
        return " ".join(self.word() for _ in range(self.r.randint(a, b)))

    def sentence(self, a=4, b=16):
        return self.words(a, b).capitalize() + self.r.choice("....?!")

    def prose(self, a=1, b=6):
        out = " ".join(self.sentence() for _ in range(self.r.randint(a, b)))
        odd = self.r.random()
        if odd < 0.06:  # texts of odd kinds are content where they stand in an article
            out = re.sub("[.?!]", "", out)
        elif odd < 0.10:
            out = " ".join([self.word().capitalize()] * self.r.randint(3, 60))
        elif odd < 0.14:
            out = " ".join(w + self.one("***", "$$$", "&amp;&amp;", "%%%", "!!") for w in out.split())
        elif odd < 0.17:
            out = out.upper()
        elif odd < 0.20:
            out = " | ".join(out.split())
        if self.r.random() < 0.2:
            w = self.word()
            out = out.replace(" ", f' <a href="/{w}">{w}</a> ', 1)
        return f"<b>{out}</b>" if self.r.random() < 0.08 else out

    def one(self, *xs):
        return self.r.choice(xs)

    def cls(self, *names):
        """A class, id or role hint, sometimes none."""
        if self.r.random() < 0.15:
            return ""
        kind = self.one("class", "class", "class", "id")
        extra = self.one("", "", "", f" {self.word()}", f"{self.word()} ")
        name = self.one(*names)
        return f' {kind}="{extra if extra.endswith(" ") else ""}{name}{extra if extra.startswith(" ") else ""}"'

    def links(self, a=3, b=9):
        items = [f'<li><a href="/{(w := self.words(1, 2))}">{w}</a></li>' for _ in range(self.r.randint(a, b))]
        if self.r.random() < 0.25:
            return " | ".join(re.sub("</?li>", "", x) for x in items)
        return "<ul>" + "".join(items) + "</ul>"

    # parts that are not content
    def menu(self):
        return self.one(f'<nav data-y="0">{self.links()}</nav>', f'<div data-y="0"{self.cls("menu", "navbar", "main-nav", "breadcrumbs", "top-menu")}>{self.links()}</div>',
                        f'<ul data-y="0"{self.cls("menu", "nav")}>' + self.links(4, 8).replace("<ul>", "").replace("</ul>", "") + "</ul>")

    def banner(self):
        inner = self.one(f"<a href='/'>{self.words(1, 3)}</a>", f"<p>{self.sentence(2, 8)}</p>", f"<h2>{self.words(1, 3)}</h2>{self.links(2, 5)}", f"<span>{self.words(1, 4)}</span>")
        return self.one(f'<header data-y="0"{self.cls("header", "site-header", "masthead")}>{inner}</header>', f'<div data-y="0"{self.cls("header", "masthead", "topbar", "site-branding")}>{inner}</div>')

    def side(self):
        inner = f"<h3>{self.words(1, 3)}</h3>" + self.one(self.links(), f"<p>{self.prose(1, 2)}</p>", f"<ul>{''.join(f'<li>{self.sentence(3, 8)}</li>' for _ in range(3))}</ul>")
        return self.one(f'<aside data-y="0"{self.cls("sidebar", "related")}>{inner}</aside>', f'<div data-y="0"{self.cls("sidebar", "side-column", "widget", "related-posts", "recommended")}>{inner}</div>',
                        f'<aside data-y="0">{inner}</aside>')

    def ad(self):
        inner = self.one(self.prose(1, 3), f"<p>{self.prose(1, 3)}</p>", f"<a href='/x'>{self.sentence()}</a>")
        tag = self.one("div", "div", "div", "section", "aside")
        return f'<{tag} data-y="0" class="{self.one("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-banner", "ad ad-top")}">{inner}</{tag}>'

    def notice(self):
        inner = self.one(self.prose(1, 2), f"<p>{self.prose(1, 3)}</p>") + self.one("", "<button>OK</button>")
        return f'<{(t := self.one("div", "div", "section", "aside"))} data-y="0" {self.one("class", "id")}="{self.one("cookie", "cookie-notice", "notice", "consent", "newsletter", "popup", "alert", "subscribe-box")}">{inner}</{t}>'

    def form(self):
        return f'<form data-y="0"{self.cls("search", "login", "contact-form")}><p>{self.sentence(2, 6)}</p><input name="q"><label>{self.word()}</label><button>{self.word()}</button></form>'

    def comments(self):
        cs = "".join(self.one(f"<p>{self.prose(1, 3)}</p>", f'<div class="comment"><b>{self.word()}</b><p>{self.prose(1, 3)}</p></div>', f"<li>{self.prose(1, 2)}</li>") for _ in range(self.r.randint(1, 5)))
        return f'<{(t := self.one("div", "section", "section", "ol", "aside"))} data-y="0" {self.one("class", "id")}="{self.one("comments", "comment-list", "reader-comments", "replies", "discussion", "user-comments")}">{self.one("", f"<h3>{self.words(1, 3)}</h3>")}{cs}</{t}>'

    def share(self):
        return f'<div data-y="0" class="{self.one("share", "social", "share-buttons")}">{self.links(2, 4)}</div>'

    def footer(self):
        inner = self.one(f"&copy; {self.word()} &middot; {self.sentence()}", f"<p>&copy; 2020 {self.word()}. {self.sentence()}</p>{self.links(2, 6)}", f"<p>{self.sentence()}</p>", self.prose(1, 2))
        return self.one(f'<footer data-y="0">{inner}</footer>', f'<footer data-y="0"{self.cls("footer", "site-footer")}>{inner}</footer>', f'<div data-y="0" {self.one("class", "id")}="{self.one("footer", "foot", "site-footer", "copyright")}">{inner}</div>')

    # content
    def body(self):
        out, r = [], self.r
        title = self.one(self.sentence(3, 9), self.words(3, 9).capitalize())
        out.append(self.one(f"<h1>{title}</h1>", f"<h1>{title}</h1>", f"<h1>{title}</h1>", f"<header><h1>{title}</h1></header>", f"<h2>{title}</h2>"))
        if r.random() < 0.3:
            out.append(f"<p><b>{title}<br>")  # unclosed
        for _ in range(r.randint(1, 9)):
            x = r.random()
            if x < 0.74:
                out.append(f"<p>{self.one(self.prose(), self.prose(), self.word().capitalize() + '.', self.sentence(1, 3))}</p>")
            elif x < 0.8:
                out.append(f"<h{(k := r.randint(2, 4))}>{self.words(1, 5)}</h{k}>")
            elif x < 0.86:
                out.append("<ul>" + "".join(f"<li>{self.sentence(2, 10)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif x < 0.89:
                out.append(f"<blockquote>{self.one(self.prose(1, 3), f'<p>{self.prose(1, 2)}</p>')}</blockquote>")
            elif x < 0.91:
                out.append(f"<pre>{self.words(5, 20)}</pre>")
            elif x < 0.93:
                out.append("<table>" + "".join(f"<tr><td>{self.words(1, 3)}</td><td>{self.words(1, 5)}</td></tr>" for _ in range(r.randint(2, 4))) + "</table>")
            elif x < 0.95:
                out.append(f"<figure><img src=x><figcaption>{self.sentence()}</figcaption></figure>")
            elif x < 0.97:
                out.append(f"<div>{self.prose()}</div>")
            else:
                out.append(f"<section><h2>{self.words(1, 5)}</h2><p>{self.prose()}</p><p>{self.prose()}</p></section>")
            y = r.random()
            if y < 0.10:
                out.append(self.one(self.ad, self.share, self.notice, self.side, self.form)())
        return "".join(out)

    def article(self):
        b = self.body()
        tail = self.r.random()
        inner_tail = self.comments() if tail < 0.15 else self.share() if tail < 0.2 else self.one(self.side, self.form, self.menu)() if tail < 0.26 else ""
        if self.r.random() < 0.06:
            b = re.sub("</?p>", " ", b) if "<ul>" not in b else b
        b += inner_tail
        return self.one(
            f'<article data-y="1">{b}</article>', f'<article data-y="1"{self.cls("post", "entry", "article")}>{b}</article>', f'<main data-y="1"><article>{b}</article></main>',
            f'<main data-y="1">{b}</main>', f'<div data-y="1" {self.one("class", "id")}="{self.one("content", "article", "post", "entry-content", "story", "main-content", "articleBody", "main", "post-body")}">{b}</div>',
            f'<section data-y="1">{b}</section>', f'<div data-y="1">{b}</div>', f'<article data-y="1"><div class="{self.one("body", "text", "content")}">{b}</div></article>')

    def page(self):
        r = self.r
        before = [f() for f, p in ((self.banner, 0.4), (self.menu, 0.75), (self.notice, 0.3), (self.ad, 0.45), (self.form, 0.15), (self.side, 0.15)) if r.random() < p]
        after = [f() for f, p in ((self.comments, 0.3), (self.side, 0.3), (self.ad, 0.25), (self.share, 0.15), (self.menu, 0.1), (self.notice, 0.2), (self.form, 0.2)) if r.random() < p]
        r.shuffle(before)
        r.shuffle(after)
        middle = self.article()
        if r.random() < 0.3:
            cut = r.randint(0, len(before))
            middle = f'<div{self.one("", self.cls("wrapper", "container", "page", "layout"))}>{"".join(before[cut:])}{middle}{"".join(after)}</div>'
            before, after = before[:cut], []
        foot = self.footer() if r.random() < 0.85 else ""
        return (f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{margin:0}}</style></head><body>"
                + "".join(before) + middle + "".join(after) + foot + "</body></html>")

    def rare_page(self):
        """A page with hidden parts and rare elements, in the content as well as outside of it."""
        r = self.r
        hide = lambda m, p: m[0] + (self.one(" hidden", ' style="display:none"', ' style="visibility: hidden"') if r.random() < p else "")

        def wrapped(m):
            if r.random() > 0.25:
                return m[0]
            plain = re.sub("<[^>]*>", "", m[1])
            return self.one(f"<dialog>{m[0]}</dialog>", f"<object>{m[0]}</object>", f"<fieldset><legend>{self.words(1, 3)}</legend>{m[0]}</fieldset>",
                            f"<svg><text>{plain}</text></svg>", f"<xmp>{plain}</xmp>", f"<div hidden>{m[0]}</div>", f"<p hidden>{m[1]}</p>")

        out = re.sub(r"<p>((?:[^<]|<a [^>]*>|</a>|</?b>)*)</p>", wrapped, self.page())
        out = re.sub(r'<\w+ data-y="0"', lambda m: hide(m, 0.3), out)
        out = re.sub(r'<\w+ data-y="1"|<body', lambda m: hide(m, 0.15), out)
        if r.random() < 0.5:
            dialog = f'<dialog data-y="0"{self.one("", self.cls("popup", "modal", "cookie-notice"))}>{self.one(self.notice(), f"<p>{self.prose(1, 2)}</p>")}</dialog>'
            out = re.sub(self.one("(?<=<body>)|(?=</body>)", "(?=</body>)"), lambda m: dialog, out, count=1)
        if r.random() < 0.3:
            out = re.sub(r'(<nav data-y="0"[^>]*>)', lambda m: f"{m[1]}<svg><desc>{self.words(1, 3)}</desc></svg>", out)
        return out


_LABEL = re.compile(r' data-y="([01])"')


def labelled_page(source: str) -> tuple[Page, list[int]]:
    """The page without its marks, and the label of every node (a node without one has its parent's; outside: 1 if it holds content)."""
    plain = Page(_LABEL.sub("", source))
    labels = []
    own = iter(_marks(source))
    for k, tag in enumerate(plain.tag):
        mark = next(own) if plain.text[k] is None and k else None
        labels.append(mark if mark is not None else labels[plain.parent[k]] if k else 2)
    for k in range(len(labels) - 1, 0, -1):  # 2: outside of all marks
        p = plain.parent[k]
        if labels[p] == 2 and labels[k] in (1, 3):
            labels[p] = 3
    return plain, [int(x in (1, 3)) for x in labels]


def _marks(source: str) -> list[int | None]:
    """Label, or None, of every block element in the order of their start tags."""
    from .html_extract import BLOCK, MARKUP, RAW
    out, at = [], 0
    while m := MARKUP.search(source, at):
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if tag in BLOCK and not (m[1] or m[4]) and tag != "hr":
            y = _LABEL.search(m[0])
            out.append(int(y[1]) if y else None)
            if tag in RAW:
                e = source.lower().find(f"</{tag}", at)
                at = source.find(">", e) + 1 if e >= 0 else len(source)
    return out


@functools.lru_cache(1)
def default_model(n: int = PAGES, seed: int = 7) -> Model:
    """Trained on ``n`` labelled pages and ``RARE`` rare ones (fixed numbers, whatever the corpus)."""
    pages = [labelled_page(_Writer(seed * 10_000 + k).page()) for k in range(n)]
    pages += [labelled_page(_Writer(seed * 20_000 + k).rare_page()) for k in range(RARE)]
    return train([p for p, _ in pages], [y for _, y in pages])
