"""Labelled pages: the annotated set that operator 2's model is trained on.

Each page is built from annotated layouts: every block of text is written
through :class:`Page`, which notes whether it is main text.  The layouts cover
pages with sectioning elements, pages of plain ``div`` with telling class
names, tables, bare paragraphs, and what stands around an article: menus,
headers, footers, sidebars, notices, adverts, forms and reader comments.
"""

from __future__ import annotations

import random
from dataclasses import dataclass, field

# Names that authors give to main text and to what surrounds it.
CONTENT_NAMES = ("content", "article", "post", "entry", "story", "main", "body", "text", "page-content",
                 "post-content", "entry-content", "article-body", "story-body", "main-content")
ASIDE_NAMES = {
    "nav": ("nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "main-menu", "topnav", "pagination"),
    "header": ("header", "masthead", "site-header", "topbar", "top", "branding", "logo"),
    "footer": ("footer", "site-footer", "bottom", "copyright", "legal", "footer-links"),
    "sidebar": ("sidebar", "side", "widget", "related", "related-posts", "recommended", "trending", "popular", "aside", "rail"),
    "notice": ("notice", "cookie", "cookies", "consent", "alert", "banner", "gdpr", "disclaimer", "popup", "modal", "newsletter",
               "subscribe", "paywall"),
    "ad": ("ad", "ads", "advert", "advertisement", "sponsored", "sponsor", "promo", "promotion", "adsense", "ad-slot", "ad-box"),
    "form": ("form", "search", "login", "signup", "contact-form", "searchbox"),
    "comments": ("comments", "comment", "comment-list", "replies", "discussion", "respond", "reader-comments", "disqus"),
    "social": ("share", "social", "sharing", "share-buttons", "tags", "byline-links"),
}
_SYLLABLES = ("an", "er", "the", "ti", "on", "re", "ha", "ou", "is", "st", "en", "ver", "lo", "ma", "que", "ló", "sch", "né")


@dataclass
class Page:
    rng: random.Random
    html: list[str] = field(default_factory=list)
    blocks: list[str] = field(default_factory=list)

    def words(self, low: int, high: int) -> str:
        r = self.rng
        if r.random() < 0.1:  # the same word again and again, without a sentence's end
            return " ".join([r.choice(_SYLLABLES) + r.choice(("", ",", "%%", " |"))] * r.randint(low, high))
        w = ["".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 3))) for _ in range(r.randint(low, high))]
        return " ".join(w).capitalize() + r.choice((".", ".", ".", "", "?"))

    def add(self, markup: str) -> None:
        self.html.append(markup)

    def block(self, tag: str, text: str, main: bool, attrs: str = "", close: bool = True) -> None:
        inner = text
        r = self.rng
        if main and r.random() < 0.25:
            cut = text.split(" ")
            k = r.randrange(len(cut))
            cut[k] = f"<{t}>{cut[k]}</{t.split()[0]}>" if (t := r.choice(("b", "em", 'a href="/x"', "span"))) else cut[k]
            inner = " ".join(cut)
        y = f' data-y="{int(main)}"'
        self.add(f"<{tag}{attrs}{y}>{inner}" + (f"</{tag}>" if close else ""))
        if main:
            self.blocks.append(" ".join(text.split()))

    # -- main text ----------------------------------------------------------
    def main(self) -> None:
        r = self.rng
        if r.random() < 0.85:
            self.block(r.choice(("h1", "h1", "h2")), self.words(2, 12), True)
        sizes = r.choice((((1, 3), (3, 9), (10, 40), (10, 40), (30, 120), (200, 700)), ((1, 4),), ((2, 9),), ((10, 60),)))
        for _ in range(r.choice((1, 2, 4, 6, 9, 25 if len(sizes) == 1 else 12, 60 if len(sizes) == 1 else 9))):
            x = r.random()
            if x < 0.72:
                self.block("p", self.words(*r.choice(sizes)), True, close=r.random() < 0.8)
            elif x < 0.8:
                self.block(r.choice(("h2", "h3")), self.words(2, 6), True)
            elif x < 0.88:
                kind = r.choice(("ul", "ol"))
                self.add(f"<{kind}>")
                for _ in range(r.randint(2, 5)):
                    self.block("li", self.words(3, 14), True)
                self.add(f"</{kind}>")
            elif x < 0.92:
                self.block(r.choice(("blockquote", "pre", "figcaption")), self.words(5, 30), True)
            elif x < 0.95:
                self.add("<table>")
                for _ in range(r.randint(1, 3)):
                    self.add("<tr>")
                    for _ in range(2):
                        self.block("td", self.words(1, 4), True)
                    self.add("</tr>")
                self.add("</table>")
            else:
                self.aside(r.choice(("ad", "social", "sidebar", "notice")))

    # -- what surrounds it ----------------------------------------------------
    def open(self, kind: str) -> str:
        r = self.rng
        native = {"nav": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}.get(kind)
        name = r.choice(ASIDE_NAMES[kind])
        attr = r.choice(("class", "class", "id"))
        roles = {"nav": "navigation", "header": "banner", "footer": "contentinfo", "sidebar": "complementary"}
        if native and r.random() < 0.6:
            tag, attrs = native, r.choice(("", "", f' {attr}="{name}"'))
        else:
            tag = r.choice(("div", "div", "section", "ul" if kind == "nav" else "div"))
            attrs = f' {attr}="{name}"' if r.random() < 0.9 or kind not in roles else f' role="{roles[kind]}"'
        self.add(f"<{tag}{attrs}>")
        return tag

    def links(self, low: int, high: int, tag: str = "li") -> None:
        for _ in range(self.rng.randint(low, high)):
            self.block(tag, f'<a href="/{self.rng.randint(1, 99)}">{self.words(1, 3)}</a>', False)

    def aside(self, kind: str) -> None:
        r = self.rng
        tag = self.open(kind)
        if kind in ("nav", "social"):
            inner = r.choice(("li", "li", "div")) if tag != "ul" else "li"
            wrap = inner == "li" and tag != "ul"
            self.add("<ul>" if wrap else "")
            self.links(2, 8, inner)
            self.add("</ul>" if wrap else "")
        elif kind == "header":
            self.block(r.choice(("div", "h1", "p", "span")), self.words(1, 4), False)
            if r.random() < 0.5:
                self.aside("nav")
        elif kind == "footer":
            if r.random() < 0.5:
                self.links(1, 6)
            if r.random() < 0.5:
                self.block(r.choice(("p", "div", "small")), "&copy; " + self.words(2, 16), False)
            else:
                self.add("&copy; " + self.words(2, 16))
        elif kind == "sidebar":
            self.block(r.choice(("h2", "h3", "h4")), self.words(1, 3), False)
            if r.random() < 0.5:
                self.links(2, 8)
            else:
                for _ in range(r.randint(1, 3)):
                    self.block("p", self.words(4, 30), False)
        elif kind == "form":
            self.block("label", self.words(1, 3), False)
            self.add('<input type="text"><select><option>one<option>two</select>')
            self.block("button", self.words(1, 2), False)
            if r.random() < 0.4:
                self.block("p", self.words(5, 20), False)
        elif kind == "comments":
            if r.random() < 0.7:
                self.block(r.choice(("h2", "h3")), self.words(1, 3), False)
            for _ in range(r.choice((1, 2, 3, 5, 12))):
                box = r.choice(("div", "li", "article", "section"))
                self.add(f'<{box} class="{r.choice(("comment", "reply", "comment-body"))}">')
                if r.random() < 0.5:
                    self.block("span", self.words(1, 2), False)
                self.block("p", self.words(4, 60), False)
                self.add(f"</{box}>")
        elif r.random() < 0.5:
            self.add(self.words(3, 20))
        else:
            self.block("p", self.words(*r.choice(((4, 40), (4, 40), (60, 200)))), False)
            if r.random() < 0.3:
                self.links(1, 2, "div")
        self.add(f"</{tag}>")


def labelled_page(seed: int) -> tuple[str, str]:
    """One page whose block elements carry ``data-y`` (1: main text), and its main text."""
    r = random.Random(seed)
    page = Page(r)
    title = page.words(2, 9)
    page.add(f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{title}</title>'
             '<style>p{margin:0}</style><script>var t="</p>";</script></head><body>')
    wrap = r.random() < 0.4
    page.add(f'<div {r.choice(("class", "id"))}="{r.choice(("wrapper", "container", "page", "site", "row"))}">' if wrap else "")
    for kind in ("notice", "header", "nav", "ad", "sidebar", "form"):
        if r.random() < {"nav": 0.7, "header": 0.5}.get(kind, 0.25):
            page.aside(kind)
    style = r.random()
    if style < 0.45:
        tag, attrs = r.choice(("article", "article", "main")), ""
    elif style < 0.85:
        tag, attrs = r.choice(("div", "div", "section", "td")), f' {r.choice(("class", "id"))}="{r.choice(CONTENT_NAMES)}"'
    else:
        tag, attrs = "", ""
    page.add("<table><tr>" if tag == "td" else "")
    page.add(f"<{tag}{attrs}>" if tag else "")
    page.main()
    if tag and r.random() < 0.2:
        page.aside("comments")
    page.add(f"</{tag}>" if tag else "")
    page.add("</tr></table>" if tag == "td" else "")
    for kind in ("social", "comments", "sidebar", "ad", "form", "notice", "footer"):
        if r.random() < {"footer": 0.75, "comments": 0.35}.get(kind, 0.2):
            page.aside(kind)
    page.add("</div>" if wrap else "")
    page.add("</body></html>")
    return "".join(page.html), "\n".join(b for b in page.blocks if b)


def labelled_pages(count: int = 600, seed: int = 1) -> list[tuple[str, str]]:
    return [labelled_page(seed * 1_000_003 + i) for i in range(count)]
