"""Pages whose main text is known, to train the extraction of it.

A page is dealt from layouts that web pages use: with semantic elements or with classes and ids,
in tables or not, main parts with or without a wrapper, and menus, headers, footers, sidebars, notices, adverts,
forms and reader comments around and inside the article, with drawings, choices and fallbacks in
them, some without an end tag. Each text block is marked as main text
or not by the part that it was written for. Words are invented.
"""

from __future__ import annotations

import numpy as np

SYLLABLES = "ba ce di fo gu la me ni po ru sa te vi wo zu an er on ti al".split()
#: Of attribute values, one is dealt to the element that a part is in.
NAMES = {
    "nav": ["nav", "menu", "main-menu", "navbar", "site-navigation", "breadcrumbs", "topnav"],
    "header": ["header", "site-header", "masthead", "page-header", "top-bar", "top"],
    "footer": ["footer", "site-footer", "page-footer", "bottom", "copyright", "colophon"],
    "side": ["sidebar", "right-rail", "widget", "widget-area", "secondary", "side"],
    "ad": ["ad", "ads", "advert", "advertisement", "ad-slot", "sponsored", "promo", "banner-ad"],
    "notice": ["notice", "cookie-notice", "cookie-consent", "alert", "gdpr", "disclaimer",
               "newsletter-signup", "popup"],
    "form": ["search-form", "login", "contact-form", "signup", "search"],
    "comment": ["comments", "comment-list", "comment", "replies", "discussion", "reader-comments"],
    "more": ["share", "social", "related", "related-posts", "recommended", "tags", "share-buttons"],
    "content": ["content", "post", "entry-content", "article-body", "story", "main", "post-content",
                "article", "text", "page-content"],
    "plain": ["wrapper", "container", "row", "inner", "box", "c1", "layout", "block", "x7"],
}


class Writer:
    """Writes a page and, in the order of its text blocks, whether each is main text."""

    def __init__(self, seed: int) -> None:
        self.rng = np.random.default_rng(seed)
        self.out: list[str] = []
        self.truth: list[bool] = []
        self.tabled = False

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, low: int, high: int) -> list[str]:
        n = int(self.rng.integers(low, high + 1))
        return [
            "".join(self.pick(SYLLABLES) for _ in range(int(self.rng.integers(1, 4))))
            for _ in range(n)
        ]

    def prose(self, sentences: int) -> str:
        made = (" ".join(self.words(3, 16)).capitalize() for _ in range(sentences))
        return " ".join(s + self.pick([".", ".", ".", "!", "?"]) for s in made)

    def text(self, text: str, main: bool) -> None:
        """One text block, with inline elements now and then."""
        if self.chance(0.2) and " " in text:
            head, _, tail = text.partition(" ")
            name = self.pick(["b", "em", "strong", "span", "i"])
            text = f"<{name}>{head}</{name}> {tail}"
        elif main and self.chance(0.15) and " " in text:
            head, _, tail = text.partition(" ")
            text = f'{head} <a href="/x">{tail[:12]}</a>{tail[12:]}'
        self.out.append(text)
        self.truth.append(main)

    def element(self, tag: str, write, attribute: str = "") -> None:
        self.out.append(f"<{tag}{attribute}>")
        write()
        self.out.append(f"</{tag}>")

    def named(self, kind: str) -> str:
        name = self.pick(NAMES[kind])
        how = self.pick(["class", "class", "id"])
        extra = f" {self.pick(NAMES['plain'])}" if how == "class" and self.chance(0.3) else ""
        return f' {how}="{name}{extra}"'

    def holder(self, kind: str, tags: list[str], write) -> None:
        """A part in a semantic element, in a named one, or in both."""
        if self.tabled:
            self.cell(write, self.named(kind) if self.chance(0.6) else "")
            return
        tag = self.pick(tags)
        named = tag in ("div", "section", "ul", "p", "form") or self.chance(0.4)
        self.element(tag, write, self.named(kind) if named else "")

    def cell(self, write, attribute: str) -> None:
        """A part of a page that is laid out as a table."""
        self.tabled = False
        if self.chance(0.8):
            self.out.append("<tr>")
        self.element("td", write, attribute)
        self.tabled = True

    # --- parts without main text

    def bar(self) -> None:
        """Links in one line."""
        n = int(self.rng.integers(2, 8))
        between = self.pick([" | ", " ", " &middot; "])
        line = between.join(f'<a href="/x">{" ".join(self.words(1, 3))}</a>' for _ in range(n))
        self.truth.append(False)
        self.out.append(self.pick([f"<p>{line}</p>", f"{line}<hr>"]))

    def links(self) -> None:
        def item() -> None:
            text = " ".join(self.words(1, 4))
            self.out.append(f'<a href="/{text[:5]}">{text}</a>')
            self.truth.append(False)

        def listed() -> None:
            for _ in range(int(self.rng.integers(2, 9))):
                self.element("li", item)

        if self.chance(0.15):
            self.bar()
        elif self.chance(0.8):
            self.element("ul", listed)
        else:
            for _ in range(int(self.rng.integers(2, 6))):
                self.element("div", item)

    def aside_text(self, low: int = 1, high: int = 3) -> None:
        """A few lines that are no main text, in paragraphs or bare."""
        if self.chance(0.4):
            self.text(self.prose(int(self.rng.integers(low, high + 1))), False)
            return
        if self.chance(0.3):
            self.element(self.pick(["h2", "h3", "h4"]), lambda: self.text(" ".join(self.words(1, 4)), False))
        for _ in range(int(self.rng.integers(1, 3))):
            self.element("p", lambda: self.text(self.prose(int(self.rng.integers(low, high + 1))), False))

    def nav(self) -> None:
        self.holder("nav", ["nav", "nav", "div", "ul" if False else "div"], self.links)

    def header(self) -> None:
        def inside() -> None:
            if self.chance(0.6):
                self.element(self.pick(["h1", "h2", "div", "p"]), lambda: self.text(" ".join(self.words(1, 5)), False))
            if self.chance(0.5):
                self.nav()
            if self.chance(0.3):
                self.element("p", lambda: self.text(self.prose(1), False))

        self.holder("header", ["header", "header", "div"], inside)

    def footer(self) -> None:
        def inside() -> None:
            if self.chance(0.4):
                self.links()
            if self.chance(0.7):
                self.text("&copy; " + " ".join(self.words(1, 5)) + " &middot; " + self.prose(1), False)
            else:
                self.aside_text()

        self.holder("footer", ["footer", "footer", "div"], inside)

    def side(self) -> None:
        def inside() -> None:
            self.pick([self.links, self.aside_text, lambda: self.aside_text(2, 5)])()

        self.holder("side", ["aside", "aside", "div", "section"], inside)

    def ad(self) -> None:
        self.holder("ad", ["div", "div", "section", "p"], lambda: self.text(self.prose(int(self.rng.integers(1, 4))), False))

    def notice(self) -> None:
        self.holder("notice", ["div", "div", "section"], lambda: self.aside_text(1, 4))

    def form(self) -> None:
        def inside() -> None:
            for _ in range(int(self.rng.integers(1, 4))):
                self.element("label", lambda: self.text(" ".join(self.words(1, 3)), False))
                self.out.append('<input type="text">')
            if self.chance(0.4):
                self.element("p", lambda: self.text(self.prose(int(self.rng.integers(1, 3))), False))
            self.element("button", lambda: self.text(" ".join(self.words(1, 2)), False))

        self.element("form", inside, self.named("form") if self.chance(0.5) else "")

    def more(self) -> None:
        self.holder("more", ["div", "div", "section", "ul" if False else "div"], self.pick([self.links, self.aside_text]))

    def comments(self) -> None:
        def one() -> None:
            if self.chance(0.5):
                self.element(self.pick(["span", "div", "h4"]) if False else self.pick(["div", "h4"]),
                             lambda: self.text(" ".join(self.words(1, 3)), False))
            for _ in range(int(self.rng.integers(1, 3))):
                self.element("p", lambda: self.text(self.prose(int(self.rng.integers(1, 6))), False))

        def inside() -> None:
            if self.chance(0.5):
                self.element("h3", lambda: self.text(" ".join(self.words(1, 3)), False))
            tag = self.pick(["div", "li", "article", "section"])
            for _ in range(int(self.rng.integers(1, 7))):
                self.element(tag, one, self.named("comment") if self.chance(0.5) else "")

        self.holder("comment", ["div", "section", "section"], inside)

    def fallback(self, main: bool) -> None:
        """What is shown where scripts or plug-ins aren't: as main as the part around it."""
        tag = self.pick(["object", "canvas", "noscript"])
        write = lambda: self.text(self.prose(int(self.rng.integers(1, 5))), main)
        if self.chance(0.5):
            self.element(tag, write)
        else:
            self.element(tag, lambda: [self.element("p", write) for _ in range(int(self.rng.integers(1, 3)))])

    def drawing(self) -> None:
        """A labelled drawing, a choice or a template."""
        kind = self.rng.random()
        if kind < 0.4:
            labels = "".join(f'<g><path d="M0 0"/><text x="1">{w}</text></g>' for w in self.words(1, 6))
            self.out.append(f'<svg viewBox="0 0 9 9">{labels}</svg>')
            self.truth.append(False)
        elif kind < 0.8:
            options = "".join(f"<option>{w}</option>" for w in self.words(2, 12))
            self.out.append(f"<select>{options}</select>")
            self.truth.append(False)
        else:
            write = lambda: self.text(self.prose(int(self.rng.integers(1, 4))), False)
            self.element("template", write if self.chance(0.3) else lambda: self.element("p", write))

    def unclosed(self) -> None:
        """A holder whose end tag is missing; a block comes next."""
        tag = self.pick(["object", "canvas", "noscript", "svg", "select", "template"])
        self.out.append(f'<{tag}{self.pick(["", self.named("plain"), self.named("ad")])}>')
        if tag == "select" and self.chance(0.7):
            self.out.append("<option>" + "<option>".join(self.words(2, 6)))
            self.truth.append(False)
        elif tag == "svg":
            self.out.append('<path d="M0 0">')

    # --- the article

    def paragraph(self) -> None:
        sentences = 1 if self.chance(0.2) else int(self.rng.integers(1, 9))
        kind = self.rng.random()
        write = lambda: self.text(self.prose(sentences), True)
        if kind < 0.72:
            if self.chance(0.15):
                self.out.append("<p><b>")
                self.text(self.prose(sentences), True)
                self.out.append("<br>")
            else:
                self.element("p", write)
        elif kind < 0.80:
            self.element(self.pick(["h2", "h3"]), lambda: self.text(" ".join(self.words(1, 7)), True))
        elif kind < 0.86:
            def listed() -> None:
                for _ in range(int(self.rng.integers(2, 6))):
                    self.element("li", lambda: self.text(" ".join(self.words(2, 14)), True))

            self.element(self.pick(["ul", "ol"]), listed)
        elif kind < 0.91:
            self.element("blockquote", write if self.chance(0.5) else lambda: self.element("p", write))
        elif kind < 0.94:
            self.element("pre", lambda: self.text(" ".join(self.words(4, 20)), True))
        elif kind < 0.97:
            def row() -> None:
                for _ in range(2):
                    self.element("td", lambda: self.text(" ".join(self.words(1, 5)), True))

            self.element("table", lambda: [self.element("tr", row) for _ in range(3)])
        else:
            self.element("div", write)

    def article(self) -> None:
        title = lambda: self.text(self.prose(1) if self.chance(0.4) else " ".join(self.words(2, 9)), True)

        def head() -> None:
            self.element("h1", title)

        if self.chance(0.8):
            if self.chance(0.2):
                self.element("header", head)
            else:
                head()
        n = int(self.rng.integers(1, 4)) if self.chance(0.25) else int(self.rng.integers(2, 14))
        inside = [self.ad, self.more, self.notice, self.side, self.form, self.nav]
        for _ in range(n):
            self.paragraph()
            if self.chance(0.06):
                self.pick(inside)()
            if self.chance(0.03):
                self.fallback(True)
            if self.chance(0.02):
                self.drawing()
            if self.chance(0.01):
                self.unclosed()
                self.element("p", lambda: self.text(self.prose(2), True))
        if self.chance(0.15):
            self.comments()

    def body(self) -> None:
        self.tabled = self.chance(0.08)
        if self.tabled:
            self.out.append("<table>")
        for part, p in ((self.notice, 0.25), (self.header, 0.5), (self.nav, 0.6), (self.ad, 0.5),
                        (self.form, 0.15), (self.side, 0.2)):
            if self.chance(p):
                part()
            if self.chance(0.02):
                self.pick([lambda: self.fallback(False), self.drawing])()
        if self.chance(0.08):
            self.unclosed()
        kind = self.rng.random()
        if self.tabled:
            main = lambda: self.cell(self.article, self.named("content") if self.chance(0.5) else "")
        elif kind < 0.45:
            main = lambda: self.element("article", self.article, self.named("content") if self.chance(0.2) else "")
        elif kind < 0.8:
            main = lambda: self.element(self.pick(["div", "section"]), self.article, self.named("content"))
        elif kind < 0.92:
            main = lambda: self.element(self.pick(["div", "section"]), self.article, self.named("plain"))
        else:
            main = self.article
        if self.tabled:
            main()
        elif self.chance(0.25):
            self.element("main", main)
        elif self.chance(0.25):
            self.element("div", main, self.named("plain"))
        else:
            main()
        for part, p in ((self.more, 0.3), (self.comments, 0.35), (self.side, 0.35), (self.form, 0.15),
                        (self.ad, 0.25), (self.notice, 0.15), (self.footer, 0.8)):
            if self.chance(p):
                part()
        if self.tabled:
            self.out.append("</table>")

    def page(self) -> tuple[str, list[bool]]:
        title = " ".join(self.words(2, 7))
        self.out.append(
            f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style>"
            f'<script>var t="</p>";</script></head><body>'
        )
        if self.chance(0.2):
            self.element("div", self.body, self.named("plain"))
        else:
            self.body()
        if self.chance(0.9):
            self.out.append("</body></html>")
        return "".join(self.out), self.truth


def pages(count: int, seed: int = 0) -> list[tuple[str, list[bool]]]:
    return [Writer(seed * 1_000_003 + i).page() for i in range(count)]
