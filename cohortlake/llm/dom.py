"""A small HTML tree: block elements, the text blocks in them, and features of both."""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import cache

import numpy as np

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)|\b(hidden)\b", re.S)
PART = re.compile(r"[a-z]+|[A-Z][a-z]*")
SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Raw-text elements: what follows up to the end tag is no text of the page, nor holds tags.
SKIPPED = frozenset("script style title textarea iframe".split())
#: Elements with a drawing, a choice or a fallback. One gets a node when text or a block comes up in
#: it, so that an icon splits no paragraph; one without an end tag counts as a plain element.
HOLDERS = frozenset("noscript template svg object canvas select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s "
    "samp small span strike strong sub sup time tt u var wbr br "
    "math mi mn mo ms mtext mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced msub msup "
    "msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mlabeledtr mtd mspace "
    "maction semantics annotation annotation-xml none".split()
)
#: What an opening tag closes, if it is open above: element -> (closed elements, where to stop).
_BLOCKS = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_LIST = (frozenset(["li"]), frozenset(["ul", "ol", "menu"]))
_TERM = (frozenset(["dt", "dd"]), frozenset(["dl"]))
_CELL = (frozenset(["td", "th"]), frozenset(["tr", "table"]))
_ROW = (frozenset(["tr", "td", "th"]), frozenset(["table", "tbody", "thead", "tfoot"]))
CLOSES = {"li": _LIST, "dt": _TERM, "dd": _TERM, "td": _CELL, "th": _CELL, "tr": _ROW}
#: Other tags that end a drawing or a choice.
ENDS = frozenset("html head body li dt dd tr td th thead tbody tfoot caption button label input".split())
_SCOPE = frozenset(["table", "td", "th", "button", "object", "template", "foreignobject"])

#: Words in class, id and role, by what they speak for.
TOKENS = {
    "nav": "nav navbar navigation menu breadcrumb pagination pager toc tab tabs links submenu skip",
    "ad": "ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion "
    "promoted adsense commercial outbrain taboola",
    "comment": "comment commentlist reply replies respond discussion disqus feedback review "
    "reader readers thread",
    "frame": "header masthead footer foot bottom colophon copyright legal topbar top credits",
    "side": "sidebar side aside widget rail secondary complementary panel",
    "notice": "notice cookie consent alert gdpr privacy disclaimer message warning popup modal "
    "overlay toast banner subscribe newsletter signup paywall",
    "form": "form login search register contact input field button captcha poll survey",
    "more": "share sharing social related recommended recommendation similar trending popular "
    "tag tags author byline meta follow print tools utility latest",
    "content": "article content main post entry story body text page hentry blog news prose copy "
    "single",
}
GROUPS = {name: i for i, name in enumerate([*TOKENS, "hidden"])}
_GROUP_OF: dict[str, tuple[int, ...]] = {}
for _name, _words in TOKENS.items():
    for _word in _words.split():
        _GROUP_OF[_word] = (*_GROUP_OF.get(_word, ()), GROUPS[_name])

TAGS = {
    "p": 0, "h1": 1, "h2": 1, "h3": 1, "h4": 1, "h5": 1, "h6": 1, "li": 2, "ul": 2, "ol": 2,
    "dl": 2, "dt": 2, "dd": 2, "article": 3, "main": 3, "nav": 4, "menu": 4, "footer": 4,
    "aside": 4, "form": 5, "button": 5, "label": 5, "fieldset": 5, "legend": 5, "option": 5,
    "header": 6, "table": 7, "tr": 7, "td": 7, "th": 7, "blockquote": 8, "pre": 8, "figure": 9,
    "figcaption": 9, "dialog": 5, "address": 4, "select": 5, "noscript": 10,
    "object": 10, "canvas": 10, "svg": 11, "template": 11,
}
N_TAGS, N_GROUPS = 12, len(GROUPS)
#: Columns that are looked up in ancestors.
FEATURES = 2 * (N_TAGS + N_GROUPS) + 14


@cache
def groups_of(attributes: str) -> tuple[int, ...]:
    """The groups of tokens that a tag's attributes name."""
    found: set[int] = set()
    for name, value, hidden in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if hidden or name == "style" and "display:none" in value.replace(" ", "").lower():
            found.add(GROUPS["hidden"])
        elif name in ("class", "id", "role") or name == "aria-label":
            for token in PART.findall(value):
                token = token.lower()
                found.update(_GROUP_OF.get(token) or _GROUP_OF.get(token.removesuffix("s"), ()))
    return tuple(sorted(found))


class Page:
    """The nodes of a page in document order. A node is a block element or, with tag "", a text
    block: a run of text with its inline elements. ``text``, ``linked``: of text blocks."""

    def __init__(self, source: str) -> None:
        self.tag, self.parent, self.marks = ["html"], [-1], [()]
        self.text: list[str] = [""]
        self.linked: list[int] = [0]
        self._read(source)

    def _node(self, tag: str, parent: int, marks: tuple[int, ...], text: str, linked: int) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.marks.append(marks)
        self.text.append(text)
        self.linked.append(linked)
        return len(self.tag) - 1

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]
        # how often a name is on the stack, and among the open inline tags: what isn't there isn't looked for
        names, inline = Counter(), Counter()
        run: list[str] = []
        # of the run: characters in links, groups of its inline elements; and the open inline tags
        state = {"linked": 0, "marks": set(), "open": []}
        # holders without a node yet, and what was open before those with one: (tag, marks, open)
        held: list[tuple[str, tuple[int, ...], list]] = []
        outside: dict[int, list] = {}

        def flush() -> None:
            raw = "".join(run)
            run.clear()
            if raw and not raw.isspace():
                text = SPACE.sub(" ", html.unescape(raw)).strip()
                if text:
                    self._node("", stack[-1][1], tuple(state["marks"]), text, state["linked"])
            state["linked"] = 0
            state["marks"] = {g for _, marks in state["open"] for g in marks}

        def settle() -> None:
            for tag, marks, opened in held:
                flush()
                node = self._node(tag, stack[-1][1], marks, "", 0)
                stack.append((tag, node))
                names[tag] += 1
                outside[node] = opened
            held.clear()

        def say(text: str) -> None:
            if held and not text.isspace():
                settle()
            run.append(text)
            if inline["a"]:
                state["linked"] += len(text.strip())

        def plain(depth: int) -> None:
            for tag, node in stack[depth:]:
                if tag in HOLDERS:
                    self.tag[node], self.marks[node] = "div", ()

        def close(depth: int) -> None:
            flush()
            held.clear()
            plain(depth + 1)
            opened = outside.get(stack[depth][1], [])
            names.subtract(tag for tag, _ in stack[depth:])
            del stack[depth:]
            state["open"], state["marks"] = opened, {g for _, marks in opened for g in marks}
            inline.clear()
            inline.update(tag for tag, _ in opened)

        def within() -> str:
            """The drawing or choice that a tag is in: it has no blocks and ends at one."""
            tag = held[-1][0] if held else stack[-1][0]
            return tag if tag in ("svg", "select") else ""

        at, end = 0, len(source)
        while at < end:
            found = TOKEN.search(source, at)
            if not found:
                say(source[at:])
                break
            if found.start() > at:
                say(source[at : found.start()])
            at = found.end()
            slash, name, attributes = found.group(1, 2, 3)
            if name is None:
                slash, name, attributes = found.group(4, 5, 6)
            if name is None:
                if found.group().startswith("<![CDATA["):
                    say(html.escape(found.group()[9:].removesuffix("]]>")))
                continue
            name = name.lower()
            if name in SKIPPED:
                if not slash and not attributes.endswith("/"):
                    stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                    at = stop.end() if stop else end
                run.append(" ")
            elif name in HOLDERS:
                if not slash:
                    if not attributes.endswith("/"):
                        held.append((name, groups_of(attributes), list(state["open"])))
                elif any(tag == name for tag, _, _ in held):
                    while held.pop()[0] != name:
                        pass
                elif names[name]:
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth][0] == name:
                            close(depth)
                            break
                run.append(" ")
            elif name in ("br", "wbr", "img"):
                run.append("" if name == "wbr" else " ")
            elif name in INLINE:
                if not slash:
                    marks = groups_of(attributes)
                    state["open"].append((name, marks))
                    state["marks"].update(marks)
                    inline[name] += 1
                elif inline[name]:
                    inline[name] -= 1
                    for i in range(len(state["open"]) - 1, -1, -1):
                        if state["open"][i][0] == name:
                            del state["open"][i]
                            break
            elif held and name in VOID and name not in ("hr", "input") or (
                within() and name not in _BLOCKS and name not in ENDS and name != "foreignobject"
            ):
                run.append(" ")
            elif slash and not names[name]:
                flush()
            elif slash:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == name:
                        close(depth)
                        break
            else:
                while name not in ("foreignobject", "hr") and within():
                    if held:
                        held.pop()
                    else:
                        close(len(stack) - 1)
                if name not in ("html", "head", "body") and name not in VOID:
                    settle()
                self._implied(name, stack, names, close)
                flush()
                if name in ("html", "head", "body") or name in VOID:
                    if name == "body":
                        self.marks[0] = tuple({*self.marks[0], *groups_of(attributes)})
                    continue
                state["open"], state["marks"] = [], set()
                inline.clear()
                marks = groups_of(attributes)
                node = self._node(name, stack[-1][1], marks, "", 0)
                if not attributes.endswith("/"):
                    stack.append((name, node))
                    names[name] += 1
        flush()
        plain(0)

    @staticmethod
    def _implied(name: str, stack: list[tuple[str, int]], names: Counter, close) -> None:
        """End tags that an opening tag implies."""
        closed, stops = CLOSES.get(name, (frozenset(), frozenset()))
        if name in _BLOCKS:
            closed, stops = frozenset(["p"]), _SCOPE
        if not any(names[tag] for tag in closed):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] in stops:
                return
            if stack[depth][0] in closed:
                close(depth)
                if name != "tr":
                    return

    def features(self) -> np.ndarray:
        """One row per node: its own tag and tokens, those of its ancestors, and statistics of its
        subtree, of its place and of its siblings."""
        n = len(self.tag)
        parent = np.array(self.parent)
        chars = np.array([len(t) for t in self.text], dtype=np.float64)
        linked = np.minimum(np.array(self.linked, dtype=np.float64), chars)
        stops = np.array([sum(map(t.count, ".!?")) for t in self.text], dtype=np.float64)
        blocks = (chars > 0).astype(np.float64)
        size = np.ones(n)
        before = np.cumsum(chars) - chars
        own = chars.copy()
        depth = np.zeros(n)
        marks = np.zeros((n, N_TAGS + N_GROUPS), dtype=np.float64)
        for i, (tag, of) in enumerate(zip(self.tag, self.marks, strict=True)):
            kind = TAGS.get(tag)
            if kind is not None:
                marks[i, kind] = 1
            for g in of:
                marks[i, N_TAGS + g] = 1
        above = np.zeros_like(marks)
        for i in range(1, n):
            p = parent[i]
            depth[i] = depth[p] + 1
            above[i] = np.maximum(above[p], marks[p])
        for i in range(n - 1, 0, -1):
            p = parent[i]
            chars[p] += chars[i]
            linked[p] += linked[i]
            stops[p] += stops[i]
            blocks[p] += blocks[i]
            size[p] += size[i]
        total = max(chars[0], 1.0)
        siblings = np.bincount(parent[1:], minlength=n).astype(np.float64)
        place = np.zeros(n)
        seen = np.zeros(n)
        for i in range(1, n):
            place[i] = seen[parent[i]]
            seen[parent[i]] += 1
        around = np.maximum(siblings[parent], 1)
        near = (chars[parent] - chars) / np.maximum(around - 1, 1)
        statistics = [
            own > 0,
            np.log1p(chars),
            linked / np.maximum(chars, 1),
            stops / np.maximum(chars, 1) * 100,
            np.log1p(blocks),
            np.log1p(chars / np.maximum(blocks, 1)),
            np.log1p(chars / size),
            depth,
            place,
            around,
            np.log1p(np.maximum(near, 0)),
            before / total,
            chars / total,
            chars / np.maximum(chars[parent], 1),
        ]
        return np.concatenate([marks, above, np.stack(statistics, axis=1)], axis=1)
