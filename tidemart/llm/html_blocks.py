"""Leaf blocks of an HTML page: text, tag path, share of link text."""

from __future__ import annotations

from html.parser import HTMLParser

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style template title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup "
                   "time tt u var".split())
# Starting one of these ends an open element of the named kinds, up to the nearest of the barriers.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
        "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
# Path elements that a block keeps, counted from the leaf.
PATH_ELEMENTS = 12


class Blocks(HTMLParser):
    """Feeds on one page; ``blocks`` holds (text, path, characters inside links)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, tuple[str, ...], int]] = []
        self.stack: list[tuple[str, str]] = []
        self.text: list[str] = []
        self.links, self.in_link, self.hidden = 0, 0, ""

    def flush(self) -> None:
        if self.text:
            text = " ".join("".join(self.text).split())
            if text:
                self.blocks.append((text, tuple(e[1] for e in self.stack[-PATH_ELEMENTS:]), self.links))
            self.text, self.links = [], 0

    def cut(self, at: int) -> None:
        for tag, _ in self.stack[at:]:
            self.in_link -= tag == "a"
        del self.stack[at:]

    def end_open(self, kinds: set[str], barriers: set[str]) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[i][0]
            if tag in kinds:
                self.cut(i)
                return
            if tag in barriers:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            if tag == "hr":
                self.flush()
            elif tag == "br":
                self.text.append(" ")
            return
        if tag in HIDDEN:
            self.hidden = tag
            return
        if tag not in INLINE:
            self.flush()
            self.end_open({"p"}, {"button", "td", "th", "table", "div", "section", "article", "aside", "main", "body", "li", "blockquote", "form"})
            if tag in ENDS:
                self.end_open(*ENDS[tag])
        names = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        self.in_link += tag == "a"
        self.stack.append((tag, f"{tag} {names}" if names else tag))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID or tag not in INLINE:
            self.handle_starttag(tag, attrs)
            if tag not in VOID and tag not in HIDDEN:
                self.handle_endtag(tag)
        self.hidden = "" if tag in HIDDEN else self.hidden

    def handle_endtag(self, tag: str) -> None:
        if tag == self.hidden:
            self.hidden = ""
            return
        if tag not in INLINE:
            self.flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                if tag in INLINE:
                    self.in_link -= tag == "a"
                    del self.stack[i]
                else:
                    self.cut(i)
                return
            if tag in INLINE and self.stack[i][0] not in INLINE:
                return

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.text.append(data)
            if self.in_link > 0:
                self.links += len(data)


def blocks_of(html: str) -> list[tuple[str, tuple[str, ...], int]]:
    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.blocks
