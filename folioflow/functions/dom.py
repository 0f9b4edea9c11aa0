"""A small document tree over the standard library's HTML tokenizer."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

#: Elements without content, and those whose start ends an open one of the same set.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


class Node:
    __slots__ = ("attrs", "children", "parent", "tag", "text")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, text: str = ""):
        self.tag, self.attrs, self.text = tag, attrs or {}, text
        self.children: list[Node] = []
        self.parent: Node | None = None

    def add(self, child: Node) -> None:
        child.parent = self
        self.children.append(child)

    def walk(self) -> Iterator[Node]:
        """All below, in document order."""
        stack = self.children[::-1]
        while stack:
            node = stack.pop()
            yield node
            stack += node.children[::-1]

    def find(self, test: Callable[[Node], bool]) -> Iterator[Node]:
        return (n for n in self.walk() if n.tag != "#text" and test(n))

    def first(self, test: Callable[[Node], bool]) -> Node | None:
        return next(self.find(test), None)

    def up(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def classes(self) -> frozenset[str]:
        return frozenset(self.attrs.get("class", "").split())

    def drop(self) -> None:
        if self.parent is not None:
            self.parent.children.remove(self)
            self.parent = None

    def copy(self) -> Node:
        twin = Node(self.tag, dict(self.attrs), self.text)
        for c in self.children:
            twin.add(c.copy())
        return twin

    def content(self) -> str:
        return self.text if self.tag == "#text" else "".join(n.text for n in self.walk() if n.tag == "#text")


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("#root")
        self.open = [self.root]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        ends = CLOSES.get(tag, set())
        if tag in BLOCKS and self.open[-1].tag == "p":
            self.open.pop()
        while self.open[-1].tag in ends:
            self.open.pop()
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].add(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.open[-1].add(Node(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].add(Node("#text", text=data))

    def handle_comment(self, data: str) -> None:
        self.open[-1].add(Node("#comment", text=data))


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root
