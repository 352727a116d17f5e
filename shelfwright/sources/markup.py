"""Items of one listing page, found in its markup.

The tasks of ``pages.extract_items`` run this module. It is shipped by value,
so executors need no installed copy of the package.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark import cloudpickle


@dataclass(frozen=True)
class ItemRules:
    """Where items, names and prices are; tried in order, as ``tag.class`` chains.

    A selector is one or two steps; the second may lie anywhere below the first.
    """

    # They decide which items are found.
    containers: tuple[str, ...] = ("article.galleryview__item", ".productlist__product")
    links: tuple[str, ...] = (
        "a.galleryview__name-link", ".productlist__name a", "a.productlist__link", "h3 a",
    )
    prices: tuple[str, ...] = (
        ".galleryview__price .price", ".productlist__price .price",
        ".productlist__price .gh_price", ".gh_price", ".price",
    )
    price_locale: str = "de"
    max_price: float = 20000.0
    need_price: bool = True


@dataclass
class _Node:
    tag: str
    attrs: dict[str, str]
    children: list = field(default_factory=list)

    def below(self) -> Iterator["_Node"]:
        stack = list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, _Node):
                yield node
                stack.extend(reversed(node.children))

    def text(self) -> str:
        words, stack = [], list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, _Node):
                stack.extend(reversed(node.children))
            else:
                words.append(node)
        return " ".join(" ".join(words).split())

    def matches(self, step: str) -> bool:
        tag, *classes = step.split(".")
        own = (self.attrs.get("class") or "").split()
        return (not tag or tag == self.tag) and all(c in own for c in classes)

    def select(self, selector: str) -> Iterator["_Node"]:
        head, *rest = selector.split()
        for node in self.below():
            if node.matches(head):
                if rest:
                    yield from node.select(" ".join(rest))
                else:
                    yield node


class _Tree(HTMLParser):
    VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in ("li", "p", "tr", "td", "dt", "dd", "option") and self.open[-1].tag == tag:
            self.open.pop()
        node = _Node(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in self.VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].children.append(_Node(tag, dict(attrs)))

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        if self.open[-1].tag not in ("script", "style"):
            self.open[-1].children.append(data)


def page_items(html: str, base: str, rules: ItemRules) -> Iterator[tuple]:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    for container in rules.containers:
        # A nested selector can reach one node twice; positions count it once.
        items = list({id(n): n for n in tree.root.select(container)}.values())
        if items:
            break
    else:
        return
    for position, item in enumerate(items, start=1):
        for selector in rules.links:
            link = next(item.select(selector), None)
            if link is None:
                continue
            name, href = link.text(), link.attrs.get("href")
            if name and href:
                break
        else:
            continue
        found = (next(item.select(p), None) for p in rules.prices)
        yield position, name, urljoin(base, href), [n.text() for n in found if n is not None]


cloudpickle.register_pickle_by_value(sys.modules[__name__])
