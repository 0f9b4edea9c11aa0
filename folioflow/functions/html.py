"""Parts of an article's HTML: one parse a page gives them all, as one struct.

Superscripts become their proper signs and an image has its own height; ``compat=True`` gives the signs and
heights that older outputs have (U+2070 plus the digit, and the width).
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from urllib.parse import unquote_plus

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.dom import Node, parse

#: What the text of an article does without.
NOISE_TAGS = frozenset("figure footer input link nav noscript script style sub sup table".split())
#: Classes of what is no article text.
NOISE_CLASSES = frozenset(
    "book catlinks citation gallery gallerybox hatnote listaref metadata mw-authority-control mw-editsection-bracket mw-editsection-divider "
    "mw-editsection-like mw-editsection-visualeditor mw-editsection mw-footer-container mw-gallery-packed mw-magiclink-isbn mw-mf-linked-projects "
    "mw-redirectedfrom NavFrame navigation-not-searchable noprint normdaten portal-bar printfooter refbegin-columns refbegin references reflist "
    "side-box sister-box sistersitebox vector-body-before-content vector-dropdown vector-header-container vector-page-toolbar vector-settings".split()
)
ABSTRACT_TAGS = frozenset("table div input script style link figure figcaption caption".split())
ABSTRACT_CLASSES = frozenset(
    "mw-ref mw-reflink-text reference IPA pronunciation respelling Z3988 geo-nondefault geo-multi-punct hide-when-compact noprint noexcerpt nomobile sortkey lang-comment rt-commentedText".split()
)
INFOBOXES = frozenset("infobox infobox_v2 infobox_v3 sinottico".split())
HIDDEN = frozenset("noprint noviewer navigation-only".split())
#: Headings of sections that are not article text, in the languages served.
BOILERPLATE = frozenset(
    "References Explanatory_notes Further_reading See_also External_links Notes Notable_people Primary_sources Secondary_sources Tertiary_sources "
    "Citations General_and_cited_sources Bibliography Referencias Véase_también Bibliografía Enlaces_externos Ciudades_hermanas Referencias_y_notas "
    "Literatur Weblinks Einzelnachweise Références Voir_aussi Bibliographie Liens_externes Notes_et_références Galerie_photos Referências Ver_também "
    "Bibliografia Ligações_externas Notas Annexes Article_connexe Voci_correlate Altri_progetti Collegamenti_esterni Note_e_riferimenti Note Riferimenti".split()
)
_SUPERSCRIPTS = str.maketrans("0123456789", "⁰¹²³⁴⁵⁶⁷⁸⁹")
_TIDY = (
    (re.compile(r"\[[^\]]+\]|•|[\u0000-\u0008​-‏﻿]"), ""),
    (re.compile(r"\s+"), " "),
    (re.compile(r"\s+([:;：；, ，、.!?])"), r"\1"),
    (re.compile(r"(\()\s+|\s+(\))"), r"\1\2"),
)


def _title(link: str) -> str:
    bare = link.removeprefix("./").replace("_", " ")
    return bare if re.search(r"%(?![0-9A-Fa-f]{2})", bare) else unquote_plus(bare)


def _url(link: str, base: str) -> str:
    url = base + link.removeprefix("./")
    return "" if re.search(r"%(?![0-9A-Fa-f]{2})", url) else url


def base_url(root: Node) -> str:
    node = root.first(lambda n: n.tag == "base" and n.attrs.get("href"))
    return "https:" + node.attrs["href"] if node else ""


def _relations(links: Iterator[str], base: str) -> list[dict]:
    found = {_title(x): _url(x, base) for x in links if x}
    return [{"name": n, "url": u} for n, u in sorted(found.items()) if n]


def templates(root: Node) -> list[dict]:
    def links() -> Iterator[str]:
        for node in root.find(lambda n: "parts" in n.attrs.get("data-mw", "")):
            try:
                parts = json.loads(node.attrs["data-mw"]).get("parts", [])
            except (ValueError, AttributeError):
                continue
            for part in parts:
                if isinstance(part, dict):
                    yield ((part.get("template") or {}).get("target") or {}).get("href", "")

    return _relations(links(), base_url(root))


def categories(root: Node) -> list[dict]:
    found = root.find(lambda n: n.tag == "link" and n.attrs.get("rel") == "mw:PageProp/Category")
    return _relations((n.attrs.get("href", "").split("#")[0] for n in found), base_url(root))


def _without(root: Node, test: Callable[[Node], bool]) -> Node:
    for node in list(root.find(test)):
        node.drop()
    return root


def _hidden(node: Node) -> bool:
    return node.tag in ("script", "style", "#comment") or bool(node.classes() & HIDDEN) or "display:none" in node.attrs.get("style", "").replace(" ", "")


def cleaned(root: Node) -> Node:
    return _without(root.copy(), _hidden)


def superscripts(root: Node, compat: bool = False) -> Node:
    """Numbers in ``sup`` as signs in the text."""
    for node in list(root.find(lambda n: n.tag == "sup")):
        digits = node.content().strip()
        if digits.isascii() and digits.isdigit():
            text = "".join(chr(0x2070 + int(d)) for d in digits) if compat else digits.translate(_SUPERSCRIPTS)
            node.tag, node.text, node.children = "#text", text, []
    return root


def tidy(text: str) -> str:
    for pattern, by in _TIDY:
        text = pattern.sub(by, text)
    return text.strip()


def text_of(node: Node, ignored: frozenset[str] = frozenset()) -> str:
    """Text, with a space between neighbouring elements that would else run together."""
    parts: list[str] = []

    def visit(n: Node) -> None:
        if n.tag == "#text":
            parts.append(n.text)
        elif n.tag not in ("script", "style", "#comment") and n.tag not in ignored:
            apart = n.tag in ("br", "p", "li", "div", "td", "th", "tr", "dd", "dt") or n.tag.startswith("h")
            if apart:
                parts.append(" ")
            for c in n.children:
                visit(c)
            if apart:
                parts.append(" ")

    visit(node)
    return tidy("".join(parts))


def lists_as_text(node: Node, depth: int = 0) -> str:
    """A list as lines ``- item``, inner lists indented."""
    lines = []
    for item in node.children:
        if item.tag not in ("li", "dt", "dd"):
            continue
        own = item.copy()
        inner = [c for c in own.children if c.tag in ("ul", "ol", "dl")]
        for c in inner:
            c.drop()
        lines.append("  " * depth + "- " + text_of(own))
        lines += [lists_as_text(c, depth + 1) for c in inner]
    return "\n".join(x for x in lines if x.strip())


def _bare(text: str) -> str:
    """text without what stands in parentheses, the innermost first."""
    while (less := re.sub(r"\s*[(（][^()（）]*[)）]", "", text)) != text:
        text = less
    return text


def abstract(root: Node, compat: bool = False) -> str:
    """The paragraphs and lists of the first section; parentheses go, except in formulas."""
    body = root.first(lambda n: n.tag == "body") or root
    section = body.first(lambda n: n.tag == "section")
    if section is None:
        return ""
    own = section.copy()
    _without(own, lambda n: bool(n.classes() & ABSTRACT_CLASSES) or n.tag in ABSTRACT_TAGS or "IPA" in n.attrs.get("data-mw", "") or "pronunciation" in n.attrs.get("title", "") or n.attrs.get("id") == "coordinates" or "display:none" in n.attrs.get("style", "").replace(" ", ""))
    formula = own.first(lambda n: n.tag in ("sub", "math")) is not None
    superscripts(own, compat)
    out = []
    for node in own.children:
        if node.tag in ("ul", "ol", "dl"):
            out.append(lists_as_text(node))
        elif node.tag in ("p", "blockquote"):
            text = text_of(node)
            out.append(text if formula else tidy(_bare(text)))
    return "\n".join(x for x in out if x)


def images(root: Node, compat: bool = False) -> list[dict]:
    found = []
    for node in root.find(lambda n: n.tag == "img" and n.attrs.get("src")):
        number = lambda k, node=node: int(node.attrs[k]) if node.attrs.get(k, "").isdigit() else 0
        caption = ""
        for up in node.up():
            if up.tag == "figure":
                cap = up.first(lambda n: n.tag == "figcaption")
                caption = text_of(cap) if cap else ""
                break
        src = node.attrs["src"]
        found.append({"content_url": "https:" + src if src.startswith("//") else src, "alternative_text": node.attrs.get("alt", ""), "caption": caption, "width": number("width"), "height": number("width" if compat else "height")})
    return found


def links(root: Node, base: str | None = None) -> list[dict]:
    """Every link but those to files: its text, else its title, and its address."""
    base = base_url(root) if base is None else base
    found = []
    for node in root.find(lambda n: n.tag == "a" and not n.attrs.get("href", "").startswith("./File:")):
        href = node.attrs.get("href", "")
        if href.startswith("./"):
            url = _url(href, base)
        elif href.startswith("//"):
            url = "https:" + href
        elif href.startswith("/"):
            url = "/".join(base.split("/")[:3]) + href
        else:
            url = href
        found.append({"url": url, "text": text_of(node) or node.attrs.get("title", "")})
    return found


def _part(kind: str, **fields) -> dict:
    return {"type": kind, **{k: v for k, v in fields.items() if v}}


def infobox(box: Node, base: str, compat: bool = False) -> dict:
    """Rows as fields, lists and images, under the headings that stand above them."""
    title = box.first(lambda n: n.tag == "caption" or "infobox-title" in n.classes())
    out = _part("infobox", name=text_of(title) if title else "", has_parts=[])
    out["has_parts"] = here = []
    for row in box.find(lambda n: n.tag == "tr"):
        cells = [c for c in row.children if c.tag in ("th", "td")]
        head = next((c for c in cells if c.tag == "th"), None)
        data = [c for c in cells if c.tag == "td"]
        if head is not None and not data:
            section = _part("section", name=text_of(head), has_parts=[])
            section["has_parts"] = here = []
            out["has_parts"].append(section)
            continue
        for cell in data:
            pictures = images(cell, compat)
            if pictures:
                here.append(_part("image", images=pictures, value=text_of(cell)))
                continue
            items = [text_of(li) for li in cell.find(lambda n: n.tag == "li")]
            kind = "list" if items else "field"
            here.append(_part(kind, name=text_of(head) if head else "", value=text_of(cell), values=items or None, links=links(cell, base)))
    return out


def infoboxes(root: Node, compat: bool = False) -> list[dict]:
    base = base_url(root)
    boxes = cleaned(root).find(lambda n: bool(n.classes() & INFOBOXES))
    return [infobox(b, base, compat) for b in boxes if not any(u.classes() & INFOBOXES for u in b.up())]


def paragraph(node: Node, base: str) -> dict:
    return _part("paragraph", value=text_of(node), links=links(node, base))


def list_part(node: Node, base: str) -> dict:
    items = []
    for li in node.children:
        if li.tag in ("li", "dt", "dd"):
            own = li.copy()
            inner = [c for c in own.children if c.tag in ("ul", "ol", "dl")]
            for c in inner:
                c.drop()
            items.append(_part("list_item", value=text_of(own), links=links(own, base), has_parts=[list_part(c, base) for c in inner]))
    return _part("list", has_parts=items)


def _heading(section: Node) -> Node | None:
    return next((n for n in section.walk() if re.fullmatch("h[1-6]", n.tag)), None)


def sections(root: Node) -> list[dict]:
    """Sections in their nesting; the first one is named Abstract; those with boilerplate headings or nothing in them go."""
    base = base_url(root)

    def noise(n: Node) -> bool:
        return n.tag in NOISE_TAGS or bool(n.classes() & (NOISE_CLASSES | INFOBOXES)) or n.attrs.get("role") == "navigation"

    own = _without(superscripts(cleaned(root)), noise)

    def build(node: Node, first: bool) -> dict | None:
        head = _heading(node)
        name = "Abstract" if first else (text_of(head) if head else "")
        if head is not None and (head.attrs.get("id") or name.replace(" ", "_")) in BOILERPLATE:
            return None
        parts: list[dict] = []

        def visit(n: Node) -> None:
            for c in n.children:
                if c.tag == "section":
                    if (inner := build(c, False)) is not None:
                        parts.append(inner)
                elif c.tag == "p":
                    if (p := paragraph(c, base)).get("value"):
                        parts.append(p)
                elif c.tag in ("ul", "ol", "dl"):
                    if (x := list_part(c, base)).get("has_parts"):
                        parts.append(x)
                elif c.tag in ("div", "blockquote", "article", "main"):
                    visit(c)

        visit(node)
        return _part("section", name=name, has_parts=parts) if parts else None

    body = own.first(lambda n: n.tag == "body") or own
    top = [n for n in body.find(lambda n: n.tag == "section") if not any(u.tag == "section" for u in n.up())]
    return [s for i, n in enumerate(top) if (s := build(n, i == 0)) is not None]


def references(root: Node) -> list[dict]:
    """The items of the reference lists, numbered from 1 through the page."""
    base, found = base_url(root), []
    for box in root.find(lambda n: "references" in n.classes()):
        for li in box.find(lambda n: n.tag == "li"):
            text = li.first(lambda n: "mw-reference-text" in n.classes()) or li
            found.append({"id": li.attrs.get("id", ""), "index": len(found) + 1, "text": text_of(text), "links": links(text, base)})
    return found


_RELATION = "array<struct<name:string,url:string>>"
_LINK = "array<struct<url:string,text:string>>"
PARTS = (
    f"base_url string, abstract string, text string, templates {_RELATION}, categories {_RELATION}, links {_LINK}, "
    "images array<struct<content_url:string,alternative_text:string,caption:string,width:int,height:int>>, "
    f"infoboxes string, sections string, references array<struct<id:string,index:int,text:string,links:{_LINK}>>"
)


#: How each part is made of the page's tree.
_MAKERS = {
    "base_url": lambda root, compat: base_url(root),
    "abstract": abstract,
    "text": lambda root, compat: text_of(root.first(lambda n: n.tag == "body") or root),
    "templates": lambda root, compat: templates(root),
    "categories": lambda root, compat: categories(root),
    "links": lambda root, compat: links(root),
    "images": images,
    "infoboxes": lambda root, compat: _json(infoboxes(root, compat)),
    "sections": lambda root, compat: _json(sections(root)),
    "references": lambda root, compat: references(root),
}


def _json(found: list) -> str | None:
    return json.dumps(found, ensure_ascii=False) if found else None


def parts(html: str | None, compat: bool = False, only: tuple[str, ...] = tuple(_MAKERS)) -> dict:
    """The parts asked for (all by default); recursive ones as JSON text, null where there are none."""
    root = parse(html or "")
    return {name: _MAKERS[name](root, compat) for name in only}


def html_parts(html: Column, compat: bool = False, only: tuple[str, ...] = tuple(_MAKERS)) -> Column:
    """The parts asked for as one struct; no other part is computed."""
    fields = dict(f.split(" ", 1) for f in re.split(r", (?=\w+ )", PARTS))

    @F.pandas_udf(", ".join(f"{name} {fields[name]}" for name in only))
    def run(pages: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for page in pages:
            yield pd.DataFrame([parts(p, compat, only) for p in page], columns=list(only))

    return run(html)
