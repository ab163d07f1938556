"""HTML to blocks and facts (TF-01 to TF-03, TF-08 to TF-10, TF-13 to TF-18) over the standard library's tokenizer.

Element tree rules we fix ourselves: void elements never open; a start of a block element, or the end of its parent,
closes an open p; unknown end tags are skipped; script and style are raw text.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser
from urllib.parse import urljoin

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote center dir div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())


class Node:
    __slots__ = ("attributes", "children", "name")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.children = name, attributes, []

    def walk(self):
        """Descendant elements in document order."""
        stack = [iter(self.children)]
        while stack:
            for c in stack[-1]:
                if isinstance(c, Node):
                    yield c
                    stack.append(iter(c.children))
                    break
            else:
                stack.pop()

    def text(self, joint: str = " ") -> str:
        """Stripped, non-empty strings of the subtree, joined."""
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                if s := n.strip():
                    out.append(s)
            else:
                stack.extend(reversed(n.children))
        return joint.join(out)

    def classes(self) -> set[str]:
        return set((self.attributes.get("class") or "").split())


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._end("p", stop=CLOSES_P - {"p"})
        if tag == "li":
            self._end("li", stop={"ul", "ol"})
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_endtag(self, tag):
        self._end(tag)

    def _end(self, tag, stop=frozenset()):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].name == tag:
                del self.open[i:]
                return
            if self.open[i].name in stop:
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str | None) -> Node:
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def clean(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip()


def main_container(root: Node) -> Node | None:
    """First of div#content, div.article, div#article, div#main, body; None if there is none."""
    divs = [n for n in root.walk() if n.name == "div"]
    tests = (lambda n: n.attributes.get("id") == "content", lambda n: "article" in n.classes(), lambda n: n.attributes.get("id") == "article", lambda n: n.attributes.get("id") == "main")
    for test in tests:
        for n in divs:
            if test(n):
                return n
    return next((n for n in root.walk() if n.name == "body"), None)


#: Elements, and parts of class names of a div, that are no content.
_CHROME = frozenset(("script", "style", "nav", "header", "footer", "form"))
_CHROME_CLASS = re.compile("nav|menu|footer|header", re.I)


def strip_noise(node: Node) -> None:
    def noise(c) -> bool:
        return isinstance(c, Node) and (c.name in _CHROME or c.name == "div" and any(_CHROME_CLASS.search(x) for x in c.classes()))

    for n in [node, *node.walk()]:
        n.children = [c for c in n.children if not noise(c)]


#: How paragraphs begin, or what they hold, that are apparatus rather than text; labels of page headers.
NOISE_STARTS = ("back to ", "back ", "written:", "first published:", "published:", "source:", "translated:", "transcribed", "transcription", "proofed:", "copyleft:", "permission is granted to copy", "see note in:")
NOISE_PARTS = ("mia :", "marxists internet archive", "marx-engels archive", "more study guides", "creative commons")
HEADER_LABELS = ("written", "source", "first published", "published", "translated", "transcribed", "transcription", "transcription/markup", "transcription/mark-up", "public domain", "copyleft")
#: Fixed value: how a title names its author.
BY = re.compile(r"\bby\s+([A-Z][A-Za-z .'-]{2,80})\b")


def is_noise(text: str) -> bool:
    low = text.lower()
    return low.startswith(NOISE_STARTS) or low == "index" or any(p in low for p in NOISE_PARTS)


def is_header(p: Node) -> bool:
    """Introductions, and information paragraphs that begin with a header label or list one in their first labels."""
    if "intro" in p.classes():
        return True
    if "information" not in p.classes():
        return False
    if clean(p.text()).lower().startswith(tuple(f"{k}:" for k in HEADER_LABELS)):
        return True
    labels = [n for n in p.walk() if n.name == "span" and "info" in n.classes()][:6]
    return any(clean(s.text()).rstrip(":").lower() in set(HEADER_LABELS) - {"transcribed"} for s in labels)


def author_override(title: str | None) -> str | None:
    m = BY.search(title or "")
    name = m[1].strip() if m else ""
    return name if len(name) >= 3 else None


def blocks(html: str | None) -> list[dict]:
    """Blocks of a page: title (or None), level, author override, paragraphs. A page without a container has none."""
    container = main_container(parse(html))
    if container is None:
        return []
    strip_noise(container)
    out: list[dict] = []
    now = {"title": None, "level": 1, "author": None, "paragraphs": []}

    def flush():
        if now["paragraphs"] or now["title"] is not None:
            out.append(dict(now))

    for n in container.walk():
        if n.name in ("h1", "h2", "h3", "h4"):
            if title := clean(n.text()):
                flush()
                now = {"title": title, "level": int(n.name[1]), "author": author_override(title), "paragraphs": []}
        elif n.name == "p" and not is_header(n):
            text = clean(n.text())
            if text and not is_noise(text):
                now["paragraphs"].append(text)
    flush()
    if not out:
        whole = clean(container.text("\n"))  # white space collapses first, so one paragraph at most
        out.append({"title": None, "level": 1, "author": None, "paragraphs": [whole] if whole else []})
    return out


def links(html: str | None, base: str) -> list[str]:
    """Targets of a and area elements, resolved; fragments, mail and scripts skipped."""
    out = []
    for n in parse(html).walk():
        target = (n.attributes.get("href") or "").strip() if n.name in ("a", "area") else ""
        if target and not target.startswith(("#", "mailto:", "javascript:")):
            try:
                out.append(urljoin(base, target))
            except ValueError:
                continue
    return out


def sample(html: str | None, size: int = 800) -> dict:
    """Title, first h1, and the first three paragraphs cut to size."""
    first, paragraphs = {}, []
    for n in parse(html).walk():
        if n.name in ("title", "h1"):
            first.setdefault(n.name, clean(n.text("")))
        elif n.name == "p" and len(paragraphs) < 3:
            paragraphs.append(n.text(""))
    return {"title": first.get("title"), "h1": first.get("h1"), "content_sample": " ".join(paragraphs)[:size]}


def heading_texts(html: str | None, most: int = 6) -> list[str]:
    """Texts of the first headings of levels 1 to 3, empty ones left out, then the document's title."""
    root, found = parse(html), []
    container = _header_container(root)
    if container is not None:
        found = [n for n in container.walk() if n.name in ("h1", "h2", "h3")][:most]
    found += [n for n in root.walk() if n.name == "title"][:1]
    return [t for n in found if (t := clean(n.text()))]


def _header_container(root: Node) -> Node | None:
    divs = [n for n in root.walk() if n.name == "div"]
    tests = (lambda n: n.attributes.get("id") == "content", lambda n: "article" in n.classes())
    return next((n for test in tests for n in divs if test(n)), next((n for n in root.walk() if n.name == "body"), None))


#: Preferred spellings of header labels, and all labels that make a paragraph a header.
FIELD_NAMES = {"first published": "First Published", "first_published": "First Published", "firstpub": "First Published", "published": "Published", "written": "Written", "date": "Date", "delivered": "Delivered", "source": "Source", "translated": "Translated", "translation": "Translation", "transcription": "Transcription"}
HEADER_KEYS = frozenset(("written", "source", "first published", "published", "translated", "translation", "editor", "edition", "transcription", "transcription/html markup", "transcription/markup", "transcription/mark-up", "markup", "mark-up", "public domain", "copyleft", "copyright", "notes", "date", "delivered"))
_KEY_VALUE = re.compile(r"^([A-Za-z][A-Za-z /\\-]{2,40}):\s*(.+)$")


def _value_after(parent: Node, label: Node) -> str:
    parts, on = [], False
    for c in parent.children:
        if c is label:
            on = True
        elif on and isinstance(c, Node):
            if c.name == "br" or c.name == "span" and "info" in c.classes():
                break
            parts.append(c.text())
        elif on:
            parts.append(c)
    return clean("".join(parts)).lstrip(" :")


def header_fields(html: str | None) -> dict[str, str]:
    """Label -> value of a page's header paragraphs; the first value of a label wins."""
    root = parse(html)
    container = _header_container(root)
    out: dict[str, str] = {}
    for p in (n for n in (container.walk() if container is not None else ()) if n.name == "p"):
        parents = {id(c): n for n in [p, *p.walk()] for c in n.children if isinstance(c, Node)}
        spans = [n for n in p.walk() if n.name == "span" and "info" in n.classes()]
        text = clean(p.text())
        labelled = any(clean(s.text()).rstrip(":").lower() in HEADER_KEYS for s in spans[:6]) or text.lower().startswith(tuple(f"{k}:" for k in HEADER_KEYS))
        if "information" not in p.classes() and not labelled:
            continue
        pairs = [(clean(s.text()).rstrip(":"), _value_after(parents[id(s)], s)) for s in spans]
        if not spans and (m := _KEY_VALUE.match(text)):
            pairs = [(m[1].strip(), m[2].strip())]
        own: dict[str, str] = {}
        for key, value in pairs:
            if not key or not value or re.fullmatch(r"\d+\.?", key):
                continue
            name = FIELD_NAMES.get(key.lower(), key)
            own["Transcription" if spans and name.lower().startswith("transcription") else name] = value
        for k, v in own.items():
            out.setdefault(k, v)
    return out
