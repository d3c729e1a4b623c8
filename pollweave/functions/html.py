"""Markup read with the standard library's parser, for what regular expressions cannot tell."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F

from pollweave.functions.semantics import col

_VOID = {"br", "img", "hr", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.off = 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style")

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.off:
            self.off -= 1

    def handle_data(self, data):
        if not self.off and data.strip():
            self.parts.append(data.strip())


def text_of(markup: str | None) -> str | None:
    """Text of a page with entities resolved, pieces joined by blanks; scripts and styles left out."""
    if markup is None:
        return None
    p = _Text()
    p.feed(markup)
    p.close()
    return " ".join(p.parts)


class _Box(HTMLParser):
    """Cells of the rows of an information box whose header is ``label``."""

    def __init__(self, label: str):
        super().__init__(convert_charrefs=True)
        self.label, self.stack, self.boxes = label, [], []
        self.head = self.cell = None

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        a = dict(attrs)
        opened = None
        if tag == "div" and "itemscope" in a:
            opened = {"best": "infotemplatebox" in (a.get("class") or "").split(), "values": []}
            self.boxes.append(opened)
        self.stack.append((tag, opened))
        if tag == "tr":
            self.head = ""
        elif tag in ("th", "td"):
            self.cell = []

    def handle_endtag(self, tag):
        while self.stack:
            top, _ = self.stack.pop()
            if top == tag:
                break
        if tag in ("th", "td") and self.cell is not None:
            text = " ".join(self.cell)
            self.cell = None
            if tag == "th":
                self.head = text
            elif self.head == self.label and text:
                box = next((b for _, b in reversed(self.stack) if b is not None), None)
                if box is not None:
                    box["values"].append(text)

    def handle_data(self, data):
        if self.cell is not None and data.strip():
            self.cell.append(data.strip())


def infobox_of(markup: str | None, label: str) -> str | None:
    """The cells of ``label`` in the page's information box, joined by ``；``; '' if there is none."""
    if markup is None:
        return None
    p = _Box(label)
    p.feed(markup)
    p.close()
    box = next((b for b in p.boxes if b["best"]), p.boxes[0] if p.boxes else None)
    return "；".join(box["values"]) if box else ""


def html_text_exact(markup: str | Column) -> Column:
    return F.udf(text_of, "string", useArrow=True)(col(markup))


def infobox(markup: str | Column, label: str) -> Column:
    return F.udf(lambda x: infobox_of(x, label), "string", useArrow=True)(col(markup))
