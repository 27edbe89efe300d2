"""Rewrites tables that need a real parser into flat row fragments (runs inside Python tasks)."""

from __future__ import annotations

import re
from html import escape, unescape
from html.parser import HTMLParser

# Markup that every parser reads alike: text, tags with plain attributes, comments without dashes.
_BLANK = r"[ \t\n\r\f]"
_PIECE = re.compile(
    r"([^<]+)"
    rf"""|<([A-Za-z][A-Za-z0-9]*)((?:{_BLANK}+[A-Za-z][-A-Za-z0-9_:]*(?:="[^"<>]*"|='[^'<>]*'|=[^\s"'<>=/`]+(?=[ \t\n\r\f>]))?)*){_BLANK}*(/?)>"""
    rf"|</([A-Za-z][A-Za-z0-9]*){_BLANK}*>"
    r"|<!--(?![->])(?:[^-]|-(?!-))*-->"
)
_TEXT, _TAG, _ATTRIBUTES, _CLOSED, _ENDED = range(1, 6)  # its groups
_STARTS = {"table", "thead", "tbody", "tfoot", "tr", "td", "th", "a"}  # the tags that count
_NAMED = {"table", "td", "th", "a"}  # and those whose attributes do
_ATTRIBUTE = re.compile(r"""([A-Za-z][-A-Za-z0-9_:]*)(?:=(?:"([^"]*)"|'([^']*)'|([^\s"']+)))?""")
_RAW_END = {tag: re.compile(rf"(?i)([^<]*(?:<(?![!/])[^<]*)*)(?=</{tag}{_BLANK}*>)") for tag in ("script", "style")}
_RAW = {"textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "plaintext"}  # parsers differ here


def _attributes(text: str) -> list[tuple[str, str | None]]:
    found = []
    for name, *values in _ATTRIBUTE.findall(text):
        value = "".join(values)
        found.append((name.lower(), unescape(value) if value else None))
    return found

class _TableReader(HTMLParser):
    """Collects the rows below selected tables, each with all its descendant cells."""

    def __init__(self, kind: str):
        super().__init__(convert_charrefs=True)
        self.kind = kind
        self.open: list[dict] = []  # open tables, outermost first
        self.found = {"id": [], "list_table": [], "list": [], "tablebg": [], "any": []}

    def read(self, html: str) -> bool:
        """Read a page of plain markup, several times faster than ``feed``; false where there is other markup.

        Two texts never follow each other here, so every text is a node of its own.
        """
        at, end, piece, tables = 0, len(html), _PIECE.match, self.open
        while at < end:
            m = piece(html, at)
            if m is None:
                return False
            at, group = m.end(), m.lastindex
            if group == _TEXT:
                if tables:
                    self._add(unescape(m[_TEXT]) if "&" in m[_TEXT] else m[_TEXT])
            elif group == _CLOSED:
                tag = m[_TAG].lower()
                if tag in _RAW:
                    return False
                if tag in _STARTS and (tables or tag == "table"):
                    self._start(tag, dict(_attributes(m[_ATTRIBUTES])) if m[_ATTRIBUTES] and tag in _NAMED else {})
                if tag in _RAW_END:
                    raw = None if m[_CLOSED] else _RAW_END[tag].match(html, at)
                    if raw is None:
                        return False
                    if raw[1]:
                        self._add(raw[1])
                    at = raw.end()
            elif group == _ENDED and tables:
                tag = m[_ENDED].lower()
                if tag in _STARTS:
                    self._end(tag)
        return True

    def _add(self, data):
        for table in self.open:
            if table["cell"] is not None:
                table["cell"]["nodes"].append(data)
            elif table["row"] is not None:
                table["row"]["loose"].append(data)

    def handle_starttag(self, tag, attrs):
        if self.open or tag == "table":
            self._start(tag, dict(attrs))
        self._break_nodes()

    def _start(self, tag, attrs):
        if tag == "table":
            classes = (attrs.get("class") or "").split()
            kinds = [k for k in ("list_table", "list", "tablebg") if k in classes]
            if attrs.get("id") == "table":
                kinds.append("id")
            self.open.append(
                {"kinds": kinds, "section": "tbody", "row": None, "cell": None, "fresh": True}
            )
        elif tag in ("thead", "tbody", "tfoot"):
            self._close_row()
            self.open[-1]["section"] = tag
        elif tag == "tr":
            self._close_row()
            row = {"cells": [], "loose": []}
            self.open[-1]["row"] = row
            for kind, rows in self.found.items():
                if self._selects(kind):
                    rows.append(row)
        elif tag in ("td", "th"):
            self.open[-1]["cell"] = None
            if self.open[-1]["row"] is not None:
                cell = {"tag": tag, "cls": attrs.get("class") or "", "nodes": [], "link": None}
                self.open[-1]["cell"] = cell
                for table in self.open:
                    if table["row"] is not None:
                        table["row"]["cells"].append((cell, table is self.open[-1]))
        elif tag == "a":
            for table in self.open:
                cell = table["cell"]
                if cell is not None and cell["link"] is None:
                    cell["link"] = attrs.get("href") or ""

    def handle_endtag(self, tag):
        if self.open:
            self._end(tag)
        self._break_nodes()

    def _end(self, tag):
        if tag == "table":
            self._close_row()
            self.open.pop()
        elif tag in ("tr", "thead", "tbody", "tfoot"):
            self._close_row()
        elif tag in ("td", "th"):
            self.open[-1]["cell"] = None

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_data(self, data):
        for table in self.open:
            if table["cell"] is not None:
                nodes = table["cell"]["nodes"]
                if table["fresh"] or not nodes:
                    nodes.append(data)
                else:
                    nodes[-1] += data
                table["fresh"] = False
            elif table["row"] is not None:
                table["row"]["loose"].append(data)

    def handle_comment(self, data):
        self._break_nodes()

    def _break_nodes(self):
        for table in self.open:
            table["fresh"] = True

    def _selects(self, kind: str) -> bool:
        """Whether a row opened now lies below a table of this kind."""
        if kind == "any":
            return True
        for depth, table in enumerate(self.open):
            if kind in table["kinds"]:
                return kind != "list" or any(t["section"] == "tbody" for t in self.open[depth:])
        return False

    def _close_row(self):
        self.open[-1]["row"] = None
        self.open[-1]["cell"] = None

    def rows(self) -> list[dict]:
        if self.kind == "detail":
            return self.found["tablebg"]
        return self.found["id"] or self.found["list_table"] or self.found["list"]


def _read(html: str, kind: str) -> _TableReader:
    reader = _TableReader(kind)
    if not reader.read(html):
        reader = _TableReader(kind)
        reader.feed(html)
        reader.close()
    return reader


def last_number(html: str, cells: int) -> int | None:
    """The number in the first cell of the last row with so many cells whose first cell is a number."""
    for row in reversed(_read(html, "any").found["any"]):
        own = [cell for cell, _ in row["cells"] if cell["tag"] == "td"]
        if len(own) >= cells:
            text = "".join(own[0]["nodes"]).strip().rstrip(".")
            if text.isdecimal() and int(text) < 1 << 31:
                return int(text)
    return None


INNER_MARK = "data-inner"


def _fragment(row: dict) -> str:
    """One row as flat markup that the built-in expressions read exactly.

    Cells of nested tables follow as cells of their own, marked, because their text already
    belongs to the cell around them; they are captions of their own row only.
    """
    out = [escape("".join(row["loose"]), quote=False)]
    for cell, direct in row["cells"]:
        link = "" if cell["link"] is None else f'<a href="{escape(cell["link"])}"></a>'
        body = "<br>".join(escape(n, quote=False) for n in cell["nodes"])
        mark = f'class="{escape(cell["cls"])}"' if direct else INNER_MARK
        out.append(f'<{cell["tag"]} {mark}>{link}{body}</{cell["tag"]}>')
    return "".join(out).replace("&#x27;", "&#39;")


def flatten_tables(html: str, kind: str) -> list[str]:
    """Flat row fragments of the selected tables of one page."""
    return [_fragment(r) for r in _read(html, kind).rows()]
