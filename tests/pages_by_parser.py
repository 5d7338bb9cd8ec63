"""Pages to runs by the standard library's parser, event by event: what the column expressions are held against."""

from __future__ import annotations

import re
from html.parser import HTMLParser

from textpanel.functions.html import ALIGN, ENDS, INLINE, LINE, POINTS, SCOPE, SILENT, SIZE, SLANT, VOID, WEIGHT, WHITE

WEIGHT, SLANT, LINE, SIZE, ALIGN, WHITE = map(re.compile, (WEIGHT, SLANT, LINE, SIZE, ALIGN, WHITE))
SCOPE = frozenset(SCOPE)


class Runs(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, tuple]] = []
        self.runs: list[tuple] = []
        self.parts: list[str] = []
        self.length = 0
        self.apart = True
        self.silent = 0

    def style(self) -> tuple:
        return self.open[-1][1] if self.open else (False, False, False, None, None)

    def close_to(self, kinds: tuple[str, ...], within: frozenset[str]) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in kinds:
                del self.open[i:]
                return
            if self.open[i][0] in within:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SILENT:
            self.silent += 1
            return
        if tag not in INLINE:
            self.apart = True
            self.close_to(("p",), SCOPE)
            if tag in ENDS:
                self.close_to(ENDS[tag], SCOPE - set(ENDS[tag]))
        if tag in VOID:
            return
        bold, italic, underline, size, align = self.style()
        css = next((v for k, v in attrs if k == "style" and v), "")
        bold = bold or tag in ("b", "strong") or bool(WEIGHT.search(css))
        italic = italic or tag in ("i", "em") or bool(SLANT.search(css))
        underline = underline or tag == "u" or bool(LINE.search(css))
        if m := SIZE.search(css):
            size = round(float(m[1]) * POINTS[m[2].lower()], 1)
        if m := ALIGN.search(css):
            align = m[1].lower()
        self.open.append((tag, (bold, italic, underline, size, align)))

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
            return
        if tag not in INLINE:
            self.apart = True
        if any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data: str) -> None:
        if self.silent or not data:
            return
        text = WHITE.sub(" ", data).strip()
        if not text:
            self.apart = True
            return
        if self.parts and (self.apart or WHITE.match(data[0])):
            self.parts.append(" ")
            self.length += 1
        self.runs.append((text, *self.style(), self.length, self.length + len(text)))
        self.parts.append(text)
        self.length += len(text)
        self.apart = bool(WHITE.match(data[-1]))


def runs_of(html: str | None) -> tuple[str, list[tuple]]:
    p = Runs()
    p.feed(html or "")
    p.close()
    return "".join(p.parts), p.runs
