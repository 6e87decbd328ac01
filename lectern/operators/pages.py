"""HTML pages: elements, clean text, metadata, validity and structure.

The element walk needs a parser, so it runs in Arrow batches of pages; every test on its result is an expression.
The parser is the standard library's: void tags close at once, script and style are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ELEMENTS = ("p", "div", "section", "span", "h1", "h2", "h3", "li", "td")
ELEMENT = ["page_id", "pos", "tag", "class", "text"]
#: Characters and rows of elements that leave a worker at once.
TOLD, ROWS = 1 << 20, 5_000
VOID = frozenset(("br", "hr", "img", "input", "link", "meta", "area", "base", "col", "embed", "source", "track", "wbr"))
#: Classes and tags whose elements hold no speech.
SKIP_CLASSES = ("navigation", "menu", "footer", "header", "sidebar", "nav")
SKIP_TAGS = ("script", "style", "nav", "header", "footer")


class _Walk(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[list] = []
        self.done: list[tuple[int, str, str, str]] = []
        self.all: list[str] = []
        self.muted = 0
        self.count = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.muted += 1
        if tag in VOID:
            return
        self.stack.append([self.count, tag, dict(attrs).get("class") or "", []])
        self.count += 1

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.muted = max(0, self.muted - 1)
        if not any(e[1] == tag for e in self.stack):
            return
        while self.stack:
            number, name, classes, parts = self.stack.pop()
            self.done.append((number, name, classes, "".join(parts)))
            if self.stack:
                self.stack[-1][3].extend(parts)
            if name == tag:
                break

    def handle_data(self, data):
        if self.muted:
            return
        self.all.append(data)
        if self.stack and data.strip():
            self.stack[-1][3].append(data.strip())


def walk(html: str | None) -> tuple[list[tuple[int, str, str, str]], str]:
    """(number, tag, class, text) of the elements in document order, and all text."""
    w = _Walk()
    w.feed(html or "")
    w.close()
    while w.stack:
        w.handle_endtag(w.stack[-1][1])
    return sorted(e for e in w.done if e[1] in ELEMENTS), "".join(w.all)


def elements(pages: DataFrame) -> DataFrame:
    """page_id, pos, tag, class, text of every content element."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Nested elements repeat their texts, so a batch of pages is told a few pages at a time.
        for f in frames:
            rows, size = [], 0
            for p, h in zip(f["page_id"], f["html"]):
                told = walk(h)[0]
                rows += [(p, *e) for e in told]
                size += sum(len(e[3]) for e in told)
                if size >= TOLD or len(rows) >= ROWS:
                    yield pd.DataFrame(rows, columns=ELEMENT)
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=ELEMENT)

    return pages.select("page_id", "html").mapInPandas(run, "page_id long, pos int, tag string, class string, text string")


def content_elements(pages: DataFrame) -> DataFrame:
    """Elements long enough, not of a skipped class or tag, and not mostly punctuation."""
    e = elements(pages)
    marks = F.regexp_count("text", F.lit(r"[.,;:!?()\[\]{}\"'-]"))
    kept = (F.length("text") >= 10) & ~F.arrays_overlap(F.split("class", " "), F.array(*map(F.lit, SKIP_CLASSES))) & ~F.col("tag").isin(*SKIP_TAGS)
    return e.where(kept & (marks <= F.length("text") * 0.3))


def clean_text(html: str | None) -> str:
    """Text without markup: trimmed lines, split at double blanks, joined by one."""
    lines = (line.strip() for line in walk(html)[1].splitlines())
    return unescape(" ".join(part.strip() for line in lines for part in line.split("  ") if part.strip()))


def cleaned(pages: DataFrame) -> DataFrame:
    @F.pandas_udf("string")
    def clean(s: pd.Series) -> pd.Series:
        return s.map(clean_text)

    return pages.select("page_id", clean("html").alias("text"))
