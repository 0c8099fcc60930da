"""HTML pages -> fields (SRC-6, FLT-10/11 inputs).

Page fields come from ``regexp_extract`` on the raw markup inside the JVM; the
selector fallbacks become ordered ``coalesce`` over alternative patterns. Cards
nest, which patterns can't follow: there a page's tags are a list of positions
and kinds, and an element ends where the depth of its name returns.
"""

from __future__ import annotations

import html as entities
import re
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def strip_tags(c: Column) -> Column:
    """Text of an HTML fragment: tags removed, whitespace collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), "\\s+", " "))


def first_match(html: Column, patterns) -> Column:
    """First non-empty capture among alternative patterns (selector fallbacks)."""
    return F.coalesce(*[F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in patterns])


def parse_pages(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Card fields of every page: language, title (h1, else <title>), first
    paragraph text, link count, ad block, footer text, size."""
    h = F.col(html_col)
    return pages.select(
        "page_id", "url",
        F.regexp_extract(h, '<html lang="([^"]*)"', 1).alias("lang"),
        first_match(h, ["(?s)<h1>(.*?)</h1>", "(?s)<title>(.*?)</title>"]).alias("title"),
        strip_tags(F.regexp_extract(h, "(?s)<article>.*?<p>(.*?)</p>", 1)).alias("first_paragraph"),
        F.size(F.regexp_extract_all(h, F.lit("<a href="), 0)).alias("n_links"),
        F.size(F.regexp_extract_all(h, F.lit("<p>"), 0)).alias("n_paragraphs"),
        h.contains('class="ad"').alias("has_ad"),
        strip_tags(F.regexp_extract(h, "(?s)<footer>(.*?)</footer>", 1)).alias("footer"),
        F.length(h).alias("n_chars"),
    )


#: class-name parts that mark a card's fields, first choice first; the first
#: element of the first choice that has a text gives the field
CARD_FIELDS = {"job_title": ["name", "title"], "salary_text": ["sal"], "company_name": ["com", "cname"], "city": ["area"]}

# fixed values: the elements that have no end tag
VOID_TAGS = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]

# fixed values: elements inside a line of text; others, and br, part words
INLINE_TAGS = ["a", "abbr", "b", "bdi", "bdo", "cite", "code", "em", "font", "i", "img", "kbd", "label", "mark", "q", "s", "small", "span",
               "strong", "sub", "sup", "time", "u", "wbr"]

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<![^>]*>", re.S)
_CLASS = re.compile(r"\bclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


class TagTree:
    """The tags of a page: where each begins and ends, its name and kind (1: it
    opens an element, -1: it closes one, 0: void, comment or declaration)."""

    def __init__(self, page: str):
        self.page = page
        self.tags = []  # (begin, end, name, kind, class)
        self.by_name: dict[str, list[int]] = {}
        for m in _TAG.finditer(page):
            name = (m[2] or "").lower()
            kind = 0 if not name or name in VOID_TAGS or (m[3] or "").endswith("/") else -1 if m[1] else 1
            css = _CLASS.search(m[3]) if kind == 1 else None
            if kind:
                self.by_name.setdefault(name, []).append(len(self.tags))
            self.tags.append((m.start(), m.end(), name, kind, (css[1] or css[2] or css[3] or "") if css else ""))
        # the depth of each name after each of its tags, and for each opening tag the
        # first later tag of the name at which the depth is back below it
        self.closes: dict[int, int] = {}
        for at in self.by_name.values():
            depth = list(accumulate(self.tags[i][3] for i in at))
            open_: list[tuple[int, int]] = []
            for i, d in zip(at, depth):
                while open_ and open_[-1][1] > d:
                    self.closes[open_.pop()[0]] = i
                if self.tags[i][3] == 1:
                    open_.append((i, d))

    def end(self, i: int, last: int) -> int:
        """The tag at which the element of tag ``i`` ends, ``last`` at most (an
        element that is never closed ends there)."""
        return min(self.closes.get(i, last), last)

    def opening(self, part: str, lo: int, hi: int) -> list[int]:
        """The opening tags from lo to hi whose class holds ``part``."""
        return [i for i in range(lo, hi) if part in self.tags[i][4]]

    def text(self, i: int, last: int) -> str:
        """The element's text: what stands between its tags, blanks collapsed."""
        stop, parts = self.end(i, last), []
        for a in range(i, stop):
            name = self.tags[a][2]
            parts.append("" if not name or name in INLINE_TAGS else " ")
            parts.append(self.page[self.tags[a][1]:self.tags[a + 1][0] if a + 1 < len(self.tags) else len(self.page)])
        return " ".join(entities.unescape("".join(parts)).split())


def page_cards(page: str, card_class: str) -> list[dict[str, str]]:
    """The fields of a page's cards in order. A card inside a card is part of it."""
    tree, out, at = TagTree(page), [], 0
    starts = tree.opening(card_class, 0, len(tree.tags))
    for n, i in enumerate(starts):
        if i < at:
            continue
        later = starts[n + 1] if n + 1 < len(starts) else len(tree.tags)
        at = tree.closes.get(i, later)  # an unclosed card ends where the next begins
        out.append({field: next((text for part in parts for j in tree.opening(part, i + 1, at) if (text := tree.text(j, at))), "")
                    for field, parts in CARD_FIELDS.items()})
    return out


def card_rows(pages: DataFrame, html_col: str = "html", card_class: str = "job-card") -> DataFrame:
    """SRC-6: a row per job card of a list page: the page's other columns,
    ``pos`` (from 0), title, salary text and numbers, company and area; a missing
    field is empty. A card is an element whose class holds ``card_class``. Null
    pages and pages without cards give no rows."""
    import pyarrow as pa

    from hirelens.functions.salary import with_salary
    from pyspark.sql.types import LongType, StringType, StructField, StructType
    rest = [f for f in pages.schema.fields if f.name != html_col]
    ordered = pages.select(*[f.name for f in rest], html_col)

    def cut(batches):
        for batch in batches:
            cards = [page_cards(h.as_py(), card_class) if h.is_valid else [] for h in batch.column(len(rest))]
            row = pa.array([i for i, c in enumerate(cards) for _ in c], pa.int64())
            flat = [c for page in cards for c in page]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).take(row) for i in range(len(rest))], pa.array([p for c in cards for p in range(len(c))], pa.int64()),
                 *[pa.array([c[f] for c in flat], pa.string()) for f in CARD_FIELDS]], names=[*[f.name for f in rest], "pos", *CARD_FIELDS])

    schema = StructType([*rest, StructField("pos", LongType()), *[StructField(f, StringType()) for f in CARD_FIELDS]])
    return with_salary(ordered.mapInArrow(cut, schema))
