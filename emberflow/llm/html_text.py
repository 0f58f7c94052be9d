"""Main text of web pages by composite text density (operator 8).

A page becomes a tree of elements (void elements, implied end tags and raw text
as in HTML). Menus, headers and footers of the page, sidebars, notices,
adverts, forms, scripts, styles, hidden parts and reader comments are left out
by element, role and the words of class and id (within an article by whole
names, and of blocks only). If that leaves no article or main element, the
outermost elements left out by name or as forms that hold one are taken back,
and so on inwards; on pages without one, those with most of the text. For every other element with C
characters, T tags, LC characters and LT tags of links (0 counts as 1, b: body):

    density = C / T * log(C / LC * T / LT) / log(ln(C / (C - LC) * LC + LCb / Cb * C + e))

The element whose children's densities have the largest sum is found, and the
smallest density on its path to the body is the threshold. Every element that
reaches the threshold has the element with the largest sum below it selected;
a selection inside an article or main element is widened to that. Blocks are
the runs of text between block-level tags and line breaks.

Defined cases: null or empty html, and pages without text, give an empty text;
unclosed and stray tags are accepted, an unclosed comment or script reaches to
the end; rows are pages, equal ones included; further columns stay as they are;
one called __text gets ``_in`` behind its name; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")

# Element names of HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title noscript template iframe noembed noframes xmp svg math".split())
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody
td tfoot th thead tr ul""".split())
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
           "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "option": ("option",)}
_SCOPE = frozenset("html body table td th caption button object ul ol dl select".split())
_OUT = frozenset("head nav footer aside form button select input label dialog menu search script style object".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
# Words of class and id by which templates name what is not the article.
_OUT_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs comment comments commentlist
consent cookie cookies disqus disclaimer footer gdpr login menu modal nav navbar navigation newsletter notice notices notification notifications
pager pagination popup promo promotion promoted recommended related respond replies reply share sharing sidebar sidebars signup skip skyscraper
social sponsor sponsored sponsors subscribe subscription toc toolbar tracking widget widgets""".split())
_HEAD_WORDS = frozenset("header masthead topbar".split())
_ARTICLE = frozenset(("article", "main"))


def _left_out(tag: str, raw: str, in_article: bool) -> int:
    """0: stays, 1: out by name or as a form, unless the main text is in it, 2: out."""
    if tag in _OUT and tag != "form" or tag == "header" and not in_article:
        return 2
    by_name = int(tag == "form")
    if not raw or raw.isspace():
        return by_name
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return 2
        if name == "role" and value in _OUT_ROLES or name == "style" and "display:none" in value.replace(" ", ""):
            return 2
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            words = set(value.split() if in_article else re.split(r"[^a-z0-9]+", value))
            if words & _OUT_WORDS and (tag in _BLOCK or not in_article) or words & _HEAD_WORDS and not in_article:
                by_name = 1
    return by_name


class _Page:
    """Elements in page order (parents before children) and what follows what."""

    def __init__(self, source: str):
        self.tags, self.parents, self.left, self.article = ["#page"], [0], [0], [-1]
        self.events: list[tuple[int, str | None]] = []  # (element, text), or (element, None) for a block edge
        stack, at = [0], 0

        def close(names: tuple[str, ...]) -> None:
            for depth in range(len(stack) - 1, 0, -1):
                tag = self.tags[stack[depth]]
                if tag in names:
                    self.events.append((stack[depth], None))
                    del stack[depth:]
                    return
                if tag in _SCOPE:
                    return

        while at < len(source):
            found = _TOKEN.search(source, at)
            end = found.start() if found else len(source)
            if end > at:
                self.events.append((stack[-1], html.unescape(source[at:end])))
            if not found:
                break
            at = found.end()
            tag = (found[2] or found[5] or "").lower()
            if not tag:
                continue
            if found[1] or found[4]:  # an end tag
                for depth in range(len(stack) - 1, 0, -1):
                    if self.tags[stack[depth]] == tag:
                        if tag in _BLOCK:
                            self.events.append((stack[depth], None))
                        del stack[depth:]
                        break
                continue
            if tag in _BLOCK:
                close(("p",))
            if tag in _CLOSES:
                for name in _CLOSES[tag]:
                    close((name,))
            raw = found[3] or found[6] or ""
            if tag in _RAW:
                last = re.compile(f"</{re.escape(tag)}[^>]*>", re.I).search(source, at)
                at = last.end() if last else len(source)
                continue
            above = stack[-1]
            node = len(self.tags)
            self.tags.append(tag)
            self.parents.append(above)
            self.left.append(2 if self.left[above] == 2 else _left_out(tag, raw, self.article[above] >= 0))
            self.article.append(node if tag in _ARTICLE and self.article[above] < 0 else self.article[above])
            if tag in _BLOCK or tag == "br":
                self.events.append((node, None))
            if tag not in _VOID and not raw.endswith("/"):
                stack.append(node)
        self.out = self._outs()

    def _outs(self) -> list[bool]:
        """Whether each element is left out, when those around the main text are taken back."""
        n = len(self.tags)
        articles, chars = [0] * n, [0] * n
        for node, text in self.events:
            if text and self.left[node] < 2:
                chars[node] += len(_SPACE.sub(" ", text).strip())
        for i in range(n - 1, 0, -1):
            articles[i] += self.tags[i] in _ARTICLE and self.left[i] < 2
            articles[self.parents[i]] += articles[i]
            chars[self.parents[i]] += chars[i]
        while True:
            out = [False] * n
            for i in range(1, n):
                out[i] = out[self.parents[i]] or self.left[i] > 0
            if any(self.tags[i] in _ARTICLE and not out[i] for i in range(n)):
                return out
            back = [i for i in range(1, n) if self.left[i] == 1 and not out[self.parents[i]]
                    and (articles[i] if articles[0] else 2 * chars[i] > chars[0])]
            if not back:
                return out
            for i in back:
                self.left[i] = 0

    def selected(self) -> list[bool]:
        """Whether each element is within the selected subtrees."""
        n = len(self.tags)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        for node, text in self.events:
            if text and not self.out[node]:
                chars[node] += len(_SPACE.sub(" ", text).strip())
        for i in range(n - 1, 0, -1):
            if self.out[i]:
                continue
            if self.tags[i] == "a":
                link_chars[i], link_tags[i] = chars[i], link_tags[i] + 1
            up = self.parents[i]
            chars[up] += chars[i]
            tags[up] += tags[i] + 1
            link_chars[up] += link_chars[i]
            link_tags[up] += link_tags[i]
        body = next((i for i in range(n) if self.tags[i] == "body" and not self.out[i]), 0)
        ratio = link_chars[body] / max(chars[body], 1)
        density = [0.0] * n
        for i in range(n):
            c, lc = chars[i], link_chars[i]
            if c and not self.out[i]:
                inside = c / max(lc, 1) * max(tags[i], 1) / max(link_tags[i], 1)
                base = math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)
                density[i] = c / max(tags[i], 1) * math.log(max(inside, 1.0)) / max(math.log(base + 1e-9), 1e-6) if inside > 1 else 0.0
        sums = [0.0] * n
        for i in range(1, n):
            sums[self.parents[i]] += density[i]
        best = list(range(n))  # the element with the largest sum in each subtree, the first of equals
        for i in range(n - 1, 0, -1):
            up = self.parents[i]
            if not self.out[i] and (sums[best[i]], -best[i]) > (sums[best[up]], -best[up]):
                best[up] = best[i]
        top = best[body]
        threshold, i = density[top], top
        while i not in (body, 0):
            i = self.parents[i]
            threshold = min(threshold, density[i])
        inside = [False] * n
        for i in range(n):
            if chars[i] and not self.out[i] and density[i] >= threshold:
                pick = best[i]
                if not sums[pick]:
                    pick = i  # text without elements of its own
                inside[self.article[pick] if self.article[pick] >= 0 else pick] = True
        for i in range(1, n):
            inside[i] = inside[i] or inside[self.parents[i]]
        return inside

    def text(self) -> str:
        inside = self.selected()
        blocks, parts = [], []
        for node, text in self.events:
            if text is not None:
                if inside[node] and not self.out[node]:
                    parts.append(text)
            elif parts:
                blocks.append(_SPACE.sub(" ", "".join(parts)).strip())
                parts = []
        blocks.append(_SPACE.sub(" ", "".join(parts)).strip())
        return "\n".join(b for b in blocks if b)


def main_text(source: str | None) -> str:
    """The main text of one page."""
    return _Page(source).text() if source else ""


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` with the main text of ``column`` as __text."""
    return common.shielded(pages, (column,), ("__text",), lambda p: _extract(p, column))


def _extract(pages: DataFrame, column: str) -> DataFrame:
    columns = pages.columns
    at = columns.index(column)

    def emit(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([main_text(h.as_py()) for h in batch.column(at)], pa.string())], names=[*columns, "__text"])

    return pages.mapInArrow(emit, pages.withColumn("__text", F.lit("").cast("string")).schema)
