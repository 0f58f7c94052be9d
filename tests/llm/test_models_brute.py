"""HTML extraction and the quality classifier against plain-Python versions."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("public_tokenizers")

from emberflow.llm import html_text, quality  # noqa: E402


# -- composite text density ---------------------------------------------------------------------
class Node:
    def __init__(self, tag, parts):
        self.tag, self.parts = tag, parts  # a part is a Node or text

    def nodes(self):
        """The node and all below it, parents first."""
        return [self] + [n for p in self.parts if isinstance(p, Node) for n in p.nodes()]

    def source(self):
        inner = "".join(p.source() if isinstance(p, Node) else p for p in self.parts)
        return inner if self.tag == "#page" else f"<{self.tag}>{inner}</{self.tag}>"


def chars(node):
    return sum(chars(p) if isinstance(p, Node) else len(" ".join(p.split())) for p in node.parts)


def link_chars(node):
    return chars(node) if node.tag == "a" else sum(link_chars(p) for p in node.parts if isinstance(p, Node))


def density(node, body):
    c, t = chars(node), max(len(node.nodes()) - 1, 1)
    lc, lt = link_chars(node), max(sum(n.tag == "a" for n in node.nodes()), 1)
    ratio = c / max(lc, 1) * t / lt
    if not c or ratio <= 1:
        return 0.0
    base = math.log(c / max(c - lc, 1) * lc + link_chars(body) / max(chars(body), 1) * c + math.e)
    return c / t * math.log(ratio) / max(math.log(base + 1e-9), 1e-6)


def density_text(page):
    order = page.nodes()
    body = next(n for n in order if n.tag == "body")
    value = {n: density(n, body) for n in order}
    total = {n: sum(value[p] for p in n.parts if isinstance(p, Node)) for n in order}

    def best(node):
        return max(node.nodes(), key=lambda n: total[n])  # the first of equals

    path = [n for n in order if best(body) in n.nodes() and n in body.nodes()]
    threshold = min(value[n] for n in path)
    picked = {best(n) if total[best(n)] else n for n in order if chars(n) and value[n] >= threshold}
    out = [""]

    def walk(node, inside):
        inside = inside or node in picked
        block = node.tag in ("div", "section", "body", "html", "li", "ul")
        if block:
            out.append("")
        for p in node.parts:
            if isinstance(p, Node):
                walk(p, inside)
            elif inside:
                out[-1] += p
        if block:
            out.append("")

    walk(page, False)
    return "\n".join(" ".join(b.split()) for b in out if b.strip())


def random_page(rng):
    def text(most):
        return " ".join(rng.choice(["one", "seven", "hundred", "of", "a"]) for _ in range(rng.randint(1, most))) + " "

    def grow(depth):
        parts = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.random()
            if kind < 0.35 or depth == 0:
                parts.append(text(rng.choice([3, 10, 60])))
            elif kind < 0.55:
                parts.append(Node("a", [text(4)]))
            elif kind < 0.65:
                parts.append(Node("span", [text(8)]))
            else:
                parts.append(Node(rng.choice(["div", "section"]), grow(depth - 1)))
        return parts

    return Node("#page", [Node("html", [Node("body", [Node("div", grow(rng.randint(1, 4))) for _ in range(rng.randint(1, 5))])])])


def test_density_decides_on_pages_without_article(spark):
    rng = random.Random(41)
    pages = [random_page(rng) for _ in range(400)]
    expected = [density_text(p) for p in pages]
    whole = [" ".join(html_text._SPACE.sub(" ", "".join(t for _, t in html_text._Page(p.source()).events if t)).split()) for p in pages]
    assert sum(e.replace("\n", " ") != w for e, w in zip(expected, whole)) > 20  # not everything is taken
    rows = spark.createDataFrame([(i, p.source()) for i, p in enumerate(pages)], "page_id long, html string").repartition(4)
    got = {r["page_id"]: r["__text"] for r in html_text.extract(rows).collect()}
    wrong = [i for i, e in enumerate(expected) if got[i] != e]
    assert not wrong, (wrong[:5], pages[wrong[0]].source(), got[wrong[0]], expected[wrong[0]])


def test_density_prefers_text_to_lists_of_links():
    links = "".join(f"<li><a href='/{i}'>Entry number {i}</a></li>" for i in range(30))
    story = "".join(f"<div>Sentence {i} of a story that goes on for a while, with words and more words.</div>" for i in range(8))
    page = f"<html><body><div><ul>{links}</ul></div><div><div>{story}</div></div></body></html>"
    text = html_text.main_text(page)
    assert "Sentence 0" in text and "Sentence 7" in text and "Entry" not in text


# -- naive Bayes support vectors ----------------------------------------------------------------
def grams(text):
    """Slots of the one- and two-byte indicators."""
    b = (text or "").encode()
    return set(b) | {256 + (x << 8 | y) for x, y in zip(b, b[1:])}


def test_ratios_equal_counts_over_all_training_rows(spark):
    rng = random.Random(5)
    docs = [(i, "".join(rng.choice("abcdé ") for _ in range(rng.choice([0, 1, 9, 200]))) if i % 11 else None) for i in range(150)]
    labels = [(i, rng.randint(0, 1)) for i in range(0, 150, 2)] + [(900, 1), (None, 1), (4, 1)]
    model = quality.train(spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
                          spark.createDataFrame(labels, "doc_id long, quality int"))
    known = {}
    for i, label in labels:
        if i is not None and i < 150 and zlib.crc32(str(i).encode()) % 3 != 1:
            known[i] = max(label, known.get(i, 0))
    sizes = [sum(v == c for v in known.values()) for c in (0, 1)]
    texts = dict(docs)
    for slot in [*range(256), *(256 + (x << 8 | y) for x in b"abcd " for y in b"abcd ")]:
        low, high = ((sum(slot in grams(texts[i]) for i, v in known.items() if v == c) + 1) / (sizes[c] + 2) for c in (0, 1))
        assert model.ratios[slot] == pytest.approx(math.log(high / low), abs=1e-5)
    scores = [r["__score"] for r in quality.score(spark.createDataFrame(docs, "doc_id long, text string"), model).orderBy("doc_id").collect()]
    again = [r["__score"] for r in quality.score(spark.createDataFrame(docs[::-1], "doc_id long, text string"), model).orderBy(F.col("doc_id")).collect()]
    assert scores == pytest.approx(again) and all(0 <= s <= 1 for s in scores)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_descent_reaches_the_optimum(seed):
    rng = np.random.default_rng(seed)
    rows = [np.unique(rng.integers(0, 40, rng.integers(3, 12))).astype(np.int32) for _ in range(60)]
    labels = np.array([int(r[0] + rng.integers(-6, 7) > 4) for r in rows])
    ratios = np.zeros(quality.SLOTS, np.float32)
    ratios[:40] = rng.normal(size=40)
    w, bias = quality._hinge(rows, labels, ratios, cost=1.0, epochs=400)
    x = np.zeros((60, 41))
    for i, r in enumerate(rows):
        x[i, r] = ratios[r] / np.linalg.norm(ratios[r].astype(float))
    x[:, 40] = 1
    sign = np.where(labels > 0, 1.0, -1.0)
    cost = 60 / (2 * np.where(labels > 0, labels.sum(), (labels == 0).sum()))
    margins = sign * (x @ np.append(w[:40], bias))
    primal = (np.append(w[:40], bias) ** 2).sum() / 2 + (cost * np.maximum(1 - margins, 0)).sum()
    q = (sign[:, None] * x) @ (sign[:, None] * x).T
    alpha, step = np.zeros(60), 1 / np.linalg.eigvalsh(q)[-1]
    for _ in range(50000):  # the dual by projected gradients
        alpha = np.clip(alpha + step * (1 - q @ alpha), 0, cost)
    dual = alpha.sum() - alpha @ q @ alpha / 2
    assert not w[40:].any()
    assert dual <= primal + 1e-6 and primal == pytest.approx(dual, rel=2e-3)
