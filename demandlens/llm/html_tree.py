"""Main text of web pages by a tree-structured graphical model.

Every block element and every text block of a page's DOM is a binary variable
(content or not) with a potential of its own features (tag, words of class, id
and role, size, link density, punctuation); every parent-child edge has a
potential by the kinds of its ends. One upward and one downward pass of
sum-product messages gives each block's marginal; blocks above one half are
the main text, in page order.

The weights maximise the conditional likelihood of labelled pages: a bounded
sample of the given pages that mark their article up by the standard's own
elements (article or main), and pages put together from the sample's words
with the usual names of menus, notices, adverts, comments and so on.

Results for odd input: null, empty and unparsable html give the empty text;
cut-off pages keep what is there; repeated rows stay.
"""

from __future__ import annotations

import math
import random

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandlens.llm.common import arrow_map
from demandlens.llm.dom import Node, parse

#: Pages sampled for training (expected), pages made up, passes and rates.
SAMPLE_PAGES, MADE_PAGES, PASSES, RATE, DECAY = 150, 300, 12, 0.3, 1e-4

#: Names that pages use for parts around the article; fixed values, English.
AROUND = {
    "menu": "menu nav navbar navigation topnav breadcrumb breadcrumbs toc pagination",
    "header": "header masthead topbar banner branding site-header page-header",
    "footer": "footer site-footer bottom copyright legal colophon page-footer",
    "sidebar": "sidebar side aside widget related recommended popular trending tags share social",
    "notice": "notice cookie consent gdpr alert message popup modal subscribe newsletter signup warning",
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner-ad commercial",
    "form": "form search login search-form contact-form newsletter-form",
    "comments": "comments comment reader-comments commentlist reply responses discussion disqus respond",
}
INSIDE = "content article post entry main story body text article-body post-content entry-content"


def _size(n: int) -> int:
    return min(12, int(math.log2(n + 1)))


def features(nodes: list[Node], k: int) -> list[str]:
    """Names of the active features of a node."""
    node = nodes[k]
    density = int(4 * node.link_chars / node.own_chars) if node.own_chars else 5
    if node.tag == "#text":
        up = nodes[node.parent]
        text = node.text
        marks = min(4, sum(text.count(c) for c in ".,;:!?"))
        return [
            "text", f"text in {up.tag}", f"size {_size(len(text))}", f"links {density}", f"marks {marks}",
            f"ends {text[-1] in '.!?'}", f"sign {text[0] in '©®«»|'}",
        ]
    out = [f"tag {node.tag}", f"block links {density}", f"block size {_size(node.own_chars)}", f"blocks {_size(node.blocks)}"]
    for w in node.names:
        out += [f"name {w}", f"stem {w[:5]}"]
    return out


def edges(nodes: list[Node], k: int) -> list[str]:
    """Names of the kinds of the edge to a node's parent."""
    up, node = nodes[nodes[k].parent], nodes[k]
    kind = "text" if node.tag == "#text" else "named" if node.names else "block"
    return [f"edge {kind}", f"edge {up.tag} {kind}", f"edge {up.tag} {node.tag}"]


def _logaddexp(a: float, b: float) -> float:
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


class TreeModel:
    """Weights by feature; an edge kind has one weight for two content ends
    and one for content below something else; other combinations weigh zero."""

    def __init__(self):
        self.w: dict[str, float] = {}

    def _scores(self, nodes: list[Node]):
        w = self.w.get
        own = [sum(w(f, 0.0) for f in features(nodes, k)) for k in range(len(nodes))]
        both, below = [0.0], [0.0]
        for k in range(1, len(nodes)):
            names = edges(nodes, k)
            both.append(sum(w(e + " 11", 0.0) for e in names))
            below.append(sum(w(e + " 01", 0.0) for e in names))
        return own, both, below

    def marginals(self, nodes: list[Node]) -> tuple[list[float], list[tuple[float, float]]]:
        """P(content) of each node, and for each edge to a parent P(both ends
        content) and P(only the child is content). Messages are log ratios."""
        own, both, below = self._scores(nodes)
        n = len(nodes)
        # up[k]: log ratio of the subtree below k, k's own potential included;
        # sent[k]: what k tells its parent
        up, sent = own[:], [0.0] * n
        for k in range(n - 1, 0, -1):
            sent[k] = _logaddexp(0.0, up[k] + both[k]) - _logaddexp(0.0, up[k] + below[k])
            up[nodes[k].parent] += sent[k]
        belief, pair = up[:], [(0.0, 0.0)] * n
        for k in range(1, n):
            p = nodes[k].parent
            rest = belief[p] - sent[k]  # the parent without this child
            a = rest + both[k] + up[k]  # both content
            b = below[k] + up[k]  # only the child
            c = rest  # only the parent
            top = max(a, b, c, 0.0)
            ea, eb, ec, e0 = (math.exp(x - top) for x in (a, b, c, 0.0))
            total = ea + eb + ec + e0
            pair[k] = (ea / total, eb / total)
            belief[k] = up[k] + _logaddexp(0.0, rest + both[k]) - _logaddexp(0.0, rest)
            if below[k]:
                belief[k] = math.log(max(ea + eb, 1e-300)) - math.log(max(ec + e0, 1e-300))
        return [1 / (1 + math.exp(-max(-500.0, min(500.0, x)))) for x in belief], pair

    def fit(self, pages: list[tuple[list[Node], list[int]]], passes: int = PASSES, seed: int = 3) -> None:
        """Stochastic gradient with per-weight rates on (nodes, labels)."""
        rng, seen = random.Random(seed), {}
        for _ in range(passes):
            rng.shuffle(pages)
            for nodes, labels in pages:
                got, pair = self.marginals(nodes)
                step: dict[str, float] = {}
                for k, (p, y) in enumerate(zip(got, labels)):
                    for f in features(nodes, k):
                        step[f] = step.get(f, 0.0) + y - p
                    if k:
                        above = labels[nodes[k].parent]
                        for e in edges(nodes, k):
                            step[e + " 11"] = step.get(e + " 11", 0.0) + y * above - pair[k][0]
                            step[e + " 01"] = step.get(e + " 01", 0.0) + y * (1 - above) - pair[k][1]
                for f, g in step.items():
                    g -= DECAY * self.w.get(f, 0.0)
                    seen[f] = seen.get(f, 1e-8) + g * g
                    self.w[f] = self.w.get(f, 0.0) + RATE * g / math.sqrt(seen[f])

    def main_text(self, page: str) -> str:
        nodes = parse(page)
        content, _ = self.marginals(nodes)
        return "\n".join(n.text for n, p in zip(nodes, content) if n.tag == "#text" and p > 0.5)


_OUTSIDE = {"nav", "footer", "aside", "form", "header", "button"}
_NAMED_OUTSIDE = {w for names in AROUND.values() for w in names.replace("-", " ").split()} - {"article", "page", "side", "top", "site", "bottom", "text"}


def semantic_labels(nodes: list[Node]) -> list[int] | None:
    """Labels of a page that marks its article up; None if it does not."""
    if not any(n.tag in ("article", "main") for n in nodes):
        return None
    labels: list[int] = []
    for n in nodes:
        inside = labels[n.parent] if n.parent >= 0 else 0
        if n.tag in ("article", "main"):
            inside = 1
        elif n.tag in _OUTSIDE or _NAMED_OUTSIDE.intersection(n.names):
            inside = 0
        labels.append(int(inside))
    return labels


def made_page(rng: random.Random, lines: list[str]) -> tuple[str, set[str]]:
    """A page put together, and its text blocks that are content (marked by a
    serial word at their end, which is taken off again)."""
    line = lambda: rng.choice(lines)
    word = lambda: rng.choice(line().split() or ["x"])
    content: list[str] = []

    def named(tags: str, names: str) -> tuple[str, str]:
        tag, name = rng.choice(tags.split()), rng.choice(names.split())
        attribute = rng.choice(["class", "class", "id"])
        return f'<{tag} {attribute}="{name}">', f"</{tag}>"

    def links(n: int) -> str:
        items = "".join(f'<li><a href="/{i}">{word()}</a></li>' for i in range(n))
        return f"<ul>{items}</ul>" if rng.random() < 0.7 else items.replace("li>", "span> ")

    def around(kind: str) -> str:
        standard = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}
        a, b = named("div section", AROUND[kind])
        if kind in standard and rng.random() < 0.5:
            a, b = f"<{standard[kind]}>", f"</{standard[kind]}>"
        if kind == "menu":
            body = links(rng.randint(2, 8))
        elif kind == "form":
            body = f"<label>{word()}</label><input name=q><button>{word()}</button>"
        elif kind == "comments":
            body = "".join(f'<div class="comment"><p>{line()}</p></div>' if rng.random() < 0.6 else f"<p>{line()}</p>" for _ in range(rng.randint(1, 4)))
        elif kind == "footer":
            body = f"&copy; {word()} &middot; {line()}"
        elif kind == "sidebar":
            body = f"<h3>{word()}</h3>" + rng.choice([links(3), f"<p>{line()}</p>"])
        else:
            body = rng.choice([line(), f"<p>{line()}</p>", f'<a href="/x">{line()}</a>', word()])
        return f"{a}{body}{b}"

    def block(tag: str) -> str:
        text = line() if rng.random() < 0.85 else word()
        content.append(text)
        return f"<{tag}>{text}</{tag}>"

    body: list[str] = [block("h1")] if rng.random() < 0.8 else []
    for _ in range(rng.randint(1, 9)):
        body.append(block(rng.choice("p p p p p p h2 h3 blockquote li pre".split())))
        if rng.random() < 0.08:
            body.append(around(rng.choice(["advert", "notice", "sidebar", "form"])))
    if rng.random() < 0.2:
        body.append(around("comments"))
    if rng.random() < 0.6:
        a, b = rng.choice([("<article>", "</article>"), ("<main>", "</main>"), ("<article>", "</article>")])
    else:
        a, b = named("div section", INSIDE)
    before = [around(k) for k in ("header", "menu", "advert", "notice", "form") if rng.random() < 0.5]
    after = [around(k) for k in ("comments", "sidebar", "advert", "notice", "footer") if rng.random() < 0.5]
    page = "".join(["<html><body>", *before, a, *body, b, *after, "</body></html>"])
    return page, set(content)


def training_pages(pages: list[str], made: int = MADE_PAGES, seed: int = 9):
    """Labelled pages: the given ones that can be labelled, and made-up ones."""
    rng = random.Random(seed)
    out, lines = [], []
    for page in pages:
        nodes = parse(page)
        labels = semantic_labels(nodes)
        lines += [n.text.replace("<", " ").replace("&", " ") for n in nodes if n.tag == "#text"]
        if labels:
            out.append((nodes, labels))
    lines = [x for x in lines if x.strip()] or ["The quick brown fox jumps over the lazy dog.", "One more line, here.", "More"]
    for _ in range(made):
        page, _ = made_page(rng, lines)
        nodes = parse(page)
        out.append((nodes, _made_labels(nodes)))
    return out


def _made_labels(nodes: list[Node]) -> list[int]:
    """Of a made-up page: the article's container and what is in it, without
    parts that are named as something around it."""
    inside_names = set(INSIDE.replace("-", " ").split())
    labels: list[int] = []
    for n in nodes:
        label = labels[n.parent] if n.parent >= 0 else 0
        if n.tag in _OUTSIDE or _NAMED_OUTSIDE.intersection(n.names):
            label = 0
        elif n.tag in ("article", "main") or (n.names and inside_names.issuperset(n.names)):
            label = 1
        labels.append(label)
    return labels


def train(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> TreeModel:
    """A model from (page_id, html) rows; about ``sample_pages`` whole pages
    are drawn at random with a fixed seed."""
    drawn = pages.filter(F.rand(seed=7) < sample_pages / max(1, pages.count())).select("html")
    model = TreeModel()
    model.fit(training_pages(sorted(r[0] for r in drawn.toLocalIterator())))
    return model


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    source = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    model = source.sparkSession.sparkContext.broadcast(train(source))  # some 1,000 weights

    def run(batches):
        for batch in batches:
            texts = [model.value.main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return arrow_map(source, run, "page_id long, url string, text string, n_chars long")
