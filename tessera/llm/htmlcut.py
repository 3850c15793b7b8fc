"""Main text of web pages by minimum-cut labelling (operator 5).

A page is cut into text blocks. Each block has a cost: the log odds of being content, from a logistic classifier on the
block's words and links plus what its containers say (elements, class and id words). Costs are the capacities to the
two terminals; neighbours in page order and blocks of one parent are joined by edges whose capacity falls with
their distance in the element tree. The minimum cut (max-flow) separates content from boilerplate.

Blocks whose cost exceeds all their open edges are on their side in every minimum cut; they are settled first, and
the max-flow runs on what is left, usually nothing.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.quality import fit_logistic

#: Most pages that the block classifier is fitted on (taken by a hash of the id).
MOST_PAGES = 2_000
NEIGHBOUR, SIBLING, CONTAINER, FORBIDDEN = 1.2, 0.6, 1.6, 12.0
#: Container evidence counts up to ``SURE`` times ``CONTAINER``, little more than the classifier's 3, so edges can overrule it.
SURE, STRONG, LOWEST, HIDDEN = 2, 4, -4, -100

RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "head", "title"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "div", "dl",
         "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html",
         "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody",
         "td", "tfoot", "th", "thead", "tr", "ul"}
CLOSES_P = BLOCK - {"button", "option", "select", "caption", "legend"}
NEVER = {"nav", "footer", "aside", "button", "select", "menu", "dialog", "option"}
CONTENT = {"article", "main"}
# Words of class, id and role attributes that mark boilerplate and content.
BAD_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner",
             "sidebar", "menu", "navbar", "nav", "navigation", "breadcrumb", "breadcrumbs", "comment", "comments", "reply", "replies",
             "disqus", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "newsletter", "subscribe", "signup", "login",
             "share", "sharing", "social", "related", "recommended", "popup", "modal", "overlay", "footer", "masthead", "widget",
             "pagination", "pager", "copyright", "legal", "toolbar", "search", "complementary", "contentinfo"}
GOOD_WORDS = {"article", "content", "post", "entry", "story", "main", "body", "text"}
# Boilerplate whatever stands beside them; a wrapper word makes only the others mean nothing, a negating word both.
STRONG_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "sponsor", "sponsored", "comment", "comments", "reply", "replies",
                "disqus", "cookie", "cookies", "consent", "gdpr"}
WRAPPER_WORDS = {"layout", "wrapper", "container", "page", "site"}
NEGATING_WORDS = {"with", "has", "no", "without"}
TOPIC = ("category-", "tag-")  # class words that name what a page is about
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')|=)*+)(?:>|\Z)|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I | re.S)


def _word_evidence(value: str) -> int:
    """Good words less bad words of one attribute, strong ones ``STRONG`` times."""
    good, weak, strong = set(), set(), set()
    for name in re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower().split():
        words = set(re.split(r"[^a-z0-9]+", name))
        if name.startswith(TOPIC) or words & NEGATING_WORDS:
            continue
        good |= words & GOOD_WORDS
        strong |= words & STRONG_WORDS
        if not words & WRAPPER_WORDS:
            weak |= words & BAD_WORDS - STRONG_WORDS
    return len(good) - len(weak) - STRONG * len(strong)


def _is_slug(name: str) -> bool:
    """Whether the id of an article names what it is about: not only boilerplate words beside a number, as ``comment-12``."""
    words = re.split(r"[^a-z0-9]+", name.lower())
    return not any(map(str.isdigit, words)) or any(not w.isdigit() and w not in BAD_WORDS | {"div", ""} for w in words)


def _own_evidence(tag: str, attributes: str) -> int:
    """What one element says: > 0 content, < 0 boilerplate, ``HIDDEN`` for what is not shown."""
    words = 0
    if attributes and attributes.strip(" /"):
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                return HIDDEN
            if name == "style":
                if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value.lower()):
                    return HIDDEN
            elif name in ("class", "id", "role") and not (name == "id" and tag in CONTENT and _is_slug(value)):
                words += _word_evidence(value)
    if tag in ("body", "html", "main"):
        words = max(words, 0)
    words += SURE * (tag in CONTENT) - STRONG * (tag in NEVER) - (tag == "form")
    return min(max(words, LOWEST), SURE)


def _inside(outer: int, own: int) -> int:
    """Evidence in an element: its own, added to that around it where one of them is negative or both are positive.

    Boilerplate in content starts anew from its own evidence; content in boilerplate makes up for it as far as it goes.
    """
    if outer == HIDDEN or own == HIDDEN:
        return HIDDEN
    return min(max(own if own < 0 < outer else outer + own, LOWEST), SURE)


def blocks_of(page: str) -> list[tuple]:
    """Text blocks in page order: (text, tag, evidence, words in links, number of the parent element, steps in the tree
    from the block before). Time and memory are linear in the page however deep its elements are nested."""
    out: list[tuple] = []
    stack = [("html", 0, 0, "html", False)]  # tag, evidence, number, innermost block tag, inside content
    open_count, number = {"html": 1}, 0
    parts: list[str] = []
    linked, links, in_header = 0, 0, 0
    before, lowest = 1, 1  # depth of the last block, and the least depth since
    unended: set[str] = set()  # elements without an end tag in the rest of the page

    def flush():
        nonlocal parts, linked, before, lowest
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            _, evidence, _, block, in_content = stack[-1]
            if in_header and evidence >= 0 and not (block in ("h1", "h2") and in_content):
                evidence = -SURE
            out.append((text, block, evidence, linked, stack[-2][2] if len(stack) > 1 else -1, before + len(stack) - 2 * lowest))
            before = lowest = len(stack)
        parts, linked = [], 0

    def close(tag):
        nonlocal links, in_header, lowest
        while len(stack) > 1:
            top = stack.pop()
            open_count[top[0]] -= 1
            links -= top[0] == "a"
            in_header -= top[0] == "header"
            if top[0] == tag:
                break
        lowest = min(lowest, len(stack))

    at, end = 0, len(page)
    while at < end:
        m = TOKEN.match(page, at)
        at = m.end()
        tag = m.group(2)
        if tag is None:
            piece = m.group()
            if piece[0] != "<" or piece == "<":
                parts.append(piece)
                if links:
                    linked += len(piece.split())
            elif piece.startswith("<![CDATA["):
                parts.append(html.escape(piece[9:].removesuffix("]]>")))
            continue
        tag = tag.lower()
        if m.group(1):
            if tag in BLOCK:
                flush()
            if open_count.get(tag, 0):
                close(tag)
            continue
        if tag in RAW:
            if tag != "head" and not m.group(3).endswith("/"):
                stop = None if tag in unended else re.compile(rf"</{tag}\s*>", re.I).search(page, at)
                if not stop:
                    unended.add(tag)
                at = stop.end() if stop else end if tag in ("script", "style") else at
            elif tag == "head":
                stop = None if tag in unended else re.compile(r"</head\s*>|<body\b", re.I).search(page, at)
                if not stop:
                    unended.add(tag)
                at = (stop.end() if stop and stop.group()[1] == "/" else stop.start()) if stop else at
            continue
        if tag in BLOCK:
            flush()
            if tag in CLOSES_P and open_count.get("p", 0):
                close("p")
            if tag in ("li", "option", "dt", "dd", "tr", "td", "th") and stack[-1][0] == tag:
                close(tag)
        elif tag == "br":
            parts.append(" ")
        if tag in VOID or m.group(3).endswith("/"):
            continue
        number += 1
        _, evidence, _, block, in_content = stack[-1]
        stack.append((tag, _inside(evidence, _own_evidence(tag, m.group(3))), number, tag if tag in BLOCK else block,
                      in_content or tag in CONTENT))
        open_count[tag] = open_count.get(tag, 0) + 1
        links += tag == "a"
        in_header += tag == "header"
    flush()
    return out


def block_inputs(blocks: list[tuple]) -> np.ndarray:
    """Inputs of the block classifier: what the block's own text and links look like."""
    rows = np.empty((len(blocks), 9))
    for i, (text, tag, _, linked, *_) in enumerate(blocks):
        n = text.count(" ") + 1
        stops = sum(map(text.count, ".,;:?!"))
        rows[i] = (min(n, 60) / 20, min(linked / n, 1.0), min(stops / n, 1.0), float(text[-1] in ".!?:\"'”»"), min(len(text) / n, 20) / 10,
                   float(tag == "p"), float(tag[0] == "h" and tag[1:].isdigit()), float(tag in ("li", "td", "th")),
                   float("©" in text or "|" in text))
    return rows


#: Weights (the last one the constant) where a table gives no examples of both kinds.
PRIOR_WEIGHTS = np.array([1.5, -4.0, 1.0, 0.8, 0.0, 0.8, 0.5, -1.0, -1.0, -1.2])


def smoothness(blocks: list[tuple]) -> list[tuple[int, int, float]]:
    """Edges (i, j, capacity): next in page order, and next with the same parent element."""
    edges, last = [], {}
    for j, (*_, parent, apart) in enumerate(blocks):
        if j:
            edges.append((j - 1, j, NEIGHBOUR / (1 + apart)))
        if parent in last and last[parent] != j - 1:
            edges.append((last[parent], j, SIBLING))
        last[parent] = j
    return edges


def min_cut(cost: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Source side (content) of the minimum cut: cost > 0 is a capacity from the source, < 0 one to the sink."""
    n, cost = len(cost), list(cost)
    pull = [0.0] * n
    for i, j, c in edges:
        pull[i] += c
        pull[j] += c
    side: list[bool | None] = [v > 0 if abs(v) > p else None for v, p in zip(cost, pull)]  # the cost exceeds all edges
    near: dict[int, list] = {i: [] for i in range(n) if side[i] is None}
    for i, j, c in edges:
        for a, b in ((i, j), (j, i)):
            if side[a] is not None and side[b] is None:  # a settled end is a capacity to its terminal
                cost[b] += c if side[a] else -c
                pull[b] -= c
        if side[i] is None and side[j] is None:
            near[i].append((j, c))
            near[j].append((i, c))
    todo = deque(near)
    while todo:  # settle blocks whose cost exceeds their open edges
        i = todo.popleft()
        if side[i] is None and abs(cost[i]) > pull[i]:
            side[i] = cost[i] > 0
            for j, c in near[i]:
                if side[j] is None:
                    cost[j] += c if side[i] else -c
                    pull[j] -= c
                    todo.append(j)
    left = [i for i in range(n) if side[i] is None]
    if left:
        for i, content in zip(left, _max_flow(left, cost, near, side)):
            side[i] = content
    return [bool(s) for s in side]


def _max_flow(left: list[int], cost: list[float], near: dict[int, list], side: list) -> list[bool]:
    """Dinic's algorithm on the open blocks; True for those that the source still reaches."""
    at = {v: k for k, v in enumerate(left)}
    s, t = len(left), len(left) + 1
    to: list[int] = []
    cap: list[float] = []
    out: list[list[int]] = [[] for _ in range(len(left) + 2)]

    def add(a, b, c, back):
        out[a].append(len(to)), to.append(b), cap.append(c)
        out[b].append(len(to)), to.append(a), cap.append(back)

    for v in left:
        if cost[v] > 0:
            add(s, at[v], cost[v], 0.0)
        elif cost[v] < 0:
            add(at[v], t, -cost[v], 0.0)
        for w, c in near[v]:
            if side[w] is None and v < w:
                add(at[v], at[w], c, c)
    while True:
        level = [-1] * len(out)
        level[s], queue = 0, deque([s])
        while queue:
            v = queue.popleft()
            for e in out[v]:
                if cap[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return [level[k] >= 0 for k in range(len(left))]
        nxt, path, v = [0] * len(out), [], s
        while True:
            if v == t:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                first = next(k for k, e in enumerate(path) if cap[e] <= 1e-9)
                v = to[path[first] ^ 1]
                path = path[:first]
            while nxt[v] < len(out[v]):
                e = out[v][nxt[v]]
                if cap[e] > 1e-9 and level[to[e]] == level[v] + 1:
                    break
                nxt[v] += 1
            else:
                if v == s:
                    break
                e = path.pop()
                v = to[e ^ 1]
                nxt[v] += 1
                continue
            path.append(out[v][nxt[v]])
            v = to[path[-1]]


def main_text(page: str | None, weights: np.ndarray = PRIOR_WEIGHTS) -> str:
    """The content blocks of a page, one per line; null and empty pages and pages without content give an empty text."""
    blocks = blocks_of(page) if page else []
    if not blocks:
        return ""
    odds = np.clip(block_inputs(blocks) @ weights[:-1] + weights[-1], -3, 3)
    cost = [float(o) + CONTAINER * max(b[2], -SURE) if b[2] != HIDDEN else -FORBIDDEN for o, b in zip(odds, blocks)]
    return "\n".join(b[0] for b, keep in zip(blocks, min_cut(cost, smoothness(blocks))) if keep)


def fit_blocks(pages: DataFrame, id_col: str, html_col: str) -> np.ndarray:
    """Classifier weights from blocks whose containers leave no doubt, on at most ``MOST_PAGES`` pages."""
    def examples(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            found = [x for p in b.column("html").to_pylist() for x in blocks_of(p or "") if abs(x[2]) >= SURE]
            x = block_inputs(found)
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), pa.array([v[2] > 0 for v in found], pa.bool_())], ["x", "y"])

    ids = (pages.select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct()
           .orderBy(F.xxhash64("id"), "id").limit(MOST_PAGES).toPandas())
    chosen = F.broadcast(pages.sparkSession.createDataFrame(ids, pages.select(F.col(id_col).alias("id")).schema))
    sample = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html")).join(chosen, "id")
    sample = sample.groupBy("id").agg(F.min("html").alias("html")).select("html")  # one row per chosen page
    # equal inputs are summed before they come to the driver; the weights depend on the counts alone
    got = (sample.mapInArrow(examples, "x array<double>, y boolean").groupBy("x", "y").count().toPandas())
    if got.y.nunique() < 2:
        return PRIOR_WEIGHTS
    got = got.assign(k=[tuple(v) for v in got.x]).sort_values(["k", "y"])
    return fit_logistic(np.stack(got.x.to_numpy()), got.y.to_numpy(dtype=float), ridge=5.0, times=got["count"].to_numpy())


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points). One Arrow pass over the whole pages.

    Text in elements that a page hides (``hidden``, ``aria-hidden``, ``display: none``) is not shown, so it is no main text.
    The id of an article or main element names its subject unless it holds boilerplate words and a number only.
    Null and empty pages have an empty text. Repeated rows and null ids stay; other columns are ignored. A table whose pages
    show no examples of both kinds of blocks is read with ``PRIOR_WEIGHTS``.
    """
    weights = fit_blocks(pages, id_col, html_col)

    def run(batches):
        for b in batches:
            text = [main_text(p, weights) for p in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(text, pa.string()),
                                              pa.array([len(x) for x in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return src.mapInArrow(run, f"page_id {dict(src.dtypes)['id']}, url string, text string, n_chars long")
