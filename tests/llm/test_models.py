"""Quality, toxicity and page extraction: held-out accuracy, brute force and edge cases; the pipeline end to end."""

import itertools
import random
import time
import zlib
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.htmlcut import PRIOR_WEIGHTS, block_inputs, blocks_of, extract_pages, main_text, min_cut
from tessera.llm.quality import INPUTS, fit_logistic, keep_good, quality_scores, site_posteriors, text_inputs
from tessera.llm.toxicity import label_model, toxicity_scores

SF = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def site():
    return {"host": F.col("source"), "path": F.concat_ws("/", "source", "lang")}


def test_quality_separates_held_out_labels(spark):
    docs, labels = table(spark, "documents"), table(spark, "labels")
    known = {r.doc_id: r.quality for r in labels.where("doc_id % 2 = 1").collect()}
    got = quality_scores(docs, labels.where("doc_id % 2 = 0"), **site())["scores"].collect()
    assert len(got) == docs.count()
    right = [(r.score >= 0.5) == (known[r.doc_id] == 1) for r in got if r.doc_id in known]
    assert np.mean(right) > 0.95


def test_site_posteriors_by_hand(spark):
    rng = np.random.default_rng(1)
    rows = [(i, i, f"h{i % 7}", f"h{i % 7}/{i % 3}", float(np.clip(rng.beta(2, 2) + 0.2 * (i % 7 == 0), 0.01, 0.99))) for i in range(300)]
    rows += [(300, None, None, None, 0.3), (301, 5, "lone", None, 0.9)]
    got = {r.node: r for r in site_posteriors(spark.createDataFrame(rows, "node long, id long, host string, path string, p double")).collect()}
    p = np.array([r[4] for r in rows])
    hosts, paths = [r[2] for r in rows], [(r[2], r[3]) for r in rows]
    base, n = p.mean(), len(p)

    def means(keys):
        return {k: p[[i for i, x in enumerate(keys) if x == k]] for k in set(keys)}

    hm, pm = means(hosts), means(paths)
    v = sum(((x - x.mean()) ** 2).sum() for x in hm.values()) / n
    tau = (sum(len(x) * (x.mean() - base) ** 2 for x in hm.values()) - (len(hm) - 1) * v) / max(n - sum(len(x) ** 2 for x in hm.values()) / n, 1)
    kh = min(max(v / max(tau, 1e-9), 1), 1e6)
    vp = sum(((x - x.mean()) ** 2).sum() for x in pm.values()) / n
    spread = sum(len(x) * (x.mean() - hm[k[0]].mean()) ** 2 for k, x in pm.items())
    tp = (spread - (len(pm) - len(hm)) * vp) / max(n - sum(len(x) ** 2 / len(hm[k[0]]) for k, x in pm.items()), 1)
    kp = min(max(vp / max(tp, 1e-9), 1), 1e6)
    for i, r in enumerate(rows):
        h, q = hm[r[2]], pm[r[2], r[3]]
        host = (h.sum() - p[i] + kh * base) / (len(h) - 1 + kh)
        path = (q.sum() - p[i] + kp * host) / (len(q) - 1 + kp)
        z = np.log(p[i] / (1 - p[i])) + np.log(path / (1 - path)) - np.log(base / (1 - base))
        assert abs(got[i].host_posterior - host) < 1e-6 and abs(got[i].path_posterior - path) < 1e-6
        assert abs(got[i].score - 1 / (1 + np.exp(-z))) < 1e-6


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, None, "en", 0), (2, "", "a", None, 0), (None, "words here", "a", "en", 0), (3, "x " * 40000, "a", "en", 0),
                                  (3, "x " * 40000, "a", "en", 0)], "doc_id long, text string, source string, lang string, node int")
    none = spark.createDataFrame([(None, 1, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    assert keep_good(docs, none, **site()).count() == 5
    assert keep_good(docs, none, **site()).columns == docs.columns
    assert quality_scores(docs.limit(0), table(spark, "labels"), **site())["scores"].count() == 0
    assert keep_good(docs, table(spark, "labels"), **site()).columns == docs.columns


def test_text_inputs_count_whole_texts():
    texts = [b"", b"a b a", b"AB!! %%\n1"]
    off = np.cumsum([0, *map(len, texts)])
    x = text_inputs(np.frombuffer(b"".join(texts), np.uint8), off)
    at = {n: i for i, n in enumerate(INPUTS)}
    assert x[0, at["is_empty"]] == 1 and x[1, at["distinct_share"]] == pytest.approx(2 / 3) and x[1, at["top_share"]] == pytest.approx(2 / 3)
    assert x[2, at["upper_share"]] == pytest.approx(2 / 9) and x[2, at["symbol_share"]] == pytest.approx(2 / 9) and x[2, at["digit_share"]] == pytest.approx(1 / 9)


def test_logistic_fit_finds_the_gradient_zero():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((500, 3))
    y = (rng.random(500) < 1 / (1 + np.exp(-(x @ [1, -2, 0] + 0.5)))).astype(float)
    x[:, 1] *= 50
    w = fit_logistic(x, y, ridge=1e-9)
    z = 1 / (1 + np.exp(-(x @ w[:3] + w[3])))
    assert np.abs(x.T @ (y - z)).max() < 1e-3 and abs((y - z).sum()) < 1e-3


def test_logistic_fit_with_counts_equals_repeated_rows():
    rng = np.random.default_rng(3)
    x, n = rng.standard_normal((200, 3)), rng.integers(1, 9, 200)
    y = (rng.random(200) < 0.4).astype(float)
    assert np.abs(fit_logistic(x, y, ridge=5.0, times=n) - fit_logistic(np.repeat(x, n, axis=0), np.repeat(y, n), ridge=5.0)).max() < 1e-9


def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = {r.doc_id: r for r in toxicity_scores(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(r.toxic, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    hit = sum(t and g.predicted for t, g in held)
    assert hit / sum(t for t, _ in held) > 0.8 and hit / sum(g.predicted for _, g in held) > 0.9
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in toxicity_scores(docs, flipped).collect()}
    assert all(abs(again[i] - r.score) < 1e-9 for i, r in got.items())  # held-out labels are never read


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "you pathetic idiot", 1), (3, "nice " * 30000, 1), (3, "nice", 1)], "doc_id long, text string, score int")
    for labels in (spark.createDataFrame([], "doc_id long, toxic int"), spark.createDataFrame([(1, 1), (3, 0), (None, 1), (2, None)], "doc_id long, toxic int")):
        got = toxicity_scores(docs, labels).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    got = {r.doc_id: r.predicted for r in toxicity_scores(docs, labels.limit(0)).collect()}
    assert got[None] == 1 and got[2] == 0
    assert toxicity_scores(docs.limit(0), labels).count() == 0


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(2)
    y = rng.random(6000) < 0.15
    rates = np.array([[0.02, 0.01, 0.05, 0.1], [0.7, 0.5, 0.6, 0.3]])
    votes = (rng.random((6000, 4)) < np.where(y[:, None], rates[1], rates[0])).astype(float)
    votes = np.column_stack([votes, votes[:, 0]])  # a voter that copies the first
    gold = np.where(rng.random(6000) < 0.3, np.where(rng.random(6000) < 0.95, y, ~y).astype(int), -1)
    post, model = label_model(votes, gold)
    assert np.mean((post > 0.5) == y) > 0.93
    assert np.abs(model["rates"][1][:4] - rates[1]).max() < 0.12 and model["share"][0] < 0.7 and model["share"][3] > 0.8


def test_label_model_counts_all_labelled_rows(spark, monkeypatch):
    """Voter statistics come from every labelled document, whatever the fit is limited to, and from counts as from rows."""
    from tessera.llm import toxicity
    seen = []
    monkeypatch.setattr(toxicity, "corpus_label_model", lambda p, v, fit=toxicity.corpus_label_model: seen.append(
        (p.count(), p.where("gold >= 0").count(), m := fit(p, v))) or m)
    docs, labels = table(spark, "documents"), table(spark, "labels").where("doc_id % 3 = 0")
    known = labels.join(docs.select("doc_id"), "doc_id").where(~toxicity.held_out(F.col("doc_id"))).count()
    monkeypatch.setattr(toxicity, "MOST_LABELS", 60)
    toxicity_scores(docs, labels)
    monkeypatch.setattr(toxicity, "MOST_PATTERNS", 0)  # the rounds as passes over the stored counts
    toxicity_scores(docs, labels)
    (n, gold, a), (_, _, b) = seen
    assert n == gold == known > 60
    assert all(np.allclose(a[k], b[k], atol=1e-8) for k in a)


def test_toxicity_fit_takes_a_bounded_number_of_rows(spark, monkeypatch):
    """A labelled id that many rows share does not bring them all to the driver."""
    from tessera.llm import toxicity
    seen = []
    monkeypatch.setattr(toxicity, "MOST_LABELS", 60)
    monkeypatch.setattr(toxicity, "fit_sparse", lambda rows, cols, n, *a, fit=toxicity.fit_sparse: seen.append(n) or fit(rows, cols, n, *a))
    docs = spark.createDataFrame([(i, "you pathetic idiot") for i in range(5)] + [(9, "nice words here")] * 300, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 9)) for i in (0, 1, 2, 3, 4, 9)], "doc_id long, toxic int")
    known = [r.doc_id for r in labels.where(~toxicity.held_out(F.col("doc_id"))).collect()]
    assert 9 in known and len(known) > 1
    assert toxicity_scores(docs, labels).count() == 305 and seen == [60]


def test_features_of_both_sides():
    import pandas as pd

    from tessera.llm.toxicity import best_of_each_side
    toxic = pd.DataFrame({"bucket": range(6), "z": [9.0, 8, 7, 6, 5, 4]})
    clean = pd.DataFrame({"bucket": range(10, 20), "z": -np.arange(20.0, 10, -1)})
    assert list(best_of_each_side(toxic, clean, 8).bucket) == [0, 1, 2, 3, 10, 11, 12, 13]
    assert list(best_of_each_side(toxic[:2], clean, 8).bucket) == [0, 1, 10, 11, 12, 13, 14, 15]
    assert list(best_of_each_side(toxic, clean[:1], 6).bucket) == [0, 1, 2, 3, 4, 10]


def test_min_cut_is_minimal():
    rng = random.Random(4)

    def value(side, cost, edges):
        return (sum((0 if s else c) if c > 0 else (-c if s else 0) for s, c in zip(side, cost))
                + sum(c for i, j, c in edges if side[i] != side[j]))

    for _ in range(150):
        n = rng.randint(1, 8)
        cost = [rng.uniform(-1, 1) for _ in range(n)]
        edges = [(i, j, rng.random()) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5]
        best = min(value(s, cost, edges) for s in itertools.product((0, 1), repeat=n))
        assert abs(value(min_cut(cost, edges), cost, edges) - best) < 1e-9


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1><p>Tagline of the site.</p></header>
<nav><ul><li><a href=1>Home</a><li><a href=2>More</a></ul></nav><div id="cookie-notice"><p>We use cookies, please accept all of them.</p></div>
<main><article><h1>A  title &amp; more</h1><script>var x="</p><p>no</p>";</script><p>First <b>bold</b>&nbsp;words
of the text, with a comma.<p>Second paragraph &lt;tag&gt; of the text; it is long enough.<div class="ad-slot"><p>Buy this now, it is cheap.</p></div>
<blockquote>A quoted sentence of the article.</blockquote><ul><li>First point of the list.</li><li>Second point of the list.</li></ul><form><input><label>Mail</label><button>Go</button></form>
<section class="comments"><h2>Comments</h2><article><p>I like this text a lot, dear reader.</p></article></section></article></main>
<aside><p>Another story that you may like, read it.</p></aside><footer>&copy; 2024 <p>All rights reserved by us.</p></footer>"""


def test_main_text_of_a_page():
    assert main_text(PAGE).split("\n") == [
        "A title & more", "First bold words of the text, with a comma.", "Second paragraph <tag> of the text; it is long enough.",
        "A quoted sentence of the article.", "First point of the list.", "Second point of the list."]
    plain = "<div><a href=1>Home</a> <a href=2>About</a></div><p>A page without any article element, but with a sentence or two. And more of it.</p><p>It goes on here, and on.</p>"
    assert main_text(plain).split("\n")[-2:] == ["A page without any article element, but with a sentence or two. And more of it.", "It goes on here, and on."]
    assert "Home" not in main_text(plain)


def test_container_evidence_is_bounded():
    prose = "This is a long paragraph of the article, with many words in it; " * 6 + "it ends here."
    body = f"<p>{prose}</p>" * 3
    nav = "<nav><a href=1>Home</a></nav>"
    for before, after in (("<article class='post-12 type-post category-legal tag-search'>", "</article>"), ("<div id='content' class='social related'>", "</div>"),
                          ("<form><div>", "</div></form>"), ("<form><article>", "</article></form>"), ("<div class='elementor-widget'><article class=post>", "</article></div>"),
                          ("<article class='no-comments'>", "</article>")):
        assert main_text(nav + before + body + after).split("\n") == [prose] * 3, before
    for name in ("comments-wrapper", "ad-container", "cookie-container", "commentsWrapper", "comment-content"):
        page = f"<article>{body}<div class='{name}'><p>{prose}</p><p>Buy this now, it is cheap.</p></div>{body}</article>"
        assert main_text(page).split("\n") == [prose] * 6, name
    assert main_text(f"{body}<div hidden><article>{body}</article></div>").split("\n") == [prose] * 3
    assert main_text(f"<article>{body}</article><section class=comments><article><p>{prose}</p></article></section>").split("\n") == [prose] * 3


def test_no_text_is_dropped_with_markup():
    def words(inner):
        return " ".join(main_text(f"<article><p>Here is {inner} and so on, it goes on.</p><p>The end of it, at last.</p></article>").split())

    assert words("<math><mi>x</mi><mo>=</mo><mn>2</mn></math>") == "Here is x=2 and so on, it goes on. The end of it, at last."
    for tag in ("svg", "math", "object", "canvas"):
        assert words(f"<{tag}>inner</{tag}>") == words(f"<{tag}>inner") == "Here is inner and so on, it goes on. The end of it, at last."
    for tag in ("noscript", "template", "iframe", "title"):
        assert words(f"<{tag}>") == "Here is and so on, it goes on. The end of it, at last." == words(f"<{tag}>inner</{tag}>")
    for tag in ("script", "style"):
        assert words(f"<{tag}>inner") == "Here is" and words(f"<{tag}>inner</{tag}>") == "Here is and so on, it goes on. The end of it, at last."
    assert main_text("<article><p title=it's>Hello world. Don't go.</p><p title = 'a > b' lang=\"x>y\" id=z'>More of it.</p></article>") == "Hello world. Don't go.\nMore of it."
    assert main_text("<article><p title=\"open>Hello world, here.</p></article>") == "Hello world, here."


def test_pages_equal_their_articles(spark):
    import html
    import re
    pages = table(spark, "pages")
    src = {r.page_id: r.html for r in pages.collect()}
    for r in extract_pages(pages).collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", src[r.page_id], re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", s)).split()) for s in re.split(r"</?(?:p|h1|br|div)\b[^>]*>", inner))
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_page_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>Text of a page, which is long enough to be one."), (3, "u", "<p>" + "word, " * 40000), (3, "u", "<"),
            (4, "u", "<div" * 3000 + "</a></b>" * 500), (5, "u", "<article>" + "<p>One more line of text.</p>" * 3000)]
    got = extract_pages(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")).collect()
    assert [r.page_id for r in got] == [r[0] for r in rows] and got[0].text == got[1].text == ""
    assert got[2].text.startswith("Text of a page") and got[3].n_chars == len("word, " * 40000) - 1 and got[6].text.count("\n") == 2999
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pipeline_against_plain_python(spark, sf_small):
    """Each stage on all its predecessor kept: decisions checked from the outside."""
    import corpus_pipeline as cp
    from tests.llm.test_joins import grams

    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    seen = [docs]
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, seen[-1], sf_small)
        assert out.columns == docs.columns, name
        out.write.parquet(path := cp.stored.__globals__["scratch_path"](spark, f"test-{name}"))
        seen.append(spark.read.parquet(path))
    rows = [{r.doc_id: r for r in d.collect()} for d in seen]
    bad = {r.doc_id for r in spark.read.parquet(f"{sf_small}/labels.parquet").where("quality = 0").collect()}
    assert len(set(rows[0]) - set(rows[1])) > 0 and len((set(rows[0]) - set(rows[1])) & bad) > 0.5 * len(bad & set(rows[0]))
    sets = {i: grams(r.text) for i, r in rows[1].items()}
    alike = {(i, j) for i in sets for j in sets if i < j and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    gone = set(rows[1]) - set(rows[2])
    assert gone == {j for i, j in alike} and not any({i, j} <= set(rows[2]) for i, j in alike)
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").collect()]
    assert set(rows[2]) - set(rows[3]) == {i for i, r in rows[2].items() if any(t in " ".join(r.text.lower().split()) for t in items)}
    assert set(rows[4]) <= set(rows[3]) and seen[4].count() > 0
    final = cp.STAGES[-1][1](spark, seen[4], sf_small)
    assert final.count() == seen[4].count()


class PlainBlocks(HTMLParser):
    """Blocks of a well-formed page with each block's whole chain of elements."""

    def __init__(self):
        super().__init__()
        self.chain, self.n, self.parts, self.blocks = [("html", 0)], 0, [], []

    def end_block(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((text, [k for _, k in self.chain]))
        self.parts = []

    def handle_starttag(self, tag, attrs):
        if tag != "b":
            self.end_block()
        self.n += 1
        self.chain.append((tag, self.n))

    def handle_endtag(self, tag):
        if tag != "b":
            self.end_block()
        self.chain.pop()

    def handle_data(self, data):
        self.parts.append(data)


def test_blocks_equal_plain_chains_on_random_trees():
    rng = random.Random(8)

    def tree(depth):
        out = []
        for _ in range(rng.randint(0, 4)):
            kind = rng.choice(["div", "section", "b", "text"]) if depth else "text"
            out.append(rng.choice(["a b", "c &amp; d. ", " "]) if kind == "text" else f"<{kind}>{tree(depth - 1)}</{kind}>")
        return "".join(out)

    seen = 0
    for _ in range(200):
        page = tree(6)
        plain = PlainBlocks()
        plain.feed(page)
        plain.close()
        plain.end_block()
        got = blocks_of(page)
        assert [b[0] for b in got] == [t for t, _ in plain.blocks]
        before = [0]
        for (*_, parent, apart), (_, chain) in zip(got, plain.blocks):
            common = next((k for k, (a, b) in enumerate(zip(before, chain)) if a != b), min(len(before), len(chain)))
            assert apart == len(before) + len(chain) - 2 * common and parent == (chain[-2] if len(chain) > 1 else -1)
            before = chain
        seen += len(got)
    assert seen > 500


def test_the_cut_turns_blocks_that_their_cost_alone_gets_wrong():
    """Pages without any telling class or element: short answers between long paragraphs, a sentence among links."""
    rng, wrong_alone, wrong_cut, n = random.Random(3), 0, 0, 0
    for _ in range(40):
        body = []
        for _ in range(8):
            body.append("A paragraph of the story, long enough to be told from links, with a comma or two. " * rng.randint(1, 3))
            if rng.random() < 0.5:
                body.append(rng.choice(["Yes", "No", "Maybe so", "Not yet"]))
        body.append("And so it ended, as all had known that it would from the first day on.")
        page = ("<div>" + "".join(f"<div><a href=x>{w}</a></div>" for w in ("Home", "News", "About us")) + "</div><div>"
                + "".join(f"<p>{x}</p>" for x in body) + "</div><div><span>Call us | 555</span></div>")
        want = {" ".join(x.split()) for x in body}
        blocks = blocks_of(page)
        alone = [x > 0 for x in np.clip(block_inputs(blocks) @ PRIOR_WEIGHTS[:-1] + PRIOR_WEIGHTS[-1], -3, 3)]
        kept = main_text(page).split("\n")
        wrong_alone += sum((b[0] in want) != a for b, a in zip(blocks, alone))
        wrong_cut += sum((b[0] in want) != (b[0] in kept) for b in blocks)
        n += len(blocks)
    assert wrong_alone > 0.1 * n and wrong_cut == 0


def test_an_articles_id_names_its_subject():
    text = "<p>A long paragraph, with many words in it, that says something to the reader.</p>" * 12
    for i in ("comments-on-policy", "cookie-recipes", "reply-to-critics", "ads"):
        assert main_text(f"<article id='{i}'>{text}</article>").count("\n") == 11
    for attributes in ("id='comment-12'", "id='div-comment-12'", "class='comment'", "id='reply-to-critics' class='comment'"):
        assert main_text(f"<article>{text}<section class=comments><article {attributes}>{text}</article></section></article>").count("\n") == 11


def test_deep_pages_take_linear_time():
    start = time.time()
    for page, blocks in (("<div>word here. " * 100_000, 100_000), ("<noscript>word " * 100_000, 1),
                         ("<div>" + "<b>x " * 20_000 + "<i>y<div>z</div></i>" * 20_000, 40_000)):
        assert len(blocks_of(page)) == blocks and isinstance(main_text(page), str)
    assert time.time() - start < 60
