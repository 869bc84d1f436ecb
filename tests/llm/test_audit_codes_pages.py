"""Filter audit, vector codes and page texts against brute force, held-out layouts and awkward inputs."""

import hashlib
import html
import itertools
import math
import os
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tideline.llm import filter_audit, page_text, vector_codes
from tideline.llm.page_layouts import labelled_pages

# ---- filter audit ----


def brute_audit(rows, labels):
    """rows: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    texts = [r[1] or "" for r in rows]
    low = {}
    for r, t in zip(rows, texts):
        if r[0] is not None:
            low[t] = min(low.get(t, r[0]), r[0])
    fails = []
    for r, t in zip(rows, texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append({k for k, bad in zip("ABCDE", (len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), bool(re.search(r"[#$%&*|]", t)), r[0] is not None and low[t] < r[0])) if bad})
    out = set()
    for part in {r[2] or "" for r in rows}:
        mine = [(f, r[0]) for f, r in zip(fails, rows) if (r[2] or "") == part]
        shares = {k: sum(math.factorial(5) // len(f) for f, _ in mine if k in f) for k in "ABCDE"}
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, k in enumerate(order, 1):
                gone = [(f, d) for f, d in left if k in f]
                left = [(f, d) for f, d in left if k not in f]
                fail = [f for f, _ in mine if k in f]
                out.add((part, order, step, len(left), len(gone), len(fail) - len(gone), sum(f == {k} for f in fail), sum(d in good for _, d in gone), sum(d in toxic for _, d in gone), shares[k]))
    return out


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audited(spark, place, rows, labels, files):
    """The query over a table whose files are written one after the other, so that their order is known."""
    docs = place / "documents.parquet"
    docs.mkdir(parents=True)
    for k, some in enumerate(files):
        table = pa.table({"doc_id": pa.array([rows[i][0] for i in some], pa.int64()), "text": pa.array([rows[i][1] for i in some], pa.string()), "lang": pa.array([rows[i][2] for i in some], pa.string()), "mask": pa.array(["x"] * len(some)), "digest": pa.array([1] * len(some)), "n": pa.array([0] * len(some))})
        pq.write_table(table, docs / f"part-{k:03d}.parquet")
        os.utime(docs / f"part-{k:03d}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(str(place / "labels.parquet"))
    out = filter_audit.op11_filter_audit(spark, str(place))
    assert tuple(out.columns) == COLUMNS
    return {tuple(r) for r in out.collect()}


def test_audit_retracts_what_later_files_disprove(spark, tmp_path):
    """Files from the largest ids down, so that almost every first row is disproved by a later micro-batch."""
    base = " ".join(f"w{i}" for i in range(120))
    texts = [base, base + " #", "A LOUD TEXT " * 40, "same " * 200, base.replace("w7 ", "w8 "), "", None, "   ", "short", "é" * 300, "long " + " ".join(f"x{i}" for i in range(30000))]
    rows = [(i, texts[i % len(texts)], ("en", "de", None, "")[i % 4]) for i in range(80)]
    rows += [(None, base, "en"), (None, base, None), (5, texts[5], "en"), (5, texts[5], "fr"), (79, "other", "en"), (-3, "short", "de"), (40, base, "en")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 80, 2)] + [(0, 1, 1), (0, 0, 0), (None, 1, 1), (900, 1, 1), (3, None, None)]
    labels = [(d, q, None if t is None else int(t)) for d, q, t in labels]
    order = sorted(range(len(rows)), key=lambda i: -(rows[i][0] if rows[i][0] is not None else 10))
    files = [order[k : k + 6] for k in range(0, len(order), 6)]
    want = brute_audit(rows, labels)
    assert audited(spark, tmp_path / "down", rows, labels, files) == want
    assert audited(spark, tmp_path / "up", rows, labels, files[::-1]) == want
    assert audited(spark, tmp_path / "one", rows, labels, [order]) == want


def test_audit_of_nothing(spark, tmp_path):
    assert audited(spark, tmp_path / "none", [], [], [[]]) == set()


def test_a_state_step_retracts(spark):
    """One text: first by id 9, then by 4 twice, then by 4 and 7."""
    group = dict(bucket=0, digest=b"d", part="en", mask=2, good=0, toxic=0, free=False)
    arrive = lambda *ids: filter_audit.added_up(pd.DataFrame([{**group, "doc_id": i} for i in ids]))
    known, changes = filter_audit.step(None, arrive(9))
    assert changes[["mask", "n"]].values.tolist() == [[2, 1]]
    known, changes = filter_audit.step(known, arrive(4, 4))
    assert sorted(changes[["mask", "n"]].values.tolist()) == [[2, 1], [18, 1]]  # two firsts more, one retracted
    assert known[["low", "n"]].values.tolist() == [[4, 2]]
    known, changes = filter_audit.step(known, arrive(7, 4))
    assert sorted(changes[["mask", "n"]].values.tolist()) == [[2, 1], [18, 1]] and known[["low", "n"]].values.tolist() == [[4, 3]]


# ---- vector codes ----


def brute_codes(rows):
    """rows: (vec_id, embedding, label) -> the rows kept with (code, error), and the codebooks."""
    held = [(i, e, b) for i, e, b in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    ids = sorted({i for i, _, _ in held if i is not None})[:16]
    first = [min(e for j, e, _ in held if j == i) for i in ids]
    held = [r for r in held if len(r[1]) == len(first[0])]
    whole = [[math.floor(4096 * x) for x in e] for _, e, _ in held]
    size = len(first[0]) // 8
    cut = lambda v: [v[p * size : p * size + size] for p in range(8)]
    books = [[cut([math.floor(4096 * x) for x in e])[p] for e in first] for p in range(8)]
    parts = [cut(v) for v in whole]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(6):
        for p in range(8):
            groups = {}
            for x in parts:
                groups.setdefault(near(p, x[p])[1], []).append(x[p])
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    out = []
    for (i, _, b), x in zip(held, parts):
        found = [near(p, x[p]) for p in range(8)]
        out.append((i, b, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    return out, ",".join(str(c) for p in books for e in p for c in e)


def vectors():
    rng = np.random.default_rng(6)
    x = rng.normal(0, 0.2, (150, 24)).astype(np.float32)
    x[:40] = np.round(x[:40], 1)  # ties
    rows = [(int(i), v.tolist(), int(i) % 5 if i % 7 else None) for i, v in zip(rng.permutation(150) - 20, x)]
    rows += [(3, rows[0][1], 1), rows[5], rows[5], (None, rows[7][1], 2), (900, None, 1), (901, [0.1] * 23 + [None], 1), (902, [float("nan")] + [0.0] * 23, 1), (903, [float("inf")] * 24, None), (904, [0.5] * 16, 0), (905, [0.0] * 24, None)]
    return rows


def test_vector_codes(spark, tmp_path):
    rows = vectors()
    schema = "vec_id long, embedding array<float>, label int, parts string, near string, code string, same_label int"
    table = spark.createDataFrame([(*r, "p", "n", "c", 1) for r in rows], schema).repartition(5)
    table.write.parquet(str(tmp_path / "embeddings.parquet"))
    coded, listed = brute_codes(rows)
    sums = {}
    for _, b, _, e in coded:
        sums[b] = sums.get(b, 0) + e
    want = [(i, c, e, sums[b], hashlib.sha256(listed.encode()).hexdigest()) for i, b, c, e in coded]
    found = [tuple(r) for r in vector_codes.op12_vector_codes(spark, str(tmp_path)).collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(found, key=key) == sorted(want, key=key)


def test_pivots_prune_and_lose_nothing():
    """Clustered parts: the nearest entries are exact, at a fraction of the distances."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-4000, 4000, (16, 8))
    x = centres[rng.integers(0, 16, 3000)] + rng.integers(-60, 60, (3000, 8))
    x[:16] = centres
    book = np.concatenate([centres[:15], centres[:1]])  # two entries alike: the lower one
    pivots = vector_codes.pick_pivots(book[None])[0]
    entry, square, tried = vector_codes.nearest(x, vector_codes.distances(x, pivots), book, vector_codes.distances(book, pivots))
    d = ((x[:, None, :] - book[None]) ** 2).sum(-1)
    assert (entry == d.argmin(1)).all() and (square == d.min(1)).all()
    assert tried < 0.25 * d.size


def test_few_and_no_vectors(spark, tmp_path):
    few = [(k, [k * 0.1] * 8, None) for k in range(3)]
    for name, rows in (("few", few), ("none", []), ("nulls", [(1, None, 1)])):
        spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / name / "embeddings.parquet"))
        found = vector_codes.op12_vector_codes(spark, str(tmp_path / name)).collect()
        assert [(r.vec_id, r.error, r.label_error) for r in sorted(found)] == ([(0, 0, 0), (1, 0, 0), (2, 0, 0)] if name == "few" else [])
    with pytest.raises(ValueError):
        vector_codes.whole(np.array([1e9]))


# ---- page texts ----


@pytest.fixture(scope="module")
def model():
    return page_text.trained()


def test_held_out_layouts(model):
    """Pages made with another seed: blocks by their labels."""
    tree = page_text.Tree()
    for i, page in enumerate(labelled_pages(300, 77)):
        page_text.grow(tree, i, page)
    block = np.array([t is not None for t in tree.text])
    right = (page_text.content(tree, model) > 0.5) == (np.array(tree.mark) == 1)
    assert right[block].mean() > 0.96


def test_messages_are_the_marginals():
    """Against all states of a small forest."""
    tree = page_text.Tree()
    page_text.grow(tree, 0, "<body><div>a<p>b</p></div><nav>c</nav></body>")
    page_text.grow(tree, 1, "d")
    n = len(tree.page)
    f = page_text.forest(tree, {"edge": 0})
    rng = np.random.default_rng(3)
    unary, edge = rng.normal(0, 1, n), rng.normal(0, 1, (n, 2, 2))
    node, both, z = page_text.messages(f, unary, edge)
    weights = {}
    for state in itertools.product((0, 1), repeat=n):
        weights[state] = math.exp(sum(unary[i] * state[i] for i in range(n)) + sum(edge[i, state[f.parent[i]], state[i]] for i in range(n) if f.parent[i] != i))
    total = sum(weights.values())
    assert z == pytest.approx(math.log(total))
    for i in range(n):
        assert math.exp(node[i, 1]) == pytest.approx(sum(v for s, v in weights.items() if s[i]) / total)
        if f.parent[i] != i:
            assert math.exp(both[i, 1, 0]) == pytest.approx(sum(v for s, v in weights.items() if s[f.parent[i]] and not s[i]) / total)


STORY = ["A title &amp; more", "First words of it, and a good many of them so that it looks like a text.", "Caf&eacute; &#233; &#x41; &lt;b&gt; of the   second\n\tparagraph goes on for a while.", "The third one ends it; nothing else is to follow after these words."]
AROUND = {
    "menu": '<nav><ul><li><a href="/">Home</a></li><li><a href="/x">News</a></li></ul></nav>',
    "header": '<header class="site-header"><p>The daily page</p></header>',
    "footer": "<footer>&copy; 2024 All of it <a href='/l'>Legal</a></footer>",
    "sidebar": '<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">One story here</a></li><li><a href="/2">Another one</a></li></ul></aside>',
    "notice": '<div class="cookie-notice"><p>We use cookies to make this page better. Do you agree to all of them?</p></div>',
    "advert": '<div class="ad">Buy this thing today. It is cheap.</div>',
    "form": '<form action="/s"><label>Your mail</label><input name="m"><p>Get our letter every week.</p><button>Send</button></form>',
    "script": "<script>document.write('<p>not a text at all, though it is long enough to be one</p>')</script><style>p{margin:0}</style>",
    "comments": '<section class="comments"><h3>2 comments</h3><div class="comment"><b>Ann</b><p>I read all of this and I have something long to say about it, too.</p></div><div class="comment"><p>So have I. It was a good text.</p></div></section>',
}


@pytest.mark.parametrize("tag", ["<article>", '<div class="content">', '<main id="main">'])
def test_parts_around_the_article_go(model, tag):
    body = f"<h1>{STORY[0]}</h1>" + "".join(f"<p>{p}" for p in STORY[1:])
    want = "\n\n".join(" ".join(html.unescape(p).split()) for p in STORY)
    close = f"</{tag[1:].split()[0].strip('>')}>"
    for chosen in [[k] for k in AROUND] + [list(AROUND)]:
        above = "".join(AROUND[k] for k in chosen if k not in ("footer", "comments"))
        below = "".join(AROUND[k] for k in chosen if k in ("footer", "comments"))
        page = f"<!DOCTYPE html><html><head><title>No</title></head><body>{above}<!-- no <p>no</p> -->{tag}{body}{close}{below}</body></html>"
        assert page_text.texts([page], model) == [want], chosen


def test_awkward_pages(spark, model):
    deep = "<article>" + "<div>" * 3000 + "<p>In the depth stands a long enough sentence, with words.</p>" + "</div>" * 5000
    pages = [None, "", "no markup", "<", "<p", "<!-- only", "<script>x", "&#0; &bogus; &amp", "<p>" * 500, "</p></div></li>" * 50, deep, "<article><p>" + "word " * 200000 + "</p></article>", "<table><tr><td>a<td>b<tr><td>c</table>", '<div class="a\'b" x="1>2">t</div>', "\x00퟿ é"]
    rows = [(i, None if i % 2 else f"u{i}", p, "x", 1) for i, p in enumerate(pages)] + [(None, "u", pages[10], "x", 1), (10, "u10", pages[10], "x", 1)]
    found = page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int"), model).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r.text for r in found}
    assert by_id[0] == by_id[1] == by_id[6] == "" and by_id[None] == by_id[10] and by_id[11].count("word") in (0, 200000)
    assert page_text.extract(spark.createDataFrame([], "page_id long, url string, html string"), model).count() == 0


def test_blocks_and_references():
    tree = page_text.Tree()
    page_text.grow(tree, 0, "<div>a <b>b</b>\n c<br>d<p>e&nbsp;&lt;f<p>g<ul><li>h<li>i <a href=x>j</a></ul>k<h2>l</h3>m<select><option>no</select></div>")
    assert [t for t in tree.text if t] == ["a b c d", "e <f", "g", "h", "i j", "k", "l", "m"]
    assert [(t, k) for t, k in zip(tree.text, tree.linked) if k] == [("i j", 1)]
