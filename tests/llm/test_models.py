"""Language identification, mixing, page text, near copies, search and tokens."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import sentencepiece
import xxhash

from pyspark.sql import functions as F

from tongues.llm import html, linear, mixing, simhash
from tongues.llm.components import components
from tongues.llm.language import identify, predict, train
from tongues.llm.mixing import DOMAINS, TARGETS, fit_rates, mix, mixed_documents, mixture
from tongues.llm.sentencepiece import MODEL, Vocabulary, codes_of, compose, product, scan, tokenize
from tongues.llm.simhash import SIMILAR_RADIUS, BKTree, fingerprint, keep_one, near_links, signature, simhash_groups, similar_groups
from tongues.llm.vptree import VPTree, nearest

ROOT = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}


def plain_fingerprint(text):
    words = re.findall("[^ \t-\r]+", (text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, radius=3):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if (a ^ values[j]).bit_count() <= radius and root(i) != root(j):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(values))]


def test_fingerprints(documents):
    texts = [None, "", " \t\x0b", "One", "one TWO", "a b c", "É é É", "the cat " * 400, "x" * 100_000, "a b c d"]
    for t in texts:
        assert fingerprint(t) % 2**64 == plain_fingerprint(t), t


def near_texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(900)]
    rows, base = [], [rng.choice(words) for _ in range(400)]
    for i in range(60):
        text = list(base)
        text[rng.randrange(400)] = rng.choice(words)
        rows.append(" ".join(text))
    rows += [" ".join(rng.choice(words) for _ in range(30)) for _ in range(60)] + [rows[3]] * 20 + [None, "", "  "]
    return rows


@pytest.mark.parametrize("tree", [4, 2048])
def test_components_equal_brute_force(spark, documents, tree, monkeypatch):
    import tongues.llm.simhash as simhash

    monkeypatch.setattr(simhash.near_links, "__defaults__", (3, tree))
    texts = near_texts()
    roots = plain_components([plain_fingerprint(t) for t in texts])
    first = {}
    for i, r in enumerate(roots):
        first.setdefault(r, i)
    found = {r["doc_id"]: r for r in simhash_groups(documents(list(enumerate(texts)), clash=True)).collect()}
    assert len(found) == len(texts)
    for i, t in enumerate(texts):
        assert found[i]["fp"] % 2**64 == plain_fingerprint(t) and found[i]["component_id"] == first[roots[i]]


def test_one_of_each_group_stays(documents):
    rows = [(5, "same text here"), (2, "same text here"), (2, "same text here"), (9, "another one entirely"), (None, "alone"), (None, "alone"), (None, "SAME text here")]
    kept = keep_one(documents(rows, clash=True)).collect()
    assert sorted((r["doc_id"] or -1, r["text"]) for r in kept) == [(-1, "alone"), (2, "same text here"), (9, "another one entirely")]
    assert keep_one(documents([])).count() == 0


def edited(rng, words, text, edits):
    """``text`` with so many words replaced, six apart, so that each takes five shingles of its own."""
    text = list(text)
    for at in rng.sample(range(0, len(text), 6), edits):
        text[at] = rng.choice(words)
    return text


def test_similar_texts_share_a_group_and_others_do_not(documents):
    rng = random.Random(11)
    words = [f"v{i}" for i in range(5000)]
    originals = [[rng.choice(words) for _ in range(rng.randrange(240, 600))] for _ in range(60)]
    texts = [" ".join(t) for t in originals]
    texts += [" ".join(edited(rng, words, t, len(t) // 50)) for t in originals]  # similarity 0.82 or more
    texts += [" ".join(t[:20] + [rng.choice(words) for _ in range(300)]) for t in originals]  # only a passage in common
    found = {r["doc_id"]: r["component_id"] for r in similar_groups(documents(list(enumerate(texts)), clash=True)).collect()}
    assert len(found) == 180 and all(found[i] == i for i in [*range(60), *range(120, 180)])
    assert sum(found[60 + i] == i for i in range(60)) >= 57


def plain_similar_groups(texts):
    sets = [{tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.split() for t in texts)]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("tree", [5, 2048])
def test_less_similar_texts_stay_apart(documents, tree, monkeypatch):
    import tongues.llm.simhash as simhash

    monkeypatch.setattr(simhash, "TREE", tree)
    rng = random.Random(23)
    words = [f"v{i}" for i in range(5000)]
    base = [rng.choice(words) for _ in range(600)]
    texts = [" ".join(edited(rng, words, base, 12)) for _ in range(40)]  # a template: about 0.7 with each other
    texts += [" ".join(edited(rng, words, texts[i].split(), 4)) for i in range(20)]  # and 0.94 with one of them
    groups = plain_similar_groups(texts)
    assert groups == [*range(40), *range(20)]
    found = {r["doc_id"]: r["component_id"] for r in similar_groups(documents(list(enumerate(texts)))).collect()}
    assert [found[i] for i in range(60)] == groups


@pytest.mark.parametrize("tree", [3, 2048])
def test_similar_groups_with_nulls_short_texts_and_split_buckets(documents, tree, monkeypatch):
    import tongues.llm.simhash as simhash

    monkeypatch.setattr(simhash, "TREE", tree)
    rng = random.Random(3)
    words = [f"v{i}" for i in range(900)]
    base = [rng.choice(words) for _ in range(600)]
    texts = [None, "", " \t", "One", "one", "two words", *[" ".join(edited(rng, words, base, 1)) for _ in range(30)], "x" * 100_000, "word " * 300_000]
    rows = [*enumerate(texts), (6, texts[6]), (None, "one"), (None, None), (None, "nothing like it")]
    found = similar_groups(documents(rows, clash=True)).collect()
    assert len(found) == len(rows)
    component = {r["doc_id"]: r["component_id"] for r in found if r["doc_id"] is not None}
    assert [component[i] for i in range(6)] == [0, 0, 0, 3, 3, 5] and {component[i] for i in range(6, 36)} == {6}
    assert component[36] == 36 and component[37] == 37
    assert sorted(r["component_id"] for r in found if r["doc_id"] is None and r["component_id"] is not None) == [0, 3]
    assert similar_groups(documents([])).count() == 0


def test_signature_is_of_sets_and_votes():
    lanes, buckets = signature(None)
    assert not lanes.any() and not buckets.any()
    a, b = signature("a b c d e f"), signature("A b  c\td e F")
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all()
    long, once = signature("a b c d e " * 20_000), signature("a b c d e " * 3)
    assert (long[1] == once[1]).all()
    apart = sum((int(x) ^ int(y)).bit_count() for x, y in zip(signature("one two three four five six")[0] & (2**62 - 1), signature("six five four three two one")[0] & (2**62 - 1)))
    assert apart > SIMILAR_RADIUS


def test_repeated_passages_neither_join_nor_part_texts(documents):
    rng = random.Random(31)
    words = [f"v{i}" for i in range(5000)]
    refrain = "la la la la la " * 60
    texts = [refrain + " ".join(rng.choice(words) for _ in range(140)) for _ in range(6)]  # a refrain in common, and no more
    base = [rng.choice(words) for _ in range(300)]
    texts += [" ".join(base), " ".join(base + base[:60] * 5)]  # a quoted passage, four shingles at its seams
    lanes = [signature(t)[0] for t in texts]
    assert len({tuple(x) for x in lanes[:6]}) == 6
    assert sum(((int(x) ^ int(y)) % 2**64).bit_count() for x, y in zip(lanes[6], lanes[7])) < SIMILAR_RADIUS
    assert plain_similar_groups(texts) == [*range(6), 6, 6]
    found = {r["doc_id"]: r["component_id"] for r in similar_groups(documents(list(enumerate(texts)))).collect()}
    assert [found[i] for i in range(8)] == [*range(6), 6, 6]


def test_radius_holds_pairs_at_the_least_similarity():
    rng = random.Random(37)
    for words, extra in ((8, 1), (204, 50)):  # 4 shingles in 5, and 200 in 250
        apart = []
        for _ in range(300):
            text = [f"v{rng.getrandbits(40)}" for _ in range(words + extra)]
            a, b = signature(" ".join(text[:words]))[0], signature(" ".join(text))[0]
            apart.append(sum(((int(x) ^ int(y)) % 2**64).bit_count() for x, y in zip(a, b)))
        assert np.mean([d <= SIMILAR_RADIUS for d in apart]) > 0.98


def test_bk_tree_finds_what_a_scan_finds():
    rng = random.Random(1)
    values = [rng.getrandbits(16) for _ in range(400)]
    tree = BKTree()
    for v in values:
        tree.add(v)
    assert BKTree().near(1, 3) == []
    for q in range(200):
        assert sorted(tree.near(q, 3)) == sorted(v for v in values if (v ^ q).bit_count() <= 3)


def test_links_connect_split_buckets(spark):
    values = [1 << i for i in range(40)] + [0, 2**62 + 5, 2**62 + 4]
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    links = near_links(fps, tree=3)
    found = {r["node"]: r["root"] for r in components(links).collect()}
    groups = plain_components(values)
    assert {frozenset(v for v in values if found.get(v, v) == r) for r in {found.get(v, v) for v in values}} == {
        frozenset(v for v, g in zip(values, groups) if g == r) for r in set(groups)}


def test_long_paths_and_loops(spark):
    edges = [(i, i + 1) for i in range(300)] + [(7, 7), (1000, 999), (999, 1000), (-5, 2000)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(301)}, 999: 999, 1000: 999, -5: -5, 2000: -5}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(found) > 200 and np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_odd_texts(documents):
    rows = [(i, "the cat sat on the mat", "en") for i in range(40)] + [(100 + i, "der hund und die katze", "de") for i in range(40)]
    odd = [(900, None, "en"), (901, "", "de"), (902, "123 !!", None), (903, "THE CAT " * 40_000, None), (None, "die katze", "de"), (904, "the", None), (904, "the", None)]
    model = train(documents(rows + odd))
    assert model.classes == ["de", "en"]
    found = [(r["doc_id"], r["lang_pred"], r["score"]) for r in identify(documents(rows + odd, clash=True)).collect()]
    assert len(found) == len(rows) + len(odd)
    by = {i: (p, s) for i, p, s in found}
    assert by[900] == by[901] == by[902] == ("und", 0.0) and by[903][0] == "en" and by[None][0] == "de"
    assert sum(i == 904 for i, _, _ in found) == 2
    nothing = documents([(1, "text", None)])
    assert [(r["lang_pred"], r["score"]) for r in identify(nothing).collect()] == [("und", 0.0)]
    assert identify(documents([])).count() == 0
    assert predict(documents([(1, "der hund")]).withColumnRenamed("source", "lang_pred"), model).first()["lang_pred"] == "de"


def test_temperature_cools_overconfidence():
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 2, 2000)
    logits = np.zeros((2000, 2))
    logits[np.arange(2000), np.where(rng.random(2000) < 0.8, truth, 1 - truth)] = 10.0
    assert linear.temperature(logits, truth) == pytest.approx(10 / np.log(4), rel=0.05)


def test_rates_match_targets(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.3, 0.1, 0.1], 3000)
    tokens = rng.integers(1, 500, 3000)
    rows = spark.createDataFrame([(int(t), [float(x) for x in q]) for t, q in zip(tokens, p)], "tokens long, p array<double>")
    rates = fit_rates(rows, TARGETS)
    rate = rates.at(p)
    reached = (tokens * rate) @ p
    assert (rate >= 0).all() and np.allclose(reached, rates.reached)
    assert reached[:2] == pytest.approx(rates.wanted[:2], rel=0.05) and reached[2] < 0.1 * rates.totals[2]
    # no feasible direction improves the fit much: the projected gradient of the last point is small
    pull = p @ ((reached - rates.wanted) / rates.totals)
    assert np.abs(np.where(rate > 0, pull, np.minimum(pull, 0))).max() < 0.05


def test_no_clean_document_is_given_up_for_a_share(spark):
    rng = np.random.default_rng(8)
    p = np.concatenate([rng.dirichlet([6, 1, 1.5], 900), rng.dirichlet([0.5, 0.5, 4], 200), rng.dirichlet([0.5, 4, 0.5], 200)])
    rows = spark.createDataFrame([(100, [float(x) for x in q]) for q in p], "tokens long, p array<double>")
    best = p.argmax(axis=1)
    rates = fit_rates(rows, TARGETS, least=1.0)
    rate = rates.at(p)
    assert (fit_rates(rows, TARGETS).at(p)[best == 0] < 1).any() and (rate[best == 0] >= 1).all()
    assert rate[best == 2].max() < 0.05 and np.allclose((100 * rate) @ p, rates.reached)
    assert "toxic: wanted 0.0000, reached" in rates.shares()


def test_steps_go_on_until_rates_settle_and_a_limit_is_told(spark, monkeypatch, caplog):
    import tongues.llm.mixing as mixing

    rng = np.random.default_rng(9)
    p = np.array([[0.5, 0.3, 0.2]]) + rng.uniform(-0.02, 0.02, (300, 1)) * np.array([[1, -0.5, -0.5]])  # hardly told apart
    rows = spark.createDataFrame([(100, [float(x) for x in q]) for q in p], "tokens long, p array<double>").coalesce(1).cache()
    rates = fit_rates(rows, TARGETS)
    rate = rates.at(p)
    gradient = p @ (((100 * rate) @ p - rates.wanted) / rates.totals) + mixing.RIDGE * (rate - 1)
    assert np.abs(np.where(rate > 0, gradient, np.minimum(gradient, 0))).max() <= 1e-6
    assert rates.gradient <= mixing.FLAT and rates.passes < mixing.STEPS and not caplog.records
    monkeypatch.setattr(mixing, "STEPS", 2)
    fit_rates(rows, TARGETS)
    assert "2 steps did not settle" in caplog.text and "reached" in caplog.text


@pytest.mark.parametrize("least", [0.0, 1.0])
def test_rates_equal_an_independent_bounded_solution(spark, least):
    """Coordinate descent, rate by rate, on the same objective."""
    rng = np.random.default_rng(21)
    p = np.concatenate([rng.dirichlet([6, 1, 1.5], 90), rng.dirichlet([0.5, 0.5, 4], 40), rng.dirichlet([0.5, 4, 0.5], 40)])
    tokens = rng.integers(0, 300, len(p))
    rows = spark.createDataFrame([(int(t), [float(x) for x in q]) for t, q in zip(tokens, p)], "tokens long, p array<double>").coalesce(1).cache()
    rates = fit_rates(rows, TARGETS, least=least)
    floor = np.where(p.argmax(axis=1) == 0, least, 0.0)

    def objective(rate):
        miss = (tokens * rate) @ p - rates.wanted
        return (miss ** 2 / rates.totals).sum() / 2 + mixing.RIDGE * (tokens * (rate - 1) ** 2).sum() / 2

    rate = np.maximum(floor, 1.0)
    for _ in range(4000):
        miss = ((tokens * rate) @ p - rates.wanted)
        for d in np.flatnonzero(tokens):
            slope = (p[d] * miss / rates.totals).sum() + mixing.RIDGE * (rate[d] - 1)
            new = max(floor[d], rate[d] - slope / (tokens[d] * (p[d] ** 2 / rates.totals).sum() + mixing.RIDGE))
            miss += tokens[d] * (new - rate[d]) * p[d]
            rate[d] = new
    best, mine = objective(rate), objective(rates.at(p))
    assert mine <= best * (1 + 1e-6) + 1e-9
    assert rates.passes <= 30
    column = np.array([r[0] for r in rows.select(rates.column()).collect()])
    assert np.allclose(np.sort(column), np.sort(rates.at(p)), atol=1e-12)


def test_totals_wanted_and_reached_are_returned(spark, documents):
    rows = [(i, "good words here" if i % 3 else "bad words there") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(40)], "doc_id long, quality int, toxic int")
    found = mixture(documents(rows), labels)
    totals = {r["domain"]: (r["wanted"], r["reached"]) for r in found.totals().collect()}
    rates = [r for r in found.documents.collect()]
    assert list(totals) == list(DOMAINS)
    for d in DOMAINS:
        assert totals[d][1] == pytest.approx(sum(r["tokens"] * r["rate"] * r[f"p_{d}"] for r in rates))
    for r in mix(documents(rows), labels).collect():
        best = max(DOMAINS, key=lambda d: r[f"p_{d}"])
        assert r["domain"] == best and (r["wanted"], r["reached"]) == pytest.approx(totals[best])


def test_mixing_of_odd_tables(spark, documents):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1), (3, None, 1), (None, 1, 1), (4, None, None), (77, 1, 0)], "doc_id long, quality int, toxic int")
    rows = [(1, "good words"), (2, "*** %%%"), (3, "bad idiot"), (4, None), (5, ""), (5, ""), (None, "good words")]
    found = mix(documents(rows, clash=True), labels).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["rate"] >= 0 and r["copies"] >= 0 and sum(r[f"p_{d}"] for d in DOMAINS) == pytest.approx(1)
        assert abs(r["copies"] - r["rate"]) < 1
    copies = sum(r["copies"] for r in found)
    again = mixed_documents(documents(rows), labels)
    assert again.count() == copies and again.columns == documents([]).columns
    assert mix(documents([]), labels).count() == 0
    unlabelled = mix(documents(rows), labels.limit(0)).collect()
    assert len(unlabelled) == len(rows)


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>Menu</ul></nav>"
    "<div class='cookie-notice'>Cookies</div><main><article class=post><header><h1>Big &amp; bold</h1></header><p>One<b>two</b> &lt;3<br>four"
    "<p>Five &nbsp; six</p><form>Ask</form><ul><li>seven<li>eight</ul><script>var a='</p>nine'</script><div class='share'>Share</div>"
    "<section id=comments><p>First!</p></section><footer>By me</footer></article></main><aside>Side</aside><!-- x --><footer>End</footer></body></html>"
)


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), (PAGE, "Big & bold Onetwo <3 four Five six seven eight"),
    ("<article><p>cut off &am", "cut off &am"), ("<body><p>a<p>b<div>c</div>d", "a b c d"), ("<main>m<aside>n</aside></main><p>o", "m"),
    ("<article>a</article><p>x</p><article>b</article>", "a b"), ("<article><script>never closed", ""), ("a < b > c", "a < b > c"),
    ("<article>" + "<div>" * 3000 + "deep", "deep"), ("<article>" + "<p>x" * 3000, " ".join(["x"] * 3000)),
    ("<article><a title=\"1 > 0\">link</a> <img alt='x'>text", "link text"),
])
def test_main_text_of_a_page(spark, page, text):
    rows = spark.createDataFrame([(1, "http://h/a", page, 5)], "page_id long, url string, html string, low long")
    assert [(r["text"], r["n_chars"]) for r in html.extract(rows).collect()] == [(text, len(text))]


def test_what_a_site_repeats_goes(spark):
    def page(i):
        return f"<html><body><div class='x'>same on all pages</div><div class='y'>text of page {i}</div></body></html>"

    rows = [(i, f"http://site/{i}", page(i)) for i in range(8)] + [(90, "http://other/1", page(90)), (91, None, page(91)), (92, "http://[bad", page(92)), (0, "http://site/0", page(0))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = html.extract(frame).collect()
    assert len(found) == len(rows)
    for r in found:
        tail = f"text of page {r['page_id']}"
        assert r["text"] == (tail if r["page_id"] < 8 else f"same on all pages {tail}")
    tree = html.style_tree(frame).filter("host = 'site'").collect()
    assert min(r["importance"] for r in tree) == 0 and all(0 <= r["importance"] <= 1.0001 for r in tree)
    assert html.extract(frame.limit(0)).count() == 0


def test_copies_of_an_article_keep_their_text(spark):
    rows = [(i, f"http://site/{i}", "<article><h1>t</h1><p>always the same</p></article>") for i in range(20)]
    found = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["text"] for r in found} == {"t always the same"}


@pytest.mark.parametrize(("page", "text"), [
    ("<div class='content has-sidebar'><article>story</article></div>", "story"), ("<div class='no-sidebar'><p>story</p></div>", "story"),
    ("<article class='post comments-open'>story</article>", "story"), ("<div id='page' class='with-menu'><p>story</p></div>", "story"),
    ("<article class='post sponsored'><p>a</p><p class='related-work'>b</p></article>", "a b"), ("<div class='has-header'>story</div>", "story"),
    ("<div class=widget><h1>t</h1><article>story</article></div>", "story"), ("<main><div class=widget><article>story</article></div></main>", "story"), ("<header><main>story</main></header>", "story"),
    ("<div class='related'><article>card</article></div><article>a long story</article>", "a long story"),
    ("<p>a</p><div class='site-header'>b</div><div id='ad-1'>c</div><div class='x share-buttons'>d</div><div class=cookie_notice>e</div>", "a"),
])
def test_only_whole_names_rule_out_and_never_the_article(spark, page, text):
    assert html.Page(page).main_text(frozenset()) == text


@pytest.mark.parametrize(("page", "text"), [
    ("<body><p>The story, which is long.</p><article>card</article></body>", "The story, which is long. card"),
    ("<main><div>The story, which is long.</div><article>card</article></main><p>x</p>", "The story, which is long. card"),
    ("<main><h1>Title</h1><p>Lead</p><div>by me</div><article>The story, which is long.</article></main><p>x</p>", "Title Lead The story, which is long."),
])
def test_the_region_with_most_text_is_chosen(page, text):
    assert html.Page(page).main_text(frozenset()) == text


def test_copies_are_no_evidence_of_boilerplate(spark):
    story = "<div class='wrap'><section><p>always</p> the same</section></div>"
    rows = [(i, f"http://bare/{i}", f"<body><nav>{i}</nav>{story}</body>") for i in range(9)]  # copies but for what is ruled out
    rows += [(20 + i, f"http://wrapped/{i}", f"<article>{story}</article>") for i in range(9)] + [(40, "http://row/0", f"<body>{story}</body>")] * 6
    found = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == len(rows) and {r["text"] for r in found} == {"always the same"}


def brute(rows, k=20):
    usable = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, a in usable:
        if q % 20 == 0:
            scored = []
            for i, b in usable:
                if i != q:
                    s = 0.0
                    for x, y in zip(a, b):
                        s += x * y
                    scored.append((-s, i))
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize(("shard", "block"), [(10_000, 1000), (60, 4)])
def test_nearest_equals_brute_force(spark, shard, block):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.1, 3)).tolist()) for i in range(700)]
    rows += [(700 + i, rows[5][1]) for i in range(300)]
    rows += [(2000, None), (2020, [0.0] * 8), (2040, [float("nan")] * 8), (2060, [None] + [1.0] * 7), (2080, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (3, rows[3][1])]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    found = {}
    for r in nearest(frame, frame["vec_id"] % 20 == 0, shard=shard, block=block).sort("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert found == brute(rows[:-1])
    assert nearest(frame.limit(0), frame["vec_id"] % 20 == 0).count() == 0


def test_fewer_candidates_than_asked_for(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 1.0]), (2, [0.5, 9.0]), (20, [1.0])], "vec_id long, embedding array<double>")
    found = nearest(frame, frame["vec_id"] % 20 == 0).collect()
    assert [tuple(r) for r in found] == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]


def test_factor_trades_recall_for_visits():
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(4000, 6))
    tree = VPTree(np.arange(4000), vectors)
    ids, asked = np.arange(0, 4000, 40), vectors[::40]

    def answers(factor):
        q, row, _ = tree.search(ids, asked, 10, factor)
        return {(a, b) for a, b in zip(q.tolist(), row.tolist())}

    exact = answers(1.0)
    scores = asked @ vectors.T
    scores[np.arange(len(ids)), ids] = -np.inf
    assert exact == {(q, b) for q in range(len(ids)) for b in np.argsort(-scores[q])[:10].tolist()}
    assert len(answers(0.3) & exact) / len(exact) < len(answers(0.9) & exact) / len(exact) <= 1


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


TEXTS = [
    None, "", " ", "   ", "a", "the cat sat", "  two  spaces ", "line\nbreak\ttab", "Ünïcödé 日本語 😀 \x00", "a▁b", "x" * 5000, "no_spaces_" * 300,
    "the quick brown fox " * 400, "😀" * 300, " " * 777,
]


@pytest.mark.parametrize(("giant", "chunk"), [(10**6, 8192), (0, 32), (20, 500)])
def test_ids_equal_the_library_and_round_trip(spark, documents, library, giant, chunk):
    docs = documents(list(enumerate(TEXTS)) + [(3, TEXTS[10]), (None, "null id")], clash=True)
    found = tokenize(docs, giant=giant, chunk=chunk).collect()
    assert len(found) == len(TEXTS) + 2
    for r in found:
        text = "null id" if r["doc_id"] is None else TEXTS[r["doc_id"]]
        if r["doc_id"] == 3 and len(r["ids"]) > 50:
            text = TEXTS[10]
        assert list(r["ids"]) == library.encode(text or "") and r["n_tokens"] == len(r["ids"])
        assert r["round_trip"]
    assert tokenize(documents([])).count() == 0


def test_unigram_reading_is_the_best_path():
    from tongues.llm.sentencepiece import backtrace, boundary_states, transfer

    v = Vocabulary.load(MODEL, merging=False)
    text = " the nation is of note and a thing of tion"
    codes, cut = codes_of(text), 13
    n = len(codes)
    best = [0.0] + [-np.inf] * n
    lattice = v.lattice(codes)
    for start in range(n):
        for end, piece in lattice[start]:
            best[end] = max(best[end], best[start] + v.weight(piece))
    parts = [(s, max(0, s - v.longest), min(s + cut, n)) for s in range(0, n, cut)]
    chunks = [(codes[low:e + v.longest], s - low, e - low, s == 0) for s, low, e in parts]
    lattices = [v.lattice(c) for c, *_ in chunks]
    states = boundary_states([transfer(v, L, a, b, z) for L, (_, a, b, z) in zip(lattices, chunks)])
    ids = [i for L, (c, a, b, z), x, y in zip(lattices, chunks, states, states[1:]) for i in backtrace(v, L, c, a, b, z, x, y)]
    assert sum(v.scores[i] for i in ids) == best[n] and "".join(v.texts[i] for i in ids) == text


def test_max_plus_products_are_associative():
    rng = np.random.default_rng(0)
    ms = [rng.integers(-9, 9, (3, 3)).astype(float) for _ in range(7)]
    out = ms[0]
    for i, m in enumerate(ms[1:], 1):
        out = compose(out, m)
        assert (product(ms[:i + 1]) == out).all()


@pytest.mark.parametrize("rows", [60, 120, 240])
def test_links_of_a_template_family_grow_linearly(documents, monkeypatch, rows):
    """Texts of one template with three words changed are all candidates of each other, and most are similar to a few only."""
    rng = random.Random(rows)
    template = [f"w{i}" for i in range(64)]
    texts = [" ".join(edited(rng, template, template, 3)) for _ in range(rows)]
    emitted = []
    monkeypatch.setattr(simhash, "components", lambda links: emitted.append(links.count()) or components(links))
    found = {r["doc_id"]: r["component_id"] for r in similar_groups(documents(list(enumerate(texts)))).collect()}
    assert [found[i] for i in range(rows)] == plain_similar_groups(texts)
    assert max(emitted) <= 2 * simhash.BANDS * rows


@pytest.mark.parametrize("span", [2, 5, 256])
def test_states_of_many_chunks_equal_a_plain_walk(spark, span):
    """Texts of one to many chunks, in groups of ``span`` matrices at most; scores of the paths are the best there are."""
    rng = np.random.default_rng(span)
    rows, plain = [], {}
    for tid, n in (("a", 1), ("b", 4), ("c", 33), ("d", 64)):
        sizes = [1, *rng.integers(1, 4, n - 1).tolist(), 1]
        ms = [np.where(rng.random((a, b)) < 0.2, -np.inf, rng.integers(-9, 9, (a, b)).astype(float)) for a, b in zip(sizes, sizes[1:])]
        ms = [np.where(np.isneginf(m).all(), 0.0, m) for m in ms]
        plain[tid] = ms
        rows += [(tid, k, m.tobytes(), m.shape[1]) for k, m in enumerate(ms)]
    rng.shuffle(rows)
    frame = spark.createDataFrame([(t, int(k), bytes(m), int(w)) for t, k, m, w in rows], "tid string, k long, matrix binary, width int")
    found = {(r["tid"], r["k"]): (r["entry"], r["leave"]) for r in scan(frame, span).collect()}
    for tid, ms in plain.items():
        path = [found[tid, k] for k in range(len(ms))]
        assert path[0][0] == 0 and all(a[1] == b[0] for a, b in zip(path, path[1:]))
        assert sum(m[a, b] for m, (a, b) in zip(ms, path)) == product(ms)[0].max()


def test_a_hundred_thousand_chunks_meet_in_small_groups(spark):
    n = 100_000
    m = np.array([[0.0, -1.0], [-1.0, 0.0]])
    frame = spark.range(n).selectExpr("'t' AS tid", "id AS k").repartition(8)
    frame = frame.withColumn("matrix", F.lit(m.tobytes())).withColumn("width", F.lit(2))
    found = scan(frame).agg(F.count("*"), F.sum("entry"), F.sum("leave")).first()
    assert tuple(found) == (n, 0, 0)


NOT_STORY = ["comments-section", "user-comments", "comment-thread", "comment-body", "left-sidebar", "top-nav", "footer-wrapper", "ad-slot",
             "ad-container", "related-articles", "share-tools", "comment-list", "site-header", "cookie-notice"]


@pytest.mark.parametrize("name", NOT_STORY)
def test_names_of_what_is_not_the_story(name):
    for attribute in ("class", "id"):
        page = f"<body><article><p>The story itself.</p></article><div {attribute}='{name}'><p>Something else that is a little longer.</p></div></body>"
        assert html.Page(page).main_text(frozenset()) == "The story itself."
        page = f"<body><div><p>The story itself.</p></div><div {attribute}='{name}'><p>Else.</p></div></body>"
        assert html.Page(page).main_text(frozenset()) == "The story itself."


@pytest.mark.parametrize("name", ["has-sidebar", "no-sidebar", "comments-open", "with-menu", "related-work", "advice", "story-body", "content", "shareholder"])
def test_names_that_may_hold_the_story(name):
    assert html.Page(f"<body><div class='{name}'><p>The story itself.</p></div></body>").main_text(frozenset()) == "The story itself."


def test_reader_comments_shaped_like_articles():
    remarks = "".join(f"<article class='remark'><p>Reader {i} has a good deal to say about this, more than the story has.</p></article>" for i in range(3))
    for box in ("<section class='comments'>", "<div id='disqus_thread'>", "<ol class='comment-list'>"):
        page = f"<body><article><p>The story itself.</p>{'' if 'ol' in box else ''}</article>{box}{remarks}</body>"
        assert html.Page(page).main_text(frozenset()) == "The story itself."
    page = "<body><article><p>The story itself.</p></article><article class='comment'><p>A remark that is much longer than it.</p></article></body>"
    assert html.Page(page).main_text(frozenset()) == "The story itself."
    page = "<body><div class='sidebar-wrapper'><article><p>The story itself, in a badly named box.</p></article></div></body>"
    assert html.Page(page).main_text(frozenset()) == "The story itself, in a badly named box."


def test_references_are_decoded_in_their_own_piece_of_text():
    assert html.Page("<body><p>a &l<b>t;</b> b &lt;i&gt; &amp;amp; &#233;</p></body>").main_text(frozenset()) == "a &lt; b <i> &amp; é"


def test_style_tree_equals_plain_entropies(spark):
    rng = random.Random(14)
    rows = []
    for i in range(40):
        body = "".join(f"<div class='{rng.choice('ab')}'><p>{rng.choice(['same', 'other', f'own {i}'])}</p></div>" for _ in range(rng.randint(0, 3)))
        rows.append((i, f"https://h{i % 3}.org/{i}", f"<body><nav>menu</nav>{body}</body>" if i % 11 else None))
    found = {(r["host"], r["node"]): (r["pages"], r["importance"]) for r in html.style_tree(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    seen = {}
    for _, url, page in rows:
        parsed = html.Page(page or "")
        for node, layout, content in parsed.style():
            old = seen.setdefault((html.host_of(url), node), {}).get(parsed.words(), (layout, content))
            seen[html.host_of(url), node][parsed.words()] = min(old[0], layout), min(old[1], content)

    def entropy(values):
        m = len(values)
        shares = [values.count(v) / m for v in set(values)]
        return 1.0 if m == 1 else -sum(s * np.log(s) for s in shares) / np.log(m)

    assert found.keys() == seen.keys()
    for key, pages in seen.items():
        layouts, contents = map(list, zip(*pages.values()))
        below = html.DECAY ** len(set(layouts))
        assert found[key] == (len(pages), pytest.approx((1 - below) * entropy(layouts) + below * entropy(contents)))


@pytest.mark.parametrize("text", ["½ ²", "① ⅷ Ⅳ", "_ 12 ³", "٣", "", None])
def test_numerals_are_no_letters(documents, text):
    rows = [(i, "the words of a language", "en") for i in range(30)] + [(100, text, "en")]
    found = {r["doc_id"]: r for r in identify(documents(rows)).collect()}
    assert (found[100]["lang_pred"], found[100]["score"]) == ("und", 0.0) and found[0]["lang_pred"] == "en"


def test_weights_equal_plain_tfidf():
    from tongues.llm.language import LENGTHS, gram_counts
    from tongues.llm.linear import Model, inverse_frequencies

    text = "Ein kleiner Text, ein Ein"
    grams = [text.lower()[i:i + n] for n in LENGTHS for i in range(len(text) - n + 1)]
    at, counts = gram_counts(text)
    assert counts.sum() == len(grams) and sorted(counts.tolist()) == sorted(grams.count(g) for g in set(grams))
    idf = inverse_frequencies(9, np.arange(1 << 15) % 7)
    _, weights = Model(["a"], np.zeros((1, 1)), idf).weigh(at, counts)
    plain = np.array([(1 + np.log(c)) * (np.log(10 / (1 + p % 7)) + 1) for p, c in zip(at, counts)])
    assert weights == pytest.approx(plain / np.linalg.norm(plain))


@pytest.mark.parametrize("scale", [1e-170, 1e-320, 1e160, 1e300, None])
def test_nearest_of_extreme_components(spark, scale):
    rng = np.random.default_rng(31)
    vectors = rng.normal(size=(600, 5))
    sizes = np.full(600, scale) if scale else 10.0 ** rng.integers(-300, 300, 600)
    vectors = vectors * sizes[:, None]
    vectors[(vectors == 0).all(axis=1), 0] = 5e-324
    frame = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {}
    for r in nearest(frame, frame["vec_id"] % 20 == 0, shard=250, block=7).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    for q in range(0, 600, 20):
        scores = np.zeros(600)
        with np.errstate(over="ignore", invalid="ignore"):
            for j in range(5):
                scores += vectors[q, j] * vectors[:, j]
        order = [i for i in np.lexsort((np.arange(600), -scores)) if i != q and not np.isnan(scores[i])][:20]
        assert sorted(found[q]) == [(n + 1, i, scores[i]) for n, i in enumerate(order)]


def test_near_copies_include_those_that_fingerprints_link(spark, documents):
    from corpus_pipeline import drop_near_copies

    rows = [*enumerate(bits_only()), (5, "another text of its own that has nothing in common")]
    assert len({r["component_id"] for r in similar_groups(documents(rows)).collect()}) == 3
    assert {r["component_id"] for r in simhash_groups(documents(rows)).collect()} == {0, 5}
    assert {r["doc_id"] for r in drop_near_copies(spark, documents(rows), "").collect()} == {0, 5}


def bits_only():
    """Two texts within 3 bits whose sets of five-word shingles are not similar."""
    rng = random.Random(1)
    head = [f"h{i}" for i in range(3)]
    # repeats decide the bits, which count each of them, and the sets count them once
    return [" ".join(head * 400 + [f"t{k}{rng.random()}" for _ in range(20)]) for k in range(2)]
