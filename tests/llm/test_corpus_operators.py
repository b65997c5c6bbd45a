"""Spelling variants, repeated passages and the filter audit, each against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations, permutations

import numpy as np
import pytest

from tongues.llm import suffixes
from tongues.llm.audit import FILTERS, Diagram, adjacent_swaps, audit_filters, audit_part
from tongues.llm.spelling import gram_prefix, index_keys, near_words, pivots, probe_keys, spelling_groups
from tongues.llm.suffixes import Intervals, SuffixArray, remove_repeats, repeat_groups, window_runs

UPPER = {c: c + 32 for c in range(65, 91)}
LABELS = "doc_id long, quality int, toxic int"


def plain_spelling(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if n >= 3 and len(w) >= 5}
    near = {w: {v for v in words if abs(len(v) - len(w)) <= 1 and one_edit(v, w)} for w in words}
    form = {}
    for w, others in near.items():
        if others and words[best := min(others, key=lambda v: (-words[v], v))] >= 2 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=repr)


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_spelling_equals_brute_force(documents):
    rng = random.Random(5)
    base = ["".join(rng.choice("abÉß") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    rows = []
    for i in range(300):
        words = [rng.choice(base) for _ in range(40)]
        words = [w if rng.random() < 0.8 else w[:k] + rng.choice(["", "a", "bÉ"]) + w[k + 1:] for w in words for k in [rng.randrange(len(w))]]
        rows.append((i, " ".join(words).upper() if i % 7 == 0 else ", ".join(words)))
    rows += [(None, "wordless 12 34"), (None, "wordless wordless"), (5, None), (6, ""), (7, "x" * 50_000)]
    rows += [(7, "aaaaa aaaaa aaaaa aaaaaa aaaaaa aaaaaa aaaab aaaab aaaab aaaab aaaab aaaab aaaab")] * 2
    found = spelling_groups(documents(rows, clash=True))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    wanted = plain_spelling(rows)
    assert collected(found) == wanted and sum(r[1] is not None for r in wanted) > 20


def test_spelling_of_nothing(documents):
    assert spelling_groups(documents([])).count() == 0
    assert collected(spelling_groups(documents([(1, "alone alone alone")]))) == [("alone", None, "alone", 3, 0, None)]


def test_entries_of_words_are_never_sent_whole_through_the_driver(spark, documents):
    words = spark.createDataFrame([("abcde", 3), ("abcdx", 9), ("other", 3)], "word string, n long")
    near = near_words(words)
    assert collected(near) == [("abcde", 3, "abcdx", 9), ("abcdx", 9, "abcde", 3)]
    groups = spelling_groups(documents([(1, "abcde abcdx " * 3 + "abcdx " * 6)]))
    for found in (near, groups):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_forms_are_followed_to_the_last(documents):
    words = {"abcdefgh": 3, "abcdefgx": 7, "abcdefyx": 15, "abcdezyx": 31, "abcdezy": 70}
    found = {r["word"]: r for r in spelling_groups(documents([(2, " ".join(w for w, n in words.items() for _ in range(n)))])).collect()}
    wanted = {r[0]: r for r in plain_spelling([(2, " ".join(w for w, n in words.items() for _ in range(n)))])}
    assert {w: tuple(r) for w, r in found.items()} == wanted
    assert found["abcdefgh"]["root"] == "abcdezy" and found["abcdefgh"]["form"] == "abcdefgx"


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(3)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(5, 12)))
        grams = sorted({word[i:i + 2] for i in range(len(word) - 1)})
        rng.shuffle(grams)
        prefix = gram_prefix(word, {g: i for i, g in enumerate(grams)})
        chosen = pivots(prefix)
        apart = [(a, b) for a, b in combinations(sorted(prefix, key=lambda g: g[1]), 2) if b[1] - a[1] >= 2]
        assert len(prefix) >= 3 and tuple(chosen) in apart
        assert sum(g[0] for g in chosen) == min(a[0] + b[0] for a, b in apart)


def test_every_near_pair_meets_under_a_pivot():
    rng = random.Random(4)
    grams = [a + b for a in "abcd" for b in "abcd"]
    rng.shuffle(grams)
    ranks = {g: i for i, g in enumerate(grams)}
    for _ in range(2000):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(5, 11)))
        k = rng.randrange(len(word))
        other = word[:k] + rng.choice(["", rng.choice("abcd"), rng.choice("abcd") + word[k]]) + word[k + 1:]
        if other == word or len(other) < 5:
            continue
        own, its = gram_prefix(word, ranks), gram_prefix(other, ranks)
        if own[-1][0] <= its[-1][0]:
            assert probe_keys(word, pivots(own)) & index_keys(other, its), (word, other)


def plain_repeats(rows, length=suffixes.LENGTH):
    texts = [(1 << 62 if i is None else i, (t or "").encode()) for i, t in rows]
    low = {}
    for doc, text in texts:
        for p in range(len(text) - length + 1):
            low[text[p:p + length]] = min(doc, low.get(text[p:p + length], doc))
    out = []
    for (i, _), (doc, text) in zip(rows, texts):
        gone = np.zeros(len(text), bool)
        for p in range(len(text) - length + 1):
            if low[text[p:p + length]] < doc:
                gone[p:p + length] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(bool(g) and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        out.append((i, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def repeated_rows():
    rng = random.Random(11)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijklmnop é😀") for _ in range(rng.randint(1, 9))) for _ in range(n))

    passages = [words(n) for n in (9, 12, 30, 120)]
    rows = [(i, words(rng.randint(0, 40))) for i in range(40)]
    rows += [(100 + i, words(5) + rng.choice(passages) + words(rng.randint(0, 9)) + rng.choice(passages)[3:-3]) for i in range(80)]
    copy = words(60)
    rows += [(200 + i, copy if i % 3 else copy[:k] + "#" + copy[k + 1:]) for i in range(25) for k in [rng.randrange(len(copy))]]
    rows += [(300, "ab" * 400), (301, "ab" * 300 + "c" + "ba" * 60), (302, "a" * 49), (303, "a" * 49), (304, "b" * 50), (305, "b" * 50), (306, "b" * 51)]
    rows += [(None, passages[3]), (None, passages[3]), (7, passages[2]), (7, passages[2]), (7, passages[2] + "!"), (400, None), (401, ""), (None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("bucket", [suffixes.BUCKET, 2])
def test_repeats_equal_brute_force(documents, monkeypatch, bucket):
    monkeypatch.setattr(suffixes, "BUCKET", bucket)  # 2: nearly all buckets are split
    rows = repeated_rows()
    found = remove_repeats(documents(rows, clash=True).repartition(5))
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    wanted = plain_repeats(rows)
    assert collected(found) == wanted and sum(r[3] > 1 for r in wanted) > 10


def test_repeats_of_nothing_and_of_a_very_long_text(documents):
    assert remove_repeats(documents([])).count() == 0
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh ") for _ in range(400_000))
    rows = [(1, long[200_000:200_060]), (2, long), (3, long[65_500:65_600])]
    assert [r[2:4] for r in collected(remove_repeats(documents(rows)))] == [(0, 0), (60, 1), (100, 1)]


@pytest.mark.parametrize("bucket", [suffixes.BUCKET, 2])
def test_repeat_groups_have_all_their_places(documents, monkeypatch, bucket):
    monkeypatch.setattr(suffixes, "BUCKET", bucket)
    rows = [r for r in repeated_rows() if r[0] is not None and r[0] not in (7, 301)]
    texts = {i: (t or "").encode() for i, t in rows}
    groups = defaultdict(set)
    for r in repeat_groups(documents(rows, clash=True).repartition(4)).collect():
        groups[r["group"], r["size"]].add((r["doc_id"], r["first"]))
    holding, covered = defaultdict(set), defaultdict(set)
    for i, t in texts.items():
        for p in range(len(t) - suffixes.LENGTH + 1):
            holding[t[p:p + suffixes.LENGTH]].add((i, p))
    for (_, size), places in groups.items():
        i, p = min(places)
        repeat = texts[i][p:p + size]
        assert size >= suffixes.LENGTH and len(places) > 1
        everywhere = {(j, q) for j, q in holding[repeat[:suffixes.LENGTH]] if texts[j][q:q + size] == repeat}
        assert places == everywhere  # not just neighbours
        for j, q in places:
            covered[j].update(range(q, q + size - suffixes.LENGTH + 1))
    for places in holding.values():
        if len({texts[i] for i, _ in places}) > 1:
            assert all(p in covered[i] for i, p in places)


def test_equal_windows_have_equal_buckets():
    rng = random.Random(8)
    text = bytes(rng.choice(b"abcab ") for _ in range(70_000)) + b"z" * 500

    def of(text):
        return [b for b, _, n in zip(*map(np.ndarray.tolist, window_runs(text))) for _ in range(n)]

    whole = of(text)
    assert len(whole) == len(text) - 49
    assert max(window_runs(text)[2]) <= suffixes.PIECE
    for at in (0, 1, 777, 65_530, 65_536):
        assert of(text[at:at + 400]) == whole[at:at + 351]
    assert of(b"") == of(b"a" * 49) == []


def test_intervals_are_maximal_repeats():
    rng = random.Random(6)
    pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randint(4, 14))) for _ in range(30)]
    pieces = list(dict.fromkeys(pieces))
    array = SuffixArray(pieces, 4)
    tree = Intervals(array, np.arange(len(pieces)))
    groups = {}
    for node, size in enumerate(tree.length):
        members = [(int(array.piece[i]), int(array.offset[i])) for i in range(tree.low[node], tree.high[node] + 1)]
        first = members[0]
        groups[pieces[first[0]][first[1]:first[1] + size]] = (set(members), tree.diverse[node], tree.owner[node])
    places = defaultdict(set)
    for i, p in enumerate(pieces):
        for a in range(len(p)):
            for b in range(a + 4, len(p) + 1):
                places[p[a:b]].add((i, a))

    def grown(s, after):
        following = {(pieces[i][a + len(s):a + len(s) + 1] if after else pieces[i][a - 1:a] if a else b"") for i, a in places[s]}
        return len(following) > 1 or following == {b""}

    wanted = {s: (at, grown(s, False), min(i for i, _ in at)) for s, at in places.items() if len(at) > 1 and grown(s, True)}
    assert set(groups) == set(wanted)
    for s, (members, diverse, owner) in groups.items():
        assert members == wanted[s][0] and owner == wanted[s][2]
        if diverse != wanted[s][1]:  # the start of a piece counts as a byte of its own
            assert diverse and any(a == 0 for _, a in members)


def plain_masks(rows, labels):
    first, good, toxic, out = {}, set(), set(), defaultdict(Counter)
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, q, x in labels:
        good |= {i} if q == 1 else set()
        toxic |= {i} if x == 1 else set()
    for i, t, source in rows:
        t = t or ""
        words = re.findall("[^ \t-\r]+", t)
        fails = (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 bool(re.search("[#$%&*|]", t)), i is not None and first[t] < i)
        mask = sum(1 << k for k, f in enumerate(fails) if f)
        known = i is not None
        for k, n in enumerate((1, known and i in good, known and i in toxic)):
            out[source or ""][mask, k] += int(n)
    return {part: {m: tuple(c[m, k] for k in range(3)) for m, _ in c} for part, c in out.items()}


def plain_audit(masks):
    share, rows = Counter(), []
    for order in permutations(FILTERS):
        left = dict(masks)
        for step, f in enumerate(order):
            bit = 1 << FILTERS.index(f)
            gone = {m: w for m, w in left.items() if m & bit}
            left = {m: w for m, w in left.items() if not m & bit}
            n, good, toxic = (sum(w[k] for w in gone.values()) for k in range(3))
            share[f] += n
            rows.append(("".join(order), step + 1, sum(w[0] for w in left.values()), n, sum(w[0] for m, w in masks.items() if m & bit) - n,
                         masks.get(bit, (0, 0, 0))[0], good, toxic, f))
    return sorted((*r[:-1], share[r[-1]]) for r in rows)


def test_diagrams_equal_brute_force():
    rng = random.Random(1)
    for _ in range(40):
        masks = {m: (rng.randint(1, 3), rng.randint(0, 2), rng.randint(0, 1)) for m in rng.sample(range(32), rng.randint(1, 32))}
        assert audit_part(masks) == plain_audit(masks)


def test_swaps_visit_every_order_and_keep_every_weight():
    orders = [list(FILTERS)]
    masks = {m: (m + 1, m % 2, 1) for m in range(0, 32, 3)}
    diagram = Diagram(masks)
    for level in adjacent_swaps(len(FILTERS)):
        diagram.swap(level)
        orders.append(list(diagram.order))
        assert diagram.root.weight == tuple(map(sum, zip(*masks.values())))
        assert all(len(nodes) <= 2 ** i for i, nodes in enumerate(diagram.levels))
    assert sorted(map(tuple, orders)) == sorted(permutations(FILTERS))


def test_audit_equals_brute_force(spark):
    rng = random.Random(9)
    long = [" ".join(f"w{rng.randint(0, n)}" for _ in range(70)) for n in (5, 500, 900)]
    texts = [None, "", *long, long[1].upper(), long[1].title(), long[1] + " #", "\n".join(long[1].split()), "é" * 30_000, long[2] * 300]
    rows = [(rng.choice([None, rng.randint(0, 60)]) if rng.random() < 0.2 else i, rng.choice(texts), rng.choice(["a", "b", "", None])) for i in range(200)]
    rows += [(3, long[0], "a"), (3, long[0], "a"), (4, long[0], "c")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (9999, 1, 1)]
    docs = spark.createDataFrame([(i, t, None, s, 7) for i, t, s in rows], "doc_id long, text string, mask int, source string, part int")
    found = audit_filters(docs, spark.createDataFrame(labels, LABELS))
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    wanted = [(part, *row) for part, masks in plain_masks(rows, labels).items() for row in plain_audit(masks)]
    assert collected(found) == sorted(wanted, key=repr)


def test_audit_of_nothing(spark, documents):
    assert audit_filters(documents([]), spark.createDataFrame([], LABELS)).count() == 0
    assert audit_filters(documents([(1, None)]), spark.createDataFrame([], LABELS)).count() == 600
