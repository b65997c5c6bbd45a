"""Personal data, exact duplicates, lines and shards, each against plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tongues.llm.exact import exact_groups
from tongues.llm.lines import LineRuns, absorb_table, batch_cuts, dedup_lines
from tongues.llm.pii import BASE, IBAN_LENGTHS, find_personal_data, iban_pattern, personal_data
from tongues.llm.sharding import MULTIPLIER, assign_shards, shard_documents

UPPER = {c: c + 32 for c in range(65, 91)}
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    out = []
    for k, (name, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": name == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[name]
            if good:
                out.append((m.start(), k, f"{name}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


TEXTS = [
    None, "", "nothing here", "a@b.co", "mail x.y+z@mail-1.example.com. and a@b.c_d@e.f", "é日😀 a@b.cc 😀 c@d.ee",
    "1.2.3.4 300.1.1.1 0.0.0.0255 1.2.3.4.5.6.7.8 000.00.0.0 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112",
    "4111  1111 1111 1111", "41111111111111111111111 5", "79927398713 000000000000 0000-0000 0000",
    "+1 (743) 555-3824, ++49.30.123456- +1 2 +123456789012345678", "+1((((", "+49 170 1234567 1.1.1.1 x@y.zz 4012888888881881",
    "a" * 20_000, "1" * 20_000, "a@b" + ".c" * 9_000, "+" * 500 + "1" * 30, " ".join(f"u{i}@x{i}.org 10.0.{i % 256}.{i % 300}" for i in range(700)),
]


def test_base_spans_equal_plain_regular_expressions(documents):
    rows = {r["doc_id"]: r for r in personal_data(documents(list(enumerate(TEXTS)), clash=True)).collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        wanted = base_spans(text or "")
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(wanted).encode()).hexdigest(), (i, rows[i]["spans"], wanted)
        counts = Counter(s.split(":")[0] for s in wanted)
        assert [rows[i][f"n_{n}"] for n in BASE] == [counts[n] for n in BASE]
        kept = [s for s in rows[i]["spans"].split(",") if s and s.split(":")[0] in BASE]
        assert kept == wanted
        assert len(rows[i]["scores"].split(",")) == len(rows[i]["spans"].split(","))


@pytest.mark.parametrize(("text", "spans"), [
    ("konto DE89 3704 0044 0532 0130 00 BIC X", "iban:6:33"),
    ("GB82WEST12345698765432", "iban:0:22"),
    ("GB82WEST12345698765433", ""),
    ("xGB82WEST12345698765432", ""),
    ("my ssn is 078-05-1120 ok", "ssn:10:21"),
    ("number 078-05-1120 ok", ""),
    ("social security 000-05-1120", ""),
])
def test_added_kinds_need_checksum_or_context(documents, text, spans):
    assert personal_data(documents([(1, text)])).first()["spans"] == spans


def test_context_raises_the_score(documents):
    rows = find_personal_data(documents([(1, "10.1.1.1"), (2, "server 10.1.1.1")])).sort("doc_id").collect()
    assert rows[0]["personal"][0]["score"] < rows[1]["personal"][0]["score"]


def test_iban_pattern_covers_every_country():
    for country, length in IBAN_LENGTHS.items():
        assert re.fullmatch(iban_pattern(), country + "0" * (length - 2))


def test_empty_tables(documents):
    none = documents([])
    for found in (personal_data(none), exact_groups(none), exact_groups(none, True), shard_documents(none), dedup_lines(none)):
        assert found.count() == 0


def test_exact_groups_equal_plain_python(documents):
    texts = ["Abc", "aBC", "abc", "ÀBC", "àbc", None, "", "x" * 200 + "a", "x" * 200 + "b", "X" * 200 + "A", "y" * 100_000, "Y" * 100_000, "abd"]
    rows = [(i * 3 % 13, t) for i, t in enumerate(texts)] + [(100, "abc"), (100, "abc"), (None, "abc"), (None, "lone"), (None, "pair"), (None, "pair")]
    for digest in (True, False):
        groups = defaultdict(list)
        for i, t in rows:
            groups[(t or "").translate(UPPER)].append(i)
        wanted = Counter()
        for text, ids in groups.items():
            keep = max((i for i in ids if i is not None), default=None)
            for n, i in enumerate(sorted(ids, key=lambda i: i == keep, reverse=True)):
                wanted[i, keep, len(ids), n == 0, hashlib.sha256(text.encode()).hexdigest()] += 1
        found = exact_groups(documents(rows, clash=True), digest).collect()
        got = Counter(tuple(r) for r in found)
        if digest:
            assert got == wanted
        else:
            assert Counter(k[:4] for k in got.elements()) == Counter(k[:4] for k in wanted.elements())
            assert all(r["text_sha256"] is not None for r in found if r["group_size"] > 1)


def plain_lines(rows):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)

    owner = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            owner[key(line)] = min(owner.get(key(line), i), i)
    out = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 10 or owner[key(x)] == i]
        out[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


LINES = [
    (7, "A common first line\nshort\nown line of seven"), (3, "\ta COMMON first line \r\nshort\nA common first line"), (9, None), (4, ""),
    (5, "éèê common ünïcode\nx"), (6, "ÉÈÊ common ünïcode\néèê COMMON ünïcode"), (8, "\n\n"), (2, "0123456789"), (12, "0123456789\n012345678"),
    (12, "0123456789\n012345678"), (12, "another text of twelve\n0123456789"), (20, "a common first line"), (21, "\n".join(["0123456789", "z"] * 3000)),
]


@pytest.mark.parametrize("batches", [1, 3, 5])
def test_lines_equal_plain_python(documents, batches):
    found = dedup_lines(documents(LINES, clash=True), batches).collect()
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in found) == plain_lines(LINES)


def test_null_ids_come_last(documents):
    found = {r["doc_id"]: r for r in dedup_lines(documents([(None, "the very same line"), (1, "the very same line")])).collect()}
    assert found[1]["n_dropped"] == 0 and found[None]["n_dropped"] == 1


def test_runs_are_compacted_and_hold_each_hash_once(documents):
    runs = absorb_table(documents([(i, f"line number {i % 7} of all\nline number {i} of this") for i in range(40)]), batches=5)
    assert isinstance(runs, LineRuns) and all(len(level) < runs.fanout for level in runs.levels) and len(runs.levels) == 3
    hashes = runs.runs()
    assert hashes.count() == hashes.select("h1", "h2").distinct().count() == 7 + 40


def test_old_runs_are_neither_exchanged_nor_sorted(documents):
    from tongues.llm.lines import _ordered_scans
    runs = absorb_table(documents([(i, f"a line that all have\nline number {i} of this") for i in range(40)]), batches=3)
    more = documents([(i, f"a line that all have\nanother line {i} of this") for i in range(100, 140)])
    with _ordered_scans(runs.spark):
        fresh = runs.unknown(more)
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Bucketed: true") == len(runs.levels) == 2
        assert plan.count("Exchange hashpartitioning") == 1 and plan.count("+- Sort ") + plan.count(":- Sort ") == 1
        # the exchange is that of the aggregation, below the joins
        assert plan.index("LeftAnti") < plan.index("functions=[min(") < plan.index("Exchange") < plan.index("partial_min")
        merged = runs.merged([p for level in runs.levels for p in level])
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort " not in plan and "SortMergeJoin" in plan
        assert merged.count() == 41 and fresh.count() == 40
    runs.absorb(more)
    assert runs.runs().count() == 81 and runs.runs().select(F.input_file_name()).distinct().count() <= 2 * runs.buckets
    runs.close()


@pytest.mark.parametrize("buckets", [None, 3])
def test_batches_in_any_order_and_sessions(documents, buckets):
    parts = [[r for r in LINES if r[0] % 3 == k] for k in (2, 0, 1)]
    runs = LineRuns(documents([]).sparkSession, buckets=buckets)
    runs.absorb(documents(parts[0]))
    runs.close()
    runs = LineRuns(runs.spark, buckets=runs.buckets, levels=runs.levels)
    for part in (*parts[1:], parts[0], []):
        runs.absorb(documents(part))
    found = runs.apply(documents(LINES)).collect()
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in found) == plain_lines(LINES)
    runs.close()


def test_more_runs_a_level(documents):
    runs = LineRuns(documents([]).sparkSession, fanout=3)
    for part in range(5):
        runs.absorb(documents([(i, f"line number {i % 7} of all\nline number {i} of this") for i in range(part * 8, part * 8 + 8)]))
    assert [len(level) for level in runs.levels] == [2, 1]
    assert runs.runs().count() == runs.runs().select("h1", "h2").distinct().count() == 7 + 40
    runs.close()


def test_batches_have_about_as_many_rows(documents):
    ids = [*range(60), 10**9, *range(10**12, 10**12 + 29)]
    cuts = batch_cuts(documents([(i, "x") for i in ids]), 3)
    sizes = [sum(low <= i < high for i in ids) for low, high in zip([0, *cuts], [*cuts, 10**13])]
    assert len(sizes) == 3 and all(28 <= n <= 32 for n in sizes)
    assert batch_cuts(documents([]), 3) == batch_cuts(documents([(None, "x")]), 3) == []


def jump(key, n):
    at, ahead, key = -1, 0, key % 2**64
    while ahead < n:
        at = ahead
        key = (key * MULTIPLIER + 1) % 2**64
        ahead = int((at + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return at


def test_jump_hash_and_slots(documents):
    ids = [0, 1, 2, 3, 2**63 - 1, -1, -(2**63), 10**12, 5, 5, 5, *range(100, 400)]
    rows = [(i, f"text {i % 9}") for i in ids] + [(None, None), (None, ""), (8, "é")]
    found = shard_documents(documents(rows, clash=True)).collect()
    assert len(found) == len(rows)
    slots = defaultdict(list)
    for r in found:
        assert (r["shard"], r["grown_shard"]) == (jump(r["doc_id"] or 0, 40), jump(r["doc_id"] or 0, 41))
        assert r["grown_shard"] in (r["shard"], 40)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (i, 16 + len((t or "").encode()), zlib.crc32((t or "").encode())) for i, t in rows)


@pytest.mark.parametrize("shards", [1, 2, 7, 1000])
def test_any_number_of_shards(spark, shards):
    found = assign_shards(spark.range(200).withColumnRenamed("id", "k"), "k", shards).collect()
    assert all((r["shard"], r["grown_shard"]) == (jump(r["k"], shards), jump(r["k"], shards + 1)) for r in found)
