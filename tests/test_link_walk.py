"""Linkage against walks in order over plain rows, with unspaced names."""

import random
import re

import pytest

from lorebase.operators import components, link, walk
from lorebase.sources.tables import materialise

NEW = "id long, stem string, name string, case_date string, chief_complaint string"
OLD = "id long, patient_id string, case_date string, chief_complaint string"


def plain(name):
    return re.sub(r"\s+", " ", re.sub(r"[,.\-']", " ", name.lower())).strip()


def key_of(pid):
    m = re.match(r"^(.+?)\s+\d{8}$", pid)
    return plain(m[1].strip() if m else pid.strip())


def grouped(old, key):
    out = {}
    for i, pid, day, complaint in sorted(old):
        out.setdefault(key(pid), []).append((i, day, complaint))
    return out


def clinical(new, old):
    cases, used, out = grouped(old, key_of), set(), []
    free = lambda fits: next((i for k, rows in cases.items() if fits(k) for i, *_ in rows if i not in used), None)
    for n, stem, name, day, _ in sorted(new):
        s, hit = plain(stem), None
        if s in cases:
            hit = next((i for i, d, _ in cases[s] if day and d and d == day), None) or next((i for i, *_ in cases[s] if i not in used), None)
        hit = hit or free(lambda k: k in s or s in k)
        hit = hit or (free(lambda k: k in plain(name) or plain(name) in k) if name else None)
        if hit:
            used.add(hit)
            out.append((n, hit))
    return sorted(out)


def by_stem(new, old):
    cases, used, out = grouped(old, lambda p: p), set(), []
    rows = [r for group in cases.values() for r in group]
    free = lambda fits, among: next((r[0] for r in among if r[0] not in used and fits(r)), None)
    for n, stem, _, day, complaint in sorted(new):
        hit = free(lambda r: True, cases.get(stem, []))
        hit = hit or (free(lambda r: r[1] == day, rows) if day else None)
        hit = hit or (free(lambda r: r[2] and complaint[:50] in r[2], rows) if complaint else None)
        if hit:
            used.add(hit)
            out.append((n, hit))
    return sorted(out)


def tables(seed):
    r = random.Random(seed)
    names = ["王小明", "王小明医案", "小明", "李", "李四", "张李四", "Ann", "Joanna", "Jo-Anna", "O'Neil", "欧阳修文公子", "欧阳修文"]
    text = "头痛三日，发热恶寒，无汗而喘，脉浮紧，身疼腰痛，骨节疼痛，恶风。" * 3
    cut = lambda: text[(a := r.randrange(40)) : a + r.choice((1, 3, 6, 20, 55, 70))] if r.random() < 0.6 else ""
    day = lambda: r.choice(("", "2020-1-1", "2020-1-2", "2020-1-3"))
    new = [(k, r.choice(names), r.choice([*names, ""]), day(), cut()) for k in range(1, 15)]
    old = [(k, r.choice(names) + r.choice(("", " 20200102")), day(), cut()) for k in range(50, 64)]
    return new, old


@pytest.mark.parametrize("seed", range(3))
def test_walks(spark, seed):
    new, old = tables(seed)
    a, b = spark.createDataFrame(new, NEW).coalesce(1), spark.createDataFrame(old, OLD).coalesce(1)
    pairs = lambda df: sorted((x["new_id"], x["old_id"]) for x in df.collect())
    assert pairs(link.link_clinical(a, b)) == clinical(new, old)
    assert pairs(link.link_by_stem(a, b)) == by_stem(new, old)


def test_unspaced_names_dates_and_inner_complaints(spark):
    new = [(1, "", "王小明", "", ""), (2, "", "Ann", "", ""), (3, "", "甲", "2020-1-1", ""), (4, "", "乙", "", "头痛")]
    old = [(11, "王小明医案", "", ""), (12, "Joanna", "", ""), (13, "丙", "2020-1-1", ""), (14, "丁", "", "昨日头痛三日")]
    got = link.link(spark.createDataFrame(new, NEW), spark.createDataFrame(old, OLD)).collect()
    assert sorted(map(tuple, got)) == [(1, 11, 2), (2, 12, 2), (3, 13, 3), (4, 14, 4)]


def test_ranks_against_a_walk_over_all_pairs(spark):
    r = random.Random(7)
    names, days = ["王小明", "李四", "张李四", "Ann", "Joanna", ""], ["", "2020-1-1", "2020-1-2"]
    new = [(k, "", r.choice(names), r.choice(days), r.choice(["", "头痛", "发热三日"])) for k in range(1, 41)]
    old = [(k, r.choice(names[:5]) + r.choice(("", " 20200102")), r.choice(days), r.choice(["", "头痛三日，发热三日"])) for k in range(50, 85)]

    def rank(n, o):
        a, b = plain(n[2]), key_of(o[1])
        if a == b:
            return 0 if n[3] and n[3] == o[2] else 1
        if a and (a in b or b in a):
            return 2
        return 3 if n[3] and n[3] == o[2] else 4 if n[4] and n[4][:50] in o[3] else None

    used, want = set(), []
    for k, n, o in sorted((k, n[0], o[0]) for n in new for o in old if (k := rank(n, o)) is not None):
        if not used & {("n", n), ("o", o)}:
            used |= {("n", n), ("o", o)}
            want.append((n, o, k))
    got = link.link(spark.createDataFrame(new, NEW), spark.createDataFrame(old, OLD)).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_numbers_within_a_key(spark):
    rows = spark.createDataFrame([(k % 3 and 1, k) for k in range(500)], "k long, id long")
    got = link.numbered(rows, ["k"], "id").collect()
    for key in (0, 1):
        assert [x["__no"] for x in sorted(got, key=lambda x: x["id"]) if x["k"] == key] == list(range(1, 1 + sum(x["k"] == key for x in got)))


@pytest.mark.parametrize("seed", (3,))
def test_walks_in_rounds(spark, monkeypatch, seed):
    """Components too large for one task go through rounds, with the same links."""
    monkeypatch.setattr(walk, "MAX_COMPONENT", 0)
    new, old = tables(seed)
    a, b = spark.createDataFrame(new, NEW).coalesce(1), spark.createDataFrame(old, OLD).coalesce(1)
    assert sorted((x["new_id"], x["old_id"]) for x in link.link_clinical(a, b).collect()) == clinical(new, old)


def test_walks_in_blocks(spark, monkeypatch):
    """Blocks of a few new rows, which read a few old rows of a pool, give the links of the whole walk; their number of writes does not follow the pairs."""
    monkeypatch.setattr(walk, "MAX_COMPONENT", 0)
    monkeypatch.setattr(walk, "BLOCK", 30)
    writes, days = [], [f"2020-1-{k}" for k in range(1, 4)]
    monkeypatch.setattr(walk, "materialise", lambda df, tag="t": (writes.append(tag), materialise(df, tag))[1])
    r = random.Random(11)
    new = [(k, f"case {r.randrange(4)}", "", r.choice(["", *days]), r.choice(["", "pain", "old pain"])) for k in range(1, 121)]
    old = [(1000 + k, f"case {k}", r.choice(["", *days]), r.choice(["", "some old pain"])) for k in range(60)]
    a, b = spark.createDataFrame(new, NEW).coalesce(1), spark.createDataFrame(old, OLD).coalesce(1)
    assert sorted((x["new_id"], x["old_id"]) for x in link.link_by_stem(a, b).collect()) == by_stem(new, old)
    assert 2 <= writes.count("block") <= 5


def test_block_stops_where_a_pool_has_more_rows(spark, monkeypatch):
    """Rows of a pool that are taken by way of another one are not too few for the next new row: the walk goes on from it."""
    monkeypatch.setattr(walk, "BLOCK", 200)
    new = spark.createDataFrame([(k, "a" if k < 150 else "b") for k in range(1, 151)], "new_id long, c string")
    wants = spark.createDataFrame([("a", "p", 1), ("b", "q", 1)], "c string, pool string, rank int")
    holds = [("p", 1000 + k, k) for k in range(200)] + [("q", 1000 + k, k) for k in range(200)]
    got = walk.walked(new, wants, spark.createDataFrame(holds, "pool string, old_id long, place long"), max_component=0)
    assert sorted(map(tuple, got.collect())) == [(k, 999 + k, 1) for k in range(1, 151)]


def test_contained_names_in_blocks(spark, monkeypatch):
    """Names inside many others: what is left of all pools is looked up by the least first row, and no pair is written."""
    monkeypatch.setattr(walk, "MAX_COMPONENT", 0)
    monkeypatch.setattr(walk, "greedy", None)
    new = [(k, "", ("case 1", "case 12")[k % 2], "", "") for k in range(1, 41)]
    old = [(100 + k, f"case {(1, 12)[k % 2]}{k} more", "", "") for k in range(30)]
    left, want = {o[0]: o[1] for o in old}, []
    for n, _, name, *_ in new:
        fits = [i for i, k in left.items() if name in k]
        if fits:
            want.append((n, min(fits), 2))
            del left[min(fits)]
    got = link.link(spark.createDataFrame(new, NEW).coalesce(1), spark.createDataFrame(old, OLD).coalesce(1)).collect()
    assert sorted(map(tuple, got)) == want


def counted_writes(monkeypatch):
    n = []
    for module in (link, walk, components):
        monkeypatch.setattr(module, "materialise", lambda df, tag="t": (n.append(tag), materialise(df, tag))[1])
    return n


def test_ten_thousand_equal_names(spark, monkeypatch):
    r = random.Random(5)
    day = lambda: r.choice(("", "", *[f"2020-1-{k}" for k in range(1, 29)]))

    def case(n):
        return [(k, "李四", "李四", day(), "") for k in range(1, n + 1)], [(10**6 + k, "李四", day(), "") for k in range(n - n // 10)]

    writes, found = counted_writes(monkeypatch), []
    for n in (40, 10_000):
        new, old = case(n)
        writes.clear()
        links = link.link_clinical(spark.createDataFrame(new, NEW), spark.createDataFrame(old, OLD))
        got = sorted((x["new_id"], x["old_id"]) for x in links.collect())
        found.append(len(writes))
        assert got == clinical_fast(new, old)
    assert found[0] == found[1] < 30
    late = link.unmatched(spark.createDataFrame(new, NEW), links, 10).collect()
    linked = {n for n, _ in got}
    assert [x["id"] for x in late] == [k for k, *_ in new if k not in linked][:10]
    assert {x["metric"]: x["n"] for x in link.link_summary(spark.createDataFrame(new, NEW), spark.createDataFrame(old, OLD), links).collect()} == {
        "linked": len(got), "unmatched": len(new) - len(linked), "unused": len(old) - len({o for _, o in got})
    }


def clinical_fast(new, old):
    """The clinical walk where all names are one, with a pointer."""
    first, used, out, at = {}, set(), [], 0
    for i, _, day, _ in old:
        first.setdefault(day, i)
    for n, _, _, day, _ in new:
        hit = first.get(day) if day else None
        while hit is None and at < len(old):
            i = old[at][0]
            at, hit = (at + 1, None) if i in used else (at, i)
        if hit is not None:
            used.add(hit)
            out.append((n, hit))
    return out


def test_components(spark):
    r = random.Random(2)
    edges = [(f"n{r.randrange(80)}", f"n{r.randrange(80)}") for _ in range(60)] + [("z", "z"), ("y1", "y1"), ("y1", "y2")]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = components.components(spark.createDataFrame(edges, "a string, b string")).collect()
    assert {x["node"]: x["label"] for x in got} == label and len(got) == len(label)
    assert components.components(spark.createDataFrame([], "a string, b string")).count() == 0
