import random
from collections import Counter

from lorebase.llm import jaccard_join
from tests.llm.fixtures import documents, frame, prose

SEPARATORS = " \t\n\x0b\x0c\r"


def shingles(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in SEPARATORS[1:]:
        lower = lower.replace(c, " ")
    w = [x for x in lower.split(" ") if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_force(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), least.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)]


def test_against_brute_force(spark):
    rows = documents()
    got = jaccard_join.jaccard_components(frame(spark)).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(brute_force(rows))


def test_short_sets_near_the_threshold(spark):
    r = random.Random(9)
    rows = []
    for _ in range(40):
        base = prose(r, r.randint(5, 40)).split(" ")
        for _ in range(4):
            cut = base[: max(1, len(base) - r.randint(0, 9))]
            if r.random() < 0.5:
                cut = cut[r.randint(0, 3) :]
            rows.append((len(rows), " ".join(cut), "en", "s", 0, *["x"] * 9))
    got = jaccard_join.jaccard_components(frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert Counter(map(tuple, got)) == Counter(brute_force(rows))


def test_prefix_subsets_are_enough():
    for n in range(1, 60):
        for m in range(n, 60):
            need = -(-3 * (n + m) // 7)
            if need <= n and 4 * n >= 3 * m:
                for k in (1, 2):
                    assert n - need + k <= n - -(-3 * n // 4) + k and m - need + k <= m - -(-3 * m // 4) + k


def test_light_and_heavy_paths(spark):
    """Any boundary gives the same links."""
    rows = documents()
    want = Counter(brute_force(rows))
    chosen = jaccard_join.boundary
    try:
        for x in (0, 20, 64):
            jaccard_join.boundary = lambda sets, x=x: x
            got = jaccard_join.jaccard_components(frame(spark)).select("doc_id", "n_shingles", "component_id").collect()
            assert Counter(map(tuple, got)) == want, x
    finally:
        jaccard_join.boundary = chosen


def test_keep_one_and_empty(spark):
    rows = [r for r in documents() if r[0] is not None and r[0] != 1]
    kept = jaccard_join.keep_one(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    want = sorted(d for d, n, c in brute_force(rows) if d == c or n == 0)
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    assert jaccard_join.jaccard_components(frame(spark, [])).count() == 0
