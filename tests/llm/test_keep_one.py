"""One row of each component, with repeated rows, ids of two texts and null ids."""

from collections import defaultdict

from lorebase.llm import jaccard_join
from tests.llm.fixtures import documents, frame
from tests.llm.test_jaccard_join import brute_force, shingles


def test_one_row_of_each_component(spark):
    rows = documents()
    # other ids, so that brute force tells components apart whatever their ids are
    groups = defaultdict(list)
    for row, (_, n, c) in zip(rows, brute_force([(k, *r[1:]) for k, r in enumerate(rows)])):
        if n:
            groups[c].append(row)
    unknown = "only here one two three four five six seven"
    extra = [(None, unknown, *rows[0][2:])] * 3 + [(1, unknown + " x", *rows[0][2:]), (5000, "p q r s t u", "en", "b", *rows[0][4:]), (5000, "p q r s t u", "en", "a", *rows[0][4:])]
    got = [tuple(r) for r in jaccard_join.keep_one(frame(spark, rows + extra)).collect()]
    for group in groups.values():
        here = [r for r in got if r in group]
        least = min((r[0] for r in group if r[0] is not None), default=None)
        assert len(here) == 1 and here[0][0] == least
    assert sorted(r[:2] for r in got if r[1] and (unknown in r[1] or r[1].startswith("p q"))) == [(1, unknown + " x"), (5000, "p q r s t u")]
    assert [r[3] for r in got if r[0] == 5000] == ["a"]
    assert sum(not shingles(r[1]) for r in got) == sum(not shingles(r[1]) for r in rows)
    assert len(got) == len(groups) + 2 + sum(not shingles(r[1]) for r in rows)


def test_null_ids_alone(spark):
    rows = [(None, "a b c d e f g", *documents()[0][2:])] * 4
    assert jaccard_join.keep_one(frame(spark, rows)).count() == 1
