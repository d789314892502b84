"""The exact signed-rank test with ties and zero differences against all sign patterns."""

import itertools
import random

import pytest

from tallymark.operators.paired import paired_tests


def enumerated(diffs):
    d = [x for x in diffs if x]
    if not d:
        return None
    sizes = sorted(abs(x) for x in d)
    rank = {s: sizes.index(s) + (sizes.count(s) + 1) / 2 for s in sizes}
    ranks = [rank[abs(x)] for x in d]
    w = sum(r for r, x in zip(ranks, d) if x > 0)
    low = min(w, sum(ranks) - w)
    below = sum(sum(r for r, s in zip(ranks, signs) if s) <= low for signs in itertools.product((0, 1), repeat=len(d)))
    return min(1.0, 2 * below / 2 ** len(d))


def test_equals_enumeration(spark):
    rng = random.Random(6)
    groups = {g: [rng.choice([-3, -2, -1, -1, 0, 1, 2, 2, 5]) for _ in range(rng.randint(1, 12))] for g in range(40)}
    groups[40], groups[41] = [0, 0], [1, 1, 1, 1, 1]
    df = spark.createDataFrame([(g, float(x), 0.0) for g, xs in groups.items() for x in xs], "g int, a double, b double")
    got = {r.g: r for r in paired_tests(df, ["g"], "a", "b", method="exact").collect()}
    for g, xs in groups.items():
        wanted = enumerated(xs)
        assert got[g].wilcoxon_pvalue == (None if wanted is None else pytest.approx(wanted, abs=1e-12))
        assert got[g].wilcoxon_method == (None if wanted is None else "exact")


def test_large_tied_groups_stay_undefined_and_auto_stays(spark):
    df = spark.createDataFrame([(float(i % 7 - 2), 0.0) for i in range(80)], "a double, b double")
    (exact,) = paired_tests(df, [], "a", "b", method="exact").collect()
    assert exact.wilcoxon_pvalue is None and exact.wilcoxon_method is None
    (wide,) = paired_tests(df, [], "a", "b", method="exact", exact_limit=100).collect()
    (auto,) = paired_tests(df, [], "a", "b").collect()
    assert auto.wilcoxon_method == "normal" and abs(wide.wilcoxon_pvalue - auto.wilcoxon_pvalue) < 0.02
