"""Op 6: the count bounds of long texts."""
import os
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from faultline.llm import jaccard  # noqa: E402


def test_points_tell_long_unrelated_sets_apart():
    """200 unrelated sets of 5,000 shingles that share one: under 1 % of the pairs are emitted (with 64 groups, all)."""
    rng = np.random.default_rng(3)
    sets = [np.unique(np.concatenate((rng.integers(0, 2**63, 5000, np.int64), [7])).view(np.uint64)) for _ in range(200)]
    at, n = jaccard.points(sets).astype(np.int32), np.array([len(s) for s in sets])
    found = sum(len(x) for x, _ in jaccard._open(np.arange(200), None, at, n, np.arange(200)))
    assert found < 0.01 * 200 * 199 / 2


def test_linked_sets_differ_by_one_grade_and_pass_the_bound():
    rng = np.random.default_rng(4)
    for size in (3, 60, 700, 1024, 1025, 2047, 2049, 9000):
        whole = np.unique(rng.integers(0, 2**63, size, np.int64).view(np.uint64))
        part = whole[rng.permutation(len(whole))[:max(1, -(-len(whole) * 4 // 5))]]
        part.sort()
        a, b = jaccard.grade(np.array([len(part), len(whole)]))
        assert 0 <= b - a <= 1
        at = jaccard.points([part, whole])
        assert np.minimum(at[0], at[1]).sum() >= len(part) >= jaccard.least_overlap(np.array([len(part)]), np.array([len(whole)]))[0]
        assert (at.sum(1) == [len(part), len(whole)]).all()


def test_long_near_copies_are_linked():
    from faultline.session import get_session
    spark = get_session("local[4]", 4, app="faultline-tests")
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in rng.integers(0, 10**6, 9000)]
    rows = []
    for i in range(12):  # chains of near copies of 700 to 1500 words that cross the grades
        n = 700 + i * 70
        rows.append((i, " ".join(words[:n])))
    rows += [(100 + i, " ".join(f"x{j}" for j in rng.integers(0, 10**6, 2000))) for i in range(20)]
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}

    def sets(t):
        w = t.split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    every = {d: sets(t) for d, t in rows}
    label = {d: d for d in every}
    for _ in range(len(every)):
        for a in every:
            for b in every:
                if 100 * len(every[a] & every[b]) >= 80 * len(every[a] | every[b]):
                    label[a] = label[b] = min(label[a], label[b])
    assert got == label
