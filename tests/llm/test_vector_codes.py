"""Vector codes against plain Lloyd in whole numbers."""

import math
import random

import numpy as np
import pytest
from gridmart.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, part int, x string, is_state string, codes string"


def plain_codes(rows, parts, entries, rounds):
    """(id, codes, distances) of (id, vector) rows in seed order, and the codebooks; every part against every entry."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max(1, -(-max((len(v) for _, v in kept), default=0) // parts))
    bound = vector_codes.largest_component(width)
    whole = [(i, [max(-bound, min(bound, math.floor(1024 * x))) for x in v] + [0] * (parts * width - len(v))) for i, v in kept]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in whole]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    for k in range(rounds + 1):
        far = [[min((sum((a - b) ** 2 for a, b in zip(c[p], e)), j) for j, e in enumerate(books[p])) for p in range(parts)] for c in cut]
        if k == rounds:
            return [(i, [j for _, j in f], [d for d, _ in f]) for (i, _), f in zip(whole, far)], books
        for p in range(parts):
            for j in range(len(books[p])):
                own = [c[p] for c, f in zip(cut, far) if f[p][1] == j]
                if own:
                    books[p][j] = [sum(x) // len(own) for x in zip(*own)]


def vectors(seed, n, size, grid):
    """Few different components, so that distances tie and vectors repeat."""
    r = random.Random(seed)
    return [(i, [r.randint(-grid, grid) / 64 for _ in range(size)]) for i in range(n)]


@pytest.mark.parametrize("size, parts, entries, rounds", [(8, 4, 16, 4), (8, 4, 16, 0), (10, 4, 7, 3), (3, 2, 256, 2), (4, 1, 9, 6)])
def test_encode(spark, size, parts, entries, rounds):
    rows = vectors(size, 150, size, 3)
    rows += [(40, rows[7][1]), (41, rows[7][1]), (41, rows[7][1]), (None, rows[9][1]), (None, rows[3][1]), (300, [0.5]), (301, []), (302, None), (303, [None] * size), (304, [math.nan] * size), (305, [math.inf] * size), (306, [1e30, -1e30] + [0.0] * (size - 2)), (-5, [-0.01] * size)]
    data = spark.createDataFrame([(i, v, i and i % 3, 1, "x", "s", "c") for i, v in rows], SCHEMA).repartition(4)
    found = vector_codes.encode(data, carry=("label",), parts=parts, entries=entries, rounds=rounds)
    want, books = plain_codes([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows], parts, entries, rounds)
    assert found.codebooks.tolist() == books
    got = [(r.vec_id, r.codes, r.distances) for r in found.rows.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and found.rows.columns == ["vec_id", "label", "codes", "distances"]


def test_empty_table(spark):
    found = vector_codes.encode(spark.createDataFrame([], SCHEMA))
    assert found.rows.count() == 0 and found.codebooks.shape == (4, 0, 1)


def test_only_moved_entries_are_compared_and_ties_go_to_the_lower_index():
    r = np.random.default_rng(1)
    for trial in range(200):
        entries, x = r.integers(-3, 4, (12, 2)), r.integers(-3, 4, (60, 2))
        code, distance = vector_codes.reassign(x, entries, np.ones(12, bool), np.full(60, -1), np.zeros(60, np.int64))
        after, moved = entries.copy(), r.random(12) < 0.3
        after[moved] = r.integers(-3, 4, (int(moved.sum()), 2))
        got = vector_codes.reassign(x, after, moved, code, distance)
        every = vector_codes.distances(x, after)
        assert (got[0] == every.argmin(axis=1)).all() and (got[1] == every.min(axis=1)).all()


def test_compares_parts_of_fixed_entries_with_moved_ones_only(monkeypatch):
    seen, whole = [], vector_codes.distances
    monkeypatch.setattr(vector_codes, "distances", lambda x, entries: seen.append(entries.shape) or whole(x, entries))
    x = np.array([[0, 0], [10, 10]])
    moved = np.array([False, True, False])
    vector_codes.reassign(x, np.array([[0, 0], [9, 9], [50, 50]]), moved, np.array([0, 1]), np.array([0, 0]))
    assert seen == [(3, 2), (1, 2)]


def test_distances_are_exact_at_the_bound():
    bound = vector_codes.largest_component(16)
    x, entries = np.full((1, 16), bound, np.int32), np.array([[-bound] * 16, [bound - 1] * 16])
    assert vector_codes.distances(x, entries).tolist() == [[16 * (2 * bound) ** 2, 16]]
