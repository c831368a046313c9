"""The n best of every line, tile by tile, against sorting everything."""

import numpy as np
import pytest

from tillsight.operators.nearest import Best


@pytest.mark.parametrize("kind", [np.int64, np.float64])
@pytest.mark.parametrize("n, columns", [(1, 30), (4, 90), (40, 30)])
def test_tiles_equal_one_sort(kind, n, columns):
    rng = np.random.default_rng(n)
    matrix = rng.integers(-3, 4, (17, columns)).astype(kind)  # many ties
    names = rng.permutation(columns)
    best = Best(17, n, kind)
    for start in range(0, columns, 13):
        tile = matrix[:, start:start + 13]
        line, column = best.reaching(np.arange(17), tile, best.limit)
        best.keep(line, tile[line, column], names[start + column])
    line, place = best.entries()
    got = {(int(a), int(p), best.scores[a, p].item(), int(best.names[a, p])) for a, p in zip(line, place, strict=True)}
    want = {(i, p, s, c) for i in range(17)
            for p, (s, c) in enumerate([(-s, c) for s, c in sorted((-matrix[i, j].item(), int(names[j])) for j in range(columns))][:n])}
    assert got == want


def test_hidden_entries_do_not_raise_the_limit():
    tile = np.arange(400.0).reshape(2, 200)
    best = Best(2, 2, np.float64)
    line, column = best.reaching(np.arange(2), tile, best.limit, lambda lines: np.arange(200) >= np.full((len(lines), 1), 190))
    shown = column < 190
    best.keep(line[shown], tile[line, column][shown], column[shown])
    assert best.names.tolist() == [[189, 188], [189, 188]]


def test_a_limit_given_before_holds():
    best = Best(1, 2, np.int64, np.array([5]))
    tile = np.array([[1, 5, 4]])
    line, column = best.reaching(np.arange(1), tile, best.limit)
    assert column.tolist() == [1]
