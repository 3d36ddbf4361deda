"""Credits of trees from leaf words against the walk down the trees."""

import numpy as np
import pytest

from kestrel.functions.trees import TreeArrays
from kestrel.operators import explain as EX


def _forest(depth=6, boosted=False):
    rng = np.random.default_rng(9)
    feature, threshold, left, right, value = [], [], [], [], []

    def grow(levels):
        i = len(feature)
        for a, v in ((feature, -1), (threshold, 0.0), (left, i), (right, i), (value, rng.random())):
            a.append(v)
        if levels and rng.random() < 0.9:
            feature[i], threshold[i] = int(rng.integers(4)), float(rng.integers(-2, 3)) / 2
            left[i] = grow(levels - 1)
            right[i] = grow(levels - 1)
        return i

    roots = [grow(d % (depth + 1)) for d in range(12)]
    return TreeArrays(np.array(roots), rng.random(12), np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), boosted)


@pytest.mark.parametrize("boosted", [False, True])
def test_leaf_words_give_the_values_of_the_walk(boosted):
    """every mixed point was walked down every tree."""
    trees, rng = _forest(boosted=boosted), np.random.default_rng(1)
    x, ref = rng.integers(-3, 4, size=(50, 4)) / 2, rng.normal(size=(3, 4))     # values on the thresholds
    x[4, 1] = np.nan
    turn = np.argsort(rng.random((50, 2, 4)), axis=2)
    words = EX._on_path(trees, trees.masks(4), x, turn, ref)
    assert np.array_equal(words, EX._at_points(trees, x, turn, ref))


def test_trees_with_more_leaves_than_bits_are_walked():
    assert _forest(depth=9).masks(4) is None
