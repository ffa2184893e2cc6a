"""Tree ensembles as tables of leaves: predictions of a row when one of its features is exchanged for another row's.

The cuts of all trees part the values of a feature into classes; values of one class take the same way in every tree, so a row
is its classes. Per tree and feature, a class leaves some leaves within reach. The one leaf that all features of a row leave is
where the row ends: without walking a tree, an exchange of one feature costs one table lookup and one intersection per tree.
"""

from dataclasses import dataclass

import numpy as np
from pyspark import SparkContext

_BITS = 64
# a tree with more leaves is walked level by level
_MOST_LEAVES = 1024


@dataclass(frozen=True)
class _Word:
    """At most 64 leaves of one tree: ``masks`` holds, per feature, the leaves that each class leaves within reach."""

    alive: int
    masks: dict[int, np.ndarray]
    values: np.ndarray  # of no leaf, of the first, of the second, ...

    def add(self, total: np.ndarray, own: np.ndarray, asked: list[int], lent: np.ndarray) -> None:
        reach = {at: mask.take(own[at]) for at, mask in self.masks.items()}
        before, others = np.full(own.shape[1], self.alive, np.uint64), {}
        for at, bits in reach.items():
            others[at], before = before, before & bits
        after = None
        for at in reversed(reach):
            if after is not None:
                others[at] = others[at] & after
            after = reach[at] if after is None else after & reach[at]
        unchanged = self._value(before)
        total[0] += unchanged
        for trial, at in enumerate(asked):
            total[trial + 1] += self._value(others[at] & self.masks[at].take(lent[trial])) if at in others else unchanged

    def _value(self, leaf: np.ndarray) -> np.ndarray:
        """One bit is left, or none: its place is the exponent of the number, and clipped to the first value for none."""
        return self.values.take((leaf.astype(np.float64).view(np.int64) >> 52) - 1022, mode="clip")


@dataclass(frozen=True)
class _Walk:
    """A tree of many leaves: ``left`` tells, from ``start`` of a node on, which classes go left. A leaf goes to itself."""

    feature: np.ndarray
    start: np.ndarray
    left: np.ndarray
    children: np.ndarray
    values: np.ndarray
    depth: int

    def add(self, total: np.ndarray, own: np.ndarray, asked: list[int], lent: np.ndarray) -> None:
        unchanged, split_on = self._value(own), set(self.feature[self.feature >= 0].tolist())
        total[0] += unchanged
        for trial, at in enumerate(asked):
            if at in split_on:
                changed = own.copy()
                changed[at] = lent[trial]
                total[trial + 1] += self._value(changed)
            else:
                total[trial + 1] += unchanged

    def _value(self, classes: np.ndarray) -> np.ndarray:
        rows = np.arange(classes.shape[1])
        node = np.zeros(len(rows), np.int64)
        for _ in range(self.depth):
            feature = self.feature[node]
            step = self.left[self.start[node] + np.where(feature < 0, 0, classes[feature, rows])]
            node = self.children[node, 1 - step]
        return self.values[node]


@dataclass(frozen=True)
class Ensemble:
    """Trees over ``width`` features; ``cuts`` holds the thresholds of a feature, or the number of its categories."""

    width: int
    cuts: dict[int, np.ndarray | int]
    trees: list[_Word | _Walk]
    divisor: float

    @property
    def kind(self) -> np.dtype:
        """The least type that holds every class."""
        return np.min_scalar_type(max([cut - 1 if isinstance(cut, int) else len(cut) for cut in self.cuts.values()], default=0))

    def classes(self, vectors: np.ndarray) -> np.ndarray:
        """Classes of rows of feature vectors, one line per feature; a feature no tree splits on has one class."""
        classes = np.zeros((self.width, len(vectors)), self.kind)
        for at, cut in self.cuts.items():
            if isinstance(cut, int):
                if len(vectors) and not (vectors[:, at] < cut).all():
                    raise ValueError(f"feature {at} has a category beyond the {cut} of the model")
                classes[at] = vectors[:, at]
            else:
                classes[at] = np.searchsorted(cut, vectors[:, at])
        return classes

    def scores(self, own: np.ndarray, asked: list[int], lent: np.ndarray) -> np.ndarray:
        """What the trees make of rows as they are, then of each trial: feature ``asked`` exchanged for the class ``lent``."""
        total = np.zeros((len(asked) + 1, own.shape[1]))
        for tree in self.trees:
            tree.add(total, own, asked, lent)
        return total / self.divisor


def read_ensemble(learner, width: int) -> Ensemble:
    """The trees of a fitted forest (mean of its trees) or of fitted boosted trees (weighted sum)."""
    arrays = SparkContext._active_spark_context._jvm.java.util.Arrays
    trees = [[] for _ in learner.trees]
    for tree, nodes in zip(learner.trees, trees, strict=True):
        _read(tree._call_java("rootNode"), arrays, nodes)
    cuts = {}
    for feature, cut, *_ in (node for nodes in trees for node in nodes if node[0] >= 0):
        cuts.setdefault(feature, set()).add(cut if isinstance(cut, float) else cut[1])
    cuts = {at: max(found) if isinstance(next(iter(found)), int) else np.array(sorted(found)) for at, found in sorted(cuts.items())}
    forest = not learner.hasParam("stepSize")
    weights = [1.0] * len(trees) if forest else learner.treeWeights
    return Ensemble(width, cuts, [part for nodes, weight in zip(trees, weights, strict=True) for part in _parts(nodes, cuts, weight)],
                    float(len(trees)) if forest else 1.0)


def _read(node, arrays, into: list[tuple]) -> int:
    """Appends (feature, cut, left, right) of a node and those below it, or (-1, value) of a leaf; returns its place."""
    place = len(into)
    into.append(())
    if node.getClass().getSimpleName() == "LeafNode":
        into[place] = (-1, node.prediction())
        return place
    split = node.split()
    if split.getClass().getSimpleName() == "ContinuousSplit":
        cut = split.threshold()
    else:
        left = frozenset(int(float(v)) for v in arrays.toString(split.leftCategories()).strip("[]").split(",") if v)
        cut = (left, len(left) + len(split.rightCategories()))
    into[place] = (split.featureIndex(), cut, _read(node.leftChild(), arrays, into), _read(node.rightChild(), arrays, into))
    return place


def _goes_left(cut: float | tuple, parting: np.ndarray | int) -> np.ndarray:
    """For each class of a feature, whether a node sends it left: at most the threshold, or in the set."""
    if isinstance(cut, float):
        return np.arange(len(parting) + 1) <= np.searchsorted(parting, cut)
    return np.isin(np.arange(parting), list(cut[0]))


def _parts(nodes: list[tuple], cuts: dict, weight: float) -> list[_Word | _Walk]:
    spans = [(0, 0)] * len(nodes)  # the leaves below each node, as places in the order from left to right
    values = []

    def number(place: int) -> int:
        first, depth = len(values), 0
        if nodes[place][0] < 0:
            values.append(nodes[place][1] * weight)
        else:
            depth = 1 + max(number(nodes[place][2]), number(nodes[place][3]))
        spans[place] = (first, len(values))
        return depth

    depth = number(0)
    left = {place: _goes_left(node[1], cuts[node[0]]) for place, node in enumerate(nodes) if node[0] >= 0}
    if len(values) > _MOST_LEAVES:
        tables = [left.get(place, np.array([True])) for place in range(len(nodes))]
        return [_Walk(
            np.array([node[0] for node in nodes]), np.cumsum([0, *map(len, tables)])[:-1], np.concatenate(tables).astype(np.int64),
            np.array([node[2:] or (place, place) for place, node in enumerate(nodes)]),
            np.array([values[spans[place][0]] if node[0] < 0 else 0.0 for place, node in enumerate(nodes)]), depth)]
    words = []
    for first in range(0, len(values), _BITS):
        held = values[first:first + _BITS]
        alive, masks = (1 << len(held)) - 1, {}
        for place, goes in left.items():
            feature, lost = nodes[place][0], []
            for child in nodes[place][2:]:  # leaves of this word below either child
                low, high = (min(max(leaf - first, 0), len(held)) for leaf in spans[child])
                lost.append(np.uint64(~((1 << high) - (1 << low)) & (1 << _BITS) - 1))
            mask = masks.setdefault(feature, np.full(len(goes), alive, np.uint64))
            mask &= np.where(goes, lost[1], lost[0])
        words.append(_Word(alive, {at: mask for at, mask in masks.items() if (mask != alive).any()}, np.array([0.0, *held])))
    return words
