"""Minimal perfect hash tables over 128-bit digests, in numpy, and sums along the trees kept in them."""

from __future__ import annotations

import numpy as np

from clickloom.llm.cascade import mixed

ROOM = 1.5  # places per key that is left at a level
MOST_LEVELS = 100


class SlotTable:
    """Slots 0 .. n - 1 for n distinct digests, each kept at its slot to verify lookups.

    At each level the keys left are dealt to a row of places; a key alone on its place gets the
    place's rank as slot, the others go on to the next level.
    """

    def __init__(self, one: np.ndarray, two: np.ndarray):
        self.size = len(one)
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []  # filled places, slots before each, number of places
        self.one, self.two = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        left, first = np.arange(self.size), 0
        while len(left):
            if len(self.levels) == MOST_LEVELS:
                raise ValueError("two nodes have the same digest")
            places = int(len(left) * ROOM) + 1
            at = self._places(one[left], two[left], len(self.levels), places)
            alone = np.bincount(at, minlength=places) == 1
            before = first + np.concatenate([[0], np.cumsum(alone)])[:-1]
            self.levels.append((alone, before, places))
            settled = left[alone[at]]
            slot = before[at[alone[at]]]
            self.one[slot], self.two[slot] = one[settled], two[settled]
            first += len(settled)
            left = left[~alone[at]]

    @staticmethod
    def _places(one: np.ndarray, two: np.ndarray, level: int, places: int) -> np.ndarray:
        hashed = mixed(mixed(one.view(np.uint64), level + 1) ^ two.view(np.uint64), level + 77)
        return (hashed % np.uint64(places)).astype(np.int64)

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 for one that the table does not hold."""
        out = np.full(len(one), -1, np.int64)
        left = np.arange(len(one))
        for level, (alone, before, places) in enumerate(self.levels):
            at = self._places(one[left], two[left], level, places)
            hit = alone[at]
            out[left[hit]] = before[at[hit]]
            left = left[~hit]
        known = out >= 0
        same = known.copy()
        same[known] = (self.one[out[known]] == one[known]) & (self.two[out[known]] == two[known])
        return np.where(same, out, -1)


def settle(
    own: tuple[np.ndarray, np.ndarray], above: tuple[np.ndarray, np.ndarray], depth: np.ndarray,
    children: np.ndarray, leaves: np.ndarray, amount: np.ndarray, below: np.ndarray,
) -> dict[str, np.ndarray]:
    """Children, leaves and amounts below of every node of a forest, and each node's parent (-1: none here).

    `own` and `above` are digests of the node and its parent, `depth` grows from parent to child.
    `children`, `leaves` and `below` are what nodes outside the forest add. Counts are scattered into
    flat arrays by slot and go up through the parents' slots, deepest first.
    """
    table = SlotTable(*own)
    slot = table.find(*own)
    parent_slot = table.find(*above)
    parent_slot = np.where(parent_slot == slot, -1, parent_slot)
    node = np.empty(table.size, np.int64)
    node[slot] = np.arange(table.size)
    flat = {k: np.zeros(table.size, np.int64) for k in ("children", "leaves", "below", "amount")}
    for k, v in (("children", children), ("leaves", leaves), ("below", below), ("amount", amount)):
        flat[k][slot] = v
    inside = parent_slot >= 0
    np.add.at(flat["children"], parent_slot[inside], 1)
    flat["leaves"][flat["children"] == 0] = 1
    order = np.argsort(-depth, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], depth[order][1:] != depth[order][:-1], [True]])) if len(order) else []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        at = order[low:high]
        at = at[inside[at]]
        np.add.at(flat["leaves"], parent_slot[at], flat["leaves"][slot[at]])
        np.add.at(flat["below"], parent_slot[at], flat["below"][slot[at]] + flat["amount"][slot[at]])
    out = {k: flat[k][slot] for k in ("children", "leaves", "below")}
    return out | {"parent": np.where(inside, node[parent_slot], -1)}
