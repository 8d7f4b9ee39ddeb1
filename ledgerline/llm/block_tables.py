"""Cheapest edits of role sequences by Four-Russians block tables.

A row is one of nine symbols: its role's initial (s, u, a or another) with or without the truncation fault, or a row that
must go. Edits lead from the roles written so far (a state) to the next; the result's initials must read
``(s?(ua)+)?``. What the rows still to come cost at least from each state is a vector of four numbers. Less its
least entry it is one of a few vectors, so a block of ``BLOCK`` symbols is a transition from the vector at its right end
to that at its left end plus a cost: all transitions of all blocks are tabulated once. A sequence is looked up block by block
from its end to its beginning. For the audit each block is then expanded backward from the vector at its right end, and
the edits are read forward: of the edits that keep the optimum always the ASCII-least, which gives the ASCII-least
text of edits, since no cheapest text is the beginning of another one for the same rows and state.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

BLOCK = 4
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
INITIALS = "sua"
MUST_GO = 8
N_SYMBOLS = 9
START, AFTER_S, AFTER_U, AFTER_A = range(4)
# Of each state: the role that may be written by an edit, and the state after it.
WRITTEN = {START: ("user", AFTER_U), AFTER_S: ("user", AFTER_U), AFTER_U: ("assistant", AFTER_A), AFTER_A: ("user", AFTER_U)}
KEPT = {(START, "s"): AFTER_S, (START, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}


def symbol(role: str, truncated: bool) -> int:
    at = INITIALS.find(role[:1]) if role else -1
    return 2 * (at if at >= 0 else len(INITIALS)) + truncated


def _moves(state: int, code: int) -> list[tuple[str, int, int]]:
    """(edit, cost, state after it) of the edits that take the row, in ASCII order."""
    moves = [("D", DELETE, state)]
    if code != MUST_GO:
        fault = TRUNCATED * (code % 2)
        initial = (INITIALS + "-")[code // 2]
        if (state, initial) in KEPT:
            moves.append(("K", fault, KEPT[state, initial]))
        moves.append(("R", REROLE + fault, WRITTEN[state][1]))
    return moves


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    for _ in range(3):  # start, then u, then a
        costs = [min(c, INSERT + costs[WRITTEN[q][1]]) for q, c in enumerate(costs)]
    return tuple(costs)


def _before(vector: tuple[int, ...], code: int) -> tuple[int, ...]:
    """Least costs before a row, from those after it."""
    return _with_inserts([min(cost + vector[to] for _, cost, to in _moves(q, code)) for q in range(4)])


def _normal(vector: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    least = min(vector)
    return tuple(v - least for v in vector), least


@dataclass
class BlockTables:
    vectors: list[tuple[int, ...]]
    step: np.ndarray  # (symbol, vector after) -> vector before
    cost: np.ndarray
    block_step: np.ndarray  # (block's number, vector after) -> vector before
    block_cost: np.ndarray
    end: int  # the vector when no row is left, and its least entry is 0
    _expanded: dict = field(default_factory=dict)

    @staticmethod
    def build(length: int = BLOCK) -> BlockTables:
        first, _ = _normal(_with_inserts([0, 99, 99, 0]))
        vectors, number, todo = [first], {first: 0}, [first]
        edges = {}
        while todo:
            vector = todo.pop()
            for code in range(N_SYMBOLS):
                before, least = _normal(_before(vector, code))
                if before not in number:
                    number[before] = len(vectors)
                    vectors.append(before)
                    todo.append(before)
                edges[code, number[vector]] = (number[before], least)
        step = np.array([[edges[c, v][0] for v in range(len(vectors))] for c in range(N_SYMBOLS)], np.int32)
        cost = np.array([[edges[c, v][1] for v in range(len(vectors))] for c in range(N_SYMBOLS)], np.int64)
        block_step, block_cost = step, cost
        for _ in range(length - 1):  # one more symbol on the left
            block_cost = (block_cost[None] + cost[np.arange(N_SYMBOLS)[:, None, None], block_step[None]]).reshape(-1, len(vectors))
            block_step = step[:, block_step].reshape(-1, len(vectors))
        return BlockTables(vectors, step, cost, block_step, block_cost, 0)

    def blocks(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the whole blocks, and the symbols left at the end."""
        whole = len(symbols) // BLOCK * BLOCK
        weights = N_SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
        return symbols[:whole].reshape(-1, BLOCK).astype(np.int64) @ weights, symbols[whole:]

    def composed(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The transition of the whole sequence from every vector: vector before it, and cost. Halves are joined."""
        blocks, rest = self.blocks(symbols)
        steps, costs = self.block_step[blocks], self.block_cost[blocks]
        steps = np.concatenate([steps, self.step[rest.astype(np.int64)]])
        costs = np.concatenate([costs, self.cost[rest.astype(np.int64)]])
        if not len(steps):
            return np.arange(len(self.vectors)), np.zeros(len(self.vectors), np.int64)
        while len(steps) > 1:
            odd = len(steps) % 2
            left, right = steps[odd::2], steps[odd + 1 :: 2]
            joined = np.take_along_axis(left, right, 1)
            cost = costs[odd + 1 :: 2] + np.take_along_axis(costs[odd::2], right, 1)
            steps, costs = np.concatenate([steps[:odd], joined]), np.concatenate([costs[:odd], cost])
        return steps[0], costs[0]

    def boundaries(self, symbols: np.ndarray, after: int) -> list[int]:
        """The vector at the right end of every block; the symbols left at the end are a block of their own."""
        blocks, rest = self.blocks(symbols)
        vector, found = after, [after]
        for code in rest[::-1].tolist():
            vector = int(self.step[code, vector])
        for number in blocks[::-1].tolist():
            found.append(vector)
            vector = int(self.block_step[number, vector])
        return found[::-1]

    def least_cost(self, symbols: np.ndarray) -> int:
        blocks, rest = self.blocks(symbols)
        vector, total = self.end, 0
        for code in rest[::-1].tolist():
            total += int(self.cost[code, vector])
            vector = int(self.step[code, vector])
        for number in blocks[::-1].tolist():
            total += int(self.block_cost[number, vector])
            vector = int(self.block_step[number, vector])
        return total + self.vectors[vector][START]

    def expand(self, codes: tuple[int, ...], after: int, state: int) -> tuple[str, int]:
        """Edits of a block's rows from ``state``, and the state after them."""
        key = (codes, after, state)
        if key not in self._expanded:
            behind = [after]
            for code in codes[::-1]:
                behind.append(int(self.step[code, behind[-1]]))
            edits, now = [], state
            for code, vector in zip(codes, behind[-2::-1]):
                left = self.vectors[vector]
                here = _before(left, code)
                taken = False
                while not taken:
                    taking = {edit: to for edit, cost, to in _moves(now, code) if cost + left[to] == here[now]}
                    role_state = WRITTEN[now][1]
                    inserted = {"I": role_state} if INSERT + here[role_state] == here[now] else {}
                    edit = min(taking | inserted)
                    taken = edit != "I"
                    now = taking[edit] if taken else role_state
                    edits.append(edit)
            self._expanded[key] = ("".join(edits), now)
        return self._expanded[key]

    def trace(self, symbols: np.ndarray, after: int, state: int) -> tuple[str, int]:
        """The ASCII-least of the cheapest edits of a sequence that begins in ``state`` and has the vector ``after`` behind
        it, and the state at its end."""
        edits = []
        for block, vector in enumerate(self.boundaries(symbols, after)):
            codes = tuple(symbols[block * BLOCK : (block + 1) * BLOCK].tolist())
            text, state = self.expand(codes, vector, state)
            edits.append(text)
        return "".join(edits), state

    def closing(self, state: int) -> str:
        """Edits after the last row."""
        return {START: "", AFTER_S: "II", AFTER_U: "I", AFTER_A: ""}[state]


@lru_cache(maxsize=1)
def tables() -> BlockTables:
    """Built once a process: their size depends on the block's length only."""
    return BlockTables.build()
