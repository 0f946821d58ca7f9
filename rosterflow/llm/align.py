"""Cheapest edits that turn a row of speakers into an alternating dialogue."""

from __future__ import annotations

# Costs of the edits, and of leaving a truncated turn in.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

# Turns that are aligned at a time.
BLOCK = 256

INFINITE = 1 << 60

# What a dialogue may look like so far: empty, a system turn, a user's turn to answer, complete pairs.
EMPTY, SYSTEM, ASKED, PAIRS = range(4)

# What it costs to end a dialogue there, by inserting what is missing, and what is inserted.
ENDINGS = {EMPTY: (0, ""), SYSTEM: (2 * INSERT, "II"), ASKED: (INSERT, "I"), PAIRS: (0, "")}


def target_states(state: int, with_system: bool, length: int) -> tuple[str, list[int]]:
    """The only target of each length from a state on, as one string of initials, and the state after each of them.

    Targets of all lengths are prefixes of one alternating string, or of two from the empty dialogue on: with
    a system turn and without.
    """
    states, wanted = [state], []
    for _ in range(length):
        if state == EMPTY and with_system:
            wanted.append("s")
            state = SYSTEM
        elif state == ASKED:
            wanted.append("a")
            state = PAIRS
        else:
            wanted.append("u")
            state = ASKED
        states.append(state)
    return "".join(wanted), states


class Alignment:
    """Wagner-Fischer costs of a block of turns against every prefix of a target, from each cell to the end.

    ``codes`` has a letter per turn: s, u, a or o (another speaker), upper case if truncated, x for
    one that must go. ``after`` is the cost of what follows the block, by state. Cells lie in Ukkonen's band: of the turns
    that may stay, a target may lack or exceed only as many as deletions or insertions below the ``incumbent``
    cost allow, which is that of a plain repair from left to right. So the band holds all cheapest alignments.
    """

    def __init__(self, codes: str, state: int, with_system: bool, after: list[int], other: Alignment | None = None):
        self.codes, self.other = codes, other
        free = [0]
        for code in codes:
            free.append(free[-1] + (code != "x"))
        self.free = free
        must = DELETE * (len(codes) - free[-1])
        slack = self.incumbent(codes, state, after) - must - min(after)
        self.under, self.over = slack // DELETE, slack // INSERT
        width = free[-1] + self.over
        self.target, self.states = target_states(state, with_system, width + 1)
        self.after = after
        self.rows: list[list[int]] = []
        self.fill()

    @staticmethod
    def incumbent(codes: str, state: int, after: list[int]) -> int:
        """The less of two costs: of reroling every turn that stands wrong, and of inserting the turn that is missing before it."""
        costs = []
        for insert in (False, True):
            cost, here = 0, state
            for code in codes:
                if code == "x":
                    cost += DELETE
                    continue
                who, wanted = code.lower(), "a" if here == ASKED else "u"
                cost += TRUNCATED if code.isupper() else 0
                if who == wanted:
                    here = PAIRS if here == ASKED else ASKED
                elif insert and who in "ua":
                    # The missing turn comes in, and this one keeps the next place.
                    cost += INSERT
                    here = ASKED if here == ASKED else PAIRS
                else:
                    cost += REROLE
                    here = PAIRS if here == ASKED else ASKED
            costs.append(cost + after[here])
        return min(costs)

    def first(self, turn: int) -> int:
        """The first column of a row's band."""
        return max(0, self.free[turn] - self.under)

    def last(self, turn: int) -> int:
        return self.free[turn] + self.over

    def cost(self, turn: int, column: int) -> int:
        at = column - self.first(turn)
        row = self.rows[turn]
        return row[at] if 0 <= at < len(row) else INFINITE

    def fill(self) -> None:
        """Costs of all rows of the band, from the last turn to the first."""
        n, target = len(self.codes), self.target
        self.rows = [[] for _ in range(n + 1)]
        below = self.rows[n] = [self.after[self.states[j]] for j in range(self.first(n), self.last(n) + 1)]
        offset = self.first(n)
        for turn in range(n - 1, -1, -1):
            start, stop, code = self.first(turn), self.last(turn), self.codes[turn]
            who, cut = code.lower(), TRUNCATED if code.isupper() else 0
            row = [INFINITE] * (stop - start + 1)
            size, right = len(below), INFINITE
            for column in range(stop, start - 1, -1):
                at, wanted = column - offset, target[column]
                best = DELETE + below[at] if 0 <= at < size else INFINITE
                if code != "x" and 0 <= at + 1 < size:
                    if who == wanted:
                        best = min(best, cut + below[at + 1])
                    elif wanted != "s":
                        best = min(best, REROLE + cut + below[at + 1])
                if wanted != "s":
                    best = min(best, INSERT + right)
                if column == 0 and self.other is not None and who == "s":
                    best = min(best, cut + self.other.cost(turn + 1, 1))
                row[column - start] = right = best
            self.rows[turn] = below = row
            offset = start

    def step(self, turn: int, column: int) -> tuple[int, str] | None:
        """Cost and letter of matching a turn to a place of the target."""
        code, wanted = self.codes[turn], self.target[column]
        if code == "x":
            return None
        cut = TRUNCATED if code.isupper() else 0
        if code.lower() == wanted:
            return cut, "K"
        return None if wanted == "s" else (REROLE + cut, "R")


def aligned(codes: str, state: int, after: list[int]) -> Alignment:
    """The alignment from a state on; from the empty dialogue with the one behind a system turn beside it."""
    other = Alignment(codes, EMPTY, True, after) if state == EMPTY and ("s" in codes or "S" in codes) else None
    return Alignment(codes, state, False, after, other)


def trace(alignment: Alignment) -> tuple[str, int]:
    """The first of the cheapest audits in ASCII order, and the state it leads to.

    D, I, K and R are tried in this order at each cell, so no other cheapest audit comes before.
    """
    here, turn, column, audit = alignment, 0, 0, []
    while turn < len(here.codes):
        cost, code = here.cost(turn, column), here.codes[turn]
        step = here.step(turn, column)
        into = here.other if column == 0 and code in "sS" else None
        if DELETE + here.cost(turn + 1, column) == cost:
            audit.append("D")
            turn += 1
        elif here.target[column] != "s" and INSERT + here.cost(turn, column + 1) == cost:
            audit.append("I")
            column += 1
        elif into is not None and (TRUNCATED if code == "S" else 0) + into.cost(turn + 1, 1) == cost:
            audit.append("K")
            here, turn, column = into, turn + 1, 1
        else:
            audit.append(step[1])
            turn, column = turn + 1, column + 1
    return "".join(audit), here.states[column]


def cheapest_edits(codes: str, block: int = BLOCK) -> tuple[int, str]:
    """Cost and audit of the cheapest edits of a conversation, given by a letter per turn (see ``Alignment``).

    A long conversation is aligned block by block from its end: what a block costs from each state on is what follows
    the block before it. The blocks are then traced from the first one on, so that memory and time grow
    with the length and not with its square.
    """
    if not codes:
        return 0, ""
    blocks = [codes[i : i + block] for i in range(0, len(codes), block)]
    after = [[ENDINGS[s][0] for s in range(4)]]
    for part in reversed(blocks[1:]):
        after.append([aligned(part, s, after[-1]).cost(0, 0) for s in range(4)])
    state, audit, cost = EMPTY, [], None
    for part, following in zip(blocks, reversed(after), strict=True):
        alignment = aligned(part, state, following)
        cost = alignment.cost(0, 0) if cost is None else cost
        letters, state = trace(alignment)
        audit.append(letters)
    return cost, "".join(audit) + ENDINGS[state][1]
