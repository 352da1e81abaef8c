"""Shortest edit paths over the lattice of a conversation, by the auction algorithm.

A node is (row, state): ``row`` rows are behind, and the roles put out so far end in
nothing, a system turn, a user turn or an assistant turn. Edits are arcs of integer
cost; insertions stay at their row. Every node has a price, and no price exceeds the
cost of an arc plus the price of its head. A path grows from its origin: while its end
can be raised, the end's price goes up to its cheapest arc and the path contracts;
otherwise the path extends along that arc, until it meets the goal.

Long conversations are taken in pieces from the last to the first: nodes at the border
of a piece keep the prices that they converged to, and meeting one of them ends a path.
So the work is in proportion to the rows. All arcs of all cheapest paths of an origin
are tight in the end (price of the tail = cost + price of the head), and following the
least letter among the tight arcs that lead to the goal gives the least edit string.

Rows come as one byte each: the role's initial, 0 other, 1 system, 2 user, 3 assistant;
plus 4 for rows that must be deleted, 8 for truncated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
MUST_GO, TRUNCATED = 4, 8
# Costs of the edits.
RENAME, DELETE, INSERT, TRUNCATED_STAYS = 1, 2, 5, 5
FOLLOWS = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
NEXT_TURN = (USER, USER, ASSISTANT, USER)  # the turn that an inserted or renamed row becomes
LATER = ((START, SYSTEM, USER, ASSISTANT), (SYSTEM, USER, ASSISTANT), (USER, ASSISTANT), (USER, ASSISTANT))
NEVER = 1 << 60
FINAL = (0, NEVER, NEVER, 0)  # prices behind the last row: nothing or a whole number of exchanges is put out
PIECE = 32


def arcs(code: int | None, state: int, inserts: bool = True) -> list[tuple[str, int, int, int]]:
    """(letter, cost, rows taken, next state) in the order of letters; no row is left where ``code`` is None."""
    found = []
    if code is not None:
        found.append(("D", DELETE, 1, state))
    if inserts:
        found.append(("I", INSERT, 0, NEXT_TURN[state]))
    if code is not None and not code & MUST_GO:
        extra = TRUNCATED_STAYS if code & TRUNCATED else 0
        if (state, code & 3) in FOLLOWS:
            found.append(("K", extra, 1, code & 3))
        found.append(("R", RENAME + extra, 1, NEXT_TURN[state]))
    return found


ARCS = {(code, state): arcs(code, state) for code in (None, *range(16)) for state in range(STATES)}


def auction(codes: Sequence[int], behind: Sequence[int], origins: Sequence[int], last: bool) -> list[list[int]]:
    """Prices of the nodes of one piece, exact at its first row for the states in ``origins``.

    ``behind`` are the prices at the piece's end. Only the ``last`` piece has
    insertions behind its last row; there ``behind`` is what stopping costs.
    """
    size = len(codes)
    low = min(behind)
    # Turns are never taken back, so a state whose later states have no way out has none itself.
    first = [low if any(behind[k] < NEVER for k in LATER[state]) else NEVER for state in range(STATES)]
    prices = [list(first) for _ in range(size)] + [list(first) if last else list(behind)]
    goal = (size + 1, 0)
    for origin in origins:
        path = [(0, origin)]
        while path:
            row, state = path[-1]
            best, head = NEVER, None
            for _, cost, taken, after in ARCS[codes[row] if row < size else None, state]:
                price = cost + prices[row + taken][after]
                if price < best:
                    best, head = price, (row + taken, after)
            if row == size and behind[state] <= best:
                best, head = behind[state], goal
            if prices[row][state] < best:
                prices[row][state] = best
                path.pop()
                if not path and best < NEVER:
                    path.append((0, origin))
            elif head is None or best >= NEVER:
                break
            elif head == goal or (head[0] == size and not last):
                break
            else:
                path.append(head)
    return prices


def settle(codes: bytes, behind: Sequence[int] = FINAL, last: bool = True, origins: Sequence[int] = (START,),
           piece: int = PIECE) -> list[list[int]]:
    """Converged prices of all nodes, piece by piece from the end."""
    prices: list[list[int]] = []
    for start in range((max(len(codes), 1) - 1) // piece * piece, -1, -piece):
        ends = last and start + piece >= len(codes)
        wanted = origins if start == 0 else range(STATES)
        part = auction(codes[start:start + piece], behind, wanted, ends)
        prices = part[:-1] + (prices or part[-1:])
        behind = part[0]
    return prices


def trace(codes: bytes, prices: list[list[int]], state: int = START, behind: Sequence[int] = FINAL,
          last: bool = True) -> tuple[str, int]:
    """The least letters along tight arcs from the first row to the end, and the state they end in.

    ``prices`` are exact for ``state`` and at the borders of pieces. A tight arc may
    lead to a node whose price never rose that far, so nodes without a tight way on
    are left again.
    """
    size = len(codes)
    dead: set[tuple[int, int]] = set()
    steps: list[tuple[int, int, str]] = []
    row = 0
    while True:
        if row == size and (not last or (behind[state] < NEVER and prices[row][state] == behind[state])):
            return "".join(letter for _, _, letter in steps), state
        for letter, cost, taken, after in ARCS[codes[row] if row < size else None, state]:
            ahead = prices[row + taken][after]
            if ahead < NEVER and prices[row][state] == cost + ahead and (row + taken, after) not in dead:
                steps.append((row, state, letter))
                row, state = row + taken, after
                break
        else:
            dead.add((row, state))
            if not steps:
                raise ValueError("the end cannot be reached")
            row, state, _ = steps.pop()


def crossing(codes: bytes) -> list[list[int]]:
    """Cheapest cost from each state before the rows to each state behind them; nothing is inserted behind the last row."""
    columns = []
    for state in range(STATES):
        behind = [0 if k == state else NEVER for k in range(STATES)]
        columns.append(settle(codes, behind, False, range(STATES))[0])
    return [list(row) for row in zip(*columns)]


END_PRICES = settle(b"", origins=range(STATES))[0]  # what each state behind the last row costs
