"""Generalised LR repair of role sequences.

The role grammar is compiled to an SLR table. While the rows of a conversation are read, all stacks
that edits can lead to are kept as one graph: a stack is a node (state, node below), so common parts
are shared, and stacks with the same top are merged into the one of least (cost, audit). That loses
nothing here: equal tops of this grammar accept the same continuations.

A front is the set of tops behind a row, in the order of their audits. Audits behind a row end with
that row's letter, so none is the beginning of another, and appending to two of them cannot change
their order. Hence a front needs no audits, only their order, and a step depends on the front's
relative costs and the row's code alone: steps are remembered, and a long conversation is a walk
through few different ones.
"""

from __future__ import annotations

from functools import cache, lru_cache

#: The role grammar ``(s?(ua)+)?``: system first if at all, then user and assistant in turn.
GRAMMAR = (("C", ""), ("C", "P"), ("C", "sP"), ("P", "ua"), ("P", "Pua"))
TERMINALS = "sua"
#: What edits cost, and the roles that may be given.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
GIVEN = {"u": "user", "a": "assistant"}

#: Codes of rows: ``x`` has to go; an initial, ``o`` for any other; upper case for truncated text.
GONE, OTHER = "x", "o"


class Table:
    """SLR actions of a grammar whose first symbol is its start symbol."""

    def __init__(self, grammar):
        self.rules = (("^", grammar[0][0]), *grammar)
        heads = {h for h, _ in self.rules}
        follow = self._follow(heads)
        self.states = [self._closure({(0, 0)}, heads)]
        self.moves: list[dict[str, int]] = []
        self.symbol = [""]  # the last symbol read when a state is on top
        for state in self.states:  # grows while it is walked
            self.moves.append({})
            for sign in sorted({self.rules[r][1][d] for r, d in state if d < len(self.rules[r][1])}):
                kernel = {(r, d + 1) for r, d in state if self.rules[r][1][d : d + 1] == sign}
                target = self._closure(kernel, heads)
                if target not in self.states:
                    self.states.append(target)
                    self.symbol.append(sign)
                self.moves[-1][sign] = self.states.index(target)
        self.reduce = [
            {sign: r for r, d in state if d == len(self.rules[r][1]) for sign in follow[self.rules[r][0]]} for state in self.states
        ]

    def _closure(self, items, heads):
        todo, out = list(items), set(items)
        while todo:
            rule, dot = todo.pop()
            ahead = self.rules[rule][1][dot : dot + 1]
            new = {(r, 0) for r, (h, _) in enumerate(self.rules) if ahead in heads and h == ahead} - out
            out |= new
            todo += new
        return frozenset(out)

    def _follow(self, heads):
        """Signs that can stand behind each head. Heads that may be empty stand at ends only."""
        first = {h: set() for h in heads}
        follow = {h: set() for h in heads} | {"^": {"$"}}
        for _ in range(len(self.rules) * 2):
            for head, body in self.rules:
                first[head] |= first.get(body[:1], {body[:1]} - {""})
                for sign, after in zip(body, [*body[1:], ""]):
                    if sign in heads:
                        follow[sign] |= first.get(after, {after}) if after else follow[head]
        return follow

    def read(self, node, sign):
        """The node behind ``sign``, or None. ``$`` is the end: it gives a node if the input may end."""
        while (rule := self.reduce[node[0]].get(sign)) is not None:
            head, body = self.rules[rule]
            if head == "^":
                return node
            for _ in body:
                node = node[1]
            node = (self.moves[node[0]][head], node)
        target = self.moves[node[0]].get(sign)
        return None if target is None else (target, node)


TABLE = Table(GRAMMAR)
START = (0, None)


@cache
def read(node, sign):
    return TABLE.read(node, sign)


@cache
def inserted(node):
    """(word, node, cost) for every number of inserts that leads to a new top."""
    out, tops = [("", node, 0)], {node[0]}
    for word, at, cost in out:
        for sign in GIVEN:
            after = read(at, sign)
            if after is not None and after[0] not in tops:
                tops.add(after[0])
                out.append((word + "I", after, cost + INSERT))
    return out


@cache
def choices(code):
    """(letter, sign read or None, cost) of every edit of a row."""
    out = [("D", None, DELETE)]
    if code != GONE:
        more, sign = (TRUNCATED if code.isupper() else 0), code.lower()
        out += [("K", sign, more)] if sign in TERMINALS else []
        out += [("R", given, REROLE + more) for given in GIVEN]
    return out


@lru_cache(1 << 17)
def advance(front, code):
    """One row on: (front, moves, cost). A move is (index of the node it came from, letters)."""
    best = {}
    for order, (node, cost) in enumerate(front):
        for word, at, extra in inserted(node):
            for letter, sign, price in choices(code):
                after = at if sign is None else read(at, sign)
                if after is None:
                    continue
                key = (cost + extra + price, order, word + letter)
                if after[0] not in best or key < best[after[0]][0]:
                    best[after[0]] = (key, after)
    found = sorted(best.values(), key=lambda x: x[0][1:])
    least = min(key[0] for key, _ in found)
    return tuple((n, key[0] - least) for key, n in found), tuple(key[1:] for key, _ in found), least


@lru_cache(1 << 17)
def finish(front):
    """(cost, index of the node, inserts) of the cheapest way to end here."""
    ends = [
        (cost + extra, order, word)
        for order, (node, cost) in enumerate(front)
        for word, at, extra in inserted(node)
        if read(at, "$") is not None
    ]
    return min(ends)


def walk(codes: str, front):
    """(front, moves of every row, cost) behind a sequence of row codes."""
    trail, total = [], 0
    for code in codes:
        front, moves, cost = advance(front, code)
        trail.append(moves)
        total += cost
    return front, trail, total


def letters(trail, index: int) -> tuple[str, int]:
    """The audit that leads to the ``index``-th node of the last front, and the index it began at."""
    out = []
    for moves in reversed(trail):
        index, word = moves[index]
        out.append(word)
    return "".join(reversed(out)), index


def repair(codes: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair, ties to the least audit."""
    front, trail, total = walk(codes, ((START, 0),))
    cost, index, word = finish(front)
    return total + cost, letters(trail, index)[0] + word


@cache
def nodes() -> dict[int, tuple]:
    """A node for each state that can be on top behind a row."""
    out, todo = {0: START}, [START]
    for node in todo:
        for sign in TERMINALS:
            after = read(node, sign)
            if after is not None and after[0] not in out:
                out[after[0]] = after
                todo.append(after)
    return out


def summary(codes: str) -> list[list[int]]:
    """[top before, top behind, cost] of a piece of a conversation, in the order of audits for each
    top before. Pieces are summed up on their own and chained afterwards."""
    out = []
    for top, node in nodes().items():
        front, _, total = walk(codes, ((node, 0),))
        out += [[top, n[0], total + cost] for n, cost in front]
    return out


def chained(front: list[tuple[int, int]], piece: list[list[int]]):
    """A front [(top, cost)] past a piece: (front, index in the old front of each)."""
    ways: dict[int, list] = {}
    for before, behind, cost in piece:
        ways.setdefault(before, []).append((behind, cost))
    best = {}
    for order, (top, cost) in enumerate(front):
        for nth, (behind, price) in enumerate(ways[top]):
            key = (cost + price, order, nth)
            if behind not in best or key < best[behind]:
                best[behind] = key
    found = sorted(best.items(), key=lambda x: x[1][1:])
    return [(top, key[0]) for top, key in found], [key[1] for _, key in found]


def between(codes: str, before: int, behind: int) -> str:
    """The audit of a piece from one top to another."""
    front, trail, _ = walk(codes, ((nodes()[before], 0),))
    return letters(trail, [n[0] for n, _ in front].index(behind))[0]


def applied(audit: str, rows, last: str) -> list[str]:
    """The lines ``role:text`` that an audit makes of rows (role, text), ``last`` being the initial
    in front of them."""
    out, at = [], 0
    for letter in audit:
        role, text = (None, "") if letter == "I" else rows[at]
        at += letter != "I"
        if letter == "D":
            continue
        if letter != "K":
            role = GIVEN["a" if last == "u" else "u"]
        last = role[:1]
        out.append(f"{role}:{text}")
    return out
