"""Probabilistic automata learned from strings by merging states of their prefix tree.

States are merged in order of evidence: the most visited open state first, with a settled state of the same depth
rather than with another. Two states may become one if their steps, their ends and what is left of the strings
after them look alike. The last test keeps formats: after ten of forty characters thirty are left, after eleven
twenty-nine, so a fixed length stays a chain of states however thin the tree is there, while a run of any
length folds into a loop.

The tree may come with equal states already drawn together (:func:`counted_tree`), so that counts of any number of
strings make one of bounded size.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

#: Characters of one class are equally likely; any other character is a class of its own.
CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ")
CLASS_OF = {c: chars[0] for chars in CLASSES for c in chars}
SIZE_OF = {chars[0]: len(chars) for chars in CLASSES}
#: Confidence of the compatibility test, visits below which a state proves nothing, and the chance of a
#: step that no training string took.
ALPHA, LEAST_VISITS, UNSEEN = 0.05, 5, 1e-4
#: Places in a string that counts tell apart; those from here on are one, and so are the lengths left.
DEEP = 256
#: Pairs by which each class is taken to occur more often than seen, so that a few strings do not make what
#: follows a rare class likely.
THIN = 16
#: Log chance of a character that ordinary text never has there.
OTHER = math.log(0.1 / 128)


def classes(text: str) -> list[str]:
    return [CLASS_OF.get(c, c) for c in text]


@dataclass
class State:
    depth: int = 0
    visits: int = 0
    ends: int = 0
    left: Counter = field(default_factory=Counter)  # lengths of what follows
    steps: Counter = field(default_factory=Counter)
    to: dict[str, State] = field(default_factory=dict)
    into: State | None = None  # the state that this one has become a part of


def whole(state: State) -> State:
    """The state that a state is a part of by now."""
    while state.into is not None:
        state = state.into
    return state


def prefix_tree(texts: list[str]) -> State:
    root = State()
    for text in texts:
        state = root
        state.visits += 1
        state.left[len(text)] += 1
        for i, c in enumerate(classes(text)):
            state.steps[c] += 1
            state = state.to.setdefault(c, State(i + 1))
            state.visits += 1
            state.left[len(text) - i - 1] += 1
        state.ends += 1
    return root


def places(shape: str, common: set[str]) -> Iterator[str]:
    """The states that a string of classes passes: its prefixes while they are common, then the last common
    prefix with the place in the string, which stops at ``DEEP``, and the class before."""
    n = 0
    while n < len(shape) and shape[:n + 1] in common:
        n += 1
    for i in range(len(shape) + 1):
        yield shape[:i] if i <= n else f"{shape[:n]} {min(i, DEEP)} {shape[i - 1]}"


def count_places(shapes: Iterable[str], common: set[str]) -> Counter:
    """How often (state, class of the step or None, length of what is left or None) occurs."""
    seen: Counter = Counter()
    for shape in shapes:
        for i, state in enumerate(places(shape, common)):
            seen[state, None, min(len(shape) - i, DEEP)] += 1
            if i < len(shape):
                seen[state, shape[i], None] += 1
    return seen


def counted_tree(counts: Iterable[tuple[str, str | None, int | None, int]], common: set[str]) -> State:
    """The start state of a tree from sums of :func:`count_places`, an (…, count) each."""
    states: dict[str, State] = {}

    def state(name):
        at = name.split(" ")
        return states.setdefault(name, State(len(name) if len(at) == 1 else int(at[1])))

    start = state("")
    for name, c, left, n in sorted(counts, key=lambda x: (x[0], x[1] or "", x[2] or 0)):
        one = state(name)
        if c is None:
            one.visits += n
            one.left[left] += n
            one.ends += n if left == 0 else 0
        else:
            prefix, *tail = name.split(" ")
            follower = name + c if not tail and name + c in common else (
                f"{prefix} {min(one.depth + 1, DEEP)} {c}")
            one.steps[c] += n
            one.to[c] = state(follower)
    return start


def differ(f1: int, n1: int, f2: int, n2: int) -> bool:
    """Whether two observed frequencies are too far apart to be one (Hoeffding's bound)."""
    bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
    return abs(f1 / n1 - f2 / n2) > bound


def lengths_differ(a: State, b: State) -> bool:
    """Whether what is left after two states has different lengths: no length in the range of both, or, if
    both are well visited, distributions too far apart."""
    if max(min(a.left), min(b.left)) > min(max(a.left), max(b.left)):
        return True
    if min(a.visits, b.visits) < LEAST_VISITS:
        return False
    n, m = a.left.total(), b.left.total()
    below_a = below_b = 0
    for length in sorted(a.left.keys() | b.left.keys()):
        below_a, below_b = below_a + a.left[length], below_b + b.left[length]
        if differ(below_a, n, below_b, m):
            return True
    return False


def compatible(a: State, b: State) -> bool:
    """Whether two states, and all that follows them, look alike."""
    pairs, seen = [(a, b)], set()
    while pairs:
        a, b = map(whole, pairs.pop())
        if a is b or (id(a), id(b)) in seen:
            continue
        seen.add((id(a), id(b)))
        if lengths_differ(a, b):
            return False
        if min(a.visits, b.visits) < LEAST_VISITS:
            continue
        if differ(a.ends, a.visits, b.ends, b.visits):
            return False
        for c in a.steps.keys() | b.steps.keys():
            if differ(a.steps[c], a.visits, b.steps[c], b.visits):
                return False
        pairs += [(a.to[c], b.to[c]) for c in a.to.keys() & b.to.keys()]
    return True


def fold(into: State, tree: State, settled: set[int]) -> None:
    """Make two states one, and their followers. Of two the settled one stays."""
    pairs = [(into, tree)]
    while pairs:
        a, b = map(whole, pairs.pop())
        if a is b:
            continue
        if id(b) in settled and id(a) not in settled:
            a, b = b, a
        b.into = a
        a.visits += b.visits
        a.ends += b.ends
        a.steps.update(b.steps)
        a.left.update(b.left)
        for c, follower in b.to.items():
            if c in a.to:
                pairs.append((a.to[c], follower))
            else:
                a.to[c] = follower


@dataclass
class Automaton:
    """Log chances: ``steps[state][class] = (log chance, next state)`` and ``ends[state]``; a step that no
    training string took goes where most steps of that class go."""

    steps: list[dict[str, tuple[float, int]]]
    ends: list[float]
    others: dict[str, tuple[float, int]]

    @classmethod
    def learned(cls, texts: list[str]) -> Automaton:
        return cls.merged(prefix_tree(sorted(texts)))

    @classmethod
    def merged(cls, start: State) -> Automaton:
        """Settled states are kept. Of the states that follow one the most visited is merged into a compatible
        settled state, if there is one (of its own depth first, then the most visited), or else is settled."""
        settled = [start]
        known = {id(start)}
        while True:
            new = max(((t.visits, -t.depth, -n, t) for n, s in enumerate(settled)
                       for _, f in sorted(s.to.items()) if id(t := whole(f)) not in known), default=None,
                      key=lambda x: x[:3])
            if new is None:
                break
            tree = new[3]
            match = max((s for s in settled if compatible(s, tree)), default=None,
                        key=lambda s: (s.depth == tree.depth, s.visits))
            if match is None:
                settled.append(tree)
                known.add(id(tree))
            else:
                fold(match, tree, known)
                settled = [s for s in settled if s.into is None]
        number = {id(s): i for i, s in enumerate(settled)}
        steps = [{c: (math.log(s.steps[c] / s.visits / SIZE_OF.get(c, 1)), number[id(whole(t))])
                  for c, t in s.to.items()} for s in settled]
        taken: dict[str, Counter] = {}
        for s in settled:
            for c, t in s.to.items():
                taken.setdefault(c, Counter())[number[id(whole(t))]] += s.steps[c]
        others = {c: (math.log(UNSEEN), max(n, key=lambda i: (n[i], -i))) for c, n in taken.items()}
        return cls(steps, [math.log(max(s.ends / max(s.visits, 1), UNSEEN)) for s in settled], others)

    def step(self, state: int, c: str) -> tuple[float, int]:
        """(log chance, next state) for a class."""
        return self.steps[state].get(c) or self.others.get(c) or (math.log(UNSEEN), 0)

    def log_chance(self, text: str) -> float:
        state, total = 0, 0.0
        for c in classes(text):
            cost, state = self.step(state, c)
            total += cost
        return total + self.ends[state]


@dataclass
class Background:
    """Ordinary text: chances of a character after the class of the one before it, with equal parts of
    ordinary letters mixed in."""

    pairs: dict[tuple[str, str], float]

    @classmethod
    def learned(cls, texts: list[str]) -> Background:
        seen: Counter = Counter()
        for text in texts:
            seen.update(zip(["", *classes(text)], text))
        return cls.counted(seen)

    @classmethod
    def counted(cls, seen: dict[tuple[str, str], int]) -> Background:
        """From how often a character follows a class."""
        total: Counter = Counter()
        for (before, _), n in seen.items():
            total[before] += n
        return cls({k: math.log(0.9 * n / (total[k[0]] + THIN) + 0.1 / 128) for k, n in seen.items()})

    @classmethod
    def even(cls, chars: str) -> Background:
        """All of these characters are equally likely."""
        return cls({(k, c): -math.log(len(chars)) for k in {"", *classes(chars)} for c in chars})

    def step(self, before: str, c: str) -> float:
        """The log chance of a character after a class ('' at the start)."""
        return self.pairs.get((before, c), OTHER)

    def log_chance(self, text: str) -> float:
        return sum(map(self.step, ["", *classes(text)], text))
