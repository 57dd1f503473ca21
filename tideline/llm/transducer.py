"""Minimal acyclic transducer: words with id sequences as outputs, in flat arrays that tasks memory-map."""

from collections.abc import Iterable

import numpy as np

HEADER = 6


class _Node:
    """A state under construction: arcs as label -> [target, output]."""

    __slots__ = ("arcs", "final", "output")

    def __init__(self):
        self.arcs: dict[int, list] = {}
        self.final, self.output = False, ()


def _common(a: tuple, b: tuple) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def compile_words(entries: Iterable[tuple[bytes, tuple[int, ...]]]) -> np.ndarray:
    """One int64 array that holds the minimal transducer of the (word, ids) entries; words are distinct and not empty.

    Words are added in order. Once no later word can pass through a state it is replaced by an equal one seen
    before, so equal suffixes are stored once; outputs move towards the root as far as the words agree on them,
    which is what lets states with different ids below them become equal.
    """
    registry: dict[tuple, int] = {}
    states: list[tuple] = []

    def settled(node: _Node) -> int:
        key = (node.final, node.output, tuple((label, t, o) for label, (t, o) in sorted(node.arcs.items())))
        if key not in registry:
            registry[key] = len(states)
            states.append(key)
        return registry[key]

    path, before = [_Node()], b""

    def settle_down_to(depth: int) -> None:
        for k in range(len(before), depth, -1):
            path[k - 1].arcs[before[k - 1]][0] = settled(path.pop())

    for word, ids in sorted(entries):
        shared = _common(word, before)
        settle_down_to(shared)
        for label in word[shared:]:
            path[-1].arcs[label] = [-1, ()]
            path.append(_Node())
        path[-1].final = True
        rest = tuple(ids)
        for k in range(shared):
            arc, below = path[k].arcs[word[k]], path[k + 1]
            agree = _common(arc[1], rest)
            if agree < len(arc[1]):
                moved = arc[1][agree:]
                for other in below.arcs.values():
                    other[1] = moved + other[1]
                if below.final:
                    below.output = moved + below.output
                arc[1] = arc[1][:agree]
            rest = rest[agree:]
        path[shared].arcs[word[shared]][1] = rest
        before = word
    settle_down_to(0)
    root = settled(path[0])

    outputs: dict[tuple, int] = {(): 0}
    final, key, target, out = [], [], [], []
    for number, (is_final, output, arcs) in enumerate(states):
        final.append(outputs.setdefault(output, len(outputs)) if is_final else -1)
        for label, to, ids in arcs:
            key.append(number << 8 | label)
            target.append(to)
            out.append(outputs.setdefault(ids, len(outputs)))
    first = np.cumsum([0, *map(len, outputs)])
    pool = [i for ids in outputs for i in ids]
    header = [len(states), len(key), len(outputs), len(pool), root, 0]
    return np.concatenate([np.array(part, np.int64) for part in (header, final, key, target, out, first, pool)])


class Transducer:
    """Looks up many words at once in the arrays of `compile_words`."""

    def __init__(self, flat: np.ndarray):
        states, arcs, outputs, pool, self.root, _ = (int(v) for v in flat[:HEADER])
        ends = HEADER + np.cumsum([0, states, arcs, arcs, arcs, outputs + 1, pool])
        self.final, self.key, self.target, self.out, self.first, self.pool = (flat[a:b] for a, b in zip(ends, ends[1:]))

    @classmethod
    def open(cls, path: str) -> "Transducer":
        """Map a file that numpy.save wrote: tasks of a machine share its pages."""
        return cls(np.load(path, mmap_mode="r"))

    def lookup(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the words data[start:end]: whether each is known, the ids of the known ones one after another, and
        the number of ids of each word. All words take a step at once; a word leaves at its end or where no arc fits."""
        known = np.zeros(len(start), bool)
        live, at = np.arange(len(start)), start.astype(np.int64)
        state = np.full(len(start), self.root)
        words, outs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(live) and len(self.key):
            ended = at == end[live]
            if ended.any():
                output = self.final[state[ended]]
                done, output = live[ended][output >= 0], output[output >= 0]
                known[done] = True
                words.append(done)
                outs.append(output)
                live, at, state = live[~ended], at[~ended], state[~ended]
            key = state << 8 | data[at]
            arc = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            fits = self.key[arc] == key
            live, at, arc = live[fits], at[fits] + 1, arc[fits]
            state, output = self.target[arc], self.out[arc]
            words.append(live[output > 0])
            outs.append(output[output > 0])
        word, output = np.concatenate(words), np.concatenate(outs)
        held = known[word]
        word, output = word[held], output[held]
        order = np.argsort(word, kind="stable")
        word, output = word[order], output[order]
        sizes = self.first[output + 1] - self.first[output]
        counts = np.bincount(word, sizes, len(start)).astype(np.int64)
        return known, self.pool[spread(self.first[output], sizes)], counts


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers first[k], first[k] + 1, ... of all runs, sizes[k] of each."""
    after = np.cumsum(sizes)
    return np.arange(after[-1] if len(after) else 0) + np.repeat(first - (after - sizes), sizes)
