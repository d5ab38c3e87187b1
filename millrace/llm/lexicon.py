"""A minimal acyclic transducer: words in, sequences of ids out, as flat arrays that can be memory-mapped.

Words are added in byte order; states with equal futures are shared as soon as they are complete
(incremental construction), so common suffixes are stored once. Every arc carries the number of
words that sort before those it leads to; the sum along a path is the word's number, and
the number selects its ids. Look-ups run over whole batches of words, one byte position at a time.
"""

from __future__ import annotations

import hashlib
import mmap
import os
import tempfile

import numpy as np

_HEADER = 6  # number of 32-bit header fields


def compile_lexicon(entries: dict[bytes, list[int]]) -> bytes:
    """Serialise the transducer of ``entries`` (word -> ids; no empty word)."""
    register: dict[tuple, int] = {}
    arcs: list[dict[int, int]] = [{}]
    final = [False]
    path = [0]  # states along the last word
    last = b""

    def freeze(keep: int) -> None:
        while len(path) > keep + 1:
            child = path.pop()
            sign = (final[child], tuple(arcs[child].items()))
            same = register.setdefault(sign, child)
            if same != child:
                arcs[path[-1]][last[len(path) - 1]] = same

    for word in sorted(entries):
        common = len(os.path.commonprefix((word, last)))
        freeze(common)
        for byte in word[common:]:
            arcs.append({})
            final.append(False)
            arcs[path[-1]][byte] = len(arcs) - 1
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        last = word
    freeze(0)

    # Live states in depth-first order, words below each.
    order: dict[int, int] = {}
    below: dict[int, int] = {}
    stack = [(0, False)]
    while stack:
        state, done = stack.pop()
        if done:
            below[state] = final[state] + sum(below[t] for t in arcs[state].values())
        elif state not in order:
            order[state] = len(order)
            stack.append((state, True))
            stack.extend((t, False) for t in arcs[state].values() if t not in order)
    rows = []
    for state, number in order.items():
        skip = int(final[state])
        for byte, target in sorted(arcs[state].items()):
            rows.append((number << 8 | byte, order[target], skip))
            skip += below[target]
    table = np.array(sorted(rows), dtype=np.uint32).reshape(-1, 3)
    finals = np.zeros(len(order), dtype=np.uint32)
    finals[[order[s] for s in order if final[s]]] = 1
    outputs = [entries[w] for w in sorted(entries)]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in outputs])]).astype(np.uint32)
    ids = np.array([i for x in outputs for i in x], dtype=np.uint32)
    header = np.array([len(table), len(finals), len(offsets), len(ids), 0, 0], dtype=np.uint32)
    return b"".join(a.tobytes() for a in (header, table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy(), finals, offsets, ids))


class Lexicon:
    """Reader over a serialised transducer (bytes or a memory map)."""

    def __init__(self, buffer):
        a = np.frombuffer(buffer, dtype=np.uint32)
        n_arcs, n_states, n_offsets, n_ids = (int(x) for x in a[:4])
        at = _HEADER

        def take(n):
            nonlocal at
            at += n
            return a[at - n:at]

        self.keys, self.targets, self.skips = take(n_arcs), take(n_arcs), take(n_arcs)
        self.finals, self.offsets, self.ids = take(n_states), take(n_offsets), take(n_ids)

    @classmethod
    def mapped(cls, blob: bytes) -> "Lexicon":
        """Write ``blob`` once into this machine's temp folder and map it, so the Python workers of
        an executor share one copy. The file is only a cache of the broadcast bytes."""
        path = os.path.join(tempfile.gettempdir(), f"lexicon-{hashlib.sha256(blob).hexdigest()[:24]}")
        if not os.path.exists(path):
            fd, part = tempfile.mkstemp(dir=tempfile.gettempdir())
            with os.fdopen(fd, "wb") as f:
                f.write(blob)
            os.replace(part, path)
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where the lexicon does not hold it."""
        out = np.full(len(words), -1, dtype=np.int64)
        if not len(self.keys) or not words:
            return out
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        state = np.zeros(len(words), dtype=np.uint32)
        total = np.zeros(len(words), dtype=np.int64)
        alive = np.flatnonzero(lengths > 0)
        depth = 0
        while len(alive):
            key = state[alive] << np.uint32(8) | flat[starts[alive] + depth]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[at] == key
            alive, at = alive[hit], at[hit]
            state[alive] = self.targets[at]
            total[alive] += self.skips[at]
            depth += 1
            ended = lengths[alive] == depth
            done = alive[ended]
            ok = self.finals[state[done]] == 1
            out[done[ok]] = total[done[ok]]
            alive = alive[~ended]
        return out

    def output(self, number: int) -> list[int]:
        return self.ids[self.offsets[number]:self.offsets[number + 1]].tolist()
