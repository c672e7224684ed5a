"""A word lexicon as a minimal acyclic transducer in one memory-mapped file.

Words that share beginnings share states, and so do words that share endings. Each
edge carries a number; the numbers on a word's way add up to the word's place in
alphabetical order, and under that place stand the word's token ids.
"""

from __future__ import annotations

import numpy as np

MAGIC = 0x4C455849


class _Builder:
    """Daciuk's construction from sorted words: finished states are replaced by equal ones."""

    def __init__(self) -> None:
        self.edges: list[dict[int, int]] = [{}]
        self.final = [False]
        self.register: dict[tuple, int] = {}
        self.path = [0]
        self.last = b""

    def add(self, word: bytes) -> None:
        shared = 0
        for a, b in zip(word, self.last):
            if a != b:
                break
            shared += 1
        self.settle(shared)
        for byte in word[shared:]:
            state = len(self.edges)
            self.edges.append({})
            self.final.append(False)
            self.edges[self.path[-1]][byte] = state
            self.path.append(state)
        self.final[self.path[-1]] = True
        self.last = word

    def settle(self, depth: int) -> None:
        """Replace or register the states of the last word that are deeper than `depth`."""
        while len(self.path) > depth + 1:
            state = self.path.pop()
            key = (self.final[state], *self.edges[state].items())
            known = self.register.setdefault(key, state)
            if known != state:
                self.edges[self.path[-1]][self.last[len(self.path) - 1]] = known
                if state == len(self.edges) - 1:
                    self.edges.pop()
                    self.final.pop()


def compile_lexicon(words: dict[bytes, list[int]], path: str) -> None:
    """Write the transducer of `words` (not empty, with their ids) to `path`."""
    ordered = sorted(words)
    builder = _Builder()
    for word in ordered:
        builder.add(word)
    builder.settle(0)
    edges, final = builder.edges, builder.final
    # Words accepted from a state on; deep states first, without recursion.
    accepted: dict[int, int] = {}
    stack = [0]
    while stack:
        state = stack[-1]
        missing = [t for t in edges[state].values() if t not in accepted]
        if missing:
            stack.extend(missing)
            continue
        accepted[state] = final[state] + sum(accepted[t] for t in edges[state].values())
        stack.pop()
    keys, targets, skips = [], [], []
    for state in sorted(accepted):
        before = int(final[state])
        for byte, target in sorted(edges[state].items()):
            keys.append(state * 256 + byte)
            targets.append(target)
            skips.append(before)
            before += accepted[target]
    ids = [words[w] for w in ordered]
    parts = [
        np.array(keys, np.int64),
        np.array(targets, np.int64),
        np.array(skips, np.int64),
        np.array(final, np.int64),
        np.cumsum([0, *map(len, ids)], dtype=np.int64),
        np.array([i for one in ids for i in one], np.int64),
    ]
    longest = max(map(len, ordered), default=0)
    head = np.array([MAGIC, longest, *map(len, parts)], np.int64)
    np.concatenate([head, *parts]).tofile(path)


class Lexicon:
    """The lexicon in a file; only the pages that are touched come into memory."""

    def __init__(self, path: str) -> None:
        data = np.memmap(path, np.int64, "r")
        if data[0] != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        self.longest = int(data[1])
        ends = 8 + np.cumsum(data[2:8])
        starts = [8, *ends[:-1]]
        self.keys, self.targets, self.skips, self.final, self.offsets, self.ids = (
            data[a:b] for a, b in zip(starts, ends)
        )

    def places(self, words: list[bytes]) -> np.ndarray:
        """Each word's place in the lexicon, -1 for a word that is not in it."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths) - lengths
        text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        place = np.zeros(len(words), np.int64)
        state = np.zeros(len(words), np.int64)
        alive = np.flatnonzero((lengths > 0) & (lengths <= self.longest))
        found = np.full(len(words), -1, np.int64)
        depth = 0
        while len(alive) and len(self.keys):
            key = state[alive] * 256 + text[starts[alive] + depth]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            here = self.keys[edge] == key
            alive, edge = alive[here], edge[here]
            state[alive] = self.targets[edge]
            place[alive] += self.skips[edge]
            depth += 1
            ended = lengths[alive] == depth
            done = alive[ended]
            done = done[self.final[state[done]] == 1]
            found[done] = place[done]
            alive = alive[~ended]
        return found
