"""Deep-shallow sorting of byte strings, with the common prefix of each pair of neighbours.

Shallow part: multikey quicksort whose characters are words of eight bytes, down
to ``SHALLOW`` bytes. Deep part: strings that still agree there (and groups of at
most ``SMALL`` strings at any depth) go into a blind trie. The trie keeps branching
bytes and depths only; a string is carried down blindly, compared once with the
leaf it meets, and hung in at the depth of their common prefix. Reading the trie
in order gives the sorted strings and their common prefixes without comparing them
again.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 64
SMALL = 24
_END = -1  # branch of a string that ends at its node


def common_prefix(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix, by halving the range that holds the first difference."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] == b[:lo], the first difference is before hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class BlindTrie:
    """Inner nodes are ``[depth, {byte: child}]``, leaves are lists of the numbers of equal strings."""

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, None

    def _branch(self, s: bytes, depth: int) -> int:
        return s[depth] if depth < len(s) else _END

    def add(self, number: int) -> None:
        s = self.strings[number]
        if self.root is None:
            self.root = ([number],)
            return
        node = self.root
        while len(node) == 2:  # blindly: where no branch fits, any will do
            children = node[1]
            node = children.get(self._branch(s, node[0])) or next(iter(children.values()))
        met = self.strings[node[0][0]]
        same = common_prefix(s, met)
        if same == len(s) == len(met):
            node[0].append(number)
            return
        above, node = None, self.root
        while len(node) == 2 and node[0] < same:
            above, node = node, node[1][s[node[0]]]
        leaf = ([number],)
        if len(node) == 2 and node[0] == same:
            node[1][self._branch(s, same)] = leaf
            return
        split = [same, {self._branch(met, same): node, self._branch(s, same): leaf}]
        if above is None:
            self.root = split
        else:
            above[1][s[above[0]]] = split

    def in_order(self) -> tuple[list[int], list[int]]:
        """Numbers in order of their strings, and each one's common prefix with the one before."""
        order: list[int] = []
        common: list[int] = []
        stack = [(self.root, 0)] if self.root is not None else []
        while stack:
            node, before = stack.pop()
            if len(node) == 1:
                length = len(self.strings[node[0][0]])
                order += node[0]
                common += [before] + [length] * (len(node[0]) - 1)
            else:
                children = sorted(node[1].items(), reverse=True)
                stack += [(child, node[0]) for _, child in children[:-1]]
                stack.append((children[-1][1], before))
        return order, common


def _shallow_groups(words: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Multikey quicksort on the columns of ``words``: an order and its runs that are left to the tries."""
    order = np.arange(len(words))
    runs, stack = [], [(0, len(words), 0)]
    while stack:
        lo, hi, depth = stack.pop()
        if hi - lo <= SMALL or depth == words.shape[1]:
            if hi - lo > 1:
                runs.append((lo, hi))
            continue
        part = order[lo:hi]
        key = words[part, depth]
        pivot = np.partition(key, len(key) // 2)[len(key) // 2]
        less, more = part[key < pivot], part[key > pivot]
        order[lo:hi] = np.concatenate([less, part[key == pivot], more])
        a, b = lo + len(less), hi - len(more)
        stack += [(lo, a, depth), (a, b, depth + 1), (b, hi, depth)]
    return order, runs


def sort_strings(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): ``common[i]`` is the common prefix of the strings at places i - 1 and i, 0 at the first."""
    n = len(strings)
    if not n:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    head = np.frombuffer(b"".join([s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings]), np.uint8).reshape(n, SHALLOW)
    order, runs = _shallow_groups(head.view(">u8").astype(np.uint64))
    inside = np.zeros(n, dtype=bool)
    common = np.zeros(n, dtype=np.int64)
    for lo, hi in runs:
        trie = BlindTrie(strings)
        for number in order[lo:hi].tolist():
            trie.add(number)
        order[lo:hi], common[lo:hi] = trie.in_order()
        inside[lo + 1: hi] = True
    edge = np.flatnonzero(~inside)[1:]  # neighbours from two groups differ within the shallow part
    if len(edge):
        lengths = np.array([len(s) for s in strings])
        a, b = order[edge - 1], order[edge]
        differ = head[a] != head[b]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), SHALLOW)
        common[edge] = np.minimum(first, np.minimum(lengths[a], lengths[b]))
    common[0] = 0
    return order, common
