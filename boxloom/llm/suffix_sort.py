"""Deep-shallow suffix sorting with longest-common-prefix lengths, for groups of byte strings.

Multikey quicksort works on keys of eight bytes down to a shallow depth. Groups that are still equal
there have long common prefixes; each is ordered by a blind trie, which looks at one byte per branch
on the way down and compares a string once, with a single leaf.
"""

from __future__ import annotations

KEY = 8


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the longest common prefix, of which ``known`` bytes are known to agree."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    while high - low > 16:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    while a[low] == b[low]:
        low += 1
    return low


class _Node:
    __slots__ = ("depth", "edges", "leaf")

    def __init__(self, depth: int, leaf: int):
        self.depth, self.edges, self.leaf = depth, {}, leaf


def _byte(s: bytes, at: int) -> int:
    return s[at] if at < len(s) else -1


def blind_trie_order(strings: list[bytes], group: list[int], known: int) -> tuple[list[int], list[int]]:
    """Sorted order of ``group`` (indices of ``strings``) and the common prefix with the one before.

    The first prefix is 0. A node holds the depth at which its strings part and one edge a byte;
    leaves hold lists of equal strings.
    """
    root: _Node | list[int] = [group[0]]
    for new in group[1:]:
        s = strings[new]
        at = root
        while isinstance(at, _Node):  # blindly to some leaf
            at = at.edges.get(_byte(s, at.depth)) or at.leaf
        other = strings[at[0]]
        depth = common_prefix(s, other, known)
        if depth == len(s) == len(other):
            at.append(new)
            continue
        up, edge, at = None, -1, root
        while isinstance(at, _Node) and at.depth < depth:
            up, edge = at, _byte(s, at.depth)
            at = at.edges[edge]
        if isinstance(at, _Node) and at.depth == depth:
            at.edges[_byte(s, depth)] = [new]
            continue
        split = _Node(depth, at.leaf if isinstance(at, _Node) else at)
        split.edges[_byte(other, depth)] = at
        split.edges[_byte(s, depth)] = [new]
        if up is None:
            root = split
        else:
            up.edges[edge] = split
    order: list[int] = []
    prefix: list[int] = []
    stack: list = [(root, 0)]
    while stack:
        at, shared = stack.pop()
        if isinstance(at, _Node):
            below = sorted(at.edges.items(), reverse=True)
            stack += [(x, at.depth) for _, x in below[:-1]]
            stack.append((below[-1][1], shared))
        else:
            order += at
            prefix += [shared] + [len(strings[at[0]])] * (len(at) - 1)
    return order, prefix


def deep_shallow_order(strings: list[bytes], known: int = 0, shallow: int = 16) -> tuple[list[int], list[int]]:
    """Sorted order of ``strings`` and the common prefix of each with the one before (0 for the first).

    ``known`` bytes are known to agree in all; keys are compared to ``shallow`` bytes beyond them.
    """
    order: list[int] = []
    prefix: list[int] = []
    stack = [(list(range(len(strings))), known)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            more, shared = group, [0]
        elif depth >= known + shallow:
            more, shared = blind_trie_order(strings, group, depth)
        else:
            pivot = strings[group[len(group) // 2]][depth : depth + KEY]
            less, same, rest = [], [], []
            for i in group:
                key = strings[i][depth : depth + KEY]
                (same if key == pivot else less if key < pivot else rest).append(i)
            if len(pivot) == KEY:
                parts = [(rest, depth), (same, depth + KEY), (less, depth)]
            else:  # ended strings: all of them are equal
                parts = [(rest, depth), (same, known + shallow), (less, depth)]
            stack += [x for x in parts if x[0]]
            continue
        if order:
            shared[0] = common_prefix(strings[order[-1]], strings[more[0]], known)
        order += more
        prefix += shared
    return order, prefix
