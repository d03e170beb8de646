"""Deep-shallow suffix sorting of byte strings, and what strings that share an anchor have in common."""

from __future__ import annotations

from bisect import bisect_left

SHALLOW, WORD = 48, 8


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n - 1  # equal up to low, different within high + 1
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _blind_trie(strings: list[bytes], group: list[int], depth: int) -> list[int]:
    """Order strings that agree up to a depth. Nodes keep a depth and the branching byte only; one comparison with the
    leaf that a blind descent ends at tells where a string belongs."""
    def byte(i: int, at: int) -> int:
        return strings[i][at] if at < len(strings[i]) else -1

    root: list = [[group[0]]]  # a leaf is [indices of equal strings]; a node is [depth, {byte: child}]
    for i in group[1:]:
        node = root[0]
        while len(node) == 2 and isinstance(node[1], dict):
            node = node[1].get(byte(i, node[0])) or next(iter(node[1].values()))
        s, t = strings[i], strings[node[0]]
        at = depth + common_prefix(s[depth:], t[depth:])
        if at == len(s) == len(t):
            node.append(i) if len(node) != 1 else node.__setitem__(slice(None), [node[0], i])
            continue
        other, parent, key = byte(node[0], at), root, 0
        node = root[0]
        while len(node) == 2 and isinstance(node[1], dict) and node[0] < at:
            parent, key = node[1], byte(i, node[0])
            node = parent[key]
        if len(node) == 2 and isinstance(node[1], dict) and node[0] == at:
            node[1][byte(i, at)] = [i]
        else:
            parent[key] = [at, {other: node, byte(i, at): [i]}]
    out: list[int] = []
    stack = [root[0]]
    while stack:
        node = stack.pop()
        if len(node) == 2 and isinstance(node[1], dict):
            stack.extend(node[1][k] for k in sorted(node[1], reverse=True))
        else:
            out.extend(node)
    return out


def deep_shallow(strings: list[bytes]) -> list[int]:
    """The order of the strings. Multikey quicksort on words of eight bytes runs to a shallow depth; groups that still
    agree there go to a blind trie."""
    out: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) == 1:
            out.append(group[0])
        elif depth >= SHALLOW:
            out.extend(_blind_trie(strings, group, depth))
        else:
            words = [strings[i][depth: depth + WORD] for i in group]
            pivot = sorted(words[:: max(1, len(words) // 7)])[min(len(words), 7) // 2]
            less = [i for i, w in zip(group, words) if w < pivot]
            more = [i for i, w in zip(group, words) if w > pivot]
            same = [i for i, w in zip(group, words) if w == pivot]
            if more:
                stack.append((more, depth))
            if len(pivot) < WORD:  # the strings end here and are equal: flat pieces of one string each
                stack.extend(([i], depth) for i in reversed(same))
            else:
                stack.append((same, depth + WORD))
            if less:
                stack.append((less, depth))
    return out


def shared(lefts: list[bytes], rights: list[bytes], least: int) -> list[list[tuple[int, int]]]:
    """Strings meet at an anchor: ``lefts`` go away from it backwards, ``rights`` forwards. For each string the
    (left, right) extents it shares with some other one, where together they have at least that length.

    The sorted right sides are joined from the longest common prefix down; each set keeps its members by the order of
    their left sides, and of two sets only neighbours in that order can share more than what is known already. The
    smaller set goes into the larger, so n strings take about n log n comparisons.
    """
    n = len(rights)
    found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    order = deep_shallow(rights)
    rank = [0] * n
    by_left = deep_shallow(lefts)
    for at, i in enumerate(by_left):
        rank[i] = at
    longest = max(map(len, lefts))
    joins = sorted(((common_prefix(rights[a], rights[b]), at) for at, (a, b) in enumerate(zip(order, order[1:]))), reverse=True)
    sets = [[rank[i]] for i in order]
    parent = list(range(n))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for right, at in joins:
        if right + longest < least:
            break
        a, b = top(at), top(at + 1)
        if len(sets[a]) < len(sets[b]):
            a, b = b, a
        large = sets[a]
        places = []
        for r in sets[b]:
            x, p = by_left[r], bisect_left(large, r)
            places.append(p)
            for q in (p - 1, p):
                if 0 <= q < len(large):
                    y = by_left[large[q]]
                    left = common_prefix(lefts[x], lefts[y])
                    if left + right >= least:
                        found[x].append((left, right))
                        found[y].append((left, right))
        if len(sets[b]) == 1:
            large.insert(places[0], sets[b][0])
        else:
            sets[a] = sorted(large + sets[b])
        parent[b] = a
    return found
