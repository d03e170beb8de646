"""The operators once more, in plain Python over whole small tables."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WHITE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def quality(text: str | None) -> dict:
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = collections.defaultdict(list)
    for i in range(len(words) - 7):
        windows[tuple(words[i: i + 8])].append(i)
    covered = {k for at in windows.values() if len(at) > 1 for i in at for k in range(i, i + 8)}
    n, symbols, chars = len(words), sum(c in "#*$%&|<>" for c in text), sum(map(len, words))
    base = n < 20 or 100 * len(covered) > 30 * n
    worse = 10 * symbols > n or 5 * text.count("!") > n or chars > 40 * n
    return dict(n_words=n, word_chars=chars, n_symbols=symbols, n_dup_lines=len(lines) - len(set(lines)),
                n_repeat_words=len(covered), base_failed=base, kept=not base and not worse)


def line_key(line: str) -> str:
    return line.strip(WHITE).translate(LOWER)


def line_dedup(rows: list[tuple], min_docs: int, keep_first: bool = False) -> list[tuple]:
    """(id, kept text, lines, dropped) per (id, text)."""
    found = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            found[line_key(line)].add(i)
    bad = {k: ids for k, ids in found.items() if k and len(ids) >= min_docs}
    out = []
    for i, text in rows:
        lines, kept, seen = (text or "").split("\n"), [], set()
        for line in lines:
            key = line_key(line)
            if key in bad:
                if not keep_first or i != min(bad[key], key=lambda x: (x is not None, x or 0)) or key in seen:
                    continue
                seen.add(key)
            kept.append(line)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def shingles(text: str | None, k: int = 5) -> set:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) >= k:
        return {tuple(words[i: i + k]) for i in range(len(words) - k + 1)}
    return {tuple(words)} if words else set()


class Sets:
    """Disjoint sets of row numbers."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def top(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.top(x), self.top(y)
        self.parent[max(x, y)] = min(x, y)


def near_duplicates(rows: list[tuple], percent: int = 85) -> list[tuple]:
    """(id, shingles, component id, kept) per (id, text)."""
    sets = [shingles(t) for _, t in rows]
    having = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            having[x].append(i)
    common: collections.Counter = collections.Counter()
    for at in having.values():
        common.update((a, b) for k, b in enumerate(at) for a in at[:k])
    joined = Sets(len(rows))
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            joined.join(a, b)
    least: dict = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            least[joined.top(i)] = min(name, least.get(joined.top(i), name))
    out = []
    for i, (name, _) in enumerate(rows):
        component = least.get(joined.top(i)) if sets[i] else name
        out.append((name, len(sets[i]), component, name == component))
    return out


def repeats(rows: list[tuple], length: int) -> list[tuple]:
    """(id, bytes, removed, runs, kept) per (id, text)."""
    count: collections.Counter = collections.Counter()
    raw = [(i, (t or "").encode()) for i, t in rows]
    for _, x in raw:
        count.update(x[p: p + length] for p in range(len(x) - length + 1))
    out = []
    for i, x in raw:
        gone = [False] * (len(x) + 1)
        for p in range(len(x) - length + 1):
            if count[x[p: p + length]] > 1:
                gone[p: p + length] = [True] * length
        runs = sum(gone[p] and not (p and gone[p - 1]) for p in range(len(x)))
        out.append((i, len(x), sum(gone), runs, bytes(c for p, c in enumerate(x) if not gone[p])))
    return out


def mix(rows: list[tuple]) -> tuple[dict, dict]:
    """Targets by source, and (size, words before it in its source) by (id, source), for (id, text, source)."""
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, target, open_ = sum(sizes.values()), {}, set(order)
    while open_:
        left = total - sum(target.values())
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not above:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: float(3 * sizes[s]) for s in above}
        open_ -= above
    before, run = {}, collections.Counter()
    for name, text, source in sorted(rows, key=lambda r: hashlib.md5(str("" if r[0] is None else r[0]).encode()).hexdigest()):
        n = len(WORD.findall(text or ""))
        before[name, source] = (n, run[source])
        run[source] += n
    return {s: (target[s], sizes[s]) for s in order}, before


def moments(rows: list[tuple]) -> list[tuple]:
    """(id, pass, words, moment) for each time that a document is taken, up to its target to the word; the demand curves
    added up and inverted by halving."""
    targets, before = mix(rows)
    curves = {1: lambda t: 1.5 * t - t * t / 2, 2: lambda t: t, 3: lambda t: 0.5 * t + t * t / 2}
    curve = {s: curves[k % 3 + 1] for k, s in enumerate(targets)}
    out = []
    for (name, source), (n, ahead) in before.items():
        target, size = targets[source]
        k = 0
        while n and (words := min(n, int(target) - k * size - ahead)) > 0:
            low, high, share = 0.0, 1.0, (k * size + ahead + words / 2) / target
            for _ in range(60):
                middle = (low + high) / 2
                low, high = (middle, high) if curve[source](middle) < share else (low, middle)
            out.append((name, k, words, low))
            k += 1
    return out


def pieces(rows: list[tuple], tokenizer, length: int) -> list[tuple]:
    """(id, piece, start, length, crc) for (id, text)."""
    out = []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for n, start in enumerate(range(0, len(ids), length)):
            part = ids[start: start + length]
            out.append((i, n, start, len(part), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part))))
    return out
