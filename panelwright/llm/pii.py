"""Personal data by a semi-Markov conditional random field.

Four kinds have fixed forms and are found by pattern: email, ip, card and phone. A semi-Markov field adds spans that
such patterns miss: e-mail addresses that are spelled out, phone numbers without a country code, identity and account
numbers, and secrets such as passwords and access keys. It scores whole candidate spans by what they look like and what
stands before them, and dynamic programming over spans of bounded length picks boundaries and kinds together.

A span of the field holds a trigger: a token with a digit, an @, an "at" in brackets, or what a word such as password is
said to be. So it is decoded on the tokens around triggers only, whole texts being scanned for those, and the result is that
of decoding the whole text. Spans that can't have a positive score, by a bound from what stands before them and how long they
are, are not looked at closer, which changes nothing and keeps tables of numbers cheap. Spans found by pattern stay and are
barriers. The field is trained here by maximum likelihood on sentences that ``labelled`` writes.

Cases: a null or empty text has no spans. Null ids, repeated rows and extra columns don't matter, as each text is read by
itself. Ties between decodings go to fewer spans. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column, text_or_empty

BASE = ("email", "ip", "card", "phone")
LABELS = ("email", "phone", "id", "secret")
LONGEST, AROUND = 24, 26
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _byte(digits: str) -> bool:
    """Whether they are 255 at most; runs of any length, which int() refuses."""
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or "0") <= 255


def _luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> list[Span]:
    """The pattern local@domain, found from its @: the local part reaches back as far as it can."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def base_spans(text: str) -> list[Span]:
    """Spans with a fixed form, by start and then by kind."""
    out = _emails(text) if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(_byte(p) for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = _digits(m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15] if "+" in text else []
    return sorted(out, key=lambda s: (s[1], BASE.index(s[0])))


# --- the field -------------------------------------------------------------------------------------------------------

#: A secret's own word comes before what it is set to.
_TRIGGER = re.compile(r"[^\W_]*[0-9][^\W_]*|@|[\[({<]\s?at\s?[\])}>]|\b(?:password|passwd|passphrase|pwd|secret)\s?[:=]\s?[\"']?([^\W_]+)", re.I)
_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
_AT = re.compile(r"[\[({<]\s?at\s?[\])}>]", re.I)
_DOT = r"(?:\.|\s?[\[({<]\s?dot\s?[\])}>]\s?|\sdot\s)"
_ADDRESS = re.compile(rf"[\w+-]+(?:{_DOT}[\w+-]+)*\s?[\[({{<]\s?at\s?[\])}}>]\s?[\w-]+(?:{_DOT}[\w-]+)+")
_GOES_ON = re.compile(rf"{_DOT}[a-z]", re.I)
_SHAPES = re.compile(r"[0-9]+|[^\W\d_]+|\s+")


def _shape(text: str) -> str:
    """Digit runs by their length, letters as one mark, spaces as one."""
    return _SHAPES.sub(lambda m: (str(min(len(m[0]), 9)) + "d") if m[0][0].isdigit() else " " if m[0].isspace() else "a", text)


def _mixture(text: str) -> str:
    kinds = (any(c.isdigit() for c in text), any(c.islower() for c in text), any(c.isupper() for c in text))
    return "".join(k for k, has in zip("dlu", kinds) if has)


def _start_features(text: str, tokens: list[tuple[int, int]], i: int) -> list[str]:
    """Of a span that starts at token i, whatever its end."""
    start = tokens[i][0]
    before = [text[a:b].lower() for a, b in tokens[max(0, i - 3): i]]
    word = next((t for t in reversed(before) if t[0].isalpha()), "-")
    out = ["bias", f"word:{word}", f"before:{before[-1] if before else '-'}", f"first:{text[start] if not text[start].isalnum() else 'x'}"]
    if i and tokens[i - 1][1] == start and text[start - 1].isalnum() is False and text[start - 1] in "-.@_/":
        out.append("joined before")
    return out


def span_features(text: str, tokens: list[tuple[int, int]], i: int, j: int) -> list[str]:
    """Of the span from token i to before token j, as a whole."""
    start, end = tokens[i][0], tokens[j - 1][1]
    span = text[start:end]
    plain = "".join(c for c in span if c.isalnum())
    n_digits, lower = len(_digits(plain)), span.lower()
    shape = _shape(span)
    alone = j == i + 1
    kind = f"{_mixture(plain)}:{min(len(plain) // 4, 10)}"
    out = [*_start_features(text, tokens, i), f"shape:{shape}", f"tokens:{j - i}", f"last:{span[-1] if not span[-1].isalnum() else 'x'}",
           f"digits:{min(n_digits, 12)}", f"{'one' if alone else 'many'}:{kind}"]
    if alone and plain and n_digits and len(plain) >= 12 and n_digits < len(plain):
        out.append("hex" if all(c in "0123456789abcdef" for c in lower) else "key")
    if _AT.search(lower):
        out.append("at")
        out.append("dotted" if re.search(r"(?:\.|[\[({<]?\s?dot\s?[\])}>]?)\s?[a-z]{2,}$", lower) else "undotted")
        if _ADDRESS.fullmatch(lower):
            out.append("part of address" if _GOES_ON.match(text, end) or "joined before" in out else "whole address")
    if j < len(tokens) and tokens[j][0] == end and text[end] in "-@_/" or j + 1 < len(tokens) and text[end: end + 1] == "." and tokens[j + 1][0] == end + 1:
        out.append("joined after")
    return out


def candidates(text: str, tokens: list[tuple[int, int]], triggers: set[int]) -> list[tuple[int, int]]:
    """Token spans that hold a trigger and begin and end with something that an entity can."""
    held = [0]
    for k in range(len(tokens)):
        held.append(held[-1] + (k in triggers))
    out = []
    for i, (a, b) in enumerate(tokens):
        if not (text[a].isalnum() or text[a] in "(+"):
            continue
        for j in range(i + 1, min(len(tokens), i + LONGEST) + 1):
            if "\n" in text[tokens[j - 1][0] if j == i + 1 else tokens[j - 2][1]: tokens[j - 1][0]]:
                break
            if held[j] > held[i] and text[tokens[j - 1][1] - 1].isalnum():
                out.append((i, j))
    return out


def _trigger_spans(text: str) -> Iterator[tuple[int, int]]:
    for m in _TRIGGER.finditer(text):
        yield m.span(1) if m[1] is not None else m.span()


def _triggers(text: str, tokens: list[tuple[int, int]]) -> set[int]:
    """The tokens that triggers touch; both come in order."""
    found, k = set(), 0
    for start, end in _trigger_spans(text):
        while k < len(tokens) and tokens[k][1] <= start:
            k += 1
        t = k
        while t < len(tokens) and tokens[t][0] < end:
            found.add(t)
            t += 1
    return found


Weights = dict[str, tuple[float, ...]]


class Field:
    """Weights, and for each label the most that features can add that aren't known before a span is looked at closely."""

    #: Features of where a span starts, how many tokens, digits and letters it has and its shape, which are known; of
    #: spelled-out addresses; of single tokens. All others are bounded for all spans.
    KNOWN = ("bias", "tokens", "word", "before", "first", "joined before", "shape", "digits", "many")
    ADDRESS = ("at", "dotted", "undotted", "part of address", "whole address")
    ALONE = ("hex", "key", "one")

    def __init__(self, weights: Weights):
        self.weights = weights
        groups: dict[str, list[tuple[float, ...]]] = {}
        for name, w in weights.items():
            groups.setdefault(name.partition(":")[0], []).append(w)

        def most(wanted) -> list[float]:
            best = [[max(0.0, *(w[k] for w in ws)) for k in range(len(LABELS))] for g, ws in groups.items() if wanted(g)]
            return [sum(b[k] for b in best) for k in range(len(LABELS))]

        self.address, self.alone = most(lambda g: g in self.ADDRESS), most(lambda g: g in self.ALONE)
        self.others = most(lambda g: g not in (*self.KNOWN, *self.ADDRESS, *self.ALONE))

    def sum(self, names: list[str]) -> list[float]:
        found = [w for f in names if (w := self.weights.get(f)) is not None]
        return [sum(w[k] for w in found) for k in range(len(LABELS))]

    def spans(self, text: str, tokens: list[tuple[int, int]], triggers: set[int]) -> Iterator[tuple[int, int, int, float]]:
        """(from token, to token, label, score) of the candidates with a positive score."""
        weights, n_tokens, nothing = self.weights, len(tokens), (0.0,) * len(LABELS)
        shapes = [_shape(text[a:b]) for a, b in tokens]
        ends_well = [text[b - 1].isalnum() for _, b in tokens]
        gaps = [text[a[1]: b[0]] for a, b in zip(tokens, tokens[1:])]
        at_ends = [m.end() for m in _AT.finditer(text)]
        chars = [text[a:b] for a, b in tokens]
        sums = [[0] for _ in range(5)]  # of digits, of letters and digits, of tokens with a digit, a small and a great letter
        for c in chars:
            for total, n in zip(sums, (len(_digits(c)), len(c) if c[0].isalnum() else 0, any(map(str.isdigit, c)), any(map(str.islower, c)),
                                       any(map(str.isupper, c)))):
                total.append(total[-1] + n)
        digits, plain, *mixed = sums
        by_digits = [self.sum([f"digits:{n}"]) for n in range(13)]
        by_kind = {(m, n): self.sum([f"many:{''.join(c for c, x in zip('dlu', m) if x)}:{n}"])
                   for m in itertools.product((False, True), repeat=3) for n in range(11)}
        most_of = [max(0.0, *(w[k] for w in by_digits)) + max(0.0, *(w[k] for w in by_kind.values())) for k in range(len(LABELS))]
        # the most that a span of n tokens can have besides what stands before it and its shape, digits and letters
        by_count = [[c + o for c, o in zip(self.sum([f"tokens:{n}"]), self.others)] for n in range(LONGEST + 1)]
        by_count[1] = [x + y for x, y in zip(by_count[1], self.alone)]
        next_held, held = n_tokens, [0] * n_tokens  # the next trigger at or after each token
        for k in range(n_tokens - 1, -1, -1):
            next_held = k if k in triggers else next_held
            held[k] = next_held
        for i, (a, _) in enumerate(tokens):
            if held[i] >= min(n_tokens, i + LONGEST) or not (text[a].isalnum() or text[a] in "(+"):
                continue
            before = self.sum(_start_features(text, tokens, i))
            last = tokens[min(n_tokens, i + LONGEST) - 1][1]
            at = bisect.bisect_left(at_ends, a)
            if at < len(at_ends) and at_ends[at] <= last:
                before = [x + y for x, y in zip(before, self.address)]
            possible = [any(x + c + m > 0 for x, c, m in zip(before, most, most_of)) for most in by_count]
            shape = shapes[i]
            for j in range(i + 1, min(n_tokens, i + LONGEST) + 1):
                if j > i + 1:
                    gap = gaps[j - 2]
                    if "\n" in gap:
                        break
                    shape += (" " if gap else "") + shapes[j - 1]
                if held[i] >= j or not ends_well[j - 1]:
                    continue
                own = weights.get("shape:" + shape, nothing)
                if own is nothing and not possible[j - i]:
                    continue
                by_d = by_digits[min(digits[j] - digits[i], 12)]
                by_k = by_kind[tuple(m[j] > m[i] for m in mixed), min((plain[j] - plain[i]) // 4, 10)] if j > i + 1 else nothing
                if all(x + c + o + d + k <= 0 for x, c, o, d, k in zip(before, by_count[j - i], own, by_d, by_k)):
                    continue
                for k, score in enumerate(self.sum(span_features(text, tokens, i, j))):
                    if score > 0:  # below, single tokens are better
                        yield i, j, k, score


def decode(text: str, field: Field | Weights) -> list[Span]:
    """The best segmentation of a text into spans and single tokens (which score nothing)."""
    field = field if isinstance(field, Field) else Field(field)
    tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    triggers = _triggers(text, tokens)
    if not triggers:
        return []
    ending: dict[int, list[tuple[int, float, str]]] = {}
    for i, j, k, score in field.spans(text, tokens, triggers):
        ending.setdefault(j, []).append((i, score, LABELS[k]))
    best: list[float] = [0.0]
    step: list[tuple[int, str | None]] = [(0, None)]
    for j in range(1, len(tokens) + 1):
        top, how = best[j - 1], (j - 1, None)
        for i, score, label in ending.get(j, ()):
            if best[i] + score > top:
                top, how = best[i] + score, (i, label)
        best.append(top)
        step.append(how)
    out, j = [], len(tokens)
    while j:
        i, label = step[j]
        if label:
            out.append((label, tokens[i][0], tokens[j - 1][1]))
        j = i
    return out[::-1]


def added_spans(text: str, base: list[Span], field: Field | Weights) -> list[Span]:
    """The field's spans outside those found by pattern. Stretches around triggers are decoded by themselves: between
    stretches no span can stand, and at their edges they hold all tokens that a span of LONGEST could use."""
    field = field if isinstance(field, Field) else Field(field)
    taken, out, last = [(s, e) for _, s, e in base], [], None
    stretches: list[list[int]] = []
    at = 0
    for start, end in _trigger_spans(text):
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at < len(taken) and taken[at][0] < end:
            continue
        if last is not None and not _apart(text, last, start):
            stretches[-1][1] = end
        else:
            stretches.append([start, end])
        last = end
    for first, end in stretches:
        low, high = first, end
        for _ in range(AROUND):
            low = _before(text, low)
            m = _TOKEN.search(text, high)
            high = m.end() if m else high
        for s, e in taken:
            if s < first and e > low:
                low = e
            if e > end and s < high:
                high = s
        cuts = [low, *[x for s, e in taken if s >= low and e <= high for x in (s, e)], high]
        for a, b in zip(cuts[::2], cuts[1::2]):
            out.extend((kind, a + s, a + e) for kind, s, e in decode(text[a:b], field))
    return sorted({s for s in out if not any(s[1] < e and s[2] > b for b, e in taken)}, key=lambda s: (s[1], s[2], s[0]))


def _apart(text: str, a: int, b: int) -> bool:
    return sum(1 for _ in itertools.islice(_TOKEN.finditer(text, a, b), 2 * AROUND + 1)) > 2 * AROUND


def _before(text: str, at: int) -> int:
    """Where the token before a position starts."""
    while at and not (text[at - 1].isalnum() or not text[at - 1].isspace()):
        at -= 1
    if at and not text[at - 1].isalnum():
        return at - 1
    while at and text[at - 1].isalnum():
        at -= 1
    return at


# --- training --------------------------------------------------------------------------------------------------------

SENTENCES, STEPS, RATE, DAMPING = 2000, 80, 0.1, 0.15


class _Sentences:
    """Writes sentences with labelled spans, and sentences with numbers that are no personal data."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.syllables = [a + b for a in "b c d f g l m n p r s t v th st".split() for b in "a e i o u an er on is é ü".split()]

    def word(self) -> str:
        return "".join(self.r.choices(self.syllables, k=self.r.randint(1, 3)))

    def digits(self, n: int) -> str:
        return "".join(self.r.choices("0123456789", k=n))

    def of(self, alphabet: str, n: int) -> str:
        while True:
            out = "".join(self.r.choices(alphabet, k=n))
            if any(c.isdigit() for c in out) and any(c.isalpha() for c in out):
                return out

    def entity(self) -> tuple[str, str, str]:
        """(what stands before, the span, its label)"""
        r, d, w = self.r, self.digits, self.word
        label = r.choice(LABELS)
        if label == "email":
            at = r.choice((" [at] ", "[at]", " (at) ", "(at)", " {at} ", " <at> "))
            dot = r.choice((".", " dot ", " [dot] ", "[dot]", ".", " (dot) "))
            local = w() + r.choice(("", "." + w(), "_" + w(), d(2), "." + d(2)))
            parts = [w() for _ in range(r.choice((1, 1, 2, 2, 3)))]
            if r.random() < 0.15:
                local = dot.join((local, w()))
            return r.choice(("", "mail", "contact", "email:", "write to")), local + at + dot.join(parts) + dot + r.choice(("com", "org", "net", "de", "example.com")), label
        if label == "phone":
            form = r.choice((f"({d(3)}) {d(3)}-{d(4)}", f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}.{d(3)}.{d(4)}", f"({d(3)}){d(3)}-{d(4)}", f"0{d(2)} {d(3)} {d(4)}", f"0{d(3)}/{d(6)}"))
            return r.choice(("", "call", "tel", "phone:", "tel:", "phone")), form, label
        if label == "id":
            if r.random() < 0.6:
                return r.choice(("ssn", "ssn:", "SSN", "", "social security number")), f"{d(3)}-{d(2)}-{d(4)}", label
            return r.choice(("iban", "IBAN:", "account", "")), r.choice(("DE", "FR", "ES", "GB")) + d(2) + " " + " ".join(d(4) for _ in range(4)) + " " + d(2), label
        kind = r.random()
        if kind < 0.2:
            letters = "abcdefghijklmnopqrstuvwxyz"
            before = r.choice(("password:", "password =", "passwd=", "secret=", "pwd:", 'password="', "passphrase:"))
            return before, "".join(r.choices(letters + letters[::2].upper(), k=r.randint(7, 14))), label
        if kind < 0.4:
            return r.choice(("password=", "password:", "passwd=", "pwd =", "password =")), self.of("0123456789abcdef", r.randint(10, 24)), label
        if kind < 0.7:
            return r.choice(('token = "', 'token="', "api_key=", 'secret: "', "token:", 'api_key = "', "secret=")), self.of("0123456789abcdef", r.choice((32, 40, 40, 64))), label
        if kind < 0.9:
            return r.choice(("", "", "key")), "AKIA" + self.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 16), label
        return r.choice(("", "key", "token")), r.choice(("ghp_", "sk_live_", "xoxb_")) + self.of("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 30), label

    def number(self) -> str:
        r, d, w = self.r, self.digits, self.word
        return r.choice((f"{r.randint(1, 31)}.{r.randint(1, 12)}.20{d(2)}", f"20{d(2)}-0{r.randint(1, 9)}-{r.randint(10, 28)}", f"version {r.randint(1, 9)}.{r.randint(0, 9)}", f"{r.randint(1, 9)}.{r.randint(0, 9)}.{r.randint(0, 20)}",
                         f"${d(2)}.{d(2)}", f"{d(1)},{d(3)},{d(3)}", f"{r.randint(1, 12)}:{r.randint(10, 59)}", f"19{d(2)}", f"20{d(2)}", f"({d(4)})", f"{d(2)}%", f"page {d(3)}", f"{d(2)}-{d(2)}",
                         f"{w()}{d(2)}", f"[{d(1)}]", f"ISBN {d(3)}-{d(1)}-{d(4)}", f"{d(12)}", f"{d(16)}", f"{d(4)} {d(4)}", f"{d(2)} {w()}", f"@{w()}", f"{w()} {d(5)}", f"RFC {d(4)}", f"{d(3)}.{d(3)}", f"{w()}-{d(3)}-{d(2)}",
                         f"secret: {r.choice(('the', 'of', 'a', 'in', 'not', 'it', 'we', 'for'))} {w()}", f"password: {r.choice(('see', 'is', 'the', 'to', 'your'))} {w()}",
                         "GNU General Public License, version 3.", "CC BY-NC 4.0.", "Apache License, Version 2.0.", f"{d(3)}.{d(3)}.{d(3)}.{d(3)}", f"{d(20)}"))

    def sentence(self) -> tuple[str, list[Span]]:
        r, text, spans = self.r, "", []
        for part in range(r.choice((1, 1, 2))):
            text += " ".join(self.word() for _ in range(r.randint(0, 4)))
            text += " " if text else ""
            if r.random() < 0.6:
                before, span, label = self.entity()
                if before:
                    text += before + ("" if before[-1] in '="' else " ")
                spans.append((label, len(text), len(text) + len(span)))
                text += span + ('"' if before.endswith('"') else "")
            else:
                text += self.number()
            text += r.choice((" ", ", ", ". ", " "))
        return text + " ".join(self.word() for _ in range(r.randint(0, 4))), spans


def labelled(n: int = SENTENCES, seed: int = 5) -> list[tuple[str, list[Span]]]:
    writer = _Sentences(seed)
    return [writer.sentence() for _ in range(n)]


def train(sentences: list[tuple[str, list[Span]]], steps: int = STEPS) -> Weights:
    """Maximum likelihood over all segmentations, by Adam; sums over segmentations run forwards and backwards."""
    names: dict[str, int] = {}
    slots, found = [], []
    plans, offset = [], 0
    for text, spans in sentences:
        tokens = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
        pairs = candidates(text, tokens, _triggers(text, tokens))
        gold = {(a, b): LABELS.index(kind) for kind, a, b in spans}
        truth = []
        for k, (i, j) in enumerate(pairs):
            for f in span_features(text, tokens, i, j):
                found.append(names.setdefault(f, len(names)))
                slots.append(offset + k)
            if (tokens[i][0], tokens[j - 1][1]) in gold:
                truth.append((offset + k, gold[tokens[i][0], tokens[j - 1][1]]))
        plans.append((len(tokens), offset, np.array(pairs, int).reshape(-1, 2), truth))
        offset += len(pairs)
    slot, feature = np.array(slots), np.array(found)
    longest = max(n for n, *_ in plans)
    rows = np.concatenate([np.full(len(p), s) for s, (_, _, p, _) in enumerate(plans)])
    starts, ends = np.concatenate([p[:, 0] for _, _, p, _ in plans]), np.concatenate([p[:, 1] for _, _, p, _ in plans])
    sizes = np.array([n for n, *_ in plans])
    by_end = [np.flatnonzero(ends == t) for t in range(longest + 1)]
    by_start = [np.flatnonzero(starts == t) for t in range(longest + 1)]
    observed = np.zeros((offset, len(LABELS)))
    for _, _, _, truth in plans:
        for k, label in truth:
            observed[k, label] = 1
    w = np.zeros((len(names), len(LABELS)))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        score = np.stack([np.bincount(slot, w[feature, k], offset) for k in range(len(LABELS))], axis=1)
        whole = np.logaddexp.reduce(score, axis=1)
        forward, backward = np.full((len(plans), longest + 1), -np.inf), np.full((len(plans), longest + 1), -np.inf)
        forward[:, 0] = 0
        for t in range(1, longest + 1):
            forward[:, t] = forward[:, t - 1]
            np.logaddexp.at(forward[:, t], rows[by_end[t]], forward[rows[by_end[t]], starts[by_end[t]]] + whole[by_end[t]])
        backward[np.arange(len(plans)), sizes] = 0
        for t in range(longest - 1, -1, -1):
            backward[:, t] = np.where(t < sizes, backward[:, t + 1], backward[:, t])
            np.logaddexp.at(backward[:, t], rows[by_start[t]], backward[rows[by_start[t]], ends[by_start[t]]] + whole[by_start[t]])
        total = forward[np.arange(len(plans)), sizes]
        likely = np.exp(forward[rows, starts][:, None] + score + backward[rows, ends][:, None] - total[rows][:, None])
        gap = observed - likely
        gradient = np.stack([np.bincount(feature, gap[slot, k], len(names)) for k in range(len(LABELS))], axis=1) - DAMPING * w
        m += 0.1 * (gradient - m)
        v += 0.01 * (gradient * gradient - v)
        w += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return {f: tuple(map(float, w[i])) for f, i in names.items()}


@functools.lru_cache(maxsize=1)
def default_weights() -> Weights:
    return train(labelled())


def as_text(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _find(weights: Weights):
    order = {k: n for n, k in enumerate((*BASE, *(x for x in LABELS if x not in BASE)))}

    def run(batches):
        field = Field(weights)
        for batch in batches:
            base, every = [], []
            for text in batch.column("text"):
                text = text.as_py()
                fixed = base_spans(text)
                more = added_spans(text, fixed, field)
                base.append(fixed)
                every.append(sorted([*fixed, *more], key=lambda s: (s[1], order[s[0]])) if more else fixed)
            kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            as_rows = lambda found: pa.array([[dict(zip(("kind", "start", "end"), s)) for s in x] for x in found], kinds)
            yield pa.RecordBatch.from_arrays([batch.column("id"), as_rows(base), as_rows(every)], ["id", "base", "spans"])
    return run


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", weights: Weights | None = None) -> DataFrame:
    """Per row: id, ``base`` (spans found by pattern) and ``spans`` (all); positions in code points, end exclusive."""
    rows = docs.select(column(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    spans = "array<struct<kind:string,start:int,end:int>>"
    return rows.mapInArrow(_find(weights or default_weights()), f"id {kind}, base {spans}, spans {spans}")
