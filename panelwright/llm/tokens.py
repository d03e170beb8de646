"""Token ids of whole texts by a public BPE tokenizer with word ends.

Such a tokenizer never looks across white space, nor across the letter runs, digits and signs that it cuts a chunk into, so
a text's ids are those of its parts in a row. A task keeps the ids of the parts that it has met, in a cache of fixed size;
what is new in some texts goes through the tokenizer together. Texts that aren't all Latin are taken by chunks between white
space: chunks outside Latin script, and those with special tokens, go to the tokenizer as they are.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
import regex

CHUNKS, PARTS = 200_000, 600_000
#: Parts that a worker keeps when a task ends or the cache is full.
KEPT = 100_000
#: Characters of texts whose new parts are learnt together.
TOGETHER = 1 << 20
_SIMPLE = re.compile(r"[\x21-\x7e¡-ɏ]+")
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
#: How the tokenizer cuts a chunk (a fixed value of its file).
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Texts of Latin letters, ASCII and white space, and the same cut for them once in lower case.
_LATIN = re.compile(r"[\t-\r\x20-\x7e¡-ɏ]*")
_LETTER, _NUMBER = "a-zªµºß-öø-ɏ", "0-9²³¹¼½¾"
_LATIN_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\s{_LETTER}{_NUMBER}]+")
_encoders: dict[str, "Encoder"] = {}


def encoder(path: str | None = None) -> "Encoder":
    """The worker's encoder for a tokenizer file; without a path, the public 49k one installed on the machine."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.chunks: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def forget(self, kept: int = KEPT) -> None:
        """Keep the parts that were learnt first, which are the frequent ones; the worker may go on with other work."""
        self.chunks.clear()
        for part in list(itertools.islice(reversed(self.parts), max(0, len(self.parts) - kept))):
            del self.parts[part]

    def direct(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn_parts(self, new: list[str]) -> None:
        for at in range(0, len(new), 2000):
            some = new[at: at + 2000]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(some):  # a part that isn't one by itself
                self.parts.update((p, self.direct(p)) for p in some)
                continue
            raw, start = ids.tobytes(), 0
            for part, end in zip(some, (4 * ends).tolist()):
                self.parts[part] = raw[start:end]
                start = end

    def _learn(self, new: set[str]) -> None:
        if len(self.chunks) + len(new) > CHUNKS:
            self.chunks.clear()
        cut = {}
        for chunk in new:
            if _SIMPLE.fullmatch(chunk) and "<|" not in chunk:
                cut[chunk] = _PARTS.findall(chunk.lower())
            else:
                self.chunks[chunk] = self.direct(chunk)
        self._learn_parts(list({p for parts in cut.values() for p in parts}.difference(self.parts)))
        get = self.parts.__getitem__
        self.chunks.update((chunk, b"".join(map(get, parts))) for chunk, parts in cut.items())

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. New parts of some texts go through the tokenizer together."""
        out: list[bytes] = []
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= TOGETHER:
                out += self._encode_some(held)
                held, size = [], 0
        return out + self._encode_some(held)

    def _encode_some(self, texts: list[str]) -> list[bytes]:
        plain = {i: _LATIN_PARTS.findall(t.lower()) for i, t in enumerate(texts) if _LATIN.fullmatch(t) and "<|" not in t}
        new = set().union(*plain.values()).difference(self.parts)
        if len(self.parts) + len(new) > PARTS:
            # what was learnt last goes; a part of these texts that goes with it is learnt anew
            self.forget(min(KEPT, PARTS // 2))
            new = set().union(*plain.values()).difference(self.parts)
        self._learn_parts(list(new))
        get = self.parts.__getitem__
        return [b"".join(map(get, plain[i])) if i in plain else self._mixed(t) for i, t in enumerate(texts)]

    def _mixed(self, text: str) -> bytes:
        """A text that isn't all Latin, by chunks."""
        if _SEPARATORS.search(text):
            return self.direct(text)
        words = text.split()
        if len(words) > CHUNKS // 4:
            return b"".join(self._encode(words[at: at + CHUNKS // 4]) for at in range(0, len(words), CHUNKS // 4))
        return self._encode(words)

    def _encode(self, words: list[str]) -> bytes:
        new = set(words).difference(self.chunks)
        if new:
            if len(self.chunks) + len(new) > CHUNKS:
                new = set(words)  # all are learnt anew, as the cache starts over
            self._learn(new)
        return b"".join(map(self.chunks.__getitem__, words))
