"""Byte-level BPE ids of whole texts, fast: words are cut out by array operations, and each distinct word is encoded once.

The ids are those of the given tokenizer definition: words do not influence each other, and a distinct word is merged by
the definition's vocabulary once (its ids are merge ranks). Texts with characters outside the blocks whose classes are
certain (``SAFE``), and texts that hold a control string of the definition, go through the tokenizers library whole.
"""

from __future__ import annotations

import json
import sys
import types
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .kernels import BASE, chunks, mix, powers

#: Code points below this, and those of general punctuation, have classes that no Unicode version changes.
SAFE, PUNCTUATION = 0x0530, (0x2000, 0x2070)
#: Words that one worker remembers before it starts anew.
REMEMBER = 1 << 19
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
#: What may follow an apostrophe as a word of its own.
ONE, TWO = "stmd", ("re", "ve", "ll")


def _classes() -> np.ndarray:
    def of(c: int) -> int:
        ch = chr(c)
        kind = unicodedata.category(ch)[0]
        if ch.isspace() and not 0x1C <= c <= 0x1F:
            return SPACE
        return LETTER if kind == "L" else NUMBER if kind == "N" else OTHER

    return np.array([of(c) for c in range(PUNCTUATION[1])], np.uint8)


def word_starts(cp: np.ndarray, bounds: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where words start; ``bounds``: the code-point offsets of the texts."""
    n = len(cp)
    kind = classes[cp]
    text_start = np.zeros(n + 1, bool)
    text_start[bounds] = True
    edge = np.ones(n + 1, bool)
    edge[1:n] = (kind[1:] != kind[:-1]) | text_start[1:n]
    start = edge[:n].copy()
    space = kind == SPACE
    # The last white space before a word: a blank joins it, anything else stands alone.
    last = np.zeros(n, bool)
    last[: n - 1] = space[:-1] & ~space[1:] & ~text_start[1:n]
    start[last] = True
    joins = np.flatnonzero(last & (cp == 32))
    start[joins + 1] = False
    # An apostrophe that starts a word takes an ending with it.
    quote = np.flatnonzero((cp == 39) & start)
    if len(quote):
        padded = np.append(cp, [0, 0, 0])
        end = np.searchsorted(bounds, quote, "right")
        room = bounds[np.minimum(end, len(bounds) - 1)] - quote
        a, b = padded[quote + 1], padded[quote + 2]
        one = np.isin(a, [ord(c) for c in ONE]) & (room > 1)
        two = np.zeros(len(quote), bool)
        for x, y in TWO:
            two |= (a == ord(x)) & (b == ord(y)) & (room > 2)
        for hit, size in ((one, 2), (two & ~one, 3)):
            q = quote[hit]
            start[q + 1] = False
            if size == 3:
                start[q + 2] = False
            rest = q + size
            rest = rest[rest < n]
            start[rest] = True
            blank = rest[last[rest] & (cp[rest] == 32)]
            start[blank] = True
    return np.flatnonzero(start)


def _merger(definition: str):
    """A function from a word to its ids, from the vocabulary of a byte-level BPE definition."""
    import tiktoken

    own = json.loads(definition)
    special = {t["content"] for t in own["added_tokens"]}
    # Byte-level BPE writes bytes as characters: printable Latin-1 as itself, the others from code point 256 on.
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    ranks = {bytes(byte[c] for c in k): i for k, i in own["model"]["vocab"].items() if k not in special}
    return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Encoder:
    """Ids of runs of texts, with a memory of words: sorted hashes and places in one array of ids, some 40 bytes a word."""

    def __init__(self, definition: str) -> None:
        self.definition, self.tokenizer = definition, None
        #: Control strings of the definition, which have ids of their own wherever they stand in a text.
        self.control = [t["content"] for t in json.loads(definition)["added_tokens"] if t["content"]]
        self.words = _merger(definition)
        self.classes = _classes()
        self.forget()

    def forget(self) -> None:
        self.names, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.first, self.used, self.size = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64), 0, 0

    def learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        """``hashes``: sorted, none of them known."""
        for text in texts:
            ids = self.words(text)
            while self.used + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            if self.size + 2 > len(self.first):
                self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.ids[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
            self.size += 1
            self.first[self.size] = self.used
        at = np.searchsorted(self.names, hashes)
        self.places = np.insert(self.places, at, np.arange(self.size - len(texts), self.size))
        self.names = np.insert(self.names, at, hashes)

    def whole(self, text: str) -> np.ndarray:
        """Ids of one text by the tokenizers library, which is loaded when a text first needs it."""
        if self.tokenizer is None:
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(self.definition)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of each text's ids)."""
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        text = raw.tobytes().decode()
        cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        bounds = np.append(0, np.cumsum((raw & 0xC0) != 0x80, dtype=np.int32))[offsets]
        odd = np.flatnonzero((cp >= SAFE) & ((cp < PUNCTUATION[0]) | (cp >= PUNCTUATION[1])))
        if any(c in text for c in self.control):
            # Not one that reaches from one text into the next.
            at = [i for i in range(len(offsets) - 1) if any(c in text[bounds[i] : bounds[i + 1]] for c in self.control)]
            odd = np.append(odd, bounds[at].astype(np.int64)) if at else odd
        if len(odd):
            return self.mixed(raw, offsets, np.unique(np.searchsorted(bounds, odd, "right") - 1))
        starts = word_starts(cp, bounds, self.classes)
        lengths = np.diff(np.append(starts, len(cp)))
        local = np.arange(len(cp), dtype=np.int32) - np.repeat(starts.astype(np.int32), lengths)
        hashes = mix(np.add.reduceat((cp.astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[local], starts) ^ (lengths.astype(np.uint64) * BASE))
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        if self.size + len(distinct) > REMEMBER:
            self.forget()
        at_known = np.minimum(np.searchsorted(self.names, distinct), max(len(self.names) - 1, 0))
        new = np.flatnonzero(self.names[at_known] != distinct) if len(self.names) else np.arange(len(distinct))
        if len(new):
            self.learn(distinct[new], [text[s : s + k] for s, k in zip(starts[at[new]].tolist(), lengths[at[new]].tolist(), strict=True)])
        place = self.places[np.searchsorted(self.names, distinct)][which]
        count = self.first[place + 1] - self.first[place]
        total = np.append(0, count.cumsum())
        ids = self.ids[np.repeat(self.first[place] - total[:-1], count) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, bounds)]

    def mixed(self, raw: np.ndarray, offsets: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts, is_odd = [], np.zeros(len(offsets) - 1, bool)
        is_odd[odd] = True
        for i in range(len(offsets) - 1):
            own = raw[offsets[i] : offsets[i + 1]]
            if is_odd[i]:
                parts.append(self.whole(own.tobytes().decode()))
            else:
                parts.append(self.encode(own, np.array([0, len(own)]))[0])
        return np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))


def encoder(definition: str) -> Encoder:
    """One encoder a worker process, kept from task to task."""
    held = sys.modules.setdefault("_driftwell_encoders", types.ModuleType("_driftwell_encoders"))
    key = f"_{hash(definition)}"
    if not hasattr(held, key):
        setattr(held, key, Encoder(definition))
    return getattr(held, key)


def encode_column(column: pa.Array, definition: str) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids); nulls are empty."""
    own = encoder(definition)
    for row, raw, offsets in chunks(column):
        ids, bounds = own.encode(raw, offsets)
        for i in range(len(offsets) - 1):
            yield row + i, ids[bounds[i] : bounds[i + 1]]
