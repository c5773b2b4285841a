"""A public tokenizer inside a task, with the words that a task has met encoded once.

Both tokenizer files split a text by a pattern before they merge bytes, and no branch of either pattern runs from a
character that is not white space into white space.  A place with such a character before it and ASCII white space
behind it is therefore a stable boundary: what stands before it never changes the tokens behind it, nor the other way
round.  Special strings hold no white space, and neither normal form composes across a space.  A text is the
concatenation of the units between stable boundaries, so its tokens are the concatenation of theirs.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

# Characters that one pattern engine or another may take as white space, beside the ASCII ones.  A text that holds any
# is encoded whole: no boundary in it is relied on.
UNSURE_RANGES = ((0x00, 0x00), (0x1C, 0x1F), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x180E, 0x180E),
                 (0x2000, 0x200F), (0x2028, 0x202F), (0x205F, 0x2064), (0x3000, 0x3000), (0xFEFF, 0xFEFF))
UNSURE = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in UNSURE_RANGES) + "]")
# White space and what follows up to the next white space; a comma or full stop behind a letter is a unit of its own, as
# neither pattern runs from a letter into one.
LETTER = f"A-Za-z{chr(0xC0)}-{chr(0xD6)}{chr(0xD8)}-{chr(0xF6)}{chr(0xF8)}-{chr(0x24F)}"
UNIT = re.compile(rf"[ \t-\r]*(?:[{LETTER}]+(?=[,.])|[^ \t-\r]+)|[ \t-\r]+")
BLACK_UNIT = re.compile(rf"[{LETTER}]+(?=[,.])|[^ \t-\r]+")  # without the white space, where that has no tokens
KEPT_WORDS = 500_000  # a task's memory of words; it starts anew beyond that


@lru_cache(maxsize=4)
def tokenizer(name: str):
    """The tokenizer of one of the public files."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


class Words:
    """Encodes texts unit by unit.  Values are the units' ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, name: str):
        self.tokenizer = tokenizer(name)
        self.known: dict[str, bytes] = {}
        self.counts: dict[str, int] = {}
        spaces = self.tokenizer.encode(" \n\t ", add_special_tokens=False).ids
        self.counted = BLACK_UNIT if not spaces else UNIT

    def encode_whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if UNSURE.search(text):
            return self.encode_whole(text)
        units = UNIT.findall(text)
        known = self.known
        new = list(set(units).difference(known))
        if new:
            if len(known) + len(new) > KEPT_WORDS:
                known.clear()
                new = list(set(units))
            for i in range(0, len(new), 4096):
                part = new[i:i + 4096]
                for unit, code in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                    known[unit] = np.array(code.ids, dtype="<u4").tobytes()
        return b"".join(map(known.__getitem__, units))


    def count(self, text: str) -> int:
        """The number of tokens."""
        if UNSURE.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        units, counts = self.counted.findall(text), self.counts
        new = list(set(units).difference(counts))
        if new:
            if len(counts) + len(new) > KEPT_WORDS:
                counts.clear()
                new = list(set(units))
            for i in range(0, len(new), 4096):
                part = new[i:i + 4096]
                codes = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
                counts.update(zip(part, map(len, codes)))
        return sum(map(counts.__getitem__, units))


# Characters of which every Unicode version and pattern engine agrees what is a letter, a digit or white space.
ODD = re.compile("[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in ((0x01, 0x1B), (0x20, 0x7E), (0xA1, 0x4FF))) + "]")
LONG_WORD = re.compile(r"(?<!\S)\S{1000}")


class Ranks:
    """Encodes whole texts with a byte-level BPE file, with the same ids as ``Words`` over the same vocabulary.

    The vocabulary also comes as ranks, which merge several times faster than the tokenizer file does.  Both split a
    text by one pattern and merge by one order; texts with characters on which pattern engines may differ, or with
    very long words, go through the tokenizer file itself.
    """

    def __init__(self, name: str):
        import base64

        import public_tokenizers
        import tiktoken

        self.exact = Words(f"{name}.json")
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        special = {str(t.content): i for i, t in self.exact.tokenizer.get_added_tokens_decoder().items()}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens=special)

    def sure(self, text: str) -> bool:
        """Whether the ranks surely give the tokenizer file's ids (special strings apart)."""
        return not (ODD.search(text) or LONG_WORD.search(text))

    def encode(self, text: str) -> bytes:
        if not self.sure(text):
            return self.exact.encode_whole(text)
        return self.fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


@lru_cache(maxsize=4)
def ranks(name: str) -> Ranks:
    """One encoder for a Python worker."""
    return Ranks(name)


@lru_cache(maxsize=4)
def words(name: str) -> Words:
    """One memory of words for a Python worker."""
    return Words(name)
