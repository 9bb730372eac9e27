"""Pre-tokens as the tokenizer libraries see them.

The libraries split text by a pattern over Unicode classes.  Python's engines
know other Unicode versions, so the classes are asked of the library itself,
once on the driver, and written out as ranges; the workers then run the same
pattern in ``re``.
"""

from __future__ import annotations

import functools
import re

#: The pattern's contractions, and what makes a class.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
CLASSES = {"L": r"\p{L}", "N": r"\p{N}", "S": r"\s"}


@functools.lru_cache(maxsize=1)
def class_ranges() -> dict[str, str]:
    """Body of a ``re`` character set for each class, from the library."""
    from tokenizers import Regex, pre_tokenizers

    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    out = {}
    for name, pattern in CLASSES.items():
        split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        points = sorted(ord(c) for piece, _ in split.pre_tokenize_str(every) for c in piece)
        ranges, start = [], points[0]
        for here, after in zip(points, [*points[1:], None]):
            if after != here + 1:
                ranges.append(f"\\U{start:08x}-\\U{here:08x}")
                start = after
        out[name] = "".join(ranges)
    return out


#: The classes below U+0100, where all Unicode versions agree.
LATIN = {"L": "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff",
         "N": "0-9\xb2\xb3\xb9\xbc-\xbe", "S": "\t-\r \x85\xa0"}


def _byte_level(c: dict[str, str]) -> str:
    return "|".join([*CONTRACTIONS, f" ?[{c['L']}]+", f" ?[{c['N']}]+",
                     f" ?[^{c['S']}{c['L']}{c['N']}]+", f"[{c['S']}]+(?![^{c['S']}])", f"[{c['S']}]+"])


@functools.lru_cache(maxsize=4)
def _compiled(pattern: str) -> re.Pattern:
    return re.compile(pattern)


class ByteLevel:
    """The split of the byte-level vocabularies (``public_tokenizers.PATTERN``).

    Built on the driver, used in the workers.  Texts below U+0100 take a pattern
    with small sets, which ``re`` runs three times as fast; the result is the same.
    """

    def __init__(self):
        self.latin, self.full = _byte_level(LATIN), _byte_level(class_ranges())

    def pattern(self, text: str) -> re.Pattern:
        return _compiled(self.latin if is_latin(text) else self.full)

    def split(self, text: str) -> list[str]:
        return self.pattern(text).findall(text)


def is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Cache(dict):
    """Results by piece, found by ``make`` on a miss; emptied but for what was
    planted when it holds ``limit`` more, so a worker's memory stays bounded."""

    def __init__(self, make, limit: int = 200_000, longest: int = 64):
        super().__init__()
        self.make, self.limit, self.longest, self.seed = make, limit, longest, {}

    def plant(self, seed: dict) -> None:
        if not self.seed:
            self.seed = seed
            self.update(seed)

    def __missing__(self, piece):
        value = self.make(piece)
        if len(piece) <= self.longest:
            if len(self) >= self.limit + len(self.seed):
                self.clear()
                self.update(self.seed)
            self[piece] = value
        return value


class RecurringCache(Cache):
    """A cache that starts afresh when full, but looks at what it held before
    first: pieces that recur stay, the others go.  It holds up to two ``limit``."""

    def __init__(self, make, limit: int, longest: int = 64):
        super().__init__(make, limit, longest)
        self.before: dict = {}

    def __missing__(self, piece):
        value = self.before.get(piece)
        if value is None:
            value = self.make(piece)
        if len(piece) <= self.longest:
            if len(self) >= self.limit:
                self.before = dict(self)
                self.clear()
            self[piece] = value
        return value


#: The letters that byte-level vocabularies write for the 256 bytes.
def byte_letters() -> dict[int, str]:
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + k) for k, b in enumerate(hidden)}}


def spelled(piece: str, letters: dict[int, str]) -> str:
    return piece.encode().decode("latin-1").translate(letters)
