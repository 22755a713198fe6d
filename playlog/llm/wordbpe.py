"""A word vocabulary (tokenizers' JSON) applied word by word.

Vocabularies of this kind drop white space and never merge across it, so a text's ids
are those of its space-separated words one after the other.  Plain Latin text is cut into pieces
(letter runs, digits, marks) by the vocabulary's own pattern in one go; a piece is looked up
whatever stood beside it, so far fewer are new than words.  Other text goes word by word.
Bounded tables of pieces and words already seen save most of the work; they change speed only.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import struct
from unicodedata import category, is_normalized

import numpy as np

#: Words remembered by a worker, and the longest of them; beyond, words are worked out anew.
MEMORY = 300_000
LONGEST = 64
#: Characters of a text that are cut at a time, up to the next space.
PART = 1 << 18
#: Printable ASCII and Latin letters, but for the one whose lower case is two characters.
_PLAIN = re.compile("[\x21-\x7e\u00a1-\u00ac\u00ae-\u012f\u0131-\u024f]*")
_PLAIN_TEXT = re.compile("[\t\n\r\x20-\x7e\u00a1-\u00ac\u00ae-\u012f\u0131-\u024f]*")
#: FIXED VALUE: the usual pattern of pieces: contractions, letter runs, single digits, mark runs.
_USUAL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BLANKS = set("\t\n\r ")
_LETTERS = {c for c in map(chr, range(0x250)) if category(c)[0] == "L"}
_MARK = "(?:[^\\w\t\n\r ]|_)"
_MARKS = re.compile(f"{_MARK}{_MARK}")


def usual_pieces(text: str) -> list[str] | None:
    """The pieces of `_USUAL` in a plain text: what white space separates, once every digit
    and mark stands alone.  None where an apostrophe may begin a contraction or marks meet."""
    odd = set(text) - _LETTERS - _BLANKS
    if "'" in odd or any(category(c)[0] != "N" for c in odd) and _MARKS.search(text):
        return None
    for c in odd:
        text = text.replace(c, f" {c} ")
    return text.split()


def _as_characters() -> dict[int, int]:
    """Byte -> character: printable ones stand for themselves, the others follow 255."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}


_AS_CHARACTERS = _as_characters()
_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]


class Words(dict):
    """word -> value; at most `times` MEMORY words, the half looked up or made last and the half
    before."""

    def __init__(self, make, times: int = 1):
        super().__init__()
        self.make, self.before, self.times = make, {}, times

    def __missing__(self, word):
        value = self.before.get(word)
        if value is None:
            value = self.make(word)
        if len(word) <= LONGEST:
            if 2 * len(self) >= self.times * MEMORY:
                self.before = dict(self)
                self.clear()
            self[word] = value
        return value


def parts(text: str):
    """The text in parts of about PART characters, each but the first from a space on."""
    at = 0
    while at < len(text):
        end = text.find(" ", at + PART)
        end = len(text) if end < 0 else end
        yield text[at:end]
        at = end


def split(text: str) -> list[str]:
    """Space and line feed separate words; other white space stays inside, where the
    library's own normaliser drops it."""
    return text.replace("\n", " ").split(" ")


def merge_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Tokens left after byte-pair merging.

    The symbols form a linked list, adjacent pairs with a rank lie in a heap.  The pair of
    the lowest rank (leftmost first) is popped and merged until none is left; an entry
    whose symbols have been merged meanwhile is stale and skipped.  The count is the
    initial number of symbols minus the merges, no identifiers are made.
    """
    n = len(symbols)
    if n < 2:
        return n
    after = list(range(1, n)) + [-1]
    before = list(range(-1, n - 1))
    rank = ranks.get
    heap = []
    for i in range(n - 1):
        r = rank((symbols[i], symbols[i + 1]))
        if r is not None:
            heap.append((r, i, symbols[i], symbols[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != left or j < 0 or symbols[j] != right:
            continue
        joined = symbols[i] = left + right
        symbols[j] = None
        merges += 1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            r = rank((joined, symbols[k]))
            if r is not None:
                heapq.heappush(heap, (r, i, joined, symbols[k]))
        h = before[i]
        if h >= 0:
            r = rank((symbols[h], joined))
            if r is not None:
                heapq.heappush(heap, (r, h, symbols[h], joined))
    return n - merges


class WordBpe:
    """Encoder and counter for one vocabulary file."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix"):
            raise ValueError(f"{path} is no vocabulary of words with an end mark")
        self.suffix = model["end_of_word_suffix"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        added = [t["content"] for t in spec["added_tokens"]]
        self.added = set(added)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.pattern = self._pattern(spec)
        self.ids = Words(self._ids)
        self.counts = Words(self._count)
        #: plain text is most of a corpus, and its pieces are short
        self.piece_ids = Words(lambda p: self._packed(self._as_characters(p)), times=2)
        self.piece_counts = Words(lambda p: self._merged(self._as_characters(p)), times=2)

    @staticmethod
    def _pattern(spec: dict):
        """The pattern of the pieces, if the file asks for the usual steps: composed
        characters, lower case, pieces by a pattern, bytes as characters."""
        import regex

        steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        if steps == ["NFC", "Replace", "Lowercase"] and len(cuts) == 2 and (
                cuts[0].get("type"), cuts[0].get("behavior"), cuts[0].get("invert"),
                cuts[1].get("type"), cuts[1].get("add_prefix_space"), cuts[1].get("use_regex"),
        ) == ("Split", "Removed", True, "ByteLevel", False, False):
            return regex.compile(cuts[0]["pattern"]["Regex"])
        return None

    def _pieces(self, word: str) -> list[str]:
        """A word's pieces, their bytes as characters.  Plain Latin words are cut here, which
        the library's steps would do no differently; all others by the library."""
        if self.pattern is not None and word.isprintable() and (
                word.isascii() or (_PLAIN.fullmatch(word) and is_normalized("NFC", word))):
            lower = word.lower()
            if lower.isalpha():
                found = [lower]
            elif lower[-1:] in ".,!" and lower[:-1].isalpha():
                found = [lower[:-1], lower[-1]]
            else:
                found = self.pattern.findall(lower)
            return found if word.isascii() else list(map(self._as_characters, found))
        t = self.tokenizer
        return [p for p, _ in t.pre_tokenizer.pre_tokenize_str(t.normalizer.normalize_str(word))]

    @staticmethod
    def _as_characters(piece: str) -> str:
        return piece if piece.isascii() else piece.encode().decode("latin-1").translate(_AS_CHARACTERS)

    def _found(self, text: str) -> list[str] | None:
        """The pieces of a plain Latin text in lower case, None for any other text."""
        if (self.pattern is None or not _PLAIN_TEXT.fullmatch(text) or not is_normalized("NFC", text)
                or ("<" in text and any(a in text for a in self.added))):
            return None
        text = text.lower()
        found = usual_pieces(text) if self.pattern.pattern == _USUAL else None
        return self.pattern.findall(text) if found is None else found

    def _packed(self, *pieces: str) -> bytes:
        tokenize = self.tokenizer.model.tokenize
        ids = [t.id for p in pieces for t in tokenize(p)]
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else np.array(ids, "<u4").tobytes()

    def _merged(self, piece: str) -> int:
        return merge_count([*piece[:-1], piece[-1] + self.suffix], self.ranks)

    def _ids(self, word: str) -> bytes:
        if self.cut and "<" in word:
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        return self._packed(*self._pieces(word))

    def _count(self, word: str) -> int:
        if not word:
            return 0
        if self.cut and "<" in word and (parts := self.cut.split(word))[1:]:
            return sum(1 if p in self.added else self._count(p) for p in parts)
        return sum(map(self._merged, self._pieces(word)))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        out = []
        for part in parts(text):
            found = self._found(part)
            out += (map(self.ids.__getitem__, split(part)) if found is None else
                    map(self.piece_ids.__getitem__, found))
        return b"".join(out)

    def forget(self) -> None:
        """Drop the words and pieces remembered: a worker that waits should hold little."""
        for memory in (self.ids, self.counts, self.piece_ids, self.piece_counts):
            memory.clear()
            memory.before = {}

    def count(self, text: str) -> int:
        total = 0
        for part in parts(text):
            found = self._found(part)
            total += sum(map(self.counts.__getitem__, split(part)) if found is None else
                         map(self.piece_counts.__getitem__, found))
        return total


@functools.lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    """One per worker process and file."""
    return WordBpe(path)
