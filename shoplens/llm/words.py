"""Whole texts to token ids, with a memory of the words already encoded."""

import re

import numpy as np
from tokenizers import Tokenizer

# The vocabularies' own splitting patterns, spelt out for the characters of Latin-1
LETTERS, NUMBERS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", "\\t-\\r \\x85\\xa0"
KEEPS_SPACES = re.compile(f" ?[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
                          f"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
DROPS_SPACES = re.compile(f"[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")


class _Unsure(Exception):
    """A space next to other white space is no sure boundary."""


class _Memory(dict):
    """Ids of what stands between two spaces, as little-endian 32-bit integers; worked out when first asked for."""

    def __init__(self, encoder):
        super().__init__()
        self.encoder = encoder

    def __missing__(self, stretch):
        value = self.encoder.stretch(stretch)
        self[stretch] = value
        return value


class WordEncoder:
    """Gives the ids that the tokenizer gives for the whole text.

    The vocabulary's added tokens (its special strings) are looked for first, as they stand; what lies between them is
    encoded by itself, as the tokenizer does.
    Both kinds of public vocabulary cut a text into words before they merge inside words, and a single space
    between two other characters is always such a cut. So a text is cut at spaces, and what stands between them
    is cut further by the vocabulary's own pattern (where it has characters of Latin-1 only). Words are encoded
    once and looked up from then on; the memory is emptied when it is full, which changes no result.
    `keeps_spaces` for byte-level vocabularies (a space belongs to the word after it); otherwise the vocabulary
    drops white space and case.
    """

    def __init__(self, path, keeps_spaces, memory=800_000):
        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that are not matched as they stand")
        self.added = {t.content: np.array([i], "<u4").tobytes() for i, t in added.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.tokenizer.encode_special_tokens = True
        self.keeps_spaces, self.memory = keeps_spaces, memory
        self.known, self.words = _Memory(self), {}
        self.cut = (KEEPS_SPACES if keeps_spaces else DROPS_SPACES).findall

    def _word(self, word):
        found = self.words.get(word)
        if found is None:
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            found = self.words[word] = np.array(ids, dtype="<u4").tobytes()
        return found

    def _pieces(self, text):
        """Ids of a whole text or of a part between sure boundaries."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self._word, self.cut(text if self.keeps_spaces else text.lower())))

    def stretch(self, text):
        if not self.keeps_spaces:
            return self._pieces(text)
        if not text or text[0].isspace() or text[-1].isspace():
            raise _Unsure
        return self._pieces(" " + text)

    def ids(self, text):
        """The ids of a text as a little-endian 32-bit array."""
        parts = self.special.split(text) if any(s in text for s in self.added) else [text]
        raw = [self.added[part] if at % 2 else self._plain(part) for at, part in enumerate(parts)]
        return np.frombuffer(b"".join(raw), "<u4")

    def _plain(self, text):
        """The ids of a text without added tokens, as bytes."""
        if not text:
            return b""
        if len(self.known) + len(self.words) > self.memory:
            self.known.clear()  # put together again from words
            if len(self.words) > 0.7 * self.memory:
                self.words.clear()
        first, *rest = text.split(" ")
        try:
            if self.keeps_spaces and (not first or first[-1].isspace()):
                raise _Unsure
            return self._pieces(first) + b"".join(map(self.known.__getitem__, rest))
        except _Unsure:
            return self._pieces(text)

    def each(self, column):
        """The ids of every text of an Arrow column in turn."""
        return (self.ids(text.as_py()) for text in column)


_MADE = {}  # one encoder for each vocabulary in a Python worker, kept from task to task


def encoder_factory(path, keeps_spaces):
    def get():
        if path not in _MADE:
            _MADE[path] = WordEncoder(path, keeps_spaces)
        return _MADE[path]
    return get
