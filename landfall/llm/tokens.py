"""Token ids of whole texts by a public tokenizer file, inside Arrow tasks.

The two BPE files used here end a pre-token before white space and after a run of letters
and digits, so a text is cut there, and each distinct piece is encoded once by the
tokenizers library and remembered: words as they stand between blanks, and the pieces
of words. Where the file folds case and gives white space no ids, texts are lower-cased
and cut in front of commas and full stops first, so fewer distinct words are encoded.
Texts where a cut is not certain (white space or controls outside ASCII,
the dotted capital I) are encoded in one call; words with underscores or characters
that normalisation would join are not cut.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Callable
from functools import cache
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from landfall.llm.base import remember

#: Words and pieces a worker remembers, by dictionary and generation (two dictionaries of two generations,
#: some 150 bytes an entry), and the longest of them.
KEPT, LONGEST = 250_000, 64
#: ASCII marks that end a word and are one piece, however many follow each other.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~"
_FINE = re.compile(r"[\t-\r ]*[^\w\t-\r ]*\w+|[\t-\r ]*[^\w\t-\r ]+|[\t-\r ]+")
_COARSE = re.compile(r"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")
_ODD = re.compile("[\x00-\x08\x0e-\x1f\x7f-\xa0\xad\u0130\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]")
#: ASCII white space other than the blank.
_BREAKS = "\n\t\r\x0b\x0c"
#: A blank that isn't followed by a word: then the cut at blanks is not certain.
_DOUBLE = ("  ", " \n", " \t", " \r", " \x0b", " \x0c")
#: A comma or full stop behind a letter or digit, and one behind anything else but a blank: it may stand inside a run of marks.
_STOP = re.compile(r"(?<=[^\W_])[,.]")
_RUN = re.compile(r"[,.](?<=[\W_][,.])(?<! [,.])")


class _Uncertain(Exception):
    """A cut in this text is not certain."""


class _Words(dict):
    """Ids by word, with ``before`` in front of each; worked out when first met.

    What has not been met for long is forgotten a generation at a time.
    """

    def __init__(self, before: str, work_out: Callable[[str, str], bytes]) -> None:
        self.before, self.work_out, self.older = before, work_out, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.work_out(self.before, word)
        if len(word) <= LONGEST:
            if len(self) >= KEPT:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids

    def forget(self) -> None:
        self.older = {}
        self.clear()


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes as they are, the others from U+0100 up."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = (b for b in range(256) if b not in set(plain))
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder:
    """Ids of a text as little-endian unsigned integers of ``dtype``."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # in a text they are ordinary text
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.blank = self.letters[32]
        self.folds = self.whole("A") == self.whole("a")
        self.strips = self.whole(" a") == self.whole("a")
        self.by_model = all(self._by_model(b, w) == self.whole(b + w) for b in ("", " ") for w in ("Word", "éÀß", "ñandú", "日本"))
        self.words, self.heads = _Words(" ", self._work_out), _Words("", self._work_out)

    def _bytes(self, ids: list[int]) -> bytes:
        return array("H" if self.dtype.itemsize == 2 else "I", ids).tobytes()

    def whole(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _by_model(self, before: str, letters: str) -> bytes:
        """Ids of one pre-token of letters, straight from the library's BPE model."""
        if self.folds:
            letters = letters.lower()
        shown = letters if letters.isascii() else letters.encode().decode("latin-1").translate(self.letters)
        if before and not self.strips:
            shown = self.blank + shown
        return self._bytes([t.id for t in self.model.tokenize(shown)])

    def ids(self, text: str | None) -> bytes:
        """All ids of the text; null is the empty text."""
        if not text:
            return b""
        try:
            if self.strips:  # white space has no ids and any of it ends a pre-token
                return b"".join(map(self.words.__getitem__, self._spread(text).split(" ")))
            if text[-1] == " " or any(d in text for d in _DOUBLE):
                return b"".join(map(self.heads.__getitem__, _COARSE.findall(text)))
            head, *words = text.split(" ")
            return b"".join(map(self.heads.__getitem__, _COARSE.findall(head))) + b"".join(map(self.words.__getitem__, words))
        except _Uncertain:
            return self.whole(text)

    def many(self, texts: list[str | None]) -> list[bytes]:
        """ids() of each text; where white space has no ids, a word is looked up once for all of them."""
        if not self.strips:
            return [self.ids(t) for t in texts]
        lists = pc.split_pattern(pa.array([self._spread(t or "") for t in texts], pa.string()), " ")
        words = lists.flatten().dictionary_encode()
        found = self._look_up(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        ids = pa.ListArray.from_arrays(lists.offsets, pa.array(found, pa.binary()).take(words.indices))
        joined = pc.binary_join(ids, pa.scalar(b"", pa.binary())).to_pylist()  # null where a word is
        return [self.whole(t) if i is None else i for t, i in zip(texts, joined, strict=True)]

    def _look_up(self, words: list[str]) -> list[bytes | None]:
        """Ids of words; none where a cut is not certain."""
        found = list(map(self.words.get, words))
        for at in [i for i, ids in enumerate(found) if ids is None]:
            try:
                found[at] = self.words[words[at]]
            except _Uncertain:
                pass
        return found

    def _spread(self, text: str) -> str:
        """A text with the same ids where white space has none: in small letters, with blanks for line ends and in front of commas and full stops."""
        for c in _BREAKS:
            text = text.replace(c, " ")
        if not is_normalized("NFC", text):  # a letter may become one with a mark, which the stop behind it joins
            return text
        if self.folds and "Σ" not in text and "\u0130" not in text:
            low = text.lower()
            if is_normalized("NFC", low):  # else small letters and marks would be joined that the capitals were not
                text = low
        if _RUN.search(text):
            return _STOP.sub(r" \g<0>", text)
        return text.replace(",", " ,").replace(".", " .")

    def _work_out(self, before: str, word: str) -> bytes:
        if word.isalpha() and self.by_model and (word.isascii() or is_normalized("NFC", word) and "Σ" not in word and "\u0130" not in word):
            return self._by_model(before, word)
        bare = word.rstrip(_MARKS)
        if bare != word and bare.isalpha() and (word.isascii() or is_normalized("NFC", word)):
            return (self.words if before else self.heads)[bare] + self.heads[word[len(bare) :]]
        if _ODD.search(word):
            raise _Uncertain
        if "_" in word or not (word.isascii() or is_normalized("NFC", word)):
            return self.whole(before + word)
        pieces = _FINE.findall(before + word)
        if len(pieces) == 1:
            return self.whole(pieces[0])
        return b"".join([self.words[p[1:]] if p[0] == " " else self.heads[p] for p in pieces])


@cache
def encoder(path: str) -> Encoder:
    """One encoder a worker process and file."""
    return Encoder(path)


def forget(path: str) -> None:
    enc = encoder(path)
    enc.words.forget()
    enc.heads.forget()


def encoding(path: str) -> Encoder:
    """The encoder, for a task: words it meets are remembered until a task of another kind begins in the worker."""
    remember(f"tokens {path}", lambda: forget(path))
    return encoder(path)
