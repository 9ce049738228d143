"""Token ids of whole texts, from a given public tokenizer.

Texts are cut at ASCII white space and each different word is encoded once per Python
worker, by the tokenizers library.  That gives the ids of the whole text because this kind
of vocabulary (byte pairs with word ends, lower case) drops white space and never joins
characters across it.  A word of Latin letters is given to the vocabulary's model directly.
"""

from __future__ import annotations

import re
from array import array

# Words a worker remembers (about 150 MB); beyond it the memory starts anew.
WORD_MEMORY = 700_000
_PUNCTUATION = b".,;:!?|%$#*&-)("
# Letters that have one form and no context: what the tokenizer's normalizer does to them is lower case alone.
_LATIN_WORD = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+").fullmatch

_encoders: dict[str, "WordEncoder"] = {}


class _Alphabet(dict):
    """What a character is in the vocabulary's own alphabet of printable bytes."""

    def __init__(self):
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self._bytes = ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, code: int) -> str:
        self[code] = self._bytes.pre_tokenize_str(chr(code))[0][0]
        return self[code]


class _Known(dict):
    """Ids by word; a new word is encoded when it is first asked for."""

    def __init__(self, tokenizer):
        super().__init__()
        self._tokenizer, self._model = tokenizer, tokenizer.model
        self._alphabet = _Alphabet()

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(_PUNCTUATION)
        text = core.decode()
        if not _LATIN_WORD(text):
            ids = array("I", self._tokenizer.encode(word.decode(), add_special_tokens=False).ids).tobytes()
        elif core is not word:
            # Letters and a tail of ASCII punctuation are two pieces.
            ids = self[core] + self[word[len(core) :]]
        else:
            lower = text.lower()
            if not text.isascii():
                ids = self._piece(lower.translate(self._alphabet))
            else:
                ids = self._piece(lower) if lower == text else self[word.lower()]
        self[word] = ids
        return ids

    def _piece(self, text: str) -> bytes:
        """Ids of one pre-token, given in the vocabulary's own alphabet of printable bytes."""
        return array("I", [t.id for t in self._model.tokenize(text)]).tobytes()


class WordEncoder:
    """Ids as little-endian unsigned 32-bit bytes, those of a plain call without added special tokens.

    Strings of special tokens inside a text become those tokens, as they do in such a call.
    """

    def __init__(self, path: str, memory: int = WORD_MEMORY):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._memory = memory
        self._known = _Known(self._tokenizer)

    @classmethod
    def of(cls, path: str) -> "WordEncoder":
        """The encoder of this process for that file."""
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def encode(self, text: str | None) -> bytes:
        """The ids of a text; NULL is an empty text."""
        if len(self._known) > self._memory:
            self._known = _Known(self._tokenizer)
        return b"".join(map(self._known.__getitem__, (text or "").encode("utf-8", "replace").split()))
