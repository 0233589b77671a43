"""Token ids by a public tokenizer, word by word.

The tokenizer (BPE inside words; white space separates words and is
dropped) gives a text the concatenation of the ids of its words.  Words are
cut at ASCII white space only, which every rule of the tokenizer treats as a
border, so this holds for any text; other kinds of white space stay inside
a "word" and are left to the tokenizer.  A worker keeps the ids of words it
has met, up to ``MAX_WORDS``; the cache only saves time.  New words are
encoded many in one call, which costs about as much as several words do.

Cases: a null text counts as empty (no ids but the closing one); a text of
any length is encoded whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ledgerline.llm.util import worker_cache

TOKENIZER = "word_bpe_49k.json"
MAX_WORDS = 200_000
MAX_WORD_BYTES = 48
WORDS_AT_ONCE = 256
TEXT_BYTES_AT_ONCE = 1 << 20
#: ASCII punctuation that the tokenizer splits off after a letter, and that is in no special token.
TRAILING = b".,;:!?*%$#&()\"'"


class WordIds(dict):
    """Word (bytes) -> its ids as little-endian uint32 bytes.

    A word that is not known is looked up without what does not change its
    ids -- ASCII capitals of an ASCII word, punctuation after a last letter
    -- before it is encoded.  When ``MAX_WORDS`` words are known, those not
    used since the last time are forgotten.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.older: dict[bytes, bytes] = {}

    def __missing__(self, word: bytes) -> bytes:
        packed = self.older.get(word)
        if packed is None:
            packed = self._parts(word)
        if len(word) <= MAX_WORD_BYTES:
            self._forget_if_full()
            self[word] = packed
        return packed

    def _parts(self, word: bytes) -> bytes:
        if smaller := _smaller(word):
            return b"".join([self[x] for x in smaller])
        ids = self.tokenizer.encode(word.decode("utf-8"), add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def learn(self, words: set[bytes]) -> None:
        """Encode those of the words that are not known yet, ``WORDS_AT_ONCE`` in one call."""
        new, made, todo = {}, [], list(words)
        for word in todo:  # grows
            if word in self or word in new or len(word) > MAX_WORD_BYTES:
                continue
            if (packed := self.older.get(word)) is not None:
                self._forget_if_full()
                self[word] = packed
            elif smaller := _smaller(word):
                todo += smaller
                made.append((word, smaller))
            elif b"<|" not in word:  # a special token may go on beyond the word
                new[word] = None
        new = list(new)
        for at in range(0, len(new), WORDS_AT_ONCE):
            self._learn(new[at:at + WORDS_AT_ONCE])
        for word, smaller in reversed(made):
            packed = b"".join([self[x] for x in smaller])
            self._forget_if_full()
            self[word] = packed

    def _forget_if_full(self) -> None:
        if len(self) >= MAX_WORDS:
            self.older = dict(self)
            self.clear()

    def _learn(self, words: list[bytes]) -> None:
        texts = [word.decode("utf-8") for word in words]
        found = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        packed = np.array(found.ids, dtype="<u4").tobytes()
        begins = np.cumsum([0, *[len(text) + 1 for text in texts]])
        ends = (4 * np.searchsorted(np.array([x for x, _ in found.offsets], np.int64), begins)).tolist()
        for word, begin, end in zip(words, ends, ends[1:], strict=False):
            self._forget_if_full()
            self[word] = packed[begin:end]


def _smaller(word: bytes) -> tuple[bytes, ...]:
    """Words whose ids, one after the other, are those of ``word``; none if it is to be encoded itself."""
    if b"<|" not in word:  # else it may hold a special token
        if word.isascii() and not word.islower() and (lower := word.lower()) != word:
            return (lower,)
        core = word.rstrip(TRAILING)
        if core and core != word and core.decode("utf-8")[-1].lower()[-1].isalpha():
            return core, word[len(core):]
    return ()


def word_ids(path: str) -> WordIds:
    return worker_cache(("word ids", path), lambda: WordIds(path))


def _kinds() -> bytes:
    """Per byte: p for ASCII punctuation, x for what starts a character beyond U+00FF (or U+0080 to U+00BF)."""
    kinds = bytearray(b"." * 256)
    for byte in range(33, 127):
        if not chr(byte).isalnum():
            kinds[byte] = ord("p")
    kinds[0xC2], kinds[0xC4:] = ord("x"), b"x" * (256 - 0xC4)
    return bytes(kinds)


KINDS = _kinds()


def plain(text: bytes) -> bytes:
    """A text with the same ids that has fewer different words, if that is cheap to tell; else the text itself.

    With ASCII and the letters U+00C0 to U+00FF only there are no combining
    marks, so ASCII capitals can be lowered; with no two punctuation marks
    side by side there are no runs of them and no special tokens, so a mark
    that ends a word can stand alone.
    """
    kinds = text.translate(KINDS)
    if b"x" in kinds or b"pp" in kinds or b"\xc3\x97" in text or b"\xc3\xb7" in text:
        return text
    text = text.lower()
    for mark in (b".", b",", b"?", b"!", b";", b":"):
        if mark in text:
            alone = b" " + mark
            text = text.replace(mark + b" ", alone + b" ").replace(mark + b"\n", alone + b"\n")
    return text


def encode(cache: WordIds, text: bytes | None, closing_id: int) -> bytes:
    """The ids of ``text`` and the closing id, as little-endian uint32 bytes."""
    body = b"".join(map(cache.__getitem__, plain(text).split())) if text else b""
    return body + closing_id.to_bytes(4, "little")


def encode_all(cache: WordIds, texts: list[bytes | None], closing_id: int) -> Iterator[bytes]:
    """``encode`` of each text; the new words of some ``TEXT_BYTES_AT_ONCE`` of texts are learned together."""
    closing, some, size = closing_id.to_bytes(4, "little"), [], 0
    for k, text in enumerate(texts, 1):
        some.append(plain(text).split() if text else [])
        size += len(text or b"")
        if size >= TEXT_BYTES_AT_ONCE or k == len(texts):
            cache.learn(set().union(*some))
            for words in some:
                yield b"".join(map(cache.__getitem__, words)) + closing
            some, size = [], 0


def pieces(ids: bytes, limit: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of each run of at most ``limit`` ids."""
    width = 4 * limit
    for k, at in enumerate(range(0, len(ids), width)):
        part = ids[at:at + width]
        yield k, at // 4, len(part) // 4, zlib.crc32(part)


def tokenizer_path(name: str = TOKENIZER) -> str:
    return public_tokenizers.path(name)
