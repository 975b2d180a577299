"""Token ids of whole texts with a memory of words that are encoded on their own.

Both pre-token patterns in use start a new match at a blank or line feed that stands between two
non-blanks, so the ids of the words, one after the other, are the ids of the text. Words repeat; the
ids of each are kept as little-endian 32-bit integers, and a text costs one dictionary look-up a word.
A text with any other white space, control or unprintable character is encoded whole.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable, Sequence

from .common import worker_state

#: Words kept by one worker; beyond that it starts anew (some 200 bytes each).
MEMO = 900_000
#: Words of more characters are encoded but not kept.
LONG = 64
def packed(ids: Sequence[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def cut(text: str) -> list[str] | None:
    """Words; those after a line feed, and the first, begin with one. None: the text can't be cut so."""
    if not text or not text.replace("\n", "").isprintable():
        return None
    spaced = text.replace("\n", " \n")
    if spaced[0] == " " or spaced[-1] in " \n" or "  " in spaced or "\n " in spaced:  # white space that isn't one between two words
        return None
    parts = spaced.split(" ")
    parts[0] = "\n" + parts[0]
    return parts


class WordEncoder:
    """``encode_words`` gives the packed ids of words as ``cut`` makes them, without a leading line
    feed's own; ``encode_text`` those of a whole text; ``line_feed`` those of a line feed."""

    def __init__(
        self,
        encode_words: Callable[[list[str]], list[bytes]],
        encode_text: Callable[[str], bytes],
        line_feed: bytes,
        fold: bool = False,
    ):
        self.encode_words, self.encode_text, self.line_feed, self.fold = encode_words, encode_text, line_feed, fold
        self.memo: dict[str, bytes] = {}

    def learn(self, new: list[str]) -> None:
        for word, ids in zip(new, self.encode_words(new)):
            self.memo[word] = self.line_feed + ids if word[0] == "\n" else ids

    def __call__(self, texts: list[str]) -> list[bytes]:
        memo, skip = self.memo, len(self.line_feed)
        if len(memo) > MEMO:
            memo.clear()
        if self.fold:  # A-Z only, which the tokenizer folds too
            texts = [t.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass") for t in texts]
        cuts = [cut(t) for t in texts]
        out, missing = [], []
        for i, (text, parts) in enumerate(zip(texts, cuts)):
            if parts is None:
                out.append(self.encode_text(text) if text else b"")
                continue
            try:
                out.append(b"".join(map(memo.__getitem__, parts))[skip:])
            except KeyError:
                missing.append(i)
                out.append(b"")
        new = list({w for i in missing for w in cuts[i] if w not in memo})
        self.learn(new)
        for i in missing:
            out[i] = b"".join(map(memo.__getitem__, cuts[i]))[skip:]
        for word in new:
            if len(word) > LONG:
                del memo[word]
        return out


def spoken(word: str) -> str:
    """The characters that a word of ``cut`` stands for, without a leading line feed."""
    return word[1:] if word[0] == "\n" else " " + word


#: Letters below this are one pre-token, have no other form, and are mapped byte by byte; marks after them are another one.
LATIN_END = "\u0250"
LATIN_WORD = re.compile(r"\n?([^\W\d_]+)([!-&(-/:-@\[-`{-~]*)").fullmatch
PROBES = ("a", "word", "wörd", "é", "abcd" * 20, "word,", "é$$$", "a.b", "x-", "end.)\"")


def byte_letters() -> dict[int, str]:
    """The character that byte-level pre-tokenizers put in a byte's place: printable Latin-1 ones stand for themselves,
    the others for those from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


def tokenizer_encoder(path: str) -> WordEncoder:
    """Encoder for a tokenizer file, without special tokens; their strings are ordinary text. One per worker.

    New words of Latin letters, with or without marks at their end, go straight to the merges, as the letters are one pre-token
    and the marks another, where probes show that to hold of the file; all others go through the whole tokenizer, many in a call.
    """
    return worker_state(("tokenizer", path), lambda: _tokenizer_encoder(path))


def _tokenizer_encoder(path: str) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    merge, letters = tokenizer.model.tokenize, byte_letters()

    def ids_of(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def merged(word: str) -> list[int]:
        """Ids of a pre-token, with the blank before it if it has one."""
        return [t.id for t in merge(word.encode().decode("latin-1").translate(letters))]

    (line_feed,) = ids_of(["\n"])
    # A tokenizer that drops white space has the same ids with and without a blank.
    blank = "" if ids_of([" a"]) == ids_of(["a"]) else " "
    folds = "Lowercase" in (tokenizer.normalizer.__getstate__().decode() if tokenizer.normalizer else "")
    marks: dict[str, bytes] = {"": b""}

    def latin(word: str) -> bytes | None:
        """Packed ids of letters and marks; None where the word is anything else."""
        found = LATIN_WORD(word)
        if not found:
            return None
        bare, tail = found.groups()
        if not bare.isalpha() or max(bare) >= LATIN_END or folds and bare != bare.lower():
            return None
        if tail not in marks:
            marks[tail] = packed(merged(tail))
        return packed(merged(bare if word[0] == "\n" else blank + bare)) + marks[tail]

    # Each probe where a blank precedes it, and at the start of a line.
    direct = all(latin(lead + p) in (None, packed(ids)) for p in PROBES for lead in ("", "\n") for ids in ids_of([("" if lead else " ") + p]))

    def encode_words(words: list[str]) -> list[bytes]:
        out = [latin(w) if direct else None for w in words]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, ids_of([spoken(words[i]) for i in rest])):
            out[i] = packed(ids)
        return out

    return WordEncoder(encode_words, lambda t: packed(ids_of([t])[0]), packed(line_feed), folds)
