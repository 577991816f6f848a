"""Token ids of whole texts by the tokenizers library, every distinct piece of text encoded once.

Byte-pair encoding works inside pre-tokens, so a text can be cut at any place where a pre-token must begin, its pieces
encoded one by one and their ids joined. Pieces repeat a lot; a bounded cache keeps their ids. The cuts used here hold
for the two published pre-tokenizers this module knows:

* byte level: a space before anything that is not white space always begins a pre-token;
* words: white space is only a separator.

Texts of letters, digits and punctuation whose classes are beyond doubt are cut into pre-tokens at once; others go piece
by piece. Strings of added tokens are cut out of a text first and stand for their ids, as in the library.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

from tokenizers import Tokenizer

# Pieces and pre-tokens kept per generation; a worker holds at most two generations of each.
CACHED = 300_000
# Letters and punctuation whose Unicode class no version of the tables changes; no apostrophe, which may begin a
# contraction. The quantifiers are possessive, so a match takes linear time. Pieces made of these are cut into
# pre-tokens here, others are left to the library as they are.
_LETTER, _DIGIT, _MARK = "A-Za-zÀ-ÖØ-öø-ÿ", "0-9", r"!-&(-/:-@\[-`{-~"
_BYTE_PLAIN = re.compile(rf"(?: ?(?:[{_LETTER}]++|[{_DIGIT}]++|[{_MARK}]++)|\n(?=\S|\Z))++")
_BYTE_PARTS = re.compile(rf" ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[{_MARK}]+|\n")
_WORD_PLAIN = re.compile(rf"[{_LETTER}{_DIGIT}{_MARK} \t\n]++")
_WORD_PARTS = re.compile(rf"[{_LETTER}]+|[{_DIGIT}]|[{_MARK}]+")
# A space before white space or the end: such texts are cut by the slower pattern.
_BLANKS = re.compile(r" (?:\s|\Z)")
# Longer texts are encoded stretch by stretch, cut before a space that surely begins a pre-token.
STRETCH = 1 << 20
_SAFE_CUT = re.compile(r" (?=\S)")
_BYTE_CHUNKS = re.compile(r"(?s).[^ ]*(?: (?!\S)[^ ]*)*")


# Prepared for the usual lengths: building the format costs more than packing.
_PACKERS = [struct.Struct(f"<{n}I").pack for n in range(33)]


def _little_endian(ids: list[int]) -> bytes:
    return _PACKERS[len(ids)](*ids) if len(ids) < len(_PACKERS) else struct.pack(f"<{len(ids)}I", *ids)


class _Recent(dict):
    """Computed values in two generations: when the younger is full it becomes the elder, and the elder is forgotten."""

    def __init__(self, compute: Callable[[str], bytes]) -> None:
        super().__init__()
        self._compute, self._elder = compute, {}

    def __missing__(self, key: str) -> bytes:
        value = self._elder.get(key)
        if value is None:
            value = self._compute(key)
        self[key] = value
        return value

    def age(self) -> None:
        if len(self) > CACHED:
            self._elder = dict(self)
            self.clear()


class PieceEncoder:
    """Ids as the library gives them without adding special tokens."""

    def __init__(self, path: str) -> None:
        self._library = Tokenizer.from_file(path)
        described = json.loads(Path(path).read_text())
        kind, added = described["pre_tokenizer"], described["added_tokens"]
        if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added tokens of {path} match more than their own string")
        self._added = {t["content"]: _little_endian([t["id"]]) for t in added}
        # The longest of those that begin at the same place.
        longest_first = sorted(self._added, key=len, reverse=True)
        self._cut = re.compile(f"({'|'.join(map(re.escape, longest_first))})").split if added else None
        self._byte_level = kind["type"] == "ByteLevel" and kind["use_regex"] and not kind["add_prefix_space"]
        if not self._byte_level and kind["type"] != "Sequence":
            raise ValueError(f"no safe cuts are known for the pre-tokenizer of {path}")
        plain, parts = (_BYTE_PLAIN, _BYTE_PARTS) if self._byte_level else (_WORD_PLAIN, _WORD_PARTS)
        self._is_plain, self._parts_of = plain.fullmatch, parts.findall
        # The published byte-to-character table: printable bytes stand for themselves, others follow from 256 on.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in shown]
        self._characters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self._space, self._line = self._characters[32], self._characters[10]
        self._tokenize = self._library.model.tokenize
        self._pretokens = _Recent(self._model_ids)
        self._pieces = _Recent(self._piece_ids)
        # Keyed without the space they begin with, so that the parts of a split text are the keys.
        self._spaced = _Recent(lambda piece: self._piece_ids(" " + piece))

    def _model_ids(self, pretoken: str) -> bytes:
        if not pretoken.isascii():
            spelled = pretoken.encode().decode("latin-1").translate(self._characters)
        elif pretoken[0] == " ":
            # Of the ASCII characters in plain pre-tokens only a space in front and a line break alone are spelled otherwise.
            spelled = self._space + pretoken[1:]
        else:
            spelled = self._line if pretoken == "\n" else pretoken
        return _little_endian([t.id for t in self._tokenize(spelled)])

    def _piece_ids(self, piece: str) -> bytes:
        if not self._is_plain(piece):
            return _little_endian(self._library.encode(piece, add_special_tokens=False).ids)
        return self._plain_ids(piece)

    def _plain_ids(self, text: str) -> bytes:
        parts = self._parts_of(text if self._byte_level else text.lower())
        return b"".join(map(self._pretokens.__getitem__, parts))

    def _encode(self, text: str) -> bytes:
        if self._cut and any(map(text.__contains__, self._added)):
            return b"".join([self._added.get(part) or self._encode(part) for part in self._cut(text) if part])
        if len(text) > STRETCH and (cut := _SAFE_CUT.search(text, STRETCH)):
            return b"".join(map(self._encode, self._stretches(text, cut.start())))
        if self._is_plain(text):
            return self._plain_ids(text)
        if not self._byte_level:
            return b"".join(map(self._pieces.__getitem__, text.replace("\n", " ").split(" ")))
        if _BLANKS.search(text):
            return b"".join(map(self._pieces.__getitem__, _BYTE_CHUNKS.findall(text)))
        first, *rest = text.split(" ")
        return self._piece_ids(first) + b"".join(map(self._spaced.__getitem__, rest))

    @staticmethod
    def _stretches(text: str, end: int) -> Iterator[str]:
        start = 0
        while True:
            yield text[start:end]
            start = end
            cut = _SAFE_CUT.search(text, start + STRETCH)
            end = cut.start() if cut else len(text)
            if start == len(text):
                return

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        encoded = []
        for text in texts:
            encoded.append(self._encode(text))
            for recent in (self._pretokens, self._pieces, self._spaced):
                recent.age()
        return encoded


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """One encoder, and so one cache, per worker process and vocabulary."""
    return PieceEncoder(path)
