"""Token ids of whole texts, by the tokenizers library with remembered pieces.

White space always separates pre-tokens of both vocabularies used here, so a text is
cut at spaces, and only pieces not seen before by this worker reach the library. A text
that holds an added token such as <|endoftext|> goes to the library whole. The result
equals encoding the text as a whole at the library's defaults, without special tokens at
its ends; tests/llm compare both.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np

REMEMBERED = 600_000

_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(f"[\x00-\x1b!-&(-\x7f{_LATIN}]*").fullmatch
# White space as Unicode has it; Python's own set is larger.
_WS = "\t-\r \x85\xa0  -     　"
_RUNS = re.compile(f" ?[^{_WS}]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+").findall
_KEPT = re.compile(f" ?[{_LATIN}]+| ?[0-9]+| ?[^{_WS}{_LATIN}0-9]+|[{_WS}]+(?![^{_WS}])|[{_WS}]+").findall
_DROPPED = re.compile(f"[{_LATIN}]+|[0-9]|[^{_WS}{_LATIN}0-9]+").findall


def _byte_letters() -> list[str]:
    """The printable stand-ins of bytes in byte-level vocabularies: themselves, or 256 and up in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class _Hazard(Exception):
    """A piece with white space at its edge: cutting at this space may change the tokens."""


class _Pieces(dict):
    def __init__(self, make):
        self.make = make

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[piece] = self.make(piece)
        return ids


class Encoder:
    """Encodes texts to ids as little-endian bytes, 2 bytes an id where the vocabulary allows.

    drops_space: the vocabulary ignores white space and case (word_bpe), else it keeps
    both (byte_bpe).
    """

    def __init__(self, path: str, drops_space: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.type = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.drops_space = drops_space
        self.letters = _byte_letters()
        self.tokens = _Pieces(self._token)
        self.parts = _Pieces(self._dropped if drops_space else self._kept)

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.type).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _token(self, token: str) -> bytes:
        """Ids of exactly one pre-token."""
        letters = self.letters
        return self._pack([t.id for t in self.model.tokenize("".join([letters[b] for b in token.encode()]))])

    def _dropped(self, part: str) -> bytes:
        if _PLAIN(part):
            return b"".join(map(self.tokens.__getitem__, _DROPPED(part.lower())))
        return self._whole(part)

    def _kept(self, part: str) -> bytes:
        if not part or part[0] in _HAZARDS or part[-1] in _HAZARDS:
            raise _Hazard
        return self._exact(f" {part}")

    def _exact(self, run: str) -> bytes:
        if _PLAIN(run.replace(" ", "")):
            return b"".join(map(self.tokens.__getitem__, _KEPT(run)))
        return self._whole(run)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(token in text for token in self.added):
            return self._whole(text)
        parts = text.split(" ")
        if self.drops_space:
            return b"".join(map(self.parts.__getitem__, parts))
        try:
            if parts[0] and parts[0][-1] in _HAZARDS:
                raise _Hazard
            return self._exact(parts[0]) + b"".join(map(self.parts.__getitem__, parts[1:]))
        except _Hazard:
            return b"".join(map(self._exact, _RUNS(text)))

    def ids(self, text: str | None, end: int) -> np.ndarray:
        """Ids of the text and then the end id."""
        return np.frombuffer(self.encode(text) + self._pack([end]), dtype=self.type)


_HAZARDS = frozenset("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B))))


@lru_cache(maxsize=2)
def encoder(path: str, drops_space: bool) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return Encoder(path, drops_space)
