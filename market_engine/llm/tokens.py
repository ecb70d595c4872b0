"""Token ids of texts, by a library that cuts and merges plain texts fast, if the vocabulary allows it."""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import tiktoken
from tokenizers import Tokenizer

# Characters up to U+024F and common punctuation and currency signs: their classes (letters, numbers, white
# space, others) are the same in every version of Unicode, so the standard library can make the cuts. Fixed
# values: the letters and numbers among them.
_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_SPACES = "\t-\r \u0085\u00a0"
_PLAIN = re.compile("[^\u0000-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]")
_CUTS = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d"
    f"| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_SPACES}{_LETTERS}{_NUMBERS}]+"
    f"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
)
# A run of white space leaves its last character to what follows. Texts are split there, so that the pattern below needs
# no look ahead, which makes it slow.
_RUN = re.compile(f"[{_SPACES}][{_SPACES}]")
_LAST_OF_RUN = re.compile(f"(?<=[{_SPACES}])(?=[{_SPACES}][^{_SPACES}])")
_SPLIT_CUTS = (
    "'(?:s|t|re|ve|m|ll|d)"
    f"| ?(?:[{_LETTERS}]+|[{_NUMBERS}]+|[^{_SPACES}{_LETTERS}{_NUMBERS}]+)"
    f"|[{_SPACES}]+"
)
#: Remembered pieces, where the vocabulary has merges in another order; the memory starts anew beyond.
REMEMBERED = 400_000


def _as_bytes() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: itself if it prints, else from 256 on in order."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printing]
    return {chr(b): b for b in printing} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _piece_encoder(path: str) -> tiktoken.Encoding | None:
    """The same merges in a library that takes plain texts faster, if they are in the order of their ids."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    vocabulary, codes = model["vocab"], _as_bytes()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ids = [vocabulary[a + b] for a, b in pairs]
    singles = [vocabulary.get(c) for c in codes]
    if model.get("type") != "BPE" or None in singles or ids != sorted(ids) or max(singles) >= ids[0]:
        return None
    made = {a + b for a, b in pairs} | set(codes)
    ranks = {bytes(codes[c] for c in token): vocabulary[token] for token in made}
    return tiktoken.Encoding("pieces", pat_str=_SPLIT_CUTS, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids as little-endian unsigned 32-bit numbers, equal to those of the tokenizer on the whole text.

    The byte-level vocabulary never merges across the cuts of its pattern, so pieces can be encoded on their
    own. Texts with other characters than those above go to the tokenizer whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [str(t) for t in (x.content for x in self.tokenizer.get_added_tokens_decoder().values())]
        self.pieces = _piece_encoder(path)
        self.memory: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def ids(self, text: str) -> bytes:
        if _PLAIN.search(text) or any(s in text for s in self.special):
            return self._whole(text)
        if self.pieces:
            parts = _LAST_OF_RUN.split(text) if _RUN.search(text) else [text]
            return b"".join(np.array(self.pieces.encode_ordinary(part), dtype="<u4").tobytes() for part in parts)
        pieces, memory = _CUTS.findall(text), self.memory
        try:
            return b"".join(map(memory.__getitem__, pieces))
        except KeyError:
            pass
        if len(memory) > REMEMBERED:
            memory.clear()
        self._learn({p for p in pieces if p not in memory})
        return b"".join(map(memory.__getitem__, pieces))

    def _learn(self, unknown: set[str]) -> None:
        rest = list(unknown)
        for piece, found in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            self.memory[piece] = np.array(found.ids, dtype="<u4").tobytes()


@lru_cache(maxsize=1)
def shared_encoder(path: str) -> Encoder:
    """The encoder of a vocabulary, made once in a Python worker and not for each of its tasks."""
    return Encoder(path)
