"""Token ids of whole texts with a public tokenizer file, inside Spark tasks.

The tokenizer splits lower-cased text into runs of letters, single digits and runs of other
signs, and encodes each on its own. So ids are looked up by what stands between blanks, then
by such piece, and only pieces not seen before reach the tokenizer's model. This holds for
texts of printable Latin-1 without special-token marks; any other text is encoded whole.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer

#: Fixed pattern of the tokenizer file's pre-tokenizer.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
PLAIN = regex.compile(r"[\t-\r\x20-\x7e\xa1-\xff]*")
#: Most entries that a worker's memo keeps; beyond it, new ones are encoded each time.
MEMO = 180_000


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Encoder:
    """Little-endian uint32 ids of texts, with a memo."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.letters = _byte_letters()
        self.memo: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        spelled = "".join([self.letters[b] for b in piece.encode()])
        return b"".join([t.id.to_bytes(4, "little") for t in self.whole.model.tokenize(spelled)])

    def _chunk(self, chunk: str) -> bytes:
        """Ids of what stands between blanks; a chunk and a piece that read alike have the same ids and share an entry."""
        pieces = PIECE.findall(chunk)
        ids = self._piece(chunk) if len(pieces) == 1 else b"".join([self.memo.get(p) or self._kept(p, self._piece(p)) for p in pieces])
        return self._kept(chunk, ids)

    def _kept(self, key: str, ids: bytes) -> bytes:
        if len(self.memo) < MEMO:
            self.memo[key] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if PLAIN.fullmatch(text) and "<|" not in text:
            get, chunk = self.memo.get, self._chunk
            return b"".join([get(w) or chunk(w) for w in text.lower().split()])
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    return Encoder(path)
