"""Token ids of whole texts by the tokenizers and sentencepiece libraries, with a cache of pre-tokens in each worker.

A byte-level vocabulary without normaliser encodes each pre-token by itself, so a text made of characters on which all
versions of Unicode agree is cut by a plain pattern and its pre-tokens are looked up; the library's model encodes the
misses. Any other text, one holding an added token's string and any other kind of vocabulary go to the library whole.
"""

from __future__ import annotations

import json
import re
import struct
from functools import cache

import numpy as np

# fixed values: letters and other characters of Latin-1 and common punctuation whose class is the same in every version
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
OTHERS = "¡-©«¬®¯±´¶-¸»¿×÷–—‘’“”„…€"
PLAIN = re.compile(f"[\\t\\n\\r\\x20-\\x7e{LETTERS}{OTHERS}]*")
# fixed value: the pre-token pattern of byte-level vocabularies, on the characters above
PIECES = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+"
)
CACHE_ENTRIES = 1 << 19
PIECE_CHARS = 64  # longer pre-tokens are encoded anew each time, so a full cache stays at some 200 MB


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Pieces(dict):
    """Pre-token to encoded value; misses are encoded, and kept if they are short and while there is room."""

    def __init__(self, encode, room: int):
        super().__init__()
        self.encode, self.room = encode, room

    def __missing__(self, piece: str):
        value = self.encode(piece)
        if len(piece) <= PIECE_CHARS and len(self) < self.room:
            self[piece] = value
        return value


class Encoder:
    """Ids of texts; ``width`` is the number of bytes of a stored id."""

    def __init__(self, path: str, room: int = CACHE_ENTRIES):
        self.path = path
        self.added: list[str] = []
        self.fast = False
        if path.endswith(".model"):
            import sentencepiece

            self.library = sentencepiece.SentencePieceProcessor(model_file=path)
            self.size = self.library.vocab_size()
        else:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(path)
            self.library.no_truncation()
            self.library.no_padding()
            self.size = self.library.get_vocab_size(with_added_tokens=True)
            form = json.loads(self.library.to_str())
            pre = form.get("pre_tokenizer") or {}
            self.added = [t["content"] for t in form.get("added_tokens", [])]
            self.fast = (
                form.get("normalizer") is None
                and pre.get("type") == "ByteLevel"
                and not pre.get("add_prefix_space")
                and pre.get("use_regex", True)
                and form["model"].get("type") == "BPE"
            )
            self.model, self.table = self.library.model, byte_alphabet()
            self.space = self.table[ord(" ")]
        self.width = 2 if self.size <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.packed = cache(lambda n: struct.Struct(f"<{n}{'H' if self.width == 2 else 'I'}").pack)
        self.ids_of = _Pieces(self._piece_bytes, room)
        self.length_of = _Pieces(lambda p: len(self._piece(p)), room)

    def _piece(self, piece: str) -> list[int]:
        if piece.isascii() and piece.isprintable():  # of these only the space is shown as another character
            shown = piece.replace(" ", self.space)
        else:
            shown = piece.encode().decode("latin-1").translate(self.table)
        return [t.id for t in self.model.tokenize(shown)]

    def _piece_bytes(self, piece: str) -> bytes:
        ids = self._piece(piece)
        return self.packed(len(ids))(*ids)

    def plain(self, text: str) -> bool:
        return self.fast and PLAIN.fullmatch(text) is not None and not any(a in text for a in self.added)

    def library_ids(self, text: str) -> list[int]:
        """The library's own ids of a whole text."""
        if self.path.endswith(".model"):
            return self.library.encode(text, num_threads=1)
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned integers of ``width`` bytes."""
        if self.plain(text):
            return b"".join(map(self.ids_of.__getitem__, PIECES.findall(text)))
        return np.array(self.library_ids(text), dtype=self.kind).tobytes()

    def count(self, text: str) -> int:
        if self.plain(text):
            return sum(map(self.length_of.__getitem__, PIECES.findall(text)))
        return len(self.library_ids(text))


@cache
def encoder(path: str) -> Encoder:
    """The encoder of this worker process; workers are used for many tasks, so its cache lives on."""
    return Encoder(path)
