"""Encoding whole texts with a public tokenizer file, one distinct word at a time."""

from __future__ import annotations

import os
import re
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Distinct pieces, and distinct odd words, one generation of a Python worker's memory holds; two are kept.
REMEMBERED, REMEMBERED_WORDS = 500_000, 200_000
#: Characters of the texts, or a single longer text, whose distinct words are looked up together.
TOGETHER = 2_000_000
#: Words whose pieces are plain to see: Latin-1 without control characters, which NFC leaves as they are.
_PLAIN = re.compile(r"[!-~\xa1-\xac\xae-\xff]+")
#: The tokenizer's own pieces within such a word, once lower-cased (fixed by the tokenizer's file).
_PIECES = re.compile(
    r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿªºµ]+|[0-9²³¹¼½¾]|[^a-zß-öø-ÿªºµ0-9²³¹¼½¾]+"
)


def _byte_letters() -> dict[int, str]:
    """Byte-level alphabet: visible Latin-1 bytes stand for themselves, the others follow from code point 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Memory(dict):
    """Values by key, made when first asked for; what was not asked for in a whole generation is forgotten."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.older = make, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value

    def turn(self) -> None:
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()


class WordEncoder:
    """Ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False)``.

    The tokenizer drops white space and normalises to NFC, which never joins characters across it. So a text's ids
    are the joined ids of its parts between spaces, tabs and line ends. Each distinct word of a group of texts is
    looked up once, and what the tokenizer made of a piece or an odd word is remembered. Pieces of plain words go
    straight to the tokenizer's model; any other word takes the whole tokenizer, as do words with ``<|``: the file's
    added tokens (``<|startoftext|>``, ``<|endoftext|>``) hold no white space and are ids of their own wherever their
    strings stand, glued to other text or not.
    """

    def __init__(self, name: str = TOKENIZER):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.letters = _byte_letters()
        size = self.tokenizer.get_vocab_size()
        self.packed = [number.tobytes() for number in np.arange(size, dtype="<u4")]
        self.odd = _Memory(self._whole, REMEMBERED_WORDS)
        self.pieces = _Memory(self._piece, REMEMBERED)

    def _piece(self, piece: str) -> bytes:
        # Visible ASCII stands for itself in the byte-level alphabet.
        seen = piece if piece.isascii() else piece.encode("utf-8").decode("latin-1").translate(self.letters)
        return b"".join([self.packed[t.id] for t in self.tokenizer.model.tokenize(seen)])

    def _word(self, word: str) -> bytes:
        if word.isascii():
            if word.isalpha():
                return self.pieces[word.lower()]
            # Letters and one mark at their end, as before a comma.
            if word[:-1].isalpha() and word[-1] in string.punctuation:
                return self.pieces[word[:-1].lower()] + self.pieces[word[-1]]
        if _PLAIN.fullmatch(word) and "<|" not in word:
            if word.isalpha():
                return self.pieces[word.lower()]
            return b"".join(map(self.pieces.__getitem__, _PIECES.findall(word.lower())))
        return self.odd[word]

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, with the end id; a null text has the end id alone."""
        out, held, size = [], [], 0
        for text in texts:
            held.append((text or "").replace("\n", " ").replace("\t", " ").replace("\r", " "))
            size += len(held[-1])
            if size >= TOGETHER:
                out += self._encoded(held)
                held, size = [], 0
        return out + self._encoded(held) if held else out

    def _encoded(self, texts: list[str]) -> list[bytes]:
        self.odd.turn()
        self.pieces.turn()
        end = np.uint32(END_ID).tobytes()
        words = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded = words.values.dictionary_encode()
        ids = pa.array(map(self._word, coded.dictionary.to_pylist()), pa.large_binary())
        # Taking each word's ids in the order of the words joins them in one buffer.
        joined = ids.take(coded.indices)
        _, places, data = joined.buffers()
        bounds = np.frombuffer(places, dtype=np.int64)[words.offsets.to_numpy()].tolist()
        data = memoryview(b"" if data is None else data)
        return [b"".join((data[i:j], end)) for i, j in zip(bounds, bounds[1:], strict=False)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(name: str = TOKENIZER) -> WordEncoder:
    """The encoder of this Python worker."""
    if name not in _ENCODERS:
        _ENCODERS[name] = WordEncoder(name)
    return _ENCODERS[name]


def texts_of(batch: pa.RecordBatch, text: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(text)).to_pylist()
