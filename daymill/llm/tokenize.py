"""Token ids of whole texts by a public tokenizer file, fast enough for a corpus.

Byte-level BPE of this kind never joins text across a single blank between two other
characters: a token takes the blank in front of it at most. A text is therefore the sequence
of its pieces between such blanks, and each distinct piece is encoded once by the tokenizers
library. Texts with any other white space beside a blank are encoded whole.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text looked at together, and pieces whose ids are kept before starting afresh.
CHUNK_BYTES = 8 << 20
KEPT_PIECES = 600_000
PIECES_AT_ONCE = 50_000
#: Marks that are looked at apart from the word before them.
MARKS = ".,!?;:$%*&#"
#: Letters whose kind no table of characters doubts; others take the longer way.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"


def _byte_chars() -> np.ndarray:
    """The character that stands for each byte in a byte-level vocabulary; a line feed stays, between words.

    Printable bytes of Latin-1 stand for themselves, all others follow from U+0100 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in shown]
    chars = np.arange(256, dtype="<u4")
    chars[others] = 256 + np.arange(len(others))
    chars[10] = 10
    return chars


BYTE_CHARS = _byte_chars()


def read_tokenizer(path: str) -> str:
    """The tokenizer file's content; tasks get it as text and need no file."""
    text = Path(path).read_text()
    pre = json.loads(text)["pre_tokenizer"]
    if pre["type"] != "ByteLevel" or pre["add_prefix_space"]:
        raise ValueError("a byte-level tokenizer without prefix blank is needed")
    return text


@lru_cache(maxsize=1)
def encoder(tokenizer: str) -> Encoder:
    """The encoder of this Python worker: tasks it runs one after another share the pieces kept."""
    return Encoder(tokenizer)


class Encoder:
    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.bytes_of[number] = len(token)
        self.known, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _ids_of(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces, each with a blank in front; new ones are learned.

        Marks behind a letter are tokens of their own, so a word with marks has the ids of
        the word and then those of the marks.
        """
        if len(self.known) > KEPT_PIECES:
            self.known, self.ids = self.known.slice(0, 0), self.ids.slice(0, 0)
        words = pc.utf8_rtrim(pieces, MARKS)
        marked = pc.and_(pc.not_equal(words, pieces), pc.match_substring_regex(words, f"[{LETTERS}]$"))
        coded = pc.if_else(marked, words, pieces).dictionary_encode()
        words, place = coded.dictionary, pc.index_in(coded.dictionary, self.known)
        new = np.flatnonzero(np.asarray(pc.is_null(place)))
        place = np.asarray(pc.fill_null(place, 0)).astype(np.int64)
        place[new] = len(self.known) + self._encode_pieces(words.take(pa.array(new)))
        of_words = self.ids.take(pa.array(place[np.asarray(coded.indices)]))
        marks = pc.if_else(marked, pc.replace_substring_regex(pieces, f"(?s)^.*[{LETTERS}]", ""), "").dictionary_encode()
        of_marks = pa.array([self.whole(m).tobytes() if m else b"" for m in marks.dictionary.to_pylist()], pa.large_binary())
        return pc.binary_join_element_wise(of_words, of_marks.take(marks.indices), pa.scalar(b"", pa.large_binary()))

    def _encode_pieces(self, pieces: pa.Array) -> np.ndarray:
        """Runs of the library over many pieces at a time, cut by their numbers of bytes.

        A piece of letters is one word to the tokenizer, blank included, so its model alone
        does; the rest goes through all of the tokenizer. Pieces are kept letters first; the
        place of each among the new ones is returned.
        """
        letters = pc.match_substring_regex(pieces, f"^[{LETTERS}]+$")
        rest = pc.invert(letters)
        for own, of_letters in ((pieces.filter(letters), True), (pieces.filter(rest), False)):
            for at in range(0, len(own), PIECES_AT_ONCE):
                part = own.slice(at, PIECES_AT_ONCE)
                text = ("\n " if of_letters else " ").join(["", *part.to_pylist()])
                if of_letters:
                    raw = np.frombuffer(text[1:].encode(), np.uint8)
                    coded = self.words.encode_batch_fast([BYTE_CHARS[raw].tobytes().decode("utf-32-le")], add_special_tokens=False)
                else:
                    coded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
                ids = np.array(coded[0].ids, np.uint32)
                ends = np.cumsum(np.asarray(pc.binary_length(part)).astype(np.int64) + 1)
                cuts = np.insert(4 * (np.searchsorted(np.cumsum(self.bytes_of[ids]), ends) + 1), 0, 0)
                cells = pa.Array.from_buffers(pa.large_binary(), len(part), [None, pa.py_buffer(cuts), pa.py_buffer(ids)])
                self.known, self.ids = pa.concat_arrays([self.known, part]), pa.concat_arrays([self.ids, cells])
        return np.argsort(np.argsort(np.asarray(rest), kind="stable"))

    def encode(self, texts: pa.Array, end: bytes, kind: str) -> pa.Array:
        """Ids of each text with the end behind them, as bytes of ``kind``; ``end`` and ids kept are four bytes each."""
        parts = pc.split_pattern(texts, " ")
        bounds = np.asarray(parts.offsets)
        coded = parts.flatten().dictionary_encode()
        codes, pieces = np.asarray(coded.indices).astype(np.int64), coded.dictionary
        trimmed = pc.utf8_trim_whitespace(pieces)
        odd = np.asarray(pc.or_(pc.not_equal(trimmed, pieces), pc.equal(trimmed, ""))).astype(bool)
        usual = np.flatnonzero(~odd)
        of_pieces = self._ids_of(pieces.take(pa.array(usual)))
        # odd pieces share the empty cell behind those of the others
        cell = np.full(len(pieces), len(usual))
        cell[usual] = np.arange(len(usual))
        values = [b""]
        # a text's first piece has no blank in front
        first = bounds[:-1]
        leading, of = np.unique(codes[first], return_inverse=True)
        codes, lead_codes = cell[codes], len(usual) + 1 + of
        values += [self.whole(p).tobytes() if not odd[c] else b"" for c, p in zip(leading.tolist(), pieces.take(pa.array(leading)).to_pylist(), strict=True)]
        odd_texts = np.unique(np.searchsorted(bounds, np.flatnonzero(codes == len(usual)), "right") - 1)
        codes[first] = lead_codes
        for t in odd_texts.tolist():
            codes[bounds[t] : bounds[t + 1]] = len(usual)
            codes[bounds[t]] = len(usual) + len(values)
            values.append(self.whole(texts[t].as_py()).tobytes())
        values.append(end)
        # one more piece behind each text, its end; then each piece's bytes are copied once
        every = pa.concat_arrays([of_pieces, pa.array(values, pa.large_binary())])
        sizes = np.frombuffer(every.buffers()[1], np.int64, len(every) + 1) // 4
        store = np.frombuffer(every.buffers()[2], "<u4", sizes[-1]).astype(kind)
        width = store.dtype.itemsize
        cells = pa.Array.from_buffers(pa.large_binary(), len(every), [None, pa.py_buffer(sizes * width), pa.py_buffer(store)])
        found = cells.take(pa.array(np.insert(codes, bounds[1:], len(every) - 1)))
        at = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1)[bounds + np.arange(len(bounds))]
        return pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(at), found.buffers()[2]])

    def arrays(self, texts: pa.Array, end_id: int, kind: str) -> Iterator[pa.Array]:
        """Ids of each text with the end id behind them, as bytes of ``kind``: arrays for some texts after another, in order."""
        texts, end = texts.cast(pa.large_string()), np.uint32(end_id).tobytes()
        sizes = np.asarray(pc.binary_length(texts)).astype(np.int64)
        group = np.cumsum(sizes) // CHUNK_BYTES
        cuts = np.flatnonzero(np.diff(group)) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)], strict=True):
            if low < high:
                yield self.encode(texts.slice(low, high - low), end, kind)

    def documents(self, texts: pa.Array, end_id: int) -> Iterator[np.ndarray]:
        """Ids of each text with the end id behind them, in order."""
        for cells in self.arrays(texts, end_id, "<u4"):
            ends = np.frombuffer(cells.buffers()[1], np.int64, len(cells) + 1) // 4
            ids = np.frombuffer(cells.buffers()[2], np.uint32, ends[-1])
            yield from (ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
