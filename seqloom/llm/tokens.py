"""Byte-level BPE by the tokenizers library over Arrow batches, encoding each different word of a batch once.

A text may be cut before every single blank between two other characters: no pretoken of the split pattern crosses
such a place, and none looks back. So a text's ids are those of its blank-led words one after the other.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import text_buffer

#: Different words whose ids a worker remembers at most; beyond it the memory starts anew.
MEMORY_WORDS = 400_000

#: Fixed value: the split pattern of byte-level tokenizers.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Fixed value: the split pattern of word-level tokenizers whose last symbols carry a word end; text is composed and lower-cased before.
WORD_END_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def cut_before_blanks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of the words, index of each text's first word with the total appended).

    Cuts fall before a blank whose neighbours are ASCII letters, digits or marks, or before the start of a text.
    Neighbours outside ASCII may be blanks of Unicode, so no cut is made beside the two that end in such bytes
    unless the byte cannot belong to one.
    """
    solid = ~_WHITE[data]
    # U+0085, U+00A0, U+1680, U+2000-200A, U+2028-9, U+202F, U+205F and U+3000 start with C2, E1, E2, E3; FS-US are 1C-1F.
    risky = np.isin(data, [0xC2, 0xE1, 0xE2, 0xE3, 0x1C, 0x1D, 0x1E, 0x1F])
    near = risky.copy()
    near[1:] |= risky[:-1]
    near[2:] |= risky[:-2]
    solid &= ~near
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 2:
        cut[1:-2] = (data[1:-1] == 32) & solid[:-2] & solid[2:]
    cut[offsets] = True
    places = np.flatnonzero(cut)
    return places, np.searchsorted(places, offsets)


class WordEncoder:
    """Ids of whole texts; ``encode_words`` maps a list of strings to a list of id lists."""

    def __init__(self, encode_words: Callable[[list[str]], list[list[int]]]):
        self.encode_words = encode_words
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)  # of each known word in flat, and the end of the last

    def _learn(self, new: list[bytes]) -> None:
        ids = self.encode_words([w.decode("utf-8") for w in new])
        n, at = len(self.known), self.starts[len(self.known)]
        ends = at + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        while len(self.flat) < ends[-1]:
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.starts) < n + len(new) + 1:
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
        self.flat[at : ends[-1]] = np.fromiter(chain.from_iterable(ids), np.uint32, int(ends[-1] - at))
        self.starts[n + 1 : n + 1 + len(new)] = ends
        self.known.update(zip(new, range(n, n + len(new)), strict=True))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text's ids); a null text is empty."""
        data, offsets = text_buffer(column)
        places, first = cut_before_blanks(data, offsets)
        return self._ids(pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(data)]), first)

    def encode_spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for words given by their spans; ``first`` is the index of each text's first word, with the total appended."""
        lengths = ends - starts
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] = 1
        inside[ends] -= 1  # a word may begin where another ends
        packed = data[np.cumsum(inside[:-1], dtype=np.int8).view(bool)]
        return self._ids(pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(packed)]), first)

    def _ids(self, words: pa.Array, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        coded = pc.dictionary_encode(words)
        different = coded.dictionary.to_pylist()
        if len(self.known) + len(different) > MEMORY_WORDS:
            self._forget()
        new = [w for w in different if w not in self.known]
        if new:
            self._learn(new)
        row = np.fromiter(map(self.known.__getitem__, different), np.int64, len(different))[coded.indices.to_numpy(zero_copy_only=False)]
        begin = self.starts[row]
        lengths = self.starts[row + 1] - begin
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.arange(total) + np.repeat(begin - (ends - lengths), lengths)]
        return ids, np.concatenate([[0], ends])[first]


def by_library(tokenizer) -> WordEncoder:
    """Encoder over a tokenizer object of the tokenizers library, special tokens not added."""
    return WordEncoder(lambda words: [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)])


def single_threaded() -> None:
    """Keep the library to the task's core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable in Latin-1, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def from_json(path: str) -> WordEncoder:
    """Encoder of a byte-level tokenizer file, special tokens not added.

    Merging unknown words is most of the work. Where every merge makes the token whose id is its place in the order of merges, as in
    byte-level files, the ids are also those of merging by rank, which tiktoken does at a third of the cost; the
    library itself takes words with special tokens and very long ones. Other files are left to the library.
    """
    single_threaded()
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    special = [t["content"] for t in content["added_tokens"]]
    vocabulary = {k: v for k, v in content["model"]["vocab"].items() if k not in special}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
    made = [vocabulary.get(a + b, -1) for a, b in pairs]
    by_rank = made == sorted(made) and len({*made}) == len(made) and -1 not in made and content["normalizer"] is None
    if not by_rank or content["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": content["pre_tokenizer"].get("trim_offsets"), "use_regex": True}:
        return by_library(tokenizer)
    ranks = {bytes(byte_of[c] for c in k): v for k, v in vocabulary.items()}
    quick = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    slow = lambda w: tokenizer.encode(w, add_special_tokens=False).ids
    return WordEncoder(lambda words: [slow(w) if len(w) > 1000 or any(s in w for s in special) else quick(w) for w in words])


def from_word_json(path: str) -> WordEncoder:
    """Encoder of blank-free words for a tokenizer file with word ends, special tokens not added.

    As in ``from_json``, merging by rank takes the place of the library where the file allows: the word end is one more byte behind a piece, 0xFF, which no text holds, and
    joins the last symbol first. Words of ASCII and of the Latin-1 letters are lower-cased and split here; all others, those that
    may hold special tokens and very long ones are left to the library, and so are files with other rules.
    """
    single_threaded()
    import regex
    import tiktoken
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        content = json.load(f)
    model, end = content["model"], content["model"]["end_of_word_suffix"]
    rules = [
        {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
        {"type": "Sequence", "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": WORD_END_PATTERN}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ]},
    ]
    special = [t["content"] for t in content["added_tokens"]]
    ids = {k: v for k, v in model["vocab"].items() if k not in special}
    joined = lambda a, b: ids.get(a + b, -1)
    made = [joined(*(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
    letters = byte_characters()
    single = [ids.get(c + e, -1) for e in ("", end or "") for c in letters]
    in_order = sorted(single) + made == list(range(len(ids)))
    if not end or not in_order or [content["normalizer"], content["pre_tokenizer"]] != rules or not all("|" in t for t in special):
        return by_library(tokenizer)
    byte_of = {c: b for b, c in enumerate(letters)}
    ranks = {bytes(byte_of[c] for c in k.removesuffix(end)) + (b"\xff" if k.endswith(end) else b""): v for k, v in ids.items()}
    quick = tiktoken.Encoding("words", pat_str=WORD_END_PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
    simple = regex.compile("[!-{}~\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]{1,1000}").fullmatch
    pieces = regex.compile(WORD_END_PATTERN).findall

    def word(w: str) -> list[int]:
        if not simple(w):
            return tokenizer.encode(w, add_special_tokens=False).ids
        w = w.lower()
        if w.isalpha():
            return quick(w.encode() + b"\xff")
        return [i for p in pieces(w) for i in quick(p.encode() + b"\xff")]

    return WordEncoder(lambda words: [word(w) for w in words])
