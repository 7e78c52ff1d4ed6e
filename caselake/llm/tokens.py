"""Ids of whole texts as a ``tokenizers`` file gives them, a batch at a time.

One kind of file drops white space and splits words before it merges, so a text's
ids are those of its pieces between ASCII white space, one after the other. For it
Arrow cuts and dictionary-encodes a batch twice: into pieces, and the different
pieces of plain characters into the words that the file's split rule makes of them.
The library's model sees a word once per worker; pieces with other characters go to
the library as they are. Whether a file is of that kind is read from the file; texts
go to the library whole for any other.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of words, odd pieces and their ids a worker remembers before it starts afresh.
REMEMBERED = 24 << 20
#: Bytes of texts that are cut at once: bounds what a batch takes besides its texts.
SLICE_BYTES = 4 << 20

# Normaliser and split rule of the kind of file whose texts may be cut at white space.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}

#: Characters whose normal form is their lower case: printable ASCII and the letters up to U+00FF.
PLAIN = "\x21-\x7eÀ-ÖØ-öø-ÿ"
#: The split rule for lower-case plain characters.
PLAIN_SPLIT = "('s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ a-zß-öø-ÿ0-9]+)"


def _byte_characters() -> dict[int, str]:
    """Plain characters as byte-level files write them: each byte of UTF-8 is a character, printable
    ones themselves, the others from U+0100 on in order."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(0x100) if b not in set(printable)]
    as_character = {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(other)}
    return {c: "".join(as_character[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}


BYTE_CHARACTERS = _byte_characters()


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core already
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class PieceEncoder:
    """Remembers the ids of words and odd pieces; neither holds ASCII white space."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.tokenizer = load(path)
        self.remembered = remembered
        rules = json.loads(self.tokenizer.to_str())
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.marks = [t.content for t in added]
        apart = not any(t.lstrip or t.rstrip or t.single_word or re.search(r"\s", t.content) for t in added)
        #: Whether texts may be cut at white space: the file holds the rules above and no added token looks beyond it.
        self.cuts = rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == PRE_TOKENIZER and not rules["post_processor"] and apart
        self.forget()

    def forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.ends = np.zeros(1, np.int64)  # of the ids of each word in ``flat``
        self.flat = np.zeros(0, np.uint32)

    def looked_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of different plain words and odd pieces in what is remembered, which they join if they are new."""
        if self.words.nbytes + 8 * len(self.ends) + self.flat.nbytes > self.remembered:
            self.forget()
        places = pc.index_in(words, value_set=self.words)
        new = words.filter(places.is_null())
        if len(new):
            known = len(self.words)
            tokenize, flat, ends = self.tokenizer.model.tokenize, [], []
            for word, plain in zip(new.to_pylist(), self.plain(new).to_pylist()):
                if plain:
                    flat += [t.id for t in tokenize(word if word.isascii() else word.translate(BYTE_CHARACTERS))]
                else:
                    flat += self.tokenizer.encode(word, add_special_tokens=False).ids
                ends.append(len(flat))
            self.words = pa.concat_arrays([self.words, new])
            self.ends = np.concatenate([self.ends, len(self.flat) + np.array(ends, np.int64)])
            self.flat = np.concatenate([self.flat, np.array(flat, np.uint32)])
            missing = places.is_null().to_numpy(zero_copy_only=False)
            places = places.fill_null(0).to_numpy().copy()
            places[missing] = known + np.arange(len(new))
        else:
            places = places.to_numpy()
        return self.ends[places], self.ends[places + 1]

    def plain(self, pieces: pa.Array) -> pa.Array:
        plain = pc.match_substring_regex(pieces, f"^[{PLAIN}]*$")
        for mark in self.marks:
            plain = pc.and_not(plain, pc.match_substring(pieces, mark))
        return plain

    def slices(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For slices of the texts: tokens per text, and the pieces as codes into a dictionary of ids.

        Yields (tokens per text, piece codes, tokens per entry, ids of all entries).
        """
        texts = pc.fill_null(texts, "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(texts):
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, "right")))
            part = texts.slice(start, end - start)
            yield self.slice(part) if self.cuts else self.whole(part)
            start = end
        pa.default_memory_pool().release_unused()

    def whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Texts as the library encodes them: each is an entry of its own."""
        ids = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts.to_pylist()]
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        return n, np.arange(len(ids)), n, np.concatenate(ids)

    def slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        pieces, coded = _cut(texts)
        words, parts = _cut(self.spaced(coded.dictionary))
        starts, ends = self.looked_up(parts.dictionary)
        word_codes = parts.indices.to_numpy(zero_copy_only=False)
        lengths = (ends - starts)[word_codes]
        per_entry = _summed(lengths, words)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        return _summed(per_entry[codes], pieces), codes, per_entry, _stretches(self.flat, starts[word_codes], lengths)

    def spaced(self, pieces: pa.Array) -> pa.Array:
        """Plain pieces with white space between their words; the others as they are."""
        return pc.if_else(self.plain(pieces), pc.replace_substring_regex(pc.utf8_lower(pieces), PLAIN_SPLIT, r"\1 "), pieces)


def _cut(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Number of stretches without ASCII white space in each text, and all of them."""
    cut = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    return pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64), cut.flatten().dictionary_encode()


def _summed(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of the given lengths."""
    running = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(lengths)
    return running[ends] - running[ends - lengths]


def gathered(codes: np.ndarray, per_entry: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Ids of all pieces in order."""
    starts = np.cumsum(per_entry) - per_entry
    return _stretches(flat, starts[codes], per_entry[codes])


def _stretches(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` that start at the given places, one after the other."""
    before = np.cumsum(lengths) - lengths
    return flat[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """The worker's encoder: kept from task to task."""
    return PieceEncoder(path)
