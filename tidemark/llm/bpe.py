"""Encoding whole texts with a public tokenizer, each different part once per worker.

The byte-level pre-tokenizer splits between letters, digits and marks and before the last
white space of a run, whatever stands around, so a text may be cut there and the parts
encoded apart. Parts recur, so a worker keeps the ids of recent ones under 64-bit hashes,
in flat arrays. Cutting, hashing, looking up and laying out the ids is array work on the
UTF-8 bytes; no Python object is made per word. All unseen parts of a piece go through
the library in one string and are told apart by the byte lengths of their ids.
"""

from __future__ import annotations

import os
import re
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from tidemark.llm import text

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
# Parts and ids a worker keeps; beyond either it starts anew.
MAX_PARTS, MAX_IDS = 3 << 19, 1 << 24
SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
# A part that keeps its ids after a line end and before another.
PLAIN = re.compile(f" ?[^{SPACE}](?:.*[^{SPACE}])?", re.S)

# Classes of bytes. OTHER ones are control characters and all beyond ASCII; a mark's apostrophe may join letters after it.
OTHER, BLANK, BREAK, LETTER, DIGIT, MARK, APOSTROPHE = range(7)
KINDS = np.zeros(256, np.uint8)
for _c in range(0x21, 0x7F):
    KINDS[_c] = LETTER if chr(_c).isalpha() else DIGIT if chr(_c).isdigit() else MARK
KINDS[0x20], KINDS[0x27] = BLANK, APOSTROPHE
KINDS[0x09:0x0E] = BREAK


def _cuts() -> np.ndarray:
    """[a, b]: whether a text may be cut between bytes of these kinds."""
    cut = np.zeros((7, 7), bool)
    words = [LETTER, DIGIT, MARK]
    for a in words:
        cut[a, words] = True
        cut[a, a] = False
    cut[[LETTER, DIGIT], APOSTROPHE] = True
    for a in (*words, APOSTROPHE):
        cut[a, [BLANK, BREAK]] = True
        cut[BREAK, a] = True
    return cut.ravel()


CUTS = _cuts()
# Last bytes of UTF-8 white space beyond ASCII.
SPACE_ENDS = np.zeros(256, bool)
SPACE_ENDS[[0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F]] = True


def cut_places(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where parts begin, in a line of texts that begin at `offsets`; every text that is not empty begins one."""
    n = len(data)
    kinds = KINDS[data]
    white = (kinds == BLANK) | (kinds == BREAK)
    maybe_white = SPACE_ENDS[data]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins = np.zeros(n, bool)
    begins[1:] = CUTS[kinds[:-1] * np.uint8(7) + kinds[1:]]
    # What is cut off after a line end must not be the last of several white spaces with others beyond ASCII.
    begins[2:] &= ~(maybe_white[:-2] & white[1:-1])
    # After a character beyond ASCII that is surely no white space.
    begins[1:] |= white[1:] & (data[:-1] >= 0x80) & ~maybe_white[:-1]
    # Before the last of several, if a plain character of the same text follows.
    last = np.zeros(n, bool)
    last[1:-1] = white[:-2] & white[1:-1] & (kinds[2:] >= LETTER)
    last[edges[edges > 0] - 1] = False
    begins |= last
    begins[edges] = True
    return np.flatnonzero(begins)


def laid(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, end on end."""
    stops = np.cumsum(sizes)
    return np.arange(int(stops[-1]) if len(stops) else 0) + np.repeat(starts - stops + sizes, sizes)


class KnownParts:
    """Ids of parts by their hashes: an open table of slots, and arrays that grow."""

    def __init__(self, dtype: np.dtype):
        self.dtype = dtype
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(1 << 16, -1, np.int32)
        self.hashes, self.starts, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.ids = np.zeros(0, self.dtype)
        self.n_parts = self.n_ids = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each part, -1 where it is not known."""
        mask = np.uint64(len(self.slots) - 1)
        slot = (hashes & mask).astype(np.int64)
        found = self.slots[slot]
        if not self.n_parts:
            return found
        # Slots taken by another hash send the search on to the next one.
        wrong = np.flatnonzero((found >= 0) & (self.hashes[found] != hashes))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & int(mask)
            found[wrong] = self.slots[slot[wrong]]
            wrong = wrong[(found[wrong] >= 0) & (self.hashes[found[wrong]] != hashes[wrong])]
        return found

    def add(self, hashes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """New parts, each once; `starts` are places in `ids`."""
        first, n = self.n_parts, len(hashes)
        self.hashes = _appended(self.hashes, first, hashes)
        self.starts = _appended(self.starts, first, starts + self.n_ids)
        self.sizes = _appended(self.sizes, first, sizes)
        self.ids = _appended(self.ids, self.n_ids, ids)
        self.n_parts, self.n_ids = first + n, self.n_ids + len(ids)
        if 2 * self.n_parts > len(self.slots):
            size = len(self.slots)
            while 2 * self.n_parts > size:
                size *= 2
            self.slots = np.full(size, -1, np.int32)
            first = 0
        self._place(np.arange(first, self.n_parts, dtype=np.int32))

    def _place(self, parts: np.ndarray) -> None:
        mask = len(self.slots) - 1
        slot = (self.hashes[parts] & np.uint64(mask)).astype(np.int64)
        while len(parts):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = parts[free]
            # Of several parts at one slot the last has it.
            left = self.slots[slot] != parts
            parts, slot = parts[left], (slot[left] + 1) & mask


def _appended(array: np.ndarray, n: int, more: np.ndarray) -> np.ndarray:
    """`array`, whose first n values are in use, with `more` after them; room grows by half."""
    if n + len(more) > len(array):
        grown = np.zeros(n + len(more) + (n >> 1), array.dtype)
        grown[:n] = array[:n]
        array = grown
    array[n : n + len(more)] = more
    return array


class BpeEncoder:
    """Ids of texts as bytes of little-endian unsigned integers of `width` bytes."""

    def __init__(self, path: str, specials_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = specials_as_text
        vocabulary = self.tokenizer.get_vocab()
        size = max(vocabulary.values()) + 1
        self.width = 2 if size <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        # In a byte-level vocabulary every character of a token stands for one byte.
        self.bytes_of = np.zeros(size, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)
        added = [] if specials_as_text else [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = [x.encode() for x in added]
        self.table = text.byte_table(False)
        self.known = KnownParts(self.dtype)

    def _ids(self, part: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([part], add_special_tokens=False)[0].ids, self.dtype)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> None:
        """Add the ids of different unseen parts."""
        first, last = KINDS[data[starts]], KINDS[data[ends - 1]]
        second = KINDS[data[np.minimum(starts + 1, ends - 1)]]
        plain = (last >= LETTER) & ((first >= LETTER) | ((first == BLANK) & (second >= LETTER)))
        for i in np.flatnonzero(~plain & ((first == OTHER) | (second == OTHER) | (last == OTHER))):
            plain[i] = PLAIN.fullmatch(data[starts[i] : ends[i]].tobytes().decode()) is not None
        packed = np.flatnonzero(plain)
        if len(packed) and not self._learn_packed(data, starts[packed], ends[packed], hashes[packed]):
            plain[:] = False
        for i in np.flatnonzero(~plain):
            ids = self._ids(data[starts[i] : ends[i]].tobytes().decode())
            self.known.add(hashes[i : i + 1], np.zeros(1, np.int64), np.array([len(ids)]), ids)

    def _learn_packed(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> bool:
        """Encode parts in one string, a line end before each; false if they cannot be told apart."""
        sizes = ends - starts + 1
        line = data[np.maximum(laid(starts - 1, sizes), 0)]
        stops = np.cumsum(sizes)
        line[stops - sizes] = 0x0A
        ids = self._ids(line.tobytes().decode())
        bytes_before = np.concatenate(([0], np.cumsum(self.bytes_of[ids])))
        heads = np.searchsorted(bytes_before, np.concatenate(([0], stops)))
        if heads[-1] >= len(bytes_before) or not np.array_equal(bytes_before[heads], np.concatenate(([0], stops))):
            return False
        if (self.bytes_of[ids[heads[:-1]]] != 1).any():
            return False
        self.known.add(hashes, heads[:-1] + 1, np.diff(heads) - 1, ids)
        return True

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """A null text has no ids."""
        data, offsets = text.text_bytes(texts if isinstance(texts, (pa.Array, pa.ChunkedArray)) else pa.array(texts, pa.large_string()))
        out: list[bytes] = []
        for a, b in text.pieces(offsets):
            out += self._encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        return out

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        if not len(data):
            return [b""] * (len(offsets) - 1)
        known = self.known
        if known.n_parts > MAX_PARTS or known.n_ids > MAX_IDS:
            known.clear()
        starts = cut_places(data, offsets)
        ends = np.append(starts[1:], len(data))
        hashes = text.word_hashes(data, starts, ends, self.table)
        parts = known.find(hashes)
        unseen = np.flatnonzero(parts < 0)
        if len(unseen):
            new, at = np.unique(hashes[unseen], return_index=True)
            at = unseen[at]
            self._learn(data, starts[at], ends[at], new)
            parts[unseen] = known.find(hashes[unseen])
        sizes = known.sizes[parts]
        raw = known.ids[laid(known.starts[parts], sizes)].tobytes()
        stops = np.concatenate(([0], np.cumsum(sizes)))
        rows = (stops[np.searchsorted(starts, offsets)] * self.width).tolist()
        out = [raw[i:j] for i, j in zip(rows[:-1], rows[1:])]
        # A special token inside a text is found before the text is split.
        whole = data.tobytes() if self.special else b""
        if any(x in whole for x in self.special):
            for i, (p, q) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                if any(x in whole[p:q] for x in self.special):
                    out[i] = self._ids(whole[p:q].decode()).tobytes()
        return out


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def worker_encoder(path: str, specials_as_text: bool = False) -> BpeEncoder:
    """The encoder of this worker process, which keeps its known parts from task to task."""
    kept = sys.modules.setdefault("_tidemark_encoders", types.ModuleType("_tidemark_encoders")).__dict__
    name = f"{path} {specials_as_text}"
    if name not in kept:
        kept[name] = BpeEncoder(path, specials_as_text)
    return kept[name]
