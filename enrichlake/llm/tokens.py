"""Byte-pair ids of whole texts, from a tokenizer file given by path."""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

#: Fixed value: how the byte-level tokenizer files cut a text before merging.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A piece longer than this is encoded by `tokenizers` itself and not remembered: the faster library overflows its
#: stack on very long runs of whitespace.
LONGEST_KEPT = 64
#: Pieces whose distinct ones are looked for at once.
BLOCK = 1 << 20
#: What `re` takes for whitespace: single bytes, and the longer characters as numbers of their two or three bytes.
SPACES = np.array([chr(b).isspace() and b < 128 for b in range(256)])
LONG_SPACES = [int.from_bytes(c.encode(), "big") for c in map(chr, range(0x80, 0x3001)) if c.isspace()]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    """Byte-level files write a byte as a visible character: itself if visible, else one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in visible}
    hidden = [b for b in range(256) if b not in set(visible)]
    return chars | {chr(256 + i): b for i, b in enumerate(hidden)}


def visible_spaces(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Marks the spaces in front of a visible character of the same text; texts begin at `starts` in UTF-8 `data`."""
    found = np.zeros(len(data), bool)
    if len(data) < 2:
        return found
    first = np.zeros(len(data) + 1, bool)
    first[starts] = True
    at = np.flatnonzero(data[:-1] == 32)
    at = at[~SPACES[data[at + 1]] & ~first[at + 1]]
    found[at] = True
    wide = at[data[at + 1] >= 128]
    padded = lambda k: np.where(wide + k < len(data), data[np.minimum(wide + k, len(data) - 1)], 0).astype(np.int64)
    two = padded(1) << 8 | padded(2)
    found[wide[np.isin(two, LONG_SPACES) | np.isin(two << 8 | padded(3), LONG_SPACES)]] = False
    return found


class ByteLevel(dict):
    """Ids of texts as little-endian unsigned 32-bit bytes.

    A space in front of a visible character always begins a new piece of the cut, so the pieces between such spaces
    are encoded one by one and remembered in two generations. `memory` bounds each; it has no part in the result.
    """

    def __init__(self, path: str, memory: int = 200_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = _byte_of_char()
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(chars[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}
        self.special = special
        self.at_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.memory = memory
        self.before: dict[str, bytes] = {}
        self.whole = Tokenizer.from_file(path)
        self.encoding = tiktoken.Encoding("byte-level", pat_str=CUT, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        self.width[list(ranks.values())] = [len(x) for x in ranks]

    def __missing__(self, piece: str) -> bytes:
        if len(piece) > LONGEST_KEPT:
            return array("I", self.whole.encode(piece, add_special_tokens=False).ids).tobytes()
        if len(self) >= self.memory:
            self.before = dict(self)
            self.clear()
        ids = self.before.get(piece) or array("I", self.encoding.encode_ordinary(piece)).tobytes()
        self[piece] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if self.at_special and any(x in text for x in self.special):
            return b"".join(
                array("I", [self.special[x]]).tobytes() if x in self.special else self.ids(x) for x in self.at_special.split(text) if x
            )
        head, *rest = re.split(r" (?=\S)", text)
        return self[head] + b"".join([self[" " + x] for x in rest])

    def many(self, texts: list[bytes]) -> list[bytes]:
        """What `ids` gives for each text; equal pieces of all texts are encoded once and nothing is remembered."""
        names = [x.encode() for x in self.special]
        odd = {i for i, t in enumerate(texts) if any(x in t for x in names)}
        ends = np.cumsum([0 if i in odd else len(t) for i, t in enumerate(texts)], dtype=np.int64)
        data = np.frombuffer(b"".join(t for i, t in enumerate(texts) if i not in odd), np.uint8)
        starts = np.concatenate([[0], ends])[:-1]
        begins = visible_spaces(data, starts)
        begins[starts[starts < ends]] = True
        bounds = np.append(np.flatnonzero(begins), len(data))
        del begins
        blocks = [self._block(data, bounds[k : k + BLOCK + 1]) for k in range(0, len(bounds) - 1, BLOCK)]
        upto = np.concatenate([[0], *(n for _, n in blocks)]).cumsum(dtype=np.int64)[np.searchsorted(bounds, ends)] * 4
        ids = b"".join(x.tobytes() for x, _ in blocks)
        sides = zip(np.concatenate([[0], upto])[:-1].tolist(), upto.tolist(), strict=True)
        return [self.ids(texts[i].decode()) if i in odd else ids[a:b] for i, (a, b) in enumerate(sides)]

    def _block(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces of `data` between `bounds`, behind each other, and their number per piece."""
        pieces = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        code, distinct = np.asarray(coded.indices), coded.dictionary
        at = np.frombuffer(distinct.buffers()[1], np.int64, len(distinct) + 1)
        held = np.frombuffer(distinct.buffers()[2], np.uint8, int(at[-1]))
        chars = np.diff(np.concatenate([[0], np.cumsum((held & 0xC0) != 0x80)])[at])
        # Those that begin at a visible space can stand behind each other, and the widths of the ids tell them apart.
        joined = visible_spaces(held, at[:-1])[at[:-1]] & (chars <= LONGEST_KEPT)
        text = held if joined.all() else held[np.repeat(joined, np.diff(at))]
        ids = self.encoding.encode_to_numpy(text.tobytes().decode(), disallowed_special=())
        first, n = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
        upto = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(np.diff(at)[joined])) + 1
        n[joined] = np.diff(upto, prepend=0)
        first[joined] = upto - n[joined]
        more, held_ids = [ids], len(ids)
        for i in np.flatnonzero(~joined).tolist():
            piece = distinct[i].as_py().decode()
            found = self.whole.encode(piece, add_special_tokens=False).ids if chars[i] > LONGEST_KEPT else self.encoding.encode_ordinary(piece)
            more.append(np.array(found, np.uint32))
            first[i], n[i] = held_ids, len(found)
            held_ids += len(found)
        each = n[code]
        behind = np.cumsum(each)
        return np.concatenate(more).astype("<u4")[np.repeat(first[code] - behind + each, each) + np.arange(behind[-1])], each


@lru_cache(maxsize=2)
def byte_level(path: str) -> ByteLevel:
    """One per worker process."""
    return ByteLevel(path)
