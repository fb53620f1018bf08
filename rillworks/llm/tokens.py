"""Public tokenizers inside tasks, with a memo of whitespace-bounded pieces.

Both tokenizers split at white space before anything else, so a text's ids are
those of its pieces, one after the other. The memo only saves time and is bounded.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rillworks.llm.text import _LOWER, Texts

#: Entries of a memo; about 100 bytes each.
MEMO = 350_000
#: Pieces that are encoded at once.
_ENCODED = 20_000
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \n\t\r")] = True
_LETTER = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
_OTHER = ~_LETTER & (np.arange(256) < 128)
_SPECIAL = b"<|"

_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
_encoders: dict = {}


def tokenizer_file(name: str) -> str:
    """A path as given, or the place of a named public vocabulary."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return str(public_tokenizers.path(name))


class _Memo:
    """Ids of pieces met before; when it is full, the half met longest ago goes."""

    def __init__(self, name: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file(name))
        self.pieces = pa.array([], pa.large_binary())
        self.size = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)
        self.met = np.zeros(0, np.int32)
        self.now = 0

    def look_up(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(first, size, ids)``: piece ``i`` has ``size[i]`` ids from ``first[i]``."""
        self.now += 1
        at = pc.index_in(pieces, self.pieces).fill_null(-1).to_numpy(zero_copy_only=False).copy()
        new = np.flatnonzero(at < 0)
        if len(new):
            missing = pieces.take(pa.array(new))
            lists = []
            for k in range(0, len(missing), _ENCODED):
                some = missing.slice(k, _ENCODED).cast(pa.large_string()).to_pylist()
                lists += [out.ids for out in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            at[new] = len(self.pieces) + np.arange(len(new))
            self.pieces = pa.concat_arrays([self.pieces, missing])
            self.size = np.append(self.size, np.fromiter(map(len, lists), np.int32, len(lists)))
            self.ids = np.append(self.ids, np.fromiter(chain.from_iterable(lists), np.uint32))
            self.met = np.append(self.met, np.zeros(len(new), np.int32))
        self.met[at] = self.now
        first = np.cumsum(self.size) - self.size
        found = first[at], self.size[at], self.ids
        if len(self.pieces) > MEMO:
            self._forget(first)
        return found

    def _forget(self, first: np.ndarray) -> None:
        kept = np.sort(np.argsort(self.met, kind="stable")[-(MEMO // 2) :])
        self.ids = self.ids[_spread(first[kept], self.size[kept])]
        self.pieces, self.size, self.met = self.pieces.take(pa.array(kept)), self.size[kept], self.met[kept]


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``first[i]``, ``first[i] + 1`` and on, ``size[i]`` of them, one after the other."""
    upto = np.cumsum(size)
    return np.arange(int(upto[-1]) if len(upto) else 0) + np.repeat(first - upto + size, size)


def word_ids(texts: Texts, name: str) -> tuple[np.ndarray, np.ndarray]:
    """``(at, ids)`` by the lower-casing word vocabulary: text ``i`` has ``ids[at[i]:at[i + 1]]``.

    Its rules end a piece at every blank and after every letter that is followed by
    something else, and give ``A`` the ids of ``a``. So texts are cut there (between
    ASCII bytes), pieces are told apart by Arrow, each distinct one is encoded once, and
    the ids of all are put together by place. A special token in a text is ordinary to
    none of these rules; texts with its first signs are cut at blanks only.
    """
    key = ("word", name)
    if key not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[key] = _Memo(name)
    data = texts.data
    inside = ~_BLANK[data]
    edge = np.zeros(len(inside) + 1, bool)
    edge[texts.at] = True
    first = inside.copy()
    first[1:] &= edge[1:-1] | ~inside[:-1]
    if _SPECIAL not in data.tobytes():
        first[1:] |= inside[1:] & _LETTER[data[:-1]] & _OTHER[data[1:]]
        data = _LOWER[data]
    start = np.flatnonzero(first)
    if not len(start):
        return np.zeros(len(texts.at), np.int64), np.zeros(0, np.uint32)
    upto = np.zeros(len(start) + 1, np.int64)
    np.cumsum(np.add.reduceat(inside, start, dtype=np.int64), out=upto[1:])
    body = pa.py_buffer(data[inside])
    pieces = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(upto), body])
    coded = pieces.dictionary_encode()
    begin, size, known = _encoders[key].look_up(coded.dictionary)
    number = coded.indices.to_numpy(zero_copy_only=False)
    count = size[number]
    total = np.append(0, np.cumsum(count))
    return total[np.searchsorted(start, texts.at)], known[_spread(begin[number], count)]


def rank_length(name: str) -> Callable[[str], int]:
    """Text to its number of ids by a rank file; special tokens count as ordinary text."""
    key = ("rank", name)
    if key not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(tokenizer_file(name), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        memo: dict[str, int] = {}

        def length(text: str) -> int:
            pieces = _BEFORE_SPACE.split(text)
            try:
                return sum(map(memo.__getitem__, pieces))
            except KeyError:
                pass
            if len(memo) > MEMO:
                memo.clear()
            for piece in set(pieces).difference(memo):
                memo[piece] = len(encoding.encode_ordinary(piece))
            return sum(map(memo.__getitem__, pieces))

        _encoders[key] = length
    return _encoders[key]
