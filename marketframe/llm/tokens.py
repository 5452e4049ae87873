"""Token ids of whole texts by a public byte-level BPE file (``tokenizers``).

Encoding a text equals encoding its chunks if it is cut where the tokenizer's own
pre-tokenizer always starts a new piece: before a space that is followed by a character other
than white space, between an ASCII letter and ``.,;:!?`` or a line feed, and between a line feed behind one of these and
an ASCII letter. A batch of texts is cut and its chunks are numbered by column (NumPy on
the UTF-8 bytes, an Arrow dictionary), each distinct chunk is encoded once
per worker (a bounded cache), and the ids are put together by one ragged take,
so no Python object is made per word. All ids come from the tokenizer as its
file has it; texts that hold one of its added tokens are encoded whole, as such
a token may reach over a cut.
"""

from __future__ import annotations

import os
from itertools import repeat

import numpy as np
import pyarrow as pa

#: Appended to each document (fixed by the task).
END_ID = 2
_JOIN = 512
_ENCODERS: dict[str, "Encoder"] = {}


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_LETTER = _table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_MARK = _table(b".,;:!?\n")
#: Bytes after a space that are or may begin white space (U+0085 and U+00A0 begin with C2, others with E1 to E3).
_MAYBE_SPACE = _table(bytes([*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]))


def cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where chunks begin in the bytes of texts, one after the other, that begin at ``starts``."""
    begin = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        left, right, letter = data[:-1], data[1:], _LETTER[data]
        begin[1:-1] = letter[:-1] & _MARK[right]
        begin[2:-1] |= (left[1:] == 10) & letter[2:] & (letter[:-2] | (_MARK[data[:-2]] & (data[:-2] != 10)))
        begin[:-2] |= (left == 32) & ~_MAYBE_SPACE[right]
        # a space at a text's end has the next text's bytes behind it
        last = starts[(starts > 0) & (starts < len(data))] - 1
        begin[last] &= data[last] != 32
    begin[starts] = True
    return np.flatnonzero(begin[:len(data)])


def default_tokenizer() -> str:
    """Path of the 50k byte-level BPE file that ships with ``public_tokenizers``."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def ragged_take(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Slices ``pool[start:start + size]`` one after the other."""
    ends = np.cumsum(sizes)
    at = np.repeat(starts - (ends - sizes), sizes)
    at += np.arange(len(at))
    return pool[at]


class Chunks:
    """Ids of the chunks seen so far: chunk -> number, and a slice of ``pool`` for each number."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.pool = np.zeros(1 << 16, "<u4")
        self.starts = np.zeros(1 << 14, np.int64)
        self.sizes = np.zeros(1 << 14, np.int64)
        self.used = 0

    def add(self, chunks: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, m = len(self.number), len(chunks)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while n + m > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.sizes))
        self.pool[self.used:self.used + len(ids)] = ids
        self.starts[n:n + m] = self.used + np.cumsum(sizes) - sizes
        self.sizes[n:n + m] = sizes
        self.used += len(ids)
        self.number.update(zip(chunks, range(n, n + m)))


class Encoder:
    def __init__(self, path: str, cache: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        size = self.tok.get_vocab_size()
        # byte 0x20 is written as U+0120 in this vocabulary
        self.starts = np.array([(self.tok.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        self.limit = cache
        self.chunks = Chunks()

    def _raw(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in self.tok.encode_batch(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[bytes]) -> None:
        """Ids of new chunks; many that begin with their only space are encoded in one string
        and told apart by the tokens that start with a space."""
        joined, other = [], []
        for c in chunks:
            (joined if c[:1] == b" " and c.count(b" ") == 1 else other).append(c)
        groups = [joined[i:i + _JOIN] for i in range(0, len(joined), _JOIN)]
        for group, ids in zip(groups, self._raw([b"".join(g).decode() for g in groups])):
            at = np.flatnonzero(self.starts[ids])
            if len(at) == len(group):
                self.chunks.add(group, ids, np.diff(np.append(at, len(ids))))
            else:
                other += group
        if other:
            ids = self._raw([c.decode() for c in other])
            self.chunks.add(other, np.concatenate(ids), np.array([len(x) for x in ids]))

    def _by_chunks(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, tokens of each text) of texts that are not empty."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        raw = b"".join(texts)
        starts = np.cumsum(sizes) - sizes
        begin = cuts(np.frombuffer(raw, np.uint8), starts)
        offsets = np.append(begin, len(raw)).astype(np.int64)
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]
                                                 ).dictionary_encode()
        names = coded.dictionary.to_pylist()
        if len(self.chunks.number) > self.limit or self.chunks.used > self.limit * 16:
            self.chunks = Chunks()
        known = np.fromiter(map(self.chunks.number.get, names, repeat(-1)), np.int64, len(names))
        missing = np.flatnonzero(known < 0)
        new = [names[i] for i in missing.tolist()]
        self._learn(new)
        known[missing] = np.fromiter(map(self.chunks.number.__getitem__, new), np.int64, len(new))
        which = known[coded.indices.to_numpy()]
        n = self.chunks.sizes[which]
        first = np.searchsorted(begin, starts)  # each text's first chunk
        return ragged_take(self.chunks.pool, self.chunks.starts[which], n), np.add.reduceat(n, first)

    def columns(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after the other; number of ids of each text)."""
        whole = [i for i, t in enumerate(texts) if any(a in t for a in self.added)]
        held = set(whole)
        cut = [i for i, t in enumerate(texts) if t and i not in held]
        got, sizes = [], np.zeros(len(texts), np.int64)
        if cut:
            ids, sizes[cut] = self._by_chunks([texts[i].encode() for i in cut])
            got.append(ids)
        if whole:
            ids = self._raw([texts[i] for i in whole])
            sizes[whole] = [len(x) for x in ids]
            got.extend(ids)
        ids = np.concatenate(got) if got else np.zeros(0, "<u4")
        if whole:  # back into the order of the texts
            order = np.array(cut + whole)
            starts = np.zeros(len(texts), np.int64)
            starts[order] = np.cumsum(sizes[order]) - sizes[order]
            ids = ragged_take(ids, starts, sizes)
        return ids, sizes

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        ids, sizes = self.columns(texts)
        raw, ends = ids.astype("<u4", copy=False).tobytes(), (4 * np.cumsum(sizes)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def text_batches(frame, text_col: str, max_chars: int = 4_000_000):
    """(first, last) row ranges of a pandas frame with about ``max_chars``
    characters each, so that the size of a batch follows the texts."""
    lengths = [len(t) if isinstance(t, str) else 0 for t in frame[text_col]]
    first, total = 0, 0
    for i, n in enumerate(lengths):
        total += n
        if total >= max_chars:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(lengths):
        yield first, len(lengths)


def release() -> None:
    """Drops the encoders of this worker and gives their memory back, before a stage that needs none."""
    _ENCODERS.clear()
    pa.default_memory_pool().release_unused()
