"""Whole-text tokenization with a cache of space-delimited chunks.

A byte-level or word BPE never merges across the border between a word and the
white space after it, so a text's ids are the joined ids of its chunks. Words
repeat far more often than texts, so each task encodes a chunk once with the
tokenizers library and afterwards gathers its ids with numpy. Byte-level texts are
cut in Arrow's buffer and their chunks numbered by Arrow, so that Python handles a
chunk once for each call; new chunks are encoded many at a time.
"""

from __future__ import annotations

import gc
import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Chunks a worker remembers; beyond it the cache starts anew (ids don't change).
CACHE_CHUNKS = 1_500_000

#: New chunks joined to one text for the library.
JOINED = 500

_OTHER_SPACE = re.compile(r"[^\S \n]")
#: A chunk of one blank and no other white space.
_PLAIN = re.compile(r" [^ \n]+")
#: Bytes by their value: all that may start other white space in UTF-8, and ASCII letters.
_MAY_SPACE, _LETTER = np.zeros(256, bool), np.zeros(256, bool)
_MAY_SPACE[[9, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_LETTER[65:91] = _LETTER[97:123] = True
#: Letters below this code point have one-to-one case and a fixed class.
_LATIN_END = "\u0250"
_LOADED: dict[tuple[str, bool, int], "ChunkTokenizer"] = {}


class _Index(dict):
    """Chunk -> number; an unknown chunk gets the next number and is noted."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = len(self)
        self.new.append(chunk)
        return n


class ChunkTokenizer:
    """``path``: a tokenizers file. ``drops_space``: the tokenizer lower-cases and
    discards white space (word BPE); otherwise white space is kept and goes with
    the next word, and a comma or full stop after an ASCII letter starts a chunk, as
    it starts a piece of the tokenizer. Without ``drops_space``, texts with white
    space other than blanks and line feeds are encoded whole, since such runs may
    cross a chunk's border."""

    def __init__(self, path: str, drops_space: bool, cache_chunks: int = CACHE_CHUNKS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.drops_space = drops_space
        self.cache_chunks = cache_chunks
        #: Whether an id's token starts with a blank (byte-level tokenizers write it so).
        vocab = self.encoder.get_vocab()
        self.blank_first = np.zeros(max(vocab.values()) + 1, bool)
        self.blank_first[[i for token, i in vocab.items() if token.startswith("\u0120")]] = True
        self._reset()

    def _reset(self) -> None:
        self.index = _Index()
        self.starts = np.zeros(4096, np.int64)
        self.lengths = np.zeros(4096, np.int64)
        self.flat = np.zeros(16384, np.uint32)
        self.known = self.used = 0

    def _parts(self, chunk: str) -> tuple[str, ...]:
        """Chunks that have the same ids together: a Latin word's final comma or
        full stop is a piece of its own, and case is dropped."""
        if not chunk or max(chunk) >= _LATIN_END:
            return (chunk,)
        word, last = chunk[:-1], chunk[-1]
        cut = last in ",." and word.lstrip(" \n").isalpha()
        return (word.lower(), last) if cut else (chunk.lower(),)

    def _learn(self) -> None:
        """Ids of the chunks that were noted, in the order of their numbers."""
        index, todo = self.index, []
        if not self.drops_space:
            self._store(self._encode_joined(index.new))
            return
        parts = []
        at = 0
        while at < len(index.new):  # grows by the parts
            chunk = index.new[at]
            own = self._parts(chunk)
            parts.append(None if own == (chunk,) else [index[p] for p in own])
            if parts[-1] is None:
                todo.append(chunk)
            at += 1
        ids = (x.ids for x in self.encoder.encode_batch_fast(todo, add_special_tokens=False))
        done = [next(ids) if p is None else None for p in parts]
        first = self.known
        for i, p in enumerate(parts):
            if p is not None:
                done[i] = [x for n in p for x in (done[n - first] if n >= first else self._ids(n))]
        self._store(done)

    def _encode_joined(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk. Plain chunks are joined and cut again where a token starts
        with a blank, unless that doesn't give one such token for each."""
        run = lambda texts: [x.ids for x in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]
        done: list = [None] * len(chunks)
        plain = [i for i, c in enumerate(chunks) if _PLAIN.fullmatch(c)]
        groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        for own, ids in zip(groups, run(["".join([chunks[i] for i in g]) for g in groups]), strict=True):
            cuts = np.flatnonzero(self.blank_first[ids]).tolist()
            if len(cuts) == len(own) and cuts[0] == 0:
                for i, low, high in zip(own, cuts, [*cuts[1:], len(ids)], strict=True):
                    done[i] = ids[low:high]
        rest = [i for i, ids in enumerate(done) if ids is None]
        for i, ids in zip(rest, run([chunks[i] for i in rest]), strict=True):
            done[i] = ids
        return done

    def _store(self, done: list[list[int]]) -> None:
        first = self.known
        lengths = np.fromiter(map(len, done), np.int64, len(done))
        n, total = len(done), int(lengths.sum())
        if first + n > len(self.starts):
            self.starts = np.resize(self.starts, 2 * (first + n))
            self.lengths = np.resize(self.lengths, 2 * (first + n))
        if self.used + total > len(self.flat):
            self.flat = np.resize(self.flat, 2 * (self.used + total))
        self.starts[first : first + n] = self.used + np.cumsum(lengths) - lengths
        self.lengths[first : first + n] = lengths
        self.flat[self.used : self.used + total] = list(itertools.chain.from_iterable(done))
        self.used += total
        self.known += n
        self.index.new = []

    def _ids(self, n: int) -> list[int]:
        return self.flat[self.starts[n] : self.starts[n] + self.lengths[n]].tolist()

    def _words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of every chunk, chunks of each text) with ``drops_space``."""
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        return np.fromiter(map(self.index.__getitem__, itertools.chain.from_iterable(parts)), np.int64, int(counts.sum())), counts

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, dict[int, str]]:
        """(number of every chunk, chunks of each text, texts to be encoded whole)."""
        data, ends = _bytes_of(texts)
        odd = np.unique(np.searchsorted(ends, np.flatnonzero(_MAY_SPACE[data]), side="right") - 1)
        whole = {i: t for i in odd.tolist() if _OTHER_SPACE.search(t := texts[i].as_py())}
        if whole:
            data, ends = _bytes_of(pc.if_else(np.isin(np.arange(len(texts)), list(whole)), "", texts))
        blank = (data == 32) | (data == 10)
        first = np.zeros(len(data) + 1, bool)
        first[1:-1] = (blank[1:] & ~blank[:-1]) | (((data[1:] == 44) | (data[1:] == 46)) & _LETTER[data[:-1]])
        first[ends] = True
        starts = np.flatnonzero(first)
        chunks = pa.LargeStringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts.astype("<i8")), pa.py_buffer(data))
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        numbers = np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))
        return numbers[coded.indices.to_numpy()], np.diff(np.searchsorted(starts, ends)), whole

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts joined, number of ids of each text)."""
        if len(self.index) > self.cache_chunks:
            self._reset()
        whole = {}
        if self.drops_space:
            at, counts = self._words(texts)
        else:
            own = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
            at, counts, whole = self._pieces(own.cast(pa.large_string()))
        if self.index.new:
            collecting = gc.isenabled()
            gc.disable()  # many small lists, none of them in cycles
            try:
                self._learn()
            finally:
                if collecting:
                    gc.enable()
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[at] - (ends - lengths), lengths) + np.arange(total)]
        borders = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        sizes = np.diff(borders)
        if whole:
            pieces = np.split(ids, borders[1:-1]) if len(texts) > 1 else [ids]
            for i, t in whole.items():
                pieces[i] = np.array(self.encoder.encode(t, add_special_tokens=False).ids, np.uint32)
            ids = np.concatenate(pieces).astype(np.uint32)
            sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        return ids, sizes


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, where each starts and the last ends)."""
    _, places, data = texts.buffers()
    ends = np.frombuffer(places, "<i8", len(texts) + 1, 8 * texts.offset)
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def tokenizer(path: str, drops_space: bool, cache_chunks: int = CACHE_CHUNKS) -> ChunkTokenizer:
    """The worker's own tokenizer for ``path``; kept between tasks."""
    key = (path, drops_space, cache_chunks)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ChunkTokenizer(path, drops_space, cache_chunks)
    return _LOADED[key]


def forget() -> None:
    """Frees a tokenizer that an earlier task left in this worker; operators that
    need the memory for something else call it."""
    _LOADED.clear()
