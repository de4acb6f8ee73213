"""Texts cut before blanks where no tokenizer here lets a token cross, so that each distinct piece is encoded once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pandas.util import hash_array


def blanks_to_cut(data: np.ndarray) -> np.ndarray:
    """Where UTF-8 bytes have a blank (0x20) right after a character that is surely no white space and not U+2581.

    Byte-level pre-tokenizers end a token before such a blank, and piece models without blanks inside pieces do as well. White
    space beyond ASCII lies in U+0085, U+00A0, U+1680, U+2000 to U+205F and U+3000: characters of two bytes from 0xC3 on, of three
    bytes that begin with 0xE0 or 0xE4 to 0xED, and of four bytes are none.
    """
    at = np.flatnonzero(data[1:] == 0x20) + 1
    before = data[at - 1]
    safe = (before > 0x20) & (before < 0x7F)
    odd = np.flatnonzero(before >= 0x80)
    places = at[odd]
    back = lambda n: np.where(places >= n, data[np.maximum(places - n, 0)], 0)
    two, three, four = back(2), back(3), back(4)
    good = (two >= 0xC3) & (two <= 0xDF)
    good |= (two & 0xC0 == 0x80) & ((three == 0xE0) | ((three >= 0xE4) & (three <= 0xED)))
    good |= (two & 0xC0 == 0x80) & (three & 0xC0 == 0x80) & (four >= 0xF0)
    safe[odd] = good
    return at[safe]


def buffers_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and bytes of a string array without nulls."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    held = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(held, np.uint8, int(offsets[-1] - offsets[0]), int(offsets[0])) if held is not None and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    return offsets - offsets[0], data


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The pieces of all texts in order, and the number of pieces of each; an empty text is one empty piece."""
    offsets, data = buffers_of(texts)
    first = np.zeros(len(data) + 1, bool)
    first[blanks_to_cut(data)] = True
    first[offsets] = False
    at = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(at, offsets)) + 1
    starts = np.empty(len(at) + len(texts), np.int64)
    heads = np.zeros(len(starts), bool)
    heads[np.cumsum(counts) - counts] = True
    starts[heads], starts[~heads] = offsets[:-1], at
    edges = np.append(starts, offsets[-1]).astype(np.int64)
    found = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(edges.tobytes()), pa.py_buffer(data.tobytes())])
    return found, counts


def ends_safely(pieces: pa.Array) -> np.ndarray:
    """Whether a blank may follow each piece as a cut."""
    offsets, data = buffers_of(pieces)
    with_blank = np.full(len(data) + len(pieces), 0x20, np.uint8)  # each piece followed by a blank
    place = np.arange(len(data)) + np.repeat(np.arange(len(pieces)), np.diff(offsets))
    with_blank[place] = data
    blanks = offsets[1:] + np.arange(len(pieces))
    cuts = np.zeros(len(with_blank), bool)
    cuts[blanks_to_cut(with_blank)] = True
    return cuts[blanks] & (np.diff(offsets) > 0)


def expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of consecutive runs: for each (start, size) start, start + 1, ..."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(total)


def ids_of_joined(encode, pieces: list[str], sizes: np.ndarray, lengths: np.ndarray, at_once: int = 500) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces that may follow each other, encoded ``at_once`` together: all ids and the number of each piece's.

    ``encode`` takes a list of texts, ``sizes`` are the pieces' bytes and ``lengths`` the bytes of each id.
    """
    runs = encode(["".join(pieces[i : i + at_once]) for i in range(0, len(pieces), at_once)])
    ids = np.concatenate([np.array(r, np.uint32) for r in runs]) if runs else np.empty(0, np.uint32)
    ends, cuts = np.cumsum(lengths[ids]), np.cumsum(sizes)
    where = np.searchsorted(ends, cuts)
    if len(cuts) and not np.array_equal(ends[np.minimum(where, len(ends) - 1)], cuts):
        raise ValueError("a token crosses a cut")
    return ids, np.diff(np.concatenate([[0], where + 1]))


def merge_parts(chosen: np.ndarray, first: tuple[np.ndarray, np.ndarray], second: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and counts of all pieces from those of the chosen ones and of the others."""
    counts = np.zeros(len(chosen), np.int64)
    counts[chosen], counts[~chosen] = first[1], second[1]
    out = np.empty(int(counts.sum()), np.uint32)
    starts = np.cumsum(counts) - counts
    out[expand(starts[chosen], counts[chosen])] = first[0]
    out[expand(starts[~chosen], counts[~chosen])] = second[0]
    return out, counts


def flat_ids(listed: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([len(x) for x in listed], np.int64)
    return np.fromiter((i for x in listed for i in x), np.uint32, int(counts.sum())), counts


class Memory:
    """Ids of the first ``limit`` distinct pieces, frequent ones among them, so that later batches do not encode them again.

    A piece is known by two independent 64-bit hashes, about 30 bytes with its ids.
    """

    def __init__(self, limit: int):
        self.limit = limit
        self.keys, self.checks = np.empty(0, np.uint64), np.empty(0, np.uint64)  # ascending keys
        self.starts, self.counts = np.empty(0, np.int64), np.empty(0, np.int32)
        self.flat, self.size = np.empty(1 << 16, np.uint32), 0

    def ids(self, distinct: pa.Array, encode) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the distinct pieces; ``encode`` gives those of the ones that are not held yet."""
        values = distinct.to_numpy(zero_copy_only=False)
        keys, checks = (hash_array(values, hash_key=k, categorize=False) for k in ("firmlake-pieces1", "firmlake-pieces2"))
        order = np.argsort(keys)  # ascending needles are found faster
        at = np.empty(len(keys), np.int64)
        at[order] = np.searchsorted(self.keys, keys[order])
        held = np.zeros(len(keys), bool)
        inside = np.flatnonzero(at < len(self.keys))
        held[inside] = (self.keys[at[inside]] == keys[inside]) & (self.checks[at[inside]] == checks[inside])
        if held.all():
            new = np.empty(0, np.uint32), np.empty(0, np.int64)
        else:
            new = encode(distinct.filter(pa.array(~held)))
        known = at[held]
        counts = self.counts[known].astype(np.int64)
        out = merge_parts(held, (self.flat[expand(self.starts[known], counts)], counts), new)
        self._keep(keys[~held], checks[~held], *new)
        return out

    def _keep(self, keys: np.ndarray, checks: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        n = min(len(keys), self.limit - len(self.keys))
        if n <= 0:
            return
        starts, total = np.cumsum(counts) - counts, int(counts[:n].sum())
        if self.size + total > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.size], np.empty(total + len(self.flat), np.uint32)])
        self.flat[self.size : self.size + total] = ids[:total]
        every = np.concatenate([self.keys, keys[:n]])
        order = np.argsort(every, kind="stable")
        self.keys = every[order]
        self.checks = np.concatenate([self.checks, checks[:n]])[order]
        self.starts = np.concatenate([self.starts, self.size + starts[:n]])[order]
        self.counts = np.concatenate([self.counts, counts[:n].astype(np.int32)])[order]
        self.size += total
