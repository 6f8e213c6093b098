"""64-bit hashes of words and word runs of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0xD1342543DE82EF95 | 5  # odd, so that it has an inverse modulo 2**64
_state: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits (two rounds of shift and multiply)."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def _tables(n: int) -> dict:
    if _state.get("n", 0) < n:
        n = max(n, 1 << 16)
        inverse = pow(BASE, -1, 1 << 64)
        up, down = np.full(n, U(BASE)), np.full(n, U(inverse))
        up[0] = down[0] = 1
        _state.update(n=n, up=np.multiply.accumulate(up), down=np.multiply.accumulate(down))
    if "space" not in _state:
        space = np.zeros(256, bool)
        space[[32, *range(9, 14)]] = True
        lower = np.arange(256)
        lower[65:91] += 32
        _state.update(space=space, code=mix(lower.astype(np.uint64) + U(1)))
    return _state


def parts(column, most: int = 2 << 20):
    """(first row, offsets, bytes) of runs of rows of about ``most`` bytes; a longer text is alone in its run."""
    import pyarrow as pa

    column = column.fill_null("").cast(pa.large_string()) if len(column) else column
    at = 0
    if not len(column):
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield at, ends[at:to + 1] - ends[at], data[ends[at]:ends[to]]
        at = to


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each word in order: runs of other bytes than ASCII white space, A-Z lower-cased."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    t = _tables(len(data))
    inside = ~t["space"][data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    first[cuts] = inside[cuts]
    starts = np.flatnonzero(first)
    last = inside
    last[:-1] &= ~inside[1:] | first[1:]
    ends = np.flatnonzero(last) + 1
    sums = np.cumsum(t["code"][data] * t["up"][:len(data)])
    before = np.where(starts > 0, sums[starts - 1], U(0))
    hashes = mix((sums[ends - 1] - before) * t["down"][starts] + (ends - starts).astype(np.uint64) * U(0x9E3779B97F4A7C15))
    return hashes, np.searchsorted(offsets, starts, "right") - 1


def runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` neighbours."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = out * U(0xA24BAED4963EE407) + hashes[i:i + n]
    return mix(out)


def shingles(column, width: int):
    """The sorted distinct shingle hashes of each row: runs of ``width`` words, all words as one if there are fewer."""
    for _, offsets, data in parts(column):
        hashes, row = words(offsets, data)
        bounds = np.searchsorted(row, np.arange(len(offsets)))
        all_runs = runs(hashes, width)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= width:
                own = all_runs[a:b - width + 1].copy()
                own.sort()
                keep = np.ones(len(own), bool)
                keep[1:] = own[1:] != own[:-1]
                yield own[keep]
            elif b > a:
                yield mix(runs(hashes[a:b], int(b - a)) + U(int(b - a)))
            else:
                yield hashes[:0]
