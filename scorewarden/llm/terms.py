"""Terms of texts in Arrow batches: maximal runs of chosen bytes, A-Z lower-cased, counted per text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from scorewarden.llm.common import chunks, ranges


def term_bytes(*, digits: bool) -> np.ndarray:
    """Which bytes belong to a term: ASCII letters, everything outside ASCII, and digits if asked for."""
    table = np.zeros(256, bool)
    table[128:] = True
    table[65:91] = table[97:123] = True
    table[48:58] = digits
    return table


def _terms(data: np.ndarray, edges: np.ndarray, table: np.ndarray):
    """(text of each term, its code, the distinct terms) of the texts that ``edges`` cut ``data`` into."""
    import pyarrow as pa
    inside = table[data]
    new = np.ones(len(data) + 1, bool)
    if len(data):
        new[1:-1] = inside[1:] != inside[:-1]
    new[edges] = True
    cuts = np.flatnonzero(new)
    starts, ends = cuts[:-1], cuts[1:]
    keep = inside[starts] if len(starts) else np.zeros(0, bool)
    starts, ends = starts[keep], ends[keep]
    upper = (data >= 65) & (data <= 90)
    letters = (data + upper.astype(np.uint8) * np.uint8(32))[inside]
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)]).dictionary_encode()
    return np.searchsorted(edges, starts, "right") - 1, found.indices.to_numpy().astype(np.int64), found.dictionary


def _pieces(data: np.ndarray, table: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A long text in pieces of about ``limit`` bytes, cut where no term is cut."""
    at = 0
    while at < len(data):
        stop, width = at + limit, limit
        while stop < len(data):
            outside = np.flatnonzero(~table[data[max(at, stop - width): stop]])
            if len(outside):
                stop = max(at, stop - width) + int(outside[-1]) + 1
                break
            stop += width
        yield data[at:stop]
        at = stop


def _long_text(data: np.ndarray, table: np.ndarray, limit: int):
    """(code, count, terms) of one long text; memory follows its distinct terms."""
    import pyarrow as pa
    names, counts = [], []
    for piece in _pieces(data, table, limit):
        _, code, terms = _terms(piece, np.array([0, len(piece)]), table)
        names.append(terms)
        counts.append(np.bincount(code, minlength=len(terms)))
    both = pa.concat_arrays(names).dictionary_encode()
    total = np.bincount(both.indices.to_numpy(), np.concatenate(counts), minlength=len(both.dictionary)).astype(np.int64)
    return np.arange(len(total)), total, both.dictionary


def term_counts(texts, table: np.ndarray, limit: int = 1 << 20):
    """Yield (row, code, count, terms) for whole texts at a time: one entry per row and term, sorted by row.

    ``terms`` holds the distinct terms of that part as bytes, which the codes point into; nulls have none.
    """
    data, at = ranges(texts)
    for start, stop in chunks(at, limit):
        part = data[at[start]: at[stop]]
        if not len(part):
            continue
        if len(part) > 2 * limit:
            code, count, terms = _long_text(part, table, limit)
            row = np.zeros(len(code), np.int64)
            # chunks() gives a long text a range of its own, but empty texts may stand beside it
            row += int(np.argmax(np.diff(at[start: stop + 1])))
        else:
            doc, code, terms = _terms(part, at[start: stop + 1] - at[start], table)
            cells, count = np.unique(doc * max(1, len(terms)) + code, return_counts=True)
            row, code = np.divmod(cells, max(1, len(terms)))
        yield row + start, code, count, terms
