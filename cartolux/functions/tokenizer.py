"""A quote-aware tokenizer of delimited records as a finite-state machine over many records at once.

States: START of a field, PLAIN, QUOTED, CLOSED (a quote inside a quoted field: it ends it or is
the first of a doubled one), ERROR. The records of a batch lie in one buffer, cut into chunks. Every
chunk is first reduced to its state transition (where each of the states leads), all chunks side by
side; the transitions are composed along the buffer; with its entry state known, each chunk is then
read once more for the real states. Records and chunks need not line up, so one record may be as
long as the buffer.
"""

from __future__ import annotations

import numpy as np

START, PLAIN, QUOTED, CLOSED, ERROR = range(5)
OTHER, QUOTE, TAB, END = range(4)
#: NEXT[class, state]
NEXT = np.array([
    [PLAIN, PLAIN, QUOTED, ERROR, ERROR],
    [QUOTED, ERROR, CLOSED, QUOTED, ERROR],
    [START, START, QUOTED, START, ERROR],
    [START, START, START, START, START],
], dtype=np.uint8)
CHUNK = 256


def classes(buffer: bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[ord('"')], table[ord("\t")], table[ord("\n")] = QUOTE, TAB, END
    return table[np.frombuffer(buffer, np.uint8)]


def states(kinds: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
    """The state before each byte, and after the last."""
    n = len(kinds)
    rows = -(-n // chunk) or 1
    padded = np.full(rows * chunk, END, np.uint8)
    padded[:n] = kinds
    grid = np.ascontiguousarray(padded.reshape(rows, chunk).T)
    leads = np.tile(np.arange(5, dtype=np.uint8), (rows, 1))
    for column in grid:
        leads = NEXT[column[:, None], leads]
    entry = np.empty(rows, np.uint8)
    state = START
    for i, lead in enumerate(leads.tolist()):
        entry[i] = state
        state = lead[state]
    out = np.empty((chunk, rows), np.uint8)
    now = entry
    for i, column in enumerate(grid):
        out[i] = now
        now = NEXT[column, now]
    flat = np.empty(rows * chunk + 1, np.uint8)
    flat[:-1] = out.T.ravel()
    flat[-1] = now[-1]
    return flat[: n + 1]


def tokenize(lines: list[str]) -> tuple[list[list[str] | None], list[int]]:
    """Fields of each record, unquoted, or None; and the offset in characters of the first place at
    which its quoting breaks (its length if a quoted field stays open), or -1. A line feed inside a
    record is content, so it is masked before the records are joined."""
    raw = [x.encode("utf-8", "surrogatepass") for x in lines]
    buffer = b"\n".join(x.replace(b"\n", b" ") if b"\n" in x else x for x in raw) + b"\n"
    kinds = classes(buffer)
    before = states(kinds)[:-1]
    ends = np.flatnonzero(kinds == END)
    starts = np.concatenate([[0], ends[:-1] + 1])
    at_end = before[ends]
    turns = np.flatnonzero((before[1:] == ERROR) & (before[:-1] != ERROR))
    first = np.searchsorted(turns, starts)
    tabs = np.flatnonzero((kinds == TAB) & (before != QUOTED) & (before != ERROR))
    tab_from, tab_to = np.searchsorted(tabs, starts), np.searchsorted(tabs, ends)
    quoted = np.add.reduceat(kinds == QUOTE, starts) > 0 if len(starts) else []
    fields: list[list[str] | None] = []
    offsets: list[int] = []
    for i, line in enumerate(lines):
        if at_end[i] == ERROR:
            fields.append(None)
            offsets.append(len(raw[i][: turns[first[i]] - starts[i]].decode("utf-8", "replace")))
        elif at_end[i] == QUOTED:
            fields.append(None)
            offsets.append(len(line))
        elif not quoted[i]:
            fields.append(line.split("\t"))
            offsets.append(-1)
        else:
            cuts = [-1, *(tabs[tab_from[i] : tab_to[i]] - starts[i]).tolist(), len(raw[i])]
            parts = [raw[i][a + 1 : b] for a, b in zip(cuts, cuts[1:])]
            fields.append([(p[1:-1].replace(b'""', b'"') if p[:1] == b'"' else p).decode("utf-8", "surrogatepass") for p in parts])
            offsets.append(-1)
    return fields, offsets
