"""An adaptive context-mixing range coder for token ids, vectorised over the lanes of a block.

A block is cut into equal lanes that are coded in step and share one model. The model learns only from ids that the
decoder knows as well, at steps that lie ever further apart. It mixes three predictions of the next id, each a whole
distribution over columns: one for each of the most frequent ids so far, and one for all others together.

* order 0: the shares of all ids so far;
* order 1: the shares of what followed the last id, for each column;
* order 2: the shares of what followed the last two ids, for the most frequent pairs of columns.

Order 1 is mixed with order 0, and order 2 with that mixture. The weights are learnt for each class of how often the
context was seen, by expectation maximisation over the counts, each occurrence judged by the others. An id that has no
column is then told by its frequency among these. The mixture drives one 64-bit range coder a lane; carries are added to
the words at the end. A block starts from an empty model and carries checksums, so each block can be decoded alone and
damage is noticed. Floating-point numbers are only added, multiplied and divided one by one, in one order, so every
machine gets the same model.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"PWB3"
HEAD = struct.Struct("<4sIIIII")
LANES = 8192
#: Ids in a block, at most.
BLOCK = 1 << 22
#: Columns (and order-1 rows), order-2 rows, a row's total.
COLUMNS, PAIRS, TOTAL_BITS = 512, 384, 13
TOTAL = 1 << TOTAL_BITS
#: The steps at which the model learns, and the rounds in which it finds its weights.
LEARNS, ROUNDS = (1, 4, 16, 60, 200), 3
U = np.uint64
_48, _32, _16, _ROW = U(48), U(1 << 32), U(16), U(TOTAL_BITS)


def _mixed(pairs: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Each row's shares of its counts, mixed with its row of base by a weight for the class of its count."""
    n = pairs.sum(axis=1)
    kind = np.frexp(n.astype(np.float64))[1]
    row, col = np.nonzero(pairs)
    c = pairs[row, col].astype(np.float64)
    others, k = (c - 1) / np.maximum(n[row] - 1, 1), kind[row]
    below = base[row if len(base) > 1 else 0, col]
    whole, weight = np.maximum(np.bincount(k, c, 64), 1.0), np.full(64, 0.5)
    for _ in range(ROUNDS):
        part = weight[k] * others
        weight = np.minimum(np.bincount(k, c * (part / (part + (1 - weight[k]) * below)), 64) / whole, 0.999)
    share = np.where(n > 1, weight[kind], 0.0)[:, None]
    return pairs * (share / np.maximum(n, 1)[:, None]) + (1 - share) * base


class Model:
    """What encoder and decoder learn alike."""

    def __init__(self, vocab: int, finds: bool):
        self.vocab, self.finds = vocab, finds
        self.column = np.full(vocab, COLUMNS - 1, np.uint16)
        self.ids = np.zeros(COLUMNS, np.uint32)
        self.row = np.tile(np.arange(COLUMNS, dtype=np.uint16), COLUMNS)  # of (id before the last, last id), in columns
        freq = np.ones((COLUMNS, COLUMNS), np.uint32)
        freq[:, -1] = TOTAL - COLUMNS + 1
        self._rows(freq)
        self._rare(np.zeros(vocab, np.int64))

    def _rows(self, freq: np.ndarray) -> None:
        start = np.cumsum(freq, axis=1, dtype=np.uint32) - freq
        self.cells = (start | freq << np.uint32(16)).reshape(-1)
        if self.finds:
            self.places = np.repeat(np.tile(np.arange(COLUMNS, dtype=np.uint16), len(freq)), freq.reshape(-1))

    def _rare(self, counts: np.ndarray) -> None:
        """The distribution of the ids without a column."""
        self.cum = np.concatenate([[0], np.cumsum((32 * counts + 1) * (self.column == COLUMNS - 1))])
        self.rare_total = U(max(1, int(self.cum[-1])))

    def learn(self, grid: np.ndarray) -> None:
        """Takes all from the steps so far (rows of full lanes)."""
        counts = np.bincount(grid.reshape(-1), minlength=self.vocab)
        known = np.flatnonzero(counts)
        top = known[np.argsort(-counts[known], kind="stable")][: COLUMNS - 1]
        self.column[:] = COLUMNS - 1
        self.column[top] = np.arange(len(top), dtype=np.uint16)
        self.ids[: len(top)] = top
        self._rare(counts)
        cols = self.column.take(grid)
        zero = np.zeros(COLUMNS)
        zero[: len(top)], zero[-1] = counts[top], grid.size - counts[top].sum() + 1
        pair = cols[:-1].astype(np.uint32) * np.uint32(COLUMNS) + cols[1:]
        pairs = np.bincount(pair.reshape(-1), minlength=COLUMNS * COLUMNS)
        one = _mixed(pairs.reshape(COLUMNS, COLUMNS), zero[None] / (grid.size + 1.0))
        often = np.flatnonzero(pairs > 8) if len(grid) > 2 else np.zeros(0, np.int64)
        often = often[np.argsort(-pairs[often], kind="stable")[:PAIRS]]
        self.row = np.tile(np.arange(COLUMNS, dtype=np.uint16), COLUMNS)
        self.row[often] = np.arange(COLUMNS, COLUMNS + len(often), dtype=np.uint16)
        rows = one
        if len(often):
            context = self.row.take(pair[:-1])
            at = np.flatnonzero(context >= COLUMNS)
            third = (context.reshape(-1).take(at).astype(np.uint32) - np.uint32(COLUMNS)) * np.uint32(COLUMNS) + cols[2:].reshape(-1).take(at)
            two = np.bincount(third, minlength=len(often) * COLUMNS).reshape(-1, COLUMNS)
            rows = np.concatenate([one, _mixed(two, one[often % COLUMNS])])
        freq = (rows * (TOTAL - COLUMNS)).astype(np.uint32) + np.uint32(1)
        left = TOTAL - freq.sum(axis=1, dtype=np.int64)
        largest = freq.argmax(axis=1)
        freq[np.arange(len(freq)), largest] += left.astype(np.uint32)  # what rounding left, or (modulo 2**32) a little took
        self._rows(freq)


def _shape(n: int) -> tuple[int, int]:
    lanes = min(LANES, -(-n // 64)) or 1
    return lanes, -(-n // lanes)


def _active(n: int, steps: int):
    """How many lanes have an id at each step: the last lane that has any may be short."""
    full, rest = divmod(n, steps)
    return lambda t: full + (t < rest)


def _rounds(steps: int):
    """(first, end) of the steps between two times of learning."""
    at = [0, *(t for t in LEARNS if t < steps), steps]
    return list(zip(at, at[1:], strict=False))


def encode_block(ids: np.ndarray, vocab: int) -> bytes:
    """ids below vocab, as one block of bytes."""
    n = len(ids)
    ids = np.ascontiguousarray(ids, "<u4")
    if n and int(ids.max()) >= vocab:
        raise ValueError("an id is beyond the vocabulary")
    lanes, steps = _shape(n)
    grid = np.zeros(lanes * steps, np.uint32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    m, active = Model(vocab, False), _active(n, steps)
    low, rng, sent = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64), np.zeros(lanes, np.int64)
    out_lane, out_word, carried = [], [], []
    names = np.arange(lanes, dtype=np.uint16)

    def narrow(lane, start, wide, r):
        """The lanes' ranges become the given parts of r; words go out until each range is wide again."""
        by = start * r
        lo = low[lane] + by
        rg = wide * r
        over = lane[lo < by] if isinstance(lane, np.ndarray) else np.flatnonzero(lo < by)
        if len(over):
            carried.append((over, sent[over] - 1))
        low[lane], rng[lane] = lo, rg
        at = np.flatnonzero(rg < _32)
        at = lane[at] if isinstance(lane, np.ndarray) else at
        while len(at):
            lo, rg = low[at], rng[at] << _16
            out_lane.append(names[at])
            out_word.append((lo >> _48).astype(np.uint32))
            sent[at] += 1
            low[at], rng[at] = lo << _16, rg
            at = at[rg < _32]

    for first, end in _rounds(steps):
        if first:
            m.learn(grid[:first, : active(first - 1)])
        before = max(0, first - 2)
        cols = np.full((end - first + 2, lanes), COLUMNS - 1, np.uint16)
        cols[2 - (first - before) :] = m.column.take(grid[before:end])
        rows = m.row.take(cols[:-2].astype(np.uint32) * np.uint32(COLUMNS) + cols[1:-1])
        cells = m.cells.take(rows.astype(np.uint32) * np.uint32(COLUMNS) + cols[2:])
        for t in range(first, end):
            k, cell = active(t), cells[t - first]
            lane = slice(0, k)
            cell = cell[:k]
            narrow(lane, (cell & np.uint32(0xFFFF)).astype(np.uint64), (cell >> np.uint32(16)).astype(np.uint64), rng[lane] >> _ROW)
            rare = np.flatnonzero(cols[t - first + 2, :k] == COLUMNS - 1)
            if len(rare):
                y = grid[t, rare]
                narrow(rare, m.cum[y].astype(np.uint64), (m.cum[y + 1] - m.cum[y]).astype(np.uint64), rng[rare] // m.rare_total)
    middle = low + (rng >> U(1))
    over = np.flatnonzero(middle < low)
    carried.append((over, sent[over] - 1))
    for s in (48, 32, 16):
        out_lane.append(names)
        out_word.append(((middle >> U(s)) & U(0xFFFF)).astype(np.uint32))
    lane, word = np.concatenate(out_lane), np.concatenate(out_word)
    word = word[np.argsort(lane, kind="stable")]
    sizes = np.bincount(lane, minlength=lanes)
    base = np.cumsum(sizes) - sizes
    for lanes_, places in carried:
        word[base[lanes_] + places] += np.uint32(1)
    while len(over := np.flatnonzero(word > 0xFFFF)):
        word[over] -= np.uint32(1 << 16)
        np.add.at(word, over - 1, np.uint32(1))
    body = zlib.compress(sizes.astype("<u4").tobytes(), 1)
    body = struct.pack("<I", len(body)) + body + word.astype("<u2").tobytes()
    crc = zlib.crc32(ids.tobytes())
    return HEAD.pack(MAGIC, n, vocab, crc, zlib.crc32(body, zlib.crc32(struct.pack("<III", n, vocab, crc))), len(body)) + body


def decode_block(data: bytes) -> np.ndarray:
    """The ids of one block; ValueError if they aren't those that were written."""
    magic, n, vocab, crc, crc_body, length = HEAD.unpack_from(data)
    body = data[HEAD.size : HEAD.size + length]
    if magic != MAGIC or len(body) != length or zlib.crc32(body, zlib.crc32(struct.pack("<III", n, vocab, crc))) != crc_body:
        raise ValueError("damaged block")
    lanes, steps = _shape(n)
    (packed,) = struct.unpack_from("<I", body)
    sizes = np.frombuffer(zlib.decompress(body[4 : 4 + packed]), "<u4").astype(np.int64)
    # four words of zeros after each lane's: nothing else is ever read beyond its end
    ends = np.cumsum(sizes)
    words = np.insert(np.frombuffer(body, "<u2", offset=4 + packed).astype(np.uint64), np.repeat(ends, 4), U(0))
    at = ends - sizes + 4 * np.arange(lanes)
    m, active = Model(vocab, True), _active(n, steps)
    rng, code = np.full(lanes, (1 << 64) - 1, np.uint64), np.zeros(lanes, np.uint64)
    for _ in range(4):
        code = (code << _16) | words[at]
        at += 1
    grid = np.zeros((steps, lanes), np.uint32)

    def widen(i):
        while len(i):
            p, rg = at[i], rng[i] << _16
            code[i] = (code[i] << _16) | words.take(p, mode="clip")
            at[i], rng[i] = p + 1, rg
            i = i[rg < _32]

    for first, end in _rounds(steps):
        if first:
            m.learn(grid[:first, : active(first - 1)])
        before = max(0, first - 2)
        cols = np.full((end - first + 2, lanes), COLUMNS - 1, np.uint16)
        cols[2 - (first - before) : 2] = m.column.take(grid[before:first])
        for t in range(first, end):
            k = active(t)
            b, a = cols[t - first, :k], cols[t - first + 1, :k]
            row = m.row.take(b.astype(np.uint32) * np.uint32(COLUMNS) + a).astype(np.uint32)
            r, co = rng[:k] >> _ROW, code[:k]
            y = np.minimum(co // r, U(TOTAL - 1)).astype(np.uint32)
            col = m.places.take((row << np.uint32(TOTAL_BITS)) + y)
            cols[t - first + 2, :k] = col
            cell = m.cells.take(row * np.uint32(COLUMNS) + col)
            co -= (cell & np.uint32(0xFFFF)) * r
            rng[:k] = (cell >> np.uint32(16)) * r
            widen(np.flatnonzero(rng[:k] < _32))
            rare = np.flatnonzero(col == COLUMNS - 1)
            if len(rare):
                r, co = rng[rare] // m.rare_total, code[rare]
                v = np.minimum(co // r, m.rare_total - U(1)).astype(np.int64)
                y = np.searchsorted(m.cum, v, side="right") - 1
                grid[t, rare] = y
                code[rare] = co - m.cum[y].astype(np.uint64) * r
                rng[rare] = rg = (m.cum[y + 1] - m.cum[y]).astype(np.uint64) * r
                widen(rare[rg < _32])
        named = cols[2:]
        grid[first:end] = np.where(named < COLUMNS - 1, m.ids.take(named), grid[first:end])
    ids = np.ascontiguousarray(grid.T).reshape(-1)[:n].astype("<u4")
    if zlib.crc32(ids.tobytes()) != crc:
        raise ValueError("damaged block")
    return ids


def encode(ids: np.ndarray, vocab: int) -> bytes:
    """Any number of ids as consecutive blocks."""
    return b"".join(encode_block(ids[i : i + BLOCK], vocab) for i in range(0, len(ids), BLOCK))


def decode(data: bytes) -> np.ndarray:
    out, at = [], 0
    while at < len(data):
        out.append(decode_block(data[at:]))
        at += HEAD.size + HEAD.unpack_from(data, at)[5]
    return np.concatenate(out) if out else np.zeros(0, "<u4")
