"""Adaptive context-mixing range coder for token ids, in independently reset and checksummed blocks.

A frame holds whole documents: their ids are one stream, cut into blocks of `BLOCK` ids that are coded independently. All
blocks of a frame advance together, one id of every block at a time, so that each step is a few array operations.

An id is coded as a symbol, its bits above the frame's `low` bits; these follow as they are. `low` is 0 for ids below 2**20.
The frame's directory has tables that every block starts from, counted over the whole frame:

* order 0: how often each symbol occurs;
* order 1: the usual follower of every symbol, and how surely it follows;
* order 2: the same for the last two symbols, by a hash of them.

A block adds what it sees itself: the symbol that last followed the last two, and how often in a row it was right, which
goes before the frame's follower once it has been right. How often a follower of some certainty is right, and how far order
1 and order 2 are trusted where they agree, starts equal in every block and adapts with every id.

The order-2 symbol takes its mixed share of the interval, the order-1 symbol, if it differs, its share of the rest, and what
remains is divided by the order-0 counts. The interval narrows a 64-bit carry-less range coder that emits 32 bits at a time:
when the range falls below 32 bits, and cut to a multiple of 2**32 where it straddles one. Integers alone make any machine
decode alike.

Frame layout (little-endian): ``TKF2``, block length u32, ids u64, documents u32, blocks u32, low bits u32, symbols u32,
order-2 slots u32, bytes of tables u32; documents: id i64, id is null u8, length u32, each as an array; blocks: ids u32,
payload bytes u32, crc32 of the ids u32, each as an array; the tables (steps between symbols, counts, followers of order 1
and order 2, u32 each, bytes of equal weight together, deflated); crc32 of all before u32; the payloads.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TKF2"
BLOCK = 1024
#: Blocks that are worked on together at most, which bounds the memory of their tables.
TOGETHER = 8192
#: Followers a block remembers itself, and those of two symbols in the frame's table at most.
SLOTS, SLOTS2 = 256, 1 << 16
#: A symbol has at most so many bits, and order 0 shares out 2**26 places, 32 of them at least to each.
SYMBOL_BITS, PLACE_BITS, LEAST = 20, 26, 32
GUIDE = 10
#: Counted at a time, and cells of counts for order 1 at most.
AT_ONCE, CELLS = 1 << 22, 1 << 22
U64 = np.uint64
_LOW32 = U64(0xFFFFFFFF)
_LIMIT = U64(1 << 32)
_3, _RUN, _SLOT = np.uint32(3), np.uint32(7), np.uint32(SLOTS - 1)
_32, _PLACES = U64(32), U64(PLACE_BITS)


def pair_hash(last: np.ndarray, before: np.ndarray) -> np.ndarray:
    """20 bits of two symbols, given as unsigned 32-bit numbers."""
    return (last * np.uint32(0x9E3779B1) + before * np.uint32(0x85EBCA6B)) >> np.uint32(12)


class Tables:
    """What all blocks of a frame start from."""

    def __init__(self, low: int, symbols: np.ndarray, counts: np.ndarray, follows1: np.ndarray, follows2: np.ndarray):
        self.low, self.symbols, self.counts, self.follows1, self.follows2 = low, symbols, counts, follows1, follows2
        n = len(symbols)
        width = np.zeros(n, np.int64)
        if n:
            free = (1 << PLACE_BITS) - LEAST * n
            width = LEAST + counts.astype(np.int64) * free // int(counts.sum())
            width[int(counts.argmax())] += (1 << PLACE_BITS) - int(width.sum())
        #: Where a symbol's places begin; it ends where the next begins.
        self.bounds = np.concatenate([[0], np.cumsum(width)])

    @classmethod
    def of(cls, ids: np.ndarray) -> tuple[Tables, np.ndarray]:
        """The tables of a frame's ids, and the number of each id's symbol."""
        low = max(0, (int(ids.max()).bit_length() if len(ids) else 0) - SYMBOL_BITS)
        high = ids >> np.uint32(low) if low else ids
        counts = np.bincount(high)
        symbols = np.flatnonzero(counts)
        number = np.zeros(len(counts), np.uint32)
        number[symbols] = np.arange(len(symbols))
        ranks = number[high]
        spread = 64
        while spread * len(symbols) > CELLS and spread > 4:
            spread //= 2
        slots = min(SLOTS2, 1 << max(0, (len(ids) // 128).bit_length() - 1))
        follows1 = _followers(ranks, max(1, len(symbols)), spread, lambda last, before: last)
        follows2 = _followers(ranks, slots, 32, lambda last, before: pair_hash(last, before) & np.uint32(slots - 1))
        return cls(low, symbols.astype("<u4"), counts[symbols].astype("<u4"), follows1, follows2), ranks

    def pack(self) -> bytes:
        steps = np.diff(self.symbols.astype(np.int64), prepend=0)
        whole = np.concatenate([steps, self.counts, self.follows1, self.follows2]).astype("<u4")
        return zlib.compress(np.ascontiguousarray(whole.view(np.uint8).reshape(-1, 4).T).tobytes(), 6)

    @classmethod
    def unpack(cls, data: bytes, low: int, symbols: int, slots: int) -> Tables:
        planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
        whole = np.ascontiguousarray(planes.T).view("<u4").reshape(-1)
        steps, counts, follows1, follows2 = np.split(whole, np.cumsum([symbols, symbols, max(1, symbols)]))
        return cls(low, np.cumsum(steps.astype(np.int64)).astype("<u4"), counts, follows1, follows2)

    def guide(self) -> np.ndarray:
        """The first symbol that may hold a place of order 0, by the place's upper bits."""
        return np.searchsorted(self.bounds[1:], np.arange(1 << (PLACE_BITS - GUIDE)) << GUIDE, side="right")


def _followers(ranks: np.ndarray, contexts: int, spread: int, context) -> np.ndarray:
    """Per context a symbol that usually follows, with its certainty, 0 to 7, in the lowest three bits.

    Followers are counted in ``spread`` hashed cells a context; of the fullest cell the last one is taken.
    """

    def parts():
        for a in range(2, len(ranks), AT_ONCE):
            b = min(len(ranks), a + AT_ONCE)
            now = ranks[a:b]
            yield now, context(ranks[a - 1 : b - 1], ranks[a - 2 : b - 2]), (now * np.uint32(0x9E3779B1) >> np.uint32(20)) & np.uint32(spread - 1)

    cells = np.zeros(contexts * spread, np.int64)
    for _, ctx, cell in parts():
        cells += np.bincount(ctx * np.uint32(spread) + cell, minlength=len(cells))
    cells = cells.reshape(contexts, spread)
    best, total, right = cells.argmax(axis=1), cells.sum(axis=1), cells.max(axis=1)
    found = np.zeros(contexts, np.int64)
    best = best.astype(np.uint32)
    for now, ctx, cell in parts():
        usual = np.flatnonzero(cell == best.take(ctx))
        found[ctx[usual]] = now[usual]
    certainty = np.zeros(contexts, np.int64)
    for k in range(1, 8):
        certainty[right << (8 - k) > total] = k  # surer than one in 2 ** (8 - k)
    return (found << 3 | certainty).astype("<u4")


class Model:
    """Predictions and statistics of ``lanes`` blocks."""

    def __init__(self, lanes: int, tables: Tables):
        lane = np.arange(lanes)
        self.follows1, self.follows2 = tables.follows1.astype(np.uint32), tables.follows2.astype(np.uint32)
        self.mask2 = np.uint32(len(self.follows2) - 1)
        self.base, self.row = lane * SLOTS, (lane * 32).astype(np.uint32)
        self.prev1 = np.zeros(lanes, np.uint32)
        self.prev2 = np.zeros(lanes, np.uint32)
        # An entry is the symbol and, in the lowest three bits, the run.
        self.last = np.zeros(lanes * SLOTS, np.uint32)
        # Of 65536, by whether both orders name the same symbol, whether it is the block's own, and by certainty or run.
        start = [max(256, 49152 >> (7 - k)) for k in range(8)] + [65536 * (k + 1) // (k + 3) for k in range(8)]
        self.right1 = np.tile(np.array(2 * start, np.int32), lanes)
        self.right2 = self.right1.copy()
        self.weight = np.full(lanes, 32, np.int32)

    def predict(self, n: int) -> tuple[np.ndarray, ...]:
        """For the first ``n`` blocks: order-2 symbol and its share of 65536, order-1 symbol and its share."""
        p1 = self.prev1[:n]
        mixed = pair_hash(p1, self.prev2[:n])
        self.at = self.base[:n] + (mixed & _SLOT)
        self.own = self.last.take(self.at)
        self.ran = self.own & _RUN
        proven = self.ran > 0
        e1, e2 = self.follows1.take(p1), np.where(proven, self.own, self.follows2.take(mixed & self.mask2))
        c1, c2 = e1 >> _3, e2 >> _3
        agree = c1 == c2
        row = self.row[:n] + (agree.view(np.uint8) << 4)
        self.q1 = row + (e1 & _RUN)
        self.q2 = row + (e2 & _RUN) + (proven.view(np.uint8) << 3)
        self.say1, self.say2 = self.right1.take(self.q1), self.right2.take(self.q2)
        self.other = np.where(agree, self.say1, self.say2)
        w = self.weight[:n]
        share2 = np.minimum(np.maximum((w * (self.say2 - self.other) >> 6) + self.other, 32), 61440)
        rest = 65536 - share2
        share1 = np.minimum(np.maximum(rest * (self.say1 >> 4) >> 12, 32), rest >> 1)
        share1 *= ~agree
        return c2, share2, c1, share1

    def learn(self, n: int, ranks: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """Every statistic moves, whichever order coded the symbol."""
        right = hit2.astype(np.int32)
        goal2, goal1 = right << 16, hit1.astype(np.int32) << 16
        # Where both say too little or too much, the weight moves to the one that said more or less.
        w = self.weight[:n] + np.sign(self.say2 - self.other) * ((right << 1) - 1)
        self.weight[:n] = np.minimum(np.maximum(w, 1), 63)
        self.right2[self.q2] = self.say2 + ((goal2 - self.say2) >> 6)
        self.right1[self.q1] = self.say1 + ((goal1 - self.say1) >> 6)
        same = (self.own >> _3) == ranks
        self.last[self.at] = ranks << _3 | np.minimum(self.ran + np.uint32(1), _RUN) * same
        self.prev2[:n] = self.prev1[:n]
        self.prev1[:n] = ranks


class _Narrow:
    """Ranges of all blocks; ``shift`` is told which blocks move on by 16 bits."""

    def __init__(self, lanes: int):
        self.low, self.range = np.zeros(lanes, U64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, U64)

    def settle(self, n: int, shift) -> None:
        """Afterwards every range has at least 32 bits."""
        low, size = self.low[:n], self.range[:n]
        which = np.flatnonzero(size < _LIMIT)
        if not len(which):
            return
        lo, sz = low[which], size[which]
        room = (~lo + U64(1)) & _LOW32  # up to the next multiple, 0 on one
        sz = np.where((room > 0) & (room < sz), room, sz)
        shift(which, lo)
        low[which], size[which] = lo << _32, sz << _32


def _blocks(ids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with one column per block, and the ids of each block; only the last may be shorter."""
    lanes = -(-len(ids) // block)
    padded = np.zeros(lanes * block, np.uint32)
    padded[: len(ids)] = ids
    sizes = np.full(lanes, block)
    if lanes:
        sizes[-1] = len(ids) - (lanes - 1) * block
    return np.ascontiguousarray(padded.reshape(lanes, block).T), sizes


def encode_blocks(ids: np.ndarray, ranks: np.ndarray, tables: Tables, block: int = BLOCK) -> list[bytes]:
    """The payload of every block of ``ids``."""
    if len(ids) > TOGETHER * block:
        parts = [slice(at, at + TOGETHER * block) for at in range(0, len(ids), TOGETHER * block)]
        return [p for part in parts for p in encode_blocks(ids[part], ranks[part], tables, block)]
    columns, sizes = _blocks(ranks, block)
    lanes = len(sizes)
    if not lanes:
        return []
    lows = _blocks(ids & np.uint32((1 << tables.low) - 1), block)[0] if tables.low else None
    model, coder = Model(lanes, tables), _Narrow(lanes)
    words = np.zeros((lanes, 64), np.uint32)
    filled = np.zeros(lanes, np.int64)

    def shift(which, low):
        nonlocal words
        at = filled[which]
        if len(at) and int(at.max()) >= words.shape[1]:
            words = np.concatenate([words, np.zeros((lanes, max(64, words.shape[1] // 2)), np.uint32)], axis=1)
        words[which, at] = low >> _32
        filled[which] = at + 1

    for t in range(min(block, len(ids))):
        n = lanes if t < sizes[-1] else lanes - 1
        now = columns[t, :n]
        c2, share2, c1, share1 = model.predict(n)
        hit2, hit1 = now == c2, now == c1
        _narrow(coder, n, tables, now, hit2, hit1, share2, share1)
        coder.settle(n, shift)
        low, size = coder.low, coder.range
        if tables.low:
            part = size[:n] >> U64(tables.low)
            low[:n] += part * lows[t, :n].astype(U64)
            size[:n] = part
            coder.settle(n, shift)
        model.learn(n, now, hit2, hit1)
    out = []
    for k in range(lanes):
        # The range has 32 bits, so a multiple of 2**32 lies in it; zeros follow.
        tail = (int(coder.low[k]) + 0xFFFFFFFF >> 32).to_bytes(4, "big")
        out.append(words[k, : filled[k]].astype(">u4").tobytes() + tail)
    return out


def _narrow(coder: _Narrow, n: int, tables: Tables, now: np.ndarray, hit2: np.ndarray, hit1: np.ndarray, share2: np.ndarray, share1: np.ndarray) -> None:
    """Narrows to the order-2 symbol's share, the order-1 symbol's, or the symbol's own within the rest."""
    used = share2 + share1
    left = np.int64(65536) - used
    start, stop = tables.bounds.take(now) * left >> 16, tables.bounds.take(now + np.uint32(1)) * left >> 16
    start += used.astype(np.int64) << 10
    stop += used.astype(np.int64) << 10
    for hit, a, b in ((hit1, share2, used), (hit2, None, share2)):
        k = np.flatnonzero(hit)
        start[k] = 0 if a is None else a[k].astype(np.int64) << 10
        stop[k] = b[k].astype(np.int64) << 10
    part = coder.range[:n] >> _PLACES
    coder.low[:n] += start.view(U64) * part
    coder.range[:n] = (stop - start).view(U64) * part


def decode_blocks(payloads: list[bytes], sizes: list[int], tables: Tables) -> list[np.ndarray]:
    """Ids of blocks, given how many each holds."""
    if len(payloads) > TOGETHER:
        parts = range(0, len(payloads), TOGETHER)
        return [b for at in parts for b in decode_blocks(payloads[at : at + TOGETHER], sizes[at : at + TOGETHER], tables)]
    if not payloads:
        return []
    order = np.argsort(-np.asarray(sizes), kind="stable")
    lengths = np.asarray(sizes)[order]
    lanes = len(order)
    longest = max(len(p) for p in payloads) // 4 + 4
    words = np.zeros((lanes, longest), np.uint32)
    for row, k in enumerate(order):
        body = np.frombuffer(payloads[k], ">u4", len(payloads[k]) // 4)
        words[row, : len(body)] = body
    code = words[:, 0].astype(U64) << _32 | words[:, 1]
    at = np.full(lanes, 2)
    model, coder = Model(lanes, tables), _Narrow(lanes)

    def shift(which, low):
        place = at[which]
        code[which] = code[which] << _32 | words[which, np.minimum(place, longest - 1)]
        at[which] = place + 1

    guide, ends = tables.guide().astype(np.uint32), tables.bounds[1:]
    out = np.zeros((int(lengths[0]), lanes), np.uint32)
    for t in range(int(lengths[0])):
        n = int(np.searchsorted(-lengths, -t, side="left"))
        low, size = coder.low, coder.range
        c2, share2, c1, share1 = model.predict(n)
        place = np.minimum((code[:n] - low[:n]) // (size[:n] >> _PLACES), U64((1 << PLACE_BITS) - 1)).astype(np.int64)
        upper = place >> 10
        used = share2 + share1
        hit2 = upper < share2
        now = np.where(hit2, c2, c1)
        rest = np.flatnonzero(upper >= used)
        used = used[rest].astype(np.int64)
        # The last place of order 0 that falls on this one.
        place = np.minimum(((place[rest] - (used << 10) + 1 << 16) - 1) // (65536 - used), (1 << PLACE_BITS) - 1)
        symbol = guide.take(place >> GUIDE)
        beyond = np.flatnonzero(ends.take(symbol) <= place)
        while len(beyond):
            symbol[beyond] += np.uint32(1)
            beyond = beyond[ends.take(symbol[beyond]) <= place[beyond]]
        now[rest] = symbol
        hit2, hit1 = now == c2, now == c1
        _narrow(coder, n, tables, now, hit2, hit1, share2, share1)
        coder.settle(n, shift)
        out[t, :n] = tables.symbols.take(now)
        if tables.low:
            part = size[:n] >> U64(tables.low)
            bits = np.minimum((code[:n] - low[:n]) // part, U64((1 << tables.low) - 1))
            low[:n] += part * bits
            size[:n] = part
            coder.settle(n, shift)
            out[t, :n] = out[t, :n] << np.uint32(tables.low) | bits.astype(np.uint32)
        model.learn(n, now, hit2, hit1)
    rows = [None] * lanes
    for row, k in enumerate(order):
        rows[k] = np.ascontiguousarray(out[: lengths[row], row])
    return rows


def pack_frame(doc_ids: list[int | None], documents: list[bytes], block: int = BLOCK) -> bytes:
    """A frame of whole documents, given as little-endian unsigned 32-bit ids."""
    ids = np.frombuffer(b"".join(documents), "<u4")
    tables, ranks = Tables.of(ids)
    payloads = encode_blocks(ids, ranks, tables, block)
    sizes = [min(block, len(ids) - k * block) for k in range(len(payloads))]
    crcs = [zlib.crc32(ids[k * block : (k + 1) * block].astype("<u4").tobytes()) for k in range(len(payloads))]
    packed = tables.pack()
    head = MAGIC + struct.pack("<IQIIIIII", block, len(ids), len(documents), len(payloads), tables.low, len(tables.symbols), len(tables.follows2), len(packed))
    head += np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
    head += np.array([d is None for d in doc_ids], np.uint8).tobytes()
    head += np.array([len(d) // 4 for d in documents], "<u4").tobytes()
    head += np.array(sizes, "<u4").tobytes() + np.array([len(p) for p in payloads], "<u4").tobytes() + np.array(crcs, "<u4").tobytes()
    head += packed
    return b"".join([head, struct.pack("<I", zlib.crc32(head)), *payloads])


class Frame:
    """A frame's directory; blocks are decoded on demand."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token frame")
        block, self.n_ids, docs, blocks, low, symbols, slots, packed = struct.unpack_from("<IQIIIIII", data, 4)
        at = 40
        self.block = block
        if len(data) < at + 13 * docs + 12 * blocks + packed + 4:
            raise ValueError("token frame is cut short")

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            values = np.frombuffer(data, kind, count, at)
            at += values.nbytes
            return values

        ids, nulls, self.lengths = take("<i8", docs), take("u1", docs), take("<u4", docs)
        self.doc_ids = [None if z else int(d) for d, z in zip(ids, nulls)]
        self.sizes, self.bytes, self.crcs = take("<u4", blocks), take("<u4", blocks), take("<u4", blocks)
        tables_at = at
        at += packed
        if zlib.crc32(data[:at]) != struct.unpack_from("<I", data, at)[0]:
            raise ValueError("token frame has a damaged directory")
        self.tables = Tables.unpack(data[tables_at:at], low, symbols, slots)
        self.payload_at = at + 4 + np.concatenate(([0], np.cumsum(self.bytes.astype(np.int64))))
        self.data = data

    def blocks(self, which: list[int] | None = None) -> list[np.ndarray]:
        """Ids of the given blocks (all), each checked against its checksum."""
        which = list(range(len(self.sizes))) if which is None else which
        payloads = [self.data[self.payload_at[k] : self.payload_at[k + 1]] for k in which]
        decoded = decode_blocks(payloads, [int(self.sizes[k]) for k in which], self.tables)
        for k, ids in zip(which, decoded):
            if zlib.crc32(ids.astype("<u4").tobytes()) != self.crcs[k]:
                raise ValueError(f"token block {k} is damaged")
        return decoded

    def documents(self) -> list[bytes]:
        body = b"".join(b.astype("<u4").tobytes() for b in self.blocks())
        ends = np.cumsum(self.lengths.astype(np.int64)) * 4
        return [body[e - 4 * int(n) : e] for e, n in zip(ends, self.lengths)]
