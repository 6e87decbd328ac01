"""Progressive JPEG in numpy, many images at once.

A frame's blocks are (blocks, 64) arrays in zigzag order, one for each component. A scan brings a band of every block
(spectral selection) or one more bit of it (successive approximation); scans accumulate in these arrays. Between restart
markers scans are independent, so restart intervals of all images of a group are coded in the same numpy calls: where
each code of a first scan ends depends on the bits alone, so the length at every bit position is looked up at once and
only the walk from code to code is a loop, over eight codes at a time. Memory follows the coefficients and one group of intervals.

Read: SOF2, eight bits a sample, one or three components of any sampling, restart intervals. ValueError: anything else,
and codes that no table holds or that end too early. Chroma is upsampled by repetition, colours are JFIF's.
"""

from __future__ import annotations

import functools
from bisect import bisect_left
from dataclasses import dataclass, field

import numpy as np

#: Positions of a block from low to high frequencies: along its diagonals, turning at the edges.
ZIGZAG = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))
#: The scans that encode() writes: components, first and last of the band, the bit before, the bit reached.
SCRIPT = (((0, 1, 2), 0, 0, 0, 1), ((0,), 1, 15, 0, 1), ((0,), 16, 63, 0, 0), ((1,), 1, 63, 0, 0), ((2,), 1, 63, 0, 0), ((0, 1, 2), 0, 0, 1, 0), ((0,), 1, 15, 1, 0))
#: Units of a scan between restart markers, and those that one group of numpy calls takes.
RESTART, GROUP = 4096, 4096
#: Code lengths that encode() writes: the sizes of adjacent differences alike; sizes 1 to 7 without a run in three bits.
DC_LENGTHS = {s: 4 for s in range(12)}
AC_LENGTHS = {s: 3 for s in range(1, 8)} | {r << 4 | s: 11 for r in range(16) for s in range(11) if r or not 1 <= s <= 7}
#: Bit positions that are looked up at a time.
_HERE = np.arange(1 << 12)
SIZES = np.array([v.bit_length() for v in range(1 << 11)], np.int64)


@dataclass
class Frame:
    height: int
    width: int
    sampling: tuple[tuple[int, int], ...]
    quant: list[np.ndarray]

    def __post_init__(self):
        self.most = tuple(max(x) for x in zip(*self.sampling))
        self.mcus = (-(-self.height // (8 * self.most[1])), -(-self.width // (8 * self.most[0])))

    def grid(self, c: int) -> tuple[int, int]:
        """Rows and columns of a component's blocks, whole MCUs."""
        return self.mcus[0] * self.sampling[c][1], self.mcus[1] * self.sampling[c][0]

    def order(self, comps: tuple[int, ...]) -> list[np.ndarray]:
        """For each component the places of its blocks, a row for each unit of the scan."""
        if len(comps) == 1:
            (c,), (_, wide) = comps, self.grid(comps[0])
            h, v = self.sampling[c]
            rows, cols = (-(-(-(-n * s // m)) // 8) for n, s, m in ((self.height, v, self.most[1]), (self.width, h, self.most[0])))
            return [(np.arange(rows)[:, None] * wide + np.arange(cols)).reshape(-1, 1)]
        out = []
        for c in comps:
            h, v = self.sampling[c]
            places = np.arange(self.mcus[0] * v * self.mcus[1] * h).reshape(self.mcus[0], v, self.mcus[1], h)
            out.append(places.transpose(0, 2, 1, 3).reshape(-1, h * v))
        return out


def _orders(frames: list[Frame], comps: tuple[int, ...]) -> list[list[np.ndarray]]:
    """Each frame's order(), told once for frames of one size; the frames have one sampling."""
    known = {}
    for f in frames:
        if (f.height, f.width) not in known:
            known[f.height, f.width] = f.order(comps)
    return [known[f.height, f.width] for f in frames]


class Table:
    """A Huffman table by what the next sixteen bits say: code length, symbol, length with the bits that follow."""

    def __init__(self, counts: bytes, symbols: bytes, dc: bool):
        self.length, self.symbol, self.total = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64), np.ones(1 << 16, np.uint8)
        self.codes, self.lengths = np.zeros(256, np.int64), np.zeros(256, np.int64)
        code, at = 0, 0
        for n, count in enumerate(counts, 1):
            for s in symbols[at : at + count]:
                if code >> n:
                    raise ValueError("too many codes")
                own = slice(code << (16 - n), (code + 1) << (16 - n))
                more = s if dc else (s & 15) or (s >> 4 if s >> 4 < 15 else 0)
                self.length[own], self.symbol[own], self.total[own] = n, s, n + more
                self.codes[s], self.lengths[s] = code, n
                code += 1
            code, at = code << 1, at + count

    @functools.cached_property
    def tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """Code and bits, and their number, of run << 11 | value + 1024, for runs under 16 and values of ten bits."""
        value = np.arange(-1024, 1024)
        magnitude = np.abs(value)
        size = SIZES[magnitude]
        symbol = np.arange(16)[:, None] << 4 | size
        return (self.codes[symbol] << size | _signed_bits(value, magnitude, size)).reshape(-1), (self.lengths[symbol] + size).reshape(-1)


@functools.lru_cache(64)
def _table(counts: bytes, symbols: bytes, dc: bool) -> Table:
    return Table(counts, symbols, dc)


def _described(lengths: dict[int, int]) -> tuple[bytes, bytes]:
    return bytes(sum(v == n for v in lengths.values()) for n in range(1, 17)), bytes(sorted(lengths, key=lambda s: lengths[s]))


# ---- writing ---------------------------------------------------------------------------------------


def _packed(values: np.ndarray, bits: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The bits of each interval, filled up with ones and stuffed; bounds: first token of each, and the end."""
    upto = np.concatenate([[0], np.cumsum(bits)])
    own = np.diff(upto[bounds])
    start = np.concatenate([[0], np.cumsum((own + 7) >> 3)])
    at = upto[:-1] + np.repeat(8 * start[:-1] - upto[bounds[:-1]], np.diff(bounds))
    words = np.zeros((start[-1] >> 2) + 3, np.uint64)
    if len(values):
        word = at >> 5
        wide = values.astype(np.uint64) << (64 - bits - (at & 31)).astype(np.uint64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        words[word[first]] |= np.bitwise_or.reduceat(wide >> np.uint64(32), first)
        words[word[first] + 1] |= np.bitwise_or.reduceat(wide & np.uint64(0xFFFFFFFF), first)
    data = words.astype(">u4").view(np.uint8)[: start[-1]].copy()
    some = own > 0
    data[start[1:][some] - 1] |= ((1 << (-own[some] & 7)) - 1).astype(np.uint8)
    full = np.flatnonzero(data == 255)
    data, start = np.insert(data, full + 1, 0), start + np.searchsorted(full, start)
    return [data[a:b].tobytes() for a, b in zip(start[:-1].tolist(), start[1:].tolist())]


def _signed_bits(value: np.ndarray, magnitude: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(value < 0, ~magnitude & ((1 << size) - 1), magnitude)


def _ends(block: np.ndarray, last: np.ndarray, length: int, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and number of the blocks that each end-of-band run covers; block, last: of what has codes of its own."""
    n = bounds[-1]
    active = np.zeros(n, bool)
    active[block] = True
    need = np.ones(n, bool)
    need[block[last == length - 1]] = False
    first = need & (active | ~np.concatenate([[False], need[:-1]]))
    first[bounds[:-1]] |= need[bounds[:-1]]
    return np.flatnonzero(first), np.bincount(np.cumsum(first)[need], minlength=1)[1:]


def _end_tokens(runs: np.ndarray, table: Table) -> tuple[np.ndarray, np.ndarray]:
    n = SIZES[runs & 2047] - 1 if not len(runs) or runs.max() < 2048 else np.log2(runs).astype(np.int64)
    return table.codes[n << 4] << n | runs - (1 << n), table.lengths[n << 4] + n


def _first_scan(band: np.ndarray, reached: int, table: Table, bounds: np.ndarray) -> list[bytes]:
    length = band.shape[1]
    value = band.reshape(-1)
    magnitude = np.abs(value) >> reached
    at = np.flatnonzero(magnitude != 0)
    value, magnitude = value[at], magnitude[at]
    block = at // length
    within = at - block * length
    run = within.copy()
    same = np.flatnonzero(block[1:] == block[:-1]) + 1
    run[same] = at[same] - at[same - 1] - 1
    which = (run & 15) << 11 | np.where(value < 0, 1024 - magnitude, 1024 + magnitude)
    tokens, bits = (x[which] for x in table.tokens)
    ends, runs = _ends(block, within, length, bounds)
    skip = np.repeat(np.arange(len(at)), run >> 4)
    where = np.concatenate([np.searchsorted(block, ends, "right"), skip])
    count = np.searchsorted(block, bounds) + np.searchsorted(ends, bounds) + np.searchsorted(block[skip], bounds)
    if len(where):
        code, wide = _end_tokens(runs, table)
        tokens = np.insert(tokens, where, np.concatenate([code, np.full(len(skip), table.codes[0xF0])]))
        bits = np.insert(bits, where, np.concatenate([wide, np.full(len(skip), table.lengths[0xF0])]))
    return _packed(tokens, bits, count)


def _refining_scan(band: np.ndarray, reached: int, table: Table, bounds: np.ndarray) -> list[bytes]:
    length = band.shape[1]
    value = band.reshape(-1)
    magnitude = np.abs(value.astype(np.int32)) >> reached
    old, new, zeros = np.flatnonzero(magnitude > 1), np.flatnonzero(magnitude == 1), np.flatnonzero(magnitude == 0)
    block = new // length
    before = np.searchsorted(zeros, new)
    base = np.searchsorted(zeros, block * length)
    same = np.flatnonzero(block[1:] == block[:-1]) + 1
    base[same] = before[same - 1]
    run = before - base
    skips = run >> 4
    owner = np.repeat(np.arange(len(new)), skips)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(skips) - skips, skips)
    skip = zeros[base[owner] + 16 * nth + 15]
    ends, runs = _ends(block, new - block * length, length, bounds)
    symbol = (run & 15) << 4 | 1
    code, wide = _end_tokens(runs, table)
    place = np.concatenate([new, skip, (ends + runs) * length - 1])
    tokens = np.concatenate([table.codes[symbol] << 1 | (value[new] > 0), np.full(len(skip), table.codes[0xF0]), code])
    bits = np.concatenate([table.lengths[symbol] + 1, np.full(len(skip), table.lengths[0xF0]), wide])
    by = np.argsort(place)
    place = place[by]
    where = np.searchsorted(old, np.concatenate([[-1], place[:-1]]), "right") if len(place) else place
    count = np.searchsorted(old, bounds * length) + np.searchsorted(place, bounds * length)
    return _packed(np.insert((magnitude[old] & 1).astype(np.int64), where, tokens[by]), np.insert(np.ones(len(old), np.int64), where, bits[by]), count)


def _dc_scan(units: list[np.ndarray], before: int, reached: int, table: Table, bounds: np.ndarray) -> list[bytes]:
    """units: (units, blocks of a unit) of each component."""
    wide = np.concatenate([u.astype(np.int64) >> reached for u in units], axis=1)
    n = wide.shape[1]
    if before:
        return _packed((wide & 1).reshape(-1), np.ones(wide.size, np.int64), bounds * n)
    at = 0
    for u in units:
        own = wide[:, at : at + u.shape[1]].reshape(-1)
        less = np.concatenate([[0], own[:-1]])
        less[bounds[:-1] * u.shape[1]] = 0
        wide[:, at : at + u.shape[1]] = (own - less).reshape(u.shape)
        at += u.shape[1]
    value = wide.reshape(-1)
    magnitude = np.abs(value)
    size = SIZES[magnitude]
    return _packed(table.codes[size] << size | _signed_bits(value, magnitude, size), table.lengths[size] + size, bounds * n)


def _marker(code: int, body: bytes) -> bytes:
    return bytes([0xFF, code]) + (len(body) + 2).to_bytes(2, "big") + body


def _intervals(units: list[int], restart: int) -> list[list[tuple[int, int, int]]]:
    """(image, first unit, end) of every interval, in groups of about GROUP units."""
    out, size = [[]], 0
    for i, n in enumerate(units):
        for a in range(0, n, restart or max(n, 1)):
            b = min(n, a + (restart or n))
            if out[-1] and size + b - a > GROUP:
                out.append([])
                size = 0
            out[-1].append((i, a, b))
            size += b - a
    return out if out[0] else []


def _bounds(part: list[tuple[int, int, int]]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([b - a for _, a, b in part])])


def encode(frames: list[Frame], images: list[list[np.ndarray]], comments: list[bytes]) -> list[bytes]:
    """Frames of three components, whole MCUs and one sampling; images: their coefficients, of at most ten bits."""
    dc, ac = _described(DC_LENGTHS), _described(AC_LENGTHS)
    tables = _table(*dc, True), _table(*ac, False)
    out = []
    for f, said in zip(frames, comments):
        head = b"".join(bytes([i + 1, h << 4 | v, 0]) for i, (h, v) in enumerate(f.sampling))
        out.append([
            b"\xff\xd8", _marker(0xFE, said), _marker(0xDB, b"\0" + f.quant[0].astype(np.uint8).tobytes()),
            _marker(0xC2, bytes([8]) + f.height.to_bytes(2, "big") + f.width.to_bytes(2, "big") + bytes([len(f.sampling)]) + head),
            _marker(0xC4, b"\0" + b"".join(dc)), _marker(0xC4, b"\x10" + b"".join(ac)), _marker(0xDD, RESTART.to_bytes(2, "big")),
        ])
    known = {comps: _orders(frames, comps) for comps in {x[0] for x in SCRIPT if x[1] == 0}}
    for comps, first, last, before, reached in SCRIPT:
        head = _marker(0xDA, bytes([len(comps), *(x for c in comps for x in (c + 1, 0)), first, last, before << 4 | reached]))
        for o in out:
            o.append(head)
        orders = known[comps] if first == 0 else None
        for part in _intervals([len(orders[i][0]) if orders else len(x[comps[0]]) for i, x in enumerate(images)], RESTART):
            bounds = _bounds(part)
            if first == 0:
                units = [np.concatenate([images[i][c][orders[i][k][a:b], 0] for i, a, b in part]) for k, c in enumerate(comps)]
                coded = _dc_scan(units, before, reached, tables[0], bounds)
            else:
                band = np.concatenate([images[i][comps[0]][a:b, first : last + 1] for i, a, b in part])
                coded = (_refining_scan if before else _first_scan)(band, reached, tables[1], bounds)
            for (i, a, _), data in zip(part, coded):
                if a:
                    out[i].append(bytes([0xFF, 0xD0 + (a // RESTART - 1) % 8]))
                out[i].append(data)
    return [b"".join([*o, b"\xff\xd9"]) for o in out]


# ---- reading ---------------------------------------------------------------------------------------


@dataclass
class Scan:
    comps: tuple[int, ...]
    band: tuple[int, int]
    before: int
    reached: int
    tables: tuple[tuple[bytes, bytes, bool] | None, ...]
    restart: int
    data: list[bytes] = field(repr=False)

    def key(self) -> tuple:
        return self.comps, self.band, self.before, self.reached, self.tables, self.restart


@dataclass
class Parsed:
    frame: Frame
    comments: list[bytes]
    scans: list[Scan]

    def key(self) -> tuple:
        return self.frame.sampling, tuple(s.key() for s in self.scans)


def _entropy(data: bytes, at: int) -> tuple[list[bytes], int]:
    """The intervals of a scan, unstuffed, and where the next marker stands."""
    out, start = [], at
    while True:
        at = data.find(b"\xff", at)
        if at < 0 or at + 1 >= len(data):
            raise ValueError("scan without an end")
        code = data[at + 1]
        if code == 0 or code == 0xFF:
            at += 2 if code == 0 else 1
            continue
        out.append(data[start:at].replace(b"\xff\x00", b"\xff"))
        if not 0xD0 <= code <= 0xD7:
            return out, at
        start = at = at + 2


def parse(data: bytes) -> Parsed:
    if data[:2] != b"\xff\xd8":
        raise ValueError("no JPEG")
    at, quant, tables, comments, scans, frame, restart, ids, chosen = 2, {}, {}, [], [], None, 0, [], []
    while True:
        while data[at : at + 2] == b"\xff\xff":
            at += 1
        if len(data) < at + 2 or data[at] != 0xFF:
            raise ValueError("no marker")
        code = data[at + 1]
        if code == 0xD9:
            break
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        body, at = data[at + 4 : at + 2 + size], at + 2 + size
        if len(body) != size - 2:
            raise ValueError("short marker")
        if code == 0xFE:
            comments.append(body)
        elif code == 0xDD:
            restart = int.from_bytes(body, "big")
        elif code == 0xDB:
            while body:
                kind = ">u2" if body[0] >> 4 else "u1"
                n = 128 if body[0] >> 4 else 64
                quant[body[0] & 15] = np.frombuffer(body[1 : 1 + n], kind).astype(np.float64)
                body = body[1 + n :]
        elif code == 0xC4:
            while body:
                n = sum(body[1:17])
                tables[body[0]] = (body[1:17], body[17 : 17 + n], body[0] < 16)
                body = body[17 + n :]
        elif code == 0xC2:
            if body[0] != 8 or body[5] not in (1, 3):
                raise ValueError("unknown frame")
            ids = list(body[6::3])
            chosen = list(body[8::3])
            sampling = tuple((x >> 4, x & 15) for x in body[7::3])
            sampling = sampling if len(sampling) == 3 else ((1, 1),)
            frame = Frame(int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big"), sampling, [])
            if not frame.height or not frame.width or any(m % x for s in sampling for m, x in zip(frame.most, s)):
                raise ValueError("unknown frame")
        elif 0xC0 <= code <= 0xCF and code != 0xCC:
            raise ValueError("no progressive frame")
        elif code == 0xDA:
            n = body[0]
            if frame is None or not n:
                raise ValueError("scan without a frame")
            comps = tuple(ids.index(x) for x in body[1 : 2 * n : 2])
            first, last, bits = body[1 + 2 * n : 4 + 2 * n]
            if first > last or last > 63 or (first == 0 and last) or (first and n > 1):
                raise ValueError("unknown band")
            dc = first == 0
            used = tuple(None if dc and bits >> 4 else tables.get(x >> 4 if dc else 16 | x & 15) for x in body[2 : 1 + 2 * n : 2])
            if not (dc and bits >> 4) and None in used:
                raise ValueError("scan without a table")
            intervals, at = _entropy(data, at)
            scans.append(Scan(comps, (first, last), bits >> 4, bits & 15, used, restart, intervals))
    if frame is None:
        raise ValueError("no frame")
    frame.quant = [quant[c] for c in chosen]
    return Parsed(frame, comments, scans)


class Bits:
    """Intervals beside each other, and the 32 bits from each byte on."""

    def __init__(self, parts: list[bytes]):
        self.start = np.cumsum([0, *(len(p) + 8 for p in parts)])[:-1]
        self.end = self.start + [len(p) for p in parts]
        self.data = (bytes(8)).join([*parts, b""])
        raw = np.frombuffer(self.data, np.uint8).astype(np.uint32)
        self.words = np.zeros(len(raw), np.uint32)
        self.words[:-3] = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]

    def sixteen(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 3] >> (16 - (at & 7)).astype(np.uint32)) & 0xFFFF

    def read(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 3].astype(np.int64) << (at & 7)) & 0xFFFFFFFF) >> (32 - n)

    def lengths(self, table: Table) -> np.ndarray:
        """The length of what would begin at each bit."""
        out = np.empty((len(self.words), 8), np.uint8)
        for j in range(8):
            out[:, j] = table.total[(self.words << np.uint32(j)) >> np.uint32(16)]
        return out.reshape(-1)


def _walk(one: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the codes of each interval begin, and how many begin before each interval and the end. What two, four and
    eight codes take is told at every bit (31 bits each, so a byte holds it); the loop steps over eight at a time."""
    jumps = [one]
    for _ in range(3):
        last, new = jumps[-1], np.empty_like(one)
        for a in range(0, len(one), len(_HERE)):
            own = last[a : a + len(_HERE)]
            new[a : a + len(_HERE)] = own + last[a : a + len(_HERE) + 256].take(own + _HERE[: len(own)], mode="clip")
        jumps.append(new)
    eight, walked, rows = jumps[3].tobytes(), [], [0]
    keep = walked.append
    for at, stop in zip(start.tolist(), end.tolist()):
        while at < stop:
            keep(at)
            at += eight[at]
        rows.append(len(walked))
    out = np.empty((len(walked), 8), np.int64)
    out[:, 0] = walked
    for k, jump in zip((4, 2, 1), jumps[2::-1]):
        known = out[:, :: 2 * k]
        out[:, k :: 2 * k] = known + jump.take(known, mode="clip")
    own = out < np.repeat(end, np.diff(rows))[:, None]
    return out[own], np.concatenate([[0], np.cumsum(own.sum(axis=1))])[rows]


def _value(bits: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.where(bits < (1 << size >> 1), bits + 1 - (1 << size), bits)


def _read_first(data: list[bytes], band: np.ndarray, reached: int, table: Table, bounds: np.ndarray) -> None:
    length, bits = band.shape[1], Bits(data)
    at, count = _walk(bits.lengths(table), 8 * bits.start, 8 * bits.end)
    if (np.diff(count) == 0).any():
        raise ValueError("scan ends too early")
    window = bits.sixteen(at)
    symbol, code = table.symbol[window], table.length[window]
    run, size = symbol >> 4, symbol & 15
    more = np.where(size > 0, size, np.where(run < 15, run, 0))
    extra = bits.read(at + code, more)
    step = np.where(size > 0, run + 1, np.where(run == 15, 16, 0))
    upto = np.cumsum(step)
    ends = np.flatnonzero(more + step == run)  # size 0 and no skip
    # where a code stands: the sum of steps, moved at the start of each interval and behind each end of band
    shift, moved, k = [], [], 0
    stops, blocks, before = ends.tolist(), (extra[ends] + (1 << run[ends])).tolist(), upto - step
    told = before[ends].tolist()
    for first, last, here, at_ in zip(count[:-1].tolist(), count[1:].tolist(), before[count[:-1]].tolist(), (bounds[:-1] * length).tolist()):
        moved.append(first)
        shift.append(at_ - here)
        while k < len(stops) and stops[k] < last:
            moved.append(stops[k])
            shift.append(((told[k] + shift[-1]) // length + blocks[k]) * length - told[k])
            k += 1
    place = upto + np.repeat(np.array(shift, np.int64), np.diff([*moved, len(upto)]))
    stop = np.repeat(bounds[1:] * length, np.diff(count))
    if (place[count[1:] - 1] < bounds[1:] * length).any():
        raise ValueError("scan ends too early")
    own = place - step < stop
    if (code[own] == 0).any() or ((place - 1) // length != (place - step) // length)[own & (step > 0)].any():
        raise ValueError("codes that do not fit")
    own &= size > 0
    band.reshape(-1)[place[own] - 1] = _value(extra[own], size[own]) << reached


def _read_refining(data: list[bytes], band: np.ndarray, reached: int, table: Table, bounds: np.ndarray) -> None:
    length, flat, bits = band.shape[1], band.reshape(-1), Bits(data)
    zeros = np.flatnonzero(flat == 0)
    known = np.flatnonzero(flat)
    after = zeros.tolist()
    symbols, codes, words = table.symbol, table.length, bits.words
    told, signs, spans = [], [], []
    for i, end in enumerate((8 * bits.end).tolist()):
        at, here, stop = int(8 * bits.start[i]), int(bounds[i]) * length, int(bounds[i + 1]) * length
        z = bisect_left(after, here)
        while here < stop:
            window = int(words[at >> 3]) >> (16 - (at & 7)) & 0xFFFF
            symbol, n = int(symbols[window]), int(codes[window])
            if n == 0 or at >= end:
                raise ValueError("scan ends too early")
            run, size, at = symbol >> 4, symbol & 15, at + n
            if size == 0 and run < 15:
                blocks = (1 << run) + ((int(words[at >> 3]) << (at & 7) & 0xFFFFFFFF) >> (32 - run))
                at += run
                to = min(stop, (here // length + blocks) * length)
                next_z = bisect_left(after, to)
                same = to - here - (next_z - z)
            else:
                if z + run >= len(after) or after[z + run] // length != here // length:
                    raise ValueError("codes that do not fit")
                to, next_z = after[z + run] + 1, z + run + 1
                same = to - 1 - here - run
                if size:
                    told.append(to - 1)
                    signs.append(1 if words[at >> 3] >> (31 - (at & 7)) & 1 else -1)
                    at += 1
            if same:
                spans.append((at, here - z, same))
                at += same
            here, z = to, next_z
    if spans:
        start, first, n = np.array(spans).T
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        where = np.repeat(start, n) + inside
        bit = (bits.words[where >> 3] >> (31 - (where & 7)).astype(np.uint32)) & 1
        which = known[np.repeat(first, n) + inside]
        flat[which] += (np.sign(flat[which]) * bit.astype(flat.dtype)) << reached
    flat[told] = np.array(signs, flat.dtype) << reached


def _read_dc(data: list[bytes], widths: list[int], scan: Scan, tables: list[Table | None], bounds: np.ndarray) -> np.ndarray:
    """(units, blocks of a unit): differences summed up, or the next bit."""
    bits, per = Bits(data), sum(widths)
    units = np.diff(bounds)
    if scan.before:
        n = np.repeat(8 * bits.start, units * per) + np.arange(bounds[-1] * per) - np.repeat(bounds[:-1] * per, units * per)
        if (8 * (bits.end - bits.start) < units * per).any():
            raise ValueError("scan ends too early")
        return bits.read(n, np.ones_like(n)).reshape(-1, per)
    lengths = {id(t): bits.lengths(t).tobytes() for t in {id(t): t for t in tables}.values()}
    pattern, walked = [lengths[id(t)] for t, w in zip(tables, widths) for _ in range(w)], []
    for at, end, n in zip((8 * bits.start).tolist(), (8 * bits.end).tolist(), units.tolist()):
        for _ in range(n):
            for own in pattern:
                walked.append(at)
                at += own[at]
            if at > end:
                raise ValueError("scan ends too early")
    at, out, k = np.array(walked, np.int64).reshape(-1, per), np.empty((len(walked) // per, per), np.int64), 0
    for table, w in zip(tables, widths):
        own = at[:, k : k + w].reshape(-1)
        window = bits.sixteen(own)
        if (table.length[window] == 0).any():
            raise ValueError("codes that do not fit")
        size = table.symbol[window]
        upto = np.cumsum(_value(bits.read(own + table.length[window], size), size))
        upto -= np.repeat(np.concatenate([[0], upto])[bounds[:-1] * w], units * w)
        out[:, k : k + w] = upto.reshape(-1, w)
        k += w
    return out


def coefficients(images: list[Parsed]) -> list[list[np.ndarray]]:
    """What all scans of these images add up to; the images have one key()."""
    firsts, known = [], {}
    for c in range(len(images[0].frame.sampling)):
        firsts.append(np.cumsum([0, *(x.frame.grid(c)[0] * x.frame.grid(c)[1] for x in images)]).tolist())
    whole = [np.zeros((own[-1], 64), np.int16) for own in firsts]
    for k, scan in enumerate(images[0].scans):
        tables = [None if t is None else _table(*t) for t in scan.tables]
        if scan.comps not in known:
            known[scan.comps] = [[o + firsts[c][i] for c, o in zip(scan.comps, own)] for i, own in enumerate(_orders([x.frame for x in images], scan.comps))]
        orders = known[scan.comps]
        first, last = scan.band
        taken = [0] * len(images)
        for part in _intervals([len(o[0]) for o in orders], scan.restart):
            bounds, data = _bounds(part), []
            for i, _, _ in part:
                if taken[i] == len(images[i].scans[k].data):
                    raise ValueError("scan ends too early")
                data.append(images[i].scans[k].data[taken[i]])
                taken[i] += 1
            places = [np.concatenate([orders[i][n][a:b] for i, a, b in part]) for n in range(len(scan.comps))]
            if first == 0:
                told, at = (_read_dc(data, [o.shape[1] for o in places], scan, tables, bounds) << scan.reached).astype(np.int16), 0
                for c, own in zip(scan.comps, places):
                    whole[c][own, 0] |= told[:, at : at + own.shape[1]]
                    at += own.shape[1]
                continue
            c, own = scan.comps[0], places[0][:, 0]
            if own[-1] - own[0] == len(own) - 1:
                own = slice(own[0], own[-1] + 1)
            band = whole[c][own, first : last + 1].copy()
            (_read_refining if scan.before else _read_first)(data, band, scan.reached, tables[0], bounds)
            whole[c][own, first : last + 1] = band
    return [[x[own[i] : own[i + 1]] for x, own in zip(whole, firsts)] for i in range(len(images))]


def _basis() -> np.ndarray:
    """A row of 64 pixels for each coefficient, in zigzag order."""
    u, x = np.arange(8)[:, None], np.arange(8)
    wave = np.cos((2 * x + 1) * u * np.pi / 16) * np.where(u == 0, 0.5**0.5, 1) / 2
    return np.einsum("vy,ux->vuyx", wave, wave).reshape(64, 64)[ZIGZAG]


BASIS = _basis()
#: Halves are rounded up whatever the last bits of a product are.
HALF = 128.5 + 1e-7


def _plane(frame: Frame, c: int, blocks: np.ndarray, rows: slice) -> np.ndarray:
    wide = frame.grid(c)[1]
    own = blocks[rows.start * wide : rows.stop * wide]
    pixels = (own * frame.quant[c]) @ BASIS
    pixels += HALF
    pixels = np.clip(pixels, 0, 255, out=pixels).astype(np.uint8)
    return pixels.reshape(-1, wide, 8, 8).transpose(0, 2, 1, 3).reshape(-1, wide * 8)


_OFF = np.arange(256) - 128
_RED, _BLUE = np.floor(1.402 * _OFF + 0.5).astype(np.int16), np.floor(1.772 * _OFF + 0.5).astype(np.int16)
_GREEN_B, _GREEN_R = -0.344136 * _OFF, -0.714136 * _OFF + 0.5


def rgb(frame: Frame, blocks: list[np.ndarray]) -> np.ndarray:
    """(height, width, 3) of eight bits; some rows of MCUs at a time, chroma repeated to full size."""
    out = np.empty((frame.height, frame.width, 3), np.uint8)
    step = max(1, GROUP // max(1, frame.mcus[1]))
    for top in range(0, frame.mcus[0], step):
        rows = [slice(top * v, min(top + step, frame.mcus[0]) * v) for _, v in frame.sampling]
        planes = [_plane(frame, c, b, r) for c, (b, r) in enumerate(zip(blocks, rows))]

        def full(x: np.ndarray, c: int) -> np.ndarray:
            h, v = frame.most[0] // frame.sampling[c][0], frame.most[1] // frame.sampling[c][1]
            x = np.repeat(x, v, axis=0) if v > 1 else x
            return np.repeat(x, h, axis=1) if h > 1 else x

        own = out[top * 8 * frame.most[1] : (top + step) * 8 * frame.most[1]]
        y = full(planes[0], 0).astype(np.int16)
        if len(planes) == 1:
            parts = (y, y, y)
        else:
            cb, cr = planes[1:]
            if frame.sampling[1] == frame.sampling[2]:
                green = full(np.floor(_GREEN_B[cb] + _GREEN_R[cr]).astype(np.int16), 1)
            else:
                green = np.floor(full(_GREEN_B[cb], 1) + full(_GREEN_R[cr], 2)).astype(np.int16)
            parts = (y + full(_RED[cr], 2), y + green, y + full(_BLUE[cb], 1))
        for k, part in enumerate(parts):
            own[..., k] = np.clip(part[: own.shape[0], : own.shape[1]], 0, 255)
    return out


def rgbs(frames: list[Frame], images: list[list[np.ndarray]]) -> list[np.ndarray]:
    """The rgb() of each; images of one width are told as one, below each other."""
    out, alike = [None] * len(frames), {}
    for i, f in enumerate(frames):
        alike.setdefault((f.width, f.sampling, b"".join(q.tobytes() for q in f.quant)), []).append(i)
    for rows in alike.values():
        f, unit, at = frames[rows[0]], 8 * frames[rows[0]].most[1], 0
        tall = Frame(unit * sum(frames[i].mcus[0] for i in rows), f.width, f.sampling, f.quant)
        pixels = rgb(tall, [np.concatenate(x) if len(x) > 1 else x[0] for x in zip(*(images[i] for i in rows))])
        for i in rows:
            out[i] = pixels[at : at + frames[i].height]
            at += unit * frames[i].mcus[0]
    return out
