"""An adaptive context-mixing range coder for blocks of token ids, run over many blocks at once with numpy.

A block is coded on its own: its tables start empty, so any block can be read without the others. Three orders foretell
an id: the one that followed the last two ids before (order 2), the one that followed the last id (order 1), and how often
each id came in this block (order 0), where only ids count that the higher orders didn't foretell. Whether an order is
right is a question of its own. The chance of a yes is mixed in the logistic domain from two adaptive tables, one by
what is known of the predictions, one by the last answers, with weights that each block learns as it goes. Ids that are
new to a block are coded by the block's frequencies of their upper bits, 256 classes, and flat below.

All blocks of a batch take their n-th id in the same step; no block sees another's tables. All arithmetic is on whole
numbers, or on products of 53-bit floats, which every machine rounds alike.
"""

from __future__ import annotations

import numpy as np

BLOCK = 2048
# An id's lower bits, coded flat when it is new: 8 for ids of 16 bits, 24 for those of 32.
LOWER_BITS = range(8, 25)
_SLOTS = 1024
# Code words of 16 bits leave at the top of 64; no range is coded from that is below the bottom.
_TOP, _BOTTOM = np.uint64(1 << 48), np.uint64(1 << 40)
_MASK = np.uint64((1 << 40) - 1)
_S16, _S48 = np.uint64(16), np.uint64(48)
_S12 = np.uint64(12)  # chances are twelve-bit numbers
_TOTAL_BITS = 14
_REBUILD = 64
_ONE = np.uint64(1)
# No chance gets to no or yes.
_NO, _YES = 31, 4064
# The more often a table's entry was used, the less an answer moves it: by one part of so many.
_PACES = (1.5, 2.5, 3.5, 5.0, 7.0, 9.0, 12.0, 16.0)
_WEIGHT, _LEARN = 1 << 16, 11
_STATES = 1 << 16


def _states() -> np.ndarray:
    """What a table's entries become after a no, after a yes and unasked, by their lower 16 bits.

    These hold a chance in 13 bits << 3 | uses; above them stands ln(p / (1 - p)) of the chance in 1 / 256.
    """
    state = np.arange(_STATES)
    p, uses = (state >> 3) + 0.5, state & 7
    more = np.minimum(uses + 1, 7)
    pace = np.array(_PACES)[uses]
    after = [(np.clip(np.rint(p + (goal - p) / pace - 0.5), 0, 8191).astype(np.int32) << 3) | more for goal in (0, 8192)]
    share = p / 8192
    packed = (np.rint(np.log(share / (1 - share)) * 256).astype(np.int32) << 16) | state.astype(np.int32)
    return np.concatenate([packed[after[0]], packed[after[1]], packed])


_AFTER = _states()
_START = _AFTER[2 * _STATES + (4096 << 3)]
# The inverse: the chance in twelve bits of a logarithm from -2047 / 256 on.
_SQUASH = np.clip(np.rint(4096 / (1 + np.exp(-np.arange(-2047, 2048) / 256))), _NO, _YES).astype(np.int32)


class _Questions:
    """The chances of a yes to some questions in each block, from two tables with an entry per context, question and block.

    `both` of `ask` has a row of places for each table; all its questions are asked there.
    """

    def __init__(self, lanes: int, questions: int, contexts: int):
        # Where a question's tables begin.
        self.begin = np.arange(2 * questions).reshape(2, questions, 1) * (lanes * contexts)
        self.table = np.full(2 * questions * lanes * contexts, _START, np.int32)
        self.weights = np.full((2, questions, lanes), _WEIGHT // 2, np.int32)

    def ask(self, both: np.ndarray, lanes: np.ndarray | None = None) -> np.ndarray:
        self.at, self.lanes = both[:, None] + self.begin, lanes
        own = self.table.take(self.at, mode="clip")
        self.state, self.inputs = own & np.int32(_STATES - 1), own >> 16
        self.used = self.weights if lanes is None else self.weights.take(lanes, axis=2, mode="clip")
        # Weights beyond all measure would wrap alike on both sides.
        each = self.used * self.inputs
        dot = (each[0] + each[1] >> 16) + np.int32(2047)
        self.chance = _SQUASH.take(dot, mode="clip")
        return self.chance.astype(np.uint64)

    def learn(self, yes: np.ndarray, unasked: np.ndarray | None = None) -> None:
        """Moves the tables and the weights by the answers to each question; what wasn't asked has no yes."""
        missed = yes * np.int32(4095) - self.chance
        plane = yes * np.int32(_STATES)
        if unasked is not None:
            missed *= ~unasked
            plane += unasked * np.int32(2 * _STATES)
        self.table[self.at] = _AFTER.take(plane + self.state, mode="clip")
        weights = self.used + (missed * self.inputs >> _LEARN)
        if self.lanes is None:
            self.weights = weights
        else:
            self.weights[:, :, self.lanes] = weights


class _Model:
    """What the encoder and the decoder both know of each block after every id.

    Looking up and storing cost most, so what is looked up together is packed into one number: an id and how far it is
    trusted, the start and the width of a class's part, the start and the end of an id's run among the sorted ids. All
    places are in their tables, which numpy isn't to check ("clip").
    """

    def __init__(self, lanes: int, length: int, lower: int):
        # Ids are shifted by two bits, and one number stands for none.
        kind = np.int32 if lower < 21 else np.int64
        self.none = np.iinfo(kind).max
        lane = np.arange(lanes)
        self.lower, self.kind, self.room = lower, kind, length
        # Orders 1 and 2 have a row each. All blocks' entries of one context lie together: most blocks ask at few contexts.
        self.slots, self.contexts = np.array([lane, lane + lanes]) * _SLOTS, lane
        self.classes, self.runs_at = lane * 256, lane * length
        self.foretold = np.zeros(2 * lanes * _SLOTS, kind)  # id << 2 | trust
        self.higher, self.order0 = _Questions(lanes, 2, 64), _Questions(lanes, 1, 64)
        self.unasked = np.zeros((2, lanes), bool)
        self.upper = np.ones((lanes, 256), np.int32)
        self.parts = np.empty((lanes, 256), np.int32)  # start << 16 | width
        self.starts = np.empty((lanes, 256), np.int32)
        self.seen = np.full((length, lanes), self.none, kind)
        self.ranked = np.full(lanes * length, self.none, kind)
        self.runs = np.zeros(lanes * length, np.int32)  # start << 16 | end
        self.ranked_to, self.next_rank = 0, 16
        self.ranked_n = np.zeros(lanes, np.int64)
        self.last = np.zeros(lanes, kind)
        self.at, self.both = self.slots.copy(), np.empty((2, lanes), np.int64)
        self.answers, self.answers0 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.step = 0

    def _rank(self) -> None:
        """Sorts the ids that order 0 knows; each is then a run as long as its count."""
        n, lanes = self.step, len(self.last)
        ranked = np.sort(np.ascontiguousarray(self.seen[:n].T), axis=1)
        place = np.arange(n, dtype=np.int32)
        turn = ranked[:, 1:] != ranked[:, :-1]
        first, final = np.zeros((lanes, n), np.int32), np.full((lanes, n), n, np.int32)
        first[:, 1:] = turn * place[1:]
        final[:, :-1] = np.where(turn, place[1:], n)
        starts = np.maximum.accumulate(first, axis=1)
        ends = np.minimum.accumulate(final[:, ::-1], axis=1)[:, ::-1]
        self.ranked.reshape(lanes, self.room)[:, :n] = ranked
        self.runs.reshape(lanes, self.room)[:, :n] = starts << 16 | ends
        self.ranked_n = np.count_nonzero(ranked != self.none, axis=1)
        self.ranked_to, self.next_rank = n, n * 5 // 4

    def predict(self) -> None:
        if self.step == self.next_rank:
            self._rank()
        if self.step % _REBUILD == 0 or self.step in (8, 24):
            sums = np.cumsum(self.upper, axis=1, dtype=np.int32)
            # Every class keeps at least one part of the total.
            scale = ((1 << _TOTAL_BITS) - 256) / sums[:, -1:].astype(np.float64)
            ends = (sums * scale).astype(np.int32)
            ends[:, -1] = (1 << _TOTAL_BITS) - 256
            ends += np.arange(1, 257, dtype=np.int32)
            self.starts[:, 0] = 0
            self.starts[:, 1:] = ends[:, :-1]
            np.subtract(ends, self.starts, out=self.parts)
            self.parts |= self.starts << 16
        self.step += 1
        np.add(self.slots[0], self.last * 40503 >> 3 & _SLOTS - 1, out=self.at[0])
        self.entry = self.foretold.take(self.at, mode="clip")
        self.guess, self.trust = self.entry >> 2, self.entry & 3
        self.guess1, self.guess2 = self.guess
        known = (self.trust[0] * 8 + self.trust[1] * 2 + (self.guess1 == self.guess2)) * len(self.last)
        np.add(self.contexts, known, out=self.both[0])
        np.add(self.contexts, self.answers * len(self.last), out=self.both[1])
        self.chance2, self.chance1 = self.higher.ask(self.both)

    def known(self, lanes: np.ndarray) -> np.ndarray:
        """The chance that the ids of these blocks are among the ranked ones."""
        age = min(self.step.bit_length() // 2, 7)
        both, begin = np.empty((2, len(lanes)), np.int64), self.contexts.take(lanes, mode="clip")
        np.add(begin, (self.trust[0].take(lanes, mode="clip") * 8 + age) * len(self.last), out=both[0])
        np.add(begin, self.answers0.take(lanes, mode="clip") * len(self.last), out=both[1])
        return self.order0.ask(both, lanes)[0]

    def runs_of(self, ids: np.ndarray) -> np.ndarray:
        """The runs of (steps, blocks) ids among the ranked ones, as start << 16 | end; 0 for ids that aren't ranked."""
        lanes, n = len(self.last), self.ranked_to
        if n == 0:
            return np.zeros(ids.shape, np.int32)
        # All blocks' ranked ids in one ascending row; what stands for none is above every id.
        lane = np.arange(lanes, dtype=np.int64) << 33
        rows = np.minimum(self.ranked.reshape(lanes, self.room)[:, :n], self.none if self.kind is np.int32 else 1 << 32)
        keys = (rows + lane[:, None]).reshape(-1)
        asked = ids.T + lane[:, None]
        at = np.minimum(np.searchsorted(keys, asked.reshape(-1)), len(keys) - 1)
        runs = self.runs.reshape(lanes, self.room)[:, :n].reshape(-1).take(at)
        return np.ascontiguousarray(np.where(keys.take(at) == asked.reshape(-1), runs, 0).reshape(asked.shape).T)

    def ranked_at(self, lanes: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids at these places of the ranked ones, with the start and the end of their runs."""
        at = self.runs_at.take(lanes, mode="clip") + place
        runs = self.runs.take(at, mode="clip")
        return self.ranked.take(at, mode="clip"), runs >> 16, runs & 0xFFFF

    def part(self, lanes: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of the classes' parts."""
        packed = self.parts.reshape(-1).take(self.classes.take(lanes) + upper, mode="clip")
        return packed >> 16, packed & 0xFFFF

    def find(self, lanes: np.ndarray, value: np.ndarray) -> np.ndarray:
        """The classes whose parts hold the values, by halving."""
        begin, starts = self.classes.take(lanes, mode="clip"), self.starts.reshape(-1)
        at = begin
        for step in (128, 64, 32, 16, 8, 4, 2, 1):
            at = at + step * (starts.take(at + step, mode="clip") <= value)
        return at - begin

    def update(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray, rest: np.ndarray, hit0: np.ndarray) -> None:
        """`rest` are the blocks whose ids orders 2 and 1 didn't foretell, `hit0` tells which of theirs were ranked."""
        self.unasked[1] = hit2
        self.higher.learn(np.array([hit2, hit1]), self.unasked)
        self.order0.learn(hit0[None])
        self.answers0[rest] = (self.answers0.take(rest, mode="clip") << 1 & 63) + hit0
        own = ids.take(rest, mode="clip")
        self.seen[self.step - 1][rest] = own
        new = (~hit0).nonzero()[0]
        self.upper.reshape(-1)[self.classes.take(rest.take(new, mode="clip"), mode="clip") + (own.take(new, mode="clip") >> self.lower)] += np.int32(24)
        # A right guess is trusted more, up to 3; a wrong one less, and without trust the id takes its place.
        wrong = np.where(self.trust, self.entry - 1, ids << 2)
        self.foretold[self.at] = np.where(self.guess == ids, self.entry + (self.trust < 3), wrong)
        np.add(self.slots[1], (self.last * 9973 ^ ids * 40503) >> 4 & _SLOTS - 1, out=self.at[1])
        self.last = ids
        self.answers = (self.answers << 2 & 63) + (hit2 * 2 + hit1)


def encode_blocks(ids: np.ndarray, lower: int = LOWER_BITS[0]) -> list[bytes]:
    """Each row of a (blocks, length) array of ids below 2^(lower + 8), as the bytes of one block."""
    lanes, length = ids.shape
    model = _Model(lanes, length, lower)
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    room = 6 * length + 8
    out, begin = np.zeros(lanes * room, np.uint16), np.arange(lanes) * room
    at = begin.copy()

    def put(rows: np.ndarray, value: np.ndarray) -> None:
        here = at.take(rows, mode="clip")
        out[here] = value >> _S48
        at[rows] = here + 1

    columns = np.ascontiguousarray(ids.T.astype(model.kind))
    total, mask = np.uint64(_TOTAL_BITS + lower), (1 << lower) - 1
    with np.errstate(over="ignore"):
        for step, x in enumerate(columns):
            model.predict()
            if step == model.ranked_to or step == 0:
                begun, runs = step, model.runs_of(columns[step : model.next_rank])
            hit2 = model.guess2 == x
            hit1 = (model.guess1 == x) & ~hit2
            part2 = (span >> _S12) * model.chance2
            low1, span1 = low + part2, span - part2
            part1 = (span1 >> _S12) * model.chance1
            low = np.where(hit2, low, np.where(hit1, low1, low1 + part1))
            span = np.where(hit2, part2, np.where(hit1, part1, span1 - part1))
            rest = (~(hit2 | hit1)).nonzero()[0]
            own, lows, spans = x.take(rest, mode="clip"), low.take(rest, mode="clip"), span.take(rest, mode="clip")
            part0 = (spans >> _S12) * model.known(rest)
            run = runs[step - begun].take(rest, mode="clip")
            hit0, first, end = run > 0, run >> 16, run & 0xFFFF
            unit = part0 // np.maximum(model.ranked_n.take(rest, mode="clip"), 1).astype(np.uint64)
            low[rest] = np.where(hit0, lows + unit * first.astype(np.uint64), lows + part0)
            span[rest] = np.where(hit0, unit * (end - first).astype(np.uint64), spans - part0)
            _shift(low, span, put)
            new = (~hit0).nonzero()[0]
            blocks, own = rest.take(new, mode="clip"), own.take(new, mode="clip")
            start, wide = model.part(blocks, own >> lower)
            unit = span.take(blocks, mode="clip") >> total
            low[blocks] += unit * ((start.astype(np.int64) << lower) + (own & mask) * wide.astype(np.int64)).astype(np.uint64)
            span[blocks] = unit * wide.astype(np.uint64)
            model.update(x, hit2, hit1, rest, hit0)
            _shift(low, span, put, blocks)
        every = np.arange(lanes)
        for _ in range(4):
            put(every, low)
            low <<= _S16
    return [out[b:e].tobytes() for b, e in zip(begin, at, strict=True)]


def decode_blocks(blocks: list[bytes], length: int, lower: int = LOWER_BITS[0]) -> np.ndarray:
    """The ids of blocks of one length."""
    lanes = len(blocks)
    model = _Model(lanes, length, lower)
    # Beyond its end a block reads as zeros.
    room = max((len(b) // 2 for b in blocks), default=0) + 8
    words = np.zeros((lanes, room), np.uint16)
    for i, b in enumerate(blocks):
        words[i, : len(b) // 2] = np.frombuffer(b, np.uint16)
    words, at = words.reshape(-1), np.arange(lanes) * room
    low, span, code = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64), np.zeros(lanes, np.uint64)

    def pull(rows: np.ndarray, _) -> None:
        here = at.take(rows, mode="clip")
        code[rows] = code.take(rows, mode="clip") << _S16 | words.take(here, mode="clip")
        at[rows] = here + 1

    every = np.arange(lanes)
    ids = np.empty((length, lanes), model.kind)
    total, mask = np.uint64(_TOTAL_BITS + lower), (1 << lower) - 1
    most = np.uint64((1 << _TOTAL_BITS + lower) - 1)
    with np.errstate(over="ignore"):
        for _ in range(4):
            pull(every, None)
        for step in range(length):
            model.predict()
            ahead = code - low
            part2 = (span >> _S12) * model.chance2
            hit2 = ahead < part2
            low1, span1 = low + part2, span - part2
            part1 = (span1 >> _S12) * model.chance1
            hit1 = (ahead - part2 < part1) & ~hit2
            low = np.where(hit2, low, np.where(hit1, low1, low1 + part1))
            span = np.where(hit2, part2, np.where(hit1, part1, span1 - part1))
            x = np.where(hit2, model.guess2, model.guess1)
            rest = (~(hit2 | hit1)).nonzero()[0]
            lows, spans = low.take(rest, mode="clip"), span.take(rest, mode="clip")
            part0 = (spans >> _S12) * model.known(rest)
            count = model.ranked_n.take(rest, mode="clip")
            unit = part0 // np.maximum(count, 1).astype(np.uint64)
            ahead = code.take(rest, mode="clip") - lows
            # Nothing was coded where no id is ranked; a damaged block may lead anywhere, its checksum tells.
            hit0 = (ahead < part0) & (count > 0)
            place = np.minimum(ahead // np.maximum(unit, _ONE), np.maximum(count - 1, 0).astype(np.uint64)).astype(np.int64)
            own, first, end = model.ranked_at(rest, place)
            low[rest] = np.where(hit0, lows + unit * first.astype(np.uint64), lows + part0)
            span[rest] = np.where(hit0, unit * (end - first).astype(np.uint64), spans - part0)
            _shift(low, span, pull)
            new = (~hit0).nonzero()[0]
            rows = rest.take(new, mode="clip")
            unit = span.take(rows, mode="clip") >> total
            value = np.minimum((code.take(rows, mode="clip") - low.take(rows, mode="clip")) // np.maximum(unit, _ONE), most).astype(np.int64)
            upper = model.find(rows, value >> lower)
            start, wide = (v.astype(np.int64) for v in model.part(rows, upper))
            below = np.minimum((value - (start << lower)) // np.maximum(wide, 1), mask)
            low[rows] += unit * ((start << lower) + below * wide).astype(np.uint64)
            span[rows] = unit * wide.astype(np.uint64)
            own[new] = upper << lower | below
            x[rest] = own
            ids[step] = x
            model.update(x, hit2, hit1, rest, hit0)
            _shift(low, span, pull, rows)
    return ids.T


def _shift(low: np.ndarray, span: np.ndarray, move, rows: np.ndarray | None = None) -> None:
    """Moves out settled code words, for the blocks that have some, of all or of `rows`; without carries."""
    while True:
        lows, spans = (low, span) if rows is None else (low.take(rows, mode="clip"), span.take(rows, mode="clip"))
        settled = (lows ^ (lows + spans)) < _TOP
        due = (settled | (spans < _BOTTOM)).nonzero()[0]
        if not len(due):
            return
        straddles = ~settled.take(due, mode="clip")
        rows = due if rows is None else rows.take(due, mode="clip")
        lows, spans = lows.take(due, mode="clip"), spans.take(due, mode="clip")
        if straddles.any():
            spans = np.where(straddles, (~lows + _ONE) & _MASK, spans)
        move(rows, lows)
        low[rows] = lows << _S16
        span[rows] = spans << _S16
