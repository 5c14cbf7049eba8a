"""Bit predictors in hashed contexts, mixed by gated logistic weights: the models of words in texts and of spelling of `lm_score`.

A word is spelt as its bytes and a closing space, each byte as eight bits, most significant first. For each
of ORDERS (how many bytes of the word so far are seen; order 0 sees the position) a table of
counts of zeros and ones is kept, indexed by a hash of the context and the bits of the byte so far.
The log odds of all orders are added up with weights that are learnt online; a gate, the
experience in two of the contexts, chooses the set of weights. The sum is refined by a table of what
followed such predictions in training. While weights are learnt, the word itself is taken
out of the counts, so they suit words that were not met before.

What words follow in a text is predicted in the same way: a token's code, the first CODE_BITS bits of its hash, is
decided bit by bit, in contexts of the FOLLOWED words before it. These are counted at every token of the
training texts; while weights are learnt, the token itself is taken out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

ORDERS = (0, 1, 2, 3, 4, 6)
GATED = (2, 4)  # places in ORDERS
LEVELS = 8
PRIOR = 0.4
RATE = 0.5
CELLS = 33
BATCH_WORDS = 2_000
FOLLOWED = (0, 1, 2)
FOLLOWED_GATED = (1, 2)
CODE_BITS = 8
BATCH_TOKENS = 4_096
FINE = 128
"""Steps of a prediction's log odds that are told apart when texts are scored."""

_MIX = np.uint64(0x9E3779B97F4A7C15)
_TURN = 0xC2B2AE3D27D4EB4F
_CODES, _PLACES = np.arange(1 << CODE_BITS)[:, None], np.arange(CODE_BITS)
_CODE_BIT = (_CODES >> (CODE_BITS - 1 - _PLACES) & 1).astype(np.int8)
_CODE_NODE = ((1 << _PLACES) | (_CODES >> (CODE_BITS - _PLACES))).astype(np.uint64) * np.uint64(_TURN)


class Spelling:
    """All bit decisions of a list of words, as arrays."""

    def __init__(self, words: list[bytes], bits: int) -> None:
        flat = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        size = np.array([len(w) + 1 for w in words])
        self.owner = np.repeat(np.arange(len(words)), size)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        seen = np.zeros(len(flat), np.uint64)  # the last six bytes of the word so far
        for k in range(1, 7):
            before = np.zeros(len(flat), np.uint64)
            before[k:] = flat[:-k]
            before[place < k] = 0
            seen |= before << np.uint64(8 * (k - 1))
        k = np.arange(8)
        self.bit = (flat[:, None] >> (7 - k) & 1).astype(np.int8)
        node = ((1 << k) | (flat[:, None].astype(np.int64) >> (8 - k))).astype(np.uint64) * np.uint64(_TURN)
        self.slots = []
        for order in ORDERS:
            context = seen & np.uint64((1 << (8 * order)) - 1) if order else np.minimum(place, 15).astype(np.uint64)
            base = (context * _MIX) ^ (np.uint64((order + 1) * _TURN % 2**64))
            base ^= base >> np.uint64(29)
            mixed = (base[:, None] ^ node) * _MIX
            self.slots.append((mixed >> np.uint64(64 - bits)).view(np.int64))


_BYTE = np.random.default_rng(1).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[[9, 10, 11, 12, 13, 32]] = 0


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers 0 to n - 1 of an odd number and of its inverse, modulo 2^64."""
    odd = _TURN | 1
    out = []
    for base in (odd, pow(odd, -1, 1 << 64)):
        factors = np.full(n, base, np.uint64)
        factors[:1] = 1
        out.append(np.cumprod(factors))
    return out[0], out[1]


_POWERS = _powers(1 << 17)


def _hashes(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _POWERS if len(flat) <= len(_POWERS[0]) else _powers(len(flat))
    found = np.add.reduceat(_BYTE[flat] * up[: len(flat)], starts) * down[starts]
    found ^= found >> np.uint64(32)
    found *= _MIX
    return found ^ (found >> np.uint64(29))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of every word, zero for the empty one."""
    found = []
    for at in range(0, len(words), BATCH_WORDS):
        part = words[at : at + BATCH_WORDS]
        size = np.array([len(w) + 1 for w in part])
        found.append(_hashes(np.frombuffer(b" ".join(part) + b" ", np.uint8), np.cumsum(size) - size))
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def token_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of lower-cased texts in turn, a zero behind each text for its end, and how many each has."""
    flat = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    inside = _BYTE[flat] != 0
    inside[1:] &= ~inside[:-1]
    starts = np.flatnonzero(inside)
    ends = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
    return np.insert(_hashes(flat, starts), ends, 0), np.diff(ends, prepend=0) + 1


class Following:
    """All bit decisions of the codes of some tokens, as arrays; `contexts` has a number per order for each token."""

    def __init__(self, code: np.ndarray, contexts: list[np.ndarray], bits: int) -> None:
        self.bit = _CODE_BIT[code]
        node = _CODE_NODE[code]
        self.slots = [(((c[:, None] ^ node) * _MIX) >> np.uint64(64 - bits)).view(np.int64) for c in contexts]


def codes(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - CODE_BITS)).astype(np.int64)


def following(hashes: np.ndarray, sizes: np.ndarray, bits: int) -> Iterator[Following]:
    """The decisions of all tokens of texts in turn: 64-bit hashes of the tokens, and how many each text has.

    Contexts begin anew with every text.
    """
    place = np.arange(len(hashes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    seen, contexts = np.zeros(len(hashes), np.uint64), []
    for order in range(max(FOLLOWED) + 1):
        if order:
            before = np.zeros(len(hashes), np.uint64)
            before[order:] = hashes[:-order]
            before[place < order] = 0
            seen = (seen ^ before) * _MIX
            seen ^= seen >> np.uint64(29)
        if order in FOLLOWED:
            base = (seen ^ np.uint64((order + 1) * _TURN % 2**64)) * _MIX
            contexts.append(base ^ (base >> np.uint64(29)))
    code = codes(hashes)
    for at in range(0, len(hashes), BATCH_TOKENS):
        part = slice(at, at + BATCH_TOKENS)
        yield Following(code[part], [c[part] for c in contexts], bits)


def _count(total: np.ndarray, s: Spelling | Following) -> None:
    for flat, slots in zip(total.reshape(len(total), -1), s.slots):
        np.add.at(flat, (2 * slots + s.bit).ravel(), flat.dtype.type(1))


def following_counts(hashes: np.ndarray, sizes: np.ndarray, bits: int, total: np.ndarray | None = None) -> np.ndarray:
    """Counts (orders, slots, 2) of the code bits that follow each context, at every token; added to `total`, if given."""
    if total is None:
        total = np.zeros((len(FOLLOWED), 1 << bits, 2), np.uint32)
    for s in following(hashes, sizes, bits):
        _count(total, s)
    return total


def counts(words: list[bytes], bits: int, total: np.ndarray | None = None) -> np.ndarray:
    """Counts (orders, slots, 2) of the bits that follow each context; every distinct word counts once.

    Added to `total`, if one is given, so that a task holds one table however many words it counts.
    """
    if total is None:
        total = np.zeros((len(ORDERS), 1 << bits, 2), np.float32)
    for at in range(0, len(words), BATCH_WORDS):
        _count(total, Spelling(words[at : at + BATCH_WORDS], bits))
    return total


class Odds:
    """Log odds and experience for every slot, worked out once from the counts.

    With `own`, they depend on the bit that follows and leave one occurrence of it out.
    """

    def __init__(self, table: np.ndarray, own: bool, gated: tuple[int, int] = GATED) -> None:
        self.own, self.gated = own, gated
        self.bits = int(table.shape[1]).bit_length() - 1
        zero, one = table[:, :, 0].astype(np.float32), table[:, :, 1].astype(np.float32)
        odds = lambda a, b: np.log((np.maximum(a, 0) + PRIOR) / (np.maximum(b, 0) + PRIOR))
        if own:
            self.odds = np.stack([odds(one, zero - 1), odds(one - 1, zero)], axis=2).reshape(len(table), -1)
        else:
            self.odds = odds(one, zero)
        met = np.maximum(zero + one - own, 0)
        self.level = np.minimum(np.log2(met[list(gated)] + 1), LEVELS - 1).astype(np.int8)

    def inputs(self, s: Spelling | Following) -> tuple[np.ndarray, np.ndarray]:
        """Log odds (orders, decisions) and gate of every decision."""
        x = np.empty((len(s.slots), s.bit.size), np.float32)
        bit = s.bit.ravel()
        for k, slots in enumerate(s.slots):
            at = slots.ravel()
            x[k] = np.take(self.odds[k], 2 * at + bit if self.own else at, mode="clip")
        first, second = (np.take(level, s.slots[k].ravel(), mode="clip") for level, k in zip(self.level, self.gated))
        return x, (LEVELS * first + second).astype(np.int64)


def _mixed(x: np.ndarray, gate: np.ndarray, weights: np.ndarray) -> np.ndarray:
    z = np.zeros(x.shape[1], np.float32)
    for each, weight in zip(x, weights.astype(np.float32)):
        z += each * np.take(weight, gate, mode="clip")
    return np.clip(z, -12, 12)


def _cell(z: np.ndarray) -> np.ndarray:
    return ((z + 12) * ((CELLS - 1) / 24) + 0.5).astype(np.int64)


def new_weights(orders: int = len(ORDERS)) -> np.ndarray:
    """(orders, gates)"""
    return np.full((orders, LEVELS ** len(GATED)), 1.5 / orders)


def new_state(orders: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, how much each set was used, and (cells, 2) what followed predictions, before anything is learnt."""
    return new_weights(orders), np.zeros(LEVELS ** len(GATED)), np.zeros((CELLS, 2))


def _learn(s: Spelling | Following, odds: Odds, state: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
    weights, used, followed = state
    x, gate = odds.inputs(s)
    z = _mixed(x, gate, weights)
    bit = s.bit.ravel()
    error = bit - 1 / (1 + np.exp(-z))
    share = np.bincount(gate, None, len(used))
    for k in range(len(x)):
        weights[k] += RATE * np.bincount(gate, error * x[k], len(used)) / np.maximum(share, 1)
    used += share
    followed += np.bincount(2 * _cell(z) + bit, None, 2 * CELLS).reshape(CELLS, 2)


def learn(words: list[bytes], odds: Odds) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Online pass: weights, how much each set was used, and (cells, 2) what followed predictions."""
    state = new_state(len(ORDERS))
    for at in range(0, len(words), BATCH_WORDS):
        _learn(Spelling(words[at : at + BATCH_WORDS], odds.bits), odds, state)
    return state


def learn_following(hashes: np.ndarray, sizes: np.ndarray, odds: Odds, state: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
    """The online pass over texts; goes on from `state` and changes it."""
    for s in following(hashes, sizes, odds.bits):
        _learn(s, odds, state)


def refinement(followed: np.ndarray) -> np.ndarray:
    """Probability of a one by cell of the prediction; cells met little stay near the prediction."""
    middle = np.linspace(-12, 12, CELLS)
    expected = 1 / (1 + np.exp(-middle))
    return (followed[:, 1] + 20 * expected) / (followed.sum(axis=1) + 20)


def _log10_steps(refine: np.ndarray) -> np.ndarray:
    """log10 probability of a zero and of a one for every step of the mixed log odds, refined."""
    z = np.arange(-12 * FINE, 12 * FINE + 1) / FINE
    one = np.interp(z, np.linspace(-12, 12, CELLS), refine)
    one = np.clip((1 / (1 + np.exp(-z)) + one) / 2, 1e-6, 1 - 1e-6)
    return np.log10(np.stack([1 - one, one], axis=1)).ravel()


def _log10_bits(s: Spelling | Following, odds: Odds, weights: np.ndarray, of_step: np.ndarray) -> np.ndarray:
    step = ((_mixed(*odds.inputs(s), weights) + 12) * FINE + 0.5).astype(np.int64)
    return np.take(of_step, 2 * step + s.bit.ravel(), mode="clip")


def log10_following(hashes: np.ndarray, sizes: np.ndarray, odds: Odds, weights: np.ndarray, refine: np.ndarray) -> np.ndarray:
    """log10 probability of every token's code after the words before it; over all codes these add up to one."""
    of_step = _log10_steps(refine)
    found = [_log10_bits(s, odds, weights, of_step).reshape(-1, CODE_BITS).sum(axis=1) for s in following(hashes, sizes, odds.bits)]
    return np.concatenate(found) if found else np.zeros(0)


def log10_spelling(words: list[bytes], odds: Odds, weights: np.ndarray, refine: np.ndarray) -> np.ndarray:
    """log10 probability of every word's spelling; over all byte strings these add up to one."""
    of_step, found = _log10_steps(refine), []
    for at in range(0, len(words), BATCH_WORDS):
        part = words[at : at + BATCH_WORDS]
        s = Spelling(part, odds.bits)
        cost = _log10_bits(s, odds, weights, of_step).reshape(-1, 8).sum(axis=1)
        found.append(np.bincount(s.owner, cost, len(part)))
    return np.concatenate(found) if found else np.zeros(0)
