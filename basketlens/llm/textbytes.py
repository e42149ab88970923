"""NumPy kernels over the UTF-8 bytes of an Arrow string column: words, word hashes, shingles.

They work on all texts of a slice at once. A slice holds about ``SLICE_BYTES`` of whole texts, so
temporary arrays stay small whatever the batch; only a single longer text makes a longer slice.
"""

import numpy as np

SLICE_BYTES = 1 << 20

# The six ASCII white-space bytes, and A-Z to a-z.
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_powers = {}

# The four largest primes below 2**31.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
_lanes = []  # (powers, inverse powers) of each prime field, up to SLICE_BYTES


def mix(x):
    """A bijective scrambling of 64-bit numbers (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


def salted(seed, n):
    """n reproducible 64-bit constants."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def powers(base, n):
    """base**0 … base**(n-1) modulo 2**64."""
    known = _powers.get(base)
    if known is None or known.size < n:
        steps = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        known = np.cumprod(steps)
        if known.size <= 4 * SLICE_BYTES:
            _powers[base] = known
    return known[:n]


def column_bytes(column):
    """(bytes, offsets) of an Arrow string column; a null text is empty."""
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    wide = str(column.type).startswith("large")
    offsets = np.frombuffer(buffers[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data, offsets


def slices(column, limit=SLICE_BYTES):
    """(first row, bytes, offsets) of consecutive runs of whole texts of about ``limit`` bytes."""
    if len(column) == 0:
        return
    data, offsets = column_bytes(column)
    low = 0
    while low < len(column):
        high = int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), len(column))
        yield low, data[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low]
        low = high


def words(data, offsets):
    """(starts, ends, first word of each text and the total) of blank-separated words."""
    blank = BLANK[data]
    edge = np.zeros(data.size + 1, dtype=bool)
    edge[offsets] = True
    starts = ~blank
    starts[1:] &= blank[:-1] | edge[1:-1]
    ends = ~blank
    ends[:-1] &= blank[1:] | edge[1:-1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def prefix_hash(data):
    """Running polynomial sums, from which the hash of any span follows by ``span_hash``."""
    sums = np.zeros(data.size + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, data.size), out=sums[1:])
    return sums


def span_hash(sums, starts, ends):
    if starts.size == 0:
        return np.empty(0, np.uint64)
    return mix((sums[ends] - sums[starts]) * powers(_INVERSE, int(starts.max()) + 1)[starts])


def _lane(k):
    """Powers of a fixed base and of its inverse in the k-th prime field, from 0 to SLICE_BYTES."""
    while len(_lanes) <= k:
        prime = PRIMES[len(_lanes)]
        base = int(salted(23, len(PRIMES))[len(_lanes)]) % (prime - 2) + 2
        both = []
        for x in (base, pow(base, -1, prime)):
            steps = np.ones(1, np.uint64)
            while steps.size <= SLICE_BYTES:
                steps = np.concatenate([steps, steps * np.uint64(pow(x, steps.size, prime)) % np.uint64(prime)])
            both.append(steps[:SLICE_BYTES + 1].astype(np.uint32))
        _lanes.append(both)
    return _lanes[k]


def _field_spans(data, starts, ends, k):
    """Each span's polynomial in the k-th prime field: sum of (byte + 1) · base**(place in the span)."""
    powers_k, inverse_k = _lane(k)
    prime = np.uint64(PRIMES[k])
    sums = np.zeros(data.size + 1, np.uint64)
    # A block's sum stays below 2**60; later blocks start from a scaled power and the sum so far.
    for low in range(0, data.size, SLICE_BYTES):
        block = data[low:low + SLICE_BYTES].astype(np.uint64)
        block += np.uint64(1)
        block *= powers_k[:block.size]
        np.cumsum(block, out=sums[low + 1:low + 1 + block.size])
        if low:
            part = sums[low + 1:low + 1 + block.size]
            part %= prime
            part *= np.uint64(pow(int(powers_k[1]), low, int(prime)))
            part += sums[low] % prime
    value = (sums[ends] % prime + prime - sums[starts] % prime) % prime
    value = value * inverse_k[starts % SLICE_BYTES] % prime
    for block in np.unique(starts // SLICE_BYTES):
        if block:
            far = starts // SLICE_BYTES == block
            value[far] = value[far] * np.uint64(pow(int(inverse_k[1]), int(block) * SLICE_BYTES, int(prime))) % prime
    return value


def span_keys(data, starts, ends):
    """Two 64-bit keys of each span, by which spans of many texts can be told apart.

    Four polynomials in different prime fields and the length go into the keys. Unlike sums modulo 2**64, which are
    equal for some pairs of strings whatever the base, each field tells two different spans of n bytes apart but for n of its 2**31 bases.
    """
    if starts.size == 0:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    lanes = [_field_spans(data, starts, ends, k) for k in range(len(PRIMES))]
    length = (ends - starts).astype(np.uint64) * np.uint64(_BASE)
    return mix((lanes[0] | lanes[1] << np.uint64(32)) + length), mix((lanes[2] | lanes[3] << np.uint64(32)) ^ length)


def paired(a, b):
    """Keys of pairs: the two 64-bit lanes of the first and the second, each lane one to one in either."""
    salts = salted(31, 4)
    return tuple(mix((x * (salts[2 * k] | np.uint64(1))) ^ mix(y + salts[2 * k + 1])) for k, (x, y) in enumerate(zip(a, b)))


def runs_of(keys, length):
    """Keys of each run of ``length`` consecutive items, by doubling; the last length - 1 places have none."""
    size = 1
    while size < length:
        step = min(size, length - size)
        keys = paired([x[:-step] for x in keys], [x[step:] for x in keys]) if keys[0].size > step else [x[:0] for x in keys]
        size += step
    return keys


def word_hashes(data, offsets, lower=True):
    """(64-bit hash of each word, first word of each text and the total)."""
    starts, ends, first = words(data, offsets)
    return span_hash(prefix_hash(LOWER[data] if lower else data), starts, ends), first


def shingles(data, offsets, size=5):
    """(hash of each run of ``size`` lower-case words, bounds of each text's runs).

    A text of fewer words has one shingle, its whole sequence; a text without words has none.
    Repeated shingles are kept.
    """
    hashes, first = word_hashes(data, offsets)
    counts = np.diff(first)
    weights = salted(5, size) | np.uint64(1)
    n = hashes.size - size + 1
    rolled = np.zeros(max(n, 0), dtype=np.uint64)
    for k in range(size if n > 0 else 0):
        rolled += hashes[k:k + n] * weights[k]
    rolled = mix(rolled)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(runs)])
    out = np.empty(bounds[-1], dtype=np.uint64)
    whole = counts >= size
    if whole.any():
        at = np.repeat(first[:-1][whole] - bounds[:-1][whole], runs[whole])
        place = np.concatenate([np.arange(a, b) for a, b in zip(bounds[:-1][whole], bounds[1:][whole])])
        out[place] = rolled[place + at]
    for text in np.flatnonzero((counts > 0) & (counts < size)):
        own = hashes[first[text]:first[text + 1]]
        out[bounds[text]] = mix(np.array([(own * weights[:own.size]).sum() + np.uint64(own.size)], np.uint64))[0]
    return out, bounds


def shingle_keys(data, offsets, size=5):
    """(two lanes of a key of each run of ``size`` lower-case words, bounds of each text's runs).

    A text of fewer words has one shingle, its whole sequence; a text without words has none. Repeated shingles are kept.
    """
    starts, ends, first = words(data, offsets)
    items = span_keys(LOWER[data], starts, ends)
    counts = np.diff(first)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(runs)])
    rolled = runs_of(items, size)
    places = np.arange(bounds[-1]) + np.repeat(first[:-1] - bounds[:-1], runs)
    whole = np.repeat(counts >= size, runs)
    out = [np.empty(bounds[-1], np.uint64) for _ in items]
    for lane, x in zip(out, rolled):
        lane[whole] = x[places[whole]]
    for n in range(1, size):
        # Sequences of n words, told apart from runs by their length.
        some = np.flatnonzero(counts == n)
        if some.size:
            keys = [x[first[some]] for x in items]
            for k in range(1, n):
                keys = paired(keys, [x[first[some] + k] for x in items])
            for lane, x in zip(out, paired(keys, [np.full(some.size, n, np.uint64)] * 2)):
                lane[bounds[some]] = x
    return out, bounds
