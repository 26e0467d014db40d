"""Places of ones and neighbouring values of Elias-Fano sequences, against plain loops."""

import numpy as np

from sievewright.llm import elias_fano


def test_places_of_ones():
    rng = np.random.default_rng(5)
    for word in [1, 1 << 63, (1 << 64) - 1, 0x8000000000000001, *rng.integers(1, 1 << 63, 200).tolist()]:
        places = [i for i in range(64) if word >> i & 1]
        assert elias_fano._one(np.full(len(places), word, dtype=np.uint64), np.arange(len(places))).tolist() == places


def test_values_and_the_next_ones():
    rng = np.random.default_rng(6)
    for n, universe in ((2, 10), (1000, 1000), (5000, 1 << 40), (3000, 1 << 62)):
        values = np.sort(rng.integers(0, universe, n))
        values[n // 2 : n // 2 + n // 4] = values[n // 2]
        values = np.sort(values)
        sequence = elias_fano.Sequence(elias_fano.encode(values, universe))
        own, following = sequence.both(np.arange(n - 1))
        assert own.tolist() == values[:-1].tolist() and following.tolist() == values[1:].tolist() and sequence.get(np.arange(n)).tolist() == values.tolist()
