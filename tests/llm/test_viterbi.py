"""Decoding against all paths of small lattices, character counts against plain counting."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest

from acctlens.llm.toxicity import LETTERS, SYMBOLS, Restorer, character_counts, symbol
from tests.llm.helpers import documents, prose


def path_cost(restorer, text):
    """Cost of a text under the character model, an edge of a word at either end and at each space."""
    a = b = 0
    total = 0.0
    for x in text:
        s = 0 if x == " " else symbol(x)
        total += restorer.cost[a][b][s]
        a, b = (0, 0) if x == " " else (b, s)
    return total + restorer.cost[a][b][0]


def all_paths(restorer, noisy, apart):
    """{text: least cost} over every path of the lattice."""
    out = {}
    for path in itertools.product(*restorer.lattice(noisy, apart)):
        text = "".join(letters for letters, _ in path)
        cost = path_cost(restorer, text) + sum(more for _, more in path)
        out[text] = min(cost, out.get(text, cost))
    return out


NOISY = ["1d10t", "sssstup1d", "0", "a", "1111", "h3ll0", "|!1", "m0r0n", "fooool", "$c+m", "aaabbb11", "c00000l"]


@pytest.mark.parametrize("seed", range(4))
def test_decoded_text_is_the_cheapest_path(seed):
    rng = np.random.default_rng(seed)
    restorer = Restorer(rng.integers(0, 200, (SYMBOLS,) * 3) * (rng.random((SYMBOLS,) * 3) < 0.3).astype(float))
    letters = random.Random(seed)
    words = NOISY + ["".join(letters.choices("ab01!$e3", k=letters.randint(1, 7))) for _ in range(40)]
    for noisy in words:
        for apart in (False, True):
            if apart and len(noisy) > 6:
                continue
            paths = all_paths(restorer, noisy, apart)
            got = restorer.restore(noisy, apart)
            assert got in paths and paths[got] <= min(paths.values()) + 1e-9, (noisy, apart, got)


def test_character_counts_against_plain_counting(spark):
    rows = [(i, prose(i, 60).replace("w", "Mört")) for i in range(12)] + [(50, None), (51, ""), (52, "a É 中b x9y")]
    want = Counter()
    for _, text in rows:
        for word in LETTERS.findall((text or "").lower()):
            codes = [0, 0, *map(symbol, word), 0]
            want.update(zip(codes, codes[1:], codes[2:]))
    got = character_counts(documents(spark, rows).repartition(3))
    assert {tuple(map(int, k)): int(got[tuple(k)]) for k in np.argwhere(got)} == dict(want)
