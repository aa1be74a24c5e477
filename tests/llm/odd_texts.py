"""Random texts for the tests."""

from __future__ import annotations

import random


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(n))
