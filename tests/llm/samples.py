"""Invented texts."""

import random

WORDS = "the quick brown fox jumps over a lazy dog while seven wise owls watch from old trees near some quiet river".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 40)) for _ in range(n)) + "."
