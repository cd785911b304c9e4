"""Texts for tests: seeded words, copies, edits."""

from __future__ import annotations

import random


def words(rng: random.Random, n: int, size: int = 400) -> list[str]:
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def sentence(seed: int, n: int = 60) -> str:
    return " ".join(words(random.Random(seed), n, 5000))


def edited(text: str, seed: int, changes: int) -> str:
    rng = random.Random(seed)
    out = text.split(" ")
    for i in rng.sample(range(len(out)), changes):
        out[i] = f"x{seed}n{i}"
    return " ".join(out)
