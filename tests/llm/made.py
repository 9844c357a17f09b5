"""Made-up texts for tests."""

from __future__ import annotations

import random


def words(n: int, seed: int = 0, size: int = 900) -> str:
    """``n`` made-up words."""
    pick = random.Random(seed)
    return " ".join(f"{pick.choice('bcdfglmnprst')}{pick.choice('aeiou')}{pick.choice('bcdfglmnprst')}{pick.randrange(size)}" for _ in range(n))
