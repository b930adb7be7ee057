"""Made-up texts."""

import random


def prose(seed: int, words: int) -> str:
    """Words of a small invented language."""
    chance = random.Random(seed)
    return " ".join("".join(chance.choices("abcdefghiklmnorstuvw", k=chance.randint(2, 7))) for _ in range(words))
