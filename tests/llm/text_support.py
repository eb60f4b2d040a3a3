"""What the tests of the text operators share besides fixtures."""

import random

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def prose(rng, n, vocabulary=400):
    """n words of a small random language, in sentences and lines."""
    words = ["".join(random.Random(i).choices(LETTERS, k=2 + i % 7)) for i in range(vocabulary)]
    out = []
    for i in range(n):
        word = rng.choice(words)
        if i % 11 == 10:
            word += "." if i % 3 else ".\n"
        out.append(word)
    return " ".join(out)
