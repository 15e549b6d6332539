"""Texts for the tests of the operators on documents."""

import random


def prose(rng: random.Random, n: int, words=400) -> str:
    return " ".join(rng.choice("abcdefgh") + str(rng.randrange(words)) for _ in range(n))


#: Texts that every operator must take: null, empty, white space, one word, signs only, beyond ASCII, a long one.
ODD = [
    (900, None), (901, ""), (902, " \t\n "), (903, "word"), (904, "!!! ??? ..."), (905, "ÉTÉ Ünï 漢字 ß İstanbul"), (906, "\n\na\n\n"),
    (907, "very long " * 30_000), (None, "no id here"), (908, "twin"), (908, "twin"), (909, "same id one"), (909, "same id two"),
]
