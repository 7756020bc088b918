"""Rows of odd documents: NULLs, empty, blank and long texts, ties and repeated rows."""

LONG = " ".join(f"word{i % 977} the of to" for i in range(12_000))
PLAIN = "the cat sat on the mat and looked at the dog for a long while"
EDGE = [
    (1, PLAIN, "en", "a"), (1, PLAIN, "en", "a"), (2, PLAIN.replace(" ", "\n\n"), "en", "a"), (3, PLAIN.upper(), None, None),
    (4, None, "en", "a"), (5, "", "de", "b"), (6, " \t\n", "de", "b"), (7, LONG, "en", "a"), (8, LONG + " end", "en", "a"),
    (None, "der hund lief über die straße und bellte", "de", "b"), (None, None, None, None), (9, "1234 !?", "de", "b"),
    (10, "write to bob.ray@mail.example.com or +1 (017) 555-7713, host 10.0.0.255", "en", "c"),
    (11, "card 4111 1111 1111 1111 not 4111 1111 1111 1112; ip 1.2.3.400 😀 é", "en", "c"), (12, "x", "fr", "c"),
    (13, "le chat est sur la table avec le chien", "fr", "c"), (100, "ab cd", "fr", "c"), (14, "7" * 30_000, "en", "a"),
]

# Vectors of three dimensions, two of them equal; the others are NULL, incomplete or not finite.
VECTORS = [(i, v, 0, i, None) for i, v in enumerate([
    [0.5, 1.0, -2.0], [0.25, -1.0, 2.0], [0.25, -1.0, 2.0], [3.0, 0.125, 1.0], [1.5, 2.5, 0.0], None, [], [1.0, 2.0], [None, 1.0, 2.0],
    [float("nan"), 1.0, 2.0], [1.0, float("-inf"), 2.0],
])]


def odd_rows(ids) -> list[str]:
    return sorted(map(str, ids))
