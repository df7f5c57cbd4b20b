"""Texts for the tests of this folder."""

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards brew potions under pale moons beside quiet rivers".split()


def sentence(start, n):
    return " ".join(WORDS[(start * 7 + k * (1 + start % 5)) % len(WORDS)] + str((start * 31 + k) % 97) for k in range(n))


#: Nulls, empty and blank texts, repeated rows and ids, a very long text and one without blanks.
ODD_TEXTS = [
    (1, sentence(1, 40)),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (None, sentence(2, 12)),
    (5, sentence(3, 30000)),
    (6, "x" * 50000),
    (7, sentence(1, 40)),
    (7, sentence(1, 40)),
    (8, "Ünïcödé “quotes” <|endoftext|> \x00\x1c tabs\tand  blanks\n\n\nend 'll 've 're"),
    (8, "another text under one id"),
    (9, "one"),
]

#: Columns named like those the operators make.
CLASHING = ("row", "n_tokens", "score", "hits", "items", "bits", "comp", "shard_id", "_alike", "label", "n", "id", "_SCORE", "_Dropped", "a.b", "tick`s", "Row.ID")
