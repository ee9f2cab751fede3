"""Rows that hold every odd case."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words int, n_hit string, replica string, score string, n_lines string, key string, runs string, label string, value string, component_id string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]
    out = []
    for i in range(n):
        out.append(rng.choice(words).capitalize() if i % 9 == 0 else rng.choice(words))
        if i % 17 == 16:
            out.append("\n")
    return " ".join(out).replace(" \n ", ".\n")


def edited(text: str, seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    for _ in range(n):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def rows() -> list[tuple]:
    """Nulls in any column, empty and very long texts, ties and repeated rows, ids that repeat, and columns with clashing names."""
    a, b, c = prose(1, 220), prose(2, 180), prose(3, 400)
    texts = [
        (1, a), (2, a), (2, a), (3, edited(a, 1, 2)), (4, edited(a, 2, 3)), (5, b), (6, b.upper()), (7, None), (8, ""), (9, " \n\t \n"), (10, "word"), (11, "two words"),
        (None, a), (None, None), (12, c), (12, c + " more"), (13, edited(c, 5, 40)), (14, prose(4, 30_000)), (15, "x" * 700), (16, "ab" * 400), (17, "é" * 250 + "ß\x00ñ"),
        (18, "shared line of some words here\n" + prose(5, 60)), (19, prose(6, 60) + "\nshared line of some words here"), (20, b[:700] + prose(7, 20) + a[:500]),
    ]
    return [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 3 else f"src{k % 12}", None if t is None else len(t), k, "x", "y", None, "1", "k", None, "z", None, "q") for k, (i, t) in enumerate(texts)]
