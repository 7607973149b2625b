"""Texts and rows for the tests of the text operators."""

from __future__ import annotations

import random

VOWELS = "aeiou"


def invented(seed: int, words: int) -> str:
    draw = random.Random(seed)
    made = ("".join(draw.choice("bcdfglmnprst") + draw.choice(VOWELS) for _ in range(draw.randint(1, 4))) for _ in range(words))
    return " ".join(w + draw.choice(["", "", "", ".", ","]) for w in made)


def cases() -> list[tuple]:
    passage, base = invented(1, 80), invented(2, 120)
    changed = base.split()
    changed[60] = "zzz"
    texts = [
        (1, base), (2, base), (3, " ".join(changed)), (4, None), (5, ""), (6, " \t\n "), (7, "one two"),
        (8, invented(3, 30) + "\n" + passage), (9, passage + " " + invented(4, 30)), (10, "same line\nsame line\nother line"),
        (11, "é ü ñ <|endoftext|> #$% 'tis it's\u00a0x  two  spaces\n\nend "), (12, invented(5, 9000)), (13, "12 34 !!"),
        (None, passage), (14, passage), (14, passage), (15, "x" * 5000), (16, invented(6, 49)), (17, invented(7, 50)),
    ]
    return [(i, t, None if i in (3, None) else "aa" if (i or 0) % 2 else "bb", "src", 0) for i, t in texts]


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
