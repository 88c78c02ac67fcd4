"""Small documents tables with every awkward case, and brute-force helpers."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, blob string, words string, h long, score double"


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    syllables = ["the", "an", "er", "ing", "th", "on", "re", "st", "ble", "ou", "wh", "ed"]
    words = []
    for _ in range(n):
        words.append(r.choice(["the", "of", "and", "to", "in", "is"]) if r.random() < 0.35
                     else "".join(r.choice(syllables) for _ in range(r.randint(1, 4))))
        if r.random() < 0.12:
            words[-1] += r.choice([".", ",", ".\n"])
    return " ".join(words).replace("\n ", "\n")


def texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 300)
    passage = prose(2, 80)
    edited = base.split(" ")
    edited[100], edited[200] = "changed", "words"
    return [
        (3, base), (5, base), (9, " ".join(edited)), (7, None), (8, ""), (10, " \t\n "),
        (11, "one two three"), (12, "one  two\nthree"), (13, prose(3, 60) + " " + passage + " " + prose(4, 60)),
        (14, passage + " " + prose(5, 90)), (14, passage + " " + prose(5, 90)), (15, "a" * 700), (16, "ab" * 400),
        (17, "Größe überall " * 60), (18, prose(6, 30000)), (None, base), (None, None),
        (19, prose(7, 55) + '\npassword = "hunter2hunter" token:abc secret=token:abcdefgh AKIA' + "A1" * 9 + " " + "0af9" * 8),
        (20, "Licensed under the Apache Licence, Version 2.0. All rights reserved. CC BY cc by cc-by. General Public License."),
        (21, "日本語 テスト 🎉 x <|endoftext|> İstanbul ﬁ naïve é ΣΑΣ don't 12,34 ==   nbsp \x1c y"),
        (-4, "ab"), (22, "\n".join(["| a | b |"] * 60)), (23, ("WORDS!! " * 70)),
        (24, "\n".join(["same line here."] * 30)), (25, prose(8, 200)), (26, prose(8, 200).upper()), (27, "x"),
    ]


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame(
        [(i, t, "en" if k % 3 else None, f"s{k % 2}", len(t or ""), "blob", "w", k, 0.5) for k, (i, t) in enumerate(rows)],
        SCHEMA).repartition(3)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def ordered(rows):
    """Rows by doc_id, null last, then by text."""
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
