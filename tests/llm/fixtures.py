"""Small corpora for the brute-force tests."""

from __future__ import annotations

import random
import re

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_key string, row int, size int"


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(UPPER))


def make_text(rng: random.Random, n: int) -> str:
    syllables = ["th", "er", "on", "an", "re", "ing", "é", "ß", "ou", "st"]
    out = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", ", ", ".\n"]) for w in out)


def corpus() -> list[tuple]:
    """Rows of SCHEMA: distinct texts, copies, near copies, a shared passage,
    NULLs, empty texts, a long one, rows given twice, NULL ids."""
    rng = random.Random(5)
    base = [make_text(rng, rng.randint(1, 120)) for _ in range(60)]
    passage = make_text(rng, 90)
    texts = list(base) + base[:8] + base[:4]
    for t in base[20:32]:
        parts = t.split(" ")
        if len(parts) > 40:
            parts[rng.randrange(len(parts))] = "changed"
        texts.append(" ".join(parts))
    texts += [make_text(rng, 10) + passage + make_text(rng, 10) for _ in range(6)]
    texts += ["", "", None, None, "   ", "one", "two words", "\n\n\n", "x" * 3000, "x" * 3000, make_text(rng, 6000)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], rows[40], (None, base[5]), (None, base[50]), (None, None)]
    rng.shuffle(rows)
    return [(i, t, "en", "s", len(t or ""), "clash", 1, 2) for i, t in rows]
