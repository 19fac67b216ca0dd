"""Small tables for the text operators' tests."""

from __future__ import annotations

import random
import zlib

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SYLLABLES = {
    "en": "the er an in on th re nd wh ou ing ed".split(),
    "de": "der sch ein ung ü ß ge ver ä ich zu".split(),
    "fr": "é le ai eau ou ç que ê ment eux".split(),
}
EDGE_TEXTS = [None, "", " ", "\n\n", "1234 !!", "a", "word " * 12, "x" * 30_000, "é" * 9_000, "a b c d", "A B C D"]


def prose(rng: random.Random, lang: str, words: int) -> str:
    syllables = SYLLABLES[lang]
    made = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(words)]
    lines = [" ".join(made[i : i + 12]) for i in range(0, words, 12)]
    return ".\n".join(line.capitalize() for line in lines)


def documents(count: int = 120, seed: int = 5) -> list[tuple]:
    """Prose, exact and near copies, common lines, and all edge texts."""
    rng = random.Random(seed)
    rows: list[tuple] = []
    spoken: list[str] = []
    for k in range(count):
        lang = rng.choice(sorted(SYLLABLES))
        text = prose(rng, lang, rng.randint(1, 150))
        if rows and (k % 7 == 3 or k % 5 == 2):
            copied = rng.randrange(len(rows))
            text, lang = rows[copied][1], spoken[copied]
        spoken.append(lang)
        if rows and k % 7 != 3 and k % 5 == 2:
            words = text.split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        rows.append((k, text, lang if k % 9 else None, f"src{k % 3}" if k % 11 else None, len(text)))
    for text in EDGE_TEXTS:
        rows.append((len(rows), text, None, "src0", None if text is None else len(text)))
    return rows


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def held(doc_id: int, modulus: int, remainder: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % modulus == remainder


def with_clashes(df):
    """Further columns, named like the operators' own."""
    from pyspark.sql import functions as F

    return df.withColumns({c: F.lit(-1) for c in ("n_words", "row", "host", "kept", "block", "a", "b", "tokens", "label2", "score", "lang_pred", "n_tokens", "factor", "expected", "copies", "m_source", "weight")})
