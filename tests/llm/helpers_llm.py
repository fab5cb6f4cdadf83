"""Small document tables with the awkward cases, and plain reference versions."""

import random

DOC = "doc_id long, text string, lang string, source string, n_chars int"


def documents(spark, texts, extra=False):
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in (texts.items() if isinstance(texts, dict) else enumerate(texts))]
    df = spark.createDataFrame(rows, DOC)
    if extra:       # names that the operators use themselves
        for c in ("score", "z", "h", "path", "node", "cell", "contaminated", "pii", "gone", "n_words", "wh"):
            df = df.selectExpr("*", f"'x' as {c}")
    return df


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}
