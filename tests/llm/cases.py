"""Small tables that every operator is tried on."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as extra columns of the input.
CLASHING = ("_row", "w", "t", "n", "node", "block", "size", "shard", "id", "content", "key", "sim", "score", "rank", "kept", "rep")


def prose(n_words: int, seed: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice(["ti", "on", "er", "the", "an", "sh", "ble"]) for _ in range(rng.randint(1, 4))) for _ in range(n_words)]
    return "".join(w + (".\n" if i % 17 == 16 else " ") for i, w in enumerate(words)).strip() + "."


def documents(spark):
    """Prose, copies, near copies, shared passages, nulls, blanks, a long text, repeated rows and ids, other scripts."""
    base, passage = prose(120, 1), prose(60, 2)
    texts = [base, base, base + " extra words here.", prose(150, 3), None, "", " \n\t ", "word", "two words", "a b c", "Ünïcödé ☃ 漢字 " * 30]
    texts += [prose(80, 10 + i) + "\n" + passage + "\n" + prose(40, 30 + i) for i in range(6)]
    texts += ["A | b | c | d\n" * 40, "LOUD!! WORDS!! ONLY!! " * 40, "x### y%%% z&&& " * 50, "same same same " * 60, prose(3000, 77)]
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    rows += [(len(texts), texts[3], "de", None, None), (len(texts), texts[3], "de", None, None), (None, base, None, "src1", 5)]
    return spark.createDataFrame(rows, DOCS)


def with_clashes(docs):
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])


def empty(spark):
    return spark.createDataFrame([], DOCS)


def texts_of(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
