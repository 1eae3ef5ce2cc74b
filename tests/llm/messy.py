"""A small table with everything that can go wrong in one, and brute-force versions of the operators."""

import random
import re
from collections import Counter

from pyspark.sql import types as T

#: Extra columns whose names clash with columns the operators use inside.
CLASHES = ["block", "key", "row", "node", "n", "label", "slot", "rank", "bucket", "held_out", "kept", "score"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())]
                      + [T.StructField(c, T.StringType()) for c in CLASHES])
WORD = re.compile("[^\x20\x09-\x0d]+")
VOCABULARY = ["Ort", "über", "the", "of", "and", "Zug", "lane", "river", "moss", "Kern", "été", "vaso", "nine", "toll",
              "ash", "ember", "quill", "frost", "basin", "copper"]


def prose(rng: random.Random, words: int) -> str:
    out = []
    for i in range(words):
        out.append("".join(rng.choice(VOCABULARY) for _ in range(rng.randint(1, 2))))
        out.append(rng.choice([" "] * 8 + ["\n", ", ", ". ", "  "]))
    return "".join(out)


def texts() -> list[str | None]:
    rng = random.Random(11)
    base = [prose(rng, rng.randint(60, 300)) for _ in range(14)]
    passage = prose(rng, 70)
    words = base[0].split(" ")
    near = " ".join([*words[:-2], "changed", "ending"])
    shifted = " ".join(["new", "start", *words])
    return [None, "", " \n\t ", "one", "one", "ONE", "a b c", *base, base[0], base[0].upper(), near, shifted,
            base[1] + " " + passage, passage + " " + base[2], passage, "\U0001f600 \x1c\x85 \xa0x", "x" * 5000,
            "la " * 400, "the the the of of of " * 60, prose(rng, 30_000)]


def rows() -> list[tuple]:
    out = [(i * 3 + 1, t) for i, t in enumerate(texts())]
    out += [out[8], out[8], (out[9][0], "another text of a repeated id"), (None, base_text(out, 8)), (None, None), (-5, "one")]
    return [(i, t, None, "src" if i else None, None if i is None else 1, *["c"] * len(CLASHES)) for i, t in out]


def base_text(rows, at):
    return rows[at][1]


def messy(spark):
    return spark.createDataFrame(rows(), SCHEMA).coalesce(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs() -> list[tuple]:
    """(doc_id, text) with nulls as empty texts."""
    return [(r[0], r[1] or "") for r in rows()]


def words(text: str) -> list[str]:
    return WORD.findall(text)


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def repeat_words(ws: list[str], size: int = 8) -> int:
    windows = [tuple(ws[i:i + size]) for i in range(len(ws) - size + 1)]
    often = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(size)})
