"""Toxicity by a weighted lexicon, matched by Aho-Corasick on folded text.

Folding undoes disguises: letters that look alike in other scripts, full-width letters, digits and signs
used for letters, invisible characters. Everything that is no letter separates words.

The lexicon is learned from labels: word stems (the first ``STEM_LENGTHS`` letters) and whole words whose
presence tells toxic documents from clean ones, weighted by their log odds. Of nested stems with the same
evidence the longest is kept, of a stem and a more special one the stem. Phrases around a lexicon word
that are found mostly in clean documents are exceptions and cancel the match inside them. The summed
weights are normalised by text length and turned into a probability by a logistic fit.

Labels are used from a bounded sample: the ``TRAIN_ROWS`` labelled rows with the smallest hash of their
id, held-out rows excluded. Defined results: null, empty and never matching texts get the score of no
match; without labels of both classes every score is 0.0. Rows with null ids are scored, not learned from.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import id_and_text, id_type, stored

TRAIN_ROWS = 20_000
TRAIN_PARTS = 32         # tasks that share the sample
FOLDS, HELD_OUT = 5, 0
STEM_LENGTHS = range(3, 9)
MIN_DOCUMENTS = 8       # toxic training documents that must hold an entry
MIN_WEIGHT = 2.0        # log odds of an entry
LEXICON_ENTRIES = 5_000
MIN_EXCEPTION = 8       # clean training documents that must hold an exception phrase

#: Letters of other scripts that look like Latin ones, and signs used for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "о": "o", "р": "p",
    "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ѵ": "v", "ո": "n", "ց": "g", "ս": "u",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
}
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}
INVISIBLE = "­​‌‍⁠﻿"


class Fold(dict):
    """Translation table of lower-cased text, filled as characters are met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if 0xFF01 <= code <= 0xFF5E:  # full-width forms of printable ASCII
            out = self[ord(chr(code - 0xFEE0).lower())]
        elif c in LOOKALIKES or c in SIGNS:
            out = LOOKALIKES.get(c) or SIGNS[c]
        elif c in INVISIBLE:
            out = ""
        else:
            out = c if c.isalpha() else " "
        self[code] = out
        return out


def words_of(text: str, table: Fold) -> list[str]:
    """Folded words. Signs at the ends of a word are punctuation, not letters."""
    out = []
    for word in text.lower().split():
        core = word.strip("!|@$.,;:?\"'()[]{}<>*#%&-_=+~`/\\")
        out += core.translate(table).split()
    return out


def train_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, label_col: str = "toxic") -> DataFrame:
    """text and label of the bounded training sample, stored, as it is read several times. Its ids are few, so
    they go to the documents; of rows that repeat an id one is taken, so the sample stays bounded."""
    labelled = labels.where(F.col("doc_id").isNotNull() & F.col(label_col).isNotNull()).where(
        F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_OUT)
    sample = labelled.groupBy("doc_id").agg(F.max(label_col).alias("label")).orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
        F.min("text").alias("text"), F.max("label").alias("label"))
    return stored(found.repartition(TRAIN_PARTS, "doc_id").select("text", "label"), "toxicity_sample")


def learn(sample: DataFrame) -> dict:
    """Lexicon, exceptions and logistic weights."""
    totals = {int(r["label"]): r["count"] for r in sample.groupBy("label").count().collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    model = {"entries": {}, "exceptions": [], "fit": None}
    if not clean or not toxic:
        return model
    counts = sample.mapInArrow(_count_features, "feature string, toxic bigint, clean bigint")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    weight = F.log((F.col("toxic") + 0.5) / (toxic - F.col("toxic") + 0.5)) - F.log(
        (F.col("clean") + 0.5) / (clean - F.col("clean") + 0.5))
    entries = counts.where(F.col("toxic") >= MIN_DOCUMENTS).withColumn("weight", weight).where(
        F.col("weight") >= MIN_WEIGHT).orderBy(F.desc("toxic"), "feature").limit(LEXICON_ENTRIES)
    found = {r["feature"]: (r["toxic"], r["clean"], r["weight"]) for r in entries.collect()}
    model["entries"] = nested(found)
    model["exceptions"] = exceptions(sample, model["entries"], toxic, clean)
    model["fit"] = fit(sample, model)
    return model


def _features(words: set[str]) -> set[str]:
    out = {f" {w} " for w in words if len(w) >= STEM_LENGTHS[0]}
    for n in STEM_LENGTHS:
        out.update(" " + w[:n] for w in words if len(w) >= n)
    return out


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, toxic, clean = Fold(), Counter(), Counter()

    def counted() -> pa.RecordBatch:
        keys = list(toxic | clean)
        batch = pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([toxic[k] for k in keys], pa.int64()),
             pa.array([clean[k] for k in keys], pa.int64())], ["feature", "toxic", "clean"])
        toxic.clear(), clean.clear()
        return batch

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            (toxic if label else clean).update(_features(set(words_of(text, table))))
            if len(toxic) + len(clean) > 500_000:
                yield counted()
    if toxic or clean:
        yield counted()


def nested(found: dict[str, tuple]) -> dict[str, float]:
    """Entry -> weight without entries that another one already says."""
    out = {}
    for feature, (toxic, clean, weight) in found.items():
        stem = feature.rstrip()
        longer = [x for x in ([feature.rstrip() + " "] if feature == stem else [])] + (
            [x for x in found if len(x.rstrip()) == len(stem) + 1 and x.startswith(stem)] if feature == stem else [])
        if any(found[x][0] == toxic and found[x][1] == clean for x in longer if x in found):
            continue  # the same documents, by a more exact entry
        shorter = [stem[:n] for n in range(len(stem) - (feature == stem), 3, -1) if stem[:n] in found]
        if any(found[x][0] > toxic and found[x][2] >= weight - 0.5 for x in shorter):
            continue  # a stem that is as telling covers it
        out[feature] = weight
    return out


class Matcher:
    """Summed weights of the lexicon in a text. Overlapping entries of one word count as its strongest."""

    def __init__(self, model: dict):
        self.table, self.automaton = Fold(), ahocorasick.Automaton()
        for entry, weight in model["entries"].items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in model["exceptions"]:
            self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, None))
        self.empty = not len(self.automaton)
        self.automaton.make_automaton()

    def spans(self, folded: str) -> dict[int, float]:
        """Weight by the position of the matched word."""
        hits: dict[int, float] = {}
        excused = []
        if self.empty:
            return hits
        for end, (length, weight) in self.automaton.iter(folded):
            start = end - length + 1
            if weight is None:
                excused.append((start, end))
            else:
                hits[start] = max(weight, hits.get(start, 0.0))
        for a, b in excused:
            for start in [s for s in hits if a <= s < b]:
                del hits[start]
        return hits

    def measure(self, text: str) -> float:
        words = words_of(text, self.table)
        weights = self.spans(f" {' '.join(words)} ").values()
        return sum(weights) / math.sqrt(max(len(words), 25))


def exceptions(sample: DataFrame, entries: dict[str, float], toxic: int, clean: int) -> list[str]:
    """Two-word phrases around a lexicon word that speak for a clean document."""
    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, counts = Matcher({"entries": entries, "exceptions": []}), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folded = f" {' '.join(words_of(text, matcher.table))} "
                seen = set()
                for start in matcher.spans(folded):
                    end = folded.index(" ", start + 1)
                    word = folded[start + 1:end]
                    before, after = folded[:start].rsplit(" ", 1)[-1] if start else "", folded[end + 1:].split(" ", 1)[0]
                    seen |= {f"{before} {word}"} if before else set()
                    seen |= {f"{word} {after}"} if after else set()
                counts.update((p, label) for p in seen)
        if counts:
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in counts]), pa.array([n if t else 0 for (_, t), n in counts.items()], pa.int64()),
                 pa.array([0 if t else n for (_, t), n in counts.items()], pa.int64())], ["phrase", "toxic", "clean"])

    if not entries:
        return []
    seen = sample.mapInArrow(phrases, "phrase string, toxic bigint, clean bigint").groupBy("phrase").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # more than twice as common in clean documents, rate for rate
    rows = seen.where((F.col("clean") >= MIN_EXCEPTION) & (F.col("clean") / clean > 2 * F.col("toxic") / toxic))
    return [r["phrase"] for r in rows.orderBy(F.desc("clean"), "phrase").limit(LEXICON_ENTRIES).collect()]


def fit(sample: DataFrame, model: dict) -> tuple[float, float]:
    """Logistic weights (slope, intercept) of the normalised sum, by Newton steps on the bounded sample."""
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        for batch in batches:
            x = [matcher.measure(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1).cast(pa.int32())], ["x", "y"])

    rows = sample.mapInArrow(measured, "x double, y int").collect()  # at most TRAIN_ROWS
    x = np.array([r["x"] for r in rows])
    y = np.array([float(r["y"] > 0) for r in rows])
    design = np.stack([x, np.ones_like(x)])
    theta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(theta @ design, -30, 30)))
        ridge = 1e-3 * np.array([1.0, 0.0])
        gradient = design @ (y - p) - ridge * theta
        hessian = (design * (p * (1 - p))) @ design.T + np.diag([1e-3, 1e-9])
        theta = theta + np.clip(np.linalg.solve(hessian, gradient), -4, 4)
    return float(theta[0]), float(theta[1])


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    texts = id_and_text(docs, id_col, text_col)
    model = learn(train_rows(texts, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(model)
        slope, intercept = model["fit"] or (0.0, -math.inf)
        for batch in batches:
            x = (slope * matcher.measure(t) + intercept for t in batch.column(1).to_pylist())
            score = [1 / (1 + math.exp(-max(-30.0, min(30.0, v)))) if v > -math.inf else 0.0 for v in x]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32())],
                ["doc_id", "score", "predicted"])

    scored = texts.mapInArrow(run, f"doc_id {id_type(docs, id_col)}, score double, predicted int")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")
