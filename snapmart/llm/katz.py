"""Language-model scoring: a Katz back-off model with Good-Turing discounts.

    P(w | u) = d(c) * c(u, w) / c(u)      if the pair was seen c(u, w) > 0 times
             = alpha(u) * P(w)            else, one order down
    P(w)     = d(c) * c(w) / N            if the word was seen; else the mass that is left, for one
                                          unknown word

Pairs and words seen up to ``CUTOFF`` times are discounted by Good-Turing estimates from the corpus's own
counts of counts (absolute discounting where these are too thin to be valid). alpha(u) is the exact
quotient of what the discounts leave in u and of what P gives to the words not seen after u, so that for
every context the probabilities of all known words and the unknown one sum to 1.

Counts are kept in tables partitioned by ranges of the key space in the shared folder (see ``blocks``):
words with their counts, pairs with theirs, contexts with the sums that alpha needs. They follow the corpus; a frequent
context is spread over parts by its next word, in proportion to its count, and its sums meet again by
context. Blocks of documents ask for the words, pairs and contexts they hold and score their tokens from
the answers; only counts of counts come to the driver.

Words are known by 64-bit hashes. Defined results: a null or empty text is its end token alone; rows with a
null id are scored but not learned from; without training rows every probability is 1.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.blocks import (LOWER, ask, chained, joined, pack, pack_sorted, part_count, part_edges, part_of,
                                 texts_of, to_blocks, unpack, unpack_sorted, with_answers, word_hashes)
from snapmart.llm.common import id_type, stored

CUTOFF = 5
TRUST = 1 - 1e-6  # factor on larger counts, so that no context is left without mass for unseen words
FOLDS, HELD_OUT = 7, 2
MODEL = -1  # in place of a block: rows of the model's tables

#: No word holds a space, so these are no words.
END, START = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b" end", b" start"))


def held_out(doc_id) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


class Tokens:
    """The tokens of a block: for each its document, its word and context among the block's words."""

    def __init__(self, block: dict):
        words = [raw.translate(LOWER).split() for raw in texts_of(block["sizes"], block["texts"])]
        self.ids = block["ids"]
        self.out = np.array([held_out(x) for x in self.ids], bool)
        train = np.array([x is not None for x in self.ids], bool) & ~self.out
        size = np.array([len(w) + 1 for w in words], np.int64)
        self.doc = np.repeat(np.arange(len(size)), size)
        hashes = np.empty(len(self.doc), np.uint64)
        last = np.cumsum(size) - 1
        is_word = np.ones(len(hashes), bool)
        is_word[last] = False
        hashes[is_word] = word_hashes([w for ws in words for w in ws])
        hashes[last] = END
        self.words, inverse = np.unique(np.append(hashes, START), return_inverse=True)
        self.word, self.start = inverse[:-1], int(inverse[-1])
        self.context = np.concatenate([[self.start], self.word[:-1]]).astype(np.int64)[:len(self.word)]
        self.context[last + 1 - size] = self.start
        self.train = train[self.doc]

    def wanted(self) -> np.ndarray:
        """Words that are contexts outside the training documents: only there pairs can be unseen."""
        return np.bincount(self.context[~self.train], minlength=len(self.words)) > 0

    def word_ids(self, ranks: np.ndarray, parts: int) -> np.ndarray:
        """Short ids of the block's words: their part and their rank in it."""
        return part_of(self.words, parts).astype(np.uint64) << np.uint64(32) | ranks

    def counts(self) -> np.ndarray:
        """Training occurrences of each word; of the start, as often as it is a context."""
        out = np.bincount(self.word[self.train], minlength=len(self.words))
        out[self.start] = np.count_nonzero(self.train & (self.context == self.start))
        return out

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, word) pairs, their training occurrences, and each token's pair."""
        code = self.context * len(self.words) + self.word
        keys, which = np.unique(code, return_inverse=True)
        return (keys // len(self.words), keys % len(self.words),
                np.bincount(which[self.train], minlength=len(keys)), which)


def routes(uid: np.ndarray, wid: np.ndarray, count: np.ndarray, tokens_in_all: int, parts: int) -> np.ndarray:
    """Part of each pair. A context (seen ``count`` times) with more than a part's share of all tokens is
    spread by the next word."""
    ways = (count * parts // max(1, tokens_in_all) + 1).astype(np.uint64)
    return part_of(chained([uid, wid % ways], 3), parts)


# -- discounts -----------------------------------------------------------------------------------

def good_turing(seen: list[int]) -> np.ndarray:
    """Factor for counts 0 .. CUTOFF + 1 (the last for all larger ones) from the numbers of n-grams seen
    1, 2, .. CUTOFF + 1 times."""
    d = np.append(np.ones(CUTOFF + 1), TRUST)
    r = np.arange(1, CUTOFF + 1)
    last = (CUTOFF + 1) * seen[CUTOFF] / seen[0] if seen[0] else 1
    if all(seen) and last < 1:
        n = np.array(seen, float)
        d[1:-1] = ((r + 1) * n[1:] / (r * n[:-1]) - last) / (1 - last)
        if (d[1:-1] > 0).all() and (d[1:-1] < 1).all():
            return d
    less = seen[0] / (seen[0] + 2 * seen[1]) if seen[0] else 0.5
    d[1:-1] = 1 - (less if less < 1 else 0.5) / r
    return d


class Words:
    """The lowest order."""

    def __init__(self, stats: list[int]):
        self.tokens, self.distinct, *seen = stats
        self.discount = good_turing(seen)
        r = np.arange(1, CUTOFF + 1)
        small = np.array(seen[:CUTOFF])
        kept = (self.discount[1:-1] * r) @ small + TRUST * (self.tokens - r @ small)
        self.left = float(1 - kept / self.tokens) if self.tokens else 1.0

    def p(self, count: np.ndarray) -> np.ndarray:
        known = self.discount[np.minimum(count, CUTOFF + 1)] * count / max(1, self.tokens)
        return np.where(count > 0, known, self.left)


def mass_left(seen: np.ndarray, discount: np.ndarray) -> np.ndarray:
    """What the discounts leave in contexts with ``seen`` next words: their numbers by count 1 .. CUTOFF, and
    the sum of larger counts."""
    r = np.append(np.arange(1, CUTOFF + 1), 1)
    return 1 - (seen @ (r * discount[1:])) / np.maximum(seen @ r, 1)


# -- tables --------------------------------------------------------------------------------------

def tally(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, CUTOFF + 2), minlength=CUTOFF + 3)[1:CUTOFF + 2].tolist()


def summed_stats(table: DataFrame) -> list[int]:
    rows = table.where(F.col("stats").isNotNull()).select(F.posexplode("stats").alias("i", "n"))
    found = {r["i"]: r["n"] for r in rows.groupBy("i").agg(F.sum("n").alias("n")).collect()}
    return [found.get(i, 0) for i in range(CUTOFF + 3)]


def word_table(blocks: DataFrame, parts: int) -> DataFrame:
    """For each block the counts of its words, their ranks in their part and which are wanted as contexts;
    MODEL rows with each part's words and counts."""
    def asked(block: dict):
        tokens = Tokens(block)
        return tokens.words, [tokens.counts(), tokens.wanted()]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(x) for x in group["keys"]]
        words, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, np.concatenate([unpack(x, np.int64) for x in group["x0"]])).astype(np.int64)
        ranks = np.split(which.astype(np.uint64), np.cumsum([len(k) for k in keys])[:-1])
        known = (total > 0) & (words != START)
        stats = [int(total[known].sum()), int(known.sum()), *tally(total[known])]
        return pd.DataFrame({
            "block": [*group["block"], MODEL], "part": [*group["part"], group["part"].iloc[0]],
            "keys": [pack_sorted(x) for x in [*ranks, words[known]]],
            "counts": [pack(x) for x in [*(total[r.astype(np.int64)] for r in ranks), total[known]]],
            "wanted": [*group["x1"], None], "stats": [None] * len(group) + [stats]})

    return stored(ask(blocks, asked, parts, 2).groupBy("part").applyInPandas(
        run, "block bigint, part bigint, keys binary, counts binary, wanted binary, stats array<bigint>"),
        "katz_words")


def of_block(block: dict, word_parts: int) -> tuple[Tokens, np.ndarray, np.ndarray]:
    """Tokens of a block that knows its words, with their ids and counts."""
    tokens = Tokens(block)
    ranks = np.concatenate([unpack_sorted(x) for x in block["ranks"]])
    return tokens, tokens.word_ids(ranks, word_parts), joined(block["words"], np.int64)


def pair_table(known: DataFrame, words: Words, word_parts: int, parts: int) -> DataFrame:
    """For each block the counts of its pairs; MODEL rows with the sums of each part's contexts.
    known: blocks that know their words."""
    def asked(block: dict):
        tokens, ids, total = of_block(block, word_parts)
        context, word, count, _ = tokens.pairs()
        part = routes(ids[context], ids[word], total[context], words.tokens, parts)
        order = np.lexsort((ids[word], ids[context], part))
        context, word = context[order], word[order]
        return ids[context], [ids[word], count[order], total[word]], part[order]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(x) for x in group["keys"]]
        key = np.concatenate(keys)
        word, count, word_count = (np.concatenate([unpack(x, t) for x in group[f"x{i}"]])
                                   for i, t in enumerate((np.uint64, np.int64, np.int64)))
        order = np.lexsort((word, key))
        new = np.ones(len(key), bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (word[order][1:] != word[order][:-1])
        first = np.flatnonzero(new)
        total = np.add.reduceat(count[order], first)
        answer = np.empty(len(key), np.int64)
        answer[order] = total[np.cumsum(new) - 1]
        # sums of the seen pairs by context
        at, seen = order[first][total > 0], total[total > 0]
        contexts, which = np.unique(key[at], return_inverse=True)
        sums = [np.bincount(which[seen == r], minlength=len(contexts)) for r in range(1, CUTOFF + 1)]
        sums.append(np.bincount(which, np.where(seen > CUTOFF, seen, 0), minlength=len(contexts)).astype(np.int64))
        below = np.bincount(which, words.p(word_count[at]), minlength=len(contexts))
        n = len(group)
        return pd.DataFrame({
            "block": [*group["block"], MODEL], "part": [*group["part"], group["part"].iloc[0]],
            "keys": [None] * n + [pack_sorted(contexts)],
            "counts": [pack(x) for x in np.split(answer, np.cumsum([len(k) for k in keys])[:-1])] + [None],
            "sums": [None] * n + [pack(np.stack(sums).ravel().astype(np.int64))],
            "below": [None] * n + [pack(below)], "stats": [None] * n + [[0, 0, *tally(seen)]]})

    return stored(ask(known, asked, parts, 3).groupBy("part").applyInPandas(
        run, "block bigint, part bigint, keys binary, counts binary, sums binary, below binary, "
             "stats array<bigint>"), "katz_pairs")


def context_table(words: DataFrame, pairs: DataFrame, discount: np.ndarray) -> DataFrame:
    """For each block alpha of the contexts it wants. The sums of a context meet at its word's part."""
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                keys = unpack_sorted(batch.column(0)[row].as_py())
                sums = unpack(batch.column(1)[row].as_py(), np.int64).reshape(CUTOFF + 1, -1)
                below = unpack(batch.column(2)[row].as_py(), np.float64)
                if not len(keys):
                    continue
                part, cuts = part_edges((keys >> np.uint64(32)).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([MODEL] * len(part), pa.int64()), pa.array(part),
                     pa.array([pack_sorted(keys[a:b] & np.uint64(0xFFFFFFFF)) for a, b in cuts]),
                     pa.nulls(len(part), pa.binary()),
                     pa.array([pack(sums[:, a:b].ravel()) for a, b in cuts]),
                     pa.array([pack(below[a:b]) for a, b in cuts])],
                    ["block", "part", "keys", "wanted", "sums", "below"])

    schema = "block bigint, part bigint, keys binary, wanted binary, sums binary, below binary"
    sums = pairs.where(F.col("block") == MODEL).select("keys", "sums", "below").mapInArrow(dealt, schema)
    none = F.lit(None).cast("binary")
    asks = words.where(F.col("block") != MODEL).select(
        "block", "part", "keys", "wanted", none.alias("sums"), none.alias("below"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        sums = group[group["block"] == MODEL]
        group = group[group["block"] != MODEL]
        ranks = [unpack_sorted(k)[unpack(w, bool)].astype(np.int64) for k, w in zip(group["keys"], group["wanted"])]
        size = 1 + max((int(r[-1]) for r in ranks if len(r)), default=0)
        alpha = np.ones(size)  # a context that was never seen hands everything down
        if len(sums):
            at = np.concatenate([unpack_sorted(x) for x in sums["keys"]]).astype(np.int64)
            rows = np.concatenate([unpack(x, np.int64).reshape(CUTOFF + 1, -1).T for x in sums["sums"]])
            lower = np.concatenate([unpack(x, np.float64) for x in sums["below"]])
            asked_for = at < size
            at, rows, lower = at[asked_for], rows[asked_for], lower[asked_for]
            order = np.lexsort((lower, at))  # one order of adding, whatever order the rows came in
            seen, below = np.zeros((size, CUTOFF + 1), np.int64), np.zeros(size)
            np.add.at(seen, at[order], rows[order])
            np.add.at(below, at[order], lower[order])
            known = seen.any(1)
            alpha[known] = mass_left(seen[known], discount) / (1 - below[known])
        return pd.DataFrame({"block": group["block"], "part": group["part"], "answer": [pack(alpha[r]) for r in ranks]})

    return asks.unionByName(sums).groupBy("part").applyInPandas(run, "block bigint, part bigint, answer binary")


# -- scores --------------------------------------------------------------------------------------

def katz_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    blocks = to_blocks(docs, id_col, text_col, level=9)
    word_parts, parts = part_count(blocks, 0.04), part_count(blocks, 0.24)
    word_rows = word_table(blocks, word_parts)
    words = Words(summed_stats(word_rows))
    answers = word_rows.where(F.col("block") != MODEL)
    known = with_answers(blocks, words=answers.select("block", "part", F.col("counts").alias("answer")),
                         ranks=answers.select("block", "part", F.col("keys").alias("answer")))
    pairs = pair_table(known, words, word_parts, parts)
    discount = good_turing(summed_stats(pairs)[2:])
    contexts = context_table(word_rows, pairs, discount)
    counts = pairs.where(F.col("block") != MODEL).select("block", "part", F.col("counts").alias("answer"))
    smoothed = words.tokens + words.distinct + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = {name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}
                tokens, ids, total = of_block(block, word_parts)
                context, word, _, which = tokens.pairs()
                part = routes(ids[context], ids[word], total[context], words.tokens, parts)
                seen = np.empty(len(part), np.int64)
                seen[np.lexsort((ids[word], ids[context], part))] = joined(block["pairs"], np.int64)
                alpha = np.ones(len(total))
                alpha[tokens.wanted()] = joined(block["contexts"], np.float64)
                p = np.where(seen > 0, discount[np.minimum(seen, CUTOFF + 1)] * seen / np.maximum(total[context], 1),
                             alpha[context] * words.p(total[word]))
                base = np.log10((total[tokens.word] + 1) / smoothed)
                n = len(tokens.ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.ids, batch.schema.field("ids").type.value_type), pa.array(tokens.out),
                     pa.array(np.bincount(tokens.doc, minlength=n)),
                     pa.array(np.bincount(tokens.doc[total[tokens.word] > 0], minlength=n)),
                     pa.array(np.full(n, words.tokens, np.int64)),
                     pa.array(np.bincount(tokens.doc, base, minlength=n)),
                     pa.array(np.bincount(tokens.doc, np.log10(p)[which], minlength=n))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    scored = with_answers(known, pairs=counts, contexts=contexts)
    return scored.mapInArrow(run, f"doc_id {id_type(docs, id_col)}, held_out boolean, n_tokens bigint, "
                                  "n_known bigint, train_tokens bigint, base_score double, score double")
