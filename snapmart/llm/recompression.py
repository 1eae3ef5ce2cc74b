"""Substring deduplication by recompression.

Every text is parsed bottom up, a round at a time: runs of two equal words become one symbol, then in each
pair round every symbol gets a side from its name and each (left, right) pair becomes one symbol. Names
are hashes of what they stand for, so all tasks give equal strings equal names without a dictionary, and
the choices depend on the symbols alone: two occurrences of a string are parsed alike except near its ends.

How near is bounded. A symbol is at most 2, 4, 8, 16 words wide after the rounds, and a round can disturb
one symbol at each end, so at most ``MARGIN`` = 2 + 2 + 4 + 8 words; in the middle of a window of ``WINDOW``
words the symbols of all its occurrences are equal. Hence a window that repeats in another document
consists, in its middle, of symbols that some other document has too. One exchange over the corpus tells
each block which of its symbols those are (see ``blocks``); only windows whose whole middle is shared are
left. These are verified by a 128-bit fingerprint of all their words in a second exchange, which answers
with the smallest document that holds the window anywhere. Words of windows that also start in a smaller
document go.

Defined results: null and empty texts have no words; texts shorter than a window lose nothing; rows that
repeat an id never remove each other; rows with a null id are left whole and remove nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from snapmart.llm.blocks import (BLOCK_CHARS, PART_KEYS, WIDE, chained, exchange, joined, part_count, texts_of,
                                 to_blocks, with_answers, word_hashes)
from snapmart.llm.common import id_type, sha256, stored

WINDOW = 50
RUN = 2
PAIR_ROUNDS = 3
MARGIN = 16  # words at each end of a window whose symbols may differ between its occurrences
NAME_BITS = 48  # of a symbol's name in the first exchange; a collision only adds windows to verify
NO_ONE = np.iinfo(np.int64).max


class Parsed:
    """Words, and for each word its document's place in the block, of a block of documents."""

    def __init__(self, block: dict):
        self.words = [raw.split() for raw in texts_of(block["sizes"], block["texts"])]
        self.ids = block["ids"]
        lengths = np.array([len(w) for w in self.words], np.int64)
        self.hashes = word_hashes([w for words in self.words for w in words])
        self.doc = np.repeat(np.arange(len(lengths)), lengths)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths

    def symbols(self) -> tuple[np.ndarray, np.ndarray]:
        """Name of every symbol after all rounds, and its first word."""
        name, at, doc = self.hashes, np.arange(len(self.hashes)), self.doc
        if len(name):
            name, at, doc = self.merge(name, at, doc, self.run_heads(name, doc), 1)
        for k in range(PAIR_ROUNDS):
            if len(name) > 1:
                side = chained([name], 101 + k) >> np.uint64(63) == 0
                heads = np.flatnonzero(side[:-1] & ~side[1:] & (doc[:-1] == doc[1:]))
                name, at, doc = self.merge(name, at, doc, heads, 11 + k)
        return name, at

    @staticmethod
    def run_heads(name: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """First positions of maximal runs of exactly ``RUN`` equal words."""
        fresh = np.ones(len(name), bool)
        fresh[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(fresh)
        return first[np.diff(np.append(first, len(name))) == RUN]

    @staticmethod
    def merge(name, at, doc, heads, seed):
        """Symbols with each head and its successor as one."""
        if not len(heads):
            return name, at, doc
        name = name.copy()
        name[heads] = chained([name[heads], name[heads + 1]], seed)
        keep = np.ones(len(name), bool)
        keep[heads + 1] = False
        return name[keep], at[keep], doc[keep]

    def names(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct symbol names, in how many documents of the block (2 for more), and each word's name."""
        name, at = self.symbols()
        name = name & ~np.uint64((1 << 64 - NAME_BITS) - 1)
        keys, of_symbol = np.unique(name, return_inverse=True)
        order = np.lexsort((self.doc[at], of_symbol))
        sym, doc = of_symbol[order], self.doc[at][order]
        new = np.ones(len(sym), bool)
        new[1:] = (sym[1:] != sym[:-1]) | (doc[1:] != doc[:-1])
        count = np.bincount(sym[new], minlength=len(keys))
        return keys, np.minimum(count, 2).astype(np.uint8), np.repeat(of_symbol, np.diff(np.append(at, len(self.doc))))

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Starts of the windows whose middle words all lie in shared symbols. shared: by distinct name."""
        if not len(self.doc):
            return np.zeros(0, np.int64)
        good = np.concatenate([[0], np.cumsum(shared[self.names()[2]])])
        usable = np.array([x is not None for x in self.ids], bool)
        at = np.arange(max(0, len(self.doc) - WINDOW + 1))
        at = at[(self.doc[at] == self.doc[at + WINDOW - 1]) & usable[self.doc[at]]]
        return at[good[at + WINDOW - MARGIN] - good[at + MARGIN] == WINDOW - 2 * MARGIN]

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct windows among those that start at ``at``: both halves of the fingerprint, the smallest
        id of a document that holds it, and which of them each start is."""
        one, two = (chained([self.hashes[at + k] for k in range(WINDOW)], seed) for seed in (21, 22))
        ids = np.array([NO_ONE if x is None else x for x in self.ids], np.int64)[self.doc[at]]
        order = np.lexsort((ids, two, one))
        new = np.ones(len(at), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        which = np.empty(len(at), np.int64)
        which[order] = np.cumsum(new) - 1
        first = order[new]
        return one[first], two[first], ids[first], which


def shared_symbols(blocks: DataFrame, part_keys: int = PART_KEYS, wide: int = WIDE) -> DataFrame:
    """For each block: whether each of its distinct names is in two or more documents of the corpus."""
    def asked(block: dict):
        keys, count, _ = Parsed(block).names()
        return keys, [count]

    def answered(keys: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
        _, inverse = np.unique(keys, return_inverse=True)
        return (np.bincount(inverse, columns[0])[inverse] > 1).astype(np.uint8)

    return exchange(blocks, asked, answered, [np.uint8], np.uint8, part_count(blocks, 0.08, part_keys), wide)


def first_holders(blocks: DataFrame, part_keys: int = PART_KEYS, wide: int = WIDE) -> DataFrame:
    """For each block with its ``shared`` answers: the smallest id that holds each distinct candidate."""
    def asked(block: dict):
        parsed = Parsed(block)
        one, two, ids, _ = parsed.windows(parsed.candidates(joined(block["shared"], np.uint8)))
        return one, [two, ids]

    def answered(keys: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
        two, ids = columns
        order = np.lexsort((ids, two, keys))
        new = np.ones(len(keys), bool)
        new[1:] = (keys[order][1:] != keys[order][:-1]) | (two[order][1:] != two[order][:-1])
        out = np.empty(len(keys), np.int64)
        out[order] = ids[order][new][np.cumsum(new) - 1]
        return out

    return exchange(blocks, asked, answered, [np.uint64, np.int64], np.int64, part_count(blocks, 0.05, part_keys), wide)


def removed_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    with_text: bool = False, block_chars: int = BLOCK_CHARS, part_keys: int = PART_KEYS,
                    wide: int = WIDE) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256, and kept_text if ``with_text``.
    ``block_chars``, ``part_keys`` and ``wide`` size the exchange of keys (see ``blocks``)."""
    blocks = to_blocks(docs, id_col, text_col, block_chars)
    spark_type = id_type(docs, id_col)
    if spark_type not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"ids must be integers, as the smaller one is kept: {spark_type}")
    shared = stored(shared_symbols(blocks, part_keys, wide), "shared_symbols")
    known = with_answers(blocks, shared=shared)
    holders = first_holders(known, part_keys, wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = {name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}
                yield pa.RecordBatch.from_pylist(
                    list(kept(block)), pa.schema([("doc_id", batch.schema.field("ids").type.value_type),
                                                  ("n_words", pa.int64()), ("n_removed", pa.int64()),
                                                  ("kept_sha256", pa.string()), ("kept_text", pa.string())]))

    def kept(block: dict) -> Iterator[dict]:
        parsed = Parsed(block)
        at = parsed.candidates(joined(block["shared"], np.uint8))
        smallest = joined(block["holders"], np.int64)
        ids = np.array([NO_ONE if x is None else x for x in parsed.ids], np.int64)
        edge = np.zeros(len(parsed.doc) + 1, np.int64)
        if len(at):
            at = at[smallest[parsed.windows(at)[3]] < ids[parsed.doc[at]]]
            np.add.at(edge, at, 1)
            np.add.at(edge, at + WINDOW, -1)
        gone = np.cumsum(edge)[:-1] > 0
        for words, a, b, doc_id in zip(parsed.words, parsed.starts.tolist(), parsed.ends.tolist(), parsed.ids):
            drop = gone[a:b]
            left = [w for w, d in zip(words, drop.tolist()) if not d] if drop.any() else words
            text = b" ".join(left)
            yield {"doc_id": doc_id, "n_words": b - a, "n_removed": int(drop.sum()), "kept_sha256": sha256(text),
                   "kept_text": text.decode() if with_text else None}

    out = with_answers(known, holders=holders).mapInArrow(
        run, f"doc_id {spark_type}, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string")
    return out if with_text else out.drop("kept_text")
