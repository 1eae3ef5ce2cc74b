"""Periodic runs of words: an online sparse diagonal DP.

A run of period q is a maximal stretch in which words q apart are the same. On the diagonal of lag q it is a
row of matches, word against the word q earlier. The words of a document are passed from left to right,
their earlier occurrences increment the match lengths of the lags that are active, and a diagonal that ends
with a sufficient length gives a run at once.

Frequent words would open nearly every lag. So lags are taken by octaves, q in [B, 2B) for B = 1, 2, 4, ...,
and in an octave the words are read B at a time: the occurrences of the B words that start at a multiple of
B are looked for B to 2B-1 words earlier, and each increments the length of its lag by B. A sufficient run has
enough whole blocks among its matches; its two ends are then found word by word. (For B = 1 this is the DP
word by word.) Blocks inside a run already found with a shorter period are left out: a lag that fits there is
a multiple of that period and no smallest period (Fine and Wilf). Each octave costs a number of steps in
proportion to the words, however often they repeat, so a text of n words costs n log n.

Block hashes only choose what to compare; every run comes from comparing words.

Defined results: a null or empty text has no words and no runs. Rows with a null id, repeated rows and ids
give one result each. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from snapmart.llm.common import id_and_text, id_type

#: A run has at least this many words, and at least this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
MIX = np.uint64(0x9E3779B97F4A7C15)
TURN = np.uint64(31)

Run = tuple[int, int, int]  # start, length, period
Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def runs_of(words: list[bytes]) -> list[Run]:
    """All runs of a text, by start and then period."""
    n = len(words)
    if n < LEAST_WORDS:
        return []
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, n)
    if len(names) == n:
        return []
    blocks, size = ids.view(np.uint64), 1
    reach = np.full(n, -1)  # last word of the runs found that hold this word
    found: list[Run] = []
    while max(LEAST_WORDS, LEAST_PERIODS * size) <= n:
        new = octave(ids, blocks, size, reach)
        for start, length, _ in new:
            reach[start:start + length] = np.maximum(reach[start:start + length], start + length - 1)
        found += new
        blocks = (blocks[:-size] * MIX) ^ (blocks[size:] + (blocks[size:] >> TURN))  # hashes of twice the words
        size *= 2
    return sorted(found, key=lambda run: (run[0], run[2]))


def octave(ids: np.ndarray, blocks: np.ndarray, size: int, reach: np.ndarray) -> list[Run]:
    """The runs with a period of ``size`` to 2 * ``size`` - 1 words."""
    n = len(ids)
    steps = n // size - 1
    # row r: the blocks at (r - 1) * size + 1 ... r * size, against the block at (r + 1) * size
    earlier = np.concatenate([blocks[:1].repeat(size - 1), blocks[:n - 2 * size + 1]])[:steps * size].reshape(steps, size)
    same = earlier == blocks[size::size][:steps, None]
    same[0, :size - 1] = False  # before the text
    row, column = np.nonzero(same)
    lag, at = 2 * size - 1 - column, (row + 1) * size
    open_ = reach[at - lag] < at + size - 1
    out: list[Run] = []
    active: dict[int, list[int]] = {}  # lag: first and last block that match
    for q, block in zip(lag[open_].tolist(), at[open_].tolist()):
        seen = active.get(q)
        if seen and seen[1] == block - size:
            seen[1] = block
        else:
            if seen:
                out += ended(ids, q, *seen, size)
            active[q] = [block, block]
    for q, seen in active.items():
        out += ended(ids, q, *seen, size)
    return out


def ended(ids: np.ndarray, lag: int, first: int, last: int, size: int) -> list[Run]:
    """The runs of a diagonal whose matching blocks start at ``first`` to ``last``."""
    need = max(LEAST_WORDS - lag, (LEAST_PERIODS - 1) * lag)
    if last - first + size + 2 * (size - 1) < need:
        return []
    low, high = max(lag, first - size), min(len(ids), last + 2 * size)
    same = np.zeros(high - low + 2, bool)
    same[1:-1] = ids[low:high] == ids[low - lag:high - lag]
    edge = np.flatnonzero(same[1:] != same[:-1])
    return [(low + a - lag, b - a + lag, lag) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= need]


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that come after the first period of a run."""
    if not runs:
        return words
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    return [w for w, d in zip(words, np.cumsum(drop).tolist()) if not d]


def strongest(runs: list[Run]) -> Run | None:
    """The run with the greatest length / period, the first of them, of these the one with the least period."""
    best = None
    for run in runs:  # by start and period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _per_text(docs: DataFrame, columns: str, types: list, measure, rewrite: Rewrite | None, id_col: str,
              text_col: str) -> DataFrame:
    """Rows of ``measure(words, runs)`` for each text, beside its id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, rows = [], []
            ids = batch.column(0).to_pylist() if rewrite else None
            for i, text in enumerate(batch.column(1)):
                words = text.as_py().encode().split()
                if rewrite:
                    words = rewrite(ids[i], words)
                for out in measure(words, runs_of(words)):
                    at.append(i)
                    rows.append(out)
            if rows:
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), *arrays],
                                                 ["doc_id", *(f"c{i}" for i in range(len(types)))])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id {id_type(docs, id_col)}, {columns}")


def periodic_runs(docs: DataFrame, rewrite: Rewrite | None = None, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per run: doc_id, start, length, period (in words). ``rewrite`` gives the words to judge from an
    id and the words of its text."""
    return _per_text(docs, "start bigint, length bigint, period bigint", [pa.int64()] * 3,
                     lambda words, runs: runs, rewrite, id_col, text_col)


def collapsed(docs: DataFrame, rewrite: Rewrite | None = None, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One row per text: doc_id, n_words, text (kept words joined by one space)."""
    return _per_text(docs, "n_words bigint, text string", [pa.int64(), pa.string()],
                     lambda words, runs: [(len(words), b" ".join(kept_words(words, runs)).decode())], rewrite, id_col,
                     text_col)


def run_summary(docs: DataFrame, rewrite: Rewrite | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """One row per text: doc_id, n_runs, the strongest run (start, length, period, exponent_milli; nulls without
    a run), and digests of all runs and of the text without their repeats."""
    def measure(words: list[bytes], runs: list[Run]):
        best = strongest(runs) or (None,) * 3
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        yield (len(runs), *best, best[1] * 1000 // best[2] if runs else None,
               hashlib.sha256(listed.encode()).hexdigest(),
               hashlib.sha256(b" ".join(kept_words(words, runs))).hexdigest())

    return _per_text(docs, "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
                           "runs_sha256 string, collapsed_sha256 string",
                     [pa.int64()] * 5 + [pa.string()] * 2, measure, rewrite, id_col, text_col)
