"""Quality rules: compression bands.

A text is judged by its zstandard ratio (compressed bytes over UTF-8 bytes), once over the whole
document and once over fixed chunks; the rest after the last whole chunk is judged as the chunk that ends
the text, which weighs as many bytes as the rest has. Short texts compress worse than long ones, so the accepted band
depends on the length: a ratio under the lower limit is repetitive, one over the upper limit is
incompressible. A document is rejected if its whole ratio leaves its band, or if more than
``CHUNK_SHARE`` of its chunk bytes lie in chunks that leave the chunk band.

Defined results: a null or empty text has no words, ratio 0.0, fails the base rule and is rejected.
Texts shorter than the first band have no ratio limits. Every row gives one row, repeated ids too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from snapmart.llm.common import SEPARATORS, map_texts

#: Fixed value: characters counted as symbols.
SYMBOLS = "#*$%&|<>"

#: (from bytes, lowest ratio, highest ratio) at zstandard level 3. The limits follow how the ratio of
#: running prose falls with length, with a quarter of it as margin on the repetitive side.
BANDS = (
    (64, 0.45, 1.40),
    (128, 0.45, 1.10),
    (256, 0.44, 0.95),
    (512, 0.41, 0.82),
    (1024, 0.38, 0.74),
    (2048, 0.36, 0.70),
    (4096, 0.34, 0.68),
    (8192, 0.33, 0.67),
    (16384, 0.31, 0.66),
    (32768, 0.30, 0.66),
)
LEVEL = 3
CHUNK_BYTES = 2048
CHUNK_BAND = (0.30, 0.74)
CHUNK_SHARE = 0.5
MIN_WORDS = 20
WINDOW = 8
REPEAT_PERCENT = 30

COLUMNS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
           "base_failed boolean, kept boolean, ratio double, chunk_bytes_low bigint, chunk_bytes_high bigint")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts, compression figures and the verdict ``kept``."""
    return map_texts(docs, id_col, text_col, COLUMNS, measure)


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns unchanged."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [row[6] for row in measure(text or "" for text in batch.column(at).to_pylist())]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def measure(texts: Iterator[str]) -> Iterator[tuple]:
    squeeze = zstandard.ZstdCompressor(level=LEVEL).compress
    for text in texts:
        raw = text.encode()
        words = raw.split()
        n = len(words)
        repeat = repeat_words(words)
        base_failed = n < MIN_WORDS or 100 * repeat > REPEAT_PERCENT * n
        ratio, low, high, good = judge(raw, squeeze)
        yield (n, len(text) - sum(map(text.count, SEPARATORS)), sum(map(text.count, SYMBOLS)), dup_lines(text),
               repeat, base_failed, not base_failed and good, ratio, low, high)


def judge(raw: bytes, squeeze) -> tuple[float, int, int, bool]:
    """Whole ratio, bytes in too repetitive and in incompressible chunks, and the bands' verdict."""
    size = len(raw)
    if not size:
        return 0.0, 0, 0, False
    ratio = len(squeeze(raw)) / size
    good = True
    for start, least, most in reversed(BANDS):
        if size >= start:
            good = least <= ratio <= most
            break
    low = high = 0
    if size > CHUNK_BYTES:  # one chunk would only repeat the whole ratio
        for start in range(0, size, CHUNK_BYTES):
            weight = min(CHUNK_BYTES, size - start)
            end = start + weight  # a short rest has no band of its own, so its chunk starts before it
            r = len(squeeze(raw[end - CHUNK_BYTES:end])) / CHUNK_BYTES
            low += weight * (r < CHUNK_BAND[0])
            high += weight * (r > CHUNK_BAND[1])
        good = good and low + high <= CHUNK_SHARE * size
    return ratio, low, high, good


def dup_lines(text: str) -> int:
    """Lines holding a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SEPARATORS)]
    return len(lines) - len(set(lines))


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words covered by a window of ``window`` words that occurs at least twice in the text.

    A rolling hash proposes the windows; they are then counted by their words, so the count is exact.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    roll = np.zeros(n, np.uint64)
    for k in range(window):
        roll = roll * np.uint64(0x9E3779B97F4A7C15) + h[k:n + k]
    ordered = np.sort(roll)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(roll, twice)).tolist()
    seen = Counter(tuple(words[i:i + window]) for i in at)
    edge = np.zeros(len(words) + 1, np.int64)
    for i in at:
        if seen[tuple(words[i:i + window])] > 1:
            edge[i] += 1
            edge[i + window] -= 1
    return int(np.count_nonzero(np.cumsum(edge)))
