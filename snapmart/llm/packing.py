"""Best-fit packing by bin completion (branch and bound).

Documents become token ids, closed by id 0; only documents longer than a sequence are cut, their first
piece taking what is left over. Which piece lengths share a sequence depends on the length histogram
alone, which has at most ``capacity`` rows whatever the corpus, so it is solved on the driver:

* best-fit decreasing gives the incumbent, ceil(tokens / capacity) the lower bound;
* bin completion takes the largest remaining length, enumerates undominated fillings of the rest of
  its sequence, and branches on them, least waste first. A branch is pruned when its waste shows
  that it can't beat the incumbent. A filling is applied to as many sequences as the counts allow.

The answer is a list of (pattern, number of sequences). Spark then gives every piece its rank among the
pieces of its length (per-block counters plus a running sum over blocks) and reads sequence and offset
off the patterns. No length class, however hot, is ever held in one task.

Defined results: a null or empty text is one piece of length 1 (its id 0). Repeated rows are packed each.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapmart.llm.common import id_and_text, id_type, stored

CAPACITY = 2048
#: The id that closes a document.
CLOSE = b"\0\0\0\0"
#: Texts that a task encodes twice, and how many of their characters.
PROBES, PROBE_CHARS = 8, 4096
#: Branch-and-bound effort: nodes in all, fillings tried at a node, steps to enumerate them. When it is
#: used up the incumbent stands; every piece is packed either way.
NODES = 20_000
FILLINGS = 4
STEPS = 4_000

Pattern = tuple[tuple[int, int], ...]  # (length, how many) in a sequence


def pack(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stored(cut(docs, tokenizer_path, pattern, capacity, id_col, text_col), "pieces")
    counts = stored(pieces.groupBy("block", "length").agg(F.count("*").alias("n")), "piece_counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.sum("n").over(Window.partitionBy("length").orderBy("block")
                             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("block", "length", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["block", "length"]).withColumn("place", F.col("before") + F.col("rank"))
    return placed(ranked, solve(histogram, capacity), id_type(docs, id_col))


def cut(docs: DataFrame, tokenizer_path: str, pattern: str, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """The pieces of every document, with their block (task) and rank among its pieces of that length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = TokenIds(tokenizer_path, pattern)
        block, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            out = []
            for row, text in enumerate(batch.column(1)):
                ids = ids_of(text.as_py())
                n = len(ids) // 4
                first = (n % capacity or capacity) if n > capacity else n
                edges = [0, *range(first, n + 1, capacity)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    out.append((row, piece, a, b - a, zlib.crc32(ids[4 * a:4 * b]), block, int(seen[b - a])))
                    seen[b - a] += 1
            if out:
                row, *rest = zip(*out)
                types = [pa.int32(), *[pa.int64()] * 5]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int32())), *map(pa.array, rest, types)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "block", "rank"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"doc_id {id_type(docs, id_col)}, piece int, start bigint, length bigint, ids_crc32 bigint, "
             "block bigint, rank bigint")


class TokenIds:
    """Token ids as little-endian 32-bit words, closed by id 0.

    The ids are those of ``tokenizers`` for the file at ``path``, without the ids a post-processor adds. They
    are computed by tiktoken from the same file's vocabulary, which merges the same pairs in the same order
    at a third of the cost; every task holds its first texts, and one with each added token of the file,
    against ``tokenizers`` itself and stops if an id differs. A text is split at the added tokens, each of
    which is one id, also where the text only quotes it.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        # the vocabulary spells bytes as characters: printable ones as themselves, the rest from U+0100 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in printable]
        byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(map(byte.__getitem__, token)): i
                 for token, i in spec["model"]["vocab"].items() if token not in special}
        encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.encode = partial(encoding.encode_to_numpy, allowed_special="all")
        self.unproved = PROBES
        for token in special:
            self.prove(f"a {token} b{token}{token}\n")

    def __call__(self, text: str) -> bytes:
        ids = self.encode(text).astype("<u4")
        if self.unproved:
            self.unproved -= 1
            self.prove(text[:PROBE_CHARS])
        return ids.tobytes() + CLOSE

    def prove(self, probe: str) -> None:
        if self.tokenizer.encode(probe, add_special_tokens=False).ids != self.encode(probe).tolist():
            raise ValueError("the vocabulary and the tokenizer give different ids")


def placed(ranked: DataFrame, plan: list[tuple[Pattern, int]], doc_id: str) -> DataFrame:
    """Sequence and offset of each ranked piece. The plan has at most a few entries per length, so it
    travels with the function whatever the size of the corpus."""
    starts: dict[int, list[tuple]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, bins in plan:
        offset = 0
        for length, n in pattern:
            starts.setdefault(length, []).append((used.get(length, 0), n, sequence, offset))
            used[length] = used.get(length, 0) + n * bins
            offset += length * n
        sequence += bins
    table = {length: np.array(rows, np.int64).T for length, rows in starts.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, place = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence_id, offset = np.empty_like(place), np.empty_like(place)
            for x in np.unique(length):
                at = np.flatnonzero(length == x)
                first, n, seq, off = table[int(x)]
                k = np.searchsorted(first, place[at], "right") - 1
                nth = place[at] - first[k]
                sequence_id[at] = seq[k] + nth // n[k]
                offset[at] = off[k] + nth % n[k] * x
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence_id), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "place").mapInArrow(
        run, f"doc_id {doc_id}, piece int, start bigint, length bigint, ids_crc32 bigint, "
             "sequence_id bigint, offset bigint")


def solve(histogram: dict[int, int], capacity: int, nodes: int = NODES) -> list[tuple[Pattern, int]]:
    """(pattern, sequences) covering the histogram exactly: bin completion below a best-fit incumbent."""
    total = sum(length * n for length, n in histogram.items())
    best = best_fit(histogram, capacity)
    fewest, bound = sum(n for _, n in best), lower_bound(histogram, capacity)
    counts = [0] * (capacity + 1)
    for length, n in histogram.items():
        counts[length] = n
    taken: list[tuple[Pattern, int, Iterator]] = []  # the path: what was applied, and what else to try there
    sequences = waste = 0
    options = None
    while fewest > bound and nodes > 0:
        nodes -= 1
        spare = (fewest - 1) * capacity - total  # waste that a better solution may have
        if options is None:
            largest = next((x for x in range(capacity, 0, -1) if counts[x]), 0)
            if not largest and sequences < fewest:
                best, fewest = [(p, n) for p, n, _ in taken], sequences
            options = fillings(counts, largest, capacity, spare - waste) if largest else iter(())
        pattern = next(options, None)
        if pattern is not None:
            lost = capacity - sum(x * n for x, n in pattern)
            bins = min(counts[x] // n for x, n in pattern)
            if lost:
                bins = min(bins, (spare - waste) // lost)
            if bins < 1:
                continue
            for x, n in pattern:
                counts[x] -= n * bins
            taken.append((pattern, bins, options))
            sequences, waste, options = sequences + bins, waste + lost * bins, None
        elif taken:
            pattern, bins, options = taken.pop()
            for x, n in pattern:
                counts[x] += n * bins
            sequences, waste = sequences - bins, waste - bins * (capacity - sum(x * n for x, n in pattern))
        else:
            break
    return best


def lower_bound(histogram: dict[int, int], capacity: int) -> int:
    """Sequences that no packing can do without: by tokens, and by pieces too large to share (with the
    room beside them that no remaining piece fits counted as waste)."""
    total = sum(length * n for length, n in histogram.items())
    least = min(histogram, default=0)
    waste = sum((capacity - x) * n for x, n in histogram.items() if capacity - x < least)
    large = sum(n for x, n in histogram.items() if 2 * x > capacity)
    return max(-(-(total + waste) // capacity), large)


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over the histogram: equal pieces are placed together, equal bins are one entry."""
    room: dict[int, list[tuple[Pattern, int]]] = {}  # by free tokens
    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            free = min((f for f in room if f >= length), default=None)
            if free is None:
                per = capacity // length
                if n >= per:
                    room.setdefault(capacity - per * length, []).append((((length, per),), n // per))
                    n %= per
                else:
                    room.setdefault(capacity - n * length, []).append((((length, n),), 1))
                    n = 0
                continue
            pattern, bins = room[free].pop()
            if not room[free]:
                del room[free]
            per = min(free // length, n)
            use = min(bins, n // per)
            n -= per * use
            room.setdefault(free - per * length, []).append(((*pattern, (length, per)), use))
            if bins > use:
                room.setdefault(free, []).append((pattern, bins - use))
    return [entry for entries in room.values() for entry in entries]


def fillings(counts: list[int], largest: int, capacity: int, spare: int) -> Iterator[Pattern]:
    """Undominated fillings around one piece of the largest length, least waste first, none above ``spare``."""
    rest = capacity - largest
    counts[largest] -= 1
    lengths = [x for x in range(min(rest, len(counts) - 1), 0, -1) if counts[x]]
    available = {x: counts[x] for x in lengths}
    counts[largest] += 1
    sums = 1  # bit s: some pieces have s tokens together
    for x in lengths:
        for _ in range(min(available[x], rest // x)):
            if (wider := (sums | sums << x) & ((2 << rest) - 1)) == sums:
                break
            sums = wider
    found: list[list[int]] = []
    steps = STEPS
    for waste in range(min(rest, spare) + 1 if spare >= 0 else 0):
        if not sums >> (rest - waste) & 1:
            continue
        stack = [(rest - waste, 0, [])]
        while stack and steps > 0 and len(found) < FILLINGS:
            steps -= 1
            need, i, chosen = stack.pop()
            if not need:
                if not any(dominates(other, chosen) for other in found):
                    found.append(chosen)
                    yield tally([largest, *chosen])
                continue
            while i < len(lengths) and lengths[i] > need:
                i += 1
            if i == len(lengths):
                continue
            x = lengths[i]
            stack.append((need, i + 1, chosen))
            if chosen.count(x) < available[x] and sums >> (need - x) & 1:
                stack.append((need - x, i, [*chosen, x]))
        if len(found) >= FILLINGS or steps <= 0:
            break
    if not found and spare >= rest - (lengths[0] if lengths else 0):
        yield tally([largest, *lengths[:1]])  # the steps ran out: one more piece, or none that fits


def dominates(one: list[int], other: list[int]) -> bool:
    """Whether the pieces of ``other`` can be dealt out inside the pieces of ``one``."""
    def deal(room: list[int], left: list[int]) -> bool:
        if not left:
            return True
        tried = set()
        for i, free in enumerate(room):
            if free >= left[0] and free not in tried:
                tried.add(free)
                if deal([*room[:i], free - left[0], *room[i + 1:]], left[1:]):
                    return True
        return False

    return len(one) <= len(other) and sum(one) >= sum(other) and deal(list(one), sorted(other, reverse=True))


def tally(lengths: list[int]) -> Pattern:
    out: dict[int, int] = {}
    for x in lengths:
        out[x] = out.get(x, 0) + 1
    return tuple(out.items())
