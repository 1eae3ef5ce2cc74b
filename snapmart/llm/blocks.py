"""Counting keys across the whole corpus in packed form.

Several operators must know, for each of the many n-grams of a document, something about that n-gram in
all documents. One row per n-gram occurrence would cost Spark more than the counting. So documents
are dealt into blocks of bounded size, a block asks once for each distinct key it holds, and its keys
travel as one packed array for each range of the key space (a part):

    blocks  --asks-->  parts  --answers-->  blocks

Spark shuffles and sorts these rows; numpy works inside a row. Keys are hashes, so parts are even, and
a key however hot is asked for once by a block. A block is bounded by ``BLOCK_CHARS`` and a part by
``PART_KEYS`` whatever the corpus; their numbers grow with it.

Were every block to send a row to every part, rows would grow with the square of the corpus. ``exchange`` lets a
block send at most ``WIDE`` rows: with more parts than that, keys go to ranges of parts first, where the
rows of as many blocks as a range has parts meet and go on together, one row a part; answers come back the same
way. Rows then grow with the blocks.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.common import id_and_text, id_type, stored

BLOCK_CHARS = 2_000_000
PART_KEYS = 1_000_000
#: Rows a block sends at most.
WIDE = 256

#: Fixed value: upper-case ASCII letters to lower case, on UTF-8 bytes.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
MIX = np.uint64(0x9E3779B97F4A7C15)
TURN = np.uint64(29)


# -- packing -------------------------------------------------------------------------------------

def pack(values: np.ndarray) -> bytes:
    """Integers as zstandard over their byte planes. Small or slowly changing values become small."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(-1, values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending unsigned keys by their steps."""
    return pack(np.diff(keys, prepend=keys[:1] * 0))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


# -- hashing -------------------------------------------------------------------------------------

def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def chained(parts: list[np.ndarray], seed: int = 0) -> np.ndarray:
    """Order-dependent 64-bit hash of several columns of hashes."""
    out = np.full(len(parts[0]), seed, np.uint64)
    for part in parts:
        out = (out ^ part) * MIX
        out ^= out >> TURN
    return out


# -- blocks --------------------------------------------------------------------------------------

def to_blocks(docs: DataFrame, id_col: str, text_col: str, block_chars: int = BLOCK_CHARS,
              level: int = 3) -> DataFrame:
    """(block, ids, sizes, texts): neighbouring documents of one task, their texts compressed. Stored, as
    all later steps rely on the same blocks. A document is never cut; a longer one is its own block."""
    spark_type = id_type(docs, id_col)
    arrow_id = pa.int64() if spark_type == "bigint" else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, raws, held = itertools.count(TaskContext.get().partitionId() << 32), [], [], 0
        kind = arrow_id

        def row() -> pa.RecordBatch:
            texts = zstandard.ZstdCompressor(level=level).compress(b"".join(raws))
            out = pa.RecordBatch.from_arrays(
                [pa.array([next(number)], pa.int64()), pa.array([ids], pa.list_(kind)),
                 pa.array([pack(np.array([len(x) for x in raws], np.int64))]), pa.array([texts])],
                ["block", "ids", "sizes", "texts"])
            ids.clear(), raws.clear()
            return out

        for batch in batches:
            kind = batch.column(0).type
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids.append(doc_id.as_py())
                raws.append(text.as_py().encode())
                held += len(raws[-1])
                if held >= block_chars:
                    yield row()
                    held = 0
        if ids:
            yield row()

    return stored(id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"block bigint, ids array<{spark_type}>, sizes binary, texts binary"), "blocks")


def texts_of(sizes: bytes, texts: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(texts)
    ends = np.cumsum(unpack(sizes, np.int64)).tolist()
    return [raw[a:b] for a, b in zip([0, *ends], ends)]


# -- asks and answers ----------------------------------------------------------------------------

def part_count(blocks: DataFrame, keys_a_char: float, part_keys: int = PART_KEYS) -> int:
    """Parts such that one holds about ``part_keys`` asked keys, and every task of a shuffle has work."""
    chars = blocks.select(F.sum(F.octet_length("texts"))).first()[0] or 0  # compressed to about a third
    least = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, int(3 * chars * keys_a_char / part_keys) + 1)


def part_edges(part: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The distinct parts of ascending part numbers, and where each one's keys start and end."""
    first = np.flatnonzero(np.diff(part, prepend=-1))
    return part[first], list(zip(first.tolist(), [*first[1:].tolist(), len(part)]))


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Ranges of the key space, numbered in key order."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def ask(blocks: DataFrame, asked: Callable[[dict], tuple], parts: int, extra: int = 1) -> DataFrame:
    """(block, part, keys, x0, x1, ...): ``asked`` gives a block's ascending keys and ``extra`` columns beside
    them; if it gives part numbers as well, those ascend and keys ascend within a part. A block is passed
    as the dict of its row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = {name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}
                keys, columns, *own = asked(block)
                if not len(keys):
                    continue
                part, cuts = part_edges(own[0] if own else part_of(keys, parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block["block"]] * len(part), pa.int64()), pa.array(part),
                     pa.array([pack_sorted(keys[a:b]) for a, b in cuts])]
                    + [pa.array([pack(c[a:b]) for a, b in cuts]) for c in columns],
                    ["block", "part", "keys"] + [f"x{i}" for i in range(extra)])

    columns = "".join(f", x{i} binary" for i in range(extra))
    return blocks.mapInArrow(run, f"block bigint, part bigint, keys binary{columns}")


def answer(asks: DataFrame, answered: Callable[[np.ndarray, list[np.ndarray]], tuple], types: list) -> DataFrame:
    """(block, part, answer, packed): ``answered`` gets all keys asked of a part and the columns beside them
    (of ``types``), one after another, and returns what to answer for each (packed as its dtype)."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(x) for x in group["keys"]]
        columns = [np.concatenate([unpack(x, t) for x in group[f"x{i}"]]) for i, t in enumerate(types)]
        out = answered(np.concatenate(keys), columns)
        ends = np.cumsum([len(k) for k in keys])
        return pd.DataFrame({"block": group["block"], "part": group["part"],
                             "answer": [pack(x) for x in np.split(out, ends[:-1])]})

    return asks.groupBy("part").applyInPandas(run, "block bigint, part bigint, answer binary")


def exchange(blocks: DataFrame, asked: Callable[[dict], tuple], answered: Callable[[np.ndarray, list[np.ndarray]], tuple],
             types: list, dtype, parts: int, wide: int = WIDE) -> DataFrame:
    """(block, part, answer) for the keys blocks ask for; see ``ask`` and ``answer``. ``dtype`` is that of answers."""
    if parts <= wide:
        return answer(ask(blocks, asked, parts, len(types)), answered, types)
    step = -(-parts // wide)  # parts of a range, and blocks of a region
    extra = [f"x{i}" for i in range(len(types))]

    def by_range(block: dict):
        keys, columns = asked(block)
        return keys, columns, part_of(keys, parts) // step

    regions = -(-blocks.count() // step)
    region = F.pmod(F.xxhash64("block"), F.lit(regions)).cast("bigint")
    asks = ask(blocks, by_range, parts, len(types)).withColumnRenamed("part", "range").withColumn("region", region)

    def dealt(group: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(x) for x in group["keys"]]
        block = np.repeat(group["block"].to_numpy(), [len(k) for k in keys])
        key = np.concatenate(keys)
        columns = [np.concatenate([unpack(x, t) for x in group[c]]) for c, t in zip(extra, types)]
        part = part_of(key, parts)
        order = np.argsort(part, kind="stable")  # a block's keys stay together and in order
        names, cuts = part_edges(part[order])
        rows = []
        for a, b in cuts:
            at = order[a:b]
            first = np.flatnonzero(np.diff(block[at], prepend=block[at][:1] - 1))
            rows.append((pack(block[at][first]), pack(np.diff(first, append=len(at))), pack_sorted(key[at]),
                         *(pack(c[at]) for c in columns)))
        out = pd.DataFrame(rows, columns=["who", "sizes", "keys", *extra])
        return out.assign(region=group["region"].iloc[0], range=group["range"].iloc[0], part=names)

    def told(group: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(x) for x in group["keys"]]
        columns = [np.concatenate([unpack(x, t) for x in group[c]]) for c, t in zip(extra, types)]
        out = np.split(answered(np.concatenate(keys), columns), np.cumsum([len(k) for k in keys])[:-1])
        return group[["region", "range", "part", "who", "sizes"]].assign(answer=[pack(x.astype(dtype)) for x in out])

    def back(group: pd.DataFrame) -> pd.DataFrame:
        found: dict[int, list[np.ndarray]] = {}
        for row in group.sort_values("part").itertuples():
            sizes = unpack(row.sizes, np.int64)
            for who, some in zip(unpack(row.who, np.int64).tolist(), np.split(unpack(row.answer, dtype), np.cumsum(sizes)[:-1])):
                found.setdefault(who, []).append(some)
        return pd.DataFrame({"block": list(found), "part": group["range"].iloc[0],
                             "answer": [pack(np.concatenate(x)) for x in found.values()]})

    place = "region bigint, range bigint, part bigint, who binary, sizes binary"
    columns = "".join(f", {c} binary" for c in extra)
    met = asks.groupBy("region", "range").applyInPandas(dealt, f"{place}, keys binary{columns}")
    answers = met.groupBy("part").applyInPandas(told, f"{place}, answer binary")
    return answers.groupBy("region", "range").applyInPandas(back, "block bigint, part bigint, answer binary")


def with_answers(blocks: DataFrame, **answers: DataFrame) -> DataFrame:
    """Blocks with one array column of answers for each name, in part order."""
    out = blocks
    for name, df in answers.items():
        rows = df.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("part", "answer"))).alias(name))
        out = out.join(rows.withColumn(name, F.col(f"{name}.answer")), "block", "left")
    return out


def joined(answers: list[bytes] | None, dtype) -> np.ndarray:
    """The answers to a block's keys, in the order of the keys."""
    return np.concatenate([unpack(x, dtype) for x in answers]) if answers else np.zeros(0, dtype)
