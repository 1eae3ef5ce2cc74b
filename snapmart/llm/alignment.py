"""Alignment of two tokenizations of the same texts, with corpus-wide counts of linked token pairs.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (sentence pieces, which add the space) the
text. Both give the same bytes, so their tokens can be laid side by side. Where both end at the same byte,
a group ends; a token of A and one of B are linked where their bytes overlap. The ends of all tokens cut the
bytes into stretches, and every link is one stretch.

How often each pair of ids is linked in the corpus comes from a minimal perfect hash:

1. documents are encoded once, into blocks of bounded size (token ids, packed and stored);
2. the first pass aligns every block and keeps its distinct pairs with their counts, dealt to a fixed number
   of parts by a hash of the pair;
3. the distinct pairs of a part are united in a tree of groups, and a minimal perfect hash is built on them:
   levels of bits, a key takes its place at the first level where no other key hashes to the same bit. The
   keys themselves are stored by their hash, as the hash says nothing about other keys;
4. each group of blocks adds its counts into a dense vector indexed by the hash, and the vectors are summed
   in a tree;
5. the second pass looks a block's pairs up (every key is verified), aligns its documents again and sums over
   their links.

The parts are bounded by the two vocabularies, whatever the corpus: at most |A| * |B| / ``PARTS`` pairs each.
So a block sends at most ``PARTS`` rows, and rows grow with the blocks. A pair however hot is one entry a block.

Defined results: texts that are null, empty, or whose tokens do not give back their bytes in either tokenizer
(a literal U+2581) have no tokens: zeros, and '' as their groups. Rows with a null id and repeated rows count and
are returned like others. Columns other than the id and the text are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.blocks import joined, pack, part_edges, unpack, with_answers
from snapmart.llm.common import id_and_text, id_type, stored

BLOCK_BYTES = 1_000_000
PARTS = 128
#: Blocks whose counts meet in one group, and groups that meet in one of the next level of a tree.
GROUP, FAN = 1024, 16
#: Bits a key at each level of the hash; levels are added until every key has a place.
ROOM, LEVELS = 1.5, 200
#: Texts a task encodes twice.
PROBES, PROBE_CHARS = 8, 4096

MIX, MIX2, TURN = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(31)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of integers, one family member a seed."""
    x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & 2 ** 64 - 1)
    x = (x ^ (x >> np.uint64(30))) * MIX
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> TURN)


def part_numbers(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((mixed(keys, -1) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


# -- minimal perfect hash ------------------------------------------------------------------------

class PerfectHash:
    """Distinct keys to 0 ... n-1. ``index`` gives -1 for keys that are not among them."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, keys: np.ndarray):
        self.sizes, self.bits, self.keys = sizes, bits, keys
        self.starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.rank = np.cumsum(bits) - bits  # bits set before each place, over all levels

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits, left = [], [], keys
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("keys are not distinct")
            size = max(8, int(ROOM * len(left)))
            at = (mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            left = left[~alone[at]]
        hashed = cls(np.array(sizes, np.int64), np.concatenate([*bits, np.zeros(0, bool)]).astype(np.int64),
                     np.zeros(len(keys), np.uint64))
        hashed.keys[hashed.places(keys)] = keys
        return hashed

    def places(self, keys: np.ndarray) -> np.ndarray:
        out, todo = np.full(len(keys), -1), np.arange(len(keys))
        for level, (start, size) in enumerate(zip(self.starts.tolist(), self.sizes.tolist())):
            at = start + (mixed(keys[todo], level) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at] == 1
            out[todo[hit]] = self.rank[at[hit]]
            todo = todo[~hit]
            if not len(todo):
                break
        return out

    def index(self, keys: np.ndarray) -> np.ndarray:
        place = self.places(keys)
        if len(self.keys):
            place[self.keys[place] != keys] = -1
        return place

    def row(self) -> tuple[bytes, bytes, bytes]:
        return pack(self.sizes), np.packbits(self.bits.astype(bool)).tobytes(), pack(self.keys)

    @classmethod
    def of(cls, sizes: bytes, bits: bytes, keys: bytes) -> PerfectHash:
        size = unpack(sizes, np.int64)
        flags = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(size.sum())).astype(np.int64)
        return cls(size, flags, unpack(keys, np.uint64))


# -- tokens --------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Tokenizers:
    """Where the two vocabularies are, and the pattern that A splits texts by."""

    a_json: str
    b_model: str
    pattern: str

    def vocabulary_a(self) -> tuple[dict[bytes, int], list[str]]:
        """Token bytes to ids, and the file's added tokens."""
        with open(self.a_json, encoding="utf-8") as file:
            spec = json.load(file)
        added = [t["content"] for t in spec["added_tokens"]]
        # the vocabulary spells bytes as characters: printable ones as themselves, the rest from U+0100 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = dict(zip(map(chr, plain), plain))
        byte |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
        return {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                if token not in added}, added

    def pieces_b(self) -> list[bytes]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=self.b_model)
        return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
                else model.id_to_piece(i).replace("▁", " ").encode() for i in range(len(model))]

    def lengths(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of each token of A and of B, by id."""
        vocabulary, _ = self.vocabulary_a()
        a = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            a[i] = len(token)
        return a, np.array([len(p) for p in self.pieces_b()], np.int64)


class Encoder:
    """Token ids of both tokenizers for a text, or none.

    A's ids are those of ``tokenizers`` with the strings of special tokens as plain text. They are computed by
    tiktoken, which merges the same pairs of the same vocabulary in the same order at a third of the cost;
    every task holds its first texts, and one with each special token, against ``tokenizers`` itself.
    """

    def __init__(self, files: Tokenizers):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        ranks, added = files.vocabulary_a()
        self.a = tiktoken.Encoding("ranks", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=files.b_model)
        self.pieces = files.pieces_b()
        self.exact = Tokenizer.from_file(files.a_json)
        self.exact.encode_special_tokens = True
        self.unproved = PROBES
        for token in added:
            self.prove(f" a {token} b{token}{token}\n")

    def prove(self, probe: str) -> None:
        if self.exact.encode(probe, add_special_tokens=False).ids != self.a.encode_ordinary(probe):
            raise ValueError("the vocabulary and the tokenizer give different ids")

    def __call__(self, text: str) -> tuple[list[int], list[int]]:
        if not text:
            return [], []
        spaced = " " + text
        if self.unproved:
            self.unproved -= 1
            self.prove(spaced[:PROBE_CHARS])
        raw, a, b = spaced.encode(), self.a.encode_ordinary(spaced), self.b.encode(text)
        if self.a.decode_bytes(a) != raw or b"".join(map(self.pieces.__getitem__, b)) != raw:
            return [], []
        return a, b


def token_blocks(docs: DataFrame, files: Tokenizers, block_bytes: int, id_col: str, text_col: str) -> DataFrame:
    """(block, ids, na, nb, a, b): neighbouring documents of a task, their numbers of tokens and their tokens one
    after another. A document is never cut; a longer one is its own block."""
    spark_type = id_type(docs, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = Encoder(files), itertools.count(TaskContext.get().partitionId() << 32)
        ids, na, nb, a, b, held, kind = [], [], [], [], [], 0, None

        def row() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array([next(number)], pa.int64()), pa.array([ids], pa.list_(kind)),
                 *(pa.array([pack(np.array(x, t))], pa.binary())
                   for x, t in ((na, np.int64), (nb, np.int64), (a, np.uint32), (b, np.uint32)))],
                ["block", "ids", "na", "nb", "a", "b"])
            for x in (ids, na, nb, a, b):
                x.clear()
            return out

        for batch in batches:
            kind = batch.column(0).type
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ta, tb = encode(text.as_py())
                ids.append(doc_id.as_py())
                na.append(len(ta))
                nb.append(len(tb))
                a += ta
                b += tb
                held += len(text.as_buffer()) + 1
                if held >= block_bytes:
                    yield row()
                    held = 0
        if ids:
            yield row()

    return stored(id_and_text(docs, id_col, text_col).mapInArrow(
        run, f"block bigint, ids array<{spark_type}>, na binary, nb binary, a binary, b binary"), "token_blocks")


# -- alignment -----------------------------------------------------------------------------------

class Aligned:
    """The tokens of a block side by side. Documents without tokens take no bytes; all others end both
    tokenizations at the same byte, so one pass over the block aligns each of them by itself."""

    def __init__(self, row: dict, lengths: tuple[np.ndarray, np.ndarray]):
        self.na, self.nb = unpack(row["na"], np.int64), unpack(row["nb"], np.int64)
        self.a, self.b = unpack(row["a"], np.uint32).astype(np.int64), unpack(row["b"], np.uint32).astype(np.int64)
        end_a, end_b = np.cumsum(lengths[0][self.a]), np.cumsum(lengths[1][self.b])
        ends = np.zeros(int(end_a[-1]) + 1 if len(end_a) else 1, np.int8)  # 1: A ends here, 2: B, 3: both
        ends[end_a] = 1
        ends[end_b] += 2
        cuts = ends[np.flatnonzero(ends)]
        ends_a, ends_b = cuts & 1, cuts >> 1
        self.link_a, self.link_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b  # tokens of each link
        self.last_a, self.last_b = ends[end_a] == 3, ends[end_b] == 3  # whether a token ends its group

    def pairs(self, size_b: int) -> np.ndarray:
        """The key of each link: id of A * size of B's vocabulary + id of B."""
        return (self.a[self.link_a] * size_b + self.b[self.link_b]).astype(np.uint64)

    def link_documents(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.na)), self.na)[self.link_a]

    def group_counts(self) -> np.ndarray:
        documents = np.repeat(np.arange(len(self.na)), self.na)
        return np.bincount(documents[self.last_a], minlength=len(self.na))

    def written(self, names: dict[str, np.ndarray]) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each document; '' without tokens."""
        group_a, group_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        before_b = np.concatenate([[0], np.flatnonzero(self.last_b) + 1])
        through_a = np.flatnonzero(self.last_a) + 1
        out = np.empty(len(self.a) + len(self.b), object)
        out[np.arange(len(self.a)) + before_b[group_a]] = np.where(self.last_a, names["a|"][self.a], names["a,"][self.a])
        out[np.arange(len(self.b)) + through_a[group_b]] = np.where(self.last_b, names["b;"][self.b], names["b,"][self.b])
        ends = np.cumsum(self.na + self.nb).tolist()
        return ["".join(out[x:y].tolist())[:-1] for x, y in zip([0, *ends], ends)]


def block_pairs(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys of a block ordered by part and key: keys, counts, part numbers, and the place of every
    given key among them."""
    distinct, place, counts = np.unique(keys, return_inverse=True, return_counts=True)
    part = part_numbers(distinct, parts)
    order = np.argsort(part, kind="stable")
    moved = np.empty_like(order)
    moved[order] = np.arange(len(order))
    return distinct[order], counts[order], part[order], moved[place]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}


def first_pass(blocks: DataFrame, lengths: tuple[np.ndarray, np.ndarray], parts: int) -> DataFrame:
    """(block, part, keys, counts): a block's distinct pairs and how many of its links hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            keys, counts, part, _ = block_pairs(Aligned(row, lengths).pairs(len(lengths[1])), parts)
            if len(keys):
                names, cuts = part_edges(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(names), pa.int64()), pa.array(names),
                     pa.array([pack(np.diff(keys[x:y], prepend=keys[:1] * 0)) for x, y in cuts]),
                     pa.array([pack(counts[x:y]) for x, y in cuts])], ["block", "part", "keys", "counts"])

    return stored(blocks.select("block", "na", "nb", "a", "b").mapInArrow(
        run, "block bigint, part bigint, keys binary, counts binary"), "pair_counts")


def ascending(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


# -- counts --------------------------------------------------------------------------------------

def tree(rows: DataFrame, merge: Callable, schema: str, slices: int, fan: int, left: int = 1) -> DataFrame:
    """Merge the rows of each part, ``fan`` slices at a time, until at most ``left`` rows a part are left."""
    while slices > left:
        slices = -(-slices // fan)
        rows = rows.withColumn("slice", F.floor(F.col("slice") / fan)).groupBy("part", "slice").applyInPandas(merge, schema)
    return rows


def hash_tables(pairs: DataFrame, slices: int, fan: int) -> DataFrame:
    """(part, sizes, bits, keys): a minimal perfect hash of each part's distinct pairs. The last merge builds it: a
    step of its own would follow in the same tasks, and every task would hold two Python workers from then on."""
    def distinct(group: pd.DataFrame) -> np.ndarray:
        return np.unique(np.concatenate([ascending(x) for x in group["keys"]]))

    def union(group: pd.DataFrame) -> pd.DataFrame:
        keys = distinct(group)
        return pd.DataFrame({"part": group["part"][:1], "slice": group["slice"][:1],
                             "keys": [pack(np.diff(keys, prepend=keys[:1] * 0))]})

    def build(group: pd.DataFrame) -> pd.DataFrame:
        sizes, bits, keys = PerfectHash.build(distinct(group)).row()
        return pd.DataFrame({"part": group["part"][:1], "sizes": [sizes], "bits": [bits], "keys": [keys]})

    rows = pairs.select("part", "slice", "keys")
    if slices > 1:
        schema = "part bigint, slice bigint, keys binary"
        rows = tree(rows.groupBy("part", "slice").applyInPandas(union, schema), union, schema, slices, fan, fan)
    return stored(rows.groupBy("part").applyInPandas(
        build, "part bigint, sizes binary, bits binary, keys binary"), "pair_hash")


def for_each_slice(tables: DataFrame, slices: int) -> DataFrame:
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint"))
    return tables.withColumn("slice", F.explode(every))


def summed_counts(pairs: DataFrame, tables: DataFrame, slices: int, fan: int) -> DataFrame:
    """``tables`` with the corpus-wide counts, a dense vector in the order of the hash."""
    def scatter(group: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        if group.empty:  # no block of the slice has a pair in the part
            return pd.DataFrame(columns=["part", "slice", "counts"])
        hashed = PerfectHash.of(*table.loc[0, ["sizes", "bits", "keys"]])
        vector = np.zeros(len(hashed.keys), np.int64)
        for keys, counts in zip(group["keys"], group["counts"]):
            vector[found(hashed, ascending(keys))] += unpack(counts, np.int64)
        return pd.DataFrame({"part": group["part"][:1], "slice": group["slice"][:1], "counts": [pack(vector)]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        vector = sum(unpack(x, np.int64) for x in group["counts"])
        return pd.DataFrame({"part": group["part"][:1], "slice": group["slice"][:1], "counts": [pack(vector)]})

    schema = "part bigint, slice bigint, counts binary"
    first = cogrouped(pairs.select("part", "slice", "keys", "counts"), tables, slices).applyInPandas(scatter, schema)
    sums = tree(first, add, schema, slices, fan).select("part", "counts")
    return stored(tables.join(sums, "part"), "pair_table")


def cogrouped(pairs: DataFrame, tables: DataFrame, slices: int):
    return pairs.groupBy("part", "slice").cogroup(for_each_slice(tables, slices).groupBy("part", "slice"))


def found(hashed: PerfectHash, keys: np.ndarray) -> np.ndarray:
    """The places of keys that must be there."""
    place = hashed.index(keys)
    if (place < 0).any():
        raise ValueError("a pair of the second pass is not in the table of the first")
    return place


def highest(tables: DataFrame, size_b: int) -> np.ndarray:
    """The highest count of a pair with each id of B. One number an id reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            b = (unpack(row["keys"], np.uint64) % np.uint64(size_b)).astype(np.int64)
            most = np.zeros(size_b, np.int64)
            np.maximum.at(most, b, unpack(row["counts"], np.int64))
            ids = np.flatnonzero(most)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(most[ids])], ["b", "most"])

    out = np.zeros(size_b, np.int64)
    rows = tables.select("keys", "counts").mapInArrow(run, "b bigint, most bigint")
    for row in rows.groupBy("b").agg(F.max("most").alias("most")).collect():
        out[row["b"]] = row["most"]
    return out


def looked_up(pairs: DataFrame, tables: DataFrame, slices: int) -> DataFrame:
    """(block, part, answer): the counts of the pairs a block has in a part."""
    def run(group: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        if group.empty:
            return pd.DataFrame(columns=["block", "part", "answer"])
        hashed, counts = PerfectHash.of(*table.loc[0, ["sizes", "bits", "keys"]]), unpack(table.loc[0, "counts"], np.int64)
        return pd.DataFrame({"block": group["block"], "part": group["part"],
                             "answer": [pack(counts[found(hashed, ascending(x))]) for x in group["keys"]]})

    return cogrouped(pairs.select("block", "part", "slice", "keys"), tables, slices).applyInPandas(
        run, "block bigint, part bigint, answer binary")


# -- operator ------------------------------------------------------------------------------------

def linked_pairs(docs: DataFrame, files: Tokenizers, block_bytes: int = BLOCK_BYTES, parts: int = PARTS,
                 group: int = GROUP, fan: int = FAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per pair of ids that is linked anywhere: a, b, links."""
    *_, tables, lengths = _counted(docs, files, block_bytes, parts, group, fan, id_col, text_col)
    size_b = len(lengths[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            keys = unpack(row["keys"], np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys // size_b), pa.array(keys % size_b), pa.array(unpack(row["counts"], np.int64))],
                ["a", "b", "links"])

    return tables.select("keys", "counts").mapInArrow(run, "a bigint, b bigint, links bigint")


def _counted(docs, files, block_bytes, parts, group, fan, id_col, text_col):
    lengths = files.lengths()
    blocks = token_blocks(docs, files, block_bytes, id_col, text_col)
    pairs = first_pass(blocks, lengths, parts)
    slices = max(1, -(-blocks.count() // group))
    pairs = pairs.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(slices)).cast("bigint"))
    tables = summed_counts(pairs, hash_tables(pairs, slices, fan), slices, fan)
    return blocks, pairs, slices, tables, lengths


def aligned(docs: DataFrame, files: Tokenizers, block_bytes: int = BLOCK_BYTES, parts: int = PARTS,
            group: int = GROUP, fan: int = FAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    blocks, pairs, slices, tables, lengths = _counted(docs, files, block_bytes, parts, group, fan, id_col, text_col)
    size_a, size_b = map(len, lengths)
    most = highest(tables, size_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = {f"{side}{end}": np.array([f"{i}{end}" for i in range(size)], object)
                 for side, size, ends in (("a", size_a, ",|"), ("b", size_b, ",;")) for end in ends}
        for batch in batches:
            id_lists = batch.column(batch.schema.get_field_index("ids"))
            rest = batch.select([n for n in batch.schema.names if n != "ids"])
            for i, row in enumerate(rows_of([rest])):
                tokens = Aligned(row, lengths)
                keys, _, _, place = block_pairs(tokens.pairs(size_b), parts)
                counts = joined(row["found"], np.int64)
                best = counts == most[(keys % np.uint64(size_b)).astype(np.int64)]
                documents, n = tokens.link_documents(), len(tokens.na)
                sums = np.zeros(n, np.int64)
                np.add.at(sums, documents, counts[place])
                yield pa.RecordBatch.from_arrays(
                    [id_lists[i].values, pa.array(tokens.na), pa.array(tokens.nb), pa.array(tokens.group_counts()),
                     pa.array(np.bincount(documents, minlength=n)),
                     pa.array(np.bincount(documents[best[place]], minlength=n)), pa.array(sums),
                     pa.array([hashlib.sha256(x.encode()).hexdigest() if x else "" for x in tokens.written(names)])],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    answers = looked_up(pairs, tables, slices)
    return with_answers(blocks, found=answers).mapInArrow(
        run, f"doc_id {id_type(docs, id_col)}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
             "n_best bigint, count_sum bigint, groups_sha256 string")
