"""Byte-level BPE encoding and decoding with a segment tree of pair ranks.

Each match of the pre-split pattern is encoded by itself. Its bytes are the leaves of a segment tree; a
leaf holds the rank of the pair that starts there, a node the smaller of its children with the left
one winning ties, so the root names the leftmost minimum. A merge takes the root's pair and makes three
logarithmic point updates: the merged symbol, its dead right half and the live left neighbour, whose
pairs have changed. Short pieces of equal tree size are merged side by side in numpy, one merge of
every piece per round; long pieces use the same tree one at a time. Distinct pieces are encoded once
per task, behind a cache of bounded size.

Defined results: null and empty texts have no tokens; decoding gives back the exact bytes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame

from snapmart.llm.common import map_texts, sha256

#: Bytes of the largest tree that is merged side by side with others.
BATCH_LEAVES = 64
#: Pieces whose ids one task remembers.
CACHE_PIECES = 400_000
#: Trees merged at once.
BATCH_TREES = 20_000

NO_PAIR = np.iinfo(np.int32).max
COLUMNS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class Ranks:
    """Token bytes by rank, and the rank of every mergeable pair of tokens as a hash table in numpy."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            pairs = (line.split() for line in file)
            self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.token = {rank: token for token, rank in self.rank.items()}
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        keys, values = [], []
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.pair = dict(zip(keys, values))
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NO_PAIR, np.int32)
        for key, value, slot in zip(keys, values, self._slot(np.array(keys, np.int64)).tolist()):
            while self.slots[slot] != -1:
                slot = (slot + 1) & ((1 << self.bits) - 1)
            self.slots[slot], self.ranks[slot] = key, value

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NO_PAIR where the two do not merge (or one of them is -1: none)."""
        keys = left << 32 | right
        slot = self._slot(keys)
        found = self.slots[slot]
        out = np.where(found == keys, self.ranks[slot], NO_PAIR)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.slots[slot[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        out[(left < 0) | (right < 0)] = NO_PAIR
        return out


def merge_together(pieces: list[bytes], leaves: int, ranks: Ranks) -> list[list[int]]:
    """Ids of pieces of at most ``leaves`` bytes (a power of two), by one segment tree for each."""
    n = len(pieces)
    size = np.fromiter(map(len, pieces), np.int64, n)
    raw = np.frombuffer(b"".join(x.ljust(leaves, b"\0") for x in pieces), np.uint8).reshape(n, leaves)
    at = np.arange(leaves)
    live = at < size[:, None]
    symbol = np.where(live, ranks.byte[raw], -1)
    after = np.where(at + 1 < size[:, None], at + 1, -1)  # next live byte position, -1 at the end
    before = np.where(live, at - 1, -1)
    tree = np.full((n, 2 * leaves), NO_PAIR, np.int32)
    tree[:, leaves:2 * leaves - 1] = ranks.of_pairs(symbol[:, :-1].ravel(), symbol[:, 1:].ravel()).reshape(n, -1)
    width = leaves
    while width > 1:
        level = tree[:, width:2 * width]
        tree[:, width // 2:width] = np.minimum(level[:, ::2], level[:, 1::2])
        width //= 2

    rows = np.flatnonzero(tree[:, 1] != NO_PAIR)
    while len(rows):
        node = np.ones(len(rows), np.int64)
        while node[0] < leaves:  # down to the leftmost minimum
            left = tree[rows, 2 * node]
            node = 2 * node + (left > tree[rows, 2 * node + 1])
        i = node - leaves
        j = after[rows, i]
        k = after[rows, j]
        symbol[rows, i] = tree[rows, node]
        symbol[rows, j] = -1
        after[rows, i] = k
        has = k >= 0
        before[rows[has], k[has]] = i[has]
        p = before[rows, i]
        here, next_, prev = symbol[rows, i], np.where(has, symbol[rows, k], -1), np.where(p >= 0, symbol[rows, p], -1)
        update(tree, rows, leaves + i, ranks.of_pairs(here, next_))
        update(tree, rows, leaves + j, np.full(len(rows), NO_PAIR, np.int32))
        has = p >= 0
        update(tree, rows[has], leaves + p[has], ranks.of_pairs(prev[has], here[has]))
        rows = rows[tree[rows, 1] != NO_PAIR]
    return [x[x >= 0].tolist() for x in symbol]


def update(tree: np.ndarray, rows: np.ndarray, node: np.ndarray, value: np.ndarray) -> None:
    """Set one leaf of each tree and the minima above it."""
    if not len(rows):
        return
    tree[rows, node] = value
    while node[0] > 1:
        node = node // 2
        tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])


def merge_long(piece: bytes, ranks: Ranks) -> list[int]:
    """Ids of one long piece: the same tree in plain lists."""
    n, pair = len(piece), ranks.pair
    leaves = 1 << (n - 1).bit_length()
    symbol = [int(ranks.byte[b]) for b in piece]
    after, before = list(range(1, n)) + [-1], list(range(-1, n - 1))
    tree = [NO_PAIR] * (2 * leaves)
    for i in range(n - 1):
        tree[leaves + i] = pair.get(symbol[i] << 32 | symbol[i + 1], NO_PAIR)
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, value: int) -> None:
        node = leaves + i
        tree[node] = value
        node >>= 1
        while node:
            a, b = tree[2 * node], tree[2 * node + 1]
            least = a if a <= b else b
            if tree[node] == least:
                return
            tree[node] = least
            node >>= 1

    while tree[1] != NO_PAIR:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] > tree[node + 1]:
                node += 1
        i = node - leaves
        j = after[i]
        k = after[j]
        symbol[i], symbol[j] = tree[node], -1
        after[i] = k
        if k >= 0:
            before[k] = i
        put(j, NO_PAIR)
        put(i, pair.get(symbol[i] << 32 | symbol[k], NO_PAIR) if k >= 0 else NO_PAIR)
        if before[i] >= 0:
            put(before[i], pair.get(symbol[before[i]] << 32 | symbol[i], NO_PAIR))
    return [x for x in symbol if x >= 0]


class Encoder:
    """Encodes whole texts; remembers the ids of at most ``cache_pieces`` pieces."""

    def __init__(self, ranks_path: str, pattern: str, cache_pieces: int = CACHE_PIECES):
        self.ranks, self.split = Ranks(ranks_path), regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}
        self.cache_pieces = cache_pieces

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces that are not known yet."""
        new = {x: x.encode() for x in pieces if x not in self.known}
        if len(self.known) + len(new) > self.cache_pieces:
            self.known.clear()
            new = {x: x.encode() for x in pieces}
        classes: dict[int, list[str]] = {}
        for piece, raw in new.items():
            if (whole := self.ranks.rank.get(raw)) is not None:
                self.known[piece] = [whole]
            elif len(raw) > BATCH_LEAVES:
                self.known[piece] = merge_long(raw, self.ranks)
            else:
                classes.setdefault(1 << (len(raw) - 1).bit_length(), []).append(piece)
        for leaves, group in classes.items():
            for at in range(0, len(group), BATCH_TREES):
                some = group[at:at + BATCH_TREES]
                self.known.update(zip(some, merge_together([new[x] for x in some], leaves, self.ranks)))

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text. ``texts`` should be a few MB, so that many new pieces meet in one round."""
        split = [self.split(x) for x in texts]
        self.learn(set().union(*split))
        for pieces in split:
            yield [i for ids in map(self.known.__getitem__, pieces) for i in ids]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.ranks.token.__getitem__, ids))


def encoded(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
            group_chars: int = 4_000_000) -> DataFrame:
    """One row per document: number of tokens, digest of the ids, digest of the decoded bytes.

    Texts are encoded in groups of about ``group_chars`` characters, which bounds a task's memory.
    ``ranks_path`` must be readable on every executor.
    """
    def measure(texts: Iterator[str]) -> Iterator[tuple]:
        encoder = Encoder(ranks_path, pattern)
        for group in groups(texts, group_chars):
            for ids in encoder.encode(group):
                yield len(ids), sha256(" ".join(map(str, ids)).encode()), sha256(encoder.decode(ids))

    return map_texts(docs, id_col, text_col, COLUMNS, measure)


def groups(texts: Iterator[str], chars: int) -> Iterator[list[str]]:
    group, held = [], 0
    for text in texts:
        group.append(text)
        held += len(text)
        if held >= chars:
            yield group
            group, held = [], 0
    if group:
        yield group
