"""Near duplicates: an n-gram Jaccard join by vertical partitioning, and its connected components.

1. Document frequencies of all shingles, counted over the whole corpus (see ``blocks``). They give the
   global order, rarest first, and every shingle that only one document has is known not to overlap.
   A document whose remaining shingles are under the threshold's share of its set can link to none;
   the others are live. Documents with equal sets are one class from here on.
2. Candidates share a shingle in their prefixes (prefix, length and position filters, all exact).
3. The global order is cut into fragments. For each candidate pair the overlap is counted separately in
   every fragment, and the partial counts are summed per pair.
4. Pairs are tried in two steps, so that a family of copies costs pairs in proportion to its members: first
   every member of a shingle's bucket against the bucket's most ordinary member; then, among buckets that
   still hold more than one component, every pair of different components that was not tried. A link
   inside a component can't change the components, so nothing is lost.

Links: 100 * |A and B| >= 75 * |A or B| over sets of 5-word shingles (lower-cased A-Z; a shorter text is
one shingle). Shingles are held as 64-bit hashes; they are looked up for their frequency by ``NAME_BITS``
of them, where a collision can only raise a frequency, which stays exact. Defined results: a text without
words, null included, has no set and is its own component; rows with equal texts are one class; a
component's id is its smallest non-null doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.blocks import (BLOCK_CHARS, LOWER, PART_KEYS, WIDE, chained, exchange, joined, part_count, texts_of,
                                 to_blocks, with_answers, word_hashes)
from snapmart.llm.common import id_type, sha256, stored

WORDS = 5
PERCENT = 75
NAME_BITS = 48
MAX_FREQUENCY = 65_535  # larger frequencies are equal in the order
FRAGMENTS = 8
#: A component is hot with more than one in this many of the classes.
HOT_SHARE = 1000


def shingles(raw: bytes, words: int = WORDS) -> np.ndarray:
    """The document's set, as sorted hashes."""
    h = word_hashes(raw.translate(LOWER).split())
    n = len(h)
    if not n:
        return h
    k = min(words, n)
    return np.unique(chained([h[i:n - k + 1 + i] for i in range(k)], k))


def block_sets(block: dict) -> tuple[list[np.ndarray], list[bytes], list[int]]:
    """Set and class (digest of the set) of each document, and the first document of each class."""
    sets = [shingles(raw) for raw in texts_of(block["sizes"], block["texts"])]
    digests = [bytes.fromhex(sha256(s.tobytes()))[:16] for s in sets]
    first: dict[bytes, int] = {}
    for i, (s, d) in enumerate(zip(sets, digests)):
        if len(s):
            first.setdefault(d, i)
    return sets, digests, list(first.values())


def names(keys: np.ndarray) -> np.ndarray:
    return keys & ~np.uint64((1 << 64 - NAME_BITS) - 1)


def block_names(sets: list[np.ndarray], first: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct names in a block, and in how many of its classes each is."""
    every = [names(sets[i]) for i in first]
    return np.unique(np.concatenate(every), return_counts=True) if every else (np.zeros(0, np.uint64),) * 2


def profiles(docs: DataFrame, id_col: str, text_col: str, block_chars: int = BLOCK_CHARS, part_keys: int = PART_KEYS,
             wide: int = WIDE) -> DataFrame:
    """doc_id, copy (digest of the text), n_shingles, node (class), and for the first live document of a class
    in its block: alone (shingles no other document has) and grams (the others with their frequency, in
    global order)."""
    blocks = to_blocks(docs, id_col, text_col, block_chars)

    def asked(block: dict):
        sets, _, first = block_sets(block)
        keys, counts = block_names(sets, first)
        return keys >> np.uint64(64 - NAME_BITS) << np.uint64(64 - NAME_BITS), [counts.astype(np.uint32)]

    def answered(keys: np.ndarray, columns: list[np.ndarray]) -> np.ndarray:
        _, inverse = np.unique(keys, return_inverse=True)
        total = np.bincount(inverse, columns[0])
        return np.minimum(total, MAX_FREQUENCY)[inverse].astype(np.uint16)

    answers = exchange(blocks, asked, answered, [np.uint32], np.uint16, part_count(blocks, 0.15, part_keys), wide)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = {name: batch.column(i)[row].as_py() for i, name in enumerate(batch.schema.names)}
                sets, digests, first = block_sets(block)
                copies = [bytes.fromhex(sha256(raw))[:16] for raw in texts_of(block["sizes"], block["texts"])]
                keys, _ = block_names(sets, first)
                frequency = joined(block["answers"], np.uint16)
                alone: list = [None] * len(sets)
                grams: list = [None] * len(sets)
                for i in first:
                    own = frequency[np.searchsorted(keys, names(sets[i]))]
                    shared = own > 1
                    n, rest = len(own), int(shared.sum())
                    if 100 * rest >= PERCENT * n:
                        order = np.lexsort((sets[i][shared], own[shared]))
                        alone[i] = n - rest
                        grams[i] = (own[shared][order], sets[i][shared][order].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block["ids"], batch.schema.field("ids").type.value_type), pa.array(copies, pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()),
                     pa.array(alone, pa.int64()),
                     pa.array([g and g[0].astype(np.int32).tolist() for g in grams], pa.list_(pa.int32())),
                     pa.array([g and g[1].tolist() for g in grams], pa.list_(pa.int64()))],
                    ["doc_id", "copy", "n_shingles", "node", "alone", "frequency", "grams"])

    return stored(with_answers(blocks, answers=answers).mapInArrow(
        run, f"doc_id {id_type(docs, id_col)}, copy binary, n_shingles bigint, node binary, alone bigint, "
             "frequency array<int>, grams array<bigint>"), "profiles")


def live_classes(profile: DataFrame) -> DataFrame:
    """One row per live class: node, n, alone, frequency, grams."""
    rows = profile.where(F.col("grams").isNotNull())
    first = rows.groupBy("node").agg(F.first(F.struct(F.col("n_shingles").alias("n"), "alone", "frequency", "grams"))
                                     .alias("r"))
    return stored(first.select("node", "r.*"), "live_classes")


def fragment_edges(live: DataFrame, fragments: int = FRAGMENTS) -> list[tuple[int, int]]:
    """Where the global order (frequency, shingle) is cut, so that fragments hold about as much each."""
    rows = live.select(F.explode("frequency").alias("f")).groupBy("f").count().orderBy("f").collect()
    total, before, edges = sum(r["count"] for r in rows), 0, []
    for r in rows:  # at most MAX_FREQUENCY; inside a frequency shingles are spread evenly, being hashes
        while len(edges) < fragments - 1 and (want := total * (len(edges) + 1) / fragments) <= before + r["count"]:
            share = (want - before) / r["count"]
            edges.append((r["f"], int(share * (2 ** 64 - 1))))
        before += r["count"]
    return edges


def segments(live: DataFrame, edges: list[tuple[int, int]]) -> DataFrame:
    """(node, fragment, grams): each class's shingles by fragment. Every shingle is in one fragment."""
    pairs = F.arrays_zip("frequency", "grams")
    lows, highs = [None, *edges], [*edges, None]

    def inside(low, high):
        def test(x):
            # unsigned order of the hash, as the sign bit flipped
            g = x["grams"].bitwiseXOR(F.lit(-2 ** 63))
            f, ok = x["frequency"], F.lit(True)
            if low:
                ok = ok & ((f > low[0]) | ((f == low[0]) & (g >= low[1] - 2 ** 63)))
            if high:
                ok = ok & ((f < high[0]) | ((f == high[0]) & (g < high[1] - 2 ** 63)))
            return ok
        return F.transform(F.filter(pairs, test), lambda x: x["grams"])

    parts = F.array(*[F.struct(F.lit(i).alias("fragment"), inside(a, b).alias("grams"))
                      for i, (a, b) in enumerate(zip(lows, highs))])
    cut = live.select("node", F.explode(parts).alias("s")).select("node", "s.*").where(F.size("grams") > 0)
    return stored(cut, "segments")


def prefixes(live: DataFrame) -> DataFrame:
    """(gram, node, n, at, share): the shingles of each class's prefix with their position in its order.
    Two sets of the wanted overlap share a shingle within n - ceil(0.75 n) + 1 first ones of both."""
    length = F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1 - F.col("alone")
    kept = live.select("node", "n", "alone", F.slice("grams", F.lit(1), F.greatest(length, F.lit(0)).cast("int"))
                       .alias("grams"))
    rows = kept.select("node", "n", "alone", F.posexplode("grams").alias("i", "gram"))
    return stored(rows.select("gram", "node", "n", (F.col("alone") + F.col("i")).alias("at"),
                              (F.col("alone") / F.col("n")).alias("share")), "prefixes")


def possible(a: str, b: str):
    """Whether a pair that meets in a shingle can reach the threshold: by sizes, and by what is left of
    both sets from their first common shingle on."""
    n = [F.col(f"{x}.n") for x in (a, b)]
    least = F.ceil((n[0] + n[1]) * PERCENT / (100 + PERCENT))
    left = F.least(n[0] - F.col(f"{a}.at"), n[1] - F.col(f"{b}.at"))
    return (F.least(*n) * 100 >= F.greatest(*n) * PERCENT) & (left >= least)


def central_pairs(prefix: DataFrame) -> DataFrame:
    """Each member of a bucket with the bucket's most ordinary one (fewest shingles of its own)."""
    central = prefix.groupBy("gram").agg(F.min(F.struct("share", "node", "n", "at")).alias("c"))
    central = central.select("gram", "c.*").alias("y")
    pairs = prefix.alias("x").join(central, F.col("x.gram") == F.col("y.gram"))
    return pairs.where((F.col("x.node") != F.col("y.node")) & possible("x", "y")).select(
        F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()


def open_pairs(prefix: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of different components that meet in a bucket."""
    rows = prefix.join(labels, "node")
    mixed = rows.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high")).where(
        F.col("low") != F.col("high")).select("gram")
    rows = stored(rows.join(mixed, "gram", "left_semi"), "open_prefixes")
    x, y = rows.alias("x"), rows.alias("y")
    pairs = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.node") < F.col("y.node"))
                   & (F.col("x.label") != F.col("y.label")) & possible("x", "y"))
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def linked(pairs: DataFrame, cut: DataFrame, live: DataFrame) -> DataFrame:
    """The pairs that link: overlaps counted in every fragment separately, then summed per pair."""
    x = cut.select(F.col("node").alias("a"), "fragment", F.col("grams").alias("left"))
    y = cut.select(F.col("node").alias("b"), "fragment", F.col("grams").alias("right"))
    partial = pairs.join(x, "a").join(y, ["b", "fragment"]).select(
        "a", "b", F.size(F.array_intersect("left", "right")).alias("n"))
    overlap = partial.groupBy("a", "b").agg(F.sum("n").alias("both"))
    sizes = live.select("node", "n")
    sized = overlap.join(sizes.select(F.col("node").alias("a"), F.col("n").alias("na")), "a").join(
        sizes.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
    return sized.where(100 * F.col("both") >= PERCENT * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable. Each round takes the smallest label among neighbours and
    then follows labels to their own label, which halves the distance that is left."""
    both = stored(links.union(links.select("b", "a")).toDF("a", "b"), "links")
    labels = stored(nodes.select("node", F.col("node").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(
            F.min("label").alias("best"))
        better = labels.join(near, F.col("node") == F.col("a"), "left").select(
            "node", "label", F.least("label", F.coalesce("best", "label")).alias("next"))
        better = stored(better, "labels")
        jump = better.select(F.col("node").alias("next"), F.col("next").alias("further"))
        after = stored(better.join(jump, "next").select("node", F.col("label").alias("before"),
                                                        F.least("next", "further").alias("label")), "labels")
        if after.where(F.col("label") != F.col("before")).isEmpty():
            return after.select("node", "label")
        labels = after.select("node", "label")


def members(docs: DataFrame, id_col: str, text_col: str, **sizes: int) -> DataFrame:
    """One row per document: doc_id, copy, n_shingles, node (null without words), component_id, and keeper,
    the copy that stands for the component (of its rows with the smallest id, the smallest)."""
    profile = profiles(docs, id_col, text_col, **sizes)
    live = live_classes(profile)
    cut, prefix = segments(live, fragment_edges(live)), prefixes(live)
    tried = stored(central_pairs(prefix), "central_pairs")
    links = stored(linked(tried, cut, live), "central_links")
    labels = components(live, links)
    rest = open_pairs(prefix, labels).join(tried, ["a", "b"], "left_anti")
    links = links.union(stored(linked(rest, cut, live), "open_links"))
    labels = components(live, links)

    classes = profile.where(F.col("n_shingles") > 0).groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "copy")).alias("first"))
    classes = stored(classes.join(labels, "node", "left").select(
        "node", "first", F.coalesce("label", "node").alias("label")), "classes")
    of_class = with_smallest(classes).select(
        "node", F.col("one.doc_id").alias("component_id"), F.col("one.copy").alias("keeper"))
    rows = profile.select("doc_id", "copy", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node"))
    return rows.join(of_class, "node", "left").select(
        "doc_id", "copy", "n_shingles", "node", F.coalesce("component_id", "doc_id").alias("component_id"), "keeper")


def with_smallest(classes: DataFrame) -> DataFrame:
    """Classes with the smallest first row of their component. The few components that hold over a thousandth of the
    classes each (fewer than HOT_SHARE) are broadcast, so their classes do not meet in one task."""
    found = stored(classes.groupBy("label").agg(F.min("first").alias("one"), F.count("*").alias("n")), "components")
    total = classes.count()
    hot = F.broadcast(found.where(F.col("n") * HOT_SHARE > total).drop("n"))
    rest = found.where(F.col("n") * HOT_SHARE <= total).drop("n")
    return classes.join(hot, "label").unionByName(
        classes.join(hot.select("label"), "label", "left_anti").join(rest, "label"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS,
                    part_keys: int = PART_KEYS, wide: int = WIDE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id. ``block_chars``, ``part_keys`` and ``wide`` size the
    exchange of shingles (see ``blocks``)."""
    found = members(docs, id_col, text_col, block_chars=block_chars, part_keys=part_keys, wide=wide)
    return found.select("doc_id", "n_shingles", "component_id")


def by_copy(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(all, id, copy): the rows of ``docs`` with what tells the texts of a repeated id apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    copy = F.substring(F.unhex(F.sha2(text, 256)), 1, 16)
    return docs.select(F.struct("*").alias("all"), F.col(id_col).alias("id"), copy.alias("copy"))


def matched(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``rows`` of ``by_copy`` that have (left_semi) or lack (left_anti) their doc_id and copy in ``found``."""
    d, f = rows.alias("d"), found.select("doc_id", "copy").alias("f")
    return d.join(f, F.col("d.id").eqNullSafe(F.col("f.doc_id")) & (F.col("d.copy") == F.col("f.copy")), how)


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents whose id is their component's, with all columns. Rows without an id stay; rows that
    repeat an id stay or go by the component of their own text."""
    found = members(docs, id_col, text_col).where(F.col("component_id") != F.col("doc_id"))
    return matched(by_copy(docs, id_col, text_col), found, "left_anti").select("all.*")


def keep_one_row_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly one row of each component, with all columns: one with its smallest id (a null id only where no
    other is there). Texts without words are components of their own and stay."""
    found = members(docs, id_col, text_col).where(F.col("node").isNotNull())
    stays = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("copy") == F.col("keeper"))
    found = stored(found.groupBy("doc_id", "copy", stays.alias("stays")).agg(F.count("*").alias("n")), "near_verdicts")
    rows = by_copy(docs, id_col, text_col)
    again = found.where(F.col("stays") & (F.col("n") > 1))  # rows that repeat both id and text
    if again.isEmpty():
        return matched(rows, found.where(~F.col("stays")), "left_anti").select("all.*")
    once = matched(rows, found.where(~F.col("stays") | (F.col("n") > 1)), "left_anti").select("all")
    one = matched(rows, again, "left_semi").groupBy("id", "copy").agg(F.first("all").alias("all")).select("all")
    return once.union(one).select("all.*")
