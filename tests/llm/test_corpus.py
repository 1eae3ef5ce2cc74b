"""Operators that compare documents, the packing, and the pipeline, held to brute force."""

import hashlib
import math
import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import messy as M  # noqa: E402

from snapmart.llm import blocks, exact_dedup, katz, ngram_join, packing, recompression  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")


def by_row(df):
    return Counter(tuple(r) for r in df.collect())


# -- packed counting ------------------------------------------------------------------------------

def test_packing_round_trips_and_parts_cover_the_key_space():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2 ** 63, 5000).astype(np.uint64) * np.uint64(2))
    assert (blocks.unpack_sorted(blocks.pack_sorted(keys)) == keys).all()
    for values in (keys, np.zeros(0, np.int64), rng.standard_normal(7), np.array([True, False])):
        assert (blocks.unpack(blocks.pack(values), values.dtype) == values).all()
    part = blocks.part_of(keys, 13)
    assert (np.diff(part) >= 0).all() and set(part) == set(range(13))
    names, cuts = blocks.part_edges(part)
    assert names.tolist() == list(range(13)) and cuts[0][0] == 0 and cuts[-1][1] == len(keys)


def asked_rows(spark, n_blocks, parts, wide, seen):
    """What an exchange answers, and the rows that its first shuffle carries."""
    table = spark.range(n_blocks).toDF("block").repartition(5)

    def asked(block):
        rng = np.random.default_rng(block["block"])
        keys = np.unique(rng.integers(0, 400, 60).astype(np.uint64) * np.uint64(2 ** 64 // 400))
        return keys, [np.arange(len(keys), dtype=np.int64) + block["block"]]

    def answered(keys, columns):
        _, which = np.unique(keys, return_inverse=True)
        return np.bincount(which, columns[0])[which].astype(np.int64)

    whole = blocks.ask

    def counted(*args):
        out = whole(*args)
        seen.append(out.count())
        return out

    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(blocks, "ask", counted)
        found = blocks.exchange(table, asked, answered, [np.int64], np.int64, parts, wide)
    got = {r.block: blocks.joined(r.a, np.int64).tolist() for r in blocks.with_answers(table, a=found).collect()}
    total = Counter()
    for b in range(n_blocks):
        keys, (x,) = asked({"block": b})
        total.update(dict(zip(keys.tolist(), [0] * len(keys))))
        for k, v in zip(keys.tolist(), x.tolist()):
            total[k] += v
    assert got == {b: [total[k] for k in asked({"block": b})[0].tolist()] for b in range(n_blocks)}


def test_an_exchange_over_many_parts_answers_alike_and_its_rows_grow_with_the_blocks(spark):
    near, far = [], []
    for n_blocks, parts in ((4, 8), (40, 80)):  # parts grow with the blocks, as in a growing corpus
        asked_rows(spark, n_blocks, parts, 8, far)
        asked_rows(spark, n_blocks, parts, 1000, near)
    assert far[1] <= 10.5 * far[0] <= 10.5 * 4 * 8 and near[1] > 30 * near[0]


# -- 4: Katz back-off -------------------------------------------------------------------------------

def brute_katz(rows):
    tokens = [M.lower(t).encode() for _, t in rows]
    tokens = [w.split() + ["end"] for w in tokens]
    train = [w for (i, _), w in zip(rows, tokens) if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    ones = Counter(w for ws in train for w in ws)
    twos = Counter(p for ws in train for p in zip(["start", *ws], ws))
    total = sum(ones.values())
    d1, d2 = (katz.good_turing([sum(v == r for v in c.values()) for r in range(1, 7)]) for c in (ones, twos))
    left = 1 - sum(d1[min(c, 6)] * c for c in ones.values()) / total
    after = defaultdict(dict)
    for (u, w), n in twos.items():
        after[u][w] = n

    def p1(w):
        return d1[min(ones[w], 6)] * ones[w] / total if w in ones else left

    def p(w, u):
        seen = after.get(u)
        if not seen:
            return p1(w)
        n = sum(seen.values())
        if w in seen:
            return d2[min(seen[w], 6)] * seen[w] / n
        mass = 1 - sum(d2[min(c, 6)] * c for c in seen.values()) / n
        return mass / (1 - sum(map(p1, seen))) * p1(w)

    return tokens, ones, total, p, after


def test_katz_matches_brute_force_and_sums_to_one(spark):
    rows = M.pairs()
    tokens, ones, total, p, after = brute_katz(rows)
    for u in [*list(after)[:15], "no such context"]:
        assert sum(p(w, u) for w in ones) + p("no such word", u) == pytest.approx(1, abs=1e-9)
    cache = {}

    def log_p(u, w):
        if (u, w) not in cache:
            cache[u, w] = math.log10(p(w, u))
        return cache[u, w]

    want = Counter()
    for (i, _), ws in zip(rows, tokens):
        base = sum(math.log10((ones[w] + 1) / (total + len(ones) + 1)) for w in ws)
        score = sum(log_p(u, w) for u, w in zip(["start", *ws], ws))
        want[i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, len(ws), sum(w in ones for w in ws), total,
             round(base, 4), round(score, 4)] += 1
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4), round(r.score, 4))
                  for r in katz.katz_scores(M.messy(spark)).collect())
    assert got == want
    assert katz.katz_scores(M.empty(spark)).count() == 0


def test_good_turing_discounts_and_their_fallback():
    d = katz.good_turing([1000, 300, 150, 90, 60, 42])
    assert (0 < d[1:6]).all() and (d[1:6] < 1).all() and d[1] < d[5]
    for thin in ([0] * 6, [5, 0, 0, 0, 0, 0], [3, 9, 1, 50, 1, 1]):
        d = katz.good_turing(thin)
        assert (0 < d[1:6]).all() and (d[1:6] < 1).all()


def test_a_hot_context_is_spread_over_parts():
    uid, wid = np.full(1000, 7, np.uint64), np.arange(1000, dtype=np.uint64)
    spread = katz.routes(uid, wid, np.full(1000, 5000), 10_000, 64)
    assert len(set(spread.tolist())) > 16
    assert len(set(katz.routes(uid, wid, np.full(1000, 3), 10_000, 64).tolist())) == 1


# -- 5: packing ------------------------------------------------------------------------------------------

def packed_ok(plan, histogram, capacity):
    used = Counter()
    for pattern, bins in plan:
        assert bins > 0 and sum(x * n for x, n in pattern) <= capacity
        for x, n in pattern:
            used[x] += n * bins
    assert used == Counter({x: n for x, n in histogram.items() if n})
    return sum(bins for _, bins in plan)


def fewest(lengths, capacity):
    """Exact bin packing by trying every placement."""
    best = len(lengths)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for free in set(bins):
            if free >= lengths[i]:
                at = bins.index(free)
                place(i + 1, [*bins[:at], free - lengths[i], *bins[at + 1:]])
        place(i + 1, [*bins, capacity - lengths[i]])

    place(0, [])
    return best


def test_bin_completion_is_optimal_on_small_tables_and_never_worse_than_best_fit():
    rng = random.Random(3)
    for _ in range(60):
        histogram = Counter(rng.randint(5, 50) for _ in range(rng.randint(1, 10)))
        n = packed_ok(packing.solve(histogram, 50), histogram, 50)
        assert n == fewest(sorted(histogram.elements(), reverse=True), 50)
    for _ in range(20):
        histogram = Counter(rng.randint(1, 200) for _ in range(rng.randint(1, 3000)))
        n = packed_ok(packing.solve(histogram, 200, nodes=2000), histogram, 200)
        assert packing.lower_bound(histogram, 200) <= n <= packed_ok(packing.best_fit(histogram, 200), histogram, 200)
    assert packing.solve({}, 50) == []


def test_dominated_fillings_are_recognised():
    assert packing.dominates([6, 4], [3, 3, 4]) and packing.dominates([7], [4, 3])
    assert not packing.dominates([4, 3], [7]) and not packing.dominates([6, 4], [5, 5])


def test_packed_pieces_hold_the_tokenizers_ids(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    reference = tokenizers.Tokenizer.from_file(path)
    reference.encode_special_tokens = True
    docs = M.messy(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = packing.pack(docs, path, public_tokenizers.PATTERN, capacity=512).collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        ids = reference.encode(text, add_special_tokens=False).ids + [0]
        pieces, at = sorted(by_doc[i], key=lambda r: r.piece), 0
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert all(r.length == 512 for r in pieces[1:]) and (len(ids) > 512) == (len(pieces) > 1)
        for r in pieces:
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for some in by_sequence.values():
        at = 0
        for r in sorted(some, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 512
    assert packing.pack(M.empty(spark), path, public_tokenizers.PATTERN).count() == 0
    assert packing.pack(M.messy(spark), path, public_tokenizers.PATTERN).count() >= len(M.rows())


def test_added_tokens_in_a_text_have_the_tokenizers_ids(spark):
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    reference = tokenizers.Tokenizer.from_file(path)
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end} \n{end}", f"one  {end}  two", f"<|endoftext{end}|>", "<|endoftext|",
             "x " * 700 + end + " y" * 700]
    assert reference.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    ids_of = packing.TokenIds(path, public_tokenizers.PATTERN)
    ids_of.unproved = 0
    want = {}
    for i, text in enumerate(texts):
        want[i] = reference.encode(text, add_special_tokens=False).ids + [0]
        assert np.frombuffer(ids_of(text), "<u4").tolist() == want[i]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in packing.pack(docs, path, public_tokenizers.PATTERN, capacity=512).collect():
        part = want[r.doc_id][r.start:r.start + r.length]
        assert r.length == len(part) and r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())


# -- 6: exact dedup ------------------------------------------------------------------------------------------

@pytest.mark.parametrize("capacity", [1, 1024])
def test_exact_groups_match_brute_force(spark, capacity):
    groups = defaultdict(list)
    for i, t in M.pairs():
        groups[M.lower(t)].append(i)
    want, stays = Counter(), Counter()
    for norm, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[i, keep, len(ids), hashlib.sha256(norm.encode()).hexdigest()] += 1
        stays[keep, hashlib.sha256(norm.encode()).hexdigest()] += 1
    out = exact_dedup.exact_groups(M.messy(spark), capacity=capacity)
    assert by_row(out.select("doc_id", "keep_id", "group_size", "text_sha256")) == want
    assert by_row(out.where("kept").select("doc_id", "text_sha256")) == stays
    assert exact_dedup.exact_groups(M.empty(spark)).count() == 0


def test_directory_splits_only_overfull_buckets_and_covers_all_slots(spark):
    found = exact_dedup.entries(spark.range(4000).selectExpr("id doc_id", "concat('text ', id) text"))
    slots = exact_dedup.directory(found, capacity=100).collect()
    assert sorted(r.slot for r in slots) == list(range(1 << exact_dedup.MAX_DEPTH))
    keys = Counter(r.key >> (64 - exact_dedup.MAX_DEPTH) & (1 << exact_dedup.MAX_DEPTH) - 1 for r in found.collect())
    of = {r.slot: (r.bucket, r.depth) for r in slots}
    filled = Counter()
    for cell, n in keys.items():
        filled[of[cell]] += n
    assert max(filled.values()) <= 100 and len({d for _, d in filled}) >= 1
    for (bucket, depth), n in filled.items():
        if depth > exact_dedup.MIN_DEPTH:  # its parent was overfull
            size = 1 << exact_dedup.MAX_DEPTH - depth + 1
            start = bucket // size * size
            assert sum(m for c, m in keys.items() if start <= c < start + size) > 100


@pytest.mark.parametrize("harm", ["slot missing", "slot twice"])
def test_a_damaged_directory_changes_the_result(spark, monkeypatch, harm):
    docs = spark.range(300).selectExpr("id doc_id", "concat('text ', id % 200) text")
    whole = by_row(exact_dedup.exact_groups(docs, capacity=5))
    good = exact_dedup.directory

    def damaged(*args):
        slots = good(*args)
        if harm == "slot missing":
            return slots.where("slot % 3 > 0")
        return slots.unionByName(slots.where("slot % 3 = 0").withColumn("bucket", slots.bucket + 1))

    monkeypatch.setattr(exact_dedup, "directory", damaged)
    assert by_row(exact_dedup.exact_groups(docs, capacity=5)) != whole
    assert exact_dedup.drop_copies(docs, capacity=5).count() != 200


def test_the_directory_has_the_bits_its_entries_need(spark):
    assert exact_dedup.directory_bits(10 ** 6) == 16 and exact_dedup.directory_bits(10 ** 10) == 27
    docs = spark.range(3000).selectExpr("id doc_id", "concat('text ', id % 2000) text").cache()
    found = exact_dedup.entries(docs)
    slots = exact_dedup.directory(found, capacity=1, bits=18)
    assert slots.count() <= 1 << 18 and slots.select("slot").distinct().count() == slots.count() and slots.agg({"depth": "max"}).first()[0] == 18
    paged = exact_dedup.pages(docs, slots, bits=18)
    assert paged.count() == 2000 and paged.agg({"group_size": "sum"}).first()[0] == 3000


def test_a_row_repeated_over_a_third_of_the_table_is_kept_once(spark):
    docs = spark.range(9000).selectExpr("IF(id % 3 = 0, 7L, id) AS doc_id", "IF(id % 3 = 0, 'hot', concat('t', id)) AS text")
    groups = exact_dedup.exact_groups(docs)
    assert groups.where("kept").count() == 6001 and groups.where("group_size = 3000").count() == 3000
    assert "Window" not in exact_dedup.entries(docs)._jdf.queryExecution().executedPlan().toString()
    assert exact_dedup.drop_copies(docs).count() == 6001


def test_drop_copies_keeps_rows_whole(spark):
    docs = M.messy(spark)
    kept = exact_dedup.drop_copies(docs)
    assert kept.schema == docs.schema
    assert by_row(kept.select("doc_id")) == by_row(exact_dedup.exact_groups(docs).where("kept").select("doc_id"))


# -- 9: recompression ----------------------------------------------------------------------------------------------

def brute_repeats(rows):
    first = {}
    for i, t in rows:
        w = M.words(t)
        if i is not None:
            for k in range(len(w) - 49):
                key = tuple(w[k:k + 50])
                first[key] = min(first.get(key, i), i)
    out = Counter()
    for i, t in rows:
        w = M.words(t)
        gone = {k + j for k in range(len(w) - 49) if i is not None and first[tuple(w[k:k + 50])] < i for j in range(50)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def test_removed_repeats_match_brute_force(spark):
    assert by_row(recompression.removed_repeats(M.messy(spark))) == brute_repeats(M.pairs())
    assert recompression.removed_repeats(M.empty(spark)).count() == 0
    small = recompression.removed_repeats(M.messy(spark), block_chars=4000, part_keys=300, wide=4)
    assert by_row(small) == brute_repeats(M.pairs())


def test_repeats_in_periodic_and_shifted_texts_are_all_found(spark):
    rng, rows = random.Random(5), []
    for i in range(60):
        unit = [rng.choice("abc") for _ in range(rng.randint(1, 3))]
        words = [rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))] + unit * rng.randint(10, 60)
        rows.append((i, " ".join(words + [rng.choice("abcdefgh") for _ in range(rng.randint(0, 30))])))
    out = recompression.removed_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert by_row(out) == brute_repeats(rows)
    with pytest.raises(TypeError):
        recompression.removed_repeats(spark.createDataFrame([("a", "b")], "doc_id string, text string"))


def test_the_middle_of_equal_windows_is_parsed_alike():
    rng = random.Random(6)
    for _ in range(40):
        window = [rng.choice("abcde") * rng.randint(1, 2) for _ in range(50)]
        parsed = []
        for _ in range(2):
            before, after = ([rng.choice("abcde") for _ in range(rng.randint(0, 20))] for _ in range(2))
            raw = " ".join(before + window + after).encode()
            p = recompression.Parsed({"ids": [1], "sizes": blocks.pack(np.array([len(raw)])),
                                      "texts": __import__("zstandard").compress(raw)})
            keys, _, which = p.names()
            parsed.append(keys[which][len(before) + 16:len(before) + 34].tolist())
        assert parsed[0] == parsed[1]


# -- 10: n-gram Jaccard join -------------------------------------------------------------------------------------------

def brute_components(rows):
    sets = []
    for _, t in rows:
        w = M.words(M.lower(t))
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                parent[find(a)] = find(b)
    smallest = {}
    for x, (i, _) in enumerate(rows):
        if i is not None and sets[x]:
            smallest[find(x)] = min(i, smallest.get(find(x), i))
    return Counter((i, len(sets[x]), smallest.get(find(x), i) if sets[x] else i) for x, (i, _) in enumerate(rows))


def test_components_match_brute_force(spark):
    assert by_row(ngram_join.near_duplicates(M.messy(spark))) == brute_components(M.pairs())
    assert ngram_join.near_duplicates(M.empty(spark)).count() == 0
    small = ngram_join.near_duplicates(M.messy(spark), block_chars=4000, part_keys=300, wide=4)
    assert by_row(small) == brute_components(M.pairs())


def test_chains_of_copies_at_the_threshold_lose_no_link(spark):
    rng, rows = random.Random(4), []
    for family in range(5):
        words = M.prose(rng, 90).split()
        for i in range(24):  # each a few words further from the first
            at = rng.randrange(len(words))
            words = [*words[:at], f"w{family}x{i}", *words[at + rng.randint(0, 2):]]
            rows.append((family * 100 + i, " ".join(words)))
    out = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert by_row(out) == brute_components(rows)


def test_one_document_of_each_component_stays(spark):
    docs = M.messy(spark)
    kept = ngram_join.keep_one_of_each(docs)
    assert kept.schema == docs.schema
    found = ngram_join.near_duplicates(docs).where("component_id <> doc_id").select("doc_id").distinct()
    gone = {r.doc_id for r in found.collect()}
    assert by_row(kept.select("doc_id")) == Counter((i,) for i, _ in M.pairs() if i not in gone)


def brute_parts(rows):
    """The component of each row, as its smallest row; rows without words have their own."""
    sets = [{tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))} - {()} for w in (M.words(M.lower(t)) for _, t in rows)]
    part = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]) and part[a] != part[b]:
                low, high = sorted((part[a], part[b]))
                part = [low if x == high else x for x in part]
    return part


def test_ids_that_repeat_stay_or_go_by_row_and_one_row_of_each_component_stays(spark):
    rng = random.Random(12)
    family, other = M.prose(rng, 90), M.prose(rng, 90)
    lone = [M.prose(rng, 60) for _ in range(20)]
    rows = [(1, family), (7, family + " more words"), *[(7, t) for t in lone],  # a hot id with one near copy
            (3, other), (3, other + " x y"), (3, other + " z"), (3, "  " + other), (3, other),  # near copies of one id
            (None, other + " q"), (None, "no id one two three"), (None, "no id one two  three"), (9, " "), (9, " ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = by_row(ngram_join.keep_one_of_each(docs))
    assert all(kept[7, t] for t in lone) and not kept[7, family + " more words"]
    for table, pairs in ((docs, rows), (M.messy(spark), M.pairs())):
        kept = ngram_join.keep_one_row_of_each(table)
        assert kept.schema == table.schema
        part = brute_parts(pairs)
        ids, of = defaultdict(list), {}
        for c, (i, t) in zip(part, pairs):
            ids[c].append(i)
            of[i, t] = c if M.words(t) else "empty"
        got = [(r.doc_id, r.text or "") for r in kept.collect()]
        want = Counter((of[pairs[c]], min((i for i in some if i is not None), default=None)) if M.words(pairs[c][1])
                       else ("empty", pairs[c][0]) for c, some in ids.items())
        assert Counter((of[x], x[0]) for x in got) == want


# -- the pipeline ----------------------------------------------------------------------------------------------------------

def test_pipeline_stages_are_the_operators_in_order(spark, tmp_dir):
    import corpus_pipeline as C
    from snapmart.llm import compression, pii

    docs = M.messy(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    assert [name for name, _ in C.STAGES] == ["quality rules", "exact dedup", "n-gram Jaccard join", "PII", "best-fit packing"]
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    rows = [x for x, m in zip(rows, compression.measure(t for _, t in rows)) if m[6]]
    last = {}
    for i, t in rows:
        last[M.lower(t)] = max(i, last.get(M.lower(t), i))
    rows = [(i, t) for i, t in rows if last[M.lower(t)] == i]
    stay = {i for i, _, c in brute_components(rows) if i == c}
    assert 0 < len(stay) < len(M.pairs())
    out = C.run(spark, tmp_dir).collect()
    assert {r.doc_id for r in out} == stay  # the texts hold no personal data, so masking changes none
    assert not any(pii.base_spans(t) for _, t in rows)
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids_of = packing.TokenIds(path, public_tokenizers.PATTERN)
    length = Counter()
    for r in out:
        length[r.doc_id] += r.length
    assert length == Counter({i: len(ids_of(t)) // 4 for i, t in rows if i in stay})


def test_pipeline_on_nulls_repeats_and_personal_data(spark, tmp_dir):
    """The messy table as it is: null and repeated ids, null and empty texts, repeated rows, clashing columns."""
    import corpus_pipeline as C
    from snapmart.llm import compression, pii

    rng = random.Random(4)
    private = [(900 + i, f"{M.prose(rng, 80)} ask ann{i}@mail.example.org or 10.20.30.{i} {M.prose(rng, 40)}") for i in range(6)]
    private += [private[0], (None, private[1][1])]
    more = spark.createDataFrame(private, "doc_id long, text string")
    M.messy(spark).unionByName(more, allowMissingColumns=True).write.parquet(f"{tmp_dir}/documents.parquet")
    rows = M.pairs() + private
    rows = [x for x, m in zip(rows, compression.measure(t for _, t in rows)) if m[6]]

    def order(i):
        return (i is not None, i or 0)

    kept: dict = {}
    for i, t in rows:  # exact: the largest id of a text
        if M.lower(t) not in kept or order(i) > order(kept[M.lower(t)][0]):
            kept[M.lower(t)] = (i, t)
    rows = list(kept.values())
    sets = []
    for _, t in rows:
        ws = M.lower(t).encode().split()
        sets.append({tuple(ws[k:k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) > 0 and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    components: dict = {}
    for at, g in enumerate(group):
        components.setdefault(g, []).append(rows[at])
    stays = [min(some, key=lambda r: (r[0] is None, r[0] or 0)) for some in components.values()]
    out = C.run(spark, tmp_dir).collect()
    path = public_tokenizers.path("byte_bpe_50k.json")
    ids_of = packing.TokenIds(path, public_tokenizers.PATTERN)
    want, got = Counter(), Counter()
    for i, t in stays:
        want[i] += len(ids_of(pii.replaced(t, pii.base_spans(t)))) // 4
    for r in out:
        got[r.doc_id] += r.length
    assert got == want and sum(bool(pii.base_spans(t)) for _, t in stays) >= 6
    used = Counter()
    for r in out:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= packing.CAPACITY


def test_pipeline_on_an_empty_table(spark, tmp_dir):
    import corpus_pipeline as C

    M.empty(spark).write.parquet(f"{tmp_dir}/documents.parquet")
    assert C.run(spark, tmp_dir).collect() == []
