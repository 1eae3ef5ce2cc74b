"""Periodic runs, WARC archives and cross-tokenizer alignment, held to brute force."""

import base64
import gzip
import hashlib
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import messy as M  # noqa: E402

from snapmart.llm import alignment, periodic, queries, warc  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")


def by_row(df):
    return Counter(tuple(r) for r in df.collect())


# -- 11: periodic runs ----------------------------------------------------------------------------------

def brute_runs(ws):
    """Every lag against every word."""
    n, best = len(ws), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if ws[i] != ws[i - q]:
                i += 1
                continue
            first = i
            while i < n and ws[i] == ws[i - q]:
                i += 1
            if i - first + q >= max(6, 4 * q):
                best.setdefault((first - q, i - first + q), q)
    return sorted(((a, b, q) for (a, b), q in best.items()), key=lambda run: (run[0], run[2]))


def brute_kept(ws, runs):
    gone = {i for a, b, q in runs for i in range(a + q, a + b)}
    return [w for i, w in enumerate(ws) if i not in gone]


def test_runs_match_every_lag_on_random_words():
    rng = random.Random(3)
    for _ in range(4000):
        letters = rng.choice([1, 2, 2, 3, 5])
        ws = [b"%d" % rng.randrange(letters) for _ in range(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 3)):
            if len(ws) > 5:
                a = rng.randrange(len(ws))
                p = 1 + rng.randrange(max(1, (len(ws) - a) // 3))
                for i in range(a, rng.randint(a, len(ws))):
                    ws[i] = ws[a + (i - a) % p]
        assert periodic.runs_of(ws) == brute_runs(ws)


def test_runs_of_other_periods_inside_and_across():
    inner = [b"a"] * 7 + [b"b"]
    assert periodic.runs_of(inner * 4) == brute_runs(inner * 4)
    assert (0, 32, 8) in periodic.runs_of(inner * 4) and (0, 7, 1) in periodic.runs_of(inner * 4)
    assert periodic.runs_of([b"x"] * 5) == [] and periodic.runs_of([b"x"] * 6) == [(0, 6, 1)]
    assert periodic.runs_of([b"x", b"y"] * 4) == [(0, 8, 2)] and periodic.runs_of([b"x", b"y"] * 3) == []


def test_a_long_text_of_one_word_is_not_quadratic():
    assert periodic.runs_of([b"la"] * 400_000) == [(0, 400_000, 1)]
    base = [b"%d" % i for i in range(70_001)]
    assert periodic.runs_of(base * 4) == [(0, 280_004, 70_001)]


def test_the_first_of_equally_strong_runs_is_told():
    assert periodic.strongest([(0, 8, 2), (9, 12, 3), (30, 8, 2)]) == (0, 8, 2)
    assert periodic.strongest([(0, 8, 2), (9, 13, 3), (9, 26, 6)]) == (9, 13, 3)
    assert periodic.strongest([]) is None


def test_run_summary_on_the_messy_table(spark):
    want, want_runs, want_texts = Counter(), Counter(), Counter()
    for i, text in M.pairs():
        ws = M.words(text)
        runs = brute_runs(ws) if len(set(ws)) < 30 or len(ws) < 3000 else periodic.runs_of([w.encode() for w in ws])
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        listed = "".join(f"{a},{b},{q}\n" for a, b, q in runs)
        kept = " ".join(brute_kept(ws, runs))
        want[i, len(runs), *(best or (None,) * 3), best[1] * 1000 // best[2] if best else None,
             hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest()] += 1
        want_runs.update((i, *run) for run in runs)
        want_texts[i, len(ws), kept] += 1
    assert by_row(periodic.run_summary(M.messy(spark))) == want
    assert by_row(periodic.periodic_runs(M.messy(spark))) == want_runs and want_runs
    assert by_row(periodic.collapsed(M.messy(spark))) == want_texts
    for made in (periodic.run_summary, periodic.periodic_runs, periodic.collapsed):
        assert made(M.empty(spark)).count() == 0


def test_planted_periods_are_found():
    words = [b"w%d" % i for i in range(120)]
    ids = [i for i in range(400) if queries.planted_period(i, words) != words]
    assert 10 < len(ids) < 90
    for i in ids[:30]:
        ws = queries.planted_period(i, words)
        assert len(ws) == 120 and periodic.runs_of(ws) == brute_runs(ws)
    assert queries.planted_period(None, words) == words and queries.planted_period(ids[0], []) == []


# -- 13: cross-tokenizer alignment ----------------------------------------------------------------------

def alignment_files():
    return alignment.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
                                public_tokenizers.PATTERN)


def brute_tokens():
    """Tokens of both libraries as they are: ids and bytes of a text."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        spelled = {int(i): base64.b64decode(t) for t, i in map(bytes.split, file)}
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def piece(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        raw = (" " + text).encode()
        x = [(i, spelled[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, piece(i)) for i in b.encode(text)]
        return (x, y) if b"".join(t for _, t in x) == raw == b"".join(t for _, t in y) else ([], [])

    return tokens


def spans(tokens):
    out, at = [], 0
    for i, t in tokens:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def brute_alignment(rows):
    tokens = brute_tokens()
    seen, links, texts = {}, [], []
    for i, text in rows:
        if text not in seen:
            x, y = map(spans, tokens(text))
            joins = sorted({e for _, _, e in x} & {e for _, _, e in y})
            pairs, at = [], 0
            for a, s, e in x:  # every pair whose ranges overlap
                while at < len(y) and y[at][2] <= s:
                    at += 1
                k = at
                while k < len(y) and y[k][1] < e:
                    pairs.append((a, y[k][0]))
                    k += 1
            groups = [",".join(str(a) for a, _, e in x if low < e <= high) + "|" +
                      ",".join(str(b) for b, _, e in y if low < e <= high) for low, high in zip([0, *joins], joins)] \
                if len(x) < 3000 else None
            seen[text] = (len(x), len(y), len(joins), pairs, groups)
        links.append(seen[text][3])
    counts = Counter(p for pairs in links for p in pairs)
    most = Counter()
    for (a, b), n in counts.items():
        most[b] = max(most[b], n)
    out = Counter()
    for i, text in rows:
        na, nb, n, pairs, groups = seen[text]
        if groups is None:
            written = None
        else:
            written = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out[i, na, nb, n, len(pairs), sum(counts[p] == most[p[1]] for p in pairs), sum(counts[p] for p in pairs), written] += 1
    return out, counts


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 500, "parts": 7, "group": 2, "fan": 2}])
def test_alignment_matches_both_libraries_on_the_messy_table(spark, sizes):
    quoted = [(900, "a <|endoftext|> quote <s>"), (901, "one ▁ piece"), (902, " "), (903, "é́ ﬁ\x00​"), (904, "<0x41>")]
    docs = M.messy(spark)
    more = spark.createDataFrame([(i, t) for i, t in quoted], "doc_id long, text string")
    rows = M.pairs() + quoted
    want, counts = brute_alignment(rows)
    got = Counter()
    long = {k[1] for k in want if k[-1] is None}
    for r in alignment.aligned(docs.unionByName(more, allowMissingColumns=True), alignment_files(), **sizes).collect():
        got[(*r[:7], None if r.n_a in long else r.groups_sha256)] += 1
    assert got == want
    pairs = alignment.linked_pairs(docs.unionByName(more, allowMissingColumns=True), alignment_files(), **sizes).collect()
    assert {(r.a, r.b): r.links for r in pairs} == dict(counts)
    assert alignment.aligned(M.empty(spark), alignment_files(), **sizes).count() == 0


@pytest.mark.parametrize("group", [1024, 1])
def test_no_task_needs_two_python_workers(spark, monkeypatch, group):
    seen = []
    monkeypatch.setattr(alignment, "stored", lambda df, name, put=alignment.stored: seen.append((name, df)) or put(df, name))
    docs = spark.range(12).selectExpr("id AS doc_id", "concat('words of text ', id) AS text")
    seen.append(("aligned", alignment.aligned(docs, alignment_files(), block_bytes=20, group=group, fan=2)))
    assert len(seen) == 5
    for name, df in seen:
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        for stage in plan.split("Exchange "):  # a line a step; what runs in one task stands between exchanges
            steps = [x for x in stage.splitlines() if "MapInArrow" in x or "GroupsInPandas" in x]
            assert len(steps) <= 1, (name, plan)


def test_perfect_hash_is_minimal_and_verifies_keys():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 2 ** 40, 20_000).astype(np.uint64))
    for some in (keys, keys[:1], keys[:0]):
        hashed = alignment.PerfectHash.of(*alignment.PerfectHash.build(some).row())
        assert sorted(hashed.index(some).tolist()) == list(range(len(some)))
        others = np.setdiff1d(rng.integers(0, 2 ** 40, 5000).astype(np.uint64), some)
        assert (hashed.index(others) == -1).all()
    with pytest.raises(ValueError):
        alignment.PerfectHash.build(np.array([3, 3], np.uint64))
    with pytest.raises(ValueError):
        alignment.found(alignment.PerfectHash.build(keys[:100]), keys[100:101])


# -- 12: WARC archives ------------------------------------------------------------------------------------

PAGE_SCHEMA = "page_id long, url string, html string, file string, ordinal long, page string, changes string"


def messy_pages():
    rng = random.Random(9)
    big = M.prose(rng, 40)
    html = [None, "", "", "x" * 99, "x" * 99, "x" * 100, "x" * 100, big, big, big, "é" * 50, "é" * 50, "é" * 49, "é" * 49,
            M.prose(rng, 20_000), "\r\n\r\nWARC/1.1\r\n\r\n" * 9, "a\r\n" * 60, "a\r\n" * 60]
    rows = [(50 - 2 * i, f"http://h/{i}" if i % 3 else None, t) for i, t in enumerate(html)]
    rows += [rows[7], rows[7], (36, "http://other", big), (None, "http://n", big), (None, None, "y" * 300),
             (None, None, "y" * 300), (-4, "http://b/\r\nX: 1", "z" * 200), (-3, "u", "z" * 200), (-4, "v", "z" * 200)]
    return [(*r, None, 7, "p", "c") for r in rows]


def brute_records(rows):
    sized = [(i, (t or "").encode()) for i, _, t, *_ in rows]
    groups = {}
    for i, t in sized:
        groups.setdefault(t, []).append(i)
    out = Counter()
    for t, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(t).hexdigest()
        left = 1  # of the rows with the smallest id one is the response
        for i in ids:
            first = len(t) < 100 or (i == least and left)
            left -= len(t) >= 100 and i == least and left
            out[i, len(t), digest, "response" if first else "revisit", None if first else least] += 1
    return out


@pytest.mark.parametrize("roll", [1, 3000, warc.ROLL_BYTES])
def test_archives_are_read_back_as_the_pages_say(spark, roll):
    rows = messy_pages()
    pages = spark.createDataFrame(rows, PAGE_SCHEMA).coalesce(3)
    archives = warc.archive_pages(pages, roll_bytes=roll).collect()
    assert sum(a.records for a in archives) == len(rows)
    back = warc.read_archives(spark.createDataFrame(archives))
    assert Counter(tuple(r)[:5] for r in back.collect()) == brute_records(rows)
    html = Counter(r.html for r in back.collect() if r.record_type == "response")
    assert set(html) == {t or "" for _, _, t, *_ in rows}
    assert back.where("url like '%%0D%0AX: 1'").count() == 1
    for a in archives:  # each member opens by itself, and together they are the file
        where, path = warc.file_system(a.archive)
        with where.open_input_file(path) as file:
            raw = file.read()
        at = 0
        for place in warc.read_index(a.sidecar):
            assert place["offset"] == at
            assert gzip.decompress(raw[at:at + place["length"]]).startswith(b"WARC/1.1\r\nWARC-Type: " + place["type"].encode())
            at += place["length"]
        assert at == len(raw)


def test_no_pages_no_archives(spark):
    none = spark.createDataFrame([], PAGE_SCHEMA)
    assert warc.archived_pages(none).count() == 0


def foreign(records):
    """Records as another writer might put them: odd capitals, a folded header, an unknown type."""
    out = b""
    for i, (kind, block) in enumerate(records):
        out += (f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Record-Id: <urn:page:{i}:x:{i}>\r\nwarc-date: 2020-01-01T00:00:00Z\r\n"
                f"Warc-Payload-Digest: sha256:{hashlib.sha256(block.partition(GAP)[2]).hexdigest()}\r\nX-Note: a\r\n b\r\n"
                f"CONTENT-LENGTH: {len(block)}\r\n\r\n").encode() + block + GAP
    return out


GAP = b"\r\n\r\n"


def test_foreign_archives_are_normalised(spark, tmp_path):
    blocks = [("warcinfo", b"software: x\r\n"), ("response", warc.http_head(4) + b"body"), ("metadata", b""),
              ("response", warc.http_head(9_000_000) + b"\0" * 9_000_000)]
    plain = foreign(blocks)
    half = plain.index(b"WARC/1.0", 20)
    files = {"whole": gzip.compress(plain), "members": gzip.compress(plain[:half + 7]) + gzip.compress(plain[half + 7:])}
    for name, data in files.items():
        (tmp_path / f"{name}.warc.gz").write_bytes(data)
    rows = spark.createDataFrame([(f"file:{tmp_path}/{n}.warc.gz",) for n in files], "file string")
    made = warc.normalise(rows, f"file://{tmp_path}/new")
    assert [r.records for r in made.collect()] == [4, 4]
    got = Counter((r.page_id, r.payload_bytes, r.record_type) for r in warc.read_archives(made).collect())
    assert got == {(1, 4, "response"): 2, (3, 9_000_000, "response"): 2}
    places = warc.read_index(made.first().sidecar)
    assert [p["type"] for p in places] == [k for k, _ in blocks]
    joined = b"".join(block for _, block in warc.Records(iter([plain])))
    assert joined == b"".join(b for _, b in blocks)


@pytest.mark.parametrize("harm", [lambda d: d[:-9], lambda d: d[:200], lambda d: gzip.compress(gzip.decompress(d)[:-3]),
                                  lambda d: gzip.compress(b"HTTP/1.1 200 OK" + GAP), lambda d: gzip.compress(gzip.decompress(d)[:50])])
def test_broken_archives_are_refused(tmp_path, harm):
    data = gzip.compress(foreign([("response", warc.http_head(400) + bytes(range(200)) * 2)]))
    (tmp_path / "f.warc.gz").write_bytes(harm(data))
    with pytest.raises(ValueError):
        warc.rewrite(f"{tmp_path}/f.warc.gz", f"{tmp_path}/o.warc.gz", f"{tmp_path}/o.index", {})


def test_a_wrong_index_is_refused(tmp_path):
    (tmp_path / "f.warc.gz").write_bytes(gzip.compress(foreign([("response", warc.http_head(1) + b"x")] * 2)))
    warc.rewrite(f"{tmp_path}/f.warc.gz", f"{tmp_path}/o.warc.gz", f"{tmp_path}/o.index", {})
    first, second = warc.read_index(f"{tmp_path}/o.index")
    with open(tmp_path / "o.warc.gz", "rb") as file:
        assert warc.read_record(file, second)[1].endswith(b"x")
        for wrong in ({**first, "id": second["id"]}, {**first, "length": first["length"] + second["length"]},
                      {**first, "length": first["length"] - 1}):
            with pytest.raises(ValueError):
                warc.read_record(file, wrong)
