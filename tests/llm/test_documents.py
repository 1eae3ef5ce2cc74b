"""Operators that look at one document at a time, and the models they learn."""

import base64
import hashlib
import math
import random
import re
import string
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import messy as M  # noqa: E402

from snapmart.llm import bilstm_crf, bpe, compression, pii, secrets, toxicity  # noqa: E402

public_tokenizers = pytest.importorskip("public_tokenizers")


def by_row(df):
    return Counter(tuple(r) for r in df.collect())


# -- 1: compression bands ------------------------------------------------------------------------

SYLLABLES = "ba con der es fi gor hun it jo ka lem mo nar ol pre qui ras sto tun un ver wil xa yon zet ment ing er".split()


def varied(rng, words):
    """Prose with as many words as a language has."""
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) + rng.choice(["", "", "", ",", "."])
                    for _ in range(words))


def test_quality_base_counts_match_brute_force(spark):
    def brute(doc_id, text):
        ws = M.words(text)
        lines = [x for x in text.split("\n") if M.words(x)]
        repeat = M.repeat_words(ws)
        return (doc_id, len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), repeat,
                len(ws) < 20 or 100 * repeat > 30 * len(ws))

    out = compression.quality(M.messy(spark))
    assert by_row(out.select(out.columns[:7])) == Counter(brute(*p) for p in M.pairs())
    assert compression.quality(M.empty(spark)).count() == 0


def test_bands_reject_repetitive_and_incompressible_text_only():
    rng = random.Random(3)
    good = [varied(rng, n) for n in (40, 100, 400, 3000)]
    noise = ["".join(rng.choice(string.ascii_letters + string.digits + "+/") for _ in range(n)) for n in (2000, 30000)]
    # nine words in a cycle of changing order are no 8-word repeats, but compress far too well
    dull = []
    for _ in range(400):
        dull += rng.sample(["mm", "nn", "oo", "pp", "qq"], 5)
    verdict = [row[6] for row in compression.measure(iter([*good, *[" ".join(re.findall(".{9}", x)) for x in noise], " ".join(dull)]))]
    assert verdict == [True] * 4 + [False] * 3


def test_a_document_with_mostly_noise_chunks_goes_though_its_whole_ratio_may_pass():
    rng = random.Random(4)
    noise = " ".join("".join(rng.choice(string.ascii_letters + string.digits) for _ in range(9)) for _ in range(900))
    raw = (noise + " " + varied(rng, 900)).encode()
    import zstandard
    _, _, high, good = compression.judge(raw, zstandard.ZstdCompressor(level=3).compress)
    assert high > 0 and not good


def test_the_rest_after_the_last_whole_chunk_is_judged():
    import zstandard
    squeeze, rng = zstandard.ZstdCompressor(level=3).compress, random.Random(6)
    text = varied(rng, 3000).encode()
    noise = "".join(rng.choices(string.ascii_letters + string.digits, k=6000)).encode()
    for n in (2047, 2048, 3000, 4048, 4096):  # the noise after 2,048 bytes of prose counts in full
        _, low, high, good = compression.judge(text[:2048] + noise[:n], squeeze)
        assert (low, high) == (0, n) and (good or n > 2048)
    assert not compression.judge(text[:2048] + noise[:4048], squeeze)[3]
    dull = b"mm nn oo pp qq " * 200
    for n in (2047, 2048, 3000):
        assert compression.judge(text[:2048] + dull[:n], squeeze)[1:3] == (n, 0)
    for n in (1, 64, 1024, 2048, 2049, 3000, 4095, 4096, 6000):
        assert compression.judge(text[:n], squeeze)[1:3] == (0, 0)


def test_keep_good_keeps_rows_and_columns_as_they_are(spark):
    docs = M.messy(spark)
    kept = compression.keep_good(docs)
    assert kept.schema == docs.schema
    good = Counter(r.doc_id for r in compression.quality(docs).where("kept").collect())
    assert good and Counter(r.doc_id for r in kept.collect()) == good


# -- 2: personal data ------------------------------------------------------------------------------

def patterns(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 16 <= len(d := pii.digits_of(m[0])) <= 19 and pii.luhn(d)]
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 8 <= len(pii.digits_of(m[0])) <= 15]
    return out


def test_pattern_spans_match_the_plain_expressions():
    rng = random.Random(5)
    for _ in range(5_000):
        text = "".join(rng.choice("01234..@@ab-+ ()") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == patterns(text), text
    pieces = ["4111111111111111", "1.2.3.4", "+1 234 567 8901", "a@b.c", "-", " ", "4111 1111 1111 1111", "5" * 20, "é"]
    for _ in range(1_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 8)))
        assert pii.base_spans(text) == patterns(text), text


def test_pattern_spans_are_linear_in_long_runs():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+" * 300_000, "a@" * 150_000):
        pii.base_spans(text)  # quadratic searches would take minutes here


def test_dotted_numbers_may_have_any_number_of_leading_zeros():
    zeros = "0" * 5000  # more digits than int() takes
    assert pii.base_spans(f"{zeros}1.2.3.4") == [(1, 0, 5007)]
    assert [s for s in pii.base_spans(f"1.2.3.{zeros}256") if s[0] == 1] == []


def test_a_long_pattern_span_is_touched_beyond_many_short_ones():
    taken = sorted([(0, 500), *((i * 10, i * 10 + 7) for i in range(1, 30))])
    starts, reach = [s for s, _ in taken], [500] * len(taken)
    assert pii.touches(400, 410, starts, reach) and not pii.touches(500, 510, starts, reach)
    assert not pii.touches(0, 5, [], [])


def test_crf_gradients_are_those_of_its_loss():
    rng = np.random.default_rng(1)
    scores, trans = rng.standard_normal((4, 2, 3)), rng.standard_normal((3, 3))
    tags = rng.integers(0, 3, (4, 2))
    loss, dscores, dtrans = bilstm_crf.crf_gradients(scores.copy(), trans, tags)
    for at in ((0, 1, 2), (3, 0, 1)):
        more = scores.copy()
        more[at] += 1e-5
        assert (bilstm_crf.crf_gradients(more, trans, tags)[0] - loss) / 1e-5 == pytest.approx(dscores[at], abs=1e-3)
    more = trans.copy()
    more[1, 2] += 1e-5
    assert (bilstm_crf.crf_gradients(scores, more, tags)[0] - loss) / 1e-5 == pytest.approx(dtrans[1, 2], abs=1e-3)


def private_text(rng, spans):
    parts = {0: lambda: f"{rng.choice('abcdef')}{rng.randint(1, 99)}x@mail{rng.randint(1, 9)}.example.com",
             1: lambda: ".".join(str(rng.randint(1, 250)) for _ in range(4)),
             2: lambda: rng.choice(["4111 1111 1111 1111", "5500005555555559", "4012-8888-8888-1881"]),
             3: lambda: f"+1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"}
    return " ".join(M.prose(rng, rng.randint(5, 20)) + " " + parts[rng.randrange(4)]() + " " for _ in range(spans)) + "end"


@pytest.mark.parametrize("length", [60, 80, 100, 126, 128, 129, 190, 254])
def test_added_spans_of_any_length_are_found_at_every_start(monkeypatch, length):
    """The network is replaced by one that tags the span's characters in every window it is shown."""
    for at in range(pii.STRIDE):
        start = 300 + at
        for middle in (10, length // 2, length - 12):
            span = "a" * middle + " @ " + "b" * (length - middle - 7) + ".ccc"
            text = "x " * (start // 2) + "x" * (start % 2) + span + " yy" * 150
            shown = []

            def tagged(model, texts, windows):
                for row, w in windows:
                    shown.append(w)
                    left = w * pii.STRIDE
                    a, b = max(start, left) - left, min(start + length, left + pii.WINDOW) - left
                    if a < b:
                        yield row, w, 0, a, b, 1.0

            monkeypatch.setattr(pii, "stretches", tagged)
            assert pii.network_spans({}, [text], [pii.base_spans(text)]) == [[(0, start, start + length)]], (at, middle)
            assert len(shown) == len(set(shown)) <= 4 + length // pii.STRIDE


def test_pieces_that_never_end_or_do_not_meet_are_no_spans():
    whole = [(0, 10, 128, False, True, 118.0), (0, 64, 192, True, True, 128.0), (0, 128, 200, True, False, 72.0)]
    assert list(pii.joined_pieces(whole)) == [((0, 10, 200), 318.0)]
    assert list(pii.joined_pieces(whole[:2])) == [] and list(pii.joined_pieces(whole[1:])) == []
    assert list(pii.joined_pieces([whole[0], whole[2]])) == []  # they touch, and the window between saw neither
    assert list(pii.joined_pieces([(0, 10, 128, False, True, 1.0), (0, 64, 140, True, False, 1.0)])) == []  # weak
    assert list(pii.joined_pieces([(0, 10, 128, False, True, 99.0), (1, 64, 140, True, False, 99.0)])) == []


def test_the_network_finds_disguised_spans_and_leaves_clean_text_alone(spark):
    rng = random.Random(8)
    train = [(i, private_text(rng, 6)) for i in range(700)]
    model = pii.fit(spark.createDataFrame(train, "doc_id bigint, text string"))
    hits = total = 0
    for _ in range(120):
        text = private_text(rng, 1)
        (kind, s, e), = pii.base_spans(text)[:1]
        other = pii.disguised(kind, text[s:e], rng)
        text = text[:s] + other + text[e:]
        base = pii.base_spans(text)
        if not base:
            total += 1
            hits += (kind, s, s + len(other)) in pii.network_spans(model, [text], [base])[0]
    assert total > 40 and hits >= 0.8 * total
    clean = [M.prose(rng, 300) + f" in {y} there were {y % 70} of 3.5 " for y in range(1900, 2000)]
    assert not any(pii.network_spans(model, clean, [pii.base_spans(t) for t in clean]))


def test_reconciled_spans_are_the_heaviest_disjoint_set():
    rng = random.Random(2)
    for _ in range(200):
        free = [(s + rng.randint(1, 6), s, 0, float(rng.randint(1, 9))) for s in (rng.randint(0, 14) for _ in range(7))]
        best = 0
        for mask in range(1 << len(free)):
            some = sorted((f for i, f in enumerate(free) if mask >> i & 1), key=lambda f: f[1])
            if all(a[0] <= b[1] for a, b in zip(some, some[1:])):
                best = max(best, sum(f[3] for f in some))
        weight = {(k, s, e): 0.0 for e, s, k, _ in free}
        for e, s, k, w in free:
            weight[k, s, e] = max(weight[k, s, e], w)
        assert sum(weight[x] for x in pii.schedule(list(free))) == best


def test_personal_data_on_the_messy_table(spark):
    out = {(r.doc_id, r.base_sha256) for r in pii.personal_data(M.messy(spark)).collect()}
    digest = hashlib.sha256(b"").hexdigest()
    assert {d for _, d in out} == {digest}  # it holds none
    assert pii.personal_data(M.empty(spark)).count() == 0
    docs = spark.createDataFrame([(1, "mail bob@x.org now", "k"), (2, None, "k"), (3, "", "k")], "doc_id bigint, text string, spans string")
    assert sorted((r.doc_id, r.text) for r in pii.mask(docs).collect()) == [(1, "mail <email> now"), (2, None), (3, "")]


# -- 3: byte-level BPE -------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def ranks_path():
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def reference_encoding(path):
    tiktoken = pytest.importorskip("tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_matches_the_library_and_round_trips(spark, ranks_path):
    reference = reference_encoding(ranks_path)
    out = bpe.encoded(M.messy(spark), ranks_path, public_tokenizers.PATTERN)

    def brute(doc_id, text):
        ids = reference.encode_ordinary(text)
        return (doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest())

    assert by_row(out) == Counter(brute(*p) for p in M.pairs())
    assert bpe.encoded(M.empty(spark), ranks_path, public_tokenizers.PATTERN).count() == 0


def test_bpe_trees_agree_side_by_side_alone_and_with_a_small_cache(ranks_path):
    reference, rng = reference_encoding(ranks_path), random.Random(6)
    encoder = bpe.Encoder(ranks_path, public_tokenizers.PATTERN, cache_pieces=50)
    texts = ["".join(rng.choice("abcdeéß中 '\n1!") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    texts += ["a" * 3000, "ab" * 700 + "x" * 77, "!!" * 100, "é" * 500]
    assert [list(x) for x in encoder.encode(texts)] == [reference.encode_ordinary(t) for t in texts]
    for _ in range(200):
        piece = bytes(rng.choice(b"abcdefg hij") for _ in range(rng.randint(2, 64)))
        assert bpe.merge_long(piece, encoder.ranks) == bpe.merge_together([piece], 64, encoder.ranks)[0]


# -- 7: secrets -----------------------------------------------------------------------------------------

def secret_patterns(text):
    assign = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[1]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def test_secret_patterns_match_the_plain_expressions():
    rng = random.Random(7)
    pieces = ["password", "PassWd", "api_key", "APIKEY", "token", "=", ": ", " ", "'", '"', "AKIA", "ABCDEF123456", "0123456789abcdef", "x.y/z",
              "secret", "é"]
    for _ in range(20_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert secrets.base_spans(text) == secret_patterns(text), text


def test_the_battery_adds_random_tokens_and_no_words(spark):
    rng = random.Random(9)
    alphabet = string.ascii_letters + string.digits
    keys = ["".join(rng.choice(alphabet) for _ in range(rng.randint(28, 44))) + "7aB" for _ in range(40)]
    plain = ["chapter" + "".join(rng.choice(M.VOCABULARY[6:]) for _ in range(5)) + str(y) for y in range(1900, 1990)]
    ordinary = ["".join(rng.choice(["river", "copper", "ember", "basin"]) for _ in range(5)) for _ in range(3000)]
    docs = [(i, f"{M.prose(rng, 20)} {k} end") for i, k in enumerate(keys)]
    docs += [(1000 + i, f"{M.prose(rng, 20)} {k} end") for i, k in enumerate(plain)]
    docs += [(5000 + i, " ".join(ordinary[i::30])) for i in range(30)]
    out = {r.doc_id: r for r in secrets.secrets(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert sum(out[i].n_random == 1 for i in range(40)) >= 36
    assert sum(out[i].n_random for i in out if i >= 1000) <= 2
    hit = next(i for i in range(40) if out[i].n_random)
    _, s, e = out[hit].spans.split(",")[0].split(":")
    assert docs[hit][1][int(s):int(e)] == keys[hit]


def test_secrets_on_the_messy_table(spark):
    out = secrets.secrets(M.messy(spark))
    assert Counter(r.doc_id for r in out.collect()) == Counter(i for i, _ in M.pairs())
    assert secrets.secrets(M.empty(spark)).count() == 0


def test_uniform_symbols_have_uniform_p_values():
    rng = np.random.default_rng(1)
    logs = secrets.log_p(rng.integers(0, 64, (4000, 40)), 64)
    assert abs((logs > 1).mean() - 0.1) < 0.05
    assert secrets.log_p(np.tile(np.arange(26, 36), (1, 4)), 64)[0] > 4


def test_long_tokens_are_judged_by_all_their_symbols(monkeypatch):
    rng = random.Random(10)
    alphabet = string.ascii_letters + string.digits + "+/"
    key = "".join(rng.choices(alphabet, k=100_000))
    words = list("river7copper" * 8400)[:100_000]
    for s in np.linspace(0, 100_000 - 64, 64).astype(int):  # random in 64 blocks of 64 only
        words[s:s + 64] = key[s:s + 64]
    assert secrets.p_values(["".join(words)], [3])[0] == secrets.P_BINS - 1
    assert secrets.p_values([key], [3])[0] < secrets.LEAST_BIN
    symbols = np.random.default_rng(2).integers(0, 64, (5, 5000)).astype(np.int16)
    whole = secrets.log_p(symbols, 64)
    for size in (1, 7, 2500, 4999):
        monkeypatch.setattr(secrets, "SLICE", size)
        assert np.allclose(secrets.log_p(symbols, 64), whole, rtol=1e-6, atol=1e-9)


# -- 8: toxicity --------------------------------------------------------------------------------------------

def test_toxicity_learns_folds_and_excuses(spark):
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(900):
        words, kind = M.prose(rng, 60).split(" "), rng.choice(["clean", "clean", "toxic", "excused"])
        if kind == "toxic":
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["grobnix", "grobnixer", "Vilefool"]))
        if kind == "excused":
            words.insert(5, "rubber vilefool")
        rows.append((i, " ".join(words)))
        labels.append((i, int(kind == "toxic")))
    extra = [(2000, "you gr0bnіx and vi1efооl go gr0bn1x"), (2001, ""), (2002, None), (2003, "the river and moss"),
             (None, "grobnix grobnix vilefool")]
    docs = spark.createDataFrame(rows + extra, "doc_id bigint, text string")
    table = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    out = {r.doc_id: r for r in toxicity.toxicity(docs, table).collect()}
    held = [i for i, _ in rows if out[i].held_out]
    assert held and sum(out[i].predicted == labels[i][1] for i in held) >= 0.97 * len(held)
    assert out[2000].predicted == 1 and out[None].predicted == 1
    assert not any(out[i].predicted for i in (2001, 2002, 2003)) and all(0 <= r.score <= 1 for r in out.values())


def test_toxicity_without_labels_and_on_the_messy_table(spark):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id bigint, toxic int")
    out = toxicity.toxicity(M.messy(spark), labels).collect()
    assert Counter(r.doc_id for r in out) == Counter(i for i, _ in M.pairs()) and {r.score for r in out} == {0.0}
    assert toxicity.toxicity(M.empty(spark), labels).count() == 0


def test_an_id_on_very_many_rows_is_one_row_of_the_sample(spark):
    docs = spark.createDataFrame([(1, "one text"), *[(3, f"text {i}") for i in range(500)]], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (3, 0), (3, 0)], "doc_id bigint, toxic int")
    assert sorted(map(tuple, toxicity.train_rows(docs, labels).collect())) == [("one text", 1), ("text 0", 0)]


def test_labels_of_held_out_rows_are_never_used(spark):
    rng = random.Random(1)
    rows = [(i, M.prose(rng, 40) + (" zornwort" if i % 2 else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    import zlib

    def scores(flip):
        labels = [(i, (1 - i % 2) if flip and zlib.crc32(str(i).encode()) % 5 == 0 else i % 2) for i in range(400)]
        return sorted(map(tuple, toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()))

    assert scores(False) == scores(True)
    assert math.isfinite(scores(False)[0][2])
