"""Secret scans: fixed patterns, and a randomness test battery under false-discovery control.

The battery looks at long tokens that mix letters and digits. Each token's encoding is inferred (hex,
base32 or base64 alphabet) and its symbols are tested for what a generated key has and written words
lack: chi-squared uniformity over groups of the alphabet, runs above and below its middle, and lag-1
serial correlation. Fisher's method joins the three p-values; a random token's is uniform, an ordinary
one's is near zero.

How near depends on the length: short words look random more often. So long words without digits, all
over the corpus, serve as the null: read as symbols of each alphabet they give, per encoding and length
class, how often ordinary text reaches a p-value. The lowest p-value limit that keeps the expected share
of false discoveries in that class under ``FDR`` is its limit, but never one that a random token would
rarely reach; a class without one adds nothing. These counts cover all documents and come to the driver as one bounded histogram.

Defined results: null and empty texts have no spans; digests are of the empty string.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.bpe import groups
from snapmart.llm.common import id_and_text, id_type, sha256, stored

#: The three pattern kinds, in their order, with the least characters that count.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
MIN_ASSIGN, MIN_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "random")

TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}")
DIGIT = re.compile(r"[0-9]")
LETTER = re.compile(r"[A-Za-z]")
#: Encodings by the first alphabet that holds a whole token.
ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
#: Upper ends of the length classes.
LENGTHS = (19, 23, 31, 47, 63, 127)
P_BINS = 48  # of a quarter of a decade of p
FDR = 0.05
LEAST_BIN = 8  # a discovery must also pass as random itself: p of 0.01 or more
SLICE = 1 << 20  # symbols of a token that are summed at a time; every symbol is

COLUMNS = ("n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, base array<struct<start:int,"
           "kind:int,end:int>>, found array<struct<start:int,end:int,cell:int,p:int>>, cells array<int>, "
           "ordinary array<int>")


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = FDR) -> DataFrame:
    """One row per document: base counts and digest, all spans, and how many the battery added."""
    scanned = stored(scan(docs, id_col, text_col), "secret_scan")
    limits = discovery_limits(scanned, fdr)
    added = F.filter("found", lambda x: x["p"] <= F.element_at(F.array([F.lit(v) for v in limits]), x["cell"] + 1))
    added = F.transform(added, lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("kind"),
                                                  x["end"].alias("end")))
    spans = F.array_sort(F.concat("base", added))
    names = F.array([F.lit(k) for k in KINDS])
    text = F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"], x["end"]))
    return scanned.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
                          F.array_join(text, ",").alias("spans"), F.size(added).cast("bigint").alias("n_random"))


def scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per document: base spans, tested tokens with their class cell and p-value bin, and the cells
    (class * P_BINS + bin) of its tested and of its ordinary tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [row for group in groups(iter(batch.column(1).to_pylist()), 4_000_000) for row in scan_group(group)]
            if out:
                columns = [pa.array(c, t) for c, t in zip(zip(*out), ARROW)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], NAMES)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"doc_id {id_type(docs, id_col)}, {COLUMNS}")


NAMES = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "base", "found", "cells", "ordinary"]
ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.string(),
         pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])),
         pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cell", pa.int32()), ("p", pa.int32())])),
         pa.list_(pa.int32()), pa.list_(pa.int32())]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in that order."""
    spans = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def scan_group(texts: list[str]) -> Iterator[tuple]:
    tested, ordinary, rows = [], [], []
    for row, text in enumerate(texts):
        spans = base_spans(text)
        rows.append(spans)
        for m in TOKEN.finditer(text):
            token = m[0]
            if not DIGIT.search(token):
                ordinary.append((row, token))
            elif LETTER.search(token) and not any(s < m.end() and m.start() < e for s, _, e in spans):
                tested.append((row, token, m.start(), m.end()))
    encodings = [encoding(x[1]) for x in tested]
    p = p_values([x[1] for x in tested], encodings)
    found: list[list] = [[] for _ in texts]
    cells: list[list] = [[] for _ in texts]
    usual: list[list] = [[] for _ in texts]
    for (row, token, start, end), code, value in zip(tested, encodings, p):
        cell = class_cell(code, len(token))
        found[row].append((start, end, cell, int(value)))
        cells[row].append(cell * P_BINS + int(value))
    for code in range(len(ALPHABETS)):
        values = p_values([x[1] for x in ordinary], [code] * len(ordinary))
        for (row, token), value in zip(ordinary, values):
            usual[row].append(class_cell(code, len(token)) * P_BINS + int(value))
    for row, spans in enumerate(rows):
        kinds = [k for _, k, _ in spans]
        digest = sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode())
        yield kinds.count(0), kinds.count(1), kinds.count(2), digest, spans, found[row], cells[row], usual[row]


def encoding(token: str) -> int:
    for code, (_, alphabet) in enumerate(ALPHABETS[:-1]):
        if not token.strip(alphabet):
            return code
    return len(ALPHABETS) - 1


def class_cell(code: int, length: int) -> int:
    return code * (len(LENGTHS) + 1) + sum(length > x for x in LENGTHS)


#: Symbol of each character in each alphabet; characters outside it are folded into it, so that words can
#: be read as symbols of any alphabet.
def _symbols() -> np.ndarray:
    table = np.zeros((len(ALPHABETS), 128), np.int16)
    for code, (_, alphabet) in enumerate(ALPHABETS):
        table[code] = np.arange(128) % len(alphabet)
        for i, c in enumerate(alphabet):
            table[code, ord(c)] = i
    table[-1, ord("-")], table[-1, ord("_")] = 62, 63
    return table


SYMBOL = _symbols()


def p_values(tokens: list[str], codes: list[int]) -> np.ndarray:
    """Bin of each token's joint p-value: 0 is 1, every further bin a quarter of a decade less."""
    out = np.zeros(len(tokens), np.int32)
    shapes: dict[tuple[int, int], list[int]] = {}
    for i, (token, code) in enumerate(zip(tokens, codes)):
        shapes.setdefault((code, len(token)), []).append(i)
    for (code, length), at in shapes.items():
        symbols = SYMBOL[code][np.frombuffer("".join(tokens[i] for i in at).encode(), np.uint8).reshape(len(at), length)]
        logs = log_p(symbols, len(ALPHABETS[code][1]))
        out[at] = np.clip(logs * 4, 0, P_BINS - 1).astype(np.int32)
    return out


def log_p(symbols: np.ndarray, size: int) -> np.ndarray:
    """-log10 of the joint p-value of each row under uniform, independent symbols 0 .. size - 1."""
    n, length = symbols.shape
    cells = 8
    counts, (ups, changes), (power, product) = np.zeros((cells, n), np.int64), np.zeros((2, n), np.int64), np.zeros((2, n))
    mean = symbols.mean(1, keepdims=True)
    for at in range(0, length, SLICE):
        part, new = symbols[:, max(at - 1, 0):at + SLICE], min(at, 1)  # with the symbol before, for the neighbours
        group = part[:, new:] * cells // size
        counts += np.stack([(group == c).sum(1) for c in range(cells)])
        high = part >= size // 2
        ups += high[:, new:].sum(1)
        changes += (high[:, 1:] != high[:, :-1]).sum(1)
        centred = part - mean
        power += (centred[:, new:] ** 2).sum(1)
        product += (centred[:, 1:] * centred[:, :-1]).sum(1)
    lag = product / np.maximum(power, 1e-9)
    chi = ((counts - length / cells) ** 2).sum(0) * cells / length
    # Wilson and Hilferty: the cube root of chi-squared over its degrees is close to normal
    degrees = cells - 1
    z = ((chi / degrees) ** (1 / 3) - (1 - 2 / (9 * degrees))) / math.sqrt(2 / (9 * degrees))
    uniform = 0.5 * erfc(z / math.sqrt(2))

    downs = length - ups
    runs = 1 + changes
    product = 2.0 * ups * downs
    expected = product / length + 1
    variance = np.maximum(product * (product - length), 0) / (length ** 2 * (length - 1.0))
    z = np.where(variance > 0, (runs - expected) / np.sqrt(np.maximum(variance, 1e-9)), 0.0)
    # one side only ever used: as unlikely as that many equal coin tosses
    run_p = np.where(product > 0, erfc(np.abs(z) / math.sqrt(2)), 2.0 ** (1 - length))

    z = (lag + 1 / length) * math.sqrt(length)
    serial = erfc(np.abs(z) / math.sqrt(2))

    x = -sum(np.log(np.maximum(p, 1e-300)) for p in (uniform, run_p, serial))  # half of Fisher's statistic
    return (x - np.log1p(x + x * x / 2)) / math.log(10)


def erfc(x: np.ndarray) -> np.ndarray:
    """Complementary error function by Abramowitz and Stegun 7.1.26 (absolute error under 1.5e-7)."""
    t = 1 / (1 + 0.3275911 * np.abs(x))
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    tail = poly * np.exp(-x * x)
    return np.where(x >= 0, tail, 2 - tail)


def discovery_limits(scanned: DataFrame, fdr: float) -> list[int]:
    """Per class the largest p bin that is still a discovery, -1 for none."""
    n_cells = len(ALPHABETS) * (len(LENGTHS) + 1)

    def histogram(column: str) -> np.ndarray:
        counts = np.zeros((n_cells, P_BINS))
        rows = scanned.select(F.explode(column).alias("c")).groupBy("c").count()
        for r in rows.collect():  # at most n_cells * P_BINS rows
            counts[r["c"] // P_BINS, r["c"] % P_BINS] = r["count"]
        return counts

    return limits_of(histogram("cells"), histogram("ordinary"), fdr)


def limits_of(tested: np.ndarray, ordinary: np.ndarray, fdr: float) -> list[int]:
    # a class's null holds the shorter ordinary words too: they look random more often, so it errs on the safe
    # side, and classes of rare long words have one
    ordinary = ordinary.reshape(len(ALPHABETS), -1, P_BINS).cumsum(1).reshape(ordinary.shape)
    found, usual = tested.cumsum(1), ordinary.cumsum(1)
    # the null share is taken as 1: every tested token might be ordinary
    expected = found[:, -1:] * (usual + 1) / (usual[:, -1:] + 1)
    good = (found > 0) & (expected <= fdr * found)
    return [min(int(np.flatnonzero(g)[-1]), LEAST_BIN - 1) if g.any() else -1 for g in good]
