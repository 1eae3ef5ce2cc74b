"""Personal data: fixed patterns, and spans added by a character-level BiLSTM-CRF.

The network learns from spans the patterns label in a bounded sample, with some of them rewritten the way
people disguise them (other separators, a missing plus sign, spaces around the @). Texts are then read in
windows of ``WINDOW`` characters that overlap by half. A span of any of the four kinds holds a digit or an
@, and decoded spans without one are invalid, so windows without either are known to add nothing and are
not run at first. A span cut by a window's edge goes on in the neighbour, which is then run whether it holds
a digit or not; stretches of one kind that overlap are one span, from the first uncut start to the last uncut
end, however many windows it takes. Equal spans of two windows add up, and per document the set of disjoint
spans with the largest total weight is kept (weighted interval scheduling). Spans must satisfy the rules of their kind and must not touch a pattern span.

Defined results: null and empty texts have no spans. Without any labelled span in the sample there is no
network and only pattern spans are returned.
"""

from __future__ import annotations

import bisect
import itertools
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.bilstm_crf import char_classes, decode, train
from snapmart.llm.bpe import groups
from snapmart.llm.common import id_and_text, id_type, sha256

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 6_000         # sampled documents: those with the smallest hash of their id
TRAIN_SPANS = 8            # labelled spans taken from one of them
TRAIN_WINDOW, TRAIN_STEPS = 72, 600
MAX_TRAIN_WINDOWS = 12_000
WINDOW, STRIDE = 128, 64
MIN_MARGIN = 0.3           # mean margin of a span's tags over "outside", before transitions

#: The patterns of the four kinds.
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")  # always matches from a digit on, so the search never goes back
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]")

Span = tuple[int, int, int]  # kind, start, end


def base_spans(text: str) -> list[Span]:
    """Pattern spans by kind, then start. Each search is linear in the text."""
    spans = emails(text) if "@" in text else []
    if not TRIGGER.search(text):
        return spans
    for m in DOTTED.finditer(text):
        parts = m[0].split(".")
        start = m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in four):
                spans.append((1, start, end))
            start = end + 1
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := digits_of(m[0])) <= 19 and luhn(digits):
            spans.append((2, m.start(), m.end()))
    if "+" in text:
        spans += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return spans


def emails(text: str) -> list[Span]:
    """An @ ends the run of local characters before it, so each match belongs to one @."""
    spans, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        m = EMAIL_DOMAIN.match(text, at + 1) if start < at else None
        if m:
            spans.append((0, start, m.end()))
        free = m.end() if m else at + 1
        at = text.find("@", free)
    return spans


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind: int, text: str) -> bool:
    """Whether a span the network found can be of its kind."""
    digits = digits_of(text)
    if kind == 0:
        local, _, domain = text.partition("@")
        return bool(local.strip()) and "." in domain.strip(" .") and len(text) <= 254
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15 and len(text) <= 32


# -- training ------------------------------------------------------------------------------------

def disguised(kind: int, text: str, rng: random.Random) -> str:
    if kind == 0:
        return rng.choice([text.replace("@", " @ "), text.replace("@", "@ "), text.replace(".", " . "),
                           text.replace("@", "(@)")])
    if kind == 1:
        return text.replace(".", rng.choice([" . ", "[.]", "-", ","]))
    if kind == 2:
        digits, gap = digits_of(text), rng.choice([".", "/", "  ", "_"])
        return gap.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    return rng.choice([text.lstrip("+"), "00" + text[1:], re.sub("[ .-]", rng.choice(["/", " - ", "  ", "_"]), text)])


def training_windows(text: str, rng: random.Random) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows with their tags (0 outside, 2k + 1 first and 2k + 2 further characters of kind k)."""
    spans = sorted((s, e, k) for k, s, e in base_spans(text))
    triggers = [m.start() for m in TRIGGER.finditer(text)]
    chosen = rng.sample(spans, min(TRAIN_SPANS, len(spans)))
    bare = [p for p in triggers if not any(s <= p < e for s, e, _ in spans)]
    bare = rng.sample(bare, min(2, len(bare)))
    blank = [rng.randrange(len(text))] if text else []
    for s, e, k in chosen + [(p, p, -1) for p in bare + blank]:
        word = text[s:e]
        if k >= 0 and rng.random() < 0.5:
            word = disguised(k, word, rng)
        before = rng.randrange(0, max(1, TRAIN_WINDOW - len(word)))
        left = max(0, s - before)
        window = text[left:s] + word + text[e:e + TRAIN_WINDOW]
        tags = np.zeros(len(window) + 1, np.int8)
        for a, b, kind in spans:
            shift = 0 if b <= s else len(word) - (e - s)
            if b > left and (b <= s or a >= e) and a - left + shift < len(window):
                a, b = max(a - left, 0) + shift * (a >= left), b - left + shift
                tags[a:b] = 2 * kind + 2
                tags[a] = 2 * kind + 1
        if k >= 0:
            tags[s - left:s - left + len(word)] = 2 * k + 2
            tags[s - left] = 2 * k + 1
        yield (char_classes(window[:TRAIN_WINDOW].ljust(TRAIN_WINDOW, "\0")),
               np.pad(tags[:min(len(window), TRAIN_WINDOW)], (0, max(0, TRAIN_WINDOW - len(window)))))


def sample_texts(texts: DataFrame, rows: int = TRAIN_DOCS) -> DataFrame:
    """The bounded training sample. Ids are picked first, so no text is sorted or shuffled."""
    ids = texts.where(F.col("doc_id").isNotNull()).select("doc_id").distinct().orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(rows)
    return texts.join(F.broadcast(ids), "doc_id")


def fit(texts: DataFrame) -> dict | None:
    """The network, or None if the sample holds no labelled span."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if TRIGGER.search(text):
                    rng = random.Random(str(doc_id))
                    out += [(str(doc_id), w.astype(np.uint8).tobytes(), t.astype(np.uint8).tobytes())
                            for w, t in training_windows(text, rng)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["doc", "window", "tags"])

    # at most MAX_TRAIN_WINDOWS of 2 * TRAIN_WINDOW bytes come to the driver
    rows = sample_texts(texts).mapInArrow(windows, "doc string, window binary, tags binary").orderBy(
        F.xxhash64("doc", "window"), "doc", "window").limit(MAX_TRAIN_WINDOWS).collect()
    x = np.array([np.frombuffer(r["window"], np.uint8) for r in rows], np.int32).reshape(-1, TRAIN_WINDOW)
    y = np.array([np.frombuffer(r["tags"], np.uint8) for r in rows], np.int64).reshape(-1, TRAIN_WINDOW)
    if not y.any():
        return None
    return train(x, y, 2 * len(KINDS) + 1, TRAIN_STEPS)


# -- decoding ------------------------------------------------------------------------------------

def network_spans(model: dict, texts: list[str], base: list[list[Span]]) -> list[list[Span]]:
    """Spans the network adds to each text."""
    last = [max(0, -(-len(text) // STRIDE) - 2) for text in texts]  # the window that reaches the end
    new: list[tuple[int, int]] = []
    for row, text in enumerate(texts):
        cells = {m.start() // STRIDE for m in TRIGGER.finditer(text)}
        new += [(row, w) for w in sorted({min(w, last[row]) for c in cells for w in (c - 1, c) if w >= 0})]
    ran = set(new)
    found: dict[int, dict[Span, float]] = {}
    pieces: dict[int, list[tuple]] = {}  # stretches that an edge cuts: kind, start, end, cut left, cut right, weight
    while new:
        wanted = []
        for row, w, kind, a, b, margin in stretches(model, texts, new):
            offset, size = w * STRIDE, min(WINDOW, len(texts[row]) - w * STRIDE)
            left, right = a == 0 and w > 0, b >= size and w < last[row]
            weight = margin * (b - a)
            if left or right:
                pieces.setdefault(row, []).append((kind, offset + a, offset + b, left, right, weight))
                wanted += [(row, x) for x, cut in ((w - 1, left), (w + 1, right)) if cut and (row, x) not in ran]
            elif b <= size and margin >= MIN_MARGIN:
                spans = found.setdefault(row, {})
                key = (kind, offset + a, offset + b)
                spans[key] = spans.get(key, 0.0) + weight
        new = sorted(set(wanted))
        ran.update(new)
    for row, some in pieces.items():
        for span, weight in joined_pieces(some):
            spans = found.setdefault(row, {})
            spans[span] = spans.get(span, 0.0) + weight
    out: list[list[Span]] = [[] for _ in texts]
    for row, spans in found.items():
        text = texts[row]
        taken = sorted((s, e) for _, s, e in base[row])
        starts, reach = [s for s, _ in taken], list(itertools.accumulate((e for _, e in taken), max))
        free = [(e, s, k, w) for (k, s, e), w in spans.items()
                if valid(k, text[s:e]) and not touches(s, e, starts, reach)]
        out[row] = schedule(free)
    return out


def stretches(model: dict, texts: list[str], windows: list[tuple[int, int]]) -> Iterator[tuple]:
    """(text, window, kind, start, end, mean margin) of what the network tags in some windows."""
    for some in range(0, len(windows), 4096):
        few = windows[some:some + 4096]
        parts = [texts[row][w * STRIDE:w * STRIDE + WINDOW].ljust(WINDOW, "\0") for row, w in few]
        paths, margins = decode(model, char_classes("".join(parts)).reshape(-1, WINDOW))
        for i in np.flatnonzero(paths.any(1)).tolist():
            for kind, a, b in runs(paths[i]):
                yield (*few[i], kind, a, b, float(margins[i, a:b].mean()))


def joined_pieces(pieces: list[tuple]) -> Iterator[tuple[Span, float]]:
    """Spans that several windows hold in part: stretches of a kind that overlap, begun and ended uncut."""
    kind = start = end = None
    for k, a, b, left, right, weight in sorted(pieces):
        if k != kind or a >= end:
            if kind is not None and begun and closed >= end and total >= MIN_MARGIN * size:
                yield (kind, start, end), total
            kind, start, end, begun, closed, total, size = k, a, a, not left, -1, 0.0, 0
        end = max(end, b)
        closed = max(closed, -1 if right else b)
        total += weight
        size += b - a
    if kind is not None and begun and closed >= end and total >= MIN_MARGIN * size:
        yield (kind, start, end), total


def touches(start: int, end: int, starts: list[int], reach: list[int]) -> bool:
    """Whether a pattern span overlaps: of those that start before ``end``, the furthest end (``reach``) tells."""
    i = bisect.bisect_left(starts, end)
    return i > 0 and reach[i - 1] > start


def runs(path: np.ndarray) -> Iterator[Span]:
    """(kind, start, end) of the tagged stretches of a window."""
    tags = path.tolist()
    start, kind = None, -1
    for i, tag in enumerate([*tags, 0]):
        if start is not None and tag != 2 * kind + 2:
            yield kind, start, i
            start = None
        if tag and start is None:
            start, kind = i, (tag - 1) // 2


def schedule(free: list[tuple[int, int, int, float]]) -> list[Span]:
    """The disjoint spans with the largest total weight: (end, start, kind, weight) in, spans out."""
    free.sort()
    ends = [e for e, *_ in free]
    best = [0.0]
    take = []
    for i, (end, start, kind, weight) in enumerate(free):
        j = bisect.bisect_right(ends, start, 0, i)
        take.append((best[j] + weight > best[i], j))
        best.append(max(best[i], best[j] + weight))
    chosen, i = [], len(free)
    while i:
        use, j = take[i - 1]
        if use:
            end, start, kind, _ = free[i - 1]
            chosen.append((kind, start, end))
            i = j
        else:
            i -= 1
    return chosen


def found_in(model: dict | None, texts: list[str]) -> Iterator[tuple[list[Span], list[Span]]]:
    """Pattern spans and added spans of each text."""
    for group in groups(iter(texts), 4_000_000):
        base = [base_spans(t) for t in group]
        added = network_spans(model, group, base) if model else [[] for _ in group]
        yield from zip(base, added)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts and digest, all spans, and how many the network added."""
    texts = id_and_text(docs, id_col, text_col)
    model = fit(texts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for base, added in found_in(model, batch.column(1).to_pylist()):
                kinds = [k for k, _, _ in base]
                rows.append((*(kinds.count(k) for k in range(4)), sha256(listed(base).encode()),
                             listed(base + added), len(added)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *map(pa.array, zip(*rows))],
                    ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_network"])

    return texts.mapInArrow(run, f"doc_id {id_type(docs, id_col)}, n_email bigint, n_ip bigint, n_card bigint, "
                                 "n_phone bigint, base_sha256 string, spans string, n_network bigint")


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; other columns unchanged. Where
    spans overlap, the stretch they cover is replaced once, by the kind of its first span."""
    model = fit(id_and_text(docs, id_col, text_col))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            masked = [replaced(t, base + added) if t else t
                      for t, (base, added) in zip(texts, found_in(model, [t or "" for t in texts]))]
            yield batch.set_column(at, batch.schema.field(at), pa.array(masked, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def replaced(text: str, spans: list[Span]) -> str:
    out, end = [], 0
    for s, e, k in sorted((s, e, k) for k, s, e in spans):
        if s >= end:
            out += [text[end:s], f"<{KINDS[k]}>"]
        end = max(end, e)
    return "".join([*out, text[end:]])
