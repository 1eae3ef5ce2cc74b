"""A character-level bidirectional LSTM with CRF transitions in numpy: training and batched decoding.

Texts come as integer class matrices (windows, steps). Every step of the recurrences handles all
windows of a batch at once.
"""

from __future__ import annotations

import numpy as np

EMBED, HIDDEN = 12, 16
CLASSES = 136  # ASCII, then kinds of other characters


def char_classes(text: str) -> np.ndarray:
    """Class of each code point: itself if ASCII, else letter-like ranges by their block."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    coarse = 128 + np.minimum(np.digitize(points, (0x250, 0x370, 0x530, 0x2000, 0x3000, 0xFF00, 0x10000)), 7)
    return np.where(points < 128, points, coarse).astype(np.int32)


def new_model(tags: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def weights(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    model = {"embed": 0.3 * rng.standard_normal((CLASSES, EMBED)).astype(np.float32),
             "out": weights(2 * HIDDEN, tags), "out_b": np.zeros(tags, np.float32),
             "trans": np.zeros((tags, tags), np.float32)}
    for way in "fb":
        bias = np.zeros(4 * HIDDEN, np.float32)
        bias[HIDDEN:2 * HIDDEN] = 1.0  # the forget gate starts open
        model |= {f"x_{way}": weights(EMBED, 4 * HIDDEN), f"h_{way}": weights(HIDDEN, 4 * HIDDEN), f"b_{way}": bias}
    return model


def sigmoid(x):
    return 0.5 * (np.tanh(0.5 * x) + 1)


def lstm(x: np.ndarray, wh: np.ndarray, keep: bool):
    """x: inputs already times their weights, (steps, windows, 4 * HIDDEN). Hidden states, and what
    the backward pass needs if ``keep``."""
    steps, n, _ = x.shape
    h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    states, kept = np.empty((steps, n, HIDDEN), np.float32), []
    for t in range(steps):
        z = x[t] + h @ wh
        gates = sigmoid(z[:, :3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        before, h_before = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        states[t] = h
        if keep:
            kept.append((i, f, o, g, before, tc, h_before))
    return states, kept


def lstm_back(grad: np.ndarray, kept: list, wh: np.ndarray):
    """Gradients of the weighted inputs and of the recurrent weights, from those of the states."""
    steps, n, _ = grad.shape
    dx, dwh = np.empty((steps, n, 4 * HIDDEN), np.float32), np.zeros_like(wh)
    dh, dc = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        i, f, o, g, before, tc, h_before = kept[t]
        dh = dh + grad[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o),
                             dc * i * (1 - g * g)], 1)
        dx[t] = dz
        dwh += h_before.T @ dz
        dh, dc = dz @ wh.T, dc * f
    return dx, dwh


def emissions(model: dict, classes: np.ndarray, keep: bool = False):
    """Tag scores (steps, windows, tags)."""
    embedded = model["embed"][classes.T]
    forward, kept_f = lstm(embedded @ model["x_f"] + model["b_f"], model["h_f"], keep)
    backward, kept_b = lstm(embedded[::-1] @ model["x_b"] + model["b_b"], model["h_b"], keep)
    states = np.concatenate([forward, backward[::-1]], 2)
    return states @ model["out"] + model["out_b"], (embedded, states, kept_f, kept_b)


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def crf_gradients(scores: np.ndarray, trans: np.ndarray, tags: np.ndarray):
    """Loss per window and gradients of scores and transitions. tags: (steps, windows)."""
    steps, n, k = scores.shape
    ahead = np.empty_like(scores)
    ahead[0] = scores[0]
    for t in range(1, steps):
        ahead[t] = scores[t] + log_sum(ahead[t - 1][:, :, None] + trans, 1)
    total = log_sum(ahead[-1], 1)
    behind = np.zeros((n, k), np.float32)
    dscores, dtrans = np.empty_like(scores), np.zeros_like(trans)
    for t in range(steps - 1, -1, -1):
        dscores[t] = np.exp(ahead[t] + behind - total[:, None])
        if t:
            nxt = scores[t] + behind
            pair = np.exp(ahead[t - 1][:, :, None] + trans + nxt[:, None, :] - total[:, None, None])
            dtrans += pair.sum(0)
            behind = log_sum(trans + nxt[:, None, :], 2)
    rows = np.arange(n)
    gold = scores[0, rows, tags[0]].astype(np.float64)
    for t in range(steps):
        dscores[t, rows, tags[t]] -= 1
        if t:
            gold = gold + scores[t, rows, tags[t]] + trans[tags[t - 1], tags[t]]
            np.add.at(dtrans, (tags[t - 1], tags[t]), -1)
    return float((total - gold).mean()), dscores / n, dtrans / n


def train(windows: np.ndarray, tags: np.ndarray, n_tags: int, steps: int, batch: int = 64, rate: float = 0.02,
          seed: int = 7) -> dict[str, np.ndarray]:
    """Adam on random batches. windows, tags: (windows, steps)."""
    model, rng = new_model(n_tags, seed), np.random.default_rng(seed)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.items()}
    for step in range(1, steps + 1):
        at = rng.integers(0, len(windows), batch)
        classes = windows[at]
        scores, (embedded, states, kept_f, kept_b) = emissions(model, classes, True)
        _, dscores, dtrans = crf_gradients(scores, model["trans"], tags[at].T)
        flat = dscores.reshape(-1, n_tags)
        grads = {"trans": dtrans, "out": states.reshape(-1, 2 * HIDDEN).T @ flat, "out_b": flat.sum(0)}
        dstates = dscores @ model["out"].T
        dx_f, grads["h_f"] = lstm_back(dstates[:, :, :HIDDEN], kept_f, model["h_f"])
        dx_b, grads["h_b"] = lstm_back(dstates[::-1, :, HIDDEN:], kept_b, model["h_b"])
        inputs = embedded.reshape(-1, EMBED)
        grads["x_f"], grads["b_f"] = inputs.T @ dx_f.reshape(-1, 4 * HIDDEN), dx_f.sum((0, 1))
        grads["x_b"] = embedded[::-1].reshape(-1, EMBED).T @ dx_b.reshape(-1, 4 * HIDDEN)
        grads["b_b"] = dx_b.sum((0, 1))
        grads["embed"] = np.zeros_like(model["embed"])
        np.add.at(grads["embed"], classes.T, dx_f @ model["x_f"].T + (dx_b @ model["x_b"].T)[::-1])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        pace = rate * min(1.0, step / 20) * (1 - 0.9 * step / steps)
        for name, g in grads.items():
            g = g * min(1.0, 5.0 / max(norm, 1e-9))
            m, v = moment[name]
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            model[name] -= (pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return model


def decode(model: dict, windows: np.ndarray, batch: int = 512):
    """Best tag paths (windows, steps) by Viterbi, and each position's margin of its tag over tag 0."""
    paths, margins = [], []
    for at in range(0, len(windows), batch):
        scores, _ = emissions(model, windows[at:at + batch])
        steps, n, _ = scores.shape
        best, back = scores[0], np.empty(scores.shape, np.int8)
        for t in range(1, steps):
            options = best[:, :, None] + model["trans"]
            back[t] = options.argmax(1)
            best = options.max(1) + scores[t]
        path = np.empty((steps, n), np.int8)
        path[-1] = best.argmax(1)
        rows = np.arange(n)
        for t in range(steps - 1, 0, -1):
            path[t - 1] = back[t, rows, path[t]]
        paths.append(path.T)
        chosen = np.take_along_axis(scores, path[:, :, None].astype(np.int64), 2)[:, :, 0]
        margins.append((chosen - scores[:, :, 0]).T)
    return np.concatenate(paths), np.concatenate(margins)
