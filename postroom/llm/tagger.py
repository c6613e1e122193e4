"""A small character tagger in numpy: bidirectional LSTM with CRF transitions."""

from __future__ import annotations

import numpy as np

N_CHARS = 101  # 0 is padding; 1 to 95 printable ASCII; then classes of others
HIDDEN = 16

Params = dict[str, np.ndarray]


def encode(text: str) -> np.ndarray:
    """A small number for each code point."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    out = np.where((codes >= 32) & (codes < 127), codes - 31, 96)
    out[(codes >= 9) & (codes <= 13)] = 97
    out[(codes >= 0xC0) & (codes < 0x250)] = 98
    out[codes >= 0x250] = 99
    out[codes == 0xA0] = 100
    return out


def start_params(n_labels: int, hidden: int = HIDDEN, seed: int = 5) -> Params:
    draw = np.random.default_rng(seed)
    p: Params = {}
    for side in "fb":
        p[f"x{side}"] = draw.normal(0, 0.3, (N_CHARS, 4 * hidden))
        p[f"h{side}"] = draw.normal(0, 0.3 / np.sqrt(hidden), (hidden, 4 * hidden))
        bias = np.zeros(4 * hidden)
        bias[hidden : 2 * hidden] = 1.0  # remember at first
        p[f"b{side}"] = bias
        p[f"u{side}"] = draw.normal(0, 0.3, (hidden, n_labels))
    p["d"], p["trans"] = np.zeros(n_labels), np.zeros((n_labels, n_labels))
    return p


def _sigmoid(a: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * a) + 0.5


def _walk(p: Params, side: str, chars: np.ndarray, keep: bool):
    """Hidden states of one direction, (T, N, H), and what its gradient needs."""
    steps, n = chars.shape
    wh, wx, bias = p[f"h{side}"], p[f"x{side}"], p[f"b{side}"]
    size = wh.shape[0]
    h = np.zeros((n, size), wh.dtype)
    c = np.zeros_like(h)
    states, cache = np.zeros((steps, n, size), wh.dtype), []
    order = range(steps) if side == "f" else range(steps - 1, -1, -1)
    for t in order:
        a = wx[chars[t]] + h @ wh + bias
        gates = _sigmoid(a[:, : 3 * size])
        i, f, o = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
        g = np.tanh(a[:, 3 * size :])
        c_new = f * c + i * g
        th = np.tanh(c_new)
        if keep:
            cache.append((t, h, c, i, f, o, g, th))
        h, c = o * th, c_new
        states[t] = h
    return states, cache


def emissions(p: Params, chars: np.ndarray) -> np.ndarray:
    """Scores of labels, (T, N, K), of windows of characters, (T, N)."""
    return sum(_walk(p, s, chars, False)[0] @ p[f"u{s}"] for s in "fb") + p["d"]


def decode(p: Params, chars: np.ndarray) -> np.ndarray:
    """Best label sequences, (T, N), by Viterbi."""
    e, trans = emissions(p, chars), p["trans"]
    steps, n, k = e.shape
    back = np.zeros((steps, n, k), np.int8)
    score = e[0]
    for t in range(1, steps):
        via = score[:, :, None] + trans
        back[t] = via.argmax(1)
        score = np.take_along_axis(via, back[t][:, None, :].astype(np.int64), 1)[:, 0] + e[t]
    out = np.zeros((steps, n), np.int64)
    out[-1] = score.argmax(1)
    for t in range(steps - 1, 0, -1):
        out[t - 1] = back[t][np.arange(n), out[t]]
    return out


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis)) + top.squeeze(axis)


def loss_and_gradient(p: Params, chars: np.ndarray, labels: np.ndarray) -> tuple[float, Params]:
    """Mean negative log likelihood of the label sequences, and its gradient."""
    steps, n = chars.shape
    walks = {s: _walk(p, s, chars, True) for s in "fb"}
    e = sum(walks[s][0] @ p[f"u{s}"] for s in "fb") + p["d"]
    trans, k = p["trans"], e.shape[2]
    ahead, behind = np.zeros_like(e), np.zeros_like(e)
    ahead[0] = e[0]
    for t in range(1, steps):
        ahead[t] = _log_sum(ahead[t - 1][:, :, None] + trans, 1) + e[t]
    for t in range(steps - 2, -1, -1):
        behind[t] = _log_sum(trans + (e[t + 1] + behind[t + 1])[:, None, :], 2)
    whole = _log_sum(ahead[-1], 1)
    at, rows = np.arange(steps)[:, None], np.arange(n)[None, :]
    gold = e[at, rows, labels].sum(0) + trans[labels[:-1], labels[1:]].sum(0)
    de = np.exp(ahead + behind - whole[:, None])
    de[at, rows, labels] -= 1
    d_trans = np.zeros_like(trans)
    for t in range(1, steps):
        both = ahead[t - 1][:, :, None] + trans + (e[t] + behind[t] - whole[:, None])[:, None, :]
        d_trans += np.exp(both).sum(0)
    np.add.at(d_trans, (labels[:-1], labels[1:]), -1)
    de /= n
    grad: Params = {"d": de.sum((0, 1)), "trans": d_trans / n}
    for s in "fb":
        states, cache = walks[s]
        size = states.shape[2]
        grad[f"u{s}"] = states.reshape(-1, size).T @ de.reshape(-1, k)
        d_state = de @ p[f"u{s}"].T
        dx, dh_w = np.zeros_like(p[f"x{s}"]), np.zeros_like(p[f"h{s}"])
        db, dh, dc = np.zeros_like(p[f"b{s}"]), np.zeros((n, size)), np.zeros((n, size))
        for t, h, c, i, f, o, g, th in reversed(cache):
            dh = dh + d_state[t]
            dc = dc + dh * o * (1 - th * th)
            da = np.concatenate(
                [
                    dc * g * i * (1 - i),
                    dc * c * f * (1 - f),
                    dh * th * o * (1 - o),
                    dc * i * (1 - g * g),
                ],
                axis=1,
            )
            np.add.at(dx, chars[t], da)
            dh_w += h.T @ da
            db += da.sum(0)
            dh, dc = da @ p[f"h{s}"].T, dc * f
        grad |= {f"x{s}": dx, f"h{s}": dh_w, f"b{s}": db}
    return float((whole - gold).mean()), grad


def train(
    chars: np.ndarray, labels: np.ndarray, n_labels: int, epochs: int, batch: int = 64, rate: float = 0.02
) -> Params:
    """Fit by Adam on windows (T, N); the order of windows is shuffled by a fixed seed."""
    p, draw = start_params(n_labels), np.random.default_rng(9)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    step, n = 0, chars.shape[1]
    for epoch in range(epochs):
        order = draw.permutation(n)
        for a in range(0, n, batch):
            some = order[a : a + batch]
            _, grad = loss_and_gradient(p, chars[:, some], labels[:, some])
            size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            scale, step = min(1.0, 5.0 / max(size, 1e-9)), step + 1
            lr = rate * 0.5 ** (2 * epoch / max(1, epochs - 1))
            for k, g in grad.items():
                g = g * scale
                m[k] = 0.9 * m[k] + 0.1 * g
                v2[k] = 0.999 * v2[k] + 0.001 * g * g
                p[k] -= lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)
    return p
