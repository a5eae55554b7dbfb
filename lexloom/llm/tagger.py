"""A character-level bidirectional LSTM with a CRF on top, in numpy.

``Tagger`` holds the weights; ``loss_and_gradients`` trains them; ``tag`` labels
texts of any length: overlapping windows are run through the network, their
emissions are blended where they overlap, and one Viterbi pass per text over the
CRF's transitions reconciles the whole.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

KINDS = ("email", "phone", "id_number", "address", "person")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
WINDOW, STRIDE = 96, 64
BATCH = 512

_LOWER = "abcdefghijklmnopqrstuvwxyz"
_SIGNS = " \n.,;:!?'\"()[]<>@+-_/&#%*=|~"
_ARABIC = "ءآأؤإئابةتثجحخدذرزسشصضطظعغفقكلمنهوىي"
_SYMBOLS = ["pad", "digit", "arabic digit", "mark", "space", "control", "latin sign", "letter", "symbol", "º"]
_CLASSES = [*_SYMBOLS, *_SIGNS, *_LOWER, *_LOWER.upper(), *(f"´{c}" for c in _LOWER), *(f"´{c}" for c in _LOWER.upper()), *_ARABIC]
_INDEX = {c: i for i, c in enumerate(_CLASSES)}
N_CLASSES = len(_CLASSES)


@lru_cache(maxsize=1 << 16)
def char_class(c: str) -> int:
    if c in _INDEX and len(c) == 1:
        return _INDEX[c]
    kind = unicodedata.category(c)
    if kind == "Nd":
        return _INDEX["digit" if c.isascii() else "arabic digit"]
    if kind[0] == "M":
        return _INDEX["mark"]
    if kind[0] == "Z":
        return _INDEX["space"]
    if kind[0] == "C":
        return _INDEX["control"]
    base = unicodedata.normalize("NFD", c)[0]
    if base != c and f"´{base}" in _INDEX:
        return _INDEX[f"´{base}"]
    if c < "ɏ":
        return _INDEX["letter" if kind[0] == "L" else "latin sign"]
    return _INDEX["letter" if kind[0] == "L" else "symbol"]


def encode(text: str) -> np.ndarray:
    return np.fromiter(map(char_class, text), np.int16, len(text))


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _lse(x, axis):
    m = x.max(axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(x - m).sum(axis))


class Tagger:
    def __init__(self, hidden: int = 40, embed: int = 20, seed: int = 0, weights: dict | None = None):
        if weights is not None:
            self.w = {k: np.asarray(v, np.float32) for k, v in weights.items()}
            return
        rng = np.random.default_rng(seed)
        k = len(LABELS)

        def init(*shape):
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.w = {"emb": rng.standard_normal((N_CLASSES, embed)).astype(np.float32) * 0.3}
        for d in "fb":
            self.w |= {f"{d}x": init(embed, 4 * hidden), f"{d}h": init(hidden, 4 * hidden), f"{d}b": np.zeros(4 * hidden, np.float32)}
            self.w[f"{d}b"][hidden : 2 * hidden] = 1
        self.w |= {"out": init(2 * hidden, k), "ob": np.zeros(k, np.float32), "trans": np.zeros((k, k), np.float32), "start": np.zeros(k, np.float32), "end": np.zeros(k, np.float32)}

    @property
    def hidden(self) -> int:
        return self.w["fh"].shape[0]

    # -- network ---------------------------------------------------------

    def _run(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        """x: (T, B) classes. h: (T, B, H). Masked steps keep the state at zero."""
        steps, n = x.shape
        hid = self.hidden
        table, wh = self.w["emb"] @ self.w[f"{d}x"] + self.w[f"{d}b"], self.w[f"{d}h"]
        h, c = np.zeros((n, hid), np.float32), np.zeros((n, hid), np.float32)
        out = np.zeros((steps, n, hid), np.float32)
        saved = []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g = table[x[t]] + h @ wh
            ifo = _sigmoid(g[:, : 3 * hid])
            i, f, o = ifo[:, :hid], ifo[:, hid : 2 * hid], ifo[:, 2 * hid :]
            z = np.tanh(g[:, 3 * hid :])
            m = mask[t][:, None]
            c_new = (f * c + i * z) * m
            tc = np.tanh(c_new)
            h_new = o * tc * m
            if keep:
                saved.append((t, i, f, o, z, c, tc, h, m))
            h, c = h_new, c_new
            out[t] = h
        return out, saved

    def _states(self, x: np.ndarray, alive: np.ndarray, d: str) -> np.ndarray:
        """h: (T, B, H) as ``_run`` gives, for columns sorted by length, longest first; ``alive`` columns at each step are worked on, in place."""
        hid = self.hidden
        scale = np.ones(4 * hid, np.float32)
        scale[: 3 * hid] = 0.5  # a sigmoid is a tanh of half its argument, so one call does for all gates
        table, wh = (self.w["emb"] @ self.w[f"{d}x"] + self.w[f"{d}b"]) * scale, self.w[f"{d}h"] * scale
        steps, n = x.shape
        h, c, out = np.zeros((n, hid), np.float32), np.zeros((n, hid), np.float32), np.zeros((steps, n, hid), np.float32)
        gates, squashed = np.empty((n, 4 * hid), np.float32), np.empty((n, hid), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            k = alive[t]
            g, ck, s = gates[:k], c[:k], squashed[:k]
            np.matmul(h[:k], wh, out=g)
            g += table[x[t, :k]]
            np.tanh(g, out=g)
            ifo, z = g[:, : 3 * hid], g[:, 3 * hid :]
            ifo *= 0.5
            ifo += 0.5
            z *= g[:, :hid]
            ck *= g[:, hid : 2 * hid]
            ck += z
            np.tanh(ck, out=s)
            np.multiply(s, g[:, 2 * hid : 3 * hid], out=h[:k])
            out[t, :k] = h[:k]
        return out

    def emissions(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """(T, B, K) for padded classes (T, B), columns sorted by length, longest first."""
        alive = (lengths[None, :] > np.arange(len(x))[:, None]).sum(1)
        hid = self.hidden
        return self._states(x, alive, "f") @ self.w["out"][:hid] + self._states(x, alive, "b") @ self.w["out"][hid:] + self.w["ob"]

    def _run_back(self, x, dh_all, saved, d, grads):
        hid = self.hidden
        wh = self.w[f"{d}h"]
        n = x.shape[1]
        dh, dc = np.zeros((n, hid), np.float32), np.zeros((n, hid), np.float32)
        dtable = np.zeros((N_CLASSES, 4 * hid), np.float32)
        for t, i, f, o, z, c_old, tc, h_old, m in reversed(saved):
            dh = (dh + dh_all[t]) * m
            dc = (dc + dh * o * (1 - tc * tc)) * m
            g = np.concatenate((dc * z * i * (1 - i), dc * c_old * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - z * z)), 1)
            np.add.at(dtable, x[t], g)
            grads[f"{d}h"] += h_old.T @ g
            dh, dc = g @ wh.T, dc * f
        grads[f"{d}x"] += self.w["emb"].T @ dtable
        grads[f"{d}b"] += dtable.sum(0)
        grads["emb"] += dtable @ self.w[f"{d}x"].T

    def loss_and_gradients(self, x: np.ndarray, y: np.ndarray, mask: np.ndarray):
        """Mean negative log likelihood a text of (T, B) padded texts, and its gradients."""
        steps, n = x.shape
        hid, k = self.hidden, len(LABELS)
        hf, sf = self._run(x, mask, "f", True)
        hb, sb = self._run(x, mask, "b", True)
        e = hf @ self.w["out"][:hid] + hb @ self.w["out"][hid:] + self.w["ob"]
        trans, start, end = self.w["trans"], self.w["start"], self.w["end"]
        on = mask.astype(bool)
        last = mask.sum(0).astype(int) - 1
        rows = np.arange(n)
        alpha, beta = np.zeros((steps, n, k)), np.zeros((steps, n, k))
        alpha[0] = start + e[0]
        for t in range(1, steps):
            alpha[t] = np.where(on[t][:, None], _lse(alpha[t - 1][:, :, None] + trans, 1) + e[t], alpha[t - 1])
        total = _lse(alpha[-1] + end, 1)
        beta[-1] = end
        for t in range(steps - 2, -1, -1):
            beta[t] = np.where(on[t + 1][:, None], _lse(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2), end)
        gold = start[y[0]] + end[y[last, rows]] + (e[np.arange(steps)[:, None], rows, y] * mask).sum(0) + (trans[y[:-1], y[1:]] * mask[1:]).sum(0)
        p = np.exp(alpha + beta - total[None, :, None]) * mask[:, :, None]
        de = p.copy()
        np.add.at(de, (np.arange(steps)[:, None], rows[None, :], y), -mask)
        grads = {name: np.zeros_like(v) for name, v in self.w.items()}
        for t in range(1, steps):
            pair = np.exp(alpha[t - 1][:, :, None] + trans + (e[t] + beta[t])[:, None, :] - total[:, None, None]) * mask[t][:, None, None]
            grads["trans"] += pair.sum(0).astype(np.float32)
        np.add.at(grads["trans"], (y[:-1], y[1:]), -mask[1:])
        grads["start"] += p[0].sum(0).astype(np.float32)
        np.add.at(grads["start"], y[0], -1)
        grads["end"] += p[last, rows].sum(0).astype(np.float32)
        np.add.at(grads["end"], y[last, rows], -1)
        de = de.astype(np.float32)
        grads["out"][:hid] += np.einsum("tbh,tbk->hk", hf, de)
        grads["out"][hid:] += np.einsum("tbh,tbk->hk", hb, de)
        grads["ob"] += de.sum((0, 1))
        self._run_back(x, de @ self.w["out"][:hid].T, sf, "f", grads)
        self._run_back(x, de @ self.w["out"][hid:].T, sb, "b", grads)
        return float((total - gold).sum() / n), {name: g / n for name, g in grads.items()}

    # -- decoding --------------------------------------------------------

    def _viterbi(self, e: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        steps, n, k = e.shape
        trans = self.w["trans"].T[None]
        score = self.w["start"] + e[0]
        back = np.zeros((steps, n, k), np.int8)
        for t in range(1, steps):
            ways = score[:, None, :] + trans
            best = ways.argmax(2)
            on = (t < lengths)[:, None]
            back[t] = np.where(on, best, np.arange(k))
            score = np.where(on, np.take_along_axis(ways, best[:, :, None], 2)[:, :, 0] + e[t], score)
        at = (score + self.w["end"]).argmax(1)
        out = np.zeros((steps, n), np.int8)
        rows = np.arange(n)
        for t in range(steps - 1, -1, -1):
            out[t] = at
            at = back[t, rows, at]
        return out

    def label(self, codes: list[np.ndarray]) -> list[np.ndarray]:
        """The label of every character of every encoded text."""
        spans = []
        for n, c in enumerate(codes):
            lo = 0
            while True:
                spans.append((n, lo, min(len(c), lo + WINDOW)))
                if lo + WINDOW >= len(c):
                    break
                lo += STRIDE
        merged = [np.zeros((len(c), len(LABELS)), np.float32) for c in codes]
        weight = [np.zeros((len(c), 1), np.float32) for c in codes]
        ramp = np.minimum(np.arange(1, WINDOW + 1), WINDOW - STRIDE).astype(np.float32)
        spans.sort(key=lambda s: s[1] - s[2])
        for b in range(0, len(spans), BATCH):
            part = spans[b : b + BATCH]
            sizes = np.array([hi - lo for _, lo, hi in part])
            x = np.zeros((sizes[0], len(part)), np.int16)
            for j, (n, lo, hi) in enumerate(part):
                x[: hi - lo, j] = codes[n][lo:hi]
            e = self.emissions(x, sizes)
            for j, (n, lo, hi) in enumerate(part):
                size = hi - lo
                w = np.ones(size, np.float32) * ramp[-1]
                if lo:
                    w = np.minimum(w, ramp[:size])
                if hi < len(codes[n]):
                    w = np.minimum(w, ramp[:size][::-1])
                merged[n][lo:hi] += e[:size, j] * w[:, None]
                weight[n][lo:hi] += w[:, None]
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(codes)
        order = sorted((n for n in range(len(codes)) if len(codes[n])), key=lambda n: len(codes[n]))
        at = 0
        while at < len(order):
            part = order[at : at + BATCH]
            while len(part) > 1 and len(part) * len(codes[part[-1]]) > 1 << 17:
                part = part[: len(part) // 2]
            at += len(part)
            lengths = np.array([len(codes[n]) for n in part])
            e = np.zeros((lengths.max(), len(part), len(LABELS)), np.float32)
            for j, n in enumerate(part):
                e[: lengths[j], j] = merged[n] / weight[n]
            path = self._viterbi(e, lengths)
            for j, n in enumerate(part):
                out[n] = path[: lengths[j], j]
        return out

    def tag(self, texts: list[str]) -> list[list[tuple[str, int, int]]]:
        """(kind, start, end) of every span of every text. Texts of the same character classes, as those that differ in digits only, are labelled once."""
        out = []
        seen: dict[bytes, int] = {}
        codes, which = [], []
        for code in map(encode, texts):
            which.append(seen.setdefault(code.tobytes(), len(seen)))
            if which[-1] == len(codes):
                codes.append(code)
        paths = self.label(codes)
        for path in map(paths.__getitem__, which):
            spans: list[tuple[str, int, int]] = []
            hits = np.flatnonzero(path)
            i = 0
            while i < len(hits):
                lo, kind = int(hits[i]), (path[hits[i]] - 1) // 2
                hi = lo + 1
                i += 1
                while i < len(hits) and hits[i] == hi and path[hi] == 2 * kind + 2:
                    hi += 1
                    i += 1
                spans.append((KINDS[kind], lo, hi))
            out.append(spans)
        return out
