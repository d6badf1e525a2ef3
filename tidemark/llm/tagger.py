"""A character tagger: bidirectional LSTM with CRF transitions, trained and run in numpy."""

from __future__ import annotations

import numpy as np

#: Size of the state in each direction.
STATE = 16
#: Characters: 1 to 95 printable ASCII, then other letters, white space and the rest; 0 pads.
CLASSES = 99
_ILLEGAL = -1e4


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    out = np.where((points >= 32) & (points < 127), points - 31, 98).astype(np.int64)
    for i in np.flatnonzero(out == 98).tolist():
        c = chr(points[i])
        out[i] = 96 if c.isalpha() else 97 if c.isspace() else 98
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis, keepdims=True)) + top).squeeze(axis)


class Tagger:
    """Tags: 0 outside; 2k + 1 begins and 2k + 2 continues a span of kind k."""

    def __init__(self, kinds: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.kinds, k, s = kinds, 2 * kinds + 1, STATE
        self.w = {"out": rng.normal(0, 0.1, (2 * s, k)), "bias": np.zeros(k), "next": np.zeros((k, k))}
        for d in "fb":
            table = rng.normal(0, 0.3, (CLASSES, 4 * s))
            table[:, s:2 * s] += 1.0  # remember at first
            self.w["in" + d], self.w["rec" + d] = table, rng.normal(0, 1 / np.sqrt(s), (s, 4 * s))
        legal = np.ones((k, k), bool)
        for j in range(kinds):
            legal[:, 2 * j + 2] = False
            legal[[2 * j + 1, 2 * j + 2], 2 * j + 2] = True
        self.barred = np.where(legal, 0.0, _ILLEGAL)

    # --- recurrent layer -----------------------------------------------------------------

    def _run(self, ids: np.ndarray, d: str):
        s, (n, steps) = STATE, ids.shape
        table, rec = self.w["in" + d], self.w["rec" + d]
        h, c = np.zeros((n, s)), np.zeros((n, s))
        out, kept = np.zeros((n, steps, s)), []
        for t in range(steps):
            z = table[ids[:, t]] + h @ rec
            gate, new = _sigmoid(z[:, :3 * s]), np.tanh(z[:, 3 * s:])
            kept.append((h, c, gate, new))
            c = gate[:, s:2 * s] * c + gate[:, :s] * new
            h = gate[:, 2 * s:] * np.tanh(c)
            out[:, t] = h
        return out, kept

    def _back(self, ids: np.ndarray, d: str, kept: list, dout: np.ndarray, grad: dict) -> None:
        s, (n, steps) = STATE, ids.shape
        rec = self.w["rec" + d]
        dh, dc = np.zeros((n, s)), np.zeros((n, s))
        for t in range(steps - 1, -1, -1):
            h, c, gate, new = kept[t]
            i, f, o = gate[:, :s], gate[:, s:2 * s], gate[:, 2 * s:]
            cell = np.tanh(f * c + i * new)
            dh = dh + dout[:, t]
            dc = dc + dh * o * (1 - cell**2)
            dz = np.concatenate([dc * new * i * (1 - i), dc * c * f * (1 - f), dh * cell * o * (1 - o), dc * i * (1 - new**2)], axis=1)
            np.add.at(grad["in" + d], ids[:, t], dz)
            grad["rec" + d] += h.T @ dz
            dh, dc = dz @ rec.T, dc * f

    def _states(self, ids: np.ndarray):
        f, kf = self._run(ids, "f")
        b, kb = self._run(ids[:, ::-1], "b")
        return np.concatenate([f, b[:, ::-1]], axis=2), kf, kb

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        return self._states(ids)[0] @ self.w["out"] + self.w["bias"]

    # --- transitions ---------------------------------------------------------------------

    def _loss(self, e: np.ndarray, tags: np.ndarray):
        """Mean negative log likelihood, and its derivatives by emissions and transitions."""
        n, steps, k = e.shape
        move = self.w["next"] + self.barred
        ahead, behind = np.zeros_like(e), np.zeros_like(e)
        ahead[:, 0] = e[:, 0]
        for t in range(1, steps):
            ahead[:, t] = _lse(ahead[:, t - 1, :, None] + move, 1) + e[:, t]
        for t in range(steps - 2, -1, -1):
            behind[:, t] = _lse(move + (e[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
        total = _lse(ahead[:, -1], 1)
        rows, places = np.arange(n)[:, None], np.arange(steps)
        score = e[rows, places, tags].sum(1) + move[tags[:, :-1], tags[:, 1:]].sum(1)
        de = np.exp(ahead + behind - total[:, None, None])
        de[rows, places, tags] -= 1
        dmove = np.zeros((k, k))
        for t in range(1, steps):
            dmove += np.exp(ahead[:, t - 1, :, None] + move + (e[:, t] + behind[:, t])[:, None, :] - total[:, None, None]).sum(0)
        np.add.at(dmove, (tags[:, :-1], tags[:, 1:]), -1)
        return (total - score).mean(), de / n, dmove / n

    def train(self, ids: np.ndarray, tags: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.02, seed: int = 5) -> list[float]:
        """Adam over equally long windows; the mean loss of each epoch."""
        rng, step, said = np.random.default_rng(seed), 0, []
        first = {n: np.zeros_like(w) for n, w in self.w.items()}
        second = {n: np.zeros_like(w) for n, w in self.w.items()}
        for epoch in range(epochs):
            losses = []
            for at in np.array_split(rng.permutation(len(ids)), max(1, len(ids) // batch)):
                x, y = ids[at], tags[at]
                states, kf, kb = self._states(x)
                loss, de, dmove = self._loss(states @ self.w["out"] + self.w["bias"], y)
                grad = {n: np.zeros_like(w) for n, w in self.w.items()}
                grad["next"], grad["bias"] = dmove, de.sum((0, 1))
                grad["out"] = np.einsum("nts,ntk->sk", states, de)
                ds = de @ self.w["out"].T
                self._back(x, "f", kf, ds[:, :, :STATE], grad)
                self._back(x[:, ::-1], "b", kb, ds[:, ::-1, STATE:], grad)
                size = np.sqrt(sum((g**2).sum() for g in grad.values()))
                step += 1
                for n, g in grad.items():
                    g = g * min(1.0, 5.0 / (size + 1e-9))
                    first[n] = 0.9 * first[n] + 0.1 * g
                    second[n] = 0.999 * second[n] + 0.001 * g**2
                    self.w[n] = self.w[n] - rate * 0.7**epoch * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                losses.append(loss)
            said.append(float(np.mean(losses)))
        return said

    def decode(self, e: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """Best legal tags of rows of emissions, ``lengths`` places each; a row begins outside or with a span's first."""
        n, steps, k = e.shape
        move = self.w["next"] + self.barred
        best = e[:, 0].copy()
        best[:, 2::2] += _ILLEGAL
        back = np.zeros((n, steps, k), np.int8)
        for t in range(1, steps):
            scores = best[:, :, None] + move
            back[:, t] = scores.argmax(1)
            on = (t < lengths)[:, None]
            best = np.where(on, scores.max(1) + e[:, t], best)
        out = []
        last = best.argmax(1)
        for i in range(n):
            m = int(lengths[i])
            tags = np.zeros(m, np.int64)
            tag = last[i]
            for t in range(m - 1, -1, -1):
                tags[t] = tag
                tag = back[i, t, tag]
            out.append(tags)
        return out
