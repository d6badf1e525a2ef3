"""A bidirectional gated recurrent network with attention pooling, in numpy.

A token's input is a word vector (a hashed table; words seen in few training
texts count as unknown) beside the sum of its character n-grams' vectors.  Two
gated recurrent layers read a window from both ends; attention weighs their
states into one vector, and a linear layer gives the window's logit.  A text's
logit is the largest of its windows'.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np

from tidemark.llm.common import MULT, mix, prefix_hash, ranges, span_hash

#: Tokens in a window and between the starts of two; windows overlap by the difference.
WINDOW, STEP = 48, 36
#: Hashed rows of the word and the character table, and bytes in an n-gram (word ends count as bytes).
WORD_ROWS, CHAR_ROWS, GRAM = 1 << 14, 1 << 13, 4
#: Sizes: word vector, character vector, states of one direction, attention.
WORD, CHAR, HIDDEN, ATTEND = 8, 12, 8, 8
#: Training texts that must hold a word for it to have a vector of its own.
SEEN = 3

_LETTER = np.zeros(256, bool)
_LETTER[0x80:] = True
for _a, _b in (("0", "9"), ("A", "Z"), ("a", "z")):
    _LETTER[ord(_a):ord(_b) + 1] = True


@dataclass
class Tokens:
    """Tokens of a block: ``kind`` names one of the distinct words, ``count`` is by document."""

    kind: np.ndarray
    count: np.ndarray
    word: np.ndarray  # table row of every distinct word
    gram: np.ndarray  # table rows of all n-grams of the distinct words, one word after another
    grams: np.ndarray  # n-grams by distinct word
    start: np.ndarray  # first byte of every token

    def first(self, n: int) -> Tokens:
        """The first ``n`` tokens of a block of one document."""
        return Tokens(self.kind[:n], np.array([n]), self.word, self.gram, self.grams, self.start[:n])


def inside(data: np.ndarray) -> np.ndarray:
    """Bytes that belong to a token."""
    return _LETTER[data]


def tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    """Letters and digits make a token; A-Z and their accented Latin forms are lower-cased."""
    low = data.copy()
    capital = (data >= 65) & (data <= 90)
    if len(data) > 1:
        capital[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    low[capital] += 32
    letter = inside(low)
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    has = np.diff(offsets) > 0
    first[offsets[:-1][has]] |= letter[offsets[:-1][has]]
    last[offsets[1:][has] - 1] |= letter[offsets[1:][has] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    count = np.diff(np.searchsorted(start, offsets))
    name = span_hash(prefix_hash(low), start, end) if len(start) else np.zeros(0, np.uint64)
    names, at, kind = np.unique(name, return_index=True, return_inverse=True)
    length = end[at] - start[at]
    # the distinct words, each between two end marks; n-grams that lie in one word
    padded = np.zeros(int((length + 2).sum()), np.uint8)
    begin = np.cumsum(length + 2) - (length + 2)
    padded[ranges(begin + 1, length)] = low[ranges(start[at], length)]
    grams = np.maximum(length + 3 - GRAM, 0)
    place = ranges(begin, grams)
    code = np.zeros(len(place), np.uint64)
    for k in range(GRAM):
        code = code * np.uint64(256) + padded[place + k]
    gram = (mix(code * np.uint64(MULT) + np.uint64(1)) % np.uint64(CHAR_ROWS)).astype(np.int64)
    return Tokens(kind, count, (mix(names) % np.uint64(WORD_ROWS)).astype(np.int64), gram, grams, start)


def windows(count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(document, first token, tokens)`` of all windows; a document without tokens has one without tokens."""
    number = np.maximum(1, -(-(count - WINDOW) // STEP) + 1)
    doc = np.repeat(np.arange(len(count)), number)
    within = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    first = np.repeat(np.cumsum(count) - count, number) + within * STEP
    return doc, first, np.minimum(WINDOW, np.repeat(count, number) - within * STEP)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers of ``rows`` and the sums of their values."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1]))) if len(rows) else np.zeros(0, np.int64)
    return rows[first], np.add.reduceat(values[order], first, axis=0) if len(rows) else values


def new_model(seed: int = 11) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    wide = WORD + CHAR
    draw = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    zeros = lambda *s: np.zeros(s, np.float32)
    model = {"word": zeros(WORD_ROWS, WORD), "char": zeros(CHAR_ROWS, CHAR), "known": zeros(WORD_ROWS, 1),
             "A": draw(2 * HIDDEN, ATTEND), "a": zeros(ATTEND), "v": draw(ATTEND, 1), "w": draw(2 * HIDDEN, 1), "b": zeros(1)}
    for d in "fb":
        model |= {f"W{d}": draw(wide, 3 * HIDDEN), f"c{d}": zeros(3 * HIDDEN), f"U{d}": draw(HIDDEN, 3 * HIDDEN)}
    return model


def _inputs(m: dict, t: Tokens) -> np.ndarray:
    """Input vectors of the distinct words."""
    x = np.zeros((len(t.word), WORD + CHAR), np.float32)
    x[:, :WORD] = m["word"][t.word] * m["known"][t.word]
    owner = np.flatnonzero(t.grams)
    if len(owner):
        first = (np.cumsum(t.grams) - t.grams)[owner]
        step = 1 << 14
        for k in range(0, len(owner), step):  # bounded pieces of the gathered rows
            part = owner[k:k + step]
            a = int(first[k])
            z = int(first[k + step]) if k + step < len(first) else len(t.gram)
            x[part, WORD:] = np.add.reduceat(m["char"][t.gram[a:z]], first[k:k + step] - a, axis=0)
        x[owner, WORD:] /= np.sqrt(t.grams[owner])[:, None]
    return x


def _run(m: dict, p: np.ndarray, d: str, index: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States of one direction for every place of a batch of windows."""
    n, wide = index.shape
    h = np.zeros((n, HIDDEN), np.float32)
    out = np.zeros((wide, n, HIDDEN), np.float32)
    u = m[f"U{d}"]
    for t in range(wide) if d == "f" else range(wide - 1, -1, -1):
        x, g = p[index[:, t]], h @ u
        zr = _sigmoid(x[:, :2 * HIDDEN] + g[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n_ = np.tanh(x[:, 2 * HIDDEN:] + r * g[:, 2 * HIDDEN:])
        new = n_ + z * (h - n_)
        k = mask[:, t, None]
        if keep is not None:
            keep.append((t, h, g, z, r, n_))
        h = h + k * (new - h)
        out[t] = h
    return out


def _pool(m: dict, s: np.ndarray, mask: np.ndarray):
    """Attention over the places: ``(logit, weights, hidden, context)``."""
    u = np.tanh(s @ m["A"] + m["a"])
    e = np.where(mask, (u @ m["v"])[..., 0], -1e9)
    a = np.exp(e - e.max(1, keepdims=True)) * mask
    a = a / np.maximum(a.sum(1, keepdims=True), 1e-9)
    c = np.einsum("nt,nth->nh", a, s)
    return (c @ m["w"])[:, 0] + m["b"][0], a, u, c


def _batch(first: np.ndarray, size: np.ndarray, kind: np.ndarray, blank: int):
    wide = max(1, int(size.max()))
    place = first[:, None] + np.arange(wide)
    mask = np.arange(wide) < size[:, None]
    index = np.full(place.shape, blank, np.int64)
    index[mask] = kind[place[mask]]
    return index, mask


def logits(m: dict, t: Tokens, chunk: int = 2048) -> np.ndarray:
    """The logit of every window of a block."""
    x = _inputs(m, t)
    blank = np.zeros((1, x.shape[1]), np.float32)
    p = {d: np.concatenate([x, blank]) @ m[f"W{d}"] + m[f"c{d}"] for d in "fb"}
    _, first, size = windows(t.count)
    out = np.zeros(len(first), np.float32)
    order = np.argsort(-size, kind="stable")  # windows of like length side by side
    for k in range(0, len(order), chunk):
        at = order[k:k + chunk]
        index, mask = _batch(first[at], size[at], t.kind, len(x))
        s = np.concatenate([_run(m, p[d], d, index, mask.astype(np.float32)) for d in "fb"], axis=2).transpose(1, 0, 2)
        out[at] = _pool(m, s, mask)[0]
    return out


def scores(m: dict, t: Tokens) -> np.ndarray:
    """The score of every document: its largest window's."""
    doc, _, _ = windows(t.count)
    best = np.full(len(t.count), -np.inf)
    np.maximum.at(best, doc, logits(m, t))
    return _sigmoid(best.astype(np.float64))


def _gradients(m: dict, t: Tokens, docs: np.ndarray, label: np.ndarray, doc: np.ndarray, first: np.ndarray, size: np.ndarray):
    """Gradients of the cross-entropy of a batch of documents; of a document its windows share it by softmax of their logits."""
    x = _inputs(m, t)
    full = np.concatenate([x, np.zeros((1, x.shape[1]), np.float32)])
    p = {d: full @ m[f"W{d}"] + m[f"c{d}"] for d in "fb"}
    at = np.flatnonzero(np.isin(doc, docs))
    index, mask = _batch(first[at], size[at], t.kind, len(x))
    live = mask.astype(np.float32)
    steps = {d: [] for d in "fb"}
    s = np.concatenate([_run(m, p[d], d, index, live, steps[d]) for d in "fb"], axis=2).transpose(1, 0, 2)
    logit, a, u, c = _pool(m, s, mask)
    own = doc[at]
    _, of = np.unique(own, return_inverse=True)
    best = np.full(len(docs), -np.inf)
    np.maximum.at(best, of, logit)
    share = np.exp(3 * (logit - best[of]))
    share /= np.bincount(of, share)[of]
    error = _sigmoid(best) - label
    dl = (error[of] * share).astype(np.float32) / len(docs)
    g = {"w": c.T @ dl[:, None], "b": np.array([dl.sum()], np.float32)}
    dc = dl[:, None] * m["w"][:, 0]
    da = np.einsum("nh,nth->nt", dc, s)
    ds = a[..., None] * dc[:, None]
    de = a * (da - (a * da).sum(1, keepdims=True))
    g["v"] = np.einsum("ntk,nt->k", u, de)[:, None]
    du = de[..., None] * m["v"][:, 0] * (1 - u * u)
    g["A"] = np.einsum("nth,ntk->hk", s, du)
    g["a"] = du.sum((0, 1))
    ds += du @ m["A"].T
    dp = {}
    for d, cut in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
        back = np.zeros((len(at), HIDDEN), np.float32)
        dx = np.zeros((*index.shape, 3 * HIDDEN), np.float32)
        gu = np.zeros_like(m[f"U{d}"])
        for step, h, gate, z, r, n_ in reversed(steps[d]):
            back = back + ds[:, step, cut]
            k = live[:, step, None]
            new = back * k
            dn = new * (1 - z) * (1 - n_ * n_)
            dz = new * (h - n_) * z * (1 - z)
            dr = dn * gate[:, 2 * HIDDEN:] * r * (1 - r)
            dg = np.concatenate([dz, dr, dn * r], axis=1)
            dx[:, step] = np.concatenate([dz, dr, dn], axis=1)
            gu += h.T @ dg
            back = back * (1 - k) + new * z + dg @ m[f"U{d}"].T
        g[f"U{d}"] = gu
        flat = np.zeros((len(full), 3 * HIDDEN), np.float32)
        rows, sums = _sums(index[mask], dx[mask])
        flat[rows] = sums
        dp[d] = flat
        g[f"c{d}"] = flat.sum(0)
        g[f"W{d}"] = full.T @ flat
    dxs = sum(dp[d] @ m[f"W{d}"].T for d in "fb")[:-1]
    used = np.flatnonzero(np.abs(dxs).sum(1) > 0)
    g["word"] = (t.word[used], dxs[used, :WORD] * m["known"][t.word[used]])
    grams = t.grams[used]
    rows = t.gram[ranges((np.cumsum(t.grams) - t.grams)[used], grams)]
    g["char"] = (rows, np.repeat(dxs[used, WORD:] / np.sqrt(np.maximum(grams, 1))[:, None], grams, axis=0))
    loss = float(np.mean(np.logaddexp(0, np.where(label > 0, -best, best))))
    return g, loss


def train(data: np.ndarray, offsets: np.ndarray, label: np.ndarray, steps: int = 500, batch: int = 32, rate: float = 0.01, seed: int = 11) -> dict[str, np.ndarray]:
    """A model learned from labelled texts, by ``steps`` batches of whole texts with Adam; the same texts give the same model."""
    m = new_model(seed)
    if not len(label):
        return m
    t = tokens(data, offsets)
    of = np.repeat(np.arange(len(t.count)), t.count)
    pairs = np.unique(np.stack([t.word[t.kind], of], axis=1), axis=0) if len(of) else np.zeros((0, 2), np.int64)
    m["known"] = (np.bincount(pairs[:, 0], minlength=WORD_ROWS) >= SEEN).astype(np.float32)[:, None]
    doc, first, size = windows(t.count)
    m["b"][0] = np.log((label.sum() + 1) / (len(label) - label.sum() + 1))
    r = np.random.default_rng(seed)
    mean, square = ({k: np.zeros_like(v) for k, v in m.items() if k != "known"} for _ in "ab")
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < min(batch, len(label)):
            order = np.concatenate([order, r.permutation(len(label))])
        docs, order = np.unique(order[:batch]), order[batch:]
        part = _only(t, docs)
        d, f, n = windows(part.count)
        g, _ = _gradients(m, part, np.arange(len(docs)), label[docs], d, f, n)
        speed = rate * np.sqrt(1 - 0.999**step) / (1 - 0.9**step) * (1 - (step - 1) / steps)
        for name, value in g.items():
            if isinstance(value, tuple):  # rows of a table: only those touched move
                rows, grad = _sums(*value)
            else:
                rows, grad = slice(None), np.asarray(value, np.float32)
            mean[name][rows] = 0.9 * mean[name][rows] + 0.1 * grad
            square[name][rows] = 0.999 * square[name][rows] + 0.001 * grad * grad
            m[name][rows] -= (speed * mean[name][rows] / (np.sqrt(square[name][rows]) + 1e-6)).astype(np.float32)
    return m


def _only(t: Tokens, docs: np.ndarray) -> Tokens:
    """The tokens of some documents, with the distinct words they use."""
    begin = np.cumsum(t.count) - t.count
    kinds, kind = np.unique(t.kind[ranges(begin[docs], t.count[docs])], return_inverse=True)
    at = np.cumsum(t.grams) - t.grams
    places = ranges(begin[docs], t.count[docs])
    return Tokens(kind, t.count[docs], t.word[kinds], t.gram[ranges(at[kinds], t.grams[kinds])], t.grams[kinds], t.start[places])


def dump(m: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **m)
    return out.getvalue()


def load(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as z:
        return {k: z[k] for k in z.files}
