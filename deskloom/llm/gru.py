"""A bidirectional gated recurrent network with attention pooling, in numpy.

A token's input is the vector of its word (words seen too rarely share one vector) next to the
mean vector of its character n-grams. Two recurrent layers read a window of tokens in both
directions, an attention layer weighs their states, and a logistic unit scores the pooled state.
Everything that depends on a word alone is computed once per distinct word of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

WORD_DIM = 12
CHAR_DIM = 20
HIDDEN = 12
GRAMS = (3, 4, 5)
GRAM_BUCKETS = 1 << 16
PAD_GATE = -30.0
#: Distinct words whose gates are held together.
MOST_WORDS = 1 << 16
RATE, TABLE_RATE = 0.01, 0.5
LEAST_DOCUMENTS = 2
REVIEWS = 3
TABLES = ("words", "grams")

_draw = np.random.default_rng(20240411)
_PLACE = _draw.integers(1, 2**63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_draw.integers(1, 2**62)) * 4 + 1
_STEP = 1 << 16

_TOKEN = np.zeros(128, bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def _powers(base: int) -> np.ndarray:
    out = np.full(_STEP, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


@dataclass
class Tokens:
    """Distinct words of some texts and where they stand."""

    hashes: np.ndarray  # per distinct word
    chars: np.ndarray  # code points of the texts, lower-cased
    start: np.ndarray  # of one occurrence of each distinct word
    size: np.ndarray
    word: np.ndarray  # distinct word of each token
    upto: np.ndarray  # tokens before each text, and in all


def tokenize(texts: list[str]) -> Tokens:
    """Tokens are runs of letters and digits; every character beyond ASCII counts as a letter."""
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) + 1 for t in lowered])
    chars = np.frombuffer("\n".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = chars >= 128
    ascii_at = np.flatnonzero(~inside)
    inside[ascii_at] = _TOKEN[chars[ascii_at]]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    stops = ~inside
    stops[1:] &= inside[:-1]
    stops[0] = False
    start, end = np.flatnonzero(begins), np.flatnonzero(stops)
    upto = np.searchsorted(start, np.append(0, np.cumsum(sizes)))
    if not len(start):
        none = np.zeros(0, np.int64)
        return Tokens(np.zeros(0, np.uint64), chars, none, none, none, upto)
    # a word's hash: sum of code points times powers by place; powers repeat after _STEP places
    place = np.arange(len(chars)) % _STEP
    values = np.where(inside, chars, 0).astype(np.uint64)
    values = _mix(values + _PLACE[7]) * _UP[place]
    values[~inside] = 0
    sums = np.add.reduceat(values, start) * _DOWN[start % _STEP]
    wraps = np.flatnonzero(start // _STEP != (end - 1) // _STEP)
    for w in wraps:  # the few words across a repetition are hashed by themselves
        own = chars[start[w] : end[w]].astype(np.uint64)
        sums[w] = (_mix(own + _PLACE[7]) * _UP[np.arange(len(own)) % _STEP]).sum(dtype=np.uint64)
    hashes, first, word = np.unique(_mix(sums), return_index=True, return_inverse=True)
    return Tokens(hashes, chars, start[first], (end - start)[first], word.ravel(), upto)


def framed_words(tokens: Tokens, words: np.ndarray) -> np.ndarray:
    """Characters of words of one length, a mark on both sides, as one row each."""
    size = int(tokens.size[words[0]])
    out = np.zeros((size + 2, len(words)), np.uint64)
    start = tokens.start[words]
    for k in range(size):
        out[k + 1] = tokens.chars[start + k]
    return out


def gram_buckets(framed: np.ndarray) -> np.ndarray:
    """(n-grams of a word, words): the bucket of every character n-gram."""
    rows = []
    for n in GRAMS:
        for at in range(len(framed) - n + 1):
            value = framed[at] * _PLACE[0] + np.uint64(n)
            for k in range(1, n):
                value += framed[at + k] * _PLACE[k]
            rows.append(value)
    return (_mix(np.array(rows)) & np.uint64(GRAM_BUCKETS - 1)).astype(np.int32)


def by_length(tokens: Tokens) -> Iterator[np.ndarray]:
    """Numbers of the distinct words, those of one length together, a bounded number at a time."""
    order = np.argsort(tokens.size, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(tokens.size[order])) + 1):
        if len(same):
            most = max(1, (1 << 18) // int(tokens.size[same[0]] + 2))
            yield from (same[i : i + most] for i in range(0, len(same), most))


def char_grams(tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of every character n-gram of the distinct words, n-grams before each word); a word
    is framed by a mark on both sides, so every word has at least one n-gram of three."""
    framed = tokens.size + 2
    counts = sum(np.maximum(framed - n + 1, 0) for n in GRAMS)
    upto = np.append(0, np.cumsum(counts)).astype(np.int64)
    buckets = np.zeros(upto[-1], np.int32)
    for words in by_length(tokens):
        found = gram_buckets(framed_words(tokens, words))
        buckets[upto[words] + np.arange(len(found))[:, None]] = found
    return buckets, upto


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


@dataclass
class Model:
    """Weights; ``vocabulary`` has the sorted hashes of the words with a vector of their own, and
    row 0 of ``words`` is the vector of all others."""

    vocabulary: np.ndarray
    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(vocabulary: np.ndarray, seed: int) -> Model:
        rng = np.random.default_rng(seed)

        def draw(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        inputs = WORD_DIM + CHAR_DIM
        weights = {
            "words": draw(len(vocabulary) + 1, WORD_DIM, scale=0.02),
            "grams": draw(GRAM_BUCKETS, CHAR_DIM, scale=0.05),
            "bias": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "inputs": draw(2, inputs, 3 * HIDDEN, scale=inputs**-0.5),
            "attend": draw(2 * HIDDEN, HIDDEN, scale=(2 * HIDDEN) ** -0.5),
            "attend_bias": np.zeros(HIDDEN, np.float32),
            "attend_out": draw(HIDDEN, scale=HIDDEN**-0.5),
            "out": draw(2 * HIDDEN, scale=(2 * HIDDEN) ** -0.5),
            "out_bias": np.zeros(1, np.float32),
        }
        weights |= {f"{g}_state": draw(2, HIDDEN, HIDDEN, scale=HIDDEN**-0.5) for g in "zrc"}
        return Model(vocabulary, weights)

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        """The row of ``words`` of each hash."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)

    def word_inputs(self, rows: np.ndarray, buckets: np.ndarray, upto: np.ndarray) -> np.ndarray:
        means = np.add.reduceat(self.weights["grams"][buckets], upto[:-1], axis=0)
        means /= np.diff(upto)[:, None].astype(np.float32)
        return np.concatenate([self.weights["words"][rows], means], axis=1)

    def all_word_inputs(self, tokens: Tokens) -> np.ndarray:
        """The inputs of all distinct words, without a table of their n-grams."""
        table = self.weights["grams"]
        out = np.zeros((len(tokens.hashes), WORD_DIM + CHAR_DIM), np.float32)
        out[:, :WORD_DIM] = self.weights["words"][self.rows(tokens.hashes)]
        for words in by_length(tokens):
            found = gram_buckets(framed_words(tokens, words))
            total = table.take(found[0], 0)
            for row in found[1:]:
                total += table.take(row, 0)
            out[words, WORD_DIM:] = total / np.float32(len(found))
        return out

    def gates(self, inputs: np.ndarray) -> list[np.ndarray]:
        """Per gate (z, r, c) the inputs' share for both directions; the last row is padding, which
        leaves the state as it is."""
        out = np.zeros((2, len(inputs) + 1, 3 * HIDDEN), np.float32)
        np.matmul(inputs[None], self.weights["inputs"], out=out[:, :-1])
        out += self.weights["bias"]
        out[:, -1, :HIDDEN] = PAD_GATE
        return [np.ascontiguousarray(out[:, :, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3)]

    def forward(self, gates: list[np.ndarray], ids: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, tuple]:
        """Logits of windows ``ids`` (windows × tokens, padding is the gates' last row)."""
        w = self.weights
        b, t = ids.shape
        columns = np.ascontiguousarray(ids.T)
        states = np.zeros((2, t, b, HIDDEN), np.float32)
        h = np.zeros((2, b, HIDDEN), np.float32)
        for s in range(t):
            now = (columns[s], columns[t - 1 - s])
            z, r, c = (np.stack([g[0].take(now[0], 0), g[1].take(now[1], 0)]) for g in gates)
            z += h @ w["z_state"]
            r += h @ w["r_state"]
            z, r = _sigmoid(z), _sigmoid(r)
            held = r * h
            c += held @ w["c_state"]
            np.tanh(c, out=c)
            if keep is not None:
                keep.append((h, z, r, c, held))
            h = h + z * (c - h)
            states[0, s], states[1, t - 1 - s] = h
        both = np.concatenate([states[0], states[1]], axis=2)
        hidden = np.tanh(both @ w["attend"] + w["attend_bias"])
        energy = hidden @ w["attend_out"]
        energy[columns == len(gates[0][0]) - 1] = -1e9
        energy -= energy.max(axis=0)
        share = np.exp(energy)
        share /= share.sum(axis=0)
        pooled = (share[:, :, None] * both).sum(axis=0)
        return pooled @ w["out"] + w["out_bias"], (both, hidden, share, pooled, columns)

    def backward(self, d_logit: np.ndarray, memo: tuple, keep: list, words: int) -> dict[str, np.ndarray]:
        """Gradients; those of the words' gate inputs are under ``gates`` (2 × words × 3 hidden)."""
        w = self.weights
        both, hidden, share, pooled, columns = memo
        t, b = columns.shape
        grad = {"out": pooled.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * w["out"]
        d_both = share[:, :, None] * d_pooled
        d_share = (both * d_pooled).sum(axis=2)
        d_energy = share * (d_share - (share * d_share).sum(axis=0))
        grad["attend_out"] = np.tensordot(d_energy, hidden, 2)
        d_hidden = d_energy[:, :, None] * w["attend_out"] * (1 - hidden**2)
        grad["attend"] = np.tensordot(both, d_hidden, ((0, 1), (0, 1)))
        grad["attend_bias"] = d_hidden.sum(axis=(0, 1))
        d_both += d_hidden @ w["attend"].T
        for g in "zrc":
            grad[f"{g}_state"] = np.zeros_like(w[f"{g}_state"])
        turned = {g: w[f"{g}_state"].transpose(0, 2, 1) for g in "zrc"}
        d_in = np.zeros((2, t, b, 3 * HIDDEN), np.float32)
        dh = np.zeros((2, b, HIDDEN), np.float32)
        for s in range(t - 1, -1, -1):
            h, z, r, c, held = keep[s]
            dh[0] += d_both[s, :, :HIDDEN]
            dh[1] += d_both[t - 1 - s, :, HIDDEN:]
            dz = dh * (c - h) * z * (1 - z)
            dc = dh * z * (1 - c * c)
            d_held = dc @ turned["c"]
            dr = d_held * h * r * (1 - r)
            back = h.transpose(0, 2, 1)
            grad["z_state"] += back @ dz
            grad["r_state"] += back @ dr
            grad["c_state"] += held.transpose(0, 2, 1) @ dc
            dh = dh * (1 - z) + d_held * r + dz @ turned["z"] + dr @ turned["r"]
            joined = np.concatenate([dz, dr, dc], axis=2)
            d_in[0, s], d_in[1, t - 1 - s] = joined
        flat = columns.ravel()
        order = np.argsort(flat, kind="stable")
        ids, first = np.unique(flat[order], return_index=True)
        sums = np.add.reduceat(d_in.reshape(2, -1, 3 * HIDDEN)[:, order], first, axis=1)
        real = ids < words
        gates = np.zeros((2, words, 3 * HIDDEN), np.float32)
        gates[:, ids[real]] = sums[:, real]
        grad["gates"] = gates
        return grad


class Adam:
    """Adam for the dense weights. The two vector tables take plain steps scaled by one second
    moment per table: a row moves as far as its own evidence goes, so rare words stay near zero."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float, table_rate: float):
        self.weights, self.rate, self.table_rate, self.step = weights, rate, table_rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in weights.items() if k not in TABLES}
        self.square = {k: np.zeros_like(v) for k, v in self.mean.items()} | dict.fromkeys(TABLES, 0.0)

    def update(self, grads: dict[str, np.ndarray], rows: dict[str, np.ndarray]) -> None:
        self.step += 1
        fix = 1 - 0.99**self.step
        for name, g in grads.items():
            if name in TABLES:
                self.square[name] = self.square[name] * 0.99 + 0.01 * float((g * g).sum())
                self.weights[name][rows[name]] -= self.table_rate * g / ((self.square[name] / fix) ** 0.5 + 1e-9)
                continue
            self.mean[name] = self.mean[name] * 0.9 + 0.1 * g
            self.square[name] = self.square[name] * 0.99 + 0.01 * g * g
            scale = self.rate / (1 - 0.9**self.step)
            self.weights[name] -= scale * self.mean[name] / (np.sqrt(self.square[name] / fix) + 1e-7)


def _row_sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(rows, kind="stable")
    ids, first = np.unique(rows[order], return_index=True)
    return ids, np.add.reduceat(values[order], first, axis=0)


def window_ids(tokens: Tokens, starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Word numbers of the windows, padded with the number of words."""
    at = starts[:, None] + np.arange(size)
    ids = tokens.word[np.minimum(at, max(0, len(tokens.word) - 1))] if len(tokens.word) else np.zeros(at.shape, np.int64)
    return np.where(at < ends[:, None], ids, len(tokens.hashes))


def windows(upto: np.ndarray, size: int, stride: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first token, token after the last, text) of all overlapping windows; the last window of a
    text ends with it, and a text without tokens has one empty window."""
    n = np.diff(upto)
    count = 1 + np.maximum(0, -(-(n - size) // stride))
    text = np.repeat(np.arange(len(n)), count)
    place = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    start = upto[:-1][text] + np.minimum(place * stride, np.maximum(0, n - size)[text])
    return start, np.minimum(start + size, upto[1:][text]), text


def tokenize_all(texts: list[str], together: int = 200) -> Tokens:
    """``tokenize`` in portions; of the characters only those of distinct words are held."""
    parts = [tokenize(texts[i : i + together]) for i in range(0, len(texts), together)]
    hashes = np.concatenate([p.hashes for p in parts])
    chars, start, at = [], [], 0
    for p in parts:
        inner = np.arange(p.size.sum()) - np.repeat(np.cumsum(p.size) - p.size, p.size)
        chars.append(p.chars[np.repeat(p.start, p.size) + inner])
        start.append(at + np.cumsum(p.size) - p.size)
        at += len(chars[-1])
    unique, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    before = np.cumsum([0, *[len(p.hashes) for p in parts]])
    word = np.concatenate([number.ravel()[b + p.word] for b, p in zip(before, parts)])
    counts = np.concatenate([np.diff(p.upto) for p in parts])
    return Tokens(
        unique,
        np.concatenate(chars),
        np.concatenate(start)[first],
        np.concatenate([p.size for p in parts])[first],
        word,
        np.append(0, np.cumsum(counts)),
    )


def train(texts: list[str], labels: np.ndarray, size: int, stride: int, steps: int, batch: int, seed: int) -> Model:
    """Fit on the windows of labelled texts. At each review a positive text's windows count only if
    they score near its best one: a text is labelled as a whole, and some passages are clean."""
    rng = np.random.default_rng(seed)
    if not len(texts) or labels.min() == labels.max():
        return Model.fresh(np.zeros(0, np.uint64), seed)
    tokens = tokenize_all(texts)
    starts, ends, group = windows(tokens.upto, size, stride)
    label = labels[group]
    # a word counts once per text
    holder = np.repeat(np.arange(len(texts)), np.diff(tokens.upto))
    once = np.unique(tokens.word * len(texts) + holder) // len(texts)
    vocabulary = tokens.hashes[np.bincount(once, minlength=len(tokens.hashes)) >= LEAST_DOCUMENTS]
    model = Model.fresh(vocabulary, seed)
    rows = model.rows(tokens.hashes)
    buckets, upto = char_grams(tokens)
    optimizer = Adam(model.weights, RATE, TABLE_RATE)
    pools = [np.flatnonzero(label == k) for k in (0, 1)]
    for step in range(steps):
        if step and step % (steps // REVIEWS) == 0:
            logits = score_windows(model, tokens, starts, ends, size)
            best = np.full(group.max() + 1, -np.inf)
            np.maximum.at(best, group, logits)
            pools[1] = np.flatnonzero((label == 1) & (logits >= best[group] - 2))
        if step == 3 * steps // 4:
            optimizer.rate, optimizer.table_rate = RATE / 4, TABLE_RATE / 4
        chosen = np.concatenate([rng.choice(pools[0], batch - batch // 3), rng.choice(pools[1], batch // 3)])
        word_ids = window_ids(tokens, starts[chosen], ends[chosen], size)
        used, ids = np.unique(word_ids, return_inverse=True)
        ids = ids.reshape(word_ids.shape)
        if used[-1] == len(tokens.hashes):
            used = used[:-1]
        lengths = upto[used + 1] - upto[used]
        offsets = np.append(0, np.cumsum(lengths))
        grams = buckets[np.repeat(upto[used] - offsets[:-1], lengths) + np.arange(offsets[-1])]
        inputs = model.word_inputs(rows[used], grams, offsets)
        keep: list = []
        gates = model.gates(inputs)
        logits, memo = model.forward(gates, ids, keep)
        d_logit = ((1 / (1 + np.exp(-logits)) - label[chosen]) / len(chosen)).astype(np.float32)
        grad = model.backward(d_logit, memo, keep, len(used))
        d_gates = grad.pop("gates")
        grad["bias"] = d_gates.sum(axis=1, keepdims=True)
        grad["inputs"] = inputs.T[None] @ d_gates
        d_inputs = (d_gates @ model.weights["inputs"].transpose(0, 2, 1)).sum(axis=0)
        word_rows, grad["words"] = _row_sums(rows[used], d_inputs[:, :WORD_DIM])
        d_grams = np.repeat(d_inputs[:, WORD_DIM:] / lengths[:, None].astype(np.float32), lengths, axis=0)
        gram_rows, grad["grams"] = _row_sums(grams, d_grams)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        if norm > 1:
            grad = {k: g / norm for k, g in grad.items()}
        optimizer.update(grad, {"words": word_rows, "grams": gram_rows})
    return model


def score_windows(
    model: Model, tokens: Tokens, starts: np.ndarray, ends: np.ndarray, size: int, batch: int = 1024
) -> np.ndarray:
    """Logits of the windows from ``starts`` to ``ends`` (token numbers, at most ``size`` apart)."""
    out = np.zeros(len(starts), np.float32)
    at_once = len(tokens.hashes) <= MOST_WORDS
    gates = model.gates(model.all_word_inputs(tokens)) if at_once else None
    for at in range(0, len(starts), batch):
        part = slice(at, at + batch)
        ids = window_ids(tokens, starts[part], ends[part], size)
        if at_once:
            out[part], _ = model.forward(gates, ids)
            continue
        # of very many distinct words, only those of the batch
        used, own = np.unique(ids, return_inverse=True)
        words = used[used < len(tokens.hashes)]
        few = Tokens(tokens.hashes[words], tokens.chars, tokens.start[words], tokens.size[words], own, tokens.upto)
        out[part], _ = model.forward(model.gates(model.all_word_inputs(few)), own.reshape(ids.shape))
    return out
