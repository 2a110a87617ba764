"""A small bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as its own embedding, the mean embedding of its character n-grams
(anchored at both ends of the word), and two evidence values counted on the
training sample.  Two recurrent layers read a window of words forwards and
backwards; attention weighs their states into one vector, and a logistic unit
scores it.  Words and n-grams outside the trained vocabularies enter as zeros.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def grams_of(word: str) -> list[str]:
    """Character n-grams of a word: all of three, and growing heads and tails."""
    w = f"<{word}>"
    n = len(w)
    grams = [w[i : i + 3] for i in range(n - 2)]
    grams += [w[:k] for k in range(4, min(n, 9))]
    grams += [w[-k:] for k in range(4, min(n, 6))]
    return grams


@dataclass
class Settings:
    """All limits here bound the training sample and the model, never the scoring."""

    window: int = 64
    stride: int = 48
    hidden: int = 8
    embedding: int = 6
    max_words: int = 20_000
    max_grams: int = 20_000
    min_texts: int = 3
    epochs: int = 6
    least_steps: int = 240
    batch: int = 128
    kept_words: int = 200_000
    rate: float = 0.01
    seed: int = 7


def windows_of(n: int, window: int, stride: int) -> list[int]:
    """Starts of overlapping windows that cover all of ``n`` words."""
    if n <= window:
        return [0]
    starts = list(range(0, n - window, stride))
    return [*starts, n - window]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


@dataclass
class Net:
    settings: Settings
    word_ids: dict[str, int]
    gram_ids: dict[str, int]
    word_evidence: np.ndarray
    gram_evidence: np.ndarray
    p: dict[str, np.ndarray]
    shift: float = 0.0

    def __post_init__(self) -> None:
        self.seen: dict[str, int] = {}
        self.done = [np.zeros((0, 3 * self.settings.hidden), np.float32)] * 2

    # --- inputs ------------------------------------------------------------

    def word_inputs(self, words: list[str]) -> tuple:
        """For distinct words: ids, n-gram ids laid end to end, their counts, two evidence values."""
        ids = np.fromiter((self.word_ids.get(w, 0) for w in words), np.int64, len(words))
        flat: list[int] = []
        lengths = np.zeros(len(words), np.int64)
        values = np.zeros((len(words), 2), np.float32)
        get, evidence = self.gram_ids.get, self.gram_evidence.tolist()
        for i, w in enumerate(words):
            own = [g for g in map(get, grams_of(w)) if g]
            if own:
                flat += own
                lengths[i] = len(own)
                values[i, 0] = max((evidence[g] for g in own), key=abs)
        values[:, 1] = self.word_evidence[ids]
        return ids, np.array(flat, np.int64), lengths, values

    def inputs(self, words: list[str]) -> np.ndarray:
        return self.compose(*self.word_inputs(words))

    def compose(self, ids, flat, lengths, values) -> np.ndarray:
        """Input vectors: word embedding, mean n-gram embedding, evidence."""
        chars = np.zeros((len(ids), self.settings.embedding), np.float32)
        if len(flat):
            filled = lengths > 0
            begins = (np.cumsum(lengths) - lengths)[filled]
            chars[filled] = np.add.reduceat(self.p["gram"][flat], begins, axis=0)
            chars[filled] /= lengths[filled, None]
        return np.hstack([self.p["word"][ids], chars, values]).astype(np.float32)

    # --- network -----------------------------------------------------------

    def projections(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Input terms of both directions for distinct words; row 0 is padding."""
        rows = np.vstack([np.zeros((1, x.shape[1]), np.float32), x])
        p = self.p
        return rows @ p["Wf"] + p["bf"], rows @ p["Wb"] + p["bb"]

    def _run(self, proj, index, mask, u, order, keep):
        h_size = self.settings.hidden
        h = np.zeros((index.shape[0], h_size), np.float32)
        states = np.zeros((index.shape[1], index.shape[0], h_size), np.float32)
        tape = []
        for t in order:
            a = proj[index[:, t]]
            g = _sigmoid(a[:, : 2 * h_size] + h @ u[:, : 2 * h_size])
            z, r = g[:, :h_size], g[:, h_size:]
            rh = r * h
            c = np.tanh(a[:, 2 * h_size :] + rh @ u[:, 2 * h_size :])
            m = mask[:, t : t + 1]
            step = z * (c - h) * m
            if keep:
                tape.append((t, h, z, r, c, rh))
            h = h + step
            states[t] = h
        return states, tape

    def forward(self, proj, index, keep=False):
        p, n = self.p, index.shape[1]
        mask = (index > 0).astype(np.float32)
        fw, tape_f = self._run(proj[0], index, mask, p["Uf"], range(n), keep)
        bw, tape_b = self._run(proj[1], index, mask, p["Ub"], range(n - 1, -1, -1), keep)
        states = np.concatenate([fw, bw], axis=2)
        e = np.tanh(states @ p["Wa"] + p["ba"])
        weights = e @ p["va"] + np.where(mask.T > 0, 0.0, -1e9).astype(np.float32)
        weights = np.exp(weights - weights.max(axis=0))
        weights /= weights.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weights, states)
        logit = pooled @ p["vo"] + p["bo"][0]
        return logit, (mask, tape_f, tape_b, states, e, weights, pooled)

    def backward(self, saved, d_logit, index, size):
        """Gradients of all parameters, and of the projections of both directions."""
        p, h_size = self.p, self.settings.hidden
        mask, tape_f, tape_b, states, e, weights, pooled = saved
        g = {"vo": pooled.T @ d_logit, "bo": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * p["vo"]
        d_states = weights[:, :, None] * d_pooled
        d_weights = np.einsum("tnh,nh->tn", states, d_pooled)
        d_score = weights * (d_weights - (weights * d_weights).sum(axis=0))
        g["va"] = np.einsum("tna,tn->a", e, d_score)
        d_e = d_score[:, :, None] * p["va"] * (1 - e * e)
        g["Wa"] = np.einsum("tnh,tna->ha", states, d_e, optimize=True)
        g["ba"] = d_e.sum(axis=(0, 1))
        d_states = d_states + d_e @ p["Wa"].T
        d_proj = []
        for name, tape, part in (("Uf", tape_f, 0), ("Ub", tape_b, 1)):
            u = p[name]
            du = np.zeros_like(u)
            dp = np.zeros((size, 3 * h_size), np.float32)
            dh = np.zeros((index.shape[0], h_size), np.float32)
            for t, h, z, r, c, rh in reversed(tape):
                dh = dh + d_states[t][:, part * h_size : (part + 1) * h_size]
                m = mask[:, t : t + 1]
                dc = dh * z * m * (1 - c * c)
                dz = dh * (c - h) * m * z * (1 - z)
                d_rh = dc @ u[:, 2 * h_size :].T
                dr = d_rh * h * r * (1 - r)
                d_zr = np.hstack([dz, dr])
                du[:, : 2 * h_size] += h.T @ d_zr
                du[:, 2 * h_size :] += rh.T @ dc
                np.add.at(dp, index[:, t], np.hstack([d_zr, dc]))
                dh = dh * (1 - z * m) + d_rh * r + d_zr @ u[:, : 2 * h_size].T
            g[name] = du
            dp[0] = 0
            d_proj.append(dp)
        return g, d_proj

    # --- scoring -----------------------------------------------------------

    def score(self, texts: list[str | None], most_windows: int = 2048) -> np.ndarray:
        """Largest window score of each whole text; every overlapping window is scored.

        Windows are run in groups of at most ``most_windows``, so memory does not
        grow with the length of a text.  Texts without words take the score of
        an empty window.
        """
        s = self.settings
        best = np.full(len(texts), -np.inf)
        rows: list[np.ndarray] = []
        owners: list[int] = []
        seen, done = self.seen, self.done

        def flush() -> None:
            if not rows:
                return
            # Input terms are worked out once for each word met.
            have = len(done[0])
            if len(seen) >= have:
                new = self.projections(self.inputs(list(seen)[max(have - 1, 0) :]))
                for k in (0, 1):
                    done[k] = np.vstack([done[k], new[k][1:]]) if have else new[k]
            logit, _ = self.forward(done, np.vstack(rows))
            np.maximum.at(best, np.array(owners), logit)
            rows.clear(), owners.clear()
            if len(seen) > s.kept_words:
                seen.clear()
                done[:] = [np.zeros((0, 3 * s.hidden), np.float32)] * 2

        for k, text in enumerate(texts):
            words = words_of(text)
            at, starts = 0, windows_of(len(words), s.window, s.stride)
            while at < len(starts):
                some = starts[at : at + most_windows - len(rows)]
                begin, end = some[0], min(some[-1] + s.window, len(words))
                ids = np.fromiter(
                    (seen.setdefault(w, len(seen) + 1) for w in words[begin:end]), np.int32, end - begin
                )
                for b in some:
                    row = np.zeros(s.window, np.int32)
                    own = ids[b - begin : b - begin + s.window]
                    row[: len(own)] = own
                    rows.append(row)
                    owners.append(k)
                at += len(some)
                if len(rows) >= most_windows:
                    flush()
        flush()
        return _sigmoid(best - self.shift)


def _evidence(groups: Iterable[set[str]], y: np.ndarray, least: int, most: int):
    """Smoothed log odds of the items that occur in at least ``least`` texts.

    The most telling ``most`` items get ids from 1; 0 stands for all others.
    Groups are taken one at a time.
    """
    seen: Counter[str] = Counter()
    hit: Counter[str] = Counter()
    for g, label in zip(groups, y, strict=True):
        seen.update(g)
        if label:
            hit.update(g)
    n1 = max(int(y.sum()), 1)
    n0 = max(len(y) - n1, 1)
    odds = {}
    for item, n in seen.items():
        if n >= least:
            a = hit.get(item, 0)
            odds[item] = np.log((a + 0.2) / (n1 + 0.4)) - np.log((n - a + 0.2) / (n0 + 0.4))
            # Rare items are trusted less.
            odds[item] *= n / (n + 4.0)
    chosen = sorted(odds, key=lambda x: (-abs(odds[x]) * np.sqrt(seen[x]), x))[:most]
    ids = {x: i + 1 for i, x in enumerate(chosen)}
    values = np.zeros(len(ids) + 1, np.float32)
    for x, i in ids.items():
        values[i] = np.clip(odds[x], -4, 4)
    return ids, values


def train(texts: list[str], labels: list[int], settings: Settings | None = None) -> Net:
    """Fit on labelled texts (a bounded sample), window by window.

    A text's label holds for its most telling window, so each epoch takes that
    one, first by the evidence values, then twice chosen anew by the network; a second,
    random window is added for texts labelled 0, all of whose windows are clean.
    A fifth of the texts is kept back to set the score at which 0.5 lies.
    """
    s = settings or Settings()
    rng = np.random.default_rng(s.seed)
    y = np.asarray(labels, np.float32)
    words = [words_of(t) for t in texts]
    back = rng.random(len(texts)) < 0.2
    fit = np.flatnonzero(~back) if 0 < y[~back].sum() < (~back).sum() else np.arange(len(texts))
    word_ids, word_values = _evidence([set(words[i]) for i in fit], y[fit], s.min_texts, s.max_words)
    gram_sets = ({g for w in set(words[i]) for g in grams_of(w)} for i in fit)
    gram_ids, gram_values = _evidence(gram_sets, y[fit], s.min_texts, s.max_grams)
    d, h, a = 2 * s.embedding + 2, s.hidden, 8

    def glorot(*shape):
        return rng.normal(0, np.sqrt(2.0 / sum(shape)), shape).astype(np.float32)

    p = {
        "word": rng.normal(0, 0.1, (len(word_ids) + 1, s.embedding)).astype(np.float32),
        "gram": rng.normal(0, 0.1, (len(gram_ids) + 1, s.embedding)).astype(np.float32),
        "Wf": glorot(d, 3 * h), "Wb": glorot(d, 3 * h), "Uf": glorot(h, 3 * h), "Ub": glorot(h, 3 * h),
        "bf": np.zeros(3 * h, np.float32), "bb": np.zeros(3 * h, np.float32),
        "Wa": glorot(2 * h, a), "ba": np.zeros(a, np.float32), "va": glorot(a, 1)[:, 0],
        "vo": glorot(2 * h, 1)[:, 0], "bo": np.zeros(1, np.float32),
    }
    p["word"][0] = p["gram"][0] = 0
    net = Net(s, word_ids, gram_ids, word_values, gram_values, p)
    vocab: dict[str, int] = {}
    for own in words:
        for w in own:
            vocab.setdefault(w, len(vocab) + 1)
    ids, gram_flat, lengths, values = net.word_inputs(list(vocab))
    gram_begin = np.cumsum(lengths) - lengths

    def parts(used: np.ndarray) -> tuple:
        """Inputs of some words: ids, n-grams, counts, values."""
        n = lengths[used]
        at = np.repeat(gram_begin[used] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return ids[used], gram_flat[at], n, values[used]

    coded = [np.array([vocab[x] for x in w], np.int32) for w in words]
    del words, vocab
    starts = [windows_of(len(c), s.window, s.stride) for c in coded]

    def window(i: int, b: int) -> np.ndarray:
        row = np.zeros(s.window, np.int32)
        own = coded[i][b : b + s.window]
        row[: len(own)] = own
        return row

    def best_windows(score) -> list[int]:
        flat = np.vstack([window(i, b) for i in range(len(coded)) for b in starts[i]])
        v = np.concatenate([score(flat[k : k + 2048]) for k in range(0, len(flat), 2048)])
        out, at = [], 0
        for own in starts:
            out.append(own[int(np.argmax(v[at : at + len(own)]))])
            at += len(own)
        return out

    def by_network(flat: np.ndarray) -> np.ndarray:
        used, index = np.unique(flat, return_inverse=True)
        index = index.reshape(flat.shape) + (used[0] != 0)
        used = used[used > 0] - 1
        x = net.compose(*parts(used))
        return net.forward(net.projections(x), index)[0]

    total = np.concatenate([[0.0], np.maximum(values, 0).sum(axis=1)]) ** 2
    top = best_windows(lambda flat: total[flat].sum(axis=1))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    balance = float(len(fit) - y[fit].sum()) / max(float(y[fit].sum()), 1.0)
    step = 0
    per_epoch = -(-(2 * len(fit) - int(y[fit].sum())) // s.batch)
    epochs = max(s.epochs, -(-s.least_steps // per_epoch))
    for epoch in range(epochs):
        if epoch in (epochs // 3, 2 * epochs // 3):
            top = best_windows(by_network)
        items = [(i, top[i]) for i in fit]
        items += [(i, starts[i][rng.integers(len(starts[i]))]) for i in fit if y[i] == 0]
        order = rng.permutation(len(items))
        for k in range(0, len(order), s.batch):
            some = [items[j] for j in order[k : k + s.batch]]
            flat = np.vstack([window(i, b) for i, b in some])
            t = y[[i for i, _ in some]]
            used, index = np.unique(flat, return_inverse=True)
            index = index.reshape(flat.shape) + (used[0] != 0)
            used = used[used > 0] - 1
            own_ids, own_grams, n_grams, own_values = parts(used)
            x = net.compose(own_ids, own_grams, n_grams, own_values)
            proj = net.projections(x)
            logit, saved = net.forward(proj, index, keep=True)
            weight = np.where(t > 0, min(balance, 4.0), 1.0).astype(np.float32)
            d_logit = (weight * (_sigmoid(logit) - t) / len(t)).astype(np.float32)
            g, d_proj = net.backward(saved, d_logit, index, len(used) + 1)
            dx = np.zeros_like(x)
            for w, b, dp in (("Wf", "bf", d_proj[0]), ("Wb", "bb", d_proj[1])):
                g[w] = x.T @ dp[1:]
                g[b] = dp.sum(axis=0)
                dx += dp[1:] @ p[w].T
            e = s.embedding
            g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
            np.add.at(g["word"], own_ids, dx[:, :e])
            per = dx[:, e : 2 * e] / np.maximum(n_grams, 1)[:, None]
            np.add.at(g["gram"], own_grams, np.repeat(per, n_grams, axis=0))
            g["word"][0] = 0
            step += 1
            rate = s.rate * (1 - 0.8 * epoch / epochs)
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            clip = min(1.0, 5.0 / (norm + 1e-9))
            for name, grad in g.items():
                m, v = moments[name]
                grad = grad * clip
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                p[name] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    # Where 0.5 lies: the cut with the fewest errors on the texts kept back.
    held = np.flatnonzero(back) if 0 < y[back].sum() < back.sum() else fit
    flat = np.vstack([window(i, b) for i in held for b in starts[i]])
    v = np.concatenate([by_network(flat[k : k + 2048]) for k in range(0, len(flat), 2048)])
    at, best = 0, []
    for i in held:
        best.append(v[at : at + len(starts[i])].max())
        at += len(starts[i])
    net.shift = _cut(np.array(best), y[held])
    return net


def _cut(logits: np.ndarray, y: np.ndarray) -> float:
    """The middle of the widest gap among the cuts with the fewest errors."""
    order = np.argsort(logits, kind="stable")
    v, t = logits[order].astype(float), y[order]
    errors = np.concatenate([[0], np.cumsum(t)]) + np.concatenate([np.cumsum((1 - t)[::-1])[::-1], [0]])
    edges = np.concatenate([[v[0] - 2.0], v, [v[-1] + 2.0]])
    gaps = np.diff(edges)
    best = np.flatnonzero(errors == errors.min())
    k = best[np.argmax(gaps[best])]
    return float((edges[k] + edges[k + 1]) / 2)
