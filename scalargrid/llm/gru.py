"""Bidirectional gated recurrent network with attention pooling, forward and backward in numpy.

Inputs are windows: matrices of word vectors, one row per word. Each direction has update, reset
and candidate gates; both states of a word are joined, attention weights sum them up, and a linear
unit gives one logit per window.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from scalargrid.llm.word_inputs import WordInputs


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


@dataclass
class Gru:
    inputs: int
    hidden: int = 8
    attention: int = 8
    seed: int = 7
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.weights:
            return
        random, h = np.random.default_rng(self.seed), self.hidden

        def drawn(rows: int, columns: int) -> np.ndarray:
            return (random.standard_normal((rows, columns)) / np.sqrt(rows)).astype(np.float32)

        for side in ("f", "b"):
            self.weights |= {f"W{side}": drawn(self.inputs, 3 * h), f"U{side}": drawn(h, 3 * h), f"c{side}": np.zeros(3 * h, np.float32)}
        self.weights |= {
            "A": drawn(2 * h, self.attention), "a": np.zeros(self.attention, np.float32), "v": drawn(self.attention, 1)[:, 0],
            "o": drawn(2 * h, 1)[:, 0], "d": np.zeros(1, np.float32),
        }

    def _states(self, x: np.ndarray, side: str, keep: list | None) -> np.ndarray:
        """Hidden state after each word, in the order of the words; ``x`` is time first, already projected."""
        h, u = self.hidden, self.weights[f"U{side}"]
        state = np.zeros((x.shape[1], h), np.float32)
        out = np.empty((x.shape[0], x.shape[1], h), np.float32)
        for t in range(x.shape[0]) if side == "f" else range(x.shape[0] - 1, -1, -1):
            own = state @ u
            gates = _sigmoid(x[t, :, : 2 * h] + own[:, : 2 * h])
            update, reset = gates[:, :h], gates[:, h:]
            candidate = np.tanh(x[t, :, 2 * h :] + reset * own[:, 2 * h :])
            after = candidate + update * (state - candidate)
            if keep is not None:
                keep.append((t, state, own[:, 2 * h :], update, reset, candidate))
            out[t] = state = after
        return out

    def forward(self, words: np.ndarray, kept: dict | None = None) -> np.ndarray:
        """Logits of windows; ``words`` is time, window, input."""
        w = self.weights
        states = []
        for side in ("f", "b"):
            steps = None if kept is None else kept.setdefault(side, [])
            states.append(self._states(words @ w[f"W{side}"] + w[f"c{side}"], side, steps))
        both = np.concatenate(states, axis=2)
        look = np.tanh(both @ w["A"] + w["a"])
        score = look @ w["v"]
        share = np.exp(score - score.max(axis=0))
        share /= share.sum(axis=0)
        pooled = np.einsum("tn,tnk->nk", share, both)
        if kept is not None:
            kept |= {"both": both, "look": look, "share": share, "pooled": pooled}
        return pooled @ w["o"] + w["d"][0]

    def gradients(self, words: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray], np.ndarray]:
        """Weighted mean cross-entropy, its gradients back through time, and its gradient at the word vectors."""
        w, h, kept = self.weights, self.hidden, {}
        logit = self.forward(words, kept)
        p = _sigmoid(logit)
        loss = float((weight * (np.logaddexp(0, logit) - labels * logit)).mean())
        g: dict[str, np.ndarray] = {}
        out = (weight * (p - labels) / len(labels)).astype(np.float32)
        both, look, share = kept["both"], kept["look"], kept["share"]
        g["o"], g["d"] = kept["pooled"].T @ out, np.array([out.sum()], np.float32)
        pooled = out[:, None] * w["o"]
        grad = share[:, :, None] * pooled
        to_share = np.einsum("nk,tnk->tn", pooled, both)
        to_score = share * (to_share - (share * to_share).sum(axis=0))
        g["v"] = np.einsum("tn,tnk->k", to_score, look)
        to_look = to_score[:, :, None] * w["v"] * (1 - look**2)
        g["A"], g["a"] = np.einsum("tni,tnj->ij", both, to_look), to_look.sum(axis=(0, 1))
        grad = grad + to_look @ w["A"].T
        to_words = np.zeros_like(words)
        for side, part in (("f", grad[:, :, :h]), ("b", grad[:, :, h:])):
            u = w[f"U{side}"]
            to_x = np.empty((*words.shape[:2], 3 * h), np.float32)
            g[f"U{side}"] = np.zeros_like(u)
            later = np.zeros((words.shape[1], h), np.float32)
            for t, state, own, update, reset, candidate in reversed(kept[side]):
                total = part[t] + later
                to_candidate = total * (1 - update) * (1 - candidate**2)
                to_update = total * (state - candidate) * update * (1 - update)
                to_reset = to_candidate * own * reset * (1 - reset)
                to_own = np.concatenate([to_update, to_reset, to_candidate * reset], axis=1)
                to_x[t] = np.concatenate([to_update, to_reset, to_candidate], axis=1)
                g[f"U{side}"] += state.T @ to_own
                later = total * update + to_own @ u.T
            g[f"W{side}"], g[f"c{side}"] = np.einsum("tni,tnj->ij", words, to_x), to_x.sum(axis=(0, 1))
            to_words += to_x @ w[f"W{side}"].T
        return loss, g, to_words

    def fit(self, words: np.ndarray, labels: np.ndarray, weight: np.ndarray, learned: WordInputs, tokens: np.ndarray,
            epochs: int = 8, batch: int = 256, rate: float = 0.01, drop: float = 0.25) -> list[float]:
        """Adam over shuffled batches; returns the loss of each epoch.

        ``words`` is window, time, given input; ``tokens`` numbers the same words for ``learned``, whose
        inputs follow the given ones. A share ``drop`` of words does without them in each batch.
        """
        random, losses = np.random.default_rng(self.seed), []
        owners = {k: store for store in (self.weights, learned.weights) for k in store}
        first, second = ({k: np.zeros_like(store[k]) for k, store in owners.items()} for _ in range(2))
        step, given = 0, words.shape[2]
        for epoch in range(epochs):
            order, seen = random.permutation(len(labels)), []
            for at in range(0, len(order), batch):
                rows = order[at : at + batch]
                used, own = np.unique(tokens[rows].T, return_inverse=True)
                own = own.reshape(tokens.shape[1], len(rows))
                kept = (random.random(own.shape) >= drop).astype(np.float32)[:, :, None]
                x = np.concatenate([words[rows].transpose(1, 0, 2), learned.vectors(used)[own] * kept], axis=2)
                loss, g, to_words = self.gradients(x, labels[rows], weight[rows])
                g |= learned.gradients(used, own, to_words[:, :, given:] * kept)
                seen.append(loss)
                norm = float(np.sqrt(sum(float((x**2).sum()) for x in g.values())))
                clip, step = min(1.0, 1.0 / (norm + 1e-9)), step + 1
                speed = rate * 0.5 ** (epoch / 4) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for k, x in g.items():
                    x = x * clip
                    first[k] = 0.9 * first[k] + 0.1 * x
                    second[k] = 0.999 * second[k] + 0.001 * x**2
                    owners[k][k] = (owners[k][k] - speed * first[k] / (np.sqrt(second[k]) + 1e-8)).astype(np.float32)
            losses.append(sum(seen) / max(1, len(seen)))
        return losses
