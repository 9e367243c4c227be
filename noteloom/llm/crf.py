"""A character-level bidirectional LSTM with CRF transitions, in numpy.

``Tagger.fit`` minimises the negative log-likelihood of tag paths by Adam; ``Tagger.emissions``
gives the scores of every tag at every character of a batch of windows; ``viterbi`` and
``marginals`` decode paths over scores of any length.
"""

import numpy as np

PAD = 0
# Printable ASCII one by one, then line breaks, other letters, and the rest.
ALPHABET = 100


def char_ids(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    ids = np.where((points >= 32) & (points < 127), points - 31, 98)
    ids[points == 10] = 96
    letters = points > 127
    if letters.any():
        ids[letters] = [97 if chr(p).isalpha() else 98 for p in points[letters].tolist()]
    return ids


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tagger:
    def __init__(self, tags: int, size: int = 10, hidden: int = 20, seed: int = 1):
        rng = np.random.default_rng(seed)
        scale = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.hidden, self.tags = hidden, tags
        self.weights = {"embed": 0.5 * rng.normal(size=(ALPHABET, size)).astype(np.float32)}
        for side in ("f", "b"):
            self.weights[f"{side}_in"] = scale(size, 4 * hidden)
            self.weights[f"{side}_rec"] = scale(hidden, 4 * hidden)
            bias = np.zeros(4 * hidden, dtype=np.float32)
            bias[hidden : 2 * hidden] = 1  # remember at first
            self.weights[f"{side}_bias"] = bias
        self.weights["out"] = scale(2 * hidden, tags)
        self.weights["out_bias"] = np.zeros(tags, dtype=np.float32)
        self.weights["trans"] = np.zeros((tags, tags), dtype=np.float32)
        self.weights["first"] = np.zeros(tags, dtype=np.float32)

    # --- forward ----------------------------------------------------------------------

    def _run(self, ids: np.ndarray, side: str, keep: bool):
        """Hidden states of one direction; windows that are shorter end in padding, which is skipped."""
        w, h = self.weights, self.hidden
        batch, length = ids.shape
        table = w["embed"] @ w[f"{side}_in"] + w[f"{side}_bias"]
        state = np.zeros((batch, h), dtype=np.float32)
        cell = np.zeros((batch, h), dtype=np.float32)
        out = np.zeros((length, batch, h), dtype=np.float32)
        trace = []
        for t in range(length) if side == "f" else range(length - 1, -1, -1):
            gates = table[ids[:, t]] + state @ w[f"{side}_rec"]
            i, f, o = (_sigmoid(gates[:, k * h : (k + 1) * h]) for k in range(3))
            g = np.tanh(gates[:, 3 * h :])
            live = (ids[:, t] != PAD)[:, None]
            new_cell = np.where(live, f * cell + i * g, cell)
            squashed = np.tanh(new_cell)
            new_state = np.where(live, o * squashed, state)
            if keep:
                trace.append((t, i, f, o, g, cell, squashed, state, live))
            state, cell = new_state, new_cell
            out[t] = state
        return out, trace

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """(windows, characters, tags) scores."""
        both = np.concatenate((self._run(ids, "f", False)[0], self._run(ids, "b", False)[0]), axis=2)
        return (both @ self.weights["out"] + self.weights["out_bias"]).transpose(1, 0, 2)

    # --- training ---------------------------------------------------------------------

    def _loss(self, ids: np.ndarray, tags: np.ndarray):
        """Mean loss of the batch and the gradients of all weights."""
        w, h = self.weights, self.hidden
        batch, length = ids.shape
        forward, f_trace = self._run(ids, "f", True)
        backward, b_trace = self._run(ids, "b", True)
        both = np.concatenate((forward, backward), axis=2)
        scores = both @ w["out"] + w["out_bias"]
        live = (ids != PAD).T
        grads = {k: np.zeros_like(v) for k, v in w.items()}

        # Forward-backward over the chain gives the expected tags and transitions.
        trans = w["trans"]
        alpha = np.empty_like(scores)
        alpha[0] = w["first"] + scores[0]
        for t in range(1, length):
            step = _logsum(alpha[t - 1][:, :, None] + trans[None], 1) + scores[t]
            alpha[t] = np.where(live[t][:, None], step, alpha[t - 1])
        total = _logsum(alpha[-1], 1)
        beta = np.zeros_like(scores)
        for t in range(length - 2, -1, -1):
            step = _logsum(trans[None] + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
            beta[t] = np.where(live[t + 1][:, None], step, beta[t + 1])
        d_scores = np.exp(alpha + beta - total[None, :, None]) * live[:, :, None]
        rows = np.arange(batch)
        gold = w["first"][tags[:, 0]] + scores[0][rows, tags[:, 0]]
        grads["first"] += d_scores[0].sum(0)
        np.subtract.at(grads["first"], tags[:, 0], 1)
        for t in range(length):
            on = live[t]
            d_scores[t][rows[on], tags[on, t]] -= 1
            if t:
                joint = alpha[t - 1][:, :, None] + trans[None] + (scores[t] + beta[t])[:, None, :] - total[:, None, None]
                grads["trans"] += (np.exp(joint) * on[:, None, None]).sum(0)
                np.subtract.at(grads["trans"], (tags[on, t - 1], tags[on, t]), 1)
                gold = gold + np.where(on, trans[tags[:, t - 1], tags[:, t]] + scores[t][rows, tags[:, t]], 0)
        grads["out"] += np.tensordot(both, d_scores, ((0, 1), (0, 1)))
        grads["out_bias"] += d_scores.sum((0, 1))
        d_both = d_scores @ w["out"].T

        for side, trace, d_out in (("f", f_trace, d_both[:, :, :h]), ("b", b_trace, d_both[:, :, h:])):
            d_state = np.zeros((batch, h), dtype=np.float32)
            d_cell = np.zeros((batch, h), dtype=np.float32)
            d_table = np.zeros((ALPHABET, 4 * h), dtype=np.float32)
            for t, i, f, o, g, cell, squashed, state, on in reversed(trace):
                d_state = d_state + d_out[t]
                ds = np.where(on, d_state, 0)
                dc = np.where(on, d_cell, 0) + ds * o * (1 - squashed**2)
                d_gates = np.concatenate(
                    (dc * g * i * (1 - i), dc * cell * f * (1 - f), ds * squashed * o * (1 - o), dc * i * (1 - g**2)), axis=1
                )
                grads[f"{side}_rec"] += state.T @ d_gates
                np.add.at(d_table, ids[:, t], d_gates)
                d_state = np.where(on, d_gates @ w[f"{side}_rec"].T, d_state)
                d_cell = np.where(on, dc * f, d_cell)
            grads[f"{side}_bias"] += d_table.sum(0)
            grads[f"{side}_in"] += w["embed"].T @ d_table
            grads["embed"] += d_table @ w[f"{side}_in"].T
        return float((total - gold).mean()), {k: g / batch for k, g in grads.items()}

    def fit(self, ids: np.ndarray, tags: np.ndarray, steps: int = 300, batch: int = 64, rate: float = 0.02, seed: int = 3, vary=None):
        """Train on windows (rows of ids, padded at the end) and their tags; returns the losses.

        ``steps`` batches are taken from the windows in random order, round after round.
        ``vary(rng, ids, tags)`` may give each batch other characters that fit the same tags.
        """
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        losses, order = [], np.empty(0, dtype=np.int64)
        for step in range(1, steps + 1):
            if len(order) < min(batch, len(ids)):
                order = rng.permutation(len(ids))
            rows, order = order[:batch], order[batch:]
            seen = ids[rows] if vary is None else vary(rng, ids[rows], tags[rows])
            loss, grads = self._loss(seen, tags[rows])
            losses.append(loss)
            size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            shrink = min(1.0, 5.0 / (size + 1e-9))
            now = rate * (1.05 - step / steps)
            for k, g in grads.items():
                g = g * shrink
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                self.weights[k] -= now * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
        return losses


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def viterbi(scores: np.ndarray, live: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """The best tag path of every row of (rows, characters, tags) scores; ``live`` marks characters."""
    rows, length, tags = scores.shape
    best = first + scores[:, 0]
    back = np.empty((length, rows, tags), dtype=np.int8)
    for t in range(1, length):
        ways = best[:, :, None] + trans[None]
        on = live[:, t, None]
        back[t] = np.where(on, ways.argmax(1), np.arange(tags)[None])
        best = np.where(on, ways.max(1) + scores[:, t], best)
    path = np.empty((rows, length), dtype=np.int8)
    path[:, -1] = best.argmax(1)
    for t in range(length - 1, 0, -1):
        path[:, t - 1] = back[t, np.arange(rows), path[:, t]]
    return path


def marginals(scores: np.ndarray, live: np.ndarray, first: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Probability of every tag at every character, in the shape of ``scores``."""
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[:, 0] = first + scores[:, 0]
    for t in range(1, scores.shape[1]):
        step = _logsum(alpha[:, t - 1, :, None] + trans[None], 1) + scores[:, t]
        alpha[:, t] = np.where(live[:, t, None], step, alpha[:, t - 1])
    for t in range(scores.shape[1] - 2, -1, -1):
        step = _logsum(trans[None] + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        beta[:, t] = np.where(live[:, t + 1, None], step, beta[:, t + 1])
    return np.exp(alpha + beta - _logsum(alpha[:, -1], 1)[:, None, None])
