"""A small causal self-attention language model over subword ids, in numpy.

The next id is predicted in two steps: its class, by attention, and the id within its class, by
counts over a whole corpus (which are not part of this module). Logits of the class are a table
row for the class of the current id plus a projection of what attention gathers from the ids of
the window; attention weights are products of queries and keys plus a bias for the distance.

Texts are laid out in chunks. A window is a chunk and the one before it: queries are the ids of
the chunk, keys all ids of the window up to the query's own. Each id is predicted once, with at
least a chunk of context where the text has it.
"""

import numpy as np

CHUNK = 16
INPUTS = 1024  # ids with an embedding of their own; rarer ones share that of their class
SIZE = 8
CLASSES = 64
REACH = 6.0  # longest query and key, and largest weight of a distance
_FAR = np.float32(-1e9)


def clusters(beside: np.ndarray, counts: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Groups of ids that stand in like contexts: k-means on the directions of what stands beside them,
    a row for each id, weighted by their counts."""
    found = beside / (np.linalg.norm(beside, axis=1, keepdims=True) + 1e-6)
    centres = found[np.argsort(-counts, kind="stable")[:k]].copy()
    for _ in range(rounds):
        group = (found @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, group, found * counts[:, None])
        sizes = np.linalg.norm(sums, axis=1)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return (found @ centres.T).argmax(1)


class Attention:
    """``inputs``: embedding number of every id; ``classes``: class of every id. Classes from
    ``first_start`` on are those of ids that start a word, and of the end.

    Ids are 0 to vocabulary - 1; ``vocabulary`` is the end of a text and ``vocabulary + 1`` what
    stands before its first id and in padding.
    """

    def __init__(self, inputs: np.ndarray, classes: np.ndarray, n_classes: int, first_start: int = 0, size: int = SIZE, seed: int = 9):
        rng = np.random.default_rng(seed)
        n = int(inputs.max()) + 1
        small = lambda *shape: (rng.normal(size=shape) * 0.3).astype(np.float32)
        self.inputs, self.classes, self.first_start = inputs, classes, first_start
        self.start = len(inputs) - 1
        self.weights = {
            "query": small(n, size),
            "key": small(n, size),
            "value": small(n, size),
            "out": small(size, n_classes),
            "table": np.zeros((n_classes, n_classes), dtype=np.float32),
            "distance": np.zeros(2 * CHUNK, dtype=np.float32),
        }

    def chunked(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Texts (each from one of ``starts`` on, with its end) as rows of chunks.

        Returns what is read and what is to be predicted, row by row (-1: nothing), which rows hold
        queries, and the text of each row. Each text has a row of padding before it.
        """
        lengths = np.diff(np.append(starts, len(ids)))
        rows = -(-lengths // CHUNK) + 1
        first = np.cumsum(rows) - rows
        place = np.repeat(first * CHUNK + CHUNK - starts, lengths) + np.arange(len(ids))
        read = np.full(int(rows.sum()) * CHUNK, self.start, dtype=np.int64)
        wanted = np.full(len(read), -1, dtype=np.int64)
        wanted[place] = ids
        inner = np.ones(len(ids), dtype=bool)
        inner[starts + lengths - 1] = False
        read[place[inner] + 1] = ids[inner]
        text = np.repeat(np.arange(len(starts)), rows)
        asks = np.ones(len(text), dtype=bool)
        asks[first] = False
        return read.reshape(-1, CHUNK), wanted.reshape(-1, CHUNK), np.flatnonzero(asks), text

    def _bias(self) -> np.ndarray:
        """Weight by distance of query and key; keys after the query are out of reach."""
        gap = np.arange(CHUNK, 2 * CHUNK)[:, None] - np.arange(2 * CHUNK)[None, :]
        return np.where(gap >= 0, self.weights["distance"][np.maximum(gap, 0)], _FAR)

    def _forward(self, read: np.ndarray, rows: np.ndarray):
        w = self.weights
        number = self.inputs[read]
        window = np.concatenate((number[rows - 1], number[rows]), axis=1)
        own = number[rows]
        query, key, value = w["query"][own], w["key"][window], w["value"][window]
        scores = np.matmul(query, key.transpose(0, 2, 1))
        scores += self._bias()
        # Padding is out of reach, but for the mark right before a text's first id: its own query.
        blank = np.concatenate((read[rows - 1], read[rows]), axis=1) == self.start
        if blank.any():
            touched = np.flatnonzero(blank.any(1))
            reach = np.where(blank[touched][:, None, :], _FAR, np.float32(0))
            reach = reach * (np.arange(2 * CHUNK)[None, None, :] != np.arange(CHUNK, 2 * CHUNK)[None, :, None])
            scores[touched] += reach
        chances = np.exp(scores, out=scores)
        chances /= chances.sum(axis=2, keepdims=True)
        gathered = np.matmul(chances, value)
        logits = np.matmul(gathered, w["out"])
        logits += w["table"][self.classes[read[rows]]]
        return own, window, query, key, value, chances, gathered, logits

    def log_chances(self, ids: np.ndarray, starts: np.ndarray, at_once: int = 128) -> tuple[np.ndarray, np.ndarray]:
        """Natural logs for every id of its class's probability, and of that of a new word there.

        As ``_forward``, in fewer passes: what attention gathers is divided by the sum of its weights, not
        these, and sums over classes are one product. ``at_once`` rows stay in a core's cache.
        """
        w = self.weights
        size, n_classes, kind = w["value"].shape[1], len(w["table"]), w["table"].dtype
        sums = np.ones((n_classes, 2), dtype=kind)
        sums[: self.first_start, 1] = 0
        one, bias = np.ones(2 * CHUNK, dtype=kind), self._bias()
        read, wanted, rows, _ = self.chunked(ids, starts)
        number, classes = self.inputs.take(read), self.classes.take(read)
        blank = (read == self.start).any(axis=1)
        aims = self.classes[wanted]
        of_class, of_start = (np.zeros(wanted.shape, dtype=np.float32) for _ in range(2))
        first = np.arange(at_once * CHUNK) * n_classes
        for i in range(0, len(rows), at_once):
            part = rows[i : i + at_once]
            window, touched, unseen = self._windows(read, number, blank, part)
            chances = np.matmul(w["query"].take(window[:, CHUNK:], axis=0), w["key"].take(window, axis=0).transpose(0, 2, 1))
            chances += bias
            chances[touched] += unseen
            np.exp(chances, out=chances)
            gathered = np.matmul(chances, w["value"].take(window, axis=0)).reshape(-1, size)
            gathered /= (chances.reshape(-1, 2 * CHUNK) @ one)[:, None]
            odds = w["table"].take(classes.take(part, axis=0).reshape(-1), axis=0)
            odds += gathered @ w["out"]
            hit = odds.reshape(-1).take(first[: len(odds)] + aims.take(part, axis=0).reshape(-1))
            np.exp(odds, out=odds)
            totals = np.log(odds @ sums)
            of_class[part] = (hit - totals[:, 0]).reshape(-1, CHUNK)
            of_start[part] = (totals[:, 1] - totals[:, 0]).reshape(-1, CHUNK)
        real = wanted.ravel() >= 0
        return of_class.ravel()[real], of_start.ravel()[real]

    def _loss(self, read: np.ndarray, wanted: np.ndarray, rows: np.ndarray):
        w = self.weights
        own, window, query, key, value, chances, gathered, logits = self._forward(read, rows)
        target = wanted[rows]
        real = target >= 0
        n = max(int(real.sum()), 1)
        aim = self.classes[np.where(real, target, 0)]
        logits -= logits.max(axis=2, keepdims=True)
        hit = np.take_along_axis(logits, aim[:, :, None], axis=2)[:, :, 0]
        np.exp(logits, out=logits)
        total = logits.sum(axis=2)
        loss = float(((np.log(total) - hit) * real).sum()) / n
        d_logits = logits / total[:, :, None]
        np.put_along_axis(d_logits, aim[:, :, None], np.take_along_axis(d_logits, aim[:, :, None], axis=2) - 1, axis=2)
        d_logits *= (real / n)[:, :, None].astype(np.float32)
        grads = {k: np.zeros_like(v) for k, v in w.items()}
        np.add.at(grads["table"], self.classes[read[rows]].ravel(), d_logits.reshape(-1, d_logits.shape[2]))
        grads["out"] = np.tensordot(gathered, d_logits, ((0, 1), (0, 1)))
        d_gathered = d_logits @ w["out"].T
        d_value = np.matmul(chances.transpose(0, 2, 1), d_gathered)
        d_chances = np.matmul(d_gathered, value.transpose(0, 2, 1))
        d_scores = chances * (d_chances - (d_chances * chances).sum(axis=2, keepdims=True))
        d_query = np.matmul(d_scores, key)
        d_key = np.matmul(d_scores.transpose(0, 2, 1), query)
        size = query.shape[2]
        np.add.at(grads["query"], own.ravel(), d_query.reshape(-1, size))
        np.add.at(grads["key"], window.ravel(), d_key.reshape(-1, size))
        np.add.at(grads["value"], window.ravel(), d_value.reshape(-1, size))
        gap = np.arange(CHUNK, 2 * CHUNK)[:, None] - np.arange(2 * CHUNK)[None, :]
        by_gap = d_scores.sum(axis=0)
        np.add.at(grads["distance"], gap[gap >= 0], by_gap[gap >= 0])
        return loss, grads

    def _windows(self, read: np.ndarray, number: np.ndarray, blank: np.ndarray, rows: np.ndarray):
        """Inputs of the windows of rows, the rows whose window holds padding, and what to add to their scores."""
        window = np.concatenate((number.take(rows - 1, axis=0), number.take(rows, axis=0)), axis=1)
        touched = np.flatnonzero(blank[rows - 1] | blank[rows])
        these = rows[touched]
        empty = np.concatenate((read[these - 1], read[these]), axis=1) == self.start
        own_reach = np.arange(2 * CHUNK)[None, :] != np.arange(CHUNK, 2 * CHUNK)[:, None]
        return window, touched, np.where(empty[:, None, :] & own_reach, _FAR, np.float32(0))

    def _sums(
        self, read: np.ndarray, number: np.ndarray, aims: np.ndarray, real: np.ndarray, blank: np.ndarray, rows: np.ndarray, at_once: int = 128
    ) -> dict:
        """What ``_loss`` has as gradients, but for the table, summed up over places, in fewer passes.

        ``number``, ``aims`` and ``real`` hold the input of each place, the class to be predicted and
        whether there is one, ``blank`` which rows hold padding. Chances of keys and classes are not
        divided by their sums: what they are multiplied with is, which is narrower. ``at_once`` rows
        are worked on at a time.
        """
        w = self.weights
        (n, size), n_classes, kind = w["value"].shape, len(w["table"]), w["value"].dtype
        sums = {k: np.zeros(v.shape, dtype=kind) for k, v in w.items() if k != "table"}
        cells = np.arange(n * size).reshape(n, size)
        back = np.ascontiguousarray(w["out"].T)
        ones = np.ones(max(2 * CHUNK, n_classes, at_once), dtype=kind)
        bias, by_place = self._bias(), np.zeros(2 * CHUNK * CHUNK, dtype=kind)
        windows, touched, unseen = self._windows(read, number, blank, rows)
        classes = self.classes.take(read.take(rows, axis=0))
        hits = np.arange(len(rows) * CHUNK).reshape(-1, CHUNK) % (at_once * CHUNK) * n_classes + aims.take(rows, axis=0)
        asked = real.take(rows, axis=0).astype(kind)
        for i in range(0, len(rows), at_once):
            window = windows[i : i + at_once]
            query, key, value = w["query"].take(window[:, CHUNK:], axis=0), w["key"].take(window, axis=0), w["value"].take(window, axis=0)
            chances = np.matmul(query, key.transpose(0, 2, 1))
            chances += bias
            low, high = np.searchsorted(touched, (i, i + at_once))
            chances[touched[low:high] - i] += unseen[low:high]
            np.exp(chances, out=chances)
            share = (1 / (chances.reshape(-1, 2 * CHUNK) @ ones[: 2 * CHUNK]))[:, None]
            gathered = np.matmul(chances, value).reshape(-1, size)
            gathered *= share
            odds = w["table"].take(classes[i : i + at_once].reshape(-1), axis=0)
            odds += gathered @ w["out"]
            np.exp(odds, out=odds)
            total = odds @ ones[:n_classes]
            odds.reshape(-1)[hits[i : i + at_once].reshape(-1)] -= total
            weight = (asked[i : i + at_once].reshape(-1) / total)[:, None]
            d_gathered = odds @ back
            d_gathered *= weight * share
            weight = gathered * weight
            sums["out"] += (odds.T @ weight).T
            inner = np.einsum("nk,nk->n", d_gathered, gathered).reshape(-1, CHUNK, 1)
            d_gathered = d_gathered.reshape(-1, CHUNK, size)
            d_scores = np.matmul(d_gathered, value.transpose(0, 2, 1))
            d_scores -= inner
            d_scores *= chances
            by_place += ones[: len(window)] @ d_scores.reshape(len(window), -1)
            at = cells.take(window, axis=0)
            np.add.at(sums["query"].reshape(-1), at[:, CHUNK:].reshape(-1), np.matmul(d_scores, key).reshape(-1))
            at = at.reshape(-1)
            np.add.at(sums["key"].reshape(-1), at, np.matmul(d_scores.transpose(0, 2, 1), query).reshape(-1))
            np.add.at(sums["value"].reshape(-1), at, np.matmul(chances.transpose(0, 2, 1), d_gathered).reshape(-1))
        gap = np.arange(CHUNK, 2 * CHUNK)[:, None] - np.arange(2 * CHUNK)[None, :]
        sums["distance"] += np.bincount(gap[gap >= 0], by_place.reshape(gap.shape)[gap >= 0], 2 * CHUNK)
        return sums

    def learn(self, texts, n_ids: int, batch: int = 512, at_once: int = 128, rate: float = 0.02, seed: int = 3) -> int:
        """Go on from the weights as they are, once over groups of texts (ids and starts) that hold
        about ``n_ids`` ids in all; returns how many places were learned from."""
        rng, state, done = np.random.default_rng(seed), self._state(), 0
        for ids, starts in texts:
            read, wanted, rows, _ = self.chunked(ids, starts)
            number, real = self.inputs[read], wanted >= 0
            aims, blank = self.classes[np.where(real, wanted, 0)], (read == self.start).any(axis=1)
            rows = rng.permutation(rows)
            # Batches of a group are about equal: a small rest would weigh as much as a whole batch.
            for some in np.array_split(rows, max(1, round(len(rows) / batch))):
                n = int(real[some].sum())
                grads = {k: v / n for k, v in self._sums(read, number, aims, real, blank, some, at_once).items()}
                self._step(grads, state, rate * (1.02 - min(done / n_ids, 1)))
                done += n
        return done

    def _state(self) -> dict:
        zeros = lambda: {k: np.zeros_like(v) for k, v in self.weights.items() if k != "table"}
        return {"mean": zeros(), "square": zeros(), "step": 0}

    def _step(self, grads: dict, state: dict, now: float) -> None:
        """One step of Adam on all weights but the table."""
        mean, square = state["mean"], state["square"]
        state["step"] = step = state["step"] + 1
        for k in mean:
            g = grads[k]
            mean[k] *= 0.9
            mean[k] += 0.1 * g
            square[k] *= 0.999
            square[k] += 0.001 * g * g
            change, spread = mean[k] / (1 - 0.9**step), square[k] / (1 - 0.999**step)
            change *= now
            np.sqrt(spread, out=spread)
            spread += 1e-8
            change /= spread
            self.weights[k] -= change
        # Products of queries and keys stay in a range that needs no care in exponentials.
        for k in ("query", "key"):
            length = np.linalg.norm(self.weights[k], axis=1, keepdims=True)
            self.weights[k] *= np.minimum(1, REACH / np.maximum(length, 1e-6))
        np.clip(self.weights["distance"], -REACH, REACH, out=self.weights["distance"])

    def fit(self, ids: np.ndarray, starts: np.ndarray, pairs: np.ndarray, steps: int = 400, batch: int = 128, rate: float = 0.05, seed: int = 2):
        """Adam over batches of rows in random order; returns the losses.

        ``pairs`` counts which class follows which; the table is their smoothed log shares and stays so.
        """
        read, wanted, rows, _ = self.chunked(ids, starts)
        whole = pairs.sum(axis=0) + 1
        pair = pairs + 5 * whole / whole.sum()
        self.weights["table"] = np.log(pair / pair.sum(axis=1, keepdims=True)).astype(np.float32)
        rng = np.random.default_rng(seed)
        state = self._state()
        losses, order = [], rows[:0]
        for step in range(1, steps + 1):
            if len(order) < min(batch, len(rows)):
                order = rng.permutation(rows)
            some, order = order[:batch], order[batch:]
            loss, grads = self._loss(read, wanted, some)
            losses.append(loss)
            self._step(grads, state, rate * (1.02 - step / steps))
        return losses
