"""A gated recurrent language model in numpy with a class-factored output softmax.

Words are numbered by falling frequency.  Number k < size is word k % WIDTH of class
k // WIDTH; the number ``size`` stands for any other word and is a class of its own.
The probability of a word is that of its class times that of the word in the class.

Texts run in lanes: a lane holds several texts one after another, the state is set to
zero where one starts and is carried on over all windows until it ends, so a text's
log-likelihood is that of the whole text.  Backpropagation is truncated to a window.

States and gates of a step have shape (lanes, features) and lie feature by feature, so that
a gate's part of them is one run of memory; the output layer works on rows, a block of them
that fits the cache at a time.
"""

from __future__ import annotations

import heapq

import numpy as np

WIDTH = 64
EMBED, HIDDEN, WINDOW = 16, 24, 16
#: States that meet the output weights together.
BLOCK = 1024


class Lanes:
    """Texts (arrays of word numbers) laid end to end in lanes of falling length.

    Cells are kept step by step, each step having the lanes that are not over, so they
    are as many as words however long one text is."""

    def __init__(self, texts: list[np.ndarray], lanes: int, start: int):
        self.start = start
        lanes = max(1, min(lanes, len(texts)))
        free = [(0, lane) for lane in range(lanes)]
        filled: list[list[int]] = [[] for _ in range(lanes)]
        for k in sorted(range(len(texts)), key=lambda k: -len(texts[k])):
            total, lane = free[0]
            filled[lane].append(k)
            heapq.heapreplace(free, (total + len(texts[k]), lane))
        total = np.array([n for n, _ in sorted(free, key=lambda x: x[1])])
        by_length = np.argsort(-total, kind="stable")
        self.lengths = total[by_length]
        steps = int(self.lengths.max(initial=0))
        # Lanes that are longer than t, for each step t.
        self.active = np.searchsorted(-self.lengths, -np.arange(steps), "left")
        self.offsets = np.concatenate([[0], np.cumsum(self.active)])
        cells = int(self.offsets[-1])
        self.target, self.given, self.text = (np.zeros(cells, np.int32) for _ in range(3))
        for lane, k in enumerate(by_length):
            own = filled[k]
            if not own or not total[k]:
                continue
            at = self.offsets[: total[k]] + lane
            words = np.concatenate([texts[t] for t in own])
            sizes = np.array([len(texts[t]) for t in own])
            before = np.concatenate([[start], words[:-1]])
            before[(np.cumsum(sizes) - sizes)[sizes > 0]] = start
            self.target[at], self.given[at], self.text[at] = words, before, np.repeat(own, sizes)

    def step(self, t: int) -> slice:
        """The cells of a step; the lanes are those of the step before, from the first on."""
        return slice(self.offsets[t], self.offsets[t + 1])

    def window(self, begin: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(given, target, live) of some steps as rectangles."""
        shape = (end - begin, int(self.active[begin]))
        given, target, live = np.full(shape, self.start, np.int32), np.zeros(shape, np.int32), np.zeros(shape, bool)
        for t in range(begin, end):
            n = int(self.active[t])
            given[t - begin, :n], target[t - begin, :n], live[t - begin, :n] = self.given[self.step(t)], self.target[self.step(t)], True
        return given, target, live


def _shift(logits: np.ndarray) -> None:
    """Subtract each row's largest where exponentials could overflow; shares stay the same."""
    if logits.size and logits.max() > 60:
        logits -= logits.max(1, keepdims=True)


class RecurrentModel:
    def __init__(self, counts: np.ndarray, other: float, seed: int = 1):
        """``counts``: smoothed counts of the numbered words; ``other``: that of all others."""
        rng = np.random.default_rng(seed)
        small = lambda *s: (rng.standard_normal(s) * 0.1).astype(np.float32)
        self.size = len(counts)
        self.classes = -(-self.size // WIDTH)
        mass = np.zeros((self.classes, WIDTH))
        mass.reshape(-1)[: self.size] = counts
        by_class = np.concatenate([mass.sum(1), [max(other, 1e-9)]])
        with np.errstate(divide="ignore", invalid="ignore"):
            words = np.log(mass / mass.sum(1, keepdims=True))
        # The biases alone are the unigram model, which training starts from.
        self.p = {
            "embed": small(self.size + 2, EMBED), "input": small(EMBED, 3 * HIDDEN), "gate_b": np.zeros(3 * HIDDEN, np.float32), "state": small(HIDDEN, 3 * HIDDEN),
            "class": np.zeros((HIDDEN, self.classes + 1), np.float32), "class_b": np.log(by_class / by_class.sum()).astype(np.float32),
            "word": np.zeros((self.classes, HIDDEN, WIDTH), np.float32), "word_b": np.maximum(words, -1e4).astype(np.float32),
        }

    @property
    def start(self) -> int:
        return self.size + 1

    # One step of the gates, for the lanes' states h and the inputs' part x of the gates.
    def _step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        u = (self.p["state"].T @ h.T).T
        zr = u[:, : 2 * HIDDEN] + x[:, : 2 * HIDDEN]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r, own = zr[:, :HIDDEN], zr[:, HIDDEN:], u[:, 2 * HIDDEN :]
        n = r * own
        n += x[:, 2 * HIDDEN :]
        np.tanh(n, out=n)
        after = h - n
        after *= z
        after += n
        return after, z, r, n, own

    def _class_of(self, target: np.ndarray) -> np.ndarray:
        return np.where(target == self.size, self.classes, target // WIDTH)

    @staticmethod
    def _own_log(h: np.ndarray, weights: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Log-softmax at ``own``; the last of the weights' rows is the bias, of h's columns 1."""
        logits = h @ weights
        _shift(logits)
        value = logits[np.arange(len(h)), own]
        np.exp(logits, out=logits)
        return value - np.log(logits @ np.ones(logits.shape[1], logits.dtype))

    def _by_class(self, target: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
        """The rows of numbered words ordered by class, and each class' place in that order."""
        kind = self._class_of(target)
        order = np.argsort(kind.astype(np.int16) if self.classes < 2**15 else kind, kind="stable")
        ends = np.cumsum(np.bincount(kind, minlength=self.classes + 1)[: self.classes]).tolist()
        parts = [(c, slice(begin, end)) for c, (begin, end) in enumerate(zip([0, *ends], ends)) if end > begin]
        return order[: ends[-1] if ends else 0], parts

    def log_probabilities(self, h: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Natural logarithms of the targets' probabilities in states ``h``."""
        out = np.empty(len(h), h.dtype)
        h = np.concatenate([h, np.ones((len(h), 1), h.dtype)], 1)
        classes = np.vstack([self.p["class"], self.p["class_b"]])
        kind = self._class_of(target)
        for at in range(0, len(h), BLOCK):  # blocks that stay in the cache
            part = slice(at, at + BLOCK)
            out[part] = self._own_log(h[part], classes, kind[part])
        known, parts = self._by_class(target)
        for c, own in parts:
            words = np.vstack([self.p["word"][c], self.p["word_b"][c]])
            for at in range(own.start, own.stop, BLOCK):
                part = known[at : min(at + BLOCK, own.stop)]
                out[part] += self._own_log(h[part], words, target[part] % WIDTH)
        return out

    def _begun(self, h: np.ndarray, given: np.ndarray) -> np.ndarray:
        """The states, zero where a text starts."""
        going = given != self.start
        return h if going.all() else h * going[:, None]

    def score(self, texts: list[np.ndarray], lanes: int = 384) -> np.ndarray:
        """Natural log-likelihood of each whole text."""
        total = np.zeros(len(texts))
        if not texts:
            return total
        laid = Lanes(texts, lanes, self.start)
        embed, inputs = self._inputs()
        h = np.zeros((len(laid.lengths), HIDDEN), np.float32, order="F")
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def flush() -> None:
            if held:
                states, target, text = (np.concatenate(x) for x in zip(*held, strict=True))
                total[:] += np.bincount(text, self.log_probabilities(np.ascontiguousarray(states), target), len(total))
                held.clear()

        size = 0
        for t in range(len(laid.active)):
            cells = laid.step(t)
            given = laid.given[cells]
            h = self._step((inputs @ embed.take(given, axis=0).T).T, self._begun(h[: len(given)], given))[0]
            held.append((h, laid.target[cells], laid.text[cells]))
            size += len(given)
            if size > 40_000:
                flush()
                size = 0
        flush()
        return total

    def _inputs(self) -> tuple[np.ndarray, np.ndarray]:
        """The words' vectors, with a 1 for the bias, and what makes the gates' part of them."""
        p = self.p
        return np.hstack([p["embed"], np.ones((len(p["embed"]), 1), p["embed"].dtype)]), np.vstack([p["input"], p["gate_b"]]).T

    def _forward(self, given: np.ndarray, h: np.ndarray) -> tuple[list, np.ndarray, np.ndarray]:
        """What the gates were at each step of a (steps, lanes) window, all states, the last."""
        embed, inputs = self._inputs()
        cache, states = [], []
        for words in given:
            vectors = embed.take(words, axis=0).T
            before = self._begun(h, words)
            h, z, r, n, u = self._step((inputs @ vectors).T, before)
            cache.append((vectors, before, z, r, n, u))
            states.append(h)
        return cache, np.ascontiguousarray(np.concatenate(states)), h

    def _output(self, flat: np.ndarray, aim: np.ndarray, weight: np.ndarray, g: dict[str, np.ndarray]) -> tuple[np.ndarray, float]:
        """The states' gradients and the loss; adds the output layer's gradients to ``g``."""
        p = self.p
        ones = np.ones(max(WIDTH, self.classes + 1), flat.dtype)
        states = np.concatenate([flat, np.ones((len(flat), 1), flat.dtype)], 1)  # 1 meets the bias
        back, loss = np.empty_like(flat), 0.0

        def shares_of(logits: np.ndarray, own: np.ndarray, weight: np.ndarray) -> float:
            """The loss; turns logits into its gradients."""
            _shift(logits)
            numbers = np.arange(len(own))
            value = logits[numbers, own]
            np.exp(logits, out=logits)
            total = logits @ ones[: logits.shape[1]]
            logits *= (weight / total)[:, None]
            logits[numbers, own] -= weight
            return -float((value - np.log(total)) @ weight)

        weights = np.vstack([p["class"], p["class_b"]])
        turned, moved, kind = np.ascontiguousarray(p["class"].T), np.zeros_like(weights), self._class_of(aim)
        for at in range(0, len(flat), BLOCK):
            part = slice(at, at + BLOCK)
            logits = states[part] @ weights
            loss += shares_of(logits, kind[part], weight[part])
            moved += states[part].T @ logits
            np.matmul(logits, turned, out=back[part])
        g["class"] += moved[:-1]
        g["class_b"] += moved[-1]
        # Rows side by side by class, so that only the products go class by class.
        known, parts = self._by_class(aim)
        if not parts:
            return back, loss
        own, weight, rows = aim[known] % WIDTH, weight[known], states[known]
        weights = np.concatenate([p["word"], p["word_b"][:, None]], 1)
        turned, moved, sums = p["word"].transpose(0, 2, 1), np.empty((len(known), HIDDEN), flat.dtype), np.zeros_like(weights)
        logits = np.empty((len(known), WIDTH), flat.dtype)
        first = 0
        while first < len(parts):  # whole classes, about a block of rows together
            last, begin = first, parts[first][1].start
            while last < len(parts) and (last == first or parts[last][1].stop - begin <= BLOCK):
                c, part = parts[last]
                np.matmul(rows[part], weights[c], out=logits[part])
                last += 1
            block = slice(begin, parts[last - 1][1].stop)
            loss += shares_of(logits[block], own[block], weight[block])
            for c, part in parts[first:last]:
                np.matmul(rows[part].T, logits[part], out=sums[c])
                np.matmul(logits[part], turned[c], out=moved[part])
            first = last
        g["word"] += sums[:, :-1]
        g["word_b"] += sums[:, -1]
        back[known] += moved
        return back, loss

    def _backward(self, given: np.ndarray, cache: list, back: np.ndarray, g: dict[str, np.ndarray]) -> None:
        """Adds the gradients of a window's gates and words to ``g``."""
        p, (steps, lanes) = self.p, given.shape
        back = np.ascontiguousarray(back.reshape(steps, lanes, HIDDEN).transpose(0, 2, 1))
        d = np.zeros((HIDDEN, lanes), back.dtype)
        # A step's gradients, feature by feature: the state's part of n, then the gates z and r, then n.
        # The first three parts meet the state's weights, the last three the words'.
        gates = np.empty((steps, 4 * HIDDEN, lanes), back.dtype)
        by_state = np.hstack([p["state"][:, 2 * HIDDEN :], p["state"][:, : 2 * HIDDEN]])
        to_state, to_input = np.zeros_like(by_state), np.zeros((EMBED + 1, 3 * HIDDEN), by_state.dtype)
        for t in reversed(range(steps)):
            vectors, *rest = cache[t]
            before, z, r, n, u = (x.T for x in rest)
            own, dz, dr, dn = gates[t].reshape(4, HIDDEN, lanes)
            d += back[t]
            kept = d * z
            np.subtract(d, kept, out=dn)
            np.subtract(before, n, out=dz)
            dz *= z
            dz *= dn  # (before - n) z (1 - z) d
            np.multiply(n, n, out=own)
            np.subtract(1, own, out=own)
            dn *= own
            np.multiply(dn, r, out=own)
            np.subtract(1, r, out=dr)
            dr *= own
            dr *= u
            to_state += before @ gates[t, : 3 * HIDDEN].T
            to_input += vectors @ gates[t, HIDDEN:].T
            d = by_state @ gates[t, : 3 * HIDDEN]
            d += kept
            going = given[t] != self.start
            if not going.all():
                d *= going
        g["state"] += np.hstack([to_state[:, HIDDEN:], to_state[:, :HIDDEN]])
        g["input"] += to_input[:-1]
        g["gate_b"] += to_input[-1]
        moved = (gates[:, HIDDEN:].transpose(0, 2, 1) @ p["input"].T).reshape(-1, EMBED)
        words = given.reshape(-1)
        order = np.argsort(words.astype(np.int16) if self.start < 2**15 else words, kind="stable")
        words = words[order]
        begin = np.flatnonzero(np.r_[True, np.diff(words) > 0])
        g["embed"][words[begin]] += np.add.reduceat(moved[order], begin, axis=0)

    def gradients(self, windows: list[tuple], words: int) -> tuple[dict[str, np.ndarray], float]:
        """Gradients and loss, both by word, of windows (given, target, live, cache, states) that
        ran under the same weights: one pass of the output layer over all, then each window's own
        backpropagation."""
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        weight = np.concatenate([live.reshape(-1) for _, _, live, _, _ in windows]).astype(np.float32) / np.float32(max(1, words))
        back, loss = self._output(np.concatenate([s for *_, s in windows]), np.concatenate([t.reshape(-1) for _, t, _, _, _ in windows]), weight, g)
        at = 0
        for given, _, _, cache, states in windows:
            self._backward(given, cache, back[at : at + len(states)], g)
            at += len(states)
        return g, loss

    def window_gradients(self, given: np.ndarray, target: np.ndarray, live: np.ndarray, h: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, float]:
        """Gradients of the mean loss of a (steps, lanes) window, the last state, the loss."""
        cache, states, last = self._forward(given, h)
        g, loss = self.gradients([(given, target, live, cache, states)], int(live.sum()))
        return g, last, loss

    def fit(self, texts: list[np.ndarray], rate: float = 0.01, lanes: int = 128, optimiser: dict | None = None) -> int:
        """One pass over whole texts; the state runs through all windows, and each is
        backpropagated.  Windows of few lanes, where only long texts go on, are gathered to
        about as many words as a whole one has before a step is made, so that each word
        weighs the same.  Returns the number of words passed."""
        words = sum(map(len, texts))
        if not words:
            return 0
        lanes = int(max(8, min(lanes, words // (WINDOW * 100))))
        laid = Lanes(texts, lanes, self.start)
        kept = optimiser if optimiser is not None else {}
        h = np.zeros((len(laid.lengths), HIDDEN), np.float32, order="F")
        full, gathered, seen = len(laid.lengths) * WINDOW, [], 0
        for begin in range(0, len(laid.active), WINDOW):
            end = min(begin + WINDOW, len(laid.active))
            given, target, live = laid.window(begin, end)
            cache, states, h = self._forward(given, h[: given.shape[1]])
            gathered.append((given, target, live, cache, states))
            seen += int(live.sum())
            if 4 * seen > 3 * full or end == len(laid.active):
                self._update(self.gradients(gathered, seen)[0], rate * min(1.0, seen / full), kept)
                gathered, seen = [], 0
        return words

    def _update(self, g: dict[str, np.ndarray], rate: float, kept: dict) -> None:
        """Adam with gradients clipped to a norm of 1."""
        norm = float(np.sqrt(sum(float(np.vdot(x, x)) for x in g.values())))
        scale = np.float32(min(1.0, 1.0 / (norm + 1e-9)))
        kept["t"] = t = kept.get("t", 0) + 1
        step = np.float32(rate * np.sqrt(1 - 0.99**t) / (1 - 0.9**t))
        for k, x in g.items():
            m = kept.setdefault(("m", k), np.zeros_like(x))
            v = kept.setdefault(("v", k), np.zeros_like(x))
            x *= np.float32(0.1) * scale
            m *= np.float32(0.9)
            m += x
            x *= x  # a hundredth of the gradient's square
            v *= np.float32(0.99)
            v += x
            np.sqrt(v, out=x)
            x += np.float32(1e-7)
            np.divide(m, x, out=x)
            x *= step
            self.p[k] -= x

    def weights(self) -> np.ndarray:
        return np.concatenate([self.p[k].reshape(-1) for k in sorted(self.p)])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k in sorted(self.p):
            n = self.p[k].size
            self.p[k] = flat[at : at + n].reshape(self.p[k].shape).astype(np.float32)
            at += n
