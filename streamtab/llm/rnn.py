"""A small gated recurrent language model in numpy: class-factored softmax, truncated backpropagation, state carried on.

Token ids below `vocab` are words, in order of frequency, `size` of them to a class; ids from `vocab` on are buckets of rarer words,
which are classes without members here. P(token) = P(class | state) * P(word | class, state).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

UNITS, CLASS_SIZE = 16, 32
WINDOW, LANES = 16, 256
# Lanes of a pass that does not learn, whose scores do not depend on them.
SCORE_LANES = 512
# A chunk that is learnt from gets at least about so many windows, by fewer lanes.
LEAST_WINDOWS = 40
RATE, CLIP = 0.08, 5.0
# More than one window's arrays take.
KEPT_BYTES = 1 << 24


def initial(log_word: np.ndarray, log_class: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """Parameters that give every word its corpus frequency whatever the state; `log_word` is (classes, size)."""
    rng = np.random.default_rng(seed)
    classes, size = log_word.shape
    tokens = classes * size + len(log_class) - classes
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    return {
        "inputs": small(tokens, 3 * UNITS),
        "state": small(UNITS, 3 * UNITS),
        "class": small(UNITS, len(log_class)) * 0.1,
        "class_bias": log_class.astype(np.float32),
        "word": small(classes, UNITS, size) * 0.1,
        "word_bias": log_word.astype(np.float32),
    }


def flat(model: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([model[k].ravel() for k in sorted(model)])


def shaped(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = values[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def lanes(documents: list[np.ndarray], most: int = LANES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents dealt into lanes, longest lane first: tokens (steps, lanes; -1 past a lane's end), each step's document, and lengths.

    Longest document first onto the shortest lane; lanes that have ended are left out of later windows.
    """
    sizes = [len(d) for d in documents]
    count = max(1, min(most, len(documents)))
    heap, held = [(0, i) for i in range(count)], [[] for _ in range(count)]
    for d in sorted(range(len(documents)), key=lambda i: (-sizes[i], i)):
        length, lane = heapq.heappop(heap)
        held[lane].append(d)
        heapq.heappush(heap, (length + sizes[d], lane))
    heap.sort(reverse=True)
    held = [held[lane] for _, lane in heap]
    lengths = np.array([length for length, _ in heap])
    steps = int(lengths[0])
    tokens, owner = np.full((count, steps), -1, np.int32), np.zeros((count, steps), np.int32)
    for lane, own in enumerate(held):
        at = 0
        for d in own:
            tokens[lane, at : at + sizes[d]] = documents[d]
            owner[lane, at : at + sizes[d]] = d
            at += sizes[d]
    return tokens.T, owner.T, lengths


def _sigmoid(x: np.ndarray) -> None:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


def _table(rows: int, count: int) -> np.ndarray:
    """Room for rows of `count` numbers that do not begin a power of two apart, where a copy by columns would find few places in the cache."""
    return np.empty((rows, (count + 15) // 16 * 16 | 16), np.float32)[:, :count]


def _sums(x: np.ndarray) -> np.ndarray:
    """Sum of each row, added in the order in which numpy adds a contiguous row of up to 128, however `x` lies in memory."""
    if x.shape[1] % 8:
        return x.sum(axis=1)
    s = x.T.reshape(x.shape[1] // 8, 8, len(x)).sum(axis=0)
    return ((s[0] + s[1]) + (s[2] + s[3])) + ((s[4] + s[5]) + (s[6] + s[7]))


def _softmax(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-probability of column `at` of each row; the exponentials, written over `x`, and their sums. Fastest where columns are contiguous."""
    columns = x.T
    columns -= columns.max(axis=0)
    picked = columns[at, np.arange(len(x))]
    np.exp(columns, out=columns)
    total = _sums(x)
    return picked - np.log(total), x, total


def _error(x: np.ndarray, total: np.ndarray, at: np.ndarray, share: int) -> np.ndarray:
    """Gradient of the loss over `share` from exponentials and sums, which are overwritten."""
    columns = x.T
    columns /= total
    columns[at, np.arange(len(x))] -= 1
    columns *= np.float32(1 / max(1, share))
    return np.ascontiguousarray(x)


def _ranked(ids: np.ndarray) -> np.ndarray:
    """Stable order of ids or classes, of which there are fewer than 65,536: numpy sorts 16 bits by their digits."""
    return np.argsort(ids.astype(np.uint16), kind="stable")


def _run_sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """`np.add.reduceat(rows, first, axis=0)` to the last bit; runs of up to eight rows, which most are, are added side by side."""
    sizes = np.diff(first, append=len(rows))
    out = rows.take(first, axis=0)
    short = np.flatnonzero((sizes > 1) & (sizes <= 8))
    # As there, the first row is added last.
    rest = rows.take(first[short] + 1, axis=0)
    for k in range(2, 8):
        more = np.flatnonzero(sizes[short] > k)
        rest[more] += rows.take(first[short[more]] + k, axis=0)
    out[short] += rest
    long = np.flatnonzero(sizes > 8)
    if len(long):
        held = sizes[long]
        starts = np.cumsum(held) - held
        at = np.repeat(first[long] - starts, held) + np.arange(held.sum())
        out[long] = np.add.reduceat(rows.take(at, axis=0), starts, axis=0)
    return out


class Pass:
    """Runs a model over lanes window by window; with `learn`, every window also updates it (Adagrad)."""

    def __init__(self, model: dict[str, np.ndarray], end: int, learn: bool = False):
        self.model, self.end, self.learn = model, end, learn
        self.vocab = model["word_bias"].size
        self.share = 1
        self.squares = {k: np.full_like(v, 1e-7) for k, v in model.items()} if learn else {}
        # A freed block of this size tells the C library to keep what a window frees; else every window asks the system for it again.
        np.empty(KEPT_BYTES, np.uint8)

    def run(self, documents: list[np.ndarray]) -> np.ndarray:
        """Log-likelihood (natural) of each document; its state starts at zero, with the end token as what came before."""
        most = SCORE_LANES
        if self.learn:
            most = int(max(8, min(LANES, sum(map(len, documents)) // (WINDOW * LEAST_WINDOWS))))
        # A window counts by its tokens: when few lanes are left it moves little.
        self.share = most * WINDOW
        tokens, owner, lengths = lanes(documents, most)
        steps, count = tokens.shape
        state, total = np.zeros((count, UNITS), np.float32), np.zeros(len(documents))
        for at in range(0, steps, WINDOW):
            live, to = int((lengths > at).sum()), min(at + WINDOW, steps)
            here, mine = np.ascontiguousarray(tokens[at:to, :live]), np.ascontiguousarray(owner[at:to, :live])
            starts, before = np.ones(here.shape, bool), np.full(here.shape, self.end, np.int32)
            if at:
                starts[0] = mine[0] != owner[at - 1, :live]
                before[0] = np.where(starts[0], self.end, tokens[at - 1, :live])
            starts[1:] = mine[1:] != mine[:-1]
            before[1:] = np.where(starts[1:] | (here[:-1] < 0), self.end, here[:-1])
            state, scores = self._window(here, before, starts, state[:live])
            valid = here >= 0
            total += np.bincount(mine[valid], weights=scores, minlength=len(documents))
        return total

    def _states(self, before, starts, state):
        """State before each step (zero at a start), both gates apart, candidate, its recurrent part, and state after each step."""
        m = self.model
        steps, count = before.shape
        # Update gate, reset gate and candidate apart, as operations on whole arrays are fastest.
        inputs = np.ascontiguousarray(m["inputs"].reshape(-1, 3, UNITS).transpose(1, 0, 2))
        x, fresh = inputs.take(before, axis=1), starts.any(axis=1).tolist()
        kept, news, states = (np.empty((steps, count, UNITS), np.float32) for _ in range(3))
        gates, recurrent = np.empty((steps, 2, count, UNITS), np.float32), np.empty((steps, 3, count, UNITS), np.float32)
        for t in range(steps):
            before_it, g, both, new, after = kept[t], recurrent[t], gates[t], news[t], states[t]
            before_it[...] = state
            if fresh[t]:
                before_it[starts[t]] = 0
            g[...] = (before_it @ m["state"]).reshape(count, 3, UNITS).transpose(1, 0, 2)
            np.add(x[:2, t], g[:2], out=both)
            _sigmoid(both)
            np.multiply(both[1], g[2], out=new)
            new += x[2, t]
            np.tanh(new, out=new)
            np.subtract(before_it, new, out=after)
            after *= both[0]
            after += new
            state = after
        return kept, gates, news, recurrent[:, 2], states

    def _window(self, tokens, before, starts, state):
        m = self.model
        kept, gates, news, inner, states = self._states(before, starts, state)
        valid = tokens >= 0
        h, y = states.reshape(-1, UNITS), tokens.ravel()
        if not valid.all():
            h, y = h[valid.ravel()], y[valid.ravel()]
        classes, size = m["word_bias"].shape
        word = y < self.vocab
        group = np.where(word, y // size, y - self.vocab + classes)
        # Logits are laid out with the states of one column together: reductions then run along them.
        logits = np.matmul(m["class"].T, h.T, out=_table(len(m["class_bias"]), len(h)))
        logits += m["class_bias"][:, None]
        logs, e, total = _softmax(logits.T, group)
        scores = logs.astype(np.float64)
        order = np.flatnonzero(word)
        order = order[_ranked(group[order])]
        cuts = np.searchsorted(group[order], np.arange(classes + 1))
        sorted_h, places = h.take(order, axis=0), y[order] % size
        held = [(c, slice(i, j)) for c, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if i < j]
        dh = grads = None
        if self.learn:
            d = _error(e, total, group, self.share)
            grads = {"class": h.T @ d, "class_bias": d.sum(axis=0), "word": np.zeros_like(m["word"]), "word_bias": np.zeros_like(m["word_bias"])}
            dh = d @ m["class"].T
        # Logits of all classes side by side, so that one softmax does them all.
        logits, columns = _table(size, len(order)), sorted_h.T
        for c, cut in held:
            np.matmul(m["word"][c].T, columns[:, cut], out=logits[:, cut])
        logits += np.repeat(m["word_bias"].T, np.diff(cuts), axis=1)
        inside, e, total = _softmax(logits.T, places)
        if self.learn:
            d, back = _error(e, total, places, self.share), np.empty_like(sorted_h)
            for c, cut in held:
                here, error = columns[:, cut], d[cut]
                np.matmul(here, error, out=grads["word"][c])
                np.add.reduce(error, axis=0, out=grads["word_bias"][c])
                np.matmul(error, m["word"][c].T, out=back[cut])
        scores[order] += inside
        if self.learn and len(y):
            back += dh.take(order, axis=0)
            dh[order] = back
            if len(dh) < valid.size:
                whole = np.zeros((valid.size, UNITS), np.float32)
                whole[valid.ravel()] = dh
                dh = whole
            self._back(before, starts, kept, gates, news, inner, dh.reshape(states.shape), grads)
        return states[-1], scores

    def _back(self, before, starts, kept, gates, news, inner, out, grads):
        """Backpropagation through the window's steps, and the update."""
        m, u = self.model, UNITS
        z, r, fresh = gates[:, 0], gates[:, 1], starts.any(axis=1).tolist()
        # What does not depend on later steps, for all steps together.
        less_z, less_r, less_n, gap = 1 - z, 1 - r, 1 - news * news, kept - news
        # Errors of both gates, of the recurrent part and of the candidate, side by side.
        errors, carry = np.empty((*before.shape, 4 * u), np.float32), np.zeros_like(out[0])
        dn, d, back = np.empty_like(carry), np.empty_like(carry), m["state"].T
        for t in range(len(out) - 1, -1, -1):
            dh, own = out[t], errors[t]
            dh += carry
            np.multiply(dh, less_z[t], out=dn)
            dn *= less_n[t]
            own[:, 3 * u :] = dn
            np.multiply(dn, r[t], out=own[:, 2 * u : 3 * u])
            np.multiply(dh, gap[t], out=d)
            d *= z[t]
            np.multiply(d, less_z[t], out=own[:, :u])
            dn *= inner[t]
            dn *= r[t]
            np.multiply(dn, less_r[t], out=own[:, u : 2 * u])
            np.matmul(own[:, : 3 * u], back, out=carry)
            dh *= z[t]
            carry += dh
            if fresh[t]:
                carry[starts[t]] = 0
        errors = errors.reshape(-1, 4 * u)
        grads["state"] = kept.reshape(-1, u).T @ errors[:, : 3 * u]
        ids = before.ravel()
        order = _ranked(ids)
        ids = ids[order]
        first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        sums = _run_sums(errors.take(order, axis=0), first)
        sums = np.concatenate([sums[:, : 2 * u], sums[:, 3 * u :]], axis=1)
        rows = ids[first]
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()) + float((sums * sums).sum()))
        scale = np.float32(min(1.0, CLIP / max(norm, 1e-9)))
        for k, g in grads.items():
            g = g * scale
            self.squares[k] += g * g
            m[k] -= RATE * g / np.sqrt(self.squares[k])
        g = sums * scale
        self.squares["inputs"][rows] += g * g
        m["inputs"][rows] -= RATE * g / np.sqrt(self.squares["inputs"][rows])


def chunks(rows: Iterator[tuple], tokens: int) -> Iterator[list[tuple]]:
    """Rows of (ids, ...) gathered until they hold `tokens` ids; a longer row is a chunk of its own."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[0])
        if size >= tokens:
            yield held
            held, size = [], 0
    if held:
        yield held
