"""A gated recurrent language model in numpy, with a class-factored softmax.

Documents run side by side in streams, one after the other in each; the state
is carried across windows and starts at zero with every document, so that a
document is scored from its first token to its last whatever the windows.
Training is truncated backpropagation: gradients flow within a window.

Token ``i`` belongs to class ``i // WIDTH``; the last id stands for all words
outside the vocabulary and is a class of its own. A token costs one softmax
over the classes and one over the words of its class.
"""

from __future__ import annotations

import heapq

import numpy as np

HIDDEN = 16
WIDTH = 32
STREAMS = 512
WINDOW = 32
RATE = 0.03

Parameters = dict[str, np.ndarray]


def start(counts: np.ndarray, outside: float, seed: int = 3) -> Parameters:
    """Parameters that give the frequencies of ``counts`` and ``outside`` before any training."""
    random = np.random.default_rng(seed)
    n, h = len(counts), HIDDEN
    classes = -(-n // WIDTH) + 1
    padded = np.zeros((classes - 1) * WIDTH)
    padded[:n] = counts + 0.5
    by_class = np.append(padded.reshape(-1, WIDTH).sum(1), outside + 0.5)
    words = np.full(len(padded), -30.0)
    words[:n] = np.log(counts + 0.5)
    small = lambda *shape: random.normal(0, 0.1, shape)
    found = {
        "embed": small(n + 1, h),
        "input": small(h, 3 * h),
        "back": small(h, 3 * h),
        "bias": np.zeros(3 * h),
        "classes": small(h, classes) * 0.1,
        "class_bias": np.log(by_class / by_class.sum()),
        "words": np.zeros((len(padded), h)),
        "word_bias": words,
    }
    return {k: v.astype(np.float32) for k, v in found.items()}


def flat(parameters: Parameters) -> np.ndarray:
    return np.concatenate([p.ravel() for p in parameters.values()])


def shaped(values: np.ndarray, like: Parameters) -> Parameters:
    out, at = {}, 0
    for name, p in like.items():
        out[name] = values[at : at + p.size].reshape(p.shape).astype(np.float32)
        at += p.size
    return out


def streams(documents: list[np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and document numbers by step and stream; -1 where a stream has ended.

    There are as many streams as keep the others as long as the longest
    document, up to ``most``.
    """
    sizes = np.array([len(d) for d in documents])
    n = max(1, min(most, len(documents), int(sizes.sum()) // max(1, int(sizes.max(initial=1)))))
    lanes: list[list[int]] = [[] for _ in range(n)]
    # The longest documents first, each to the shortest stream.
    ends = [(0, lane) for lane in range(n)]
    for k in np.argsort(-sizes, kind="stable").tolist():
        end, lane = heapq.heappop(ends)
        lanes[lane].append(k)
        heapq.heappush(ends, (end + len(documents[k]), lane))
    steps = max((end for end, _ in ends), default=0)
    ids, owner = np.full((n, steps), -1, np.int32), np.full((n, steps), -1, np.int32)
    for lane, held in enumerate(lanes):
        tokens = np.concatenate([documents[k] for k in held])
        ids[lane, : len(tokens)] = tokens
        owner[lane, : len(tokens)] = np.repeat(held, sizes[held])
    ids = np.ascontiguousarray(ids.T)
    return ids, np.ascontiguousarray(owner.T)


def score(p: Parameters, documents: list[np.ndarray], n: int = STREAMS, window: int = 64) -> np.ndarray:
    """Natural log probability of each document."""
    ids, owner = streams(documents, n)
    total = np.zeros(len(documents))
    table = p["embed"] @ p["input"] + p["bias"]
    state = np.zeros((ids.shape[1], HIDDEN), np.float32)
    for at in range(0, len(ids), window):
        now, who = ids[at : at + window], owner[at : at + window]
        previous, fresh = _previous(ids, owner, at, len(now))
        hidden, state, _ = _forward(p, table, previous, fresh, state, keep=False)
        live = now >= 0
        found = _log_probability(p, hidden[live], now[live])[0]
        total += np.bincount(who[live], found, len(documents))
    return total


class Trainer:
    """Adagrad over windows of many streams, with parameters of its own."""

    def __init__(self, parameters: Parameters):
        self.p = {k: v.copy() for k, v in parameters.items()}
        self.seen = {k: np.full_like(v, 1e-4) for k, v in parameters.items()}
        self.tokens = 0

    def learn(self, documents: list[np.ndarray]) -> None:
        ids, owner = streams(documents, STREAMS)
        state = np.zeros((ids.shape[1], HIDDEN), np.float32)
        for at in range(0, len(ids), WINDOW):
            now = ids[at : at + WINDOW]
            previous, fresh = _previous(ids, owner, at, len(now))
            gradients, state, n = backward(self.p, previous, fresh, now, state)
            self.tokens += n
            for name, g in gradients.items():
                g = np.clip(g / max(n, 1), -0.5, 0.5)
                self.seen[name] += g * g
                self.p[name] -= RATE * g / np.sqrt(self.seen[name])


def backward(p: Parameters, previous, fresh, targets, state):
    """Gradients of a window's loss, the state after it, and how many tokens it has."""
    h = HIDDEN
    table = p["embed"] @ p["input"] + p["bias"]
    hidden, last, steps = _forward(p, table, previous, fresh, state, keep=True)
    live = targets >= 0
    _, outputs, g_live = _log_probability(p, hidden[live], targets[live], gradients=True)
    g_hidden = np.zeros_like(hidden)
    g_hidden[live] = g_live
    # Gradients of the gates: of what the input gave and of what the state gave.
    befores, updates, resets, candidates, inners = steps
    by_update = befores - candidates
    by_update *= updates
    by_candidate = 1 - candidates * candidates
    by_reset = inners * resets
    by_reset *= 1 - resets
    rests = 1 - updates
    # The input's share and the state's differ in the candidates alone.
    gates = np.empty((*previous.shape, 2 * h), hidden.dtype)
    given, own = np.empty_like(befores), np.empty_like(befores)
    carried = np.zeros_like(state)
    back_gates = np.ascontiguousarray(p["back"][:, : 2 * h].T)
    back_inner = np.ascontiguousarray(p["back"][:, 2 * h :].T)
    restart = fresh.any(1).tolist()
    for t in range(len(targets) - 1, -1, -1):
        g = g_hidden[t]
        g += carried
        rest, now = rests[t], gates[t]
        rest *= g
        candidate = np.multiply(rest, by_candidate[t], out=given[t])
        np.multiply(rest, by_update[t], out=now[:, :h])
        np.multiply(candidate, by_reset[t], out=now[:, h:])
        carried = now @ back_gates
        carried += np.multiply(candidate, resets[t], out=own[t]) @ back_inner
        g *= updates[t]
        carried += g
        if restart[t]:
            carried *= ~fresh[t][:, None]
    g_back = befores.reshape(-1, h).T @ np.concatenate([gates, own], 2).reshape(-1, 3 * h)
    g_table = np.zeros_like(table)
    tokens = np.where(previous < 0, len(table) - 1, previous).ravel()
    order = _order(tokens, len(table))
    tokens = tokens[order]
    heads = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    of_token = tokens[heads]
    g_table[of_token, : 2 * h] = np.add.reduceat(gates.reshape(-1, 2 * h).take(order, 0), heads)
    g_table[of_token, 2 * h :] = np.add.reduceat(given.reshape(-1, h).take(order, 0), heads)
    used = outputs
    used["bias"] = g_table.sum(0)
    used["input"] = p["embed"].T @ g_table
    used["embed"] = g_table @ p["input"].T
    used["back"] = g_back
    return {k: used[k] for k in p}, last, int(live.sum())


def _previous(ids, owner, at, n) -> tuple[np.ndarray, np.ndarray]:
    """The token before each, and where a document starts. Starts read the outside token."""
    before = np.empty((n, ids.shape[1]), np.int64)
    before[1:] = ids[at : at + n - 1]
    before[0] = ids[at - 1] if at else -1
    other = np.empty((n, ids.shape[1]), np.int64)
    other[1:] = owner[at : at + n - 1]
    other[0] = owner[at - 1] if at else -1
    fresh = owner[at : at + n] != other
    # The last row of the table is the outside token's.
    return np.where(fresh, -1, before), fresh


def _order(keys, kinds) -> np.ndarray:
    """The places of equal keys after each other; short keys are sorted by their digits."""
    return np.argsort(keys.astype(np.uint16) if kinds <= 1 << 16 else keys, kind="stable")


def _sigmoid(x):
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.divide(1, x, out=x)


def _forward(p, table, previous, fresh, state, keep):
    h = HIDDEN
    # Apart, so that all that is done by element is done on whole arrays.
    tables, backs = ([np.ascontiguousarray(x[:, k * h : (k + 1) * h]) for k in range(3)] for x in (table, p["back"]))
    hidden = np.empty((*previous.shape, h), np.float32)
    steps = [np.empty_like(hidden) for _ in range(5)] if keep else []
    tokens = np.where(previous < 0, len(table) - 1, previous)
    restart = fresh.any(1).tolist()
    for t, now in enumerate(tokens):
        if restart[t]:
            state = state * ~fresh[t][:, None]
        update, reset, candidate = (x.take(now, 0) for x in tables)
        update += state @ backs[0]
        reset += state @ backs[1]
        inner = state @ backs[2]
        update, reset = _sigmoid(update), _sigmoid(reset)
        candidate += reset * inner
        np.tanh(candidate, out=candidate)
        for held, x in zip(steps, (state, update, reset, candidate, inner)):
            held[t] = x
        state = np.subtract(state, candidate, out=hidden[t])
        state *= update
        state += candidate
    return hidden, state.copy(), steps


def _exponentials(logits, cuts):
    """Exponentials of the logits and their sums by row; large logits are moved, which is rarely needed.

    Both are taken for the rows between two cuts together.
    """
    parts = [slice(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]
    if len(logits) and logits.max() > 60:
        for rows in parts:
            if logits[rows].max() > 60:
                logits[rows] -= logits[rows].max(1, keepdims=True)
    e = np.exp(logits)
    sums, ones = np.empty(len(e), e.dtype), np.ones(e.shape[1], e.dtype)
    for rows in parts:
        np.matmul(e[rows], ones, out=sums[rows])
    if len(logits) and sums.min() < 1e-20:
        for rows in parts:
            if sums[rows].min() < 1e-20:
                logits[rows] -= logits[rows].max(1, keepdims=True)
                e[rows] = np.exp(logits[rows])
                sums[rows] = e[rows].sum(1)
    return e, sums


def _log_probability(p, hidden, targets, gradients=False):
    """Log probability of each target after its state; with gradients of the negative sum."""
    outside = len(p["embed"]) - 1
    last = p["classes"].shape[1] - 1
    of = np.where(targets == outside, last, targets // WIDTH)
    # In the order of classes, so that each is a slice.
    order = _order(of, last + 1)
    of, within, hidden = of[order], (targets % WIDTH)[order], hidden[order]
    cuts = np.searchsorted(of, np.arange(last + 1)).tolist()
    at = np.arange(len(of))
    logits = hidden @ p["classes"]
    logits += p["class_bias"]
    e, sums = _exponentials(logits, [0, len(of)])
    # Rounding may lift a certain choice a little above probability 1.
    found = np.minimum(logits[at, of] - np.log(sums), 0)
    out, g_hidden = {}, None
    if gradients:
        e /= sums[:, None]
        e[at, of] -= 1
        out = {"classes": hidden.T @ e, "class_bias": e.sum(0)}
        out |= {"words": np.zeros_like(p["words"]), "word_bias": np.zeros_like(p["word_bias"])}
        g_hidden = e @ p["classes"].T
    inner = cuts[last]
    at, within = at[:inner], within[:inner]
    parts = [(slice(cuts[c], cuts[c + 1]), slice(c * WIDTH, (c + 1) * WIDTH)) for c in range(last) if cuts[c] < cuts[c + 1]]
    logits = np.empty((inner, WIDTH), hidden.dtype)
    for rows, own in parts:
        np.matmul(hidden[rows], p["words"][own].T, out=logits[rows])
        logits[rows] += p["word_bias"][own]
    e, sums = _exponentials(logits, cuts)
    found[:inner] += np.minimum(logits[at, within] - np.log(sums), 0)
    if gradients:
        e /= sums[:, None]
        e[at, within] -= 1
        for rows, own in parts:
            out["words"][own] = e[rows].T @ hidden[rows]
            out["word_bias"][own] = e[rows].sum(0)
            g_hidden[rows] += e[rows] @ p["words"][own]
    scores = np.empty(len(found))
    scores[order] = found
    if gradients:
        back = np.empty_like(g_hidden)
        back[order] = g_hidden
        g_hidden = back
    return scores, out, g_hidden
