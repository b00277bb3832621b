"""A small causal self-attention model over slots, in numpy: its probabilities, gradients and fit.

A text is a sequence of slots that ends in ``END`` and is preceded by as many ``END`` as a
window needs. A window predicts ``SPAN`` slots from the three slots before each
and by attention over all earlier slots of the window, which
begins ``BEFORE`` slots ahead. Windows overlap by these; each slot is scored once.

Slots come in groups of ``MEMBERS``; the model gives the probability of the group,
and of the slot within it, so a slot's cost does not grow with their number.
"""

from __future__ import annotations

import ctypes

import numpy as np

BEFORE, SPAN = 8, 40
WINDOW = BEFORE + SPAN
#: Slots that a window needs: the inputs, the two before them, and the last target.
REACH = WINDOW + 3
GROUPS, MEMBERS = 32, 32
END, RARE = 0, 1
WIDTH, HIDDEN = 24, 48
#: Windows of a step of the fit; windows that the layers score at once, whose arrays stay in a core's cache; and windows whose slots are told apart at once.
BATCH, AT_ONCE, CHUNK = 64, 32, 512
RATE, DECAYS = 2e-2, (0.9, 0.99)
#: Logits beyond it count as it.
MOST = 60

_SHAPES = {
    "now": (GROUPS * MEMBERS, WIDTH), "last": (GROUPS * MEMBERS, WIDTH), "older": (GROUPS * MEMBERS, WIDTH), "place": (WINDOW, WIDTH),
    "query": (WIDTH, WIDTH), "key": (WIDTH, WIDTH), "value": (WIDTH, WIDTH),
    "inner": (WIDTH, HIDDEN), "inner_bias": (HIDDEN,), "outer": (HIDDEN, WIDTH),
    "group": (WIDTH, GROUPS), "group_bias": (GROUPS,), "member": (GROUPS, WIDTH, MEMBERS), "member_bias": (GROUPS, MEMBERS),
}
_ENDS = np.cumsum([int(np.prod(s)) for s in _SHAPES.values()]).tolist()
_PLACES = {name: (slice(a, b), shape) for (name, shape), a, b in zip(_SHAPES.items(), [0, *_ENDS], _ENDS)}
SIZE = _ENDS[-1]
#: What a logit of attention can be at most: nothing is read from a later slot.
_LIMITS = np.where(np.arange(WINDOW)[None, :] <= np.arange(BEFORE, WINDOW)[:, None], MOST, -1e9).astype(np.float32)
#: What adds up the logits of groups and those of members.
_SUMS = np.repeat(np.eye(2, dtype=np.float32), (GROUPS, MEMBERS), 0)


def keep_memory() -> None:
    """Let this process keep the memory of arrays that it frees, where the C library can: batches are many and alike.

    Otherwise each array of over 128 KB is mapped and cleared anew, which takes longer than the arithmetic.
    """
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):
        for option in (-1, -3):  # M_TRIM_THRESHOLD, M_MMAP_THRESHOLD
            libc.mallopt(option, 64 << 20)


def parts(weights: np.ndarray) -> dict[str, np.ndarray]:
    """Views of the flat ``weights`` by name."""
    return {name: weights[at].reshape(shape) for name, (at, shape) in _PLACES.items()}


def first_weights(group_counts: np.ndarray | None = None, seed: int = 0) -> np.ndarray:
    """Random weights; where the slots' counts are known, the biases give their frequencies."""
    weights = (np.random.default_rng(seed).standard_normal(SIZE) * 0.15).astype(np.float32)
    p = parts(weights)
    for name in ("inner_bias", "group_bias", "member_bias"):
        p[name][:] = 0
    if group_counts is not None:
        counts = group_counts.reshape(GROUPS, MEMBERS) + 1.0
        p["group_bias"][:] = np.log(counts.sum(1) / counts.sum())
        p["member_bias"][:] = np.log(counts / counts.sum(1, keepdims=True))
    return weights


def places(length: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows of texts that lie end to end over ``length`` slots begin, and which text each is of."""
    sizes = np.diff(np.append(starts, length))
    per_text = -(-sizes // SPAN)
    text = np.repeat(np.arange(len(starts)), per_text)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    return starts[text] + number * SPAN, text


def windows(slots: np.ndarray, starts: np.ndarray, begin: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The windows that ``begin`` at these places, one a row; -1 is beyond a text."""
    ends = np.append(starts[1:], len(slots))
    place = begin[:, None] + np.arange(-BEFORE - 3, SPAN)[None, :]
    out = slots[np.clip(place, 0, max(0, len(slots) - 1))]
    out[place < starts[text][:, None]] = END
    out[place >= ends[text][:, None]] = -1
    return out


def text_scores(p: dict, slots: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The natural log probability of each text, a few windows at a time."""
    begin, text = places(len(slots), starts)
    out = np.zeros(len(starts))
    for at in range(0, len(begin), CHUNK):
        own = text[at : at + CHUNK]
        found = log_probabilities(p, windows(slots, starts, begin[at : at + CHUNK], own)).sum(1, dtype=np.float64)
        np.add.at(out, own, found)
    return out


def _mixing(p: dict) -> np.ndarray:
    """What makes keys, scaled queries and values of inputs, side by side."""
    return np.concatenate([p["key"], p["query"] * WIDTH**-0.5, p["value"]], 1)


def _with_bias(matrix: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The matrix, and its bias as a last row."""
    return np.concatenate([matrix, bias[..., None, :]], -2)


def _heads(p: dict) -> np.ndarray:
    """For each group what makes the logits of all groups, and of its own members; the last row is the bias."""
    group = _with_bias(p["group"], p["group_bias"])
    return np.concatenate([np.broadcast_to(group, (GROUPS, *group.shape)), _with_bias(p["member"], p["member_bias"])], 2)


def _forward(p: dict, batch: np.ndarray):
    """Inputs and what the layers make of them, for gradients too."""
    batch = batch.astype(np.int64)
    n = len(batch)
    known = np.maximum(batch, 0)
    x = p["now"].take(known[:, 2:-1], 0)
    x += p["last"].take(known[:, 1:-2], 0)
    x += p["older"].take(known[:, :-3], 0)
    x += p["place"]
    # Keys, queries, values and a one, which adds the weights up.
    made = np.empty((n, WINDOW, 3 * WIDTH + 1), x.dtype)
    made[:, :, -1] = 1
    np.matmul(x.reshape(-1, WIDTH), _mixing(p), out=made.reshape(n * WINDOW, -1)[:, :-1])
    key, query, value = made[:, :, :WIDTH], made[:, BEFORE:, WIDTH : 2 * WIDTH], made[:, :, 2 * WIDTH :]
    seen = np.matmul(query, key.transpose(0, 2, 1))
    np.minimum(seen, _LIMITS, out=seen)
    np.exp(seen, out=seen)
    read = np.matmul(seen, value).reshape(-1, WIDTH + 1)
    total = read[:, -1:]
    read = read[:, :-1] / total
    mixed = (read.reshape(n, SPAN, WIDTH) + x[:, BEFORE:]).reshape(-1, WIDTH)
    inner = mixed @ p["inner"]
    inner += p["inner_bias"]
    np.maximum(inner, np.zeros_like(inner), out=inner)
    top = inner @ p["outer"]
    top += mixed
    return known, x, key, query, value, seen, total, read, mixed, inner, top


def _log_of(logits: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The log probability of the targets, what the exponentials of groups and of members add up to, which take the logits' place, and where the targets' lie in them."""
    if logits.max(initial=0) > MOST:
        np.minimum(logits, MOST, out=logits)
    row = np.arange(0, logits.size, GROUPS + MEMBERS)
    where = [row + target // MEMBERS, row + (GROUPS + target % MEMBERS)]
    chosen = logits.take(where[0]) + logits.take(where[1])
    np.exp(logits, out=logits)
    total = logits @ _SUMS
    return chosen - np.log(total).sum(1), total, where


def _by_group(batch: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, slice]]]:
    """Where there are targets, those of a group together, the targets, and where each group's are."""
    target = batch[:, -SPAN:].reshape(-1)
    there = np.flatnonzero(target >= 0)
    group = (target.take(there) // MEMBERS).astype(np.int8)
    order = np.argsort(group, kind="stable")
    stops = np.cumsum(np.bincount(group, minlength=GROUPS)).tolist()
    there = there.take(order)
    return there, target.take(there).astype(np.int64), [(g, slice(a, b)) for g, (a, b) in enumerate(zip([0, *stops], stops)) if b > a]


def log_probabilities(p: dict, rows: np.ndarray) -> np.ndarray:
    """The natural log probability of each target of the windows, zero where there is none."""
    out = np.zeros(len(rows) * SPAN, np.float32)
    top = np.concatenate([_forward(p, rows[i : i + AT_ONCE])[-1] for i in range(0, len(rows), AT_ONCE)])
    there, target, slices = _by_group(rows)
    heads = _heads(p)
    for g, own in slices:
        logits = top.take(there[own], 0) @ heads[g, :-1]
        logits += heads[g, -1]
        out[there[own]] = _log_of(logits, target[own])[0]
    return out.reshape(len(rows), SPAN)


def loss_and_gradient(weights: np.ndarray, batch: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean negative log probability of the targets, and its gradient."""
    p, gradient = parts(weights), np.zeros_like(weights)
    d = parts(gradient)
    known, x, key, query, value, seen, total, read, mixed, inner, top = _forward(p, batch)
    # Those of a group lie together, so that only products are made group by group.
    there, target, slices = _by_group(batch)
    n, size = max(1, len(there)), len(batch)
    h, heads = np.ones((len(there), WIDTH + 1), top.dtype), _heads(p)
    h[:, :-1] = top.take(there, 0)
    prob = np.empty((len(there), GROUPS + MEMBERS), h.dtype)
    for g, own in slices:
        np.matmul(h[own], heads[g], out=prob[own])
    found, sums, where = _log_of(prob, target)
    each = prob.reshape(-1, 2, MEMBERS)
    each *= (1 / (n * sums))[:, :, None]
    for own in where:
        prob.reshape(-1)[own] -= 1 / n
    dh, dheads = np.empty((len(there), WIDTH), h.dtype), np.zeros_like(heads)
    for g, own in slices:
        np.matmul(prob[own], heads[g, :-1].T, out=dh[own])
        np.matmul(h[own].T, prob[own], out=dheads[g])
    shared = dheads[:, :, :GROUPS].sum(0)
    d["group"][:], d["group_bias"][:] = shared[:-1], shared[-1]
    d["member"][:], d["member_bias"][:] = dheads[:, :-1, GROUPS:], dheads[:, -1, GROUPS:]
    dtop = np.zeros((len(top), WIDTH), h.dtype)
    dtop[there] = dh
    d["outer"][:] = inner.T @ dtop
    dinner = dtop @ p["outer"].T
    dinner *= inner > 0
    d["inner"][:], d["inner_bias"][:] = mixed.T @ dinner, dinner.sum(0)
    dmixed = dinner @ p["inner"].T
    dmixed += dtop
    # The gradient is divided by the sum of a row's weights, rather than all the weights.
    dread = np.empty((len(top), WIDTH + 1), h.dtype)
    np.divide(dmixed, total, out=dread[:, :-1])
    dread[:, -1] = -np.einsum("ij,ij->i", dread[:, :-1], read)
    dread = dread.reshape(size, SPAN, -1)
    dmade = np.zeros((size, WINDOW, 3 * WIDTH), h.dtype)
    np.matmul(seen.transpose(0, 2, 1), dread[:, :, :-1], out=dmade[:, :, 2 * WIDTH :])
    dseen = np.matmul(dread, value.transpose(0, 2, 1))
    dseen *= seen
    np.matmul(dseen.transpose(0, 2, 1), query, out=dmade[:, :, :WIDTH])
    np.matmul(dseen, key, out=dmade[:, BEFORE:, WIDTH : 2 * WIDTH])
    dmade = dmade.reshape(-1, 3 * WIDTH)
    dmixing = x.reshape(-1, WIDTH).T @ dmade
    d["key"][:], d["query"][:], d["value"][:] = dmixing[:, :WIDTH], dmixing[:, WIDTH : 2 * WIDTH] * WIDTH**-0.5, dmixing[:, 2 * WIDTH :]
    # Two rows without a gradient on both sides: a slot is the oldest of one input, the last of the next, and the one after's own.
    dx = np.zeros((size, WINDOW + 4, WIDTH), h.dtype)
    dx[:, 2:-2] = (dmade @ _mixing(p).T).reshape(size, WINDOW, WIDTH)
    dx[:, 2 + BEFORE : -2] += dmixed.reshape(size, SPAN, WIDTH)
    d["place"][:] = dx[:, 2:-2].sum(0)
    three = np.lib.stride_tricks.as_strided(dx, (size * (WINDOW + 4) - 2, 3 * WIDTH), (dx.strides[1], dx.strides[2]), writeable=False)
    ids = known[:, :-1].reshape(-1)
    order = np.argsort(ids.astype(np.int16), kind="stable")
    ids = ids.take(order)
    first = np.flatnonzero(np.diff(ids, prepend=-1))
    at = (np.arange(size)[:, None] * (WINDOW + 4) + np.arange(WINDOW + 2)).reshape(-1)
    # Added up two numbers at once, as complex ones.
    sums = np.add.reduceat(three[at.take(order)].view(np.result_type(dx, np.complex64)), first, axis=0).view(dx.dtype)
    ids = ids[first]
    d["now"][ids], d["last"][ids], d["older"][ids] = sums[:, :WIDTH], sums[:, WIDTH : 2 * WIDTH], sums[:, 2 * WIDTH :]
    return -found.sum(dtype=np.float64) / n, gradient


def fit(weights: np.ndarray, rows: np.ndarray, steps: int, rate: float = RATE, seed: int = 0) -> np.ndarray:
    """``weights`` after ``steps`` steps of Adam over ``rows``, windows in random order, the rate going down to a twentieth."""
    weights = weights.copy()
    rng = np.random.default_rng(seed)
    mean, square, change = np.zeros_like(weights), np.zeros_like(weights), np.empty_like(weights)
    order, at = rng.permutation(len(rows)), 0
    for step in range(1, steps + 1):
        if at >= len(order):
            order, at = rng.permutation(len(rows)), 0
        _, gradient = loss_and_gradient(weights, rows[order[at : at + BATCH]])
        at += BATCH
        now = rate * (0.05 + 0.95 * (1 - step / steps)) * min(1, step / 30)
        mean *= DECAYS[0]
        square *= DECAYS[1]
        np.multiply(gradient, 1 - DECAYS[0], out=change)
        mean += change
        gradient *= gradient
        gradient *= 1 - DECAYS[1]
        square += gradient
        # The means are divided by what their first steps lack, all in one factor.
        lack = (1 - DECAYS[1] ** step) ** 0.5
        np.sqrt(square, out=change)
        change += 1e-8 * lack
        np.divide(mean, change, out=change)
        change *= now * lack / (1 - DECAYS[0] ** step)
        weights -= change
    return weights
