"""A small causal self-attention model in numpy: one layer, one head, class outputs in two steps.

Inputs are numbers below ``inputs``; outputs are class numbers. A position's state is its embedding (with its place in
the window) plus what it attends to at itself and before. Classes lie in groups of ``GROUP``: a softmax of the state gives the
group of the next token's class, and a second one, of the group's own, the class within it. So a position costs
classes / GROUP + GROUP outputs in place of all classes.
"""

from __future__ import annotations

import numpy as np

NAMES = ("embed", "place", "qkv", "out", "top", "top_bias", "sub", "sub_bias")
GROUP = 16
ADAM_PART = 1 << 13
PRODUCT_ROWS = 96


def initial(inputs: int, classes: int, width: int, window: int, seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: (rng.standard_normal(shape) * 0.08).astype(np.float32)
    groups = -(-classes // GROUP)
    none = lambda *shape: np.zeros(shape, np.float32)
    places = none(groups, GROUP)
    places.ravel()[classes:] = -30  # the last group's places that no class has
    return {"embed": draw(inputs, width), "place": draw(window, width), "qkv": draw(width, 3 * width), "out": draw(width, width), "top": draw(width, groups), "top_bias": none(groups), "sub": draw(groups, width, GROUP), "sub_bias": places}


def start_from_shares(model: dict[str, np.ndarray], mass: np.ndarray) -> None:
    """Without context, the classes' own shares; places in the last group that no class has are left all but impossible."""
    shares = np.zeros(model["sub_bias"].size)
    shares[: len(mass)] = np.maximum(mass, 1e-9)
    shares = np.maximum(shares.reshape(model["sub_bias"].shape), 1e-13)
    model["top_bias"][:] = np.log(shares.sum(axis=1))
    model["sub_bias"][:] = np.log(shares / shares.sum(axis=1, keepdims=True))


def flat(model: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([model[n].ravel() for n in NAMES])


def shaped(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return {n: x.astype(np.float32) for n, x in _views(values, like).items()}


def _views(values: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for n in NAMES:
        out[n] = values[at : at + like[n].size].reshape(like[n].shape)
        at += like[n].size
    return out


_scratch: dict[str, np.ndarray] = {}


def _buffer(name: str, *shape: int) -> np.ndarray:
    """A float32 array that is used again from call to call: fresh large ones cost more in page faults than the sums in them."""
    n = int(np.prod(shape))
    if name not in _scratch or _scratch[name].size < n:
        _scratch[name] = np.empty(n, np.float32)
    return _scratch[name][:n].reshape(shape)


def _row_sums(x: np.ndarray) -> np.ndarray:
    """Sums along the last axis, as a product, which costs a tenth of numpy's own sum of short rows."""
    return np.matmul(x.reshape(-1, x.shape[-1]), np.ones(x.shape[-1], np.float32)).reshape(x.shape[:-1])


def _product_of_columns(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """x.T @ y of many rows, part by part: twice as fast as the whole at once."""
    cut = len(x) - len(x) % PRODUCT_ROWS
    parts = np.matmul(x[:cut].reshape(-1, PRODUCT_ROWS, x.shape[1]).transpose(0, 2, 1), y[:cut].reshape(-1, PRODUCT_ROWS, y.shape[1]))
    return parts.sum(axis=0) + x[cut:].T @ y[cut:]


def _attention(q: np.ndarray, k: np.ndarray, first: int = 0, places: np.ndarray | None = None) -> np.ndarray:
    """How much each position from ``first`` on (a row of scaled ``q``) attends to each of its window; ``places`` is what keys
    hold besides ``k``, of all windows alike."""
    b, w, d = k.shape
    s = np.matmul(q, k.transpose(0, 2, 1), out=_buffer("s", b, w - first, w))
    if places is not None:
        s += np.matmul(q.reshape(-1, d), places.T, out=_buffer("by_place", b * (w - first), w)).reshape(s.shape)
    np.clip(s, -30, 30, out=s)
    np.exp(s, out=s)
    s.reshape(b, -1)[:] *= np.tril(np.ones((w, w), np.float32))[first:].ravel()  # no position sees a later one
    s /= _row_sums(s)[:, :, None]
    return s


def _folded(m: dict[str, np.ndarray]) -> np.ndarray:
    """What states (with ones) are multiplied by to be queries, keys being the states themselves, and by what to be values (with
    ones) that are added to the state as they are: queries times keys, scaled, and values times ``out``. So a position pays for two
    products in place of four."""
    d = len(m["qkv"])
    q, k, v = (m["qkv"][:, n * d : (n + 1) * d].astype(np.float64) for n in range(3))
    out = np.zeros((2, d + 1, d + 1))
    out[0, :d, :d], out[1, :d, :d], out[1, d, d] = q @ k.T * d**-0.5, v @ m["out"], 1
    return np.concatenate(out, axis=1)


def _ones_beside(x: np.ndarray, value: float) -> np.ndarray:
    """Rows with one more place, of this value: by a one, biases are a matrix's last row. Whole rows are summed faster than parts of rows."""
    return np.concatenate([x, np.full((len(x), 1), value, x.dtype)], axis=1)


def prepared(m: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """A model that is only asked: what each input and each place adds to a position's query, own state (and key) and value,
    so that these are looked up and not multiplied anew for every position."""
    d, folded, out = m["embed"].shape[1], _folded(m), {}
    each = {"query": folded[:, : d + 1], "state": np.eye(d + 1), "value": folded[:, d + 1 :]}
    for name, weights in each.items():
        for part, one in (("embed", 1), ("place", 0)):
            out[f"{name}_{part}"] = (_ones_beside(m[part].astype(np.float64), one) @ weights).astype(np.float32)
    return m | out | {"heads": _heads(m)}


def _heads(m: dict[str, np.ndarray]) -> np.ndarray:
    """Of each group the matrix that gives a state's outputs for all groups and for the group's own classes. A state's last place is
    two, one by itself and one by what it attends to, so biases are halved."""
    groups, d, _ = m["sub"].shape
    out = np.empty((groups, d + 1, groups + GROUP), np.float32)
    out[:, :d, :groups], out[:, d, :groups] = m["top"], m["top_bias"] / 2
    out[:, :d, groups:], out[:, d, groups:] = m["sub"], m["sub_bias"] / 2
    return out


def _outputs(heads: np.ndarray, state: np.ndarray, targets: np.ndarray):
    """States by group of their targets: that order, the groups' bounds, the states in it, their two softmaxes side by
    side before division, the sums of these, what summed them, and the targets' places in both."""
    groups, _, both = heads.shape
    group = (targets // GROUP).astype(np.uint8 if groups <= 256 else np.int32)
    order = np.argsort(group, kind="stable")
    bounds = np.searchsorted(group[order], np.arange(groups + 1)).tolist()
    own = np.take(state, order, axis=0, out=_buffer("own", *state.shape), mode="clip")
    found = _buffer("found", len(state), both)
    for g in range(groups):
        a, b = bounds[g], bounds[g + 1]
        if b > a:
            np.matmul(own[a:b], heads[g], out=found[a:b])
    np.clip(found, -30, 30, out=found)
    np.exp(found, out=found)
    halves = np.zeros((both, 2), np.float32)
    halves[:groups, 0] = halves[groups:, 1] = 1
    at, rows = targets[order], np.arange(len(state)) * both
    places = rows + at // GROUP, rows + (groups + at % GROUP)
    return order, bounds, own, found, np.matmul(found, halves, out=_buffer("sums", len(state), 2)), halves, places


def log_probabilities(m: dict[str, np.ndarray], ids: np.ndarray, targets: np.ndarray, first: int) -> np.ndarray:
    """log P(target class) at the positions from ``first`` on of each window; of a ``prepared`` model, or one to be prepared."""
    m = m if "heads" in m else prepared(m)
    b, w = ids.shape
    d = m["heads"].shape[1]
    asked = np.take(m["query_embed"], ids[:, first:].ravel(), axis=0)
    states, values = (np.take(m[f"{name}_embed"], ids.ravel(), axis=0, out=_buffer(name, ids.size, d), mode="clip").reshape(b, w, d) for name in ("state", "value"))
    return _log_probabilities(m, asked.reshape(b, -1), states, states[:, first:].reshape(b, -1), values, targets[:, first:])


def sliding_log_probabilities(m: dict[str, np.ndarray], ids: np.ndarray, targets: np.ndarray, window: int, stride: int) -> np.ndarray:
    """log P(target class) at the last ``stride`` positions of each window that begins at a multiple of ``stride`` in flat ``ids``: as
    ``log_probabilities``, but each id is looked up once for all windows that hold it."""
    m = m if "heads" in m else prepared(m)
    n, first, d = (len(ids) - window) // stride + 1, window - stride, m["heads"].shape[1]
    scored = slice(first, first + n * stride)
    asked = np.take(m["query_embed"], ids[scored], axis=0, out=_buffer("query", n * stride, d), mode="clip")
    states, values = (np.take(m[f"{name}_embed"], ids, axis=0, out=_buffer(name, len(ids), d), mode="clip") for name in ("state", "value"))
    keys, held = (np.lib.stride_tricks.as_strided(x, (n, window, d), (stride * x.strides[0], *x.strides), writeable=False) for x in (states, values))
    return _log_probabilities(m, asked.reshape(n, -1), keys, states[scored].reshape(n, -1), held, targets[scored].reshape(n, stride))


def _log_probabilities(m: dict[str, np.ndarray], asked: np.ndarray, keys: np.ndarray, states: np.ndarray, values: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Of what the inputs add to windows and to their last positions; what the places add is the same in all windows, and comes here."""
    (b, t), (_, w, d) = targets.shape, keys.shape
    q = np.add(asked, m["query_place"][w - t : w].ravel(), out=_buffer("q", b, t * d)).reshape(b, t, d)
    s = _attention(q, keys, w - t, m["state_place"][:w])
    state = np.matmul(s, values, out=_buffer("mixed", b, t, d)).reshape(b, -1)
    state += np.matmul(s.reshape(-1, w), m["value_place"][:w], out=_buffer("through", b * t, d)).reshape(b, -1)
    state += states
    state += m["state_place"][w - t : w].ravel()
    order, _, _, found, sums, _, places = _outputs(m["heads"], state.reshape(b * t, d), targets.ravel())
    logs = np.empty(b * t, np.float32)
    logs[order] = np.log(np.take(found, places[0]) * np.take(found, places[1]) / (sums[:, 0] * sums[:, 1]))
    return logs.reshape(b, t)


def _wide(m: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return m | {"embed": _ones_beside(m["embed"], 1), "place": _ones_beside(m["place"], 0)}


def _narrow(m: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    return m | {"embed": m["embed"][:, :-1], "place": m["place"][:, :-1]}


def gradients(m: dict[str, np.ndarray], ids: np.ndarray, targets: np.ndarray, counted: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss over the counted positions, and its gradient."""
    wide = _wide(m)
    g = {n: np.empty_like(wide[n]) for n in NAMES}
    return _gradients(wide, ids, targets, counted, g, True), _narrow(g)


def _gradients(m: dict[str, np.ndarray], ids: np.ndarray, targets: np.ndarray, counted: np.ndarray, g: dict[str, np.ndarray], with_loss: bool = False) -> float:
    """Writes the gradient of a model with ones beside its embeddings to ``g``. What lies in the last place of rows has no
    slope that anything takes."""
    b, w = ids.shape
    n, d = b * w, m["embed"].shape[1]
    width, fed = d - 1, ids.ravel()
    x = np.take(m["embed"], fed, axis=0, out=_buffer("x", n, d), mode="clip")
    x.reshape(b, w * d)[:] += m["place"][:w].ravel()
    folded, by_window = _folded(m).astype(np.float32), (b, w, d)
    held = np.matmul(x, folded, out=_buffer("held", n, 2 * d)).reshape(b, w, 2 * d)
    q, values, x = held[:, :, :d], held[:, :, d:], x.reshape(by_window)
    s = _attention(q, x)
    mixed = np.matmul(s, values, out=_buffer("mixed", *by_window))
    state = np.add(mixed, x, out=_buffer("state", *by_window)).reshape(n, d)
    heads, weight = _heads(m), counted.ravel().astype(np.float32) / np.float32(max(1, counted.sum()))
    order, bounds, own, found, sums, halves, places = _outputs(heads, state, targets.ravel())
    weight, groups = weight[order], len(heads)
    loss, flat_found = 0.0, found.reshape(-1)
    if with_loss:
        loss = -float(sum((np.log(np.maximum(flat_found[at] / part, 1e-20)) * weight).sum() for at, part in zip(places, sums.T)))
    found *= np.matmul(weight[:, None] / sums, halves.T, out=_buffer("shares", *found.shape))
    for at in places:
        flat_found[at] -= weight
    g_heads, d_own = np.zeros_like(heads), _buffer("d_own", n, d)
    heads[:, width] = 0
    for k in range(groups):
        lo, hi = bounds[k], bounds[k + 1]
        if hi > lo:
            np.matmul(own[lo:hi].T, found[lo:hi], out=g_heads[k])
            np.matmul(found[lo:hi], heads[k].T, out=d_own[lo:hi])
    g_heads[:, width] /= 2
    top = g_heads[:, :, :groups].sum(axis=0)
    g["top"][:], g["top_bias"][:], g["sub"][:], g["sub_bias"][:] = top[:width], top[width], g_heads[:, :width, groups:], g_heads[:, width, groups:]
    back = np.empty_like(order)
    back[order] = np.arange(n)
    d_state = np.take(d_own, back, axis=0, out=_buffer("d_state", n, d), mode="clip")
    taken = _row_sums(np.multiply(d_state, mixed.reshape(n, d), out=_buffer("d_own", n, d)))
    np.negative(taken, out=d_state[:, width])  # what the division of s by its sums takes back, by the values' ones
    d_mixed = d_state.reshape(by_window)
    d_s = np.matmul(d_mixed, values.transpose(0, 2, 1), out=_buffer("d_s", b, w, w))
    d_s *= s
    d_held = _buffer("d_held", b, w, 2 * d)
    np.matmul(d_s, x, out=d_held[:, :, :d])
    np.matmul(s.transpose(0, 2, 1), d_mixed, out=d_held[:, :, d:])
    d_held = d_held.reshape(n, 2 * d)
    d_x = np.matmul(d_held, folded.T, out=_buffer("d_x", n, d))
    d_x += d_state
    d_x += np.matmul(d_s.transpose(0, 2, 1), q, out=_buffer("d_k", *by_window)).reshape(n, d)
    g_folded, (of_q, of_k, of_v) = _product_of_columns(x.reshape(n, d), d_held)[:width], (m["qkv"][:, k * width : (k + 1) * width] for k in range(3))
    g_scores, g_values = g_folded[:, :width] * np.float32(width**-0.5), g_folded[:, d : d + width]
    np.concatenate([g_scores @ of_k, g_scores.T @ of_q, g_values @ m["out"].T], axis=1, out=g["qkv"])
    np.matmul(of_v.T, g_values, out=g["out"])
    g["place"][:] = 0
    d_x[:, width] = 0
    g["place"][:w] = np.matmul(np.ones(b, np.float32), d_x.reshape(b, w * d)).reshape(w, d)
    g["embed"][:] = 0
    order = np.argsort(fed.astype(np.uint16 if len(m["embed"]) <= 65536 else np.int32), kind="stable")
    fed = fed[order]
    opens = np.flatnonzero(np.concatenate([[True], fed[1:] != fed[:-1]]))
    g["embed"][fed[opens]] = np.add.reduceat(np.take(d_x, order, axis=0, out=_buffer("d_own", n, d), mode="clip"), opens)
    return loss


def train(m: dict[str, np.ndarray], ids: np.ndarray, targets: np.ndarray, counted: np.ndarray, batch: int = 64, rate: float = 3e-3, seed: int = 1) -> dict[str, np.ndarray]:
    """One pass over the windows by Adam. All numbers lie in one array, their slopes in another, so that a step's sums are made in
    place, a part at a time that stays in the processor's caches. ``first`` and ``second`` are Adam's means before the factors
    0.1 and 0.01, which the step's rate takes in."""
    m = _wide(m)
    now = flat(m)
    slopes, first, second = np.zeros_like(now), np.zeros_like(now), np.zeros_like(now)
    views, into = _views(now, m), _views(slopes, m)
    part = np.empty(min(len(now), ADAM_PART), np.float32)
    order = np.random.default_rng(seed).permutation(len(ids))
    for step, a in enumerate(range(0, len(order), batch), 1):
        pick = order[a : a + batch]
        _gradients(views, ids[pick], targets[pick], counted[pick], into)
        root = (0.01 / (1 - 0.99**step)) ** 0.5
        scale, least = rate * 0.1 / (1 - 0.9**step) / root, 1e-8 / root
        for lo in range(0, len(now), ADAM_PART):
            g, f, s, n = (x[lo : lo + ADAM_PART] for x in (slopes, first, second, now))
            p = part[: len(g)]
            f *= 0.9
            f += g
            s *= 0.99
            s += np.multiply(g, g, out=p)
            np.sqrt(s, out=p)
            p += least
            np.divide(f, p, out=p)
            p *= scale
            n -= p
    return _narrow(views)


def windows(lengths: np.ndarray, window: int, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, first position) of the windows over texts of these numbers of positions: the last ones reach the end."""
    n = 1 + np.maximum(0, -(-(lengths - window) // stride))
    text = np.repeat(np.arange(len(lengths)), n)
    number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    return text, number * stride
