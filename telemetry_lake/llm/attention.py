"""A small causal self-attention model in numpy: one layer, forward and backward.

The output is a softmax in two steps, first the group of the next unit, then the unit
within its group, so that each token pays for GROUPS + MEMBERS scores and not for all
units.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

GROUPS = MEMBERS = 32
UNITS = GROUPS * MEMBERS
# Input unit that stands before a text.
START = UNITS
WIDTH = 24
# Targets of a window.
WINDOW = 32
# A target that is not there, after a text's end.
NONE = -1

Parameters = dict[str, np.ndarray]


SHAPES = {
    "embed": (UNITS + 1, WIDTH),
    "place": (WINDOW, WIDTH),
    "qkv": (WIDTH, 3 * WIDTH),
    "out": (WIDTH, WIDTH),
    "group": (WIDTH, GROUPS),
    "group_bias": (GROUPS,),
    "unit": (GROUPS, WIDTH, MEMBERS),
    "unit_bias": (GROUPS, MEMBERS),
}
# Counts that each pair of units gets beforehand, shared out by the second one's frequency,
# and the bound of a pair's log ratio.
PRIOR, RATIO_BOUND = 20.0, 4.0


def start(counts: np.ndarray, pairs: np.ndarray) -> Parameters:
    """Parameters before training, from how often units, and pairs of neighbours, occur.

    The biases give each unit its share. The embeddings and output weights are the best
    low-rank fit (by singular values, weighted by frequency) of how much a unit before
    changes the odds of a group, and of a unit in its group. The rest is small noise.
    """
    noise = np.random.default_rng(1)
    p = {name: noise.normal(0, 0.1, shape).astype(np.float32) for name, shape in SHAPES.items()}
    p["out"] *= np.float32(0.1)
    p["place"] *= np.float32(0.1)
    share = (counts.astype(np.float64) + 0.5) / (counts + 0.5).sum()
    before = pairs.sum(axis=1, keepdims=True)
    given = ((pairs + PRIOR * share) / (before + PRIOR)).reshape(UNITS + 1, GROUPS, MEMBERS)
    share = share.reshape(GROUPS, MEMBERS)
    group, group_given = share.sum(axis=1), given.sum(axis=2)
    p["group_bias"] = np.log(group).astype(np.float32)
    p["unit_bias"] = np.log(share / group[:, None]).astype(np.float32)
    by_unit = np.log(given / group_given[:, :, None]) - np.log(share / group[:, None])
    by_group = np.log(group_given / group)
    ratios = np.concatenate([by_unit.reshape(UNITS + 1, UNITS), by_group], axis=1).clip(-RATIO_BOUND, RATIO_BOUND)
    rows = np.sqrt((before + 1) / (before + 1).sum())
    columns = np.sqrt(np.concatenate([share.ravel(), group]))
    left, values, right = np.linalg.svd(rows * ratios * columns, full_matrices=False)
    root = np.sqrt(values[:WIDTH])
    embed, output = left[:, :WIDTH] * root / rows, root[:, None] * right[:WIDTH] / columns
    scale = ((embed**2).mean() / max((output**2).mean(), 1e-12)) ** 0.25 or 1.0
    embed, output = embed / scale, output * scale
    p["embed"] = embed.astype(np.float32)
    p["unit"] = np.ascontiguousarray(output[:, :UNITS].reshape(WIDTH, GROUPS, MEMBERS).transpose(1, 0, 2), dtype=np.float32)
    p["group"] = output[:, UNITS:].astype(np.float32)
    return p


# Scores are kept below this bound, so that exponentials need no maximum taken off first,
# and their sums above the least, so that logarithms stay finite.
BOUND, LEAST = np.float32(60), np.float32(1e-30)
# No sum below this has a term that the bound would have changed.
_SURE = np.float32(np.exp(59.0))
_CAUSAL = np.tril(np.ones((WINDOW, WINDOW), dtype=np.float32))
_ONES = np.ones(max(WINDOW, GROUPS, MEMBERS), dtype=np.float32)
# Hidden states to be scored carry a one at their end, for the biases.
WIDE = WIDTH + 1
SCALE = WIDTH**-0.5


def _sums(rows: np.ndarray) -> np.ndarray:
    """Row sums, by a product with ones, which is faster along short rows."""
    out = rows @ _ONES[: rows.shape[-1]].astype(rows.dtype, copy=False)
    out += rows.dtype.type(LEAST)
    return out


def _exponentials(left: np.ndarray, right: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Of the scores left @ right, in `out`; returns their sums. The bound is only applied where a sum shows that it may matter."""
    np.matmul(left, right, out=out)
    with np.errstate(over="ignore"):
        np.exp(out, out=out)
    sums = _sums(out)
    if not sums.max(initial=0) < _SURE:
        np.matmul(left, right, out=out)
        np.exp(np.minimum(out, BOUND, out=out), out=out)
        sums = _sums(out)
    return sums


def _weights(q: np.ndarray, k: np.ndarray, causal: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Causal weights, not yet divided by their sums, in `out`; returns one over the sums."""
    flat = out.reshape(-1, WINDOW)
    np.matmul(q, k.transpose(0, 2, 1), out=out)
    with np.errstate(over="ignore", invalid="ignore"):
        np.exp(out, out=out)
        out *= causal
        sums = _sums(flat)
    if not sums.max(initial=0) < _SURE:
        np.matmul(q, k.transpose(0, 2, 1), out=out)
        np.exp(np.minimum(out, BOUND, out=out), out=out)
        out *= causal
        sums = _sums(flat)
    return (1 / sums)[:, None]


def _parts(qkv: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Views of q, k and v by window."""
    own = qkv.reshape(-1, WINDOW, 3 * WIDTH)
    return own[..., :WIDTH], own[..., WIDTH : 2 * WIDTH], own[..., 2 * WIDTH :]


def _by_group(targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """Order of the targets by group, and each group's slice of it."""
    groups = (targets // MEMBERS).astype(np.uint8)  # sorted by counting, as they are so small
    stops = np.bincount(groups, minlength=GROUPS).cumsum().tolist()
    slices = [(g, slice(a, b)) for g, (a, b) in enumerate(zip([0, *stops], stops, strict=False)) if a < b]
    return groups.argsort(kind="stable"), slices


def _scaled(qkv: np.ndarray) -> np.ndarray:
    """Projections to scaled q, k and v."""
    out = qkv.copy()
    out[:, :WIDTH] *= qkv.dtype.type(SCALE)
    return out


class Reader:
    """Log probabilities under fixed parameters, with all products that can be made beforehand.

    Hidden states and scores of groups are made window by window, in pieces that fit the cache;
    scores within groups for OUTPUT_ROWS at once, which shares the work of going through the groups.
    """

    def __init__(self, p: Parameters):
        # One head: mixing values and then mapping them out is mixing values mapped out before.
        projections = _scaled(p["qkv"])
        projections[:, 2 * WIDTH :] = p["qkv"][:, 2 * WIDTH :] @ p["out"]
        # States are sums of a unit's and a place's row, and so is all that is linear in them.
        # Rows have room behind the values, as states do for the ones.
        self.of_unit, self.of_place = (np.pad(p[name] @ projections, ((0, 0), (0, 1))) for name in ("embed", "place"))
        self.embed, self.place = (np.pad(p[name], ((0, 0), (0, 1))) for name in ("embed", "place"))
        self.causal = _CAUSAL.astype(projections.dtype)
        self.group = np.concatenate([p["group"], p["group_bias"][None]])
        self.unit = np.concatenate([p["unit"], p["unit_bias"][:, None]], axis=1)
        self.hidden: list[np.ndarray] = []
        self.targets: list[np.ndarray] = []
        self.logs: list[np.ndarray] = []
        self.rows = 0

    def _states(self, inputs: np.ndarray, first: int) -> np.ndarray:
        """Hidden states, each with a one behind, of the places from `first` on."""
        n = len(inputs)
        all_ = self.of_unit.take(inputs, axis=0, mode="clip")
        all_ += self.of_place
        weights = np.empty((n, WINDOW - first, WINDOW), dtype=all_.dtype)
        out = np.empty((n, WINDOW - first, WIDE), dtype=all_.dtype)
        over = _weights(all_[:, first:, :WIDTH], all_[..., WIDTH : 2 * WIDTH], self.causal[first:], weights)
        np.matmul(weights, all_[..., 2 * WIDTH :], out=out)
        out *= over.reshape(n, -1, 1)
        out[..., -1] = 1
        x = self.embed.take(inputs[:, first:], axis=0, mode="clip")
        x += self.place[first:]
        out += x
        return out.reshape(-1, WIDE)

    def add(self, inputs: np.ndarray, targets: np.ndarray, wanted: np.ndarray) -> None:
        """Windows of input units, their targets, and which of these are wanted."""
        first = int(wanted.any(axis=0).argmax())
        hidden = self._states(inputs, first).take(np.flatnonzero(wanted[:, first:]), axis=0)
        own = targets[wanted]
        scores = np.empty((len(own), GROUPS), dtype=hidden.dtype)
        sums = _exponentials(hidden, self.group, scores)
        picked = scores.ravel().take(np.arange(0, scores.size, GROUPS) + own // MEMBERS)
        self.hidden.append(hidden)
        self.targets.append(own)
        self.logs.append(self._log(picked, sums, hidden, lambda at: self.group.T[own[at] // MEMBERS]))
        self.rows += len(own)

    @staticmethod
    def _log(picked: np.ndarray, sums: np.ndarray, hidden: np.ndarray, columns: Callable) -> np.ndarray:
        """Logarithms of shares of sums; where an exponential is too small to tell, its score is made again from its column."""
        with np.errstate(divide="ignore"):
            out = np.log(picked)
        small = np.flatnonzero(picked < LEAST)
        if len(small):
            out[small] = (hidden[small] * columns(small)).sum(axis=1)
        out -= np.log(sums)
        return out

    def take(self) -> np.ndarray:
        """Log probabilities of the wanted targets since the last call, in their order."""
        hidden, own, out = np.concatenate(self.hidden), np.concatenate(self.targets), np.concatenate(self.logs)
        self.hidden, self.targets, self.logs, self.rows = [], [], [], 0
        order, groups = _by_group(own)
        hidden, member = hidden.take(order, axis=0), own[order] % MEMBERS
        more = np.empty(len(own), dtype=out.dtype)
        scores = np.empty((max((part.stop - part.start for _, part in groups), default=0), MEMBERS), dtype=out.dtype)
        steps = np.arange(0, scores.size, MEMBERS)
        for g, part in groups:
            state, mine = hidden[part], member[part]
            here = scores[: len(state)]
            sums = _exponentials(state, self.unit[g], here)
            picked = here.ravel().take(steps[: len(state)] + mine)
            more[part] = self._log(picked, sums, state, lambda at, g=g, mine=mine: self.unit[g].T[mine[at]])
        out[order] += more
        return out


# Hidden states that are scored at once.
OUTPUT_ROWS = 1 << 15


def log_probabilities(p: Parameters, inputs: np.ndarray, targets: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Natural log probability of each wanted target, in the order of `wanted`'s true cells."""
    reader = Reader(p)
    reader.add(inputs, targets, wanted)
    return reader.take()


# As SHAPES, with biases as a last row of the weights.
_LAID = {name: SHAPES[name] for name in ("embed", "place", "qkv", "out")} | {"group": (WIDE, GROUPS), "unit": (GROUPS, WIDE, MEMBERS)}


class Trainer:
    """Parameters, and their gradient over a batch, each in one array; working arrays are made once and used again."""

    def __init__(self, p: Parameters, windows: int):
        self.dtype = p["embed"].dtype
        self.all, self.p = self._laid()
        self.gradient, self.g = self._laid()
        for name, value in self.named(self.p).items():
            value[:] = p[name]
        rows = windows * WINDOW
        widths = dict.fromkeys(("x", "mixed", "mapped", "d_hidden", "d_mixed", "d_x"), WIDTH) | dict.fromkeys(("hidden", "state", "back", "more"), WIDE)
        widths |= {"qkv": 3 * WIDTH, "d_qkv": 3 * WIDTH, "weights": WINDOW, "d_weights": WINDOW, "by_group": GROUPS, "by_unit": MEMBERS}
        self.held = {name: np.empty((rows, width), dtype=self.dtype) for name, width in widths.items()}
        self.held["hidden"][:, WIDTH] = 1
        self.causal = _CAUSAL.astype(self.dtype)
        self.ones = np.ones(WIDTH, dtype=self.dtype)

    def _laid(self) -> tuple[np.ndarray, Parameters]:
        sizes = [int(np.prod(shape)) for shape in _LAID.values()]
        flat = np.zeros(sum(sizes), dtype=self.dtype)
        parts = np.split(flat, np.cumsum(sizes)[:-1])
        return flat, {name: part.reshape(shape) for (name, shape), part in zip(_LAID.items(), parts, strict=True)}

    @staticmethod
    def named(laid: Parameters) -> Parameters:
        """Views by the names and shapes of SHAPES."""
        group, unit = laid["group"], laid["unit"]
        biased = {"group": group[:WIDTH], "group_bias": group[WIDTH], "unit": unit[:, :WIDTH], "unit_bias": unit[:, WIDTH]}
        return {name: laid[name] for name in ("embed", "place", "qkv", "out")} | biased

    def gradients(self, inputs: np.ndarray, targets: np.ndarray) -> int:
        """Makes the mean gradient of the negative log probability over the targets that are there; returns how many are."""
        n = len(inputs)
        rows = n * WINDOW
        a = {name: value[:rows] for name, value in self.held.items()}
        p, g = self.p, self.g
        inputs, targets = inputs.ravel(), targets.ravel()
        # Forward.
        projections = _scaled(p["qkv"])
        x, qkv, mixed, mapped, hidden = (a[name] for name in ("x", "qkv", "mixed", "mapped", "hidden"))
        p["embed"].take(inputs, axis=0, out=x, mode="clip")
        by_window = x.reshape(n, WINDOW, WIDTH)
        by_window += p["place"]
        np.matmul(x, projections, out=qkv)
        q, k, v = _parts(qkv)
        weights = a["weights"].reshape(n, WINDOW, WINDOW)
        over = _weights(q, k, self.causal, weights)
        np.matmul(weights, v, out=mixed.reshape(n, WINDOW, WIDTH))
        mixed *= over
        np.matmul(mixed, p["out"], out=mapped)
        np.add(mapped, x, out=hidden[:, :WIDTH])
        # Targets lie by group, so a group's products are of slices; all else is done at once.
        there = (targets != NONE).nonzero()[0]
        order, groups = _by_group(targets.take(there))
        there = there.take(order)
        own, many = targets.take(there), len(there)
        scale = self.dtype.type(1 / max(1, many))
        state, back, more, error, error2 = (a[name][:many] for name in ("state", "back", "more", "by_group", "by_unit"))
        hidden.take(there, axis=0, out=state, mode="clip")
        steps = np.arange(0, many * GROUPS, GROUPS)
        sums = _exponentials(state, p["group"], error)
        error *= (scale / sums)[:, None]
        error.ravel()[steps + own // MEMBERS] -= scale
        np.matmul(state.T, error, out=g["group"])
        np.matmul(error, p["group"].T, out=back)
        for number, part in groups:
            np.matmul(state[part], p["unit"][number], out=error2[part])
        with np.errstate(over="ignore"):
            np.exp(error2, out=error2)
        sums = _sums(error2)
        if not sums.max(initial=0) < _SURE:
            for number, part in groups:
                np.matmul(state[part], p["unit"][number], out=error2[part])
            np.exp(np.minimum(error2, BOUND, out=error2), out=error2)
            sums = _sums(error2)
        error2 *= (scale / sums)[:, None]
        error2.ravel()[steps + own % MEMBERS] -= scale
        if len(groups) < GROUPS:
            g["unit"][:] = 0
        for number, part in groups:
            mine = error2[part]
            np.matmul(state[part].T, mine, out=g["unit"][number])
            np.matmul(mine, p["unit"][number].T, out=more[part])
        # Backward.
        back += more
        d_hidden, d_mixed, d_qkv, d_x = (a[name] for name in ("d_hidden", "d_mixed", "d_qkv", "d_x"))
        if many < rows:
            d_hidden[:] = 0
        d_hidden[there] = back[:, :WIDTH]
        np.matmul(mixed.T, d_hidden, out=g["out"])
        np.matmul(d_hidden, p["out"].T, out=d_mixed)
        d_mixed *= over
        # What a softmax's gradient takes off a row is the row's own product with the mixed values.
        common = np.multiply(d_mixed, mixed, out=d_x) @ self.ones
        d_wide = d_mixed.reshape(n, WINDOW, WIDTH)
        d_scores = a["d_weights"].reshape(n, WINDOW, WINDOW)
        np.matmul(d_wide, v.transpose(0, 2, 1), out=d_scores)
        d_scores -= common.reshape(n, WINDOW, 1)
        d_scores *= weights
        d_q, d_k, d_v = _parts(d_qkv)
        np.matmul(d_scores, k, out=d_q)
        np.matmul(d_scores.transpose(0, 2, 1), q, out=d_k)
        np.matmul(weights.transpose(0, 2, 1), d_wide, out=d_v)
        np.matmul(x.T, d_qkv, out=g["qkv"])
        g["qkv"][:, :WIDTH] *= self.dtype.type(SCALE)  # q was scaled
        np.matmul(d_qkv, projections.T, out=d_x)
        d_x += d_hidden
        np.sum(d_x.reshape(n, WINDOW, WIDTH), axis=0, out=g["place"])
        order = inputs.astype(np.uint16).argsort(kind="stable")
        units = inputs.take(order)
        firsts = np.append(0, (units[1:] != units[:-1]).nonzero()[0] + 1)
        g["embed"][:] = 0
        g["embed"][units[firsts]] = np.add.reduceat(d_x.take(order, axis=0), firsts)
        return many


def gradients(p: Parameters, inputs: np.ndarray, targets: np.ndarray) -> Parameters:
    """Mean gradient of the negative log probability over the targets that are there."""
    trainer = Trainer(p, len(inputs))
    trainer.gradients(inputs, targets)
    return Trainer.named(trainer.g)


class Adam:
    """The usual moment estimates, in place; kept without their constant factors."""

    def __init__(self, p: Parameters, rate: float):
        self.p, self.rate, self.steps = p, rate, 0
        self.mean = {name: np.zeros_like(value) for name, value in p.items()}
        self.square = {name: np.zeros_like(value) for name, value in p.items()}
        self.work = {name: np.empty_like(value) for name, value in p.items()}

    def step(self, g: Parameters) -> None:
        self.steps += 1
        rate = self.rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        for name, value in self.p.items():
            mean, square, work = self.mean[name], self.square[name], self.work[name]
            mean *= np.float32(0.9)
            mean += g[name]
            square *= np.float32(0.99)
            square += np.multiply(g[name], g[name], out=work)
            # Factors of 0.1 and 0.01 are left out of the sums: the first stays, as 0.1 / sqrt(0.01) is 1.
            np.sqrt(square, out=work)
            work += np.float32(1e-7)
            np.divide(mean, work, out=work)
            work *= np.float32(rate)
            value -= work


def flatten(p: Parameters) -> np.ndarray:
    return np.concatenate([p[name].ravel() for name in SHAPES])


def unflatten(values: np.ndarray) -> Parameters:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = values[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out
