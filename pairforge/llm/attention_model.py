"""A small causal self-attention model over subword ids, in numpy.

Every frequent subword has an embedding of its own; rare ones share rows by class and id.
One head of causal self-attention mixes the embeddings of a window. The next subword is
predicted in three steps, so that no step compares it with the whole vocabulary:

* one of 16 groups of classes, and
* one of the 16 classes of that group, both from the attention head on top of the counts
  of classes after the class before, over the whole training corpus;
* a frequent subword is a class alone. Another one has its share of the class by counts
  over the whole corpus, as it follows the class before it, smoothed by its overall share.

Texts are read in windows of CONTEXT + SCORED positions which overlap by CONTEXT; a window
scores its last SCORED positions only, so every position is scored once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

GROUPS, MEMBERS = 16, 16
CLASSES, BANDS, WIDTH = GROUPS * MEMBERS, 8, 8
CONTEXT, SCORED = 8, 32
WINDOW = CONTEXT + SCORED
#: Subwords with an embedding of their own, and embeddings that the others of a class share.
EMBEDDED, SHARED = 4096, 16
#: Windows that are scored, or make a step, at once.
BATCH = 512
#: Steps that some windows are split into at least, and windows of a step at least.
LEAST_STEPS, LEAST_BATCH = 40, 32
#: Weight of the overall share of a subword against its counts after a class.
SHARE_WEIGHT = 20.0
FAR = np.float32(-1e9)
#: Attention scores are kept below this by a common shift, so that exponents need none per row.
HIGHEST = 60.0


@dataclass
class Layout:
    """Class and embedding row of each subword; the last entry is the begin and end of a text.

    The last embedding row is padding.
    """

    classes: np.ndarray
    rows: np.ndarray
    row_class: np.ndarray

    def goal_classes(self, goal: np.ndarray) -> np.ndarray:
        """Classes of subwords; -1 stays."""
        return np.append(self.classes, -1).astype(np.int16).take(goal)

    @property
    def n_rows(self) -> int:
        return len(self.row_class)


def layout_of(counts: np.ndarray, starts_word: np.ndarray) -> Layout:
    """Classes and embeddings from subword counts; class 0 is the begin and end of a text."""
    size = len(counts)
    classes = np.zeros(size + 1, np.int64)
    alone = CLASSES - 1 - 2 * BANDS
    order = np.lexsort((np.arange(size), -counts))
    classes[order[:alone]] = 1 + np.arange(min(alone, size))
    rest = order[alone:]
    band = np.minimum(np.log2(np.arange(1, len(rest) + 1)).astype(int) * BANDS // 16, BANDS - 1)
    classes[rest] = 1 + alone + 2 * band + starts_word[rest]
    own = min(EMBEDDED, size)
    rows = np.zeros(size + 1, np.int64)
    rows[order[:own]] = np.arange(own)
    rare = order[own:]
    rows[rare] = own + (classes[rare] - 1 - alone) * SHARED + rare % SHARED
    end = own + 2 * BANDS * SHARED
    rows[size] = end
    row_class = np.zeros(end + 2, np.int64)
    row_class[own:end] = 1 + alone + np.arange(2 * BANDS * SHARED) // SHARED
    row_class[np.arange(own)] = classes[order[:own]]
    return Layout(classes, rows, row_class)


def windows_of(ids: np.ndarray, length: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of embedding rows, the subwords they score (-1: none), and the text of each window.

    ``ids`` has the subwords of all texts in a row. A position holds what comes before the
    subword that it scores; a text begins, and is scored to end, with the last entry.
    """
    end = len(layout.classes) - 1
    rows = layout.rows.astype(np.uint16)
    blocks = -(-(length + 1) // SCORED)
    first = (np.cumsum(blocks) - blocks) * SCORED
    text = np.repeat(np.arange(len(length)), blocks)
    place = np.arange(len(ids)) + np.repeat(first - (np.cumsum(length) - length), length)
    goal = np.full(len(text) * SCORED, -1, np.int32)
    goal[place] = ids
    goal[first + length] = end
    # Each text has CONTEXT positions of padding before it.
    shift = (np.arange(len(length)) + 1) * CONTEXT
    source = np.full(len(goal) + len(length) * CONTEXT + SCORED, layout.n_rows - 1, np.uint16)
    source[first + shift] = rows[end]
    source[place + np.repeat(shift + 1, length)] = rows.take(ids)
    start = np.repeat(shift - CONTEXT, blocks) + np.arange(len(text)) * SCORED
    return np.lib.stride_tricks.sliding_window_view(source, WINDOW)[start], goal.reshape(-1, SCORED), text


DISTANCE = np.arange(SCORED)[:, None] + CONTEXT - np.arange(WINDOW)[None, :]


def relative_bias(rel: np.ndarray) -> np.ndarray:
    """Bias by distance for scored position i and window position j; later positions are masked."""
    return np.where(DISTANCE >= 0, rel[np.maximum(DISTANCE, 0)], FAR).astype(np.float32)


@dataclass
class Priors:
    """Log probabilities by counts: of a group after a class, and of a class within its group after a class."""

    group: np.ndarray  # class before, group
    member: np.ndarray  # class before * GROUPS + group, member

    @classmethod
    def of(cls, pairs: np.ndarray) -> Priors:
        smooth = (pairs + 0.5).reshape(CLASSES, GROUPS, MEMBERS)
        groups = smooth.sum(2)
        group = np.log(groups / groups.sum(1, keepdims=True))
        member = np.log(smooth / groups[:, :, None])
        return cls(group.astype(np.float32), member.reshape(CLASSES * GROUPS, MEMBERS).astype(np.float32))


def initial(n_rows: int) -> dict[str, np.ndarray]:
    """Parameters before training. Output matrices are zero, so the model starts as the counts alone."""
    rng = np.random.default_rng(3)
    init = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
    return {
        "e": init(n_rows, WIDTH), "q": init(WIDTH, WIDTH), "k": init(WIDTH, WIDTH), "v": init(WIDTH, WIDTH),
        "group": np.zeros((WIDTH, GROUPS), np.float32), "member": np.zeros((GROUPS, WIDTH, MEMBERS), np.float32), "r": np.zeros(WINDOW, np.float32),
    }


class Forward:
    """The attention of a batch of windows, and the probabilities of what they score."""

    def __init__(self, p: dict[str, np.ndarray], tables: tuple, priors: Priors, row_class: np.ndarray, w: np.ndarray, goal: np.ndarray) -> None:
        queries, keys, values, bias = tables
        own = w[:, CONTEXT:]
        self.q, self.k, self.v = queries.take(own, axis=0), keys.take(w, axis=0), values.take(w, axis=0)
        a = self.q @ self.k.transpose(0, 2, 1)
        a += bias
        np.exp(a, out=a)
        mixed = a @ self.v
        self.a, self.total = a, mixed[:, :, WIDTH:] + np.float32(1e-30)
        self.o = (mixed[:, :, :WIDTH] / self.total).reshape(-1, WIDTH)
        # Scored positions only, those of one group together.
        goal = goal.ravel()
        scored = np.flatnonzero(goal >= 0)
        group = (goal[scored] // MEMBERS).astype(np.uint8)
        order = np.argsort(group, kind="stable")
        self.at, self.g = scored[order], group[order].astype(np.int64)
        self.m = goal[self.at] % MEMBERS
        self.cuts = np.searchsorted(self.g, np.arange(GROUPS + 1))
        before = row_class[own.ravel()[self.at]]
        self.x = self.o.take(self.at, axis=0)
        self.by_group = self.x @ p["group"]
        self.by_group += priors.group.take(before, axis=0)
        self.by_member = priors.member.take(before * GROUPS + self.g, axis=0)
        for i in range(GROUPS):
            part = slice(self.cuts[i], self.cuts[i + 1])
            self.by_member[part] += self.x[part] @ p["member"][i]

    def log_probability(self) -> np.ndarray:
        """Per position of the windows; 0 where nothing is scored."""
        line = np.arange(len(self.at)) * GROUPS
        out, ones = np.zeros(len(self.o)), np.ones(GROUPS, np.float32)
        found = self.by_group.take(line + self.g) + self.by_member.take(line + self.m)
        for z in (self.by_group, self.by_member):
            found -= np.log(np.exp(z, out=z) @ ones)
        out[self.at] = found
        return out


def tables_of(p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Queries, keys and values of every embedding row, and the bias by position.

    An extra column masks the padding row in the keys, and sums the weights in the values.
    """
    n = len(p["e"])
    one = np.ones((n, 1), np.float32)
    pad = np.zeros((n, 1), np.float32)
    pad[-1] = FAR
    queries, keys = p["e"] @ p["q"] * np.float32(WIDTH**-0.5), p["e"] @ p["k"]
    bias = relative_bias(p["r"])
    top = np.sqrt((queries**2).sum(1).max() * (keys**2).sum(1).max()) + bias.max()
    bias -= np.float32(max(0.0, top - HIGHEST))
    return np.hstack([queries, one]), np.hstack([keys, pad]), np.hstack([p["e"] @ p["v"], one]), bias


def gradients(p: dict[str, np.ndarray], priors: Priors, row_class: np.ndarray, w: np.ndarray, goal: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean loss over the scored positions of windows; ``goal`` has classes."""
    f = Forward(p, tables_of(p), priors, row_class, w, goal)
    share, line = np.float32(1 / max(1, len(f.at))), np.arange(len(f.at))
    g: dict[str, np.ndarray] = {"member": np.empty_like(p["member"])}
    for z, wanted in ((f.by_group, f.g), (f.by_member, f.m)):
        np.exp(z, out=z)
        z *= share / (z @ np.ones(GROUPS, np.float32))[:, None]
        z[line, wanted] -= share
    g["group"] = f.x.T @ f.by_group
    dx = f.by_group @ p["group"].T
    for i in range(GROUPS):
        part = slice(f.cuts[i], f.cuts[i + 1])
        g["member"][i] = f.x[part].T @ f.by_member[part]
        dx[part] += f.by_member[part] @ p["member"][i].T
    do = np.zeros_like(f.o)
    do[f.at] = dx
    inner = (do * f.o).sum(1).reshape(len(w), SCORED, 1)
    do = do.reshape(len(w), SCORED, WIDTH)
    a = f.a
    a /= f.total
    dv = a.transpose(0, 2, 1) @ do
    ds = do @ f.v[:, :, :WIDTH].transpose(0, 2, 1)
    ds -= inner
    ds *= a
    g["r"] = np.bincount(np.maximum(DISTANCE, 0).ravel(), ds.sum(0).ravel(), WINDOW).astype(np.float32)
    scale = np.float32(WIDTH**-0.5)
    dq = (ds @ f.k[:, :, :WIDTH]).reshape(-1, WIDTH) * scale
    dk = (ds.transpose(0, 2, 1) @ f.q[:, :, :WIDTH]).reshape(-1, WIDTH)
    dv = dv.reshape(-1, WIDTH)
    x = p["e"].take(w, axis=0)
    own, x = x[:, CONTEXT:].reshape(-1, WIDTH), x.reshape(-1, WIDTH)
    g["q"], g["k"], g["v"] = own.T @ dq, x.T @ dk, x.T @ dv
    de = (dk @ p["k"].T + dv @ p["v"].T).reshape(len(w), WINDOW, WIDTH)
    de[:, CONTEXT:] += (dq @ p["q"].T).reshape(len(w), SCORED, WIDTH)
    g["e"] = _sum_rows(w.ravel(), de.reshape(-1, WIDTH), len(p["e"]))
    return g


def _sum_rows(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of rows by number."""
    at = at.astype(np.int64)
    return np.stack([np.bincount(at, column, n) for column in rows.T], 1).astype(np.float32)


class Adam:
    """Steps of Adam that change parameters in place."""

    def __init__(self, p: dict[str, np.ndarray], rate: float = 0.01) -> None:
        self.p, self.rate, self.steps = p, rate, 0
        self.moments = {n: (np.zeros_like(x), np.zeros_like(x)) for n, x in p.items()}

    def step(self, g: dict[str, np.ndarray]) -> None:
        self.steps += 1
        for n, x in self.p.items():
            m, m2 = self.moments[n]
            m += np.float32(0.1) * (g[n] - m)
            m2 += np.float32(0.01) * (g[n] ** 2 - m2)
            x -= np.float32(self.rate / (1 - 0.9**self.steps)) * m / (np.sqrt(m2 * np.float32(1 / (1 - 0.99**self.steps))) + np.float32(1e-6))


def train_on(adam: Adam, priors: Priors, layout: Layout, w: np.ndarray, goal: np.ndarray) -> None:
    """Steps over all windows, each window once, in an order that mixes texts; few windows make smaller steps."""
    batch = min(BATCH, max(LEAST_BATCH, len(w) // LEAST_STEPS))
    order = np.random.default_rng(len(w)).permutation(len(w))
    goal = layout.goal_classes(goal)
    for i in range(0, len(w), batch):
        part = order[i : i + batch]
        adam.step(gradients(adam.p, priors, layout.row_class, w[part], goal[part]))


@dataclass
class Attention:
    """A trained model: parameters of the head, counts, and how often each subword follows each class."""

    layout: Layout
    p: dict[str, np.ndarray]
    priors: Priors
    share: np.ndarray  # log of a subword's overall share of its class
    after: np.ndarray  # counts by class before and subword
    totals: np.ndarray  # counts by class before and class

    def __post_init__(self) -> None:
        self.tables = tables_of(self.p)

    def within(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Log share of each subword of its class, after the class before it."""
        out = np.zeros(len(ids))
        several = np.flatnonzero(self.share[ids] < 0)
        before, ids = before[several], ids[several]
        weighted = SHARE_WEIGHT * np.exp(self.share[ids]) + self.after[before, ids]
        out[several] = np.log(weighted / (self.totals[before, self.layout.classes[ids]] + SHARE_WEIGHT))
        return out

    def score(self, ids: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Natural log probability of each text; ``ids`` has the subwords of all texts in a row."""
        total = np.zeros(len(length))
        if not len(length):
            return total
        windows, goals, text = windows_of(ids, length, self.layout)
        for i in range(0, len(windows), BATCH):
            w, goal = windows[i : i + BATCH], goals[i : i + BATCH]
            scored = goal >= 0
            classes = self.layout.goal_classes(goal)
            found = Forward(self.p, self.tables, self.priors, self.layout.row_class, w, classes).log_probability().reshape(goal.shape)
            found[scored] += self.within(self.layout.row_class[w[:, CONTEXT:][scored]], goal[scored])
            total += np.bincount(text[i : i + BATCH], found.sum(1), len(length))
        return total


def log_shares(classes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Log of each subword's share of its class, smoothed so that none is zero."""
    weight = np.append(counts + 0.1, 1.0)
    total = np.bincount(classes, weight, CLASSES)
    return np.log(weight / total[classes])


def class_pairs(after: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Counts of class after class, from counts of subword after class."""
    out = np.zeros((CLASSES, CLASSES))
    for before in range(CLASSES):
        out[before] = np.bincount(classes, after[before], CLASSES)
    return out
