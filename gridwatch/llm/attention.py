"""Causal self-attention over subword ids, trained and applied in numpy.

Windows hold subword ids by their rank in the corpus, the rarest ones as one. At the start of each word the
model tells the class of the subword that begins it (or the end): the most frequent ids are classes of
their own. It adds what attention finds in the window to the corpus's log table of what class follows which.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np

#: Ids with an embedding of their own (and one for all rarer ones, one for the end), and classes of the output.
INPUTS, CLASSES, TAIL_CLASSES, WIDTH = 1024, 128, 7, 16
WINDOW, CONTEXT = 32, 8
STEP = WINDOW - CONTEXT
END = INPUTS - 1
#: Windows that are scored at once.
BATCH = 96
#: Steps of a task at least where it is asked for them, and the first rate.
STEPS, RATE = 150, 0.01
#: Windows of a training step, and after how many steps the rate is down to 0.7 of the first.
DRAWN, SLOWER = 128, 1000


@dataclass
class Model:
    input_of: np.ndarray  # subword id -> input number, by rank
    class_of: np.ndarray  # subword id -> class
    bigram: np.ndarray  # log P(class that begins a word | class before), float32
    weights: dict[str, np.ndarray]


def ranks_of(counts: np.ndarray) -> np.ndarray:
    """Rank of each subword id in the counts; of equal ones the lesser id comes first."""
    rank = np.empty(len(counts), np.int64)
    rank[np.lexsort((np.arange(len(counts)), -counts))] = np.arange(len(counts))
    return rank


def classes_of(rank: np.ndarray) -> np.ndarray:
    """Class of each rank; the last classes but the end's are ranges of rarer ids."""
    own = CLASSES - 1 - TAIL_CLASSES
    tail = own + np.minimum(TAIL_CLASSES - 1, np.log2(1 + np.maximum(rank - own, 0) / own).astype(np.int64))
    return np.where(rank < own, rank, tail).astype(np.uint8)


def inputs_of(rank: np.ndarray) -> np.ndarray:
    return np.minimum(rank, INPUTS - 2).astype(np.uint16)


#: Class of each input; the rare ids that share the last but one input count as the class of its first rank.
CLASS_OF = np.append(classes_of(np.arange(INPUTS - 1)), CLASSES - 1).astype(np.int64)


SHAPES = {"E": (INPUTS, WIDTH), "P": (WINDOW, WIDTH), "Q": (WIDTH, WIDTH), "K": (WIDTH, WIDTH), "V": (WIDTH, WIDTH), "O": (WIDTH, WIDTH), "U": (WIDTH, CLASSES)}


def start_weights(seed: int = 3) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)
    return {k: np.zeros(s, np.float32) if k == "U" else draw.normal(0, 0.3, s).astype(np.float32) for k, s in SHAPES.items()}


#: The most that a position's attention to another may be, before exp(): a float32's range for those before, nothing for those after.
CAP = np.where(np.tril(np.ones((WINDOW, WINDOW), bool)), np.float32(80), np.float32(-1e9))
#: Logits up to here are within a float32's range after exp(), also times weights and summed; they are log probabilities plus a few units.
MOST = 60

#: Columns of ones: a product with them is a sum over a window's positions or over the classes.
ONES, ALL = np.ones((WINDOW, 1), np.float32), np.ones((CLASSES, 1), np.float32)
#: Where an input's row of embeddings lies among all of them.
CELLS = np.arange(INPUTS * WIDTH).reshape(INPUTS, WIDTH)


def forward(p: dict, bigram: np.ndarray, seen: np.ndarray, first: int = 0):
    """Hidden states and class logits (not normalised) at positions `first` and later of each window."""
    x = p["E"].take(seen, axis=0) + p["P"]
    a = (x[:, first:] @ (p["Q"] / np.float32(np.sqrt(WIDTH)))) @ (x @ p["K"]).transpose(0, 2, 1)
    a = np.exp(np.clip(a, np.float32(-80), CAP[first:]))
    h = x[:, first:] + (a / a.sum(axis=2, keepdims=True)) @ (x @ p["V"]) @ p["O"]
    return h, h @ p["U"] + bigram[CLASS_OF[seen[:, first:]]]


@dataclass
class Asked:
    """What `forward` makes where `wanted` (positions from CONTEXT on) says, in one row each; attention's queries are packed by window."""

    cell: np.ndarray  # of each row, its number among the packed queries
    place: np.ndarray  # its number among all positions of the windows
    x: np.ndarray  # all embeddings
    own: np.ndarray  # embeddings of the rows
    q: np.ndarray
    k: np.ndarray
    v: np.ndarray
    a: np.ndarray  # not divided by its sums
    sums: np.ndarray
    c: np.ndarray
    h: np.ndarray
    logits: np.ndarray


def forward_at(p: dict, bigram: np.ndarray, seen: np.ndarray, wanted: np.ndarray) -> Asked:
    at = np.flatnonzero(wanted)
    window = at // STEP
    count = np.bincount(window, minlength=len(seen))
    most = int(count.max(initial=0))
    cell = np.arange(len(at)) + (np.arange(len(seen)) * most - (np.cumsum(count) - count)).take(window)
    place = at + CONTEXT * (window + 1)
    x = p["E"].take(seen, axis=0)
    x += p["P"]
    x = x.reshape(-1, WIDTH)
    kv = (x @ np.concatenate([p["K"], p["V"]], axis=1)).reshape(*seen.shape, 2 * WIDTH)
    k, v, own = kv[:, :, :WIDTH], kv[:, :, WIDTH:], x.take(place, axis=0)
    q = np.zeros((len(seen) * most, WIDTH), np.float32)
    q[cell] = own @ (p["Q"] / np.float32(np.sqrt(WIDTH)))
    q = q.reshape(len(seen), most, WIDTH)
    line = np.full(len(seen) * most, CONTEXT)
    line[cell] = place - window * WINDOW
    a = q @ k.transpose(0, 2, 1)
    np.maximum(a, np.float32(-80), out=a)
    np.minimum(a, CAP.take(line, axis=0).reshape(a.shape), out=a)
    np.exp(a, out=a)
    sums = (a.reshape(-1, WINDOW) @ ONES).take(cell, axis=0)
    c = (a @ v).reshape(-1, WIDTH).take(cell, axis=0)
    c /= sums
    h = own + c @ p["O"]
    logits = h @ p["U"]
    logits += bigram.take(CLASS_OF[seen.ravel().take(place)], axis=0)
    return Asked(cell, place, x, own, q, k, v, a, sums, c, h, logits)


def steep(p: dict) -> float:
    return float(np.sqrt((p["U"] ** 2).sum(axis=0).max()))


def beyond(steepest: float, h: np.ndarray) -> bool:
    """Whether logits may leave a float32's range; the states' norms tell."""
    return bool(len(h)) and steepest * math.sqrt(float(np.einsum("ij,ij->i", h, h).max())) > MOST


def gradients(p: dict, bigram: np.ndarray, seen: np.ndarray, target: np.ndarray, wanted: np.ndarray) -> dict:
    """Of the mean loss at the `wanted` positions from CONTEXT on, of which there is one at least."""
    f = forward_at(p, bigram, seen, wanted)
    d, n, root = f.logits, len(f.h), np.float32(np.sqrt(WIDTH))
    if beyond(steep(p), f.h):
        d -= d.max(axis=1, keepdims=True)
    np.exp(d, out=d)
    sums = d @ ALL  # d stays times these; what it is multiplied with has fewer columns
    d.ravel()[np.arange(n) * CLASSES + target.ravel().take(np.flatnonzero(wanted))] -= sums[:, 0]
    sums *= np.float32(n)
    dh = d @ p["U"].T
    dh /= sums
    g = {"U": (d.T @ (f.h / sums)).T, "O": f.c.T @ dh}
    dc = dh @ p["O"].T
    dc /= f.sums
    full, off = np.zeros((f.q.shape[0] * f.q.shape[1], WIDTH), np.float32), np.zeros((f.q.shape[0] * f.q.shape[1], 1), np.float32)
    full[f.cell] = dc
    off[f.cell, 0] = np.einsum("ij,ij->i", dc, f.c)  # what the softmax takes off
    dc = full.reshape(f.q.shape)
    ds = dc @ f.v.transpose(0, 2, 1)
    ds -= off.reshape(*f.q.shape[:2], 1)
    ds *= f.a
    dq = (ds @ f.k).reshape(-1, WIDTH).take(f.cell, axis=0)
    dkv = np.empty((*seen.shape, 2 * WIDTH), np.float32)
    np.matmul(ds.transpose(0, 2, 1), f.q, out=dkv[:, :, :WIDTH])
    np.matmul(f.a.transpose(0, 2, 1), dc, out=dkv[:, :, WIDTH:])
    dkv = dkv.reshape(-1, 2 * WIDTH)
    g["Q"] = f.own.T @ dq / root
    g["K"], g["V"] = np.split((dkv.T @ f.x).T, 2, axis=1)
    dx = dkv @ np.concatenate([p["K"], p["V"]], axis=1).T
    dx[f.place] += dh + dq @ (p["Q"].T / root)
    g["P"] = dx.reshape(*seen.shape, WIDTH).sum(axis=0)
    g["E"] = np.bincount(CELLS.take(seen.ravel(), axis=0).ravel(), dx.ravel(), INPUTS * WIDTH).reshape(INPUTS, WIDTH)
    return g


def windows(sequences: list[np.ndarray], goals: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping windows of input numbers (each sequence from END to END): inputs, target classes and what is scored.

    goals: for each sequence the class after each input, -1 where none is asked for. Windows start STEP apart
    with CONTEXT positions before what they score, so each goal is scored once.
    """
    n = np.fromiter(map(len, goals), np.int64, len(goals))
    count, number = -(-n // STEP), np.arange(len(n))
    at = np.arange(n.sum()) + np.repeat((np.cumsum(count) - count) * STEP - (np.cumsum(n) - n), n)
    goal = np.full(count.sum() * STEP, -1, np.int64)
    goal[at] = np.concatenate(goals)
    padded = np.full(len(goal) + CONTEXT * len(n), END, np.int64)  # CONTEXT before each sequence
    padded[at + np.repeat(CONTEXT * (number + 1), n)] = np.concatenate([s[:-1] for s in sequences])
    starts = np.arange(count.sum()) * STEP + np.repeat(CONTEXT * number, count)
    target = goal.reshape(-1, STEP)
    return padded[starts[:, None] + np.arange(WINDOW)], np.maximum(target, 0), target >= 0


class Trainer:
    """Adam from weights p, over windows that come in parts."""

    def __init__(self, p: dict[str, np.ndarray], seed: int = 5):
        self.row = packed(p).astype(np.float32)
        self.p, self.draw, self.steps = unpacked(self.row), np.random.default_rng(seed), 0  # p: views of the row
        self.m, self.v = np.zeros_like(self.row), np.zeros_like(self.row)

    def learn(self, bigram: np.ndarray, seen: np.ndarray, target: np.ndarray, wanted: np.ndarray) -> None:
        """Each of these windows once, in an order drawn anew; each asks for something."""
        order = self.draw.permutation(len(seen))
        for i in range(0, len(order), DRAWN):
            pick = order[i : i + DRAWN]
            self.step(packed(gradients(self.p, bigram, seen[pick], target[pick], wanted[pick])).astype(np.float32))

    def step(self, g: np.ndarray) -> None:
        self.steps += 1
        rate = RATE / math.sqrt(1 + self.steps / SLOWER) / (1 - 0.9**self.steps)
        self.m *= np.float32(0.9)
        self.m += np.float32(0.1) * g
        g *= g
        g *= np.float32(0.01)
        self.v *= np.float32(0.99)
        self.v += g
        root = np.sqrt(self.v)
        root *= np.float32(1 / math.sqrt(1 - 0.99**self.steps))
        root += np.float32(1e-8)
        np.divide(self.m, root, out=root)
        root *= np.float32(rate)
        self.row -= root


def train_parts(parts: Iterable[tuple[list[np.ndarray], list[np.ndarray]]], bigram: np.ndarray, p: dict[str, np.ndarray], steps: int) -> tuple[dict[str, np.ndarray], int]:
    """New weights from p after each window of all parts (sequences, goals) that asks for something, and the number of these windows.

    All are taken once; if that makes fewer than `steps`, all again until there are so many. Only so few are kept.
    """
    trainer, kept, n = Trainer(p), [], 0
    for sequences, goals in parts:
        if sequences:
            seen, target, wanted = windows(sequences, goals)
            asks = wanted.any(axis=1)
            some = seen[asks], target[asks], wanted[asks]
            trainer.learn(bigram, *some)
            n += len(some[0])
            kept = [*kept, some] if trainer.steps < steps else []
    while n and trainer.steps < steps:
        for some in kept:
            trainer.learn(bigram, *some)
    return trainer.p if n else p, n


def train(sequences: list[np.ndarray], goals: list[np.ndarray], bigram: np.ndarray, p: dict[str, np.ndarray], steps: int = STEPS) -> tuple[dict[str, np.ndarray], int]:
    """`train_parts` of one part."""
    return train_parts([(sequences, goals)], bigram, p, steps)


def packed(p: dict[str, np.ndarray]) -> np.ndarray:
    """All weights in one row, by name."""
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def unpacked(row: np.ndarray) -> dict[str, np.ndarray]:
    """Views of a float32 row."""
    at, p = 0, {}
    for k, shape in sorted(SHAPES.items()):
        p[k] = row[at : at + math.prod(shape)].reshape(shape).astype(np.float32, copy=False)
        at += math.prod(shape)
    return p


def class_scores(model: Model, sequences: list[np.ndarray], goals: list[np.ndarray]) -> np.ndarray:
    """Log probability of each goal (-1: none), one sequence after the other."""
    seen, target, wanted = windows(sequences, goals)
    found, steepest = np.zeros(wanted.shape), steep(model.weights)
    order = np.argsort(np.count_nonzero(wanted, axis=1), kind="stable")  # packed queries are as many as those of the window with most
    for i in range(0, len(order), BATCH):
        pick = order[i : i + BATCH]
        asks = wanted[pick]
        f = forward_at(model.weights, model.bigram, seen[pick], asks)
        logits = f.logits
        if beyond(steepest, f.h):
            np.minimum(logits, 80, out=logits)
        at = logits[np.arange(len(logits)), target[pick][asks]].astype(np.float64)
        np.exp(logits, out=logits)
        some = np.zeros(asks.shape)
        some[asks] = at - np.log((logits @ ALL)[:, 0].astype(np.float64))
        found[pick] = some
    return found[wanted]
