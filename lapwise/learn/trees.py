"""Boosted and bagged trees over binned features, grown level by level with one aggregation for each level.

Features are cut into at most 64 bins once and kept as bytes in blocks of rows.
For every level, tasks sum the gradient, the Hessian and the rows per (tree,
node, feature, bin) of their blocks, of large siblings only the smaller one, as
the other's sums are their parent's without it. The sums are added up by (tree,
node), and the best split of each node is found where its sums meet: on the
driver if those of all partitions take up to `DRIVER_BYTES`, which saves an
exchange, else in tasks. So what the driver holds depends on the settings and
the partitions, not on the rows.

Many ensembles over one table grow side by side: each job does the next level of
all of them. Rounds of boosting follow one another, so a table costs as many jobs
as its slowest ensemble has levels, however many there are. Its partitions are as
many as run at a time, or more if a task would have too many rows, and a task
joins its blocks, so that a job's sums and the work on them grow with the
settings and the cores, not with the rows. The sums of a table of up to
`ROWS_PER_TASK` rows are whole where they are made, so its only task goes on to the
next level by itself; ensembles then grow in jobs of their own. Both ways give
the same trees.

Tasks keep blocks, margins and places in growing boosted trees in Spark's local
folders between jobs, as any Python worker of an executor may get a partition's
next level. A job reads handles of these files, which are cached where the files
are, and not the rows. That saves time only: where files are missing, a job keeps
the partition's blocks again and applies the trees grown since the margins that
came with them, which are checkpointed every few trees. Rows and columns are
sampled by hashes, so a lost task makes the same choices again.
"""

from __future__ import annotations

import ast
import math
import os
import pickle
import shutil
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from dataclasses import dataclass, field, replace
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, Broadcast, StorageLevel, TaskContext, inheritable_thread_target
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.session import materialised, shared_dir

BINS = 64
# Precision of the bin edges, as the largest relative rank error.
RANK_ERROR = 1e-4
# Rows that a task takes, at about 100 bytes each; up to so many grow in one task, which is faster than a job for each level.
ROWS_PER_TASK = 1 << 21
# Rows of a joined block, and least rows of a task of a larger table.
BLOCK_ROWS = 1 << 18
# Sums of one job, which bounds the trees of a forest that grow together, and jobs at a time.
JOB_BYTES = 64 << 20
JOBS = 8
# Sums of a level, over all partitions, that the driver adds up; more are exchanged.
DRIVER_BYTES = 16 << 20
# Finished trees that travel with a job; more are broadcast.
TAIL = 64
# Trees of each ensemble, on average, between two checkpoints of the margins.
CHECKPOINT_TREES = 200
# Rows of a node in a block from which its sums are those of its parent without its sibling's.
SIBLING_ROWS = 1 << 14
# Rows times features that are added up in one call; larger nodes go feature by feature.
CALL_CODES = 1 << 14
LEAST_GAIN = 1e-9
# Stored blocks whose draws are at hand: about those of a joined block.
SAME_DRAWS = 64
# Nodes whose sums travel together.
NODES = 32
# Rows for each node of a tree from which rows find their leaves node by node.
NODE_ROWS = 256


@dataclass(frozen=True)
class TreeSettings:
    """An ensemble: `boosted` on squared or logistic loss, or bagged.

    Splits of second order (`newton`) weigh by the Hessian, with penalties `l1`
    and `l2`, `least_weight` of Hessian on both sides and at least `least_gain`;
    others weigh by rows, with `least_rows` on both sides. `column_share` is
    drawn for each tree; with `root_columns` each node draws the square root of
    the number of features.
    """

    trees: int
    depth: int
    rate: float = 1.0
    row_share: float = 1.0
    column_share: float = 1.0
    root_columns: bool = False
    least_rows: int = 1
    least_weight: float = 0.0
    l1: float = 0.0
    l2: float = 0.0
    least_gain: float = 0.0
    logistic: bool = False
    newton: bool = False
    boosted: bool = True
    seed: int = 42

    def start(self, mean: float) -> float:
        """The margin before the first tree."""
        if not self.boosted:
            return 0.0
        if not self.logistic:
            return mean
        if self.newton:
            # One Newton step from 0.
            return (mean - 0.5) / 0.25
        return math.log(max(mean, 1e-12) / max(1 - mean, 1e-12))

    def gradients(self, y: np.ndarray, margin: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
        if not self.boosted:
            return -y, np.ones(len(y))
        if not self.logistic:
            return margin - y, np.ones(len(y))
        p = 1 / (1 + np.exp(-margin))
        return p - y, p * (1 - p)

    def leaf(self, sums: Sequence[float]) -> float:
        """The value of a node with sums (gradient, Hessian, rows)."""
        g, h, n = sums
        if not self.boosted:
            return -g / n if n else 0.0
        if not self.newton:
            return -g / h * self.rate if h > 0 else 0.0
        return -shrunk(g, self.l1) / (h + self.l2) * self.rate if h + self.l2 > 0 else 0.0


def shrunk(g, l1: float):
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0) if l1 else g


def uniforms(*parts: int | np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) that depend on the parts alone (splitmix64 of each in turn)."""
    x = np.uint64(0)
    with np.errstate(over="ignore"):
        for part in parts:
            x = (x ^ np.asarray(part).astype(np.uint64)) + np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(np.float64) / 2.0**53


# Chances of 0, 1, 2, ... draws of a row in a bootstrap sample: Poisson with mean 1.
DRAWS = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


@lru_cache(SAME_DRAWS)
def row_draws(seed: int, tree: int, block: int, rows: int) -> np.ndarray:
    """A number in [0, 1) for each row of a stored block; the ensembles of a search that grow the same tree share them."""
    return uniforms(seed, tree, block, np.arange(rows))


def row_weights(settings: TreeSettings, tree: int, block: int, rows: int) -> np.ndarray:
    """How often each row of a block counts in a tree."""
    if settings.boosted and settings.row_share >= 1:
        return np.ones(rows)
    u = row_draws(settings.seed, tree, block, rows)
    if settings.boosted:
        return (u < settings.row_share).astype(np.float64)
    return np.searchsorted(DRAWS, u, side="right").astype(np.float64)


def drawn(settings: TreeSettings, columns: int) -> int:
    """How many features a tree may split on."""
    return max(1, math.ceil(settings.column_share * columns - 1e-9))


def summed_columns(settings: TreeSettings, columns: int, tree: int) -> np.ndarray:
    """The features whose sums a tree needs: those it may split on, and the first one for the sums of whole nodes."""
    if settings.column_share >= 1:
        return np.arange(columns)
    order = np.argsort(uniforms(settings.seed + 1, tree, np.arange(columns)))
    return np.unique(np.append(order[: drawn(settings, columns)], 0))


def allowed_columns(settings: TreeSettings, columns: int, tree: int, node: int) -> np.ndarray:
    """The features that a node may split on; nodes are numbered 1 for the root, 2k and 2k + 1 for the children of k."""
    if settings.column_share >= 1 and not settings.root_columns:
        return np.ones(columns, bool)
    order = np.argsort(uniforms(settings.seed + 1, tree, np.arange(columns)))
    kept = order[: drawn(settings, columns)]
    if settings.root_columns:
        kept = kept[np.argsort(uniforms(settings.seed + 2, tree, node, kept))[: max(1, math.isqrt(columns))]]
    mask = np.zeros(columns, bool)
    mask[kept] = True
    return mask


@dataclass(frozen=True)
class Split:
    """A node's sums (gradient, Hessian, rows) and its best split, if any: bins up to `cut` go left."""

    total: tuple[float, float, float]
    feature: int = -1
    cut: int = -1
    gain: float = 0.0
    left: tuple[float, float, float] = (0.0, 0.0, 0.0)


def best_splits(settings: TreeSettings, allowed: np.ndarray, sums: np.ndarray) -> list[Split]:
    """The best split of each node by its sums (node x (gradient, Hessian, rows) x feature x bin); the first feature and bin of equals."""
    total = sums[:, :, 0].sum(axis=-1)
    g, h, n = np.cumsum(sums, axis=-1)[..., :-1].transpose(1, 0, 2, 3)
    weigh = 1 if settings.newton else 2
    penalty, l1 = (settings.l2, settings.l1) if settings.newton else (0.0, 0.0)
    least = max(settings.least_weight, 1e-12) if settings.newton else settings.least_rows
    w, whole, weight = (h if settings.newton else n), total[:, 0, None, None], total[:, weigh, None, None]
    rest = weight - w
    fits = (w >= least) & (rest >= least) & allowed[:, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = shrunk(g, l1) ** 2 / (w + penalty) + shrunk(whole - g, l1) ** 2 / (rest + penalty)
        gain -= shrunk(whole, l1) ** 2 / (weight + penalty)
    gain[~fits] = -np.inf
    gain = gain.reshape(len(sums), -1)
    at = np.argmax(gain, axis=1)
    best = gain[np.arange(len(sums)), at]
    out = []
    for node, (place, found) in enumerate(zip(at.tolist(), best.tolist())):
        own = tuple(total[node].tolist())
        if not found > LEAST_GAIN or found < settings.least_gain:
            out.append(Split(own))
            continue
        f, cut = divmod(place, BINS - 1)
        out.append(Split(own, f, cut, found, (float(g[node, f, cut]), float(h[node, f, cut]), float(n[node, f, cut]))))
    return out


@dataclass
class Tree:
    """Nodes as columns: the root first; `feature` is -1 for leaves; bins up to `cut` go to `left`, others to `right`."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def depth(self) -> int:
        below = np.zeros(len(self.feature), int)
        # Children come after their parents.
        for node in reversed(np.flatnonzero(self.feature >= 0).tolist()):
            below[node] = 1 + max(below[self.left[node]], below[self.right[node]])
        return int(below[0])

    def packed(self) -> tuple[bytes, bytes]:
        return np.stack([self.feature, self.cut, self.left, self.right]).astype(np.int32).tobytes(), self.value.tobytes()

    @staticmethod
    def values_of(packed: tuple[bytes, bytes], codes: np.ndarray) -> np.ndarray:
        """The values of the leaves that rows of codes (feature x row) fall into."""
        value = np.frombuffer(packed[1])
        feature, cut, left, right = np.frombuffer(packed[0], np.int32).reshape(4, -1)
        if codes.shape[1] >= NODE_ROWS * len(value):
            return Tree._values_by_node(feature, cut, left, right, value, codes)
        place = np.zeros(codes.shape[1], np.int32)
        rows = np.arange(codes.shape[1])
        while True:
            inner = feature[place] >= 0
            if not inner.any():
                return value[place]
            if not inner.all():
                inner = np.flatnonzero(inner)
                at, who = place[inner], rows[inner]
                place[inner] = np.where(codes[feature[at], who] <= cut[at], left[at], right[at])
            else:
                place = np.where(codes[feature[place], rows] <= cut[place], left[place], right[place])

    @staticmethod
    def _values_by_node(feature, cut, left, right, value, codes: np.ndarray) -> np.ndarray:
        """The same, node by node: faster for many rows."""
        out = np.full(codes.shape[1], value[0])
        # The rows of a node; all of them at the root.
        todo: list[tuple[int, np.ndarray | None]] = [(0, None)]
        while todo:
            node, rows = todo.pop()
            if feature[node] < 0:
                if rows is not None:
                    out[rows] = value[node]
                continue
            low = (codes[feature[node]] if rows is None else codes[feature[node]].take(rows)) <= cut[node]
            sides = (np.flatnonzero(low), np.flatnonzero(~low)) if rows is None else (rows[low], rows[~low])
            todo += zip((left[node], right[node]), sides)
        return out


@dataclass
class Block:
    """Rows as a task reads them: codes (feature x row), label, and the margin of every boosted ensemble.

    `pieces` are the stored blocks it is made of, as (number, rows); samples of rows go by these.
    """

    number: int
    codes: np.ndarray
    y: np.ndarray
    margins: dict[int, np.ndarray]
    pieces: list[tuple[int, int]] = field(default_factory=list)


def joined(blocks: Iterable[Block]) -> Iterator[Block]:
    """The blocks of a partition as few large ones, of up to `BLOCK_ROWS` rows where a block has fewer."""
    held: list[Block] = []
    # By number: a partition that is read again may have them in another order.
    for block in sorted(blocks, key=lambda b: b.number):
        if held and sum(len(b.y) for b in held) + len(block.y) > BLOCK_ROWS:
            yield _joined(held)
            held = []
        held.append(block)
    if held:
        yield _joined(held)


def _joined(blocks: list[Block]) -> Block:
    first = blocks[0]
    return Block(
        first.number, np.concatenate([b.codes for b in blocks], axis=1), np.concatenate([b.y for b in blocks]),
        {e: np.concatenate([b.margins[e] for b in blocks]) for e in first.margins}, [p for b in blocks for p in b.pieces])


class Growing:
    """The rows of a block in a tree that grows, by open node: their numbers, and gradient and weight as one complex number.

    The imaginary part is the Hessian with logistic loss, where a row counts once, and else how often the row counts.
    """

    def __init__(self, block: Block, settings: TreeSettings, margin: np.ndarray | float, tree: int, state: tuple | None = None):
        self.tree, self.level = tree, 0
        self.columns = summed_columns(settings, len(block.codes), tree)
        self.codes = block.codes
        self.own = settings.boosted and settings.logistic
        # Sums of the level above, for nodes whose sums follow from them, and the place of each open node's parent.
        self.above: np.ndarray | None = None
        self.parents: list[int] = []
        g, h = settings.gradients(block.y, margin)
        if state is None:
            weight = np.concatenate([row_weights(settings, tree, number, rows) for number, rows in block.pieces])
            rows = [np.flatnonzero(weight)]
        else:
            self.level, places, self.above, self.parents, nodes = state
            rows, weight = [np.flatnonzero(places == k) for k in range(nodes)], None
        self.nodes = []
        for some in rows:
            pairs = np.empty(len(some), np.complex128)
            # Rows of boosted trees count once.
            pairs.real, pairs.imag = g.take(some), h.take(some) if self.own or weight is None else weight.take(some)
            if not settings.boosted:
                pairs.real *= pairs.imag
            self.nodes.append((some.astype(np.int32), pairs))

    def state(self) -> tuple:
        """What another task needs to go on with a boosted tree: level, place of each row's open node, sums of the level, parents, nodes."""
        places = np.full(self.codes.shape[1], len(self.nodes), np.uint8 if len(self.nodes) < 256 else np.int32)
        for k, (rows, _) in enumerate(self.nodes):
            places[rows] = k
        return self.level, places, self.above, self.parents, len(self.nodes)

    @property
    def planes(self) -> np.ndarray:
        """Gradient, Hessian and weight of the rows of open nodes."""
        pairs = np.concatenate([p for _, p in self.nodes])
        return np.stack([pairs.real, pairs.imag, np.ones(len(pairs)) if self.own else pairs.imag])

    def descend(self, splits: np.ndarray) -> None:
        """Move rows from the nodes of a level to theirs of the next; `splits` has (feature, cut, left, right) for each node."""
        following, self.parents = [], []
        for place, ((rows, pairs), (feature, cut, left, _)) in enumerate(zip(self.nodes, splits.T.tolist())):
            if left >= 0:
                low = self.codes[feature].take(rows) <= cut
                # Children of a node stand side by side.
                following += [(rows[side], pairs[side]) for side in (low, ~low)]
                self.parents += [place, place]
        self.nodes = following
        self.level += 1

    def sums(self, nodes: int, settings: TreeSettings, numbers: Sequence[int] = ()) -> np.ndarray:
        """Sums of node x plane x feature x bin; zeros for features that the node does not need, and for rows if the Hessian weighs.

        `numbers` are those of the nodes, by which they draw their features.
        """
        columns = len(self.codes)
        out = np.zeros((nodes, 3, columns, BINS))
        later = []
        for place, (rows, pairs) in enumerate(self.nodes):
            needed = self.columns
            if settings.root_columns and numbers:
                # The first feature has the sums of whole nodes.
                needed = np.flatnonzero(allowed_columns(settings, columns, self.tree, numbers[place]) | (np.arange(columns) == 0))
            elif self.above is not None and len(rows) >= SIBLING_ROWS:
                sibling = place ^ 1
                if (len(self.nodes[sibling][0]), sibling) < (len(rows), place):
                    later.append((place, sibling))
                    continue
            self._add(out[place], rows, pairs, needed, not settings.newton)
        for place, sibling in later:
            np.subtract(self.above[self.parents[place]], out[sibling], out=out[place])
        # Nodes of large parents only, in trees whose nodes need the same features.
        self.above = out if not settings.root_columns and any(len(rows) >= SIBLING_ROWS for rows, _ in self.nodes) else None
        return out

    def _add(self, out: np.ndarray, rows: np.ndarray, pairs: np.ndarray, needed: np.ndarray, counted: bool) -> None:
        """Add up the rows of a node: each bin in the order of rows."""
        if len(rows) * len(needed) <= CALL_CODES:
            groups = [needed]
        else:
            groups = [needed[k : k + 1] for k in range(len(needed))]
        for some in groups:
            if len(some) == 1:
                key, both = self.codes[some[0]].take(rows).astype(np.intp), pairs
            else:
                key = (self.codes[some[:, None], rows] + (np.arange(len(some)) * BINS)[:, None]).ravel()
                both = np.tile(pairs, len(some))
            sums = np.zeros(len(some) * BINS, np.complex128)
            np.add.at(sums, key, both)
            sums = sums.reshape(-1, BINS)
            out[0, some], out[1, some] = sums.real, sums.imag
            if counted:
                out[2, some] = np.bincount(key, minlength=len(some) * BINS).reshape(-1, BINS) if self.own else sums.imag


class Remembered:
    """A block's margins, each after some trees of the log, and its rows in the trees that grow."""

    def __init__(self, block: Block, applied: int = 0):
        self.block, self.growing = block, {}
        self._margins = {e: (applied, margin) for e, margin in block.margins.items()}

    def margin(self, e: int, log: Log) -> np.ndarray | float:
        """The margin after all trees of the log; 0 for trees that are not boosted."""
        if e not in self._margins:
            return 0.0
        applied, margin = self._margins[e]
        later = [tree for at, tree in log.since(applied) if at == e]
        for tree in later:
            margin = margin + Tree.values_of(tree, self.block.codes)
        if later:
            self._margins[e] = len(log), margin
        return margin

    def grown(self, e: int, settings: TreeSettings, request: Request, log: Log) -> Growing | None:
        """The requested tree as it was at some level above."""
        growing = self.growing.pop(e, None)
        return growing if growing is not None and growing.tree == request.tree and growing.level <= len(request.levels) else None

    def keep(self, e: int, growing: Growing) -> None:
        self.growing[e] = growing


@dataclass(frozen=True)
class Handle:
    """The folder where an executor keeps a block and what grows on it."""

    folder: str


class Files:
    """Values by ensemble, each in a file that is replaced as a whole."""

    def __init__(self, folder: str, name: str):
        self.path = f"{folder}/{name}"

    def __setitem__(self, e: int, value: object) -> None:
        part = f"{self.path}-{e}.{uuid.uuid4().hex}"
        with open(part, "wb") as file:
            pickle.dump(value, file, pickle.HIGHEST_PROTOCOL)
        # Some file systems write a file to disk at once if it takes the name of another.
        with suppress(FileNotFoundError):
            os.remove(f"{self.path}-{e}")
        os.replace(part, f"{self.path}-{e}")

    def __contains__(self, e: int) -> bool:
        return os.path.exists(f"{self.path}-{e}")

    def __getitem__(self, e: int) -> object:
        with open(f"{self.path}-{e}", "rb") as file:
            return pickle.load(file)

    def numbers(self) -> list[int]:
        folder, name = os.path.split(self.path)
        return sorted(int(end) for kind, _, end in (f.partition("-") for f in os.listdir(folder)) if kind == name and end.isdigit())


class Kept(Remembered):
    """A block in files of this executor."""

    def __init__(self, handle: Handle):
        codes, y = (np.asarray(np.load(f"{handle.folder}/{part}.npy", mmap_mode="r")) for part in ("codes", "y"))
        self.block = Block(0, codes, y, {}, Files(handle.folder, "pieces")[0])
        self._trees, self._margins = Files(handle.folder, "tree"), Files(handle.folder, "margin")

    def grown(self, e: int, settings: TreeSettings, request: Request, log: Log) -> Growing | None:
        # A file stays for a task that runs again.
        if e not in self._trees:
            return None
        tree, state = self._trees[e]
        if tree != request.tree or state[0] > len(request.levels):
            return None
        return Growing(self.block, settings, self.margin(request.margin, log), tree, state)

    def keep(self, e: int, growing: Growing) -> None:
        self._trees[e] = growing.tree, growing.state()

    def margins(self, log: Log) -> dict[int, np.ndarray]:
        """The margins of all boosted ensembles after the trees of the log."""
        return {e: self.margin(e, log) for e in self._margins.numbers()}


# Blocks in files that this worker has mapped, by run and folder.
_MEMORY: dict[tuple[str, str], Kept] = {}


def _kept(run: str, handle: Handle) -> Kept:
    key = (run, handle.folder)
    if key not in _MEMORY:
        for old in [k for k in _MEMORY if k[0] != run]:
            del _MEMORY[old]
        _MEMORY[key] = Kept(handle)
    return _MEMORY[key]


def _kept_folder(run: str) -> str:
    """This executor's folder for the blocks of a run, which Spark removes when the executor ends."""
    return os.path.join(os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")[0], "python", f"lapwise-{run}")


def _keep(run: str, applied: int, blocks: Iterator[Block]) -> Iterator[Handle]:
    """Write blocks, whose margins are after `applied` trees, to files of this executor."""
    for block in blocks:
        folder = f"{_kept_folder(run)}/{block.number}"
        os.makedirs(folder, exist_ok=True)
        for part, values in (("codes", block.codes), ("y", block.y)):
            written = f"{folder}/{part}.{uuid.uuid4().hex}.npy"
            np.save(written, np.ascontiguousarray(values))
            os.replace(written, f"{folder}/{part}.npy")
        margins = Files(folder, "margin")
        for e, margin in block.margins.items():
            margins[e] = applied, margin
        Files(folder, "pieces")[0] = block.pieces
        yield Handle(folder)


def _drop_kept(run: str, handles: Iterator[Handle]) -> None:
    for key in [k for k in _MEMORY if k[0] == run]:
        del _MEMORY[key]
    for folder in {os.path.dirname(h.folder) for h in handles}:
        shutil.rmtree(folder, ignore_errors=True)


@dataclass
class Log:
    """The trees finished since the margins were stored, as (number of the margin, packed tree): broadcast chunks of `size`, then the tail."""

    size: int
    chunks: list[Broadcast]
    tail: list[tuple[int, tuple[bytes, bytes]]]

    def __len__(self) -> int:
        return len(self.chunks) * self.size + len(self.tail)

    def since(self, place: int) -> Iterator[tuple[int, tuple[bytes, bytes]]]:
        for chunk in self.chunks[place // self.size :]:
            yield from chunk.value[place % self.size :]
            place = (place // self.size + 1) * self.size
        yield from self.tail[place - len(self.chunks) * self.size :]


@dataclass
class Request:
    """The next level of a tree: the splits of the levels above it, and the numbers of its open nodes."""

    margin: int
    tree: int
    levels: list[np.ndarray]
    nodes: list[int]


def _level_sums(
    settings: Sequence[TreeSettings], requests: dict[int, Request], log: Log, memories: Iterable[Remembered], bagged: bool = False
) -> dict[int, np.ndarray]:
    """The sums of the open nodes of every requested tree over some blocks; `bagged` keeps the rows of trees of a forest too."""
    total: dict[int, np.ndarray] = {}
    for memory in memories:
        for e, request in requests.items():
            growing = memory.grown(e, settings[e], request, log)
            if growing is None:
                growing = Growing(memory.block, settings[e], memory.margin(request.margin, log), request.tree)
            if growing.level + 1 != len(request.levels):
                # The sums that it has are not those of the level above.
                growing.above = None
            for splits in request.levels[growing.level :]:
                growing.descend(splits)
            sums = growing.sums(len(request.nodes), settings[e], request.nodes)
            if e in total:
                total[e] += sums
            else:
                total[e] = sums.copy()
            # A tree's last level is not asked for again, and a tree of a forest finds its way from the root, as many grow side by side.
            if (settings[e].boosted or bagged) and len(request.levels) + 1 < settings[e].depth:
                memory.keep(e, growing)
    return total


def _partition_sums(
    run: str, version: int, settings: Sequence[TreeSettings], requests: dict[int, Request], log: Log, blocks: Iterator[Block | Handle]
) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
    """((ensemble, first node), sums of nodes) of the blocks of a partition; (-1, partition) if they are kept elsewhere."""
    blocks = list(blocks)
    if any(isinstance(b, Handle) and not os.path.exists(b.folder) for b in blocks):
        yield (-1, TaskContext.get().partitionId()), np.zeros(0)
        return
    memories = (_kept(run, block) if isinstance(block, Handle) else Remembered(block, version) for block in blocks)
    for e, sums in _level_sums(settings, requests, log, memories).items():
        for first in range(0, len(sums), NODES):
            yield (e, first), sums[first : first + NODES]


class Grower:
    """One ensemble: what it has grown, and the level it needs next. `margin` is its number in the blocks, `first` that of its first tree."""

    def __init__(self, settings: TreeSettings, columns: int, margin: int = -1, first: int = 0):
        self.settings, self.columns, self.margin, self.first = settings, columns, margin, first
        self.trees: list[Tree] = []
        self._begin()

    @property
    def done(self) -> bool:
        return len(self.trees) >= self.settings.trees

    def _begin(self) -> None:
        # Per node: feature, cut, left, right, value, gain; open nodes as (row, number).
        self.rows: list[list] = [[-1, -1, -1, -1, 0.0, 0.0]]
        self.open, self.levels = [(0, 1)], []

    def request(self) -> Request:
        return Request(self.margin, self.first + len(self.trees), self.levels, [number for _, number in self.open])

    def advance(self, splits: dict[int, Split]) -> Tree | None:
        """Take the splits of the open nodes; the tree, if that finishes it."""
        level = np.full((4, len(self.open)), -1, np.int64)
        following = []
        deeper = len(self.levels) + 1 < self.settings.depth
        for place, (row, number) in enumerate(self.open):
            # A node without rows in any block has no sums.
            split = splits.get(place, Split((0.0, 0.0, 0.0)))
            if not self.levels:
                self.rows[row][4] = self.settings.leaf(split.total)
            if split.feature < 0:
                level[:2, place] = 0, BINS
                continue
            level[:2, place] = split.feature, split.cut
            sides = (split.left, tuple(a - b for a, b in zip(split.total, split.left)))
            self.rows[row][:4] = split.feature, split.cut, len(self.rows), len(self.rows) + 1
            self.rows[row][5] = split.gain
            for side, sums in enumerate(sides):
                if deeper:
                    level[2 + side, place] = len(following)
                    following.append((len(self.rows), 2 * number + side))
                self.rows.append([-1, -1, -1, -1, self.settings.leaf(sums), 0.0])
        self.levels = [*self.levels, level]
        self.open = following
        if following:
            return None
        columns = list(zip(*self.rows))
        tree = Tree(*[np.array(c, np.int32) for c in columns[:4]], *[np.array(c, np.float64) for c in columns[4:]])
        self.trees.append(tree)
        self._begin()
        return tree


@dataclass
class Matrix:
    """A binned table: bin edges of every feature, the number and mean of the labels, and its blocks (stored)."""

    edges: list[np.ndarray]
    rows: int
    mean: float
    stored: DataFrame

    def partitions(self) -> int:
        """One for a small table; otherwise as many as can run at a time, fewer if they had few rows, and more if they had many."""
        if self.rows <= ROWS_PER_TASK:
            return 1
        cores = self.stored.sparkSession.sparkContext.defaultParallelism
        return max(-(-self.rows // ROWS_PER_TASK), min(-(-self.rows // BLOCK_ROWS), cores))

    def blocks(self, starts: dict[int, float]) -> RDD:
        columns = len(self.edges)

        def block(row) -> Block:
            y = np.frombuffer(row["y"])
            codes = np.frombuffer(row["codes"], np.uint8).reshape(columns, len(y))
            return Block(row["number"], codes, y, {e: np.full(len(y), start) for e, start in starts.items()}, [(row["number"], len(y))])

        parts = self.partitions()
        stored = self.stored.repartition(parts) if parts > 1 else self.stored.coalesce(1)
        return stored.rdd.map(block).mapPartitions(joined)


def bin_codes(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Bins (feature x row) of values (row x feature): values up to the k-th edge are in bins up to k."""
    return np.stack([np.searchsorted(e, values[:, f]) for f, e in enumerate(edges)]).astype(np.uint8)


def binned(prepared: DataFrame, label: str, columns: int, features: str = "features") -> Matrix:
    """The binned table of a vector column and a label; rows without a label are left out."""
    rows = prepared.filter(F.col(label).isNotNull()).select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    shares = [k / BINS for k in range(1, BINS)]
    found = rows.agg(
        F.count("y").alias("rows"), F.avg("y").alias("mean"),
        *[F.percentile_approx(F.col("x")[f], shares, int(1 / RANK_ERROR)).alias(f"f{f}") for f in range(columns)],
    ).first()
    edges = [np.unique(np.array(found[f"f{f}"] or [0.0])) for f in range(columns)]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for k, batch in enumerate(batches):
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, columns)
            codes, y = bin_codes(values, edges), batch.column(1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | k], pa.int64()), pa.array([codes.tobytes()], pa.binary()), pa.array([y.astype(np.float64).tobytes()], pa.binary())],
                names=["number", "codes", "y"],
            )

    # Written, so that the numbers of blocks and with them the samples of rows stay as they are.
    stored = materialised(rows.mapInArrow(pack, "number long, codes binary, y binary"), "binned")
    return Matrix(edges, found["rows"], found["mean"] or 0.0, stored)


def _requests(growers: Sequence[Grower]) -> dict[int, Request]:
    return {e: g.request() for e, g in enumerate(growers) if not g.done}


def _splits(
    settings: Sequence[TreeSettings], columns: int, requests: dict[int, Request], item: tuple[tuple[int, int], np.ndarray]
) -> tuple[int, int, list[Split]]:
    """(ensemble, first node, splits) of the whole sums of some nodes."""
    (e, first), sums = item
    if e < 0:
        return e, first, []
    request = requests[e]
    numbers = request.nodes[first : first + len(sums)]
    allowed = np.stack([allowed_columns(settings[e], columns, request.tree, number) for number in numbers])
    return e, first, best_splits(settings[e], allowed, sums)


def _advance(growers: Sequence[Grower], requests: dict[int, Request], found: Iterable[tuple[int, int, list[Split]]], log: Log) -> None:
    """Take the splits of a level, and enter finished trees of boosted ensembles in the log."""
    splits: dict[int, dict[int, Split]] = {e: {} for e in requests}
    for e, first, own in found:
        splits[e].update(enumerate(own, first))
    for e, own in splits.items():
        tree = growers[e].advance(own)
        if tree is not None and growers[e].settings.boosted:
            log.tail.append((growers[e].margin, tree.packed()))


def _grow_here(growers: Sequence[Grower], blocks: Iterator[Block]) -> Iterator[list[list[Tree]]]:
    """All trees of the growers over the blocks of the only partition."""
    own = {g.margin for g in growers}
    held = [Remembered(replace(b, margins={e: m for e, m in b.margins.items() if e in own})) for b in blocks]
    settings = [g.settings for g in growers]
    log = Log(TAIL, [], [])
    # Trees of a forest grow one after the other, so that the rows of only one are kept between its levels.
    together = [[e] for e, s in enumerate(settings) if not s.boosted] + [[e for e, s in enumerate(settings) if s.boosted]]
    for some in together:
        while held and not all(growers[e].done for e in some):
            requests = {e: request for e, request in _requests(growers).items() if e in some}
            sums = _level_sums(settings, requests, log, held, True)
            _advance(growers, requests, [_splits(settings, growers[0].columns, requests, ((e, 0), whole)) for e, whole in sums.items()], log)
    yield [g.trees for g in growers]


def grow(blocks: RDD, growers: Sequence[Grower], kept: KeptBlocks | None = None) -> None:
    """Grow all trees of all growers side by side; more than one partition is kept in files."""
    if kept is None:
        for grower, trees in zip(growers, blocks.mapPartitions(partial(_grow_here, growers)).collect()[0]):
            grower.trees = trees
        return
    settings, columns = [g.settings for g in growers], growers[0].columns
    parts, log, stored = blocks.getNumPartitions(), Log(TAIL, [], []), 0
    boosted = any(s.boosted for s in settings)
    while not all(g.done for g in growers):
        requests = _requests(growers)
        pieces = min(parts, sum(-(-len(r.nodes) // NODES) for r in requests.values()))
        few = parts * sum(len(r.nodes) for r in requests.values()) * 3 * 8 * columns * BINS <= DRIVER_BYTES

        def level(handles: RDD) -> list[tuple[int, int, list[Split]]]:
            sums = handles.mapPartitions(partial(_partition_sums, kept.run, 0, settings, requests, log))
            own = partial(_splits, settings, columns, requests)
            if not few:
                return sums.reduceByKey(np.add, pieces).map(own).collect()
            whole: dict[tuple[int, int], np.ndarray] = {}
            for key, part in sums.collect():
                whole[key] = whole[key] + part if key in whole else part
            return [own(item) for item in whole.items()]

        _advance(growers, requests, kept.read(level), log)
        while len(log.tail) >= log.size:
            log = Log(log.size, [*log.chunks, blocks.context.broadcast(log.tail[: log.size])], log.tail[log.size :])
        if boosted and len(log) - stored >= CHECKPOINT_TREES * len(growers) and not all(g.done for g in growers):
            kept.checkpoint(log)
            stored = len(log)


class KeptBlocks:
    """The blocks of a table in files of the executors, and the handles of these files, cached where the files are."""

    def __init__(self, blocks: RDD):
        self.run, self.blocks, self.applied = uuid.uuid4().hex, blocks, 0
        self.lock = threading.Lock()
        self.handles = self._handles()

    def _handles(self) -> RDD:
        return self.blocks.mapPartitions(partial(_keep, self.run, self.applied)).persist(StorageLevel.MEMORY_AND_DISK)

    def read(self, job: Callable[[RDD], list[tuple]]) -> list[tuple]:
        """What `job` returns from the handles, run again if a task had no files: they are then written where the tasks run."""
        while True:
            handles = self.handles
            found = job(handles)
            if all(item[0] >= 0 for item in found):
                return found
            with self.lock:
                if self.handles is handles:
                    handles.unpersist()
                    self.handles = self._handles()

    def checkpoint(self, log: Log) -> None:
        """From now on lost blocks come back with the margins after the trees of the log."""

        def moved(handle: Handle) -> Block:
            memory = _kept(run, handle)
            return replace(memory.block, number=int(os.path.basename(handle.folder)), margins=memory.margins(log))

        run, older = self.run, self.blocks
        blocks = self.handles.map(moved).persist(StorageLevel.MEMORY_AND_DISK)
        blocks.checkpoint()
        blocks.count()
        self.blocks, self.applied = blocks, len(log)
        older.unpersist()

    def drop(self) -> None:
        self.handles.foreachPartition(partial(_drop_kept, self.run))
        self.handles.unpersist()
        self.blocks.unpersist()


def fit_ensembles(matrix: Matrix, settings: Sequence[TreeSettings]) -> list[TreeModel]:
    """Models of all settings over one table.

    Boosted ones grow side by side, in one job each if the table has a single
    partition. Trees of bagged ones do not depend on one another and grow in
    groups whose sums fit into one job. Groups run at the same time, with more
    partitions after the boosted ones.
    """
    spark = matrix.stored.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "rounds"))
    columns = len(matrix.edges)
    boosted = [(e, Grower(s, columns, e)) for e, s in enumerate(settings) if s.boosted]
    single = matrix.partitions() == 1
    bagged: list[list[tuple[int, Grower]]] = []
    for e, s in enumerate(settings):
        if not s.boosted:
            each = max(1, JOB_BYTES // (3 * 8 * columns * BINS * 2 ** (s.depth - 1)))
            alone = [(e, Grower(replace(s, trees=1), columns, -1, first)) for first in range(s.trees)]
            bagged += [alone[k : k + each] for k in range(0, len(alone), each)]
    turns = [[[b] for b in boosted] + bagged] if single else [[boosted] if boosted else [], bagged]
    blocks = matrix.blocks({e: s.start(matrix.mean) for e, s in enumerate(settings) if s.boosted}).persist(StorageLevel.MEMORY_AND_DISK)
    kept = None if single else KeptBlocks(blocks)
    try:
        for groups in turns if matrix.rows else []:
            with ThreadPoolExecutor(JOBS) as pool:
                run = inheritable_thread_target(spark)(lambda group: grow(blocks, [g for _, g in group], kept))
                list(pool.map(run, groups))
    finally:
        if kept is not None:
            kept.drop()
        blocks.unpersist()
    trees: list[list[Tree]] = [[] for _ in settings]
    for group in [group for groups in turns for group in groups]:
        for e, grower in group:
            trees[e] += grower.trees
    return [TreeModel(s, matrix.edges, s.start(matrix.mean), t) for s, t in zip(settings, trees)]


NODES_SCHEMA = "tree int, node int, feature int, cut int, left int, right int, threshold double, value double, gain double"


@dataclass
class TreeModel:
    """A fitted ensemble."""

    settings: TreeSettings
    edges: list[np.ndarray]
    base: float
    trees: list[Tree]

    def margins(self, values: np.ndarray) -> np.ndarray:
        """Sums (boosted) or means (bagged) of the leaves of rows of feature values (row x feature)."""
        codes = bin_codes(values, self.edges)
        total = np.zeros(len(values))
        for tree in self.trees:
            total += Tree.values_of(tree.packed(), codes)
        return self.base + total if self.settings.boosted else total / max(1, len(self.trees))

    def scores(self, values: np.ndarray) -> np.ndarray:
        """Predicted values, or chances of label 1 for a classifier."""
        margin = self.margins(values)
        return 1 / (1 + np.exp(-margin)) if self.settings.boosted and self.settings.logistic else margin

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """`df` with `prediction`, and with `probability` (of labels 0 and 1) for a classifier."""
        # The size of a model depends on its settings alone.
        model = df.sparkSession.sparkContext.broadcast(self)
        columns = len(self.edges)

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            values = np.stack(x.to_numpy()) if len(x) else np.empty((0, columns))
            return pd.Series(model.value.scores(values))

        out = df.withColumn("__score", score(vector_to_array(features)))
        if self.settings.logistic:
            chance = F.col("__score")
            out = out.withColumn("probability", array_to_vector(F.array(1 - chance, chance)))
            out = out.withColumn("prediction", (chance > 0.5).cast("double"))
        else:
            out = out.withColumn("prediction", F.col("__score"))
        return out.drop("__score")

    def importances(self) -> np.ndarray:
        """Gain of each feature's splits as a share of all gain."""
        total = np.zeros(len(self.edges))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
        return total / total.sum() if total.sum() > 0 else total

    def nodes(self) -> DataFrame:
        """One row per node: tree, node, feature and threshold (null for leaves), left, right, value, gain."""
        spark = SparkSession.active()
        if not self.trees:
            return spark.createDataFrame([], NODES_SCHEMA)
        sizes = [len(t.feature) for t in self.trees]
        column = {c: np.concatenate([getattr(t, c) for t in self.trees]) for c in ("feature", "cut", "left", "right", "value", "gain")}
        leaf = column["feature"] < 0
        # Edges of all features one after the other.
        offsets = np.concatenate([[0], np.cumsum([len(e) for e in self.edges])])
        flat = np.concatenate([*self.edges, [0.0]])
        column["threshold"] = flat[np.where(leaf, 0, offsets[column["feature"]] + column["cut"])]
        made = {"tree": pa.array(np.repeat(np.arange(len(sizes)), sizes), pa.int32()),
                "node": pa.array(np.concatenate([np.arange(n) for n in sizes]), pa.int32())}
        made |= {c: pa.array(column[c], pa.int32(), mask=leaf) for c in ("feature", "cut", "left", "right")}
        made |= {"threshold": pa.array(column["threshold"], mask=leaf), "value": pa.array(column["value"]), "gain": pa.array(column["gain"])}
        return spark.createDataFrame(pa.table(made), NODES_SCHEMA)

    def save(self, path: str) -> None:
        """Nodes, bin edges and settings as tables below `path`."""
        spark = SparkSession.active()
        self.nodes().coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        edges = [(f, [float(x) for x in e]) for f, e in enumerate(self.edges)]
        spark.createDataFrame(edges, "feature int, edges array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/edges")
        settings = {**self.settings.__dict__, "base": float(self.base)}
        spark.createDataFrame([(repr(settings),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/settings")

    @staticmethod
    def load(path: str) -> TreeModel:
        spark = SparkSession.active()
        settings = ast.literal_eval(spark.read.text(f"{path}/settings").first()[0])
        base = settings.pop("base")
        edges = [np.array(r["edges"]) for r in spark.read.parquet(f"{path}/edges").orderBy("feature").collect()]
        nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"])
        trees = []
        for _, rows in nodes.groupby("tree"):
            whole = [rows[c].fillna(-1).to_numpy(np.int32) for c in ("feature", "cut", "left", "right")]
            trees.append(Tree(*whole, rows["value"].to_numpy(np.float64), rows["gain"].to_numpy(np.float64)))
        return TreeModel(TreeSettings(**settings), edges, base, trees)
