"""Boosted trees for many models at once, as Spark jobs over one table of binned rows.

A model is a set of features and a part of the labelled rows that it does not train on. All models grow their trees
together: one job adds up the gradients of every open node of every model by feature and bin, and finds each node's best
split where the sums meet; only splits come to the driver. Labelled rows are kept in blocks of thousands, column by
column: a block's bins and margins are one array each, so that a job adds up whole columns and no row is handled by
itself. Margins are written anew with each chunk of rounds, when the exact area under the curve of every round in the
chunk decides which models go on.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import quoted
from tallyloom.functions.scalars import name as col_name
from tallyloom.operators.staging import large_rows, passing, release, stage

#: Features whose sums are one row of the exchange, and rows whose trees are applied at once.
FEATURES_TOGETHER, ROWS_TOGETHER = 16, 4_096

#: Rows of a block, fewer if its bins or margins would take more bytes.
ROWS_IN_BLOCK, BYTES_IN_BLOCK = 8_192, 4 << 20


@dataclass(frozen=True)
class BoostSettings:
    """Defaults are those of the published run; ``rounds`` ends with ``patience`` rounds without a better held-out AUC."""

    rounds: int = 10_000
    patience: int = 200
    step: float = 0.02
    leaves: int = 20
    depth: int = 8
    bins: int = 64
    row_sample: float = 0.8715623
    column_sample: float = 0.9497036
    l1: float = 0.041545473
    l2: float = 0.0735294
    min_gain: float = 0.0222415
    # smallest sum of second derivatives, and of rows, in a leaf
    min_weight: float = 60.0
    min_rows: int = 20
    seed: int = 0
    # rounds between two writes of the margins
    chunk: int = 5


@dataclass
class Tree:
    """Nodes in order of creation; a node without a feature is a leaf. Rows with a bin up to ``cut`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row; ``bins`` has a row for each feature. A split's right child follows its left one."""
        at = np.zeros(bins.shape[1], np.uint8 if len(self.feature) <= 256 else np.uint32)
        for node, feature in enumerate(self.feature):
            if feature >= 0:
                here = (at == node).view(np.uint8)
                right = (bins[feature] > self.cut[node]).view(np.uint8)
                right &= here
                at += here.astype(at.dtype, copy=False) * at.dtype.type(self.left[node] - node)
                at += right
        return at

    def split(self, node: int, feature: int, cut: int, gain: float) -> tuple[int, int]:
        children = len(self.feature), len(self.feature) + 1
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        self.left[node], self.right[node] = children
        for column, value in zip((self.feature, self.cut, self.left, self.right, self.value, self.gain), (-1, 0, 0, 0, 0.0, 0.0), strict=True):
            column += [value, value]
        return children


@dataclass(frozen=True)
class Task:
    """One model to train: its name, the fold it is judged on, its features (places in the vector), its first margin."""

    name: str
    fold: int
    features: tuple[int, ...]
    margin: float = 0.0


@dataclass
class Trained:
    task: Task
    trees: list[Tree]
    best: int  # trees up to the round of the best held-out AUC
    history: list[float]  # held-out AUC of each round


def _quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], error: float) -> list[list[float]]:
    """As ``approxQuantile``, which fetches the numbers one by one; here those of a column come together."""
    context = df.sparkSession.sparkContext
    jvm, new_array = context._jvm, context._gateway.new_array
    names, places = new_array(jvm.java.lang.String, len(columns)), new_array(jvm.double, len(shares))
    for array, values in ((names, columns), (places, shares)):
        for i, value in enumerate(values):
            array[i] = value
    found = df._jdf.stat().approxQuantile(names, places, float(error))
    texts = (jvm.java.util.Arrays.toString(found[i])[1:-1] for i in range(len(columns)))
    return [[float(x) for x in text.split(", ") if x] for text in texts]


def cut_points(df: DataFrame, features: Sequence[str], bins: int, error: float = 0.001) -> list[np.ndarray]:
    """Distinct cut points of each feature, near its quantiles; one pass over all columns."""
    names = [f"__{i}" for i in range(len(features))]
    doubles = df.selectExpr(*[f"double({col_name(c)}) AS {n}" for c, n in zip(features, names, strict=True)])
    finite = doubles.selectExpr(*[f"IF(isnan({n}) OR abs({n}) = double('infinity'), NULL, {n}) AS {n}" for n in names])
    shares = [i / (bins - 1) for i in range(1, bins - 1)]
    return [np.unique(np.array(points, float)) for points in _quantiles(finite, names, shares, error)]


def _binned_batches(batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    kept = 4
    for batch in batches:
        out = np.zeros((batch.num_rows, len(cuts)), np.uint8)
        for i, points in enumerate(cuts):
            values = batch.column(kept + i).to_numpy(zero_copy_only=False).astype(float)
            out[:, i] = np.where(np.isnan(values), 0, 1 + np.searchsorted(points, values))
        raw = pa.array([row.tobytes() for row in out], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:kept], raw], names=["__key", "__label", "fold", "__draw", "bins"])


def binned(df: DataFrame, key: str, label: str, fold: str, features: Sequence[str], bins: int) -> DataFrame:
    """key, label, fold, a number to draw by, and a byte for each feature: 0 if missing, else its place among the cut points."""
    if not 3 <= bins <= 255:
        raise ValueError("bins: 3 to 255")
    cuts = cut_points(df, features, bins)
    kind = df.schema[key].dataType.simpleString()
    columns = [quoted(key).alias("__key"), quoted(label).cast("double").alias("__label"), quoted(fold).cast("int").alias("fold")]
    rows = df.select(*columns, F.xxhash64(quoted(key)).alias("__draw"), *[quoted(c).cast("double").alias(f"__{i}") for i, c in enumerate(features)])
    return rows.mapInArrow(partial(_binned_batches, cuts=cuts), f"__key {kind}, __label double, fold int, __draw long, bins binary")


def _drawn(draw: np.ndarray, salt: int, share: float) -> np.ndarray:
    """Which rows take part: a share of them, by the row's number and ``salt`` alone."""
    with np.errstate(over="ignore"):
        x = draw.view(np.uint64) + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (x >> np.uint64(11)) < np.uint64(int(share * (1 << 53)))


def _salt(seed: int, round_number: int, fold: int) -> int:
    return (seed * 1_000_003 + round_number) * 1_009 + fold + 1


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, width)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_TOGETHER):
            yield batch.slice(start, ROWS_TOGETHER)


_BLOCK = "rows int, label binary, fold binary, draw binary, bins binary, margins binary"
#: A row is some megabytes, so sizes are looked at after few rows.
_BLOCK_FILES = {"parquet.block.size": 32 << 20, "parquet.page.size.row.check.min": 1, "parquet.block.size.row.check.min": 1}


def _blocks(batches: Iterator[pa.RecordBatch], first: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    """Labelled rows in blocks; bins have a row for each feature, margins one for each model."""
    most = max(1, min(ROWS_IN_BLOCK, BYTES_IN_BLOCK // max(1, width, 8 * len(first))))
    names = [part.split()[0] for part in _BLOCK.split(", ")]

    def block(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        label, fold, draw, bins = (np.concatenate(x) for x in zip(*parts, strict=True))
        margins = np.repeat(first[:, None], len(label), axis=1)
        arrays = label.astype("<f8"), fold.astype("<i4"), draw.astype("<i8"), np.ascontiguousarray(bins.T), margins.astype("<f8")
        return pa.RecordBatch.from_arrays([pa.array([len(label)], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in arrays]], names=names)

    held, n = [], 0
    for batch in _slices(batches):
        label = batch.column("__label").to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(~np.isnan(label))
        columns = label, batch.column("fold").to_numpy(), batch.column("__draw").to_numpy(), _matrix(batch, width)
        columns = [x[rows] for x in columns]
        while len(columns[0]):
            room = most - n
            held.append(tuple(x[:room] for x in columns))
            n += len(held[-1][0])
            columns = [x[room:] for x in columns]
            if n == most:
                yield block(held)
                held, n = [], 0
    if n:
        yield block(held)


@dataclass(frozen=True)
class _Block:
    label: np.ndarray
    fold: np.ndarray
    draw: np.ndarray
    bins: np.ndarray
    margins: np.ndarray


def _unpacked(batch: pa.RecordBatch, width: int, models: int) -> Iterator[_Block]:
    for i in range(batch.num_rows):
        n = batch.column("rows")[i].as_py()
        label, fold, draw, bins, margins = (
            np.frombuffer(batch.column(c)[i].as_buffer(), kind)
            for c, kind in (("label", "<f8"), ("fold", "<i4"), ("draw", "<i8"), ("bins", np.uint8), ("margins", "<f8"))
        )
        yield _Block(label, fold, draw, bins.reshape(width, n), margins.reshape(models, n))


def _advanced(margin: np.ndarray, bins: np.ndarray, grown: Sequence[Tree], step: float) -> np.ndarray:
    for tree in grown:
        margin = margin + step * np.array(tree.value)[tree.leaf_of(bins)]
    return margin


def _gradients(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = 1 / (1 + np.exp(-margin))
    return p - label, p * (1 - p)


@dataclass(frozen=True)
class _Round:
    """What a histogram job needs to know of each model that grows: tasks, trees of the chunk, the growing tree, open nodes."""

    number: int
    tasks: dict[int, Task]
    trees: dict[int, list[Tree]]
    growing: dict[int, Tree]
    nodes: dict[int, list[int]]
    features: dict[int, np.ndarray]
    models: int
    width: int
    settings: BoostSettings


_SUMS = "model int, node int, block int, sums binary"


def _sums(batches: Iterator[pa.RecordBatch], r: _Round) -> Iterator[pa.RecordBatch]:
    """Sums of both derivatives and of rows for each open node, feature and bin over the task's rows."""
    s, totals = r.settings, {}
    for block in (block for batch in batches for block in _unpacked(batch, r.width, r.models)):
        taken: dict[int, np.ndarray] = {}
        for model, tree in r.growing.items():
            fold, used, nodes = r.tasks[model].fold, r.features[model], r.nodes[model]
            if fold not in taken:
                taken[fold] = np.flatnonzero((block.fold != fold) & _drawn(block.draw, _salt(s.seed, r.number, fold), s.row_sample))
            slots = np.full(len(tree.feature), -1)
            slots[nodes] = np.arange(len(nodes))
            slot = slots[tree.leaf_of(block.bins)[taken[fold]]]
            rows, first = taken[fold][slot >= 0], slot[slot >= 0] * s.bins
            weights = np.empty(len(rows), complex)
            margin = _advanced(block.margins[model], block.bins, r.trees[model], s.step)
            weights.real, weights.imag = _gradients(margin[rows], block.label[rows])
            size = len(nodes) * s.bins
            if model not in totals:
                totals[model] = np.zeros((len(used), size), complex), np.zeros((len(used), size), np.int64)
            both, counts = totals[model]
            for i, feature in enumerate(used):
                # a column at a time, so that its sums stay in the processor's cache
                cells = first + block.bins[feature].take(rows)
                np.add.at(both[i], cells, weights)
                counts[i] += np.bincount(cells, minlength=size)
    rows = []
    for model, (both, counts) in totals.items():
        for slot, node in enumerate(r.nodes[model]):
            own = slice(slot * s.bins, (slot + 1) * s.bins)
            for start in range(0, len(both), FEATURES_TOGETHER):
                some = slice(start, start + FEATURES_TOGETHER)
                sums = np.stack([both.real[some, own], both.imag[some, own], counts[some, own]], axis=-1)
                rows.append((model, node, start // FEATURES_TOGETHER, sums.astype("<f8").tobytes()))
    for start in range(0, len(rows), 500):
        columns = zip(*rows[start : start + 500], strict=True)
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["model", "node", "block", "sums"])


def _score(g: np.ndarray, h: np.ndarray, s: BoostSettings) -> np.ndarray:
    return np.maximum(np.abs(g) - s.l1, 0) ** 2 / (h + s.l2)


def leaf_value(g: float, h: float, s: BoostSettings) -> float:
    return float(-np.sign(g) * max(abs(g) - s.l1, 0) / (h + s.l2))


def best_split(sums: np.ndarray, s: BoostSettings) -> tuple[float, int, int, np.ndarray, np.ndarray]:
    """Gain, feature, cut, sums to the left and sums of all, for ``sums`` (feature, bin, 3); gain 0 if no split is allowed."""
    left = np.cumsum(sums, axis=1)[:, :-1]
    whole = sums[0].sum(axis=0)
    right = whole - left
    gain = _score(left[..., 0], left[..., 1], s) + _score(right[..., 0], right[..., 1], s) - _score(whole[0], whole[1], s)
    allowed = np.minimum(left[..., 1], right[..., 1]) >= s.min_weight
    allowed &= np.minimum(left[..., 2], right[..., 2]) >= s.min_rows
    gain = np.where(allowed & (gain > s.min_gain), gain, 0.0)
    feature, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return float(gain[feature, cut]), int(feature), int(cut), left[feature, cut], whole


_SPLIT = "model int, node int, gain double, feature int, cut int, gl double, hl double, nl double, g double, h double, n double"


def _splits(batches: Iterator[pa.RecordBatch], r: _Round) -> Iterator[pa.RecordBatch]:
    """Adds up the tasks' sums and returns the best split of each node within each block of features."""
    held: dict[tuple[int, int, int], np.ndarray] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            model, node, block, raw = (c[i].as_py() for c in batch.columns)
            sums = np.frombuffer(raw, "<f8")
            held[model, node, block] = held[model, node, block] + sums if (model, node, block) in held else sums
    rows = []
    for (model, node, block), sums in sorted(held.items()):
        gain, feature, cut, left, whole = best_split(sums.reshape(-1, r.settings.bins, 3), r.settings)
        rows.append((model, node, gain, int(r.features[model][block * FEATURES_TOGETHER + feature]), cut, *left.tolist(), *whole.tolist()))
    if rows:
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.int32(), pa.int32(), *[pa.float64()] * 6]
        names = [part.split()[0] for part in _SPLIT.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _grow(state: DataFrame, r: _Round) -> None:
    """Grows one tree for each model, level by level; a job for each level serves all of them."""
    s, leaves, depth = r.settings, dict.fromkeys(r.growing, 1), 0
    while r.growing:
        sums = state.mapInArrow(partial(_sums, r=r), _SUMS).repartition("model", "node", "block")
        best: dict[tuple[int, int], tuple] = {}
        for row in sums.mapInArrow(partial(_splits, r=r), _SPLIT).collect():  # a row for each open node and block of features
            known = best.get((row.model, row.node))
            if known is None or (-row.gain, row.feature) < (-known.gain, known.feature):
                best[row.model, row.node] = row
        nodes: dict[int, list[int]] = {m: [] for m in r.growing}
        for row in sorted(best.values(), key=lambda x: (x.model, -x.gain, x.node)):
            tree = r.growing[row.model]
            if depth == 0:
                tree.value[0] = leaf_value(row.g, row.h, s)
            if row.gain > 0 and leaves[row.model] < s.leaves:
                children = tree.split(row.node, row.feature, row.cut, row.gain)
                left = (row.gl, row.hl)
                for child, (g, h) in zip(children, (left, (row.g - left[0], row.h - left[1])), strict=True):
                    tree.value[child] = leaf_value(g, h, s)
                leaves[row.model] += 1
                nodes[row.model] += children
        depth += 1
        open_models = {m for m in r.growing if nodes[m] and leaves[m] < s.leaves and depth < s.depth}
        r = replace(r, growing={m: t for m, t in r.growing.items() if m in open_models}, nodes={m: nodes[m] for m in open_models})


def _next_margins(batches: Iterator[pa.RecordBatch], r: _Round) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = []
        for block in _unpacked(batch, r.width, r.models):
            rows = [_advanced(block.margins[m], block.bins, r.trees.get(m, ()), r.settings.step) for m in range(r.models)]
            raw.append(np.stack(rows).astype("<f8").tobytes())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(raw, pa.binary())], names=batch.schema.names)


def _held_out_margins(batches: Iterator[pa.RecordBatch], r: _Round) -> Iterator[pa.RecordBatch]:
    """model, round, label, margin of held-out rows after each round of the chunk."""
    for block in (block for batch in batches for block in _unpacked(batch, r.width, r.models)):
        for model, grown in r.trees.items():
            rows = np.flatnonzero(block.fold == r.tasks[model].fold)
            margin, bins = block.margins[model, rows], block.bins[:, rows]
            for number, tree in enumerate(grown):
                margin = _advanced(margin, bins, [tree], r.settings.step)
                columns = [np.full(len(rows), model, np.int32), np.full(len(rows), number, np.int32), block.label[rows], margin]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["model", "round", "label", "margin"])


def trained(table: DataFrame, tasks: Sequence[Task], width: int, settings: BoostSettings, auc) -> list[Trained]:
    """Trains every task on ``table`` (see ``binned``, written), stopping each by the AUC of its own held-out fold.

    ``auc`` gives the exact area by groups (``evaluate.auc``). Rounds after ``patience`` rounds without a better value are
    dropped, as are trees after the best round. A model whose tree has no split left is done.
    """
    s = settings
    totals = table.where("__label IS NOT NULL").groupBy("fold").agg(F.sum("__label").alias("ones"), F.count("*").alias("n")).collect()  # folds
    out = []
    for task in tasks:
        ones, n = (sum(row[k] for row in totals if row.fold != task.fold) for k in ("ones", "n"))
        share = min(max(ones / n, 1e-6), 1 - 1e-6) if n else 0.5
        out.append(Trained(replace(task, margin=float(np.log(share / (1 - share)))), [], 0, []))
    with large_rows(table.sparkSession):
        return _boosted(table, out, width, s, auc)


def _boosted(table: DataFrame, out: list[Trained], width: int, s: BoostSettings, auc) -> list[Trained]:
    blocks = partial(_blocks, first=np.array([t.task.margin for t in out]), width=width)
    state = stage(table.where("__label IS NOT NULL").mapInArrow(blocks, _BLOCK), **_BLOCK_FILES)
    going, number = set(range(len(out))), 0
    while going and number < s.rounds:
        chunk: dict[int, list[Tree]] = {m: [] for m in sorted(going)}
        finished = set()
        for _ in range(min(s.chunk, s.rounds - number)):
            growing = {m: Tree() for m in sorted(going - finished)}
            if not growing:
                break
            chosen = {m: _chosen_features(out[m].task, s, number) for m in growing}
            r = _Round(number, {m: out[m].task for m in chunk}, chunk, dict(growing), {m: [0] for m in growing}, chosen, len(out), width, s)
            _grow(state, r)
            for m, tree in growing.items():
                if len(tree.feature) == 1:
                    finished.add(m)
                else:
                    chunk[m].append(tree)
            number += 1
        chunk = {m: grown for m, grown in chunk.items() if grown}
        r = _Round(number, {m: out[m].task for m in chunk}, chunk, {}, {}, {}, len(out), width, s)
        judged = state.mapInArrow(partial(_held_out_margins, r=r), "model int, round int, label double, margin double")
        with passing(table.sparkSession):
            rows = auc(judged, "label", "margin", ["model", "round"]).collect()  # models times rounds of a chunk
        areas = {(x.model, x["round"]): x.auc for x in rows}
        for m in list(going):
            model = out[m]
            for i, tree in enumerate(chunk.get(m, [])):
                model.trees.append(tree)
                model.history.append(areas.get((m, i)) or 0.0)
                if model.history[-1] > max(model.history[: model.best], default=-1.0):
                    model.best = len(model.history)
                if len(model.history) - model.best >= s.patience:
                    finished.add(m)
                    break
        going -= finished
        if going and number < s.rounds:
            following = stage(state.mapInArrow(partial(_next_margins, r=r), _BLOCK), **_BLOCK_FILES)
            release(state)
            state = following
    release(state)
    for model in out:
        model.trees = model.trees[: model.best]
    return out


def _chosen_features(task: Task, s: BoostSettings, number: int) -> np.ndarray:
    """The features that a round may use: a share of the model's, drawn by the round's number."""
    places = np.array(sorted(task.features), np.int64)
    order = np.random.default_rng([s.seed, number]).permutation(len(places))
    return np.sort(places[order[: max(1, round(len(places) * s.column_sample))]])


_PREDICTED = "model int, label double, held_out boolean, prediction double"


def _predictions(batches: Iterator[pa.RecordBatch], models: list[Trained], width: int, step: float) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        label, fold = batch.column("__label").to_numpy(zero_copy_only=False), batch.column("fold").to_numpy()
        bins = np.ascontiguousarray(_matrix(batch, width).T)
        for number, model in enumerate(models):
            margin = _advanced(np.full(len(label), model.task.margin), bins, model.trees, step)
            known = ~np.isnan(label)
            columns = [pa.array(np.full(len(label), number, np.int32)), pa.array(label, from_pandas=True), pa.array(np.where(known, fold == model.task.fold, False), mask=~known)]
            yield pa.RecordBatch.from_arrays([batch.column("__key"), *columns, pa.array(1 / (1 + np.exp(-margin)))], names=["__key", *(p.split()[0] for p in _PREDICTED.split(", "))])


def predicted(table: DataFrame, models: Sequence[Trained], width: int, settings: BoostSettings) -> DataFrame:
    """__key, model, label, held_out (null without a label), prediction: all rows under all models, in one scan."""
    kind = table.schema["__key"].dataType.simpleString()
    step = partial(_predictions, models=list(models), width=width, step=settings.step)
    return table.mapInArrow(step, f"__key {kind}, {_PREDICTED}")


def gains(model: Trained, features: Sequence[str]) -> list[tuple[str, float]]:
    """What the splits on each feature of the model gained, added up over its trees."""
    total = dict.fromkeys(sorted(model.task.features), 0.0)
    for tree in model.trees:
        for feature, gain in zip(tree.feature, tree.gain, strict=True):
            if feature >= 0:
                total[feature] += gain
    return [(features[i], gain) for i, gain in total.items()]
