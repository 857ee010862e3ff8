"""A classifier of sequences: stacked LSTM layers, a dense layer, a sigmoid.

Training is synchronous and data-parallel.  The sequences (H5) are placed by a hash of
their key and held as blocks; each step sends the parameters out, every task runs its
part of the step's batch forward and back, and the gradients are added up in further tasks, in a
tree where there are many: one vector of the model's size comes back.
Adam moves the parameters on the driver.  After each epoch the same pass without
gradients gives the loss of the validation tail (H7): the rate is halved when it stalls,
training ends when it has not improved for ``patience`` epochs, and the best parameters
are kept.

Which sequences make a batch and which units drop out follow from hashes of key, seed
and step, so a run can be repeated, and a lost task is simply run again.

Attributions are integrated gradients: the gradient of the log odds along the straight line from a
background sequence to the row's, by Gauss-Legendre quadrature, times the difference,
averaged over the background.  They add up to the row's log odds less the
background's mean, up to the error of the quadrature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

ROWS = 1 << 14        # sequences of a block
FLAT = 32             # gradients that one task adds
AT_ONCE = 2048        # sequences run forward together


@dataclass
class Net:
    """Sizes of the layers and the parameters in one vector."""
    features: int
    hidden: tuple[int, ...] = (128, 64, 32)
    dense: int = 16
    values: np.ndarray = field(default=None)

    def shapes(self) -> list[tuple[int, ...]]:
        out, wide = [], self.features
        for h in self.hidden:
            out += [(wide, 4 * h), (h, 4 * h), (4 * h,)]
            wide = h
        return [*out, (wide, self.dense), (self.dense,), (self.dense, 1), (1,)]

    def parts(self, values: np.ndarray | None = None) -> list[np.ndarray]:
        values, out, at = self.values if values is None else values, [], 0
        for s in self.shapes():
            n = int(np.prod(s))
            out.append(values[at:at + n].reshape(s))
            at += n
        return out

    def drawn(self, seed: int) -> Net:
        """Parameters between -1 and 1 over the root of the units that read them."""
        rnd = np.random.default_rng(seed)
        widths = [h for h in self.hidden for _ in range(3)] + [self.hidden[-1]] * 2 + [self.dense] * 2
        self.values = np.concatenate([rnd.uniform(-1, 1, int(np.prod(s))) / np.sqrt(w) for s, w in zip(self.shapes(), widths)])
        return self


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def forward(net: Net, x: np.ndarray, masks: list[np.ndarray] | None = None) -> tuple[np.ndarray, list]:
    """Log odds of the sequences ``x`` (rows, steps, features), and what the way back needs."""
    p, kept, given = net.parts(), [], x
    for k, width in enumerate(net.hidden):
        wx, wh, b = p[3 * k:3 * k + 3]
        h = c = np.zeros((len(x), width))
        outs, steps = [], []
        for t in range(given.shape[1]):
            z = given[:, t] @ wx + h @ wh + b
            i, f, o = (sigmoid(z[:, j * width:(j + 1) * width]) for j in (0, 1, 3))
            g = np.tanh(z[:, 2 * width:3 * width])
            before, c = c, f * c + i * g
            steps.append((i, f, g, o, before, np.tanh(c), h))
            h = o * steps[-1][5]
            outs.append(h)
        kept.append((given, steps))
        given = np.stack(outs, axis=1)
        if masks:
            given = given * masks[k][:, None, :]
    last = given[:, -1]
    w1, b1, w2, b2 = p[-4:]
    middle = np.maximum(last @ w1 + b1, 0)
    shown = middle * masks[-1] if masks else middle
    return (shown @ w2 + b2)[:, 0], [*kept, (last, middle, shown)]


def backward(net: Net, kept: list, slope: np.ndarray, masks: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(gradient of the parameters, gradient of the input) for ``slope``, the loss's derivative by each row's log odds."""
    p = net.parts()
    total = np.zeros(len(net.values))
    g = net.parts(total)
    last, middle, shown = kept[-1]
    w1, _, w2, _ = p[-4:]
    g[-2][:], g[-1][:] = shown.T @ slope[:, None], slope.sum()
    back = slope[:, None] * w2.T
    back = (back * masks[-1] if masks else back) * (middle > 0)
    g[-4][:], g[-3][:] = last.T @ back, back.sum(axis=0)
    flow = np.zeros((len(slope), len(kept[0][1]), net.hidden[-1]))
    flow[:, -1] = back @ w1.T
    for k in reversed(range(len(net.hidden))):
        given, steps = kept[k]
        wx, wh, _ = p[3 * k:3 * k + 3]
        if masks:
            flow = flow * masks[k][:, None, :]
        below = np.zeros(given.shape)
        dh = dc = np.zeros((len(slope), net.hidden[k]))
        for t in reversed(range(len(steps))):
            i, f, cand, o, before, tc, h = steps[t]
            dh = dh + flow[:, t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.hstack((dc * cand * i * (1 - i), dc * before * f * (1 - f), dc * i * (1 - cand * cand), dh * tc * o * (1 - o)))
            g[3 * k][:] += given[:, t].T @ dz
            g[3 * k + 1][:] += h.T @ dz
            g[3 * k + 2][:] += dz.sum(axis=0)
            below[:, t] = dz @ wx.T
            dh, dc = dz @ wh.T, dc * f
        flow = below
    return total, flow


def losses(odds: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, odds) - y * odds


def masks_of(net: Net, rows: np.ndarray, share: float, seed: int) -> list[np.ndarray] | None:
    """Units that stay, scaled up, for rows known by a hash each: the same wherever they are run."""
    if not share:
        return None
    widths = [*net.hidden, net.dense]
    out, units = [], np.arange(sum(widths), dtype=np.uint64)
    x = rows.astype(np.uint64)[:, None] ^ (units * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))[None, :]
    for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(m)
    keep = ((x >> np.uint64(40)).astype(float) / (1 << 24) >= share) / (1 - share)
    for w in widths:
        out.append(keep[:, :w])
        keep = keep[:, w:]
    return out


# ---- sequences --------------------------------------------------------------

def matrix(column: pa.Array, features: int) -> np.ndarray:
    """(rows, steps, features) of a column of flattened sequences of equal length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1, features) if len(column) else np.zeros((0, 1, features))


def flat(seq: str) -> Column:
    """The steps' features in one array; nulls and NaN count as 0, the mean of standardised features."""
    every = F.flatten(F.transform(seq, lambda s: s["x"]))
    return F.transform(every, lambda v: F.coalesce(F.nanvl(v.cast("double"), F.lit(0.0)), F.lit(0.0)))


def held_blocks(spark: SparkSession, seqs: DataFrame, keys: list[str], label: str, part: str, features: int):
    """The sequences as an RDD of (part is 'fit', hashes, x, y): placed and ordered by a hash of the key."""
    rows = seqs.select(F.xxhash64(*keys).alias("h"), (F.col(part) == "fit").alias("fit"), flat("seq").alias("x"), F.col(label).cast("double").alias("y"))
    path = scratch_path(spark, "sequence-rows")
    rows.where("y is not null").write.parquet(path)
    rows = spark.read.parquet(path)
    n = rows.count()
    tasks = max(1, min(-(-n // 512), spark.sparkContext.defaultParallelism), -(-n // (16 * ROWS)))
    placed = rows.repartition(tasks, "h").sortWithinPartitions("h", "y", "x")
    schema = "fit boolean, n long, h binary, x binary, y binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                own = b.slice(at, ROWS)
                x, fit = matrix(own.column(2), features), own.column(1).to_numpy(zero_copy_only=False)
                for side in (True, False):
                    on = fit == side
                    if on.any():
                        h, y = own.column(0).to_numpy(zero_copy_only=False)[on], own.column(3).to_numpy(zero_copy_only=False)[on]
                        yield pa.RecordBatch.from_pydict({"fit": [side], "n": [int(on.sum())], "h": [h.astype("<i8").tobytes()],
                                                          "x": [x[on].astype("<f4").tobytes()], "y": [y.astype("<f4").tobytes()]})

    path = scratch_path(spark, "sequence-blocks")
    placed.mapInArrow(pack, schema).write.parquet(path)
    stored = spark.read.parquet(path)
    counts = {r.fit: r.n for r in stored.groupBy("fit").agg(F.sum("n").alias("n")).collect()}
    return stored.repartitionByRange(tasks, "h").sortWithinPartitions("fit", "h").rdd.map(tuple), tasks, counts


def pass_over(rows: Iterator[tuple], net: Net, fit: bool, batches: int, batch: int, share: float, seed: int) -> tuple[float, int, np.ndarray]:
    """(loss, rows, gradient), summed over a task's sequences of a batch; no gradient for the validation side."""
    loss, n, total = 0.0, 0, np.zeros(len(net.values) if fit else 0)
    for side, count, h, x, y in rows:
        if side != fit:
            continue
        h, y = np.frombuffer(h, "<i8"), np.frombuffer(y, "<f4")
        x = np.frombuffer(x, "<f4").reshape(count, -1, net.features)
        on = np.flatnonzero(h.view(np.uint64) % np.uint64(batches) == batch)
        for at in range(0, len(on), AT_ONCE):
            own = on[at:at + AT_ONCE]
            masks = masks_of(net, h[own], share, seed) if fit else None
            odds, kept = forward(net, x[own].astype(float), masks)
            loss += float(losses(odds, y[own]).sum())
            n += len(own)
            if fit:
                total += backward(net, kept, sigmoid(odds) - y[own], masks)[0]
    return loss, n, total


def summed(parts: RDD, tasks: int) -> tuple:
    """The sum of (loss, rows, gradient) over (task, its part): up to ``FLAT`` are added in one task, in the order of the
    tasks, until one is left.  One gradient reaches the driver, however many tasks there are."""
    while tasks > 1:
        tasks = -(-tasks // FLAT)
        parts = (parts.map(lambda p: (p[0] // FLAT, p)).groupByKey(tasks)
                 .mapValues(lambda own: tuple(sum(x) for x in zip(*[v for _, v in sorted(own, key=lambda p: p[0])]))))
    return parts.values().first()


def fit(spark: SparkSession, seqs: DataFrame, features: int, keys=("symbol", "date"), label: str = "label", part: str = "part",
        hidden=(128, 64, 32), dense: int = 16, epochs: int = 50, batch: int = 1024, rate: float = 0.001, dropout: float = 0.3,
        patience: int = 15, stall: int = 5, least_rate: float = 1e-5, seed: int = 42) -> tuple[Net, list[tuple[int, float, float, float]]]:
    """The net with the least validation loss, and (epoch, loss of the fit part, of the validation part, rate) for
    each epoch.  ``batch`` is about how many sequences make a step, over all tasks.  Without a validation part the
    loss of the fit part decides; without sequences it is an error."""
    held, tasks, counts = held_blocks(spark, seqs, list(keys), label, part, features)
    if not counts.get(True):
        raise ValueError("no sequences to fit")
    held = held.persist()
    net = Net(features, tuple(hidden), dense).drawn(seed)
    steps = max(1, round(counts[True] / batch))

    def added(fit_side: bool, batches: int, which: int, now: int):
        def run(k, rows):
            yield k, pass_over(rows, net, fit_side, batches, which, dropout, now)
        return summed(held.mapPartitionsWithIndex(run), tasks)

    first = second = np.zeros(len(net.values))
    best, best_loss, waited, stalled, done, history = net.values, np.inf, 0, 0, 0, []
    try:
        for epoch in range(epochs):
            loss = seen = 0
            for which in range(steps):
                part_loss, n, gradient = added(True, steps, which, (seed << 20) + done)
                loss, seen, done = loss + part_loss, seen + n, done + 1
                if n:
                    gradient = gradient / n
                    first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient ** 2
                    net.values = net.values - rate * (first / (1 - 0.9 ** done)) / (np.sqrt(second / (1 - 0.999 ** done)) + 1e-8)
            fit_loss = loss / max(1, seen)
            val_loss, n, _ = added(False, 1, 0, 0) if counts.get(False) else (fit_loss, 1, None)
            val_loss = val_loss / max(1, n)
            history.append((epoch, fit_loss, val_loss, rate))
            if val_loss < best_loss:
                best, best_loss, waited, stalled = net.values, val_loss, 0, 0
            else:
                waited, stalled = waited + 1, stalled + 1
                if stalled > stall:
                    rate, stalled = max(least_rate, rate / 2), 0
            if waited >= patience:
                break
    finally:
        held.unpersist()
    net.values = best
    return net, history


def store(spark: SparkSession, net: Net, path: str) -> str:
    spark.createDataFrame([(net.features, list(net.hidden), net.dense, net.values.tolist())],
                          "features int, hidden array<int>, dense int, values array<double>").write.mode("overwrite").parquet(path)
    return path


def load(spark: SparkSession, path: str) -> Net:
    r = spark.read.parquet(path).first()
    return Net(r.features, tuple(r.hidden), r.dense, np.array(r["values"]))


def mapped(df: DataFrame, seq: str, net: Net, work, added: T.StructType) -> DataFrame:
    """``df`` with the columns that ``work`` makes of the matrix of its sequences."""
    names = [*df.columns, *added.names]
    from pyspark.sql.pandas.types import to_arrow_schema
    kinds = to_arrow_schema(added).types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, AT_ONCE):
                part = b.slice(at, AT_ONCE)
                new = work(matrix(part.columns[-1], net.features))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *[pa.array(c, k) for c, k in zip(new, kinds)]], names=names)
    return df.select("*", flat(seq).alias("_flat")).mapInArrow(run, T.StructType([*df.schema.fields, *added.fields]))


def predict(net: Net, df: DataFrame, seq: str = "seq", threshold: float = 0.5) -> DataFrame:
    """``df`` with p_up and predicted_signal."""
    out = mapped(df, seq, net, lambda x: [sigmoid(forward(net, x)[0])], T.StructType([T.StructField("p_up", T.DoubleType())]))
    return out.withColumn("predicted_signal", (F.col("p_up") > threshold).cast("int"))


def background(seqs: DataFrame, keys: list[str], features: int, rows: int = 16) -> np.ndarray:
    """``rows`` sequences, the first by a hash of their key: a bounded sample."""
    held = seqs.select(F.xxhash64(*keys).alias("h"), flat("seq").alias("x")).orderBy("h").limit(rows).collect()
    return np.array([r.x for r in held]).reshape(len(held), -1, features)


def attributions(net: Net, df: DataFrame, base: np.ndarray, seq: str = "seq", points: int = 8) -> DataFrame:
    """``df`` with log_odds, base_value and attributions: an array of structs (x: a value for each feature), one for each step."""
    at, weight = np.polynomial.legendre.leggauss(points)
    at, weight = (at + 1) / 2, weight / 2
    zero = float(forward(net, base)[0].mean())

    def work(x: np.ndarray) -> list:
        total = np.zeros(x.shape)
        for b in base:
            for a, w in zip(at, weight):
                kept = forward(net, b + a * (x - b))[1]
                total += w * backward(net, kept, np.ones(len(x)))[1] * (x - b)
        total /= len(base)
        return [forward(net, x)[0], np.full(len(x), zero), [[{"x": s} for s in row] for row in total.tolist()]]

    step = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))])
    return mapped(df, seq, net, work, T.StructType([T.StructField("log_odds", T.DoubleType()), T.StructField("base_value", T.DoubleType()),
                                                    T.StructField("attributions", T.ArrayType(step))]))
