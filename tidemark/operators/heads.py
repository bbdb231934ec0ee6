"""Six linear heads on windows, fitted from blocked sums and scored in factors.

A sample is (date, symbol). Its features are the symbol's last ``window`` rows and the
last ``window`` rows of the news, which all symbols of a date share. No vector
of a sample's thousands of features is ever made:

* fitting needs the sums of x xᵀ and x y over the samples. Their stock part is summed in
  halo blocks, one small matrix a task; the news part of a date enters once, with
  the date's sums over its symbols; the news-news part is summed over date blocks. One
  task gets the whole matrix, of a size that the configuration fixes, and solves it;
* a head is a sum over the steps of the window: score = Σ step k of (row of step k) · (weights of
  step k). A block's rows are multiplied by each step's weights and added at the shifted
  position; the news of a date is scored once for all symbols.

``ridge`` solves the five continuous heads from one pass (a Cholesky solve of the standardised
moments) and the direction by reweighted steps of the same pass. ``marginal`` weighs each
feature by its own covariance: coarser, but it can be written in plain SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions.numeric import scale_clip
from tidemark.operators import dataset as DS
from tidemark.operators import halo
from tidemark.session import cut_lineage

HEADS = tuple(h for h, _ in C.LOSS_WEIGHTS)
LOG_HEADS = ("log_return_1d", "log_return_3d", "log_return_5d")
UP = HEADS.index("direction_1d")
RIDGE = 0.01          # penalty of a standardised weight, per sample
STEPS = 12            # at most so many reweighted steps
BUCKETS = 64          # symbols of a date block are dealt into so many parts
TILE = 128            # rows of the news matrix that are summed as one record
DATES = 1024          # dates of a news block


@dataclass(frozen=True)
class Heads:
    """Weights by (head, step, feature); ``link`` of the direction: logistic or linear."""

    stock: np.ndarray
    news: np.ndarray
    intercept: np.ndarray
    link: str = "logistic"

    @property
    def window(self) -> int:
        return self.stock.shape[1]

    def vectors(self) -> np.ndarray:
        """(heads, all weights), the stock's steps first."""
        q = len(self.intercept)
        return np.concatenate([self.stock.reshape(q, -1), self.news.reshape(q, -1)], axis=1)


def heads_of(vectors: np.ndarray, intercept: np.ndarray, window: int, n_stock: int,
             link: str) -> Heads:
    q = len(intercept)
    cut = window * n_stock
    return Heads(vectors[:, :cut].reshape(q, window, n_stock),
                 vectors[:, cut:].reshape(q, window, -1), intercept, link)


def save(heads: Heads, spark, path: str) -> None:
    """One row a weight: (head, part, step, feature, value), and the link."""
    rows = [("", heads.link, 0, 0, 0.0)]
    for k, h in enumerate(HEADS):
        rows.append((h, "intercept", 0, 0, float(heads.intercept[k])))
        for part in ("stock", "news"):
            m = getattr(heads, part)[k]
            rows += [(h, part, i, j, float(m[i, j])) for i in range(m.shape[0])
                     for j in range(m.shape[1])]
    (spark.createDataFrame(rows, "head string, part string, step int, feature int, value double")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/heads"))


def load(spark, path: str) -> Heads:
    rows = spark.read.parquet(f"{path}/heads").toPandas()     # a size the configuration fixes
    link = rows.loc[rows["head"] == "", "part"].iloc[0]
    found = {}
    for part in ("stock", "news"):
        own = rows[rows["part"] == part]
        m = np.zeros((len(HEADS), int(own["step"].max()) + 1, int(own["feature"].max()) + 1))
        m[own["head"].map(HEADS.index), own["step"], own["feature"]] = own["value"]
        found[part] = m
    own = rows[rows["part"] == "intercept"]
    intercept = np.zeros(len(HEADS))
    intercept[own["head"].map(HEADS.index)] = own["value"]
    return Heads(found["stock"], found["news"], intercept, link)


# --- samples ----------------------------------------------------------------


@dataclass(frozen=True)
class Samples:
    """``blocks``: (id, block, t0, x, y), a block's features and labels as flat arrays;
    ``news``: (localDate, t, values). Positions are those of the aligned dates."""

    blocks: DataFrame
    news: DataFrame
    index: DataFrame
    window: int
    n_dates: int
    first_validation: int
    n_validation: int
    n_news: int

    @property
    def n_stock(self) -> int:
        return len(C.PIVOTED_FEATURES)


def scaled_targets(targets: DataFrame) -> DataFrame:
    """(localDate, id, y_{head}…): doubles, log returns scaled and clipped."""
    y = {h: F.col(h).cast("double") for h in HEADS}
    return targets.select("localDate", "id", *[(scale_clip(y[h]) if h in LOG_HEADS else y[h])
                                               .alias(f"y_{h}") for h in HEADS])


def news_values(lagged: DataFrame, index: DataFrame) -> DataFrame:
    """(localDate, t, values): the news row of each indexed date as one array."""
    cols = [c for c in lagged.columns if c != "localDate"]
    return lagged.join(index, "localDate").select("localDate", "t", F.array(
        *[F.col(f"`{c}`").cast("double") for c in cols]).alias("values"))


def samples(panel: DataFrame, targets: DataFrame, lagged: DataFrame, aligned: DataFrame,
            window: int = C.WINDOW_SIZE) -> Samples:
    """The aligned dataset in halo blocks, stored once: a fit passes over it twice,
    and once more for each reweighted step."""
    index = cut_lineage(DS.date_index(aligned))
    n = index.count()                                    # one row per day
    first, held = DS.split_point(n, window)
    rows = panel.join(scaled_targets(targets), ["localDate", "id"], "left")
    names = [*C.PIVOTED_FEATURES, *[f"y_{h}" for h in HEADS]]
    parts = halo.blocked(rows.select("localDate", "id", *names), index, window, names, ["id"])
    blocks = halo.arrays(parts, x=lambda r: [r[f] for f in C.PIVOTED_FEATURES],
                         y=lambda r: [r[f"y_{h}"] for h in HEADS])
    news = cut_lineage(news_values(lagged, index))
    return Samples(cut_lineage(blocks), news, index, window, n, first, held,
                   len(lagged.columns) - 1)


def _flat(column: pa.Array) -> np.ndarray:
    """The values of a one-row list column, null as NaN."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)


def block_arrays(batches: Iterator[pa.RecordBatch], window: int, n_stock: int, past: bool):
    """(row of the batch, first sample, X, Y) of each block; Y is empty without labels.

    ``past``: the sample after the last row is one too (its window is full)."""
    size = max(halo.BLOCK, window)
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            get = lambda c: row.column(row.schema.get_field_index(c))  # noqa: E731, B023
            x = _flat(get("x")).reshape(-1, n_stock)
            y = _flat(get("y")).reshape(len(x), -1) if "y" in row.schema.names else np.zeros((0, 0))
            t0, block = get("t0")[0].as_py(), get("block")[0].as_py()
            lo, hi = max(block * size, t0 + window), min((block + 1) * size, t0 + len(x) + past)
            if lo < hi:
                yield row, t0, lo, hi, x, y


def steps_of(x: np.ndarray, t0: int, lo: int, hi: int, window: int) -> np.ndarray:
    """(samples, window * features): the rows before each sample, oldest first."""
    at = lo - t0 - window
    return np.concatenate([x[at + k:at + k + hi - lo] for k in range(window)], axis=1)


def score_steps(x: np.ndarray, weights: np.ndarray, t0: int, lo: int, hi: int) -> np.ndarray:
    """(samples, heads): every row once by each step's weights, added where it is that step."""
    window = weights.shape[1]
    out = np.zeros((hi - lo, weights.shape[0]))
    for k in range(window):
        at = lo - t0 - window + k
        out += x[at:at + hi - lo] @ weights[:, k].T
    return out


def day_scores(news: DataFrame, heads: Heads) -> DataFrame:
    """(t, score): the news part of each head for every position whose window is full;
    the position after the last row is one too."""
    window, weights = heads.window, heads.news
    parts = halo.blocked(news.select("localDate", "values"), news.select("localDate", "t"), window,
                         ["values"], gaps=True)
    flat = parts.select("block", F.transform("rows", lambda r: r["t"]).alias("at"),
                        F.flatten(F.transform("rows", lambda r: r["values"])).alias("x"))
    size = max(halo.BLOCK, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                block, at = batch.column(0)[k].as_py(), _flat(batch.column(1).slice(k, 1))
                x = _flat(batch.column(2).slice(k, 1)).reshape(len(at), -1)
                if len(at) < window:
                    continue
                found = score_steps(x, weights, 0, window, len(at) + 1)
                whole = at[window - 1:] - at[:len(at) - window + 1] == window - 1
                t = at[window - 1:].astype(np.int64) + 1
                own = whole & (t >= block * size) & (t < (block + 1) * size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(t[own]), pa.array(list(found[own]), pa.list_(pa.float64()))],
                    ["t", "score"])

    return flat.mapInArrow(run, "t long, score array<double>")


def raw_scores(blocks: DataFrame, heads: Heads, past: bool = False) -> DataFrame:
    """(id, t, score, y): the stock part of each head for every sample of the blocks."""
    weights, n_stock = heads.stock, heads.stock.shape[2]
    labels = "y" in blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, t0, lo, hi, x, y in block_arrays(batches, heads.window, n_stock, past):
            found = score_steps(x, weights, t0, lo, hi)
            own = list(y[lo - t0:hi - t0]) if labels else [None] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(row.column(0)[0], hi - lo), pa.array(np.arange(lo, hi)),
                 pa.array(list(found), pa.list_(pa.float64())),
                 pa.array(own, pa.list_(pa.float64()))], ["id", "t", "score", "y"])

    cols = ["id", "block", "t0", "x"] + (["y"] if labels else [])
    return blocks.select(*cols).mapInArrow(
        run, "id string, t long, score array<double>, y array<double>")


def outputs(stock: str, news: str, heads: Heads) -> list:
    """Head columns from the two score arrays: the direction as a probability."""
    cols = []
    for k, h in enumerate(HEADS):
        z = F.col(stock)[k] + F.col(news)[k] + F.lit(float(heads.intercept[k]))
        if k == UP:
            z = (1 / (1 + F.exp(-z)) if heads.link == "logistic"
                 else F.greatest(F.lit(0.0), F.least(F.lit(1.0), z)))
        cols.append(z.alias(h))
    return cols


# --- sums -------------------------------------------------------------------


@dataclass
class Moments:
    """Sums over samples of (1, stock, news): ``total`` (the first is the number of
    samples), ``squares``, ``cross`` with the labels, the least and greatest value of each
    feature, and ``gram``, all products, where it was asked for."""

    total: np.ndarray
    squares: np.ndarray
    cross: np.ndarray
    low: np.ndarray
    high: np.ndarray
    gram: np.ndarray | None = None

    @property
    def n(self) -> float:
        return self.total[0]


def _payload(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int64()),
         pa.array([np.ascontiguousarray(r[2], "<f8").tobytes() for r in rows], pa.binary())],
        ["kind", "at", "data"])


SUMS = "kind string, at long, data binary"


def _add_up(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One record of a kind and place: the sum (or the least) of all."""
    total = None
    for chunk in table["data"].chunks:
        for v in chunk:
            part = np.frombuffer(v.as_buffer(), "<f8")
            if total is None:
                total = part.copy()
            elif key[0].as_py() == "low":
                np.minimum(total, part, out=total)
            else:
                total += part
    return pa.table([pa.array([key[0].as_py()]), pa.array([key[1].as_py()], pa.int64()),
                     pa.array([total.tobytes()], pa.binary())], ["kind", "at", "data"])


def moment_records(s: Samples, heads: Heads | None = None, full: bool = True) -> DataFrame:
    """The sums over the training samples, as records of (kind, place) that ``together``
    puts together; without ``full`` no matrix is made.

    With ``heads`` those of a reweighted step of the direction: samples weigh p (1 - p), and
    the one label is p (1 - p) z + y - p for the present score z."""
    window, n_stock, first = s.window, s.n_stock, s.first_validation
    width = window * n_stock
    bucket = F.pmod(F.xxhash64("id"), F.lit(BUCKETS))
    blocks = s.blocks.select("id", "block", "t0", "x", "y", bucket.alias("bucket"))
    weights = day = bias = None
    if heads is not None:
        size = max(halo.BLOCK, window)
        own = Heads(heads.stock[UP:UP + 1], heads.news[UP:UP + 1], heads.intercept[UP:UP + 1])
        per = day_scores(s.news, own).select("t", F.col("score")[0].alias("z")).groupBy(
            F.floor(F.col("t") / size).cast("long").alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("t", "z"))).alias("_d"))
        blocks = blocks.join(per.select("block", F.col("_d.t").alias("dt"),
                                        F.col("_d.z").alias("dz")), "block")
        weights, bias = own.stock, float(own.intercept[0])
    blocks = blocks.repartition("block", "bucket")
    q = 1 if heads is not None else len(HEADS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ss, sy = np.zeros((width, width)), np.zeros((width, q))
        low = np.full(2 * width, np.inf)
        days: dict[int, np.ndarray] = {}       # by block: (1, stock, labels) of its dates
        size = max(halo.BLOCK, window)
        for row, t0, lo, hi, x, y in block_arrays(batches, window, n_stock, False):
            hi = min(hi, first)
            if lo >= hi:
                continue
            own, label = steps_of(x, t0, lo, hi, window), y[lo - t0:hi - t0]
            w = np.ones(hi - lo)
            if weights is not None:
                get = lambda c: _flat(row.column(row.schema.get_field_index(c)))  # noqa: E731, B023
                z = score_steps(x, weights, t0, lo, hi)[:, 0] + bias
                z += get("dz")[np.searchsorted(get("dt"), np.arange(lo, hi))]
                p = 1 / (1 + np.exp(-z))
                w = p * (1 - p)
                label = (w * z + label[:, UP] - p)[:, None]
            real = ~np.isnan(label).any(axis=1)
            w, label = np.where(real, w, 0.0), np.where(real[:, None], label, 0.0)
            weighted = own * w[:, None]
            ss += weighted.T @ own
            sy += own.T @ label
            if real.any():
                np.minimum(low, np.r_[own[real].min(axis=0), -own[real].max(axis=0)], out=low)
            block = lo // size
            sums = days.setdefault(block, np.zeros((size, 1 + width + q)))
            sums[lo - block * size:hi - block * size] += np.column_stack([w, weighted, label])
        rows = [("ss", 0, ss), ("sy", 0, sy), ("stock low", 0, low)]
        for block, sums in days.items():
            rows += [("day", block * size + k, sums[k]) for k in np.flatnonzero(sums[:, 0])]
        for at in range(0, len(rows), 256):
            yield _payload(rows[at:at + 256])

    parts = blocks.mapInArrow(run, SUMS).groupBy("kind", "at").applyInArrow(_add_up, SUMS)
    parts = cut_lineage(parts)                        # read for the dates and for the matrices
    day = F.col("kind") == "day"
    return parts.where(~day).unionByName(news_sums(s, parts.where(day), q, full))


def news_sums(s: Samples, days: DataFrame, q: int, full: bool) -> DataFrame:
    """Records of the sums that hold the news, from one row a date: news windows by date
    blocks against the dates' sums over their symbols, the matrix in tiles of rows."""
    window, width, n_news = s.window, s.window * s.n_stock, s.window * s.n_news
    rows = s.news.join(days.select(F.col("at").alias("t"), "data"), "t", "left")
    size = max(DATES, window)
    own = lambda t: F.floor(t / F.lit(size)).cast("long")
    rows = rows.withColumn("block", F.explode(F.array_distinct(F.array(
        own(F.col("t")), own(F.col("t") + window))))).select("block", "t", "values", "data")
    side = 1 + width + q

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        block, at = key[0].as_py(), table["t"].to_numpy()
        order = np.argsort(at)
        at = at[order]
        x = np.concatenate([_flat(c) for c in table["values"].chunks]).reshape(len(at), -1)[order]
        data = [table["data"][int(k)].as_py() for k in order]
        use = [k for k in range(len(at)) if data[k] is not None and at[k] // size == block
               and k >= window and at[k] - at[k - window] == window]
        out = []
        if use:
            k = np.array(use)
            n = np.concatenate([x[k - window + j] for j in range(window)], axis=1)
            d = np.array([np.frombuffer(data[j], "<f8") for j in use])
            right = np.concatenate([n * d[:, :1], d], axis=1) if full else d
            for a in range(0, n_news, TILE):
                out.append(("news", a, n[:, a:a + TILE].T @ right))
            out += [("total", 0, d.sum(axis=0)), ("squares", 0, d[:, 0] @ (n * n)),
                    ("low", 0, np.r_[n.min(axis=0), -n.max(axis=0)])]
        return pa.Table.from_batches([_payload(out)] if out else [],
                                     pa.schema([("kind", pa.string()), ("at", pa.int64()),
                                                ("data", pa.binary())]))

    return (rows.groupBy("block").applyInArrow(run, SUMS)
            .groupBy("kind", "at").applyInArrow(_add_up, SUMS))


def together(records: Iterable[tuple[str, int, np.ndarray]], s: Shape, full: bool) -> Moments:
    """The sums from their records; a record is read once and let go."""
    width, n_news, q = s.width, s.n_news, s.labels
    p, side, news = 1 + width + n_news, 1 + width + q, slice(1 + width, None)
    m = Moments(np.zeros(p), np.zeros(p), np.zeros((p, q)), np.zeros(p - 1), np.zeros(p - 1),
                np.zeros((p, p)) if full else None)
    stock = slice(1, 1 + width)
    for kind, at, data in records:
        if kind == "ss":
            m.squares[stock] = data[::width + 1]
            if full:
                m.gram[stock, stock] = data.reshape(width, width)
        elif kind == "sy":
            m.cross[stock] = data.reshape(width, q)
        elif kind == "stock low":
            m.low[:width], m.high[:width] = data[:width], -data[width:]
        elif kind == "total":
            m.total[:1 + width], m.cross[0] = data[:1 + width], data[1 + width:]
            m.squares[0] = data[0]
            if full:
                m.gram[0, :1 + width] = m.gram[:1 + width, 0] = data[:1 + width]
        elif kind == "squares":
            m.squares[news] = data
        elif kind == "low":
            m.low[width:], m.high[width:] = data[:n_news], -data[n_news:]
        else:
            tile = data.reshape(-1, n_news + side if full else side)
            a = slice(1 + width + at, 1 + width + at + len(tile))
            left = tile[:, -side:][:, :1 + width]
            m.total[a], m.cross[a] = left[:, 0], tile[:, -q:]
            if full:
                m.gram[a, news], m.gram[a, :1 + width] = tile[:, :n_news], left
                m.gram[:1 + width, a] = left.T
    return m


@dataclass(frozen=True)
class Shape:
    """Numbers of the stock's features, of the news' and of the labels."""

    width: int
    n_news: int
    labels: int


def shape_of(s: Samples, heads: Heads | None) -> Shape:
    return Shape(s.window * s.n_stock, s.window * s.n_news, len(HEADS) if heads is None else 1)


def moments(s: Samples, heads: Heads | None = None, full: bool = True) -> Moments:
    """The sums over the training samples on the driver, record after record."""
    rows = moment_records(s, heads, full).toLocalIterator()
    return together(((r["kind"], r["at"], np.frombuffer(bytes(r["data"]))) for r in rows),
                    shape_of(s, heads), full)


def solved(s: Samples, heads: Heads | None, solve: Callable[[Moments], list]) -> list[np.ndarray]:
    """``solve`` of the whole sums, run in one task: the matrix, of a size that the
    configuration fixes, is put together and solved there, and the driver gets the arrays
    that ``solve`` returns."""
    shape = shape_of(s, heads)

    def run(table: pa.Table) -> pa.Table:
        views = ((k.as_py(), a.as_py(), np.frombuffer(v.as_buffer(), "<f8"))
                 for batch in table.to_batches()
                 for k, a, v in zip(*(batch.column(c) for c in ("kind", "at", "data"))))
        return pa.Table.from_batches([_payload([("found", k, v) for k, v in
                                                enumerate(solve(together(views, shape, True)))])])

    rows = moment_records(s, heads).groupBy().applyInArrow(run, SUMS).collect()
    return [np.frombuffer(bytes(r["data"])) for r in sorted(rows, key=lambda r: r["at"])]


# --- solutions --------------------------------------------------------------


def _cholesky(a: np.ndarray, b: np.ndarray, size: int = 128) -> np.ndarray:
    """The solution of a x = b for a positive definite ``a``; substitution by blocks, without
    further copies of the matrix."""
    lower = np.linalg.cholesky(a)
    x = b.copy()
    starts = range(0, len(a), size)
    for k in starts:
        e = min(k + size, len(a))
        x[k:e] = np.linalg.solve(lower[k:e, k:e], x[k:e] - lower[k:e, :k] @ x[:k])
    for k in reversed(starts):
        e = min(k + size, len(a))
        x[k:e] = np.linalg.solve(lower[k:e, k:e].T, x[k:e] - lower[e:, k:e].T @ x[e:])
    return x


def feature_scales(m: Moments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(means, standard deviations, which features vary)."""
    mean = m.total[1:] / m.n
    var = m.squares[1:] / m.n - mean * mean
    varies = (m.low < m.high) & (var > 0)
    return mean, np.sqrt(np.where(varies, var, 1.0)), varies


def solve_ridge(m: Moments, reg: float) -> tuple[np.ndarray, np.ndarray]:
    """(weights by head, intercepts) that minimise, for each head, the mean squared error
    plus ``reg`` times the squares of the standardised weights. A constant feature weighs 0."""
    mean, scale, varies = feature_scales(m)
    own = np.flatnonzero(varies)
    a = m.gram[np.ix_(own + 1, own + 1)]
    for k in range(0, len(a), 128):         # row by row block: one copy of the matrix
        rows = a[k:k + 128]
        rows /= m.n
        rows -= mean[own[k:k + 128], None] * mean[own]
        rows /= scale[own[k:k + 128], None] * scale[own]
    a[np.diag_indices_from(a)] = 1.0 + reg
    label = m.cross[0] / m.n
    b = ((m.cross[1:] / m.n - np.outer(mean, label)) / scale[:, None])[varies]
    weights = np.zeros((len(mean), m.cross.shape[1]))
    weights[varies] = _cholesky(a, b) / scale[varies, None]
    return weights.T, label - mean @ weights


def solve_step(m: Moments, scale: np.ndarray, varies: np.ndarray, n: float, reg: float,
               weight: float = 1.0) -> tuple[np.ndarray, float]:
    """The weights and the intercept after one reweighted step; ``weight``: what each sample
    of ``gram`` counts."""
    keep = np.flatnonzero(np.r_[True, varies])
    by = np.r_[1.0, scale][keep]
    a = m.gram[np.ix_(keep, keep)]
    for k in range(0, len(a), 128):
        a[k:k + 128] *= weight / n
        a[k:k + 128] /= by[k:k + 128, None] * by
    a[np.diag_indices_from(a)] += np.r_[0.0, np.full(len(by) - 1, reg)]
    found = np.zeros(len(varies) + 1)
    found[keep] = _cholesky(a, (m.cross[keep, 0] / n / by)[:, None])[:, 0] / by
    return found[1:], float(found[0])


def ridge(s: Samples, reg: float = RIDGE, steps: int = STEPS, tolerance: float = 1e-9) -> Heads:
    """The six heads with a penalty: one pass for the continuous ones, then one more for
    each reweighted step of the direction, until its weights rest."""
    def first(m: Moments) -> list:
        weights, intercept = solve_ridge(m, reg)
        _, scale, varies = feature_scales(m)
        # all scores are 0: the sums of a reweighted step, each sample weighing a quarter
        m.cross = (m.cross[:, UP] - m.total / 2)[:, None]
        up, bias = solve_step(m, scale, varies, m.n, reg, 0.25)
        return [weights, intercept, scale, varies, [m.n], up, [bias]]

    def step(m: Moments) -> list:
        new, bias = solve_step(m, scale, varies, n, reg)
        return [new, [bias]]

    flat, intercept, scale, varies, (n,), up, (bias,) = solved(s, None, first)
    weights, intercept = flat.reshape(len(HEADS), -1).copy(), intercept.copy()
    varies = varies > 0
    moved = max(np.abs(up * scale).max(initial=0), abs(bias))
    for _ in range(steps - 1):
        if moved < tolerance:
            break
        weights[UP], intercept[UP] = up, bias
        new, (new_bias,) = solved(
            s, heads_of(weights, intercept, s.window, s.n_stock, "logistic"), step)
        moved = max(np.abs((new - up) * scale).max(initial=0), abs(new_bias - bias))
        up, bias = new, new_bias
    weights[UP], intercept[UP] = up, bias
    return heads_of(weights, intercept, s.window, s.n_stock, "logistic")


def marginal(s: Samples) -> Heads:
    """Heads that average what each varying feature says on its own: the weight of a
    feature is cov(x, y) / var(x), divided by the number of such features."""
    m = moments(s, full=False)
    mean, scale, varies = feature_scales(m)
    label = m.cross[0] / m.n
    cov = m.cross[1:] / m.n - np.outer(mean, label)
    weights = np.where(varies[:, None], cov / (scale * scale)[:, None], 0.0) / max(1, varies.sum())
    return heads_of(weights.T, label - mean @ weights, s.window, s.n_stock, "linear")


def evaluate(s: Samples, heads: Heads) -> DataFrame:
    """({head}_p, {head}_a) of the validation samples, log returns unscaled."""
    first = s.first_validation
    size = max(halo.BLOCK, s.window)
    own = s.blocks.where((F.col("block") + 1) * size > first)
    rows = (raw_scores(own, heads).where(F.col("t") >= first)
            .join(day_scores(s.news, heads).withColumnRenamed("score", "day"), "t"))
    rows = rows.select("id", "t", "y", *outputs("score", "day", heads))
    scale = lambda c, h: c / C.TARGET_SCALE if h in LOG_HEADS else c
    return rows.where(~F.exists("y", lambda v: v.isNull() | F.isnan(v))).select(
        "id", "t", *[scale(F.col(h), h).alias(f"{h}_p") for h in HEADS],
        *[scale(F.col("y")[k], h).alias(f"{h}_a") for k, h in enumerate(HEADS)])
