"""Gaussian mixtures of many sizes and starts, fitted together: one scan an iteration for all of them.

The vectors are written once as dense blocks. The open models are dealt into shares, and a task reads
all blocks (or, where models are few, a part of them) for one share: it computes responsibilities and adds
up, per model and component, the mass, the first and the second moments. Nothing is shuffled: the sums go
to the driver, which makes the new parameters. Their size follows from the models asked for, never from the
rows, and is bounded (``SUMS_BYTES``): over models that are many, blocks are parted less.
Models that have converged leave, so a sweep over K costs as many scans as its slowest fit has
iterations, not the sum over all fits.

A log density is linear in a row's numbers and their products of two, and the second moments are sums of
the same products. So the densities of all components of all models are one matrix product, and their
moments another (``features``, ``natural``). Where values lie so far apart that this could cost digits
(``REACH``), components are whitened one by one and moments taken around their means.

Fits start from greedy k-means++ seeds and a few rounds of k-means on a bounded sample, with the pooled
covariance of that sample's clusters: a cluster with few rows does not start out flat.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sembra.functions.vectors import as_double, matrix
from sembra.session import materialize, spread

BLOCK_ROWS = 4_096
START_ROWS = 4_096
START_ROUNDS = 5
#: Added to every variance, as the published system does: components of copies stay solvable.
VARIANCE_FLOOR = 1e-6
#: Convergence: the mean log likelihood of a row moves by less than this.
ROW_TOLERANCE = 1e-3
#: Largest mean square distance of a component from the common centre for which rows are expanded into
#: products: rounding then stays below 1e-11 of a variance, and the floor is 1e-6.
REACH = 1e4
#: Numbers of expanded rows that a task holds at once.
EXPANDED = 1 << 21
#: Sums of all tasks of an iteration, in bytes, unless those of one task a model are more.
SUMS_BYTES = 32 << 20


@dataclass
class Fit:
    """One mixture with full covariances, and how its fit went."""

    k: int
    seed: int
    weights: np.ndarray
    means: np.ndarray
    covariances: np.ndarray
    log_likelihood: float = float("-inf")
    iterations: int = 0
    converged: bool = False
    #: Common origin of the rows where these are expanded.
    centre: np.ndarray | None = None

    @property
    def natural(self) -> np.ndarray | None:
        """``natural`` of the parameters around the common origin."""
        return None if self.centre is None else natural(self.means - self.centre, self.covariances)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "covariances": packed(self.covariances)}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state, covariances=unpacked(state["covariances"], state["means"].shape[1]))


class Densities:
    """log(weight * density) of rows under one mixture; matrices are factored once."""

    def __init__(self, weights: np.ndarray, means: np.ndarray, covariances: np.ndarray):
        self.means = means
        roots = _roots(covariances)
        self.whiteners = np.linalg.inv(roots)
        log_det = 2.0 * np.log(np.diagonal(roots, axis1=1, axis2=2)).sum(axis=1)
        with np.errstate(divide="ignore"):
            self.offsets = np.log(weights) - 0.5 * (means.shape[1] * np.log(2 * np.pi) + log_det)

    def log_joint(self, x: np.ndarray) -> np.ndarray:
        out = np.empty((len(x), len(self.means)))
        for c, (mean, whitener) in enumerate(zip(self.means, self.whiteners)):
            white = (x - mean) @ whitener.T
            out[:, c] = self.offsets[c] - 0.5 * np.einsum("ij,ij->i", white, white)
        return out

    def responsibilities(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Posteriors and log density of every row."""
        joint = self.log_joint(x)
        top = joint.max(axis=1, keepdims=True)
        joint -= top
        np.exp(joint, out=joint)
        total = joint.sum(axis=1, keepdims=True)
        joint /= total
        return joint, (top + np.log(total))[:, 0]


def _roots(covariances: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.cholesky(covariances)
    except np.linalg.LinAlgError:
        # Rounding has made one indefinite: raise what lies below the floor.
        values, axes = np.linalg.eigh(covariances)
        values = np.maximum(values, VARIANCE_FLOOR)
        return np.linalg.cholesky((axes * values[:, None, :]) @ axes.transpose(0, 2, 1))


def vector_blocks(df: DataFrame, vector_col: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """(n, x): dense blocks of at most ``rows`` vectors as bytes, written once; nulls are left out."""
    schema = StructType.fromDDL("n int, x binary")

    def run(batches: Iterator[pa.RecordBatch]):
        types, waiting, n = to_arrow_schema(schema), [], 0

        def block():
            x = np.concatenate(waiting)
            return pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int32()), pa.array([x.tobytes()], pa.binary())], schema=types)

        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = matrix(batch.column(0).slice(start, rows))
                waiting.append(part)
                n += len(part)
                if n >= rows:
                    yield block()
                    waiting, n = [], 0
        if waiting:
            yield block()

    vector = as_double(F.col(vector_col))
    return materialize(df.where(F.col(vector_col).isNotNull()).select(vector.alias("v")).mapInArrow(run, schema), "blocks")


def start_sample(df: DataFrame, vector_col: str, rows: int = START_ROWS) -> np.ndarray:
    """At most ``rows`` vectors chosen by a hash of their content: the same ones at every run."""
    vector = as_double(F.col(vector_col)).alias("v")
    known = df.where(F.col(vector_col).isNotNull()).select(vector)
    return matrix(known.orderBy(F.xxhash64("v"), "v").limit(rows).toArrow()["v"])


def first_parameters(sample: np.ndarray, k: int, seed: int) -> Fit:
    """k-means on the sample: its centres and shares, and one pooled covariance."""
    draw = np.random.default_rng([seed, k])
    centres = sample[[draw.integers(len(sample))]]
    squares = (sample**2).sum(1)

    def distances(to: np.ndarray) -> np.ndarray:
        return np.maximum(squares[:, None] - 2 * sample @ to.T + (to**2).sum(1), 0.0)

    least, trials = distances(centres)[:, 0], 2 + int(np.log(k))
    for _ in range(1, k):
        total = least.sum()
        tried = draw.choice(len(sample), trials, p=least / total) if total > 0 else draw.integers(len(sample), size=1)
        # Of some drawn rows the one that brings the others nearest: groups far apart are not missed by chance.
        fallen = np.minimum(least[:, None], distances(sample[tried]))
        best = fallen.sum(0).argmin()
        centres, least = np.vstack([centres, sample[tried[best]]]), fallen[:, best]
    for _ in range(START_ROUNDS):
        nearest = distances(centres).argmin(1)
        for c in range(k):
            if (mine := nearest == c).any():
                centres[c] = sample[mine].mean(0)
    nearest = distances(centres).argmin(1)
    apart = sample - centres[nearest]
    pooled = apart.T @ apart / len(sample) + VARIANCE_FLOOR * np.eye(sample.shape[1])
    weights = (np.bincount(nearest, minlength=k) + 1.0) / (len(sample) + k)
    return Fit(k, seed, weights, centres, np.tile(pooled, (k, 1, 1)))


def packed(matrices: np.ndarray) -> np.ndarray:
    """Upper triangles of symmetric matrices, row by row."""
    i, j = np.triu_indices(matrices.shape[-1])
    return matrices[..., i, j]


def unpacked(triangle: np.ndarray, dim: int) -> np.ndarray:
    """The inverse of :func:`packed`."""
    i, j = np.triu_indices(dim)
    out = np.empty((*triangle.shape[:-1], dim, dim))
    out[..., i, j] = out[..., j, i] = triangle
    return out


def features(x: np.ndarray) -> np.ndarray:
    """1, the numbers of every row, and their products of two in the order of ``packed``."""
    n, dim = x.shape
    # Made column by column: each is then one run of memory.
    out = np.empty((1 + dim + dim * (dim + 1) // 2, n))
    out[0], out[1 : dim + 1] = 1.0, x.T
    at = dim + 1
    for i in range(dim):
        np.multiply(out[i + 1], out[i + 1 : dim + 1], out=out[at : at + dim - i])
        at += dim - i
    return out.T


def natural(means: np.ndarray, covariances: np.ndarray) -> np.ndarray:
    """Factors of ``features`` (of rows around the origin of ``means``) whose sum is the log density."""
    dim = means.shape[1]
    roots = _roots(covariances)
    whiteners = np.linalg.inv(roots)
    precisions = whiteners.transpose(0, 2, 1) @ whiteners
    linear = (precisions @ means[:, :, None])[:, :, 0]
    log_det = 2.0 * np.log(np.diagonal(roots, axis1=1, axis2=2)).sum(axis=1)
    constant = -0.5 * (dim * np.log(2 * np.pi) + log_det + (means * linear).sum(1))
    # A product of two different numbers stands for both of its places.
    return np.hstack([constant[:, None], linear, -packed(precisions) * np.where(packed(np.eye(dim)) > 0, 0.5, 1.0)])


def block_moments(densities: Densities, x: np.ndarray) -> tuple[list[np.ndarray], float]:
    """Per component mass, first and second moment around the mean as one row; and the log likelihood."""
    share, density = densities.responsibilities(x)
    rows = []
    for c, mean in enumerate(densities.means):
        apart = x - mean
        weighted = apart * share[:, c : c + 1]
        rows.append(np.concatenate([[share[:, c].sum()], weighted.sum(0), packed(weighted.T @ apart)]))
    return rows, float(density.sum())


class Expanded:
    """Models as factors of ``features``: the densities of all their components in one product."""

    def __init__(self, models: Sequence[tuple[np.ndarray, np.ndarray]], centre: np.ndarray):
        """``models`` are (weights, natural)."""
        self.centre = centre
        self.ends = np.cumsum([len(weights) for weights, _ in models]).tolist()
        self.factors = np.ascontiguousarray(np.concatenate([factors for _, factors in models]).T)
        with np.errstate(divide="ignore"):
            self.log_weights = np.log(np.concatenate([weights for weights, _ in models]))
        self.totals = np.zeros(len(models))
        self.sums = np.zeros(self.factors.shape[::-1])

    def add(self, x: np.ndarray, moments: bool) -> None:
        """Add the log likelihoods of rows and, with ``moments``, those of all components."""
        step = max(64, EXPANDED // max(self.factors.shape))
        for start in range(0, len(x), step):
            wide = features(x[start : start + step] - self.centre)
            joint = wide @ self.factors
            joint += self.log_weights
            for m, (first, end) in enumerate(zip([0, *self.ends], self.ends)):
                own = joint[:, first:end]
                top = own.max(axis=1, keepdims=True)
                own -= top
                np.exp(own, out=own)
                total = own.sum(axis=1, keepdims=True)
                own /= total
                self.totals[m] += float((top + np.log(total)).sum())
            if moments:
                self.sums += joint.T @ wide


def _shares(sizes: Sequence[int], n: int) -> list[list[int]]:
    """Positions of models with so many components, dealt into at most ``n`` shares of about equal sums."""
    shares: list[list[int]] = [[] for _ in range(min(n, len(sizes)))]
    loads = [0] * len(shares)
    for m in sorted(range(len(sizes)), key=lambda m: -sizes[m]):
        least = loads.index(min(loads))
        shares[least].append(m)
        loads[least] += sizes[m]
    return shares


def _expand(fits: Sequence[Fit]) -> bool:
    """Whether rows can be expanded for these fits; then all of them get their common centre."""
    centre = fits[0].weights @ fits[0].means if fits[0].centre is None else fits[0].centre
    far = max((((fit.means - centre) ** 2).sum(1) + np.trace(fit.covariances, axis1=1, axis2=2)).max() for fit in fits)
    for fit in fits:
        fit.centre = centre if far <= REACH else None
    return fits[0].centre is not None


def one_iteration(blocks: DataFrame, n_blocks: int, fits: Sequence[Fit], last: bool = False) -> None:
    """Update all ``fits`` by one scan; with ``last`` only their log likelihoods."""
    spark = blocks.sparkSession
    dim = fits[0].means.shape[1]
    expand = _expand(fits)
    centre = fits[0].centre
    shared = spark.sparkContext.broadcast(list(fits))
    # Tasks are few: each reads blocks for all models of its share and sends sums of them.
    cores = spark.sparkContext.defaultParallelism
    shares = _shares([f.k for f in fits], cores)
    width = 1 + dim + dim * (dim + 1) // 2
    fitting = SUMS_BYTES // (8 * width * sum(f.k for f in fits))
    parts = max(1, min(n_blocks, -(-2 * cores // len(shares)), fitting))
    # Every share meets every part of the blocks where it lies: read from the files, not dealt out anew.
    numbers = spark.range(0, len(shares), 1, len(shares)).select(F.col("id").cast("int").alias("share"))
    dealt = blocks.coalesce(parts).hint("shuffle_replicate_nl").crossJoin(numbers)
    sums_schema = StructType.fromDDL("model int, rows long, total double, sums binary")

    def expanded(batches: Iterator[pa.RecordBatch]):
        models, share, rows = None, [], 0
        for batch in batches:
            for data, number in zip(batch.column(1), batch.column(2).to_pylist()):
                x = np.frombuffer(data.as_buffer()).reshape(-1, dim)
                if models is None:
                    share = shares[number]
                    models = Expanded([(shared.value[m].weights, shared.value[m].natural) for m in share], centre)
                models.add(x, not last)
                rows += len(x)
        if models is not None:
            for m, total, first, end in zip(share, models.totals, [0, *models.ends], models.ends):
                yield m, rows, float(total), models.sums[first:end]

    def whitened(batches: Iterator[pa.RecordBatch]):
        prepared: dict[int, Densities] = {}
        found: dict[int, list] = {}
        for batch in batches:
            for data, number in zip(batch.column(1), batch.column(2).to_pylist()):
                x = np.frombuffer(data.as_buffer()).reshape(-1, dim)
                for m in shares[number]:
                    if m not in prepared:
                        prepared[m] = Densities(shared.value[m].weights, shared.value[m].means, shared.value[m].covariances)
                    if last:
                        sums, total = np.zeros(0), float(prepared[m].responsibilities(x)[1].sum())
                    else:
                        rows, total = block_moments(prepared[m], x)
                        sums = np.array(rows)
                    before = found.get(m, (0, 0.0, 0.0))
                    found[m] = [before[0] + len(x), before[1] + total, before[2] + sums]
        yield from ((m, *sums) for m, sums in found.items())

    def scan(batches: Iterator[pa.RecordBatch]):
        for m, rows, total, sums in (expanded if expand else whitened)(batches):
            data = None if last else np.ascontiguousarray(sums).tobytes()
            columns = zip([m, rows, total, data], to_arrow_schema(sums_schema))
            yield pa.RecordBatch.from_arrays([pa.array([c], t.type) for c, t in columns], schema=to_arrow_schema(sums_schema))

    found = dealt.mapInArrow(scan, sums_schema).toArrow()
    shared.destroy()
    by_model: dict[int, list] = {}
    for m, rows, total, data in zip(*(found.column(name) for name in ("model", "rows", "total", "sums"))):
        sums = 0.0 if last else np.frombuffer(data.as_buffer()).reshape(-1, width)
        before = by_model.get(m.as_py(), (0, 0.0, 0.0))
        by_model[m.as_py()] = [before[0] + rows.as_py(), before[1] + total.as_py(), before[2] + sums]
    for m, (rows, total, sums) in by_model.items():
        fit = fits[m]
        fit.converged = abs(total - fit.log_likelihood) < ROW_TOLERANCE * rows
        fit.log_likelihood = total
        if not last:
            _update(fit, sums)


def _update(fit: Fit, sums: np.ndarray) -> None:
    """The parameters that the sums of all rows give; a component without rows keeps its place without weight."""
    dim = fit.means.shape[1]
    own = sums[:, 0] > 1e-10
    mass = sums[own, :1]
    shifts = sums[own, 1 : dim + 1] / mass
    covariances = unpacked(sums[own, dim + 1 :] / mass, dim) - shifts[:, :, None] * shifts[:, None, :]
    fit.covariances[own] = covariances + VARIANCE_FLOOR * np.eye(dim)
    fit.means[own] = (fit.means[own] if fit.centre is None else fit.centre) + shifts
    fit.weights = sums[:, 0] / sums[:, 0].sum()
    fit.iterations += 1


def fit_mixtures(
    df: DataFrame, specs: Sequence[tuple[int, int]], max_iter: int, vector_col: str = "reduced", start_rows: int = START_ROWS
) -> list[Fit]:
    """Fits of all (components, seed) in ``specs``, in their order; log likelihoods of the final parameters."""
    blocks = vector_blocks(spread(df), vector_col)
    n_blocks = blocks.count()
    if not n_blocks:
        raise ValueError("no vectors to fit a mixture to")
    sample = start_sample(df, vector_col, start_rows)
    fits = [first_parameters(sample, k, seed) for k, seed in specs]
    open_ = fits
    for _ in range(max_iter):
        one_iteration(blocks, n_blocks, open_)
        open_ = [f for f in open_ if not f.converged]
        if not open_:
            break
    finished = [f.converged for f in fits]
    one_iteration(blocks, n_blocks, fits, last=True)
    for fit, done in zip(fits, finished):
        fit.converged = done
    return fits


def best_fits(fits: Sequence[Fit]) -> dict[int, Fit]:
    """The fit of highest likelihood of each K; the earlier seed on ties."""
    best: dict[int, Fit] = {}
    for fit in sorted(fits, key=lambda f: f.seed):
        if fit.k not in best or fit.log_likelihood > best[fit.k].log_likelihood:
            best[fit.k] = fit
    return best
