"""Soft-membership mixing: document rates for target token shares of domains.

A classifier fitted on labelled documents (a softmax over hashed features, at
most ``max_rows`` rows) gives each document a posterior over the domains. With
n_i tokens and posterior p_i, a document at rate r_i adds r_i n_i p_i expected
tokens to the domains. The rates minimise

    sum over domains of (sum_i r_i n_i p_i - target)^2 / available

over r >= 0 by scaled projected gradient from rates near 1. Distances between
rates weigh a document by its tokens; then the slope of document i is p_i . g, with
one number g a domain, and the plain step r = max(0, r - p_i . g) never overshoots.
It is slow where posteriors are alike, so that the slope is scaled (Bertsekas'
projection): documents at a bound that the slope pushes against are held, the
others move along p_i . c, where c solves the small system of their curvature, and
are cut off at the bounds. A pass over the posterior table gives the expected
tokens for c at some lengths and for the plain step, and the best is taken; another
gives the curvature there. Only rows of such sums reach the driver. No rate is
stored between steps: g and c of each step go to all tasks, which replay them on
their rows, so a lost task costs its own rows only. The fit ends when each
domain's residual is at most ``CLOSE`` of its target (for a target of 0, of all
target tokens), when a plain step would move at most ``STILL`` of it, where no
rates fit better, or after ``STEPS`` steps. What is left of the residuals is logged
and kept in ``Fit``.

``SAMPLE`` posteriors on the driver give the first rates, by their dual; they
save passes and do not decide where the fit ends.

Targets should be within reach: a domain that is asked to vanish takes each
document along that has a trace of it, so ``SHARES`` leaves ``bad`` and ``toxic``
what the classifier's errors put there.

The pipeline's stage (``mixed``) must not lose clean documents, so its rates have
a least value: 1 for a document whose posterior is mainly of the anchor (or of the
domains ``whole`` together), 0 for others; ``most`` bounds them above (1: no
document comes twice). It emits as many copies as a rate says, so that the expected tokens of the output are those of the
fit.

Domains of the labels table: ``bad`` (quality 0), ``toxic``, ``clean``.
``ANCHOR`` is the domain whose available tokens stay whole; the others' targets
follow from the shares. A domain without tokens has no target.

Null text: empty, 0 tokens, a rate like any other. Null ids and repeated rows
are documents of their own. Without labels every posterior is uniform. An empty
table gives no rows.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import SLICE_BYTES, SMALL_SLICE, materialize, prepare, row_slices, text_column, texts_of, tidy
from tillroll.llm.features import Adam, Design, Scorer, labelled_features
from tillroll.llm.pieces import encoder
from tillroll.llm.quality import MAX_ROWS, MIN_ROWS, RIDGE, ROUNDS, rating

DOMAINS = ("bad", "toxic", "clean")          # in the order of the ratings
SHARES = {"bad": 0.05, "toxic": 0.05, "clean": 0.90}
ANCHOR = "clean"
TOKENIZER = "byte_bpe_50k.json"   # of the tokens that weigh documents in the pipeline
CLOSE = 1e-4    # residual of a domain, as a part of its target, at which the fit ends
STILL = 1e-9    # the same for what a step moves
STEPS = 60      # of two passes over the posteriors each; about 3 are used
PULLS = tuple(10.0 ** -k for k in range(2, 12))   # of the sample's rates towards 1
NEWTON = 50                                       # steps for a pull there
RIDGES = 10.0 ** np.array([-9, -7, -6, -5, -4, -3, -2, -1])   # of the system of a scaled step: the larger, the shorter
LENGTHS = np.array([1.0, 4.0, 16.0, 64.0])                    # of a plain step
PARTS = 16      # values of a column with a domain of their own
SAMPLE = 4096   # posteriors on the driver, for the first rates

log = logging.getLogger(__name__)


@dataclass
class DomainModel:
    weights: np.ndarray   # place, domain
    bias: np.ndarray
    limit: int = SLICE_BYTES   # text that is scored at once

    def __post_init__(self):
        self.scorer = Scorer(self.weights, self.limit)

    def posteriors(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Posteriors in rows, and numbers of words."""
        sums, words = self.scorer(texts)
        z = self.bias + sums
        e = np.exp(z - z.max(axis=1, keepdims=True, initial=-np.inf))
        return e / e.sum(axis=1, keepdims=True), words


def fit_domains(rows: list[np.ndarray], domains: np.ndarray, n: int = len(DOMAINS), min_rows: int = MIN_ROWS) -> DomainModel:
    design = Design(rows, domains, n, min_rows)
    w, bias, adam = np.zeros((len(design.places), n)), np.zeros(n), Adam()
    for _ in range(ROUNDS if len(rows) else 0):
        z = np.column_stack([design.times(w[:, k]) for k in range(n)]) + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(rows)), domains] -= 1
        p /= len(rows)
        w = adam("w", w, np.column_stack([design.back(p[:, k]) for k in range(n)]) + RIDGE * w, 0.1)
        bias = adam("b", bias, p.sum(axis=0), 0.1)
        adam.step += 1
    return DomainModel(np.column_stack([design.spread(w[:, k]) for k in range(n)]), bias)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, min_rows: int = MIN_ROWS, domain: Column | None = None,
        n: int = len(DOMAINS)) -> DomainModel:
    """``domain``: number of the domain under ``n``, a column over ``labels``; None: its rating."""
    grade = rating() if domain is None else domain
    return fit_domains(*labelled_features(docs, labels, grade, max_rows), n, min_rows=min_rows)


def clean_parts(docs: DataFrame, part: str, tail: float, most: int = PARTS) -> tuple[dict[str, float], Column, str]:
    """Domains for a mix over the values of a column: ``bad``, ``toxic``, and
    ``clean`` cut into the ``most`` largest values by text and the rest with the
    nulls. Returns target shares (0 for bad and toxic, text ** ``tail`` for a
    part, so that small parts gain where it is under 1), the domain's number
    over labels that have the column, and the largest part."""
    sizes = docs.groupBy(F.col(part).cast("string").alias("part")).agg(F.sum(F.length(text_column())).alias("size"))
    top = sizes.filter("part IS NOT NULL AND size > 0").orderBy(F.desc("size"), "part").limit(most).collect()
    rest = (sizes.agg(F.sum("size")).first()[0] or 0) - sum(r["size"] for r in top)
    parts = {f"clean {r['part']}": float(r["size"]) ** tail for r in top}
    if rest or not parts:
        parts[ANCHOR] = float(rest) ** tail or 1.0
    shares = {"bad": 0.0, "toxic": 0.0, **parts}
    number = F.lit(len(shares) - 1 if ANCHOR in parts else None).cast("int")
    for k, r in enumerate(top):
        number = F.when(F.col(part).cast("string") == r["part"], k + 2).otherwise(number)
    return shares, F.when(rating() == 2, number).otherwise(rating()), max(parts, key=parts.get)


def posterior(docs: DataFrame, model: DomainModel, tokenizer: str = TOKENIZER) -> Column:
    """Posterior and number of tokens of each text, as a column over ``docs``."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("p array<double>, n_tokens long")
    def run(texts: pa.Array) -> pa.Array:
        p, _ = shared.value.posteriors(texts)
        return pa.StructArray.from_arrays([_posterior_list(p), pa.array(encoder(tokenizer).count(texts), pa.int64())], names=["p", "n_tokens"])

    return run(text_column())


@dataclass(frozen=True)
class Rates:
    """Rates as a function of a document's posterior: the first ones and the
    steps from there."""
    start: np.ndarray                                      # first rates: 1 - p . start, within bounds
    whole: int | tuple[int, ...] | None = None             # domains whose documents keep a rate of 1 or more
    most: float = np.inf
    steps: tuple[tuple[np.ndarray, np.ndarray], ...] = ()  # slope and move of each domain

    def step(self, slope: np.ndarray, move: np.ndarray) -> Rates:
        return replace(self, steps=(*self.steps, (slope, move)))

    def least(self, p: np.ndarray) -> np.ndarray:
        return np.zeros(len(p)) if self.whole is None else (p[:, np.atleast_1d(self.whole)].sum(axis=1) > 0.5).astype(float)

    def held(self, r: np.ndarray, p: np.ndarray, slope: np.ndarray) -> np.ndarray:
        """Documents at a bound that the slope pushes against."""
        push = p @ slope
        return (r <= self.least(p)) & (push > 0) | (r >= self.most) & (push < 0)

    def moved(self, r: np.ndarray, p: np.ndarray, slope: np.ndarray, move: np.ndarray) -> np.ndarray:
        return np.where(self.held(r, p, slope), r, np.clip(r - p @ move, self.least(p), self.most))

    def __call__(self, p: np.ndarray) -> np.ndarray:
        """``p`` has a row for each document."""
        r = np.clip(1 - p @ self.start, self.least(p), self.most)
        for slope, move in self.steps:
            r = self.moved(r, p, slope, move)
        return r


@dataclass
class Fit:
    """Rates, and the expected tokens that they reach."""
    rates: Rates
    tokens: np.ndarray
    target: np.ndarray
    used: np.ndarray   # domains that have tokens
    still: bool        # no rates fit better

    @property
    def residual(self) -> np.ndarray:
        """Of each domain, as a part of its target; of all target tokens where that is 0."""
        return np.where(self.used, self.tokens - self.target, 0.0) / _unit(self.target)

    @property
    def close(self) -> bool:
        return bool((np.abs(self.residual) <= CLOSE).all())


def _unit(target: np.ndarray) -> np.ndarray:
    return np.where(target > 0, target, max(target.sum(), np.finfo(float).tiny))


def _matrix(batch: pa.RecordBatch, column: str | int = "p") -> np.ndarray:
    p = batch.column(column)
    return p.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) if batch.num_rows else np.zeros((0, len(DOMAINS)))


Sums = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray], int], np.ndarray]


def tokens_of(rates: Rates, slope: np.ndarray, moves: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Expected tokens of each domain after each of some moves."""
    def of(p: np.ndarray, n_tokens: np.ndarray) -> np.ndarray:
        r = rates(p)
        return np.concatenate([(rates.moved(r, p, slope, m) * n_tokens) @ p for m in moves])
    return of


def curvature_of(rates: Rates, slope: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """What a plain step moves of each domain's tokens, and the curvature of
    the documents that are not held."""
    def of(p: np.ndarray, n_tokens: np.ndarray) -> np.ndarray:
        r = rates(p)
        moved = np.abs(rates.moved(r, p, slope, slope) - r)
        free = np.where(rates.held(r, p, slope), 0.0, n_tokens)
        return np.concatenate([(moved * n_tokens) @ p, ((p * free[:, None]).T @ p).ravel()])
    return of


def table_sums(posts: DataFrame) -> Sums:
    """Sums of a function of (posteriors, tokens) over a table."""
    def over(of: Callable[[np.ndarray, np.ndarray], np.ndarray], width: int) -> np.ndarray:
        names = [f"d{k}" for k in range(width)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(width)
            for batch in batches:
                if batch.num_rows:
                    total += of(_matrix(batch), batch.column("n_tokens").to_numpy().astype(float))
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in total.tolist()], names=names)

        parts = posts.select("p", "n_tokens").mapInArrow(run, ", ".join(f"{d} double" for d in names))
        row = parts.agg(*(F.sum(d).alias(d) for d in names)).first()
        return np.array([row[d] or 0.0 for d in names])

    return over


def descend(over: Sums, available: np.ndarray, target: np.ndarray, rates: Rates) -> Fit:
    """Scaled projected gradient from the first rates."""
    n, used, unit = len(target), available > 0, _unit(target)
    per_token = np.divide(1.0, available, out=np.zeros(n), where=used)
    tokens = over(tokens_of(rates, np.zeros(n), np.zeros((1, n))), n)
    fit = Fit(rates, tokens, target, used, False)
    while not fit.close and not fit.still and len(fit.rates.steps) < STEPS:
        slope = (fit.tokens - target) * per_token
        row = over(curvature_of(fit.rates, slope), n + n * n)
        if (row[:n] <= STILL * unit).all():
            fit.still = True
            break
        system = per_token[:, None] * row[n:].reshape(n, n)
        moves = np.vstack([*(np.linalg.solve(system + ridge * np.eye(n), slope) for ridge in RIDGES), LENGTHS[:, None] * slope])
        reached = over(tokens_of(fit.rates, slope, moves), n * len(moves)).reshape(-1, n)
        best = int(np.argmin((reached - target) ** 2 @ per_token))
        fit = Fit(fit.rates.step(slope, moves[best]), reached[best], target, used, False)
    return fit


def _targets(available: np.ndarray, shares: dict[str, float], anchor: str) -> np.ndarray:
    return np.array(list(shares.values())) / shares[anchor] * available[list(shares).index(anchor)]


def first_rates(p: np.ndarray, n_tokens: np.ndarray, shares: dict[str, float], anchor: str, rates: Rates) -> Rates:
    """Rates that fit a sample on the driver: those nearest to 1 are
    1 - p . dual within bounds. The dual is the minimum of a smooth convex
    function, found by Newton steps for a falling pull towards 1."""
    available = n_tokens @ p
    target, used = _targets(available, shares, anchor), available > 0
    n, dual = len(target), np.zeros(len(target))

    def moments(dual: np.ndarray, pull: float) -> tuple[float, np.ndarray, np.ndarray]:
        r, free = replace(rates, start=dual)(p), 1 - p @ dual
        value = n_tokens @ (r * free - r**2 / 2) + dual @ target + pull / 2 * (available @ dual**2)
        slope = np.where(used, target - (r * n_tokens) @ p + pull * available * dual, 0.0)
        return value, slope, (p * (n_tokens * (r == free))[:, None]).T @ p + pull * np.diag(available)

    for pull in PULLS:
        value, slope, curve = moments(dual, pull)
        for _ in range(NEWTON):
            move = np.zeros(n)
            move[used] = np.linalg.lstsq(curve[np.ix_(used, used)], -slope[used], rcond=None)[0]
            trials = [dual + move / 4.0**k for k in range(4)]
            found = [moments(d, pull) for d in trials]
            best = int(np.argmin([f[0] for f in found]))
            if found[best][0] >= value:
                break   # no further in floating point
            dual, (value, slope, curve) = trials[best], found[best]
        first = replace(rates, start=dual)
        if Fit(first, (first(p) * n_tokens) @ p, target, used, False).close:
            break
    return first


def fit_rates(posts: DataFrame, shares: dict[str, float] = SHARES, anchor: str = ANCHOR,
              whole: int | tuple[int, ...] | None = None, most: float = np.inf) -> Fit:
    """``posts`` is a written table: doc_id, p, n_tokens."""
    n = len(shares)
    over, rates = table_sums(posts), Rates(np.zeros(n), whole, most)
    available = over(lambda p, n_tokens: n_tokens @ p, n)
    target = _targets(available, shares, anchor)
    rows = posts.select("p", "n_tokens").orderBy(F.xxhash64("doc_id", "p"), "p", "n_tokens").limit(SAMPLE).collect()
    p, n_tokens = np.array([r["p"] for r in rows]).reshape(-1, n), np.array([r["n_tokens"] for r in rows], float)
    fit = descend(over, available, target, first_rates(p, n_tokens, shares, anchor, rates))
    log.info("mixing: %d steps, remaining residuals %s", len(fit.rates.steps), dict(zip(shares, fit.residual.tolist())))
    return fit


def copies(rate: np.ndarray, coins: np.ndarray) -> np.ndarray:
    """A whole number of copies that is ``rate`` on average: rounded up where
    the row's coin, a number under 1, is below the fraction."""
    return np.floor(rate + coins).astype(np.int32)


def _coins(rows: pa.RecordBatch) -> np.ndarray:
    return rows.column("coin").to_numpy()


def _posterior_list(p: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))


def coin() -> Column:
    """A number under 1 for each stored row, so that repeated rows have coins of their own."""
    return (F.pmod(F.xxhash64("row", F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)).alias("coin")


def mix_documents(docs: DataFrame, model: DomainModel, shares: dict[str, float] = SHARES, anchor: str = ANCHOR,
                  tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens, p_<domain> ..., rate, copies of every document."""
    posts = materialize(docs.select("doc_id", posterior(docs, model, tokenizer).alias("x")).select(
        "doc_id", "x.p", "x.n_tokens", F.monotonically_increasing_id().alias("row")), "posteriors")
    rates = fit_rates(posts, shares, anchor).rates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = rates(_matrix(batch))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(r), pa.array(copies(r, _coins(batch)))],
                                             names=[*batch.schema.names[:3], "rate", "copies"])

    rated = posts.select("doc_id", "p", "n_tokens", coin()).mapInArrow(
        run, "doc_id long, p array<double>, n_tokens long, rate double, copies int")
    return rated.select("doc_id", "n_tokens", *(F.col("p")[k].alias(f"p_{d}") for k, d in enumerate(shares)), "rate", "copies")


def mixed(docs: DataFrame, model: DomainModel, shares: dict[str, float] = SHARES, anchor: str = ANCHOR,
          tokenizer: str = TOKENIZER, most: float = np.inf, whole: tuple[str, ...] = ()) -> DataFrame:
    """The documents, each as often as it has copies, with all their columns.
    Mainly those of the domains ``whole`` (none: the anchor) stay at a rate of 1 or more.
    Every text is classified and counted once: its row is stored with what was
    found, the fit reads the found columns alone, and a last pass emits copies."""
    prepare(docs.sparkSession)
    small = DomainModel(model.weights, model.bias, SMALL_SLICE)
    shared = docs.sparkSession.sparkContext.broadcast(small)
    floor = tuple(list(shares).index(d) for d in whole or (anchor,))
    columns = docs.columns
    width = len(columns)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch):
                texts = texts_of(part)
                p, _ = shared.value.posteriors(texts)
                yield pa.RecordBatch.from_arrays([*part.columns, _posterior_list(p), pa.array(encoder(tokenizer).count(texts), pa.int64())],
                                                 names=[f"c{k}" for k in range(width + 2)])

    # Numbered names, so that no column's name matters.
    numbered = docs.toDF(*(f"c{k}" for k in range(width)))
    schema = T.StructType([*numbered.schema.fields, T.StructField(f"c{width}", T.ArrayType(T.DoubleType())), T.StructField(f"c{width + 1}", T.LongType())])
    rows = materialize(docs.mapInArrow(tidy(weigh), schema).withColumn("row", F.monotonically_increasing_id()), "weighed")
    posts = rows.select(F.col(f"c{columns.index('doc_id')}").alias("doc_id"), F.col(f"c{width}").alias("p"), F.col(f"c{width + 1}").alias("n_tokens"))
    rates = fit_rates(posts, shares, anchor, floor, most).rates

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            times = copies(rates(_matrix(batch, width)), _coins(batch))
            own = batch.select(range(width))
            for k in range(int(times.max(initial=0))):   # first copies, second ones, ...
                yield own.filter(pa.array(times > k))

    return rows.select(*(f"c{k}" for k in range(width + 1)), coin()).mapInArrow(tidy(emit), numbered.schema).toDF(*columns)
