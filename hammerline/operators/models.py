"""Per-state regressions, all states at once.

Rows are reduced to moment matrices inside the tasks that read them; only those p x p sums are
shuffled, and the per-state solve sees a group of a few thousand matrix cells. No group of rows is
ever gathered, so a state holding a third of the listings is an ordinary case. The sums are whole numbers
(``functions.exact``), so that moments and least squares are the same bit for bit however rows are ordered or partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.functions import solvers
from hammerline.functions.columns import all_present, ratio, same_key
from hammerline.functions.exact import Gram, joined, scale_of
from hammerline.functions.ranking import medians, quantiles
from hammerline.functions.scoring import (
    CONDITIONS, LEVELS, OCCUPANCY, PRICE_TERMS, SALE_TERMS, TIMES, TRUSTEE_PRICE_TERMS, TRUSTEE_TERMS,
    VALUATION_TERMS, term_value,
)
from hammerline.params import LISTING_KEY
from hammerline.session import settle, settle_all

STATE = "PropertyState"

# Regressors of each fit.
VALUATION_FIT = (*VALUATION_TERMS, f"Bedrooms{TIMES}Baths")
SALE_FIT = (*SALE_TERMS, "Turnover")
PRICE_FIT = (*PRICE_TERMS, "Turnover", "HasWellMatchedBidders", "HasLikelyBidders")
PRICE_ONLY = ("HasWellMatchedBidders", "HasLikelyBidders", "IntrinsicBidderQuality", "TotalRegistrantScore")
PRE_RESERVE_FIT = (
    "SFR_Flag", "MultiResidence_Flag", "C2C_Flag", "REO_Flag", "ShortSale_Flag", *CONDITIONS, *OCCUPANCY,
    "FinancingAvailable", "TotalActive", "Vacancy", "Appreciation", "Turnover", "MedianPPSQFT", "ForeclosedPer10000",
    "PrevForeclosureSoldRate", "IsSubjectToApproval", "FullWarrantyDeed", "SpecialWarrantyDeed", "QuitClaimDeed",
    "PercentHomesSold", "Historical_Execution", "SellerPortfolioQuality",
)
TRUSTEE_FIT = (*TRUSTEE_TERMS, "Turnover", "Trustee_Flag")
TRUSTEE_PRICE_FIT = (*TRUSTEE_PRICE_TERMS, "Turnover")

# Columns a row must have to be trained on or scored.
_FLAGS = (
    "C2C_Flag", "REO_Flag", "ShortSale_Flag", "Trustee_Flag", *CONDITIONS, *OCCUPANCY,
)
PRE_RESERVE_REQUIRED = (
    *_FLAGS, "FinancingAvailable", "Favorites", "TotalActive", "Vacancy", "Appreciation", "Turnover", "MedianPPSQFT",
)
REQUIRED = (
    *PRE_RESERVE_REQUIRED, "Reserve", "BPOSurplus", *LEVELS, "RunNum", "HasPrevAttempts", "BPOSurplusPct",
    "TotalRegistrantScore", "IntrinsicBidderQuality", "MedianPPSQFTDeviation",
)
TRUSTEE_REQUIRED = (
    *_FLAGS, "Reserve", *LEVELS, "RunNum", "TotalActive", "Vacancy", "HasPrevAttempts", "BPOSurplusPct",
    "Appreciation", "Turnover", "MedianPPSQFT", "MedianPPSQFTDeviation",
)


# ---- moments --------------------------------------------------------------------------------

def listing_fold(folds: int = 10) -> Column:
    """A repeatable fold from the listing key."""
    return F.pmod(F.xxhash64(*LISTING_KEY), F.lit(folds)).cast("int")


def design(df: DataFrame, terms: Sequence[str], targets: Sequence[str], folds: int = 10) -> tuple[DataFrame, DataFrame]:
    """Standardised complete cases and their per-state (mean, deviation) as matrix cells.

    The selected columns are written once; a pass over them reads that copy and scales it on the fly.
    Centring before multiplying keeps the products well conditioned next to reserves in the millions.
    """
    picked = [term_value(t).cast("double").alias(t) for t in terms]
    rows = df.filter(F.col(STATE).isNotNull()).select(
        STATE, listing_fold(folds).alias("_fold"), *[F.col(t).cast("double").alias(f"y_{t}") for t in targets], *picked)
    rows = settle(rows.filter(all_present([*terms, *[f"y_{t}" for t in targets]])))
    stats = settle(_means_and_deviations(rows, terms))
    met = rows.join(stats, STATE)
    scaled = [
        F.coalesce(ratio(F.col(t) - F.col(f"s_{t}.mean"), F.when(F.col(f"s_{t}.sd") > 1e-12, F.col(f"s_{t}.sd"))),
                   F.lit(0.0)).alias(t)
        for t in terms
    ]
    standard = met.select(STATE, "_fold", *[f"y_{t}" for t in targets], *scaled)
    cells = F.explode(F.array(*[
        F.struct(F.lit(kind).alias("i"), F.lit(j).alias("j"), F.col(f"s_{t}.{part}").alias("v"))
        for j, t in enumerate(terms) for kind, part in ((-1, "mean"), (-2, "sd"))
    ])).alias("c")
    return standard, stats.select(STATE, cells).select(STATE, F.lit(-1).alias("_fold"), "c.i", "c.j", "c.v")


PARTS = "high bigint, middle bigint, low bigint"


def _scales(rows: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """A power of two for each column that brings its largest value near the top of the exact grid; one row comes to the driver."""
    most = rows.agg(*[F.max(F.abs(F.col(c))) for c in columns]).first()
    return np.array([scale_of(m or 0.0) for m in most])


def _means_and_deviations(rows: DataFrame, terms: Sequence[str]) -> DataFrame:
    """(state, s_<term> struct(mean, sd)) of every term; the sums behind them are exact."""
    scale, p = _scales(rows, terms), len(terms)

    def reduce_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, Gram] = {}
        for pdf in batches:
            for state, part in pdf.groupby(STATE, sort=False):
                x = part[list(terms)].to_numpy(float) * scale
                one = np.ones((len(x), 1))
                sums.setdefault(state, Gram()).add(one, np.column_stack([one, x, x * x * 2.0**-20]))
        power = np.concatenate([[1.0], 1 / scale, 2.0**20 / scale**2])
        for state, s in sums.items():
            high, middle, low = (part[0] for part in s.parts())
            yield pd.DataFrame({STATE: state, "i": 0, "j": np.arange(2 * p + 1), "high": high, "middle": middle, "low": low, "power": power})

    cells = _summed(rows.select(STATE, *terms).mapInPandas(reduce_batches, f"{STATE} string, i int, j int, {PARTS}, power double"), STATE)
    held = settle(cells.groupBy(STATE).agg(F.transform(F.sort_array(F.collect_list(F.struct("j", "v"))), lambda c: c["v"]).alias("v")))
    out = []
    for k, t in enumerate(terms):
        n, total, square = F.col("v")[0], F.col("v")[k + 1], F.col("v")[p + k + 1]
        spread = square / n - (total / n) * (total / n)
        # a column whose values differ by less than its own rounding has no deviation
        sd = F.when(spread > (total / n) * (total / n) * 1e-14, F.sqrt(F.greatest(spread, F.lit(0.0)))).otherwise(0.0)
        out.append(F.struct((total / n).alias("mean"), sd.alias("sd")).alias(f"s_{t}"))
    return held.select(STATE, *out)


def _summed(cells: DataFrame, *key: str) -> DataFrame:
    """Cells (key, i, j, parts, power) of all tasks added up; ``power`` undoes the scale of the columns."""
    total = joined(*[F.sum(c) for c in ("high", "middle", "low")]) * F.max("power")
    return cells.groupBy(*key, "i", "j").agg(total.alias("v"))


def moments(standard: DataFrame, terms: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """Sums of products over (1, terms, targets) as (state, fold, i, j, v) cells, upper triangle."""
    columns = [*terms, *[f"y_{t}" for t in targets]]
    scale = np.concatenate([[1.0], _scales(standard, columns)])

    def reduce_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple, Gram] = {}
        for pdf in batches:
            for key, part in pdf.groupby([STATE, "_fold"], sort=False):
                sums.setdefault(key, Gram()).add(np.column_stack([np.ones(len(part)), part[columns].to_numpy(float)]) * scale)
        for (state, fold), s in sums.items():
            i, j = np.triu_indices(len(scale))
            high, middle, low = (p[i, j] for p in s.parts())
            yield pd.DataFrame({STATE: state, "_fold": fold, "i": i, "j": j, "high": high, "middle": middle, "low": low, "power": 1 / (scale[i] * scale[j])})

    schema = f"{STATE} string, _fold int, i int, j int, {PARTS}, power double"
    return _summed(standard.select(STATE, "_fold", *columns).mapInPandas(reduce_batches, schema), STATE, "_fold")


def _by_state(cells: DataFrame, solve, schema: str, *key: str) -> DataFrame:
    """One solver call per state, spread over all cores (a small shuffle would be merged into one task)."""
    spread = cells.repartition(cells.sparkSession.sparkContext.defaultParallelism, STATE, *key)
    return spread.groupBy(STATE, *key).applyInPandas(solve, schema)


def _matrix(cells: pd.DataFrame, size: int) -> np.ndarray:
    m = np.zeros((size, size))
    i, j, v = cells["i"].to_numpy(), cells["j"].to_numpy(), cells["v"].to_numpy()
    m[i, j] = v
    m[j, i] = v
    return m


def _unpack(pdf: pd.DataFrame, p: int, targets: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fold moment matrices, feature means, feature deviations) of one state's cells."""
    stats, cells = pdf[pdf["i"] < 0], pdf[pdf["i"] >= 0]
    mean, sd = np.zeros(p), np.zeros(p)
    for kind, out in ((-1, mean), (-2, sd)):
        part = stats[stats["i"] == kind]
        out[part["j"].to_numpy()] = part["v"].to_numpy()
    folds = np.array([_matrix(c, p + 1 + targets) for _, c in cells.groupby("_fold")])
    return folds, mean, sd


def _raw_scale(beta: np.ndarray, mean: np.ndarray, sd: np.ndarray) -> np.ndarray:
    """Coefficients on standardised terms back to the original units."""
    slope = np.divide(beta[1:], sd, out=np.zeros(len(sd)), where=sd > 1e-12)
    return np.concatenate([[beta[0] - slope @ mean], slope])


_COEF_SCHEMA = f"{STATE} string, model string, term string, value double"


def _solve_states(cells: DataFrame, terms: Sequence[str], model: str, solve) -> DataFrame:
    names = ["Intercept", *terms]

    def one_state(pdf: pd.DataFrame) -> pd.DataFrame:
        folds, mean, sd = _unpack(pdf, len(terms))
        return pd.DataFrame({STATE: pdf[STATE].iloc[0], "model": model, "term": names, "value": solve(folds, mean, sd)})

    return _by_state(cells, one_state, _COEF_SCHEMA)


# ---- linear fits ----------------------------------------------------------------------------

def ols_per_state(df: DataFrame, terms: Sequence[str], target: str, model: str = "valuation") -> DataFrame:
    """Least squares for every state; collinear terms share their effect (predictions are unaffected)."""
    standard, stats = design(df, terms, [target])

    def solve(folds, mean, sd):
        return _raw_scale(solvers.least_squares(folds.sum(axis=0)), mean, sd)

    return _solve_states(moments(standard, terms, [target]).unionByName(stats), terms, model, solve)


def elastic_net_price(df: DataFrame, terms: Sequence[str], target: str, model: str = "high_bid",
                      alpha: float = 0.005) -> DataFrame:
    """Elastic net on unscaled terms at the last penalty of its path."""
    return elastic_net_price_fits(df, terms, target, model, alpha).filter(F.col("term") != PENALTY)


PENALTY = "(penalty)"


def elastic_net_price_fits(df: DataFrame, terms: Sequence[str], target: str, model: str = "high_bid", alpha: float = 0.005) -> DataFrame:
    """As ``elastic_net_price``, with the penalty of every state as one more row."""
    standard, stats = design(df, terms, [target])
    names = ["Intercept", *terms, PENALTY]

    def one_state(pdf: pd.DataFrame) -> pd.DataFrame:
        folds, mean, sd = _unpack(pdf, len(terms))
        n, m, cov = solvers.centred(folds.sum(axis=0))
        gram, cross = cov[:-1, :-1] * np.outer(sd, sd), cov[:-1, -1] * sd
        path, slopes = solvers.fit_path(gram, cross, cov[-1, -1], n, alpha)
        slope = solvers.elastic_net_exact(gram, cross, float(path[-1]), alpha, slopes[-1])  # the path stops short of the last digits
        values = [m[-1] - slope @ mean - (slope * sd) @ m[:-1], *slope, path[-1]]
        return pd.DataFrame({STATE: pdf[STATE].iloc[0], "model": model, "term": names, "value": values})

    return _by_state(moments(standard, terms, [target]).unionByName(stats), one_state, _COEF_SCHEMA)


def lambda_by_cv(df: DataFrame, terms: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """Penalty with the smallest held-out error of a lasso path, per state and target."""
    standard, _ = design(df, terms, targets)
    return _lambda(standard, terms, targets)


def _lambda(standard: DataFrame, terms: Sequence[str], targets: Sequence[str], share: float = 1e-5) -> DataFrame:
    p, targets = len(terms), list(targets)

    def one_state(pdf: pd.DataFrame) -> pd.DataFrame:
        folds, _, _ = _unpack(pdf, p, len(targets))
        rows = []
        for t, target in enumerate(targets):
            own = [*range(p + 1), p + 1 + t]
            mine = folds[:, own][:, :, own]
            rows.append((pdf[STATE].iloc[0], target, *solvers.cross_validated_penalty(mine, share), solvers.path_top(mine, share)))
        return pd.DataFrame(rows, columns=[STATE, "label", "lambda", "loss", "path_end", "path_top"])

    schema = f"{STATE} string, label string, lambda double, loss double, path_end double, path_top double"
    return _by_state(moments(standard, terms, targets), one_state, schema)


# ---- logistic fits --------------------------------------------------------------------------

def two_class(df: DataFrame, label: str, to_one: Column, to_zero: Column | None = None) -> DataFrame:
    """Where a state has one label only, flip the single row that comes closest to the other one.

    All zero: the row with the smallest ``to_one`` becomes 1. All one: the row with the smallest
    ``to_zero`` becomes 0. Ties go by listing key.
    """
    key = F.struct(*LISTING_KEY)
    to_zero = to_one if to_zero is None else to_zero

    def nearest(order: Column) -> Column:
        return F.min_by(key, F.when(order.isNotNull(), F.struct(order, *LISTING_KEY)))

    edge = settle(df.groupBy(STATE).agg(
        F.min(label).alias("_low"), F.max(label).alias("_high"),
        nearest(to_one).alias("_up"), nearest(to_zero).alias("_down")))
    joined = df.alias("d").join(edge.alias("e"), same_key("d", "e", [STATE]), "left")
    mine = F.struct(*[F.col(f"d.{k}") for k in LISTING_KEY])
    flipped = (
        F.when((F.col("_high") == 0) & (mine == F.col("_up")), 1)
        .when((F.col("_low") == 1) & (mine == F.col("_down")), 0)
        .otherwise(F.col(f"d.{label}"))
    )
    return joined.select(*[f"d.{c}" for c in df.columns if c != label], flipped.alias(label))


def shortfall() -> Column:
    """How far the high bid stayed below the reserve, as a share of it."""
    return ratio(F.col("Reserve") - F.col("HighBid"), F.col("Reserve"))


CONVERGED, ONE_CLASS, RUNNING, STOPPED = "converged", "one class", "running", "not converged"


LASSO_SHARE = 1e-5  # of the penalty of the sale models
STEPS = 4  # penalties a fit passes on its way down to its own
TABLE = f"{STATE} string, label string, penalty double, path array<double>, step int, beta array<double>, kept array<double>, loss double, status string, passes int"


def ridge_logistic(df: DataFrame, terms: Sequence[str], labels: Sequence[str], floor: float = 1e-4,
                   tol: float = 1e-6, most: int = 100) -> DataFrame:
    """Logistic regression of every label in every state: (state, model, term, value), see ``ridge_logistic_fits``."""
    return ridge_logistic_fits(df, terms, labels, floor, tol, most).select(STATE, "model", "term", "value")


def ridge_logistic_fits(df: DataFrame, terms: Sequence[str], labels: Sequence[str], floor: float = 1e-4, tol: float = 1e-6,
                        most: int = 100, share: float = LASSO_SHARE, penalty: float | None = None, steps: int = STEPS) -> DataFrame:
    """Elastic-net logistic regression of every label in every state, with ``status``, ``passes`` and ``penalty`` of each fit.

    ``share`` of the penalty is lasso, the rest ridge. The penalty of a (state, label) is its cross-validated lasso penalty, never
    below the end of the path of its own mix nor below ``floor``; or ``penalty`` for all. A fit starts at the penalty that
    leaves no slope and goes down to its own in ``steps`` even ratios, each from the solution before. Each pass over the rows is one
    proximal Newton step of all fits that still move: tasks sum the weighted moments, and the quadratic problem with its penalty is
    solved by coordinate descent on the p x p matrix. A step that raises the penalised loss is halved.
    Coefficients stay in a small settled frame that the rows are joined with; only whether fits still move comes back. A state with one
    class of a label has no finite optimum: it gets the smoothed share of its class and no slopes. A fit that still moves after ``most``
    passes says so in its status.
    """
    standard, stats = design(df, terms, labels)
    standard = settle(standard)  # every pass reads it: scaled once, not once a pass
    size = len(terms) + 1
    tally = standard.groupBy(STATE).agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"y_{x}").alias(f"ones_{x}") for x in labels])
    tally = tally.select(STATE, F.col("n").cast("double").alias("n"), F.explode(F.array(*[
        F.struct(F.lit(x).alias("label"), F.col(f"ones_{x}").alias("ones")) for x in labels])).alias("c")).select(STATE, "n", "c.*")
    lam = _lambda(standard, terms, labels, share)
    own = F.lit(float(penalty)) if penalty is not None else F.greatest("lambda", "path_end", F.lit(floor))
    lam = lam.select(STATE, "label", own.alias("penalty"), "path_top")
    mixed = (F.col("ones") > 0) & (F.col("ones") < F.col("n"))
    prior = F.log(ratio(F.col("ones") + F.when(mixed, 0.0).otherwise(0.5), F.col("n") - F.col("ones") + F.when(mixed, 0.0).otherwise(0.5)))
    drop = F.col("path_top") / F.col("penalty")
    path = F.transform(F.sequence(F.lit(1), F.lit(steps)), lambda k: F.when(k == steps, F.col("penalty")).otherwise(
        F.col("penalty") * F.pow(drop, 1 - k / steps)))
    start = F.concat(F.array(prior), F.array_repeat(F.lit(0.0), size - 1))
    fits = settle(tally.join(lam, [STATE, "label"]).select(
        STATE, "label", "penalty", F.when(drop > 1, path).otherwise(F.array("penalty")).alias("path"), F.lit(0).alias("step"),
        start.alias("beta"), start.alias("kept"), F.lit(float("inf")).alias("loss"),
        F.when(mixed, RUNNING).otherwise(ONE_CLASS).alias("status"), F.lit(0).alias("passes")))
    for k in range(1, most + 1):
        if not fits.filter(F.col("status") == RUNNING).limit(1).count():
            break
        moved = _newton_pass(standard, terms, labels, fits.filter(F.col("status") == RUNNING), share, tol, k == most)
        fits = settle(moved.unionByName(fits.filter(F.col("status") != RUNNING)))
    return _to_raw(fits, stats, terms)


def _newton_pass(standard: DataFrame, terms: Sequence[str], labels: Sequence[str], fits: DataFrame, share: float, tol: float, last: bool) -> DataFrame:
    """``fits`` after one step."""
    size = len(terms) + 1
    columns = list(terms)
    betas = fits.groupBy(STATE).agg(F.map_from_entries(F.collect_list(F.struct("label", "beta"))).alias("_beta"))

    def reduce_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # columns of b, label after label: weighted terms, residual and loss of a row; of a: 1 and terms
        sums: dict[str, Gram] = {}
        moving: dict[str, list[str]] = {}
        for batch in batches:
            terms_of = np.column_stack([np.ones(batch.num_rows), *[batch.column(c).to_numpy(zero_copy_only=False) for c in columns]])
            states = batch.column(STATE).dictionary_encode()
            codes = states.indices.to_numpy()
            for code, state in enumerate(states.dictionary.to_pylist()):
                rows = np.flatnonzero(codes == code)
                x, right = terms_of[rows], []
                betas = dict(batch.column("_beta")[int(rows[0])].as_py())  # of a state's rows only the first is read
                moving[state] = sorted(betas)
                for label in moving[state]:
                    z = np.clip((x * np.asarray(betas[label], dtype=float)).sum(axis=1), -700, 700)  # a row's sum does not depend on its neighbours
                    y, prob = batch.column(f"y_{label}").to_numpy(zero_copy_only=False)[rows], 1 / (1 + np.exp(-z))
                    right += [x * (prob * (1 - prob))[:, None], y - prob, np.logaddexp(0, z) - y * z, np.ones(len(x))]
                sums.setdefault(state, Gram()).add(x, np.column_stack(right))
        i, j = (m.ravel() for m in np.indices((size, size + 3)))
        wanted = (i <= j) & (j < size) | (j == size) | (i == 0)
        i, j = i[wanted], j[wanted]
        for state, s in sums.items():
            parts = s.parts()
            for k, label in enumerate(moving[state]):
                high, middle, low = (p[i, j + k * (size + 3)] for p in parts)
                yield pa.RecordBatch.from_pydict({
                    STATE: pa.array([state] * len(i)), "label": pa.array([label] * len(i)), "i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()),
                    "high": high, "middle": middle, "low": low, "power": np.ones(len(i))})

    def step(key: tuple, cells: pd.DataFrame, fit: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros((size, size + 3))
        held[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["v"].to_numpy()
        row = fit.iloc[0].copy()
        n = held[0, size + 2]
        hessian, gradient, loss = np.triu(held[:, :size]), held[:, size] / n, held[0, size + 1] / n
        hessian = (hessian + hessian.T - np.diag(np.diag(hessian))) / n
        beta, kept = np.array(row["beta"], dtype=float), np.array(row["kept"], dtype=float)
        lam = float(row["path"][row["step"]])
        full = loss + solvers.net_penalty(beta[1:], lam, share)
        row["passes"] += 1
        if full > row["loss"] * (1 + 1e-12) + 1e-12:  # too far: half the way
            fresh = (beta + kept) / 2
            moved = np.inf
        else:
            row["kept"], row["loss"] = beta, full
            fresh = solvers.proximal_step(hessian, gradient, beta, lam, share)
            moved = float(np.abs(fresh - beta).max())
        final = row["step"] == len(row["path"]) - 1
        if moved < (tol if final else 1e-2):
            if final:
                row["status"] = CONVERGED
            else:
                row["step"] += 1
                row["loss"] = np.inf  # another penalty has another loss
        if last and row["status"] == RUNNING:
            row["status"] = STOPPED
        row["beta"] = fresh
        out = pd.DataFrame([row])
        return out[[f.split()[0] for f in TABLE.split(", ")]]

    cells = _summed(
        standard.select(STATE, *[f"y_{x}" for x in labels], *columns).join(betas, STATE)
        .mapInArrow(reduce_batches, f"{STATE} string, label string, i int, j int, {PARTS}, power double"), STATE, "label")
    spread = cells.sparkSession.sparkContext.defaultParallelism
    key = [STATE, "label"]
    return cells.repartition(spread, *key).groupBy(*key).cogroup(fits.repartition(spread, *key).groupBy(*key)).applyInPandas(step, TABLE)


def _to_raw(fits: DataFrame, stats: DataFrame, terms: Sequence[str]) -> DataFrame:
    """Fits on standardised terms as a long table on the original scale."""
    def part(kind: int) -> Column:
        cells = F.sort_array(F.collect_list(F.when(F.col("i") == kind, F.struct("j", "v"))))
        return F.transform(cells, lambda c: c["v"])

    scale = stats.groupBy(STATE).agg(part(-1).alias("mean"), part(-2).alias("sd"))
    slope = F.zip_with(F.slice("beta", 2, len(terms)), "sd", lambda b, s: F.when(s > 1e-12, b / s).otherwise(0.0))
    held = fits.join(scale, STATE).withColumn("slope", slope)
    shift = F.aggregate(F.zip_with("slope", "mean", lambda b, m: b * m), F.lit(0.0), lambda a, b: a + b)
    values = F.concat(F.array(F.col("beta")[0] - shift), F.col("slope"))
    names = F.array(*[F.lit(t) for t in ("Intercept", *terms)])
    return held.select(STATE, F.col("label").alias("model"), "status", "passes", "penalty",
                       F.inline(F.arrays_zip(names.alias("term"), values.alias("value"))))


# ---- valuation training set -----------------------------------------------------------------

_MEDIAN_ROW = ("SFR_Flag", "MultiResidence_Flag", "Bedrooms", "Baths", "Age", "LotSize", "HomeSquareFootage", "MedianPPSQFT")


def valuation_training(df: DataFrame) -> DataFrame:
    """Valued listings with repaired home facts, plus one median listing of unknown condition per state."""
    valued = df.filter(F.col("BPO").isNotNull() & F.col(STATE).isNotNull())
    columns = [*_MEDIAN_ROW, *CONDITIONS]
    rows = settle(valued.select(STATE, *LISTING_KEY, "BPO", *[F.col(c).cast("double").alias(c) for c in columns]))
    usual = medians(rows, [STATE], {c: F.col(c) for c in _MEDIAN_ROW})
    value = quantiles(rows, [STATE], "BPO", [0.5], "q").select(STATE, F.col("q")[0].alias("BPO"))
    unknown = [F.lit(1.0 if c == "Condition_unknown" else 0.0).alias(c) for c in CONDITIONS]
    extra = usual.join(value, STATE).select(
        STATE, *[F.lit(-1).cast("long").alias(k) for k in LISTING_KEY], "BPO", *_MEDIAN_ROW, *unknown)
    together = rows.unionByName(settle(extra))
    c = F.col
    middles, feet = settle_all(
        medians(together, [STATE], {
            "m_Bedrooms": F.when(c("Bedrooms") > 0, c("Bedrooms")), "m_Baths": F.when(c("Baths") > 0, c("Baths")),
            "m_Age": F.when(c("Age") < 200, c("Age")),
        }),
        together.groupBy(STATE).agg(
            F.avg(F.when(c("HomeSquareFootage") >= 100, c("HomeSquareFootage"))).alias("m_feet")),
    )
    return (
        together.join(middles, STATE).join(feet, STATE)
        .withColumns({
            "Bedrooms": F.when(c("Bedrooms") < 0, c("m_Bedrooms")).otherwise(c("Bedrooms")),
            "Baths": F.when(c("Baths") < 0, c("m_Baths")).otherwise(c("Baths")),
            "Age": F.when(c("Age") >= 200, c("m_Age")).otherwise(c("Age")),
            "LotSize": F.coalesce("LotSize", F.lit(0.1)),
            "HomeSquareFootage": F.when(c("HomeSquareFootage") < 100, c("m_feet")).otherwise(c("HomeSquareFootage")),
        })
        .drop("m_Bedrooms", "m_Baths", "m_Age", "m_feet")
    )
