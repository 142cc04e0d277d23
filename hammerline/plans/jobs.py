"""Whole jobs: from tables to one commit of predictions, from an extract to fitted models and their files.

Each job works in a workspace of the shared folder, which is empty again when its results are written.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from hammerline.operators import commits, publish, spelling
from hammerline.params import Params
from hammerline.plans import nontrustee, train, trustee
from hammerline.session import workspace
from hammerline.sources import files

_TRUSTEE_KEYS = {c: t for c, t in spelling.TEXT_KEYS.items() if c not in ("bidderemail", "SellerCode")}
_KEYS = {c: t for c, t in spelling.TEXT_KEYS.items() if c != "TrusteeCode"}


def _one_spelling(wh: Mapping[str, DataFrame], coefficients: Mapping[str, DataFrame], weights: DataFrame, keys: Mapping[str, tuple[str, ...]]):
    """Tables, coefficients and weights in which no text key differs by case alone; states are spelled alike in all three."""
    names = {n: f"coefficients of {n}" for n in coefficients}
    frames = spelling.Respelled(wh, {**{names[n]: f for n, f in coefficients.items()}, "weights": weights})
    same = spelling.unify(frames, {**keys, "PropertyState": (*keys["PropertyState"], *names.values(), "weights")})
    return same, {n: same[names[n]] for n in coefficients}, same["weights"]


def publish_predictions(wh: Mapping[str, DataFrame], coefficients: Mapping[str, DataFrame], weights: DataFrame, p: Params, root: str,
                        run_id: int, trustees: bool = False) -> commits.Manifest:
    """Feature rows of the upcoming listings, scored, explained and committed as one run: history and current set change together."""
    plan = trustee if trustees else nontrustee
    spark = weights.sparkSession
    with workspace(spark):
        wh, coefficients, weights = _one_spelling(wh, coefficients, weights, _TRUSTEE_KEYS if trustees else _KEYS)
        out = plan.predictions(plan.feature_row(wh, p, scoring=True), coefficients, weights, p)
        staged = commits.stage(out, root, run_id)
    return commits.commit(spark, staged)


def publish_unified(spark, roots: tuple[str, str], root: str, run_id: int) -> commits.Manifest:
    """The current sets of both product lines (non-trustee, trustee) in one layout, as one run."""
    return commits.publish(publish.unified(*[commits.read_current(spark, r) for r in roots]), root, run_id)


def train_and_write(rows: DataFrame, line: train.Line, p: Params, folder: str, estimates: DataFrame | None = None,
                    second: DataFrame | None = None, accepted: DataFrame | None = None) -> None:
    """Fit one product line on its extract and write ``full``, ``short`` and, with a second population, ``second`` as delimited files,
    and ``coefficients`` with a folder a model, each with how its fit ended."""
    with workspace(rows.sparkSession):
        frames = {"rows": rows, "second": second, "accepted": accepted}
        given = [n for n, f in frames.items() if f is not None]
        same = spelling.unify(frames, {c: given for c in ("SellerCode", "TrusteeCode", "AuctionCode", "PropertyState", "PropertyCounty")})
        rows, second, accepted = (same[n] for n in frames)
        fit = train.fit_and_score(rows, line, p, estimates, second, accepted)
        publish.write_csv(fit.full, f"{folder}/full")
        publish.write_csv(fit.short, f"{folder}/short")
        files.write_coefficients(fit.coefficients, f"{folder}/coefficients")
        if fit.second is not None:
            publish.write_csv(fit.second, f"{folder}/second")
