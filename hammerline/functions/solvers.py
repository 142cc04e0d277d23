"""Small dense solvers over moment matrices. Their input is p x p (p about 40), never rows of data."""

from __future__ import annotations

import numpy as np


def centred(moments: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """(row count, means, covariance) of the columns after the leading constant one."""
    n = moments[0, 0]
    mean = moments[0, 1:] / n
    return n, mean, moments[1:, 1:] / n - np.outer(mean, mean)


def least_squares(moments: np.ndarray) -> np.ndarray:
    """Intercept and coefficients of the last column on the others; minimum norm when collinear."""
    _, mean, cov = centred(moments)
    gram, cross = cov[:-1, :-1], cov[:-1, -1]
    beta = np.linalg.pinv(gram, rcond=1e-10, hermitian=True) @ cross
    return np.concatenate([[mean[-1] - mean[:-1] @ beta], beta])


def elastic_net(gram: np.ndarray, cross: np.ndarray, lam: float, alpha: float, tol: float,
                start: np.ndarray | None = None) -> np.ndarray:
    """Coordinate descent for a stack of problems sharing one penalty.

    Minimises b'Gb/2 - c'b + lam * (alpha * |b|_1 + (1 - alpha) / 2 * |b|_2^2) for every (G, c) of the
    stack. The stack is the last axis: ``gram`` is (p, p, k), ``cross`` and the result (p, k). Stops
    when no coordinate lowers the objective by more than ``tol``; every sweep before that lowers it by more than
    half of ``tol``, and it is bounded below, so the sweeps need no limit.
    """
    p, k = cross.shape
    beta = np.zeros((p, k)) if start is None else start.copy()
    rest = cross - np.einsum("ijk,jk->ik", gram, beta)
    diagonal = np.ascontiguousarray(np.einsum("iik->ik", gram))
    usable = diagonal > 1e-12
    inverse = np.where(usable, 1 / np.where(usable, diagonal + lam * (1 - alpha), 1.0), 0.0)
    bar = lam * alpha
    moved = np.inf
    while moved > tol:
        moved = 0.0
        for j in range(p):
            had = beta[j]
            pull = rest[j] + diagonal[j] * had
            fresh = (pull - np.minimum(np.maximum(pull, -bar), bar)) * inverse[j]
            step = fresh - had
            if step.any():
                rest -= gram[j] * step
                beta[j] = fresh
                moved = max(moved, float((diagonal[j] * step * step).max()))
    return beta


def penalty_path(cross: np.ndarray, n: float, alpha: float, size: int = 100) -> np.ndarray:
    """Decreasing penalties from the smallest one that zeroes every coefficient."""
    top = np.abs(cross).max() / max(alpha, 1e-3)
    low = 1e-4 if n > len(cross) else 1e-2
    return np.geomspace(top, top * low, size) if top > 0 else np.zeros(1)


def fit_path(gram: np.ndarray, cross: np.ndarray, variance: float, n: float, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """(penalties, coefficients per penalty); ends early once the explained share stalls or is complete."""
    path, fits, share = penalty_path(cross, n, alpha), [], 0.0
    beta = None
    for lam in path:
        beta = elastic_net(gram[:, :, None], cross[:, None], float(lam), alpha, 1e-7 * variance, beta)
        b = beta[:, 0]
        fits.append(b.copy())
        before, share = share, (2 * cross @ b - b @ gram @ b) / max(variance, 1e-300)
        if len(fits) >= 5 and (share - before < 1e-5 * share or share > 0.999):
            break
    return path[:len(fits)], np.array(fits)


def _standard(cov: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(correlation of the features, their scaled products with the last column, deviations)."""
    sd = np.sqrt(np.maximum(np.diag(cov)[:-1], 0))
    sd = np.where(sd > 1e-9, sd, np.inf)
    return cov[:-1, :-1] / np.outer(sd, sd), cov[:-1, -1] / sd, sd


def cross_validated_penalty(folds: np.ndarray, ridge_share: float = 1e-5) -> tuple[float, float, float]:
    """(penalty, mean squared error) with the smallest held-out error of a lasso path, and the end of the path whose lasso part is ``ridge_share``.

    A model of another mix is known along its own path only: a smaller penalty than the last of that path counts as the last.

    ``folds`` is (k, m, m): one moment matrix per fold over (1, features, target).
    """
    total = folds.sum(axis=0)
    keep = [f for f in folds if f[0, 0] > 0]
    n, _, cov = centred(total)
    gram, cross, _ = _standard(cov)
    path, _ = fit_path(gram, cross, cov[-1, -1], n, 1.0)
    parts = [centred(total - f) for f in keep]
    scaled = [_standard(c) for _, _, c in parts]
    means = np.array([m for _, m, _ in parts]).T
    grams = np.ascontiguousarray(np.stack([g for g, _, _ in scaled], axis=-1))
    crosses = np.stack([c for _, c, _ in scaled], axis=-1)
    scales = np.stack([s for _, _, s in scaled], axis=-1)
    beta, best = None, (float(path[0]), np.inf)
    for lam in path:
        beta = elastic_net(grams, crosses, float(lam), 1.0, 1e-7 * cov[-1, -1], beta)
        raw = beta / scales
        intercept = means[-1] - (raw * means[:-1]).sum(axis=0)
        loss = 0.0
        for i, held in enumerate(keep):
            v = np.concatenate([[-intercept[i]], -raw[:, i], [1.0]])
            loss += float(v @ held @ v)
        if loss / n < best[1] - 1e-15:
            best = (float(lam), loss / n)
    return *best, float(penalty_path(cross, n, ridge_share)[-1])


def path_top(folds: np.ndarray, share: float) -> float:
    """The penalty at which the path of a mix begins, where no slope is left."""
    n, _, cov = centred(folds.sum(axis=0))
    return float(penalty_path(_standard(cov)[1], n, share)[0])


def newton_step(hessian: np.ndarray, gradient: np.ndarray, beta: np.ndarray, n: float, lam: float) -> np.ndarray:
    """One ridge-logistic update; the intercept (first) is not penalised."""
    penalty = np.full(len(beta), lam)
    penalty[0] = 1e-9
    return beta + np.linalg.solve(hessian / n + np.diag(penalty), gradient / n - penalty * beta)


def elastic_net_exact(gram: np.ndarray, cross: np.ndarray, lam: float, share: float, start: np.ndarray, most: int = 100) -> np.ndarray:
    """The elastic net of one problem by solving for the signs: with them known it is a linear system.

    Slopes whose sign turns leave, slopes whose pull exceeds the lasso part come in, until both conditions of the optimum hold. If signs still
    change after ``most`` rounds, coordinate descent finishes.
    """
    ridge, lasso = lam * (1 - share), lam * share
    p = len(cross)
    usable = np.diag(gram) > 1e-12
    system = gram + np.diag(np.full(p, ridge))
    beta, signs = np.zeros(p), np.where(usable, np.sign(start), 0.0)
    if not signs.any():
        signs = np.where(usable & (np.abs(cross) > lasso), np.sign(cross), 0.0)
    for _ in range(most):
        inside = np.flatnonzero(signs)
        beta = np.zeros(p)
        if len(inside):
            beta[inside] = np.linalg.lstsq(system[np.ix_(inside, inside)], cross[inside] - lasso * signs[inside], rcond=None)[0]
        turned = (signs != 0) & (np.sign(beta) != signs)
        pull = cross - gram @ beta
        wanted = usable & (signs == 0) & (np.abs(pull) > lasso * (1 + 1e-9) + 1e-15)
        if not turned.any() and not wanted.any():
            return beta
        signs = np.where(turned, 0.0, np.where(wanted & ~turned.any(), np.sign(pull), signs))
    variance = float(np.abs(np.diag(gram)).max(initial=0.0))
    return elastic_net(gram[:, :, None], cross[:, None], lam, share, 1e-16 * max(variance, 1e-12), start[:, None])[:, 0]


def net_penalty(slopes: np.ndarray, lam: float, share: float) -> float:
    return lam * float(share * np.abs(slopes).sum() + (1 - share) / 2 * (slopes * slopes).sum())


def proximal_step(hessian: np.ndarray, gradient: np.ndarray, beta: np.ndarray, lam: float, share: float) -> np.ndarray:
    """The optimum of the loss's quadratic model at ``beta`` under an elastic net; the intercept (first) is not penalised.

    ``hessian`` and ``gradient`` (of the log likelihood) are means over the rows. The intercept is profiled out, which leaves
    a problem in the slopes.
    """
    top = max(hessian[0, 0], 1e-12)
    side = hessian[0, 1:]
    gram = hessian[1:, 1:] - np.outer(side, side) / top
    cross = gradient[1:] - side * gradient[0] / top + gram @ beta[1:]
    slopes = elastic_net_exact(gram, cross, lam, share, beta[1:])
    return np.concatenate([[beta[0] + (gradient[0] - side @ (slopes - beta[1:])) / top], slopes])
