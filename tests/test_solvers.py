import numpy as np
import pytest

from hammerline.functions import solvers


def problem(n=400, p=6, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) * rng.uniform(0.5, 3, p)
    y = x @ np.array([1.5, 0, -2, 0, 0.3, 0][:p]) + 4 + rng.normal(size=n)
    return x, y


def moment(x, y):
    z = np.column_stack([np.ones(len(x)), x, y])
    return z.T @ z


def test_least_squares_equals_lstsq():
    x, y = problem()
    expected = np.linalg.lstsq(np.column_stack([np.ones(len(x)), x]), y, rcond=None)[0]
    assert np.allclose(solvers.least_squares(moment(x, y)), expected, atol=1e-8)


def test_collinear_columns_leave_predictions_unchanged():
    x, y = problem()
    wide = np.column_stack([x, x[:, 0] + x[:, 1]])
    a, b = solvers.least_squares(moment(x, y)), solvers.least_squares(moment(wide, y))
    assert np.allclose(a[0] + x @ a[1:], b[0] + wide @ b[1:], atol=1e-6)


def test_zero_penalty_recovers_least_squares():
    x, y = problem()
    _, mean, cov = solvers.centred(moment(x, y))
    b = solvers.elastic_net(cov[:-1, :-1, None], cov[:-1, -1:], 0.0, 1.0, 1e-18)
    assert np.allclose(b[:, 0], solvers.least_squares(moment(x, y))[1:], atol=1e-6)


@pytest.mark.parametrize("alpha", [1.0, 0.5, 0.005])
def test_elastic_net_meets_optimality_conditions(alpha):
    x, y = problem()
    _, _, cov = solvers.centred(moment(x, y))
    gram, cross, lam = cov[:-1, :-1], cov[:-1, -1], 0.3
    b = solvers.elastic_net(gram[:, :, None], cross[:, None], lam, alpha, 1e-20)[:, 0]
    slope = cross - gram @ b - lam * (1 - alpha) * b
    active = b != 0
    assert np.allclose(slope[active], lam * alpha * np.sign(b[active]), atol=1e-7)
    assert np.all(np.abs(slope[~active]) <= lam * alpha + 1e-7)


def test_stacked_problems_equal_single_ones():
    a, b = problem(seed=1), problem(seed=2)
    covs = [solvers.centred(moment(*q))[2] for q in (a, b)]
    gram = np.stack([c[:-1, :-1] for c in covs], axis=-1)
    cross = np.stack([c[:-1, -1] for c in covs], axis=-1)
    both = solvers.elastic_net(gram, cross, 0.2, 1.0, 1e-18)
    for k in range(2):
        one = solvers.elastic_net(gram[:, :, k:k + 1], cross[:, k:k + 1], 0.2, 1.0, 1e-18)
        assert np.allclose(both[:, k], one[:, 0], atol=1e-6)


def test_cross_validated_penalty_equals_brute_force():
    x, y = problem(n=200)
    fold = np.arange(len(x)) % 5
    lam, loss, _ = solvers.cross_validated_penalty(np.array([moment(x[fold == f], y[fold == f]) for f in range(5)]))
    total = moment(x, y)
    _, _, cov = solvers.centred(total)
    gram, cross, _ = solvers._standard(cov)
    path, _ = solvers.fit_path(gram, cross, cov[-1, -1], len(x), 1.0)
    losses = []
    for candidate in path:
        sse = 0.0
        for f in range(5):
            tr, te = fold != f, fold == f
            sd = x[tr].std(axis=0)
            z, zt = (x[tr] - x[tr].mean(axis=0)) / sd, (x[te] - x[tr].mean(axis=0)) / sd
            yc = y[tr] - y[tr].mean()
            b = solvers.elastic_net((z.T @ z / tr.sum())[:, :, None], (z.T @ yc / tr.sum())[:, None], candidate, 1.0, 1e-16)[:, 0]
            sse += ((y[te] - y[tr].mean() - zt @ b) ** 2).sum()
        losses.append(sse / len(x))
    assert loss == pytest.approx(min(losses), rel=1e-3)
    assert losses[int(np.argmin(np.abs(path - lam)))] == pytest.approx(min(losses), rel=1e-3)


def test_newton_reaches_the_penalised_optimum():
    x, y = problem()
    label = (y > y.mean()).astype(float)
    z = np.column_stack([np.ones(len(x)), (x - x.mean(0)) / x.std(0)])
    beta, lam = np.zeros(z.shape[1]), 0.05
    for _ in range(30):
        p = 1 / (1 + np.exp(-z @ beta))
        beta = solvers.newton_step(z.T @ (z * (p * (1 - p))[:, None]), z.T @ (label - p), beta, len(z), lam)
    p = 1 / (1 + np.exp(-z @ beta))
    gradient = z.T @ (label - p) / len(z) - lam * np.r_[0, beta[1:]]
    assert np.abs(gradient).max() < 1e-8


def test_penalty_stops_at_the_end_of_the_near_ridge_path():
    """With little noise the lasso wants less penalty than the near-ridge path ever has; its end holds."""
    r = np.random.default_rng(3)
    x = r.normal(size=(500, 6))
    y = (x @ r.normal(size=6) > 0).astype(float)
    folds = np.array([moment(x[k::10], y[k::10]) for k in range(10)])
    lam, _, end = solvers.cross_validated_penalty(folds)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    cross = np.abs(z.T @ (y - y.mean()) / len(y)).max()
    assert end == pytest.approx(cross / 1e-3 * 1e-4)
    assert lam < end
