"""Edge frames for the single rules."""

import dataclasses
from datetime import date

import pytest
from pyspark.sql import functions as F

from hammerline.functions import scoring as sf
from hammerline.operators import explain, features as fx, history, impute, models, publish, report, scoring
from hammerline.params import Params
from hammerline.plans import trustee
from hammerline.sources import files


def one(df, column):
    return [r[column] for r in df.collect()]


def test_raw_reserve_takes_zero_and_positive_reserve_does_not(spark):
    rows = [(0.0, None, None, 80.0, 70.0), (None, None, None, None, None), (-5.0, None, 0.0, None, 40.0), (None, None, None, None, 7.0)]
    df = spark.createDataFrame(rows, "a double, r double, b double, c double, d double")
    fa = df.selectExpr("a AS AuctionSellerReserve", "b AS Reserve", "c AS LenderReserve", "d AS UpdatedReserve", "monotonically_increasing_id() AS id").alias("fa")
    fr = df.selectExpr("r AS AuctionSellerReserve", "monotonically_increasing_id() AS id").alias("fr")
    out = fa.join(fr, F.col("fa.id") == F.col("fr.id")).orderBy("fa.id").select(fx.reserve().alias("x"), fx.positive_reserve().alias("y"))
    assert one(out, "x") == [0.0, None, -5.0, 7.0]
    assert one(out, "y") == [80.0, None, 40.0, 7.0]


def valuation_frame(spark, **given):
    names = ["AprAsIs", "TotalOwed", "PropertyFeature6", "SellerBPOValue", "Agent90AsIs", "AgentValue", "GrcValue",
             "AuctionSellerReserve", "Reserve", "LenderReserve", "UpdatedReserve"]
    num = lambda n, src: F.lit(given.get(f"{src}_{n}")).cast("double").alias(n)
    base = spark.range(1)
    fa = base.select("id", *[num(n, "fa") for n in names]).alias("fa")
    fr = base.select("id", *[num(n, "fr") for n in ("AuctionSellerReserve", "BPO", "AprAsIs")]).alias("fr")
    dp = base.select("id", F.lit(given.get("product", "REO")).alias("ProductType"), num("SellerBPOValue", "dp")).alias("dp")
    ds = base.select("id", F.lit(given.get("parent")).cast("string").alias("SellerParent")).alias("ds")
    joined = fa.join(fr, F.col("fa.id") == F.col("fr.id")).join(dp, F.col("fa.id") == F.col("dp.id")).join(ds, F.col("fa.id") == F.col("ds.id"))
    return joined.select(fx.valuation(Params(as_of=date(2014, 2, 1)), parent="ds.SellerParent").alias("v")).first().v


def test_valuation_source_order(spark):
    assert valuation_frame(spark, product="c2c", fa_AprAsIs=9.0, fr_BPO=5.0) == 9.0
    assert valuation_frame(spark, parent="bank of america", fa_TotalOwed=3.0, fr_BPO=5.0) == 3.0
    assert valuation_frame(spark, fa_TotalOwed=3.0, fr_BPO=5.0) == 5.0
    assert valuation_frame(spark, fa_AprAsIs=50_000_001.0, fa_Reserve=10_000_000.0, dp_SellerBPOValue=11.0) == 11.0
    assert valuation_frame(spark, fa_AprAsIs=9_000_000.0, fa_Reserve=1_000_000.0) == 9_000_000.0
    assert valuation_frame(spark, dp_SellerBPOValue=9.0) is None


def test_trustee_share_is_over_itself_unless_switched(spark, p):
    df = spark.createDataFrame([(150.0, 100.0)], "v double, r double")
    share = lambda q: df.select(trustee.surplus_share(F.col("v"), F.col("r"), q).alias("s")).first().s
    assert share(p) == 0.0
    assert share(dataclasses.replace(p, trustee_pct_over_reserve=True)) == pytest.approx(0.5)


def test_flags_ignore_case_and_null_is_no_condition(spark):
    df = spark.createDataFrame([("sfr", "reo", "Excellent", "VACANT"), ("Townhouse", "Short Sale", None, "n/a")],
                               "PropertyType string, ProductType string, Condition string, PropertyOccupancyStatus string")
    out = df.withColumns(fx.property_flags()).collect()
    assert (out[0].SFR_Flag, out[0].REO_Flag, out[0].Condition_good, out[0].PropertyOccupancyStatus_Vacant) == (1, 1, 1, 1)
    assert sum(out[1][c] for c in sf.CONDITIONS) == 0 and out[1].PropertyOccupancyStatus_Unknown == 1
    shown = df.select(fx.condition_text(F.col("Condition"), True).alias("a"), fx.condition_text(F.col("Condition"), False).alias("b"))
    assert shown.collect()[1] == ("unknown", None)


def test_status_filter_drops_unknown_status(spark):
    status = spark.createDataFrame([(1, "Sold"), (2, "Removed by seller"), (3, "cancelled"), (4, None)], "AuctionStatusId int, AuctionStatus string")
    df = spark.createDataFrame([(i,) for i in range(1, 6)], "AuctionStatusId int")
    assert one(history.live_status(df, status), "AuctionStatusId") == [1]


def test_zip_in_two_states_stays_apart(spark, p):
    prop = spark.createDataFrame([(1, "CA", "9"), (2, "NV", "9")], "PropertyId int, PropertyState string, PropertyZip string")
    rows = [(1, 1, 1)] * 10 + [(2, 0, 1)] * 10 + [(2, 1, None)]
    listings = spark.createDataFrame(rows, "PropertyId int, IsSold int, IsAuctioned int")
    out = {r.PropertyState: (r.AvgSTR, r.TotalAuctioned) for r in history.zip_sell_through(listings, prop, p).collect()}
    assert out["CA"] == (1.0, 10) and out["NV"] == (pytest.approx(1 / 11), 10)


def test_monotone_rule_leaves_nulls_alone(spark):
    rows = [(0.1, 0.3, 0.2), (0.1, 0.2, 0.3), (None, 0.2, 0.3), (0.1, None, 0.3), (0.1, 0.2, None)]
    names = ["AuctionDaySalePrediction", "SellerAcceptedSalePrediction", "ExceedReservePrediction"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    got = [(r[names[0]], r[names[1]], r[names[2]]) for r in scoring.order_probabilities(df).select(*names).collect()]
    assert got == [(0.3, 0.3, 0.2), (0.3, 0.3, 0.3), (None, 0.3, 0.3), (0.1, None, 0.3), (0.2, 0.2, None)]


def test_bands_include_their_lower_edge(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.5,), (0.8,), (None,)], "p double")
    assert one(df.select(scoring.likelihood_band(F.col("p")).alias("b")), "b") == ["Low", "Borderline", "Moderate", "High", "Low"]


def test_price_cap_floor_and_reduction(spark):
    df = spark.createDataFrame([(400000.0, 200000.0, 0.4), (180000.0, 100000.0, 0.4), (90000.0, 100000.0, 0.4), (90000.0, 100000.0, 0.6)],
                               "price double, reserve double, chance double")
    out = df.select(scoring.cap_price(F.col("price"), F.col("reserve")).alias("c"),
                    scoring.reserve_reduction(F.col("chance"), F.col("price"), F.col("reserve")).alias("r"))
    assert one(out, "c") == [300000.0, 180000.0, 90000.0, 90000.0]
    assert one(out, "r") == [0.0, 0.0, -10000.0, 0.0]


def test_rounded_defaults_switch(p):
    old = dataclasses.replace(p, legacy_decimal=True)
    assert [old.number(n) for n in ("valuation_ratio", "surplus_share_default", "absurd_valuation_bound", "vacancy_default")] == [1, 0, 0, 0]
    assert p.number("valuation_ratio") == 1.2
    first, second = sf.NONTRUSTEE_MODELS[:2]
    assert "0.2D" in sf.scoring_input("BPOSurplusPct", old, first)
    assert "0.0D" in sf.scoring_input("BPOSurplusPct", old, second)


def test_score_is_null_with_a_null_term_and_defaults_apply(spark, p):
    model = sf.Model("m", "out", ("Appreciation", "Vacancy", "BPOSurplus"), logistic=False)
    df = spark.createDataFrame([("CA", 1.0, None, None, 100.0, 1.0), ("CA", None, 0.1, 50.0, 100.0, 1.0), ("ZZ", 1.0, 0.1, 50.0, 100.0, 1.0)],
                               "PropertyState string, Appreciation double, Vacancy double, BPO double, Reserve double, BPOSurplus double")
    table = spark.createDataFrame([("CA", 1.0, 2.0, 10.0, 0.1)], "PropertyState string, Intercept double, Appreciation double, Vacancy double, BPOSurplus double")
    got = one(scoring.with_scores(df, {"m": table}, (model,), p).orderBy("Appreciation"), "out")
    assert got == [None, pytest.approx(1 + 2 + 0.87 + 0.1 * 120)]


def test_acceptance_falls_back_to_home_state_then_last_model(spark):
    models_ = spark.createDataFrame([("A", "NV", 0, 1.0), ("A", "CA", 1, 2.0), ("B", "TX", 2, 3.0), ("Z", "Z", 9, 4.0)],
                                    "SellerCode string, PropertyState string, Position int, intercept double").withColumns(
        {b: F.lit(0.0) for b in ("b1", "b2", "b3")})
    df = spark.createDataFrame([(1, "A", "NV"), (2, "A", "TX"), (3, "B", "NV"), (4, "C", "NV")], "id int, SellerCode string, PropertyState string")
    out = scoring.acceptance(df.withColumns({"price": F.lit(1.0), "Reserve": F.lit(2.0)}), models_, "price").orderBy("id")
    z = one(out.select(F.log(F.col("AcceptancePrediction") / (1 - F.col("AcceptancePrediction"))).alias("z")), "z")
    assert z == [pytest.approx(v) for v in (1.0, 2.0, 4.0, 4.0)]


def fault_frame(spark, rows):
    cols = [v for v in explain.VARIABLES]
    df = spark.createDataFrame(rows, "PropertyId long, AuctionId long, VenueId long, GlobalPropertyId long, PropertyState string, Reserve double, BPO double, Vacancy double, Appreciation double")
    given = set(df.columns)
    return df.withColumns({c: F.lit(None).cast("double") for c in cols if c not in given})


def test_faults_need_two_contributions_and_skip_reserve(spark, p):
    lookup = spark.createDataFrame([("CA", "Reserve", "R", -9.0), ("CA", "Vacancy", "V", -1.0), ("CA", "Appreciation", "A", -1.0), ("CA", "Intercept", "I", -99.0)],
                                   "PropertyState string, PropertyFaultVariable string, PropertyFaultName string, Value double")
    df = fault_frame(spark, [(1, 1, 1, 7, "CA", 5.0, None, 0.5, 0.9), (2, 1, 1, 8, "CA", 5.0, None, 0.5, None), (3, 1, 1, 9, "CA", 5.0, None, 2.0, 2.0),
                             (4, 1, 1, 7, "CA", 5.0, None, 3.0, 0.1)])
    out = {r.PropertyId: (r.Negative1, r.Negative2) for r in explain.top_two_faults(df, lookup, explain.VARIABLES, p).collect()}
    assert out == {1: ("A", "V"), 3: ("A", "V"), 4: ("V", "A")}
    shared = explain.top_two_faults(df, lookup, explain.VARIABLES, p, key=["GlobalPropertyId"])
    assert {r.PropertyId: (r.Negative1, r.Negative2) for r in shared.collect()} == {1: ("V", "A"), 3: ("A", "V"), 4: ("V", "A")}


def test_centred_faults_report_ties(spark):
    df = spark.createDataFrame([("CA", 1, 0, 4.0), ("CA", 0, 0, 8.0), ("CA", 1, 1, 6.0)], "PropertyState string, RunFlag int, OtherFlag int, Size double")
    weights = spark.createDataFrame([("CA", "RunFlag", -1.0), ("CA", "OtherFlag", -1.0), ("CA", "Size", 0.01)], "PropertyState string, term string, weight double")
    names = {"RunFlag": "Runs", "OtherFlag": "Other", "Size": "Small"}
    out = explain.centred_faults(df, weights, ["RunFlag", "OtherFlag", "Size"], masked=(), names=names).orderBy("Size").select("Neg1", "Neg2")
    assert [tuple(r) for r in out.collect()] == [("Runs", "Small"), (explain.NO_FAULT, explain.NO_FAULT), (explain.NO_FAULT, explain.NO_FAULT)]


def test_hierarchical_fill_levels(spark):
    names = list(impute.FILLED)
    rows = [("CA", "A", 1.0), ("CA", "A", None), ("CA", "B", None), ("NV", "C", None), ("TX", "D", 5.0)]
    df = spark.createDataFrame([(i, s, c, v) for i, (s, c, v) in enumerate(rows)], "id int, PropertyState string, PropertyCounty string, Turnover double")
    df = df.withColumns({n: F.when(F.col("id") == 1, 77.0).otherwise(F.col("Turnover")) for n in names if n != "Turnover"})
    out = impute.hierarchical_fill(df).orderBy("id").collect()
    assert [r.Turnover for r in out] == [1.0, 1.0, 1.0, 3.0, 5.0]
    assert [r.Appreciation for r in out] == [1.0, 39.0, 39.0, 5.0, 5.0]  # a missing Turnover overwrites all metrics


def test_reserve_position_at_breakpoints(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (2.0,), (3.0,)], "r double").withColumn("b", F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)))
    assert one(df.select(impute.reserve_position(F.col("r"), F.col("b")).alias("k")), "k") == [1, 2, 2, 3]


def test_two_class_flips_one_row_only_when_needed(spark):
    rows = [(1, "CA", 0, 0.3), (2, "CA", 0, 0.1), (3, "CA", 0, 0.1), (4, "NV", 1, 0.2), (5, "NV", 0, 0.9), (6, "TX", 1, 0.5), (7, "TX", 1, None)]
    df = spark.createDataFrame(rows, "PropertyId long, PropertyState string, y int, gap double").withColumns({"AuctionId": F.lit(1), "VenueId": F.lit(1)})
    out = models.two_class(df, "y", F.col("gap"), -F.col("gap"))
    assert {r.PropertyId: r.y for r in out.collect()} == {1: 0, 2: 1, 3: 0, 4: 1, 5: 0, 6: 0, 7: 1}


def test_ols_and_logistic_against_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    rows = [(int(i), 1, 1, "CA" if i % 3 else "NV", float(a), float(b), float(3 + 2 * a - b + e), int(a + e > 0))
            for i, (a, b, e) in enumerate(rng.normal(size=(600, 3)))]
    df = spark.createDataFrame(rows, "PropertyId long, AuctionId long, VenueId long, PropertyState string, a double, b double, y double, hit int")
    pdf = df.toPandas()
    fit = {(r.PropertyState, r.term): r.value for r in models.ols_per_state(df, ["a", "b"], "y").collect()}
    logit = {(r.PropertyState, r.term): r.value for r in models.ridge_logistic(df, ["a", "b"], ["hit"]).collect()}
    lam = {r.PropertyState: max(r["lambda"], r["path_end"], 1e-4) for r in models.lambda_by_cv(df, ["a", "b"], ["hit"]).collect()}
    for state, part in pdf.groupby("PropertyState"):
        x = np.column_stack([np.ones(len(part)), part.a, part.b])
        expected = np.linalg.lstsq(x, part.y, rcond=None)[0]
        assert np.allclose([fit[(state, t)] for t in ("Intercept", "a", "b")], expected)
        beta = np.array([logit[(state, t)] for t in ("Intercept", "a", "b")])
        prob = 1 / (1 + np.exp(-x @ beta))
        sd = part[["a", "b"]].std(ddof=0).to_numpy()
        z = (part[["a", "b"]] - part[["a", "b"]].mean()).to_numpy() / sd
        gradient = z.T @ (part.hit - prob) / len(part) - lam[state] * beta[1:] * sd
        assert np.abs(gradient).max() < 1e-5 and abs((part.hit - prob).mean()) < 1e-5


def test_history_keeps_one_current_run(spark, tmp_path):
    path = str(tmp_path / "h")
    df = spark.createDataFrame([(1, 0.5)], "PropertyId int, x double")
    for run in (1, 2, 2):
        publish.append_history(df, path, run)
    out = publish.read_history(spark, path)
    assert sorted((r.RunId, r.MostRecentData) for r in out.collect()) == [(1, 0), (2, 1)]
    assert publish.current_rows(out).count() == 1


def test_csv_reading_and_writing(spark, tmp_path, p):
    (tmp_path / "UnifiedPredictionData_2014-02-01.csv").write_text('AuctionDate,SellerName,Reserve\n1/5/2014,"Smith, Co",100\nbad,X,NULL\n')
    raw = files.read_feature_csv(spark, str(tmp_path), p.as_of, ["AuctionDate", "SellerName", "Reserve"])
    assert [str(r.AuctionDate) for r in raw.collect()] == ["2014-01-05", "None"]
    ready = raw.withColumns({"BPO": F.lit("5"), "BPOSurplusPct": F.lit("9"), "PropertyCity": F.lit("A,B")})
    clean = impute.clean(ready, p, ["Reserve", "BPO", "BPOSurplusPct"]).collect()
    assert [(r.SellerName, r.Reserve, r.BPO, r.PropertyCity) for r in clean] == [("Smith Co", 100.0, None, "AB")]
    publish.write_csv(raw.select("SellerName", "Reserve"), str(tmp_path / "out"))
    back = spark.read.option("header", True).option("nullValue", "NA").csv(str(tmp_path / "out"))
    assert sorted(r.SellerName for r in back.collect()) == ["Smith, Co", "X"]


def test_estimate_files_are_stacked(spark, tmp_path):
    (tmp_path / "a.csv").write_text("2014-01-01,http://x/asset/12?y=1,100\n2014-01-02,http://x/asset/12,300\n")
    (tmp_path / "b.csv").write_text("2014-01-01,http://x/other/9,50\n2014-01-01,http://x/asset/5,NULL\n")
    out = impute.external_estimates(files.read_estimates(spark, str(tmp_path / "*.csv")))
    assert [(r.GlobalPropertyId, r.ExternalEstimate) for r in out.collect()] == [(12, 200.0)]


def test_coefficients_round_trip(spark):
    wide = spark.createDataFrame([("CA", 1.0, 2.0)], "PropertyState string, Intercept double, Reserve double")
    long = scoring.coefficients_long(wide, "m", ["Reserve"])
    assert scoring.coefficients_wide(long, ["Reserve"]).collect() == wide.collect()


def test_histogram_puts_one_in_the_last_bin(spark, p):
    df = spark.createDataFrame([(1.0, date(2014, 3, 1)), (0.0, date(2014, 1, 1)), (0.5, date(2014, 2, 1))], "p double, AuctionDate date")
    out = {(r.Population, r.Bin): r.Rows for r in report.prediction_histogram(df, p, "p", 10).collect()}
    assert out == {("all", 10): 1, ("all", 1): 1, ("all", 6): 1, ("upcoming", 10): 1, ("trailing", 1): 1}


# ---- fits that lose, mislabel or cap nothing -------------------------------------------------

def test_balanced_flips_the_listing_nearest_to_its_reserve(spark):
    """All met their reserve: the one that exceeded it least fails. None did: the one that fell short least succeeds."""
    from hammerline.plans import train
    rows = [("A", k, 1, 1, 100.0, bid, 1) for k, bid in enumerate([500.0, 101.0, 200.0])]
    rows += [("B", k, 1, 1, 100.0, bid, 0) for k, bid in enumerate([10.0, 99.0, 50.0])]
    df = spark.createDataFrame(rows, "PropertyState string, PropertyId long, AuctionId long, VenueId long, Reserve double, HighBid double, AuctionReserveSuccess int")
    out = {(r.PropertyState, r.HighBid): r.AuctionReserveSuccess for r in train.balanced(df, train.REO).collect()}
    assert out == {("A", 500.0): 1, ("A", 101.0): 0, ("A", 200.0): 1, ("B", 10.0): 0, ("B", 99.0): 1, ("B", 50.0): 0}


def test_blend_without_valuations_in_a_bucket_takes_three_reserves(spark, p):
    from datetime import timedelta
    from hammerline.operators import impute
    day = p.as_of - timedelta(days=1)
    rows = [(k, 100.0 * (k + 1), 90.0 * (k + 1) if k < 3 else None, 80.0, day, "X", 50.0) for k in range(10)]
    rows += [(k, 100.0, None, 80.0, day, "NO VALUES AT ALL", 50.0) for k in (20, 21)]
    df = spark.createDataFrame(rows, "PropertyId long, Reserve double, BPO double, Guess double, AuctionDate date, PropertyState string, StartingBid double")
    out = {r.PropertyId: r.BPO for r in impute.blend_valuation(df, p, "Guess").collect()}
    assert None not in out.values()
    assert out[7] == 3 * 800.0 and out[20] == 300.0 and out[1] == 180.0


def test_listing_of_a_state_without_a_model_keeps_its_row(spark):
    from hammerline.plans import train
    df = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "PropertyState string, x double")
    coefficients = spark.createDataFrame([("A", "m", "Intercept", 1.0), ("A", "m", "x", 2.0)], "PropertyState string, model string, term string, value double")
    got = {r.PropertyState: r.out for r in train.predict(df, coefficients, "m", ["x"], "out", how="left").collect()}
    assert got == {"A": 3.0, "B": None}
    assert [r.out for r in train.predict(df, coefficients, "m", ["x"], "out").collect()] == [3.0]


def test_repeated_coefficient_is_an_error(spark):
    from hammerline.operators import scoring
    twice = spark.createDataFrame([("A", "x", 2.0), ("A", "x", 3.0)], "PropertyState string, term string, value double")
    with pytest.raises(Exception, match="more than one value"):
        scoring.coefficients_wide(twice, ["x"]).collect()


def _states(spark, **states):
    rows = [(s, k, 1, 1, float(x), int(y)) for s, points in states.items() for k, (x, y) in enumerate(points)]
    return spark.createDataFrame(rows, "PropertyState string, PropertyId long, AuctionId long, VenueId long, x double, y int")


def test_every_logistic_fit_says_how_it_ended(spark):
    """One ordinary, one separable and one one-class state: the ordinary one takes as many passes as alone, and all have a status."""
    import numpy as np
    from hammerline.operators import models
    r = np.random.default_rng(2)
    x = r.normal(size=200)
    ordinary = list(zip(x, r.random(200) < 1 / (1 + np.exp(-x))))
    separable, single = [(v, v > 0) for v in x], [(v, 1) for v in x[:40]]
    got = models.ridge_logistic_fits(_states(spark, O=ordinary, S=separable, C=single), ["x"], ["y"]).toPandas().set_index(["PropertyState", "term"])
    alone = models.ridge_logistic_fits(_states(spark, O=ordinary), ["x"], ["y"]).toPandas().set_index("term")
    assert got.loc[("O", "x"), "status"] == got.loc[("S", "x"), "status"] == models.CONVERGED and got.loc[("C", "x"), "status"] == models.ONE_CLASS
    assert got.loc[("O", "x"), "passes"] == alone.loc["x", "passes"] and got.loc[("O", "x"), "value"] == pytest.approx(alone.loc["x", "value"])
    assert got.loc[("C", "x"), "value"] == 0 and got.loc[("C", "Intercept"), "value"] == pytest.approx(np.log(40.5 / 0.5))
    stopped = models.ridge_logistic_fits(_states(spark, O=ordinary), ["x"], ["y"], most=1)
    assert {r.status for r in stopped.collect()} == {models.STOPPED}
    assert models.ridge_logistic(_states(spark, O=[]), ["x"], ["y"]).count() == 0


def test_snapshot_and_empty_rerun(spark, tmp_path):
    from hammerline.operators import publish
    one, two = spark.createDataFrame([(1,)], "v int"), spark.createDataFrame([(2,), (3,)], "v int")
    publish.replace_current(one, f"{tmp_path}/now")
    held = publish.read_current(spark, f"{tmp_path}/now")
    publish.replace_current(two, f"{tmp_path}/now")
    assert [r.v for r in held.collect()] == [1] and sorted(r.v for r in publish.read_current(spark, f"{tmp_path}/now").collect()) == [2, 3]
    publish.append_history(two, f"{tmp_path}/all", 1)
    publish.append_history(one, f"{tmp_path}/all", 2)
    publish.append_history(two.limit(0), f"{tmp_path}/all", 2)
    assert sorted(r.v for r in publish.read_history(spark, f"{tmp_path}/all").collect()) == [2, 3]


def test_workspace_leaves_nothing(spark, tmp_path):
    import os
    from hammerline.session import settle, workspace
    with workspace(spark) as folder:
        settle(spark.range(5)).write.parquet(f"{tmp_path}/kept")
        assert len(os.listdir(folder.removeprefix("file:"))) == 1
    assert not os.path.exists(folder.removeprefix("file:")) and spark.read.parquet(f"{tmp_path}/kept").count() == 5
