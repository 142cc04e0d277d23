"""The same results as plain DuckDB SQL, written from the business rules.

Each entry of ``CTES`` is one SELECT that may read test tables, warehouse roles and earlier entries;
``oracle_query`` gathers what a result needs into a single WITH statement.
"""

from __future__ import annotations

from checks.roles import BASE, ROLES, mentions, role_sql
from checks import terms as tt
from hammerline.functions.scoring import NONTRUSTEE_MODELS, SALE_TERMS, TRUSTEE_MODELS, VALUATION_MODEL
from hammerline.operators.publish import UNIFIED

AS_OF = "DATE '2001-05-15'"
FIVE_BACK = "DATE '2000-12-15'"
THREE_BACK = "DATE '2001-02-15'"
START = "DATE '2000-01-01'"
HOLDOUT = "DATE '2001-04-15'"
HORIZON = "DATE '2001-01-15'"
KEY = "PropertyId, AuctionId, VenueId"

CTES: dict[str, str] = {}

# ---- windows and histories ------------------------------------------------------------------
CTES["real_auction"] = "SELECT * FROM dim_auction WHERE IsTest = 0 AND IsDemo = 0"
CTES["recent"] = f"""
  SELECT f.*, a.SystemAuctionId, a.AuctionCode, CAST(date_trunc('month', f.AuctionDate) AS DATE) AS MarketMonth,
         CAST(year(f.AuctionDate) * 100 + month(f.AuctionDate) AS INTEGER) AS PostalMonth
  FROM fact_auction f JOIN real_auction a ON f.AuctionId = a.AuctionId WHERE f.AuctionDate >= {FIVE_BACK}"""
CTES["recent_upcoming"] = f"SELECT * FROM recent WHERE AuctionDate >= {AS_OF}"
CTES["live"] = """
  SELECT r.* FROM recent r JOIN dim_auction_status s ON r.AuctionStatusId = s.AuctionStatusId
  WHERE s.AuctionStatus NOT ILIKE '%Removed%' AND s.AuctionStatus NOT ILIKE '%Cancelled%'"""
CTES["zip_rate"] = """
  SELECT d.PropertyState, d.PropertyZip, avg(CAST(l.IsSold AS DOUBLE)) AS AvgSTR, count(l.IsAuctioned) AS TotalAuctioned
  FROM live l LEFT JOIN dim_property d ON l.PropertyId = d.PropertyId
  GROUP BY 1, 2 HAVING count(l.IsAuctioned) >= 10"""
CTES["line_property"] = """
  SELECT * FROM dim_property WHERE ProductType ILIKE '%REO%' OR ProductType ILIKE '%C2C%' OR ProductType ILIKE 'Short Sale'"""
CTES["zip_rate_scoring"] = f"""
  SELECT d.PropertyState, d.PropertyZip, avg(CAST(l.IsSold AS DOUBLE)) AS AvgSTR, count(l.IsAuctioned) AS TotalAuctioned
  FROM live l JOIN line_property d ON l.PropertyId = d.PropertyId WHERE l.AuctionDate <= {AS_OF}
  GROUP BY 1, 2 HAVING count(l.IsAuctioned) >= 10"""
CTES["seller_rate"] = """
  SELECT s.SellerCode, avg(CAST(l.IsSold AS DOUBLE)) AS AvgSTR, count(l.IsAuctioned) AS TotalAuctioned
  FROM live l LEFT JOIN dim_seller s ON l.SellerId = s.SellerId GROUP BY 1 HAVING count(l.IsAuctioned) >= 10"""
CTES["seller_rate_scoring"] = f"""
  SELECT s.SellerCode, avg(CAST(l.IsSold AS DOUBLE)) AS AvgSTR, count(l.IsAuctioned) AS TotalAuctioned
  FROM live l JOIN line_property d ON l.PropertyId = d.PropertyId LEFT JOIN dim_seller s ON l.SellerId = s.SellerId
  WHERE l.AuctionDate <= {AS_OF} GROUP BY 1 HAVING count(l.IsAuctioned) >= 10"""
CTES["recent_trustee"] = f"""
  SELECT f.*, a.SystemAuctionId, a.AuctionCode, CAST(date_trunc('month', f.AuctionDate) AS DATE) AS MarketMonth,
         CAST(year(f.AuctionDate) * 100 + month(f.AuctionDate) AS INTEGER) AS PostalMonth
  FROM fact_trustee_auction f JOIN real_auction a ON f.AuctionId = a.AuctionId WHERE f.AuctionDate >= {FIVE_BACK}"""
CTES["trustee_zip_rate"] = """
  SELECT d.PropertyState, d.PropertyZip, avg(CAST(l.IsSold AS DOUBLE)) AS AvgSTR, count(l.IsAuction) AS TotalAuctioned
  FROM recent_trustee l LEFT JOIN dim_property d ON l.PropertyId = d.PropertyId
  WHERE l.IsAuction = 1 GROUP BY 1, 2 HAVING count(l.IsAuction) >= 5"""
CTES["trustee_rate"] = """
  SELECT t.TrusteeCode, avg(CAST(l.IsSold AS DOUBLE)) AS AvgSTR, count(l.IsAuction) AS TotalAuctioned
  FROM recent_trustee l LEFT JOIN dim_trustee t ON l.TrusteeId = t.TrusteeId
  WHERE l.IsAuction = 1 GROUP BY 1 HAVING count(l.IsAuction) >= 5"""
_HELD = f"SELECT * FROM recent_trustee WHERE AuctionDate <= {AS_OF}"
CTES["held_trustee"] = _HELD
for _n in ("trustee_zip_rate", "trustee_rate"):
    CTES[f"{_n}_scoring"] = CTES[_n].replace("recent_trustee", "held_trustee")
_BIDS = """
  SELECT PropertyId, VenueId, AuctionId, max(BidAmount) AS HighBid, max(WinningBid) AS WinningBid,
         count(DISTINCT BidderId) AS Bidders, count(DISTINCT BidAmount) AS Bids
  FROM fact_bid_live WHERE {} GROUP BY 1, 2, 3"""
CTES["high_bid"] = _BIDS.format(f"BidStartDate >= {FIVE_BACK} AND BidderId <> -1")
CTES["high_bid_scoring"] = _BIDS.format(f"AuctionDate >= {THREE_BACK} AND IsSellerAutoBid = 0")
CTES["fav_property"] = "SELECT PropertyId, count(DISTINCT UserId) AS Favorites FROM fact_property_favorites GROUP BY 1"
CTES["fav_listing"] = """
  SELECT PropertyId, AuctionId, count(DISTINCT UserId) AS Favorites FROM fact_property_favorites GROUP BY 1, 2"""
CTES["outcome_history"] = """
  SELECT PropertyId, sum(IsAuction) + sum(IsRemoved) + sum(IsCancelled) + sum(IsPostponed) AS RunNum,
         sum(IsRemoved) AS Removals, sum(IsCancelled) AS Cancellations, sum(IsPostponed) AS Postponements
  FROM fact_trustee_auction GROUP BY 1"""

# ---- bidders --------------------------------------------------------------------------------
_HISTORY = """
  SELECT b.bidderemail, f.PropertyId, f.AuctionId, f.VenueId, d.PropertyCounty, {dated}
         max(f.BidAmount) AS MaxBid, max(f.WinningBid) AS WinningBid, max(f.IsWinningBid) AS Winner,
         max(f.StartingBid) AS StartingBid, max(f.AuctionSellerReserve) AS Reserve, max(d.Bedrooms) AS beds,
         max(d.Baths) AS baths, max(d.LotSize) AS lotsize, max(d.YearBuilt) AS yearbuilt, max(r.BPO) AS BPO, max(d.PropertyZip) AS ZIP
  FROM fact_bid_live f JOIN fact_residential r ON f.PropertyId = r.PropertyId AND f.AuctionId = r.AuctionId AND f.VenueId = r.VenueId
  JOIN dim_property d ON f.PropertyId = d.PropertyId JOIN dim_bidder b ON f.BidderId = b.BidderId
  WHERE f.AuctionDate >= {start} AND f.BidderId > 0 AND f.PropertyId > 0 AND f.AuctionId > 0
  GROUP BY ALL"""
CTES["bid_history"] = _HISTORY.format(dated="", start=START)
CTES["bid_history_dated"] = _HISTORY.format(dated="f.AuctionDate,", start=START)
def _exact_means(sql: str) -> str:
    """``mean(x)`` as a sum of whole multiples of 2**-70, which is the same in every order of rows."""
    unit, out, at = 2**70, "", 0
    while (found := sql.find("mean(", at)) >= 0:
        end, depth = found + 5, 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        x = f"CAST(({sql[found + 5:end - 1]}) AS DOUBLE)"
        out += sql[at:found] + f"(CAST(sum(CAST({x} * {unit}.0e0 AS HUGEINT)) AS DOUBLE) / {unit}.0e0 / count({x}))"
        at = end
    return out + sql[at:]


_BUDGET = _exact_means("""
  SELECT bidderemail, count(DISTINCT PropertyId) AS AssetsBidUpon, mean(MaxBid) AS AvgMaxBid, mean(Winner) AS AvgWinRate,
         mean(CASE WHEN MaxBid > WinningBid THEN 1.0 ELSE 0.0 END) AS FallOutRate,
         mean(MaxBid / nullif(CASE WHEN Reserve < 1 THEN coalesce(MaxBid, StartingBid) ELSE Reserve END, 0)) AS AvgMaxBidAsShareOfReserve,
         mean(StartingBid) AS AvgStartingBid, mean(Reserve) AS AvgReserve,
         mean(CASE WHEN beds >= 0 THEN beds END) AS avgBeds, mean(CASE WHEN baths >= 0 THEN baths END) AS avgBaths,
         mean(CASE WHEN lotsize >= 0 THEN lotsize END) AS avgLotSize,
         mean(CASE WHEN yearbuilt > 1500 THEN yearbuilt END) AS AvgYearBuilt, mean(BPO) AS AvgBPO
  FROM {} GROUP BY 1""")
CTES["budget"] = _BUDGET.format("bid_history")
CTES["budget_dated"] = _BUDGET.format("bid_history_dated")
CTES["attendance_rate"] = f"""
  SELECT a.bidderemail, b.totalattended, a.totalregistrations, b.totalattended * 1.0e0 / a.totalregistrations AS attendance
  FROM (SELECT bidderemail, count(DISTINCT r.PropertyId) AS totalregistrations
        FROM dim_bidder d JOIN fact_property_registration r ON d.BidderId = r.BidderId WHERE r.CreateDate >= {START} GROUP BY 1) a,
       (SELECT bidderemail, count(DISTINCT f.PropertyId) AS totalattended
        FROM dim_bidder d JOIN fact_bid_live f ON d.BidderId = f.BidderId
        WHERE f.AuctionDate >= {START} AND f.BidderId > 0 AND f.PropertyId > 0 AND f.AuctionId > 0 GROUP BY 1) b
  WHERE a.bidderemail = b.bidderemail"""
_MATCH = """
  SELECT PropertyId, AuctionId, VenueId, bidderemail, raw AS Reserve, AvgReserve / nullif(base, 0) AS ReserveMatch,
         (CASE WHEN Bedrooms <= 0 THEN avgBeds ELSE Bedrooms END)
           / nullif(CASE WHEN avgBeds <= 0 THEN (CASE WHEN Bedrooms <= 0 THEN 1 ELSE Bedrooms END) ELSE avgBeds END, 0) AS Bedmatch,
         (CASE WHEN Baths <= 0 THEN avgBaths ELSE Baths END)
           / nullif(CASE WHEN avgBaths < 1 THEN (CASE WHEN Baths <= 0 THEN 1 ELSE Baths END) ELSE avgBaths END, 0) AS Bathmatch,
         (CASE WHEN LotSize <= 0 THEN avgLotSize ELSE LotSize END)
           / nullif(CASE WHEN avgLotSize <= 0 THEN (CASE WHEN LotSize <= 0 THEN 1 ELSE LotSize END) ELSE avgLotSize END, 0) AS Lotmatch,
         attendance * AvgMaxBidAsShareOfReserve AS NaturalScore,
         attendance * AvgMaxBidAsShareOfReserve * abs(coalesce(AvgReserve, 1) / nullif(base + 1, 0)) AS BidderScore
  FROM (SELECT r.PropertyId, r.AuctionId, r.VenueId, d.bidderemail, h.Bedrooms, h.Baths, h.LotSize, a.*, t.attendance,
               coalesce(f.AuctionSellerReserve, f.Reserve, f.LenderReserve, f.UpdatedReserve, AvgReserve, 1) AS raw, {base} AS base
        FROM fact_property_registration r JOIN dim_bidder d ON r.BidderId = d.BidderId JOIN dim_property h ON r.PropertyId = h.PropertyId
        JOIN {budget} a ON d.bidderemail = a.bidderemail JOIN attendance_rate t ON d.bidderemail = t.bidderemail
        LEFT JOIN fact_auction f ON r.PropertyId = f.PropertyId AND r.AuctionId = f.AuctionId AND r.VenueId = f.VenueId
        WHERE r.VenueId IS NOT NULL AND r.ApprovalBucket IN
          ('Fully Approved', 'Fully Approved, IDO', 'Needs Review - Approved w/o Validated Funds')) x"""
_ABOVE0 = """coalesce(CASE WHEN f.AuctionSellerReserve > 0 THEN f.AuctionSellerReserve END, CASE WHEN f.Reserve > 0 THEN f.Reserve END,
  CASE WHEN f.LenderReserve > 0 THEN f.LenderReserve END, CASE WHEN f.UpdatedReserve > 0 THEN f.UpdatedReserve END,
  CASE WHEN AvgReserve > 0 THEN AvgReserve END, 1)"""
_RAW = "coalesce(f.AuctionSellerReserve, f.Reserve, f.LenderReserve, f.UpdatedReserve, AvgReserve, 1)"
CTES["reg_match_scoring"] = _MATCH.format(base=_ABOVE0, budget="budget").replace("a.*", "a.* EXCLUDE (bidderemail)")
CTES["reg_match"] = _MATCH.format(base=_RAW, budget="budget_dated").replace("a.*", "a.* EXCLUDE (bidderemail)")
for _n in ("", "_scoring"):
    CTES[f"reg_score{_n}"] = f"""
  SELECT PropertyId, VenueId, AuctionId, count(DISTINCT bidderemail) AS ALRRegistrants,
         sum(NaturalScore) AS IntrinsicBidderQuality, sum(BidderScore) AS TotalRegistrantScore
  FROM reg_match{_n} GROUP BY 1, 2, 3"""

# ---- feature rows ---------------------------------------------------------------------------
CTES["prop_flags"] = """
  SELECT *,
    CASE WHEN PropertyType ILIKE 'SF%' OR PropertyType ILIKE 'Single%' OR PropertyType ILIKE '%Town%' THEN 1 ELSE 0 END AS SFR_Flag,
    CASE WHEN PropertyType ILIKE '%Condo%' OR PropertyType ILIKE '%plex%' THEN 1 ELSE 0 END AS MultiResidence_Flag,
    CASE WHEN ProductType ILIKE '%C2C%' THEN 1 ELSE 0 END AS C2C_Flag, CASE WHEN ProductType ILIKE '%REO%' THEN 1 ELSE 0 END AS REO_Flag,
    CASE WHEN ProductType ILIKE '%Short Sale%' THEN 1 ELSE 0 END AS ShortSale_Flag,
    CASE WHEN ProductType ILIKE '%Trustee%' THEN 1 ELSE 0 END AS Trustee_Flag,
    CASE WHEN lower(Condition) = 'poor' THEN 1 ELSE 0 END AS Condition_poor, CASE WHEN lower(Condition) = 'fair' THEN 1 ELSE 0 END AS Condition_fair,
    CASE WHEN lower(Condition) = 'average' THEN 1 ELSE 0 END AS Condition_average,
    CASE WHEN lower(Condition) IN ('good', 'excellent') THEN 1 ELSE 0 END AS Condition_good,
    CASE WHEN lower(Condition) IN ('', 'n/a') THEN 1 ELSE 0 END AS Condition_unknown,
    CASE WHEN lower(PropertyOccupancyStatus) = 'occupied' THEN 1 ELSE 0 END AS PropertyOccupancyStatus_Occupied,
    CASE WHEN lower(PropertyOccupancyStatus) IN ('', 'n/a') THEN 1 ELSE 0 END AS PropertyOccupancyStatus_Unknown,
    CASE WHEN lower(PropertyOccupancyStatus) = 'vacant' THEN 1 ELSE 0 END AS PropertyOccupancyStatus_Vacant
  FROM dim_property"""
_LEVELS = ", ".join(
    f"coalesce({z}, County{w}, State{w}, National{w}) AS {out}" for out, z, w in (
        ("Appreciation", "Appreciation", "Appreciation"), ("Turnover", "Turnover", "Turnover"),
        ("TotalHomesForSale", "TotalHomesForSale", "TotalHomesForSale"),
        ("PercentHomesSold", "PercentHomesSold_12moTrailing", "PercentHomesSold_12moTrailing"),
        ("MedianPPSQFT", "MedianPPSQFT", "MedianPPSQFT"), ("ForeclosedPer10000", "ForeclosedHomesPer10000", "ForeclosedHomesPer10000"),
        ("PrevForeclosureSoldRate", "PercentSoldHomesPrevForeclosures_12moTrailing", "PrevForeclosureSold")))
CTES["market_level"] = f"SELECT PropertyZip, Date AS MarketMonth, {_LEVELS} FROM market_metrics"
CTES["listing_market"] = """
  SELECT l.PropertyId, l.AuctionId, l.VenueId, m.* EXCLUDE (PropertyZip, MarketMonth), u.Active AS TotalActive, u.Vacancy
  FROM live l JOIN dim_property d ON l.PropertyId = d.PropertyId
  LEFT JOIN market_level m ON d.PropertyZip = m.PropertyZip AND l.MarketMonth = m.MarketMonth
  LEFT JOIN postal_vacancy u ON d.PropertyZip = u.ZIP AND l.PostalMonth = u.Date"""
_POS = ", ".join(f"CASE WHEN {c} > 0 THEN {c} END" for c in (
    "fa.AuctionSellerReserve", "fr.AuctionSellerReserve", "fa.Reserve", "fa.LenderReserve", "fa.UpdatedReserve"))
_RES = "coalesce(fa.AuctionSellerReserve, fr.AuctionSellerReserve, fa.Reserve, fa.LenderReserve, fa.UpdatedReserve)"
_BPO = f"""coalesce(CASE WHEN dp.ProductType ILIKE '%C2C%' THEN coalesce(fa.AprAsIs, fr.AprAsIs) END,
    CASE WHEN ds.SellerParent = 'Bank of America' THEN coalesce(fa.TotalOwed, fa.PropertyFeature6, fa.SellerBPOValue, dp.SellerBPOValue) END,
    fr.BPO, fa.Agent90AsIs, fa.AgentValue, fa.PropertyFeature6, fa.GrcValue,
    CASE WHEN fa.AprAsIs > 4 * {_RES} AND fa.AprAsIs > 10000000 THEN NULL ELSE fa.AprAsIs END,
    CASE WHEN dp.SellerBPOValue IS NULL OR dp.SellerBPOValue < 10 THEN NULL ELSE dp.SellerBPOValue END)"""
_FEATURE = """
  SELECT x.*, (HighBid >= Reserve AND HighBid IS NOT NULL AND Reserve IS NOT NULL)::INTEGER AS AuctionReserveSuccess,
         CASE WHEN HighBid >= Reserve OR (IsSold = 1 AND IsSubjectToApproval = 1 AND SubjToAccepted = 1) THEN 1 ELSE 0 END AS TrueSold,
         MedianPPSQFT - Reserve / (CASE WHEN HomeSquareFootage > 10 THEN HomeSquareFootage END) AS MedianPPSQFTDeviation,
         CASE WHEN tile = 1 THEN 1 ELSE 0 END AS ValueLevel_Low, CASE WHEN tile = 2 THEN 1 ELSE 0 END AS ValueLevel_Med,
         CASE WHEN tile = 3 THEN 1 ELSE 0 END AS ValueLevel_High
  FROM (
    SELECT y.*, ntile(3) OVER (PARTITION BY PropertyState ORDER BY Reserve NULLS FIRST, PropertyId, AuctionId, VenueId) AS tile,
           count(AuctionCode) OVER (PARTITION BY AuctionCode) AS EventSize,
           count(AuctionCode) OVER (PARTITION BY AuctionCode, PropertyState) AS StateEventSize
    FROM (
      SELECT dp.GlobalPropertyId, fa.SystemAuctionId, fa.VenueId, fa.AuctionId, fa.PropertyId, fa.REDCID, dp.LoanNbr, dp.PropertyState,
             dp.PropertyZip, dp.PropertyCounty, dp.PropertyCity, dg.MSAName, fa.AuctionCode, ds.SellerCode, ds.SellerName,
             dg.Latitude, dg.Longitude, fa.{date}, dp.PropertyOccupancyStatus,
             CASE WHEN lower(dp.Condition) IN ('', 'n/a'){nullcond} THEN 'unknown' ELSE dp.Condition END AS Condition,
             dp.PropertyType, dp.ProductType, dp.SFR_Flag, dp.MultiResidence_Flag, dp.C2C_Flag, dp.REO_Flag, dp.ShortSale_Flag, dp.Trustee_Flag,
             dp.Condition_poor, dp.Condition_fair, dp.Condition_average, dp.Condition_good, dp.Condition_unknown,
             dp.PropertyOccupancyStatus_Occupied, dp.PropertyOccupancyStatus_Unknown, dp.PropertyOccupancyStatus_Vacant,
             CASE WHEN lower(pas.FinancingAvailable) IN ('203k', 'yes') THEN 1 ELSE 0 END AS FinancingAvailable,
             CASE WHEN sg.DeedType = 'Full Warranty' THEN 1 ELSE 0 END AS FullWarrantyDeed,
             CASE WHEN sg.DeedType = 'Special Warranty' THEN 1 ELSE 0 END AS SpecialWarrantyDeed,
             CASE WHEN sg.DeedType = 'Quit Claim' THEN 1 ELSE 0 END AS QuitClaimDeed,
             fa.IsSold, fa.RunNum, CAST(sign(fa.RunNum - 1) AS INTEGER) AS HasPrevAttempts, {res} AS Reserve, {bpo} AS BPO,
             {bpo} - coalesce({pos}) AS BPOSurplus, {bpo} / coalesce({pos}) - 1 AS BPOSurplusPct,
             dp.HomeSquareFootage, dp.Bedrooms, dp.Baths, 2013 - dp.YearBuilt AS Age, dp.LotSize, fa.StartingBid, fr.IsSubjectToApproval,
             fa.SubjToAccepted, hb.HighBid, coalesce(rs.ALRRegistrants, 0) AS ALRRegistrants,
             coalesce(rs.TotalRegistrantScore, 0) AS TotalRegistrantScore, coalesce(rs.IntrinsicBidderQuality, 0) AS IntrinsicBidderQuality,
             {fav} AS Favorites, m.Appreciation, m.Turnover, m.TotalHomesForSale, m.PercentHomesSold, m.MedianPPSQFT, m.ForeclosedPer10000,
             m.PrevForeclosureSoldRate, u.Active AS TotalActive, u.Vacancy,
             coalesce(zr.AvgSTR, 0) AS Historical_Execution, coalesce(sr.AvgSTR, 0) AS SellerPortfolioQuality
      FROM live fa LEFT JOIN prop_flags dp ON dp.PropertyId = fa.PropertyId
      LEFT JOIN fact_residential fr ON fr.PropertyId = fa.PropertyId AND fr.AuctionId = fa.AuctionId AND fr.VenueId = fa.VenueId
      LEFT JOIN dim_venue dv ON dv.VenueId = fa.VenueId
      LEFT JOIN dim_pre_auction_status pas ON pas.PreAuctionStatusId = fr.PreAuctionStatusId
      LEFT JOIN dim_geo dg ON dg.GeoId = fr.NewGeoId LEFT JOIN dim_seller ds ON ds.SellerId = fr.SellerId
      LEFT JOIN dim_seller_group sg ON ds.SellerCode = sg.SellerCode
      LEFT JOIN {favtab} fv ON fv.PropertyId = fa.PropertyId {favon}
      LEFT JOIN reg_score{suffix} rs ON rs.PropertyId = fa.PropertyId AND rs.AuctionId = fa.AuctionId AND rs.VenueId = fa.VenueId
      LEFT JOIN high_bid{suffix} hb ON hb.PropertyId = fa.PropertyId AND hb.AuctionId = fa.AuctionId AND hb.VenueId = fa.VenueId
      LEFT JOIN market_level m ON m.PropertyZip = dp.PropertyZip AND m.MarketMonth = fa.MarketMonth
      LEFT JOIN postal_vacancy u ON u.ZIP = dp.PropertyZip AND u.Date = fa.PostalMonth
      LEFT JOIN zip_rate{suffix} zr ON zr.PropertyZip = dp.PropertyZip AND zr.PropertyState = dp.PropertyState
      LEFT JOIN seller_rate{suffix} sr ON sr.SellerCode = ds.SellerCode
      WHERE {keep}) y) x"""
CTES["feature"] = _FEATURE.format(
    date="AuctionDate", nullcond="", res=_RES, bpo=_BPO, pos=_POS, favtab="fav_property", favon="", suffix="",
    fav="coalesce(fv.Favorites, 0) // (CASE WHEN fa.RunNum < 1 THEN 1 ELSE fa.RunNum END)", keep="dv.AuctionDate IS NOT NULL")
CTES["feature_scoring"] = _FEATURE.format(
    date="BidEndDT", nullcond=" OR dp.Condition IS NULL", res=_RES, bpo=_BPO, pos=_POS, favtab="fav_listing",
    favon="AND fv.AuctionId = fa.AuctionId", suffix="_scoring", fav="coalesce(fv.Favorites, 0)", keep=f"fa.AuctionDate >= {AS_OF}")

_TRES = """coalesce(fa.AuctionSellerReserve, fa.MaximumCreditBidAmnt, fa.BeneficiaryAmount,
    CASE WHEN fa.CreditBidType = 'Total Debt' THEN fa.TotalEstDebtorNOSAmount END, fa.TotalEstDebtorNOSAmount)"""
_TVAL = "CASE WHEN coalesce(fa.BPO, fa.InitialAVMValue, fa.IVG) < 10 THEN NULL ELSE coalesce(fa.BPO, fa.InitialAVMValue, fa.IVG) END"
_TFEATURE = """
  SELECT x.*, MedianPPSQFT - Reserve / nullif(CASE WHEN HomeSquareFootage < 10 THEN state_feet ELSE HomeSquareFootage END, 0) AS MedianPPSQFTDeviation,
         CASE WHEN tile = 1 THEN 1 ELSE 0 END AS ValueLevel_Low, CASE WHEN tile = 2 THEN 1 ELSE 0 END AS ValueLevel_Med,
         CASE WHEN tile = 3 THEN 1 ELSE 0 END AS ValueLevel_High
  FROM (
    SELECT y.*, ntile(3) OVER (PARTITION BY PropertyState ORDER BY Reserve NULLS FIRST, PropertyId, AuctionId, VenueId) AS tile,
           count(AuctionCode) OVER (PARTITION BY AuctionCode) AS EventSize, avg(HomeSquareFootage) OVER (PARTITION BY PropertyState) AS state_feet,
           count(AuctionCode) OVER (PARTITION BY AuctionCode, PropertyState) AS StateEventSize
    FROM (
      SELECT dp.GlobalPropertyId, fa.SystemAuctionId, fa.VenueId, fa.AuctionId, fa.PropertyId, fa.REDCID, dp.LoanNbr, dp.PropertyState,
             dp.PropertyZip, dp.PropertyCounty, dp.PropertyCity, dg.MetroArea AS MSAName, fa.AuctionCode, dt.TrusteeCode, dt.TrusteeName,
             dg.Latitude, dg.Longitude, fa.AuctionDate, dp.PropertyOccupancyStatus,
             CASE WHEN lower(dp.Condition) IN ('', 'n/a') THEN 'unknown' ELSE dp.Condition END AS Condition,
             dp.PropertyType, dp.ProductType, dp.SFR_Flag, dp.MultiResidence_Flag, dp.C2C_Flag, dp.REO_Flag, dp.ShortSale_Flag, dp.Trustee_Flag,
             dp.Condition_poor, dp.Condition_fair, dp.Condition_average, dp.Condition_good, dp.Condition_unknown,
             dp.PropertyOccupancyStatus_Occupied, dp.PropertyOccupancyStatus_Unknown, dp.PropertyOccupancyStatus_Vacant,
             fa.IsSold, CASE WHEN coalesce(fa.WinningBid, fa.HighBidAmt) >= {res} THEN 1 ELSE 0 END AS AuctionReserveSuccess,
             fa.HighBidAmt AS HighBid, fa.WinningBid, h.RunNum, h.Removals, h.Cancellations, h.Postponements,
             CAST(sign(h.RunNum + h.Cancellations + h.Postponements - 1) AS INTEGER) AS HasPrevAttempts,
             {res} AS Reserve, {val} AS BPO, {val} - {res} AS BPOSurplus, {val} / nullif({val}, 0) - 1 AS BPOSurplusPct,
             dp.HomeSquareFootage, dp.Bedrooms, dp.Baths, 2013 - dp.YearBuilt AS Age, dp.LotSize, fa.OpeningBid,
             {fav} AS Favorites, m.Appreciation, m.Turnover, m.TotalHomesForSale, m.PercentHomesSold, m.MedianPPSQFT, m.ForeclosedPer10000,
             m.PrevForeclosureSoldRate, u.Active AS TotalActive, u.Vacancy,
             coalesce(zr.AvgSTR, 0) AS Historical_Execution, coalesce(tr.AvgSTR, 0) AS SellerPortfolioQuality,
             fa.IsAuction, fa.IsRemoved, fa.IsCancelled, fa.IsPostponed
      FROM recent_trustee fa LEFT JOIN prop_flags dp ON dp.PropertyId = fa.PropertyId
      LEFT JOIN dim_geo dg ON dg.GeoId = fa.GeoId LEFT JOIN dim_trustee dt ON dt.TrusteeId = fa.TrusteeId
      LEFT JOIN {favtab} fv ON fv.PropertyId = fa.PropertyId {favon}
      LEFT JOIN market_level m ON m.PropertyZip = dp.PropertyZip AND m.MarketMonth = fa.MarketMonth
      LEFT JOIN postal_vacancy u ON u.ZIP = dp.PropertyZip AND u.Date = fa.PostalMonth
      LEFT JOIN trustee_zip_rate{suffix} zr ON zr.PropertyZip = dp.PropertyZip AND zr.PropertyState = dp.PropertyState
      LEFT JOIN trustee_rate{suffix} tr ON tr.TrusteeCode = dt.TrusteeCode
      LEFT JOIN outcome_history h ON h.PropertyId = fa.PropertyId {keep}) y) x"""
CTES["feature_trustee"] = _TFEATURE.format(
    res=_TRES, val=f"({_TVAL})", favtab="fav_property", favon="", suffix="", keep="",
    fav="coalesce(fv.Favorites, 0) // (CASE WHEN h.RunNum = 0 OR h.RunNum IS NULL THEN 1 ELSE h.RunNum END)")
CTES["feature_trustee_scoring"] = _TFEATURE.format(
    res=_TRES, val=f"({_TVAL})", favtab="fav_listing", favon="AND fv.AuctionId = fa.AuctionId", suffix="_scoring",
    keep=f"WHERE fa.AuctionDate >= {AS_OF}", fav="coalesce(fv.Favorites, 0)")


# ---- single rules ---------------------------------------------------------------------------
CTES["sane_valuation"] = """
  SELECT * EXCLUDE (BPO), CASE WHEN BPOSurplusPct >= 5 OR BPOSurplusPct < -0.9 THEN NULL ELSE BPO END AS BPO FROM feature"""
CTES["outcome"] = "SELECT * EXCLUDE (IsSubjectToApproval), coalesce(IsSubjectToApproval, 0) AS IsSubjectToApproval FROM feature"
CTES["priced"] = """
  SELECT f.PropertyId, f.AuctionId, f.VenueId, f.Reserve, d.PropertyState, a.AuctionCode FROM fact_auction f
  LEFT JOIN dim_property d ON f.PropertyId = d.PropertyId LEFT JOIN dim_auction a ON f.AuctionId = a.AuctionId"""
CTES["tercile"] = f"""
  SELECT *, CASE WHEN t = 1 THEN 1 ELSE 0 END AS ValueLevel_Low, CASE WHEN t = 2 THEN 1 ELSE 0 END AS ValueLevel_Med,
         CASE WHEN t = 3 THEN 1 ELSE 0 END AS ValueLevel_High, CASE t WHEN 1 THEN 'Low' WHEN 2 THEN 'Med' ELSE 'High' END AS ValueLevel
  FROM (SELECT *, ntile(3) OVER (PARTITION BY PropertyState ORDER BY Reserve NULLS FIRST, {KEY}) AS t FROM priced) q"""
CTES["event_size"] = """
  SELECT *, count(AuctionCode) OVER (PARTITION BY AuctionCode) AS EventSize,
         count(AuctionCode) OVER (PARTITION BY AuctionCode, PropertyState) AS StateEventSize FROM priced"""

# ---- imputation -----------------------------------------------------------------------------
_F = ("Turnover", "Appreciation", "MedianPPSQFT", "MedianPPSQFTDeviation", "ForeclosedPer10000", "PrevForeclosureSoldRate", "PercentHomesSold")
_GAP = "(PropertyId % 7 = 0 OR PropertyCounty IN ('NATION_3', 'NATION_12') OR PropertyState = 'EUROPE')"
_GAPPED = [m for m in _F if m != "MedianPPSQFTDeviation"]
CTES["gappy"] = f"""
  SELECT * EXCLUDE ({', '.join(_GAPPED)}, TotalHomesForSale), {', '.join(f'CASE WHEN {_GAP} THEN NULL ELSE {m} END AS {m}' for m in _GAPPED)},
         CASE WHEN PropertyId % 5 = 0 THEN NULL ELSE TotalHomesForSale END AS TotalHomesForSale FROM feature"""
CTES["filled"] = f"""
  SELECT g.* EXCLUDE ({', '.join(_F)}),
    {', '.join(f"""CASE WHEN g.Turnover IS NOT NULL THEN g.{m} WHEN c.Turnover IS NOT NULL THEN c.{m}
      WHEN s.Turnover IS NOT NULL THEN s.{m} ELSE n.{m} END AS {m}""" for m in _F)}
  FROM gappy g
  LEFT JOIN (SELECT PropertyState, PropertyCounty, {', '.join(f'avg({m}) AS {m}' for m in _F)} FROM gappy GROUP BY 1, 2) c
    ON g.PropertyState = c.PropertyState AND g.PropertyCounty = c.PropertyCounty
  LEFT JOIN (SELECT PropertyState, {', '.join(f'avg({m}) AS {m}' for m in _F)} FROM gappy GROUP BY 1) s ON g.PropertyState = s.PropertyState
  CROSS JOIN (SELECT {', '.join(f'median({m}) AS {m}' for m in _F)} FROM gappy) n"""
CTES["repaired"] = """
  SELECT f.PropertyId, f.AuctionId, f.VenueId, CASE WHEN Age > 200 THEN mAge ELSE Age END AS Age, coalesce(LotSize, 0.1) AS LotSize,
         CASE WHEN Bedrooms < 0 OR Bedrooms IS NULL THEN mBed ELSE Bedrooms END AS Bedrooms, CASE WHEN Baths < 0 THEN mBath ELSE Baths END AS Baths,
         CASE WHEN HomeSquareFootage < 100 OR HomeSquareFootage IS NULL THEN mFeet ELSE HomeSquareFootage END AS HomeSquareFootage,
         ceil(Favorites * 1.0e0 / nullif(RunNum, 0)) AS Favorites, coalesce(TotalActive, mAct) AS TotalActive, coalesce(Vacancy, mVac) AS Vacancy
  FROM feature f LEFT JOIN (
    SELECT PropertyState, median(CASE WHEN Age < 200 THEN Age END) AS mAge, median(CASE WHEN Bedrooms > 0 THEN Bedrooms END) AS mBed,
           median(CASE WHEN Baths > 0 THEN Baths END) AS mBath, avg(CASE WHEN HomeSquareFootage >= 100 THEN HomeSquareFootage END) AS mFeet,
           median(TotalActive) AS mAct, median(Vacancy) AS mVac FROM feature GROUP BY 1) s ON f.PropertyState = s.PropertyState"""
CTES["repaired_trustee"] = CTES["repaired"].replace("FROM feature", "FROM feature_trustee").replace(
    "coalesce(TotalActive, mAct)", "coalesce(TotalActive, mAct, nAct)").replace("coalesce(Vacancy, mVac)", "coalesce(Vacancy, mVac, nVac)") + """
  CROSS JOIN (SELECT median(TotalActive) AS nAct, median(Vacancy) AS nVac FROM feature_trustee) n"""
_ABSURD = "CASE WHEN BPOSurplusPct >= 5 OR BPOSurplusPct < -0.9 THEN NULL ELSE BPO END"
for _t, _who in (("", "SellerName"), ("_trustee", "TrusteeName")):
    CTES[f"cleaned{_t}"] = f"""
  SELECT * EXCLUDE (BPO, {_who}, PropertyCity), {_ABSURD} AS BPO, replace({_who}, ',', '') AS {_who}, replace(PropertyCity, ',', '') AS PropertyCity
  FROM feature{_t} WHERE AuctionDate >= {HORIZON} AND Reserve IS NOT NULL"""
    CTES[f"filled_cleaned{_t}"] = CTES["filled"].replace("gappy", f"cleaned{_t}")
CTES["prepared"] = """
  SELECT * EXCLUDE (IsSubjectToApproval, BPOSurplus), coalesce(IsSubjectToApproval, 0) AS IsSubjectToApproval, BPO - Reserve AS BPOSurplus,
         CASE WHEN BPO IS NULL THEN 1 ELSE 0 END AS IsPredictedBPO, 0.0e0 AS ExternalEstimate FROM filled_cleaned
  WHERE PropertyState IN (SELECT PropertyState FROM cleaned GROUP BY 1 HAVING count(*) > 30)"""
CTES["prepared_trustee"] = """
  SELECT * EXCLUDE (HighBid, BPOSurplus), coalesce(HighBid, WinningBid) AS HighBid, BPO - Reserve AS BPOSurplus,
         CASE WHEN BPO IS NULL THEN 1 ELSE 0 END AS IsPredictedBPO FROM filled_cleaned_trustee
  WHERE PropertyState IN (SELECT PropertyState FROM cleaned_trustee GROUP BY 1 HAVING count(*) > 50)"""
_S2 = ("Turnover", "Appreciation", "MedianPPSQFT", "ForeclosedPer10000", "PrevForeclosureSoldRate")
CTES["second_step"] = f"""
  SELECT g.PropertyId, g.AuctionId, g.VenueId, {', '.join(f'CASE WHEN g.Turnover IS NULL THEN s.{m} ELSE g.{m} END AS {m}' for m in (*_S2, 'PercentHomesSold', 'TotalHomesForSale'))},
         s.PercentHomesSold AS sp, s.TotalHomesForSale AS st,
         CASE WHEN g.TotalActive IS NULL THEN s.TotalActive ELSE g.TotalActive END AS TotalActive,
         CASE WHEN g.TotalActive IS NULL THEN s.Vacancy ELSE g.Vacancy END AS Vacancy
  FROM gappy g LEFT JOIN (SELECT PropertyState, {', '.join(f'avg({m}) AS {m}' for m in (*_S2, 'PercentHomesSold', 'TotalHomesForSale', 'TotalActive', 'Vacancy'))}
                          FROM gappy WHERE Reserve IS NOT NULL GROUP BY 1) s ON g.PropertyState = s.PropertyState WHERE g.Reserve IS NOT NULL"""
CTES["second_filled"] = f"""
  SELECT PropertyId, AuctionId, VenueId, {', '.join(_S2)}, CASE WHEN TotalHomesForSale IS NULL THEN sp ELSE PercentHomesSold END AS PercentHomesSold,
         coalesce(TotalHomesForSale, st) AS TotalHomesForSale, TotalActive, Vacancy, 0 AS TrueSold, 0.0e0 AS HighBid FROM second_step"""
_NEED = ("C2C_Flag REO_Flag ShortSale_Flag Trustee_Flag Condition_poor Condition_fair Condition_average Condition_good Condition_unknown "
         "PropertyOccupancyStatus_Occupied PropertyOccupancyStatus_Unknown PropertyOccupancyStatus_Vacant FinancingAvailable Favorites TotalActive "
         "Vacancy Appreciation Turnover MedianPPSQFT Reserve BPOSurplus ValueLevel_Low ValueLevel_Med ValueLevel_High RunNum HasPrevAttempts "
         "BPOSurplusPct TotalRegistrantScore IntrinsicBidderQuality MedianPPSQFTDeviation").split()
CTES["complete_case"] = f"""
  SELECT PropertyId, AuctionId, VenueId, CASE WHEN AuctionDate < {HOLDOUT} THEN 'train' ELSE 'score' END AS Side FROM feature
  WHERE PropertyState IN (SELECT PropertyState FROM feature GROUP BY 1 HAVING count(*) > 30) AND {' AND '.join(f'{c} IS NOT NULL' for c in _NEED)}"""
_DEC = "[" + ", ".join(str(i / 10) for i in range(11)) + "]"
CTES["decile_list"] = f"SELECT PropertyState, quantile_cont(Reserve, {_DEC}) AS b FROM feature GROUP BY 1"
CTES["decile"] = "SELECT PropertyState, i - 1 AS Place, b[i] AS Value FROM decile_list, (SELECT unnest(range(1, 12)) AS i) n"
CTES["quintile_trustee"] = """
  SELECT PropertyState, i - 1 AS Place, b[i] AS Value
  FROM (SELECT PropertyState, quantile_cont(Reserve, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS b FROM feature_trustee_scoring GROUP BY 1) q,
       (SELECT unnest(range(1, 7)) AS i) n"""
_BUCKET = """
  SELECT f.PropertyState, d.Place, min(f.BPO) AS Value FROM {src} f
  JOIN (SELECT a.PropertyState, a.Place, a.Value AS lo, b.Value AS hi FROM {dec} a JOIN {dec} b ON a.PropertyState = b.PropertyState AND b.Place = a.Place + 1) d
    ON f.PropertyState = d.PropertyState AND f.Reserve BETWEEN d.lo AND d.hi GROUP BY 1, 2
  UNION ALL SELECT PropertyState, 10, max(BPO) FROM {src} GROUP BY 1"""
CTES["bucket_low_list"] = _BUCKET.format(src="feature", dec="decile")
CTES["unvalued"] = """
  SELECT * EXCLUDE (BPO), CASE WHEN PropertyId % 5 = 0 THEN NULL ELSE BPO END AS BPO, MedianPPSQFT * HomeSquareFootage - 60000 AS Predicted FROM feature"""
CTES["bucket_unvalued"] = _BUCKET.format(src="unvalued", dec="decile")
CTES["placed"] = """
  SELECT u.PropertyId, u.AuctionId, u.VenueId, u.PropertyState, u.Reserve, u.BPO, u.AuctionDate, u.StartingBid, u.Predicted,
         CAST(floor(count(CASE WHEN d.Value < u.Reserve THEN 1 END) + 1 + count(CASE WHEN d.Value = u.Reserve THEN 1 END) / 2.0) AS INTEGER) - 1 AS Place
  FROM unvalued u LEFT JOIN decile d ON u.PropertyState = d.PropertyState GROUP BY ALL"""
CTES["mixed"] = """
  SELECT q.*, CASE WHEN b.Value IS NULL THEN 3 * Reserve ELSE (4 * CASE WHEN p >= 3 * Reserve THEN 3 * Reserve ELSE p END + b.Value) / 5 END AS m
  FROM (SELECT *, CASE WHEN Predicted <= 0 OR Predicted IS NULL THEN coalesce(StartingBid, 0) ELSE Predicted END AS p FROM placed) q
  LEFT JOIN bucket_unvalued b ON q.PropertyState = b.PropertyState AND q.Place = b.Place"""
CTES["blended"] = f"""
  SELECT *, BPO - Reserve AS BPOSurplus, (BPO - Reserve) / nullif(Reserve, 0) AS BPOSurplusPct FROM (
    SELECT PropertyId, AuctionId, VenueId, Reserve, CASE WHEN BPO IS NULL AND AuctionDate >= {HOLDOUT}
           THEN (CASE WHEN m >= 3 * Reserve THEN 3 * Reserve ELSE m END) ELSE BPO END AS BPO FROM mixed) q"""
CTES["estimate"] = """
  SELECT GlobalPropertyId, avg(v) AS ExternalEstimate FROM (
    SELECT TRY_CAST(regexp_extract(url, '/(\\d+)', 1) AS BIGINT) AS GlobalPropertyId,
           CASE WHEN page_id % 9 = 0 THEN NULL WHEN page_id % 10 = 0 THEN 0 ELSE page_id * 1000 END AS v FROM pages) q
  WHERE GlobalPropertyId IS NOT NULL AND v > 0 GROUP BY 1"""
CTES["estimate_filled"] = """
  SELECT u.PropertyId, u.AuctionId, u.VenueId, coalesce(u.BPO, e.ExternalEstimate) AS BPO, coalesce(u.BPO, e.ExternalEstimate) - u.Reserve AS BPOSurplus,
         CASE WHEN u.BPO IS NULL THEN 1 ELSE 0 END AS IsPredictedBPO, coalesce(e.ExternalEstimate, 0) AS ExternalEstimate,
         replace(u.SellerName, ',', '') AS SellerName, replace(u.PropertyCity, ',', '') AS PropertyCity
  FROM unvalued u LEFT JOIN estimate e ON u.PropertyId = e.GlobalPropertyId"""

_MID = "SFR_Flag MultiResidence_Flag Bedrooms Baths Age HomeSquareFootage".split()
CTES["valued"] = f"""
  SELECT PropertyState, BPO, {', '.join(_MID)} FROM feature WHERE BPO IS NOT NULL
  UNION ALL SELECT PropertyState, median(BPO), {', '.join(f'median({c})' for c in _MID)} FROM feature WHERE BPO IS NOT NULL GROUP BY 1"""
CTES["valuation_rows"] = """
  SELECT v.PropertyState, count(*) AS Rows, sum(BPO) AS SumBPO, sum(CASE WHEN Age >= 200 THEN mAge ELSE Age END) AS SumAge,
         sum(CASE WHEN Bedrooms < 0 THEN mBed ELSE Bedrooms END) AS SumBedrooms, sum(CASE WHEN Baths < 0 THEN mBath ELSE Baths END) AS SumBaths,
         sum(CASE WHEN HomeSquareFootage < 100 THEN mFeet ELSE HomeSquareFootage END) AS SumFeet
  FROM valued v JOIN (
    SELECT PropertyState, median(CASE WHEN Age < 200 THEN Age END) AS mAge, median(CASE WHEN Bedrooms > 0 THEN Bedrooms END) AS mBed,
           median(CASE WHEN Baths > 0 THEN Baths END) AS mBath, avg(CASE WHEN HomeSquareFootage >= 100 THEN HomeSquareFootage END) AS mFeet
    FROM valued GROUP BY 1) m ON v.PropertyState = m.PropertyState GROUP BY 1"""
CTES["labelled"] = """
  SELECT PropertyId, AuctionId, VenueId, PropertyState, (Reserve - HighBid) / nullif(Reserve, 0) AS gap,
         CASE PropertyState WHEN 'ASIA' THEN IsSold WHEN 'AFRICA' THEN 1 ELSE 0 END AS y FROM feature"""
CTES["flipped"] = f"""
  SELECT {KEY}, CASE WHEN hi = 0 AND up = 1 AND gap IS NOT NULL THEN 1 WHEN lo = 1 AND down = 1 AND gap IS NOT NULL THEN 0 ELSE y END AS Label
  FROM (SELECT *, min(y) OVER (PARTITION BY PropertyState) AS lo, max(y) OVER (PARTITION BY PropertyState) AS hi,
               row_number() OVER (PARTITION BY PropertyState ORDER BY gap NULLS LAST, {KEY}) AS up,
               row_number() OVER (PARTITION BY PropertyState ORDER BY -gap NULLS LAST, {KEY}) AS down FROM labelled) q"""

# ---- scores ---------------------------------------------------------------------------------
for _m in tt.MODELS:
    CTES[f"coef_{_m}"] = tt.coefficient_select(_m)


def _scored(source: str, models, bound: str) -> str:
    scores = ", ".join(f"{tt.score_sql(m.name)} AS {m.output}" for m in models)
    joins = " ".join(f"JOIN coef_{m.name} c_{m.name} ON a.PropertyState = c_{m.name}.PropertyState" for m in models)
    return f"""SELECT a.*, CASE WHEN a.BPO < {bound} * a.Reserve OR a.BPO IS NULL THEN 1.2 * a.Reserve ELSE a.BPO END AS FunctionalBPO,
      {scores} FROM {source} a {joins}"""


CTES["scored"] = _scored("feature_scoring", (*NONTRUSTEE_MODELS, VALUATION_MODEL), "0.15")
CTES["scored_training"] = _scored("feature", (*NONTRUSTEE_MODELS, VALUATION_MODEL), "0.15")
CTES["scored_trustee"] = _scored("feature_trustee_scoring", TRUSTEE_MODELS, "0.1")
_SA = "(CASE WHEN SellerAcceptedSalePrediction < ExceedReservePrediction THEN ExceedReservePrediction ELSE SellerAcceptedSalePrediction END)"
_ORDERED = """SELECT * EXCLUDE (AuctionDaySalePrediction, SellerAcceptedSalePrediction), {sa} AS SellerAcceptedSalePrediction,
  CASE WHEN AuctionDaySalePrediction < {sa} THEN {sa} ELSE AuctionDaySalePrediction END AS AuctionDaySalePrediction FROM {src}"""
CTES["ordered"] = _ORDERED.format(sa=_SA, src="scored")
CTES["ordered_training"] = _ORDERED.format(sa=_SA, src="scored_training")
CTES["capped"] = """
  SELECT * EXCLUDE (StartingBid), coalesce(StartingBid, (SELECT min(StartingBid) FROM ordered)) AS StartingBid,
         CASE WHEN RecommendedMaxReservePrice > 1.5 * Reserve AND RecommendedMaxReservePrice > 200000 THEN 1.5 * Reserve
              ELSE RecommendedMaxReservePrice END AS capped_price FROM ordered"""
CTES["ruled"] = """
  SELECT *, CASE WHEN AuctionDaySalePrediction < 0.5 AND capped_price < Reserve THEN capped_price - Reserve ELSE 0 END AS ReserveRedux,
         CASE WHEN capped_price < StartingBid THEN StartingBid ELSE capped_price END AS HighBidPrediction FROM capped"""
CTES["banded"] = """
  SELECT *, CASE WHEN AuctionDaySalePrediction >= 0.8 THEN 'High' WHEN AuctionDaySalePrediction >= 0.5 THEN 'Moderate'
                 WHEN AuctionDaySalePrediction >= 0.1 THEN 'Borderline' ELSE 'Low' END AS SaleLikelihood FROM ordered"""
CTES["accept_model"] = tt.ACCEPTANCE_MODELS
_PICK = "coalesce(o.{0}, h.{0}, (SELECT arg_max({0}, Position) FROM accept_model))"
CTES["accepted"] = f"""
  SELECT q.*, 1 / (1 + exp(-(b0 + b1 * s + b2 * s * s + b3 * s * s * s))) AS AcceptancePrediction FROM (
    SELECT f.PropertyId, f.AuctionId, f.VenueId, {_PICK.format('intercept')} AS b0, {_PICK.format('b1')} AS b1, {_PICK.format('b2')} AS b2,
           {_PICK.format('b3')} AS b3, greatest(1 - f.BPO * 0.7 / nullif(f.Reserve, 0), 0) AS s
    FROM feature f
    LEFT JOIN (SELECT * FROM accept_model QUALIFY row_number() OVER (PARTITION BY SellerCode, PropertyState ORDER BY Position) = 1) o
      ON f.SellerCode = o.SellerCode AND f.PropertyState = o.PropertyState
    LEFT JOIN (SELECT * FROM accept_model WHERE PropertyState = 'ASIA' QUALIFY row_number() OVER (PARTITION BY SellerCode ORDER BY Position) = 1) h
      ON f.SellerCode = h.SellerCode) q"""

# ---- explanations ---------------------------------------------------------------------------
CTES["fault_weight"] = tt.weight_select()
CTES["fault_weight_trustee"] = tt.weight_select(True)
for _n, _src, _tr in (("contribution", "feature_scoring", False), ("contribution_trustee", "feature_trustee_scoring", True)):
    CTES[_n] = f"""
  SELECT a.GlobalPropertyId, a.PropertyId, a.AuctionId, a.VenueId, w.PropertyFaultVariable, w.PropertyFaultName,
         {tt.contribution_sql(_tr)} AS ComponentValue FROM {_src} a JOIN fault_weight{'_trustee' if _tr else ''} w ON a.PropertyState = w.PropertyState"""
_TOP = """
  SELECT {key}, max(CASE WHEN n = 1 THEN PropertyFaultName END) AS Negative1, max(CASE WHEN n = 2 THEN PropertyFaultName END) AS Negative2
  FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ComponentValue, PropertyFaultVariable, PropertyFaultName{more}) AS n
        FROM {src} WHERE ComponentValue IS NOT NULL AND PropertyFaultVariable NOT IN ('Intercept', 'Reserve')) q
  WHERE n <= 2 GROUP BY {key} HAVING count(*) = 2"""
CTES["top_two"] = _TOP.format(key=KEY, src="contribution", more="")
CTES["top_two_trustee"] = _TOP.format(key=KEY, src="contribution_trustee", more="")
CTES["top_two_property"] = _TOP.format(key="GlobalPropertyId", src="contribution", more=f", {KEY}")
CTES["top_two_shared"] = """
  SELECT a.PropertyId, a.AuctionId, a.VenueId, t.Negative1, t.Negative2 FROM feature_scoring a
  JOIN top_two_property t ON a.GlobalPropertyId = t.GlobalPropertyId WHERE a.PropertyState IN (SELECT PropertyState FROM fault_weight)"""
CTES["sale_long"] = tt.coefficient_long_select("auction_day_sale")
CTES["price_long"] = tt.coefficient_long_select("high_bid")
CTES["chosen_weight"] = """
  SELECT s.PropertyState, s.term, CASE WHEN s.value = 0 THEN p.value / m.peak ELSE s.value END AS weight
  FROM sale_long s LEFT JOIN price_long p ON s.PropertyState = p.PropertyState AND s.term = p.term
  JOIN (SELECT PropertyState, max(abs(value)) AS peak FROM price_long WHERE term <> 'IntrinsicBidderQuality' GROUP BY 1) m
    ON s.PropertyState = m.PropertyState WHERE s.term <> 'Intercept'"""
CTES["fault_text"] = tt.fault_names_sql()
_CAST = ", ".join(f"CAST({t} AS DOUBLE) AS {t}" for t in SALE_TERMS)
_MASK = "('SFR_Flag', 'MultiResidence_Flag', 'C2C_Flag', 'REO_Flag', 'ShortSale_Flag', 'Trustee_Flag', 'Reserve')"
for _n, _src in (("tall", "feature"), ("tall_second", "feature_scoring")):
    CTES[_n] = f"""
  SELECT * FROM (SELECT {KEY}, PropertyState, {_CAST} FROM {_src}) UNPIVOT (x FOR term IN ({', '.join(SALE_TERMS)}))"""
CTES["centre"] = """
  SELECT PropertyState, term, CASE WHEN bool_and(x = 0 OR x = 1) THEN 0 ELSE avg(x) END AS c FROM tall GROUP BY 1, 2"""
for _n, _src, _all in (("centred", "tall", "feature"), ("centred_second", "tall_second", "feature_scoring")):
    CTES[_n] = f"""
  SELECT f.PropertyId, f.AuctionId, f.VenueId, coalesce(r.n1, 'Cannot Suggest Fault') AS Neg1, coalesce(r.n2, 'Cannot Suggest Fault') AS Neg2
  FROM {_all} f LEFT JOIN (
    SELECT {KEY}, max(CASE WHEN k = 1 AND (nxt IS NULL OR part < nxt) THEN name END) AS n1,
           max(CASE WHEN k = 2 AND (nxt IS NULL OR part < nxt) AND part > prv THEN name END) AS n2
    FROM (SELECT *, row_number() OVER w AS k, lead(part) OVER w AS nxt, lag(part) OVER w AS prv FROM (
            SELECT t.PropertyId, t.AuctionId, t.VenueId, x.name, (t.x - c.c) * w.weight AS part FROM {_src} t
            JOIN centre c ON t.PropertyState = c.PropertyState AND t.term = c.term
            JOIN chosen_weight w ON t.PropertyState = w.PropertyState AND t.term = w.term JOIN fault_text x ON t.term = x.term
            WHERE t.term NOT IN {_MASK} AND w.weight IS NOT NULL) q
          WINDOW w AS (PARTITION BY {KEY} ORDER BY part, name)) z GROUP BY ALL) r
    ON f.PropertyId = r.PropertyId AND f.AuctionId = r.AuctionId AND f.VenueId = r.VenueId"""

# ---- publishing -----------------------------------------------------------------------------
CTES["final"] = f"""
  SELECT o.* EXCLUDE (RecommendedMaxReservePrice), o.IsSold AS AuctionDaySale, o.TrueSold AS SellerAcceptedSale, o.AuctionReserveSuccess AS ReserveExceeded,
         CASE WHEN o.RecommendedMaxReservePrice < o.StartingBid THEN o.StartingBid ELSE o.RecommendedMaxReservePrice END AS RecommendedMaxReservePrice,
         {AS_OF} AS ModelRunDate, t.Negative1, t.Negative2
  FROM ordered o JOIN top_two t ON o.PropertyId = t.PropertyId AND o.AuctionId = t.AuctionId AND o.VenueId = t.VenueId"""
CTES["final_trustee"] = f"""
  SELECT o.* EXCLUDE (RecommendedMaxReservePrice, ThirdPartySaleIfAuctionedPrediction),
         CASE WHEN ThirdPartySaleIfAuctionedPrediction < ThirdPartySaleOverallPrediction THEN ThirdPartySaleOverallPrediction
              ELSE ThirdPartySaleIfAuctionedPrediction END AS ThirdPartySaleIfAuctionedPrediction,
         CASE WHEN o.RecommendedMaxReservePrice < o.OpeningBid THEN o.OpeningBid ELSE o.RecommendedMaxReservePrice END AS RecommendedMaxReservePrice,
         {AS_OF} AS ModelRunDate, t.Negative1, t.Negative2
  FROM scored_trustee o JOIN top_two_trustee t ON o.PropertyId = t.PropertyId AND o.AuctionId = t.AuctionId AND o.VenueId = t.VenueId"""
CTES["history_table"] = """
  SELECT f.*, 1 AS RunId, 0 AS MostRecentData FROM final f UNION ALL SELECT f.*, 2, 1 FROM final f"""
CTES["current_table"] = "SELECT *, 1 AS MostRecentData FROM final"
_TYPE = {"bigint": "BIGINT", "string": "VARCHAR", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def _unified_side(which: int, table: str) -> str:
    columns = []
    for name, *sources, kind in UNIFIED:
        source = name if sources[which] == "=" else sources[which]
        columns.append(f"CAST({source or 'NULL'} AS {_TYPE[kind]}) AS {name}")
    return f"SELECT {', '.join(columns)} FROM {table}"


CTES["unified_table"] = f"{_unified_side(0, 'final')} UNION ALL {_unified_side(1, 'final_trustee')}"

# ---- reports --------------------------------------------------------------------------------
CTES["sided"] = f"""
  SELECT *, CASE WHEN AuctionDate > {AS_OF} THEN 'upcoming' WHEN AuctionDate < {AS_OF} THEN 'trailing' END AS side FROM ordered_training"""
CTES["histogram_rows"] = """
  SELECT Population, least(floor(p * 20) + 1, 20) AS Bin, count(*) AS Rows FROM (
    SELECT 'all' AS Population, AuctionDaySalePrediction AS p FROM sided
    UNION ALL SELECT side, AuctionDaySalePrediction FROM sided WHERE side IS NOT NULL) q WHERE p IS NOT NULL GROUP BY 1, 2"""
CTES["error_rows"] = """
  SELECT side AS Population, CASE WHEN AuctionDaySalePrediction > 0.5 THEN 1 ELSE 0 END - IsSold AS ErrorType, count(*) AS Rows
  FROM sided WHERE side IS NOT NULL AND AuctionDaySalePrediction IS NOT NULL GROUP BY 1, 2"""
CTES["calibrated"] = """
  SELECT a.m AS MeanPrediction, b.s AS ShareWithoutHighBid, a.m * b.s AS Product
  FROM (SELECT avg(AuctionDaySalePrediction) AS m FROM ordered_training) a,
       (SELECT avg(CASE WHEN HighBid IS NULL THEN 1.0 ELSE 0.0 END) AS s FROM feature) b"""
_PART = {"All": "TRUE", "WithoutFirst": "(SellerCode IS NULL OR SellerCode NOT IN ('SC0', 'SC1'))", "Second": "SellerCode = 'SC2'", "Third": "SellerCode = 'SC3'"}
_MEANS = ", ".join(
    f"avg(CASE WHEN AuctionDate {op} {AS_OF} THEN {m} END) AS {t}{m}"
    for m in ("BPOSurplus", "Reserve", "BPO", "BPOSurplusPct") for t, op in (("Pre", ">"), ("Post", "<")))
CTES["drifted"] = " UNION ALL ".join(
    f"SELECT '{n}' AS Segment, *, PreBPO - PostBPO AS BPODifference, PreReserve - PostReserve AS ReserveDifference "
    f"FROM (SELECT {_MEANS} FROM feature WHERE {w}) q" for n, w in _PART.items())


# ---- assembly -------------------------------------------------------------------------------

def _with(body: str) -> str:
    """Prefix a SELECT with every role and entry it needs, in dependency order."""
    order: list[str] = []

    def visit(sql: str, own: str | None) -> None:
        for name in mentions(sql, [*ROLES, *CTES]):
            if name != own and name not in order:
                inner = role_sql(name, "duckdb") if name in ROLES else CTES[name]
                visit(inner, name)
                if name not in order:
                    order.append(name)

    visit(body, None)
    if not order:
        return body
    parts = [f"{n} AS ({role_sql(n, 'duckdb') if n in ROLES else CTES[n]})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body


def oracle_query(source: str, spec: str) -> str:
    """SQL for one result: ``source`` is an entry or a SELECT, ``spec`` its output columns and kinds."""
    columns = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        if kind == "i":
            columns.append(f"CAST({name} AS BIGINT) AS {name}")
        elif kind == "d":
            columns.append(f"CAST(CAST({name} AS DATE) AS VARCHAR) AS {name}")
        elif kind:
            columns.append(f"round(CAST({name} AS DOUBLE), {kind}) + 0.0e0 AS {name}")
        else:
            columns.append(name)
    table = source if source in CTES or source in ROLES or source in BASE else f"({source}) q"
    return _with(f"SELECT {', '.join(columns)} FROM {table}")
