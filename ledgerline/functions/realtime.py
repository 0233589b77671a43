"""Model inputs of an order line, for training and for serving alike.

``line_features`` is the only place that derives them: the training frame
and the stream call it with the same ``ServingParams``, so the two cannot
drift apart; what a serving message does not carry (a ship date, some
categories) comes from the parameters.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import numeric as N
from ledgerline.functions.dates import parse_date, week_iso, week_sunday

# The serving defaults that results must agree with
REFERENCE_SALES_P1 = 0.36
REFERENCE_SALES_P99 = 31357.32
REFERENCE_SHIP_P1 = 0.0
REFERENCE_SHIP_P99 = 1784.71
REFERENCE_DELIVERY_DAYS = 4.0
REFERENCE_FALLBACK_DATE = "2026-06-13"
REFERENCE_DEFAULTS = {"Segment": "Consumer", "Region": "Central", "Ship_Mode": "Standard Class",
                      "Order_Priority": "Medium"}
REFERENCE_MARKET_DEFAULT = "US"
REFERENCE_HIGH_DISCOUNT = 0.2
# Names of the profit tiers, from the lowest up
RISK_TIERS = ("LOSS RISK", "LOW PROFIT", "MEDIUM PROFIT", "HIGH PROFIT OPPORTUNITY")


@dataclass(frozen=True)
class ServingParams:
    sales_lo: float = REFERENCE_SALES_P1
    sales_hi: float = REFERENCE_SALES_P99
    ship_lo: float = REFERENCE_SHIP_P1
    ship_hi: float = REFERENCE_SHIP_P99
    delivery_days: float = REFERENCE_DELIVERY_DAYS
    fallback_date: str = REFERENCE_FALLBACK_DATE
    week_rule: str = "iso"  # or "sunday"; training and serving must use the same
    high_discount: float = REFERENCE_HIGH_DISCOUNT
    market_default: str = REFERENCE_MARKET_DEFAULT
    defaults: tuple = tuple(REFERENCE_DEFAULTS.items())


def per_unit(total: Column, units) -> Column:
    """total / units, 0 where there are no units."""
    u = F.col(units) if isinstance(units, str) else units
    return F.when(u != 0, total / u).when(u == 0, F.lit(0.0))


def line_features(df: DataFrame, p: ServingParams, names: dict[str, str] | None = None) -> DataFrame:
    """Add the derived inputs to order lines.

    ``names`` maps the inputs (sales, shipping_cost, discount, quantity,
    order_date, market, category; optional ship_date, None for none) to
    columns of ``df``; default: their own names.  The order date may be a
    date or text.
    """
    col = {k: k for k in ("sales", "shipping_cost", "discount", "quantity", "order_date", "market", "category")}
    if "ship_date" in df.columns:
        col["ship_date"] = "ship_date"
    col |= names or {}
    day = F.col(col["order_date"])
    if dict(df.dtypes)[col["order_date"]] != "date":
        day = parse_date(day, "yyyy-MM-dd", p.fallback_date)
    week = {"iso": week_iso, "sunday": week_sunday}[p.week_rule]
    # first the inputs that others are made of, then what is made of them
    df = df.withColumns({
        "sales_capped": N.clamp(N.dbl(col["sales"]), p.sales_lo, p.sales_hi),
        "shipping_cost_capped": N.clamp(N.dbl(col["shipping_cost"]), p.ship_lo, p.ship_hi),
        "discount_d": N.dbl(col["discount"]), "order_day": day})
    sales = F.col("sales_capped")
    ship = col.get("ship_date")
    delivery = F.datediff(ship, "order_day").cast("double") if ship else F.lit(p.delivery_days)
    return df.withColumns({
        "year": F.year("order_day"), "weeknum": week(F.col("order_day")), "delivery_days": delivery,
        "discount_amount": sales * F.col("discount_d"),
        "shipping_ratio": per_unit(F.col("shipping_cost_capped"), sales),
        "avg_item_value": per_unit(sales, col["quantity"]),
        "is_discounted": N.flag(F.col(col["discount"]) > 0),
        "high_discount": N.flag(F.col(col["discount"]) >= F.lit(p.high_discount)),
        "market_category": F.concat_ws("_", F.coalesce(F.col(col["market"]), F.lit(p.market_default)),
                                       F.col(col["category"]))})


#: Columns of an order message and the names the features use.
MESSAGE_NAMES = {"Order_ID": "order_id", "Customer_ID": "customer_id", "Order_Date": "order_date",
                 "Category": "category", "Sub_Category": "sub_category", "Sales": "sales", "Discount": "discount",
                 "Quantity": "quantity", "Shipping_Cost": "shipping_cost", "Market": "market"}


def message_features(orders: DataFrame, p: ServingParams) -> DataFrame:
    """Order messages with lower-case names, missing categories filled from the defaults, and all derived inputs."""
    names = {c.lower(): c for c in orders.columns}
    lower = orders.select(*[F.col(c).alias(MESSAGE_NAMES.get(c, c)) for c in orders.columns])
    filled = {c.lower(): F.coalesce(F.col(c), F.lit(v)) if c.lower() in names else F.lit(v) for c, v in p.defaults}
    lower = lower.withColumns(filled)
    if "country" not in names:  # a message names no country: the region's default stands for it
        lower = lower.withColumn("country", F.lit(dict(p.defaults).get("Region")))
    return line_features(lower, p, {"ship_date": None})  # not shipped yet


def tier(value, upper_bounds, labels) -> Column:
    """The label of the first bound that ``value`` does not exceed; the last label beyond all, and for null.

    A bound is a number (value <= bound) or a pair (number, "<") for a strict one.
    """
    x = F.col(value) if isinstance(value, str) else value
    out = None
    for bound, label in zip(upper_bounds, labels, strict=False):
        limit, strict = bound if isinstance(bound, tuple) else (bound, "")
        cond = x < F.lit(limit) if strict else x <= F.lit(limit)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(labels[len(upper_bounds)]))


def risk_tier(pred, low: float = 100.0, high: float = 500.0, explicit_null: bool = False) -> Column:
    """Profit tier of a prediction: below 0, up to ``low``, up to ``high``, above.

    A null prediction falls into the top tier, as the reports expect; with
    ``explicit_null`` it is UNKNOWN instead.
    """
    x = F.col(pred) if isinstance(pred, str) else pred
    t = tier(x, [(0.0, "<"), low, high], RISK_TIERS)
    return F.when(x.isNull(), F.lit("UNKNOWN")).otherwise(t) if explicit_null else t
