"""Business rules: calendar, order status, discount choice, order derivation, attributes."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType, StringType, StructField, StructType

from martlight.functions.columns import (
    DateLike,
    as_date,
    date_key,
    leaf_category,
    main_category,
    surrogate_id,
    vendor_rating,
    whole_days_between,
)
from martlight.schemas import DIM_TIME, FACT_ORDER

# Purchases and ends of rules that a stretch of time holds, about, and the most stretches of either kind.
STRETCH_PURCHASES = 100_000
STRETCH_ENDS = 200
MAX_STRETCHES = 1024
# The ends of time, in microseconds.
_FIRST, _LAST = -(1 << 63), (1 << 63) - 1


def calendar(spans: DataFrame) -> DataFrame:
    """One calendar row per day in the closed spans (first_day, last_day), each day once."""
    day = F.col("dt")
    iso_day = F.weekday(day) + 1
    parts = {
        "time_id": date_key(day),
        "dt": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "hour": F.lit(0),
        "minute": F.lit(0),
        "day_of_week": iso_day,
        "is_weekend": F.when(iso_day >= 6, 1).otherwise(0),
    }
    return (
        spans.select(F.explode(F.sequence("first_day", "last_day")).alias("dt"))
        .select([parts[f.name].cast(f.dataType).alias(f.name) for f in DIM_TIME])
        .dropDuplicates(["time_id"])
    )


def build_dim_time(orders: DataFrame) -> DataFrame:
    """Calendar of every day between the first and the last order."""
    return calendar(orders.agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")))


def rate_vendors(vendors: DataFrame) -> DataFrame:
    """Recompute ``vendor_rating`` from the vendor's own attributes."""
    return vendors.withColumn("vendor_rating", vendor_rating())


def status_by_age(order_ts: Column, as_of: Column, is_returned: Column | None = None) -> Column:
    """Fulfilment status from whole days since the order; a returned flag only matters once complete."""
    age = whole_days_between(as_of, order_ts)
    # Names of the states and the age in days at which each one ends.
    status = (
        F.when(age < 0, "Pending").when(age < 1, "Processing").when(age < 3, "Shipped").when(age < 7, "Delivered")
    )
    if is_returned is not None:
        status = status.when(is_returned, "Returned")
    return F.when(age.isNotNull(), status.otherwise("Completed"))


def order_status_by_age(
    orders: DataFrame, as_of: str | dt.datetime, ts_column: str = "order_ts", returned_column: str | None = None
) -> DataFrame:
    """Add ``order_status`` to rows carrying an order time."""
    flag = None if returned_column is None else F.col(returned_column)
    return orders.withColumn("order_status", status_by_age(F.col(ts_column), F.lit(as_of).cast("timestamp"), flag))


def _priced_rules(discounts: DataFrame) -> DataFrame:
    """Rules as (lo, hi, share, threshold, best): half-open span in microseconds, and what ranks them.

    ``percentage`` takes a share of gross, ``fixed`` and ``coupon`` their face value, any other kind
    nothing. A rule without a span, threshold or value never applies.
    """
    kind = F.col("discount_type")
    value = F.when(kind.isin("fixed", "coupon", "percentage"), F.col("discount_value")).otherwise(0)
    return discounts.select(
        F.unix_micros("valid_from").alias("lo"),
        # Both ends of a validity belong to it.
        (F.unix_micros("valid_to") + 1).alias("hi"),
        F.coalesce(kind == "percentage", F.lit(False)).alias("share"),
        F.col("threshold_amount").alias("threshold"),
        # The greatest takes off most and has, of equals, the lowest id.
        F.struct(value.cast("decimal(12,2)").alias("value"), (-F.col("discount_id")).alias("negated_id")).alias("best"),
    ).where("lo < hi and threshold is not null and best.value is not null and best.negated_id is not null")


def _frontier(rules: DataFrame, *by: str) -> DataFrame:
    """Rules that some gross would choose: a higher threshold must take off more, or as much with a lower id."""
    lower = (
        Window.partitionBy(*by, "share")
        .orderBy("threshold", F.desc("best"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.max("best").over(lower)
    return rules.withColumn("_before", before).where("_before is null or best > _before").drop("_before")


def _quantiles(times: DataFrame, each: int) -> list[int]:
    """Times that cut ``times`` (at) into parts of about ``each`` rows, ascending; a hot time comes repeatedly."""
    cuts = [i / MAX_STRETCHES for i in range(1, MAX_STRETCHES)]
    found = times.agg(F.count("at").alias("n"), F.percentile_approx("at", cuts, 16 * MAX_STRETCHES).alias("cuts")).first()
    parts = min(MAX_STRETCHES, -(-found["n"] // each))
    return [found["cuts"][i * MAX_STRETCHES // parts - 1] for i in range(1, parts)]


class _Stretches:
    """Time cut where purchases and rule ends lie dense, not by the clock.

    Stretches are numbered in order; ``salts`` says over how many keys the purchases of each are dealt: a
    time that takes up several cuts is one stretch of as many keys.
    """

    def __init__(self, cuts: list[int]):
        # The search compares doubles; times that they can't tell apart share a stretch.
        self._starts = sorted({float(c) for c in cuts})
        self.salts = [1] + [sum(float(c) == s for c in cuts) for s in self._starts]

    def number(self, rows: DataFrame, **times: Column) -> DataFrame:
        """Add under each name the stretch of its time (not null)."""
        if not self._starts:
            return rows.withColumns({name: F.lit(0) for name in times})
        columns = rows.columns
        names = {name: f"_time_{name}" for name in times}
        rows = rows.withColumns({names[n]: t.cast("double") for n, t in times.items()})
        splits = [float("-inf"), *self._starts, float("inf")]
        cut = Bucketizer(
            splitsArray=[splits] * len(times), inputCols=list(names.values()), outputCols=list(times)
        ).transform(rows)
        return cut.select(*columns, *[F.col(n).cast("int").alias(n) for n in times])


def _throughout(rules: DataFrame, stretches: int) -> DataFrame:
    """(stretch, share, threshold, best): frontier of the rules that are valid through a whole stretch.

    The whole stretches of a rule, those between its first and its last, are some blocks of 2 ** k
    stretches each, two of a size at most. Only the frontier of each block is dealt to its stretches, so a
    rule that lasts for ever meets few of them, unless it can be chosen there.
    """
    levels = range(max(stretches, 1).bit_length())
    left, right = F.col("first") + 1, F.col("last")
    blocks = []
    for k in levels:
        lo, hi = F.ceil(left / (1 << k)), F.floor(right / (1 << k))
        odd = (lo < hi) & (lo % 2 == 1)
        rest = lo + F.when(odd, 1).otherwise(0)
        blocks += [
            F.when(odd, F.struct(F.lit(k).alias("level"), lo.alias("block"))),
            F.when((rest < hi) & (hi % 2 == 1), F.struct(F.lit(k).alias("level"), (hi - 1).alias("block"))),
        ]
    lasting = rules.where("last - first > 1").select(F.inline(F.array_compact(F.array(*blocks))), "share", "threshold", "best")
    # Very many rules may last for ever: of one threshold only the best is ranked.
    best = lasting.groupBy("level", "block", "share", "threshold").agg(F.max("best").alias("best"))
    wide = _frontier(best, "level", "block")
    size = F.expr("shiftleft(1, level)")
    own = F.sequence(F.col("block") * size, (F.col("block") + 1) * size - 1)
    dealt = wide.select(F.explode(own.cast("array<int>")).alias("stretch"), "share", "threshold", "best")
    return _frontier(dealt, "stretch")


def discount_steps(discounts: DataFrame, stretches: _Stretches) -> DataFrame:
    """(stretch, at, shares, values): from ``at`` on, until the next step of the stretch, these two frontiers hold.

    Between two ends of any validity the usable rules are the same; only those on the frontier of
    threshold and amount can be chosen. A rule steps in and out in the stretches of its two ends; the
    stretches between have it from their start, if it is on the frontier of those that last.
    """
    rules = _priced_rules(discounts)
    rules = stretches.number(rules, first=F.col("lo"), last=F.col("hi") - 1)
    columns = ["stretch", "lo", "hi", "share", "threshold", "best"]
    ends = rules.withColumn("stretch", F.explode(F.array_distinct(F.array("first", "last"))))
    ends = ends.withColumns(
        {
            "lo": F.when(F.col("stretch") == F.col("first"), F.col("lo")).otherwise(F.lit(_FIRST)),
            "hi": F.when(F.col("stretch") == F.col("last"), F.col("hi")).otherwise(F.lit(_LAST)),
        }
    ).select(columns)
    if len(stretches.salts) > 2:
        through = _throughout(rules, len(stretches.salts))
        through = through.withColumns({"lo": F.lit(_FIRST), "hi": F.lit(_LAST)})
        ends = ends.union(through.select(columns))
    at = ends.select("stretch", F.explode(F.array("lo", "hi")).alias("at")).where(F.col("at") < _LAST).distinct()
    usable = at.join(ends, "stretch").where("lo <= at and at < hi")
    steps = _frontier(usable.select("stretch", "at", "share", "threshold", "best"), "stretch", "at")
    step = F.struct("threshold", "best")

    def side(condition: str) -> Column:
        return F.collect_list(F.when(F.expr(condition), step))

    # Where the last rule ends there is no step, but an end of the one before.
    ended = at.select("stretch", "at", *[F.lit(None).cast(steps.schema[c].dataType).alias(c) for c in ("share", "threshold", "best")])
    return (
        steps.unionByName(ended)
        .groupBy("stretch", "at")
        .agg(side("share").alias("shares"), side("not share").alias("values"))
    )


def best_valid_discount(
    purchases: DataFrame,
    discounts: DataFrame,
    stretch_purchases: int = STRETCH_PURCHASES,
    stretch_ends: int = STRETCH_ENDS,
    clock: DataFrame | None = None,
) -> DataFrame:
    """Attach to each purchase the valid discount that takes off most, lowest id on a tie.

    ``purchases`` needs event_ts and gross_amount. Adds discount_id (NULL if none applies),
    exact_discount (unrounded) and discount_amount. Time is cut into stretches by quantiles of the purchases'
    times and of the rules' ends. In each, purchases and the steps of the frontier are one sequence
    by time: a purchase takes the last frontier before it and picks from that in place. Every row
    comes out once, also repeated ones and those without a time. ``clock`` may name a cheaper frame whose event_ts
    are spread like the purchases'.
    """
    now, gross = F.unix_micros("event_ts"), F.col("gross_amount")
    seen = (purchases if clock is None else clock).select(now.alias("at"))
    ends = _priced_rules(discounts).select(F.explode(F.array("lo", "hi")).alias("at"))
    stretches = _Stretches(_quantiles(seen, stretch_purchases) + _quantiles(ends, stretch_ends))
    steps = discount_steps(discounts, stretches)
    salts = F.get(F.array(*[F.lit(n) for n in stretches.salts]), "stretch")
    steps = steps.select(
        "stretch",
        F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
        "at",
        F.lit(None).cast(purchases.schema).alias("row"),
        F.struct("shares", "values").alias("step"),
    )
    # Drawn by content, so that a task that runs again deals alike.
    plain = [f.name for f in purchases.schema if isinstance(f.dataType, AtomicType)]
    bought = purchases.select(F.struct(*purchases.columns).alias("row"), now.alias("at"), F.xxhash64(*plain).alias("draw"))
    bought = stretches.number(bought, stretch=F.coalesce("at", F.lit(0))).select(
        "stretch",
        F.pmod("draw", salts).cast("int").alias("salt"),
        "at",
        "row",
        F.lit(None).cast(steps.schema["step"].dataType).alias("step"),
    )
    # Of one time, steps come before purchases; a purchase without a time comes before all steps.
    order = Window.partitionBy("stretch", "salt").orderBy("at", F.col("row").isNotNull())
    swept = bought.union(steps).withColumn("step", F.last("step", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    swept = swept.where(F.col("row").isNotNull()).select("row.*", F.col("step").alias("_step"))

    def best(side: str) -> Column:
        usable = F.filter(F.col("_step")[side], lambda x: x["threshold"] <= gross)
        return F.array_max(F.transform(usable, lambda x: x["best"]))

    def amount(side: str, value: Column) -> Column:
        chosen = F.col(f"_{side}")
        return F.when(
            chosen.isNotNull(),
            F.struct(value.cast("decimal(23,4)").alias("amount"), chosen["negated_id"].alias("negated_id")),
        )

    candidates = [amount("shares", gross * F.col("_shares")["value"]), amount("values", F.col("_values")["value"])]
    exact = F.coalesce(F.col("_best")["amount"], F.lit(0)).cast("decimal(23,4)")
    return (
        swept.withColumns({"_shares": best("shares"), "_values": best("values")})
        .withColumn("_best", F.greatest(*candidates))
        .withColumns({"discount_id": -F.col("_best")["negated_id"], "exact_discount": exact})
        .withColumn("discount_amount", F.round("exact_discount", 2).try_cast("decimal(12,2)"))
        .select(*purchases.columns, "discount_id", "exact_discount", "discount_amount")
    )


def purchase_orphans(events: DataFrame, products: DataFrame, users: DataFrame) -> DataFrame:
    """(reason, event_id, product_id, user_id) of purchases that no order comes of.

    The reason is ``product``, ``user`` or ``product and user``, whichever the tables don't have; a null
    key is unknown as well. Distinct keys of purchases are looked up, not purchases: a
    left-anti join of the keys, so a key that a third of the events share is looked up once. Known keys
    leave no rows, and only the unknown ones go back to the events.
    """
    bought = events.where(F.col("event_type") == "purchase").select("event_id", "product_id", "user_id")

    def unknown(keys: str, table: DataFrame) -> DataFrame:
        asked = bought.select(keys).where(F.col(keys).isNotNull()).distinct()
        return asked.join(table.select(keys), keys, "left_anti").withColumn(f"_no_{keys}", F.lit(True))

    lost = bought
    for keys, table in (("product_id", products), ("user_id", users)):
        lost = lost.join(unknown(keys, table), keys, "left")
    no_product = F.col("product_id").isNull() | F.col("_no_product_id").isNotNull()
    no_user = F.col("user_id").isNull() | F.col("_no_user_id").isNotNull()
    reason = F.when(no_product & no_user, "product and user").when(no_product, "product").when(no_user, "user")
    return lost.select(reason.alias("reason"), "event_id", "product_id", "user_id").where("reason is not null")


def orphan_counts(events: DataFrame, products: DataFrame, users: DataFrame) -> DataFrame:
    """(reason, purchases): purchases that become orders (``kept``) and those that don't, by reason; they add up to all."""
    lost = purchase_orphans(events, products, users).groupBy("reason").agg(F.count(F.lit(1)).alias("purchases"))
    whole = events.where(F.col("event_type") == "purchase").agg(F.count(F.lit(1)).alias("purchases"))
    signed = lost.select((-F.col("purchases")).alias("n")).union(whole).agg(F.sum("n").alias("purchases"))
    return lost.union(signed.select(F.lit("kept"), "purchases"))


def orders_from_events(
    events: DataFrame,
    products: DataFrame,
    users: DataFrame,
    discounts: DataFrame,
    as_of: str | dt.datetime,
) -> DataFrame:
    """Order facts from purchase events; those of unknown products or users are left out (``purchase_orphans`` lists them).

    ``events`` carries quantity, payment_method and purchase_channel with each purchase.
    """
    gross = F.round(F.col("unit_price") * F.col("quantity"), 2).try_cast("decimal(12,2)")
    purchases = (
        events.where(F.col("event_type") == "purchase")
        .join(products.select("product_id", "unit_price", "vendor_id"), "product_id")
        .join(users.select("user_id", "province", "city"), "user_id")
        .withColumn("gross_amount", gross)
    )
    net = F.round(F.col("gross_amount") - F.col("exact_discount"), 2)
    return (
        best_valid_discount(purchases, discounts, clock=events)
        .withColumns(
            {
                "order_id": surrogate_id("event_id"),
                "net_amount": F.when(net.isNotNull(), F.greatest(net, F.lit(0))).cast("decimal(12,2)"),
                "order_date": F.to_date("event_ts"),
                "time_id": date_key(F.to_date("event_ts")),
                "order_status": status_by_age(F.col("event_ts"), F.lit(as_of).cast("timestamp")),
            }
        )
        .select(*FACT_ORDER.fieldNames())
    )


_ATTRIBUTES = StructType([StructField("color", StringType()), StructField("size", StringType())])


def product_attributes(products: DataFrame) -> DataFrame:
    """Both ends of each product's category path, and colour and size out of its JSON attributes."""
    attributes = F.from_json("implicit_attributes", _ATTRIBUTES)
    return products.select(
        "product_id",
        main_category("category").alias("main_category"),
        leaf_category("category").alias("sub_category"),
        attributes.alias("a"),
    ).select("product_id", "main_category", "sub_category", "a.color", "a.size")


def vendor_areas(vendors: DataFrame) -> DataFrame:
    """One row per vendor and distribution area."""
    return vendors.select("vendor_id", F.explode("distribution_areas").alias("distribution_area"))


def attribute_leaves(products: DataFrame, attributes: str = "implicit_attributes") -> DataFrame:
    """(product_id, path, value) of every leaf of each product's JSON attributes, whatever they are called.

    Paths are found in the data: names are joined by dots, list positions stand in brackets. The JSON becomes a
    variant, and each round opens what the last one found to be an object or a list, so there are as many
    rounds as the deepest value has levels. A JSON null is a leaf without a value; text that is no JSON, and
    empty objects and lists, have no leaves.
    """
    kind = F.schema_of_variant("node")
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    level = products.select("product_id", F.lit("").alias("path"), F.try_parse_json(attributes).alias("node"))
    level = level.where(F.col("node").isNotNull())
    found = []
    while True:
        found.append(level.where(~nested).select("product_id", "path", F.try_variant_get("node", "$", "string").alias("value")))
        inner = level.where(nested)
        if inner.isEmpty():
            return reduce(DataFrame.union, found)
        named = F.map_entries(F.try_variant_get("node", "$", "map<string,variant>"))
        listed = F.try_variant_get("node", "$", "array<variant>")
        below = F.when(F.col("path") == "", F.lit("")).otherwise(F.concat("path", F.lit(".")))
        fields = F.transform(named, lambda x: F.struct(F.concat(below, x["key"]).alias("path"), x["value"].alias("node")))
        items = F.transform(
            listed, lambda x, i: F.struct(F.concat("path", F.lit("["), i.cast("string"), F.lit("]")).alias("path"), x.alias("node"))
        )
        level = inner.select("product_id", F.inline(F.coalesce(fields, items)))
