"""Session funnel, behaviour profile and coupon targeting from the event log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.functions.columns import half_up, main_category, ratio
from martlight.functions.distribution import salted

# Channels counted as social influence.
SOCIAL_CHANNELS = ["social_media", "affiliate"]

# Cuts of each bound of a dominance grid, and keys that one cell's rows are dealt to.
GRID_CUTS = 11
STRATEGY_SALTS = 8


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def session_funnel(events: DataFrame) -> DataFrame:
    """Sessions reaching each stage view, cart, purchase (each with all before it) and step rates."""
    per_session = events.groupBy("session_id").agg(
        F.coalesce(F.bool_or(_is("view")), F.lit(False)).alias("viewed"),
        F.coalesce(F.bool_or(_is("cart_add")), F.lit(False)).alias("carted"),
        F.coalesce(F.bool_or(_is("purchase")), F.lit(False)).alias("bought"),
    )
    return funnel_of_sessions(per_session)


def funnel_of_sessions(sessions: DataFrame) -> DataFrame:
    """The funnel of rows that say for a session whether it ``viewed``, ``carted`` and ``bought``."""
    viewed, carted, bought = F.col("viewed"), F.col("carted"), F.col("bought")
    totals = sessions.agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(viewed).alias("view_sessions"),
        F.count_if(viewed & carted).alias("cart_sessions"),
        F.count_if(viewed & carted & bought).alias("purchase_sessions"),
    )

    def step(to: str, start: str) -> Column:
        return half_up(ratio(F.col(to), F.col(start)), 4)

    return totals.withColumns(
        {
            "view_to_cart_rate": step("cart_sessions", "view_sessions"),
            "cart_to_purchase_rate": step("purchase_sessions", "cart_sessions"),
            "view_to_purchase_rate": step("purchase_sessions", "view_sessions"),
        }
    )


def _session_times(events: DataFrame) -> DataFrame:
    """Per user: event counts and mean whole seconds between the stages of a session."""
    def first(event_type: str) -> Column:
        return F.min(F.when(_is(event_type), F.unix_seconds("event_ts")))

    def wait(end: str, start: str) -> Column:
        seconds = F.col(end) - F.col(start)
        return F.when(seconds > 0, seconds)

    sessions = (
        events.groupBy("user_id", "session_id")
        .agg(
            first("view").alias("view_at"),
            first("cart_add").alias("cart_at"),
            first("purchase").alias("buy_at"),
            F.count_if(_is("purchase")).alias("purchases"),
            F.count(F.lit(1)).alias("events"),
        )
        .withColumns({"research": wait("cart_at", "view_at"), "decision": wait("buy_at", "cart_at")})
    )

    def mean_seconds(column: str) -> Column:
        return half_up(ratio(F.sum(column), F.count(column)), 0).cast("int")

    return sessions.groupBy("user_id").agg(
        mean_seconds("research").alias("avg_research_time"),
        mean_seconds("decision").alias("decision_time"),
        half_up(ratio(F.sum("purchases"), F.sum("events")), 2).cast("decimal(5,2)").alias("purchase_intensity"),
    )


def _order_habits(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Per user: most-bought main category, channels used and share of social orders.

    Orders are counted by user, product and channel before they meet the products, so
    only counts travel, and a user arrives at the last step as a few of them.
    """
    bought = orders.groupBy("user_id", "product_id", "purchase_channel").agg(F.count(F.lit(1)).alias("lines"))
    named = bought.join(products.select("product_id", "category"), "product_id", "left").select(
        "user_id", main_category("category").alias("main_category"), "purchase_channel", "lines"
    )
    named = named.groupBy("user_id", "main_category", "purchase_channel").agg(F.sum("lines").alias("lines"))
    counts = named.groupingSets(
        [["user_id", "main_category"], ["user_id", "purchase_channel"]],
        "user_id",
        "main_category",
        "purchase_channel",
    ).agg(F.sum("lines").alias("n"), (F.grouping("main_category") == 1).alias("by_channel"))

    n, channel, by_channel = F.col("n"), F.col("purchase_channel"), F.col("by_channel")
    category_rank = F.struct((-n).alias("rank"), "main_category")
    favourite = F.min(F.when(~by_channel & F.col("main_category").isNotNull(), category_rank))
    social = F.sum(F.when(by_channel & channel.isin(SOCIAL_CHANNELS), n).otherwise(0))
    return counts.groupBy("user_id").agg(
        favourite["main_category"].alias("preferred_category"),
        F.sort_array(F.collect_list(F.when(by_channel, channel))).alias("channel_preference"),
        half_up(ratio(social, F.sum(F.when(by_channel, n))), 2)
        .cast("decimal(5,2)")
        .alias("social_influence_factor"),
    )


def user_behavior_profile(events: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One profile row per user with events or orders.

    Research time runs from a session's first view to its first cart event,
    decision time from there to its first purchase; sessions without a positive
    time do not count. Ties for the preferred category go to the first name.
    """
    return (
        _session_times(events)
        .join(_order_habits(orders, products), "user_id", "full")
        .select(
            "user_id",
            "avg_research_time",
            "decision_time",
            "purchase_intensity",
            "preferred_category",
            "channel_preference",
            "social_influence_factor",
        )
    )


def user_activity(events: DataFrame, users: DataFrame) -> DataFrame:
    """Discount sensitivity, views and cart additions of every user."""
    counts = events.groupBy("user_id").agg(
        F.count_if(_is("view")).alias("view_count"), F.count_if(_is("cart_add")).alias("cart_count")
    )
    return (
        users.select("user_id", "discount_sensitivity")
        .join(counts, "user_id", "left")
        .na.fill(0, subset=["view_count", "cart_count"])
    )


def _cuts(rows: DataFrame, columns: list[str], cuts: int) -> list[list]:
    """Up to ``cuts`` values of each column, ascending, that part its rows evenly; all values if they are few."""
    asked = [i / (cuts + 1) for i in range(1, cuts + 1)]
    # The least value alone would be cut off by no quantile.
    found = rows.agg(
        *[F.array_append(F.percentile_approx(c, asked, 100 * cuts), F.min(c)).alias(f"_{i}") for i, c in enumerate(columns)]
    ).first()
    return [sorted({v for v in values or [] if v is not None}) for values in found]


def _place(value: Column, cuts: list) -> Column:
    """How many cuts a value reaches; null for a null."""
    return reduce(lambda n, cut: n + (value >= F.lit(cut)).cast("int"), cuts, F.when(value.isNotNull(), 0))


def dominance_candidates(
    left: DataFrame, right: DataFrame, have: list[str], least: list[str], cuts: int = GRID_CUTS, salts: int = STRATEGY_SALTS
) -> DataFrame:
    """Pairs of a row of ``left`` and one of ``right`` that may reach it, and ``_tests``: bounds still to be tested.

    The values that ``right`` asks for cut each bound, so space falls into cells. A left row meets the right
    rows of the cells whose place is no higher than its own in any bound. Where it is higher, the bound
    is reached for certain; where both have one place, it has to be tested. Only pairs
    of cells are listed without data, at most ((cuts + 1) * (cuts + 2) / 2) ** len(have) of them.
    """
    grid = _cuts(right, least, cuts)
    own, asked = [f"_own_{i}" for i in range(len(have))], [f"_asked_{i}" for i in range(len(have))]
    rows = left.withColumns({o: _place(F.col(c), g) for o, c, g in zip(own, have, grid)}).dropna(subset=own)
    wanted = right.withColumns({o: _place(F.col(c), g) for o, c, g in zip(asked, least, grid)}).dropna(subset=asked)
    cells = wanted.select(*asked).distinct()
    for o, a, g in zip(own, asked, grid):
        cells = cells.withColumn(o, F.explode(F.sequence(F.col(a), F.lit(len(g)))))
    rows, cells = salted(rows, cells, spread_by=F.struct(*have), salts=salts)
    met = rows.join(cells, [*own, "_salt"]).join(wanted, asked)
    tests = F.array_compact(F.array(*[F.when(F.col(o) == F.col(a), F.lit(i)) for i, (o, a) in enumerate(zip(own, asked))]))
    return met.withColumn("_tests", tests).drop("_salt", *own, *asked)


def dominance_join(
    left: DataFrame, right: DataFrame, have: list[str], least: list[str], cuts: int = GRID_CUTS, salts: int = STRATEGY_SALTS
) -> DataFrame:
    """Every pair of a row of ``left`` and one of ``right`` where each ``have`` reaches its ``least``; nulls reach nothing.

    Columns of both sides must differ in name.
    """
    met = dominance_candidates(left, right, have, least, cuts, salts)
    tests = [~F.array_contains("_tests", i) | (F.col(h) >= F.col(m)) for i, (h, m) in enumerate(zip(have, least))]
    return met.where(reduce(Column.__and__, tests)).drop("_tests")


def coupon_targeting(
    events: DataFrame, users: DataFrame, strategies: DataFrame, salts: int = STRATEGY_SALTS
) -> DataFrame:
    """One row per user and strategy whose three minimums the user reaches.

    Users who look alike and strategies that ask alike meet once: the distinct triples of
    sensitivity, views and carts are matched by a dominance join, and only matches are joined back to users
    and strategies.
    """
    activity = user_activity(events, users)
    profile = ["discount_sensitivity", "view_count", "cart_count"]
    minimum = ["min_discount_sensitivity", "min_view_count", "min_cart_count"]
    met = dominance_join(
        activity.select(*profile).distinct(), strategies.select(*minimum).distinct(), profile, minimum, salts=salts
    )
    return (
        activity.join(met, profile)
        .join(strategies, minimum)
        .select("user_id", "strategy_id", "trigger_type", "action_type", "coupon_id")
    )
