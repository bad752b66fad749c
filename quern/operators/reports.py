"""Shipment and revenue reports over the order tables.

Line items are the large side everywhere, so they are filtered at the scan, cut to
the columns in use and, where the join key is all they are grouped by, summed per
order before they meet another table: the sum and the join then share one shuffle, no
key repeats on either side, and a single heavy order or customer cannot make a heavy
task. Joins carry no hints: small sides are found and broadcast by their measured size
at run time, anything else is shuffled, and adaptive execution splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.dates import date_after, date_before, in_date_fragment, month_of


def _day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd")


def _money(total: Column) -> Column:
    """A sum rounded to cents; noise beyond six digits must not decide which way."""
    return F.round(F.round(total, 6), 2)


def shipdate_filter(lineitem: DataFrame, date: str) -> DataFrame:
    """Line items whose ship date contains ``date``."""
    return lineitem.where(in_date_fragment(lineitem, "l_shipdate", date))


def ordered_before_shipped_after(lineitem: DataFrame, orders: DataFrame, date: str) -> DataFrame:
    """Orders placed before the date with the number of their lines shipped after it."""
    open_lines = (
        lineitem.where(date_after(lineitem, "l_shipdate", date))
        .groupBy("l_orderkey")
        .agg(F.count("*").alias("open_lines"))
    )
    early = orders.where(date_before(orders, "o_orderdate", date))
    return early.join(open_lines, early.o_orderkey == open_lines.l_orderkey).select(
        "o_orderkey", _day("o_orderdate").alias("o_orderdate"), "open_lines"
    )


def monthly_lines(lineitem: DataFrame) -> DataFrame:
    """Number of line items per month of shipping."""
    return lineitem.groupBy(month_of(lineitem, "l_shipdate").alias("month")).agg(
        F.count("*").alias("n")
    )


def shipdate_count(lineitem: DataFrame, date: str) -> DataFrame:
    """How many line items were shipped on the date; 0 when none."""
    return shipdate_filter(lineitem, date).agg(F.count("*").alias("n"))


def orders_by_shipdate(
    lineitem: DataFrame, orders: DataFrame, date: str, clerk: str = "o_clerk", limit: int = 20
) -> DataFrame:
    """``(clerk, o_orderkey)`` for each line shipped on the date, first by order key.

    Lines are counted per order before the join and laid out again after it. No order
    can fill more than ``limit`` places, so no more copies than that are made.
    """
    lines = (
        shipdate_filter(lineitem, date)
        .groupBy("l_orderkey")
        .agg(F.least(F.count("*"), F.lit(limit)).cast("int").alias("copies"))
    )
    return (
        orders.select("o_orderkey", F.col(clerk).alias("clerk"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .select("clerk", "o_orderkey", "copies")
        .orderBy("o_orderkey", "clerk")
        .limit(limit)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
        .orderBy("o_orderkey", "clerk")
        .limit(limit)
        .select("clerk", "o_orderkey")
    )


def orders_by_shipdate_semi(
    lineitem: DataFrame, orders: DataFrame, date: str, clerk: str = "o_clerk", limit: int = 20
) -> DataFrame:
    """As ``orders_by_shipdate``, one row per order however many lines it has."""
    lines = shipdate_filter(lineitem, date).select("l_orderkey")
    return (
        orders.select(F.col(clerk).alias("clerk"), "o_orderkey")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
        .orderBy("o_orderkey", "clerk")
        .limit(limit)
    )


def part_supplier_by_shipdate(
    lineitem: DataFrame, part: DataFrame, supplier: DataFrame, date: str, limit: int = 20
) -> DataFrame:
    """``(order key, part name, supplier name)`` of lines shipped on the date.

    The first ``limit`` lines are chosen before their names are looked up. They are
    the side that is broadcast: at most ``limit`` rows, so the part and supplier
    tables are read once each and never shuffled.
    """
    chosen = (
        shipdate_filter(lineitem, date)
        .select("l_orderkey", "l_partkey", "l_suppkey")
        .orderBy("l_orderkey", "l_partkey", "l_suppkey")
        .limit(limit)
    )
    with_part = F.broadcast(chosen).join(
        part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")
    )
    return (
        F.broadcast(with_part)
        .join(supplier.select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "p_name", "s_name")
        .orderBy("l_orderkey", "p_name", "s_name")
    )


def _lines_per_customer(lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines per customer: summed per order, joined, summed again."""
    per_order = lines.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    return (
        per_order.join(
            orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
        )
        .groupBy("o_custkey")
        .agg(F.sum("n").alias("n"))
    )


def nation_shipments(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, date: str
) -> DataFrame:
    """``(nation key, name, lines shipped on the date)`` by the customer's nation."""
    per_customer = _lines_per_customer(shipdate_filter(lineitem, date), orders)
    per_nation = (
        per_customer.join(
            customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
        )
        .groupBy("c_nationkey")
        .agg(F.sum("n").alias("n"))
    )
    return (
        per_nation.join(
            nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey")
        )
        .select("n_nationkey", "n_name", "n")
        .orderBy("n_nationkey")
    )


def nation_monthly_shipments(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    nation: DataFrame,
    nations: Sequence[str],
) -> DataFrame:
    """Lines per month of shipping for the customers of the named nations, all dates.

    Nothing bounds the line items here, so the narrow tables go first: orders are cut
    to the customers of the named nations before they meet the line items. Lines of an
    order rarely share a month; summing by (order, month) first would be a second
    shuffle of all of them, so they are joined as they are and summed by nation after.
    """
    named = nation.where(F.col("n_name").isin(list(nations))).select("n_nationkey", "n_name")
    buyers = customer.select("c_custkey", "c_nationkey").join(
        named, F.col("c_nationkey") == F.col("n_nationkey")
    )
    wanted = (
        orders.select("o_orderkey", "o_custkey")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "n_nationkey", "n_name")
    )
    lines = lineitem.select("l_orderkey", month_of(lineitem, "l_shipdate").alias("month"))
    return (
        lines.join(wanted, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("n_nationkey", "n_name", "month")
        .agg(F.count("*").alias("n"))
        .orderBy("n_nationkey", "month")
    )


def pricing_summary(lineitem: DataFrame, date: str) -> DataFrame:
    """Sums and averages per (return flag, line status) of the lines shipped on the date."""
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        shipdate_filter(lineitem, date)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            _money(F.sum("l_quantity")).alias("sum_qty"),
            _money(F.sum("l_extendedprice")).alias("sum_base_price"),
            _money(F.sum(net)).alias("sum_disc_price"),
            _money(F.sum(net * (1 + F.col("l_tax")))).alias("sum_charge"),
            F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
            F.round(F.avg("l_extendedprice"), 6).alias("avg_price"),
            F.round(F.avg("l_discount"), 6).alias("avg_disc"),
            F.count("*").alias("count_order"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


def unshipped_revenue_topk(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    date: str,
    priority: str = "o_shippriority",
    limit: int = 10,
) -> DataFrame:
    """Largest revenues of orders placed before the date and shipped after it.

    Revenue is summed per order before the join. The customer's name is looked up for
    the ``limit`` chosen orders only: they are broadcast to one pass over customers.
    """
    revenue = (
        lineitem.where(date_after(lineitem, "l_shipdate", date))
        .groupBy("l_orderkey")
        .agg(
            _money(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount")))).alias("revenue")
        )
    )
    early = orders.where(date_before(orders, "o_orderdate", date)).select(
        "o_orderkey", "o_custkey", "o_orderdate", F.col(priority).alias("priority")
    )
    largest = (
        early.join(revenue, F.col("o_orderkey") == F.col("l_orderkey"))
        .orderBy(F.desc("revenue"), "o_orderkey")
        .limit(limit)
    )
    return (
        F.broadcast(largest)
        .join(customer.select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            "c_name",
            "o_orderkey",
            "revenue",
            _day("o_orderdate").alias("o_orderdate"),
            "priority",
        )
        .orderBy(F.desc("revenue"), "o_orderkey")
    )
