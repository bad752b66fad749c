"""Date predicates and reports; text and Parquet inputs give the same reports."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from quern.functions.dates import date_after, date_before, in_date_fragment, month_of
from quern.operators import reports
from quern.sources.tables import scan_delimited, scan_parquet

FOLDER = "/root/testdata/sf0.001"
DAYS = ["1995-12-31", "1996-01-01", "1996-01-02", "1996-01-31", "1996-02-01", "1997-01-02"]
KINDS = ["string", "date", "timestamp", "timestamp_ntz"]


def days(spark, kind):
    return spark.createDataFrame([(d,) for d in DAYS], "text string").select(
        "text", F.col("text").cast(kind).alias("d")
    )


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize(
    "fragment", ["1996-01-02", "1996-01", "1996", "01-02", "-01-", "1996-13", "96", "1996-02-30", ""]
)
def test_fragment_is_a_substring_test(spark, kind, fragment):
    rows = days(spark, kind)
    got = [r.text for r in rows.where(in_date_fragment(rows, "d", fragment)).collect()]
    assert got == [d for d in DAYS if fragment in d]


@pytest.mark.parametrize("kind", KINDS)
@pytest.mark.parametrize("text", ["1996-01-02", "1996-01", "1996", "1996-1", "1996-01-99"])
def test_before_and_after_compare_text(spark, kind, text):
    rows = days(spark, kind)
    before = [r.text for r in rows.where(date_before(rows, "d", text)).collect()]
    after = [r.text for r in rows.where(date_after(rows, "d", text)).collect()]
    assert before == [d for d in DAYS if d < text]
    assert after == [d for d in DAYS if d > text]


@pytest.mark.parametrize("kind", KINDS)
def test_month(spark, kind):
    rows = days(spark, kind)
    assert [r[0] for r in rows.select(month_of(rows, "d")).collect()] == [d[:7] for d in DAYS]


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    """Every table once as Parquet and once as delimited text with a trailing delimiter."""
    folder = str(tmp_path_factory.mktemp("tbl"))
    parquet, text = {}, {}
    for name in ("lineitem", "orders", "customer", "nation", "part", "supplier"):
        rows = scan_parquet(spark, FOLDER, name)
        parquet[name] = rows
        plain = rows.select(
            *[
                F.date_format(f.name, "yyyy-MM-dd").alias(f.name)
                if f.dataType.typeName().startswith("timestamp")
                else F.col(f.name)
                for f in rows.schema
            ]
        )
        plain.withColumn("end", F.lit("")).write.option("sep", "|").option("emptyValue", "").csv(
            f"{folder}/{name}.tbl"
        )
        text[name] = scan_delimited(spark, folder, name, plain.schema)
        if "o_orderdate" in text[name].columns:
            text[name] = text[name].withColumn("o_orderdate", F.to_date("o_orderdate"))
    return parquet, text


def all_reports(t):
    line, order, cust, nation = t["lineitem"], t["orders"], t["customer"], t["nation"]
    day, month = "1996-01-02", "1996-01"
    yield reports.shipdate_count(line, day)
    yield reports.orders_by_shipdate(line, order, month, "o_orderpriority")
    yield reports.orders_by_shipdate_semi(line, order, month, "o_orderpriority")
    yield reports.part_supplier_by_shipdate(line, t["part"], t["supplier"], month)
    yield reports.nation_shipments(line, order, cust, nation, month)
    yield reports.nation_monthly_shipments(line, order, cust, nation, ["NATION_2", "NATION_3"])
    yield reports.pricing_summary(line, month)
    yield reports.unshipped_revenue_topk(line, order, cust, day, "o_orderpriority")


def test_text_equals_parquet(both):
    parquet, text = both
    for a, b in zip(all_reports(parquet), all_reports(text)):
        assert a.columns == b.columns
        found = a.collect()
        assert found and found == b.collect()


def test_trailing_delimiter(spark, tmp_path):
    (tmp_path / "t.tbl").write_text("1|x|\n2|y|\n")
    schema = spark.createDataFrame([], "k bigint, v string").schema
    assert [tuple(r) for r in scan_delimited(spark, str(tmp_path), "t", schema).collect()] == [
        (1, "x"), (2, "y"),
    ]


def test_no_match_counts_zero(both):
    assert reports.shipdate_count(both[0]["lineitem"], "1890-01-01").first().n == 0


def test_heavy_order_fills_the_report(spark):
    line = spark.range(1000).select(
        F.lit(1).cast("bigint").alias("l_orderkey"), F.lit(date(1996, 1, 2)).alias("l_shipdate")
    )
    order = spark.createDataFrame([(1, "c1"), (2, "c2")], "o_orderkey bigint, o_clerk string")
    got = reports.orders_by_shipdate(line, order, "1996-01-02").collect()
    assert [tuple(r) for r in got] == [("c1", 1)] * 20
    assert reports.orders_by_shipdate_semi(line, order, "1996-01-02").count() == 1
