from decimal import Decimal


from riverbend.functions.text import head_before
from riverbend.operators import report

INC = "DISTRICT string, OFFENSE_CODE long, MONTH int, LAT decimal(38,18), LONG decimal(38,18)"
CODES = "CODE long, NAME string"


def test_head_before_edges(spark):
    df = spark.createDataFrame([("LARCENY - SHOPLIFTING",), ("-",), (None,), ("A-B-C",)], "n string")
    got = [r[0] for r in df.select(head_before("n")).collect()]
    assert got == ["LARCENY", "", None, "A"]


def test_code_with_two_names_fans_out(spark):
    codes = spark.createDataFrame([(1, "A - x"), (1, "A - y")], CODES)
    inc = spark.createDataFrame([("D1", 1, 1, Decimal("1.0"), Decimal("2.0"))], INC)
    fan = report.incident_report(inc, codes).collect()
    assert fan[0]["crimes_total"] == 2
    one = report.incident_report(inc, codes, dedupe_key=True).collect()
    assert one[0]["crimes_total"] == 1


def test_null_district_absent(spark):
    codes = spark.createDataFrame([(1, "A - x")], CODES)
    inc = spark.createDataFrame([(None, 1, 1, Decimal("1"), Decimal("1")),
                                 ("D1", 1, 1, Decimal("1"), Decimal("1"))], INC)
    rows = report.incident_report(inc, codes).collect()
    assert [r["DISTRICT"] for r in rows] == ["D1"]


def test_top3_order_and_ties(spark):
    codes = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], CODES)
    counts = {1: 9, 3: 9, 2: 5, 4: 1}
    inc = spark.createDataFrame(
        [("D", code, 1, Decimal("0"), Decimal("0")) for code, n in counts.items() for _ in range(n)], INC)
    row = report.incident_report(inc, codes).collect()[0]
    assert row["frequent_crime_types"] == "a, c, b"


def test_monthly_median_is_a_member(spark):
    inc = spark.createDataFrame(
        [("D", 1, m, Decimal("0"), Decimal("0")) for m, n in {1: 1, 2: 2, 3: 3, 4: 10}.items()
         for _ in range(n)], INC)
    assert report.monthly_median(inc).collect()[0]["crimes_monthly"] == 2


def test_mean_location(spark):
    codes = spark.createDataFrame([(1, "a")], CODES)
    inc = spark.createDataFrame([("D", 1, 1, Decimal("1.5"), Decimal("-2")),
                                 ("D", 1, 2, Decimal("2.5"), None)], INC)
    row = report.incident_report(inc, codes).collect()[0]
    assert row["lat"] == Decimal("2") and row["lng"] == Decimal("-2")


def test_district_dimension_path_equals_direct_path(spark):
    from riverbend.plans import tables as tb
    from conftest import SF_SMALL
    t = tb.Tables(spark, SF_SMALL)
    direct = report.incident_report(tb.incidents_from_tables(t), tb.codes_from_tables(t), name_sep=" ")
    districts = tb.supplier_district(t).withColumnRenamed("s_suppkey", "l_suppkey")
    via_dim = report.incident_report(tb.incident_facts(t), tb.codes_from_tables(t), name_sep=" ",
                                     districts=districts, district_key="l_suppkey")
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, via_dim.collect()))


def test_sql_report_keeps_the_scale_of_the_coordinates(spark):
    from decimal import Decimal
    from riverbend.plans.sql_views import incident_report_sql
    inc = spark.createDataFrame([("A", 1, 1, Decimal("42.3601"), Decimal("-71.0589"))],
                                "DISTRICT string, OFFENSE_CODE long, MONTH int, LAT decimal(38,18), LONG decimal(38,18)")
    codes = spark.createDataFrame([(1, "X-Y")], "CODE long, NAME string")
    before = {t.name for t in spark.catalog.listTables()}
    row = incident_report_sql(spark, inc, codes).first()
    assert (round(row.lat, 4), round(row.lng, 4)) == (Decimal("42.3601"), Decimal("-71.0589"))
    assert {t.name for t in spark.catalog.listTables()} == before
