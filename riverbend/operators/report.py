"""Per-district incident report (domain A).

Output per district: total incidents, median monthly count, the most frequent
incident types as text, and the mean location.

Plan shape (one pass over the facts):

* the code dimension is de-duplicated and cleaned, then joined to the facts
  (broadcast only when a bounded count proves it small);
* the joined facts are aggregated once at the finest grain the three
  measures need, ``(DISTRICT, MONTH, NAME)``, with a map-side partial
  aggregate, so a hot district is combined inside each scan task;
* that small aggregate is written once to the shared scratch folder
  (lineage cut) and the measures are derived from it: totals, means and
  the median in one chain (per month, then per district), the top-k list
  in another;
* the top-k list uses ``row_number() <= k``, which Spark executes with a
  partial per-task group limit before the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverbend.functions.text import head_before, top_k_text
from riverbend.session import materialize

# Fixed values of the reference report: three types, joined by ", ".
TOP_K = 3
LIST_SEP = ", "


def clean_codes(codes: DataFrame, name_sep: str = "-", dedupe_key: bool = False) -> DataFrame:
    """``(CODE, NAME)`` with NAME cut to its head before ``name_sep``.

    The reference de-duplicates on the pair, so a code with two names fans
    a join out; ``dedupe_key=True`` keeps one name per code (the smallest).
    """
    pairs = codes.select("CODE", "NAME")
    if dedupe_key:
        pairs = pairs.groupBy("CODE").agg(F.min("NAME").alias("NAME"))
    else:
        pairs = pairs.distinct()
    return pairs.select("CODE", head_before("NAME", name_sep).alias("NAME"))


def top_k_per_group(counts: DataFrame, group: str, item: str, count: str,
                    k: int = TOP_K, sep: str = LIST_SEP, out: str = "items") -> DataFrame:
    """Per group, the k items with the highest count (ties: item ascending), as text."""
    w = Window.partitionBy(group).orderBy(F.col(count).desc(), F.col(item).asc())
    ranked = counts.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k)
    return ranked.groupBy(group).agg(top_k_text("_rank", item, sep).alias(out))


def incident_report(incidents: DataFrame, codes: DataFrame, *, name_sep: str = "-",
                    dedupe_key: bool = False, top_k: int = TOP_K, list_sep: str = LIST_SEP,
                    districts: DataFrame | None = None,
                    district_key: str | None = None) -> DataFrame:
    """Report over ``incidents(DISTRICT, OFFENSE_CODE, MONTH, LAT, LONG)`` and
    ``codes(CODE, NAME)``.

    When the district comes from a dimension (``districts(district_key,
    DISTRICT)``, incidents carrying ``district_key`` instead of ``DISTRICT``),
    the codes are joined first and the facts pre-aggregated on
    ``(district_key, MONTH, NAME)`` before the district join, so that join
    shuffles partial aggregates instead of incident rows.  Sums and counts
    add up across the join, fan-out included, so the result is the same.

    Columns: ``DISTRICT, crimes_total, crimes_monthly, frequent_crime_types,
    lat, lng``.  Whether the code dimension is broadcast the planner decides from the size
    estimate (``spark.sql.autoBroadcastJoinThreshold``) and AQE from the real
    size, with a shuffle join beyond either.  A null district is grouped but dropped by the final inner
    joins, as in the reference.  ``crimes_monthly`` is the approximate
    median (a member of the set) of the per-month counts; months of
    different years are pooled.
    """
    dim = clean_codes(codes, name_sep, dedupe_key)
    joined = incidents.join(dim, incidents["OFFENSE_CODE"] == dim["CODE"], "inner")

    if districts is None:
        fine = joined.groupBy("DISTRICT", "MONTH", "NAME").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("LAT").alias("s_lat"), F.count("LAT").alias("c_lat"),
            F.sum("LONG").alias("s_lng"), F.count("LONG").alias("c_lng"),
        )
    else:
        pre = joined.groupBy(district_key, "MONTH", "NAME").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("LAT").alias("s_lat"), F.count("LAT").alias("c_lat"),
            F.sum("LONG").alias("s_lng"), F.count("LONG").alias("c_lng"),
        )
        dist = districts.select(F.col(district_key).alias("_dk"), "DISTRICT")
        fine = (pre.join(dist, pre[district_key] == dist["_dk"], "left")
                   .groupBy("DISTRICT", "MONTH", "NAME")
                   .agg(F.sum("n").alias("n"), F.sum("s_lat").alias("s_lat"),
                        F.sum("c_lat").alias("c_lat"), F.sum("s_lng").alias("s_lng"),
                        F.sum("c_lng").alias("c_lng")))
    # small (districts x months x names); saved once so the facts are
    # scanned once although two branches read it
    fine = materialize(fine, "report-fine")

    per_month = fine.groupBy("DISTRICT", "MONTH").agg(
        F.sum("n").alias("n"), F.sum("s_lat").alias("s_lat"), F.sum("c_lat").alias("c_lat"),
        F.sum("s_lng").alias("s_lng"), F.sum("c_lng").alias("c_lng"))
    totals = per_month.groupBy("DISTRICT").agg(
        F.sum("n").alias("crimes_total"),
        F.percentile_approx("n", 0.5).alias("crimes_monthly"),
        exact_mean(F.sum("s_lat"), F.sum("c_lat"), incidents.schema["LAT"].dataType).alias("lat"),
        exact_mean(F.sum("s_lng"), F.sum("c_lng"), incidents.schema["LONG"].dataType).alias("lng"),
    )
    types = top_k_per_group(
        fine.groupBy("DISTRICT", "NAME").agg(F.sum("n").alias("counts")),
        "DISTRICT", "NAME", "counts", top_k, list_sep, out="frequent_crime_types")

    return (totals.join(types, "DISTRICT", "inner")
                  .select("DISTRICT", "crimes_total", "crimes_monthly",
                          "frequent_crime_types", "lat", "lng"))


def exact_mean(total: F.Column, count: F.Column, dtype) -> F.Column:
    """``total / count``.  For decimals the sum is first narrowed to 20 integer
    digits, which leaves Spark's decimal division 18 fractional digits (the
    default rules would keep only 6 and a later rounding could round twice)."""
    if isinstance(dtype, T.DecimalType):
        scale = dtype.scale
        return total.cast(T.DecimalType(min(38, scale + 20), scale)) / count
    return total / count


def counts_by_district(rows: DataFrame, by: list[str], districts: DataFrame | None = None,
                       district_key: str | None = None, out: str = "counts") -> DataFrame:
    """Row counts per ``(DISTRICT, *by)``.  With a district dimension the rows
    are counted per ``(district_key, *by)`` first and only those counts are
    joined and summed."""
    if districts is None:
        return rows.groupBy("DISTRICT", *by).agg(F.count(F.lit(1)).alias(out))
    pre = rows.groupBy(district_key, *by).agg(F.count(F.lit(1)).alias(out))
    dist = districts.select(F.col(district_key).alias("_dk"), "DISTRICT")
    return (pre.join(dist, pre[district_key] == dist["_dk"], "left")
               .groupBy("DISTRICT", *by).agg(F.sum(out).alias(out)))


def monthly_median(incidents: DataFrame, districts: DataFrame | None = None,
                   district_key: str | None = None) -> DataFrame:
    """``(DISTRICT, crimes_monthly)``: approximate median of per-month counts."""
    return (counts_by_district(incidents, ["MONTH"], districts, district_key)
            .groupBy("DISTRICT")
            .agg(F.percentile_approx("counts", 0.5).alias("crimes_monthly")))
