"""The incident report written as Spark SQL text over temporary views, the
way the reference wrote it, with its defects fixed (explicit rank for the
top-k, list cut on the array, not on the joined text).

Catalyst plans SQL text and DataFrame code the same way; the one step SQL
cannot say is "compute this once for two readers", so the fine aggregate
is written to the shared scratch folder and registered as a view.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from riverbend.session import materialize

FINE_SQL = """
SELECT i.DISTRICT, i.MONTH, c.NAME, count(*) AS n,
       sum(i.LAT) AS s_lat, count(i.LAT) AS c_lat, sum(i.LONG) AS s_lng, count(i.LONG) AS c_lng
FROM {incidents} i
JOIN (SELECT CODE, trim(split(NAME, '\\\\Q{sep}\\\\E')[0]) AS NAME
      FROM (SELECT DISTINCT CODE, NAME FROM {codes})) c
  ON c.CODE = i.OFFENSE_CODE
GROUP BY i.DISTRICT, i.MONTH, c.NAME
"""

REPORT_SQL = """
WITH per_month AS (
  SELECT DISTRICT, MONTH, sum(n) AS n, sum(s_lat) AS s_lat, sum(c_lat) AS c_lat,
         sum(s_lng) AS s_lng, sum(c_lng) AS c_lng
  FROM {fine} GROUP BY DISTRICT, MONTH),
totals AS (
  SELECT DISTRICT, sum(n) AS crimes_total,
         percentile_approx(n, 0.5) AS crimes_monthly,
         CAST(sum(s_lat) AS {lat}) / sum(c_lat) AS lat,
         CAST(sum(s_lng) AS {lng}) / sum(c_lng) AS lng
  FROM per_month GROUP BY DISTRICT),
ranked AS (
  SELECT DISTRICT, NAME,
         row_number() OVER (PARTITION BY DISTRICT ORDER BY counts DESC, NAME ASC) AS rk
  FROM (SELECT DISTRICT, NAME, sum(n) AS counts FROM {fine} GROUP BY DISTRICT, NAME)),
types AS (
  SELECT DISTRICT,
         array_join(transform(array_sort(collect_list(struct(rk, NAME))), x -> x.NAME), ', ')
           AS frequent_crime_types
  FROM ranked WHERE rk <= {k} GROUP BY DISTRICT)
SELECT t.DISTRICT, t.crimes_total, t.crimes_monthly, y.frequent_crime_types, t.lat, t.lng
FROM totals t JOIN types y ON t.DISTRICT = y.DISTRICT
"""


def _sum_type(df: DataFrame, col: str) -> str:
    """Type to narrow a sum to before the division: 20 integer digits for a
    decimal, which keeps its own scale (see ``operators.report.exact_mean``)."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({min(38, kind.scale + 20)},{kind.scale})"
    return "DOUBLE"


def incident_report_sql(spark: SparkSession, incidents: DataFrame, codes: DataFrame,
                        name_sep: str = "-", top_k: int = 3) -> DataFrame:
    """Same result as ``operators.report.incident_report``, built from SQL text
    and temp views, which are dropped once the plans are made."""
    tag = uuid.uuid4().hex[:8]
    inc_v, codes_v, fine_v = f"incidents_{tag}", f"codes_{tag}", f"fine_{tag}"
    incidents.createOrReplaceTempView(inc_v)
    codes.createOrReplaceTempView(codes_v)
    fine = spark.sql(FINE_SQL.format(incidents=inc_v, codes=codes_v, sep=name_sep))
    materialize(fine, "report-fine").createOrReplaceTempView(fine_v)
    out = spark.sql(REPORT_SQL.format(fine=fine_v, k=int(top_k), lat=_sum_type(incidents, "LAT"),
                                      lng=_sum_type(incidents, "LONG")))
    for view in (inc_v, codes_v, fine_v):
        spark.catalog.dropTempView(view)
    return out
