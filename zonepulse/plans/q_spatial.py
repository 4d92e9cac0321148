"""Queries for spatial clustering on the ``hubs`` view (rows 65-69)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import spatial as SP
from ..sources.tables import load_view
from .registry import register

# known DBSCAN answer: hubs numbered by their smallest non-noise record id, noise -1
DBSCAN_TRUTH = """(SELECT h.record_id, h.latitude, h.longitude,
   CASE WHEN h.is_noise THEN -1 ELSE CAST(r.rk - 1 AS INTEGER) END AS cluster_id
 FROM hubs h LEFT JOIN (SELECT hub, dense_rank() OVER (ORDER BY min(record_id)) AS rk
                        FROM hubs WHERE NOT is_noise GROUP BY hub) r ON h.hub = r.hub)"""


def _hubs(spark, sf):
    return load_view(spark, sf, "hubs")


# the isolated points lie far from the hubs and form a sixth group, the last one by latitude
@register("cluster_kmeans", "SELECT record_id, CASE WHEN is_noise THEN 5 ELSE hub END AS cluster_id FROM hubs",
          ("hubs",))
def cluster_kmeans(spark, sf):
    out, _ = SP.kmeans(_hubs(spark, sf).select("record_id", "latitude", "longitude"), 6)
    return out.select("record_id", "cluster_id")


@register("cluster_auto_k", "SELECT CAST(k AS INTEGER) AS k, k = 6 AS is_best FROM range(2, 21) t(k)")
def cluster_auto_k(spark, sf):
    table = SP.auto_k(_hubs(spark, sf).select("record_id", "latitude", "longitude"), max_clusters=20)
    return table.select("k", (F.col("k") == SP.best_k(table)).alias("is_best"))


_SIL = """
WITH p AS (SELECT cluster_id AS c, latitude AS x, longitude AS y, row_number() OVER () AS i
           FROM {src} WHERE latitude IS NOT NULL AND longitude IS NOT NULL),
s AS (SELECT c, count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x*x + y*y) AS sq FROM p GROUP BY c),
d AS (SELECT p.i, p.c AS pc, s.c AS sc, s.n,
             (p.x*p.x + p.y*p.y) - 2*(p.x*s.sx + p.y*s.sy)/s.n + s.sq/s.n AS md
      FROM p CROSS JOIN s),
ab AS (SELECT i, max(CASE WHEN sc = pc THEN n END) AS n_own,
              max(CASE WHEN sc = pc AND n > 1 THEN md * n / (n - 1) END) AS a,
              min(CASE WHEN sc <> pc THEN md END) AS b
       FROM d GROUP BY i)
SELECT round(avg(CASE WHEN n_own <= 1 THEN 0.0 WHEN a < b THEN 1 - a/b WHEN a > b THEN b/a - 1
                      ELSE 0.0 END), 6) AS silhouette FROM ab"""

HUB_LABELS = ("(SELECT CASE WHEN is_noise THEN -1 ELSE hub END AS cluster_id, latitude, longitude "
              "FROM hubs)")


@register("cluster_silhouette", _SIL.format(src=HUB_LABELS), ("hubs",))
def cluster_silhouette(spark, sf):
    df = _hubs(spark, sf).select(
        F.when(F.col("is_noise"), F.lit(-1)).otherwise(F.col("hub")).alias("cluster_id"),
        "latitude", "longitude")
    return SP.silhouette(df).select(F.round("silhouette", 6).alias("silhouette"))


_EUCLIDEAN = """
WITH p AS (SELECT cluster_id AS c, latitude AS x, longitude AS y, count(*) AS m FROM {src}
           WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3),
s AS (SELECT c, sum(m) AS n FROM p GROUP BY c),
d AS (SELECT p.c, p.x, p.y, p.m, q.c AS k, sum(q.m * sqrt((p.x - q.x) * (p.x - q.x) + (p.y - q.y) * (p.y - q.y))) AS t
      FROM p CROSS JOIN p q GROUP BY 1, 2, 3, 4, 5),
ab AS (SELECT d.c, x, y, m, max(CASE WHEN k = d.c THEN n END) AS n_own, max(CASE WHEN k = d.c AND n > 1 THEN t / (n - 1) END) AS a,
              min(CASE WHEN k <> d.c THEN t / n END) AS b FROM d JOIN s ON d.k = s.c GROUP BY 1, 2, 3, 4)
SELECT round(sum(m * CASE WHEN n_own = 1 OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) / sum(m), 6) AS silhouette,
       true AS within_a_thousandth FROM ab"""


@register("cluster_silhouette_euclidean", _EUCLIDEAN.format(src=HUB_LABELS), ("hubs",))
def cluster_silhouette_euclidean(spark, sf):
    from ..operators.silhouette import euclidean
    df = _hubs(spark, sf).select(
        F.when(F.col("is_noise"), F.lit(-1)).otherwise(F.col("hub")).alias("cluster_id"),
        "latitude", "longitude")
    return euclidean(df).select(F.round("silhouette", 6).alias("silhouette"), (F.col("bound") < 0.001).alias("within_a_thousandth"))


@register("cluster_dbscan", f"SELECT record_id, cluster_id FROM {DBSCAN_TRUTH}", ("hubs",))
def cluster_dbscan(spark, sf):
    df = _hubs(spark, sf).select("record_id", "latitude", "longitude")
    return SP.dbscan(df, 0.01, 5).select("record_id", "cluster_id")


@register("cluster_metadata", f"""
WITH t AS {DBSCAN_TRUTH},
sil AS ({_SIL.format(src='t')})
SELECT 'dbscan' AS method, cluster_id, CAST(count(*) AS BIGINT) AS n,
  round(CAST(avg(CAST(latitude AS DECIMAL(38,15))) AS DOUBLE), 6) AS center_lat,
  round(CAST(avg(CAST(longitude AS DECIMAL(38,15))) AS DOUBLE), 6) AS center_lon,
  CAST(count(*) OVER () AS BIGINT) AS n_clusters, (SELECT silhouette FROM sil) AS silhouette
FROM t WHERE cluster_id <> -1 GROUP BY cluster_id""", ("hubs",))
def cluster_metadata(spark, sf):
    df = _hubs(spark, sf).select("record_id", "latitude", "longitude")
    out, meta = SP.cluster(df, method="dbscan", exact=True)
    return meta.select("method", "cluster_id", "n", F.round("center_lat", 6).alias("center_lat"),
                       F.round("center_lon", 6).alias("center_lon"), "n_clusters",
                       F.round("silhouette", 6).alias("silhouette"))
