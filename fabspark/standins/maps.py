"""Die-map operators on 8 x 8 maps made from the embedding vectors."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fabspark.operators import diemaps as M
from fabspark.operators import models, splitting, synthesis
from fabspark.standins.common import Registry, round_all, table

R = Registry()
SIDE = 8

# Long form of the maps: one row per die, with its row y and column x.
CELLS_SQL = """cells AS (SELECT vec_id, label, pos, pos // 8 AS y, pos % 8 AS x, CASE WHEN v > 0.1 THEN 2 WHEN abs(v) < 0.02 THEN 0 ELSE 1 END AS die
  FROM (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings))"""
DIST_SQL = "sqrt((y - 4.0) ** 2 + (x - 4.0) ** 2)"


def die(v):
    v = v.cast("double")
    return F.when(v > 0.1, 2).when(F.abs(v) < 0.02, 0).otherwise(1)


def die_maps(spark, d):
    cells = F.transform("embedding", die)
    return table(spark, d, "embeddings").select("vec_id", "label", M.cells_to_binary(cells).alias("map"))


def shaped(spark, d):
    """Maps with their shape, in two shapes of 64 dies."""
    wide = F.col("vec_id") % 2 == 0
    return die_maps(spark, d).select("vec_id", "label", F.struct(
        F.when(wide, 8).otherwise(4).alias("rows"), F.when(wide, 8).otherwise(16).alias("cols"), F.col("map").alias("cells"),
    ).alias("map"))


@R.add(f"""WITH {CELLS_SQL}, g AS (SELECT vec_id, count(*) FILTER (die > 0) AS a, count(*) FILTER (die = 2) AS n,
    count(*) FILTER (die = 2 AND {DIST_SQL} > 3.5 * 0.75) AS e, count(*) FILTER (die = 2 AND {DIST_SQL} < 3.5 * 0.38) AS c,
    avg({DIST_SQL}) FILTER (die = 2) AS r FROM cells GROUP BY 1)
  SELECT vec_id, round(CASE WHEN a > 0 THEN n / a ELSE 0 END, 6) AS defect_density, round(a / 64, 6) AS active_ratio,
    round(e / (n + 1e-9), 6) AS edge_defect_ratio, round(c / (n + 1e-9), 6) AS center_defect_ratio,
    round(coalesce(r, 0), 6) AS radial_mean, CAST(n AS INTEGER) AS defect_count, CAST(a AS INTEGER) AS active_count FROM g""")
def map_features(spark, d):
    maps = die_maps(spark, d).withColumn("f", M.spatial_features(F.col("map"), SIDE, SIDE))
    return round_all(maps.select("vec_id", "f.*"))


@R.add(f"""WITH {CELLS_SQL}, g AS (SELECT vec_id, label, count(*) FILTER (die > 0) AS a, count(*) FILTER (die = 2) AS n,
    count(*) FILTER (die = 2 AND {DIST_SQL} > 3.5 * 0.75) AS e, count(*) FILTER (die = 2 AND {DIST_SQL} < 3.5 * 0.38) AS c
    FROM cells GROUP BY 1, 2)
  SELECT label, count(*) AS n, round(avg(n / a), 6) AS avg_density, round(avg(a / 64), 6) AS avg_active,
    round(avg(e / (n + 1e-9)), 6) AS avg_edge, round(avg(c / (n + 1e-9)), 6) AS avg_center FROM g GROUP BY 1""")
def feature_store_summary(spark, d):
    maps = die_maps(spark, d).select("label", M.spatial_features(F.col("map"), SIDE, SIDE).alias("f"))
    return round_all(maps.groupBy("label").agg(
        F.count("*").alias("n"), F.avg("f.defect_density").alias("avg_density"), F.avg("f.active_ratio").alias("avg_active"),
        F.avg("f.edge_defect_ratio").alias("avg_edge"), F.avg("f.center_defect_ratio").alias("avg_center"),
    ))


@R.add(f"""WITH {CELLS_SQL} SELECT vec_id,
    round(count(*) FILTER (die = 2 AND {DIST_SQL} <= sqrt(32.0) * 0.35) / (count(*) FILTER (die = 2) + 1e-8), 6) AS center_ratio,
    round(count(*) FILTER (die = 2 AND {DIST_SQL} >= sqrt(32.0) * 0.75) / (count(*) FILTER (die = 2) + 1e-8), 6) AS edge_ratio,
    round(count(*) FILTER (die = 2 AND {DIST_SQL} >= sqrt(32.0) * 0.55 AND {DIST_SQL} < sqrt(32.0) * 0.75) / (count(*) FILTER (die = 2) + 1e-8), 6) AS ring_ratio,
    round(count(*) FILTER (die = 2) / (count(*) FILTER (die > 0) + 1e-8), 6) AS defect_density
  FROM cells GROUP BY 1""")
def mechanism_metrics(spark, d):
    maps = die_maps(spark, d).withColumn("f", M.mechanism_metrics(F.col("map"), SIDE, SIDE))
    return round_all(maps.select("vec_id", "f.*"))


@R.add(f"""WITH {CELLS_SQL} SELECT vec_id, round(count(*) FILTER (die = 2) / greatest(count(*) FILTER (die > 0), 1), 6) AS defect_ratio,
  string_agg(DISTINCT CAST(die AS VARCHAR), ',' ORDER BY CAST(die AS VARCHAR)) AS die_values, 1 AS valid FROM cells GROUP BY 1""")
def map_ratio(spark, d):
    return round_all(die_maps(spark, d).select(
        "vec_id", M.defect_ratio(F.col("map")).alias("defect_ratio"),
        F.array_join(M.die_values(F.col("map")), ",").alias("die_values"),
        M.map_validity(F.col("map"), SIDE, SIDE).cast("int").alias("valid"),
    ))


@R.add(f"WITH {CELLS_SQL} SELECT label, CAST(pos AS INTEGER) AS pos, round(avg(CASE WHEN die = 2 THEN 1.0 ELSE 0.0 END), 6) AS mean_value, count(*) AS n_maps FROM cells GROUP BY 1, 2")
def heatmap(spark, d):
    return round_all(M.class_heatmap(die_maps(spark, d), "label", "map"))


@R.add("""SELECT label, CAST(pos AS INTEGER) AS pos, round(avg(abs(v)), 6) AS mean_value, count(*) AS n_maps
  FROM (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) GROUP BY 1, 2""")
def attribution_map(spark, d):
    rows = table(spark, d, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("a"))
    return round_all(M.class_heatmap(rows, "label", "a", kind="array"))


ENTROPY_SQL = """h AS (SELECT label, pos, avg(CASE WHEN die = 2 THEN 1.0 ELSE 0.0 END) + 1e-10 AS m, count(*) AS n FROM cells GROUP BY 1, 2),
  p AS (SELECT label, n, m / sum(m) OVER (PARTITION BY label) AS p FROM h)"""


@R.add(f"WITH {CELLS_SQL}, {ENTROPY_SQL} SELECT label, round(-sum(p * ln(p)), 6) AS spatial_entropy, max(n) AS n_samples FROM p GROUP BY 1")
def spatial_entropy(spark, d):
    return round_all(M.heatmap_entropy(M.class_heatmap(die_maps(spark, d), "label", "map"), "label"))


@R.add(f"""WITH {CELLS_SQL}, {ENTROPY_SQL}, e AS (SELECT label, -sum(p * ln(p)) AS spatial_entropy, max(n) AS n_samples FROM p GROUP BY 1),
  g AS (SELECT vec_id, label, count(*) FILTER (die = 2 AND {DIST_SQL} <= sqrt(32.0) * 0.35) / (count(*) FILTER (die = 2) + 1e-8) AS cr,
    count(*) FILTER (die = 2 AND {DIST_SQL} >= sqrt(32.0) * 0.75) / (count(*) FILTER (die = 2) + 1e-8) AS er,
    count(*) FILTER (die = 2 AND {DIST_SQL} >= sqrt(32.0) * 0.55 AND {DIST_SQL} < sqrt(32.0) * 0.75) / (count(*) FILTER (die = 2) + 1e-8) AS rr,
    count(*) FILTER (die = 2) / (count(*) FILTER (die > 0) + 1e-8) AS dd FROM cells GROUP BY 1, 2)
  SELECT label, round(avg(cr), 6) AS center_ratio, round(avg(er), 6) AS edge_ratio, round(avg(rr), 6) AS ring_ratio,
    round(avg(dd), 6) AS defect_density, round(any_value(spatial_entropy), 6) AS spatial_entropy, any_value(n_samples) AS n_samples
  FROM g JOIN e USING (label) GROUP BY 1""")
def spatial_evidence(spark, d):
    return round_all(M.spatial_evidence(die_maps(spark, d), "label", "map", SIDE, SIDE))


@R.add(f"""WITH {CELLS_SQL}, s AS (SELECT vec_id, pos, die, CASE WHEN vec_id % 2 = 0 THEN 8 ELSE 4 END AS h, CASE WHEN vec_id % 2 = 0 THEN 8 ELSE 16 END AS w FROM cells),
  o AS (SELECT DISTINCT vec_id, h, w, i, j FROM s, range(12) a(i), range(12) b(j))
  SELECT o.vec_id, string_agg(CAST(s.die AS VARCHAR), '' ORDER BY i, j) AS cells FROM o
  JOIN s ON s.vec_id = o.vec_id AND s.pos = (i * o.h // 12) * o.w + (j * o.w // 12) GROUP BY 1""")
def resize_nearest(spark, d):
    resized = shaped(spark, d).withColumn("m", M.resize_nearest(F.col("map"), 12, 12))
    return resized.select("vec_id", F.array_join(M.binary_to_cells(F.col("m")), "").alias("cells"))


@R.add(f"""WITH {CELLS_SQL}, s AS (SELECT vec_id, die, CASE WHEN vec_id % 2 = 0 THEN pos // 8 ELSE pos // 16 END AS y,
    CASE WHEN vec_id % 2 = 0 THEN pos % 8 ELSE pos % 16 END AS x, CASE WHEN vec_id % 2 = 0 THEN 2 ELSE 1 END AS bh, CASE WHEN vec_id % 2 = 0 THEN 2 ELSE 4 END AS bw FROM cells)
  SELECT vec_id, CAST((y // bh) * 4 + x // bw AS INTEGER) AS pos, round(avg(CASE WHEN die = 2 THEN 1.0 ELSE 0.0 END), 6) AS share FROM s GROUP BY 1, 2""")
def resize_area(spark, d):
    resized = shaped(spark, d).select("vec_id", F.posexplode(M.resize_defect_mask(F.col("map"), 4, 4)).alias("pos", "share"))
    return round_all(resized)


@R.add(f"""WITH {CELLS_SQL}, t AS (SELECT vec_id, die, CASE WHEN (vec_id // 2) % 2 = 1 THEN 7 - y ELSE y END AS y,
    CASE WHEN vec_id % 2 = 1 THEN 7 - x ELSE x END AS x, (vec_id // 4) % 4 AS k FROM cells),
  u AS (SELECT vec_id, die, CASE k WHEN 0 THEN y WHEN 1 THEN 7 - x WHEN 2 THEN 7 - y ELSE x END AS y,
    CASE k WHEN 0 THEN x WHEN 1 THEN y WHEN 2 THEN 7 - x ELSE 7 - y END AS x FROM t)
  SELECT vec_id, string_agg(CAST(die AS VARCHAR), '' ORDER BY y, x) AS cells FROM u GROUP BY 1""")
def symmetry(spark, d):
    k = F.col("vec_id")
    turned = M.symmetry(F.col("map"), k % 2, F.floor(k / 2) % 2, F.floor(k / 4) % 4, SIDE)
    return die_maps(spark, d).select("vec_id", F.array_join(M.binary_to_cells(turned), "").alias("cells"))


@R.add(f"""WITH {CELLS_SQL} SELECT vec_id, string_agg(CAST(die AS VARCHAR), '' ORDER BY pos) AS cells,
  round(sum(die / 2.0) / 64, 6) AS mean_value, count(*) AS n_dies FROM cells GROUP BY 1""")
def codec_round_trip(spark, d):
    cells = M.binary_to_cells(F.col("map"))
    total = F.aggregate(M.normalise(cells), F.lit(0.0), lambda a, v: a + v)
    return round_all(die_maps(spark, d).select(
        "vec_id", F.array_join(cells, "").alias("cells"), (total / 64).alias("mean_value"),
        F.size(cells).cast("long").alias("n_dies"),
    ))


@R.add("SELECT count(*) * 2 AS n_copies, count(*) AS n_maps, CAST(0 AS BIGINT) AS changed_density FROM embeddings")
def augmented_copies(spark, d):
    """Copies keep the density of their map."""
    maps = die_maps(spark, d).withColumn("density", M.defect_ratio(F.col("map")))
    copies = M.augmented_copies(maps, "vec_id", "map", 2, SIDE)
    return copies.agg(
        F.count("*").alias("n_copies"), F.count_if(F.col("copy") == 1).alias("n_maps"),
        F.count_if(F.abs(M.defect_ratio(F.col("map")) - F.col("density")) > 1e-12).alias("changed_density"),
    )


STEPS = {
    "Rotate": {"limit": 20, "p": 0.5}, "HorizontalFlip": {"p": 0.5}, "VerticalFlip": {"p": 0.5},
    "CoarseDropout": {"min_holes": 1, "max_holes": 2, "min_height": 2, "max_height": 3, "min_width": 1, "max_width": 4, "fill_value": 0.0, "p": 0.6},
}


def _mix_sql(x):
    first = f"((xor({x}, ({x}) >> 16) * {0x45D9F3B}) & 2147483647)"
    second = f"((xor({first}, {first} >> 15) * {0x2C1B3C6D}) & 2147483647)"
    return f"xor({second}, {second} >> 16)"


def _draws_sql(columns):
    """Columns of draws: name -> (step, number). The inner mix comes as a column ``s<step>``."""
    return ", ".join(f"m31((s{step} + {number}) & 2147483647) / 2147483648.0 AS {name}" for name, (step, number) in columns.items())


_DRAWS = {"h1": (1, 0), "a": (1, 1), "h2": (2, 0), "h3": (3, 0), "h4": (4, 0), "n": (4, 1)} | {
    f"{c}{k}": (4, 2 + 4 * k + i) for k in range(2) for i, c in enumerate(("hh", "ww", "tt", "ll"))}
# Pixels are followed from the result back: dropout, vertical flip, horizontal flip, rotation.
AUGMENT_SQL = f"""WITH {CELLS_SQL}, q0 AS (SELECT vec_id, CAST('0x' || substr(md5(vec_id || ':1'), 1, 15) AS BIGINT) & 2147483647 AS seed FROM embeddings),
  q1 AS (SELECT vec_id, {', '.join(f'm31((seed + {7919 * k}) & 2147483647) AS s{k}' for k in range(1, 5))} FROM q0),
  q2 AS (SELECT vec_id, {_draws_sql(_DRAWS)} FROM q1),
  q3 AS (SELECT *, radians(-20 + 40 * a) AS angle, 1 + floor(2 * n) AS holes, {', '.join(
      f'2 + floor(2 * hh{k}) AS hgt{k}, 1 + floor(4 * ww{k}) AS wid{k}' for k in range(2))} FROM q2),
  q4 AS (SELECT *, {', '.join(f'floor(tt{k} * (8 - hgt{k} + 1)) AS top{k}, floor(ll{k} * (8 - wid{k} + 1)) AS lef{k}' for k in range(2))} FROM q3),
  o AS (SELECT q4.*, pos, pos // 8 AS y, pos % 8 AS x FROM q4, range(64) r(pos)),
  f AS (SELECT *, h4 < 0.6 AND ({' OR '.join(
      f'({k} < holes AND y >= top{k} AND y < top{k} + hgt{k} AND x >= lef{k} AND x < lef{k} + wid{k})' for k in range(2))}) AS hole,
    CASE WHEN h3 < 0.5 THEN 7 - y ELSE y END AS fy, CASE WHEN h2 < 0.5 THEN 7 - x ELSE x END AS fx FROM o),
  g AS (SELECT vec_id, pos, hole, CASE WHEN h1 < 0.5 THEN floor(cos(angle) * (fy - 3.5) + sin(angle) * (fx - 3.5) + 4) ELSE fy END AS gy,
    CASE WHEN h1 < 0.5 THEN floor(cos(angle) * (fx - 3.5) - sin(angle) * (fy - 3.5) + 4) ELSE fx END AS gx FROM f)
  SELECT g.vec_id, CAST(g.pos AS INTEGER) AS pos, CASE WHEN hole THEN 0.0 ELSE coalesce(c.die, 0) / 2.0 END::DOUBLE AS value
  FROM g LEFT JOIN cells c ON c.vec_id = g.vec_id AND c.y = gy AND c.x = gx"""


def _with_mix(sql):
    """DuckDB queries are one statement, so the mix is written out where it is used."""
    while "m31(" in sql:
        at = sql.rindex("m31(")
        end, open_ = at + 4, 1
        while open_:
            open_ += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = sql[:at] + _mix_sql(sql[at + 3:end]) + sql[end:]
    return sql


@R.add(_with_mix(AUGMENT_SQL))
def augmented_images(spark, d):
    """Every pixel after rotation, flips and dropout."""
    images = die_maps(spark, d).select("vec_id", F.posexplode(M.augment_image(F.col("map"), md5_draw(F.col("vec_id"), 1), SIDE, STEPS)).alias("pos", "value"))
    return images.select("vec_id", "pos", F.col("value").cast("double").alias("value"))


def _quadrants():
    """Toy predictor: logits are the defect shares of the four quadrants."""
    def predict(maps: np.ndarray) -> np.ndarray:
        bad = maps == 1.0
        half = maps.shape[1] // 2
        parts = [bad[:, :half, :half], bad[:, :half, half:], bad[:, half:, :half], bad[:, half:, half:]]
        return np.stack([p.sum(axis=(1, 2)) for p in parts], axis=1)
    return predict


@R.add(f"""WITH {CELLS_SQL}, q AS (SELECT vec_id, (y // 4) * 2 + x // 4 AS q, count(*) FILTER (die = 2) AS n FROM cells GROUP BY 1, 2),
  b AS (SELECT vec_id, max(n) AS best FROM q GROUP BY 1)
  SELECT q.vec_id, CAST(min(q) FILTER (n = best) AS INTEGER) AS class_idx, round(1 / sum(exp(CAST(n - best AS DOUBLE))), 6) AS prob
  FROM q JOIN b USING (vec_id) GROUP BY 1""")
def batch_predict(spark, d):
    scored = die_maps(spark, d).withColumn("s", models.batch_predict(F.col("map"), _quadrants, SIDE, SIDE))
    return round_all(scored.select("vec_id", "s.*"))


FEATURES_SQL = f"""g AS (SELECT vec_id, label, count(*) FILTER (die > 0) AS a, count(*) FILTER (die = 2) AS n,
    count(*) FILTER (die = 2 AND {DIST_SQL} > 3.5 * 0.75) AS e FROM cells GROUP BY 1, 2),
  s AS (SELECT vec_id, label, CASE WHEN a > 0 THEN n / a ELSE 0 END AS defect_density, a / 64 AS active_ratio, e / (n + 1e-9) AS edge_defect_ratio FROM g)"""


@R.add(f"""WITH {CELLS_SQL}, {FEATURES_SQL} SELECT label, count(*) AS n, round(sum(defect_density) / (SELECT count(*) FROM s), 6) AS density,
  round(sum(active_ratio) / (SELECT count(*) FROM s), 6) AS active, round(sum(edge_defect_ratio) / (SELECT count(*) FROM s), 6) AS edge,
  0.0::DOUBLE AS gap FROM s GROUP BY 1""")
def tabular_classifier(spark, d):
    """At the best fit the predicted shares, and the features weighted by them, equal those of the labels: the gradient is zero."""
    feats = ["defect_density", "active_ratio", "edge_defect_ratio"]
    rows = die_maps(spark, d).select("label", M.spatial_features(F.col("map"), SIDE, SIDE).alias("f")).select("label", *[f"f.{c}" for c in feats])
    scored = models.tabular_classifier(rows, feats, "label", max_iter=1000, tol=1e-12).transform(rows)
    scored = scored.select("label", *feats, F.posexplode(vector_to_array("prob")).alias("k", "p"))
    own = (F.col("label") == F.col("k")).cast("double")
    means = [F.avg(own * F.col(c)) for c in feats]
    gaps = [F.abs(F.avg(F.col("p")) - F.avg(own)), *[F.abs(F.avg(F.col("p") * F.col(c)) - m) for c, m in zip(feats, means)]]
    return scored.groupBy(F.col("k").alias("label")).agg(
        F.count_if(F.col("label") == F.col("k")).alias("n"), *[F.round(m, 6).alias(out) for m, out in zip(means, ("density", "active", "edge"))],
        F.round(F.greatest(*gaps), 3).alias("gap"))


@R.add(f"""WITH {CELLS_SQL}, {FEATURES_SQL}, c AS (SELECT var_samp(defect_density) AS a, covar_samp(defect_density, active_ratio) AS b, var_samp(active_ratio) AS d FROM s),
  l AS (SELECT *, (a + d) / 2 + sqrt((a - d) ** 2 / 4 + b * b) AS top FROM c),
  v AS (SELECT b / sqrt(b * b + (top - a) ** 2) AS vx, (top - a) / sqrt(b * b + (top - a) ** 2) AS vy FROM l)
  SELECT vec_id, round(abs(defect_density * vx + active_ratio * vy), 5) AS first, round(abs(active_ratio * vx - defect_density * vy), 5) AS second FROM s, v""")
def pca_features(spark, d):
    """Two columns, whose components have a closed form; their signs are free."""
    rows = die_maps(spark, d).select("vec_id", M.spatial_features(F.col("map"), SIDE, SIDE).alias("f")).select("vec_id", "f.*")
    out = models.pca_features(rows, ["defect_density", "active_ratio"], 2)
    return out.select("vec_id", *[F.round(F.abs(F.get("pca", F.lit(i))), 5).alias(name) for i, name in enumerate(("first", "second"))])


@R.add("SELECT CASE WHEN quality IS NULL THEN 'pseudo' ELSE 'label' END AS origin, count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL OR least(d.n_chars / 5000.0, 1.0) >= 0.95 GROUP BY 1")
def pseudo_labels(spark, d):
    """Unlabelled documents carry a stand-in confidence that grows with their length."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    labels = table(spark, d, "labels")
    scored = docs.join(labels, "doc_id", "left_anti").select(
        "doc_id", F.lit(1).alias("quality"), F.least(F.col("n_chars") / 5000.0, F.lit(1.0)).alias("prob"))
    out = models.pseudo_labels(scored, docs.join(labels, "doc_id").select("doc_id", "quality"))
    return out.groupBy("origin").agg(F.count("*").alias("n"))


# ---- splits, weights and resampling ------------------------------------------------
def md5_draw(key, seed):
    """60 bits that DuckDB can draw too."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed)))), 1, 15), 16, 10).cast("long")


DRAW_SQL = "CAST('0x' || substr(md5(event_id || ':42'), 1, 15) AS BIGINT)"


@R.add(f"""WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1),
  t AS (SELECT *, sum(n) OVER () AS whole, ceil(round(sum(n) OVER () * 0.3, 6)) AS held FROM c),
  a AS (SELECT *, (whole - held) * n / whole AS ex FROM t),
  b AS (SELECT *, floor(ex) + CASE WHEN row_number() OVER (ORDER BY floor(ex) - ex, event_type) <= whole - held - sum(floor(ex)) OVER () THEN 1 ELSE 0 END AS train FROM a),
  d AS (SELECT *, n - train AS rest, ceil(round(held * 0.15 / 0.3, 6)) * (n - train) / sum(n - train) OVER () AS ey FROM b),
  s AS (SELECT *, rest - floor(ey) - CASE WHEN row_number() OVER (ORDER BY floor(ey) - ey, event_type) <= ceil(round(held * 0.15 / 0.3, 6)) - sum(floor(ey)) OVER () THEN 1 ELSE 0 END AS val FROM d),
  r AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY {DRAW_SQL}, event_id) AS k FROM events)
  SELECT event_id, event_type, CASE WHEN k <= train THEN 'train' WHEN k <= train + val THEN 'val' ELSE 'test' END AS split FROM r JOIN s USING (event_type)""")
def strat_split(spark, d):
    """Exact sizes per class by largest remainders, rows in the order of a hash."""
    rows = table(spark, d, "events").select("event_id", "event_type")
    return splitting.stratified_split(rows, "event_id", "event_type", draw=md5_draw)


def draw_sql(key, seed):
    return f"CAST('0x' || substr(md5({key} || ':{seed}'), 1, 15) AS BIGINT)"


@R.add(f"""WITH c AS (SELECT source, count(*) AS n FROM documents GROUP BY 1),
  k AS (SELECT source, n, coalesce(sum(1.0 / n * n) OVER (ORDER BY source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / sum(1.0 / n * n) OVER () AS lo,
    sum(1.0 / n * n) OVER (ORDER BY source) / sum(1.0 / n * n) OVER () AS hi FROM c),
  t AS (SELECT ({draw_sql('t', 43)} & 9007199254740991) / 9007199254740992.0 AS u, ({draw_sql('t', 44)} & 9007199254740991) / 9007199254740992.0 AS v
    FROM range((SELECT count(*) FROM documents)) x(t)),
  p AS (SELECT source, least(floor(v * n), n - 1) AS r FROM t JOIN k ON u >= lo AND u < hi),
  o AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {draw_sql('doc_id', 42)}, doc_id) - 1 AS r FROM documents)
  SELECT doc_id, source, count(*) AS copies FROM p JOIN o USING (source, r) GROUP BY 1, 2""")
def weighted_resample(spark, d):
    """Copies of each row drawn; as many draws as rows, every source with the same expected total."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    drawn = splitting.weighted_resample(docs, "doc_id", "source", draw=md5_draw, cell_rows=50)
    return drawn.groupBy("doc_id", "source").agg(F.count("*").alias("copies"))


@R.add(f"""SELECT event_id, event_type FROM (SELECT event_id, event_type,
    row_number() OVER (PARTITION BY event_type ORDER BY {DRAW_SQL}, event_id) AS k FROM events) WHERE k <= 200""")
def class_sample(spark, d):
    rows = table(spark, d, "events").select("event_id", "event_type")
    return splitting.class_sample(rows, "event_id", "event_type", 200, draw=md5_draw)


WEIGHTS_SQL = "c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)"


@R.add(f"WITH {WEIGHTS_SQL} SELECT event_type, n, round(sum(n) OVER () / (count(*) OVER () * n), 6) AS weight FROM c")
def class_weights_balanced(spark, d):
    return round_all(splitting.class_weights(table(spark, d, "events"), "event_type"))


@R.add(f"WITH {WEIGHTS_SQL} SELECT event_type, n, round((1 / (n + 1)) / sum(1 / (n + 1)) OVER () * count(*) OVER (), 6) AS weight FROM c")
def class_weights_inverse(spark, d):
    return round_all(splitting.class_weights(table(spark, d, "events"), "event_type", "inverse"))


@R.add(f"WITH {WEIGHTS_SQL} SELECT event_type, n, round((1 / n) / sum(1 / n) OVER () * count(*) OVER (), 6) AS weight FROM c")
def class_weights_balanced_norm(spark, d):
    return round_all(splitting.class_weights(table(spark, d, "events"), "event_type", "balanced_norm"))


COMBOS = [(0, 1), (2, 3), (2, 4)]
PAIRS_SQL = f"""{CELLS_SQL}, idx AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY {draw_sql('vec_id', 42)}, vec_id) AS i FROM embeddings),
  combos(combo, a, b) AS (VALUES {', '.join(f'({i}, {a}, {b})' for i, (a, b) in enumerate(COMBOS))}),
  p AS (SELECT combo, x.vec_id AS id_a, y.vec_id AS id_b FROM combos JOIN idx x ON x.label = a JOIN idx y ON y.label = b AND y.i = x.i)"""


def byte_sums(blob):
    """Defects and a position-weighted sum of a map's bytes, so that a die out of place shows."""
    cells = F.transform(F.sequence(F.lit(1), F.length(blob)), lambda i: F.conv(F.hex(F.substr(blob, i, F.lit(1))), 16, 10).cast("long"))
    return [F.size(F.filter(cells, lambda x: x == 2)).cast("long").alias("defects"),
            F.aggregate(F.transform(cells, lambda x, i: x * (i + 1)), F.lit(0).cast("long"), lambda a, x: a + x).alias("place_sum")]


@R.add(f"""WITH {PAIRS_SQL}, o AS (SELECT combo, id_a, id_b, c.pos, greatest(c.die, e.die) AS die
    FROM p JOIN cells c ON c.vec_id = id_a JOIN cells e ON e.vec_id = id_b AND e.pos = c.pos)
  SELECT CAST(combo AS INTEGER) AS combo, id_a, id_b, count(*) FILTER (die = 2) AS defects, CAST(sum(die * (pos + 1)) AS BIGINT) AS place_sum,
    true AS checks, CAST(2 AS INTEGER) AS labels FROM o GROUP BY 1, 2, 3""")
def overlay_pairs(spark, d):
    """Which maps are paired, and every die of the composite."""
    pairs = synthesis.pair_maps(die_maps(spark, d), "vec_id", "label", "map", COMBOS, draw=md5_draw)
    made = pairs.withColumn("out", synthesis.overlay(F.col("map_a"), F.col("map_b"), 64))
    checked = made.withColumn("k", synthesis.composite_checks(F.col("map_a"), F.col("map_b"), F.col("out"), 64))
    hot = synthesis.multi_hot(F.array("class_a", "class_b"), list(range(10)))
    ok = F.col("k.defects_kept") & F.col("k.active_kept") & F.col("k.inside_mask") & F.col("k.values_valid")
    return checked.select("combo", "id_a", "id_b", *byte_sums(F.col("out")), ok.alias("checks"),
                          F.aggregate(hot, F.lit(0), lambda x, v: x + v).alias("labels"))


_PAIR_DRAW = draw_sql("id_a || ':' || id_b", 42)


@R.add(f"""WITH {PAIRS_SQL}, m AS (SELECT *, {_PAIR_DRAW} % 49 // 7 - 3 AS dy, {_PAIR_DRAW} % 49 % 7 - 3 AS dx FROM p),
  o AS (SELECT combo, id_a, id_b, c.pos, CASE WHEN e.die = 2 THEN 2 ELSE c.die END AS die FROM m JOIN cells c ON c.vec_id = id_a
    JOIN cells e ON e.vec_id = id_b AND e.y = (c.y - dy + 8) % 8 AND e.x = (c.x - dx + 8) % 8)
  SELECT CAST(combo AS INTEGER) AS combo, id_a, id_b, count(*) FILTER (die = 2) AS defects, CAST(sum(die * (pos + 1)) AS BIGINT) AS place_sum FROM o GROUP BY 1, 2, 3""")
def pasted_pairs(spark, d):
    """Every die of the base map with the donor's moved defects."""
    pairs = synthesis.pair_maps(die_maps(spark, d), "vec_id", "label", "map", COMBOS, draw=md5_draw)
    move = F.pmod(md5_draw(F.concat_ws(":", "id_a", "id_b"), 42), F.lit(49))
    made = pairs.withColumn("out", synthesis.paste_defects(F.col("map_a"), F.col("map_b"), move, SIDE))
    return made.select("combo", "id_a", "id_b", *byte_sums(F.col("out")))
