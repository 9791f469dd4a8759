"""Map kernels against plain numpy, and their properties."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fabspark.constants import TRAIN_AUGMENTATION
from fabspark.functions import kernels as K
from fabspark.operators import diemaps as M
from fabspark.operators import synthesis

SIDE = 16


def reference_features(m):
    rows, cols = m.shape
    active, bad = (m > 0).sum(), m == 2
    if active == 0:
        return [0.0] * 5 + [0, 0]
    dist = np.array([[np.hypot(y - rows / 2, x - cols / 2) for x in range(cols)] for y in range(rows)])
    radius, n = rows / 2 - 0.5, bad.sum()
    return [n / active, active / m.size, bad[dist > 0.75 * radius].sum() / (n + 1e-9),
            bad[dist < 0.38 * radius].sum() / (n + 1e-9), dist[bad].mean() if n else 0.0, n, active]


def edge_maps(side):
    empty, good, full = np.zeros((side, side)), np.ones((side, side)), np.full((side, side), 2)
    centre, corners = good.copy(), good.copy()
    centre[side // 2, side // 2] = 2
    corners[[0, 0, -1, -1], [0, -1, 0, -1]] = 2
    rng = np.random.default_rng(1)
    return [m.astype(np.uint8) for m in (empty, good, full, centre, corners, rng.integers(0, 3, (side, side)))]


@pytest.mark.parametrize("side", [SIDE, 64])
def test_spatial_features(spark, side):
    maps = edge_maps(side)
    df = spark.createDataFrame([(i, bytearray(m.tobytes())) for i, m in enumerate(maps)] + [(99, None)], "id int, m binary")
    out = {r["id"]: r["f"] for r in df.select("id", M.spatial_features(F.col("m"), side, side).alias("f")).collect()}
    assert out[99] is None
    for i, m in enumerate(maps):
        assert np.allclose(list(out[i]), reference_features(m), atol=1e-9)


def test_wrong_size_fails(spark):
    df = spark.createDataFrame([(bytearray(5),)], "m binary")
    with pytest.raises(Exception, match="4096"):
        df.select(M.spatial_features(F.col("m"))).collect()


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32 - 1))
def test_counts_survive_symmetry(seed):
    m = np.random.default_rng(seed).integers(0, 3, (1, SIDE * SIDE)).astype(np.uint8)
    weights = K.region_weights(SIDE, SIDE, "disc")[:, :1]
    base, active = K.region_sums(m, weights)
    for index in K.symmetry_table(SIDE, SIDE):
        sums, on = K.region_sums(m[:, index], weights)
        assert sums[0, 0] == base[0, 0] and on[0] == active[0]


def test_symmetry_table():
    table, base = K.symmetry_table(4, 4), np.arange(16)
    turn = table[4]
    assert (base[turn][turn][turn][turn] == base).all() and not (base[turn] == base).all()
    assert (base[table[1]][table[1]] == base).all() and (base[table[2]][table[2]] == base).all()
    assert (base[turn] == np.rot90(base.reshape(4, 4)).ravel()).all()


def test_ragged_maps(spark):
    """Long, wide and empty shapes in one batch."""
    rng = np.random.default_rng(3)
    maps = [rng.integers(0, 3, s).astype(np.uint8) for s in ((3, 204), (212, 15), (8, 8), (1, 1))]
    df = spark.createDataFrame(
        [(i, (m.shape[0], m.shape[1], bytearray(m.tobytes()))) for i, m in enumerate(maps)],
        "id int, m struct<rows:int,cols:int,cells:binary>").coalesce(1)
    out = df.select(
        "id", M.resize_nearest(F.col("m")).alias("near"), M.resize_defect_mask(F.col("m"), 5, 7).alias("area"),
        M.defect_ratio(F.col("m.cells")).alias("ratio")).collect()
    for row in out:
        m = maps[row["id"]]
        r = np.floor(np.arange(64) * m.shape[0] / 64).astype(int)
        c = np.floor(np.arange(64) * m.shape[1] / 64).astype(int)
        assert (np.frombuffer(row["near"], np.uint8).reshape(64, 64) == m[np.ix_(r, c)]).all()
        assert np.isclose(np.mean(row["area"]), (m == 2).mean())
        assert np.isclose(row["ratio"], (m == 2).sum() / max((m > 0).sum(), 1))


def test_heatmap_and_entropy(spark):
    maps = edge_maps(SIDE)
    rows = [("a" if i < 4 else "b", bytearray(m.tobytes())) for i, m in enumerate(maps)] + [("a", None)]
    df = spark.createDataFrame(rows, "c string, m binary").repartition(3)
    heat = M.class_heatmap(df, "c", "m")
    got = {(r["c"], r["pos"]): r["mean_value"] for r in heat.collect()}
    entropy = {r["c"]: r["spatial_entropy"] for r in M.heatmap_entropy(heat, "c").collect()}
    for label, group in (("a", maps[:4]), ("b", maps[4:])):
        mean = np.mean([(m == 2) for m in group], axis=0).ravel()
        assert np.allclose([got[label, i] for i in range(SIDE * SIDE)], mean)
        p = (mean + 1e-10) / (mean + 1e-10).sum()
        assert np.isclose(entropy[label], -(p * np.log(p)).sum())


def test_diagonal_edge_share_is_zero_on_a_disc(spark):
    y, x = np.mgrid[:64, :64]
    disc = np.where(np.hypot(y - 31.5, x - 31.5) <= 32, 2, 0).astype(np.uint8)
    df = spark.createDataFrame([(bytearray(disc.tobytes()),)], "m binary")
    assert df.select(M.mechanism_metrics(F.col("m")).alias("f")).first()["f"]["edge_ratio"] == 0.0


def test_long_form_twin(spark):
    maps = edge_maps(8)
    df = spark.createDataFrame([(i, bytearray(m.tobytes())) for i, m in enumerate(maps)], "id int, m binary")
    twin = M.long_form(df, "m", "id").groupBy("id").agg(F.count_if(F.col("die") == 2).alias("bad"), F.count_if(F.col("die") > 0).alias("on"))
    kernel = df.select("id", M.spatial_features(F.col("m"), 8, 8).alias("f")).select("id", "f.defect_count", "f.active_count")
    assert sorted(map(tuple, twin.collect())) == sorted(map(tuple, kernel.collect()))


def test_validity(spark):
    df = spark.createDataFrame([(bytearray([0, 1, 2, 2]),), (bytearray([0, 1, 3, 2]),), (bytearray([0, 1]),), (None,)], "m binary")
    assert [r[0] for r in df.select(M.map_validity(F.col("m"), 2, 2)).collect()] == [True, False, False, False]
    assert [r[0] for r in df.limit(3).select(M.die_values(F.col("m"))).collect()] == [[0, 1, 2], [0, 1, 2], [0, 1]]


def test_augmentation_is_repeatable(spark):
    maps = edge_maps(SIDE)
    df = spark.createDataFrame([(i, bytearray(m.tobytes())) for i, m in enumerate(maps)], "id int, m binary")
    copies = M.augmented_copies(df, "id", "m", 3, SIDE)
    a = sorted((r["id"], r["copy"], bytes(r["m"])) for r in copies.collect())
    b = sorted((r["id"], r["copy"], bytes(r["m"])) for r in M.augmented_copies(df.repartition(5), "id", "m", 3, SIDE).collect())
    assert a == b and len(a) == 18
    image = df.select(M.augment_image(F.col("m"), F.xxhash64("id"), SIDE).alias("x"))
    first, second = image.collect(), image.collect()
    assert first == second and all(0 <= v <= 1 for r in first for v in r["x"])


def test_image_steps_one_by_one(monkeypatch):
    """Each step on a stack equals the step on its maps alone, and its draws have the right spread."""
    rng = np.random.default_rng(3)
    maps, seeds = rng.integers(0, 3, (400, 12, 12)) / 2.0, rng.integers(0, 1 << 31, 400)
    config = TRAIN_AUGMENTATION | {"CoarseDropout": TRAIN_AUGMENTATION["CoarseDropout"] | {"min_height": 2, "max_height": 5}}
    whole = M.augmented(maps.copy(), seeds, config)
    for i in range(0, 400, 37):
        assert np.array_equal(whole[i], M.augmented(maps[i:i + 1].copy(), seeds[i:i + 1], config)[0])
    for name, c in config.items():
        one = {n: (v if n == name else v | {"p": 0.0}) for n, v in config.items()}
        out = M.augmented(maps.copy(), seeds, one)
        changed = (out != maps).any(axis=(1, 2)).mean()
        assert abs(changed - c["p"]) < (0.2 if name == "Rotate" else 0.1), name  # a small turn may change nothing
    flips = M.augmented(maps.copy(), seeds, {"HorizontalFlip": {"p": 1.0}, "VerticalFlip": {"p": 1.0}})
    assert np.array_equal(flips, maps[:, ::-1, ::-1])
    flat = np.full((300, 16, 16), 0.5)
    noise = M.augmented(flat.copy(), rng.integers(0, 1 << 31, 300), {"GaussNoise": {"var_limit": (0.004, 0.004), "p": 1.0}}) - 0.5
    assert abs(noise.mean()) < 2e-3 and abs(noise.std() - np.sqrt(0.004)) < 2e-3
    u = M.draw31(np.arange(200_000), 3, 1)
    assert abs(u.mean() - 0.5) < 4e-3 and abs(np.histogram(u, 50, (0, 1))[0] / 4000 - 1).max() < 0.08
    assert abs(np.corrcoef(u, M.draw31(np.arange(200_000), 3, 2))[0, 1]) < 0.01
    blur = M.augmented(np.eye(5)[None].copy(), np.array([1]), {"Blur": {"blur_limit": 3, "p": 1.0}})
    assert blur[0, 2, 2] == pytest.approx(1 / 3) and blur[0, 0, 0] == pytest.approx(5 / 9)


def test_byte_rows_of_a_slice():
    column = pa.array([b"\x00\x01", b"\x02\x01", None, b"\x02\x02"], pa.binary()).slice(1, 3)
    assert K.byte_rows(column, 2).tolist() == [[2, 1], [0, 0], [2, 2]]


def test_paste_moves_defects(spark):
    base, donor = np.ones((8, 8), np.uint8), np.ones((8, 8), np.uint8)
    base[0, 0], donor[4, 4] = 2, 2
    df = spark.createDataFrame([(m, bytearray(base.tobytes()), bytearray(donor.tobytes())) for m in range(49)], "m int, a binary, b binary")
    for row in df.withColumn("o", synthesis.paste_defects(F.col("a"), F.col("b"), F.col("m"), 8)).collect():
        out = np.frombuffer(row["o"], np.uint8).reshape(8, 8)
        assert out[0, 0] == 2 and out[4 + row["m"] // 7 - 3, 4 + row["m"] % 7 - 3] == 2 and (out == 2).sum() == 2


def test_overlay_and_checks(spark):
    a = np.array([0, 0, 1, 1, 2, 0, 2, 1], np.uint8)
    b = np.array([0, 1, 1, 2, 0, 2, 2, 0], np.uint8)
    df = spark.createDataFrame([(bytearray(a.tobytes()), bytearray(b.tobytes()))], "a binary, b binary")
    made = df.withColumn("o", synthesis.overlay(F.col("a"), F.col("b"), 8))
    row = made.select("o", synthesis.composite_checks(F.col("a"), F.col("b"), F.col("o"), 8).alias("k"),
                      synthesis.composite_checks(F.col("a"), F.col("b"), F.col("a"), 8).alias("bad")).first()
    assert list(row["o"]) == [0, 1, 1, 2, 2, 2, 2, 1]
    assert all(row["k"]) and not row["bad"]["defects_kept"] and not row["bad"]["active_kept"]


def test_class_index_is_dense(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 5)).alias("c"))
    for _, g in synthesis.class_index(df, "id", "c").toPandas().groupby("c"):
        assert sorted(g["_idx"]) == list(range(len(g)))
