"""The array-file source against numpy."""

import io

import numpy as np
import pytest

from fabspark.sources import npy, readers


def rows(df):
    return {r["wafer_id"]: bytes(r["wafer_map_flat"]) for r in df.collect()}


@pytest.mark.parametrize("kind", ["u1", "<i8", ">i2", "<f4", "?"])
@pytest.mark.parametrize("version", [(1, 0), (2, 0), (3, 0)])
def test_files_of_any_kind(spark, tmp_path, kind, version):
    maps = np.random.default_rng(1).integers(0, 2 if kind == "?" else 3, (57, 6, 5)).astype(kind)
    with open(tmp_path / "x.npy", "wb") as file:
        np.lib.format.write_array(file, maps, version)
    df = npy.read_npy_maps(spark, str(tmp_path / "x.npy"), part_bytes=7 * 30 * maps.itemsize)
    assert df.rdd.getNumPartitions() == 9
    assert rows(df) == {i: m.astype("u1").tobytes() for i, m in enumerate(maps)}


def test_folders_and_sink(spark, tmp_path):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 3, (10, 4, 4)).astype("u1"), rng.integers(0, 3, (3, 4, 4)).astype("u1")
    np.save(tmp_path / "a.npy", a)
    np.save(tmp_path / "b.npy", b)
    np.save(tmp_path / "c.npy", a[:0])
    (tmp_path / "_done").write_text("")
    whole = npy.read_npy_maps(spark, f"file://{tmp_path}")
    want = {i: m.tobytes() for i, m in enumerate(np.concatenate([a, b]))}
    assert rows(whole) == want
    out = str(tmp_path / "out")
    for header in (True, False):
        for _ in range(2):
            npy.write_npy_maps(whole.repartitionByRange(3, "wafer_id").sortWithinPartitions("wafer_id"), out, 4, header=header)
        assert rows(npy.read_npy_maps(spark, out, None if header else 16)) == want
    npy.write_npy_maps(whole.limit(0), out, 4)
    assert rows(npy.read_npy_maps(spark, out)) == {}
    npy.write_npy_maps(whole.coalesce(1), out, 4, mode="append")
    npy.write_npy_maps(whole.coalesce(1), out, 4, mode="append")
    assert len(rows(npy.read_npy_maps(spark, out))) == 26
    assert all(np.load(p).shape[1:] == (4, 4) for p in (tmp_path / "out").glob("part*.npy"))
    (tmp_path / "raw.bin").write_bytes(a.tobytes())
    assert rows(readers.read_fixed_width_maps(spark, str(tmp_path / "raw.bin"), 16)) == {i: m.tobytes() for i, m in enumerate(a)}


def test_bad_files(spark, tmp_path):
    np.save(tmp_path / "f.npy", np.asfortranarray(np.zeros((4, 3, 3), "u1")))
    np.save(tmp_path / "o.npy", np.array(["a"]))
    good = io.BytesIO()
    np.save(good, np.zeros((4, 3, 3), "u1"))
    (tmp_path / "short.npy").write_bytes(good.getvalue()[:-1])
    (tmp_path / "none.npy").write_bytes(b"no header at all")
    for name, text in (("f", "column-major"), ("o", "not an array of maps"), ("short", "disagree"), ("none", "no array header"), ("missing", "missing")):
        with pytest.raises(Exception, match=text):
            npy.read_npy_maps(spark, str(tmp_path / f"{name}.npy")).count()
    with pytest.raises(Exception, match="not whole maps"):
        npy.read_npy_maps(spark, str(tmp_path / "none.npy"), 7).count()
