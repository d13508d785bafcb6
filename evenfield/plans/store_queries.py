"""Registered queries of sources and sinks: the voxel view is written, read back and compared with the SQL of what was written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..model import embedding_voxels
from ..operators import emptiness, levels, orderstats, thresholds, tilestats
from ..session import shared_folder
from ..sources import files, source, spimdata, stores, tiff
from .pipeline import Run
from .queries import BASE, COLUMNS, EMPTY_AT, EMPTY_PART, FIELDS, LEVEL, LI, OTSU, PIXELS, STATS, known_fields, query, rounded

CHUNK, SHARD = (8, 4, 4), (16, 8, 8)
#: (z, y, x) factors of the levels that the metadata queries write.
STEPS = ((1, 1, 1), (1, 2, 2), (2, 4, 4))
FORMATS = ", ".join(f"('{f}')" for f in stores.FORMATS)


def _sizes(voxels: DataFrame) -> dict[int, tuple[int, int, int]]:
    found = voxels.groupBy("setup").agg(*((F.max(c) + 1).alias(c) for c in "zyx")).collect()  # a row per setup
    return {r["setup"]: (r["z"], r["y"], r["x"]) for r in found}


def _register_store(fmt: str) -> None:
    def written_and_read(spark: SparkSession, sf_dir: str) -> DataFrame:
        voxels, root = embedding_voxels(spark, sf_dir), shared_folder(spark, "store")
        sizes = _sizes(voxels)
        stores.write(stores.to_chunks(voxels, CHUNK), root, fmt, sizes, CHUNK, SHARD)
        return stores.to_voxels(stores.chunks(spark, root, fmt, sorted(sizes)), voxels.select("camera", "setup").distinct())

    written_and_read.__name__ = f"store_{fmt}"
    query(f"{BASE} SELECT * FROM voxel")(written_and_read)


for _fmt in stores.FORMATS:
    _register_store(_fmt)

SPARSE = f"{BASE}, sparse AS (SELECT camera, setup, z, y, x, CASE WHEN (setup + z // {CHUNK[0]} + y // {CHUNK[1]} + x // {CHUNK[2]}) % 3 = 0 OR z // {SHARD[0]} = 1 THEN 0 ELSE v END AS v FROM voxel)"


def _sparse_store(spark: SparkSession, sf_dir: str, fmt: str) -> tuple[str, dict[int, tuple[int, int, int]], DataFrame]:
    """A store in which chunks, and whole files, of the voxel view are left out: what isn't stored is zero."""
    voxels, root = embedding_voxels(spark, sf_dir), shared_folder(spark, "store")
    sizes = _sizes(voxels)
    held = voxels.filter(f"(setup + z div {CHUNK[0]} + y div {CHUNK[1]} + x div {CHUNK[2]}) % 3 != 0 and z div {SHARD[0]} != 1")
    stores.write(stores.to_chunks(held, CHUNK), root, fmt, sizes, CHUNK, SHARD)
    return root, sizes, voxels.select("camera", "setup").distinct()


def _register_sparse(fmt: str) -> None:
    def sparse_read(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, sizes, cameras = _sparse_store(spark, sf_dir, fmt)
        return stores.to_voxels(stores.chunks(spark, root, fmt, sorted(sizes)), cameras)

    sparse_read.__name__ = f"store_sparse_{fmt}"
    query(f"{SPARSE} SELECT * FROM sparse")(sparse_read)


for _fmt in stores.FORMATS:
    _register_sparse(_fmt)


@query(f"{SPARSE} SELECT setup, 0 AS level, z, y, x, v FROM sparse WHERE setup >= 3 AND setup < 7 AND z >= 10 AND z < 30 AND y < 3 AND x = 5")
def store_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box of some setups by the Spark source: filters and ranges choose arrays, files and chunks before any is opened."""
    root, _, _ = _sparse_store(spark, sf_dir, "zarr3")
    return source.load(spark, root, "zarr3", rows="voxels", pushdown="true", y=":3", x="5:6").filter("setup >= 3 and setup < 7 and z >= 10 and z < 30")


_CEIL = "CAST(ceil((max({c}) + 1) / {f}) AS INT) AS n{c}"
_LEVELS = " UNION ALL ".join(f"SELECT setup, {k} AS level, {', '.join(_CEIL.format(c=c, f=f) for c, f in zip('zyx', three))} FROM voxel GROUP BY setup" for k, three in enumerate(STEPS))


@query(f"""{BASE}, s AS ({_LEVELS}), f(format) AS (VALUES {FORMATS})
SELECT format, s.setup, s.level, s.nz, s.ny, s.nx, {', '.join(f'CAST(greatest(round_even(o.n{c} / s.n{c}, 0), 1) AS INT) AS f{c}' for c in 'zyx')} FROM f, s JOIN s o ON o.setup = s.setup AND o.level = 0""")
def store_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and factors of stored pyramids, from metadata alone."""
    sizes, rows = _sizes(embedding_voxels(spark, sf_dir)), []
    for fmt in stores.FORMATS:
        root = shared_folder(spark, "levels")
        for setup, size in sizes.items():
            for k, three in enumerate(STEPS):
                stores.create(root, fmt, setup, tuple(-(-n // f) for n, f in zip(size, three)), CHUNK, SHARD, k)
            rows += [(fmt, setup, k, *shape) for k, shape in enumerate(stores.pyramid_shapes(root, fmt, setup))]
    found = spark.createDataFrame(rows, "format string, setup int, level int, nz int, ny int, nx int")
    own = [levels.level_factors(found.filter(F.col("format") == f).drop("format")).withColumn("format", F.lit(f)) for f in stores.FORMATS]
    every = reduce(DataFrame.unionByName, own)
    return found.join(every.select("format", "setup", "level", "fz", "fy", "fx"), ["format", "setup", "level"])


_AXES = " UNION ALL ".join(f"SELECT format, setup, level, '{c}' AS axis, f{c} AS f FROM g" for c in "zyx")


@query(f"""{BASE}, s AS ({_LEVELS}), f(format) AS (VALUES {FORMATS}),
  g AS (SELECT format, s.setup, s.level, {', '.join(f'greatest(round_even(o.n{c} / s.n{c}, 0), 1) AS f{c}' for c in 'zyx')} FROM f, s JOIN s o ON o.setup = s.setup AND o.level = 0), a AS ({_AXES})
SELECT format, setup, level, axis, CAST(f AS DOUBLE) AS scale, CASE WHEN format <> 'n5' THEN CAST(greatest(f / 2 - 0.5, 0) AS DOUBLE) END AS translation FROM a""")
def group_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scales and translations of each setup's levels, as the groups' metadata hold them; factors follow from the tiles' sizes."""
    sizes, rows = _sizes(embedding_voxels(spark, sf_dir)), []
    for fmt in stores.FORMATS:
        root = shared_folder(spark, "group")
        for setup, size in sizes.items():
            shapes = [tuple(-(-n // f) for n, f in zip(size, three)) for three in STEPS]
            stores.open_group(root, fmt, setup)
            stores.write_group(root, fmt, setup, [tuple(max(round(a / b), 1) for a, b in zip(size, shape)) for shape in shapes])
            for k, (scale, shift) in enumerate(stores.group_scales(root, fmt, setup)):
                rows += [(fmt, setup, k, c, scale[i], None if shift is None else shift[i]) for i, c in enumerate("zyx")]
    return spark.createDataFrame(rows, "format string, setup int, level int, axis string, scale double, translation double")


@query(f"{BASE} SELECT * FROM voxel")
def tile_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    voxels, root = embedding_voxels(spark, sf_dir), shared_folder(spark, "tiff")
    tiles = voxels.groupBy("camera", "setup").agg(*((F.max(c) + 1).alias(c) for c in "zyx")).collect()  # a row per setup
    sizes = {r["setup"]: (r["z"], r["y"], r["x"]) for r in tiles}
    tiff.write_tiles(stores.to_chunks(voxels, (1, 1 << 20, 1 << 20)), root, sizes)
    cameras = spark.createDataFrame([(r["camera"], r["setup"]) for r in tiles], "camera int, setup int")
    return stores.to_voxels(tiff.tile_planes(spark, root, sorted(sizes)), cameras)


@query(f"{BASE}, {FIELDS}, t AS (SELECT unnest(range(10)) AS t) SELECT camera, CAST(t AS INT) AS y, x, round(flat, 4) AS flat, round(dark, 4) AS dark FROM t, fields WHERE fields.y = least(t, 7)")
def field_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that are stored the other way round, read to their frame of 10 x 8."""
    import numpy as np

    root, frame = shared_folder(spark, "fields"), (10, 8)
    rows = levels.fitted_to(known_fields(embedding_voxels(spark, sf_dir)), *frame).toPandas()  # two cameras' fields of 80 pixels
    cameras = sorted(rows["camera"].unique())
    for camera in cameras:
        own = rows[rows["camera"] == camera]
        for value, name in tiff.FIELDS.items():
            plane = np.zeros(frame, np.float32)
            plane[own["y"], own["x"]] = own[value]
            tiff.write_plane(f"{root}/camera{camera + 1}/{name}.tif", plane.T)
    return rounded(tiff.fields(spark, root, len(cameras), frame).select("camera", "y", "x", F.col("flat").cast("double"), F.col("dark").cast("double")), 4)


@query(f"{STATS} SELECT camera, y, x, CAST(plane AS INT) AS plane, v FROM planes")
def qstack_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantile planes as the export writes them, a page each, and as a run takes them from there."""
    now = _run(spark, sf_dir)
    now.keep("qstack", orderstats.column_stats(embedding_voxels(spark, sf_dir)))
    root = shared_folder(spark, "export")
    now.export(root)
    now.take(root)
    return now.read("qstack").select("camera", "y", "x", "plane", F.col("v").cast("int").alias("v"))


def _run(spark: SparkSession, sf_dir: str, apply_basic: bool = False, **settings) -> Run:
    own = Settings(results_root=shared_folder(spark, "results"), setup_ids=((0, 1, 2, 3, 4), (5, 6, 7, 8, 9)), **settings)
    return Run(spark, own, apply_basic, voxels=lambda: embedding_voxels(spark, sf_dir))


@query(f"{BASE} SELECT camera, setup, z, CAST(y // 4 AS INT) AS y, CAST(x // 4 AS INT) AS x, CAST(round_even(avg(v), 0) AS INT) AS v FROM voxel GROUP BY camera, setup, z, y // 4, x // 4")
def level_in_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).at_level(2)[0]


@query(f"""{BASE}, {FIELDS}, f AS (SELECT camera, y // 2 AS y, x // 2 AS x, avg(flat) AS flat, avg(dark) AS dark FROM fields GROUP BY camera, y // 2, x // 2),
  s AS (SELECT camera, setup, z, y // 2 AS y, x // 2 AS x, round_even(avg(v), 0) AS v FROM voxel GROUP BY camera, setup, z, y // 2, x // 2)
SELECT camera, setup, z, CAST(y AS INT) AS y, CAST(x AS INT) AS x, round(greatest((v - dark) / flat, 0), 6) AS v FROM s JOIN f USING (camera, y, x)""")
def seen_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The voxels of a coarse level, corrected by the fields, as the intensity stages see them."""
    now = _run(spark, sf_dir, apply_basic=True, stats_scale=1)
    now.keep("fields", known_fields(embedding_voxels(spark, sf_dir)))
    return rounded(now.seen()[0])


@query(f"{BASE}, {COLUMNS}, {PIXELS}, {LEVEL} SELECT camera, round(level, 6) AS dark FROM lev")
def measured_dark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dark level that overrides each camera's fitted one."""
    now, voxels = _run(spark, sf_dir), embedding_voxels(spark, sf_dir)
    cols = emptiness.columns(voxels, thresholds.pooled(voxels, EMPTY_AT), EMPTY_PART)
    now.keep("background", emptiness.background_level(emptiness.by_pixel(cols)))
    return rounded(spark.createDataFrame(list(now.measured_darks().items()), "camera int, dark double"))


@query(f"{LI}, {OTSU} SELECT setup, CASE WHEN setup % 2 = 0 THEN threshold + 1 ELSE threshold END AS otsu, round(li, 6) AS li, CASE WHEN setup % 2 = 0 THEN 'new' END AS note FROM otsu JOIN li USING (setup)")
def merged_tile_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later writer's records over earlier ones: its values win, the others stay."""
    old = thresholds.catalogue(thresholds.histogram(embedding_voxels(spark, sf_dir), "setup"), "setup")
    new = old.filter("setup % 2 = 0").select("setup", (F.col("otsu") + 1).alias("otsu"), F.lit("new").alias("note"))
    return rounded(tilestats.merged_records(new, old))


@query(f"""{BASE} SELECT setup, CAST(max(x) + 1 AS INT) AS size_x, CAST(max(y) + 1 AS INT) AS size_y, CAST(max(z) + 1 AS INT) AS size_z, CASE WHEN setup % 3 < 2 THEN 5.0::DOUBLE END AS um_z, CASE WHEN setup % 3 < 2 THEN 0.5::DOUBLE END AS um_y, CASE WHEN setup % 3 < 2 THEN 0.25::DOUBLE END AS um_x,
  [2.0, 0, 0, 6 * setup, 0, 2, 0, setup, 0, 0, 5, 0.5]::DOUBLE[] AS affine FROM voxel GROUP BY setup""".replace("[2.0", "array_to_string([2.0").replace("::DOUBLE[] AS affine", "::DOUBLE[], ' ') AS affine"))
def tile_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes, voxel sizes and composed transforms from a geometry file; the last listed transform acts first."""
    sizes, path = _sizes(embedding_voxels(spark, sf_dir)), f"{shared_folder(spark, 'geometry')}/dataset.xml"
    units = ("um", " Micrometer ", "pixel")
    view = lambda s, n: f"<ViewSetup><id>{s}</id><size>{n[2]} {n[1]} {n[0]}</size><voxelSize><unit>{units[s % 3]}</unit><size>0.25 0.5 5</size></voxelSize></ViewSetup>"
    affine = lambda text: f'<ViewTransform type="affine"><affine>{text}</affine></ViewTransform>'
    placed = lambda s, t: f'<ViewRegistration timepoint="{t}" setup="{s}">{affine(f"1 0 0 {6 * s + 100 * t} 0 1 0 {s} 0 0 1 0.5")}{affine("2 0 0 0 0 2 0 0 0 0 5 0")}</ViewRegistration>'
    text = "".join(view(s, n) for s, n in sizes.items()) + "".join(placed(s, t) for s in sizes for t in (0, 1))
    files.write(path, f"<SpimData>{text}</SpimData>".encode())
    return spimdata.setups(spark, path).join(spimdata.registrations(spark, path), "setup").withColumn("affine", F.array_join(F.transform("affine", lambda v: v.cast("string")), " "))
