"""The registered queries of the operators over the voxel view of the embeddings table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import basic_corrected, library_corrected, shrink
from ..model import LEVELS, PER_CAMERA, embedding_voxels, tiles_in_a_row
from ..operators import correct as correcting
from ..operators import blockpairs, blocks, blockstats, emptiness, gains, geometry, levels, orderstats, pairs, selection, thresholds, tilestats, unmix
from ..session import shared_folder
from ..sources import stores
from . import flatfield

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

VIEW = """voxel AS (SELECT CAST(label // 5 AS INT) AS camera, CAST(label AS INT) AS setup, CAST(z AS INT) AS z, CAST(i // 8 AS INT) AS y, CAST(i % 8 AS INT) AS x,
    CAST(least(greatest(round_even((CAST(e AS DOUBLE) + 1) * 1000, 0), 0), 65535) AS INT) AS v
  FROM (SELECT label, z, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS i
    FROM (SELECT label, embedding, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS z FROM embeddings)))"""
DEPTH = "depth AS (SELECT camera, min(n) AS depth FROM (SELECT camera, setup, max(z) + 1 AS n FROM voxel GROUP BY camera, setup) GROUP BY camera HAVING min(n) > 21)"
SIZED = "sized AS (SELECT camera, depth, CAST(floor((depth - 1) / 21) * 21 AS INT) AS p FROM depth)"
RANKED = """ranked AS (SELECT camera, setup, y, x, p, b, row_number() OVER (PARTITION BY camera, setup, y, x, b ORDER BY v) AS k, v
  FROM (SELECT voxel.*, p, z // p AS b FROM voxel JOIN sized USING (camera) WHERE z < (depth // p) * p))"""
FITS = "fits AS (SELECT camera, setup, y, x, p, k, sum(v) / CAST(count(*) AS DOUBLE) AS value FROM ranked GROUP BY camera, setup, y, x, p, k)"
# the setups' columns folded in order, as the operator does it
MERGED = """five AS (SELECT camera, y, x, p, k, max(value) FILTER (setup % 5 = 0) AS a, max(value) FILTER (setup % 5 = 1) AS b, max(value) FILTER (setup % 5 = 2) AS c, max(value) FILTER (setup % 5 = 3) AS d, max(value) FILTER (setup % 5 = 4) AS e FROM fits GROUP BY camera, y, x, p, k),
  two AS (SELECT *, a + CAST(0.5 AS DOUBLE) * (b - a) AS m2 FROM five), three AS (SELECT *, m2 + (CAST(1 AS DOUBLE) / 3) * (c - m2) AS m3 FROM two), four AS (SELECT *, m3 + CAST(0.25 AS DOUBLE) * (d - m3) AS m4 FROM three),
  merged AS (SELECT camera, y, x, p, k, m4 + (CAST(1 AS DOUBLE) / 5) * (e - m4) AS value FROM four)"""
PLACES = "places(p, plane, rank, w) AS (VALUES " + ", ".join(f"({n}, {k}, {r}, {w!r}::DOUBLE)" for n in range(21, 421, 21) for k, (r, w) in enumerate(orderstats.r7_position(n, q / 100) for q in LEVELS)) + ")"
PLANES = "planes AS (SELECT camera, y, x, plane, CAST(round_even((1 - w) * s[rank] + w * s[rank + 1], 0) AS INT) AS v FROM (SELECT camera, y, x, p, list(value ORDER BY value) AS s FROM merged GROUP BY camera, y, x, p) JOIN places USING (p))"
QUANTILES = "[" + ", ".join(f"{q / 100}" for q in LEVELS) + "]"
HIST = "hist AS (SELECT setup, v, count(*) AS n FROM voxel GROUP BY setup, v)"
OTSU = """upto AS (SELECT setup, v, CAST(sum(n) OVER w AS DOUBLE) AS w0, CAST(sum(n * v) OVER w AS DOUBLE) AS s0, CAST(sum(n) OVER t AS DOUBLE) AS w, CAST(sum(n * v) OVER t AS DOUBLE) AS s FROM hist
    WINDOW w AS (PARTITION BY setup ORDER BY v ROWS UNBOUNDED PRECEDING), t AS (PARTITION BY setup)),
  between_ AS (SELECT setup, v, CASE WHEN w0 < w THEN w0 * (w - w0) * (s0 / w0 - (s - s0) / (w - w0)) * (s0 / w0 - (s - s0) / (w - w0)) ELSE -1 END AS b FROM upto),
  otsu AS (SELECT setup, CAST(v AS DOUBLE) AS threshold FROM (SELECT setup, v, row_number() OVER (PARTITION BY setup ORDER BY b DESC, v) AS r FROM between_) WHERE r = 1)"""
BASE = f"WITH {VIEW}"
STATS = f"{BASE}, {DEPTH}, {SIZED}, {RANKED}, {FITS}, {MERGED}, {PLACES}, {PLANES}"
TILES = f"{BASE}, {HIST}, {OTSU}"


def query(sql: str | None = None):
    def keep(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return keep


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that engines that add in another order agree."""
    return df.select(*(F.round(F.col(c), digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


@query(f"{BASE} SELECT * FROM voxel")
def voxel_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_voxels(spark, sf_dir)


@query(f"{BASE} SELECT camera, min(n) AS depth FROM (SELECT camera, setup, max(z) + 1 AS n FROM voxel GROUP BY camera, setup) GROUP BY camera")
def camera_depths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderstats.camera_depth(embedding_voxels(spark, sf_dir))


@query(f"{STATS} SELECT camera, y, x, CAST(plane AS INT) AS plane, v FROM planes")
def column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderstats.column_stats(embedding_voxels(spark, sf_dir))


@query(f"{STATS} SELECT camera, y, x, min(v) AS minimum, max(v) AS maximum, count(*) AS n FROM voxel JOIN depth USING (camera) WHERE z < depth GROUP BY camera, y, x")
def column_extrema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderstats.column_extrema(embedding_voxels(spark, sf_dir))


@query(f"{BASE}, d AS (SELECT camera, min(n) AS depth FROM (SELECT camera, setup, max(z) + 1 AS n FROM voxel GROUP BY ALL) GROUP BY camera) SELECT camera, CAST((setup - camera * 5) * depth + z AS INT) AS plane, y, x, v FROM voxel JOIN d USING (camera) WHERE z < depth")
def raw_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderstats.raw_stack(embedding_voxels(spark, sf_dir))


@query(f"{TILES} SELECT setup, threshold AS otsu FROM otsu")
def otsu_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thresholds.otsu(thresholds.histogram(embedding_voxels(spark, sf_dir), "setup"), "setup")


LI = f"""WITH RECURSIVE {VIEW}, {HIST}, low AS (SELECT setup, min(v) AS low FROM hist GROUP BY setup),
  h AS (SELECT setup, CAST(v - low AS DOUBLE) AS v, CAST(n AS DOUBLE) AS n FROM hist JOIN low USING (setup)),
  it AS (SELECT setup, 0 AS k, sum(v * n) / sum(n) AS t, CAST(-1e9 AS DOUBLE) AS was FROM h GROUP BY setup
    UNION ALL SELECT setup, k, CASE WHEN mb = 0 THEN t ELSE (mb - mf) / (ln(mb) - ln(mf)) END AS t, t AS was FROM (
      SELECT it.setup, it.k + 1 AS k, it.t AS t, sum(CASE WHEN h.v > it.t THEN h.v * h.n END) / sum(CASE WHEN h.v > it.t THEN h.n END) AS mf, sum(CASE WHEN h.v <= it.t THEN h.v * h.n END) / sum(CASE WHEN h.v <= it.t THEN h.n END) AS mb
      FROM it JOIN h ON h.setup = it.setup WHERE abs(it.t - it.was) > 0.5 AND it.k < 200 GROUP BY it.setup, it.k, it.t)),
  li AS (SELECT setup, t + low AS li FROM (SELECT setup, t, row_number() OVER (PARTITION BY setup ORDER BY k DESC) AS r FROM it) JOIN low USING (setup) WHERE r = 1)"""


@query(f"{LI} SELECT setup, round(li, 6) AS li FROM li")
def li_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(thresholds.li(thresholds.histogram(embedding_voxels(spark, sf_dir), "setup"), "setup"))


@query(f"{LI}, {OTSU} SELECT setup, threshold AS otsu, round(li, 6) AS li FROM otsu JOIN li USING (setup)")
def threshold_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(thresholds.catalogue(thresholds.histogram(embedding_voxels(spark, sf_dir), "setup"), "setup"))


def _tile_thresholds(voxels: DataFrame) -> DataFrame:
    return thresholds.resolve(thresholds.histogram(voxels, "setup"), "otsu", "setup")


MOMENTS = """moments AS (SELECT setup, threshold, avg(v) FILTER (v > threshold) AS mean, stddev_pop(v) FILTER (v > threshold) AS std, avg(v) FILTER (v <= threshold) AS bg_mean, stddev_pop(v) FILTER (v <= threshold) AS bg_std,
    avg(v) AS all_mean, stddev_pop(v) AS all_std, count(*) FILTER (v > threshold) AS n_foreground, count(*) AS n_voxels FROM voxel JOIN otsu USING (setup) GROUP BY setup, threshold)"""


@query(f"""{TILES}, {MOMENTS} SELECT setup, threshold, round(mean, 6) AS mean, round(std, 6) AS std, round(bg_mean, 6) AS bg_mean, round(bg_std, 6) AS bg_std, round(all_mean, 6) AS all_mean, round(all_std, 6) AS all_std,
  n_foreground, n_voxels, round((mean - bg_mean) / (bg_std + 1e-6), 6) AS separation FROM moments""")
def tile_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    voxels = embedding_voxels(spark, sf_dir)
    return rounded(tilestats.moments(voxels, _tile_thresholds(voxels)))


#: The threshold that the emptiness queries use, and the part of a column that may lie above it.
EMPTY_AT, EMPTY_PART = 1200.0, 0.05


@query(f"""{BASE}, hist AS (SELECT camera AS setup, v, count(*) AS n FROM voxel JOIN (SELECT setup AS s, max(y) + 1 AS ny, max(x) + 1 AS nx FROM voxel GROUP BY setup) ON s = setup WHERE z % 4 = 0 AND ((z // 4) * ny * nx + y * nx + x) % 7 = 0 GROUP BY 1, 2),
  {OTSU} SELECT setup AS camera, threshold FROM otsu""")
def pooled_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return thresholds.pooled(embedding_voxels(spark, sf_dir), "otsu")


COLUMNS = f"cols AS (SELECT camera, setup, y, x, avg(CASE WHEN v > {EMPTY_AT} THEN 1.0 ELSE 0.0 END) < {EMPTY_PART} AS is_empty, avg(v) FILTER (v < {EMPTY_AT}) AS below FROM voxel GROUP BY camera, setup, y, x)"
AREAS = "areas AS (SELECT camera, setup, avg(CASE WHEN is_empty THEN 1.0 ELSE 0.0 END) AS empty_area FROM cols GROUP BY camera, setup)"
PIXELS = "pixels AS (SELECT camera, y, x, avg(CASE WHEN is_empty THEN 1.0 ELSE 0.0 END) AS phi, sum(CASE WHEN is_empty AND below IS NOT NULL THEN below ELSE 0 END) AS bg_sum, count(*) FILTER (is_empty AND below IS NOT NULL) AS bg_count FROM cols GROUP BY camera, y, x)"
LEVEL = "lev AS (SELECT camera, quantile_cont(bg_sum / bg_count, 0.05) FILTER (bg_count > 0) AS level, count(*) FILTER (bg_count > 0) AS n_pixels FROM pixels GROUP BY camera)"


def _columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    voxels = embedding_voxels(spark, sf_dir)
    return emptiness.columns(voxels, thresholds.pooled(voxels, EMPTY_AT), EMPTY_PART)


@query(f"{BASE}, {COLUMNS}, {AREAS} SELECT camera, setup, round(empty_area, 6) AS empty_area FROM areas")
def emptiness_tile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(emptiness.by_tile(_columns(spark, sf_dir)))


@query(f"{BASE}, {COLUMNS}, {PIXELS} SELECT camera, y, x, round(phi, 6) AS phi, round(bg_sum, 6) AS bg_sum, bg_count FROM pixels")
def emptiness_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(emptiness.by_pixel(_columns(spark, sf_dir)))


@query(f"{BASE}, {COLUMNS}, {PIXELS}, {LEVEL} SELECT camera, round(level, 6) AS level, n_pixels FROM lev")
def background_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(emptiness.background_level(emptiness.by_pixel(_columns(spark, sf_dir))))


@query(f"{BASE}, {COLUMNS}, {AREAS} SELECT camera, round(min(empty_area), 6) AS least, round(median(empty_area), 6) AS middle, round(max(empty_area), 6) AS most FROM areas GROUP BY camera")
def emptiness_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(emptiness.report(emptiness.by_tile(_columns(spark, sf_dir))))


PROFILE_AT = 1500.0


@query(f"""{STATS}, tops AS (SELECT camera, setup, y, x, max(v) AS vmax FROM voxel JOIN depth USING (camera) WHERE z < depth GROUP BY camera, setup, y, x),
  q AS (SELECT camera, setup, y, x, quantile_cont(value, {QUANTILES}) AS qs FROM fits JOIN tops USING (camera, setup, y, x) WHERE x % 8 = 0 AND y % 8 = 0 AND vmax < {PROFILE_AT} GROUP BY ALL)
SELECT camera, CAST(i - 1 AS INT) AS plane, round(avg(qs[i]), 6) AS level, count(*) AS n_columns FROM (SELECT camera, qs, unnest(range(1, 22)) AS i FROM q) GROUP BY camera, i""")
def background_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    voxels = embedding_voxels(spark, sf_dir)
    return rounded(orderstats.background_profile(orderstats.fit(voxels), thresholds.pooled(voxels, PROFILE_AT)))


@query(f"""{STATS}, {COLUMNS}, {PIXELS}, {LEVEL}
SELECT camera, CAST(plane AS INT) AS plane, y, x, round(CASE WHEN level IS NULL THEN v ELSE least(greatest((v - least(phi, 0.9) * level) / (1 - least(phi, 0.9)), 0), 65535) END, 6) AS v FROM planes JOIN pixels USING (camera, y, x) JOIN lev USING (camera)""")
def unmix_qstack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pixels = emptiness.by_pixel(_columns(spark, sf_dir))
    return rounded(unmix.unmix(orderstats.column_stats(embedding_voxels(spark, sf_dir)), pixels, emptiness.background_level(pixels)))


TILE_BOXES = "boxes AS (SELECT setup, CAST(6 * setup AS DOUBLE) AS min_x, 0.0::DOUBLE AS min_y, 0.0::DOUBLE AS min_z, CAST(6 * setup + max(x) + 1 AS DOUBLE) AS max_x, CAST(max(y) + 1 AS DOUBLE) AS max_y, CAST(max(z) + 1 AS DOUBLE) AS max_z FROM voxel GROUP BY setup)"
OVERLAPS = """laps AS (SELECT a.setup AS a, b.setup AS b, greatest(a.min_x, b.min_x) AS min_x, greatest(a.min_y, b.min_y) AS min_y, greatest(a.min_z, b.min_z) AS min_z, least(a.max_x, b.max_x) AS max_x, least(a.max_y, b.max_y) AS max_y, least(a.max_z, b.max_z) AS max_z
  FROM boxes a JOIN boxes b ON a.setup < b.setup AND least(a.max_x, b.max_x) > greatest(a.min_x, b.min_x) AND least(a.max_y, b.max_y) > greatest(a.min_y, b.min_y) AND least(a.max_z, b.max_z) > greatest(a.min_z, b.min_z))"""


#: Chunks (z, y, x) that the block queries cut the voxel view into.
BLOCK = (8, 4, 4)


class View:
    """What several steps of one query read, each computed once and kept in the shared folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._held = spark, sf_dir, {}

    def _kept(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._held:
            path = shared_folder(self.spark, name)
            make().write.parquet(path)
            self._held[name] = self.spark.read.parquet(path)
        return self._held[name]

    def voxels(self) -> DataFrame:
        return self._kept("voxels", lambda: embedding_voxels(self.spark, self.sf_dir))

    def thresholds(self) -> DataFrame:
        return self._kept("thresholds", lambda: _tile_thresholds(self.voxels()))

    def sizes(self) -> DataFrame:
        return self._kept("tiles", lambda: tiles_in_a_row(self.voxels()))

    def cameras(self) -> DataFrame:
        return self.sizes().select(F.expr(f"cast(setup div {PER_CAMERA} as int)").alias("camera"), "setup")

    def chunks(self) -> DataFrame:
        return self._kept("chunks", lambda: stores.to_chunks(self.voxels(), BLOCK))

    def ranges(self) -> tuple[DataFrame, DataFrame]:
        found = self._kept("overlaps", lambda: geometry.overlap_pairs(geometry.world_boxes(self.sizes())))
        return tuple(geometry.pixel_ranges(found, self.sizes(), side) for side in "ab")

    def constraints(self) -> DataFrame:
        floors = pairs.floors(self.thresholds())
        return self._kept("constraints", lambda: pairs.constraints(pairs.gated(pairs.intersection(self.voxels(), *self.ranges(), floors), GATE, FRACTION)))

    def classified(self) -> DataFrame:
        empty = emptiness.by_tile(emptiness.columns(self.voxels(), thresholds.pooled(self.voxels(), EMPTY_AT), EMPTY_PART))
        return tilestats.classified(tilestats.moments(self.voxels(), self.thresholds()), empty)

    def targets(self) -> DataFrame:
        solved = gains.solve(self.constraints(), self.cameras().select("setup", F.col("camera").alias("grp")), LAM)
        return self._kept("targets", lambda: gains.targets(self.classified(), solved))


def _overlaps(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    view = View(spark, sf_dir)
    voxels, tiles = view.voxels(), view.sizes()
    return voxels, tiles, geometry.overlap_pairs(geometry.world_boxes(tiles))


@query(f"{BASE}, {TILE_BOXES} SELECT * FROM boxes")
def world_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.world_boxes(tiles_in_a_row(embedding_voxels(spark, sf_dir))).select("setup", *(f"{m}_{c}" for m in ("min", "max") for c in "xyz"))


@query(f"{BASE}, {TILE_BOXES}, {OVERLAPS} SELECT * FROM laps")
def overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overlaps(spark, sf_dir)[2]


@query(f"{BASE}, {TILE_BOXES}, {OVERLAPS} SELECT a, b, CAST(min_x - 6 * a AS INT) AS lo_x, 0 AS lo_y, 0 AS lo_z, CAST(max_x - 6 * a AS INT) AS hi_x, CAST(max_y AS INT) AS hi_y, CAST(max_z AS INT) AS hi_z FROM laps")
def pixel_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tiles, found = _overlaps(spark, sf_dir)
    return geometry.pixel_ranges(found, tiles, "a")


def _pair_inputs(spark: SparkSession, sf_dir: str):
    voxels, tiles, found = _overlaps(spark, sf_dir)
    thr = pairs.floors(_tile_thresholds(voxels))
    return voxels, geometry.pixel_ranges(found, tiles, "a"), geometry.pixel_ranges(found, tiles, "b"), thr


MATCHED = """matched AS (SELECT a.setup AS a, b.setup AS b, greatest(ta.threshold, tb.threshold) AS thr, CAST(a.v AS DOUBLE) AS va, CAST(b.v AS DOUBLE) AS vb FROM voxel a JOIN voxel b ON b.setup = a.setup + 1 AND b.z = a.z AND b.y = a.y AND b.x = a.x - 6
    JOIN otsu ta ON ta.setup = a.setup JOIN otsu tb ON tb.setup = b.setup)"""
INTERSECTION = """inter AS (SELECT a, b, thr, count(*) FILTER (va > thr AND vb > thr) AS n_a, count(*) FILTER (va > thr AND vb > thr) AS n_b, count(*) AS n_overlap, count(*) AS n_overlap_b, median(va) FILTER (va > thr AND vb > thr) AS med_a, median(vb) FILTER (va > thr AND vb > thr) AS med_b FROM matched GROUP BY a, b, thr)"""
GATE, FRACTION = 8, 0.001


@query(f"{TILES}, {MATCHED}, {INTERSECTION} SELECT a, b, thr, n_a, n_b, n_overlap, n_overlap_b, med_a, med_b, CASE WHEN least(n_a, n_b) < {GATE} THEN 'foreground ' || least(n_a, n_b) || ' of {GATE}' WHEN n_a < {FRACTION} * n_overlap OR n_b < {FRACTION} * n_overlap_b THEN 'fraction ' || CASE WHEN n_a < {FRACTION} * n_overlap THEN n_a || ' of ' || n_overlap ELSE n_b || ' of ' || n_overlap_b END END AS reason FROM inter")
def pair_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.gated(pairs.intersection(*_pair_inputs(spark, sf_dir)), GATE, FRACTION)


@query(f"""{TILES}, {TILE_BOXES}, {OVERLAPS}, o AS (SELECT laps.*, greatest(ta.threshold, tb.threshold) AS thr FROM laps JOIN otsu ta ON ta.setup = a JOIN otsu tb ON tb.setup = b),
  pa AS (SELECT a, b, thr, count(*) FILTER (v > thr) AS n_a, count(*) AS n_overlap, median(CAST(v AS DOUBLE)) FILTER (v > thr) AS med_a FROM o JOIN voxel ON setup = a AND x + 6 * setup >= min_x AND x + 6 * setup < max_x AND z < max_z GROUP BY a, b, thr),
  pb AS (SELECT a, b, thr, count(*) FILTER (v > thr) AS n_b, count(*) AS n_overlap_b, median(CAST(v AS DOUBLE)) FILTER (v > thr) AS med_b FROM o JOIN voxel ON setup = b AND x + 6 * setup >= min_x AND x + 6 * setup < max_x AND z < max_z GROUP BY a, b, thr)
SELECT a, b, thr, n_a, n_b, n_overlap, n_overlap_b, med_a, med_b FROM pa JOIN pb USING (a, b, thr)""")
def pair_independent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.independent(*_pair_inputs(spark, sf_dir))


@query(f"""{TILES}, {MATCHED}, fore AS (SELECT a, b, va, vb / greatest(va, 1e-12) AS r FROM matched WHERE va > thr AND vb > thr), split AS (SELECT a, b, median(va) AS split, count(*) AS n FROM fore GROUP BY a, b),
  d AS (SELECT a, b, n, median(r) FILTER (va <= split) AS ratio_low, median(r) FILTER (va > split) AS ratio_high, count(*) FILTER (va <= split) AS n_low, count(*) FILTER (va > split) AS n_high FROM fore JOIN split USING (a, b) GROUP BY a, b, n)
SELECT a, b, n, round(ratio_low, 6) AS ratio_low, round(ratio_high, 6) AS ratio_high, coalesce(n >= 128 AND n_low >= 32 AND n_high >= 32 AND ratio_low > 0 AND abs(ratio_high / ratio_low - 1) > 0.15, false) AS unstable FROM d""")
def pair_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pairs.drift(*_pair_inputs(spark, sf_dir)))


CONSTRAINTS = f"cons AS (SELECT a, b, ln(med_a) - ln(med_b) AS d, CAST(least(n_a, n_b) AS DOUBLE) AS w FROM inter WHERE least(n_a, n_b) >= {GATE} AND n_a >= {FRACTION} * n_overlap)"
LAM = 1e-6


@query(f"{TILES}, {MATCHED}, {INTERSECTION}, {CONSTRAINTS} SELECT a, b, round(d, 6) AS d, w FROM cons")
def pair_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(View(spark, sf_dir).constraints())


# two cameras: the solution in closed form, g_0 = -g_1 = D / (2 W + lam)
CAMERA_GAINS = f"""two AS (SELECT d, w / median(w) OVER () AS u FROM cons WHERE a // 5 <> b // 5), tot AS (SELECT sum(u) AS w, sum(u * d) AS d FROM two),
  gains AS (SELECT setup, exp(CASE WHEN setup // 5 = 0 THEN 1 ELSE -1 END * coalesce(tot.d / (2 * tot.w + {LAM}), 0)) AS gain FROM (SELECT DISTINCT setup FROM voxel), tot)"""


@query(f"{TILES}, {MATCHED}, {INTERSECTION}, {CONSTRAINTS}, {CAMERA_GAINS} SELECT setup, round(gain, 6) AS gain FROM gains")
def camera_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = View(spark, sf_dir)
    return rounded(gains.solve(view.constraints(), view.cameras().select("setup", F.col("camera").alias("grp")), LAM))


# tiles in a row overlap their neighbours only: the tridiagonal system is eliminated upwards and solved downwards
TILE_GAINS = """units AS (SELECT a AS i, w / median(w) OVER () AS u, d FROM cons), rows_ AS (SELECT s.i, 0.1 + coalesce(r.u, 0) + coalesce(l.u, 0) AS diag, coalesce(r.u, 0) AS up, coalesce(l.u, 0) AS low, coalesce(r.u * r.d, 0) - coalesce(l.u * l.d, 0) AS rhs
    FROM (SELECT DISTINCT setup AS i FROM voxel) s LEFT JOIN units r ON r.i = s.i LEFT JOIN units l ON l.i = s.i - 1),
  upwards AS (SELECT i, -up / diag AS c, rhs / diag AS q FROM rows_ WHERE i = 0
    UNION ALL SELECT n.i, -n.up / (n.diag + n.low * p.c), (n.rhs + n.low * p.q) / (n.diag + n.low * p.c) FROM upwards p JOIN rows_ n ON n.i = p.i + 1),
  downwards AS (SELECT i, q AS g FROM upwards WHERE i = (SELECT max(i) FROM rows_) UNION ALL SELECT u.i, u.q - u.c * p.g FROM downwards p JOIN upwards u ON u.i = p.i - 1)"""


@query(f"{TILES.replace('WITH', 'WITH RECURSIVE', 1)}, {MATCHED}, {INTERSECTION}, {CONSTRAINTS}, {TILE_GAINS} SELECT i AS setup, round(exp(g), 6) AS gain FROM downwards")
def tile_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = View(spark, sf_dir)
    return rounded(gains.solve(view.constraints(), view.cameras().select("setup", F.col("setup").alias("grp")), 0.1))


@query(f"{TILES}, {MATCHED}, {INTERSECTION}, {CONSTRAINTS}, {CAMERA_GAINS} SELECT CAST(setup // 5 AS INT) AS camera, round(median(gain), 6) AS median_gain, round(min(gain), 6) AS min_gain, round(max(gain), 6) AS max_gain, count(*) AS n_tiles FROM gains GROUP BY 1")
def camera_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = View(spark, sf_dir)
    solved = gains.solve(view.constraints(), view.cameras().select("setup", F.col("camera").alias("grp")), LAM)
    return rounded(gains.camera_summary(rounded(solved), view.cameras()))


LIMITS = tilestats.Limits()
KIND = f"CASE WHEN NOT (n_foreground >= {LIMITS.min_tile_fraction} * n_voxels AND std > 0 AND all_std >= {LIMITS.min_uniform_std}) OR std IS NULL THEN 'empty' WHEN empty_area >= {LIMITS.min_background_area} THEN 'bimodal' ELSE 'uniform' END"
KINDS = f"kinds AS (SELECT moments.*, empty_area, {KIND} AS kind FROM moments JOIN areas USING (setup))"
TARGETS = """tgt AS (SELECT kinds.*, gain FROM kinds JOIN gains USING (setup)), mid AS (SELECT median(CASE kind WHEN 'bimodal' THEN mean WHEN 'uniform' THEN all_mean END / gain) AS target_mean, median(CASE kind WHEN 'bimodal' THEN std WHEN 'uniform' THEN all_std END / gain) AS target_std FROM tgt),
  targets AS (SELECT tgt.*, target_mean, target_std, gain * target_mean AS corrected_mean, gain * target_std AS corrected_std FROM tgt, mid)"""
ALL = f"{TILES}, {MOMENTS}, {COLUMNS}, {AREAS}, {KINDS}"
ALL_TARGETS = f"{ALL}, {MATCHED}, {INTERSECTION}, {CONSTRAINTS}, {CAMERA_GAINS}, {TARGETS}"


@query(f"{ALL} SELECT setup, round(empty_area, 6) AS empty_area, kind FROM kinds")
def classify_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(View(spark, sf_dir).classified().select("setup", "empty_area", "kind"))


@query(f"{ALL_TARGETS} SELECT setup, kind, round(gain, 6) AS gain, round(target_mean, 5) AS target_mean, round(target_std, 5) AS target_std, round(corrected_mean, 5) AS corrected_mean, round(corrected_std, 5) AS corrected_std FROM targets")
def gain_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(View(spark, sf_dir).targets().select("setup", "kind", F.round("gain", 6).alias("gain"), *(F.round(c, 5).alias(c) for c in ("target_mean", "target_std", "corrected_mean", "corrected_std"))))


# fields of a known form stand for fitted ones: their arithmetic is what the two engines compare
FIELDS = "fields AS (SELECT DISTINCT camera, y, x, CAST(1 AS DOUBLE) + CAST(0.01 AS DOUBLE) * (x - 3) + CAST(0.02 AS DOUBLE) * (y - 4) AS flat, CAST(30 AS DOUBLE) + camera AS dark FROM voxel)"
FLOORED = "coef AS (SELECT camera, y, x, 1 / flat AS slope, -dark / flat AS shift FROM fields)"


def known_fields(voxels: DataFrame) -> DataFrame:
    frame = voxels.select("camera", "y", "x").distinct()
    return frame.select("camera", "y", "x", (1 + 0.01 * (F.col("x") - 3) + 0.02 * (F.col("y") - 4)).alias("flat"), (30.0 + F.col("camera")).alias("dark"))


OUT = "CAST(round_even(least(greatest({}, 0), 65535), 0) AS INT) AS v"


@query(f"{BASE}, {FIELDS}, {FLOORED} SELECT camera, setup, z, y, x, {OUT.format('v * slope + shift')} FROM voxel JOIN coef USING (camera, y, x)")
def correct_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    voxels = embedding_voxels(spark, sf_dir)
    return correcting.correct(voxels, known_fields(voxels))


RESCALE = f"par AS (SELECT setup, CASE kind WHEN 'empty' THEN 'none' ELSE kind END AS mode, threshold AS thr, corrected_mean AS m, least(target_std / corrected_std, {LIMITS.max_gain_scale}) AS s, target_mean AS t FROM targets)"


@query(f"{ALL_TARGETS}, {RESCALE} SELECT camera, setup, z, y, x, {OUT.format(chr(10) + 'CASE WHEN mode = $$uniform$$ OR (mode = $$bimodal$$ AND v > thr) THEN (v - m) * s + t ELSE v END'.replace('$$', chr(39)))} FROM voxel JOIN par USING (setup)")
def correct_intensity(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = View(spark, sf_dir)
    return correcting.correct(view.voxels(), None, correcting.rescaling(view.targets()))


BOTH = """CASE mode WHEN 'uniform' THEN greatest(v * (slope * s) + (shift * s + (t - m * s)), t - m * s) WHEN 'bimodal' THEN CASE WHEN v * slope + shift > thr THEN (v * slope + shift) * s + (t - m * s) ELSE v * slope + shift END ELSE v * slope + shift END"""


@query(f"{ALL_TARGETS}, {RESCALE}, {FIELDS}, {FLOORED} SELECT camera, setup, z, y, x, {OUT.format(BOTH)} FROM voxel JOIN par USING (setup) JOIN coef USING (camera, y, x)")
def correct_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = View(spark, sf_dir)
    return correcting.correct(view.voxels(), known_fields(view.voxels()), correcting.rescaling(view.targets()))


@query(f"{BASE}, {FIELDS} SELECT camera, setup, z, y, x, round(greatest((v - dark) / flat, 0), 6) AS basic, round(((v - dark) / flat + 5) * 2, 6) AS library FROM voxel JOIN fields USING (camera, y, x)")
def correction_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    voxels = embedding_voxels(spark, sf_dir)
    rows = voxels.join(known_fields(voxels), ["camera", "y", "x"])
    raw, flat, dark = F.col("v").cast("double"), F.col("flat"), F.col("dark")
    return rounded(rows.select("camera", "setup", "z", "y", "x", basic_corrected(raw, flat, dark).alias("basic"), library_corrected(raw, flat, dark, 5.0, 2.0).alias("library")))


@query(f"{BASE}, f AS (SELECT DISTINCT camera, y, x, CASE WHEN x = 0 THEN -1.0 ELSE 0.5 * x END * (1 - camera) + camera AS flat, 7.0 AS dark FROM voxel) SELECT f.camera, y, x, round(CASE WHEN low <= 0 THEN greatest(flat, 0.001) ELSE flat END, 6) AS flat, round(dark, 6) AS dark FROM f JOIN (SELECT camera, min(flat) AS low FROM f GROUP BY camera) l ON l.camera = f.camera")
def flat_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = embedding_voxels(spark, sf_dir).select("camera", "y", "x").distinct()
    flat = F.when(F.col("x") == 0, -1.0).otherwise(0.5 * F.col("x")) * (1 - F.col("camera")) + F.col("camera")
    return rounded(correcting.floored(frame.select("camera", "y", "x", flat.alias("flat"), F.lit(7.0).alias("dark"))))


@query(f"{BASE}, {FIELDS} SELECT camera, CAST(y // 3 AS INT) AS y, CAST(x // 3 AS INT) AS x, round(avg(flat), 6) AS flat, round(avg(dark), 6) AS dark FROM fields GROUP BY camera, y // 3, x // 3")
def field_block_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(levels.block_mean(known_fields(embedding_voxels(spark, sf_dir)), 3, 3, "flat", "dark"))


@query(f"{BASE}, {FIELDS}, t AS (SELECT unnest(range(10)) AS t) SELECT camera, CAST(a.t AS INT) AS y, CAST(b.t AS INT) AS x, round(flat, 6) AS flat, round(dark, 6) AS dark FROM t a, t b, fields WHERE fields.y = least(a.t, 7) AND fields.x = least(b.t, 7)")
def field_edge_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(levels.fitted_to(known_fields(embedding_voxels(spark, sf_dir)), 10, 10).select("camera", "y", "x", "flat", "dark"))


@query(f"{BASE} SELECT camera, setup, CAST(z // 2 AS INT) AS z, CAST(y // 2 AS INT) AS y, CAST(x // 3 AS INT) AS x, CAST(round_even(avg(v), 0) AS INT) AS v FROM voxel GROUP BY camera, setup, z // 2, y // 2, x // 3")
def pyramid_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return levels.downsample(embedding_voxels(spark, sf_dir), 2, 2, 3)


@query(f"""{BASE}, s AS (SELECT setup, CAST(k AS INT) AS level, CAST(ceil((max(z) + 1) / f) AS INT) AS nz, CAST(ceil((max(y) + 1) / f) AS INT) AS ny, CAST(ceil((max(x) + 1) / f) AS INT) AS nx FROM voxel, (VALUES (0, 1), (1, 2), (2, 4)) AS t(k, f) GROUP BY setup, k, f)
SELECT s.setup, s.level, CAST(greatest(round_even(o.nz / s.nz, 0), 1) AS INT) AS fz, CAST(greatest(round_even(o.ny / s.ny, 0), 1) AS INT) AS fy, CAST(greatest(round_even(o.nx / s.nx, 0), 1) AS INT) AS fx FROM s JOIN s o ON o.setup = s.setup AND o.level = 0""")
def level_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = embedding_voxels(spark, sf_dir).groupBy("setup").agg(*((F.max(c) + 1).alias(c) for c in "zyx"))
    at = F.explode(F.array(*(F.struct(F.lit(k).alias("level"), F.lit(f).alias("f")) for k, f in ((0, 1), (1, 2), (2, 4)))))
    rows = sizes.withColumn("l", at)
    return levels.level_factors(rows.select("setup", F.col("l.level").alias("level"), *(F.ceil(F.col(c) / F.col("l.f")).cast("int").alias(f"n{c}") for c in "zyx")))


def _resize_sql(n_in: int, n_out: int, name: str) -> str:
    place = f"least(greatest({n_in} / {n_out}.0 * (k + 0.5) - 0.5, 0), {n_in - 1})"
    return f"w{name} AS (SELECT k AS to_, low AS frm, 1 - (c - low) AS w FROM p{name} UNION ALL SELECT k, low + 1, c - low FROM p{name})", f"p{name} AS (SELECT k, {place} AS c, least(floor({place}), {n_in - 2}) AS low FROM (SELECT unnest(range({n_out})) AS k))"


_WY, _PY = _resize_sql(8, 5, "y")
_WX, _PX = _resize_sql(8, 13, "x")


@query(f"{BASE}, {FIELDS}, {_PY}, {_WY}, {_PX}, {_WX} SELECT camera, CAST(wy.to_ AS INT) AS y, CAST(wx.to_ AS INT) AS x, round(sum(wy.w * wx.w * flat), 6) AS flat FROM fields JOIN wy ON wy.frm = y JOIN wx ON wx.frm = x GROUP BY camera, wy.to_, wx.to_")
def resize_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(levels.resize(known_fields(embedding_voxels(spark, sf_dir)), (8, 8), (5, 13), "flat"))


@query(f"""{BASE}, {FIELDS}, b AS (SELECT k, i, cos(pi() * k * (2 * i + 1) / 16) * sqrt(CASE WHEN k = 0 THEN 1 / 8.0 ELSE 2 / 8.0 END) AS b FROM (SELECT unnest(range(8)) AS k), (SELECT unnest(range(8)) AS i))
SELECT camera, CAST(u.k AS INT) AS u, CAST(w.k AS INT) AS v, round(sum(u.b * w.b * flat), 6) + 0.0 AS coefficient FROM fields JOIN b u ON u.i = y JOIN b w ON w.i = x GROUP BY camera, u.k, w.k""")
def dct2(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = levels.dct2(known_fields(embedding_voxels(spark, sf_dir)), (8, 8), "flat")
    return found.select("camera", "u", "v", (F.round("coefficient", 6) + 0.0).alias("coefficient"))


@query(f"{BASE} SELECT camera, setup, z, y, x, CAST(sign(v - 1000) * greatest(abs(v - 1000) - 50.5, 0) AS DOUBLE) + 0.0 AS v FROM voxel")
def soft_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_voxels(spark, sf_dir).select("camera", "setup", "z", "y", "x", (shrink((F.col("v") - 1000).cast("double"), F.lit(50.5)) + 0.0).alias("v"))


@query(f"""{BASE}, b AS (SELECT camera, least(floor((v - 700) / 0.5), 999) AS bin, count(*) AS n FROM voxel WHERE v BETWEEN 700 AND 1200 GROUP BY 1, 2), t AS (SELECT camera, sum(n) AS t FROM b GROUP BY camera)
SELECT camera, round(-sum(n / t / 0.5 * ln(n / t / 0.5)) * 0.5, 6) AS entropy FROM b JOIN t USING (camera) GROUP BY camera""")
def histogram_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(levels.histogram_entropy(embedding_voxels(spark, sf_dir), 700.0, 1200.0))


@query(f"{LI}, {OTSU} SELECT setup, round(li, 6) AS thr FROM otsu JOIN li USING (setup)")
def tile_floor(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = thresholds.catalogue(thresholds.histogram(embedding_voxels(spark, sf_dir), "setup"), "setup")
    return rounded(pairs.floors(found, "li"))


def _chunks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    view = View(spark, sf_dir)
    return view.chunks(), view.voxels().select("camera", "setup").distinct()


@query(_SQL["column_stats"])
def block_column_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = orderstats.merge(blocks.fit(*_chunks(spark, sf_dir)))
    return orderstats.quantile_planes(merged, "camera", "y", "x")


@query(_SQL["threshold_catalogue"])
def block_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(thresholds.catalogue(blocks.histogram(_chunks(spark, sf_dir)[0]), "setup"))


@query(_SQL["correct_both"])
def block_correct_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = View(spark, sf_dir)
    found = blocks.correct(view.chunks(), view.cameras(), known_fields(view.voxels()), correcting.rescaling(view.targets()), BLOCK[1:])
    return stores.to_voxels(found, view.cameras())


@query(f"{BASE} SELECT camera, setup, CAST(z // 2 AS INT) AS z, CAST(y // 2 AS INT) AS y, CAST(x // 2 AS INT) AS x, CAST(round_even(avg(v), 0) AS INT) AS v FROM voxel GROUP BY camera, setup, z // 2, y // 2, x // 2")
def block_pyramid_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks, cameras = _chunks(spark, sf_dir)
    return stores.to_voxels(blocks.downsample(chunks, 2, 2, 2, 1), cameras)


def _pair_chunks(view: View) -> blockpairs.Crops:
    return blockpairs.matched(view.chunks(), *view.ranges(), pairs.floors(view.thresholds()), BLOCK)


@query(_SQL["tile_moments"])
def block_tile_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds and moments from one histogram that is summed where chunks are read."""
    counts = blockstats.counts(View(spark, sf_dir).chunks()).select("setup", F.col("v").cast("int").alias("v"), "n")
    return rounded(tilestats.moments_of_counts(counts, thresholds.resolve(counts, "otsu", "setup")))


@query(f"""{BASE}, {FIELDS}, c AS (SELECT setup, greatest((v - dark) / flat, 0) AS v FROM voxel JOIN fields USING (camera, y, x)), e AS (SELECT setup, min(v) AS low, max(v) AS high FROM c GROUP BY setup),
  hist AS (SELECT setup, low + (bin + 0.5::DOUBLE) * ((high - low) / 256) AS v, n FROM (SELECT setup, low, high, least(floor((v - low) / (high - low) * 256), 255) AS bin, count(*) AS n FROM c JOIN e USING (setup) GROUP BY 1, 2, 3, 4)), {OTSU}
SELECT setup, round(threshold, 4) AS threshold, round(avg(v) FILTER (v > threshold), 4) AS mean, round(stddev_pop(v) FILTER (v > threshold), 4) AS std, round(avg(v) FILTER (v <= threshold), 4) AS bg_mean, round(stddev_pop(v) FILTER (v <= threshold), 4) AS bg_std,
  round(avg(v), 4) AS all_mean, round(stddev_pop(v), 4) AS all_std, count(*) FILTER (v > threshold) AS n_foreground, count(*) AS n_voxels FROM c JOIN otsu USING (setup) GROUP BY setup, threshold""")
def block_corrected_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds and moments of corrected voxels, chunk by chunk; no voxel is a row."""
    view = View(spark, sf_dir)
    chunks = blocks.corrected_reals(view.chunks(), view.cameras(), known_fields(view.voxels()), BLOCK[1:])
    own = thresholds.otsu(blockstats.counts(chunks, "<f8").filter("binned").drop("binned"), "setup").withColumnRenamed("otsu", "threshold")
    return rounded(blockstats.moments(chunks, own), 4).drop("separation")


@query(_SQL["pooled_threshold"])
def block_pooled_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = View(spark, sf_dir)
    return blockstats.pooled(view.chunks(), view.cameras())


@query(_SQL["emptiness_frame"])
def block_emptiness_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = View(spark, sf_dir)
    limits = blockstats.pooled(view.chunks(), view.cameras(), EMPTY_AT)
    return rounded(emptiness.by_pixel(emptiness.judged(blockstats.column_sums(view.chunks(), view.cameras(), limits), EMPTY_PART)))


@query(_SQL["pair_intersection"])
def block_pair_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.gated(_pair_chunks(View(spark, sf_dir)).found(), GATE, FRACTION)


@query(_SQL["pair_drift"])
def block_pair_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_pair_chunks(View(spark, sf_dir)).drift())


@query(_SQL["pair_independent"])
def block_pair_independent(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = View(spark, sf_dir)
    return blockpairs.alone(view.chunks(), *view.ranges(), pairs.floors(view.thresholds()), BLOCK).found()


_STEPS = {1: (1, 2, 2), 2: (3, 4, 4), 3: (5, 8, 8)}


@query(f"{BASE} " + " UNION ALL ".join(f"SELECT camera, setup, {k} AS level, CAST(z // {fz} AS INT) AS z, CAST(y // {fy} AS INT) AS y, CAST(x // {fx} AS INT) AS x, CAST(round_even(avg(v), 0) AS INT) AS v FROM voxel GROUP BY camera, setup, z // {fz}, y // {fy}, x // {fx}" for k, (fz, fy, fx) in _STEPS.items()))
def block_pyramid_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every level from one reading of chunks that the factors don't divide."""
    view = View(spark, sf_dir)
    found = blocks.pyramid(view.chunks(), view.sizes().selectExpr("setup", "size_z as nz", "size_y as ny", "size_x as nx"), _STEPS, (3, 4, 4))
    return stores.to_voxels(found, view.cameras(), "level")


@query(f"""{BASE}, {FIELDS}, c AS (SELECT setup, greatest((v - dark) / flat, 0) AS v FROM voxel JOIN fields USING (camera, y, x)), e AS (SELECT setup, min(v) AS low, max(v) AS high FROM c GROUP BY setup),
  hist AS (SELECT setup, low + (bin + 0.5::DOUBLE) * ((high - low) / 256) AS v, n FROM (SELECT setup, low, high, least(floor((v - low) / (high - low) * 256), 255) AS bin, count(*) AS n FROM c JOIN e USING (setup) GROUP BY 1, 2, 3, 4)), {OTSU}
SELECT setup, round(threshold, 6) AS otsu FROM otsu""")
def otsu_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Otsu's threshold of corrected voxels, which are no counts: 256 equal bins over each tile's range."""
    voxels = embedding_voxels(spark, sf_dir)
    rows = voxels.join(known_fields(voxels), ["camera", "y", "x"])
    rows = rows.select("setup", basic_corrected(F.col("v").cast("double"), F.col("flat"), F.col("dark")).alias("v"))
    return rounded(thresholds.otsu(thresholds.binned(rows, "setup"), "setup"))


@query(f"{BASE}, {FIELDS} SELECT setup, count(*) AS n, round(quantile_cont(greatest((v - dark) / flat, 0), 0.05), 6) AS low FROM voxel JOIN fields USING (camera, y, x) GROUP BY setup")
def selected_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A percentile of each tile's corrected voxels by radix selection over all tasks."""
    voxels = embedding_voxels(spark, sf_dir)
    rows = voxels.join(known_fields(voxels), ["camera", "y", "x"])
    rows = rows.select("setup", basic_corrected(F.col("v").cast("double"), F.col("flat"), F.col("dark")).alias("v"))
    return rounded(selection.percentiles(rows, ["setup"], "v", 0.05).withColumnRenamed("result", "low"))


@query()
def basic_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatfield.fit_cameras(orderstats.column_stats(embedding_voxels(spark, sf_dir)))


@query(f"{BASE}, {FIELDS} SELECT camera, y, x, round(flat / avg(flat) OVER (PARTITION BY camera), 4) AS flat, round(dark, 2) AS dark FROM fields")
def known_field_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stack made from known fields, flat and dark; the fit finds both again."""
    truth = known_fields(embedding_voxels(spark, sf_dir))
    stack = truth.select("camera", F.explode(F.sequence(F.lit(0), F.lit(20))).alias("plane"), "y", "x", "flat", "dark")
    stack = stack.select("camera", "plane", "y", "x", (F.col("flat") * (500 + 50 * F.col("plane")) + F.col("dark")).alias("v"))
    found = flatfield.fit_cameras(stack)
    return found.select("camera", "y", "x", F.round(F.col("flat").cast("double"), 4).alias("flat"), F.round(F.col("dark").cast("double"), 2).alias("dark"))


@query()
def autotune_lambda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatfield.tune_cameras(orderstats.column_stats(embedding_voxels(spark, sf_dir)))


def queries() -> dict[str, Query]:
    from . import store_queries  # noqa: F401  registers its own, by names of this module

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    queries()
    return dict(_SQL)
