"""More queries over the driver's tables: ledgers, sinks, plans, names and the rows behind figures, each with its SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelflux.functions import fields as fx
from voxelflux.operators import aggregates, grid, ledger
from voxelflux.plans import energy, reports, views
from voxelflux.plans.journal import Journal
from voxelflux.plans.queries import _SEAM, CHAIN, CUBE, FLUX, N, POINT, QUAD, REGIME, SIGMA, _derive, _energy, _filter, _snapshots, cubes, flux, query, r, rounded, table
from voxelflux.session import shared_dir, ship
from voxelflux.sources import bricks
from voxelflux.streaming import bricks as stream
from voxelflux.streaming import rollups, tail

#: Bytes of a float, lowest first, as a string of bits.
BITS = "substr(b, 25, 8) || substr(b, 17, 8) || substr(b, 9, 8) || substr(b, 1, 8)"
SHA = f"sha256((string_agg({BITS}, '' ORDER BY {{}})::BIT)::BLOB)"


def key_sql(x: str, y: str, z: str) -> str:
    return f"printf('x%04d_y%04d_z%04d', {x}, {y}, {z})"


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Reductions --------------------------------------------------------------------------------------------------------


@query(f"WITH {FLUX} SELECT count(*)::BIGINT AS point_count, {r('quantile_cont(abs(pi)::DOUBLE, 0.99)', 6, 'abs_p99')}, {r('max(abs(pi))', 6, 'abs_max')} FROM f")
def tail_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p99 and maximum of |pi|, from a scan of that column alone."""
    return rounded(reports.tail(flux(spark, sf_dir).select("pi")), 6, "abs_p99", "abs_max")


@query(f"WITH {FLUX} SELECT l_suppkey, {r('quantile_cont(abs(pi)::DOUBLE, 0.99)', 6, 'abs_p99')}, {r('quantile_cont(abs(pi)::DOUBLE, 0.5)', 6, 'abs_p50')} FROM f GROUP BY l_suppkey")
def grouped_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two percentiles of each group, narrowed together in one set of passes."""
    out = aggregates.percentiles(flux(spark, sf_dir), ["l_suppkey"], F.abs("pi"), {"abs_p99": 0.99, "abs_p50": 0.5})
    return rounded(out, 6, "abs_p99", "abs_p50")


@query("SELECT user_id, bool_and(value > 1) AS passed, count(*) FILTER (value <= 1)::BIGINT AS failed FROM events GROUP BY user_id")
def gates_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every check of a snapshot passed; users stand for snapshots."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.bool_and(F.col("value") > 1).alias("passed"), F.count_if(F.col("value") <= 1).alias("failed"))


# Digests and sinks -------------------------------------------------------------------------------------------------

_BITS_OF_CUBE = f"""{CUBE}, e AS (SELECT s, c, z, y, x, v, (v::FLOAT::BIT)::VARCHAR AS b FROM u JOIN pt USING (q)),
d AS (SELECT s, {key_sql("x // 2 * 2", "y // 2 * 2", "z // 2 * 2")} AS tile_key, count(*) // 3 AS n_points, count(*) * 4 AS byte_count, {SHA.format("c, z, y, x")} AS sha256 FROM e GROUP BY ALL)"""


@query(f"SELECT vec_id, {SHA.format('i')} AS sha256, 256::BIGINT AS byte_count FROM (SELECT vec_id, i, (embedding[i]::FLOAT::BIT)::VARCHAR AS b FROM embeddings, range(1, 65) t(i)) GROUP BY vec_id")
def array_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 of each line's 64 float32 values, lowest byte first."""
    lines = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("int").alias("time_index"), F.posexplode("embedding").alias("x", "v")).withColumns({"y": F.lit(0), "z": F.lit(0)})
    ship(spark)
    return bricks.checksums(lines, 64, ["v"]).select(F.col("time_index").cast("long").alias("vec_id"), "sha256", "byte_count")


@query(f"WITH {_BITS_OF_CUBE} SELECT s AS time_index, tile_key, n_points::BIGINT AS n_points, byte_count::BIGINT AS byte_count, sha256 FROM d")
def tile_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SHA-256 of the values of each 2 * 2 * 2 tile, component by component."""
    return bricks.checksums(cubes(spark, sf_dir), 2).drop("n_finite")


@query(f"""WITH {_BITS_OF_CUBE}, m AS (SELECT s, min(v) AS lo, max(v) AS hi FROM u GROUP BY s)
SELECT s AS time_index, count(*)::BIGINT AS n_parts, sum(byte_count)::BIGINT AS byte_count, sha256(string_agg(sha256, '' ORDER BY tile_key)) AS digest, {r("any_value(lo)", 9, "minimum")}, {r("any_value(hi)", 9, "maximum")} FROM d JOIN m USING (s) GROUP BY s""")
def snapshot_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot's digest over those of its tiles in order, with its bytes and extrema."""
    points = cubes(spark, sf_dir)
    sums = bricks.checksums(points, 2)
    digest = aggregates.ordered_digest(sums, ["time_index"], F.col("tile_key"), F.col("sha256")).withColumn("n_parts", F.col("n_parts").cast("long"))
    size = sums.groupBy("time_index").agg(F.sum("byte_count").alias("byte_count"))
    range_ = reports.snapshot_statistics(points, list(energy.U)).select("time_index", "minimum", "maximum")
    return rounded(digest.join(size, "time_index").join(range_, "time_index"), 9, "minimum", "maximum")


@query(f"WITH {_BITS_OF_CUBE} SELECT s AS time_index, tile_key, n_points::BIGINT AS n_points, n_points::BIGINT AS n_finite, sha256 FROM d")
def verified_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots written as bricks and read back: digests of what stands in the files, equal to those of what was sent."""
    return bricks.write_verified(cubes(spark, sf_dir), scratch(spark, "bricks"), 2, N, files=1)


@query(f"WITH {CUBE} SELECT s AS time_index, z, y, x, {r('max(CASE WHEN c = 0 THEN v END)', 9, 'ux')} FROM u JOIN pt USING (q) WHERE z BETWEEN 1 AND 2 GROUP BY ALL")
def bricks_of_a_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bricks written whole, and planes 1 and 2 read back: the scan takes only bricks that hold them."""
    path = scratch(spark, "bricks")
    bricks.write(cubes(spark, sf_dir), path, 2, folders=("zb",))
    return rounded(bricks.read(spark, path, 2, z=(1, 3)).select(*POINT, "ux"), 9, "ux")


@query(f"WITH {CUBE} SELECT s AS time_index, count(*)::BIGINT AS n, {r('min(v)', 9, 'minimum')}, {r('max(v)', 9, 'maximum')}, bool_and(isfinite(v)) AS all_finite FROM u JOIN pt USING (q) WHERE x < 2 AND y < 2 AND z < 2 GROUP BY s")
def smoke_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics of a small box at the origin, as a smoke read takes them."""
    out = reports.snapshot_statistics(grid.crop(cubes(spark, sf_dir), (0, 0, 0), (2, 2, 2)), list(energy.U))
    return rounded(out.select("time_index", "n", "minimum", "maximum", "all_finite"), 9, "minimum", "maximum")


@query(f"""
WITH {CUBE}, {_filter("ub", "u", "c")}, p AS (SELECT s, c, v FROM ub JOIN pt USING (q) WHERE x BETWEEN 1 AND 2 AND y BETWEEN 1 AND 2 AND z BETWEEN 1 AND 2)
SELECT s AS time_index, CASE c WHEN 0 THEN 'bx' WHEN 1 THEN 'by' ELSE 'bz' END AS field, {r("max(abs(v * 1.00001 - v))", 9, "max_diff")}, bool_and(abs(v * 1.00001 - v) <= 2e-6 + 2e-5 * abs(v)) AS close FROM p GROUP BY s, c
""")
def filtered_cache_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored crop of the filtered velocity (here off by a hundred-thousandth) against the velocity filtered anew."""
    new = energy.filtered(cubes(spark, sf_dir), N, sigma=SIGMA).select(*POINT, *energy.UB)
    held = grid.crop(new, (1, 1, 1), (2, 2, 2)).select("time_index", *(F.col(f"l{a}").alias(a) for a in "xyz"), *((F.col(b) * 1.00001).alias(b) for b in energy.UB))
    return rounded(grid.cached_velocity(held, new, (1, 1, 1)), 9, "max_diff")


# Ledgers -----------------------------------------------------------------------------------------------------------


@query("SELECT o_orderkey::VARCHAR AS key, 7::BIGINT AS seq, 'planned' AS event FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1)")
def planned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events to append for a plan: orders are the plan, first lines are what the ledger has."""
    known = table(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").cast("string").alias("key"))
    return ledger.planned(known, table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("key")), 7).select("key", "seq", "event")


_EVENT = "SELECT user_id::VARCHAR AS key, event_id AS seq, CASE WHEN value > 400 THEN 'verified' WHEN value > 250 THEN 'failed' ELSE 'fetching' END AS event, CASE WHEN value > 400 THEN sha256(props) END AS sha256, CASE WHEN value > 400 THEN length(props) END AS byte_count FROM events"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, done = F.col("value"), F.col("value") > 400
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("key"), F.col("event_id").alias("seq"), F.when(done, "verified").when(v > 250, "failed").otherwise("fetching").alias("event"),
        F.when(done, F.sha2("props", 256)).alias("sha256"), F.when(done, F.length("props")).cast("long").alias("byte_count"),
    )


@query(f"""
WITH e AS ({_EVENT}) SELECT key, arg_max(event, seq) AS status, count(*) FILTER (event = 'fetching')::BIGINT AS attempts,
arg_max(sha256, seq) FILTER (sha256 IS NOT NULL) AS sha256, coalesce(arg_max(byte_count, seq) FILTER (sha256 IS NOT NULL), 0)::BIGINT AS byte_count FROM e GROUP BY key
""")
def tile_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status, attempts and last digest of each tile; users stand for tiles."""
    return ledger.state(_events(spark, sf_dir)).fillna(0, ["byte_count"])


@query(f"""
WITH e AS ({_EVENT}), t AS (SELECT key, arg_max(event, seq) AS status, arg_max(sha256, seq) FILTER (sha256 IS NOT NULL) AS sha256 FROM e GROUP BY key),
h AS (SELECT key, max(sha256) AS sha256 FROM e GROUP BY key)
SELECT h.key FROM h LEFT JOIN t ON h.key = t.key AND t.status = 'verified' AND t.sha256 = h.sha256 WHERE t.key IS NULL
""")
def tiles_to_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a resumed acquisition still has to fetch: tiles that are not verified, or whose stored digest differs."""
    events = _events(spark, sf_dir)
    stored = events.groupBy("key").agg(F.max("sha256").alias("sha256"))
    return ledger.to_fetch(events.select("key").distinct(), ledger.state(events), stored)


@query("SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def ledger_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles without their snapshot: lines of orders that are not there as finished ones."""
    snapshots = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return ledger.orphans(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), snapshots, ["l_orderkey"])


@query("SELECT l_orderkey, l_linenumber, count(*)::BIGINT AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.repeated(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT o_orderkey, o_orderstatus, coalesce(n, 0)::BIGINT AS tiles FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey")
def results_with_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results beside what their manifest counts, which may be absent."""
    results = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    counts = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("tiles"))
    return results.join(counts, "o_orderkey", "left").fillna(0, ["tiles"])


@query("SELECT event_id, user_id, event_type FROM events WHERE user_id IN (SELECT s_suppkey FROM supplier)")
def ledger_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of the keys that a table names."""
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("user_id"))
    return ledger.lookup(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), names, ["user_id"])


@query("""
SELECT o_orderkey, count(l_linestatus)::BIGINT AS entries, coalesce(bool_and(sha256(l_linestatus) = sha256(o_orderstatus)), false) AS current FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
""")
def chain_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether reports are the ones that their manifests name: orders are reports, their lines are entries of manifests."""
    reports_ = table(spark, sf_dir, "orders").select("o_orderkey", F.sha2("o_orderstatus", 256).alias("sha256"))
    manifest = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.sha2("l_linestatus", 256).alias("sha256"))
    return ledger.current(reports_, manifest, ["o_orderkey"])


# Plans and names ---------------------------------------------------------------------------------------------------

_ORDERED = f"""t AS (SELECT s, x0, y0, z0, {key_sql("x0", "y0", "z0")} AS tile_key FROM (SELECT DISTINCT s FROM whole), (VALUES (0), (3)) a(z0), (VALUES (0), (3)) b(y0), (VALUES (0), (3)) c(x0))"""


@query(f"WITH {CUBE}, {_ORDERED} SELECT s AS time_index, tile_key, row_number() OVER (PARTITION BY s ORDER BY z0, y0, x0)::INT AS listed, row_number() OVER (PARTITION BY s ORDER BY x0, y0, z0)::INT AS natural FROM t")
def tile_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of each tile of a snapshot in the listing (z first) and in the natural order of tiles (x first)."""
    return grid.ordered(grid.tiles(_snapshots(spark, sf_dir), (N, N, N), (3, 3, 3))).select("time_index", "tile_key", "listed", "natural")


@query(f"WITH {CUBE}, w AS (SELECT DISTINCT s FROM whole) SELECT s AS time_index, 8::BIGINT AS requests, 64::BIGINT AS tiles, 768::BIGINT AS raw_bytes, (64 * 17 + 8 * 96)::BIGINT AS result_bytes, 2560::BIGINT AS workspace_bytes FROM w")
def plan_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.plan(_snapshots(spark, sf_dir), (N, N, N), (2, 2, 2), (1, 1, 1), (2, 2, 2))


@query(f"WITH {CUBE} SELECT s AS time_index, max(x) + 1 AS nx, max(y) + 1 AS ny, max(z) + 1 AS nz, (count(*) // 3)::BIGINT AS n_points, count(*) = 192 AS \"full\" FROM u JOIN pt USING (q) GROUP BY s")
def axis_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.axis_lengths(cubes(spark, sf_dir))


@query("SELECT (vec_id // 3)::INT AS time_index, list_sort(list(DISTINCT (vec_id % 3)::INT))::VARCHAR AS components, count(DISTINCT vec_id % 3) = 3 AS \"full\" FROM embeddings GROUP BY 1")
def component_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which components of each snapshot are there, and whether all three are."""
    rows = table(spark, sf_dir, "embeddings").groupBy(F.floor(F.col("vec_id") / 3).cast("int").alias("time_index")).agg(F.array_sort(F.collect_set((F.col("vec_id") % 3).cast("int"))).alias("c"))
    return rows.select("time_index", F.concat(F.lit("["), F.array_join("c", ", "), F.lit("]")).alias("components"), (F.size("c") == 3).alias("full"))


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice AS sigma, printf('t%06d_sigma_', l_linenumber) || replace(replace(printf('%.8g', l_extendedprice / 7), '-', 'm'), '.', 'p') AS result FROM lineitem")
def result_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of results from time index and filter width: line numbers and prices stand for them."""
    name = fx.result_name(F.col("l_linenumber"), F.col("l_extendedprice") / 7)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_extendedprice").alias("sigma"), name.alias("result"))


@query("SELECT event_id, greatest(0.0::DOUBLE, (epoch_us((SELECT max(ts) FROM events)) - 3600000000 * 24 - epoch_us(ts))::DOUBLE / 3.6e9::DOUBLE) AS hours FROM events")
def hours_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours from each event to a day before the last one, 0 if that has passed."""
    ev = table(spark, sf_dir, "events")
    end = ev.agg(F.max("ts")).first()[0]
    return ev.select("event_id", fx.hours_left(F.col("ts").cast("timestamp"), F.lit(end).cast("timestamp") - F.expr("INTERVAL 24 HOURS")).alias("hours"))


@query("SELECT event_id, printf('%.6e', value) AS shown, replace(props, 'k', '***') AS props, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def shown_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values as figures show them, texts without a secret, and a fact out of stored JSON."""
    return table(spark, sf_dir, "events").select("event_id", fx.scientific(F.col("value")).alias("shown"), fx.redacted(F.col("props"), "k").alias("props"), F.get_json_object("props", "$.k").cast("long").alias("k"))


# Rows behind figures -----------------------------------------------------------------------------------------------

_BUDGET = f"{FLUX}, g AS (SELECT *, wf - wr + pi + l_suppkey * 0.001 AS sb FROM f)"


def _budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return reports.budget_qa(flux(spark, sf_dir).withColumn("s_bar", c("work_full") - c("work_resolved") + c("pi") + c("l_suppkey") * 0.001))


@query(f"WITH {_BUDGET} " + " UNION ALL ".join(f"SELECT {i} AS place, '{n}' AS field, {r(f'sum({c})', 2, 'total')} FROM g" for i, (n, c) in enumerate((("s_bar", "sb"), ("pi", "pi"), ("work_resolved", "wr"), ("work_full", "wf")))))
def totals_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(views.totals(_budget(spark, sf_dir)), 2, "total")


@query(f"""
WITH {_BUDGET}, a AS (SELECT sqrt(avg(pow(wf - wr + pi - sb, 2))) / sqrt(avg(wf * wf) + avg(wr * wr) + avg(pi * pi) + avg(sb * sb)) AS res, abs(sum(sb)) / abs(sum(pi)) AS net FROM g)
SELECT 'identity residual' AS metric, '1.000000e-04' AS threshold, CASE WHEN res <= 1e-4 THEN 'pass' ELSE 'fail' END AS status FROM a
UNION ALL SELECT 'net transport', '1.000000e-02', CASE WHEN net <= 1e-2 THEN 'pass' ELSE 'fail' END FROM a
""")
def gate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.gates(_budget(spark, sf_dir), 1e-4, 1e-2).drop("value")


@query(f"""
WITH {FLUX}, a AS (SELECT count(*) AS n, sum(pi) AS s, coalesce(sum(pi) FILTER (pi > 0), 0) AS ps, coalesce(sum(pi) FILTER (pi < 0), 0) AS ns, count(*) FILTER (pi > 0) AS pc, count(*) FILTER (pi < 0) AS nc, count(*) FILTER (pi = 0) AS zc FROM f),
b AS (SELECT n, 0 AS place, 'positive' AS part, ps AS t, pc AS k FROM a UNION ALL SELECT n, 1, 'negative', ns, nc FROM a UNION ALL SELECT n, 2, 'net', s, zc FROM a)
SELECT place, part, {r("t", 2, "total")}, k::BIGINT AS n, {r("k / n", 9, "volume_fraction")} FROM b
""")
def sign_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(views.signs(reports.weak_asymmetry(flux(spark, sf_dir))), 2, "total"), 9, "volume_fraction")


@query(f"""
WITH {FLUX}, q AS (SELECT {QUAD} AS quadrant, pi FROM f), g AS (SELECT quadrant, count(*) AS n, sum(pi) AS s FROM q GROUP BY quadrant)
SELECT v.place, v.quadrant, coalesce(n, 0)::BIGINT AS n, {r("s / nullif(n, 0)", 6, "conditional_mean")} FROM (VALUES (0, 'Q1'), (1, 'Q2'), (2, 'Q3'), (3, 'Q4')) v(place, quadrant) LEFT JOIN g USING (quadrant)
""")
def quadrant_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(views.quadrants(reports.quadrant_flux(flux(spark, sf_dir))), 6, "conditional_mean")


@query(f"""
WITH {CHAIN}, f AS (SELECT s, q, wf.v AS wf, wr.v AS wr FROM wf JOIN wr USING (s, q)), l AS (SELECT s, 0.5 * sqrt(avg(wf * wf)) AS ef, 0.5 * sqrt(avg(wr * wr)) AS er FROM f GROUP BY s)
SELECT s AS time_index, z, x, {REGIME} AS regime FROM f JOIN l USING (s) JOIN pt USING (q) WHERE y = 2
""")
def regime_plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of one plane of each snapshot, never thinned."""
    points = energy.with_regime(_energy(spark, sf_dir, "work_full", "work_resolved"), ["time_index"], eps_rel=0.5)
    return views.regime_slice(points, "y", 2)


@query(f"WITH {CUBE}, {_derive('gu', 'u', 'c')} SELECT s AS time_index, y, x, {r('v', 9, 'g_xy')} FROM gu JOIN pt USING (q) WHERE c = 0 AND j = 1 AND z = 3")
def gradient_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plane of one component of the velocity gradient; only its transforms are planned."""
    return rounded(grid.plane(_energy(spark, sf_dir, "g_xy"), "z", 3, ["g_xy"]), 9, "g_xy")


def _sigma_sql(sigma: float) -> str:
    cube = CUBE.replace(f"pow({SIGMA} * 2", f"pow({sigma} * 2")
    return f"(WITH {cube}, {_filter('ub', 'u', 'c')} SELECT s AS time_index, {sigma}::DOUBLE AS sigma, {r('sqrt(avg(v * v))', 9, 'rms')}, {r('max(abs(v))', 9, 'max_abs')} FROM ub GROUP BY s)"


@query(f"SELECT * FROM {_sigma_sql(1.0)} UNION ALL SELECT * FROM {_sigma_sql(2.0)}")
def sigma_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filtered velocity of each snapshot at several filter widths, as one batch."""
    sigmas = [1.0, 2.0]
    batch = energy.filtered_batch(cubes(spark, sf_dir), N, sigmas)
    per = F.array(*(F.struct(F.lit(s).alias("sigma"), F.array(*(energy.own(b, i) for b in energy.UB)).alias("v")) for i, s in enumerate(sigmas)))
    rows = batch.select("time_index", F.inline(per)).select("time_index", "sigma", F.explode("v").alias("v"))
    out = rows.groupBy("time_index", "sigma").agg(F.sqrt(F.avg(F.col("v") * F.col("v"))).alias("rms"), F.max(F.abs("v")).alias("max_abs"))
    return rounded(out.orderBy("sigma", "time_index"), 9, "rms", "max_abs")


@query(f"WITH {CHAIN} SELECT s AS time_index, {r('sum(v)', 6, 'total')}, {r('sqrt(avg(v * v))', 9, 'rms')}, count(*)::BIGINT AS n FROM pf GROUP BY s")
def flux_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Total and rms of pi of each snapshot."""
    v = F.col("pi")
    out = _energy(spark, sf_dir, "pi").groupBy("time_index").agg(F.sum(v).alias("total"), F.sqrt(F.avg(v * v)).alias("rms"), F.count(F.lit(1)).alias("n"))
    return rounded(rounded(out, 6, "total"), 9, "rms")


# One-pass validation and streams -----------------------------------------------------------------------------------


@query(f"""
WITH {CUBE}, p AS (SELECT s, c, v, z, y, x FROM u JOIN pt USING (q)), m AS ({_SEAM}),
a AS (SELECT s, 8::BIGINT AS tiles, count(*)::BIGINT AS n, min(v) AS lo, max(v) AS hi, avg(v) AS mean, sqrt(avg(v * v)) AS rms, bool_and(isfinite(v)) AS all_finite FROM u GROUP BY s)
SELECT s AS time_index, axis, tiles, n, {r('lo', 9, 'minimum')}, {r('hi', 9, 'maximum')}, {r('mean', 9, 'mean')}, {r('rms', 9, 'rms')}, all_finite, {r('w', 9, 'wrap_rms')}, {r('i', 9, 'internal_rms')} FROM a JOIN m USING (s)
""")
def frame_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coverage, statistics and seams of every snapshot from one scan, as validation takes them."""
    facts = bricks.tile_facts(cubes(spark, sf_dir), 2, N)
    out = bricks.statistics(facts).join(bricks.seams(facts, N).drop("ratio"), "time_index")
    return rounded(out, 9, "minimum", "maximum", "mean", "rms", "wrap_rms", "internal_rms")


@query(f"WITH {CUBE} SELECT s AS time_index, 8::INTEGER AS tiles, count(*)::BIGINT AS point_count, {r('quantile_cont(abs(v)::DOUBLE, 0.9)', 9, 'abs_percentile')}, {r('max(abs(v))', 9, 'abs_max')}, true AS complete FROM u WHERE c = 0 GROUP BY s")
def streamed_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentile of |ux| of each snapshot from a stream of its tiles, every one of which is delivered twice."""
    base = scratch(spark, "stream")
    key = F.concat_ws("_", *(F.floor(F.col(a) / 2) for a in "zyx"))
    tiles = tail.tile_tails(cubes(spark, sf_dir), key, "ux", N**3, 0.9)
    for _ in range(2):
        tiles.write.mode("append").parquet(f"{base}/tiles")
    out = tail.collected(spark, f"{base}/tiles", f"{base}/out", f"{base}/checkpoint", N**3, 0.9)
    return rounded(out, 9, "abs_percentile", "abs_max")


_CUBE_LEAVES = f"""{_BITS_OF_CUBE}, leaf AS (SELECT s, z, y, x, {SHA.format("c")} AS h FROM e GROUP BY ALL),
l1 AS (SELECT s, z // 2 AS z, y // 2 AS y, x // 2 AS x, sha256(string_agg(h, '' ORDER BY z, y, x)) AS h FROM leaf GROUP BY s, z // 2, y // 2, x // 2),
l2 AS (SELECT s, sha256(string_agg(h, '' ORDER BY z, y, x)) AS h FROM l1 GROUP BY s)"""


@query(f"WITH {_CUBE_LEAVES} SELECT s AS time_index, 2::INTEGER AS level, 0::INTEGER AS z, 0::INTEGER AS y, 0::INTEGER AS x, h AS digest FROM l2 UNION ALL SELECT s, 1::INTEGER, z::INTEGER, y::INTEGER, x::INTEGER, h FROM l1")
def digest_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inner nodes of each snapshot's Merkle tree over its points as tiles."""
    facts = bricks.checksums(cubes(spark, sf_dir), 1)
    place = [F.substring("tile_key", at, 4).cast("int").alias(a) for a, at in (("z", 14), ("y", 8), ("x", 2))]
    return aggregates.tree(facts.select("time_index", *place, F.col("sha256").alias("digest"))).where("level > 0")


@query("SELECT user_id::VARCHAR AS key, arg_max(event_type, (ts, event_type)) AS status, count(*) FILTER (event_type = 'fetching')::BIGINT AS attempts, count(*)::BIGINT AS events FROM events GROUP BY user_id")
def compacted_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of a ledger that was written in four appends and compacted after two of them."""
    ev = table(spark, sf_dir, "events")
    seq = F.unix_micros(F.col("ts").cast("timestamp"))
    rows = ev.select(F.col("user_id").cast("string").alias("key"), seq.alias("seq"), F.col("event_type").alias("event"), F.lit(None).cast("string").alias("sha256"), F.lit(None).cast("long").alias("byte_count"))
    held = Journal(spark, scratch(spark, "journal"))
    for part in range(4):
        held.append(rows.where(F.col("seq") % 4 == part))
        if part in (1, 3):
            held.compact()
    counts = ev.groupBy(F.col("user_id").cast("string").alias("key")).agg(F.count(F.lit(1)).alias("events"))
    return held.state().join(counts, "key").select("key", "status", "attempts", "events")


@query(f"WITH {CUBE} SELECT s AS time_index, 8::BIGINT AS n_tiles, count(*)::BIGINT AS n, {r('avg(v)', 9, 'mean')}, {r('sqrt(avg(v * v))', 9, 'rms')}, {r('max(abs(v))', 9, 'max_abs')} FROM u WHERE c = 1 GROUP BY s")
def streamed_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Moments of uy of each snapshot, kept up from a stream that delivers every tile twice."""
    base = scratch(spark, "rollup")
    key = F.concat_ws("_", *(F.floor(F.col(a) / 2) for a in "zyx"))
    tiles = stream.tile_moments(cubes(spark, sf_dir), key, "uy").withColumn("arrived", F.lit("2026-01-01").cast("timestamp"))
    for _ in range(2):
        tiles.write.mode("append").parquet(f"{base}/tiles")
    held = rollups.Rollup(spark, f"{base}/totals")
    rollups.keep_up(spark.readStream.schema(rollups.TILE_SCHEMA).option("maxFilesPerTrigger", 100).parquet(f"{base}/tiles"), held, f"{base}/checkpoint").awaitTermination()
    return rounded(held.totals(), 9, "mean", "rms", "max_abs")


@query(f"WITH {CUBE}, p AS (SELECT s, z, y, x, v FROM u JOIN pt USING (q) WHERE c = 0) SELECT s AS time_index, {key_sql('x // 2 * 2', 'y // 2 * 2', 'z // 2 * 2')} AS tile_key, count(*)::BIGINT AS n, {r('min(v)', 9, 'lowest')}, {r('max(v)', 9, 'highest')} FROM p GROUP BY ALL")
def tile_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extrema of ux in each planned tile: points meet their tile by division, and the box is checked in full."""
    points = cubes(spark, sf_dir)
    tiles = grid.tiles(points.select("time_index").distinct(), (N, N, N), (2, 2, 2))
    on = [F.col("time_index") == F.col("t"), *(F.floor(F.col(a) / 2) * 2 == F.col(f"{a}0") for a in "xyz")]
    joined = points.join(tiles.withColumnRenamed("time_index", "t"), on).where(grid.in_tile())
    out = joined.groupBy("time_index", "tile_key").agg(F.count(F.lit(1)).alias("n"), F.min("ux").alias("lowest"), F.max("ux").alias("highest"))
    return rounded(out, 9, "lowest", "highest")
