"""One query for each operator family, over the driver's tables, each with SQL that gives the same rows.

Tables stand in for fields: lineitem for energy fields (FLUX), embeddings for periodic lines of 64 points (LINE) and
for snapshots of 4 * 4 * 4 points, three vectors each (CUBE), events and orders for ledgers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelflux.functions import fields as fx
from voxelflux.operators import aggregates, grid, ledger, spectral
from voxelflux.plans import energy, reports, views
from voxelflux.session import ship
from voxelflux.sources import analytic, bricks

N = 4
SIGMA = 1.0
POINT = ["time_index", "z", "y", "x"]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = sql.strip()
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flux(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytic.flux(table(spark, sf_dir, "lineitem"))


def cubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return analytic.cubes(table(spark, sf_dir, "embeddings"))


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({c: fx.rounded(F.col(c), digits) for c in names})


def r(expr: str, digits: int, name: str) -> str:
    return f"CASE WHEN round({expr}, {digits}) = 0 THEN 0.0 ELSE round({expr}, {digits}) END AS {name}"


FLUX = "f AS (SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice - 50000 AS pi, l_quantity - 25.5 AS wf, l_discount - 0.05 AS wr FROM lineitem)"
QUAD = "CASE WHEN wf >= 0 AND wr >= 0 THEN 'Q1' WHEN wf >= 0 THEN 'Q2' WHEN wr >= 0 THEN 'Q3' ELSE 'Q4' END"


@query(f"""
WITH {FLUX}, q AS (SELECT {QUAD} AS quadrant, pi FROM f), a AS (SELECT count(*) AS n_all FROM f),
g AS (SELECT quadrant, count(*) AS n, sum(pi) AS s FROM q GROUP BY quadrant),
e AS (SELECT v.quadrant, coalesce(n, 0)::BIGINT AS n, coalesce(s, 0.0) AS s, n_all FROM (VALUES ('Q1'), ('Q2'), ('Q3'), ('Q4')) v(quadrant) LEFT JOIN g USING (quadrant) CROSS JOIN a)
SELECT quadrant, n, {r("n / n_all", 9, "volume_fraction")}, {r("s", 2, "pi_sum")}, {r("s / n_all", 6, "stored_cq")}, {r("s / nullif(n, 0)", 6, "conditional_mean")}, {r("-s / n_all", 6, "les_cq")}, {r("-s / nullif(n, 0)", 6, "les_conditional_mean")} FROM e
""")
def cq_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rounded(reports.quadrant_flux(flux(spark, sf_dir)), 2, "pi_sum")
    return rounded(rounded(out, 9, "volume_fraction"), 6, "stored_cq", "conditional_mean", "les_cq", "les_conditional_mean")


@query(f"""
WITH {FLUX} SELECT count(*)::BIGINT AS covered, count(*)::BIGINT AS point_count, {r("sum(pi)", 2, "parts_sum")}, {r("sum(pi)", 2, "pi_sum")}, {r("sum(abs(pi))", 2, "abs_sum")}, true AS passed FROM f
""")
def cq_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rounded(reports.quadrant_closure(flux(spark, sf_dir)), 2, "parts_sum", "pi_sum", "abs_sum")
    return out.drop("relative_residual")


@query(f"""
WITH {FLUX}, a AS (SELECT count(*) AS n, sum(pi) AS s, sum(abs(pi)) AS sa, sum(pi * pi) AS q, max(abs(pi)) AS m, sum(pi) FILTER (pi > 0) AS ps, sum(pi) FILTER (pi < 0) AS ns,
count(*) FILTER (pi > 0) AS pc, count(*) FILTER (pi < 0) AS nc, count(*) FILTER (pi = 0) AS zc, quantile_cont(abs(pi)::DOUBLE, 0.99) AS p FROM f)
SELECT n::BIGINT AS point_count, {r("s", 2, "pi_sum")}, {r("sa", 2, "abs_sum")}, {r("s / n", 6, "pi_mean")}, {r("sqrt(q / n)", 6, "pi_rms")}, {r("p", 6, "abs_p99")}, {r("m", 6, "abs_max")}, {r("coalesce(ps, 0)", 2, "positive_sum")}, {r("coalesce(ns, 0)", 2, "negative_sum")},
pc::BIGINT AS positive_count, nc::BIGINT AS negative_count, zc::BIGINT AS zero_count, {r("(s / n) / sqrt(q / n)", 9, "asymmetry_index")}, {r("abs(s / n) / p", 9, "ratio_p99")}, {r("abs(s / n) / m", 9, "ratio_max")}, true AS passed FROM a
""")
def weak_asymmetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = reports.weak_asymmetry(flux(spark, sf_dir)).drop("sum_squares", "closure_residual")
    out = rounded(rounded(out, 2, "pi_sum", "abs_sum", "positive_sum", "negative_sum"), 6, "pi_mean", "pi_rms", "abs_p99", "abs_max")
    return rounded(out, 9, "asymmetry_index", "ratio_p99", "ratio_max")


LIMITS = "l AS (SELECT 0.5 * sqrt(avg(wf * wf)) AS ef, 0.5 * sqrt(avg(wr * wr)) AS er FROM f)"
REGIME = "CASE WHEN wf > ef AND wr > er THEN 1 WHEN wf > ef AND wr < -er THEN 2 WHEN wf < -ef AND wr > er THEN 3 WHEN wf < -ef AND wr < -er THEN 4 ELSE 0 END"


def _regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = flux(spark, sf_dir).withColumn("time_index", F.lit(1))
    return energy.with_regime(one, ["time_index"], eps_rel=0.5)


@query(f"WITH {FLUX}, {LIMITS} SELECT l_orderkey, l_partkey, l_suppkey, count(*)::BIGINT AS n, sum({REGIME})::BIGINT AS regimes FROM f CROSS JOIN l GROUP BY ALL")
def regime_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = _regimes(spark, sf_dir)
    return coded.groupBy("l_orderkey", "l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("regime").alias("regimes"))


@query(f"""
WITH {FLUX}, {LIMITS}, c AS (SELECT {REGIME} AS regime, count(*) AS n FROM f CROSS JOIN l GROUP BY 1)
SELECT r.i::INT AS regime, coalesce(n, 0)::BIGINT AS n FROM range(5) r(i) LEFT JOIN c ON c.regime = r.i
""")
def regime_occupancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = aggregates.dense_counts(_regimes(spark, sf_dir), F.col("regime"), "regime", list(fx.REGIMES))
    return out.select(F.col("regime").cast("int").alias("regime"), F.col("n").cast("long").alias("n"))


@query(f"""
WITH {FLUX}, g AS (SELECT *, wf - wr + pi + l_suppkey * 0.001 AS sb FROM f), h AS (SELECT *, wf - wr + pi - sb AS res FROM g),
a AS (SELECT count(*) AS n, sum(wf) AS tf, sum(wr) AS tr, sum(pi) AS tp, sum(sb) AS ts, sqrt(avg(res * res)) AS rr, max(abs(res)) AS rm, sqrt(avg(wf * wf) + avg(wr * wr) + avg(pi * pi) + avg(sb * sb)) AS j FROM h)
SELECT n::BIGINT AS point_count, {r("tf", 2, "total_work_full")}, {r("tr", 2, "total_work_resolved")}, {r("tp", 2, "total_pi")}, {r("ts", 2, "total_s_bar")}, {r("rr", 6, "residual_rms")}, {r("rm", 6, "residual_max")}, {r("j", 4, "joint_rms")},
{r("rr / j", 9, "relative_residual")}, {r("abs(ts) / abs(tp)", 9, "s_bar_vs_pi")}, rr / j <= 1e-4 AS identity_passed, abs(ts) / abs(tp) <= 1e-2 AS net_passed, rr / j <= 1e-4 AND abs(ts) / abs(tp) <= 1e-2 AS passed FROM a
""")
def sbar_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    fields = flux(spark, sf_dir).withColumn("s_bar", c("work_full") - c("work_resolved") + c("pi") + c("l_suppkey") * 0.001)
    out = rounded(reports.budget_qa(fields), 2, *(f"total_{f}" for f in energy.ENERGY))
    return rounded(rounded(rounded(out, 6, "residual_rms", "residual_max"), 4, "joint_rms"), 9, "relative_residual", "s_bar_vs_pi")


@query(f"WITH {FLUX} " + " UNION ALL ".join(f"SELECT '{n}' AS field, count(*)::BIGINT AS point_count, {r(f'sum({c})', 2, 'total')}, {r(f'sqrt(avg({c} * {c}))', 6, 'rms')}, {r(f'max(abs({c}))', 6, 'max_abs')} FROM f" for n, c in (("pi", "pi"), ("work_full", "wf"), ("work_resolved", "wr"))))
def field_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = aggregates.moments(flux(spark, sf_dir), ["pi", "work_full", "work_resolved"]).drop("sum_squares")
    return rounded(rounded(out, 2, "total"), 6, "rms", "max_abs")


@query(f"WITH {FLUX} SELECT l_orderkey, l_partkey, l_suppkey, abs(pi) AS magnitude FROM f ORDER BY magnitude DESC, l_orderkey, l_partkey, l_suppkey LIMIT 100")
def tail_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 largest |pi|: a top-k report."""
    rows = flux(spark, sf_dir).select("l_orderkey", "l_partkey", "l_suppkey", F.abs("pi").alias("magnitude"))
    return rows.orderBy(F.desc("magnitude"), "l_orderkey", "l_partkey", "l_suppkey").limit(100)


@query("""
SELECT event_type, count(*)::BIGINT AS n, CASE WHEN round(quantile_cont(abs(value)::DOUBLE, 0.99), 6) = 0 THEN 0.0 ELSE round(quantile_cont(abs(value)::DOUBLE, 0.99), 6) END AS color_limit FROM events GROUP BY event_type
""")
def color_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    limits = aggregates.symmetric_limits(ev, ["event_type"], F.col("value"))
    counts = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return rounded(counts.join(limits, "event_type"), 6, "color_limit")


@query(f"WITH {FLUX} SELECT l_suppkey, count(*)::BIGINT AS n, {r('sum(sign(pi) * ln(1 + abs(pi) / 1000.0))', 4, 'symlog_sum')}, {r('max(sign(pi) * ln(1 + abs(pi) / 1000.0))', 6, 'symlog_max')} FROM f GROUP BY l_suppkey")
def symlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flux(spark, sf_dir).select("l_suppkey", fx.symlog(F.col("pi"), 1000.0).alias("v"))
    out = rows.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("symlog_sum"), F.max("v").alias("symlog_max"))
    return rounded(rounded(out, 4, "symlog_sum"), 6, "symlog_max")


# Lines of 64 points ------------------------------------------------------------------------------------------------

LINE = "p AS (SELECT vec_id, i::INT AS i, embedding[i + 1]::DOUBLE AS v FROM embeddings, range(64) t(i))"


def _lines(spark: SparkSession, sf_dir: str, ops: str) -> DataFrame:
    ship(spark)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", spectral.line(F.col("embedding"), ops).alias("v"))
    return rounded(rows.select("vec_id", F.posexplode("v").alias("i", "value")), 6, "value")


@query(f"""
WITH {LINE}, k AS (SELECT m, CASE WHEN m = 0 THEN 0.0 ELSE 0.5 * (CASE WHEN m % 2 = 0 THEN 1 ELSE -1 END) / tan(pi() * m / 64) END AS d FROM range(64) t(m)),
o AS (SELECT vec_id, ((p.i + m) % 64)::INT AS i, sum(v * d) AS s FROM p CROSS JOIN k GROUP BY ALL) SELECT vec_id, i, {r("s", 6, "value")} FROM o
""")
def spectral_derivative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, spectral.DERIVE)


@query(f"""
WITH {LINE}, k AS (SELECT m, sum(exp(-0.5 * pow(2 * pi() * least(n, 64 - n) / 64, 2)) * cos(2 * pi() * n * m / 64)) / 64 AS w FROM range(64) t(m), range(64) u(n) GROUP BY m),
o AS (SELECT vec_id, ((p.i + m) % 64)::INT AS i, sum(v * w) AS s FROM p CROSS JOIN k GROUP BY ALL) SELECT vec_id, i, {r("s", 6, "value")} FROM o
""")
def spectral_gaussian(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir, spectral.FILTER)


# Snapshots of 4 * 4 * 4 points -------------------------------------------------------------------------------------

CUBE = f"""
k AS (SELECT m, CASE WHEN m = 0 THEN 0.0 ELSE 0.5 * (CASE WHEN m % 2 = 0 THEN 1 ELSE -1 END) / tan(pi() * m / {N}) END AS d,
  (SELECT sum(exp(-0.5 * pow({SIGMA} * 2 * pi() * least(n, {N} - n) / {N}, 2)) * cos(2 * pi() * n * m / {N})) / {N} FROM range({N}) u(n)) AS w FROM range({N}) t(m)),
pt AS (SELECT q::INT AS q, (q // 16)::INT AS z, (q // 4 % 4)::INT AS y, (q % 4)::INT AS x FROM range(64) t(q)),
g AS (SELECT o.q AS qo, i.q AS qi, kz.w * ky.w * kx.w AS w FROM pt o CROSS JOIN pt i JOIN k kz ON kz.m = (o.z - i.z + 4) % 4 JOIN k ky ON ky.m = (o.y - i.y + 4) % 4 JOIN k kx ON kx.m = (o.x - i.x + 4) % 4),
dd AS (SELECT 0 AS j, o.q AS qo, i.q AS qi, d FROM pt o JOIN pt i ON o.z = i.z AND o.y = i.y JOIN k ON m = (o.x - i.x + 4) % 4
  UNION ALL SELECT 1, o.q, i.q, d FROM pt o JOIN pt i ON o.z = i.z AND o.x = i.x JOIN k ON m = (o.y - i.y + 4) % 4
  UNION ALL SELECT 2, o.q, i.q, d FROM pt o JOIN pt i ON o.y = i.y AND o.x = i.x JOIN k ON m = (o.z - i.z + 4) % 4),
whole AS (SELECT (vec_id // 3)::INT AS s FROM embeddings GROUP BY 1 HAVING count(*) = 3),
u AS (SELECT (vec_id // 3)::INT AS s, (vec_id % 3)::INT AS c, q, embedding[q + 1]::DOUBLE AS v FROM embeddings CROSS JOIN pt WHERE (vec_id // 3)::INT IN (SELECT s FROM whole))"""


def _filter(name: str, source: str, keys: str) -> str:
    return f"{name} AS (SELECT s, {keys}, qo AS q, sum(v * w) AS v FROM {source} JOIN g ON qi = q GROUP BY ALL)"


def _derive(name: str, source: str, keys: str) -> str:
    return f"{name} AS (SELECT s, {keys}, j, qo AS q, sum(v * d) AS v FROM {source} JOIN dd ON qi = q GROUP BY ALL)"


CHAIN = ",\n".join([
    CUBE, _filter("ub", "u", "c"), _derive("gu", "u", "c"), _derive("gb", "ub", "c"),
    "acc AS (SELECT gu.s, gu.c, gu.q, sum(gu.v * u.v) AS v FROM gu JOIN u ON u.s = gu.s AND u.c = gu.j AND u.q = gu.q GROUP BY ALL)", _filter("facc", "acc", "c"),
    "prod AS (SELECT a.s, a.c AS a, b.c AS b, a.q, a.v * b.v AS v FROM u a JOIN u b ON a.s = b.s AND a.q = b.q)", _filter("fprod", "prod", "a, b"),
    "tau AS (SELECT f.s, a, b, f.q, f.v - x.v * y.v AS v FROM fprod f JOIN ub x ON x.s = f.s AND x.q = f.q AND x.c = a JOIN ub y ON y.s = f.s AND y.q = f.q AND y.c = b)",
    "pf AS (SELECT t.s, t.q, sum(t.v * h.v) AS v FROM tau t JOIN gb h ON h.s = t.s AND h.q = t.q AND h.c = a AND h.j = b GROUP BY ALL)",
    "tr AS (SELECT t.s, b AS c, t.q, sum(t.v * ub.v) AS v FROM tau t JOIN ub ON ub.s = t.s AND ub.q = t.q AND ub.c = a GROUP BY ALL)", _derive("gt", "tr", "c"),
    "sb AS (SELECT s, q, sum(v) AS v FROM gt WHERE c = j GROUP BY ALL)",
    "wf AS (SELECT f.s, f.q, sum(f.v * ub.v) AS v FROM facc f JOIN ub ON ub.s = f.s AND ub.q = f.q AND ub.c = f.c GROUP BY ALL)",
    "wr AS (SELECT h.s, h.q, sum(h.v * a.v * b.v) AS v FROM gb h JOIN ub a ON a.s = h.s AND a.q = h.q AND a.c = h.c JOIN ub b ON b.s = h.s AND b.q = h.q AND b.c = h.j GROUP BY ALL)",
])


def _point_sql(source: str, name: str, keys: str = "") -> str:
    return f"WITH {CHAIN} SELECT f.s AS time_index, pt.z, pt.y, pt.x{keys}, {r('f.v', 9, name)} FROM {source} f JOIN pt USING (q)"


def _energy(spark: SparkSession, sf_dir: str, *wanted: str) -> DataFrame:
    return energy.energy_fields(cubes(spark, sf_dir), N, sigma=SIGMA, wanted=list(wanted))


def _add_energy(name: str, field: str, source: str) -> None:
    @query(_point_sql(source, field))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(_energy(spark, sf_dir, field).select(*POINT, field), 9, field)

    QUERIES[name], ORACLES[name] = QUERIES.pop("run"), ORACLES.pop("run")


for _name, _field, _source in (("work_full", "work_full", "wf"), ("work_resolved", "work_resolved", "wr"), ("pi_field", "pi", "pf"), ("s_bar_field", "s_bar", "sb")):
    _add_energy(_name, _field, _source)


@query(_point_sql("tau", "tau", ", a, b") + " WHERE a <= b")
def tau_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    six = F.array(*(F.struct(F.lit(i).alias("a"), F.lit(j).alias("b"), energy.tau(i, j).alias("tau")) for i, j in energy.PAIRS))
    return rounded(_energy(spark, sf_dir, *energy.TAU).select(*POINT, F.inline(six)), 9, "tau")


@query(_point_sql("ub", "value", ", c"))
def filter_3d(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = energy.filtered(cubes(spark, sf_dir), N, sigma=SIGMA)
    return rounded(grid.unpivot(out, list(energy.UB)).withColumnRenamed("v", "value"), 9, "value")


@query(_point_sql("gu", "value", ", c, j"))
def gradient_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    nine = F.array(*(F.struct(F.lit(i).alias("c"), F.lit(j).alias("j"), F.col(f"g_{energy.AXES[i]}{energy.AXES[j]}").alias("value")) for i in range(3) for j in range(3)))
    return rounded(energy.gradients(cubes(spark, sf_dir), N).select(*POINT, F.inline(nine)), 9, "value")


@query(f"""
WITH {CUBE}, {_derive("gu", "u", "c")}, dv AS (SELECT s, q, sum(v) AS v FROM gu WHERE c = j GROUP BY ALL),
a AS (SELECT s, count(*) AS n, sqrt(avg(v * v)) AS dr, max(abs(v)) AS dm FROM dv GROUP BY s), b AS (SELECT s, sqrt(avg(v * v)) AS gr, max(abs(v)) AS gm FROM gu GROUP BY s)
SELECT s AS time_index, n::BIGINT AS n_points, {r("dr", 9, "div_rms")}, {r("dm", 9, "div_max")}, {r("gr", 9, "grad_rms")}, {r("gm", 9, "grad_max")}, {r("dr / greatest(gr, 1e-30)", 6, "relative_rms")}, {r("dm / greatest(gm, 1e-30)", 6, "relative_max")},
dr / greatest(gr, 1e-30) <= 1e-4 AND dm / greatest(gm, 1e-30) <= 1e-3 AS passed FROM a JOIN b USING (s)
""")
def divergence_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = energy.gradients(cubes(spark, sf_dir), N).withColumn("div", energy.divergence("g"))
    out = energy.divergence_metrics(out, "div", energy.gradient_names("g"))
    return rounded(rounded(out, 9, "div_rms", "div_max", "grad_rms", "grad_max"), 6, "relative_rms", "relative_max")


@query(f"""
WITH {CHAIN}, j AS (SELECT s, wf.v AS wf, wr.v AS wr, pf.v AS pi, sb.v AS sb, wf.v - wr.v + pf.v - sb.v AS res FROM wf JOIN wr USING (s, q) JOIN pf USING (s, q) JOIN sb USING (s, q))
SELECT s AS time_index, count(*)::BIGINT AS point_count, {r("sqrt(avg(res * res))", 9, "residual_rms")}, {r("max(abs(res))", 9, "residual_max")}, {r("sqrt(avg(wf * wf) + avg(wr * wr) + avg(pi * pi) + avg(sb * sb))", 9, "joint_rms")},
{r("sqrt(avg(res * res)) / sqrt(avg(wf * wf) + avg(wr * wr) + avg(pi * pi) + avg(sb * sb))", 6, "relative_residual")} FROM j GROUP BY s
""")
def energy_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closure of each snapshot's budget; these fields are not free of divergence, so it must not close."""
    out = reports.budget_qa(_energy(spark, sf_dir, *energy.ENERGY), keys=["time_index"]).select("time_index", "point_count", "residual_rms", "residual_max", "joint_rms", "relative_residual")
    return rounded(rounded(out, 9, "residual_rms", "residual_max", "joint_rms"), 6, "relative_residual")


_SEAM = " UNION ALL ".join(
    f"SELECT s, '{a}' AS axis, sqrt(avg(pow(f.v - l.v, 2))) AS w, sqrt(avg(pow(n.v - f.v, 2))) AS i FROM p f JOIN p l USING (s, c, {b}, {d}) JOIN p n USING (s, c, {b}, {d}) WHERE f.{a} = 0 AND l.{a} = 3 AND n.{a} = 1 GROUP BY s"
    for a, b, d in (("x", "y", "z"), ("y", "x", "z"), ("z", "x", "y"))
)


@query(f"WITH {CUBE}, p AS (SELECT s, c, v, z, y, x FROM u JOIN pt USING (q)), m AS ({_SEAM}) SELECT s AS time_index, axis, {r('w', 9, 'wrap_rms')}, {r('i', 9, 'internal_rms')}, {r('w / greatest(i, 1e-30)', 6, 'ratio')} FROM m")
def seam_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(grid.seams(cubes(spark, sf_dir), N, list(energy.U)), 9, "wrap_rms", "internal_rms"), 6, "ratio")


@query(f"WITH {CUBE} SELECT s AS time_index, count(*)::BIGINT AS n, {r('min(v)', 9, 'minimum')}, {r('max(v)', 9, 'maximum')}, {r('avg(v)', 9, 'mean')}, {r('sqrt(avg(v * v))', 9, 'rms')}, bool_and(isfinite(v)) AS all_finite FROM u GROUP BY s")
def snapshot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(reports.snapshot_statistics(cubes(spark, sf_dir), list(energy.U)), 9, "minimum", "maximum", "mean", "rms")


@query("SELECT label, count(DISTINCT vec_id)::BIGINT AS n_lines, count(*) FILTER (NOT isfinite(v))::BIGINT AS n_bad FROM (SELECT label, vec_id, unnest(embedding) AS v FROM embeddings) GROUP BY label")
def finite_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = F.size(F.filter("embedding", lambda v: ~fx.finite(v)))
    return table(spark, sf_dir, "embeddings").groupBy("label").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(bad).alias("n_bad"))


@query(f"WITH {CUBE} SELECT s AS time_index, x - 1 AS lx, y - 1 AS ly, z - 1 AS lz, x, y, z, {r('v', 9, 'ux')} FROM u JOIN pt USING (q) WHERE c = 0 AND x BETWEEN 1 AND 2 AND y BETWEEN 1 AND 2 AND z BETWEEN 1 AND 2")
def center_crop(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = grid.crop(cubes(spark, sf_dir), (1, 1, 1), (2, 2, 2))
    return rounded(out.select("time_index", "lx", "ly", "lz", "x", "y", "z", "ux"), 9, "ux")


@query(f"WITH {CUBE} SELECT s AS time_index, z, x, {r('v', 9, 'uy')} FROM u JOIN pt USING (q) WHERE c = 1 AND y = 2")
def plane_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(grid.plane(cubes(spark, sf_dir), "y", 2, ["uy"]), 9, "uy")


@query(f"WITH {CUBE} SELECT s AS time_index, y, x, {r('v', 9, 'uz')} FROM u JOIN pt USING (q) WHERE c = 2 AND z = 1 AND y % 2 = 0 AND x % 2 = 0")
def strided_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(grid.plane(cubes(spark, sf_dir), "z", 1, ["uz"], stride=2), 9, "uz")


@query(f"WITH {CUBE} SELECT s AS time_index, z, y, x, {r('max(CASE WHEN c = 0 THEN v END)', 9, 'ux')}, {r('max(CASE WHEN c = 1 THEN v END)', 9, 'uy')}, {r('max(CASE WHEN c = 2 THEN v END)', 9, 'uz')} FROM u JOIN pt USING (q) GROUP BY s, z, y, x")
def component_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = grid.unpivot(cubes(spark, sf_dir), list(energy.U))
    return rounded(grid.pivot_components(long), 9, *energy.U)


@query(f"""
WITH {CUBE}, p AS (SELECT s, c, z, y, x, v FROM u JOIN pt USING (q)), o AS (SELECT s, c, max(abs(v * 1.00001 - v)) AS d, bool_and(abs(v * 1.00001 - v) <= 5e-6 + 5e-5 * abs(v)) AS k FROM p WHERE x BETWEEN 1 AND 2 AND y BETWEEN 1 AND 2 AND z BETWEEN 1 AND 2 GROUP BY ALL)
SELECT s AS time_index, CASE c WHEN 0 THEN 'ux' WHEN 1 THEN 'uy' ELSE 'uz' END AS field, {r("d", 9, "max_diff")}, k AS close FROM o
""")
def overlap_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = cubes(spark, sf_dir)
    local = grid.crop(new, (1, 1, 1), (2, 2, 2))
    old = local.select("time_index", F.col("lx").alias("x"), F.col("ly").alias("y"), F.col("lz").alias("z"), *((F.col(c) * 1.00001).alias(c) for c in energy.U))
    return rounded(grid.overlap(old, new, (1, 1, 1), list(energy.U)), 9, "max_diff")


_TILES = """t AS (SELECT s, z0, y0, x0, least(3, 4 - z0) AS nz, least(3, 4 - y0) AS ny, least(3, 4 - x0) AS nx, printf('x%04d_y%04d_z%04d', x0, y0, z0) AS tile_key
FROM (SELECT DISTINCT s FROM whole), (VALUES (0), (3)) a(z0), (VALUES (0), (3)) b(y0), (VALUES (0), (3)) c(x0))"""


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = table(spark, sf_dir, "embeddings").groupBy(F.floor(F.col("vec_id") / 3).cast("int").alias("time_index")).count()
    return whole.where("count = 3").select("time_index")


@query(f"WITH {CUBE}, {_TILES} SELECT s AS time_index, tile_key, x0, y0, z0, nx, ny, nz, x0 + 1 AS api_first, x0 + nx AS api_last FROM t")
def tile_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = grid.tiles(_snapshots(spark, sf_dir), (N, N, N), (3, 3, 3))
    return out.select("time_index", "tile_key", "x0", "y0", "z0", "nx", "ny", "nz", fx.api_range(F.col("x0"), F.col("nx"))[0].alias("api_first"), fx.api_range(F.col("x0"), F.col("nx"))[1].alias("api_last"))


@query(f"""
WITH {CUBE}, t AS (SELECT s, z0, y0, x0, printf('x%04d_y%04d_z%04d', x0, y0, z0) AS tile_key FROM (SELECT DISTINCT s FROM whole), range(4) a(z0), range(4) b(y0), range(4) c(x0)),
q AS (SELECT z0, y0, x0, printf('x%04d_y%04d_z%04d', x0, y0, z0) AS request FROM (VALUES (0), (2)) a(z0), (VALUES (0), (2)) b(y0), (VALUES (0), (2)) c(x0))
SELECT s AS time_index, tile_key, request FROM t JOIN q ON t.x0 >= q.x0 AND t.x0 + 1 <= q.x0 + 2 AND t.y0 >= q.y0 AND t.y0 + 1 <= q.y0 + 2 AND t.z0 >= q.z0 AND t.z0 + 1 <= q.z0 + 2
""")
def tiles_in_request(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = _snapshots(spark, sf_dir)
    out = grid.inside(grid.tiles(snapshots, (N, N, N), (1, 1, 1)), grid.tiles(snapshots, (N, N, N), (2, 2, 2)), (2, 2, 2))
    return out.select("time_index", "tile_key", F.col("tile_key_r").alias("request"))


@query("""
WITH p AS (SELECT DISTINCT o_orderkey AS k FROM orders), f AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag <> 'R')
SELECT coalesce(p.k, f.k) AS order_key, CASE WHEN f.k IS NULL THEN 'missing' ELSE 'unplanned' END AS side FROM p FULL JOIN f ON p.k = f.k WHERE p.k IS NULL OR f.k IS NULL
""")
def coverage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key")).distinct()
    found = table(spark, sf_dir, "lineitem").where("l_returnflag <> 'R'").select(F.col("l_orderkey").alias("order_key")).distinct()
    return grid.coverage(planned, found, ["order_key"])


@query("""
SELECT o_orderkey, o_orderstatus FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_linestatus = o.o_orderstatus)
""")
def pending_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    verified = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"))
    return grid.pending(planned, verified, ["o_orderkey", "o_orderstatus"])


@query("""
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value, max((ts, event_id)).event_id AS event_id FROM (SELECT user_id, event_type, value, {'ts': ts, 'event_id': event_id} AS o, ts, event_id FROM events) GROUP BY user_id
""".replace("max((ts, event_id)).event_id", "max(o).event_id").replace("(ts, event_id)", "o"))
def ledger_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.latest(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], ["event_type", "value", "event_id"])


@query("""
SELECT user_id, event_type AS status, count(*)::BIGINT AS n FROM events GROUP BY GROUPING SETS ((user_id, event_type), (user_id))
""")
def ledger_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.progress(table(spark, sf_dir, "events"), ["user_id"], F.col("event_type"))


@query("SELECT o_orderkey, sha256(o_orderkey::VARCHAR) AS sha256, length(o_orderkey::VARCHAR)::INT AS byte_count FROM orders")
def tile_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", grid.key_of(key).alias("sha256"), F.octet_length(key.cast("string")).alias("byte_count"))


@query("SELECT o_custkey, count(*)::BIGINT AS n_parts, sha256(string_agg(sha256(o_orderkey::VARCHAR), '' ORDER BY o_orderkey)) AS digest FROM orders GROUP BY o_custkey")
def ordered_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = aggregates.ordered_digest(table(spark, sf_dir, "orders"), ["o_custkey"], F.col("o_orderkey"), grid.key_of(F.col("o_orderkey")))
    return out.withColumn("n_parts", F.col("n_parts").cast("long"))


@query("SELECT vec_id, round((vec_id::DOUBLE) * 0.002, 9) AS physical_time FROM embeddings")
def physical_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(fx.physical_time(F.col("vec_id") + 1), 9).alias("physical_time"))


@query("SELECT vec_id, round((vec_id % 64)::DOUBLE * 2 * pi() / 64, 9) AS x FROM embeddings")
def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    import math

    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(fx.coordinate(F.col("vec_id") % 64, 64, 2 * math.pi), 9).alias("x"))


@query(f"WITH {CUBE} SELECT s AS time_index, printf('x%04d_y%04d_z%04d', x // 2 * 2, y // 2 * 2, z // 2 * 2) AS tile_key, (count(*) // 3)::BIGINT AS n_points, (count(*) // 3)::BIGINT AS n_finite, (count(*) * 4)::BIGINT AS byte_count FROM u JOIN pt USING (q) GROUP BY ALL")
def tile_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and finite values of each 2 * 2 * 2 tile; the byte digest beside them has no SQL form and stays in tests."""
    return bricks.checksums(cubes(spark, sf_dir), 2).drop("sha256")


@query("""
SELECT user_id AS time_index, arg_max(event_type, event_id) AS status, arg_max(props, event_id) FILTER (value > 400) AS manifest_hash, min(event_id) AS created, max(event_id) AS updated,
count(*)::BIGINT AS tiles, count(*) FILTER (value > 100)::BIGINT AS done FROM events GROUP BY user_id
""")
def snapshot_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users stand for snapshots and their events for tiles; props counts as a hash where the value is high."""
    ev = table(spark, sf_dir, "events")
    said = ev.select(F.lit("events").alias("dataset"), F.col("user_id").alias("time_index"), F.col("event_id").alias("seq"), F.col("event_type").alias("status"), F.when(F.col("value") > 400, F.col("props")).alias("manifest_hash"))
    tiles = ev.select(F.col("user_id").alias("time_index"), F.when(F.col("value") > 100, "verified").otherwise("planned").alias("status"))
    return ledger.with_progress(ledger.snapshots(said), tiles, ["time_index"]).drop("dataset")


@query(f"""
WITH {CUBE}, s AS (SELECT s, z, x, sign(v) * ln(1 + abs(v) / 0.01) AS w FROM u JOIN pt USING (q) WHERE c = 0 AND y = 1), l AS (SELECT quantile_cont(abs(w)::DOUBLE, 0.95) AS top FROM s)
SELECT s AS time_index, z, x, {r("w", 6, "value")}, {r("top", 6, "color_top")} FROM s CROSS JOIN l
""")
def symlog_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat, top = views.continuous_slice(cubes(spark, sf_dir), N, "y", 1, "ux", percent=95, scale="symlog", threshold=0.01)
    return rounded(flat.select("time_index", "z", "x", "value", F.lit(top).alias("color_top")), 6, "value", "color_top")


@query(f"""
WITH {FLUX}, q AS (SELECT {QUAD} AS quadrant, pi FROM f)
SELECT quadrant, count(*)::BIGINT AS n, count(*) FILTER (pi > 0)::BIGINT AS positive_count, {r("sum(pi) FILTER (pi > 0)", 2, "positive_sum")}, {r("sum(pi) FILTER (pi < 0)", 2, "negative_sum")}, {r("avg(pi) / sqrt(avg(pi * pi))", 9, "asymmetry_index")} FROM q GROUP BY quadrant
""")
def weak_by_quadrant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rounded(reports.weak_by_quadrant(flux(spark, sf_dir)), 2, "positive_sum", "negative_sum"), 9, "asymmetry_index")
