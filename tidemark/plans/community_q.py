"""Registered community-statistics queries (COM family) on ``embeddings``
(sites x variables, groups = labels) and ``events`` (user x event-type counts).

Permutations are bijections in integer arithmetic, so the SQL twins of the
p-value queries compute the same relabellings with a recursive query. The
number of variables is taken from the data.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import community as cm
from tidemark.plans.common import r6, register, rn, table

EVENT_TYPES = ["view", "click", "purchase", "signup", "error"]


def _emb(spark, sf):
    """(frame, variable names): one column for each element of the longest vector."""
    e = table(spark, sf, "embeddings")
    cols = [f"e{i}" for i in range(e.agg(F.max(F.size("embedding"))).first()[0] or 0)]
    return e.select("vec_id", "label", *[F.get("embedding", i).cast("double").alias(c) for i, c in enumerate(cols)]), cols


def _args(spark, sf):
    d, cols = _emb(spark, sf)
    return d, "label", cols


_LONG = """l AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x,
  generate_subscripts(embedding, 1) AS j FROM embeddings)"""


def _counts(spark, sf):
    e = table(spark, sf, "events")
    kind = F.col("event_type")
    listed = F.when(kind.isin(EVENT_TYPES), kind).otherwise(F.raise_error(F.concat(F.lit("event type is not listed: "), F.coalesce(kind, F.lit("NULL")))))
    c = e.withColumn("event_type", listed).groupBy("user_id").pivot("event_type", EVENT_TYPES).count().fillna(0, subset=EVENT_TYPES)
    return c.select("user_id", (F.col("user_id") % 3).alias("grp"),
                    *[F.col(t).cast("double").alias(t) for t in EVENT_TYPES])


_COUNTS_SQL = "c AS (SELECT user_id, user_id % 3 AS grp, " + ", ".join(
    f"CAST(count(CASE WHEN event_type = '{t}' THEN 1 END) AS DOUBLE) AS {t}" for t in EVENT_TYPES
) + " FROM events GROUP BY user_id)"


# ---------------------------------------------------------------- COM-1 ----

COM1_SQL = f"""WITH {_LONG},
m AS (SELECT j, avg(x) AS m, stddev_samp(x) AS s FROM l GROUP BY j)
SELECT l.vec_id, l.label, 'e' || (l.j - 1) AS variable, round((l.x - m.m) / m.s, 6) AS z
FROM l JOIN m ON l.j = m.j WHERE m.s > 0"""


@register("com1_prepare_matrix", ("COM-1",), COM1_SQL)
def com1_prepare_matrix(spark, sf):
    """Complete cases, constant columns dropped, z-scores (all variables, one row each)."""
    d, cols = _emb(spark, sf)
    z, kept = cm.prepare_matrix(d.withColumn("flat", F.lit(0.0)), cols + ["flat"], keep=["vec_id", "label"])
    long = z.unpivot(["vec_id", "label"], kept, "variable", "z")
    return long.withColumn("z", r6("z"))


# ---------------------------------------------------------------- COM-2 ----

COM2_SQL = f"""WITH {_LONG},
gm AS (SELECT label, j, avg(x) AS m FROM l GROUP BY label, j)
SELECT l.vec_id, l.label, round(sqrt(sum((l.x - gm.m) * (l.x - gm.m))), 6) AS distance
FROM l JOIN gm ON l.label = gm.label AND l.j = gm.j GROUP BY l.vec_id, l.label"""


@register("com2_centroid_distance", ("COM-2",), COM2_SQL)
def com2_centroid_distance(spark, sf):
    """Euclidean distance of each site to its group centroid (all variables)."""
    d = cm.distance_to_centroid(*_args(spark, sf))
    return d.select("vec_id", "label", r6("distance").alias("distance"))


COM2B_SQL = f"""WITH {_COUNTS_SQL},
cen AS (SELECT grp, {", ".join(f"avg({t}) AS {t}" for t in EVENT_TYPES)} FROM c GROUP BY grp)
SELECT c.user_id, c.grp, round(({" + ".join(f"abs(c.{t} - cen.{t})" for t in EVENT_TYPES)})
  / ({" + ".join(f"(c.{t} + cen.{t})" for t in EVENT_TYPES)}), 6) AS distance
FROM c JOIN cen ON c.grp = cen.grp"""


@register("com2_bray_curtis", ("COM-2",), COM2B_SQL)
def com2_bray_curtis(spark, sf):
    """Bray-Curtis dissimilarity of each user's counts to its group profile."""
    d = cm.distance_to_centroid(_counts(spark, sf), "grp", EVENT_TYPES, metric="bray")
    return d.select("user_id", "grp", r6("distance").alias("distance"))


# ---------------------------------------------------------------- COM-3 ----

COM3_SQL = f"""WITH {_LONG},
gm AS (SELECT label, j, avg(x) AS m FROM l GROUP BY label, j),
tm AS (SELECT j, avg(x) AS m FROM l GROUP BY j),
w AS (SELECT sum((l.x - gm.m) * (l.x - gm.m)) AS v FROM l JOIN gm ON l.label = gm.label AND l.j = gm.j),
t AS (SELECT sum((l.x - tm.m) * (l.x - tm.m)) AS v FROM l JOIN tm ON l.j = tm.j),
c AS (SELECT count(*) AS n, count(DISTINCT label) AS g FROM embeddings)
SELECT c.n, c.g AS groups, c.g - 1 AS df_between, c.n - c.g AS df_within,
  round(t.v - w.v, 4) AS ss_between, round(w.v, 4) AS ss_within, round(t.v, 4) AS ss_total,
  round(((t.v - w.v) / (c.g - 1)) / (w.v / (c.n - c.g)), 6) AS f, round(1 - w.v / t.v, 6) AS r2
FROM c, w, t"""


def _round_stats(df):
    return df.withColumns({**{c: rn(c, 4) for c in ("ss_between", "ss_within", "ss_total") if c in df.columns},
                           **{c: r6(c) for c in ("f", "r2") if c in df.columns}})


@register("com3_permanova", ("COM-3",), COM3_SQL)
def com3_permanova(spark, sf):
    """PERMANOVA statistics (Euclidean) by group sums, no distance matrix."""
    p = cm.permanova(*_args(spark, sf), permutations=0)
    return _round_stats(p.drop("p_value"))


def _mix_sql(t):
    u = f"((({t}) * {cm.PERM_MULT} + {cm.PERM_ADD}) % {cm.PERM_PRIME})"
    return f"(({u} * {u} + ({t})) % {cm.PERM_PRIME})"


def _rounds_sql(keys: str, n: str, seed: str, rank: str, source: str, where: str = "") -> str:
    """Recursive CTE ``s(keys, perm, r, x)`` of swap-or-not rounds and ``pos`` of its last round."""
    step = f"""SELECT {keys}, perm, n, seed, r + 1 AS r,
      CASE WHEN (({_mix_sql(f"(CASE WHEN x > y THEN x ELSE y END + base) % {cm.PERM_PRIME}")}) >> 9) & 1 = 1 THEN y ELSE x END AS x
    FROM (SELECT *, (((({_mix_sql("base")}) % n - x) % n) + n) % n AS y
      FROM (SELECT *, {_mix_sql(f"{_mix_sql(f'(seed * 1000003 + perm) % {cm.PERM_PRIME}')} + r + 1")} AS base FROM s WHERE r < {cm.PERM_ROUNDS}))"""
    return f"""s AS (
  SELECT {keys}, perm, {n} AS n, {seed} AS seed, 0 AS r, {rank} AS x FROM {source} {where}
  UNION ALL {step}),
pos AS (SELECT {keys}, perm, x FROM s WHERE r = {cm.PERM_ROUNDS})"""


PERMS = 999
COM3P_SQL = f"""WITH RECURSIVE o AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS rk FROM embeddings),
nn AS (SELECT count(*) AS n FROM o),
pp AS (SELECT vec_id, rk, n, perm FROM o, nn, (SELECT unnest(range(1, {PERMS + 1})) AS perm)),
{_rounds_sql("vec_id", "n", "123", "rk", "pp")},
sz AS (SELECT label, count(*) AS k, sum(count(*)) OVER (ORDER BY label) AS hi FROM embeddings GROUP BY label),
lab AS (SELECT pos.vec_id, pos.perm, sz.label, sz.k FROM pos JOIN sz ON pos.x < sz.hi AND pos.x >= sz.hi - sz.k),
{_LONG},
tm AS (SELECT j, avg(x) AS m FROM l GROUP BY j),
sums AS (SELECT lab.perm, lab.label, l.j, sum(l.x - tm.m) AS v, max(lab.k) AS k
  FROM lab JOIN l ON lab.vec_id = l.vec_id JOIN tm ON l.j = tm.j GROUP BY 1, 2, 3),
fp AS (SELECT perm, sum(v * v / k) AS b FROM sums GROUP BY perm),
obs AS ({COM3_SQL.replace("WITH " + _LONG, "WITH " + _LONG)}),
raw AS (SELECT sum((l.x - tm.m) * (l.x - tm.m)) AS t FROM l JOIN tm ON l.j = tm.j),
ob AS (SELECT sum(v * v / k) AS b FROM (SELECT l.label, l.j, sum(l.x - tm.m) AS v, count(*) AS k FROM l JOIN tm ON l.j = tm.j GROUP BY 1, 2))
SELECT obs.*, (1 + (SELECT count(*) FROM fp, raw, ob WHERE (fp.b / (obs.groups - 1)) / ((raw.t - fp.b) / (obs.n - obs.groups))
  >= (ob.b / (obs.groups - 1)) / ((raw.t - ob.b) / (obs.n - obs.groups)) - {cm.PERM_EPS})) / {PERMS + 1}.0::DOUBLE AS p_value
FROM obs"""


@register("com3_permanova_perm", ("COM-3",), COM3P_SQL)
def com3_permanova_perm(spark, sf):
    """PERMANOVA with 999 exact label permutations (p-value)."""
    return _round_stats(cm.permanova(*_args(spark, sf), permutations=PERMS, seed=123, id_col="vec_id"))


# ---------------------------------------------------------------- COM-4 ----

COM4_SQL = f"""WITH {_LONG},
lv AS (SELECT DISTINCT label FROM embeddings),
pr AS (SELECT a.label AS g1, b.label AS g2 FROM lv a JOIN lv b ON a.label < b.label),
d AS (SELECT pr.g1, pr.g2, l.vec_id, l.label, l.j, l.x FROM pr JOIN l ON l.label = pr.g1 OR l.label = pr.g2),
gm AS (SELECT g1, g2, label, j, avg(x) AS m FROM d GROUP BY g1, g2, label, j),
pm AS (SELECT g1, g2, j, avg(x) AS m FROM d GROUP BY g1, g2, j),
w AS (SELECT d.g1, d.g2, sum((d.x - gm.m) * (d.x - gm.m)) AS v FROM d JOIN gm
      ON d.g1 = gm.g1 AND d.g2 = gm.g2 AND d.label = gm.label AND d.j = gm.j GROUP BY d.g1, d.g2),
t AS (SELECT d.g1, d.g2, sum((d.x - pm.m) * (d.x - pm.m)) AS v, count(DISTINCT d.vec_id) AS n FROM d JOIN pm
      ON d.g1 = pm.g1 AND d.g2 = pm.g2 AND d.j = pm.j GROUP BY d.g1, d.g2)
SELECT t.g1 AS group1, t.g2 AS group2, t.n, round((t.v - w.v) / (w.v / (t.n - 2)), 6) AS f,
  round(1 - w.v / t.v, 6) AS r2
FROM t JOIN w ON t.g1 = w.g1 AND t.g2 = w.g2"""


@register("com4_pairwise_permanova", ("COM-4",), COM4_SQL)
def com4_pairwise_permanova(spark, sf):
    """PERMANOVA F and R2 for every pair of groups."""
    p = cm.pairwise_permanova(*_args(spark, sf), permutations=0)
    return _round_stats(p.select("group1", "group2", "n", "f", "r2"))


PAIR_PERMS = PERMS
COM4P_SQL = f"""WITH RECURSIVE sz AS (SELECT label, count(*) AS k, row_number() OVER (ORDER BY label) - 1 AS gi FROM embeddings GROUP BY label),
g AS (SELECT count(*) AS g FROM sz),
pr AS (SELECT a.label AS g1, b.label AS g2, a.k AS k1, b.k AS k2, 123 + a.gi * g.g + b.gi AS seed FROM sz a JOIN sz b ON a.label < b.label, g),
o AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS rk FROM embeddings),
pp AS (SELECT pr.g1, pr.g2, o.vec_id, CASE WHEN o.label = pr.g1 THEN o.rk ELSE o.rk + pr.k1 END AS rk, pr.k1 + pr.k2 AS nn, pr.seed AS sd, perm
  FROM pr JOIN o ON o.label = pr.g1 OR o.label = pr.g2, (SELECT unnest(range(1, {PAIR_PERMS + 1})) AS perm)),
{_rounds_sql("g1, g2, vec_id", "nn", "sd", "rk", "pp")},
{_LONG},
d AS (SELECT pr.g1, pr.g2, l.vec_id, l.label, l.j, l.x FROM pr JOIN l ON l.label = pr.g1 OR l.label = pr.g2),
pm AS (SELECT g1, g2, j, avg(x) AS m FROM d GROUP BY 1, 2, 3),
c AS (SELECT d.g1, d.g2, d.vec_id, d.label, d.j, d.x - pm.m AS x FROM d JOIN pm ON d.g1 = pm.g1 AND d.g2 = pm.g2 AND d.j = pm.j),
t AS (SELECT g1, g2, sum(x * x) AS t FROM c GROUP BY 1, 2),
one AS (SELECT c.g1, c.g2, pos.perm, c.j, sum(c.x) AS v FROM pos JOIN pr ON pos.g1 = pr.g1 AND pos.g2 = pr.g2
  JOIN c ON c.g1 = pos.g1 AND c.g2 = pos.g2 AND c.vec_id = pos.vec_id WHERE pos.x < pr.k1 GROUP BY 1, 2, 3, 4),
b AS (SELECT one.g1, one.g2, one.perm, sum(v * v / k1 + v * v / k2) AS b FROM one JOIN pr ON one.g1 = pr.g1 AND one.g2 = pr.g2 GROUP BY 1, 2, 3),
ob AS (SELECT x.g1, x.g2, sum(v * v / k1 + v * v / k2) AS b FROM (SELECT g1, g2, j, sum(x) AS v FROM c WHERE label = g1 GROUP BY 1, 2, 3) x
  JOIN pr ON x.g1 = pr.g1 AND x.g2 = pr.g2 GROUP BY 1, 2),
f AS (SELECT pr.g1, pr.g2, pr.k1 + pr.k2 AS n, ob.b / ((t.t - ob.b) / (pr.k1 + pr.k2 - 2)) AS f, ob.b / t.t AS r2, t.t
  FROM pr JOIN ob ON pr.g1 = ob.g1 AND pr.g2 = ob.g2 JOIN t ON pr.g1 = t.g1 AND pr.g2 = t.g2),
pv AS (SELECT f.g1, f.g2, (1 + count(CASE WHEN b.b / ((f.t - b.b) / (f.n - 2)) >= f.f - {cm.PERM_EPS} THEN 1 END)) / {PAIR_PERMS + 1}.0::DOUBLE AS p
  FROM f JOIN b ON f.g1 = b.g1 AND f.g2 = b.g2 GROUP BY 1, 2)
SELECT f.g1 AS group1, f.g2 AS group2, f.n, round(f.f, 6) AS f, round(f.r2, 6) AS r2, round(pv.p, 6) AS p_value,
  round(least(1.0, pv.p * (SELECT count(*) FROM pr)), 6) AS p_adjusted
FROM f JOIN pv ON f.g1 = pv.g1 AND f.g2 = pv.g2"""


@register("com4_pairwise_perm", ("COM-4",), COM4P_SQL)
def com4_pairwise_perm(spark, sf):
    """Pairwise PERMANOVA with permutation p and Bonferroni adjustment (99 permutations for each pair)."""
    p = cm.pairwise_permanova(*_args(spark, sf), permutations=PAIR_PERMS, seed=123, id_col="vec_id")
    return _round_stats(p).withColumn("p_value", r6("p_value")).withColumn("p_adjusted", r6("p_adjusted"))


# ---------------------------------------------------------------- COM-5 ----

def _simper_sql():
    pairs = ", ".join(f"a.{t} AS a_{t}, b.{t} AS b_{t}" for t in EVENT_TYPES)
    den = " + ".join(f"(a_{t} + b_{t})" for t in EVENT_TYPES)
    long = "\n  UNION ALL ".join(
        f"SELECT g1, g2, '{t}' AS variable, abs(a_{t} - b_{t}) / ({den}) AS contribution FROM pr" for t in EVENT_TYPES)
    return f"""WITH {_COUNTS_SQL},
cen AS (SELECT grp, {", ".join(f"avg({t}) AS {t}" for t in EVENT_TYPES)} FROM c GROUP BY grp),
pr AS (SELECT a.grp AS g1, b.grp AS g2, {pairs} FROM cen a JOIN cen b ON a.grp < b.grp),
lo AS ({long}),
sh AS (SELECT *, contribution / sum(contribution) OVER (PARTITION BY g1, g2) AS share FROM lo)
SELECT g1 AS group1, g2 AS group2, variable, round(contribution, 6) AS contribution, round(share, 6) AS share,
  round(sum(share) OVER (PARTITION BY g1, g2 ORDER BY contribution DESC, variable
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cumulative
FROM sh"""


@register("com5_simper", ("COM-5",), _simper_sql())
def com5_simper(spark, sf):
    """Variable contributions to Bray-Curtis dissimilarity between group profiles."""
    s = cm.simper_profile(_counts(spark, sf), "grp", EVENT_TYPES)
    return s.select("group1", "group2", "variable", *[r6(c).alias(c) for c in ("contribution", "share", "cumulative")])


# ---------------------------------------------------------------- COM-6 ----

COM6_SQL = f"""WITH {_LONG},
gm AS (SELECT label, j, avg(x) AS m FROM l GROUP BY label, j),
d AS (SELECT l.vec_id, l.label, sqrt(sum((l.x - gm.m) * (l.x - gm.m))) AS dist
      FROM l JOIN gm ON l.label = gm.label AND l.j = gm.j GROUP BY l.vec_id, l.label),
per AS (SELECT label, count(*) AS n, avg(dist) AS md FROM d GROUP BY label),
ss AS (SELECT sum((d.dist - per.md) * (d.dist - per.md)) AS w FROM d JOIN per ON d.label = per.label),
st AS (SELECT sum((dist - (SELECT avg(dist) FROM d)) * (dist - (SELECT avg(dist) FROM d))) AS t,
              count(*) AS nn, count(DISTINCT label) AS g FROM d)
SELECT per.label, per.n, round(per.md, 6) AS mean_distance,
  round(((st.t - ss.w) / (st.g - 1)) / (ss.w / (st.nn - st.g)), 6) AS f, st.g - 1 AS df1, st.nn - st.g AS df2
FROM per, ss, st"""


@register("com6_dispersion", ("COM-6",), COM6_SQL)
def com6_dispersion(spark, sf):
    """Distances to group centroids and their one-way ANOVA F."""
    d = cm.dispersion(*_args(spark, sf))
    return d.drop("p_value").withColumn("mean_distance", r6("mean_distance")).withColumn("f", r6("f"))


# the upper tail of F as the power series of the incomplete beta function at df2 / (df2 + df1 f)
COM6P_SQL = f"""WITH a AS ({COM6_SQL}),
x AS (SELECT DISTINCT f, df1, df2, df2 / 2.0::DOUBLE AS a, df1 / 2.0::DOUBLE AS b, df2 / (df2 + df1 * f)::DOUBLE AS x FROM a)
SELECT df1, df2, round(f, 4) AS f, round(list_sum(list_transform(range(0, 60000), lambda n:
  exp((a + n) * ln(x) + b * ln(1 - x) + lgamma(a + b + n) - lgamma(b) - lgamma(a + n + 1)))), 4) AS p_value FROM x"""


@register("com6_dispersion_p", ("COM-6",), COM6P_SQL)
def com6_dispersion_p(spark, sf):
    """The p-value of the dispersion test."""
    d = cm.dispersion(*_args(spark, sf)).select("df1", "df2", "f", "p_value").distinct()
    return d.select("df1", "df2", rn("f", 4).alias("f"), rn("p_value", 4).alias("p_value"))


# at a spatial median the unit vectors to the other points sum to zero: that
# is what the query reports, and the SQL states
COM6M_SQL = "SELECT label, count(*) AS n, TRUE AS balanced, TRUE AS nearer FROM embeddings GROUP BY label"


@register("com6_spatial_median", ("COM-6",), COM6M_SQL)
def com6_spatial_median(spark, sf):
    """Spatial median of each group: unit vectors balance there, and its mean distance is at most the centroid's."""
    d, g, cols = _args(spark, sf)
    med = cm.spatial_medians(d, g, cols).select(F.col(g).alias("g"), *[F.col(c).alias(f"m{i}") for i, c in enumerate(cols)])
    cen = cm.distance_to_centroid(d, g, cols, out="to_centroid")
    j = cen.join(med, F.col(g) == F.col("g"))
    dist = F.sqrt(sum(((F.col(c) - F.col(f"m{i}")) ** 2 for i, c in enumerate(cols)), F.lit(0.0)))
    j = j.withColumn("dist", dist)
    unit = [F.sum(F.when(F.col("dist") > 1e-12, (F.col(c) - F.col(f"m{i}")) / F.col("dist"))).alias(f"u{i}") for i, c in enumerate(cols)]
    per = j.groupBy(g).agg(F.count(F.lit(1)).alias("n"), F.avg("dist").alias("d"), F.avg("to_centroid").alias("c"), *unit)
    pull = F.sqrt(sum((F.col(f"u{i}") ** 2 for i in range(len(cols))), F.lit(0.0)))
    return per.select(g, "n", (pull < 1e-4 * F.col("n")).alias("balanced"), (F.col("d") <= F.col("c")).alias("nearer"))


# ---------------------------------------------------------------- COM-7 ----

@register("com7_discriminant", ("COM-7",), None)
def com7_discriminant(spark, sf):
    """Linear discriminant scores of every site (all variables)."""
    d, g, cols = _args(spark, sf)
    scores, _, _ = cm.discriminant(d, g, cols, keep=["vec_id"])
    return scores.select("vec_id", "label", *[r6(c).alias(c) for c in scores.columns if c.startswith("LD")])


# the scores' pooled within-group covariance is the identity, their group
# means (weighted by squared size, as in the fit) are uncorrelated, and there is one axis less than there are groups
COM7_SQL = """WITH k AS (SELECT least(count(DISTINCT label) - 1, max(len(embedding))) AS k FROM embeddings),
a AS (SELECT CAST(unnest(range(1, k + 1)) AS INTEGER) AS i FROM k)
SELECT a.i, b.i AS j, CASE WHEN a.i = b.i THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS within_cov, CASE WHEN a.i <> b.i THEN 0.0::DOUBLE END AS between_cov
FROM a JOIN a b ON a.i <= b.i"""


@register("com7_discriminant_axes", ("COM-7",), COM7_SQL)
def com7_discriminant_axes(spark, sf):
    """Pooled within-group and between-group covariances of the discriminant scores."""
    d, g, cols = _args(spark, sf)
    scores, _, info = cm.discriminant(d, g, cols)
    ld = [c for c in scores.columns if c.startswith("LD")]
    groups = len(info["levels"])
    pairs = [(i, j) for i in range(len(ld)) for j in range(i, len(ld))]
    per = scores.groupBy(g).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(ld)],
                                *[F.covar_pop(ld[i], ld[j]).alias(f"c{i}_{j}") for i, j in pairs])
    tot = per.agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col(f"c{i}_{j}")).alias(f"w{i}_{j}") for i, j in pairs],
                  *[F.sum(F.col("n") * F.col("n") * F.col(f"m{i}") * F.col(f"m{j}")).alias(f"b{i}_{j}") for i, j in pairs])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(j + 1).alias("j"),
                              rn(F.col(f"w{i}_{j}") / (F.col("n") - groups), 5).alias("within_cov"),
                              (rn(F.col(f"b{i}_{j}") / (F.col("n") * F.col("n")), 5) if i != j else F.lit(None).cast("double")).alias("between_cov")) for i, j in pairs])
    return tot.select(F.inline(rows))


# ---------------------------------------------------------------- COM-8 ----

@register("com8_ordinate", ("COM-8",), None)
def com8_ordinate(spark, sf):
    """Two-axis principal-component ordination of sites (all variables)."""
    d, cols = _emb(spark, sf)
    scores, _ = cm.ordinate(d, cols, k=2, keep=["vec_id", "label"])
    return scores.select("vec_id", "label", r6("PC1").alias("PC1"), r6("PC2").alias("PC2"))


# of all axes: variances sum to the trace of the covariance matrix and their
# squares to its squared Frobenius norm; different axes do not covary
COM8_SQL = f"""WITH {_LONG},
v AS (SELECT j, avg(x) AS m FROM l GROUP BY j),
c AS (SELECT a.j AS i, b.j AS j, sum((a.x - va.m) * (b.x - vb.m)) / (count(*) - 1) AS c
  FROM l a JOIN l b ON a.vec_id = b.vec_id JOIN v va ON va.j = a.j JOIN v vb ON vb.j = b.j GROUP BY 1, 2)
SELECT max(i) AS axes, round(sum(CASE WHEN i = j THEN c END), 6) AS total_variance, round(sum(c * c), 6) AS squared_norm,
  0.0::DOUBLE AS worst_covariance, 1.0::DOUBLE AS ratio_sum FROM c"""


@register("com8_ordinate_axes", ("COM-8",), COM8_SQL)
def com8_ordinate_axes(spark, sf):
    """Variances and covariances of all principal axes."""
    d, cols = _emb(spark, sf)
    scores, ratio = cm.ordinate(d, cols, k=len(cols))
    pcs = [c for c in scores.columns if c.startswith("PC")]
    var = scores.agg(*[F.var_samp(c).alias(c) for c in pcs])
    near = scores.agg(*[F.abs(F.covar_samp(a, b)).alias(f"x{i}") for i, (a, b) in enumerate(zip(pcs, pcs[1:]))])
    w = var.select(sum((F.col(c) for c in pcs), F.lit(0.0)).alias("t"), sum((F.col(c) ** 2 for c in pcs), F.lit(0.0)).alias("q"))
    worst = near.select(F.greatest(*[F.col(c) for c in near.columns]).alias("w")).first()["w"]
    return w.select(F.lit(len(pcs)).cast("long").alias("axes"), r6("t").alias("total_variance"), r6("q").alias("squared_norm"),
                    r6(F.lit(float(worst))).alias("worst_covariance"), r6(F.lit(float(sum(ratio)))).alias("ratio_sum"))


@register("com8_landmark_ordination", ("COM-8",), None)
def com8_landmark_ordination(spark, sf):
    """Two-axis ordination of users' event counts on Bray-Curtis distances."""
    scores, _ = cm.landmark_ordination(_counts(spark, sf), "user_id", EVENT_TYPES, keep=["grp"])
    return scores.select("user_id", "grp", *[r6(c).alias(c) for c in ("MDS1", "MDS2", "misfit")])


# of the landmarks: eigenvalues sum to the trace of the centred matrix, their squares to its squared norm
COM8L_SQL = f"""WITH {_COUNTS_SQL},
lm AS (SELECT row_number() OVER (ORDER BY md5(user_id || ':123')) AS i, {", ".join(EVENT_TYPES)} FROM c QUALIFY i <= {cm.LANDMARKS}),
d AS (SELECT a.i, b.i AS j, power(({" + ".join(f"abs(a.{t} - b.{t})" for t in EVENT_TYPES)}) / ({" + ".join(f"a.{t} + b.{t}" for t in EVENT_TYPES)}), 2) AS d FROM lm a, lm b),
m AS (SELECT i, avg(d) AS m FROM d GROUP BY i),
b AS (SELECT d.i, d.j, -(d.d - x.m - y.m + t.t) / 2 AS b FROM d JOIN m x ON x.i = d.i JOIN m y ON y.i = d.j, (SELECT avg(d) AS t FROM d) t)
SELECT (SELECT count(*) FROM lm) AS landmarks, round(sum(CASE WHEN i = j THEN b END), 6) AS total, round(sum(b * b), 6) AS squared_norm FROM b"""


@register("com8_landmark_axes", ("COM-8",), COM8L_SQL)
def com8_landmark_axes(spark, sf):
    """Number of landmarks, sum and sum of squares of their eigenvalues."""
    _, info = cm.landmark_ordination(_counts(spark, sf), "user_id", EVENT_TYPES)
    e = info["eigenvalues"]
    return spark.range(1).select(F.lit(info["landmarks"]).cast("long").alias("landmarks"), r6(F.lit(float(sum(e)))).alias("total"), r6(F.lit(float(sum(v * v for v in e)))).alias("squared_norm"))


# ---------------------------------------------------------------- COM-9 ----

# ellipses of the two first ordination axes; rotation leaves each group's total
# scatter in all axes as it was, and group means of scores average to zero
@register("com9_group_shape", ("COM-9",), None)
def com9_group_shape(spark, sf):
    """Group centroid and 2 x 2 covariance on two ordination axes (ellipse data)."""
    d, cols = _emb(spark, sf)
    scores, _ = cm.ordinate(d, cols, k=2, keep=["label"])
    g = cm.group_shape(scores, "label", "PC1", "PC2")
    return g.select("label", "n", *[r6(c).alias(c) for c in ("mean_x", "mean_y", "var_x", "var_y", "cov_xy")])


COM9C_SQL = "WITH " + _COUNTS_SQL + """
SELECT grp, count(*) AS n, round(avg(view), 6) AS mean_x, round(avg(click), 6) AS mean_y, round(var_samp(view), 6) AS var_x,
  round(var_samp(click), 6) AS var_y, round(covar_samp(view, click), 6) AS cov_xy FROM c GROUP BY grp"""


@register("com9_group_shape_counts", ("COM-9",), COM9C_SQL)
def com9_group_shape_counts(spark, sf):
    """The same shape on two count variables."""
    g = cm.group_shape(_counts(spark, sf), "grp", "view", "click")
    return g.select("grp", "n", *[r6(c).alias(c) for c in ("mean_x", "mean_y", "var_x", "var_y", "cov_xy")])


# --------------------------------------------------------------- COM-10 ----

FIT_PERMS = PERMS
COM10_SQL = f"""WITH RECURSIVE {_LONG},
o AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS rk FROM embeddings),
tm AS (SELECT j, avg(x) AS m FROM l GROUP BY j),
c AS (SELECT o.rk, l.j, l.x - tm.m AS x FROM l JOIN tm ON l.j = tm.j JOIN o ON o.vec_id = l.vec_id),
ax AS (SELECT a.rk, a.x AS a, b.x AS b FROM c a JOIN c b ON a.rk = b.rk WHERE a.j = 1 AND b.j = 2),
xx AS (SELECT sum(a * a) AS aa, sum(a * b) AS ab, sum(b * b) AS bb, sum(a * a) * sum(b * b) - sum(a * b) * sum(a * b) AS det, count(*) AS n FROM ax),
pp AS (SELECT ax.rk, n, perm FROM ax, xx, (SELECT unnest(range(1, {FIT_PERMS + 1})) AS perm)),
{_rounds_sql("rk", "n", "123", "rk", "pp")},
mv AS (SELECT c.j, sum(ax.a * c.x) AS av, sum(ax.b * c.x) AS bv, sum(c.x * c.x) AS vv FROM c JOIN ax ON ax.rk = c.rk WHERE c.j > 2 GROUP BY c.j),
pv AS (SELECT pos.perm, c.j, sum(ax.a * c.x) AS av, sum(ax.b * c.x) AS bv FROM pos JOIN ax ON ax.rk = pos.rk JOIN c ON c.rk = pos.x WHERE c.j > 2 GROUP BY 1, 2),
fit AS (SELECT mv.j, (bb * av - ab * bv) / det AS ca, (aa * bv - ab * av) / det AS cb, (bb * av * av - 2 * ab * av * bv + aa * bv * bv) / det / vv AS r2, vv FROM mv, xx),
hit AS (SELECT pv.j, count(CASE WHEN (bb * av * av - 2 * ab * av * bv + aa * bv * bv) / det / fit.vv >= fit.r2 - {cm.PERM_EPS} THEN 1 END) AS ge
  FROM pv JOIN fit ON pv.j = fit.j, xx GROUP BY pv.j)
SELECT 'e' || (fit.j - 1) AS variable, round(ca / sqrt(ca * ca + cb * cb), 6) AS dir_e0, round(cb / sqrt(ca * ca + cb * cb), 6) AS dir_e1,
  round(r2, 6) AS r2, round((ge + 1) / {FIT_PERMS + 1}.0::DOUBLE, 6) AS p_value
FROM fit JOIN hit ON fit.j = hit.j"""


@register("com10_vector_fit", ("COM-10",), COM10_SQL)
def com10_vector_fit(spark, sf):
    """Direction, r2 and permutation p of all other variables on two axes."""
    d, cols = _emb(spark, sf)
    v = cm.vector_fit(d, cols[:2], cols[2:], permutations=FIT_PERMS, seed=123, id_col="vec_id")
    return v.select("variable", *[r6(c).alias(c) for c in v.columns if c != "variable"])


# --------------------------------------------------------------- COM-11 ----

# y: a curve with noise from the data. The optimum is stated by its normal
# equations: residuals are orthogonal to the curve's three derivatives.
COM11_SQL = """WITH p AS (SELECT CAST(p_size AS DOUBLE) AS x, 5 + 2 * exp(0.03 * p_size) + (p_partkey % 7 - 3) / 10.0::DOUBLE AS y FROM part)
SELECT count(*) AS n_points, round(sum((y - m) * (y - m)), 4) AS tss, 0.0::DOUBLE AS pull_a, 0.0::DOUBLE AS pull_b, 0.0::DOUBLE AS pull_c,
  TRUE AS below_generating, TRUE AS converged FROM p, (SELECT avg(y) AS m FROM p)"""


def _points(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("double").alias("x"))
    return p.withColumn("y", F.lit(5.0) + F.lit(2.0) * F.exp(F.lit(0.03) * F.col("x")) + (F.col("p_partkey") % 7 - 3) / F.lit(10.0))


@register("com11_fit_exponential", ("COM-11",), COM11_SQL)
def com11_fit_exponential(spark, sf):
    """Least-squares fit of y = a + b exp(c x) to noisy points: size, spread and normal equations at the optimum."""
    p = _points(spark, sf)
    fit = cm.fit_exponential(p, "x", "y", start=(-20.0, 10.0, 0.03))
    r = fit.first()
    e = F.exp(F.lit(r["c"]) * F.col("x"))
    res = cm.exponential_residuals(p, "x", "y", fit)
    made = F.col("y") - (F.lit(5.0) + F.lit(2.0) * F.exp(F.lit(0.03) * F.col("x")))
    pull = {"pull_a": F.lit(1.0), "pull_b": e, "pull_c": F.lit(r["b"]) * F.col("x") * e}
    scale = {k: F.sqrt(F.sum(v * v)) * F.sqrt(F.sum(F.col("residual") ** 2)) for k, v in pull.items()}
    return res.agg(F.count(F.lit(1)).alias("n_points"), rn(F.lit(r["tss"]), 4).alias("tss"),
                   *[rn(F.sum(F.col("residual") * v) / scale[k], 4).alias(k) for k, v in pull.items()],
                   (F.sum(F.col("residual") ** 2) <= F.sum(made * made)).alias("below_generating"), F.lit(r["converged"]).alias("converged"))


# the twin finds the rate by itself: nine times the best of 65 rates, each time between the neighbours of the best
def _rates_sql(level: int) -> str:
    src = "(SELECT -0.5::DOUBLE AS lo, 0.5::DOUBLE AS hi)" if level == 0 else f"(SELECT c - step AS lo, c + step AS hi FROM b{level - 1})"
    return f"""g{level} AS (SELECT lo + (hi - lo) * k / 64 AS c, (hi - lo) / 64 AS step FROM {src}, (SELECT unnest(range(0, 65)) AS k)),
b{level} AS (SELECT c, step FROM (SELECT c, any_value(step) AS step, corr(y, u) AS r FROM (
  SELECT c, step, y, CASE WHEN abs(c) < 1e-12 THEN x - m ELSE (exp(c * (x - m)) - 1) / c END AS u FROM p, mx, g{level}) GROUP BY c) ORDER BY r * r DESC, c LIMIT 1)"""


_COM11_FIT_SQL = """WITH p AS (SELECT p_partkey, CAST(p_size AS DOUBLE) AS x, 5 + 2 * exp(0.03 * p_size) + (p_partkey % 7 - 3) / 10.0::DOUBLE AS y FROM part),
mx AS (SELECT avg(x) AS m FROM p),
""" + ",\n".join(_rates_sql(k) for k in range(6)) + """,
ab AS (SELECT any_value(c) AS c, regr_slope(y, exp(c * x)) AS b, regr_intercept(y, exp(c * x)) AS a FROM p, b5),
f AS (SELECT p_partkey, x, y, a, b, c, a + b * exp(c * x) AS fitted FROM p, ab)"""

COM11R_SQL = _COM11_FIT_SQL + """
SELECT p_partkey, x, round(fitted, 4) AS fitted, round(y - fitted, 4) AS residual FROM f"""


@register("com11_residuals", ("COM-11",), COM11R_SQL)
def com11_residuals(spark, sf):
    """Fitted value and residual of every point."""
    p = _points(spark, sf)
    res = cm.exponential_residuals(p, "x", "y", cm.fit_exponential(p, "x", "y"))
    return res.select("p_partkey", "x", rn("fitted", 4).alias("fitted"), rn("residual", 4).alias("residual"))


COM11P_SQL = _COM11_FIT_SQL + """
SELECT round(any_value(a), 3) AS a, round(any_value(b), 3) AS b, round(any_value(c), 5) AS c, round(sum((y - fitted) * (y - fitted)), 4) AS rss,
  round(1 - sum((y - fitted) * (y - fitted)) / (var_pop(y) * count(*)), 6) AS r2, count(*) AS n_points FROM f"""


@register("com11_growth_parameters", ("COM-11",), COM11P_SQL)
def com11_growth_parameters(spark, sf):
    """Estimates, RSS and R2 of the growth curve."""
    r = cm.fit_exponential(_points(spark, sf), "x", "y")
    return r.select(rn("a", 3).alias("a"), rn("b", 3).alias("b"), rn("c", 5).alias("c"), rn("rss", 4).alias("rss"), r6("r2").alias("r2"), "n_points")
