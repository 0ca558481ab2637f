"""Distances, linkage, k-means, density clusters and the choice of k."""

from __future__ import annotations

from pyspark.sql import functions as F

from segloom.config import AXES, CELL, CELL_RAW_K, DENSITY_AXES, MISSING, SINGLE_SEGMENT_CELL, TUNED_CONFIG, TUNED_K_SCALE
from segloom.functions.columns import cell_slug
from segloom.operators import density as DN
from segloom.operators import distance as D
from segloom.operators import encoding as E
from segloom.operators import kmeans as K
from segloom.operators import linkage as L
from segloom.operators import stats as S
from segloom.plans import segment as SG
from segloom.plans import views as V
from segloom.plans.ranking_queries import SCORES, scores
from segloom.plans.registry import query
from segloom.plans.stats_queries import dominant_sql, rounded
from segloom.runtime import beside, cut

M = MISSING
CELLS = "job_type, payment_group"
VC = ("v_cells",)
LABELED = ("v_labeled",)


def _miss(c):
    return f"(trim({c}) = '{M}')"


def axis_sql(a, b, w):
    both, one = f"({_miss(a)} AND {_miss(b)})", f"({_miss(a)} <> {_miss(b)})"
    d = f"CASE WHEN {both} THEN 0 WHEN {one} THEN 0.35 WHEN {a} = {b} THEN 0 ELSE 1 END::DOUBLE * {w}"
    ww = f"CASE WHEN {both} THEN 0 WHEN {one} THEN 0.5 ELSE 1 END::DOUBLE * {w}"
    return d, ww


def gower_sql(left, right, axes=DENSITY_AXES, weights=(1, 1, 3, 3)):
    parts = [axis_sql(f"{left}{a}", f"{right}{a}", w) for a, w in zip(axes, weights)]
    top, bottom = " + ".join(p[0] for p in parts), " + ".join(p[1] for p in parts)
    return f"coalesce(({top}) / nullif({bottom}, 0), 0)"


DOMS = dominant_sql("v_cells", CELLS, AXES)
CONTRIBUTIONS = ", ".join(
    f"round(sum({d}), 6) AS d_{a}, round(sum({w}), 6) AS w_{a}" for a in AXES for d, w in [axis_sql(f"v.{a}", f"x.dom_{a}", 1)]
)


@query(
    "axis_contributions",
    f"WITH doms AS ({DOMS}) SELECT v.job_type, v.payment_group, {CONTRIBUTIONS} FROM v_cells v JOIN doms x USING (job_type, payment_group) GROUP BY 1, 2",
    VC,
)
def axis_contributions(spark, sf):
    """Distance and weight of every row to its cell's dominant values, summed per cell."""
    rows = V.cells(spark, sf)
    joined = rows.join(S.dominants(rows, CELL, AXES), [*CELL])
    sums = []
    for a in AXES:
        d, w = D.axis_contribution(F.col(a), F.col(f"dom_{a}"))
        sums += [F.round(F.sum(d), 6).alias(f"d_{a}"), F.round(F.sum(w), 6).alias(f"w_{a}")]
    return joined.groupBy(*CELL).agg(*sums)


@query(
    "distance_to_dominant",
    f"WITH doms AS ({DOMS}) SELECT v.posting_id, round({gower_sql('v.', 'x.dom_')}, 6) AS distance FROM v_cells v JOIN doms x USING (job_type, payment_group)",
    VC,
)
def distance_to_dominant(spark, sf):
    rows = V.cells(spark, sf)
    joined = rows.join(S.dominants(rows, CELL, AXES), [*CELL])
    distance = D.gower([F.col(a) for a in AXES], [F.col(f"dom_{a}") for a in AXES])
    return joined.select("posting_id", F.round(distance, 6).alias("distance"))


PROFILES = f"prof AS (SELECT {CELLS}, place, purpose, topic, treatment, count(*) AS n FROM v_cells GROUP BY ALL)"
PAIRED = f"""prof AS (SELECT *, row_number() OVER (PARTITION BY {CELLS} ORDER BY place, purpose, topic, treatment) - 1 AS pid FROM
  (SELECT {CELLS}, place, purpose, topic, treatment, count(*) AS n FROM v_cells GROUP BY ALL))"""


@query("profiles", f"WITH {PROFILES} SELECT * FROM prof", VC)
def profiles(spark, sf):
    return D.profiles(V.cells(spark, sf)).drop("pid")


@query(
    "profile_pairs",
    f"""WITH {PAIRED} SELECT {CELLS}, CAST(sum(n_pairs) AS BIGINT) AS n_pairs, CAST(sum(row_pairs) AS BIGINT) AS row_pairs FROM (
        SELECT a.job_type, a.payment_group, count(*) AS n_pairs, sum(a.n * b.n) AS row_pairs FROM prof a JOIN prof b USING (job_type, payment_group) WHERE a.pid < b.pid GROUP BY 1, 2) GROUP BY ALL""",
    VC,
)
def profile_pairs(spark, sf):
    out = D.gower_histogram(D.profiles(V.cells(spark, sf)))
    return out.groupBy(*CELL).agg(F.sum("n_pairs").alias("n_pairs"), F.sum("row_pairs").alias("row_pairs"))


@query(
    "gower_distances",
    f"""WITH {PAIRED} SELECT a.job_type, a.payment_group, round({gower_sql('a.', 'b.')}, 6) AS d, count(*) AS n_pairs, CAST(sum(a.n * b.n) AS BIGINT) AS row_pairs
        FROM prof a JOIN prof b USING (job_type, payment_group) WHERE a.pid < b.pid GROUP BY ALL""",
    VC,
)
def gower_distances(spark, sf):
    return D.gower_histogram(D.profiles(V.cells(spark, sf)))


@query(
    "gower_neighbours",
    f"""WITH {PAIRED}, d AS (SELECT a.job_type, a.payment_group, a.place, a.purpose, a.topic, a.treatment, a.n, a.pid = b.pid AS own, b.n AS m, {gower_sql('a.', 'b.')} AS d
        FROM prof a JOIN prof b USING (job_type, payment_group))
        SELECT {CELLS}, place, purpose, topic, treatment, n, round(min(d) FILTER (NOT own), 6) AS nearest, round(sum(d * m) / sum(m), 6) AS mean_distance FROM d GROUP BY ALL""",
    VC,
)
def gower_neighbours(spark, sf):
    return rounded(D.gower_nearest(D.profiles(V.cells(spark, sf))).drop("pid"), "nearest", "mean_distance")


def _k_sql(scaled):
    whens = " ".join(
        f"WHEN '{c}' THEN greatest(1, round_even({k} * {float(TUNED_K_SCALE.get(c, 1.0)) if scaled else 1.0}::DOUBLE, 0))" for c, k in CELL_RAW_K.items()
    )
    return f"CAST(greatest(1, least(CASE job_type || '_' || payment_group {whens} ELSE 1 END, count(*))) AS INT)"


@query("raw_cluster_counts", f"SELECT {CELLS}, count(*) AS n, {_k_sql(False)} AS k, {_k_sql(True)} AS tuned_k FROM v_cells GROUP BY {CELLS}", VC)
def raw_cluster_counts(spark, sf):
    from segloom.config import DEFAULT_CONFIG

    sizes = V.cells(spark, sf).groupBy(*CELL).agg(F.count("*").alias("n"))
    slug = cell_slug()
    return sizes.select(
        *CELL, "n", D.target_raw_k(slug, F.col("n"), DEFAULT_CONFIG).alias("k"), D.target_raw_k(slug, F.col("n"), TUNED_CONFIG).alias("tuned_k")
    )


@query("average_linkage")
def average_linkage(spark, sf):
    """Clusters of the profiles of all cells at the tuned number of clusters."""
    table = SG.catalogue_table(V.cells(spark, sf), TUNED_CONFIG)
    tree = SG.build_tree(table, TUNED_CONFIG)
    labeled = SG.label_table(table, tree, TUNED_CONFIG)
    return labeled.groupBy(*CELL, "raw_cluster_id").agg(F.sum("n").alias("n"), F.count("*").alias("n_profiles"))


@query(
    "average_linkage_rounds",
    f"""WITH r AS (SELECT * FROM v_cells WHERE job_type || '_' || payment_group <> '{SINGLE_SEGMENT_CELL}' AND ({' OR '.join(f"NOT {_miss(a)}" for a in DENSITY_AXES)})),
        p AS (SELECT {CELLS}, count(*) AS n_profiles FROM (SELECT DISTINCT {CELLS}, {', '.join(DENSITY_AXES)} FROM r) GROUP BY ALL),
        k AS (SELECT {CELLS}, count(*) AS n, {_k_sql(True)} AS k FROM r GROUP BY {CELLS})
        SELECT {CELLS}, n, n_profiles, CAST(least(k, n_profiles) AS BIGINT) AS n_clusters, 0::BIGINT AS n_closer FROM p JOIN k USING (job_type, payment_group)""",
    VC,
)
def average_linkage_rounds(spark, sf):
    """The same with blocks of 64 clusters, so that cells merge in distributed rounds; `n_closer` merges are lower than one inside them."""
    table = SG.catalogue_table(V.cells(spark, sf), TUNED_CONFIG)
    tree = SG.build_tree(table, TUNED_CONFIG, block=64)
    labeled = SG.label_table(table, tree, TUNED_CONFIG).filter((F.col("raw_cluster_id") >= 0) & (cell_slug() != SINGLE_SEGMENT_CELL))
    found = labeled.groupBy(*CELL).agg(
        F.sum("n").alias("n"), F.countDistinct(*DENSITY_AXES).alias("n_profiles"), F.countDistinct("raw_cluster_id").alias("n_clusters")
    )
    # Average linkage is monotone: what a cluster was made by is not higher than what it joins by.
    inner = tree.merges.select(*CELL, F.explode(F.array("a", "b")).alias("id"), F.col("round").alias("r"), F.col("height").alias("h"))
    outer = tree.merges.select(*CELL, F.explode(F.array("a", "b")).alias("id"), "round", "height")
    lower = outer.join(inner, [*CELL, "id"]).filter((F.col("r") < F.col("round")) & (F.col("height") < F.col("h") - 1e-6))
    closer = lower.groupBy(*CELL).agg(F.count("*").alias("n_closer"))
    return found.join(closer, [*CELL], "left").withColumn("n_closer", F.coalesce("n_closer", F.lit(0)))


KEYWORD_LIMIT = 0.75  # no two vectors are closer than 0.5, so the limit is not 0.35


def keyword_labels(spark, sf, block=1024):
    """The vectors (id, size, total) with their cluster."""
    units = V.table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.lit(1.0).alias("size"), D.unit_vector("embedding").alias("total")
    )
    points = cut(units)
    merges = L.average_linkage(points, [], D.CosineForm(), max_height=KEYWORD_LIMIT, block=block)
    grouped = points.withColumn("_all", F.lit(0))
    return points.join(L.cut_tree(grouped, merges, ["_all"]).select("id", "cluster"), "id")


@query("keyword_clusters")
def keyword_clusters(spark, sf):
    """Average linkage of the vectors."""
    return keyword_labels(spark, sf).groupBy("cluster").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


@query("keyword_cluster_gaps", "SELECT count(*) AS n_vectors, 0::BIGINT AS n_below FROM embeddings")
def keyword_cluster_gaps(spark, sf):
    """Vectors in clusters (merged in rounds over blocks of 256), and pairs of clusters that are still closer than the limit: none."""
    sums = keyword_labels(spark, sf, block=256).select("cluster", F.posexplode("total").alias("at", "x"))
    sums = sums.groupBy("cluster", "at").agg(F.sum("x").alias("x"), F.count("*").cast("double").alias("size"))
    total = F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda p: p["x"])
    found = cut(sums.groupBy(F.col("cluster").cast("long").alias("id")).agg(total.alias("total"), F.first("size").alias("size")))
    return beside(found.agg(F.sum("size").cast("long").alias("n_vectors")), L.pairs_below(found, D.CosineForm(), KEYWORD_LIMIT))


@query(
    "cosine_neighbours",
    """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), p AS (SELECT a.vec_id, a.label, round(1 - list_cosine_similarity(a.v, b.v), 6) AS d
       FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id) SELECT vec_id, label, min(d) AS distance FROM p GROUP BY 1, 2""",
)
def cosine_neighbours(spark, sf):
    out = D.cosine_nearest(V.table(spark, sf, "embeddings"), ["label"], "vec_id", "embedding")
    return out.select("vec_id", "label", F.round("distance", 6).alias("distance"))


DOMAIN = {"place": ["A", "R", M], "career": ["any", "senior"], "continuity": [M, "once"]}


def _slots_sql():
    parts, offset = [], 0
    for a, values in DOMAIN.items():
        fall = M if M in values else values[-1]
        pos = f"list_position([{', '.join(repr(v) for v in values)}], CASE WHEN {a} IN ({', '.join(repr(v) for v in values)}) THEN {a} ELSE '{fall}' END) - 1 + {offset}"
        parts.append(f"SELECT posting_id, CAST({pos} AS INT) AS slot FROM v_cells")
        offset += len(values)
    return " UNION ALL ".join(parts)


@query("onehot_fixed", f"SELECT slot, count(*) AS n FROM ({_slots_sql()}) GROUP BY 1", VC)
def onehot_fixed(spark, sf):
    from pyspark.ml.functions import vector_to_array

    rows = E.onehot_fixed(V.cells(spark, sf), DOMAIN)
    ones = F.posexplode(vector_to_array("features")).alias("slot", "x")
    return rows.select(ones).filter("x = 1").groupBy("slot").agg(F.count("*").alias("n"))


LEARNED = " UNION ".join(f"SELECT {i} AS o, {a} AS value FROM v_cells WHERE {a} <> '{M}'" for i, a in enumerate(AXES))
SLOTTED = " UNION ALL ".join(f"SELECT slot FROM v_cells JOIN s ON o = {i} AND value = {a}" for i, a in enumerate(AXES))


@query(
    "onehot_learned",
    f"""WITH v AS ({LEARNED}), s AS (SELECT *, CAST(row_number() OVER (ORDER BY o, value) - 1 AS INT) AS slot FROM v)
        SELECT slot, count(*) AS n FROM ({SLOTTED}) GROUP BY 1""",
    VC,
)
def onehot_learned(spark, sf):
    """Rows per slot of the values of all axes."""
    from pyspark.ml.functions import vector_to_array

    rows = V.cells(spark, sf).select(*AXES)
    model = E.fit_onehot(rows, AXES, drop_missing=True)
    ones = F.posexplode(vector_to_array("features")).alias("slot", "x")
    return E.encode(rows, model, AXES, True).select(ones).filter("x = 1").groupBy("slot").agg(F.count("*").alias("n"))


CORE = ("place", "purpose", "treatment")


def cell_profiles(spark, sf, axes):
    rows = V.cells(spark, sf)
    return cut(K.numbered(S.compress(rows, CELL, axes), CELL, axes))


def _cells(small):
    return [tuple(r) for r in small.select(*CELL).distinct().orderBy(*CELL).collect()]  # the nine cells


@query("kmeans_best")
def kmeans_best(spark, sf):
    """Best of ten seeds per cell on three axes, with the cell's cluster number."""
    from segloom.config import K_CAP

    small = cell_profiles(spark, sf, CORE)
    best = K.kmeans_best(small, CORE, {c: K_CAP["_".join(c)] for c in _cells(small)})
    return best.groupBy(*CELL, "cluster").agg(F.sum("n").alias("n"), F.round(F.max("silhouette"), 6).alias("silhouette"))


def _square_sql(axes):
    return " + ".join(f"CASE WHEN a.{x} = b.{x} THEN 0 ELSE 2 - CAST(a.{x} = '{M}' AS INT) - CAST(b.{x} = '{M}' AS INT) END" for x in axes)


@query(
    "silhouette",
    f"""WITH pts AS (SELECT job_type, payment_group, place, topic, career, raw_cluster_id AS c, count(*) AS n FROM v_labeled GROUP BY ALL),
        d AS (SELECT a.job_type, a.payment_group, a.place, a.topic, a.career, a.c, a.n, b.c AS o, sum(sqrt({_square_sql(('place', 'topic', 'career'))}) * b.n) AS t, sum(b.n) AS m
          FROM pts a JOIN pts b USING (job_type, payment_group) GROUP BY ALL),
        s AS (SELECT job_type, payment_group, place, topic, career, c, n, max(t / (m - 1)) FILTER (c = o AND m > 1) AS a, min(t / m) FILTER (c <> o) AS b FROM d GROUP BY ALL)
        SELECT job_type, payment_group, round(sum(coalesce((b - a) / nullif(greatest(a, b), 0), 0) * n) / sum(n), 6) AS silhouette, count(DISTINCT c) AS n_clusters FROM s GROUP BY ALL""",
    LABELED,
)
def silhouette(spark, sf):
    axes = ["place", "topic", "career"]
    points = S.compress(V.labeled(spark, sf), CELL, [*axes, "raw_cluster_id"])
    points = cut(K.numbered(points, CELL, [*axes, "raw_cluster_id"]))
    return rounded(K.silhouette(points, CELL, axes, "raw_cluster_id", drop_missing=True), "silhouette")


@query("k_sweep")
def k_sweep(spark, sf):
    """Silhouette and variance ratio for every k from 3 to the cell's cap, with the recommended k; a cell with the cap 1 has none."""
    from segloom.config import K_CAP

    small = cell_profiles(spark, sf, CORE)
    caps = {c: K_CAP["_".join(c)] for c in _cells(small)}
    ks = {c: range(min(3, cap), cap + 1) for c, cap in caps.items() if cap > 1}
    table = cut(K.k_sweep(small, CORE, ks))
    chosen = K.recommend_k(table, CELL)
    best = K.sweep_choice(table)
    return rounded(table.join(chosen, [*CELL]).join(best, [*CELL]).withColumn("all_low", F.col("all_low").cast("int")), "silhouette", "ch", "best_silhouette")


def _long(source, by, axes):
    return " UNION ALL ".join(f"SELECT {by}, '{a}' AS axis, {a} AS value, count(*) AS n FROM {source} GROUP BY ALL" for a in axes)


@query(
    "variance_ratio",
    f"""WITH v AS ({_long('v_labeled', CELLS + ', raw_cluster_id', DENSITY_AXES)}), sz AS (SELECT {CELLS}, raw_cluster_id, count(*) AS size FROM v_labeled GROUP BY ALL),
        w AS (SELECT {CELLS}, sum(n * (1 - n / size)) AS within FROM v JOIN sz USING (job_type, payment_group, raw_cluster_id) GROUP BY ALL),
        tot AS (SELECT {CELLS}, sum(size) AS size, count(*) AS k FROM sz GROUP BY ALL),
        pl AS (SELECT {CELLS}, axis, value, sum(n) AS n FROM v GROUP BY ALL),
        t AS (SELECT {CELLS}, sum(n * (1 - n / size)) AS total, any_value(size) AS size, any_value(k) AS k FROM pl JOIN tot USING (job_type, payment_group) GROUP BY ALL)
        SELECT {CELLS}, CAST(size AS BIGINT) AS n, k, round(((total - within) / (k - 1)) / (within / (size - k)), 4) AS score FROM t JOIN w USING (job_type, payment_group)""",
    LABELED,
)
def variance_ratio(spark, sf):
    return rounded(K.calinski_harabasz(V.labeled(spark, sf), CELL, DENSITY_AXES, "raw_cluster_id"), "score", digits=4)


def kneedle_sql(source, x, y):
    """Elbow per cell of the (x, y) rows of `source`."""
    return f"""SELECT cell, CASE WHEN count(*) <= 2 THEN min({x}) ELSE arg_max({x}, far * 1000000.0 - {x} / 1000000.0) END AS elbow FROM (
      SELECT cell, {x}, round(abs(dx * ey - dy * ex) / CASE WHEN ex = 0 AND ey = 0 THEN 1 ELSE sqrt(ex * ex + ey * ey) END, 9) AS far FROM (
        SELECT *, last_value(dx) OVER w AS ex, last_value(dy) OVER w AS ey FROM (
          SELECT *, xs - first_value(xs) OVER w AS dx, ys - first_value(ys) OVER w AS dy FROM (
            SELECT cell, {x}, coalesce(({x} - min({x}) OVER c) / nullif(max({x}) OVER c - min({x}) OVER c, 0), 0) AS xs,
              coalesce(({y} - min({y}) OVER c) / nullif(max({y}) OVER c - min({y}) OVER c, 0), 0) AS ys FROM {source} WINDOW c AS (PARTITION BY cell))
          WINDOW w AS (PARTITION BY cell ORDER BY {x}))
        WINDOW w AS (PARTITION BY cell ORDER BY {x} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))) GROUP BY cell"""


@query("elbow_of_scores", f"WITH {SCORES} {kneedle_sql('scores', 'k', 'score')}")
def elbow_of_scores(spark, sf):
    return K.kneedle(scores(spark, sf), ["cell"], "k", "score")


STEPS = "steps AS (SELECT cell, k, score - lag(score) OVER (PARTITION BY cell ORDER BY k) AS step FROM scores QUALIFY step IS NOT NULL)"


@query(
    "recommended_k",
    f"""WITH {SCORES}, {STEPS}, e AS ({kneedle_sql('steps', 'k', 'step')}), b AS (SELECT cell, arg_max(k, ch * 1000 - k / 1000.0) AS ch_best FROM scores GROUP BY 1)
        SELECT cell, elbow AS recommended_k, ch_best, CASE abs(ch_best - elbow) WHEN 0 THEN 'equal' WHEN 1 THEN 'within_one' ELSE 'differ' END AS agreement FROM e JOIN b USING (cell)""",
)
def recommended_k(spark, sf):
    return K.recommend_k(scores(spark, sf), ["cell"], "k", "score", "ch")


@query(
    "k_caps",
    """SELECT p_partkey, p_size AS cap, CAST(CASE WHEN p_size <= 1 THEN 1 ELSE greatest(least(15, p_size // 2), CASE WHEN p_size >= 6 THEN 3 ELSE 2 END) END AS INT) AS k_cap FROM part""",
)
def k_caps(spark, sf):
    return V.table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("cap"), K.derive_k_cap(F.col("p_size")).alias("k_cap"))


def density_sql(axes, source="v_cells"):
    """Rows, clusters and noise per cell: components of every level by reachability, then clusters level by level."""
    slug = "job_type || '_' || payment_group"
    sizes = " ".join(f"WHEN '{c}' THEN {n}" for c, n in DN.MIN_CLUSTER_SIZE.items())
    explicit = " OR ".join(f"{a} <> '{M}'" for a in axes)
    steps, chosen = [], []
    for level in range(1, 2 * len(axes) + 1):
        fall = level**-0.5
        stability = f"CASE WHEN mass > 0 THEN gone - mass * {fall!r} ELSE 0 END"
        steps.append(f"""ch{level} AS (SELECT s.*, k.c AS up, {stability} AS stability, greatest({stability}, inside) AS best, count(*) OVER (PARTITION BY s.cell, k.c) AS k
            FROM st{level - 1} s JOIN comp k ON k.l = {level} AND k.cell = s.cell AND k.p = s.c WHERE s.big),
          up{level} AS (SELECT cell, up, max(k) AS k, sum(size) AS bsize, sum(gone) AS bgone, sum(mass) AS bmass, sum(inside) AS binside, sum(best) AS bbest FROM ch{level} GROUP BY ALL),
          st{level} AS (SELECT n.cell, c, size, size >= mcs AS big,
            CASE WHEN k = 1 THEN bgone ELSE 0 END + CASE WHEN k = 1 THEN size - bsize ELSE size END * {fall!r} AS gone,
            CASE WHEN k = 1 THEN bmass + size - bsize ELSE size END AS mass,
            CASE WHEN k = 1 THEN binside WHEN k > 1 THEN bbest ELSE 0 END AS inside
            FROM node n LEFT JOIN up{level} u ON u.cell = n.cell AND u.up = n.c WHERE l = {level})""")
        chosen.append(f"SELECT {level} AS l, cell, c FROM ch{level} WHERE k > 1 AND NOT inside > stability")
    return f"""WITH RECURSIVE prof AS (SELECT {CELLS}, {slug} AS cell, {', '.join(axes)}, count(*) AS n FROM {source} GROUP BY ALL),
      pts AS (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY {', '.join(axes)}) AS pid, CASE cell {sizes} ELSE 10 END AS mcs,
        sum(n) OVER (PARTITION BY cell) AS all_rows, max(CASE WHEN {explicit} THEN 1 ELSE 0 END) OVER (PARTITION BY cell) AS explicit FROM prof),
      fit AS (SELECT * FROM pts WHERE cell <> '{SINGLE_SEGMENT_CELL}' AND all_rows >= mcs AND explicit = 1),
      d AS (SELECT a.cell, a.pid AS p, b.pid AS q, {_square_sql(axes)} AS square, b.n, greatest(1, a.mcs // 2) AS least FROM fit a JOIN fit b USING (cell)),
      core AS (SELECT cell, p, min(square) AS core FROM (SELECT *, sum(n) OVER (PARTITION BY cell, p ORDER BY square) AS reach FROM d) WHERE reach >= least GROUP BY ALL),
      m AS (SELECT d.cell, d.p, d.q, greatest(square, x.core, y.core) AS level FROM d JOIN core x USING (cell, p) JOIN core y ON y.cell = d.cell AND y.p = d.q WHERE d.p <> d.q),
      reach (l, cell, p, c) USING KEY (l, cell, p) AS (SELECT l, cell, p, p FROM core, range(0, {2 * len(axes) + 1}) t(l) WHERE core <= l
        UNION SELECT r.l, r.cell, m.q, min(r.c) FROM reach r JOIN m ON m.cell = r.cell AND m.p = r.p AND m.level <= r.l
          JOIN recurring.reach x ON x.l = r.l AND x.cell = r.cell AND x.p = m.q WHERE r.c < x.c GROUP BY ALL),
      comp AS MATERIALIZED (SELECT * FROM reach),
      node AS MATERIALIZED (SELECT l, cell, c, CAST(sum(n) AS DOUBLE) AS size, max(mcs) AS mcs FROM comp JOIN fit USING (cell) WHERE p = pid GROUP BY ALL),
      st0 AS (SELECT cell, c, size, size >= mcs AS big, 'inf'::DOUBLE AS gone, size AS mass, 0.0::DOUBLE AS inside FROM node WHERE l = 0),
      {', '.join(steps)},
      chosen AS ({' UNION ALL '.join(chosen)}),
      lab AS (SELECT k.cell, k.p AS pid, arg_max(ch.l * 1000000 + ch.c, ch.l) AS label FROM chosen ch JOIN comp k ON k.l = ch.l - 1 AND k.cell = ch.cell AND k.c = ch.c GROUP BY ALL),
      lrows AS (SELECT pts.job_type, pts.payment_group, pts.n, CASE WHEN cell = '{SINGLE_SEGMENT_CELL}' THEN 0 ELSE coalesce(label, -1) END AS cluster FROM pts LEFT JOIN lab USING (cell, pid)),
      sizes AS (SELECT {CELLS}, cluster, CAST(sum(n) AS BIGINT) AS size FROM lrows GROUP BY ALL)
      SELECT {CELLS}, CAST(sum(size) AS BIGINT) AS n_rows, count(*) FILTER (cluster <> -1) AS n_clusters, CAST(coalesce(sum(size) FILTER (cluster = -1), 0) AS BIGINT) AS n_noise,
        round(coalesce(sum(size) FILTER (cluster = -1), 0) * 100.0::DOUBLE / sum(size), 6) AS noise_pct, min(size) FILTER (cluster <> -1) AS min_size,
        quantile_cont(size, 0.5) FILTER (cluster <> -1) AS median_size, max(size) FILTER (cluster <> -1) AS max_size FROM sizes GROUP BY ALL"""


@query("density_clusters", density_sql(CORE), VC)
def density_clusters(spark, sf):
    """Density clusters on the three core axes: clusters and noise per cell."""
    labels = DN.density_clusters(V.cells(spark, sf), CORE)
    return rounded(DN.density_summary(labels), "noise_pct")


@query("density_clusters_wide", density_sql(DENSITY_AXES), VC)
def density_clusters_wide(spark, sf):
    """The same on the four density axes, which make many more profiles."""
    labels = DN.density_clusters(V.cells(spark, sf), DENSITY_AXES)
    return rounded(DN.density_summary(labels), "noise_pct")


@query(
    "compared_methods",
    f"""SELECT {CELLS}, count(DISTINCT type_code) AS n_a, count(DISTINCT raw_cluster_id) FILTER (raw_cluster_id <> -1) AS n_b,
        round(count(*) FILTER (raw_cluster_id = -1) * 100.0::DOUBLE / count(*), 6) AS noise_pct FROM v_labeled GROUP BY {CELLS}""",
    LABELED,
)
def compared_methods(spark, sf):
    rows = V.labeled(spark, sf)
    a, b = rows.withColumn("cluster", F.col("type_code")), rows.withColumn("cluster", F.col("raw_cluster_id"))
    return rounded(K.compare_methods(a, b), "noise_pct")


