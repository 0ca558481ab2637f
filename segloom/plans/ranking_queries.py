"""Top-n, ranks, bins, samples, deltas."""

from __future__ import annotations

from pyspark.sql import functions as F

from segloom.config import CELL
from segloom.operators import ranking as R
from segloom.operators import stats as S
from segloom.plans import views as V
from segloom.plans.registry import query
from segloom.plans.stats_queries import assigned_postings, rounded

LABELED = ("v_labeled",)
ASSIGNED = ("v_assigned",)
CELLS = "job_type, payment_group"


@query(
    "first_rows_per_segment",
    f"""SELECT {CELLS}, raw_cluster_id, posting_id, CAST(row_number() OVER (PARTITION BY {CELLS}, raw_cluster_id ORDER BY posting_id) AS INT) AS rank
        FROM v_labeled QUALIFY rank <= 30""",
    LABELED,
)
def first_rows_per_segment(spark, sf):
    rows = V.labeled(spark, sf).select(*CELL, "raw_cluster_id", "posting_id")
    return R.top_n_per_group(rows, [*CELL, "raw_cluster_id"], ["posting_id"], 30)


@query(
    "segments_by_size",
    f"""SELECT *, CAST(row_number() OVER (PARTITION BY {CELLS} ORDER BY n DESC, first_cluster) - 1 AS INT) AS segment_id
        FROM (SELECT {CELLS}, raw_cluster_id AS first_cluster, count(*) AS n FROM v_labeled WHERE raw_cluster_id <> -1 GROUP BY ALL)""",
    LABELED,
)
def segments_by_size(spark, sf):
    sizes = S.compress(V.labeled(spark, sf).filter("raw_cluster_id <> -1"), CELL, ["raw_cluster_id"])
    return R.rank_by_size(sizes.withColumnRenamed("raw_cluster_id", "first_cluster"))


@query(
    "largest_segments",
    f"""WITH t AS (SELECT {CELLS}, segment_id, segment_key, count(*) AS n FROM v_assigned GROUP BY ALL), p AS (SELECT *, round(n * 100.0::DOUBLE / sum(n) OVER (PARTITION BY {CELLS}), 6) AS pct FROM t)
        SELECT *, CAST(row_number() OVER (PARTITION BY {CELLS} ORDER BY n DESC, segment_id) AS INT) AS rank FROM p WHERE segment_id <> -1 QUALIFY rank <= 3""",
    ASSIGNED,
)
def largest_segments(spark, sf):
    return rounded(R.largest_segments(V.assigned(spark, sf), 3), "pct")


@query(
    "assignment_queue",
    """SELECT id, title FROM v_postings WHERE is_deleted = 0 AND is_expired = 0 AND id NOT IN (SELECT doc_id FROM labels) ORDER BY id LIMIT 100""",
    ("v_postings",),
)
def assignment_queue(spark, sf):
    return R.queue(assigned_postings(spark, sf), 100).select("id", "title")


def hash_sql(key, seed=42):
    return f"('0x' || substr(md5('{seed}-' || {key}), 1, 15))::BIGINT"


@query("sampled_rows", f"SELECT id, lang FROM v_postings ORDER BY {hash_sql('id')}, id LIMIT 100", ("v_postings",))
def sampled_rows(spark, sf):
    """The sampling operator itself: 100 reproducible rows of the postings."""
    return R.sample_n(V.postings(spark, sf).select("id", "lang"), 100)


@query(
    "length_bins",
    """WITH t AS (SELECT id, lang, length(content) AS len FROM v_postings), q AS (SELECT lang, quantile_cont(len, 1.0::DOUBLE / 3) AS p33, quantile_cont(len, 2.0::DOUBLE / 3) AS p66 FROM t GROUP BY 1)
       SELECT id, lang, CAST(len AS INT) AS len, round(p33, 6) AS p33, round(p66, 6) AS p66, CASE WHEN len <= p33 THEN 'short' WHEN len <= p66 THEN 'medium' ELSE 'long' END AS length_bin FROM t JOIN q USING (lang)""",
    ("v_postings",),
)
def length_bins(spark, sf):
    rows = V.postings(spark, sf).select("id", "lang", F.length("content").alias("len"))
    return rounded(R.tercile_bins(rows, ["lang"], "len"), "p33", "p66")


@query(
    "stratified_sample",
    f"""WITH t AS (SELECT id, lang, length(content) AS len FROM v_postings), q AS (SELECT lang, quantile_cont(len, 1.0::DOUBLE / 3) AS p33, quantile_cont(len, 2.0::DOUBLE / 3) AS p66 FROM t GROUP BY 1),
        b AS (SELECT id, lang, CASE WHEN len <= p33 THEN 'short' WHEN len <= p66 THEN 'medium' ELSE 'long' END AS length_bin, {hash_sql('id')} AS h FROM t JOIN q USING (lang)),
        s AS (SELECT lang, length_bin, 90 // count(*) OVER () + CASE WHEN row_number() OVER (ORDER BY lang, length_bin) - 1 < 90 % count(*) OVER () THEN 1 ELSE 0 END AS quota FROM (SELECT DISTINCT lang, length_bin FROM b)),
        r AS (SELECT b.*, row_number() OVER (PARTITION BY lang, length_bin ORDER BY h, id) <= quota AS taken FROM b JOIN s USING (lang, length_bin)),
        f AS (SELECT lang, length_bin, taken OR row_number() OVER (PARTITION BY taken ORDER BY h, id) <= 90 - count(*) FILTER (taken) OVER () AS chosen FROM r)
        SELECT lang, length_bin, count(*) AS n FROM f WHERE chosen GROUP BY ALL""",
    ("v_postings",),
)
def stratified_sample(spark, sf):
    """Sizes of a 90-row sample over languages and length bins."""
    rows = V.postings(spark, sf).select("id", "lang", F.length("content").alias("len"))
    binned = R.tercile_bins(rows, ["lang"], "len").select("id", "lang", "length_bin")
    strata = binned.select("lang", "length_bin").distinct()
    strata = strata.withColumn("ord", F.row_number().over(R.Window.partitionBy(F.lit(1)).orderBy("lang", "length_bin")) - 1)
    chosen = R.stratified_sample(binned, strata, ["lang", "length_bin"], 90)
    return chosen.groupBy("lang", "length_bin").agg(F.count("*").alias("n"))


@query(
    "split_sizes",
    """WITH c AS (SELECT y, count(*) AS n FROM v_texts GROUP BY 1), e AS (SELECT y, n, round(n * 0.2::DOUBLE, 9) AS x FROM c),
       r AS (SELECT *, row_number() OVER (ORDER BY x - floor(x) DESC, CAST(y AS VARCHAR)) AS k, ceil(round(sum(n) OVER () * 0.2::DOUBLE, 9)) - sum(floor(x)) OVER () AS need FROM e)
       SELECT y, n, CAST(floor(x) + CASE WHEN k <= need THEN 1 ELSE 0 END AS BIGINT) AS n_test FROM r""",
    ("v_texts",),
)
def split_sizes(spark, sf):
    rows = R.split_train_test(V.texts(spark, sf).select("id", "y"), "y")
    return rows.groupBy("y").agg(F.count("*").alias("n"), F.count_if("is_test").alias("n_test"))


SCORES = "scores AS (SELECT l_returnflag AS cell, CAST(l_linenumber AS INT) AS k, round(avg(l_quantity), 6) AS score, round(avg(l_discount * 100), 6) AS ch FROM lineitem GROUP BY ALL)"


def scores(spark, sf):
    """A k-score table per cell, derived from the line items."""
    return V.table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("cell"), F.col("l_linenumber").alias("k")).agg(
        F.round(F.avg("l_quantity"), 6).alias("score"), F.round(F.avg(F.col("l_discount") * 100), 6).alias("ch")
    )


@query(
    "score_deltas",
    f"WITH {SCORES} SELECT cell, k, score, ch, round(score - lag(score) OVER (PARTITION BY cell ORDER BY k), 6) AS delta FROM scores",
)
def score_deltas(spark, sf):
    return rounded(R.delta(scores(spark, sf), ["cell"], "k", "score"), "delta")
