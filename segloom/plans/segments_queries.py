"""Merging, absorbing, splitting and naming segments; the catalogue build."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segloom.config import (
    CELL,
    COARSE_CONFIG,
    DEFAULT_CONFIG,
    DENSITY_AXES,
    DENSITY_VARIANTS,
    EXTENDED_VARIANTS,
    HYBRID,
    KEY_AXES,
    MISSING,
    SINGLE_SEGMENT_CELL,
    TUNED_CONFIG,
    WEIGHT_VARIANTS,
    SegmentConfig,
)
from segloom.functions.columns import cell_slug
from segloom.operators.distance import target_raw_k
from segloom.operators import merge as MG
from segloom.plans import segment as SG
from segloom.plans import views as V
from segloom.plans.registry import query
from segloom.plans.stats_queries import INFO, dominant_sql, key_sql
from segloom.runtime import beside

M = MISSING
CELLS = "job_type, payment_group"
LABELED = ("v_labeled",)
ASSIGNED = ("v_assigned",)


def sizes(df: DataFrame) -> DataFrame:
    return df.groupBy(*CELL, "segment_id", "segment_key").agg(F.count("*").alias("n"))


def name_sql(key="merge_key"):
    """Display name of a '|'-joined key."""
    return f"(SELECT CASE WHEN x = '' THEN '기타' ELSE x END FROM (SELECT array_to_string(list_filter(string_split({key}, '|'), lambda p: p NOT IN ('{M}', '{HYBRID}', '')), '·') AS x))"


MERGED = f"""info AS (SELECT *, {key_sql()} AS merge_key FROM ({INFO})),
seg AS (SELECT {CELLS}, merge_key, CAST(sum(n) AS BIGINT) AS n, min(raw_cluster_id) AS first FROM info GROUP BY ALL),
merged AS (SELECT *, CAST(row_number() OVER (PARTITION BY {CELLS} ORDER BY n DESC, first) - 1 AS INT) AS segment_id FROM seg)"""
POOR = f"SELECT {CELLS}, -1 AS segment_id, '정보 부족형' AS segment_key, count(*) AS n FROM v_labeled WHERE raw_cluster_id = -1 GROUP BY ALL"


@query(
    "merged_segments",
    f"WITH {MERGED} SELECT {CELLS}, segment_id, {name_sql()} AS segment_key, n FROM merged UNION ALL {POOR}",
    LABELED,
)
def merged_segments(spark, sf):
    return sizes(MG.merge_by_key(V.labeled(spark, sf), "raw_cluster_id", absorb=False))


@query(
    "segments_by_purpose",
    f"""WITH info AS ({INFO}), seg AS (SELECT {CELLS}, dom_purpose, CAST(sum(n) AS BIGINT) AS n, min(raw_cluster_id) AS first FROM info GROUP BY ALL)
        SELECT {CELLS}, CAST(row_number() OVER (PARTITION BY {CELLS} ORDER BY n DESC, first) - 1 AS INT) AS segment_id,
        CASE WHEN dom_purpose IN ('{M}', '{HYBRID}') THEN '기타' ELSE dom_purpose END AS segment_key, n FROM seg UNION ALL {POOR}""",
    LABELED,
)
def segments_by_purpose(spark, sf):
    """A key function of one's own: the purpose alone."""
    return sizes(MG.merge_by_key(V.labeled(spark, sf), "raw_cluster_id", key=lambda _: F.array("dom_purpose"), absorb=False))


def absorbed_sql(limit):
    """Segments that finally hold each key: a recursive query whose state is a cell's lists, one absorption a step.

    The rest of a pass waits in `queue`, smallest first by the sizes at its start; passes repeat while one has moved something.
    """
    alike = "len(list_filter(list_zip(keys[i], keys[j]), lambda z: z[1] = z[2]))"
    others = "list_filter(range(1, len(alive) + 1), lambda j: alive[j] AND j <> i)"
    small = f"list_filter(range(1, len(alive) + 1), lambda j: alive[j] AND sizes[j] < least)"
    return f"""lists AS (SELECT {CELLS}, list(first ORDER BY first) AS firsts, list(string_split(merge_key, '|') ORDER BY first) AS keys, list(n ORDER BY first) AS sizes, {limit} AS least FROM seg GROUP BY {CELLS}),
      walk AS (
        SELECT {CELLS}, least, firsts, keys, sizes, range(1, len(firsts) + 1) AS held, list_transform(firsts, lambda x: TRUE) AS alive, []::BIGINT[] AS queue, TRUE AS moved, 0 AS step FROM lists
        UNION ALL
        SELECT {CELLS}, least, firsts, keys,
          CASE WHEN act THEN list_transform(sizes, lambda s, j: s + CASE WHEN j = target THEN sizes[i] ELSE 0 END) ELSE sizes END,
          CASE WHEN act THEN list_transform(held, lambda t: CASE WHEN t = i THEN target ELSE t END) ELSE held END,
          CASE WHEN act THEN list_transform(alive, lambda x, j: x AND j <> i) ELSE alive END,
          CASE WHEN len(queue) > 0 THEN queue[2:] ELSE again END, len(queue) > 0 AND (moved OR act), step + 1
        FROM (SELECT *, list_min(list_transform({others}, lambda j: {{'a': -{alike}, 's': -sizes[j], 'j': j}})).j AS target,
            list_transform(list_sort(list_transform({small}, lambda j: {{'s': sizes[j], 'j': j}})), lambda x: x.j) AS again,
            len(queue) > 0 AND sizes[i] < least AND len(list_filter(alive, lambda x: x)) > 1 AS act FROM (SELECT *, queue[1] AS i FROM walk))
        WHERE len(queue) > 0 OR (moved AND len(again) > 0)),
      ended AS (SELECT {CELLS}, arg_max(firsts, step) AS firsts, arg_max(held, step) AS held FROM walk GROUP BY ALL),
      held AS (SELECT {CELLS}, unnest(firsts) AS first, unnest(list_transform(held, lambda j: firsts[j])) AS into_ FROM ended)"""


@query(
    "absorbed_segments",
    f"""WITH RECURSIVE {MERGED}, {absorbed_sql("(SELECT greatest(10, count(*) // 90) FROM v_labeled)")}
        SELECT {CELLS}, into_ AS "into", CAST(sum(n) AS BIGINT) AS n, count(*) AS n_keys FROM seg JOIN held USING (job_type, payment_group, first) GROUP BY ALL""",
    LABELED,
)
def absorbed_segments(spark, sf):
    """Segments after absorbing those below a tenth of the mean cell size of the rows."""
    rows = V.labeled(spark, sf)
    info = MG.cluster_info(rows, "raw_cluster_id")
    segments = info.groupBy(*CELL, "merge_key").agg(F.sum("n").alias("n"), F.min("raw_cluster_id").alias("first_cluster"))
    limit = max(10, rows.count() // 90)
    return MG.absorb_small(segments, min_size=limit).groupBy(*CELL, "into").agg(F.sum("n").alias("n"), F.count("*").alias("n_keys"))


@query(
    "absorbed_profiles",
    f"""WITH RECURSIVE seg AS (SELECT *, CAST(row_number() OVER (PARTITION BY {CELLS} ORDER BY merge_key) AS INT) AS first FROM
          (SELECT {CELLS}, purpose || '|' || place || '|' || topic AS merge_key, count(*) AS n FROM v_labeled GROUP BY ALL)),
        {absorbed_sql("(SELECT greatest(10, count(*) // 200) FROM v_labeled)")}
        SELECT {CELLS}, into_ AS "into", CAST(sum(n) AS BIGINT) AS n, count(*) AS n_keys FROM seg JOIN held USING (job_type, payment_group, first) GROUP BY ALL""",
    LABELED,
)
def absorbed_profiles(spark, sf):
    """Every purpose, place and topic a segment of its own: most are too small and are absorbed in many steps."""
    rows = V.labeled(spark, sf)
    segments = rows.groupBy(*CELL, F.concat_ws("|", "purpose", "place", "topic").alias("k")).agg(F.count("*").alias("n"))
    order = F.row_number().over(Window.partitionBy(*CELL).orderBy("k"))  # over the distinct keys of a cell
    segments = segments.select(*CELL, F.split("k", r"\|").alias("merge_key"), "n", order.alias("first_cluster"))
    return MG.absorb_small(segments, min_size=max(10, rows.count() // 200)).groupBy(*CELL, "into").agg(F.sum("n").alias("n"), F.count("*").alias("n_keys"))


DOMS2 = dominant_sql("stage", CELLS + ", segment_id", KEY_AXES)
COARSE2 = key_sql(f"CASE WHEN dom_topic NOT IN ('{HYBRID}', '{M}') THEN dom_topic END")


@query(
    "second_pass",
    f"""WITH {MERGED}, stage AS (SELECT v.*, m.segment_id FROM v_labeled v JOIN info USING (job_type, payment_group, raw_cluster_id) JOIN merged m USING (job_type, payment_group, merge_key)),
        i2 AS (SELECT *, {COARSE2} AS k FROM ({DOMS2})), s2 AS (SELECT {CELLS}, k, CAST(sum(n) AS BIGINT) AS n, min(segment_id) AS first FROM i2 GROUP BY ALL)
        SELECT {CELLS}, CAST(row_number() OVER (PARTITION BY {CELLS} ORDER BY n DESC, first) - 1 AS INT) AS segment_id, {name_sql('k')} AS segment_key, n FROM s2 UNION ALL {POOR}""",
    LABELED,
)
def second_pass(spark, sf):
    first = MG.merge_by_key(V.labeled(spark, sf), "raw_cluster_id", absorb=False)
    return sizes(MG.second_pass(first, replace(COARSE_CONFIG, absorb_small=False)))


VAGUE = dominant_sql("(SELECT * FROM v_assigned WHERE segment_id <> -1)", CELLS + ", segment_id", ("purpose", "place"))


@query(
    "absorbed_ambiguous",
    f"""WITH d AS (SELECT *, dom_purpose IN ('{HYBRID}', '{M}') AND dom_place IN ('{HYBRID}', '{M}') AS vague FROM ({VAGUE})),
        r AS (SELECT *, CASE WHEN vague THEN -1 ELSE CAST(row_number() OVER (PARTITION BY {CELLS}, vague ORDER BY segment_id) - 1 AS INT) END AS new FROM d)
        SELECT a.job_type, a.payment_group, coalesce(new, -1) AS segment_id, CASE WHEN coalesce(vague, TRUE) THEN '정보 부족형' ELSE a.segment_key END AS segment_key, count(*) AS n
        FROM v_assigned a LEFT JOIN r USING (job_type, payment_group, segment_id) GROUP BY ALL""",
    ASSIGNED,
)
def absorbed_ambiguous(spark, sf):
    return sizes(MG.absorb_ambiguous(V.assigned(spark, sf)))


def names_sql(source, by):
    """Plain and place-missing names of the groups of `source`."""
    doms = dominant_sql(source, by, KEY_AXES)
    kept = f"array_to_string(list_filter([dom_purpose, dom_topic], lambda p: p NOT IN ('{M}', '')), '·')"
    return f"""SELECT *, {name_sql('mk')} AS plain, CASE WHEN {kept} = '' THEN '장소미기재' ELSE {kept} || '·장소미기재' END AS no_place
      FROM (SELECT *, {key_sql()} AS mk FROM ({doms}))"""


def split_sql(source, part, fits, name_b):
    """Rows per segment after a split; `fits` selects from d (dominants, n, n_b, n_a)."""
    doms = dominant_sql("op", CELLS + ", segment_id", ("purpose", "place", "topic"))
    return f"""WITH src AS ({source}), op AS (SELECT *, {part} AS part FROM src WHERE segment_id <> -1),
      c AS (SELECT {CELLS}, segment_id, count(*) FILTER (part) AS n_b, count(*) FILTER (NOT part) AS n_a FROM op GROUP BY ALL),
      d AS (SELECT *, max(segment_id) OVER (PARTITION BY {CELLS}) AS last FROM ({doms}) JOIN c USING (job_type, payment_group, segment_id)),
      q AS (SELECT *, last + row_number() OVER (PARTITION BY {CELLS} ORDER BY segment_id) AS new FROM d WHERE {fits}),
      inside AS (SELECT op.* FROM op JOIN q USING (job_type, payment_group, segment_id)),
      nm AS ({names_sql('inside', CELLS + ', segment_id, part')}),
      z AS (SELECT s.job_type, s.payment_group, CASE WHEN s.segment_id = -1 THEN -1 WHEN q.new IS NOT NULL AND {part} THEN q.new ELSE s.segment_id END AS id,
        CASE WHEN q.new IS NULL THEN s.segment_key WHEN {part} THEN nm.{name_b} ELSE nm.plain END AS segment_key
        FROM src s LEFT JOIN q ON q.job_type = s.job_type AND q.payment_group = s.payment_group AND q.segment_id = s.segment_id
        LEFT JOIN nm ON nm.job_type = s.job_type AND nm.payment_group = s.payment_group AND nm.segment_id = s.segment_id AND nm.part = ({part}))
      SELECT {CELLS}, CASE WHEN id = -1 THEN -1 ELSE CAST(dense_rank() OVER (PARTITION BY {CELLS}, id = -1 ORDER BY id) - 1 AS INT) END AS segment_id, segment_key, count(*) AS n
      FROM z GROUP BY {CELLS}, id, segment_key"""


SMALL_SPLIT = SegmentConfig(split_min_segment=300)


@query(
    "split_by_place",
    split_sql("SELECT * FROM v_assigned", f"place = '{M}'", f"n >= 300 AND n_b / n >= 0.25 AND n_b >= 30 AND dom_place <> '{HYBRID}'", "no_place"),
    ASSIGNED,
)
def split_by_place(spark, sf):
    return sizes(MG.split_by_place(V.assigned(spark, sf), SMALL_SPLIT)[0])


TOPICS = """SELECT * REPLACE (CASE topic WHEN '1-URGENT' THEN '스냅' ELSE topic END AS topic, CASE WHEN purpose IN ('MEDIUM', 'STANDARD') THEN '포트폴리오' ELSE purpose END AS purpose,
  CASE WHEN raw_cluster_id = -1 THEN -1 ELSE ascii(topic) % 7 END AS segment_id,
  CASE WHEN raw_cluster_id = -1 THEN '정보 부족형' ELSE 'seg' || (ascii(topic) % 7) END AS segment_key) FROM v_assigned"""


def topic_segments(spark, sf):
    rows = V.assigned(spark, sf)
    poor, number = F.col("raw_cluster_id") == -1, F.ascii("topic") % 7
    return rows.withColumns(
        {
            "segment_id": F.when(poor, -1).otherwise(number).cast("int"),
            "segment_key": F.when(poor, "정보 부족형").otherwise(F.concat(F.lit("seg"), number)),
            "purpose": F.when(F.col("purpose").isin("MEDIUM", "STANDARD"), "포트폴리오").otherwise(F.col("purpose")),
            "topic": F.when(F.col("topic") == "1-URGENT", "스냅").otherwise(F.col("topic")),
        }
    )


@query(
    "split_by_purpose",
    split_sql(TOPICS, "purpose <> '포트폴리오'", "n >= 300 AND n_a / n >= 0.25 AND n_a >= 30 AND n_b >= 30 AND dom_purpose <> '포트폴리오' AND dom_topic = '스냅'", "plain"),
    ASSIGNED,
)
def split_by_purpose(spark, sf):
    return sizes(MG.split_by_purpose(topic_segments(spark, sf), SMALL_SPLIT)[0])


PLACE_PART, PLACE_FITS = f"place = '{M}'", f"n >= 300 AND n_b / n >= 0.25 AND n_b >= 30 AND dom_place <> '{HYBRID}'"


@query(
    "split_log",
    f"""WITH op AS (SELECT *, {PLACE_PART} AS part FROM v_assigned WHERE segment_id <> -1),
      c AS (SELECT {CELLS}, segment_id, count(*) FILTER (part) AS n_b, count(*) FILTER (NOT part) AS n_a, min(segment_key) AS original_name FROM op GROUP BY ALL),
      q AS (SELECT * FROM ({dominant_sql("op", CELLS + ", segment_id", ("purpose", "place", "topic"))}) JOIN c USING (job_type, payment_group, segment_id) WHERE {PLACE_FITS}),
      inside AS (SELECT op.* FROM op JOIN q USING (job_type, payment_group, segment_id)),
      nm AS ({names_sql('inside', CELLS + ', segment_id, part')})
      SELECT {CELLS}, original_name, q.n AS total, coalesce(max(plain) FILTER (NOT part), '기타') AS name_a, n_a, max(no_place) FILTER (part) AS name_b, n_b
      FROM q JOIN nm USING (job_type, payment_group, segment_id) GROUP BY {CELLS}, segment_id, original_name, q.n, n_a, n_b""",
    ASSIGNED,
)
def split_log(spark, sf):
    """What the place split did, one row per split segment."""
    return MG.split_by_place(V.assigned(spark, sf), SMALL_SPLIT)[1]


OPERATIONAL = "(SELECT * FROM v_assigned WHERE segment_id <> -1)"


@query(
    "renamed_segments",
    f"SELECT {CELLS}, segment_id, plain AS segment_key, n FROM ({names_sql(OPERATIONAL, CELLS + ', segment_id')}) UNION ALL "
    f"SELECT {CELLS}, -1, '정보 부족형', count(*) FROM v_assigned WHERE segment_id = -1 GROUP BY ALL",
    ASSIGNED,
)
def renamed_segments(spark, sf):
    return sizes(MG.rename_segments(V.assigned(spark, sf)))


EVERYTHING = SegmentConfig(absorb_ambiguous=True, place_split=True, purpose_split=True, rename=True, split_min_segment=300)


def ambiguous_ctes(src, out):
    """`out`: the rows of `src` after vague segments have become info-poor."""
    doms = dominant_sql(f"(SELECT * FROM {src} WHERE segment_id <> -1)", CELLS + ", segment_id", ("purpose", "place"))
    return f"""{out}_d AS (SELECT *, dom_purpose IN ('{HYBRID}', '{M}') AND dom_place IN ('{HYBRID}', '{M}') AS vague FROM ({doms})),
      {out}_r AS (SELECT {CELLS}, segment_id, vague, CASE WHEN vague THEN -1 WHEN bool_or(vague) OVER (PARTITION BY {CELLS})
        THEN row_number() OVER (PARTITION BY {CELLS}, vague ORDER BY segment_id) - 1 ELSE segment_id END AS new FROM {out}_d),
      {out} AS MATERIALIZED (SELECT s.* REPLACE (CAST(coalesce(r.new, s.segment_id) AS INT) AS segment_id, CASE WHEN r.vague THEN '정보 부족형' ELSE s.segment_key END AS segment_key)
        FROM {src} s LEFT JOIN {out}_r r ON r.job_type = s.job_type AND r.payment_group = s.payment_group AND r.segment_id = s.segment_id)"""


def split_ctes(src, out, part, fits, name_b):
    """`out`: the rows of `src` after a split (see `split_sql`)."""
    doms = dominant_sql(f"{out}_op", CELLS + ", segment_id", ("purpose", "place", "topic"))
    return f"""{out}_op AS (SELECT *, {part} AS part FROM {src} WHERE segment_id <> -1),
      {out}_c AS (SELECT {CELLS}, segment_id, count(*) FILTER (part) AS n_b, count(*) FILTER (NOT part) AS n_a FROM {out}_op GROUP BY ALL),
      {out}_d AS (SELECT *, max(segment_id) OVER (PARTITION BY {CELLS}) AS last FROM ({doms}) JOIN {out}_c USING (job_type, payment_group, segment_id)),
      {out}_q AS (SELECT *, last + row_number() OVER (PARTITION BY {CELLS} ORDER BY segment_id) AS new FROM {out}_d WHERE {fits}),
      {out}_inside AS (SELECT o.* FROM {out}_op o JOIN {out}_q USING (job_type, payment_group, segment_id)),
      {out}_nm AS ({names_sql(out + '_inside', CELLS + ', segment_id, part')}),
      {out}_z AS (SELECT s.* REPLACE (CASE WHEN s.segment_id = -1 THEN -1 WHEN q.new IS NOT NULL AND {part} THEN q.new ELSE s.segment_id END AS segment_id,
        CASE WHEN q.new IS NULL THEN s.segment_key WHEN {part} THEN nm.{name_b} ELSE nm.plain END AS segment_key)
        FROM {src} s LEFT JOIN {out}_q q ON q.job_type = s.job_type AND q.payment_group = s.payment_group AND q.segment_id = s.segment_id
        LEFT JOIN {out}_nm nm ON nm.job_type = s.job_type AND nm.payment_group = s.payment_group AND nm.segment_id = s.segment_id AND nm.part = ({part})),
      {out} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN segment_id = -1 THEN -1 ELSE CAST(dense_rank() OVER (PARTITION BY {CELLS}, segment_id = -1 ORDER BY segment_id) - 1 AS INT) END AS segment_id) FROM {out}_z)"""


PURPOSE_PART = "purpose <> '포트폴리오'"
PURPOSE_FITS = "n >= 300 AND n_a / n >= 0.25 AND n_a >= 30 AND n_b >= 30 AND dom_purpose <> '포트폴리오' AND dom_topic = '스냅'"


def postprocessed_sql(base):
    return f"""WITH base AS MATERIALIZED ({base}), {ambiguous_ctes('base', 'one')}, {split_ctes('one', 'two', PLACE_PART, PLACE_FITS, 'no_place')},
      {split_ctes('two', 'three', PURPOSE_PART, PURPOSE_FITS, 'plain')},
      cur AS (SELECT {CELLS}, segment_id, min(segment_key) AS current FROM three WHERE segment_id <> -1 GROUP BY ALL),
      names AS ({names_sql('(SELECT * FROM three WHERE segment_id <> -1)', CELLS + ', segment_id')}),
      final AS (SELECT {CELLS}, segment_id, CASE WHEN current LIKE '%·장소미기재' THEN no_place ELSE plain END AS name FROM names JOIN cur USING (job_type, payment_group, segment_id))
      SELECT t.job_type, t.payment_group, t.segment_id, coalesce(f.name, t.segment_key) AS segment_key, count(*) AS n
      FROM three t LEFT JOIN final f ON f.job_type = t.job_type AND f.payment_group = t.payment_group AND f.segment_id = t.segment_id GROUP BY ALL"""


@query("postprocessed_segments", postprocessed_sql(TOPICS), ASSIGNED)
def postprocessed_segments(spark, sf):
    """All optional steps one after the other."""
    return sizes(MG.postprocess(topic_segments(spark, sf), EVERYTHING)[0])


SNAPS = """SELECT * REPLACE (CASE WHEN segment_id % 2 = 0 THEN '스냅' ELSE topic END AS topic, CASE WHEN purpose IN ('MEDIUM', 'STANDARD') THEN '포트폴리오' ELSE purpose END AS purpose,
  CASE WHEN segment_id % 2 = 0 AND place = 'R' THEN 'A' ELSE place END AS place) FROM v_assigned"""


@query("postprocessed_assignment", postprocessed_sql(SNAPS), ASSIGNED)
def postprocessed_assignment(spark, sf):
    """The same on the assigned segments, half of them with one topic: some are absorbed, some split."""
    snap = F.col("segment_id") % 2 == 0
    rows = V.assigned(spark, sf).withColumns(
        {
            "topic": F.when(snap, F.lit("스냅")).otherwise(F.col("topic")),
            "purpose": F.when(F.col("purpose").isin("MEDIUM", "STANDARD"), "포트폴리오").otherwise(F.col("purpose")),
            "place": F.when(snap & (F.col("place") == "R"), "A").otherwise(F.col("place")),
        }
    )
    return sizes(MG.postprocess(rows, EVERYTHING)[0])


@query("segment_catalogue")
def segment_catalogue(spark, sf):
    """The catalogue build over all cells: rows per segment."""
    return sizes(SG.build_catalogue(V.cells(spark, sf), TUNED_CONFIG).rows)


@query("catalogue_cells")
def catalogue_cells(spark, sf):
    """The per-cell figures of the build with coarse merging and all optional steps."""
    config = replace(EVERYTHING, coarse_merge=True)
    return SG.build_catalogue(V.cells(spark, sf), config).cells.withColumns({c: F.col(c).cast("int") for c in ("single_segment", "k_capped")})


VARIANTS = {
    **WEIGHT_VARIANTS,
    **DENSITY_VARIANTS,
    **EXTENDED_VARIANTS,
    "default": DEFAULT_CONFIG,
    "tuned": TUNED_CONFIG,
    "coarse": COARSE_CONFIG,
    "place_split": replace(TUNED_CONFIG, place_split=True),
    "v10_with_split": replace(EXTENDED_VARIANTS["v10_dense_split"], place_split=True),
}


@query("variant_grid")
def variant_grid(spark, sf):
    """Figures of all sets of variants and which of them is the purest."""
    grid = SG.variant_grid(V.cells(spark, sf), VARIANTS)
    best = SG.best_variant(grid).withColumnRenamed("variant", "best").drop("purity")
    return beside(grid, best).withColumn("purity", F.round("purity", 6))


def _variant_k_sql(config):
    whens = " ".join(
        f"WHEN '{c}' THEN greatest(1, round_even({k} * {float(config.cell_raw_k_scale.get(c, config.raw_k_scale))}::DOUBLE, 0))" for c, k in config.raw_k.items()
    )
    return f"least(CASE job_type || '_' || payment_group {whens} ELSE 1 END, n)"


@query(
    "variant_clusters",
    f"""WITH r AS (SELECT * FROM v_cells WHERE job_type || '_' || payment_group <> '{SINGLE_SEGMENT_CELL}' AND ({' OR '.join(f"trim({a}) <> '{M}'" for a in DENSITY_AXES)})),
        p AS (SELECT {CELLS}, count(*) AS p FROM (SELECT DISTINCT {CELLS}, {', '.join(DENSITY_AXES)} FROM r) GROUP BY ALL),
        k AS (SELECT {CELLS}, count(*) AS n FROM r GROUP BY {CELLS}),
        v AS ({' UNION ALL '.join(f"SELECT '{name}' AS variant, {CELLS}, n, {_variant_k_sql(c)} AS k FROM k" for name, c in VARIANTS.items())})
        SELECT variant, {CELLS}, n, CAST(least(k, p) AS BIGINT) AS n_raw, k > p AS capped FROM v JOIN p USING (job_type, payment_group)""",
    ("v_cells",),
)
def variant_clusters(spark, sf):
    """Rows and raw clusters per cell of each variant's build, and whether the profiles cap their number."""
    final = SG.variant_segments(SG.catalogue_table(V.cells(spark, sf)), VARIANTS)
    usable = final.filter((F.col("raw_cluster_id") >= 0) & (cell_slug() != SINGLE_SEGMENT_CELL))
    found = usable.groupBy("variant", *CELL).agg(
        F.sum("n").alias("n"), F.countDistinct("raw_cluster_id").alias("n_raw"), F.countDistinct(*DENSITY_AXES).alias("_p")
    )
    target = SG.per_variant(VARIANTS, lambda c: target_raw_k(cell_slug(), F.col("n"), c))
    return found.withColumn("capped", target > F.col("_p")).drop("_p")


