"""Aggregates over attribute columns.

Every figure here is a function of the distinct attribute tuples and their
counts, so rows are first reduced with `compress` (one pass, combined in the
map tasks); all later steps work on that small table. A group that holds a
third of all rows therefore costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segloom.config import AXES, CELL, DENSITY_AXES, HYBRID, KEY_AXES, MISSING, UNCLEAR_LIMITS, Gates
from segloom.functions.columns import active, cell_slug
from segloom.functions.text import any_marker, full_text
from segloom.operators.rules import PERM, PERM_EVIDENCE


def compress(df: DataFrame, by: Iterable[str], axes: Iterable[str], weight: str | None = None) -> DataFrame:
    """Distinct (by, axes) tuples with their row count `n`."""
    names = list(dict.fromkeys([*by, *axes]))
    count = F.sum(weight) if weight else F.count("*")
    return df.groupBy(*names).agg(count.alias("n"))


def axis_counts(df: DataFrame, by: Iterable[str], axes: Iterable[str], weight: str | None = None) -> DataFrame:
    """Rows per (by, axis, value); NULL is a value of its own here."""
    by, axes = list(by), list(axes)
    small = compress(df, by, axes, weight)
    pairs = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).cast("string").alias("value")) for a in axes])
    return small.select(*by, "n", F.inline(pairs)).groupBy(*by, "axis", "value").agg(F.sum("n").alias("n"))


def value_counts(df: DataFrame, by: Iterable[str], axes: Iterable[str], top_n: int | None = None, weight: str | None = None) -> DataFrame:
    """Count, share of the group and rank of each value."""
    by = list(by)
    group = Window.partitionBy(*by, "axis")
    counts = axis_counts(df, by, axes, weight).withColumn("share", F.col("n") / F.sum("n").over(group))
    counts = counts.filter(F.col("value").isNotNull())
    ranked = counts.withColumn("rank", F.row_number().over(group.orderBy(F.desc("n"), "value")))
    return ranked.filter(F.col("rank") <= top_n) if top_n else ranked


def top_values(df: DataFrame, by: Iterable[str], axes: Iterable[str], weight: str | None = None) -> DataFrame:
    """Per (by, axis): rows `total`, the commonest value `top` and its count `top_n`.

    NULLs count towards the total only. Equal counts: the smallest value wins.
    """
    by = list(by)
    best = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("m"), F.col("value").alias("v"))))
    return (
        axis_counts(df, by, axes, weight)
        .groupBy(*by, "axis")
        .agg(F.sum("n").alias("total"), best.alias("_best"))
        .select(*by, "axis", "total", F.col("_best.v").alias("top"), F.coalesce(-F.col("_best.m"), F.lit(0)).alias("top_n"))
    )


def dominant_of(top: str, top_n: str, total: str, threshold: float = 0.70, missing_is_value: bool = False) -> Column:
    reached = F.col(top_n) / F.col(total) >= threshold
    value = F.when(reached, F.col(top)).otherwise(F.lit(HYBRID))
    if missing_is_value:
        return value
    return F.when(F.col(top).isNull() | (F.col(top) == MISSING), F.lit(MISSING)).otherwise(value)


def dominants(
    df: DataFrame,
    by: Iterable[str],
    axes: Iterable[str] = KEY_AXES,
    threshold: float = 0.70,
    missing_is_value: bool = False,
    weight: str | None = None,
) -> DataFrame:
    """Per group: rows `n` and one `dom_<axis>` column per axis."""
    by, axes = list(by), list(axes)
    tops = top_values(df, by, axes, weight).withColumn(
        "dom", dominant_of("top", "top_n", "total", threshold, missing_is_value)
    )
    wide = [F.max(F.when(F.col("axis") == a, F.col("dom"))).alias(f"dom_{a}") for a in axes]
    return tops.groupBy(*by).agg(F.max("total").alias("n"), *wide)


def unclear_stats(
    df: DataFrame,
    axes: Iterable[str],
    by: str = "job_type",
    defined: Mapping[str, Iterable[str]] | None = None,
    flag_pct: float = 30.0,
) -> DataFrame:
    """Missing share per attribute, overall (`by` NULL) and per type.

    `defined` limits an attribute to the types whose schema has it.
    """
    axes = list(axes)
    counts = axis_counts(df, [by], axes)
    if defined:
        allowed = F.lit(False)
        for axis in axes:
            here = F.col("axis") == axis
            allowed = allowed | (here & F.col(by).isin(*defined[axis]) if axis in defined else here)
        counts = counts.filter(allowed)
    missing = F.sum(F.when(F.col("value") == MISSING, F.col("n")).otherwise(0))
    out = counts.groupingSets([[F.col("axis")], [F.col("axis"), F.col(by)]], "axis", by).agg(
        missing.alias("n_missing"), F.sum("n").alias("n_rows"), F.grouping(by).cast("int").alias("overall")
    )
    pct = F.col("n_missing") * 100.0 / F.col("n_rows")
    return out.withColumns({"missing_pct": pct, "flagged": pct >= flag_pct})


def unclear_limits(df: DataFrame, axes: Iterable[str] = AXES, limits: Mapping[str, float] = UNCLEAR_LIMITS) -> DataFrame:
    """Missing share per axis against its own ceiling."""
    ceiling = F.lit(None).cast("double")
    for axis, limit in limits.items():
        ceiling = F.when(F.col("axis") == axis, F.lit(limit * 100.0)).otherwise(ceiling)
    counts = axis_counts(df, [], axes).groupBy("axis").agg(
        F.sum(F.when(F.col("value") == MISSING, F.col("n")).otherwise(0)).alias("n_missing"), F.sum("n").alias("n_rows")
    )
    pct = F.col("n_missing") * 100.0 / F.col("n_rows")
    return counts.withColumns({"missing_pct": pct, "limit_pct": ceiling, "over_limit": pct >= ceiling})


def hallucination_stats(
    attributes: DataFrame, texts: DataFrame, key: str = "id", value: str = PERM, evidence: Iterable[str] = PERM_EVIDENCE
) -> DataFrame:
    """Rows with the value, and those of them without evidence (no text: no evidence)."""
    wanted = attributes.filter(F.col("treatment") == value).select(key)
    found = texts.select(key, any_marker(full_text("title", "content"), evidence).alias("_found"))
    return wanted.join(found, key, "left").agg(
        F.count("*").alias("n_value"), F.count_if(~F.coalesce("_found", F.lit(False))).alias("n_without_evidence")
    )


def compare_runs(runs: Mapping[str, DataFrame], axes: Iterable[str] = AXES, limits: Mapping[str, float] = UNCLEAR_LIMITS) -> DataFrame:
    """Missing share per axis, one column per run, and whether the last run meets its ceiling."""
    names = list(runs)
    parts = [unclear_limits(df, axes, limits).withColumn("run", F.lit(name)) for name, df in runs.items()]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    wide = rows.groupBy("axis", "limit_pct").pivot("run", names).agg(F.first("missing_pct"))
    return wide.select(
        "axis", "limit_pct", *[F.col(n).alias(f"pct_{n}") for n in names], (F.col(names[-1]) < F.col("limit_pct")).alias("passed")
    )


def parse_success(df: DataFrame, by: str = "job_type", ok: str = "ok", kind: str | None = None) -> DataFrame:
    """Success counts per type and overall (`by` NULL); with `kind`, also per kind of post (each type's and all)."""
    good = F.coalesce(F.col(ok), F.lit(False))
    keys = [by, kind] if kind else [by]
    out = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(good).alias("n_ok"))
    sets = [[F.col(by)], []] + ([[F.col(by), F.col(kind)], [F.col(kind)]] if kind else [])
    level = [F.grouping_id().alias("level")] if kind else []  # tells a total from a kind that is NULL
    out = out.groupingSets(sets, *keys).agg(F.sum("n").alias("n_rows"), F.sum("n_ok").alias("n_ok"), *level)
    return out.withColumns(
        {"n_fail": F.col("n_rows") - F.col("n_ok"), "ok_pct": F.col("n_ok") * 100.0 / F.col("n_rows")}
    )


def segment_table(
    df: DataFrame, by: Iterable[str] = CELL, segment: str = "segment_id", axes: Iterable[str] = DENSITY_AXES, weight: str | None = None
) -> DataFrame:
    """Per cell and segment: key, rows, share of the cell's operational rows, top shares.

    Info-poor rows (-1) are listed too; their share also uses the operational total.
    """
    by, axes = list(by), list(axes)
    tops = top_values(df, [*by, segment], [*axes, "segment_key"], weight)
    shares = [F.max(F.when(F.col("axis") == a, F.col("top_n") / F.col("total"))).alias(f"{a}_top") for a in axes]
    key = F.max(F.when(F.col("axis") == "segment_key", F.col("top"))).alias("segment_key")
    rows = tops.groupBy(*by, segment).agg(F.max("total").alias("n"), key, *shares)
    cell_n = F.sum(F.when(F.col(segment) != -1, F.col("n")).otherwise(0)).over(Window.partitionBy(*by))
    return rows.withColumn("cell_n", cell_n).withColumn(
        "pct_cell", F.when(F.col("cell_n") > 0, F.col("n") * 100.0 / F.col("cell_n")).otherwise(F.lit(100.0))
    )


def segment_rows(df: DataFrame, digits: int | None = None, **kw) -> DataFrame:
    """`segment_table` without the info-poor rows, optionally rounded (1 and 3 digits)."""
    out = segment_table(df, **kw).filter(F.col(kw.get("segment", "segment_id")) != -1)
    if digits is None:
        return out
    return out.withColumns(
        {"pct_cell": F.round("pct_cell", 1), "purpose_top": F.round("purpose_top", digits), "place_top": F.round("place_top", digits)}
    )


def catalogue_metrics(
    segments: DataFrame, gates: Gates = Gates(), focus: str | None = None, focus_total: int | None = None,
    catch_cells: Iterable[str] | None = None, segment: str = "segment_id", by: Iterable[str] = (),
) -> DataFrame:
    """One row of catalogue figures from `segment_table`, or one per group of `by`.

    `focus_total` replaces the focus cell's operational row count as denominator.
    """
    from segloom.config import CATCH_ALL_CELLS, FOCUS_CELL

    focus = focus or FOCUS_CELL
    catch = list(catch_cells if catch_cells is not None else CATCH_ALL_CELLS)
    slug = cell_slug()
    op = F.col(segment) != -1
    per_cell = segments.groupBy(*by, slug.alias("slug")).agg(
        F.count_if(op).alias("segs"),
        F.sum(F.when(~op, F.col("n")).otherwise(0)).alias("poor"),
        F.count_if(op & (F.col("n") < gates.micro_n)).alias("micro"),
        F.max(F.when(op, F.round("pct_cell", 1))).alias("max_pct"),
        F.max(F.when(op, F.col("n"))).alias("max_n"),
        F.sum(F.when(op, F.col("n")).otherwise(0)).alias("op_n"),
    )
    here = F.col("slug") == focus
    out = per_cell.groupBy(*by).agg(
        F.sum("segs").alias("n_segments"),
        F.sum("poor").alias("n_poor"),
        F.sum("micro").alias("n_micro"),
        F.count_if(F.col("slug").isin(*catch) & (F.col("max_pct") > gates.catch_all_pct)).alias("catch_all_cells"),
        F.coalesce(F.max(F.when(here, F.col("max_n"))), F.lit(0)).alias("focus_max"),
        F.coalesce(F.max(F.when(here, F.col("op_n"))), F.lit(0)).alias("_total"),
        F.coalesce(F.max(F.when(here, F.col("segs"))), F.lit(0)).alias("focus_segments"),
    )
    total = F.lit(focus_total) if focus_total else F.col("_total")
    pct = F.when(total > 0, F.round(F.col("focus_max") * 100.0 / total, 1)).otherwise(F.lit(0.0))
    return out.withColumn("focus_max_pct", pct).drop("_total")


def cell_summary(df: DataFrame, raw: str = "raw_cluster_id", segment: str = "segment_id", by: Iterable[str] = CELL, weight: str | None = None) -> DataFrame:
    """Per cell: rows, info-poor rows, raw clusters, segments, segment size spread, single-segment flag."""
    by = list(by)
    small = compress(df, by, [raw, segment], weight)
    sizes = small.filter(F.col(segment) != -1).groupBy(*by, segment).agg(F.sum("n").alias("size"))
    spread = sizes.groupBy(*by).agg(
        F.count("*").alias("n_segments"),
        F.min("size").alias("min_size"),
        F.percentile("size", 0.5).alias("median_size"),
        F.max("size").alias("max_size"),
    )
    totals = small.groupBy(*by).agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col(segment) == -1, F.col("n")).otherwise(0)).alias("n_poor"),
        F.countDistinct(F.when(F.col(raw) != -1, F.col(raw))).alias("n_raw"),
    )
    return totals.join(spread, by, "left").withColumns(
        {"n_segments": F.coalesce("n_segments", F.lit(0)), "single_segment": F.coalesce(F.col("n_segments") == 1, F.lit(False))}
    )


def purity(df: DataFrame, axes: Iterable[str] = DENSITY_AXES, by: Iterable[str] = (*CELL, "segment_id"), segment: str = "segment_id", weight: str | None = None, over: Iterable[str] = ()) -> DataFrame:
    """Size-weighted mean over segments of the mean top share on the axes, per group of `over`.

    by=(segment_id,) pools equal ids of different cells.
    """
    axes, by = list(axes), [*over, *by]
    tops = top_values(df.filter(F.col(segment) != -1), by, axes, weight)
    per = tops.groupBy(*by).agg(F.max("total").alias("n"), (F.sum(F.col("top_n") / F.col("total")) / len(axes)).alias("p"))
    return per.groupBy(*over).agg(
        F.coalesce(F.sum(F.col("p") * F.col("n")) / F.sum("n"), F.lit(0.0)).alias("purity"), F.count("*").alias("n_segments")
    )


def assignment_stats(postings: DataFrame, version: str = "segment_version") -> DataFrame:
    """Per version and overall: rows, assigned, info-poor, unassigned, mean confidence (active rows)."""

    label = F.coalesce(F.col(version), F.lit("미배정(NULL version)"))
    per = postings.filter(active()).groupBy(label.alias("version")).agg(
        F.count("*").alias("n"),
        F.count("segment_id").alias("a"),
        F.count_if(F.col("segment_id") == -1).alias("p"),
        F.sum("segment_confidence").alias("c"),
        F.count("segment_confidence").alias("k"),
    )
    return per.groupingSets([[F.col("version")], []], "version").agg(
        F.sum("n").alias("n_rows"),
        F.sum("a").alias("n_assigned"),
        F.sum("p").alias("n_poor"),
        (F.sum("n") - F.sum("a")).alias("n_unassigned"),
        F.coalesce(F.sum("c") / F.nullif(F.sum("k"), F.lit(0)), F.lit(0.0)).alias("avg_confidence"),
    )


def cluster_profiles(df: DataFrame, label: str, domain: Mapping[str, list[str]], by: Iterable[str] = (), digits: int = 6) -> DataFrame:
    """Share of every domain value per cluster and axis, 0 when absent, with the dominant flag.

    The dominant value is the commonest, the first in domain order among equals.
    """
    by = [*by, label]
    axes = list(domain)
    counts = axis_counts(df, by, axes)
    sizes = counts.filter(F.col("axis") == axes[0]).groupBy(*by).agg(F.sum("n").alias("size"))
    listed = F.array(
        *[
            F.struct(F.lit(a).alias("axis"), F.lit(v).alias("value"), F.lit(i).alias("ord"))
            for a in axes
            for i, v in enumerate(domain[a])
        ]
    )
    grid = sizes.select(*by, "size", F.inline(listed))
    full = grid.join(counts, [*by, "axis", "value"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    full = full.withColumn("share", F.round(F.col("n") / F.col("size"), digits))
    order = Window.partitionBy(*by, "axis").orderBy(F.desc("share"), "ord")
    return full.withColumn("is_dominant", F.row_number().over(order) == 1)


def profile_documents(profiles: DataFrame, by: Iterable[str]) -> DataFrame:
    """Nested form of `cluster_profiles`: attribute shares and dominant values as maps."""
    by = list(by)
    per_axis = profiles.groupBy(*by, "size", "axis").agg(
        F.map_from_entries(
            F.transform(F.sort_array(F.collect_list(F.struct("ord", "value", "share"))), lambda x: F.struct(x["value"], x["share"]))
        ).alias("shares"),
        F.max(F.when(F.col("is_dominant"), F.col("value"))).alias("dominant"),
    )
    return per_axis.groupBy(*by, "size").agg(
        F.map_from_entries(F.collect_list(F.struct("axis", "shares"))).alias("attributes"),
        F.map_from_entries(F.collect_list(F.struct("axis", "dominant"))).alias("dominant_values"),
    )


def category_top(df: DataFrame, by: Iterable[str], n: int | None = None, categories: str = "categories") -> DataFrame:
    """Commonest categories per group with their count per 100 rows of the group."""
    by = list(by)
    # one marker per row carries the row count through the same aggregation
    marked = F.concat(F.array(F.lit(None).cast("string")), F.coalesce(F.col(categories), F.array().cast("array<string>")))
    counts = df.select(*by, F.explode(marked).alias("category")).groupBy(*by, "category").agg(F.count("*").alias("n"))
    group = Window.partitionBy(*by)
    rows = F.max(F.when(F.col("category").isNull(), F.col("n"))).over(group)
    counts = counts.withColumn("n_rows", rows).filter(F.col("category").isNotNull())
    ranked = counts.withColumns(
        {"pct": F.col("n") * 100.0 / F.col("n_rows"), "rank": F.row_number().over(group.orderBy(F.desc("n"), "category"))}
    )
    return ranked.filter(F.col("rank") <= n) if n else ranked


def suggest_label(
    df: DataFrame, by: Iterable[str], axes: Iterable[str] = KEY_AXES, min_ratio: float = 0.25, max_parts: int = 3,
    default: str = "(속성 혼재·불명확 다수)",
) -> DataFrame:
    """Per axis the commonest explicit value with enough share; distinct, joined by ' · '."""
    by, axes = list(by), list(axes)
    counts = value_counts(df, by, axes)
    place = F.lit(0)
    for i, axis in enumerate(axes):
        place = F.when(F.col("axis") == axis, i).otherwise(place)
    best = counts.groupBy(*by, place.alias("pos")).agg(
        F.min(F.when(F.col("value") != MISSING, F.struct((-F.col("n")).alias("m"), "value", "share"))).alias("b")
    )
    parts = F.transform(
        F.sort_array(F.collect_list(F.when(F.col("b.share") >= min_ratio, F.struct("pos", F.col("b.value").alias("value"))))),
        lambda x: x["value"],
    )
    name = F.array_join(F.slice(F.array_distinct(parts), 1, max_parts), " · ")
    labels = best.groupBy(*by).agg(name.alias("label"))
    return labels.withColumn("label", F.when(F.col("label") == "", F.lit(default)).otherwise(F.col("label")))


def segment_sources(df: DataFrame, by: Iterable[str] = CELL, segment: str = "segment_id", raw: str = "raw_cluster_id") -> DataFrame:
    """Per segment: key, rows and the (raw cluster, rows) pairs it consists of."""
    by = list(by)
    pairs = compress(df.filter(F.col(segment) != -1), by, [segment, "segment_key", raw])
    source = F.when(F.col(raw) != -1, F.struct(F.col(raw).alias("cluster"), F.col("n").alias("n")))
    return pairs.groupBy(*by, segment).agg(
        F.min("segment_key").alias("segment_key"),
        F.sum("n").alias("n"),
        F.sort_array(F.collect_list(source)).alias("sources"),
    )


def text_quality(df: DataFrame, by: str = "job_type", text: str = "text") -> DataFrame:
    """Rows, rows without text and text length figures per type."""
    length = F.length(F.coalesce(F.col(text), F.lit("")))
    return df.groupBy(by).agg(
        F.count("*").alias("n_rows"), F.count_if(length == 0).alias("n_empty"), F.max(length).alias("max_chars")
    )

