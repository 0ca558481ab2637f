"""Variants and tiers built as groups of one plan, against one build each."""

from dataclasses import replace

from pyspark.sql import functions as F

from segloom.config import CELL, COARSE_CONFIG, MISSING, TUNED_CONFIG, WEIGHT_VARIANTS, SegmentConfig
from segloom.functions.columns import job_type_norm, payment_group
from segloom.operators import rules as R
from segloom.operators import stats as S
from segloom.plans import segment as SG
from segloom.plans import views as V


def sizes(df, *by):
    return sorted(tuple(r) for r in df.groupBy(*by, *CELL, "segment_id", "segment_key").agg(F.sum("n").alias("n")).collect())


def test_variants_equal_single_builds(spark, sf):
    rows = V.cells(spark, sf)
    configs = {
        "flat": WEIGHT_VARIANTS["v1_w1111_3axis"],
        "tuned": TUNED_CONFIG,
        "coarse": replace(COARSE_CONFIG, dominant_threshold=0.5),
        "split": replace(TUNED_CONFIG, place_split=True, split_min_segment=60, split_part_min_size=10, min_segment_size=40),
    }
    table = SG.catalogue_table(rows)
    got = sizes(SG.variant_segments(table, configs), "variant")
    for name, config in configs.items():
        assert [r[1:] for r in got if r[0] == name] == sizes(SG.build_catalogue(rows, config).table)


def test_tiers_equal_single_builds(spark, sf):
    cells = V.postings(spark, sf).select("id", job_type_norm("job_type").alias("job_type"), payment_group("payment").alias("payment_group"))
    rows = V.rule_text(spark, sf).join(cells, "id").withColumns({"career": F.lit(MISSING), "continuity": F.lit(MISSING)})
    grid = {r.tier: r for r in SG.tier_grid(rows).collect()}
    assert set(grid) == set(R.TIERS)
    for tier in ("full", R.DEFAULT_TIER):
        final = SG.build_catalogue(R.apply_rules(rows, tier=tier), SegmentConfig()).table
        want = S.catalogue_metrics(S.segment_table(final, weight="n")).first()
        assert (want.n_segments, want.n_poor, want.focus_max) == (grid[tier].n_segments, grid[tier].n_poor_after, grid[tier].focus_max)


def test_texts_are_scanned_once(spark, sf):
    """The text rules stand once in the plan of all tiers' rows."""
    cells = V.rule_text(spark, sf).withColumns({"career": F.lit(MISSING), "continuity": F.lit(MISSING)})
    plan = R.tier_rows(cells, R.TIERS, ["place", "purpose", "topic", "treatment"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == cells._jdf.queryExecution().executedPlan().toString().count("Scan parquet")
