"""Report tables and nested views of a catalogue."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segloom.config import AXES, CELL, INFO_POOR_ID, KEY_AXES, MISSING, VERSION
from segloom.functions.columns import stripped
from segloom.functions.text import preview, text_or_empty
from segloom.operators.merge import cluster_info
from segloom.operators.quality import grade
from segloom.operators.ranking import top_n_per_group
from segloom.operators.stats import category_top, cell_summary, segment_sources, segment_table, value_counts


def post_texts(posts: DataFrame) -> DataFrame:
    """Stripped title and content, and both joined by a line break."""
    title, content = stripped(text_or_empty("title")), stripped(text_or_empty("content"))
    both = F.concat_ws("\n", F.nullif(title, F.lit("")), F.nullif(content, F.lit("")))
    return posts.withColumns({"title": title, "content": content, "text": both})


def segment_index(df: DataFrame, by: Iterable[str] = CELL) -> DataFrame:
    """Per segment: key, rows, share, grade, flags and merge key."""
    by = list(by)
    keys = cluster_info(df, "segment_id", by).select(
        *by, "segment_id", F.concat(F.lit("("), F.array_join("merge_key", ", "), F.lit(")")).alias("merge_key")
    )
    return grade(segment_table(df, by)).join(keys, [*by, "segment_id"], "left")


def segment_view(df: DataFrame, posts: DataFrame | None = None, cap: int = 30, key: str = "id") -> DataFrame:
    """One row per segment, with its cell and its first posts nested (texts, if `posts` has them).

    Only `cap` ids per segment survive the ranking; texts are joined to those. The levels above a
    segment (job type, payment group) stay columns, so no row grows with the number of segments.
    """
    index = segment_index(df)
    first = top_n_per_group(df.select(*CELL, "segment_id", key), [*CELL, "segment_id"], [key], cap)
    fields = [F.col(key).alias("id")]
    if posts is not None:
        first = first.join(post_texts(posts).select(key, "title", "content", "text", "categories"), key, "left")
        fields += [F.col(c) for c in ("title", "content", "text", "categories")]
    record = F.struct(F.col("rank"), F.struct(*fields).alias("post"))
    shown = first.groupBy(*CELL, "segment_id").agg(
        F.transform(F.sort_array(F.collect_list(record)), lambda x: x["post"]).alias("posts")
    )
    cells = index.groupBy(*CELL).agg(F.sum("n").alias("cell_count"))
    return index.join(shown, [*CELL, "segment_id"]).join(cells, [*CELL]).select(
        *CELL, F.concat_ws("_", "payment_group", "job_type").alias("cell_key"), "cell_count", F.lit(VERSION).alias("version"),
        "segment_id", "segment_key", "grade", "merge_key", F.col("n").alias("post_count"), F.size("posts").alias("posts_shown"), "posts",
    )


def segment_catalog(rows: DataFrame, by: Iterable[str] = CELL) -> DataFrame:
    """Flat catalogue of training rows: cell, segment, key, rows; cell totals."""
    from pyspark.sql import Window

    by = list(by)
    per = rows.filter(F.col("segment_id") != INFO_POOR_ID).groupBy(*by, "segment_id").agg(
        F.min("segment_key").alias("segment_key"), F.count("*").alias("n")
    )
    cell = Window.partitionBy(*by)
    return per.withColumns(
        {"n_train": F.sum("n").over(cell), "n_segments": F.count("*").over(cell), "version": F.lit(VERSION)}
    )


def catalog_document(catalog: DataFrame) -> DataFrame:
    """One nested row per cell: id -> (key, n)."""
    entry = F.struct(F.col("segment_id").cast("string"), F.struct("segment_key", "n"))
    return catalog.groupBy(F.concat_ws("_", "payment_group", "job_type").alias("cell"), "n_train", "n_segments", "version").agg(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("segments")
    )


def axis_distribution(df: DataFrame, by: Iterable[str], axes: Iterable[str] = KEY_AXES, top: int = 8, bold: float = 0.70) -> DataFrame:
    """Per group and axis: the top values, how many more exist, and the bold mark."""
    by, axes = list(by), list(axes)
    clean = df.withColumns({a: F.coalesce(F.col(a), F.lit(MISSING)) for a in axes})
    counts = value_counts(clean, by, axes)
    marked = (F.col("rank") == 1) & (F.col("value") != MISSING) & (F.col("share") >= bold)
    pct = F.format_number(F.col("share") * 100, 1)
    text = F.concat(F.col("value"), F.lit(": "), pct, F.lit("%"))
    line = F.when(marked, F.concat(F.lit("**"), text, F.lit("**"))).otherwise(text)
    kept = F.when(F.col("rank") <= top, F.struct("rank", line.alias("line")))
    more = F.greatest(F.count("*") - top, F.lit(0))
    out = counts.groupBy(*by, "axis").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(kept)), lambda x: x["line"]), ", ").alias("shown"),
        more.alias("n_more"),
        F.max(marked).alias("has_bold"),
    )
    return out.withColumn(
        "shown", F.when(F.col("n_more") > 0, F.concat("shown", F.lit(", … (외 "), F.col("n_more"), F.lit("값)"))).otherwise(F.col("shown"))
    )


def report_lines(df: DataFrame) -> DataFrame:
    """The text report as ordered lines: cell headers, segments, sources, distributions."""
    cells = cell_summary(df).select(
        *CELL, F.lit(-2).alias("segment_id"), F.lit(0).alias("part"), F.lit("").alias("item"),
        F.format_string("[%s x %s] rows %d, info-poor %d, raw %d, segments %d", "job_type", "payment_group", "n_rows", "n_poor", "n_raw", "n_segments").alias("line"),
    )
    segments = segment_table(df).select(
        *CELL, "segment_id", F.lit(1).alias("part"), F.lit("").alias("item"),
        F.format_string("segment %d %s: %d", "segment_id", "segment_key", "n").alias("line"),
    )
    pairs = F.array_join(F.transform("sources", lambda s: F.concat_ws(":", s["cluster"], s["n"])), ", ")
    sources = segment_sources(df).select(
        *CELL, "segment_id", F.lit(2).alias("part"), F.lit("").alias("item"), F.concat(F.lit("sources "), pairs).alias("line")
    )
    values = axis_distribution(df, [*CELL, "segment_id"], AXES).select(
        *CELL, "segment_id", F.lit(3).alias("part"), F.col("axis").alias("item"), F.concat_ws(" ", "axis", "shown").alias("line")
    )
    return cells.unionByName(segments).unionByName(sources).unionByName(values)


def write_report(df: DataFrame, path: str) -> None:
    """Sorted lines as a text dataset."""
    report_lines(df).orderBy(*CELL, "segment_id", "part", "item").select("line").write.mode("overwrite").text(path)


def segment_examples(df: DataFrame, texts: DataFrame, n: int = 3, key: str = "id", top: int = 8, chars: int = 100) -> DataFrame:
    """Per segment: index row, distribution lines, top categories (if present) and first n previews."""
    by = [*CELL, "segment_id"]
    lines = axis_distribution(df, by, KEY_AXES, top)
    shape = lines.groupBy(*by).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("axis", "shown")))).alias("distribution")
    )
    first = top_n_per_group(df.select(*by, key), by, [key], n)
    first = first.join(texts.select(key, preview("text", chars).alias("preview")), key, "left")
    examples = first.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("rank", F.col(key).alias("id"), "preview"))).alias("examples"))
    out = segment_index(df).join(shape, by).join(examples, by)
    if "categories" in df.columns:
        tops = category_top(df, by, 3)
        label = F.format_string("%s(%d, %s%%)", "category", "n", F.format_number("pct", 1))
        listed = tops.groupBy(*by).agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", label.alias("l")))), lambda x: x["l"]), ", ").alias("top_categories")
        )
        out = out.join(listed, by, "left").withColumn("top_categories", F.coalesce("top_categories", F.lit("-")))
    return out
