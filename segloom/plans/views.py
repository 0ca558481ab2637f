"""Views of the test tables that feed the operators, in Spark and as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segloom.config import MISSING
from segloom.runtime import spread

CATEGORY_NAMES = ("헤어", "스튜디오", "프로필", "패션", "뷰티", "일상", "인물스냅", "웨딩", "여행", "커플", "우정", "한복")
MARKED_ENDS = (
    " 야외 촬영",
    " 스튜디오 실내 촬영",
    " 포폴 작업물",
    " 인물 스냅",
    " 레이어드컷 염색",
    " Before After",
    " 야외 스튜디오",
    " 룩북 화보",
    " 홈스냅 집에서",
    " 신부 예복",
    "",
)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pick(key, values, default):
    out = F.lit(default)
    for i, value in reversed(list(enumerate(values))):
        out = F.when(key == i, F.lit(value)).otherwise(out)
    return out


# A line's id: 60 bits of these fields' digest, so that keys of any size keep apart.
LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """V1: one profile row per line item."""
    fields = F.concat_ws("-", *[F.col(c).cast("string") for c in LINE_KEY])
    # Lines are many: they carry only what comes of them, and meet two tables, the orders (with all that belongs to them) and the parts.
    line = table(spark, sf, "lineitem").select(
        F.conv(F.substring(F.md5(fields), 1, 15), 16, 10).cast("long").alias("posting_id"),
        "l_orderkey",
        "l_partkey",
        F.when(F.col("l_returnflag") == "N", MISSING).otherwise(F.col("l_returnflag")).alias("place"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_quantity") > 5), "once").otherwise(MISSING).alias("continuity"),
    )
    nation = table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf, "region")
    customer = (
        table(spark, sf, "customer")
        .select("c_custkey", "c_nationkey", "c_mktsegment")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    order = (
        table(spark, sf, "orders")
        .select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
    )
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    kind = F.col("p_type")
    return (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "posting_id",
            "l_orderkey",
            "l_partkey",
            F.when(F.col("c_mktsegment") == "BUILDING", "model")
            .when(F.col("c_mktsegment") == "AUTOMOBILE", "beauty")
            .when(F.col("c_mktsegment") == "MACHINERY", "photo")
            .otherwise("")
            .alias("job_type"),
            F.when(F.col("o_orderstatus") == "F", "n2")
            .when(F.col("o_orderstatus") == "O", "n3")
            .otherwise("pay")
            .alias("payment_group"),
            "place",
            F.when(kind == "PROMO", MISSING).otherwise(kind).alias("purpose"),
            F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", MISSING)
            .otherwise(F.col("o_orderpriority"))
            .alias("topic"),
            F.when(F.col("n_regionkey") == 0, MISSING).otherwise(F.col("r_name")).alias("treatment"),
            F.when(F.col("p_size") <= 38, "any")
            .when(F.col("p_size") <= 45, MISSING)
            .otherwise("senior")
            .alias("career"),
            "continuity",
            F.when(kind == "MEDIUM", 0)
            .when(kind == "STANDARD", 1)
            .when(kind == "LARGE", 2)
            .when(kind == "PROMO", 3)
            .when(kind == "SMALL", 4)
            .otherwise(5)
            .alias("type_code"),
        )
    )


def cells(spark: SparkSession, sf: str) -> DataFrame:
    """V1 rows of the nine cells."""
    return lines(spark, sf).filter("job_type <> ''")


def labeled(spark: SparkSession, sf: str) -> DataFrame:
    """V1b: cell rows with a noisy cluster label."""
    code = F.col("type_code")
    return cells(spark, sf).withColumn(
        "raw_cluster_id",
        F.when(F.col("l_orderkey") % 50 == 0, -1)
        .when((F.col("l_orderkey") + F.col("l_partkey")) % 6 == 0, (code + 1) % 6)
        .otherwise(code),
    )


def assigned(spark: SparkSession, sf: str) -> DataFrame:
    """V1b as an assignment: the label is the segment id, the key names its kind."""
    return labeled(spark, sf).select(
        "*",
        F.col("raw_cluster_id").alias("segment_id"),
        F.when(F.col("raw_cluster_id") == -1, "정보 부족형")
        .otherwise(F.concat(F.lit("seg"), F.col("raw_cluster_id").cast("string")))
        .alias("segment_key"),
    )


def second_assignment(spark: SparkSession, sf: str) -> DataFrame:
    """V1c: the labels of two runs."""
    first = F.col("raw_cluster_id")
    key = F.col("l_partkey") % 10
    return labeled(spark, sf).select(
        "posting_id",
        first.alias("a_id"),
        F.when(key == 0, -1).when(key == 1, (F.col("type_code") + 2) % 6).otherwise(first).alias("b_id"),
    )


def postings(spark: SparkSession, sf: str) -> DataFrame:
    """V2: text postings with flags, dates, NULL payments and padded types."""
    key = F.col("doc_id")
    return table(spark, sf, "documents").select(
        key.alias("id"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.col("text").alias("content"),
        F.when(key % 4 == 0, "model").when(key % 4 == 1, " Beauty ").when(key % 4 == 2, "photo").otherwise("other").alias("job_type"),
        F.when(key % 5 == 0, -2).when(key % 5 == 1, -3).when(key % 5 == 2, F.lit(None).cast("int")).otherwise(100).alias("payment"),
        F.date_add(F.lit("2025-06-01").cast("date"), (key % 120).cast("int")).alias("created_at"),
        F.when(key % 17 == 0, 1).otherwise(0).alias("is_deleted"),
        F.when(key % 13 == 0, 1).otherwise(0).alias("is_expired"),
        "lang",
        "source",
    )


def categories(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")
    return (
        table(spark, sf, "part")
        .select("p_size")
        .distinct()
        .select(size.alias("category_id"), _pick(size % 12, CATEGORY_NAMES[:11], CATEGORY_NAMES[11]).alias("name"))
    )


def line_categories(spark: SparkSession, sf: str) -> DataFrame:
    """The category of each line; the lines of a posting are together, in parts of a bounded number of lines."""
    line = table(spark, sf, "lineitem")
    rows = line.join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select(F.col("l_orderkey").alias("job_posting_id"), F.col("p_size").alias("category_id"))
    return spread(rows, line.count(), "job_posting_id")  # the count comes from the files' footers


def posting_categories(spark: SparkSession, sf: str) -> DataFrame:
    return line_categories(spark, sf).distinct()


def rule_text(spark: SparkSession, sf: str) -> DataFrame:
    """V4: whole texts with a marker at the end, categories and partly missing axes."""
    key = F.col("doc_id")
    cats = [["헤어", "일상"], ["인물스냅"], ["프로필"], ["스튜디오", "헤어"], ["웨딩"], []]
    cat = F.lit(None).cast("array<string>")
    for i, names in reversed(list(enumerate(cats))):
        value = F.array(*[F.lit(n) for n in names]).cast("array<string>")
        cat = F.when(key % 6 == i, value).otherwise(cat)
    return table(spark, sf, "documents").select(
        key.alias("id"),
        F.when(key % 12 == 0, "펌").when(key % 12 == 1, "컷").otherwise(MISSING).alias("treatment"),
        F.when(key % 7 == 0, "웨딩").otherwise(MISSING).alias("topic"),
        F.when(key % 5 == 0, "포트폴리오").otherwise(MISSING).alias("purpose"),
        F.when(key % 9 == 0, "야외").otherwise(MISSING).alias("place"),
        cat.alias("categories"),
        F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
        F.concat(F.col("text"), _pick(key % 11, MARKED_ENDS[:10], MARKED_ENDS[10])).alias("content"),
    )


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """V5: raw responses, fenced, surrounded, bare and truncated."""
    key, props = F.col("event_id"), F.col("props")
    return table(spark, sf, "events").select(
        key.alias("id"),
        F.when(key % 4 == 0, F.concat(F.lit("```json\n"), props, F.lit("\n```")))
        .when(key % 4 == 1, F.concat(F.lit("answer: "), props, F.lit(" end")))
        .when(key % 4 == 2, props)
        .otherwise(F.substring(props, F.lit(1), F.length(props) - 1))
        .alias("raw_text"),
    )


def texts(spark: SparkSession, sf: str) -> DataFrame:
    """V6: texts with one of four classes."""
    return (
        table(spark, sf, "documents")
        .join(table(spark, sf, "labels"), "doc_id")
        .select(F.col("doc_id").alias("id"), "text", (F.col("quality") * 2 + F.col("toxic")).alias("y"), "lang")
    )


# --- the same views for the other engine -------------------------------------


def _sql_pick(expr: str, values, default: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {whens} ELSE '{default}' END"


VIEW_SQL = {
    "v_lines": f"""
SELECT ('0x' || substr(md5(concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_returnflag, l.l_linestatus)), 1, 15))::BIGINT AS posting_id, l.l_orderkey, l.l_partkey,
 CASE c.c_mktsegment WHEN 'BUILDING' THEN 'model' WHEN 'AUTOMOBILE' THEN 'beauty' WHEN 'MACHINERY' THEN 'photo' ELSE '' END AS job_type,
 CASE o.o_orderstatus WHEN 'F' THEN 'n2' WHEN 'O' THEN 'n3' ELSE 'pay' END AS payment_group,
 CASE l.l_returnflag WHEN 'N' THEN '{MISSING}' ELSE l.l_returnflag END AS place,
 CASE p.p_type WHEN 'PROMO' THEN '{MISSING}' ELSE p.p_type END AS purpose,
 CASE o.o_orderpriority WHEN '4-NOT SPECIFIED' THEN '{MISSING}' ELSE o.o_orderpriority END AS topic,
 CASE WHEN n.n_regionkey = 0 THEN '{MISSING}' ELSE r.r_name END AS treatment,
 CASE WHEN p.p_size <= 38 THEN 'any' WHEN p.p_size <= 45 THEN '{MISSING}' ELSE 'senior' END AS career,
 CASE WHEN l.l_linestatus = 'O' AND l.l_quantity > 5 THEN 'once' ELSE '{MISSING}' END AS continuity,
 CASE p.p_type WHEN 'MEDIUM' THEN 0 WHEN 'STANDARD' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'PROMO' THEN 3 WHEN 'SMALL' THEN 4 ELSE 5 END AS type_code
FROM lineitem l JOIN orders o ON l.l_orderkey=o.o_orderkey JOIN customer c ON o.o_custkey=c.c_custkey
 JOIN nation n ON c.c_nationkey=n.n_nationkey JOIN region r ON n.n_regionkey=r.r_regionkey JOIN part p ON l.l_partkey=p.p_partkey""",
    "v_cells": "SELECT * FROM v_lines WHERE job_type <> ''",
    "v_labeled": """
SELECT *, CASE WHEN l_orderkey % 50 = 0 THEN -1 WHEN (l_orderkey + l_partkey) % 6 = 0 THEN (type_code+1)%6 ELSE type_code END AS raw_cluster_id
FROM v_cells""",
    "v_assigned": """
SELECT *, raw_cluster_id AS segment_id,
 CASE WHEN raw_cluster_id = -1 THEN '정보 부족형' ELSE concat('seg', CAST(raw_cluster_id AS VARCHAR)) END AS segment_key FROM v_labeled""",
    "v_assign_b": """
SELECT posting_id, raw_cluster_id AS a_id, CASE WHEN l_partkey % 10 = 0 THEN -1 WHEN l_partkey % 10 = 1 THEN (type_code+2)%6 ELSE raw_cluster_id END AS b_id
FROM v_labeled""",
    "v_postings": """
SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, text AS content,
 CASE doc_id % 4 WHEN 0 THEN 'model' WHEN 1 THEN ' Beauty ' WHEN 2 THEN 'photo' ELSE 'other' END AS job_type,
 CASE doc_id % 5 WHEN 0 THEN -2 WHEN 1 THEN -3 WHEN 2 THEN CAST(NULL AS INT) ELSE 100 END AS payment,
 DATE '2025-06-01' + CAST(doc_id % 120 AS INT) AS created_at,
 CASE WHEN doc_id % 17 = 0 THEN 1 ELSE 0 END AS is_deleted, CASE WHEN doc_id % 13 = 0 THEN 1 ELSE 0 END AS is_expired, lang, source
FROM documents""",
    "v_categories": f"SELECT DISTINCT p_size AS category_id, {_sql_pick('p_size % 12', CATEGORY_NAMES[:11], CATEGORY_NAMES[11])} AS name FROM part",
    "v_posting_categories": "SELECT DISTINCT l_orderkey AS job_posting_id, p_size AS category_id FROM lineitem JOIN part ON l_partkey=p_partkey",
    "v_rule_text": f"""
SELECT doc_id AS id, CASE doc_id % 12 WHEN 0 THEN '펌' WHEN 1 THEN '컷' ELSE '{MISSING}' END AS treatment,
 CASE doc_id % 7 WHEN 0 THEN '웨딩' ELSE '{MISSING}' END AS topic, CASE doc_id % 5 WHEN 0 THEN '포트폴리오' ELSE '{MISSING}' END AS purpose,
 CASE doc_id % 9 WHEN 0 THEN '야외' ELSE '{MISSING}' END AS place,
 CASE doc_id % 6 WHEN 0 THEN ['헤어','일상'] WHEN 1 THEN ['인물스냅'] WHEN 2 THEN ['프로필'] WHEN 3 THEN ['스튜디오','헤어'] WHEN 4 THEN ['웨딩'] ELSE CAST([] AS VARCHAR[]) END AS cats,
 concat(split_part(text, chr(10), 1), ' ', text, {_sql_pick('doc_id % 11', MARKED_ENDS[:10], MARKED_ENDS[10])}) AS txt
FROM documents""",
    "v_responses": """
SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN concat('```json', chr(10), props, chr(10), '```') WHEN 1 THEN concat('answer: ', props, ' end')
 WHEN 2 THEN props ELSE substr(props,1,length(props)-1) END AS raw_text FROM events""",
    "v_texts": "SELECT d.doc_id AS id, text, quality*2+toxic AS y, lang FROM documents d JOIN labels USING (doc_id)",
}
NEEDS = {
    "v_cells": ["v_lines"],
    "v_labeled": ["v_cells"],
    "v_assigned": ["v_labeled"],
    "v_assign_b": ["v_labeled"],
}


def with_views(names: list[str], body: str) -> str:
    """`body` preceded by the views it uses (a body may open its own WITH list)."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    ctes = [f"{name} AS ({VIEW_SQL[name].strip()})" for name in ordered]
    body = body.strip()
    for opening in ("WITH RECURSIVE ", "WITH "):
        if body.upper().startswith(opening):
            return opening + ",\n".join([*ctes, body[len(opening) :]])
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body
