"""Text files with broken records: every line is either a row or a reject with a reason.

The reader keeps the text of a line that it cannot read whole
(``columnNameOfCorruptRecord``); the lines are scanned once, into a table of
rows and rejects, and a reject's text is read again on its own, as text
fields, to say what is wrong with it.  Rows and rejects together are the
lines of the files.

Cases: a field that does not parse, a missing field and a surplus field make
a reject; an empty field is null and makes none, unless the column is in
``required``; empty lines are no records; an empty file has neither rows nor
rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import numeric as N
from ledgerline.plans import sqltext as S
from ledgerline.plans.lineage import cut
from ledgerline.plans.registry import register
from ledgerline.sources.fact import order_lines
from ledgerline.sources.io import CSV_PROFILES, scratch_path

CORRUPT = "_corrupt_record"


def reason_of(line: str, schema: T.StructType, options: dict) -> Column:
    """What is wrong with a line that does not fit the schema."""
    texts = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema.fields], T.StructField(CORRUPT, T.StringType())])
    as_text = F.from_csv(F.col(line), texts.simpleString()[7:-1].replace(":", " "), {
        **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    one = lambda f: F.from_csv(F.col(line), ", ".join(
        f"{g.name} {g.dataType.simpleString() if g.name == f.name else 'string'}" for g in schema.fields), options)[f.name]
    reason = F.when(as_text[CORRUPT].isNotNull(), F.lit("number of fields"))
    for f in schema.fields:
        reason = reason.when(as_text[f.name].isNotNull() & one(f).isNull(), F.lit(f"bad {f.name}"))
    return reason.otherwise(F.lit("unreadable"))


def read_checked(spark: SparkSession, path: str, schema: T.StructType, profile: str = "fast",
                 required: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): the rows in the columns of ``schema``; line and reason of every other line."""
    options = {**CSV_PROFILES[profile], "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "enforceSchema": "true"}
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    read = spark.read.options(**options).schema(wide).csv(path)
    plain = {k: v for k, v in CSV_PROFILES[profile].items() if k in ("dateFormat", "quote", "escape")}
    reason = F.when(F.col(CORRUPT).isNotNull(), reason_of(CORRUPT, schema, plain))
    for c in required:
        reason = reason.when(F.col(c).isNull(), F.lit(f"no {c}"))
    text = F.coalesce(F.col(CORRUPT), F.to_csv(F.struct(*schema.names), plain))
    found = cut(read.withColumn("reject_reason", reason).withColumn("line", F.when(F.col("reject_reason").isNotNull(), text)), "checked")
    return found.where("reject_reason IS NULL").select(*schema.names), \
        found.where("reject_reason IS NOT NULL").select("line", "reject_reason")


def reject_counts(rows: DataFrame, rejects: DataFrame) -> DataFrame:
    """n per reason, and of the rows (reason null)."""
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n")).union(
        rows.agg(F.lit(None).cast("string").alias("reject_reason"), F.count(F.lit(1)).alias("n")))


# --------------------------------------------------------------- registered

SCHEMA = T.StructType([T.StructField("order_id", T.LongType()), T.StructField("order_date", T.DateType()),
                       T.StructField("sales", T.DoubleType()), T.StructField("quantity", T.IntegerType()),
                       T.StructField("market", T.StringType())])


def broken_file(spark, sf_dir) -> str:
    """The lines as text, some broken by a rule: a word for a quantity, a field too many or too few, a false date, no id."""
    df = order_lines(spark, sf_dir, ["order_id", "order_date", "sales", "quantity", "market"])
    i, q = F.col("order_id"), F.col("quantity")
    fields = [F.when(q == 9, F.lit("")).otherwise(i.cast("string")),
              F.when(i % 31 == 4, F.lit("2001-02-30x")).otherwise(F.date_format("order_date", "yyyy-MM-dd")),
              N.dbl("sales").cast("string"), F.when(i % 17 == 3, F.lit("many")).otherwise(q.cast("string")), F.col("market")]
    line = F.concat_ws(",", *fields)
    line = F.when(i % 23 == 5, F.concat(line, F.lit(",more"))).when(i % 29 == 7, F.substring_index(line, ",", 3)).otherwise(line)
    path = scratch_path(spark, "broken")
    df.select(line.alias("value")).write.text(path)
    return path


_REASON_SQL = """CASE WHEN order_id % 23 = 5 OR order_id % 29 = 7 THEN 'number of fields'
       WHEN order_id % 31 = 4 THEN 'bad order_date' WHEN order_id % 17 = 3 THEN 'bad quantity'
       WHEN quantity = 9 THEN 'no order_id' END"""


def _checked(spark, sf_dir):
    return read_checked(spark, broken_file(spark, sf_dir), SCHEMA, "headless", required=("order_id",))


@register("src_csv_rejects", sql=S.with_fact(f"""
SELECT {_REASON_SQL} AS reject_reason, COUNT(*) AS n FROM fact GROUP BY 1"""))
def _src_csv_rejects(spark, sf_dir):
    """Rows and rejects by reason: together all lines."""
    return reject_counts(*_checked(spark, sf_dir))


@register("src_csv_checked", sql=S.with_fact(f"""
SELECT order_id, order_date, CAST(sales AS DOUBLE) AS sales, quantity, market FROM fact WHERE ({_REASON_SQL}) IS NULL"""))
def _src_csv_checked(spark, sf_dir):
    """The rows that are left."""
    return _checked(spark, sf_dir)[0]
