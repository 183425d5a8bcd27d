"""Delimited text and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from partload.functions import text
from partload.plans.inputs import table
from partload.sources import delimited, storage
from partload.spec import ErrorLimit


def _hostile(spark, sf_dir):
    """Documents with a carriage return, field delimiters, quotes, backslashes and outer blanks added."""
    documents = table(spark, sf_dir, "documents")
    hard = F.concat(
        F.lit(" \r\\\"\x1f\""), F.col("text"), F.lit("\\"), F.lit("\r\n"), F.col("source"), F.lit(" ")
    )
    lang = F.when(F.col("n_chars") < 500, F.lit("")).when(F.col("lang") != "en", F.col("lang"))
    return documents.select("doc_id", hard.alias("text"), lang.alias("lang"))


def delimited_roundtrip(spark, sf_dir):
    """Hostile text written as delimited files and read back; NULL and '' both come back NULL."""
    rows = _hostile(spark, sf_dir)
    path = storage.scratch_dir(spark) + "/documents"
    delimited.write_delimited(rows, path, max_records=50_000)
    back = delimited.read_delimited(spark, path, rows.schema)
    return back.select(
        "doc_id", F.length("text").alias("text_length"), F.md5("text").alias("text_md5"), "lang"
    )


def split_quoted_read(spark, sf_dir):
    """Hostile text in one file for each task that reads the documents, whose fields hold line breaks, read
    back by one task for each 256 KiB of a file."""
    rows = _hostile(spark, sf_dir)
    path = storage.scratch_dir(spark) + "/documents"
    delimited.write_delimited(rows, path)
    back = delimited.split_read(spark, path, rows.schema, split_bytes=1 << 18)
    return back.select(
        "doc_id", F.length("text").alias("text_length"), F.md5("text").alias("text_md5"), "lang"
    )


def delimited_keep_empty(spark, sf_dir):
    """The same round trip telling NULL and '' apart."""
    rows = _hostile(spark, sf_dir)
    path = storage.scratch_dir(spark) + "/documents"
    delimited.write_delimited(rows, path, max_records=50_000, keep_empty=True)
    back = delimited.read_delimited(spark, path, rows.schema, keep_empty=True)
    return back.groupBy("lang").agg(F.count(F.lit(1)).alias("row_count"))


def quote_fields(spark, sf_dir):
    """Quoted delimited lines built as a column."""
    documents = table(spark, sf_dir, "documents")
    line = text.quote_line(F.col("doc_id").cast("string"), F.col("lang"), F.col("text"))
    return documents.select("doc_id", F.md5(line).alias("line_md5"), F.length(line).alias("line_length"))


def empty_to_null(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    blanked = F.when(F.col("lang") == "en", F.lit("")).otherwise(F.col("lang"))
    return documents.select("doc_id", text.empty_to_null(blanked).alias("lang"))


def dirty_row_gate(spark, sf_dir):
    """Orders as text, prices of some statuses unreadable: counts and verdicts of three limits."""
    orders = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderstatus") == "P", F.lit("n/a")).otherwise(
        F.col("o_totalprice").cast("string")
    )
    lines = orders.select(
        F.col("o_orderkey").cast("string"), price.alias("o_totalprice"), "o_orderstatus"
    )
    path = storage.scratch_dir(spark) + "/orders"
    delimited.write_delimited(lines, path)
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderstatus", T.StringType()),
        ]
    )
    counts = storage.materialise(
        delimited.error_counts(delimited.read_with_errors(spark, path, schema)), "counts"
    )
    limits = {
        "none": ErrorLimit(),
        "half": ErrorLimit(record=None, percentage=0.5),
        "all": ErrorLimit(record=2**40),
    }
    out = None
    for name, limit in limits.items():
        row = delimited.gate(counts, limit).withColumn("limit_name", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


def good_rows(spark, sf_dir):
    """The rows that pass when a load tolerates bad ones."""
    documents = table(spark, sf_dir, "documents")
    number = F.when(F.col("lang") == "en", F.concat(F.lit("#"), "n_chars")).otherwise(
        F.col("n_chars").cast("string")
    )
    path = storage.scratch_dir(spark) + "/documents"
    delimited.write_delimited(
        documents.select(F.col("doc_id").cast("string"), number.alias("n_chars"), "text"), path
    )
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_chars", T.LongType()),
            T.StructField("text", T.StringType()),
        ]
    )
    kept = delimited.good_rows(delimited.read_with_errors(spark, path, schema))
    return kept.select("doc_id", "n_chars", F.md5("text").alias("text_md5"))


def split_uri(spark, sf_dir):
    """Host and path of page URLs, and the URL under another scheme."""
    pages = table(spark, sf_dir, "pages")
    parts = text.split_uri(F.col("url"))
    return pages.select(
        "page_id",
        parts["host"].alias("host"),
        parts["path"].alias("path"),
        text.with_scheme(F.col("url"), "s3a").alias("stored_at"),
        text.without_scheme(F.col("url")).alias("bare"),
    )


QUERIES = {
    "delimited_roundtrip": delimited_roundtrip,
    "split_quoted_read": split_quoted_read,
    "delimited_keep_empty": delimited_keep_empty,
    "quote_fields": quote_fields,
    "empty_to_null": empty_to_null,
    "dirty_row_gate": dirty_row_gate,
    "good_rows": good_rows,
    "split_uri": split_uri,
}

_HOSTILE = """
WITH rows AS (
  SELECT doc_id,
         ' ' || chr(13) || chr(92) || '"' || chr(31) || '"' || text || chr(92) || chr(13) || chr(10)
             || source || ' ' AS text,
         CASE WHEN n_chars < 500 THEN '' WHEN lang <> 'en' THEN lang END AS lang
  FROM documents
)"""
_URI = "'^[A-Za-z][A-Za-z0-9+.-]*://([^/]+)(/.*)$'"
_SCHEME = "'^[A-Za-z][A-Za-z0-9+.-]*://'"

ORACLES = {
    "delimited_roundtrip": _HOSTILE + """
SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length, md5(text) AS text_md5,
       nullif(lang, '') AS lang
FROM rows""",
    "split_quoted_read": _HOSTILE + """
SELECT doc_id, CAST(length(text) AS INTEGER) AS text_length, md5(text) AS text_md5,
       nullif(lang, '') AS lang
FROM rows""",
    "delimited_keep_empty": _HOSTILE + " SELECT lang, count(*) AS row_count FROM rows GROUP BY lang",
    "quote_fields": """
WITH lines AS (
  SELECT doc_id, '"' || doc_id || '"' || chr(31) || '"' || replace(coalesce(lang, ''), '"', '""') || '"'
         || chr(31) || '"' || replace(text, '"', '""') || '"' AS line
  FROM documents
)
SELECT doc_id, md5(line) AS line_md5, CAST(length(line) AS INTEGER) AS line_length FROM lines""",
    "empty_to_null": """
SELECT doc_id, CASE WHEN lang <> 'en' THEN nullif(lang, '') END AS lang FROM documents""",
    "dirty_row_gate": """
WITH counts AS (
  SELECT count(*) AS total_rows, count(*) FILTER (WHERE o_orderstatus = 'P') AS bad_rows FROM orders
)
SELECT limit_name, total_rows, bad_rows,
       CASE limit_name WHEN 'none' THEN bad_rows <= 0 WHEN 'half' THEN bad_rows <= total_rows * 0.5
            ELSE true END AS passed
FROM counts, (VALUES ('none'), ('half'), ('all')) v(limit_name)""",
    "good_rows": """
SELECT doc_id, n_chars, md5(text) AS text_md5 FROM documents WHERE lang IS DISTINCT FROM 'en'""",
    "split_uri": f"""
SELECT page_id,
       CASE WHEN regexp_matches(url, {_URI}) THEN regexp_extract(url, {_URI}, 1) END AS host,
       CASE WHEN regexp_matches(url, {_URI}) THEN regexp_extract(url, {_URI}, 2) END AS path,
       regexp_replace(url, {_SCHEME}, 's3a://') AS stored_at,
       regexp_replace(url, {_SCHEME}, '') AS bare
FROM pages""",
}
