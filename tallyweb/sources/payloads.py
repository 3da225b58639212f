"""Url lists as text: JSON lists and objects, lines, or commas. Columns only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import BLANK, or_null
from ..schemas import JOB_FIELDS

ENTRY = f"struct<{', '.join(f.replace(' ', ': ', 1) for f in JOB_FIELDS.split(', '))}, id: bigint>"


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"\A{BLANK}+|{BLANK}+\z", "")


def _one_json(text: Column) -> Column:
    """The text as a variant if it is one JSON value, else null. The parser reads the first value and leaves the rest, so
    the text is read as the first of two members of a list."""
    two = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("\n,0]"))), "$", "array<variant>")
    return F.when(F.size(two) == 2, F.get(two, 0))


def _kind(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), r"\A[A-Z]+", 0)


def _entry(v: Column) -> Column:
    """The entry of a variant: a string is a url, an object has fields; else null."""
    fields = [f.split(" ") for f in (JOB_FIELDS + ", id BIGINT").split(", ")]
    of_object = F.struct(*[F.try_variant_get(v, f"$.{name}", kind.lower()).alias(name) for name, kind in fields])
    of_string = F.struct(*[(F.try_variant_get(v, "$", "string") if name == "url" else F.lit(None).cast(kind.lower())).alias(name) for name, kind in fields])
    return F.when(_kind(v) == "OBJECT", of_object).when(_kind(v) == "STRING", of_string)


def _plain(url: Column) -> Column:
    fields = [f.split(" ") for f in (JOB_FIELDS + ", id BIGINT").split(", ")]
    return F.struct(*[(url if name == "url" else F.lit(None).cast(kind.lower())).alias(name) for name, kind in fields])


def parse_url_payload(payloads: DataFrame) -> DataFrame:
    """(payload_id, pos, job fields) of each entry of the payloads (payload_id, text).

    A JSON list, or an object's `urls`, gives its strings and objects; a JSON string is one url. All else is read by lines,
    or by commas if there is one line that doesn't begin with `{`; blank lines and those that begin with `#` go; a line may
    be a JSON string, or an object with `url`.
    """
    text = F.col("__text")
    rows = payloads.select("payload_id", _strip(F.col("text")).alias("__text")).where("__text <> ''")
    rows = rows.withColumn("__json", _one_json(text))
    json = F.col("__json")
    as_list = lambda v, path: F.try_variant_get(v, path, "array<variant>")
    listed = F.when(_kind(json) == "ARRAY", as_list(json, "$")).when((_kind(json) == "OBJECT") & (_kind(F.try_variant_get(json, "$.urls", "variant")) == "ARRAY"), as_list(json, "$.urls"))
    whole = F.when(_kind(json) == "STRING", F.array(json))
    members = F.filter(F.transform(F.coalesce(listed, whole), _entry), lambda e: e.isNotNull())

    lines = F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]")
    parts = F.when((F.size(lines) == 1) & text.contains(",") & ~text.startswith("{"), F.split(text, ",")).otherwise(lines)
    parts = F.filter(F.transform(parts, _strip), lambda x: (x != "") & ~x.startswith("#"))

    def of_line(x: Column) -> Column:
        v = _one_json(x)
        has_url = (_kind(v) == "OBJECT") & F.try_variant_get(v, "$.url", "variant").isNotNull()
        return F.coalesce(F.when(has_url | (_kind(v) == "STRING"), _entry(v)), _plain(x))

    entries = F.coalesce(members, F.transform(parts, of_line))
    return rows.select("payload_id", F.posexplode(entries).alias("pos", "e")).select("payload_id", "pos", "e.*")


def load_manual_urls(inline: DataFrame, files: DataFrame) -> DataFrame:
    """Entries of inline payloads, then those of files, without empty ones; `source` is 0 or 1."""
    both = parse_url_payload(inline).withColumn("source", F.lit(0)).unionByName(parse_url_payload(files).withColumn("source", F.lit(1)))
    return both.where(or_null(F.col("url")).isNotNull())


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Text files, whole, as payloads."""
    return spark.read.text(path, wholetext=True).select(F.xxhash64(F.input_file_name()).alias("payload_id"), F.col("value").alias("text"))
