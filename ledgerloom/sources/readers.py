"""Readers and writers: CSV as text, bulletin text JSON, manifests, links of an index page."""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules

TEXT_SCHEMA = "method string, pages array<string>, n_pages int, n_chars int, errors array<string>, has_text_layer boolean"


def read_csv_text(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A CSV with every column as text and '' for what is missing."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', enforceSchema=False).fillna("")


def read_or_empty(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """read_csv_text, or no rows where the path does not exist."""
    try:
        return read_csv_text(spark, path, columns)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def read_bulletins(spark: SparkSession, path: str) -> DataFrame:
    """bulletin_id (file name) and the extracted text of a folder with one JSON document per file."""
    df = spark.read.schema(TEXT_SCHEMA).option("multiLine", True).json(path)
    return df.select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("bulletin_id"), "*")


def checked(files: DataFrame) -> DataFrame:
    """path, bulletin_id (file name), status, why and the extracted text of files(path, content): a row a file, whatever it holds.

    status: ok; no_text (no page with text); corrupt (no JSON object of this kind, or no UTF-8); unreadable (no content). Only ok rows
    have pages, so a broken file stops nothing, and none is lost.
    """
    said = F.col("content").cast("string")
    whole = F.when(F.is_valid_utf8(said), said)
    doc = F.from_json(whole, f"{TEXT_SCHEMA}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    df = files.select("path", F.col("content").isNull().alias("missing"), whole.isNull().alias("odd"), doc.alias("doc"))
    broken = F.col("odd") | F.col("doc").isNull() | F.col("doc._corrupt").isNotNull()
    texts = F.coalesce(F.exists("doc.pages", lambda p: F.trim(p) != ""), F.lit(False)) & F.coalesce("doc.has_text_layer", F.lit(False))
    status = F.when(F.col("missing"), "unreadable").when(broken, "corrupt").when(~texts, "no_text").otherwise("ok")
    why = F.when(F.col("missing"), "no content").when(F.col("odd"), "not UTF-8").when(broken, F.concat(F.lit("no such JSON: "), F.substring(F.coalesce("doc._corrupt", F.lit("")), 1, 60)))
    df = df.withColumns({"status": status, "why": F.coalesce(why, F.when(status == "no_text", F.array_join("doc.errors", "; ")), F.lit(""))})
    names = [c.split()[0] for c in TEXT_SCHEMA.split(", ")]
    return df.select("path", F.regexp_extract("path", r"([^/]+?)(?:\.json)?$", 1).alias("bulletin_id"), "status", "why", *[F.when(F.col("status") == "ok", F.col(f"doc.{c}")).alias(c) for c in names])


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True, escape='"', emptyValue="")


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """A set of analysis tables as CSV, one folder for each name."""
    for name, df in tables.items():
        write_csv(df, f"{folder}/{name}")


def append_manifest(df: DataFrame, path: str) -> None:
    write_csv(df, path, mode="append")


def write_documents(df: DataFrame, path: str, *, by: str | None = None) -> None:
    """Nested rows as JSON lines; with `by`, one folder for each value of that column."""
    out = df.write.mode("overwrite")
    (out.partitionBy(by) if by else out).json(path)


def write_records(df: DataFrame, path: str) -> None:
    """Rows as JSON arrays of records, one array a part file, with null columns as null."""

    def arrays(batches):
        begun = False
        for batch in batches:
            rows = batch["row"].to_pylist()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([("," if begun or k else "[") + row for k, row in enumerate(rows)])], ["value"])
                begun = True
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array(["]"])], ["value"])

    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row"))
    rows.mapInArrow(arrays, "value string").write.mode("overwrite").text(path)


def write_bulletin_text(df: DataFrame, path: str) -> None:
    """Extracted text, one folder per bulletin."""
    df.write.mode("overwrite").partitionBy("bulletin_id").json(path)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Temp views under the given names, the SQL counterpart of the history database."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


_HREF = r"""(?is)href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def links(pages: DataFrame, base: str = "") -> DataFrame:
    """page_id, pos, href (without fragment, resolved against base if given), label of every anchor in pages(page_id, html)."""
    found = F.regexp_extract_all("html", F.lit(r"""(?is)<a\s(?:"[^"]*"|'[^']*'|[^'">])*>.*?</a>"""), F.lit(0))
    df = pages.select("page_id", F.posexplode(F.filter(found, lambda a: a.rlike(_HREF))).alias("pos", "a"))
    href = F.concat(*[F.regexp_extract("a", _HREF, k) for k in (1, 2, 3)])
    href = F.split_part(F.trim(F.replace(href, F.lit("&amp;"), F.lit("&"))), F.lit("#"), F.lit(1))
    label = F.trim(F.regexp_replace(F.regexp_replace(F.regexp_extract("a", r"""(?is)^<a\s(?:"[^"]*"|'[^']*'|[^'">])*>(.*)</a>$""", 1), "<[^>]*>", " "), r"\s+", " "))
    return df.select("page_id", "pos", (resolved(href, base) if base else href).alias("href"), label.alias("label"))


def resolved(href: Column, base: str) -> Column:
    """An address relative to a page's own, as an absolute one: scheme, host, root or folder are taken from base, dot parts are folded."""
    scheme, _, rest = base.partition("://")
    host, _, path = rest.split("?")[0].split("#")[0].partition("/")
    folder = path.rpartition("/")[0]
    root = f"{scheme}://{host}"
    absolute, own = href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.split_part(href, F.lit("?"), F.lit(1))
    full = F.when(own.startswith("/"), own).otherwise(F.concat(F.lit(f"/{folder}/" if folder else "/"), own))
    parts = F.split(F.substring(full, 2, 1 << 20), "/")
    step = lambda acc, x: F.when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(F.concat(acc, F.array(x)))
    ends = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise("")
    folded = F.concat(F.lit("/"), F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/"))
    query = F.when(F.contains(href, F.lit("?")), F.regexp_extract(href, r"(\?.*)$", 1)).otherwise("")
    return (
        F.when(absolute, href).when(href.startswith("//"), F.concat(F.lit(f"{scheme}:"), href)).when(href == "", F.lit(base.split("#")[0]))
        .when(own == "", F.concat(F.lit(base.split("?")[0].split("#")[0]), query)).otherwise(F.concat(F.lit(root), folded, F.when(folded.endswith("/"), "").otherwise(ends), query))
    )


def bulletin_index(found: DataFrame) -> DataFrame:
    """pdf_url, index_label, year, month, flags of the bulletin links among links(pos, href, label).

    Labels of one URL are folded in page order: an empty label is replaced, and a later one that says bulletin wins.
    """
    path = F.lower(F.regexp_replace(F.split_part("href", F.lit("?"), F.lit(1)), r"^[a-z]+://[^/]*", ""))
    own = found.filter(path.endswith(".pdf") & (F.contains(path, F.lit("enforcement")) | F.contains(F.lower("label"), F.lit("enforcement"))))
    per = own.groupBy(F.col("href").alias("pdf_url")).agg(F.array_sort(F.collect_list(F.struct("pos", "label"))).alias("seen"))
    better = lambda acc, x: F.when((x["label"] != "") & ((acc == "") | F.contains(F.lower(x["label"]), F.lit("bulletin"))), x["label"]).otherwise(acc)
    df = per.withColumn("index_label", F.aggregate("seen", F.lit(""), better)).drop("seen")
    name, said = r"(?i)(\d{2})(\d{2})_enforcement_action_bulletin\.pdf$", rf"(?i)({'|'.join(rules.MONTHS)})\s+(\d{{4}})"
    month_of = F.array_position(F.array(*[F.lit(m.lower()) for m in rules.MONTHS]), F.lower(F.regexp_extract("index_label", said, 1))).cast("int")
    df = df.withColumns({
        "filename_pattern_ok": F.col("pdf_url").rlike(name), "label_month": F.nullif(month_of, F.lit(0)), "label_year": F.regexp_extract("index_label", said, 2).try_cast("int"),
    })
    df = df.withColumns({
        "bulletin_month": F.when(F.col("filename_pattern_ok"), F.regexp_extract("pdf_url", name, 1).try_cast("int")).otherwise(F.col("label_month")),
        "bulletin_year": F.when(F.col("filename_pattern_ok"), 2000 + F.regexp_extract("pdf_url", name, 2).try_cast("int")).otherwise(F.col("label_year")),
    })
    differs = (F.col("label_month") != F.col("bulletin_month")) | (F.col("label_year") != F.col("bulletin_year"))
    return df.withColumn("label_conflict", F.coalesce(F.col("label_month").isNotNull() & differs, F.lit(False)))
