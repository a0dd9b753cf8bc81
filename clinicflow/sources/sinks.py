"""Sinks: JSON rows, ordered JSON arrays, bounded documents, report writers."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, TimestampNTZType, TimestampType

from clinicflow.functions.dates import iso_instant_text
from clinicflow.functions.expr import name_order
from clinicflow.functions.labels import REPORT_TZ
from clinicflow.operators.lineage import materialize
from clinicflow.operators.ordering import global_row_number

JSON_OPTS = {"ignoreNullFields": "false"}


def json_rows(df: DataFrame, cols: list[str] | None = None, rename: dict[str, str] | None = None, out: str = "json") -> DataFrame:
    """One ``{k: v, ...}`` JSON text per row, NULL fields kept
    (``jsonb_build_object`` keeps them; ``to_json`` drops them by default).
    ``rename`` maps column -> presentation key (e.g. Thai keys)."""
    cols = cols or df.columns
    rename = rename or {}
    return df.select(F.to_json(F.struct(*[F.col(c).alias(rename.get(c, c)) for c in cols]), JSON_OPTS).alias(out))


def ordered_json_array(df: DataFrame, value: Column, order: list[str], empty_as_null: bool = False) -> DataFrame:
    """S6/S7/S8 ``jsonb_agg(value ORDER BY keys)`` for a *bounded* frame.

    One row with one JSON array text. ``collect_list`` gathers the whole frame
    into one value, so use it only where rows are bounded by days / clinics /
    codes / plans; unbounded content goes through ``write_json_lines``.
    ``empty_as_null`` keeps ``jsonb_agg``'s NULL on no rows (without COALESCE).
    """
    items = F.collect_list(F.struct(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(order)], value.alias("_v")))
    arr = F.transform(F.array_sort(items), lambda x: x["_v"])
    j = F.to_json(arr, JSON_OPTS)
    if empty_as_null:
        j = F.when(F.size(arr) > 0, j)
    return df.agg(j.alias("json"))


def meta_json(meta: DataFrame, tz: str = REPORT_TZ) -> DataFrame:
    """The meta row as one JSON text; timestamps as ISO-8601 in ``tz``
    with the zone offset (``2026-01-03T00:00:00+07:00``), NULL fields kept."""
    cols = []
    for f in meta.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, TimestampType):
            # an instant (e.g. generated_at): session zone -> UTC wall clock first
            c = iso_instant_text(F.convert_timezone(None, F.lit("UTC"), c), tz)
        elif isinstance(f.dataType, TimestampNTZType):
            c = iso_instant_text(c, tz)
        cols.append(c.alias(f.name))
    return meta.select(F.to_json(F.struct(*cols), JSON_OPTS).alias("json"))


def json_document(meta: DataFrame, content_json: DataFrame, empty: str = "null") -> DataFrame:
    """``{"meta": {...}, "content": [...]}`` for bounded reports (one row); ``empty``: the content of a report without rows."""
    json_text = content_json.select("json").scalar()
    c = F.when(json_text.isNull() | (json_text == "[]"), F.lit(empty)).otherwise(json_text)
    doc = F.concat(F.lit('{"meta":'), F.col("json"), F.lit(',"content":'), c, F.lit("}"))
    return meta_json(meta).select(doc.alias("document"))


def write_json_lines(df: DataFrame, path: str, order: tuple = (), mode: str = "overwrite") -> None:
    """Unbounded content: JSON lines written by all tasks (optionally range-sorted)."""
    out = df.orderBy(*order) if order else df
    out.write.mode(mode).option("ignoreNullFields", "false").json(path)


def _printed(report) -> dict[str, str]:
    """Content column -> key of the printed row."""
    return report.keys or {c: c for c in report.content.columns if c != "sort_order"}


def write_report(report, path: str, mode: str = "overwrite") -> None:
    """``path/content`` (JSON lines), ``path/<name>`` for each further output, and ``path/meta`` (one JSON line).

    Rows carry the report's presentation keys and no sort column. Content is written first; meta that depends on the rows is computed from
    the written content (``report.meta_fn``), so the fact pipeline runs once.
    """
    text = {f.name for f in report.content.schema.fields if isinstance(f.dataType, StringType)}
    order = [name_order(c, report.collation if c in text else None) for c in report.order]
    content = report.content.orderBy(*order) if order else report.content
    content = content.select(*[F.col(c).alias(k) for c, k in _printed(report).items()])
    write_json_lines(content, f"{path}/content", (), mode)
    for name, rows in report.extras.items():
        write_json_lines(rows, f"{path}/{name}", (), mode)
    meta = report.meta
    if report.meta_fn is not None:
        spark = report.content.sparkSession
        written = spark.read.schema(content.schema).json(f"{path}/content")
        meta = report.meta_fn(written)
    meta_json(meta).coalesce(1).write.mode(mode).text(f"{path}/meta")


def write_document(report, path: str, mode: str = "overwrite", parts: int | None = None) -> list[str]:
    """One valid JSON document ``{"meta": {...}, "content": [...]}``, written in parts by many tasks.

    ``path/manifest`` (one JSON line) lists the files in order with their sizes;
    their bytes one after the other are the document. The content is computed
    once, written as typed rows for the meta that depends on them, and numbered
    in the report's order over even ranges (``global_row_number``); each range is
    a part, written in order by the task that holds it. A row's comma stands
    before it, on all rows but number 1, so a part needs to know nothing of
    the others. No rows give ``report.empty`` (S8). Rows that tie in the report's order
    are ordered by their other columns. Returns the files in order. The order
    is binary: a report with a collation (bounded by its names) goes through ``write_report``.
    """
    if report.collation is not None:
        raise ValueError("documents in parts are ordered by binary text; use write_report for a collation")
    spark = report.content.sparkSession
    rows = materialize(report.content, "document")
    order = list(report.order)
    ties = [f.name for f in rows.schema.fields if not isinstance(f.dataType, (ArrayType, BinaryType, MapType, StructType))]
    numbered = global_row_number(rows, order, [c for c in ties if c not in order], "_seq", parts, keep_position=True)
    line = F.to_json(F.struct(*[F.col(c).alias(k) for c, k in _printed(report).items()]), JSON_OPTS)
    text = F.concat(F.when(F.col("_seq") > 1, ",").otherwise(""), line)
    ordered = numbered.select(F.col("_pid").alias("part"), "_mid", text.alias("value")).sortWithinPartitions("part", "_mid")
    ordered.drop("_mid").write.mode(mode).partitionBy("part").text(f"{path}/parts")
    written = _files(spark, f"{path}/parts")
    meta = meta_json(report.meta_fn(rows) if report.meta_fn is not None else report.meta).first()["json"]
    head, tail = ("[", "]}") if written else (report.empty, "}")
    for name, value in (("head", f'{{"meta":{meta},"content":{head}'), ("tail", tail)):
        spark.createDataFrame([(value,)], "value string").coalesce(1).write.mode(mode).text(f"{path}/{name}")
    files = [*_files(spark, f"{path}/head"), *written, *_files(spark, f"{path}/tail")]
    manifest = json.dumps({"files": [{"path": p, "bytes": n} for p, n in files]})
    spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode(mode).text(f"{path}/manifest")
    return [p for p, _ in files]


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """The data files below a written folder with their sizes, by number of the part, then by name."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, at = [], fs.listFiles(folder, True)
    while at.hasNext():
        status = at.next()
        name, parent = status.getPath().getName(), status.getPath().getParent().getName()
        if name.startswith("part-") and status.getLen():
            number = int(parent.removeprefix("part=")) if parent.startswith("part=") else 0
            found.append((number, name, status.getPath().toString(), status.getLen()))
    return [(p, n) for _, _, p, n in sorted(found)]
