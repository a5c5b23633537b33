"""Landed JSON drops: what each file really holds, which files may be loaded, and their events with narrow types.

Files are read as lines of text and parsed into variants, so no file's odd schema can spoil a scan or its schema
inference. One scan with one aggregate by file gives the merged schema of every wanted field; a file with a fault is listed with its
reasons and left out whole, the others load. Nothing loops over files on the driver.

Defined cases: blank lines are nothing; a line that is no JSON, or has no list of events, is a fault of its file; an event
that lacks a field has NULL there, a fault if the field is required; a value outside its narrow type becomes NULL; a
file without lines is in no result; files of ``known`` are not loaded again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spindrift.sources.io import owner
from spindrift.sources.session import fixed

#: What JSON values a column type takes. ``entry`` is a list of (group, item) objects of which the first counts; a list of
#: plain strings in its place says nothing.
ACCEPTED = {
    "string": r"^(STRING|VOID)$", "boolean": r"^(BOOLEAN|VOID)$", "double": r"^(BIGINT|DECIMAL\(.*\)|DOUBLE|FLOAT|VOID)$", "timestamp": r"^(STRING|VOID)$", "date": r"^(STRING|VOID)$",
    "bigint": r"^(BIGINT|VOID)$", "int": r"^(BIGINT|VOID)$", "smallint": r"^(BIGINT|VOID)$", "tinyint": r"^(BIGINT|VOID)$", "entry": r"^(VOID|ARRAY<(VOID|STRING|VARIANT|OBJECT<.*>)>)$",
}
ENTRY = "struct<group:string,item:string>"


def lines(spark: SparkSession, path: str, root: str = "events", whole: bool = False) -> DataFrame:
    """source_file, document and event (variants): a row an event, or one with a NULL event for a line without."""
    rows = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=whole)
    rows = rows.where(F.trim("value") != "").select(F.col("_metadata.file_path").alias("source_file"), F.try_parse_json("value").alias("document"))
    events = F.try_variant_get("document", f"$.{root}", "array<variant>")
    return rows.select("source_file", "document", events.isNotNull().alias("listed"), F.explode_outer(events).alias("event"))


def of_event(name: str, kind: str) -> Column:
    """A field of an event in its type, or NULL."""
    path = f"$.{name}"
    if kind == "entry":
        first = F.get(F.try_variant_get("event", path, "array<variant>"), F.lit(0))
        return F.try_variant_get(first, "$", ENTRY)
    if kind in ("timestamp", "date"):
        return F.try_variant_get("event", path, "string").try_cast(kind)
    if kind in ("int", "smallint", "tinyint"):
        return F.try_variant_get("event", path, "bigint").try_cast(kind)
    return F.try_variant_get("event", path, kind)


def inspected(rows: DataFrame, fields: dict[str, str], required: list[str] | None = None) -> DataFrame:
    """(source_file, owner_name, n_events, reasons) of each file: why it can't be loaded, or no reason."""
    required = required or []
    got = {f: F.try_variant_get("event", f"$.{f}", "variant") for f in fields}
    merged = [F.schema_of_variant_agg(v).alias(f"kind_{f}") for f, v in got.items()]
    gaps = [F.count_if(F.col("event").isNotNull() & (got[f].isNull() | F.is_variant_null(got[f]))).alias(f"gap_{f}") for f in required]
    files = rows.groupBy("source_file").agg(F.count("event").alias("n_events"), F.count_if(F.col("document").isNull()).alias("broken"), F.count_if(F.col("document").isNotNull() & ~F.col("listed")).alias("unlisted"), *merged, *gaps)
    reasons = [F.when(F.col("broken") > 0, F.lit("not JSON")), F.when(F.col("unlisted") > 0, F.lit("no list of events"))]
    reasons += [F.when(F.col(f"gap_{f}") > 0, F.lit(f"missing: {f}")) for f in required]
    reasons += [F.when(~F.coalesce(F.col(f"kind_{f}"), F.lit("VOID")).rlike(ACCEPTED[kind]), F.concat(F.lit(f"type of {f}: "), F.col(f"kind_{f}"), F.lit(f", not {kind}"))) for f, kind in fields.items()]
    return files.select("source_file", owner(F.col("source_file")).alias("owner_name"), "n_events", F.array_compact(F.array(*reasons)).alias("reasons"))


def load(spark: SparkSession, path: str, fields: dict[str, str], required: list[str] | None = None, known: DataFrame | None = None, root: str = "events", whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """The events of all sound files that are not in ``known`` (source_file), with typed fields, source_file and owner_name;
    and the faulty files with their reasons."""
    if unknown := sorted(set(fields.values()) - set(ACCEPTED)):
        raise ValueError(f"no such types: {unknown}")
    rows = lines(spark, path, root, whole)
    files = fixed(inspected(rows, fields, required))
    good = files.where(F.size("reasons") == 0).select("source_file", "owner_name")
    if known is not None:
        good = good.join(known.select("source_file").distinct(), "source_file", "left_anti")
    typed = rows.where("event is not null").select("source_file", *[of_event(f, kind).alias(f) for f, kind in fields.items()])
    return typed.join(good, "source_file"), files.where(F.size("reasons") > 0).select("source_file", "owner_name", "reasons")
