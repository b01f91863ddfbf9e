"""Landed JSON documents and the records inside them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barframe.fixed_values import SNAPSHOT_PATHS, SPLIT_DOCUMENT, SPLIT_FIELDS
from barframe.functions.names import quoted_name


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as rows, with the partition columns of the folder. One file is one value."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "doc")


def read_snapshots(spark: SparkSession, catalog: Mapping[str, str]) -> DataFrame:
    """``(category, doc)`` for a catalog of category -> path. A missing path is an error; an empty file
    is a NULL document (the reader of files passes it over)."""
    parts = [read_documents(spark, path).select(F.lit(c).alias("category"), "doc") for c, path in catalog.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    names = spark.createDataFrame([(c,) for c in catalog], "category string")
    return names.join(out, "category", "left")


def _variant_path(name: str) -> str | None:
    """A path to a key, quoted by the quote it does not hold; None if it holds both."""
    quote = next((q for q in "'\"" if q not in name), None)
    return quote and f"$[{quote}{name}{quote}]"


def record_array(doc: Column | str, path: str) -> Column:
    """The records under a path such as ``$.allSec.data``, each kept as text.

    The path becomes a schema, so that one pass parses the document and splits the array.
    """
    names = path.removeprefix("$.").split(".")
    schema = "array<string>"
    for name in reversed(names):
        schema = f"struct<{quoted_name(name)}: {schema}>"
    value = F.from_json(doc, schema)
    for name in names:
        value = value.getField(name)
    return value


def _or_fail(records: Column, what: str) -> Column:
    """The records, or an error for a document that has no array in their place."""
    failure = F.raise_error(F.concat(F.lit(f"no {what} in the document of category "), F.col("category")))
    return F.coalesce(records, failure.cast("array<string>"))


def _array_by_category(paths: Mapping[str, str], strict: bool = True) -> Column:
    by_path: dict[str, list[str]] = {}
    for category, path in paths.items():
        by_path.setdefault(path, []).append(category)
    found = [(F.col("category").isin(*cs), record_array("doc", p), p) for p, cs in by_path.items()]
    return F.coalesce(*[F.when(here, _or_fail(records, f"array at {p}") if strict else records) for here, records, p in found])


def _split_parts(fields: Mapping[str, str], parsed: str = "__fields", strict: bool = True) -> Column:
    def part(field: str) -> Column:
        records = F.col(parsed).getField(field)
        return _or_fail(records, f"array {field}") if strict else records

    return F.array(*[F.struct(F.lit(category).alias("category"), part(field).alias("records")) for field, category in fields.items()])


def _split_schema(fields: Mapping[str, str]) -> str:
    return "struct<" + ", ".join(f"{quoted_name(field)}: array<string>" for field in fields) + ">"


def _exploded(df: DataFrame, rest: Sequence[str]) -> DataFrame:
    """Rows of ``__parts``, an array of (category, records), as one row per record.

    A plain ``explode`` of a column lets the optimizer test its size in a filter below, which
    would parse every document a second time; the outer form does not.
    """
    records = df.select(*rest, F.explode_outer("__parts").alias("__part")).select(
        *rest, F.col("__part.category").alias("category"), F.posexplode_outer("__part.records").alias("pos", "raw")
    )
    return records.where("pos is not null")


def extract_records(docs: DataFrame, paths: Mapping[str, str] = SNAPSHOT_PATHS, strict: bool = True) -> DataFrame:
    """``(category, pos, raw)``: one row per record of the documents whose category has a path.

    A document that cannot be read, or has no array at its path, is an error, or without
    ``strict`` has no records. An empty array is fine.
    """
    rest = [c for c in docs.columns if c != "doc"]
    wanted = docs.where(F.col("category").isin(*paths))
    return wanted.select(*rest, F.posexplode(_array_by_category(paths, strict)).alias("pos", "raw"))


def split_document(
    docs: DataFrame, document: str = SPLIT_DOCUMENT, fields: Mapping[str, str] = SPLIT_FIELDS, strict: bool = True
) -> DataFrame:
    """The records of one document under several fields, each field a category of its own; a missing
    field is an error unless ``strict`` is off."""
    rest = [c for c in docs.columns if c not in ("doc", "category")]
    parsed = docs.where(F.col("category") == document).select(
        *rest, "category", F.from_json("doc", _split_schema(fields)).alias("__fields")
    )
    return _exploded(parsed.withColumn("__parts", _split_parts(fields, strict=strict)), rest)


def all_records(
    docs: DataFrame, paths: Mapping[str, str] = SNAPSHOT_PATHS, document: str = SPLIT_DOCUMENT,
    fields: Mapping[str, str] = SPLIT_FIELDS, strict: bool = True,
) -> DataFrame:
    """``extract_records`` and ``split_document`` together, in one scan of the documents."""
    rest = [c for c in docs.columns if c not in ("doc", "category")]
    is_split = F.col("category") == document
    parsed = docs.where(F.col("category").isin(*paths, document)).select(
        *rest, "category",
        F.when(is_split, F.from_json("doc", _split_schema(fields))).alias("__fields"),
        _array_by_category(paths, strict).alias("__records"),
    )
    single = F.array(F.struct("category", F.col("__records").alias("records")))
    return _exploded(parsed.withColumn("__parts", F.when(is_split, _split_parts(fields, strict=strict)).otherwise(single)), rest)


def record_keys(raw: Column | str) -> Column:
    """The keys of the record itself, in its own order."""
    return F.concat_ws(", ", F.json_object_keys(raw))


def discover_fields(
    records: DataFrame, order: Sequence[str | Column] = ("pos",), raw: str = "raw"
) -> list[tuple[str, str]]:
    """Field names and types found in the records, in order of first appearance.

    Reads the records once; one row per distinct field comes to the driver, since fields become
    columns. Records keyed by ids have as many fields as ids and are not meant for this. A
    key that holds both kinds of quotes counts as text.
    """
    place = [F.col(c) if isinstance(c, str) else c for c in order]
    keys = records.select(
        F.struct(*[c.alias(f"o{i}") for i, c in enumerate(place)]).alias("at"),
        F.parse_json(raw).alias("v"),
        F.posexplode(F.json_object_keys(raw)).alias("kpos", "key"),
    )
    quote = F.when(~F.contains("key", F.lit("'")), "'").when(~F.contains("key", F.lit('"')), '"')
    path = F.concat(F.lit("$["), quote, F.col("key"), quote, F.lit("]"))
    found = (
        keys.groupBy("key")
        .agg(
            F.min(F.struct("at", "kpos")).alias("first"),
            F.schema_of_variant_agg(F.try_variant_get("v", path, "variant")).alias("kind"),
        )
        .orderBy("first")
        .select("key", "kind")
        .collect()
    )
    return [(r["key"], _field_type(r["kind"])) for r in found]


def _field_type(kind: str) -> str:
    if kind == "BIGINT":
        return "bigint"
    if kind == "DOUBLE" or kind.startswith("DECIMAL"):
        return "double"
    return "boolean" if kind == "BOOLEAN" else "string"


def expand_fields(
    records: DataFrame, fields: Sequence[tuple[str, str]], raw: str = "raw", nested: str = "null"
) -> DataFrame:
    """The fields of each record as columns, missing ones NULL.

    A nested value gives NULL, or its JSON text with ``nested='text'``.
    """
    schema = "struct<" + ", ".join(f"{quoted_name(name)}: string" for name, _ in fields) + ">"
    parsed = records.withColumn("__fields", F.from_json(raw, schema))

    def value(name: str, dtype: str) -> Column:
        text = F.col("__fields").getField(name)
        path = _variant_path(name)
        if nested == "null" and path:
            # Only a text that looks nested is looked at again.
            kind = F.schema_of_variant(F.try_variant_get(F.parse_json(raw), path, "variant"))
            text = F.when(~F.substring(text, 1, 1).isin("[", "{"), text).when(~kind.rlike("^(OBJECT|ARRAY)"), text)
        return (text if dtype == "string" else text.try_cast(dtype)).alias(name)

    return parsed.select(*[F.col(quoted_name(c)) for c in records.columns], *[value(n, t) for n, t in fields])
