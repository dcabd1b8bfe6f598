"""Table reads, drift-tolerant scans, rescued JSON and nested-array reshaping."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from harborline.operators.projection import cast_columns
from harborline.session import written_once
from harborline.sources import folders, inventory

RESCUED = "_rescued_data"
_CORRUPT = "_corrupt_record"


# --- plain reads ------------------------------------------------------------------


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A path-addressed table (anything with a ``/``) or a catalog table."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def sql_over_path(spark: SparkSession, path: str, select: str = "count(*) AS row_count", fmt: str = "parquet") -> DataFrame:
    """SQL straight over a path-addressed table."""
    return spark.sql(f"SELECT {select} FROM {fmt}.`{path}`")


def rows_to_df(spark: SparkSession, rows: Iterable[tuple], schema: StructType) -> DataFrame:
    """A small in-memory table with a fixed schema."""
    return spark.createDataFrame(list(rows), schema)


def read_typed(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Schema-on-read: cast each declared field, whatever type the files hold."""
    raw = spark.read.parquet(path)
    return raw.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def refresh(spark: SparkSession, name_or_path: str) -> None:
    """Pick up files that were added to or replaced in an external table."""
    if "/" in name_or_path:
        spark.catalog.refreshByPath(name_or_path)
    else:
        spark.catalog.refreshTable(name_or_path)


def file_inventory(df: DataFrame) -> DataFrame:
    """The files behind a file-based frame, with their sizes."""
    return df.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    ).distinct()


def peek_raw(df: DataFrame, n: int = 5) -> DataFrame:
    """A few rows as raw JSON text, to learn field names before declaring types."""
    return df.select(F.to_json(F.struct("*")).alias("value")).limit(n)


# --- file discovery and schema drift ----------------------------------------------


def list_files(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Sorted files under ``path`` that end in ``suffix``, for small folders; ``inventory.listing`` keeps them in a frame."""
    return sorted(row.path for row in inventory.listing(spark, path, suffix).select("path").collect())


#: Schemes of paths as Spark lists them, and those under which the footer reader opens them.
FOOTER_SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def footer_uri() -> Callable[[str], str]:
    """A function from a listed path to the footer reader's URI; nested, so that it travels by value."""
    schemes = dict(FOOTER_SCHEMES)

    def uri(path: str) -> str:
        scheme, _, rest = path.partition(":")
        if scheme not in schemes:
            raise ValueError(f"footers cannot be read from {scheme}: paths; the schemes are {sorted(schemes)}")
        return f"{schemes[scheme]}://{rest.removeprefix('//')}"

    return uri


def _footer_reader() -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A function that adds to each file its column names and physical types as one text.

    It is built inside this one, so that it travels to the executors by value and they
    need no copy of this package.
    """

    uri = footer_uri()

    def shapes(batches):
        import pandas
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            found = []
            for path in batch["path"]:
                filesystem, inner = fs.FileSystem.from_uri(uri(path))
                with filesystem.open_input_file(inner) as handle:
                    schema = pq.read_schema(handle)
                found.append(";".join(sorted(f"{f.name}:{f.type}" for f in schema)))
            yield batch.assign(shape=pandas.Series(found, index=batch.index, dtype=object))

    return shapes


SHAPED = inventory.FILE + ", shape string"


def file_shapes(spark: SparkSession, path: str, suffix: str = ".parquet", manifest: str | None = None) -> DataFrame:
    """``(path, size, modified, shape, is_read)`` of all files; ``shape`` names their columns and physical types.

    Executors read the footers. With ``manifest``, a folder in which the shapes are kept, only those of files that are new
    or changed since the last run (``is_read``), and the manifest is brought up to date.
    """
    now = inventory.listing(spark, path, suffix)
    if manifest is None:
        return _footers(now).withColumn("is_read", F.lit(True))
    now = written_once(now, "listing")
    same = ["path", "size", "modified"]
    known = now.join(inventory.stored(spark, manifest, SHAPED), same)
    unseen = now.join(known.select(*same), same, "left_anti")
    shapes = known.withColumn("is_read", F.lit(False)).unionByName(_footers(unseen).withColumn("is_read", F.lit(True)))
    shapes = written_once(shapes, "shapes")
    inventory.publish(shapes.drop("is_read"), manifest)
    return shapes


def _footers(files: DataFrame) -> DataFrame:
    # A listing scan has a task per file; a few footers per task are cheaper.
    few = files.coalesce(4 * files.sparkSession.sparkContext.defaultParallelism)
    return few.mapInPandas(_footer_reader(), SHAPED)


def _above(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]+$", 1)


def _units(files: DataFrame, root: str) -> tuple[DataFrame, str]:
    """``(shape, unit, newest)``: the topmost folders that hold files of one shape only, and files of mixed folders one by one.

    Also how they are to be read: ``partitioned`` where all folders below ``root`` are ``key=value`` ones, ``nested`` where none is. In a
    ``mixed`` layout units are the folders the files lie in.
    """
    placed = files.select("path", "shape", "modified", _above(F.col("path")).alias("folder"))
    depth = F.lit(_depth(root))
    inner = F.slice(F.split("folder", "/+"), depth + 1, F.greatest(F.size(F.split("folder", "/+")) - depth, F.lit(0)))
    kinds = placed.select(F.explode(inner).alias("name")).agg(F.min(F.col("name").contains("=")).alias("all"), F.max(F.col("name").contains("=")).alias("any")).first()
    layout = "partitioned" if kinds["all"] else "nested" if not kinds["any"] else "mixed"
    by_folder = placed.groupBy("folder").agg(F.min("shape").alias("least"), F.max("shape").alias("most"), F.max("modified").alias("newest"))
    parts = F.split("folder", "/")
    lowest = F.size(parts) if layout == "mixed" else F.least(F.size(parts), F.size(parts) - F.size(F.filter(inner, lambda x: x != "")))
    upper = F.transform(F.sequence(lowest, F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    folders = by_folder.select(F.explode(upper).alias("unit"), "least", "most", "newest")
    folders = folders.groupBy("unit").agg(F.min("least").alias("shape"), F.max("most").alias("most"), F.max("newest").alias("newest")).where("shape = most").drop("most")
    inside = folders.select(F.col("unit").alias("_upper"))
    top = folders.join(inside, _above(F.col("unit")) == F.col("_upper"), "left_anti")
    single = placed.join(folders.select(F.col("unit").alias("folder")), "folder", "left_anti")
    return top.unionByName(single.select(F.col("path").alias("unit"), "shape", F.col("modified").alias("newest"))), layout


def folder_units(shapes: DataFrame, path: str) -> DataFrame:
    """``(shape, unit, newest)``: what ``read_drifting_parquet`` reads for each shape of ``file_shapes``."""
    some = shapes.select("path").head()
    return shapes.select("shape", F.col("path").alias("unit"), F.col("modified").alias("newest")).limit(0) if some is None else _units(shapes, _listed_root(path, some.path))[0]


def _depth(root: str) -> int:
    """Parts of a root's path, as they are counted in the paths of its files."""
    return len(re.split("/+", root.rstrip("/")))


def read_drifting_parquet(
    spark: SparkSession, path: str, casts: Mapping[str, DataType | str], suffix: str = ".parquet", manifest: str | None = None
) -> DataFrame:
    """Union Parquet files whose schemas disagree.

    Executors read the footers (see ``file_shapes``) and group the files by schema; the driver gets one row for each
    schema, with the topmost folders that hold nothing else, so the plan grows with the
    number of distinct schemas and not with the number of files. Each
    scan applies ``casts`` and records ``_source_file`` before the union by name, in
    which absent columns become NULL. Files that land meanwhile wait for the next read.
    """
    shapes = file_shapes(spark, path, suffix, manifest)
    if manifest is None:
        shapes = written_once(shapes, "shapes")
    some = shapes.select("path").head()
    if some is None:
        raise FileNotFoundError(f"no {suffix} files under {path}")
    if path.endswith(suffix) and shapes.select(F.count_distinct("shape")).first()[0] == 1:
        groups, layout = [([path], None)], "mixed"
    else:
        units, layout = _units(shapes, _listed_root(path, some.path))
        rows = units.groupBy("shape").agg(F.sort_array(F.collect_set("unit")).alias("units"), F.max(F.unix_micros("newest")).alias("newest")).collect()
        groups = [(r.units, r.newest) for r in sorted(rows, key=lambda r: r.shape)]
    reader = spark.read.option("pathGlobFilter", f"*{suffix}")
    if layout == "nested":
        reader = reader.option("recursiveFileLookup", "true")
    elif not path.endswith(suffix):
        reader = reader.option("basePath", path)  # keeps the columns of a key=value layout
    scans = []
    for found, newest in groups:
        scan = reader.parquet(*found)
        if newest is not None:
            scan = scan.where(F.col("_metadata.file_modification_time") <= F.timestamp_micros(F.lit(newest)))
        scans.append(cast_columns(scan.withColumn("_source_file", F.col("_metadata.file_path")), casts))
    return union_all_by_name(scans)


def _listed_root(path: str, listed: str) -> str:
    """``path`` as the listing writes it, with the scheme and authority of a listed file."""
    inner = path.split("://", 1)[-1] if "://" in path else path.split(":", 1)[-1]
    inner = inner.rstrip("/")
    at = listed.find(inner + "/")
    return listed[: at + len(inner)] if at >= 0 else path


def union_all_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


# --- JSON -------------------------------------------------------------------------


_TEXTS = MapType(StringType(), StringType())


def _misfits(raw: Column, typed: Column, schema: StructType, prefix: Column) -> Column:
    """``(key, value)`` entries of what ``typed`` lost of the object ``raw``, nested objects included.

    A key carries its path: ``a.b`` for a field of a struct, ``a[0].b`` for one of an array's elements.
    """
    known = [f.name for f in schema.fields]
    untyped = F.array_compact(F.array(*[F.when(typed.getField(n).isNull(), F.lit(n)) for n in known]))
    own = F.map_filter(raw, lambda k, v: ~k.isin(*known) | (v.isNotNull() & F.array_contains(untyped, k)))
    parts = [F.transform(F.map_entries(own), lambda e: F.struct(F.concat(prefix, e["key"]).alias("key"), e["value"].alias("value")))]
    for field in schema.fields:
        kind, text, inner = field.dataType, raw[field.name], typed.getField(field.name)
        if isinstance(kind, StructType):
            parts.append(_misfits(F.from_json(text, _TEXTS), inner, kind, F.concat(prefix, F.lit(f"{field.name}."))))
        elif isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType):
            place = lambda i, name=field.name: F.concat(prefix, F.lit(f"{name}["), i.cast("string"), F.lit("]."))

            def of_element(e, i, inner=inner, kind=kind, place=place):
                return _misfits(e, F.get(inner, i), kind.elementType, place(i))

            each = F.transform(F.from_json(text, ArrayType(_TEXTS)), lambda e, i: of_element(e, i))
            parts.append(F.flatten(each))
    empty = F.array().cast("array<struct<key:string,value:string>>")
    return F.concat(*[F.coalesce(p, empty) for p in parts])


def rescue_json(df: DataFrame, value_col: str, schema: StructType) -> DataFrame:
    """Parse JSON text to typed columns and keep whatever does not fit.

    ``_rescued_data`` holds, as JSON, the keys the schema does not know and the values
    whose type does not match, those inside structs and arrays of structs under their
    paths; a line that is not JSON at all is kept whole under
    ``_corrupt_record``. It is NULL for a clean line. Other columns pass through.
    """
    text = F.col(value_col).cast("string")
    parsed = df.withColumns({"_typed": F.from_json(text, schema), "_raw": F.from_json(text, _TEXTS)})
    misfits = F.map_from_entries(_misfits(F.col("_raw"), F.col("_typed"), schema, F.lit("")))
    whole_line = F.create_map(F.lit(_CORRUPT), text)
    broken = F.col("_raw").isNull() & text.isNotNull()
    rescued = F.when(broken, F.to_json(whole_line)).when(F.size(misfits) > 0, F.to_json(misfits))
    passed = [c for c in df.columns if c != value_col]
    known = [f.name for f in schema.fields]
    return parsed.select(*passed, *[F.col("_typed").getField(n).alias(n) for n in known], rescued.alias(RESCUED))


def rescued_report(df: DataFrame) -> DataFrame:
    """Rows with rescued data, and their percentage."""
    rescued = F.count(RESCUED)
    pct = F.coalesce(F.try_divide(rescued * 100.0, F.count(F.lit(1))), F.lit(0.0))
    return df.agg(rescued.alias("rescued_rows"), pct.alias("rescued_pct"))


def rescued_sample(df: DataFrame, n: int = 10) -> DataFrame:
    kept = [c for c in (RESCUED, "_source_file") if c in df.columns]
    return df.filter(F.col(RESCUED).isNotNull()).select(*kept).limit(n)


def saved_schema(spark: SparkSession, path: str) -> StructType | None:
    """The schema persisted at ``path``, or None if there is none yet."""
    import json

    if not folders.exists(spark, path):
        return None
    lines = spark.read.text(path, wholetext=True).head(1)
    return StructType.fromJson(json.loads(lines[0].value)) if lines else None


def infer_json_schema(spark: SparkSession, src: str, schema_path: str) -> StructType:
    """Infer the schema of all landed JSON lines once, persist it, and reuse it on later runs."""
    known = saved_schema(spark, schema_path)
    if known is not None:
        return known
    inferred = _infer(spark, src)
    _save_schema(spark, inferred, schema_path)
    return inferred


def evolve_json_schema(spark: SparkSession, src: str, schema_path: str) -> StructType:
    """Add to the persisted schema the columns that newly landed files bring.

    Only files that are not in the inventory beside the schema are read; their lines are merged to one schema by a
    single aggregate. Known columns keep their type, so values that changed type are rescued, not recast.
    """
    store = f"{schema_path.rstrip('/')}_files"
    now = written_once(inventory.listing(spark, src), "listing")
    known = saved_schema(spark, schema_path)
    if known is None:
        known = infer_json_schema(spark, src, schema_path)
    else:
        taken = {name.lower() for name in known.names}
        added = [f for f in merged_json_schema(_unseen_lines(spark, src, now, store)).fields if f.name.lower() not in taken]
        if added:
            known = StructType([*known.fields, *added])
            _save_schema(spark, known, schema_path)
    inventory.publish(now, store)
    return known


def _unseen_lines(spark: SparkSession, src: str, now: DataFrame, store: str) -> DataFrame:
    """The lines of files that are new or changed since the inventory at ``store``.

    Files before the oldest of them are left out by their time, without a look into them. Only where
    seen files are as young are the paths compared too.
    """
    unseen = written_once(inventory.difference(now, inventory.stored(spark, store)).where("change <> 'gone'"), "unseen-files")
    since = unseen.agg(F.min(F.unix_micros("modified"))).first()[0]
    lines = spark.read.option("recursiveFileLookup", "true").text(src)
    if since is None:
        return lines.select("value").limit(0)
    moment = F.timestamp_micros(F.lit(since))
    young = lines.where(F.col("_metadata.file_modification_time") >= moment).select("value", F.col("_metadata.file_name").alias("_name"), F.col("_metadata.file_path").alias("_path"))
    others = now.join(unseen, "path", "left_anti").where(F.col("modified") >= moment)
    if others.isEmpty():
        return young.select("value")
    wanted = unseen.select(F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/").alias("_path"))
    plain = F.regexp_replace(F.url_decode(F.replace("_path", F.lit("+"), F.lit("%2B"))), "^([a-z0-9]+):/+", "$1:/")
    return young.withColumn("_path", plain).join(wanted, "_path", "left_semi").select("value")


#: How the merged type of JSON values is written, and the column type that holds all of them as JSON inference would.
_MERGED_TYPE = re.compile(r"`(?:[^`]|``)*`|\b(?:OBJECT(?=<)|VARIANT\b(?!:)|VOID\b(?!:)|DECIMAL\(\d+,\s*(\d+)\))")


def merged_json_schema(lines: DataFrame, value_col: str = "value") -> StructType:
    """The schema of JSON lines by one aggregate that merges types: unlike ones become text, numbers the wider number.

    Lines that are no JSON objects bring no columns.
    """
    merged = lines.select(F.try_parse_json(value_col).alias("v")).where(F.schema_of_variant("v").startswith("OBJECT<"))
    found = merged.agg(F.schema_of_variant_agg("v")).first()[0]
    if not found or not found.startswith("OBJECT<") or found == "OBJECT<>":
        return StructType()

    def plain(m: re.Match) -> str:
        if m[0].startswith("`"):
            return m[0]
        if m[0] == "OBJECT":
            return "STRUCT"
        return "STRING" if m[0] in ("VARIANT", "VOID") else "DOUBLE" if int(m[1]) else "DECIMAL(38,0)"

    return StructType.fromDDL(f"root {_MERGED_TYPE.sub(plain, found)}").fields[0].dataType


def _infer(spark: SparkSession, src: str) -> StructType:
    # one distributed read of the whole folder: no file is left out and no path comes to the driver
    inferred = spark.read.option("recursiveFileLookup", "true").json(src).schema
    return StructType([StructField(f.name, f.dataType, True) for f in inferred.fields if f.name != _CORRUPT])


def _save_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def explode_parallel_arrays(df: DataFrame, struct_col: str, mapping: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Zip the parallel arrays of a struct into rows.

    ``mapping`` is ``{output: (array field, type)}``; other columns pass through.
    """
    fields = {out: field for out, (field, _) in mapping.items()}
    source = F.col(struct_col)
    zipped = F.arrays_zip(*[source.getField(field).alias(out) for out, field in fields.items()])
    others = [c for c in df.columns if c != struct_col]
    rows = df.select(*others, F.explode(zipped).alias("_row"))
    return rows.select(
        *others,
        *[F.col("_row").getField(out).cast(kind).alias(out) for out, (_, kind) in mapping.items()],
    )
