"""Scans, standardization and union of review sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxtally.functions import text
from voxtally.functions.literals import sql_string
from voxtally.rules import DEFAULT_RULES, RuleSet
from voxtally.schema import INGEST_ORDER, REVIEW_COLUMNS, REVIEW_SCHEMA, STANDARD_COLUMNS
from voxtally.sources.dates import settle_dates
from voxtally.sources.registry import Dataset

SOURCE_MODES = ("public", "synthetic", "combined")


def read_raw(spark: SparkSession, path: str | Sequence[str], file_format: str = "csv", multi_line: bool = True,
             schema: str | None = None) -> DataFrame:
    """Raw review files, with ``source_row`` holding each row's place.

    CSV columns are read as text; spellings of "missing" become null.  A quoted
    field may span lines, so such a file is read by one task: provide many
    files, or pass ``multi_line=False`` where texts hold no line breaks and the
    files may be split.  Either way, land the result in Parquet once.  CSV files
    read together must have the same header; where one differs, reading fails,
    and :func:`read_mixed` reads them.  ``schema`` saves other formats a pass to find theirs.
    """
    if file_format == "csv":
        raw = spark.read.csv(path, header=True, multiLine=multi_line, escape='"', inferSchema=False, enforceSchema=False)
    elif file_format in ("parquet", "orc", "json"):
        reader = spark.read.format(file_format)
        raw = (reader.schema(schema) if schema else reader).load(path)
    else:
        raise ValueError(f"unsupported file format {file_format!r}")
    names = [_quoted(c) for c in raw.columns if c != "source_row"]
    values = [f"{text.missing_to_null(c)} AS {c}" for c in names] if file_format == "csv" else names
    # Row numbers only compare within one split of one file, so file and offset
    # come first: the order is that of the files, however they are packed into tasks.
    place = ("named_struct('file', _metadata.file_path, 'offset', _metadata.file_block_start, "
             "'row', monotonically_increasing_id())")
    return raw.selectExpr(*values, f"{place} AS source_row")


def headers(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``header``, the first line of CSV files, and the ``files`` that begin with it.

    Lines are split but not parsed, and a task keeps one of each file.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "row").alias("header"))
    return first.select(F.regexp_replace("header", r"^\x{FEFF}|\s+$", "").alias("header"), "file").groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))


def read_mixed(spark: SparkSession, path: str | Sequence[str], multi_line: bool = True) -> DataFrame:
    """Raw CSV files of differing headers as one table: every column any of them has, null where a file lacks it.

    Files of one header are read together with the columns it names, so their order does not matter; the parts are put
    together by name.  A job finds the headers when this is called, and the driver gets the list of files by
    header, as it does for any scan.  Names that differ in case only are one column.  Files without a line are left out.
    """
    parts = [read_raw(spark, list(r.files), "csv", multi_line) for r in headers(spark, path).orderBy("header").collect() if r.header]
    if not parts:
        raise ValueError(f"no CSV file with a header at {path}")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def read_dataset(spark: SparkSession, path: str | Sequence[str], dataset: Dataset, rules: RuleSet = DEFAULT_RULES, multi_line: bool = True) -> DataFrame:
    """A raw dataset in the format its description names, standardized; CSV files may differ in their headers."""
    raw = read_mixed(spark, path, multi_line) if dataset.file_format == "csv" else read_raw(spark, path, dataset.file_format)
    return standardize(raw, dataset, rules)


def spread(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Deal a small input out to so many tasks before heavy work on each row; off unless the caller asks."""
    return df.repartition(partitions, key) if partitions else df


def _quoted(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _type(name: str) -> str:
    return REVIEW_SCHEMA[name].dataType.simpleString()


def standardize(raw: DataFrame, dataset: Dataset, rules: RuleSet = DEFAULT_RULES, id_digits: int = 12) -> DataFrame:
    """A raw dataset in the standard schema: mapped, parsed, identified and labelled as public.

    Standard columns without a raw counterpart are null.  ``source_row`` is
    carried along when the raw table has it.  Dates that are text may have any
    form of :mod:`voxtally.sources.dates`; the order of day and month is that of
    the column.  On a stream, which has no whole column, only ISO dates are read.  Identifiers of 32 digits can be shortened by :func:`short_ids`.
    """
    date_column = dataset.column_map.get("review_date")
    if date_column in raw.columns and isinstance(raw.schema[date_column].dataType, T.StringType) and not raw.isStreaming:
        raw = settle_dates(raw, date_column)
    present = {name: _quoted(source) for name, source in dataset.column_map.items() if source in raw.columns}

    def as_text(name: str) -> str:
        return f"string({present.get(name, 'NULL')})"

    def id_part(name: str) -> str:
        # a column the dataset lacks altogether reads differently from a missing value
        return as_text(name) if name in present else "'<NA>'"

    date = f"string({text.parse_date(as_text('review_date'))})"
    raw_text = text.combine_parts(as_text("review_title"), as_text("review_text"))
    values = {name: as_text(name) for name in REVIEW_COLUMNS}
    values |= {
        "review_id": text.review_id(dataset.key, id_part("airline"), date, id_part("review_title"), id_part("review_text"), id_digits),
        "source": sql_string(dataset.source_label),
        "review_date": date,
        "rating": text.parse_number(as_text("rating")),
        "recommended": text.parse_flag(as_text("recommended")),
        "disruption_type": text.infer_disruption(raw_text, rules),
        "raw_text": raw_text,
        "is_synthetic": "false",
        "feedback_text": as_text("review_text"),
    }
    row = ["source_row"] if "source_row" in raw.columns else []
    return raw.selectExpr(*[f"{values[name]} AS {name}" for name in STANDARD_COLUMNS], *row)


def short_ids(df: DataFrame, digits: int = 12, column: str = "review_id") -> DataFrame:
    """Identifiers of 32 digits cut to ``digits``, but for those that would then name different reviews: they stay whole.

    Equal reviews keep equal identifiers.  Only identifiers are shuffled to find the collisions, of which there are few;
    how they get back to the reviews is left to the planner.
    """
    short = f"left({column}, length({column}) - {32 - digits})"
    names = df.selectExpr(f"{short} AS _short", f"{column} AS _whole")
    shared = names.groupBy("_short").agg(F.min("_whole").alias("_a"), F.max("_whole").alias("_b")).where("_a <> _b").select("_short")
    marked = df.withColumn("_id", F.expr(short)).join(shared.withColumn("_shared", F.lit(True)), F.col("_id") == F.col("_short"), "left")
    return marked.withColumn(column, F.expr(f"IF(_shared, {column}, _id)")).drop("_id", "_short", "_shared")


def complete_columns(df: DataFrame, is_synthetic: bool | None = None) -> DataFrame:
    """Add the standard columns a table lacks, as nulls, and fill gaps in ``raw_text``.

    Existing columns keep their types; cleaning parses what is still text.
    """
    values = {name: name if name in df.columns else f"cast(NULL AS {_type(name)})" for name in REVIEW_COLUMNS}
    if is_synthetic is not None:
        values["is_synthetic"] = str(is_synthetic).lower()
    joined = text.combine_parts(values["review_title"], values["review_text"])
    values["raw_text"] = f"coalesce({values['raw_text']}, {joined})"
    values["feedback_text"] = values["review_text"]
    row = ["source_row"] if "source_row" in df.columns else []
    return df.selectExpr(*[f"{values[name]} AS {name}" for name in STANDARD_COLUMNS], *row)


def _ranked(df: DataFrame, rank: int) -> DataFrame:
    """All columns in the types of the standard schema, with the place in the whole order."""
    rank_column, row_column = INGEST_ORDER
    if row_column not in df.columns:
        raise ValueError(f"a review source needs {row_column}, the position of each row in it; read_raw adds it")
    values = {name: f"string({name})" for name in STANDARD_COLUMNS}
    values |= {"rating": text.parse_number("rating"),
               **{name: text.parse_flag(name) for name in ("recommended", "is_synthetic")}}
    place = row_column
    if not isinstance(df.schema[row_column].dataType, T.StructType):  # a plain row number
        place = f"named_struct('file', '', 'offset', 0L, 'row', bigint({row_column}))"
    return df.selectExpr(*[f"{values[name]} AS {name}" for name in STANDARD_COLUMNS], f"{rank} AS {rank_column}",
                         f"{place} AS {row_column}")


def union_sources(public: DataFrame | None = None, synthetic: DataFrame | None = None,
                  mode: str = "public") -> DataFrame:
    """The sources asked for, public rows first.

    "First" is kept as data (``source_rank``, ``source_row``): a table has no
    order of its own once it is distributed.
    """
    if mode not in SOURCE_MODES:
        raise ValueError(f"invalid source mode {mode!r}; expected one of {SOURCE_MODES}")
    given = {"public": public, "synthetic": synthetic}
    wanted = list(given) if mode == "combined" else [mode]
    lacking = [name for name in wanted if given[name] is None]
    if lacking:
        raise ValueError(f"source mode {mode!r} needs the {' and '.join(lacking)} source")
    parts = [_ranked(complete_columns(given[name], name == "synthetic"), rank) for rank, name in enumerate(wanted)]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
