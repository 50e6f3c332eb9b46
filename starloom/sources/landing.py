"""Landing sources and sinks (O-01, O-30..O-32, O-35..O-38).

The landing table holds the six CSV fields as text plus an arrival stamp.
Values missing from a file (absent column, empty field) become ``''``,
never NULL, as the upload front end wrote them.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.schemas import CSV_HEADERS, LANDING_COLUMNS
from starloom.session import cut_lineage


def _stamp(batch_ts: datetime | str | Column | None) -> Column:
    if batch_ts is None:
        return F.current_timestamp()
    if isinstance(batch_ts, Column):
        return batch_ts.cast("timestamp")
    return F.lit(batch_ts).cast("timestamp")


def to_landing(raw: DataFrame, batch_ts: datetime | str | Column | None = None) -> DataFrame:
    """Map a CSV-header frame to landing columns; missing or NULL -> ''."""
    present = set(raw.columns)
    cols = [
        (F.coalesce(F.col(f"`{h}`"), F.lit("")) if h in present else F.lit("")).alias(c)
        for h, c in CSV_HEADERS.items()
    ]
    return raw.select(*cols, _stamp(batch_ts).alias("updated_at"))


FILE, BLOCK, LINE = "_file", "_block", "_line"
REASON_FEW, REASON_MANY = "Too few fields", "Too many fields"
REASON_QUOTE, REASON_ENCODING = "Unclosed quote", "Invalid encoding"
_CSV = {"sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


#: A quoted field with the comma before it: quotes open at a field's start alone.
_QUOTED_FIELD = r'(^|,)"[^"]*+(?:""[^"]*+)*+"(?=,|$)'


def with_origin(lines: DataFrame) -> DataFrame:
    """A text scan (batch or stream) with each line's file and the start of its block in it."""
    return lines.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Lines of CSV files (``value``, file and block), each parsed by its own file's header: the landing text columns, ``record`` (the line),
    ``malformed`` (a reason or NULL) and the other columns of ``lines``.

    A file's header is its first line that is not blank: the least line number of the block at 0, found for all files by one partial aggregation. The
    headers (a row a file) are written, so their size is known, and joined back by file. Two jobs, whatever the number of files.
    """
    text = F.col("value")
    numbered = lines.filter(F.trim(text) != "").withColumn(LINE, F.monotonically_increasing_id())
    named = numbered.filter(F.col(BLOCK) == 0).groupBy(FILE).agg(
        F.min_by(F.regexp_replace("value", "^\uFEFF", ""), LINE).alias("_header"), F.min(LINE).alias("_first"))
    named = cut_lineage(named, "headers")
    # One number: no header has more fields than commas and one.
    width = (named.agg(F.max(F.regexp_count("_header", F.lit(",")))).first()[0] or 0) + 1
    schema = ", ".join(f"c{i} string" for i in range(width + 1))
    fields = lambda c: F.from_csv(c, schema, _CSV)
    as_list = lambda c: F.array(*[F.col(f"{c}.c{i}") for i in range(width + 1)])
    bare = lambda c: F.regexp_replace(c, _QUOTED_FIELD, "$1")
    count = lambda c: F.regexp_count(bare(c), F.lit(",")) + 1
    known = named.select(FILE, "_first", count(F.col("_header")).alias("_asked"), fields(F.col("_header")).alias("_names"))
    known = known.withColumn("_names", as_list("_names"))
    rows = (numbered.join(known, FILE).filter((F.col(BLOCK) != 0) | (F.col(LINE) != F.col("_first")))
            .withColumn("_csv", fields(text)).withColumn("_fields", as_list("_csv")))
    at = lambda h: F.array_position("_names", h).cast("int")
    found = [F.coalesce(F.try_element_at("_fields", F.nullif(at(h), F.lit(0))), F.lit("")).alias(c) for h, c in CSV_HEADERS.items()]
    given, asked = count(text), F.col("_asked")
    reason = (F.when(~F.is_valid_utf8(text), REASON_ENCODING).when(bare(text).rlike('(^|,)"'), REASON_QUOTE)
              .when(given < asked, REASON_FEW).when(given > asked, REASON_MANY))
    kept = [c for c in lines.columns if c not in ("value", FILE, BLOCK)]
    return rows.select(*kept, *found, F.make_valid_utf8(text).alias("record"), reason.alias("malformed"))


def landing_of(parsed: DataFrame, batch_ts: datetime | str | Column | None = None, malformed: str = "keep") -> DataFrame:
    """Landing rows of ``parse_lines``. ``keep``: short rows are filled with '' and surplus fields dropped, as the source does;
    ``reject``: malformed rows are left out (``malformed_of`` has them)."""
    if malformed not in ("keep", "reject"):
        raise ValueError(f"unknown option malformed={malformed!r}")
    rows = parsed.filter(F.col("malformed").isNull()) if malformed == "reject" else parsed
    return rows.select(*CSV_HEADERS.values(), _stamp(batch_ts).alias("updated_at"))


def malformed_of(parsed: DataFrame, batch_ts: datetime | str | Column | None = None) -> DataFrame:
    """The malformed records in the shape of rejected rows: the fields read so far, the reason, the arrival, and the line itself."""
    stamp = _stamp(batch_ts)
    return parsed.filter(F.col("malformed").isNotNull()).select(
        *CSV_HEADERS.values(), F.col("malformed").alias("error_reason"), stamp.alias("logged_at"), stamp.alias("executed_time"), "record")


def read_landing_csv(spark: SparkSession, paths: str | Sequence[str], batch_ts: datetime | str | Column | None = None,
                     multi_line: bool = False, malformed: str = "keep") -> DataFrame:
    """Read one or many CSV files (header row, quoted commas) as landing rows.

    Columns are matched by header name, file by file (``parse_lines``). ``multi_line`` accepts quoted line breaks with plain
    CSV readers, one a header; it is off by default because such files cannot be split and each one's header is read by a job.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    stamp = F.lit(datetime.now(timezone.utc)) if batch_ts is None else batch_ts
    if not multi_line:
        return landing_of(parse_lines(with_origin(spark.read.text(paths))), stamp, malformed)
    reader = (
        spark.read.option("header", True).option("inferSchema", False)
        .option("quote", '"').option("escape", '"').option("multiLine", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    )
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in sorted(spark.read.text(paths).inputFiles()):
        by_header.setdefault(tuple(reader.csv(file).columns), []).append(file)
    if not by_header:
        return to_landing(reader.csv(paths), batch_ts)
    return reduce(DataFrame.unionByName, [to_landing(reader.csv(files), stamp) for files in by_header.values()])


def write_landing_csv(df: DataFrame, path: str, compression: str | None = None, rows_a_file: int = 0) -> None:
    """Write landing rows back out as CSV with the original headers. A compressed file cannot be split: ``rows_a_file`` (0: no limit) keeps each short."""
    out = df.select(*[F.col(c).alias(h) for h, c in CSV_HEADERS.items()])
    (out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("maxRecordsPerFile", rows_a_file).csv(path, compression=compression))


def load_landing(spark: SparkSession, paths: str | Sequence[str], target: str,
                 batch_ts: datetime | str | Column | None = None, batch_id: int | None = None) -> DataFrame:
    """O-01: read CSVs, stamp arrival, append to the landing table at ``target``.

    With ``batch_id`` the rows go to the table's partition of that batch, which a retry overwrites: a file is never landed twice.
    """
    df = read_landing_csv(spark, paths, batch_ts)
    if batch_id is None:
        df.write.mode("append").parquet(target)
    else:
        (df.withColumn("batch_id", F.lit(batch_id)).write.partitionBy("batch_id").mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").parquet(target))
    return df


__all__ = ["LANDING_COLUMNS", "to_landing", "read_landing_csv", "write_landing_csv", "load_landing", "with_origin", "parse_lines",
           "landing_of", "malformed_of"]
