"""CSV in, with the lines that don't fit set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

CORRUPT = "_corrupt_record"
#: What a line set aside keeps.
REJECTED = "file string, line string, reason string"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of headed CSV files.

    A line whose fields are too few, too many or of another type is no row; it goes to ``rejected`` with its file and the
    first thing that is wrong with it. Every line is in one of both. Empty fields are NULL; empty lines are skipped. Fields
    don't run over line ends.
    """
    kind = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    with_corrupt = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in kind], T.StructField(CORRUPT, T.StringType())])
    parsed = (spark.read.schema(with_corrupt).option("header", header).option("mode", "PERMISSIVE").option("columnPruning", False)
              .option("escape", '"').option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    names = [f"`{f.name}`" for f in kind]
    # Spark looks at the fields of asked columns only; this asks for all, so that a line is good or bad for all queries alike
    looked_at = F.size(F.array(*[F.col(n).cast("string") for n in names])) == len(names)
    rows = parsed.where(looked_at & F.col(CORRUPT).isNull()).select(*names)
    bad = parsed.where(F.col(CORRUPT).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"), F.col(CORRUPT).alias("line"), _reason(kind, F.col(CORRUPT)).alias("reason"))
    return rows, bad


def _reason(kind: T.StructType, line: Column) -> Column:
    """The number of fields, or the first field that has a text but no value."""
    n = len(kind)
    plain = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    fields = F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit(""))) + 1
    texts = F.from_csv(line, F.lit(", ".join(f"c{i} string" for i in range(n))), {"escape": '"'})
    wrong = [F.when(texts[f"c{i}"].isNotNull() & F.col(f"`{f.name}`").isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}"))
             for i, f in enumerate(kind)]
    return (F.when(fields < n, F.concat(F.lit("too few fields: "), fields.cast("string"), F.lit(f" of {n}")))
            .when(fields > n, F.concat(F.lit("too many fields: "), fields.cast("string"), F.lit(f" of {n}")))
            .otherwise(F.coalesce(*wrong, F.lit("malformed"))))


def load_csv(warehouse, path: str, schema: T.StructType | str, layer: str, table: str, header: bool = True) -> dict[str, int]:
    """Land CSV files in a table; lines set aside go to ``<table>_REJECTED``. Gives the number of both, counted on the way."""
    rows, rejected = read_csv(warehouse.spark, path, schema, header)
    counts = {}
    for name, target, df in (("rows", table, rows), ("rejected", f"{table}_REJECTED", rejected)):
        seen = Observation()
        warehouse.append(df.observe(seen, F.count(F.lit(1)).alias("n")), layer, target)
        counts[name] = seen.get["n"]
    return counts


def reasons(rejected: DataFrame) -> DataFrame:
    """How many lines of each file were set aside for what."""
    return rejected.groupBy("file", "reason").agg(F.count(F.lit(1)).alias("lines"))

