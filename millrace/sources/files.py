"""File sources and text formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_files(spark: SparkSession, fmt: str, path: str, schema: str | None = None, glob: str | None = None,
               recursive: bool = False, skip_corrupt: bool = False, skip_missing: bool = False, **options) -> DataFrame:
    """Any file format with the options all file sources share."""
    reader = spark.read.format(fmt).options(**options)
    if schema:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    for name, on in (("recursiveFileLookup", recursive), ("ignoreCorruptFiles", skip_corrupt), ("ignoreMissingFiles", skip_missing)):
        if on:
            reader = reader.option(name, "true")
    return reader.load(path)


def fixed_records(spark: SparkSession, path: str, length: int, glob: str | None = None) -> DataFrame:
    """Files cut into records of ``length`` bytes: (path, record_no, record), by Spark's own readers. A short last record is
    dropped.

    Whole files pass through one row each, so keep files below the binary reader's limit of 2 GB; ``records.read_records``
    reads files of any size, by ranges.
    """
    files = read_files(spark, "binaryFile", path, glob=glob).where(F.col("length") >= length)
    numbers = F.sequence(F.lit(0).cast("bigint"), F.floor(F.col("length") / length) - 1)
    cut = files.select("path", "content", F.explode(numbers).alias("record_no"))
    return cut.select("path", "record_no", F.substring(F.col("content"), (F.col("record_no") * length + 1).cast("int"), F.lit(length)).alias("record"))


def edge_list(spark: SparkSession, path: str, canonical: bool = False) -> DataFrame:
    """Edges from text lines of two numbers; ``#`` starts a comment. With ``canonical``, src < dst."""
    lines = spark.read.text(path).select(F.trim("value").alias("line")).where("line <> '' AND NOT startswith(line, '#')")
    parts = F.split("line", r"\s+")
    edges = lines.select(parts[0].cast("bigint").alias("src"), parts[1].cast("bigint").alias("dst"))
    if canonical:
        edges = edges.select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
    return edges


def regex_table(spark: SparkSession, path: str, pattern: str, columns: list[str]) -> DataFrame:
    """Text lines matched by a pattern of N groups as N string columns; a line that does not match gives nulls."""
    whole = F.col("value").rlike(f"^(?:{pattern})$")
    return spark.read.text(path).select(
        *[F.when(whole, F.regexp_extract("value", f"^(?:{pattern})$", i)).alias(c) for i, c in enumerate(columns, 1)])


def write_delimited(df: DataFrame, path: str, field: str = "\x01", item: str = "\x02", key: str = "\x03", null: str = "\\N",
                    escape: str | None = None, line: str = "\n") -> None:
    """Delimited text with separate marks for fields, array items, map keys and lines, and a mark for missing values.

    With ``escape``, one character, a value may hold any of the marks, the escape itself and line ends: each gets the escape
    put before it (line ends as ``n`` and ``r``, the mark of lines as ``l``). A value that reads like the mark for missing values is escaped too.
    Without it, values that hold a mark cannot be told from the marks, and such a value raises when the rows are written.
    """
    marks = [field, item, key, line]
    if escape is not None and (len(escape) != 1 or escape in "".join([*marks, "nrl"])):
        raise ValueError("the escape is one character that is no mark, n, r or l")

    def value(c: Column) -> Column:
        text = c.cast("string")
        if escape is None:
            held = [F.contains(text, F.lit(m)) for m in dict.fromkeys([*marks, "\n"])]
            bad = held[0]
            for h in held[1:]:
                bad = bad | h
            return F.when(bad, F.raise_error(F.concat(F.lit("a value holds a mark: "), text))).otherwise(text)
        plain = text
        for old, new in [(escape, escape * 2), *((m, escape + m) for m in dict.fromkeys(marks[:3])), ("\n", f"{escape}n"), ("\r", f"{escape}r"), (line, f"{escape}l")]:
            plain = F.replace(plain, F.lit(old), F.lit(new))
        return F.when(text == null, F.lit(escape + null)).otherwise(plain)

    def as_text(c: str) -> Column:
        kind = df.schema[c].dataType.typeName()
        col = F.col(f"`{c}`")
        if kind == "array":
            text = F.array_join(F.transform(col, lambda x: F.coalesce(value(x), F.lit(null))), item)
        elif kind == "map":
            text = F.array_join(F.transform(F.map_entries(col), lambda e: F.concat_ws(key, value(e["key"]), F.coalesce(value(e["value"]), F.lit(null)))), item)
        else:
            text = value(col)
        return F.coalesce(text, F.lit(null))

    df.select(F.concat_ws(field, *[as_text(c) for c in df.columns]).alias("line")).write.option("lineSep", line).text(path)


def read_delimited(spark: SparkSession, path: str, columns: dict[str, str], field: str = "\x01", item: str = "\x02",
                   key: str = "\x03", null: str = "\\N", escape: str | None = None, line: str = "\n") -> DataFrame:
    """Read what ``write_delimited`` wrote with the same marks; values that do not parse give null."""
    def quoted(text: str) -> str:
        return "\\Q" + text + "\\E"

    def parts(text: Column, mark: str) -> Column:
        if escape is None:
            return F.split(text, quoted(mark), -1)
        # pieces that end with a mark before which no escape stands
        return F.regexp_extract_all(F.concat(text, F.lit(mark)), F.lit(f"(?s)((?:{quoted(escape)}.|(?!{quoted(mark)}).)*+){quoted(mark)}"), F.lit(1))

    def value(text: Column) -> Column:
        own = F.when(text == null, None).otherwise(text)
        if escape is None:
            return own
        back = F.when(own == escape + null, null)
        # every escape begins a pair; between pairs of escapes all others stand before what they are for
        pieces = F.transform(F.split(own, quoted(escape * 2), -1), lambda p: unmarked(p))
        return F.coalesce(back, F.array_join(pieces, escape))

    def unmarked(piece: Column) -> Column:
        for old, new in ((f"{escape}n", "\n"), (f"{escape}r", "\r"), (f"{escape}l", line), (escape, "")):
            piece = F.replace(piece, F.lit(old), F.lit(new))
        return piece

    def typed(i: int, kind: str) -> Column:
        raw = F.get(parts(F.col("value"), field), F.lit(i))
        kind = kind.strip().lower()
        if kind.startswith("array<"):
            items = F.when(raw == "", F.array().cast("array<string>")).otherwise(parts(raw, item))
            return F.when(raw != null, F.transform(items, lambda x: value(x).try_cast(kind[6:-1])))
        if kind.startswith("map<"):
            key_kind, value_kind = (k.strip() for k in kind[4:-1].split(",", 1))
            pairs = F.transform(F.when(raw == "", F.array().cast("array<string>")).otherwise(parts(raw, item)), lambda x: parts(x, key))
            entries = F.transform(pairs, lambda x: F.struct(value(F.get(x, F.lit(0))).try_cast(key_kind).alias("key"), value(F.get(x, F.lit(1))).try_cast(value_kind).alias("value")))
            return F.when(raw != null, F.map_from_entries(entries))
        return value(raw).try_cast(kind)

    return spark.read.option("lineSep", line).text(path).select(*[typed(i, kind).alias(c) for i, (c, kind) in enumerate(columns.items())])


def read_jdbc(spark: SparkSession, url: str, table: str, column: str | None = None, low=None, high=None, parts: int = 1, **properties) -> DataFrame:
    """A database table read in ranges of a numeric column. The dialect follows from the URL."""
    if column:
        return spark.read.jdbc(url, table, column=column, lowerBound=low, upperBound=high, numPartitions=parts, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)
