"""Generators and row transforms."""

from __future__ import annotations

import shlex

from pyspark.sql import Column, DataFrame, functions as F


def lateral(df: DataFrame, generator: Column, names: list[str], keep: list[str] | None = None) -> DataFrame:
    """LATERAL VIEW: each row with the rows its generator gives; use an ``_outer`` generator to keep empty ones."""
    made = generator.alias(*names) if len(names) > 1 else generator.alias(names[0])
    return df.select(*(keep or df.columns), made)


def unstack(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """Columns to rows."""
    return df.unpivot(keys, columns, name, value)


ESCAPES = [("\\", "\\134"), ("\t", "\\011"), ("\n", "\\012"), ("\r", "\\015")]
FILTERS = {
    "cat": ["cat"],
    "upper": ["tr", "[:lower:]", "[:upper:]"],
    "reverse_fields": ["awk", "-F\\t", "{for (i = NF; i > 1; i--) printf \"%s\\t\", $i; print $1}"],
}


def through_script(df: DataFrame, script: str, schema: str) -> DataFrame:
    """Stream the rows of each partition, tab separated, through one of the fixed commands in ``FILTERS``: one process for each task.

    Missing values travel as ``\\N``; tabs, line ends and backslashes as octal escapes such as ``\\011``, which the commands
    leave alone, so every value comes back whole. Output fields are strings, cast to ``schema``; fields that are missing at the
    end of a line are null, and more than the schema has are left out.
    """
    fields = [part.strip().split()[0] for part in schema.split(",")]

    def replaced(c: Column, pairs) -> Column:
        for old, new in pairs:
            c = F.replace(c, F.lit(old), F.lit(new))
        return c

    # the backslash is escaped first and restored last
    clean = [replaced(F.col(f"`{c}`").cast("string"), ESCAPES).alias(c) for c in df.columns]
    command = shlex.join(FILTERS[script]).replace("\\", "\\\\").replace('"', '\\"').replace("{", "{{").replace("}", "}}")
    form = r"""ROW FORMAT DELIMITED FIELDS TERMINATED BY '\t' LINES TERMINATED BY '\n' NULL DEFINED AS '\\N'"""
    names = ", ".join(f"`{c}`" for c in df.columns)
    raw = df.sparkSession.sql(f"""SELECT TRANSFORM({names}) {form} USING "{command}" AS ({", ".join(f"{f} string" for f in fields)}) {form} FROM {{rows}}""", rows=df.select(*clean))
    casts = [part.strip().split(None, 1) for part in schema.split(",")]
    whole = raw.select(*[replaced(F.col(n), [(new, old) for old, new in reversed(ESCAPES)]).alias(n) for n, _ in casts])
    return whole.select(*[F.expr(f"try_cast({n} AS {kind})").alias(n) for n, kind in casts])
