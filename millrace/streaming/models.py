"""Models kept up to date batch by batch. A batch is reduced on Spark to a few sums per centre or coefficient.

The state of a model is rows in the shared folder, one version per batch id, beside the stream's checkpoint. A batch reads the
version of the batch before it and writes its own; so a batch that runs again, because the query was ended between the write
and the commit, starts from the same version and counts once, and a restarted query goes on where the last one stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from millrace.operators.features import centre_means, nearest_centre
from millrace.session import scratch_path
from millrace.streaming.sinks import run_batches

#: rows of a model, and how the rows of one batch change them
State = list[tuple]
Fold = Callable[[State, DataFrame], State]


class Versions:
    """The versions of a model: ``batch=<id>`` folders of a few rows each. Batch -1 is the start."""

    def __init__(self, spark: SparkSession, folder: str, schema: str, start: State):
        self.folder, self.schema, self.size = folder, schema, len(start)
        self.write(spark, -1, start)

    def _rows(self, spark: SparkSession, which: str) -> list[Row]:
        return spark.read.schema(f"{self.schema}, batch bigint").option("basePath", self.folder).parquet(f"{self.folder}/batch={which}").collect()

    def at(self, spark: SparkSession, batch_id: int) -> tuple[State, State | None]:
        """The state before a batch, and the one behind it if that is stored as a whole."""
        rows = self._rows(spark, f"{{{batch_id - 1},{batch_id}}}")
        before, own = ([tuple(r)[:-1] for r in rows if r["batch"] == b] for b in (batch_id - 1, batch_id))
        if len(before) != self.size:
            raise RuntimeError(f"{self.folder} lacks the version before batch {batch_id}")
        return before, own if len(own) == self.size else None

    def write(self, spark: SparkSession, batch_id: int, state: State) -> None:
        spark.createDataFrame(state, self.schema).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")

    def last(self, spark: SparkSession) -> State:
        rows = spark.read.schema(f"{self.schema}, batch bigint").option("basePath", self.folder).parquet(f"{self.folder}/batch=*")
        return [tuple(r)[:-1] for r in rows.where(F.col("batch") == rows.agg(F.max("batch")).first()[0]).collect()]


def run_model(stream: DataFrame, fold: Fold, schema: str, start: State, checkpoint: str | None = None, after: Callable[[int], None] | None = None) -> State:
    """Fold all batches into a model and return its last version; with the checkpoint of an earlier run, go on from there.

    ``start`` has as many rows as every version. ``after`` is called when a batch's version is stored, before its commit.
    """
    spark = stream.sparkSession
    checkpoint = checkpoint or scratch_path(spark, "stream-checkpoint")
    versions = Versions(spark, f"{checkpoint}-model", schema, start)

    def learn(batch: DataFrame, batch_id: int) -> None:
        before, own = versions.at(batch.sparkSession, batch_id)
        if own is None:
            versions.write(batch.sparkSession, batch_id, fold(before, batch))
        if after is not None:
            after(batch_id)

    run_batches(stream, learn, checkpoint=checkpoint)
    return versions.last(spark)


def streaming_kmeans(stream: DataFrame, vector: str, centres: list[list[float]], decay: float = 1.0, checkpoint: str | None = None,
                     after: Callable[[int], None] | None = None) -> tuple[list[list[float]], list[float]]:
    """Centres and weights after all batches: each centre moves to the weighted mean of its past and its new points.

    ``decay`` is the weight that a batch leaves to what came before it.
    """

    def learn(state: State, batch: DataFrame) -> State:
        state = sorted(state)
        places = [list(c) for _, _, c in state]
        assigned = batch.select(vector, nearest_centre(F.col(vector), places).alias("c"))
        counts = {r["c"]: r["n"] for r in assigned.groupBy("c").agg(F.count("*").alias("n")).collect()}
        for r in centre_means(assigned, vector, "c").collect():
            old, new = state[r["c"]][1] * decay, counts[r["c"]]
            places[r["c"]][r["i"]] = (places[r["c"]][r["i"]] * old + r["x"] * new) / (old + new)
        return [(c, weight * decay + counts.get(c, 0), places[c]) for c, weight, _ in state]

    start = [(i, 0.0, [float(x) for x in c]) for i, c in enumerate(centres)]
    state = sorted(run_model(stream, learn, "cluster int, weight double, centre array<double>", start, checkpoint, after))
    return [list(c) for _, _, c in state], [w for _, w, _ in state]


def streaming_regression(stream: DataFrame, x: str, y: str, checkpoint: str | None = None, after: Callable[[int], None] | None = None) -> dict[str, float]:
    """Slope and intercept of a line from moments kept across batches; rows with a missing value count for nothing.

    The moments are centred and merged, so a large common offset of the values costs no digits.
    """
    a, b = F.col(x).cast("double"), F.col(y).cast("double")

    def learn(state: State, batch: DataFrame) -> State:
        n, mx, my, sxx, sxy = state[0]
        rows = batch.where(a.isNotNull() & b.isNotNull())
        m = rows.agg(F.count("*").alias("n"), F.avg(a).alias("x"), F.avg(b).alias("y"), F.var_pop(a).alias("xx"), F.covar_pop(a, b).alias("xy")).first()
        if not m["n"]:
            return state
        total, dx, dy = n + m["n"], m["x"] - mx, m["y"] - my
        share = n * m["n"] / total
        return [(total, mx + dx * m["n"] / total, my + dy * m["n"] / total, sxx + m["xx"] * m["n"] + dx * dx * share, sxy + m["xy"] * m["n"] + dx * dy * share)]

    _, mx, my, sxx, sxy = run_model(stream, learn, "n double, x double, y double, xx double, xy double", [(0.0, 0.0, 0.0, 0.0, 0.0)], checkpoint, after)[0]
    slope = sxy / sxx if sxx else float("nan")
    return {"slope": slope, "intercept": my - slope * mx}
