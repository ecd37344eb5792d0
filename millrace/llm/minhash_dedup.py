"""Near-duplicate documents by b-bit MinHash.

1. Each text becomes its set of distinct five-word shingles (64-bit fingerprints), a 128-bit name of the set, 128 minima over it, the low two bits of
   each minimum packed into four 64-bit words, and one key per band of three minima. Only these are stored, not the sets.
2. Documents with equal sets share one name and from here on count as one node, so exact copies cost one row.
3. Nodes that share a band key are candidates. Each is compared with the smallest node of its bucket: bit counts of the
   packed words give the share of equal low bits, corrected for chance agreement, and pairs whose estimate is more than
   ``SIGMAS`` deviations below the bound are left.
4. The remaining pairs are confirmed on their full sets, read from the texts once more.
5. Buckets that still hold nodes of different components are compared in full, in blocks: packed signatures choose the
   pairs, full sets confirm them, and only edges that unite two components leave the block. So no pair of a bucket goes
   unseen, and no bucket gives out its pairs.

A pair at similarity 0.75 shares no band with probability (1 - 0.75**3)**24 = 2e-6.

Hot groups: equal sets are merged by a partial aggregate; joins on band keys and on hubs are plain sort-merge joins, which
adaptive execution splits; large buckets are cut into parts of ``PART_SHINGLES``.

Defined results
    * a text of fewer than five words is one shingle, its whole word sequence;
    * a null, empty or blank text has an empty set, is linked with nothing and is kept;
    * a row with a null id is linked with nothing: ``component_id`` is null and it is kept;
    * rows that repeat an id are judged one by one and share the component of their text;
    * other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from millrace.llm import bytescan, columns
from millrace.session import checkpointed

WORDS = 5
PERCENT = 75
MINIMA, BITS, BANDS, ROWS = 128, 2, 24, 3
WORDS64 = MINIMA * BITS // 64
SIGMAS = 4.5
#: So many shingles of a bucket make one part; two parts meet in a task (16 bytes a shingle).
PART_SHINGLES = 1 << 18
#: Up to so many rows of one or two ids (8 bytes each) are sent to every executor; beyond it, the join is shuffled.
BROADCAST_IDS = 2_000_000

_MULTIPLY = bytescan.mixed(np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(2654435761)) | np.uint64(1)
_ADD = bytescan.mixed(np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(40503))
SIGNATURE = [f"s{k}" for k in range(WORDS64)]


def least_agreement() -> int:
    """Equal positions that a pair at the bound has at least, but for ``SIGMAS`` deviations."""
    p = PERCENT / 100
    agree = p + (1 - p) / (1 << BITS)
    return int(np.floor(MINIMA * agree - SIGMAS * np.sqrt(MINIMA * agree * (1 - agree))))


def estimate(agreeing: Column) -> Column:
    """Similarity from the number of equal positions, corrected for those that agree by chance."""
    chance = 1.0 / (1 << BITS)
    return (agreeing / F.lit(MINIMA) - chance) / (1 - chance)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], list[bytes | None]]:
    """For each text the sorted distinct fingerprints of its shingles, and 128 bits that stand for the set (None if it is empty).

    The two halves of the latter come from independent fingerprints of the shingles, so that two sets which are one by
    chance in the first are told apart by the second.
    """
    scan = bytescan.Scan(data, offsets, lower=True)
    hashes = [scan.word_hashes(f) for f in range(2)]
    starts, keys = bytescan.windows(hashes[0], scan.word_at, WORDS)
    others = bytescan.windows(hashes[1], scan.word_at, WORDS)[1]
    at = np.searchsorted(starts, scan.word_at)
    sets, names = [], []
    for i in range(scan.count):
        first, behind = scan.word_at[i], scan.word_at[i + 1]
        if behind - first >= WORDS:
            one, which = np.unique(keys[at[i] : at[i + 1]], return_index=True)
            two = others[at[i] : at[i + 1]][which]
        elif behind > first:
            one, two = (bytescan.windows(h[first:behind], np.array([0, behind - first]), int(behind - first))[1] for h in hashes)
        else:
            one = two = np.zeros(0, np.uint64)
        sets.append(one)
        names.append(_set_name(one, two) if len(one) else None)
    return sets, names


def _set_name(one: np.ndarray, two: np.ndarray) -> bytes:
    size = np.uint64(len(one))
    halves = [bytescan.mixed(bytescan.mixed(x + np.uint64(17 + k)).sum(keepdims=True) + size) for k, x in enumerate((one, two))]
    return np.concatenate(halves).tobytes()


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """One row of minima for each set; the sets must not be empty."""
    joined = np.concatenate(sets)
    at = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), MINIMA), np.uint64)
    for k in range(MINIMA):
        out[:, k] = np.minimum.reduceat(joined * _MULTIPLY[k] + _ADD[k], at)
    return out


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of all minima, side by side in 64-bit words."""
    low = bytescan.mixed(least) & np.uint64((1 << BITS) - 1)
    shifts = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
    return (low.reshape(len(least), WORDS64, 64 // BITS) << shifts).sum(axis=2, dtype=np.uint64)


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = least[:, : BANDS * ROWS].reshape(len(least), BANDS, ROWS)
    return bytescan.mixed((bytescan.mixed(rows) * bytescan.CODES[:ROWS]).sum(axis=2, dtype=np.uint64) + bytescan.CODES[:BANDS])


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, set size, set fingerprint (null for an empty set), packed signature and band keys of each row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in bytescan.steps(batch, text):
                sets, names = shingle_sets(data, offsets)
                full = np.array([len(s) > 0 for s in sets])
                key = pa.array(names, pa.binary())
                least = minima([s for s in sets if len(s)]) if full.any() else np.zeros((0, MINIMA), np.uint64)
                words = np.zeros((len(sets), WORDS64), np.int64)
                words[full] = packed(least).view(np.int64)
                keys = band_keys(least).view(np.int64)
                at = np.concatenate([[0], np.cumsum(np.where(full, BANDS, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), key, *(pa.array(words[:, k]) for k in range(WORDS64)), pa.ListArray.from_arrays(at, keys.ravel())],
                    names=["doc_id", "n_shingles", "node", *SIGNATURE, "bands"],
                )
        bytescan.rest()

    schema = "doc_id long, n_shingles long, node binary, " + ", ".join(f"{s} long" for s in SIGNATURE) + ", bands array<long>"
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias(text)).mapInArrow(scan, schema)


def _sent(ids: DataFrame) -> DataFrame:
    """``ids`` to be broadcast where they are few enough, so that the texts need not be shuffled for them."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def _sets(documents: DataFrame, wanted: DataFrame, id_col: str, text: str) -> DataFrame:
    """Node and full set, for the nodes of ``wanted`` (node, doc_id: one row that has this set)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in bytescan.steps(batch, text):
                sets, names = shingle_sets(data, offsets)
                at = np.cumsum([0, *(len(s) for s in sets)]).astype(np.int32)
                values = np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)
                got = pa.array(names, pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), got, pa.ListArray.from_arrays(at, values)], names=["node", "got", "shingles"])

    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias(text))
    found = rows.join(_sent(wanted), "doc_id").select("node", text).mapInArrow(scan, "node binary, got binary, shingles array<long>")
    # an id may be repeated with another text, or the row itself may be repeated
    return found.where("node = got").groupBy("node").agg(F.first("shingles").alias("shingles"))


def _confirmed(pairs: DataFrame, nodes: DataFrame, documents: DataFrame, id_col: str, text: str) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = checkpointed(wanted.join(nodes.select("node", "doc_id"), "node"))
    sets = checkpointed(_sets(documents, wanted, id_col, text))
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(100 * shared >= PERCENT * (F.size("x") + F.size("y") - shared)).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """Node and the smallest node it reaches, for all nodes of ``edges`` (a, b).

    Every round takes the smallest label among neighbours and then the label's own label, so far ends meet in a number of
    rounds that grows with the logarithm of the distance in practice. Ends when a round changes nothing.
    """
    both = checkpointed(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = checkpointed(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near")).withColumnRenamed("a", "node")
        step = labels.join(near, "node").select("node", F.col("label").alias("before"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        step = checkpointed(step.join(jump, "label", "left").select("node", "before", F.least("label", F.coalesce("beyond", "label")).alias("label")))
        labels = step.select("node", "label")
        if step.where("label <> before").limit(1).count() == 0:
            return labels


def _in_blocks(members: DataFrame, nodes: DataFrame, documents: DataFrame, id_col: str, text: str) -> DataFrame:
    """Edges between different components within each bucket of ``members`` (key, node, label).

    A bucket is cut into parts of about ``PART_SHINGLES`` shingles; every two parts meet in one group, which holds their
    signatures and sets. There the packed signatures choose the pairs to confirm, and only confirmed pairs that unite two
    components come out, so a group gives fewer rows than it has nodes.
    """
    wanted = checkpointed(members.select("node").distinct().join(nodes.select("node", "doc_id"), "node"))
    sets = checkpointed(_sets(documents, wanted, id_col, text))
    sized = members.join(nodes.select("node", "n_shingles"), "node")
    parts = sized.groupBy("key").agg(F.ceil(F.sum("n_shingles") / F.lit(PART_SHINGLES)).cast("int").alias("parts"))
    cut = sized.join(parts, "key").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    cut = cut.select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "label")
    blocks = cut.join(nodes.select("node", *SIGNATURE), "node").join(sets, "node")
    least = least_agreement()

    def compare(table: pa.Table) -> pa.Table:
        column = {c: table[c].combine_chunks() for c in table.schema.names}
        node, mine = column["node"].to_pylist(), column["mine"].to_numpy()
        sign = np.stack([column[s].to_numpy() for s in SIGNATURE], axis=1).view(np.uint64)
        size = np.diff(column["shingles"].offsets.to_numpy())
        ids = np.unique(column["shingles"].flatten().to_numpy(), return_inverse=True)[1]
        starts = np.cumsum(size) - size
        part = np.array(column["label"].dictionary_encode().indices)
        mark = np.zeros(len(ids) + 1, np.int32)
        i, j = column["i"][0].as_py(), column["j"][0].as_py()
        left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        edges = []
        for at, x in enumerate(left):
            others = right[at + 1 :] if i == j else right
            odd = sign[others] ^ sign[x]
            unequal = np.bitwise_count((odd | (odd >> np.uint64(1))) & np.uint64(0x5555555555555555)).sum(axis=1)
            hits = others[(MINIMA - unequal.astype(np.int64) >= least) & (part[others] != part[x])]
            if not len(hits):
                continue
            own = ids[starts[x] : starts[x] + size[x]]
            mark[own] = 1
            if len(hits) < len(size) // 4:
                shared = np.array([mark[ids[starts[y] : starts[y] + size[y]]].sum() for y in hits])
            else:
                shared = np.add.reduceat(mark[ids], starts)[hits]
            mark[own] = 0
            for y in hits[100 * shared >= PERCENT * (size[x] + size[hits] - shared)]:
                if part[y] != part[x]:
                    edges.append((node[x], node[y]))
                    part[part == part[y]] = part[x]
        return pa.table({"a": pa.array([min(e) for e in edges], pa.binary()), "b": pa.array([max(e) for e in edges], pa.binary())})

    return blocks.groupBy("key", "i", "j").applyInArrow(compare, "a binary, b binary").distinct()


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: doc_id, n_shingles, component_id and kept (it is its component's smallest id)."""
    return _judged(documents, id_col, text).drop("node", "part")


def _judged(documents: DataFrame, id_col: str, text: str) -> DataFrame:
    """:func:`near_duplicates` with the fingerprint of the row's set and that of its component."""
    base = checkpointed(fingerprints(documents, id_col, text))
    nodes = checkpointed(
        base.where("node is not null and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), *(F.first(c).alias(c) for c in ("n_shingles", *SIGNATURE, "bands")))
    )
    banded = nodes.select(F.explode("bands").alias("key"), "node")
    buckets = banded.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("far"), F.count("*").alias("size")).where("hub < far").drop("far")
    members = checkpointed(banded.join(buckets, "key"))

    stars = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    for end in ("a", "b"):
        stars = stars.join(nodes.select(F.col("node").alias(end), *(F.col(s).alias(f"{end}{s}") for s in SIGNATURE)), end)
    odd = [F.col(f"a{s}").bitwiseXOR(F.col(f"b{s}")) for s in SIGNATURE]
    unequal = sum((F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))) for x in odd), F.lit(0))
    stars = checkpointed(stars.where(MINIMA - unequal >= least_agreement()).select("a", "b"))
    edges = checkpointed(_confirmed(stars, nodes, documents, id_col, text))

    labels = components(edges)
    left = members.where("size > 2").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    open_buckets = left.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    more = checkpointed(_in_blocks(left.join(open_buckets, "key").select("key", "node", "label"), nodes, documents, id_col, text))
    if more.limit(1).count():
        labels = components(edges.union(more))

    named = labels.join(nodes.select("node", "doc_id"), "node")
    lowest = named.groupBy("label").agg(F.min("doc_id").alias("lowest"))
    owner = nodes.select("node", "doc_id").join(named.join(lowest, "label").select("node", "lowest", "label"), "node", "left")
    owner = owner.select("node", F.coalesce("lowest", "doc_id").alias("lowest"), F.coalesce("label", "node").alias("part"))
    out = base.select("doc_id", "n_shingles", "node").join(owner, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("lowest", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), "node", "part").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _with_node(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the set fingerprint of each row."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in bytescan.steps(batch, text):
                key = pa.array(shingle_sets(data, offsets)[1], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, key], names=[*part.schema.names, "_node"])
        bytescan.rest()

    return docs.mapInArrow(scan, StructType([*docs.schema.fields, StructField("_node", BinaryType())]))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, each id once per component; all columns are kept.

    Rows with an empty set or a null id are linked with nothing and stay. Of several rows of a component with its smallest
    id the one with the smallest text stays, then the one whose other columns come first as JSON.
    """
    docs, back = columns.apart(docs, ("_n", "_best", "_gone", "_again", "_id", "_set", "_part", "_row", "_node"))
    id_col, text = ({old: new for new, old in back.items()}.get(c, c) for c in (id_col, text))
    return _kept_rows(docs, id_col, text).withColumnsRenamed(back)


def _kept_rows(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    judged = checkpointed(_judged(docs, id_col, text))
    linked = judged.where("doc_id is not null and n_shingles > 0")
    many = linked.groupBy("doc_id").agg(F.count("*").alias("_n"), F.max(F.col("kept").cast("int")).alias("_best"))
    gone = _sent(checkpointed(many.where("_best = 0").select(F.col("doc_id").alias("_gone"))))
    blank = F.length(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+", "")) == 0
    left = docs.join(gone, (F.col(id_col).cast("long") == F.col("_gone")) & ~blank, "left_anti")
    repeated = many.where("_best = 1 and _n > 1").select(F.col("doc_id").alias("_again"))
    if repeated.limit(1).count() == 0:
        return left
    once = left.join(repeated, F.col(id_col).cast("long") == F.col("_again"), "left_anti")
    # ids given to several rows: each row is judged by its own set, and equal texts and links leave one each
    again = left.join(repeated, F.col(id_col).cast("long") == F.col("_again"), "left_semi")
    own = [F.col(f"`{c}`") for c in docs.columns]
    best = linked.where("kept").join(repeated, F.col("doc_id") == F.col("_again"), "left_semi").select(F.col("doc_id").alias("_id"), F.col("node").alias("_set"), F.col("part").alias("_part")).distinct()
    rows = _with_node(again.where(~blank), text).join(best, (F.col(id_col).cast("long") == F.col("_id")) & (F.col("_node") == F.col("_set")))
    order = F.struct(F.col(text), F.to_json(F.struct(*own), {"ignoreNullFields": "false"}))
    first = rows.groupBy("_id", "_part").agg(F.min_by(F.struct(*own), order).alias("_row")).select("_row.*")
    return once.unionByName(first).unionByName(again.where(blank))
