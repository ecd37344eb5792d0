"""Sources, sinks and table loads: given tables are written to the shared folder in each form and read back."""

from pyspark.sql import functions as F

from millrace.operators import maintenance as om
from millrace.registry import query
from millrace.session import scratch_path
from millrace.sources import files as sf, generate as sg, records as sr
from millrace.sources.tables import parallelized, staged

CUSTOMER = """SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer"""
COLUMNS = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double"


def customers(t):
    return t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal")


def round_trip(t, fmt, **options):
    path = staged(customers(t), fmt, fmt, **options)
    return sf.read_files(t.spark, fmt, path, COLUMNS, **options)


@query("src_csv", CUSTOMER)
def src_csv(t):
    return round_trip(t, "csv", header="true")


@query("src_json", CUSTOMER)
def src_json(t):
    return round_trip(t, "json")


@query("src_orc", CUSTOMER)
def src_orc(t):
    return round_trip(t, "orc")


@query("src_glob_recursive", """SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey""")
def src_glob_recursive(t):
    path = staged(customers(t).withColumn("seg", F.col("c_nationkey") % 3), "tree", "json", ["seg"])
    return sf.read_files(t.spark, "json", path, COLUMNS, glob="*.json", recursive=True, skip_corrupt=True, skip_missing=True).groupBy(
        "c_nationkey").agg(F.count("*").alias("n"))


@query("src_binary_file", """SELECT sum(strlen(c_name) + 1)::BIGINT AS bytes FROM customer""")
def src_binary_file(t):
    path = staged(t.customer.select("c_name"), "names", "text")
    return sf.read_files(t.spark, "binaryFile", path, glob="*.txt").agg(F.sum("length").alias("bytes"))


@query("src_fixed_records", """SELECT c_custkey, c_name FROM customer""")
def src_fixed_records(t):
    """18-character names and a line end make records of 19 bytes."""
    path = staged(t.customer.select("c_name"), "records", "text")
    name = F.decode(F.substring("record", 1, 18), "UTF-8")
    return sf.fixed_records(t.spark, path, 19, "*.txt").select(F.regexp_extract(name, "([0-9]+)$", 1).cast("bigint").alias("c_custkey"), name.alias("c_name"))


@query("src_fixed_ranges", """SELECT c_custkey, c_name FROM customer""")
def src_fixed_ranges(t):
    """The same records by byte ranges of some hundred bytes, so that each file is read by several tasks."""
    path = staged(t.customer.select("c_name"), "ranges", "text")
    name = F.decode(F.substring("record", 1, 18), "UTF-8")
    found = sr.read_records(t.spark, path, 19, glob="*.txt", range_bytes=4096, chunk_bytes=1000)
    return found.select(F.regexp_extract(name, "([0-9]+)$", 1).cast("bigint").alias("c_custkey"), name.alias("c_name"))


@query("src_text_lines", """SELECT p_name AS value, count(*) AS n FROM part GROUP BY p_name""")
def src_text_lines(t):
    return t.spark.read.text(staged(t.part.select("p_name"), "lines", "text")).groupBy("value").agg(F.count("*").alias("n"))


@query("src_whole_text", """SELECT p_type, count(*) AS lines FROM part GROUP BY p_type""")
def src_whole_text(t):
    path = staged(t.part.select("p_type", F.col("p_name").alias("value")), "whole", "text", ["p_type"])
    docs = t.spark.read.text(path, wholetext=True)
    return docs.groupBy("p_type").agg(F.sum(F.size(F.split("value", "\n")) - 1).cast("bigint").alias("lines"))


@query("src_libsvm", """SELECT count(*) AS n, sum(p_size)::DOUBLE AS sizes FROM part""")
def src_libsvm(t):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows = VectorAssembler(inputCols=["p_size", "p_retailprice"], outputCol="features").transform(
        t.part.withColumn("label", (F.col("p_partkey") % 2).cast("double"))).select("label", "features")
    path = staged(rows, "svm", "libsvm")
    back = t.spark.read.format("libsvm").option("numFeatures", "2").load(path)
    return back.agg(F.count("*").alias("n"), F.sum(vector_to_array("features")[0]).alias("sizes"))


@query("src_image")
def src_image(t):
    """Small bitmaps, one per supplier, drawn from the table, written by the tasks and read as images."""
    path = scratch_path(t.spark, "images")
    spark = t.spark
    # a 24-bit bitmap of 2 x 1 pixels: header fields are fixed, the pixels come from the row
    head = "424d3e000000000000003600000028000000020000000100000001001800000000000800000000000000000000000000000000000000"
    pixels = F.lpad(F.hex(F.pmod(F.col("s_suppkey") * 2654435761, F.lit(1 << 48))), 12, "0")
    lines = t.supplier.select(F.unhex(F.concat(F.lit(head), pixels, F.lit("0000"))).alias("content"), "s_suppkey")

    def save(rows):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(path)
        store.create_dir(root)
        for r in rows:
            with store.open_output_stream(f"{root}/{r.s_suppkey}.bmp") as out:
                out.write(bytes(r.content))

    lines.foreachPartition(save)
    return spark.read.format("image").option("dropInvalid", "true").load(path).select("image.width", "image.height", "image.nChannels")


@query("src_key_value", """SELECT 'quality' AS attribute, quality::VARCHAR AS batch_id, count(*) AS n FROM labels WHERE quality = 1 GROUP BY ALL""")
def src_key_value(t):
    """Rows stored by attribute and batch, then one (attribute, batch) read by partition pruning."""
    path = scratch_path(t.spark, "kv")
    for attribute in ("quality", "toxic"):
        rows = t.labels.select(F.lit(attribute).alias("attribute"), F.col(attribute).cast("string").alias("batch_id"), F.col("doc_id").alias("item_id"))
        staged(rows, "kv", partition_by=["attribute", "batch_id"], mode="append", path=path)
    rows = t.spark.read.schema("item_id bigint, attribute string, batch_id string").parquet(path)
    return rows.where("attribute = 'quality' AND batch_id = '1'").groupBy("attribute", "batch_id").agg(F.count("*").alias("n"))


@query("src_inline_values", """SELECT p_type, w FROM part JOIN (VALUES ('PROMO', 1.5::DOUBLE), ('SMALL', 2.0::DOUBLE)) v(k, w) ON p_type = k GROUP BY ALL""")
def src_inline_values(t):
    weights = t.spark.sql("SELECT * FROM VALUES ('PROMO', CAST(1.5 AS DOUBLE)), ('SMALL', 2) AS v(k, w)")
    return t.part.select("p_type").distinct().join(weights, F.col("p_type") == F.col("k")).select("p_type", "w")


@query("src_range", """SELECT g.k AS k, count(c_custkey) AS n FROM range(0, 25, 2) g(k) LEFT JOIN customer ON c_nationkey = g.k GROUP BY g.k""")
def src_range(t):
    keys = t.spark.range(0, 25, 2, 4).toDF("k")
    counts = t.customer.groupBy(F.col("c_nationkey").cast("bigint").alias("k")).agg(F.count("*").alias("n"))
    return keys.join(counts, "k", "left").na.fill(0, ["n"])


@query("src_edge_list", """SELECT least(o_custkey, o_orderkey) AS src, greatest(o_custkey, o_orderkey) AS dst FROM orders""")
def src_edge_list(t):
    lines = t.orders.select(F.concat_ws(" ", "o_custkey", "o_orderkey").alias("value")).union(t.region.select(F.concat(F.lit("# "), "r_name")))
    return sf.edge_list(t.spark, staged(lines, "edges", "text"), canonical=True)


@query("src_partitioned", """SELECT p_type, p_size, count(*) AS n FROM part WHERE p_type = 'PROMO' AND p_size < 20 GROUP BY ALL""")
def src_partitioned(t):
    path = staged(t.part, "parts", partition_by=["p_type", "p_size"])
    back = t.spark.read.option("basePath", path).parquet(f"{path}/p_type=PROMO")
    return back.where("p_size < 20").groupBy("p_type", "p_size").agg(F.count("*").alias("n"))


@query("src_save_modes", """SELECT (SELECT count(*) FROM nation) * 2 AS appended, (SELECT count(*) FROM region) AS replaced, (SELECT count(*) FROM region) AS kept, true AS refused""")
def src_save_modes(t):
    from pyspark.errors import AnalysisException

    names = t.nation.select(F.col("n_name").alias("name"))
    path = staged(names, "modes")
    staged(names, "modes", mode="append", path=path)
    count = lambda label: t.spark.read.parquet(path).agg(F.count("*").alias(label))
    appended = count("appended").first()[0]
    staged(t.region.select(F.col("r_name").alias("name")), "modes", mode="overwrite", path=path)
    replaced = count("replaced").first()[0]
    staged(names, "modes", mode="ignore", path=path)
    try:
        staged(names, "modes", mode="errorifexists", path=path)
        refused = False
    except AnalysisException:
        refused = True
    return count("kept").select(F.lit(appended).cast("bigint").alias("appended"), F.lit(replaced).cast("bigint").alias("replaced"), "kept", F.lit(refused).alias("refused"))


@query("src_sequence_file", """SELECT o_orderpriority AS k, count(*) AS v FROM orders GROUP BY 1""")
def src_sequence_file(t):
    counts = t.orders.groupBy(F.col("o_orderpriority").alias("k")).agg(F.count("*").alias("v"))
    path = scratch_path(t.spark, "seq")
    counts.rdd.map(lambda row: (row.k, row.v)).saveAsSequenceFile(path)
    return t.spark.createDataFrame(t.spark.sparkContext.sequenceFile(path), "k string, v bigint")


@query("src_delimited", """SELECT p_partkey, p_brand AS brand, nullif(p_type, 'PROMO') AS kind, p_size AS last_item, p_name AS name FROM part""")
def src_delimited(t):
    path = scratch_path(t.spark, "delimited")
    rows = t.part.select("p_partkey", F.array(F.lit(1), F.col("p_size")).alias("items"), F.create_map(F.lit("brand"), "p_brand", F.lit("name"), "p_name").alias("m"),
                         F.expr("nullif(p_type, 'PROMO')").alias("kind"))
    sf.write_delimited(rows, path, field="|", item=";", key="=")
    back = sf.read_delimited(t.spark, path, {"p_partkey": "bigint", "items": "array<int>", "m": "map<string,string>", "kind": "string"}, "|", ";", "=")
    return back.select("p_partkey", F.col("m")["brand"].alias("brand"), "kind", F.element_at("items", -1).alias("last_item"), F.col("m")["name"].alias("name"))


@query("src_delimited_escaped", """SELECT p_partkey, p_name || '|;=' || chr(92) || chr(10) || 'x' || chr(92) AS name, p_brand || ';' AS item, p_type || '=' AS value FROM part""")
def src_delimited_escaped(t):
    """Values that hold every mark, the escape and line ends; lines end with a mark of their own."""
    path = scratch_path(t.spark, "escaped")
    rows = t.part.select("p_partkey", F.concat("p_name", F.lit("|;=\\\nx\\")).alias("name"), F.array(F.lit("\\N"), F.concat("p_brand", F.lit(";"))).alias("items"),
                         F.create_map(F.lit("k="), F.concat("p_type", F.lit("="))).alias("m"))
    how = {"field": "|", "item": ";", "key": "=", "escape": "\\", "null": "NULL", "line": "\x1e"}
    sf.write_delimited(rows, path, **how)
    back = sf.read_delimited(t.spark, path, {"p_partkey": "bigint", "name": "string", "items": "array<string>", "m": "map<string,string>"}, **how)
    return back.where(F.col("items")[0] == "\\N").select("p_partkey", "name", F.col("items")[1].alias("item"), F.col("m")["k="].alias("value"))


@query("src_parallelized", """SELECT n_regionkey, count(*) AS customers FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY n_regionkey""")
def src_parallelized(t):
    """The nations as a local list, cut into slices."""
    rows = [(r["n_nationkey"], r["n_regionkey"]) for r in t.nation.select("n_nationkey", "n_regionkey").orderBy("n_nationkey").limit(1000).collect()]  # the table of nations is short
    local = parallelized(t.spark, rows, "k bigint, n_regionkey bigint", 4)
    return t.customer.groupBy("c_nationkey").agg(F.count("*").alias("n")).join(local, F.col("c_nationkey") == F.col("k")).groupBy("n_regionkey").agg(F.sum("n").alias("customers"))


@query("src_regex_table", """SELECT split_part(p_name, ' ', 1) AS tone, split_part(p_name, ' ', 2) AS thing, count(*) AS n FROM part GROUP BY ALL""")
def src_regex_table(t):
    path = staged(t.part.select("p_name"), "regex", "text")
    return sf.regex_table(t.spark, path, "([a-z]*) ([a-z]*)", ["tone", "thing"]).groupBy("tone", "thing").agg(F.count("*").alias("n"))


@query("src_overwrite_directory", """SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus""")
def src_overwrite_directory(t):
    path = scratch_path(t.spark, "directory")
    t.orders.createOrReplaceTempView("millrace_directory_orders")
    t.spark.sql(f"INSERT OVERWRITE DIRECTORY '{path}' USING orc SELECT o_orderstatus, count(*) AS n FROM millrace_directory_orders GROUP BY o_orderstatus")
    return t.spark.read.orc(path)


@query("src_random")
def src_random(t):
    return sg.random_table(t.orders, "o_orderkey").agg(*[F.avg(c).alias(c) for c in ("uniform", "normal", "poisson", "exponential", "gamma", "log_normal", "weibull")])


@query("src_generated_points")
def src_generated_points(t):
    points = sg.cluster_points(t.customer, "c_custkey", 5, 3)
    return points.groupBy("cluster").agg(F.count("*").alias("n"), *[F.avg(F.col("point")[i]).alias(f"x{i}") for i in range(3)])


@query("src_generated_ratings")
def src_generated_ratings(t):
    return sg.factor_ratings(t.orders, "o_custkey", "o_orderkey").agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev("value").alias("sd"))


@query("src_generated_labels")
def src_generated_labels(t):
    return sg.labelled_points(t.customer, "c_custkey", 4).groupBy("label").agg(F.count("*").alias("n"))


@query("src_file_name", """SELECT true AS named, count(*) AS n FROM nation""")
def src_file_name(t):
    rows = t.nation.select(F.input_file_name().alias("f"), F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_block_start").alias("at"))
    return rows.agg(F.bool_and(F.contains("p", F.lit("nation.parquet")) & F.contains("f", F.lit("nation.parquet"))).alias("named"), F.count("*").alias("n"))


ORDER_COUNTS = """SELECT o_orderstatus AS status, year(o_orderdate)::INT AS y, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ALL"""


def order_rows(t):
    return t.orders.select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"), F.year("o_orderdate").alias("y"))


def order_counts(df):
    return df.groupBy("status", "y").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("load_insert", """SELECT count(*) AS n FROM (SELECT o_orderkey FROM orders UNION ALL SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def load_insert(t):
    name = om.managed_table(t.orders.select("o_orderkey", "o_orderstatus"), "insert")
    t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus").write.insertInto(name)
    return t.spark.table(name).agg(F.count("*").alias("n"))


@query("load_dynamic_partitions", f"""
WITH a AS ({ORDER_COUNTS}) SELECT status, y, CASE WHEN status = 'F' THEN 2 * n ELSE n END AS n, CASE WHEN status = 'F' THEN round(2 * total, 2) ELSE total END AS total FROM a""")
def load_dynamic_partitions(t):
    """Load all partitions, then replace those of one status with doubled rows; the others stay."""
    path = scratch_path(t.spark, "dyn")
    rows = order_rows(t)
    om.load_partitions(rows, path, ["status", "y"])
    done = rows.where("status = 'F'")
    om.load_partitions(done.union(done), path, ["status", "y"])
    return order_counts(t.spark.read.schema("o_orderkey bigint, o_totalprice double, status string, y int").parquet(path))


@query("load_static_partition", """SELECT 'one' AS part, status, n FROM (SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1)""")
def load_static_partition(t):
    path = scratch_path(t.spark, "static")
    om.load_partitions(order_rows(t), path, ["status"], {"part": "one"})
    return t.spark.read.parquet(path).groupBy("part", "status").agg(F.count("*").alias("n"))


@query("load_multi_insert", """
SELECT 'big' AS target, count(*) AS n FROM orders WHERE o_totalprice > 300000 UNION ALL SELECT 'by_status', count(DISTINCT o_orderstatus) FROM orders""")
def load_multi_insert(t):
    paths = om.multi_insert(t.orders, {
        "big": lambda d: d.where("o_totalprice > 300000").select("o_orderkey"),
        "by_status": lambda d: d.groupBy("o_orderstatus").agg(F.count("*").alias("n")),
    })
    parts = [t.spark.read.parquet(p).agg(F.lit(name).alias("target"), F.count("*").alias("n")) for name, p in paths.items()]
    return parts[0].union(parts[1])


@query("load_ctas", """SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment""")
def load_ctas(t):
    name = om.managed_table(t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("n")), "ctas")
    like = f"{name}_like"
    t.spark.sql(f"CREATE TABLE {like} LIKE {name} USING parquet LOCATION '{scratch_path(t.spark, 'like')}'")
    t.spark.table(name).write.insertInto(like)
    return t.spark.table(like)


@query("load_view", """SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_nationkey""")
def load_view(t):
    t.customer.createOrReplaceTempView("millrace_customers")
    t.spark.sql("CREATE OR REPLACE TEMPORARY VIEW millrace_rich AS SELECT * FROM millrace_customers WHERE c_acctbal > 0")
    return t.spark.sql("SELECT c_nationkey, count(*) AS n FROM millrace_rich GROUP BY c_nationkey")


@query("load_partition_admin", """
SELECT o_orderstatus AS status, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""")
def load_partition_admin(t):
    """Add, rename, drop and repair partitions of a catalog table."""
    spark = t.spark
    name = om.managed_table(order_rows(t).select("o_orderkey", "status"), "admin", ["status"])
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (status = 'none')")
    spark.sql(f"ALTER TABLE {name} PARTITION (status = 'none') RENAME TO PARTITION (status = 'empty')")
    spark.sql(f"ALTER TABLE {name} DROP PARTITION (status = 'empty')")
    spark.sql(f"ALTER TABLE {name} DROP PARTITION (status = 'P')")
    return spark.table(name).groupBy("status").agg(F.count("*").alias("n"))


@query("load_repair", """SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1""")
def load_repair(t):
    path = staged(order_rows(t).select("o_orderkey", "status"), "repair", partition_by=["status"])
    name = "millrace_repair_" + path.rsplit("-", 1)[1]
    t.spark.sql(f"CREATE TABLE {name} (o_orderkey BIGINT, status STRING) USING parquet PARTITIONED BY (status) LOCATION '{path}'")
    t.spark.sql(f"MSCK REPAIR TABLE {name}")
    return t.spark.table(name).groupBy("status").agg(F.count("*").alias("n"))


@query("load_truncate", """SELECT 0::BIGINT AS after, count(*) AS before FROM nation""")
def load_truncate(t):
    name = f"{om.scratch_database(t.spark)}.nations"
    t.spark.sql(f"CREATE TABLE {name} (n_nationkey INT, n_name STRING) USING parquet")
    t.nation.select("n_nationkey", "n_name").write.insertInto(name)
    before = t.spark.table(name).count()
    t.spark.sql(f"TRUNCATE TABLE {name}")
    return t.spark.table(name).agg(F.count("*").alias("after"), F.lit(before).cast("bigint").alias("before"))


@query("load_files", """SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey""")
def load_files(t):
    """LOAD DATA: files written elsewhere are appended to a table."""
    incoming = staged(t.supplier, "incoming", "csv")
    path = scratch_path(t.spark, "loaded")
    schema = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
    staged(sf.read_files(t.spark, "csv", incoming, schema), "loaded", mode="append", path=path)
    return t.spark.read.parquet(path).groupBy("s_nationkey").agg(F.count("*").alias("n"))


@query("load_bucketed", """SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey""")
def load_bucketed(t):
    from millrace.sources.tables import bucketed_table

    return bucketed_table(t.orders.select("o_custkey", "o_orderkey"), "bucketed", ["o_custkey"], om.bucket_count(t.spark, t.path("orders")), ["o_custkey", "o_orderkey"]).groupBy(
        "o_custkey").agg(F.count("*").alias("n"))


@query("load_list_bucketed", """
SELECT CASE WHEN l_linenumber IN (1, 2) THEN l_linenumber::VARCHAR ELSE 'other' END AS bucket, count(*) AS n FROM lineitem GROUP BY 1""")
def load_list_bucketed(t):
    path = scratch_path(t.spark, "lists")
    om.list_buckets(t.lineitem.select("l_linenumber", "l_orderkey"), "l_linenumber", [1, 2], path)
    return t.spark.read.schema("l_linenumber int, l_orderkey bigint, bucket string").parquet(path).groupBy("bucket").agg(F.count("*").alias("n"))


@query("load_evolve", """
SELECT key, name, NULL::VARCHAR AS note, balance, kind FROM (SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance, 's' AS kind FROM supplier
UNION ALL SELECT c_custkey, c_name, c_acctbal, 'c' FROM customer)""")
def load_evolve(t):
    new = om.evolve(t.supplier, {"note": "string"}, {"s_suppkey": "key", "s_name": "name", "s_acctbal": "balance"}, {"s_nationkey": "bigint"}, ["s_nationkey"])
    old = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.lit("c").alias("kind"))
    return new.withColumn("kind", F.lit("s")).unionByName(old, allowMissingColumns=True)


@query("load_export_import", """SELECT o_orderstatus AS status, y, n, total FROM (SELECT o_orderstatus, year(o_orderdate)::INT AS y, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'P' GROUP BY ALL)""")
def load_export_import(t):
    folder = scratch_path(t.spark, "export")
    om.export_table(order_rows(t), folder, ["status"])
    return order_counts(om.import_table(t.spark, folder, "status = 'P'"))


@query("load_compact", """SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, true AS fewer FROM orders""")
def load_compact(t):
    many = staged(t.orders.select("o_orderkey", "o_totalprice").repartition(24), "small_files")
    packed = t.spark.read.parquet(om.compact(t.spark, many))
    return packed.agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), (F.countDistinct(F.col("_metadata.file_path")) < 24).alias("fewer"))


@query("load_compact_partitions", """SELECT o_orderstatus AS status, count(*) AS n, round(sum(o_totalprice), 2) AS total, true AS fewer, true AS in_its_folder FROM orders GROUP BY 1""")
def load_compact_partitions(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"))
    many = staged(rows.repartition(24), "small_parts", partition_by=["status"])
    packed = t.spark.read.parquet(om.compact(t.spark, many, by=["status"]))
    path = F.col("_metadata.file_path")
    return packed.groupBy("status").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), (F.countDistinct(path) < 12).alias("fewer"),
                                        F.bool_and(F.contains(path, F.concat(F.lit("/status="), "status", F.lit("/")))).alias("in_its_folder"))


@query("load_stats", """SELECT count(*) AS n FROM orders""")
def load_stats(t):
    name = om.managed_table(t.orders, "stats")
    stats = om.table_statistics(t.spark, name, ["o_orderkey", "o_orderstatus"])["statistics"]
    return t.spark.table(name).agg(F.count("*").alias("n")).where(F.lit(" rows" in stats))


@query("load_latest_partition", """SELECT max(year(o_orderdate))::VARCHAR AS latest FROM orders""")
def load_latest_partition(t):
    name = om.managed_table(order_rows(t), "years", ["y"])
    return t.spark.range(1).select(F.lit(om.latest_partition(t.spark, name, "y")).alias("latest"))
