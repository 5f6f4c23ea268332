"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a row's hash. A bucket above the byte limit is split on one more bit, and
only such a bucket, until every bucket fits. As a bucket's bytes never grow when bits are added, the shard of a row is
the shortest prefix of its hash whose bucket fits: the sums of all prefixes come from one aggregate of at most 2**STEP
leaves, and only rows beneath a leaf that still is too large go on to the next STEP bits. Rows that are alike throughout are
numbered and hashed with their number, so that they part like any others.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spoor.llm.common import written

#: Bits that one round adds to the directory, and bits of the hash.
STEP, BITS = 12, 60
#: Bytes of UTF-8 text in a shard.
LIMIT = 1 << 20


def prefix_hash(*columns: str) -> Column:
    """The first 60 bits of the MD5 of the columns' values as text, as a long that is never negative."""
    text = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("long")


def directory(sizes: DataFrame, limit: int) -> DataFrame:
    """``sizes`` (h, bytes and others) plus shard_depth and shard_bits, the length and value of the shard's hash prefix."""
    done, open_, base = None, sizes, 0
    while True:
        leaf = F.shiftright("h", BITS - base - STEP)
        open_ = open_.withColumns({"upper": F.shiftright("h", BITS - base) if base else F.lit(0).cast("long"), "leaf": leaf.cast("long")})
        leaves = open_.groupBy("upper", "leaf").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        depths = leaves.select("*", F.explode(F.sequence(F.lit(0 if base == 0 else 1), F.lit(STEP))).alias("d"))
        prefix = F.expr(f"shiftright(leaf, {STEP} - d)")
        sums = depths.groupBy("upper", "d", prefix.alias("prefix")).agg(F.sum("bytes").alias("total"), F.sum("n").alias("rows"), F.collect_set("leaf").alias("leaves"))
        # A single row can't be split; at the last bit no bucket can.
        last = base + STEP >= BITS
        fits = (F.col("total") <= limit) | (F.col("rows") == 1) | (F.lit(last) & (F.col("d") == STEP))
        chosen = sums.where(fits).select("upper", F.explode("leaves").alias("leaf"), "d").groupBy("upper", "leaf").agg(F.min("d").alias("d"))
        found = open_.join(written(chosen), ["upper", "leaf"], "left")
        settled = found.where("d is not null").select(*sizes.columns, (F.col("d") + base).cast("int").alias("shard_depth"), F.expr(f"shiftright(h, {BITS - base} - d)").alias("shard_bits"))
        done = settled if done is None else done.unionByName(settled)
        rest = written(found.where("d is null").select(*sizes.columns))
        if last or rest.isEmpty():
            return done
        open_, base = rest, base + STEP


def told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` (h, place and others) with another hash for each row but the first of those that share one.

    ``place`` is a row's monotonically increasing id. Rows are numbered within the part of the table that they were written
    in, and parts by running totals, so that no task takes in all of many equal rows.
    """
    again = written(rows.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    alike = rows.join(again, "h", "left_semi").withColumn("part", F.shiftright("place", 33))
    before = Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = alike.groupBy("h", "part").agg(F.count("*").alias("n")).select("h", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("h", "part").orderBy("place")) - 1
    numbered = alike.withColumn("own", own).join(parts, ["h", "part"]).withColumn("number", F.col("before") + F.col("own"))
    anew = F.conv(F.substring(F.md5(F.concat_ws(":", F.col("h").cast("string"), F.col("number").cast("string"))), 1, BITS // 4), 16, 10).cast("long")
    numbered = numbered.withColumn("h", F.when(F.col("number") == 0, F.col("h")).otherwise(anew)).select(*rows.columns)
    return rows.join(again, "h", "left_anti").select(*rows.columns).unionByName(numbered)


def _placed(rows: DataFrame, limit: int) -> DataFrame:
    """``rows`` (h, bytes, place and others) plus shard, the row's hash prefix as bits."""
    placed = written(directory(written(told_apart(rows)), limit))
    return placed.withColumn("shard", F.when(F.col("shard_depth") == 0, "").otherwise(F.lpad(F.bin("shard_bits"), F.col("shard_depth"), F.lit("0"))))


def _size(text_col: str) -> Column:
    return F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long")


def assign(docs: DataFrame, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8 bytes of the text, null as 0), shard (hash prefix as bits, empty for one shard) and shard_bytes.

    Every shard holds at most ``limit`` bytes, but for one that is a single row above it. Rows that repeat come back as often
    and may part; null ids and texts are hashed as such. No other column is read; an empty table gives none.
    """
    sizes = docs.select(F.col(id_col).alias("doc_id"), prefix_hash(id_col, text_col).alias("h"), _size(text_col).alias("bytes"), F.monotonically_increasing_id().alias("place"))
    placed = _placed(written(sizes), limit).select("doc_id", F.col("bytes").alias("n_bytes"), "shard")
    total = placed.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"))
    return placed.join(written(total), "shard").select("doc_id", "n_bytes", "shard", "shard_bytes")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` as one Parquet folder a shard; a shard is small by its limit, so one task writes it.

    A column named shard is replaced by the prefix behind a "b", which keeps it a text. The rows are written once before, so that each keeps the place it is known by.
    """
    rows = written(docs.drop("shard").select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("place")))
    sizes = rows.select("place", prefix_hash(f"row.{id_col}", f"row.{text_col}").alias("h"), _size(f"row.{text_col}").alias("bytes"))
    joined = rows.join(_placed(sizes, limit).select("place", F.concat(F.lit("b"), "shard").alias("shard")), "place").select("row.*", "shard")
    joined.repartition("shard").write.partitionBy("shard").parquet(path)


def oracle(limit: int = LIMIT) -> str:
    """DuckDB SQL of :func:`assign`."""
    return f"""
WITH s AS (SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes, CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), chr(0)) || chr(31) || coalesce(text, chr(0))), 1, {BITS // 4})) AS BIGINT) AS first FROM documents),
u AS (SELECT *, row_number() OVER (PARTITION BY first) - 1 AS number FROM s),
r AS (SELECT doc_id, n_bytes, CASE WHEN number = 0 THEN first ELSE CAST(('0x' || substr(md5(CAST(first AS VARCHAR) || ':' || CAST(number AS VARCHAR)), 1, {BITS // 4})) AS BIGINT) END AS h FROM u),
p AS (SELECT r.*, d, h >> ({BITS} - d) AS prefix FROM r CROSS JOIN (SELECT unnest(range(0, {BITS + 1})) AS d) AS depths),
t AS (SELECT d, prefix, sum(n_bytes) AS total, count(*) AS n FROM p GROUP BY d, prefix),
f AS (SELECT p.doc_id, p.h, p.n_bytes, min(p.d) AS depth FROM p JOIN t USING (d, prefix) WHERE total <= {limit} OR n = 1 OR p.d = {BITS} GROUP BY p.doc_id, p.h, p.n_bytes),
g AS (SELECT doc_id, n_bytes, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(h >> ({BITS} - depth)), CAST(depth AS INTEGER), '0') END AS shard FROM f)
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, shard, CAST(sum(n_bytes) OVER (PARTITION BY shard) AS BIGINT) AS shard_bytes FROM g"""
