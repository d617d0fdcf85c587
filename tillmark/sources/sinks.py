"""Table writers and the keyed upsert."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from tillmark.operators.durable import checkpointed, run_once, scratch
from tillmark.sources import schemas
from tillmark.sources.readers import judged, load_raw, raw_files, read_table, table_name


def with_filters(writer: DataFrameWriter, columns: tuple[str, ...]) -> DataFrameWriter:
    """``writer`` that gives every row group a Bloom filter of each column, sized by what it holds (1 MB at most).

    Stored tables are packed by zstd: half of a line is ids and hashes as text, which need the entropy coder.
    """
    writer = writer.option("compression", "zstd")
    for column in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        # Sizes to choose from, each half of the one before: a month of one task has some thousand lines, and the smallest
        # of the usual five sizes is 64 kB.
        writer = writer.option(f"parquet.bloom.filter.candidates.number#{column}", "8")
    return writer.option("parquet.bloom.filter.adaptive.enabled", "true") if columns else writer


def write_table(
    df: DataFrame,
    target: str,
    partition_by: tuple[str, ...] = (),
    observed: Observation | None = None,
    *measures,
    found_by: tuple[str, ...] = (),
) -> DataFrame:
    """Replace a whole table (parquet folder or catalog table) and return a frame that reads it.

    Reading back cuts the lineage: a later failure re-reads the table instead of rebuilding everything above it.
    ``measures`` are aggregates over the rows, gathered into ``observed`` by the write itself.  Rows are looked up by
    the columns ``found_by`` (``near_keys``).
    """
    if observed is not None:
        df = df.observe(observed, *measures)
    writer = with_filters(df.write.mode("overwrite"), found_by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with run_once(df.sparkSession):
        if "/" in target:
            writer.parquet(target)
        else:
            writer.format("parquet").saveAsTable(target)
    return read_table(df.sparkSession, target)


def drop_and_write(df: DataFrame, table: str, observed: Observation | None = None, *measures) -> DataFrame:
    """Model output: the old table is dropped first, so that a changed schema never meets old files."""
    if "/" not in table:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {table}")
    return write_table(df, table, (), observed, *measures)


def replace_raw(
    spark: SparkSession, folder: str, target: str, max_rejected: float | None = None
) -> dict[str, DataFrame]:
    """Load all raw CSV files of ``folder``, each replacing its table below ``target`` (a folder or a database).

    With ``max_rejected`` the records that do not load whole (``readers.judged``) are kept beside the table, as
    ``<table>_rejected``, and a file in which more than that share of the records is such fails the load before any
    table is replaced.  This reads the files once more.
    """
    place = f"{target.rstrip('/')}/" if "/" in target else f"{target}."
    files = raw_files(spark, folder)
    for path in files if max_rejected is not None else ():
        name = table_name(path)
        if name not in schemas.RAW:
            continue
        seen = Observation()
        records = judged(spark, path, schemas.struct(schemas.RAW[name]))
        bad = F.size("reasons") > 0
        records = records.observe(seen, F.count(F.lit(1)).alias("records"), F.count_if(bad).alias("rejected"))
        write_table(records.where(bad), f"{place}{name}_rejected")
        found = seen.get
        if found["rejected"] > max_rejected * found["records"]:
            raise ValueError(f"{path}: {found['rejected']} of {found['records']} records do not load whole")
    return {name: write_table(frame, f"{place}{name}") for name, frame in (load_raw(spark, path) for path in files)}


PUBLISHED = "_PUBLISHED"


def _version_folders(spark: SparkSession, target: str, pattern: str) -> list:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/versions/{pattern}")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted((f.getPath() for f in found), key=lambda p: p.toString())


def new_version(spark: SparkSession, target: str) -> str:
    """A folder below ``target`` for the tables of the next version.  Names sort in the order of their making."""
    numbers = [int(p.getName().split("-")[0]) for p in _version_folders(spark, target, "*")]
    return f"{target.rstrip('/')}/versions/{max(numbers, default=0) + 1:012d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, version: str) -> None:
    """Make a version the one that readers see: one empty file is created, which any file system does whole or not."""
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{version}/{PUBLISHED}")
    mark.getFileSystem(spark._jsc.hadoopConfiguration()).create(mark, False).close()


def published_version(spark: SparkSession, target: str) -> str | None:
    """The folder of the last version below ``target`` that was published."""
    marks = _version_folders(spark, target, f"*/{PUBLISHED}")
    return marks[-1].getParent().toString() if marks else None


def published(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The tables of the last version that was published, all of one refresh; none before the first."""
    version = published_version(spark, target)
    if version is None:
        return {}
    name = version.rsplit("/", 1)[-1]
    tables = [p for p in _version_folders(spark, target, f"{name}/*") if not p.getName().startswith("_")]
    return {p.getName(): spark.read.parquet(p.toString()) for p in tables}


def remove_versions(spark: SparkSession, target: str, keep: int = 2) -> None:
    """Remove versions before the last ``keep`` published ones, unfinished ones among them included.

    Who still reads a removed version fails, so keep as many as a reader may be behind.
    """
    marks = _version_folders(spark, target, f"*/{PUBLISHED}")[-max(keep, 1) :]
    if not marks:
        return
    oldest = marks[0].getParent().getName()
    for path in _version_folders(spark, target, "*"):
        if path.getName() < oldest:
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def upsert(target: DataFrame, batch: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``target`` whose key is not in ``batch``, plus all of ``batch``.

    Parquet has no MERGE, so the result is a new table: write it to a new place, never over ``target``.  Repeating a
    batch gives the same table.  Keys compare null-safe, so a null key is replaced like any other.  A batch that repeats
    a key has no single row to put there: all of its rows are taken (``require_unique`` rejects it).
    """
    keep = target.alias("t").join(
        batch.select(*keys).alias("b"),
        reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]),
        "left_anti",
    )
    return keep.unionByName(batch)


def require_unique(batch: DataFrame, *keys: str) -> DataFrame:
    """Stop where a batch repeats a key: a keyed merge could not tell which row to keep.  Runs one job."""
    twice = batch.groupBy(*keys).count().where(F.col("count") > 1).first()
    if twice:
        raise ValueError(f"the batch repeats the key {tuple(twice[k] for k in keys)}")
    return batch


# So many keys of a batch are named to the scan; a few kilobytes in the plan.
NAMED = 1000


def near_keys(target: DataFrame, batch: DataFrame, key: str, named: int = NAMED) -> DataFrame:
    """The rows of ``target`` that can have a key of ``batch``: never fewer, mostly not many more.

    A scan answers the condition from its row groups' Bloom filters and smallest and largest values, so most of a large
    table is not read.  Up to ``named`` keys are named; of a larger batch the smallest and largest key bound the scan.
    Null keys count as keys.  What is kept still has to meet the batch.
    """
    return target.where(_near(batch, key, named))


def _near(batch: DataFrame, key: str, named: int = NAMED) -> Column:
    """The condition of ``near_keys``."""
    spark = batch.sparkSession
    own = batch.select(key)
    # The first rows of a large batch mostly tell that it has more keys than are named.
    seen = own.limit(10 * (named + 1)).distinct().limit(named + 1).collect()
    if len(seen) <= named:
        seen = own.distinct().limit(named + 1).collect()
    seen = [row[0] for row in seen]
    if len(seen) <= named:
        # A scan is given no more than the range of a list that is longer than this.
        threshold = "spark.sql.parquet.pushdown.inFilterThreshold"
        spark.conf.set(threshold, max(named, int(spark.conf.get(threshold))))
        near, null = F.col(key).isin([k for k in seen if k is not None]), None in seen
    else:
        low, high, nulls = batch.agg(F.min(key), F.max(key), F.count_if(F.col(key).isNull())).first()
        near, null = F.col(key).between(F.lit(low), F.lit(high)), nulls > 0
    return near | F.col(key).isNull() if null else near


# Bits for each marked key, and the most of all: 64 MB, which every executor is sent.  More keys find more bits set, and
# more rows are looked at that are none of theirs.
BITS_A_KEY, MOST_BITS = 8, 1 << 29
_WORD = _BLOCK = 1 << 6  # bits in a word, words in a row of marks


class Marks:
    """A bit for the hash of every key: a row without its bit has none of the keys, without a shuffle of the rows."""

    def __init__(self, keys: DataFrame):
        self._columns = keys.columns
        wanted = min(max(keys.count() * BITS_A_KEY, _WORD * _BLOCK), MOST_BITS)
        self._words = 1 << ((wanted - 1).bit_length() - 6)
        bits = keys.select(self._word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("long"), self._bit).alias("_bits"))
        # A row for every word, so that its place in its block is its number.
        none = keys.sparkSession.range(self._words).select(F.col("id").alias("_word"), F.lit(0).cast("long").alias("_bits"))
        words = bits.unionByName(none).groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))
        in_order = F.array_sort(F.collect_list(F.struct("_word", "_bits")))
        self._blocks = checkpointed(
            words.groupBy(F.shiftright("_word", 6).alias("_block")).agg(F.transform(in_order, lambda w: w["_bits"]).alias("_marks"))
        )

    @property
    def _hash(self) -> Column:
        return F.xxhash64(*self._columns)

    @property
    def _word(self) -> Column:
        return F.pmod(F.shiftrightunsigned(self._hash, 6), F.lit(self._words))

    @property
    def _bit(self) -> Column:
        return self._hash.bitwiseAND(F.lit(_WORD - 1)).cast("int")

    def seen(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with ``name``: whether the bit of the row's key is set."""
        block = F.shiftright(self._word, 6)
        word = F.get("_marks", self._word.bitwiseAND(F.lit(_BLOCK - 1)).cast("int"))
        is_set = F.call_function("shiftright", word, self._bit).bitwiseAND(F.lit(1)) == 1
        met = rows.join(F.broadcast(self._blocks), block == F.col("_block"))
        return met.select(*rows.columns, is_set.alias(name))


def _null_safe(left: str, right: str, columns: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def upsert_partitions(
    path: str, batch: DataFrame, keys: tuple[str, ...], partition_by: tuple[str, ...], unique: bool = True
) -> DataFrame:
    """Upsert into a stored, partitioned table; only partitions that the batch's rows are in, or were in, are rewritten.

    Replaced rows are looked for where row groups may have them (``near_keys``); what is written can be found so too.
    A batch that repeats a key is refused; where keys need not be ``unique``, all of its rows replace all of that key's.

    The stored rows are not sent to meet the batch: keys that may be in it by their ``Marks`` meet it alone, and a row
    stays where its key has no mark, or is one of the few that has one and is not in the batch after all.  ``batch`` is
    read several times.
    """
    spark = batch.sparkSession
    if unique:
        require_unique(batch, *keys)
    target = spark.read.parquet(path)
    batch = batch.select(target.columns)
    with scratch(spark):
        wanted = batch.select([F.col(k).cast(target.schema[k].dataType) for k in keys])
        marks = Marks(wanted)
        near = reduce(lambda a, b: a & b, [_near(batch, key) for key in keys])
        found = marks.seen(target.where(near).select(*keys, *partition_by), "_marked").where("_marked").drop("_marked")
        theirs = wanted.distinct().withColumn("_theirs", F.lit(True))
        found = found.alias("t").join(theirs.alias("b"), _null_safe("t", "b", keys), "left").select("t.*", F.col("_theirs").isNotNull().alias("_theirs"))
        found = checkpointed(found)
        was_in = found.where("_theirs").select(*partition_by)
        touched = checkpointed(was_in.union(batch.select(*partition_by)).distinct())
        others = found.where("not _theirs").select(*keys)
        old = target.alias("t").join(touched.alias("p"), _null_safe("t", "p", partition_by), "left_semi").select("t.*")
        old = marks.seen(old, "_marked").withColumn("_marked", F.coalesce(near, F.lit(False)) & F.col("_marked"))
        doubted = Marks(others).seen(old.where("_marked"), "_other").where("_other")
        # Not a semi join, which the optimizer would move below the marks, so that all rows would be sent.
        doubted = doubted.alias("t").join(others.distinct().alias("b"), _null_safe("t", "b", keys)).select("t.*")
        rows = reduce(DataFrame.unionByName, [part.select(target.columns) for part in (old.where("not _marked"), doubted, batch)])
        return overwrite_partitions(path, rows, touched, partition_by, keys)


def overwrite_partitions(
    path: str, rows: DataFrame, touched: DataFrame, partition_by: tuple[str, ...], found_by: tuple[str, ...] = ()
) -> DataFrame:
    """Replace the partitions that ``touched`` lists by ``rows``, which may be made from the table itself.

    The writer puts new files aside and moves them when all are written, so the old ones are read to the end, and a
    failure before that leaves the table as it was.
    """
    spark = rows.sparkSession
    target = spark.read.parquet(path)
    seen = Observation()
    new = rows.select(target.columns).observe(seen, F.collect_set(F.struct(*partition_by)).alias("written"))
    writer = new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    with run_once(spark):
        with_filters(writer, found_by).parquet(path)
    # A partition that keeps no row is not overwritten by the writer and has to go by itself.
    written = {tuple(row) for row in seen.get["written"]}
    for row in touched.select(*partition_by).distinct().collect():
        if tuple(row) in written:
            continue
        gone = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/" + "/".join(f"{c}={row[c]}" for c in partition_by))
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return spark.read.schema(target.schema).parquet(path)


def database(spark: SparkSession, name: str) -> str:
    """A namespace for tables; custom names replace the default one and are not appended to it."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return name
