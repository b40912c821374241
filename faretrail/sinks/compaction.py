"""Small files to a few of a target size, in place.

The files of each folder are dealt to groups of about the target size.  Each group is read and
written by one task, so no row is shuffled or sorted, and many groups go at a time.  What is packed is written to a hidden folder first; a journal, written in one step,
then decides: before it the folder is as it was, after it the change is carried through, by the
next call if need be.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faretrail import storage

TARGET_BYTES = 128 << 20
_HIDDEN = "_packing-"
_GROUP = "_ft_group"
#: Groups that are submitted together; their tasks run as the cluster has cores.
PACKED_AT_ONCE = 64


def groups(files: DataFrame, target_bytes: int) -> DataFrame:
    """(path, folder, group): groups from 0 on over all folders, each of one folder.  Files of
    more than half the target stay as they are; the others of a folder, by name, make groups of
    the target less or more one file.  A file without neighbours to join is left out."""
    small = files.where(F.col("length") * 2 <= target_bytes).select("path", "length", F.regexp_replace("path", "/[^/]*$", "").alias("folder"))
    before = Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    small = small.withColumn("slot", F.floor(F.coalesce(F.sum("length").over(before), F.lit(0)) / target_bytes))
    whole = small.groupBy("folder", "slot").agg(F.count("*").alias("n"), F.collect_list("path").alias("paths")).where("n > 1")
    numbered = whole.withColumn("group", F.row_number().over(Window.orderBy("folder", "slot")) - 1)
    return numbered.select(F.explode("paths").alias("path"), "folder", F.col("group").cast("int").alias("group"))


def _finish(spark: SparkSession, folder: str, hidden: str) -> None:
    """Carry a journalled change through: new files into place, old ones away."""
    plan = json.loads(storage.read_text(spark, f"{folder}/{hidden}/journal.json"))
    for source, target in plan["moves"]:
        if storage.exists(spark, source):
            storage.move(spark, source, target)
    for path in plan["old"]:
        storage.delete(spark, path)
    storage.delete(spark, f"{folder}/{hidden}")


def recover(spark: SparkSession, folder: str) -> None:
    """Finish or undo what a stopped compaction left in ``folder``."""
    folder = folder.rstrip("/")
    for hidden in [n for n in storage.names(spark, folder) if n.startswith(_HIDDEN)]:
        if storage.exists(spark, f"{folder}/{hidden}/journal.json"):
            _finish(spark, folder, hidden)
        else:
            storage.delete(spark, f"{folder}/{hidden}")


def compact(spark: SparkSession, folder: str, target_bytes: int = TARGET_BYTES) -> tuple[int, int]:
    """Pack the small Parquet files under ``folder`` (flat, or in ``col=value/`` folders, each
    packed by itself); returns the numbers of files replaced and of new ones.

    Rows and columns stay, their order in a folder doesn't.  Files that land meanwhile are left
    alone.  A reader that lists the folder between the moves sees rows twice; readers that must
    not be stopped read through :class:`faretrail.sinks.versions.TableSet`.
    """
    folder = folder.rstrip("/")
    recover(spark, folder)
    packed = groups(storage.listing(spark, folder, ".parquet", recursive=True), target_bytes)
    hidden = f"{_HIDDEN}{uuid.uuid4().hex[:10]}"
    plan = f"{folder}/{hidden}/plan"
    packed.write.parquet(plan)  # a row a file; the group numbers are fixed from here on
    packed = spark.read.parquet(plan)
    if packed.isEmpty():
        storage.delete(spark, f"{folder}/{hidden}")
        return 0, 0
    members: dict[int, list[str]] = {}
    where: dict[int, str] = {}
    for r in packed.orderBy("path").collect():  # names, as the journal lists them
        members.setdefault(r["group"], []).append(r["path"])
        where[r["group"]] = r["folder"]
    old = sorted(path for paths in members.values() for path in paths)
    rows = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(*[storage.literal(p) for p in old])
    out, schema = f"{folder}/{hidden}/files", rows.schema

    def pack(group: int) -> None:
        """The files of a group, of about the target together, read by one task, which writes them as one."""
        own = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*[storage.literal(p) for p in members[group]])
        own.coalesce(1).write.parquet(f"{out}/{_GROUP}={group}")

    with ThreadPoolExecutor(PACKED_AT_ONCE) as pool:
        list(pool.map(pack, sorted(members)))
    if spark.read.parquet(out).count() != rows.count():  # both from the footers
        storage.delete(spark, f"{folder}/{hidden}")
        raise RuntimeError(f"packing {folder} would have changed the number of rows")
    moves = []
    for r in storage.listing(spark, out, ".parquet", recursive=True).select("path").orderBy("path").collect():
        group = int(r["path"].split(f"/{_GROUP}=")[1].split("/")[0])
        moves.append((r["path"], f"{where[group]}/packed-{hidden.removeprefix(_HIDDEN)}-{len(moves):06d}.parquet"))
    storage.write_once(spark, f"{folder}/{hidden}/journal.json", json.dumps({"moves": moves, "old": old}))
    _finish(spark, folder, hidden)
    return len(old), len(moves)

