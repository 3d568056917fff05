"""Tables whose parts are replaced as wholes: a reader sees the old rows or the new ones, never a mixture and never nothing.

    table/rows/<version>/part=<part>/   the rows of one version of a part, never changed once written
    table/commits/<moment>-<version>    a line `part version` for each part that this commit replaces, never changed

A commit writes the rows of all its parts to a new version in one job, and then makes its file, by a rename, which is one step. Readers list the commits
once and read what the latest of each part names, so several parts change together. Whoever opened the table before
goes on with the old versions; they stay until `remove_old` deletes them. A write that fails leaves a version that no commit names.
"""

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

NOTHING = "nothing"
ROWS = "rows"


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _name(name: str) -> str:
    if not name or not name[0].isalnum() or not name.isascii() or not all(c.isalnum() or c in "-_." for c in name):
        raise ValueError(f"no name for a part or version: {name!r}")
    return name


def _children(spark: SparkSession, path: str) -> list:
    root, files = _place(spark, path)
    found = files.listStatus(root) if files.exists(root) else ()
    return sorted((status for status in found if status.getPath().getName()[0].isalnum()), key=lambda status: status.getPath().getName())


def _text(spark: SparkSession, path) -> str:
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, changes: dict[str, str]) -> None:
    commits = [status.getPath().getName() for status in _children(spark, f"{path}/commits")]
    latest = int(commits[-1].split("-")[0]) if commits else 0
    moment = max(time.time_ns(), latest + 1)  # later than all others, also where this machine's clock is behind
    name = f"{moment:020}-{uuid.uuid4().hex}"
    draft, files = _place(spark, f"{path}/drafts/{name}")
    target, _ = _place(spark, f"{path}/commits/{name}")
    files.mkdirs(target.getParent())
    out = files.create(draft, False)
    out.write(bytearray("".join(f"{part} {version}\n" for part, version in changes.items()).encode()))
    out.close()
    if not files.rename(draft, target):
        raise OSError(f"the commit could not be moved to {target}")


def versions(spark: SparkSession, path: str) -> dict[str, str]:
    """Part -> the version that counts now; a line for each part of each commit comes to the driver."""
    known: dict[str, str] = {}
    for status in _children(spark, f"{path}/commits"):
        known.update(line.split(" ") for line in _text(spark, status.getPath()).splitlines())
    return {part: version for part, version in known.items() if version != NOTHING}


def publish(
    df: DataFrame,
    path: str,
    part_col: str,
    parts: list[str] | None = None,
    version: str | None = None,
    beside: dict[str, DataFrame] | None = None,
) -> str | None:
    """Replace parts by the rows of `df` that name them in `part_col`, all in one step.

    `parts` are those to replace, also by no rows; without it, those that `df` names. With a `version` of the caller's (a batch, a
    run), publishing it again while one of `parts` has it does nothing. `beside` are further tables with that column, which are committed with the rows
    and read by their name. Returns the version, None if there was nothing to do.
    """
    spark = df.sparkSession
    for part in parts or ():
        _name(part)
    if version:
        _name(version)
        known = versions(spark, path)
        if any(known.get(part, "").split("~")[0] == version for part in parts or ()):
            return None
    attempt = f"{version or 'rows'}~{uuid.uuid4().hex}"  # an attempt that fails half-way has a folder of its own
    for name, rows in {**(beside or {}), ROWS: df}.items():
        rows.write.partitionBy(part_col).parquet(f"{path}/{name}/{attempt}")
    found = [status.getPath().getName().split("=", 1)[1] for status in _children(spark, f"{path}/{ROWS}/{attempt}") if status.isDirectory()]
    stray = set(found) - set(parts) if parts is not None else ()
    if stray:
        raise ValueError(f"rows of parts that are not replaced: {sorted(stray)}")
    _commit(spark, path, {_name(part): attempt if part in found else NOTHING for part in sorted({*found, *(parts or ())})})
    return attempt


def read(
    spark: SparkSession, path: str, schema: StructType | str, parts: list[str] | None = None, part_col: str | None = None, name: str = ROWS
) -> DataFrame:
    """The rows of all parts (or of some) as they are now. `schema` is that of the rows without the part; `part_col` adds it."""
    known = versions(spark, path)
    chosen = {part: version for part, version in sorted(known.items()) if parts is None or part in parts}
    if part_col is None:
        folders = [f"{path}/{name}/{version}/*={part}" for part, version in chosen.items()]
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)
    if not chosen:
        return spark.createDataFrame([], schema).withColumn(part_col, F.lit(""))
    rows = read(spark, path, schema, parts, name=name)
    return rows.withColumn(part_col, F.regexp_extract(F.col("_metadata.file_path"), "=([^/=]+)/[^/]+$", 1))


def withdraw(spark: SparkSession, path: str, parts: list[str]) -> None:
    """Take parts out of the table in one step; their rows stay for those who read them."""
    _commit(spark, path, {_name(part): NOTHING for part in parts})


def remove_old(spark: SparkSession, path: str, older_than: float = 86_400.0) -> int:
    """Delete versions that count no more and were written more than so many seconds ago, and fold old commits to one; how many versions they were.

    The limit must be longer than any reader or writer takes.
    """
    limit, removed = (time.time() - older_than) * 1000, 0
    old = [status.getPath() for status in _children(spark, f"{path}/commits") if status.getModificationTime() < limit]
    known = versions(spark, path)
    if len(old) > 1:
        _commit(spark, path, known)
        for place in old:
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, False)
    for table in _children(spark, path):
        for version in _children(spark, f"{path}/{table.getPath().getName()}") if table.getPath().getName() not in ("commits", "drafts") else ():
            name = version.getPath().getName()
            if name not in known.values() and version.getModificationTime() < limit:
                _, files = _place(spark, path)
                files.delete(version.getPath(), True)
                removed += table.getPath().getName() == ROWS
    return removed
