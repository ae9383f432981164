"""Snapshots and the published corpus, as Parquet directories.

A snapshot is ``<root>/<revision>/<table>.parquet``. The published corpus is
``<corpus>/revision=<revision>/<table>`` for every revision, and
``<corpus>/main/<table>`` for the latest state. Such a table is a small list of
parts, which names the folders that hold its rows; rows lie under the revision
that wrote them, in folders that never change. Issues are dealt to buckets by a
hash of their id, and a publication writes the buckets that it touches; all other
buckets stay in the folders of earlier revisions, and main and the new revision
both name them there. A list's next version commits a publication, so readers see
the state before or after it, and a publication cut short leaves folders that no
list names (``sweep`` removes them).
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultloom.dims import frameworks, taxonomy
from faultloom.operators.merging import merge_dealt, merge_latest
from faultloom.schemas import CROSS_LINKS, FRAMEWORKS, ISSUES, TAXONOMY, conform, empty
from faultloom.sources import fs

log = logging.getLogger(__name__)

TABLES: Mapping[str, T.StructType] = {
    "issues": ISSUES,
    "cross_links": CROSS_LINKS,
    "taxonomy": TAXONOMY,
    "frameworks": FRAMEWORKS,
}
PARTS = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("folder", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        # Of issues, what can be told of a bucket without reading it.
        T.StructField("rows", T.LongType()),
        T.StructField("digest", T.StringType()),
        T.StructField("slugs", T.ArrayType(T.StringType())),
    ]
)
#: Buckets of a new corpus. A corpus keeps the number it began with.
BUCKETS = 64
_REVISION_IN_PATH = r"([^/]+)/issues\.parquet"


def snapshot_table(root: str, revision: str, table: str) -> str:
    return f"{root.rstrip('/')}/{revision}/{table}.parquet"


def corpus_table(corpus: str, revision: str | None, table: str) -> str:
    branch = "main" if revision is None else f"revision={revision}"
    return f"{corpus.rstrip('/')}/{branch}/{table}"


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A table with its declared schema; no rows where nothing was written yet.

    Tables that an earlier layout wrote whole are read as they are.
    """
    parts = _parts(spark, path)
    if parts is not None:
        return _rows_of(spark, path.rstrip("/").rsplit("/", 2)[0], parts, table)
    found = fs.readable(spark, path)
    if found is None:
        return empty(spark, TABLES[table])
    return spark.read.schema(TABLES[table]).parquet(found)


def _list_of_parts(target: str) -> str:
    return f"{target.rstrip('/')}/parts"


def _parts(spark: SparkSession, target: str) -> list[Row] | None:
    """A published table's parts, a row for each bucket; None where it has no list."""
    found = fs.current_version(spark, _list_of_parts(target))
    return None if found is None else spark.read.schema(PARTS).parquet(found).collect()


def _rows_of(spark: SparkSession, corpus: str, parts: Sequence[Row], table: str) -> DataFrame:
    if not parts:
        return empty(spark, TABLES[table])
    return spark.read.schema(TABLES[table]).parquet(*sorted(f"{corpus}/{p.folder}" for p in parts))


def write_snapshot(
    issues: DataFrame, cross_links: DataFrame, root: str, revision: str
) -> str:
    """Write the four tables of a revision and return its directory."""
    spark = issues.sparkSession
    tables = {
        "issues": issues,
        "cross_links": cross_links,
        "taxonomy": taxonomy(spark).coalesce(1),
        "frameworks": frameworks(spark).coalesce(1),
    }
    for name, df in tables.items():
        path = snapshot_table(root, revision, name)
        conform(df, TABLES[name]).write.mode("overwrite").parquet(path)
    return f"{root.rstrip('/')}/{revision}"


def revisions(spark: SparkSession, root: str) -> list[str]:
    """Revisions under a snapshot root that hold issues, oldest first."""
    return [
        name
        for name in fs.subdirs(spark, root)
        if fs.exists(spark, snapshot_table(root, name, "issues"))
    ]


def read_revisions(spark: SparkSession, root: str) -> DataFrame:
    """Issues of every revision under a root, with the revision they belong to."""
    paths = [snapshot_table(root, name, "issues") for name in revisions(spark, root)]
    return _with_revision(spark, paths)


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    """Issues of the newest revision under a root; only its files are read."""
    newest = revisions(spark, root)[-1:]
    return _with_revision(spark, [snapshot_table(root, name, "issues") for name in newest])


def find_shards(spark: SparkSession, root: str) -> list[str]:
    """Every shard's issues table under a tree, sorted."""
    return fs.find(spark, root, "issues.parquet")


def read_shards(spark: SparkSession, root: str) -> DataFrame:
    """Issues of all shards. No shard, or shards of different revisions, is an error."""
    paths = find_shards(spark, root)
    if not paths:
        raise ValueError(f"No issues.parquet found under {root}")
    found = sorted({path.rstrip("/").split("/")[-2] for path in paths})
    if len(found) != 1:
        raise ValueError(f"Inconsistent revisions across shards: {found}")
    return _with_revision(spark, paths)


def _with_revision(spark: SparkSession, paths: list[str]) -> DataFrame:
    if not paths:
        return empty(spark, T.StructType([*ISSUES.fields, T.StructField("revision", T.StringType())]))
    rows = spark.read.schema(ISSUES).parquet(*paths)
    return rows.select(
        "*",
        F.regexp_extract(F.col("_metadata.file_path"), _REVISION_IN_PATH, 1).alias("revision"),
    )


def publish(
    spark: SparkSession,
    snapshot: str,
    corpus: str,
    revision: str,
    *,
    also_main: bool = True,
    cumulative: bool = True,
    existing_unique: bool = False,
    strict_reference: bool = False,
    buckets: int = BUCKETS,
) -> dict[str, str]:
    """Publish a snapshot's tables to its revision and, usually, to main.

    ``cumulative`` first merges the snapshot's issues onto main's, newest row
    per issue, in the buckets that the snapshot touches; the other tables are
    replaced. Where main was only ever written by such merges, ``existing_unique``
    keeps its untouched rows out of the ranking. A table the snapshot lacks is
    skipped. Rows are written once, and revision and main name them. Returns the
    paths published, per table. One publication at a time.
    """
    corpus = corpus.rstrip("/")
    how = {"existing_unique": existing_unique, "strict_reference": strict_reference}

    def one(name: str) -> str | None:
        source = f"{snapshot.rstrip('/')}/{name}.parquet"
        if not fs.exists(spark, source):
            log.warning("snapshot %s has no table %s", snapshot, name)
            return None
        rows = spark.read.schema(TABLES[name]).parquet(source)
        target, main = corpus_table(corpus, revision, name), corpus_table(corpus, None, name)
        if name == "issues":
            parts = _publish_issues(rows, corpus, target, main, buckets, cumulative, how)
        else:
            folder = _new_folder(target)
            rows.write.parquet(folder)
            parts = [(0, folder.removeprefix(f"{corpus}/"), 1, None, None, None)]
        listed = spark.createDataFrame(parts, PARTS).coalesce(1)
        for place in (target, main) if also_main else (target,):
            fs.write_version(listed, _list_of_parts(place))
        return target

    # The tables are small jobs of their own: side by side, they take the time of the longest.
    with ThreadPoolExecutor(len(TABLES)) as pool:
        targets = dict(zip(TABLES, pool.map(one, TABLES), strict=True))
    return {name: target for name, target in targets.items() if target}


def _new_folder(target: str) -> str:
    return f"{target}/rows-{uuid.uuid4().hex}"


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("node_id"), F.lit(buckets)).cast("int")


def _publish_issues(
    rows: DataFrame, corpus: str, target: str, main: str, buckets: int, cumulative: bool, how: dict
) -> list[Row]:
    """Write the touched buckets and return the parts of the table that follows main.

    A bucket's digest is that of its ids and frameworks, in any order of rows.
    """
    spark, known = rows.sparkSession, []
    if cumulative:
        listed = _parts(spark, main)
        known = listed or []
        if known:
            buckets = known[0].buckets
            # At most as many as there are buckets.
            touched = {r[0] for r in rows.select(bucket_of(buckets)).distinct().collect()}
            existing = _rows_of(spark, corpus, [p for p in known if p.bucket in touched], "issues")
            how = how | {"strict_reference": False}
        else:
            existing = empty(spark, ISSUES) if listed is not None else read_table(spark, main, "issues")
    folder = _new_folder(target)
    if cumulative and not any(how.values()):
        dealt = merge_dealt(rows, existing, "bucket", bucket_of(buckets))
    else:
        rows = merge_latest(rows, existing, **how) if cumulative else rows
        dealt = rows.withColumn("bucket", bucket_of(buckets)).repartition("bucket")
    dealt.write.partitionBy("bucket").parquet(folder)
    if not fs.subdirs(spark, folder):
        return known
    written = spark.read.schema("node_id string, framework_slug string, bucket int").parquet(folder)
    told = written.groupBy("bucket").agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("node_id", "framework_slug").cast("decimal(38,0)")).cast("string").alias("digest"),
        F.sort_array(F.collect_set("framework_slug")).alias("slugs"),
    )
    inside = folder.removeprefix(f"{corpus}/")
    # A row for each bucket, with a name for each framework.
    made = [(r.bucket, f"{inside}/bucket={r.bucket}", buckets, r.n, r.digest, r.slugs) for r in told.collect()]
    new = {part[0] for part in made}
    return made + [p for p in known if p.bucket not in new]


def changed_issues(spark: SparkSession, corpus: str, old: str | None, new: str | None) -> tuple[DataFrame, DataFrame]:
    """Issues of two published revisions (None: main), of the buckets alone whose digests differ."""
    sides = [_parts(spark, corpus_table(corpus, r, "issues")) or [] for r in (old, new)]
    known = [{(p.bucket, p.buckets, p.rows, p.digest) for p in parts} for parts in sides]
    same = known[0] & known[1]
    rest = [[p for p in parts if (p.bucket, p.buckets, p.rows, p.digest) not in same] for parts in sides]
    return tuple(_rows_of(spark, corpus.rstrip("/"), parts, "issues") for parts in rest)


def listed_frameworks(spark: SparkSession, corpus: str, revision: str | None) -> DataFrame:
    """(framework_slug) of a published revision, from its list of parts."""
    found = {s for p in _parts(spark, corpus_table(corpus, revision, "issues")) or [] for s in p.slugs or []}
    return spark.createDataFrame([(s,) for s in sorted(found)], "framework_slug string")


def sweep(spark: SparkSession, corpus: str) -> list[str]:
    """Remove folders of rows that no list of parts names, and return them. Not while a publication runs."""
    corpus = corpus.rstrip("/")
    tables = [f"{branch}/{name}" for branch in fs.subdirs(spark, corpus) for name in TABLES]
    named = {p.folder for t in tables for p in _parts(spark, f"{corpus}/{t}") or []}
    # A bucket's folder lies in a folder of rows.
    named |= {folder.rsplit("/", 1)[0] for folder in named}
    found = [f"{t}/{n}" for t in tables for n in fs.subdirs(spark, f"{corpus}/{t}") if n.startswith("rows-")]
    gone = [folder for folder in found if folder not in named]
    for folder in gone:
        fs.delete(spark, f"{corpus}/{folder}")
    return gone
