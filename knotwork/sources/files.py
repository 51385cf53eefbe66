"""Readers of record, truth and id files, their path rules, and writers of results."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import id_list

RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("entity_id", "business_name", "business_address", "country")])
TRUTH = T.StructType([T.StructField(n, T.StringType()) for n in ("source1_entity_id", "matched_entity_ids")])
#: The variable that names the data folder.
DATA_VARIABLE = "KNOTWORK_DATA_DIR"


def read_records(spark: SparkSession, path: str, sep: str = "\t", ordered: bool = False) -> DataFrame:
    """A record file with a header and quoted fields; rows without an id are dropped. ordered adds `ord`, the place in the file."""
    rows = spark.read.csv(path, sep=sep, header=True, schema=RECORD, quote='"', escape='"', multiLine=True, mode="PERMISSIVE")
    rows = rows.select(*[F.coalesce(c, F.lit("")).alias(c) for c in RECORD.names]).where(F.trim("entity_id") != "")
    return number_rows(rows) if ordered else rows


def number_rows(rows: DataFrame) -> DataFrame:
    """rows with `ord` from 0 in file order: a count per partition, then places within each."""
    marked = rows.withColumn("_m", F.monotonically_increasing_id())
    part = F.shiftright("_m", 33)
    counts = dict(marked.groupBy(part.alias("p")).count().collect())  # a number for each partition
    starts, total = [], 0
    for p in sorted(counts):
        starts.append((p, total))
        total += counts[p]
    base = F.create_map(*[F.lit(x) for pair in starts for x in pair]) if starts else None
    at = F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    return marked.withColumn("ord", (base[part] + at) if starts else at).drop("_m")


def first_rows(records: DataFrame, limit: int | None) -> DataFrame:
    """The first rows by `ord`; all of them for None or 0."""
    return records.where(F.col("ord") < limit) if limit else records


def row_range(records: DataFrame, start: int, end: int) -> DataFrame:
    return records.where((F.col("ord") >= start) & (F.col("ord") < end))


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """(q, ids): every query, those without a match with an empty array."""
    rows = spark.read.csv(path, sep="\t", header=True, schema=TRUTH, quote='"', escape='"')
    return rows.select(F.trim("source1_entity_id").alias("q"), id_list(F.col("matched_entity_ids")).alias("ids")).where("q <> ''")


def truth_pairs(truth: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """(q, id), if asked only of the queries in only (q)."""
    kept = truth if only is None else truth.join(only.select("q").distinct(), "q", "left_semi")
    return kept.select("q", F.explode("ids").alias("id")).distinct()


def count_lines(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count()


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The first column of a tab-separated file, behind its header."""
    lines = spark.read.text(path)
    first = F.trim(F.split("value", "\t")[0])
    return lines.select(first.alias("id")).where((F.col("id") != "") & (F.col("id") != "entity_id"))


def read_result_lines(spark: SparkSession, path: str) -> tuple[str | None, DataFrame]:
    """(header line, the other lines as `value`)."""
    lines = spark.read.text(path)
    head = lines.first()
    header = head["value"] if head else None
    return header, lines.where(~F.col("value").startswith("source1_entity_id\t"))


def guaranteed_universe(targets: DataFrame, truth: DataFrame, size: int) -> DataFrame:
    """All targets (id, ord) that truth names, and the first others by ord up to size rows in all."""
    needed = targets.join(truth.select("id").distinct(), "id", "left_semi")
    others = targets.join(truth.select("id").distinct(), "id", "left_anti")
    free = max(0, size - needed.count())
    return needed.unionByName(others.orderBy("ord", "id").limit(free))


def missing_positives(universe: DataFrame, targets: DataFrame, truth: DataFrame) -> DataFrame:
    """Targets that truth names and the universe lacks: none, if it was made as above."""
    return targets.join(truth.select("id").distinct(), "id", "left_semi").join(universe, "id", "left_anti")


def data_dir(given: str | None = None, defaults: tuple[str, ...] = ("data", "dataset")) -> Path:
    """The folder given, else the one that the environment names, else the first default that is there, else the last."""
    for name in (given, os.environ.get(DATA_VARIABLE)):
        if name and (clean := name.strip().strip("\"'")):
            place = Path(clean).expanduser()
            return place / "dataset" if not place.exists() and (place / "dataset").exists() else place
    return next((Path(d) for d in defaults if Path(d).exists()), Path(defaults[-1]))


def data_file(folder: Path, split: str, name: str) -> Path:
    """A table's file: in the split's folder or beside it, with or without the split in its name, .tsv or .csv, in any case."""
    wanted = [f"{stem}{end}" for stem in (f"{split}_{name}", name) for end in (".tsv", ".csv")]
    for place in (folder / split, folder / split.upper(), folder):
        if place.is_dir():
            there = {p.name.lower(): p for p in place.iterdir()}
            for w in wanted:
                if w.lower() in there:
                    return there[w.lower()]
    return folder / split / wanted[0]


def id_lists(queries: DataFrame, found: DataFrame, name: str, sort_ids: bool = False) -> DataFrame:
    """(source1_entity_id, name): a row for every query (q), its ids of found (q, id, place) in order, comma-joined."""
    order = F.struct("id", "place") if sort_ids else F.struct("place", "id")
    lists = found.groupBy("q").agg(F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["id"]), ",").alias("_l"))
    return queries.select("q").distinct().join(lists, "q", "left").select(F.col("q").alias("source1_entity_id"), F.coalesce("_l", F.lit("")).alias(name))


def write_tsv(frame: DataFrame, path: str) -> None:
    """Unquoted; an empty list stays empty."""
    frame.write.mode("overwrite").csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="")


def write_stage(frame: DataFrame, path: str) -> DataFrame:
    """A finished stage is read again, an unfinished one is written anew: Spark marks a whole write with _SUCCESS."""
    spark = frame.sparkSession
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        frame.write.mode("overwrite").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def write_report(frame: DataFrame, path: str) -> None:
    frame.coalesce(1).write.mode("overwrite").json(path)
