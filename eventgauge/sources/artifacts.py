"""Writing and reading the frames of a run.

Every artifact is a folder with one subfolder per run, laid out as a partition.
Writing a run again replaces its subfolder as a whole, also when the result is empty;
the latest run is found by its id, so no second copy has to be kept in step.

A run as a whole is committed by a manifest that is written after its last artifact and taken
away before its first one is replaced.  Where runs are committed, the latest run is the latest
committed one: a run that dies half way is never read by chance.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventgauge.sources.versions import Files

#: Folder of the manifests, one file a committed run.
RUNS = "_runs"
FORMATS = ("parquet", "json", "csv")


def flat(frame: DataFrame) -> DataFrame:
    """Nested columns as JSON text, for formats that hold scalars only."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return frame.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in frame.schema.fields
        ]
    )


def write_artifact(
    frame: DataFrame, root: str, artifact: str, run_id: str, fmt: str = "parquet"
) -> str:
    """Write one frame of a run; writing it again replaces it."""
    if fmt not in FORMATS:
        raise ValueError(f"artifacts are written as {', '.join(FORMATS)}, not {fmt!r}")
    path = f"{root.rstrip('/')}/{artifact}/run_id={run_id}"
    writer = (flat(frame) if fmt == "csv" else frame).write
    if fmt == "csv":
        writer = writer.option("header", "true")
    if fmt == "json":
        writer = writer.option("ignoreNullFields", "false")
    writer.mode("overwrite").format(fmt).save(path)
    return path


def write_run(
    frames: Mapping[str, DataFrame], root: str, run_id: str, fmt: str = "parquet"
) -> dict[str, str]:
    """Write all frames of a run and then its manifest."""
    if not frames:
        raise ValueError("a run has at least one artifact")
    root = root.rstrip("/")
    files = Files(next(iter(frames.values())).sparkSession, root)
    files.system.mkdirs(files.path(f"{root}/{RUNS}"))
    files.remove(f"{root}/{RUNS}/{run_id}")
    written = {name: write_artifact(frame, root, name, run_id, fmt) for name, frame in frames.items()}
    files.put(f"{root}/{RUNS}/{run_id}", json.dumps({"format": fmt, "artifacts": sorted(written)}))
    return written


def committed_runs(spark: SparkSession, root: str) -> dict[str, list[str]] | None:
    """The artifacts of every committed run by run id; None where no run was ever begun."""
    root = root.rstrip("/")
    files = Files(spark, root)
    if not files.system.exists(files.path(f"{root}/{RUNS}")):
        return None
    names = [n for n in files.names(f"{root}/{RUNS}") if not n.startswith(("_", "."))]
    return {n: json.loads(files.text(f"{root}/{RUNS}/{n}"))["artifacts"] for n in names}


def read_artifact(
    spark: SparkSession,
    root: str,
    artifact: str,
    run_id: str | None = None,
    fmt: str = "parquet",
    schema: str | None = None,
) -> DataFrame:
    """Rows of one run, or of the latest run when none is named."""
    reader = spark.read.option("header", "true") if fmt == "csv" else spark.read
    if schema is not None:
        reader = reader.schema(f"{schema}, run_id string")
    folder = f"{root.rstrip('/')}/{artifact}"
    # The folders of the runs are listed; files of other runs are not read.
    chosen = latest_run(spark, root, artifact) if run_id is None else run_id
    frame = reader.option("basePath", folder).format(fmt).load(f"{folder}/run_id={chosen}")
    # A run id of digits only is read from its folder name as a number.
    return frame.withColumn("run_id", F.lit(chosen))


def latest_run(spark: SparkSession, root: str, artifact: str) -> str:
    """The largest run id that holds an artifact, among committed runs where runs are committed."""
    committed = committed_runs(spark, root)
    if committed is not None:
        runs = [run for run, artifacts in committed.items() if artifact in artifacts]
    else:
        folder = f"{root.rstrip('/')}/{artifact}"
        names = Files(spark, folder).names(folder)
        runs = [name.removeprefix("run_id=") for name in names if name.startswith("run_id=")]
    if not runs:
        raise FileNotFoundError(f"no run of {artifact} under {root}")
    return max(runs)


def create_once(frame: DataFrame, path: str, fmt: str = "json") -> None:
    """Write a frame unless the path already holds one; manual edits stay."""
    frame.write.mode("ignore").format(fmt).save(path)
