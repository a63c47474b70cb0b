"""Writers: small final tables as one file each, whole result folders at once, reports and manifests. Large tables are written by Spark as Parquet."""

from __future__ import annotations

import contextlib
import hashlib
import json
import math
import os
import platform
import shutil
import tempfile
from collections.abc import Iterator
from importlib import metadata
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sorrel.sources.readers import checksum


def cell(x) -> str:
    """Text of a value: shortest round-trip floats, blank for null and NaN, True and False."""
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return ""
    return repr(x) if isinstance(x, float) else str(x)


def write_tsv(df: DataFrame, path: str, order: list[str], columns: list[str] | None = None) -> None:
    """One file, streamed row by row in order and put in place when whole. An empty table is a header."""
    columns = columns or df.columns
    folder = os.path.dirname(os.path.abspath(path))
    fd, temp = tempfile.mkstemp(dir=folder)
    try:
        with os.fdopen(fd, "w", encoding="utf-8", newline="") as out:
            out.write("\t".join(columns) + "\n")
            for row in df.orderBy(*order).select(*columns).toLocalIterator():
                out.write("\t".join(cell(x) for x in row) + "\n")
        os.replace(temp, path)
    except BaseException:
        os.unlink(temp)
        raise


def write_parts(df: DataFrame, path: str, order: list[str]) -> None:
    """A folder of tab-separated parts, written by the tasks, for tables that grow with the data: the parts' names follow the order, and rows are in order within each."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.options(sep="\t", header=True, nullValue="", emptyValue="").csv(path)


@contextlib.contextmanager
def published(path: str) -> Iterator[Path]:
    """A folder that appears with all its files or not at all; a target that isn't empty, or is a link, is refused."""
    target = Path(path)
    if target.is_symlink() or (target.exists() and (not target.is_dir() or any(target.iterdir()))):
        raise FileExistsError(f"{path} isn't an empty folder")
    target.parent.mkdir(parents=True, exist_ok=True)
    stage = Path(tempfile.mkdtemp(prefix=".stage-", dir=target.parent))
    try:
        yield stage
        if target.exists():
            target.rmdir()
        os.rename(stage, target)
    except BaseException:
        shutil.rmtree(stage, ignore_errors=True)
        raise


def safe_path(root: str, relative: str) -> Path:
    """A path below root, without links or dots."""
    p = Path(relative)
    if p.is_absolute() or ".." in p.parts or not p.parts:
        raise ValueError(f"{relative!r} isn't a plain relative path")
    full = Path(root, p)
    if any(x.is_symlink() for x in (full, *full.parents) if x != Path(root).parent and str(x).startswith(str(root))):
        raise ValueError(f"{relative!r} goes through a link")
    return full


def json_text(value) -> str:
    return json.dumps(value, sort_keys=True, indent=2, allow_nan=False) + "\n"


def run_identity(operation: str, inputs: dict[str, str], parameters: dict) -> dict:
    """What a run depends on, and the id that follows from it."""
    identity = {"operation": operation, "inputs": inputs, "parameters": parameters}
    return identity | {"run_id": hashlib.sha256(json_text(identity).encode()).hexdigest()}


def manifest(folder: Path) -> dict[str, str]:
    """Checksums of all files of a folder but its own provenance."""
    return {str(p.relative_to(folder)): checksum(str(p)) for p in sorted(folder.rglob("*")) if p.is_file() and p != folder / "provenance.json"}


def verify(folder: Path, expected: dict[str, str]) -> None:
    if (found := manifest(folder)) != expected:
        raise ValueError(f"files differ from the manifest: {sorted(set(found.items()) ^ set(expected.items()))}")


def environment() -> dict:
    """Versions of what a run depends on; no names of hosts, users or folders."""
    return {"python": platform.python_version(), "platform": platform.platform(), "packages": {x: metadata.version(x) for x in ("pyspark", "pyarrow", "pandas", "numpy")}}


def copied(spark: SparkSession, source: Path, out: Path, names: tuple[str, ...]) -> list[dict]:
    """Copy the named files, and the files of the named folders, of a source that driver and executors share; relative_path, bytes and sha256 of each, in order. What isn't named isn't copied.

    Each file is copied and read back by a task of its own, so no table passes through the driver. A copy is put in place when it is whole, so a task that is run again leaves the same file.
    """
    files = []
    for name in names:
        path = safe_path(str(source), name)
        if not path.exists():
            raise FileNotFoundError(f"{name} isn't there")
        files += [name] if path.is_file() else sorted(str(p.relative_to(source)) for p in path.rglob("*") if p.is_file() and p.name[0] not in "._")
    for name in files:
        safe_path(str(source), name)
    source, out = source.resolve(), out.resolve()

    def copy(batches):
        for batch in batches:
            rows = []
            for name in batch.column(0).to_pylist():
                target = out / name
                target.parent.mkdir(parents=True, exist_ok=True)
                fd, temp = tempfile.mkstemp(dir=target.parent)
                os.close(fd)
                shutil.copyfile(source / name, temp)
                os.chmod(temp, 0o644)
                os.replace(temp, target)
                rows.append((name, target.stat().st_size, checksum(str(target))))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string()), strict=True)] if rows else [pa.array([], t) for t in (pa.string(), pa.int64(), pa.string())], ["relative_path", "bytes", "sha256"])

    listed = spark.createDataFrame([(i, x) for i, x in enumerate(files)], "i long, name string").repartitionByRange(max(1, min(len(files), 1000)), "i").select("name")
    done = listed.mapInArrow(copy, "relative_path string, bytes long, sha256 string")
    return [r.asDict() for r in done.orderBy("relative_path").collect()]


def joined(spark: SparkSession, folder: Path, path: Path) -> None:
    """Make one file of a folder's parts, in the order of their names, and delete the folder. Sums of the parts' sizes say where each goes, and a task for each writes it there, so a task that is run again writes the same bytes."""
    parts = sorted(p for p in folder.resolve().iterdir() if p.name[0] not in "._")
    sizes = [p.stat().st_size for p in parts]
    target = path.resolve()
    with open(target, "wb") as f:
        f.truncate(sum(sizes))

    def place(batches):
        for batch in batches:
            for at, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with open(name, "rb") as source, open(target, "r+b") as out:
                    out.seek(at)
                    shutil.copyfileobj(source, out)
            yield pa.RecordBatch.from_arrays([batch.column(1)], ["name"])

    listed = [(sum(sizes[:i]), str(p)) for i, p in enumerate(parts) if sizes[i]]
    if listed:
        spark.createDataFrame(listed, "at long, name string").repartitionByRange(min(len(listed), 1000), "at").mapInArrow(place, "name string").count()
    shutil.rmtree(folder)


def write_fasta(records: DataFrame, path: str, name: str, sequence: str, width: int = 60) -> None:
    """One FASTA file in order of the names, which are expected to be encoded. Tasks write the records in ranges of names, and put the ranges together."""
    lines = F.array_join(F.regexp_extract_all(sequence, F.lit(f"(.{{1,{width}}})"), 1), "\n")
    n = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folder = Path(f"{path}.parts")
    records.repartitionByRange(n, name).sortWithinPartitions(name).select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), lines).alias("value")).write.text(str(folder))
    joined(records.sparkSession, folder, Path(path))


def markdown(title: str, sections: dict[str, DataFrame], preview: int = 10) -> str:
    """A report with the first rows of ordered tables."""
    out = [f"# {title}", ""]
    for name, df in sections.items():
        rows = df.limit(preview).collect()
        out += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(cell(x) for x in r) + " |" for r in rows), ""]
    return "\n".join(out)
