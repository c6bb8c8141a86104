"""Files on the driver: hashes, artifacts, atomic writes, JSON lines."""

from __future__ import annotations

import hashlib
import json
import os
import re
import tempfile
from dataclasses import asdict, dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

from corpusmill.errors import FormatError, ValidationError

_CHUNK = 1 << 20


@dataclass(frozen=True)
class Artifact:
    """What a manifest states of an artifact: a file, or a folder of part files."""

    path: str
    sha256: str
    bytes: int
    records: int

    def as_dict(self) -> dict:
        return asdict(self)


def file_digests(path: Path) -> tuple[str, str, int]:
    """SHA-1, SHA-256 and size of a file in one pass."""
    first, second, size = hashlib.sha1(), hashlib.sha256(), 0
    with path.open("rb") as file:
        while chunk := file.read(_CHUNK):
            first.update(chunk)
            second.update(chunk)
            size += len(chunk)
    return first.hexdigest(), second.hexdigest(), size


def parts_of(path: Path) -> list[Path]:
    """The data files of an artifact in order: the file itself, or the parts of a folder without hidden files."""
    if path.is_file():
        return [path]
    return sorted(p for p in path.rglob("*") if p.is_file() and not p.name.startswith((".", "_")))


#: Bytes of an artifact's parts from which they are hashed by tasks and not by the driver.
DRIVER_BYTES = 64 << 20


def artifact(root: Path, name: str, records: int, spark: SparkSession | None = None) -> Artifact:
    """The summary of an artifact; a folder's hash is taken over the names and hashes of its parts.

    With a session the parts of a large folder are hashed by tasks, which read
    them from the folder all executors share.
    """
    path = root / name
    if path.is_file():
        _, digest, size = file_digests(path)
        return Artifact(name, digest, size, records)
    parts = parts_of(path)
    sizes = [p.stat().st_size for p in parts]
    if spark is not None and sum(sizes) > DRIVER_BYTES:
        hashes = _hashes_by_tasks(spark, parts)
    else:
        hashes = [file_digests(p)[1] for p in parts]
    listed = hashlib.sha256()
    for part, digest in zip(parts, hashes):
        listed.update(f"{part.relative_to(path).as_posix()} {digest}\n".encode())
    return Artifact(name, listed.hexdigest(), sum(sizes), records)


def _hashes_by_tasks(spark: SparkSession, parts: list[Path]) -> list[str]:
    def run(batches):
        for batch in batches:
            digests = [file_digests(Path(p))[1] for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(digests, pa.string())], names=["path", "sha256"])

    rows = spark.createDataFrame([(str(p),) for p in parts], "path string").repartition(len(parts))
    found = {r["path"]: r["sha256"] for r in rows.mapInArrow(run, "path string, sha256 string").collect()}
    return [found[str(p)] for p in parts]


def confined(root: Path, name: object) -> Path:
    """The place of an artifact inside a dataset; an absolute path or one that leaves it is an error."""
    if not isinstance(name, str) or not name or Path(name).is_absolute():
        raise ValidationError("an artifact path is not relative")
    path = (root / name).resolve()
    if not path.is_relative_to(root.resolve()):
        raise ValidationError("an artifact path leaves the dataset")
    return path


def write_json(path: Path, value: object) -> None:
    """Write JSON through a temporary sibling, so that a reader sees the old file or the new one."""
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    with os.fdopen(handle, "w", encoding="utf-8", newline="\n") as file:
        json.dump(value, file, ensure_ascii=False, indent=2, sort_keys=True)
        file.write("\n")
        file.flush()
        os.fsync(file.fileno())
    os.replace(temporary, path)


def read_json(path: Path, what: str) -> dict:
    """A JSON file whose root must be an object."""
    try:
        value = json.loads(path.read_text(encoding="utf-8"))
    except (OSError, ValueError) as error:
        raise ValidationError(f"{what} cannot be read: {error}") from error
    if not isinstance(value, dict):
        raise ValidationError(f"{what} is not an object")
    return value


def compact_line(row: dict) -> str:
    """A row as one line of compact JSON with sorted keys."""
    return json.dumps(row, ensure_ascii=False, sort_keys=True, separators=(",", ":")) + "\n"


def write_lines(path: Path, rows) -> int:
    """Write rows as JSON lines; the number of rows."""
    count = 0
    with path.open("w", encoding="utf-8", newline="\n") as file:
        for row in rows:
            file.write(compact_line(row))
            count += 1
    return count


def read_lines(path: Path, what: str) -> list[dict]:
    """Rows of a JSON-lines file, blank lines skipped; a line that is no object is an error."""
    rows = []
    for number, line in enumerate(path.read_text(encoding="utf-8").split("\n"), 1):
        if line.strip():
            try:
                row = json.loads(line)
            except ValueError as error:
                raise ValidationError(f"{what} line {number} is no JSON") from error
            if not isinstance(row, dict):
                raise ValidationError(f"{what} line {number} is no object")
            rows.append(row)
    return rows


def published_sha1(manifest: str, name: str) -> str:
    """The SHA-1 that a published list of ``<hash>  <file>`` lines states for a file, which it must name exactly once."""
    found = re.findall(rf"(?m)^([0-9a-fA-F]{{40}})  {re.escape(name)}$", manifest)
    if len(found) != 1:
        raise FormatError(f"the checksum list names {name} {len(found)} times")
    return found[0].lower()
