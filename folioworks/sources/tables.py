"""Tables from files: JSON lines, Parquet, downloads to a checked cache, source sets."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import urllib.error
import urllib.request
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..errors import InvalidFormatError, SourceNotFoundError, ValidationError
from ..logs import get_logger
from .ivtff import loci, read_lines

# The aligned sources, their alphabets, and whether that is EVA.
SOURCES = {"zl": ("eva", True), "it": ("eva", True), "cd": ("currier", False), "fg": ("fsg", False), "gc": ("v101", False)}

log = get_logger("sources")


def bad_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, line`` of the lines of JSON lines files that are no JSON objects; blank ones are passed over."""
    lines = read_lines(spark, path).where(F.col("line").rlike(r"\S"))
    return lines.where(F.try_parse_json("line").isNull() | ~F.ltrim("line").startswith("{")).select("file", "line_no", "line")


def check_jsonl(spark: SparkSession, path: str) -> None:
    """Raise, with its number, on the first line of a JSON lines file that is no JSON object."""
    first = bad_json_lines(spark, path).orderBy("file", "line_no").first()
    if first:
        raise InvalidFormatError(f"line {first.line_no} is no JSON object", first.line_no, first.line, file=first.file)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str | None = None, strict: bool = True) -> DataFrame:
    """Rows of a JSON lines file; ``strict`` raises on a line that is no JSON, with its number; blank lines are skipped."""
    if strict:
        check_jsonl(spark, path)
    reader = spark.read.option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    return (reader.schema(schema) if schema else reader).json(path)


def read_raw_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """``json``: the lines themselves, for checks of which fields are there."""
    return spark.read.text(path).where("value rlike '\\\\S'").withColumnRenamed("value", "json")


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def file_hashes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file, size, sha256, source_version`` of whole files."""
    files = spark.read.format("binaryFile").load(paths)
    digest = F.sha2("content", 256)
    return files.select(F.col("path").alias("file"), F.col("length").alias("size"), digest.alias("sha256"), F.left(digest, F.lit(12)).alias("source_version"))


def sha256_of_file(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


AGENT = {"User-Agent": "folioworks"}


def probe(url: str, timeout: float = 30, most_bytes: int | None = None) -> tuple[bytes, int, str]:
    """Content, status and content type of a url; an error status is returned like others, with what came with it."""
    try:
        answer = urllib.request.urlopen(urllib.request.Request(url, headers=AGENT), timeout=timeout)  # noqa: S310
    except urllib.error.HTTPError as error:
        answer = error
    with answer:
        return answer.read(most_bytes), getattr(answer, "status", None) or 200, answer.headers.get("Content-Type", "")


def fetch(url: str, to: str, sha256: str | None = None, timeout: float = 30) -> bool:
    """Download a file into a cache; whether it was needed. A file that misses its hash is removed."""
    if os.path.exists(to) and (sha256 is None or sha256_of_file(to) == sha256):
        return False
    os.makedirs(os.path.dirname(to) or ".", exist_ok=True)
    request = urllib.request.Request(url, headers=AGENT)
    with urllib.request.urlopen(request, timeout=timeout) as answer, open(to, "wb") as file:  # noqa: S310
        shutil.copyfileobj(answer, file)
    if sha256 is not None and (got := sha256_of_file(to)) != sha256:
        os.remove(to)
        raise ValidationError("downloaded file misses its hash", url=url, expected=sha256, got=got)
    return True


@dataclass(frozen=True)
class Source:
    """A registered source: where it is, what it holds, and the hash that locks it."""

    name: str
    url: str
    description: str = ""
    alphabet: str = "eva"
    sha256: str | None = None
    status: str = "unverified"


def read_registry(path: str) -> dict[str, Source]:
    """Sources by name from a JSON file, an object of objects with the fields of ``Source``."""
    with open(path, encoding="utf-8") as file:
        return {name: Source(name, **spec) for name, spec in json.load(file).items()}


def write_registry(sources: dict[str, Source], path: str) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        json.dump({name: {k: v for k, v in asdict(s).items() if k != "name"} for name, s in sorted(sources.items())}, file, indent=2, ensure_ascii=False)


def fetch_all(sources: dict[str, Source], folder: str) -> dict[str, Source]:
    """All sources into a cache; the registry with the hashes of those that had none, and of each whether it is verified.

    A source that cannot be had, or misses its hash, is ``failed``; the others go on.
    """
    found = {}
    for name, source in sources.items():
        to = os.path.join(folder, name)
        try:
            fetch(source.url, to, source.sha256)
            found[name] = replace(source, sha256=sha256_of_file(to), status="verified")
        except (OSError, ValidationError) as error:
            log.warning("source cannot be fetched", source=name, error=str(error)[:200])
            found[name] = replace(source, status="failed")
    return found


def registry_table(spark: SparkSession, sources: dict[str, Source]) -> DataFrame:
    return spark.createDataFrame([asdict(s) for s in sources.values()], "name string, url string, description string, alphabet string, sha256 string, status string")


def source_table(spark: SparkSession, sources: dict = SOURCES) -> DataFrame:
    return spark.createDataFrame([(k, a, e) for k, (a, e) in sources.items()], "source_id string, alphabet string, is_eva boolean")


def load_source(spark: SparkSession, source_id: str, path: str) -> DataFrame | None:
    """Loci of one source with ``source_id``; None, and a warning, if it cannot be read."""
    if source_id not in SOURCES:
        log.warning("unknown source", source=source_id)
        return None
    try:
        found = loci(read_lines(spark, path), comments=False).withColumn("source_id", F.lit(source_id))
    except Exception as error:
        log.warning("source cannot be read", source=source_id, error=str(error)[:200])
        return None
    return found


def load_sources(spark: SparkSession, paths: dict[str, str], primary: str = "zl") -> DataFrame:
    """Loci of all readable sources; the primary one must be among them."""
    found = {k: x for k, p in paths.items() if (x := load_source(spark, k, p)) is not None}
    if primary not in found:
        raise SourceNotFoundError(f"primary source {primary} is required", found=sorted(found))
    return reduce(DataFrame.unionByName, found.values())
