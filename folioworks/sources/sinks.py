"""Writing tables and reports: canonical JSON lines, Parquet, hashes, manifests, cards."""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import __version__
from .ordered import digest_of_lines, write_lines


def canonical_json(frame: DataFrame) -> Column:
    """A row as JSON with sorted keys, no blanks, nulls kept and text unescaped."""
    return F.to_json(F.struct(*sorted(frame.columns)), {"ignoreNullFields": "false"})


def row_hash(frame: DataFrame) -> Column:
    return F.sha2(canonical_json(frame), 256)


def write_canonical_lines(frame: DataFrame, path: str, *order: Column | str) -> None:
    """The same without a hash, which one task would have to read the whole file for."""
    write_lines(frame, canonical_json(frame), path, *order)


def write_canonical_jsonl(frame: DataFrame, path: str, *order: Column | str) -> str:
    """Rows in order as one file with line feeds, written by executors; returns its SHA-256."""
    write_canonical_lines(frame, path, *order)
    return digest_of_lines(frame.sparkSession, path).first()["sha256"]


def write_jsonl(frame: DataFrame, path: str) -> None:
    """Rows as a folder of JSON lines, nulls and nested values kept."""
    frame.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_parquet(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").parquet(path)


def write_split(frame: DataFrame, folder: str, split: str = "train") -> str:
    """Rows as one split of a data set, a Parquet folder of its name."""
    write_parquet(frame, path := f"{folder}/{split}.parquet")
    return path


def write_splits(frame: DataFrame, folder: str, split_col: str = "split") -> None:
    """All splits of a data set, a partition each."""
    frame.write.mode("overwrite").partitionBy(split_col).parquet(folder)


def flatten_section(frame: DataFrame) -> DataFrame:
    """``section`` as four plain columns; alternatives are left out."""
    flat = [F.col(f"section.{k}").alias(f"section_{k}") for k in ("value", "attribution", "confidence", "disputed")]
    return frame.select(*(c for c in frame.columns if c != "section"), *flat)


def flatten_folios(frame: DataFrame) -> DataFrame:
    return flatten_section(frame).withColumn("verso_page_ids", F.array_join("verso_page_ids", ","))


def write_json(value: dict, path: str, sort_keys: bool = True) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as file:
        json.dump(value, file, indent=2, sort_keys=sort_keys, ensure_ascii=False)


def write_sums(hashes: dict[str, str], path: str) -> None:
    """``hash  name`` lines as sha256sum reads them."""
    with open(path, "w", encoding="utf-8", newline="\n") as file:
        file.writelines(f"{digest}  {name}\n" for name, digest in hashes.items())


def check_sums(path: str) -> dict[str, bool]:
    """Whether each file named beside a sums file has its hash."""
    folder, found = os.path.dirname(path), {}
    with open(path, encoding="utf-8") as file:
        for line in file:
            digest, name = line.rstrip("\n").split("  ", 1)
            with open(os.path.join(folder, name), "rb") as data:
                found[name] = hashlib.file_digest(data, "sha256").hexdigest() == digest
    return found


def manifest(report: dict, name: str, version: str, canonical: str, sha256: str, others: dict[str, str] | list[str], source: str = "primary", charset: str = "folioworks.functions.charset.CLEAN") -> dict:
    """What a release holds, what may be relied on, and how its canonical file is verified.

    The format is this library's own. ``others`` are further files, each with a
    word on why its bytes may differ from build to build.
    """
    others = others if isinstance(others, dict) else dict.fromkeys(others, "not the same bytes in every build")
    counted = ("total_pages_in_source", "pages_with_lines", "pages_without_lines", "total_lines", "total_characters", "total_words")
    return {
        "format": "folioworks release 1",
        "release": {"name": name, "version": version, "built": report.get("build_date"), "library": __version__},
        "source": {"id": source, "file": report.get("source_file"), "sha256": report.get("source_hash"), "as_expected": bool(report.get("source_verified"))},
        "files": [
            {"name": canonical, "role": "canonical", "sha256": sha256, "same_bytes": True},
            *({"name": n, "role": "derived", "same_bytes": False, "remark": why} for n, why in others.items()),
        ],
        "promises": {
            "clean_text": f"text_clean holds no characters but those of {charset}; the rule is {report.get('text_clean_policy')}",
            "flags": "flags tell what the text holds once its tags are off and before its marks are",
            "lines": "one JSON object a line, keys sorted, no blanks, null fields kept, line feeds on every system",
            "order": "folio, side, panel, line",
        },
        "verify": {"command": "sha256sum --check SHA256SUMS", "covers": [canonical], "beyond": "a Parquet file holds the same rows, its bytes depend on who writes it"},
        "statistics": {k: report.get(k) for k in counted},
    }


def render_card(template: str, to: str, values: dict[str, str]) -> None:
    """A template file with ``{{KEY}}`` replaced; unknown keys stay."""
    with open(template, encoding="utf-8") as file:
        text = file.read()
    for key, value in values.items():
        text = text.replace("{{" + key + "}}", value)
    os.makedirs(os.path.dirname(to) or ".", exist_ok=True)
    with open(to, "w", encoding="utf-8") as file:
        file.write(text)
