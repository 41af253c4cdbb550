"""Readers: Parquet with a row index, JSON lines, benchmarks, ZIP and tar archives."""

from __future__ import annotations

import hashlib
import io
import json
import re
import tarfile
import zipfile
from pathlib import PurePosixPath
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.mcq import completion_text
from ..functions.text import overlap_key

FILE_LIMIT, TOTAL_LIMIT, LINES_LIMIT = 10 << 20, 256 << 20, 50 << 20


def _bare(path: str) -> str:
    return re.sub(r"^file:/+", "/", unquote(path)).rstrip("/")


def file_rows(spark: SparkSession, paths: list[str]) -> DataFrame:
    """file, rows of each Parquet file under paths that has rows: one scan that reads no column."""
    return spark.read.parquet(*paths).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))


def indexed(spark: SparkSession, paths: list[str], columns: list[str] | None = None) -> DataFrame:
    """Rows of Parquet files with row_index, which runs through the files in the order given (those of a folder by name).

    One scan counts the rows of all files, another reads them; the driver sees a row for each file.
    """
    bare = [_bare(p) for p in paths]

    def place(file: str) -> tuple[int, str]:
        own = _bare(file)
        return next((i for i, p in enumerate(bare) if own == p or own.startswith(p + "/")), len(bare)), own

    counts = sorted(((place(r.file), r.file, r.rows) for r in file_rows(spark, paths).collect()))
    starts, at = [], 0
    for _, file, rows in counts:
        starts.append((file, at))
        at += rows
    df = spark.read.option("mergeSchema", True).parquet(*paths)
    offsets = F.broadcast(spark.createDataFrame(starts, "_file string, _start long"))
    names = columns or df.columns
    rows = df.select(*names, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_index")).join(offsets, "_file")
    return rows.select(*names, (F.col("_index") + F.col("_start")).alias("row_index"))


def checked_counts(spark: SparkSession, expected: dict[str, int]) -> None:
    """ValueError unless the Parquet files or folders hold as many rows as a manifest says; no column is read."""
    for path, rows in expected.items():
        if (have := spark.read.parquet(path).count()) != rows:
            raise ValueError(f"{path}: {have} rows, {rows} in the manifest")


def bounded_lines(path: str, limit: int = LINES_LIMIT) -> tuple[list[dict], str]:
    """Objects of a small JSON-lines file of the driver, and the SHA-256 of its bytes; larger files and other values are errors."""
    with open(path, "rb") as file:
        raw = file.read(limit + 1)
    if len(raw) > limit:
        raise ValueError(f"{path}: more than {limit} bytes; use a sample")
    rows = [json.loads(line) for line in raw.decode("utf-8-sig").splitlines() if line.strip()]
    if not all(isinstance(r, dict) for r in rows):
        raise ValueError(f"{path}: a line is no object")
    return rows, hashlib.sha256(raw).hexdigest()


def message_texts(spark: SparkSession, root: str, names: tuple[str, ...] = ("train.jsonl", "validation.jsonl")) -> DataFrame:
    """label ("file:id:index"), text of all messages whose content is a string that is not blank, in those files of root that are there."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    there = [n for n in names if (p := jvm.org.apache.hadoop.fs.Path(f"{root}/{n}")).getFileSystem(conf).exists(p)]
    out = spark.createDataFrame([], "label string, text string")
    for name in there:
        rows = spark.read.text(f"{root}/{name}").where("trim(value) <> ''").select(F.parse_json("value").alias("v"))
        messages = rows.select(F.coalesce(F.variant_get("v", "$.id", "string"), F.lit("unknown")).alias("id"), F.posexplode(F.variant_get("v", "$.messages", "array<variant>")).alias("i", "m"))
        content = F.variant_get("m", "$.content", "variant")
        said = messages.where(F.schema_of_variant(content) == "STRING").select("id", "i", F.variant_get("m", "$.content", "string").alias("text"))
        out = out.union(said.where(F.col("text").rlike(r"\S")).select(F.concat(F.lit(f"{name}:"), "id", F.lit(":"), F.col("i").cast("string")), "text"))
    return out


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines file; a byte-order mark is taken off, a line that is no object is an error."""
    lines = spark.read.text(path).where("trim(value) <> ''").select(F.regexp_replace("value", "^\\x{FEFF}", "").alias("value"))
    parsed = lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r"))
    return parsed.select("r.*")


def benchmarks(spark: SparkSession, paths: dict[str, str | None]) -> DataFrame:
    """hash, name of each distinct prompt and variant; a benchmark without a path isn't checked."""
    out = spark.createDataFrame([], "hash string, name string")
    for name, path in paths.items():
        if path:
            rows = json_lines(spark, path, "prompt string, variants array<string>")
            texts = rows.select(F.explode(F.array_append(F.coalesce("variants", F.array().cast("array<string>")), F.col("prompt"))).alias("text"))
            if texts.isEmpty():
                raise ValueError(f"benchmark {name} is empty")
            out = out.union(texts.select(overlap_key("text").alias("hash"), F.lit(name).alias("name")))
    return out.distinct()


def zip_members(spark: SparkSession, path: str) -> DataFrame:
    """path, member, text of the JSON members of ZIP files; names that leave the archive and sizes beyond the limits are errors."""
    def run(batches):
        for pdf in batches:
            rows = []
            for name, content in zip(pdf.path, pdf.content):
                total = 0
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.infolist():
                        place = PurePosixPath(member.filename.replace("\\", "/"))
                        total += member.file_size
                        if place.is_absolute() or ".." in place.parts or member.file_size > FILE_LIMIT or total > TOTAL_LIMIT:
                            raise ValueError(f"{name}: {member.filename} is not acceptable")
                        if place.suffix == ".json" and not member.is_dir():
                            rows.append((name, member.filename, archive.read(member).decode("utf-8-sig")))
            yield pd.DataFrame(rows, columns=["path", "member", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, member string, text string")


def _texts(value):
    """A string without white space at its ends; of a list, the texts in it that are not empty, nested as they are; of anything else, the empty string."""
    if isinstance(value, list):
        return [t for t in map(_texts, value) if t]
    return value.strip() if isinstance(value, str) else ""


def _first(*values):
    return next((v for v in values if v), None)


def evaluation_rows(members: DataFrame) -> DataFrame:
    """id ("archive:member:id"), task, task_name, metric, instruction, input, references, choices and prompt of the rows of members (path, member, text) that have an output and something to do.

    Rows are in data.dev of the envelope, or of the object that its json holds; the metric is named by itself or first in a list.
    """
    flat = lambda v: v if isinstance(v, list) else [v] if v else []

    def run(batches):
        for pdf in batches:
            rows = []
            for path, member, text in zip(pdf.path, pdf.member, pdf.text):
                outer = json.loads(text)
                inner = outer["json"] if isinstance(outer.get("json"), dict) else outer
                data = inner.get("data")
                if not isinstance(data, dict) or not isinstance(data.get("dev"), list):
                    raise ValueError(f"{member}: no rows in data.dev")
                listed = inner.get("metric_list")
                listed = listed[0] if isinstance(listed, list) and listed else None
                metric = str(_first(outer.get("metric"), inner.get("metric"), listed.get("metric") if isinstance(listed, dict) else listed) or "").lower()
                task = str(_first(outer.get("task"), inner.get("task"), outer.get("category")) or "unknown")
                name = str(_first(inner.get("name"), outer.get("name")) or task)
                for at, row in enumerate(data["dev"]):
                    row = {k: _texts(v) if k != "id" else v for k, v in row.items()} if isinstance(row, dict) else {}
                    given = row.get("input", "")
                    given = "\n".join(map(str, given)) if isinstance(given, list) else given
                    if row.get("output") and (row.get("instruction") or given):
                        key = f"{PurePosixPath(path).stem}:{member}:{row.get('id', at)}"
                        rows.append((key, task, name, metric, str(row.get("instruction", "")), given, [str(x) for x in flat(row["output"])], [str(x) for x in flat(row.get("mcq"))]))
            yield pd.DataFrame(rows, columns=["id", "task", "task_name", "metric", "instruction", "input", "references", "choices"])

    found = members.select("path", "member", "text").mapInPandas(run, "id string, task string, task_name string, metric string, instruction string, input string, references array<string>, choices array<string>")
    return found.withColumn("prompt", completion_text(F.col("instruction"), F.col("input"), F.col("choices")))


def tar_lines(spark: SparkSession, path: str, names: tuple[str, ...] = ("sample.jsonl", "examples.jsonl")) -> DataFrame:
    """id, example_hash, input_hash of earlier packs' rows in tar.gz files; nothing is unpacked to disk."""
    def run(batches):
        for pdf in batches:
            rows = []
            for content in pdf.content:
                with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as archive:
                    for member in archive:
                        if member.isfile() and PurePosixPath(member.name).name in names:
                            if member.size > LINES_LIMIT:
                                raise ValueError(f"{member.name} is too large")
                            for line in archive.extractfile(member).read().decode("utf-8-sig").splitlines():
                                if line.strip():
                                    x = json.loads(line)
                                    rows.append(tuple(x.get(k) for k in ("id", "example_hash", "input_hash")))
            yield pd.DataFrame(rows, columns=["id", "example_hash", "input_hash"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "id string, example_hash string, input_hash string")
