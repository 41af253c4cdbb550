"""Sinks: outputs appear whole or not at all."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def publish(frames: dict[str, DataFrame], target: str) -> None:
    """Writes each frame as zstd Parquet beside its place and renames all when all are written; an existing target is an error."""
    spark = next(iter(frames.values())).sparkSession
    jvm = spark._jvm
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(path(target)):
        raise FileExistsError(target)
    partial = target.rstrip("/") + ".partial"
    fs.delete(path(partial), True)
    for name, df in frames.items():
        df.write.option("compression", "zstd").parquet(f"{partial}/{name}")
    if not fs.rename(path(partial), path(target)):
        raise OSError(f"{partial} can't be renamed")


def fan_out(decided: DataFrame, target: str) -> None:
    """One evaluated frame of decisions to kept rows, held-out rows and all decisions."""
    decided = decided.persist()  # to memory and disk; blocks of a lost executor are computed again
    try:
        publish({"candidates": decided.where("decision = 'keep'"), "holdout": decided.where("decision = 'holdout'"), "decisions": decided}, target)
    finally:
        decided.unpersist()


def write_json(path: str, value) -> None:
    """A JSON file of the driver, replaced in one step."""
    fd, temporary = tempfile.mkstemp(dir=os.path.dirname(path) or ".", suffix=".tmp")
    with os.fdopen(fd, "w", encoding="utf-8") as file:
        json.dump(value, file, ensure_ascii=False, indent=2, sort_keys=True, allow_nan=False)
    os.replace(temporary, path)


def write_sample(df: DataFrame, path: str, order: list[str], limit: int = 100_000) -> int:
    """A bounded sample as sorted JSON lines; more rows than the limit are an error."""
    rows = df.orderBy(*order).select(F.to_json(F.struct("*")).alias("line")).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows")
    with open(path, "x", encoding="utf-8") as file:
        file.writelines(r.line + "\n" for r in rows)
    return len(rows)


def freeze(path: str, rows: list[dict], receipt: str) -> str:
    """Writes rows as JSON lines to a file that must not be there yet, and a receipt with the SHA-256 of its bytes; returns that."""
    raw = "".join(json.dumps(r, ensure_ascii=False, sort_keys=True, allow_nan=False) + "\n" for r in rows).encode()
    with open(path, "xb") as file:
        file.write(raw)
    digest = hashlib.sha256(raw).hexdigest()
    write_json(receipt, {"sha256": digest, "rows": len(rows)})
    return digest


def unchanged(path: str, receipt: str) -> bool:
    """Whether a frozen file still has the bytes of its receipt."""
    with open(path, "rb") as file, open(receipt, encoding="utf-8") as other:
        return hashlib.sha256(file.read()).hexdigest() == json.load(other)["sha256"]


def report(title: str, tables: dict[str, DataFrame], facts: dict | None = None, limit: int = 1000) -> str:
    """A Markdown report of facts and of aggregated tables, rows sorted; a table of more rows than the limit is an error, not cut."""
    cell = lambda x: "" if x is None else str(x).replace("|", "\\|").replace("\n", " ")
    out = [f"# {title}", *([""] if facts else []), *(f"- {k}: {cell(v)}" for k, v in (facts or {}).items())]
    for name, df in tables.items():
        rows = df.orderBy(*df.columns).limit(limit + 1).collect()
        if len(rows) > limit:
            raise ValueError(f"{name}: more than {limit} rows")
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns), *("| " + " | ".join(map(cell, r)) + " |" for r in rows)]
    return "\n".join(out) + "\n"
