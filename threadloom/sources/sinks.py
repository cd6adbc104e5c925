"""Writers: routed and ordered files, tables, reports, and publication with the manifest last."""

from __future__ import annotations

import hashlib
import json
import os
from html import escape
from pathlib import Path
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators.validation import demand, matrix_faults


def file_digest(path: Path) -> str:
    """A27."""
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def fingerprint(df: DataFrame) -> tuple[int, int]:
    """A27 for tables: number of rows and a sum of row hashes, the same in any order and partitioning."""
    row = df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")), F.lit(0))).first()
    return int(row[0]), int(row[1])


def write_jsonl(df: DataFrame, path: str, order: list[str]) -> None:
    """JSON lines, globally in order over as many files as there are ranges."""
    df.orderBy(*order).write.mode("error").json(path)


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder per split in one pass."""
    df.write.mode("error").partitionBy(split).json(path)


def write_matrix(df: DataFrame, folder: str, key: str, vector: str, dims: int) -> str:
    """A matrix of float32 rows in order of ``key``, checked first (V01); returns the table's path below ``folder``."""
    demand(matrix_faults(df, vector, dims), "the matrix has faults")
    path = f"{folder}/matrix-{uuid4().hex}"
    df.select(key, F.col(vector).cast("array<float>").alias(vector)).repartitionByRange(key).sortWithinPartitions(key).write.parquet(path)
    return path


def report_bundle(folder: Path, name: str, title: str, rows: list[tuple[str, float]]) -> list[Path]:
    """An aggregate as JSON, Markdown, CSV and SVG beside each other; refuses if one is there."""
    out = {
        "json": json.dumps({"title": title, "rows": [list(r) for r in rows]}, ensure_ascii=False, indent=1),
        "md": markdown(title, rows),
        "csv": "measure,value\n" + "".join(f"\"{str(k).replace(chr(34), chr(34) * 2)}\",{v}\n" for k, v in rows),
        "svg": bar_chart(rows, title),
    }
    paths = [folder / f"{name}.{kind}" for kind in out]
    if there := [p for p in paths if p.exists()]:
        raise FileExistsError(there[0])
    folder.mkdir(parents=True, exist_ok=True)
    for path, text in zip(paths, out.values()):
        path.write_text(text, encoding="utf-8")
    return paths


def write_table(df: DataFrame, path: str, order: list[str]) -> None:
    """An aggregate, which is small, as one CSV file with a header."""
    df.orderBy(*order).coalesce(1).write.mode("error").option("header", True).csv(path)


def bar_chart(rows: list[tuple[str, float]], title: str, width: int = 900, row: int = 34) -> str:
    """Horizontal bars in proportion, as SVG; for a collected aggregate."""
    top = max([v for _, v in rows], default=0) or 1
    bars = "".join(f'<text x="8" y="{row * i + 56}">{escape(k)}</text><rect x="260" y="{row * i + 40}" width="{(width - 360) * v / top:.1f}" height="{row - 12}"/><text x="{width - 90}" y="{row * i + 56}">{v:g}</text>' for i, (k, v) in enumerate(rows))
    return f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{row * len(rows) + 50}"><title>{escape(title)}</title><text x="8" y="24">{escape(title)}</text>{bars}</svg>'


def markdown(title: str, rows: list[tuple[str, object]]) -> str:
    """A report of aggregates only."""
    return f"# {title}\n\n| measure | value |\n|-|-|\n" + "".join(f"| {k} | {v} |\n" for k, v in rows)


def publish(folder: Path, files: dict[str, bytes], manifest: dict, force: bool = False) -> Path:
    """Data first and the manifest, with all digests, last, each renamed into place; nothing stays behind on failure."""
    target = folder / "manifest.json"
    if target.exists() and not force:
        raise FileExistsError(target)
    folder.mkdir(parents=True, exist_ok=True)
    made: list[tuple[Path, Path]] = []
    try:
        whole = manifest | {"files": {n: hashlib.sha256(b).hexdigest() for n, b in files.items()}}
        for name, data in [*files.items(), ("manifest.json", json.dumps(whole, indent=1, sort_keys=True).encode())]:
            temporary = folder / f".{name}.{uuid4().hex}"
            made.append((temporary, folder / name))
            temporary.write_bytes(data)
        for temporary, final in made:
            os.replace(temporary, final)
    finally:
        for temporary, _ in made:
            temporary.unlink(missing_ok=True)
    return target


def validated(folder: Path, names: set[str] | None = None) -> dict:
    """A snapshot's manifest, if its files are exactly those named and have their digests; else ValueError."""
    manifest = json.loads((folder / "manifest.json").read_text())
    found = {p.name for p in folder.iterdir()} - {"manifest.json"}
    if found != set(manifest["files"]) or (names is not None and found != names):
        raise ValueError(f"files differ from the manifest: {sorted(found ^ set(manifest['files']))}")
    for name, digest in manifest["files"].items():
        if file_digest(folder / name) != digest:
            raise ValueError(f"{name} was changed")
    return manifest


def switch(current: Path, snapshot: Path) -> Path | None:
    """Points ``current`` at a validated snapshot in one step and returns where it pointed, for a rollback."""
    validated(snapshot)
    before = current.resolve() if current.is_symlink() else None
    temporary = current.with_name(f".{current.name}.{uuid4().hex}")
    temporary.symlink_to(snapshot.resolve())
    os.replace(temporary, current)
    return before
