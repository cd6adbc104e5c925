"""Resumable runs of named stages over checked tables."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession

from threadloom.operators.splitting import whole_groups
from threadloom.operators.validation import id_faults
from threadloom.sources.sinks import fingerprint

Stage = Callable[[DataFrame], DataFrame]


@dataclass
class Plan:
    """What a dry run says: each stage with run, skip or blocked, and the checks by outcome."""

    stages: list[tuple[str, str]]
    checks: list[tuple[str, str, str]] = field(default_factory=list)

    @property
    def blocked(self) -> bool:
        return any(state == "blocked" for _, state, _ in self.checks)


class Runner:
    """Stages in order, each output a Parquet table bound to its input by fingerprints, the state file written last and in one step."""

    def __init__(self, spark: SparkSession, folder: Path, stages: list[tuple[str, Stage]], config: dict, gates: dict[str, Callable[[DataFrame], str]] | None = None):
        self.spark, self.folder, self.stages, self.gates = spark, folder, stages, gates or {}
        self.config_hash = hashlib.sha256(json.dumps(config, sort_keys=True).encode()).hexdigest()
        self.state_path = folder / "run.json"

    def state(self) -> dict:
        return json.loads(self.state_path.read_text()) if self.state_path.exists() else {"stages": []}

    def _save(self, state: dict) -> None:
        temporary = self.state_path.with_suffix(".tmp")
        temporary.write_text(json.dumps(state, indent=1))
        os.replace(temporary, self.state_path)

    def _out(self, name: str) -> str:
        return str(self.folder / f"{name}.parquet")

    def done(self, source: DataFrame, restart_from: str | None = None) -> int:
        """How many stages at the front hold: same configuration and input, outputs unchanged."""
        state = self.state()
        if state.get("config") != self.config_hash or state.get("source") != list(fingerprint(source)):
            return 0
        n = 0
        for (name, _), entry in zip(self.stages, state["stages"]):
            if name == restart_from or entry["name"] != name or entry["status"] != "done" or not os.path.exists(self._out(name)):
                break
            if list(fingerprint(self.spark.read.parquet(self._out(name)))) != entry["output"]:
                break
            n += 1
        return n

    def dry_run(self, source: DataFrame, expected: int | None = None, tolerance: float = 0.1, minimum_free: int = 0, restart_from: str | None = None, columns: tuple[str, ...] = (), key: str | None = None, resources: dict[str, str] | None = None, vectors: int = 0) -> Plan:
        """Reads only. Says what would run, and whether rows, columns, ids, named resources, the state of an earlier run and disk space allow it.

        ``resources`` maps names to paths that must be there; ``vectors`` is the length of the vectors that stages will
        write, from which the disk space is estimated: four times their float32 bytes, ``minimum_free`` at least.
        """
        done = self.done(source, restart_from)
        plan = Plan([(n, "skip" if i < done else "run") for i, (n, _) in enumerate(self.stages)])
        n = fingerprint(source)[0]
        plan.checks.append(("rows", "ready" if n else "blocked", str(n)))
        lost = [c for c in columns if c not in source.columns]
        plan.checks.append(("columns", "blocked" if lost else "ready", ", ".join(lost)))
        if key and key in source.columns:
            faults = id_faults(source, key).first()
            plan.checks.append(("ids", "blocked" if faults["blank"] or faults["repeated"] else "ready", f"{faults['blank']} blank, {faults['repeated']} repeated"))
        for name, path in (resources or {}).items():
            plan.checks.append((f"resource {name}", "ready" if Path(path).exists() else "blocked", path))
        names = [x for x, _ in self.stages]
        plan.checks.append(("stages", "blocked" if len(set(names)) < len(names) or (restart_from and restart_from not in names) else "ready", ", ".join(names)))
        earlier = self.state().get("status")
        plan.checks.append(("earlier run", "warning" if earlier in ("running", "failed") else "ready", str(earlier)))
        minimum_free = max(minimum_free, 4 * n * vectors * 4)
        if expected:
            plan.checks.append(("expected_rows", "ready" if abs(n - expected) / expected <= tolerance else "warning", str(expected)))
        where = self.folder if self.folder.exists() else self.folder.parent
        free = shutil.disk_usage(where).free
        plan.checks.append(("disk", "ready" if free >= minimum_free else "blocked", str(free)))
        return plan

    def run(self, source: DataFrame, stop_after: str | None = None, restart_from: str | None = None) -> dict:
        """Runs what doesn't hold yet; stops at a gate that asks for review, at a failure, or after a named stage."""
        self.folder.mkdir(parents=True, exist_ok=True)
        before = list(fingerprint(source))
        done = self.done(source, restart_from)
        state = {"config": self.config_hash, "source": before, "status": "running", "stages": self.state()["stages"][:done]}
        at = source if not done else self.spark.read.parquet(self._out(self.stages[done - 1][0]))
        for name, stage in self.stages[done:]:
            began = time.time()
            entry = {"name": name, "status": "running", "input": list(fingerprint(at))}
            state["stages"].append(entry)
            self._save(state)
            try:
                stage(at).write.mode("overwrite").parquet(self._out(name))
            except Exception as e:
                entry |= {"status": "failed", "error": type(e).__name__, "duration_seconds": time.time() - began}
                state["status"] = "failed"
                self._save(state)
                raise
            at = self.spark.read.parquet(self._out(name))
            entry |= {"status": "done", "output": list(fingerprint(at)), "duration_seconds": time.time() - began}
            gate = self.gates.get(name)
            verdict = gate(at) if gate else "pass"
            if verdict != "pass":
                state["status"] = "failed" if verdict == "fail" else "awaiting_review"
                break
            if name == stop_after:
                state["status"] = "stopped"
                break
        else:
            state["status"] = "done"
        if list(fingerprint(source)) != before:
            state["status"] = "failed"
            self._save(state)
            raise ValueError("the source changed during the run")
        self._save(state)
        return state


def smoke(spark: SparkSession, folder: Path, stages: list[tuple[str, Stage]], config: dict, source: DataFrame, group: Column, target: int = 2_000, seed: int = 42, gates: dict | None = None) -> dict:
    """The stages over whole groups of about ``target`` rows, in a folder of its own below ``folder``. Its state says that it is a smoke run, which is never published."""
    sample = whole_groups(source, group, seed, target)
    runner = Runner(spark, folder / "smoke", stages, config | {"smoke": target}, gates)
    state = runner.run(sample) | {"smoke": True, "rows": fingerprint(sample)[0]}
    runner._save(state)
    return state


def publishable(state: dict) -> bool:
    """Whether a run's state allows publication: done, and no smoke run."""
    return state.get("status") == "done" and not state.get("smoke")


class Snapshot:
    """A loaded snapshot, loaded again when its manifest changes; the last good one stays if the new one doesn't load."""

    def __init__(self, manifest: Path, load: Callable[[Path], object]):
        self.manifest, self.load, self.seen, self.value, self.error = manifest, load, None, None, None

    def get(self):
        stamp = self.manifest.stat().st_mtime_ns if self.manifest.exists() else None
        if stamp is not None and stamp != self.seen:
            try:
                self.value, self.error = self.load(self.manifest.parent), None
            except Exception as e:  # noqa: BLE001  the last good snapshot goes on serving
                self.error = e
            self.seen = stamp
        if self.value is None:
            raise self.error or FileNotFoundError(self.manifest)
        return self.value
