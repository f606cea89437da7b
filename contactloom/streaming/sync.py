"""Incremental sync: delta -> clean -> map -> match -> conflict filter -> write.

``run_once`` is the nightly batch run over a table; ``sync_stream`` feeds the same
step from Structured Streaming with ``availableNow``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.operators import runs, upsert, windows
from contactloom.plans import jobs
from contactloom.sources.staging import stage
from contactloom.streaming.repeats import without_repeats
from contactloom.streaming.state import SyncState, from_micros, now, resolve_window


class RunHeld(RuntimeError):
    """The failure rate exceeded its limit; the watermark was not moved."""


def _write_changes(target: DataFrame, writes: DataFrame, path: str) -> None:
    """Store what a run writes: one row per touched record."""
    updates = upsert.collapse_updates(writes).join(target.select("hs_id"), "hs_id", "left_semi")
    rows = updates.withColumn("created", F.lit(False)).unionByName(
        upsert.fold_inserts(writes).withColumn("created", F.lit(True)), allowMissingColumns=True
    )
    stage(rows.select("hs_id", "ord", "created", *upsert.PROPS), path, wide=True)


def _process(
    state: SyncState, delta: DataFrame, owner_map: DataFrame | None, seq: int, catalog: DataFrame | None = None, dry_run: bool = False
) -> dict:
    """Write the changes of one delta and return its counters (scalars only).

    A dry run plans and counts the same way, keeps the plan for a look at it, and writes no change.
    """
    staged = f"{state.root}/staged/{'dry' if dry_run else 'run'}={seq}"
    target = state.identities()
    planned = jobs.plan_updates(
        delta, target, owner_map, allowlist=rules.UPDATE_ALLOWLIST, small_delta=True, catalog=catalog
    )
    writes = stage(planned, staged, wide=True)
    if dry_run:
        return runs.judged(upsert.write_counts(target, writes)).first().asDict()
    _write_changes(target, writes, state.change_path(seq))
    upsert.failed_records(target, writes).write.mode("overwrite").parquet(f"{state.root}/failed/run={seq}")
    return runs.judged(upsert.write_counts(target, writes)).first().asDict()


def run_once(
    state: SyncState,
    source: DataFrame,
    until: datetime,
    owner_map: DataFrame | None = None,
    since: datetime | None = None,
    dry_run: bool = False,
    max_failure_rate: float = rules.MAX_FAILURE_RATE,
    exclude_tags: list[str] = rules.LOOP_GUARD_TAGS,
    catalog: DataFrame | None = None,
) -> dict:
    """One sync run; the watermark row is the last thing written.

    A crash records a failed run and re-raises; a held run keeps the watermark,
    so its window is read again.  Both are safe because writes are keyed.
    A dry run records in ``dry_runs`` what it would update, insert and withhold; target, history and
    watermark stay, and ``planned_writes`` shows its plan.
    """
    lower, origin = resolve_window(state, until, since)
    seq = state.head()["seq"] + 1
    summary = {
        "seq": seq, "started_at": until, "since": lower, "until": until, "dry_run": dry_run,
        "updated": 0, "inserted": 0, "failed": 0, "skipped": 0, "withheld": 0, "failure_rate": 0.0,
    }
    try:
        delta = windows.changed_since(source, lower, until, exclude_tags)
        delta = stage(delta, f"{state.root}/staged/{'dry_delta' if dry_run else 'delta'}={seq}")  # the source is scanned once
        changed = delta.count()
        summary |= {"changed": changed, "ok": True, "finished_at": now()}
        if changed == 0:
            state.record(**summary, advance_to=None if dry_run else until)
            return summary | {"origin": origin}
        counts = _process(state, delta, owner_map, seq, catalog, dry_run)
        ok = counts["failed"] <= max_failure_rate * counts["processed"]
        summary |= {k: counts[k] for k in ("updated", "inserted", "failed", "skipped", "withheld", "failure_rate")}
        summary |= {"ok": ok, "wrote": not dry_run, "finished_at": now()}
        state.record(**summary, advance_to=until if ok and not dry_run else None)
        return summary | {"origin": origin}
    except Exception as err:
        state.record(**summary | {"finished_at": now(), "ok": False, "error": str(err)})
        raise


def planned_writes(state: SyncState, seq: int, dry_run: bool = False) -> DataFrame:
    """What a run planned to write: one row per changed contact with its action, target and properties."""
    return state.spark.read.parquet(f"{state.root}/staged/{'dry' if dry_run else 'run'}={seq}")


def sync_stream(
    state: SyncState,
    changes: DataFrame,
    checkpoint: str,
    owner_map: DataFrame | None = None,
    max_failure_rate: float = rules.MAX_FAILURE_RATE,
    exclude_tags: list[str] = rules.LOOP_GUARD_TAGS,
    catalog: DataFrame | None = None,
    repeats_within: str | None = None,
):
    """Start an ``availableNow`` query over a stream of changed contacts.

    A micro-batch above the failure limit raises: its offsets stay uncommitted
    and the same rows are replayed at the next start.
    With ``repeats_within`` (such as ``"7 days"``) a change that arrived before in that time is left out by a state store;
    choose it before the first start, as a checkpoint keeps its operators.
    """
    if repeats_within:
        changes = without_repeats(changes, repeats_within)

    def step(batch: DataFrame, batch_id: int) -> None:
        head = state.head()
        if head["batch_id"] is not None and batch_id <= head["batch_id"]:
            return  # already committed
        seq = head["seq"] + 1
        if repeats_within:
            batch = stage(batch, f"{state.root}/staged/batch={batch_id}")  # the state is gone through once
        edge = batch.agg(
            F.unix_micros(F.min("dateUpdated")), F.unix_micros(F.max("dateUpdated")), F.count_if(F.col("dateUpdated").isNull())
        ).first()
        bounds = {"lo": from_micros(edge[0]), "hi": from_micros(edge[1])}
        undated = edge[2]  # rows without a change time can't be placed; they count as skipped
        base = {"seq": seq, "started_at": now(), "batch_id": batch_id, "dry_run": False}
        if bounds["hi"] is None:
            state.record(**base, finished_at=now(), ok=True, changed=0, skipped=undated)
            return
        delta = windows.changed_since(batch, bounds["lo"], bounds["hi"], exclude_tags)
        counts = _process(state, delta, owner_map, seq, catalog)
        ok = counts["failed"] <= max_failure_rate * counts["processed"]
        counts["skipped"] += undated
        newest = max(bounds["hi"], head["watermark"] or bounds["hi"])  # an older batch does not move it back
        state.record(
            **base,
            finished_at=now(), ok=ok, since=bounds["lo"], until=bounds["hi"], wrote=True,
            changed=counts["input"],
            **{k: counts[k] for k in ("updated", "inserted", "failed", "skipped", "withheld", "failure_rate")},
            advance_to=newest if ok else None,
        )
        if not ok:
            raise RunHeld(f"failure rate {counts['failure_rate']} above {max_failure_rate}")

    return (
        changes.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
