"""Merges of duplicate groups in order, with records instead of record pairs.

Applied one after another, a pair (a, b) succeeds if neither record was merged away before, and the pairs stand in the
order of their records.  So a record meets the later ones that are still there, in order, until it loses; everything it
beats on the way is gone.  Which records pair is known per *profile* (name, e-mail, phone): copies are one node.

Profiles linked by automatic pairs form groups (connected components, in rounds of joins).  A group is settled by one task
that holds 40 bytes a record: the next record still there is found per profile by pointers that skip merged ones, so
a group of n copies costs some n steps, not n * n.  The outcome is one row per merge.  A group of copies of one profile,
the only kind whose size has no bound in practice, never gathers: its survivors are running maxima, see ``copy_merges``.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions import text as T
from contactloom.sources.staging import stage
from contactloom.sources.workers import importable

#: Records of one copy group that are compared in one window; larger groups are cut into such pieces first.
PIECE = 100_000
MERGES = "p string, m string, pos struct<block: string, ord_a: bigint, ord_b: bigint>, reason string"


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges (a, b) is connected to.

    Every round moves edges to the smallest neighbour of their ends; pointers are then doubled to their ends.
    """
    left = stage(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    roots = None
    while not left.isEmpty():
        ends = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = stage(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("r")).select("node", F.least("node", "r").alias("root")))
        while True:
            ahead = step.select(F.col("node").alias("root"), F.col("root").alias("up"))
            step = stage(step.join(ahead, "root", "left").select("node", F.coalesce("up", "root").alias("root"), (F.col("up") < F.col("root")).alias("more")))
            more = not step.where("more").isEmpty()
            step = step.select("node", "root")
            if not more:
                break
        a, b = step.toDF("a", "x"), step.toDF("b", "y")
        left = stage(
            left.join(a, "a").join(b, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
        if roots is None:
            roots = step
        else:
            later = step.select(F.col("node").alias("root"), F.col("root").alias("end"))
            roots = stage(roots.join(later, "root", "left").select("node", F.coalesce("end", "root").alias("root")))
    return left.select(F.col("a").alias("node"), F.col("b").alias("root")) if roots is None else roots


def seen(prefix: str = "") -> Column:
    """Last activity in microseconds, else creation, else 0."""
    t = F.coalesce(F.col(f"{prefix}hs_last_activity_date"), F.col(f"{prefix}createdate"))
    return F.coalesce(F.unix_micros(t.cast("timestamp")), F.lit(0).cast("bigint"))


def copy_merges(recs: DataFrame, reason: str) -> DataFrame:
    """Merges inside groups of copies: ``recs`` has name_key, group, ord, hs_id, at.

    All copies pair with each other and only their time decides, the earlier one winning a tie.  So a record that is
    newer than all before it takes over from the last such record, and every other one goes to the newest before it.
    Newest records are found inside pieces of the group first; only they are compared across pieces.
    """
    piece = F.pmod(F.floor(F.col("ord") / PIECE), F.lit(1 << 40)).alias("piece")  # pieces are stretches of the order
    given = recs.select("name_key", "group", "ord", "hs_id", "at", piece)
    tops = given.groupBy("group", "piece").agg(F.max_by(F.struct("at", "ord", "hs_id"), F.struct("at", -F.col("ord"))).alias("top"))
    before = Window.partitionBy("group").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    best = F.struct(F.col("top.at").alias("at"), (-F.col("top.ord")).alias("back"), F.col("top.hs_id").alias("hs_id"))
    carried = tops.select("group", "piece", F.max(best).over(before).alias("carried"))
    own = F.struct(F.col("at"), (-F.col("ord")).alias("back"), F.col("hs_id"))
    inside = Window.partitionBy("group", "piece").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    ranked = given.withColumn("own", own).withColumn("inside", F.max(own).over(inside)).join(carried, ["group", "piece"])
    rival = F.greatest("inside", "carried")  # the newest record before this one, the earliest of equals
    wins = F.col("at") > F.col("rival.at")
    pos = F.struct(F.col("name_key").alias("block"), (-F.col("rival.back")).alias("ord_a"), F.col("ord").alias("ord_b"))
    return ranked.withColumn("rival", rival).where("rival IS NOT NULL").select(
        F.when(wins, F.col("hs_id")).otherwise(F.col("rival.hs_id")).alias("p"),
        F.when(wins, F.col("rival.hs_id")).otherwise(F.col("hs_id")).alias("m"),
        pos.alias("pos"), F.lit(reason).alias("reason"),
    )


def settle(order: np.ndarray, node: np.ndarray, common: np.ndarray, mail: np.ndarray, at: np.ndarray, links: dict[int, list[int]]) -> Iterator[tuple[int, int, int, int]]:
    """(winner, loser, earlier, later) of every merge, as places in these arrays, which stand in input order."""
    members = {n: np.flatnonzero(node == n) for n in set(node.tolist())}
    place = np.empty(len(order), np.int64)
    for rows in members.values():
        place[rows] = np.arange(len(rows))
    skip = {n: np.arange(len(rows) + 1) for n, rows in members.items()}
    gone = np.zeros(len(order), bool)

    def there(n: int, i: int) -> int:
        """First member of the node at or after place ``i`` that is still there."""
        step, end = skip[n], i
        while step[end] != end:
            end = step[end]
        while step[i] != end:
            step[i], i = end, step[i]
        return int(end)

    def drop(u: int) -> None:
        gone[u] = True
        skip[int(node[u])][place[u]] = place[u] + 1

    for u in range(len(order)):
        if gone[u]:
            continue
        heap = []
        for n in links.get(int(node[u]), ()):
            i = there(n, int(np.searchsorted(members[n], u, side="right")))
            if i < len(members[n]):
                heap.append((int(members[n][i]), n, i))
        heapq.heapify(heap)
        while heap:
            v, n, i = heapq.heappop(heap)
            stays = bool(common[u]) if common[u] != common[v] else bool(mail[u]) if mail[u] != mail[v] else at[u] >= at[v]
            yield (u, v, u, v) if stays else (v, u, u, v)
            drop(v if stays else u)
            if not stays:
                break
            i = there(n, i + 1)
            if i < len(members[n]):
                heapq.heappush(heap, (int(members[n][i]), n, i))


def _settle_group(key: tuple, recs: pa.Table, edges: pa.Table) -> pa.Table:
    recs = recs.sort_by("ord")
    names = {n: i for i, n in enumerate(sorted(set(recs["node"].to_pylist())))}
    node = np.array([names[n] for n in recs["node"].to_pylist()], np.int64)
    links: dict[int, list[int]] = {}
    why = {}
    for e in edges.to_pylist():
        a, b = names[e["a"]], names[e["b"]]
        for x, y in {(a, b), (b, a)}:
            links.setdefault(x, []).append(y)
            why[x, y] = e["reason"]
    column = lambda c: recs[c].to_numpy()
    ord_, ids = column("ord"), recs["hs_id"].to_pylist()
    done = list(settle(ord_, node, column("common"), column("mail"), column("at"), links))
    block = recs["name_key"][0].as_py()
    kind = pa.struct([("block", pa.string()), ("ord_a", pa.int64()), ("ord_b", pa.int64())])
    return pa.table({
        "p": pa.array([ids[w] for w, _, _, _ in done], pa.string()), "m": pa.array([ids[x] for _, x, _, _ in done], pa.string()),
        "pos": pa.array([{"block": block, "ord_a": int(ord_[a]), "ord_b": int(ord_[b])} for _, _, a, b in done], kind),
        "reason": pa.array([why[int(node[a]), int(node[b])] for _, _, a, b in done], pa.string()),
    })


def merges(target: DataFrame, found=None) -> DataFrame:
    """(p, m, pos, reason, merged): the automatic merges that succeed, one row per record merged away.

    ``pos`` is the pair's place in the sequence.  Pairs that fail are those of ``dedupe.duplicate_pairs`` not listed here.
    ``found`` is a ``dedupe.Search`` of the target made before.
    """
    from contactloom.operators import dedupe

    node = F.md5(F.concat_ws("\u0000", "name_key", "e", "p"))
    found = found or dedupe.search(target)
    recs = found.recs
    pairs = found.pairs.where(dedupe.pair_class(F.col("reason")) == dedupe.AUTO)

    def end(i: int) -> Column:
        return F.md5(F.concat_ws("\u0000", F.col("name_key"), F.col(f"e{i}"), F.col(f"p{i}")))

    edges = stage(pairs.select(end(1).alias("a"), end(2).alias("b"), "reason"))
    roots = components(edges)
    within = recs.select(
        "name_key", "ord", "hs_id", node.alias("node"), seen().alias("at"), (F.col("e") != "").alias("mail"),
        T.email_domain(F.col("e")).isin(*rules.COMMON_MAIL_DOMAINS).alias("common"),
    )
    linked = roots.select("node", F.col("root").alias("group"))
    lone = edges.where("a = b").select(F.col("a").alias("node"), "reason").join(linked, "node", "left_anti")
    copies = copy_merges(
        within.join(lone.select("node"), "node", "left_semi").withColumn("group", F.col("node")), "same_phone_one_no_email"
    )
    grouped = within.join(linked, "node").groupBy("group")
    inside = edges.join(linked.toDF("a", "of"), "a").groupBy("of")
    importable(target.sparkSession)
    mixed = grouped.cogroup(inside).applyInArrow(_settle_group, MERGES)
    return copies.select("p", "m", "pos", "reason").unionByName(mixed).withColumn("merged", F.lit(True))


def outcomes(target: DataFrame) -> DataFrame:
    """Every automatic pair with ``merged``, in the columns of ``merge.ordered_pairs``."""
    from contactloom.operators import dedupe, merge

    found = dedupe.search(target)
    done = merges(target, found).select(F.col("p"), F.col("m"), F.col("pos"), "merged")
    pairs = merge.ordered_pairs(dedupe.duplicate_pairs(target, found))
    return pairs.join(done, ["p", "m", "pos"], "left").withColumn("merged", F.coalesce("merged", F.lit(False))).select("p", "m", "pos", "reason", "merged")


def failures(target: DataFrame) -> DataFrame:
    """Automatic pairs that did not merge, with both records' names and why.

    Their number grows with the square of a group; ``failure_counts`` has them per reason.
    """
    from contactloom.operators import dedupe

    found = dedupe.search(target)
    done = stage(merges(target, found))
    name = lambda s: F.trim(F.concat_ws(" ", F.coalesce(f"{s}.firstname", F.lit("")), F.coalesce(f"{s}.lastname", F.lit(""))))
    pairs = dedupe.duplicate_pairs(target, found).where(F.col("classification") == dedupe.AUTO).select(
        "reason", F.col("primary.hs_id").alias("primary_id"), F.coalesce("primary.email", F.lit("")).alias("primary_email"), name("primary").alias("primary_name"),
        F.col("to_merge.hs_id").alias("duplicate_id"), F.coalesce("to_merge.email", F.lit("")).alias("duplicate_email"), name("to_merge").alias("duplicate_name"),
        F.struct("ord_a", "ord_b").alias("at"),
    )
    lost = done.select(F.col("m").alias("id"), F.struct("pos.ord_a", "pos.ord_b").alias("lost_at"))
    kept_out = pairs.join(lost.toDF("primary_id", "primary_lost"), "primary_id", "left").join(lost.toDF("duplicate_id", "duplicate_lost"), "duplicate_id", "left")
    first = F.coalesce(F.col("primary_lost") < F.col("at"), F.lit(False))
    second = F.coalesce(F.col("duplicate_lost") < F.col("at"), F.lit(False))
    error = F.when(first & second, "both merged before").when(first, "primary merged before").when(second, "duplicate merged before")
    return kept_out.withColumn("error", error).where("error IS NOT NULL").select(
        "reason", "primary_id", "primary_email", "primary_name", "duplicate_id", "duplicate_email", "duplicate_name", "error"
    )


def merge_counts(target: DataFrame) -> DataFrame:
    """merged, failed and skipped (manual review) pairs, without listing one."""
    from contactloom.operators import dedupe

    found = dedupe.search(target)
    every = dedupe.duplicate_profiles(target, found).agg(
        F.coalesce(F.sum(F.when(F.col("classification") == dedupe.AUTO, F.col("n_pairs"))), F.lit(0)).alias("auto"),
        F.coalesce(F.sum(F.when(F.col("classification") == dedupe.REVIEW, F.col("n_pairs"))), F.lit(0)).alias("skipped"),
    )
    merged = merges(target, found).agg(F.count(F.lit(1)).alias("merged"))
    return every.crossJoin(merged).select("merged", (F.col("auto") - F.col("merged")).cast("bigint").alias("failed"), F.col("skipped").cast("bigint").alias("skipped"))
