"""Apply auto-merge pairs as if one after another, but in parallel rounds.

A pair (primary, to_merge) succeeds when neither record was merged away by an
earlier pair.  Only *earlier* pairs that merge one of the two records matter, so
every pair whose relevant earlier pairs are decided can be decided at once.
Rounds are needed only along chains of merges; a record with many duplicates is
one round.  Each round is written through ``checkpoint()``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.operators.upsert import PROPS
from contactloom.sources.staging import shared_root


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names when none is set yet."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{shared_root(spark)}/contactloom-checkpoints")


def ordered_pairs(dup: DataFrame) -> DataFrame:
    """Auto pairs with a sortable position: by block, then by record order."""
    from contactloom.functions import text as T
    from contactloom.operators.dedupe import AUTO

    name = T.name_key(F.col("primary.firstname"), F.col("primary.lastname"))
    auto = dup.where(F.col("classification") == AUTO)
    return auto.select(
        F.col("primary.hs_id").alias("p"),
        F.col("to_merge.hs_id").alias("m"),
        F.struct(name.alias("block"), "ord_a", "ord_b").alias("pos"),
        "reason",
    )


def decide_merges(pairs: DataFrame) -> DataFrame:
    """Add ``merged`` (true/false) to pairs ``(p, m, pos, ...)``.

    Every round decides at least the earliest open pair, so rounds go on until none
    is open.  Only open pairs are carried on; of decided ones just the first
    merge of each record is kept at hand.
    """
    ensure_checkpoint_dir(pairs.sparkSession)
    left = pairs.checkpoint()
    done: list[DataFrame] = []
    lost = None
    while not left.isEmpty():
        # earliest success and earliest open pair per record that would be merged away
        waits = left.groupBy(F.col("m").alias("rec")).agg(F.min("pos").alias("open_at"))
        gone = waits.withColumn("gone_at", F.lit(None).cast(waits.schema["open_at"].dataType))
        if lost is not None:
            gone = waits.join(lost, "rec", "full").select("rec", "open_at", "gone_at")
        gone = gone.select("rec", "gone_at", "open_at")
        g1 = gone.toDF("p", "gone_p", "open_p")
        g2 = gone.toDF("m", "gone_m", "open_m")
        joined = left.join(g1, "p", "left").join(g2, "m", "left")
        dead = F.coalesce(F.col("gone_p") < F.col("pos"), F.lit(False)) | F.coalesce(
            F.col("gone_m") < F.col("pos"), F.lit(False)
        )
        waiting = F.coalesce(F.col("open_p") < F.col("pos"), F.lit(False)) | F.coalesce(
            F.col("open_m") < F.col("pos"), F.lit(False)
        )
        decided = F.when(dead, F.lit(False)).when(~waiting, F.lit(True))
        state = joined.select(*pairs.columns, decided.alias("merged")).checkpoint()
        done.append(state.where(F.col("merged").isNotNull()))
        left = state.where(F.col("merged").isNull()).drop("merged")
        new = state.where("merged").groupBy(F.col("m").alias("rec")).agg(F.min("pos").alias("gone_at"))
        both = new if lost is None else lost.unionByName(new)
        lost = both.groupBy("rec").agg(F.min("gone_at").alias("gone_at")).checkpoint()
        if len(done) == 32:  # keeps plans short on long chains
            done = [reduce(DataFrame.unionByName, done).checkpoint()]
    if not done:
        return left.withColumn("merged", F.lit(None).cast("boolean"))
    return reduce(DataFrame.unionByName, done)


def survivors(decided: DataFrame) -> DataFrame:
    """Per merged record its final survivor and the path of merge positions.

    Pointer jumping: every round doubles the covered chain length.  The path
    orders a survivor's sources as the single merges would have filled blanks.
    """
    links = decided.where(F.col("merged")).select(
        F.col("m").alias("rec"), F.col("p").alias("root"), F.array("pos").alias("path")
    ).checkpoint()
    while True:
        up = links.select(
            F.col("rec").alias("root"), F.col("root").alias("_next"), F.col("path").alias("_path")
        )
        stepped = links.join(up, "root", "left")
        moved = stepped.select(
            "rec",
            F.coalesce("_next", "root").alias("root"),
            F.concat(F.coalesce("_path", F.array().cast(links.schema["path"].dataType)), F.col("path")).alias("path"),
            F.col("_next").isNotNull().alias("_moved"),
        ).checkpoint()
        links = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return links


def merge_duplicates(target: DataFrame, decided: DataFrame) -> DataFrame:
    """Target without merged records; survivors' blanks filled in merge order."""
    columns = target.columns
    props = [p for p in PROPS if p in columns]
    where_to = survivors(decided)
    none = F.array().cast(where_to.schema["path"].dataType)
    members = where_to.select(F.col("rec").alias("hs_id"), F.col("root").alias("_root"), F.col("path").alias("_path"))
    roots = where_to.select("root").distinct().select(
        F.col("root").alias("hs_id"), F.col("root").alias("_root"), none.alias("_path")
    )
    # only the records taking part are gathered, not the whole target
    sources = target.select("hs_id", *props).join(members.unionByName(roots), "hs_id")
    filled = sources.groupBy("_root").agg(
        *[F.min_by(p, F.when(F.col(p).isNotNull(), F.col("_path"))).alias(f"_f_{p}") for p in props]
    )
    kept = target.join(where_to.select(F.col("rec").alias("hs_id")), "hs_id", "left_anti")
    return kept.join(filled.withColumnRenamed("_root", "hs_id"), "hs_id", "left").select(
        *[F.coalesce(c, f"_f_{c}").alias(c) if c in props else F.col(c) for c in columns]
    )


def merge_report(decided: DataFrame, dup: DataFrame) -> DataFrame:
    """merged / failed counts and skipped manual-review pairs."""
    from contactloom.operators.dedupe import REVIEW

    done = decided.agg(
        F.count_if(F.col("merged")).alias("merged"), F.count_if(~F.col("merged")).alias("failed")
    )
    skipped = dup.agg(F.count_if(F.col("classification") == REVIEW)).scalar()
    return done.select("merged", "failed", skipped.alias("skipped"))
