"""Quality rules as a bitmask ledger.

``ledger`` looks at every text once and stores what it measured and one failure bit per rule.
``apply_policy`` keeps or drops rows by a versioned mask over those bits, and ``ablation`` tells from
the counts of each bit pattern what every rule of a policy costs; neither reads a text again.

All expressions are built in.  The ledger needs no shuffle; the ablation shuffles one row per bit
pattern and task.

Defined cases: a null text counts as empty and fails ``few_words``; a null id stays null; repeated rows
are judged each on its own; further columns of the input are not read; an empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.llm.common import WS, count_chars, paired, spaced, texts

SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: name -> condition over the measurements; the place in the list is the bit.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 14 * n_words"),
    ("capitals", "2 * n_capitals > word_chars"),
    ("exclamations", "10 * n_exclamations > 3 * n_words"),
    ("stutters", "10 * n_stutters > 3 * n_words"),
]


@dataclass(frozen=True)
class Policy:
    """A version name and the rules whose failure drops a row."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = [n for n, _ in RULES]
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_windows"))
#: All rules but ``repeated_lines``: prose with a repeated line is often sound.
STRICT = Policy("strict-2", tuple(n for n, _ in RULES if n != "repeated_lines"))


def _repeat_words(windows: str, order: str) -> Column:
    """Words inside windows whose hash occurs twice, given (hash, place) sorted by hash."""
    twice = F.filter(
        order,
        lambda x, i: F.coalesce(F.get(F.col(order), i - 1)["h"] == x["h"], F.lit(False))
        | F.coalesce(F.get(F.col(order), i + 1)["h"] == x["h"], F.lit(False)),
    )
    places = F.sort_array(F.transform(twice, lambda x: x["p"]))
    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(
        places,
        start,
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n")),
        lambda acc: acc["n"].cast("long"),
    )


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements that rules refer to.

    Windows are compared by 64-bit hashes, built by doubling: pairs, fours, eights.  Only a text in
    which some window repeats has its windows sorted.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WS.replace("[", "[^")))
    base = texts(docs).select(
        "doc_id",
        F.length(F.replace(spaced(F.col("text")), F.lit(" "), F.lit(""))).cast("long").alias("word_chars"),
        count_chars(text, SYMBOLS).alias("n_symbols"),
        count_chars(text, "!").alias("n_exclamations"),
        F.octet_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long").alias("n_capitals"),
        lines.alias("_lines"),
        F.transform(F.array_remove(F.split(spaced(F.col("text")), " "), ""), lambda w: F.xxhash64(w)).alias("_one"),
    )
    kept = ["doc_id", "word_chars", "n_symbols", "n_exclamations", "n_capitals"]
    counted = base.select(
        *kept,
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_one").cast("long").alias("n_words"),
        F.size(F.filter("_one", lambda w, i: w == F.get("_one", i - 1))).cast("long").alias("n_stutters"),
        paired("_one", 1).alias("_two"),
    )
    kept += ["n_lines", "n_dup_lines", "n_words", "n_stutters"]
    fours = counted.select(*kept, paired("_two", 2).alias("_four"))
    eights = fours.select(
        *kept, F.slice(paired("_four", 4), 1, F.greatest(F.col("n_words").cast("int") - 7, F.lit(0))).alias("_eight")
    )
    repeats = F.size("_eight") > F.size(F.array_distinct("_eight"))
    sorted_windows = F.sort_array(F.transform("_eight", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    ordered = eights.select(*kept, F.when(repeats, sorted_windows).alias("_order"))
    return ordered.select(
        *kept, F.coalesce(_repeat_words("_eight", "_order"), F.lit(0)).cast("long").alias("n_repeat_words")
    )


def ledger(docs: DataFrame) -> DataFrame:
    """Measurements plus ``fail_bits``, one bit per rule of ``RULES``."""
    bits = [F.when(F.expr(cond), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, cond) in enumerate(RULES)]
    return measure(docs).withColumn("fail_bits", sum(bits[1:], bits[0]))


def failed(policy: Policy) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")) != 0


def apply_policy(entries: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with ``kept`` and ``policy`` added."""
    return entries.withColumns({"kept": ~failed(policy), "policy": F.lit(policy.version)})


def ablation(entries: DataFrame, policy: Policy) -> DataFrame:
    """Per rule: rows it fails, rows only it fails (kept again without it), rows the policy drops.

    Rows are first counted per masked bit pattern, at most 2 to the number of rules per task.
    """
    masked = entries.select(F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("m"))
    patterns = masked.groupBy("m").agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(
        F.array(*[
            F.struct(F.lit(n).alias("rule"), F.lit(1 << i).cast("long").alias("bit"))
            for i, (n, _) in enumerate(RULES) if n in policy.rules
        ])
    )
    rows = patterns.select("m", "n", rules.alias("r"))
    return rows.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(F.col("m").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("m") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(F.col("m") != 0, F.col("n")).otherwise(0)).alias("n_dropped"),
        F.bit_or("m").alias("seen_bits"),
    )
