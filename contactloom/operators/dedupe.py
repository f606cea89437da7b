"""Find duplicate record pairs inside blocks of equal names.

The rules compare e-mails, phones and edit distances of two records with the
same normalised name.  Records are first reduced to distinct *profiles*
(name, e-mail, phone): a group of copies is one profile with a member count.

A name of few e-mails (``SMALL_BLOCK``) is compared with itself, which costs less than the keys below.  In larger blocks
pairs come from equality joins, whatever the size:

* profiles with the same usable phone: all of them qualify;
* e-mails with the same local part of four characters or more;
* e-mails with the same domain, which then differ in the local part only: by its segments (``segments``);
* e-mails with different domains: the distinct domains of a name are compared first, then local parts by segments within
  each pair of domains that few edits can turn into each other, also when an edit moves the @ sign;
* e-mails with no or several @ signs: by segments of the whole text.

A common domain thus never makes strangers meet.  What grows with a square is only the number of distinct domains of one
name.  E-mail pairs are made distinct before they are expanded to profiles, and profiles to records.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions import text as T
from contactloom.operators import segments
from contactloom.sources.staging import stage

AUTO, REVIEW = "auto-merge", "manual-review"  # fixed values
MAX_EDITS = 4  # fixed value: largest e-mail distance any rule accepts
LOCAL_CHARS = 4  # fixed value: shortest local part that pairs records by itself
SHORT_EDITS = 2  # fixed value: largest distance of domains, beyond that of local parts, any rule accepts
SMALL_BLOCK = 48  # e-mails of a name that are all compared; an e-mail of a larger block asks for up to 49 keys in each join
PHONE_SLICE = 2048  # records of one name and phone that a task compares with as many others at a time


def records(target: DataFrame) -> DataFrame:
    """The six columns needed, with name key, e-mail and phone digits."""
    name = T.name_key(F.col("firstname"), F.col("lastname"))
    return (
        target.select(
            "hs_id", "ord", "email", "firstname", "lastname", "createdate", "hs_last_activity_date",
            name.alias("name_key"),
            T.trim(F.lower(F.coalesce("email", F.lit("")))).alias("e"),
            T.digits(F.coalesce("phone", F.lit(""))).alias("p"),
        )
        .where(F.col("name_key").isNotNull())
    )


def profiles(recs: DataFrame) -> DataFrame:
    """Distinct (name, e-mail, phone) with the number of records."""
    return (
        recs.groupBy("name_key", "e", "p")
        .agg(F.count(F.lit(1)).alias("members"))
        .select(
            "name_key", "e", "p", "members",
            T.email_local(F.col("e")).alias("l"),
            T.email_domain(F.col("e")).alias("d"),
        )
    )


def name_blocks(target: DataFrame) -> DataFrame:
    """Records per normalised name."""
    return (
        target.select(T.name_key(F.col("firstname"), F.col("lastname")).alias("name_key"))
        .where(F.col("name_key").isNotNull())
        .groupBy("name_key")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _within(a: Column, b: Column, limit: int) -> Column:
    """Edit distance at most ``limit`` (the built-in gives -1 beyond the limit)."""
    return F.levenshtein(a, b, limit) >= 0


def pair_reason(a: str, b: str) -> Column:
    """Ordered rules for two profiles ``a`` and ``b``; null when none applies."""
    e1, e2 = F.col(f"{a}.e"), F.col(f"{b}.e")
    l1, l2 = F.col(f"{a}.l"), F.col(f"{b}.l")
    d1, d2 = F.col(f"{a}.d"), F.col(f"{b}.d")
    p1, p2 = F.col(f"{a}.p"), F.col(f"{b}.p")
    same_phone = (p1 == p2) & (F.length(p1) >= 10)
    no_email = (e1 == "") | (e2 == "")
    return (
        F.when(no_email & same_phone, F.lit("same_phone_one_no_email"))
        .when(no_email | (e1 == e2), F.lit(None).cast("string"))
        .when((l1 == l2) & _within(d1, d2, 2), F.lit("domain_typo"))
        .when((d1 == d2) & _within(l1, l2, 1), F.lit("local_typo"))
        .when(_within(e1, e2, 2), F.lit("email_typo"))
        .when(same_phone, F.lit("same_phone_different_email"))
        .when((l1 == l2) & (F.length(l1) >= 4), F.lit("same_local_different_domain"))
        .when(_within(e1, e2, MAX_EDITS), F.lit("possible_email_typo"))
    )


def pair_class(reason: Column) -> Column:
    return F.when(
        reason.isin("same_local_different_domain", "possible_email_typo"), F.lit(REVIEW)
    ).otherwise(F.lit(AUTO))


def emails(profs: DataFrame) -> DataFrame:
    """Distinct e-mails per name; ``odd`` marks those without exactly one @ sign."""
    at_signs = F.length("e") - F.length(F.replace(F.col("e"), F.lit("@"), F.lit("")))
    return profs.where(F.col("e") != "").groupBy("name_key", "e", "l", "d").agg(F.max(at_signs != 1).alias("odd"))


def _keyed(given: DataFrame, side: str, keys: Column, *more: Column) -> DataFrame:
    """One row per e-mail and key: ``name_key``, the key columns, and the e-mail as a struct named ``side``."""
    own = F.struct("e", "l", "d", F.lit("").alias("p"))
    return given.select("name_key", *more, F.explode(keys).alias("k"), own.alias(side))


def _met(left: DataFrame, right: DataFrame, on: list[str], shorter: Column) -> DataFrame:
    """Pairs of e-mails that share a key and that a rule accepts."""
    both = left.join(right, ["name_key", *on, "k"]).where(shorter & (F.col("a.e") != F.col("b.e")))
    return both.where(pair_reason("a", "b").isNotNull()).select("name_key", F.least("a.e", "b.e").alias("e1"), F.greatest("a.e", "b.e").alias("e2"))


def domain_pairs(given: DataFrame) -> DataFrame:
    """(name_key, d1, d2, edits, moved): different domains of a name that few edits can turn into each other.

    ``edits`` is their distance up to MAX_EDITS, else null.  ``moved``: e-mails may be near only as the @ sign moves to the right.
    Then d2 is within two edits of an end of d1 (removing and setting the @ sign are two of the four).  Keeping the @ sign instead
    costs at most ``3 - c + n + edits``, where the end lacks n characters of d1 and is c edits from d2; four and less are found without.
    """
    each = given.select("name_key", "d").distinct()
    left, right = each.withColumnRenamed("d", "d1"), each.withColumnRenamed("d", "d2")
    distance = F.levenshtein("d1", "d2", MAX_EDITS)
    free = MAX_EDITS - 2

    def only_moved(t: int) -> Column:
        end = F.expr(f"right(d1, length(d2) + {t})")
        c = F.levenshtein(end, F.col("d2"), free)
        whole = F.when(distance >= 0, distance).otherwise(MAX_EDITS + 1)
        return (c >= 0) & (F.length("d1") - F.length(end) + whole - c >= 2)

    return left.join(right, "name_key").where("d1 <> d2").select(
        "name_key", "d1", "d2", F.when(distance >= 0, distance).alias("edits"),
        reduce(lambda x, y: x | y, [only_moved(t) for t in range(-free, free + 1)]).alias("moved"),
    ).where("edits IS NOT NULL OR moved")


#: Columns of ``_text`` that go with each key.
TOLD = ["id", "t", "n", "s", "o"]


def _told(text: str) -> list[Column]:
    """Length, signature and outline of a column."""
    t = F.col(text)
    return [F.length(t).alias(f"n{text}"), segments.signature(t).alias(f"s{text}"), segments.outline(t).alias(f"o{text}")]


def _text(given: DataFrame, text: str, *tag: str, room: Column | None = None, more: Column | None = None) -> DataFrame:
    """What the joins need of an e-mail: its number, one text with length, signature and outline, and a hash that partners have in common.

    ``room`` is the number of edits that the text of a partner may be away, ``more`` a column for ``head_keys``.
    """
    kept = [F.lit(MAX_EDITS).alias("room") if room is None else room.alias("room"), *([] if more is None else [more.alias("expected")])]
    own = [F.col(column).alias(name) for column, name in ((text, "t"), (f"n{text}", "n"), (f"s{text}", "s"), (f"o{text}", "o"))]
    return given.select("id", "l", *own, F.xxhash64("name_key", *tag).alias("tag"), *kept)


def stored_keys(given: DataFrame, limit: int, text: str = "t") -> DataFrame:
    """One row per e-mail of ``_text`` and key that the column ``text`` is found by."""
    placed = given.select("*", F.explode(segments.stored_places(limit)).alias("place"))
    fits, key = segments.stored_key(F.col(text), F.length(text), F.col("place"), limit, F.col("tag"))
    return placed.where(fits).select(*TOLD, "room", key.alias("k"))


def asked_keys(given: DataFrame, limit: int, text: str = "t") -> DataFrame:
    """One row per e-mail of ``_text`` and key that the column ``text`` asks for."""
    placed = given.select("*", F.explode(segments.asked_places(limit)).alias("place"))
    fits, key = segments.asked_key(F.col(text), F.length(text), F.col("place"), limit, F.col("tag"))
    return placed.where(fits).select(*TOLD, key.alias("k"))


def head_keys(given: DataFrame) -> DataFrame:
    """Keys by which local parts are found that are within two edits of a beginning of this one, for pairs whose @ sign moved.

    ``expected`` is the length of such a local part in an e-mail as long as this one.  Of the four edits one is at either @ sign, so
    lengths differ by three at most.
    """
    free = MAX_EDITS - 2
    placed = given.select("*", F.explode(segments.head_places(free, MAX_EDITS - 1)).alias("place"))
    fits, key = segments.head_key(F.col("l"), F.col("expected"), F.col("place"), free, F.col("tag"))
    return placed.where(fits).select(*TOLD, key.alias("k"))


def _near(stored: DataFrame, asked: DataFrame, limit: int, shorter_stored: bool = True) -> DataFrame:
    """(i, j): numbers of different e-mails that share a key and whose texts are within ``room`` edits.

    Strangers meet often where texts are short, so signatures and outlines are compared first.  Where the shorter text is stored, texts of one
    length meet twice, and the second time is left out.
    """
    a = stored.select("k", "room", *[F.col(c).alias(f"a_{c}") for c in TOLD])
    b = asked.select("k", *[F.col(c).alias(f"b_{c}") for c in TOLD])
    more = F.col("b_n") - F.col("a_n")
    both = b.join(a.hint("merge"), "k")  # rows of one key stand side by side there, and nothing gathers on the driver
    if shorter_stored:
        both = both.where((more > 0) | ((more == 0) & (F.col("a_id") < F.col("b_id"))))
    else:
        both = both.where(F.col("a_id") != F.col("b_id"))
    distance = F.levenshtein("a_t", "b_t", limit)
    far = [rule(F.col(f"a_{c}"), F.col("a_n"), F.col(f"b_{c}"), F.col("b_n"), limit) for rule, c in ((segments.unlike, "s"), (segments.misplaced, "o"))]
    near = both.where(~far[0]).where(~far[1]).where((distance >= 0) & (distance <= F.col("room")))
    return near.select(F.least("a_id", "b_id").alias("i"), F.greatest("a_id", "b_id").alias("j"))


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def email_pairs(profs: DataFrame) -> DataFrame:
    """(name_key, e1, e2): e-mails of one name that a rule accepts without a look at phones."""
    every = emails(profs)
    sizes = every.groupBy("name_key").agg((F.count(F.lit(1)) <= SMALL_BLOCK).alias("few"))
    every = stage(every.join(sizes, "name_key"))  # several joins read it
    few, one = every.where("few"), F.struct("e", "l", "d", F.lit("").alias("p"))
    small = few.select("name_key", one.alias("a")).join(few.select("name_key", one.alias("b")), "name_key").where("a.e < b.e")
    direct = small.where(pair_reason("a", "b").isNotNull()).select("name_key", F.col("a.e").alias("e1"), F.col("b.e").alias("e2"))
    large = every.where("NOT few").drop("few")
    return direct if large.isEmpty() else direct.unionByName(_large_block_pairs(large))


def _large_block_pairs(given: DataFrame) -> DataFrame:
    """``email_pairs`` of names with many e-mails, by keys; every join reads ``given``.

    Each join is a job of its own: in one plan Spark would gather the sides it broadcasts on the driver all at once.
    """
    long = given.where(F.length("l") >= LOCAL_CHARS)
    own_local = F.array(F.concat(F.lit("l|"), F.col("l")))
    same_local = stage(_met(_keyed(long, "a", own_local), _keyed(long, "b", own_local), [], F.col("a.e") < F.col("b.e")).distinct())

    texts = [c for t in ("l", "e") for c in _told(t)]
    given = given.repartition(_tasks(given), "e")  # e-mails come in few files, and each makes a hundred keys
    given = stage(given.select(F.monotonically_increasing_id().alias("id"), "name_key", "e", "l", "d", "odd", *texts), wide=True)
    fine = given.where("NOT odd")
    found = []

    def add(stored: DataFrame, asked: DataFrame, limit: int, shorter_stored: bool = True) -> None:
        found.append(stage(_near(stored, asked, limit, shorter_stored).distinct()))

    same = _text(fine, "l", "d")
    add(stored_keys(same, MAX_EDITS), asked_keys(same, MAX_EDITS), MAX_EDITS)

    domains = stage(domain_pairs(fine))
    first, second = fine.withColumnRenamed("d", "d1"), fine.withColumnRenamed("d", "d2")
    near = domains.where("edits IS NOT NULL").select("name_key", "d1", "d2", "edits")
    for row in near.select("edits").distinct().collect():  # at most MAX_EDITS numbers
        rest = MAX_EDITS - row["edits"]  # what the domains leave to the local parts
        pairs, room = near.where(F.col("edits") == row["edits"]).select("name_key", "d1", "d2"), F.lit(rest)
        a, b = (_text(pairs.join(side, ["name_key", d]), "l", "d1", "d2", room=room) for side, d in ((first, "d1"), (second, "d2")))
        add(stored_keys(a, rest), asked_keys(b, rest), rest)
    moved = domains.where("moved").select("name_key", "d1", "d2")
    if not moved.isEmpty():
        a = _text(moved.join(first, ["name_key", "d1"]), "e", "d1", "d2")
        b = _text(moved.join(second, ["name_key", "d2"]), "e", "d1", "d2", more=F.col("ne") - F.length("d1") - 1)
        add(stored_keys(a, MAX_EDITS - 2, "l"), head_keys(b), MAX_EDITS, False)

    odd = given.where("odd").select("name_key").distinct()
    if not odd.isEmpty():  # spares joins where all are well-formed
        front = given.join(odd, "name_key", "left_semi").withColumn("f", F.concat("l", F.lit("@"), "d"))
        beside = stage(front.select("*", *_told("f")), wide=True)
        for left, right in ((beside.where("odd"), beside), (beside, beside.where("odd"))):
            for text, limit in (("e", MAX_EDITS), ("f", SHORT_EDITS)):
                a, b = _text(left, text, room=F.lit(limit)), _text(right, text)
                add(stored_keys(a, limit), asked_keys(b, limit), limit)

    one = F.struct("e", "l", "d", F.lit("").alias("p"))
    a, b = given.select(F.col("id").alias("i"), "name_key", one.alias("a")), given.select(F.col("id").alias("j"), F.col("name_key").alias("other"), one.alias("b"))
    met = reduce(DataFrame.unionByName, found).distinct().join(a, "i").join(b, "j").where("name_key = other")
    named = met.where(pair_reason("a", "b").isNotNull()).select("name_key", F.least("a.e", "b.e").alias("e1"), F.greatest("a.e", "b.e").alias("e2"))
    return stage(same_local.unionByName(named).distinct())


def _sides(pairs: DataFrame, profs: DataFrame, on: dict[str, str]) -> DataFrame:
    """Pairs with the profiles of both ends as ``a`` and ``b``."""
    one = F.struct("e", "p", "l", "d")
    left = profs.select("name_key", F.col(on["a"]).alias("_1"), one.alias("a"))
    right = profs.select("name_key", F.col(on["b"]).alias("_2"), one.alias("b"))
    return pairs.join(left, ["name_key", "_1"]).join(right, ["name_key", "_2"])


def _usable(p: str) -> Column:
    return F.length(p) >= 10


def _with_reason(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "name_key", F.col("a.e").alias("e1"), F.col("a.p").alias("p1"), F.col("b.e").alias("e2"), F.col("b.p").alias("p2"),
        pair_reason("a", "b").alias("reason"),
    )


def mail_pairs(profs: DataFrame) -> DataFrame:
    """The pairs of ``profile_pairs`` without a usable phone in common."""
    near = email_pairs(profs).withColumnsRenamed({"e1": "_1", "e2": "_2"})
    return _with_reason(_sides(near, profs, {"a": "e", "b": "e"}).where(~(_usable("a.p") & (F.col("a.p") == F.col("b.p")))))


def profile_pairs(profs: DataFrame) -> DataFrame:
    """Qualifying pairs of different profiles: ``name_key, e1, p1, e2, p2, reason``."""
    one = F.struct("e", "p", "l", "d")
    phones = profs.where(_usable("p")).select("name_key", "p", one.alias("x"))
    same_phone = phones.withColumnRenamed("x", "a").join(phones.withColumnRenamed("x", "b"), ["name_key", "p"]).where("a.e < b.e").select("name_key", "a", "b")
    return _with_reason(same_phone).unionByName(mail_pairs(profs))


def copy_groups(profs: DataFrame) -> DataFrame:
    """Profiles whose own records pair with each other: no e-mail, usable phone, 2+ records."""
    return profs.where(
        (F.col("e") == "") & (F.length("p") >= 10) & (F.col("members") > 1)
    ).select(
        "name_key",
        F.col("e").alias("e1"), F.col("p").alias("p1"),
        F.col("e").alias("e2"), F.col("p").alias("p2"),
        F.lit("same_phone_one_no_email").alias("reason"),
    )


class Search(NamedTuple):
    """One search, staged, for all results that need it: records, their profiles, qualifying profile pairs and copy groups."""

    recs: DataFrame
    profs: DataFrame
    pairs: DataFrame


def search(target: DataFrame) -> Search:
    recs = stage(records(target))
    profs = stage(profiles(recs))
    return Search(recs, profs, stage(profile_pairs(profs).unionByName(copy_groups(profs))))


def duplicate_profiles(target: DataFrame, found: Search | None = None) -> DataFrame:
    """Compact, lossless result: qualifying profile pairs with member counts.

    A group of n copies stays one row here, whereas record pairs grow with n*n.
    """
    if found is None:
        profs = stage(profiles(records(target)))
        pairs = profile_pairs(profs).unionByName(copy_groups(profs))
    else:
        profs, pairs = found.profs, found.pairs
    m = profs.select("name_key", "e", "p", "members")
    m1 = m.toDF("name_key", "e1", "p1", "members1")
    m2 = m.toDF("name_key", "e2", "p2", "members2")
    same = (F.col("e1") == F.col("e2")) & (F.col("p1") == F.col("p2"))
    n_pairs = F.when(
        same, F.col("members1") * (F.col("members1") - 1) / 2
    ).otherwise(F.col("members1") * F.col("members2"))
    return (
        pairs.join(m1, ["name_key", "e1", "p1"])
        .join(m2, ["name_key", "e2", "p2"])
        .select(
            "name_key", "e1", "p1", "e2", "p2", "reason",
            pair_class(F.col("reason")).alias("classification"),
            "members1", "members2", n_pairs.cast("bigint").alias("n_pairs"),
        )
    )


def _standing(side: str = "") -> list[Column]:
    """What decides which of two records is kept: common domain, has e-mail, last activity; a missing date counts as the epoch."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp")
    e = F.col(f"{side}e")
    return [
        T.email_domain(e).isin(*rules.COMMON_MAIL_DOMAINS).alias("common"), (e != "").alias("mailed"),
        F.coalesce(F.col(f"{side}hs_last_activity_date"), F.col(f"{side}createdate"), epoch).alias("at"),
    ]


def _kept_first(a: list[Column], b: list[Column]) -> Column:
    (d1, h1, t1), (d2, h2, t2) = a, b
    return F.when(d1 != d2, d1).when(h1 != h2, h1).otherwise(t1 >= t2)


def first_survives(a: str, b: str) -> Column:
    """Is record ``a`` (earlier) kept?  Common domain, then has e-mail, then activity.

    A missing date counts as the epoch.  Ties keep the earlier record.
    """
    return _kept_first(_standing(f"{a}."), _standing(f"{b}."))


#: What a record pair shows of its records.
RECORD = ["hs_id", "ord", "e", "email", "firstname", "lastname", "createdate", "hs_last_activity_date"]


def _before(a: str, b: str) -> Column:
    """Is record ``a`` the earlier one?  Equal places do not occur in one input; if they do, copies are no pair."""
    o1, o2 = F.col(f"{a}.ord"), F.col(f"{b}.ord")
    return (o1 < o2) | ((o1 == o2) & (F.col(f"{a}.e") > F.col(f"{b}.e")))


def phone_record_pairs(recs: DataFrame) -> DataFrame:
    """Record pairs with a usable phone in common: ``reason, a, b, keep_a``, copies without an e-mail included.

    Their number grows with the square of the records of one phone, so pairs leave the join as they are made and never move again.
    A large group is cut into slices, and each task gets two slices to compare; what moves is records, some n / PHONE_SLICE times.
    """
    usable = recs.where(_usable("p"))
    sizes = usable.groupBy("name_key", "p").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    slices = F.ceil(F.col("n") / PHONE_SLICE).cast("int")
    at_signs = F.length("e") - F.length(F.replace(F.col("e"), F.lit("@"), F.lit("")))
    own = F.struct("e", "p", T.email_local(F.col("e")).alias("l"), T.email_domain(F.col("e")).alias("d"), "ord", *_standing(), F.struct(*RECORD).alias("r"))
    cut = stage(
        usable.join(sizes, ["name_key", "p"]).select(
            "name_key", "p", slices.alias("slices"), F.pmod(F.xxhash64("ord"), slices).cast("int").alias("slice"),
            own.alias("x"), F.length("e").alias("size"), segments.signature(F.col("e")).alias("sign"), (at_signs <= 1).alias("fine"),
        ), wide=True,
    )
    given = ["name_key", "p", "size", "sign", "fine"]
    left = cut.select(*given, "x", F.col("slice").alias("i"), F.explode(F.sequence("slice", F.col("slices") - 1)).alias("j"))
    right = cut.select("name_key", "p", *[F.col(c).alias(f"{c}_y") for c in given[2:]], F.col("x").alias("y"), F.col("slice").alias("j"), F.explode(F.sequence(F.lit(0), "slice")).alias("i"))
    e1, e2, first = F.col("x.e"), F.col("y.e"), _before("x", "y")
    on = ["name_key", "p", "i", "j"]
    tasks = _tasks(recs)  # given by number, as few records make many pairs
    pairs = left.repartition(tasks, *on).join(right.repartition(tasks, *on), on).where(((F.col("i") < F.col("j")) | first) & ((e1 != e2) | (e1 == "")))
    far = F.col("fine") & F.col("fine_y") & segments.unlike(F.col("sign"), F.col("size"), F.col("sign_y"), F.col("size_y"), SHORT_EDITS)
    x, y = ([F.col(f"{side}.{c}") for c in ("common", "mailed", "at")] for side in "xy")
    return pairs.select(  # all reasons before that of the phone have two edits at most where e-mails are well-formed
        F.when((e1 == "") | (e2 == ""), F.lit("same_phone_one_no_email")).when(far, F.lit("same_phone_different_email")).otherwise(pair_reason("x", "y")).alias("reason"),
        F.when(first, F.col("x.r")).otherwise(F.col("y.r")).alias("a"),
        F.when(first, F.col("y.r")).otherwise(F.col("x.r")).alias("b"),
        F.when(first, _kept_first(x, y)).otherwise(_kept_first(y, x)).alias("keep_a"),
    )


def duplicate_pairs(target: DataFrame, found: Search | None = None) -> DataFrame:
    """Record pairs with survivor choice, reason and classification."""
    if found is None:
        recs = stage(records(target))
        both = _record_pairs(mail_pairs(stage(profiles(recs))), recs).unionByName(phone_record_pairs(recs))
    else:
        both = _record_pairs(found.pairs, found.recs)
    keep_a = F.col("keep_a")
    return both.select(
        F.when(keep_a, F.col("a")).otherwise(F.col("b")).alias("primary"),
        F.when(keep_a, F.col("b")).otherwise(F.col("a")).alias("to_merge"),
        "reason",
        pair_class(F.col("reason")).alias("classification"),
        F.col("a.ord").alias("ord_a"),
        F.col("b.ord").alias("ord_b"),
    )


def _record_pairs(pairs: DataFrame, recs: DataFrame) -> DataFrame:
    """Record pairs ``reason, a, b, keep_a`` of profile pairs, the earlier record first."""
    keyed = recs.select("name_key", "e", "p", F.struct(*RECORD).alias("r"))
    left = keyed.toDF("name_key", "e1", "p1", "x")
    right = keyed.toDF("name_key", "e2", "p2", "y")
    same = (F.col("e1") == F.col("e2")) & (F.col("p1") == F.col("p2"))
    return (
        pairs.join(left, ["name_key", "e1", "p1"])
        .join(right, ["name_key", "e2", "p2"])
        .where(~same | (F.col("x.ord") < F.col("y.ord")))
        .select(
            "reason",
            F.when(F.col("x.ord") < F.col("y.ord"), F.col("x")).otherwise(F.col("y")).alias("a"),
            F.when(F.col("x.ord") < F.col("y.ord"), F.col("y")).otherwise(F.col("x")).alias("b"),
        )
        .withColumn("keep_a", first_survives("a", "b"))
    )


def profile_pair_counts(target: DataFrame) -> DataFrame:
    """Record pairs per classification and reason, from profiles: copies are counted, not listed."""
    return duplicate_profiles(target).groupBy("classification", "reason").agg(F.sum("n_pairs").alias("n"))


def pair_counts(dup: DataFrame) -> DataFrame:
    return dup.groupBy("classification", "reason").agg(F.count(F.lit(1)).alias("n"))


def review_rows(dup: DataFrame) -> DataFrame:
    """Manual-review pairs in the fixed seven report columns."""
    def name(side: str) -> Column:
        return F.concat(
            F.coalesce(F.col(f"{side}.firstname"), F.lit("")),
            F.lit(" "),
            F.coalesce(F.col(f"{side}.lastname"), F.lit("")),
        )

    return dup.where(F.col("classification") == REVIEW).select(
        F.col("primary.hs_id").alias("primary_id"),
        F.coalesce("primary.email", F.lit("")).alias("primary_email"),
        name("primary").alias("primary_name"),
        F.col("to_merge.hs_id").alias("duplicate_id"),
        F.coalesce("to_merge.email", F.lit("")).alias("duplicate_email"),
        name("to_merge").alias("duplicate_name"),
        "reason",
    )
