"""Jaccard join of n-gram sets with prefix trees.

A text's set is its distinct word n-grams as 63-bit numbers.  Equal sets are one node.  The query uses ``GRAM`` words and
``SHARE`` percent; both are arguments.

1. One pass counts n-grams in ``BUCKETS`` buckets and names every text's node.  The counts give the global order: an
   n-gram's number starts with the level of its bucket, so rare ones come first.  Any order gives the same links.
2. Two sets that link have a common n-gram among the first ``size - ceil(share) + 1`` of both.  Only these n-grams are
   posted, and those posted by one node only are dropped.
3. A posting holds the size and a parity sketch of its set.  Every n-gram by which two sets differ flips one bit, so
   pairs with more unlike bits than linked sets can have are out.  So are pairs of unlike sizes, and those with fewer
   common first n-grams than links have: some 5 percent of the size at 90, 9 at 80.  Postings without any partner that
   sizes and sketches allow are dropped before anything is paired.
   Pairs of long sets are then compared by wide sketches, one per node, before any set travels.
4. Surviving pairs go to the smallest n-gram they share, and only there their sets travel.  The sets below an n-gram stand
   in a tree of shared beginnings; a probe walks it, adds up the overlap once for all sets below, and leaves a branch when
   the remaining lengths cannot reach the threshold.  Links found are exact.
5. In the first round every node meets the smallest node of its posting only, so a group of near copies costs a line.
   Then the nodes of every posting that is still not connected meet ``PIVOTS`` drawn nodes of it.  Where more than ``STAR_GAIN`` pairs a node are left unconnected, every node tests the smallest partner in up to
   ``STAR_ROUNDS`` further rounds; then all pairs that are still not connected are tested.  Later links only join roots.
   Such a pair is met at its smallest common n-gram and not again while one of the last ``BEFORE`` n-grams of both is the same;
   a second sketch, of the n-grams a node still posts, drops pairs that have too few of them in common.
6. Components are those of verified links; all copies of a set follow their node.

Defined cases: a null text, or one without a word, has an empty set and links with nothing; with fewer words than an n-gram has the whole
sequence is the only n-gram; rows repeated with one id are one document each with the same component; a null
id takes part and can only be the component's id if no other is there; further columns are not read by ``classes``
and kept by ``deduplicate``; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contactloom.llm.common import free_name, map_arrow
from contactloom.llm.components import components
from contactloom.llm.exact_dedup import filter_bits
from contactloom.sources.staging import stage

#: Links of op9: SHARE_OF * intersection >= SHARE * union, over n-grams of so many words.
SHARE, SHARE_OF = 90, 100
GRAM = 3
#: Sets of one side that stand in one tree.
BLOCK = 512
#: Counters of n-grams, whatever the corpus: the driver holds their levels, one byte each.
BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
#: Bits of a parity sketch, kept as longs.
SKETCH_LONGS = 4
#: Longs of the wide sketch of a set from so many n-grams on; shorter ones have none.
WIDE_LONGS = [(6000, 256), (400, 32)]
#: A posting's preceding n-grams of its node that tell whether two nodes have met already.
BEFORE = 4
#: Nodes drawn from every posting, which the others meet before all pairs do.
PIVOTS = 8
#: Rounds in which every node is tested against the smallest partner it has left, before all pairs left are tested.
STAR_ROUNDS = 3
#: Pairs left a node from which on such a round is worth its jobs.
STAR_GAIN = 4
#: Words whose hashes a task keeps.
KEEP_WORDS = 500_000


class WordHashes(dict):
    """Hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEEP_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def gram_hashes(text: bytes | None, gram: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the text's n-grams; bytes are lower-cased and split at ASCII white space only."""
    ws = (text or b"").lower().split()
    if not ws:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(known.__getitem__, ws), np.uint64, len(ws))
    width = min(gram, len(ws))
    many = one[: len(one) - width + 1].copy()
    for k in range(1, width):
        many = many * np.uint64(0x9E3779B97F4A7C15) + one[k : len(one) - width + 1 + k]
    many = (many ^ (many >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return np.unique(many ^ (many >> np.uint64(29)))


def node_of(hashes: np.ndarray) -> int:
    """The name of a set."""
    return xxhash.xxh3_64_intdigest(hashes.tobytes()) - (1 << 63)


def ordered(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The n-grams' numbers in the global order: six bits of level, 57 bits of hash."""
    level = levels[(hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.uint64)
    return np.sort(((level << np.uint64(57)) | (hashes >> np.uint64(7))).astype(np.int64))


def prefix_length(size: int, share: int) -> int:
    """How many first n-grams of a set hold one of every set that links with it."""
    return size - -(-size * share // SHARE_OF) + 1


def parity_sketch(grams: np.ndarray) -> np.ndarray:
    """Longs whose bits say whether an odd number of n-grams fell on them."""
    bits = np.bincount(grams & (64 * SKETCH_LONGS - 1), minlength=64 * SKETCH_LONGS) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def wide_sketch(hashes: np.ndarray) -> list[int] | None:
    """A parity sketch that is long enough for long sets."""
    longs = next((w for least, w in WIDE_LONGS if len(hashes) >= least), None)
    if longs is None:
        return None
    bits = np.bincount((hashes & np.uint64(64 * longs - 1)).astype(np.int64), minlength=64 * longs) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64).tolist()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.col("text").cast("binary").alias("text"))


def profile(docs: DataFrame, gram: int = GRAM) -> tuple[DataFrame, np.ndarray]:
    """((doc_id, row, n_shingles, node, wide), levels): the texts' nodes (null if empty) and wide sketches, the levels of the order's buckets."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = WordHashes(), np.zeros(BUCKETS, np.int64)
        schema = None
        for batch in batches:
            sets = [gram_hashes(t, gram, known) for t in batch.column(2).to_pylist()]
            sizes, nodes = [len(h) for h in sets], [node_of(h) if len(h) else None for h in sets]
            flat = np.concatenate(sets or [np.empty(0, np.uint64)])
            counts += np.bincount((flat >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), minlength=BUCKETS)
            none, wide = pa.nulls(len(sizes), pa.int64()), pa.array([wide_sketch(h) for h in sets], pa.list_(pa.int64()))
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), wide, none, none],
                names=["doc_id", "row", "n_shingles", "node", "wide", "bucket", "n"],
            )
            schema = out.schema
            yield out
        if schema is not None:
            used = np.flatnonzero(counts)
            blank = [pa.nulls(len(used), f.type) for f in list(schema)[:5]]
            yield pa.RecordBatch.from_arrays([*blank, pa.array(used), pa.array(counts[used])], schema=schema)

    told = stage(
        map_arrow(_keyed(docs), run, f"doc_id {id_type}, row bigint, n_shingles bigint, node bigint, wide array<bigint>, bucket bigint, n bigint")
    )
    counted = told.where("bucket IS NOT NULL").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    levels = np.zeros(BUCKETS, np.uint8)
    levels[counted.column("bucket").to_numpy()] = np.minimum(63, 2 * np.log2(counted.column("n").to_numpy()))
    return told.where("bucket IS NULL").select("doc_id", "row", "n_shingles", "node", "wide"), levels


def postings(docs: DataFrame, levels: np.ndarray, gram: int, share: int) -> DataFrame:
    """(gram, node, size, parity sketch) of the first n-grams of every set."""
    names = ["gram", "node", "size", *(f"p{k}" for k in range(SKETCH_LONGS))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            firsts, facts = [], []
            for t in batch.column(2).to_pylist():
                h = gram_hashes(t, gram, known)
                if len(h):
                    grams = ordered(h, levels)
                    firsts.append(grams[: prefix_length(len(grams), share)])
                    facts.append((node_of(h), len(grams), *parity_sketch(grams).tolist()))
            if firsts:
                many = np.repeat(np.array(facts, np.int64), [len(f) for f in firsts], axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(firsts)), *(pa.array(many[:, k].copy()) for k in range(many.shape[1]))], names=names)

    return map_arrow(_keyed(docs), run, ", ".join(f"{n} bigint" for n in names))


def shared_postings(docs: DataFrame, levels: np.ndarray, gram: int, share: int) -> DataFrame:
    """Postings, one per n-gram and node, that have another node with which theirs may link."""
    all_ = stage(postings(docs, levels, gram, share))
    shared = stage(all_.groupBy("gram").agg(F.min("node").alias("_lo"), F.max("node").alias("_hi")).where("_lo <> _hi").select("gram"))
    near = maybe_member(all_, shared, "gram", filter_bits(shared.count()), "_near").where("_near").drop("_near")
    rest = [c for c in near.columns if c not in ("gram", "node")]
    once = near.groupBy("gram", "node").agg(*[F.min(c).alias(c) for c in rest])
    partner = (F.col("x.gram") == F.col("y.gram")) & (F.col("x.node") != F.col("y.node")) & _may_link(share)
    return stage(once.alias("x").join(once.alias("y"), partner, "left_semi"))


def _unlike(sketch: str):
    """How many bits of a sketch differ between postings ``x`` and ``y``."""
    return sum((F.bit_count(F.col(f"x.{sketch}{k}").bitwiseXOR(F.col(f"y.{sketch}{k}"))) for k in range(SKETCH_LONGS)), F.lit(0))


def _may_link(share: int):
    """Condition on postings ``x`` and ``y`` of one n-gram that all links fulfil: like sizes and sketches.

    Sets that link differ in size(x) + size(y) - 2 * overlap n-grams, with overlap >= share / (share + SHARE_OF) * (size(x) + size(y)).
    """
    x, y = F.col("x.size"), F.col("y.size")
    return (SHARE_OF * F.least(x, y) >= share * F.greatest(x, y)) & ((share + SHARE_OF) * _unlike("p") <= (SHARE_OF - share) * (x + y))


def least_common(small: int, large: int, share: int) -> int:
    """How many n-grams the first ones of two linked sets of these sizes have in common at least."""
    return -(-share * (small + large) // (share + SHARE_OF)) - -(-share * large // SHARE_OF) + 1


def _least(share: int):
    """``least_common`` of postings ``x`` and ``y``.

    Of the two sets' first n-grams, take those that end earlier in the order: all of them that the other set holds are among
    its first ones too, and a set lacks at most size - overlap of the other's.
    """
    up = lambda top, by: F.expr(f"({top} + {by - 1}) div {by}")
    return up(f"{share} * (x.size + y.size)", share + SHARE_OF) - up(f"{share} * greatest(x.size, y.size)", SHARE_OF) + 1


def _pairs(met: DataFrame, share: int) -> DataFrame:
    """(gram, a, b): pairs with enough common first n-grams, each at the smallest n-gram where it came up."""
    told = met.select("gram", F.col("x.node").alias("a"), F.col("y.node").alias("b"), _least(share).alias("_least"))
    common = told.groupBy("a", "b").agg(F.min("gram").alias("gram"), F.count(F.lit(1)).alias("_n"), F.min("_least").alias("_least"))
    return common.where("_n >= _least").select("gram", "a", "b")


def first_pairs(posted: DataFrame, share: int) -> DataFrame:
    """Nodes with the smallest node of their postings, where they may link."""
    facts = [c for c in posted.columns if c not in ("gram", "node")]
    posted = posted.repartition("gram")
    least = posted.groupBy("gram").agg(F.min(F.struct("node", *facts)).alias("_y")).select("gram", "_y.*")
    return _pairs(least.alias("x").join(posted.alias("y"), "gram").where((F.col("x.node") < F.col("y.node")) & _may_link(share)), share)


def open_postings(posted: DataFrame, found: DataFrame) -> DataFrame:
    """Postings, with their roots, of n-grams that ``found`` (node, root) does not connect."""
    named = posted.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = named.groupBy("gram").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).where("_lo <> _hi").select("gram")
    return stage(named.join(mixed, "gram", "left_semi"))


def pivot_pairs(open_: DataFrame, share: int) -> DataFrame:
    """Nodes with up to ``PIVOTS`` drawn nodes of their postings, where they may link and are not connected."""
    open_ = open_.repartition("gram")
    facts = F.struct(*[c for c in open_.columns if c != "gram"])
    drawn = [F.min_by(facts, F.struct(F.xxhash64("node", F.lit(k)), "node")) for k in range(PIVOTS)]
    pivots = open_.groupBy("gram").agg(F.array_distinct(F.array(*drawn)).alias("_p")).select("gram", F.inline("_p"))
    met = pivots.alias("x").join(open_.alias("y"), "gram").where((F.col("x.root") != F.col("y.root")) & _may_link(share))
    return _pairs(met, share)


def preceded(open_: DataFrame) -> DataFrame:
    """Postings with what their node still posts: how many n-grams, their parity sketch, and the last ``BEFORE`` before this one."""
    node = Window.partitionBy("node")
    flip = "CASE WHEN (shiftright(gram, 6) & {}) = {} THEN shiftleft(1L, CAST(gram & 63 AS INT)) ELSE 0L END"
    sketch = [F.bit_xor(F.expr(flip.format(SKETCH_LONGS - 1, k))).over(node).alias(f"q{k}") for k in range(SKETCH_LONGS)]
    before = F.collect_list("gram").over(node.orderBy("gram").rowsBetween(-BEFORE, -1)).alias("before")
    return open_.select("*", F.count(F.lit(1)).over(node).alias("n"), *sketch, before)


def met_pairs(open_: DataFrame, share: int) -> DataFrame:
    """Postings ``x`` and ``y`` of pairs that may link and are not connected, at their smallest common n-gram and few further ones.

    Nodes that are not connected find all their common n-grams in ``open_``.  There, the n-grams in which they differ are
    n(x) + n(y) - 2 * common ones, which is at least the number of unlike bits; and where both have a common n-gram
    before this one, they met at the first such n-gram.
    """
    own, least = preceded(open_), _least(share)
    apart = (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root"))
    enough = (F.least("x.n", "y.n") >= least) & (_unlike("q") <= F.col("x.n") + F.col("y.n") - 2 * least)
    first = ~F.arrays_overlap("x.before", "y.before")
    return own.alias("x").join(own.alias("y"), "gram").where(apart & _may_link(share) & enough & first)


def other_pairs(open_: DataFrame, share: int) -> DataFrame:
    """(gram, a, b): pairs that may link and are not connected, each at its smallest common n-gram."""
    told = met_pairs(open_, share).select("gram", F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    return told.groupBy("a", "b").agg(F.min("gram").alias("gram")).select("gram", "a", "b")


def wide_pairs(pairs: DataFrame, own: DataFrame, share: int) -> DataFrame:
    """``pairs`` (gram, a, b) without those whose wide sketches differ in more bits than linked sets do.

    Sketches that are missing or of another length tell nothing.  ``own`` is (node, size, wide).
    """
    long_ = own.where("wide IS NOT NULL")
    for side in ("a", "b"):
        pairs = pairs.join(long_.select(F.col("node").alias(side), F.col("size").alias(f"_n{side}"), F.col("wide").alias(f"_w{side}")), side, "left")
    unlike = F.aggregate(F.zip_with("_wa", "_wb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, k: n + k)
    far = (F.size("_wa") == F.size("_wb")) & ((share + SHARE_OF) * unlike > (SHARE_OF - share) * (F.col("_na") + F.col("_nb")))
    return pairs.where(~F.coalesce(far, F.lit(False))).select("gram", "a", "b")


def maybe_member(df: DataFrame, members: DataFrame, key: str, bits: int, flag: str) -> DataFrame:
    """``df`` with a boolean ``flag``: false is certain, true means that ``key`` may be among ``members``.

    What is broadcast is a bitmap of bits / 8 bytes.
    """

    def slot(seed: int):
        return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(bits).cast("long")) + 1

    hit = F.lit(True)
    for i in range(2):
        bucket, bitmap = f"_bucket{i}", f"_bitmap{i}"
        maps = members.select(slot(i).alias("_s")).groupBy(F.bitmap_bucket_number("_s").alias(bucket)).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("_s")).alias(bitmap)
        )
        place = F.bitmap_bit_position(slot(i))
        byte = F.conv(F.hex(F.substring(F.col(bitmap), (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        df = df.join(F.broadcast(maps), F.bitmap_bucket_number(slot(i)) == F.col(bucket), "left")
        hit = hit & F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    return df.withColumn(flag, hit).drop(*[f"_{n}{i}" for i in range(2) for n in ("bucket", "bitmap")])


class Tree:
    """Sorted sets with shared beginnings stored once.

    ``edges[k]`` is (n-grams, children or None, member or None, smallest and largest set size below).
    """

    def __init__(self, sets: list[np.ndarray], share: int = SHARE):
        self.sets = sets
        self.share = share
        sign = np.uint64(1 << 63)
        raw = [(s.view(np.uint64) ^ sign).astype(">u8").tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=raw.__getitem__)
        self.roots = self._split(0, len(self.order), 0)

    def _split(self, lo: int, hi: int, depth: int) -> list[tuple]:
        out, stack = [], [(lo, hi, depth, None)]
        while stack:
            lo, hi, depth, into = stack.pop()
            into = out if into is None else into
            at = lo
            while at < hi:
                first = self.sets[self.order[at]]
                if len(first) <= depth:  # ends here
                    into.append((first[:0], None, self.order[at], len(first), len(first)))
                    at += 1
                    continue
                end = at + 1
                while end < hi and self.sets[self.order[end]][depth] == first[depth]:
                    end += 1
                if end - at == 1:
                    into.append((first[depth:], None, self.order[at], len(first), len(first)))
                else:
                    last = self.sets[self.order[end - 1]]
                    n = min(len(first), len(last))
                    unlike = np.flatnonzero(first[depth:n] != last[depth:n])
                    stop = depth + (int(unlike[0]) if len(unlike) else n - depth)
                    sizes = [len(self.sets[self.order[k]]) for k in range(at, end)]
                    children: list[tuple] = []
                    into.append((first[depth:stop], children, None, min(sizes), max(sizes)))
                    stack.append((at, end, stop, children))
                at = end
        return out

    def linked(self, probe: np.ndarray, skip) -> Iterator[int]:
        """Members whose set links with ``probe``; ``skip(member)`` says which need no answer."""
        size = len(probe)
        share = self.share
        both = share + SHARE_OF
        stack = [(e, 0, 0) for e in self.roots]
        while stack:
            (grams, children, member, small, large), depth, overlap = stack.pop()
            if SHARE_OF * large < share * size or SHARE_OF * size < share * small:
                continue
            if member is not None and skip(member):
                continue
            passed = 0
            if len(grams):
                spots = np.searchsorted(probe, grams)
                overlap += int((probe[np.minimum(spots, size - 1)] == grams).sum())
                depth += len(grams)
                passed = int(np.searchsorted(probe, grams[-1], side="right"))
                # n-grams of the tree path that the probe lacks, and of the probe that the path has passed over
                if SHARE_OF * large < share * size + both * (depth - overlap):
                    continue
                if SHARE_OF * size < share * small + both * (passed - overlap):
                    continue
            if member is not None:
                if SHARE_OF * overlap >= share * (size + len(self.sets[member]) - overlap):
                    yield member
            else:
                stack.extend((c, depth, overlap) for c in children)


def link_block(nodes: list[int], sides: list[int], sets: list[np.ndarray], share: int = SHARE) -> list[tuple[int, int]]:
    """Links that connect the nodes of a piece; side 0 is the tree, side 1 probes, a node may be on both."""
    parent = list(range(len(nodes)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    inner = [i for i, s in enumerate(sides) if s == 0]
    if not inner:
        return []
    tree, out = Tree([sets[i] for i in inner], share), []
    for i, s in enumerate(sides):
        if s == 0:
            continue
        for member in tree.linked(sets[i], lambda m, i=i: find(inner[m]) == find(i)):
            j = inner[member]
            a, b = find(i), find(j)
            if a != b:
                parent[a] = b
                out.append((nodes[i], nodes[j]))
    return out


def whole_sets(docs: DataFrame, levels: np.ndarray, gram: int, wanted: DataFrame) -> DataFrame:
    """(node, toks) for the rows whose hashes are in ``wanted`` (row); the other texts only meet a bitmap."""
    near = maybe_member(_keyed(docs), wanted, "row", filter_bits(wanted.count()), "_near").where("_near").drop("_near")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            rows, nodes, sets = [], [], []
            for row, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                h = gram_hashes(t, gram, known)
                if len(h):
                    rows.append(row)
                    nodes.append(node_of(h))
                    sets.append(ordered(h, levels).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], names=["row", "node", "toks"]
            )

    return map_arrow(near, run, "row bigint, node bigint, toks binary").join(wanted, "row", "left_semi").select("node", "toks")


def links(docs: DataFrame, own: DataFrame, pairs: DataFrame, levels: np.ndarray, gram: int, share: int) -> DataFrame:
    """(a, b): exact links among the pairs (gram, a, b), enough to connect what links; ``own`` is (node, row)."""
    pairs = stage(pairs)

    # pairs of an n-gram are dealt by both of their nodes, so no tree holds more than its share of a hot n-gram
    count = lambda c: F.ceil(F.approx_count_distinct(c) / BLOCK).cast("long").alias(f"_n{c}")
    block = lambda c: F.pmod(F.xxhash64(c, F.lit(17)), F.greatest(f"_n{c}", F.lit(1)))
    cut = pairs.join(pairs.groupBy("gram").agg(count("a"), count("b")), "gram")
    cut = stage(cut.select("gram", block("a").alias("i"), block("b").alias("j"), "a", "b"))
    work = cut.select("gram", "i", "j", F.col("a").alias("node"), F.lit(0).alias("side")).unionByName(
        cut.select("gram", "i", "j", F.col("b").alias("node"), F.lit(1).alias("side"))
    ).distinct()
    wanted = stage(own.join(work.select("node").distinct(), "node", "left_semi").select("row"))
    held = work.join(whole_sets(docs, levels, gram, wanted).groupBy("node").agg(F.first("toks").alias("toks")), "node")
    keyed = held.select("gram", "i", "j", "side", "node", "toks").repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j", "side", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, nodes, sides, sets, out = None, [], [], [], []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in range(3)))
            for k, side, node, toks in zip(keys, batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                if k != key:
                    out += link_block(nodes, sides, sets, share)
                    key, nodes, sides, sets = k, [], [], []
                nodes.append(node)
                sides.append(side)
                sets.append(np.frombuffer(toks, np.int64))
        out += link_block(nodes, sides, sets, share)
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], names=["a", "b"])

    return stage(map_arrow(keyed, run, "a bigint, b bigint"))


def joined_roots(roots: DataFrame, found: DataFrame) -> DataFrame:
    """``roots`` (node, root) after further links (a, b): only the roots that these touch are gone through again."""
    for side in ("a", "b"):
        known = roots.select(F.col("node").alias(side), F.col("root").alias("_root"))
        found = found.join(known, side, "left").withColumn(side, F.coalesce("_root", side)).drop("_root")
    moved = components(found.select("a", "b"))
    ends = moved.select(F.col("node").alias("root"), F.col("root").alias("_end"))
    old = roots.join(ends, "root", "left").select("node", F.coalesce("_end", "root").alias("root"))
    return stage(old.unionByName(moved.join(roots, "node", "left_anti")))


def node_roots(docs: DataFrame, sets: DataFrame, levels: np.ndarray, gram: int, share: int) -> DataFrame:
    """(node, root) of nodes that link with another."""
    # nodes have their size and wide sketch from any of their copies
    first = [F.first("n_shingles").alias("size"), F.first("wide").alias("wide")]
    own = stage(sets.where("node IS NOT NULL").groupBy("node").agg(F.min("row").alias("row"), *first))
    near = lambda pairs: wide_pairs(pairs, own, share)
    posted = shared_postings(docs, levels, gram, share)
    roots = components(links(docs, own, near(first_pairs(posted, share)), levels, gram, share))
    open_ = open_postings(posted, roots)
    roots = joined_roots(roots, links(docs, own, near(pivot_pairs(open_, share)), levels, gram, share))
    left = stage(near(other_pairs(open_postings(posted, roots), share)))
    for turn in range(STAR_ROUNDS + 1):
        n, nodes = left.agg(F.count(F.lit(1)), F.approx_count_distinct("b")).first()
        if not n:
            break
        if turn == STAR_ROUNDS or n <= STAR_GAIN * nodes:
            return joined_roots(roots, links(docs, own, left, levels, gram, share))
        star = stage(left.groupBy("b").agg(F.min(F.struct("a", "gram")).alias("_s")).select("_s.gram", "_s.a", "b"))
        roots = joined_roots(roots, links(docs, own, star, levels, gram, share))
        named = left.join(star.select("a", "b"), ["a", "b"], "left_anti")
        for side in ("a", "b"):
            named = named.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"_{side}")), side, "left")
        left = stage(named.where("NOT coalesce(_a, a) <=> coalesce(_b, b)").select("gram", "a", "b"))
    return roots


def _ids(sets: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, component_id): the smallest id among the rows of a node's component."""
    own = sets.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("_least"))
    named = own.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("_least").alias("component_id"))
    return named.join(least, "root").select("node", "component_id")


def classes(docs: DataFrame, gram: int = GRAM, share: int = SHARE) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    sets, levels = profile(docs, gram)
    rows = sets.select("doc_id", "n_shingles", "node")
    ids = _ids(sets, node_roots(docs, sets, levels, gram, share))
    return (
        rows.where("node IS NOT NULL").join(ids, "node").select("doc_id", "n_shingles", "component_id")
        .unionByName(rows.where("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    )


def deduplicate(docs: DataFrame, gram: int = GRAM, share: int = SHARE) -> DataFrame:
    """The row with the smallest id of every component, with all its columns.

    Sets of n-grams of ``gram`` words link from ``share`` percent on.

    Of rows with equal ids the one with the smaller hash stays, of equal rows one.  Rows that are neither
    dropped nor repeated pass without a shuffle: a broadcast bitmap tells them apart.
    """
    row, flag, whole = (free_name(docs, n) for n in ("_row", "_flag", "_whole"))
    sets, levels = profile(docs, gram)
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    rows = sets.where("node IS NOT NULL").groupBy("node", "doc_id", "row").agg(F.count(F.lit(1)).alias("n"))
    named = rows.join(_ids(sets, node_roots(docs, sets, levels, gram, share)), "node")
    best = named.groupBy("component_id").agg(F.min(rank).alias("best"))
    told = named.alias("r").join(
        best.alias("b"), F.col("r.component_id").eqNullSafe(F.col("b.component_id"))
    )
    special = stage(
        told.select(F.col("r.row").alias(row), (F.col("r.row") != F.col("b.best.row")).alias("_gone"), F.col("r.n").alias("_n"))
        .where("_gone OR _n > 1").groupBy(row).agg(F.min("_gone").alias("_gone"))
    )
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    tested = maybe_member(keyed, special.select(row), row, filter_bits(special.count()), flag)
    known = tested.where(flag).join(special, row, "left").where("_gone IS NULL OR NOT _gone")
    once = known.where("NOT _gone").groupBy(row).agg(F.first(F.struct(*docs.columns)).alias(whole)).select(f"{whole}.*")
    return (
        tested.where(~F.col(flag)).select(*docs.columns)
        .unionByName(known.where("_gone IS NULL").select(*docs.columns))
        .unionByName(once)
    )
