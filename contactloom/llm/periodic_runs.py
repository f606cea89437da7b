"""Periodic runs of words by block convolution.

A run is a stretch of words with smallest period q and length >= max(``MIN_LENGTH``, ``MIN_EXPONENT`` * q) that no
neighbouring word extends.  For each dyadic block width B the texts are cut into blocks of B words; the sum of squared
differences of every block with every place of the window behind it comes from exact integer transforms, and is zero
where the block occurs again.  A run of period q in [B, 2 B) holds two neighbouring blocks that both occur q words
later, since it is at least 3 q words longer than q.  Such distances seed extensions, which compare the words themselves
and give the run's ends.  Periods are found in rising order, so a seed inside a known run shows a multiple of its period
and is skipped.

Words become small codes with width * code^2 below the transform's prime: equal words have equal codes, and unequal ones
that share a code only cost a comparison.  Texts are independent rows; those of an Arrow batch are transformed together,
and nothing is shuffled.  A text of n words takes O(n log^2 n) time and memory of some 60 n bytes; above ``ntt.MAX_ROW``
words of period, blocks stay that wide and windows further behind are asked too.

Defined cases: a null or empty text has no runs and collapses to an empty text; repeated rows give repeated rows; a null
id is kept; further columns are not read; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.llm import ntt
from contactloom.llm.bpe import blocks
from contactloom.llm.common import map_arrow, texts, words

MIN_LENGTH, MIN_EXPONENT = 6, 4
BLOCK_CHARS = 1_000_000
#: Entries of one transformed slice.
SLICE = 1 << 17
SCHEMA = "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"


def occurrences(rows: np.ndarray, ahead: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, shift): the row occurs ``ahead`` rows and ``shift`` entries later, in the rows laid end to end."""
    width = rows.shape[1]
    step = max(SLICE // (2 * width) - ahead - 1, 1)
    found = []
    for at in range(0, len(rows) - ahead - 1, step):
        part = rows[at : at + step + ahead + 1]
        n = len(part) - ahead - 1
        spectra = ntt.forward(part)
        got = ntt.correlate(spectra[:n], spectra[ahead : ahead + n], spectra[ahead + 1 : ahead + 1 + n])
        squares = part * part
        own = squares.sum(axis=1)
        sums = np.cumsum(squares, axis=1)
        behind = own[ahead : ahead + n, None] + np.concatenate([np.zeros((n, 1)), sums[ahead + 1 : ahead + 1 + n, :-1] - sums[ahead : ahead + n, :-1]], axis=1)
        # sum of squared differences = own + behind - 2 * inner product
        got -= ntt.reduce((own[:n, None] + behind) * width)
        row, shift = np.nonzero(ntt.reduce(got) == 0)
        found.append((row + at, shift))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _same(left: np.ndarray, right: np.ndarray) -> int:
    """Length of the common beginning of two equally long arrays."""
    at, step = 0, 32
    while at < len(left):
        differ = left[at : at + step] != right[at : at + step]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, step * 2
    return len(left)


def _extend(ids: np.ndarray, at: int, distance: int, first: int, last: int) -> tuple[int, int]:
    """Ends of the stretch around ``at`` inside [first, last) whose words ``distance`` apart are the same."""
    right = _same(ids[at : last - distance], ids[at + distance : last])
    if right == 0:
        return at, at
    left = _same(ids[first:at][::-1], ids[first + distance : at + distance][::-1])
    return at - left, at + right + distance


def seeds(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, distance) of blocks that, with the next block, occur again ``distance`` words later."""
    fit = np.flatnonzero(sizes >= max(MIN_LENGTH, MIN_EXPONENT * width))
    if not len(fit):
        return
    last = 1 if width < ntt.MAX_ROW else int(sizes.max()) // (MIN_EXPONENT * width)
    n, own = sizes[fit], starts[fit]
    count = n // width + last
    row = np.cumsum(count) - count
    most = int(np.sqrt((ntt.PRIME - 1) // width))
    flat = np.zeros((int(count.sum()) + 1) * width)
    source = np.arange(int(n.sum())) + np.repeat(own - (np.cumsum(n) - n), n)
    flat[source + np.repeat(row * width - own, n)] = ids[source] * 2654435761 % most + 1
    for ahead in range(1, last + 1):
        block, shift = occurrences(flat.reshape(-1, width), ahead)
        text = np.searchsorted(row, block, side="right") - 1
        whole = (block - row[text] + 1) * width <= n[text]
        block, shift, text = block[whole], shift[whole], text[whole]
        key = block * width + shift
        after = np.minimum(np.searchsorted(key, key + width), max(len(key) - 1, 0))
        twice = key[after] == key + width if len(key) else np.zeros(0, bool)
        yield fit[text[twice]], own[text[twice]] + (block[twice] - row[text[twice]]) * width, ahead * width + shift[twice]


def find_runs(ids: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of all runs in texts of these sizes, laid end to end as word numbers."""
    starts = np.cumsum(sizes) - sizes
    known_end = np.zeros(len(ids) + 1, np.int64)  # the farthest end of a known run over each word
    found, width = [], 1
    while len(sizes) and width <= ntt.MAX_ROW and MIN_EXPONENT * width <= int(sizes.max()):
        fresh = []
        for text, place, distance in seeds(ids, starts, sizes, width):
            new = known_end[place] < place + 2 * width + distance
            text, place, distance = text[new], place[new], distance[new]
            before, done = -1, -1
            for i in np.lexsort((place, distance)).tolist():
                t, p, d = int(text[i]), int(place[i]), int(distance[i])
                if d == before and p + d < done:
                    continue
                first = int(starts[t])
                begin, end = _extend(ids, p, d, first, first + int(sizes[t]))
                if end > begin:
                    before, done = d, end
                if end - begin >= max(MIN_LENGTH, MIN_EXPONENT * d):
                    fresh.append((t, begin, end, d))
        for t, begin, end, d in sorted(fresh, key=lambda f: f[3]):
            part = known_end[begin:end]
            if int(part[0]) >= end and width >= ntt.MAX_ROW:  # a multiple of a period found at this width
                continue
            np.maximum(part, end, out=part)
            found.append((t, begin - int(starts[t]), end - begin, d))
        width *= 2
    return sorted(found, key=lambda f: (f[0], f[1], f[3]))


def _collapse(lists: list[list[bytes]]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    sizes = np.array([len(ws) for ws in lists], np.int64)
    every = [w for ws in lists for w in ws]
    number = {w: i for i, w in enumerate(dict.fromkeys(every))}
    ids = np.fromiter(map(number.__getitem__, every), np.int64, len(every))
    starts = np.cumsum(sizes) - sizes
    step = np.zeros(len(ids) + 1, np.int64)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in lists]
    for t, start, length, period in find_runs(ids, sizes):
        runs[t].append((start, length, period))
        step[starts[t] + start + period] += 1
        step[starts[t] + start + length] -= 1
    keep = np.cumsum(step[:-1]) == 0
    texts_ = [
        b" ".join(compress(ws, keep[a : a + n].tolist()) if r else ws)
        for ws, r, a, n in zip(lists, runs, starts.tolist(), sizes.tolist())
    ]
    return runs, texts_


def collapse(docs: DataFrame) -> DataFrame:
    """doc_id, runs by start and period, and the text without the words a run repeats, joined by blanks."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block in blocks(batch.column(1).cast(pa.binary()), BLOCK_CHARS):
                runs, kept = _collapse([t.split() for t in block])  # bytes split at ASCII white space
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(block)),
                        pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], kind),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "runs", "collapsed"],
                )

    return map_arrow(texts(docs).selectExpr("CAST(doc_id AS BIGINT) doc_id", "text"), run, SCHEMA)


def planted(doc_id: Column, text: Column) -> Column:
    """The text itself, or for every tenth hash of the id its words made periodic from some word on."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    ws = words(text)
    n = F.size(ws)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))).cast("int")
    again = F.array_repeat(F.slice(ws, a + 1, p), F.ceil((n - a) / p).cast("int"))
    turned = F.slice(F.concat(F.slice(ws, F.lit(1), a), F.flatten(again)), F.lit(1), n)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(turned, " ")).otherwise(text)


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run and digests, from the rows of ``collapse``."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    length = -F.col("best.less")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"),
        F.col("best.period").alias("period"), F.floor(1000 * length / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
