"""Packing by lexical retrieval: a sharded BM25 index gives every seed its neighbours.

1. Texts are encoded and an end id is added.  A text's full windows of ``WINDOW`` ids are sequences of their
   own; what is left over, its tail, goes on to packing.  This is staged once.
2. Document frequencies of the token ids over all tails (one row per id, at most the vocabulary) give the
   BM25 weights, and each tail's heaviest id is its topic.
3. Tails are dealt to shards of about ``SHARD_DOCS``, topic by topic in a fixed order; a topic with many tails
   fills many shards, so no group grows with the corpus.
4. In a shard, postings by id answer a seed's query with the unused tails, best first.  They fill the
   seed's window; the one that does not fit is cut, and its rest is the next seed.  Only the last
   sequence of a shard is shorter than the window.

Defined cases: a null text counts as empty and is the end id alone; repeated rows are packed each on its own
(with the doc_id they have); a null id stays null; further columns are not read; an empty table
gives none.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contactloom.llm.bpe import blocks
from contactloom.llm.chunks import cut
from contactloom.llm.common import importable, map_arrow, texts
from contactloom.sources.staging import stage

WINDOW = 2048
END_ID = 1
SHARD_DOCS = 512
K1, B = 1.2, 0.75
#: Tokens a worker keeps of pieces it has met, from task to task; then it forgets them all.  Bounds memory, not results.
KEEP_TOKENS = 2_500_000
BLOCK_CHARS = 2_000_000

PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def byte_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a ``tokenizers`` byte-level BPE file as bytes and ids.

    Byte-level files write each byte as one printable character: printable ones as they are, the others
    as characters from 256 on, in order.
    """
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    letters.update({chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(printable))})
    return {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if all(c in letters for c in t)}


def added_tokens(path: str) -> dict[str, int]:
    """Tokens beside the vocabulary, which a text is split at before anything else."""
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens") or []
    if any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("added tokens that depend on their surroundings are not supported")
    return {t["content"]: t["id"] for t in added}


class _Places(dict):
    """Piece -> place, asking ``add`` for pieces it has not met."""

    def __init__(self, add):
        self.add = add

    def __missing__(self, piece: str) -> int:
        return self.add(piece)


class Tokens:
    """Ids of texts; pieces between blanks are encoded once and kept in one flat array."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        self.added = added_tokens(path)
        # the longest of those that begin at one place; without any, nothing matches
        self.split = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        ranks = {t: i for t, i in byte_ranks(path).items() if t.decode("utf-8", "replace") not in self.added}
        self.keep = KEEP_TOKENS
        self.encode = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.forget()

    def forget(self) -> None:
        self.place = _Places(self._add)
        self.flat = np.zeros(1 << 16, np.uint16)
        self.starts = np.zeros(1 << 14, np.int64)
        self.sizes = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _add(self, piece: str) -> int:
        ids = self.encode(" " + piece)
        i, n = len(self.place), len(ids)
        while self.used + n > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        if i >= len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.sizes = np.concatenate([self.sizes, np.zeros_like(self.sizes)])
        self.flat[self.used : self.used + n] = ids
        self.starts[i], self.sizes[i] = self.used, n
        self.used += n
        self.place[piece] = i
        return i

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text with the end id; added tokens in it are single ids, as the library gives them."""
        parts, at = [], 0
        for found in self.split.finditer(text):
            parts += [self._plain(text[at : found.start()]), np.array([self.added[found.group()]], np.uint16)]
            at = found.end()
        return np.concatenate([*parts, self._plain(text[at:] if at else text), np.array([END_ID], np.uint16)])

    def _plain(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint16)
        first, *rest = cut(text)
        if self.used > self.keep:
            self.forget()
        at = np.fromiter(map(self.place.__getitem__, rest), np.int64, len(rest))
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        spots = np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(total)
        return np.concatenate([np.array(self.encode(first), np.uint16), self.flat[spots]])


_TOKENS: dict[tuple[str, str], Tokens] = {}


def tokens(path: str, pattern: str) -> Tokens:
    """One per worker process and vocabulary."""
    if (path, pattern) not in _TOKENS:
        _TOKENS[path, pattern] = Tokens(path, pattern)
    return _TOKENS[path, pattern]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenised(docs: DataFrame, path: str, pattern: str, keep_tokens: int = KEEP_TOKENS, release: bool = False) -> DataFrame:
    """Rows of ``PIECE`` plus ``ids``: full windows as finished pieces, tails with their ids (2 bytes each).

    ``release`` makes a worker forget its pieces after each task, for jobs whose other stages need the memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task, made = tokens(path, pattern), TaskContext.get().partitionId(), 0
        own.keep = keep_tokens
        for batch in batches:
            names = batch.column(0).to_pylist()
            for start, block in blocks(batch.column(1), BLOCK_CHARS):
                rows = []
                for doc, text in zip(names[start : start + len(block)], block):
                    ids = own.ids(text)
                    n = len(ids)
                    full = n - n % WINDOW
                    for at in range(0, full, WINDOW):
                        rows.append((doc, at, WINDOW, crc(ids[at : at + WINDOW]), n, ((task << 36) + made) * 2, 0, None))
                        made += 1
                    if full < n:
                        rows.append((doc, full, n - full, None, n, None, None, ids[full:].tobytes()))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns[:7]] + [pa.array(columns[7], pa.binary())],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"],
                )
        if release:
            own.forget()

    given = texts(docs).selectExpr("CAST(doc_id AS BIGINT) doc_id", "text")
    return map_arrow(given, run, PIECE + ", ids binary")


def frequencies(tails: DataFrame) -> tuple[np.ndarray, int, float]:
    """(document frequency by id, number of tails, mean tail length); the table is as long as the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, length = np.zeros(1 << 16, np.int64), 0, 0
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                ids = np.frombuffer(raw, np.uint16)
                df[np.unique(ids)] += 1
                n, length = n + 1, length + len(ids)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, [-1, -2])), pa.array(np.append(df[seen], [n, length]))], names=["id", "n"]
        )

    rows = map_arrow(tails.select("ids"), run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = {r["id"]: r["n"] for r in rows}
    df = np.zeros(1 << 16, np.int64)
    for i, n in counts.items():
        if i >= 0:
            df[i] = n
    n = counts.get(-1, 0)
    return df, n, counts.get(-2, 0) / max(n, 1)


def _weights(ids: np.ndarray, idf: np.ndarray, mean: float) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids of a tail and their BM25 weights."""
    terms, tf = np.unique(ids, return_counts=True)
    return terms, idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / mean))


def _topic(ids: np.ndarray, idf: np.ndarray, mean: float) -> int:
    terms, w = _weights(ids, idf, mean)
    return int(terms[np.argmax(w)])


def sharded(tails: DataFrame, idf: np.ndarray, mean: float) -> DataFrame:
    """The tails with ``shard``: topics laid end to end, each as wide as it has tails.

    Tails are staged with their topic, so that it is found once.
    """

    def topics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_topic(np.frombuffer(raw, np.uint16), idf, mean) for raw in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, "topic"])

    schema = "doc_id bigint, start bigint, doc_tokens bigint, ids binary, topic bigint"
    told = stage(map_arrow(tails.select("doc_id", "start", "doc_tokens", "ids"), topics, schema))
    width = told.groupBy("topic").agg(F.count(F.lit(1)).alias("width"))
    # as many rows as the vocabulary at most
    before = Window.orderBy("topic").rowsBetween(Window.unboundedPreceding, -1)
    places = width.select("topic", "width", F.coalesce(F.sum("width").over(before), F.lit(0)).alias("begin"))
    salt = F.pmod(F.xxhash64("doc_id", F.length("ids")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    shard = F.floor((F.col("begin") + salt * F.col("width")) / SHARD_DOCS).alias("shard")
    return told.join(F.broadcast(places), "topic").select("doc_id", "start", "doc_tokens", "ids", shard)


class Index:
    """BM25 postings of one shard: for each id the tails that hold it and their weights."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float):
        parts = [_weights(t, idf, mean) for t in tails]
        self.terms = [p[0] for p in parts]
        ids = np.concatenate(self.terms)
        docs = np.repeat(np.arange(len(tails)), [len(t) for t in self.terms])
        order = np.argsort(ids, kind="stable")
        self.docs, self.weights = docs[order], np.concatenate([p[1] for p in parts])[order]
        self.bounds = np.searchsorted(ids[order], np.arange((1 << 16) + 1))
        self.n = len(tails)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """The unused tails by falling score for the seed's ids, ties by place."""
        terms = self.terms[seed].astype(np.int64)
        lo = self.bounds[terms]
        sizes = self.bounds[terms + 1] - lo
        ends = np.cumsum(sizes)
        spots = np.repeat(lo - (ends - sizes), sizes) + np.arange(int(ends[-1]))
        scores = np.bincount(self.docs[spots], self.weights[spots], self.n)
        left = np.flatnonzero(unused)
        return left[np.argsort(-scores[left], kind="stable")]


def fill(tails: list[np.ndarray], idf: np.ndarray, mean: float) -> list[list[tuple[int, int, int]]]:
    """Sequences of (tail, from, to): every id once, every sequence but the last full."""
    index, unused = Index(tails, idf, mean), np.ones(len(tails), bool)
    sequences: list[list[tuple[int, int, int]]] = []
    rest: tuple[int, int] | None = None
    while rest or unused.any():
        if rest is None:
            rest = (int(np.argmax(unused)), 0)
            unused[rest[0]] = False
        seed, at = rest
        rest = None
        end = min(len(tails[seed]), at + WINDOW)
        window, room = [(seed, at, end)], WINDOW - (end - at)
        if room:
            for other in index.neighbours(seed, unused).tolist():
                unused[other] = False
                take = min(room, len(tails[other]))
                window.append((other, 0, take))
                room -= take
                if take < len(tails[other]):
                    rest = (other, take)
                if not room:
                    break
        sequences.append(window)
    return sequences


def pack(docs: DataFrame, path: str, pattern: str, keep_tokens: int = KEEP_TOKENS, release: bool = False) -> DataFrame:
    """Pieces of all texts: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    staged = stage(tokenised(docs, path, pattern, keep_tokens, release))
    tails = staged.where("ids IS NOT NULL")
    df, n, mean = frequencies(tails)
    idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
    mean = max(mean, 1.0)
    dealt = sharded(tails, idf, mean)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("doc_tokens", "ascending"), ("ids", "ascending")])
        doc, start, total = (table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens"))
        shard = table.column("shard")[0].as_py()
        own = [np.frombuffer(raw, np.uint16) for raw in table.column("ids").to_pylist()]
        rows = []
        for k, window in enumerate(fill(own, idf, mean)):
            offset = 0
            for t, a, b in window:
                rows.append((doc[t], start[t] + a, b - a, crc(own[t][a:b]), total[t], ((shard << 24) + k) * 2 + 1, offset))
                offset += b - a
        columns = list(zip(*rows))
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)

    importable(docs)
    packed = dealt.groupBy("shard").applyInArrow(run, PIECE)
    return staged.where("ids IS NULL").drop("ids").unionByName(packed)


