"""Byte-level BPE encoding and decoding with recursive DuckDB queries, one engine per task.

Spark deals the texts; inside a task every distinct pretoken becomes token-position rows in DuckDB.  A
recursive query joins neighbouring rows with the merge table, contracts the leftmost pair of minimum rank of
each word, and goes on until no pair of a word is in the table; such words leave the recursion.  An
ordered aggregation gives the ids of a word, and joined with the vocabulary its bytes.  Words already met by
the worker process are kept (``KEEP_WORDS``, then forgotten together: memory is bounded, results do not
depend on it).

A pretoken of more than ``LONG`` bytes takes a second query with the same rule that contracts, in one step,
all non-overlapping places of the minimum rank from left to right, if the merged token can't take part in
a pair of the same or a lower rank; that is what one contraction after another would do.

Defined cases: a null text counts as empty: no tokens, digests of nothing; repeated rows are encoded each on
its own; further columns are not read; an empty table gives none.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from contactloom.llm.chunks import cut
from contactloom.llm.common import map_arrow, texts

KEEP_WORDS = 600_000
BATCH_WORDS = 20_000
#: Bytes of text that are cut before the new words among them are encoded.
BLOCK_CHARS = 4_000_000
LONG = 256

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

#: Token-position rows: word, position, token, and position and token of the right neighbour.
STATE = """
SELECT w, p, tok, lead(p) OVER v AS np, lead(tok) OVER v AS nt, true AS active
FROM (SELECT b.w, b.p, y.tok FROM letters b JOIN byte_tokens y ON y.b = b.b)
WINDOW v AS (PARTITION BY w ORDER BY p)
"""

CONTRACT = f"""
WITH RECURSIVE s(w, p, tok, np, nt, active) AS (
  {STATE}
  UNION ALL
  SELECT w, p, tok, np, nt, active FROM (
    WITH best AS (
      SELECT w, min(k) AS k, arg_min(np, k) AS bn FROM (
        SELECT a.w, a.np, (m.rank::BIGINT << 32) | a.p AS k
        FROM s a JOIN merges m ON m.l = a.tok AND m.r = a.nt WHERE a.active) GROUP BY w),
    hit AS (
      SELECT h.w, (h.k & 4294967295) AS bp, (h.k >> 32)::INT AS r, h.bn, b.np AS bnp, b.nt AS bnt
      FROM best h JOIN s b ON b.active AND b.w = h.w AND b.p = h.bn)
    SELECT a.w, a.p,
      CASE WHEN a.p = h.bp THEN h.r ELSE a.tok END AS tok,
      CASE WHEN a.p = h.bp THEN h.bnp ELSE a.np END AS np,
      CASE WHEN a.p = h.bp THEN h.bnt WHEN a.np = h.bp THEN h.r ELSE a.nt END AS nt,
      h.w IS NOT NULL AS active
    FROM s a LEFT JOIN hit h ON a.w = h.w
    WHERE a.active AND (h.w IS NULL OR a.p <> h.bn))
)
"""

CONTRACT_LONG = f"""
WITH RECURSIVE s(w, p, tok, active) AS (
  SELECT w, p, tok, active FROM ({STATE})
  UNION ALL
  SELECT w, p, tok, active FROM (
    WITH nx AS (
      SELECT w, p, tok, lead(tok) OVER v AS nt, lead(p) OVER v AS np, row_number() OVER v AS i
      FROM s WHERE active WINDOW v AS (PARTITION BY w ORDER BY p)),
    pairs AS (SELECT nx.w, nx.p, nx.np, nx.i, m.rank FROM nx JOIN merges m ON m.l = nx.tok AND m.r = nx.nt),
    best AS (SELECT w, min(rank) AS rank FROM pairs GROUP BY w),
    met AS (
      SELECT q.*, q.i - row_number() OVER (PARTITION BY q.w ORDER BY q.i) AS island
      FROM pairs q JOIN best USING (w, rank)),
    pick AS (
      SELECT w, p, np, rank FROM (
        SELECT met.*, row_number() OVER (PARTITION BY w, island ORDER BY i) AS j, min(i) OVER (PARTITION BY w) AS first_i
        FROM met) LEFT JOIN unsafe u ON u.tok = rank
      WHERE i = first_i OR (u.tok IS NULL AND j % 2 = 1))
    SELECT nx.w, nx.p, coalesce(k.rank, nx.tok)::INT AS tok, b.w IS NOT NULL AS active
    FROM nx LEFT JOIN best b ON b.w = nx.w LEFT JOIN pick k ON k.w = nx.w AND k.p = nx.p
    WHERE NOT EXISTS (SELECT 1 FROM pick g WHERE g.w = nx.w AND g.np = nx.p))
)
"""

RESULT = """
SELECT s.w, count(*) AS n, string_agg(s.tok::VARCHAR, ',' ORDER BY s.p) AS ids,
  string_agg(hex(v.bytes), '' ORDER BY s.p) AS decoded
FROM s JOIN vocabulary v ON v.tok = s.tok WHERE NOT s.active GROUP BY s.w ORDER BY s.w
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of base64 tokens and ranks, one a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}


class Engine:
    """DuckDB tables of one vocabulary and the words encoded so far."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.find = regex.compile(pattern).findall
        ranks = read_ranks(path)
        left, right, rank, unsafe = [], [], [], set()
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
                    unsafe.update(x for x in (a, b) if x > r)
        self.db = duckdb.connect()
        self.db.execute("SET threads = 1")
        self.db.execute("SET memory_limit = '300MB'")
        self._table("merges", l=pa.array(left, pa.int32()), r=pa.array(right, pa.int32()), rank=pa.array(rank, pa.int32()))
        self._table("byte_tokens", b=pa.array(range(256), pa.uint8()), tok=pa.array([ranks[bytes([i])] for i in range(256)], pa.int32()))
        self._table("vocabulary", tok=pa.array(list(ranks.values()), pa.int32()), bytes=pa.array(list(ranks), pa.binary()))
        self._table("unsafe", tok=pa.array(sorted(unsafe), pa.int32()))
        self.forget()

    def _table(self, name: str, **columns: pa.Array) -> None:
        self.db.register("_given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM _given")
        self.db.unregister("_given")

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids: list[str] = []
        self.counts: list[int] = []
        self.decoded: list[bytes] = []
        #: What follows a blank -> (token count, comma-joined ids, decoded bytes).
        self.pieces: dict[str, tuple[int, str, bytes]] = {}

    def learn(self, words: list[str]) -> None:
        """Encode words that are not kept yet."""
        short, long = [], []
        for w in words:
            (short if len(w) * 4 <= LONG or len(w.encode()) <= LONG else long).append(w)
        for rule, group, size in ((CONTRACT, short, BATCH_WORDS), (CONTRACT_LONG, long, 16)):
            for i in range(0, len(group), size):
                self._encode(rule, group[i : i + size])

    def _encode(self, rule: str, words: list[str]) -> None:
        import numpy as np

        raw = [w.encode() for w in words]
        sizes = np.array([len(b) for b in raw], np.int64)
        starts = np.cumsum(sizes) - sizes
        self._table(
            "letters",
            w=pa.array(np.repeat(np.arange(len(raw), dtype=np.int32), sizes)),
            p=pa.array((np.arange(sizes.sum()) - np.repeat(starts, sizes)).astype(np.int32)),
            b=pa.array(np.frombuffer(b"".join(raw), np.uint8)),
        )
        rows = self.db.execute(rule + RESULT).fetchall()
        for w, (_, n, ids, decoded) in zip(words, rows, strict=True):
            self.place[w] = len(self.ids)
            self.ids.append(ids)
            self.counts.append(n)
            self.decoded.append(bytes.fromhex(decoded))

    def _joined(self, ws: list[str]) -> tuple[int, str, bytes]:
        at = [self.place[w] for w in ws]
        if len(at) == 1:
            return self.counts[at[0]], self.ids[at[0]], self.decoded[at[0]]
        return sum([self.counts[i] for i in at]), ",".join([self.ids[i] for i in at]), b"".join([self.decoded[i] for i in at])

    def encode(self, block: list[str]) -> Iterator[tuple[int, list[str], list[bytes]]]:
        """Per text: token count, pieces of comma-joined ids, pieces of decoded bytes.

        Pieces met in earlier blocks are kept, so a block only works on new ones.
        """
        if len(self.place) > KEEP_WORDS:
            self.forget()
        if len(self.pieces) > KEEP_WORDS:
            self.pieces.clear()
        cuts = [cut(t) if t else [] for t in block]
        split = {c[0]: self.find(c[0]) for c in cuts if c}
        rest: set[str] = set()
        for c in cuts:
            rest.update(c[1:])
        later = {p: [" " + p] if p.isalpha() else self.find(" " + p) for p in rest.difference(self.pieces)}
        self.learn(list({w for parts in (split, later) for ws in parts.values() for w in ws if w not in self.place}))
        firsts = {p: self._joined(ws) for p, ws in split.items()}
        self.pieces.update((p, self._joined(ws)) for p, ws in later.items())
        known = self.pieces
        for c in cuts:
            if not c:
                yield 0, [], []
                continue
            got = [firsts[c[0]], *map(known.__getitem__, c[1:])]
            yield sum([g[0] for g in got]), [g[1] for g in got], [g[2] for g in got]


_ENGINES: dict[tuple[str, str], Engine] = {}


def engine(path: str, pattern: str) -> Engine:
    """One engine per worker process and vocabulary."""
    if (path, pattern) not in _ENGINES:
        _ENGINES[path, pattern] = Engine(path, pattern)
    return _ENGINES[path, pattern]


def blocks(column: pa.Array, limit: int) -> Iterator[tuple[int, list[str]]]:
    """(start, texts) of up to ``limit`` bytes each, or one longer text; null texts are empty.

    Only one block at a time is turned into Python strings.
    """
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, [v or "" for v in column.slice(start, stop - start).to_pylist()]
        start = stop


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens and digests of the comma-joined ids and of the bytes decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(path, pattern)
        for batch in batches:
            for start, block in blocks(batch.column(1), BLOCK_CHARS):
                rows = [
                    (n, hashlib.sha256(",".join(ids).encode()).hexdigest(), hashlib.sha256(b"".join(back)).hexdigest())
                    for n, ids, back in own.encode(block)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, len(block)),
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.string()),
                        pa.array([r[2] for r in rows], pa.string()),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return map_arrow(texts(docs).selectExpr("CAST(doc_id AS BIGINT) doc_id", "text"), run, SCHEMA)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids, the token ids of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = engine(path, pattern)
        for batch in batches:
            for start, block in blocks(batch.column(1), BLOCK_CHARS):
                lists = [[int(i) for p in ids for i in p.split(",")] for _, ids, _ in own.encode(block)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(block)), pa.array(lists, pa.list_(pa.int64()))], names=["doc_id", "ids"]
                )

    return map_arrow(texts(docs).selectExpr("CAST(doc_id AS BIGINT) doc_id", "text"), run, "doc_id bigint, ids array<bigint>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and decoded bytes from ids: token-position rows join the vocabulary, ordered aggregation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        db = duckdb.connect()
        db.execute("SET threads = 1")
        ranks = read_ranks(path)
        db.register("v", pa.table({"tok": pa.array(list(ranks.values()), pa.int64()), "bytes": pa.array(list(ranks), pa.binary())}))
        for batch in batches:
            lists = pa.table({"d": pa.array(range(batch.num_rows), pa.int64()), "ids": batch.column(1)})
            db.register("given", lists)
            rows = dict(
                db.execute(
                    """SELECT d, string_agg(hex(v.bytes), '' ORDER BY p) FROM (
                         SELECT d, unnest(ids) AS tok, generate_subscripts(ids, 1) AS p FROM given) t
                       JOIN v ON v.tok = t.tok GROUP BY d"""
                ).fetchall()
            )
            db.unregister("given")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([bytes.fromhex(rows.get(i, "")) for i in range(batch.num_rows)], pa.binary())],
                names=["doc_id", "decoded"],
            )

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id bigint, decoded binary")
