"""Secrets by fixed patterns and by a battery of randomness tests.

Patterns give the base spans.  Other runs of letters and digits with ``-_+/=``, and what base spans leave of such runs, are
cut at inner ``=``; every piece of ``MIN_TOKEN`` characters is a candidate.  A name or a path may be glued to a secret, so
parts between ``/`` (or ``+``, beside ``-`` or ``_``) and parts without leading names are tested as well.  The alphabet they use (decimal, hex, base32, base64) is inferred, and under it
they must pass a chi-squared test of uniform characters, a runs test around the alphabet's middle and a serial
correlation test, each at ``ALPHA``.  What passes is tested against ordinary text: its changes of
character class, at the rate ordinary text shows, give a p-value, which by construction only falls with length.
Of the parts of a piece that pass, the least p-values count, times the number of parts.
False discoveries are held at ``FDR`` by the Benjamini-Hochberg rule within each band of lengths, over all candidates of
all texts: p-values are counted in bins (bands times bins, a fixed number of rows), and the bin bounds
become thresholds.  Bin ends are used for p, so rounding only makes the rule stricter.

Defined cases: a null text counts as empty and has no spans; repeated rows are scanned each on its own;
spans are code points with the end exclusive; further columns are not read by ``scan`` and kept by
``redact``; an empty table gives none.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contactloom.llm.bpe import blocks
from contactloom.llm.common import map_arrow, texts
from contactloom.sources.staging import stage

MIN_TOKEN = 20
ALPHA = 0.001
FDR = 0.01
#: Share of neighbouring characters of ordinary words and names that change class.
CHANGE_RATE = 0.15
BIN, BINS = 0.5, 80
MASK = "[SECRET]"
BLOCK_CHARS = 2_000_000

# The base patterns, in the order of their kinds.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ["assign", "access", "hex", "random"]

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Text between ``=``, with padding at the end of a run.
PIECE = re.compile(r"[^=]+(?:={1,2}\Z)?")
#: Words in front of a token, such as ``sk_live_`` or ``api-key-``.
NAMES = re.compile(r"(?:[_-]*(?:[A-Z]?[a-z]{2,}|[A-Z]{2,})[0-9]?[_-])+")

ALPHABETS = [
    ("decimal", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("hex", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("alnum36", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; leftmost and non-overlapping within a kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def _normal_tail(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def chi_squared_p(values: list[int], size: int) -> float:
    """Uniform use of the alphabet, by the Wilson-Hilferty approximation; only surplus counts against it."""
    n, df = len(values), size - 1
    counts = [0] * size
    for v in values:
        counts[v] += 1
    chi = sum(c * c for c in counts) * size / n - n
    if chi <= 0:
        return 1.0
    z = ((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return 0.5 * math.erfc(z / math.sqrt(2))


def runs_p(values: list[int], size: int) -> float:
    """Runs above and below the middle of the alphabet."""
    above = [v >= size / 2 for v in values]
    n1 = sum(above)
    n2 = len(above) - n1
    if not n1 or not n2:
        return 2.0 ** (1 - len(above))
    runs = 1 + sum(a != b for a, b in zip(above, above[1:]))
    mean = 1 + 2 * n1 * n2 / (n1 + n2)
    var = (mean - 1) * (mean - 2) / (n1 + n2 - 1)
    return _normal_tail((runs - mean) / math.sqrt(var)) if var > 0 else 1.0


def serial_p(values: list[int]) -> float:
    """Correlation of neighbours."""
    n = len(values)
    mean = sum(values) / n
    var = sum((v - mean) ** 2 for v in values)
    if var == 0:
        return 0.0
    r = sum((a - mean) * (b - mean) for a, b in zip(values, values[1:])) / var
    return _normal_tail(r * math.sqrt(n))


def encoding(token: str) -> tuple[str, str] | None:
    """The smallest alphabet that holds all characters, without padding."""
    used = set(token.rstrip("="))
    return next(((n, a) for n, a in ALPHABETS if used and used <= set(a)), None)


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def looks_random(token: str) -> bool:
    """Passes the battery under its inferred encoding."""
    found = encoding(token)
    if found is None or found[0] == "decimal":
        return False
    place = {c: i for i, c in enumerate(found[1])}
    values = [place[c] for c in token.rstrip("=")]
    if len(values) < MIN_TOKEN:
        return False
    size = len(found[1])
    return chi_squared_p(values, size) >= ALPHA and runs_p(values, size) >= ALPHA and serial_p(values) >= ALPHA


def ordinary_bin(token: str) -> int:
    """-log10 of the p-value as ordinary text, rounded down to bins: the chance of so many changes of class."""
    kinds = [_kind(c) for c in token]
    n, k = len(kinds) - 1, sum(a != b for a, b in zip(kinds, kinds[1:]))
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(CHANGE_RATE) + (n - i) * math.log(1 - CHANGE_RATE)
        for i in range(k, n + 1)
    ]
    top = max(logs)
    p = (top + math.log(sum(math.exp(x - top) for x in logs))) / math.log(10)
    return max(0, min(BINS, int(-p / BIN)))


def band(length: int) -> int:
    """Lengths by powers of the square root of two."""
    return int(2 * math.log2(length))


def _free(a: int, b: int, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The stretches of a run that no base span covers; ``taken`` is in order."""
    for s, e in taken:
        if s >= b:
            break
        if e > a:
            if s > a:
                yield a, s
            a = max(a, e)
    if a < b:
        yield a, b


def parts(piece: str) -> list[tuple[int, int]]:
    """The piece, its parts between delimiters, and these without leading names; all of ``MIN_TOKEN`` at least."""
    out = {(0, len(piece)): None}
    for delimiters in ("/", "/+") if "+" in piece and ("-" in piece or "_" in piece) else ("/",):
        out.update({m.span(): None for m in re.finditer(f"[^{delimiters}]+", piece)})
    for a, b in list(out):
        names = NAMES.match(piece, a, b)
        if names:
            out[names.end(), b] = None
    return [(a, b) for a, b in out if b - a >= MIN_TOKEN]


def _best(piece: str) -> list[tuple[int, int, int, bool]]:
    """(start, end, bin, passed) of the parts that look random, the least likely as ordinary text first and none overlapping.

    Without one the whole piece stands for a test that failed.
    """
    tried = parts(piece)
    good = [(ordinary_bin(piece[a:b]), b - a, a) for a, b in tried if looks_random(piece[a:b])]
    if not good:
        return [(0, len(piece), ordinary_bin(piece), False)]
    lost, out = math.ceil(math.log10(len(tried)) / BIN), []
    for i, n, a in sorted(good, reverse=True):
        if not any(a < e and s < a + n for s, e, _, _ in out):
            out.append((a, a + n, max(0, i - lost), True))
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, bool]]:
    """(start, end, band, bin, passed) of the tested parts of runs, outside base spans."""
    out, taken, at = [], sorted((s, e) for s, _, e in base), 0
    for m in CANDIDATE.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        for a, b in _free(*m.span(), taken[at:] if at < len(taken) and taken[at][0] < m.end() else []):
            for piece in PIECE.finditer(text[a:b]):
                if len(piece[0]) >= MIN_TOKEN:
                    off = a + piece.start()
                    out += [(off + x, off + y, band(y - x), i, ok) for x, y, i, ok in _best(piece[0])]
    return out


FOUND = "base array<struct<start:int,kind:int,end:int>>, more array<struct<start:int,end:int,band:int,bin:int,passed:boolean>>"


def _find(values: list[str]) -> list[pa.Array]:
    base, more = [], []
    for text in values:
        own = base_spans(text)
        base.append([{"start": s, "kind": k, "end": e} for s, k, e in sorted(own)])
        more.append([dict(zip(("start", "end", "band", "bin", "passed"), c)) for c in candidates(text, own)])
    span = pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
    other = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("band", pa.int32()), ("bin", pa.int32()), ("passed", pa.bool_())])
    return [pa.array(base, pa.list_(span)), pa.array(more, pa.list_(other))]


def found(docs: DataFrame) -> DataFrame:
    """doc_id, base spans and tested candidates of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block in blocks(batch.column(1), BLOCK_CHARS):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(block)), *_find(block)], names=["doc_id", "base", "more"])

    return map_arrow(texts(docs).selectExpr("CAST(doc_id AS BIGINT) doc_id", "text"), run, "doc_id bigint, " + FOUND)


def thresholds(rows: DataFrame) -> dict[int, int]:
    """Per band the smallest bin that Benjamini-Hochberg accepts; bands without one are absent.

    Every candidate is a test; those that fail the battery count with p = 1.
    """
    tests = rows.select(F.explode("more").alias("c")).select(
        F.col("c.band").alias("band"), F.when(F.col("c.passed"), F.col("c.bin")).otherwise(0).alias("bin")
    )
    counts: dict[int, dict[int, int]] = {}
    for r in tests.groupBy("band", "bin").agg(F.count(F.lit(1)).alias("n")).collect():  # bands * (BINS + 1) rows at most
        counts.setdefault(r["band"], {})[r["bin"]] = r["n"]
    out = {}
    for b, bins in counts.items():
        total, above = sum(bins.values()), 0
        for i in sorted((x for x in bins if x > 0), reverse=True):
            above += bins[i]
            if 10 ** (-i * BIN) <= FDR * above / total:
                out[b] = i
    return out


def accepted(rows: DataFrame) -> DataFrame:
    """Adds ``spans``: base spans and the candidates within the thresholds, in order."""
    limits = thresholds(rows)

    def hit(c):
        ok = F.lit(False)
        for b, i in sorted(limits.items()):
            ok = ok | ((c["band"] == b) & (c["bin"] >= i))
        return c["passed"] & ok

    extra = F.transform(
        F.filter("more", hit),
        lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")),
    )
    return rows.withColumn("spans", F.array_sort(F.concat("base", extra)))


def _text(spans: str):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every text; the first pass is staged."""
    rows = accepted(stage(found(docs)))
    kinds = rows.withColumn("_kinds", F.transform("base", lambda s: s["kind"]))
    number = [
        (F.size("_kinds") - F.size(F.array_remove("_kinds", k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)
    ]
    return kinds.select("doc_id", *number, F.sha2(_text("base"), 256).alias("base_sha256"), _text("spans").alias("spans"))


def mask(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with every stretch of overlapping spans replaced by ``MASK``."""
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join(out) + text[at:] if out else text


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns with secrets masked in ``text`` and ``n_chars`` renewed if it is there."""
    limits = thresholds(stage(found(docs).select("more")))
    place = docs.columns.index("text")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, block in blocks(batch.column(place), BLOCK_CHARS):
                part = batch.slice(start, len(block))
                new = []
                for text in block:
                    base = base_spans(text)
                    more = [(a, b) for a, b, w, i, ok in candidates(text, base) if ok and i >= limits.get(w, BINS + 1)]
                    new.append(mask(text, [(s, e) for s, _, e in base] + more))
                null = part.column(place).is_null().to_pylist()
                columns = list(part.columns)
                columns[place] = pa.array([None if n else t for n, t in zip(null, new)], batch.schema.field(place).type)
                if chars is not None:
                    old = columns[chars].to_pylist()
                    columns[chars] = pa.array([o if n else len(t) for o, n, t in zip(old, null, new)], batch.schema.field(chars).type)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return map_arrow(docs, run, docs.schema)
