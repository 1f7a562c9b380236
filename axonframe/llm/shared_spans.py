"""Long exact spans shared between records: fixed-block anchors probed by every rolling window.

A run of ``min_span`` characters that two documents share covers, in each of them, a whole block of ``block`` characters
that starts at a multiple of ``block`` (``min_span >= 2 * block - 1``). So the non-overlapping blocks of all documents are the
index, and every window of ``block`` characters, at every offset of every document, probes it. All steps are exact up to
the final comparison of text, which settles what a hash leaves open:

1. documents are spread over chunks by a hash of their id; a chunk hashes all its windows with a rolling polynomial;
2. the windows' short hashes travel, sorted and delta-coded, to the owner of their hash range, where the blocks of the
   range are; hashes that are a block and stand in two places go back to the chunks that hold them. A chunk sends to at most ``FAN`` ranges: with
   more, it sends to wide ranges, whose owners merge what neighbouring chunks sent and pass it on, and the answers come back the same way;
3. the chunks name the documents and offsets behind these hashes, with their full 64-bit hash;
4. the offsets that meet a block of another document get their text around them, and each meeting is extended to both
   sides, which gives the maximal exact repeat, or refused.

Nothing is collected; a chunk's size is bounded, and the traffic is about one byte per character of text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from axonframe.plans import cut_lineage, lookup_join, skew_safe_join

MIN_SPAN = 200
#: Characters of a chunk, on average; documents are never split between chunks.
CHUNK_CHARS = 8_000_000
#: Chunks whose windows make up one range of hashes, on average: its owner holds the blocks, an eightieth part, and one summary at a time.
RANGE_CHUNKS = 2
#: Most ranges that a chunk sends to.
FAN = 4096
#: Windows that are hashed at once.
STEP = 1 << 20
#: Meetings of one anchor up to which all its blocks and windows are compared directly.
DIRECT = 10_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if n not in _powers:
        _powers.clear()
        with np.errstate(over="ignore"):
            up = np.full(n, _BASE, dtype=np.uint64)
            down = np.full(n, _INVERSE, dtype=np.uint64)
            up[0] = down[0] = 1
            _powers[n] = (np.cumprod(up), np.cumprod(down))
    return _powers[n]


def window_hashes(codes: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """64-bit hashes of all windows of ``width`` code points, in pieces: (offset of the first, hashes)."""
    up, down = _power_table(STEP + width)
    n = len(codes) - width + 1
    for at in range(0, max(n, 0), STEP):
        part = codes[at : at + STEP + width - 1].astype(np.uint64)
        part += np.uint64(1)
        part *= up[: len(part)]
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part, out=total[1:])
        h = total[width:] - total[:-width]
        h *= down[: len(h)]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        yield at, h


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in a row, and the start of each text with the end of the last."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return codes, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def _pack(sorted_values: np.ndarray) -> bytes:
    """Sorted distinct uint64 values as compressed deltas of one, two or four bytes, as their mean asks for; a delta that does not fit is the largest
    number of that width, and eight bytes more."""
    deltas = np.diff(sorted_values.astype(np.uint64), prepend=np.uint64(0))
    mean = int(sorted_values[-1]) // len(sorted_values) if len(sorted_values) else 0
    width = 1 if mean < 64 else 2 if mean < 1 << 14 else 4
    most = (1 << 8 * width) - 1
    small = np.minimum(deltas, np.uint64(most)).astype(f"<u{width}")
    large = deltas[deltas >= most].astype("<u8")
    raw = np.array([len(small), width], dtype="<u4").tobytes() + small.tobytes() + large.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack(blob: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, width = (int(v) for v in np.frombuffer(raw, dtype="<u4", count=2))
    deltas = np.frombuffer(raw, dtype=f"<u{width}", count=n, offset=8).astype(np.uint64)
    deltas[deltas == (1 << 8 * width) - 1] = np.frombuffer(raw, dtype="<u8", offset=8 + n * width)
    return np.cumsum(deltas, dtype=np.uint64)


def _short(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.uint32 if bits <= 32 else np.uint64)


def _bounds(bits: int, ranges: int) -> np.ndarray:
    """Start of each range of short hashes, and the end of the last."""
    return np.array([(r << bits) // ranges for r in range(ranges + 1)], dtype=np.uint64)


class _Chunk:
    """The documents of one chunk that are long enough to share a span."""

    def __init__(self, t: pa.Table, block: int, min_span: int):
        ids, texts = t.column("doc_id").to_pylist(), t.column("text").to_pylist()
        keep = [i for i, x in enumerate(texts) if len(x) >= min_span]
        self.ids = np.array([ids[i] for i in keep], dtype=np.int64)
        self.texts = [texts[i] for i in keep]
        self.codes, self.starts = _codes(self.texts)
        self.block = block

    def pieces(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per piece: the hashes of windows within one document, their document (index) and offset."""
        for at, h in window_hashes(self.codes, self.block):
            place = np.arange(at, at + len(h), dtype=np.int64)
            doc = np.searchsorted(self.starts, place, side="right") - 1 if len(self.starts) < 3 else self._owner(at, len(h))
            whole = place + self.block <= self.starts[doc + 1]
            yield h[whole], doc[whole], (place - self.starts[doc])[whole]

    def _owner(self, at: int, n: int) -> np.ndarray:
        first = int(np.searchsorted(self.starts, at, side="right")) - 1
        last = int(np.searchsorted(self.starts, at + n - 1, side="right")) - 1
        edges = np.clip(self.starts[first : last + 2], at, at + n)
        return np.repeat(np.arange(first, last + 1), np.diff(edges))


def _by_range(bounds: np.ndarray, first: int, chunk: int, windows: np.ndarray, twice: np.ndarray, blocks: np.ndarray) -> list[tuple]:
    """Rows of a summary, one per range that holds a window; ``bounds`` are those of the ranges from number ``first`` on."""
    cuts = [np.searchsorted(a, bounds) for a in (windows, twice, blocks)]
    rows = []
    for r in np.flatnonzero(np.diff(cuts[0])).tolist():
        rows.append((first + r, chunk, *[_pack(a[c[r] : c[r + 1]].astype(np.uint64) - bounds[r]) for a, c in zip((windows, twice, blocks), cuts, strict=True)]))
    return rows


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _summaries(block: int, min_span: int, bits: int, ranges: int):
    bounds = _bounds(bits, ranges)

    def of_chunk(t: pa.Table) -> pa.Table:
        c = _Chunk(t, block, min_span)
        hashes, blocks = [], []
        for h, _, offset in c.pieces():
            s = _short(h, bits)
            hashes.append(s)
            blocks.append(s[offset % block == 0])
        if not hashes:
            return _table([], _SUMMARY)
        s = np.concatenate(hashes)
        hashes.clear()
        s.sort()
        again = s[1:][s[1:] == s[:-1]]
        s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        return _table(_by_range(bounds, 0, t.column("chunk")[0].as_py(), s, np.unique(again), np.unique(np.concatenate(blocks))), _SUMMARY)

    return of_chunk


def _merge(bits: int, ranges: int, width: int):
    """What neighbouring chunks sent to one wide range, as one summary for each of its ranges."""
    bounds = _bounds(bits, ranges)

    def of_part(t: pa.Table) -> pa.Table:
        first = t.column("range")[0].as_py() * width
        mine = bounds[first : first + width + 1]
        held = {k: np.concatenate([_unpack(b) for b in t.column(k).to_pylist()]) + mine[0] for k in ("windows", "twice", "blocks")}
        windows, n = np.unique(held["windows"], return_counts=True)
        twice = np.union1d(held["twice"], windows[n > 1])
        return _table(_by_range(mine, first, t.column("part")[0].as_py(), windows, twice, np.unique(held["blocks"])), _SUMMARY)

    return of_part


def _hand_back(bits: int, ranges: int, width: int):
    """The answer to the chunks of a merged summary: of its hot hashes, those that each chunk sent, counted from the start of the wide range."""
    bounds = _bounds(bits, ranges)

    def of_part(sent: pa.Table, hot: pa.Table) -> pa.Table:
        rows = []
        if sent.num_rows and hot.num_rows:
            wide = sent.column("range")[0].as_py()
            wanted = np.concatenate([_unpack(b) + bounds[r] for r, b in zip(hot.column("range").to_pylist(), hot.column("hot").to_pylist(), strict=True)]) - bounds[wide * width]
            for chunk, windows in zip(sent.column("chunk").to_pylist(), sent.column("windows").to_pylist(), strict=True):
                mine = np.intersect1d(wanted, _unpack(windows), assume_unique=True)
                if len(mine):
                    rows.append((chunk, wide, _pack(mine)))
        return _table(rows, _HOT)

    return of_part


_SUMMARY = pa.schema([("range", pa.int32()), ("chunk", pa.int32()), ("windows", pa.binary()), ("twice", pa.binary()), ("blocks", pa.binary())])
_HOT = pa.schema([("chunk", pa.int32()), ("range", pa.int32()), ("hot", pa.binary())])
_HITS = pa.schema([("fp", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32()), ("is_block", pa.bool_()), ("chunk", pa.int32())])
_AROUND = pa.schema([("fp", pa.int64()), ("doc_id", pa.int64()), ("pos", pa.int32()), ("is_block", pa.bool_()), ("left", pa.string()), ("mid", pa.string()), ("right", pa.string())])


def _meet(t: pa.Table) -> pa.Table:
    """Of one range: per chunk, the hashes that are some document's block and stand in two places."""
    blocks = np.unique(np.concatenate([_unpack(b) for b in t.column("blocks").to_pylist()]))
    seen = np.zeros(len(blocks), dtype=np.int64)
    held = []
    for windows, twice in zip(t.column("windows").to_pylist(), t.column("twice").to_pylist(), strict=True):
        here = np.flatnonzero(np.isin(blocks, _unpack(windows), assume_unique=True))
        seen[here] += 1
        seen[np.isin(blocks, _unpack(twice), assume_unique=True)] += 1
        held.append(here)
    out: dict[str, list] = {"chunk": [], "range": [], "hot": []}
    for chunk, here in zip(t.column("chunk").to_pylist(), held, strict=True):
        hot = blocks[here[seen[here] > 1]]
        if len(hot):
            out["chunk"].append(chunk)
            out["range"].append(t.column("range")[0].as_py())
            out["hot"].append(_pack(hot))
    return pa.table(out, schema=_HOT)


def _name_hits(block: int, min_span: int, bits: int, ranges: int):
    bounds = _bounds(bits, ranges)

    def of_chunk(docs: pa.Table, hot: pa.Table) -> pa.Table:
        out: dict[str, list] = {k: [] for k in ("fp", "doc_id", "pos", "is_block")}
        chunk = 0
        if docs.num_rows and hot.num_rows:
            chunk = docs.column("chunk")[0].as_py()
            c = _Chunk(docs, block, min_span)
            parts = [_unpack(b) + bounds[r] for r, b in zip(hot.column("range").to_pylist(), hot.column("hot").to_pylist(), strict=True)]
            kind = _short(np.zeros(0, dtype=np.uint64), bits).dtype
            wanted = np.unique(np.concatenate(parts).astype(kind))
            near = np.zeros(1 << 22, dtype=bool)
            low = kind.type((1 << 22) - 1)
            near[wanted & low] = True
            for h, doc, offset in c.pieces():
                s = _short(h, bits)
                i = np.flatnonzero(near[s & low])
                i = i[np.isin(s[i], wanted)]
                out["fp"].append(h[i].view(np.int64))
                out["doc_id"].append(c.ids[doc[i]])
                out["pos"].append(offset[i].astype(np.int32))
                out["is_block"].append(offset[i] % block == 0)
        arrays = {k: np.concatenate(v) if v else np.array([]) for k, v in out.items()}
        n = len(arrays["fp"])
        return pa.table([pa.array(arrays[f.name] if n else [], f.type) for f in _HITS if f.name != "chunk"] + [pa.array([chunk] * n, pa.int32())], schema=_HITS)

    return of_chunk


def _cut_out(block: int, min_span: int):
    """The text around each hit: up to ``min_span - block`` characters to the left and right."""
    side = min_span - block

    def of_chunk(docs: pa.Table, hits: pa.Table) -> pa.Table:
        texts = dict(zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist(), strict=True)) if hits.num_rows else {}
        rows = []
        for fp, doc, pos, is_block in zip(*[hits.column(k).to_pylist() for k in ("fp", "doc_id", "pos", "is_block")], strict=True):
            x = texts[doc]
            rows.append((fp, doc, pos, is_block, x[max(0, pos - side) : pos], x[pos : pos + block], x[pos + block : pos + block + side]))
        return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_AROUND)], schema=_AROUND)

    return of_chunk


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int32(): "int", pa.int64(): "bigint", pa.bool_(): "boolean", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def _hits_around(documents: DataFrame, min_span: int, chunk_chars: int, doc: str, text: str, fan: int) -> DataFrame:
    """All places whose block or window meets a block of another document, with the text around them."""
    block = (min_span + 1) // 2
    docs = documents.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).alias("text")).where(F.col("doc_id").isNotNull() & (F.length("text") >= min_span))
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = max(1, math.ceil(total / chunk_chars))
    bits = min(60, max(16, math.ceil(math.log2(total + 1))))
    docs = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)).cast("int")).repartitionById(chunks, F.col("chunk"))
    ranges = math.ceil(chunks / RANGE_CHUNKS)
    width = 1 if ranges <= fan else math.ceil(math.sqrt(ranges))  # ranges in a wide one
    sent_to = math.ceil(ranges / width)
    ranges = sent_to * width
    sent = docs.groupBy("chunk").applyInArrow(_summaries(block, min_span, bits, sent_to), _ddl(_SUMMARY))
    meet = lambda summaries: summaries.repartitionById(ranges, F.col("range")).groupBy("range").applyInArrow(_meet, _ddl(_HOT))
    if width == 1:
        hot = meet(sent)
    else:
        together = math.ceil(math.sqrt(chunks))
        sent = sent.withColumn("part", F.floor(F.col("chunk") / together).cast("int")).repartition("range", "part")
        hot = meet(sent.groupBy("range", "part").applyInArrow(_merge(bits, ranges, width), _ddl(_SUMMARY)))
        answers = hot.withColumns({"wide": F.floor(F.col("range") / width).cast("int"), "part": F.col("chunk")})
        hot = sent.groupBy("range", "part").cogroup(answers.groupBy("wide", "part")).applyInArrow(_hand_back(bits, ranges, width), _ddl(_HOT))
    hits = cut_lineage(docs.groupBy("chunk").cogroup(hot.repartitionById(chunks, F.col("chunk")).groupBy("chunk")).applyInArrow(_name_hits(block, min_span, bits, sent_to), _ddl(_HITS)))
    met = hits.groupBy("fp").agg(F.max("is_block").alias("b"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("b and lo < hi").select("fp")
    true = hits.join(met, "fp", "left_semi")
    return cut_lineage(docs.groupBy("chunk").cogroup(true.repartitionById(chunks, F.col("chunk")).groupBy("chunk")).applyInArrow(_cut_out(block, min_span), _ddl(_AROUND)))


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low = 0
    while n - low > 1:
        mid = (low + n) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            n = mid
    return low


_MET = pa.schema([("fp", pa.int64()), ("doc_a", pa.int64()), ("pos_a", pa.int32()), ("doc_b", pa.int64()), ("pos_b", pa.int32()), ("l", pa.int32()), ("r", pa.int32())])


def _compare(side: int):
    """Extend each meeting to both sides; those in no run of ``min_span`` characters are refused."""

    def of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = {k: batch.column(k).to_pylist() for k in batch.schema.names}
            rows = []
            for i in range(batch.num_rows):
                if x["mid_a"][i] != x["mid_b"][i]:
                    continue
                left = _common(x["left_a"][i][::-1], x["left_b"][i][::-1])
                right = _common(x["right_a"][i], x["right_b"][i])
                if left + right >= side and x["l"][i] in (-1, left):
                    rows.append((x["fp"][i], x["doc_a"][i], x["pos_a"][i], x["doc_b"][i], x["pos_b"][i], left, right))
            yield pa.record_batch([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_MET)], schema=_MET)

    return of_batch


def _end(df: DataFrame, x: str) -> DataFrame:
    return df.select("fp", "l", F.col("doc_id").alias(f"doc_{x}"), F.col("pos").alias(f"pos_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in ("left", "mid", "right")])


def _extended(places: DataFrame, side: int) -> DataFrame:
    """The meetings of a block of ``doc_a`` with a window of ``doc_b`` > ``doc_a``, extended."""
    places = places.withColumn("l", F.lit(-1))
    return _end(places.where("is_block"), "a").join(_end(places, "b").drop("l"), "fp").where("doc_a < doc_b").mapInArrow(_compare(side), _ddl(_MET))


def _meetings(around: DataFrame, min_span: int) -> tuple[DataFrame, DataFrame | None]:
    """Extended meetings of a block of ``doc_a`` with a window of ``doc_b`` > ``doc_a``; the first also holds every run
    between the two, as a run covers a whole block of either document.

    An anchor with over ``DIRECT`` meetings does not compare all pairs: each place is keyed by the ``side`` + 1 ways to lay a
    span of ``min_span`` characters over it, so that only true pairs meet, and places of one document with equal
    surroundings count as one. The second table gives such places (``doc_id``, ``fp``, ``first``, ``pos``), or is None.
    """
    side = min_span - (min_span + 1) // 2
    sizes = around.groupBy("fp").agg(F.sum(F.col("is_block").cast("long")).alias("b"), F.count(F.lit(1)).alias("n"))
    crowded = sizes.where(F.col("b") * F.col("n") > DIRECT).select("fp", F.lit(True).alias("crowd"))
    plain, members = around, None
    if crowded.limit(1).count():
        marked = cut_lineage(lookup_join(around, crowded, "fp"))
        plain = marked.where("crowd is null").drop("crowd")
        places = marked.where("crowd").groupBy("fp", "doc_id", "is_block", "left", "mid", "right").agg(F.min("pos").alias("pos"), F.collect_list("pos").alias("all"))
        places = cut_lineage(places)
        members = places.select("doc_id", "fp", F.col("pos").alias("first"), F.explode("all").alias("pos")).distinct()
        ways = places.drop("all").withColumn("l", F.explode(F.sequence(F.greatest(F.lit(0), side - F.length("right")), F.least(F.lit(side), F.length("left")))))
        keyed = lambda df, x: _end(df, x).withColumn("k", F.xxhash64("fp", "l", F.expr(f"right(left_{x}, l)"), F.substring(f"right_{x}", F.lit(1), side - F.col("l"))))
        more = keyed(ways.where("is_block"), "a").join(keyed(ways, "b").drop("fp", "l"), "k").where("doc_a < doc_b").drop("k").mapInArrow(_compare(side), _ddl(_MET))
    met = _extended(plain, side)
    return cut_lineage(met.unionByName(more) if members is not None else met), members


def shared_pairs(documents: DataFrame, min_span: int = MIN_SPAN, chunk_chars: int = CHUNK_CHARS, doc: str = "doc_id", text: str = "text", fan: int = FAN) -> DataFrame:
    """Pairs ``doc_a`` < ``doc_b`` with a common run of at least ``min_span`` characters.

    ``doc`` must be unique; rows without an id or a text share nothing, as do empty texts and those shorter than
    ``min_span``. Lengths are in Unicode code points of the stored text. A repeat within one document makes no pair. An empty
    table gives no rows. Extra columns are ignored.
    """
    met, _ = _meetings(_hits_around(documents, min_span, chunk_chars, doc, text, fan), min_span)
    return met.select("doc_a", "doc_b").distinct()


def shared_runs(documents: DataFrame, min_span: int = MIN_SPAN, chunk_chars: int = CHUNK_CHARS, doc: str = "doc_id", text: str = "text", fan: int = FAN) -> DataFrame:
    """Maximal exact repeats: ``doc_a`` < ``doc_b``, ``pos_a``, ``pos_b``, ``n_chars``, one row per pair and repeat.

    Meetings on one diagonal, a block apart, lie in one repeat. Otherwise as ``shared_pairs``.
    """
    block = (min_span + 1) // 2
    met, members = _meetings(_hits_around(documents, min_span, chunk_chars, doc, text, fan), min_span)
    if members is not None:  # a meeting of first places is one of all the places that they stand for
        for x in "ab":
            of = members.select(F.col("doc_id").alias(f"doc_{x}"), "fp", F.col("first").alias(f"pos_{x}"), F.col("pos").alias("other"))
            met = met.join(of, [f"doc_{x}", "fp", f"pos_{x}"], "left").withColumn(f"pos_{x}", F.coalesce("other", f"pos_{x}")).drop("other")
    diagonal = ["doc_a", "doc_b", "shift"]
    met = met.withColumn("shift", F.col("pos_b") - F.col("pos_a"))
    w = Window.partitionBy(*diagonal).orderBy("pos_a")
    start = F.coalesce((F.col("pos_a") - F.lag("pos_a").over(w) > block) | (F.lag("r").over(w) < block), F.lit(True))
    met = met.withColumn("run", F.sum(start.cast("int")).over(w))
    runs = met.groupBy(*diagonal, "run").agg(F.min(F.col("pos_a") - F.col("l")).alias("pos_a"), F.max(F.col("pos_a") + block + F.col("r")).alias("end"))
    return runs.select("doc_a", "doc_b", "pos_a", (F.col("pos_a") + F.col("shift")).alias("pos_b"), (F.col("end") - F.col("pos_a")).alias("n_chars"))


def _class_reach(places: DataFrame, side: int) -> DataFrame:
    """How far the text around each place (``doc_id``, ``fp``, ``pos``) agrees with that of another document: ``l``, ``r``, without making pairs.

    A place is put into one class for each way to lay a span over it: anchor, text to the left and text to the right, as a hash of 128 bits. A class with two documents
    is a span that they share; the longest left and the longest right end of a place's shared spans are its reach.
    """
    ways = places.withColumn("l", F.explode(F.sequence(F.greatest(F.lit(0), side - F.length("right")), F.least(F.lit(side), F.length("left")))))
    span = [F.col("mid"), F.col("l"), F.expr("right(left, l)"), F.substring("right", F.lit(1), side - F.col("l"))]
    keyed = cut_lineage(ways.select("doc_id", "fp", "pos", "l", F.struct(F.xxhash64("fp", *span), F.xxhash64(F.lit(1), *span)).alias("k")))
    classes = keyed.groupBy("k").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi").select("k", "n")
    shared = skew_safe_join(keyed, cut_lineage(classes), "k", F.col("n"), keyed.count())
    return shared.groupBy("doc_id", "fp", "pos").agg(F.max("l").alias("l"), (side - F.min("l")).alias("r"))


def shared_share(documents: DataFrame, min_span: int = MIN_SPAN, chunk_chars: int = CHUNK_CHARS, doc: str = "doc_id", text: str = "text", fan: int = FAN) -> DataFrame:
    """One row per document: ``doc_id``, ``n_chars``, ``shared_chars``; how much of the text lies in runs of ``min_span`` characters that stand in another document.

    Every row of ``documents`` comes out; a null text has 0 characters. Anchors with few blocks extend their meetings; one with more blocks than
    there are ways to lay a span over it puts its places into classes, so the work grows with the places, not with their pairs.
    """
    block = (min_span + 1) // 2
    side = min_span - block
    around = _hits_around(documents, min_span, chunk_chars, doc, text, fan)
    sizes = around.groupBy("fp").agg(F.sum(F.col("is_block").cast("long")).alias("b"))
    marked = cut_lineage(lookup_join(around, sizes.where(F.col("b") > side + 1).select("fp", F.lit(True).alias("crowd")), "fp"))
    met = _extended(marked.where("crowd is null"), side)
    ends = lambda x: met.select("fp", F.col(f"doc_{x}").alias("doc_id"), F.col(f"pos_{x}").alias("pos"), "l", "r")
    places = ends("a").unionByName(ends("b")).groupBy("doc_id", "fp", "pos").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    places = places.unionByName(_class_reach(marked.where("crowd").select("doc_id", "fp", "pos", "left", "mid", "right").distinct(), side))
    spans = places.select("doc_id", (F.col("pos") - F.col("l")).alias("a"), (F.col("pos") + block + F.col("r")).alias("b"))
    w = Window.partitionBy("doc_id").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("b") - F.greatest(F.col("a"), F.coalesce(F.max("b").over(w), F.lit(0))))
    covered = spans.withColumn("fresh", fresh).groupBy("doc_id").agg(F.sum("fresh").alias("shared_chars"))
    every = documents.select(F.col(doc).cast("long").alias("doc_id"), F.coalesce(F.length(F.col(text)), F.lit(0)).alias("n_chars"))
    return every.join(covered, "doc_id", "left").select("doc_id", "n_chars", F.coalesce("shared_chars", F.lit(0)).cast("long").alias("shared_chars"))
