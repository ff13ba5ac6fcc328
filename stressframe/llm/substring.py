"""Removal of repeated byte strings by merging shard transforms (operator 2).

A byte goes if a string of ``window`` bytes that covers it also starts earlier
(smaller id, or the same document and an earlier place), judged on the input.

1. Every text is cut into spans of windows with one anchor (``anchors``): equal
   windows lie in spans with equal keys.  Spans of equal bytes (128-bit hash)
   meet by hash; all but the first are repeats as a whole.
2. The different spans left meet by key.  Keys with one span hold no repeat.
3. The bytes of the others are fetched and dealt by key; each task builds the
   Burrows-Wheeler transforms of shards of them and merges the transforms by
   refining their interleave (``transforms``), which yields the repeated windows.
4. Repeated windows become byte ranges per document and are cut out.

Keys with more than ``many`` different spans are not gathered: a task of step 1
that alone holds a large part marks the key, and its spans are compared window by
window, grouped by a 128-bit hash of the window with partial aggregation.

Special cases: null is empty; texts under ``window`` bytes keep all bytes; very
long texts are cut in overlapping parts; repeated rows (same id and text) are
one document and lose the same bytes; a null id counts as the largest; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stressframe.llm.anchors import Anchors
from stressframe.llm.textvec import Roller, mix, text_slices
from stressframe.llm.transforms import Strings, repeated_windows
from stressframe.session import cut_lineage

FLUSH_BYTES = 16 << 20
PART_BYTES = 8 << 20  # texts over this are cut in parts
BATCH_STRINGS = 32_768
LAST_ID = (1 << 63) - 1

SPAN = np.dtype([("key", "<u8"), ("sign", "<u8"), ("doc", "<i8"), ("start", "<i8"), ("n", "<i4"), ("mid", "<i4")])
REPEAT, SINGLE, HOT, CANDIDATE = range(4)


def pack(spans: np.ndarray) -> bytes:
    """Column by column, compressed: neighbours in a column are alike."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(spans[f]).tobytes() for f in SPAN.names))


def unpack(raw: bytes) -> np.ndarray:
    body = zstandard.ZstdDecompressor().decompress(raw)
    n = len(body) // SPAN.itemsize
    out, at = np.empty(n, SPAN), 0
    for f in SPAN.names:
        size = SPAN[f].itemsize * n
        out[f] = np.frombuffer(body[at : at + size], SPAN[f])
        at += size
    return out


def first_spans(spans: np.ndarray):
    """(the first of each kind of equal spans, the later ones), by document and place."""
    s = spans[np.lexsort((spans["start"], spans["doc"], spans["sign"], spans["key"]))]
    head = np.ones(len(s), bool)
    head[1:] = (s["key"][1:] != s["key"][:-1]) | (s["sign"][1:] != s["sign"][:-1])
    first = s[head][np.cumsum(head) - 1]
    again = ~head & ((s["doc"] != first["doc"]) | (s["start"] != first["start"]))
    return s[head], s[again]


def _rows(kind: int, bucket: np.ndarray, spans: np.ndarray, names) -> pa.RecordBatch | None:
    """One row per bucket with its packed spans."""
    if not len(spans):
        return None
    order = np.lexsort((spans["start"], spans["doc"], bucket))
    bucket, spans = bucket[order], spans[order]
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    blobs = [pack(spans[a:b]) for a, b in zip(cut[:-1], cut[1:])]
    arrays = [pa.array(np.full(len(blobs), kind, np.int32)), pa.array(bucket[cut[:-1]].astype(np.int32)), pa.array(blobs, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=names)


NAMES = ["kind", "bucket", "spans"]
SCHEMA = "kind int, bucket int, spans binary"


def find_spans(docs: DataFrame, window: int, inner: int, buckets: int) -> DataFrame:
    """Packed spans of all texts, dealt to buckets by key and signature; equal spans of
    one flush are told apart here."""

    def run(batches):
        anchors, held, size = Anchors(window, inner), [], 0

        def flush():
            first, again = first_spans(np.concatenate(held))
            place = (mix(first["key"] ^ mix(first["sign"])) % np.uint64(buckets)).astype(np.int64)
            yield _rows(SINGLE, place, first, NAMES)
            yield _rows(REPEAT, (again["sign"] % np.uint64(buckets)).astype(np.int64), again, NAMES)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, data, offsets in text_slices(batch.column(1)):
                for at in range(0, max(len(data), 1), PART_BYTES if len(offsets) == 2 else len(data) + 1):
                    if len(offsets) == 2:
                        part = data[at : at + PART_BYTES + window - 1]
                        offs = np.array([0, len(part)])
                    else:
                        part, offs = data, offsets
                    key, sign, r, start, n, mid = anchors.spans(part, offs)
                    s = np.empty(len(key), SPAN)
                    s["key"], s["sign"], s["doc"], s["start"], s["n"], s["mid"] = key, sign, ids[row + r], start + at, n, mid
                    held.append(s)
                    size += len(part)
                if size >= FLUSH_BYTES:
                    yield from (b for b in flush() if b is not None)
                    held, size = [], 0
        if held:
            yield from (b for b in flush() if b is not None)

    return docs.mapInArrow(run, SCHEMA)


def _by_bucket(batches, through: tuple[int, ...]):
    """(bucket, [(kind, packed spans)]) of a partition sorted by bucket; rows of the kinds
    ``through`` come alone, at once."""
    now, rows = None, []
    for batch in batches:
        for kind, bucket, raw in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if kind in through:
                yield None, [(kind, raw)]
                continue
            if bucket != now and rows:
                yield now, rows
                rows = []
            now = bucket
            rows.append((kind, raw))
    if rows:
        yield now, rows


def meet_equal(spans: DataFrame, buckets: int, many: int) -> DataFrame:
    """Equal spans of all tasks meet: later ones become repeats, the first go on, dealt by
    key.  A key of which this bucket alone holds a large part goes on as hot."""
    part = 2 * many // buckets + 64

    def run(batches):
        for _, rows in _by_bucket(batches, (REPEAT,)):
            for kind, raw in rows:
                if kind == REPEAT:
                    yield pa.RecordBatch.from_arrays([pa.array([REPEAT], pa.int32()), pa.array([0], pa.int32()), pa.array([raw], pa.binary())], names=NAMES)
            held = [unpack(raw) for kind, raw in rows if kind == SINGLE]
            if not held:
                continue
            first, again = first_spans(np.concatenate(held))
            place = (mix(first["key"]) % np.uint64(buckets)).astype(np.int64)
            _, group, count = np.unique(first["key"], return_inverse=True, return_counts=True)
            hot = count[group] > part
            marks = np.unique(first["key"][hot], return_index=True)[1]
            out = [
                _rows(REPEAT, np.zeros(len(again), np.int64), again, NAMES),
                _rows(SINGLE, place[~hot], first[~hot], NAMES),
                _rows(HOT, place[hot], first[hot], NAMES),
                _rows(CANDIDATE, place[hot][marks], first[hot][marks], NAMES),  # tells the key's bucket
            ]
            yield from (b for b in out if b is not None)

    return spans.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, SCHEMA)


def meet_keys(spans: DataFrame, many: int) -> DataFrame:
    """Spans of equal keys meet.  (kind, key, doc, start, n, mid): repeats, candidates of
    keys with two spans or more, and the spans of hot keys."""

    def table(kind, s):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(s), kind, np.int32)), *(pa.array(s[f].astype(np.int64)) for f in ("key", "doc", "start", "n", "mid"))],
            names=["kind", "key", "doc", "start", "n", "mid"],
        )

    def keyed(batches):
        for _, rows in _by_bucket(batches, (REPEAT, HOT)):
            held, marks = [], []
            for kind, raw in rows:
                if kind in (REPEAT, HOT):
                    yield table(kind, unpack(raw))
                elif kind == SINGLE:
                    held.append(unpack(raw))
                else:
                    marks.append(unpack(raw)["key"])
            if not held:
                continue
            s = np.concatenate(held)
            s = s[np.argsort(s["key"], kind="stable")]
            head = np.ones(len(s), bool)
            head[1:] = s["key"][1:] != s["key"][:-1]
            at = np.flatnonzero(head)
            count = np.diff(np.append(at, len(s)))[np.cumsum(head) - 1]
            hot = count > many
            if marks:
                hot |= np.isin(s["key"], np.concatenate(marks))
            yield table(HOT, s[hot])
            yield table(CANDIDATE, s[~hot & (count > 1)])

    spread = F.when(F.col("kind").isin(REPEAT, HOT), F.pmod(F.xxhash64("spans"), F.lit(1 << 20)) + 1).otherwise(0)
    return (
        spans.withColumn("side", spread.cast("int"))
        .repartition("bucket", "side")
        .sortWithinPartitions("bucket", "side")
        .select("kind", "bucket", "spans")
        .mapInArrow(keyed, "kind int, key long, doc long, start long, n long, mid long")
    )


def squeezed(docs: DataFrame) -> DataFrame:
    """(doc, n_bytes, body): texts compressed before they are shuffled."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            raw = [x.as_buffer() if x.is_valid else b"" for x in batch.column(1).cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(r) for r in raw], pa.int64()), pa.array([press.compress(r) for r in raw], pa.binary())],
                names=["doc", "n_bytes", "body"],
            )

    return docs.mapInArrow(run, "doc long, n_bytes long, body binary")


def fetch(spans: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """(key, doc, start, mid, body): the bytes of spans."""
    wanted = spans.groupBy("doc").agg(F.collect_list(F.struct("key", "start", "n", "mid")).alias("spans"))

    def run(batches):
        for batch in batches:
            docs_, bodies = batch.column(0).to_pylist(), batch.column(2)
            lists = batch.column(1)
            flat = lists.flatten()
            key, start, n, mid = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            at = 0
            out: list[list] = [[], [], [], [], []]
            press = zstandard.ZstdDecompressor()
            for doc, size, body in zip(docs_, sizes, bodies):
                text = press.decompress(body.as_buffer())
                for k in range(at, at + size):
                    out[4].append(text[start[k] : start[k] + n[k] - 1 + window])
                out[1].extend([doc] * int(size))
                at += int(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(out[1], pa.int64()), pa.array(start), pa.array(mid), pa.array(out[4], pa.binary())],
                names=["key", "doc", "start", "mid", "body"],
            )

    return wanted.join(squeezed(docs), "doc").select("doc", "spans", "body").mapInArrow(
        run, "key long, doc long, start long, mid long, body binary"
    )


def _flag_ranges(flags: np.ndarray, low: int, doc: np.ndarray, anchor: np.ndarray, window: int):
    """(doc, first byte, last byte + 1) of the runs of flagged windows of each string."""
    wide = np.zeros((flags.shape[0], flags.shape[1] + 2), np.int8)
    wide[:, 1:-1] = flags
    edge = np.diff(wide, axis=1)
    r, a = np.nonzero(edge == 1)
    _, b = np.nonzero(edge == -1)
    return doc[r], anchor[r] + low + a, anchor[r] + low + b - 1 + window


def merge_transforms(strings: DataFrame, window: int, shard_size: int) -> DataFrame:
    """(doc, low, high): byte ranges of repeated windows among strings of equal keys."""

    def solve(tables):
        t = pa.Table.from_batches(tables).combine_chunks()
        doc, start, mid = (t.column(k).to_numpy() for k in (1, 2, 3))
        body = t.column(4).combine_chunks()
        if isinstance(body, pa.ChunkedArray):
            body = body.chunk(0)
        offs = np.frombuffer(body.buffers()[1], np.int32)[body.offset : body.offset + len(body) + 1].astype(np.int64)
        data = np.frombuffer(body.buffers()[2], np.uint8)
        rank = np.empty(len(doc), np.int64)
        order = np.lexsort((start + mid, doc))
        later = (np.diff(doc[order]) != 0) | (np.diff((start + mid)[order]) != 0)  # repeated rows give equal ranks
        rank[order] = np.concatenate([[0], np.cumsum(later)])
        flags, low = repeated_windows(Strings(data, offs[:-1], np.diff(offs), mid), rank, window, shard_size)
        cols = _flag_ranges(flags, low, doc, start + mid, window)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=["doc", "low", "high"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            key = batch.column(0).to_numpy(zero_copy_only=False)
            # a batch may be cut after the last complete key only
            new = np.flatnonzero(key[1:] != key[:-1]) + 1
            if held and len(key) and held[-1].column(0)[-1].as_py() != key[0]:
                new = np.concatenate([[0], new])
            at = 0
            for cut in new:
                if n + cut - at >= BATCH_STRINGS:
                    if cut > at:
                        held.append(batch.slice(at, cut - at))
                    yield solve(held)
                    held, n, at = [], 0, int(cut)
            if at < len(key):
                held.append(batch.slice(at))
                n += len(key) - at
        if held:
            yield solve(held)

    return strings.repartition("key").sortWithinPartitions("key").mapInArrow(run, "doc long, low long, high long")


def compare_windows(strings: DataFrame, window: int) -> DataFrame:
    """(doc, low, high): repeated windows of hot keys, grouped by their 128-bit hash."""

    def run(batches):
        one, two = Roller(3), Roller(4)
        for batch in batches:
            doc, start = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            for row, data, offsets in text_slices(batch.column(4)):
                n = np.diff(offsets) - window + 1
                r = np.repeat(np.arange(len(n)), n)
                k = np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n)
                at = offsets[r] + k
                one.load(data)
                two.load(data)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one.ranges(at, at + window).view(np.int64)),
                        pa.array(two.ranges(at, at + window).view(np.int64)),
                        pa.array(doc[row + r]),
                        pa.array(start[row + r] + k),
                    ],
                    names=["h1", "h2", "doc", "start"],
                )

    found = cut_lineage(strings.mapInArrow(run, "h1 long, h2 long, doc long, start long"))
    first = found.groupBy("h1", "h2").agg(F.min(F.struct("doc", "start")).alias("x"), F.max(F.struct("doc", "start")).alias("y"))
    first = first.where("x <> y").select("h1", "h2", "x")
    return (
        found.join(first, ["h1", "h2"])
        .where(F.struct("doc", "start") != F.col("x"))
        .select("doc", F.col("start").alias("low"), (F.col("start") + window).alias("high"))
    )


def repeated_ranges(docs: DataFrame, window: int, inner: int, bucket_bytes: int, many: int, shard_size: int) -> DataFrame:
    """(doc, low, high): byte ranges to remove, not merged."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = max(1, -(-total // bucket_bytes))
    spans = cut_lineage(meet_keys(meet_equal(find_spans(docs, window, inner, buckets), buckets, many), many))
    repeats = spans.where(F.col("kind") == REPEAT).select(
        "doc", F.col("start").alias("low"), (F.col("start") + F.col("n") - 1 + window).alias("high")
    )
    merged = merge_transforms(fetch(spans.where(F.col("kind") == CANDIDATE), docs, window), window, shard_size)
    out = repeats.unionAll(merged)
    hot = spans.where(F.col("kind") == HOT)
    if not hot.isEmpty():
        out = out.unionAll(compare_windows(fetch(hot, docs, window), window))
    return out


def dedup_substrings(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 100,
    inner: int = 32,
    bucket_bytes: int = 8 << 20,
    many: int = 50_000,
    shard_size: int = 16_384,
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans (removed runs) and the bytes kept."""
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = repeated_ranges(own, window, inner, bucket_bytes, many, shard_size)
    lists = ranges.groupBy("doc").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))

    def run(batches):
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            removed, runs, kept = [], [], []
            for n, body, ranges_ in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                text = press.decompress(body.as_buffer()) if n else b""
                if not ranges_.is_valid or not n:
                    removed.append(0)
                    runs.append(0)
                    kept.append(text)
                    continue
                low, high = (ranges_.values.field(k).to_numpy(zero_copy_only=False) for k in range(2))
                order = np.argsort(low, kind="stable")
                low, top = low[order], np.minimum(np.maximum.accumulate(high[order]), n)
                new = np.ones(len(low), bool)
                new[1:] = low[1:] > top[:-1]
                a = low[new]
                b = top[np.append(np.flatnonzero(new)[1:], len(low)) - 1]
                removed.append(int((b - a).sum()))
                runs.append(len(a))
                kept.append(b"".join(text[i:j] for i, j in zip([0, *b.tolist()], [*a.tolist(), n])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    cut = squeezed(own).join(lists, "doc", "left").select("doc", "n_bytes", "body", "ranges")
    cut = cut.mapInArrow(run, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    named = F.when(F.col("doc") != LAST_ID, F.col("doc")).cast(kind).alias(id_col)
    return cut.select(named, "n_bytes", "n_removed", "n_spans", "kept")
