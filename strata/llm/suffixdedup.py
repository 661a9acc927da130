"""Suffix-array dedup of exact byte strings.

Removes every byte that lies in a string of ``length`` bytes which also starts
anywhere else in the corpus.

Anchors. Of the hashes of all ``GRAM``-byte grams in a string of that length, the
smallest (leftmost) is the string's anchor. Equal strings have the same anchor
at the same offset, so only strings around equal grams can be equal. A string
that starts ``d`` bytes before its anchor has ``d`` bytes to the anchor's left and
``length - d`` from the anchor on; one anchor serves a run of starts. Grams are
counted over the corpus, and anchors whose gram occurs once are done.

Suffix order. The contexts of the other anchors meet by gram. What lies right of
the anchors, and in reverse what lies left of them, is written as sequences of
blocks (numbered in byte order), and ``gsaca.suffix_array`` sorts their
suffixes. Contexts that agree on n bytes are then neighbours whose common
prefixes all have n bytes or more. So for every ``d``, a cut of the right order at
``length - d`` and of the left order at ``d`` numbers the strings, and a number
that is held twice is a repeat.

Copies. Of documents with the same text (by 128-bit digest) one is worked on,
and counts twice. Contexts of a gram in more than ``HOT`` documents are cut to what
the strings of a run cover. Equal ones (by 128-bit digest) repeat each other in whole, so they
are done, and one of them stands for all: they are folded in the task that finds them, then in
sorted order in ``SALTS`` parts of each context, then what is left of the parts. If more than ``HOT`` different ones
are left, they part by the range of d: the strings of either half of it share
more than the gram (what lies between the last start and the first end), which is
the key that they meet by from then on. Halving ends with single strings, of which
different ones have different keys. No row stands for less than a run of strings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textops
from strata.llm.gsaca import suffix_array
from strata.llm.tables import SMALL, light, small_batches, staged, text_of

GRAM = 64
#: Different contexts that meet in one task for one gram.
HOT = 4096
#: Parts in which the runs of one context are folded first.
SALTS = 64
#: Runs of strings judged in one go; a task goes through its contexts in such parts.
PART = 20_000
#: 2**MAP_BITS bits (16 MB) tell the scan which grams may be repeated; with more repeated grams than MAP_GRAMS they meet in a join instead.
MAP_BITS, MAP_GRAMS = 27, 1 << 24
_BLOCK = 40  # bytes of a block


def _pieces(raw: np.ndarray, at: np.ndarray, length: int, limit: int = textops.BLOCK // 2):
    """Texts of a batch in groups of about ``limit`` bytes; longer texts in pieces that overlap by a string less a byte."""
    rows, parts, size = [], [], 0
    for row, (lo, hi) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        for base in range(lo, max(lo + 1, hi - length + 1), limit):
            if hi - base >= length:
                part = raw[base : min(hi, base + limit + length - 1)]
                rows.append((row, base - lo, len(part)))
                parts.append(part)
                size += len(part)
                if size >= limit:
                    yield rows, np.concatenate(parts)
                    rows, parts, size = [], [], 0
    if parts:
        yield rows, np.concatenate(parts)


def anchors(raw: np.ndarray, at: np.ndarray, length: int, gram: int):
    """Arrays (row, gram hash, place in its text, least d, greatest d) of all anchors of a batch's texts."""
    out = []
    width = length - gram + 1
    for rows, data in _pieces(raw, at, length):
        n = len(data) - gram + 1
        begin = np.arange(n)
        hashes = textops.rolling_hashes(textops.mix(data.astype(np.uint64) + np.uint64(7)), begin, begin + gram)
        packed = (hashes & ~np.uint64((1 << 23) - 1)) | begin.astype(np.uint64)  # pieces have fewer bytes than 2**23
        fill = -n % width
        grid = np.concatenate([packed, np.full(fill + width, ~np.uint64(0))]).reshape(-1, width)
        ahead = np.minimum.accumulate(grid, 1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
        starts = np.arange(n - width + 1)
        anchor = (np.minimum(behind[starts], ahead[starts + width - 1]) & np.uint64((1 << 23) - 1)).astype(np.int64)
        sizes = np.array([x[2] for x in rows])
        ends = np.cumsum(sizes)
        piece = np.searchsorted(ends, starts, "right")
        inside = starts + length <= ends[piece]
        starts, anchor, piece = starts[inside], anchor[inside], piece[inside]
        new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])])[: len(anchor)])
        last = np.append(new[1:], len(anchor)) - 1
        if not len(new):
            continue
        a, p = anchor[new], piece[new]
        shift = np.array([x[1] for x in rows]) - (ends - sizes)
        out.append((np.array([x[0] for x in rows])[p], hashes[a], a + shift[p], a - starts[last], a - starts[new]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _gram_batches(length: int, gram: int):
    """For mapInArrow over texts: the gram of every anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in textops.slices(batch.column(0)):
                found = anchors(*textops.utf8(batch.column(0)[rows]), length, gram)
                yield pa.RecordBatch.from_arrays([pa.array(found[1].view(np.int64))], names=["gram"])

    return run


def _context_batches(length: int, gram: int, bits):
    """For mapInArrow over (digest, many, text): one row for each distinct context of a gram in a text.

    left: up to ``length - gram`` bytes before the anchor; right: up to
    ``length`` bytes from it on; runs: place << 16 | least d << 8 | greatest d.
    """
    reach = length - gram
    low, high = np.uint64((1 << MAP_BITS) - 1), np.uint64(64 - MAP_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if bits is None else np.frombuffer(bits.value, np.uint8)

        def marked(x: np.ndarray) -> np.ndarray:
            return (table[x >> np.uint64(3)] >> (x & np.uint64(7)).astype(np.uint8)) & 1 == 1

        for batch in batches:
            for rows in textops.slices(batch.column(2)):
                part = batch.slice(rows.start, rows.stop - rows.start)
                raw, at = textops.utf8(part.column(2))
                row, key, place, least, most = anchors(raw, at, length, gram)
                if table is not None:
                    keep = marked(key & low) & marked(key >> high)
                    row, key, place, least, most = (x[keep] for x in (row, key, place, least, most))
                data = raw.tobytes()
                merged: dict[tuple, list[int]] = {}
                for r, k, p, a, b in zip(row.tolist(), key.view(np.int64).tolist(), place.tolist(), least.tolist(), most.tolist(), strict=True):
                    lo, hi, x = int(at[r]), int(at[r + 1]), int(at[r]) + p
                    merged.setdefault((r, k, data[max(lo, x - reach) : x], data[x : min(hi, x + length)]), []).append(p << 16 | a << 8 | b)
                found = list(merged)
                keep = part.take(pa.array([x[0] for x in found], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*keep.columns[:2], pa.array([x[1] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.binary()), pa.array([x[3] for x in found], pa.binary()), pa.array(list(merged.values()), pa.list_(pa.int64()))],
                    names=["digest", "many", "gram", "left", "right", "runs"],
                )

    return run


def _classes(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct byte strings: the text each is, their suffix order, and the bytes that neighbours in it share."""
    distinct = {t: i for i, t in enumerate(dict.fromkeys(texts))}
    which = np.array([distinct[t] for t in texts])
    blocks = -(-size // _BLOCK)
    table = np.zeros((len(distinct), blocks * _BLOCK), np.uint8)
    lengths = np.array([len(t) for t in distinct])
    table[np.arange(table.shape[1])[None] < lengths[:, None]] = np.frombuffer(b"".join(distinct), np.uint8) + 1  # UTF-8 has no byte 255; 0 is past the end
    names = np.unique(table.view(f"S{_BLOCK}").ravel(), return_inverse=True)[1].reshape(-1, blocks) + 1
    sequence = np.zeros((len(distinct), blocks + 1), np.int64)  # 0 ends each sequence
    sequence[:, :-1] = names
    order = suffix_array(sequence.ravel())
    order = order[order % (blocks + 1) == 0] // (blocks + 1)
    differ = table[order[1:]] != table[order[:-1]]
    shared = np.where(differ.any(1), differ.argmax(1), table.shape[1])
    return which, order, shared


def repeats(left: list[bytes], right: list[bytes], least: np.ndarray, most: np.ndarray, weight: np.ndarray, context: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Of every run (of a context): a table of whether the string at each d is repeated."""
    which_r, order_r, shared_r = _classes(right, length)
    which_l, order_l, shared_l = _classes([x[::-1] for x in left], length - gram)
    rank_r, rank_l = np.empty_like(order_r), np.empty_like(order_l)
    rank_r[order_r], rank_l[order_l] = np.arange(len(order_r)), np.arange(len(order_l))
    place_r, place_l = rank_r[which_r][context], rank_l[which_l][context]
    out = np.zeros((len(context), length - gram + 1), bool)
    for d in range(length - gram + 1):
        some = np.flatnonzero((least <= d) & (d <= most))
        if not len(some):
            continue
        cut_r = np.concatenate([[0], np.cumsum(shared_r < length - d)])
        cut_l = np.concatenate([[0], np.cumsum(shared_l < d)])
        number = cut_r[place_r[some]] * (len(order_l) + 1) + cut_l[place_l[some]]
        _, number = np.unique(number, return_inverse=True)
        out[some, d] = np.bincount(number, weight[some])[number] > 1
    return out


def _spans(rows: np.ndarray, place: np.ndarray, repeated: np.ndarray, length: int):
    """(row, start, end) of the repeated strings of each run, those at neighbouring d as one."""
    padded = np.zeros((len(repeated), repeated.shape[1] + 2), np.int8)
    padded[:, 1:-1] = repeated
    step = np.diff(padded, axis=1)
    run, first = np.nonzero(step == 1)
    _, stop = np.nonzero(step == -1)  # d runs from first to stop - 1
    return rows[run], place[run] - (stop - 1), place[run] - first + length


def _repeat_batches(length: int, gram: int):
    """For mapInArrow over contexts sorted by gram: (digest, start, end) of repeated strings."""

    def flush(held: list[tuple]) -> pa.RecordBatch:
        digests = np.array([x[0] for x in held], object)
        runs = [x[5] for x in held]
        context = np.repeat(np.arange(len(held)), [len(r) for r in runs])
        packed = np.array([p for r in runs for p in r], np.int64)
        least, most = (packed >> 8) & 255, packed & 255
        weight = np.array([2 if x[1] else 1 for x in held])[context]
        found = repeats([x[3] for x in held], [x[4] for x in held], least, most, weight, context, length, gram)
        row, start, end = _spans(context, packed >> 16, found, length)
        return pa.RecordBatch.from_arrays([pa.array(digests[row], pa.binary()), pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["digest", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        group: list[tuple] = []  # contexts of the gram at hand
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and group[0][2] != row[2]:
                    if len(group) > 1 or group[0][1] or len(group[0][5]) > 1:
                        held += group
                        size += sum(len(x[5]) for x in group)
                    group = []
                    if size >= PART:
                        yield flush(held)
                        held, size = [], 0
                group.append(row)
        held += group
        if held:
            yield flush(held)

    return run


_PART = "digest binary, many boolean, gram long, left binary, right binary, place long, a int, b int, lo int, hi int, ctx binary"


_FOLDED = _PART + ", start long, end long"


def _context(key: int, left: bytes, right: bytes, a: int, b: int) -> bytes:
    """Digest of what the strings of a run cover."""
    return hashlib.md5(b"%d %d %d " % (a, b, len(left)) + left + right, usedforsecurity=False).digest()


def _folded_rows(kept: list[tuple], runs: list[tuple], length: int) -> pa.RecordBatch:
    """Runs that stand for their contexts, and apart from them the spans of repeated runs, those of a text that meet as one."""
    spans: list[list] = []
    for digest, start, end in sorted((x[0], x[5] - x[7], x[5] - x[6] + length) for x in runs):
        if spans and spans[-1][0] == digest and start <= spans[-1][2]:
            spans[-1][2] = max(spans[-1][2], end)
        else:
            spans.append([digest, start, end])
    rows = [(*x, None, None) for x in kept] + [(x[0], *[None] * 10, *x[1:]) for x in spans]
    kinds = [pa.binary(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), *[pa.int32()] * 4, pa.binary(), pa.int64(), pa.int64()]
    columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _FOLDED.split(", ")])


def _run_batches(length: int, gram: int):
    """For mapInArrow over contexts: a row for each run, cut to what its strings cover, but one for equal ones met in a task, and spans.

    Runs of copied texts, and all of a context met twice, give their spans; the run
    that stands for them is ``many``, which from here on tells that its span is out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            spans = []
            for digest, many, key, left, right, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for packed in runs:
                    a, b = (packed >> 8) & 255, packed & 255
                    before, after = left[len(left) - b :], right[: length - a]
                    ctx = _context(key, before, after, a, b)
                    row = (digest, many, key, before, after, packed >> 16, a, b, 0, length - gram, ctx)
                    first = held.setdefault((key, ctx), row)
                    if first is not row:
                        spans.append(row)
                        if not first[1]:
                            spans.append(first)
                            held[key, ctx] = (first[0], True, *first[2:])
                    elif many:
                        spans.append(row)
            full = len(held) >= PART
            yield _folded_rows(list(held.values()) if full else [], spans, length)
            if full:
                held = {}
        yield _folded_rows(list(held.values()), [], length)

    return run


def _half_batches(length: int):
    """For mapInArrow over runs (digest, many, key, left, right, place, a, b, lo, hi): their parts in either half of lo to hi, by what all strings there share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for digest, many, key, left, right, place, a, b, lo, hi in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                middle = (lo + hi + 1) // 2
                for least, most in ((lo, middle - 1), (middle, hi)):
                    x, y = max(a, least), min(b, most)
                    if x <= y:
                        shared = b"%d %d %d " % (key, least, most) + left[len(left) - least :] + right[: length - most]
                        own = int.from_bytes(hashlib.md5(shared, usedforsecurity=False).digest()[:8], "little", signed=True)
                        before, after = left[len(left) - y :], right[: length - x]
                        rows.append((digest, many, own, before, after, place, x, y, least, most, _context(own, before, after, x, y)))
            columns = zip(*rows, strict=True) if rows else [()] * 11
            kinds = (pa.binary(), pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), *[pa.int32()] * 4, pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in _PART.split(", ")])

    return run


def _fold_batches(length: int):
    """For mapInArrow over runs sorted by gram and ctx: one run of each context, and the spans of those that another run shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # stands for the context at hand
        for batch in batches:
            kept, spans = [], []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is not None and held[2] == row[2] and held[10] == row[10]:
                    if not held[1]:
                        spans.append(held)
                        held = (held[0], True, *held[2:])
                    if not row[1]:
                        spans.append(row)
                else:
                    if held is not None:
                        kept.append(held)
                    held = row
            yield _folded_rows(kept, spans, length)
        if held is not None:
            yield _folded_rows([held], [], length)

    return run


def _settled(runs: DataFrame, length: int, gram: int) -> DataFrame:
    """(digest, start, end) of repeated strings among folded runs of hot grams."""
    columns = [x.split()[0] for x in _PART.split(", ")]
    salt = F.pmod(F.xxhash64("digest", "place"), F.lit(SALTS))

    def folded(some: DataFrame, *keys) -> DataFrame:
        order = some.select(*columns).repartition("gram", "ctx", *keys).sortWithinPartitions("gram", "ctx", "digest", "place")
        return staged(order.mapInArrow(_fold_batches(length), _FOLDED), "contexts-of-runs")

    runs = staged(runs, "runs")
    out = [runs.where("gram IS NULL").select("digest", "start", "end")]
    while True:
        parts = folded(runs.where("gram IS NOT NULL"), salt)
        whole = folded(parts.where("gram IS NOT NULL"))
        out += [x.where("gram IS NULL").select("digest", "start", "end") for x in (parts, whole)]
        one = whole.where("gram IS NOT NULL").select(*columns)
        sizes = staged(one.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "context-counts")  # of one context nothing is left to compare
        few = one.join(sizes.where(F.col("n") <= HOT).select("gram"), "gram", "left_semi")
        packed = F.array(F.shiftleft("place", 16).bitwiseOR(F.shiftleft(F.col("a").cast("long"), 8)).bitwiseOR(F.col("b").cast("long")))
        few = few.select("digest", "many", "gram", "left", "right", packed.alias("runs"))
        out.append(few.repartition("gram").sortWithinPartitions("gram").mapInArrow(_repeat_batches(length, gram), "digest binary, start long, end long"))
        many = sizes.where(F.col("n") > HOT).select("gram")
        if many.isEmpty():
            return reduce(DataFrame.union, out)
        runs = one.join(many, "gram", "left_semi").select(*columns[:-1]).mapInArrow(_half_batches(length), _PART)


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, spans, text): what is removed, and the digest of the rest."""
    for batch in batches:
        removed, count, shas = [], [], []
        for spans, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            data, at, gone, runs, kept = text.encode(), 0, 0, 0, hashlib.sha256()
            lo = hi = -1
            for start, end in [*sorted((s["start"], s["end"]) for s in spans), (len(data) + 1, len(data) + 1)]:
                if start > hi:
                    if hi >= 0:
                        kept.update(data[at:lo])
                        at, gone, runs = hi, gone + hi - lo, runs + 1
                    lo, hi = start, end
                else:
                    hi = max(hi, end)
            kept.update(data[at:])
            removed.append(gone)
            count.append(runs)
            shas.append(kept.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(shas, pa.string())], names=["digest", "n_removed", "n_spans", "kept_sha256"])


def spans(docs: DataFrame, digest: str = "digest", text: str = "text", length: int = 200, gram: int = GRAM) -> DataFrame:
    """(digest, start, end) of repeated strings, in bytes; they overlap. ``docs``: digest, many, text, one row a text."""
    grams = docs.select(text).mapInArrow(_gram_batches(length, gram), "gram long")
    weigh = docs.where("many").select(text).mapInArrow(_gram_batches(length, gram), "gram long")  # texts with copies count twice
    counted = staged(grams.union(weigh).groupBy("gram").agg(F.count("*").alias("n")).where("n > 1"), "grams")
    shared = None
    if counted.count() <= MAP_GRAMS:
        bits = counted.select(F.explode(F.array(F.col("gram").bitwiseAND((1 << MAP_BITS) - 1), F.shiftrightunsigned("gram", 64 - MAP_BITS))).alias("b"))
        words = bits.select(F.shiftright("b", 5).cast("int").alias("w"), F.expr("shiftleft(1L, CAST(b & 31 AS INT))").alias("m"))
        table = np.zeros(1 << (MAP_BITS - 5), np.uint32)
        for part in words.groupBy("w").agg(F.bit_or("m").alias("m")).toArrow().to_batches():
            table[part.column(0).to_numpy()] = part.column(1).to_numpy().astype(np.uint32)
        shared = docs.sparkSession.sparkContext.broadcast(table.astype("<u4").tobytes())
    fields = "digest binary, many boolean, gram long, left binary, right binary, runs array<long>"
    contexts = docs.select(digest, "many", text).mapInArrow(_context_batches(length, gram, shared), fields)
    if shared is None:
        contexts = contexts.join(counted.select("gram"), "gram", "left_semi").select("digest", "many", "gram", "left", "right", "runs")
    contexts = staged(contexts, "contexts")  # read twice below
    hot = light(staged(counted.where(F.col("n") > HOT).select("gram"), "hot-grams"), rows=SMALL)
    each = contexts.join(hot, "gram", "left_anti").select("digest", "many", "gram", "left", "right", "runs")
    found = each.repartition("gram").sortWithinPartitions("gram").mapInArrow(_repeat_batches(length, gram), "digest binary, start long, end long")
    split = contexts.join(hot, "gram", "left_semi").select("digest", "many", "gram", "left", "right", "runs")
    if hot.isEmpty():
        return found
    return found.union(_settled(split.mapInArrow(_run_batches(length, gram), _FOLDED), length, gram))


def dedup(docs: DataFrame, length: int = 200, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What is left of every text without its repeated strings of ``length`` bytes.

    Returns one row per input row: ``id_col``, ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs) and ``kept_sha256`` of the remaining
    bytes. Strings are judged on the input; they may overlap, and repeat within
    one document; they never cross documents. A null text counts as empty, and
    texts shorter than ``length`` lose nothing. Repeated rows are documents of
    their own, so all their strings are repeats. Further columns aren't read; an
    empty table gives no rows.
    """
    if not gram < length <= gram + 255:
        raise ValueError("a string must be longer than a gram, by 255 bytes at most")
    small_batches(docs.sparkSession)
    part = docs.select(docs[id_col].alias("id"), text_of(text_col).alias("text")).select("id", "text", F.unhex(F.md5("text")).alias("digest"))
    rows = staged(part.select("id", "digest", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "texts")
    copies = rows.where(F.col("n_bytes") >= length).groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1")
    copies = light(staged(copies.select(F.col("digest").alias("copied"), "first"), "copies"), rows=SMALL)
    one = part.join(copies, F.col("digest") == F.col("copied"), "left").where(F.col("copied").isNull() | F.col("id").eqNullSafe(F.col("first")))
    one = one.select("digest", F.col("copied").isNotNull().alias("many"), "text")
    found = spans(one, length=length, gram=gram)
    by_text = staged(found.groupBy("digest").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans")  # of one text
    # spans grow with the texts, so both are shuffled whatever their size; the spans make the hash table, texts aren't sorted
    texts = one.select("digest", "text").join(by_text.hint("shuffle_hash"), "digest").select("digest", "spans", "text")
    cut = texts.mapInArrow(_cut_batches, "digest binary, n_removed long, n_spans long, kept_sha256 string").dropDuplicates(["digest"])
    out = rows.join(cut, "digest", "left")
    zero = F.lit(0).cast("long")
    return out.select(F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
