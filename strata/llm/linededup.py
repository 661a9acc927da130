"""Substring dedup by line hashing.

Units of a text are normalised to their words (runs of letters and digits,
lower-cased, one space between them) and stand for their MD5. Over the whole corpus the earliest unit of
each digest stays: the one with the smallest document id, then offset. All
others are removed, with their offsets in the original text on record.

A text is cut into atoms, at line breaks and after the ends of sentences. Units are

- lines and paragraphs (up to a line without words, whatever their line breaks) of
  ``MIN_WORDS`` words or more, and for each shorter line the fewest neighbouring
  short lines that reach ``MIN_WORDS`` words with it, once from it onward and once
  back from it;
- sentences of ``SENTENCE_WORDS`` words or more, whatever their line breaks, and for
  each shorter one the fewest neighbouring sentences that reach so many words from it
  onward.

So a passage that recurs inside longer lines, or with other line breaks, is covered by
units that recur, but for what is left of sentences at its ends; only shorter runs
(headings) are left alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm import textops
from strata.llm.tables import light, small_batches, staged, text_of

MIN_WORDS, SENTENCE_WORDS = 20, 12
#: Where an atom ends: a line break, or the end of a sentence with what closes it.
_END = re.compile(r"\n|[.!?\u2026\u3002\uff01\uff1f]+[\"')\]\u00bb\u201d\u2019]*(?=\s)")
_alnum = np.zeros(256, bool)
_alnum[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True  # of lower-cased text


def _windows(of: np.ndarray, words: np.ndarray, least: int, alone: np.ndarray, both: bool) -> tuple[np.ndarray, np.ndarray]:
    """Units of consecutive parts (with ``words`` each, 1 or more) in one group ``of``: first and last part of each.

    Parts of ``least`` words are units; for others the fewest neighbours that
    reach so many with it, onward and with ``both`` back, that don't cross a part which stands ``alone``.
    """
    n = len(words)
    each = np.arange(n)
    sums = np.concatenate([[0], np.cumsum(words)])
    long = words >= least
    change = np.ones(n, bool)
    change[1:] = (of[1:] != of[:-1]) | alone[1:] | alone[:-1]
    firsts = np.flatnonzero(change)
    number = np.cumsum(change) - 1
    first, end = firsts[number], np.append(firsts[1:], n)[number]
    onward = np.searchsorted(sums, sums[:-1] + least)  # ends after the first parts that reach the words
    some = ~long & (onward <= end)
    if not both:
        return np.concatenate([each[long], each[some]]), np.concatenate([each[long], onward[some] - 1])
    back = np.searchsorted(sums, sums[1:] - least, "right") - 1
    more = ~long & (back >= first)
    return np.concatenate([each[long], each[some], back[more]]), np.concatenate([each[long], onward[some] - 1, each[more]])


def _grouped(new: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last atom and words of each group, from the atoms where one begins."""
    firsts = np.flatnonzero(new)
    return firsts, np.append(firsts[1:], len(new)) - 1, np.add.reduceat(words, firsts) if len(firsts) else np.zeros(0, np.int64)


def _units(of: np.ndarray, words: np.ndarray, line_end: np.ndarray, sentence_end: np.ndarray, min_words: int, sentence_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last atom of every unit, from each atom's text, number of words, and whether a line or sentence ends with it."""
    if not len(of):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.ones(len(of), bool)
    text[1:] = of[1:] != of[:-1]
    new_line = text.copy()
    new_line[1:] |= line_end[:-1]
    first, last, size = _grouped(new_line, words)
    full = np.flatnonzero(size)  # a unit begins and ends in a line with words
    blank = np.diff(full, prepend=-1) > 1
    line_of, line_words = of[first[full]], size[full]
    lo, hi = _windows(line_of, line_words, min_words, line_words >= min_words, True)
    found = [(first[full[lo]], last[full[hi]])]
    if len(full):  # paragraphs
        change = blank | np.concatenate([[True], line_of[1:] != line_of[:-1]])
        top, bottom, total = _grouped(change, line_words)
        some = total >= min_words
        found.append((first[full[top[some]]], last[full[bottom[some]]]))
    # sentences end with their last atom, before a line without words, and with their text
    empty = np.repeat(size == 0, last - first + 1)
    new = text.copy()
    new[1:] |= sentence_end[:-1] | empty[1:] | empty[:-1]
    first, last, size = _grouped(new, words)
    full = np.flatnonzero(size)
    lo, hi = _windows(of[first[full]], size[full], sentence_words, np.zeros(len(full), bool), False)
    found.append((first[full[lo]], last[full[hi]]))
    top, bottom = (np.concatenate(x) for x in zip(*found, strict=True))
    while True:  # units begin and end with an atom that has words
        lead, trail = (words[top] == 0) & (top < bottom), (words[bottom] == 0) & (top < bottom)
        if not lead.any() and not trail.any():
            break
        top, bottom = top + lead, bottom - (trail & ~(lead & (top + 1 == bottom)))
    both = np.unique(top * len(of) + bottom)
    return both // len(of), both % len(of)


def _atoms(text: str) -> tuple[list[int], list[int], list[bool], list[bool]]:
    """Starts, ends (before a line break), and which end a line or a sentence."""
    starts, ends, lines, sentences, at = [], [], [], [], 0
    for m in _END.finditer(text):
        line = m[0] == "\n"
        starts.append(at)
        ends.append(m.start() if line else m.end())
        lines.append(line)
        sentences.append(not line)
        at = m.end()
    starts.append(at)
    ends.append(len(text))
    lines.append(True)
    sentences.append(False)
    return starts, ends, lines, sentences


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, bytes, np.ndarray, np.ndarray]:
    """Words of lower-cased strings: the words before each string, and all words with a space after each, with their places."""
    raw, at = textops.utf8(column)
    word = _alnum[raw]
    head = word.copy()
    head[1:] &= ~word[:-1]
    inner = at[(at > 0) & (at < len(raw))]
    head[inner] = word[inner]
    starts = np.flatnonzero(head)
    before = np.searchsorted(starts, at)
    del head
    letters = np.concatenate([[0], np.cumsum(word)]).astype(np.int64)
    tail = np.append(starts[1:], len(raw))
    lo = letters[starts] + np.arange(len(starts))  # a space for each word before
    hi = letters[tail] + np.arange(len(starts))
    out = np.full(int(letters[-1]) + len(starts), 0x20, np.uint8)
    number = np.searchsorted(starts, np.flatnonzero(word), "right") - 1
    out[np.arange(len(number)) + number] = raw[word]
    return before, at, out.tobytes(), lo, hi


def _unit_batches(min_words: int, sentence_words: int):
    """For mapInArrow over (row, doc_id, key, text): one row for each unit, offsets in code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in textops.slices(batch.column(3)):
                part = batch.slice(rows.start, rows.stop - rows.start)
                of, begin, stop, line, sentence, atoms = [], [], [], [], [], []
                for i, text in enumerate(part.column(3).to_pylist()):
                    starts, ends, lines, sentences = _atoms(text or "")
                    of += [i] * len(starts)
                    begin += starts
                    stop += ends
                    line += lines
                    sentence += sentences
                    atoms += [text[a:b] for a, b in zip(starts, ends, strict=True)] if text else [""]
                before, _, words, lo, hi = _words(pc.utf8_lower(pa.array(atoms, pa.string())))
                of, begin, stop = np.array(of), np.array(begin), np.array(stop)
                top, last = _units(of, np.diff(before), np.array(line), np.array(sentence), min_words, sentence_words)
                first_word, last_word = before[:-1][top], before[1:][last] - 1
                digests = [hashlib.md5(words[a:b], usedforsecurity=False).digest() for a, b in zip(lo[first_word].tolist(), hi[last_word].tolist(), strict=True)]
                which = pa.array(of[top], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(c.take(which) for c in part.columns[:3]), pa.array(begin[top], pa.int64()), pa.array(stop[last], pa.int64()), pa.array(digests, pa.binary())],
                    names=["row", "doc_id", "key", "start", "end", "unit"],
                )

    return run


def repeated(docs: DataFrame, min_words: int = MIN_WORDS, sentence_words: int = SENTENCE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Units to remove: ``doc_id``, ``key`` (a hash of the text), ``row`` (a number of the input row), ``start``, ``end``.

    Offsets are code points, ends exclusive, without the line break. Units
    may overlap; one that overlaps the earliest of its digest stays with it. Null and empty texts have no lines to remove; a null id ranks after all others;
    repeated rows are documents of their own, of which one ranks first. Further
    columns aren't read; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    part = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("key"), text_of(text_col).alias("text"))
    fields = "row long, doc_id long, key long, start long, end long, unit binary"
    lines = staged(part.mapInArrow(_unit_batches(min_words, sentence_words), fields), "lines")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "start", "end")
    first = lines.groupBy("unit").agg(F.min(rank).alias("first"), F.count("*").alias("n")).where("n > 1")
    first = first.select("unit", F.col("first.row").alias("first_row"), F.col("first.end").alias("first_end"))
    again = lines.join(first, "unit").where("row <> first_row OR start >= first_end")
    return again.select("doc_id", "key", "row", "start", "end")


def _pieces(spans: list[tuple[int, int]], text: str) -> list[tuple[int, int]]:
    """What sorted units cover, parted at line breaks: each line, or part of one, once."""
    merged: list[list[int]] = []
    for lo, hi in spans:
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    out = []
    for lo, hi in merged:
        while (end := text.find("\n", lo, hi)) >= 0:
            out.append((lo, end))
            lo = end + 1
        out.append((lo, hi))
    return out


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, starts, ends, text) with sorted units: the pieces they cover, what is left, and its digest."""
    for batch in batches:
        left, shas, all_starts, all_ends = [], [], [], []
        for starts, ends, text in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
            at, out = 0, []
            pieces = _pieces(list(zip(starts, ends, strict=True)), text)
            for lo, hi in pieces:
                out.append(text[at:lo])
                whole = (lo == 0 or text[lo - 1] == "\n") and text[hi : hi + 1] == "\n"
                at = hi + whole  # the line break goes with a whole line
            out.append(text[at:])
            left.append("".join(out))
            shas.append(hashlib.sha256(left[-1].encode()).hexdigest())
            all_starts.append([lo for lo, _ in pieces])
            all_ends.append([hi for _, hi in pieces])
        ints = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(all_starts, ints), pa.array(all_ends, ints), pa.array(left, pa.string()), pa.array(shas, pa.string())], names=["doc_id", "starts", "ends", "left", "kept_sha256"])


def remove(docs: DataFrame, min_words: int = MIN_WORDS, sentence_words: int = SENTENCE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents that lose units: ``doc_id``, ``starts`` and ``ends`` of the removed lines and parts of lines, ``left`` (the remaining text), ``kept_sha256``.

    A document's own units meet in one row; texts meet them by id and
    text hash, so repeated rows come out once for each (its spans by row).
    """
    gone = repeated(docs, min_words, sentence_words, id_col, text_col)
    spans = gone.groupBy("row", "doc_id", "key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("x"))
    spans = staged(spans.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("x.start").alias("starts"), F.col("x.end").alias("ends")), "line-spans")
    spans = light(spans, F.size("starts"))
    part = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(text_of(text_col)).alias("key"), text_of(text_col).alias("text"))
    texts = part.join(spans, part.doc_id.eqNullSafe(F.col("d")) & (part.key == F.col("k")), "left_semi").dropDuplicates(["doc_id", "key"])
    both = texts.join(spans, texts.doc_id.eqNullSafe(F.col("d")) & (texts.key == F.col("k"))).select("doc_id", "starts", "ends", "text")
    return both.mapInArrow(_cut_batches, "doc_id long, starts array<long>, ends array<long>, left string, kept_sha256 string")


def report(docs: DataFrame, min_words: int = MIN_WORDS, sentence_words: int = SENTENCE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document that loses units: ``doc_id``, ``n_removed`` lines and parts of lines, ``spans`` (``start:end`` joined by commas), ``kept_sha256``."""
    found = remove(docs, min_words, sentence_words, id_col, text_col)
    spans = F.array_join(F.transform(F.arrays_zip("starts", "ends"), lambda x: F.concat_ws(":", x["starts"], x["ends"])), ",")
    return found.select("doc_id", F.size("starts").cast("long").alias("n_removed"), spans.alias("spans"), "kept_sha256")
