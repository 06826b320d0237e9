"""Substring dedup: exact repeats of runs of words, found by super-k-mers.

Every window of ``window`` words has a minimiser: its lowest-ranked run of ``mini`` words. Neighbouring windows with
the same minimiser travel as one packed string of words to the minimiser's bucket, so a window costs a fraction of its
length, and equal windows meet wherever they come from. In a bucket all windows are sorted by content and place; all
but the first of equals are repeats. Words that repeats cover are removed.

Ranks are random but for very frequent runs (found by counting all runs of words in a sketch of fixed size), which come
last. A passage that many documents share is therefore not gathered in one bucket together with everything around
it. Equal strings of a task, told by 128-bit cryptographic digests, are merged before they travel: only the first goes, the
others are repeats already, so a passage in a third of all documents reaches its bucket once a task. In a bucket, equal
windows are compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from maintlake.llm.bloom import possible
from maintlake.llm.shared import NULL_ID, known_id, require, saved
from maintlake.llm.textops import U, Words, digests, find_words, run_codes, text_blocks

SKETCH_BITS = 16
#: Longest string of windows, and the packed bytes that a task gathers before it merges and sends them.
MAX_WINDOWS, GATHER_BYTES = 256, 32 << 20
_REPEAT = "doc_id long, text_key long, start long, n long"


def keyed(docs: DataFrame) -> DataFrame:
    """What places are told by: the id (null: last) and a key of the text, since ids may repeat."""
    return docs.select(
        known_id().alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text"
    )


def frequent_runs(docs: DataFrame, mini: int, times: float = 8.0) -> np.ndarray:
    """Which cells of a sketch of all runs of ``mini`` words hold over ``times`` the mean: at most 1/times of them."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                runs, inside = _runs(find_words(data, offsets), mini)
                total += np.bincount((runs[inside] >> U(64 - SKETCH_BITS)).astype(np.int64), minlength=total.size)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], names=["cell", "n"])

    counts = docs.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    counts = saved(counts)
    mean = counts.agg(F.sum("n") / (1 << SKETCH_BITS)).alias("mean")
    often = np.zeros(1 << SKETCH_BITS, bool)
    often[[r["cell"] for r in counts.filter(F.col("n") > F.lit(times) * mean.scalar()).select("cell").collect()]] = True
    return often


def _runs(words: Words, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of runs of ``length`` words by first word, and which runs stay inside one text."""
    runs = run_codes(words.hashes(), length)
    last = np.repeat(words.first[1:], words.counts)[: runs.size]
    return runs, np.arange(runs.size) + length <= last


def least_ahead(values: np.ndarray, span: int) -> np.ndarray:
    """The least of each value and the ``span - 1`` after it, by doubling."""
    size = values.size - span + 1
    low, step = values, 1
    while step * 2 <= span:
        low = np.minimum(low[: low.size - step], low[step:])
        step *= 2
    return np.minimum(low[:size], low[span - step : span - step + size])


def strings_of(words: Words, window: int, mini: int, often: np.ndarray):
    """First word, number of windows and minimiser of each string of windows of the texts in ``words``."""
    empty = np.zeros(0, np.int64)
    if words.starts.size < window:
        return empty, empty, np.zeros(0, U)
    runs, _ = _runs(words, mini)
    rank = (runs >> U(1)) | (often[(runs >> U(64 - SKETCH_BITS)).astype(np.int64)].astype(U) << U(63))
    least = least_ahead(rank, window - mini + 1)
    last = np.repeat(words.first[1:], words.counts)[: least.size]
    at = np.flatnonzero(np.arange(least.size) + window <= last)
    if not at.size:
        return empty, empty, np.zeros(0, U)
    mine = least[at]
    fresh = np.ones(at.size, bool)
    fresh[1:] = (at[1:] != at[:-1] + 1) | (mine[1:] != mine[:-1]) | (words.owner[at[1:]] != words.owner[at[:-1]])
    begin = np.flatnonzero(fresh)
    size = np.diff(np.append(begin, at.size))
    # cut very long strings (periodic texts), at equal distances from their beginnings
    cuts = (size + MAX_WINDOWS - 1) // MAX_WINDOWS
    nth = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    begin, size = np.repeat(begin, cuts) + nth * MAX_WINDOWS, np.repeat(size, cuts) - nth * MAX_WINDOWS
    return at[begin], np.minimum(size, MAX_WINDOWS), mine[begin]


def gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Slices of ``data`` one after the other."""
    sizes = ends - starts
    stops = np.cumsum(sizes)
    at = np.repeat(starts - (stops - sizes), sizes)
    at += np.arange(at.size)
    return data[at]


def _packer(window: int, mini: int, often: np.ndarray, buckets: int):
    """Texts to rows: packed strings for buckets, and (not packed) repeats already found."""
    names = ["bucket", "doc_id", "text_key", "start", "n", "size", "packed"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        held_bytes = 0
        for batch in batches:
            ids, keys = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for first, _, data, offsets in text_blocks(batch.column(2)):
                words = find_words(data, offsets)
                begin, n, mine = strings_of(words, window, mini, often)
                if not begin.size:
                    continue
                plain, starts, ends = words.joined()
                left, right = starts[begin], ends[begin + n + window - 2]
                of = words.owner[begin]
                place = ids[first + of], keys[first + of], begin - words.first[of], n
                held.append((*digests(plain, left, right).T, *place, mine, right - left, gathered(plain, left, right)))
                held_bytes += held[-1][-1].size
                if held_bytes >= GATHER_BYTES:
                    yield from flushed(held)
                    held, held_bytes = [], 0
        if held:
            yield from flushed(held)

    def flushed(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        one, two, ids, keys, start, n, mine, size, data = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((start, keys, ids, two, one))
        a, b = order[1:], order[:-1]
        once = np.append(True, (one[a] != one[b]) | (two[a] != two[b]) | (ids[a] != ids[b]) | (keys[a] != keys[b]) | (start[a] != start[b]))
        order = order[once]  # a row that occurs twice is at one place
        a, b = order[1:], order[:-1]
        first = np.append(True, (one[a] != one[b]) | (two[a] != two[b]))
        again = order[~first]
        to = again[np.argsort(ids[again] % buckets, kind="stable")]
        for part in np.split(to, np.flatnonzero(np.diff(ids[to] % buckets)) + 1) if to.size else ():
            yield _batch([int(ids[part[0]] % buckets)], [ids[part]], [keys[part]], [start[part]], [n[part]], [[]], [None])
        go = np.sort(order[first])
        bucket = (mine[go] % U(buckets)).astype(np.int64)
        go = go[np.argsort(bucket, kind="stable")]
        bucket = np.sort(bucket)
        right = np.cumsum(size)
        cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), go.size) if go.size else [0]
        pack = zstandard.ZstdCompressor(level=3)
        out: list[list] = [[] for _ in names]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            part = go[lo:hi]
            packed = pack.compress(gathered(data, right[part] - size[part], right[part]).tobytes())
            for column, value in zip(out, (int(bucket[lo]), ids[part], keys[part], start[part], n[part], size[part], packed)):
                column.append(value)
        if out[0]:
            yield _batch(*out)

    def _batch(bucket, *columns) -> pa.RecordBatch:
        lists = [pa.array(c, pa.list_(pa.int64())) for c in columns[:-1]]
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int64()), *lists, pa.array(columns[-1], pa.binary())], names=names)

    return rows


def later_windows(ids, keys, starts, n, sizes, data: np.ndarray, window: int):
    """Which windows of a bucket's strings repeat an earlier one, as (string, first window, number of windows)."""
    of = np.repeat(np.arange(n.size), n)
    within = np.arange(of.size) - np.repeat(np.cumsum(n) - n, n)
    stops = np.cumsum(sizes)
    parts = []
    lo = 0
    while lo < n.size:  # codes of about a million bytes of strings at a time
        base = int(stops[lo] - sizes[lo])
        hi = max(lo + 1, int(np.searchsorted(stops, base + (1 << 20), "right")))
        words = find_words(data[base : stops[hi - 1]], np.append(0, stops[lo:hi] - base))
        at = np.repeat(words.first[:-1], n[lo:hi]) + within[of.searchsorted(lo) : of.searchsorted(hi)]
        one, two = (run_codes(words.hashes(seed), window, seed)[at] for seed in (0, 1))
        parts.append((one, two, words.starts[at] + base, words.ends[at + window - 1] + base))
        lo = hi
    one, two, left, right = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((starts[of] + within, keys[of], ids[of], two, one))
    a, b = order[1:], order[:-1]
    same = np.append(False, (one[a] == one[b]) & (two[a] == two[b]))
    raw = memoryview(data)
    later = np.flatnonzero(same)
    if any(raw[left[x] : right[x]] != raw[left[y] : right[y]] for x, y in zip(order[later], order[later - 1])):
        text = [bytes(raw[x:y]) for x, y in zip(left, right)]  # codes collide: sort by the words themselves
        order = np.array(sorted(range(of.size), key=lambda i: (text[i], ids[of[i]], keys[of[i]], starts[of[i]] + within[i])))
        same = np.array([False, *(text[x] == text[y] for x, y in zip(order[1:], order[:-1]))])
    lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(order.size)))]  # the first of each one's equals
    start = starts[of] + within
    elsewhere = (ids[of[order]] != ids[of[lead]]) | (keys[of[order]] != keys[of[lead]]) | (start[order] != start[lead])
    hit = np.zeros(of.size, bool)
    hit[order[same & elsewhere]] = True
    where = np.flatnonzero(hit)
    if not where.size:
        return where, where, where
    fresh = np.append(True, (where[1:] != where[:-1] + 1) | (of[where[1:]] != of[where[:-1]]))
    begin = np.flatnonzero(fresh)
    return of[where[begin]], within[where[begin]], np.diff(np.append(begin, where.size))


def repeats(texts: DataFrame, window: int = 20, mini: int = 3, buckets: int | None = None) -> DataFrame:
    """Windows of ``texts`` (from :func:`keyed`) that start earlier elsewhere: ``doc_id, text_key, start, n`` windows."""
    spark = texts.sparkSession
    buckets = buckets or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    often = frequent_runs(texts, mini)
    arrays = "doc_id array<long>, text_key array<long>, start array<long>, n array<long>, size array<long>"
    sent = texts.mapInArrow(_packer(window, mini, often, buckets), f"bucket long, {arrays}, packed binary")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            buckets_here = np.asarray(batch.column(0))
            cuts = np.append(np.flatnonzero(np.append(True, buckets_here[1:] != buckets_here[:-1])), len(batch)) if len(batch) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if held and buckets_here[lo] != now:
                    yield _judged(held, window)
                    held = []
                now = buckets_here[lo]
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield _judged(held, window)

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(judge, _REPEAT)


def _judged(held: list[pa.RecordBatch], window: int) -> pa.RecordBatch:
    table = pa.Table.from_batches(held)
    known = pc.is_null(table.column(6))

    def columns(part: pa.Table) -> list[np.ndarray]:
        return [np.asarray(part.column(c).combine_chunks().flatten()) for c in range(1, 6)]

    out = columns(table.filter(known))[:4]
    packed = table.filter(pc.invert(known))
    if packed.num_rows:
        ids, keys, starts, n, sizes = columns(packed)
        unpack = zstandard.ZstdDecompressor()
        data = np.frombuffer(b"".join(unpack.decompress(x.as_py()) for x in packed.column(6)), np.uint8)
        string, first, count = later_windows(ids, keys, starts, n, sizes, data, window)
        fresh = ids[string], keys[string], starts[string] + first, count
        out = [np.concatenate(x) for x in zip(out, fresh)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["doc_id", "text_key", "start", "n"])


def without_repeats(docs: DataFrame, window: int = 20, mini: int = 3, buckets: int | None = None, emit_text: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``doc_id, n_words, n_removed, kept_sha256``, with ``emit_text`` also ``kept``.

    A word goes if a window that covers it also starts earlier: in a smaller doc_id, or in the same document earlier.
    Null ids sort last and count as one; of equal ids with different texts the order is that of a hash of the text.
    Rows equal in id and text are one document: they don't repeat each other and get equal results. Null and empty texts
    have no words; texts of fewer than ``window`` words keep all. Other columns are ignored.
    """
    require(docs, "doc_id", "text")
    texts = keyed(docs)
    found = (
        repeats(texts, window, mini, buckets)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list("start").alias("starts"), F.collect_list("n").alias("ns"))
    )
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if emit_text else [])]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(1)):
                words = find_words(data, offsets)
                size = last - first
                change = np.zeros(words.starts.size + 1, np.int64)
                starts, ns = batch.column(2).slice(first, size), batch.column(3).slice(first, size)
                of = np.repeat(np.arange(size), pc.fill_null(pc.list_value_length(starts), 0))
                begin = words.first[of] + np.asarray(starts.flatten())
                np.add.at(change, begin, 1)
                np.add.at(change, begin + np.asarray(ns.flatten()) + window - 1, -1)
                keep = np.cumsum(change[:-1]) == 0
                plain, left, right = words.joined(keep)
                counts = np.bincount(words.owner[keep], minlength=size)
                stop = np.cumsum(counts)
                raw = plain.tobytes()
                kept = [raw[left[e - c] : right[e - 1]] if c else b"" for c, e in zip(counts.tolist(), stop.tolist())]
                columns = [
                    batch.column(0).slice(first, size), pa.array(words.counts), pa.array(words.counts - counts),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                ]
                if emit_text:
                    columns.append(pa.array([k.decode() for k in kept]))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    found = saved(found)
    place = F.xxhash64("doc_id", "text_key")
    level = possible(found.select(place.alias("key")))
    some = texts
    untouched = None
    if level is not None:  # texts without any repeat needn't travel
        some = texts.filter(level.lets_through(place))
        untouched = texts.filter(~level.lets_through(place))
    joined = some.join(found, ["doc_id", "text_key"], "left")
    if untouched is not None:
        nothing = F.lit(None).cast("array<long>")
        joined = joined.unionByName(untouched.withColumns({"starts": nothing, "ns": nothing}))
    joined = joined.select(
        F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"), "text", "starts", "ns"
    )
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * emit_text
    return joined.mapInArrow(rows, schema)


ORACLE = r"""
WITH w AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN []::VARCHAR[] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS words
  FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(words) - 18)) AS s, words FROM w WHERE len(words) >= 20),
k AS (SELECT doc_id, s, array_to_string(words[s : s + 19], ' ') AS t FROM p),
later AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY t ORDER BY doc_id, s) AS r FROM k) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM later),
g AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id)
SELECT w.doc_id, len(words) AS n_words, coalesce(len(gone), 0) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN words
    ELSE list_filter(words, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM w LEFT JOIN g USING (doc_id)
"""
