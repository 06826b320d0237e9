"""Line dedup by a segment-partition edit join.

Lines within ``edits`` edits of each other are copies. A line cut into edits + 1 segments keeps at least one whole under
that many edits, at a place that the edits before and after it bound. Each distinct line is indexed by its
length, segment number and segment, and probes with its substrings at those places for every length that a partner can
have. Lines that meet on a key make a family (a star a key, not its pairs); families are compared in blocks, where pairs
that share a key and aren't linked yet are verified by a banded bit-parallel edit distance.

A line's number is half of a 128-bit cryptographic digest of its bytes; equal lines are told by the whole digest. Codes of
segments only propose pairs, which are then verified on the lines themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from maintlake.llm.bloom import possible, thinned
from maintlake.llm.links import Groups, components, each_group, in_blocks
from maintlake.llm.shared import NULL_ID, dropped, known_id, require, saved
from maintlake.llm.textops import U, Rolling, digests, mix, text_blocks

#: Bytes other than spaces, which never occur inside another character.
_INK = np.ones(256, bool)
_INK[[9, 10, 11, 12, 13, 32]] = False
#: Letters are counted by their code points modulo this.
_CELLS = 32


@dataclass
class Lines:
    """Lines that aren't blank, of consecutive texts, as stretches of bytes."""

    data: np.ndarray
    owner: np.ndarray
    number: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def characters(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The code points of all texts, and the lines as stretches of them."""
        points = np.frombuffer(self.data.tobytes().decode().encode("utf-32-le"), np.uint32)
        at = np.append(0, np.cumsum((self.data & 0xC0) != 0x80))
        return points, at[self.starts], at[self.ends]

    def digests(self) -> np.ndarray:
        return digests(self.data, self.starts, self.ends).view(np.int64)

    def texts(self, which: np.ndarray) -> pa.Array:
        # lines and what lies between them take turns
        edges = np.column_stack([self.starts, self.ends]).ravel().astype(np.int64)
        if not edges.size:
            return pa.array([], pa.string())
        all_texts = pa.LargeStringArray.from_buffers(edges.size - 1, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(self.data)))
        return all_texts.take(pa.array(2 * which)).cast(pa.string())


def find_lines(data: np.ndarray, offsets: np.ndarray) -> Lines:
    breaks = np.flatnonzero(data == 10)
    full = np.flatnonzero(np.diff(offsets))
    owner = np.append(full, np.searchsorted(offsets, breaks, "right") - 1)
    starts = np.append(offsets[:-1][full], breaks + 1)
    order = np.lexsort((starts, owner))
    owner, starts = owner[order], starts[order]
    last = np.append(owner[1:] != owner[:-1], True) if owner.size else np.zeros(0, bool)
    ends = np.where(last, offsets[1:][owner], np.append(starts[1:], 0) - 1)
    number = np.arange(owner.size) - np.searchsorted(owner, owner)
    ink = np.append(0, np.cumsum(_INK[data]))
    solid = ink[ends] > ink[starts]
    return Lines(data, owner[solid], number[solid], starts[solid], ends[solid])


def segments(length: np.ndarray, parts: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of segment ``i`` of ``parts`` nearly equal ones; the later ones are the longer ones."""
    short, longer = length // parts, length % parts
    before = np.maximum(0, i - (parts - longer))
    return i * short + before, short + (i >= parts - longer)


def probes(edits: int) -> list[tuple[int, int, int]]:
    """(by how much a partner is shorter, segment, shift of its place) that a line has to look up.

    Left of the first intact segment i there are at most i edits, right of it at most ``edits - i``.
    """
    return [
        (less, i, shift)
        for less in range(edits + 1)
        for i in range(edits + 1)
        for shift in range(-i, i + 1)
        if abs(shift - less) <= edits - i
    ]


def line_keys(rolling: Rolling, starts: np.ndarray, ends: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, key) of all index and probe keys; a line's own segments are its probes without shift for its own length."""
    length = ends - starts
    lines, keys = [np.zeros(0, np.int64)], [np.zeros(0, U)]
    for less, i, shift in probes(edits):
        place, size = segments(length - less, edits + 1, i)
        begin = place + shift
        ok = np.flatnonzero((length - less > edits) & (begin >= 0) & (begin + size <= length))
        left = starts[ok] + begin[ok]
        code = rolling.codes(left, left + size[ok])
        lines.append(ok)
        keys.append(mix(code ^ mix(((length[ok] - less) * 64 + i).astype(U))))
    return np.concatenate(lines), np.concatenate(keys)


def within(a: str, b: str, edits: int) -> bool:
    """Whether ``b`` is at most ``edits`` insertions, deletions and replacements from ``a``: a band of 2 * edits + 1
    cells around the diagonal in one word, moved along a column at a time."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > edits:
        return False
    head, top = 0, len(b)
    while head < top and a[head] == b[head]:
        head += 1
    tail, top = 0, len(b) - head
    while tail < top and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if not b or len(a) <= edits:
        return len(a) <= edits
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    bits = 2 * edits + 1
    full, low_edge = (1 << bits) - 1, 1 << (bits - 1)
    # vertical differences in the band (bit 0: its upper end); the cells above the matrix count as equal
    plus, minus, distance = (full << edits) & full, 0, edits
    along = low_edge >> 1
    for j, c in enumerate(b):
        shift = j - edits
        equal = places.get(c, 0)
        equal = (equal >> shift if shift >= 0 else equal << -shift) & full
        diagonal = ((((equal & plus) + plus) ^ plus) | equal | minus) & full
        right_up = (minus | ~(diagonal | plus)) & full
        right_down = diagonal & plus
        if j < len(a) - edits:  # the lower edge runs along a diagonal, then along the last row
            distance += not diagonal & low_edge
        else:
            distance += bool(right_up & along) - bool(right_down & along)
            along >>= 1
        plus = (right_down | ~((diagonal >> 1) | right_up)) & full
        minus = (diagonal >> 1) & right_up
    return distance <= edits


def lined(docs: DataFrame) -> DataFrame:
    return docs.select(known_id().alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"), "text")


def _places(texts: DataFrame, edits: int, least: int) -> DataFrame:
    """``node, check, doc_id, text_key, line, keys`` of every line that isn't blank; ``keys``, null otherwise, of lines of
    ``least`` characters or more, once for equal lines of a block of texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for first, _, data, offsets in text_blocks(batch.column(2)):
                x = find_lines(data, offsets)
                one, two = x.digests().T
                points, starts, ends = x.characters()
                fresh = np.unique(one, return_index=True)[1]
                fresh = np.sort(fresh[ends[fresh] - starts[fresh] >= least])
                line, key = line_keys(Rolling(points), starts[fresh], ends[fresh], edits)
                line = fresh[line]
                counts = np.bincount(line, minlength=one.size)
                stops = np.append(0, np.cumsum(counts)).astype(np.int32)
                key = key[np.argsort(line, kind="stable")].view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(stops), pa.array(key), mask=pa.array(counts == 0))
                columns = [pa.array(c) for c in (one, two, ids[first + x.owner], keys[first + x.owner], x.number)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, lists], names=["node", "check", "doc_id", "text_key", "line", "keys"]
                )

    schema = "node long, check long, doc_id long, text_key long, line long, keys array<long>"
    return texts.mapInArrow(rows, schema)


def _wanted_lines(texts: DataFrame) -> DataFrame:
    """``node, value`` of every line that isn't blank, once for equal lines of a block of texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                x = find_lines(data, offsets)
                node, first = np.unique(x.digests()[:, 0], return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(node), x.texts(first)], names=["node", "value"])

    return texts.select("text").mapInArrow(rows, "node long, value string")


def compare(table: pa.Table, edits: int) -> pa.RecordBatch | None:
    """Links ``a, b`` of one pair of blocks that join what others of it don't."""
    left, right = table.column("left")[0].as_py(), table.column("right")[0].as_py()
    node, index = np.unique(np.asarray(table.column("node")), return_index=True)
    if node.size < 2:
        return None
    block = np.asarray(table.column("block"))[index]
    values = table.column("value").take(pa.array(index)).to_pylist()
    points = np.frombuffer("".join(values).encode("utf-32-le"), np.uint32)
    stops = np.cumsum([len(v) for v in values])
    line, key = line_keys(Rolling(points), np.append(0, stops[:-1]), stops, edits)
    order = np.lexsort((line, key))
    line, key = line[order], key[order]
    cuts = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), key.size)
    # an edit changes at most two of a line's letter counts by one: lines whose counts differ by more aren't near
    sizes = np.diff(np.append(0, stops))
    cell = np.repeat(np.arange(node.size) * _CELLS, sizes) + points % _CELLS
    letters = np.bincount(cell, minlength=node.size * _CELLS).reshape(-1, _CELLS).astype(np.int32)
    groups, links = Groups(node.size), []
    seen: set[tuple[int, int]] = set()
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if hi - lo < 2:
            continue
        met = np.unique(line[lo:hi])
        roots: set[int] = set()  # components of the lines passed; one that is alone has nothing left to link
        for n, i in enumerate(met.tolist()):
            mine = groups.find(i)
            if roots - {mine}:
                near = met[:n][np.abs(letters[met[:n]] - letters[i]).sum(axis=1) <= 2 * edits]
                for j in near.tolist():
                    if left != right and block[i] == block[j] or (j, i) in seen or groups.find(j) == groups.find(i):
                        continue
                    seen.add((j, i))
                    if within(values[i], values[j], edits):
                        groups.join(i, j)
                        links.append((int(node[i]), int(node[j])))
                if groups.find(i) != mine or any(groups.find(r) != r for r in roots):
                    roots, mine = {groups.find(r) for r in roots}, groups.find(i)
            roots.add(mine)
    if not links:
        return None
    a, b = zip(*links)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def line_links(
    texts: DataFrame, edits: int, least: int, block_chars: int = 2_000_000, places: DataFrame | None = None
) -> DataFrame:
    """Links ``a, b`` between different lines: exact up to connectedness. ``places``: those of ``texts``, if saved already."""
    if places is None:
        places = saved(_places(texts, edits, least))
    keys = places.select(F.explode("keys").alias("token"), "node")
    hubs = keys.groupBy("token").agg(F.min("node").alias("hub"), F.max("node").alias("other")).filter("hub <> other")
    hubs = saved(hubs.select("token", "hub"))
    level = possible(hubs.select(F.col("token").alias("key")))
    stars = thinned(keys, F.col("token"), level).join(hubs, "token").filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    found = components(stars)
    dropped(hubs, *([level.words] if level else []))
    family = found.withColumnRenamed("component", "family")
    level = possible(family.select(F.col("node").alias("key")))
    members = thinned(_wanted_lines(texts), F.col("node"), level).join(family, "node").groupBy("node", "family").agg(F.min("value").alias("value"))
    members = saved(members.withColumn("chars", F.length("value")))
    dropped(found, *([level.words] if level else []))
    spread = in_blocks(members.select("family", "node", "chars"), "chars", block_chars).drop("chars")
    blocks = spread.join(members.select("node", "value"), "node")
    return each_group(blocks, ["family", "left", "right"], lambda t: compare(t, edits), "a long, b long")


def repeated_lines(docs: DataFrame, edits: int = 2, least: int = 20) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``doc_id, n_lines, n_removed, removed`` (numbers of removed lines from 0).

    Lines end at line feeds; blank lines are kept and not compared. Lines are copies if equal, or if both have ``least``
    characters or more and ``edits`` edits or fewer lead from one to the other, also in several steps. Of copies the
    first stays: smallest doc_id (null last), then a hash of the text where ids repeat, then line number. Rows equal in
    id and text are one document and get equal results. Null and empty texts have no lines. Other columns are ignored.
    """
    require(docs, "doc_id", "text")
    if least < 2 * edits + 2:
        raise ValueError("near copies need lines of at least 2 * edits + 2 characters")
    texts = lined(docs)
    # every text is taken apart once; its lines' keys and digests are read again from here
    places = saved(_places(texts, edits, least))
    found = components(line_links(texts, edits, least, places=places))
    place = F.struct("doc_id", "text_key", "line")
    first = places.groupBy("node", "check").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
    # a line seen once and without near copies stays: most lines end here
    met = saved(first.join(found, "node", "left").filter("copies > 1 OR component IS NOT NULL"))
    leaders = met.filter("component IS NOT NULL").groupBy("component").agg(F.min("first").alias("leader"))
    # lines with near copies: their class's first place; all others: their own
    near = met.join(leaders, "component").select("node", "check", F.col("leader").alias("first"))
    first = saved(near.unionAll(met.filter("component IS NULL").select("node", "check", "first")))
    level = possible(first.select(F.col("node").alias("key")))
    gone = saved(
        thinned(places, F.col("node"), level)
        .join(first, ["node", "check"])
        .filter(F.col("first") != place)
        .groupBy("doc_id", "text_key")
        .agg(F.sort_array(F.collect_set("line")).alias("removed"))
    )
    # the lines' keys are most of what is stored here
    dropped(places, found, met, first, *([level.words] if level else []))
    breaks = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    n_lines = F.when(F.octet_length("text") > 0, breaks + 1).otherwise(0).cast("long")
    counts = texts.select("doc_id", "text_key", n_lines.alias("n_lines"))
    return counts.join(gone, ["doc_id", "text_key"], "left").select(
        F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")).alias("doc_id"),
        "text_key",
        "n_lines",
        F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<long>")).alias("removed"),
    )


def without_repeated_lines(docs: DataFrame, edits: int = 2, least: int = 20) -> DataFrame:
    """``docs`` with the same columns, their texts (and ``n_chars``) without repeated lines; documents that lose all
    their lines go. A null text stays null."""
    found = repeated_lines(docs, edits, least).filter("n_removed > 0").dropDuplicates(["doc_id", "text_key"])
    found = found.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("removed").alias("__removed"))
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    joined = docs.join(found, docs["doc_id"].eqNullSafe(F.col("__id")) & (key == F.col("__key")), "left")
    names = docs.columns
    schema = docs.select("*", F.lit(True).alias("__any")).schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, some = [], []
            for t, gone in zip(batch.column("text").to_pylist(), batch.column("__removed").to_pylist()):
                lines = (t or "").split("\n") if gone else []
                for i in gone or ():
                    lines[i] = None
                kept = [x for x in lines if x is not None]
                text.append("\n".join(kept) if gone else t)
                some.append(not gone or any(x.strip(" \t\v\f\r") for x in kept))
            columns = [pa.array(text, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(some)], names=[*names, "__any"])

    out = joined.select(*names, "__removed").mapInArrow(rows, schema).filter("__any").drop("__any")
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
