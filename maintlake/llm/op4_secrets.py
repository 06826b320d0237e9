"""Secret scan with DataFrame functions only: fixed patterns, and stretches of high entropy.

Places come from splitting a text at a pattern: the lengths (code points) of what lies between the matches and of
the matches add up to starts and ends. Candidates for the entropy scan are runs of one character class. A window
slides over each; per step one character enters, one leaves, and only their counts' terms of sum(c * log2 c) change.
Overlapping windows above the class's threshold join into a span; an allow-list then removes known harmless ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from maintlake.llm.shared import require

# The base kinds in the order that ranks them, their patterns, the group and its least length.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}+", 0, 16),
)


@dataclass(frozen=True)
class CharClass:
    """Runs of ``alphabet`` of at least ``window`` characters are candidates; ``bits`` of entropy a character make a span."""

    kind: str
    alphabet: str
    window: int
    bits: float


_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
CLASSES = (
    CharClass("entropy_hex", _DIGITS + "abcdefABCDEF", 32, 3.0),
    CharClass("entropy_base64", _LOWER + _UPPER + _DIGITS + "+/_-", 24, 4.0),
)
#: Spans whose whole text fits one of these are harmless: words and paths without digits, alphabets in order, place-holders.
ALLOW = (
    r"[A-Za-z/_-]+",
    r".*(abcdefghijkl|ABCDEFGHIJKL|0123456789).*",
    r"(?i).*(example|sample|placeholder|dummy|changeme).*",
    r"[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",
)
#: Items that are counted through in one go; longer lists and runs are taken in blocks, with the same results.
BLOCK = 256
_RANGE = "array<struct<start:int,end:int>>"
_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string>>"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often ``use`` and its inner functions refer to it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def starts(lengths: Column) -> Column:
    """Sum of all lengths before each one, in blocks: a list that grows by copying never gets longer than a block."""

    def running(values: Column, first: Column) -> Column:
        sums = F.aggregate(values, F.array(first), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x)))
        return F.slice(sums, F.lit(1), F.size(values))

    def of_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, F.lit(0), lambda s, x: s + x))
        begins = bound(totals, lambda t: running(t, F.lit(0)))
        return bound(
            begins, lambda first: F.flatten(F.transform(blocks, lambda block, b: running(block, F.get(first, b))))
        )

    return bound(
        lengths,
        lambda whole: bound(
            F.transform(_blocks(F.size(whole)), lambda b: F.slice(whole, b * BLOCK + 1, F.lit(BLOCK))), of_blocks
        ),
    )


def _blocks(n: Column) -> Column:
    """Numbers of the blocks that ``n`` items fill; at least one."""
    return F.sequence(F.lit(0), F.greatest(F.ceil(n / F.lit(BLOCK)).cast("int") - 1, F.lit(0)))


def matches(text: Column, pattern: str, group: int, least: int, rank: int, kind: str) -> Column:
    """Leftmost non-overlapping matches whose ``group`` has ``least`` characters or more, as spans with their text."""
    p = F.lit(pattern)
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, p, F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, p, F.lit(group)).alias("part"),
    )

    def placed(found: Column) -> Column:
        # the last gap follows the last match and has none of its own
        steps = F.slice(found, F.lit(1), F.greatest(F.size(found) - 1, F.lit(0)))
        lengths = F.transform(steps, lambda x: F.length(x["gap"]) + F.length(x["whole"]))

        def span(at: Column) -> Callable[[Column, Column], Column]:
            return lambda x, i: F.struct(
                (F.get(at, i) + F.length(x["gap"])).alias("start"),
                F.lit(rank).alias("rank"),
                (F.get(at, i) + F.length(x["gap"]) + F.length(x["whole"])).alias("end"),
                F.lit(kind).alias("kind"),
                x["whole"].alias("value"),
                (F.length(x["part"]) >= least).alias("long"),
            )

        spans = bound(starts(lengths), lambda at: F.transform(steps, span(at)))
        return F.transform(
            F.filter(spans, lambda x: x["long"]),
            lambda x: F.struct(*(x[c].alias(c) for c in ("start", "rank", "end", "kind", "value"))),
        )

    return F.when(text.rlike(pattern), bound(found, placed)).otherwise(_none())


def _none() -> Column:
    return F.array().cast(_SPAN)


def noisy_spans(candidate: Column, cls: CharClass, rank: int) -> Column:
    """The union of all windows of ``candidate`` (a span) with enough entropy, as spans.

    Windows are slid over pieces of a candidate that begin ``BLOCK`` characters apart and overlap by a window less one,
    so that each window lies in one piece; spans of neighbouring pieces that meet are joined. Time is linear in length.
    """
    w = cls.window
    #: entropy >= bits  <=>  sum(c * log2 c) <= limit
    limit = w * (math.log2(w) - cls.bits) + 1e-9
    term = F.array(*(F.lit(c * math.log2(c) if c else 0.0) for c in range(w + 2)))
    state = F.struct(
        F.array_repeat(F.lit(0), len(cls.alphabet) + 1).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(None).cast(_RANGE).alias("spans"),
    )

    def step(s: Column, pair: Column) -> Column:
        # symbol 0 stands for no character: what "leaves" before the window is full
        enters, leaves, i = pair["enters"], pair["leaves"], pair["i"]
        gone = F.when(leaves > 0, F.element_at(s["counts"], leaves + 1)).otherwise(0)
        there = F.element_at(s["counts"], enters + 1) - (enters == leaves).cast("int")
        total = (
            s["total"]
            + F.when(leaves > 0, F.element_at(term, gone) - F.element_at(term, gone + 1)).otherwise(0.0)
            + F.element_at(term, there + 2)
            - F.element_at(term, there + 1)
        )
        counts = F.transform(
            s["counts"], lambda c, k: c + (k == enters).cast("int") - ((k == leaves) & (k > 0)).cast("int")
        )
        begin = i - w + 1
        last = F.element_at(s["spans"], -1)
        fresh = F.struct(begin.alias("start"), (i + 1).alias("end"))
        grown = F.struct(last["start"].alias("start"), (i + 1).alias("end"))
        spans = (
            F.when((begin < 0) | (total > limit), s["spans"])
            .when(s["spans"].isNull(), F.array(fresh))
            .when(last["end"] >= begin, F.concat(F.slice(s["spans"], F.lit(1), F.size(s["spans"]) - 1), F.array(grown)))
            .otherwise(F.concat(s["spans"], F.array(fresh)))
        )
        return F.struct(counts.alias("counts"), total.alias("total"), spans.alias("spans"))

    def of_piece(piece: Column) -> Column:
        """Spans of one piece, counted from the candidate's begin."""
        steps = F.transform(
            piece["symbols"],
            lambda c, i: F.struct(
                c.alias("enters"), F.when(i >= w, F.get(piece["symbols"], i - w)).otherwise(0).alias("leaves"), i.alias("i")
            ),
        )
        found = F.coalesce(F.aggregate(steps, state, step, lambda s: s["spans"]), F.array().cast(_RANGE))
        return F.transform(
            found,
            lambda x: F.struct((x["start"] + piece["at"]).alias("start"), (x["end"] + piece["at"]).alias("end")),
        )

    def of_symbols(symbols: Column) -> Column:
        pieces = F.transform(
            _blocks(F.size(symbols) - (w - 1)),
            lambda b: F.struct(
                (b * BLOCK).alias("at"), F.slice(symbols, b * BLOCK + 1, F.lit(BLOCK + w - 1)).alias("symbols")
            ),
        )
        return bound(F.flatten(F.transform(pieces, of_piece)), joined)

    def joined(spans: Column) -> Column:
        # begins and ends both rise, so a span that doesn't meet the one before it opens, and one that doesn't meet the next closes
        opens = F.filter(spans, lambda x, i: (i == 0) | (F.get(spans, i - 1)["end"] < x["start"]))
        closes = F.filter(
            spans, lambda x, i: (i == F.size(spans) - 1) | (F.get(spans, i + 1)["start"] > x["end"])
        )
        return F.arrays_zip(
            F.transform(opens, lambda x: x["start"]).alias("start"), F.transform(closes, lambda x: x["end"]).alias("end")
        )

    def of_characters(characters: Column) -> Column:
        symbols = F.transform(characters, lambda c: F.call_function("locate", c, F.lit(cls.alphabet)))
        return F.transform(
            bound(symbols, of_symbols),
            lambda x: F.struct(
                (candidate["start"] + x["start"]).alias("start"),
                F.lit(rank).alias("rank"),
                (candidate["start"] + x["end"]).alias("end"),
                F.lit(cls.kind).alias("kind"),
                F.array_join(F.slice(characters, x["start"] + 1, x["end"] - x["start"]), "").alias("value"),
            ),
        )

    return bound(F.split(candidate["value"], ""), of_characters)


def _noisy(cls: CharClass, rank: int) -> Callable[[Column], Column]:
    return lambda candidate: noisy_spans(candidate, cls, rank)


def _count(kind: str) -> Column:
    return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def find_secrets(
    docs: DataFrame,
    text: str = "text",
    classes: tuple[CharClass, ...] = CLASSES,
    allow: tuple[str, ...] = ALLOW,
) -> DataFrame:
    """``docs`` without ``text`` plus ``found``: all spans by start, then kind (start, rank, end, kind, value).

    Offsets are code points, ends exclusive. A null text counts as empty and has no spans. The allow-list and the
    overlap with base spans only suppress spans of the entropy scan. Rows are judged each by itself, repeated ones
    alike; there is no shuffle. A column of ``docs`` named ``found`` is replaced.
    """
    require(docs, text)
    kept = [c for c in docs.columns if c not in (text, "found")]
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = F.concat(*(matches(whole, p, g, n, rank, kind) for rank, (kind, p, g, n) in enumerate(BASE)))
    step1 = docs.select(*(F.col(f"`{c}`") for c in kept), whole.alias("__text"), base.alias("__base"))
    harmless = "^(?s:" + "|".join(f"(?:{a})" for a in allow) + ")$" if allow else None
    more = []
    for rank, cls in enumerate(classes, len(BASE)):
        pattern = "[" + cls.alphabet.replace("-", "\\-") + "]{" + str(cls.window) + ",}+"
        candidates = matches(F.col("__text"), pattern, 0, cls.window, rank, cls.kind)
        more.append(F.flatten(F.transform(candidates, _noisy(cls, rank))))
    added = F.concat(*more) if more else _none()
    fresh = F.filter(
        added,
        lambda x: ~F.exists(F.col("__base"), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
        & (~x["value"].rlike(harmless) if harmless else F.lit(True)),
    )
    return step1.select(
        *(F.col(f"`{c}`") for c in kept), F.array_sort(F.concat(F.col("__base"), fresh)).alias("found")
    )


def secret_digest(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, the digest of the base spans, and all spans as text."""
    shown = find_secrets(docs.select("doc_id", "text"))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    base = F.filter("found", lambda x: x["rank"] < len(BASE))
    return shown.select(
        "doc_id",
        *(_count(kind) for kind, *_ in BASE),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )
