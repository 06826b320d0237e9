"""Sub-word encoding and decoding with a merge-type SentencePiece vocabulary.

The encoder walks a text from left to right by backtracking instead of keeping a queue of merges. An
Aho-Corasick automaton gives the longest piece at every position; a piece is taken if it can stand next to the
one before it, which holds exactly if merging the two pieces' characters again ends in these two pieces. If not,
the next shorter piece is tried, then the piece before is given up; a bit field remembers positions from which no
way leads on, so none is tried twice. Merging picks pairs by the merged piece's score and position alone, hence
a sequence of pieces is the merge result exactly if every adjacent pair is.

Merges never cross two neighbouring characters that are neighbours in no piece. Texts are therefore cut before
word-start marks that follow another character, and between letters and other characters; that no piece spans such a
cut is checked when the vocabulary is loaded. A bounded cache holds the parts met before.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from maintlake.llm.shared import in_small_batches, require

MARK = "▁"
#: Parts of a marked text that are encoded on their own: marks with the letters, or the other characters, after them.
_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u0370-\u0373\u0376-\u037d\u0386-\u0481\u048a-\u0556"
_PART = re.compile(f"{MARK}*[{_LETTERS}]+|{MARK}*[^{MARK}{_LETTERS}]+|{MARK}+")


@dataclass(frozen=True)
class Vocabulary:
    """What of a model is needed: mergeable pieces with scores, single bytes, and the begin, end and unknown ids."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: tuple[int, ...]
    begin: int
    end: int
    unknown: int


def read_vocabulary(model_file: str) -> Vocabulary:
    """Read the vocabulary on the driver (32,000 entries; it travels with the function, so executors need no file)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces, byte_ids = {}, {}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[piece] = (i, model.get_score(i))
    if crossing := next((p for p in pieces if _PART.match(p).end() != len(p)), None):
        raise ValueError(f"piece {crossing!r} spans a cut; parts can't be encoded on their own")
    if len(byte_ids) != 256:
        raise ValueError("the vocabulary has no piece for every byte")
    return Vocabulary(
        pieces, tuple(byte_ids[b] for b in range(256)), model.bos_id(), model.eos_id(), model.unk_id()
    )


class _Parts(dict):
    """Encoded parts of texts, made when first asked for."""

    def __init__(self, codec: Codec) -> None:
        super().__init__()
        self.codec = codec

    def __missing__(self, part: str) -> bytes:
        made = self.codec.part(part)
        if len(part) <= 64:  # long parts are rare and would fill the memory
            if len(self) >= self.codec.cache_size:
                self.clear()
            self[part] = made
        return made


@dataclass
class Codec:
    vocabulary: Vocabulary
    #: Parts kept with their ids, and neighbours kept with their compatibility; both start anew beyond this.
    cache_size: int = 1_000_000
    neighbours: dict[tuple[str, str], bool] = field(default_factory=dict)

    def __post_init__(self) -> None:
        pieces = self.vocabulary.pieces
        self.automaton = ahocorasick.Automaton()
        for piece in pieces:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.byte_of = {i: b for b, i in enumerate(self.vocabulary.byte_ids)}
        self.marked = {i for piece, (i, _) in pieces.items() if piece.startswith(MARK)}
        shown = {i: piece.replace(MARK, " ").encode() for piece, (i, _) in pieces.items()}
        shown |= {i: bytes([b]) for i, b in self.byte_of.items()} | {self.vocabulary.unknown: " \u2047 ".encode()}
        self.shown = [shown.get(i, b"") for i in range(max([*shown, self.vocabulary.begin, self.vocabulary.end]) + 1)]
        self.shown_size = np.array([len(x) for x in self.shown])
        self.shown_at = np.cumsum(self.shown_size) - self.shown_size
        self.shown_bytes = np.frombuffer(b"".join(self.shown), np.uint8)
        #: The next shorter piece that begins a piece; a single character always is one.
        self.shorter = {
            p: next((p[:n] for n in range(len(p) - 1, 1, -1) if p[:n] in pieces), p[0]) for p in pieces if len(p) > 1
        }
        self.parts = _Parts(self)

    def merged(self, text: str) -> list[str]:
        """Merge the characters of a short string: highest score first, the leftmost of equals."""
        parts = list(text)
        pieces = self.vocabulary.pieces
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = pieces.get(parts[i] + parts[i + 1])
                if found and (best is None or found[1] > best):
                    best, at = found[1], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, left: str, right: str) -> bool:
        """Whether ``right`` can follow ``left`` (empty: begins the text)."""
        known = self.neighbours.get((left, right))
        if known is None:
            if len(self.neighbours) >= self.cache_size:
                self.neighbours.clear()
            known = self.merged(left + right) == ([left, right] if left else [right])
            self.neighbours[left, right] = known
        return known

    def split(self, text: str) -> list[str]:
        """The pieces of ``text``; a character outside the vocabulary is a piece of its own."""
        longest = [1] * len(text)
        for last, n in self.automaton.iter(text):
            if n > longest[last - n + 1]:
                longest[last - n + 1] = n
        failed = bytearray(len(text) + 1)
        known, shorter = self.neighbours.get, self.shorter
        taken: list[str] = []
        before, at, size = "", 0, len(text)
        piece = text[: longest[0]] if text else ""
        while at < size:
            while piece:
                if not failed[at + len(piece)]:
                    fits = known((before, piece))
                    if fits or fits is None and self.fits(before, piece):
                        break
                piece = shorter.get(piece, "")
            if piece:
                taken.append(piece)
                at += len(piece)
                before = piece
                if at < size:
                    piece = text[at : at + longest[at]]
            else:  # no way leads on from here: give the piece before up
                failed[at] = 1
                piece = taken.pop()
                at -= len(piece)
                before = taken[-1] if taken else ""
        return taken

    def part(self, part: str) -> bytes:
        """The ids of one part as little-endian 32-bit numbers."""
        ids: list[int] = []
        pieces = self.vocabulary.pieces
        for piece in self.split(part):
            if piece in pieces:
                ids.append(pieces[piece][0])
            else:
                ids += [self.vocabulary.byte_ids[b] for b in piece.encode()]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _slowly(self, ids: list[int]) -> str:
        """Runs of byte pieces that aren't valid UTF-8 become replacement characters, one a byte."""
        out: list[str] = []
        run = bytearray()

        def flush() -> None:
            rest = bytes(run)
            run.clear()
            while rest:
                try:
                    out.append(rest.decode())
                    return
                except UnicodeDecodeError as e:
                    out.append(rest[: e.start].decode() + "\ufffd")
                    rest = rest[e.start + 1 :]

        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
            else:
                flush()
                out.append(self.shown[i].decode())
        flush()
        return "".join(out)

    def raw_ids(self, text: str) -> bytes:
        """All ids of a whole text, with begin and end, as little-endian 32-bit numbers."""
        v = self.vocabulary
        parts = _PART.findall(MARK + text.replace(" ", MARK)) if text else ()
        return b"".join([struct.pack("<I", v.begin), *map(self.parts.__getitem__, parts), struct.pack("<I", v.end)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.raw_ids(text), "<u4").tolist()

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ``ids``; begin and end give nothing, and the mark put before the text is taken off."""
        ids = np.asarray(ids, np.int64)
        v = self.vocabulary
        if ((ids[1:-1] == v.begin) | (ids[1:-1] == v.end)).any():  # they end a run of byte pieces
            text = self._slowly(ids.tolist())
        else:
            text = self._quickly(ids)
        first = next((i for i in ids.tolist() if i not in (v.begin, v.end)), None)
        return text[1:] if first in self.marked else text

    def _quickly(self, ids: np.ndarray) -> str:
        sizes = self.shown_size[ids]
        stops = np.cumsum(sizes)
        at = np.repeat(self.shown_at[ids] - (stops - sizes), sizes)
        at += np.arange(at.size)
        try:
            return self.shown_bytes[at].tobytes().decode()
        except UnicodeDecodeError:
            return self._slowly(ids.tolist())


_CODECS: dict[int, Codec] = {}


def encode_documents(docs: DataFrame, model_file: str, text: str = "text", emit_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text of ``docs``: its columns (but the text), then ``n_tokens`` (all ids),
    ``ids_sha256`` and ``decoded_sha256``; with ``emit_ids`` also ``token_ids`` and ``decoded``.

    No shuffle: each row by itself, in the rows' own partitions. A null text counts as empty (ids: begin, end).
    Repeated rows give repeated rows. Columns of ``docs`` with the names of result columns are replaced.
    """
    require(docs, text)
    in_small_batches(docs.sparkSession)
    vocabulary = read_vocabulary(model_file)
    key = hash((model_file, len(vocabulary.pieces)))
    made = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    if emit_ids:
        made |= {"token_ids": pa.list_(pa.int32()), "decoded": pa.string()}
    kept = [c for c in docs.columns if c != text and c not in made]
    ddl = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"} | (
        {"token_ids": "array<int>", "decoded": "string"} if emit_ids else {}
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _CODECS.setdefault(key, Codec(vocabulary))
        for batch in batches:
            out: dict[str, list] = {c: [] for c in made}
            for t in batch.column(0):
                raw = codec.raw_ids(t.as_py() or "")
                ids = np.frombuffer(raw, "<u4")
                decoded = codec.decode(ids)
                out["n_tokens"].append(ids.size)
                out["ids_sha256"].append(hashlib.sha256(raw).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                if emit_ids:
                    out["token_ids"].append(ids.astype(np.int32))
                    out["decoded"].append(decoded)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], *(pa.array(out[c], made[c]) for c in made)], names=[*batch.schema.names[1:], *made]
            )

    source = docs.select(F.col(f"`{text}`").alias("__text"), *(F.col(f"`{c}`") for c in kept))
    schema = ", ".join(
        [*(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[1:]), *(f"{c} {t}" for c, t in ddl.items())]
    )
    return source.mapInArrow(rows, schema)
