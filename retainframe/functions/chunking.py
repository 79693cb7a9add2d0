"""Text chunks of bounded length."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import bind
from .strings import strip

CHUNK_SIZE = 1500
CHUNK_OVERLAP = 50

# Paragraph, line, word and character boundaries, tried in this order.
SEPARATORS = ("\n\n", "\n", " ", "")


def fixed_chunks(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Array of chunks starting every ``size - overlap`` characters.

    One regular expression cuts the text into strides, and a chunk is its stride plus the head of
    the next one. Unlike a substring per chunk this reads the text once, whatever its length. A
    last stride that lies inside the previous chunk's overlap is not a chunk of its own.
    """
    stride = size - overlap
    count = F.greatest(F.ceil((F.length(text) - overlap) / F.lit(stride)).cast("int"), F.lit(1))

    def chunks(pieces: Column) -> Column:
        def chunk(piece: Column, i: Column) -> Column:
            return F.concat(piece, F.coalesce(F.substring(F.get(pieces, i + 1), 1, overlap), F.lit("")))

        return F.transform(F.slice(pieces, F.lit(1), count), chunk)

    return bind(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{stride}}}"), 0), chunks)


def recursive_chunks(size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, separators: Sequence[str] = SEPARATORS):
    """Column function: text to an array of chunks cut at the widest boundary that fits.

    A separator stays at the head of the piece after it; pieces are packed up to ``size`` and a new
    chunk starts with whole pieces of the previous one up to ``overlap``. A piece that is itself too
    long is cut by the next separator.

    All of it is built from Spark's own functions. Long pieces are set apart, separator by separator, from runs of pieces
    that fit; every run is then packed by one fold that takes a chunk per step, so words are never handled one by one.
    """
    if size <= overlap:
        raise ValueError("a chunk must be longer than the overlap")

    def split(text: Column) -> Column:
        runs = F.array(_run(text, F.lit(None).cast("int"), F.length(text) >= size))
        for level, separator in enumerate(separators):
            runs = F.flatten(F.transform(runs, _cutter(level, separator, size)))
        packed = F.flatten(F.transform(runs, _packer(tuple(separators), size, overlap)))
        chunks = F.filter(F.transform(packed, strip), lambda c: c != "")
        return F.when(text.isNotNull(), chunks)

    return split


def _run(text: Column, level: Column, long: Column) -> Column:
    """A stretch of text, the separator whose pieces all fit in it (null: it is one piece), and whether it is still too long."""
    return F.struct(text.alias("text"), level.alias("level"), long.alias("long"))


def _pieces(text: Column, separator: str) -> Column:
    """The text cut before every separator; only the first piece has none."""
    parts = F.split(text, re.escape(separator), -1)
    return bind(parts, lambda p: F.filter(F.transform(p, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit(separator), x))), lambda x: x != ""))


def _cutter(level: int, separator: str, size: int):
    """One long run to the runs of short pieces and the single long pieces it is made of; other runs stay."""

    def cut(run: Column) -> Column:
        here = F.lit(level)
        if separator == "":  # single characters always fit
            return F.array(_run(run["text"], F.when(run["long"], here).otherwise(run["level"]), F.lit(False)))

        def joined(pieces: Column) -> Column:
            long = lambda i: F.length(F.get(pieces, i)) >= size
            edges = F.filter(F.sequence(F.lit(0), F.size(pieces)), lambda i: (i == 0) | (i == F.size(pieces)) | long(i) | long(i - 1))
            return bind(edges, lambda e: F.transform(
                F.slice(e, F.lit(1), F.size(e) - 1),
                lambda i, k: _run(F.array_join(F.slice(pieces, i + 1, F.get(e, k + 1) - i), ""), here, long(i)),
            ))

        # without a piece that is too long, the run needs no cutting at all
        other = f"[^{re.escape(separator)}]"
        stretch = f"(?s)^.{{{size}}}" if len(separator) > 1 else f"^{other}{{{size}}}|{re.escape(separator)}{other}{{{size - 1}}}"
        some_long = run["text"].rlike(stretch)
        whole = F.array(_run(run["text"], here, F.lit(False)))
        return F.when(~run["long"], F.array(run)).when(some_long, bind(_pieces(run["text"], separator), joined)).otherwise(whole)

    return cut


# A run is fed to the fold in blocks of this many characters, so that a step's work does not grow with the text.
BLOCK = 1 << 16


def _packer(separators: tuple[str, ...], size: int, overlap: int):
    """One run to its chunks, not yet stripped."""

    def pack(run: Column) -> Column:
        text, level = run["text"], run["level"]
        packed = F.array(text)
        for i, separator in enumerate(separators):
            cut = fixed_chunks(text, size, overlap) if separator == "" else _folded(text, separator, size, overlap)
            packed = F.when(level == i, cut).otherwise(packed)
        return F.when(F.length(text) <= size, F.array(text)).otherwise(packed)

    return pack


def _folded(text: Column, separator: str, size: int, overlap: int) -> Column:
    """Greedy packing of pieces that all fit: each step takes the longest chunk from the head of the rest.

    Two steps move on by more than ``size - overlap`` characters, which bounds their number. A step waits for more text
    unless the rest holds two chunks or is the end.
    """
    width, need = len(separator), 2 * size + len(separator)
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), 0)

    def timed(parts: Column) -> Column:
        def fed(part: Column, i: Column) -> Column:
            last = i == F.size(parts) - 1
            steps = 2 * F.ceil((F.length(part) + need) / F.lit(size - overlap)).cast("int") + 2
            idle = F.array_repeat(F.struct(F.lit("").alias("text"), last.alias("last")), steps)
            return F.concat(F.array(F.struct(part.alias("text"), last.alias("last"))), idle)

        return F.flatten(F.transform(parts, fed))

    def end_of(rest: Column) -> Column:
        """Length of the longest chunk: up to the last boundary within ``size`` characters."""
        head = F.substring(rest, 1, size + width)
        last = F.substring_index(head, separator, -1) if width == 1 else F.element_at(F.split(head, re.escape(separator), -1), -1)
        return F.length(head) - F.length(last) - width

    def step(state: Column, tick: Column) -> Column:
        fed = F.concat(state["rest"], tick["text"])

        def chunked(rest: Column) -> Column:
            def moved(end: Column) -> Column:
                after = F.substring(rest, end + 1, F.lit(size))
                following = F.call_function("locate", F.lit(separator), after, F.lit(1 + width))
                piece = F.when(following > 0, following - 1).otherwise(F.length(after))
                least = F.greatest(end - overlap, end + piece - size)

                def start(low: Column) -> Column:
                    if width == 1:
                        place = F.instr(F.substring(rest, low + 1, end - low), separator)
                        return F.when(place > 0, low + place - 1).otherwise(end)
                    parts = F.split(F.substring(rest, F.lit(1), end), re.escape(separator), -1)
                    first = F.aggregate(
                        parts, F.struct(F.lit(-width).alias("at"), F.lit(None).cast("int").alias("found")),
                        lambda s, p: F.struct((s["at"] + width + F.length(p)).alias("at"), F.coalesce(s["found"], F.when(s["at"] >= low, s["at"])).alias("found")),
                    )
                    return F.coalesce(first["found"], end)

                return bind(bind(least, start), lambda begin: F.struct(
                    F.substring(rest, begin + 1, F.length(rest)).alias("rest"),
                    F.concat(state["out"], F.array(F.substring(rest, F.lit(1), end))).alias("out"),
                ))

            waiting = F.struct(rest.alias("rest"), state["out"].alias("out"))
            final = F.struct(F.lit("").alias("rest"), F.concat(state["out"], F.array(rest)).alias("out"))
            room = F.length(rest)
            return (
                F.when((room == 0) | (~tick["last"] & (room < need)), waiting)
                .when(room <= size, final)
                .otherwise(bind(end_of(rest), moved))
            )

        return bind(fed, chunked)

    empty = F.struct(F.lit("").alias("rest"), F.array().cast("array<string>").alias("out"))
    return F.aggregate(bind(blocks, timed), empty, step, lambda s: s["out"])
