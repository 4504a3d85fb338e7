"""CSV records with newlines inside quotes, read by many tasks.

Spark's text reader splits a file at newlines, wherever they stand. Whether a
split begins inside a quoted field depends on all splits before it, so:

1. Every split is scanned once for what it does to the two states that a line
   can begin in, outside of quotes or inside: it keeps, flips or sets them. That
   is one small row per split.
2. A running composition over a file's splits gives the state that each begins
   in; a running sum of bytes gives its exact place in the file.
3. A second scan cuts records. Those that lie within a split are whole; what
   sticks out at a split's ends is a fragment, at most one at either end.
4. Fragments, a few rows per split, are put together in order, and all records
   are parsed by Spark's own CSV parser (``from_csv``).

A quote opens a field only at the field's beginning, two quotes inside are one
literal quote, and text after a closing quote belongs to the field, up to the
delimiter: as Spark's parser reads them. A quote that is never closed makes the
rest of its file (less a newline at its end) one record, as for a reader with one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lamina.operators.relational import DEFAULT_BROADCAST_LIMIT, estimated_bytes
from lamina.sources.tables import stage

RECORD, FILE, PLACE = "record", "file", "place"

# What a split does to the state a line begins in: (from outside, from inside) -> inside?
KEEP, FLIP, SET_OUT, SET_IN = (False, True), (True, False), (False, False), (True, True)


class LineStates:
    """Whether a record goes on after a line, for a delimiter of one character."""

    def __init__(self, delimiter: str = ",", quote: str = '"'):
        q, d = re.escape(quote), re.escape(delimiter)
        self.quote = quote
        body = f"(?:[^{q}]|{q}{q})*"
        # one field from its beginning: closed, open (group 1), or without quotes
        self._field = re.compile(f"{q}{body}(?:{q}(?!{q})[^{d}]*|($))|(?!{q})[^{d}]*", re.S)
        self._rest = re.compile(f"{body}{q}(?!{q})[^{d}]*", re.S)

    def ends_inside(self, line: str, inside: bool) -> bool:
        if self.quote not in line:
            return inside
        at = 0
        if inside:
            closed = self._rest.match(line)
            if not closed:
                return True
            at = closed.end()
            if at == len(line):
                return False
            at += 1
        while True:
            field = self._field.match(line, at)
            if field.group(1) is not None:
                return True
            at = field.end()
            if at >= len(line):
                return False
            at += 1  # the delimiter


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(value, size, file, block, at)``: the physical lines, in the order of the scan."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", (F.octet_length("value") + 1).cast("long").alias("size"),
        F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))


def split_states(lines: DataFrame, states: LineStates) -> DataFrame:
    """``(file, block, out, into, size)``: what each split does to either state, and its bytes."""

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, effect, size = None, KEEP, 0
        for pdf in frames:
            done = []
            for file, block, value, n in zip(pdf[FILE], pdf["block"], pdf["value"], pdf["size"]):
                if (file, block) != here:
                    if here is not None:
                        done.append((*here, *effect, size))
                    here, effect, size = (file, block), KEEP, 0
                size += n
                if states.quote in value:
                    effect = tuple(states.ends_inside(value, s) for s in effect)
            if done:
                yield pd.DataFrame(done, columns=[FILE, "block", "out", "into", "size"])
        if here is not None:
            yield pd.DataFrame([(*here, *effect, size)], columns=[FILE, "block", "out", "into", "size"])

    return lines.select(FILE, "block", "value", "size").mapInPandas(
        fold, "file string, block long, out boolean, into boolean, size long")


def split_starts(effects: DataFrame) -> DataFrame:
    """``(file, block, inside, start)``: the state and the byte that each split begins with."""
    before = Window.partitionBy(FILE).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy(FILE).orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flips = F.sum((F.col("out") & ~F.col("into")).cast("long"))
    fixed = F.when(F.col("out") == F.col("into"), F.struct(F.col("out").alias("state"), F.col("flips").alias("flips")))
    last = effects.withColumn("flips", flips.over(so_far)).withColumn("last", F.last(fixed, True).over(before)).withColumn(
        "before", F.coalesce(flips.over(before), F.lit(0)))
    since = F.col("before") - F.coalesce(F.col("last.flips"), F.lit(0))
    return last.select(
        FILE, "block", (F.coalesce(F.col("last.state"), F.lit(False)) != (since % 2 == 1)).alias("inside"),
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))


WHOLE, ENDS, BEGINS, WITHIN = 0, 1, 2, 3  # a whole record; fragments of one


def cut_records(lines: DataFrame, starts: DataFrame, states: LineStates) -> DataFrame:
    """``(file, block, kind, place, record)``: whole records and the fragments at the ends of splits."""
    if estimated_bytes(starts) <= DEFAULT_BROADCAST_LIMIT:  # splits stay as they were scanned
        known = lines.join(F.broadcast(starts), [FILE, "block"])
    else:
        known = lines.join(starts.hint("shuffle_merge"), [FILE, "block"]).repartition(FILE, "block").sortWithinPartitions(FILE, "block", "at")
    columns = [FILE, "block", "kind", PLACE, RECORD]

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, inside, place, held, held_at, began = None, False, 0, [], 0, True

        def left() -> list[tuple]:
            return [(*here, BEGINS if began else WITHIN, held_at, "\n".join(held))] if held else []

        for pdf in frames:
            out = []
            for file, block, value, size, start_inside, start in zip(
                    *(pdf[c] for c in (FILE, "block", "value", "size", "inside", "start"))):
                if (file, block) != here:
                    if here is not None:
                        out += left()
                    here, inside, place, held, began = (file, block), bool(start_inside), start, [], not start_inside
                    held_at = place
                if not held:
                    held_at = place
                inside = states.ends_inside(value, inside)
                held.append(value)
                place += size
                if not inside:
                    out.append((file, block, WHOLE if began else ENDS, held_at, "\n".join(held)))
                    held, began = [], True
            if out:
                yield pd.DataFrame(out, columns=columns)
        if here is not None and held:
            yield pd.DataFrame(left(), columns=columns)

    return known.select(FILE, "block", "value", "size", "inside", "start").mapInPandas(
        cut, "file string, block long, kind int, place long, record string")


def join_fragments(fragments: DataFrame) -> DataFrame:
    """``(file, place, record)``: records put together from their fragments."""
    in_file = Window.partitionBy(FILE).orderBy("block", PLACE)
    numbered = fragments.withColumn("nr", F.sum((F.col("kind") == BEGINS).cast("long")).over(in_file))
    part = F.struct("block", PLACE, RECORD)
    return numbered.groupBy(FILE, "nr").agg(F.min(PLACE).alias(PLACE), F.sort_array(F.collect_list(part)).alias("parts")).select(
        FILE, PLACE, F.concat_ws("\n", F.transform("parts", lambda p: p[RECORD])).alias(RECORD))


def read_raw_records(spark: SparkSession, path: str | list[str], delimiter: str = ",", quote: str = '"') -> DataFrame:
    """``(file, place, record)`` of all records but blank ones, headers included, staged in scratch space.

    ``place`` is the byte of the file at which the record begins.
    """
    states = LineStates(delimiter, quote)
    lines = _lines(spark, path)
    starts = stage(split_starts(stage(split_states(lines, states), "csv_effects")), "csv_starts")
    cut = stage(cut_records(lines, starts, states), "csv_cut")
    whole = cut.filter(F.col("kind") == WHOLE).select(FILE, PLACE, RECORD)
    records = whole.unionByName(join_fragments(cut.filter(F.col("kind") != WHOLE)))
    bare = F.regexp_replace(RECORD, "\r$", "")
    return records.withColumn(RECORD, bare).filter(F.trim(RECORD) != "")


def parse_records(records: DataFrame, schema: T.StructType, options: dict[str, str], corrupt_col: str | None = None,
                  keep: list[Column] | None = None) -> DataFrame:
    """``records`` as rows of ``schema``, by Spark's CSV parser, and the columns to ``keep``.

    With ``header`` in ``options`` the first record of each file is skipped.
    """
    if options.get("header", "false").lower() == "true":
        first = records.groupBy(FILE).agg(F.min(PLACE).alias(PLACE))
        records = records.join(first, [FILE, PLACE], "left_anti")
    if corrupt_col:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType(), True)])
    of = {k: v for k, v in options.items() if k != "header"} | ({"columnNameOfCorruptRecord": corrupt_col} if corrupt_col else {})
    parsed = F.from_csv(RECORD, schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), of)
    return records.withColumn("__row", parsed).select(*[F.col(f"__row.{f.name}").alias(f.name) for f in schema.fields], *(keep or []))
