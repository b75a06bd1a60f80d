"""Delimited lines into typed rows, with a reason for every line that cannot be loaded.

Blocks of lines go through a columnar bulk parser (Arrow's CSV reader and vectorised checks).  A block with broken
quoting, or one the reader fails on, is cut in two again and again, so the bad lines are isolated in a logarithmic number
of steps and all others are still parsed in bulk.  Lines of a wrong shape are reported by the reader, lines of invalid
values by a mask over the parsed columns.  What is set aside is read strictly, by the letter of the format, which yields
either its row or its first reason.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most lines of a bulk block.
BLOCK_LINES = 4096
#: A block of at most this many lines with broken quoting is looked at line by line.
STRICT_LINES = 8

BLANKS = " \t\r\n\x0b\x0c"
NULL_MARKS = ("", ".", "?")
_FIELD = r'(?:[^",]*|"(?:[^"]|"")*")'
_LINE = rf"{_FIELD}(?:,{_FIELD})*"
_NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?(?:\([0-9]+\))?"
_STRICT_LINE, _STRICT_FIELD, _STRICT_NUMBER = re.compile(_LINE), re.compile(rf"({_FIELD})(?:,|\Z)"), re.compile(_NUMBER)


@dataclass(frozen=True)
class Field:
    """One field of a line.  ``kind`` is string, int or number; ``required`` fields fail their line when invalid
    (other invalid values load as null); ``low`` and ``high`` bound a number, both included."""

    name: str
    kind: str = "string"
    required: bool = False
    low: float | None = None
    high: float | None = None


#: The ten fields of an atom-site line.
ATOM_SITE = (
    Field("cod_id", "int"),
    Field("label"),
    Field("type_symbol"),
    Field("fract_x", "number", True),
    Field("fract_y", "number"),
    Field("fract_z", "number"),
    Field("occupancy", "number", True, 0.0, 1.0),
    Field("u_iso_or_equiv", "number", True, 0.0),
    Field("wyckoff_symbol"),
    Field("site_symmetry"),
)

_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "number": T.DoubleType()}


def _strict_value(text: str, f: Field):
    """(value, valid) of one field."""
    text = text.strip(BLANKS)
    if text in NULL_MARKS:
        return None, True
    if f.kind == "string":
        return text, True
    if not _STRICT_NUMBER.fullmatch(text):
        return None, False
    x = float(text.partition("(")[0])
    if (f.low is not None and x < f.low) or (f.high is not None and x > f.high):
        return None, False
    if f.kind == "int":
        return (int(x), True) if x == x // 1 and abs(x) < 2**31 else (None, False)
    return x, True


def read_strictly(line: str | None, fields: tuple[Field, ...]) -> tuple[list, str | None]:
    """The values of one line and the first reason against it; a null line has no fields."""
    none = [None] * len(fields)
    if line is None:
        return none, "column_count"
    if not _STRICT_LINE.fullmatch(line):
        return none, "quoting"
    cells = []
    at = 0
    while True:
        m = _STRICT_FIELD.match(line, at)
        cells.append(m[1][1:-1].replace('""', '"') if m[1][:1] == '"' else m[1])
        at = m.end()
        if at == len(line) and not line.endswith(",", m.end(1), at):
            break
    if len(cells) != len(fields):
        return none, "column_count"
    read = [_strict_value(c, f) for c, f in zip(cells, fields, strict=True)]
    return [v for v, _ in read], next((f.name for f, (_, ok) in zip(fields, read, strict=True) if f.required and not ok), None)


def _ill_quoted(lines, at) -> list[int]:
    """The places, of ``at``, of lines with broken quoting, by bisection: a part is cut while any of its lines fails."""
    import pyarrow as pa
    import pyarrow.compute as pc

    found, todo = [], [at]
    while todo:
        part = todo.pop()
        if len(part) <= STRICT_LINES:
            found += [i for i in part if not _STRICT_LINE.fullmatch(lines[i].as_py())]
        elif not pc.all(pc.match_substring_regex(lines.take(pa.array(part)), rf"(?s)\A{_LINE}\z")).as_py():
            half = len(part) // 2
            todo += [part[:half], part[half:]]
    return found


def _read_block(lines, fields: tuple[Field, ...]):
    """(places, columns, doubtful places) of a block whose quoting is sound: the places of lines of the right shape, their
    Arrow columns, and of these the places with invalid values.  None if the reader fails on the block."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyarrow import csv

    wrong: list[int] = []

    def set_aside(row):
        wrong.append(row.number)
        return "skip"

    data = "\n".join(lines.to_pylist()) + "\n"
    try:
        t = csv.read_csv(
            pa.BufferReader(data.encode()),
            read_options=csv.ReadOptions(column_names=[str(i) for i in range(len(fields))], use_threads=False, block_size=max(1 << 16, 4 * len(data) + 16)),
            parse_options=csv.ParseOptions(newlines_in_values=False, ignore_empty_lines=False, invalid_row_handler=set_aside),
            convert_options=csv.ConvertOptions(column_types={str(i): pa.string() for i in range(len(fields))}, strings_can_be_null=False),
        )
        if t.num_rows + len(wrong) != len(lines) or None in wrong:
            return None
        places = np.delete(np.arange(len(lines)), np.array(wrong, int) - 1)
        doubt = np.zeros(len(places), bool)
        cols = []
        for f, c in zip(fields, t.columns, strict=True):
            c = pc.utf8_trim(c.combine_chunks() if c.num_chunks else pa.array([], pa.string()), characters=BLANKS)
            c = pc.if_else(pc.is_in(c, value_set=pa.array(NULL_MARKS)), pa.scalar(None, pa.string()), c)
            if f.kind != "string":
                given = c.is_valid()
                c = pc.if_else(pc.match_substring_regex(c, rf"\A{_NUMBER}\z"), c, pa.scalar(None, pa.string()))
                c = pc.replace_substring_regex(c, r"\A\+|\(.*", "").cast(pa.float64())
                good = c.is_valid()
                for bound, beyond in ((f.low, pc.less), (f.high, pc.greater)):
                    if bound is not None:
                        good = pc.and_(good, pc.invert(pc.fill_null(beyond(c, bound), False)))
                if f.kind == "int":
                    good = pc.and_(good, pc.fill_null(pc.and_(pc.equal(c, pc.floor(c)), pc.less(pc.abs(c), 2.0**31)), False))
                c = pc.if_else(good, c, pa.scalar(None, pa.float64()))
                if f.required:
                    doubt |= pc.and_not(given, good).to_numpy(zero_copy_only=False)
                if f.kind == "int":
                    c = c.cast(pa.int32())
            cols.append(c)
        return places, cols, places[doubt]
    except pa.ArrowInvalid:
        return None


def _load_block(lines, fields: tuple[Field, ...]):
    """(columns, reasons) of a block of lines, in order."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    # Lines that aren't one line of the reader's are never bulk.
    plain = pc.fill_null(pc.and_(pc.not_equal(lines, ""), pc.invert(pc.match_substring_regex(lines, "[\n\r\\x00]"))), False)
    bulk = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
    quoted = np.flatnonzero(pc.fill_null(pc.match_substring(lines, '"'), False).to_numpy(zero_copy_only=False))
    bulk = np.setdiff1d(bulk, _ill_quoted(lines, np.intersect1d(bulk, quoted).tolist()), assume_unique=True)
    types = [{"string": pa.string(), "int": pa.int32(), "number": pa.float64()}[f.kind] for f in fields]
    got, where, strict = [[] for _ in fields], [], np.ones(len(lines), bool)
    todo = [bulk] if len(bulk) else []
    while todo:
        part = todo.pop()
        read = _read_block(lines.take(pa.array(part)), fields)
        if read is not None:
            places, cols, doubt = read
            fine = ~np.isin(places, doubt)
            where.append(part[places[fine]])
            strict[where[-1]] = False
            for all_, c in zip(got, cols, strict=True):
                all_.append(c.filter(pa.array(fine)))
        elif len(part) > 1:
            half = len(part) // 2
            todo += [part[:half], part[half:]]
    rest = np.flatnonzero(strict)
    read = [read_strictly(x.as_py(), fields) for x in lines.take(pa.array(rest))]
    where.append(rest)
    reasons = np.full(len(lines), None, object)
    reasons[rest] = [reason for _, reason in read]
    order = pa.array(np.argsort(np.concatenate(where), kind="stable"))
    out = []
    for i, (all_, kind) in enumerate(zip(got, types, strict=True)):
        all_.append(pa.array([None if reason else values[i] for values, reason in read], kind))
        out.append(pa.concat_arrays(all_).take(order))
    return out, pa.array(reasons, pa.string())


def load_lines(df: DataFrame, line_col: str, keys: list[str], fields: tuple[Field, ...] = ATOM_SITE, block: int = BLOCK_LINES) -> DataFrame:
    """``keys``, one typed column per field and ``reason``: null for a loaded row, else why the line was refused.

    Reasons, the first that holds: ``quoting``, ``column_count``, the name of a required field with an invalid value.
    One row per input row, so repeated lines stay repeated; a refused line has null fields.

    Defined results: a null line has no fields (``column_count``), an empty line has one; invalid values in fields
    that aren't required load as null; very long lines and lines with line feeds are read like any other; an empty
    table gives an empty table.  Only ``keys`` and ``line_col`` are read; a key named like a field or ``reason``
    keeps its name and the field gets ``_field`` behind it.
    """
    named = lambda n: n + "_field" if n in keys else n
    schema = T.StructType([*(df.schema[k] for k in keys), *(T.StructField(named(f.name), _TYPES[f.kind]) for f in fields), T.StructField(named("reason"), T.StringType())])
    src = df.select(*keys, F.col(line_col).alias("__line"))

    def parse(batches):
        import pyarrow as pa

        for batch in batches:
            for start in range(0, len(batch), block):
                part = batch.slice(start, block)
                cols, reasons = _load_block(part.column(len(keys)), fields)
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keys)], *cols, reasons], names=schema.names)

    return src.mapInArrow(parse, schema)
