"""Deeply nested JSON records into flat tables, by Dewey labels.

Every entry of a repeated level (an array element) becomes a *node*.  Its label is the path of ordinals that leads to
it, e.g. ``[4, 0, 2]``: entry 2 of entry 0 of entry 4.  Its schema path is the path of names, e.g.
``$.lines[].families[].members[]``.  The parent's label is the label without its last ordinal, so parent links need
no look-up, and the nodes of one schema path are one flat table.  Fields met once per entry are kept in the node
itself (``attrs``, by dotted name).

Parsing a text is the one step done in Python (Arrow batches, no shuffle); labels, parents, tables and typed columns
are Spark expressions over the node rows.  A text that can't be read is a row with its reason, never an error.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NODE = [
    T.StructField("schema_path", T.StringType()),
    T.StructField("label", T.ArrayType(T.IntegerType())),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
]
#: Nodes, and ordinals in their labels, that an output batch holds.
_BATCH_NODES, _BATCH_ORDINALS = 20_000, 500_000
#: The schema path of a text that gives no nodes; its reason is the attribute ``reason``.
REFUSED = "!"


class _Digits(str):
    """A whole number of too many digits for an integer, as its text."""


def _not_json(text):
    raise ValueError(text)


def _loads(text: str):
    try:
        return json.loads(text, parse_constant=_not_json)
    except json.JSONDecodeError:
        raise
    except ValueError as e:
        if "digits" not in str(e):
            raise
        return json.loads(text, parse_constant=_not_json, parse_int=lambda x: int(x) if len(x) < 4000 else _Digits(x))


def read_with_reason(text: str | None):
    """(value, reason): the value of a JSON text, JSON inside a JSON string counting as its content; or why there is
    none: ``null``, ``not_json`` or ``too_deep`` (beyond the parser's stack, thousands of levels)."""
    if text is None:
        return None, "null"
    value = text
    try:
        while isinstance(value, str) and not isinstance(value, _Digits):
            value = _loads(value)
    except RecursionError:
        return None, "too_deep"
    except ValueError:
        return None, "not_json"
    return value, "null" if value is None else None


def read_json(text: str | None):
    """The value of a JSON text, or None if it can't be read as a whole."""
    return read_with_reason(text)[0]


_SPECIAL = re.compile(r"[\\.\[\]]")


def _name(key: str) -> str:
    """A key as part of a path: dots, brackets and backslashes escaped; the empty key is a backslash."""
    return _SPECIAL.sub(lambda m: "\\" + m[0], key) if _SPECIAL.search(key) else key or "\\"


def _text(value) -> str:
    if isinstance(value, str):
        return str(value)
    if value is True or value is False:
        return "true" if value else "false"
    if isinstance(value, list):
        return f"[{', '.join('null' if x is None else json.dumps(x) if isinstance(x, str) and not isinstance(x, _Digits) else _text(x) for x in value)}]"
    return "{}" if isinstance(value, dict) else repr(value)


def _walk(root, repeated: frozenset[str]):
    """Yields (schema path, label, attrs) of the root's node and of all nodes below it, without recursion."""
    nodes = [(root, "$", ())]
    while nodes:
        value, path, label = nodes.pop()
        attrs: dict[str, str] = {}
        if type(value) is list and not label and path == "$":
            arrays, fields = [("", value)], []
        else:
            arrays, fields = [], [("", "", value)]
        while fields:
            name, prefix, v = fields.pop()
            many = name in repeated
            if many and isinstance(v, str) and not isinstance(v, _Digits):
                inner = read_json(v)
                v = v if inner is None else inner
            if type(v) is dict:
                if many and prefix:
                    arrays.append((prefix, [v]))
                else:
                    fields += [(k, f"{prefix}.{_name(k)}" if prefix else _name(k), x) for k, x in v.items()]
            elif type(v) is list and (many or any(type(x) in (dict, list) for x in v)):
                arrays.append((prefix, v))
            elif v is not None:
                attrs[prefix] = _text(v)
        yield path, label, attrs
        for prefix, entries in arrays:
            at = (f"{path}.{prefix}" if prefix else path) + "[]"
            nodes += [(entry, at, (*label, i)) for i, entry in enumerate(entries) if entry is not None]


def _clean(texts: list[str]) -> list[str]:
    """Texts in which unpaired surrogates are replaced (a JSON escape may name them, UTF-8 can't hold them)."""
    return [x.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace") for x in texts]


def _strings(texts: list[str]):
    import pyarrow as pa

    try:
        return pa.array(texts, pa.string())
    except UnicodeEncodeError:
        return pa.array(_clean(texts), pa.string())


def dewey_nodes(df: DataFrame, keys: list[str], text_col: str, repeated: set[str], refused: bool = False) -> DataFrame:
    """All nodes of the JSON texts in ``text_col``: ``keys``, ``schema_path``, ``label``, ``attrs``.

    ``repeated`` names the fields that are arrays by meaning, so that an object (or JSON inside a string) in such a
    place counts as its entry 0.  Arrays of plain values elsewhere stay attributes, as JSON text.  With ``refused``, a
    text that isn't null and can't be read gives one row of the schema path ``REFUSED`` and its reason.

    Defined results: null entries keep their ordinal but give no node; null texts and texts that aren't JSON as a
    whole (also NaN, trailing text, nesting of many thousand levels) give no nodes; a scalar root gives the root node
    alone; whole numbers of any length are kept digit by digit; unpaired surrogates become U+FFFD; dots, brackets and
    backslashes in field names are escaped by a backslash, so no two fields share a name; of a field given twice the
    last counts; repeated rows give repeated nodes; columns other than ``keys`` and ``text_col`` are never read; a key
    named like a node column keeps its name and the node column gets ``_node`` behind it.
    """
    names = frozenset(repeated)
    text = "__text"
    src = df.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col(text_col).alias(text))
    schema = T.StructType([*(T.StructField(f"__k{i}", df.schema[k].dataType) for i, k in enumerate(keys)), *_NODE])

    def parse(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            rows, paths, ordinals, label_ends, fields, values, attr_ends = [], [], [], [0], [], [], [0]

            def flush(batch=batch):
                at = pa.array(rows, pa.int32())
                ends = lambda x: pa.array(np.array(x, "int32"))
                cols = [batch.column(i).take(at) for i in range(len(keys))]
                cols += [_strings(paths), pa.ListArray.from_arrays(ends(label_ends), pa.array(np.array(ordinals, "int32"))), pa.MapArray.from_arrays(ends(attr_ends), _strings(fields), _strings(values))]
                out = pa.RecordBatch.from_arrays(cols, names=schema.names)
                for x in (rows, paths, ordinals, fields, values):
                    x.clear()
                del label_ends[1:], attr_ends[1:]
                return out

            def add(row, path, label, own):
                rows.append(row)
                paths.append(path)
                ordinals.extend(label)
                label_ends.append(len(ordinals))
                fields.extend(own)
                values.extend(own.values())
                attr_ends.append(len(fields))

            for row, t in enumerate(batch.column(len(keys))):
                value, reason = read_with_reason(t.as_py())
                if reason:
                    if refused and reason != "null":
                        add(row, REFUSED, (), {"reason": reason})
                    continue
                for node in _walk(value, names):
                    add(row, *node)
                    if len(rows) >= _BATCH_NODES or len(ordinals) >= _BATCH_ORDINALS:
                        yield flush()
            if rows:
                yield flush()

    nodes = src.mapInArrow(parse, schema)
    own = [F.col(f.name).alias(f.name + "_node" if f.name in keys else f.name) for f in _NODE]
    return nodes.select(*[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)], *own)


def parent_label(label: str = "label") -> Column:
    """A node's parent, by truncation; null for the root."""
    c = F.col(label)
    return F.when(F.size(c) > 0, F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))))


def node_table(nodes: DataFrame, schema_path: str) -> DataFrame:
    """The flat table of one schema path (a regular expression over the whole path), with ``parent`` links."""
    return nodes.where(F.col("schema_path").rlike(f"^(?:{schema_path})$")).withColumn("parent", parent_label())


def distinct_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """``df.select(cols)`` without repeated rows.  Each column is read once; equal rows meet by the hash of the whole row
    and combine before the shuffle, so neither a hot key nor a row repeated many times makes a large task."""
    return df.select(*cols).distinct()


# ---- reflections of theoretical patterns ----------------------------------------------------------------------------

#: Fields of a pattern text that are arrays by meaning, under all the names that program versions gave them.
REFLECTION_LEVELS = {"lines", "families", "hkl_families", "equivalents", "members"}
LINE_PATHS = r"\$\[\]|\$\.(?:[^\[\]]*\.)?lines\[\]"
FAMILY_PATHS = rf"(?:{LINE_PATHS})\.(?:hkl_)?families\[\]"
MEMBER_PATHS = rf"{FAMILY_PATHS}\.(?:equivalents|members)\[\]"


def miller_indices(attrs: Column) -> Column:
    """``array(h, k, l)`` of an entry, however it writes them; null where it has none.

    Own fields ``h, k, l``, a field ``hkl`` (array, object or text), or the entry itself being an array or text; of
    four indices the third is dropped.
    """
    number = F.lit(r"[+-]?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?")
    whole = lambda x: x.try_cast("double").try_cast("int")
    own = F.array(*[whole(F.coalesce(attrs[n], attrs[f"hkl.{n}"])) for n in "hkl"])
    listed = F.transform(F.regexp_extract_all(F.coalesce(attrs["hkl"], attrs[""], F.lit("")), number, F.lit(0)), whole)
    listed = F.when(F.size(listed) == 4, F.array(listed[0], listed[1], listed[3])).when(F.size(listed) == 3, listed)
    return F.when(own[0].isNotNull() & own[1].isNotNull() & own[2].isNotNull(), own).otherwise(listed)


def _pattern_nodes(patterns: DataFrame, refused: bool = False) -> DataFrame:
    return dewey_nodes(distinct_rows(patterns, ["id", "cod_id", "reflections"]), ["id", "cod_id"], "reflections", REFLECTION_LEVELS, refused)


def refused_patterns(patterns: DataFrame) -> DataFrame:
    """``id, cod_id, reason`` of the pattern rows whose text can't be read (null texts are no texts)."""
    return _pattern_nodes(patterns, True).where(F.col("schema_path") == REFUSED).select("id", "cod_id", F.col("attrs")["reason"].alias("reason"))


def reflection_nodes(patterns: DataFrame) -> DataFrame:
    """One node per line, family and equivalent of each distinct pattern row, with places and indices.

    Columns ``id, cod_id, level ('line', 'family', 'member'), label, parent, line_no, family_no, member_no, h, k, l,
    attrs``; a place that does not apply is -1.
    """
    nodes = _pattern_nodes(patterns)
    path = F.col("schema_path")
    level = F.when(path.rlike(f"^(?:{LINE_PATHS})$"), "line").when(path.rlike(f"^(?:{FAMILY_PATHS})$"), "family").when(path.rlike(f"^(?:{MEMBER_PATHS})$"), "member")
    place = lambda i: F.coalesce(F.try_element_at("label", F.lit(i)), F.lit(-1))
    hkl = F.col("hkl")
    return (
        nodes.withColumn("level", level)
        .where(F.col("level").isNotNull())
        .withColumn("hkl", miller_indices(F.col("attrs")))
        .select("id", "cod_id", "level", "label", parent_label().alias("parent"), place(1).alias("line_no"), place(2).alias("family_no"), place(3).alias("member_no"), hkl[0].alias("h"), hkl[1].alias("k"), hkl[2].alias("l"), "attrs")
    )


def reflection_tables(patterns: DataFrame) -> dict[str, DataFrame]:
    """The flat tables ``lines``, ``families`` and ``equivalents``; ``(id, cod_id, label)`` is each row's key and
    ``(id, cod_id, parent)`` the key of the row above it."""
    nodes = reflection_nodes(patterns)
    num = lambda k: F.col("attrs")[k].try_cast("double")
    keys = ["id", "cod_id", "label", "parent"]
    return {
        "lines": nodes.where("level = 'line'").select(*keys, "line_no", "h", "k", "l", num("d_hkl").alias("d_hkl"), num("two_theta").alias("two_theta"), num("multiplicity").cast("int").alias("multiplicity"), num("intensity_rel").alias("intensity_rel"), num("profile.fwhm").alias("fwhm"), num("profile.shape.eta").alias("eta")),
        "families": nodes.where("level = 'family'").select(*keys, "line_no", "family_no", "h", "k", "l", num("multiplicity").cast("int").alias("multiplicity"), F.col("attrs")["phase.origin"].alias("phase_origin")),
        "equivalents": nodes.where("level = 'member'").select(*keys, "line_no", "family_no", "member_no", "h", "k", "l"),
    }


def family_multiplicities(patterns: DataFrame) -> DataFrame:
    """``id, cod_id, line_no, n_families, multiplicity`` of every line that has families: the sum of theirs."""
    m = F.col("attrs")["multiplicity"].try_cast("double").cast("int")
    families = reflection_nodes(patterns).where("level = 'family'")
    return families.groupBy("id", "cod_id", "line_no").agg(F.count(F.lit(1)).alias("n_families"), F.sum(m).alias("multiplicity"))
