"""MySQL table definitions to Spark schemas."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

_SIMPLE = {
    "tinyint": T.ShortType(), "smallint": T.ShortType(), "mediumint": T.IntegerType(), "int": T.IntegerType(), "integer": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "float": T.FloatType(), "real": T.DoubleType(), "datetime": T.TimestampNTZType(), "timestamp": T.TimestampNTZType(), "date": T.DateType(),
    "year": T.ShortType(), "bool": T.BooleanType(), "boolean": T.BooleanType(), "bit": T.BooleanType(),
}
_WIDER = {"tinyint": T.ShortType(), "smallint": T.IntegerType(), "mediumint": T.IntegerType(), "int": T.LongType(), "integer": T.LongType(), "bigint": T.DecimalType(20, 0)}


@dataclass
class Table:
    """A table definition: Spark schema, keys and the values that enum and set columns allow."""

    schema: T.StructType
    primary_key: list[str] = field(default_factory=list)
    unique: list[list[str]] = field(default_factory=list)
    indexes: list[list[str]] = field(default_factory=list)
    fulltext: list[list[str]] = field(default_factory=list)
    allowed: dict[str, list[str]] = field(default_factory=dict)


def split_top(text: str, sep: str = ",") -> list[str]:
    """Parts of ``text`` between separators outside quotes and brackets."""
    parts, depth, quote, start, i = [], 0, "", 0, 0
    while i < len(text):
        c = text[i]
        if quote:
            if c == "\\" and quote != "`":
                i += 1
            elif c == quote:
                quote = ""
        elif c in "'\"`":
            quote = c
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
            if depth < 0:
                break
        elif c == sep and not depth:
            parts.append(text[start:i].strip())
            start = i + 1
        i += 1
    return [p for p in (*parts, text[start:i].strip()) if p]


def _without_comments(sql: str) -> str:
    quoted = r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`"
    return re.sub(rf"({quoted})|/\*.*?\*/|(?:--[ \t]|\#)[^\n]*", lambda m: m[1] or " ", sql, flags=re.S)


def _names(text: str) -> list[str]:
    return [re.sub(r"\(\d+\)|\s+(?:asc|desc)$", "", x.strip(), flags=re.I).strip("` ") for x in split_top(text)]


def _type(spec: str) -> tuple[T.DataType, list[str]]:
    m = re.match(r"([a-z]+)\s*(\((?:[^()'\"]|'(?:[^'\\]|\\.|'')*'|\"[^\"]*\")*\))?", spec, re.I)
    base, args = m[1].lower(), (m[2] or "()")[1:-1]
    if base in ("enum", "set"):
        return T.StringType(), [re.sub(r"''", "'", x.strip()[1:-1]) for x in split_top(args)]
    if base in ("decimal", "numeric"):
        p = [int(x) for x in args.split(",") if x.strip()] or [10]
        return T.DecimalType(p[0], p[1] if len(p) > 1 else 0), []
    if base.endswith("blob") or base in ("binary", "varbinary"):
        return T.BinaryType(), []
    if re.search(r"\bunsigned\b", spec, re.I) and base in _WIDER:
        return _WIDER[base], []
    return _SIMPLE.get(base, T.StringType()), []


def read_ddl(sql: str) -> dict[str, Table]:
    """Tables defined in a MySQL dump.  Quotes are understood, so brackets or commas in comments and defaults do no
    harm; unsigned types are widened; constraints are left out."""
    text = _without_comments(sql)
    out = {}
    for m in re.finditer(r"create\s+table\s+(?:if\s+not\s+exists\s+)?`?([\w.]+)`?\s*\(", text, re.I):
        t = Table(T.StructType())
        for item in split_top(text[m.end() :]):
            key = re.match(r"(primary\s+key|unique(?:\s+(?:key|index))?|fulltext(?:\s+(?:key|index))?|key|index|constraint|foreign\s+key|check|spatial\s+key)\b", item, re.I)
            if key and not item.startswith("`"):
                kind = key[1].lower().split()[0]
                inner = re.search(r"\((.*)\)", item, re.S)
                names = _names(inner[1]) if inner else []
                if kind == "primary":
                    t.primary_key = names
                elif kind in ("unique", "fulltext", "key", "index") and names:
                    {"unique": t.unique, "fulltext": t.fulltext}.get(kind, t.indexes).append(names)
                continue
            c = re.match(r"(`[^`]+`|\w+)\s+(.*)", item, re.S)
            if c:
                name = c[1].strip("`")
                kind, values = _type(c[2])
                t.schema.add(T.StructField(name, kind, not re.search(r"\bnot\s+null\b|\bprimary\s+key\b", re.sub(r"'(?:[^'\\]|\\.)*'", "", c[2]), re.I)))
                if values:
                    t.allowed[name] = values
                if re.search(r"\bprimary\s+key\b", re.sub(r"'(?:[^'\\]|\\.)*'", "", c[2]), re.I):
                    t.primary_key = [name]
        out[m[1].split(".")[-1]] = t
    return out
