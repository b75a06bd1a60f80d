"""Cells of flattened notebooks: from documents and cell positions to cell texts.

Each text is joined once with the (small) array of its cells' positions, so a long text is not repeated per cell, and
cutting happens inside the Arrow map that uses the cells.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_cells(docs: DataFrame, cells: DataFrame, extra: list[str] | None = None, where: Column | None = None) -> DataFrame:
    """``doc_id, text, layout, *extra, cells`` for every document that has cells.

    ``cells`` is an array of (cell_no, start_char, length) in no order; ``where`` selects cells.  Repeated cell rows
    count once, repeated document rows repeat their result; null ids and positions are left out.
    """
    own = cells if where is None else cells.where(where)
    own = own.where("doc_id IS NOT NULL AND start_char IS NOT NULL AND length IS NOT NULL")
    arrays = own.withColumn("doc_id", F.col("doc_id").cast("bigint")).groupBy("doc_id").agg(F.collect_set(F.struct("cell_no", "start_char", "length")).alias("cells"))
    return docs.where(F.length("text") > 0).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "layout", *(extra or [])).join(arrays, "doc_id")


def is_json(text: str, layout: str | None) -> bool:
    """Whether a document is a notebook file as JSON; told from the text where the layout is not known."""
    return layout == "json" or (layout is None and text.lstrip()[:1] == "{" and '"cells"' in text)


def decoded(piece: str) -> str:
    """The text of a cell of the JSON layout: an array of lines (or one string); anything else stays as it is."""
    try:
        v = json.loads(piece)
    except (ValueError, RecursionError):
        return piece
    if isinstance(v, list):
        return "".join(x for x in v if isinstance(x, str))
    return v if isinstance(v, str) else piece


def iter_cells(batch):
    """Yields (row, cell_no, cell text) over an Arrow batch with columns text, layout, cells."""
    texts, layouts = batch.column("text"), batch.column("layout")
    lists = batch.column("cells")
    ends = lists.offsets.to_pylist()
    flat = lists.values
    no, start, length = (flat.field(i).to_pylist() for i in range(3))
    for row in range(len(batch)):
        text = texts[row].as_py()
        js = is_json(text, layouts[row].as_py())
        for i in range(ends[row], ends[row + 1]):
            piece = text[start[i] : start[i] + length[i]]
            yield row, no[i], decoded(piece) if js else piece
