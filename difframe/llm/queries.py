"""Queries of the training-data operators and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from difframe.llm.langid import detect_languages
from difframe.llm.leaks import renamed_items, verbatim_leaks
from difframe.llm.names import link_spellings, spelling_pairs
from difframe.llm.tokenize import decode_corpus, encode_corpus
from difframe.llm.topn import top_n_per_group
from difframe.runtime import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


@query(
    "p2_found",
    """SELECT cod_id, id FROM (
         SELECT cod_id, id, row_number() OVER (PARTITION BY cod_id
                ORDER BY calculated_at DESC NULLS LAST, n_reflections DESC NULLS LAST, id) AS k
         FROM (SELECT DISTINCT cod_id, id, calculated_at, n_reflections FROM reference_patterns))
       WHERE k <= 3""",
)
def p2_found(spark, sf_dir):
    """The three newest runs of every structure."""
    return top_n_per_group(
        table(spark, sf_dir, "reference_patterns"),
        group=["cod_id"],
        score="calculated_at",
        ties=[F.col("n_reflections").desc_nulls_last(), F.col("id").asc_nulls_last()],
        n=3,
        keep=["cod_id", "id"],
        tie_columns=["n_reflections", "id"],
    )


@query("p6_ids")
def p6_ids(spark, sf_dir):
    """Ids of every document's text by the 50k byte-level vocabulary."""
    return encode_corpus(table(spark, sf_dir, "documents"))


@query("p6_decoded", "SELECT doc_id, coalesce(text, '') AS text FROM documents")
def p6_decoded(spark, sf_dir):
    """Every document encoded and decoded again from raw bytes."""
    return decode_corpus(p6_ids(spark, sf_dir)).select("doc_id", F.col("bytes").cast("string").alias("text"))


def _notebooks(spark, sf_dir):
    return table(spark, sf_dir, "documents"), table(spark, sf_dir, "notebook_cells")


_CELL_WORDS = """SELECT doc_id, regexp_extract_all(lower(CASE WHEN js THEN array_to_string(from_json(t, '["VARCHAR"]'), '') ELSE t END), '[\\p{L}\\p{N}]+') AS w
  FROM (SELECT n.doc_id, substring(d.text, n.start_char + 1, n.length) AS t, coalesce(d.layout = 'json', d.text LIKE '{%"cells"%') AS js FROM documents d JOIN notebook_cells n ON n.doc_id = d.doc_id WHERE d.text <> '')"""


@query(
    "p7_found",
    f"""WITH c AS ({_CELL_WORDS}), e AS (SELECT item_id, regexp_extract_all(lower(unnest([question, answer])), '[\\p{{L}}\\p{{N}}]+') AS w FROM eval_items),
         ew AS (SELECT DISTINCT item_id, array_to_string(w[i:i+11], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 10)) AS i FROM e WHERE len(w) >= 12)),
         cw AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+11], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 10)) AS i FROM c WHERE len(w) >= 12))
       SELECT DISTINCT doc_id, item_id FROM cw JOIN ew USING (s)""",
)
def p7_found(spark, sf_dir):
    """Documents with a verbatim passage of an evaluation item."""
    return verbatim_leaks(*_notebooks(spark, sf_dir), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id").distinct()


@query("p7_renamed")
def p7_renamed(spark, sf_dir):
    """Passages that follow evaluation items with other numbers, names or units, and all of these items."""
    return renamed_items(*_notebooks(spark, sf_dir), table(spark, sf_dir, "eval_items"))


@query("p8_found")
def p8_found(spark, sf_dir):
    """Documents with a missing or wrong label, and text cells in another language than their document's."""
    return detect_languages(*_notebooks(spark, sf_dir), table(spark, sf_dir, "languages")).where("wrong").select("doc_id", "cell_no", "lang")


@query("p8_languages")
def p8_languages(spark, sf_dir):
    """The language of every document and text cell, with confidence."""
    out = detect_languages(*_notebooks(spark, sf_dir), table(spark, sf_dir, "languages"))
    return out.withColumn("confidence", F.round("confidence", 6))


@query("p3_found")
def p3_found(spark, sf_dir):
    """Pairs of spellings of one person or journal."""
    return spelling_pairs(link_spellings(table(spark, sf_dir, "cod_data"), {"authors": ";"}, ["journal"]))
