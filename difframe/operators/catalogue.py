"""The documented catalogue queries as functions over the structure table (``file`` is the structure's number)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from difframe.functions.crystal import crystal_system
from difframe.operators.relational import top_ranked


def clean(radiation: str = "X-ray") -> Column:
    """Public, unflagged experimental records with coordinates."""
    return F.col("status").isNull() & F.col("onhold").isNull() & (F.col("radiation") == radiation) & F.coalesce(F.col("method") != "theoretical", F.lit(True)) & F.contains("flags", F.lit("has coordinates"))


def ambient() -> Column:
    """Measured at room temperature and low pressure, as far as told."""
    return (F.col("celltemp").isNull() | F.col("celltemp").between(250, 320)) & (F.col("cellpressure").isNull() | (F.col("cellpressure") < 200))


def good_fit(robs: float = 0.08, rfsqd: float = 0.10) -> Column:
    return (F.col("robs") < robs) | (F.col("robs").isNull() & (F.col("rfsqd") < rfsqd))


def near_cell(columns: tuple[str, ...] = ("a", "b", "c"), tolerance: float = 0.01, prefix: str = "q_") -> Column:
    """Cell lengths within ``tolerance`` of those in ``prefix`` columns."""
    return reduce(lambda x, y: x & y, [F.col(c).between(F.col(prefix + c) * (1 - tolerance), F.col(prefix + c) * (1 + tolerance)) for c in columns])


def well_determined(relative: float = 0.005) -> Column:
    """A volume of small relative error; null where the error is not told."""
    return F.try_divide(F.col("sigvol"), F.col("vol")) < relative


def since(year: int = 1990) -> Column:
    return F.col("year") > year


def consistent(gof: float = 2.0) -> Column:
    return F.col("gofall") < gof


def cell_search(data: DataFrame, questions: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """``q, file``: structures whose three cell lengths are within ``tolerance`` of a question's (``q, a, b, c``).

    Lengths meet by bins of the logarithm of each, so no space of similar cells meets itself whole.
    """
    step = -2 * math.log(1 - tolerance)
    bin_of = lambda c: F.floor(F.log(c) / step).cast("long")
    q = questions.where("a > 0 AND b > 0 AND c > 0").select("q", *[F.col(x).alias(f"q_{x}") for x in "abc"])
    for x in "abc":
        q = q.withColumn(f"bin_{x}", F.explode(F.sequence(bin_of(F.col(f"q_{x}") * (1 - tolerance)), bin_of(F.col(f"q_{x}") * (1 + tolerance)))))
    own = data.where("a > 0 AND b > 0 AND c > 0").select("file", "a", "b", "c", *[bin_of(F.col(x)).alias(f"bin_{x}") for x in "abc"])
    return q.join(own, ["bin_a", "bin_b", "bin_c"]).where(near_cell(tolerance=tolerance)).select("q", "file")


def with_spacegroups(data: DataFrame, spacegroups: DataFrame) -> DataFrame:
    """Structures with the settings of their space group (``itcn`` and more): a number with several settings gives several
    rows, as in the catalogue's own join."""
    return data.join(spacegroups, data["sgnumber"] == spacegroups["itcn"])


def quality_listing(data: DataFrame) -> DataFrame:
    return data.where(clean() & good_fit())


def by_system(data: DataFrame, system: str) -> DataFrame:
    return data.where(F.col("status").isNull() & (F.col("radiation") == "X-ray") & (crystal_system("sgnumber") == system))


def phase_search(data: DataFrame, questions: DataFrame, tolerance: float = 0.02, top: int = 20) -> DataFrame:
    """``q, file, k``: for every question (``q, sgnumber, vol``) the ``top`` clean ambient structures of its space
    group within ``tolerance`` of its volume, by R factor (nulls last), then number.

    Volumes meet by bins of their logarithm, so a space group with many structures does not meet itself whole.
    """
    bin_of = lambda c: F.floor(F.log(c) / (2 * tolerance)).cast("long")
    q = questions.where("vol > 0").select("q", "sgnumber", (F.col("vol") * (1 - tolerance)).alias("lo"), (F.col("vol") * (1 + tolerance)).alias("hi"))
    q = q.withColumn("bin", F.explode(F.sequence(bin_of(F.col("lo")), bin_of(F.col("hi")))))
    own = data.where(clean() & ambient() & (F.col("vol") > 0)).select("file", "sgnumber", "vol", "robs", bin_of(F.col("vol")).alias("bin"))
    return top_ranked(q.join(own, ["sgnumber", "bin"]).where("vol BETWEEN lo AND hi"), ["q"], [F.asc_nulls_last("robs"), F.asc("file")], top, "k").select("q", "file", "k")


def name_search(data: DataFrame, text: str, columns: tuple[str, ...] = ("mineral", "commonname", "chemname")) -> DataFrame:
    """Records with ``text`` in any of the name columns, whatever its case."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(c), F.lit(text.lower())), F.lit(False))
    return data.where(hit)


def stems(text: str | Column) -> Column:
    """Lower-case words with common endings cut off: an approximation of stemming."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0)), lambda w: F.regexp_replace(w, "(ing|ed|es|s)$", ""))


def text_search(data: DataFrame, column: str, question: str) -> DataFrame:
    """Records whose ``column`` holds all words of the question."""
    return data.where(F.size(F.array_except(stems(F.lit(question)), stems(F.col(column)))) == 0)


def powder_structures(data: DataFrame, low: float = 1.5, high: float = 1.6) -> DataFrame:
    return data.where((F.col("method") == "powder diffraction") & F.col("status").isNull() & F.col("wavelength").between(low, high))


def density_proxy() -> Column:
    return F.try_divide(F.col("z").cast("double"), F.col("vol"))


def doi_link() -> Column:
    return F.concat(F.lit("https://doi.org/"), F.col("doi"))


def cross_links(found: DataFrame, references: DataFrame, url: str) -> DataFrame:
    """``file, ext_id, link`` from a cross-reference table (``ext_id, cod_id, relation_id``); ``url`` ends where the id goes."""
    ids = references.select(F.col("cod_id").alias("file"), "ext_id")
    return found.select("file").join(ids, "file").withColumn("link", F.concat(F.lit(url), F.col("ext_id").cast("string")))


def canonical(data: DataFrame) -> DataFrame:
    """``file, canonical``: the record that stands for each structure, if it exists, else itself."""
    own = data.select("file", F.coalesce("duplicateof", "optimal").alias("other"))
    return own.join(data.select(F.col("file").alias("other"), F.col("file").alias("found")), "other", "left").select("file", F.coalesce("found", "file").alias("canonical"))


def similar_bits(words: DataFrame, questions: DataFrame, word_columns: list[str], top: int = 5) -> DataFrame:
    """``q, other, similarity``: Tanimoto of bit fingerprints kept as 64-bit words, for a set of questions.

    ``words`` has ``id`` and the word columns; ``questions`` ``q`` and the same.  Questions travel in blocks; each
    task keeps ``top`` rows per question before the shuffle.
    """
    blocks = -(-questions.count() // 1000) or 1
    q = questions.select(F.struct("q", F.array(*word_columns).alias("w")).alias("x")).withColumn("block", F.pmod(F.xxhash64("x.q"), F.lit(blocks)).cast("int")).groupBy("block").agg(F.collect_list("x").alias("xs"))
    own = words.select("id", F.array(*word_columns).alias("w")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    from difframe.runtime import small

    hits = own.join(small(q), "block").select("id", "w", F.explode("xs").alias("x")).where("id <> x.q")
    count = lambda op: F.aggregate(F.zip_with("w", "x.w", op), F.lit(0), lambda s, v: s + F.bit_count(v))
    s = F.try_divide(count(lambda a, b: a.bitwiseAND(b)).cast("double"), count(lambda a, b: a.bitwiseOR(b)))
    return top_ranked(hits.select("x.q", F.col("id").alias("other"), s.alias("similarity")), ["q"], [F.desc("similarity"), F.asc("other")], top, "k").select("q", "other", "similarity")
