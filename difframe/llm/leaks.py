"""Evaluation texts leaking into training text, by template windows.

Words are made canonical: numbers, units and names become typed placeholders, other words stay.  All windows of
``width`` canonical words get a template hash.  Corpus windows meet evaluation windows in a hash join on the template
alone; then their slots are compared: equal words in all slots mean a verbatim passage, a consistent renaming means the
same question with other parameters.

For renamed questions a run of words of one type is one placeholder (``324`` and ``3.5``, ``five`` and ``twenty five``,
names of any number of words), and names are words with the ending of a substance or, in a second reading of each
text, capitalised words inside a sentence.

Before the join, corpus windows whose template can't occur in the evaluation set are dropped inside the Arrow map, by a
Bloom filter that Spark builds from the evaluation windows.  Its size follows their number up to ``FILTER_BITS``; more
windows make it less selective, never wrong, and the plan is the same at every size.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from difframe.llm.notebooks import iter_cells, with_cells
from difframe.runtime import small, staged

#: Consecutive words that make a leak.
WIDTH = 12
#: The Bloom filter of evaluation templates has 2 ** bits bits: 256 a window, at least 2 ** 16, at most 2 ** FILTER_BITS.
FILTER_BITS = 27

# Words that stand for numbers and units.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million half "
    "first second third fourth fifth sixth seventh eighth ninth tenth eleventh twelfth".split()
)
UNITS = frozenset(
    "percent kelvin celsius degree degrees bar bars pascal kilopascal megapascal gigapascal volt volts watt watts joule joules hertz "
    "gram grams kilogram kilograms milligram milligrams microgram micrograms metre metres meter meters millimetre millimetres nanometre nanometres angstrom angstroms "
    "litre litres second seconds minute minutes hour hours day days week weeks month months year years k kg g mg mm cm nm ml".split()
)
# Endings of names of minerals and compounds.
_NAME = re.compile(r"[^\W\d_]{4,}(?:ite|ine|ide|ate|ane|ene|yne|one|ium|ole|spar)")
_WORD = re.compile(r"[^\W_]+")
# A capital behind a word and a blank (and a comma) begins a name; the mark is a letter that no text should hold.
_CAPITAL, _MARK = re.compile(r"([^\W_],? )(?=[A-ZÀ-ÖØ-ÞΑ-ΩА-Я])"), "\ua66e"
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


WINDOW = "template bigint, check bigint, reading int, at int, word_at int, slots array<string>"


def words(text: str) -> list[str]:
    """Runs of letters and digits, in lower case."""
    return _WORD.findall(text.lower())


@lru_cache(maxsize=200_000)
def placeholder(word: str) -> str:
    """The canonical form of a word: itself or a typed placeholder; a marked word is a name."""
    if word[0] == _MARK:
        return "<name>"
    if word[0].isdigit() or word in NUMBER_WORDS:
        return "<number>"
    if word in UNITS:
        return "<unit>"
    return "<name>" if _NAME.fullmatch(word) else word


class _Codes(dict):
    """64-bit code of a word's canonical form, remembered per word; codes of placeholders are even, others odd."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        p = placeholder(word)
        code = xxhash.xxh64_intdigest(p)
        code = self[word] = code & ~1 if p != word and p[0] == "<" else code | 1
        return code


def window_hashes(codes, width: int, multiplier: int = _MULTIPLIERS[0]):
    """Polynomial hashes (mod 2^64) of all windows of ``width`` codes."""
    import numpy as np

    n = len(codes) - width + 1
    if n <= 0:
        return np.empty(0, "uint64")
    h = np.zeros(n, "uint64")
    for j in range(width):
        h *= np.uint64(multiplier)
        h += codes[j : j + n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _readings(text: str, runs: bool, codes: _Codes):
    """Yields (reading, words, codes): the plain reading and, with ``runs``, one with marked names if the text has capitals
    inside.  The text is cut into words once; the plain reading differs at the marked words only."""
    import numpy as np

    marked = _CAPITAL.sub(r"\1" + _MARK, text.replace(_MARK, "")) if runs else text
    w = words(marked)
    c = np.fromiter(map(codes.__getitem__, w), "uint64", len(w))
    if _MARK not in marked:
        yield 0, w, c
        return
    plain, own = w.copy(), c.copy()
    for i in np.flatnonzero(c == codes[_MARK]).tolist():
        if w[i][0] == _MARK:
            plain[i] = w[i][1:]
            own[i] = codes[plain[i]]
    yield 0, plain, own
    yield 1, w, c


def _windows(text: str, width: int, runs: bool, codes: _Codes, passes=None):
    """Yields (reading, templates, checks, places, word places, slots) of the windows of a text that ``passes`` lets
    through.  Slots are placeholder and words, joined."""
    import numpy as np

    for reading, w, c in _readings(text, runs, codes):
        if len(w) < width:
            continue
        starts = np.arange(len(c))
        if runs:  # a run of one type is one placeholder
            again = np.zeros(len(c), bool)
            again[1:] = (c[1:] == c[:-1]) & (c[1:] & np.uint64(1) == 0)
            starts = np.flatnonzero(~again)
            c = c[starts]
        h = window_hashes(c, width)
        at = np.arange(len(h)) if passes is None else passes(h)
        if not len(at):
            continue
        check = np.zeros(len(at), "uint64")
        for j in range(width):
            check *= np.uint64(_MULTIPLIERS[1])
            check += c[at + j]
        ends = np.append(starts[1:], len(w))
        slots = []
        for i in at.tolist():
            own = []
            for j in range(i, i + width):
                p = placeholder(w[starts[j]])
                if p != w[starts[j]]:
                    own.append(f"{p}{' '.join(x.removeprefix(_MARK) for x in w[starts[j] : ends[j]])}")
            slots.append(own)
        yield reading, h[at].view("int64"), check.view("int64"), at, starts[at], slots


def _arrow_windows(pieces_of, n_keys: int, schema, width: int, runs: bool, sent=None):
    """An Arrow map from batches to window rows; ``pieces_of`` yields ((key values), text) of a batch."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        codes, passes = _Codes(), None
        if sent is not None:
            bits, table = sent.value
            table = np.frombuffer(table, "uint64")
            some = table.view("uint8") != 0  # whether any of eight places in a row is set: one look for most windows
            coarse, top, low, mask = (np.uint64(x) for x in (64 - bits + 3, 64 - bits, 64 - 2 * bits, (1 << bits) - 1))
            hit = lambda p: (table[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1

            def passes(h):
                at = np.flatnonzero(some[h >> coarse])
                at = at[hit(h[at] >> top)]
                return at[hit((h[at] >> low) & mask)]

        def flush(out):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

        for batch in batches:
            out = [[] for _ in schema]
            for key, text in pieces_of(batch):
                for reading, h, check, at, word_at, slots in _windows(text, width, runs, codes, passes):
                    for c, v in zip(out, (*key, None, None, reading), strict=False):
                        if v is not None:
                            c.extend([v] * len(at))
                    for c, v in zip(out[n_keys:], (h, check, None, at, word_at), strict=False):
                        if v is not None:
                            c.extend(v.tolist())
                    out[-1].extend(slots)
                if len(out[-1]) > 20_000:
                    yield flush(out)
                    out = [[] for _ in schema]
            if out[-1]:
                yield flush(out)

    return run


def _schema(*keys):
    import pyarrow as pa

    return pa.schema([*keys, ("template", pa.int64()), ("check", pa.int64()), ("reading", pa.int32()), ("at", pa.int32()), ("word_at", pa.int32()), ("slots", pa.list_(pa.string()))])


def eval_windows(items: DataFrame, width: int = WIDTH, runs: bool = False) -> DataFrame:
    """``item_id, field`` and the windows of the items' questions and answers."""
    import pyarrow as pa

    texts = items.select("item_id", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in ("question", "answer")])).alias("x")).select("item_id", "x.field", "x.text").where("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    id_type = items.schema["item_id"].dataType.simpleString()
    kind = {"int": pa.int32(), "bigint": pa.int64(), "smallint": pa.int16(), "string": pa.string()}[id_type]

    def pieces(batch):
        for i, f, t in zip(*(batch.column(c).to_pylist() for c in ("item_id", "field", "text")), strict=True):
            yield (i, f), t

    return texts.mapInArrow(_arrow_windows(pieces, 2, _schema(("item_id", kind), ("field", pa.string())), width, runs), f"item_id {id_type}, field string, {WINDOW}")


def template_filter(windows: DataFrame, most_bits: int = FILTER_BITS) -> tuple[int, bytes]:
    """(bits, table) of a Bloom filter over the ``template`` of windows: two places a template, 2 ** bits places in all.

    The places are set by Spark as 64-bit words, so at most 2 ** (bits - 6) words reach the driver.
    """
    import numpy as np

    bits = min(most_bits, max(16, (256 * max(windows.count(), 1) - 1).bit_length()))
    t = F.col("template")
    places = F.array(F.shiftrightunsigned(t, 64 - bits), F.shiftrightunsigned(t, 64 - 2 * bits).bitwiseAND(F.lit((1 << bits) - 1)))
    set_ = windows.select(F.explode(places).alias("p")).select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, CAST(p & 63 AS INT))").alias("bit"))
    found = set_.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros(1 << (bits - 6), "int64")
    table[found["word"].to_numpy("int64")] = found["bits"].to_numpy("int64")
    return bits, table.tobytes()


def corpus_windows(docs: DataFrame, cells: DataFrame, width: int = WIDTH, runs: bool = False, passing: tuple[int, bytes] | None = None) -> DataFrame:
    """``doc_id, cell_no`` and the windows of every cell; only those that pass a ``template_filter``, if given."""
    import pyarrow as pa

    sent = None if passing is None else docs.sparkSession.sparkContext.broadcast(passing)

    def pieces(batch):
        ids = batch.column("doc_id").to_pylist()
        for row, no, text in iter_cells(batch):
            yield (ids[row], no), text

    return with_cells(docs, cells).mapInArrow(_arrow_windows(pieces, 2, _schema(("doc_id", pa.int64()), ("cell_no", pa.int32())), width, runs, sent), f"doc_id bigint, cell_no int, {WINDOW}")


def template_matches(docs: DataFrame, cells: DataFrame, items: DataFrame, width: int = WIDTH, runs: bool = False, slots: Column | None = None) -> DataFrame:
    """Every pair of a corpus window and an evaluation window of one template whose slots satisfy ``slots`` (of
    ``slots`` and ``item_slots``).

    ``doc_id, cell_no, reading, at, word_at, slots, item_id, field, item_reading, item_at, item_slots``.
    """
    known = staged(eval_windows(items, width, runs), "eval-windows")
    corpus = corpus_windows(docs, cells, width, runs, template_filter(known))
    evals = known.select(F.col("template").alias("item_template"), F.col("check").alias("item_check"), "item_id", "field", F.col("reading").alias("item_reading"), F.col("at").alias("item_at"), F.col("slots").alias("item_slots"))
    on = (F.col("template") == F.col("item_template")) & (F.col("check") == F.col("item_check"))
    return corpus.join(small(evals), on if slots is None else on & slots).drop("template", "check", "item_template", "item_check")


def verbatim_leaks(docs: DataFrame, cells: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, item_id, field, cell_no, n_windows, first_at``: cells that hold ``width`` or more consecutive words
    of an item's question or answer: windows of one template with the same words in all slots.

    Defined results: items whose texts are shorter than ``width`` words cannot leak; null or empty texts, questions
    and answers give nothing, nor do null ids; a passage across two cells does not count; repeated rows count once;
    empty tables give an empty table.  Only the named columns are read.
    """
    same = template_matches(docs, cells, items, width, slots=F.col("slots") == F.col("item_slots"))
    return same.groupBy("doc_id", "item_id", "field", "cell_no").agg(F.size(F.collect_set("at")).alias("n_windows"), F.min("at").alias("first_at"))


def renamed_items(docs: DataFrame, cells: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Questions that come back with other numbers, names or units, one row per passage and item.

    ``doc_id, cell_no, first_at, n_windows, item_id, n_items, n_changed, best``: a passage of a cell that follows an item's
    text word by word but for slots, which are renamed consistently within every ``width`` words (a run of slot words
    counts as one): the same slot always to the same words, and different names to different names.  A passage is a run
    of such windows; ``first_at`` is the place of its first word.  Of the ``n_items`` items it follows, ``best`` marks
    the one followed longest, then with the fewest renamed slots, then the smallest id.  Defined results otherwise as
    in ``verbatim_leaks``.
    """
    m = template_matches(docs, cells, items, width, runs=True)
    pairs = F.array_distinct(F.zip_with("item_slots", "slots", lambda a, b: F.struct(a.alias("a"), b.alias("b"))))
    part = lambda c, x: F.array_distinct(F.transform(c, lambda p: p[x]))
    names = F.filter("pairs", lambda p: p["a"].startswith("<name>"))
    m = m.select("doc_id", "cell_no", "item_id", "field", "reading", "item_reading", (F.col("at") - F.col("item_at")).alias("shift"), "at", "word_at", pairs.alias("pairs"))
    m = m.where((F.size(part("pairs", "a")) == F.size("pairs")) & (F.size(part(names, "b")) == F.size(names)))
    # Only renamed slots travel.  One aggregate with partial results: a passage's windows combine before the shuffle.
    m = m.withColumn("pairs", F.filter("pairs", lambda p: p["a"] != p["b"]))
    line = ["doc_id", "cell_no", "item_id", "field", "reading", "item_reading", "shift"]
    runs = m.groupBy(*line).agg(F.array_sort(F.collect_set("at")).alias("ats"), F.collect_set(F.struct("at", "word_at", "pairs")).alias("w"))
    # Consecutive windows keep their distance to their place in the order.  Grouped by more keys: no second shuffle.
    runs = runs.select(*line, "ats", F.explode("w").alias("w")).withColumn("run", F.col("w.at") - F.array_position("ats", F.col("w.at")))
    runs = runs.groupBy(*line, "run").agg(F.min("w.word_at").alias("first_at"), F.size(F.collect_set("w.at")).alias("n_windows"), F.size(F.array_distinct(F.flatten(F.collect_set("w.pairs")))).alias("n_changed"))
    fits = runs.where("n_changed > 0")
    each = fits.groupBy("doc_id", "cell_no", "first_at", "item_id").agg(F.min(F.struct((-F.col("n_windows")).alias("w"), "n_changed")).alias("r"))
    passage = Window.partitionBy("doc_id", "cell_no", "first_at")
    best = F.row_number().over(passage.orderBy("r", "item_id")) == 1
    return each.select("doc_id", "cell_no", "first_at", (-F.col("r.w")).alias("n_windows"), "item_id", F.count(F.lit(1)).over(passage).cast("int").alias("n_items"), "r.n_changed", best.alias("best"))


def renamed_leaks(docs: DataFrame, cells: DataFrame, items: DataFrame, width: int = WIDTH) -> DataFrame:
    """The best item of every passage of ``renamed_items``: one row per passage."""
    return renamed_items(docs, cells, items, width).where("best").drop("best")
