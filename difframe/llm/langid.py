"""Languages of notebooks and of their text cells, by error-correcting output codes.

Every language has a codeword of bits.  For each bit a binary classifier on character n-grams within words (and whole
words) says how likely the bit is set; decoding picks the language whose codeword has the least loss, bits weighted by
how well their classifiers separate the training cells.  The gap to the second-best codeword gives the confidence and
flags ambiguous cells.

The classifiers are naive log-odds over hashed features.  They are fitted on a bounded sample of labelled cells
(``sample_cells`` per language, chosen by hash); labels may be wrong, so cells that the first fit contradicts are left
out of the second.  Scoring covers every text cell: a word's score is a sum over its features, remembered per word.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from difframe.llm.notebooks import iter_cells, with_cells

#: Labelled text cells per language the classifiers are fitted on, at most.
SAMPLE_CELLS = 400
#: Hashed features, bits of a codeword, longest character n-gram.
FEATURES, BITS, GRAMS = 1 << 16, 24, 4
#: Features (about 15 to 20 letters of text) below which evidence is discounted.
FULL_EVIDENCE = 60
#: A cell of less confidence is flagged ambiguous.
AMBIGUOUS = 0.6

# The ways in which a label may name a language (ISO 639-1, 639-2 T and B, English name).
NAMES = {
    "de": ("deu", "ger", "german"),
    "en": ("eng", "english"),
    "es": ("spa", "spanish", "castilian"),
    "fr": ("fra", "fre", "french"),
    "it": ("ita", "italian"),
    "ja": ("jpn", "japanese"),
    "nl": ("nld", "dut", "dutch", "flemish"),
    "pl": ("pol", "polish"),
    "pt": ("por", "portuguese"),
    "ru": ("rus", "russian"),
    "sv": ("swe", "swedish"),
    "zh": ("zho", "chi", "chinese", "cmn"),
}

_NOT_PROSE = re.compile(
    r"```.*?(?:```|\Z)|`[^`\n]*`|\$\$.*?\$\$|\$[^$\n]*\$|!?\[[^\]\n]*\]\([^)\n]*\)|<[^<>\n]{1,200}>|data:[\w/+;=,-]+|https?://\S+|\\[A-Za-z]+"
    r"|\S*[_\d=@\\/][A-Za-z]\S*|[A-Za-z]+[(.][\w.(]*[A-Za-z0-9]|[A-Za-z]+[_\d]\w*",
    re.S,
)
_WORD = re.compile(r"[^\W\d_]+")


def label_language(label: Column) -> Column:
    """The two-letter language a label names in any form, or null."""
    forms = {form: code for code, others in NAMES.items() for form in (code, *others)}
    known = F.create_map(*[F.lit(x) for kv in sorted(forms.items()) for x in kv])
    return known[F.lower(F.regexp_extract(label, r"^\s*(\p{L}+)", 1))]


def prose_words(text: str) -> list[str]:
    """The natural-language words of a cell, in lower case: without code, formulas, links, markup and identifiers."""
    words = _WORD.findall(_NOT_PROSE.sub(" ", text).lower())
    return words or _WORD.findall(text.lower())


def word_features(word: str) -> list[int]:
    """Hashed features of a word: its n-grams with marked ends, and the word itself."""
    import zlib

    marked = f"_{word}_"
    grams = [marked[i : i + n] for n in range(1, GRAMS + 1) for i in range(len(marked) - n + 1) if marked[i : i + n] != "_"]
    return [zlib.crc32(g.encode()) % FEATURES for g in (*grams, marked)]


def codewords(n: int, bits: int = BITS):
    """``n`` codewords of ``bits`` signs, far apart: the best of many drawn with a fixed seed."""
    import numpy as np

    rnd = np.random.default_rng(0)
    best, best_gap = None, -1
    for _ in range(2000):
        code = np.where(rnd.random((n, bits)) < 0.5, 1, -1).astype("int8")
        shared = np.abs(code.sum(0)) == n
        code[rnd.integers(n), shared] *= -1  # a bit that all languages share tells nothing
        gap = min(((code[i] != code[j]).sum() for i in range(n) for j in range(i)), default=bits)
        if gap > best_gap:
            best, best_gap = code, gap
    return best


class Model:
    """The fitted classifiers: languages, codewords, feature weights per bit, weights of the bits."""

    def __init__(self, langs: list[str]):
        import numpy as np

        self.langs, self.code = langs, codewords(len(langs))
        self.weights = np.zeros((FEATURES, self.code.shape[1]), "float32")
        self.trust = np.ones(self.code.shape[1], "float32")
        self.fitted = False
        self._seen: dict[str, tuple] = {}

    def __getstate__(self):
        return {**self.__dict__, "_seen": {}}

    def fit(self, cells: list[list[str]], labels: list[str]) -> None:
        """Two rounds: all labels, then without the cells the first round contradicts."""
        import numpy as np

        at = {x: i for i, x in enumerate(self.langs)}
        y = np.array([at[x] for x in labels], "int64")
        self.fitted = len(y) > 0
        keep = np.ones(len(y), bool)
        feats = [np.array([f for w in c for f in word_features(w)], "int64") for c in cells]
        for last in (False, True):
            counts = np.full((len(self.langs), FEATURES), 1e-9)
            for i in range(len(self.langs)):
                own = [feats[j] for j in np.flatnonzero(keep & (y == i))]
                if own:
                    counts[i] += np.bincount(np.concatenate(own), minlength=FEATURES)
            share = counts / counts.sum(1, keepdims=True)
            floor = 1 / (FEATURES * 4)
            for b in range(self.code.shape[1]):
                on, off = share[self.code[:, b] > 0].mean(0), share[self.code[:, b] < 0].mean(0)
                self.weights[:, b] = np.log((on + floor) / (off + floor))
            self._seen.clear()
            margins = np.array([self.margins(c) for c in cells]) if cells else np.zeros((0, self.code.shape[1]))
            right = margins * self.code[y] > 0
            accuracy = right[keep].mean(0) if keep.any() else np.full(self.code.shape[1], 0.9)
            self.trust = np.clip(np.log((accuracy + 1e-3) / (1 - accuracy + 1e-3)), 0.1, None).astype("float32")
            self.trust /= self.trust.mean()
            if not last:
                keep = np.array([self.classify(c)[0] == x for c, x in zip(cells, labels, strict=True)], bool)
        self._seen.clear()

    def _word(self, word: str):
        got = self._seen.get(word)
        if got is None:
            if len(self._seen) > 200_000:
                self._seen.clear()
            f = word_features(word)
            got = self._seen[word] = (self.weights[f].sum(0), len(f))
        return got

    def margins(self, words: list[str]):
        """Each bit's evidence: its mean log-odds per feature; a text of few features counts as diluted."""
        import numpy as np

        total, n = np.zeros(self.code.shape[1], "float32"), 0
        for w in words:
            v, k = self._word(w)
            total, n = total + v, n + k
        return total / max(FULL_EVIDENCE, n)

    def classify(self, words: list[str]) -> tuple[str | None, float]:
        """(language, confidence); no words or no labelled cells to learn from, no language."""
        import numpy as np

        if not words or not self.fitted:
            return None, 0.0
        loss = (self.trust * np.logaddexp(0, -self.code * self.margins(words))).sum(1)
        p = np.exp(loss.min() - loss)
        best = int(loss.argmin())
        return self.langs[best], float(p[best] / p.sum())


def fit_languages(docs: DataFrame, cells: DataFrame, langs: list[str], sample_cells: int = SAMPLE_CELLS) -> Model:
    """Fits the classifiers on at most ``sample_cells`` labelled text cells per language, chosen by hash."""
    labelled = docs.select("doc_id", label_language(F.col("lang")).alias("label")).where(F.col("label").isin(langs))
    text_cells = cells.where("cell_type = 'markdown' AND length > 0").select("doc_id", "cell_no", "start_char", "length")
    chance = F.xxhash64("doc_id", "cell_no")
    rank = F.row_number().over(Window.partitionBy("label").orderBy(chance, "doc_id", "cell_no"))
    chosen = text_cells.join(labelled, "doc_id").withColumn("k", rank).where(F.col("k") <= sample_cells).drop("k")
    # At most sample_cells rows per language: small enough to send to the texts.
    wanted = chosen.groupBy("doc_id", "label").agg(F.collect_set(F.struct("cell_no", "start_char", "length")).alias("cells"))
    rows = docs.where(F.length("text") > 0).select("doc_id", "text", "layout").join(F.broadcast(wanted), "doc_id")

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            labels = batch.column("label").to_pylist()
            out = [(labels[row], text) for row, _, text in iter_cells(batch)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.string()), pa.array([t for _, t in out], pa.string())], names=["label", "text"])

    sample = rows.mapInArrow(cut, "label string, text string").collect()
    pairs = sorted((r["label"], r["text"]) for r in sample)
    model = Model(langs)
    model.fit([prose_words(t) for _, t in pairs], [x for x, _ in pairs])
    return model


def cell_languages(docs: DataFrame, cells: DataFrame, model: Model) -> DataFrame:
    """``doc_id, label, cells``: per document its text cells as (cell_no, lang, confidence, ambiguous)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        import pyarrow as pa

        own = sent.value
        kind = pa.struct([("cell_no", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64()), ("ambiguous", pa.bool_())])
        for batch in batches:
            found: list[list] = [[] for _ in range(len(batch))]
            for row, no, text in iter_cells(batch):
                lang, p = own.classify(prose_words(text))
                found[row].append({"cell_no": no, "lang": lang, "confidence": p, "ambiguous": p < AMBIGUOUS})
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(found, pa.list_(kind))], names=["doc_id", "label", "cells"])

    src = with_cells(docs.select("doc_id", "text", "layout", F.col("lang").alias("label")), cells, ["label"], F.col("cell_type") == "markdown")
    return src.mapInArrow(judge, "doc_id bigint, label string, cells array<struct<cell_no:int,lang:string,confidence:double,ambiguous:boolean>>")


def detect_languages(docs: DataFrame, cells: DataFrame, languages: DataFrame, sample_cells: int = SAMPLE_CELLS) -> DataFrame:
    """Languages of documents and of their text cells, with confidence.

    ``doc_id, cell_no, lang, confidence, ambiguous, label, label_lang, doc_lang, wrong``: cell_no -1 is the document
    itself, whose language is that of more than half of its text cells that have words (null if there is none) and
    whose confidence is the mean of those cells' times their share.  ``wrong`` marks documents whose label does not
    name their language and cells in another language than their document.

    Defined results: documents without text, or without text cells, give no rows; a cell without letters has no
    language and does not count; null, blank and unknown labels name no language; repeated rows of cells count once;
    empty tables give an empty table.
    """
    langs = sorted(r["lang"] for r in languages.select("lang").where("lang IS NOT NULL").distinct().collect())
    if not langs:
        langs = sorted(NAMES)
    model = fit_languages(docs, cells, langs, sample_cells)
    d = cell_languages(docs, cells, model)
    named = F.transform(F.filter("cells", lambda c: c["lang"].isNotNull()), lambda c: c["lang"])
    times = lambda x: F.size(F.filter(F.col("named"), lambda y: y == x))
    d = d.withColumn("named", named).withColumn("doc_lang", F.try_element_at(F.filter(F.array_distinct("named"), lambda x: 2 * times(x) > F.size("named")), F.lit(1)))
    d = d.withColumn("label_lang", label_language(F.col("label")))
    own = F.filter("cells", lambda c: c["lang"] == F.col("doc_lang"))
    total = F.aggregate(own, F.lit(0.0), lambda s, c: s + c["confidence"])
    p = F.when(F.size("named") > 0, total / F.size("named")).otherwise(0.0)
    whole = F.struct(F.lit(-1).alias("cell_no"), F.col("doc_lang").alias("lang"), p.alias("confidence"), (p < AMBIGUOUS).alias("ambiguous"))
    rows = d.withColumn("cell", F.explode(F.concat(F.array(whole), "cells")))
    wrong = F.when(F.col("cell.cell_no") == -1, ~F.col("label_lang").eqNullSafe(F.col("doc_lang")) & F.col("doc_lang").isNotNull()).otherwise(F.coalesce(F.col("cell.lang") != F.col("doc_lang"), F.lit(False)))
    return rows.select("doc_id", "cell.cell_no", "cell.lang", "cell.confidence", "cell.ambiguous", "label", "label_lang", "doc_lang", wrong.alias("wrong"))
