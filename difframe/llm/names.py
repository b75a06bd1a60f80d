"""Variant spellings of names of persons and journals, by trie joins.

1. Distinct spellings are read into forms: a person's surname and given names, a title's words.
2. A trie join finds the words within one edit of each other (surnames, given names, whole titles): words are sharded
   so that two words one edit apart share a shard, each shard's words form a trie, and every word walks it with a
   Levenshtein automaton (substitution, insertion, deletion, transposition).
3. Token orders are tried: both readings of a person's name without comma, and, by a second trie walk, a title's words
   in any order, each of which may be cut off.
4. A rare word is a misspelling of the most usual word next to it; misspellings never chain.  Persons are then told
   apart within a surname: a form that leaves something open (an initial for a name, no middle initial) belongs to a
   person only if a single one fits; an initial that two persons share stays alone and joins nobody.  Titles that
   differ by an edit are one; an abbreviation joins a full title only if a single one fits.

Shards with too many words are split on both sides, so no task gets an unbounded group.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from difframe.llm.components import connected_components
from difframe.runtime import staged

#: Words of a shard that one task takes on either side; larger shards are split.
SHARD_WORDS = 4000
#: A word that differs by an edit from a more usual one of n forms is its misspelling if it has at most ``RARE`` forms or
#: at most the root of n times the slack; otherwise both are names of their own.  (Typing errors of one kind are a small
#: share of a word; there are few given names, so their errors meet more often.)
RARE, SURNAME_SLACK, GIVEN_SLACK = 2, 1.0, 2.0
#: Surnames with fewer letters are misspellings only where the given names agree exactly, given names with fewer only
#: where surname and middle initial agree, titles with fewer only where their rows are so few.
SHORT_SURNAME, SHORT_GIVEN, SHORT_TITLE = 5, 4, 5

# Particles of surnames, small words of titles, nicknames by given name.
PARTICLES = frozenset("von van vom de der den del della di da dos das du des la le les ter ten te zu zum zur el al bin ibn af av y e".split())
SMALL_WORDS = frozenset(
    "the of and und et y e on in for to from with at by under für zur zum der die das des den dem van von het en op le la les du de della delle dei del di da do dos das el los las "
    "og och i series ser section sect".split()
)
NICKNAMES = {
    "alexander": "alex sasha sandy xander",
    "andrew": "andy drew",
    "anthony": "tony",
    "barbara": "barb babs",
    "benjamin": "ben benny",
    "catherine": "cathy cate",
    "charles": "charlie chuck",
    "charlotte": "lottie lotte charlie",
    "christopher": "chris kit",
    "daniel": "dan danny",
    "david": "dave davy",
    "dominik": "dom nik",
    "edward": "ed eddie ned ted",
    "elizabeth": "liz beth betty lisa lizzie eliza",
    "emilio": "milo",
    "francisco": "paco pancho",
    "frederik": "fred fritz freddy",
    "gabriela": "gaby gabi",
    "gregory": "greg",
    "heinrich": "heinz",
    "henrietta": "hetty etta",
    "henry": "harry hank",
    "ignacio": "nacho",
    "ingrid": "inga",
    "james": "jim jimmy jamie",
    "johannes": "hans jan",
    "john": "jack johnny",
    "jonathan": "jon",
    "jose": "pepe",
    "joseph": "joe joey",
    "katherine": "kate kathy katie",
    "lucia": "lucy",
    "margaret": "maggie peggy meg",
    "michael": "mike mick",
    "nicholas": "nick",
    "nikolai": "kolya nik nick",
    "oliver": "ollie",
    "patricia": "pat tricia patty trish",
    "peter": "pete",
    "quentin": "quinn",
    "richard": "rick dick rich",
    "robert": "bob rob bobby bert",
    "samuel": "sam",
    "stephen": "steve",
    "susanna": "sue susie",
    "theodore": "ted theo",
    "thomas": "tom tommy",
    "timothy": "tim",
    "ulrike": "uli rike",
    "victoria": "vicky tori",
    "william": "bill will billy",
    "yevgenia": "zhenya",
    "zoltan": "zoli",
}

_LETTERS = re.compile(r"[^\W\d_]+")
_ALNUM = re.compile(r"[^\W_]+")
_CAMEL = re.compile(r"(?<=[^\W\d_A-Z])(?=[A-Z])")


def folded(text: str) -> str:
    """Case-folded text without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c))


def formal_names(nicknames: dict[str, str]) -> dict[str, list[str]]:
    """The formal names that each nickname may stand for."""
    out: dict[str, list[str]] = {}
    for name, nicks in nicknames.items():
        for n in nicks.split():
            out.setdefault(n, []).append(name)
    return out


def person_readings(spelling: str) -> tuple[tuple[str, list[str]], tuple[str, list[str]] | None]:
    """((surname, given names), the other reading) of a person's spelling, folded, whatever the order and style.

    ``Surname, Given M.``, ``G. M. Surname``, ``Surname GM``, ``SURNAME GIVEN``, ``Given Surname``; particles are set
    aside (also written together, as in ``vanSurname``); a surname without given names has none.  Words in no telling
    order (no comma, initials or capitals) have a second reading, ``Surname Given``; others have None.
    """
    text = _CAMEL.sub(" ", spelling) if _CAMEL.search(spelling) and any(p in PARTICLES for p in _CAMEL.sub(" ", spelling).split()) else spelling
    shout = text.upper() == text

    def initials(t: str) -> bool:
        t = t.strip(",")
        return bool(t) and ("." in t and all(len(x) <= 2 for x in t.split(".")) or len(t) == 1 or (len(t) <= 3 and t.isupper() and not (shout and (len(t) == 3 or folded(t) in PARTICLES))))

    def form(sur: str, given: str) -> tuple[str, list[str]]:
        words = _LETTERS.findall(folded(sur))
        own = [w for w in words if w not in PARTICLES] or words
        names: list[str] = []
        for piece in re.findall(r"[^\W\d_]+\.?", given):
            p = piece.rstrip(".")
            if len(p) <= 3 and initials(p):
                names += list(folded(p))
            elif folded(p) not in PARTICLES:
                names.append(folded(p))
        return "".join(own), names

    if "," in text:
        sur, _, given = text.partition(",")
        return form(sur, given), None
    t = text.split()
    if not t:
        return form("", ""), None
    short = [initials(x) for x in t]
    plain = [i for i, x in enumerate(t) if not short[i] and folded(x.strip(".")) not in PARTICLES]
    at = 0 if not plain else plain[0] if shout else plain[-1]
    split = lambda i: form(t[i], " ".join(t[:i] + t[i + 1 :]))
    return split(at), split(plain[0]) if len(plain) > 1 and not shout and not any(short) else None


def person_form(spelling: str) -> tuple[str, list[str]]:
    """(surname, given names) of a person's spelling in its usual reading."""
    return person_readings(spelling)[0]


def title_form(spelling: str) -> tuple[str, list[str], str]:
    """(all letters in a row, words sorted, series) of a title, folded; small words are left out of the words, and the
    series is a last word of one letter."""
    words = _ALNUM.findall(folded(spelling))
    if words[:1] == ["the"] and len(words) > 1:
        words = words[1:]
    own = [w for w in words if w not in SMALL_WORDS] or words
    return "".join(words), sorted(own), words[-1] if len(words) > 1 and len(words[-1]) == 1 else ""


# ---- trie walks -----------------------------------------------------------------------------------------------------

_END = ""


def build_trie(words, root: dict | None = None) -> dict:
    root = {} if root is None else root
    for w in words:
        at = root
        for c in w:
            at = at.setdefault(c, {})
        at[_END] = w
    return root


def within_one_edit(trie: dict, word: str) -> dict[str, int]:
    """Words of the trie at most one edit (also a swap of neighbours) from ``word``, with their distance."""
    found: dict[str, int] = {}

    def walk(at: dict, i: int, spent: int) -> None:
        if i == len(word) and _END in at:
            w = at[_END]
            found[w] = min(spent, found.get(w, spent))
        if i < len(word) and word[i] in at:
            walk(at[word[i]], i + 1, spent)
        if spent:
            return
        if i < len(word):
            walk(at, i + 1, 1)
        for c, below in at.items():
            if c == _END:
                continue
            walk(below, i, 1)
            if i < len(word) and c != word[i]:
                walk(below, i + 1, 1)
                if i + 1 < len(word) and c == word[i + 1] and word[i] in below:
                    walk(below[word[i]], i + 2, 1)

    walk(trie, 0, 0)
    return found


def abbreviated(trie: dict, words: list[str]) -> dict[str, int]:
    """Entries of a trie of sorted words (joined by blanks) that ``words`` may abbreviate in any order, at the cost of
    one edit at most.  A word may be cut off after any letter for free; one gap inside a word counts as the edit; first
    letters and words of one or two letters take no edits.

    Words are used up as a set (a bit each) while the trie is walked, so every order is tried without listing orders.
    """
    words = sorted(words)
    everything = (1 << len(words)) - 1
    found: dict[str, int] = {}
    seen: set[tuple[int, int, int]] = set()

    def ends(at: dict):
        """Places in the trie where the word being read is over, its rest skipped."""
        todo = [at]
        while todo:
            n = todo.pop()
            if " " in n or _END in n:
                yield n
            todo += [below for c, below in n.items() if c not in (" ", _END)]

    def next_word(at: dict, used: int, spent: int) -> None:
        if (id(at), used, spent) in seen:
            return
        seen.add((id(at), used, spent))
        for k, w in enumerate(words):
            twin = k > 0 and words[k - 1] == w and not used >> (k - 1) & 1
            if not used >> k & 1 and not twin and w[0] in at:
                read(at[w[0]], w, 1, used | 1 << k, spent)

    def word_over(at: dict, used: int, spent: int) -> None:
        for n in ends(at):
            if used == everything:
                if _END in n:
                    found[n[_END]] = min(spent, found.get(n[_END], spent))
            elif " " in n:
                next_word(n[" "], used, spent)

    def read(at: dict, w: str, i: int, used: int, spent: int) -> None:
        if i == len(w):
            word_over(at, used, spent)
        elif w[i] in at:
            read(at[w[i]], w, i + 1, used, spent)
        if spent or len(w) < 3:
            return
        if i < len(w):
            read(at, w, i + 1, used, 1)
        for c, below in at.items():
            if c in (" ", _END):
                continue
            if i < len(w):
                read(below, w, i, used, 1)
                if c != w[i]:
                    read(below, w, i + 1, used, 1)
                if i + 1 < len(w) and c == w[i + 1] and w[i] in below:
                    read(below[w[i]], w, i + 2, used, 1)
                if i >= 2 and i == len(w) - 1:  # a gap before the last letter: compd. for compounds
                    todo = [below]
                    while todo:
                        n = todo.pop()
                        if w[i] in n:
                            read(n[w[i]], w, i + 1, used, 1)
                        todo += [b for x, b in n.items() if x not in (" ", _END)]

    if words and all(words):
        next_word(trie, 0, 0)
    return found


def _in_shards(words: DataFrame, walk, shard_words: int) -> DataFrame:
    """``kind, word, other, edits`` from walking each shard's words over the shard's trie.

    ``words`` has ``kind, shard, word``.  A shard of n words is cut into a grid of ceil(n / shard_words) squared
    tasks: every part of the words walks the trie of every part.
    """
    n = F.ceil(F.col("n") / F.lit(shard_words)).cast("int")
    shared = words.groupBy("kind", "shard").agg(n_rows()).where("n > 1")
    parts = words.join(shared, ["kind", "shard"]).withColumn("parts", n).drop("n")
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    asks = parts.withColumn("q", own).withColumn("t", every)
    holds = parts.withColumn("t", own).withColumn("q", every)
    key = ["kind", "shard", "q", "t"]
    both = asks.withColumn("asks", F.lit(True)).unionByName(holds.withColumn("asks", F.lit(False))).select(*key, "asks", "word")
    # Few bytes, much work: the number of tasks follows the cores, not the size.  Groups are read one after another.
    tasks = 3 * words.sparkSession.sparkContext.defaultParallelism
    ordered = both.repartition(tasks, *key).sortWithinPartitions(*key, "asks")

    def run(batches):
        import pandas as pd

        rows = (r for pdf in batches for r in pdf.itertuples(index=False, name=None))
        out: list[tuple] = []
        for (kind, *_), group in itertools.groupby(rows, key=lambda r: r[:4]):
            trie: dict = {}
            for *_, asking, word in group:
                if not asking:
                    build_trie([word], trie)
                else:
                    out += [(kind, word, o, d) for o, d in walk(trie, word).items() if o != word]
            if len(out) > 50_000:
                yield pd.DataFrame(out, columns=["kind", "word", "other", "edits"])
                out = []
        yield pd.DataFrame(out, columns=["kind", "word", "other", "edits"])

    return ordered.mapInPandas(run, "kind string, word string, other string, edits int").groupBy("kind", "word", "other").agg(F.min("edits").alias("edits"))


def n_rows(name: str = "n"):
    return F.count(F.lit(1)).alias(name)


def trie_join(words: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """All pairs of different ``word``s of one ``kind`` within one edit: ``kind, word, other, edits`` (both ways).

    Shards: one edit leaves the first or the last half of a word alone, so a word goes to the shards of its front
    and back halves, for its own length and the two lengths an edit away; two letters that may be swapped meet by
    their sorted letters.
    """
    half = lambda d: F.floor((F.length("word") + d) / 2).cast("int")
    front = lambda d: F.concat(F.lit("<"), F.col("word").substr(F.lit(1), half(d)))
    back = lambda d: F.concat(F.lit(">"), F.reverse(F.reverse(F.col("word")).substr(F.lit(1), half(d))))
    swap = F.concat(F.lit("~"), F.array_join(F.array_sort(F.split("word", "")), ""))
    keys = F.array_distinct(F.when(half(-1) > 0, F.array(front(-1), back(-1), front(0), back(0))).otherwise(F.array(swap, front(0), back(0))))
    return _in_shards(words.select("kind", "word").where(F.length("word") > 1).distinct().select("kind", F.explode(keys).alias("shard"), "word"), within_one_edit, shard_words)


def abbreviation_join(titles: DataFrame, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Pairs of sorted-word strings of which the first may abbreviate the second; shards are the words' initials."""
    initials = F.array_join(F.transform(F.split("word", " "), lambda w: F.substring(w, 1, 1)), "")
    return _in_shards(titles.select("kind", "word").distinct().withColumn("shard", initials), lambda trie, w: abbreviated(trie, w.split(" ")), shard_words)


# ---- linking --------------------------------------------------------------------------------------------------------


def spellings(df: DataFrame, persons: dict[str, str], titles: list[str]) -> DataFrame:
    """Distinct ``field, spelling`` and their ``n_rows``: pieces between separators of the ``persons`` columns, whole
    ``titles`` values."""
    parts = [df.select(F.lit(c).alias("field"), F.explode(F.split(F.col(c), re.escape(sep))).alias("spelling")).withColumn("spelling", F.regexp_replace("spelling", r"^\s+|\s+$", "")) for c, sep in persons.items()]
    parts += [df.select(F.lit(c).alias("field"), F.col(c).alias("spelling")) for c in titles]
    return reduce(DataFrame.unionByName, parts).where(F.col("spelling").rlike(r"[\p{L}\p{N}]")).groupBy("field", "spelling").agg(F.count(F.lit(1)).alias("n_rows"))


def _forms(spelled: DataFrame, persons: set[str]) -> DataFrame:
    """``field, spelling, n_rows, word, parts, series, other_word, other_parts``: readings of every spelling."""

    def read(batches):
        import pyarrow as pa

        texts = pa.list_(pa.string())
        for b in batches:
            forms = []
            for f, s in zip(b.column("field").to_pylist(), b.column("spelling").to_pylist(), strict=True):
                if f in persons:
                    (word, names), other = person_readings(s)
                    forms.append((word, names, "", *(other or (None, None))))
                else:
                    forms.append((*title_form(s), None, None))
            cols = [pa.array([x[i] for x in forms], k) for i, k in enumerate((pa.string(), texts, pa.string(), pa.string(), texts))]
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=["field", "spelling", "n_rows", "word", "parts", "series", "other_word", "other_parts"])

    return spelled.select("field", "spelling", "n_rows").mapInArrow(read, "field string, spelling string, n_rows bigint, word string, parts array<string>, series string, other_word string, other_parts array<string>")


def _first(parts: str = "parts"):
    return F.try_element_at(parts, F.lit(1))


def _in_order(people: DataFrame) -> DataFrame:
    """Persons with the reading that another spelling confirms: ``Surname Given`` only where a telling spelling has that
    surname and initial and none has the usual reading's surname."""
    told = people.where("other_word IS NULL")
    known = told.select("field", "word").distinct()
    known_pair = told.where(F.size("parts") > 0).select("field", F.col("word").alias("other_word"), F.substring(_first(), 1, 1).alias("initial")).distinct()
    open_ = people.where(F.size("other_parts") > 0).withColumn("initial", F.substring(_first("other_parts"), 1, 1))
    turned = open_.join(known_pair, ["field", "other_word", "initial"], "left_semi").join(known, ["field", "word"], "left_anti").select("field", "spelling", F.lit(True).alias("turned"))
    both = people.join(turned, ["field", "spelling"], "left")
    pick = lambda a, b: F.when(F.col("turned"), F.col(b)).otherwise(F.col(a))
    out = both.select("field", "spelling", "n_rows", pick("word", "other_word").alias("word"), pick("parts", "other_parts").alias("parts"))
    return out.withColumn("rest", F.array_join("parts", " "))


def _rare(few, many, slack: float = 1.0):
    return few <= F.greatest(F.lit(float(RARE)), slack * F.sqrt(many))


def _misspelled(pairs: DataFrame, slack: float) -> DataFrame:
    """``a, b``: each rare word (or form) and the most usual one next to it, of which it is a misspelling.

    ``pairs`` has ``a, b`` and their weights ``wa, wb``, structs that begin with a count ``n`` and end with something
    that makes them unique.  A word that is a misspelling itself is no one's usual form, so nothing chains.
    """
    rare = pairs.where((F.col("wa") < F.col("wb")) & _rare(F.col("wa.n"), F.col("wb.n"), slack))
    usual = rare.join(rare.select(F.col("a").alias("b")).distinct(), "b", "left_anti")
    return usual.groupBy("a").agg(F.max_by("b", "wb").alias("b"))


def _persons(people: DataFrame, near: DataFrame, nicknames: dict[str, str]) -> DataFrame:
    """``field, spelling, entity`` of persons."""
    people = staged(_in_order(people), "name-persons")
    forms = people.groupBy("field", "word", "rest").agg(F.first("parts").alias("parts"), F.sum("n_rows").alias("rows")).withColumn("g", _first())
    close = near.where("kind = 'surname'").select(F.col("word").alias("a"), F.col("other").alias("b"), (F.least(F.length("word"), F.length("other")) < SHORT_SURNAME).alias("short"))

    # Surnames: a rare one takes the usual one's place; a short one only where all given names agree.
    weight = forms.groupBy("word").agg(F.struct(n_rows(), F.sum("rows").alias("rows"), F.col("word").alias("word")).alias("w"))
    weighed = close.join(weight.select(F.col("word").alias("a"), F.col("w").alias("wa")), "a").join(weight.select(F.col("word").alias("b"), F.col("w").alias("wb")), "b")
    kin = _misspelled(weighed.where("NOT short"), SURNAME_SLACK).select(F.col("a").alias("word"), F.col("b").alias("kin"))
    exact = forms.where(F.length("g") > 1).select("field", "rest", F.struct("field", "word", "rest").alias("form"), "word")
    short = weighed.where("short").join(exact.select(F.col("word").alias("a"), "field", "rest", F.col("form").alias("fa")), "a").join(exact.select(F.col("word").alias("b"), "field", "rest", F.col("form").alias("fb")), ["b", "field", "rest"])
    same = _misspelled(short.select(F.col("fa").alias("a"), F.col("fb").alias("b"), "wa", "wb"), SURNAME_SLACK).select("a.*", F.col("b.word").alias("own"))
    forms = forms.join(kin, "word", "left").join(same, ["field", "word", "rest"], "left")
    forms = staged(forms.select("field", "word", "rest", "g", F.coalesce("own", "kin", "word").alias("kin"), F.substring(F.try_element_at("parts", F.lit(2)), 1, 1).alias("m")), "name-kin")

    # Given names: the same, by the number of surnames that bear them; short ones where kin and middle initial agree.
    full, initial = forms.where(F.length("g") > 1), forms.where(F.length("g") == 1)
    borne = full.groupBy("g").agg(F.struct(F.countDistinct("kin").alias("n"), n_rows("rows"), F.col("g").alias("g")).alias("w"))
    close = near.where("kind = 'given'").select(F.col("word").alias("a"), F.col("other").alias("b"))
    weighed = close.join(borne.select(F.col("g").alias("a"), F.col("w").alias("wa")), "a").join(borne.select(F.col("g").alias("b"), F.col("w").alias("wb")), "b")
    brief = F.least(F.length("a"), F.length("b")) < SHORT_GIVEN
    usual = _misspelled(weighed.where(~brief), GIVEN_SLACK).select(F.col("a").alias("g"), F.col("b").alias("name"))
    placed = full.where("m IS NOT NULL").select("field", "kin", "m", "g").distinct()
    at = lambda g: F.struct("field", "kin", "m", F.col(g).alias("g"))
    met = weighed.where(brief).join(placed.withColumnRenamed("g", "a"), "a").join(placed.withColumnRenamed("g", "b"), ["field", "kin", "m", "b"])
    local = _misspelled(met.select(at("a").alias("x"), at("b").alias("y"), "wa", "wb").select(F.col("x").alias("a"), F.col("y").alias("b"), "wa", "wb"), GIVEN_SLACK).select("a.*", F.col("b.g").alias("near_name"))
    full = full.join(usual, "g", "left").join(local, ["field", "kin", "m", "g"], "left").withColumn("name", F.coalesce("near_name", "name", "g"))

    # Nicknames: of a nickname's formal names, and itself, the one that the surname's other forms speak for.
    formals = formal_names(nicknames)
    known = F.create_map(*[x for k, v in sorted(formals.items()) for x in (F.lit(k), F.array(*map(F.lit, v)))]) if formals else F.lit(None).cast("map<string,array<string>>")
    full = full.withColumn("formals", known[F.col("name")])
    spoken = full.where("formals IS NULL").select("field", "kin", F.col("name").alias("option")).distinct().withColumn("written", F.lit(2))
    opened = initial.select("field", "kin", F.col("g").alias("i")).distinct().withColumn("initial", F.lit(1))
    nick = full.where("formals IS NOT NULL").select("field", "kin", "name", "formals").distinct()
    options = nick.withColumn("option", F.explode(F.concat("formals", F.array("name")))).withColumn("i", F.substring("option", 1, 1))
    options = options.join(spoken, ["field", "kin", "option"], "left").join(opened, ["field", "kin", "i"], "left")
    scored = options.groupBy("field", "kin", "name").agg(F.collect_set(F.struct(F.coalesce("written", "initial", F.lit(0)).alias("s"), F.col("option").alias("o"))).alias("x"))
    best = F.filter("x", lambda o: (o["s"] == F.array_max(F.transform("x", lambda y: y["s"]))) & (o["o"] != F.col("name")))
    meant = scored.select("field", "kin", "name", F.when(F.size(best) == 1, best[0]["o"]).otherwise(F.col("name")).alias("f"))
    full = full.join(meant, ["field", "kin", "name"], "left").withColumn("f", F.coalesce("f", "name"))

    cols = ["field", "word", "rest", "kin", "m"]
    read = full.select(*cols, "f", F.substring("f", 1, 1).alias("i")).unionByName(initial.select(*cols, F.lit(None).cast("string").alias("f"), F.col("g").alias("i")))
    read = read.unionByName(forms.where("g IS NULL OR g = ''").select(*cols, F.lit(None).cast("string").alias("f"), F.lit("").alias("i")))
    sure = _one_person(staged(read, "name-signs"))
    entity = F.concat_ws("|", "field", "kin", "i", F.coalesce("pf", F.lit("")), F.coalesce("pm", F.lit("")))
    return people.join(sure.select("field", "word", "rest", entity.alias("entity")), ["field", "word", "rest"]).select("field", "spelling", "entity")


def _one_person(signs: DataFrame) -> DataFrame:
    """``signs`` with the person each form belongs to: first name ``pf`` and middle initial ``pm`` within ``kin, i``.

    What a form leaves open is filled in only if one value fits: a missing middle initial by the only one that goes
    with the first name, a missing first name by the only one that goes with the middle initial, and either by the only
    one of the whole surname and initial if there is but one of both.  All of it is by least and greatest values per
    key, so no group is gathered.
    """
    lo_hi = lambda c, x: (F.min(c).alias(f"{x}_lo"), F.max(c).alias(f"{x}_hi"))
    group = ["field", "kin", "i"]
    s = signs.select(*group, "f", "m").distinct()
    whole = s.groupBy(*group).agg(*lo_hi("f", "f"), *lo_hi("m", "m"))
    by_f = s.where("f IS NOT NULL").groupBy(*group, "f").agg(*lo_hi("m", "fm"))
    by_m = s.where("m IS NOT NULL").groupBy(*group, "m").agg(*lo_hi("f", "mf"))
    j = signs.join(whole, group).join(by_f, [*group, "f"], "left").join(by_m, [*group, "m"], "left")
    at_most_one = lambda x: F.coalesce(F.col(f"{x}_lo") == F.col(f"{x}_hi"), F.lit(True))
    lone = at_most_one("f") & at_most_one("m") & (F.col("i") != "")
    only = lambda x: F.when(F.col(f"{x}_lo") == F.col(f"{x}_hi"), F.col(f"{x}_lo"))
    pf = F.coalesce("f", only("mf"), F.when(lone & F.col("mf_lo").isNull(), F.col("f_lo")))
    pm = F.coalesce("m", only("fm"), F.when(lone & F.col("fm_lo").isNull(), F.col("m_lo")))
    return j.withColumns({"pf": pf, "pm": pm})


def _titles(titles: DataFrame, near: DataFrame) -> DataFrame:
    """``field, spelling, entity`` of titles: one edit in the whole title (but not in a series letter), words in any
    order, abbreviations of a single full title."""
    titles = titles.withColumn("rest", F.array_join("parts", " ")).withColumn("node", F.concat_ws("|", "field", "rest"))
    forms = titles.groupBy("field", "word", "series", "rest", "node").agg(F.first("parts").alias("parts"), F.sum("n_rows").alias("rows"))
    one = near.where(F.col("kind") == "title").select("word", "other")
    side = lambda x: forms.select("field", F.col("word").alias("word" if x == "a" else "other"), "series", F.col("parts").alias(f"p{x}"), F.col("rows").alias(f"r{x}"), F.col("node").alias(x))
    edited = side("a").join(one, "word").join(side("b"), ["field", "other", "series"])
    only_a, only_b = F.array_except("pa", "pb"), F.array_except("pb", "pa")
    letter = (F.size("pa") == F.size("pb")) & (F.size(only_a) <= 1) & (F.size(only_b) <= 1) & ((F.length(F.array_join(only_a, "")) <= 2) | (F.length(F.array_join(only_b, "")) <= 2)) & (F.size(only_a) + F.size(only_b) > 0)
    brief = F.least(F.length("word"), F.length("other")) < SHORT_TITLE
    rare = _rare(F.least("ra", "rb"), F.greatest("ra", "rb"))
    same_letters = forms.groupBy("field", "word").agg(F.min("node").alias("b")).join(forms.select("field", "word", F.col("node").alias("a")), ["field", "word"])
    strict = edited.where(F.when(brief, rare).otherwise(~letter)).select("a", "b").unionByName(same_letters.select("a", "b"))
    groups = connected_components(forms.select("node").distinct(), strict)

    # Abbreviations: from the shorter to the longer; a full title is one that is short for no other.
    cut = abbreviation_join(forms.where("rest <> ''").select(F.col("field").alias("kind"), F.col("rest").alias("word"))).where(F.length("word") < F.length("other"))
    node = lambda c: F.concat_ws("|", "kind", c)
    up = cut.select(node("word").alias("x"), node("other").alias("y"), "edits").join(groups.select(F.col("node").alias("x"), F.col("component").alias("a")), "x").join(groups.select(F.col("node").alias("y"), F.col("component").alias("b")), "y")
    up = staged(up.where("a <> b").groupBy("a", "b").agg(F.min("edits").alias("edits")), "title-abbreviations")
    full = up.join(up.where("edits = 0").select(F.col("a").alias("b")).distinct(), "b", "left_anti")
    nearest = full.groupBy("a").agg(F.min("edits").alias("edits"))
    link = full.join(nearest, ["a", "edits"]).groupBy("a").agg(F.min("b").alias("b"), F.max("b").alias("c")).where("b = c").select("a", "b")
    twice = link.join(link.select(F.col("a").alias("b"), F.col("b").alias("c")), "b", "left").select(F.col("a").alias("component"), F.coalesce("c", "b").alias("full"))
    entity = groups.join(twice, "component", "left").select("node", F.coalesce("full", "component").alias("entity"))
    return titles.join(entity, "node").select("field", "spelling", "entity")


def link_spellings(df: DataFrame, persons: dict[str, str], titles: list[str], nicknames: dict[str, str] = NICKNAMES) -> DataFrame:
    """``field, spelling, entity`` for every distinct spelling: ``entity`` names the group it belongs to.

    ``persons`` maps columns of person names to their separators; ``titles`` are columns of whole titles; ``nicknames``
    lists nicknames by formal name.

    Defined results: null, empty and blank values, and values without letters or digits, are no spellings; repeated
    rows count once; a spelling unlike all others is its own entity; initials that fit several persons, and
    abbreviations that fit several titles, are entities of their own; an empty table gives an empty table.
    """
    forms = staged(_forms(spellings(df, persons, titles), set(persons)), "name-forms")
    is_person = F.col("field").isin(*persons) if persons else F.lit(False)
    people, works = forms.where(is_person), forms.where(~is_person)
    both = people.select("word", "parts").unionByName(people.where("other_word IS NOT NULL").select(F.col("other_word").alias("word"), F.col("other_parts").alias("parts")))
    words = both.select(F.lit("surname").alias("kind"), "word").unionByName(works.select(F.lit("title").alias("kind"), "word")).unionByName(both.select(F.lit("given").alias("kind"), _first().alias("word")))
    near = staged(trie_join(words), "name-neighbours")
    return _persons(people, near, nicknames).unionByName(_titles(works, near))


def spelling_pairs(linked: DataFrame) -> DataFrame:
    """``field, spelling_1, spelling_2``: all pairs of an entity's spellings, the smaller first."""
    a = linked.select("field", "entity", F.col("spelling").alias("spelling_1"))
    b = linked.select("field", "entity", F.col("spelling").alias("spelling_2"))
    return a.join(b, ["field", "entity"]).where("spelling_1 < spelling_2").select("field", "spelling_1", "spelling_2")
