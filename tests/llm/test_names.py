import random

from pyspark.sql import Row

from difframe.llm.components import connected_components
from difframe.llm.names import abbreviated, build_trie, link_spellings, person_form, spelling_pairs, title_form, trie_join


def _osa(a, b):
    d = {(i, -1): i + 1 for i in range(-1, len(a))} | {(-1, j): j + 1 for j in range(-1, len(b))}
    for i in range(len(a)):
        for j in range(len(b)):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i] != b[j]))
            if i and j and a[i] == b[j - 1] and a[i - 1] == b[j]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a) - 1, len(b) - 1]


def test_trie_join_equals_brute_force(spark):
    rnd = random.Random(2)
    words = {"".join(rnd.choices("abc", k=rnd.randint(4, 7))) for _ in range(150)}
    df = spark.createDataFrame([Row(kind="x", word=w) for w in words])
    want = {(a, b) for a in words for b in words if a != b and _osa(a, b) <= 1}
    for shard in (4000, 10):  # also with shards split
        rows = trie_join(df.union(df), shard).collect()
        assert {(r.word, r.other) for r in rows} == want and len(rows) == len(want)
    assert trie_join(df.limit(0)).count() == 0


def test_person_forms():
    for s in ("Smithson, Robert J.", "Robert J. Smithson", "SMITHSON ROBERT J"):
        assert person_form(s) == ("smithson", ["robert", "j"]), s
    for s in ("Smithson, R. J.", "Smithson, R.J.", "Smithson RJ", "R. J. Smithson", "von Smithson, R. J.", "Smithson, R. J. von", "VON SMITHSON, R. J."):
        assert person_form(s) == ("smithson", ["r", "j"]), s
    assert person_form("vanSmithson, Ann") == ("smithson", ["ann"]) and person_form("Müller") == ("muller", [])
    assert person_form("Smithson DE") == ("smithson", ["d", "e"])
    assert person_form("...") == ("", [])


def test_title_forms():
    assert title_form("The Annals of Odd Things, Series B") == ("annalsofoddthingsseriesb", ["annals", "b", "odd", "things"], "b")
    assert title_form("Odd Things, Annals of")[1] == title_form("Annals of Odd Things")[1]


def test_abbreviations():
    t = build_trie(["annals odd things", "compounds framework letters", "journal ordered solids", "a proceedings society"])
    assert abbreviated(t, ["ann", "odd", "th"]) == {"annals odd things": 0}
    assert abbreviated(t, ["compd", "framew", "lett"]) == {"compounds framework letters": 1}
    assert abbreviated(t, ["j", "orrd", "solid"]) == {"journal ordered solids": 1}
    assert abbreviated(t, ["b", "proc", "soc"]) == {} and abbreviated(t, ["ann", "odd"]) == {}


def test_links(spark):
    authors = [
        "Smithson, Robert J.; Bob Smithson ;Smithson, R. J.;SMITHSON ROBERT; Smihtson, Robert",
        "Smithson, Mary; M. Smithson",
        "Okonkwo, Michael;Okonkwo, M. H.",
        "Lindqvist, Michael;Lindqvist, M. H.;Lindqvist, Margaret",
        None, "", " ; ;", "...;", "Smithson, Mary",
    ]
    journal = ["Annals of Odd Things", "Ann. Odd Thin.", "Odd Things, Annals of", "Annals of Odd Things Letters", "Journal of Works, Series A", "Journal of Works, Series B", "J. Works A", None, "annals of  odd thinsg"]
    df = spark.createDataFrame([Row(authors=a, journal=j, word="x", node="y", field="z") for a, j in zip(authors, journal, strict=True)], "authors string, journal string, word string, node string, field string")
    got = {}
    for r in link_spellings(df.union(df), {"authors": ";"}, ["journal"]).collect():
        got.setdefault((r.field, r.entity), set()).add(r.spelling)
    groups = {frozenset(v) for v in got.values()}
    assert groups == {
        frozenset({"Smithson, Robert J.", "Bob Smithson", "Smithson, R. J.", "SMITHSON ROBERT", "Smihtson, Robert"}),
        frozenset({"Smithson, Mary", "M. Smithson"}),
        frozenset({"Okonkwo, Michael", "Okonkwo, M. H."}),
        frozenset({"Lindqvist, Michael"}),
        frozenset({"Lindqvist, M. H."}),
        frozenset({"Lindqvist, Margaret"}),
        frozenset({"Annals of Odd Things", "Ann. Odd Thin.", "Odd Things, Annals of", "annals of  odd thinsg"}),
        frozenset({"Annals of Odd Things Letters"}),
        frozenset({"Journal of Works, Series A", "J. Works A"}),
        frozenset({"Journal of Works, Series B"}),
    }
    pairs = spelling_pairs(link_spellings(df, {"authors": ";"}, ["journal"])).collect()
    assert len(pairs) == 10 + 1 + 1 + 6 + 1 and all(r.spelling_1 < r.spelling_2 for r in pairs)
    assert link_spellings(df.limit(0), {"authors": ";"}, ["journal"]).count() == 0


def _entities(spark, authors, journals=()):
    rows = [(a, None) for a in authors] + [(None, j) for j in journals]
    linked = link_spellings(spark.createDataFrame(rows, "authors string, journal string"), {"authors": ";"}, ["journal"])
    groups = {}
    for r in linked.collect():
        groups.setdefault((r.field, r.entity), set()).add(r.spelling)
    return {frozenset(v) for v in groups.values()}


def test_shared_initials_join_nobody(spark):
    one = lambda *x: {frozenset({y}) for y in x}
    names = ["Hoffman, John", "Hoffman, Jane", "Hoffman, Jacob", "Hoffman, J.", "Hoffman, J. K.", "Hoffman, J. L."]
    assert _entities(spark, names) == one(*names)
    got = _entities(spark, ["Okafor, John K.", "Okafor, Jane L.", "Okafor, J. K.", "J. L. Okafor", "Okafor, Jane", "Okafor, J.", "Okafor, Bob", "Okafor, R. T."])
    assert got == {frozenset({"Okafor, John K.", "Okafor, J. K."}), frozenset({"Okafor, Jane L.", "J. L. Okafor", "Okafor, Jane"}), frozenset({"Okafor, Bob", "Okafor, R. T."})} | one("Okafor, J.")
    assert _entities(spark, ["Tamm, Ted", "Tamm, T.", "Tamm, Edward", "Tamm, B.", "Bob Tamm"]) == {frozenset({"Tamm, Ted", "Tamm, Edward"}), frozenset({"Tamm, B.", "Bob Tamm"})} | one("Tamm, T.")


def test_misspellings_do_not_chain(spark):
    """Each is one letter from the next; only the usual one gathers its neighbours."""
    usual = [f"Kolarumir, {x}" for x in ("Robert", "Mary", "Otto", "Ines")]
    got = _entities(spark, [*usual, "Kolarumit, Robert", "Kolarumtt, Robert"])
    assert frozenset({"Kolarumir, Robert", "Kolarumit, Robert"}) in got and frozenset({"Kolarumtt, Robert"}) in got


def test_either_word_order(spark):
    got = _entities(spark, ["Smithson, Robert", "Smithson Robert", "Robert Smithson", "Vale Ingrid"])
    assert got == {frozenset({"Smithson, Robert", "Smithson Robert", "Robert Smithson"}), frozenset({"Vale Ingrid"})}


def test_short_names(spark):
    """One edit in surnames of two to four letters, by the same given names: recall and precision over planted ones."""
    rnd = random.Random(8)
    syllables = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]
    sur = sorted({"".join(rnd.choices(syllables, k=2)).capitalize() for _ in range(40)} | {rnd.choice(syllables).capitalize() + rnd.choice("nrs") for _ in range(20)})
    names = rnd.sample([a + b + c for a in syllables[:20] for b in syllables[20:40] for c in ("n", "rt", "la")], len(sur))
    people = [(s, n.capitalize()) for s, n in zip(sur, names, strict=True)]
    typo = []
    for s, n in people:
        i = rnd.randrange(1, len(s))
        w = rnd.choice([s[:i] + s[i + 1 :], s[:i] + rnd.choice("aeioubdk") + s[i:], s[:i] + rnd.choice("xqwy") + s[i + 1 :], s[: i - 1] + s[i].upper() + s[i - 1].lower() + s[i + 1 :]])
        typo.append(f"{w}, {n}")
    groups = _entities(spark, [f"{s}, {n}; {n} {s}; {s}, {n[0]}." for s, n in people] + typo)
    of = {x: g for g in groups for x in g}
    found = sum(f"{s}, {n}" in of[t] for (s, n), t in zip(people, typo, strict=True))
    owners = {x: i for i, (s, n) in enumerate(people) for x in (f"{s}, {n}", f"{n} {s}", typo[i])}
    assert found >= 0.95 * len(people) and all(len({owners[x] for x in g if x in owners}) <= 1 for g in groups)


def test_titles_in_any_order_and_ambiguous_abbreviations(spark):
    t = build_trie(["canada cat crystal cubic", "annals animal art atom axis"])
    assert abbreviated(t, ["canad", "c", "cr", "cu"]) == {"canada cat crystal cubic": 0}
    assert abbreviated(t, ["ax", "at", "ar", "ani", "a"]) == {"annals animal art atom axis": 0}
    assert abbreviated(t, ["a"] * 40) == {} and abbreviated(t, []) == {}
    got = _entities(spark, [], ["Crystal Cat Canada Cubic", "Cr. C. Canad. Cu.", "Journal Physics", "Journal Physiology", "J. Phys.", "J. Physio.", "Acta", "Atca", *["Acta"] * 20])
    assert got == {frozenset({"Crystal Cat Canada Cubic", "Cr. C. Canad. Cu."}), frozenset({"Journal Physiology", "J. Physio."}), frozenset({"Journal Physics"}), frozenset({"J. Phys."}), frozenset({"Acta", "Atca"})}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    links = spark.createDataFrame(chain, "a int, b int")
    nodes = spark.createDataFrame([(i,) for i in [*range(41), 100, 101, 200]], "node int")
    got = {r.node: r.component for r in connected_components(nodes, links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200}
