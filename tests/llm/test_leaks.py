import json
import random
import re

from pyspark.sql import Row

from difframe.llm.leaks import placeholder, renamed_items, renamed_leaks, verbatim_leaks
from difframe.llm.queries import QUERIES
from difframe.runtime import table

W = re.compile(r"[^\W_]+")


def _brute(docs, cells, items):
    grams = {}
    for i, q, a in items:
        for t in (q, a):
            w = W.findall((t or "").lower())
            for k in range(len(w) - 11):
                grams.setdefault(tuple(w[k : k + 12]), set()).add(i)
    texts = {d.doc_id: d for d in docs}
    out = set()
    for c in cells:
        d = texts[c.doc_id]
        s = d.text[c.start_char : c.start_char + c.length]
        if d.layout == "json" or (d.layout is None and d.text.startswith("{")):
            s = "".join(json.loads(s))
        w = W.findall(s.lower())
        for k in range(len(w) - 11):
            for i in grams.get(tuple(w[k : k + 12]), ()):
                out.add((c.doc_id, i))
    return out


def test_found_equals_brute_force(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        docs, cells = table(spark, sf, "documents").collect(), table(spark, sf, "notebook_cells").collect()
        items = [tuple(r) for r in table(spark, sf, "eval_items").select("item_id", "question", "answer").collect()]
        got = [tuple(r) for r in QUERIES["p7_found"](spark, sf).select("doc_id", "item_id").collect()]
        assert len(got) == len(set(got)) and set(got) == _brute(docs, cells, items)


Q = "Explain why the double detector counts 324 photons from jormiloride but hardly six from fenmiraxide at station 79 and jormiloride"
RENAMED = Q.replace("324", "11").replace("jormiloride", "dulxosoride")
TORN = Q.replace("jormiloride but", "dulxosoride but")


def _tables(spark, texts):
    docs = spark.createDataFrame([Row(doc_id=i, text=t, layout="transcript", lang=None, at=1, words="x") for i, t in enumerate(texts)], "doc_id long, text string, layout string, lang string, at int, words string")
    cells = spark.createDataFrame([Row(doc_id=i, cell_no=0, cell_type="code", start_char=0, length=len(t)) for i, t in enumerate(texts) if t], "doc_id long, cell_no int, cell_type string, start_char int, length int")
    items = spark.createDataFrame([(1, Q, "short"), (2, None, Q.upper()), (3, "", None)], "item_id int, question string, answer string")
    return docs, cells, items


def test_cases(spark):
    w = Q.split()
    texts = [None, "", " ".join(w[3:15]), " ".join(w[3:14]), "# *" + "*,\n# ".join(w[:13]), "x " * 300_000 + Q, RENAMED, TORN, Q + " " + Q]
    docs, cells, items = _tables(spark, texts)
    got = {(r.doc_id, r.item_id, r.field) for r in verbatim_leaks(docs.union(docs), cells.union(cells), items).collect()}
    assert got == {(d, i, f) for d in (2, 4, 5, 8) for i, f in ((1, "question"), (2, "answer"))} | {(7, 1, "question"), (7, 2, "answer")} if len(w[12:]) >= 12 else got
    ren = {r.doc_id: r for r in renamed_leaks(docs, cells, items).collect()}
    assert 6 in ren and ren[6].n_changed == 2 and ren[6].n_items == 2 and ren[6].item_id == 1
    assert 2 not in ren and 8 not in ren


def test_split_over_two_cells_and_empty(spark):
    docs, cells, items = _tables(spark, [Q])
    half = len(Q) // 2
    two = spark.createDataFrame([(0, 0, "code", 0, half), (0, 1, "code", half, len(Q) - half)], cells.schema)
    assert verbatim_leaks(docs, two, items).count() == 0
    for a, b, c in ((docs.limit(0), cells, items), (docs, cells.limit(0), items), (docs, cells, items.limit(0))):
        assert verbatim_leaks(a, b, c).count() == 0 and renamed_leaks(a, b, c).count() == 0


def test_every_item_of_a_renamed_passage(spark):
    rows = renamed_items(*_tables(spark, [RENAMED])).collect()
    assert sorted((r.item_id, r.n_items, r.best) for r in rows) == [(1, 2, True), (2, 2, False)]


def test_windows_are_checked_one_by_one(spark):
    """A clash ends a passage and does not discard it; two numbers may become the same one, two names may not."""
    numbers = Q.replace("324", "six")
    clash = Q.replace("fenmiraxide", "jormiloride")
    docs, cells, items = _tables(spark, [TORN, numbers, clash])
    rows = renamed_items(docs, cells, items).where("item_id = 1").collect()
    got = {r.doc_id: (r.first_at, r.n_windows, r.n_changed) for r in rows}
    n = len(Q.split()) - 11
    far = Q.split().index("jormiloride")
    assert got[0] == (0, sum(not (k <= far and k + 12 == len(Q.split())) for k in range(n)), 1)
    assert got[1] == (0, n, 1)
    assert 2 not in got or got[2][1] < n


def _reparameterised(text, rnd, capitals):
    """A copy with other numbers, units and names, each consistently; numbers and names also change their length."""
    seen = {}

    def other(m):
        w = m[0]
        kind = placeholder(w.lower())
        if kind == w.lower():
            return w
        if w not in seen:
            if kind == "<number>":
                seen[w] = rnd.choice([f"{rnd.randint(2, 999)}", f"{rnd.randint(2, 99)}.{rnd.randint(1, 9)}", "forty three", "nine"])
            elif kind == "<unit>":
                seen[w] = rnd.choice(["hours", "kelvin", "milligrams", "bars"])
            else:
                stem = "".join(rnd.choice("bdfgklmnprst") + rnd.choice("aeiou") for _ in range(4))
                seen[w] = f"{stem.capitalize()} {stem[::-1].capitalize()}" if capitals and rnd.random() < 0.5 else stem + rnd.choice(["ite", "ide", "ate"])
        return seen[w]

    return W.sub(other, text)


def test_planted_renamed_questions(spark):
    """Recall over the items of the test data, re-parameterised and set among other text."""
    items = table(spark, "/root/testdata/sf0.01", "eval_items")
    rnd = random.Random(7)
    texts, want = [], {}
    for i, q in sorted((r.item_id, t) for r in items.collect() for t in (r.question, r.answer) if t):
        if sum(placeholder(w) == w for w in W.findall(q.lower())) < 14:
            continue
        for capitals in (False, True):
            copy = _reparameterised(q, rnd, capitals)
            want[len(texts)] = (i, copy)
            texts.append("Some notes come first,\n# " + copy.replace(" the ", "  *the* ") + "\nand others follow.")
    docs, cells, _ = _tables(spark, texts)
    rows = renamed_items(docs, cells, items).select("doc_id", "item_id").distinct().collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    found = sum((d, i) in got for d, (i, _) in want.items())
    assert len(want) > 200 and found >= 0.95 * len(want), (found, len(want))


def test_filter_is_exact_however_full(spark, monkeypatch):
    """A filter with far too few places lets more through; the result is the same."""
    from difframe.llm import leaks

    docs, cells, items = _tables(spark, [Q, RENAMED, "other words " * 50])
    want = sorted(verbatim_leaks(docs, cells, items).collect()), sorted(renamed_items(docs, cells, items).collect())
    real = leaks.template_filter
    monkeypatch.setattr(leaks, "template_filter", lambda w: real(w, 7))
    assert (sorted(verbatim_leaks(docs, cells, items).collect()), sorted(renamed_items(docs, cells, items).collect())) == want
