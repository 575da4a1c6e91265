import re

import numpy as np
import pyarrow as pa

from tickloom.llm.lines import _Lines, _within_one, dedup_lines
from tickloom.llm.textbytes import blocks

from .conftest import twins

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(rows):
    earlier, out = [], {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        kept, n, m = [], 0, 0
        for line in (text or "").split("\n"):
            words = WORD.findall(line)
            gone = bool(words) and any(
                w == words or (max(len(w), len(words)) >= 5 and abs(len(w) - len(words)) <= 1 and distance(w, words) <= 1) for w in earlier
            )
            n, m = n + bool(words), m + gone
            earlier += [words] if words else []
            kept += [] if gone else [line]
        out[key] = (None if text is None else "\n".join(kept), n, m)
    return out


def result(df):
    return {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in df.collect()}


def test_against_brute_force(docs):
    got = dedup_lines(docs)
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert result(got) == want and sum(m for *_, m in want.values()) > 20


def test_edits_at_every_place(spark):
    base = "a b c d e f g".split()
    near = [base[:i] + ["x"] + base[i:] for i in range(8)] + [base[:i] + base[i + 1 :] for i in range(7)]
    near += [base[:i] + ["y"] + base[i + 1 :] for i in range(7)]
    far = ["b c d e f g z w".split(), "a b c d".split(), "a b q d".split(), "b b c d e".split(), "b c d e f g a".split()]
    rows = [(i, " ".join(w) + ("\n\n" if i % 2 else "")) for i, w in enumerate([base, *near, *far])]
    assert result(dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_random_small_alphabet(spark):
    import random

    rng = random.Random(3)
    rows = [(i, "\n".join(" ".join(rng.choice("ab") for _ in range(rng.randint(0, 8))) for _ in range(3))) for i in range(40)]
    assert result(dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)
    rows = [(i, "\n".join(" ".join(rng.choice("abcde") for _ in range(rng.randint(4, 7))) for _ in range(3))) for i in range(60)]
    assert result(dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_clashing_columns_nulls_and_empty(spark, empty_docs):
    assert dedup_lines(empty_docs).count() == 0
    rows = [(1, "p q\nr s", 7, "u", None), (2, "r s\n\nt", 8, "v", [1]), (None, "t", 9, "w", None), (4, None, 1, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines long, unit string, `a.b` array<int>").withColumnRenamed("a.b", "__text")
    got = {r.doc_id: r for r in dedup_lines(df).collect()}
    assert {k: r.text for k, r in got.items()} == {1: "p q\nr s", 2: "\nt", None: "", 4: None}
    assert got[2]["__text"] == [1] and got[2].unit == "v" and got[2].n_lines == 2


def test_lines_that_weak_hashes_confuse(spark):
    x, y = twins(1024, "foo", "bar")
    near = [*x[:500], "baz", *x[501:]]
    rows = [(1, " ".join(x)), (2, " ".join(y)), (3, " ".join(near)), (4, "".join(twins(2048, "a", "b")[0])), (5, "".join(twins(2048, "a", "b")[1]))]
    got = result(dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {k: m for k, (_, _, m) in got.items()} == {1: 0, 2: 0, 3: 1, 4: 0, 5: 0}


def test_bound_is_a_parameter(spark):
    rows = [(1, "a b c"), (2, "a b d"), (3, "a b c d e f"), (4, "a b c d e g"), (5, "a b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    removed = lambda **x: [k for k, (_, _, m) in sorted(result(dedup_lines(df, **x)).items()) if m]
    assert removed(edits=0) == [5] and removed() == [4, 5] and removed(similarity=0.6) == [2, 4, 5]


def test_equal_ids_and_repeated_rows(spark):
    rows = [(7, f"line {i % 3} of one id\nown{i}") for i in range(9)] + [(None, "line 0 of one id")] * 4
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == 13 and sum(r.n_lines - r.n_removed for r in got) == 10 and all(r.n_removed == 1 for r in got if r.doc_id is None)


def test_distance_on_words():
    import itertools

    words = [list(x) for n in range(4) for x in itertools.product(b"ab", repeat=n)]
    assert all(_within_one(a, b) == (distance(a, b) <= 1) for a in words for b in words)


def test_words_of_one_line_without_those_of_the_others():
    texts = ["red  green\x0bblue\x1cx\n\t\né y \r z", "", "last\x0cline"]
    (here,) = [_Lines(first, data, at) for first, _, data, at in blocks(pa.array(texts))]
    found = [b" ".join(here.line(i)) for i in range(len(here))]
    assert "spans" not in vars(here)
    assert found == here.texts(np.arange(len(here)))
