import re

from tickloom.llm.substrings import COVER, PERIOD, dedup_substrings

from .conftest import twins

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        words = WORD.findall(text or "")
        drop = set()
        for i in range(len(words) - 19):
            window = tuple(words[i : i + 20])
            if window in seen:
                drop |= set(range(i, i + 20))
            seen.add(window)
        kept = [w for i, w in enumerate(words) if i not in drop]
        out[key] = (len(words), len(drop), " ".join(kept))
    return out


def test_cover_has_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_against_brute_force(docs):
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in dedup_substrings(docs).collect()}
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert got == want and sum(n for _, n, _ in want.values()) > 500


def test_runs_within_and_between_documents(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(words)), (2, "x " + " ".join(words[7:40]) + " y"), (3, " ".join(words[:19])), (4, "a b " * 40), (5, " ".join(words[30:50])), (6, "a b")]
    got = {r.doc_id: r for r in dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: (r.n_words, r.n_removed, r.kept_text) for k, r in got.items()} == brute(rows)
    assert got[2].kept_text == "x y" and got[3].n_removed == 0 and got[5].kept_text == ""


def test_nulls_repeats_and_empty(spark, empty_docs):
    assert dedup_substrings(empty_docs).count() == 0
    long = " ".join(f"z{i}" for i in range(25))
    rows = [(None, long), (3, long), (3, long), (4, None)]
    got = sorted((str(r.doc_id), r.n_removed) for r in dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [("3", 0), ("3", 25), ("4", 0), ("None", 25)]


def test_windows_that_weak_hashes_confuse(spark):
    x, y = ("".join(w) for w in twins(1024, "a", "b"))
    same = " ".join(f"w{i}" for i in range(19))
    p, q = (" ".join(w) for w in twins(1024, "foo", "bar"))
    rows = [(1, f"{same} {x}"), (2, f"{same} {y}"), (3, p), (4, q)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows) and got[2][1] == 0
