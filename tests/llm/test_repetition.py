"""Suffix-array repetition against brute force."""

import random
import re

from learnlake.llm import repetition
from learnlake.llm.repetition import Limits


def brute(text, limits):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(w)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    window = [False] * n
    starts = {}
    for i in range(n - 7):
        starts.setdefault(tuple(w[i:i + 8]), []).append(i)
    for at in starts.values():
        if len(at) > 1:
            for i in at:
                window[i:i + 8] = [True] * 8
    covered, longest = [False] * n, 0
    for length in range(limits.min_words, n):
        found = {}
        for i in range(n - length + 1):
            found.setdefault(tuple(w[i:i + length]), []).append(i)
        for at in found.values():
            if len(at) > 1:
                longest = length
                for i in at:
                    covered[i:i + length] = [True] * length
    failed = n < 20 or 100 * sum(window) > 30 * n
    good = sum(covered) <= limits.max_covered * n and longest <= limits.max_longest
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), sum(window), failed,
            not failed and good, sum(covered), longest)


def texts():
    rnd = random.Random(5)
    out = [None, "", " ", "one", "a\xa0b c\x1cd é f", "\n\n \nx\nx\n x\nx ", "w " * 300, "a b " * 40, "#* $% &|<>"]
    for size in (10, 30, 80, 200):
        for vocabulary in (2, 5, 60):
            out.append(" ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(size)))
    line = " ".join(f"x{i}" for i in range(12))
    out += [line + "\n" + " ".join(f"y{i}" for i in range(100)) + "\n" + line + "\n", (line + "\n") * 2]
    passage = " ".join(f"p{i}" for i in range(60))
    out.append(passage + " " + " ".join(f"q{i}" for i in range(400)) + " " + passage)
    return out


def test_measures_equal_brute_force():
    limits = Limits()
    got = repetition.measure([t or "" for t in texts()], limits)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "covered_words", "longest_repeat")
    for i, t in enumerate(texts()):
        assert tuple(got[c][i] for c in names) == brute(t, limits), t


def test_query_and_stage(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "again and again"), (3, "one")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as kept", "2 as n_words")
    got = repetition.quality_of_documents(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None and r.doc_id != 3:
            assert (r.n_words, r.kept) == (brute(rows[r.doc_id][1], Limits())[0], brute(rows[r.doc_id][1], Limits())[6])
    kept = repetition.unrepetitive(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.kept)
    assert repetition.quality_of_documents(docs.limit(0)).count() == 0


def test_intervals_are_maximal_repeats():
    import numpy as np
    symbols = np.array([1, 2, 3, 9, 1, 2, 3, 8, 7, 2, 3])
    order, lcp = repetition.suffix_array(symbols)
    found = {(tuple(symbols[order[a]:order[a] + n]), b - a + 1)
             for a, b, n in repetition.maximal_repeats(symbols, order, lcp, 2)}
    assert found == {((1, 2, 3), 2), ((2, 3), 3)}
