"""Order MinHash fingerprints: edited texts and order against plain Python, signatures against their definition."""

import hashlib

import pytest

from learnlake.llm import order_minhash as omh

ROWS = [(3, "a b c d e f g h " * 6), (1, "hello"), (7, None), (5, ""), (9, "é ü ö wörd " * 9), (9, "same id"),
        (None, "no id at all"), (-2, "x"), (4, " \n\t"), (8, "the end of it all " * 30), (9, "same id"),
        (2, "a b c d e f g h " * 6)]


def plain(rows):
    """doc_id, n_chars, sha of the edited text in the order of ids; rows with the same id in every order they may have."""
    texts = sorted(((d is not None, d or 0), t or "") for d, t in rows)
    out = {}
    for i, (key, t) in enumerate(texts):
        options = [texts[(i + 1) % len(texts)][1]]
        same = [x for k, x in texts if k == key]
        after = [x for k, x in texts if k > key] or [texts[0][1]]
        first = min((k for k, _ in texts if k > key), default=texts[0][0])
        options += same + [x for k, x in texts if k == first] + after[:1]
        q = len(t) // 4
        out.setdefault((key, t), set()).update(
            hashlib.sha256((t[:len(t) - q] + o[:q]).encode()).hexdigest() for o in options)
    return out


@pytest.mark.parametrize("ranges", [1, 4])
def test_edited_texts_follow_the_order_of_ids(spark, monkeypatch, ranges):
    monkeypatch.setattr(omh, "RANGES", ranges)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr(
        "*", "1 as uid", "2 as part", "3 as own", "4 as meta")
    got = omh.fingerprints_of_documents(docs).collect()
    assert len(got) == len(ROWS)
    expected = plain(ROWS)
    allowed = {}
    for (key, t), shas in expected.items():
        allowed.setdefault((key, len(t)), set()).update(shas)
    for r in got:
        assert r.edited_sha256 in allowed[((r.doc_id is not None, r.doc_id or 0), r.n_chars)]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert len(r.fingerprint) == len(r.edited_fingerprint) == omh.DIGITS * omh.SKETCHES
    by_id = {r.doc_id: r for r in got}
    assert by_id[2].fingerprint == by_id[3].fingerprint and by_id[2].near_next == 1.0
    assert by_id[7].fingerprint == by_id[5].fingerprint == by_id[4].fingerprint == omh.EMPTY * omh.SKETCHES
    assert omh.fingerprints_of_documents(docs.limit(0)).count() == 0
    one = omh.fingerprints_of_documents(docs.where("doc_id = 8")).first()
    text = ROWS[9][1]
    assert one.edited_sha256 == hashlib.sha256(
        (text[:len(text) - len(text) // 4] + text[:len(text) // 4]).encode()).hexdigest()


def test_signature_is_the_ordered_tuple_of_smallest_numbered_kmers(spark):
    texts = ["a b c a b c a b c x y", "one two three four five six seven", "w", "", "q q q q q q q q q q"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in omh.fingerprints(docs, ["doc_id"]).collect()}

    def hashed(*values):
        kinds = ", ".join("string" if isinstance(v, str) else "bigint" if abs(v) > 1000 else "int" for v in values)
        names = [f"c{i} {k}" for i, k in enumerate(kinds.split(", "))]
        return spark.createDataFrame([values], ", ".join(names)).selectExpr(
            f"xxhash64({', '.join(f'c{i}' for i in range(len(values)))})").first()[0]

    text = texts[0].split()
    seen, bins = {}, {}
    for at in range(len(text) - omh.K + 1):
        kmer = (hashed(*text[at:at + omh.K]) & (2**64 - 1)) >> 29
        seen[kmer] = seen.get(kmer, 0) + 1
        h = hashed(kmer, seen[kmer])
        bins.setdefault(h % omh.SKETCHES, []).append(((h & (2**64 - 1)) >> 29, at))
    assert max(seen.values()) > 1
    for s in range(omh.SKETCHES):
        part = got[0][s * omh.DIGITS:(s + 1) * omh.DIGITS]
        if s not in bins:
            assert part == omh.EMPTY
            continue
        chosen = [h for h, _ in sorted(sorted(bins[s])[:omh.PICKED], key=lambda x: x[1])]
        values = ", ".join(f"{h}L" for h in chosen)
        digest = spark.sql(f"select xxhash64(array({values}))").first()[0]
        assert part == f"{digest & (2**64 - 1):016x}"[:omh.DIGITS]


def test_likeness_falls_with_edits_and_with_order(spark):
    base = [f"word{i}" for i in range(400)]
    little = base[:200] + ["changed"] + base[201:]
    much = base[:200] + [f"other{i}" for i in range(200)]
    turned = base[200:] + base[:200]
    none = [f"else{i}" for i in range(400)]
    docs = spark.createDataFrame(
        [(i, " ".join(w)) for i, w in enumerate([base, little, much, turned, none])], "doc_id long, text string")
    prints = omh.fingerprints(docs, ["doc_id"])
    first = prints.where("doc_id = 0").select(omh.F.col("fingerprint").alias("base"))
    near = {r.doc_id: r.n for r in prints.crossJoin(first).select(
        "doc_id", omh.likeness(omh.F.col("fingerprint"), omh.F.col("base")).alias("n")).collect()}
    assert near[0] == 1 and near[4] == 0
    assert near[1] > 0.7 > near[2] > near[4]
    assert near[3] < 0.9


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = omh.with_next(docs).select(omh.sketch_tuples(omh.F.col("text")))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
