"""SimHash near-duplicates against brute force."""

import random

import pytest
import xxhash

from learnlake.llm import simhash


def brute_fingerprint(text):
    words = []
    for line in (text or "").translate({i: i + 32 for i in range(65, 91)}).split(" "):
        words += [w for w in line.replace("\t", "\n").replace("\x0b", "\n").replace("\x0c", "\n")
                  .replace("\r", "\n").split("\n") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        least[find(i)] = min(least.get(find(i), d), d)
    return [least[find(i)] for i in range(len(ids))]


TEXTS = ["", None, " \n", "one", "One", "a b c", "A B  c", "a b c d", "a b c d e", "é à ü ö x y", "\xa0 x\x1cy z w",
         "word " * 400, "the quick brown fox jumps over the lazy dog " * 3]


def test_fingerprints_and_groups(spark, tmp_path):
    rnd = random.Random(3)
    texts = TEXTS + ["".join(rnd.choice(["a", "b ", "c\n"]) for _ in range(rnd.randrange(60))) for _ in range(60)]
    base = [f"w{rnd.randrange(900)}" for _ in range(120)]
    for _ in range(60):
        near = list(base)
        near[rnd.randrange(120)] = "z"
        texts.append(" ".join(near))
    texts += texts[:20]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs = docs.selectExpr("*", "1 as fp", "'x' as component_id", "2 as node")
    got = {r.doc_id: r for r in simhash.simhash_groups(docs).collect()}
    fps = [brute_fingerprint(t) for t in texts]
    roots = brute_components(range(len(texts)), fps)
    assert len(got) == len(texts)
    for i, (fp, root) in enumerate(zip(fps, roots, strict=True)):
        assert (got[i].fingerprint, got[i].component_id) == (f"{fp:016x}", root)


@pytest.mark.parametrize("block_rows", [3, 40, 5000])
def test_links_connect_all_close_pairs(spark, block_rows):
    rnd = random.Random(block_rows)
    fps = {rnd.getrandbits(64) for _ in range(60)}
    for centre in list(fps)[:3]:
        for _ in range(90):
            x = centre
            for _ in range(rnd.randrange(1, 5)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.similar_fingerprints(
        spark.createDataFrame([(f,) for f in signed], "fp long"), block_rows).collect()
    place = {f: i for i, f in enumerate(signed)}
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        assert (fps[place[a]] ^ fps[place[b]]).bit_count() <= 4
        parent[find(place[a])] = find(place[b])
    expected = brute_components(range(len(fps)), fps)
    least = {}
    for i in range(len(fps)):
        least[find(i)] = min(least.get(find(i), i), i)
    assert [least[find(i)] for i in range(len(fps))] == expected


def test_posting_lists_are_never_sent_whole(spark):
    """An exploded table looks as small as what it came from, so its size must not decide about a broadcast."""
    distinct = spark.range(1000).selectExpr("xxhash64(id) AS fp")
    plan = simhash.similar_fingerprints(distinct)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


def test_one_per_group_keeps_whole_rows(spark):
    rows = [(3, "a b c d e", 1), (1, "a b c d e", 2), (1, "a b c d e", 2), (None, "a b c d e", 4), (9, "x y", 5),
            (None, "q", 6), (7, None, 7), (8, "", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, uid int")
    kept = sorted((tuple(r) for r in simhash.one_per_group(docs).collect()), key=str)
    assert kept == sorted([(1, "a b c d e", 2), (9, "x y", 5), (None, "q", 6), (7, None, 7)], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert simhash.simhash_groups(docs).count() == 0
    assert simhash.one_per_group(docs).count() == 0
