"""Greedy token counts and URL lists against plain versions."""

import datetime as dt
import random

import public_tokenizers

from learnlake.llm import url_filter, wordpiece

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def greedy(word, pieces, longest):
    text, n, at = b" " + word, 0, 0
    while at < len(text):
        size = next((s for s in range(min(longest, len(text) - at), 0, -1) if text[at:at + s] in pieces), 0)
        if not size:
            return 1
        n, at = n + 1, at + size
    return n


def test_counts_equal_greedy_on_small_vocabularies():
    rnd = random.Random(4)
    for _ in range(60):
        pieces = {bytes([c]) for c in b" abc"} if rnd.random() < 0.8 else {b" ", b"a", b"b"}
        pieces |= {bytes(rnd.choice(b" abc") if i == 0 else rnd.choice(b"abc") for i in range(rnd.randrange(1, 7)))
                   for _ in range(rnd.randrange(25))}
        machine = wordpiece.Automaton(pieces)
        words = [bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(1, 20))) for _ in range(60)]
        words.append(bytes(rnd.choice(b"abc") for _ in range(300)))
        assert machine.counts(words).tolist() == [greedy(w, pieces, 8) for w in words]


def test_counts_with_the_production_vocabulary(spark):
    machine = wordpiece.automaton(VOCABULARY)
    import base64
    pieces = {base64.b64decode(x.split()[0]) for x in open(VOCABULARY, "rb") if x.strip()}
    longest = max(map(len, pieces))
    words = "The quick unbelievably internationalisation naïve 漢字 ### 12345678 aaaaaaaaaaaaaaaa".split()
    words = [w.encode() for w in words] + [b"xyz" * 400, b"\xff\xfe"]
    assert machine.counts(words).tolist() == [greedy(w, pieces, longest) for w in words]
    rows = [(1, "The quick  fox\n"), (None, None), (2, ""), (2, "a\xa0b c"), (2, "a\xa0b c"), (3, "word " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_words", "2 as n_tokens")
    got = wordpiece.token_counts(docs, VOCABULARY, ["doc_id"]).collect()
    want = []
    for d, t in rows:
        ws = (t or "").encode().split()
        want.append((str(d), len(ws), sum(greedy(w, pieces, longest) for w in ws)))
    assert sorted((str(r.doc_id), r.n_words, r.n_tokens) for r in got) == sorted(want)
    assert wordpiece.token_counts(docs.limit(0), VOCABULARY, ["doc_id"]).count() == 0


def plain_verdict(url, day, log):
    """Replays the log up to the day for every list value the URL falls under."""
    if url is None or day is None or "://" not in url:
        return 0, 0
    rest = url.split("://", 1)[1]
    host = rest.split("/")[0].split("?")[0].split("#")[0].split("@")[-1].split(":")[0].lower().rstrip(".")
    path = [s for s in rest.split("?")[0].split("#")[0].split("/")[1:] if s]
    labels = host.split(".")
    names = {("host", host)} | {("domain", ".".join(labels[i:])) for i in range(len(labels))}
    names |= {("prefix", host + "/" + "/".join(path[:i + 1])) for i in range(len(path))}
    n = {"block": 0, "allow": 0}
    for name in {(e[0], e[1], e[2]) for e in log if None not in e[:4]}:
        if name[1:] in names:
            state = False
            for e in sorted((e for e in log if e[:3] == name and e[3] is not None and e[3] <= day), key=lambda e: (e[3], not e[4])):
                state = e[4]
            n[name[0]] += state
    return n["block"], n["allow"]


def test_captures_against_replayed_lists(spark):
    rnd = random.Random(8)
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(i)
    values = [("domain", "example.com"), ("domain", "com"), ("host", "a.example.com"), ("prefix", "b.example.com/x/y"),
              ("prefix", "a.example.com/x"), ("host", "c.org")]
    log = [(rnd.choice(["block", "allow"]), *rnd.choice(values), day(rnd.randrange(30)), rnd.random() < 0.6)
           for _ in range(60)] + [("block", "host", None, day(1), True), ("block", "host", "c.org", None, True)]
    urls = ["http://a.example.com/x/y?q=1", "https://user@B.Example.com:80/x/y/z", "http://c.org", "http://d.c.org./#f",
            "no url", None, "", "http://b.example.com//x//y", "ftp://com/", "http:///path"]
    captures = [(i, rnd.choice(urls), day(rnd.randrange(32)) if rnd.random() < 0.95 else None) for i in range(300)]
    captures += captures[:3]
    frame = spark.createDataFrame(captures, "id long, url string, fetched date").selectExpr(
        "*", "1 as n_active", "2 as list", "3 as hit_url", "4 as value")
    entries = spark.createDataFrame(log, "list string, kind string, value string, dated date, added boolean")
    got = url_filter.evaluate(frame, entries, ["id"]).collect()
    want = []
    for i, url, fetched in captures:
        block, allow = plain_verdict(url, fetched, log)
        want.append((i, block + allow, block, allow, block > 0 and allow == 0))
    assert sorted(map(tuple, got)) == sorted(want)
    assert any(r.blocked for r in got) and any(r.n_allow for r in got)
    assert url_filter.evaluate(frame, entries.limit(0), ["id"]).where("blocked").count() == 0
    assert url_filter.evaluate(frame.limit(0), entries, ["id"]).count() == 0
