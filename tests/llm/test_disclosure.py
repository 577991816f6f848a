"""Personal data: base detection against the plain patterns, disclosure against counting by hand."""

import hashlib
import math
import random
import re

import pytest

from learnlake.llm import disclosure
from learnlake.llm.disclosure import Disclosure

# The patterns as stated.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    out += [("ip", *m.span()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(CARD, text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(PHONE, text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_detection_equals_the_patterns():
    rnd = random.Random(2)
    parts = ["a", "b.c", "@", ".", "-", "1", "255", "256", "+", " ", "(", ")", "é", "\n", "x@y.zz", "4539578763621486",
             "0001.2.3.4", "+1 (555) 123-4567", "%", "_", "٣", "a@b.c_d@e.f"]
    for _ in range(6000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(14)))
        assert disclosure.base_spans(text) == plain_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "@" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000,
                 "a@b" * 60_000, "+1(" * 100_000):
        disclosure.base_spans(text)


def corpus():
    rows = []
    for i in range(6):
        rows.append((i, f"filler{i} words Zorgon keeper writes bob@example.com about things number{i}"))
    rows += [(10 + i, f"plain text about things words number{i} keeper") for i in range(30)]
    rows += [(50, None), (51, ""), (None, "call +1 (555) 123-4567 now"), (52, "x 10.0.0.1 y"), (52, "x 10.0.0.1 y")]
    return rows


def brute_classes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "email":
        return {(kind, value.lower()), (kind, "pool", value.lower().split("@")[1])}
    if kind == "ip":
        return {(kind, value), (kind, "pool", tuple(value.split(".")[:3]))}
    return {(kind, digits), (kind, "pool", digits[:6 if kind == "card" else 5])}


def brute_places(text):
    """(term, start, end): runs of letters and digits with a digit, and runs of letters, from two characters on."""
    out = []
    for m in re.finditer(r"[^\W_]{2,}", text):
        if re.search(r"\d", m[0]):
            out.append((m[0].lower(), *m.span()))
        out += [(x[0].lower(), m.start() + x.start(), m.start() + x.end()) for x in re.finditer(r"[^\W\d_]{2,}", m[0])]
    return out


def brute_terms(rows, rule):
    """{row: spans of disclosing terms}, from sets of documents."""
    of_term, of_class, near, spans_of = {}, {}, {}, []
    for i, (_, text) in enumerate(rows):
        text = text or ""
        spans = plain_spans(text)
        spans_of.append(spans)
        places = brute_places(text)
        for t, _, _ in places:
            of_term.setdefault(t, set()).add(i)
        for c in {c for kind, a, b in spans for c in brute_classes(kind, text[a:b])}:
            of_class.setdefault(c, set()).add(i)
        if spans:
            near[i] = {t for t, a, b in places if not any(a < y and x < b for _, x, y in spans)}
    found = set()
    for c, holders in of_class.items():
        for t in set().union(*(near[i] for i in holders)):
            n, k = len(of_term[t]), sum(t in near[i] for i in holders)
            p, z2 = k / n, rule.z ** 2
            low = (p + z2 / (2 * n) - rule.z * math.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)
            if low > 0 and -math.log2(low) <= rule.remaining_bits and math.log2(low * len(rows) / len(holders)) >= rule.gained_bits:
                found.add(t)
    out = {}
    for i, (_, text) in enumerate(rows):
        for t, a, b in brute_places(text or ""):
            if t in found and not any(a < y and x < b for _, x, y in spans_of[i]):
                out.setdefault(i, set()).add((a, b))
    return out


def address_book(rnd, n):
    """Random texts whose words go with addresses, domains, networks and number prefixes to several degrees."""
    rows = []
    for i in range(n):
        words = [rnd.choice("common words about many plain things".split()) for _ in range(12)]
        k = rnd.randrange(8)
        entity = {0: f"user{i}@brimstone.org", 1: f"10.1.2.{i % 250}", 2: "Ann@Example.org", 3: f"+4930{i:07d}"}.get(k, "")
        term = {0: "Brimstone", 1: "rack7b", 2: "Bo", 3: "Berlin"}.get(k, "")
        if term and rnd.random() < 0.8:
            words.insert(rnd.randrange(12), term)
        if rnd.random() < 0.02:
            words.append(rnd.choice(["Brimstone", "Berlin", "rack7b"]))
        rows.append((i, " ".join([*words, entity, f"number{i}", rnd.choice(["user7", ""])])))
    return rows


def expected_spans(rows, terms):
    out = []
    for i, (doc_id, text) in enumerate(rows):
        base = [f"{k}:{a}:{b}" for k, a, b in plain_spans(text or "")]
        added = [f"term:{a}:{b}" for a, b in sorted(terms.get(i, ()))]
        out.append((str(doc_id), hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(base + added)))
    return sorted(out)


@pytest.mark.parametrize("book", [False, True])
def test_spans_equal_counting_by_hand(spark, book):
    rows = address_book(random.Random(4), 1500) if book else corpus()
    rule = Disclosure()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "1 as uid", "2 as base", "3 as contexts", "4 as terms", "5 as n_email")
    terms = brute_terms(rows, rule)
    assert terms
    got = disclosure.personal_data(docs.repartition(6), rule).collect()
    assert sorted((str(r.doc_id), r.base_sha256, r.spans) for r in got) == expected_spans(rows, terms)


def test_verdicts_do_not_depend_on_the_size_of_the_corpus(spark):
    rows = address_book(random.Random(4), 600)
    small = spark.createDataFrame(rows, "doc_id long, text string")
    # Ten times as many documents that have nothing to do with the entities.
    more = [(10_000 + i, f"other text number{i} of the corpus") for i in range(9 * len(rows))]
    large = small.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    one, ten = ({r.term for r in disclosure.disclosing_terms(d, Disclosure()).collect()} for d in (small, large))
    assert one == ten and "brimstone" in one and "common" not in one


def test_documents_with_many_entities(spark):
    listed = " ".join(f"u{i}@host{i}.org name{i}" for i in range(600))
    rows = [(0, listed), (1, listed + " more"), *((2 + i, "Kestrel writes kim@firm.org") for i in range(9))]
    rows += [(100 + i, "plain words") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((str(r.doc_id), r.base_sha256, r.spans) for r in disclosure.personal_data(docs).collect()) == expected_spans(
        rows, brute_terms(rows, Disclosure()))


def test_stage_rewrites_texts_only_where_needed(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "length(text) as n_chars", "7 as uid", "8 as terms")
    got = disclosure.sanitised(docs)
    assert got.columns == docs.columns
    texts = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(rows)
    assert "bob@" not in texts[0].text and "[EMAIL]" in texts[0].text and "zorgon" not in texts[0].text.lower()
    assert texts[0].n_chars == len(texts[0].text)
    assert texts[12].text == dict(rows)[12] and texts[50].text is None and texts[51].text == ""
    assert texts[None].text == "call [PHONE] now" and texts[52].text == "x [IP] y"


def test_one_coincidence_is_no_evidence_but_pooled_values_are(spark):
    rows = [(i, f"common words about things number {i}") for i in range(3000)]
    rows += [(3000, "common words by Quillfeather at q@example.org"), (3001, "about Brimstone 10.1.2.3 things"),
             (3002, "words Brimstone 10.1.2.3 common")]
    rows += [(4000 + i, f"Ravenscroft of p{i}@tower.org") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in disclosure.personal_data(docs).where("spans like '%term%'").collect()}
    assert set(spans) == {4000 + i for i in range(4)} and all("term:0:11" in s for s in spans.values())


def test_terms_count_in_the_whole_document_and_go_everywhere(spark):
    far = " ".join(["common words about things"] * 10)
    rows = [(i, "common words about things") for i in range(3000)]
    rows += [(3000 + i, f"Bo {far} ann@example.org {far} Thornapple ref77 and Thornapple") for i in range(9)]
    rows += [(3009, "here Thornapple is named without the address")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in disclosure.sanitised(docs).where("doc_id >= 3000").collect()}
    assert len(out) == 10
    for i, text in out.items():
        assert "Thornapple" not in text and "ref77" not in text and "Bo" not in text, i
        # "and" stands nowhere else either.
        assert text.count("[TERM]") == (1 if i == 3009 else 5)


def test_terms_of_much_evidence_are_removed(spark):
    rows = [(i, f"plain words {i}") for i in range(400)] + [(1000 + i, f"see Kestrel kim@firm.org words {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in disclosure.sanitised(docs).collect()}
    assert out[1000] == "  [EMAIL] words 0" and out[3] == "plain words 3"


def test_long_term_runs_take_linear_time():
    for text in ("a" * 300_000, "a1" * 150_000, "1" * 300_000, "a_" * 100_000):
        assert {t for t, *_ in disclosure.terms_of(text)} == disclosure.distinct_terms(text)


def test_overlapping_spans_become_one():
    assert disclosure.redact("abcdef", [("ip", 1, 3), ("card", 2, 5)]) == "a[IP]f"


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n_chars long")
    assert disclosure.personal_data(docs).count() == 0 and disclosure.sanitised(docs).count() == 0
