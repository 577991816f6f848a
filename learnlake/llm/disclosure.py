"""Personal data, and terms that disclose it.

Base detection finds e-mail addresses, IP addresses, payment cards and phone numbers by form. What stands near such an
entity may give it away as well. How strongly is estimated from the corpus. Entities form classes: one for each value,
and one for each domain, network or number prefix, so that values found in few documents are judged together. With
document counts n, the share of a term's documents that hold class c is estimated from below (Wilson's bound)

    p(c|t) = lower bound of n(c,t) / n(t),

and a term discloses c where both

    -log2 p(c|t)                <=  ``remaining_bits``   (little is left to guess about c once t is known), and
    log2(p(c|t) / (n(c) / N))   >=  ``gained_bits``      (t tells much more than c's frequency alone).

The bound is one continuous formula for all counts: a coincidence in one or two documents never suffices, and the size
of the corpus N matters only for classes in a good part of all documents. Disclosing terms are generalised, or removed
where p(c|t) reaches ``remove_share``, wherever they occur in any text. Counts are of whole documents and cover all of
them.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.llm.common import fresh, in_slices, written

SLICE_BYTES = 8 << 20
# The kinds in their order and the forms of the base detection.
KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# The look-behind only skips starts inside a run of digits, which could not match where the run's start does not.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile("[0-9]")
_RUN = re.compile(r"[^\W_]{2,}")
_LETTERS = re.compile(r"[^\W\d_]{2,}")
_ANY_DIGIT = re.compile(r"\d")
PLACEHOLDERS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]", "gone": ""}
# Characters of a value's leading digits that form its pool.
POOL_DIGITS = {"card": 6, "phone": 5}
# Bits per disclosing term in the filter that saves looking up most terms of a text, and the most bits it may have.
FILTER_BITS, MOST_FILTER_BITS = 32, 1 << 26
# Term counts a task holds before it sends them.
COUNTED_TERMS = 500_000


@dataclass(frozen=True)
class Disclosure:
    """Thresholds in bits; ``z`` is the number of standard errors of the lower bound."""

    remaining_bits: float = 1.0
    gained_bits: float = 2.0
    z: float = 1.96
    remove_share: float = 0.9

    @property
    def least_documents(self) -> int:
        """The fewest documents of a pair that could pass, if the term had no others: n / (n + z * z) is the bound."""
        share = 2.0 ** -self.remaining_bits
        return max(1, math.ceil(self.z ** 2 * share / (1 - share) - 1e-9))


def lower_bound(hits: Column, n: Column, z: float) -> Column:
    """Wilson's lower bound of a share of which ``hits`` of ``n`` were seen."""
    share, z2 = hits / n, z * z
    return (share + z2 / (2 * n) - z * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches; every character is looked at a bounded number of times."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARACTERS:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", domain.end() if domain else at + 1)


def _luhn(digits: str) -> bool:
    doubled = (2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])
    return (sum(doubled) + sum(map(int, digits[-1::-2]))) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed and then start."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(map(m[0].count, "0123456789")) <= 15:
                found.append(("phone", *m.span()))
    return found


def classes_of(kind: str, value: str) -> set[int]:
    """The value itself, whatever its letter case or punctuation, and its domain, network or leading digits."""
    if kind in POOL_DIGITS:
        plain = "".join(c for c in value if c in "0123456789")
        pool = plain[:POOL_DIGITS[kind]]
    else:
        plain = value.lower()
        pool = plain.partition("@")[2] if kind == "email" else plain.rpartition(".")[0]
    return {xxhash.xxh64_intdigest(name) - (1 << 63) for name in (f"{kind}:{plain}", f"{kind} pool:{pool}")}


def terms_of(text: str) -> list[tuple[str, int, int]]:
    """(term, start, end): runs of two or more letters, and whole runs of letters and digits that have a digit."""
    out = []
    for m in _RUN.finditer(text):
        run, at = m[0], m.start()
        if _ANY_DIGIT.search(run):
            out.append((run.lower(), *m.span()))
            out += [(w[0].lower(), at + w.start(), at + w.end()) for w in _LETTERS.finditer(run)]
        else:
            out.append((run.lower(), *m.span()))
    return out


def distinct_terms(text: str) -> set[str]:
    """The terms of ``terms_of``, each once."""
    runs = set(_RUN.findall(text))
    parts = {w for run in runs if _ANY_DIGIT.search(run) for w in _LETTERS.findall(run)}
    return {t.lower() for t in runs | parts}


def outside(terms: list[tuple[str, int, int]], spans: list[tuple[str, int, int]], size: int) -> list[tuple[str, int, int]]:
    """The ``terms`` that share no character with a span."""
    if not spans or not terms:
        return terms
    marked = np.zeros(size + 2, np.int64)
    for _, a, b in spans:
        marked[a + 1] += 1
        marked[b + 1] -= 1
    covered = np.cumsum(np.cumsum(marked) > 0)
    return [t for t in terms if covered[t[2]] == covered[t[1]]]


FOUND = (
    "n_email long, n_ip long, n_card long, n_phone long, base string, "
    "places array<struct<term:string,start:bigint,end:bigint>>"
)
_CANDIDATES = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _joined(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def holders(docs: DataFrame) -> DataFrame:
    """(uid, classes, terms): what the documents that hold an entity hold, each once, written to the shared folder."""
    source = docs.select(F.monotonically_increasing_id().alias("uid"), "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text", SLICE_BYTES):
            rows = []
            for uid, text in zip(batch.column("uid").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if spans := base_spans(text or ""):
                    near = outside(terms_of(text), spans, len(text))
                    found = set().union(*(classes_of(k, text[a:b]) for k, a, b in spans))
                    rows.append((uid, sorted(found), list({t for t, *_ in near})))
            uids, classes, terms = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_pydict({
                "uid": pa.array(uids, pa.int64()), "classes": pa.array(classes, pa.list_(pa.int64())),
                "terms": pa.array(terms, pa.list_(pa.string()))})

    return written(source.mapInArrow(run, "uid long, classes array<bigint>, terms array<string>"), "entity-holders")


def locate(docs: DataFrame, keep: list[str], terms: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The columns ``keep`` of every row, a row number, base detection and places of ``terms``, in the shared folder.

    The places, outside all spans, are those of terms that pass a filter: the join with ``terms`` drops the rest.
    Also returns the names the added columns got, which avoid those in ``keep``.
    """
    names = ["uid", "n_email", "n_ip", "n_card", "n_phone", "base", "places"]
    source = docs.select(*dict.fromkeys([*keep, "text"]))
    new = dict(zip(names, fresh(source, *names), strict=True))
    source = source.withColumn(new["uid"], F.monotonically_increasing_id())
    kept = [*keep, new["uid"]]
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name in kept]
    order = [f.name for f in source.schema if f.name in kept]
    added = [f"`{new[n]}` {kind}" for n, kind in (part.strip().split(" ", 1) for part in FOUND.split(", "))]
    wanted = TermFilter(terms)

    def places(text: str, spans: list[tuple[str, int, int]]) -> list[dict]:
        passing = wanted.passing(distinct_terms(text)) if wanted.marked else None
        if not passing:
            return []
        here = [t for t in terms_of(text) if t[0] in passing]
        return [dict(zip(("term", "start", "end"), t, strict=True)) for t in outside(here, spans, len(text))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text", SLICE_BYTES):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            spans = [base_spans(t) for t in texts]
            counts = [Counter(k for k, *_ in s) for s in spans]
            columns = [pa.array([c[k] for c in counts], pa.int64()) for k in KINDS]
            columns.append(pa.array([_joined(s) for s in spans], pa.string()))
            columns.append(pa.array([places(t, s) for t, s in zip(texts, spans, strict=True)], _CANDIDATES))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in order], *columns], names=[*order, *[new[n] for n in names[1:]]])

    return written(source.mapInArrow(run, ", ".join([*fields, *added])), "personal-data"), new


class TermFilter:
    """One bit per CRC of a term: passes all of ``terms``, and few others while there are bits enough."""

    def __init__(self, terms: DataFrame) -> None:
        count = terms.count()
        self.bits = min(MOST_FILTER_BITS, max(1 << 10, 1 << (FILTER_BITS * count).bit_length()))
        bit = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(self.bits))
        rows = (
            terms.select(F.shiftright(bit.cast("long"), 5).alias("word"), bit.bitwiseAND(F.lit(31)).cast("int").alias("bit"))
            .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).collect()
        )
        words = np.zeros(self.bits // 32, np.uint32)
        for r in rows:
            words[r["word"]] = r["bits"]
        self.marked = words.view(np.uint8).tobytes() if count else b""

    def passing(self, terms: Iterable[str]) -> set[str]:
        if not self.marked:
            return set()
        out = set()
        for t in terms:
            h = crc32(t.encode()) % self.bits
            if self.marked[h >> 3] >> (h & 7) & 1:
                out.add(t)
        return out


def document_frequency(docs: DataFrame) -> DataFrame:
    """(term, n_term): in how many rows of ``docs`` (text) each term occurs, counted per task before the shuffle."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "term": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

        for batch in in_slices(batches, "text", SLICE_BYTES):
            for text in batch.column("text").to_pylist():
                if text:
                    seen.update(distinct_terms(text))
            if len(seen) > COUNTED_TERMS:
                yield flush()
                seen.clear()
        yield flush()

    return docs.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))


def disclosing_terms(docs: DataFrame, rule: Disclosure) -> DataFrame:
    """(term, share): terms that disclose a class of entities, and the largest lower bound of their share.

    Pairs are only counted for classes and terms that could pass: the class and the term must be in enough documents
    that hold an entity, and most of the term's documents must hold one. Classes with the same documents have the same
    counts and are one, known by its size and a hash of its documents.
    """
    held = holders(docs)
    least, share = rule.least_documents, 2.0 ** -rule.remaining_bits
    total = float(docs.count())
    single = held.select("uid", F.explode("classes").alias("class"))
    sizes = single.groupBy("class").agg(F.count("*").alias("n_class"), F.expr("bit_xor(xxhash64(uid))").alias("mark"))
    sizes = sizes.where((F.col("n_class") >= least) & (F.col("n_class") * 2.0 ** rule.gained_bits <= total))
    classes = single.join(sizes, "class").select("uid", "n_class", "mark").distinct()
    terms = held.select("uid", F.explode("terms").alias("term"))
    near = terms.groupBy("term").agg(F.count("*").alias("n_held")).where(F.col("n_held") >= least)
    wanted = document_frequency(docs).join(near, "term").where(lower_bound(F.col("n_held"), F.col("n_term"), rule.z) >= share)
    wanted = written(wanted.select("term", "n_term"), "disclosure-terms")
    pairs = terms.join(wanted, "term").join(classes, "uid").groupBy("n_class", "mark", "term", "n_term").agg(
        F.count("*").alias("n_both"))
    judged = pairs.withColumn("share", lower_bound(F.col("n_both"), F.col("n_term"), rule.z))
    gained = F.log2(F.col("share") * total / F.col("n_class"))
    best = judged.where((F.col("share") >= share) & (gained >= rule.gained_bits))
    return written(best.groupBy("term").agg(F.max("share").alias("share")), "disclosing-terms")


def _with_term_spans(rows: DataFrame, new: dict[str, str], terms: DataFrame, rule: Disclosure) -> tuple[DataFrame, str]:
    """``rows`` of ``locate`` with an array of the spans of disclosing terms, and that column's name.

    Each span has a flag that tells whether it is removed; null where there are none.
    """
    owner, added = fresh(rows, "owner", "terms")
    uses = rows.where(F.size(new["places"]) > 0).select(
        F.col(new["uid"]).alias(owner), F.explode(new["places"]).alias("p")).select(owner, "p.*")
    span = F.struct("start", "end", (F.col("share") >= rule.remove_share).alias("gone"))
    spans = uses.join(terms, "term").groupBy(owner).agg(F.array_sort(F.collect_list(span)).alias(added))
    return rows.join(spans, rows[new["uid"]] == spans[owner], "left").drop(owner), added


def personal_data(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """doc_id, counts per kind, SHA-256 of the base spans, and all spans as text; one row per row of ``docs``.

    Null texts count as empty; they, empty texts and texts without personal data or disclosing terms have no spans
    (the SHA-256 of the empty text). Spans are ``kind:start:end`` in code points, end exclusive, by kind as listed,
    ``term`` last.
    """
    terms = disclosing_terms(docs, rule)
    found, new = locate(docs, ["doc_id"], terms)
    rows, added = _with_term_spans(found, new, terms, rule)
    text = F.array_join(F.transform(added, lambda s: F.concat_ws(":", F.lit("term"), s["start"], s["end"])), ",")
    spans = F.concat_ws(",", F.when(F.col(new["base"]) != "", F.col(new["base"])), text)
    return rows.select(
        "doc_id", *[new[f"n_{k}"] for k in KINDS], F.sha2(F.col(new["base"]), 256).alias("base_sha256"),
        spans.alias("spans"))


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Every span replaced by its kind's placeholder; overlapping ones become one with the first one's."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], PLACEHOLDERS[kind]]
        done = max(done, b)
    return "".join([*out, text[done:]])


def sanitised(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """Documents, all columns, with personal data and disclosing terms replaced in ``text``.

    No row is dropped. Texts without personal data or disclosing terms stay as they are, null included; ``n_chars``, where present, is
    the new length of a changed text.
    """
    terms = disclosing_terms(docs, rule)
    found, new = locate(docs, docs.columns, terms)
    touched, added = _with_term_spans(found.where(F.size(new["places"]) > 0), new, terms, rule)
    touched = touched.select(*docs.columns, new["base"], added)
    # The many rows without such terms take no part in the join.
    rest = found.where(F.size(new["places"]) == 0).select(
        *docs.columns, new["base"], F.lit(None).cast(touched.schema[added].dataType).alias(added))
    both = rest.unionByName(touched)
    columns_out, base_column = docs.columns, new["base"]
    lengths = [c for c in columns_out if c == "n_chars"]

    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text", SLICE_BYTES):
            texts, changed = batch.column("text").to_pylist(), set()
            for i, (base, near) in enumerate(zip(
                    batch.column(base_column).to_pylist(), batch.column(added).to_pylist(), strict=True)):
                spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in base.split(",") if s)]
                spans += [("gone" if s["gone"] else "term", s["start"], s["end"]) for s in near or []]
                if spans:
                    texts[i] = redact(texts[i], spans)
                    changed.add(i)
            columns = {c: batch.column(c) for c in columns_out}
            columns["text"] = pa.array(texts, pa.string())
            for c in lengths:
                old = columns[c].to_pylist()
                columns[c] = pa.array([len(texts[i]) if i in changed else n for i, n in enumerate(old)], columns[c].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return both.mapInArrow(rewrite, docs.schema)
