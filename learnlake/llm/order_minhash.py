"""Order MinHash fingerprints, in DataFrame functions only.

The k-mers of a text are runs of ``K`` words, each with the number of its occurrence, so that repeats count. A hash
puts every numbered k-mer into one of ``SKETCHES`` sketches, each sketch keeps its ``PICKED`` smallest hashes in the
order in which they stand in the text, and the hash of that tuple is one place of the fingerprint: moving text about
changes it as well as editing does. Likeness is the share of equal places among those that either text fills.

A text's k-mers stay inside its row: sorting them brings equal ones together in text order, so one fold over the sorted
array numbers the occurrences and keeps the smallest hashes. No k-mer is exploded or shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnlake.functions.ordering import add_buckets
from learnlake.llm.common import SPACES, written

K = 3
SKETCHES = 32
PICKED = 2
# Hex digits of one place of the fingerprint; an empty sketch is written as dashes.
DIGITS = 8
EMPTY = "-" * DIGITS
# Ranges of ids per shuffle partition.
RANGES = 4
# Words of a text that can be told apart by position: more than a row can hold.
POSITION_BITS = 28


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, although ``use`` refers to it in lambda functions."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sorted_kmers(text: Column, k: int = K) -> Column:
    """The k-mers of a text, sorted, each as 35 bits of hash and below them its position.

    Fewer words than k are one k-mer, no words give an empty array.
    """
    stripped = F.btrim(text, F.lit(SPACES))

    def kmers(words: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(words) - k, F.lit(0))),
            lambda i: _packed(F.xxhash64(*[F.get(words, i + j) for j in range(k)]), i))

    found = _bound(F.split(stripped, r"[\x20\x09-\x0D]+"), kmers)
    return F.sort_array(F.when(stripped == "", F.array().cast("array<bigint>")).otherwise(found))


def _packed(digest: Column, position: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(digest, POSITION_BITS + 1), POSITION_BITS).bitwiseOR(position.cast("long"))


def sketch_tuples(text: Column) -> Column:
    """The tuple hash of each sketch, null where it is empty."""
    nothing = F.lit((1 << 63) - 1)
    low = F.lit((1 << POSITION_BITS) - 1)

    def step(state: Column, x: Column) -> Column:
        kmer = F.shiftright(x, POSITION_BITS)
        nth = F.when(kmer == state["kmer"], state["nth"] + 1).otherwise(F.lit(1))
        digest = F.xxhash64(kmer, nth)
        sketch = F.pmod(digest, F.lit(SKETCHES)).cast("int")
        entry = _packed(digest, x.bitwiseAND(low))
        kept, old = state["kept"], F.get(state["kept"], sketch)
        new = F.slice(F.sort_array(F.array_append(old, entry)), 1, PICKED)
        changed = F.concat(
            F.slice(kept, 1, sketch), F.array(new), F.slice(kept, sketch + 2, F.lit(SKETCHES)))
        # Most k-mers are not among the smallest of their sketch and leave everything as it is.
        kept = F.when(entry < F.get(old, F.lit(PICKED - 1)), changed).otherwise(kept)
        return F.struct(kmer.alias("kmer"), nth.alias("nth"), kept.alias("kept"))

    start = F.struct(
        F.lit(-1).cast("long").alias("kmer"), F.lit(0).alias("nth"),
        F.array_repeat(F.array_repeat(nothing, PICKED), SKETCHES).alias("kept"))

    def place(kept: Column) -> Column:
        real = F.filter(kept, lambda x: x != nothing)
        by_position = F.array_sort(F.transform(real, lambda x: F.struct(
            x.bitwiseAND(low).alias("at"), F.shiftright(x, POSITION_BITS).alias("hash"))))
        return F.when(F.get(kept, F.lit(0)) != nothing, F.xxhash64(F.transform(by_position, lambda x: x["hash"])))

    return F.aggregate(sorted_kmers(text), start, step, lambda state: F.transform(state["kept"], place))


def as_text(places: Column) -> Column:
    """The fingerprint: ``DIGITS`` hex digits per sketch."""
    return F.array_join(F.transform(places, lambda p: F.when(p.isNull(), EMPTY).otherwise(
        F.lower(F.substring(F.lpad(F.hex(p), 16, "0"), 1, DIGITS)))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal places among those that at least one of two fingerprints fills; 1 for two empty ones."""
    places = F.sequence(F.lit(0), F.lit(SKETCHES - 1))
    part = lambda f, i: F.substr(f, i * DIGITS + 1, F.lit(DIGITS))
    pairs = F.transform(places, lambda i: F.struct(part(a, i).alias("a"), part(b, i).alias("b")))
    filled = F.size(F.filter(pairs, lambda p: (p["a"] != EMPTY) | (p["b"] != EMPTY)))
    equal = F.size(F.filter(pairs, lambda p: (p["a"] == p["b"]) & (p["a"] != EMPTY)))
    return F.when(a == b, 1.0).otherwise(equal / F.greatest(filled, F.lit(1)))


def fingerprints(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``fingerprint`` of every row; a null text counts as empty, and equal texts get equal fingerprints."""
    return docs.select(*keys, as_text(sketch_tuples(F.coalesce("text", F.lit("")))).alias("fingerprint"))


def _range_starts(docs: DataFrame) -> list[float]:
    """The smallest id of each range, by Spark's own range partitioning: as many as shuffle partitions times RANGES."""
    wanted = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.where("doc_id is not null").select(F.col("doc_id").cast("double").alias("id"))
    parts = ids.repartitionByRange(wanted, "id").groupBy(F.spark_partition_id().alias("part")).agg(F.min("id").alias("id"))
    return sorted({r["id"] for r in parts.collect()})


def with_next(docs: DataFrame) -> DataFrame:
    """(uid, doc_id, text, next_uid, next_text) of every row.

    The next document follows by ascending doc_id (null first, equal ids by a hash of the text), after the last comes
    the first. Ranges of ids are dealt to parts; the rows with a range's smallest id also visit the range before it,
    so that every row finds its successor at home and each text is shuffled once.
    """
    starts = _range_starts(docs)
    uid = F.monotonically_increasing_id().alias("uid")
    rows = docs.select(uid, "doc_id", F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))).alias("id"))
    rows = add_buckets(rows, {"id": starts[1:]}).withColumnRenamed("id_bucket", "own").withColumn(
        "own", F.col("own").cast("int"))
    lowest = rows.agg(F.min("id")).first()[0]
    last, here = len(starts[1:]), F.lit(0)
    opens = F.col("id").isin(starts[1:]) if len(starts) <= 256 else F.array_contains(
        F.lit(starts[1:]).cast("array<double>"), F.col("id"))
    home = F.struct(F.col("own").alias("part"), here.alias("lap"), F.lit(False).alias("guest"))
    visit = F.when(opens, F.struct((F.col("own") - 1).alias("part"), here.alias("lap"), F.lit(True).alias("guest")))
    again = F.when(F.col("id") == F.lit(lowest if lowest is not None else 0.0), F.struct(
        F.lit(last).alias("part"), F.lit(1).alias("lap"), F.lit(True).alias("guest")))
    dealt = rows.withColumn("to", F.explode(F.array_compact(F.array(home, visit, again)))).select("uid", "doc_id", "text", "to.*")
    order = Window.partitionBy("part").orderBy(
        "lap", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "uid")
    followed = dealt.repartition("part").select(
        "*", F.lead("uid").over(order).alias("next_uid"), F.lead("text").over(order).alias("next_text"))
    return followed.where(~F.col("guest")).select("uid", "doc_id", "text", "next_uid", "next_text")


def fingerprints_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The edited text has its last quarter (floor) of code points replaced by as many of the next document's first, or
    all it has. A single document follows itself. Null texts count as empty.
    """
    rows = with_next(docs)
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - quarter), F.substr("next_text", F.lit(1), quarter))
    rows = rows.withColumn("edited", edited)
    prints = written(rows.select(
        "uid", "next_uid", "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(sketch_tuples(F.col("text"))).alias("fingerprint"),
        as_text(sketch_tuples(F.col("edited"))).alias("edited_fingerprint")), "fingerprints")
    following = prints.select(F.col("uid").alias("next_uid"), F.col("fingerprint").alias("next_fingerprint"))
    own = F.col("fingerprint")
    return prints.join(following, "next_uid").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(own, F.col("edited_fingerprint")).alias("near_edited"),
        likeness(own, F.col("next_fingerprint")).alias("near_next"))
