"""The pipeline against a plain version of every stage."""

import hashlib
import math
import sys
import zlib
from pathlib import Path

import corpus_pipeline
import public_tokenizers

sys.path.insert(0, str(Path(__file__).resolve().parent))
from test_disclosure import brute_terms, plain_spans  # noqa: E402
from test_mixing import reshared  # noqa: E402
from test_simhash import brute_components, brute_fingerprint  # noqa: E402
from test_tokens import le, library  # noqa: E402

from learnlake.llm import disclosure, language  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain_pieces(rows, model):
    names, scores = language.classify([r["text"] or "" for r in rows], model)
    rows = [r for r, n, s in zip(rows, names, scores, strict=True)
            if n != "und" and s >= corpus_pipeline.MIN_LANGUAGE_SCORE]
    roots = brute_components([r["doc_id"] for r in rows], [brute_fingerprint(r["text"]) for r in rows])
    rows = [r for r, root in zip(rows, roots, strict=True) if r["doc_id"] == root]
    terms = brute_terms([(r["doc_id"], r["text"]) for r in rows], disclosure.Disclosure())
    for i, r in enumerate(rows):
        spans = plain_spans(r["text"])
        assert i not in terms or spans
        r["text"] = disclosure.redact(r["text"], spans + [("term", *s) for s in terms.get(i, ())])
    sizes = {}
    for r in rows:
        r["size"] = len([w for w in r["text"].encode().split()])
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    targets = reshared(sizes)
    tokenizer, out = library(public_tokenizers.path("word_bpe_49k.json")), []
    for r in rows:
        rate = targets[r["source"]] / sizes[r["source"]]
        draw = int(hashlib.md5(f"mix-1:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2**52
        ids = tokenizer.encode(r["text"], add_special_tokens=False).ids + [2]
        for _ in range(math.floor(rate) + (draw < rate - math.floor(rate))):
            out += [(r["doc_id"], s, len(ids[s:s + 4096]), zlib.crc32(le(ids[s:s + 4096])), len(ids))
                    for s in range(0, len(ids), 4096)]
    return sorted(out)


def test_pipeline_equals_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs.where(~language.held_out(docs["doc_id"])))
    got = corpus_pipeline.run(spark, SF).collect()
    expected = plain_pieces([r.asDict() for r in docs.collect()], model)
    assert sorted((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == expected
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for members in by_sequence.values():
        ends = [0, *[a + n for a, n in sorted(members)]]
        assert [a for a, _ in sorted(members)] == ends[:-1] and ends[-1] <= 4096


def test_stages_handle_odd_rows(spark):
    rows = [(1, None, None, None, None), (None, "Some words in a text here", "en", "s", 25), (2, "", "en", "s", 0),
            (3, "mail a@b.cd now and then again", "en", None, 30), (3, "mail a@b.cd now and then again", "en", None, 30),
            (4, "word " * 20_000, "xx", "s", 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "1 as uid", "2 as fp", "3 as size", "4 as start", "5 as terms", "6 as base")
    for table in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            result = stage(spark, table, SF)
            assert result.schema.names == docs.schema.names
            table = corpus_pipeline.written(result, "test-stage")
        packed = corpus_pipeline.STAGES[-1][1](spark, table, SF)
        assert {"doc_id", "start", "sequence_id", "offset"} <= set(packed.columns)
        packed.collect()
