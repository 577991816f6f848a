"""Language identification: held-out accuracy, the algebra against a plain version, and edge cases."""

import numpy as np

from learnlake.llm import language


def plain_bundle(text):
    """The bundle of one text, gram by gram."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    total = np.zeros(language.DIMENSIONS)
    padded = " " + " ".join(words) + " " if words else ""
    for i in range(len(padded) - 2):
        a, b, c = (language.character_vectors(np.array([ord(x)])) for x in padded[i:i + 3])
        bits = np.unpackbits((np.roll(a, 2, 1) ^ np.roll(b, 1, 1) ^ c).view(np.uint8))
        total += 1.0 - 2.0 * bits
    return total


def test_classify_equals_plain_cosine():
    texts = ["Hello, wörld", "", "a", "ab 1 cd\n\nx", "12 !", "ß" * 50, "öäü 漢字 \U00020000 x", "x\ud800y"]
    rows = [plain_bundle("hello world of words"), plain_bundle("öäü ß und straße"), plain_bundle("漢字")]
    model = language.LanguageModel(("en", "de", "zh"), np.array(rows))
    names, scores = language.classify(texts, model)
    for text, name, score in zip(texts, names, scores, strict=True):
        x = plain_bundle(text)
        if not x.any():
            assert (name, score) == ("und", 0)
            continue
        cosines = [x @ p / np.linalg.norm(x) / np.linalg.norm(p) for p in rows]
        assert name == model.languages[int(np.argmax(cosines))]
        assert abs(score - max(0.0, max(cosines))) < 1e-4


def test_fit_is_the_sum_of_bundles(spark):
    rows = [(1, "abc abc", "x"), (2, "abd", "x"), (3, "zzz", "y"), (4, None, "y"), (5, "q", None), (6, "", "z")]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr(
        "*", "1 as gram", "2 as n", "3 as dim"))
    assert model.languages == ("x", "y")
    assert np.allclose(model.prototypes[0], plain_bundle("abc abc") + plain_bundle("abd"))
    assert np.allclose(model.prototypes[1], plain_bundle("zzz"))


def test_documents_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.language_of_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and 250 < len(held) < 420
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_edge_rows(spark):
    rows = [(1, "abc", "x"), (None, "abc", None), (2, None, "x"), (2, "12", "x"), (3, "", None), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr(
        "*", "0.5 as score", "'?' as lang_pred", "true as held_out")
    got = language.language_of_documents(docs).collect()
    assert len(got) == 6 and {r.lang_pred for r in got if r.doc_id in (2, 3)} == {"und"}
    model = language.fit(docs)
    kept = language.recognised(docs, model, 0.1)
    assert kept.columns == docs.columns and [r.text for r in kept.collect()] == ["abc", "abc"]
    nothing = language.fit(docs.limit(0))
    assert nothing.languages == ()
    assert {r.lang_pred for r in language.identify(docs, nothing, ["doc_id"]).collect()} == {"und"}
