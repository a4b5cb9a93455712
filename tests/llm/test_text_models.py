"""Quality, language and pieces."""

import math

import numpy as np
import pytest
import zstandard
from cases import ROWS, documents, prose, tuples
from pyspark.sql import functions as F
from rankflow.llm import langid, pieces, quality
from rankflow.llm.lattice import Vocabulary, load_vocabulary, log_marginals


def test_quality_on_held_out_texts(spark):
    good = [prose(i, 60, 3000) for i in range(300)]
    bad = [" ".join(f"{w}$$$ |" for w in prose(1000 + i, 40, 3000).split(" ")) for i in range(300)]
    rows = [(i, text, None, None, None) for i, text in enumerate(good + bad)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(600)] + [(1, 1), (None, 0), (5, None), (7, 3)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels.filter("doc_id % 3 != 0 OR doc_id IS NULL"))
    scored = dict(tuples(quality.score(docs, model, out="p").filter("doc_id % 3 = 0"), "doc_id", "p"))
    right = sum((p >= 0.7) == (i < 300) for i, p in scored.items())
    assert right / len(scored) > 0.97
    odd = tuples(quality.score(documents(spark), model), "doc_id", "text", "score")
    assert len(odd) == len(ROWS) and all(0 <= p <= 1 for *_, p in odd)
    by_text = {text: p for _, text, p in odd}
    assert by_text[None] == by_text[""]


def plain_score(model, text):
    """The score by plain compression of the blocks, without the operator's own helpers."""
    data, sizes = (text or "").encode(), []
    for dictionary in (model.good, model.bad):
        packer = zstandard.ZstdCompressor(
            dict_data=zstandard.ZstdCompressionDict(dictionary), level=3, write_checksum=False
        )
        sizes.append(sum(len(packer.compress(data[i : i + 2048])) for i in range(0, len(data), 2048)))
    x = 100 * (sizes[1] - sizes[0]) / len(data) if data else 0.0
    return 1 / (1 + math.exp(-(model.slope * x + model.offset)))


def test_scores_equal_plain_compression(spark):
    good = [prose(i, 60, 3000) for i in range(80)]
    bad = [" ".join(f"{w}$$$ |" for w in prose(1000 + i, 40, 3000).split(" ")) for i in range(80)]
    rows = [(100 + i, text, None, None, None) for i, text in enumerate(good + bad)]
    labels = spark.createDataFrame([(100 + i, int(i < 80)) for i in range(160)], "doc_id bigint, quality int")
    docs = documents(spark, [*ROWS, *rows])
    model = quality.fit(docs, labels)
    got = tuples(quality.score(docs, model), "text", "score")
    assert len(got) == len(ROWS) + 160
    for text, score in got:
        assert score == pytest.approx(plain_score(model, text), abs=1e-9)


def test_one_defined_text_of_an_id_that_very_many_rows_share(spark):
    texts = [prose(i, 20) for i in range(3000)]
    rows = [(1, text, None, None, None) for text in texts] + [(i, prose(5000 + i, 30), None, None, None) for i in range(2, 60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 60)], "doc_id bigint, quality int")
    model = quality.fit(documents(spark, rows), labels)
    assert quality.fit(documents(spark, rows[::-1]).repartition(3), labels) == model
    least = spark.createDataFrame([(t,) for t in texts], "t string").orderBy(F.xxhash64("t")).first()["t"]
    assert quality.fit(documents(spark, [(1, least, None, None, None), *rows[3000:]]), labels) == model


def test_quality_without_a_class(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    model = quality.fit(documents(spark), labels)
    assert {row[0] for row in tuples(quality.score(documents(spark), model), "score")} == {1.0}
    model = quality.fit(documents(spark), labels.filter("false"))
    assert {row[0] for row in tuples(quality.score(documents(spark), model), "score")} == {0.5}


def brute_marginal(vocabulary: Vocabulary, text: str, weights: np.ndarray) -> np.ndarray:
    ids = {vocabulary.pieces[i]: i for i in vocabulary.kept}
    sums = [np.ones(weights.shape[1])]
    for t in range(1, len(text) + 1):
        total = np.zeros(weights.shape[1])
        for length in range(1, min(t, vocabulary.longest) + 1):
            piece = text[t - length : t]
            if piece in ids:
                total = total + sums[t - length] * weights[ids[piece]]
            elif length == 1:
                total = total + sums[t - 1] * weights[vocabulary.size]
        sums.append(total)
    return np.log(sums[-1])


def test_marginals_equal_brute_force():
    vocabulary = load_vocabulary()
    weights = np.random.default_rng(0).random((vocabulary.size + 1, 3)) * 1e-2
    texts = ["▁the", "▁internationalization", "x", "▁öß漢😀", "▁a▁b", "▁understand" * 5]
    for text, own in zip(texts, log_marginals(vocabulary, texts, weights)):
        assert np.allclose(own, brute_marginal(vocabulary, text, weights))
    long = log_marginals(vocabulary, ["ab" * 20_000], weights)
    assert np.isfinite(long).all()


def test_languages(spark):
    sample = {"en": "the house and the garden of this man", "de": "das haus und der garten von diesem mann"}
    rows = [(i, text, lang, None, None) for i in range(20) for lang, text in sample.items()]
    model = langid.fit(documents(spark, rows))
    got = tuples(langid.identify(documents(spark, [
        (1, "The garden", "de", None, None), (2, "Der Garten", None, None, None), (3, None, None, None, None),
        (4, "12 -- ²", "en", None, None), (5, "", None, None, None), (6, "the garden of " * 60_000, None, None, None),
    ]), model), "doc_id", F.col("language.lang"), F.col("language.score"))
    assert {i: lang for i, lang, _ in got} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", 6: "en"}
    assert all(0 <= p <= 1 for *_, p in got)
    unlearned = langid.fit(documents(spark, rows).filter("false"))
    assert {r[0] for r in tuples(langid.identify(documents(spark), unlearned), F.col("language.lang"))} == {"und"}


def test_pieces_are_lossless_and_seeded(spark):
    docs = documents(spark)
    coded = pieces.encode(docs)
    back = tuples(pieces.decode(coded), "doc_id", "text", "decoded", "ids")
    assert len(back) == len(ROWS)
    assert all(text == decoded for _, text, decoded, _ in back)
    assert all((ids is None) == (text is None) for _, text, _, ids in back)
    again = tuples(pieces.encode(docs.repartition(2)), "doc_id", "text", "ids")
    assert sorted(map(str, again)) == sorted(str((i, t, ids)) for i, t, _, ids in back)
    other = dict(tuples(pieces.encode(docs, seed=1).filter("doc_id IN (1, 10)"), "doc_id", "ids"))
    assert other[10] != next(ids for i, _, _, ids in back if i == 10)
    assert pieces.encode(docs.filter("false")).count() == 0


def test_every_code_point_survives(spark):
    marks = ["a\U0010ffffb", "▁", " ▁ ▁▁  ", "\ud7ff\ue000\U00010000", "\x01\x7f", "<0x41><unk></s>", "\ufffd\ufffe\uffff"]
    texts = [*marks, "".join(marks), *("x" + chr(c) + " y" for c in range(1, 0x3000, 7))]
    rows = [(i, text, None, None, None) for i, text in enumerate(texts)]
    back = dict(tuples(pieces.decode(pieces.encode(documents(spark, rows))), "doc_id", "decoded"))
    assert [back[i] for i in range(len(texts))] == texts


def test_segmentations_follow_their_weights():
    sampler = pieces.Sampler(pieces.TOKENIZER_PATH, 0.5)
    drawn = [tuple(ids) for ids in sampler.encode_block(["the cat"] * 20_000, list(range(20_000)))]
    vocabulary, weights = sampler.vocabulary, sampler.weights[:, 0]
    total = {}
    for stretch in ("the", "▁cat"):
        total[stretch] = np.exp(brute_marginal(vocabulary, stretch, sampler.weights))[0]
    for ids in set(drawn):
        chance = np.prod([weights[i] for i in ids]) / (total["the"] * total["▁cat"])
        assert abs(drawn.count(ids) / len(drawn) - chance) < 0.02
